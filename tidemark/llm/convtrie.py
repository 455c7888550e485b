"""Prefix trie of conversations, built as ternary search trees over range shards.

Turns (role, text) are encoded by a dictionary, so a conversation is a row of whole numbers.  Conversations are sorted and
dealt by ranges of these rows, and ids within equal rows, so a frequent conversation spreads over shards.  A shard's
distinct rows go into a ternary search tree, the median first and then the medians of both sides, which balances it.
An iterative traversal accumulates members, leaves and savings from the leaves up.  Only the nodes on the paths of a shard's
first and last conversation can have members in other shards: these boundary nodes are merged, `FAN` neighbouring shards
at a time, until one group is left; what is no boundary of its group is finished there.

Members that end at a boundary node are kept as packed chunks and hashed one after the other, in order.  A conversation
occupies eight bytes a turn in one row; texts are read once, for the dictionary.

Cases: rows without a conv_id take no part; a null role or text counts as empty; equal turn numbers stand in the order of
a hash of role and text, null turns first; repeated rows are turns of their own; an empty table has no nodes; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import WORD, read, stored
from tidemark.llm.spelling import crc_ctes, crc_sql
from tidemark.plans.ordered import with_positions

#: Each conversation takes its first turns from the one at the multiple of this below it, so that prefixes are shared.
SIBLINGS = 20
BORROWED = 4
SHARD = 50_000
FAN = 64
CHUNK = 1 << 16
#: At most so many turns are dealt over several keys of the dictionary join.
HOT_TURNS = 1000
EMPTY = hashlib.sha256(b"").hexdigest()
ROOT = b""


# ---- conversations as rows of turn ids

def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest, words of each turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).alias("words"))


def coded(rows: DataFrame) -> DataFrame:
    """Replaces digest by id, a whole number for each distinct one; rows: conv_id, pos, digest and others.

    Digests with over a thousandth of the rows, fewer than `HOT_TURNS`, are dealt over several keys of the join.
    """
    counts = stored(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("uses")).withColumn("id", F.monotonically_increasing_id()))
    each = max(1000, (counts.agg(F.sum("uses")).first()[0] or 0) // HOT_TURNS)
    keys = F.ceil(F.col("uses") / each).cast("int")
    hot = F.broadcast(counts.filter(F.col("uses") > each).select("digest", keys.alias("_k")))  # under HOT_TURNS rows
    dealt = rows.join(hot, "digest", "left").withColumn("_s", F.coalesce(F.pmod(F.xxhash64("conv_id", "pos"), F.col("_k")).cast("int"), F.lit(0))).drop("_k")
    return dealt.join(counts.select("digest", "id", F.explode(F.sequence(F.lit(0), keys - 1)).alias("_s")), ["digest", "_s"]).drop("digest", "_s")


def borrowed(conv_id: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % BORROWED).cast("int")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, path (ids of its turns), words (of each): every conversation after the exchange of first turns."""
    rows = stored(turn_rows(conversations))
    turns = stored(coded(with_positions(rows, "conv_id", ["turn", "digest"]).drop("n", "turn")))
    item = F.struct("pos", "id", "words")
    own = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.when(F.col("pos") > borrowed(F.col("conv_id")), item))).alias("own"))
    first = turns.filter((F.col("conv_id") % SIBLINGS == 0) & (F.col("pos") < BORROWED)).groupBy(F.col("conv_id").alias("base"))
    first = first.agg(F.array_sort(F.collect_list(item)).alias("first"))
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % SIBLINGS).join(first, "base", "left")
    head = F.slice(F.coalesce("first", F.array().cast(both.schema["own"].dataType)), F.lit(1), borrowed(F.col("conv_id")))
    whole = both.select("conv_id", F.concat(head, "own").alias("_t"))
    return whole.select("conv_id", F.col("_t.id").alias("path"), F.col("_t.words").alias("words"))


# ---- one shard

class TernaryTree:
    """Nodes by number; `equal` leads to the tree of the next position, `low` and `high` to other codes of the same one."""

    def __init__(self):
        self.code, self.low, self.equal, self.high, self.parent, self.depth, self.words = [0], [-1], [-1], [-1], [-1], [0], [0]

    def insert(self, path: list[int], words: list[int]) -> list[int]:
        """The nodes of the path, from the root; missing ones are added."""
        code, low, equal, high = self.code, self.low, self.equal, self.high
        node, nodes = 0, [0]
        for d, c in enumerate(path):
            at, link, side = equal[node], equal, node
            while at >= 0 and code[at] != c:
                link, side = (low, at) if c < code[at] else (high, at)
                at = link[side]
            if at < 0:
                at = link[side] = len(code)
                code.append(c)
                for some in (low, equal, high):
                    some.append(-1)
                self.parent.append(node)
                self.depth.append(d + 1)
                self.words.append(words[d])
            nodes.append(at)
            node = at
        return nodes

    def in_order(self) -> list[int]:
        """All nodes, parents before children and siblings by code."""
        out, stack = [0], [self.equal[0]] if self.equal[0] >= 0 else []
        while stack:
            at = stack.pop()
            if at < 0:
                out.append(~at)
                after = [self.equal[~at]]
            else:
                after = [self.high[at], ~at, self.low[at]]
            stack += [x for x in after if x != -1]  # ~0 is -1, but the root is never on the stack
        return out


def _medians(n: int) -> list[int]:
    """0 to n - 1, the median first and then the medians of what is left and right of it."""
    out, stack = [], [(0, n)]
    while stack:
        a, b = stack.pop()
        if a < b:
            m = (a + b) // 2
            out.append(m)
            stack += [(m + 1, b), (a, m)]
    return out


def _key(parent: bytes, code: int) -> bytes:
    return hashlib.blake2b(parent + code.to_bytes(8, "little"), digest_size=16).digest()


def _hashed(ids) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


#: kind: 0 finished node, 1 part of a boundary node, 2 chunk of a boundary node's ends.
ROWS = """kind int, shard bigint, key binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint,
          n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, first boolean, last boolean, ends_sha256 string,
          number int, ends binary"""
NAMES = [x.split()[0] for x in ROWS.split(",")]


def _shard_nodes(shard: int, paths: list[list[int]], words: list[list[int]], ends: list[list[int]]):
    """Rows of one shard; paths are sorted and distinct, ends are the ids of each path's conversations, ascending."""
    tree = TernaryTree()
    spine, at_end = {}, {}  # boundary nodes with their keys; a node's ends
    for m in _medians(len(paths)):
        nodes = tree.insert(paths[m], words[m])
        at_end[nodes[-1]] = ends[m]
        if m in (0, len(paths) - 1):
            key = ROOT
            for node in nodes:
                key = _key(key, tree.code[node]) if node else ROOT
                before = spine.get(node, (key, False, False))
                spine[node] = (key, before[1] or m == 0, before[2] or m == len(paths) - 1)
    size = len(tree.code)
    n, conv, kids, leaves, saved = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size
    order = tree.in_order()
    for at in reversed(order):
        mine = at_end.get(at, ())
        n[at] += len(mine)
        if mine and (conv[at] is None or mine[0] < conv[at]):
            conv[at] = mine[0]
        up = tree.parent[at]
        if at not in spine:
            leaves[at] = leaves[at] or 1
            saved[at] += (n[at] - 1) * tree.words[at]
            kids[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
        if up >= 0:
            n[up] += n[at]
            if conv[up] is None or conv[at] < conv[up]:
                conv[up] = conv[at]
    for at in order:
        up = tree.parent[at]
        if at in spine:
            key, first, last = spine[at]
            yield (1, shard, key, spine[up][0] if up >= 0 else None, conv[at], tree.depth[at], None, n[at], kids[at], leaves[at], saved[at], tree.words[at], first, last, None, None, None)
            mine = np.array(at_end.get(at, ()), np.int64)
            for k in range(0, len(mine), CHUNK):
                some = mine[k : k + CHUNK]
                packed = zlib.compress(np.diff(some, prepend=0).astype("<i8").tobytes(), 1)
                yield (2, shard, key, *[None] * 12, k // CHUNK, packed)
        else:
            close = up not in spine
            yield (0, shard, None, None if close else spine[up][0], conv[at], tree.depth[at], conv[up] if close else None, n[at], kids[at], leaves[at], saved[at], tree.words[at],
                   None, None, _hashed(at_end[at]) if at in at_end else EMPTY, None, None)


def _batches(rows, schema: pa.Schema):
    """Batches of rows; few rows with large binaries."""
    some, load = [], 0
    for r in rows:
        some.append(r)
        load += 100 + len(r[-1] or b"")
        if load > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)
            some, load = [], 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def shard_tries(paths: DataFrame, shards: int) -> DataFrame:
    """The rows of all shards; paths: conv_id (distinct), path, words."""
    schema = to_arrow_schema(paths.sparkSession.createDataFrame([], ROWS).schema)

    def build(batches):
        keys, words, ends = [], [], []
        for b in batches:
            for conv, path, w in zip(*(c.to_pylist() for c in b.columns)):
                if not keys or keys[-1] != path:
                    keys.append(path)
                    words.append(w)
                    ends.append([])
                ends[-1].append(conv)
        if keys:
            yield from _batches(_shard_nodes(TaskContext.get().partitionId(), keys, words, ends), schema)

    dealt = paths.select("conv_id", "path", "words").repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    return stored(dealt.mapInArrow(build, ROWS))


# ---- boundary nodes

def _merged(group: int, rows: list[tuple], final: bool):
    """Rows of the boundary nodes of neighbouring shards, given as (shard, key, parent, conv_id, depth, n_convs, n_children,
    n_leaves, saved_tokens, words, first, last) by shard.  A node that is no boundary of the group is finished."""
    nodes, low, high = {}, set(), set()
    for shard, key, parent, conv, depth, n, kids, leaves, saved, words, first, last in rows:
        if shard == rows[0][0] and first:
            low.add(key)
        if shard == rows[-1][0] and last:
            high.add(key)
        if (x := nodes.get(key)) is None:
            nodes[key] = [parent, conv, depth, n, kids, leaves, saved, words]
        else:
            x[1] = min(x[1], conv)
            for i, more in ((3, n), (4, kids), (5, leaves), (6, saved)):
                x[i] += more
    open_ = set() if final else low | high
    for key in sorted(nodes, key=lambda k: -nodes[k][2]):
        parent, conv, depth, n, kids, leaves, saved, words = nodes[key]
        if key in open_:
            yield (1, group, key, parent, conv, depth, None, n, kids, leaves, saved, words, key in low, key in high, None, None, None)
            continue
        leaves, saved = leaves or 1, saved + (n - 1) * words
        if parent is not None:
            up = nodes[parent]
            up[4] += 1
            up[5] += leaves
            up[6] += saved
        yield (0, group, key, parent, conv, depth, None, n, kids, leaves, saved, words, None, None, None, None, None)


def merge_boundaries(parts: DataFrame, shards: int) -> DataFrame:
    """The finished boundary nodes of all shards, without the hash of their ends."""
    schema = to_arrow_schema(parts.sparkSession.createDataFrame([], ROWS).schema)
    use = ["shard", "key", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "words", "first", "last"]
    done = None
    while True:
        groups = -(-shards // FAN)

        def merge(batches, final=groups == 1):
            group, rows = None, []
            for b in batches:
                for g, *r in zip(*(c.to_pylist() for c in b.columns)):
                    if g != group:
                        if rows:
                            yield from _batches(_merged(group, rows, final), schema)
                        group, rows = g, []
                    rows.append(tuple(r))
            if rows:
                yield from _batches(_merged(group, rows, final), schema)

        dealt = parts.select((F.col("shard") / FAN).cast("bigint").alias("_g"), *use).repartition(groups, "_g").sortWithinPartitions("_g", "shard", "depth")
        now = stored(dealt.mapInArrow(merge, ROWS))
        finished = now.filter(F.col("kind") == 0)
        done = finished if done is None else done.unionByName(finished)
        if groups == 1:
            return done
        parts, shards = now.filter(F.col("kind") == 1), groups


def hashed_ends(chunks: DataFrame) -> DataFrame:
    """key, ends_sha256; the chunks of a key stream through one hash in order."""
    def hashes(batches):
        key, state, ids = None, None, 0
        for b in batches:
            out = []
            for k, data in zip(b.column(0).to_pylist(), b.column(1)):
                if k != key:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state, ids = k, hashlib.sha256(), 0
                more = np.cumsum(np.frombuffer(zlib.decompress(data.as_py()), "<i8")).tolist()
                state.update(("," * (ids > 0) + ",".join(map(str, more))).encode())
                ids += len(more)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())], names=["key", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    n = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.select("key", "ends", "shard", "number").repartition(n, "key").sortWithinPartitions("key", "shard", "number")
    return dealt.select("key", "ends").mapInArrow(hashes, "key binary, ends_sha256 string")


def trie(paths: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    paths: conv_id (distinct), path (array of whole numbers), words (of each, as many).
    """
    paths = stored(paths)
    shards = max(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), paths.count() // SHARD)
    rows = shard_tries(paths, shards)
    boundary = rows.filter(F.col("kind") == 1)
    # partition numbers are below `shards` unless the session raises what is asked for
    most = boundary.agg(F.max("shard")).first()[0] or 0
    done = stored(merge_boundaries(boundary, most + 1))
    conv = done.select("key", F.col("conv_id").alias("_conv"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    above = conv.withColumnRenamed("key", "parent").withColumnRenamed("_conv", "parent_conv_id")
    merged = done.drop("ends_sha256", "parent_conv_id").join(hashed_ends(rows.filter(F.col("kind") == 2)), "key", "left")
    merged = merged.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))).join(above, "parent", "left")
    inner = rows.filter(F.col("kind") == 0)
    # nodes below a boundary node take its smallest member from the boundary of their own shard
    here = boundary.select("shard", "key").join(conv, "key").select("shard", F.col("key").alias("parent"), "_conv")
    below = inner.filter(F.col("parent").isNotNull()).join(here, ["shard", "parent"]).withColumn("parent_conv_id", F.col("_conv"))
    return inner.filter(F.col("parent").isNull()).select(out).unionByName(below.select(out)).unionByName(merged.select(out))


def op11_conversation_trie(spark, sf_dir: str) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    return trie(rebuilt(read(spark, sf_dir, "conversations")))


OP11_SQL = f"""WITH {crc_ctes()},
turns AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) AS pos
  FROM (SELECT conv_id::BIGINT AS c, turn, substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS digest,
               len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS words
        FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT c, c - c % {SIBLINGS} AS base, {crc_sql("c::VARCHAR")} % {BORROWED} AS h FROM (SELECT DISTINCT c FROM turns), crc),
taken AS (
  SELECT v.c, 0 AS own, pos, digest, words FROM convs v JOIN turns t ON t.c = v.base AND t.pos <= v.h
  UNION ALL SELECT v.c, 1, pos, digest, words FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h),
paths AS (
  SELECT v.c, coalesce(p, []) AS p, coalesce(w, []) AS w
  FROM convs v LEFT JOIN (SELECT c, list(digest ORDER BY own, pos) AS p, list(words ORDER BY own, pos) AS w FROM taken GROUP BY c) x ON x.c = v.c),
steps AS (SELECT c, d, p[1:d] AS node, p[1:d - 1] AS up, len(p) AS l, coalesce(w[d], 0) AS words FROM (SELECT *, unnest(range(len(p) + 1)) AS d FROM paths)),
nodes AS MATERIALIZED (
  SELECT node, any_value(d) AS depth, CASE WHEN any_value(d) > 0 THEN any_value(up) END AS up, min(c) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(words) AS saved, sha256(coalesce(string_agg(CASE WHEN l = d THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM steps GROUP BY node),
kids AS (SELECT up, count(*) AS n FROM nodes GROUP BY up),
below AS (
  SELECT top, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT n.node[1:d] AS top, n.saved, (k.n IS NULL)::INT AS leaf
        FROM (SELECT *, unnest(range(depth + 1)) AS d FROM nodes) n LEFT JOIN kids k ON k.up = n.node)
  GROUP BY top)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.top = n.node LEFT JOIN kids k ON k.up = n.node LEFT JOIN nodes p ON p.node = n.up"""
