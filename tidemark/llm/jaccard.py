"""N-gram Jaccard join by chosen paths.

Texts are sets of hashed word 5-grams (a shorter text is one gram).  Exact copies of a word sequence are one class from
the start.  Each class is embedded as a tuple of `TOKENS` minimum hashes; two sets of similarity J share each of these
tokens with probability J.  In each of `RUNS` runs a node of the recursion samples `CHOSEN` token positions, and sets
that share a sampled token go to the same child; a child of up to `SMALL` sets, one that keeps most of its parent's
sets (splitting it further would not part them), or one at the last level is a leaf.  In leaves all pairs are compared
exactly on their grams; a pair that shares several leaves counts in the first of them only.

A leaf of more than `TILE` sets is cut into chunks of about so many.  Each set's text goes to its leaf once; a chunk is
compared within itself and leaves one packed row of its sets of grams, and packed rows meet two by two.  A leaf of n
sets thus makes (n / TILE)^2 rows at most, beside n^2 / 2 comparisons, which links between different texts need.

Recall: a pair at similarity 0.8 shares a child with probability 1 - 0.2^2 = 0.96 a level, so three runs of three
levels miss it with probability (1 - 0.96^3)^3 < 0.2 %; runs repeat until `RECALL` is reached for the deepest path.

Output: a row for each document with the smallest id of its class (documents connected by links) and its number of
links, copies included.  Links are not expanded into rows: a comparison gives sums and a spanning forest.

Cases: null and empty texts have no grams and link to nothing; their class is their own id; rows with a null id take
part in no class (class null, links 0); rows that repeat an id with the same text count as copies, with another text
as documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import read, saved, stored, text_of
from tidemark.plans.scale import join_hot

GRAM = 5
SIMILARITY = 0.8
TOKENS = 64
CHOSEN = 2
LEVELS = 3
RECALL = 0.998
SMALL = 48
DENSE = 0.5
TILE = 256
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(11).integers(1, 2**63, TOKENS, dtype=np.uint64) | np.uint64(1)
_POWERS = np.random.default_rng(12).integers(1, 2**63, GRAM, dtype=np.uint64) | np.uint64(1)
_BYTES = np.random.default_rng(13).integers(1, 2**63, 256, dtype=np.uint64)


def runs() -> int:
    """Runs until a pair at the least similarity meets with probability `RECALL` at the deepest level."""
    once = (1 - (1 - SIMILARITY) ** CHOSEN) ** LEVELS
    return math.ceil(math.log(1 - RECALL) / math.log(1 - once))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MULTIPLY
    return (x ^ (x >> np.uint64(29))) * _MULTIPLY


def grams(text: str) -> np.ndarray:
    """Hashes of a text's word n-grams, in order, with repeats: bytes to words to grams in whole-array steps."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    solid = (data != 32) & ((data < 9) | (data > 13))
    edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    # a word's hash: the sum over its bytes of a random number for the byte times one for the place in the word
    data, solid, stop, start = data[start[0] :], solid[start[0] :], stop - start[0], start - start[0]
    inside = np.arange(len(data)) - np.repeat(start, np.diff(np.append(start, len(data))))
    odd = (inside.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _MULTIPLY
    code = np.where(solid, _BYTES[data] * odd, np.uint64(0))
    word = _mix(np.add.reduceat(code, start) + (stop - start).astype(np.uint64))
    if len(word) < GRAM:
        return _mix((word * _POWERS[: len(word)]).sum(keepdims=True) + np.uint64(len(word)))
    n = len(word) - GRAM + 1
    return _mix(sum(word[i : i + n] * _POWERS[i] for i in range(GRAM)))


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, h, text; id and hash tell unlike rows apart."""
    text = text_of(docs)
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), copy (digest of the word sequence; null without words), tokens (minimum hashes)."""
    def sketch(batches):
        for b in batches:
            copy, tokens = [], []
            for i in range(b.num_rows):
                text = b.column(2)[i].as_py()
                g = grams(text)
                if not len(g):
                    copy.append(None)
                    tokens.append(None)
                    continue
                copy.append(hashlib.blake2b(" ".join(text.split()).encode("utf-8", "replace"), digest_size=16).digest())
                tokens.append([int((_s * g).min() >> np.uint64(33)) for _s in _SEEDS])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(copy, pa.binary()), pa.array(tokens, pa.list_(pa.int32()))], names=["doc_id", "h", "copy", "tokens"])

    return _texts(docs).mapInArrow(sketch, "doc_id bigint, h bigint, copy binary, tokens array<int>")


def leaves(reps: DataFrame) -> DataFrame:
    """leaf, rep: the sets of at least two that the recursion leaves for comparison.  reps: rep, tokens."""
    roots = F.array(*[F.struct(F.xxhash64(F.lit(r), F.lit(c), F.element_at("tokens", c + 1)).alias("path"))
                      for r, root in enumerate(np.random.default_rng(14).permuted(np.tile(np.arange(TOKENS), (runs(), 1)), axis=1)[:, :CHOSEN].tolist()) for c in root])
    now = reps.select("rep", F.explode(roots).alias("x")).select("rep", "x.path", F.lit(2**62).alias("parent"))
    now = stored(now)
    ends = None
    for level in range(1, LEVELS + 1):
        sizes = stored(now.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
        now = stored(join_hot(now, sizes, "path", "n"))
        last = F.lit(level == LEVELS) | (F.col("n") <= SMALL) | (F.col("n") >= DENSE * F.col("parent"))
        done = now.filter(last).select(F.col("path").alias("leaf"), "rep")
        ends = done if ends is None else ends.unionByName(done)
        if level < LEVELS:
            deeper = now.filter(~last).join(reps, "rep")
            positions = [F.pmod(F.xxhash64("path", F.lit(i)), F.lit(TOKENS)).cast("int") for i in range(CHOSEN)]
            child = F.array_distinct(F.array(*[F.xxhash64("path", p, F.element_at("tokens", p + 1)) for p in positions]))
            now = stored(deeper.select("rep", F.col("n").alias("parent"), F.explode(child).alias("path")))
    # leaves with the same members need one comparison
    same = ends.groupBy("leaf").agg(F.sum(F.pmod(F.xxhash64("rep"), F.lit(2**40))).alias("s"), F.min("rep").alias("a"), F.count(F.lit(1)).alias("n"))
    kept = stored(same.groupBy("s", "a", "n").agg(F.min("leaf").alias("leaf")).select("leaf", "n"))
    return join_hot(ends, kept, "leaf", "n")


def _adjacency(sets: list[np.ndarray]) -> np.ndarray:
    """Whether each two sets are similar enough, exactly."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    flat, who = np.concatenate(sets), np.repeat(np.arange(m), size)
    order = np.argsort(flat, kind="stable")
    flat, who = flat[order], who[order]
    group = np.cumsum(np.diff(flat, prepend=flat[:1]) != 0)
    often = np.bincount(group)
    use = often[group] > 1
    new = np.cumsum(often > 1) - 1
    group, who = new[group[use]], who[use]
    both = np.zeros((m, m), np.float32)
    width = 4096
    for lo in range(0, int(group[-1]) + 1 if len(group) else 0, width):
        a, b = np.searchsorted(group, [lo, lo + width])
        dense = np.zeros((m, width), np.float32)
        dense[who[a:b], group[a:b] - lo] = 1
        both += dense @ dense.T
    return both >= SIMILARITY * (size[:, None] + size[None, :] - both) - 1e-6


def _compare(rows: list, leaf: int, other: int):
    """(links by rep, forest edges) of the first `other` rows with the rest, or of all if `other` is 0.

    rows: (rep, copies, leaves, distinct grams).
    """
    ok = _adjacency([r[3] for r in rows])
    np.fill_diagonal(ok, False)
    if other:
        ok[:other, :other] = ok[other:, other:] = False
    # a pair counts in the first leaf that it shares
    earlier = sorted({z for r in rows for z in r[2] if z < leaf})
    if earlier and ok.any():
        place = {z: i for i, z in enumerate(earlier)}
        has = np.zeros((len(rows), len(earlier)), np.float32)
        for i, r in enumerate(rows):
            for z in r[2]:
                if z < leaf:
                    has[i, place[z]] = 1
        ok &= (has @ has.T) == 0
    links = ok @ np.array([r[1] for r in rows], np.int64)
    rep = np.array([r[0] for r in rows], np.int64)
    root = rep.copy()
    while True:
        least = np.minimum(root, np.where(ok, root[None, :], np.iinfo(np.int64).max).min(1))
        if (least == root).all():
            break
        root = least
    return [(r[0], None, int(n)) for r, n in zip(rows, links) if n] + [(r[0], int(t), 0) for r, t in zip(rows, root) if t != r[0]]


def _packed(rows: list) -> bytes:
    """Sets that are alike lie side by side, and so pack well."""
    sizes = np.array([len(r[3]) for r in rows], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(([r[:3] for r in rows], sizes, np.concatenate([r[3] for r in rows]))))


def _unpacked(data: bytes) -> list:
    rows, sizes, flat = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
    return [(*r, g) for r, g in zip(rows, np.split(flat, np.cumsum(sizes)[:-1]))]


_FOUND = "a bigint, b bigint, links bigint, leaf bigint, chunk int, chunks int, data binary"
_SHAPE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64()), ("leaf", pa.int64()), ("chunk", pa.int32()), ("chunks", pa.int32()), ("data", pa.binary())])


def _found(rows: list) -> pa.RecordBatch:
    rows = [(*r, *[None] * (7 - len(r))) for r in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SHAPE)], schema=_SHAPE)


def _by_key(batches, width: int):
    """(key, rows) of runs of rows that agree in the first `width` columns."""
    key, rows = None, []
    for b in batches:
        cols = [c.to_pylist() for c in b.columns[:-1]]
        for i, r in enumerate(zip(*cols)):
            if r[:width] != key:
                if rows:
                    yield key, rows
                key, rows = r[:width], []
            rows.append((*r[width:], b.column(b.num_columns - 1)[i].as_py()))
    if rows:
        yield key, rows


def linked(docs: DataFrame, reps: DataFrame, ends: DataFrame, again: DataFrame) -> DataFrame:
    """a, b, links: sums of links of a (b null) and edges of spanning forests (links 0).

    reps: rep, doc_id, h, copies; ends: leaf, rep, n; again: doc_id, h of texts that an id repeats.
    """
    mine = ends.groupBy("rep").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))  # at most RUNS x CHOSEN^LEVELS each
    asked = reps.select("rep", "doc_id", "h", "copies").join(mine, "rep")
    chunks = F.ceil(F.col("n") / TILE).cast("int")
    cut = ends.select("leaf", "rep", chunks.alias("chunks"), F.pmod(F.xxhash64("rep"), chunks).cast("int").alias("chunk")).join(asked, "rep")
    texts = _texts(docs)
    if not again.isEmpty():  # of rows that repeat id and text one is enough
        texts = texts.join(again, ["doc_id", "h"], "left_anti").unionByName(texts.join(again, ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id", "h"]))
    full = cut.join(texts, ["doc_id", "h"])
    full = full.select("leaf", "chunk", "chunks", "rep", "copies", "leaves", "text").repartition("leaf", "chunk").sortWithinPartitions("leaf", "chunk", "rep")

    def within(batches):
        for (leaf, chunk, chunks), rows in _by_key(batches, 3):
            rows = [(*r[:3], np.unique(grams(r[3]))) for r in rows]
            out = _compare(rows, leaf, 0) if len(rows) > 1 else []
            if chunks > 1:
                out.append((None, None, None, leaf, chunk, chunks, _packed(rows)))
            if out:
                yield _found(out)

    def across(batches):
        for (leaf, *_), rows in _by_key(batches, 3):
            if len(rows) == 2:
                one, two = (_unpacked(r[-1]) for r in rows)
                if out := _compare(one + two, leaf, len(one)):
                    yield _found(out)

    found = stored(full.mapInArrow(within, _FOUND))
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: o != F.col("chunk")))
    packed = found.filter(F.col("data").isNotNull()).select("leaf", "chunk", other.alias("o"), "data")
    tiles = packed.select("leaf", F.least("chunk", "o").alias("x"), F.greatest("chunk", "o").alias("y"), "chunk", "data")
    tiles = tiles.repartition("leaf", "x", "y").sortWithinPartitions("leaf", "x", "y", "chunk")
    crossed = tiles.mapInArrow(across, _FOUND)
    return found.filter(F.col("data").isNull()).select("a", "b", "links").unionByName(crossed.select("a", "b", "links"))


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node is connected to.  edges: a, b."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = saved(both)
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")))
    while True:
        told = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(told, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("root").alias("far"))
        new = saved(step.join(jump, "via", "left").select("node", "old", F.least("via", F.coalesce("far", "via")).alias("root")))
        labels = new.select("node", "root")
        if new.filter(F.col("old") != F.col("root")).isEmpty():
            return labels


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sketches; of each copy group: copy, copies, links, least (doc_id and h of its class); doc_id, h of repeated rows."""
    known = stored(sketches(docs))
    again = stored(known.filter(F.col("doc_id").isNotNull()).groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id", "h"))
    first = F.min(F.struct("doc_id", "h")).alias("first")
    reps = known.filter(F.col("copy").isNotNull() & F.col("doc_id").isNotNull()).groupBy("copy").agg(first, F.count(F.lit(1)).alias("copies"), F.first("tokens").alias("tokens"))
    reps = stored(reps.select(F.monotonically_increasing_id().alias("rep"), "copy", "first.doc_id", "first.h", "copies", "tokens"))
    ends = stored(leaves(reps.select("rep", "tokens")))
    found = stored(linked(docs, reps, ends, again))
    roots = components(found.filter(F.col("b").isNotNull()))
    links = found.filter(F.col("b").isNull()).groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    told = reps.select("rep", "copy", "copies", "doc_id", "h").join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    told = stored(told.select("copy", "copies", "doc_id", "h", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "rep").alias("root")))
    least = told.groupBy("root").agg(F.min(F.struct("doc_id", "h")).alias("least"))
    return known, stored(told.join(least, "root").select("copy", "copies", "links", "least")), again


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links."""
    known, told, _ = _classes(docs)
    has = F.col("copy").isNotNull() & F.col("doc_id").isNotNull()
    ours = join_hot(known.filter(has).select("doc_id", "copy"), told, "copy", "copies")
    ours = ours.select("doc_id", F.col("least.doc_id").alias("class_id"), (F.col("links") + F.col("copies") - 1).alias("n_links"))
    rest = known.filter(~has).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return ours.unionByName(rest)


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class: the one of the smallest id, and of texts under one id that of the smallest hash.

    Of rows that repeat its id and text one stays; documents without an id or without words all stay.
    """
    known, told, again = _classes(docs)
    has = F.col("copy").isNotNull() & F.col("doc_id").isNotNull()
    ours = (join_hot(known.filter(has).select("doc_id", "h", "copy"), told, "copy", "copies").withColumn("keeps", F.col("least") == F.struct("doc_id", "h")).select("doc_id", "h", "keeps"))
    gone = ours.filter(~F.col("keeps")).select("doc_id", "h").distinct()
    # names of our own, since the table may have any
    rows = docs.select(F.struct(*docs.columns).alias("row"), docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(text_of(docs)).alias("h"))
    left = rows.join(gone, ["doc_id", "h"], "left_anti")
    again = again.join(ours.filter("keeps").select("doc_id", "h").distinct(), ["doc_id", "h"])
    if not again.isEmpty():
        left = left.join(again, ["doc_id", "h"], "left_anti").unionByName(left.join(again, ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]))
    return left.select("row.*")


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """doc_id, class_id, n_links."""
    return classes(read(spark, sf_dir, "documents"))
