"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Encoding: texts are split into pre-tokens, block by block of documents.  A block keeps its distinct pre-tokens once and
each document as the numbers of its pre-tokens in order.  All blocks' pre-tokens are shuffled by the pre-token, so each
distinct one meets itself and is encoded once; its ids go back to the blocks that hold it, where documents are
reassembled by position.  A common pre-token thus moves once for each block, not for each use.
Decoding looks ids up in the token-byte table, which is as large as the vocabulary and goes to each task.

Cases: a null text counts as empty; an empty text has no ids; ids are the ranks of the vocabulary; repeated rows are
documents of their own; an empty table gives no rows; other columns are ignored.  Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import pickle
import zlib
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import read, text_of

VOCABULARY = "byte_bpe_50k.tiktoken"
#: A block is closed at this many characters; the largest text may exceed it.
BLOCK_CHARS = 8 << 20
#: From this length on, merges are found with a heap.
LONG_WORD = 128


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the pair with the lowest rank, leftmost first, is merged until none is left."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) >= LONG_WORD:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    none = len(ranks)
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(word)
    end = list(range(1, n + 1))  # a part begins at i and ends at end[i]
    prev, alive = list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue  # one of the two has been merged meanwhile
        alive[j] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^32, byte planes apart, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _words_packed(words: list[bytes]) -> bytes:
    return pickle.dumps((_packed(np.array([len(w) for w in words])), zlib.compress(b"".join(words), 1)))


def _words_unpacked(data: bytes) -> list[bytes]:
    lens, joined = pickle.loads(data)
    joined, ends = zlib.decompress(joined), np.cumsum(_unpacked(lens).astype(np.int64)).tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


def _blocks(docs: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """block, data: ids of documents, pre-tokens of each, their stream (pre-tokens by number, the commonest first), and the
    block's distinct pre-tokens by bucket, in order, with the numbers in that order.

    One binary column, so that all readers share one exchange and texts are split once.
    """
    shape = pa.schema([("block", pa.int64()), ("data", pa.binary())])

    def split(batches):
        find = regex.compile(pattern).findall
        home, count = TaskContext.get().partitionId() << 24, 0
        ids, lens, parts, number, chars = [], [], [], {}, 0

        def block():
            flat = np.concatenate(parts)
            order = np.argsort(-np.bincount(flat, minlength=len(number)), kind="stable")
            rank = np.empty(len(number), np.int64)
            rank[order] = np.arange(len(number))
            words = sorted((crc32(w) % buckets, w, n) for w, n in ((w.encode("utf-8", "replace"), n) for w, n in number.items()))
            dealt = {b: _words_packed([w for _, w, _ in group]) for b, group in groupby(words, itemgetter(0))}
            place = rank[[n for _, _, n in words]] if words else np.zeros(0, np.int64)
            data = pickle.dumps((ids, _packed(np.array(lens)), _packed(rank[flat]), _packed(place), dealt))
            return pa.RecordBatch.from_arrays([pa.array([home + count]), pa.array([data], pa.binary())], schema=shape)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at, key in enumerate(keys):
                text = batch.column(1)[at].as_py()
                words = find(text)
                parts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
                ids.append(key)
                lens.append(len(words))
                chars += len(text)
                if chars >= BLOCK_CHARS:
                    yield block()
                    count += 1
                    ids, lens, parts, number, chars = [], [], [], {}, 0
        if ids:
            yield block()

    return docs.select(docs["doc_id"], text_of(docs).alias("text")).mapInArrow(split, "block bigint, data binary")


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids (array<int>) of each document."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(load_ranks(path))  # as large as the vocabulary
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _blocks(docs, pattern, 4 * n).repartition(n, "block")

    def words(batches):
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                dealt = pickle.loads(data.as_py())[4]
                yield pa.RecordBatch.from_arrays([pa.array(list(dealt), pa.int32()), pa.array([block] * len(dealt), pa.int64()), pa.array(dealt.values(), pa.binary())], names=["bucket", "block", "words"])

    def encoded(batches):
        """The rows of a bucket hold all uses of its pre-tokens; each is encoded once and kept until the bucket ends."""
        table, done, now = ranks.value, {}, None
        for batch in batches:
            lens, ids = [], []
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(2)):
                if bucket != now:
                    done, now = {}, bucket
                mine = []
                for w in _words_unpacked(data.as_py()):
                    got = done.get(w)
                    if got is None:
                        got = done[w] = tuple(merge(w, table))
                    mine.append(got)
                lens.append(_packed(np.array([len(m) for m in mine])))
                ids.append(_packed(np.array([x for m in mine for x in m])))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), pa.array(lens, pa.binary()), pa.array(ids, pa.binary())], names=["block", "bucket", "lens", "ids"])

    spread = blocks.mapInArrow(words, "bucket int, block bigint, words binary").repartition(n, "bucket").sortWithinPartitions("bucket")
    found = spread.mapInArrow(encoded, "block bigint, bucket int, lens binary, ids binary")
    kind = docs.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)

    def joined(column) -> np.ndarray:
        return np.concatenate([_unpacked(x.as_py()) for x in column] or [np.zeros(0, np.uint32)]).astype(np.int64)

    def assembled(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, lens, stream, place, _ = pickle.loads(left.column("data")[0].as_py())
        right = right.sort_by("bucket")
        size, flat = joined(right.column("lens")), joined(right.column("ids")).astype(np.int32)
        lens, stream, place = _unpacked(lens).astype(np.int64), _unpacked(stream), _unpacked(place)
        begin, length = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        begin[place], length[place] = np.cumsum(size) - size, size
        n = length[stream]
        ends = np.cumsum(n)
        where = np.repeat(begin[stream] - (ends - n), n)
        where += np.arange(len(where))
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lens)])].astype(np.int32)
        return pa.table({"doc_id": pa.array(keys, arrow), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[where]))})

    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(assembled, f"doc_id {kind.simpleString()}, ids array<int>")


def token_bytes(path: str) -> list[bytes]:
    ranks = load_ranks(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        table[i] = token
    return table


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, data (binary) of documents given as doc_id, ids; a null list counts as empty."""
    table = encoded.sparkSession.sparkContext.broadcast(token_bytes(path))  # as large as the vocabulary
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def decoded(batches):
        look = table.value.__getitem__
        for batch in batches:
            data = [b"".join(map(look, x or ())) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, f"doc_id {kind}, data binary")


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of documents given as doc_id, ids: decodes and hashes."""
    table = encoded.sparkSession.sparkContext.broadcast(token_bytes(path))  # as large as the vocabulary
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def hashed(batches):
        look = table.value.__getitem__
        name = [str(i).encode() for i in range(len(table.value))].__getitem__
        for batch in batches:
            rows = []
            for at in range(batch.num_rows):
                ids = batch.column(1)[at].values
                ids = ids.to_numpy().tolist() if ids is not None else []
                rows.append((len(ids), hashlib.sha256(b" ".join(map(name, ids))).hexdigest(), hashlib.sha256(b"".join(map(look, ids))).hexdigest()))
            a, b, c = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(a, pa.int64()), pa.array(b, pa.string()), pa.array(c, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select("doc_id", "ids").mapInArrow(hashed, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encoded_digests(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return digests(encode(docs, path), path)


def op2_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded_digests(read(spark, sf_dir, "documents"))
