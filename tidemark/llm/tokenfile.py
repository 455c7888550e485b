"""Token ids in binary files of patched frame-of-reference blocks.

Writing: documents are dealt by ranges of doc_id and sorted; each task encodes its whole texts and writes one file of
segments of at least `SEGMENT` ids (a document is never cut; the last segment of a file is shorter).  A segment is

    magic, shard, number in the shard, documents, ids, blocks, exceptions    (one header)
    doc ids, whether they are null, ids of each document
    of each block: least id, width, place of its packed ids, number of its first exception    (the block index)
    packed ids of all blocks; places and high parts of all exceptions

and ends with a line feed.  A block of `BLOCK` ids subtracts its least id and packs the rest at one width in bits: that of
the percentile in `PERCENTILES` which makes the block smallest.  Ids that don't fit keep their low bits there and go to
the exception list with their place in the block and their high part.  `ids_between` decodes only the blocks it needs.

Reading: files are read as they are; shards follow the order of doc_id, so the ids before a segment are the sum over
earlier segments, of which there is one row for each some million ids.

Encoding: the vocabulary drops white space, so the ids of a text are those of its white-space-separated pieces in order;
each worker keeps the ids of about `KNOWN` pieces and words at most.  With `pieces=False` texts are encoded whole (for other vocabularies).

Cases: a null text counts as empty; an empty text has the end id only; rows of equal id stand in the order of a hash of
their texts, a null id comes first; repeated rows are documents of their own; an empty table gives no rows; other
columns are ignored.  Strings of special tokens in a text become those tokens, as the library does by default.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import read, saved, stored, text_of

VOCABULARY = "word_bpe_49k.json"
END = 2
MAGIC = b"TMPFOR01"
HEADER = struct.Struct("<8sqqqqqq")
BLOCK = 1024
PERCENTILES = (100, 99, 98, 95, 90, 80)
SEGMENT = 1 << 21
KNOWN = 1 << 19
#: Bytes of text for each file.
FILE_BYTES = 256 << 20
_EXCEPTION_BITS = 48
_SLAB = 256


# ---- blocks

def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that whole numbers below 2^32 need."""
    return np.frexp(x.astype(np.float64))[1]


def _packed(values: np.ndarray, w: int) -> np.ndarray:
    """Rows of `BLOCK` numbers of w bits as rows of bytes: 64 numbers to w words of 64 bits."""
    lanes = np.ascontiguousarray(values.reshape(-1, 64).T).astype(np.uint64)
    out = np.zeros((w, lanes.shape[1]), np.uint64)
    for i in range(64):
        word, bit = divmod(i * w, 64)
        out[word] |= lanes[i] << np.uint64(bit)
        if bit + w > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - bit)
    return np.ascontiguousarray(out.T).astype("<u8").view(np.uint8).reshape(len(values), -1)


def _unpacked(data: np.ndarray, w: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(data).view("<u8").reshape(-1, w).T)
    out, mask = np.empty((64, words.shape[1]), np.uint32), np.uint64((1 << w) - 1)
    for i in range(64):
        word, bit = divmod(i * w, 64)
        got = words[word] >> np.uint64(bit)
        if bit + w > 64:
            got |= words[word + 1] << np.uint64(64 - bit)
        out[i] = got & mask
    return np.ascontiguousarray(out.T).reshape(len(data), BLOCK)


def pack_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]:
    """least id, width, place and first exception of each block; packed bytes; places and high parts of exceptions."""
    n = -(-len(ids) // BLOCK)
    rest = np.full(n * BLOCK, ids[-1] if len(ids) else 0, np.uint32)
    rest[: len(ids)] = ids
    rest = rest.reshape(n, BLOCK)
    least = rest.min(1, initial=np.iinfo(np.uint32).max)
    rest -= least[:, None]
    # how many numbers of a block need at most so many bits
    need = np.bincount((_bits(rest) + 33 * np.arange(n)[:, None]).ravel(), minlength=33 * n).reshape(n, 33).cumsum(1)
    width, cost = np.zeros(n, np.int64), np.full(n, np.inf)
    for p in PERCENTILES:
        w = (need < BLOCK * p / 100).sum(1)
        price = BLOCK * w + _EXCEPTION_BITS * (BLOCK - need[np.arange(n), w])
        width, cost = np.where(price < cost, w, width), np.minimum(price, cost)
    size = width * BLOCK // 8
    place = np.cumsum(size) - size
    packed = np.zeros(int(size.sum()), np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        which = np.flatnonzero(width == w)
        for lo in range(0, len(which), _SLAB):
            some = which[lo : lo + _SLAB]
            bits = _packed(rest[some] & np.uint32((1 << w) - 1), w)
            packed[place[some][:, None] + np.arange(bits.shape[1])] = bits
    out = np.flatnonzero(need[np.arange(n), width] < BLOCK)  # blocks with exceptions
    high = rest[out] >> width[out, None].astype(np.uint32)
    who, where = np.nonzero(high)
    many = np.bincount(out[who], minlength=n)
    return least, width.astype(np.uint8), place, np.cumsum(many) - many, packed.tobytes(), where.astype(np.uint16), high[who, where]


def unpack_blocks(least, width, place, first, packed: np.ndarray, where: np.ndarray, high: np.ndarray, begin: int, end: int) -> np.ndarray:
    """The ids of blocks begin to end (exclusive), the padding of the last one included."""
    out = np.zeros((end - begin, BLOCK), np.uint32)
    for w in np.unique(width[begin:end]).tolist():
        which = np.flatnonzero(width[begin:end] == w) + begin
        for lo in range(0, len(which) if w else 0, _SLAB):
            some = which[lo : lo + _SLAB]
            out[some - begin] = _unpacked(packed[place[some][:, None] + np.arange(w * BLOCK // 8)], w)
    starts = np.append(first, len(where))
    a, b = int(starts[begin]), int(starts[end])
    who = np.repeat(np.arange(begin, end), np.diff(starts[begin : end + 1]))
    out[who - begin, where[a:b]] += high[a:b] << width[who].astype(np.uint32)
    return (out + least[begin:end, None]).ravel()


# ---- segments

def segment_bytes(shard: int, number: int, doc_ids: list, sizes: list[int], ids: np.ndarray) -> bytes:
    least, width, place, first, packed, where, high = pack_blocks(ids)
    head = HEADER.pack(MAGIC, shard, number, len(doc_ids), len(ids), len(least), len(where))
    keys = np.array([0 if d is None else d for d in doc_ids], "<i8")
    null = np.array([d is None for d in doc_ids], np.uint8)
    parts = [keys, null, np.array(sizes, "<i8"), least.astype("<u4"), width, place.astype("<i8"), first.astype("<i8")]
    return b"".join([head, *(p.tobytes() for p in parts), struct.pack("<q", len(packed)), packed, where.astype("<u2").tobytes(), high.astype("<u4").tobytes()])


class Segment:
    """One segment of a file's content that begins at byte `at`; `end` is the byte after it and its line feed."""

    def __init__(self, content: bytes, at: int = 0):
        magic, self.shard, self.number, docs, self.n_ids, blocks, exceptions = HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        at += HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(content, kind, n, at)
            at += got.nbytes
            return got

        keys, null, self.sizes = take("<i8", docs), take("u1", docs), take("<i8", docs)
        self.doc_ids = [None if z else k for k, z in zip(keys.tolist(), null.tolist())]
        index = take("<u4", blocks), take("u1", blocks), take("<i8", blocks), take("<i8", blocks)
        packed = take("u1", int(take("<i8", 1)[0]))
        self._parts = (*index, packed, take("<u2", exceptions), take("<u4", exceptions))
        self.blocks = blocks
        self.end = at + 1

    def ids_between(self, begin: int, end: int) -> np.ndarray:
        """The ids from place `begin` to `end` (exclusive); only the blocks that hold them are decoded."""
        begin, end = max(0, begin), min(end, self.n_ids)
        if begin >= end:
            return np.zeros(0, np.uint32)
        a, b = begin // BLOCK, -(-end // BLOCK)
        return unpack_blocks(*self._parts, a, b)[begin - a * BLOCK : end - a * BLOCK]

    def documents(self):
        """(doc id, first place, ids) of each document, some blocks at a time."""
        stops = np.cumsum(self.sizes).tolist()
        lo = hi = 0
        some = np.zeros(0, np.uint32)
        for doc, size, stop in zip(self.doc_ids, self.sizes.tolist(), stops):
            if stop > hi:
                lo, hi = stop - size, min(self.n_ids, max(stop, stop - size + _SLAB * BLOCK))
                some = self.ids_between(lo, hi)
            yield doc, stop - size, some[stop - size - lo : stop - lo]


def segments(content: bytes):
    at = 0
    while at < len(content):
        segment = Segment(content, at)
        yield segment
        at = segment.end


# ---- tables

def _letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: visible bytes themselves, the others from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in seen else next(rest)) for b in range(256)]


class _Words(dict):
    """The ids of a model's words, in bytes."""

    def __init__(self, library):
        self.model, self.letters = library.model.tokenize, _letters().__getitem__

    def __missing__(self, word: str) -> bytes:
        seen = word if word.isascii() else "".join(map(self.letters, word.encode()))
        ids = [t.id for t in self.model(seen)]
        got = self[word] = struct.pack(f"<{len(ids)}I", *ids)
        return got


class _Pieces(dict):
    """The ids of white-space-separated pieces, in bytes.

    A piece of Latin letters and then ASCII punctuation is two words of the model, which are kept each; all others
    go through the whole library.  `PROBES` must come out alike in both ways, else the library encodes all pieces.
    """

    PROBES = ["Straße", "a", "ÀÉÎÕÜÿß,", "word.", "WORD?!", "µm)", "naïve...", "x" * 70 + ";", *map(chr, [*range(65, 91), *range(192, 256)])]
    PUNCTUATED = re.compile(r"([A-Za-zªµºÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)").fullmatch

    def __init__(self, library):
        self.library, self.words, self.by_words = library, _Words(library), True
        self.by_words = all(self.ids(p) == self.whole(p) for p in self.PROBES)

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, piece: str) -> bytes:
        found = self.PUNCTUATED(piece)
        if not found or not self.by_words:
            return self.whole(piece)
        core, tail = found.groups()
        got = self.words[core.lower()]
        return got + self.words[tail] if tail else got

    def __missing__(self, piece: bytes) -> bytes:
        got = self[piece] = self.ids(piece.decode())
        return got

    def text(self, text: str) -> bytes:
        if len(self) > KNOWN:
            self.clear()
        if len(self.words) > KNOWN:
            self.words.clear()
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split()))  # at ASCII white space


@functools.lru_cache(maxsize=2)  # a worker's tasks share the pieces
def encoder(path: str, pieces: bool = True):
    """A function from a text to its ids, as little-endian unsigned 32-bit integers in bytes."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    if not pieces:
        return lambda text: np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    return _Pieces(library).text


def write_tokens(docs: DataFrame, vocabulary: str, path: str, end: int | None = END, pieces: bool = True) -> None:
    """Write the ids of all documents, in the order of doc_id, to files in the folder `path`."""
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    order = ["doc_id", "_h", "_at"]  # the place in the input parts rows of equal id and text
    rows = rows.withColumn("_h", F.xxhash64("text")).withColumn("_at", F.monotonically_increasing_id())
    last = b"" if end is None else struct.pack("<I", end)

    def encoded(batches):
        shard, number = TaskContext.get().partitionId(), 0
        encode = encoder(vocabulary, pieces)
        doc_ids, parts, n = [], [], 0

        def segment():
            sizes = [len(p) // 4 for p in parts]
            data = segment_bytes(shard, number, doc_ids, sizes, np.frombuffer(b"".join(parts), "<u4"))
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

        for batch in batches:
            for i, doc in enumerate(batch.column(0).to_pylist()):
                ids = encode(batch.column(1)[i].as_py()) + last
                doc_ids.append(doc)
                parts.append(ids)
                n += len(ids) // 4
                if n >= SEGMENT:
                    yield segment()
                    number += 1
                    doc_ids, parts, n = [], [], 0
        if doc_ids:
            yield segment()

    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text")
    # Spark's text writer copies a string's bytes as they are and ends each row with a line feed
    dealt.mapInArrow(encoded, "data binary").select(F.col("data").cast("string")).write.option("compression", "none").text(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """content (binary) of each file."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def read_documents(spark: SparkSession, path: str, made, shape: str) -> DataFrame:
    """doc_id, start, n_tokens and the columns that `made` (ids of a document to a tuple) gives, named by `shape`."""
    def documents(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                for s in segments(batch.column(0)[i].as_py()):
                    rows = [(s.shard, s.number, at, doc, len(ids), *made(ids)) for doc, at, ids in s.documents()]
                    for lo in range(0, len(rows), 4096):
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[lo : lo + 4096]], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    spec = f"_shard bigint, _number bigint, _at bigint, doc_id bigint, n_tokens bigint, {shape}"
    schema = to_arrow_schema(spark.createDataFrame([], spec).schema)
    found = stored(read_segments(spark, path).mapInArrow(documents, spec))
    parts = found.groupBy("_shard", "_number").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    within = Window.partitionBy("_shard").orderBy("_number").rowsBetween(Window.unboundedPreceding, -1)
    shards = parts.groupBy("_shard").agg(F.sum("_n").alias("_n")).select("_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s0"))
    starts = parts.select("_shard", "_number", F.coalesce(F.sum("_n").over(within), F.lit(0)).alias("_s1")).join(shards, "_shard")
    return found.join(starts, ["_shard", "_number"]).withColumn("start", F.col("_s0") + F.col("_s1") + F.col("_at")).drop("_shard", "_number", "_at", "_s0", "_s1")


def folder(spark: SparkSession) -> str:
    """A new folder's name beside the checkpoints, which driver and executors share."""
    saved(spark.range(0))  # sets the checkpoint folder where it is unset
    return f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}"


def op13_token_files(spark, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32."""
    path = folder(spark)
    write_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), path)
    rows = read_documents(spark, path, lambda ids: (zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes()),), "ids_crc32 bigint")
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")
