"""Mixing sources to target weights, with DataFrame functions only.

Each source's documents stand in a pseudorandom order as one stream of words, cut into blocks of a fixed number
of words.  Every output shard draws how many of its slots each source gets (a multinomial draw; draws beyond what
a source may give go, in order, to the sources that fell short, so totals are exact).  A source's slots run
through a pseudorandom permutation of its block indices, one permutation for each time round, and slots and
blocks meet in a join on (source, index).

Cases: null text counts as empty; a document without words takes part with size 0 and takes nothing; null is a
source of its own, last in order; repeated rows are documents of their own; an empty table gives an empty mix;
other columns are ignored unless carried.  Target weights are a setting for each source, so the list of sources
(one row each) is small enough for the driver; nothing else is gathered there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, read, running_sum, saved, text_of

#: Weights by the order of the sources, and the share of all words that the mix takes.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
#: A source gives each word twice at most.
TIMES = 2
BLOCK_WORDS = 256
SHARD_SLOTS = 4096
SEED = 20240607
#: A word with the separators after it, the first one also with those before it: all of them together are the text.
WHOLE_WORD = r"(?:\A[\x20\x09-\x0D]++)?[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+"


def _hash(*cols: Column) -> Column:
    return F.xxhash64(F.lit(SEED), *cols)


def sized(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, the source as a key without nulls, and what is carried (as `_c_<name>`)."""
    key = F.when(docs["source"].isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), docs["source"]))
    return docs.select(docs["doc_id"], docs["source"], key.alias("_sk"),
                       F.regexp_count(text_of(docs), F.lit(WORD)).cast("long").alias("size"),
                       *[docs[c].alias(f"_c_{c}") for c in carry])


def targets(sizes: DataFrame) -> DataFrame:
    """A row for each source: _sk, source, source_size, weight, target (double).

    Water-filling: sources in the order in which they reach their limit; the level is that of the first source
    which does not reach it when all before it have.
    """
    per = sizes.groupBy("_sk", "source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1, F.lit(len(WEIGHTS)))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (turn + 1).cast("int")))
    per = per.withColumn("_limit", (F.col("source_size") * TIMES).cast("double")).withColumn("_at", F.col("_limit") / F.col("weight"))
    by = Window.orderBy("_at", "_sk")
    past, every = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.sum("source_size").over(every) * F.lit(SHARE)
    left = total - F.coalesce(F.sum("_limit").over(past), F.lit(0.0))
    level = left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(past), F.lit(0)))
    per = per.withColumn("_level", level)
    # rounding must not push every source below the level
    fits = F.when(F.col("_level") <= F.col("_at") * (1 + 1e-12), F.struct("_at", "_sk", "_level"))
    per = per.withColumn("_level", F.min(fits).over(every)["_level"])
    return per.select("_sk", "source", "source_size", "weight",
                      F.least(F.col("_limit"), F.col("_level") * F.col("weight")).alias("target"))


def placed(sizes: DataFrame) -> DataFrame:
    """Adds `_start`, the place of the document's first word in its source's stream."""
    return running_sum(sizes.withColumn("_h", _hash(F.col("doc_id"))), ["_sk"], "_h", ["doc_id", "size"], "size", "_start").drop("_h")


def blocks(docs: DataFrame, table: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row for each block and time round: _sk, block, index (its place among the slots of its source) and words
    (the words its slot takes; the source's last slot may take fewer than the block holds)."""
    first = F.ceil(F.col("_start") / block_words)
    last = F.floor((F.col("_start") + F.col("size") - 1) / block_words)
    own = docs.filter((F.col("size") > 0) & (first <= last)).select("_sk", F.explode(F.sequence(first, last)).alias("block"))
    want = F.round("target").cast("long")
    own = own.join(F.broadcast(table.select("_sk", "source_size", want.alias("_want"))), "_sk")
    own = own.withColumn("_len", F.least(F.lit(block_words), F.col("source_size") - F.col("block") * block_words))
    own = own.withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(TIMES - 1))))
    own = own.withColumn("_h", _hash(F.col("_sk"), F.col("_round"), F.col("block")))
    own = running_sum(own, ["_sk", "_round"], "_h", ["block"], "_len", "_before", rank="_rank")
    n_blocks = F.ceil(F.col("source_size") / block_words)
    before = F.col("_before") + F.col("_round") * F.col("source_size")
    return own.withColumn("words", F.least(F.col("_len"), F.col("_want") - before)).filter(F.col("words") > 0).select(
        "_sk", "block", (F.col("_rank") + F.col("_round") * n_blocks).alias("index"), "words")


def slots(spark, quota: list[tuple[str, int]], shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """A row for each output slot: shard, slot, _sk, index.

    quota: slots for each source.  A shard's slots draw their source with the quotas as odds; counts for each
    shard and source, summed over the shards before, number a source's draws.  Draws beyond the quota are numbered
    on, and handed to the sources that drew too few.
    """
    quota = [x for x in quota if x[1] > 0]
    total = sum(n for _, n in quota)
    keys = F.array(*[F.lit(k) for k, _ in quota]) if quota else F.array(F.lit(""))
    ends, run = [], 0
    for _, n in quota:
        run += n
        ends.append(float(run))
    u = F.shiftrightunsigned(_hash(F.lit("draw"), F.col("id")), 11) * F.lit(2.0**-53) * float(total)
    drawn = spark.range(total).select((F.col("id") / shard_slots).cast("long").alias("shard"), "id", u.alias("u"))
    which = F.size(F.filter(F.array(*[F.lit(e) for e in ends[:-1]]).cast("array<double>"), lambda e: e <= F.col("u")))
    drawn = drawn.select("shard", F.col("id").alias("slot"), which.alias("s"))
    counts = saved(drawn.groupBy("shard", "s").agg(F.count(F.lit(1)).alias("_n"), F.min("slot").alias("_at")))
    past = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_first", F.coalesce(F.sum("_n").over(past), F.lit(0)))
    each = counts.select("shard", "s", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)).alias("j"))
    got = {r["s"]: r["n"] for r in counts.groupBy("s").agg(F.sum("_n").alias("n")).collect()}
    over, short, spare, need = [], [], 0, 0
    for i, (_, n) in enumerate(quota):
        g = got.get(i, 0)
        over.append(spare)
        short.append((need, g))
        spare += max(0, g - n)
        need += max(0, n - g)
    lookup = lambda xs: F.element_at(F.array(*[F.lit(int(x)) for x in xs] or [F.lit(0)]).cast("array<bigint>"), F.col("s") + 1)
    each = each.withColumn("_quota", lookup([n for _, n in quota])).withColumn("_o", lookup(over) + F.col("j") - F.col("_quota"))
    kept = each.filter(F.col("j") < F.col("_quota")).select("shard", "s", "j")
    ends2 = F.array(*[F.lit(int(a + max(0, n - g))) for (a, g), (_, n) in zip(short, quota)] or [F.lit(0)]).cast("array<bigint>")
    moved = each.filter(F.col("j") >= F.col("_quota")).withColumn("s", F.size(F.filter(ends2, lambda e: e <= F.col("_o"))))
    moved = moved.select("shard", "s", (lookup([g for _, g in short]) + F.col("_o") - lookup([a for a, _ in short])).alias("j"))
    return kept.unionByName(moved).select("shard", F.element_at(keys, F.col("s") + 1).alias("_sk"), F.col("j").alias("index"))


def mix(docs: DataFrame, carry: tuple[str, ...] = (), block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS):
    """(documents, filled).

    documents: a row for each document with doc_id, source, size, source_size, target, _sk and _start.
    filled: a row for each slot of the mix: shard, _sk, index, block and words (the words it takes from the block's head).
    """
    spark = docs.sparkSession
    sizes = saved(sized(docs, carry))
    table = saved(targets(sizes))
    at = saved(placed(sizes))
    packed = saved(blocks(at, table, block_words))
    quota = [(r["_sk"], r["n"]) for r in packed.groupBy("_sk").agg(F.count(F.lit(1)).alias("n")).orderBy("_sk").collect()]
    # merge joins: Spark takes an exploded table for as small as it was before, and would broadcast it
    filled = slots(spark, quota, shard_slots).hint("merge").join(packed, ["_sk", "index"])
    return at.join(F.broadcast(table.select("_sk", "source_size", "target")), "_sk"), filled


def pieces(documents: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row for each block that a document reaches into: adds block, first_word (of the document, from 0), n_words and
    at (where in the block they begin)."""
    lo, hi = F.floor(F.col("_start") / block_words), F.floor((F.col("_start") + F.col("size") - 1) / block_words)
    parts = documents.filter(F.col("size") > 0).withColumn("block", F.explode(F.sequence(lo, hi)))
    begin = F.greatest(F.col("_start"), F.col("block") * block_words)
    end = F.least(F.col("_start") + F.col("size"), (F.col("block") + 1) * block_words)
    return parts.withColumn("first_word", begin - F.col("_start")).withColumn("n_words", end - begin).withColumn("at", begin - F.col("block") * block_words)


def whole_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WHOLE_WORD), F.lit(0))


def joined(words: Column, skip: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, (skip + 1).cast("int"), n.cast("int")), "")


def mixed_parts(docs: DataFrame) -> DataFrame:
    """A row for each part of a document that a slot takes: `_doc` (the document without its text), `_size` (its words),
    `_first_word` and `_n_words` (the part's place in it), `_shard`, `_index` and `_text`.

    A part is an unchanged stretch of the text, from a word's start to the next part's: a document's parts, ordered by
    `_first_word`, are together its text.  A part that a source's last slot cuts short ends before its next word.
    """
    row = F.xxhash64(*[docs[c] for c, kind in docs.dtypes if not kind.startswith("map")])
    known = docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", "source", "text", row.alias("_row"))
    documents, filled = mix(known, carry=("_row",))
    # the text moves once to its place in the stream and once, cut in pieces, to its slots
    texts = known.dropDuplicates(["_row"]).select("_row", "_doc")
    placed_texts = texts.join(documents.select(F.col("_c__row").alias("_row"), "_sk", "_start", "size"), "_row")
    cut = pieces(placed_texts.withColumn("_w", whole_words(F.col("_doc")["text"])))  # taken apart once, before rows multiply
    cut = cut.select("_sk", "block", "at", "size", "first_word", "n_words", joined(F.col("_w"), F.col("first_word"), F.col("n_words")).alias("_p"),
                     F.struct(*[F.col("_doc")[c].alias(c) for c in docs.columns if c != "text"]).alias("_doc"))
    taken = cut.hint("merge").join(filled, ["_sk", "block"]).filter(F.col("at") < F.col("words"))
    n = F.least(F.col("n_words"), F.col("words") - F.col("at"))
    text = F.when(n == F.col("n_words"), F.col("_p")).otherwise(joined(whole_words(F.col("_p")), F.lit(0), n))
    return taken.select("_doc", F.col("size").alias("_size"), F.col("first_word").alias("_first_word"), n.alias("_n_words"),
                        F.col("shard").alias("_shard"), F.col("index").alias("_index"), text.alias("_text"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: a row for each part of a document that a slot takes, with its text and its length; other
    columns of documents stay.  The order of rows carries no meaning; `mixed_parts` also gives each part's place."""
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return mixed_parts(docs).select(*[(new[c] if c in new else F.col("_doc")[c]).alias(c) for c in docs.columns])


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken: words that the mix takes of each document, repeats counted."""
    documents, filled = mix(read(spark, sf_dir, "documents"))
    parts = pieces(documents.select("_sk", "_start", "size")).hint("merge").join(filled, ["_sk", "block"]).filter(F.col("at") < F.col("words"))
    # a document with words is known by its place in its source's stream
    taken = parts.groupBy("_sk", "_start").agg(F.sum(F.least(F.col("n_words"), F.col("words") - F.col("at"))).alias("_taken"))
    some = documents.filter(F.col("size") > 0).join(taken, ["_sk", "_start"], "left")
    none = documents.filter(F.col("size") == 0).withColumn("_taken", F.lit(0).cast("long"))
    return some.unionByName(none).select("doc_id", "size", "source_size", "target", F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"))
