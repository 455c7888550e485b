"""Grouping of spelling variants by asymmetric q-chunks.

Words are runs of letters of whole texts; one occurrence in 31 loses a letter, chosen by a hash, as a stand-in for
misspellings.  Two words are near if one inserted, deleted or replaced code point parts them.

Near pairs: the shorter word (either one, at equal lengths) contributes its two halves as disjoint chunks, the other
its positional grams.  One edit leaves a chunk whole: the first where it stands, the second where it stands or, if the
edit inserts a code point before it, one place further.  Only grams as long as a chunk that start there can meet it, so
only those are written.  The half with the edit is cut once more by the same rule, one of its two parts being whole
too; a key is a chunk together with such a part, its length and places.  Words that share a key thus agree in about three
quarters of their letters, and each pair is verified by its exact distance.

A word's form is its near word of most occurrences, if it occurs ten times as often; the root follows forms to the
last.  Occurrences grow tenfold with each step, so the pointer jumping ends after a few rounds.

All joins are sort-merge joins by a hint: both sides grow with the texts, but Spark sizes a compressed table by its file
and keeps that size through an explode, so it would broadcast keys that are many times larger.

Cases: null texts have no words; a null id counts as an empty one; repeated rows count as often as they come; ties of
forms go to the smallest word in code-point order; an empty table gives no rows; other columns are ignored; a word may
be as long as a text, since keys are hashes and a word's rows are twelve.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import read, saved, stored, text_of

LEAST = 7
LETTERS = "[A-Za-zÀ-ÿ]"
OFTEN = 2
#: One occurrence in so many loses a letter.
SLIP = 31
#: A form occurs at least so many times as often as its variant.
RATIO = 10


def occurrences(docs: DataFrame) -> DataFrame:
    """word: one row for each occurrence, letters lost by slips left out."""
    runs = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("_d"),
                       F.explode(F.regexp_extract_all(text_of(docs), F.lit(f"{LETTERS}{{{LEAST},}}"), F.lit(0))).alias("run"))
    runs = runs.select("_d", F.translate("run", ascii_uppercase, ascii_lowercase).alias("run"))
    runs = runs.withColumn("_h", F.crc32(F.concat("_d", F.lit(":"), "run").cast("binary")))
    at = (F.col("_h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(F.col("_h") % SLIP == 0, slipped).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= LEAST)


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of the words that occur often enough."""
    return occurrences(docs).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= OFTEN)


def _keys(word: Column, length: Column, longer: bool) -> Column:
    """The four keys under which a word meets words of `length`: as one of them, or as one code point longer."""
    one = int(longer)
    half = F.floor(length / 2).cast("int")
    first, second = F.floor(half / 2).cast("int"), F.floor((length - half) / 2).cast("int")

    def part(begin: Column, end: Column, shift: int) -> Column:
        return F.substring(word, begin + shift + 1, end - begin)

    zero = F.lit(0)
    a, b = part(zero, half, 0), part(half, length, one)
    pairs = [(a, part(half, half + second, 0)), (a, part(half + second, length, one)),
             (b, part(zero, first, 0)), (b, part(first, half, one))]
    return F.array(*[F.xxhash64(length, F.lit(i), x, y) for i, (x, y) in enumerate(pairs)])


def near_pairs(words: DataFrame) -> DataFrame:
    """a, an, b, bn: each two near words with their counts once.  words: word, n; distinct."""
    length = F.length("word")
    chunks = words.select(F.col("word").alias("a"), F.col("n").alias("an"), F.explode(_keys(F.col("word"), length, False)).alias("key"))
    as_long = chunks.select(F.col("a").alias("b"), F.col("an").alias("bn"), "key", F.lit(False).alias("longer"))
    longer = words.select(F.col("word").alias("b"), F.col("n").alias("bn"), F.explode(_keys(F.col("word"), length - 1, True)).alias("key"), F.lit(True).alias("longer"))
    met = chunks.join(as_long.unionByName(longer).hint("merge"), "key").filter(F.col("longer") | (F.col("a") < F.col("b")))
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "an", "b", "bn").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that forms lead to.  forms: word, form."""
    now = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        told = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = saved(now.join(told.hint("merge"), "root", "left"))
        now = step.select("word", F.coalesce("next", "root").alias("root"))
        if step.filter(F.col("next").isNotNull()).isEmpty():
            return now


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    words = stored(vocabulary(docs))
    pairs = stored(near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("bn").alias("m"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("an").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    is_form = -F.col("best.m") >= RATIO * F.col("n")
    known = stored(words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.other")).alias("form"),
        F.when(is_form, -F.col("best.m")).alias("form_n")))
    ends = roots(known.filter(F.col("form").isNotNull()).select("word", "form"))
    return known.join(ends.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    return variants(read(spark, sf_dir, "documents"))


def crc_ctes() -> str:
    """DuckDB has no crc32: `crc` holds the table of the 256 remainders in the list `t`."""
    steps = ["c0 AS (SELECT i, i::BIGINT AS c FROM range(256) r(i))"]
    steps += [f"c{k + 1} AS (SELECT i, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) AS c FROM c{k})" for k in range(8)]
    return ",\n".join([*steps, "crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM c8)"])


def crc_sql(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes, beside `crc`."""
    data = f"list_transform(range(1, length(hex({text})), 2), lambda i: ('0x' || substr(hex({text}), i, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])))"


OP12_SQL = f"""WITH RECURSIVE {crc_ctes()},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d,
         translate(unnest(regexp_extract_all(text, '{LETTERS}{{{LEAST},}}')), '{ascii_uppercase}', '{ascii_lowercase}') AS run
  FROM documents),
hashed AS (SELECT run, count(*) AS c, {crc_sql("d || ':' || run")} AS h FROM runs, crc GROUP BY d, run, t),
cut AS (
  SELECT c, CASE WHEN h % {SLIP} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
  FROM hashed),
words AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM cut WHERE length(word) >= {LEAST} GROUP BY word HAVING sum(c) >= {OFTEN}),
less AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(m) AS m, (list(other ORDER BY m DESC, other))[1] AS other FROM near GROUP BY word),
known AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {RATIO} * n THEN other END AS form, CASE WHEN m >= {RATIO} * n THEN m END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
follow(word, root) AS (
  SELECT word, word FROM known
  UNION ALL SELECT f.word, k.form FROM follow f JOIN known k ON k.word = f.root WHERE k.form IS NOT NULL)
SELECT k.word, k.form, f.root, k.n, k.n_near, k.form_n
FROM known k JOIN follow f ON f.word = k.word JOIN known e ON e.word = f.root AND e.form IS NULL"""
