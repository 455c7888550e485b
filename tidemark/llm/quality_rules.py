"""Quality rules: robust multivariate outliers, with DataFrame functions only.

Five statistics of a text are transformed and held against a minimum-covariance-determinant (MCD) estimate of
their centre and spread, one for each language and source; a document whose squared Mahalanobis distance exceeds
`CUT` goes.  MCD: from two starts (medians and quartile ranges; plain means and covariances) concentration steps
keep the `SHARE` of a group's rows that lie nearest and estimate again; the start that ends with the smaller
determinant counts.  Languages and sources with fewer than `MIN_ROWS` documents share an estimate with the other
such sources of their language, and languages too small even so share one.

Transformed statistics are whole numbers (1/1024), so that sums are exact and reruns agree.  Quantiles come
from counts of whole numbers (at most some ten thousand for each group), never from gathered rows.

Cases: null text counts as empty and fails the base rules; null languages and sources form groups like others;
repeated rows count as documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import read, saved, text_of, words_of

#: Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: The method's settings.
MIN_ROWS = 100
SHARE = 0.75
STEPS = 4
DIMS = 5
#: Consistency factor of MCD's covariance for a share of 0.75 in 5 dimensions
#: (0.75 over the chi-square distribution with 7 degrees at the 0.75 quantile of that with 5), and the
#: 0.999 quantile of chi-square with 5 degrees.
CONSISTENCY = 1.41
CUT = 20.515
#: Least standard deviations, in the units of `transformed`.  Lengths vary in every group, and theirs only prevent
#: singularity.  Symbols, duplicated lines and repeated words are 0 in most texts of nearly every group, where the robust
#: spread is 0: with smaller floors a single duplicated line would reject a text.
FLOORS = (0.05, 0.01, 0.05, 0.12, 0.12)
UNIT = 1024
X = [f"_x{i}" for i in range(DIMS)]
Z = [f"_z{i}" for i in range(DIMS)]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, _lines."""
    text = text_of(docs)
    d = docs.select(docs["doc_id"], docs["lang"], docs["source"], text.alias("_t"), words_of(text).alias("_w"))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    windows = F.when(F.size("_w") > WINDOW, F.transform(F.sequence(F.lit(1), F.size("_w") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_w", i, WINDOW))))
    d = d.select(
        "doc_id", "lang", "source", F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_l"), windows.alias("_h"))
    # texts whose windows all differ need no more
    twice = F.col("_h").isNotNull() & (F.size(F.array_distinct("_h")) < F.size("_h"))
    d = d.withColumn("_s", F.when(twice, F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("_s", lambda x, i: (F.get("_s", i - 1)["h"].eqNullSafe(x["h"])) | (F.get("_s", i + 1)["h"].eqNullSafe(x["h"])))
    at = F.array_sort(F.transform(again, lambda x: x["i"]))
    # each window adds its words beyond those of the window before it
    covered = F.aggregate(at, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
                          lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")), lambda a: a["n"])
    return d.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols",
                    (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                    F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), F.size("_l").cast("long").alias("_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def transformed() -> list[Column]:
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return [
        F.log1p("n_words"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "_lines"),
        share("n_repeat_words", "n_words"),
    ]


def grouped(stats: DataFrame) -> DataFrame:
    """Adds `_g`, the group whose estimate holds for a row."""
    n = stats.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_n"))
    small = F.col("_n") < MIN_ROWS
    n = n.withColumn("_m", F.sum(F.when(small, F.col("_n"))).over(Window.partitionBy("lang")))
    name = F.when(~small, F.to_json(F.struct("lang", "source"))).when(F.col("_m") >= MIN_ROWS, F.to_json(F.struct("lang"))).otherwise("")
    n = n.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), name.alias("_g"))
    same = stats["lang"].eqNullSafe(n["_lang"]) & stats["source"].eqNullSafe(n["_source"])
    return stats.join(n, same).drop("_lang", "_source")


def estimate(rows: DataFrame) -> DataFrame:
    """_g, _start -> mean and lower Cholesky factor of the rows in groups, by exact sums of whole numbers."""
    pairs = [(i, j) for i in range(DIMS) for j in range(i + 1)]
    sums = rows.groupBy("_g", "_start").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(x).alias(f"_s{x}") for x in X],
                                            *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"_p{i}{j}") for i, j in pairs])
    mean = {i: F.col(f"_s{X[i]}") / F.col("_n") for i in range(DIMS)}
    cov = {}
    for i, j in pairs:
        c = (F.col(f"_p{i}{j}") / F.col("_n") - mean[i] * mean[j]) / UNIT**2 * CONSISTENCY
        cov[i, j] = F.greatest(c, F.lit(0.0)) + FLOORS[i] ** 2 if i == j else c
    return factored(sums.select("_g", "_start", *[(mean[i] / UNIT).alias(f"_m{i}") for i in range(DIMS)], *[cov[p].alias(f"_c{p[0]}{p[1]}") for p in pairs]))


def factored(params: DataFrame) -> DataFrame:
    """Covariances `_c<i><j>` to the Cholesky factor `_l<i><j>` and the determinant's logarithm."""
    for i in range(DIMS):
        for j in range(i + 1):
            rest = F.col(f"_c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
            params = params.withColumn(f"_l{i}{j}", F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 / 4))) if i == j else rest / F.col(f"_l{j}{j}"))
    det = sum((F.log(f"_l{i}{i}") for i in range(DIMS)), F.lit(0.0))
    return params.withColumn("_det", det).drop(*[f"_c{i}{j}" for i in range(DIMS) for j in range(i + 1)])


def robust_start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges by counts of the (whole) values, as a diagonal estimate."""
    dims = F.array(*[F.struct(F.lit(i).alias("d"), F.col(x).alias("v")) for i, x in enumerate(X)])
    counts = rows.select("_g", F.explode(dims).alias("e")).groupBy("_g", "e").agg(F.count(F.lit(1)).alias("_n"))
    by = Window.partitionBy("_g", "e.d")
    counts = counts.withColumn("_u", F.sum("_n").over(by.orderBy("e.v")) / F.sum("_n").over(by))
    at = lambda q: F.min(F.when(F.col("_u") >= q, F.col("e.v"))) / UNIT
    quarts = counts.groupBy("_g", "e.d").agg(at(0.25).alias("a"), at(0.5).alias("m"), at(0.75).alias("b"))
    wide = quarts.groupBy("_g").agg(*[F.max(F.when(F.col("d") == i, F.col(c))).alias(f"{c}{i}") for i in range(DIMS) for c in "amb"])
    zero = [F.lit(0.0).alias(f"_c{i}{j}") for i in range(DIMS) for j in range(i)]
    spread = [(((F.col(f"b{i}") - F.col(f"a{i}")) / 1.349) ** 2 + FLOORS[i] ** 2).alias(f"_c{i}{i}") for i in range(DIMS)]
    return factored(wide.select("_g", F.lit(1).alias("_start"), *[F.col(f"m{i}").alias(f"_m{i}") for i in range(DIMS)], *zero, *spread))


def distances(rows: DataFrame, params: DataFrame, keys: list[str]) -> DataFrame:
    """Adds `_d2`, the squared Mahalanobis distance."""
    d = rows.join(params, keys)
    for i in range(DIMS):
        rest = F.col(X[i]) / UNIT - F.col(f"_m{i}")
        for j in range(i):
            rest = rest - F.col(f"_l{i}{j}") * F.col(Z[j])
        d = d.withColumn(Z[i], rest / F.col(f"_l{i}{i}"))
    d = d.withColumn("_d2", sum((F.col(z) * F.col(z) for z in Z), F.lit(0.0)))
    return d.drop(*[c for c in params.columns if c not in keys], *Z)


def mcd(rows: DataFrame) -> DataFrame:
    """The estimate for each `_g`: rows has `_g` and the whole numbers `_x0`..`_x4`."""
    both = rows.select("_g", *X).withColumn("_start", F.explode(F.array(F.lit(0), F.lit(1))))
    params = saved(estimate(rows.withColumn("_start", F.lit(0))).unionByName(robust_start(rows)))
    for _ in range(STEPS):
        near = distances(both, params, ["_g", "_start"]).withColumn("_bin", F.floor(F.log1p("_d2") * 256))
        counts = near.groupBy("_g", "_start", "_bin").agg(F.count(F.lit(1)).alias("_n"))
        by = Window.partitionBy("_g", "_start")
        counts = counts.withColumn("_u", F.sum("_n").over(by.orderBy("_bin"))).withColumn("_all", F.sum("_n").over(by))
        edge = counts.filter(F.col("_u") >= F.ceil(F.col("_all") * SHARE)).groupBy("_g", "_start").agg(F.min("_bin").alias("_edge"))
        params = saved(estimate(near.join(edge, ["_g", "_start"]).filter(F.col("_bin") <= F.col("_edge"))))
    best = params.groupBy("_g").agg(F.min(F.struct("_det", "_start"))["_start"].alias("_start"))
    return params.join(best, ["_g", "_start"]).drop("_start", "_det")


def judged(docs: DataFrame) -> DataFrame:
    """A row for each document: doc_id, lang, source, the statistics, base_failed, distance (null where base rules
    failed already) and kept."""
    stats = statistics(docs).withColumn("base_failed", base_failed())
    stats = stats.select("*", *[F.round(x * UNIT).cast("long").alias(c) for x, c in zip(transformed(), X)])
    stats = saved(stats)
    passed = saved(grouped(stats.filter(~F.col("base_failed"))))
    found = distances(passed, mcd(passed), ["_g"]).drop("_g")
    rest = stats.filter("base_failed").withColumn("_d2", F.lit(None).cast("double"))
    out = found.unionByName(rest).withColumn("kept", F.coalesce(F.col("_d2") <= CUT, F.lit(False)))
    return out.withColumnRenamed("_d2", "distance").drop(*X, "_lines")


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance."""
    return judged(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
