"""Decision-split statistics and counting classifiers as table operators.

All statistics start from grouped counts (partial aggregation), then work on
the small count tables: (attribute, value, label) for classification and
(bin) or (distinct x) for regression splits.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import fround
from tidemark.plans.ordered import join_on


def unpivot(df: DataFrame, attrs: list[str], label: str, keep: list[str] | None = None) -> DataFrame:
    """(*keep, attr, value, label) rows with values cast to string (`stack`)."""
    pairs = ", ".join(f"'{a}', CAST(`{a}` AS STRING)" for a in attrs)
    return df.selectExpr(*[f"`{k}`" for k in (keep or [])],
                         f"stack({len(attrs)}, {pairs}) AS (attr, value)", f"`{label}` AS label")


def _plogp(p: F.Column) -> F.Column:
    return F.when(p > 0, -p * F.log2(p)).otherwise(F.lit(0.0))


def entropy(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """-sum p log2 p of `label` within groups `by` (whole table if None)."""
    by = by or []
    c = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    c = c.withColumn("n", F.sum("c").over(w))  # rows per group = label values
    return c.groupBy(*by).agg(F.sum(_plogp(F.col("c") / F.col("n"))).alias("entropy"), F.max("n").alias("n"))


def split_table(df: DataFrame, attrs: list[str], label: str) -> DataFrame:
    """(attr, value, label, c) counts - the only pass over the data."""
    return unpivot(df, attrs, label).groupBy("attr", "value", "label").agg(F.count(F.lit(1)).alias("c"))


def info_gain(counts: DataFrame) -> DataFrame:
    """Per attribute gain = Ent(D) - sum share*Ent(D_v), intrinsic
    value IV = -sum share log2 share, gain ratio, and the C4.5 choice: best
    ratio among attributes whose gain is at least the average gain."""
    by_val = counts.groupBy("attr", "value").agg(F.sum("c").alias("nv"))
    ent_v = (
        counts.join(by_val, ["attr", "value"])
        .groupBy("attr", "value")
        .agg(F.sum(_plogp(F.col("c") / F.col("nv"))).alias("ent_v"), F.max("nv").alias("nv"))
    )
    by_lab = counts.groupBy("attr", "label").agg(F.sum("c").alias("nl"))
    tot = by_lab.groupBy("attr").agg(F.sum("nl").alias("n"))
    ent_d = by_lab.join(tot, "attr").groupBy("attr").agg(
        F.sum(_plogp(F.col("nl") / F.col("n"))).alias("ent_d"), F.max("n").alias("n")
    )
    g = ent_v.join(ent_d, "attr").groupBy("attr").agg(
        F.max("ent_d").alias("ent_d"),
        F.sum(F.col("nv") / F.col("n") * F.col("ent_v")).alias("cond"),
        F.sum(_plogp(F.col("nv") / F.col("n"))).alias("iv"),
    )
    g = g.select(
        "attr",
        (F.col("ent_d") - F.col("cond")).alias("gain"),
        "iv",
        F.when(F.col("iv") > 0, (F.col("ent_d") - F.col("cond")) / F.col("iv")).alias("gain_ratio"),
    )
    # one row per attribute: the global windows below run on that tiny table
    allw = Window.partitionBy(F.lit(0))
    g = g.withColumn("_avg", F.avg("gain").over(allw))
    elig = F.col("gain") >= F.col("_avg") - F.lit(1e-12)
    best = F.max(F.when(elig, F.col("gain_ratio"))).over(allw)
    first = F.min(F.when(elig & (F.col("gain_ratio") == best), F.col("attr"))).over(allw)
    return g.withColumn("chosen", F.col("attr") == first).drop("_avg")


def gini_splits(counts: DataFrame) -> DataFrame:
    """One-vs-rest split on each (attr, value): weighted Gini of the
    value side and the rest; `best` marks the minimum per attribute (ties:
    smallest value)."""
    by_val = counts.groupBy("attr", "value").agg(F.sum("c").alias("nv"))
    by_lab = counts.groupBy("attr", "label").agg(F.sum("c").alias("nl"))
    n = by_lab.groupBy("attr").agg(F.sum("nl").alias("n"))
    x = counts.join(by_val, ["attr", "value"]).join(by_lab, ["attr", "label"]).join(n, "attr")
    x = x.select(
        "attr", "value", "nv", "n",
        (F.col("c") / F.col("nv")).alias("p_in"),
        F.when(F.col("n") > F.col("nv"), (F.col("nl") - F.col("c")) / (F.col("n") - F.col("nv"))).alias("p_out"),
    )
    # labels absent inside a value still count on the rest side
    g = x.groupBy("attr", "value").agg(
        F.max("nv").alias("nv"), F.max("n").alias("n"),
        (1 - F.sum(F.col("p_in") * F.col("p_in"))).alias("gini_in"),
    )
    rest = (
        by_lab.join(n, "attr").join(by_val, "attr")
        .join(counts.select("attr", "value", "label", "c"), ["attr", "value", "label"], "left")
        .select("attr", "value", "nv", "n",
                F.when(F.col("n") > F.col("nv"),
                       (F.col("nl") - F.coalesce(F.col("c"), F.lit(0))) / (F.col("n") - F.col("nv"))).alias("q"))
        .groupBy("attr", "value").agg(F.when(F.count("q") > 0, 1 - F.sum(F.col("q") * F.col("q"))).alias("gini_out"))
    )
    s = g.join(rest, ["attr", "value"]).select(
        "attr", "value",
        (F.col("nv") / F.col("n") * F.col("gini_in")
         + (F.col("n") - F.col("nv")) / F.col("n") * F.coalesce(F.col("gini_out"), F.lit(0.0))).alias("gini_split"),
    )
    w = Window.partitionBy("attr").orderBy(fround("gini_split", 9), F.col("value"))
    return s.withColumn("best", F.row_number().over(w) == 1)


def best_sse_split(df: DataFrame, x: str, y: str) -> DataFrame:
    """For every distinct x threshold t (left: x <= t): SSE(left) +
    SSE(right) from prefix sums of n, sum y, sum y^2 over the distinct-x table."""
    g = df.groupBy(F.col(x).alias("t")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(F.col(y) * F.col(y)).alias("syy")
    )
    # one row per distinct x value (bounded by the feature's cardinality)
    pre = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    allw = Window.partitionBy(F.lit(0))
    g = g.select(
        "t",
        F.sum("n").over(pre).alias("nl"), F.sum("sy").over(pre).alias("syl"), F.sum("syy").over(pre).alias("syyl"),
        F.sum("n").over(allw).alias("N"), F.sum("sy").over(allw).alias("SY"), F.sum("syy").over(allw).alias("SYY"),
    )
    nr, syr, syyr = F.col("N") - F.col("nl"), F.col("SY") - F.col("syl"), F.col("SYY") - F.col("syyl")
    sse_l = F.col("syyl") - F.col("syl") * F.col("syl") / F.col("nl")
    sse_r = F.when(nr > 0, syyr - syr * syr / nr).otherwise(F.lit(0.0))
    return g.select("t", "nl", (sse_l + sse_r).alias("sse")).filter(F.col("nl") < F.col("N"))


def hist_split(df: DataFrame, x: str, grad: str, hess: str, bins: int, lam: float = 1.0, gamma: float = 0.0) -> DataFrame:
    """Equal-width bins of x; per bin sums of gradient, hessian and
    count; prefix (left) sums; right = parent - left (sibling subtraction);
    gain = 1/2 (GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)) - gamma."""
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(x) - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    h = df.groupBy(b.alias("bin")).agg(
        F.sum(grad).alias("g"), F.sum(hess).alias("h"), F.count(F.lit(1)).alias("n")
    )
    pre = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # <= bins rows
    allw = Window.partitionBy(F.lit(0))
    h = h.select(
        "bin", "n",
        F.sum("g").over(pre).alias("GL"), F.sum("h").over(pre).alias("HL"),
        F.sum("g").over(allw).alias("G"), F.sum("h").over(allw).alias("H"),
    )
    GR, HR = F.col("G") - F.col("GL"), F.col("H") - F.col("HL")
    gain = 0.5 * (F.col("GL") ** 2 / (F.col("HL") + lam) + GR ** 2 / (HR + lam) - F.col("G") ** 2 / (F.col("H") + lam)) - gamma
    return h.select("bin", "n", "GL", "HL", GR.alias("GR"), HR.alias("HR"), gain.alias("gain"))


def naive_bayes_counts(counts: DataFrame, alpha: float = 1.0) -> DataFrame:
    """Class prior and per-attribute likelihood with add-alpha smoothing:
    P(v | c) = (c_vc + alpha) / (n_c + alpha * |V_attr|)."""
    n_c = counts.groupBy("attr", "label").agg(F.sum("c").alias("n_c"))
    k = counts.groupBy("attr").agg(F.countDistinct("value").alias("k"))
    return counts.join(n_c, ["attr", "label"]).join(k, "attr").select(
        "attr", "value", "label", "c",
        ((F.col("c") + alpha) / (F.col("n_c") + alpha * F.col("k"))).alias("likelihood"),
    )


def naive_bayes_predict(df: DataFrame, key: list[str], attrs: list[str], label: str, counts: DataFrame,
                        alpha: float = 1.0) -> DataFrame:
    """Score every row: log prior + sum log likelihood per class; the
    prediction is the arg-max (ties: smallest label).  Unseen (attr, value,
    class) cells get the smoothed zero-count likelihood.

    Log likelihoods are looked up once for each distinct combination of the
    attributes, one column per class, and joined to the rows, which are
    shuffled once, by their key; rows that share a key are scored together.
    The counts are read several times."""
    lik = naive_bayes_counts(counts, alpha)
    n_c = counts.filter(F.col("attr") == attrs[0]).groupBy("label").agg(F.sum("c").alias("n_c")).collect()  # label alphabet (small)
    n = float(sum(r["n_c"] for r in n_c))
    prior = sorted((r["label"], math.log(r["n_c"] / n)) for r in n_c if r["label"] is not None)
    k = counts.groupBy("attr").agg(F.countDistinct("value").alias("k"))
    rows = df.select(*key, *attrs, F.col(label).alias("label")).dropna(subset=key)
    if not prior:
        return rows.select(*key, F.col("label").alias("prediction"), F.lit(None).cast("double").alias("score"), "label").limit(0)
    kinds = rows.select(*attrs).distinct()
    # each combination against each class: the class alphabet is a literal array
    cand = unpivot(kinds, attrs, attrs[0], keep=attrs).drop("label").withColumn("cls", F.explode(F.array(*[F.lit(c) for c, _ in prior])))
    scored = (
        cand.join(lik.select("attr", "value", F.col("label").alias("cls"), "likelihood"), ["attr", "value", "cls"], "left")
        .join(counts.groupBy("attr", F.col("label").alias("cls")).agg(F.sum("c").alias("n_ac")), ["attr", "cls"])
        .join(k, "attr")
        .select(*attrs, "cls",
                F.log(F.coalesce(F.col("likelihood"), F.lit(alpha) / (F.col("n_ac") + alpha * F.col("k")))).alias("ll"))
    )
    lls = [f"_ll{i}" for i in range(len(prior))]
    wide = scored.groupBy(*attrs).agg(*[F.sum(F.when(F.col("cls") == c, F.col("ll"))).alias(x) for x, (c, _) in zip(lls, prior)])
    rows = join_on(rows, wide, attrs).select(*key, "label", *lls)
    w = Window.partitionBy(*key)
    totals = [F.sum(x).over(w) + F.lit(lp) for x, (_, lp) in zip(lls, prior)]
    best = F.array_min(F.array(*[F.struct((-fround(t, 9)).alias("r"), F.lit(c).alias("cls"), t.alias("score")) for t, (c, _) in zip(totals, prior)]))
    return rows.select(*key, "label", best.alias("_b")).select(
        *key, F.col("_b.cls").alias("prediction"), F.col("_b.score").alias("score"), "label")


def cpt(df: DataFrame, child: str, parents: list[str]) -> DataFrame:
    """P(child | parents) = count(parents, child) / count(parents)."""
    c = df.groupBy(*parents, child).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*parents)  # rows per parent config = child values
    return c.withColumn("prob", F.col("count") / F.sum("count").over(w))
