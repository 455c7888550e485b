"""Feature preparation: profiles, imputation, scaling, bucketing, encoding.

Statistics are computed once with a global aggregate (partial aggregation per
partition) and applied with literal columns, so fitting never needs a join
and applying never shuffles.  Fit on training rows, apply to any rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordered import dense_index
from tidemark.plans.quantile import quantile_cont


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n_null) for every column, one pass."""
    agg = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in df.columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return agg.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column, n_null)")


def fit_impute(df: DataFrame, col: str, strategy: str) -> float | None:
    """Mean, exact median (interpolated) or mode (most frequent, ties to
    the smallest value) of the non-null values."""
    if strategy == "mean":
        return df.agg(F.avg(col)).first()[0]
    if strategy == "median":
        return quantile_cont(df, col, 0.5)
    if strategy == "mode":
        top = (
            df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("c"))
            .orderBy(F.col("c").desc(), F.col(col)).limit(1).collect()
        )
        return top[0][col] if top else None
    raise ValueError(strategy)


def impute(df: DataFrame, col: str, value) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))


def fit_scaler(df: DataFrame, cols: list[str]) -> dict:
    """Min, max, mean, population and sample std per column (one agg)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_pop(c).alias(f"{c}__std_pop"), F.stddev_samp(c).alias(f"{c}__std")]
    row = df.agg(*aggs).first().asDict()
    return {c: {k: row[f"{c}__{k}"] for k in ("min", "max", "mean", "std_pop", "std")} for c in cols}


def minmax(df: DataFrame, stats: dict, suffix: str = "") -> DataFrame:
    """(x - min) / (max - min) with fitted statistics; a constant column
    maps to 0 (not 0.5)."""
    out = df
    for c, s in stats.items():
        rng = (s["max"] or 0.0) - (s["min"] or 0.0)
        val = (F.col(c) - F.lit(s["min"])) / F.lit(rng) if rng != 0 else F.lit(0.0)
        out = out.withColumn(c + suffix, val.cast("double"))
    return out


def standardize(df: DataFrame, stats: dict, suffix: str = "", std: str = "std") -> DataFrame:
    """(x - mean) / std (sample std by default); zero std gives 0."""
    out = df
    for c, s in stats.items():
        sd = s[std] or 0.0
        val = (F.col(c) - F.lit(s["mean"])) / F.lit(sd) if sd != 0 else F.lit(0.0)
        out = out.withColumn(c + suffix, val.cast("double"))
    return out


def decade(year: F.Column) -> F.Column:
    """floor(year / 10) * 10 as a string."""
    return (F.floor(year / 10) * 10).cast("bigint").cast("string")


def bucketize(x: F.Column, splits: list[float]) -> F.Column:
    """index i of the interval [splits[i], splits[i+1]) (last closed);
    values outside the splits give null."""
    expr = None
    for i in range(len(splits) - 1):
        lo, hi = splits[i], splits[i + 1]
        cond = (x >= lo) & ((x < hi) if i < len(splits) - 2 else (x <= hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def cross(*cols: F.Column) -> F.Column:
    """feature cross as 'a_b'."""
    return F.concat_ws("_", *[c.cast("string") for c in cols])


def explode_vector(df: DataFrame, col: str, n: int, prefix: str) -> DataFrame:
    """array column to n scalar columns."""
    return df.select("*", *[F.col(col).getItem(i).alias(f"{prefix}{i}") for i in range(n)]).drop(col)


def one_hot(df: DataFrame, col: str, categories: list) -> DataFrame:
    """one 0/1 column per category (dropLast=False)."""
    return df.select("*", *[(F.col(col) == F.lit(v)).cast("int").alias(f"{col}_{v}") for v in categories])


def categories(df: DataFrame, col: str, limit: int = 10_000) -> list:
    """Sorted distinct values of a categorical column (bounded alphabet)."""
    vals = df.select(col).distinct().orderBy(col).limit(limit + 1).collect()
    if len(vals) > limit:
        raise ValueError(f"{col} has more than {limit} categories; hash it instead")
    return [r[0] for r in vals]


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson r with strength bands (|r| >= 0.8 very strong, >= 0.6
    strong, >= 0.4 moderate, >= 0.2 weak, else very weak)."""
    r = df.agg(F.corr(a, b).alias("r"))
    ar = F.abs(F.col("r"))
    band = (F.when(ar >= 0.8, "very strong").when(ar >= 0.6, "strong").when(ar >= 0.4, "moderate")
            .when(ar >= 0.2, "weak").otherwise("very weak"))
    return r.withColumn("band", band)


def covariance(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sample covariance matrix in long form (i, j, cov), one pass."""
    aggs = [F.covar_samp(a, b).alias(f"{a}__{b}") for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*aggs)
    pairs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            pairs.append(f"'{a}', '{b}', `{a}__{b}`")
            if a != b:
                pairs.append(f"'{b}', '{a}', `{a}__{b}`")
    return row.selectExpr(f"stack({len(pairs)}, {', '.join(pairs)}) AS (i, j, cov)")


def threshold_sweep(scored: DataFrame, prob: str, label: str, thresholds: list[float]) -> DataFrame:
    """Predictions `prob >= t` for each t and the confusion counts,
    precision and recall; thresholds are a literal array per row."""
    t = scored.select(F.col(prob).alias("p"), F.col(label).alias("y"),
                      F.explode(F.array(*[F.lit(float(x)) for x in thresholds])).alias("threshold"))
    pred = (F.col("p") >= F.col("threshold")).cast("int")
    g = t.groupBy("threshold").agg(
        F.sum(((pred == 1) & (F.col("y") == 1)).cast("bigint")).alias("tp"),
        F.sum(((pred == 1) & (F.col("y") == 0)).cast("bigint")).alias("fp"),
        F.sum(((pred == 0) & (F.col("y") == 0)).cast("bigint")).alias("tn"),
        F.sum(((pred == 0) & (F.col("y") == 1)).cast("bigint")).alias("fn"),
    )
    return g.withColumn("precision", F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn(
        "recall", F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    )


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, count, mean, stddev, min, max) for numeric columns."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__sd"),
                 F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    row = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', `{c}__n`, `{c}__mean`, `{c}__sd`, `{c}__min`, `{c}__max`" for c in cols)
    return row.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, count, mean, stddev, min, max)")


def item_features(items: DataFrame, scalars: list[str], year: str, vectors: DataFrame, key: str = "item_id") -> DataFrame:
    """M6: (key, decade, features): min-max scaled scalars (nulls count as 0
    before scaling) followed by the components of the item's vector; an item
    without a vector has the scalars only.  vectors: (key, vec)."""
    filled = items.na.fill(0, scalars)
    scaled = minmax(filled.withColumn("decade", decade(F.col(year))), fit_scaler(filled, scalars))
    both = scaled.join(vectors.select(key, "vec"), key, "left")
    head = F.array(*[F.col(c).cast("double") for c in scalars])
    tail = F.coalesce(F.transform("vec", lambda x: x.cast("double")), F.array().cast("array<double>"))
    return both.select(key, "decade", F.concat(head, tail).alias("features"))


def label_ids(df: DataFrame, label: str, out: str = "label_id") -> DataFrame:
    """The id of each row's label, 0..n-1 in label order; rows without a
    label get none."""
    ids = dense_index(df.filter(F.col(label).isNotNull()), label, out)
    return df.join(ids, label, "left")
