"""Random forests whose bootstrap is known: out-of-bag error, proximities as sums over leaves, rules as rows.

Each tree is fitted on Poisson(1) weights that come from a hash of the row's key and the tree's number, so which tree
saw which row can be told afterwards.  Proximity of two rows is the share of trees in which they fall into the same
leaf; weighted means and votes over proximities are sums over (tree, leaf), never over pairs of rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import md5_mod
from tidemark.plans.scale import written

_UNITS = 1_000_000


def _uniform(key: str, tree: int, seed: int) -> Column:
    """A hash of row and tree in [0, 1)."""
    return md5_mod(F.concat_ws(":", F.lit(str(seed)), F.lit(str(tree)), F.col(key).cast("string")), _UNITS) / F.lit(float(_UNITS))


def _times(u: Column) -> Column:
    """Poisson(1) by inversion."""
    below, term, out = 0.0, 0.36787944117144233, F.lit(9)
    steps = []
    for k in range(9):
        below += term
        term /= k + 1
        steps.append((below, k))
    for bound, k in reversed(steps):
        out = F.when(u < bound, F.lit(k)).otherwise(out)
    return out


def poisson_weight(key: str, tree: int, seed: int = 7) -> Column:
    """How often tree number `tree` draws the row: Poisson(1) by inversion of a hash in [0, 1)."""
    return _times(_uniform(key, tree, seed))


def with_draws(rows: DataFrame, key: str, trees: int, seed: int = 7) -> DataFrame:
    """rows and _w0, _w1, ...: how often each tree draws the row, hashed once and written.

    A fit reads its rows several times; the hashes would be taken again each time, and for each step of the inversion.
    """
    hashed = rows.select("*", *[_uniform(key, t, seed).alias(f"_u{t}") for t in range(trees)])
    return written(hashed.select(*rows.columns, *[_times(F.col(f"_u{t}")).cast("tinyint").alias(f"_w{t}") for t in range(trees)]))


class Forest:
    """Trees of one weight column each; `rows` has key, features and y, and the draws if they are known."""

    def __init__(self, rows: DataFrame, key: str, trees: int = 15, depth: int = 5, seed: int = 1, subset: str = "sqrt"):
        self.key, self.trees, self.rows = key, [], rows
        self.drawn = rows if "_w0" in rows.columns else with_draws(rows, key, trees)
        for t in range(trees):
            drawn = self.drawn.select("y", "features", F.col(f"_w{t}").cast("double").alias("_w")).filter("_w > 0")
            one = RandomForestClassifier(labelCol="y", weightCol="_w", numTrees=1, bootstrap=False, maxDepth=depth, seed=seed + t,
                                         featureSubsetStrategy=subset, leafCol="_leaf", predictionCol="_p")
            self.trees.append(one.fit(drawn))

    def passed(self, rows: DataFrame, *keep: str) -> DataFrame:
        """keep, tree, leaf, p (the tree's class): one row for each row and tree."""
        out = rows
        for t, model in enumerate(self.trees):
            out = model.transform(out).withColumn(f"_t{t}", F.struct(F.lit(t).alias("tree"), vector_to_array("_leaf")[0].cast("int").alias("leaf"), F.col("_p").alias("p")))
            out = out.drop("_leaf", "_p", "rawPrediction", "probability")
        long = out.select(*keep, F.explode(F.array(*[f"_t{t}" for t in range(len(self.trees))])).alias("_x"))
        return long.select(*keep, "_x.tree", "_x.leaf", "_x.p")


def assembled(df: DataFrame, cols: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df)


def out_of_bag(forest: Forest, rows: DataFrame) -> DataFrame:
    """Key, y, trees (that did not draw the row), vote (their majority, the smallest class of a tie).

    A row that all trees drew has no vote.  The out-of-bag error is the share of votes that differ from y.
    """
    drawn = forest.drawn if rows is forest.rows else with_draws(rows, forest.key, len(forest.trees))
    times = F.array(*[F.col(f"_w{t}") for t in range(len(forest.trees))])
    passed = forest.passed(drawn.withColumn("_times", times), forest.key, "y", "_times")
    votes = passed.filter(F.get("_times", F.col("tree")) == 0).groupBy(forest.key, "y", "p").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy(forest.key, "y").agg(F.sum("n").alias("trees"), F.min(F.struct((-F.col("n")).alias("n"), "p")).alias("best"))
    won = best.select(forest.key, "y", "trees", F.col("best.p").alias("vote"))
    return rows.select(forest.key, "y").join(won, [forest.key, "y"], "left")


def near_values(leaves: DataFrame, key: str, value: str, numeric: bool) -> DataFrame:
    """key, est of the rows without a value: the mean (or the most frequent value, the smallest of a tie) of the rows
    that have one, weighted by proximity.  leaves: key, value, tree, leaf, one row for each row and tree."""
    have, lack = leaves.filter(F.col(value).isNotNull()), leaves.filter(F.col(value).isNull()).select(key, "tree", "leaf")
    if numeric:
        sums = have.groupBy("tree", "leaf").agg(F.sum(value).alias("s"), F.count(F.lit(1)).alias("n"))
        return lack.join(sums, ["tree", "leaf"]).groupBy(key).agg((F.sum("s") / F.sum("n")).alias("est"))
    sums = have.groupBy("tree", "leaf", value).agg(F.count(F.lit(1)).alias("n"))
    votes = lack.join(sums, ["tree", "leaf"]).groupBy(key, value).agg(F.sum("n").alias("n"))
    return votes.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), value)).alias("best")).select(key, F.col(f"best.{value}").alias("est"))


def impute_by_proximity(rows: DataFrame, key: str, cols: list[str], value: str, rounds: int = 3, trees: int = 15, **forest) -> DataFrame:
    """Rows with the missing numbers of `value` filled in, as est.

    rows: key, y, cols (numbers, `value` among them).  The first fill is the median; each round fits a forest on the
    filled rows and replaces the missing values by the proximity-weighted mean of the known ones.
    """
    median = rows.agg(F.percentile_approx(value, 0.5, 100_000)).first()[0]
    filled = rows.withColumn("est", F.coalesce(F.col(value).cast("double"), F.lit(float(median if median is not None else 0))))
    filled = with_draws(filled, key, trees)  # each round's forest draws the same rows
    for _ in range(rounds):
        ready = assembled(filled, [c if c != value else "est" for c in cols])
        model = Forest(ready, key, trees, **forest)
        told = near_values(model.passed(ready, key, value), key, value, True).withColumnRenamed("est", "_new")
        filled = written(filled.join(told, key, "left").withColumn("est", F.when(F.col(value).isNull(), F.coalesce("_new", "est")).otherwise(F.col("est"))).drop("_new"))
    return filled.drop(*[f"_w{t}" for t in range(trees)])


def rules(model, names: list[str]) -> list[tuple[int, str, float, int]]:
    """(leaf, condition, prediction, rows that trained it) of a fitted tree, leaves from left to right."""
    out, stack = [], [(model._call_java("rootNode"), [])]
    while stack:
        node, path = stack.pop()
        if node.subtreeDepth() == 0:
            out.append((len(out), " AND ".join(path) or "TRUE", float(node.prediction()), int(node.impurityStats().count())))
            continue
        split = node.split()
        name = names[split.featureIndex()]
        stack += [(node.rightChild(), [*path, f"{name} > {split.threshold()!r}"]), (node.leftChild(), [*path, f"{name} <= {split.threshold()!r}"])]
    return out
