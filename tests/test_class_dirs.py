"""Class folders with and without counts; ranges looked up by merged positions."""

from pyspark.sql import functions as F

from tidemark.plans.ordered import range_lookup
from tidemark.sources.readers import read_class_dirs


def test_class_dirs(spark, tmp_path):
    rows = spark.createDataFrame([("ab"[i % 2], f"text {i}") for i in range(40)], "label string, value string")
    rows.repartition(10, "value").write.partitionBy("label").text(str(tmp_path / "c"))
    whole = read_class_dirs(spark, str(tmp_path / "c"), train_share=0.5).select("label", "text", "split").collect()
    assert sum(len(r["text"].splitlines()) for r in whole) == 40 and {r["label"] for r in whole} == {"label=a", "label=b"}
    assert {r["split"] for r in whole} == {"train", "test"}
    some = read_class_dirs(spark, str(tmp_path / "c"), 2, 3).groupBy("label", "split").count().collect()
    assert {(r["split"], r["count"]) for r in some} == {("train", 2), ("test", 3)}


def test_range_lookup(spark):
    bounds = spark.createDataFrame([(0.0, "a"), (0.5, "b"), (0.5, "c"), (2.0, "d"), (None, "z")], "lo double, w string")
    points = spark.createDataFrame([(i, x) for i, x in enumerate([-1.0, 0.0, 0.4, 0.5, 0.5, 1.9, 2.0, 9.0, None])], "k long, x double")
    got = {r["k"]: r["w"] for r in range_lookup(points, bounds, "x", "lo", ["w"]).collect()}
    assert got == {0: None, 1: "a", 2: "a", 3: "c", 4: "c", 5: "c", 6: "d", 7: "d", 8: None}
    many = spark.range(5000).select("id", (F.col("id") % 97 / 97).alias("x"))
    table = spark.range(50).select((F.col("id") / 50).alias("lo"), F.col("id").alias("slot"))
    out = range_lookup(many, table, "x", "lo", ["slot"])
    assert out.count() == 5000 and out.filter((F.col("slot") / 50 > F.col("x")) | ((F.col("slot") + 1) / 50 <= F.col("x"))).isEmpty()
    assert range_lookup(points.limit(0), bounds, "x", "lo", ["w"]).count() == 0
    assert range_lookup(points, bounds.limit(0), "x", "lo", ["w"]).filter("w IS NOT NULL").isEmpty()
