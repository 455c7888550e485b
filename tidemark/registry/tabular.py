"""Tabular queries over `lineitem` / `orders` / `customer` (label
l_returnflag, regression target l_extendedprice)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.hashing import md5_mod, md5_mod_sql
from tidemark.functions.numeric import fround
from tidemark.operators import evaluation as E
from tidemark.operators import features as X
from tidemark.operators import trees as Tr
from tidemark.plans import views
from tidemark.plans.scale import written
from tidemark.registry import query

ATTRS = ["l_linestatus", "qty_band", "disc_band", "tax_band"]
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CLASSES = ["A", "N", "R"]
THRESHOLDS = [round(0.1 * i, 1) for i in range(1, 10)]

TAB_SQL = """tab AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
         CAST(floor(l_quantity / 10) AS INTEGER) AS qty_band, CAST(round(l_discount * 100) AS INTEGER) AS disc_band,
         CAST(round(l_tax * 100) AS INTEGER) AS tax_band,
         CAST(l_returnflag = 'R' AS INTEGER) AS y_bin, least(l_discount / 0.1, 1.0) AS p_r
  FROM lineitem)"""
UNPIV_SQL = "unp AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS attr, CAST({a} AS VARCHAR) AS value, l_returnflag AS label FROM tab" for a in ATTRS
) + "), cnt AS (SELECT attr, value, label, COUNT(*) AS c FROM unp GROUP BY 1, 2, 3)"


def _tab(spark, d):
    li = views.table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", *NUM, "l_returnflag", "l_linestatus",
        F.floor(F.col("l_quantity") / 10).cast("int").alias("qty_band"),
        F.round(F.col("l_discount") * 100).cast("int").alias("disc_band"),
        F.round(F.col("l_tax") * 100).cast("int").alias("tax_band"),
        (F.col("l_returnflag") == "R").cast("int").alias("y_bin"),
        F.least(F.col("l_discount") / 0.1, F.lit(1.0)).alias("p_r"),
    )


def _counts(spark, d):
    return Tr.split_table(_tab(spark, d), ATTRS, "l_returnflag")


def _split_sql(expr: str) -> str:
    return md5_mod_sql(f"CAST({expr} AS VARCHAR)", 100)


@query("null_counts", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, COUNT(*) - COUNT({c}) AS n_null FROM lineitem"
    for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]) + ")")
def null_counts(spark, d):
    return X.null_counts(views.table(spark, d, "lineitem"))


IMPUTE_SRC = """src AS (
  SELECT c.c_custkey, o.avg_price, o.n_orders FROM customer c LEFT JOIN (
    SELECT o_custkey, avg(o_totalprice) AS avg_price, COUNT(*) AS n_orders FROM orders
    WHERE o_orderstatus = 'P' GROUP BY 1) o ON o.o_custkey = c.c_custkey)"""


@query("impute_stats", f"""WITH {IMPUTE_SRC}
SELECT COUNT(*) - COUNT(avg_price) AS n_null, round(avg(avg_price), 6) AS mean,
       round(quantile_cont(avg_price, 0.5), 6) AS median,
       (SELECT n_orders FROM src WHERE n_orders IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, n_orders LIMIT 1) AS mode
FROM src""")
def impute_stats(spark, d):
    o = views.table(spark, d, "orders").filter(F.col("o_orderstatus") == "P").groupBy("o_custkey").agg(
        F.avg("o_totalprice").alias("avg_price"), F.count(F.lit(1)).alias("n_orders"))
    src = views.table(spark, d, "customer").select("c_custkey").join(
        o.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
    mean = X.fit_impute(src, "avg_price", "mean")
    median = X.fit_impute(src, "avg_price", "median")
    mode = X.fit_impute(src, "n_orders", "mode")
    stats = src.agg((F.count(F.lit(1)) - F.count("avg_price")).alias("n_null"))
    return stats.select(
        "n_null", fround(F.lit(mean), 6).alias("mean"), fround(F.lit(median), 6).alias("median"),
        F.lit(mode).cast("bigint").alias("mode"),
    )


@query("impute_apply", f"""WITH {IMPUTE_SRC},
m AS (SELECT quantile_cont(avg_price, 0.5) AS med FROM src)
SELECT c_custkey, round(COALESCE(avg_price, m.med), 6) AS avg_price FROM src CROSS JOIN m""")
def impute_apply(spark, d):
    o = views.table(spark, d, "orders").filter(F.col("o_orderstatus") == "P").groupBy("o_custkey").agg(
        F.avg("o_totalprice").alias("avg_price"))
    src = views.table(spark, d, "customer").select("c_custkey").join(
        o.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
    out = X.impute(src, "avg_price", X.fit_impute(src, "avg_price", "median"))
    return out.select("c_custkey", fround("avg_price", 6).alias("avg_price"))


@query("label_mean", f"""WITH {TAB_SQL}
SELECT l_linestatus, COUNT(*) AS n, round(avg(y_bin), 6) AS label_mean FROM tab GROUP BY 1""")
def label_mean(spark, d):
    return _tab(spark, d).groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), fround(F.avg("y_bin"), 6).alias("label_mean"))


@query("threshold_sweep", f"""WITH {TAB_SQL},
t AS (SELECT p_r, y_bin, unnest([{', '.join(f'{t}::DOUBLE' for t in THRESHOLDS)}]) AS threshold FROM tab),
g AS (SELECT threshold,
             CAST(SUM(CASE WHEN p_r >= threshold AND y_bin = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(SUM(CASE WHEN p_r >= threshold AND y_bin = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(SUM(CASE WHEN p_r < threshold AND y_bin = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
             CAST(SUM(CASE WHEN p_r < threshold AND y_bin = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn FROM t GROUP BY 1)
SELECT threshold, tp, fp, tn, fn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 6) AS recall FROM g""")
def threshold_sweep(spark, d):
    s = X.threshold_sweep(_tab(spark, d), "p_r", "y_bin", THRESHOLDS)
    return s.withColumn("precision", fround("precision", 6)).withColumn("recall", fround("recall", 6))


@query("describe", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, COUNT({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in NUM) + ")")
def describe(spark, d):
    x = X.describe(views.table(spark, d, "lineitem"), NUM)
    return x.withColumn("mean", fround("mean", 6)).withColumn("stddev", fround("stddev", 6))


@query("scaler_stats", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, min({c}) AS min, max({c}) AS max, round(avg({c}), 6) AS mean, "
    f"round(stddev_pop({c}), 6) AS std_pop, round(stddev_samp({c}), 6) AS std FROM lineitem" for c in NUM) + ")")
def scaler_stats(spark, d):
    st = X.fit_scaler(views.table(spark, d, "lineitem"), NUM)
    rows = [(c, s["min"], s["max"], s["mean"], s["std_pop"], s["std"]) for c, s in st.items()]
    df = spark.createDataFrame(rows, "column string, min double, max double, mean double, std_pop double, std double")
    return df.select("column", "min", "max", *[fround(c, 6).alias(c) for c in ("mean", "std_pop", "std")])


@query("entropy", f"""WITH {TAB_SQL},
c AS (SELECT l_linestatus, l_returnflag, COUNT(*) AS c FROM tab GROUP BY 1, 2),
n AS (SELECT *, SUM(c) OVER (PARTITION BY l_linestatus) AS n FROM c)
SELECT l_linestatus, round(SUM(-(c / n) * log2(c / n)), 6) AS entropy, CAST(max(n) AS BIGINT) AS n FROM n GROUP BY 1""")
def entropy(spark, d):
    e = Tr.entropy(_tab(spark, d), "l_returnflag", ["l_linestatus"])
    return e.withColumn("entropy", fround("entropy", 6))


@query("info_gain", f"""WITH {TAB_SQL}, {UNPIV_SQL},
bv AS (SELECT attr, value, SUM(c) AS nv FROM cnt GROUP BY 1, 2),
ev AS (SELECT cnt.attr, cnt.value, SUM(-(c / nv) * log2(c / nv)) AS ent_v, max(nv) AS nv
       FROM cnt JOIN bv ON bv.attr = cnt.attr AND bv.value = cnt.value GROUP BY 1, 2),
bl AS (SELECT attr, label, SUM(c) AS nl FROM cnt GROUP BY 1, 2),
tot AS (SELECT attr, SUM(nl) AS n FROM bl GROUP BY 1),
ed AS (SELECT bl.attr, SUM(-(nl / n) * log2(nl / n)) AS ent_d, max(n) AS n FROM bl JOIN tot ON tot.attr = bl.attr GROUP BY 1),
g AS (SELECT ev.attr, max(ent_d) - SUM(nv / n * ent_v) AS gain, SUM(-(nv / n) * log2(nv / n)) AS iv
      FROM ev JOIN ed ON ed.attr = ev.attr GROUP BY 1),
r AS (SELECT *, CASE WHEN iv > 0 THEN gain / iv END AS gain_ratio, avg(gain) OVER () AS avg_gain FROM g),
b AS (SELECT min(attr) AS attr FROM r WHERE gain >= avg_gain - 1e-12 AND gain_ratio =
        (SELECT max(gain_ratio) FROM r WHERE gain >= avg_gain - 1e-12))
SELECT attr, round(gain, 6) AS gain, round(iv, 6) AS iv, round(gain_ratio, 6) AS gain_ratio,
       attr = (SELECT attr FROM b) AS chosen FROM r""")
def info_gain(spark, d):
    g = Tr.info_gain(_counts(spark, d))
    return g.select("attr", *[fround(c, 6).alias(c) for c in ("gain", "iv", "gain_ratio")], "chosen")


@query("gini_splits", f"""WITH {TAB_SQL}, {UNPIV_SQL},
bv AS (SELECT attr, value, SUM(c) AS nv FROM cnt GROUP BY 1, 2),
bl AS (SELECT attr, label, SUM(c) AS nl FROM cnt GROUP BY 1, 2),
n AS (SELECT attr, SUM(nl) AS n FROM bl GROUP BY 1),
gi AS (SELECT cnt.attr, cnt.value, 1 - SUM((c / nv) * (c / nv)) AS gini_in, max(nv) AS nv
       FROM cnt JOIN bv USING (attr, value) GROUP BY 1, 2),
go AS (SELECT bl.attr, bv.value,
              CASE WHEN COUNT(CASE WHEN n.n > bv.nv THEN 1 END) > 0 THEN
                1 - SUM(CASE WHEN n.n > bv.nv THEN ((nl - COALESCE(cnt.c, 0)) / (n.n - bv.nv)) ^ 2 END) END AS gini_out
       FROM bl JOIN n USING (attr) JOIN bv USING (attr)
       LEFT JOIN cnt ON cnt.attr = bl.attr AND cnt.value = bv.value AND cnt.label = bl.label GROUP BY 1, 2),
s AS (SELECT gi.attr, gi.value, gi.nv / n.n * gini_in + (n.n - gi.nv) / n.n * COALESCE(gini_out, 0.0) AS gini_split
      FROM gi JOIN go USING (attr, value) JOIN n USING (attr))
SELECT attr, value, round(gini_split, 6) AS gini_split,
       row_number() OVER (PARTITION BY attr ORDER BY round(gini_split, 9), value) = 1 AS best FROM s""")
def gini_splits(spark, d):
    g = Tr.gini_splits(_counts(spark, d))
    return g.select("attr", "value", fround("gini_split", 6).alias("gini_split"), "best")


@query("best_sse_split", f"""WITH g AS (
  SELECT l_quantity AS t, COUNT(*) AS n, SUM(l_extendedprice / 1000) AS sy,
         SUM((l_extendedprice / 1000) * (l_extendedprice / 1000)) AS syy FROM lineitem GROUP BY 1),
p AS (SELECT t, SUM(n) OVER w AS nl, SUM(sy) OVER w AS syl, SUM(syy) OVER w AS syyl,
             SUM(n) OVER () AS nn, SUM(sy) OVER () AS sa, SUM(syy) OVER () AS ssa FROM g
      WINDOW w AS (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT t, CAST(nl AS BIGINT) AS nl, round((syyl - syl * syl / nl) + CASE WHEN nn - nl > 0 THEN (ssa - syyl) - (sa - syl) * (sa - syl) / (nn - nl)
  ELSE 0.0 END, 2) AS sse FROM p WHERE nl < nn""")
def best_sse_split(spark, d):
    li = views.table(spark, d, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 1000).alias("y"))
    s = Tr.best_sse_split(li, "l_quantity", "y")
    return s.select("t", "nl", fround("sse", 2).alias("sse"))


@query("hist_split", """WITH m AS (SELECT min(l_discount) AS lo, max(l_discount) AS hi, avg(l_extendedprice / 1000) AS mu FROM lineitem),
b AS (SELECT least(CAST(floor((l_discount - m.lo) / ((m.hi - m.lo) / 10)) AS INTEGER), 9) AS bin,
             m.mu - l_extendedprice / 1000 AS g FROM lineitem CROSS JOIN m),
h AS (SELECT bin, SUM(g) AS g, COUNT(*) AS h, COUNT(*) AS n FROM b GROUP BY 1),
p AS (SELECT bin, n, SUM(g) OVER w AS gl, SUM(h) OVER w AS hl, SUM(g) OVER () AS gg, SUM(h) OVER () AS hh FROM h
      WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT bin, n, round(gl, 4) AS GL, CAST(hl AS DOUBLE) AS HL, round(gg - gl, 4) AS GR, CAST(hh - hl AS DOUBLE) AS HR,
       round(0.5 * (gl * gl / (hl + 1.0) + (gg - gl) * (gg - gl) / (hh - hl + 1.0) - gg * gg / (hh + 1.0)), 4) AS gain FROM p""")
def hist_split(spark, d):
    li = views.table(spark, d, "lineitem")
    mu = li.agg(F.avg(F.col("l_extendedprice") / 1000)).first()[0]
    x = li.select("l_discount", (F.lit(mu) - F.col("l_extendedprice") / 1000).alias("g"), F.lit(1.0).alias("h"))
    s = Tr.hist_split(x, "l_discount", "g", "h", 10)
    return s.select("bin", "n", fround("GL", 4).alias("GL"), "HL", fround("GR", 4).alias("GR"), "HR",
                    fround("gain", 4).alias("gain"))


@query("nb_counts", f"""WITH {TAB_SQL}, {UNPIV_SQL},
nc AS (SELECT attr, label, SUM(c) AS n_c FROM cnt GROUP BY 1, 2),
k AS (SELECT attr, COUNT(DISTINCT value) AS k FROM cnt GROUP BY 1)
SELECT cnt.attr, value, cnt.label, c, round((c + 1.0) / (n_c + 1.0 * k), 6) AS likelihood
FROM cnt JOIN nc USING (attr, label) JOIN k USING (attr)""")
def nb_counts(spark, d):
    return Tr.naive_bayes_counts(_counts(spark, d)).withColumn("likelihood", fround("likelihood", 6))


NB_PRED_SQL = f"""nc AS (SELECT attr, label, SUM(c) AS n_c FROM cnt GROUP BY 1, 2),
k AS (SELECT attr, COUNT(DISTINCT value) AS k FROM cnt GROUP BY 1),
prior AS (SELECT label AS cls, ln(n_c / SUM(n_c) OVER ()) AS lp FROM nc WHERE attr = '{ATTRS[0]}'),
rows_ AS ({" UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, '{a}' AS attr, CAST({a} AS VARCHAR) AS value FROM tab" for a in ATTRS)}),
sc AS (SELECT r.l_orderkey, r.l_linenumber, p.cls,
              SUM(ln((COALESCE(c.c, 0) + 1.0) / (nc.n_c + 1.0 * k.k))) + max(p.lp) AS score
       FROM rows_ r CROSS JOIN prior p
       JOIN nc ON nc.attr = r.attr AND nc.label = p.cls JOIN k ON k.attr = r.attr
       LEFT JOIN cnt c ON c.attr = r.attr AND c.value = r.value AND c.label = p.cls
       GROUP BY 1, 2, 3),
pred AS (SELECT s.l_orderkey, s.l_linenumber, s.cls AS prediction, t.l_returnflag AS label FROM (
           SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY round(score, 9) DESC, cls) AS rk
           FROM sc) s JOIN tab t USING (l_orderkey, l_linenumber) WHERE rk = 1)"""


def _nb_pred(spark, d):
    tab = _tab(spark, d)
    counts = written(Tr.split_table(tab, ATTRS, "l_returnflag"))
    return Tr.naive_bayes_predict(tab, ["l_orderkey", "l_linenumber"], ATTRS, "l_returnflag", counts)


@query("nb_accuracy", f"""WITH {TAB_SQL}, {UNPIV_SQL}, {NB_PRED_SQL},
per AS (SELECT label, COUNT(*) AS n, SUM(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS hit FROM pred GROUP BY 1)
SELECT round(SUM(hit) / SUM(n), 6) AS accuracy, round(avg(hit / n), 6) AS macro_recall FROM per""")
def nb_accuracy(spark, d):
    a = E.accuracy_macro_recall(_nb_pred(spark, d))
    return a.select(fround("accuracy", 6).alias("accuracy"), fround("macro_recall", 6).alias("macro_recall"))


@query("class_report", f"""WITH {TAB_SQL}, {UNPIV_SQL}, {NB_PRED_SQL},
cls AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
m AS (SELECT cls.c, COUNT(*) FILTER (WHERE p.label = cls.c AND p.prediction = cls.c) AS tp,
             COUNT(*) FILTER (WHERE p.label = cls.c) AS support,
             COUNT(*) FILTER (WHERE p.prediction = cls.c) AS npred FROM cls CROSS JOIN pred p GROUP BY 1),
r AS (SELECT c, CASE WHEN npred > 0 THEN tp / npred END AS precision,
             CASE WHEN support > 0 THEN tp / support END AS recall, support FROM m)
SELECT c AS label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) END, 6) AS f1,
       support FROM r""")
def class_report(spark, d):
    r = E.class_report(_nb_pred(spark, d))
    return r.select("label", *[fround(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("confusion", f"""WITH {TAB_SQL}, {UNPIV_SQL}, {NB_PRED_SQL}
SELECT label, {', '.join(f"COUNT(*) FILTER (WHERE prediction = '{c}') AS pred_{c}" for c in CLASSES)}
FROM pred GROUP BY 1""")
def confusion(spark, d):
    return E.confusion(_nb_pred(spark, d), CLASSES)


@query("cpt", f"""WITH {TAB_SQL}, c AS (SELECT l_linestatus, disc_band, l_returnflag, COUNT(*) AS count FROM tab GROUP BY 1, 2, 3)
SELECT *, round(count / SUM(count) OVER (PARTITION BY l_linestatus, disc_band), 6) AS prob FROM c""")
def cpt(spark, d):
    return Tr.cpt(_tab(spark, d), "l_returnflag", ["l_linestatus", "disc_band"]).withColumn("prob", fround("prob", 6))


LINREG_SQL = f"""sp AS (SELECT l_quantity AS x, l_extendedprice AS y, {_split_sql('l_orderkey')} AS chance FROM lineitem),
fit AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM sp WHERE chance >= 20),
test AS (SELECT y, fit.a + fit.b * x AS yhat FROM sp CROSS JOIN fit WHERE chance < 20)"""


@query("linreg_closed_form", f"""WITH {LINREG_SQL}
SELECT round(avg((yhat - y) * (yhat - y)), 4) AS mse, round(sqrt(avg((yhat - y) * (yhat - y))), 6) AS rmse,
       round(1 - SUM((yhat - y) * (yhat - y)) / (COUNT(*) * var_pop(y)), 6) AS r2 FROM test""")
def linreg_closed_form(spark, d):
    li = views.table(spark, d, "lineitem").select(
        F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"),
        md5_mod(F.col("l_orderkey").cast("string"), 100).alias("chance"))
    b, a = li.filter(F.col("chance") >= 20).agg(F.regr_slope("y", "x"), F.regr_intercept("y", "x")).first()
    test = li.filter(F.col("chance") < 20).select("y", (F.lit(a) + F.lit(b) * F.col("x")).alias("yhat"))
    m = E.regression_metrics(test)
    return m.select(fround("mse", 4).alias("mse"), fround("rmse", 6).alias("rmse"), fround("r2", 6).alias("r2"))


@query("losses", f"""WITH {TAB_SQL},
c AS (SELECT y_bin, least(greatest(p_r, 1e-15), 1 - 1e-15) AS pc, p_r FROM tab)
SELECT round(avg(-(y_bin * ln(pc) + (1 - y_bin) * ln(1 - pc))), 6) AS log_loss,
       round(avg(greatest(0.0, 1 - (2 * y_bin - 1) * (2 * p_r - 1))), 6) AS hinge_loss FROM c""")
def losses(spark, d):
    l = E.losses(_tab(spark, d), "p_r", "y_bin")
    return l.select(fround("log_loss", 6).alias("log_loss"), fround("hinge_loss", 6).alias("hinge_loss"))


SCALE_SQL = f"""sp AS (SELECT *, {_split_sql('l_orderkey')} AS chance FROM lineitem),
st AS (SELECT {', '.join(f"min({c}) AS {c}_min, max({c}) AS {c}_max, avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_sd" for c in NUM)}
       FROM sp WHERE chance >= 20)"""


def _split_frames(spark, d):
    li = views.table(spark, d, "lineitem").withColumn("chance", md5_mod(F.col("l_orderkey").cast("string"), 100))
    return li.filter(F.col("chance") >= 20), li.filter(F.col("chance") < 20)


@query("minmax_scale", f"""WITH {SCALE_SQL}
SELECT l_orderkey, l_linenumber, {', '.join(
    f"round(CASE WHEN {c}_max - {c}_min <> 0 THEN ({c} - {c}_min) / ({c}_max - {c}_min) ELSE 0.0 END, 6) AS {c}"
    for c in NUM)} FROM sp CROSS JOIN st WHERE chance < 20""")
def minmax_scale(spark, d):
    train, test = _split_frames(spark, d)
    out = X.minmax(test, X.fit_scaler(train, NUM))
    return out.select("l_orderkey", "l_linenumber", *[fround(c, 6).alias(c) for c in NUM])


@query("standardize", f"""WITH {SCALE_SQL}
SELECT l_orderkey, l_linenumber, {', '.join(
    f"round(CASE WHEN {c}_sd <> 0 THEN ({c} - {c}_mean) / {c}_sd ELSE 0.0 END, 6) AS {c}" for c in NUM)}
FROM sp CROSS JOIN st WHERE chance < 20""")
def standardize(spark, d):
    train, test = _split_frames(spark, d)
    out = X.standardize(test, X.fit_scaler(train, NUM))
    return out.select("l_orderkey", "l_linenumber", *[fround(c, 6).alias(c) for c in NUM])


@query("decade_counts", """SELECT CAST(CAST(floor(year(o_orderdate) / 10) * 10 AS BIGINT) AS VARCHAR) AS decade,
COUNT(*) AS n FROM orders GROUP BY 1""")
def decade_counts(spark, d):
    o = views.table(spark, d, "orders")
    return o.groupBy(X.decade(F.year("o_orderdate")).alias("decade")).agg(F.count(F.lit(1)).alias("n"))


PRICE_SPLITS = [0.0, 10000.0, 20000.0, 30000.0, 50000.0, 100000.0, 1000000.0]


def _bucket_sql(x: str) -> str:
    parts = []
    for i in range(len(PRICE_SPLITS) - 1):
        lo, hi = PRICE_SPLITS[i], PRICE_SPLITS[i + 1]
        op = "<" if i < len(PRICE_SPLITS) - 2 else "<="
        parts.append(f"WHEN {x} >= {lo} AND {x} {op} {hi} THEN {i}")
    return f"CASE {' '.join(parts)} END"


@query("bucket_cross", f"""SELECT {_bucket_sql('l_extendedprice')} AS bucket,
  CAST({_bucket_sql('l_extendedprice')} AS VARCHAR) || '_' || l_returnflag AS crossed, COUNT(*) AS n
FROM lineitem GROUP BY 1, 2""")
def bucket_cross(spark, d):
    li = views.table(spark, d, "lineitem")
    b = X.bucketize(F.col("l_extendedprice"), PRICE_SPLITS)
    return li.select(b.alias("bucket"), X.cross(b, F.col("l_returnflag")).alias("crossed")).groupBy(
        "bucket", "crossed").agg(F.count(F.lit(1)).alias("n"))


@query("one_hot", f"""SELECT l_orderkey, l_linenumber, {', '.join(
    f"CAST(l_returnflag = '{c}' AS INTEGER) AS l_returnflag_{c}" for c in CLASSES)} FROM lineitem""")
def one_hot(spark, d):
    li = views.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    cats = X.categories(li, "l_returnflag")
    return X.one_hot(li, "l_returnflag", cats).drop("l_returnflag")


@query("pearson", """SELECT round(corr(l_quantity, l_extendedprice), 6) AS r,
  CASE WHEN abs(corr(l_quantity, l_extendedprice)) >= 0.8 THEN 'very strong'
       WHEN abs(corr(l_quantity, l_extendedprice)) >= 0.6 THEN 'strong'
       WHEN abs(corr(l_quantity, l_extendedprice)) >= 0.4 THEN 'moderate'
       WHEN abs(corr(l_quantity, l_extendedprice)) >= 0.2 THEN 'weak' ELSE 'very weak' END AS band FROM lineitem""")
def pearson(spark, d):
    p = X.pearson(views.table(spark, d, "lineitem"), "l_quantity", "l_extendedprice")
    return p.select(fround("r", 6).alias("r"), "band")


@query("covariance", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS i, '{b}' AS j, round(covar_samp({a}, {b}), 4) AS cov FROM lineitem"
    for a in NUM for b in NUM) + ")")
def covariance(spark, d):
    c = X.covariance(views.table(spark, d, "lineitem"), NUM)
    return c.withColumn("cov", fround("cov", 4))


@query("na_drop_fill", """WITH src AS (
  SELECT c.c_custkey, c.c_mktsegment, o.avg_price FROM customer c LEFT JOIN (
    SELECT o_custkey, avg(o_totalprice) AS avg_price FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) o
  ON o.o_custkey = c.c_custkey)
SELECT c_mktsegment, COUNT(*) AS n_rows, COUNT(avg_price) AS n_after_dropna,
       round(SUM(COALESCE(avg_price, 0.0)), 4) AS sum_after_fillna FROM src GROUP BY 1""")
def na_drop_fill(spark, d):
    """Rows kept by `na.drop` and the sum after `na.fill(0)` per segment."""
    o = views.table(spark, d, "orders").filter(F.col("o_orderstatus") == "P").groupBy(
        F.col("o_custkey").alias("c_custkey")).agg(F.avg("o_totalprice").alias("avg_price"))
    src = views.table(spark, d, "customer").select("c_custkey", "c_mktsegment").join(o, "c_custkey", "left")
    kept = src.na.drop().groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_after_dropna"))
    filled = src.na.fill(0.0, ["avg_price"]).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_rows"), fround(F.sum("avg_price"), 4).alias("sum_after_fillna"))
    return filled.join(kept, "c_mktsegment", "left").fillna(0, ["n_after_dropna"]).select(
        "c_mktsegment", "n_rows", "n_after_dropna", "sum_after_fillna")


ENSEMBLE_SQL = f"""{TAB_SQL}, {UNPIV_SQL}, {NB_PRED_SQL},
c2 AS (SELECT l_linestatus, disc_band, l_returnflag, COUNT(*) AS c FROM tab GROUP BY 1, 2, 3),
m2 AS (SELECT l_linestatus, disc_band, l_returnflag AS p FROM (
         SELECT *, row_number() OVER (PARTITION BY l_linestatus, disc_band ORDER BY c DESC, l_returnflag) AS r FROM c2) WHERE r = 1),
c3 AS (SELECT qty_band, l_returnflag, COUNT(*) AS c FROM tab GROUP BY 1, 2),
m3 AS (SELECT qty_band, l_returnflag AS p FROM (
         SELECT *, row_number() OVER (PARTITION BY qty_band ORDER BY c DESC, l_returnflag) AS r FROM c3) WHERE r = 1),
votes AS (
  SELECT l_orderkey, l_linenumber, prediction, 1 AS priority FROM pred
  UNION ALL SELECT t.l_orderkey, t.l_linenumber, m2.p, 2 FROM tab t JOIN m2 USING (l_linestatus, disc_band)
  UNION ALL SELECT t.l_orderkey, t.l_linenumber, m3.p, 3 FROM tab t JOIN m3 USING (qty_band)),
g AS (SELECT l_orderkey, l_linenumber, prediction, COUNT(*) AS votes, min(priority) AS pr FROM votes GROUP BY 1, 2, 3)"""


@query("ensemble_vote", f"""WITH {ENSEMBLE_SQL}
SELECT l_orderkey, l_linenumber, prediction, CAST(votes AS DOUBLE) AS votes FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY votes DESC, pr) AS r FROM g) WHERE r = 1""")
def ensemble_vote(spark, d):
    """Majority vote of three predictors of l_returnflag - naive Bayes,
    the conditional-probability table on (line status, discount band) and
    the majority class of the quantity band; ties go to naive Bayes."""
    return E.ensemble_vote(_three(spark, d), LINE)


@query("ensemble_rules", f"""WITH {ENSEMBLE_SQL}
SELECT l_orderkey, l_linenumber, COUNT(*) AS models, bool_and(prediction = 'N') AS accepted,
       round(SUM((prediction = 'N')::INT * (4 - priority)) / SUM(4 - priority), 6) AS score FROM votes GROUP BY 1, 2""")
def ensemble_rules(spark, d):
    """One veto (all three must say N) and the mean of the three, weighted 3, 2 and 1."""
    # both aggregates start from rows dealt by line: a written file packs more rows than a task could group at once;
    # lines without a whole key are in no result
    preds = written(_three(spark, d).dropna(subset=LINE)).repartition(*LINE)
    scores = preds.select(*LINE, (F.col("prediction") == "N").cast("double").alias("score"), (4 - F.col("priority")).cast("double").alias("weight"))
    mean = E.weighted_mean(scores, LINE).withColumn("score", fround("score", 6))
    return E.one_veto(preds, LINE, "N").join(mean, LINE)


LINE = ["l_orderkey", "l_linenumber"]


def _three(spark, d):
    """The predictions of three models of l_returnflag, one row for each line and model."""
    from pyspark.sql import Window

    tab = _tab(spark, d)
    key = LINE

    def majority(by):
        c = tab.groupBy(*by, "l_returnflag").agg(F.count(F.lit(1)).alias("c"))
        w = Window.partitionBy(*by).orderBy(F.col("c").desc(), F.col("l_returnflag"))  # rows per group <= labels
        return c.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).select(
            *by, F.col("l_returnflag").alias("prediction"))

    nb = _nb_pred(spark, d).select(*key, "prediction", F.lit(1.0).alias("weight"), F.lit(1).alias("priority"))
    p2 = tab.join(majority(["l_linestatus", "disc_band"]), ["l_linestatus", "disc_band"]).select(
        *key, "prediction", F.lit(1.0).alias("weight"), F.lit(2).alias("priority"))
    p3 = tab.join(majority(["qty_band"]), ["qty_band"]).select(
        *key, "prediction", F.lit(1.0).alias("weight"), F.lit(3).alias("priority"))
    return nb.unionByName(p2).unionByName(p3)
