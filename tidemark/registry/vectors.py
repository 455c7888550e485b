"""Vector queries over `embeddings` (64-d unit vectors, labels 0..9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import vectors as V
from tidemark.functions.hashing import md5_mod, md5_mod_sql
from tidemark.functions.numeric import fround
from tidemark.operators import vectors as X
from tidemark.plans import views
from tidemark.registry import query

K = 5
DIM = 64


def _vecs(spark, d):
    return views.vectors(spark, d).select("id", V.as_double(F.col("embedding")).alias("vec"), "label")


def _split(spark, d):
    v = _vecs(spark, d).withColumn("chance", md5_mod(F.col("id").cast("string"), 100))
    return v.filter(F.col("chance") < 20), v.filter(F.col("chance") >= 20)


SPLIT_SQL = f"""v AS (SELECT vec_id AS id, embedding AS vec, label,
                {md5_mod_sql('CAST(vec_id AS VARCHAR)', 100)} AS chance FROM embeddings),
q AS (SELECT * FROM v WHERE chance < 20), b AS (SELECT * FROM v WHERE chance >= 20)"""


def _dist_sql(a: str, b: str) -> str:
    return f"sqrt(list_sum(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i]::DOUBLE - {b}[i]::DOUBLE) ^ 2)))"


# components of the embeddings table's vectors
WIDTH = 64


@query("vec_explode", "SELECT vec_id AS id, " + ", ".join(
    f"round(embedding[{i + 1}]::DOUBLE, 6) AS e{i}" for i in range(WIDTH)) + " FROM embeddings")
def vec_explode(spark, d):
    from tidemark.operators.features import explode_vector

    e = explode_vector(_vecs(spark, d).select("id", "vec"), "vec", WIDTH, "e")
    return e.select("id", *[fround(f"e{i}", 6).alias(f"e{i}") for i in range(WIDTH)])


@query("vec_norms", """SELECT vec_id AS id,
  round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm,
  round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total FROM embeddings""")
def vec_norms(spark, d):
    v = _vecs(spark, d)
    return v.select("id", fround(V.l2norm(F.col("vec")), 6).alias("norm"),
                    fround(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


CENT_SQL = """c AS (SELECT label, list(m ORDER BY i) AS centroid FROM (
  SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) r(i) GROUP BY 1, 2) GROUP BY 1),
var AS (SELECT list(v ORDER BY i) AS var FROM (
  SELECT i, var_pop(embedding[i]::DOUBLE) AS v FROM embeddings, range(1, 65) r(i) GROUP BY 1)),
x AS (SELECT e.vec_id AS id, e.label, list_transform(e.embedding, lambda z: z::DOUBLE) AS a, c.centroid AS b, var.var
      FROM embeddings e JOIN c ON c.label = e.label CROSS JOIN var),
pd AS (SELECT *, list_transform(a, lambda z: abs(z) / list_sum(list_transform(a, lambda w: abs(w)))) AS pa,
                 list_transform(b, lambda z: abs(z) / list_sum(list_transform(b, lambda w: abs(w)))) AS pb FROM x)"""


@query("vec_distances", f"""WITH {CENT_SQL}
SELECT id, label,
  round(sqrt(list_sum(list_transform(range(1, 65), lambda i: (a[i] - b[i]) * (a[i] - b[i])))), 6) AS euclid,
  round(list_sum(list_transform(range(1, 65), lambda i: abs(a[i] - b[i]))), 6) AS manhattan,
  round(list_max(list_transform(range(1, 65), lambda i: abs(a[i] - b[i]))), 6) AS chebyshev,
  round(pow(list_sum(list_transform(range(1, 65), lambda i: pow(abs(a[i] - b[i]), 3.0))), 1.0 / 3.0), 6) AS minkowski3,
  round(list_sum(list_transform(range(1, 65), lambda i: a[i] * b[i]))
        / (sqrt(list_sum(list_transform(a, lambda z: z * z))) * sqrt(list_sum(list_transform(b, lambda z: z * z)))), 6) AS cosine,
  round(sqrt(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN var[i] > 0 THEN (a[i] - b[i]) * (a[i] - b[i]) / var[i] ELSE 0.0 END))), 6) AS std_euclid,
  CAST(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN sign(a[i]) <> sign(b[i]) THEN 1 ELSE 0 END)) AS INTEGER) AS hamming_sign,
  round(-ln(list_sum(list_transform(range(1, 65), lambda i: sqrt(pa[i] * pb[i])))), 6) AS bhattacharyya,
  round(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN pa[i] > 0 THEN pa[i] * ln(pa[i] / pb[i]) ELSE 0.0 END)), 6) AS kl
FROM pd""")
def vec_distances(spark, d):
    v = _vecs(spark, d)
    cents = X.dim_means(v, "vec", ["label"])
    _, var = X.dim_stats(v, "vec")
    var_lit = F.array(*[F.lit(float(x)) for x in var])
    j = v.join(cents, "label")
    a, b = F.col("vec"), F.col("centroid")
    pa, pb = V.to_distribution(a), V.to_distribution(b)
    return j.select(
        "id", "label",
        fround(V.euclidean(a, b), 6).alias("euclid"),
        fround(V.manhattan(a, b), 6).alias("manhattan"),
        fround(V.chebyshev(a, b), 6).alias("chebyshev"),
        fround(V.minkowski(a, b, 3.0), 6).alias("minkowski3"),
        fround(V.cosine(a, b), 6).alias("cosine"),
        fround(V.std_euclidean(a, b, var_lit), 6).alias("std_euclid"),
        V.hamming(F.transform(a, lambda x: F.signum(x)), F.transform(b, lambda x: F.signum(x))).alias("hamming_sign"),
        fround(V.bhattacharyya(pa, pb), 6).alias("bhattacharyya"),
        fround(V.kl_divergence(pa, pb), 6).alias("kl"),
    )


KNN_SQL = f"""{SPLIT_SQL},
dd AS (SELECT q.id AS qid, b.id, {_dist_sql('q.vec', 'b.vec')} AS dist FROM q CROSS JOIN b),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), id) AS rank FROM dd)
       WHERE rank <= {K})"""


def _knn(spark, d):
    q, b = _split(spark, d)
    return X.knn_exact(q.select("id", "vec"), b.select("id", "vec"), K), q, b


@query("knn_exact", f"WITH {KNN_SQL} SELECT qid, id, round(dist, 6) AS dist, rank FROM nn")
def knn_exact(spark, d):
    nn, _, _ = _knn(spark, d)
    return nn.select("qid", "id", fround("dist", 6).alias("dist"), "rank")


VOTE_SQL = f"""{KNN_SQL},
votes AS (SELECT nn.qid, b.label, COUNT(*) AS votes FROM nn JOIN b ON b.id = nn.id GROUP BY 1, 2),
pred AS (SELECT qid, label AS prediction, votes FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY votes DESC, label) AS r FROM votes) WHERE r = 1)"""


@query("knn_vote", f"WITH {VOTE_SQL} SELECT * FROM pred")
def knn_vote(spark, d):
    nn, _, b = _knn(spark, d)
    return X.knn_vote(nn, b.select("id", "label"))


@query("knn_error", f"""WITH {VOTE_SQL}
SELECT COUNT(*) AS n, round(avg(CASE WHEN p.prediction <> q.label THEN 1.0 ELSE 0.0 END), 6) AS error_rate
FROM pred p JOIN q ON q.id = p.qid""")
def knn_error(spark, d):
    nn, q, b = _knn(spark, d)
    p = X.knn_vote(nn, b.select("id", "label")).join(q.select(F.col("id").alias("qid"), "label"), "qid")
    return p.agg(F.count(F.lit(1)).alias("n"),
                 fround(F.avg((F.col("prediction") != F.col("label")).cast("double")), 6).alias("error_rate"))


@query("ivf_search")
def ivf_search(spark, d):
    """Rows-only: approximate cosine search over 4 probed cells of 16."""
    q, b = _split(spark, d)
    return X.ivf_search(q.select("id", "vec"), b.select("id", "vec"), K, n_cells=16, nprobe=4)


N_CENTERS = 10


@query("lloyd_step", f"""WITH c0 AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS center, embedding AS c FROM embeddings
                                     QUALIFY center < {N_CENTERS}),
dd AS (SELECT e.vec_id, e.embedding, c0.center,
              list_sum(list_transform(range(1, 65), lambda i: (e.embedding[i]::DOUBLE - c0.c[i]::DOUBLE) ^ 2)) AS d2
       FROM embeddings e CROSS JOIN c0),
a AS (SELECT vec_id, embedding, center FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, center) AS r FROM dd) WHERE r = 1),
m AS (SELECT center, i, avg(embedding[i]::DOUBLE) AS x, COUNT(*) AS n FROM a, range(1, 65) r(i) GROUP BY 1, 2)
SELECT CAST(center AS INTEGER) AS center, n, CAST(i - 1 AS INTEGER) AS dim, round(x, 6) AS value FROM m""")
def lloyd_step(spark, d):
    v = _vecs(spark, d)
    start = [r["vec"] for r in v.orderBy("id").limit(N_CENTERS).collect()]
    m = X.lloyd_step(v, start)
    return m.select("center", "n", F.posexplode("centroid").alias("dim", "value")).withColumn(
        "value", fround("value", 6))


@query("center_scale", f"""WITH {SPLIT_SQL},
st AS (SELECT i, avg(vec[i]::DOUBLE) AS m, stddev_pop(vec[i]::DOUBLE) AS s FROM b, range(1, 65) r(i) GROUP BY 1)
SELECT q.id, CAST(st.i - 1 AS INTEGER) AS dim,
       round(CASE WHEN st.s > 0 THEN (q.vec[st.i]::DOUBLE - st.m) / st.s ELSE q.vec[st.i]::DOUBLE - st.m END, 6) AS value
FROM q CROSS JOIN st""")
def center_scale(spark, d):
    q, b = _split(spark, d)
    means, var = X.dim_stats(b, "vec")
    out = X.center_scale(q.select("id", "vec"), "vec", means, [v ** 0.5 for v in var])
    return out.select("id", F.posexplode("vec").alias("dim", "value")).withColumn("value", fround("value", 6))


@query("frame_summary", """SELECT label, CAST(i - 1 AS INTEGER) AS dim, round(avg(embedding[i]::DOUBLE), 6) AS mean,
  round(stddev_pop(embedding[i]::DOUBLE), 6) AS std FROM embeddings, range(1, 65) r(i) GROUP BY 1, 2""")
def frame_summary(spark, d):
    """A4: per-dimension mean and population std over the frames (vectors)
    of each group (label)."""
    v = _vecs(spark, d)
    ex = v.select("label", F.posexplode("vec").alias("dim", "x"))
    return ex.groupBy("label", "dim").agg(fround(F.avg("x"), 6).alias("mean"), fround(F.stddev_pop("x"), 6).alias("std"))
