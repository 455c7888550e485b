"""Source/sink round trips: the given tables are written in the demo's file
formats into the shared scratch folder (under spark.checkpoint.dir), read
back with the readers, and must equal the tables they came from."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tidemark.functions import vectors as V
from tidemark.functions.hashing import md5_mod, md5_mod_sql
from tidemark.functions.numeric import fround
from tidemark.operators import text as X
from tidemark.plans import views
from tidemark.plans.session import ensure_checkpoint_dir
from tidemark.registry import query
from tidemark.registry import sqlviews as SV
from tidemark.registry.text import DOCS
from tidemark.sources import formats, readers


def _scratch(spark, d, name):
    key = hashlib.md5(d.encode()).hexdigest()[:10]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-files/{name}-{key}"


def _flat(c):
    return F.regexp_replace(c, r"[\t\r\n]", " ")


@query("read_plays", f"""WITH {SV.PLAYS}
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS song_id, play_count FROM plays""")
def read_plays(spark, d):
    """Plays written as headerless TSV and read back with fixed names."""
    path = _scratch(spark, d, "plays_tsv")
    views.plays(spark, d).write.mode("overwrite").csv(path, sep="\t", header=False)
    return readers.read_plays(spark, path)


@query("read_table", """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS _corrupt_record
FROM customer""")
def read_table(spark, d):
    """S3: a header CSV typed by an explicit schema (corrupt rows kept)."""
    path = _scratch(spark, d, "customer_csv")
    views.table(spark, d, "customer").write.mode("overwrite").csv(path, header=True)
    return readers.read_table(spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                                            "c_mktsegment string")


@query("read_matrix", """SELECT CAST(l_linenumber AS DOUBLE) AS label, 4 AS n_features,
  round(l_quantity + l_extendedprice + l_discount + l_tax, 6) AS total FROM lineitem""")
def read_matrix(spark, d):
    """A space-separated numeric matrix, label in the last column."""
    path = _scratch(spark, d, "matrix_txt")
    li = views.table(spark, d, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    li.select(F.concat_ws(" ", *[F.col(c).cast("double").cast("string") for c in cols]).alias("value")).write.mode(
        "overwrite").text(path)
    m = readers.read_matrix(spark, path)
    return m.select("label", F.size("features").alias("n_features"),
                    fround(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("read_labeled_text", """SELECT lang AS label, regexp_replace(text, '[\\t\\r\\n]', ' ', 'g') AS content
FROM documents WHERE regexp_replace(text, '[\\t\\r\\n]', ' ', 'g') <> ''""")
def read_labeled_text(spark, d):
    """`label \\t content` lines (one document per line)."""
    path = _scratch(spark, d, "labeled_txt")
    views.corpus(spark, d).select(F.concat_ws("\t", "lang", _flat(F.col("text"))).alias("value")).write.mode(
        "overwrite").text(path)
    return readers.read_labeled_text(spark, path)


@query("read_tsv_gbk")
def read_tsv_gbk(spark, d):
    """S6 (rows-only): the knowledge base written as a GBK TSV and decoded
    back.  Characters outside GBK are lost on writing, so equality with the
    source is asserted for the rows GBK surely represents (ASCII text)."""
    path = _scratch(spark, d, "kb_gbk")
    src = views.kb(spark, d).select("item_id", _flat(F.col("text")).alias("text"))
    src.write.mode("overwrite").csv(path, sep="\t", encoding="GBK", quote="\u0000")
    back = readers.read_tsv(spark, path, "item_id long, text string", encoding="GBK")
    representable = src.filter(F.col("text").rlike("^[\\x00-\\x7F]*$"))  # ASCII is a subset of GBK
    bad = representable.join(back.withColumnRenamed("text", "_b"), "item_id").filter(F.col("_b") != F.col("text"))
    if bad.limit(1).count():
        raise AssertionError("GBK round trip changed representable text")
    return back


@query("task_examples", """SELECT 'train-' || q.conv_id || '-' || q.turn AS guid,
  regexp_replace(q.text, '[\\t\\r\\n]', ' ', 'g') AS text_a, regexp_replace(a.text, '[\\t\\r\\n]', ' ', 'g') AS text_b,
  '1' AS label
FROM conversations q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
WHERE q.role = 'user' AND a.role = 'assistant'""")
def task_examples(spark, d):
    """A sentence-pair TSV with header (quality, id1, id2, s1, s2) read by
    the paired-task processor (text_a = s1, text_b = s2, label = quality);
    the row key is the explicit pair id."""
    from tidemark.operators import dialogue as DLG

    path = _scratch(spark, d, "pairs_tsv")
    p = DLG.qa_pairs(views.turns(spark, d))
    header = spark.createDataFrame([("Quality\t#1 ID\t#2 ID\t#1 String\t#2 String",)], "value string")
    body = p.select(F.concat_ws("\t", F.lit("1"), F.col("conv_id").cast("string"), F.col("turn").cast("string"),
                                _flat(F.col("question")), _flat(F.col("answer"))).alias("value"))
    header.unionByName(body).write.mode("overwrite").text(path)
    raw = spark.read.text(path).filter(~F.col("value").startswith("Quality\t"))
    fields = F.split("value", "\t")
    rows = raw.select(F.concat_ws("-", fields[1], fields[2]).alias("row"), fields.alias("fields"))
    # the paired task reads s1, s2 and the quality column (positions 3, 4, 0)
    return readers.examples(rows, "mrpc", "train")


@query("read_libsvm", f"""WITH {DOCS}, tok AS (SELECT doc_id, unnest(tokens) AS token FROM docs),
counts AS (SELECT token, COUNT(*) AS count FROM tok GROUP BY 1),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY count DESC, token) AS INTEGER) AS id FROM counts QUALIFY id <= 4999),
bow AS (SELECT t.doc_id, v.id, COUNT(*) AS c FROM tok t JOIN vocab v USING (token) GROUP BY 1, 2),
f AS (SELECT doc_id, COUNT(*) AS n, SUM(c) AS total FROM bow GROUP BY 1)
SELECT CAST(l.quality AS DOUBLE) AS label, CAST(COALESCE(f.n, 0) AS INTEGER) AS n_features,
       CAST(COALESCE(f.total, 0) AS DOUBLE) AS total
FROM labels l JOIN documents dd ON dd.doc_id = l.doc_id LEFT JOIN f ON f.doc_id = l.doc_id""")
def read_libsvm(spark, d):
    """Libsvm lines written and parsed back."""
    from tidemark.registry.text import libsvm_lines

    path = _scratch(spark, d, "libsvm")
    libsvm_lines(spark, d).select(F.col("line").alias("value")).write.mode("overwrite").text(path)
    r = formats.read_libsvm(spark, path)
    return r.select("label", F.size("features").alias("n_features"),
                    F.aggregate("features", F.lit(0.0), lambda a, x: a + x["value"]).alias("total"))


@query("read_vectors", """SELECT CAST(vec_id AS VARCHAR) AS token, CAST(len(embedding) AS INTEGER) AS dim,
  round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total FROM embeddings""")
def read_vectors(spark, d):
    """`word v1..vd` lines with a `count dim` header, read back."""
    path = _scratch(spark, d, "vectors_txt")
    v = views.vectors(spark, d).select(F.col("id").cast("string").alias("token"),
                                      V.as_double(F.col("embedding")).alias("vector"))
    formats.vector_header(v).unionByName(formats.vector_lines(v)).write.mode("overwrite").text(path)
    r = formats.read_vectors(spark, path)
    return r.select("token", F.size("vector").alias("dim"),
                    fround(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("vocab_roundtrip", f"""WITH {DOCS}, tok AS (SELECT doc_id, unnest(tokens) AS token FROM docs),
counts AS (SELECT token, COUNT(*) AS count FROM tok GROUP BY 1)
SELECT '_PAD' AS token, 0 AS id UNION ALL
SELECT token, CAST(row_number() OVER (ORDER BY count DESC, token) AS INTEGER) AS id FROM counts QUALIFY id <= 4999""")
def vocab_roundtrip(spark, d):
    """Vocabulary persisted as (token, id) and loaded back."""
    path = _scratch(spark, d, "vocab")
    formats.save_vocab(X.build_vocab(X.with_words(views.corpus(spark, d)), 5000), path)
    return formats.load_vocab(spark, path)


@query("split_by_ids", f"""WITH dev AS (SELECT o_orderkey FROM orders WHERE {md5_mod_sql("CAST(o_orderkey AS VARCHAR)", 10)} = 0)
SELECT 'dev' AS part, COUNT(*) AS n, round(SUM(l_extendedprice), 2) AS total FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM dev)
UNION ALL
SELECT 'train', COUNT(*), round(SUM(l_extendedprice), 2) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM dev)""")
def split_by_ids(spark, d):
    """Lines split into dev / train by a dev id list (semi / anti join)."""
    dev = views.table(spark, d, "orders").filter(md5_mod(F.col("o_orderkey").cast("string"), 10) == 0).select(
        F.col("o_orderkey").alias("l_orderkey"))
    li = views.table(spark, d, "lineitem")
    a, b = readers.split_by_ids(li, dev, "l_orderkey")
    agg = lambda df, name: df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"),
                                  fround(F.sum("l_extendedprice"), 2).alias("total"))
    return agg(a, "dev").unionByName(agg(b, "train"))


@query("read_bow_lines", f"""WITH {DOCS}
SELECT CAST(doc_id AS VARCHAR) AS track, token AS word, COUNT(*) AS count FROM (
  SELECT doc_id, unnest(tokens) AS token FROM docs) GROUP BY 1, 2""")
def read_bow_lines(spark, d):
    """Bag-of-words lines `track,word:count,...` read into long form."""
    path = _scratch(spark, d, "bow_lines")
    tf = X.term_freq(X.with_words(views.corpus(spark, d)))
    lines = tf.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_list(
        F.concat(F.col("token"), F.lit(":"), F.col("tf").cast("string")))), ",").alias("_w"))
    lines.select(F.concat_ws(",", F.col("doc_id").cast("string"), "_w").alias("value")).write.mode(
        "overwrite").text(path)
    return readers.read_bow_lines(spark, path)



def _parse_page(raw: bytes) -> list[dict]:
    """Url and html length of every record of a page file (the page id is in
    the folder name of the partitioned write)."""
    import json

    recs = [json.loads(line) for line in raw.decode("utf-8").split("\n") if line.strip()]
    return [{"url": r.get("url"), "n_chars": len(r["html"]) if r.get("html") is not None else None} for r in recs]


@query("ingest_files", "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars, CAST(NULL AS VARCHAR) AS _error FROM pages")
def ingest_files(spark, d):
    """One JSON file per page (written partitioned by page id), ingested
    recursively as binary files and parsed per batch in mapInPandas; a file
    that fails to parse lands in `_error` instead of stopping the job."""
    path = _scratch(spark, d, "pages_files")
    views.table(spark, d, "pages").repartition("page_id").write.mode("overwrite").partitionBy("page_id").json(path)
    out = readers.ingest_files(spark, path, _parse_page, "url string, n_chars long")
    pid = F.regexp_extract("path", "page_id=([0-9]+)", 1).cast("bigint")
    return out.select(pid.alias("page_id"), "url", "n_chars", "_error")


@query("read_class_dirs", f"""SELECT doc_id, lang AS label, CASE WHEN ({md5_mod_sql("'doc_id=' || CAST(doc_id AS VARCHAR)", 1000)}) < 800 THEN 'train' ELSE 'test' END AS split,
  CAST(length(text) AS BIGINT) AS n_chars FROM documents""")
def read_class_dirs(spark, d):
    """One text file per document under a folder per language, read back
    with the label from the path; a hash of the document's folder splits."""
    path = _scratch(spark, d, "class_dirs")
    docs = views.table(spark, d, "documents").select("lang", "doc_id", F.col("text").alias("value"))
    docs.repartition("lang", "doc_id").write.mode("overwrite").partitionBy("lang", "doc_id").text(path)
    got = readers.read_class_dirs(spark, path, label_at=-3, key_at=-2)
    return got.select(F.regexp_extract("path", "doc_id=([0-9]+)", 1).cast("bigint").alias("doc_id"),
                      F.regexp_replace("label", "^lang=", "").alias("label"), "split",
                      (F.length("text") - 1).cast("bigint").alias("n_chars"))  # the writer ends each text with \n


@query("label_ids", """SELECT doc_id, source, CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER) AS label_id
FROM documents WHERE source IS NOT NULL UNION ALL SELECT doc_id, source, NULL FROM documents WHERE source IS NULL""")
def label_ids(spark, d):
    """Every document's source as the id of its label."""
    from tidemark.operators.features import label_ids as ids

    return ids(views.table(spark, d, "documents").select("doc_id", "source"), "source").select("doc_id", "source", "label_id")
