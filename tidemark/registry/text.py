"""Corpus queries over `documents` (and `labels`)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.numeric import fround

from tidemark.functions import text as T
from tidemark.operators import text as X
from tidemark.plans import views
from tidemark.plans.scale import cut_lineage
from tidemark.registry import query

V = 5000
PAD_LEN = 600


# ---------------------------------------------------------------- SQL twins

def sql_clean(col: str) -> str:
    t = f"replace({col}, chr(10), ' ')"
    t = f"replace({t}, '-', ' ')"
    for pat in (T.DATE_RE, T.TIME_RE, T.EMAIL_RE, T.URL_RE, T.NOT_LETTER_OR_SPACE_RE):
        t = f"regexp_replace({t}, '{pat}', '', 'g')"
    return f"array_to_string(list_filter(string_split({t}, ' '), lambda w: length(w) > 1), ' ')"


STOP_SQL = "[" + ", ".join(f"'{w}'" for w in T.STOP_WORDS) + "]"


def sql_words(col: str) -> str:
    return (f"list_filter(string_split(lower({sql_clean(col)}), ' '), "
            f"lambda w: w <> '' AND NOT list_contains({STOP_SQL}, w))")


DOCS = f"docs AS (SELECT doc_id, lang, source, {sql_words('text')} AS tokens FROM documents)"
TOK = "tok AS (SELECT doc_id, unnest(tokens) AS token FROM docs)"
COUNTS = "counts AS (SELECT token, COUNT(*) AS count FROM tok GROUP BY 1)"


def sql_vocab(v: int) -> str:
    return f"""vocab AS (
  SELECT '_PAD' AS token, 0 AS id, CAST(NULL AS BIGINT) AS count
  UNION ALL
  SELECT token, CAST(row_number() OVER (ORDER BY count DESC, token) AS INTEGER) AS id, count
  FROM counts QUALIFY id <= {v - 1})"""


def sql_vocab_special(v: int) -> str:
    return f"""vocab AS (
  SELECT * FROM (VALUES ('_PAD', 0, CAST(NULL AS BIGINT)), ('_GO', 1, NULL), ('_EOS', 2, NULL),
                        ('_UNK', 3, NULL)) s(token, id, count)
  UNION ALL
  SELECT token, CAST(row_number() OVER (ORDER BY count DESC, token) + 3 AS INTEGER) AS id, count
  FROM counts QUALIFY id <= {v - 1})"""


POSTOK = "ptok AS (SELECT doc_id, unnest(tokens) AS token, unnest(range(len(tokens))) AS pos FROM docs)"


def sql_encode(unk: int | None) -> str:
    if unk is None:
        j = "SELECT p.doc_id, p.pos, v.id FROM ptok p JOIN vocab v ON v.token = p.token"
    else:
        j = (f"SELECT p.doc_id, p.pos, COALESCE(v.id, {unk}) AS id FROM ptok p "
             "LEFT JOIN vocab v ON v.token = p.token")
    return f"""enc AS (
  SELECT d.doc_id, COALESCE(list(e.id ORDER BY e.pos) FILTER (WHERE e.id IS NOT NULL), []) AS ids
  FROM docs d LEFT JOIN ({j}) e ON e.doc_id = d.doc_id GROUP BY d.doc_id)"""


def _docs(spark, d):
    return X.with_words(views.corpus(spark, d))


def _n_docs(spark, d) -> int:
    return views.corpus(spark, d).count()


# ---------------------------------------------------------------- queries

@query("clean_text", f"SELECT doc_id, {sql_clean('text')} AS clean FROM documents")
def clean_text(spark, d):
    return views.corpus(spark, d).select("doc_id", T.clean_email_text(F.col("text")).alias("clean"))


@query("corpus_words", f"""WITH {DOCS}
SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, md5(array_to_string(tokens, ' ')) AS tokens_md5 FROM docs""")
def corpus_words(spark, d):
    return _docs(spark, d).select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5")
    )


@query("tokenize_ws", r"""WITH t AS (
  SELECT doc_id, list_filter(string_split(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), ' '),
                             lambda w: w <> '') AS tokens FROM documents)
SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, md5(array_to_string(tokens, ' ')) AS tokens_md5 FROM t""")
def tokenize_ws(spark, d):
    t = views.corpus(spark, d).select("doc_id", T.tokenize_ws(F.col("text")).alias("tokens"))
    return t.select("doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query("basic_tokenizer", r"""WITH t AS (
  SELECT doc_id, list_filter(string_split(trim(regexp_replace(
           translate(regexp_replace(text, '[0-9]+', '_NUM', 'g'), '、。，‘’', ''), '\s+', ' ', 'g')), ' '),
         lambda w: w <> '') AS tokens FROM documents)
SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, md5(array_to_string(tokens, ' ')) AS tokens_md5 FROM t""")
def basic_tokenizer(spark, d):
    t = views.corpus(spark, d).select("doc_id", T.basic_tokenizer(F.col("text")).alias("tokens"))
    return t.select("doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query("char_freq", """SELECT lang, ch, COUNT(*) AS n FROM (
  SELECT lang, unnest(list_filter(string_split(text, ''), lambda c: c <> '')) AS ch FROM documents)
GROUP BY 1, 2""")
def char_freq(spark, d):
    c = views.corpus(spark, d).select("lang", F.explode(T.chars(F.col("text"))).alias("ch"))
    return c.groupBy("lang", "ch").agg(F.count(F.lit(1)).alias("n"))


@query("sentences", r"""WITH s AS (
  SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?\n]'), lambda x: trim(x)),
                             lambda x: x <> '') AS sents FROM documents)
SELECT doc_id, CAST(unnest(range(1, len(sents) + 1)) AS INTEGER) AS sent_pos, unnest(sents) AS sentence FROM s""")
def sentences(spark, d):
    s = views.corpus(spark, d).select("doc_id", T.sentences(F.col("text")).alias("s"))
    return s.select("doc_id", F.posexplode("s").alias("sent_pos", "sentence")).withColumn(
        "sent_pos", F.col("sent_pos") + 1
    )


@query("vocab_top", f"WITH {DOCS}, {TOK}, {COUNTS}, {sql_vocab(V)} SELECT * FROM vocab")
def vocab_top(spark, d):
    return X.build_vocab(_docs(spark, d), V)


@query("vocab_special", f"WITH {DOCS}, {TOK}, {COUNTS}, {sql_vocab_special(V)} SELECT * FROM vocab")
def vocab_special(spark, d):
    return X.build_vocab_special(_docs(spark, d), V)


@query("vocab_oov", f"""WITH {DOCS}, {TOK}, {COUNTS}, {sql_vocab_special(V)}
SELECT COUNT(*) AS n_tokens, COUNT(v.id) AS n_known, COUNT(*) - COUNT(v.id) AS n_oov
FROM tok LEFT JOIN vocab v ON v.token = tok.token""")
def vocab_oov(spark, d):
    docs = _docs(spark, d)
    vocab = X.build_vocab_special(docs, V)
    t = docs.select(F.explode("tokens").alias("token")).join(F.broadcast(vocab.select("token", "id")), "token", "left")
    return t.agg(
        F.count(F.lit(1)).alias("n_tokens"), F.count("id").alias("n_known"),
        (F.count(F.lit(1)) - F.count("id")).alias("n_oov"),
    )


@query("encode_drop", f"""WITH {DOCS}, {TOK}, {COUNTS}, {sql_vocab(V)}, {POSTOK}, {sql_encode(None)}
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_ids, array_to_string(ids, ' ') AS ids FROM enc""")
def encode_drop(spark, d):
    docs = cut_lineage(_docs(spark, d))  # tokenised once
    e = X.encode(docs, X.build_vocab(docs, V))
    return e.select("doc_id", F.size("ids").alias("n_ids"), F.array_join("ids", " ").alias("ids"))


@query("encode_unk", f"""WITH {DOCS}, {TOK}, {COUNTS}, {sql_vocab_special(V)}, {POSTOK}, {sql_encode(3)}
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_ids, array_to_string(ids, ' ') AS ids FROM enc""")
def encode_unk(spark, d):
    docs = cut_lineage(_docs(spark, d))  # tokenised once
    e = X.encode(docs, X.build_vocab_special(docs, V), unk=T.UNK_ID)
    return e.select("doc_id", F.size("ids").alias("n_ids"), F.array_join("ids", " ").alias("ids"))


@query("pad_pre", f"""WITH {DOCS}, {TOK}, {COUNTS}, {sql_vocab(V)}, {POSTOK}, {sql_encode(None)},
kept AS (SELECT doc_id, CASE WHEN len(ids) > {PAD_LEN} THEN ids[len(ids) - {PAD_LEN} + 1:] ELSE ids END AS ids FROM enc)
SELECT doc_id, array_to_string(list_concat(list_transform(range(greatest({PAD_LEN} - len(ids), 0)), lambda x: 0), ids), ' ') AS padded
FROM kept""")
def pad_pre(spark, d):
    docs = cut_lineage(_docs(spark, d))  # tokenised once
    e = X.encode(docs, X.build_vocab(docs, V))
    return e.select("doc_id", F.array_join(T.pad_pre(F.col("ids"), PAD_LEN), " ").alias("padded"))


TF = "tf AS (SELECT doc_id, token, COUNT(*) AS tf FROM tok GROUP BY 1, 2)"
DF = "dfreq AS (SELECT token, COUNT(*) AS df FROM tf GROUP BY 1)"


@query("doc_freq", f"""WITH {DOCS}, {TOK}, {TF}, {DF}
SELECT token, df, (SELECT COUNT(*) FROM documents) AS n_docs FROM dfreq""")
def doc_freq(spark, d):
    n = _n_docs(spark, d)
    return X.doc_freq(X.term_freq(_docs(spark, d))).withColumn("n_docs", F.lit(n).cast("bigint"))


@query("min_count", f"WITH {DOCS}, {TOK}, {COUNTS} SELECT token, count FROM counts WHERE count >= 10")
def min_count(spark, d):
    return X.token_counts(_docs(spark, d)).filter(F.col("count") >= 10)


@query("df_band", f"""WITH {DOCS}, {TOK}, {TF}, {DF}
SELECT token, df FROM dfreq
WHERE df >= 0.01 * (SELECT COUNT(*) FROM documents) AND df <= 0.4 * (SELECT COUNT(*) FROM documents)""")
def df_band(spark, d):
    n = _n_docs(spark, d)
    df = X.doc_freq(X.term_freq(_docs(spark, d)))
    return df.filter((F.col("df") >= 0.01 * n) & (F.col("df") <= 0.4 * n))


TFIDF = f"""{TF}, {DF},
nd AS (SELECT COUNT(*) AS n FROM documents),
x AS (SELECT tf.doc_id, tf.token, tf.tf, dfreq.df,
             tf.tf * ln(nd.n / (dfreq.df + 1)) AS tfidf_note,
             tf.tf * (ln((1.0 + nd.n) / (dfreq.df + 1)) + 1) AS raw
      FROM tf JOIN dfreq ON dfreq.token = tf.token CROSS JOIN nd),
tfidf AS (SELECT doc_id, token, tf, df, tfidf_note,
                 raw / sqrt(SUM(raw * raw) OVER (PARTITION BY doc_id)) AS tfidf FROM x)"""


@query("tfidf", f"""WITH {DOCS}, {TOK}, {TFIDF}
SELECT doc_id, token, tf, df, round(tfidf_note, 6) AS tfidf_note, round(tfidf, 6) AS tfidf FROM tfidf""")
def tfidf(spark, d):
    t = X.tfidf(X.term_freq(_docs(spark, d)), _n_docs(spark, d))
    return t.withColumn("tfidf_note", fround("tfidf_note", 6)).withColumn("tfidf", fround("tfidf", 6))


@query("keywords", f"""WITH {DOCS}, {TOK}, {TFIDF}
SELECT doc_id, token, round(tfidf, 6) AS tfidf, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(tfidf, 9) DESC, token) AS rank FROM tfidf)
WHERE rank <= 5""")
def keywords(spark, d):
    t = X.tfidf(X.term_freq(_docs(spark, d)), _n_docs(spark, d))
    k = X.keywords(t, 5)
    return k.select("doc_id", "token", fround("tfidf", 6).alias("tfidf"), "rank")


@query("bigram_counts", f"""WITH {DOCS},
g AS (SELECT doc_id, unnest(list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1])) AS ngram
      FROM docs WHERE len(tokens) >= 2)
SELECT doc_id, ngram, COUNT(*) AS count FROM g GROUP BY 1, 2""")
def bigram_counts(spark, d):
    return X.ngram_counts(_docs(spark, d), 2)


@query("char_trigrams", f"""WITH {DOCS}, {TOK}, {COUNTS}, {sql_vocab(V)},
w AS (SELECT token, '<' || token || '>' AS b FROM vocab WHERE id > 0)
SELECT token, CAST(unnest(range(1, greatest(length(b) - 2, 1) + 1)) AS INTEGER) AS gram_pos,
       unnest(list_transform(range(1, greatest(length(b) - 2, 1) + 1), lambda i: substr(b, i, 3))) AS gram
FROM w""")
def char_trigrams(spark, d):
    v = X.build_vocab(_docs(spark, d), V).filter(F.col("id") > 0)
    return v.select("token", F.posexplode(T.char_ngrams(F.col("token"), 3)).alias("gram_pos", "gram")).withColumn(
        "gram_pos", F.col("gram_pos") + 1
    )


def _sql_window_pairs(w: int) -> str:
    parts = []
    for dd in range(1, w + 1):
        parts.append(f"""SELECT tokens[i] AS w1, tokens[i + {dd}] AS w2, {dd} AS d
  FROM (SELECT tokens, unnest(range(1, len(tokens) - {dd} + 1)) AS i FROM docs WHERE len(tokens) > {dd})
  UNION ALL SELECT tokens[i + {dd}], tokens[i], {dd}
  FROM (SELECT tokens, unnest(range(1, len(tokens) - {dd} + 1)) AS i FROM docs WHERE len(tokens) > {dd})""")
    return "\n  UNION ALL ".join(parts)


@query("cooccurrence", f"""WITH {DOCS}, pairs AS ({_sql_window_pairs(2)})
SELECT w1, w2, COUNT(*) AS count, round(SUM(1.0 / d), 6) AS weight FROM pairs GROUP BY 1, 2""")
def cooccurrence(spark, d):
    c = X.cooccurrence(_docs(spark, d), window=2)
    return c.withColumn("weight", fround("weight", 6))


@query("ngram_context", f"""WITH {DOCS},
p AS (SELECT array_to_string(tokens[i - 2:i - 1], ' ') AS context, tokens[i] AS target
      FROM (SELECT tokens, unnest(range(3, len(tokens) + 1)) AS i FROM docs WHERE len(tokens) >= 3))
SELECT context, target, COUNT(*) AS count FROM p GROUP BY 1, 2""")
def ngram_context(spark, d):
    return X.ngram_lm_pairs(_docs(spark, d), 3)


@query("context_centre", f"""WITH {DOCS},
p AS (SELECT array_to_string(list_concat(tokens[greatest(i - 2, 1):i - 1], tokens[i + 1:i + 2]), ' ') AS context, tokens[i] AS target
      FROM (SELECT tokens, unnest(range(1, len(tokens) + 1)) AS i FROM docs))
SELECT context, target, COUNT(*) AS count FROM p GROUP BY 1, 2""")
def context_centre(spark, d):
    return X.context_centre_pairs(_docs(spark, d), 2)


@query("negative_table", f"""WITH {DOCS}, {TOK}, {COUNTS}, {sql_vocab(V)},
v AS (SELECT token, id, count, pow(count, 0.75) AS w FROM vocab WHERE count IS NOT NULL),
c AS (SELECT *, SUM(w) OVER () AS tot, SUM(w) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM v)
SELECT token, id, count, round(w / tot, 9) AS share, round((cum - w) / tot, 9) AS lo, round(cum / tot, 9) AS hi FROM c""")
def negative_table(spark, d):
    t = X.negative_table(X.build_vocab(_docs(spark, d), V))
    return t.select("token", "id", "count", *[fround(c, 9).alias(c) for c in ("share", "lo", "hi")])


BOW = f"""bow AS (SELECT p.doc_id, v.id, COUNT(*) AS count FROM ptok p JOIN vocab v ON v.token = p.token
                 GROUP BY 1, 2)"""


@query("bow", f"WITH {DOCS}, {TOK}, {COUNTS}, {sql_vocab(V)}, {POSTOK}, {BOW} SELECT doc_id, id, count FROM bow")
def bow(spark, d):
    docs = _docs(spark, d)
    vocab = X.build_vocab(docs, V)
    tf = X.term_freq(docs).join(F.broadcast(vocab.select("token", "id")), "token")
    return tf.select("doc_id", "id", F.col("tf").alias("count"))


@query("libsvm_lines", f"""WITH {DOCS}, {TOK}, {COUNTS}, {sql_vocab(V)}, {POSTOK}, {BOW},
feats AS (SELECT doc_id, string_agg(id || ':' || count, ' ' ORDER BY id) AS f FROM bow GROUP BY 1)
SELECT l.doc_id, CAST(l.quality AS VARCHAR) || CASE WHEN f.f IS NULL THEN '' ELSE ' ' || f.f END AS line
FROM labels l JOIN documents dd ON dd.doc_id = l.doc_id LEFT JOIN feats f ON f.doc_id = l.doc_id""")
def libsvm_lines(spark, d):
    from tidemark.sources import formats

    docs = _docs(spark, d)
    vocab = X.build_vocab(docs, V)
    tf = X.term_freq(docs).join(F.broadcast(vocab.select("token", "id")), "token")
    labels = views.table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    labelled = labels.join(docs.select("doc_id"), "doc_id")
    return formats.libsvm_lines(labelled, tf.select("doc_id", "id", F.col("tf").alias("count")))


@query("fasttext_lines", f"""WITH {DOCS}
SELECT doc_id, array_to_string(tokens, ' ') || chr(9) || '__label__' || lang AS line FROM docs""")
def fasttext_lines(spark, d):
    from tidemark.sources import formats

    return formats.fasttext_lines(_docs(spark, d), "tokens", "lang")


@query("smooth_rate", """SELECT d.source, COUNT(*) AS n, CAST(SUM(l.quality) AS BIGINT) AS k,
       round((SUM(l.quality) + 1.0) / (COUNT(*) + 2.0), 6) AS rate
FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY 1""")
def smooth_rate(spark, d):
    from tidemark.operators import stats

    lab = views.table(spark, d, "labels").join(views.corpus(spark, d), "doc_id")
    r = stats.beta_binomial_rate(lab, "source", "quality", 1.0, 1.0)
    return r.withColumn("rate", fround("rate", 6))


@query("lang_shares", """WITH c AS (SELECT source, lang, COUNT(*) AS c FROM documents GROUP BY 1, 2),
k AS (SELECT COUNT(DISTINCT lang) AS k FROM documents)
SELECT source, lang, c, round((c + 1.0) / (SUM(c) OVER (PARTITION BY source) + k.k * 1.0), 6) AS share
FROM c CROSS JOIN k""")
def lang_shares(spark, d):
    from tidemark.operators import stats

    docs = views.corpus(spark, d)
    k = docs.select("lang").distinct().count()
    s = stats.dirichlet_shares(docs, "source", "lang", 1.0, k)
    return s.withColumn("share", fround("share", 6))


@query("unigram_ll", f"""WITH {DOCS}, {TOK}, {COUNTS},
tot AS (SELECT SUM(count) AS t FROM counts)
SELECT d.doc_id, CAST(len(d.tokens) AS INTEGER) AS n_tokens,
       round(COALESCE((SELECT SUM(ln(c.count / tot.t)) FROM tok JOIN counts c ON c.token = tok.token
                       WHERE tok.doc_id = d.doc_id), 0.0), 6) AS loglik
FROM docs d CROSS JOIN tot""")
def unigram_ll(spark, d):
    from tidemark.operators import stats

    docs = _docs(spark, d)
    return stats.unigram_loglik(docs, "tokens").withColumn("loglik", fround("loglik", 6))


@query("mask_tokens", f"""WITH {DOCS}, {TOK}, {COUNTS}, {sql_vocab(V)}, {POSTOK},
h AS (SELECT doc_id, pos, token, md5('7:' || doc_id || ':' || pos) AS h FROM ptok),
u AS (SELECT doc_id, pos, token,
             ('0x' || substr(h, 1, 8))::BIGINT / 4294967296.0 AS u1,
             ('0x' || substr(h, 9, 8))::BIGINT / 4294967296.0 AS u2,
             ('0x' || substr(h, 17, 8))::BIGINT AS r FROM h)
SELECT u.doc_id, u.pos, u.token,
       CASE WHEN u2 < 0.8 THEN '[MASK]' WHEN u2 < 0.9 THEN v.token ELSE u.token END AS replacement,
       CASE WHEN u2 < 0.8 THEN 'mask' WHEN u2 < 0.9 THEN 'random' ELSE 'keep' END AS action
FROM u LEFT JOIN vocab v ON v.id = 1 + (u.r % {V - 1})
WHERE u1 < 0.15""")
def mask_tokens(spark, d):
    docs = _docs(spark, d)
    vocab = X.build_vocab(docs, V)
    return X.mask_tokens(docs, vocab, seed=7, V=V)
