"""More corpus and sequence-preparation queries: page text, term filters,
perplexity, set similarity, probabilities, downsampling, seq2seq batches,
decoding, next-sentence pairs, GloVe cells, domain similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions import vectors as V
from tidemark.functions.hashing import md5_mod, md5_mod_sql
from tidemark.functions.numeric import fround
from tidemark.operators import dialogue as D
from tidemark.operators import evaluation as E
from tidemark.operators import stats
from tidemark.operators import text as X
from tidemark.plans import views
from tidemark.plans.scale import written
from tidemark.registry import query
from tidemark.registry.dialogue import PAIRS_SQL, tok_sql
from tidemark.registry.text import COUNTS, DOCS, TOK, _docs, _sql_window_pairs

ENT_SQL = [(e, c.replace("'", "''")) for e, c in X.HTML_ENTITIES]


def _html_sql(col: str) -> str:
    t = f"regexp_replace({col}, '(?is)<script[^>]*>.*?</script>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?is)<style[^>]*>.*?</style>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?s)<!--.*?-->', ' ', 'g')"
    t = f"regexp_replace({t}, '<[^>]*>', ' ', 'g')"
    for e, c in ENT_SQL:
        t = f"replace({t}, '{e}', '{c}')"
    return f"trim(regexp_replace({t}, '\\s+', ' ', 'g'))"


@query("html_to_text", f"SELECT page_id, {_html_sql('html')} AS text FROM pages")
def html_to_text(spark, d):
    return views.table(spark, d, "pages").select("page_id", X.html_to_text(F.col("html")).alias("text"))


LODDS_SQL = f"""{DOCS},
lab AS (SELECT d.doc_id, d.tokens, l.toxic = 1 AS flag FROM docs d JOIN labels l USING (doc_id)),
tot AS (SELECT SUM(CAST(flag AS BIGINT)) AS a_all, SUM(CAST(NOT flag AS BIGINT)) AS b_all FROM lab),
per AS (SELECT term, SUM(CAST(flag AS BIGINT)) AS a, SUM(CAST(NOT flag AS BIGINT)) AS b FROM (
          SELECT flag, unnest(list_distinct(tokens)) AS term FROM lab) GROUP BY 1 HAVING SUM(1) >= 3),
lo AS (SELECT term, a, b, ln((a + 1.0) / (tot.a_all - a + 1.0)) - ln((b + 1.0) / (tot.b_all - b + 1.0)) AS log_odds
       FROM per CROSS JOIN tot),
dict AS (SELECT term FROM lo ORDER BY round(log_odds, 9) DESC, term LIMIT 20)"""


def _toxic_dict(spark, d):
    docs = _docs(spark, d).join(views.table(spark, d, "labels").select("doc_id", (F.col("toxic") == 1).alias("flag")),
                                "doc_id")
    lo = X.term_log_odds(docs, "flag")
    return lo.orderBy(fround("log_odds", 9).desc(), "term").limit(20), docs


@query("toxic_terms", f"""WITH {LODDS_SQL}
SELECT term, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, round(log_odds, 6) AS log_odds FROM lo
WHERE term IN (SELECT term FROM dict)""")
def toxic_terms(spark, d):
    dic, _ = _toxic_dict(spark, d)
    return dic.select("term", "a", "b", fround("log_odds", 6).alias("log_odds"))


@query("filter_terms", f"""WITH {LODDS_SQL},
hits AS (SELECT doc_id, COUNT(*) AS hits, COUNT(DISTINCT term) AS distinct_terms FROM (
           SELECT doc_id, unnest(tokens) AS term FROM docs) WHERE term IN (SELECT term FROM dict) GROUP BY 1)
SELECT d.doc_id, COALESCE(h.hits, 0) AS hits, COALESCE(h.distinct_terms, 0) AS distinct_terms,
       COALESCE(h.hits, 0) > 0 AS flagged FROM docs d LEFT JOIN hits h USING (doc_id)""")
def filter_terms(spark, d):
    dic, _ = _toxic_dict(spark, d)
    return X.filter_terms(_docs(spark, d), dic)


@query("perplexity", f"""WITH {DOCS}, {TOK}, {COUNTS},
tot AS (SELECT SUM(count) AS t FROM counts),
ll AS (SELECT tok.doc_id, SUM(ln(c.count / tot.t)) AS ll FROM tok JOIN counts c USING (token) CROSS JOIN tot GROUP BY 1)
SELECT d.doc_id, round(CASE WHEN len(d.tokens) = 0 THEN NULL WHEN -ll.ll / len(d.tokens) < 300 THEN exp(-ll.ll / len(d.tokens))
                            ELSE 'Infinity'::DOUBLE END, 6) AS perplexity
FROM docs d LEFT JOIN ll USING (doc_id)""")
def perplexity(spark, d):
    ll = stats.unigram_loglik(_docs(spark, d), "tokens")
    loss = -F.col("loglik") / F.col("n_tokens")
    return ll.select("doc_id", fround(F.when(F.col("n_tokens") > 0, E.perplexity(loss)), 6).alias("perplexity"))


@query("qa_jaccard", f"""WITH {PAIRS_SQL},
t AS (SELECT conv_id, turn, list_distinct({tok_sql('question')}) AS a, list_distinct({tok_sql('answer')}) AS b FROM pairs)
SELECT conv_id, turn, round(CASE WHEN len(list_distinct(list_concat(a, b))) > 0 THEN
  len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END, 6) AS jaccard FROM t""")
def qa_jaccard(spark, d):
    p = D.qa_pairs(views.turns(spark, d))
    a, b = T.tokenize_ws(F.col("question")), T.tokenize_ws(F.col("answer"))
    return p.select("conv_id", "turn", fround(X.jaccard(F.array_distinct(a), F.array_distinct(b)), 6).alias("jaccard"))


@query("to_prob", """WITH x AS (SELECT vec_id AS id, list_transform(embedding, lambda v: 10.0 * v::DOUBLE) AS s FROM embeddings),
y AS (SELECT id, s, list_max(s) AS m FROM x),
z AS (SELECT id, s, list_transform(s, lambda v: exp(v - m)) AS ex FROM y)
SELECT id, round(1.0 / (1.0 + exp(-s[1])), 6) AS sigmoid_first,
       round(list_max(ex) / list_sum(ex), 6) AS p_max,
       CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS argmax FROM z""")
def to_prob(spark, d):
    v = views.vectors(spark, d).select("id", F.transform("embedding", lambda x: 10.0 * x.cast("double")).alias("s"))
    sm = V.softmax(F.col("s"))
    return v.select("id", fround(V.sigmoid(F.col("s")[0]), 6).alias("sigmoid_first"),
                    fround(F.array_max(sm), 6).alias("p_max"),
                    (F.array_position("s", F.array_max("s")) - 1).cast("int").alias("argmax"))


@query("downsample", f"""WITH l AS (SELECT doc_id, quality FROM labels),
c AS (SELECT quality, COUNT(*) AS n FROM l GROUP BY 1),
m AS (SELECT min(n) AS mn FROM c)
SELECT l.doc_id, l.quality FROM l JOIN c USING (quality) CROSS JOIN m
WHERE ({md5_mod_sql("'3:' || CAST(l.doc_id AS VARCHAR)", 1000000)}) / 1000000.0 < m.mn / c.n""")
def downsample(spark, d):
    """Keep each class with probability min_count / class_count (md5
    uniform), so every class ends near the minority size."""
    lab = views.table(spark, d, "labels").select("doc_id", "quality")
    c = lab.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    mn = c.agg(F.min("n")).first()[0]
    u = md5_mod(F.concat(F.lit("3:"), F.col("doc_id").cast("string")), 1000000) / F.lit(1000000.0)
    return lab.join(c, "quality").filter(u < F.lit(float(mn)) / F.col("n")).select("doc_id", "quality")


CONV_VOCAB_SPECIAL = f"""ct AS (SELECT unnest({tok_sql('text')}) AS token FROM conversations),
cc AS (SELECT token, COUNT(*) AS count FROM ct GROUP BY 1),
vocab AS (
  SELECT * FROM (VALUES ('_PAD', 0), ('_GO', 1), ('_EOS', 2), ('_UNK', 3)) s(token, id)
  UNION ALL
  SELECT token, CAST(row_number() OVER (ORDER BY count DESC, token) + 3 AS INTEGER) AS id FROM cc QUALIFY id < 2000)"""


def _enc_side_sql(side: str) -> str:
    return f"""e_{side} AS (
  SELECT conv_id, turn, list(COALESCE(v.id, 3) ORDER BY pos) AS ids FROM (
    SELECT conv_id, turn, unnest({side}) AS token, unnest(range(len({side}))) AS pos FROM tp WHERE len({side}) > 0) x
  LEFT JOIN vocab v USING (token) GROUP BY 1, 2)"""


def _conv_vocab(spark, d):
    from pyspark.sql import Window

    turns = views.turns(spark, d).select(T.tokenize_ws(F.col("text")).alias("tokens"))
    counts = X.token_counts(turns)
    top = counts.orderBy(F.col("count").desc(), F.col("token")).limit(2000 - 4)
    words = top.select("token", (F.row_number().over(Window.orderBy(F.col("count").desc(), F.col("token"))) + 3)
                       .cast("int").alias("id"))
    specials = spark.createDataFrame([(t, i) for i, t in enumerate(T.SPECIAL_TOKENS)], "token string, id int")
    return specials.unionByName(words)


def _encoded_pairs(spark, d):
    p = D.qa_pairs(views.turns(spark, d)).select(
        "conv_id", "turn", T.tokenize_ws(F.col("question")).alias("a"), T.tokenize_ws(F.col("answer")).alias("b"))
    vocab = _conv_vocab(spark, d)
    key = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    p = p.withColumn("k", key)
    ea = X.encode(p.select("k", F.col("a").alias("tokens")), vocab, unk=T.UNK_ID, key="k").withColumnRenamed("ids", "ia")
    eb = X.encode(p.select("k", F.col("b").alias("tokens")), vocab, unk=T.UNK_ID, key="k").withColumnRenamed("ids", "ib")
    return p.join(ea, "k").join(eb, "k"), vocab


@query("seq2seq_batch", f"""WITH {PAIRS_SQL}, {CONV_VOCAB_SPECIAL},
tp AS (SELECT conv_id, turn, {tok_sql('question')} AS a, {tok_sql('answer')} AS b FROM pairs),
{_enc_side_sql('a')}, {_enc_side_sql('b')},
j AS (SELECT tp.conv_id, tp.turn, COALESCE(ea.ids, []) AS ia, list_append(COALESCE(eb.ids, []), 2) AS ib
      FROM tp LEFT JOIN e_a ea USING (conv_id, turn) LEFT JOIN e_b eb USING (conv_id, turn)),
bk AS (SELECT *, CASE {' '.join(f"WHEN len(ia) < {s} AND len(ib) < {t} THEN {i}" for i, (s, t) in enumerate(D.BUCKETS))} END AS bucket FROM j),
sz AS (SELECT *, {' '.join(['CASE'] + [f"WHEN bucket = {i} THEN {s}" for i, (s, _) in enumerate(D.BUCKETS)] + ['END'])} AS es,
                 {' '.join(['CASE'] + [f"WHEN bucket = {i} THEN {t}" for i, (_, t) in enumerate(D.BUCKETS)] + ['END'])} AS ds
       FROM bk WHERE bucket IS NOT NULL),
b AS (SELECT conv_id, turn, bucket,
             list_reverse(list_concat(ia, list_transform(range(greatest(es - len(ia), 0)), lambda x: 0))) AS enc,
             list_concat([1], ib, list_transform(range(greatest(ds - len(ib) - 1, 0)), lambda x: 0)) AS dec, ds FROM sz)
SELECT conv_id, turn, bucket, array_to_string(enc, ' ') AS encoder_inputs, array_to_string(dec, ' ') AS decoder_inputs,
       array_to_string(list_transform(range(1, len(dec) + 1), lambda i: CASE WHEN i < ds AND dec[i + 1] <> 0 THEN 1.0 ELSE 0.0 END), ' ')
         AS target_weights
FROM b""")
def seq2seq_batch(spark, d):
    """F21 on the length buckets of F22: target ids end with EOS."""
    p, _ = _encoded_pairs(spark, d)
    p = p.withColumn("ib", F.concat(F.col("ib"), F.array(F.lit(T.EOS_ID))))
    p = p.withColumn("bucket", D.bucket_id(F.size("ia"), F.size("ib") - 1)).filter(F.col("bucket").isNotNull())
    outs = []
    for i, (s, t) in enumerate(D.BUCKETS):
        enc, dec, w = X.seq2seq_batch(F.col("ia"), F.col("ib"), s, t)
        outs.append(p.filter(F.col("bucket") == i).select(
            "conv_id", "turn", "bucket", F.array_join(enc, " ").alias("encoder_inputs"),
            F.array_join(dec, " ").alias("decoder_inputs"),
            F.array_join(F.transform(w, lambda x: F.format_number(x, 1)), " ").alias("target_weights")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


@query("decode_ids", f"""WITH {PAIRS_SQL}, {CONV_VOCAB_SPECIAL},
tp AS (SELECT conv_id, turn, {tok_sql('question')} AS a, {tok_sql('answer')} AS b FROM pairs),
{_enc_side_sql('b')},
dec AS (SELECT e.conv_id, e.turn, list(v.token ORDER BY x.pos) AS toks FROM e_b e,
          LATERAL (SELECT unnest(e.ids) AS id, unnest(range(len(e.ids))) AS pos) x JOIN vocab v ON v.id = x.id GROUP BY 1, 2)
SELECT tp.conv_id, tp.turn, array_to_string(COALESCE(dec.toks, []), ' ') AS text FROM tp LEFT JOIN dec USING (conv_id, turn)""")
def decode_ids(spark, d):
    """the answer ids decoded back to tokens (OOV shows as _UNK)."""
    p, vocab = _encoded_pairs(spark, d)
    dec = X.decode_ids(p.select("k", F.col("ib").alias("ids")), vocab, key="k", eos=T.EOS_ID)
    j = p.select("k", "conv_id", "turn").join(dec, "k")
    return j.select("conv_id", "turn", F.array_join("tokens", " ").alias("text"))


@query("glove_cells", f"""WITH {DOCS}, pairs AS ({_sql_window_pairs(2)}),
c AS (SELECT w1, w2, SUM(1.0 / d) AS x FROM pairs GROUP BY 1, 2)
SELECT w1, w2, round(x, 6) AS x, round(least(1.0, pow(x / 100.0, 0.75)), 6) AS f, round(ln(x), 6) AS target FROM c WHERE x > 0""")
def glove_cells(spark, d):
    g = X.glove_cells(X.cooccurrence(_docs(spark, d), window=2))
    return g.select("w1", "w2", fround("x", 6).alias("x"), fround("f", 6).alias("f"), fround("target", 6).alias("target"))


@query("domain_similarity", f"""WITH {DOCS}, {TOK}, {COUNTS},
src AS (SELECT d.source, t.token, COUNT(*) AS c FROM tok t JOIN docs d USING (doc_id) GROUP BY 1, 2),
st AS (SELECT source, SUM(c) AS n, sqrt(SUM(c * c)) AS norm FROM src GROUP BY 1),
g AS (SELECT SUM(count) AS n, sqrt(SUM(count * count)) AS norm FROM counts),
dotp AS (SELECT s.source, SUM(s.c * c.count) AS dp,
                SUM((s.c / st.n) * ln((s.c / st.n) / (c.count / g.n))) AS kl
         FROM src s JOIN counts c USING (token) JOIN st USING (source) CROSS JOIN g GROUP BY 1)
SELECT dotp.source, round(dp / (st.norm * g.norm), 6) AS cosine, round(kl, 6) AS kl
FROM dotp JOIN st USING (source) CROSS JOIN g""")
def domain_similarity(spark, d):
    """Each source's term distribution against the whole corpus: cosine
    and KL(source || corpus) over shared terms."""
    docs = _docs(spark, d)
    tf = written(docs.select("source", F.explode("tokens").alias("token")).groupBy("source", "token").agg(
        F.count(F.lit(1)).alias("c")))
    allc = tf.groupBy("token").agg(F.sum("c").alias("count"))  # the corpus is read once
    g = allc.agg(F.sum("count").alias("n"), F.sqrt(F.sum(F.col("count") * F.col("count"))).alias("norm")).first()
    st = tf.groupBy("source").agg(F.sum("c").alias("n"), F.sqrt(F.sum(F.col("c") * F.col("c"))).alias("norm"))
    j = tf.join(allc, "token").join(st, "source")
    ps = F.col("c") / F.col("n")
    pg = F.col("count") / F.lit(float(g["n"]))
    agg = j.groupBy("source").agg(F.sum(F.col("c") * F.col("count")).alias("dp"), F.sum(ps * F.log(ps / pg)).alias("kl"),
                                  F.max("norm").alias("norm"))
    return agg.select("source", fround(F.col("dp") / (F.col("norm") * F.lit(float(g["norm"]))), 6).alias("cosine"),
                      fround("kl", 6).alias("kl"))


@query("instance_weights", """WITH b AS (SELECT doc_id, least(CAST(floor(log10(greatest(n_chars, 1))) AS INTEGER), 5) AS band,
                  doc_id IN (SELECT doc_id FROM labels) AS target FROM documents),
s AS (SELECT band, COUNT(*) / (SELECT COUNT(*) FROM b) AS src_share FROM b GROUP BY 1),
t AS (SELECT band, COUNT(*) / (SELECT COUNT(*) FROM b WHERE target) AS tgt_share FROM b WHERE target GROUP BY 1)
SELECT s.band, round(s.src_share, 6) AS src_share, round(COALESCE(t.tgt_share, 0.0), 6) AS tgt_share,
       round(COALESCE(t.tgt_share, 0.0) / s.src_share, 6) AS weight FROM s LEFT JOIN t USING (band)""")
def instance_weights(spark, d):
    """Importance weights target share / source share per length band
    (source = the corpus, target = the labelled documents)."""
    docs = views.table(spark, d, "documents").select("doc_id", "n_chars")
    lab = views.table(spark, d, "labels").select("doc_id", F.lit(True).alias("target"))
    b = docs.join(lab, "doc_id", "left").select(
        F.least(F.floor(F.log10(F.greatest("n_chars", F.lit(1)))).cast("int"), F.lit(5)).alias("band"),
        F.coalesce("target", F.lit(False)).alias("target"))
    tot = b.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("target").cast("bigint")).alias("nt")).first()
    g = b.groupBy("band").agg((F.count(F.lit(1)) / F.lit(float(tot["n"]))).alias("src_share"),
                              (F.sum(F.col("target").cast("bigint")) / F.lit(float(tot["nt"]))).alias("tgt_share"))
    return g.select("band", fround("src_share", 6).alias("src_share"), fround("tgt_share", 6).alias("tgt_share"),
                    fround(F.col("tgt_share") / F.col("src_share"), 6).alias("weight"))


@query("nsp_pairs", r"""WITH l AS (
  SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?\n]'), lambda x: trim(x)),
                             lambda x: x <> '') AS sents FROM documents),
s AS (SELECT doc_id, CAST(unnest(range(1, len(sents) + 1)) AS INTEGER) AS sent_pos, unnest(sents) AS sentence FROM l),
p AS (SELECT *, row_number() OVER (ORDER BY doc_id, sent_pos) - 1 AS place, COUNT(*) OVER (PARTITION BY doc_id) AS n,
        COUNT(*) OVER () AS total, md5('5:' || doc_id || ':' || sent_pos) AS h FROM s),
r AS (SELECT *, CASE WHEN ('0x' || substr(h, 1, 8))::BIGINT < 2147483648 THEN 1 ELSE 0 END AS is_next,
        ('0x' || substr(h, 9, 15))::BIGINT % nullif(total - n, 0) AS draw FROM p WHERE sent_pos < n),
t AS (SELECT *, CASE WHEN is_next = 1 THEN place + 1 WHEN draw < place - sent_pos + 1 THEN draw ELSE draw + n END AS partner
      FROM r)
SELECT t.doc_id, t.sent_pos, t.sentence AS a, p.sentence AS b, t.is_next FROM t JOIN p ON p.place = t.partner""")
def nsp_pairs(spark, d):
    """next sentence pairs, half true successors, half sentences of
    other documents."""
    s = views.corpus(spark, d).select("doc_id", T.sentences(F.col("text")).alias("s"))
    sents = s.select("doc_id", F.posexplode("s").alias("sent_pos", "sentence")).withColumn("sent_pos", F.col("sent_pos") + 1)
    return X.nsp_pairs(sents)


@query("wordpiece")
def wordpiece(spark, d):
    """F16 + F17 (rows-only): BERT-style pre-tokenisation of the corpus and
    greedy longest-match word pieces against a corpus-derived vocabulary of
    at most 2000 words + characters + 3000 continuation pieces; every token
    must re-assemble from its pieces unless it is [UNK] (asserted)."""
    from tidemark.functions.wordpiece import UNK, basic_pretokenize

    docs = written(views.corpus(spark, d).select("doc_id", basic_pretokenize(F.col("text")).alias("tokens")))
    vocab = [r["piece"] for r in X.wordpiece_vocab(docs, 2000, 3000).collect()]  # bounded: <= 5000 + chars
    wp = X.wordpiece(docs, vocab)
    # pieces depend on the word alone: each distinct word is checked
    words = X.wordpiece(docs.select(F.explode("tokens").alias("word")).distinct().select("word", F.array("word").alias("tokens")), vocab, key="word")
    joined = F.array_join(F.transform("pieces", lambda p: F.regexp_replace(p, "^##", "")), "")
    bad = words.filter((F.element_at("pieces", 1) != UNK) & (joined != F.col("token"))).limit(1).count()
    if bad:
        raise AssertionError("word pieces do not re-assemble the token")
    return wp.select("doc_id", "pos", "token", F.array_join("pieces", " ").alias("pieces"))
