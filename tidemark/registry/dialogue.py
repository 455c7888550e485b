"""Dialogue / QA queries over `conversations`, `benchmark` (knowledge base)
and `documents` (questions with passage ground truth)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions.numeric import fround
from tidemark.operators import dialogue as D
from tidemark.operators import segment as SEG
from tidemark.operators import text as X
from tidemark.plans import views
from tidemark.registry import query

MAX_LEN = 128
V_CONV = 2000
TOP_K = 3
THRESHOLD = 8.0


def tok_sql(col: str) -> str:
    return (f"list_filter(string_split(trim(regexp_replace(lower({col}), '\\s+', ' ', 'g')), ' '), "
            f"lambda w: w <> '')")


PAIRS_SQL = """pairs AS (
  SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer
  FROM conversations q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
  WHERE q.role = 'user' AND a.role = 'assistant')"""


def _pairs(spark, d):
    return D.qa_pairs(views.turns(spark, d))


def _tok_pairs(spark, d):
    return _pairs(spark, d).select(
        "conv_id", "turn", T.tokenize_ws(F.col("question")).alias("a"), T.tokenize_ws(F.col("answer")).alias("b"))


@query("qa_pairs", f"WITH {PAIRS_SQL} SELECT * FROM pairs")
def qa_pairs(spark, d):
    return _pairs(spark, d)


@query("split_dialogue", """SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer
FROM conversations q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
WHERE q.turn % 2 = 0 AND a.turn % 2 = 1""")
def split_dialogue(spark, d):
    return D.split_dialogue(views.turns(spark, d))


@query("trailing_context", """SELECT t.conv_id, t.turn, CAST(COUNT(h.turn) AS INTEGER) AS n_context,
  md5(COALESCE(string_agg(h.role || ': ' || h.text, chr(10) ORDER BY h.turn), '')) AS context_md5
FROM conversations t LEFT JOIN conversations h ON h.conv_id = t.conv_id AND h.turn BETWEEN t.turn - 3 AND t.turn - 1
GROUP BY 1, 2""")
def trailing_context(spark, d):
    c = D.trailing_context(views.turns(spark, d), 3)
    lines = F.transform("context", lambda h: F.concat(h["role"], F.lit(": "), h["text"]))
    return c.select("conv_id", "turn", F.size("context").alias("n_context"),
                    F.md5(F.array_join(lines, "\n")).alias("context_md5"))


def _trunc_sql(L: int) -> str:
    T_ = L - 3
    return f"""tp AS (SELECT conv_id, turn, {tok_sql('question')} AS a, {tok_sql('answer')} AS b FROM pairs),
ln AS (SELECT *, len(a) AS la, len(b) AS lb, greatest(len(a) + len(b) - {T_}, 0) AS ex,
              abs(len(a) - len(b)) AS dd, least(len(a), len(b)) AS m FROM tp),
tr AS (SELECT conv_id, turn, a, b,
  CASE WHEN ex = 0 THEN la WHEN la > lb THEN (CASE WHEN ex <= dd THEN la - ex ELSE m - floor((ex - dd) / 2) END)
       ELSE (CASE WHEN ex <= dd THEN la ELSE m - floor((ex - dd) / 2) END) END AS na,
  CASE WHEN ex = 0 THEN lb WHEN lb > la THEN (CASE WHEN ex <= dd THEN lb - ex ELSE m - ceil((ex - dd) / 2) END)
       WHEN la > lb THEN (CASE WHEN ex <= dd THEN lb ELSE m - ceil((ex - dd) / 2) END)
       ELSE m - ceil(ex / 2) END AS nb FROM ln),
tt AS (SELECT conv_id, turn, a[1:CAST(na AS INTEGER)] AS a, b[1:CAST(nb AS INTEGER)] AS b FROM tr)"""


@query("truncate_pair", f"""WITH {PAIRS_SQL}, {_trunc_sql(MAX_LEN)}
SELECT conv_id, turn, CAST(len(a) AS INTEGER) AS len_a, CAST(len(b) AS INTEGER) AS len_b,
       md5(array_to_string(a, ' ')) AS a_md5, md5(array_to_string(b, ' ')) AS b_md5 FROM tt""")
def truncate_pair(spark, d):
    p = _tok_pairs(spark, d)
    a, b = D.truncate_pair(F.col("a"), F.col("b"), MAX_LEN)
    t = p.select("conv_id", "turn", a.alias("a"), b.alias("b"))
    return t.select("conv_id", "turn", F.size("a").alias("len_a"), F.size("b").alias("len_b"),
                    F.md5(F.array_join("a", " ")).alias("a_md5"), F.md5(F.array_join("b", " ")).alias("b_md5"))


CONV_VOCAB_SQL = f"""ct AS (SELECT unnest({tok_sql('text')}) AS token FROM conversations),
cc AS (SELECT token, COUNT(*) AS c FROM ct GROUP BY 1),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY c DESC, token) + 4 AS INTEGER) AS id FROM cc
          QUALIFY id < {V_CONV})"""


def _enc_sql(side: str) -> str:
    return f"""e_{side} AS (
  SELECT conv_id, turn, list(COALESCE(v.id, 1) ORDER BY pos) AS ids FROM (
    SELECT conv_id, turn, unnest({side}) AS token, unnest(range(len({side}))) AS pos FROM tt WHERE len({side}) > 0) x
  LEFT JOIN vocab v USING (token) GROUP BY 1, 2)"""


@query("bert_features", f"""WITH {PAIRS_SQL}, {_trunc_sql(MAX_LEN)}, {CONV_VOCAB_SQL}, {_enc_sql('a')}, {_enc_sql('b')},
f AS (SELECT tt.conv_id, tt.turn,
             list_concat([2], COALESCE(ea.ids, []), [3], COALESCE(eb.ids, []), [3]) AS ids,
             len(tt.a) AS la, len(tt.b) AS lb
      FROM tt LEFT JOIN e_a ea USING (conv_id, turn) LEFT JOIN e_b eb USING (conv_id, turn))
SELECT conv_id, turn,
  array_to_string(list_concat(ids, list_transform(range(greatest({MAX_LEN} - len(ids), 0)), lambda x: 0)), ' ') AS input_ids,
  array_to_string(list_concat(list_transform(range(la + 2), lambda x: 0), list_transform(range(lb + 1), lambda x: 1),
                              list_transform(range(greatest({MAX_LEN} - len(ids), 0)), lambda x: 0)), ' ') AS segment_ids,
  array_to_string(list_concat(list_transform(range(len(ids)), lambda x: 1),
                              list_transform(range(greatest({MAX_LEN} - len(ids), 0)), lambda x: 0)), ' ') AS input_mask
FROM f""")
def bert_features(spark, d):
    turns = views.turns(spark, d).select(T.tokenize_ws(F.col("text")).alias("tokens"))
    counts = X.token_counts(turns)
    top = counts.orderBy(F.col("count").desc(), F.col("token")).limit(V_CONV - 5)
    from pyspark.sql import Window

    vocab = top.select("token", (F.row_number().over(Window.orderBy(F.col("count").desc(), F.col("token"))) + 4)
                       .cast("int").alias("id"))
    p = _tok_pairs(spark, d)
    a, b = D.truncate_pair(F.col("a"), F.col("b"), MAX_LEN)
    t = p.select("conv_id", "turn", a.alias("a"), b.alias("b"))
    key = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    ea = X.encode(t.withColumn("k", key).select("k", F.col("a").alias("tokens")), vocab, unk=1, key="k")
    eb = X.encode(t.withColumn("k", key).select("k", F.col("b").alias("tokens")), vocab, unk=1, key="k")
    j = t.withColumn("k", key).join(ea.withColumnRenamed("ids", "ia"), "k").join(eb.withColumnRenamed("ids", "ib"), "k")
    ids, seg, mask = D.to_features(F.col("ia"), F.col("ib"), MAX_LEN, cls_id=2, sep_id=3)
    return j.select("conv_id", "turn", F.array_join(ids, " ").alias("input_ids"),
                    F.array_join(seg, " ").alias("segment_ids"), F.array_join(mask, " ").alias("input_mask"))


@query("bucket_pairs", f"""WITH {PAIRS_SQL},
l AS (SELECT conv_id, turn, CAST(len({tok_sql('question')}) AS INTEGER) AS src_len,
             CAST(len({tok_sql('answer')}) AS INTEGER) AS tgt_len FROM pairs),
b AS (SELECT *, CASE {' '.join(f"WHEN src_len < {s} AND tgt_len + 1 < {t} THEN {i}" for i, (s, t) in enumerate(D.BUCKETS))} END AS bucket FROM l)
SELECT * FROM b WHERE bucket IS NOT NULL""")
def bucket_pairs(spark, d):
    p = _tok_pairs(spark, d).select("conv_id", "turn", F.size("a").alias("src_len"), F.size("b").alias("tgt_len"))
    return p.withColumn("bucket", D.bucket_id(F.col("src_len"), F.col("tgt_len"))).filter(F.col("bucket").isNotNull())


@query("length_hist", f"""WITH {PAIRS_SQL},
l AS (SELECT len({tok_sql('question')}) AS s, len({tok_sql('answer')}) + 1 AS t FROM pairs)
SELECT 'source' AS side, CAST(s // 10 AS INTEGER) AS bin, COUNT(*) AS n FROM l GROUP BY 1, 2
UNION ALL SELECT 'target', CAST(t // 10 AS INTEGER), COUNT(*) FROM l GROUP BY 1, 2""")
def length_hist(spark, d):
    p = _tok_pairs(spark, d)
    src = p.select(F.lit("source").alias("side"), F.floor(F.size("a") / 10).cast("int").alias("bin"))
    tgt = p.select(F.lit("target").alias("side"), F.floor((F.size("b") + 1) / 10).cast("int").alias("bin"))
    return src.unionByName(tgt).groupBy("side", "bin").agg(F.count(F.lit(1)).alias("n"))


@query("length_stats", f"""WITH {PAIRS_SQL},
l AS (SELECT len({tok_sql('question')}) AS s, len({tok_sql('answer')}) + 1 AS t FROM pairs)
SELECT 'source' AS side, round(avg(s), 6) AS mean, round(stddev_pop(s), 6) AS std FROM l
UNION ALL SELECT 'target', round(avg(t), 6), round(stddev_pop(t), 6) FROM l""")
def length_stats(spark, d):
    p = _tok_pairs(spark, d)
    src = p.select(F.lit("source").alias("side"), F.size("a").alias("x"))
    tgt = p.select(F.lit("target").alias("side"), (F.size("b") + 1).alias("x"))
    return src.unionByName(tgt).groupBy("side").agg(fround(F.avg("x"), 6).alias("mean"),
                                                    fround(F.stddev_pop("x"), 6).alias("std"))


BM25_SQL = f"""kbt AS (SELECT item_id, {tok_sql('text')} AS tokens FROM benchmark),
post AS (SELECT term, item_id, dl, COUNT(*) AS tf FROM (
           SELECT item_id, len(tokens) AS dl, unnest(tokens) AS term FROM kbt) GROUP BY ALL),
st AS (SELECT COUNT(*) AS n, avg(len(tokens)) AS avgdl FROM kbt),
dfq AS (SELECT term, COUNT(*) AS df FROM post GROUP BY 1),
w AS (SELECT p.term, p.item_id,
             ln(1 + (st.n - dfq.df + 0.5) / (dfq.df + 0.5)) * p.tf * {D.BM25_K1 + 1}
             / (p.tf + {D.BM25_K1} * ({1 - D.BM25_B} + {D.BM25_B} * p.dl / st.avgdl)) AS w
      FROM post p JOIN dfq USING (term) CROSS JOIN st)"""


def _bm25_sql(qsrc: str) -> str:
    return f"""{BM25_SQL},
qt AS (SELECT DISTINCT qid, unnest(tokens) AS term FROM ({qsrc})),
sc AS (SELECT qid, item_id, SUM(w) AS score FROM qt JOIN w USING (term) GROUP BY 1, 2),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, item_id) AS rank
           FROM sc) WHERE rank <= {TOP_K})"""


USER_Q_SQL = f"SELECT conv_id * 1000 + turn AS qid, {tok_sql('text')} AS tokens FROM conversations WHERE role = 'user'"


def _kb(spark, d):
    return views.kb(spark, d).select("item_id", T.tokenize_ws(F.col("text")).alias("tokens"))


def _user_q(spark, d):
    t = views.turns(spark, d).filter(F.col("role") == "user")
    return t.select((F.col("conv_id") * 1000 + F.col("turn")).alias("qid"), T.tokenize_ws(F.col("text")).alias("tokens"))


@query("bm25_retrieve", f"WITH {_bm25_sql(USER_Q_SQL)} SELECT qid, item_id, round(score, 6) AS score, rank FROM ranked")
def bm25_retrieve(spark, d):
    r = D.bm25_search(_user_q(spark, d), "qid", "tokens", _kb(spark, d), "item_id", "tokens", TOP_K)
    return r.select("qid", "item_id", fround("score", 6).alias("score"), "rank")


@query("qa_answer", f"""WITH {_bm25_sql(USER_Q_SQL)},
top AS (SELECT qid, score >= {THRESHOLD} AS answered FROM ranked WHERE rank = 1)
SELECT r.qid, r.item_id, round(r.score, 6) AS score, r.rank, t.answered FROM ranked r JOIN top t USING (qid)
WHERE NOT t.answered OR r.rank = 1""")
def qa_answer(spark, d):
    r = D.bm25_search(_user_q(spark, d), "qid", "tokens", _kb(spark, d), "item_id", "tokens", TOP_K)
    a = D.answer(r, "qid", THRESHOLD)
    return a.select("qid", "item_id", fround("score", 6).alias("score"), "rank", "answered")


@query("select_answers", f"""WITH {_bm25_sql(USER_Q_SQL)},
kb AS (SELECT item_id, {tok_sql('text')} AS tokens FROM benchmark),
near AS (
  SELECT r.qid, r.item_id, len(list_intersect(list_distinct(u.tokens), kb.tokens)) / len(list_distinct(list_concat(u.tokens, kb.tokens))) AS score
  FROM ranked r JOIN ({USER_Q_SQL}) u USING (qid) JOIN kb USING (item_id)),
c AS (SELECT qid, item_id, 0.7 * score / (SELECT max(score) FROM ranked) AS s FROM ranked
      UNION ALL SELECT qid, item_id, 0.3 * score / (SELECT max(score) FROM near) FROM near),
f AS (SELECT qid, item_id, SUM(s) AS score, COUNT(*) AS sources FROM c GROUP BY 1, 2)
SELECT qid, item_id, round(score, 6) AS score, sources FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, item_id) AS r FROM f) WHERE r = 1""")
def select_answers(spark, d):
    """The answer of each user turn by retrieval score and word overlap together."""
    from tidemark.operators import evaluation as E
    from tidemark.plans.scale import written

    q, kb = _user_q(spark, d), _kb(spark, d)
    found = written(D.bm25_search(q, "qid", "tokens", kb, "item_id", "tokens", TOP_K).select("qid", "item_id", "score"))
    both = found.select("qid", "item_id").join(q, "qid").join(kb.withColumnRenamed("tokens", "kb_tokens"), "item_id")
    near = both.select("qid", "item_id", F.lit("overlap").alias("source"), X.jaccard(F.col("tokens"), F.col("kb_tokens")).alias("score"))
    out = E.select_answers(found.select("qid", "item_id", F.lit("search").alias("source"), "score").unionByName(near), "qid", "item_id", {"search": 0.7, "overlap": 0.3})
    return out.withColumn("score", fround("score", 6))


@query("bleu", f"""WITH {_bm25_sql(USER_Q_SQL)}, {PAIRS_SQL},
bp AS (SELECT p.conv_id, p.turn, {tok_sql('p.answer')} AS label, {tok_sql('b.text')} AS pred
       FROM pairs p JOIN ranked r ON r.qid = p.conv_id * 1000 + p.turn AND r.rank = 1
       JOIN benchmark b ON b.item_id = r.item_id),
ng AS (SELECT conv_id, turn, n, side, g, COUNT(*) AS c FROM (
         SELECT conv_id, turn, n, 'p' AS side,
                unnest(list_transform(range(1, len(pred) - n + 2), lambda i: array_to_string(pred[i:i + n - 1], ' '))) AS g
         FROM bp, range(1, 5) r(n) WHERE len(pred) >= n
         UNION ALL
         SELECT conv_id, turn, n, 'l',
                unnest(list_transform(range(1, len(label) - n + 2), lambda i: array_to_string(label[i:i + n - 1], ' ')))
         FROM bp, range(1, 5) r(n) WHERE len(label) >= n) GROUP BY ALL),
m AS (SELECT p.conv_id, p.turn, p.n, SUM(least(p.c, COALESCE(l.c, 0))) / SUM(p.c) AS pn
      FROM ng p LEFT JOIN ng l ON l.conv_id = p.conv_id AND l.turn = p.turn AND l.n = p.n AND l.g = p.g AND l.side = 'l'
      WHERE p.side = 'p' GROUP BY 1, 2, 3),
wide AS (SELECT bp.conv_id, bp.turn, len(label) AS len_label, len(pred) AS len_pred,
             {', '.join(f"COALESCE(max(CASE WHEN m.n = {i} THEN m.pn END), 0.0) AS p{i}" for i in range(1, 5))}
      FROM bp LEFT JOIN m USING (conv_id, turn) GROUP BY 1, 2, 3, 4)
SELECT conv_id, turn, CAST(len_label AS INTEGER) AS len_label, CAST(len_pred AS INTEGER) AS len_pred,
       {', '.join(f"round(p{i}, 6) AS p{i}" for i in range(1, 5))},
       round(CASE WHEN len_pred > 0 THEN exp(least(0.0, 1 - len_label / len_pred)) ELSE 0.0 END
             * {' * '.join(f'pow(p{i}, {1.0 / 2 ** i})' for i in range(1, 5))}, 6) AS bleu
FROM wide""")
def bleu(spark, d):
    r = D.bm25_search(_user_q(spark, d), "qid", "tokens", views.kb(spark, d).select(
        "item_id", T.tokenize_ws(F.col("text")).alias("tokens")), "item_id", "tokens", TOP_K).filter(F.col("rank") == 1)
    p = _pairs(spark, d).withColumn("qid", F.col("conv_id") * 1000 + F.col("turn"))
    kbt = views.kb(spark, d).select("item_id", T.tokenize_ws(F.col("text")).alias("pred"))
    bp = p.join(r.select("qid", "item_id"), "qid").join(kbt, "item_id").select(
        "conv_id", "turn", T.tokenize_ws(F.col("answer")).alias("label"), "pred")
    b = D.bleu(bp, ["conv_id", "turn"], "label", "pred")
    return b.select("conv_id", "turn", "len_label", "len_pred",
                    *[fround(f"p{i}", 6).alias(f"p{i}") for i in range(1, 5)], fround("bleu", 6).alias("bleu"))


TRUTH_SQL = "truth AS (SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text))"


@query("passage_truth", f"WITH {TRUTH_SQL} SELECT * FROM truth")
def passage_truth(spark, d):
    return D.passage_containment(views.corpus(spark, d), "doc_id", views.kb(spark, d), "item_id")


DOC_Q_SQL = f"SELECT doc_id AS qid, {tok_sql('text')} AS tokens FROM documents"


@query("qa_metrics", f"""WITH {_bm25_sql(DOC_Q_SQL)}, {TRUTH_SQL},
log AS (SELECT d.doc_id,
               COALESCE(r.score >= {THRESHOLD}, false) AS answered,
               COALESCE(r.score >= {THRESHOLD} AND EXISTS (SELECT 1 FROM truth t WHERE t.doc_id = d.doc_id AND t.item_id = r.item_id), false) AS correct,
               EXISTS (SELECT 1 FROM truth t WHERE t.doc_id = d.doc_id) AS answerable
        FROM documents d LEFT JOIN ranked r ON r.qid = d.doc_id AND r.rank = 1)
SELECT COUNT(*) AS n, round(avg(CAST(answered AS DOUBLE)), 6) AS answered_rate,
       round(1 - avg(CAST(answered AS DOUBLE)), 6) AS rejection_rate,
       round(SUM(CAST(correct AS BIGINT)) / SUM(CAST(answerable AS BIGINT)), 6) AS recall,
       round(SUM(CAST(correct AS BIGINT)) / SUM(CAST(answered AS BIGINT)), 6) AS precision FROM log""")
def qa_metrics(spark, d):
    docs = views.corpus(spark, d)
    q = docs.select(F.col("doc_id").alias("qid"), T.tokenize_ws(F.col("text")).alias("tokens"))
    top1 = D.bm25_search(q, "qid", "tokens", _kb(spark, d), "item_id", "tokens", TOP_K).filter(F.col("rank") == 1)
    truth = D.passage_containment(docs, "doc_id", views.kb(spark, d), "item_id")
    answerable = truth.select("doc_id").distinct().withColumn("answerable", F.lit(True))
    hit = truth.withColumn("_hit", F.lit(True))
    log = (
        docs.select("doc_id")
        .join(top1.select(F.col("qid").alias("doc_id"), "item_id", "score"), "doc_id", "left")
        .join(hit, ["doc_id", "item_id"], "left")
        .join(answerable, "doc_id", "left")
        .select(
            "doc_id",
            F.coalesce(F.col("score") >= THRESHOLD, F.lit(False)).alias("answered"),
            F.coalesce((F.col("score") >= THRESHOLD) & F.coalesce(F.col("_hit"), F.lit(False)), F.lit(False)).alias("correct"),
            F.coalesce(F.col("answerable"), F.lit(False)).alias("answerable"),
        )
    )
    m = D.qa_metrics(log)
    return m.select("n", *[fround(c, 6).alias(c) for c in ("answered_rate", "rejection_rate", "recall", "precision")])


@query("eval_sample", """WITH c AS (SELECT lang, COUNT(*) AS c FROM documents GROUP BY 1),
q AS (SELECT lang, CAST(round(100.0 * c / (SELECT SUM(c) FROM c)) AS INTEGER) AS quota FROM c),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('11:' || doc_id), doc_id) AS rank FROM documents)
SELECT r.doc_id, r.lang, r.rank FROM r JOIN q USING (lang) WHERE r.rank <= q.quota""")
def eval_sample(spark, d):
    s = D.stratified_sample(views.corpus(spark, d).select("doc_id", "lang"), "doc_id", "lang", 100)
    return s.select("doc_id", "lang", "rank")


@query("feedback", """WITH l AS (SELECT user_id, event_type IN ('purchase', 'error') AS gave, event_type = 'purchase' AS sat FROM events),
per AS (SELECT user_id, max(CAST(gave AS INTEGER)) AS g, SUM(CAST(gave AS BIGINT)) AS nf,
               SUM(CAST(gave AND sat AS BIGINT)) AS ns FROM l GROUP BY 1)
SELECT COUNT(*) AS n_users, CAST(SUM(nf) AS BIGINT) AS n_feedback, round(avg(g), 6) AS participation_rate,
       round(SUM(ns) / SUM(nf), 6) AS satisfaction FROM per""")
def feedback(spark, d):
    ev = views.events(spark, d).select(
        "user_id", F.col("event_type").isin("purchase", "error").alias("gave"),
        (F.col("event_type") == "purchase").alias("sat"))
    f = D.feedback(ev, "user_id", "gave", "sat")
    return f.select("n_users", "n_feedback", fround("participation_rate", 6).alias("participation_rate"),
                    fround("satisfaction", 6).alias("satisfaction"))


@query("dialog_state", """SELECT conv_id, turn, role,
  CAST(SUM(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS user_turns,
  CAST(SUM(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS assistant_turns,
  max(CASE WHEN role = 'user' THEN turn END) OVER w AS last_user_turn,
  max(CASE WHEN role = 'system' THEN turn END) OVER w AS last_system_turn
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def dialog_state(spark, d):
    """Per-turn dialogue slot state (counts and last-seen turns)."""
    return D.dialog_state(views.turns(spark, d))


# dictionaries and templates of the demo: words that the conversations use
PLACES = ("hent", "thor", "thaat", "ou")
TIMES = ("is", "to", "than", "and")
INTENTS = {"place_time": [PLACES, TIMES, "of"], "time_only": [TIMES, "in"], "place_only": [PLACES]}
SYNONYMS = {"and": ("plus", "also"), "of": ("from",), "to": ("towards", "into"), "is": ("was",)}


def _intent_sql() -> str:
    hit = {n: f"regexp_matches(text, '{D.template_pattern(p)}')" for n, p in INTENTS.items()}
    slot = [" ".join(f"WHEN {hit[n]} THEN " + (f"lower(regexp_extract(text, '{D.template_pattern(p)}', {i}))"
                                               if i <= sum(isinstance(x, tuple) for x in p) else "NULL")
                     for n, p in INTENTS.items()) for i in (1, 2)]
    name = " ".join(f"WHEN {h} THEN '{n}'" for n, h in hit.items())
    return f"SELECT conv_id, turn, CASE {name} END AS intent, CASE {slot[0]} END AS slot_1, CASE {slot[1]} END AS slot_2 FROM conversations"


@query("intent_templates", _intent_sql())
def intent_templates(spark, d):
    """F32: template intents (dictionary slot .. any .. slot .. keyword)."""
    return D.match_intent(views.turns(spark, d), "text", INTENTS).select("conv_id", "turn", "intent", "slot_1", "slot_2")


@query("slot_state", f"""WITH f AS ({_intent_sql()}),
g AS (SELECT f.conv_id, f.turn, CASE WHEN c.role = 'user' AND intent IN ('place_time', 'place_only') THEN slot_1 END AS place,
             CASE WHEN c.role = 'user' THEN CASE intent WHEN 'place_time' THEN slot_2 WHEN 'time_only' THEN slot_1 END END AS time
      FROM f JOIN conversations c ON c.conv_id = f.conv_id AND c.turn = f.turn),
s AS (SELECT conv_id, turn, last_value(place IGNORE NULLS) OVER w AS place, last_value(time IGNORE NULLS) OVER w AS time FROM g
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT *, (place IS NOT NULL)::INT + (time IS NOT NULL)::INT AS n_filled, place IS NOT NULL AND time IS NOT NULL AS complete FROM s""")
def slot_state(spark, d):
    """Place and time as the user's turns have filled them so far, by the templates above."""
    found = D.match_intent(views.turns(spark, d), "text", INTENTS)
    place = F.when(F.col("intent").isin("place_time", "place_only"), F.col("slot_1"))
    time = F.when(F.col("intent") == "place_time", F.col("slot_2")).when(F.col("intent") == "time_only", F.col("slot_1"))
    given = found.select("conv_id", "turn", (F.col("role") == "user").alias("speaks"), place.alias("place"), time.alias("time"))
    return D.fill_slots(given, "conv_id", "turn", ["place", "time"])


@query("expand_synonyms", f"""WITH syn(w, s, i) AS (VALUES {', '.join(f"('{w}', '{x}', {i + 1})" for w, s in SYNONYMS.items() for i, x in enumerate(s))}),
t AS (SELECT conv_id, turn, {tok_sql('text')} AS toks FROM conversations),
l AS (SELECT conv_id, turn, unnest(toks) AS w, unnest(range(1, len(toks) + 1)) AS pos FROM t),
e AS (SELECT conv_id, turn, w, pos, 0 AS i FROM l UNION ALL
      SELECT conv_id, turn, s, pos, syn.i FROM l JOIN syn USING (w)),
o AS (SELECT conv_id, turn, w, min(pos * 100 + i) AS place FROM e GROUP BY 1, 2, 3),
g AS (SELECT conv_id, turn, COUNT(*) AS n, string_agg(w, ' ' ORDER BY place) AS x FROM o GROUP BY 1, 2)
SELECT t.conv_id, t.turn, CAST(COALESCE(n, 0) AS INTEGER) AS n_tokens, md5(COALESCE(x, '')) AS tokens_md5
FROM t LEFT JOIN g USING (conv_id, turn)""")
def expand_synonyms(spark, d):
    """The words of each turn with their synonyms, before retrieval."""
    x = views.turns(spark, d).select("conv_id", "turn", D.expand_synonyms(T.tokenize_ws(F.col("text")), SYNONYMS).alias("x"))
    return x.select("conv_id", "turn", F.size("x").alias("n_tokens"), F.md5(F.array_join("x", " ")).alias("tokens_md5"))


#: Question templates by predicate; the group is the subject.
KG_TEMPLATES = {
    "located_in": "^(?i:where is) (.+) located[?]$",
    "made_as": "^(?i:which brands) make (.+)[?]$",
}


@query("kg_answer", """WITH triples AS (
  SELECT n_name AS s, 'located_in' AS p, r_name AS o FROM nation JOIN region ON r_regionkey = n_regionkey
  UNION SELECT s_name, 'located_in', n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey
  UNION SELECT p_name, 'made_as', p_brand FROM part),
q AS (SELECT 'Where is ' || s_name || ' located?' AS question, lower(s_name) AS subject, 'located_in' AS predicate FROM supplier
  UNION SELECT 'where is ' || n_name || ' located?', lower(n_name), 'located_in' FROM nation
  UNION SELECT 'where is ' || c_name || ' located?', lower(c_name), 'located_in' FROM customer
  UNION SELECT 'Which brands make ' || p_name || '?', lower(p_name), 'made_as' FROM part
  UNION SELECT 'How much is ' || p_name || '?', NULL, NULL FROM part)
SELECT question, predicate, subject, o AS answer
FROM q LEFT JOIN (SELECT DISTINCT lower(s) AS s, p, o FROM triples) t ON t.s = q.subject AND t.p = q.predicate""")
def kg_answer(spark, d):
    """questions on suppliers, nations, customers (no triples) and parts, looked up in triples of the tables."""
    read = lambda t: views.table(spark, d, t)
    nation, supplier, part = read("nation"), read("supplier"), read("part")
    triple = lambda df, s, p, o: df.select(F.col(s).alias("subject"), F.lit(p).alias("predicate"), F.col(o).alias("object"))
    triples = triple(nation.join(read("region"), F.col("r_regionkey") == F.col("n_regionkey")), "n_name", "located_in", "r_name")
    triples = triples.unionByName(triple(supplier.join(nation, F.col("n_nationkey") == F.col("s_nationkey")), "s_name", "located_in", "n_name"))
    triples = triples.unionByName(triple(part, "p_name", "made_as", "p_brand"))
    ask = lambda df, a, c, b: df.select(F.concat(F.lit(a), c, F.lit(b)).alias("question"))
    asked = ask(supplier, "Where is ", "s_name", " located?").unionByName(ask(nation, "where is ", "n_name", " located?"))
    asked = asked.unionByName(ask(read("customer"), "where is ", "c_name", " located?"))
    asked = asked.unionByName(ask(part, "Which brands make ", "p_name", "?")).unionByName(ask(part, "How much is ", "p_name", "?"))
    return D.kg_answer(asked.distinct(), "question", KG_TEMPLATES, triples).select("question", "predicate", "subject", "answer")


# ------------------------------------------------------------ segmentation

#: Words of the turns that make the dictionary: the most frequent, ties by word.
SEGMENT_WORDS = 2000
_SPACED = r"[ \t\n\r\f]+"


def _turn_words(spark, d):
    t = views.turns(spark, d).select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    words = t.select(F.explode(F.split("text", _SPACED)).alias("w")).filter("w <> ''").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    top = words.orderBy(F.col("n").desc(), "w").limit(SEGMENT_WORDS).collect()  # bounded by the dictionary's size
    return t.select("conv_id", "turn", F.regexp_replace("text", _SPACED, "").alias("text")), {r["w"]: float(r["n"]) for r in top}


@query("segment_turns", f"""WITH RECURSIVE words AS MATERIALIZED (
  SELECT w FROM (SELECT unnest(string_split_regex(text, '{_SPACED}')) AS w FROM conversations) WHERE w <> '' GROUP BY w
  ORDER BY count(*) DESC, w LIMIT {SEGMENT_WORDS}),
lens AS MATERIALIZED (SELECT list(DISTINCT length(w)) AS ls FROM words),
t AS MATERIALIZED (SELECT conv_id, turn, regexp_replace(coalesce(text, ''), '{_SPACED}', '', 'g') AS text FROM conversations),
places AS MATERIALIZED (SELECT conv_id, turn, text, unnest(range(1, length(text) + 1)) AS i FROM t),
found AS MATERIALIZED (
  SELECT p.conv_id, p.turn, p.i, max(length(words.w)) AS n
  FROM (SELECT conv_id, turn, i, unnest(list_transform(ls, lambda n: substr(text, i, n))) AS s FROM places CROSS JOIN lens) p JOIN words ON words.w = p.s
  GROUP BY ALL),
step AS MATERIALIZED (SELECT p.conv_id, p.turn, p.i, coalesce(f.n, 1) AS n, substr(p.text, p.i, coalesce(f.n, 1)) AS w FROM places p LEFT JOIN found f USING (conv_id, turn, i)),
walk(conv_id, turn, i, n, w) AS (
  SELECT * FROM step WHERE i = 1
  UNION ALL SELECT s.* FROM walk x JOIN step s ON s.conv_id = x.conv_id AND s.turn = x.turn AND s.i = x.i + x.n)
SELECT t.conv_id, t.turn, coalesce(string_agg(w, ' ' ORDER BY i), '') AS words FROM t LEFT JOIN walk USING (conv_id, turn) GROUP BY t.conv_id, t.turn""")
def segment_turns(spark, d):
    """each turn without its spaces, cut by forward maximum match with the most frequent words."""
    rows, words = _turn_words(spark, d)
    return SEG.segment(rows, ["conv_id", "turn"], "text", words).withColumn("words", F.array_join("words", " "))


@query("segment_best")
def segment_best(spark, d):
    """F15 (rows-only): the same by the most probable path."""
    rows, words = _turn_words(spark, d)
    return SEG.segment(rows, ["conv_id", "turn"], "text", words, "best").withColumn("words", F.array_join("words", " "))
