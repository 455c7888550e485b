"""Dialogue and question-answering operators: turn pairing, context
windows, sequence-pair preparation, BM25 retrieval, answering, BLEU and QA
metrics.

Turns carry explicit (conv_id, turn) keys, so "next turn" and "previous n
turns" are equi-joins / scatters on those keys, never a window over a whole
conversation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions.numeric import fround
from tidemark.plans.scale import topn_per

# ---------------------------------------------------------------------------
# Published BM25 constants; sequence-to-sequence length buckets
# (source, target) of the translation demo; BERT-style special tokens.
BM25_K1, BM25_B = 1.2, 0.75
BUCKETS = [(20, 20), (40, 40), (50, 50), (60, 60)]
BERT_SPECIALS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
# ---------------------------------------------------------------------------


def qa_pairs(turns: DataFrame, q_role: str = "user", a_role: str = "assistant") -> DataFrame:
    """Each `q_role` turn paired with the `a_role` turn right after it
    (equi-join on (conv_id, turn + 1))."""
    q = turns.filter(F.col("role") == q_role).select("conv_id", "turn", F.col("text").alias("question"))
    a = turns.filter(F.col("role") == a_role).select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return q.join(a, ["conv_id", "turn"])


def split_dialogue(turns: DataFrame) -> DataFrame:
    """Even turns are questions, odd turns answers; question t pairs
    with answer t + 1."""
    q = turns.filter(F.col("turn") % 2 == 0).select("conv_id", "turn", F.col("text").alias("question"))
    a = turns.filter(F.col("turn") % 2 == 1).select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return q.join(a, ["conv_id", "turn"])


def trailing_context(turns: DataFrame, n: int) -> DataFrame:
    """The previous n turns (oldest first) of every turn.  Each turn is
    scattered to the n turns after it and regrouped by (conv_id, turn), so a
    group holds at most n rows."""
    scat = turns.select("conv_id", F.explode(F.sequence(F.col("turn") + 1, F.col("turn") + n)).alias("turn"),
                        F.struct(F.col("turn").alias("t"), "role", "text").alias("h"))
    ctx = scat.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list("h")).alias("_h"))
    return turns.join(ctx, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "text",
        F.coalesce(F.col("_h"), F.array().cast("array<struct<t:bigint,role:string,text:string>>")).alias("context"),
    )


def truncate_pair(a: F.Column, b: F.Column, max_len: int) -> tuple[F.Column, F.Column]:
    """pop from the longer list (ties pop b) until |a| + |b| <= L - 3,
    in closed form on the sizes; the kept tokens are the leading ones."""
    la, lb = F.size(a), F.size(b)
    T_ = max_len - 3
    excess = F.greatest(la + lb - F.lit(T_), F.lit(0))
    d = F.abs(la - lb)
    m = F.least(la, lb)
    rest = excess - d
    a_len = F.when(excess == 0, la).when(la > lb, F.when(excess <= d, la - excess).otherwise(m - F.floor(rest / 2))) \
        .otherwise(F.when(excess <= d, la).otherwise(m - F.floor(rest / 2)))
    b_len = F.when(excess == 0, lb).when(lb > la, F.when(excess <= d, lb - excess).otherwise(m - F.ceil(rest / 2))) \
        .when(la > lb, F.when(excess <= d, lb).otherwise(m - F.ceil(rest / 2))) \
        .otherwise(m - F.ceil(excess / 2))
    return F.slice(a, 1, a_len.cast("int")), F.slice(b, 1, b_len.cast("int"))


def truncate_single(a: F.Column, max_len: int) -> F.Column:
    return F.slice(a, 1, max_len - 2)


def to_features(ids_a: F.Column, ids_b: F.Column, max_len: int, cls_id: int, sep_id: int, pad_id: int = 0):
    """[CLS] a [SEP] b [SEP] ids, segment ids (0 then 1), input mask,
    all zero-padded to max_len.  Returns (input_ids, segment_ids, mask)."""
    ids = F.concat(F.array(F.lit(cls_id)), ids_a, F.array(F.lit(sep_id)), ids_b, F.array(F.lit(sep_id)))
    seg = F.concat(F.array_repeat(F.lit(0), F.size(ids_a) + 2), F.array_repeat(F.lit(1), F.size(ids_b) + 1))
    n = F.size(ids)
    pad = F.greatest(F.lit(max_len) - n, F.lit(0))
    return (
        F.concat(ids, F.array_repeat(F.lit(pad_id), pad)),
        F.concat(seg, F.array_repeat(F.lit(0), pad)),
        F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), pad)),
    )


def bucket_id(src_len: F.Column, tgt_len: F.Column, buckets=BUCKETS) -> F.Column:
    """first bucket with len(source) < s and len(target) + 1 < t (EOS
    counted); null = dropped."""
    expr = None
    for i, (s, t) in enumerate(buckets):
        cond = (src_len < s) & (tgt_len + 1 < t)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


# ------------------------------------------------------------ retrieval

def bm25_index(kb: DataFrame, key: str, tokens: str) -> tuple[DataFrame, int, float]:
    """Postings (term, key, tf, dl) plus N and average length of the KB."""
    stats = kb.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size(tokens)).alias("avgdl")).first()
    post = (
        kb.select(key, F.size(tokens).alias("dl"), F.explode(tokens).alias("term"))
        .groupBy("term", key, "dl").agg(F.count(F.lit(1)).alias("tf"))
    )
    return post, stats["n"], stats["avgdl"] or 0.0


def bm25_search(queries: DataFrame, qkey: str, qtokens: str, kb: DataFrame, key: str, tokens: str,
                k: int, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """BM25 over the inverted index (equi-join on term); distinct query
    terms; idf = ln(1 + (N - df + 0.5) / (df + 0.5)); top-k per query, ties
    by KB key.  Output (qkey, key, score, rank)."""
    post, n, avgdl = bm25_index(kb, key, tokens)
    df = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = df.select("term", F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    w = post.join(idf, "term").select(
        "term", key,
        (F.col("idf") * F.col("tf") * (k1 + 1)
         / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.lit(avgdl)))).alias("w"))
    qt = queries.select(qkey, F.explode(F.array_distinct(qtokens)).alias("term"))
    s = qt.join(w, "term").groupBy(qkey, key).agg(F.sum("w").alias("score"))
    return topn_per(s, qkey, [fround("score", 9).desc(), F.col(key)], k)


def answer(ranked: DataFrame, qkey: str, threshold: float) -> DataFrame:
    """The top-1 item when its score reaches the threshold (answered),
    else the whole head list is returned for the user to choose."""
    top = ranked.filter(F.col("rank") == 1).select(qkey, (F.col("score") >= threshold).alias("answered"))
    j = ranked.join(top, qkey)
    return j.filter(~F.col("answered") | (F.col("rank") == 1))


def passage_containment(docs: DataFrame, dkey: str, kb: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Which KB passages occur verbatim inside which documents.

    Interior word 5-gram shingles of each passage (first and last word
    excluded, they may be glued to neighbouring text) are matched to the
    documents' shingles by equi-join on a 64-bit hash; documents holding
    every shingle of a passage are then verified with an exact substring
    test.  Passages with fewer interior words than n are checked on their
    longest interior run."""
    def shingles(text: F.Column) -> F.Column:
        return F.split(F.trim(text), r"\s+")

    kt = kb.select(key, "text", shingles(F.col("text")).alias("_t"))
    kt = kt.withColumn("_i", F.slice(F.col("_t"), 2, F.greatest(F.size("_t") - 2, F.lit(0))))
    kt = kt.withColumn("_n", F.least(F.lit(n), F.greatest(F.size("_i"), F.lit(1))))
    ksh = kt.select(key, "_n", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("_i") - F.col("_n") + 1, F.lit(1))),
        lambda i: F.xxhash64(F.array_join(F.slice(F.col("_i"), i, F.col("_n")), " "))))).alias("h"))
    need = ksh.groupBy(key).agg(F.count(F.lit(1)).alias("need"), F.max("_n").alias("_n"))
    sizes = [r[0] for r in need.select("_n").distinct().collect()]  # shingle lengths used (<= n values)
    dsh = None
    for m in sizes:
        dt = docs.select(dkey, shingles(F.col("text")).alias("_t"))
        part = dt.select(dkey, F.lit(m).alias("_n"), F.explode(F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.greatest(F.size("_t") - m + 1, F.lit(1))),
            lambda i: F.xxhash64(F.array_join(F.slice(F.col("_t"), i, m), " "))))).alias("h"))
        dsh = part if dsh is None else dsh.unionByName(part)
    if dsh is None:
        return docs.select(dkey).limit(0).withColumn(key, F.lit(None).cast("bigint"))
    hits = dsh.join(ksh, ["h", "_n"]).groupBy(dkey, key).agg(F.count(F.lit(1)).alias("got"))
    cand = hits.join(need.select(key, "need"), key).filter(F.col("got") >= F.col("need")).select(dkey, key)
    ver = cand.join(docs.select(dkey, F.col("text").alias("_dt")), dkey).join(
        kb.select(key, F.col("text").alias("_kt")), key)
    return ver.filter(F.instr(F.col("_dt"), F.col("_kt")) > 0).select(dkey, key)


def qa_metrics(log: DataFrame) -> DataFrame:
    """Answered rate, rejection rate, recall (correct / answerable) and
    precision (correct / answered) from (answered, correct, answerable)."""
    return log.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("answered").cast("double")).alias("answered_rate"),
        (1 - F.avg(F.col("answered").cast("double"))).alias("rejection_rate"),
        F.try_divide(F.sum(F.col("correct").cast("bigint")), F.sum(F.col("answerable").cast("bigint"))).alias("recall"),
        F.try_divide(F.sum(F.col("correct").cast("bigint")), F.sum(F.col("answered").cast("bigint"))).alias("precision"),
    )


def stratified_sample(df: DataFrame, key: str, stratum: str, n: int, seed: int = 11) -> DataFrame:
    """Per stratum quota round(n * share), filled by md5 order of the key
    within the stratum.  Every quota is <= n, so a top-n per stratum (partial
    limit before the shuffle) is enough to pick exactly."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("_c"))
    total = sizes.agg(F.sum("_c")).first()[0] or 1
    quota = sizes.select(stratum, fround(F.lit(float(n)) * F.col("_c") / F.lit(float(total)), 0).cast("int").alias("quota"))
    top = topn_per(df.withColumn("_h", h), stratum, [F.col("_h"), F.col(key)], n, rank_col="rank")
    return top.join(quota, stratum).filter(F.col("rank") <= F.col("quota")).drop("_h")


def feedback(log: DataFrame, user: str, gave: str, satisfied: str) -> DataFrame:
    """Participation rate (users who gave feedback / users) and
    satisfaction (satisfied feedback / feedback), from one per-user reduce."""
    per = log.groupBy(user).agg(
        F.max(F.col(gave).cast("int")).alias("_g"),
        F.sum(F.col(gave).cast("bigint")).alias("_nf"),
        F.sum((F.col(gave) & F.col(satisfied)).cast("bigint")).alias("_ns"),
    )
    return per.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.sum("_nf").alias("n_feedback"),
        F.avg("_g").alias("participation_rate"),
        F.try_divide(F.sum("_ns"), F.sum("_nf")).alias("satisfaction"),
    )


# ------------------------------------------------------------ BLEU

def _ngram_counts(df: DataFrame, key: list[str], tokens: str, side: str, max_n: int) -> DataFrame:
    parts = []
    for n in range(1, max_n + 1):
        parts.append(df.select(*key, F.lit(n).alias("n"), F.explode(T.ngrams(F.col(tokens), n)).alias("g")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy(*key, "n", "g").agg(F.count(F.lit(1)).alias(side))


def bleu(pairs: DataFrame, key: list[str], label: str, pred: str, max_n: int = 4) -> DataFrame:
    """Clipped n-gram precisions p_1..p_N, brevity penalty
    exp(min(0, 1 - len_label / len_pred)) and BLEU = BP * prod p_n^(1/2^n).
    A prediction without n-grams of some order has p_n = 0."""
    pc = _ngram_counts(pairs, key, pred, "cp", max_n)
    lc = _ngram_counts(pairs, key, label, "cl", max_n)
    m = pc.join(lc, key + ["n", "g"], "left").groupBy(*key, "n").agg(
        F.sum(F.least(F.col("cp"), F.coalesce(F.col("cl"), F.lit(0)))).alias("clip"), F.sum("cp").alias("tot"))
    wide = m.groupBy(*key).agg(*[
        F.max(F.when(F.col("n") == i, F.col("clip") / F.col("tot"))).alias(f"p{i}") for i in range(1, max_n + 1)])
    base = pairs.select(*key, F.size(label).alias("len_label"), F.size(pred).alias("len_pred"))
    j = base.join(wide, key, "left")
    ps = [F.coalesce(F.col(f"p{i}"), F.lit(0.0)) for i in range(1, max_n + 1)]
    prod = F.lit(1.0)
    for i, p in enumerate(ps, start=1):
        prod = prod * F.pow(p, F.lit(1.0 / (2 ** i)))
    bp = F.when(F.col("len_pred") > 0, F.exp(F.least(F.lit(0.0), 1 - F.col("len_label") / F.col("len_pred")))).otherwise(F.lit(0.0))
    return j.select(*key, "len_label", "len_pred", *[p.alias(f"p{i}") for i, p in enumerate(ps, start=1)],
                    (bp * prod).alias("bleu"))


def dialog_state(turns: DataFrame, block_rows: int | None = None) -> DataFrame:
    """M41 (batch): slot state after every turn of a conversation - user and
    assistant turns so far, the last user turn and the last system turn
    (forward-filled, i.e. last non-null).  Running aggregates use the
    skew-safe ordered blocks, so a very long conversation is split."""
    from tidemark.plans.ordered import DEFAULT_BLOCK_ROWS, running_agg, with_positions

    t = turns.select("conv_id", "turn", "role").withColumn("_o", F.col("turn").cast("double"))
    p = with_positions(t, "conv_id", ["_o", "turn"], keep_block=True,
                       block_rows=block_rows or DEFAULT_BLOCK_ROWS)
    p = p.withColumn("_u", (F.col("role") == "user").cast("long")).withColumn(
        "_a", (F.col("role") == "assistant").cast("long")).withColumn(
        "_lu", F.when(F.col("role") == "user", F.col("turn"))).withColumn(
        "_ls", F.when(F.col("role") == "system", F.col("turn")))
    p = running_agg(p, "conv_id", "_u", "sum", "user_turns")
    p = running_agg(p, "conv_id", "_a", "sum", "assistant_turns")
    p = running_agg(p, "conv_id", "_lu", "max", "last_user_turn")
    p = running_agg(p, "conv_id", "_ls", "max", "last_system_turn")
    return p.select("conv_id", "turn", "role", F.col("user_turns").cast("bigint").alias("user_turns"),
                    F.col("assistant_turns").cast("bigint").alias("assistant_turns"), "last_user_turn", "last_system_turn")


def template_pattern(parts: list[tuple[str, ...] | str]) -> str:
    """A template as one pattern: a tuple is a dictionary slot (a group that
    holds any of its words), a string a keyword; anything may stand between.
    Words match whole and in any case."""
    def words(p):
        return "|".join(re.escape(w) for w in sorted((p,) if isinstance(p, str) else p, key=lambda w: (-len(w), w)))

    groups = [f"({words(p)})" if isinstance(p, tuple) else f"(?:{words(p)})" for p in parts]
    gap = r"[^\p{L}\p{N}]"
    return f"(?is)(?:^|{gap})" + f"{gap}(?:.*?{gap})?".join(groups) + f"(?:{gap}|$)"


def match_intent(df: DataFrame, text: str, templates: dict[str, list[tuple[str, ...] | str]], slots: int = 2) -> DataFrame:
    """F32: `intent`, the first template that the text matches (null: none),
    and what its dictionary slots hold, in lower case, as slot_1 ..."""
    found = F.lit(None).cast("string")
    values = [F.lit(None).cast("string")] * slots
    for name, parts in reversed(templates.items()):
        pattern = template_pattern(parts)
        hit = F.col(text).rlike(pattern)
        found = F.when(hit, F.lit(name)).otherwise(found)
        held = sum(isinstance(p, tuple) for p in parts)
        values = [F.when(hit, F.lower(F.regexp_extract(text, pattern, i + 1)) if i < held else F.lit(None)).otherwise(v)
                  for i, v in enumerate(values)]
    return df.withColumn("intent", found).withColumns({f"slot_{i + 1}": v for i, v in enumerate(values)})


def expand_synonyms(tokens: Column, synonyms: dict[str, tuple[str, ...]]) -> Column:
    """The tokens, each followed by its synonyms (a dictionary given as
    a parameter), every word once in the order of its first place."""
    if not synonyms:
        return F.array_distinct(tokens)
    table = F.create_map(*[x for w, s in synonyms.items() for x in (F.lit(w), F.array(*map(F.lit, s)))])
    more = F.transform(tokens, lambda t: F.concat(F.array(t), F.coalesce(F.try_element_at(table, t), F.array().cast("array<string>"))))
    return F.array_distinct(F.flatten(more))


def kg_answer(questions: DataFrame, text: str, templates: dict[str, str], triples: DataFrame) -> DataFrame:
    """the first template (predicate: pattern with one slot) that a question matches names the predicate
    and, in its slot, the subject; triples (subject, predicate, object) give the answers.

    A row for each question and answer; a question without a template or a triple stays with a null answer.
    Equal triples count once.  Both sides meet on (subject, predicate), which AQE splits where it is skewed."""
    predicate, subject = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, pattern in reversed(templates.items()):
        hit = F.col(text).rlike(pattern)
        predicate = F.when(hit, F.lit(name)).otherwise(predicate)
        subject = F.when(hit, F.lower(F.regexp_extract(text, pattern, 1))).otherwise(subject)
    facts = triples.select(F.lower("subject").alias("subject"), "predicate", F.col("object").alias("answer")).distinct()
    return questions.withColumns({"predicate": predicate, "subject": subject}).join(facts, ["subject", "predicate"], "left")


def fill_slots(filled: DataFrame, key: str, order: str, slots: list[str], asks: str = "speaks", block_rows: int | None = None) -> DataFrame:
    """The dialogue's slots after every turn: each slot keeps the last value that a turn gave it.

    filled: key, order, `slots` (null where a turn says nothing) and `asks`, whether the turn may set slots.  Adds
    n_filled, and complete once all slots have a value.  Runs over ordered blocks, so a long dialogue is split.
    """
    from tidemark.plans.ordered import DEFAULT_BLOCK_ROWS, running_agg, with_positions

    t = filled.select(key, order, F.col(asks).alias("_may"), *slots)
    p = with_positions(t, key, [order, *slots], keep_block=True, block_rows=block_rows or DEFAULT_BLOCK_ROWS)
    for s in slots:
        p = p.withColumn(f"_v_{s}", F.when(F.col("_may") & F.col(s).isNotNull(), F.struct("pos", F.col(s).alias("value")))).drop(s)
        p = running_agg(p, key, f"_v_{s}", "max", f"_l_{s}")
    out = p.select(key, order, *[F.col(f"_l_{s}")["value"].alias(s) for s in slots])
    n = sum((F.col(s).isNotNull().cast("int") for s in slots[1:]), F.col(slots[0]).isNotNull().cast("int"))
    return out.withColumn("n_filled", n).withColumn("complete", F.col("n_filled") == len(slots))
