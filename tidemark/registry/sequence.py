"""Sequence queries over `events` as per-user state sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.numeric import fround

from tidemark.operators import hmm as H
from tidemark.operators import sequence as Q
from tidemark.plans import views
from tidemark.plans.ordered import lag_join
from tidemark.registry import query

BANDS_SQL = " ".join(f"WHEN value < {hi} THEN '{name}'" for hi, name in Q.VALUE_BANDS)
SEQ = f"""seq AS (
  SELECT user_id, event_id, ts, event_type AS state,
         CASE {BANDS_SQL} ELSE '{Q.TOP_BAND}' END AS obs, value AS reward,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
         COUNT(*) OVER (PARTITION BY user_id) AS n
  FROM events)"""
BIGRAMS = """big AS (
  SELECT user_id, COALESCE(lag(state) OVER (PARTITION BY user_id ORDER BY pos), 'START') AS prev, state AS cur FROM seq
  UNION ALL SELECT user_id, state, 'END' FROM seq WHERE pos = n)"""
TRANS = """trans AS (
  SELECT prev AS from_state, cur AS to_state, COUNT(*) AS count,
         COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY prev) AS prob FROM big GROUP BY 1, 2)"""
EMIT = """emit AS (
  SELECT state, obs, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY state) AS prob
  FROM seq GROUP BY 1, 2)"""


def _seq(spark, d, keep_block=False):
    return Q.event_sequences(views.events(spark, d), keep_block=keep_block)


@query("event_positions", f"WITH {SEQ} SELECT user_id, event_id, pos, n FROM seq")
def event_positions(spark, d):
    return _seq(spark, d).select("user_id", "event_id", "pos", "n")


@query("transitions", f"""WITH {SEQ}, {BIGRAMS}, {TRANS}
SELECT from_state, to_state, count, round(prob, 6) AS prob FROM trans""")
def transitions(spark, d):
    return Q.transitions(_seq(spark, d)).withColumn("prob", fround("prob", 6))


@query("emissions", f"""WITH {SEQ}, {EMIT} SELECT state, obs, count, round(prob, 6) AS prob FROM emit""")
def emissions(spark, d):
    return Q.emissions(_seq(spark, d)).withColumn("prob", fround("prob", 6))


@query("hmm_fit", f"""WITH {SEQ}, {BIGRAMS}, {TRANS}, {EMIT}
SELECT 'trans' AS kind, from_state AS a, to_state AS b, count, round(prob, 6) AS prob FROM trans
UNION ALL SELECT 'emit', state, obs, count, round(prob, 6) FROM emit""")
def hmm_fit(spark, d):
    return Q.hmm_fit(_seq(spark, d)).withColumn("prob", fround("prob", 6))


@query("seq_logprob", f"""WITH {SEQ}, {BIGRAMS}, {TRANS}, {EMIT},
terms AS (
  SELECT b.user_id, ln(t.prob) AS lp FROM big b LEFT JOIN trans t ON t.from_state = b.prev AND t.to_state = b.cur
  UNION ALL
  SELECT s.user_id, ln(e.prob) FROM seq s LEFT JOIN emit e ON e.state = s.state AND e.obs = s.obs)
SELECT user_id, COUNT(*) AS n_terms,
       round(CASE WHEN COUNT(lp) = COUNT(*) THEN SUM(lp) END, 6) AS logprob FROM terms GROUP BY 1""")
def seq_logprob(spark, d):
    s = _seq(spark, d)
    r = Q.seq_logprob(s, Q.transitions(s), Q.emissions(s))
    return r.withColumn("logprob", fround("logprob", 6))


@query("moving_avg", f"""WITH {SEQ}
SELECT user_id, event_id, pos, round(CASE WHEN pos <= 5 THEN reward ELSE
  avg(reward) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) END, 6) AS ma
FROM seq""")
def moving_avg(spark, d):
    m = Q.moving_avg(_seq(spark, d), "reward", 5)
    return m.select("user_id", "event_id", "pos", fround("ma", 6).alias("ma"))


@query("lag_rate", f"""WITH {SEQ},
x AS (SELECT user_id, pos, CAST(state = 'click' AS INTEGER) AS x, CAST(state = 'purchase' AS INTEGER) AS y FROM seq),
l AS (SELECT *, lag(x, 3) OVER (PARTITION BY user_id ORDER BY pos) AS x_lag3,
                lag(x, 8) OVER (PARTITION BY user_id ORDER BY pos) AS x_lag8 FROM x)
SELECT x_lag3, x_lag8, COUNT(*) AS n, round(avg(y), 6) AS rate FROM l
WHERE x_lag3 IS NOT NULL AND x_lag8 IS NOT NULL GROUP BY 1, 2""")
def lag_rate(spark, d):
    s = _seq(spark, d).select(
        "user_id", "pos", "n",
        (F.col("state") == "click").cast("int").alias("x"),
        (F.col("state") == "purchase").cast("int").alias("y"),
    )
    l = Q.lag_features(s, "x", [3, 8])
    return (
        l.filter(F.col("lag3_x").isNotNull() & F.col("lag8_x").isNotNull())
        .groupBy(F.col("lag3_x").alias("x_lag3"), F.col("lag8_x").alias("x_lag8"))
        .agg(F.count(F.lit(1)).alias("n"), fround(F.avg("y"), 6).alias("rate"))
    )


@query("chunks", f"""WITH {SEQ},
c AS (SELECT user_id, CAST((pos - 1) // 10 + 1 AS BIGINT) AS chunk, pos, event_id FROM seq WHERE pos <= (n // 10) * 10)
SELECT user_id, chunk, string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY pos) AS items FROM c GROUP BY 1, 2""")
def chunks(spark, d):
    c = Q.chunks(_seq(spark, d), 10)
    return c.select("user_id", "chunk", F.array_join("items", " ").alias("items"))


@query("supervised_windows", f"""WITH {SEQ},
w AS (SELECT user_id, pos AS t, n FROM seq WHERE pos >= 15 AND pos <= n - 15)
SELECT w.user_id, w.t,
  (SELECT string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY pos) FROM seq s WHERE s.user_id = w.user_id AND s.pos BETWEEN w.t - 14 AND w.t) AS inputs,
  (SELECT string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY pos) FROM seq s WHERE s.user_id = w.user_id AND s.pos BETWEEN w.t + 1 AND w.t + 15) AS outputs,
  '0 ' || (SELECT string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY pos) FROM seq s WHERE s.user_id = w.user_id AND s.pos BETWEEN w.t + 1 AND w.t + 14) AS decoder_inputs
FROM w""")
def supervised_windows(spark, d):
    w = Q.supervised_windows(_seq(spark, d), 15, 15)
    return w.select(
        "user_id", "t",
        *[F.array_join(c, " ").alias(c) for c in ("inputs", "outputs", "decoder_inputs")],
    )


@query("discounted_return", f"""WITH RECURSIVE {SEQ},
r(user_id, pos, ret) AS (
  SELECT user_id, pos, reward FROM seq WHERE pos = n
  UNION ALL
  SELECT s.user_id, s.pos, s.reward + 0.9 * r.ret FROM seq s JOIN r ON s.user_id = r.user_id AND s.pos = r.pos - 1)
SELECT user_id, pos, round(ret, 6) AS ret FROM r""")
def discounted_return(spark, d):
    r = Q.discounted_return(_seq(spark, d, keep_block=True), 0.9)
    return r.select("user_id", "pos", fround("ret", 6).alias("ret"))


def _steps(seq):
    nxt = lag_join(seq, "user_id", ["state"], k=-1, prefix="next_")
    return nxt.select(F.col("state").alias("s"), F.col("obs").alias("a"), F.col("reward").alias("r"),
                      F.col("next_state").alias("s_next"))


def _q_sql(gamma: float, iters: int) -> str:
    parts = [f"""WITH {SEQ},
steps AS (SELECT state AS s, obs AS a, reward AS r, lead(state) OVER (PARTITION BY user_id ORDER BY pos) AS s_next FROM seq),
agg AS (SELECT s, a, s_next, COUNT(*) AS c, SUM(r) AS rsum FROM steps GROUP BY ALL),
nsa AS (SELECT s, a, SUM(c) AS n, SUM(rsum) AS rs FROM agg GROUP BY ALL),
q0 AS (SELECT s, a, 0.0 AS q FROM nsa)"""]
    for i in range(1, iters + 1):
        parts.append(f"""q{i} AS (
  SELECT n.s, n.a, (n.rs + {gamma} * COALESCE(f.fv, 0.0)) / n.n AS q FROM nsa n LEFT JOIN (
    SELECT g.s, g.a, SUM(g.c * COALESCE(v.v, 0.0)) AS fv FROM agg g
    LEFT JOIN (SELECT s AS s_next, max(q) AS v FROM q{i - 1} GROUP BY 1) v ON v.s_next = g.s_next
    GROUP BY 1, 2) f ON f.s = n.s AND f.a = n.a)""")
    return ",\n".join(parts) + f"\nSELECT s, a, round(q, 6) AS q FROM q{iters}"


@query("q_iteration", _q_sql(0.9, 10))
def q_iteration(spark, d):
    q = Q.q_iteration(_steps(_seq(spark, d)), 0.9, 10)
    return q.select("s", "a", fround("q", 6).alias("q"))


def _tables(spark, d):
    return Q.HmmTables(Q.hmm_fit(_seq(spark, d)).collect())


@query("viterbi")
def viterbi(spark, d):
    """Rows-only: decoded state per event and path score per user."""
    tab = _tables(spark, d)
    return Q.viterbi(_seq(spark, d, keep_block=True), tab)


@query("hmm_forward")
def hmm_forward(spark, d):
    """Rows-only: log P(observations) per user."""
    tab = _tables(spark, d)
    return Q.hmm_forward(_seq(spark, d, keep_block=True), tab)


# ------------------------------------------------------------ learned without states

STATES = ["s0", "s1", "s2"]
BANDS = [name for _, name in Q.VALUE_BANDS] + [Q.TOP_BAND]
START_MODEL = H.initial_model(len(STATES), len(BANDS))


def _passes_sql(m: H.Hmm) -> str:
    """Forward and backward vectors of each step, scaled to sum 1, and the posteriors `g0, g1, ...`."""
    s = range(m.size)
    emit = ", ".join("CASE obs " + " ".join(f"WHEN '{b}' THEN {float(m.emit[i, o])!r}::DOUBLE" for o, b in enumerate(BANDS)) + f" ELSE 1 END AS e{i}" for i in s)

    def into(j, terms):
        return "(" + " + ".join(terms) + f") AS {j}"

    ahead = ", ".join(into(f"x{j}", [f"f.a{i} * {float(m.move[i, j])!r}" for i in s]).replace(f" AS x{j}", f" * e{j} AS x{j}") for j in s)
    back = ", ".join(into(f"x{i}", [f"{float(m.move[i, j])!r} * b.e{j} * b.b{j}" for j in s]) for i in s)
    total = " + ".join(f"x{i}" for i in s)
    cols = lambda c: ", ".join(f"{c}{i}" for i in s)
    scaled = lambda c: ", ".join(f"x{i} / ({total}) AS {c}{i}" for i in s)
    return f"""em AS MATERIALIZED (SELECT user_id, pos, n, obs, {emit} FROM seq),
f(user_id, pos, {cols("a")}, c) AS (
  SELECT user_id, pos, {scaled("a")}, {total} FROM (SELECT user_id, pos, {", ".join(f"{float(m.start[i])!r} * e{i} AS x{i}" for i in s)} FROM em WHERE pos = 1)
  UNION ALL
  SELECT user_id, pos, {scaled("a")}, {total} FROM (SELECT em.user_id, em.pos, {ahead} FROM f JOIN em ON em.user_id = f.user_id AND em.pos = f.pos + 1)),
b(user_id, pos, {cols("b")}, {cols("e")}) AS (
  SELECT user_id, pos, {", ".join(f"{float(m.stop[i])!r}::DOUBLE" for i in s)}, {cols("e")} FROM em WHERE pos = n
  UNION ALL
  SELECT user_id, pos, {scaled("b")}, {cols("e")} FROM (SELECT em.user_id, em.pos, {back}, {", ".join(f"em.e{i}" for i in s)} FROM b JOIN em ON em.user_id = b.user_id AND em.pos = b.pos - 1)),
g AS MATERIALIZED (
  SELECT em.user_id, em.pos, em.n, em.obs, f.c, {cols("a")}, {cols("b")}, {", ".join(f"em.e{i}" for i in s)}, {", ".join(f"a{i} * b{i} / ({' + '.join(f'a{k} * b{k}' for k in s)}) AS g{i}" for i in s)}
  FROM em JOIN f ON f.user_id = em.user_id AND f.pos = em.pos JOIN b ON b.user_id = em.user_id AND b.pos = em.pos)"""


def _step_sql(m: H.Hmm) -> str:
    s = range(m.size)
    terms = [[f"p.a{i} * {float(m.move[i, j])!r} * q.e{j} * q.b{j}" for j in s] for i in s]
    whole = " + ".join(t for r in terms for t in r)
    counts = [f"SELECT 'trans' AS kind, 'START' AS a, '{STATES[i]}' AS b, sum(g{i}) AS w FROM g WHERE pos = 1" for i in s]
    counts += [f"SELECT 'trans', '{STATES[i]}', 'END', sum(g{i}) FROM g WHERE pos = n" for i in s]
    counts += [f"SELECT 'trans', '{STATES[i]}', '{STATES[j]}', sum({terms[i][j]} / ({whole})) FROM g p JOIN g q ON q.user_id = p.user_id AND q.pos = p.pos + 1" for i in s for j in s]
    counts += [f"SELECT 'emit', '{STATES[i]}', '{b}', coalesce(sum(g{i}) FILTER (obs = '{b}'), 0) FROM g" for i in s for b in BANDS]
    return f"""WITH RECURSIVE {SEQ}, {_passes_sql(m)},
counts AS ({" UNION ALL ".join(counts)})
SELECT kind, a, b, round(w / sum(w) OVER (PARTITION BY kind, a), 6) AS prob FROM counts
UNION ALL SELECT 'loglik', '', '', round(sum(ln(c)) + (SELECT sum(ln({" + ".join(f"a{i} * {float(m.stop[i])!r}" for i in s)})) FROM g WHERE pos = n), 4) FROM g"""


def _segments(spark, d):
    return H.segments(_seq(spark, d), BANDS)


@query("baum_welch_step", _step_sql(START_MODEL))
def baum_welch_step(spark, d):
    """One re-estimation from a fixed start: the new model and the log likelihood of the old one."""
    m, logs = H.baum_welch(_segments(spark, d), START_MODEL, 1)
    rows = [(*r[:3], round(r[3], 6)) for r in H.model_rows(m, STATES, BANDS)] + [("loglik", "", "", round(logs[0], 4))]
    return spark.createDataFrame(rows, "kind string, a string, b string, prob double")


@query("baum_welch")
def baum_welch(spark, d):
    """Rows-only: the model after ten re-estimations, and the log likelihood before each and after the last."""
    m, logs = H.baum_welch(_segments(spark, d), START_MODEL, 10)
    rows = H.model_rows(m, STATES, BANDS) + [("loglik", str(i), "", x) for i, x in enumerate(logs)]
    return spark.createDataFrame(rows, "kind string, a string, b string, prob double")


@query("hmm_posterior", f"""WITH RECURSIVE {SEQ}, {_passes_sql(START_MODEL)}
SELECT user_id, pos, {", ".join(f"round(g{i}, 6) AS p_{x}" for i, x in enumerate(STATES))} FROM g""")
def hmm_posterior(spark, d):
    """Probability of each hidden state at each event, given the user's whole sequence."""
    p = H.posteriors(START_MODEL, _segments(spark, d))
    return p.select(F.col("key").alias("user_id"), "pos", *[fround(F.col("state")[i], 6).alias(f"p_{x}") for i, x in enumerate(STATES)])
