"""Sequence operators: Markov/HMM counting, decoding, lags, windows, returns.

Sequences are (key, pos) rows with dense positions from
`tidemark.plans.ordered.with_positions`; look-backs are equi-joins on
(key, pos - k).  Sequential recurrences (Viterbi, forward probability,
discounted return) run per ordered block of bounded size, as sorted Arrow
batches or in `applyInPandas`, and blocks are stitched through their
one-row-per-block summaries, so a hot key never lands in one task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.plans.ordered import DEFAULT_BLOCK_ROWS, join_on, lag_join, trailing_agg, with_positions
from tidemark.plans.scale import cut_lineage, written

START, END = "START", "END"

# ---------------------------------------------------------------------------
# Observation bands for event values (upper bounds, exclusive).
VALUE_BANDS = [(10.0, "v0"), (50.0, "v1"), (100.0, "v2")]
TOP_BAND = "v3"
# ---------------------------------------------------------------------------


def value_band(col: F.Column) -> F.Column:
    expr = None
    for hi, name in VALUE_BANDS:
        expr = F.when(col < hi, F.lit(name)) if expr is None else expr.when(col < hi, F.lit(name))
    return expr.otherwise(F.lit(TOP_BAND))


def event_sequences(events: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS, keep_block: bool = False) -> DataFrame:
    """(user_id, pos, n, event_id, ts, state, obs, reward) ordered by ts, event_id."""
    e = events.select(
        "user_id", "event_id", "ts",
        F.col("event_type").alias("state"),
        value_band(F.col("value")).alias("obs"),
        F.col("value").alias("reward"),
    )
    return with_positions(e, "user_id", ["ts", "event_id"], block_rows=block_rows, keep_block=keep_block)


def padded_bigrams(seq: DataFrame, key: str = "user_id", state: str = "state") -> DataFrame:
    """(prev, cur) for every step with START before the first and END after
    the last row of each sequence (A8 padding, no cross-sequence pairs)."""
    lagged = lag_join(seq, key, [state])
    steps = lagged.select(
        F.coalesce(F.col("prev_" + state), F.lit(START)).alias("prev"), F.col(state).alias("cur")
    )
    ends = seq.filter(F.col("pos") == F.col("n")).select(F.col(state).alias("prev"), F.lit(END).alias("cur"))
    return steps.unionByName(ends)


def cond_prob(pairs: DataFrame, given: str, of: str) -> DataFrame:
    """count(a, b) and MLE count(a, b) / count(a)."""
    c = pairs.groupBy(given, of).agg(F.count(F.lit(1)).alias("count"))
    # rows per `given` = distinct outcomes, bounded by the outcome alphabet
    tot = F.sum("count").over(Window.partitionBy(given))
    return c.withColumn("prob", F.col("count") / tot)


def transitions(seq: DataFrame) -> DataFrame:
    """START/END-padded transition counts and probabilities."""
    return cond_prob(padded_bigrams(seq), "prev", "cur").withColumnRenamed("prev", "from_state").withColumnRenamed(
        "cur", "to_state"
    )


def emissions(seq: DataFrame) -> DataFrame:
    """A7 on (state, obs): emission counts and probabilities."""
    return cond_prob(seq.select("state", "obs"), "state", "obs")


def hmm_fit(seq: DataFrame) -> DataFrame:
    """Both tables in one frame: (kind, a, b, count, prob)."""
    t = transitions(seq).select(F.lit("trans").alias("kind"), F.col("from_state").alias("a"),
                                F.col("to_state").alias("b"), "count", "prob")
    e = emissions(seq).select(F.lit("emit").alias("kind"), F.col("state").alias("a"),
                              F.col("obs").alias("b"), "count", "prob")
    return t.unionByName(e)


def seq_logprob(seq: DataFrame, trans: DataFrame, emit: DataFrame, key: str = "user_id") -> DataFrame:
    """Ln P(states, observations) per sequence: padded transitions plus
    emissions; an unseen transition or emission gives null (log 0)."""
    tl = trans.select(F.col("from_state").alias("prev"), F.col("to_state").alias("cur"), F.log("prob").alias("lp"))
    el = emit.select("state", "obs", F.log("prob").alias("lp"))
    lagged = lag_join(seq, key, ["state"])
    steps = lagged.select(key, F.coalesce(F.col("prev_state"), F.lit(START)).alias("prev"), F.col("state").alias("cur"))
    ends = seq.filter(F.col("pos") == F.col("n")).select(key, F.col("state").alias("prev"), F.lit(END).alias("cur"))
    tpart = steps.unionByName(ends).join(tl, ["prev", "cur"], "left").select(key, "lp")
    epart = seq.select(key, "state", "obs").join(el, ["state", "obs"], "left").select(key, "lp")
    both = tpart.unionByName(epart)
    return both.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_terms"),
        F.when(F.count("lp") == F.count(F.lit(1)), F.sum("lp")).alias("logprob"),
    )


def moving_avg(seq: DataFrame, value: str, w: int, key: str = "user_id") -> DataFrame:
    """Average of the w previous values; the first w rows keep their value."""
    t = trailing_agg(seq, key, value, w)
    return t.withColumn("ma", F.when(F.col("pos") <= w, F.col(value)).otherwise(F.col("trail_avg"))).drop(
        "trail_avg", "trail_n"
    )


def lag_features(seq: DataFrame, col: str, lags: list[int], key: str = "user_id") -> DataFrame:
    """x[t-k] columns; null before the start (no wrap-around)."""
    out = seq
    for k in lags:
        out = lag_join(out, key, [col], k=k, prefix=f"lag{k}_")
    return out


def chunks(seq: DataFrame, n: int, key: str = "user_id", item: str = "event_id") -> DataFrame:
    """Consecutive chunks of n rows, the incomplete remainder dropped."""
    c = seq.filter(F.col("pos") <= F.floor(F.col("n") / n) * n).withColumn(
        "chunk", ((F.col("pos") - 1) / n).cast("bigint") + 1
    )
    # groups are (key, chunk): at most n rows each
    return c.groupBy(key, "chunk").agg(
        F.sort_array(F.collect_list(F.struct("pos", item))).alias("_r")
    ).select(key, "chunk", F.col("_r." + item).alias("items"))


def supervised_windows(seq: DataFrame, h: int, f: int, key: str = "user_id", item: str = "event_id") -> DataFrame:
    """For every t with h rows of history (t-h+1..t) and f rows ahead
    (t+1..t+f): input window, output window and the decoder input (0 then
    the output shifted right).  Each row is scattered to the h+f windows it
    belongs to, then windows regroup by (key, t): bounded by h+f rows."""
    hist = seq.select(key, F.explode(F.sequence(F.col("pos"), F.col("pos") + h - 1)).alias("t"),
                      F.lit(0).alias("side"), "pos", item, "n")
    fut = seq.select(key, F.explode(F.sequence(F.col("pos") - f, F.col("pos") - 1)).alias("t"),
                     F.lit(1).alias("side"), "pos", item, "n")
    both = hist.unionByName(fut).filter((F.col("t") >= h) & (F.col("t") <= F.col("n") - f))
    g = both.groupBy(key, "t").agg(
        F.sort_array(F.collect_list(F.when(F.col("side") == 0, F.struct("pos", item)))).alias("_h"),
        F.sort_array(F.collect_list(F.when(F.col("side") == 1, F.struct("pos", item)))).alias("_f"),
    )
    out = F.col("_f." + item)
    return g.select(
        key, "t",
        F.col("_h." + item).alias("inputs"),
        out.alias("outputs"),
        F.concat(F.array(F.lit(0).cast("bigint")), F.slice(out, 1, f - 1)).alias("decoder_inputs"),
    )


# ------------------------------------------------------------ blocked scans

def _local_returns(gamma: float, names: list[str]):
    """Rows sorted by block and falling position: the return inside the block; one value goes on to the next batch."""
    def fn(batches):
        last, acc = None, 0.0
        for b in batches:
            if not b.num_rows:
                continue
            user, blk = b.column(names.index("user_id")), b.column(names.index("_blk"))
            none = user.is_null().to_numpy(zero_copy_only=False)
            u, k = user.fill_null(0).to_numpy(), blk.to_numpy()
            first = np.r_[(bool(none[0]), u[0], k[0]) != last, (none[1:] != none[:-1]) | (u[1:] != u[:-1]) | (k[1:] != k[:-1])]
            r = b.column(names.index("reward")).cast(pa.float64()).to_numpy(zero_copy_only=False)
            out = np.empty_like(r)
            # one sum after the other: doubled sums would round otherwise than the recurrence
            for i, (x, new) in enumerate(zip(r.tolist(), first.tolist())):
                acc = x + gamma * (0.0 if new else acc)
                out[i] = acc
            last = (bool(none[-1]), u[-1], k[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64(), mask=np.isnan(out))], names=[*names, "_local"])
    return fn


def _block_carry(gamma: float):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_blk")
        carry = np.zeros(len(pdf))
        c = 0.0
        first = pdf["_first"].to_numpy(dtype=float)
        length = pdf["_len"].to_numpy(dtype=float)
        for i in range(len(pdf) - 1, -1, -1):
            carry[i] = c
            c = first[i] + (gamma ** length[i]) * c
        return pd.DataFrame({"user_id": pdf["user_id"].to_numpy(), "_blk": pdf["_blk"].to_numpy(), "_carry": carry})
    return fn


def discounted_return(seq_blocked: DataFrame, gamma: float) -> DataFrame:
    """R_t = r_t + gamma * R_(t+1) per sequence.

    Input must carry `n` and `_blk` (with_positions(keep_block=True)).  Rows
    are dealt by block and pass in falling order as Arrow batches, which
    compute the local suffix recurrence of all their blocks at once; of
    sequences of several blocks a per-user pass over the block summaries (one
    row per block) yields the return entering from the next block, and
    R_t = local_t + gamma^(block_end - t + 1) * carry."""
    names = seq_blocked.columns
    dealt = seq_blocked.repartition("user_id", "_blk").sortWithinPartitions("user_id", "_blk", F.col("pos").desc())
    schema = StructType([*seq_blocked.schema.fields, StructField("_local", DoubleType())])
    local = dealt.mapInArrow(_local_returns(gamma, names), schema)
    # only sequences of several blocks, which are cut by partitions' ends, have a return to carry
    cut = local.groupBy("user_id", "_blk").agg(
        F.min_by("_local", "pos").alias("_first"),
        F.count(F.lit(1)).alias("_len"),
        F.max("pos").alias("_end"),
        F.max("n").alias("_n"),
    ).filter(F.col("_len") < F.col("_n"))
    carry = cut.select("user_id", "_blk", "_first", "_len").groupBy("user_id").applyInPandas(
        _block_carry(gamma), "user_id long, _blk int, _carry double"
    )
    # at most two sequences a partition are cut, and their blocks are no more than the partitions
    ends = F.broadcast(join_on(carry, cut.select("user_id", "_blk", "_end"), ["user_id", "_blk"]))
    ret = F.col("_local") + F.pow(F.lit(gamma), F.col("_end") - F.col("pos") + 1) * F.col("_carry")
    whole = join_on(local, ends, ["user_id", "_blk"], "left").withColumn("ret", F.when(F.col("_end").isNull(), F.col("_local")).otherwise(ret))
    return whole.drop("_blk", "_local", "_carry", "_end")


# ------------------------------------------------------------ HMM decoding

class HmmTables:
    """Dense log tables of a fitted HMM (small: states x states, states x obs)."""

    def __init__(self, hmm_rows: list):
        trans = [(r["a"], r["b"], r["prob"]) for r in hmm_rows if r["kind"] == "trans"]
        emit = [(r["a"], r["b"], r["prob"]) for r in hmm_rows if r["kind"] == "emit"]
        self.states = sorted({a for a, _, _ in trans if a != START} | {b for _, b, _ in trans if b != END})
        self.obs = sorted({b for _, b, _ in emit})
        si = {s: i for i, s in enumerate(self.states)}
        oi = {o: i for i, o in enumerate(self.obs)}
        S, O = len(self.states), len(self.obs)
        with np.errstate(divide="ignore"):
            self.A = np.full((S, S), -np.inf)
            self.pi = np.full(S, -np.inf)
            self.end = np.full(S, -np.inf)
            self.B = np.full((S, O), -np.inf)
            for a, b, p in trans:
                if a == START and b in si:
                    self.pi[si[b]] = math.log(p)
                elif b == END and a in si:
                    self.end[si[a]] = math.log(p)
                elif a in si and b in si:
                    self.A[si[a], si[b]] = math.log(p)
            for a, b, p in emit:
                if a in si:
                    self.B[si[a], oi[b]] = math.log(p)
        self.oi = oi

    def emis(self, obs_seq) -> np.ndarray:
        """(L, S) log emission of each observation (unseen symbol: -inf)."""
        S = len(self.states)
        cols = [self.B[:, self.oi[o]] if o in self.oi else np.full(S, -np.inf) for o in obs_seq]
        return np.array(cols).reshape(len(obs_seq), S)


def _maxplus(P: np.ndarray, M: np.ndarray) -> np.ndarray:
    return np.max(P[:, :, None] + M[None, :, :], axis=1)


def _logsumexp_mm(P: np.ndarray, M: np.ndarray) -> np.ndarray:
    x = P[:, :, None] + M[None, :, :]
    m = np.max(x, axis=1)
    safe = np.where(np.isfinite(m), m, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.sum(np.exp(x - safe[:, None, :]), axis=1))


def _block_products(tab: HmmTables, semiring: str):
    """Per block: the entering->exit score matrix (first block: START row)."""
    S = len(tab.states)
    mm = _maxplus if semiring == "max" else _logsumexp_mm

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        E = tab.emis(list(pdf["obs"]))
        first_block = int(pdf["pos"].iloc[0]) == 1
        if first_block:
            P = np.full((S, S), -np.inf)
            P[0, :] = tab.pi + E[0]  # row 0 stands for START
            rest = E[1:]
        else:
            P = np.where(np.eye(S) > 0, 0.0, -np.inf)
            rest = E
        for e in rest:
            P = mm(P, tab.A + e[None, :])
        return pd.DataFrame({"user_id": [pdf["user_id"].iloc[0]], "_blk": [int(pdf["_blk"].iloc[0])],
                             "_first": [first_block], "_P": [P.ravel().tolist()]})
    return fn


def _stitch(tab: HmmTables, semiring: str):
    """Per user over its block summaries: total score and each block's exit
    state (Viterbi) or the total log-likelihood (forward)."""
    S = len(tab.states)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_blk")
        mats = [np.array(p).reshape(S, S) for p in pdf["_P"]]
        deltas = []
        v = None
        for P in mats:
            if v is None:
                v = P[0].copy()
            elif semiring == "max":
                v = np.max(v[:, None] + P, axis=0)
            else:
                v = _logsumexp_mm(v[None, :], P)[0]
            deltas.append(v)
        if semiring == "max":
            final = v + tab.end
            s = int(np.argmax(final))
            score = float(final[s])
            exits = [0] * len(mats)
            exits[-1] = s
            for b in range(len(mats) - 1, 0, -1):
                exits[b - 1] = int(np.argmax(deltas[b - 1] + mats[b][:, exits[b]]))
            return pd.DataFrame({"user_id": pdf["user_id"].to_numpy(), "_blk": pdf["_blk"].to_numpy(),
                                 "_exit": exits, "_enter": [-1] + exits[:-1], "score": score})
        tot = _logsumexp_mm((v + tab.end)[None, :], np.zeros((S, 1)))[0, 0]
        return pd.DataFrame({"user_id": [pdf["user_id"].iloc[0]], "loglik": [float(tot)]})
    return fn


def _decode_block(tab: HmmTables):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        E = tab.emis(list(pdf["obs"]))
        enter, exit_ = int(pdf["_enter"].iloc[0]), int(pdf["_exit"].iloc[0])
        L, S = E.shape
        back = np.zeros((L, S), dtype=np.int64)
        if enter < 0:
            d = tab.pi + E[0]
        else:
            d = tab.A[enter] + E[0]
        for t in range(1, L):
            x = d[:, None] + tab.A
            back[t] = np.argmax(x, axis=0)
            d = x[back[t], np.arange(S)] + E[t]
        path = np.zeros(L, dtype=np.int64)
        path[-1] = exit_
        for t in range(L - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return pd.DataFrame({"user_id": pdf["user_id"].to_numpy(), "pos": pdf["pos"].to_numpy(),
                             "decoded": [tab.states[i] for i in path]})
    return fn


def _decoded(tab: HmmTables, start: np.ndarray, size: np.ndarray, E: np.ndarray):
    """States of all rows and score of each run of rows, step by step for all runs at once.

    Each step adds in the order of `_block_products` (v, scores) and of `_decode_block` (d, back-pointers)."""
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    back = np.zeros(E.shape, np.int32)
    v = tab.pi + E[start]
    d = v.copy()
    for t in range(1, int(size[0])):
        on = int(np.searchsorted(-size, -t, "left"))  # runs of more than t rows come first
        e = E[start[:on] + t]
        v[:on] = np.max(v[:on, :, None] + (tab.A[None] + e[:, None, :]), axis=1)
        x = d[:on, :, None] + tab.A[None]
        best = np.argmax(x, axis=1)
        back[start[:on] + t] = best
        d[:on] = np.take_along_axis(x, best[:, None, :], 1)[:, 0] + e
    final = v + tab.end
    state = np.argmax(final, axis=1)
    score = np.empty(len(size))
    score[order] = final[np.arange(len(size)), state]
    path = np.zeros(len(E), np.int64)
    for t in range(int(size[0]) - 1, -1, -1):
        on = int(np.searchsorted(-size, -t, "left"))
        path[start[:on] + t] = state[:on]
        state[:on] = back[start[:on] + t, state[:on]]
    return path, score


def _decode_whole(tab: HmmTables):
    """Rows sorted by user and position, whole sequences only; the last one of a batch waits for the next batch."""
    names = np.array(tab.states, dtype=object)
    table = np.vstack([tab.B.T, np.full(len(tab.states), -np.inf)])

    def told(parts):
        t = pa.Table.from_batches(parts).combine_chunks()
        pos = t.column("pos").to_numpy()
        start = np.flatnonzero(pos == 1)
        size = np.diff(np.r_[start, len(pos)])
        at = pc.fill_null(pc.index_in(t.column("obs"), value_set=pa.array(tab.obs, pa.string())), len(tab.obs)).to_numpy()
        path, score = _decoded(tab, start, size, table[at])
        return pa.RecordBatch.from_arrays([t.column("user_id").combine_chunks(), t.column("pos").combine_chunks(), pa.array(names[path], pa.string()),
                                           pa.array(np.repeat(score, size), pa.float64())], names=["user_id", "pos", "decoded", "score"])

    def fn(batches):
        waits = []
        for b in batches:
            begins = np.flatnonzero(b.column("pos").to_numpy() == 1)
            if len(begins):
                cut = int(begins[-1])
                done = [x for x in [*waits, b.slice(0, cut)] if x.num_rows]
                if done:
                    yield told(done)
                waits = []
                b = b.slice(cut)
            waits.append(b)
        if any(x.num_rows for x in waits):
            yield told(waits)
    return fn


def viterbi(seq_blocked: DataFrame, tab: HmmTables) -> DataFrame:
    """Most likely state path per sequence with back-pointers and the END
    step; log space, unseen = -inf (no smoothing), ties to the first state in
    sorted order.  Input needs `n` and `_blk` (with_positions(keep_block=True)).

    Sequences inside one block are decoded where they are, all of an Arrow
    batch at once; those of several blocks (at most two a partition are cut)
    are stitched from their blocks."""
    base = seq_blocked.select("user_id", "_blk", "pos", "obs", "n")
    blocks = base.groupBy("user_id", "_blk").agg(F.count(F.lit(1)).alias("_len"), F.max("n").alias("_n"))
    cut = F.broadcast(written(blocks.filter(F.col("_len") < F.col("_n")).select("user_id", "_blk")))
    whole = join_on(base, cut, ["user_id", "_blk"], "left_anti").select("user_id", "pos", "obs")
    whole = whole.repartition("user_id").sortWithinPartitions("user_id", "pos").mapInArrow(
        _decode_whole(tab), "user_id long, pos long, decoded string, score double")
    base = join_on(base, cut, ["user_id", "_blk"]).drop("n")
    prods = base.groupBy("user_id", "_blk").applyInPandas(
        _block_products(tab, "max"), "user_id long, _blk int, _first boolean, _P array<double>"
    )
    exits = prods.groupBy("user_id").applyInPandas(
        _stitch(tab, "max"), "user_id long, _blk int, _exit int, _enter int, score double"
    )
    j = join_on(base, exits.select("user_id", "_blk", "_exit", "_enter"), ["user_id", "_blk"])
    dec = j.groupBy("user_id", "_blk").applyInPandas(_decode_block(tab), "user_id long, pos long, decoded string")
    return whole.unionByName(join_on(dec, exits.select("user_id", "score").distinct(), ["user_id"]))


def hmm_forward(seq_blocked: DataFrame, tab: HmmTables) -> DataFrame:
    """Log P(observations) per sequence (forward algorithm, END step
    included) with the same block stitching in the log-sum-exp semiring."""
    base = seq_blocked.select("user_id", "_blk", "pos", "obs")
    prods = base.groupBy("user_id", "_blk").applyInPandas(
        _block_products(tab, "sum"), "user_id long, _blk int, _first boolean, _P array<double>"
    )
    return prods.groupBy("user_id").applyInPandas(_stitch(tab, "sum"), "user_id long, loglik double")


# ------------------------------------------------------------ Q iteration

def q_iteration(steps: DataFrame, gamma: float, iters: int) -> DataFrame:
    """Q(s,a) = mean over logged (s, a, r, s') of r + gamma * max_a' Q(s',a')
    (terminal s' contributes r only), iterated from Q = 0.

    The logged steps are reduced once to (s, a, s') counts and reward sums;
    iterations then run on that small table, checkpointed each round."""
    agg = steps.groupBy("s", "a", "s_next").agg(
        F.count(F.lit(1)).alias("c"), F.sum("r").alias("rsum")
    )
    agg = cut_lineage(agg)
    n_sa = agg.groupBy("s", "a").agg(F.sum("c").alias("n"), F.sum("rsum").alias("rs"))
    q = n_sa.select("s", "a", F.lit(0.0).alias("q"))
    for _ in range(iters):
        v = q.groupBy("s").agg(F.max("q").alias("v")).withColumnRenamed("s", "s_next")
        fut = agg.join(v, "s_next", "left").groupBy("s", "a").agg(
            F.sum(F.col("c") * F.coalesce(F.col("v"), F.lit(0.0))).alias("fv")
        )
        q = n_sa.join(fut, ["s", "a"], "left").select(
            "s", "a", ((F.col("rs") + gamma * F.coalesce(F.col("fv"), F.lit(0.0))) / F.col("n")).alias("q")
        )
        q = cut_lineage(q)
    return q
