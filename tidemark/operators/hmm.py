"""Hidden Markov models learned from observations alone (Baum-Welch) and state posteriors.

A sequence is cut into segments of `SEGMENT` steps; a segment is one row with its observation codes.  Tasks run many
segments side by side, one array step for each position, so Python loops over positions and not over rows.

A segment is a product of matrices (states x states).  Sequences of several segments are stitched by these products:
runs of `RUN` segments are multiplied, each sequence passes once over its runs, and the forward vector that enters and the
backward vector that leaves go back down to runs and segments.  A sequence with a third of all rows thus spreads over
tasks; the task that holds its runs sees one row for each million steps.

The model (states, alphabet) lives on the driver and must be small: states x (states + observations) numbers go to
tasks and come back as sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordered import join_on
from tidemark.plans.scale import cut_lineage

SEGMENT = 256
RUN = 4096
#: Segments that are computed side by side.
LANES = 1024


@dataclass
class Hmm:
    """start[i], move[i, j], stop[i] and emit[i, o]; move and stop of a state add up to 1."""

    start: np.ndarray
    move: np.ndarray
    stop: np.ndarray
    emit: np.ndarray

    @property
    def size(self) -> int:
        return len(self.start)

    def seen(self, codes: np.ndarray) -> np.ndarray:
        """Likelihood of each code (last axis: states); an unknown code, -1, says nothing about the state."""
        table = np.vstack([self.emit.T, np.ones(self.size)])
        return table[codes]


def initial_model(states: int, observations: int) -> Hmm:
    """A start that is the same everywhere: states prefer to stay, and state i prefers the observations o = i, i + states, ..."""
    move = np.ones((states, states)) + np.eye(states)
    total = move.sum(1) + 0.5
    emit = 1.0 + (np.arange(observations)[None, :] % states == np.arange(states)[:, None])
    return Hmm(np.full(states, 1 / states), move / total[:, None], 0.5 / total, emit / emit.sum(1, keepdims=True))


def segments(seq: DataFrame, alphabet: list[str], key: str = "user_id", obs: str = "obs", length: int = SEGMENT) -> DataFrame:
    """key, seg, at (rows before it), codes, alone, last of sequences with dense positions `pos` from 1 and rows `n`.

    Observations that are null or not in the alphabet have code -1.
    """
    code = F.coalesce(F.array_position(F.array(*[F.lit(a) for a in alphabet]), F.col(obs)).cast("int") - 1, F.lit(-1))
    seg = F.floor((F.col("pos") - 1) / length).cast("bigint")
    rows = seq.groupBy(key, seg.alias("seg")).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", code.alias("code")))).alias("_r"))
    return cut_lineage(rows.select(F.col(key).alias("key"), "seg", (F.col("seg") * length).alias("at"), F.col("_r.code").alias("codes"),
                                   (F.col("n") <= length).alias("alone"), ((F.col("seg") + 1) * length >= F.col("n")).alias("last")))


# ---------------------------------------------------------------- array steps over many segments

def _padded(codes: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(c) for c in codes])
    out = np.full((len(codes), size.max(initial=0)), -1, np.int64)
    for i, c in enumerate(codes):
        out[i, : len(c)] = c
    return out, size


def _scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (all axes but the first) divided by their sums, and the logarithms of the sums."""
    total = x.reshape(len(x), -1).sum(1)
    safe = np.where(total > 0, total, 1.0).reshape(-1, *[1] * (x.ndim - 1))
    with np.errstate(divide="ignore"):
        return x / safe, np.log(total)


def _products(hmm: Hmm, codes: np.ndarray, size: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each segment the matrix from the state before it to its last state, scaled, and the logarithm of the scale.

    A first segment has the forward vector in all rows, so that any vector of sum 1 enters it.
    """
    n, s = len(codes), hmm.size
    now, log = np.broadcast_to(np.eye(s), (n, s, s)).copy(), np.zeros(n)
    for t in range(codes.shape[1]):
        on = size > t
        step = now[on] @ hmm.move
        if t == 0:
            step[first[on]] = hmm.start
        step, more = _scaled(step * hmm.seen(codes[on, t])[:, None, :])
        now[on] = step
        log[on] += more
    return now, log


def _passes(hmm: Hmm, codes: np.ndarray, size: np.ndarray, first: np.ndarray, enter: np.ndarray, leave: np.ndarray):
    """Forward vectors (sum 1), backward vectors (any scale) of each position, and the logarithm of the forward scale."""
    n, length = codes.shape
    ahead, back, log = np.zeros((n, length, hmm.size)), np.zeros((n, length, hmm.size)), np.zeros(n)
    now = enter
    for t in range(length):
        on = size > t
        step = now @ hmm.move
        if t == 0:
            step = np.where(first[:, None], hmm.start, step)
        step, more = _scaled(step * hmm.seen(codes[:, t]))
        now = np.where(on[:, None], step, now)
        ahead[:, t] = now
        log += np.where(on, more, 0.0)
    now = leave
    for t in range(length - 1, -1, -1):
        on = size > t
        last = size == t + 1
        if t + 1 < length:
            step = _scaled((hmm.seen(codes[:, t + 1]) * back[:, t + 1]) @ hmm.move.T)[0]
            now = np.where(last[:, None], leave, step)
        back[:, t] = np.where(on[:, None], now, 0.0)
    return ahead, back, log


def _posteriors(ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
    both = ahead * back
    total = both.sum(2, keepdims=True)
    return both / np.where(total > 0, total, 1.0)


def _counts(hmm: Hmm, codes, size, first, last, enter, leave) -> np.ndarray:
    """Expected counts of starts, moves, stops and emissions, one after the other, flat, over all segments."""
    ahead, back, _ = _passes(hmm, codes, size, first, enter, leave)
    state = _posteriors(ahead, back)
    before = np.concatenate([enter[:, None], ahead[:, :-1]], axis=1)
    after = hmm.seen(codes) * back
    total = np.einsum("nti,ij,ntj->nt", before, hmm.move, after)
    on = np.arange(codes.shape[1])[None, :] < size[:, None]
    on[:, :1] &= ~first[:, None]  # a sequence's first step starts, it doesn't move
    share = np.where(on & (total > 0), 1.0 / np.where(total > 0, total, 1.0), 0.0)
    moves = np.einsum("nti,ntj,nt->ij", before, after, share) * hmm.move
    starts = state[first, 0].sum(0)
    stops = state[np.arange(len(codes)), size - 1][last].sum(0)
    emits = np.zeros((hmm.size, hmm.emit.shape[1]))
    for o in range(hmm.emit.shape[1]):
        emits[:, o] = state[codes == o].sum(0)
    return np.concatenate([starts, moves.ravel(), stops, emits.ravel()])


# ---------------------------------------------------------------- Spark passes

def _lanes(batches: Iterator[pa.RecordBatch]):
    """Columns as lists, some rows at a time."""
    for b in batches:
        for lo in range(0, b.num_rows, LANES):
            yield b.schema.names, [c.to_pylist() for c in b.slice(lo, LANES).columns]


def _single(hmm: Hmm, batches):
    """(enter, leave, log likelihood) are known at once where a sequence is one segment."""
    for names, cols in _lanes(batches):
        row = dict(zip(names, cols))
        codes, size = _padded(row["codes"])
        n = len(size)
        yield row, codes, size, np.ones(n, bool), np.ones(n, bool), np.tile(hmm.start, (n, 1)), np.tile(hmm.stop, (n, 1))


def _stitched(hmm: Hmm, batches):
    for names, cols in _lanes(batches):
        row = dict(zip(names, cols))
        codes, size = _padded(row["codes"])
        yield row, codes, size, np.array(row["seg"]) == 0, np.array(row["last"]), np.array(row["enter"]), np.array(row["leave"])


def _enter_leave(hmm: Hmm, segs: DataFrame, run: int) -> DataFrame:
    """segs with enter, leave (vectors) and log (likelihood of the whole sequence, in the row of its first segment)."""
    s = hmm.size

    def products(batches):
        for names, cols in _lanes(batches):
            row = dict(zip(names, cols))
            codes, size = _padded(row["codes"])
            p, log = _products(hmm, codes, size, np.array(row["seg"]) == 0)
            yield pa.RecordBatch.from_arrays([pa.array(row["key"], kind), pa.array(row["seg"], pa.int64()), pa.array(p.reshape(len(p), -1).tolist(), pa.list_(pa.float64())), pa.array(log)], names=["key", "seg", "p", "log"])

    def multiplied(pdf):
        pdf = pdf.sort_values("seg")
        now, log = None, 0.0
        for p, more in zip(pdf["p"], pdf["log"]):
            p = np.asarray(p).reshape(1, s, s)
            now, scale = _scaled(p if now is None else now @ p)
            log += more + scale[0]
        return pdf.head(1)[["key", "run"]].assign(p=[now.ravel().tolist()], log=log)

    def vectors(pdf, order: str, first: str | None = None, last: str | None = None):
        """Vectors before and after each row's matrix, in one pass forward and one backward."""
        pdf = pdf.sort_values(order).reset_index(drop=True)
        mats = [np.asarray(p).reshape(s, s) for p in pdf["p"]]
        now = hmm.start if first is None else np.asarray(pdf[first].iloc[0])
        enter, leave, log = [], [None] * len(mats), 0.0
        for p, more in zip(mats, pdf["log"]):
            enter.append(now.tolist())
            step, scale = _scaled((now @ p)[None])
            now, log = step[0], log + more + scale[0]
        end = hmm.stop if last is None else np.asarray(pdf[last].iloc[0])
        with np.errstate(divide="ignore"):
            log += np.log(now @ end)
        for i in range(len(mats) - 1, -1, -1):
            leave[i] = end.tolist()
            end = _scaled((mats[i] @ end)[None])[0][0]
        return pdf.assign(enter=enter, leave=leave, log=log)

    from pyspark.sql.pandas.types import to_arrow_type

    spec = segs.schema["key"].dataType.simpleString()
    kind = to_arrow_type(segs.schema["key"].dataType)
    mats = segs.select("key", "seg", "codes").mapInArrow(products, f"key {spec}, seg bigint, p array<double>, log double")
    mats = cut_lineage(mats.withColumn("run", F.floor(F.col("seg") / run).cast("bigint")))
    runs = mats.groupBy("key", "run").applyInPandas(multiplied, f"key {spec}, run bigint, p array<double>, log double")
    whole = runs.groupBy("key").applyInPandas(
        lambda pdf: vectors(pdf, "run")[["key", "run", "enter", "leave", "log"]],
        f"key {spec}, run bigint, enter array<double>, leave array<double>, log double")
    whole = whole.select("key", "run", F.col("enter").alias("e"), F.col("leave").alias("l"), F.col("log").alias("whole"))
    parts = join_on(mats, whole, ["key", "run"]).groupBy("key", "run").applyInPandas(
        lambda pdf: vectors(pdf, "seg", "e", "l").assign(log=lambda x: x["whole"])[["key", "seg", "enter", "leave", "log"]],
        f"key {spec}, seg bigint, enter array<double>, leave array<double>, log double")
    return join_on(segs, parts, ["key", "seg"])


def _ready(hmm: Hmm, segs: DataFrame, run: int = RUN):
    """(table, how a task reads it) of sequences of one segment and of longer ones."""
    yield segs.filter("alone"), _single
    longer = segs.filter("NOT alone")
    if not longer.isEmpty():
        yield _enter_leave(hmm, longer, run), _stitched


def expected_counts(hmm: Hmm, segs: DataFrame, run: int = RUN) -> tuple[np.ndarray, float]:
    """The counts of `_counts` over all sequences, and their log likelihood; one row for each task comes together."""
    width = 2 * hmm.size + hmm.size**2 + hmm.emit.size

    def summed(read):
        def task(batches):
            total = np.zeros(width + 1)
            for row, codes, size, first, last, enter, leave in read(hmm, batches):
                total[:width] += _counts(hmm, codes, size, first, last, enter, leave)
                if "log" in row:
                    total[width] += sum(x for x, f in zip(row["log"], first) if f)
                else:
                    ahead, _, log = _passes(hmm, codes, size, first, enter, leave)
                    with np.errstate(divide="ignore"):
                        total[width] += (log + np.log(ahead[np.arange(len(size)), size - 1] @ hmm.stop)).sum()
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["x"])
        return task

    rows = None
    for table, read in _ready(hmm, segs, run):
        some = table.mapInArrow(summed(read), "x array<double>")
        rows = some if rows is None else rows.unionByName(some)
    sums = rows.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
    out = np.zeros(width + 1)
    for r in sums.collect():  # as many as the model has numbers
        out[r["i"]] = r["x"]
    return out[:width], float(out[width])


def maximized(hmm: Hmm, counts: np.ndarray) -> Hmm:
    """The model of the greatest expected likelihood; what was never expected keeps its row."""
    s, o = hmm.size, hmm.emit.shape[1]
    start, move, stop, emit = np.split(counts, np.cumsum([s, s * s, s]))
    move, emit = move.reshape(s, s), emit.reshape(s, o)
    out, seen = move.sum(1) + stop, emit.sum(1)

    def shared(x, total, old):
        return np.where(total > 0, x / np.where(total > 0, total, 1.0), old)

    return Hmm(start / start.sum() if start.sum() > 0 else hmm.start, shared(move, out[:, None], hmm.move), shared(stop, out, hmm.stop), shared(emit, seen[:, None], hmm.emit))


def baum_welch(segs: DataFrame, hmm: Hmm, rounds: int) -> tuple[Hmm, list[float]]:
    """The model after `rounds` re-estimations, and the log likelihood before each and after the last.

    A sequence that the model holds impossible adds nothing to the counts, and the likelihood is then -inf.
    """
    logs = []
    for _ in range(rounds):
        counts, log = expected_counts(hmm, segs)
        hmm = maximized(hmm, counts)
        logs.append(log)
    return hmm, [*logs, expected_counts(hmm, segs)[1]]


def posteriors(hmm: Hmm, segs: DataFrame, run: int = RUN) -> DataFrame:
    """M34, forward and backward: key, pos, state (array: probability of each state given the whole sequence)."""
    spec = segs.schema["key"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(segs.schema["key"].dataType)

    def states(read):
        def task(batches):
            for row, codes, size, first, _, enter, leave in read(hmm, batches):
                p = _posteriors(*_passes(hmm, codes, size, first, enter, leave)[:2])
                for i, (key, at, n) in enumerate(zip(row["key"], row["at"], size.tolist())):
                    flat = pa.ListArray.from_arrays(pa.array(range(0, n * hmm.size + 1, hmm.size), pa.int32()), pa.array(p[i, :n].ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array([key] * n, kind), pa.array(np.arange(n) + at + 1), flat], names=["key", "pos", "state"])
        return task

    out = None
    for table, read in _ready(hmm, segs, run):
        some = table.mapInArrow(states(read), f"key {spec}, pos bigint, state array<double>")
        out = some if out is None else out.unionByName(some)
    return out


def model_rows(hmm: Hmm, states: list[str], alphabet: list[str]) -> list[tuple[str, str, str, float]]:
    """(kind, a, b, prob) as `sequence.hmm_fit` has them: trans with START and END, and emit."""
    rows = [("trans", "START", b, p) for b, p in zip(states, hmm.start.tolist())]
    rows += [("trans", a, b, p) for a, r in zip(states, hmm.move.tolist()) for b, p in zip(states, r)]
    rows += [("trans", a, "END", p) for a, p in zip(states, hmm.stop.tolist())]
    return rows + [("emit", a, b, p) for a, r in zip(states, hmm.emit.tolist()) for b, p in zip(alphabet, r)]
