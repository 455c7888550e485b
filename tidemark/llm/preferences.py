"""Chat formatting of preference pairs.

A pair has a chosen and a rejected conversation.  Their longest common prefix of turns (same place, role and text) is
rendered once, as the prompt; what follows is rendered as two completions, each with a loss mask that covers the
assistant's words and end marks and nothing else.  The first difference is a minimum over a join of the turns, so no
conversation is compared inside one row; a conversation only becomes a row when it is rendered.

Cases: turns with a null pair or turn number are left out; a null role or text counts as empty; of rows that repeat a
turn the smallest (role, text) counts; a pair that lacks one side has no common turn; equal sides have empty
completions; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import read, saved
from tidemark.plans.ordered import global_positions

TRAINED = "assistant"


def turns_of(rows: DataFrame, pair: str) -> DataFrame:
    """pair_id, turn, role, text; one row for each pair and turn."""
    text = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    known = rows.filter(F.col(pair).isNotNull() & F.col("turn").isNotNull())
    return known.groupBy(F.col(pair).alias("pair_id"), "turn").agg(F.min(text).alias("x")).select("pair_id", "turn", "x.role", "x.text")


def formatted(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask (trained places as start:end, comma-joined,
    in code points of the completion, ends exclusive) of turns (pair_id, turn, role, text)."""
    side = lambda t, s: t.select("pair_id", "turn", F.struct("role", "text").alias(s))
    both = side(chosen, "c").join(side(rejected, "r"), ["pair_id", "turn"], "full")
    first = both.groupBy("pair_id").agg(F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("turn"))).alias("first"))
    each = both.select("pair_id", "turn", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("c").alias("x")), F.struct(F.lit(1).alias("side"), F.col("r").alias("x")))).alias("e"))
    each = each.select("pair_id", "turn", "e.side", "e.x.role", "e.x.text").filter(F.col("role").isNotNull()).join(first, "pair_id")
    common = F.col("first").isNull() | (F.col("turn") < F.col("first"))
    # the prompt is rendered from the chosen side
    each = each.withColumn("part", F.when(common, 2).otherwise(F.col("side"))).filter(~common | (F.col("side") == 0))
    head = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))
    each = each.withColumn("shown", F.concat(head, F.col("text"), F.lit("<|end|>\n")))
    before = Window.partitionBy("pair_id", "part").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("shown")).over(before), F.lit(0))
    span = F.concat_ws(":", (F.col("at") + F.length(head)).cast("string"), (F.col("at") + F.length("shown") - 1).cast("string"))
    each = each.withColumn("at", at).withColumn("span", F.when(F.col("role") == TRAINED, span))
    gather = lambda p, c: F.transform(F.array_sort(F.collect_list(F.when((F.col("part") == p) & F.col(c).isNotNull(), F.struct("turn", F.col(c).alias("x"))))), lambda e: e["x"])
    text = lambda p: F.array_join(gather(p, "shown"), "")
    mask = lambda p: F.array_join(gather(p, "span"), ",")
    return each.groupBy("pair_id").agg(
        F.count(F.when(F.col("part") == 2, 1)).alias("n_common"), text(2).alias("prompt"), text(0).alias("chosen"), text(1).alias("rejected"),
        mask(0).alias("chosen_mask"), mask(1).alias("rejected_mask"))


def pairs_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns: the table holds no preferences, so a conversation is chosen and the same one, going on
    from a turn that its id sets as the conversation of the next id does (after the last one, of the first), is rejected."""
    turns = turns_of(conversations, "conv_id")
    size = turns.groupBy("pair_id").agg(F.min("turn").alias("lo"), F.count(F.lit(1)).alias("n"))
    number = F.conv(F.substring(F.md5(F.col("pair_id").cast("string").cast("binary")), 1, 6), 16, 10).cast("bigint")
    placed = saved(global_positions(size, ["pair_id"], pos="_at"))
    last = placed.agg(F.max("_at")).first()[0] or 0
    after = placed.select(F.col("pair_id").alias("next"), F.when(F.col("_at") == 0, last).otherwise(F.col("_at") - 1).alias("_at"))
    cuts = saved(placed.join(after, "_at").select("pair_id", "next", (F.col("lo") + 1 + number % F.greatest(F.col("n") - 1, F.lit(1))).alias("cut")))
    head = turns.join(cuts, "pair_id").filter(F.col("turn") < F.col("cut")).drop("cut", "next")
    tail = turns.withColumnRenamed("pair_id", "next").join(cuts, "next").filter(F.col("turn") >= F.col("cut"))
    return turns, head.unionByName(tail.select(*turns.columns))


def op9_preference_pairs(spark, sf_dir: str) -> DataFrame:
    return formatted(*pairs_of(read(spark, sf_dir, "conversations")))


OP9_SQL = r"""
WITH t AS (
  SELECT conv_id AS pair_id, turn, min(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))) AS x
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2),
size AS (SELECT pair_id, min(turn) AS lo, count(*) AS n FROM t GROUP BY 1),
cuts AS (
  SELECT pair_id, coalesce(lead(pair_id) OVER (ORDER BY pair_id), min(pair_id) OVER ()) AS next,
    lo + 1 + CAST('0x' || substr(md5(CAST(pair_id AS VARCHAR)), 1, 6) AS BIGINT) % greatest(n - 1, 1) AS cut
  FROM size),
c AS (SELECT pair_id, turn, x FROM t),
r AS (
  SELECT t.pair_id, turn, x FROM t JOIN cuts USING (pair_id) WHERE turn < cut
  UNION ALL SELECT cuts.pair_id, turn, x FROM t JOIN cuts ON cuts.next = t.pair_id WHERE turn >= cut),
b AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.turn, r.turn) AS turn, c.x AS cx, r.x AS rx
  FROM c FULL JOIN r ON c.pair_id = r.pair_id AND c.turn = r.turn),
f AS (SELECT pair_id, min(CASE WHEN cx IS DISTINCT FROM rx THEN turn END) AS first FROM b GROUP BY 1),
e AS (
  SELECT b.pair_id, turn, 2 AS part, cx AS x FROM b JOIN f USING (pair_id) WHERE cx IS NOT NULL AND (first IS NULL OR turn < first)
  UNION ALL SELECT b.pair_id, turn, 0, cx FROM b JOIN f USING (pair_id) WHERE cx IS NOT NULL AND turn >= first
  UNION ALL SELECT b.pair_id, turn, 1, rx FROM b JOIN f USING (pair_id) WHERE rx IS NOT NULL AND turn >= first),
s AS (
  SELECT *, '<|' || x.role || '|>' || chr(10) AS head, '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10) AS shown FROM e),
p AS (
  SELECT *, coalesce(sum(length(shown)) OVER (PARTITION BY pair_id, part ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM s)
SELECT pair_id, count(*) FILTER (WHERE part = 2) AS n_common,
  coalesce(string_agg(shown, '' ORDER BY turn) FILTER (WHERE part = 2), '') AS prompt,
  coalesce(string_agg(shown, '' ORDER BY turn) FILTER (WHERE part = 0), '') AS chosen,
  coalesce(string_agg(shown, '' ORDER BY turn) FILTER (WHERE part = 1), '') AS rejected,
  coalesce(string_agg(CAST(off + length(head) AS BIGINT) || ':' || CAST(off + length(shown) - 1 AS BIGINT), ',' ORDER BY turn) FILTER (WHERE part = 0 AND x.role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(CAST(off + length(head) AS BIGINT) || ':' || CAST(off + length(shown) - 1 AS BIGINT), ',' ORDER BY turn) FILTER (WHERE part = 1 AND x.role = 'assistant'), '') AS rejected_mask
FROM p GROUP BY 1
"""
