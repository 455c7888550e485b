"""Experiment and online-metric queries over `customer` and `events`."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.hashing import md5_mod_sql
from tidemark.functions.numeric import fround
from tidemark.operators import experiment as X
from tidemark.plans import views
from tidemark.plans.scale import topn_per
from tidemark.registry import query


def _arm_sql(bucket: str) -> str:
    cum, parts = 0.0, []
    for name, share in X.EXPERIMENTS:
        cum += share
        parts.append(f"WHEN {bucket} < {cum!r} THEN '{name}'")
    return f"CASE {' '.join(parts)} ELSE '{X.FALLBACK_ARM}' END"


def _bucket_sql(layer: str, user: str) -> str:
    return f"({md5_mod_sql(f"'{layer}:' || CAST({user} AS VARCHAR)", 1000)}) / 1000.0"


ROUTED = f"""routed AS (
  SELECT c_custkey, {_bucket_sql('recall', 'c_custkey')} AS recall_bucket,
         {_bucket_sql('rank', 'c_custkey')} AS rank_bucket FROM customer),
arms AS (SELECT c_custkey, recall_bucket, {_arm_sql('recall_bucket')} AS recall_arm,
                rank_bucket, {_arm_sql('rank_bucket')} AS rank_arm FROM routed)"""


def _routed(spark, d):
    users = views.table(spark, d, "customer").select("c_custkey")
    return X.route(users, "c_custkey", ["recall", "rank"])


@query("hash_split", f"""SELECT c_custkey, {md5_mod_sql('CAST(c_custkey AS VARCHAR)', 100)} AS chance,
  CASE WHEN {md5_mod_sql('CAST(c_custkey AS VARCHAR)', 100)} < 10 THEN 'validation'
       WHEN {md5_mod_sql('CAST(c_custkey AS VARCHAR)', 100)} < 20 THEN 'testing' ELSE 'training' END AS split
FROM customer""")
def hash_split(spark, d):
    return X.hash_split(views.table(spark, d, "customer").select("c_custkey"), "c_custkey")


@query("ab_assign", f"WITH {ROUTED} SELECT * FROM arms")
def ab_assign(spark, d):
    return _routed(spark, d)


@query("ab_check", f"""WITH {ROUTED}
SELECT recall_arm, rank_arm, COUNT(*) AS n, round(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share
FROM arms GROUP BY 1, 2""")
def ab_check(spark, d):
    return X.ab_check(_routed(spark, d), "recall", "rank").withColumn("share", fround("share", 6))


SESS_SQL = """s AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
                  lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
f AS (SELECT *, CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 30 MINUTE THEN pos END AS st FROM s),
g AS (SELECT *, max(st) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             AS start_pos FROM f),
sess AS (SELECT user_id, start_pos, min(ts) AS start, max(ts) AS last, COUNT(*) AS n_events FROM g GROUP BY 1, 2)"""


def _sessions(spark, d):
    return X.sessions(views.events(spark, d), "user_id", "ts", 30, "event_id")


def _micros(c):
    # without a time zone, so that the session's zone plays no part
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, F.col(c).cast("timestamp_ntz"))


@query("sessions", f"""WITH {SESS_SQL}
SELECT user_id, start_pos, epoch_us(start) AS start_us, epoch_us(last) AS last_us, n_events FROM sess""")
def sessions(spark, d):
    s = _sessions(spark, d)
    return s.select("user_id", "start_pos", _micros("start").alias("start_us"), _micros("last").alias("last_us"),
                    "n_events")


RET_SQL = """act AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
fst AS (SELECT user_id, min(day) AS cohort FROM act GROUP BY 1),
ret AS (SELECT f.user_id, f.cohort, EXISTS (SELECT 1 FROM act a WHERE a.user_id = f.user_id
                                            AND a.day = f.cohort + INTERVAL 7 DAY) AS r FROM fst f)"""


@query("retention_7d", f"""WITH {RET_SQL}
SELECT cohort, COUNT(*) AS n_users, COUNT(*) FILTER (WHERE r) AS retained,
       round(COUNT(*) FILTER (WHERE r) / COUNT(*), 6) AS rate FROM ret GROUP BY 1""")
def retention_7d(spark, d):
    return X.retention(views.events(spark, d), "user_id", "ts", 7).withColumn("rate", fround("rate", 6))


@query("ab_metrics", f"""WITH {SESS_SQL}, {RET_SQL},
ua AS (SELECT DISTINCT user_id, {_arm_sql(_bucket_sql('recall', 'user_id'))} AS arm FROM events),
ev AS (SELECT ua.arm, COUNT(DISTINCT e.user_id) AS n_users, COUNT(*) AS n_events,
              COUNT(*) FILTER (WHERE event_type = 'click') AS clicks,
              COUNT(*) FILTER (WHERE event_type = 'view') AS views,
              COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchases
       FROM events e JOIN ua ON ua.user_id = e.user_id GROUP BY 1),
se AS (SELECT ua.arm, avg(epoch_us(s.last) - epoch_us(s.start)) / 1e6 AS avg_session_sec
       FROM sess s JOIN ua ON ua.user_id = s.user_id GROUP BY 1),
re AS (SELECT ua.arm, avg(CAST(r AS INTEGER)) AS retention_7d FROM ret JOIN ua ON ua.user_id = ret.user_id GROUP BY 1)
SELECT ev.arm, n_users, n_events, round(clicks / views, 6) AS ctr, round(purchases / clicks, 6) AS purchase_per_click,
       round(avg_session_sec, 6) AS avg_session_sec, round(retention_7d, 6) AS retention_7d
FROM ev JOIN se ON se.arm = ev.arm JOIN re ON re.arm = ev.arm""")
def ab_metrics(spark, d):
    ev = views.events(spark, d)
    arms = ev.select("user_id").distinct().withColumn("arm", X.assign_range(X.ab_bucket(F.col("user_id"), "recall")))
    e = ev.join(arms, "user_id").groupBy("arm").agg(
        F.countDistinct("user_id").alias("n_users"),
        F.count(F.lit(1)).alias("n_events"),
        F.count(F.when(F.col("event_type") == "click", 1)).alias("clicks"),
        F.count(F.when(F.col("event_type") == "view", 1)).alias("views"),
        F.count(F.when(F.col("event_type") == "purchase", 1)).alias("purchases"),
    )
    s = _sessions(spark, d).join(arms, "user_id").groupBy("arm").agg(
        (F.avg(_micros("last") - _micros("start")) / 1e6).alias("avg_session_sec")
    )
    act = ev.select("user_id", F.to_date("ts").alias("day")).distinct()
    first = act.groupBy("user_id").agg(F.min("day").alias("cohort"))
    back = first.join(act, "user_id").filter(F.col("day") == F.date_add("cohort", 7)).select("user_id").distinct()
    r = first.join(back.withColumn("_r", F.lit(1)), "user_id", "left").join(arms, "user_id").groupBy("arm").agg(
        F.avg(F.coalesce(F.col("_r"), F.lit(0))).alias("retention_7d")
    )
    out = e.join(s, "arm").join(r, "arm")
    return out.select(
        "arm", "n_users", "n_events",
        fround(F.col("clicks") / F.col("views"), 6).alias("ctr"),
        fround(F.col("purchases") / F.col("clicks"), 6).alias("purchase_per_click"),
        fround("avg_session_sec", 6).alias("avg_session_sec"),
        fround("retention_7d", 6).alias("retention_7d"),
    )


@query("hourly_hot", """WITH c AS (
  SELECT date_trunc('hour', ts) AS w, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, COUNT(*) AS n
  FROM events GROUP BY 1, 2)
SELECT epoch_us(w) AS window_start_us, item_id, n, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY w ORDER BY n DESC, item_id) AS rank FROM c) WHERE rank <= 5""")
def hourly_hot(spark, d):
    ev = views.events(spark, d).select(
        F.window("ts", "1 hour").start.alias("w"), F.get_json_object("props", "$.k").cast("bigint").alias("item_id")
    )
    c = ev.groupBy("w", "item_id").agg(F.count(F.lit(1)).alias("n"))
    top = topn_per(c, "w", [F.col("n").desc(), F.col("item_id")], 5)
    return top.select(_micros("w").alias("window_start_us"), "item_id", "n", "rank")
