"""URL filters by a temporal list join.

Dated list entries (an addition or a removal of a key) become validity intervals; every capture is held against the
entries that were active when it was fetched.  A capture's keys are its host's domain suffixes, its path prefixes and
its address, so the join is on (kind, key) with the day inside the interval: an as-of join of each key's history.

Cases: a null or malformed URL has no host and matches nothing; a null day is active in no interval; entries with a
null field are ignored; several changes of a key on one day count in the order additions, removals; changes that
change nothing are ignored; repeated captures are all answered; empty tables give no rows or no matches; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import read

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)"
DAY = "2024-01-01"


def host_of(url: Column) -> Column:
    """The host without user, port and final dots."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1), "^.*@", ""), r"[.]*(?::[0-9]*)?$", ""))


def address_of(url: Column) -> Column:
    """The URL up to its fragment."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), "#.*$", "")


def prefixes_of(url: Column) -> Column:
    """host/a, host/a/b, ... of the non-empty path segments."""
    parts = F.filter(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), "/"), lambda x: x != "")
    return F.transform(F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts))).otherwise(F.array().cast("array<int>")),
                       lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))


def suffixes_of(host: Column) -> Column:
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """list, kind, key, since, until (exclusive; null while it holds) of entries (list, kind, key, action, day)."""
    by = Window.partitionBy("list", "kind", "key").orderBy("day", "action")
    known = entries.dropna(subset=["list", "kind", "key", "action", "day"]).select("list", "kind", "key", "action", "day")
    changes = known.withColumn("_was", F.lag("action").over(by)).filter((F.col("action") != F.coalesce("_was", F.lit("remove"))))
    spans = changes.withColumn("until", F.lead("day").over(by)).filter(F.col("action") == "add")
    return spans.select("list", "kind", "key", F.col("day").alias("since"), "until").filter(F.col("until").isNull() | (F.col("since") < F.col("until")))


def evaluated(captures: DataFrame, valid: DataFrame) -> DataFrame:
    """The captures (url, day and others) with n_active, lists (sorted names, comma-joined) and blocked.

    Distinct (url, day) are evaluated once; a hot host's captures spread over their days and addresses and, where the
    join is still uneven, over the tasks that adaptive execution splits it into.
    """
    once = captures.select(captures["url"].alias("_url"), captures["day"].alias("_day")).filter(F.col("_url").isNotNull() & F.col("_day").isNotNull()).distinct()
    host = host_of(F.col("_url"))
    keys = F.concat(
        F.transform(suffixes_of(host), lambda k: F.struct(F.lit("domain").alias("kind"), k.alias("key"))),
        F.transform(prefixes_of(F.col("_url")), lambda k: F.struct(F.lit("prefix").alias("kind"), k.alias("key"))),
        F.array(F.struct(F.lit("url").alias("kind"), address_of(F.col("_url")).alias("key"))))
    asked = once.filter(host != "").select("_url", "_day", F.explode(keys).alias("k")).select("_url", "_day", "k.kind", "k.key")
    hits = asked.join(valid, ["kind", "key"]).filter((F.col("since") <= F.col("_day")) & (F.col("until").isNull() | (F.col("_day") < F.col("until"))))
    told = hits.groupBy("_url", "_day").agg(F.count(F.lit(1)).alias("n_active"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"))
    out = captures.join(told, (captures["url"] == told["_url"]) & (captures["day"] == told["_day"]), "left").drop("_url", "_day")
    return out.withColumns({"n_active": F.coalesce("n_active", F.lit(0)), "lists": F.coalesce("lists", F.lit("")), "blocked": F.col("n_active").isNotNull()})


def _number(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 6), 16, 10).cast("bigint")


def captures_of(pages: DataFrame) -> DataFrame:
    """page_id, url, day: the pages table names no fetch time, so a page's id sets its day of the year."""
    day = F.date_add(F.lit(DAY).cast("date"), F.pmod(F.col("page_id"), F.lit(365)).cast("int"))
    return pages.select("page_id", "url", day.alias("day"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated entries made of the pages' own hosts, domains, path prefixes and addresses."""
    urls = pages.select("url").filter(host_of(F.col("url")) != "")
    host = host_of(F.col("url"))
    day = lambda n: F.date_add(F.lit(DAY).cast("date"), n.cast("int"))

    def made(kind, name, key, steps, some):
        k = urls.select(F.explode(key).alias("key")).distinct().withColumn("n", _number(F.col("key"))).filter(some(F.col("n")))
        each = F.array(*[F.struct(F.lit(a).alias("action"), day(d(F.col("n"))).alias("day")) for a, d in steps])
        return k.select(F.lit(name).alias("list"), F.lit(kind).alias("kind"), "key", F.explode(each).alias("e")).select("list", "kind", "key", "e.action", "e.day")

    on = made("domain", "hosts", F.array(host), [("add", lambda n: n % 150), ("remove", lambda n: n % 150 + 30 + n % 90), ("add", lambda n: 280 + n % 40)], lambda n: n % 4 == 0)
    short = F.substring_index(host, ".", -2)
    on = on.unionByName(made("domain", "domains", F.array(short), [("add", lambda n: n % 300), ("add", lambda n: n % 300 + 2), ("remove", lambda n: n % 300 + 5)], lambda n: n % 1 == 0))
    on = on.unionByName(made("prefix", "paths", prefixes_of(F.col("url")), [("add", lambda n: n % 300), ("remove", lambda n: n % 300 + 40)], lambda n: n % 5 == 0))
    return on.unionByName(made("url", "urls", F.array(address_of(F.col("url"))), [("add", lambda n: n % 365)], lambda n: n % 20 == 0))


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    """page_id, url, day, n_active, lists, blocked."""
    pages = read(spark, sf_dir, "pages")
    return evaluated(captures_of(pages), intervals(entries_of(pages)))


OP7_SQL = r"""
WITH u AS (
  SELECT url, lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1), '^.*@', ''), '[.]*(?::[0-9]*)?$', '')) AS host,
    regexp_replace(url, '#.*$', '') AS address,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)', 1), '/'), lambda x: x <> '') AS parts
  FROM (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL)),
w AS (
  SELECT *, string_split(host, '.') AS labels FROM u WHERE host <> ''),
keys AS (
  SELECT url, 'domain' AS kind, unnest(list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))) AS key FROM w
  UNION ALL SELECT url, 'prefix', unnest(list_transform(range(1, len(parts) + 1), lambda i: host || '/' || array_to_string(parts[:i], '/'))) FROM w
  UNION ALL SELECT url, 'url', address FROM w),
seeds AS (
  SELECT *, CAST('0x' || substr(md5(key), 1, 6) AS BIGINT) AS n FROM (
    SELECT DISTINCT 'hosts' AS list, 'domain' AS kind, host AS key FROM w
    UNION ALL SELECT DISTINCT 'domains', 'domain', array_to_string(labels[-2:], '.') FROM w
    UNION ALL SELECT DISTINCT 'paths', 'prefix', key FROM keys WHERE kind = 'prefix'
    UNION ALL SELECT DISTINCT 'urls', 'url', address FROM w)),
entries AS (
  SELECT list, kind, key, 'add' AS action, n % 150 AS d FROM seeds WHERE list = 'hosts' AND n % 4 = 0
  UNION ALL SELECT list, kind, key, 'remove', n % 150 + 30 + n % 90 FROM seeds WHERE list = 'hosts' AND n % 4 = 0
  UNION ALL SELECT list, kind, key, 'add', 280 + n % 40 FROM seeds WHERE list = 'hosts' AND n % 4 = 0
  UNION ALL SELECT list, kind, key, 'add', n % 300 FROM seeds WHERE list = 'domains'
  UNION ALL SELECT list, kind, key, 'add', n % 300 + 2 FROM seeds WHERE list = 'domains'
  UNION ALL SELECT list, kind, key, 'remove', n % 300 + 5 FROM seeds WHERE list = 'domains'
  UNION ALL SELECT list, kind, key, 'add', n % 300 FROM seeds WHERE list = 'paths' AND n % 5 = 0
  UNION ALL SELECT list, kind, key, 'remove', n % 300 + 40 FROM seeds WHERE list = 'paths' AND n % 5 = 0
  UNION ALL SELECT list, kind, key, 'add', n % 365 FROM seeds WHERE list = 'urls' AND n % 20 = 0),
changes AS (
  SELECT *, lag(action) OVER (PARTITION BY list, kind, key ORDER BY d, action) AS was FROM entries),
spans AS (
  SELECT list, kind, key, action, d AS since, lead(d) OVER (PARTITION BY list, kind, key ORDER BY d, action) AS until
  FROM changes WHERE action <> coalesce(was, 'remove')),
captures AS (
  SELECT page_id, url, CAST(page_id % 365 AS BIGINT) AS d FROM pages),
hits AS (
  SELECT c.url, c.d, count(*) AS n, array_to_string(list_sort(list_distinct(list(s.list))), ',') AS lists
  FROM (SELECT DISTINCT url, d FROM captures) c JOIN keys k ON k.url = c.url
  JOIN spans s ON s.kind = k.kind AND s.key = k.key AND s.action = 'add' AND s.since <= c.d AND (s.until IS NULL OR c.d < s.until)
  GROUP BY 1, 2)
SELECT c.page_id, c.url, CAST(DATE '2024-01-01' + CAST(c.d AS INTEGER) AS DATE) AS day, coalesce(h.n, 0) AS n_active,
  coalesce(h.lists, '') AS lists, h.n IS NOT NULL AS blocked
FROM captures c LEFT JOIN hits h ON h.url = c.url AND h.d = c.d
"""
