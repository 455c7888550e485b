"""SQL twins of the canonical views in `tidemark.plans.views`, as CTE bodies
for the DuckDB oracle strings."""

PLAYS = """plays AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(SUM(l_quantity) AS BIGINT) AS play_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey)"""

HOLD = """hold AS (
  SELECT o_custkey AS user_id, o_orderkey AS orderkey FROM (
    SELECT o_custkey, o_orderkey, row_number() OVER (
      PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1)"""

TRAIN = """train AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(SUM(l_quantity) AS BIGINT) AS play_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE NOT EXISTS (SELECT 1 FROM hold h WHERE h.user_id = o_custkey AND h.orderkey = o_orderkey)
  GROUP BY o_custkey, l_partkey)"""

TRUTH = """truth AS (
  SELECT DISTINCT o_custkey AS user_id, l_partkey AS item_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN hold h ON h.user_id = o_custkey AND h.orderkey = o_orderkey)"""

EVENT_PLAYS = """event_plays AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         COUNT(*) AS n
  FROM events GROUP BY 1, 2)"""

ITEMS = """items AS (
  SELECT p_partkey AS item_id, p_type AS genre, p_brand AS brand, p_name AS name,
         p_size AS size, p_retailprice AS price FROM part)"""


def itemcf_sim(src: str = "plays", n: int = 20, alpha: float = 0.5) -> str:
    """CTE chain w, co, ni, sim ending in `simtop(item_id, similar_id, sim, rank)`."""
    return f"""w AS (SELECT user_id, item_id, ln(1 + play_count) AS w FROM {src}),
co AS (
  SELECT a.item_id AS item_i, b.item_id AS item_j, SUM(a.w * b.w) AS co
  FROM w a JOIN w b ON a.user_id = b.user_id AND a.item_id <> b.item_id
  GROUP BY 1, 2),
ni AS (SELECT item_id, COUNT(*) AS n FROM w GROUP BY 1),
simall AS (
  SELECT item_i AS item_id, item_j AS similar_id,
         co / (pow(x.n, {alpha}) * pow(y.n, {1.0 - alpha}) + 1e-9) AS sim
  FROM co JOIN ni x ON x.item_id = item_i JOIN ni y ON y.item_id = item_j),
simtop AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id
                                 ORDER BY round(sim, 9) DESC, similar_id) AS rank
    FROM simall) WHERE rank <= {n})"""


def itemcf_recs(src: str = "plays", k: int = 10) -> str:
    """CTE `recs(user_id, item_id, score, rank)` after `simtop`."""
    return f"""cand AS (
  SELECT w.user_id, s.similar_id AS item_id, SUM(s.sim * w.w) AS score
  FROM w JOIN simtop s ON s.item_id = w.item_id
  GROUP BY 1, 2),
unseen AS (
  SELECT * FROM cand c WHERE NOT EXISTS (
    SELECT 1 FROM {src} p WHERE p.user_id = c.user_id AND p.item_id = c.item_id)),
recs AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id
                                 ORDER BY round(score, 9) DESC, item_id) AS rank
    FROM unseen) WHERE rank <= {k})"""


def ranking_metrics(recs: str = "recs", truth: str = "truth", ks=(10, 20, 50)) -> str:
    kl = ", ".join(str(k) for k in ks)
    return f"""ks AS (SELECT unnest([{kl}]) AS k),
sizes AS (SELECT user_id, COUNT(*) AS n_truth FROM {truth} GROUP BY 1),
hits AS (
  SELECT r.user_id, r.rank FROM {recs} r
  WHERE EXISTS (SELECT 1 FROM {truth} t WHERE t.user_id = r.user_id AND t.item_id = r.item_id)),
uh AS (
  SELECT h.user_id, ks.k, COUNT(*) AS hits, SUM(1.0 / log2(h.rank + 1)) AS dcg
  FROM hits h JOIN ks ON h.rank <= ks.k GROUP BY 1, 2),
pu AS (
  SELECT s.user_id, ks.k,
         COALESCE(uh.hits, 0) / ks.k AS p,
         COALESCE(uh.hits, 0) / s.n_truth AS r,
         COALESCE(uh.dcg, 0.0) / list_sum(list_transform(range(1, least(s.n_truth, ks.k) + 1),
                                                         lambda x: 1.0 / log2(x + 1))) AS ndcg
  FROM sizes s CROSS JOIN ks LEFT JOIN uh ON uh.user_id = s.user_id AND uh.k = ks.k)"""
