"""Shared DuckDB SQL fragments for the oracle queries (CTEs over the
pre-registered views). They restate the engine's semantics in plain SQL,
independently of the Spark code."""

from quire.operators.ranking import DIRICHLET_GRID, JM_GRID

# The standard analyzer's token pattern (RE2 and Java agree on it).
WORD = r"[\p{L}\p{N}]+"

# postings / statistics of the standard analyzer over `documents`
INDEX_CTES = rf"""
tok AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS term
  FROM documents),
post AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM tok GROUP BY doc_id, term),
dlen AS (
  SELECT doc_id, sum(tf)::BIGINT AS dl FROM post GROUP BY doc_id),
tstat AS (
  SELECT term, count(*)::BIGINT AS df, sum(tf)::BIGINT AS cf FROM post GROUP BY term),
corp AS (
  SELECT (SELECT count(*) FROM documents)::BIGINT AS n_docs,
         count(*)::BIGINT AS n_docs_nonempty,
         sum(dl)::BIGINT AS n_tokens,
         avg(dl::DOUBLE) AS avgdl
  FROM dlen)"""

# analysed queries: whole benchmark passages, lower-cased, standard analyzer
QUERY_CTES = rf"""
qtok AS (
  SELECT item_id AS query_id, unnest(regexp_extract_all(lower(lower(text)), '{WORD}')) AS term
  FROM benchmark),
qt AS (
  SELECT query_id, term, count(*)::BIGINT AS qtf FROM qtok GROUP BY query_id, term)"""

# features of every (query term, posting) pair
FEAT_CTE = r"""
feat AS (
  SELECT qt.query_id, qt.qtf, p.doc_id, p.tf::DOUBLE AS tf, d.dl::DOUBLE AS dl,
         t.df::DOUBLE AS df, t.cf::DOUBLE AS cf,
         c.n_tokens::DOUBLE AS n_tokens, c.n_docs_nonempty::DOUBLE AS n_ne, c.avgdl
  FROM qt JOIN post p ON p.term = qt.term
          JOIN dlen d ON d.doc_id = p.doc_id
          JOIN tstat t ON t.term = qt.term
          CROSS JOIN corp c)"""


def weight_sql(model: str, param: str) -> str:
    """Per-posting weight; ``param`` is a SQL expression (literal or column)."""
    p = "((cf + 1.0) / (n_tokens + 1.0))"
    if model == "jm":
        return (f"CASE WHEN {param} = 0 THEN 1.0 ELSE "
                f"ln(1.0 + ((1.0 - {param}) * tf / dl) / ({param} * {p})) END")
    if model == "dirichlet":
        return (f"CASE WHEN {param} = 0 THEN 0.0 ELSE "
                f"greatest(0.0, ln(1.0 + tf / ({param} * {p})) + ln({param} / (dl + {param}))) END")
    if model == "boolean":
        return "1.0"
    if model == "bm25":
        return ("ln(1.0 + (n_ne - df + 0.5) / (df + 0.5)) * tf / "
                "(tf + 1.2 * (0.25 + 0.75 * dl / avgdl))")
    raise ValueError(model)


def ranked_sql(model: str, param: float, cut: int) -> str:
    """Full SELECT: top ``cut`` (query_id, rk, doc_id, score) of one model."""
    w = weight_sql(model, f"CAST({param!r} AS DOUBLE)")
    return f"""
WITH {INDEX_CTES},
{QUERY_CTES},
{FEAT_CTE},
sc AS (
  SELECT query_id, doc_id, round(sum(qtf * ({w})), 6) AS score
  FROM feat GROUP BY query_id, doc_id),
r AS (
  SELECT query_id, doc_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::BIGINT AS rk
  FROM sc)
SELECT query_id, rk, doc_id, score FROM r WHERE rk <= {cut}"""


# derived judgements: >= share of the passage's distinct terms occur in the document
def qrels_cte(share: float = 0.4) -> str:
    return rf"""
qd AS (
  SELECT DISTINCT query_id, term FROM (
    SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS term
    FROM benchmark)),
nq AS (SELECT query_id, count(*) AS nq FROM qd GROUP BY query_id),
qm AS (
  SELECT qd.query_id, p.doc_id, count(*) AS m
  FROM qd JOIN post p ON p.term = qd.term GROUP BY qd.query_id, p.doc_id),
qrels AS (
  SELECT qm.query_id, qm.doc_id FROM qm JOIN nq USING (query_id)
  WHERE CAST(qm.m AS DOUBLE) >= CAST({share!r} AS DOUBLE) * nq.nq)"""


def run_cte(model: str, param: float, cut: int, name: str = "run") -> str:
    """CTEs ``{name}_sc`` and ``{name}``: the top-``cut`` run of one model
    (needs INDEX_CTES, QUERY_CTES and FEAT_CTE before it)."""
    w = weight_sql(model, f"CAST({param!r} AS DOUBLE)")
    return f"""
{name}_sc AS (
  SELECT query_id, doc_id, round(sum(qtf * ({w})), 6) AS score
  FROM feat GROUP BY query_id, doc_id),
{name} AS (
  SELECT * FROM (
    SELECT query_id, doc_id, score,
           row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::BIGINT AS rk
    FROM {name}_sc) WHERE rk <= {cut})"""


def metrics_ctes(run: str = "run", qrels: str = "qrels", queries: str = "qsel") -> str:
    """CTEs tagged, cum, agg, judged, m: per-query P/AP/recall/RR of ``run``."""
    return f"""
jq AS (SELECT DISTINCT query_id, doc_id FROM {qrels}),
tagged AS (
  SELECT r.query_id, r.rk, r.doc_id, r.score,
         (CASE WHEN j.doc_id IS NULL THEN 0 ELSE 1 END)::BIGINT AS rel
  FROM {run} r LEFT JOIN jq j ON j.query_id = r.query_id AND j.doc_id = r.doc_id),
cum AS (
  SELECT *, sum(rel) OVER (PARTITION BY query_id ORDER BY rk
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_rel
  FROM tagged),
agg AS (
  SELECT query_id, count(*) AS n_hits, sum(rel) AS n_rel_ret,
         sum(CASE WHEN rel = 1 THEN cum_rel::DOUBLE / rk END) AS sum_prec,
         min(CASE WHEN rel = 1 THEN rk END) AS first_rel
  FROM cum GROUP BY query_id),
judged AS (SELECT query_id, count(*) AS n_rel FROM jq GROUP BY query_id),
m AS (
  SELECT j.query_id, coalesce(a.n_hits, 0)::BIGINT AS n_hits,
    CASE WHEN coalesce(a.n_hits, 0) > 0
         THEN round(coalesce(a.n_rel_ret, 0)::DOUBLE / a.n_hits, 9) ELSE 0.0 END AS p,
    CASE WHEN coalesce(a.n_rel_ret, 0) > 0
         THEN round(a.sum_prec / a.n_hits, 9) ELSE 0.0 END AS ap,
    CASE WHEN coalesce(a.n_hits, 0) > 0
         THEN round(coalesce(a.n_rel_ret, 0)::DOUBLE / j.n_rel, 9) ELSE 0.0 END AS recall,
    CASE WHEN coalesce(a.n_rel_ret, 0) > 0
         THEN round(1.0 / a.first_rel, 9) ELSE 0.0 END AS rr
  FROM (SELECT DISTINCT query_id FROM {queries}) s
  JOIN judged j ON j.query_id = s.query_id
  LEFT JOIN agg a ON a.query_id = s.query_id)"""


def eval_sql(select: str, model: str = "jm", param: float = 0.5, cut: int = 10,
             share: float = 0.4) -> str:
    """WITH index, queries, features, run, derived qrels, metrics -> ``select``."""
    return f"""
WITH {INDEX_CTES},
{QUERY_CTES},
{FEAT_CTE},
{run_cte(model, param, cut)},
{qrels_cte(share)},
qsel AS (SELECT item_id AS query_id FROM benchmark),
{metrics_ctes()}
{select}"""


GRID_SQL = {"jm": ", ".join(map(str, JM_GRID)), "dirichlet": ", ".join(str(int(v)) for v in DIRICHLET_GRID)}
METRIC_SQL = {"P": "p", "MAP": "ap", "R": "recall", "MRR": "rr"}


def tuning_ctes(model: str, metric: str, cut: int = 10, prefix: str = "") -> str:
    """CTEs for a whole tuning job over all benchmark queries and all grid
    values: ``{prefix}mv`` (param, query_id, value, split), ``{prefix}best``
    (best_param, best_mean) and ``{prefix}test`` (query_id, value, best_param).
    Needs INDEX_CTES, QUERY_CTES, FEAT_CTE and the qrels CTE before it."""
    x = prefix
    vals = ", ".join(f"(CAST({v} AS DOUBLE))" for v in GRID_SQL[model].split(", "))
    w = weight_sql(model, "g.param")
    col = METRIC_SQL[metric]
    return f"""
{x}grid AS (SELECT * FROM (VALUES {vals}) AS t(param)),
{x}gsc AS (
  SELECT g.param, query_id, doc_id, round(sum(qtf * ({w})), 6) AS score
  FROM feat CROSS JOIN {x}grid g GROUP BY g.param, query_id, doc_id),
{x}grun AS (
  SELECT * FROM (
    SELECT param, query_id, doc_id, score,
           row_number() OVER (PARTITION BY param, query_id ORDER BY score DESC, doc_id)::BIGINT AS rk
    FROM {x}gsc) WHERE rk <= {cut}),
{x}jq AS (SELECT DISTINCT query_id, doc_id FROM qrels),
{x}cum AS (
  SELECT r.param, r.query_id, r.rk,
         (CASE WHEN j.doc_id IS NULL THEN 0 ELSE 1 END) AS rel,
         sum(CASE WHEN j.doc_id IS NULL THEN 0 ELSE 1 END) OVER (
           PARTITION BY r.param, r.query_id ORDER BY r.rk
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_rel
  FROM {x}grun r LEFT JOIN {x}jq j ON j.query_id = r.query_id AND j.doc_id = r.doc_id),
{x}agg AS (
  SELECT param, query_id, count(*) AS n_hits, sum(rel) AS n_rel_ret,
         sum(CASE WHEN rel = 1 THEN cum_rel::DOUBLE / rk END) AS sum_prec,
         min(CASE WHEN rel = 1 THEN rk END) AS first_rel
  FROM {x}cum GROUP BY param, query_id),
{x}judged AS (SELECT query_id, count(*) AS n_rel FROM {x}jq GROUP BY query_id),
{x}rng AS (
  SELECT min(item_id) AS lo, max(item_id) AS hi, (min(item_id) + max(item_id)) // 2 AS mid
  FROM benchmark),
{x}mall AS (
  SELECT g.param, j.query_id,
    CASE WHEN coalesce(a.n_hits, 0) > 0
         THEN round(coalesce(a.n_rel_ret, 0)::DOUBLE / a.n_hits, 9) ELSE 0.0 END AS p,
    CASE WHEN coalesce(a.n_rel_ret, 0) > 0
         THEN round(a.sum_prec / a.n_hits, 9) ELSE 0.0 END AS ap,
    CASE WHEN coalesce(a.n_hits, 0) > 0
         THEN round(coalesce(a.n_rel_ret, 0)::DOUBLE / j.n_rel, 9) ELSE 0.0 END AS recall,
    CASE WHEN coalesce(a.n_rel_ret, 0) > 0
         THEN round(1.0 / a.first_rel, 9) ELSE 0.0 END AS rr
  FROM {x}judged j CROSS JOIN {x}grid g
  LEFT JOIN {x}agg a ON a.query_id = j.query_id AND a.param = g.param),
{x}mv AS (
  SELECT m.param, m.query_id, m.{col} AS value,
         CASE WHEN m.query_id <= r.mid THEN 'train' ELSE 'test' END AS split
  FROM {x}mall m CROSS JOIN {x}rng r),
{x}means AS (
  SELECT param, round(avg(value), 9) AS mean FROM {x}mv WHERE split = 'train' GROUP BY param),
{x}best AS (
  SELECT param AS best_param, mean AS best_mean FROM {x}means
  ORDER BY mean DESC, param ASC LIMIT 1),
{x}test AS (
  SELECT v.query_id, v.value, b.best_param
  FROM {x}mv v JOIN {x}best b ON v.param = b.best_param WHERE v.split = 'test')"""


def tuning_sql(model: str, metric: str, select: str, cut: int = 10) -> str:
    return f"""
WITH {INDEX_CTES},
{QUERY_CTES},
{FEAT_CTE},
{qrels_cte(0.4)},
{tuning_ctes(model, metric, cut)}
{select}"""
