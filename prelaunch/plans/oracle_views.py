"""The fixture views of prelaunch.plans.fixtures as DuckDB SQL.

Oracle queries are written against these CTEs; ``with_views`` prepends the
definitions a query needs. Constants are those of the Spark fixtures.
"""

from __future__ import annotations

from prelaunch.plans.fixtures import MODEL_SEEDS, SUCCESS_THRESHOLD

_LINES = """
lines_agg AS (
  SELECT l.l_orderkey,
         CAST(sum(l.l_quantity) AS BIGINT) AS estimated_owners,
         count(*) AS achievements,
         count(DISTINCT l.l_suppkey) AS dlc_count,
         bool_or(l.l_returnflag = 'A') AS windows,
         bool_or(l.l_returnflag = 'R') AS mac,
         bool_or(l.l_returnflag = 'N') AS linux,
         '[' || string_agg(DISTINCT '''' || p.p_type || '''', ', ' ORDER BY '''' || p.p_type || '''') || ']' AS genres,
         '[' || string_agg(DISTINCT '''' || p.p_brand || '''', ', ' ORDER BY '''' || p.p_brand || '''') || ']' AS categories,
         '[' || string_agg(DISTINCT '''' || sr.r_name || '''', ', ' ORDER BY '''' || sr.r_name || '''') || ']' AS supported_languages
  FROM lineitem l
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN (SELECT s.s_suppkey, r.r_name FROM supplier s
             JOIN nation n ON s.s_nationkey = n.n_nationkey
             JOIN region r ON n.n_regionkey = r.r_regionkey) sr ON l.l_suppkey = sr.s_suppkey
  GROUP BY l.l_orderkey
)"""

_G = f"""
g AS (
  SELECT o.o_orderkey AS game_id,
         CASE WHEN o.o_orderkey % 97 = 0 THEN 'not a date' ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS release_date,
         CASE WHEN o.o_orderkey % 10 = 0 THEN 0.0::DOUBLE WHEN o.o_orderkey % 53 = 0 THEN NULL
              ELSE floor(o.o_totalprice / 100) / 100.0 END AS price,
         la.estimated_owners,
         CAST(la.estimated_owners >= {SUCCESS_THRESHOLD} AS INTEGER) AS success,
         la.achievements, la.dlc_count, la.windows, la.mac, la.linux,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 18 ELSE 0 END AS required_age,
         CASE WHEN o.o_custkey % 41 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS developers,
         la.genres, la.categories, la.supported_languages
  FROM orders o LEFT JOIN lines_agg la ON o.o_orderkey = la.l_orderkey
)"""

_D = """
d AS (
  SELECT doc_id, text AS short_description,
         CASE WHEN doc_id % 3 = 0 THEN text END AS detailed_features, lang, source
  FROM documents
)"""

_DL = """
dl AS (
  SELECT d.*, CAST(lb.quality AS INTEGER) AS success FROM d JOIN labels lb ON d.doc_id = lb.doc_id
)"""


def hash_uniform_sql(key: str, seed: str) -> str:
    return f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '#{seed}'), 1, 8)) AS BIGINT) / 4294967296.0)"


_S = "\ns AS (\n" + "\n  UNION ALL\n".join(
    f"""  SELECT '{name}' AS model, game_id, success AS y,
         round(0.3 * success + 0.7 * {hash_uniform_sql('game_id', seed)}, 3) AS proba,
         CAST(round(0.3 * success + 0.7 * {hash_uniform_sql('game_id', seed)}, 3) >= 0.5 AS INTEGER) AS pred
  FROM g WHERE success IS NOT NULL""" for name, seed in MODEL_SEEDS.items()) + "\n)"

_T = f"""
t AS (
  SELECT 'baseline' AS model, game_id, success AS y,
         (SELECT avg(success) FROM g WHERE success IS NOT NULL) AS proba,
         CAST({hash_uniform_sql('game_id', '42')} < (SELECT avg(success) FROM g WHERE success IS NOT NULL) AS INTEGER) AS pred
  FROM g WHERE success IS NOT NULL
)"""

_GY = """
gy AS (
  SELECT g.*, CAST(year(try_strptime(release_date, '%Y-%m-%d')) AS INTEGER) AS release_year,
         CAST(month(try_strptime(release_date, '%Y-%m-%d')) AS INTEGER) AS release_month,
         CAST(quarter(try_strptime(release_date, '%Y-%m-%d')) AS INTEGER) AS release_quarter
  FROM g
)"""

VIEWS = {"lines_agg": (_LINES, []), "g": (_G, ["lines_agg"]), "gy": (_GY, ["g"]), "d": (_D, []),
         "dl": (_DL, ["d"]), "s": (_S, ["g"]), "t": (_T, ["g"])}


def with_views(body: str, *names: str, extra: list[str] | None = None) -> str:
    """``WITH <needed views>[, extra CTEs] <body>`` with dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        for dep in VIEWS[n][1]:
            visit(dep)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    ctes = [VIEWS[n][0].strip() for n in order] + [e.strip() for e in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
