"""SQL for another engine that states each registered query a second time, over the raw tables."""

from __future__ import annotations

from subvent.plans import queries as q
from subvent.sources.fixtures import KNOTS

# fixed values: the five priorities, in order
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SUMS = ("n", "high", "sz", "sw", "sy", "szy", "szw")

IV_PANEL = """iv_raw AS MATERIALIZED (
  SELECT o_orderkey AS unit_id, c_mktsegment AS segment, c_acctbal AS acctbal, o_totalprice AS price,
    o_orderpriority AS priority, CAST(o_custkey AS VARCHAR) AS customer,
    ((o_orderkey * 7919) % 1009) / 1009e0 AS u1, ((o_orderkey * 104729) % 997) / 997e0 AS u2,
    ((o_orderkey * 1299709) % 991) / 991e0 AS u3,
    CASE WHEN c_acctbal >= 4500 THEN 30e0 ELSE 10e0 END AS tau
  FROM orders JOIN customer ON o_custkey = c_custkey),
iv_issued AS (
  SELECT *, CAST(u1 < 0.5e0 AS INTEGER) AS z,
    CAST((CASE WHEN u1 < 0.5e0 THEN u2 > 0.3e0 ELSE u2 > 0.8e0 END) AS INTEGER) AS w FROM iv_raw),
iv_panel AS MATERIALIZED (
  SELECT *, 100e0 + tau * w + 60e0 * u2 + 10e0 * (u3 - 0.5e0) AS y FROM iv_issued)"""

DOSE_PANEL = """dose_raw AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_returnflag AS segment, l_discount AS dose,
    CASE l_returnflag WHEN 'A' THEN 20e0 + 100e0 * l_discount + 4000e0 * l_discount * l_discount
      WHEN 'N' THEN 20e0 + 2000e0 * l_discount * l_discount WHEN 'R' THEN 20e0 + 300e0 * l_discount END AS truth
  FROM lineitem),
dose_panel AS MATERIALIZED (
  SELECT *, truth + 20e0 * (((order_key * 7919 + line_no * 104729) % 1009) / 1009e0 - 0.5e0) AS y FROM dose_raw)"""


def r(expr: str, digits: int = 4) -> str:
    # adding zero turns a negative zero into zero
    return f"round({expr}, {digits}) + 0e0"


def relu(x: str, power: int = 2) -> str:
    return f"pow(greatest({x}, 0e0), {power})"


# ---------------------------------------------------------------- effects per group


# a row of the panel for each row that a weight of 1 + unit_id % 3 stands for
REPEATED = "JOIN (SELECT unnest([1, 2, 2, 3, 3, 3]) AS times) ON times = 1 + unit_id % 3"


def iv_effect(by: list[str], extra: str = "", where: str = "TRUE", repeat: str = "") -> str:
    """``where`` tells complete rows from those that are left out; ``repeat`` is a join that repeats rows."""
    keys = ", ".join(by)
    group = f"GROUP BY {keys}" if by else ""
    comma = f"{keys}, " if by else ""
    match = " AND ".join(f"g.{k} IS NOT DISTINCT FROM p.{k}" for k in by) or "TRUE"
    return f"""WITH {IV_PANEL},
every AS (SELECT *{extra}, {where} AS complete FROM iv_panel),
p AS (SELECT every.* FROM every {repeat} WHERE complete),
left_out AS (SELECT {comma}count(*) FILTER (NOT complete) AS n_dropped FROM every {group}),
g AS (SELECT {comma}count(*) AS n, avg(z) AS mz, avg(w) AS mw, avg(y) AS my,
    covar_samp(y, z) AS cyz, covar_samp(w, z) AS cwz, covar_samp(y, w) AS cyw, var_samp(z) AS vz, var_samp(w) AS vw
  FROM p {group}),
e AS (SELECT {", ".join("g." + k for k in by) + ", " if by else ""}
    sum(pow((z - mz) * ((y - my) - cyz / cwz * (w - mw)), 2)) AS s2
  FROM p JOIN g ON {match} {"GROUP BY " + ", ".join("g." + k for k in by) if by else ""}),
f AS (SELECT g.*, s2, cwz * cwz / (vw * vz) AS r2 FROM g JOIN e ON {" AND ".join(f"g.{k} IS NOT DISTINCT FROM e.{k}" for k in by) or "TRUE"}),
o AS (SELECT *, CASE WHEN r2 < 1 - 1e-12 THEN r2 * (n - 2) / (1 - r2) END AS f_stat FROM f)
SELECT {", ".join("o." + k for k in by) + ", " if by else ""}n, n_dropped, {r("cyw / vw")} AS naive, {r("cyz / vz")} AS itt,
  {r("cwz / vz")} AS first_stage, {r("cyz / cwz")} AS effect, {r("sqrt(s2) / (abs(cwz) * (n - 1))")} AS std_error,
  {r("f_stat")} AS f_stat, CASE WHEN f_stat < 10 THEN 'weak' ELSE 'ok' END AS status
FROM o JOIN left_out l ON {" AND ".join(f"o.{k} IS NOT DISTINCT FROM l.{k}" for k in by) or "TRUE"}"""


# one row of moments and of scores per group; a group too small or without a first stage has no effect
IV_EFFECT_MANY = f"""WITH {IV_PANEL},
p AS (SELECT *, CAST(floor(unit_id / {q.GROUP_UNITS}e0) AS BIGINT) AS batch FROM iv_panel),
m AS (SELECT batch, count(*) AS n, avg(z) AS mz, avg(w) AS mw, avg(y) AS my,
    covar_samp(y, z) AS cyz, covar_samp(w, z) AS cwz, covar_samp(y, w) AS cyw, var_samp(z) AS vz, var_samp(w) AS vw
  FROM p GROUP BY batch),
g AS (SELECT *, CASE WHEN n >= 3 AND vz > 0 AND abs(cwz) > 1e-12 * sqrt(vw * vz) THEN cyz / cwz END AS effect FROM m),
e AS (SELECT g.batch, sum(pow((z - mz) * ((y - my) - effect * (w - mw)), 2)) AS s2 FROM p JOIN g ON g.batch = p.batch GROUP BY g.batch),
f AS (SELECT g.*, s2, cwz * cwz / nullif(vw * vz, 0) AS r2 FROM g JOIN e ON g.batch = e.batch),
o AS (SELECT *, CASE WHEN n >= 3 AND r2 < 1 - 1e-12 THEN r2 * (n - 2) / (1 - r2) END AS f_stat FROM f)
SELECT batch, n, CAST(0 AS BIGINT) AS n_dropped, {r("cyw / nullif(vw, 0)")} AS naive, {r("cyz / nullif(vz, 0)")} AS itt,
  {r("cwz / nullif(vz, 0)")} AS first_stage, {r("effect")} AS effect,
  {r("sqrt(s2) / nullif(abs(cwz) * (n - 1), 0)")} AS std_error, {r("f_stat")} AS f_stat,
  CASE WHEN n < 3 THEN 'too_few' WHEN vz = 0 THEN 'no_instrument_variation' WHEN abs(cwz) <= 1e-12 * sqrt(vw * vz) THEN 'no_first_stage'
    WHEN f_stat < 10 * (1 - 1e-9) THEN 'weak' ELSE 'ok' END AS status FROM o"""

EXPERIMENT_PANEL = f"""WITH a AS (
  SELECT DISTINCT user_id AS unit_id, CAST(user_id % 2 AS INTEGER) AS z,
    TIMESTAMP '2024-01-08' + to_days(CAST(user_id % 7 AS INTEGER)) AS ts FROM events),
i AS (SELECT a.unit_id, sum(e.value) AS amount FROM a JOIN events e ON e.user_id = a.unit_id
  AND e.event_type = 'signup' AND e.ts >= a.ts AND e.ts < a.ts + INTERVAL 2 DAY GROUP BY a.unit_id),
o AS (SELECT a.unit_id, sum(e.value) AS y FROM a JOIN events e ON e.user_id = a.unit_id
  AND e.event_type = 'purchase' AND e.ts >= a.ts AND e.ts < a.ts + INTERVAL 2 DAY GROUP BY a.unit_id)
SELECT a.unit_id, a.ts, a.z, CAST(i.unit_id IS NOT NULL AS INTEGER) AS w,
  {r("coalesce(i.amount, 0)")} AS amount, {r("coalesce(o.y, 0)")} AS y
FROM a LEFT JOIN i ON i.unit_id = a.unit_id LEFT JOIN o ON o.unit_id = a.unit_id"""

EXPERIMENT_PANEL_DATES = f"""WITH a AS (
  SELECT DISTINCT user_id AS unit_id, CAST(user_id % 2 AS INTEGER) AS z,
    CAST(TIMESTAMP '2024-01-08' + to_days(CAST(user_id % 7 AS INTEGER)) AS DATE) AS ts FROM events),
d AS (SELECT user_id, event_type, value, CAST(ts AS DATE) AS ts FROM events),
i AS (SELECT a.unit_id, sum(e.value) AS amount FROM a JOIN d e ON e.user_id = a.unit_id
  AND e.event_type = 'signup' AND e.ts >= a.ts AND e.ts < a.ts + INTERVAL 36 HOUR GROUP BY a.unit_id),
o AS (SELECT a.unit_id, sum(e.value) AS y FROM a JOIN d e ON e.user_id = a.unit_id
  AND e.event_type = 'purchase' AND e.ts >= a.ts AND e.ts < a.ts + INTERVAL 36 HOUR GROUP BY a.unit_id)
SELECT a.unit_id, CAST(a.ts AS TIMESTAMP) AS ts, a.z, CAST(i.unit_id IS NOT NULL AS INTEGER) AS w,
  {r("coalesce(i.amount, 0)")} AS amount, {r("coalesce(o.y, 0)")} AS y
FROM a LEFT JOIN i ON i.unit_id = a.unit_id LEFT JOIN o ON o.unit_id = a.unit_id"""

RESIDUALS = """folded AS (SELECT *, CAST(unit_id % 5 AS INTEGER) AS fold FROM iv_panel),
cells AS (SELECT segment, priority, fold, count(*) AS n, sum(z) AS z, sum(w) AS w, sum(y) AS y FROM folded GROUP BY ALL),
others AS (SELECT own.segment, own.priority, own.fold, sum(o.z) / sum(o.n) AS z, sum(o.w) / sum(o.n) AS w, sum(o.y) / sum(o.n) AS y
  FROM cells own JOIN cells o ON own.segment = o.segment AND own.priority = o.priority AND own.fold <> o.fold GROUP BY ALL),
residuals AS MATERIALIZED (SELECT f.*, f.z - o.z AS z_res, f.w - o.w AS w_res, f.y - o.y AS y_res
  FROM folded f LEFT JOIN others o ON f.segment = o.segment AND f.priority = o.priority AND f.fold = o.fold)"""

CROSS_FIT = f"""WITH {IV_PANEL},
{RESIDUALS}
SELECT unit_id, fold, {r("z_res")} AS z_res, {r("w_res")} AS w_res, {r("y_res")} AS y_res FROM residuals"""


# ---------------------------------------------------------------- forests


def draw(unit: str, tree: str) -> str:
    h1 = f"(({unit} * 40503 + {tree} * 30011) % 65537)"
    h2 = f"(({h1} * {h1} + {unit} * 7 + {tree} * 13) % 65537)"
    return f"(({h2} * {h2} + {h2} * 31 + {tree}) % 65537)"


def edge_count(column: str, edges: list[float]) -> str:
    return "1 + " + " + ".join(f"CAST({column} >= {e}e0 AS INTEGER)" for e in edges)


def bin_list() -> list[str]:
    bins = [edge_count("acctbal", q.ACCTBAL_EDGES), edge_count("price", q.PRICE_EDGES)]
    bins += [f"CASE WHEN priority = '{p}' THEN 2 ELSE 1 END" for p in PRIORITIES]
    return [f"CAST({b} AS INTEGER)" for b in bins]


def best_split(name: str, rows: str, min_leaf: int, features: int | None = None) -> str:
    """CTEs ending in ``name``: the winning split per (tree, node) of ``rows``."""
    features = features or len(bin_list())
    half = f"{min_leaf / 2}e0"
    total = ", ".join(f"sum({c}) OVER n AS t_{c}" for c in SUMS)
    left = ", ".join(f"sum({c}) OVER u AS l_{c}" for c in SUMS)
    return f"""{name}_h AS (SELECT tree, node, feature, bins[feature + 1] AS bin, count(*) AS n, sum(high) AS high,
    sum(z) AS sz, sum(w) AS sw, sum(y) AS sy, sum(z * y) AS szy, sum(z * w) AS szw
  FROM {rows}, (SELECT unnest(range({features})) AS feature) GROUP BY ALL),
{name}_w AS (SELECT tree, node, feature, bin, {left}, {total} FROM {name}_h
  WINDOW n AS (PARTITION BY tree, node, feature),
    u AS (PARTITION BY tree, node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name}_t AS (SELECT *, (t_szy - t_sz * t_sy / t_n) / nullif(t_szw - t_sz * t_sw / t_n, 0) AS tau FROM {name}_w
  WHERE l_n >= {min_leaf} AND t_n - l_n >= {min_leaf} AND l_high >= {half} AND l_n - l_high >= {half}
    AND t_high - l_high >= {half} AND (t_n - l_n) - (t_high - l_high) >= {half}),
{name}_g AS (SELECT *, pow((l_szy - t_sz / t_n * l_sy - t_sy / t_n * l_sz + l_n * (t_sz / t_n) * (t_sy / t_n))
    - tau * (l_szw - t_sz / t_n * l_sw - t_sw / t_n * l_sz + l_n * (t_sz / t_n) * (t_sw / t_n)), 2)
    * (1e0 / l_n + 1e0 / (t_n - l_n)) AS gain FROM {name}_t),
{name} AS MATERIALIZED (SELECT tree, node, CAST(feature AS INTEGER) AS feature, bin, gain, t_n AS n, l_n AS n_left
  FROM {name}_g WHERE gain IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY CAST(gain AS FLOAT) DESC, feature, bin) = 1)"""


IV_SPLIT = f"""WITH {IV_PANEL},
rows1 AS (SELECT CAST(1 AS INTEGER) AS tree, unnest([1, CASE WHEN segment < 'F' THEN 2 WHEN segment < 'I' THEN 3 ELSE 4 END]) AS node,
    [{", ".join(bin_list())}] AS bins, z, w, y FROM iv_panel),
means AS (SELECT tree, node, avg(z) AS mz, avg(w) AS mw, avg(y) AS my FROM rows1 GROUP BY ALL),
ready AS MATERIALIZED (SELECT r.tree, CAST(r.node AS BIGINT) AS node, bins, CAST(z > mz AS INTEGER) AS high,
    z - mz AS z, w - mw AS w, y - my AS y
  FROM rows1 r JOIN means m ON r.tree = m.tree AND r.node = m.node),
{best_split("best", "ready", q.SPLIT_MIN_LEAF)}
SELECT tree, node, feature, bin, {r("gain", 2)} AS gain, CAST(n AS BIGINT) AS n, CAST(n_left AS BIGINT) AS n_left FROM best"""


def residual_trees() -> str:
    """Residuals from trees per fold, grown on the rows of the other folds that a tree drew; leaf means are sums of the drawn rows."""
    targets = ("z", "w", "y")
    sums = ", ".join(f"sum(s{c}) OVER n AS t_{c}, sum(s{c}) OVER u AS l_{c}" for c in targets)
    fall = " + ".join(
        f"(l_{c} * l_{c} / l_n + (t_{c} - l_{c}) * (t_{c} - l_{c}) / (t_n - l_n) - t_{c} * t_{c} / t_n) / v{c}" for c in targets
    )
    parts = [
        f"""WITH {IV_PANEL},
mean AS (SELECT {", ".join(f"avg({c}) AS m{c}, var_pop({c}) AS v{c}" for c in targets)} FROM iv_panel),
rows_ AS MATERIALIZED (SELECT unit_id AS unit, CAST(unit_id % {q.RESIDUAL_FOLDS} AS INTEGER) AS fold, [{", ".join(bin_list())}] AS bins,
    {", ".join(f"{c} - m{c} AS {c}" for c in targets)} FROM iv_panel, mean),
trees AS (SELECT unnest(range(1, {q.RESIDUAL_TREES + 1})) AS tree),
folds AS (SELECT CAST(unnest(range({q.RESIDUAL_FOLDS})) AS INTEGER) AS own),
node0 AS MATERIALIZED (SELECT own, tree, bins, z, w, y, 1 AS node FROM rows_, trees, folds
  WHERE fold <> own AND {draw("unit", "tree")} < 32768)"""
    ]
    for level in range(q.RESIDUAL_DEPTH):
        parts.append(
            f"""hist{level} AS (SELECT own, tree, node, feature, bins[feature + 1] AS bin, count(*) AS n, {", ".join(f"sum({c}) AS s{c}" for c in targets)}
  FROM node{level}, (SELECT unnest(range({len(bin_list())})) AS feature) GROUP BY ALL),
side{level} AS (SELECT own, tree, node, feature, bin, sum(n) OVER n AS t_n, sum(n) OVER u AS l_n, {sums} FROM hist{level}
  WINDOW n AS (PARTITION BY own, tree, node, feature),
    u AS (PARTITION BY own, tree, node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
best{level} AS MATERIALIZED (SELECT own, tree, node, feature, bin FROM (SELECT *, {fall} AS gain FROM side{level}, mean
    WHERE l_n >= {q.MIN_LEAF} AND t_n - l_n >= {q.MIN_LEAF}) WHERE gain > 1e-9 * t_n
  QUALIFY row_number() OVER (PARTITION BY own, tree, node ORDER BY CAST(gain AS FLOAT) DESC, feature, bin) = 1),
node{level + 1} AS MATERIALIZED (SELECT d.* EXCLUDE (node),
    CASE WHEN b.node IS NULL THEN d.node ELSE 2 * d.node + CAST(d.bins[b.feature + 1] > b.bin AS INTEGER) END AS node
  FROM node{level} d LEFT JOIN best{level} b ON d.own = b.own AND d.tree = b.tree AND d.node = b.node),
at{level} AS MATERIALIZED (SELECT r.* EXCLUDE (node),
    CASE WHEN b.node IS NULL THEN r.node ELSE 2 * r.node + CAST(r.bins[b.feature + 1] > b.bin AS INTEGER) END AS node
  FROM {"(SELECT rows_.*, tree, 1 AS node FROM rows_, trees)" if level == 0 else f"at{level - 1}"} r
  LEFT JOIN best{level} b ON r.fold = b.own AND r.tree = b.tree AND r.node = b.node)"""
        )
    last = q.RESIDUAL_DEPTH
    parts.append(f"leaf AS (SELECT own, tree, node, {', '.join(f'avg({c}) AS g{c}' for c in targets)} FROM node{last} GROUP BY ALL)")
    outputs = ", ".join(f"{r(f'any_value(a.{c}) - avg(g{c})')} AS {c}_res" for c in targets)
    return ",\n".join(parts) + f"""
SELECT unit AS unit_id, fold, {outputs} FROM at{last - 1} a JOIN leaf l ON a.fold = l.own AND a.tree = l.tree AND a.node = l.node
GROUP BY unit, fold"""


def forest(w: str = "w", bag_size: int = 1, fraction: float = 0.5, residual: bool = False, repeat: str = "") -> str:
    """CTEs ``binned``, ``drawn``, ``splits`` and ``leaves`` of the registered forest."""
    z, y, source = "z", "y", "iv_panel"
    if residual:
        z, w, y, source = "z_res", "w_res", "y_res", "residuals"
    limit = int(fraction * 65536)
    sample = f"{draw('unit', 'tree')} < {limit}"
    if bag_size > 1:
        bag = f"((tree - 1) // {bag_size} + {q.TREES} + 1)"
        sample = f"{draw('unit', bag)} < 32768 AND {draw('unit', 'tree')} < {2 * limit}"
    parts = [
        f"""WITH {IV_PANEL},
{RESIDUALS},
mean AS (SELECT avg({z}) AS mz, avg({w}) AS mw, avg({y}) AS my, avg(z) AS raw FROM {source}),
binned AS MATERIALIZED (SELECT unit_id AS unit, [{", ".join(bin_list())}] AS bins, {z} - mz AS z, {w} - mw AS w, {y} - my AS y,
    CAST(z > raw AS INTEGER) AS high FROM {source} {repeat}, mean),
trees AS (SELECT unnest(range(1, {q.TREES + 1})) AS tree),
drawn AS MATERIALIZED (SELECT CAST(tree AS INTEGER) AS tree, unit, bins, z, w, y, high, {draw("unit", "tree")} % 2 = 0 AS half
  FROM binned, trees WHERE {sample}),
split0 AS MATERIALIZED (SELECT *, CAST(1 AS BIGINT) AS node FROM drawn WHERE half)""",
        best_split("best0", "split0", q.MIN_LEAF),
    ]
    return ",\n".join([*parts, *grown()])


def grown(features: int | None = None) -> list[str]:
    """CTEs ``splits`` and ``leaves`` from the CTEs ``drawn`` and ``best0``."""
    parts = []
    for level in range(1, q.DEPTH):
        parts.append(
            f"""split{level} AS MATERIALIZED (SELECT s.* EXCLUDE (node),
    2 * s.node + CAST(s.bins[b.feature + 1] > b.bin AS BIGINT) AS node
  FROM split{level - 1} s JOIN best{level - 1} b ON s.tree = b.tree AND s.node = b.node)"""
        )
        parts.append(best_split(f"best{level}", f"split{level}", q.MIN_LEAF, features))
    union = " UNION ALL ".join(f"SELECT * FROM best{level}" for level in range(q.DEPTH))
    parts.append(f"splits AS MATERIALIZED ({union})")
    parts.append(walk("leafrow", "SELECT * FROM drawn WHERE NOT half"))
    parts.append(
        """leaves AS MATERIALIZED (SELECT tree, node, count(*) AS n, avg(z) AS mz, avg(w) AS mw, avg(y) AS my,
    avg(z * y) AS mzy, avg(z * w) AS mzw FROM leafrow GROUP BY ALL)"""
    )
    return parts


def forest_ordered() -> str:
    """CTEs of a forest on price and customer, whose values each tree puts in the order of their effects on its split half.

    ``every`` has the bins of all units in all trees.
    """
    n = q.ORDERED_BINS
    price = f"CAST({edge_count('price', q.PRICE_EDGES)} AS INTEGER)"
    return f"""WITH {IV_PANEL},
mean AS (SELECT avg(z) AS mz, avg(w) AS mw, avg(y) AS my FROM iv_panel),
trees AS (SELECT CAST(unnest(range(1, {q.TREES + 1})) AS INTEGER) AS tree),
base AS MATERIALIZED (SELECT tree, unit_id AS unit, {price} AS price_bin, customer, z - mz AS z, w - mw AS w, y - my AS y,
    CAST(z > mz AS INTEGER) AS high, {draw("unit_id", "tree")} AS draw FROM iv_panel, mean, trees),
value_sums AS (SELECT tree, customer, count(*) AS n, sum(z) AS sz, sum(w) AS sw, sum(y) AS sy, sum(z * y) AS szy, sum(z * w) AS szw
  FROM base WHERE draw < 32768 AND draw % 2 = 0 GROUP BY ALL),
whole AS (SELECT tree, sum(n) AS t_n, sum(sz) / sum(n) AS mz, sum(sw) / sum(n) AS mw, sum(sy) / sum(n) AS my,
    (sum(szy) - sum(sz) * sum(sy) / sum(n)) / (sum(szw) - sum(sz) * sum(sw) / sum(n)) AS tau FROM value_sums GROUP BY tree),
judged AS MATERIALIZED (SELECT v.tree, customer, n, t_n,
    (szy - mz * sy - my * sz + n * mz * my - tau * (szw - mz * sw - mw * sz + n * mz * mw)) / n AS effect
  FROM value_sums v JOIN whole USING (tree)),
placed AS (SELECT *, sum(n) OVER (PARTITION BY tree ORDER BY effect, customer ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until FROM judged),
value_bins AS MATERIALIZED (SELECT tree, customer, CAST(1 + ({n} * (2 * until - n)) // t_n AS INTEGER) AS bin FROM placed),
unseen AS (SELECT tree, CAST(1 + ({n} * 2 * coalesce(sum(n) FILTER (effect <= 0), 0)) // max(t_n) AS INTEGER) AS bin FROM judged GROUP BY tree),
every AS MATERIALIZED (SELECT b.* EXCLUDE (price_bin, customer), [price_bin, coalesce(v.bin, u.bin)] AS bins
  FROM base b LEFT JOIN value_bins v ON b.tree = v.tree AND b.customer = v.customer JOIN unseen u ON b.tree = u.tree),
drawn AS MATERIALIZED (SELECT *, draw % 2 = 0 AS half FROM every WHERE draw < 32768),
split0 AS MATERIALIZED (SELECT *, CAST(1 AS BIGINT) AS node FROM drawn WHERE half),
{best_split("best0", "split0", q.MIN_LEAF, 2)},
""" + ",\n".join(grown(2))


def walk(name: str, rows: str) -> str:
    """CTEs ending in ``name``: the rows with the node they end in."""
    parts = [f"{name}0 AS (SELECT *, CAST(1 AS BIGINT) AS node FROM ({rows}))"]
    for level in range(q.DEPTH):
        last = name if level == q.DEPTH - 1 else f"{name}{level + 1}"
        parts.append(
            f"""{last} AS MATERIALIZED (SELECT s.* EXCLUDE (node), CASE WHEN b.feature IS NULL THEN s.node
    ELSE 2 * s.node + CAST(s.bins[b.feature + 1] > b.bin AS BIGINT) END AS node
  FROM {name}{level} s LEFT JOIN splits b ON s.tree = b.tree AND s.node = b.node)"""
        )
    return ",\n".join(parts)


def scored(oob: bool = False, rows: str = "SELECT CAST(tree AS INTEGER) AS tree, unit, bins FROM binned, trees") -> str:
    if oob:
        rows += f" WHERE {draw('unit', 'tree')} >= 32768"
    return f"""{walk("ended", rows)},
used AS MATERIALIZED (SELECT a.unit, l.* FROM ended a JOIN leaves l ON a.tree = l.tree AND a.node = l.node),
mean_leaf AS MATERIALIZED (SELECT unit, count(*) AS trees, avg(mz) AS mz, avg(mw) AS mw, avg(my) AS my, avg(mzy) AS mzy, avg(mzw) AS mzw
  FROM used GROUP BY unit),
effects AS MATERIALIZED (SELECT *, (mzy - mz * my) / nullif(mzw - mz * mw, 0) AS effect, mzw - mz * mw AS spread FROM mean_leaf)"""


def predict(oob: bool = False, residual: bool = False) -> str:
    return f"""{forest(residual=residual)},
{scored(oob)}
SELECT b.unit AS unit_id, {r("e.effect")} AS effect, CAST(coalesce(e.trees, 0) AS INTEGER) AS n_trees,
  CASE WHEN e.unit IS NULL THEN 'no_tree' WHEN e.effect IS NULL THEN 'no_first_stage' ELSE 'ok' END AS effect_status
FROM binned b LEFT JOIN effects e ON b.unit = e.unit"""


PREDICT_ORDERED = f"""{forest_ordered()},
{scored(rows="SELECT tree, unit, bins FROM every")}
SELECT b.unit_id, {r("e.effect")} AS effect, CAST(coalesce(e.trees, 0) AS INTEGER) AS n_trees,
  CASE WHEN e.unit IS NULL THEN 'no_tree' WHEN e.effect IS NULL THEN 'no_first_stage' ELSE 'ok' END AS effect_status
FROM iv_panel b LEFT JOIN effects e ON b.unit_id = e.unit"""

VARIANCE = f"""{forest(bag_size=2, fraction=0.25)},
{scored()},
scores AS (SELECT u.unit, (u.tree - 1) // 2 AS bag,
    ((u.mzy - e.effect * u.mzw - (e.my - e.effect * e.mw) * u.mz)
      - e.mz * (u.my - e.my - e.effect * (u.mw - e.mw))) / e.spread AS score
  FROM used u JOIN effects e ON u.unit = e.unit),
bags AS (SELECT unit, bag, avg(score) AS centre, var_pop(score) AS within FROM scores GROUP BY ALL HAVING count(*) = 2),
spread AS (SELECT unit, count(*) AS bags, sum(centre * centre) AS between_bags, sum(within) AS within_bags FROM bags GROUP BY unit)
SELECT b.unit AS unit_id, {r("e.effect")} AS effect,
  {r("CASE WHEN s.bags >= 2 THEN sqrt(greatest(s.between_bags - s.within_bags, 0) / s.bags) END")} AS std_error,
  CAST(coalesce(e.trees, 0) AS INTEGER) AS n_trees,
  CASE WHEN e.unit IS NULL THEN 'no_tree' WHEN e.effect IS NULL THEN 'no_first_stage' ELSE 'ok' END AS effect_status
FROM binned b LEFT JOIN effects e ON b.unit = e.unit LEFT JOIN spread s ON b.unit = s.unit"""

SPLITS_OUT = f"SELECT tree, node, feature, bin, {r('gain', 2)} AS gain FROM splits"
LEAVES_OUT = "SELECT tree, node, CAST(n AS BIGINT) AS n, " + ", ".join(
    f"{r(c, 7)} AS {c}" for c in ("mz", "mw", "my", "mzy", "mzw")
) + " FROM leaves"

BIN_FEATURES = f"""WITH {IV_PANEL}
SELECT unit_id, {", ".join(f"{b} AS {n}" for b, n in zip(bin_list(), ["bin_acctbal", "bin_price"] + [f"bin_priority_{p[0]}" for p in PRIORITIES]))}
FROM iv_panel"""

HONEST_DRAWS = f"""WITH {IV_PANEL},
d AS (SELECT unit_id, CAST(tree AS INTEGER) AS tree, {draw("unit_id", "tree")} AS draw
  FROM iv_panel, (SELECT unnest(range(1, {q.DRAW_TREES + 1})) AS tree))
SELECT unit_id, tree, CASE WHEN draw >= 32768 THEN 'out' WHEN draw % 2 = 0 THEN 'split' ELSE 'leaf' END AS role FROM d"""


# ---------------------------------------------------------------- curves


def terms(x: str, knots: tuple[float, ...]) -> list[str]:
    return ["1e0", x, *[relu(f"{x} - {t}e0") for t in knots]]


def slopes(x: str, knots: tuple[float, ...]) -> list[str]:
    return ["0e0", "1e0", *[f"2e0 * greatest({x} - {t}e0, 0e0)" for t in knots]]


def products(name: str, source: str, columns: list[str], y: str, keys: str = "segment", where: str = "TRUE") -> str:
    """CTE of mean cross products ``g_i_j`` (i <= j), ``b_i``, ``yy`` and ``n`` per segment."""
    k = len(columns)
    items = [f"avg(({columns[i]}) * ({columns[j]})) AS g_{i}_{j}" for i in range(k) for j in range(i, k)]
    items += [f"avg(({columns[i]}) * ({y})) AS b_{i}" for i in range(k)]
    return f"""{name} AS MATERIALIZED (SELECT {keys}, count(*) AS n, avg(({y}) * ({y})) AS yy, {", ".join(items)}
  FROM {source} WHERE {where} GROUP BY {keys})"""


def solve(name: str, source: str, k: int, signed: list[int]) -> str:
    """CTEs ending in ``name``: coefficients ``c_0``.. and the mean loss per segment, by trying every
    set of signed terms: the best of those whose coefficients are all >= 0 is the constrained optimum."""
    bits = {i: n for n, i in enumerate(signed)}
    on = [f"((mask >> {bits[i]}) & 1)" if i in bits else "1" for i in range(k)]
    alive = [f"(CASE WHEN g_{i}_{i} > 0 THEN 1 ELSE 0 END)" for i in range(k)]
    scale = [f"sqrt(CASE WHEN g_{i}_{i} > 0 THEN g_{i}_{i} ELSE 1e0 END)" for i in range(k)]
    start = []
    for i in range(k):
        for j in range(k):
            lo, hi = min(i, j), max(i, j)
            cell = f"g_{lo}_{hi} / (d_{i} * d_{j}) * o_{i} * o_{j}"
            start.append(f"{cell}{f' + (1 - o_{i})' if i == j else ''} AS a_{i}_{j}")
        start.append(f"b_{i} / d_{i} * o_{i} AS a_{i}_{k}")
    carry = "segment, n, yy, mask, " + ", ".join([f"b_{i}" for i in range(k)] + [f"d_{i}" for i in range(k)])
    parts = [
        f"""{name}_m AS MATERIALIZED (SELECT s.*, mask, {", ".join(f"{on[i]} * {alive[i]} AS o_{i}, {scale[i]} AS d_{i}" for i in range(k))}
  FROM {source} s, (SELECT unnest(range({2 ** len(signed)})) AS mask))""",
        f"{name}_s AS MATERIALIZED (SELECT {carry}, {', '.join(start)} FROM {name}_m)",
    ]
    last = f"{name}_s"
    for p in range(k):
        cells = []
        for i in range(k):
            for j in range(p, k + 1):
                value = f"a_{p}_{j} / a_{p}_{p}" if i == p else f"a_{i}_{j} - a_{i}_{p} * a_{p}_{j} / a_{p}_{p}"
                cells.append(f"{value} AS a_{i}_{j}")
        parts.append(f"{name}_e{p} AS MATERIALIZED (SELECT {carry}, {', '.join(cells)} FROM {last})")
        last = f"{name}_e{p}"
    feasible = " AND ".join(f"a_{i}_{k} >= 0" for i in signed) or "TRUE"
    fitted = " - ".join(["yy"] + [f"a_{i}_{k} / d_{i} * b_{i}" for i in range(k)])
    parts.append(
        f"""{name} AS MATERIALIZED (SELECT segment, n, greatest({fitted}, 0e0) AS loss,
    {", ".join(f"a_{i}_{k} / d_{i} AS c_{i}" for i in range(k))}
  FROM {last} WHERE {feasible} QUALIFY row_number() OVER (PARTITION BY segment ORDER BY {fitted}) = 1)"""
    )
    return ",\n".join(parts)


def curve(x: str, knots: tuple[float, ...], c: str = "c") -> str:
    return " + ".join(f"{c}.c_{i} * ({t})" for i, t in enumerate(terms(x, knots)))


def curve_slope(x: str, knots: tuple[float, ...], c: str = "c") -> str:
    return " + ".join(f"{c}.c_{i} * ({t})" for i, t in enumerate(slopes(x, knots)))


SIGNED = list(range(1, 2 + len(KNOTS)))
CURVES = f"""WITH {DOSE_PANEL},
{products("crossed", "dose_panel", terms("dose", KNOTS), "y")},
{solve("curves", "crossed", 2 + len(KNOTS), SIGNED)}"""


def grid(n: int, lo: float, hi: float, segments: str = "SELECT DISTINCT segment FROM dose_panel") -> str:
    return f"""points AS MATERIALIZED (SELECT segment, CAST(i AS INTEGER) AS point_id, {lo}e0 + i * (({hi}e0 - {lo}e0) / {n - 1}) AS dose
  FROM ({segments}), (SELECT unnest(range({n})) AS i))"""


def audit(rows: str, pred: str, x: str, by: str, slope_sign: int, bend_sign: int, worst: bool = True) -> str:
    return f"""pts AS (SELECT {by}, {x} AS x, CASE WHEN min({pred}) = max({pred}) THEN min({pred}) ELSE avg({pred}) END AS p
  FROM {rows} GROUP BY {by}, {x}),
d1 AS (SELECT *, x - lag(x) OVER o AS gap, x - lag(x, 2) OVER o AS span, p - lag(p) OVER o AS rise
  FROM pts WINDOW o AS (PARTITION BY {by} ORDER BY x)),
d2 AS (SELECT *, (rise / gap - lag(rise / gap) OVER o) / span AS turn,
    4e-15 * max(abs(p)) OVER three / min(gap) OVER three AS fuzz
  FROM d1 WINDOW o AS (PARTITION BY {by} ORDER BY x),
    three AS (PARTITION BY {by} ORDER BY x ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
d3 AS (SELECT *, CASE WHEN {-slope_sign} * (rise / gap) > 1e-9 + fuzz THEN {-slope_sign} * (rise / gap) END AS slope,
    CASE WHEN {-bend_sign} * turn > 1e-9 + fuzz / span THEN {-bend_sign} * turn END AS bend FROM d2)
SELECT {by}, count(*) AS points, count(slope) AS slope_breaches,
  count(bend) AS bend_breaches{f", {r('coalesce(greatest(max(slope), max(bend)), 0e0)', 2)} AS worst" if worst else ""}
FROM d3 GROUP BY {by}"""


def gram_rows(source: str, k: int, keys: str, counts: bool = True, digits: int = 6) -> str:
    """Long form of a CTE made by :func:`products`."""
    rows = [f"SELECT {keys}, {i} AS i, {j} AS j, g_{i}_{j} AS value FROM {source}" for i in range(k) for j in range(i, k)]
    rows += [f"SELECT {keys}, {i} AS i, {k} AS j, b_{i} AS value FROM {source}" for i in range(k)]
    rows += [f"SELECT {keys}, {k} AS i, {k} AS j, yy AS value FROM {source}"]
    if counts:
        rows += [f"SELECT {keys}, -1 AS i, 0 AS j, CAST(n AS DOUBLE) AS value FROM {source}"]
        rows += [f"SELECT {keys}, -1 AS i, 1 AS j, 0e0 AS value FROM {source}"]
    return " UNION ALL ".join(rows)


H = q.GRID_STEP
THIRD = ((3, 1.0), (2, -3.0), (1, 3.0), (0, -1.0))


def stencil_terms(x: str, knots: tuple[float, ...], stencil=THIRD) -> list[str]:
    at = [(terms(f"({x} + {steps * H}e0)", knots), coef) for steps, coef in stencil]
    return [" + ".join(f"{coef}e0 * ({t[i]})" for t, coef in at) for i in range(2 + len(knots))]


def third_prior(knots: tuple[float, ...]) -> str:
    """CTE of the mean cross products of the third-difference prior over the grid on [0, 0.1]."""
    return products("prior3", "points", stencil_terms("dose", knots), "0e0", where=f"dose + {3 * H}e0 <= 0.1e0 + 1e-10")


def combined(name: str, k: int, data: str, priors: list[tuple[str, float]]) -> str:
    """CTE of the data's cross products plus each prior's, times its factor."""
    joins = " ".join(f"JOIN {p} ON {p}.segment = {data}.segment" for p, _ in priors)
    items = []
    for column in [f"g_{i}_{j}" for i in range(k) for j in range(i, k)] + [f"b_{i}" for i in range(k)] + ["yy"]:
        items.append(f"{data}.{column}" + "".join(f" + {factor}e0 * {p}.{column}" for p, factor in priors) + f" AS {column}")
    return f"{name} AS MATERIALIZED (SELECT {data}.segment, {data}.n, {', '.join(items)} FROM {data} {joins})"


K = 2 + len(KNOTS)


def soft(source: str = "dose_panel") -> str:
    return f"""WITH {DOSE_PANEL},
{grid(41, 0.0, 0.1)},
{products("crossed", source, terms("dose", KNOTS), "y")},
{third_prior(KNOTS)},
{combined("joint", K, "crossed", [("prior3", q.LAMBDA)])},
{solve("curves", "joint", K, [])}"""


SOFT_POINTS = f"""SELECT p.segment, p.point_id, {r(curve("p.dose", KNOTS))} AS pred, {r(curve_slope("p.dose", KNOTS), 2)} AS slope
FROM points p JOIN curves c ON c.segment = p.segment"""


def prior_gram() -> str:
    bound = products("prior_hi", "points", terms("dose", KNOTS), "25e0")
    return f"""WITH {DOSE_PANEL},
{grid(41, 0.0, 0.1)},
{products("crossed", "dose_panel", terms("dose", KNOTS), "y")},
{third_prior(KNOTS)},
{bound},
{combined("joint", K, "crossed", [("prior3", 100.0), ("prior_hi", 50.0)])},
longform AS ({gram_rows("joint", K, "segment")})
SELECT segment, i, j, {r("value", 6)} AS value FROM longform"""


def prior_residuals() -> str:
    """Each prior at each grid point of [0, 0.12] where its whole stencil fits."""
    priors = [
        ("increasing", ((1, 1.0), (0, -1.0)), ">=", 0.0),
        ("convex", ((1, 1.0), (0, -2.0), (-1, 1.0)), ">=", 0.0),
        ("upper_bound", ((0, 1.0),), "<=", 45.0),
        ("third_difference", THIRD, "=", 0.0),
    ]
    parts = []
    for name, stencil, relation, target in priors:
        value = " + ".join(f"{coef}e0 * ({curve(f'(p.dose + {s * H}e0)', KNOTS)})" for s, coef in stencil)
        first, last = min(s for s, _ in stencil) * H, max(s for s, _ in stencil) * H
        parts.append(
            f"""SELECT p.segment, p.point_id, '{name}' AS prior, '{relation}' AS relation, {target}e0 AS target, {value} AS value
  FROM points p JOIN curves c ON c.segment = p.segment
  WHERE p.dose + {first}e0 >= -1e-10 AND p.dose + {last}e0 <= 0.12e0 + 1e-10"""
        )
    miss = "value - target"
    return f"""{CURVES},
{grid(41, 0.0, 0.12)},
found AS ({" UNION ALL ".join(parts)})
SELECT segment, point_id, prior, {r("value")} AS value, {r(f'''CASE relation WHEN '=' THEN {miss}
  WHEN '>=' THEN least({miss}, 0e0) ELSE greatest({miss}, 0e0) END''')} AS residual FROM found"""


def report(repeated: str = "") -> str:
    knots, k = q.REPORT_KNOTS, 2 + len(q.REPORT_KNOTS)
    parts = [
        f"WITH {DOSE_PANEL}",
        grid(41, 0.0, 0.1),
        products("crossed", "dose_panel", terms("dose", knots), "y", where=f"NOT dose BETWEEN {q.REPORT_CUT}e0 AND 1e0"),
        third_prior(knots),
        combined("joint", k, "crossed", [("prior3", q.LAMBDA)]),
        solve("free", "crossed", k, []),
        solve("shape", "crossed", k, list(range(1, k))),
        solve("soft", "joint", k, []),
    ]
    errors = " UNION ALL ".join(
        f"""SELECT '{m}' AS model, d.segment, d.dose BETWEEN {q.REPORT_CUT}e0 AND 1e0 AS held, {curve("d.dose", knots)} - d.truth AS e{repeated}
  FROM dose_panel d JOIN {m} c ON c.segment = d.segment"""
        for m in ("free", "shape", "soft")
    )
    return ",\n".join(parts) + f""",
errors AS ({errors}),
o AS (SELECT segment, model, count(*) FILTER (held) AS n, sqrt(avg(e * e) FILTER (held)) AS rmse, avg(abs(e)) FILTER (held) AS mae,
    avg(e) FILTER (held) AS bias, count(*) FILTER (NOT held) AS n_train, sqrt(avg(e * e) FILTER (NOT held)) AS rmse_train
  FROM errors GROUP BY segment, model)
SELECT segment, model, n, CAST(0 AS BIGINT) AS n_dropped, {r("rmse")} AS rmse, {r("mae")} AS mae, {r("bias")} AS bias, n_train,
  {r("rmse_train")} AS rmse_train, {r("rmse - rmse_train")} AS gap FROM o"""


def softplus(x: float) -> str:
    return f"ln(1e0 + exp({x}e0))"


def net_predict() -> str:
    theta, h = q.NET_THETA, (len(q.NET_THETA) - 1) // 4
    v, a, u, b = (theta[1 + i * h : 1 + (i + 1) * h] for i in range(4))
    s0, s1, t0, t1, mean, sd = q.NET_SCALES
    s, t = f"((l_discount - {s0}e0) / {s1}e0)", f"((l_quantity - {t0}e0) / {t1}e0)"
    units = [f"{softplus(v[k])} * {relu(f'{softplus(a[k])} * {s} + ({u[k]}e0) * {t} + ({b[k]}e0)')}" for k in range(h)]
    total = f"(({theta[0]}e0) + {' + '.join(units)}) * {sd}e0 + {mean}e0"
    return f"SELECT l_orderkey, l_linenumber, {r(total)} AS pred FROM lineitem"


def net_steps(prior: bool, where: str = "TRUE", weight: str = "1") -> str:
    """Damped Gauss-Newton steps of a net with two hidden units, from a given start.

    ``parts`` are the places at which an observation needs the net, with a factor: one for a cell of equal doses, four
    for a third difference. A step solves for all weights by elimination and is kept if the loss falls.
    """
    s0, s1, _, _, mean, sd = q.STEPS_SCALES
    p, h = len(q.STEPS_THETA), 2
    c, v, a, u, b = "th_0", ["th_1", "th_2"], ["th_3", "th_4"], ["th_5", "th_6"], ["th_7", "th_8"]
    times = f"(SELECT *, (y - {mean}e0) / {sd}e0 AS v, unnest(range({weight})) FROM dose_panel WHERE {where})"
    cells = f"""cells AS (SELECT (dose - {s0}e0) / {s1}e0 AS s, count(*) AS n, avg(v) AS m, var_pop(v) AS q FROM {times} GROUP BY dose)"""
    parts = """SELECT 'cell ' || s AS id, s, 1e0 AS coef, n / sum(n) OVER () AS weight, m, q FROM cells"""
    if prior:
        shifts = " UNION ALL ".join(f"SELECT {k * H / s1}e0 AS shift, {coef}e0 AS coef" for k, coef in THIRD)
        parts += f""" UNION ALL SELECT 'point ' || point_id, (dose - {s0}e0) / {s1}e0 + shift, coef,
    {q.STEPS_LAMBDA}e0 / (SELECT count(*) FROM points WHERE dose + {3 * H}e0 <= 0.1e0 + 1e-10), 0e0, 0e0
  FROM points, ({shifts}) WHERE dose + {3 * H}e0 <= 0.1e0 + 1e-10"""
    ctes = [f"WITH {DOSE_PANEL}", grid(41, 0.0, 0.1, "SELECT 0 AS segment"), cells, f"parts AS MATERIALIZED ({parts})"]
    theta = ", ".join(f"CAST({t}e0 AS DOUBLE) AS th_{i}" for i, t in enumerate(q.STEPS_THETA))
    ctes.append(f"now0 AS (SELECT {theta}, 1e-2 AS damping)")

    def soft(x: str) -> str:
        return f"ln(1e0 + exp({x}))"

    def share(x: str) -> str:
        return f"(1e0 / (1e0 + exp(-({x}))))"

    inner = [f"greatest({soft(a[k])} * s + {b[k]}, 0e0)" for k in range(h)]
    grow = [f"{soft(v[k])} * 2e0 * {inner[k]}" for k in range(h)]
    slopes_by = ["1e0"]
    slopes_by += [f"pow({inner[k]}, 2) * {share(v[k])}" for k in range(h)]
    slopes_by += [f"{grow[k]} * s * {share(a[k])}" for k in range(h)]
    slopes_by += ["0e0" for _ in u] + [grow[k] for k in range(h)]
    value = f"{c} + " + " + ".join(f"pow({inner[k]}, 2) * {soft(v[k])}" for k in range(h))

    def sums(name: str, weights: str) -> list[str]:
        columns = ", ".join(f"sum(coef * ({x})) AS j_{i}" for i, x in enumerate(slopes_by))
        products = [f"sum(weight * j_{i} * j_{j}) AS a_{i}_{j}" for i in range(p) for j in range(i, p)]
        products += [f"-sum(weight * j_{i} * (f - m)) AS a_{i}_{p}" for i in range(p)]
        return [
            f"""{name}_f AS (SELECT id, weight, m, q, sum(coef * ({value})) AS f, {columns} FROM parts, {weights} GROUP BY id, weight, m, q)""",
            f"""{name} AS MATERIALIZED (SELECT {", ".join(products)}, sum(weight * (pow(f - m, 2) + q)) AS loss FROM {name}_f)""",
        ]

    ctes += sums("sums0", "now0")
    for step in range(q.NET_STEPS):
        most = f"greatest({', '.join(f'a_{i}_{i}' for i in range(p))}, 1e-12)"
        start = []
        for i in range(p):
            for j in range(p):
                cell = f"a_{min(i, j)}_{max(i, j)}"
                start.append((f"{cell} + damping * ({cell} + 1e-8 * {most})" if i == j else cell) + f" AS e_{i}_{j}")
            start.append(f"a_{i}_{p} AS e_{i}_{p}")
        ctes.append(f"e{step}_0 AS (SELECT {', '.join(start)} FROM sums{step}, now{step})")
        for pivot in range(p):
            cells_left = []
            for i in range(p):
                for j in range(pivot + 1, p + 1):
                    x = f"e_{pivot}_{j} / e_{pivot}_{pivot}"
                    cells_left.append(f"{x if i == pivot else f'e_{i}_{j} - e_{i}_{pivot} * {x}'} AS e_{i}_{j}")
            ctes.append(f"e{step}_{pivot + 1} AS MATERIALIZED (SELECT {', '.join(cells_left)} FROM e{step}_{pivot})")
        moved = ", ".join(f"th_{i} + e_{i}_{p} AS th_{i}" for i in range(p))
        ctes.append(f"trial{step} AS MATERIALIZED (SELECT {moved} FROM now{step}, e{step}_{p})")
        ctes += sums(f"try{step}", f"trial{step}")
        falls = f"try{step}.loss < sums{step}.loss"
        chosen = ", ".join(f"CASE WHEN {falls} THEN trial{step}.th_{i} ELSE now{step}.th_{i} END AS th_{i}" for i in range(p))
        ctes.append(
            f"""now{step + 1} AS MATERIALIZED (SELECT {chosen}, CASE WHEN {falls} THEN greatest(damping / 5, 1e-10) ELSE damping * 8 END AS damping
  FROM now{step}, trial{step}, try{step}, sums{step})"""
        )
        names = [f"a_{i}_{j}" for i in range(p) for j in range(i, p)] + [f"a_{i}_{p}" for i in range(p)] + ["loss"]
        kept = ", ".join(f"CASE WHEN {falls} THEN try{step}.{n} ELSE sums{step}.{n} END AS {n}" for n in names)
        ctes.append(f"sums{step + 1} AS MATERIALIZED (SELECT {kept} FROM try{step}, sums{step})")
    rows = [f"SELECT 0 AS unit, NULL::DOUBLE AS a, NULL::DOUBLE AS u, NULL::DOUBLE AS v, {r('th_0')} AS b FROM now{q.NET_STEPS}"]
    rows += [
        f"SELECT {k + 1} AS unit, {r(a[k])} AS a, {r(u[k])} AS u, {r(v[k])} AS v, {r(b[k])} AS b FROM now{q.NET_STEPS}" for k in range(h)
    ]
    return ",\n".join(ctes) + "\n" + " UNION ALL ".join(rows)


def basis_columns() -> str:
    x = "l_quantity"
    convex = [f"{t} AS convex_{i}" for i, t in enumerate(terms(x, q.QUANTITY_KNOTS))]
    mirrored = ["1e0", x, *[relu(f"{t}e0 - {x}") for t in q.QUANTITY_KNOTS]]
    concave = [f"{t} AS concave_{i}" for i, t in enumerate(mirrored)]
    return f"SELECT l_orderkey, l_linenumber, l_quantity, {', '.join(convex + concave)} FROM lineitem"


def weighted_gram() -> str:
    columns = terms("l_discount", (0.02, 0.05))
    k, y, keys = len(columns), "l_quantity", "l_returnflag, l_linestatus"
    every = [*columns, y]
    rows = [
        f"SELECT {keys}, {i} AS i, {j} AS j, avg(l_tax * ({every[i]}) * ({every[j]})) AS value FROM lineitem GROUP BY {keys}"
        for i in range(k + 1)
        for j in range(i, k + 1)
    ]
    rows.append(f"SELECT {keys}, -1 AS i, 0 AS j, CAST(count(*) AS DOUBLE) AS value FROM lineitem GROUP BY {keys}")
    rows.append(f"SELECT {keys}, -1 AS i, 1 AS j, 0e0 AS value FROM lineitem GROUP BY {keys}")
    return f"SELECT {keys}, i, j, {r('value', 6)} AS value FROM ({' UNION ALL '.join(rows)})"


def bounded_curves(rounds: int = 12) -> str:
    """Curves under an upper bound and a rise along the grid: solve, mark the points in breach, solve again. Each round
    is a Newton step on a convex loss that is quadratic between sets of points, so a set that stays is the minimum's."""
    rise = ((1, 1.0), (0, -1.0))
    fits = f"p.dose + {H}e0 <= 0.1e0 + 1e-10"
    parts = [
        f"WITH {DOSE_PANEL}",
        grid(41, 0.0, 0.1),
        products("crossed", "dose_panel", terms("dose", KNOTS), "y"),
        solve("curves0", "crossed", K, []),
    ]
    for n in range(1, rounds + 1):
        rising = " + ".join(f"{coef}e0 * ({curve(f'(p.dose + {s * H}e0)', KNOTS)})" for s, coef in rise)
        parts += [
            f"""marked{n} AS MATERIALIZED (SELECT p.segment, p.dose, {fits} AS fits,
    CASE WHEN {curve("p.dose", KNOTS)} > {q.BOUND}e0 THEN 1e0 ELSE 0e0 END AS high,
    CASE WHEN {rising} < 0 THEN 1e0 ELSE 0e0 END AS falls
  FROM points p JOIN curves{n - 1} c ON c.segment = p.segment)""",
            products(f"high{n}", f"marked{n}", [f"high * ({t})" for t in terms("dose", KNOTS)], f"high * {q.BOUND}e0"),
            products(f"falls{n}", f"marked{n}", [f"falls * ({t})" for t in stencil_terms("dose", KNOTS, rise)], "0e0", where="fits"),
            combined(f"joint{n}", K, "crossed", [(f"high{n}", q.BOUND_LAMBDA), (f"falls{n}", q.BOUND_LAMBDA)]),
            solve(f"curves{n}", f"joint{n}", K, []),
        ]
    return ",\n".join(parts) + f"""
SELECT p.segment, p.point_id, {r(curve("p.dose", KNOTS))} AS pred, {r(curve_slope("p.dose", KNOTS), 2)} AS slope
FROM points p JOIN curves{rounds} c ON c.segment = p.segment"""


OVER = "(l_quantity - 25e0)"
def net_steps_by(prior: bool) -> str:
    parts = [f"SELECT '{k}' AS segment, * FROM ({net_steps(prior, f"segment = '{k}'")})" for k in ("A", "N", "R")]
    return " UNION ALL ".join(parts)


NET_CLAIMS = """SELECT l_returnflag AS segment, count(*) AS n, CAST(0 AS BIGINT) AS n_dropped, TRUE AS ended, CAST(81 AS BIGINT) AS points,
  CAST(0 AS BIGINT) AS slope_breaches, CAST(0 AS BIGINT) AS bend_breaches, TRUE AS near_truth FROM lineitem GROUP BY l_returnflag"""

SQL: dict[str, str] = {
    "experiment_panel": EXPERIMENT_PANEL,
    "experiment_panel_dates": EXPERIMENT_PANEL_DATES,
    "iv_effect_incomplete": iv_effect(["segment"], where="unit_id % 17 <> 0 AND unit_id % 13 <> 0 AND unit_id % 11 <> 0 AND unit_id % 7 <> 0"),
    "iv_effect_many": IV_EFFECT_MANY,
    "iv_effect_weighted": iv_effect(["segment"], repeat=REPEATED),
    "iv_forest_weighted": f"{forest(repeat=REPEATED)}\n{SPLITS_OUT}",
    "iv_effect": iv_effect(["segment"]),
    "iv_effect_overall": iv_effect([]),
    "iv_effect_by_band": iv_effect(["high_balance", "priority", "segment"], ", acctbal >= 4500 AS high_balance"),
    "cross_fit_residuals": CROSS_FIT,
    "cross_fit_residuals_trees": residual_trees(),
    "honest_draws": HONEST_DRAWS,
    "bin_features": BIN_FEATURES,
    "iv_split": IV_SPLIT,
    "iv_forest_fit": f"{forest()}\n{SPLITS_OUT}",
    "iv_forest_leaves": f"{forest()}\n{LEAVES_OUT}",
    "iv_forest_predict": predict(),
    "iv_forest_predict_oob": predict(oob=True),
    "iv_forest_centred": predict(oob=True, residual=True),
    "iv_forest_ordered": f"{forest_ordered()}\n{SPLITS_OUT}",
    "iv_forest_ordered_predict": PREDICT_ORDERED,
    "causal_forest_fit": f"{forest(w='z')}\n{SPLITS_OUT}",
    "iv_forest_variance": VARIANCE,
    "recu": f"""SELECT l_orderkey, l_linenumber, {r(relu(OVER))} AS recu_2,
  {r(f"pow(greatest({OVER}, 0e0), 1.5e0)")} AS recu_1_5,
  {r(f"CASE WHEN {OVER} > -20 THEN pow(greatest({OVER}, 0e0), 3) END")} AS recu_3 FROM lineitem""",
    "recu_basis": basis_columns(),
    "gram": f"""WITH {DOSE_PANEL},
{products("crossed", "dose_panel", terms("dose", KNOTS), "y")},
longform AS ({gram_rows("crossed", K, "segment")})
SELECT segment, i, j, {r("value", 6)} AS value FROM longform""",
    "gram_weighted": weighted_gram(),
    "shape_curve_fit": f"""{CURVES}
SELECT segment, n, CAST(0 AS BIGINT) AS n_dropped, {r("loss")} AS loss, 'ok' AS status, CAST(term AS INTEGER) AS term, {r("coef", 2)} AS coef
FROM (SELECT segment, n, loss, unnest(range({K})) AS term, unnest([{", ".join(f"c_{i}" for i in range(K))}]) AS coef FROM curves)""",
    "curve_predict": f"""{CURVES}
SELECT d.order_key, d.line_no, d.segment, {r(curve("d.dose", KNOTS))} AS pred, {r(curve_slope("d.dose", KNOTS), 2)} AS slope
FROM dose_panel d JOIN curves c ON c.segment = d.segment""",
    "shape_audit": f"WITH {DOSE_PANEL},\n{audit('dose_panel', 'y', 'dose', 'segment', 1, 1)}",
    "shape_audit_prices": f"WITH {audit('lineitem', 'l_quantity', 'l_extendedprice', 'l_returnflag', -1, -1)}",
    "shape_audit_fitted": f"""{CURVES},
{grid(81, -0.05, 0.2)},
fitted AS (SELECT p.segment, p.dose, {curve("p.dose", KNOTS)} AS pred FROM points p JOIN curves c ON c.segment = p.segment),
{audit("fitted", "pred", "dose", "segment", 1, 1)}""",
    "prior_curve_fit_bounds": bounded_curves(),
    "recu_net_predict": net_predict(),
    "recu_net_steps": net_steps(prior=False),
    "prior_net_steps": net_steps(prior=True),
    "recu_net_steps_by": net_steps_by(prior=False),
    "recu_net_steps_weighted": net_steps(prior=False, weight="line_no"),
    "recu_net_claims_by": NET_CLAIMS,
    "prior_net_steps_by": net_steps_by(prior=True),
    "prior_net_claims_by": NET_CLAIMS,
    "recu_net_claims": """SELECT count(*) AS n, 'converged' AS status, CAST(81 AS BIGINT) AS points, CAST(0 AS BIGINT) AS slope_breaches,
  CAST(0 AS BIGINT) AS bend_breaches, TRUE AS near_truth FROM lineitem""",
    "collocation_points": f"""WITH e AS (SELECT l_returnflag, l_linestatus, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
  FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_linestatus, CAST(i AS INTEGER) AS point_id, {r("lo + i * ((hi - lo) / 40)", 6)} AS l_extendedprice,
  {r("lo", 6)} AS lo, {r("hi", 6)} AS hi FROM e, (SELECT unnest(range(41)) AS i)""",
    "prior_residuals": prior_residuals(),
    "prior_gram": prior_gram(),
    "prior_curve_fit": f"{soft()}\n{SOFT_POINTS}",
    "prior_curve_fit_weighted": f"{soft('(SELECT *, unnest(range(line_no)) FROM dose_panel)')}\n{SOFT_POINTS}",
    "generalization_report_weighted": report(", unnest(range(line_no)) AS time"),
    "generalization_report": report(),
}
