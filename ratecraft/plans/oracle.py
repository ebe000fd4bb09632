"""DuckDB SQL twins of the catalogue queries (the correctness oracle).

Each string runs on views named after the driver tables. Aliases match the Spark
column names exactly. Dialect notes: DuckDB ``CAST(double AS BIGINT)`` rounds, so
truncation is written ``CAST(trunc(x) AS BIGINT)``; ``sum``/``count`` results are
cast to BIGINT; ``x / 0.0`` is infinity in DuckDB, so divisors go through
``nullif``. Floating outputs use the same significant-digit rounding as Spark.
"""

from __future__ import annotations

from ratecraft.plans.catalogue import (
    EARLY_STOP_DELTA, EARLY_STOP_TOLERANCE, FIXED_MODEL, RANKING_GROUPS, RANKING_TARGETS, MI_FEATURES, MI_TARGETS, PRIORITY_CODES, PROFILE_NUMERIC, SEARCH_SPACE, VIF_COLS,
)
from ratecraft.plans.tables import LINE_NUMERIC


def sig(x: str, d: int = 9) -> str:
    """SQL twin of ``round_sig`` (same IEEE operations, no engine ``round``)."""
    ax = f"(abs({x}) * CAST({1.0 + 1e-12!r} AS DOUBLE))"
    k = f"(CAST({float(d - 1)!r} AS DOUBLE) - floor(log10(abs({x}))))"
    up = f"(floor({ax} * pow(10.0, {k}) + 0.5) / pow(10.0, {k}))"
    down = f"(floor({ax} / pow(10.0, -{k}) + 0.5) * pow(10.0, -{k}))"
    mag = f"(CASE WHEN {k} >= 0 THEN {up} ELSE {down} END)"
    return (f"(CASE WHEN ({x}) IS NULL THEN NULL WHEN isnan({x}) OR ({x}) = 0 THEN ({x}) "
            f"WHEN ({x}) < 0 THEN -{mag} ELSE {mag} END)")


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_ORDER_FACTS = """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
         CAST(year(o_orderdate) AS BIGINT) AS yr, c_nationkey AS nk
  FROM orders JOIN customer ON o_custkey = c_custkey"""

_COUNTS = f"""
  SELECT nk, yr, o_orderpriority AS pr, l_returnflag AS site, CAST(count(*) AS BIGINT) AS cnt
  FROM lineitem JOIN ({_ORDER_FACTS}) f ON l_orderkey = f.o_orderkey
  GROUP BY ALL"""

_POPULATION = """
  SELECT c_nationkey AS nk, CAST(year(o_orderdate) AS BIGINT) AS yr,
         CAST(count(DISTINCT c_custkey) AS BIGINT) AS population
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""

_RATE_LONG = f"""
  SELECT c.*, p.population,
         CAST(trunc(CAST(c.cnt AS DOUBLE) / p.population * 100000) AS BIGINT) AS rate
  FROM ({_COUNTS}) c LEFT JOIN ({_POPULATION}) p
    ON c.nk IS NOT DISTINCT FROM p.nk AND c.yr IS NOT DISTINCT FROM p.yr"""

RATE_PIVOT = f"""
SELECT nk, yr, pr, population,
       CAST(trunc(avg(CASE WHEN site = 'A' THEN rate END)) AS BIGINT) AS a,
       CAST(trunc(avg(CASE WHEN site = 'N' THEN rate END)) AS BIGINT) AS n,
       CAST(trunc(avg(CASE WHEN site = 'R' THEN rate END)) AS BIGINT) AS r
FROM ({_RATE_LONG}) r
WHERE population IS NOT NULL AND rate IS NOT NULL AND nk IS NOT NULL AND yr IS NOT NULL
  AND pr IS NOT NULL AND site IS NOT NULL
GROUP BY nk, yr, pr, population
"""

_ECONOMY = f"""
  SELECT nk, yr, round(sum(o_totalprice), 2) AS gdp, CAST(count(*) AS BIGINT) AS n_jobs
  FROM ({_ORDER_FACTS}) f GROUP BY ALL"""

RATE_WITH_ECONOMY = f"""
SELECT rp.*, e.gdp, e.n_jobs
FROM ({RATE_PIVOT}) rp LEFT JOIN ({_ECONOMY}) e
  ON rp.nk IS NOT DISTINCT FROM e.nk AND rp.yr IS NOT DISTINCT FROM e.yr
"""

_SURVEY_F = f"""
  SELECT a.nk, a.yr, a._n / b._t * 100 AS non_smoker_rate
  FROM (SELECT nk, yr, o_orderstatus, count(*) AS _n FROM ({_ORDER_FACTS}) f GROUP BY ALL) a
  JOIN (SELECT nk, yr, count(*) AS _t FROM ({_ORDER_FACTS}) f GROUP BY ALL) b
    ON a.nk = b.nk AND a.yr = b.yr
  WHERE a.o_orderstatus = 'F'"""

RATE_WITH_SURVEY = f"""
SELECT w.nk, w.yr, w.pr, w.population, w.a, w.n, w.r, w.gdp, w.n_jobs,
       {sig('s.non_smoker_rate')} AS non_smoker_rate
FROM ({RATE_WITH_ECONOMY}) w LEFT JOIN ({_SURVEY_F}) s
  ON w.nk IS NOT DISTINCT FROM s.nk AND w.yr IS NOT DISTINCT FROM s.yr
"""

JOIN_KEY_DUPLICATES = """
SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS yr, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY ALL HAVING count(*) > 1
"""

RECODE_PRIORITY = ("SELECT o_orderkey, o_orderpriority, CASE o_orderpriority "
                   + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_CODES.items())
                   + " END AS priority_code FROM orders")

PREFIX_CODE = """
SELECT c_custkey, fips, substr(fips, 1, 2) AS state_code FROM (
  SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0')
                    || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS fips
  FROM customer)
"""

COERCE_INT = """
SELECT o_orderkey, count_text,
       COALESCE(TRY_CAST(count_text AS BIGINT),
                CAST(trunc(TRY_CAST(count_text AS DOUBLE)) AS BIGINT)) AS count_value,
       CAST(trunc(o_totalprice / 1000) AS BIGINT) AS price_k
FROM (SELECT o_orderkey, o_totalprice,
             CASE WHEN o_orderstatus = 'P' THEN 'Suppressed'
                  ELSE CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) END AS count_text
      FROM orders)
"""

_NATION_MEANS = f"""
  SELECT m.site, m.nk, n.n_name, m._mean, CAST(trunc(m._mean) AS BIGINT) AS mean_rate
  FROM (SELECT site, nk, avg(rate) AS _mean FROM ({_RATE_LONG}) r
        WHERE site IS NOT NULL AND nk IS NOT NULL GROUP BY site, nk) m
  LEFT JOIN nation n ON m.nk = n.n_nationkey"""

TOP5_NATIONS = f"""
SELECT site, CAST(row_number() OVER (PARTITION BY site ORDER BY _mean DESC NULLS LAST, nk) AS BIGINT) AS rank, nk, n_name, mean_rate
FROM ({_NATION_MEANS}) QUALIFY rank <= 5
"""

BOTTOM5_NATIONS = f"""
SELECT site, CAST(row_number() OVER (PARTITION BY site ORDER BY _mean, nk DESC) AS BIGINT) AS rank, nk, n_name, mean_rate
FROM ({_NATION_MEANS}) WHERE _mean IS NOT NULL QUALIFY rank <= 5
"""

RANK_SEGMENTS = """
SELECT c_mktsegment, CAST(trunc(_mean) AS BIGINT) AS mean_price,
       CAST(row_number() OVER (ORDER BY _mean DESC NULLS LAST, c_mktsegment) AS BIGINT) AS rank
FROM (SELECT c_mktsegment, avg(o_totalprice) AS _mean
      FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE c_mktsegment IS NOT NULL GROUP BY 1)
"""

_ORDER_RETURNS = """
  SELECT o.o_orderkey, o.o_totalprice, o.o_orderstatus, CAST(year(o.o_orderdate) AS BIGINT) AS yr,
         CASE WHEN o.o_orderstatus = 'O' THEN 'NaN'::DOUBLE ELSE o.o_totalprice END AS price_nan,
         rr.r_qty, rr.r_price, rr.r_lines
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, sum(l_quantity) AS r_qty, avg(l_extendedprice) AS r_price,
           CAST(count(*) AS BIGINT) AS r_lines
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) rr
  ON o.o_orderkey = rr.l_orderkey"""

# (name, spark simple type) of the order/returns frame, in column order.
_OR_COLS = [("o_orderkey", "bigint"), ("o_totalprice", "double"), ("o_orderstatus", "string"),
            ("yr", "bigint"), ("price_nan", "double"), ("r_qty", "double"),
            ("r_price", "double"), ("r_lines", "bigint")]


def _missing_cond(c: str, t: str) -> str:
    return f"({c} IS NULL OR isnan({c}))" if t == "double" else f"({c} IS NULL)"


def _missing_parts() -> list[str]:
    return [f"SELECT {i} AS position, '{c}' AS \"column\", "
            f"CAST(count_if({_missing_cond(c, t)}) AS BIGINT) AS missing_count, "
            f"CAST(count_if({_missing_cond(c, t)}) AS DOUBLE) * 100 / nullif(count(*), 0) AS _pct, "
            f"'{t}' AS dtype FROM f" for i, (c, t) in enumerate(_OR_COLS)]


MISSING_SUMMARY = f"""
WITH f AS ({_ORDER_RETURNS})
SELECT "column", missing_count, round_even(_pct, 2) AS missing_percent, dtype
FROM ({_union(_missing_parts())})
"""


def _clean_sql(c: str, t: str) -> str:
    return f"CAST(CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS DOUBLE)" if t == "double" \
        else f"CAST({c} AS DOUBLE)"


def _describe_parts() -> list[str]:
    types = dict(_OR_COLS)
    out = []
    for i, c in enumerate(PROFILE_NUMERIC):
        x = _clean_sql(c, types[c])
        out.append(
            f"SELECT {i} AS position, '{c}' AS \"column\", CAST(count(x) AS BIGINT) AS count, "
            f"{sig('avg(x)')} AS mean, {sig('stddev_samp(x)')} AS std, {sig('min(x)')} AS min, "
            f"{sig('quantile_cont(x, 0.25)')} AS p25, {sig('quantile_cont(x, 0.5)')} AS p50, "
            f"{sig('quantile_cont(x, 0.75)')} AS p75, {sig('max(x)')} AS max "
            f"FROM (SELECT {x} AS x FROM f)")
    return out


DESCRIBE = f"""
WITH f AS ({_ORDER_RETURNS})
SELECT "column", count, mean, std, min, p25, p50, p75, max FROM ({_union(_describe_parts())})
"""

PROFILE = f"""
WITH f AS ({_ORDER_RETURNS}),
d AS ({_union(_describe_parts())}),
m AS ({_union(_missing_parts())})
SELECT d."column", m.dtype, d.count, d.mean, d.std, d.min, d.p25, d.p50, d.p75, d.max,
       m.missing_count, {sig('m._pct')} AS missing_percent
FROM d LEFT JOIN m ON d."column" = m."column"
"""


def _pair_corr_sql(a: str, b: str, src: str, extra: str = "", group: str = "") -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return (f"SELECT {extra} covar_pop(a2, b2) / nullif(stddev_pop(a2) * stddev_pop(b2), 0) AS corr "
            f"FROM (SELECT {group + ', ' if group else ''}"
            f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END AS a2, "
            f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END AS b2 FROM {src})"
            + (f" GROUP BY {group}" if group else ""))


def _corr_matrix() -> str:
    parts = []
    cols = list(LINE_NUMERIC)
    for i, a in enumerate(cols):
        for b in cols[i:]:
            parts.append(_pair_corr_sql(a, b, "lineitem", f"'{a}' AS col_a, '{b}' AS col_b,"))
            if a != b:
                parts.append(_pair_corr_sql(a, b, "lineitem", f"'{b}' AS col_a, '{a}' AS col_b,"))
    return f"SELECT col_a, col_b, {sig('corr')} AS corr FROM ({_union(parts)})"


CROSS_TARGETS = ("l_extendedprice", "l_quantity")
CROSS_FEATURES = ("l_discount", "l_tax", "l_linenumber")


def _cross_corr(groups: tuple | None, threshold: float | None) -> str:
    where = "l_returnflag IS NOT NULL"
    if groups:
        where += " AND l_returnflag IN (" + ", ".join(f"'{g}'" for g in groups) + ")"
    src = f"(SELECT * FROM lineitem WHERE {where})"
    parts = [_pair_corr_sql(t, f, src, f"l_returnflag AS \"group\", '{t}' AS target, '{f}' AS feature,",
                            group="l_returnflag")
             for t in CROSS_TARGETS for f in CROSS_FEATURES]
    c = "corr" if threshold is None else f"(CASE WHEN abs(corr) >= {threshold} THEN corr END)"
    return f"SELECT \"group\", target, feature, {sig(c)} AS corr FROM ({_union(parts)})"


MEDIAN_FILL = f"""
WITH f AS ({_ORDER_RETURNS}),
med AS (SELECT quantile_cont(r_qty, 0.5) AS m1,
               quantile_cont(CASE WHEN isnan(price_nan) THEN NULL ELSE price_nan END, 0.5) AS m2,
               quantile_cont(CAST(r_lines AS DOUBLE), 0.5) AS m3 FROM f)
SELECT o_orderkey,
       {sig('CASE WHEN r_qty IS NULL OR isnan(r_qty) THEN m1 ELSE r_qty END')} AS r_qty,
       {sig('CASE WHEN price_nan IS NULL OR isnan(price_nan) THEN m2 ELSE price_nan END')} AS price_nan,
       CAST(trunc(CASE WHEN r_lines IS NULL THEN m3 ELSE CAST(r_lines AS DOUBLE) END) AS BIGINT) AS r_lines
FROM f, med
"""

MEAN_FILL = f"""
WITH f AS ({_ORDER_RETURNS}),
mu AS (SELECT avg(CASE WHEN isnan(r_price) THEN NULL ELSE r_price END) AS m FROM f)
SELECT o_orderkey, {sig('CASE WHEN r_price IS NULL OR isnan(r_price) THEN m ELSE r_price END')} AS r_price
FROM f, mu
"""


def _cardinality() -> str:
    parts = []
    for c in ("p_brand", "p_type", "p_size"):
        n = (f"(count(DISTINCT CAST({c} AS VARCHAR)) + "
             f"CASE WHEN count_if({c} IS NULL) > 0 THEN 1 ELSE 0 END)")
        parts.append(f"SELECT '{c}' AS \"column\", CAST({n} AS BIGINT) AS n_levels, "
                     f"CAST(least(50, ({n} + 1) // 2) AS BIGINT) AS emb_dim FROM part")
    return _union(parts)


DISTINCT_PAIRS = "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders"

UNION_ALL = """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment, 'customer' AS kind FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS VARCHAR), 'supplier' FROM supplier
"""


def _scaled(kind: str) -> str:
    cols = list(LINE_NUMERIC)
    if kind == "z":
        params = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(cols))
        exprs = ", ".join(
            sig(f"CASE WHEN s{i} = 0 THEN (CASE WHEN {c} IS NULL THEN NULL ELSE 0.0 END) "
                f"ELSE ({c} - m{i}) / s{i} END", 6) + f" AS {c}_z" for i, c in enumerate(cols))
    elif kind == "mm":
        params = ", ".join(f"min({c}) AS lo{i}, max({c}) AS hi{i}" for i, c in enumerate(cols))
        exprs = ", ".join(
            sig(f"CASE WHEN hi{i} = lo{i} THEN (CASE WHEN {c} IS NULL THEN NULL ELSE 0.0 END) "
                f"ELSE ({c} - lo{i}) / (hi{i} - lo{i}) END") + f" AS {c}_mm" for i, c in enumerate(cols))
    else:  # round trip: the original values
        return ("SELECT l_orderkey, l_linenumber, "
                + ", ".join(f"{sig(c)} AS {c}" for c in cols) + " FROM lineitem")
    return f"SELECT l_orderkey, l_linenumber, {exprs} FROM lineitem, (SELECT {params} FROM lineitem) p"


ORDINAL_CODES = """
WITH lv AS (
  SELECT col, level, CAST(dense_rank() OVER (PARTITION BY col ORDER BY level) - 1 AS BIGINT) AS code
  FROM (SELECT DISTINCT 'p_brand' AS col, COALESCE(CAST(p_brand AS VARCHAR), 'nan') AS level FROM part
        UNION SELECT DISTINCT 'p_type', COALESCE(CAST(p_type AS VARCHAR), 'nan') FROM part))
SELECT p.p_partkey, p.p_brand, p.p_type,
       COALESCE(b.code, -1) AS p_brand_code, COALESCE(t.code, -1) AS p_type_code
FROM part p
LEFT JOIN (SELECT level, code FROM lv WHERE col = 'p_brand') b
  ON COALESCE(CAST(p.p_brand AS VARCHAR), 'nan') = b.level
LEFT JOIN (SELECT level, code FROM lv WHERE col = 'p_type') t
  ON COALESCE(CAST(p.p_type AS VARCHAR), 'nan') = t.level
"""

# Part types of the driver data in byte order; the first is the dropped reference level.
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

DUMMIES = ("SELECT p_partkey, " + ", ".join(
    f"CAST(COALESCE(p_type = '{v}', false) AS INTEGER) AS type_{v.lower()}" for v in PART_TYPES[1:])
    + " FROM part")


def _hash_bucket(keys: list[str], seed: int) -> str:
    parts = ", ".join(f"COALESCE(CAST({k} AS VARCHAR), '')" for k in keys)
    return f"(('0x' || substr(md5(concat_ws('|', {parts}, '{seed}')), 1, 8))::BIGINT % 10000)"


HOLDOUT = (f"SELECT l_orderkey, l_linenumber, {_hash_bucket(['l_orderkey', 'l_linenumber'], 42)} < 2000 "
           "AS is_test FROM lineitem")

KFOLD = (f"SELECT l_orderkey, l_linenumber, CAST({_hash_bucket(['l_orderkey', 'l_linenumber'], 42)} % 3 "
         "AS INTEGER) AS fold FROM lineitem")

SAMPLE_N = """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
ORDER BY md5(concat_ws('|', COALESCE(CAST(l_orderkey AS VARCHAR), ''),
                            COALESCE(CAST(l_linenumber AS VARCHAR), ''), '7')),
         l_orderkey, l_linenumber, l_quantity
LIMIT 100
"""

FIRST_N = "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20"


def _determinant(m: list) -> str:
    """Laplace expansion of a matrix of SQL terms along its first row."""
    if len(m) == 1:
        return m[0][0]
    minors = [_determinant([r[:j] + r[j + 1:] for r in m[1:]]) for j in range(len(m))]
    return "(" + " ".join(f"{'-' if j % 2 else '+'} {m[0][j]} * {d}" for j, d in enumerate(minors)) + ")"


def _vif() -> str:
    """VIF of column i: determinant of the correlations without it over that of all."""
    n = len(VIF_COLS)
    known = " AND ".join(f"{c} IS NOT NULL" for c in VIF_COLS)
    corr = ", ".join(f"covar_pop({VIF_COLS[i]}, {VIF_COLS[j]}) / nullif(stddev_pop({VIF_COLS[i]}) * stddev_pop({VIF_COLS[j]}), 0) AS r{i}{j}"
                     for i in range(n) for j in range(i + 1, n))
    m = [["1.0" if i == j else f"r{min(i, j)}{max(i, j)}" for j in range(n)] for i in range(n)]
    parts = []
    for i, c in enumerate(VIF_COLS):
        rest = [[v for k, v in enumerate(row) if k != i] for j, row in enumerate(m) if j != i]
        parts.append(f"SELECT '{c}' AS feature, {sig(f'({_determinant(rest)} / {_determinant(m)})')} AS vif FROM r")
    return f"WITH r AS (SELECT {corr} FROM lineitem WHERE {known})\n" + _union(parts)


def _mutual_info() -> str:
    cols = list(dict.fromkeys(list(MI_FEATURES) + list(MI_TARGETS)))
    clean = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    qs = ", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS q_{c}" for c in cols)
    bins = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE len(list_filter(q_{c}, lambda k: {c} > k)) END AS {c}"
                     for c in cols)
    cells = _union([f"SELECT '{f}' AS feature, '{t}' AS target, {f} AS bf, {t} AS bt FROM b "
                    f"WHERE {f} IS NOT NULL AND {t} IS NOT NULL"
                    for f in MI_FEATURES for t in MI_TARGETS])
    term = ("(CAST(nxy AS DOUBLE) / CAST(n AS DOUBLE)) * ln((CAST(nxy AS DOUBLE) / CAST(nx AS DOUBLE)) "
            "* (CAST(n AS DOUBLE) / CAST(ny AS DOUBLE)))")
    return f"""
WITH c AS (SELECT {clean} FROM lineitem),
q AS (SELECT {qs} FROM c),
b AS (SELECT {bins} FROM c, q),
cells AS ({cells}),
ct AS (SELECT feature, target, bf, bt, count(*) AS nxy FROM cells GROUP BY ALL),
n AS (SELECT feature, target, sum(nxy) AS n FROM ct GROUP BY ALL),
nx AS (SELECT feature, target, bf, sum(nxy) AS nx FROM ct GROUP BY ALL),
ny AS (SELECT feature, target, bt, sum(nxy) AS ny FROM ct GROUP BY ALL),
pp AS (SELECT ct.feature, ct.target, sum({term}) AS mi
       FROM ct JOIN n USING (feature, target) JOIN nx USING (feature, target, bf)
       JOIN ny USING (feature, target, bt) GROUP BY ALL)
SELECT feature, {sig('avg(mi)')} AS mi FROM pp GROUP BY feature
"""


_TRIAL_RESULTS = """
  SELECT trial_id, avg(loss) AS value, CAST(count(*) AS BIGINT) AS n_steps,
         CASE first(event_type ORDER BY ts DESC, event_id DESC)
              WHEN 'error' THEN 'FAIL' WHEN 'signup' THEN 'PRUNED' ELSE 'COMPLETE' END AS state
  FROM (SELECT user_id AS trial_id, value AS loss, ts, event_id, event_type FROM events)
  GROUP BY trial_id"""

INTERVAL_SUMMARY = f"""
SELECT user_id AS trial_id, {sig('avg(value)')} AS mean,
       {sig('quantile_cont(value, 0.025)')} AS lower_95, {sig('quantile_cont(value, 0.975)')} AS upper_95
FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY user_id
"""

BEST_TRIAL = f"""
SELECT trial_id, {sig('value')} AS value, n_steps, state FROM ({_TRIAL_RESULTS})
WHERE state = 'COMPLETE' AND value IS NOT NULL ORDER BY value, trial_id LIMIT 1
"""

STATE_COUNTS = f"SELECT state, CAST(count(*) AS BIGINT) AS n FROM ({_TRIAL_RESULTS}) GROUP BY state"

EPOCH_LOSS = f"""
SELECT user_id AS trial_id, CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS BIGINT) AS epoch,
       {sig('avg(value)')} AS loss
FROM events GROUP BY ALL
"""

EARLY_STOP = f"""
WITH m AS (SELECT user_id AS trial_id, -value AS score,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i
           FROM events WHERE value IS NOT NULL),
a AS (SELECT *, max(score) OVER (PARTITION BY trial_id ORDER BY i
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_prev FROM m),
b AS (SELECT *, CASE WHEN best_prev IS NULL OR score >= best_prev THEN i END AS imp FROM a),
c AS (SELECT *, max(imp) OVER (PARTITION BY trial_id ORDER BY i
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_imp FROM b),
stops AS (SELECT trial_id, min(i) AS stop_index, arg_min(-best_prev, i) AS best_at_stop
          FROM c WHERE i - last_imp >= 3 GROUP BY trial_id),
overall AS (SELECT trial_id, -max(score) AS best_end FROM m GROUP BY trial_id)
SELECT o.trial_id, CAST(s.stop_index AS BIGINT) AS stop_index,
       {sig('COALESCE(s.best_at_stop, o.best_end)')} AS best_loss
FROM overall o LEFT JOIN stops s ON o.trial_id = s.trial_id
"""

def _early_stop_recursive(patience: int, delta: float, strict: bool) -> str:
    """The patience rule stated step by step (recursive CTE), an independent check."""
    worse = (f"m.score <= r.best + CAST({delta!r} AS DOUBLE)" if strict
             else f"m.score < r.best + CAST({delta!r} AS DOUBLE)")
    return f"""
WITH RECURSIVE m AS (
  SELECT user_id AS trial_id, -value AS score,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i
  FROM events WHERE value IS NOT NULL),
r(trial_id, i, best, counter) AS (
  SELECT trial_id, i, score, 0 FROM m WHERE i = 0
  UNION ALL
  SELECT m.trial_id, m.i,
         CASE WHEN {worse} THEN r.best ELSE m.score END,
         CASE WHEN {worse} THEN r.counter + 1 ELSE 0 END
  FROM r JOIN m ON m.trial_id = r.trial_id AND m.i = r.i + 1
  WHERE r.counter < {patience}),
stops AS (SELECT trial_id, min(i) AS stop_index FROM r WHERE counter >= {patience} GROUP BY trial_id),
fin AS (SELECT r.trial_id, s.stop_index,
               arg_max(r.best, r.i) FILTER (WHERE s.stop_index IS NULL OR r.i <= s.stop_index) AS best
        FROM r LEFT JOIN stops s ON r.trial_id = s.trial_id GROUP BY r.trial_id, s.stop_index)
SELECT trial_id, CAST(stop_index AS BIGINT) AS stop_index, {sig('-best')} AS best_loss FROM fin
"""


MEDIAN_PRUNE = f"""
WITH m AS (SELECT user_id AS trial_id, value AS v,
                  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS step
           FROM events WHERE value IS NOT NULL),
c AS (SELECT trial_id FROM ({_TRIAL_RESULTS}) WHERE state = 'COMPLETE'),
r AS (SELECT *, min(v) OVER (PARTITION BY trial_id ORDER BY step
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best FROM m),
s AS (SELECT step, quantile_cont(v, 0.5) AS med, count(*) AS k FROM m
      WHERE trial_id IN (SELECT trial_id FROM c) GROUP BY step),
f AS (SELECT r.trial_id, min(r.step) AS pruned_step FROM r JOIN s ON r.step = s.step
      WHERE r.step >= 0 AND s.k >= 1 AND r.best > s.med AND (SELECT count(*) FROM c) >= 5
      GROUP BY r.trial_id)
SELECT t.trial_id, CAST(f.pruned_step AS BIGINT) AS pruned_step
FROM (SELECT DISTINCT trial_id FROM m) t LEFT JOIN f ON t.trial_id = f.trial_id
"""

RESUME = f"""
SELECT c_custkey AS trial_id FROM customer
ANTI JOIN (SELECT trial_id FROM ({_TRIAL_RESULTS}) t WHERE state = 'COMPLETE') e ON c_custkey = e.trial_id
"""


def _pred_sql(target: str) -> str:
    coefs = FIXED_MODEL[target]
    e = f"CAST({coefs['intercept']!r} AS DOUBLE)"
    for f, w in coefs.items():
        if f != "intercept":
            e = f"({e} + CAST({w!r} AS DOUBLE) * {f})"
    return e


def _regression_metrics() -> str:
    parts = []
    for t in FIXED_MODEL:
        p = _pred_sql(t)
        both = f"{t} IS NOT NULL AND ({p}) IS NOT NULL"
        src = (f"(SELECT CASE WHEN {both} THEN CAST({t} AS DOUBLE) END AS y, "
               f"CASE WHEN {both} THEN {p} END AS yhat FROM lineitem)")
        parts.append(f"SELECT '{t}' AS target, CAST(count(y) AS BIGINT) AS n, "
                     f"avg((y - yhat) * (y - yhat)) AS mse, var_pop(y) AS v FROM {src}")
    return (f"SELECT target, n, {sig('mse')} AS mse, {sig('sqrt(mse)')} AS rmse, "
            f"{sig('1 - mse / nullif(v, 0)')} AS r2 FROM ({_union(parts)})")


def _linear_attribution() -> str:
    feats = sorted({f for c in FIXED_MODEL.values() for f in c if f != "intercept"})
    mu = ", ".join(f"avg({f}) AS m_{f}" for f in feats)
    parts = []
    for t, coefs in FIXED_MODEL.items():
        for f in coefs:
            if f == "intercept":
                continue
            parts.append(f"SELECT l_orderkey, l_linenumber, '{t}' AS target, '{f}' AS feature, "
                         f"CAST({coefs[f]!r} AS DOUBLE) * ({f} - m_{f}) AS phi FROM lineitem, mu")
    return f"WITH mu AS (SELECT {mu} FROM lineitem), a AS ({_union(parts)})"


LINEAR_ATTRIBUTION = _linear_attribution() + f"""
SELECT l_orderkey, l_linenumber, target, feature, round(phi, 6) AS phi FROM a
"""

TOPK_FEATURES = _linear_attribution() + f"""
SELECT target, feature, {sig('m')} AS mean_abs_phi, rank FROM (
  SELECT target, feature, m,
         CAST(row_number() OVER (PARTITION BY target ORDER BY m DESC, feature) AS BIGINT) AS rank
  FROM (SELECT target, feature, avg(abs(phi)) AS m FROM a GROUP BY ALL))
WHERE rank <= 10
"""


def _search_space() -> str:
    cols = []
    for name, spec in SEARCH_SPACE.items():
        u = (f"(CAST(('0x' || substr(md5(concat_ws('|', CAST(trial_id AS VARCHAR), '{name}', '11')), 1, 13))"
             f"::BIGINT AS DOUBLE) / {float(16 ** 13)!r})")
        kind = spec[0]
        if kind in ("int", "int_excl"):
            lo, hi = int(spec[1]), int(spec[2]) + (1 if kind == "int" else 0)
            cols.append(f"CAST(floor({u} * {hi - lo}) + {lo} AS BIGINT) AS {name}")
        elif kind == "float":
            lo, hi = float(spec[1]), float(spec[2])
            cols.append(f"{sig(f'CAST({lo!r} AS DOUBLE) + {u} * CAST({hi - lo!r} AS DOUBLE)')} AS {name}")
        elif kind == "logfloat":
            lo, hi = float(spec[1]), float(spec[2])
            e = f"exp(ln(CAST({lo!r} AS DOUBLE)) + {u} * (ln(CAST({hi!r} AS DOUBLE)) - ln(CAST({lo!r} AS DOUBLE))))"
            cols.append(f"{sig(e)} AS {name}")
    return ("SELECT trial_id, " + ", ".join(cols)
            + " FROM (SELECT DISTINCT CAST(user_id AS BIGINT) AS trial_id FROM events)")


SEARCH_SPACE_SQL = _search_space()


def _rate_rankings() -> str:
    parts = [f"SELECT '{g}' AS group_col, CAST({g} AS VARCHAR) AS \"group\", '{t}' AS target, "
             f"CAST({t} AS DOUBLE) AS v FROM t" for g in RANKING_GROUPS for t in RANKING_TARGETS]
    return f"""
WITH t AS ({RATE_WITH_SURVEY}),
long AS ({_union(parts)}),
m AS (SELECT group_col, "group", target, avg(v) AS _mean FROM long
      WHERE "group" IS NOT NULL GROUP BY group_col, "group", target)
SELECT group_col, "group", target, CAST(trunc(_mean) AS BIGINT) AS mean_rate,
       CAST(row_number() OVER (PARTITION BY group_col, target
                               ORDER BY _mean IS NULL, -_mean, "group") AS BIGINT) AS rank
FROM m
"""


SQL: dict[str, str] = {
    "rate_pivot": RATE_PIVOT,
    "rate_with_economy": RATE_WITH_ECONOMY,
    "rate_with_survey": RATE_WITH_SURVEY,
    "rate_rankings": _rate_rankings(),
    "join_key_duplicates": JOIN_KEY_DUPLICATES,
    "recode_priority": RECODE_PRIORITY,
    "prefix_code": PREFIX_CODE,
    "coerce_int": COERCE_INT,
    "top5_nations": TOP5_NATIONS,
    "bottom5_nations": BOTTOM5_NATIONS,
    "rank_segments": RANK_SEGMENTS,
    "missing_summary": MISSING_SUMMARY,
    "describe": DESCRIBE,
    "profile": PROFILE,
    "corr_matrix": _corr_matrix(),
    "cross_corr_by_flag": _cross_corr(None, None),
    "cross_corr_masked": _cross_corr(("A", "R"), 0.01),
    "median_fill": MEDIAN_FILL,
    "mean_fill": MEAN_FILL,
    "cardinality": _cardinality(),
    "distinct_pairs": DISTINCT_PAIRS,
    "union_all": UNION_ALL,
    "standardize": _scaled("z"),
    "unstandardize": _scaled("round"),
    "minmax": _scaled("mm"),
    "ordinal_codes": ORDINAL_CODES,
    "dummies": DUMMIES,
    "holdout": HOLDOUT,
    "kfold": KFOLD,
    "sample_n": SAMPLE_N,
    "first_n": FIRST_N,
    "vif": _vif(),
    "mutual_info": _mutual_info(),
    "interval_summary": INTERVAL_SUMMARY,
    "best_trial": BEST_TRIAL,
    "state_counts": STATE_COUNTS,
    "epoch_loss": EPOCH_LOSS,
    "early_stop": EARLY_STOP,
    "early_stop_strict": _early_stop_recursive(3, 0.0, True),
    "early_stop_delta": _early_stop_recursive(3, EARLY_STOP_DELTA, False),
    "early_stop_tolerant": _early_stop_recursive(3, EARLY_STOP_TOLERANCE, False),
    "median_prune": MEDIAN_PRUNE,
    "resume": RESUME,
    "regression_metrics": _regression_metrics(),
    "linear_attribution": LINEAR_ATTRIBUTION,
    "topk_features": TOPK_FEATURES,
    "search_space": SEARCH_SPACE_SQL,
    "distinct_segments": "SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL",
}
