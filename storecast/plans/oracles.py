"""Independent SQL for the query catalogue, for DuckDB over the driver tables.

Written from the operators' definitions. Every statement carries the common
table expressions it needs, since only the raw tables are views there.
"""

from __future__ import annotations

from ..config import MASTER_REQUIRED

_FRIDAY = "CAST(date_trunc('week', l.l_shipdate) AS DATE) + 4"
_HOLIDAY = f"weekofyear({_FRIDAY}) IN (6, 36, 47, 52)"
_MD = [f"MarkDown{i}" for i in range(1, 6)]


def _sales(store: str) -> str:
    return f"""
  SELECT CAST({store} AS INT) AS Store, CAST(substr(p.p_brand, 7) AS INT) AS Dept,
         {_FRIDAY} AS Date,
         CAST(SUM(CAST(CASE WHEN l.l_returnflag = 'R' AND l.l_quantity <= 1
                            THEN -l.l_extendedprice
                            ELSE l.l_extendedprice * (1 - l.l_discount) END
                       AS DECIMAL(18,4))) AS DOUBLE) AS Weekly_Sales,
         {_HOLIDAY} AS IsHoliday
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
  GROUP BY {store}, CAST(substr(p.p_brand, 7) AS INT), {_FRIDAY}"""


_MARKDOWN_SUMS = ",\n         ".join(
    f"CAST(SUM(CASE WHEN o.o_orderpriority LIKE '{i}%' THEN "
    f"CAST(l.l_extendedprice * l.l_discount AS DECIMAL(18,4)) END) AS DOUBLE) AS MarkDown{i}"
    for i in range(1, 6))

_MD_ZERO = ", ".join(f"coalesce({c}, 0) AS {c}" for c in _MD)
_MD_COUNT = " + ".join(f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END" for c in _MD)
_MD_SUM = " + ".join(f"coalesce({c}, 0)" for c in _MD)
_BAND = ("CASE WHEN Temperature IS NULL THEN 'Unknown' WHEN Temperature <= 32 THEN 'Freezing' "
         "WHEN Temperature <= 52 THEN 'Cold' WHEN Temperature <= 78 THEN 'Moderate' "
         "ELSE 'Hot' END")
_YMW = ("CAST(year(Date) AS INT) AS Year, CAST(month(Date) AS INT) AS Month, "
        "CAST(weekofyear(Date) AS INT) AS Week")


def _weeks(source: str) -> str:
    return f"""
  SELECT g.Store, g.Date, coalesce(w.y, 0) AS y
  FROM (SELECT Store, CAST(unnest(generate_series(min(Date), max(Date), INTERVAL 7 DAY)) AS DATE)
               AS Date FROM {source} GROUP BY Store) g
  LEFT JOIN (SELECT Store, Date, sum(Weekly_Sales) AS y FROM {source} GROUP BY Store, Date) w
    ON w.Store = g.Store AND w.Date = g.Date"""


# name -> (names it needs, body)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "sales": ((), _sales("s.s_nationkey")),
    "sales_sup": ((), _sales("s.s_suppkey")),
    "stores": ((), """
  SELECT n_nationkey AS Store,
         CASE WHEN n_regionkey <= 1 THEN 'A' WHEN n_regionkey <= 3 THEN 'B' ELSE 'C' END AS Type,
         30000 + 7000 * n_nationkey AS Size
  FROM nation"""),
    "features": ((), f"""
  SELECT s.s_nationkey AS Store, {_FRIDAY} AS Date,
         CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*) * 2 AS Temperature,
         2 + CAST(SUM(CAST(l.l_tax AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*) * 20 AS Fuel_Price,
         {_MARKDOWN_SUMS},
         CASE WHEN (weekofyear({_FRIDAY}) + s.s_nationkey) % 5 = 0 THEN NULL
              ELSE 200 + CAST(COUNT(*) AS DOUBLE) / 10 END AS CPI,
         CASE WHEN (weekofyear({_FRIDAY}) + s.s_nationkey) % 7 = 0 THEN NULL
              ELSE 5 + CAST(s.s_nationkey * 7 % 10 AS DOUBLE) / 2 END AS Unemployment,
         {_HOLIDAY} AS IsHoliday
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey GROUP BY s.s_nationkey, {_FRIDAY}"""),
    "lines": ((), f"""
  SELECT s.s_nationkey AS Store, CAST(substr(p.p_brand, 7) AS INT) AS Dept, {_FRIDAY} AS Date,
         l.l_extendedprice AS Weekly_Sales
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey"""),
    "kept": (("sales",), "SELECT * FROM sales WHERE Weekly_Sales IS NULL OR Weekly_Sales >= 0"),
    "kept_sup": (("sales_sup",),
                 "SELECT * FROM sales_sup WHERE Weekly_Sales IS NULL OR Weekly_Sales >= 0"),
    "lagged": (("kept",), """
  SELECT *, coalesce(lag(Weekly_Sales) OVER (PARTITION BY Store, Dept ORDER BY Date), 0)
         AS Sales_Lag_1 FROM kept"""),
    "flagged": (("lagged",), """
  SELECT *, coalesce(abs(Sales_ZScore) > 3, false) AS Is_Anomaly FROM (
    SELECT *, (Weekly_Sales - avg(Weekly_Sales) OVER (PARTITION BY Store, Dept))
              / (stddev_samp(Weekly_Sales) OVER (PARTITION BY Store, Dept) + 1e-9) AS Sales_ZScore
    FROM lagged)"""),
    "features_filled": (("features",), f"""
  SELECT Store, Date, IsHoliday, Temperature, Fuel_Price, {', '.join(_MD)},
         last_value(CPI IGNORE NULLS) OVER w AS CPI,
         last_value(Unemployment IGNORE NULLS) OVER w AS Unemployment
  FROM features WINDOW w AS (PARTITION BY Store ORDER BY Date
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "master": (("flagged", "stores", "features_filled"), f"""
  SELECT k.*, st.Type, st.Size, f.Temperature, f.Fuel_Price,
         {', '.join(f'coalesce(f.{c}, 0) AS {c}' for c in _MD)}, f.CPI, f.Unemployment
  FROM flagged k LEFT JOIN stores st ON st.Store = k.Store
  LEFT JOIN features_filled f
    ON f.Store = k.Store AND f.Date = k.Date AND f.IsHoliday = k.IsHoliday"""),
    "master_input": (("kept", "features"), """
  SELECT k.Store, k.Dept, k.Date,
         last_value(f.CPI IGNORE NULLS) OVER w AS CPI,
         last_value(f.Unemployment IGNORE NULLS) OVER w AS Unemployment
  FROM kept k LEFT JOIN features f
    ON f.Store = k.Store AND f.Date = k.Date AND f.IsHoliday = k.IsHoliday
  WINDOW w AS (PARTITION BY k.Store ORDER BY k.Dept, k.Date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "engineered": (("master",), f"""
  SELECT *, {_YMW}, {_BAND} AS Temp_Category, CAST({_MD_COUNT} AS INT) AS MD_Count,
         {_MD_SUM} AS Total_MD_Value FROM master"""),
    "profiles": (("engineered",), """
  SELECT Store, avg(Weekly_Sales) AS Weekly_Sales, min(Size) AS Size,
         avg(Total_MD_Value) AS Total_MD_Value, avg(Unemployment) AS Unemployment
  FROM engineered GROUP BY Store"""),
    "segments": (("stores",), "SELECT Store, CAST(floor(Size / 50000) AS INT) AS Cluster FROM stores"),
    "ruled": (("profiles",), "SELECT *, CAST(floor(Size / 50000) AS INT) AS Cluster FROM profiles"),
    "long_profile": (("profiles",), """
  SELECT 'Weekly_Sales' AS column_name, Weekly_Sales AS x FROM profiles
  UNION ALL SELECT 'Size', CAST(Size AS DOUBLE) FROM profiles
  UNION ALL SELECT 'Total_MD_Value', Total_MD_Value FROM profiles
  UNION ALL SELECT 'Unemployment', Unemployment FROM profiles"""),
    "store_weeks": (("sales",), _weeks("sales")),
    "supplier_weeks": (("sales_sup",), _weeks("sales_sup")),
    "store_items": (("sales",), """
  SELECT DISTINCT CAST(Store AS VARCHAR) || '|' || CAST(Date AS VARCHAR) AS basket,
         CAST(Dept AS VARCHAR) AS item FROM sales"""),
    "order_items": ((), """
  SELECT DISTINCT CAST(l.l_orderkey AS VARCHAR) AS basket, substr(p.p_brand, 7) AS item
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey"""),
    "holdout": (("lagged",), """
  SELECT t.*, m.series_mean FROM (SELECT * FROM lagged WHERE Date >= DATE '2000-01-01') t
  LEFT JOIN (SELECT Store, Dept, avg(Weekly_Sales) AS series_mean FROM lagged
             WHERE Date < DATE '2000-01-01' GROUP BY Store, Dept) m
    ON m.Store = t.Store AND m.Dept = t.Dept"""),
}


def _with(body: str, *names: str, extra: str = "") -> str:
    ordered: list[str] = []

    def need(name: str) -> None:
        for dep in _CTES[name][0]:
            need(dep)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        need(n)
    parts = [f"{n} AS ({_CTES[n][1]})" for n in ordered]
    if extra:
        parts.append(extra)
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body


_DATE = "CAST(Date AS VARCHAR) AS Date"
_KEY = f"Store, Dept, {_DATE}"
_WS = "round(Weekly_Sales, 4) AS Weekly_Sales"


def _mean(expr: str) -> str:
    """A mean of four-decimal amounts, kept off the exact halves of rounding."""
    return f"round({expr} + 1.3e-6, 4)"


def _flags(source: str) -> str:
    return f"SELECT {_KEY}, {_WS}, round(Sales_ZScore, 4) AS Sales_ZScore, Is_Anomaly FROM {source}"


def _metric_columns(y: str, f: str) -> str:
    e = f"({y} - {f})"
    return f"""count(*) AS n,
       round(1 - sum({e} * {e}) / (var_pop({y}) * count(*)), 6) AS r2,
       round(avg(abs({e})), 4) AS mae, round(sqrt(avg({e} * {e})), 4) AS rmse,
       round(avg(abs({e}) / greatest(abs({y}), 1e-9)) * 100, 4) AS mape"""


# ---- itemsets ------------------------------------------------------------

_ITEMSETS = """total AS (SELECT count(DISTINCT basket) AS n FROM {src}),
  k1 AS (SELECT item AS a, count(*) AS n FROM {src} GROUP BY item
         HAVING count(*) >= 0.011 * (SELECT n FROM total)),
  live AS (SELECT * FROM {src} WHERE item IN (SELECT a FROM k1)),
  k2 AS (SELECT x.item AS a, y.item AS b, count(*) AS n FROM live x
         JOIN live y ON x.basket = y.basket AND x.item < y.item GROUP BY x.item, y.item
         HAVING count(*) >= 0.011 * (SELECT n FROM total)),
  k3 AS (SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS n FROM live x
         JOIN live y ON x.basket = y.basket AND x.item < y.item
         JOIN live z ON x.basket = z.basket AND y.item < z.item
         GROUP BY x.item, y.item, z.item
         HAVING count(*) >= 0.011 * (SELECT n FROM total)),
  sets AS (SELECT a AS items, 1 AS size, n FROM k1
           UNION ALL SELECT a || ',' || b, 2, n FROM k2
           UNION ALL SELECT a || ',' || b || ',' || c, 3, n FROM k3),
  scored AS (SELECT items, CAST(size AS INT) AS size, n,
                    CAST(n AS DOUBLE) / (SELECT n FROM total) AS support FROM sets)"""

_SPLITS2 = """SELECT a AS l, b AS r, a || ',' || b AS whole FROM k2
           UNION ALL SELECT b, a, a || ',' || b FROM k2"""
_SPLITS3 = _SPLITS2 + "".join(f"""
           UNION ALL SELECT {left}, {right}, a || ',' || b || ',' || c FROM k3"""
                              for left, right in (
    ("a", "b || ',' || c"), ("b", "a || ',' || c"), ("c", "a || ',' || b"),
    ("b || ',' || c", "a"), ("a || ',' || c", "b"), ("a || ',' || b", "c")))


def _itemsets(source: str, size: int | None) -> str:
    where = f" WHERE size = {size}" if size else ""
    return _with(f"SELECT items, size, n, round(support, 8) AS support FROM scored{where}",
                 source, extra=_ITEMSETS.format(src=source))


def _rules(source: str, splits: str) -> str:
    extra = _ITEMSETS.format(src=source) + f""",
  splits AS ({splits})"""
    return _with("""SELECT antecedents, consequents, round(support, 8) AS support,
       round(confidence, 8) AS confidence, round(lift, 8) AS lift FROM (
  SELECT s.l AS antecedents, s.r AS consequents, w.support AS support,
         w.support / a.support AS confidence, (w.support / a.support) / c.support AS lift
  FROM splits s JOIN scored w ON w.items = s.whole JOIN scored a ON a.items = s.l
  JOIN scored c ON c.items = s.r)
WHERE confidence >= 0.1 AND lift >= 1.0""", source, extra=extra)


_CLOSED_SIZES = range(2, 9)


def _closed(body: str) -> str:
    """Itemsets up to eight items, level by level over the rows that hold them; closed are those
    that none of one more item matches in count."""
    levels = ["""total AS (SELECT count(DISTINCT basket) AS n FROM store_items),
  f1 AS (SELECT [item] AS items, item AS last, count(*) AS n FROM store_items GROUP BY item
         HAVING count(*) >= 0.011 * (SELECT n FROM total)),
  live AS (SELECT * FROM store_items WHERE item IN (SELECT last FROM f1)),
  r1 AS (SELECT basket, [item] AS items, item AS last FROM live)"""]
    for k in _CLOSED_SIZES:
        levels.append(f"""
  g{k} AS (SELECT r.basket, list_append(r.items, l.item) AS items, l.item AS last
           FROM r{k - 1} r JOIN live l ON l.basket = r.basket AND l.item > r.last),
  f{k} AS (SELECT items, count(*) AS n FROM g{k} GROUP BY items
           HAVING count(*) >= 0.011 * (SELECT n FROM total)),
  r{k} AS (SELECT g.* FROM g{k} g JOIN f{k} f ON f.items = g.items)""")
    every = " UNION ALL ".join([f"SELECT items, n, {k} AS size FROM f{k}" for k in (1, *_CLOSED_SIZES)])
    levels.append(f"""
  every_set AS ({every}),
  smaller AS (SELECT list_filter(e.items, lambda y: y <> u.x) AS items, e.n
              FROM every_set e, unnest(e.items) AS u(x) WHERE e.size > 1),
  shut AS (SELECT e.items, e.size, e.n, CAST(e.n AS DOUBLE) / (SELECT n FROM total) AS support
           FROM every_set e WHERE NOT EXISTS (SELECT 1 FROM smaller s WHERE s.items = e.items AND s.n = e.n))""")
    return _with(body, "store_items", extra=",".join(levels))


def _kpss(levels: str) -> str:
    """CTEs of the KPSS statistic of each (Store, kind) of `levels`, which has t and v."""
    return f"""dev AS (SELECT Store, kind, t, v - avg(v) OVER g AS e, count(*) OVER g AS n,
         least(floor(4 * pow(count(*) OVER g / 100.0, 0.25)), count(*) OVER g - 1) AS lags
         FROM {levels} WINDOW g AS (PARTITION BY Store, kind)),
  partial AS (SELECT *, sum(e) OVER (PARTITION BY Store, kind ORDER BY t) AS s FROM dev),
  near AS (SELECT a.Store, a.kind, sum((1 - (a.t - b.t) / (a.lags + 1)) * a.e * b.e) AS c
           FROM dev a JOIN dev b ON b.Store = a.Store AND b.kind = a.kind AND b.t BETWEEN a.t - a.lags AND a.t - 1
           GROUP BY a.Store, a.kind),
  stat AS (SELECT p.Store, p.kind, sum(s * s) / (max(n) * (sum(e * e) + 2 * max(c))) AS kpss
           FROM partial p JOIN near USING (Store, kind) GROUP BY p.Store, p.kind)"""


def _unit_roots() -> str:
    return _with("""
SELECT c.Store, c.n, round(c.strength, 6) AS strength, round(x.kpss, 6) AS kpss, round(y.kpss, 6) AS kpss_diff,
       c.sd, CAST(CASE WHEN x.kpss <= 0.463 THEN 0 WHEN y.kpss <= 0.463 THEN 1 ELSE 2 END AS INT) AS d
FROM chosen c JOIN stat x ON x.Store = c.Store AND x.kind = 0 JOIN stat y ON y.Store = c.Store AND y.kind = 1""",
                 "store_weeks", extra="""
  base AS (SELECT Store, y, row_number() OVER w - 1 AS t, count(*) OVER (PARTITION BY Store) AS n,
           lag(y, 52) OVER w AS back, y - (sum(y) OVER (PARTITION BY Store ORDER BY Date ROWS BETWEEN 25 PRECEDING AND 25 FOLLOWING)
                + (lag(y, 26) OVER w + lead(y, 26) OVER w) / 2) / 52 AS x
           FROM store_weeks WINDOW w AS (PARTITION BY Store ORDER BY Date)),
  rest AS (SELECT Store, x, x - avg(x) OVER (PARTITION BY Store, t % 52) AS r FROM base WHERE x IS NOT NULL),
  strong AS (SELECT Store, greatest(0, 1 - (sum(r * r) / (count(*) - 52)) / var_samp(x)) AS strength FROM rest GROUP BY Store),
  chosen AS (SELECT Store, n, CASE WHEN n >= 156 THEN coalesce(strength, 0) ELSE 0 END AS strength,
             CAST(CASE WHEN n >= 156 AND strength > 0.64 THEN 1 ELSE 0 END AS INT) AS sd
             FROM (SELECT Store, count(*) AS n FROM base GROUP BY Store) LEFT JOIN strong USING (Store)),
  level AS (SELECT b.Store, b.t, CASE WHEN sd = 1 THEN b.y - b.back ELSE b.y END AS v FROM base b JOIN chosen USING (Store)),
  levels AS (SELECT Store, 0 AS kind, t, v FROM level WHERE v IS NOT NULL UNION ALL
             SELECT Store, 1, t, v FROM (SELECT Store, t, v - lag(v) OVER (PARTITION BY Store ORDER BY t) AS v FROM level)
             WHERE v IS NOT NULL),
  """ + _kpss("levels"))


def _histogram() -> str:
    parts = []
    for c in ("Temperature", "Fuel_Price", "CPI", "Unemployment"):
        parts.append(f"""SELECT '{c}' AS column_name, {c} AS x, b.lo AS lo, b.w AS w FROM features,
  (SELECT min({c}) AS lo, CASE WHEN max({c}) > min({c}) THEN (max({c}) - min({c})) / 20
          ELSE 1 END AS w FROM features) b WHERE {c} IS NOT NULL""")
    return _with(f"""SELECT column_name, bin, round(lo + bin * w, 6) AS lower,
       round(lo + (bin + 1) * w, 6) AS upper, count(*) AS n
FROM (SELECT column_name, lo, w, CAST(least(floor((x - lo) / w), 19) AS INT) AS bin
      FROM ({' UNION ALL '.join(parts)}))
GROUP BY column_name, bin, lo, w""", "features")


def _drift() -> str:
    parts = []
    for c in ("CPI", "Unemployment"):
        parts.append(f"""
SELECT '{c}' AS column_name,
       round((SELECT avg({c}) FROM ref), 6) AS ref_mean, round((SELECT avg({c}) FROM cur), 6)
       AS cur_mean, round((SELECT stddev_samp({c}) FROM ref), 6) AS ref_sd,
       round((SELECT stddev_samp({c}) FROM cur), 6) AS cur_sd,
       round(sum((q - p) * ln(q / p)), 6) AS psi
FROM (SELECT b.bin,
        greatest((SELECT count(*) FROM ref, (SELECT min({c}) AS lo, max({c}) AS hi FROM ref)
                  WHERE {c} IS NOT NULL AND greatest(0, least(9, floor(({c} - lo) / ((hi - lo) / 10))))
                  = b.bin) / (SELECT CAST(count({c}) AS DOUBLE) FROM ref), 1e-6) AS p,
        greatest((SELECT count(*) FROM cur, (SELECT min({c}) AS lo, max({c}) AS hi FROM ref)
                  WHERE {c} IS NOT NULL AND greatest(0, least(9, floor(({c} - lo) / ((hi - lo) / 10))))
                  = b.bin) / (SELECT CAST(count({c}) AS DOUBLE) FROM cur), 1e-6) AS q
      FROM (SELECT unnest(range(10)) AS bin) b)""")
    return _with(" UNION ALL ".join(parts), "features", extra="""ref AS (
  SELECT * FROM features WHERE Date < DATE '2000-01-01'), cur AS (
  SELECT * FROM features WHERE Date >= DATE '2000-01-01')""")


_FEATURE_COLUMNS = ("Store", "Date", "Temperature", "Fuel_Price", *_MD, "CPI", "Unemployment",
                    "IsHoliday")
_FEATURE_TYPES = {"Store": "int", "Date": "date", "IsHoliday": "boolean"}


def _profile() -> str:
    return _with(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{_FEATURE_TYPES.get(c, 'double')}' AS data_type, "
        f"count(*) AS n_rows, count({c}) AS n_present FROM features"
        for c in _FEATURE_COLUMNS), "features")


def _null_rates() -> str:
    columns = ("Store", "Dept", "Date", "Weekly_Sales", "Type", "Size", "Temperature", "CPI",
               "Unemployment")
    return _with(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(CAST(count(*) - count({c}) AS DOUBLE) / count(*), 8) "
        f"AS null_share FROM raw" for c in columns), "sales", "stores", "features", extra="""
raw AS (SELECT s.*, st.Type, st.Size, f.Temperature, f.CPI, f.Unemployment FROM sales s
  LEFT JOIN stores st ON st.Store = s.Store LEFT JOIN features f
  ON f.Store = s.Store AND f.Date = s.Date AND f.IsHoliday = s.IsHoliday)""")


def _check(table: str, check: str, passed: str, severity: str = "error") -> str:
    return (f"SELECT '{table}' AS table_name, '{check}' AS \"check\", ({passed}) AS passed, "
            f"'{severity}' AS severity")


def _unique(table: str, keys: str) -> str:
    return f"SELECT count(*) = 0 FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING count(*) > 1)"


_VALIDATE = " UNION ALL ".join([
    *[_check(t, "schema", "true") for t in ("sales", "stores", "features")],
    _check("stores", "min_rows", "SELECT count(*) >= 10 FROM stores"),
    _check("sales", "min_rows", "SELECT count(*) >= 5000 FROM sales"),
    _check("sales", "unique_key", _unique("sales", "Store, Dept, Date")),
    _check("sales", "key_nulls", "SELECT count(*) = 0 FROM sales WHERE Store IS NULL OR "
           "Dept IS NULL OR Date IS NULL", "warn"),
    _check("stores", "unique_key", _unique("stores", "Store")),
    _check("stores", "key_nulls", "SELECT count(*) = 0 FROM stores WHERE Store IS NULL", "warn"),
    _check("features", "key_nulls", "SELECT count(*) = 0 FROM features WHERE Store IS NULL OR "
           "Date IS NULL OR IsHoliday IS NULL", "warn"),
    _check("features", "unique_key", _unique("features", "Store, Date, IsHoliday")),
    _check("sales", "orphans", "SELECT count(*) = 0 FROM sales WHERE Store NOT IN "
           "(SELECT Store FROM stores)"),
    _check("sales", "negative_share", "SELECT avg(CASE WHEN Weekly_Sales < 0 THEN 1.0 ELSE 0.0 "
           "END) <= 0.01 FROM sales", "warn"),
])


def _naive(source: str) -> str:
    back = f"lag(y, 52) OVER (PARTITION BY Store ORDER BY {source}.Date)"
    return _with(f"SELECT Store, {_DATE}, round(y, 4) AS y, round({back}, 4) AS seasonal_naive, "
                 f"round(y - {back}, 4) AS seasonal_diff FROM {source}", source)


_FEATURE_VALUES = (f"round(Temperature, 6) AS Temperature, round(Fuel_Price, 6) AS Fuel_Price, "
                   f"{', '.join(_MD)}, round(CPI, 6) AS CPI, Unemployment, IsHoliday")

_YJ = {"Weekly_Sales": "(pow(Weekly_Sales + 1, 0.5) - 1) / 0.5", "Size": "ln(Size + 1)",
       "Total_MD_Value": "(pow(Total_MD_Value + 1, 0.25) - 1) / 0.25",
       "Unemployment": "(pow(Unemployment + 1, -1.0) - 1) / -1.0"}

ORACLES: dict[str, str] = {
    "load_sales": _with(f"SELECT {_KEY}, Weekly_Sales, IsHoliday FROM sales", "sales"),
    "load_stores": _with("SELECT * FROM stores", "stores"),
    "load_features": _with(f"SELECT Store, {_DATE}, {_FEATURE_VALUES} FROM features", "features"),
    "parse_bool": """
SELECT token, parsed, count(*) AS n FROM (
  SELECT CASE o_orderkey % 10 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' yes ' WHEN 2 THEN '1'
              WHEN 3 THEN 't' WHEN 4 THEN '0' WHEN 5 THEN '' WHEN 6 THEN NULL
              WHEN 7 THEN 'False' WHEN 8 THEN 'no' ELSE o_orderpriority END AS token,
         o_orderkey % 10 <= 3 AS parsed FROM orders) GROUP BY token, parsed""",
    "parse_dates": """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, count(*) AS n
FROM orders GROUP BY 1""",
    "dq_schema": _with(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'schema' AS \"check\", true AS passed, "
        f"CAST(0 AS DOUBLE) AS observed, '{t} has all its columns; rows: ' || format('{{:,}}', count(*)) "
        f"AS message FROM {t}" for t in ("sales", "stores", "features")),
        "sales", "stores", "features"),
    "dq_row_counts": _with(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'min_rows' AS \"check\", count(*) >= {m} AS passed, "
        f"CAST(count(*) AS DOUBLE) AS observed, CAST({m} AS DOUBLE) AS \"limit\" FROM {t}"
        for t, m in (("stores", 10), ("sales", 5000))), "sales", "stores"),
    "dq_duplicates": _with("""
SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS duplicate_rows,
       CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS extra_rows, count(*) AS duplicate_keys
FROM (SELECT count(*) AS c FROM lines GROUP BY Store, Dept, Date HAVING count(*) > 1)""", "lines"),
    "dq_orphans": _with("""
SELECT 'orphans' AS "check", count(DISTINCT Store) = 0 AS passed,
       CAST(count(DISTINCT Store) AS DOUBLE) AS observed FROM sales_sup
WHERE Store NOT IN (SELECT Store FROM stores)""", "sales_sup", "stores"),
    "dq_negative_share": _with("""
SELECT count(*) AS n_rows, count(*) FILTER (Weekly_Sales < 0) AS n_negative,
       round(CAST(count(*) FILTER (Weekly_Sales < 0) AS DOUBLE) / count(*), 8) AS negative_share
FROM sales""", "sales"),
    "dq_null_rates": _null_rates(),
    "validate": _with(_VALIDATE, "sales", "stores", "features"),
    "freshness": _with("""
SELECT table_name, CAST(newest AS VARCHAR) AS newest,
       CAST(datediff('day', newest, max(newest) OVER ()) AS INT) AS age_days,
       datediff('day', newest, max(newest) OVER ()) > 7 AS stale
FROM (SELECT 'sales' AS table_name, max(Date) AS newest FROM sales
      UNION ALL SELECT 'features', max(Date) FROM features
      UNION ALL SELECT 'orders', max(CAST(o_orderdate AS DATE)) FROM orders)""",
                       "sales", "features"),
    "dedupe_sales": _with(f"SELECT {_KEY}, max(Weekly_Sales) AS Weekly_Sales FROM lines "
                          "GROUP BY Store, Dept, Date", "lines"),
    "clean_negative_sales": _with(f"SELECT {_KEY}, {_WS}, IsHoliday FROM kept", "kept"),
    "impute_markdowns": _with(
        f"SELECT Store, {_DATE}, {', '.join(f'round(coalesce({c}, 0), 4) AS {c}' for c in _MD)} "
        "FROM features", "features"),
    "ffill_macro": _with(f"SELECT {_KEY}, round(CPI, 6) AS CPI, round(Unemployment, 6) "
                         "AS Unemployment FROM master_input", "master_input"),
    "ffill_macro_chrono": _with(f"SELECT {_KEY}, round(CPI, 6) AS CPI, round(Unemployment, 6) "
                                "AS Unemployment FROM master", "master"),
    "split_train": _with(f"SELECT {_KEY}, {_WS}, IsHoliday FROM sales "
                         "WHERE Date < DATE '2000-01-01'", "sales"),
    "split_test": _with(f"SELECT {_KEY}, {_WS}, IsHoliday FROM sales "
                        "WHERE Date >= DATE '2000-01-01'", "sales"),
    "join_stores": _with("SELECT s.Store, s.Dept, CAST(s.Date AS VARCHAR) AS Date, "
                         "round(s.Weekly_Sales, 4) AS Weekly_Sales, s.IsHoliday, st.Type, st.Size "
                         "FROM sales s LEFT JOIN stores st ON st.Store = s.Store",
                         "sales", "stores"),
    "build_master": _with(
        f"SELECT {_KEY}, {_WS}, IsHoliday, Type, Size, round(Temperature, 6) AS Temperature, "
        f"round(Fuel_Price, 6) AS Fuel_Price, {', '.join(f'round({c}, 4) AS {c}' for c in _MD)}, "
        "round(CPI, 6) AS CPI, round(Unemployment, 6) AS Unemployment FROM master", "master"),
    "temporal_features": _with(f"SELECT {_KEY}, {_YMW} FROM sales", "sales"),
    "temp_bands": _with(f"SELECT Store, {_DATE}, round(Temperature, 6) AS Temperature, "
                        f"{_BAND} AS Temp_Category FROM features", "features"),
    "markdown_signals": _with(f"SELECT Store, {_DATE}, CAST({_MD_COUNT} AS INT) AS MD_Count, "
                              f"round({_MD_SUM}, 4) AS Total_MD_Value FROM features", "features"),
    "sales_lag": _with(f"SELECT {_KEY}, {_WS}, IsHoliday, round(Sales_Lag_1, 4) AS Sales_Lag_1 "
                       "FROM lagged", "lagged"),
    "engineered_master": _with(
        f"SELECT {_KEY}, {_WS}, Type, Size, Year, Month, Week, Temp_Category, "
        "round(Sales_Lag_1, 4) AS Sales_Lag_1, MD_Count, round(Total_MD_Value, 4) AS "
        "Total_MD_Value, round(CPI, 6) AS CPI, round(Sales_ZScore, 4) AS Sales_ZScore, "
        "Is_Anomaly FROM engineered", "engineered"),
    "encode_type": _with("SELECT Store, Type, Size, CAST(dense_rank() OVER (ORDER BY Type) - 1 "
                         "AS INT) AS Type_Encoded FROM stores", "stores"),
    "flag_anomalies": _with(_flags("flagged"), "flagged"),
    "anomaly_summary": _with("""
SELECT count(*) FILTER (Is_Anomaly) AS total_anomalies,
       round(CAST(count(*) FILTER (Is_Anomaly) AS DOUBLE) / count(*), 8) AS anomaly_rate,
       round(coalesce(CAST(count(*) FILTER (Is_Anomaly AND IsHoliday) AS DOUBLE)
                      / nullif(count(*) FILTER (Is_Anomaly), 0), 0), 8)
       AS holiday_share_among_anomalies FROM flagged""", "flagged"),
    "anomaly_drilldown": _with(f"SELECT {_DATE}, {_WS}, round(Sales_ZScore, 4) AS Sales_ZScore, "
                               "Is_Anomaly FROM flagged WHERE Store = 1 AND Dept = 1", "flagged"),
    "anomaly_triage": _with("""
SELECT CAST(Date AS VARCHAR) AS Date, n_rows, n_anomalies,
       round(CAST(n_anomalies AS DOUBLE) / n_rows, 8) AS anomaly_rate,
       round(CAST(n_hol AS DOUBLE) / nullif(n_anomalies, 0), 8) AS holiday_share,
       CASE WHEN n_anomalies = 0 THEN 'none' WHEN 2 * n_hol >= n_anomalies THEN 'calendar_event'
            ELSE 'suspect_data' END AS verdict
FROM (SELECT Date, count(*) AS n_rows, count(*) FILTER (Is_Anomaly) AS n_anomalies,
             count(*) FILTER (Is_Anomaly AND IsHoliday) AS n_hol FROM flagged GROUP BY Date)""",
                            "flagged"),
    "store_ranking": _with(f"SELECT Store, {_mean('avg(Weekly_Sales)')} AS avg_sales FROM kept "
                           "GROUP BY Store", "kept"),
    "seasonality": _with(f"SELECT Year, Week, {_mean('avg(Weekly_Sales)')} AS avg_sales FROM "
                         f"(SELECT *, {_YMW} FROM kept) GROUP BY Year, Week", "kept"),
    "seasonality_wide": _with(f"""
SELECT w.Week, y.Year, {_mean('m.m')} AS avg_sales
FROM (SELECT DISTINCT Week FROM dated) w CROSS JOIN (SELECT DISTINCT Year FROM dated) y
LEFT JOIN (SELECT Week, Year, avg(Weekly_Sales) AS m FROM dated GROUP BY Week, Year) m
  ON m.Week = w.Week AND m.Year = y.Year""", "kept", extra=f"dated AS (SELECT *, {_YMW} FROM kept)"),
    "macro_histogram": _histogram(),
    "holiday_lift": _with(f"""
SELECT Week, {_mean('avg(Weekly_Sales) FILTER (IsHoliday)')} AS holiday_avg,
       {_mean('avg(Weekly_Sales) FILTER (NOT IsHoliday)')} AS regular_avg,
       count(Weekly_Sales) FILTER (IsHoliday) AS n_holiday,
       count(Weekly_Sales) FILTER (NOT IsHoliday) AS n_regular,
       round(avg(Weekly_Sales) FILTER (IsHoliday)
             / (SELECT avg(Weekly_Sales) FROM kept WHERE NOT IsHoliday), 6) AS lift
FROM (SELECT *, CAST(weekofyear(Date) AS INT) AS Week FROM kept) GROUP BY Week""", "kept"),
    "holiday_effect": _with(f"""
SELECT Week, IsHoliday, {_mean('avg(Weekly_Sales)')} AS avg_sales, count(Weekly_Sales) AS n,
       round(stddev_samp(Weekly_Sales), 4) AS sd_sales
FROM (SELECT *, CAST(weekofyear(Date) AS INT) AS Week FROM kept) GROUP BY Week, IsHoliday""",
                            "kept"),
    "run_summary": _with("""
SELECT count(*) AS n_rows, count(DISTINCT Store) AS n_stores, count(DISTINCT Dept) AS n_depts,
       count(DISTINCT Date) AS n_weeks, count(*) FILTER (Is_Anomaly) AS n_anomalies
FROM flagged""", "flagged"),
    "table_profile": _profile(),
    "store_profiles": _with(f"SELECT Store, {_mean('Weekly_Sales')} AS Weekly_Sales, Size, "
                            f"{_mean('Total_MD_Value')} AS Total_MD_Value, round(Unemployment, 6) "
                            "AS Unemployment FROM profiles", "profiles"),
    "segment_summary": _with("""
SELECT Cluster, count(Store) AS store_count, round_even(avg(Weekly_Sales), 2) AS avg_weekly_sales,
       round_even(avg(Size), 2) AS avg_size, round_even(avg(Unemployment), 2) AS avg_unemployment
FROM ruled GROUP BY Cluster""", "ruled"),
    "attach_segments": _with("SELECT k.Store, k.Dept, CAST(k.Date AS VARCHAR) AS Date, "
                             "round(k.Weekly_Sales, 4) AS Weekly_Sales, k.IsHoliday, g.Cluster "
                             "FROM kept k LEFT JOIN segments g ON g.Store = k.Store",
                             "kept", "segments"),
    "yeo_johnson_lambda": _with("""
SELECT column_name, lam, round(ll, 4) AS loglik FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY ll DESC, lam) AS r FROM (
    SELECT column_name, lam,
           -count(*) / 2.0 * ln(var_pop(CASE WHEN lam = 0 THEN ln(x + 1)
                                             ELSE pow(x + 1, lam) / lam END))
           + (lam - 1) * sum(sign(x) * ln(1 + abs(x))) AS ll
    FROM long_profile, (SELECT -3 + 0.25::DOUBLE * unnest(range(25)) AS lam)
    GROUP BY column_name, lam)) WHERE r = 1""", "long_profile"),
    "yeo_johnson": _with(f"SELECT Store, {', '.join(f'round({e}, 6) AS {c}' for c, e in _YJ.items())}"
                         " FROM profiles", "profiles"),
    "standardize": _with("SELECT Store, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in _YJ)
        + " FROM profiles", "profiles"),
    "wcss": _with("""
SELECT r.Cluster, count(*) AS n,
       round(sum(pow(r.Weekly_Sales - m.a, 2) + pow(r.Total_MD_Value - m.b, 2)), 1) AS inertia
FROM ruled r JOIN (SELECT Cluster, avg(Weekly_Sales) AS a, avg(Total_MD_Value) AS b FROM ruled
                   GROUP BY Cluster) m ON m.Cluster = r.Cluster GROUP BY r.Cluster""", "ruled"),
    "silhouette": _with("""
SELECT round(avg(CASE WHEN n_own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette,
       count(*) AS n_points, CAST(max(k) AS INT) AS n_clusters, 'euclidean' AS metric
FROM (SELECT i, max(n_own) AS n_own, max(CASE WHEN own THEN total / nullif(n_own - 1, 0) END) AS a,
             min(CASE WHEN NOT own THEN total / n END) AS b, max(k) AS k
      FROM (SELECT p.Store AS i, q.Cluster = p.Cluster AS own, count(*) AS n,
                   sum(sqrt(pow(p.Weekly_Sales / 1000 - q.Weekly_Sales / 1000, 2)
                            + pow(p.Size / 1000 - q.Size / 1000, 2))) AS total,
                   (SELECT count(*) FROM ruled z WHERE z.Cluster = p.Cluster) AS n_own,
                   (SELECT count(DISTINCT Cluster) FROM ruled) AS k
            FROM ruled p CROSS JOIN ruled q GROUP BY p.Store, p.Cluster, q.Cluster)
      GROUP BY i)""", "ruled"),
    "model_frame": _with(f"""
SELECT {_DATE}, e.Store, Dept, IsHoliday, Size, t.Type_Encoded, round(CPI, 6) AS CPI,
       round(Unemployment, 6) AS Unemployment, round(Temperature, 6) AS Temperature,
       round(Fuel_Price, 6) AS Fuel_Price, Month, Week, round(Sales_Lag_1, 4) AS Sales_Lag_1,
       g.Cluster, {', '.join(f'round({c}, 4) AS {c}' for c in _MD)}
FROM engineered e LEFT JOIN segments g ON g.Store = e.Store LEFT JOIN (
  SELECT Type, CAST(dense_rank() OVER (ORDER BY Type) - 1 AS INT) AS Type_Encoded
  FROM (SELECT DISTINCT Type FROM engineered WHERE Type IS NOT NULL)) t ON t.Type = e.Type""",
                         "engineered", "segments"),
    "forecast_errors": _with(f"""
SELECT {_KEY}, round(Weekly_Sales - Sales_Lag_1, 4) AS forecast_error,
       round(abs(Weekly_Sales - Sales_Lag_1) / greatest(Weekly_Sales, 1) * 100, 4)
       AS abs_pct_error FROM lagged""", "lagged"),
    "mean_abs_pct_error": _with("""
SELECT count(*) AS n, round(avg(abs(Weekly_Sales - Sales_Lag_1) / greatest(Weekly_Sales, 1)) * 100,
                            6) AS mean_abs_pct_error FROM lagged""", "lagged"),
    "regression_metrics": _with(f"SELECT {_metric_columns('Weekly_Sales', 'Sales_Lag_1')} "
                                "FROM lagged", "lagged"),
    "metrics_by_segment": _with(
        f"SELECT g.Cluster, {_metric_columns('Weekly_Sales', 'Sales_Lag_1')} FROM lagged k "
        "LEFT JOIN segments g ON g.Store = k.Store GROUP BY g.Cluster", "lagged", "segments"),
    "compare_runs": _with("""
SELECT run_id, created_at, round(mae, 4) AS mae, round(rmse, 4) AS rmse,
       round(last_value(rmse IGNORE NULLS) OVER b, 4) AS previous,
       round(min(rmse) OVER b, 4) AS champion,
       round(rmse - last_value(rmse IGNORE NULLS) OVER b, 4) AS change,
       rmse IS NOT NULL AND coalesce(rmse < min(rmse) OVER b, true) AS promote
FROM (SELECT r.run_id, r.created_at, avg(abs(Weekly_Sales - p)) AS mae,
             sqrt(avg((Weekly_Sales - p) * (Weekly_Sales - p))) AS rmse
      FROM (SELECT 'run-2' AS run_id, '2001-01-15' AS created_at, Weekly_Sales, Sales_Lag_1 AS p
            FROM holdout
            UNION ALL SELECT 'run-3', '2001-02-01', Weekly_Sales, series_mean FROM holdout
            UNION ALL SELECT 'run-5', '2001-03-01', Weekly_Sales, Sales_Lag_1 FROM holdout) r
      WHERE p IS NOT NULL GROUP BY r.run_id, r.created_at
      UNION ALL VALUES ('run-1', '2001-01-01', NULL, NULL), ('run-4', '2001-02-15', NULL, NULL))
WINDOW b AS (ORDER BY created_at, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""", "holdout"),
    "macro_drift": _drift(),
    "weekly_totals": _with(f"SELECT {_DATE}, round(sum(Weekly_Sales), 4) AS y FROM sales "
                           "GROUP BY sales.Date", "sales"),
    "seasonal_naive": _naive("store_weeks"),
    "seasonal_naive_suppliers": _naive("supplier_weeks"),
    "ar1_fit": _with("""
SELECT Store, count(*) AS n, round(regr_slope(y, prev), 6) AS slope,
       round(regr_intercept(y, prev), 3) AS intercept, round(regr_r2(y, prev), 6) AS r2
FROM (SELECT Store, y, lag(y) OVER (PARTITION BY Store ORDER BY Date) AS prev FROM store_weeks)
WHERE prev IS NOT NULL GROUP BY Store""", "store_weeks"),
    "sink_master": _with("SELECT CAST(year(Date) AS INT) AS Year, count(*) AS n_rows, "
                         "round(sum(Weekly_Sales), 0) AS total FROM kept GROUP BY 1", "kept"),
    "sink_forecasts": _with(f"SELECT {_KEY}, {_WS}, round(Sales_Lag_1, 4) AS "
                            "predicted_weekly_sales FROM lagged", "lagged"),
    "sink_scores": _with(f"SELECT {_KEY}, {_WS}, round(Sales_Lag_1, 4) AS point_forecast "
                         "FROM lagged", "lagged"),
    "sink_export": _with("""
SELECT k.Store, k.Dept, CAST(k.Date AS VARCHAR) AS Date, g.Cluster, 'lag' AS model,
       round(k.Weekly_Sales, 4) AS Weekly_Sales, round(k.Sales_Lag_1, 4) AS point_forecast,
       round(k.Weekly_Sales - k.Sales_Lag_1, 4) AS forecast_error, true AS stamped
FROM lagged k LEFT JOIN segments g ON g.Store = k.Store""", "lagged", "segments"),
    "sink_rules": _rules("store_items", _SPLITS2),
    "run_manifest": _with("""
SELECT 'run-1' AS run_id, 'train' AS stage, round(avg(abs(Weekly_Sales - Sales_Lag_1)), 4) AS mae,
       round(sqrt(avg(pow(Weekly_Sales - Sales_Lag_1, 2))), 4) AS rmse, true AS stamped FROM lagged
UNION ALL SELECT 'run-2', 'score', NULL, NULL, true""", "lagged"),
    "ingest": _with(f"SELECT {_KEY}, {_WS}, Type, round(CPI, 6) AS CPI FROM master", "master"),
    "top_departments": _with("SELECT Dept, round(sum(Weekly_Sales), 4) AS total_sales FROM sales "
                             "GROUP BY Dept ORDER BY sum(Weekly_Sales) DESC, Dept LIMIT 15",
                             "sales"),
    "top_department_sales": _with("""
SELECT Dept, count(*) AS n FROM sales WHERE Dept IN (
  SELECT Dept FROM sales GROUP BY Dept ORDER BY sum(Weekly_Sales) DESC, Dept LIMIT 15)
GROUP BY Dept""", "sales"),
    "dept_baskets": _with(f"SELECT Store, {_DATE}, string_agg(DISTINCT CAST(Dept AS VARCHAR), ',' "
                          "ORDER BY CAST(Dept AS VARCHAR)) AS items FROM sales "
                          "GROUP BY Store, sales.Date", "sales"),
    "basket_matrix": _with("""
SELECT b.Store, CAST(b.Date AS VARCHAR) AS Date, 'item_' || i.Dept AS item, s.Dept IS NOT NULL AS present
FROM (SELECT DISTINCT Store, Date FROM sales) b CROSS JOIN (SELECT DISTINCT Dept FROM sales) i
LEFT JOIN (SELECT DISTINCT Store, Date, Dept FROM sales) s
  ON s.Store = b.Store AND s.Date = b.Date AND s.Dept = i.Dept""", "sales"),
    "rules_empty": """
SELECT string_agg(x, ',') AS antecedents, string_agg(x, ',') AS consequents, 1.0::DOUBLE AS support,
       1.0::DOUBLE AS confidence, 1.0::DOUBLE AS lift FROM (SELECT n_name AS x FROM nation WHERE false) GROUP BY x""",
    "run_all": _with("""
SELECT 'master' AS output, count(*) AS n_rows FROM kept UNION ALL SELECT 'scores', count(*) FROM kept
UNION ALL SELECT 'forecasts', count(*) FROM kept WHERE Date >= DATE '2000-01-01'
UNION ALL SELECT 'profiles', count(DISTINCT Store) FROM kept""", "kept"),
    "score_consistency": _with("SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_mismatch FROM kept "
                               "WHERE Date >= DATE '2000-01-01'", "kept"),
    "late_weeks": _with(f"SELECT {_KEY}, {_WS}, round(Sales_Lag_1, 4) AS Sales_Lag_1, "
                        "round(Sales_ZScore, 4) AS Sales_ZScore, Is_Anomaly FROM flagged", "flagged"),
    "boosting_state": _with("""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE Date < hi - CAST(greatest(floor((hi - lo) * 0.1) - 1, 0) AS INT)) AS n_train,
       10 AS n_rounds, CAST(0 AS BIGINT) AS n_apart
FROM kept, (SELECT min(Date) AS lo, max(Date) AS hi FROM kept WHERE Date < DATE '2000-01-01' AND Weekly_Sales IS NOT NULL)
WHERE Date < DATE '2000-01-01' AND Weekly_Sales IS NOT NULL""", "kept"),
    "unit_root_statistics": _unit_roots(),
    "closed_itemsets": _closed("SELECT array_to_string(items, ',') AS items, CAST(size AS INT) AS size, n, "
                               "round(support, 8) AS support FROM shut"),
    "closed_supports": _closed("SELECT array_to_string(items, ',') AS items, CAST(size AS INT) AS size, n, "
                               "round(CAST(n AS DOUBLE) / (SELECT n FROM total), 8) AS support FROM every_set WHERE size <= 3"),
    "closed_rules": _closed("""SELECT antecedents, consequents, round(support, 8) AS support, round(confidence, 8) AS confidence,
       round(lift, 8) AS lift FROM (
  SELECT array_to_string(a.items, ',') AS antecedents, u.c AS consequents, w.support,
         CAST(w.n AS DOUBLE) / a.n AS confidence, CAST(w.n AS DOUBLE) / a.n / (c.n / (SELECT CAST(n AS DOUBLE) FROM total)) AS lift
  FROM shut w, unnest(w.items) AS u(c) JOIN every_set a ON a.items = list_filter(w.items, lambda y: y <> u.c)
  JOIN f1 c ON c.last = u.c WHERE w.size >= 2)
WHERE confidence >= 0.1 AND lift >= 1.0"""),
    "guarded_promotion": _with("SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_mismatch, false AS challenger_promoted "
                               "FROM kept WHERE Date >= DATE '2000-01-01'", "kept"),
    "master_checks": _with("SELECT 'master' AS table_name, 'schema' AS \"check\", true AS passed, CAST(0 AS DOUBLE) AS observed, "
                           "CAST(0 AS DOUBLE) AS \"limit\" UNION ALL " + " UNION ALL ".join(
                               f"SELECT 'master', 'null_share:{c}', share <= 0.05, round(share, 8), CAST(0.05 AS DOUBLE) FROM "
                               f"(SELECT CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS share FROM engineered)"
                               for c in MASTER_REQUIRED), "engineered"),
    "report_round_trip": _with(f"SELECT {_metric_columns('Weekly_Sales', 'Sales_Lag_1')}, "
                               "CAST(1 AS INT) AS n_checks FROM lagged", "lagged"),
    "saved_mapping": _with("SELECT s.Store, s.Dept, CAST(s.Date AS VARCHAR) AS Date, st.Type, "
                           "CAST(CASE st.Type WHEN 'A' THEN 0 WHEN 'B' THEN 1 END AS INT) AS Type_Encoded "
                           "FROM sales s LEFT JOIN stores st ON st.Store = s.Store", "sales", "stores"),
    "table_head": _with(f"SELECT {_KEY}, {_WS}, IsHoliday FROM sales "
                        "ORDER BY Store, Dept, sales.Date LIMIT 5", "sales"),
    "frequent_items": _itemsets("store_items", 1),
    "frequent_pairs": _itemsets("store_items", 2),
    "frequent_triples": _itemsets("store_items", 3),
    "frequent_itemsets_orders": _itemsets("order_items", None),
    "association_rules": _rules("store_items", _SPLITS2),
    "association_rules_k3": _rules("store_items", _SPLITS3),
    "association_rules_orders": _rules("order_items", _SPLITS3),
    "flag_anomalies_suppliers": "",
    "sales_lag_suppliers": _with(
        f"SELECT {_KEY}, {_WS}, IsHoliday, round(coalesce(lag(Weekly_Sales) OVER "
        "(PARTITION BY Store, Dept ORDER BY kept_sup.Date), 0), 4) AS Sales_Lag_1 FROM kept_sup",
        "kept_sup"),
    "store_ranking_suppliers": _with(f"SELECT Store, {_mean('avg(Weekly_Sales)')} AS avg_sales "
                                     "FROM kept_sup GROUP BY Store", "kept_sup"),
}

ORACLES["raise_if_failed"] = f"""
SELECT 'bridge' AS "limits", coalesce(bool_or(NOT passed AND severity = 'error'), false) AS raised
FROM ({ORACLES["validate"]}) a
UNION ALL SELECT 'no_floor', coalesce(bool_or(NOT passed AND severity = 'error' AND "check" <> 'min_rows'), false)
FROM ({ORACLES["validate"]}) b
UNION ALL SELECT 'high_floor', true"""

ORACLES["flag_anomalies_suppliers"] = _with(_flags("flagged_sup"), "kept_sup", extra="""
flagged_sup AS (SELECT *, coalesce(abs(Sales_ZScore) > 3, false) AS Is_Anomaly FROM (
  SELECT *, (Weekly_Sales - avg(Weekly_Sales) OVER (PARTITION BY Store, Dept))
            / (stddev_samp(Weekly_Sales) OVER (PARTITION BY Store, Dept) + 1e-9) AS Sales_ZScore
  FROM kept_sup))""")

ORACLES["bucketed_flags"] = ORACLES["flag_anomalies"]
ORACLES["bucketed_lag"] = ORACLES["sales_lag"]


def _quantile_drift() -> str:
    parts = [f"""
SELECT '{c}' AS column_name, (SELECT count({c}) FROM ref) AS ref_n, (SELECT count({c}) FROM cur) AS cur_n,
       round((SELECT avg({c}) FROM ref), 6) AS ref_mean, round((SELECT avg({c}) FROM cur), 6) AS cur_mean,
       CAST(count(*) AS INT) AS n_bins, round(sum((q - p) * ln(q / p)), 6) AS psi
FROM (SELECT greatest((SELECT count(*) FROM ref WHERE {c} > lo AND {c} <= hi) / (SELECT CAST(count({c}) AS DOUBLE) FROM ref), 1e-6) AS p,
             greatest((SELECT count(*) FROM cur WHERE {c} > lo AND {c} <= hi) / (SELECT CAST(count({c}) AS DOUBLE) FROM cur), 1e-6) AS q
      FROM (SELECT lag(hi, 1, '-inf'::DOUBLE) OVER (ORDER BY hi) AS lo, hi FROM (
        SELECT DISTINCT unnest(quantile_disc({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS hi FROM ref
        UNION ALL SELECT 'inf'::DOUBLE)))""" for c in ("CPI", "Unemployment")]
    return _with(" UNION ALL ".join(parts), "features", extra="""ref AS (
  SELECT * FROM features WHERE Date < DATE '2000-01-01'), cur AS (
  SELECT * FROM features WHERE Date >= DATE '2000-01-01')""")


ORACLES["quantile_drift"] = _quantile_drift()
