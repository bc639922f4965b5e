"""The same results as SQL for an independent engine, written from each operator's description.

Common table expressions are shared as text; a query names those it needs, in order.
"""

from __future__ import annotations

from . import domain
from .sources import driver_tables as D

ORACLES: dict[str, str] = {}

_PRIORITY_COMMODITY = {
    "1-URGENT": "rice",
    "2-HIGH": "coffee",
    "3-MEDIUM": "cocoa",
    "4-NOT SPECIFIED": "cotton",
    "5-LOW": "rubber",
}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def cases(column: str, values: dict, default: str = "NULL") -> str:
    def literal(v):
        return quoted(v) if isinstance(v, str) else str(v)

    branches = " ".join(f"WHEN {column} = {quoted(k)} THEN {literal(v)}" for k, v in values.items())
    return f"CASE {branches} ELSE {default} END"


def rounded(expression: str, digits: int = 4) -> str:
    return f"floor(({expression}) * {float(10**digits)!r}::DOUBLE + 0.5::DOUBLE) / {float(10**digits)!r}::DOUBLE"


def mean(column: str, dtype: str, over: str = "") -> str:
    exact = f"CAST({column} AS {dtype})"
    return f"CAST(sum({exact}) {over} AS DOUBLE) / nullif(count({exact}) {over}, 0)"


def change(new: str, old: str) -> str:
    return f"CASE WHEN {old} <> 0 THEN ({new} - {old}) / {old} * 100 END"


PRICE, FINE = "DECIMAL(18,6)", "DECIMAL(28,9)"
_COMMODITY = cases("o_orderpriority", _PRIORITY_COMMODITY)

CTES = {
    # Daily quotes: the latest load per day, commodity and market.
    "quotes": f"""quotes AS (
        SELECT CAST(o_orderdate AS DATE) AS price_date, {_COMMODITY} AS commodity,
               CASE WHEN o_orderstatus = 'P' THEN 'US futures market' ELSE o_orderstatus END AS region,
               CASE WHEN o_orderstatus = 'F' THEN 'Viet Nam' ELSE 'United States' END AS country,
               CAST(o_totalprice AS {PRICE}) AS price, o_orderkey,
               TIMESTAMP '2002-01-01' + to_seconds(o_orderkey) AS ingested_at
        FROM orders)""",
    "observed": """observed AS (
        SELECT *, CAST(price AS DOUBLE) AS dprice FROM quotes WHERE price > 0 AND price_date IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY price_date, commodity, region ORDER BY ingested_at DESC, price DESC) = 1)""",
    "spine": """spine AS (
        SELECT CAST(day AS DATE) AS date
        FROM (SELECT unnest(generate_series(make_date(year(min(d)), 1, 1), make_date(year(max(d)) + 1, 12, 31), INTERVAL 1 DAY))
              AS day FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem)))""",
    # Calendar of each series joined to its observations, then carried forward.
    "dense": """bounds AS (
        SELECT commodity, region, min(price_date) AS lo, max(price_date) AS hi FROM observed GROUP BY ALL),
    dense AS (
        SELECT b.commodity, b.region, s.date, o.price, o.country, o.ingested_at,
               last_value(o.price IGNORE NULLS) OVER w AS carried_price,
               last_value(o.country IGNORE NULLS) OVER w AS carried_country,
               last_value(o.ingested_at IGNORE NULLS) OVER w AS carried_ingested_at,
               last_value(o.price_date IGNORE NULLS) OVER w AS seen
        FROM bounds b JOIN spine s ON s.date BETWEEN b.lo AND b.hi
        LEFT JOIN observed o ON o.commodity = b.commodity AND o.region = b.region AND o.price_date = s.date
        WINDOW w AS (PARTITION BY b.commodity, b.region ORDER BY s.date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    "daily": """daily AS (
        SELECT commodity, date AS price_date, region, carried_country AS country, carried_price AS price,
               carried_ingested_at AS ingested_at, price IS NULL AS is_imputed
        FROM dense
        WHERE price IS NOT NULL
           OR (extract(dow FROM date) IN (0, 6) AND date_diff('day', seen, date) BETWEEN 1 AND 3))""",
    "monthly": f"""priced AS (
        SELECT {_COMMODITY} AS commodity, CAST(date_trunc('month', l_shipdate) AS DATE) AS price_date,
               l_returnflag AS region, CAST(l_extendedprice AS {PRICE}) AS price,
               TIMESTAMP '2002-01-01' + to_seconds(l_orderkey * 8 + l_linenumber) AS ingested_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    monthly AS (
        SELECT *, 'World' AS country FROM priced WHERE price > 0
        QUALIFY row_number() OVER (PARTITION BY price_date, commodity, region ORDER BY ingested_at DESC, price DESC) = 1)""",
    "markets": """markets AS (
        SELECT row_number() OVER (ORDER BY country, region, source) AS region_id, *
        FROM (SELECT country, region, 'WORLD_BANK' AS source FROM monthly
              UNION SELECT country, region, 'YAHOO_FINANCE' FROM daily))""",
    "fact": f"""both_sources AS (
        SELECT commodity, price_date, region, country, price, 'kg' AS unit, 'WORLD_BANK' AS source, ingested_at,
               FALSE AS is_imputed FROM monthly
        UNION ALL
        SELECT commodity, price_date, region, country, price, 'unit_contract', 'YAHOO_FINANCE', ingested_at,
               is_imputed FROM daily),
    fact AS (
        SELECT b.*, m.region_id, CAST(b.price AS DOUBLE) AS dprice,
               CAST(lag(b.price) OVER s AS DOUBLE) AS previous,
               {mean("b.price", PRICE, "OVER s7")} AS avg7, {mean("b.price", PRICE, "OVER s30")} AS avg30
        FROM both_sources b JOIN markets m USING (country, region, source)
        WINDOW s AS (PARTITION BY b.commodity, m.region_id ORDER BY b.price_date),
               s7 AS (PARTITION BY b.commodity, m.region_id ORDER BY b.price_date
                      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
               s30 AS (PARTITION BY b.commodity, m.region_id ORDER BY b.price_date
                       ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))""",
    "across": f"""across_sources AS (
        SELECT commodity, price_date, {mean("price", PRICE)} AS price,
               {mean(change("dprice", "previous"), FINE)} AS pct, {mean("avg7", FINE)} AS avg7,
               {mean("avg30", FINE)} AS avg30, count(DISTINCT source) AS source_count
        FROM fact GROUP BY commodity, price_date)""",
    "frame": f"""means AS (
        SELECT price_date, commodity, {mean("price", PRICE)} AS usd FROM fact GROUP BY price_date, commodity),
    frame AS (
        SELECT price_date, commodity, usd, usd * 1.0::DOUBLE AS price,
               lag(usd, 30) OVER c AS usd_before,
               {mean("usd", FINE, "OVER c7")} AS avg7, {mean("usd", FINE, "OVER c30")} AS avg30
        FROM means
        WINDOW c AS (PARTITION BY commodity ORDER BY price_date),
               c7 AS (PARTITION BY commodity ORDER BY price_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
               c30 AS (PARTITION BY commodity ORDER BY price_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))""",
    "latest": f"""latest AS (
        SELECT *, {change("usd", "usd_before")} AS pct FROM frame
        QUALIFY row_number() OVER (PARTITION BY commodity ORDER BY price_date DESC) = 1)""",
    "closes": """closes AS (
        SELECT commodity, price_date, dprice AS price FROM observed
        QUALIFY row_number() OVER (PARTITION BY commodity, price_date ORDER BY ingested_at DESC, price DESC) = 1)""",
    "alerts": f"""moves AS (
        SELECT commodity, price_date, price AS new_price,
               lag(price) OVER (PARTITION BY commodity ORDER BY price_date) AS old_price FROM closes),
    changes AS (
        SELECT *, {change("new_price", "old_price")} AS pct_change,
               CAST({cases("commodity", domain.THRESHOLDS, "5.0")} AS DOUBLE) AS threshold
        FROM moves WHERE old_price > 0),
    alerts AS (
        SELECT 'ALT_' || commodity || '_' || strftime(price_date, '%Y%m%d') || '_'
                   || CAST(CAST(round_even(abs(pct_change), 0) AS BIGINT) AS VARCHAR) AS alert_id,
               price_date AS alert_date, commodity, old_price, new_price,
               {rounded("pct_change", 6)} AS pct_change, threshold,
               commodity || ' ' || CASE WHEN pct_change > 0 THEN {quoted(domain.DIRECTION_UP)}
                   ELSE {quoted(domain.DIRECTION_DOWN)} END || ' ' || printf('%.2f%%', abs(pct_change)) AS ai_comment
        FROM changes WHERE abs(pct_change) >= threshold)""",
    # Model features without gaps: the first rows take the first value that exists.
    "filled": f"""lagged AS (
        SELECT commodity, price_date, price, lag(price, 1) OVER c AS lag_1, lag(price, 7) OVER c AS lag_7,
               {mean("price", FINE, "OVER c30")} AS avg_30, stddev_samp(price) OVER c30 AS vol_30,
               row_number() OVER c AS row_no, count(*) OVER (PARTITION BY commodity) AS n
        FROM closes
        WINDOW c AS (PARTITION BY commodity ORDER BY price_date),
               c30 AS (PARTITION BY commodity ORDER BY price_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
    filled AS MATERIALIZED (
        SELECT commodity, price_date, row_no, n, price, """
    + ", ".join(f"coalesce({c}, first_value({c} IGNORE NULLS) OVER later) AS {c}" for c in ("lag_1", "lag_7", "avg_30", "vol_30"))
    + """
        FROM lagged WINDOW later AS (PARTITION BY commodity ORDER BY price_date
                                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
    # Ridge regression over scaled windows: standardised columns, normal equations, Gauss-Jordan elimination.
    "ridge": """bounds_of AS (
        SELECT commodity, """
    + ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in ("price", "lag_1", "lag_7", "avg_30", "vol_30"))
    + """
        FROM filled WHERE n > 40 AND row_no <= 30 + floor(0.8::DOUBLE * (n - 30)) GROUP BY commodity),
    prices AS (
        SELECT commodity, price_lo AS low, CASE WHEN price_hi = price_lo THEN 1 ELSE price_hi - price_lo END AS width FROM bounds_of),
    scaled AS MATERIALIZED (
        SELECT commodity, price_date, row_no, n, ["""
    + ", ".join(f"({c} - {c}_lo) / CASE WHEN {c}_hi = {c}_lo THEN 1 ELSE {c}_hi - {c}_lo END" for c in ("price", "lag_1", "lag_7", "avg_30", "vol_30"))
    + """] AS cells
        FROM filled JOIN bounds_of USING (commodity) WHERE n > 40),
    windows AS MATERIALIZED (
        SELECT commodity, row_no - 30 AS k, cells[1] AS y, row_no - 30 <= floor(0.8::DOUBLE * (n - 30)) AS is_train,
               flatten(list(cells) OVER (PARTITION BY commodity ORDER BY row_no ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)) AS x
        FROM scaled QUALIFY row_no > 30),
    targets AS MATERIALIZED (
        SELECT commodity, count(*) AS n, avg(y) AS y_mean, stddev_pop(y) AS y_dev, list((y) ORDER BY k) AS ys
        FROM windows WHERE is_train GROUP BY commodity),
    columns_of AS (
        SELECT commodity, cell, avg(v) AS mean, stddev_pop(v) AS dev, list(v ORDER BY k) AS vs
        FROM (SELECT commodity, k, unnest(x) AS v, generate_subscripts(x, 1) AS cell FROM windows WHERE is_train)
        GROUP BY commodity, cell),
    standard AS MATERIALIZED (
        SELECT c.*, t.n, t.y_dev, row_number() OVER (PARTITION BY commodity ORDER BY cell) AS i,
               count(*) OVER (PARTITION BY commodity) AS m, list_transform(vs, lambda v: (v - mean) / dev) AS z,
               list_transform(ys, lambda v: (v - y_mean) / y_dev) AS ty
        FROM columns_of c JOIN targets t USING (commodity) WHERE dev > 1e-7),
    equations AS MATERIALIZED (
        SELECT a.commodity, a.i, any_value(a.m) AS m,
               list(list_dot_product(a.z, b.z) / a.n + CASE WHEN a.i = b.i THEN 0.001::DOUBLE / a.y_dev ELSE 0 END ORDER BY b.i)
                   || [any_value(list_dot_product(a.z, a.ty) / a.n)] AS line
        FROM standard a JOIN standard b ON a.commodity = b.commodity GROUP BY a.commodity, a.i),
    solved AS (
        WITH RECURSIVE eliminated AS (
            SELECT commodity, i, m, line, 1 AS step FROM equations
            UNION ALL
            SELECT r.commodity, r.i, r.m, CASE WHEN r.i = r.step THEN list_transform(r.line, lambda v: v / r.line[r.step])
                       ELSE list_transform(list_zip(r.line, p.line), lambda v: v[1] - v[2] * (r.line[r.step] / p.line[r.step])) END, r.step + 1
            FROM eliminated r JOIN eliminated p ON p.commodity = r.commodity AND p.i = r.step WHERE r.step <= r.m)
        SELECT commodity, i, line[m + 1] AS w FROM eliminated WHERE step = m + 1),
    weighted AS (
        SELECT c.commodity, c.cell, c.mean, coalesce(s.w * d.y_dev / c.dev, 0) AS w
        FROM columns_of c LEFT JOIN standard d ON d.commodity = c.commodity AND d.cell = c.cell
        LEFT JOIN solved s ON s.commodity = d.commodity AND s.i = d.i),
    models AS MATERIALIZED (
        SELECT commodity, any_value(y_mean) - sum(w * mean) AS intercept, list(w ORDER BY cell) AS weights
        FROM weighted JOIN targets USING (commodity) GROUP BY commodity),
    walked AS (
        WITH RECURSIVE walk AS (
            SELECT commodity, max(price_date) AS last_date, 0 AS step, list(cells ORDER BY row_no) AS rows_seen, [0::DOUBLE] AS path
            FROM scaled WHERE row_no > n - 30 GROUP BY commodity
            UNION ALL
            SELECT commodity, last_date, step + 1, rows_seen[2:] || [[list_dot_product(flatten(rows_seen), weights) + intercept] || rows_seen[30][2:]],
                   [list_dot_product(flatten(rows_seen), weights) + intercept]
            FROM walk JOIN models USING (commodity) WHERE step < 6)
        SELECT * FROM walk)""",
    "ar1": """pairs AS (
        SELECT commodity, price_date, price, lag(price) OVER (PARTITION BY commodity ORDER BY price_date) AS prev
        FROM closes),
    fit AS (
        SELECT commodity, regr_slope(price, prev) AS slope, regr_intercept(price, prev) AS intercept,
               max(price_date) AS last_date, arg_max(price, price_date) AS last_price
        FROM pairs GROUP BY commodity HAVING count(*) >= 30),
    steps AS (
        WITH RECURSIVE walk AS (
            SELECT commodity, slope, intercept, last_date, 1 AS step, last_price * slope + intercept AS p FROM fit
            UNION ALL
            SELECT commodity, slope, intercept, last_date, step + 1, p * slope + intercept FROM walk WHERE step < 6)
        SELECT * FROM walk),
    forecast AS (
        SELECT CAST(last_date + 30 * step AS DATE) AS forecast_date, commodity, p AS predicted_price,
               p - p * (0.05::DOUBLE + 0.01::DOUBLE * (step - 1)) AS ci_lower,
               p + p * (0.05::DOUBLE + 0.01::DOUBLE * (step - 1)) AS ci_upper FROM steps)""",
}

_CHAIN = {
    "observed": ["quotes"],
    "dense": ["observed", "spine"],
    "daily": ["dense"],
    "markets": ["daily", "monthly"],
    "fact": ["markets"],
    "across": ["fact"],
    "frame": ["fact"],
    "latest": ["frame"],
    "closes": ["observed"],
    "alerts": ["closes"],
    "ar1": ["closes"],
    "filled": ["closes"],
    "ridge": ["filled"],
}


def _closure(names: list[str]) -> list[str]:
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in _CHAIN.get(name, []):
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return order


def sql(name: str, body: str, *ctes: str) -> None:
    parts = [CTES[c] for c in _closure(list(ctes))]
    ORACLES[name] = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


STAMP = "strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at"

# --- Cleaning ---

sql(
    "tolerant_pick",
    """
SELECT event_id, event_type AS by_table_order, CAST(CAST(value AS DECIMAL(18,6)) AS DOUBLE) AS by_candidate_order,
       TRY_CAST(props AS DOUBLE) IS NULL AS uncastable_is_null, TRUE AS absent_is_null
FROM events""",
)
sql(
    "parse_period",
    """
SELECT o_orderkey, CAST(CASE
    WHEN o_orderpriority = '1-URGENT' THEN date_trunc('month', o_orderdate)
    WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN o_orderdate
    WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN NULL
    WHEN o_orderstatus = 'P' THEN NULL
    WHEN o_orderstatus = 'O' AND month(o_orderdate) <= 9 THEN make_date(year(o_orderdate), month(o_orderdate) + 3, 1)
    ELSE date_trunc('year', o_orderdate) END AS DATE) AS price_date
FROM orders""",
)
sql(
    "unit_ladder",
    """
SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
    CASE WHEN p_size < 10 OR p_type IN ('ECONOMY', 'STANDARD', 'MEDIUM') THEN l_extendedprice / 1000
         WHEN p_type = 'LARGE' THEN l_extendedprice / 0.45359237::DOUBLE
         ELSE l_extendedprice END AS monthly_price,
    CASE WHEN l_returnflag = 'R' THEN l_extendedprice / 4
         WHEN p_type IN ('ECONOMY', 'SMALL') THEN l_extendedprice / 100 / 0.45359237::DOUBLE
         WHEN p_type = 'STANDARD' THEN l_extendedprice / 100 / 45.359237::DOUBLE
         WHEN p_type IN ('MEDIUM', 'LARGE') THEN l_extendedprice / 1000 END AS daily_price,
    CASE WHEN p_size < 10 THEN l_extendedprice / 45.359237::DOUBLE * 2.2::DOUBLE
         WHEN p_size < 20 THEN l_extendedprice / 100 / 0.45359237::DOUBLE
         WHEN p_size < 30 THEN l_extendedprice / 1000 END AS contract_price
FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
sql(
    "blank_defaults",
    """
SELECT event_id,
    CASE event_type WHEN 'click' THEN 'Eur' WHEN 'purchase' THEN 'purchase' ELSE 'US futures market' END AS region,
    CASE event_type WHEN 'click' THEN 'EUR' WHEN 'purchase' THEN 'PURCHASE' ELSE 'USD' END AS currency,
    CASE event_type WHEN 'click' THEN 'eur' WHEN 'purchase' THEN 'purchase' ELSE '' END AS plain
FROM events""",
)
sql(
    "melt_measures",
    """
SELECT l_returnflag, measure, count(*) AS value_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM (SELECT l_returnflag, 'quantity' AS measure, l_quantity AS value FROM lineitem
      UNION ALL SELECT l_returnflag, 'price', l_extendedprice FROM lineitem
      UNION ALL SELECT l_returnflag, 'discount', l_discount FROM lineitem
      UNION ALL SELECT l_returnflag, 'tax', l_tax FROM lineitem)
WHERE value <> 0 GROUP BY l_returnflag, measure""",
)
sql(
    "wide_sheet_rows",
    """
SELECT strftime(o_orderdate, '%YM%m') AS price_date, original_name, max(o_totalprice) AS price_usd, commodity,
       'world_bank_pink_sheet' AS source
FROM orders JOIN (VALUES ('1-URGENT', 'RICE, THAI 5%', 'rice'), ('2-HIGH', 'Coffee, Arabica', 'coffee'),
    ('3-MEDIUM', 'Cocoa beans', 'cocoa'), ('5-LOW', 'Cotton, A Index', 'cotton'))
    AS names(priority, original_name, commodity) ON o_orderpriority = priority
GROUP BY ALL""",
)
sql(
    "alias_lookup_join",
    f"""
SELECT o_orderkey, {cases("o_orderpriority", {**D.DAILY_NAMES, "5-LOW": " Soy Beans "})} AS raw_name,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'soy beans' ELSE {_COMMODITY} END AS commodity FROM orders""",
)
sql(
    "latest_load_per_day",
    f"""
SELECT commodity, price_date, region, country, dprice AS price_usd_per_kg, 'USD' AS currency, 'unit_contract' AS unit,
       'unknown' AS ticker, 'YAHOO_FINANCE' AS source, {STAMP} FROM observed""",
    "observed",
)
sql(
    "clean_monthly_prices",
    f"""
SELECT commodity, price_date, region, country, CAST(price AS DOUBLE) AS price_usd_per_kg, 'USD' AS currency,
       'kg' AS unit, 'WORLD_BANK' AS source, {STAMP} FROM monthly""",
    "monthly",
)

# --- Calendar ---

sql(
    "calendar_fill_weekend",
    f"""
SELECT commodity, price_date, region, country, CAST(price AS DOUBLE) AS price_usd_per_kg, 'USD' AS currency,
       'unit_contract' AS unit, 'YAHOO_FINANCE' AS source, {STAMP}, 'unknown' AS ticker,
       CAST(price AS DOUBLE) AS close_price, is_imputed FROM daily""",
    "daily",
)
sql(
    "calendar_fill_every_day",
    """
SELECT commodity, region, date AS price_date, CAST(carried_price AS DOUBLE) AS price_usd_per_kg,
       CAST(last_value(CASE WHEN extract(dow FROM date) <> 2 THEN price END IGNORE NULLS) OVER (
           PARTITION BY commodity, region ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           AS DOUBLE) AS close_price,
       seen AS last_observed_date, date_diff('day', seen, date) AS days_since_observed, price IS NULL AS is_imputed
FROM dense""",
    "dense",
)
sql(
    "series_bounds",
    """
SELECT commodity, region, country, 'YAHOO_FINANCE' AS source, min(price_date) AS min_date, max(price_date) AS max_date
FROM observed GROUP BY commodity, region, country""",
    "observed",
)


def calendar_sql(day: str) -> str:
    return f"""CAST(strftime({day}, '%Y%m%d') AS BIGINT) AS date_id, {day} AS date, year({day}) AS year,
       quarter({day}) AS quarter, month({day}) AS month, strftime({day}, '%B') AS month_name, week({day}) AS week,
       extract(dow FROM {day}) AS day_of_week, extract(dow FROM {day}) IN (0, 6) AS is_weekend,
       strftime({day}, '%m-%d') IN ('01-01', '04-30', '05-01', '09-02') AS is_vietnam_public_holiday"""


sql(
    "date_dimension",
    f"""
SELECT {calendar_sql("date")}, coalesce(n, 0) AS orders
FROM spine LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) ON date = d""",
    "spine",
)
sql(
    "date_attributes",
    f"""
SELECT n AS items, {calendar_sql("d")}
FROM (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1)""",
)
sql(
    "rows_outside_calendar",
    """
SELECT commodity, region, 'YAHOO_FINANCE' AS source, count(*) AS dropped_rows FROM observed
WHERE price_date < DATE '1996-01-01' OR price_date > DATE '2001-01-13' GROUP BY commodity, region""",
    "observed",
)

# --- Star schema and marts ---

sql(
    "rolling_price_metrics",
    f"""
SELECT commodity, region, price_date, dprice AS price_usd_per_kg, previous AS previous_price_usd_per_kg,
       {change("dprice", "previous")} AS price_change_pct, price_7d_avg, price_30d_avg
FROM (SELECT *, lag(dprice) OVER (PARTITION BY commodity, region ORDER BY price_date) AS previous,
        {mean("price", PRICE, "OVER (PARTITION BY commodity, region ORDER BY price_date ROWS 6 PRECEDING)")} AS price_7d_avg,
        {mean("price", PRICE, "OVER (PARTITION BY commodity, region ORDER BY price_date ROWS 29 PRECEDING)")} AS price_30d_avg
      FROM observed)""",
    "observed",
)
sql(
    "star_fact",
    f"""
SELECT md5(source || '|' || commodity || '|' || CAST(price_date AS VARCHAR) || '|' || region) AS price_id,
       CAST({cases("commodity", domain.COMMODITY_IDS)} AS BIGINT) AS commodity_id,
       CAST(strftime(price_date, '%Y%m%d') AS BIGINT) AS date_id, region_id, price_date, commodity, region, country,
       dprice AS price_usd_per_kg, previous AS previous_price_usd_per_kg,
       {change("dprice", "previous")} AS price_change_pct, avg7 AS price_7d_avg, avg30 AS price_30d_avg,
       'USD' AS currency, unit, source, {STAMP}, is_imputed FROM fact""",
    "fact",
)
sql(
    "region_dimension",
    """
SELECT region_id, country, region, source, lower(country) IN ('vietnam', 'viet nam') AS is_vietnam_market
FROM markets""",
    "markets",
)
_SEED = {row[1]: row for row in domain.COMMODITY_MAPPING}
_SEED_VALUES = ", ".join(
    f"({i}, {quoted(c)}, {quoted(_SEED[c][2])}, {quoted(_SEED[c][3])})" for c, i in domain.COMMODITY_IDS.items()
)
sql(
    "commodity_dimension",
    f"""
SELECT CAST(id AS BIGINT) AS commodity_id, seed.commodity, name_vi, category, coalesce(n, 0) AS observations
FROM (VALUES {_SEED_VALUES}) AS seed(id, commodity, name_vi, category)
LEFT JOIN (SELECT commodity, count(*) AS n FROM observed GROUP BY 1) AS o ON o.commodity = seed.commodity""",
    "observed",
)
_ATTRIBUTES = """year(price_date) AS year, quarter(price_date) AS quarter, month(price_date) AS month,
       week(price_date) AS week, extract(dow FROM price_date) IN (0, 6) AS is_weekend,
       strftime(price_date, '%m-%d') IN ('01-01', '04-30', '05-01', '09-02') AS is_vietnam_public_holiday"""
sql(
    "cross_source_daily",
    f"""
SELECT price_date, commodity, {_ATTRIBUTES}, price AS price_usd_per_kg, {rounded("pct")} AS price_change_pct,
       {rounded("avg7")} AS price_7d_avg, {rounded("avg30")} AS price_30d_avg, source_count FROM across_sources""",
    "across",
)
_HARVEST = " OR ".join(
    f"(commodity = {quoted(c)} AND month(price_date) IN ({', '.join(map(str, months))}))"
    for c, months in domain.HARVEST_MONTHS.items()
)
sql(
    "ml_features",
    f"""
SELECT price_date, commodity, {_ATTRIBUTES}, ({_HARVEST}) AS is_harvest_season, price AS price_usd_per_kg,
       {rounded("pct")} AS price_change_pct, {rounded("avg7")} AS price_7d_avg, {rounded("avg30")} AS price_30d_avg,
       {mean("price", FINE, "OVER c90")} AS price_90d_avg,
       {rounded("stddev_samp(price) OVER c30")} AS price_30d_volatility,
       lag(price, 1) OVER c AS price_lag_1, lag(price, 7) OVER c AS price_lag_7, lag(price, 30) OVER c AS price_lag_30,
       source_count
FROM across_sources
WINDOW c AS (PARTITION BY commodity ORDER BY price_date),
       c30 AS (PARTITION BY commodity ORDER BY price_date ROWS 29 PRECEDING),
       c90 AS (PARTITION BY commodity ORDER BY price_date ROWS 89 PRECEDING)""",
    "across",
)
sql(
    "monthly_combined",
    f"""
SELECT commodity, price_date AS month_date, CAST(price AS DOUBLE) AS price_usd_per_kg, region, country,
       'USD' AS currency, 'WORLD_BANK' AS source FROM monthly
UNION ALL
SELECT commodity, CAST(date_trunc('month', price_date) AS DATE), CAST(CAST({mean("price", PRICE)} AS {PRICE}) AS DOUBLE),
       region, country, 'USD', 'YAHOO_FINANCE_MONTHLY_AVG'
FROM daily GROUP BY commodity, date_trunc('month', price_date), region, country""",
    "daily",
    "monthly",
)

# --- Serving ---

_NAME_VI = cases("commodity", {c: row[2] for c, row in _SEED.items()})
_CATEGORY = cases("commodity", {c: row[3] for c, row in _SEED.items()})
sql(
    "serving_frame",
    f"""
SELECT price_date, commodity, usd AS price_usd_per_kg, {_NAME_VI} AS name_vi, {_CATEGORY} AS category,
       {change("usd", "usd_before")} AS price_change_pct, avg7 AS price_7d_avg, avg30 AS price_30d_avg,
       usd * 25000::DOUBLE AS price, avg7 * 25000::DOUBLE AS price_7d, avg30 * 25000::DOUBLE AS price_30d FROM frame""",
    "frame",
)
sql(
    "frame_bounds",
    """
SELECT min(price_date) AS min_date, max(price_date) AS max_date, count(*) AS rows,
       count(DISTINCT commodity) AS commodities FROM frame""",
    "frame",
)
sql(
    "frame_members",
    f"SELECT DISTINCT commodity, {cases('commodity', domain.DISPLAY_NAMES, 'commodity')} AS name FROM frame",
    "frame",
)
sql(
    "filtered_range",
    """
SELECT price_date, commodity, price, avg30 AS price_30d FROM frame
WHERE commodity IN ('rice', 'coffee', 'rubber') AND price_date <= DATE '2001-06-30'
  AND price_date >= (SELECT greatest(min(price_date), CAST(max(price_date) - INTERVAL 3 YEAR AS DATE)) FROM frame)""",
    "frame",
)
sql(
    "latest_per_series",
    """
SELECT commodity, price_date, price, pct AS price_change_pct, coalesce(abs(pct), 0) AS abs_change FROM latest""",
    "latest",
)
sql(
    "latest_non_null",
    """
SELECT event_type,
    arg_max(value, (ts, value)) FILTER (value >= 20) AS high_value,
    arg_max(user_id, (ts, user_id)) FILTER (user_id > 100) AS late_user,
    count(*) FILTER (value < 0) > 0 AS has_negative
FROM events GROUP BY event_type""",
)
sql(
    "last_rows_per_series",
    """
SELECT commodity, price_date, price AS price_usd_per_kg FROM closes
QUALIFY row_number() OVER (PARTITION BY commodity ORDER BY price_date DESC) <= 24""",
    "closes",
)
sql(
    "strongest_move",
    f"""
SELECT arg_min(commodity, (-coalesce(abs(pct), 0), commodity)) AS strongest,
       {rounded("arg_min(pct, (-coalesce(abs(pct), 0), commodity))")} AS strongest_change,
       {rounded("avg(coalesce(abs(pct), 0))")} AS avg_move, max(price_date) AS latest_date, count(*) AS commodities
FROM latest""",
    "latest",
)
sql(
    "top_movers",
    """
SELECT commodity, price, coalesce(abs(pct), 0) AS abs_change FROM latest
ORDER BY abs_change DESC, commodity LIMIT 3""",
    "latest",
)
sql(
    "metric_cards",
    f"""
SELECT commodity, latest_date, price_now, price_past, high_52w, low_52w,
       coalesce({change("price_now", "price_past")}, 0) AS change_pct
FROM (
    SELECT l.commodity, l.price_date AS latest_date, l.price AS price_now,
           (SELECT f.price FROM frame f WHERE f.commodity = l.commodity AND f.price_date <= l.price_date - 30
            ORDER BY f.price_date DESC LIMIT 1) AS price_past,
           (SELECT max(f.price) FROM frame f
            WHERE f.commodity = l.commodity AND f.price_date >= l.price_date - 364) AS high_52w,
           (SELECT min(f.price) FROM frame f
            WHERE f.commodity = l.commodity AND f.price_date >= l.price_date - 364) AS low_52w
    FROM latest l)""",
    "latest",
)
_LABEL = f"{cases('commodity', domain.DISPLAY_MARKS, quoted(''))} || ' ' || {cases('commodity', domain.DISPLAY_NAMES, 'commodity')}"
sql("price_ranking", f"SELECT commodity, {_LABEL} AS label, price FROM latest", "latest")


def quartile(share: str) -> str:
    """Linear interpolation between the two ranks around the quartile of a sorted list."""
    position = f"((n - 1) * {share}::DOUBLE)"
    low, high = f"floor({position})", f"ceil({position})"
    pick_low, pick_high = f"l[CAST({low} AS BIGINT) + 1]", f"l[CAST({high} AS BIGINT) + 1]"
    return (
        f"CASE WHEN {low} = {high} OR {pick_low} = {pick_high} THEN {pick_low} "
        f"ELSE ({high} - {position}) * {pick_low} + ({position} - {low}) * {pick_high} END"
    )


sql(
    "displayed_prices",
    """
SELECT commodity, printf('%.4f', price) AS usd, format('{:,}', CAST(round_even(price * 25000, 0) AS BIGINT)) AS vnd FROM latest""",
    "latest",
)
sql(
    "yearly_distribution",
    f"""
SELECT commodity, year, {quartile("0.25")} AS q1, {quartile("0.5")} AS median_price, {quartile("0.75")} AS q3,
       mean_price, min_price, max_price
FROM (SELECT commodity, year(price_date) AS year, list_sort(list(price)) AS l, count(*) AS n,
             {mean("price", FINE)} AS mean_price, min(price) AS min_price, max(price) AS max_price
      FROM frame GROUP BY 1, 2)
QUALIFY year >= max(year) OVER (PARTITION BY commodity) - 10""",
    "frame",
)


def pair_sql(x: str, y: str) -> str:
    return f"""(SELECT a.price AS px, b.price AS py FROM frame a JOIN frame b USING (price_date)
      WHERE a.commodity = {quoted(x)} AND b.commodity = {quoted(y)})"""


sql(
    "pair_correlation",
    f"""
SELECT count(*) AS days, {rounded("corr(px, py)", 6)} AS correlation, {rounded("regr_slope(py, px)", 6)} AS slope,
       {rounded("regr_intercept(py, px)", 2)} AS intercept, min(px) AS min_x, max(px) AS max_x,
       CASE WHEN abs(corr(px, py)) > 0.7 THEN 'mạnh' WHEN abs(corr(px, py)) > 0.4 THEN 'trung bình' ELSE 'yếu' END
           AS strength
FROM {pair_sql("rice", "coffee")}""",
    "frame",
)
sql(
    "trend_line",
    f"""
SELECT point, {rounded("lo + point * ((hi - lo) / 99)", 3)} AS x,
       {rounded("slope * (lo + point * ((hi - lo) / 99)) + intercept", 3)} AS y
FROM (SELECT regr_slope(py, px) AS slope, regr_intercept(py, px) AS intercept, min(px) AS lo, max(px) AS hi
      FROM {pair_sql("cocoa", "cotton")}), range(100) AS r(point)""",
    "frame",
)
# Mean in cents, rounded half up with whole numbers: billionths of a price, so a cent is ten million of them.
_CENTS = """(CAST(sum(CAST(price AS DECIMAL(28,9))) * 1000000000 AS HUGEINT) * 2 + count(*) * 10000000)
           // (count(*) * 20000000)"""
_YEARS = f"""(SELECT year(price_date) AS year, commodity, {_CENTS} AS cents FROM frame GROUP BY 1, 2
      QUALIFY dense_rank() OVER (ORDER BY year(price_date) DESC) <= 4)"""
sql(
    "yearly_means_recent",
    f"SELECT year, commodity, CAST(cents AS DOUBLE) / 100 AS mean_price FROM {_YEARS}",
    "frame",
)
sql(
    "report_table",
    f"""
SELECT strftime(price_date, '%m/%Y') AS month, {_LABEL} AS commodity, price, {change("usd", "usd_before")} AS change_pct,
       avg7 AS avg_7, avg30 AS avg_30 FROM frame""",
    "frame",
)
_SHORT = cases("commodity", domain.SUMMARY_NAMES, "commodity")
_MARKED = f"{cases('commodity', domain.SUMMARY_MARKS, quoted(''))} || ' ' || {_SHORT}"
_FOOTER = " UNION ALL ".join(
    f"SELECT 9, {i}::DOUBLE, '', {quoted(text)}" for i, text in enumerate(domain.SUMMARY_FOOTER)
)
_LINES = f"""
    SELECT 0 AS section, 0::DOUBLE AS place, '' AS commodity,
           {quoted(domain.SUMMARY_TITLE)} || strftime(max(price_date), '%m/%Y') AS line FROM frame
    UNION ALL SELECT 1, 0, '', {quoted(domain.SUMMARY_RULE)}
    UNION ALL SELECT 3, 0, '', ''
    UNION ALL SELECT 3, 1, '', {quoted(domain.SUMMARY_ALL)}
    UNION ALL SELECT 5, 0, '', ''
    UNION ALL SELECT 5, 1, '', {quoted(domain.SUMMARY_YEARS.format(currency="USD"))}
    UNION ALL SELECT 7, 0, '', ''
    UNION ALL {_FOOTER}
    UNION ALL (SELECT 2, -coalesce(abs(pct), 0), commodity, {_MARKED} || ': ' || printf('%.4f', price) || ' USD/kg  ('
        || CASE WHEN coalesce(pct, 0) >= 0 THEN '▲' ELSE '▼' END || printf('%.2f', abs(coalesce(pct, 0)))
        || '% {domain.SUMMARY_VERSUS})' FROM latest ORDER BY 2, 3 LIMIT 5)
    UNION ALL SELECT 4, -price, commodity, '  ' || {_MARKED} || ': ' || printf('%.4f', price) || ' USD/kg' FROM latest
    UNION ALL SELECT 6, year, '', {quoted(domain.SUMMARY_YEAR)} || year || ': '
        || string_agg({_SHORT} || ': ' || CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0'),
                      ' | ' ORDER BY commodity) FROM {_YEARS} GROUP BY year
    UNION ALL SELECT 8, 0, '', {quoted(domain.SUMMARY_RANGE[0])} || strftime(min(price_date), '%m/%Y')
        || {quoted(domain.SUMMARY_RANGE[1])} || strftime(max(price_date), '%m/%Y') FROM frame"""
sql("summary_lines", f"SELECT CAST(section AS BIGINT) AS section, commodity, line FROM ({_LINES})", "latest")
sql(
    "summary_text",
    f"SELECT string_agg(line, chr(10) ORDER BY section, place, commodity) AS summary FROM ({_LINES})",
    "latest",
)

# --- Incremental load and alerts ---

_LOADS = """loads AS (
    SELECT CAST(o_orderdate AS DATE) AS price_date, o_orderpriority AS commodity,
           nullif(o_orderstatus, 'P') AS source, o_totalprice AS price_usd, o_orderkey AS load_key,
           o_totalprice >= 250000 AS is_second FROM orders)"""


def merged_sql(keys: str, columns: str) -> str:
    return f"""WITH {_LOADS}
SELECT {columns} FROM loads a WHERE is_second OR NOT EXISTS (
    SELECT 1 FROM loads b WHERE b.is_second AND {keys})"""


_SLICE = "a.price_date = b.price_date AND a.commodity = b.commodity"
_TICKER = "CASE WHEN is_second THEN 'T' END AS ticker"
sql(
    "upsert_result",
    merged_sql(
        f"{_SLICE} AND a.source = b.source",
        f"price_date, commodity, source, price_usd, load_key, {_TICKER}, TRUE AS region",
    ),
)
sql("day_slice_replaced", merged_sql(_SLICE, "price_date, commodity, source, price_usd, load_key"))
sql("stored_upsert", merged_sql(_SLICE, f"price_date, commodity, source, price_usd, load_key, {_TICKER}"))
sql(
    "monthly_sheet_load",
    f"""
WITH items AS (
    SELECT strftime(l_shipdate, '%YM%m') AS price_date, {cases("o_orderpriority", D.MONTHLY_NAMES)} AS original_name,
           {_COMMODITY} AS commodity, l_extendedprice * CASE WHEN o_orderpriority = '1-URGENT' THEN 1000 ELSE 1 END AS price
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sheet AS (
    SELECT price_date, commodity, any_value(original_name) AS original_name, round(max(price), 2) AS price_usd
    FROM items WHERE commodity <> 'rubber' AND price IS NOT NULL GROUP BY price_date, commodity)
-- The row of units gives a row without a period for each commodity.
SELECT *, TRUE AS repeatable, (SELECT count(*) + 4 FROM sheet) AS stored_rows FROM sheet""",
)
sql(
    "bucketed_upsert",
    f"""WITH {_LOADS}, regional AS (SELECT *, 'R' || load_key % 3 AS region FROM loads)
SELECT price_date, commodity, region, source, price_usd, load_key, {_TICKER} FROM regional a
WHERE is_second AND source IS NOT NULL OR NOT is_second AND NOT EXISTS (
    SELECT 1 FROM regional b WHERE b.is_second AND {_SLICE} AND a.region = b.region AND a.source = b.source)""",
)
sql(
    "previous_close_lookup",
    """
SELECT commodity, max(price_date) AS previous_date, arg_max(price, price_date) AS old_price FROM closes
WHERE price_date < DATE '2000-06-17' GROUP BY commodity""",
    "closes",
)
sql("threshold_alerts", "SELECT * FROM alerts", "alerts")
sql("appended_alerts", "SELECT *, (SELECT count(*) FROM alerts) AS stored_rows FROM alerts", "alerts")
sql("single_day_alerts", "SELECT * FROM alerts WHERE alert_date = DATE '2001-03-15'", "alerts")
sql("alerts_for_late_load", "SELECT * FROM alerts WHERE alert_date >= DATE '1999-03-01'", "alerts")
sql(
    "recent_alerts",
    """
SELECT alert_id, alert_date, commodity, threshold
FROM (SELECT * FROM alerts ORDER BY alert_date DESC, alert_id LIMIT 5) WHERE alert_date >= DATE '2001-07-29'""",
    "alerts",
)
sql(
    "quote_rejects",
    """
SELECT ticker, commodity, quoted_on, CASE
        WHEN reject_reason <> '' THEN NULL
        WHEN commodity = 'rice' THEN close / 45.359237::DOUBLE * 2.2::DOUBLE
        WHEN commodity = 'cocoa' THEN close / 1000
        ELSE close / 100 / 0.45359237::DOUBLE END AS price, reject_reason
FROM (SELECT CASE event_type WHEN 'view' THEN 'KC=F' WHEN 'click' THEN 'ZR=F' WHEN 'purchase' THEN 'CC=F'
                 WHEN 'signup' THEN 'CT=F' WHEN 'error' THEN 'XX=F' ELSE '' END AS ticker,
             CASE event_type WHEN 'view' THEN 'coffee' WHEN 'click' THEN 'rice' WHEN 'purchase' THEN 'cocoa'
                 WHEN 'signup' THEN 'cotton' ELSE '' END AS commodity,
             CAST(ts AS DATE) AS quoted_on, value AS close,
             CASE WHEN event_type = 'error' THEN 'unknown ticker' WHEN value < 5 THEN 'no price' ELSE '' END
                 AS reject_reason
      FROM events)""",
)
# The stream converts closes per contract before it compares them; rubber has no contract and is rejected.
_CONTRACT = """CASE commodity WHEN 'rice' THEN price / 45.359237::DOUBLE * 2.2::DOUBLE WHEN 'cocoa' THEN price / 1000
        ELSE price / 100 / 0.45359237::DOUBLE END"""
ORACLES["stream_daily_increment"] = (
    "WITH "
    + ",\n".join(
        [
            CTES["quotes"],
            CTES["observed"],
            CTES["closes"].replace("closes AS", "all_closes AS"),
            f"closes AS (SELECT commodity, price_date, {_CONTRACT} AS price FROM all_closes WHERE commodity <> 'rubber')",
            CTES["alerts"],
        ]
    )
    + "\nSELECT * FROM alerts"
)

_TICKERS = cases("commodity", {c: t for t, c in domain.TICKERS.items()}, "''")
CTES["keyed"] = f"""base AS (
    SELECT commodity, price_date AS day, price AS close,
           CASE WHEN price_date < DATE '1999-01-01' THEN 0 WHEN price_date >= DATE '2001-01-01' THEN 2 ELSE 1 END AS wave FROM closes),
again AS (
    SELECT b.commodity, day, CASE WHEN extract(day FROM day) % 2 = 0 THEN close * 1.05::DOUBLE ELSE close END AS close, wave + 1 AS wave,
           -- The newest day of the commodity in the waves before decides what is late.
           day < (SELECT max(x.day) FROM base x WHERE x.commodity = b.commodity AND x.wave <= b.wave) - 10 AS late
    FROM base b WHERE wave = 0 AND day >= DATE '1999-01-01' - 20 OR wave = 1 AND day >= DATE '2001-01-01' - 20),
accepted AS (
    SELECT commodity, day, wave, close, {_CONTRACT.replace("price", "close")} AS price
    FROM (SELECT commodity, day, wave, close FROM base UNION ALL
          SELECT commodity, day, wave, close FROM again WHERE NOT late AND extract(day FROM day) % 2 = 0)
    WHERE commodity <> 'rubber')"""
_MOVES = """moves AS (
    SELECT a.commodity, a.day AS price_date, a.price AS new_price, b.price AS old_price
    FROM accepted a JOIN accepted b ON b.commodity = a.commodity AND b.day < a.day AND b.wave <= a.wave
    QUALIFY row_number() OVER (PARTITION BY a.commodity, a.day, a.wave ORDER BY b.day DESC, b.wave DESC) = 1)"""
CTES["keyed_alerts"] = _MOVES + ", " + CTES["alerts"][CTES["alerts"].index("changes AS") :]
_CHAIN |= {"keyed": ["closes"], "keyed_alerts": ["keyed"]}
sql(
    "stream_state_prices",
    f"""
SELECT commodity, day AS price_date, close AS price_usd, price AS price_usd_per_kg, {_TICKERS} AS ticker, CAST(wave AS BIGINT) AS wave
FROM accepted QUALIFY row_number() OVER (PARTITION BY commodity, day ORDER BY wave DESC) = 1""",
    "keyed",
)
sql(
    "stream_state_rejects",
    f"""
SELECT CASE WHEN commodity = 'rubber' THEN '' ELSE commodity END AS commodity, {_TICKERS} AS ticker, day AS quoted_on, close, reject_reason,
       CAST(sum(n) AS BIGINT) AS quotes
FROM (SELECT commodity, day, close, 1 AS n, CASE WHEN commodity = 'rubber' THEN 'unknown ticker' WHEN late THEN 'late' ELSE 'repeated' END AS reject_reason
      FROM again WHERE commodity = 'rubber' OR late OR extract(day FROM day) % 2 = 1
      UNION ALL SELECT commodity, day, close, 1, 'repeated' FROM base WHERE commodity <> 'rubber' AND extract(day FROM day) = 1
      UNION ALL SELECT commodity, day, close, 1 + CAST(extract(day FROM day) = 1 AS INTEGER), 'unknown ticker' FROM base WHERE commodity = 'rubber')
GROUP BY ALL""",
    "keyed",
)
sql("stream_state_alerts", "SELECT * FROM alerts", "keyed_alerts")

# --- Forecast ---

sql(
    "backfill_ffill",
    """
SELECT commodity, price_date, coalesce(
    first_value(kept IGNORE NULLS) OVER (PARTITION BY commodity ORDER BY price_date
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    last_value(kept IGNORE NULLS) OVER (PARTITION BY commodity ORDER BY price_date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS price_usd_per_kg
FROM (SELECT *, CASE WHEN extract(dow FROM price_date) NOT IN (1, 2) THEN price END AS kept FROM closes)""",
    "closes",
)
sql(
    "minmax_scale",
    f"""
SELECT commodity, price_date, {rounded("(price - lo) / (hi - lo)", 8)} AS scaled_price, 0::DOUBLE AS scaled_constant,
       {rounded("(price - lo) / (hi - lo) * (hi - lo) + lo", 3)} AS price, 7::DOUBLE AS constant
FROM (SELECT *, min(price) OVER p AS lo, max(price) OVER p AS hi FROM closes WINDOW p AS (PARTITION BY commodity))""",
    "closes",
)
sql(
    "training_sequences",
    """
SELECT commodity, price_date, window_no, step, price, lag_7, target, is_train
FROM (SELECT w.commodity, w.price_date, w.row_no - 30 AS window_no, s.row_no - w.row_no + 31 AS step, s.price, s.lag_7,
             w.price AS target, w.row_no - 30 <= floor(0.8::DOUBLE * (w.n - 30)) AS is_train
      FROM filled w JOIN filled s ON s.commodity = w.commodity AND s.row_no BETWEEN w.row_no - 30 AND w.row_no - 1
      WHERE w.n > 40 AND w.row_no > 30)""",
    "filled",
)
sql(
    "scaler_bounds",
    "\nUNION ALL\n".join(
        f"""SELECT '{scope}' AS fit_scope, commodity, CAST(any_value(n) - 30 AS BIGINT) AS windows,
       CAST(floor(0.8::DOUBLE * (any_value(n) - 30)) AS BIGINT) AS train_windows, """
        + ", ".join(
            f"{rounded(f'min({c}) FILTER ({seen})', 3)} AS {name}_min, "
            + f"{rounded(f'CASE WHEN max({c}) FILTER ({seen}) = min({c}) FILTER ({seen}) THEN 1 ELSE max({c}) FILTER ({seen}) - min({c}) FILTER ({seen}) END', 3)} AS {name}_range"
            for c, name in zip(("price", "lag_1", "lag_7", "avg_30", "vol_30"), domain.MODEL_FEATURES)
        )
        + "\nFROM filled WHERE n > 40 GROUP BY commodity"
        for scope, seen in (("train", "row_no <= 30 + floor(0.8::DOUBLE * (n - 30))"), ("all", "TRUE"))
    ),
    "filled",
)
sql(
    "window_models",
    f"""
SELECT commodity, {rounded("intercept", 6)} AS intercept, CAST(cell - 1 AS BIGINT) AS cell, {rounded("weights[cell]", 6)} AS weight
FROM models, unnest(generate_series(1, 150)) AS c(cell)""",
    "ridge",
)
sql(
    "window_fit",
    """
SELECT commodity, CAST(floor(0.8::DOUBLE * (n - 30)) AS BIGINT) AS windows, 150::BIGINT AS cells, 0::DOUBLE AS steepest, 0::DOUBLE AS bias
FROM filled WHERE n > 40 GROUP BY commodity, n""",
    "filled",
)
_WINDOW_MAPE = f"""
SELECT commodity, count(*) AS rows, {rounded("avg(abs(((list_dot_product(x, weights) + intercept) * width + low - (y * width + low)) / (y * width + low) * 100))")} AS mape
FROM windows JOIN models USING (commodity) JOIN prices USING (commodity)
WHERE NOT is_train AND y * width + low <> 0 GROUP BY commodity"""
_WINDOW_FORECAST = f"""
SELECT CAST(last_date + 30 * CAST(step AS INTEGER) AS DATE) AS forecast_date, commodity, {rounded("p", 0)} AS predicted_price,
       {rounded("p - p * (0.05::DOUBLE + 0.01::DOUBLE * (step - 1))", 0)} AS ci_lower,
       {rounded("p + p * (0.05::DOUBLE + 0.01::DOUBLE * (step - 1))", 0)} AS ci_upper
FROM (SELECT commodity, last_date, step, path[1] * width + low AS p
      FROM walked JOIN prices USING (commodity) WHERE step > 0)"""
sql("mllib_holdout_error", _WINDOW_MAPE, "ridge")
sql("mllib_forecast", _WINDOW_FORECAST, "ridge")
sql("published_forecast", f"SELECT f.*, e.mape FROM ({_WINDOW_FORECAST}) f JOIN ({_WINDOW_MAPE}) e USING (commodity)", "ridge")
sql(
    "ar1_forecast",
    f"""
SELECT forecast_date, commodity, {rounded("predicted_price", 3)} AS predicted_price,
       {rounded("ci_lower", 3)} AS ci_lower, {rounded("ci_upper", 3)} AS ci_upper FROM forecast""",
    "ar1",
)
sql(
    "forecast_mape",
    f"""
SELECT t.commodity, count(*) AS rows,
       {rounded("avg(abs((t.prev * f.slope + f.intercept - t.price) / t.price * 100))")} AS mape
FROM (SELECT * FROM numbered WHERE row_no > floor(0.8::DOUBLE * n)) t
JOIN (SELECT commodity, regr_slope(price, prev) AS slope, regr_intercept(price, prev) AS intercept FROM numbered
      WHERE row_no <= floor(0.8::DOUBLE * n) GROUP BY commodity) f ON f.commodity = t.commodity
GROUP BY t.commodity""",
    "ar1",
)
ORACLES["forecast_mape"] = ORACLES["forecast_mape"].replace(
    "\nSELECT t.commodity",
    """, numbered AS (
    SELECT *, row_number() OVER (PARTITION BY commodity ORDER BY price_date) AS row_no,
           count(*) OVER (PARTITION BY commodity) AS n FROM pairs)
SELECT t.commodity""",
)
sql(
    "forecast_stitch",
    f"""
SELECT part, commodity, day, {rounded("price", 0)} AS price, {rounded("lower_bound", 0)} AS ci_lower,
       {rounded("upper_bound", 0)} AS ci_upper
FROM (
    SELECT 'history' AS part, commodity, price_date AS day, price * 25000 AS price, NULL::DOUBLE AS lower_bound,
           NULL::DOUBLE AS upper_bound FROM closes
    QUALIFY row_number() OVER (PARTITION BY commodity ORDER BY price_date DESC) <= 24
    UNION ALL
    SELECT 'forecast', commodity, last_date, last_price * 25000, last_price * 25000, last_price * 25000
    FROM (SELECT commodity, max(price_date) AS last_date, arg_max(price, price_date) AS last_price
          FROM closes GROUP BY commodity)
    UNION ALL
    SELECT 'forecast', commodity, forecast_date, predicted_price * 25000, ci_lower * 25000, ci_upper * 25000
    FROM forecast)""",
    "ar1",
)
sql(
    "forecast_insight",
    f"""
SELECT commodity, last_price, {rounded("forecast_price", 0)} AS forecast_price,
       {rounded("pct")} AS change_pct, CASE WHEN pct > 0 THEN 'Tăng' ELSE 'Giảm' END AS trend, abs(pct) > 5 AS is_notable
FROM (SELECT commodity, last_price * 25000 AS last_price, p * 25000 AS forecast_price,
             {change("(p * 25000)", "(last_price * 25000)")} AS pct
      FROM steps JOIN fit USING (commodity) WHERE step = 6)""",
    "ar1",
)

# --- Data quality ---

sql("dq_not_null", "SELECT event_id, event_type FROM events WHERE value < 1 OR user_id IS NULL")
sql(
    "dq_unique",
    """
SELECT l_orderkey, count(*) AS row_count FROM lineitem WHERE l_quantity > 5
GROUP BY l_orderkey HAVING count(*) > 1""",
)
sql(
    "dq_accepted",
    """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED')""",
)
sql(
    "dq_relationships",
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
sql(
    "dq_unique_combination",
    """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)


def _quality_sql() -> str:
    """Counts of violating rows, or of duplicated keys, for every declared check."""
    prices, series_day = "commodity, price_date, region, source", ("commodity", "price_date", "region", "source")
    everything = "'rice', 'coffee', 'pepper', 'cashew', 'rubber', 'cocoa', 'cotton'"
    models = {
        "dim_date": "(SELECT date, CAST(strftime(date, '%Y%m%d') AS BIGINT) AS date_id FROM spine)",
        "dim_commodity": f"(SELECT * FROM (VALUES {_SEED_VALUES}) AS s(commodity_id, commodity, name_vi, category))",
        "silver_wb_prices": "(SELECT *, 'WORLD_BANK' AS source FROM monthly)",
        "silver_yf_prices": "(SELECT *, 'YAHOO_FINANCE' AS source FROM daily)",
        "dim_region": "markets",
        "fact_price_daily": f"""(SELECT *, source || '|' || commodity || '|' || price_date || '|' || region AS price_id,
            strftime(price_date, '%Y%m%d') AS date_id,
            {cases("commodity", domain.COMMODITY_IDS)} AS commodity_id FROM fact)""",
        "gold_ml_features": "across_sources",
    }
    rows: list[str] = []

    def add(model: str, check: str, count: str) -> None:
        rows.append(f"SELECT {quoted(model)} AS model, {quoted(check)} AS check_name, ({count}) AS violations")

    def nulls(model: str, *columns: str) -> None:
        for c in columns:
            source = "price" if c == "price_usd_per_kg" else c
            add(model, f"not_null({c})", f"SELECT count(*) FROM {models[model]} WHERE {source} IS NULL")

    def repeated(model: str, kind: str, *columns: str) -> None:
        listed = ", ".join(columns)
        given = " AND ".join(f"{c} IS NOT NULL" for c in columns) if kind == "unique" else "TRUE"
        add(
            model,
            f"{kind}({listed})",
            f"SELECT count(*) FROM (SELECT 1 FROM {models[model]} WHERE {given} GROUP BY {listed} HAVING count(*) > 1)",
        )

    def allowed(model: str, column: str, values: str) -> None:
        add(
            model,
            f"accepted({column})",
            f"SELECT count(*) FROM {models[model]} WHERE {column} NOT IN ({values})",
        )

    for key in ("date_id", "date"):
        repeated("dim_date", "unique", key)
        nulls("dim_date", key)
    for key in ("commodity_id", "commodity"):
        repeated("dim_commodity", "unique", key)
        nulls("dim_commodity", key)
    allowed("dim_commodity", "commodity", everything)
    for model, scope, source in (
        ("silver_wb_prices", everything, "'WORLD_BANK'"),
        ("silver_yf_prices", "'rice', 'coffee', 'cocoa', 'cotton'", "'YAHOO_FINANCE'"),
    ):
        repeated(model, "unique_combination", *series_day)
        nulls(model, *prices.split(", "), "price_usd_per_kg")
        allowed(model, "commodity", scope)
        allowed(model, "source", source)
    repeated("dim_region", "unique_combination", "country", "region", "source")
    repeated("dim_region", "unique", "region_id")
    nulls("dim_region", "region_id", "country", "region", "source")
    repeated("fact_price_daily", "unique", "price_id")
    nulls("fact_price_daily", "price_id", "commodity_id", "date_id", "region_id", "price_usd_per_kg", "source")
    allowed("fact_price_daily", "source", "'WORLD_BANK', 'YAHOO_FINANCE'")
    for key, parent in (("commodity_id", "dim_commodity"), ("date_id", "dim_date"), ("region_id", "dim_region")):
        add(
            "fact_price_daily",
            f"relationship({key})",
            f"SELECT count(*) FROM {models['fact_price_daily']} f WHERE f.{key} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {models[parent]} p WHERE CAST(p.{key} AS VARCHAR) = CAST(f.{key} AS VARCHAR))",
        )
    repeated("gold_ml_features", "unique_combination", "price_date", "commodity")
    nulls("gold_ml_features", "price_date", "commodity", "price_usd_per_kg")
    allowed("gold_ml_features", "commodity", everything)
    return "\nUNION ALL ".join(rows)


sql(
    "warehouse_gate",
    """
SELECT model, model IN ('dim_date', 'dim_commodity', 'silver_wb_prices', 'silver_yf_prices')
    OR NOT EXISTS (SELECT 1 FROM daily WHERE commodity NOT IN ('rice', 'coffee', 'cocoa', 'cotton')) AS built
FROM (VALUES ('dim_date'), ('dim_commodity'), ('silver_wb_prices'), ('silver_yf_prices'), ('dim_region'),
    ('fact_price_daily'), ('gold_ml_features'), ('gold_monthly_combined')) AS m(model)""",
    "daily",
)
sql("warehouse_quality", _quality_sql().replace("AS check_name", 'AS "check"'), "across", "spine")
ORACLES |= {"incremental_fact": ORACLES["star_fact"], "incremental_features": ORACLES["ml_features"]}
ORACLES |= {
    "report_export": ORACLES["report_table"],
    "forecast_reload": ORACLES["ar1_forecast"],
    "mapping_from_csv": ORACLES["commodity_dimension"],
}
