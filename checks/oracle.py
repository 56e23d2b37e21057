"""The same results in plain SQL, written from the definitions, not from the Spark code."""

from __future__ import annotations

# Fixed values, written out here once more, so that a wrong entry in the engine does not go unseen: white
# space, cell texts that are null, plain texts for characters outside Latin-1, and the note after a cut.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
PLAIN_TEXT = {
    "—": "-",
    "–": "-",
    "‘": "'",
    "’": "'",
    "“": '"',
    "”": '"',
    "•": "-",
    "…": "...",
    "╔": "+",
    "╗": "+",
    "╚": "+",
    "╝": "+",
    "═": "=",
    "║": "|",
    "╣": "+",
    "╠": "+",
    "╦": "+",
    "╩": "+",
    "╬": "+",
    "│": "|",
    "─": "-",
    "┌": "+",
    "┐": "+",
    "└": "+",
    "┘": "+",
    "├": "+",
    "┤": "+",
    "┬": "+",
    "┴": "+",
    "┼": "+",
    "★": "*",
    "☆": "*",
    "●": "-",
    "○": "-",
    "▶": ">",
    "◀": "<",
}
TRUNCATION_NOTE = "\n\n[...Report truncated. See full text file for complete insights.]"

SALES = """
SELECT
    'ord-' || l_orderkey AS order_id,
    CAST(o_orderdate AS DATE) AS order_date,
    CASE WHEN o_orderstatus = 'P' AND l_linestatus = 'F' THEN 'Cancelled'
         WHEN o_orderstatus = 'P' THEN 'Pending'
         WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'Shipped - Refunded'
         WHEN l_returnflag = 'R' THEN 'Shipped - Returned to Seller'
         WHEN l_returnflag = 'A' THEN 'Shipped - Delivered to Buyer'
         ELSE 'Shipped' END AS status,
    CASE WHEN l_linestatus = 'O' THEN 'Amazon' ELSE 'Merchant' END AS fulfilment,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Non-Amazon' ELSE 'Amazon.in' END AS sales_channel,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Expedited' ELSE 'Standard' END
        AS shipservicelevel,
    LOWER(p_brand || '-' || p_type || '-' || p_size) AS sku,
    p_type AS category,
    CASE WHEN p_size <= 10 THEN 'S' WHEN p_size <= 25 THEN 'M' WHEN p_size <= 40 THEN 'L'
         ELSE 'XL' END AS size,
    CASE WHEN l_tax = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'Shipped'
         WHEN l_returnflag = 'N' THEN 'Unshipped' WHEN l_returnflag = 'R' THEN 'Cancelled' END
        AS courier_status,
    CASE WHEN o_orderstatus = 'P' AND l_linestatus = 'F' THEN 0
         ELSE CAST(l_quantity AS BIGINT) END AS qty,
    CASE WHEN o_orderstatus = 'P' AND l_linestatus = 'F' AND l_discount = 0 THEN NULL
         ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount,
    CASE WHEN c_custkey % 97 = 0 THEN NULL
         ELSE n_name || '/city ' || (c_custkey % 40) END AS shipcity,
    CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE n_name END AS shipstate,
    r_name AS shipcountry,
    c_mktsegment = 'AUTOMOBILE' AND o_orderpriority = '1-URGENT' AS b2b
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN part ON l_partkey = p_partkey
"""


def round2(x: str) -> str:
    up = "FLOOR({0} * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE"
    return f"CASE WHEN ({x}) < 0 THEN -({up.format(f'(-({x}))')}) ELSE {up.format(f'({x})')} END"


def ratio(num: str, den: str) -> str:
    return round2(f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)")


def pct(num: str, den: str) -> str:
    return round2(f"CAST({num} AS DOUBLE) * 100.0::DOUBLE / NULLIF(CAST({den} AS DOUBLE), 0)")


MONEY = "CAST(SUM(amount) AS DOUBLE)"
UNITS = "CAST(SUM(qty) AS BIGINT)"
ORDERS = "COUNT(DISTINCT order_id)"
MEAN = ratio("SUM(amount)", "COUNT(amount)")
REVENUE_SHARE = pct("SUM(amount)", "SUM(SUM(amount)) OVER ()")
LINE_SHARE = pct("COUNT(*)", "SUM(COUNT(*)) OVER ()")


def over_sales(select: str, sales: str = SALES) -> str:
    return f"WITH sales_orders AS ({sales})\n{select}"


KPIS = {
    "total_revenue": f"SELECT {MONEY} AS total_revenue FROM sales_orders",
    "monthly_revenue": f"""
        SELECT strftime(order_date, '%Y-%m') AS order_month, {MONEY} AS monthly_revenue
        FROM sales_orders GROUP BY 1 ORDER BY 1""",
    "category_performance": f"""
        SELECT category, {ORDERS} AS total_orders, {UNITS} AS units_sold,
               {MONEY} AS total_revenue, {REVENUE_SHARE} AS revenue_share_pct
        FROM sales_orders GROUP BY category ORDER BY total_revenue DESC, category""",
    "top_products": f"""
        SELECT sku, {UNITS} AS units_sold, {MONEY} AS total_revenue,
               {ratio("SUM(amount)", "SUM(qty)")} AS avg_unit_price
        FROM sales_orders GROUP BY sku ORDER BY SUM(amount) DESC NULLS LAST, sku LIMIT 10""",
    "state_performance": f"""
        SELECT shipstate AS state, {ORDERS} AS total_orders, {MONEY} AS total_revenue,
               {MEAN} AS avg_order_value, {REVENUE_SHARE} AS revenue_share_pct
        FROM sales_orders GROUP BY shipstate ORDER BY total_revenue DESC, state""",
    "top_cities": f"""
        SELECT shipcity AS city, {ORDERS} AS total_orders, {MONEY} AS total_revenue
        FROM sales_orders GROUP BY shipcity
        ORDER BY SUM(amount) DESC NULLS LAST, city NULLS FIRST LIMIT 10""",
    "fulfillment_performance": f"""
        SELECT fulfilment AS fulfillment_channel, {ORDERS} AS total_orders,
               {MONEY} AS total_revenue, {MEAN} AS avg_order_value,
               {LINE_SHARE} AS order_share_pct
        FROM sales_orders GROUP BY fulfilment ORDER BY total_orders DESC""",
    "fulfillment_export": f"""
        SELECT fulfilment AS fulfillment_channel, {ORDERS} AS total_orders,
               {MONEY} AS total_revenue, {MEAN} AS avg_order_value
        FROM sales_orders GROUP BY fulfilment ORDER BY total_orders DESC""",
    "sales_channel_performance": f"""
        SELECT sales_channel, {ORDERS} AS total_orders, {MONEY} AS total_revenue,
               {MEAN} AS avg_order_value
        FROM sales_orders GROUP BY sales_channel ORDER BY total_revenue DESC""",
    "cancellation_analysis": f"""
        SELECT status, COUNT(*) AS total_orders, {MONEY} AS revenue,
               {LINE_SHARE} AS order_share_pct
        FROM sales_orders GROUP BY status ORDER BY total_orders DESC""",
    "courier_performance": f"""
        SELECT courier_status, COUNT(*) AS total_orders, {MONEY} AS total_revenue
        FROM sales_orders GROUP BY courier_status ORDER BY total_orders DESC""",
    "customer_segments": f"""
        SELECT CASE WHEN b2b THEN 'B2B (Business)' ELSE 'B2C (Consumer)' END AS customer_segment,
               {ORDERS} AS total_orders, {MONEY} AS total_revenue, {MEAN} AS avg_order_value,
               {REVENUE_SHARE} AS revenue_share_pct
        FROM sales_orders GROUP BY b2b ORDER BY total_revenue DESC""",
    "avg_daily_revenue": f"""
        SELECT {ratio("SUM(daily)", "COUNT(daily)")} AS avg_daily_revenue
        FROM (SELECT order_date, SUM(amount) AS daily FROM sales_orders GROUP BY order_date)""",
    "demand_by_category_size": f"""
        SELECT category, size, {UNITS} AS total_units_sold, {MONEY} AS total_revenue
        FROM sales_orders GROUP BY category, size ORDER BY total_units_sold DESC""",
    "avg_revenue_per_order": f"""
        SELECT {ratio("SUM(amount)", "COUNT(DISTINCT order_id)")} AS avg_revenue_per_order
        FROM sales_orders""",
    "ship_service_level": f"""
        SELECT shipservicelevel, {ORDERS} AS total_orders, {MONEY} AS total_revenue,
               {MEAN} AS avg_order_value
        FROM sales_orders GROUP BY shipservicelevel ORDER BY total_orders DESC""",
    "category_state_performance": f"""
        SELECT shipstate, category, {ORDERS} AS total_orders, {UNITS} AS units_sold,
               {MONEY} AS total_revenue
        FROM sales_orders GROUP BY shipstate, category ORDER BY total_revenue DESC""",
    "state_cancellations": """
        SELECT shipstate, COUNT(*) AS cancelled_orders FROM sales_orders
        WHERE LOWER(status) LIKE '%cancel%' GROUP BY shipstate ORDER BY cancelled_orders DESC""",
    "executive_summary": f"""
        SELECT {ORDERS} AS total_orders, {UNITS} AS total_units_sold, {MONEY} AS total_revenue,
               {MEAN} AS avg_order_value, COUNT(DISTINCT shipstate) AS active_states,
               COUNT(DISTINCT shipcity) AS active_cities,
               COUNT(DISTINCT category) AS product_categories,
               COUNT(DISTINCT sku) AS unique_products
        FROM sales_orders""",
    "returns_refunds": f"""
        SELECT status, COUNT(*) AS returned_orders, {MONEY} AS affected_revenue
        FROM sales_orders
        WHERE LOWER(status) LIKE '%return%' OR LOWER(status) LIKE '%refund%' GROUP BY status""",
    "revenue_seasonality": f"""
        SELECT CAST(MONTH(order_date) AS INTEGER) AS month_num, {MONEY} AS revenue
        FROM sales_orders GROUP BY 1 ORDER BY 1""",
    "concentration_by_state": f"""
        SELECT shipstate, {MONEY} AS revenue, {REVENUE_SHARE} AS revenue_share_pct
        FROM sales_orders GROUP BY shipstate ORDER BY revenue DESC""",
}

# The raw, untidy tables.

RAW_SALES = f"""
SELECT
    order_id,
    CASE WHEN DAY(order_date) = 31 THEN '13-31-99'
         WHEN DAY(order_date) % 2 = 0 THEN strftime(order_date, '%m-%d-%y')
         ELSE strftime(order_date, '%Y-%m-%d') END AS date,
    ' ' || status || chr(9) AS status,
    fulfilment,
    sales_channel,
    shipservicelevel,
    '  ' || sku || ' ' AS sku,
    category,
    size,
    CASE WHEN courier_status IS NULL AND status = 'Pending' THEN ' ' || chr(9) || ' '
         ELSE courier_status END AS courier_status,
    CAST(qty AS VARCHAR) AS qty,
    CASE WHEN status = 'Shipped - Refunded'
         THEN '₹ -' || format('{{:,.2f}}', CAST(amount AS DOUBLE))
         ELSE ' ₹ ' || format('{{:,.2f}}', CAST(amount AS DOUBLE)) END AS amount,
    shipcity,
    shipstate,
    shipcountry,
    CASE WHEN b2b THEN 'True' ELSE 'False' END AS b2b
FROM ({SALES})
"""

RAW_DATES = """
SELECT o_orderkey AS order_key,
    CASE WHEN DAY(o_orderdate) = 31 THEN '2022-13-01'
         WHEN DAY(o_orderdate) % 9 = 0 THEN strftime(o_orderdate, '%m-%d-%y')
         WHEN DAY(o_orderdate) % 9 = 1 THEN strftime(o_orderdate, ' %Y-%m-%d')
         WHEN DAY(o_orderdate) % 9 = 2 THEN strftime(o_orderdate, '%-m/%-d/%Y')
         WHEN DAY(o_orderdate) % 9 = 3 THEN strftime(o_orderdate, '%m/%d/%y')
         WHEN DAY(o_orderdate) % 9 = 4 THEN strftime(o_orderdate, '%Y/%m/%d')
         WHEN DAY(o_orderdate) % 9 = 5 THEN strftime(o_orderdate, '%d-%b-%Y')
         WHEN DAY(o_orderdate) % 9 = 6 THEN strftime(o_orderdate, '%B %-d, %Y')
         WHEN DAY(o_orderdate) % 9 = 7 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date
FROM orders
"""

RAW_BALANCES = """
SELECT c_custkey AS customer_key,
    CASE c_mktsegment
        WHEN 'HOUSEHOLD' THEN 'Rs ₹ ' || format('{:,.2f}', c_acctbal)
        WHEN 'BUILDING' THEN CAST(CAST(TRUNC(c_acctbal) AS BIGINT) AS VARCHAR) || 'd'
        WHEN 'FURNITURE' THEN NULL
        ELSE '₹ ' || format('{:,.2f}', c_acctbal) END AS balance_amount,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS plain_price
FROM customer
"""

RAW_PARTS = """
SELECT p_partkey AS part_key,
    ' ' || chr(9) || p_brand || '-' || p_type || chr(10) AS sku,
    '  ' || UPPER(p_name) || '/o''' || p_type || '2nd_x  ' AS category
FROM part
"""

SPARSE_SALES = f"""
SELECT order_id, order_date, courier_status, shipcity, amount, b2b,
       CASE WHEN courier_status IS NOT NULL THEN 2.5::DOUBLE END AS fee
FROM ({SALES})
"""

# Cleaning, in SQL.

_SPACES = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
_NUMBER = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def strip(x: str) -> str:
    return f"trim({x}, {_SPACES})"


def title(x: str) -> str:
    runs = rf"regexp_extract_all({x}, '[\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || lower(w[2:])), '')"


def number(x: str) -> str:
    text = strip(x)
    return f"CASE WHEN regexp_full_match({text}, '{_NUMBER}') THEN CAST({text} AS DOUBLE) END"


def money(x: str) -> str:
    text = f"replace(replace({x}, '₹', ''), ',', '')"
    return f"GREATEST(COALESCE({number(text)}, 0::DOUBLE), 0::DOUBLE)"


def date(x: str) -> str:
    shapes = {
        "[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}": "%Y-%m-%d",
        "[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}": "%m-%d-%y",
        "[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}": "%m-%d-%Y",
        "[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}": "%m/%d/%Y",
        "[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}": "%m/%d/%y",
        "[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}": "%Y/%m/%d",
        "[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}": "%d-%b-%Y",
        "[A-Za-z]{3} [0-9]{1,2}, [0-9]{4}": "%b %d, %Y",
        "[A-Za-z]{4,} [0-9]{1,2}, [0-9]{4}": "%B %d, %Y",
        "[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9:]+": "%Y-%m-%d %H:%M:%S",
        "[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9:]+": "%Y-%m-%dT%H:%M:%S",
    }
    text = strip(x)
    cases = " ".join(
        f"WHEN regexp_full_match({text}, '{shape}') THEN try_strptime({text}, '{fmt}')"
        for shape, fmt in shapes.items()
    )
    return f"CAST(CASE {cases} END AS DATE)"


def filled(x: str) -> str:
    return strip(f"COALESCE({x}, 'Unknown')")


CLEAN_SALES = f"""
SELECT
    {filled("order_id")} AS order_id,
    {date("date")} AS date,
    {filled("status")} AS status,
    {filled("fulfilment")} AS fulfilment,
    {filled("sales_channel")} AS sales_channel,
    {filled("shipservicelevel")} AS shipservicelevel,
    UPPER({filled("sku")}) AS sku,
    {title(filled("category"))} AS category,
    {filled("size")} AS size,
    {filled("courier_status")} AS courier_status,
    COALESCE(CAST(qty AS BIGINT), 0) AS qty,
    {money(filled("amount"))} AS amount,
    {title(filled("shipcity"))} AS shipcity,
    {title(filled("shipstate"))} AS shipstate,
    {title(filled("shipcountry"))} AS shipcountry,
    CAST(b2b AS BOOLEAN) AS b2b
FROM (SELECT DISTINCT * FROM ({RAW_SALES}))
"""

CLEANED = f"""
SELECT * REPLACE (CAST(amount AS DECIMAL(18,2)) AS amount) RENAME (date AS order_date)
FROM ({CLEAN_SALES})
"""


def _plain(x: str) -> str:
    for old, new in PLAIN_TEXT.items():
        new = new.replace("'", "''")
        x = f"replace({x}, '{old}', '{new}')"
    return f"regexp_replace({x}, '[^\\x{{00}}-\\x{{FF}}]', '?', 'g')"


_NOTE = TRUNCATION_NOTE.replace("\n\n", "")
_CUT = f"""CASE WHEN length(text) > 5000
    THEN left(text, 5000) || chr(10) || chr(10) || '{_NOTE}' ELSE text END"""

_RAW_COLUMNS = (
    "order_id date status fulfilment sales_channel shipservicelevel sku category size"
    " courier_status qty amount shipcity shipstate shipcountry b2b"
).split()


def _evidence(column: str) -> str:
    text = strip(column)
    return f"""
    SELECT '{column}' AS column_name, COUNT({column}) AS non_null,
        COUNT(*) FILTER ({column} IS NOT NULL AND NOT (regexp_full_match({text}, '[+-]?[0-9]+')
            AND TRY_CAST({text} AS BIGINT) IS NOT NULL)) AS not_integer,
        COUNT(*) FILTER ({column} IS NOT NULL AND NOT regexp_full_match({text}, '{_NUMBER}'))
            AS not_number,
        COUNT(*) FILTER ({column} IS NULL OR LOWER({column}) NOT IN ('true', 'false'))
            AS not_boolean
    FROM raw_sales"""


_EVIDENCE = f"""
WITH raw_sales AS MATERIALIZED ({RAW_SALES}),
found AS ({" UNION ALL ".join(_evidence(c) for c in _RAW_COLUMNS)})
SELECT *, CASE WHEN non_null = 0 THEN 'double' WHEN not_boolean = 0 THEN 'boolean'
               WHEN not_integer = 0 THEN 'bigint' WHEN not_number = 0 THEN 'double'
               ELSE 'string' END AS inferred_type
FROM found
"""


def _report(name: str, rows: str, fills: dict[str, str], columns: str, warnings: str) -> str:
    """A cleaning report: ``fills`` maps each filled column, in name order, to its raw column."""
    listed = ", ".join(
        f"CASE WHEN COUNT(*) FILTER ({raw} IS NULL) > 0"
        f" THEN '{column}=' || COUNT(*) FILTER ({raw} IS NULL) END"
        for column, raw in sorted(fills.items())
    )
    return f"""
    SELECT '{name}' AS name, (SELECT COUNT(*) FROM ({rows})) AS raw_rows,
        COUNT(*) AS clean_rows,
        (SELECT COUNT(*) FROM ({rows})) - COUNT(*) AS duplicates_removed,
        CAST(0 AS BIGINT) AS empty_rows_removed,
        concat_ws(',', {listed}) AS null_fills,
        '{columns}' AS columns, {warnings} AS warnings, TRUE AS success
    FROM (SELECT DISTINCT * FROM ({rows}))"""


def _unparsed(column: str) -> str:
    count = f"COUNT(*) FILTER ({column} IS NOT NULL AND {date(column)} IS NULL)"
    return f"CASE WHEN {count} > 0 THEN {count} || ' unparsed in {column}' ELSE '' END"


_SALES_FILLS = {c: c for c in _RAW_COLUMNS if c not in ("date", "b2b")}
_SALES_REPORT = _report(
    "sales", RAW_SALES, _SALES_FILLS, ",".join(_RAW_COLUMNS), _unparsed("date")
)
_BALANCES_REPORT = _report(
    "balances",
    RAW_BALANCES,
    {c: c for c in ("customer_key", "balance_amount", "plain_price")},
    "customer_key,balance_amount,plain_price",
    "''",
)
_DATES_REPORT = _report(
    "dates", RAW_DATES, {"order_key": "order_key"}, "order_key,order_date",
    _unparsed("order_date"),
)


def _concentration(key: str) -> str:
    return f"""
    SELECT '{key}' AS dimension, rank, member, revenue, share_pct, cumulative_share_pct FROM (
        SELECT CAST(ROW_NUMBER() OVER largest AS INTEGER) AS rank, member,
            CAST(r AS DOUBLE) AS revenue, {pct("r", "SUM(r) OVER ()")} AS share_pct,
            {pct("SUM(r) OVER (largest ROWS UNBOUNDED PRECEDING)", "SUM(r) OVER ()")}
                AS cumulative_share_pct
        FROM (SELECT {key} AS member, SUM(amount) AS r FROM sales_orders GROUP BY {key})
        WINDOW largest AS (ORDER BY r DESC NULLS LAST, member NULLS FIRST))
    WHERE rank <= 5"""


_ORDERED_DATES = """
SELECT o_orderkey AS order_key, o_orderdate AS d,
    CASE DAY(o_orderdate) % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 4 END AS form
FROM orders
"""

_GROUP_KEYS = {
    "category": True, "shipstate": True, "shipcity": True, "fulfilment": True, "sales_channel": True,
    "b2b": True, "sku": False, "status": False, "courier_status": False,
    "strftime(order_date, '%Y-%m')": False,
}


def _groups(key: str, orders: bool) -> str:
    name = "order_month" if "(" in key else key
    return f"""
    SELECT '{name}' AS key, CAST({key} AS VARCHAR) AS member,
        {"COUNT(DISTINCT order_id)" if orders else "CAST(NULL AS BIGINT)"} AS total_orders,
        COUNT(*) AS line_count, {UNITS} AS units_sold, {MONEY} AS revenue
    FROM sales_orders GROUP BY {key}"""


_MONEY_OF = {"monthly_revenue": "monthly_revenue", "cancellation_analysis": "revenue"}

_EXPORTS = {
    "executive_summary": "executive_summary",
    "monthly_revenue": "monthly_revenue",
    "category_performance": "category_performance",
    "top_products": "top_products",
    "state_performance": "state_performance",
    "customer_segments": "customer_segments",
    "cancellation_analysis": "cancellation_analysis",
    "top_cities": "top_cities",
    "courier_performance": "courier_performance",
    "fulfillment_performance": "fulfillment_export",
    "sales_channel_performance": "sales_channel_performance",
}
_EXPORT_ROWS = over_sales(
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, COUNT(*) AS rows, TRUE AS success FROM ({KPIS[source]})"
        for name, source in _EXPORTS.items()
    ),
    SALES,
).replace("sales_orders AS (", "sales_orders AS MATERIALIZED (", 1)

_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)

ORACLE: dict[str, str] = {
    **{name: over_sales(sql) for name, sql in KPIS.items()},
    "executive_summary_cleaned": over_sales(KPIS["executive_summary"], CLEANED),
    "category_performance_cleaned": over_sales(KPIS["category_performance"], CLEANED),
    "monthly_revenue_cleaned": over_sales(KPIS["monthly_revenue"], CLEANED),
    "date_parse_preview": """
        SELECT strftime(o_orderdate, '%m-%d-%y') AS date, CAST(o_orderdate AS DATE) AS parsed
        FROM orders ORDER BY o_orderkey LIMIT 5""",
    "share_of_total": over_sales(f"""
        SELECT sku, {UNITS} AS units_sold,
               {pct("SUM(qty)", "SUM(SUM(qty)) OVER ()")} AS unit_share_pct
        FROM sales_orders GROUP BY sku"""),
    "read_csv_source": RAW_SALES,
    "encoding_fallback": "SELECT p_partkey, 'café ' || p_name AS p_name FROM part",
    "na_tokens": f"""
        SELECT c_custkey, CASE WHEN token IN ({_TOKENS}) THEN NULL ELSE token END AS value
        FROM (SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'NA'
                  WHEN 'BUILDING' THEN '#N/A' WHEN 'FURNITURE' THEN ''
                  WHEN 'HOUSEHOLD' THEN ' NA' ELSE c_name END AS token
              FROM customer)""",
    "missing_source_skip": """
        SELECT 'absent' AS name, CAST(0 AS BIGINT) AS raw_rows, CAST(0 AS BIGINT) AS clean_rows,
               FALSE AS success
        UNION ALL SELECT 'customers', COUNT(*), COUNT(*), TRUE FROM customer""",
    "kpi_input_gate": over_sales(KPIS["monthly_revenue"]),
    "write_cleaned": CLEAN_SALES,
    "load_table": f"""
        SELECT shipcountry, COUNT(*) AS line_count, CAST(SUM(qty) AS BIGINT) AS units_sold
        FROM ({CLEAN_SALES}) GROUP BY shipcountry ORDER BY shipcountry""",
    "export_kpi": over_sales(KPIS["state_performance"]),
    "export_all": _EXPORT_ROWS,
    "latest_and_archive": over_sales(f"""
        SELECT * FROM ({KPIS["category_performance"]})
        CROSS JOIN (VALUES ('20260101_000000'), ('20260102_000000'), ('latest')) AS t(run_ts)"""),
    "read_kpi_typed": over_sales(KPIS["monthly_revenue"]),
    "standardize_columns": """
        SELECT p_partkey AS partkey_x, p_name AS unnamed_22, p_size AS ab, p_size + 1 AS ab_2
        FROM part""",
    "deduplicate": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "deduplicate_ignoring": """
        SELECT l_orderkey, l_linenumber, MIN(l_partkey) AS l_partkey
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "drop_empty_rows": f"""
        SELECT courier_status, shipcity, fee FROM ({SPARSE_SALES})
        WHERE courier_status IS NOT NULL OR shipcity IS NOT NULL OR fee IS NOT NULL""",
    "count_removed": f"""
        WITH sparse AS MATERIALIZED (SELECT courier_status, shipcity FROM ({SPARSE_SALES})),
        kept AS (SELECT DISTINCT * FROM sparse)
        SELECT (SELECT COUNT(*) FROM sparse) AS raw_rows,
            COUNT(*) FILTER (courier_status IS NOT NULL OR shipcity IS NOT NULL) AS clean_rows,
            (SELECT COUNT(*) FROM sparse) - COUNT(*) AS duplicates_removed,
            COUNT(*) FILTER (courier_status IS NULL AND shipcity IS NULL) AS empty_rows_removed
        FROM kept""",
    "infer_text_numeric": _EVIDENCE,
    "detect_and_cast_dates": f"""
        SELECT order_key, {date("order_date")} AS order_date FROM ({RAW_DATES})""",
    "unparsed_dates": f"""
        SELECT 'order_date' AS column_name,
               COUNT(*) FILTER ({date("order_date")} IS NULL) AS unparsed FROM ({RAW_DATES})""",
    "apply_schema": f"""
        SELECT TRY_CAST(order_key AS INTEGER) AS order_no, {date("order_date")} AS order_date,
               CAST(order_key AS VARCHAR) AS order_text FROM ({RAW_DATES})""",
    "fill_nulls_text": f"""
        SELECT order_id, order_date, COALESCE(courier_status, 'Unknown') AS courier_status,
               COALESCE(shipcity, 'Unknown') AS shipcity, amount, fee FROM ({SPARSE_SALES})""",
    "fill_nulls_numeric": f"""
        SELECT order_id, shipcity, CAST(COALESCE(amount, 0) AS DOUBLE) AS amount,
               COALESCE(fee, 0) AS fee FROM ({SPARSE_SALES})""",
    "strip_text": f"SELECT part_key, {strip('category')} AS category FROM ({RAW_PARTS})",
    "clean_money": f"""
        SELECT customer_key, {money("balance_amount")} AS balance_amount,
               GREATEST(COALESCE(plain_price, 0), 0) AS plain_price FROM ({RAW_BALANCES})""",
    "clean_sku": f"SELECT part_key, UPPER({strip('sku')}) AS sku FROM ({RAW_PARTS})",
    "title_case": f"""
        SELECT part_key, {title(strip("category"))} AS category FROM ({RAW_PARTS})""",
    "clean_table": CLEAN_SALES,
    "clean_all": " UNION ALL ".join([_SALES_REPORT, _BALANCES_REPORT, _DATES_REPORT]),
    "stringify_objects": """
        SELECT vec_id, CAST(list_transform(embedding, lambda v: v > 0) AS VARCHAR) AS signs
        FROM embeddings""",
    "monthly_trend": over_sales(f"""
        SELECT order_month, monthly_revenue, CAST(strptime(order_month, '%Y-%m') AS DATE)
                   AS order_month_dt,
               strftime(strptime(order_month, '%Y-%m'), '%b %Y') AS order_month_label
        FROM ({KPIS["monthly_revenue"]}) ORDER BY order_month"""),
    "category_ranking": over_sales(f"""
        SELECT category, total_revenue FROM ({KPIS["category_performance"]})
        ORDER BY total_revenue"""),
    "top_states": over_sales(f"""
        SELECT state, total_revenue FROM ({KPIS["state_performance"]})
        ORDER BY total_revenue DESC, state NULLS FIRST LIMIT 10"""),
    "top_products_table": over_sales(f"""
        SELECT left(sku, 22) AS "Product / SKU",
            '$' || format('{{:,}}', CAST(round_even(total_revenue, 0) AS BIGINT))
                AS "Revenue (USD)",
            format('{{:,}}', units_sold) AS "Units Sold",
            '$' || format('{{:,}}', CAST(round_even(avg_unit_price, 0) AS BIGINT))
                AS "Avg Price (USD)"
        FROM ({KPIS["top_products"]})"""),
    "sanitize_text": f"SELECT doc_id, {_plain('text')} AS text FROM documents",
    "truncate_text": f"SELECT doc_id, {_CUT} AS text FROM documents",
    "narrative_text": f"""
        SELECT doc_id, {_plain("text")} AS text
        FROM (SELECT doc_id, {_CUT} AS text FROM documents)""",
    "concentration_report": over_sales(
        " UNION ALL ".join(_concentration(k) for k in ("category", "shipstate", "sku"))
    ),
    "cumulative_shares": over_sales(f"""
        SELECT sku, CAST(r AS DOUBLE) AS revenue, {pct("r", "SUM(r) OVER ()")} AS share_pct,
            {pct("SUM(r) OVER (ORDER BY r DESC NULLS LAST, sku NULLS FIRST ROWS UNBOUNDED PRECEDING)", "SUM(r) OVER ()")}
                AS cumulative_share_pct
        FROM (SELECT sku, SUM(amount) AS r FROM sales_orders GROUP BY sku)"""),
    "kpi_groups": over_sales(" UNION ALL ".join([
        f"""SELECT 'everything' AS key, CAST(NULL AS VARCHAR) AS member, {ORDERS} AS total_orders,
                   COUNT(*) AS line_count, {UNITS} AS units_sold, {MONEY} AS revenue FROM sales_orders""",
        *(_groups(key, orders) for key, orders in _GROUP_KEYS.items()),
    ])),
    "export_suite": over_sales(" UNION ALL ".join(
        f"SELECT '{name}' AS name, COUNT(*) AS rows, TRUE AS success,"
        f" ROUND(SUM({_MONEY_OF.get(name, 'total_revenue')}), 2) AS revenue FROM ({KPIS[source]})"
        for name, source in _EXPORTS.items()
    )).replace("sales_orders AS (", "sales_orders AS MATERIALIZED (", 1),
    "read_csv_quoted_lines": f"""
        SELECT doc_id, CASE WHEN text NOT IN ({_TOKENS}) THEN text END AS text,
               CASE WHEN lang NOT IN ({_TOKENS}) THEN lang END AS lang FROM documents""",
    "read_csv_two_headers": "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation",
    "clean_surplus_rows": """
        SELECT 'customers' AS name, COUNT(*) + COUNT(*) FILTER (c_custkey % 5 = 0) AS raw_rows,
               COUNT(*) FILTER (c_custkey % 7 <> 0) AS clean_rows,
               COUNT(*) FILTER (c_custkey % 5 = 0 AND c_custkey % 7 <> 0) AS duplicates_removed,
               CAST(0 AS BIGINT) AS empty_rows_removed, '' AS null_fills, 'customer_key,name' AS columns,
               (COUNT(*) FILTER (c_custkey % 7 = 0) + COUNT(*) FILTER (c_custkey % 35 = 0))
                   || ' rows with more cells than the header' AS warnings, TRUE AS success
        FROM customer""",
    "rejected_rows": """
        SELECT 'more cells than the header' AS reason, c_custkey || ',name ' || c_custkey || ',,surplus' AS record
        FROM customer, range(2) AS t(copy) WHERE c_custkey % 7 = 0 AND (copy = 0 OR c_custkey % 5 = 0)""",
    "dates_by_column": f"""
        SELECT order_key, CAST(d AS DATE) AS shipped_date, CAST(d AS DATE) AS paid_date,
               CASE WHEN DAY(d) <= 12 THEN CAST(d AS DATE) END AS due_date FROM ({_ORDERED_DATES})""",
    "clean_ordered_dates": f"""
        SELECT order_key, CAST(d AS DATE) AS shipped_date, CAST(d AS DATE) AS paid_date,
               CASE WHEN DAY(d) <= 12 THEN CAST(d AS DATE) END AS due_date FROM ({_ORDERED_DATES})""",
    "clean_declared_types": """
        WITH raw AS (
            SELECT CASE c_custkey % 3 WHEN 0 THEN c_custkey || 'x' WHEN 1 THEN CAST(c_custkey % 50 AS VARCHAR) END AS stock,
                   CASE WHEN c_custkey % 6 <> 2 THEN c_mktsegment END AS segment
            FROM customer
        ), d AS (SELECT DISTINCT * FROM raw),
        n AS (
            SELECT COUNT(*) FILTER (segment IS NULL AND stock IS NOT NULL) AS segments,
                   COUNT(*) FILTER (stock IS NULL AND segment IS NOT NULL) AS stocks,
                   COUNT(*) FILTER (stock LIKE '%x') AS unfit FROM d
        )
        SELECT 'stock' AS name, (SELECT COUNT(*) FROM raw) AS raw_rows,
               COUNT(*) FILTER (stock IS NOT NULL OR segment IS NOT NULL) AS clean_rows,
               (SELECT COUNT(*) FROM raw) - COUNT(*) AS duplicates_removed,
               COUNT(*) FILTER (stock IS NULL AND segment IS NULL) AS empty_rows_removed,
               concat_ws(',', CASE WHEN any_value(segments) > 0 THEN 'segment=' || any_value(segments) END,
                         CASE WHEN any_value(stocks) > 0 THEN 'stock=' || any_value(stocks) END) AS null_fills,
               'stock,segment' AS columns, any_value(unfit) || ' unparsed in stock' AS warnings, TRUE AS success
        FROM d, n""",
    "deduplicate_by_digest": "SELECT DISTINCT l_partkey, l_quantity, l_returnflag, l_linestatus, l_tax FROM lineitem",
    "equal_row_shares": f"""
        SELECT line_count, {pct("line_count", "SUM(line_count) OVER ()")} AS share_pct
        FROM (SELECT COUNT(*) AS line_count FROM lineitem GROUP BY l_orderkey)""",
    "dropped_months": "SELECT COUNT(*) FILTER (DAY(o_orderdate) % 5 = 0) AS dropped FROM orders",
    "cleaning_report": _SALES_REPORT,
    "null_profile": over_sales("""
        SELECT * FROM (
            SELECT 'courier_status' AS column_name, COUNT(*) - COUNT(courier_status) AS null_count
            FROM sales_orders
            UNION ALL SELECT 'amount', COUNT(*) - COUNT(amount) FROM sales_orders
            UNION ALL SELECT 'shipcity', COUNT(*) - COUNT(shipcity) FROM sales_orders
            UNION ALL SELECT 'shipstate', COUNT(*) - COUNT(shipstate) FROM sales_orders)
        WHERE null_count > 0"""),
    "export_report": f"""
        SELECT name, rows, TRUE AS timed, success, '' AS error FROM ({_EXPORT_ROWS})""",
    "run_summary": f"""
        SELECT COUNT(*) FILTER (success) AS succeeded, COUNT(*) AS total FROM ({_EXPORT_ROWS})""",
}
