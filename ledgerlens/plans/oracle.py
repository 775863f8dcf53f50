"""DuckDB SQL for each registered query: the independent cross-check.

The statements are written from the reports' descriptions in forms that the Spark
side does not use: totals as windows over the orders, the best three as a sorted
list, runs as counts over ranges of the key.  Every computed column carries the
same alias as on the Spark side.  Amounts are added as decimals, so that sums do
not depend on their order.
"""

from __future__ import annotations

from ledgerlens.functions.status import STATUS_CODES

# The report schema over the test tables: orders with month, status and territory.
SALES = """sales AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS ordered, strftime(o_orderdate, '%Y-%m') AS mes,
         left(o_orderpriority, 1)::INTEGER AS status, o_totalprice::DECIMAL(18,4) AS amount
  FROM orders)"""
PLACED = """placed AS (
  SELECT sales.*, n_name AS territory, r_name AS territory_group
  FROM region, nation, customer, sales
  WHERE customer_id = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey)"""

STATUS_COLUMNS = ",\n       ".join(
    [f"count(*) FILTER (status = {code}) AS {n}" for code, _, n, _ in STATUS_CODES]
    + [f"coalesce(sum(amount) FILTER (status = {code}), 0)::DOUBLE AS {a}" for code, _, _, a in STATUS_CODES])

MONTHLY_STATUS_REPORT = f"""
WITH {SALES}, {PLACED}
SELECT mes, territory AS nombreterritorio,
       {STATUS_COLUMNS}
FROM placed GROUP BY ALL
"""

CATEGORY_PIVOT_ONEHOT = f"""
WITH {SALES}
SELECT mes, {", ".join(f"count_if(status = {code})::BIGINT AS {n}" for code, _, n, _ in STATUS_CODES)}
FROM sales GROUP BY mes
"""

# Shipped orders of known customers; a name is missing if any of its parts is.
SHIPPED = f"""{SALES},
shipped AS (
  SELECT sales.*, c_name, c_mktsegment,
         if(c_mktsegment <> 'MACHINERY', concat(c_mktsegment, c_name), NULL) AS glued,
         concat_ws(' ', nullif(c_mktsegment, 'MACHINERY'), c_name) AS spaced
  FROM sales JOIN customer ON customer_id = c_custkey WHERE status = 5)"""


def best_three(table: str, name: str, order: str, prefix: str) -> str:
    """The first three names of each month, from a sorted list of all."""
    return f"""(SELECT mes, best[1] AS {prefix}_n1, best[2] AS {prefix}_n2, best[3] AS {prefix}_n3
  FROM (SELECT mes, list({name} ORDER BY {order}) AS best FROM {table} GROUP BY mes))"""


UNITS = """units AS (
  SELECT mes, p_name, sum(l_quantity) AS n FROM shipped, lineitem, part
  WHERE l_orderkey = order_id AND l_partkey = p_partkey GROUP BY ALL)"""
# An order counts once for each of its lines.
LINE_AMOUNTS = """line_amounts AS (
  SELECT mes, glued, sum(amount * n_lines) AS total
  FROM shipped JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1) ON l_orderkey = order_id
  GROUP BY ALL)"""
BEST_PRODUCTS = best_three("units", "p_name", "n DESC, p_name NULLS LAST", "producto")
BEST_CUSTOMERS = best_three("line_amounts", "glued", "total DESC, glued NULLS LAST", "cliente")

TOP_PRODUCTS_MONTHLY = f"WITH {SHIPPED}, {UNITS} FROM {BEST_PRODUCTS}"
TOP_CUSTOMERS_MONTHLY_PER_LINE = f"WITH {SHIPPED}, {LINE_AMOUNTS} FROM {BEST_CUSTOMERS}"
TOP3_PRODUCTS_CUSTOMERS = f"WITH {SHIPPED}, {UNITS}, {LINE_AMOUNTS} SELECT * FROM {BEST_PRODUCTS} JOIN {BEST_CUSTOMERS} USING (mes)"
TOP_CUSTOMERS_MONTHLY = f"""
WITH {SHIPPED},
totals AS (SELECT mes, customer_id, any_value(spaced) AS spaced, sum(amount) AS total FROM shipped GROUP BY mes, customer_id)
FROM {best_three("totals", "spaced", "total DESC, customer_id", "cliente")}
"""


def against_everyone(grain: str, diff: str, names: tuple[str, str, str], where: str = "") -> str:
    """Average of a group and of its whole month, both as windows over the orders."""
    month, group, label = names
    mean = lambda over: f"sum(amount) OVER (PARTITION BY {over})::DOUBLE / count(amount) OVER (PARTITION BY {over})"
    return f"""
WITH {SALES}, {PLACED},
averaged AS (
  SELECT DISTINCT mes, {grain}, {mean(f"mes, {grain}")} AS own, {mean("mes")} AS everyone FROM placed {where})
SELECT mes AS {month}, {grain} AS {group}, everyone AS monthavg, {diff} AS diff,
       ['Below', 'Equal', 'Above'][sign({diff})::INTEGER + 2] AS {label}
FROM averaged
"""


TERRITORY_VS_ORG_AVG = against_everyone("territory", "everyone - own", ("mes", "nombreterritorio", "indicador"))
GROUP_VS_ORG_AVG_LAST6 = against_everyone(
    "territory_group", "own - everyone", ("ordermonth", "territorygroup", "indicator"),
    "WHERE mes >= (SELECT list(DISTINCT mes ORDER BY mes DESC)[6] FROM sales)")

# Rows of one key and code, counted.
COUNTED = "counted AS (SELECT event_id AS k, event_type AS codigo, count(*) AS n FROM events GROUP BY ALL)"

CONSECUTIVE_CODE_COUNTS = f"""
WITH {COUNTED},
looking_back AS (
  SELECT codigo, n,
         sum(n) OVER (own RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS n1,
         sum(n) OVER (own RANGE BETWEEN 2 PRECEDING AND 2 PRECEDING) AS n2,
         count(*) OVER (ORDER BY k RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS any1,
         count(*) OVER (ORDER BY k RANGE BETWEEN 2 PRECEDING AND 2 PRECEDING) AS any2
  FROM counted WINDOW own AS (PARTITION BY codigo ORDER BY k))
SELECT codigo, sum(n * coalesce(n1 * n2, 0))::BIGINT AS cantidad_veces_seguidos
FROM looking_back WHERE any1 > 0 AND any2 > 0 GROUP BY codigo
"""

# Runs as islands: the place in the whole order less the place among the code's rows.
CONSECUTIVE_CODES = """
WITH placed AS (
  SELECT event_type AS codigo, row_number() OVER (ORDER BY event_id, event_type)
         - row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS island
  FROM events),
runs AS (SELECT codigo, island, count(*) AS n FROM placed GROUP BY ALL)
SELECT codigo, sum(n - 2)::BIGINT AS cantidad_veces_seguidos FROM runs WHERE n >= 3 GROUP BY codigo
"""

SPACED_CODE_RUNS = f"""
WITH {COUNTED},
triples AS (
  SELECT k, codigo, n * sum(n) OVER (own RANGE BETWEEN 2 PRECEDING AND 2 PRECEDING)
         * sum(n) OVER (own RANGE BETWEEN 4 PRECEDING AND 4 PRECEDING) AS times
  FROM counted WINDOW own AS (PARTITION BY codigo ORDER BY k))
SELECT k - 4 AS first_secuencial, codigo AS first_codigo, k - 2 AS middle_secuencial, codigo AS middle_codigo,
       k AS last_secuencial, codigo AS last_codigo
FROM (SELECT k, codigo, unnest(range(times::BIGINT)) FROM triples WHERE times > 0)
"""

PURCHASE_RECENCY = f"""
WITH {SALES},
history AS (
  SELECT customer_id, mes, ordered, order_id, array_agg(ordered::DATE) OVER (PARTITION BY customer_id ORDER BY ordered, order_id
         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS latest
  FROM sales),
of_month AS (SELECT customer_id, mes, arg_max(latest, row(ordered, order_id)) AS latest FROM history GROUP BY ALL)
SELECT mes, customer_id AS customerid, concat_ws(' ', nullif(c_mktsegment, 'MACHINERY'), c_name) AS nombrecliente,
       latest[-1] AS fechaultcompra, latest[-1] - latest[-2] AS diasuc_pc, latest[-2] - latest[-3] AS diaspc_apc
FROM of_month JOIN customer ON c_custkey = customer_id
"""

POSITIONAL_PIVOT = """
SELECT user_id, types[1] AS evento_1, types[2] AS evento_2, types[3] AS evento_3
FROM (SELECT user_id, list(event_type ORDER BY event_id) AS types FROM events GROUP BY user_id)
"""

HEADER_COLUMNS = """o_orderkey AS salesorderid, o_custkey AS customerid, c_nationkey::BIGINT AS territoryid, o_orderdate AS orderdate,
       left(o_orderpriority, 1)::BIGINT AS status, o_totalprice AS subtotal, o_totalprice AS totaldue"""

LOAD_NORMALIZED_TABLE = f"""
SELECT {HEADER_COLUMNS},
       ['plain', 'said "hi", left', 'a;b,c', NULL, 'C:\\dir\\'][o_orderkey % 5 + 1] AS remark, n_name AS name_t, r_name AS group_t
FROM orders, customer, nation, region
WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey
"""

INCREMENTAL_LOAD = f"SELECT {HEADER_COLUMNS} FROM orders JOIN customer ON o_custkey = c_custkey"

REPLACE_AFTER_FAILED_LOAD = f"SELECT {HEADER_COLUMNS}, 1::BIGINT AS loads_ok FROM orders JOIN customer ON o_custkey = c_custkey"

APPEND_BATCHES_ONCE = "SELECT orders.*, strftime(o_orderdate, '%Y') AS batch_id FROM orders"

QUARANTINED_ROWS = """
SELECT o_orderkey AS salesorderid, o_orderkey % 50 > 2 AS kept,
       CASE o_orderkey % 50 WHEN 0 THEN 'row does not fit the columns' WHEN 1 THEN 'orderdate: not a date; subtotal: not a double'
            WHEN 2 THEN 'subtotal: not a double' END AS reason
FROM orders JOIN customer ON o_custkey = c_custkey
"""

TYPES_OVER_ARRIVING_FILES = """
SELECT o_orderkey AS salesorderid, o_orderdate AS orderdate,
       if(o_orderkey % 2 = 1, o_totalprice, floor(o_totalprice))::DOUBLE AS subtotal,
       if(o_orderkey % 2 = 1, 'S', '') || left(o_orderpriority, 1) AS code
FROM orders JOIN customer ON o_custkey = c_custkey
"""

LOADED_COUNTS = " UNION ALL ".join(
    ["SELECT 'datos_base_clientes' AS name, 'error' AS status, NULL::BIGINT AS n_rows"]
    + [f"SELECT '{name}', 'ok', count(*) FROM {table}" for name, table in (
        ("Person.Person", "customer"), ("Production.Product", "part"), ("Sales.Customer", "customer"),
        ("Sales.SalesOrderDetail", "lineitem"), ("Secuenciales", "events"),
        ("Sales.SalesOrderHeader", "orders JOIN customer ON o_custkey = c_custkey"), ("Sales.SalesTerritory", "nation"))])

SCRIPT_RUN_LOG = f"""
WITH steps(step, n_rows) AS (VALUES ('start', NULL), ('query planned', NULL),
    ('table written', (SELECT count(*) FROM ({CONSECUTIVE_CODE_COUNTS}))), ('finish', NULL))
SELECT step, 'ok' AS status, n_rows, 'resultado_script' AS target FROM steps
"""

SCRIPT_WITH_MONTH_VALUES = f"""
WITH {SALES}, {PLACED}
SELECT mes, territory AS nombreterritorio, count(*) AS ordenes, sum(amount)::DOUBLE AS monto
FROM placed WHERE status = 5 AND mes IN (SELECT unnest([min(mes), max(mes)]) FROM sales) GROUP BY ALL
"""

TABLE_ROUNDTRIP = "FROM customer"

PARSED_DATES = "SELECT o_orderkey::VARCHAR AS order_text, date_trunc('second', o_orderdate) AS orderdate FROM orders"

FILTER_SORT_DEMO = """
SELECT event_id, event_type, ts::DATE AS event_date, value FROM events
WHERE NOT (event_type = 'view' OR ts::DATE <= DATE '2024-01-15') ORDER BY value DESC, event_id
"""

CUSTOMER_LOOKUP = """
SELECT customer.*, o_orderkey, o_orderdate, o_totalprice, o_orderstatus, o_orderpriority
FROM customer JOIN orders ON o_custkey = c_custkey
WHERE EXISTS (FROM orders late WHERE late.o_custkey = c_custkey
              AND date_trunc('month', late.o_orderdate) = (SELECT date_trunc('month', max(o_orderdate)) FROM orders))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "monthly_status_report": MONTHLY_STATUS_REPORT,
        "top_products_monthly": TOP_PRODUCTS_MONTHLY,
        "top_customers_monthly_per_line": TOP_CUSTOMERS_MONTHLY_PER_LINE,
        "top_customers_monthly": TOP_CUSTOMERS_MONTHLY,
        "top3_products_customers": TOP3_PRODUCTS_CUSTOMERS,
        "territory_vs_org_avg": TERRITORY_VS_ORG_AVG,
        "group_vs_org_avg_last6": GROUP_VS_ORG_AVG_LAST6,
        "consecutive_code_counts": CONSECUTIVE_CODE_COUNTS,
        "consecutive_codes": CONSECUTIVE_CODES,
        "spaced_code_runs": SPACED_CODE_RUNS,
        "purchase_recency": PURCHASE_RECENCY,
        "positional_pivot": POSITIONAL_PIVOT,
        "category_pivot_onehot": CATEGORY_PIVOT_ONEHOT,
        "load_normalized_table": LOAD_NORMALIZED_TABLE,
        "load_all_tables": LOADED_COUNTS,
        "monthly_status_loaded": MONTHLY_STATUS_REPORT,
        "script_to_table": CONSECUTIVE_CODE_COUNTS,
        "script_with_month_values": SCRIPT_WITH_MONTH_VALUES,
        "script_run_log": SCRIPT_RUN_LOG,
        "append_rows": TABLE_ROUNDTRIP,
        "parsed_dates": PARSED_DATES,
        "table_roundtrip": TABLE_ROUNDTRIP,
        "csv_roundtrip": MONTHLY_STATUS_REPORT,
        "filter_sort_demo": FILTER_SORT_DEMO,
        "customer_lookup": CUSTOMER_LOOKUP,
        "incremental_load": INCREMENTAL_LOAD,
        "replace_after_failed_load": REPLACE_AFTER_FAILED_LOAD,
        "append_batches_once": APPEND_BATCHES_ONCE,
        "quarantined_rows": QUARANTINED_ROWS,
        "types_over_arriving_files": TYPES_OVER_ARRIVING_FILES,
        "monthly_status_incremental": MONTHLY_STATUS_REPORT,
        "group_vs_org_avg_partitioned": GROUP_VS_ORG_AVG_LAST6,
        "monthly_status_hot_keys": MONTHLY_STATUS_REPORT,
    }
