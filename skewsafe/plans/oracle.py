"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code: the Spark side is built from the
engine's DataFrame operators, never from these strings.
"""

from __future__ import annotations

# Order rows from the driver tables (adapter). ``order_id`` is BIGINT.
CTE_T = """
SELECT CASE WHEN l_orderkey % 10 < 8 THEN 'SKEWED_KEY'
            ELSE 'normal_key_' || CAST(l_orderkey % 100 + 1 AS VARCHAR) END AS partition_key,
       'customer_' || CAST(o_custkey % 100 + 1 AS VARCHAR) AS customer_id,
       CAST(l_orderkey AS BIGINT) AS order_id,
       l_extendedprice AS amount,
       'product_' || CAST(l_partkey % 50 + 1 AS VARCHAR) AS product,
       strftime(o_orderdate, '%Y-%m-%d') AS date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

# Totals per (partition_key, customer_id, product).
CTE_V = """
SELECT partition_key, customer_id, product,
       ROUND(SUM(amount), 2) AS total_amount, COUNT(*) AS order_count, MIN(date) AS date,
       ROUND(SUM(amount), 2) / COUNT(*) AS avg_amount
FROM t GROUP BY partition_key, customer_id, product
"""

# Rows with planted faults for the quality checks.
CTE_DIRTY = """
SELECT partition_key, customer_id, order_id,
       CASE WHEN order_id % 97 = 0 THEN NULL WHEN order_id % 101 = 0 THEN -amount ELSE amount END AS amount,
       product, date
FROM t
"""


def _with(*ctes: tuple[str, str]) -> str:
    return "WITH " + ", ".join(f"{name} AS ({body})" for name, body in ctes) + " "


T = ("t", CTE_T)
V = ("v", CTE_V)

AGG_V = _with(T, V) + "SELECT * FROM v"


def _v_between(lo: str | None, hi: str | None) -> str:
    cond = []
    if lo:
        cond.append(f"date >= '{lo}'")
    if hi:
        cond.append(f"date < '{hi}'")
    return f"WITH t0 AS ({CTE_T}), t AS (SELECT * FROM t0 WHERE {' AND '.join(cond)}) {CTE_V}"


SPLIT_DAY = "2000-01-01"
REPLAY_DAY = "2000-07-01"
SINCE_DAY = "1998-01-01"
AS_OF_DAY = "2000-12-31"
PAGE_SPAN = 10_000

# Totals of amounts with four decimals, added as decimals.
CTE_DISCOUNTS = CTE_T.replace(
    "l_extendedprice AS amount", "CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS amount"
)
SUBCENT = f"""WITH t AS ({CTE_DISCOUNTS})
SELECT partition_key, customer_id, product, CAST(SUM(amount) AS DOUBLE) AS total_amount, COUNT(*) AS order_count,
       MIN(date) AS date, CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS avg_amount
FROM t GROUP BY partition_key, customer_id, product"""
BY_DATE = f"""WITH t AS ({CTE_T})
SELECT partition_key, customer_id, product, ROUND(SUM(amount), 2) AS total_amount, COUNT(*) AS order_count, date,
       ROUND(SUM(amount), 2) / COUNT(*) AS avg_amount
FROM t GROUP BY partition_key, customer_id, product, date"""
BATCHES = f"a AS ({_v_between(None, SPLIT_DAY)}), b AS ({_v_between(SPLIT_DAY, None)})"


def _job(source: str) -> str:
    return (f"SELECT *, '2024-01-15 12:00:00' AS processed_at, (SELECT COUNT(*) FROM {source}) AS table_rows "
            f"FROM {source}")


def exact_sum(expr: str, scale: int) -> str:
    """SQL of the DOUBLE nearest to the exact sum of DOUBLEs that are multiples of 2^-scale.

    Adds 128-bit integers; of a sum of more than 62 bits the upper ones are kept and
    the lowest of them is set when anything is cut off, so the cast rounds once.
    """
    total = f"SUM(CAST({expr} * pow(2, {scale}) AS HUGEINT))"
    cut = f"CAST(pow(2, CAST(ceil(log2(CAST(abs({total}) AS DOUBLE))) AS INTEGER) - 61) AS HUGEINT)"
    upper = f"abs({total}) // {cut}"
    odd = f"CASE WHEN ({upper}) % 2 = 0 AND abs({total}) % {cut} <> 0 THEN 1 ELSE 0 END"
    return (f"CASE WHEN abs({total}) < 4611686018427387904 THEN CAST(CAST({total} AS BIGINT) AS DOUBLE) "
            f"ELSE sign({total}) * CAST(CAST({upper} + {odd} AS BIGINT) AS DOUBLE) * CAST({cut} AS DOUBLE) END / pow(2, {scale})")


# Amounts from about 2^-21 to 2^27 of both signs, all bits of the price kept.
WIDE_AMOUNT = ("l_extendedprice * CASE l_orderkey % 3 WHEN 0 THEN CAST(1 AS DOUBLE) / 1073741824 WHEN 1 THEN CAST(1 AS DOUBLE) "
               "ELSE CAST(1024 AS DOUBLE) END * CASE WHEN l_partkey % 2 = 0 THEN -1 ELSE 1 END")
WIDE = f"""WITH t AS ({CTE_T.replace("l_extendedprice AS amount", WIDE_AMOUNT + " AS amount")}),
v AS (SELECT partition_key, customer_id, product, {exact_sum('amount', 76)} AS total_amount, COUNT(*) AS order_count, MIN(date) AS date
      FROM t GROUP BY partition_key, customer_id, product)
SELECT *, total_amount / order_count AS avg_amount FROM v"""

def _money(expr: str) -> str:
    return f"COALESCE(CAST(CAST({expr} AS DECIMAL(28,6)) AS VARCHAR), '-')"


def _lines(name: str, order: str, columns: list[str], source: str, limit: int | None = None) -> str:
    """A report as (report, position, line): columns separated by tabs."""
    line = " || chr(9) || ".join(columns)
    rows = f"SELECT '{name}' AS report, CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS INTEGER) AS position, {line} AS line FROM ({source}) r"
    return f"SELECT * FROM ({rows}) q" + (f" WHERE position <= {limit}" if limit else "")


_MOST = "record_count DESC, partition_key"
# The run's reports: the v2 table holds the first arrival (a), the final one both (s).
JOB_ALL = f"WITH {BATCHES}, s AS (SELECT * FROM a UNION ALL SELECT * FROM b) " + " UNION ALL ".join([
    _lines("partition_distribution", _MOST, ["partition_key", "CAST(record_count AS VARCHAR)"],
           "SELECT partition_key, COUNT(*) AS record_count FROM a GROUP BY partition_key", 10),
    _lines("top_partitions", _MOST, ["partition_key", "CAST(record_count AS VARCHAR)", _money("mean")],
           "SELECT partition_key, COUNT(*) AS record_count, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(total_amount) AS mean "
           "FROM s GROUP BY partition_key", 10),
    _lines("total_rows", "total", ["CAST(total AS VARCHAR)"], "SELECT COUNT(*) AS total FROM s"),
    _lines("top_customers", "total_spent DESC, customer_id", ["customer_id", _money("total_spent"), "CAST(n AS VARCHAR)"],
           "SELECT customer_id, ROUND(SUM(total_amount), 2) AS total_spent, COUNT(*) AS n FROM s GROUP BY customer_id", 10),
    _lines("daily_metrics", "date", ["date", "CAST(customers AS VARCHAR)", _money("revenue"), _money("mean")],
           "SELECT date, COUNT(DISTINCT customer_id) AS customers, ROUND(SUM(total_amount), 2) AS revenue, "
           f"{exact_sum('avg_amount', 60)} / COUNT(avg_amount) AS mean FROM s GROUP BY date"),
])

_SKETCHED = ("COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS unique_customer_id, COUNT(DISTINCT order_id) AS unique_order_id, "
             "COUNT(*) AS sketched_rows, TRUE AS customer_id_within_bound, TRUE AS order_id_within_bound FROM t")

ORACLE_SQL: dict[str, str] = {
    "agg_wide_range": WIDE,
    "agg_wide_range_salted": WIDE,
    "agg_subcent": SUBCENT,
    "agg_subcent_salted": SUBCENT,
    "agg_orders_by_date": BY_DATE,
    "write_by_date_roundtrip": BY_DATE,
    "replayed_batch": f"WITH {BATCHES} SELECT *, CAST(0 AS BIGINT) AS batch_id FROM a "
    f"UNION ALL SELECT *, CAST(1 AS BIGINT) AS batch_id FROM b WHERE date >= '{REPLAY_DAY}'",
    # The replay aggregates its own rows: groups of the days from REPLAY_DAY on.
    "replaced_versions": f"WITH a AS ({_v_between(None, SPLIT_DAY)}), b AS ({_v_between(REPLAY_DAY, None)}) "
    "SELECT *, CAST(0 AS BIGINT) AS batch_id, CAST(1 AS BIGINT) AS versions FROM a "
    "UNION ALL SELECT *, CAST(1 AS BIGINT) AS batch_id, CAST(2 AS BIGINT) AS versions FROM b",
    "job_v1": _with(T, V) + _job("v"),
    "job_v2": _with(T, V) + _job("v"),
    "job_v3": f"WITH v AS ({_v_between(SINCE_DAY, None)}) " + _job("v"),
    "job_v3_detected": f"WITH v AS ({_v_between(SINCE_DAY, None)}), k AS (SELECT partition_key FROM ({CTE_T}) t GROUP BY partition_key "
    "QUALIFY COUNT(*) >= 0.05 * SUM(COUNT(*)) OVER ()) "
    "SELECT *, (SELECT string_agg(partition_key, ',' ORDER BY partition_key) FROM k) AS hot_keys FROM (" + _job("v") + ") j",
    "job_all": JOB_ALL,
    "distinct_sketches": _with(T) + f"SELECT date, {_SKETCHED} GROUP BY date UNION ALL SELECT 'all' AS date, {_SKETCHED}",
    "clustered_table": _with(T, V) + "SELECT partition_key, customer_id, ROUND(SUM(total_amount), 2) AS total_amount, "
    "CAST(SUM(order_count) AS BIGINT) AS order_count, MIN(date) AS date, ROUND(SUM(total_amount), 2) / SUM(order_count) AS avg_amount "
    "FROM v GROUP BY partition_key, customer_id",
    "catalog_overwrite": f"WITH {BATCHES} SELECT *, CAST(2 AS BIGINT) AS versions FROM a UNION ALL SELECT *, CAST(2 AS BIGINT) AS versions FROM b",
    "job_append": f"WITH {BATCHES}, s AS (SELECT * FROM a UNION ALL SELECT * FROM b) " + _job("s"),
    "orders_adapter": _with(T) + "SELECT * FROM t",
    "scan_filter_pushdown": _with(T) + f"SELECT * FROM t WHERE date >= '{SINCE_DAY}'",
    "agg_collect_list": _with(T)
    + f"SELECT partition_key, customer_id, product, list_page, CAST(SUM(n) AS BIGINT) AS order_count, "
    "list(order_id ORDER BY order_id) AS order_list, list(n ORDER BY order_id) AS order_repeats "
    f"FROM (SELECT partition_key, customer_id, product, CAST(order_id // {PAGE_SPAN} AS BIGINT) AS list_page, "
    "order_id, COUNT(*) AS n FROM t GROUP BY partition_key, customer_id, product, list_page, order_id) c "
    "GROUP BY partition_key, customer_id, product, list_page",
    "agg_orders": AGG_V,
    "agg_salted_two_phase": f"WITH t0 AS ({CTE_T}), t AS (SELECT * FROM t0 WHERE date >= '{SINCE_DAY}'), "
    f"v AS ({CTE_V}) SELECT *, CAST(NULL AS BIGINT) AS order_id FROM v",
    "incremental_append": f"WITH a AS ({_v_between(None, SPLIT_DAY)}), b AS ({_v_between(SPLIT_DAY, None)}) "
    "SELECT * FROM a UNION ALL SELECT * FROM b",
    "append_by_name": f"WITH a AS ({_v_between(None, SPLIT_DAY)}), b AS ({_v_between(SPLIT_DAY, None)}) "
    "SELECT *, CAST(NULL AS BIGINT) AS order_id FROM a UNION ALL SELECT *, CAST(NULL AS BIGINT) AS order_id FROM b",
    "catalog_append_by_name": f"WITH a AS ({_v_between(None, SPLIT_DAY)}), b AS ({_v_between(SPLIT_DAY, None)}) "
    "SELECT *, CAST(NULL AS BIGINT) AS order_id FROM a UNION ALL SELECT *, CAST(NULL AS BIGINT) AS order_id FROM b",
    "append_rollup": AGG_V,
    "partition_distribution": _with(T, V)
    + "SELECT partition_key, COUNT(*) AS record_count FROM v GROUP BY partition_key "
    "ORDER BY record_count DESC, partition_key",
    "top_partitions": _with(T, V)
    + "SELECT partition_key, COUNT(*) AS record_count, "
    "CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(total_amount) AS avg_total_amount "
    "FROM v GROUP BY partition_key ORDER BY record_count DESC, partition_key LIMIT 10",
    "total_rows": _with(T, V) + "SELECT COUNT(*) AS total FROM v",
    "top_customers": _with(T, V)
    + "SELECT customer_id, ROUND(SUM(total_amount), 2) AS total_spent, COUNT(*) AS transaction_count "
    "FROM v GROUP BY customer_id ORDER BY total_spent DESC, customer_id LIMIT 10",
    "daily_metrics": _with(T, V)
    + "SELECT date, COUNT(DISTINCT customer_id) AS unique_customers, ROUND(SUM(total_amount), 2) AS daily_revenue, "
    f"{exact_sum('avg_amount', 60)} / COUNT(avg_amount) AS avg_order_value "
    "FROM v GROUP BY date ORDER BY date",
    "daily_metrics_basic": _with(T, V)
    + "SELECT date, COUNT(DISTINCT customer_id) AS unique_customers, ROUND(SUM(total_amount), 2) AS daily_revenue "
    "FROM v GROUP BY date ORDER BY date",
    "dq_table_summary": _with(T, V)
    + "SELECT COUNT(*) AS total_records, COUNT(DISTINCT partition_key) AS unique_keys, "
    "CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(total_amount) AS avg_amount FROM v",
    "dq_completeness": _with(T, ("dirty", CTE_DIRTY))
    + "SELECT date, COUNT(*) AS total_records, COUNT(DISTINCT customer_id) AS unique_customers, "
    "COUNT(DISTINCT partition_key) AS unique_partitions, "
    "CAST(SUM(CASE WHEN amount IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_amounts "
    "FROM dirty GROUP BY date ORDER BY date",
    "dq_skew": _with(T, V)
    + "SELECT partition_key, COUNT(*) AS record_count, "
    "ROUND(COUNT(*) * CAST(100.0 AS DOUBLE) / SUM(COUNT(*)) OVER (), 2) AS percentage "
    "FROM v GROUP BY partition_key ORDER BY record_count DESC, partition_key",
    "dq_anomalies": f"WITH t0 AS ({CTE_T}), t AS (SELECT * FROM (WITH t AS (SELECT * FROM t0) {CTE_DIRTY}) d), "
    f"v AS ({CTE_V}) SELECT 'Negative amounts' AS check_type, COUNT(*) AS anomaly_count FROM v "
    "WHERE total_amount < 0 UNION ALL SELECT 'Future dates' AS check_type, COUNT(*) AS anomaly_count FROM v "
    f"WHERE date > '{AS_OF_DAY}'",
    "table_preview": _with(T, V) + "SELECT * FROM v ORDER BY partition_key, customer_id, product LIMIT 10",
    "hot_keys": _with(T)
    + "SELECT partition_key, COUNT(*) AS record_count, COUNT(*) / SUM(COUNT(*)) OVER () AS share "
    "FROM t GROUP BY partition_key QUALIFY COUNT(*) >= 0.05 * SUM(COUNT(*)) OVER ()",
    "write_partitioned_roundtrip": AGG_V,
    "write_clustered_roundtrip": AGG_V,
    "staged_publish": AGG_V,
    "stream_append_rollup": _with(T, V) + "SELECT *, '2024-01-15 12:00:00' AS processed_at, "
    "(SELECT COUNT(*) FROM t) AS batch_orders, TRUE AS several_batches FROM v",
}
