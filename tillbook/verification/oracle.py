"""The registered queries restated in SQL for DuckDB, from the same star-schema tables."""

from tillbook.schema import CONSTANT_COLUMN, CRITICAL, NOT_NULL, RAW_COLUMNS, WAREHOUSE_COLUMNS

_RAW = ", ".join(RAW_COLUMNS)
_CLEAN = ", ".join(c for c in RAW_COLUMNS if c != CONSTANT_COLUMN)
_WAREHOUSE = ", ".join(WAREHOUSE_COLUMNS)
_ANY_NULL = " OR ".join(f"{c} IS NULL" for c in CRITICAL)
_ROW_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"

_STAGES = f"""
WITH raw AS (
  SELECT
    CASE WHEN (l_orderkey * 7 + l_linenumber) % 211 = 0 THEN NULL
         ELSE l_orderkey || '-' || l_linenumber END AS invoice_id,
    CASE WHEN l_partkey % 97 = 0 THEN NULL
         ELSE substr('ABCDE', r_regionkey + 1, 1) END AS branch,
    n_name AS city,
    CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'Member' ELSE 'Normal' END AS customer_type,
    CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    p_type AS product_line,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS unit_price,
    CASE WHEN l_partkey % 89 = 0 THEN 0
         WHEN l_partkey % 101 = 0 THEN NULL
         ELSE CAST(l_quantity AS INTEGER) END AS quantity,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.05 AS DECIMAL(18,4)) AS tax_5,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 1.05 AS DECIMAL(18,4))
      * CASE WHEN l_partkey % 83 = 0 THEN -1 ELSE 1 END AS signed_total,
    strftime(o_orderdate, '%-m/%-d/%Y') AS date,
    (10 + l_orderkey % 11) || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') AS time,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Cash' WHEN '2-HIGH' THEN 'Credit card'
         ELSE 'Ewallet' END AS payment,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS cogs,
    CAST(4.761904762 AS DECIMAL(20,9)) AS gross_margin_percentage,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.05 AS DECIMAL(18,4)) AS gross_income,
    CAST(CAST(4.0 + (l_orderkey % 61) / 10 AS DECIMAL(4,1)) AS DECIMAL(18,4)) AS rating,
    CAST(signed_total AS DECIMAL(18,4)) AS total,
    {_ROW_ORDER}
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
), deduped AS (
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY invoice_id ORDER BY {_ROW_ORDER}) = 1
), complete AS (
  SELECT * FROM deduped WHERE NOT ({_ANY_NULL})
), positive AS (
  SELECT * FROM complete WHERE quantity > 0 AND total > 0
), clean AS (
  SELECT * REPLACE (CAST(try_strptime(date, '%-m/%-d/%Y') AS DATE) AS date) FROM positive
), warehouse AS (
  SELECT * REPLACE (strftime(strptime(time, '%H:%M'), '%H:%M:%S') AS time) FROM clean
)
"""


def _money(value):
    return f"CAST(round({value}, 2) AS DECIMAL(28,2))"


def _average(value):
    """In whole numbers, so that it is rounded once: a cent is 100 units of the last of 4 decimals."""
    units, rows = f"CAST(sum({value}) * 10000 AS HUGEINT)", f"CAST(count({value}) AS HUGEINT)"
    cents = f"((2 * abs({units}) + 100 * {rows}) // (200 * {rows})) * sign({units})"
    return f"CAST(CAST({cents} AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def _check(table, check_id):
    name, observed, passed = {
        1: ("not_empty", "count(*)", "count(*) > 0"),
        2: ("no_critical_nulls", f"count(*) FILTER ({_ANY_NULL})", f"count(*) FILTER ({_ANY_NULL}) = 0"),
        3: ("unique_invoice_id", "count(*)", "count(*) = 0"),
        4: (
            "positive_values",
            "count(*) FILTER (total <= 0 OR quantity <= 0)",
            "count(*) FILTER (total <= 0 OR quantity <= 0) = 0",
        ),
        5: ("branch_sample", "count(*)", "TRUE"),
    }[check_id]
    rows = f"(SELECT invoice_id FROM {table} GROUP BY invoice_id HAVING count(*) > 1)" if check_id == 3 else table
    return (
        f"SELECT '{table}' AS table_name, {check_id} AS check_id, '{name}' AS check_name, "
        f"{observed} AS observed, {passed} AS passed FROM {rows}"
    )


def _checks(*check_ids):
    parts = [_check(t, i) for t in ("raw", "warehouse") for i in check_ids]
    return _STAGES + " UNION ALL ".join(parts)


def _constraint(kind, column, count, rows):
    return f"SELECT '{kind}' AS constraint_name, '{column}' AS column_name, {count} AS violations FROM {rows}"


def _constraints():
    """Uncleaned rows with the injected bad dates and times and missing values."""
    variant = """, variant AS (
      SELECT * REPLACE (
        CASE WHEN l_partkey % 73 = 0 THEN NULL ELSE city END AS city,
        CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE product_line END AS product_line,
        CASE WHEN l_partkey % 59 = 0 THEN NULL ELSE unit_price END AS unit_price,
        CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE total END AS total,
        CASE WHEN l_partkey % 67 = 0 THEN '25:99' ELSE time END AS time,
        CAST(try_strptime(CASE WHEN l_partkey % 79 = 0 THEN '2/30/2000' ELSE date END, '%-m/%-d/%Y') AS DATE) AS date
      ) FROM raw
    )"""
    keys = "(SELECT invoice_id FROM variant WHERE invoice_id IS NOT NULL GROUP BY invoice_id HAVING count(*) > 1)"
    parts = [_constraint("not_null", c, f"count(*) FILTER ({c} IS NULL)", "variant") for c in NOT_NULL]
    parts.append(_constraint("unique", "invoice_id", "count(*)", keys))
    parts.append(
        _constraint("time_of_day", "time", "count(*) FILTER (time IS NOT NULL AND try_strptime(time, '%H:%M') IS NULL)", "variant")
    )
    return _STAGES + variant + " UNION ALL ".join(parts)


def _removed_by_reason():
    def part(counted, reason, count):
        return f"SELECT '{counted}' AS counted, '{reason}' AS reason, {count} AS row_count"

    duplicates = "(SELECT count(*) FROM raw) - (SELECT count(*) FROM deduped)"
    incomplete = "(SELECT count(*) FROM deduped) - (SELECT count(*) FROM complete)"

    def bad(condition):
        return f"(SELECT count(*) FROM complete WHERE {condition})"

    return _STAGES + " UNION ALL ".join([
        part("reported", "duplicate", duplicates),
        part("reported", "critical_null", incomplete),
        part("reported", "quantity_not_positive", bad("quantity <= 0")),
        part("reported", "total_not_positive", bad("total <= 0")),
        part("removed", "duplicate", duplicates),
        part("removed", "critical_null", incomplete),
        part("removed", "value_not_positive", bad("quantity <= 0 OR total <= 0")),
        part("removed", "quantity_null", bad("quantity IS NULL AND total > 0")),
    ])


# Patterns of dates, and the same for DuckDB.
_PATTERNS = {
    "M/d/yyyy": "%-m/%-d/%Y", "d/M/yyyy": "%-d/%-m/%Y", "yyyy/M/d": "%Y/%-m/%-d", "M-d-yyyy": "%-m-%-d-%Y", "d-M-yyyy": "%-d-%-m-%Y", "yyyy-M-d": "%Y-%-m-%-d",
}


def _date_patterns():
    texts = "(SELECT CASE WHEN l_partkey % 79 = 0 THEN '2/30/2000' ELSE date END AS text FROM raw)"
    return _STAGES + " UNION ALL ".join(
        f"SELECT '{p}' AS pattern, count(try_strptime(text, '{d}')) AS parsed, count(text) AS texts FROM {texts}" for p, d in _PATTERNS.items()
    )


def _decimals():
    numbers = ("unit_price", "tax_5", "total", "cogs", "gross_margin_percentage", "gross_income", "rating")
    return _STAGES + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, coalesce(max(length(rtrim(split_part({c}::VARCHAR, '.', 2), '0'))), 0) AS decimals FROM raw" for c in numbers
    )


def _report_pack():
    keys = ("branch", "city", "product_line", "customer_type", "gender", "payment", "month")
    sets = {
        "revenue_by_branch_city": ("branch", "city"), "top_product_lines": ("product_line",), "customer_segment_spend": ("customer_type", "gender"),
        "payment_mix": ("payment",), "monthly_revenue": ("month",), "branch_revenue_sample": ("branch",), "null_profile": (),
    }

    def part(name, columns):
        shown = ", ".join(f"{k if k in columns else 'NULL'} AS {k}" for k in keys)
        nulls = ", ".join(f"CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS no_{c}" for c in ("invoice_id", "branch", "total", "date"))
        return (
            f"SELECT '{name}' AS report, {shown}, count(*) AS rows, {_money('sum(total)')} AS total, count(total) AS totals, "
            f"{_money('sum(rating)')} AS rating, count(rating) AS ratings, {nulls}, count(*) FILTER ({_ANY_NULL}) AS incomplete, "
            "count(*) FILTER (total <= 0 OR quantity <= 0) AS not_positive FROM (SELECT *, strftime(date, '%Y-%m') AS month FROM warehouse)"
            + (f" GROUP BY {', '.join(columns)}" if columns else "")
        )

    return _STAGES + " UNION ALL ".join(part(n, c) for n, c in sets.items())


def sql() -> dict[str, str]:
    loaded = f"SELECT {_WAREHOUSE} FROM warehouse"
    queries = {
        "source_profile": f"SELECT count(*) AS row_count, {len(RAW_COLUMNS)} AS column_count, "
        f"'{','.join(RAW_COLUMNS)}' AS column_names FROM raw",
        "raw_load": f"SELECT {_RAW} FROM raw",
        "raw_row_count": "SELECT count(*) AS row_count FROM raw",
        "warehouse_row_count": "SELECT count(*) AS row_count FROM warehouse",
        "warehouse_preview": f"{loaded} ORDER BY invoice_id LIMIT 5",
        "load_warehouse": loaded,
        "normalize_headers": f"SELECT {_RAW} FROM raw",
        "dedup_keep_first": f"SELECT {_RAW} FROM deduped",
        "duplicate_count": "SELECT count(*) - (SELECT count(*) FROM deduped) AS duplicate_count FROM raw",
        "critical_null_profile": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM deduped" for c in CRITICAL
        ),
        "drop_critical_nulls": f"SELECT {_RAW} FROM complete",
        "invalid_value_counts": "SELECT count(*) FILTER (quantity <= 0) AS invalid_quantity, "
        "count(*) FILTER (total <= 0) AS invalid_total FROM complete",
        "positive_filter": f"SELECT {_RAW} FROM positive",
        "coerce_dates": "SELECT invoice_id, CAST(try_strptime(CASE WHEN l_partkey % 79 = 0 THEN '2/30/2000' "
        "ELSE date END, '%-m/%-d/%Y') AS DATE) AS date FROM raw",
        "coerce_numerics": "SELECT invoice_id, try_cast(CASE WHEN l_partkey % 71 = 0 THEN 'n.a.' "
        "ELSE CAST(unit_price AS VARCHAR) END AS DECIMAL(18,4)) AS unit_price, quantity, total FROM raw",
        "drop_constant_column": f"SELECT {_CLEAN} FROM raw",
        "clean_sales": f"SELECT {_CLEAN} FROM clean",
        "clean_summary": "SELECT b AS rows_before, b - a AS rows_removed, a AS rows_after, "
        "CAST(coalesce(round(100.0 * a / nullif(b, 0), 1), 0) AS DECIMAL(18,2)) AS clean_pct "
        "FROM (SELECT (SELECT count(*) FROM raw) AS b, (SELECT count(*) FROM clean) AS a)",
        "row_count_audit": "SELECT 'raw_supermarket_sales' AS table_name, count(*) AS row_count FROM raw "
        "UNION ALL SELECT 'warehouse_supermarket_sales', count(*) FROM warehouse",
        "revenue_by_branch_city": f"SELECT branch, city, count(*) AS total_transactions, "
        f"{_money('sum(total)')} AS total_revenue, {_average('total')} AS avg_revenue_per_transaction "
        "FROM warehouse GROUP BY branch, city ORDER BY total_revenue DESC, branch, city",
        "top_product_lines": f"SELECT product_line, count(*) AS total_sold, {_money('sum(total)')} AS total_revenue, "
        f"{_average('rating')} AS avg_rating FROM warehouse GROUP BY product_line "
        "ORDER BY total_revenue DESC, product_line LIMIT 5",
        "customer_segment_spend": f"SELECT customer_type, gender, count(*) AS total_transactions, "
        f"{_money('sum(total)')} AS total_spent, {_average('total')} AS avg_spent "
        "FROM warehouse GROUP BY customer_type, gender ORDER BY total_spent DESC, customer_type, gender",
        "payment_mix": f"SELECT payment, count(*) AS total_transactions, {_money('sum(total)')} AS total_revenue, "
        "CAST(round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS DECIMAL(18,2)) AS percentage "
        "FROM warehouse GROUP BY payment ORDER BY total_revenue DESC, payment",
        "monthly_revenue": f"SELECT strftime(date, '%Y-%m') AS month, count(*) AS total_transactions, "
        f"{_money('sum(total)')} AS monthly_revenue FROM warehouse GROUP BY 1 ORDER BY 1",
        "top_transactions": "SELECT invoice_id, branch, product_line, quantity, total, date FROM warehouse "
        "ORDER BY total DESC, invoice_id LIMIT 10",
        "null_profile": "SELECT count(*) AS total_rows, "
        + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in ("invoice_id", "branch", "total", "date"))
        + " FROM warehouse",
        "branch_revenue_sample": f"SELECT branch, count(*) AS total_transactions, {_money('sum(total)')} AS total_revenue "
        "FROM warehouse GROUP BY branch ORDER BY branch",
        "load_reconciliation": "SELECT (SELECT count(*) FROM raw) AS raw_row_count, "
        "(SELECT count(*) FROM clean) AS clean_row_count, "
        "(SELECT count(*) FROM raw) - (SELECT count(*) FROM clean) AS removed_row_count, "
        "(SELECT count(*) FROM warehouse) AS warehouse_row_count",
    }
    return {name: _STAGES + body for name, body in queries.items()} | {
        "constraint_violations": _constraints(),
        "removed_by_reason": _removed_by_reason(),
        "date_pattern_evidence": _date_patterns(),
        "decimals_needed": _decimals(),
        "report_pack": _report_pack(),
        "dq_not_empty": _checks(1),
        "dq_null_critical": _checks(2),
        "dq_duplicate_keys": _checks(3),
        "dq_positive_values": _checks(4),
        "dq_report": _checks(1, 2, 3, 4, 5),
    }
