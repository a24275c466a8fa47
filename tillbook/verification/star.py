"""Raw sales derived from the star-schema test tables (rules: FIXTURES.md, section 3).

Dimensions are joined by left joins on their unique keys, so no sale is lost to a missing
dimension row, and a dimension whose columns are not asked for need not be joined at all.
No join is told how to run: the optimizer broadcasts a dimension only below its size threshold.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.schema import ORDER_PREFIX, RAW_COLUMNS, RAW_SCHEMA

ROW_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
]
_PART = {"product_line", "unit_price"}
_CUSTOMER = {"branch", "city", "customer_type", "gender"}
_ORDERS = _CUSTOMER | {"date", "payment"}


def _every(divisor: int, replacement: Column, value: Column) -> Column:
    return F.when(F.col("l_partkey") % divisor == 0, replacement).otherwise(value)


def _columns() -> dict[str, Column]:
    cogs = F.col("l_extendedprice").cast("decimal(18,2)")
    total = (cogs * F.lit(Decimal("1.05"))).cast("decimal(18,4)")
    tax = (cogs * F.lit(Decimal("0.05"))).cast("decimal(18,4)")
    null = F.lit(None)
    hour = (10 + F.col("l_orderkey") % 11).cast("string")
    minute = F.lpad((F.col("l_partkey") % 60).cast("string"), 2, "0")
    return {
        "invoice_id": F.when(
            (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 211 != 0,
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
        ),
        "branch": _every(97, null, F.substring(F.lit("ABCDE"), F.col("r_regionkey") + 1, F.lit(1))),
        "city": F.col("n_name"),
        "customer_type": F.when(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD"), "Member").otherwise("Normal"),
        "gender": F.when(F.col("c_custkey") % 2 == 0, "Female").otherwise("Male"),
        "product_line": F.col("p_type"),
        "unit_price": F.col("p_retailprice").cast("decimal(18,2)"),
        "quantity": F.when(F.col("l_partkey") % 89 == 0, 0).otherwise(_every(101, null, F.col("l_quantity").cast("int"))),
        "tax_5": tax,
        "total": _every(83, -total, total),
        "date": F.date_format("o_orderdate", "M/d/yyyy"),
        "time": F.concat(hour, F.lit(":"), minute),
        "payment": F.when(F.col("o_orderpriority") == "1-URGENT", "Cash")
        .when(F.col("o_orderpriority") == "2-HIGH", "Credit card")
        .otherwise("Ewallet"),
        "cogs": cogs,
        "gross_margin_percentage": F.lit(Decimal("4.761904762")),
        "gross_income": tax,
        "rating": ((F.col("l_orderkey") % 61 + 40).cast("decimal(18,1)") * F.lit(Decimal("0.1"))),
    }


def bad_dates() -> dict[str, Column]:
    return {"date": _every(79, F.lit("2/30/2000"), _columns()["date"])}


def missing_values() -> dict[str, Column]:
    base = _columns()
    return {c: _every(n, F.lit(None), base[c]) for c, n in (("city", 73), ("product_line", 61), ("unit_price", 59), ("total", 53))}


def bad_times() -> dict[str, Column]:
    return {"time": _every(67, F.lit("25:99"), _columns()["time"])}


def number_texts() -> dict[str, Column]:
    base = _columns()
    return {
        "unit_price": _every(71, F.lit("n.a."), base["unit_price"].cast("string")),
        "quantity": base["quantity"].cast("string"),
        "total": base["total"].cast("string"),
    }


def raw_sales(
    spark: SparkSession,
    sf_dir: str,
    columns: list[str] = RAW_COLUMNS,
    variant: dict[str, Column] | None = None,
) -> DataFrame:
    def table(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    wanted = set(columns)
    sales = table("lineitem")
    if wanted & _PART:
        sales = sales.join(table("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    if wanted & _ORDERS:
        orders = table("orders")
        if wanted & _CUSTOMER:
            # Joined to the orders, not to the sales, which then cross one shuffle for all of them.
            orders = (
                orders.join(table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
                .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            )
        sales = sales.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    values = _columns()
    types = {f.name: f.dataType for f in RAW_SCHEMA}
    typed = {c: values[c].cast(types[c]) for c in columns} | (variant or {})
    return sales.select(
        *[typed[c].alias(c) for c in columns],
        *[F.col(c).alias(f"{ORDER_PREFIX}{i}") for i, c in enumerate(ROW_ORDER, 1)],
    )
