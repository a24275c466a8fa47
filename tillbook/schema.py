"""Table names, column types and the fixed value lists of the sales tables."""

from pyspark.sql import types as T

KEY = "invoice_id"

# Table names shown in the row count report.
RAW_TABLE = "raw_supermarket_sales"
WAREHOUSE_TABLE = "warehouse_supermarket_sales"

#: Decimals of money and ratings, unless a load asks for others.
SCALE = 4
MAX_SCALE = 18
MONEY = T.DecimalType(14 + SCALE, SCALE)
MARGIN = T.DecimalType(20, 9)

RAW_SCHEMA = T.StructType([
    T.StructField("invoice_id", T.StringType()),
    T.StructField("branch", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("customer_type", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("product_line", T.StringType()),
    T.StructField("unit_price", MONEY),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("tax_5", MONEY),
    T.StructField("total", MONEY),
    T.StructField("date", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("payment", T.StringType()),
    T.StructField("cogs", MONEY),
    T.StructField("gross_margin_percentage", MARGIN),
    T.StructField("gross_income", MONEY),
    T.StructField("rating", MONEY),
])
RAW_COLUMNS = RAW_SCHEMA.fieldNames()


def with_scale(schema: T.StructType, scale: int) -> T.StructType:
    """The schema with ``scale`` decimals (2 to MAX_SCALE) for money and ratings; 14 whole digits stay."""
    if not 2 <= scale <= MAX_SCALE:
        raise ValueError(f"scale must be from 2 to {MAX_SCALE}: {scale}")
    money = T.DecimalType(14 + scale, scale)
    return T.StructType([T.StructField(f.name, money if f.dataType == MONEY else f.dataType) for f in schema])



# Dropped by cleaning: the value is the same in every row.
CONSTANT_COLUMN = "gross_margin_percentage"

# ``time`` is text in HH:mm:ss; Spark's TIME type is off by default.
WAREHOUSE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.DateType() if f.name == "date" else f.dataType)
        for f in RAW_SCHEMA
        if f.name != CONSTANT_COLUMN
    ]
    + [T.StructField("loaded_at", T.TimestampNTZType())]
)
# What a loader supplies; ``loaded_at`` is filled in by the load itself.
WAREHOUSE_COLUMNS = WAREHOUSE_SCHEMA.fieldNames()[:-1]

# Columns whose NULLs remove a row, and NOT NULL columns of the warehouse.
CRITICAL = ["invoice_id", "branch", "product_line", "total", "date"]
NOT_NULL = ["invoice_id", "branch", "city", "product_line", "unit_price", "quantity", "total", "date"]

# Field texts that mean "no value" in a source file.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Columns with this prefix, in their order, say which of several rows came first.
ORDER_PREFIX = "_ord_"

# Which number columns of a row were rounded, one bit each in raw column order; see ``to_raw``.
ROUNDED = "_rounded"


def order_columns(df):
    return [c for c in df.columns if c.startswith(ORDER_PREFIX)]
