"""Sales CSV files to the typed raw table."""

from collections import Counter
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions import decimals_needed, lossy, missing_to_null, numbers_fit, whole_number
from tillbook.schema import MAX_SCALE, MONEY, ORDER_PREFIX, RAW_COLUMNS, RAW_SCHEMA, ROUNDED, SCALE, order_columns, with_scale
from tillbook.sources.quoted_lines import read_records

_CORRUPT = "_corrupt"
# What a reader puts in place of bytes that it can't decode.
_REPLACED = "\ufffd"
_UTF8 = "UTF-8"
# The encoding in which every byte is a letter.
_BYTES = "ISO-8859-1"


def normalize_headers(names: list[str]) -> list[str]:
    """Source headings to column names: ``" Tax 5 %"`` and ``"Tax 5%"`` both give ``tax_5``."""
    swaps = str.maketrans({" ": "_", "-": "_", "%": None})
    clean = [name.strip().lower().translate(swaps) for name in names]
    clean = ["tax_5" if name == "tax_5_" else name for name in clean]
    repeated = [name for name, n in Counter(clean).items() if n > 1]
    if repeated:
        raise ValueError(f"headings give the same column name: {repeated}")
    return clean


def source_bytes(spark: SparkSession, path: str) -> int:
    """Size of the source as stored; a missing path raises. Taken from the file listing that a scan needs
    anyway, without a job over the files."""
    return int(spark.read.text(path)._jdf.queryExecution().analyzed().stats().sizeInBytes())


def source_profile(df: DataFrame) -> DataFrame:
    names = [c for c in df.columns if not c.startswith(ORDER_PREFIX)]
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(names)).alias("column_count"),
        F.lit(",".join(names)).alias("column_names"),
    )


def to_raw(df: DataFrame, scale: int = SCALE, round_digits: bool = False) -> DataFrame:
    """Match columns by name to the raw schema: missing ones are NULL, unknown ones an error.

    ``scale`` is the number of decimals that money and ratings keep. A number with more is an error, or
    rounded half away from zero with ``round_digits``; ``_rounded`` then says where that was.

    Numbers of another type than the raw table's are checked and converted by way of their text, so
    that none is cut short; for a float that is its shortest text. Order columns are kept, because
    "first" must survive storage.
    """
    extra = order_columns(df)
    schema = with_scale(RAW_SCHEMA, scale)
    unknown = [c for c in df.columns if c not in RAW_COLUMNS and c not in extra]
    if unknown:
        raise ValueError(f"columns not in the raw table: {unknown}")
    given = {f.name: f.dataType for f in df.schema}
    texts = {
        f.name: f.dataType
        for f in schema
        if f.dataType != T.StringType() and given.get(f.name, f.dataType) != f.dataType
    }

    def typed(field: T.StructField) -> Column:
        if field.name not in given:
            return F.lit(None).cast(field.dataType)
        value = F.col(field.name)
        if field.name not in texts:
            return value.cast(field.dataType)
        return whole_number(value) if field.dataType == T.IntegerType() else value.try_cast(field.dataType)

    if texts:
        df = df.withColumns({name: F.col(name).cast("string") for name in texts}).where(numbers_fit(texts, round_digits))
    if round_digits:
        bits = [F.when(lossy(F.col(n), t), 1 << RAW_COLUMNS.index(n)).otherwise(0) for n, t in texts.items() if t != T.IntegerType()]
        extra = [*extra, reduce(add, bits, F.lit(0)).alias(ROUNDED)]
    return df.select(*[typed(f).alias(f.name) for f in schema], *extra)


def rounded_counts(raw: DataFrame) -> DataFrame:
    """One row: per number column, the rows of ``to_raw`` in which it was rounded."""
    return raw.agg(*[
        F.count_if(F.col(ROUNDED).bitwiseAND(1 << i) != 0).alias(f"rounded_{f.name}")
        for i, f in enumerate(RAW_SCHEMA) if isinstance(f.dataType, T.DecimalType)
    ])


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _well_formed(columns: list[str], multi_line: bool) -> Column:
    """Row filter: drop blank lines, keep short rows (padded with NULL), fail on long ones."""
    record = F.col(_CORRUPT)
    # Naming a data column too: Spark reads no file for the malformed record alone.
    blank = (F.trim(record) == "") & (F.coalesce(F.trim(columns[0]), F.lit("")) == "")
    outside_quotes = F.regexp_replace(record, r'(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1")
    too_long = F.length(outside_quotes) - F.length(F.replace(outside_quotes, F.lit(","))) >= len(columns)
    checked = F.when(record.isNull(), True).when(blank, False)
    if not multi_line:
        # A quoted line break that is read line by line leaves a ragged row with the start of a
        # quoted field, or, from the last column, one with its end. A text that just ends with a
        # quote, in a short row, is taken for the latter.
        checked = checked.when(
            outside_quotes.rlike(r'(^|,)"|"(,|$)'),
            F.raise_error(F.concat(F.lit("open quote, read with multi_line=True: "), record)),
        )
    too_many = F.raise_error(F.concat(F.lit("row has too many fields: "), record))
    return checked.when(too_long, too_many).otherwise(True)


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as it begins in the file paths that rows carry."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(there).toUri().toString()


def _file_path(path: str, spark: SparkSession, whole: Column) -> Column:
    """A file's path without the folder that was asked for, as it travels with every row."""
    file_path = F.replace(whole, F.lit(":///"), F.lit(":/"))
    root = _qualified(spark, path).replace(":///", ":/").rstrip("/")
    return (
        F.when(file_path.startswith(f"{root}/"), F.substring(file_path, len(root) + 2, 1 << 30))
        .when(file_path == root, F.substring_index(file_path, "/", -1))
        .otherwise(file_path)
    )


def _checked(valid: Column, encoding: str, file: Column) -> Column:
    """Row filter: true, or an error that names the file."""
    return F.when(valid, True).otherwise(F.raise_error(F.concat(F.lit(f"not {encoding}: "), file)))


def _by_lines(spark: SparkSession, path: str, header: list[str], dialect: dict, encoding: str) -> tuple[DataFrame, list[Column]]:
    """Fields of a file with one record a line, with file, block and row; and the columns of text.

    UTF-8 is read as Latin-1 first, which keeps every byte, and then checked and decoded, so that a bad
    byte can be told from a replacement character that is in the file.
    """
    schema = T.StructType([T.StructField(h, T.StringType()) for h in [*header, _CORRUPT]])
    lines = (
        spark.read.schema(schema)
        .options(
            **dialect,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=_CORRUPT,
            columnPruning=False,  # the field count is checked on the whole record
            enforceSchema=False,  # every file must have the header that was read
        )
        .csv(path)
    )
    fields = [_quoted(h) for h in header]
    whole_line = F.concat_ws(" ", *fields)
    if encoding == _UTF8 and dialect["encoding"] != encoding:

        def decoded(text: Column) -> Column:
            return F.encode(text, _BYTES).cast("string")

        def ascii_only(text: Column) -> Column:
            return F.octet_length(text) == F.char_length(text)

        readable = ascii_only(whole_line) | F.is_valid_utf8(decoded(whole_line))
        fields = [F.when(ascii_only(f), f).otherwise(decoded(f)) for f in fields]
    else:
        readable = ~whole_line.contains(_REPLACED)
    lines = lines.where(_checked(readable, encoding, F.col("_metadata.file_path"))).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row")
    )
    return lines, fields


def _by_records(spark: SparkSession, path: str, header: list[str], dialect: dict, encoding: str) -> tuple[DataFrame, list[Column]]:
    """Like ``_by_lines`` for files whose quoted fields may hold line breaks."""
    records = read_records(spark, path)
    text = F.col("record").cast("string") if encoding == _UTF8 else F.decode("record", encoding)
    readable = F.is_valid_utf8(text) if encoding == _UTF8 else ~text.contains(_REPLACED)
    text = F.rtrim(F.when(F.col("first"), F.ltrim(text, F.lit("\ufeff"))).otherwise(text), F.lit("\r"))
    names = [f"c{k}" for k in range(len(header))]
    options = {k: str(v) for k, v in dialect.items() if k in ("quote", "escape")}
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "multiLine": "true"}
    ddl = ", ".join(f"{n} string" for n in [*names, _CORRUPT])
    parsed = records.where(_checked(readable, encoding, F.col("file"))).select("file", "block", "row", "first", text.alias("text"))
    # a record that isn't blank has no null struct
    parsed = parsed.where(F.trim("text") != "").withColumn("fields", F.from_csv("text", ddl, options))
    given = F.array(*[F.coalesce(F.col(f"fields.{n}"), F.lit("")) for n in names])
    conforms = (given == F.array(*[F.lit(h) for h in header])) & F.col(f"fields.{_CORRUPT}").isNull()
    other = F.raise_error(F.concat(F.lit("CSV header does not conform to the first file's: "), F.col("file")))
    rows = parsed.where(F.when(~F.col("first"), True).when(conforms, False).otherwise(other))
    lines = rows.select("fields.*", F.col("file").alias("_file"), F.col("block").alias("_block"), F.col("row").alias("_row"))
    return lines.toDF(*header, _CORRUPT, "_file", "_block", "_row"), [_quoted(h) for h in header]


def read_sales_csv(
    spark: SparkSession, path: str, multi_line: bool = False, encoding: str = "UTF-8", scale: int | None = SCALE, round_digits: bool = False
) -> DataFrame:
    """Read one headered CSV file, or a folder of files with the same header, as raw sales.

    Files are in ``encoding``. Bytes that aren't in it are an error that names the file, as two different
    names could become one. ``scale`` and ``round_digits``: see ``to_raw``; a scale of None is what the numbers
    need, SCALE at least, which takes a pass over the files for it alone.

    Every field is read as text and typed afterwards. ``multi_line`` allows line breaks inside quotes. Files are
    read by splits all the same, but a second time, for where their quotes are open; so it is off by default,
    and such a file is reported. Line breaks in fields stay as they are. Only a file in UTF-16 or UTF-32 is one split then.
    Order columns follow file order: path, offset of the split, running row number.
    """
    encoding = _UTF8 if encoding.upper() in ("UTF-8", "UTF8") else encoding
    by_bytes = encoding == _UTF8 or encoding.lower() in ("iso-8859-1", "us-ascii")
    whole_files = multi_line and not by_bytes
    dialect = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "encoding": encoding}
    if encoding == _UTF8 and not multi_line:
        dialect["encoding"] = _BYTES
    header = spark.read.options(**dialect).csv(path).columns
    if not header:
        raise ValueError(f"no header in {path}")
    try:
        headings = [h.encode("latin-1").decode("utf-8") for h in header] if dialect["encoding"] != encoding else header
    except UnicodeDecodeError:
        headings = [_REPLACED]
    if multi_line and any(_REPLACED in h for h in headings) or headings == [_REPLACED]:
        raise ValueError(f"header isn't {encoding} in {path}")
    names = normalize_headers(headings)
    read = _by_records if multi_line and not whole_files else _by_lines
    lines, fields = read(spark, path, header, dialect, encoding)
    rows = lines.select(
        *[missing_to_null(f).alias(name) for f, name in zip(fields, names)],
        _file_path(path, spark, F.col("_file")).alias(f"{ORDER_PREFIX}file"),
        F.col("_block").alias(f"{ORDER_PREFIX}block"),
        F.col("_row").alias(f"{ORDER_PREFIX}row"),
        _CORRUPT,
    )
    rows = rows.where(_well_formed(names, multi_line)).drop(_CORRUPT)
    return to_raw(rows, scale_needed(rows) if scale is None else scale, round_digits)


def scale_needed(texts: DataFrame) -> int:
    """The decimals that money and ratings need, SCALE at least and no more than a column can have."""
    money = [f.name for f in RAW_SCHEMA if f.dataType == MONEY and f.name in texts.columns]
    found = decimals_needed(texts, money).agg(F.max("decimals")).first()[0] if money else 0
    return min(max(found, SCALE), MAX_SCALE)
