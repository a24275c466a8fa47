"""What the data say of their own format: the pattern of dates, and how many decimals numbers need.

One aggregate over the whole table each, so that the answer doesn't depend on which file or row comes first.
"""

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.parsing import sale_date

# The patterns of dates that are tried.
DATE_PATTERNS = [
    "M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "M-d-yyyy", "d-M-yyyy", "yyyy-M-d", "M.d.yyyy", "d.M.yyyy", "yyyy.M.d", "d MMM yyyy", "MMM d, yyyy",
]


class AmbiguousDatesError(ValueError):
    """Several patterns fit the dates equally well and give different days."""


def date_evidence(table: DataFrame, column: str = "date", patterns: list[str] | None = None) -> DataFrame:
    """A row per pattern: pattern, parsed (texts that it parses), texts (that are not NULL). One aggregate."""
    patterns = patterns or DATE_PATTERNS
    counts = table.agg(
        F.count(column).alias("texts"), *[F.count(sale_date(F.col(column), p)).alias(f"parsed_{k}") for k, p in enumerate(patterns)]
    )
    found = F.array(*[F.struct(F.lit(p).alias("pattern"), F.col(f"parsed_{k}").alias("parsed")) for k, p in enumerate(patterns)])
    return counts.select(F.explode(found).alias("found"), "texts").select("found.pattern", "found.parsed", "texts")


def date_pattern_of(table: DataFrame, column: str = "date", patterns: list[str] | None = None) -> str:
    """The pattern that parses most texts of the column.

    Of several that parse equally many, the first, if they give the same day for every text; else it is an error, and
    the pattern has to be said. Without any date, the first pattern.
    """
    patterns = patterns or DATE_PATTERNS
    parsed = {r.pattern: r.parsed for r in date_evidence(table, column, patterns).collect()}
    best = [p for p in patterns if parsed[p] == max(parsed.values())]
    if len(best) == 1 or not max(parsed.values()):
        return best[0]
    pairs = list(combinations(best, 2))
    differ = [F.count_if(~sale_date(F.col(column), a).eqNullSafe(sale_date(F.col(column), b))) for a, b in pairs]
    counts = table.agg(*[d.alias(f"d{k}") for k, d in enumerate(differ)]).first()
    unlike = [f"{a} and {b}" for (a, b), n in zip(pairs, counts) if n]
    if unlike:
        raise AmbiguousDatesError(f"column {column}: equally many texts are dates by {', '.join(unlike)}; say which pattern holds")
    return best[0]


def decimals(text: Column) -> Column:
    """Decimals that a number text needs, zeros at the end not counted; NULL for other texts."""
    exponent = F.coalesce(F.nullif(F.regexp_extract(text, r"[eE]([+-]?\d+)\s*$", 1), F.lit("")).try_cast("int"), F.lit(0))
    mantissa = F.regexp_extract(text, r"^\s*[+-]?([\d.]*)", 1)
    fraction = F.regexp_extract(mantissa, r"\.(\d*?)0*$", 1)
    zeros = F.length(F.regexp_extract(mantissa, r"^\d*?[1-9](0*)(?:\.|$)", 1))
    # digits behind the point, or, if there are none, zeros before it, which a negative exponent moves behind
    needed = F.when(fraction != "", F.length(fraction)).otherwise(-zeros) - exponent
    return F.when(text.try_cast("double").isNotNull(), F.when(mantissa.rlike("[1-9]"), F.greatest(needed, F.lit(0))).otherwise(0))


def decimals_needed(table: DataFrame, columns: list[str]) -> DataFrame:
    """A row per column: column_name, decimals (the most that a number in it needs, 0 without numbers). One aggregate."""
    most = table.agg(*[F.coalesce(F.max(decimals(F.col(c).cast("string"))), F.lit(0)).cast("long").alias(c) for c in columns])
    found = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("decimals")) for c in columns])
    return most.select(F.explode(found).alias("found")).select("found.*")
