"""Rounded report values. Spark's decimal ``round`` is half away from zero, as in the reports."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(total: Column) -> Column:
    """A sum of money with two decimals; 26 whole digits leave room for very large tables."""
    return F.round(total, 2).cast("decimal(28,2)")


def average(total: Column, rows: Column) -> Column:
    """``total / rows`` with two decimals, NULL when there are no rows.

    Rounded once: a quotient is cut to some number of decimals, which may turn a value just below a half
    cent into a half. Here cents are counted with an exact remainder instead, for any scale of ``total``.
    """
    count = F.nullif(rows, F.lit(0)).cast("decimal(20,0)")
    cent = (count * F.lit(Decimal("0.01"))).cast("decimal(22,2)")
    doubled = F.abs(total) * 2 + cent
    whole = ((doubled - doubled % (cent * 2)) / (cent * 2)).cast("decimal(20,0)")
    rounded = (whole * F.lit(Decimal("0.01"))).cast("decimal(18,2)")
    return F.when(total < 0, -rounded).otherwise(rounded)


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` on exact decimals; NULL when ``whole`` is 0."""
    ratio = (F.lit(100) * part).cast("decimal(22,0)") / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(ratio, digits).cast("decimal(18,2)")
