"""Cleaning on random sales with hot keys, against a plain brute-force account."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.operators import cleaning, quality
from tillbook.plans import daily_load
from tillbook.schema import CRITICAL, RAW_COLUMNS, RAW_SCHEMA

N = 1500
ORDERED = T.StructType(RAW_SCHEMA.fields + [T.StructField("_ord_row", T.LongType())])


def random_sales(seed):
    """A third of the rows share one invoice, a sixth have none."""
    rng = random.Random(seed)

    def maybe(value, chance=0.05):
        return None if rng.random() < chance else value

    out = []
    for i in range(N):
        kind = rng.random()
        key = "hot" if kind < 1 / 3 else None if kind < 1 / 2 else f"I-{rng.randrange(N // 2)}"
        total = maybe(Decimal(rng.randrange(-500, 20000)) / 100)
        row = dict.fromkeys(RAW_COLUMNS)
        row |= {
            "invoice_id": key,
            "branch": maybe(rng.choice("ABC")),
            "city": "Yangon",
            "product_line": maybe(rng.choice(["Food", "Sports"])),
            "unit_price": Decimal(5),
            "quantity": maybe(rng.randrange(-1, 9)),
            "total": total,
            "date": maybe(f"{rng.randrange(1, 13)}/{rng.randrange(1, 29)}/2019"),
            "time": "10:05",
            "gross_margin_percentage": Decimal("4.761904762"),
        }
        out.append(tuple(row[c] for c in RAW_COLUMNS) + (i,))
    return out


def brute_force(rows):
    names = [*RAW_COLUMNS, "_ord_row"]
    seen, removed, kept = set(), Counter(), []
    reported = Counter()
    for values in sorted(rows, key=lambda r: r[-1]):
        row = dict(zip(names, values))
        if row["invoice_id"] in seen:
            removed["duplicate"] += 1
            continue
        seen.add(row["invoice_id"])
        for c in CRITICAL:
            reported[f"null_{c}"] += row[c] is None
        if any(row[c] is None for c in CRITICAL):
            removed["critical_null"] += 1
            continue
        low_quantity = row["quantity"] is not None and row["quantity"] <= 0
        reported["quantity"] += low_quantity
        reported["total"] += row["total"] <= 0
        if low_quantity or row["total"] <= 0:
            removed["value_not_positive"] += 1
        elif row["quantity"] is None:
            removed["quantity_null"] += 1
        else:
            kept.append((row["invoice_id"], row["_ord_row"]))
    return removed, reported, kept


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cleaning_matches_brute_force(spark, tmp_path, seed):
    data = random_sales(seed)
    removed, reported, kept = brute_force(data)
    shuffled = random.Random(seed + 100).sample(data, len(data))
    raw = spark.createDataFrame(shuffled, ORDERED).repartition(7)
    stored = daily_load.load_raw(raw, str(tmp_path)).rows
    load = daily_load.load_warehouse(stored, str(tmp_path))

    for audit in (cleaning.audit_of_raw(raw), load.audit):
        by_reason = {(r.counted, r.reason): r.row_count for r in cleaning.removed_by_reason(audit).collect()}
        assert {k[1]: n for k, n in by_reason.items() if k[0] == "removed"} == dict(removed)
        assert sum(removed.values()) == N - len(kept)
        profile = {r.column_name: r.null_count for r in cleaning.critical_null_profile(audit).collect()}
        assert profile == {c: reported[f"null_{c}"] for c in CRITICAL}
        assert tuple(cleaning.invalid_value_counts(audit).first()) == (reported["quantity"], reported["total"])
        counts = audit.first()
        assert (counts.rows_before, counts.rows_after, counts.rows_removed) == (N, len(kept), N - len(kept))

    survivors = raw.transform(cleaning.keep_first).transform(cleaning.drop_critical_nulls)
    survivors = survivors.transform(cleaning.positive_filter).select("invoice_id", "_ord_row")
    assert Counter(map(tuple, survivors.collect())) == Counter(kept)

    clean = cleaning.clean_sales(raw)
    columns = ["invoice_id", "branch", "quantity", "total", "date"]
    assert Counter(clean.select(columns).collect()) == Counter(load.rows.select(columns).collect())

    assert cleaning.duplicate_count(raw).first()[0] == removed["duplicate"]
    keys = Counter(r[0] for r in data)
    assert quality.dq_duplicate_keys(raw).first().observed == sum(n > 1 for n in keys.values())


def test_cleaning_clean_rows_changes_nothing(spark):
    raw = spark.createDataFrame(random_sales(4), ORDERED)
    once = cleaning.clean_sales(raw)
    again = cleaning.clean_sales(once.withColumn("_ord_row", F.lit(0)))
    assert Counter(once.collect()) == Counter(again.collect())


def test_first_row_needs_an_order(spark):
    raw = spark.createDataFrame(random_sales(5), ORDERED).drop("_ord_row")
    with pytest.raises(ValueError, match="undefined"):
        cleaning.keep_first(raw)
    with pytest.raises(ValueError, match="undefined"):
        cleaning.clean_sales(raw)
