"""What the optimizer must make of the plans for them to hold on large tables."""

import contextlib
import io
import re

import pytest

from tillbook.operators import cleaning, quality
from tillbook.plans import daily_load, reports
from tillbook.sources.tables import read_staged, stage
from tillbook.verification.registry import QUERIES
from tillbook.verification.star import raw_sales

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(df):
    """Operators from the result down to the scans."""
    return plan(df).split("\n\n")[0]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    return daily_load.load_raw(raw_sales(spark, SF_DIR), root).rows


@pytest.fixture(scope="module")
def warehouse(spark, raw, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    return daily_load.load_warehouse(raw, root).rows


def scan_columns(df):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*)>", plan(df))]


def test_one_row_per_key_and_partition_crosses_the_shuffle(raw):
    text = tree(cleaning.clean_sales(raw))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")  # the partial limit is below it


def test_null_keys_are_filtered_at_the_scan(raw):
    assert re.search(r"PushedFilters: \[.*IsNotNull\(invoice_id\)", plan(cleaning.clean_sales(raw)))


def test_account_of_cleaning_is_aggregated_before_the_shuffle(raw):
    df = cleaning.removed_by_reason(cleaning.audit_of_raw(raw))
    text = tree(df)
    assert text.count("Scan parquet") == 1
    assert "Window" not in text
    below = text[text.rindex("Exchange"):]
    assert "SortAggregate" in below
    assert "payment" not in scan_columns(df)[0] and "city" not in scan_columns(df)[0]


@pytest.mark.parametrize("check", [cleaning.duplicate_count, quality.dq_duplicate_keys])
def test_key_counts_read_only_the_key(raw, check):
    df = check(raw)
    assert scan_columns(df) == [{"invoice_id"}]
    text = tree(df)
    assert "HashAggregate" in text[text.rindex("Exchange"):]


@pytest.mark.parametrize(
    ("report", "columns"),
    [
        (reports.revenue_by_branch_city, {"branch", "city", "total"}),
        (reports.top_product_lines, {"product_line", "total", "rating"}),
        (reports.customer_segment_spend, {"customer_type", "gender", "total"}),
        (reports.payment_mix, {"payment", "total"}),
        (reports.monthly_revenue, {"date", "total"}),
        (reports.null_profile, {"invoice_id", "branch", "total", "date"}),
        (reports.branch_revenue_sample, {"branch", "total"}),
    ],
)
def test_reports_read_their_columns_and_aggregate_before_the_shuffle(warehouse, report, columns):
    df = report(warehouse)
    assert scan_columns(df) == [columns]
    text = tree(df)
    below = text[text.rindex("Exchange"):]
    assert "HashAggregate" in below and "Window" not in below


def test_single_partition_exchanges_see_aggregates_only(warehouse):
    for report in (reports.payment_mix, reports.null_profile, reports.row_count):
        text = plan(report(warehouse))
        node = tree(report(warehouse))
        assert "SinglePartition" in text
        assert "HashAggregate" in node[node.rindex("Exchange"):]


@pytest.mark.parametrize("report", [reports.top_transactions, reports.warehouse_preview])
def test_top_rows_do_not_sort_everything(warehouse, report):
    text = tree(report(warehouse))
    assert "TakeOrderedAndProject" in text and "Sort " not in text and "Exchange" not in text


def test_month_is_formatted_after_grouping(warehouse):
    text = tree(reports.monthly_revenue(warehouse))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_counting_raw_rows_joins_nothing(spark):
    assert "Join" not in tree(QUERIES["raw_row_count"](spark, SF_DIR))
    assert "Join" not in tree(QUERIES["duplicate_count"](spark, SF_DIR))


def test_no_python_workers_and_no_cross_joins(spark):
    for name, query in QUERIES.items():
        text = tree(query(spark, SF_DIR))
        assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|NestedLoop", text), name


def test_dimension_broadcast_depends_on_size(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = tree(raw_sales(spark, SF_DIR))
        assert "Broadcast" not in text and text.count("SortMergeJoin") == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_warehouse_rows_are_not_sorted_for_the_write(spark, tmp_path):
    """Between the window that finds first rows and the write of both kinds of rows there is no sort."""
    raw = daily_load.load_raw(raw_sales(spark, SF_DIR), str(tmp_path)).rows
    seen = spark._jsparkSession.sharedState().statusStore()

    def latest(n):
        """The last executions; the store keeps a fixed number, so that their places change, but not their ids."""
        found = seen.executionsList()
        return [found.apply(k) for k in range(max(0, found.size() - n), found.size())]

    before = max((e.executionId() for e in latest(1)), default=-1)
    daily_load.load_warehouse(raw, str(tmp_path))
    plans = [e.physicalPlanDescription() for e in latest(100) if e.executionId() > before]
    (write,) = [p for p in plans if "Execute InsertIntoHadoopFsRelationCommand" in p and "Window" in p]
    tree_ = write[: write.index("\n\n(1)")] if "\n\n(1)" in write else write
    final = tree_[tree_.index("Final Plan") :] if "Final Plan" in tree_ else tree_
    final = final.split("Initial Plan")[0]
    assert "Sort" not in final[: final.index("Window (")]
    assert "Sort" in final[final.index("Window (") :]


def test_staged_versions_do_not_overwrite_each_other(spark, tmp_path):
    df = spark.range(3)
    paths = {stage(df, str(tmp_path), "t") for _ in range(2)}
    assert len(paths) == 2
    assert all(read_staged(spark, p, df.schema).count() == 3 for p in paths)
