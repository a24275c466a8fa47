from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from golden import GOLDEN, changed, rows
from tillbook.schema import RAW_COLUMNS, RAW_SCHEMA, order_columns
from tillbook.sizing import sized_for, sizes
from tillbook.sources.csv_source import normalize_headers, read_sales_csv, rounded_counts, source_bytes, source_profile, to_raw

HEADER = GOLDEN.splitlines()[0]


@pytest.fixture
def csv(tmp_path):
    def write(text, name="sales.csv"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
        return str(path)

    return write


def line(invoice="X-1", branch="A", city="Yangon", quantity="1", price="5.00", rating="7.0"):
    return (
        f"{invoice},{branch},{city},Normal,Male,Sports and travel,{price},{quantity},0.25,5.25,1/6/2019,10:00,"
        f"Cash,5.00,4.761904762,0.25,{rating}"
    )


def read(spark, path, *columns, **options):
    df = read_sales_csv(spark, path, **options)
    return [tuple(r) for r in df.orderBy(*order_columns(df)).select(*columns).collect()]


def test_headings_become_column_names():
    assert normalize_headers(HEADER.split(",")) == RAW_COLUMNS
    assert normalize_headers([" Tax 5 % ", "gross-margin %"]) == ["tax_5", "gross_margin_"]
    with pytest.raises(ValueError, match="same column name"):
        normalize_headers(["Unit price", "unit-price"])


def test_golden_file_is_read_in_order_with_types(spark, csv):
    df = read_sales_csv(spark, csv(GOLDEN))
    assert [f.dataType for f in df.select(*RAW_COLUMNS).schema] == [f.dataType for f in RAW_SCHEMA]
    got = read(spark, csv(GOLDEN), "invoice_id", "branch", "quantity", "total", "date")
    assert len(got) == 13
    assert got[0] == ("I-01", "A", 2, Decimal("21.0000"), "1/5/2019")
    assert [r[0] for r in got[4:6]] == [None, None]
    assert got[2][1] is None  # NA
    assert got[12][2] is None  # null
    assert rows(source_profile(df)) == [(13, 17, ",".join(RAW_COLUMNS))]


def test_file_size_and_missing_file(spark, csv, tmp_path):
    path = csv(GOLDEN)
    assert source_bytes(spark, path) == len(GOLDEN)
    for action in (source_bytes, read_sales_csv):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            action(spark, str(tmp_path / "absent.csv"))


def test_order_follows_the_file_across_splits(spark, csv):
    path = csv("\n".join([HEADER] + [line(f"X-{i}") for i in range(3000)]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_sales_csv(spark, path)
        assert df.select(F.spark_partition_id()).distinct().count() > 4
        assert read(spark, path, "invoice_id") == [(f"X-{i}",) for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("multi_line", [False, True])
def test_dialect(spark, csv, multi_line):
    text = "﻿" + HEADER.replace("Branch", " Branch ") + "\n\n" + "\n".join([
        line("X-1", '"say ""A"", B"'),
        "   ",
        line("X-2", " NA "),
        line("X-3", '""'),
        line("X-4", '"N/A"'),
        "X-5,B",
        "",
    ])
    got = read(spark, csv(text), "invoice_id", "branch", "city", multi_line=multi_line)
    assert got == [
        ("X-1", 'say "A", B', "Yangon"),
        ("X-2", " NA ", "Yangon"),
        ("X-3", None, "Yangon"),
        ("X-4", None, "Yangon"),
        ("X-5", "B", None),
    ]


@pytest.mark.parametrize("field", ["branch", "invoice", "city"])
def test_line_break_in_quotes(spark, csv, field):
    path = csv(f"{HEADER}\n{line('X-1')}\n{line(**{field: '"a' + chr(10) + 'b"'})}\n")
    with pytest.raises(PySparkException, match="multi_line"):
        read(spark, path, "branch")
    column = {"invoice": "invoice_id"}.get(field, field)
    assert read(spark, path, column, multi_line=True)[1] == ("a\nb",)


def test_line_break_in_last_field_is_found(spark, csv):
    header = HEADER.replace(",Payment", "") + ",Payment"
    row = line().replace(",Cash", "") + ',"Ca\nsh"'
    path = csv(f"{header}\n{row}\n")
    with pytest.raises(PySparkException, match="multi_line"):
        read(spark, path, "payment")
    assert read(spark, path, "payment", multi_line=True) == [("Ca\nsh",)]


@pytest.mark.parametrize("extra", [",9", ",", ',"x,y"'])
@pytest.mark.parametrize("multi_line", [False, True])
def test_too_many_fields_fail(spark, csv, extra, multi_line):
    path = csv(f"{HEADER}\n{line()}\n{line('X-2')}{extra}\n")
    with pytest.raises(PySparkException, match="too many fields"):
        read(spark, path, "invoice_id", multi_line=multi_line)


def test_short_row_with_quoted_commas_is_padded(spark, csv):
    path = csv(f'{HEADER}\nX-1,"{"," * 40}"\n')
    assert read(spark, path, "branch", "city") == [("," * 40, None)]


def test_unknown_and_missing_columns(spark, csv):
    extra = "\n".join(f"{row},x" for row in GOLDEN.splitlines())
    with pytest.raises(ValueError, match="not in the raw table"):
        read_sales_csv(spark, csv(extra.replace("Rating,x", "Rating,Note")))
    shorter = "\n".join(row.rsplit(",", 1)[0] for row in GOLDEN.splitlines())
    got = read(spark, csv(shorter), "invoice_id", "rating")
    assert len(got) == 13 and {r[1] for r in got} == {None}


def test_files_with_different_headers_fail(spark, csv, tmp_path):
    csv(f"{HEADER}\n{line('X-1')}\n", "a.csv")
    other = HEADER.replace("Branch,City", "City,Branch")
    csv(f"{other}\n{line('X-2')}\n", "b.csv")
    with pytest.raises(Exception, match="header does not conform"):
        read(spark, str(tmp_path), "invoice_id")


def test_several_files_are_ordered_by_path(spark, csv, tmp_path):
    tmp_path = tmp_path / "with space"
    tmp_path.mkdir()
    csv(f"{HEADER}\n{line('X-3')}\n", "with space/b.csv")
    csv(f"{HEADER}\n{line('X-1')}\n{line('X-2')}\n", "with space/a.csv")
    assert read(spark, str(tmp_path), "invoice_id") == [("X-1",), ("X-2",), ("X-3",)]
    files = read_sales_csv(spark, str(tmp_path)).select("_ord_file").distinct().collect()
    assert sorted(r[0] for r in files) == ["a.csv", "b.csv"]


@pytest.mark.parametrize(
    ("old", "new", "message"),
    [
        ("10.00,1,", "abc,1,", "not a number"),
        ("10.00,1,", "10.00,one,", "not an integer"),
        ("10.00,1,", "1.23456,1,", "does not fit"),
        ("10.00,1,", "123456789012345.5,1,", "does not fit"),
    ],
)
def test_bad_numbers_fail_the_raw_load(spark, csv, old, new, message):
    with pytest.raises(PySparkException, match=message):
        read(spark, csv(changed(old, new)), "unit_price", "quantity")


def test_scale_is_a_parameter(spark, csv):
    text = changed("10.00,1,", "10.500000000000002,1,")
    for scale, error in ((4, "does not fit"), (14, "does not fit")):
        with pytest.raises(PySparkException, match=error):
            read(spark, csv(text), "unit_price", scale=scale)
    got = read(spark, csv(text), "invoice_id", "unit_price", "gross_margin_percentage", scale=15)
    assert ("I-08", Decimal("10.500000000000002"), Decimal("4.761904762")) in got
    with pytest.raises(ValueError, match="scale"):
        read_sales_csv(spark, csv(text), scale=1)


def test_further_digits_can_be_rounded_and_are_counted(spark, csv):
    prices = ["10.50005", "10.500049999999999999999999", "-0.00005", "1.0000", "1.00000", "1e-30", "7"]
    path = csv("\n".join([HEADER] + [line(price=p, rating="7.00001") for p in prices]))
    df = read_sales_csv(spark, path, round_digits=True)
    assert [r.unit_price for r in df.orderBy(*order_columns(df)).collect()] == [
        Decimal(p) for p in ("10.5001", "10.5000", "-0.0001", "1.0000", "1.0000", "0.0000", "7.0000")
    ]
    counts = rounded_counts(df).first().asDict()
    assert counts["rounded_unit_price"] == 4 and counts["rounded_rating"] == 7
    assert sum(counts.values()) == 11
    for bad in ("abc", "123456789012345.5"):
        with pytest.raises(PySparkException, match="not a number|does not fit"):
            read(spark, csv(changed("10.00,1,", f"{bad},1,")), "unit_price", round_digits=True)


def test_encoding(spark, csv, tmp_path):
    text = f"{HEADER}\n{line(city='Zürich')}\n{line('X-2')}\n"
    assert read(spark, csv(text), "city") == [("Zürich",), ("Yangon",)]
    latin = csv(text.encode("latin-1"), "latin/one.csv")
    assert read(spark, latin, "city", encoding="ISO-8859-1") == [("Zürich",), ("Yangon",)]
    with pytest.raises(PySparkException, match="not UTF-8.*one.csv"):
        read(spark, latin, "city")
    headed = csv(text.replace("City", "Stadt ü").encode("latin-1"), "latin2.csv")
    with pytest.raises(ValueError, match="header isn't UTF-8"):
        read_sales_csv(spark, headed)


def test_listing_runs_no_job_and_brings_no_paths(spark, csv, tmp_path):
    for i in range(4):
        csv(f"{HEADER}\n{line(f'X-{i}')}\n", f"many/{i}.csv")
    csv(f"{HEADER}\n{line('Y')}\n", "other/0.csv")
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "size of the source")
    assert source_bytes(spark, str(tmp_path / "many")) == 4 * len(f"{HEADER}\n{line('X-1')}\n")
    assert status.getJobIdsForGroup("listing") == []
    spark.sparkContext._jsc.clearJobGroup()
    one = read_sales_csv(spark, str(tmp_path / "many/2.csv")).first()
    assert one["_ord_file"] == "2.csv"
    # paths of a pattern stay whole, as names may repeat
    both = read_sales_csv(spark, str(tmp_path / "*/0.csv"))
    assert len({r["_ord_file"] for r in both.collect()}) == 2


def test_integers_are_rounded_half_away_from_zero(spark, csv):
    numbers = ["7.5", "2.5", "-2.5", "7.0", "7.49", " 3 "]
    path = csv("\n".join([HEADER] + [line(quantity=n) for n in numbers]))
    assert [r[0] for r in read(spark, path, "quantity")] == [8, 3, -3, 7, 7, 3]


def test_raw_load_does_not_depend_on_ansi_mode(spark, csv):
    spark.conf.set("spark.sql.ansi.enabled", False)
    try:
        with pytest.raises(PySparkException, match="not a number"):
            read(spark, csv(changed("10.00,1,", "abc,1,")), "unit_price")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_columns_are_matched_by_name(spark):
    df = spark.createDataFrame([(date(2019, 1, 5), "3", "A")], ["date", "quantity", "branch"])
    assert rows(to_raw(df).select("branch", "quantity", "date", "total")) == [("A", 3, "2019-01-05", None)]


@pytest.mark.parametrize("n_bytes", [10**12, 2 * 10**13, 10**14])
@pytest.mark.parametrize("growth", [1, 4, 8])
def test_blocks_and_reduce_partitions_stay_in_bounds(n_bytes, growth):
    partitions, split = sizes(n_bytes, growth)
    maps = -(-n_bytes // max(split, 128 << 20))
    shuffled = n_bytes * growth
    assert shuffled / partitions <= 4 << 30
    assert shuffled / (maps * partitions) >= 64_000


def test_small_inputs_need_nothing(spark):
    assert sizes(10**6)[0] == 1 and sizes(0)[0] == 1
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    with sized_for(spark, 10**6):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before[0]
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b"


def test_settings_last_as_long_as_the_load(spark):
    def settings():
        return spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.files.maxPartitionBytes")

    before, inside = settings(), []
    for n_bytes in (2 * 10**13, 10**14, 10**15):
        with pytest.raises(RuntimeError), sized_for(spark, n_bytes):
            inside.append((int(settings()[0]), int(settings()[1].removesuffix("b"))))
            raise RuntimeError
        assert settings() == before
    # a larger input in the same session has larger splits again
    assert inside == sorted(inside) and inside[0][1] < inside[1][1] < inside[2][1]


def test_numbers_of_other_types_are_converted_exactly(spark):
    df = spark.createDataFrame([(0.1, 7.5, 123456789.25)], ["unit_price", "quantity", "total"])
    assert rows(to_raw(df).select("unit_price", "quantity", "total")) == [
        (Decimal("0.1000"), 8, Decimal("123456789.2500"))
    ]
    finer = spark.createDataFrame([(Decimal("1.23456"),)], "unit_price decimal(20,6)")
    with pytest.raises(PySparkException, match="does not fit"):
        to_raw(finer).collect()


def test_file_without_header(spark, csv):
    with pytest.raises(ValueError, match="no header"):
        read_sales_csv(spark, csv(""))
