"""Column expressions on the awkward values."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import scrub
from scrub.functions import parse, text
from scrub.functions.hashing import row_hash


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def outcome(df, value):
    return [r.x for r in df.select("i", value.alias("x")).orderBy("i").collect()]


def v():
    return F.col("v")



def test_title_case(spark):
    df = column(spark, ["o'neil mc-DONALD x_y 3rd éa", "", None, "ärger-über  alles"])
    assert outcome(df, text.title_case(v())) == [
        "O'Neil Mc-Donald X_y 3rd Éa", "", None, "Ärger-Über  Alles",
    ]


def test_trim_cuts_spaces_only_and_runs_before_collapse(spark):
    df = column(spark, ["\t a \n b  ", "  a  "])
    assert outcome(df, text.collapse_whitespace(text.trim_spaces(v()))) == [" a b", "a"]


def test_alphanumeric_drops_accents_and_keeps_white_space(spark):
    assert outcome(column(spark, ["é-a_1 \tb!"]), text.keep_alphanumeric(v())) == ["a1 \tb"]


@pytest.mark.parametrize("value, expected", [
    ("2024-01-31", date(2024, 1, 31)), ("01/02/2024", date(2024, 2, 1)),
    ("12/25/2023", date(2023, 12, 25)), ("01-02-2024", date(2024, 1, 2)),
    ("20240102", date(2024, 1, 2)), ("2024.01.02", date(2024, 1, 2)),
    ("1/2/2024", date(2024, 1, 2)), ("001/002/2024", date(2024, 1, 2)),
    ("2024-13-01", None), ("x", None), ("", None), (None, None),
])
def test_later_date_formats_win(spark, value, expected):
    assert outcome(column(spark, [value]), parse.parse_date(v())) == [expected]


def test_far_years_do_not_stop_the_job(spark):
    far = ["+1234567-01-01", "+294248-01-01", "+1234567 Jan 1"]
    formats = ["yyyy-MM-dd", "yyyy MMM d"]
    assert outcome(column(spark, far), parse.parse_date(v(), formats)) == [None] * 3
    assert outcome(column(spark, ["2024 Jan 5"]), parse.parse_date(v(), formats)) == [date(2024, 1, 5)]


def date_like(n):
    rnd = random.Random(5)
    numbers = ["1", "01", "12", "13", "31", "32", "2024", "0001", "12345", "+12345", "-2024",
               "+2024", "+99999", "20240102", "99", "0", "00", "24", "59", "60", "", "٣", "001"]
    texts = {" 2024-01-02", "2024-01-02 ", "2024-01-02\n", "2024-01-02t03:04:05.678z",
             "5 Jan 2024", "x" * 60, "+123450102", "135650.12"}
    while len(texts) < n:
        sep = rnd.choice("-/. ")
        day = sep.join(rnd.choice(numbers) for _ in range(3))
        if rnd.random() < 0.4:
            day = f"{rnd.randint(1, 9999):04d}{sep}{rnd.randint(1, 13):02d}{sep}{rnd.randint(1, 32):02d}"
        if rnd.random() < 0.5:
            day += rnd.choice([" ", "T", "t", "  "])
            day += ":".join(f"{rnd.randint(0, 61):02d}" for _ in range(3))
            day += rnd.choice(["", ".123", ".123Z", ".1", "Z"])
        texts.add(day)
    return sorted(texts)


@pytest.mark.parametrize("formats, kind", [
    (parse.DATE_FORMATS, "date"),
    (parse.TIMESTAMP_FORMATS, "timestamp"),
    (("M/d/yyyy H:m:s", "yyyy-MM-dd", "d MMM yyyy", "yyyy/MM/dd"), "date"),
    (("d MMM yyyy",), "date"),
    (("yyyy'T1'MM-d", "yyyy MM"), "date"),
])
def test_shapes_read_what_trying_every_format_reads(spark, formats, kind):
    df = column(spark, date_like(4000)).repartition(8)
    if kind == "date":
        plain = F.coalesce(*[F.try_to_date(v(), f) for f in reversed(formats)])
        quick = parse.parse_date(v(), formats)
    else:
        plain = F.coalesce(*[F.try_to_timestamp(v(), F.lit(f)) for f in reversed(formats)])
        quick = parse.parse_timestamp(v(), formats)
    both = df.select("v", plain.cast("string").alias("a"), quick.cast("string").alias("b"))
    assert both.where("NOT (a <=> b)").collect() == []


@pytest.mark.parametrize(
    "formats", [parse.DATE_FORMATS, parse.TIMESTAMP_FORMATS, ("MMM d, yyyy", "d MMMM yyyy"), ("yyyy-MM-dd", "d MMMM yyyy"), ()]
)
def test_a_text_has_a_reading_where_it_is_read(spark, formats):
    texts = [
        "2024-01-02", "01/02/2024", "13/13/2024", "001/02/2024", "1/2/2024", "+123456-01-01", "-290308-01-01", "+999999-12-31",
        "+12345-01-02", "", "abc", "2024-01-02 10:00:00", "2024-01-02T25:00:00", "20240102", "99999999", "31.13.2024",
        "2024.02.30", " 2024-01-02", "1/2/+12345", "Jan 5, 2024", "5 January 2024", None,
    ]
    df = column(spark, texts)
    read = outcome(df, parse._first_reading(v(), formats, "timestamp").isNotNull())
    assert outcome(df, parse.has_reading(v(), formats)) == read
    shape = parse.shape_of(v(), *formats, *parse.TIMESTAMP_FORMATS)
    assert outcome(df, parse.has_reading(v(), formats, shape)) == read


def test_no_formats_read_nothing(spark):
    assert outcome(column(spark, ["2024-01-01"]), parse.parse_date(v(), [])) == [None]


def test_timestamps(spark):
    df = column(spark, ["2024-01-02 03:04:05", "2024-01-02T03:04:05.678Z", "01/02/2024 03:04:05"])
    found = outcome(df, parse.parse_timestamp(v()).cast("timestamp_ntz"))
    assert found == [
        datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 678000),
        datetime(2024, 2, 1, 3, 4, 5),
    ]


def test_booleans(spark):
    df = column(spark, [" Yes ", "T", "ON", "1", "off", "N", "0", "maybe", "", None])
    assert outcome(df, parse.parse_boolean(v())) == [True] * 4 + [False] * 3 + [None] * 3


@pytest.mark.parametrize("value, expected", [
    ("1e30", "99999.99"), ("-1e30", "-99999.99"), ("99999.996", "99999.99"), ("5.555", "5.56"),
    ("nan", None), ("inf", None), ("-Infinity", None), ("abc", None), (None, None), ("7", "7.00"),
])
def test_decimals_are_clamped(spark, value, expected):
    found = outcome(column(spark, [value]), parse.parse_decimal(v(), 7, 2, "truncate"))
    assert found == [None if expected is None else Decimal(expected)]


def test_widest_decimal_is_clamped_exactly(spark):
    found = outcome(column(spark, ["1e30"]), parse.parse_decimal(v(), 38, 10, "truncate"))
    assert found == [Decimal("9" * 28 + "." + "9" * 10)]


def test_decimals_kept_as_text(spark):
    df = column(spark, ["1.5", "abc", "1e30", None])
    assert outcome(df, parse.parse_decimal(v(), 7, 2, "string")) == ["1.50", "abc", "1e30", None]


def test_integers_cut_the_fraction(spark):
    df = column(spark, ["12", "12.9", "-3.7", "1e3", "abc", "99999999999", " 5 ", "1."])
    assert outcome(df, parse.parse_integer(v(), "int")) == [12, 12, -3, None, None, None, 5, 1]


@pytest.mark.parametrize("value, number, whole", [
    ("1,234", True, True), ("1.0", True, True), ("1.5", True, False), ("1e400", True, False),
    ("1_000", False, False), ("nan", False, False), ("inf", False, False), ("1d", False, False),
    (" 7\n", True, True), ("", False, False), (".5", True, False), ("-", False, False),
])
def test_number_probes(spark, value, number, whole):
    df = column(spark, [value])
    assert outcome(df, parse.is_number(v())) == [number]
    assert outcome(df, parse.is_whole_number(v())) == [whole]


def test_hash_leaves_nulls_out_unless_told(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = df.select(row_hash(df, df.columns).alias("h")).collect()
    marked = df.select(row_hash(df, df.columns, null_token="~").alias("h")).collect()
    assert plain[0].h == plain[1].h
    assert marked[0].h != marked[1].h


def test_hash_of_nested_columns(spark):
    df = spark.createDataFrame(
        [(1, {"a": 1}, (1, "x"), [1.5], ["p", "q"])],
        "i int, m map<string,int>, s struct<a:int,b:string>, f array<float>, t array<string>",
    )
    assert len(df.select(row_hash(df, df.columns).alias("h")).first().h) == 32
    assert df.select(row_hash(df, []).alias("h")).first().h is None


def test_fill_values_keep_digits_and_say_when_they_do_not_fit(spark):
    df = spark.createDataFrame([(None, None, None, None)], "a long, b decimal(25,2), c double, t timestamp")
    filled = scrub.fill_nulls(df, numbers=str(2**62 + 1)).first()
    assert (filled.a, filled.b, filled.c) == (2**62 + 1, Decimal(2**62 + 1), float(2**62 + 1))
    assert scrub.fill_nulls(df, numbers="12345678901234567890123").first().b == Decimal("12345678901234567890123")
    assert scrub.fill_nulls(df, numbers="0.5").first().c == 0.5
    with pytest.warns(UserWarning, match="is no timestamp, NULL stays in t"):
        assert scrub.fill_nulls(df, dates="2024-01-02").first().t is None
