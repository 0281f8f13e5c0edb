"""Table operators: skipping, errors, order of steps, awkward types."""

import importlib
import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import scrub
from scrub import Action, ConvertOptions, DerivedColumn, Rule, SchemaError, SchemaSpec

# The package offers the function of the same name.
quantile_code = importlib.import_module("scrub.operators.quantiles")


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order or df.columns).collect()]


# --- strings, types ------------------------------------------------------------------------------


def test_strings_leave_other_types_alone(spark):
    df = spark.createDataFrame([(" a ", [" b "], 1)], "s string, a array<string>, i int")
    assert rows(scrub.clean_strings(df, case="upper")) == [("A", [" b "], 1)]
    with pytest.raises(ValueError):
        scrub.clean_strings(df, case="camel")


def test_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(" 1 ", None)], "`a.b` string, `c d` double")
    cleaned = scrub.fill_nulls(scrub.convert_types(scrub.clean_strings(df), {"a.b": "int"}),
                               numbers=0)
    assert rows(cleaned, F.col("`a.b`")) == [(1, 0.0)]
    assert scrub.profile(df).count() == 2
    assert scrub.dedup(df, ["a.b"]).count() == 1


def test_same_type_is_skipped_and_bad_target_reported(spark):
    df = spark.createDataFrame([(1, "x")], "a bigint, b string")
    report = scrub.conversion_report(df, {"a": "LONG", "b": "no_such_type"}).collect()
    assert [(r.column_name, r.failed) for r in report] == [("b", True)]
    assert scrub.convert_types(df, {"b": "no_such_type"}, infer=False).dtypes == df.dtypes


def test_conversion_of_other_types(spark):
    df = spark.sql("SELECT 20240102 AS day, 1 AS yes, timestamp_ntz'2024-01-02 03:04:05' AS ts, "
                   "2.7D AS d")
    done = scrub.convert_types(
        df, {"day": "date", "yes": "boolean", "ts": "date", "d": "int"}, infer=False
    )
    assert rows(done) == [(date(2024, 1, 2), True, date(2024, 1, 2), 2)]


def test_string_policy_changes_the_type_only_when_needed(spark):
    options = ConvertOptions(precision=7, scale=2, overflow="string")
    df = spark.createDataFrame([("1.5", "1.5"), ("2", "abc")], "a string, b string")
    done = scrub.convert_types(df, {"a": "decimal", "b": "decimal"}, False, options)
    assert done.dtypes == [("a", "decimal(7,2)"), ("b", "string")]


def test_inference(spark):
    data = [(str(i), f"{i},000.5", "yes", f"2024-01-{i % 28 + 1:02d}", None, f"{i}.0", "007")
            for i in range(100)]
    df = spark.createDataFrame(
        data, "a string, b string, c string, d string, e string, f string, g string"
    )
    done = scrub.convert_types(df)
    assert dict(done.dtypes) == {
        "a": "bigint", "b": "decimal(38,10)", "c": "boolean", "d": "date", "e": "string",
        "f": "bigint", "g": "bigint",
    }
    first = done.where("a = 3").first()
    assert (first.b, first.f, first.g) == (Decimal("3000.5"), 3, 7)
    assert dict(scrub.convert_types(df, {"g": "string"}).dtypes)["g"] == "string"


def test_inference_of_nothing(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert rows(scrub.infer_types(df)) == [("a", "string")]
    assert scrub.infer_shares(df.select("b")).count() == 0
    assert scrub.convert_types(df).dtypes == df.dtypes


# --- nulls ---------------------------------------------------------------------------------------


def test_fills(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(None, nan, None, None, None), ("x", 1.0, 2, date(2024, 1, 1), True)],
        "s string, d double, i int, t date, b boolean",
    )
    done = scrub.fill_nulls(df, "N/A", "0.5", "2000-01-01", "TRUE")
    assert rows(done, "s") == [
        ("N/A", 0.5, 0, date(2000, 1, 1), True), ("x", 1.0, 2, date(2024, 1, 1), True),
    ]
    assert done.schema["t"].dataType == df.schema["t"].dataType


def test_fill_with_the_clock_keeps_the_type(spark):
    df = spark.sql("SELECT CAST(NULL AS DATE) AS d, CAST(NULL AS TIMESTAMP_NTZ) AS t")
    done = scrub.fill_nulls(df, dates="current_timestamp")
    assert done.dtypes == df.dtypes
    assert None not in done.first()


def test_fill_that_does_not_fit_changes_nothing(spark):
    df = spark.sql("SELECT CAST(NULL AS DECIMAL(3,1)) AS a, CAST(NULL AS DATE) AS d")
    with pytest.warns(UserWarning):
        assert scrub.fill_nulls(df, numbers="many").first().a is None
    assert rows(scrub.fill_nulls(df, numbers="12345", dates="someday")) == [(None, None)]
    assert rows(scrub.fill_nulls(df, numbers="1", skip=["a"])) == [(None, None)]


def test_drop_null_keys(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0), (None, 1.0)], "a int, b double")
    assert rows(scrub.drop_null_keys(df, ["a", "b", "zzz"])) == [(2, 1.0)]


# --- rules ---------------------------------------------------------------------------------------


@pytest.fixture
def three(spark):
    return spark.createDataFrame([(1, "x"), (None, "y"), (-1, "z")], "a int, s string")


def test_unknown_condition(three):
    drop = [Rule("a", "a < 0")]
    assert rows(scrub.apply_rules(three, drop).clean) == [(1, "x")]
    passed = scrub.apply_rules(three, drop, unknown="pass").clean
    assert rows(passed, "s") == [(1, "x"), (None, "y")]
    moved = scrub.apply_rules(three, [Rule("a", "a < 0", Action.QUARANTINE, "neg")])
    assert rows(moved.clean, "s") == [(1, "x"), (None, "y")]
    assert [r.quarantine_reason for r in moved.quarantined.collect()] == ["neg"]


@pytest.mark.parametrize("default", [0, 7])
def test_defaults_that_look_like_nothing(three, default):
    rule = Rule("a", "a < 0", Action.SET_DEFAULT, default=default)
    assert rows(scrub.apply_rules(three, [rule]).clean, "s")[-1] == (default, "z")
    empty = Rule("s", "s = 'z'", Action.SET_DEFAULT, default="")
    assert rows(scrub.apply_rules(three, [empty]).clean, "s")[0] == (-1, "")


def test_skipped_rules_are_reported(three):
    rules = [
        Rule("a", "a < 0", enabled=False),
        Rule("nope", "a < 0"),
        Rule("a", "no_such_function(a)"),
        Rule("a", "a < 0", Action.SET_DEFAULT),
        Rule("a", "a < 0", Action.QUARANTINE),
        Rule("a", "sum(a) > 1"),
        Rule("a", "a + 1", Action.FLAG_RECORD),
    ]
    result = scrub.apply_rules(three, rules, quarantine=False)
    status = [s.split(":")[0] for s in result.status]
    assert status == ["disabled", "no such column", "failed", "no default", "quarantine is off",
                      "failed", "failed"]
    assert result.clean.count() == 3 and result.quarantined.count() == 0
    assert [r.affected_records for r in result.counts.collect()] == [0] * 7


def test_rows_taken_out_stay_as_they_were(three):
    result = scrub.apply_rules(three, [
        Rule("s", "s = 'x'", Action.QUARANTINE, "first"),
        Rule("a", "true", Action.SET_DEFAULT, "ten", default=10),
        Rule("a", "a = 10", Action.FLAG_RECORD, "ten"),
        Rule("s", "s = 'z'", Action.QUARANTINE, "second"),
    ])
    moved = result.quarantined.select("a", "s", "a_ten_flag", "quarantine_reason")
    assert rows(moved, "s") == [(1, "x", None, "first"), (10, "z", True, "second")]
    assert rows(result.clean) == [(10, "y", True)]
    assert [r.affected_records for r in result.counts.orderBy("rule_order").collect()] == [1, 2, 2, 1]


def test_conditions_do_not_run_on_rows_already_out(spark):
    df = spark.createDataFrame([(0,), (4,)], "a int")
    rules = [Rule("a", "a = 0", Action.QUARANTINE), Rule("a", "8 / a > 3")]
    assert rows(scrub.apply_rules(df, rules).clean) == [(4,)]


# --- outliers, quantiles -------------------------------------------------------------------------


def test_outliers_of_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "y")], "a int, b double, s string")
    assert scrub.flag_outliers(df, "zscore").columns == ["a", "b", "s"]
    assert scrub.flag_outliers(df, "iqr").columns == ["a", "b", "s", "a_outlier_iqr"]
    with pytest.raises(ValueError):
        scrub.flag_outliers(df, "forest")


def test_null_is_no_outlier(spark):
    df = spark.createDataFrame([(i,) for i in [*range(100), 10_000, None]], "a int")
    flagged = scrub.flag_outliers(df, "iqr").where("a_outlier_iqr")
    assert rows(flagged) == [(10_000, True)]
    tails = scrub.flag_outliers(spark.range(1, 1001).toDF("a"), "isolation")
    assert 18 <= tails.where("a_outlier_isolation").count() <= 22


@pytest.mark.parametrize("values", [
    [random.Random(1).gauss(0, 100) for _ in range(30_000)],
    [float(i % 7) for i in range(20_000)],
    [0.0] * 9_000 + [float(i) for i in range(20_000)],
    [1.0] * 10_000 + [2.0] * 10_000,
    [float(i) ** 9 for i in range(15_000)],
])
def test_exact_quantiles_by_narrowing_equal_the_built_in(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    wanted = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    narrowed = scrub.quantiles(df, ["v"], wanted, exact=True, exact_values=700)["v"]
    built_in = df.where("NOT isnan(v)").agg(F.percentile("v", wanted)).first()[0]
    assert narrowed == pytest.approx(built_in, rel=1e-12)


@pytest.mark.parametrize("margin, size", [(quantile_code.MARGIN, quantile_code.SKETCH_SIZE), (0.0, 8)])
def test_exact_quantiles_keep_all_digits(spark, monkeypatch, margin, size):
    """Whole numbers beyond a double's 53 bits and decimals, also where sketches miss the ranks."""
    monkeypatch.setattr(quantile_code, "MARGIN", margin)
    monkeypatch.setattr(quantile_code, "SKETCH_SIZE", size)
    random.seed(2)
    big = [2**60 + random.randrange(5000) for _ in range(4001)]
    price = [Decimal(random.randrange(10**17)).scaleb(-4) for _ in range(4001)]
    rows_ = [(a, b, random.choice([None, 3, 4])) for a, b in zip(big, price)]
    df = spark.createDataFrame(rows_, "a long, b decimal(18,4), c int")
    wanted = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    found = scrub.quantiles(df, ["a", "b", "c"], wanted, exact=True, exact_values=50)
    assert found["a"] == [sorted(big)[round(p * 4000)] for p in wanted]
    assert found["b"] == [sorted(price)[round(p * 4000)] for p in wanted]
    built_in = df.agg(F.percentile("c", wanted)).first()[0]
    assert found["c"] == built_in


def test_exact_quantiles_read_the_table_twice(spark):
    df = spark.range(60_000).select("id", (F.col("id") * 7 % 1009).alias("b"), F.rand(3).alias("c"))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    found = scrub.quantiles(df.mapInArrow(counted, df.schema), df.columns, [0.01, 0.25, 0.5, 0.75, 0.99], exact=True)
    assert found["id"][2] == 29999.5
    assert 0 < read.value <= 2 * 60_000


# --- duplicates, derived columns, audit ----------------------------------------------------------


def test_dedup_with_nulls_and_maps(spark):
    df = spark.createDataFrame(
        [(1, None, {"a": 1}), (1, None, {"a": 1}), (1, 5, {"a": 2})], "a int, b int, m map<string,int>"
    )
    assert scrub.dedup(df).count() == 2
    assert rows(scrub.dedup(df, ["a"]).select("a", "b")) == [(1, None)]
    assert rows(scrub.dedup_counts(df)) == [(3, 2, 1)]
    assert scrub.dedup(df, ["zzz"]).count() == 2
    assert scrub.dedup(df, ["a"]).columns == df.columns


def test_derive_skips_what_does_not_fit(spark):
    df = spark.createDataFrame([("5",)], "a string")
    specs = [
        DerivedColumn("b", "a || 'x'"),
        DerivedColumn("c", "b || 'y'", dependencies=("b",)),
        DerivedColumn("d", "a", "int"),
        DerivedColumn("e", "c", "int"),
        DerivedColumn("f", "zzz + 1"),
        DerivedColumn("g", "a", dependencies=("zzz",)),
    ]
    assert rows(scrub.derive(df, specs)) == [("5", "5x", "5xy", 5, None)]
    status = [s.split(":")[0] for _, s in scrub.derive_report(df, specs)]
    assert status == ["applied"] * 4 + ["failed", "missing"]


def test_audit(spark):
    df = spark.createDataFrame([(1, "x")], "a int, etl_note string")
    row = scrub.add_audit(df, "j", "src", 99.5).first()
    assert (row.etl_job_id, row.etl_source_path, row.etl_quality_score) == ("j", "src", 99.5)
    assert row.etl_load_timestamp is not None
    expected = df.select(F.md5(F.lit("1|x"))).first()[0]
    assert row.etl_row_hash == expected
    again = scrub.add_audit(scrub.add_audit(df, "j", "src")).first()
    assert again.etl_row_hash == expected


# --- schema, profile, scores ---------------------------------------------------------------------


def test_schema(spark):
    df = spark.createDataFrame([], "a bigint, b string, c timestamp_ntz")
    types = {"a": "bigint", "b": "int", "c": "timestamp", "zzz": "int"}
    issues = scrub.validate_schema(df, SchemaSpec(["a"], column_types=types))
    assert [(i.column, i.expected, i.actual) for i in issues] == [("b", "int", "string")]
    for spec in (SchemaSpec(["zzz"]), SchemaSpec(min_columns=4), SchemaSpec(max_columns=2)):
        with pytest.raises(SchemaError):
            scrub.validate_schema(df, spec)


def test_profile_of_every_type(spark):
    df = spark.sql("""SELECT * FROM VALUES
      ('a', 1, 1.5D, 2.50BD, true, date'2024-01-01', array('x'), map('k', 1), x'01', 7S,
       interval '1' day),
      (' ', -1, double('NaN'), NULL, false, date'2024-03-01', NULL, NULL, NULL, 7S,
       interval '2' day),
      ('', 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 7S, NULL)
      AS t(s, i, d, dec, b, dt, arr, m, bin, sh, iv)""")
    found = {r.column_name: r for r in scrub.profile(df).collect()}
    assert (found["s"].empty_string_count, found["s"].whitespace_only_count) == (1, 2)
    assert (found["i"].zero_count, found["i"].negative_count, found["i"].mean) == (1, 1, 0.0)
    assert (found["d"].nan_count, found["d"].null_count, found["d"].unique_count) == (1, 1, 3)
    assert (found["d"].mean, found["d"].max_value) == (1.5, "1.5")
    assert found["dec"].min_value == "2.50"
    assert (found["b"].true_percentage, found["b"].false_count) == (50.0, 1)
    assert found["dt"].date_range_days == 60
    assert [found[c].unique_count for c in ("arr", "m", "bin", "sh", "iv")] == [2, 2, 2, 1, 3]
    assert found["sh"].std_dev == 0.0 and found["iv"].mean is None
    estimated = {r.column_name: r.unique_count
                 for r in scrub.profile(df.drop("m"), approx_distinct=True).collect()}
    assert estimated == {k: v.unique_count for k, v in found.items() if k != "m"}


def test_profile_of_columns_without_values(spark):
    df = spark.sql("SELECT CAST(NULL AS DOUBLE) d, CAST(NULL AS INT) i, CAST(NULL AS STRING) s")
    for r in scrub.profile(df).collect():
        assert (r.min_value, r.max_value, r.q1, r.min_length) == (None,) * 4
        assert (r.total_records, r.null_count, r.unique_count) == (1, 1, 1)
        assert r.mean in (None, 0.0)


def test_long_texts_are_told_apart(spark):
    long = "x" * 5000
    df = spark.createDataFrame([(long + "a",), (long + "b",), (long + "b",), ("x",)], "s string")
    assert scrub.profile(df).first().unique_count == 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "s string, d double, t timestamp, b boolean")
    for r in scrub.profile(df).collect():
        assert (r.total_records, r.null_percentage, r.uniqueness_percentage) == (0, 0.0, 0.0)
        assert r.unique_count == 0
    assert scrub.completeness(df).first().completeness_score == 100.0
    assert scrub.consistency(df).first().consistency_score == 100.0
    assert rows(scrub.dedup_counts(df)) == [(0, 0, 0)]
    assert scrub.quantiles(df, ["d"], [0.5], exact=True) == {"d": None}


def test_scores_do_not_count_audit_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b")], "x int, y double, etl_job_id string")
    assert scrub.completeness(df).first().completeness_score == 50.0
    assert scrub.consistency(df).first().consistency_score == 50.0
    report = scrub.before_after(df, df).collect()
    assert [(r.completeness_score, r.consistency_score) for r in report] == [(50.0, 50.0)] * 2
