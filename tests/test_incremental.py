"""Batches against one run: duplicates, statistics, types, and all of them in incremental cleaning."""

import itertools
import json
import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import scrub
from catalog.fixtures import table
from scrub.functions.hashing import row_digest
from scrub.operators.outliers import limits_of, measured_limits
from scrub.operators.parts import RANK_ERROR
from scrub.operators.types import PROBES

SF_DIR = "/root/testdata/sf0.001"


def bag(df, columns=None):
    return sorted(repr(tuple(r)) for r in df.select(columns or df.columns).collect())


def split(df, n, seed=1):
    return df.randomSplit([1.0] * n, seed)


def union(frames):
    return reduce(DataFrame.unionByName, frames)


# --- statistics -----------------------------------------------------------------------------------

ESTIMATES = {"unique_count", "uniqueness_percentage", "q1", "median", "q3"}


@pytest.mark.parametrize("name, n", [("lineitem", 5), ("dirty_events", 7), ("orders_text", 1)])
def test_merged_profile_is_the_profile(spark, name, n):
    df = table(spark, SF_DIR, name)
    if name == "dirty_events":
        df = df.withColumns({"price": F.expr("CAST(value AS DECIMAL(30,4))"), "day": F.to_date("ts"), "none": F.expr("CAST(NULL AS INT)")})
    parts = union([scrub.profile_part(p) for p in split(df, n)])
    merged = {r.column_name: r.asDict() for r in scrub.merge_profiles(parts, df.schema).collect()}
    whole = {r.column_name: r.asDict() for r in scrub.profile(df, exact_quantiles=True).collect()}
    for column, expected in whole.items():
        for key, value in expected.items():
            if key not in ESTIMATES:
                assert merged[column][key] == pytest.approx(value, rel=1e-9, abs=2e-4) if isinstance(value, float) else merged[column][key] == value
        assert merged[column]["unique_count"] == pytest.approx(expected["unique_count"], rel=0.05)
    ranks, checks = [], []
    for column, r in merged.items():
        if r["median"] is not None:
            c = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
            for share, value in ((0.25, r["q1"]), (0.5, r["median"]), (0.75, r["q3"])):
                ranks += [F.count_if(c < value), F.count_if(c <= value), F.count(c)]
                checks.append(share)
    found = list(df.agg(*ranks).first()) if ranks else []
    for share, below, up_to, size in zip(checks, found[::3], found[1::3], found[2::3]):
        assert below / size - RANK_ERROR - 1 / size <= share <= up_to / size + RANK_ERROR + 1 / size


def test_profile_of_no_part_and_of_empty_parts(spark):
    df = table(spark, SF_DIR, "dirty_events")
    empty = {r.column_name: r.asDict() for r in scrub.profile(df.limit(0)).collect()}
    for parts in (scrub.profile_part(df).limit(0), scrub.profile_part(df.limit(0))):
        assert {r.column_name: r.asDict() for r in scrub.merge_profiles(parts, df.schema).collect()} == empty


@pytest.mark.parametrize("method", ["iqr", "zscore", "isolation"])
def test_merged_limits_flag_as_one_run_does(spark, method):
    df = table(spark, SF_DIR, "dirty_events").withColumn("none", F.expr("CAST(NULL AS INT)")).withColumn("same", F.lit(7))
    parts = union([scrub.profile_part(p) for p in split(df, 5)])
    limits = scrub.part_limits(parts, df.schema, method)
    expected = measured_limits(df, ["event_id", "user_id", "value", "none", "same"], method, exact=True)
    assert limits.keys() == expected.keys()
    if method == "zscore":
        assert bag(scrub.flag_outliers(df, method, limits=limits)) == bag(scrub.flag_outliers(df, method))
    else:
        # As limits by rank: those of one run with quantiles a little to either side hold those of the parts.
        low, high = (0.25, 0.75) if method == "iqr" else (0.01, 0.99)
        near = RANK_ERROR + 1 / df.count()
        for c, own in limits.items():
            q = scrub.quantiles(df, [c], [low - near, low + near, high - near, high + near], exact=True)[c]
            out, in_ = (limits_of(method, quantiles_=x) for x in ((q[0], q[3]), (q[1], q[2])))
            assert out.low <= own.low <= in_.low and in_.high <= own.high <= out.high


# --- types ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_types_do_not_depend_on_the_split(spark, seed):
    df = table(spark, SF_DIR, "orders_text").withColumn("none", F.expr("CAST(NULL AS STRING)"))
    random.seed(seed)
    # Parts that say different things: sorted by a column, then cut at random places.
    order = random.choice(df.columns)
    rows = df.orderBy(order).collect()
    cuts = sorted(random.sample(range(len(rows)), 4))
    parts = [spark.createDataFrame(rows[a:b], df.schema) for a, b in zip([0, *cuts], [*cuts, len(rows)]) if b > a]
    random.shuffle(parts)
    counts = scrub.add_type_counts(union([scrub.type_counts(p) for p in parts]))
    assert bag(scrub.types_of_counts(counts)) == bag(scrub.infer_types(df))
    assert bag(counts) == bag(scrub.type_counts(df).select(counts.columns))


def test_one_file_is_probed_by_all_cores(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 1).selectExpr(
        "CAST(id AS STRING) AS n", "CAST(date_add(DATE'2020-01-01', CAST(id AS INT)) AS STRING) AS day"
    )
    rows.write.parquet(str(tmp_path / "one"))
    counts = scrub.type_counts(spark.read.parquet(str(tmp_path / "one")))
    assert "RepartitionByExpression" in counts._jdf.queryExecution().optimizedPlan().toString()
    found = {r.column_name: r for r in counts.collect()}
    assert found["n"].integer_count == found["day"].date_count == 4000 and found["day"].numeric_count == 0


def test_the_wider_type_is_a_join():
    kinds = [None, "boolean", "long", "decimal", "timestamp", "date", "string"]
    join = scrub.wider_type
    assert len(PROBES) == 6
    for a, b, c in itertools.product(kinds, repeat=3):
        assert join(a, a) == a and join(a, b) == join(b, a)
        assert join(join(a, b), c) == join(a, join(b, c))
    assert (join("long", "decimal"), join("date", "timestamp"), join("boolean", "long")) == ("decimal", "timestamp", "string")


# --- duplicates -----------------------------------------------------------------------------------


def test_digests_tell_rows_apart(spark):
    rows = [
        (None, "x", 0.0, [1, None]), ("x", None, 0.0, [1, None]), ("x", None, -0.0, [1, None]), ("x", None, float("nan"), [1, None]),
        ("x", None, float("nan"), [1, None]), ("x", "", 0.0, [1]), ("x", "", 0.0, None), ("x\"", "", 0.0, None), ("x", "\",", 0.0, None),
    ]
    df = spark.createDataFrame(rows, "a string, b string, c double, d array<int>")
    stamps = "SELECT timestamp'2024-11-03 01:30:00.000001Z' AS t UNION ALL SELECT timestamp'2024-11-03 01:30:00.000002Z'"
    assert df.select(row_digest(df)).distinct().count() == df.distinct().count() == 7
    assert spark.sql(stamps).select(row_digest(spark.sql(stamps))).distinct().count() == 2


def drop_files(df, source, n, seed=5):
    """The rows as ``n`` CSV files in a new folder each, which come one after the other."""
    for i, part in enumerate(split(df, n, seed)):
        part.coalesce(1).write.option("header", True).csv(f"{source}/{i}")
        yield i


CONFIG = {
    "CRITICAL_NULL_COLUMNS": "customer_id", "STANDARDIZE_STRING_CASE": "lower", "FILL_NULL_STRINGS_WITH": "none",
    "CUSTOM_VALIDATION_RULES_JSON": json.dumps([
        {"column": "amount", "rule_name": "small", "rule": "amount < 40000", "action": "quarantine"},
        {"column": "is_active", "rule_name": "off", "rule": "is_active = 'maybe'", "action": "drop_row"},
    ]),
    "TYPE_CONVERSION_MAP": json.dumps({"amount": "decimal(12,2)", "order_date": "date"}),
    "CUSTOM_DERIVED_COLUMNS_JSON": json.dumps([{"name": "twice", "expression": "amount * 2"}]),
}
COUNTERS = [
    "total_records", "duplicate_records", "null_records", "quarantined_records", "validation_failures", "input_records",
    "output_records", "completeness_score", "consistency_score", "validity_score", "overall_quality_score",
]


@pytest.mark.parametrize("subset", ["", "customer_id,priority"])
def test_batches_are_one_run(spark, tmp_path, subset):
    """Files that come in two calls, one of several batches, give the rows, counters and profile of one run."""
    orders = table(spark, SF_DIR, "dirty_orders")
    text = orders.select(*[F.col(c).cast("string") for c in orders.columns])
    source = tmp_path / "in"
    settings = CONFIG | {"S3_SOURCE_PATH": str(source), "DROP_DUPLICATE_SUBSET": subset, "ENABLE_OUTLIER_DETECTION": "true", "OUTLIER_METHOD": "zscore"}
    schema = ", ".join(f"{c} string" for c in text.columns)
    found = None
    for i in drop_files(text, source, 3):
        if i:
            found = scrub.clean_incrementally(
                spark, settings | {"S3_TARGET_PATH": str(tmp_path / "steps")}, schema, str(tmp_path / "cp"), files_per_batch=1, state_partitions=3
            )
    whole = scrub.run(spark, settings | {"S3_TARGET_PATH": str(tmp_path / "whole")})
    columns = [c for c in whole.clean.columns if not c.startswith("etl_") and "outlier" not in c]
    assert found.inferred == whole.shaped.inferred
    assert bag(found.clean, columns) == bag(whole.clean, columns)
    assert found.written.select("batch").distinct().count() > 1
    moved = [c for c in whole.quarantine.columns if c != "quarantine_timestamp"]
    assert bag(spark.read.parquet(f"{tmp_path}/steps_quarantine"), moved) == bag(whole.quarantine, moved)
    one, other = found.metrics.first(), whole.metrics.first()
    for c in COUNTERS:
        if subset and c == "duplicate_records":
            assert other[c] == one[c] > 0
        assert one[c] == pytest.approx(other[c])
    merged, profile = found.profile, whole.profile
    same = ["column_name", "data_type", "total_records", "null_count", "min_length", "max_length", "empty_string_count"]
    assert bag(merged, same) == bag(profile, same)
    # A call without new files changes nothing.
    before = bag(found.written)
    again = scrub.clean_incrementally(spark, settings | {"S3_TARGET_PATH": str(tmp_path / "steps")}, schema, str(tmp_path / "cp"), state_partitions=3)
    assert bag(again.written) == before and again.metrics.first() == found.metrics.first()


def test_files_that_would_widen_a_type_stop_the_call(spark, tmp_path):
    source = tmp_path / "in"
    settings = {"S3_SOURCE_PATH": str(source), "S3_TARGET_PATH": str(tmp_path / "out"), "INPUT_FORMAT": "json"}
    ingest = lambda: scrub.clean_incrementally(spark, settings, "a string, b string", str(tmp_path / "cp"))
    put = lambda name, rows: spark.createDataFrame(rows, "a string, b string").write.json(f"{source}/{name}")
    source.mkdir()
    assert ingest().clean is None
    put("one", [(str(i + 5), None) for i in range(50)])
    first = ingest()
    assert first.inferred == {"a": "long"} and first.clean.schema["a"].dataType.simpleString() == "bigint"
    # Values of the type, and a column that had none when it was written first.
    put("two", [("7", str(i + 3)) for i in range(9)])
    second = ingest()
    assert second.inferred == {"a": "long"} and second.clean.where("b = '3'").count() == 1
    before = bag(second.written)
    put("three", [("x1", None) for i in range(200)])
    with pytest.raises(scrub.TypesChanged, match="a"):
        ingest()
    assert bag(spark.read.parquet(str(tmp_path / "out"))) == before


def test_a_batch_that_is_cut_short_is_written_again(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    rows = [(str(i % 7), "v") for i in range(30)]
    settings = {"S3_SOURCE_PATH": str(source), "S3_TARGET_PATH": str(target), "INPUT_FORMAT": "json", "TYPE_CONVERSION_MAP": '{"a": "string", "b": "string"}'}
    spark.createDataFrame(rows, "a string, b string").write.json(f"{source}/one")
    from scrub.streaming import whole

    for step in ("write_table", "_put"):
        with pytest.MonkeyPatch.context() as patch:
            done, real = [], getattr(whole, step)

            def broken(*args, **options):
                real(*args, **options)
                done.append(1)
                if len(done) == (1 if step == "write_table" else 3):
                    raise RuntimeError("cut short")

            patch.setattr(whole, step, broken)
            with pytest.raises(Exception, match="cut short"):
                scrub.clean_incrementally(spark, settings, "a string, b string", str(tmp_path / step))
        found = scrub.clean_incrementally(spark, settings | {"S3_TARGET_PATH": str(target)}, "a string, b string", str(tmp_path / step))
        assert bag(found.clean, ["a", "b"]) == [repr((str(i), "v")) for i in range(7)]
        assert found.metrics.first().duplicate_records == 23


def test_settings_that_need_all_files_first(spark, tmp_path):
    settings = {"S3_SOURCE_PATH": str(tmp_path), "S3_TARGET_PATH": str(tmp_path / "out")}
    with pytest.raises(ValueError, match="overflow"):
        scrub.clean_incrementally(spark, settings | {"HANDLE_NUMERIC_OVERFLOW": "string"}, "a string", str(tmp_path / "cp"))
    with pytest.raises(ValueError, match="target"):
        scrub.clean_incrementally(spark, {"S3_SOURCE_PATH": str(tmp_path)}, "a string", str(tmp_path / "cp"))
