"""Settings, the composed plan and the run with its outputs."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

import scrub
from catalog.fixtures import table
from catalog.queries import CLEAN_ORDERS, STRICT_ORDERS
from scrub import Action, CleaningConfig, Rule, Severity
from scrub.functions.columns import AUDIT_COLUMNS
from scrub.plans.config import KEYS

SF_DIR = "/root/testdata/sf0.001"


# --- settings ------------------------------------------------------------------------------------


def test_all_keys_have_a_setting():
    assert len(KEYS) == 46
    assert set(KEYS.values()) <= set(CleaningConfig.__dataclass_fields__)


def test_settings_from_text():
    config = CleaningConfig.from_dict({
        "--S3_SOURCE_PATH": "/in", "S3_TARGET_PATH": "/out/", "INPUT_FORMAT": "JSON",
        "CRITICAL_NULL_COLUMNS": " a, b ,,", "DATE_FORMATS_TO_TRY": "yyyy-MM-dd,MM/dd/yyyy",
        "TIMESTAMP_FORMATS_TO_TRY": "", "TRIM_STRINGS": "false", "NUMERIC_SCALE": "4",
        "OUTLIER_THRESHOLD": "2.5", "ENABLE_OUTLIER_DETECTION": "TRUE", "TYPE_CONVERSION_MAP": "",
        "SCHEMA_VALIDATION_CONFIG": '{"required_columns": ["a"], "min_columns": 1}',
        "CUSTOM_VALIDATION_RULES_JSON": json.dumps([
            {"column": "a", "rule": "a < 0"},
            {"column": "b", "rule_name": "zero", "expression": "b IS NULL", "action": "set_default",
             "severity": "high", "default": 0, "enabled": False, "error_message": "no b"},
        ]),
        "CUSTOM_DERIVED_COLUMNS_JSON":
            '[{"name": "c", "expression": "a + b", "type": "int", "dependencies": ["a"]}]',
    })
    assert (config.source, config.input_format, config.scale) == ("/in", "json", 4)
    assert config.critical_columns == ("a", "b")
    assert config.date_formats == ("yyyy-MM-dd", "MM/dd/yyyy")
    assert config.timestamp_formats == CleaningConfig().timestamp_formats
    assert (config.trim, config.outliers, config.outlier_threshold) == (False, True, 2.5)
    assert config.schema.required_columns == ["a"]
    assert config.rules == (
        Rule("a", "a < 0"),
        Rule("b", "b IS NULL", Action.SET_DEFAULT, "zero", Severity.HIGH, 0, "no b", False),
    )
    assert config.derived[0].data_type == "int"
    assert config.quarantine_target == "/out_quarantine"
    assert config.metrics_target == "/out_metrics"


@pytest.mark.parametrize("settings", [
    {"TYPE_CONVERSION_MAP": "{not json"},
    {"CUSTOM_VALIDATION_RULES_JSON": '{"column": "a"}'},
    {"CUSTOM_VALIDATION_RULES_JSON": '[{"column": "a"}]'},
    {"CUSTOM_VALIDATION_RULES_JSON": '[{"column": "a", "rule": "x", "action": "explode"}]'},
    {"STANDARDIZE_STRING_CASE": "camel"},
    {"OUTLIER_METHOD": "forest"},
    {"HANDLE_NUMERIC_OVERFLOW": "wrap"},
])
def test_bad_settings_are_errors(settings):
    with pytest.raises(ValueError):
        CleaningConfig.from_dict(settings)


def test_unknown_keys_warn():
    with pytest.warns(UserWarning, match="TYPO"):
        CleaningConfig.from_dict({"TYPO": "1"})


# --- plans ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def orders(spark):
    return table(spark, SF_DIR, "dirty_orders").cache()


def test_every_row_is_accounted_for(orders):
    result = scrub.plan(orders, STRICT_ORDERS)
    m = result.metrics.first()
    assert m.input_records == orders.count()
    assert m.output_records == result.clean.count()
    assert m.quarantined_records == result.quarantine.count() > 0
    lost = m.null_records + m.validation_failures + m.quarantined_records + m.duplicate_records
    assert m.input_records == m.output_records + lost
    counted = {r.rule_name: r.affected_records for r in result.rule_counts.collect()}
    assert counted["no_amount"] + counted["old"] == m.quarantined_records
    assert counted["small"] == m.validation_failures


def test_quarantine_alone_loses_nothing(orders):
    rules = [Rule("amount", "amount = 'abc'", Action.QUARANTINE, "words"),
             Rule("customer_id", "customer_id > 50", Action.QUARANTINE, "late")]
    result = scrub.apply_rules(orders, rules)
    both = result.clean.unionByName(result.quarantined.select(orders.columns))
    assert both.exceptAll(orders).count() == 0 and both.count() == orders.count()


def test_scores_stay_in_bounds(spark, orders):
    harsh = CleaningConfig(rules=(Rule("order_id", "order_id > 5", Action.DROP_ROW),))
    empty = CleaningConfig(rules=(Rule("order_id", "true"),))
    for config in (harsh, empty):
        m = scrub.plan(orders, config).metrics.first()
        for name in ("completeness_score", "consistency_score", "validity_score",
                     "overall_quality_score"):
            assert 0 <= m[name] <= 100


def test_consistency_is_measured_when_a_derived_column_hides_the_difference(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    derived = scrub.DerivedColumn("a", "0")
    m = scrub.plan(df, CleaningConfig(derived=(derived,))).metrics.first()
    assert m.consistency_score == pytest.approx(100 / 3)


def test_plan_without_quarantine_and_with_outliers(orders):
    config = CleaningConfig(
        quarantine=False, outliers=True, outlier_method="zscore", infer=False,
        rules=(Rule("amount", "amount = 'abc'", Action.QUARANTINE),),
    )
    result = scrub.plan(orders, config)
    assert result.quarantine.count() == 0
    assert "order_id_outlier_zscore" in result.clean.columns
    assert result.clean.count() == orders.distinct().count()


def test_schema_contract(orders):
    config = CleaningConfig(
        schema_validation=True,
        schema=scrub.SchemaSpec(["order_id"], column_types={"amount": "double"}),
    )
    assert [i.column for i in scrub.plan(orders, config).schema_warnings] == ["amount"]
    with pytest.raises(scrub.SchemaError):
        scrub.plan(orders, CleaningConfig(
            schema_validation=True, schema=scrub.SchemaSpec(["nope"])))


# --- runs ----------------------------------------------------------------------------------------


def without_audit(df):
    return df.drop(*AUDIT_COLUMNS, "quarantine_timestamp")


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_run_writes_what_the_plan_says(spark, orders, tmp_path, fmt):
    target = str(tmp_path / "orders")
    config = {**vars(STRICT_ORDERS), "target": target, "output_format": fmt, "profiling": "true",
              "job_run_id": "run-1", "job_name": "nightly"}
    result = scrub.run(spark, config, orders)
    planned = scrub.plan(orders, STRICT_ORDERS)
    schema = result.clean.schema
    options = {"schema": schema}
    if fmt == "csv":
        options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    written = scrub.read_table(spark, target, fmt, **options)
    assert written.count() == planned.clean.count()
    assert without_audit(written).exceptAll(without_audit(planned.clean)).count() == 0
    moved = spark.read.parquet(target + "_quarantine")
    assert without_audit(moved).exceptAll(without_audit(planned.quarantine)).count() == 0
    assert moved.count() == planned.quarantine.count()
    record = json.loads(spark.read.text(target + "_metrics").first()[0])
    assert record["job_name"] == "nightly" and record["target_path"] == target
    assert record["column_metrics"]["amount"]["null_count"] > 0
    assert "mean" not in record["column_metrics"]["amount"]
    score = written.select("etl_quality_score").distinct().collect()
    assert [r[0] for r in score] == [pytest.approx(record["overall_quality_score"])]
    assert written.select("etl_job_id").distinct().first()[0] == "run-1"


def test_a_run_counts_while_it_writes(spark, orders, tmp_path):
    """Counters, rule counts and conversions are those of the plan, and no job reads the source for them."""
    target = str(tmp_path / "orders")
    contract = {"required_columns": ["order_id"], "column_types": {"order_id": "string"}}
    config = {**vars(STRICT_ORDERS), "target": target, "profiling": True, "schema_validation": True}
    config["SCHEMA_VALIDATION_CONFIG"] = json.dumps(contract)
    del config["schema"]
    with pytest.warns(UserWarning, match="of the values of order_date convert to date"):
        result = scrub.run(spark, config, orders)
    planned = scrub.plan(orders, STRICT_ORDERS)
    for mine, lazy in ((result.rule_counts, planned.rule_counts), (result.conversions, planned.conversions)):
        assert mine.collect() == lazy.collect() and mine.columns == lazy.columns
        assert "FileScan" not in mine._jdf.queryExecution().toString()
        assert "FileScan" in lazy._jdf.queryExecution().toString()
    counters = ["total_records", "null_records", "quarantined_records", "validation_failures", "completeness_score", "overall_quality_score"]
    assert result.metrics.select(counters).first() == planned.metrics.select(counters).first()
    record = json.loads(spark.read.text(target + "_metrics").first()[0])
    assert [r["rule_name"] for r in record["rule_counts"]] == [r.rule_name for r in STRICT_ORDERS.rules]
    assert [r["affected_records"] for r in record["rule_counts"]] == [r.affected_records for r in planned.rule_counts.collect()]
    assert {c["column_name"]: c["low_success"] for c in record["conversions"]}["order_date"]
    assert record["schema_warnings"] == [{"column_name": "order_id", "check": "type", "expected": "string", "actual": "bigint"}]


def test_run_from_files_with_sampling_and_partitions(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(1000).select(F.col("id").cast("string")).write.csv(source, header=True)
    result = scrub.run(spark, {
        "source": source, "target": target, "ENABLE_SAMPLING": "true",
        "MAX_RECORDS_PER_PARTITION": "300", "ENABLE_DATA_PROFILING": "false",
        "csv_multiline": "false", "cache": "true",
    })
    assert result.profile is None
    written = spark.read.parquet(target)
    assert written.count() == 1000
    assert "etl_quality_score" not in written.columns
    assert not (tmp_path / "out_metrics").exists() and not (tmp_path / "out_quarantine").exists()
    assert written.select("etl_source_path").first()[0] == source


def test_rows_carry_the_path_of_their_own_file(spark, tmp_path):
    """A row in two files is one row, from the first of them; paths are no text to clean, hash or count."""
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.csv").write_text("id,v\n1,x\n2,y\n")
    (source / "B.csv").write_text("id,v\n2,y\n3,-\n4,\n")
    settings = {
        "source": str(source), "target": target, "true_source": "true", "STANDARDIZE_STRING_CASE": "upper", "null_token": "?",
        "approx_distinct": "true", "ENABLE_ADVANCED_ANALYTICS": "true",
        "CUSTOM_VALIDATION_RULES_JSON": '[{"column": "v", "rule": "v = \'-\'", "action": "quarantine"}]',
    }
    result = scrub.run(spark, settings)
    found = {r.id: r.etl_source_path.rsplit("/", 1)[1] for r in spark.read.parquet(target).collect()}
    assert found == {1: "a.csv", 2: "B.csv", 4: "B.csv"}
    assert spark.read.parquet(target + "_quarantine").first().etl_source_path.endswith("/B.csv")
    plain = scrub.run(spark, settings | {"target": target + "2", "true_source": "false"})
    columns = ["id", "v", "etl_row_hash"]
    assert result.clean.select(columns).exceptAll(plain.clean.select(columns)).count() == 0
    assert result.metrics.first().completeness_score == plain.metrics.first().completeness_score
    assert result.clean.where("id = 4").first().etl_row_hash == hashlib.md5(b"4|?").hexdigest()
    scores = {r.stage: r for r in result.before_after.collect()}
    assert (scores["before"].total_records, scores["after"].total_records) == (5, 3)
    assert (scores["before"].validity_score, scores["after"].validity_score) == (80.0, 100.0)
    record = json.loads(spark.read.text(target + "_metrics").first()[0])
    assert [r["stage"] for r in record["before_after"]] == ["before", "after"]


def test_unknown_conditions_may_pass(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", -1)], "k string, v int")
    rule = [Rule("v", "v < 0", Action.DROP_ROW, "negative")]
    for unknown, kept in (("drop", ["a"]), ("pass", ["a", "b"])):
        planned = scrub.plan(df, CleaningConfig(rules=tuple(rule), unknown=unknown, infer=False, profiling=False))
        assert sorted(r.k for r in planned.clean.collect()) == kept
    with pytest.raises(ValueError, match="unknown"):
        CleaningConfig(unknown="keep")


def test_run_of_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "a string, b double")
    m = scrub.run(spark, {"target": str(tmp_path / "t"), "outliers": True}, df).metrics.first()
    assert (m.total_records, m.completeness_score, m.validity_score) == (0, 100.0, 100.0)


def test_cleaned_table_can_be_cleaned_again(spark, orders, tmp_path):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    scrub.run(spark, {**vars(CLEAN_ORDERS), "target": first}, orders)
    again = CleaningConfig(source=first, target=second, input_format="parquet", infer=False)
    scrub.run(spark, again)
    data = without_audit(spark.read.parquet(first))
    assert without_audit(spark.read.parquet(second)).exceptAll(data).count() == 0


def test_run_needs_a_source_and_a_target(spark):
    with pytest.raises(ValueError):
        scrub.run(spark, {"target": "/tmp/x"})
    with pytest.raises(ValueError):
        scrub.run(spark, {"source": "/tmp/x"})
