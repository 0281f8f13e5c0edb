"""Readers, writers, staging and incremental ingest."""

import pytest
from pyspark.sql import functions as F

import scrub
from catalog import incremental
from scrub.plans import CleaningConfig
from scrub.sources import readers, staging
from scrub.sources.writers import LOSSLESS_CSV


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_csv_options_and_folders(spark, tmp_path):
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    (tmp_path / "one.csv").write_text("x;y\n1;'two\nlines'\n")
    (deep / "two.csv").write_text("x;y\n2;'it\\'s; here'\n")
    df = scrub.read_table(spark, str(tmp_path), "csv", separator=";", quote="'")
    assert df.dtypes == [("x", "string"), ("y", "string")]
    assert rows(df) == [("1", "two\nlines"), ("2", "it's; here")]
    typed = scrub.read_table(
        spark, str(tmp_path), "CSV", separator=";", quote="'", infer_schema=True
    )
    assert typed.dtypes[0] == ("x", "int")


def test_json_with_nested_values(spark, tmp_path):
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "a.json").write_text('{"a": 1, "s": {"t": "x"}, "l": [1, 2]}\n')
    df = scrub.read_table(spark, str(tmp_path), "json")
    assert dict(df.dtypes) == {"a": "bigint", "l": "array<bigint>", "s": "struct<t:string>"}


@pytest.mark.parametrize("action", [
    lambda spark: scrub.read_table(spark, "/nowhere", "orc"),
    lambda spark: scrub.write_table(spark.range(1), "/nowhere", "xml"),
    lambda spark: CleaningConfig(output_format="avro"),
])
def test_unknown_formats(spark, action):
    with pytest.raises(ValueError):
        action(spark)


@pytest.mark.parametrize("codec", ["snappy", "gzip", "zstd", "lz4", "none"])
def test_parquet_codecs(spark, tmp_path, codec):
    path = str(tmp_path / "t")
    scrub.write_table(spark.range(5), path, compression=codec)
    assert scrub.read_table(spark, path, "parquet").count() == 5


def test_csv_keeps_spaces_empty_text_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(" a ", ""), (None, "b\nc"), ("q'q", 'd"d')], "x string, y string")
    for quote in ('"', "'"):
        path = str(tmp_path / f"t{ord(quote)}")
        scrub.write_table(df, path, "csv", quote=quote, **LOSSLESS_CSV)
        back = scrub.read_table(spark, path, "csv", quote=quote, **LOSSLESS_CSV)
        assert rows(back) == rows(df)


def test_failed_write_is_an_error(spark, tmp_path):
    scrub.write_quarantine(spark.range(1), str(tmp_path / "q"))
    with pytest.raises(Exception, match="already exists"):
        scrub.write_quarantine(spark.range(1), str(tmp_path / "q"))


def test_sampling(spark):
    df = spark.range(10_000)
    sampled = readers.sample_rows(df)
    assert 800 < sampled.count() < 1_200
    assert rows(sampled) == rows(readers.sample_rows(df))


@pytest.mark.parametrize("records, expected", [
    (0, 1), (999_999, 1), (1_000_000, 1), (2_999_999, 2), (10**12, 10**6),
])
def test_partition_bounds(records, expected):
    assert readers.partitions_for(records) == expected


def test_repartition(spark):
    df = readers.repartition_by_rows(spark.range(100), 100, rows=30, lo=2, hi=5)
    assert df.rdd.getNumPartitions() == 3


def test_staging_goes_to_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert staging.shared_folder(spark) == folder
    df = spark.createDataFrame([(1, None)], "a int, b decimal(38,10)")
    staged = scrub.materialize(df, "t")
    assert rows(staged) == rows(df) and staged.dtypes == df.dtypes
    assert all(folder in f for f in staged.inputFiles())
    assert staging.scratch_path(spark, "t") != staging.scratch_path(spark, "t")


def test_a_cluster_must_name_its_folder():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())


# --- incremental ---------------------------------------------------------------------------------

SCHEMA = "customer_id string, age string, joined string"
FILES = {
    "a.csv": "customer_id,age,joined\n 1 ,30,2024-01-02\n2,-5,2024-01-03\n",
    "b.csv": "customer_id,age,joined\n3,41,01/31/2024\n,22,2024-01-03\n",
    "c.csv": "customer_id,age,joined\n4,abc,unknown\n5,-1,2024-02-01\n",
}


def test_only_new_files_are_read(spark, tmp_path):
    source, seen = tmp_path / "in", []
    source.mkdir()

    def apply(batch, batch_id):
        seen.append((batch_id, sorted(r.customer_id or "" for r in batch.collect())))

    def ingest():
        scrub.ingest_new(spark, str(source), SCHEMA, str(tmp_path / "cp"), apply)

    for name in ("a.csv", "b.csv"):
        (source / name).write_text(FILES[name])
    ingest()
    ingest()
    (source / "c.csv").write_text(FILES["c.csv"])
    ingest()
    assert seen == [(0, ["", " 1 ", "2", "3"]), (1, ["4", "5"])]


def test_batches_give_the_rows_of_one_run(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    settings = {
        "S3_SOURCE_PATH": str(source),
        "TYPE_CONVERSION_MAP": '{"age": "int", "joined": "date", "customer_id": "long"}',
        "CRITICAL_NULL_COLUMNS": "customer_id",
        "FILL_NULL_NUMBERS_WITH": "0",
        "CUSTOM_VALIDATION_RULES_JSON":
            '[{"column": "age", "rule_name": "neg", "rule": "age < 0", "action": "quarantine"}]',
    }
    for name, text in FILES.items():
        (source / name).write_text(text)
        scrub.clean_new_files(
            spark, settings | {"S3_TARGET_PATH": str(tmp_path / "steps")}, SCHEMA,
            str(tmp_path / "cp"),
        )
    scrub.run(spark, settings | {"S3_TARGET_PATH": str(tmp_path / "whole")})
    for part in ("", "_quarantine"):
        whole = spark.read.parquet(f"{tmp_path}/whole{part}")
        steps = spark.read.parquet(f"{tmp_path}/steps{part}")
        columns = ["customer_id", "age", "joined"]
        assert rows(steps.select(columns)) == rows(whole.select(columns))
    assert steps.select("batch").distinct().count() == 2


def test_a_larger_table_comes_in_more_files_but_not_in_more_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "ROWS_PER_FILE", 100)
    df = spark.range(1234).withColumn("text", F.col("id").cast("string"))
    per_batch = incremental.as_files(df, str(tmp_path / "files"))
    sizes = [r.n for r in spark.read.parquet(str(tmp_path / "files")).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 13 and max(sizes) <= 200 and sum(sizes) == 1234 and per_batch == 5
    batches = incremental.in_batches(df, scrub.type_counts)
    assert batches.select("batch").distinct().count() == incremental.BATCHES
    assert scrub.add_type_counts(batches).first().integer_count == 1234
