"""Versions of a run's outputs: they become visible together or not at all."""

import warnings
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import scrub
from scrub.plans import cleaning

RULE = '[{"column": "v", "rule_name": "neg", "rule": "v < 0", "action": "quarantine"}]'


def settings(target, **more):
    return {"target": str(target), "versions": "true", "infer": "false", "CUSTOM_VALIDATION_RULES_JSON": RULE, **more}


def table(spark, n):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") - 1).alias("v"))


def state(spark, target):
    """What readers see of all three outputs."""
    found = [scrub.read_published(spark, str(target), o) for o in ("clean", "quarantine", "metrics")]
    return None if found[0] is None else (found[0].count(), found[1].count(), found[2].first().input_records)


@pytest.mark.parametrize("step", ["write_quarantine", "write_metrics", "write_table", "publish"])
def test_a_run_that_ends_early_leaves_the_old_version(spark, tmp_path, monkeypatch, step):
    target = tmp_path / "out"
    real = getattr(cleaning, step)

    def cut(*args, **options):
        if step != "publish":
            real(*args, **options)
        raise RuntimeError("cut short")

    for n, expected in ((5, None), (9, (4, 1, 5))):
        with monkeypatch.context() as patch:
            patch.setattr(cleaning, step, cut)
            with pytest.raises(RuntimeError, match="cut short"):
                scrub.run(spark, settings(target), table(spark, n))
        assert state(spark, target) == expected
        scrub.run(spark, settings(target), table(spark, n))
        assert state(spark, target) == (n - 1, 1, n)
    assert len(list((target / "_versions").iterdir())) == 4
    assert scrub.drop_versions(spark, str(target)) == 3
    assert state(spark, target) == (8, 1, 9)
    assert scrub.drop_versions(spark, str(target)) == 0


def test_of_two_runs_at_once_one_fails(spark, tmp_path, monkeypatch):
    target, real = tmp_path / "out", cleaning.publish

    def late(spark_, path, outputs, after):
        with monkeypatch.context() as patch:
            patch.setattr(cleaning, "publish", real)
            scrub.run(spark, settings(target), table(spark, 3))
        return real(spark_, path, outputs, after)

    with monkeypatch.context() as patch:
        patch.setattr(cleaning, "publish", late)
        with pytest.raises(scrub.PublishConflict):
            scrub.run(spark, settings(target), table(spark, 7))
    assert state(spark, target) == (2, 1, 3)
    assert not [p for p in (target / "_manifests").iterdir() if p.name.endswith(".draft")]


def test_formats_and_missing_outputs(spark, tmp_path):
    target = str(tmp_path / "out")
    assert scrub.read_published(spark, target) is None and scrub.drop_versions(spark, target) == 0
    more = {"OUTPUT_FORMAT": "csv", "CSV_DELIMITER": ";", "ENABLE_DATA_PROFILING": "false", "ENABLE_QUARANTINE": "false"}
    scrub.run(spark, settings(target, **more), table(spark, 3))
    assert sorted(r.k for r in scrub.read_published(spark, target).collect()) == ["0", "1", "2"]
    assert scrub.read_published(spark, target, "metrics") is None
    assert scrub.read_published(spark, target, "quarantine") is None


def test_tables_between_the_steps_can_be_dropped(spark, tmp_path):
    with scrub.run(spark, settings(tmp_path / "out", versions="false"), table(spark, 6)) as result:
        folder = Path(result.scratch.folder)
        assert result.metrics.first().output_records == 5 and any(folder.iterdir())
    assert not folder.exists()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        scrub.plan(table(spark, 2), scrub.CleaningConfig()).release()
