import pytest

from strataflow.operators.sinks import SinkFailure, run_sinks


@pytest.fixture(scope="module")
def tables(spark):
    rejected = spark.sql("SELECT 1 id, array('valid_a_notNull', 'valid_b_positive') codes")
    return {"clean": spark.range(3), "rejected": rejected}


def run(spark, tables, *sinks, **more):
    return run_sinks(spark, sinks, tables.__getitem__, **more)


def test_modes_and_default_append(spark, tables, folder):
    sink = {"input": "clean", "path": f"{folder}/a", "format": "parquet"}
    for _ in range(2):
        report = run(spark, tables, sink)
    assert [tuple(r) for r in report.select("rows", "status").collect()] == [(3, "ok")]
    assert spark.read.parquet(f"{folder}/a").count() == 6
    run(spark, tables, {**sink, "saveMode": "OVERWRITE"})
    assert spark.read.parquet(f"{folder}/a").count() == 3
    run(spark, tables, {**sink, "saveMode": "ignore"})
    assert spark.read.parquet(f"{folder}/a").count() == 3


def test_json_keeps_arrays(spark, tables, folder):
    run(spark, tables, {"input": "rejected", "paths": f"{folder}/j", "format": "JSON"})
    assert spark.read.json(f"{folder}/j").first().codes == ["valid_a_notNull", "valid_b_positive"]


def test_delta_falls_back_to_parquet(spark, tables, folder):
    run(spark, tables, {"input": "clean", "path": f"{folder}/d", "format": "DELTA"})
    assert spark.read.parquet(f"{folder}/d").count() == 3


def test_failures_are_isolated_and_raised_once(spark, tables, folder):
    sinks = [
        {"input": "absent", "path": f"{folder}/x", "format": "JSON"},
        {"input": "clean", "format": "JSON"},
        {"input": "clean", "path": f"{folder}/y", "format": "no-such-format"},
        {"input": "clean", "path": f"{folder}/z", "format": "JSON"},
    ]
    with pytest.raises(SinkFailure, match="3 sink") as caught:
        run(spark, tables, *sinks)
    report = caught.value.report.collect()
    assert [r.status for r in report] == ["failed", "failed", "failed", "ok"]
    assert "no path" in report[1].error
    assert spark.read.json(f"{folder}/z").count() == 3
