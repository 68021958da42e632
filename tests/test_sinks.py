import tempfile

import pytest

from panelcast.sources.sinks import append, replace_partition, write_outputs


def test_append_replace_and_outputs(spark):
    d = tempfile.mkdtemp(prefix="pc-sink-")
    target = f"{d}/metric"
    a = spark.createDataFrame([("s1", 1, 1.0), ("s2", 1, 2.0)], "data_source string, week int, v double")
    assert append(a, target, ["data_source"])
    assert not append(a.limit(0), target, ["data_source"])
    new = spark.createDataFrame([("s1", 2, 9.0)], "data_source string, week int, v double")
    replace_partition(spark, new, target, {"data_source": "s1"}, ["data_source"])
    got = sorted((r.data_source, r.week, r.v) for r in spark.read.parquet(target).collect())
    assert got == [("s1", 2, 9.0), ("s2", 1, 2.0)]
    replace_partition(spark, new.limit(0), target, {"data_source": "s1"}, ["data_source"])
    assert sorted(r.data_source for r in spark.read.parquet(target).collect()) == ["s2"]
    paths = write_outputs({"leaderboard": a}, f"{d}/out", fmt="csv")
    assert spark.read.option("header", True).csv(paths["leaderboard"]).count() == 2


def test_replace_keeps_all_other_rows(spark):
    d = tempfile.mkdtemp(prefix="pc-sink-")
    target, parts = f"{d}/metric", ["data_source", "task"]
    old = spark.createDataFrame(
        [("s1", "t1", 1.0), ("s1", "t2", 2.0), ("s2", "t1", 3.0), (None, "t1", 4.0), ("s 3/x", "t1", 5.0)],
        "data_source string, task string, v double")
    append(old, target, parts)
    new = spark.createDataFrame([("s1", "t1", 10.0), ("s2", "t9", 20.0)], old.schema)
    replace_partition(spark, new, target, {"data_source": "s1"}, parts)
    rows = lambda: sorted(((r.data_source, r.task, r.v) for r in spark.read.parquet(target).collect()), key=str)
    assert rows() == sorted([("s1", "t1", 10.0), ("s2", "t1", 3.0), ("s2", "t9", 20.0), (None, "t1", 4.0), ("s 3/x", "t1", 5.0)], key=str)
    replace_partition(spark, new.limit(0), target, {"data_source": "s 3/x", "task": "t1"}, parts)
    replace_partition(spark, new.limit(0), target, {"task": "t9"}, parts)
    assert rows() == sorted([("s1", "t1", 10.0), ("s2", "t1", 3.0), (None, "t1", 4.0)], key=str)


def test_interrupted_replace_leaves_the_old_rows(spark):
    d = tempfile.mkdtemp(prefix="pc-sink-")
    target = f"{d}/metric"
    append(spark.createDataFrame([("s1", 1.0)], "data_source string, v double"), target, ["data_source"])
    broken = spark.range(1).selectExpr("'s1' AS data_source", "CAST(raise_error('lost') AS double) AS v")
    with pytest.raises(Exception, match="lost"):
        replace_partition(spark, broken, target, {"data_source": "s1"}, ["data_source"])
    assert [r.v for r in spark.read.parquet(target).collect()] == [1.0]


def test_conform_to_output_schema(spark):
    from panelcast.sources.sinks import FORECAST_SCHEMA, conform

    df = spark.createDataFrame([("s", "A", "X", 202101, 1, 2.6, "ridge")],
                               "data_source string, disease string, county string, yearweek int, lead_week int, "
                               "forecast_count double, model_name string")
    out = conform(df, FORECAST_SCHEMA)
    assert out.schema == FORECAST_SCHEMA
    r = out.first()
    assert r.forecast_count == 2.6 and r.model_task is None


@pytest.mark.parametrize("after", ["staging", "journal", "first_delete", "deletes", "first_move"])
def test_interrupted_swap_ends_with_all_old_or_all_new_rows(spark, monkeypatch, after):
    from panelcast.sources import sinks as S

    target, parts = tempfile.mkdtemp(prefix="pc-sink-") + "/metric", ["data_source", "task"]
    old = spark.createDataFrame([("s1", "t1", 1.0), ("s1", "t2", 2.0), (None, "t1", 3.0), ("s2", "t1", 4.0)], "data_source string, task string, v double")
    append(old, target, parts)
    new = spark.createDataFrame([("s1", "t1", 10.0), ("s1", "t3", 30.0)], old.schema)
    calls = {"write": 0, "delete": 0, "move": 0}

    def stop(name, at):
        real = getattr(S._Folder, name)

        def run(self, *a):
            calls[name] += 1
            if calls[name] == at:
                raise OSError("lost")
            return real(self, *a)

        monkeypatch.setattr(S._Folder, name, run)

    stop(*{"staging": ("write", 1), "journal": ("delete", 1), "first_delete": ("delete", 2), "deletes": ("move", 1), "first_move": ("move", 2)}[after])
    with pytest.raises(OSError, match="lost"):
        replace_partition(spark, new, target, {"data_source": "s1"}, parts)
    monkeypatch.undo()
    S.recover(spark, target)
    rows = sorted(((r.data_source, r.task, r.v) for r in spark.read.parquet(target).collect()), key=str)
    kept = [(None, "t1", 3.0), ("s2", "t1", 4.0)]
    want = [("s1", "t1", 1.0), ("s1", "t2", 2.0)] if after == "staging" else [("s1", "t1", 10.0), ("s1", "t3", 30.0)]
    assert rows == sorted(kept + want, key=str)
    assert not S._Folder(spark, target).names("_replace") and not S._Folder(spark, target).names("_journal")


def test_replace_rows_without_a_key_value(spark):
    target = tempfile.mkdtemp(prefix="pc-sink-") + "/metric"
    old = spark.createDataFrame([("None", 1.0), (None, 2.0), ("s2", 3.0)], "data_source string, v double")
    append(old, target, ["data_source"])
    replace_partition(spark, spark.createDataFrame([(None, 9.0)], old.schema), target, {"data_source": None}, ["data_source"])
    got = sorted(((r.data_source, r.v) for r in spark.read.parquet(target).collect()), key=str)
    assert got == sorted([("None", 1.0), (None, 9.0), ("s2", 3.0)], key=str)


def test_outputs_go_to_their_tables(spark):
    from panelcast.sources.sinks import METRIC_SCHEMA, append_outputs

    d = tempfile.mkdtemp(prefix="pc-sink-")
    metric = spark.createDataFrame([("s", "overall", 5, 1.5, "x")], "data_source string, metric_level string, n_obs int, MAE float, run_mode string")
    assert append_outputs({"metric": metric}, {"metric": f"{d}/metric"}) == ["metric"]
    assert append_outputs({"metric": metric.limit(0)}, {"metric": f"{d}/metric"}) == []
    got = spark.read.parquet(f"{d}/metric")
    assert got.schema == METRIC_SCHEMA and got.first().n_obs == 5 and got.first().WAPE is None
    with pytest.raises(ValueError, match="no output table"):
        append_outputs({}, {"other": "x/y"})
