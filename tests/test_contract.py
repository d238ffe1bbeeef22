import re

import pytest

import __spark_entry__ as entry
from seriesloom.session import materialize, shared_dir
from seriesloom.sources import files, sinks
from seriesloom.sources.panel import panel_report


def test_names_and_registration():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = {q for q in set(entry.queries()) - set(entry.oracle_sql()) if not re.match(r"op\d+_|pipeline$", q)}
    assert without == {"ses_optimised", "holt_optimised", "evaluate_estimated", "holt_winters_additive_fit", "holt_winters_multiplicative_fit", "model_runs"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["k", "n", "mean"] and df.count() == 5


def test_csv_contract(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text("Date,PJME_MW,Other\n2020-01-01 00:00:00,1.5,1\nbad,2.5,2\n2020-01-01 01:00:00,,3\n")
    df = files.read_csv(spark, str(good))
    assert df.columns == ["date", "pjme_mw", "other"] and files.target_columns(df) == ["pjme_mw"]
    long = files.series_from_wide(df).orderBy("t").collect()
    assert [(r.k, r.v) for r in long] == [("pjme_mw", 1.5), ("pjme_mw", None)]
    assert files.target_columns(df.drop("pjme_mw")) == ["other"]
    bad = tmp_path / "bad.csv"
    bad.write_text("When,x\n1,2\n")
    with pytest.raises(ValueError, match="date"):
        files.read_csv(spark, str(bad))


def test_malformed_rows_are_kept_aside(spark, tmp_path):
    path = tmp_path / "dirty.csv"
    path.write_text("Date,X,Y\n2020-01-01 00:00:00,1.5,7\n2020-01-01 01:00:00,n/a,8\nsomeday,x,9.5\n2020-01-01 02:00:00,,\n2020-01-01 03:00:00,4\n2020-01-01 04:00:00,5,6,7\n")
    df = files.read_csv_rescued(spark, str(path), "Date timestamp_ntz, X double, Y int")
    good, aside = files.set_aside(df)
    assert good.dtypes == [("date", "timestamp_ntz"), ("x", "double"), ("y", "int")]
    assert [(r.x, r.y) for r in good.collect()] == [(1.5, 7), (None, 8), (None, None), (None, None)]
    assert sorted((sorted(r.bad_cells.items()), r.bad_line) for r in aside.collect() if r.bad_line is None) == [
        ([("date", "someday"), ("x", "x"), ("y", "9.5")], None), ([("x", "n/a")], None)]
    assert sorted(r.bad_line for r in aside.collect() if r.bad_line) == ["2020-01-01 03:00:00,4", "2020-01-01 04:00:00,5,6,7"]
    assert {(r.column, r.n_bad_cells) for r in files.malformed_report(df).collect()} == {("date", 1), ("x", 2), ("y", 1)}
    report = panel_report(files.series_from_wide(good), df).first()
    assert (report.n_rows, report.n_bad_lines, report.n_bad_cells) == (6, 2, 4)
    empty = tmp_path / "empty.csv"
    empty.write_text("Date,X\n")
    none = files.read_csv_rescued(spark, str(empty), "Date string, X double")
    assert [(r.n_rows, r.n_bad_lines, r.n_bad_cells) for r in files.malformed_report(none).collect()] == [(0, 0, 0)] * 2
    with pytest.raises(ValueError, match="bad_line"):
        files.read_csv_rescued(spark, str(empty), "Date string, Bad_Line string")


def test_nan_becomes_null(spark):
    wide = spark.sql("select '2020-01-01 00:00:00' date, double('NaN') x union all select '2020-01-02 00:00:00', 1d")
    assert sorted(r.v is None for r in files.series_from_wide(wide).collect()) == [False, True]


def test_event_table_appends(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = spark.sql("select 'a' k, 'm' model, 'ok' status, 1d mse union all select 'b', 'm', 'error: short', null")
    sinks.append_events(sinks.header_event(spark, "r1", {"x": "1"}), path)
    sinks.append_events(sinks.completion_events(rows, "r1"), path)
    got = sorted((r.event, r.payload) for r in sinks.read_events(spark, path).collect())
    assert [e for e, _ in got] == ["model_completion", "model_error", "process_header"]
    assert got[1][1] == '{"k":"b","model":"m","status":"error: short"}'
    with pytest.raises(ValueError):
        sinks.events(rows, "other", "r1")


def test_events_of_a_repeated_run_are_written_once(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = spark.sql("select 'a' k, 'm' model, 'ok' status, 1d mse union all select 'b', 'm', 'error: short', null union all select null, 'm', 'ok', 2d")
    again = rows.withColumn("mse", rows["mse"] + 1)  # other figures, the same events
    for found, run in ((rows, "r1"), (again, "r1"), (rows, "r2"), (rows.withColumn("model", rows["k"]), "r2")):
        for events in (sinks.header_event(spark, run, {"x": "1"}), sinks.completion_events(found, run), sinks.exported_event(spark, run, "/out", "m")):
            sinks.append_events(events, path)
    sinks.append_events(sinks.completion_events(rows, "r3").unionByName(sinks.completion_events(rows, "r3")), path)
    got = [(r.run_id, r.event) for r in sinks.read_events(spark, path).collect()]
    count = lambda run: {e: got.count((run, e)) for e in sinks.EVENTS}
    assert count("r1") == {"process_header": 1, "model_completion": 2, "model_error": 1, "exported_files": 1}
    assert count("r2") == {"process_header": 1, "model_completion": 4, "model_error": 2, "exported_files": 1}
    assert count("r3") == {"process_header": 0, "model_completion": 2, "model_error": 1, "exported_files": 0}
    assert [r.payload for r in sinks.read_events(spark, path).filter("run_id = 'r1' and payload like '%\"k\":\"a\"%'").collect()] == ['{"k":"a","model":"m","status":"ok","mse":1.0}']


def test_forecast_files(spark, tmp_path):
    f = spark.sql("select 'a' k, 'sma' model, 1 step, timestamp_ntz'2020-01-01' t, 1d forecast, 0d lower_95, 2d upper_95, 'ok' status")
    sinks.write_forecasts(f, str(tmp_path / "out"), "r1")
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert set(back.columns) == {"series_id", "step", "date", "forecast", "lower_95", "upper_95", "run_id", "model"}
    assert back.first().model == "sma"


def test_materialize_goes_to_the_shared_folder(spark):
    df = materialize(spark.range(3), "numbers")
    assert df.count() == 3 and shared_dir(spark) in df.inputFiles()[0]
    assert shared_dir(spark).rstrip("/") == spark.conf.get("spark.checkpoint.dir").rstrip("/")
