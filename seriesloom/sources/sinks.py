"""Forecast files and the event table of a run."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Event names.
EVENTS = ("process_header", "model_completion", "model_error", "exported_files")
EVENT_SCHEMA = "run_id string, ts timestamp, event string, payload string, event_key string"


def write_forecasts(forecasts: DataFrame, path: str, run_id: str, fmt: str = "csv", mode: str = "append") -> None:
    """Forecast rows ``date, forecast, lower_95, upper_95`` in folders per run and model.

    With ``append``, rows of the same run and model are replaced, so a run that is tried again does not double them.
    """
    out = forecasts.select(
        F.lit(run_id).alias("run_id"), "model", F.col("k").alias("series_id"), "step", F.col("t").alias("date"),
        "forecast", "lower_95", "upper_95")
    writer = out.write.partitionBy("run_id", "model")
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic") if mode == "append" else writer.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def events(rows: DataFrame, event: str, run_id: str, payload: list[str] | None = None) -> DataFrame:
    """One event per row of ``rows``, the chosen columns as a JSON payload.

    ``event_key`` is made of the run, the event, and the series and model it is about: what a repeated run has in common with the first.
    """
    if event not in EVENTS:
        raise ValueError(f"unknown event {event!r}; known: {EVENTS}")
    body = F.to_json(F.struct(*(payload or rows.columns)))
    about = F.to_json(F.struct(F.lit(run_id).alias("run_id"), F.lit(event).alias("event"), *[c for c in ("k", "model") if c in rows.columns]))
    return rows.select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("ts"), F.lit(event).alias("event"), body.alias("payload"),
                       F.sha2(about, 256).alias("event_key"))


def completion_events(records: DataFrame, run_id: str) -> DataFrame:
    """``model_completion`` for fitted series and ``model_error`` for the others."""
    ok = F.col("status") == "ok"
    return events(records.filter(ok), "model_completion", run_id).unionByName(
        events(records.filter(~ok), "model_error", run_id, ["k", "model", "status"]))


def append_events(rows: DataFrame, path: str) -> None:
    """Append to the event table, except events that it has already: a run that is tried again leaves one row for each.

    Of equal keys among ``rows`` one is written. Earlier events are not touched.
    """
    new = rows.dropDuplicates(["event_key"])
    try:
        known = rows.sparkSession.read.schema(EVENT_SCHEMA).parquet(path).select("event_key")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        new = new.join(known, "event_key", "left_anti").select(*rows.columns)
    new.write.mode("append").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(path)


def header_event(spark: SparkSession, run_id: str, settings: dict[str, str]) -> DataFrame:
    row = spark.range(1).select(*[F.lit(str(v)).alias(n) for n, v in settings.items()])
    return events(row, "process_header", run_id)


def exported_event(spark: SparkSession, run_id: str, path: str, model: str) -> DataFrame:
    """Record that the forecasts of a model were written."""
    row = spark.range(1).select(F.lit(model).alias("model"), F.lit(path).alias("forecasts"))
    return events(row, "exported_files", run_id)
