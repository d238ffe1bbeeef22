"""From raw timestamped rows to series in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clean_double
from ..operators.layout import ROWS_PER_CHUNK, index_series, tag_chunk
from ..session import materialize
from .files import malformed_report


def to_long(df: DataFrame, columns: list[str], time_col: str = "date") -> DataFrame:
    """Wide frame (one column per series) to ``(k, t, v)``."""
    wide = df.select(F.col(time_col).alias("t"), *[clean_double(F.col(c)).alias(c) for c in columns])
    return wide.unpivot(["t"], columns, "k", "v").select("k", "t", "v")


NO_KEY = "(none)"
TIES = {"sum": F.sum, "mean": F.avg}


def _named(obs: DataFrame) -> DataFrame:
    """Rows with a time; those without a key form a series of their own, if keys are text."""
    k = F.coalesce("k", F.lit(NO_KEY)) if obs.schema["k"].dataType.typeName() == "string" else F.col("k")
    return obs.filter(F.col("t").isNotNull()).select(k.alias("k"), "t", "v")


def panel_report(obs: DataFrame, rescued: DataFrame | None = None) -> DataFrame:
    """One row: rows read, rows without a time (which panels leave out), without a key, and beyond the first of their time.

    With the rows of ``read_csv_rescued`` that ``obs`` comes from, also their bad lines and bad cells.
    """
    repeated = obs.filter(F.col("t").isNotNull()).groupBy("k", "t").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n_repeated"))
    counts = obs.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("t").isNull()).alias("n_without_time"), F.count_if(F.col("k").isNull()).alias("n_without_key"))
    parts = [repeated]
    if rescued is not None:
        parts.append(malformed_report(rescued).agg(F.max("n_bad_lines").alias("n_bad_lines"), F.sum("n_bad_cells").alias("n_bad_cells")))
    out = counts.withColumn("one", F.lit(1))
    for part in parts:  # one row each
        out = out.join(part.withColumn("one", F.lit(1)), "one")
    return out.drop("one")


def irregular_panel(obs: DataFrame, rows: int = ROWS_PER_CHUNK, ties: str = "keep") -> DataFrame:
    """Number the observed rows of each series in time.

    ``ties`` says what becomes of rows of one time: ``keep`` (all stay, ordered by value), ``sum`` or
    ``mean``.  Rows without a time are left out (see ``panel_report``).  The rows are stored first,
    since numbering reads them several times.
    """
    named = _named(obs)
    if ties != "keep":
        named = named.groupBy("k", "t").agg(TIES[ties]("v").alias("v"))
    return index_series(materialize(named, "observations"), rows)


def regular_panel(obs: DataFrame, step: str, rows: int = ROWS_PER_CHUNK, ties: str = "sum") -> DataFrame:
    """Observations per ``(k, t)`` on a full grid from first to last time; gaps are NULL.

    Rows of one time are combined by ``ties`` (``sum`` or ``mean``).  A time off the grid of its series
    stops the run: round or truncate times first.  The grid is unfolded chunk by chunk, and grid rows
    and observations meet in one aggregation that combines on the map side, so no join is needed.
    """
    obs = _named(obs)
    one = F.expr(f"interval {step}")
    many = F.expr(f"{rows} * interval {step}")
    ends = obs.groupBy("k").agg(F.min("t").alias("a"), F.max("t").alias("z"))
    starts = ends.select("k", "z", F.posexplode(F.sequence("a", "z", many)).alias("chunk", "c0"))
    last = F.least(F.col("z"), F.col("c0") + many - one)
    grid = starts.repartition("k", "chunk").select(
        "k", "chunk", F.posexplode(F.sequence(F.col("c0"), last, one)).alias("p", "t")
    )
    both = obs.select("k", "t", "v", F.lit(None).cast("long").alias("i")).unionByName(
        grid.select("k", "t", F.lit(None).cast("double").alias("v"), (F.col("chunk").cast("long") * rows + F.col("p")).alias("i"))
    )
    dense = both.groupBy("k", "t").agg(TIES[ties]("v").alias("v"), F.max("i").alias("i"))
    off = F.raise_error(F.concat(F.lit("off the grid: series "), F.col("k").cast("string"), F.lit(" at "), F.col("t").cast("string")))
    dense = dense.withColumn("i", F.when(F.col("i").isNull(), off.cast("long")).otherwise(F.col("i")))
    return dense.select("k", "t", "v", "i", tag_chunk(F.floor(F.col("i") / rows), rows))
