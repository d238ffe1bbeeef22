"""CSV and Parquet sources with the column contract of a time-series table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Required time column and default target column of the input contract.
TIME_COLUMN = "date"
TARGET_COLUMN = "pjme_mw"

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail before any job runs if a required column is absent."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"missing column(s) {absent}; found {df.columns}")
    return df


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """CSV with a header.  Give a schema where it is known; inferring one reads the file twice."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return require_columns(lower_names(reader.csv(path)), TIME_COLUMN)


# Columns that ``read_csv_rescued`` adds.
BAD_CELLS, BAD_LINE = "bad_cells", "bad_line"


def read_csv_rescued(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV under a typed schema in which nothing unreadable is lost.

    Cells are read as text and cast one by one, so a bad cell leaves the others of its row alone.
    ``bad_cells`` maps the columns whose text isn't of their type to that text (empty where all are
    fine; an empty cell is a missing value, not a bad one). ``bad_line`` is the whole line of a row
    that has another number of fields than the schema, else NULL. See ``set_aside`` and ``malformed_report``.
    """
    typed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name.lower() for f in typed.fields]
    if taken := {BAD_CELLS, BAD_LINE} & set(names):
        raise ValueError(f"column name(s) {sorted(taken)} are needed for malformed rows")
    text = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(BAD_LINE, T.StringType())])
    # Without column pruning, since the fields of a line are only counted where all are parsed.
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE, "columnPruning": False}
    raw = spark.read.options(**options).schema(text).csv(path)

    def cast(f: T.StructField) -> Column:
        return F.col(f"`{f.name.lower()}`").try_cast(f.dataType)

    bad = [F.when(F.col(f"`{n}`").isNotNull() & (F.trim(f"`{n}`") != "") & cast(f).isNull(), F.struct(F.lit(n).alias("key"), F.col(f"`{n}`").alias("value")))
           for n, f in zip(names, typed.fields)]
    out = raw.select(*[cast(f).alias(n) for n, f in zip(names, typed.fields)], F.map_from_entries(F.array_compact(F.array(*bad))).alias(BAD_CELLS), BAD_LINE)
    return require_columns(out, TIME_COLUMN)


def set_aside(rescued: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to work on and rows kept aside.

    The first are typed rows with the right number of fields (bad cells are NULL there); the second,
    with a bad cell or a bad line, keep all columns. A row with bad cells is in both, one with a bad
    line only among the second, since it isn't known which of its columns its values belong to.
    """
    return rescued.filter(F.col(BAD_LINE).isNull()).drop(BAD_CELLS, BAD_LINE), rescued.filter(F.col(BAD_LINE).isNotNull() | (F.size(BAD_CELLS) > 0))


def malformed_report(rescued: DataFrame) -> DataFrame:
    """One row for each column: rows read, rows with a bad line, cells of this column that aren't of its type.

    Bad cells of bad lines are not counted again. One aggregation reads the table once.
    """
    names = [c for c in rescued.columns if c not in (BAD_CELLS, BAD_LINE)]
    whole = F.col(BAD_LINE).isNull()
    row = rescued.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~whole).alias("n_bad_lines"),
                      *[F.count_if(whole & F.map_contains_key(BAD_CELLS, F.lit(n))).alias(f"b{j}") for j, n in enumerate(names)])
    cells = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"b{j}").alias("n_bad_cells")) for j, n in enumerate(names)])
    return row.select("n_rows", "n_bad_lines", F.inline(cells))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return require_columns(lower_names(spark.read.parquet(path)), TIME_COLUMN)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def target_columns(df: DataFrame, target: str = TARGET_COLUMN) -> list[str]:
    """The default target if present, else every numeric column."""
    return [target] if target in df.columns else numeric_columns(df)


def parse_dates(df: DataFrame, time_col: str = TIME_COLUMN, fmt: str | None = None, out: str = "t") -> DataFrame:
    """Text to timestamp; unreadable text becomes NULL."""
    parsed = F.expr(f"try_cast(`{time_col}` as timestamp_ntz)") if fmt is None else \
        F.try_to_timestamp(F.col(time_col), F.lit(fmt)).cast("timestamp_ntz")
    return df.withColumn(out, parsed)


def series_from_wide(df: DataFrame, target: str | None = None) -> DataFrame:
    """Contract check, date parsing, choice of columns: ``(k, t, v)`` without undated rows."""
    from .panel import to_long

    df = require_columns(lower_names(df), TIME_COLUMN)
    columns = target_columns(df, target.lower() if target else TARGET_COLUMN)
    if not columns:
        raise ValueError("no numeric column found")
    dated = parse_dates(df).filter(F.col("t").isNotNull())
    return to_long(dated, columns, "t")
