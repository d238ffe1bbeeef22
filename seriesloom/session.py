"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def build_session(app: str = "seriesloom", master: str | None = None, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", "64m")  # rows may hold whole chunks
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.conf.get("spark.app.id")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="seriesloom-")
    return _local_dirs[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives later steps a columnar source
    with known size, so that column pruning and size-based join choices work on it.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.setdefault(df.sparkSession.conf.get("spark.app.id"), []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark(spark: SparkSession) -> int:
    """A point in the list of intermediate tables, for ``release``."""
    return len(_written.get(spark.conf.get("spark.app.id"), []))


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete the intermediate tables written after ``mark``, once nothing that reads them is needed; returns how many."""
    paths = _written.get(spark.conf.get("spark.app.id"), [])
    jvm, own = spark._jvm, paths[since:]
    for path in own:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    del paths[since:]
    return len(own)
