import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from seriesloom.operators.layout import with_chunk  # noqa: E402
from seriesloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {}
    if "SPARK_CHECKPOINT_DIR" not in os.environ:
        conf["spark__checkpoint__dir"] = str(tmp_path_factory.mktemp("shared"))
    s = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                      spark__driver__memory="4g", **conf)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def series(spark):
    """``series({'a': [1, None, 3]}, rows=2)``: hourly series as an indexed frame."""

    def make(values: dict, rows: int = 1000, hours: dict | None = None):
        data = []
        for k, vs in values.items():
            at = (hours or {}).get(k, range(len(vs)))
            data += [(k, dt.datetime(2018, 8, 2) + dt.timedelta(hours=int(h)), None if v is None else float(v), i)
                     for i, (h, v) in enumerate(zip(at, vs))]
        raw = spark.createDataFrame(data, "k string, t timestamp_ntz, v double, i long")
        return with_chunk(raw.select("k", "t", "v", "i", F.lit(0).alias("chunk")), rows)

    return make


@pytest.fixture(scope="session")
def column():
    """Values of one column of one series in row order, NULL as None."""

    def get(df, name, k="a", order="i"):
        return [None if r[0] is None or r[0] != r[0] else r[0] for r in df.filter(F.col("k") == k).orderBy(order).select(name).collect()]

    return get
