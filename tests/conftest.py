import os
import sys

import pytest
from py4j import clientserver

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mattone.session import build_session  # noqa: E402

# Py4J drops what Python has released on a thread that sleeps a second at a time; a warm session writes a step in less.
clientserver.DEFAULT_WORKER_SLEEP_TIME = 0.01

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "tests",
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.shuffle.partitions": "4"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def read(spark):
    """Values of one column expression over a list of texts, in order."""

    def run(fn, values, kind="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").coalesce(1)
        rows = df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()
        return [tuple(r.r) if hasattr(r.r, "asDict") else r.r for r in rows]

    return run
