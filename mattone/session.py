"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", app: str = "mattone", **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    On a cluster the submitted configuration supplies master, partition count
    and ``spark.checkpoint.dir``; this helper is for tests and the bench.
    """
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        # HotSpot compiles no method above 8000 bytes; larger generated ones would be interpreted.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Recording the Python call site of every column expression costs more than planning them.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.master(master).appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_base: str | None = None


def use_work_base(path: str) -> None:
    """Where work folders lie in sessions without ``spark.checkpoint.dir``, such as those of tests and local runs."""
    global _base
    _base = path


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for a table this application writes between two steps.

    It lies under ``spark.checkpoint.dir``, which every executor of a cluster can
    reach, so a lost executor loses nothing.  Without that setting the caller has to name a folder
    by ``use_work_base``; none is made up on one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _base
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{_application_folder(spark, base)}/{purpose}-{uuid.uuid4().hex}"


def drop_work(spark: SparkSession) -> None:
    """Remove the work folders of this application; tables read from them are gone."""
    base = spark.conf.get("spark.checkpoint.dir", None) or _base
    if base:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark, base))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _application_folder(spark: SparkSession, base: str) -> str:
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"
