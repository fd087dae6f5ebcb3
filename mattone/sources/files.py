"""Layer snapshots as CSV, and the graph results as JSON and CSV."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mattone.functions.numbers import HOME_ZONE
from mattone.operators.validate import conform, failed_rules, split_rejects
from mattone.schemas import schema_of
from mattone.session import work_folder

# Files stay small because one with line breaks inside quotes cannot be split for reading.
ROWS_PER_FILE = 500_000

CSV = {
    "sep": ";",
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
    "timeZone": HOME_ZONE,
}

# An unquoted empty cell reads as this marker and becomes null, a quoted one stays an empty text.
# A file whose header names other columns, or in another order, is an error; a row that does not fit is kept.
CORRUPT = "_corrupt"
READ = {**CSV, "nullValue": "\x00", "emptyValue": "", "enforceSchema": "false", "columnNameOfCorruptRecord": CORRUPT}


def _is_nested(f: T.StructField) -> bool:
    return isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))


def append_csv(df: DataFrame, path: str, layer: str) -> int:
    """Append all rows, duplicates included, and return how many; nothing is written for none."""
    rows = conform(df, layer).select(*schema_of(layer).names)
    staged = work_folder(df.sparkSession, "csv-rows")
    rows.write.parquet(staged)
    rows = df.sparkSession.read.schema(rows.schema).parquet(staged)
    n = rows.count()
    if n == 0:
        return 0

    def cell(f: T.StructField) -> Column:
        return F.to_json(f.name).alias(f.name) if _is_nested(f) else F.col(f.name)

    flat = rows.select(*[cell(f) for f in rows.schema.fields])
    flat.write.mode("append").options(**CSV).option("maxRecordsPerFile", ROWS_PER_FILE).csv(path)
    return n


def read_layer(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """The good rows of a layer's CSV snapshot in their declared types; a missing path has no rows."""
    return read_layer_checked(spark, path, layer)[0]


def read_layer_checked(spark: SparkSession, path: str, layer: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, others with ``failed_rules``): each row is checked as it is loaded.

    A row of too few cells, or with one that is not of its type, fails as ``corrupt_row``; its text is in ``_corrupt``.
    """
    rows = _read_rows(spark, path, layer).withColumn("failed_rules", F.when(F.col(CORRUPT).isNotNull(), "corrupt_row").otherwise(failed_rules(layer)))
    good, bad = split_rejects(rows, "failed_rules")
    return good.drop(CORRUPT), bad


def _read_rows(spark: SparkSession, path: str, layer: str) -> DataFrame:
    schema = schema_of(layer)
    corrupt = T.StructField(CORRUPT, T.StringType())
    flat = T.StructType([*[T.StructField(f.name, T.StringType() if _is_nested(f) else f.dataType) for f in schema.fields], corrupt])
    try:
        rows = spark.read.schema(flat).options(**READ).csv(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([*schema.fields, corrupt]))
    return rows.select(
        *[F.from_json(f.name, f.dataType).alias(f.name) if _is_nested(f) else F.col(f.name) for f in schema.fields], CORRUPT
    )


def write_paths_json(paths: DataFrame, path: str) -> None:
    """Paths as JSON lines ``{nodes: [...], relationships: [...]}``."""
    paths.select("nodes", "relationships").write.mode("overwrite").json(path)


def write_neighbours_csv(found: DataFrame, path: str, one_start: bool = True) -> None:
    """Ranked neighbours with a header; part files follow the ranking. Neighbours of several starts name theirs."""
    named = found.select(*([] if one_start else ["start"]), F.col("text").alias("feedbackText"), "distance", "score")
    named.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
