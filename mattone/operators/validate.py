"""Row rules of the layers, kept as data and applied as one expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mattone import schemas
from mattone.functions.text import strip


def conform(df: DataFrame, layer: str, derived: frozenset[str] = frozenset()) -> DataFrame:
    """The layer's columns in order and type, strings stripped; missing ones null, unknown ones an error.

    Columns whose names start with an underscore or end in ``_reason`` ride along.
    ``derived`` names columns that a job computed itself and that need no stripping.
    """
    schema = schemas.schema_of(layer)
    known = {f.name: f for f in schema.fields}
    extra = [c for c in df.columns if c not in known]
    unknown = [c for c in extra if not (c.startswith("_") or c.endswith("_reason"))]
    if unknown:
        raise ValueError(f"unknown columns for {layer}: {unknown}")
    present = set(df.columns)

    def shaped(f: T.StructField) -> Column:
        if f.name not in present:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f.name)
        if f.name in derived:
            return c
        if isinstance(f.dataType, T.StringType):
            c = strip(c)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.transform(c, strip)
        return (c if df.schema[f.name].dataType == f.dataType else c.cast(f.dataType)).alias(f.name)

    return df.select(*[shaped(f) for f in schema.fields], *extra)


def rules_of(layer: str, derived: frozenset[str] = frozenset()) -> list[tuple[str, Column]]:
    """(rule name, condition under which a row breaks it) in the order they are reported.

    ``derived`` columns meet their rules by the way they are computed; they are not checked
    again, which would compute them twice.
    """
    rules = [(f"{c}_missing", F.col(c).isNull()) for c in schemas.required_of(layer) if c not in derived]
    doubles = [f.name for f in schemas.schema_of(layer).fields if isinstance(f.dataType, T.DoubleType) and f.name not in derived]
    for c in doubles:
        rules.append((f"{c}_not_finite", F.isnan(c) | F.col(c).isin(float("inf"), float("-inf"))))
    for c in [c for c in schemas.NOT_NEGATIVE[layer] if c not in derived]:
        rules.append((f"{c}_negative", F.col(c) < 0))
    for c in schemas.NOT_EMPTY[layer]:
        rules.append((f"{c}_empty", F.col(c) == ""))
    if "build_year" in schemas.schema_of(layer).names:
        rules.append(("build_year_out_of_range", ~F.col("build_year").between(*schemas.BUILD_YEARS)))
    for c, allowed in [(c, a) for c, a in schemas.ALLOWED[layer].items() if c.split(".")[0] not in derived]:
        rules.append((f"{c.split('.')[-1]}_not_allowed", ~F.col(c).isin(allowed)))
    return rules


def failed_rules(layer: str, derived: frozenset[str] = frozenset()) -> Column:
    """Names of the broken rules joined by commas, null when the row meets all."""
    return F.nullif(F.concat_ws(",", *[F.when(broken, F.lit(name)) for name, broken in rules_of(layer, derived)]), F.lit(""))


def validate(df: DataFrame, layer: str, errors: str = "quarantine") -> DataFrame:
    """The conformed rows with ``failed_rules``; with ``errors="fail"`` the first bad row ends the job."""
    checked = conform(df, layer).withColumn("failed_rules", failed_rules(layer))
    return apply_policy(checked, "failed_rules", errors)


def apply_policy(df: DataFrame, reason: str, errors: str) -> DataFrame:
    if errors == "quarantine":
        return df
    if errors == "fail":
        raised = F.raise_error(F.concat(F.lit("row rejected: "), F.col(reason))).cast("string")
        return df.withColumn(reason, F.when(F.col(reason).isNotNull(), raised))
    raise ValueError(f"errors must be 'quarantine' or 'fail', not {errors!r}")


def split_rejects(df: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    """(good rows without the reason column, rejected rows with it).

    A row is unpacked from an array of itself, or of nothing.  A plain filter on the
    reason would be pushed below the parsing, which Spark would then do twice.
    """

    def rows_where(kept: Column, columns: list[str]) -> DataFrame:
        return df.select(F.inline(F.when(kept, F.array(F.struct(*columns)))))

    return (
        rows_where(F.col(reason).isNull(), [c for c in df.columns if c != reason]),
        rows_where(F.col(reason).isNotNull(), df.columns),
    )


def stage_checked(df: DataFrame, reason: str, path: str) -> tuple[DataFrame, DataFrame]:
    """Write checked rows once and read them back as (good, rejected); both sides only read."""
    df.write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.where(F.col(reason).isNull()).drop(reason), stored.where(F.col(reason).isNotNull())
