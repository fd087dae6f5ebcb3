"""Which rows of one layer the next layer still lacks, and lookups between tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, never sent whole through the driver when it is joined.

    Keys and addresses of a layer are packed so well in its files that Spark takes millions of them for a few megabytes, worth
    a broadcast, which unpacks them in the driver.
    """
    return df.hint("merge")


def pending(upstream: DataFrame, downstream: DataFrame, key: str = "id") -> DataFrame:
    """Rows of the upstream layer whose key the downstream layer does not hold.

    Only the key column of the downstream table is read.
    """
    return upstream.join(shuffled(downstream.select(key)), key, "left_anti")


def sample_n(df: DataFrame, n: int, key: str = "id", seed: str = "0") -> DataFrame:
    """n random rows, the same ones whenever the seed is the same.

    Ordering by a digest of seed and key does not depend on how the rows are
    partitioned, so a task that runs again draws the same rows.  Each task keeps
    its own n smallest and nothing is sorted as a whole.
    """
    draw = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    return df.orderBy(draw, F.col(key)).limit(n)


def sample_random(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """n random rows, drawn anew on every run."""
    return df.orderBy(F.rand(seed) if seed is not None else F.rand()).limit(n)


def lookup_count(left: DataFrame, right: DataFrame, left_key: str, right_key: str, out: str = "n_matches") -> DataFrame:
    """Left rows with the number of right rows of their key; 0 when there is none.

    The right side is counted per key before it is shuffled, so a key that holds
    much of the table travels as one row per task.
    """
    counts = right.groupBy(F.col(right_key).alias("_key")).agg(F.count("*").alias(out))
    joined = left.join(counts, left[left_key] == counts["_key"], "left").drop("_key")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(0).cast("bigint")))


def lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left rows with each matching right row as the struct ``match``; once with null when there is none.

    One row per match instead of one array per left row, so no row grows with its
    key's share of the table.  The matching part is an inner join, which Spark may
    split on either side where one key is hot, and the rest only needs the distinct keys.
    """
    named = right.select(F.col(right_key).alias("_key"), F.struct("*").alias("match"))
    found = left.join(named, left[left_key] == named["_key"], "inner").drop("_key")
    keys = right.select(F.col(right_key).alias("_key")).distinct()
    lonely = left.join(keys, left[left_key] == keys["_key"], "left_anti")
    return found.unionByName(lonely.withColumn("match", F.lit(None).cast(named.schema["match"].dataType)))


def first_per_key(df: DataFrame, key: str | list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key by ``order``; equal positions fall to a digest of the row.

    An aggregate, not a window: a key held by a third of all rows is down to one row
    per task before the shuffle.
    """
    keys = [key] if isinstance(key, str) else key
    position = F.struct(*order, row_digest(df))
    rest = [c for c in df.columns if c not in keys]
    firsts = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), position).alias("_first"))
    return firsts.select(*[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns])


def best_per_key(df: DataFrame, key: str | list[str], order: list[Column], k: int, place: str | None = None) -> DataFrame:
    """The k first rows of each key by ``order``, which must settle every tie; ``place`` names a column for the place of each.

    Spark limits the window inside each task before the shuffle and again after it, so a key that holds a third of all rows sends k rows
    per task.  It does so for k up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000); the rows are the same beyond.
    """
    keys = [key] if isinstance(key, str) else key
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    best = df.withColumn(place or "_place", at).where(F.col(place or "_place") <= k)
    return best if place else best.drop("_place")


def row_digest(df: DataFrame) -> Column:
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.xxhash64(*plain)
