"""Joins and numberings that hold when one key owns a large share of the rows.

Three decisions are taken here for the whole library, each from a measured size:
what may be broadcast, which keys are hot, and where intermediate tables live.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

# A lookup is broadcast only when it was counted and has at most this many (narrow) rows;
# spark.modelweave.broadcastRows overrides it.
BROADCAST_ROWS = 200_000
# More rows than this under one key are split over several tasks; spark.modelweave.hotRows overrides it.
HOT_ROWS = 2_000_000
# Rows without a key are spread over this many salts once any key is hot.
NULL_KEY_SALTS = 10_000
# Rows are counted by this many hashes of their key before any key is counted.
KEY_HASHES = 1 << 16
BUCKETED = "modelweave_bucketed_"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _broadcast_rows(spark: SparkSession, given: int | None) -> int:
    return int(spark.conf.get("spark.modelweave.broadcastRows", str(BROADCAST_ROWS))) if given is None else given


def _hot_rows(spark: SparkSession, given: int | None) -> int:
    return int(spark.conf.get("spark.modelweave.hotRows", str(HOT_ROWS))) if given is None else given


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate").rstrip("/")


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/modelweave-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A new path below one folder per application, which `remove_folders` removes."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove one intermediate table; only below the folder of this application."""
    if f"/modelweave-{spark.sparkContext.applicationId}/" not in folder:
        raise ValueError(f"{folder} is no intermediate table of this application")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_folders(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; frames that read them are of no use afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, Spark removes an execution's shuffle files as soon as it has ended."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table once to the shared folder and read it back: cuts lineage, survives lost executors.

    The shuffle files behind it are removed with the end of the write.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    with freeing_shuffles(spark):
        df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, label: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, dict[str, object]]:
    """`materialize`, with aggregates over its rows taken by the tasks that write them; no second scan.

    The aggregates are observed in the stage that writes, and Spark takes a task of an action's last stage into
    account once, however often it ran, so they stay exact when executors are lost.
    """
    seen = Observation()
    kept = materialize(df.observe(seen, *[value.alias(name) for name, value in metrics.items()]), label)
    return kept, dict(seen.get)


def bucketed(df: DataFrame, label: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """`materialize` into buckets of ``keys``, each sorted by them: a join on the keys reads them without a shuffle.

    As many buckets as shuffle partitions, or as given for larger tables; every bucket is one file, written by the
    one task that holds it. Spark sorts what it reads of a bucket once more, which costs little on sorted rows. One
    key is one bucket: it is meant for tables whose keys are all but unique. `drop_bucketed` takes the tables out of the session's catalog.
    """
    spark = df.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions")) if buckets is None else buckets
    name = f"{BUCKETED}{label}_{uuid.uuid4().hex}".replace("-", "_")
    with freeing_shuffles(spark):
        (
            df.repartition(count, *keys).write.bucketBy(count, *keys).sortBy(*keys)
            .option("path", new_folder(spark, label)).format("parquet").saveAsTable(name)
        )
    return spark.table(name)


def drop_bucketed(spark: SparkSession) -> None:
    """Take the tables that `bucketed` made out of the catalog; `remove_folders` removes their files."""
    for table in spark.catalog.listTables(pattern=f"{BUCKETED}*"):
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")


def _key_hash(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_HASHES))


def _crowded(df: DataFrame, keys: Sequence[str], hot_rows: int) -> list[int]:
    """Hashes that more than ``hot_rows`` rows have; at most `KEY_HASHES` rows of a task are shuffled."""
    counts = df.groupBy(_key_hash(keys).alias("_hash")).agg(F.count(F.lit(1)).alias("_rows"))
    return [r["_hash"] for r in counts.filter(F.col("_rows") > hot_rows).collect()]


def _hot_among(df: DataFrame, keys: Sequence[str], hot_rows: int, hashes: Sequence[int]) -> DataFrame:
    crowded = F.broadcast(df.sparkSession.createDataFrame([(h,) for h in hashes], "_hash long"))
    likely = df.select(*keys, _key_hash(keys).alias("_hash")).join(crowded, "_hash", "left_semi")
    return likely.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and their counts; only keys whose hash has as many are counted."""
    return _hot_among(df, keys, hot_rows, _crowded(df, keys, hot_rows))


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    broadcast_rows: int | None = None,
    hot_rows: int | None = None,
    lookup_rows: int | None = None,
) -> DataFrame:
    """Join a large side to a lookup on equal columns, keeping the large side in place when possible.

    A counted, small lookup is broadcast (``lookup_rows`` is its count where the caller knows it). Otherwise both sides are shuffled, and each hot key of
    the large side is spread over as many salts as its own row count asks for.
    """
    keys = list(keys)
    broadcast_rows = _broadcast_rows(facts.sparkSession, broadcast_rows)
    hot_rows = _hot_rows(facts.sparkSession, hot_rows)
    if (lookup.count() if lookup_rows is None else lookup_rows) <= broadcast_rows:
        return facts.join(F.broadcast(lookup), keys, how)
    if facts.isStreaming:
        return facts.join(lookup, keys, how)
    crowded = _crowded(facts, keys, hot_rows)
    if not crowded:
        return facts.join(lookup, keys, how)
    hot = materialize(
        _hot_among(facts, keys, hot_rows, crowded).select(
            *keys, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_salts")
        ),
        "hot-keys",
    )
    n_hot = hot.count()
    if n_hot == 0:
        return facts.join(lookup, keys, how)
    salts = F.broadcast(hot) if n_hot <= broadcast_rows else hot
    # By the row's place, so that equal rows are split too; every salt has its copy of the lookup.
    place = F.monotonically_increasing_id()
    # A null key matches nothing, so its rows may go anywhere.
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    salt = F.when(no_key, F.pmod(place, F.lit(NULL_KEY_SALTS))).otherwise(
        F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(F.pmod(place, "_salts"))
    )
    spread = facts.join(salts, keys, "left").withColumn("_salt", salt.cast("int"))
    copies = (
        lookup.join(salts, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return spread.drop("_salts").join(copies, [*keys, "_salt"], how).drop("_salt")


def used_lookup(lookup: DataFrame, facts: DataFrame, keys: Sequence[str], broadcast_rows: int | None = None) -> DataFrame:
    """The rows of a lookup that a join with the large side can meet, written once; a small lookup stays as it is.

    For large sides that have few keys: their part of the lookup may be broadcast where the whole may not.
    """
    spark = lookup.sparkSession
    if lookup.limit(_broadcast_rows(spark, broadcast_rows) + 1).count() <= _broadcast_rows(spark, broadcast_rows):
        return lookup
    used = materialize(facts.select(*keys).distinct(), "used-keys")
    return materialize(lookup_join(lookup, used, keys, "left_semi", broadcast_rows), "used-lookup")


def keep_listed(facts: DataFrame, lookup: DataFrame, columns: Sequence[str], limit: int = 1000) -> DataFrame:
    """Filter the large side by the few values a lookup has, so that scans and partitions are pruned.

    At most ``limit`` + 1 rows reach the driver; a longer list filters nothing here and is left to
    the join that follows.
    """
    listed = lookup.select(*columns).distinct().limit(limit + 1).collect()
    if len(listed) > limit:
        return facts
    for i, column in enumerate(columns):
        facts = facts.filter(F.col(column).isin(*sorted({r[i] for r in listed if r[i] is not None})))
    return facts


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    out: str = "index",
    hot_rows: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """0-based position of each row within its key, by ``order``; ``rows`` is their number where it is known.

    Keys must not be null. Ordinary keys use one window. A hot key is range-partitioned by key and order, numbered within
    each range, and shifted by the sizes of the ranges before it, so no task holds the whole key.
    """
    keys = list(keys)
    hot_rows = _hot_rows(df.sparkSession, hot_rows)
    ordering = [F.col(c) if isinstance(c, str) else c for c in order]
    in_key = (F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)) - 1).cast("int")
    if rows is not None and rows <= hot_rows:  # no key has more rows than the table
        return df.withColumn(out, in_key)
    crowded = _crowded(df, keys, hot_rows)
    if not crowded:
        return df.withColumn(out, in_key)
    hot = materialize(_hot_among(df, keys, hot_rows, crowded), "hot-keys")
    sizes = hot.agg(F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("rows")).first()
    if sizes["n"] == 0:
        return df.withColumn(out, in_key)
    marks = hot.select(*keys)
    if sizes["n"] <= _broadcast_rows(df.sparkSession, None):
        marks = F.broadcast(marks)
    cold = df.join(marks, keys, "left_anti").withColumn(out, in_key)

    ranges = math.ceil(sizes["rows"] / hot_rows) + 1
    # Written once: range bounds are sampled, so the range number must not be computed twice.
    placed = materialize(
        df.join(marks, keys, "left_semi")
        .repartitionByRange(ranges, *keys, *ordering)
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy(*keys, "_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    in_range = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*ordering)) - 1
    warm = (
        placed.withColumn("_in_range", in_range)
        .join(shifts, [*keys, "_range"])
        .withColumn(out, (F.col("_shift") + F.col("_in_range")).cast("int"))
        .drop("_range", "_in_range", "_shift")
    )
    return cold.unionByName(warm)
