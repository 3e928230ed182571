"""Commits as units: events of a commit may come in any files, batches and order, and are given out once, together.

The end of a commit is an event too, the marker, which tells how many events the commit has. Until all of them have
come they wait in a table, the buffer, which is the state of the stream, keyed by commit. Each micro-batch writes a
new version of it: what waited and what came, without repeated events, split into the commits that are whole now
and those that go on waiting. Only the last version is read, so a batch that runs again gives the same; and no
commit is held in the memory of one task, however large it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from modelweave.functions.scale import lookup_join
from modelweave.operators.changes import ChangeLookups, classify_changes
from modelweave.schemas import RAW, struct
from modelweave.streaming.changes import Notifier, notify_all

COMMITTED = "TRANSACTION_COMMITTED"


def with_markers(changes: DataFrame) -> DataFrame:
    """Events with a marker for each commit; a marker is no element's event, so classification passes over it."""
    names = [f.name for f in struct(RAW["change"]).fields]
    ends = changes.groupBy("txn").agg(F.count_distinct("seq").alias("n")).select(
        "txn", F.lit(False).alias("is_element"), F.lit(COMMITTED).alias("property"),
        F.col("n").cast("string").alias("new_value"),
    )
    return changes.select(*names).unionByName(ends, allowMissingColumns=True)


class CommitBuffer:
    """The events of commits that are not whole, below ``folder``; one version per micro-batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _version(self, batch_id: int) -> str:
        return f"{self.folder}/version={batch_id}"

    def _read(self, batch_id: int, whole: bool) -> DataFrame:
        held = self.spark.read.schema(f"{RAW['change']}, whole boolean").parquet(self._version(batch_id))
        return held.filter(F.col("whole") == whole).drop("whole")

    def _given_out(self, batch_id: int) -> DataFrame | None:
        """Commits of earlier batches that were given out."""
        if batch_id == 0:
            return None
        return self.spark.read.schema("txn string").parquet(
            *[f"{self.folder}/given-out/batch={n}" for n in range(max(0, batch_id - 1), batch_id)]
        )

    def release(self, events: DataFrame, batch_id: int) -> DataFrame:
        """Add a micro-batch's events; returns those of all commits that are whole now."""
        names = [f.name for f in struct(RAW["change"]).fields]
        held = events.select(*names)
        before = self._given_out(batch_id)
        if before is not None:
            held = held.join(before, "txn", "left_anti").unionByName(self._read(batch_id - 1, False))
        held = held.dropDuplicates(["txn", "seq"])
        marker = F.col("property") == COMMITTED
        commits = held.groupBy("txn").agg(
            F.max(F.when(marker, F.col("new_value").cast("long"))).alias("announced"),
            F.count(F.when(~marker, F.lit(1))).alias("came"),
        )
        whole = commits.select("txn", F.coalesce(F.col("came") >= F.col("announced"), F.lit(False)).alias("whole"))
        placed = lookup_join(held, whole, ["txn"]).select(*names, "whole")
        placed.write.mode("overwrite").partitionBy("whole").parquet(self._version(batch_id))
        released = self._read(batch_id, True)
        out = released.select("txn").distinct()
        # Carried on from batch to batch, so that an event that comes again later is known.
        (out if before is None else out.unionByName(before)).write.mode("overwrite").parquet(
            f"{self.folder}/given-out/batch={batch_id}"
        )
        for old in (self._version(batch_id - 2), f"{self.folder}/given-out/batch={batch_id - 2}"):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(old)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return released.filter(~marker)

    def waiting(self, batch_id: int) -> DataFrame:
        """(txn, came) of the commits that are not whole after a batch."""
        events = self._read(batch_id, False).filter(F.col("property") != COMMITTED)
        return events.groupBy("txn").agg(F.count(F.lit(1)).alias("came"))


def classify_commits(
    changes: DataFrame, lookups: ChangeLookups, notifiers: Sequence[Notifier], checkpoint: str, buffer: str,
    available_now: bool = False, manifest: str | None = None,
) -> StreamingQuery:
    """Classify whole commits only; their records reach the notifiers in the order of ``txn`` and ``seq``."""
    spark = changes.sparkSession

    def batch(events: DataFrame, batch_id: int) -> None:
        whole = CommitBuffer(spark, buffer).release(events, batch_id)
        records = classify_changes(whole, lookups).orderBy("txn", "seq", "event", "attribute")
        notify_all(records, batch_id, notifiers, manifest)

    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
