"""Change events as a stream: commit files in, one folder of records per micro-batch out.

A micro-batch takes many commits at once, so its tasks run in parallel; ``txn`` and ``seq`` keep the order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from modelweave.functions.scale import materialize
from modelweave.operators.changes import ChangeLookups, classify_changes
from modelweave.schemas import RAW, struct

Notifier = Callable[[DataFrame, int], None]
BYTES_PER_BATCH = 4 << 30


def read_changes(
    spark: SparkSession, folder: str, stream: bool = False, bytes_per_batch: int = BYTES_PER_BATCH
) -> DataFrame:
    """Events of all commits, undo and redo included; a streaming read takes so many bytes of files per batch."""
    schema = struct(RAW["change"])
    if not stream:
        return spark.read.schema(schema).parquet(folder)
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", str(bytes_per_batch)).parquet(folder)


def notify_all(
    records: DataFrame, batch_id: int, notifiers: Sequence[Notifier], manifest: str | None = None
) -> None:
    """Hand the records of one batch to every notifier; for several, they are written to the shared folder once.

    With ``manifest``, the batch is entered there when all of them have ended, and `notified` reads only what is
    entered: either all notifiers' outputs of a batch are seen or none.
    """
    spark = records.sparkSession
    if len(notifiers) > 1:
        records = materialize(records, "change-batch")
    for notifier in notifiers:
        notifier(records, batch_id)
    if manifest is not None:
        entry = spark.range(1).select(F.lit(batch_id).cast("long").alias("batch"), F.lit(len(notifiers)).alias("notifiers"))
        entry.write.mode("overwrite").parquet(f"{manifest}/entry-{batch_id}")


def notified(output: DataFrame, manifest: str) -> DataFrame:
    """The rows of a notifier's output, read with its column ``batch``, of batches that the manifest names."""
    entered = output.sparkSession.read.schema("batch long, notifiers int").option("recursiveFileLookup", True).parquet(manifest)
    return output.join(entered.select("batch").distinct(), output["batch"].cast("long") == entered["batch"], "left_semi")


def as_messages(records: DataFrame) -> DataFrame:
    """The messages of a record (its description, and a second one for a deleted element), then the record as JSON."""
    fields = [c for c in records.columns if c != "description"]
    messages = F.array("description")
    if {"event", "changeKind", "entity"} <= set(records.columns):
        deleted = (F.col("event") == "ModelElementChangedEvent") & (F.col("changeKind") == "DeletedChange")
        after = F.concat(F.lit("post(DELETE) UUID="), F.coalesce("entity", F.lit("null")))
        messages = F.when(deleted, F.array("description", after)).otherwise(messages)
    return records.select("txn", "seq", messages.alias("messages"), F.to_json(F.struct(*fields)).alias("record"))


def write_change_events(folder: str) -> Notifier:
    """Notifier that writes messages and records; a repeated batch replaces its own folder."""

    def write(records: DataFrame, batch_id: int) -> None:
        as_messages(records).write.mode("overwrite").json(f"{folder}/batch={batch_id}")

    return write


def write_records(folder: str) -> Notifier:
    def write(records: DataFrame, batch_id: int) -> None:
        records.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return write


def classify_stream(
    changes: DataFrame, lookups: ChangeLookups, notifiers: Sequence[Notifier], checkpoint: str,
    available_now: bool = False, manifest: str | None = None,
) -> StreamingQuery:
    """Classify each micro-batch of events and notify; stateless, so no watermark is needed."""
    writer = (
        classify_changes(changes, lookups)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda records, batch_id: notify_all(records, batch_id, notifiers, manifest))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
