"""A stream of snapshot rows, each batch compared with the last snapshot it follows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import diff
from ..sources import sheets


def watch(spark: SparkSession, source: str, schema, state: str, reports: str, checkpoint: str, trigger: dict | None = None):
    """Start a query on the directory source whose batches are snapshots: each is kept under reports, and its added, removed and changed rows beside it.

    No watermark is needed: a batch is compared with the snapshot before it, not by event time. The state names the batch that wrote
    it and what that was compared with, so a batch that is run again after a failure makes the same reports once more.
    """

    def compare(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        path = f"{reports}/batch={batch_id}"
        sheets.write_report(batch, f"{path}/snapshot")
        held = sheets.load_state(spark, state)
        again = held.get("batch") == batch_id
        previous = held.get("before") if again else held.get("prev_file_name")
        now, then = sheets.load_sheet(spark, f"{path}/snapshot"), sheets.load_sheet(spark, previous) if previous else None
        for name, report in (("added", diff.added(then, now)), ("removed", diff.removed(then, now)), ("changed", diff.changed(then, now))):
            sheets.write_report(report, f"{path}/{name}")
        if not again:
            sheets.save_state(spark, state, f"{path}/snapshot", batch=batch_id, before=previous)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    return stream.writeStream.foreachBatch(compare).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
