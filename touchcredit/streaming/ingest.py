"""Incremental landing of export files (load only files not seen before).

A Structured Streaming file source remembers, in its checkpoint, every file
it has processed; ``trigger(availableNow=True)`` processes whatever is new and
stops.  Each batch of files is appended by one idempotent commit: its rows go
to a folder named after the load history and the batch, so a batch that failed
after it was written, and is run again, replaces its own rows instead of adding
them twice.  Re-running the load adds nothing; a new file adds only its rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schema import EXPORT_SCHEMA
from ..sources.export import path_matches, with_event_date

LOAD = "load"  # partition folder of a batch


def load_export_incremental(spark: SparkSession, source: str, table_path: str, checkpoint: str,
                            glob: str = "*.parquet", max_files_per_trigger: int | None = None,
                            pattern: str | None = None) -> int:
    """Append unseen export files under ``source`` to the Parquet table at ``table_path``.

    ``pattern`` is a regular expression or glob for a file's path below ``source``
    (``daily/.*``, see ``sources.export.path_matches``); ``glob`` restricts file
    names.  A file that was seen under one pattern counts as seen.
    ``checkpoint`` must be a shared, durable folder (it is the load history).
    The table has a folder per batch and, in it, per ``event_date``; read it with
    ``load_export``.  Returns the number of rows appended by this call.
    """
    reader = (spark.readStream.schema(EXPORT_SCHEMA)
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.parquet(source)
    if pattern is not None:
        rows = rows.filter(path_matches(spark, source, pattern))
    rows = with_event_date(rows)
    appended: dict[int, int] = {}

    def append(batch: DataFrame, number: int) -> None:
        appended[number] = _commit(batch, number, table_path, checkpoint)

    query = (rows.writeStream.foreachBatch(append)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return sum(appended.values())


def _commit(batch: DataFrame, number: int, table_path: str, checkpoint: str) -> int:
    """Write one batch to its own folder, in place of what an earlier attempt left there; rows written."""
    spark = batch.sparkSession
    history = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
    folder = f"{table_path.rstrip('/')}/{LOAD}={history}-{number:09d}"
    written = Observation()
    counted = batch.observe(written, F.count(F.lit(1)).alias("rows"))
    # By day, in files of the advisory size: large days are split, small ones share a task.
    counted.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(folder)
    return int(written.get["rows"])
