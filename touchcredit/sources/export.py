"""Batch reading and landing of the nested event export."""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import EXPORT_SCHEMA


def path_matches(spark: SparkSession, path: str, pattern: str) -> Column:
    """Does a row's file, by its path below ``path``, match ``pattern``?

    The pattern is a regular expression (Java's) for the whole relative path
    (``daily/.*``); a glob (``daily/*.parquet``, where ``*`` spans folders) is
    understood as well.  As a predicate on the file's metadata it prunes whole
    files when a scan is planned.
    """
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(path).toUri().getPath().rstrip("/")
    if not base.startswith("/"):  # relative paths are resolved like the reader's
        root = jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        base = fs.makeQualified(root).toUri().getPath().rstrip("/")
    # The metadata's path is an encoded URI; a plus sign stands for itself there.
    plain = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), "[+]", "%2B"))
    relative = F.substr(F.regexp_replace(plain, "^[^:/]+:(//[^/]*)?", ""), F.lit(len(base) + 2))
    forms = [fnmatch.translate(pattern).removesuffix("\\Z").removesuffix("\\z")]
    try:
        re.compile(pattern)
        forms.append(pattern)
    except re.error:  # a glob such as *.parquet is no regular expression
        pass
    return relative.rlike("^(?:" + "|".join(f"(?:{f})" for f in forms) + ")\\z")


def with_event_date(rows: DataFrame) -> DataFrame:
    """``event_date`` from the partition folder of the row's file where the file lacks it, else from the event's time."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), "event_date=([^/]+)/", 1)
    day = F.date_format(F.timestamp_micros("event_timestamp"), "yyyyMMdd")
    return rows.withColumn("event_date", F.coalesce("event_date", F.when(folder != "", folder), day))


def load_export(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Read staged Parquet export files under the declared export schema.

    ``pattern`` restricts the files read (see :func:`path_matches`): Spark lists
    the folder, in parallel where it is large, and drops files that do not match
    before any is opened; no match reads as an empty export.  Partition folders
    such as ``event_date=20240101`` fill their column either way.  Nothing is
    inferred: fields absent from a file read as NULL, and only the leaves a
    query uses are decoded (nested pruning).
    """
    reader = spark.read.schema(EXPORT_SCHEMA)
    if pattern is None:
        return reader.parquet(path).select(*EXPORT_SCHEMA.names)
    matching = reader.option("recursiveFileLookup", "true").parquet(path).filter(path_matches(spark, path, pattern))
    return with_event_date(matching).select(*EXPORT_SCHEMA.names)


def rebalanced_by_day(rows: DataFrame) -> DataFrame:
    """Rows dealt and sorted for a landing by day.

    Few files per day, and a day holding a large share of the export is still split over several tasks (by
    measured size).  A range split would compute the whole export twice: once for its sample.
    """
    return rows.hint("rebalance", F.col("event_date")).sortWithinPartitions("event_date")


def land_export(export: DataFrame, path: str | None = None, partition_by_date: bool = True, mode: str = "overwrite",
                table: str | None = None, by_day: bool = False) -> None:
    """Write a typed landing copy of the export, partitioned by ``event_date``.

    ``by_day``: the rows come from :func:`rebalanced_by_day` and only need to be written.

    ``table`` names a catalog table to create or replace, at ``path`` when one
    is given; without it the copy is files under ``path``.

    Partitioning by day lets later reads prune whole days; the attribution
    itself needs the full history (logins and later conversions relabel
    earlier sessions), so it reads every partition.
    """
    if partition_by_date:
        dealt = export if by_day else export.hint("rebalance", F.col("event_date"))
        writer = dealt.write.mode(mode).partitionBy("event_date")
    else:
        writer = export.write.mode(mode)
    if table is None:
        writer.parquet(path)
    else:
        (writer.option("path", path) if path else writer).format("parquet").saveAsTable(table)


def to_variant(export: DataFrame) -> DataFrame:
    """One-column VARIANT form of the export (compatibility input)."""
    return export.select(F.to_variant_object(F.struct(*[F.col(c) for c in export.columns])).alias("v"))


def from_variant(landing: DataFrame, column: str = "v") -> DataFrame:
    """Typed export from a one-column VARIANT landing table, with absent structs as NULL (reads every struct whole)."""
    v = F.col(column)
    return landing.select(*[F.variant_get(v, f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
                            for f in EXPORT_SCHEMA.fields])


SHREDDING = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}


def land_variant(export: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Land the export as one VARIANT column in Parquet, shredded: frequent fields get columns of their own."""
    conf = export.sparkSession.conf
    kept = {k: conf.get(k, None) for k in SHREDDING}
    for k, v in SHREDDING.items():
        conf.set(k, v)
    try:
        to_variant(export).write.mode(mode).parquet(path)
    finally:
        for k, v in kept.items():
            conf.unset(k) if v is None else conf.set(k, v)


def variant_leaves(landing: DataFrame, column: str = "v") -> DataFrame:
    """The export put together leaf by leaf from a VARIANT column.

    Every leaf of the schema is its own extraction, so the optimizer keeps those
    a query uses, and Spark pushes them into the scan: of a shredded file only
    their columns are read.  An absent struct reads as a struct of NULLs, which
    every operator treats alike; ``event_params`` is one leaf.
    """

    def leaf(path: str, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            return F.struct(*[leaf(f"{path}.{f.name}", f.dataType).alias(f.name) for f in kind.fields])
        return F.variant_get(F.col(column), path, kind.simpleString())

    return landing.select(*[leaf(f"$.{f.name}", f.dataType).alias(f.name) for f in EXPORT_SCHEMA.fields])
