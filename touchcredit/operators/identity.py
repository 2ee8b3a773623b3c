"""O05 identity stitching and O09 blending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans import chunked as ck


def last_logins(events: DataFrame) -> DataFrame:
    """Last non-NULL ``user_id`` per ``user_pseudo_id`` (NULL pseudo id is one group).

    "Last" follows ``event_ts ASC NULLS LAST`` (ties: greater ``user_id``).
    Only rows carrying a login are read (the filter reaches the Parquet
    scan), so this never aggregates the whole event table.
    """
    # Per login its latest time: fixed-width buffers, so a hash aggregate that
    # combines before the shuffle; the window then sees distinct logins, and
    # its group limit keeps one of them per task before its own exchange.
    latest = (events.filter(F.col("user_id").isNotNull()).groupBy("user_pseudo_id", "user_id")
              .agg(F.max(F.col("event_ts").isNull()).alias("_no_ts"), F.max("event_ts").alias("_ts")))
    last = Window.partitionBy("user_pseudo_id").orderBy(F.desc("_no_ts"), F.desc("_ts"), F.desc("user_id"))
    # Among logins with a NULL time the greatest user_id is last, whatever their other times.
    return (latest.withColumn("_ts", F.when(~F.col("_no_ts"), F.col("_ts")))
            .withColumn("_place", F.row_number().over(last)).filter(F.col("_place") == 1)
            .select("user_pseudo_id", "user_id"))


def stitch_identities(events: DataFrame) -> DataFrame:
    """One row per ``user_pseudo_id``: last non-NULL login, first and last seen.

    A group-by replaces the DISTINCT over whole-partition windows.  First and
    last seen are a hash aggregation with fixed-width buffers (partial,
    map-side, so a hot pseudo id costs one row per task); the login comes from
    :func:`last_logins` and is attached with a NULL-safe join.
    """
    seen = events.groupBy("user_pseudo_id").agg(F.min("event_ts").alias("first_seen_at"),
                                                F.max("event_ts").alias("last_seen_at"))
    logins = last_logins(events).withColumnRenamed("user_pseudo_id", "_p")
    joined = seen.join(logins, seen["user_pseudo_id"].eqNullSafe(logins["_p"]), "left")
    return joined.select("user_pseudo_id", "user_id", "first_seen_at", "last_seen_at")


def login_map(ids: DataFrame) -> DataFrame:
    """pseudo id -> login, for pseudo ids that ever logged in (the only ones a join can change).

    ``ids`` is :func:`last_logins` output or :func:`stitch_identities` output.
    """
    return (ids.filter(F.col("user_pseudo_id").isNotNull() & F.col("user_id").isNotNull())
            .select("user_pseudo_id", F.col("user_id").alias("_login")))


def blend_users(df: DataFrame, ids: DataFrame, logins: DataFrame | None = None,
                heavy: ck.Heavy | None = None) -> DataFrame:
    """``df`` + ``blended_user_id = coalesce(login, user_pseudo_id)``.

    Left join on ``user_pseudo_id``, in one pass over ``df``.  A NULL pseudo id
    never matches: such rows join on a hash of the row behind a mark that no
    login has, so they spread over all partitions; ``heavy`` pseudo ids (keys of
    ``ck.heavy_keys``) take their login from a small broadcast, others that are hot
    are split by AQE's skew join.  ``logins`` is ``login_map(ids)`` when the caller
    already has it.
    """
    lookup = logins if logins is not None else login_map(ids)
    spread = F.concat(F.lit("0"), F.xxhash64(*df.columns).cast("string"))
    key = F.concat(F.lit("1"), F.col("user_pseudo_id"))
    lookup = lookup.select(key.alias("_pk"), "_login")
    return (ck.join_unique(df, lookup, F.coalesce(key, spread), F.col("_pk"), heavy)
            .withColumn("blended_user_id", F.coalesce(F.col("_login"), F.col("user_pseudo_id")))
            .select(*df.columns, "blended_user_id"))


def login_keys(logins: DataFrame) -> DataFrame:
    """The login map under the ordered stages' key."""
    return logins.select(F.concat(F.lit("1"), F.col("user_pseudo_id")).alias(ck.KEY), "_login")


def blend_ordered(rows: ck.Ordered, logins: DataFrame) -> DataFrame:
    """:func:`blend_users` of rows that are dealt by pseudo id.

    Dealt rows stay where they are: the join reuses their exchange and only the
    login map moves.  Pinned rows take their logins from a broadcast of at most one
    row per hot key.
    """
    lookup = login_keys(logins)
    blended = F.coalesce(F.col("_login"), F.col("user_pseudo_id"))

    def joined(part: DataFrame, known: DataFrame) -> DataFrame:
        return ck.drop_internal(part.join(known, ck.KEY, "left").withColumn("blended_user_id", blended).drop("_login"))

    dealt = joined(rows.dealt, lookup)
    if rows.pinned is None:
        return dealt
    known = lookup.join(F.broadcast(rows.heavy.hot), ck.KEY, "left_semi")
    return dealt.unionByName(joined(rows.pinned, F.broadcast(known)))


def user_counts(counts: DataFrame, logins: DataFrame) -> DataFrame:
    """Row counts per pseudo id (``_ck_key, n``) as counts per blended user."""
    return (counts.join(login_keys(logins), ck.KEY, "left")
            .select(F.coalesce(F.concat(F.lit("1"), F.col("_login")), F.col(ck.KEY)).alias(ck.KEY), "n"))
