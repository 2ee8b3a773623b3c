"""Column builders: JVM-side expressions only, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import AttributionConfig

_KINDS = ("int", "string", "double")


def event_param(key: str, kind: str = "string", params: str = "event_params") -> Column:
    """Value of the first ``event_params`` entry whose key is ``key``.

    Whichever of the entry's slots is populated is read and cast to the kind;
    NULL when the key is absent or its value does not cast.  ``filter`` + ``get`` tolerates repeated keys, which
    ``map_from_entries`` would reject.
    """
    if kind not in _KINDS:
        raise ValueError(f"kind must be one of {_KINDS}")
    value = F.get(F.filter(F.col(params), lambda p: p["key"] == F.lit(key)), 0)["value"]
    real = F.coalesce(value["double_value"], value["float_value"])
    if kind == "int":
        return F.coalesce(value["int_value"], value["string_value"].try_cast("bigint"), real.try_cast("bigint"))
    if kind == "double":
        return F.coalesce(real, value["int_value"].cast("double"), value["string_value"].try_cast("double"))
    return F.coalesce(value["string_value"], value["int_value"].cast("string"), real.cast("string"))


def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def micros_to_ts(micros: Column) -> Column:
    """Microsecond epoch -> TIMESTAMP_NTZ in UTC, independent of the session time zone."""
    return F.timestamp_add("MICROSECOND", micros, epoch_ntz())


def event_key(pseudo_id: Column, name: Column, micros: Column) -> Column:
    """``pseudo-name-micros`` text; NULL when any part is NULL.

    The time part is the integer microsecond epoch, so two events one
    microsecond apart never share a key.
    """
    return F.concat(pseudo_id, F.lit("-"), name, F.lit("-"), micros.cast("string"))


def device_class(category: Column, app_id: Column) -> Column:
    """desktop / tablet-web / mobile-web / tablet-app / mobile-app, else NULL."""
    return (F.when(category == "desktop", F.lit("desktop"))
            .when((category == "tablet") & app_id.isNull(), F.lit("tablet-web"))
            .when((category == "mobile") & app_id.isNull(), F.lit("mobile-web"))
            .when((category == "tablet") & app_id.isNotNull(), F.lit("tablet-app"))
            .when((category == "mobile") & app_id.isNotNull(), F.lit("mobile-app")))


def is_non_direct(source: Column, cfg: AttributionConfig) -> Column:
    """FALSE for the configured direct sources (lower-cased); TRUE otherwise, NULL included."""
    return F.when(F.lower(source).isin(*cfg.direct_sources), F.lit(False)).otherwise(F.lit(True))


def is_paid(medium: Column, cfg: AttributionConfig) -> Column:
    """TRUE when lower(medium) LIKE the paid pattern; FALSE otherwise, NULL included."""
    return F.when(F.lower(medium).like(cfg.paid_medium_pattern), F.lit(True)).otherwise(F.lit(False))


def div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b = 0, NULL when either side is NULL."""
    return F.when(b == 0, F.lit(0.0)).otherwise(F.try_divide(a, b))


def null_str() -> Column:
    return F.lit(None).cast("string")


def nulls_last_key(*cols: Column) -> Column:
    """Struct whose natural ordering is ``cols ASC NULLS LAST`` (for min/max).

    Field ``_v{i}`` holds the i-th column's value.
    """
    parts = []
    for i, c in enumerate(cols):
        parts += [c.isNull().alias(f"_n{i}"), c.alias(f"_v{i}")]
    return F.struct(*parts)


def non_null_key(c: Column) -> Column:
    """Injective non-null string for a nullable key (NULL -> '0', v -> '1'||v).

    Lets NULL behave as one group in equi-joins, as SQL windows treat it.
    """
    return F.concat(F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce(c.cast("string"), F.lit("")))


MIN_LONG = -9223372036854775808


def non_null_long(c: Column) -> Column:
    """Non-null LONG for a nullable integral key (NULL -> Long.MinValue)."""
    return F.coalesce(c.cast("long"), F.lit(MIN_LONG))
