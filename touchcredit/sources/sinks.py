"""Where the attribution result goes (the workload defines a view)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..config import DEFAULT_CONFIG, AttributionConfig
from ..plans.pipeline import Attribution


def register_view(result: DataFrame, name: str = "attribution") -> DataFrame:
    """Expose the long-form result to SQL as a temporary view.

    The view is a snapshot: the result's chunk checkpoints were written when
    it was built, so events that arrive later appear only after
    :func:`refresh_view`.
    """
    result.createOrReplaceTempView(name)
    return result


def refresh_view(export: Callable[[], DataFrame], cfg: AttributionConfig = DEFAULT_CONFIG,
                 name: str = "attribution", previous: Attribution | None = None) -> Attribution:
    """Build the attribution from what ``export()`` reads now and point the view at it.

    Returns the new pipeline; pass it as ``previous`` next time, and its cached
    rows are released once the view has moved on.
    """
    run = Attribution(export(), cfg)
    register_view(run.result, name)
    if previous is not None:
        previous.close()
    return run


def write_attribution(result: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the long-form result as Parquet, one folder per model, in files of about the advisory size.

    Adaptive execution deals the rows by model and then merges small parts and
    splits large ones by their measured bytes
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so no model is gathered
    in one task.  Without it the rows are written where they are.
    """
    if result.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        result = result.hint("rebalance", "model")
    result.write.mode(mode).partitionBy("model").parquet(path)
