"""touchcredit: multi-cycle, multi-touch attribution on Spark DataFrames."""

from .config import DEFAULT_CONFIG, AttributionConfig
from .plans.pipeline import Attribution, attribution
from .sources.export import land_export, load_export
from .streaming.ingest import load_export_incremental

__all__ = ["AttributionConfig", "DEFAULT_CONFIG", "Attribution", "attribution", "load_export", "land_export",
           "load_export_incremental"]
