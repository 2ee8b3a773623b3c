"""Landing as a catalog table, the refreshed view, and parameters in any value slot."""

from __future__ import annotations

from conftest import export_row, make_export
from pyspark.sql import functions as F

from touchcredit.functions.columns import event_param
from touchcredit.sources.export import land_export
from touchcredit.sources.sinks import refresh_view

ROWS = [export_row("a", "session_start", "2024-01-01 10:00", 1),
        export_row("a", "file_download", "2024-01-01 10:05", 1, revenue=5.0, txn="t1")]
LATER = [export_row("b", "session_start", "2024-01-02 10:00", 2),
         export_row("b", "file_download", "2024-01-02 10:05", 2, revenue=7.0, txn="t2")]


def test_view_over_a_catalog_table_sees_new_events_when_refreshed(spark):
    land_export(make_export(spark, ROWS), table="landed_export_test")

    def export():
        return spark.read.table("landed_export_test")

    def users():
        return {r[0] for r in spark.sql("SELECT DISTINCT blended_user_id FROM attribution_test").collect()}

    first = refresh_view(export, name="attribution_test")
    assert users() == {"a"}
    land_export(make_export(spark, LATER), table="landed_export_test", mode="append")
    second = refresh_view(export, name="attribution_test", previous=first)
    assert users() == {"a", "b"} and not first.rounds.staged
    second.close()


def test_param_value_is_read_from_any_slot(spark):
    df = spark.sql("""SELECT array(
        named_struct('key', 'd', 'value', named_struct('string_value', CAST(NULL AS STRING), 'int_value',
          CAST(NULL AS BIGINT), 'float_value', CAST(NULL AS DOUBLE), 'double_value', 2.5D)),
        named_struct('key', 'f', 'value', named_struct('string_value', CAST(NULL AS STRING), 'int_value',
          CAST(NULL AS BIGINT), 'float_value', 3D, 'double_value', CAST(NULL AS DOUBLE)))) AS event_params""")
    got = df.select(event_param("d").alias("a"), event_param("f", "int").alias("b"),
                    event_param("f", "double").alias("c"), F.isnull(event_param("none")).alias("d")).first()
    assert tuple(got) == ("2.5", 3, 3.0, True)
