"""Column contracts of every layer (widths and declared types)."""

from epicentre.plans import catalog as C
from epicentre.schemas import FACT_COLUMNS, RAW_SCHEMA, STAGING_COLUMNS


def test_layer_widths_and_types(spark, sf001):
    raw = C._raw(spark, sf001)
    assert [(f.name, f.dataType) for f in raw.schema] == [(f.name, f.dataType) for f in RAW_SCHEMA]
    assert len(raw.columns) == 29
    types = dict(raw.dtypes)
    assert types["event_time"] == "bigint" and types["magnitude"] == "double"
    assert types["num_stations"] == "int" and types["created_at"] == "timestamp_ntz"
    stg = C._stg(spark, sf001)
    assert stg.columns == STAGING_COLUMNS and len(stg.columns) == 36
    st = dict(stg.dtypes)
    assert (st["event_date"], st["has_tsunami_warning"], st["event_hour"], st["day_of_week"]) == (
        "date", "boolean", "int", "int")
    fct = C._fct(spark, sf001)
    assert fct.columns == FACT_COLUMNS and len(fct.columns) == 31
    assert len(C._warehouse(spark, sf001).table("agg_daily_summary").columns) == 27
    risk = C._warehouse(spark, sf001).table("agg_regional_risk")
    assert len(risk.columns) == 23 and dict(risk.dtypes)["days_with_data"] == "bigint"
    assert len(C._warehouse(spark, sf001).table("agg_hourly_heatmap").columns) == 8
