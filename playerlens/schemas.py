"""Row types of the raw tables, and the layout each raw table is stored in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(text: str, **nested: T.DataType) -> T.StructType:
    """Fields from ``name type, ...``; works without a session. ``nested`` names other types."""
    kinds = {**_TYPES, **nested}
    pairs = [item.split() for item in text.split(",")]
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


# Column names and types of the incoming files.
RAW_INSTALLS = struct(
    """
    attributed_touch_type string, attributed_touch_time timestamp, install_time timestamp,
    event_time timestamp, event_name string, media_source string, channel string,
    campaign string, campaign_id string, adset string, adset_id string, ad string,
    ad_id string, site_id string, sub_site_id string, cost_model string, cost_value double,
    cost_currency string, appsflyer_id string, customer_user_id string, platform string,
    device_type string, os_version string, app_version string, country_code string,
    city string, ip string, wifi boolean, language string, operator string, carrier string,
    _ingestion_timestamp timestamp, _source string
    """
)

RAW_ATTRIBUTION_EVENTS = struct(
    """
    event_time timestamp, event_name string, event_value string, event_revenue double,
    event_revenue_currency string, media_source string, channel string, campaign string,
    campaign_id string, adset string, adset_id string, appsflyer_id string,
    customer_user_id string, platform string, device_type string, os_version string,
    app_version string, country_code string, city string, ip string, install_time timestamp,
    _ingestion_timestamp timestamp, _source string
    """
)

RAW_UNINSTALLS = struct(
    """
    event_time timestamp, appsflyer_id string, customer_user_id string, platform string,
    media_source string, campaign string, country_code string, install_time timestamp,
    _ingestion_timestamp timestamp, _source string
    """
)

RAW_EVENTS = struct(
    """
    event_date date, event_timestamp timestamp, event_name string, event_value_in_usd double,
    user_pseudo_id string, user_id string, user_first_touch_timestamp timestamp,
    platform string, stream_id string, device_category string, device_brand string,
    device_model string, device_os string, device_os_version string, device_language string,
    geo_continent string, geo_country string, geo_region string, geo_city string,
    traffic_source string, traffic_medium string, traffic_campaign string,
    param_level bigint, param_score bigint, param_board string, param_success string,
    param_value double, param_virtual_currency_name string,
    param_engagement_time_msec bigint, param_firebase_screen string,
    param_firebase_screen_class string, param_session_id string,
    _ingestion_timestamp timestamp, _source_date_suffix string
    """
)

_PARAM_VALUE = struct("string_value string, int_value bigint, double_value double")
NESTED_EVENTS = struct(
    """
    event_date string, event_timestamp bigint, event_name string, event_value_in_usd double,
    user_pseudo_id string, user_id string, user_first_touch_timestamp bigint,
    platform string, stream_id string, device device, geo geo,
    traffic_source traffic_source, event_params event_params
    """,
    device=struct(
        """
        category string, mobile_brand_name string, mobile_model_name string,
        operating_system string, operating_system_version string, language string
        """
    ),
    geo=struct("continent string, country string, region string, city string"),
    traffic_source=struct("source string, medium string, name string"),
    event_params=T.ArrayType(struct("key string, value value", value=_PARAM_VALUE)),
)


@dataclass(frozen=True)
class RawTable:
    """How a raw table is keyed and stored."""

    name: str
    schema: T.StructType
    time_column: str
    cluster_columns: tuple[str, ...]
    dedup_keys: tuple[str, ...]


INSTALLS = RawTable(
    "raw_installs",
    RAW_INSTALLS,
    "install_time",
    ("platform", "country_code", "media_source"),
    ("appsflyer_id", "install_time"),
)
ATTRIBUTION_EVENTS = RawTable(
    "raw_attribution_events",
    RAW_ATTRIBUTION_EVENTS,
    "event_time",
    ("event_name", "platform", "country_code"),
    ("appsflyer_id", "event_time", "event_name"),
)
UNINSTALLS = RawTable(
    "raw_uninstalls",
    RAW_UNINSTALLS,
    "event_time",
    ("platform", "country_code"),
    ("appsflyer_id", "event_time"),
)
RAW_TABLES = {t.name: t for t in (INSTALLS, ATTRIBUTION_EVENTS, UNINSTALLS)}

REPORT_TARGETS = {
    "installs": INSTALLS,
    "organic_installs": INSTALLS,
    "in_app_events": ATTRIBUTION_EVENTS,
    "organic_in_app_events": ATTRIBUTION_EVENTS,
    "uninstalls": UNINSTALLS,
}
