"""Builds the library's raw inputs out of the general-purpose test tables.

``raw_events`` maps the ``events`` and ``customer`` tables to flat game events with sessions,
churn, revenue and repeated rows; the other functions derive report-shaped and nested inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playerlens import schemas

EPOCH_DAY = "2024-01-01"


# Given, so that opening a table does not start a job to infer them.
TABLE_SCHEMAS = {
    "events": schemas.struct(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "customer": schemas.struct(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "nation": schemas.struct("n_nationkey int, n_name string, n_regionkey int"),
    "region": schemas.struct("r_regionkey int, r_name string"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


# Output column: SQL expression over u(ser), t(ype), v(alue), k, d(ay), at and copy.
RAW_EVENT_COLUMNS = {
    "event_key": "event_id",
    "event_date": "d",
    "event_timestamp": "at",
    "event_name": """CASE
        WHEN t = 'click' THEN
          CASE WHEN k % 4 = 0 THEN 'level_retry' WHEN k % 8 = 1 THEN 'select_content'
            ELSE 'level_start' END
        WHEN t = 'signup' THEN IF(k % 3 = 0, 'level_complete', 'level_up')
        WHEN t = 'error' THEN
          CASE WHEN k % 4 = 0 THEN 'level_reset' WHEN k % 8 = 2 THEN 'app_remove'
            ELSE 'level_end' END
        WHEN t = 'view' THEN
          CASE k % 8 WHEN 0 THEN 'ad_impression' WHEN 4 THEN 'ad_click'
            WHEN 3 THEN 'user_engagement' WHEN 7 THEN 'session_start' ELSE 'post_score' END
        WHEN t = 'purchase' THEN
          CASE k % 3 WHEN 0 THEN 'in_app_purchase' WHEN 1 THEN 'spend_virtual_currency'
            ELSE 'earn_virtual_currency' END
        END""",
    "event_value_in_usd": """CASE
        WHEN t = 'purchase' AND k % 3 = 0 AND u % 3 = 1 THEN v
        WHEN t = 'view' AND k % 4 = 0 AND u % 5 = 0 THEN 0.01D END""",
    "user_pseudo_id": "concat('p', u)",
    "user_id": "IF(u % 3 <> 0, concat('a', u), NULL)",
    "user_first_touch_timestamp":
        "CAST(date_add(DATE'2024-01-01', CAST(u % 8 AS INT)) AS TIMESTAMP)",
    "platform": "IF(u % 2 = 0, 'ANDROID', 'IOS')",
    "stream_id": "concat('s', u % 4)",
    "device_category": "IF(u % 5 <> 0, 'mobile', NULL)",
    "device_brand": "IF(u % 5 <> 0, c_mktsegment, NULL)",
    "device_model": "IF(u % 5 <> 0, concat('model', u % 6), NULL)",
    "device_os": "IF(u % 5 <> 0, IF(u % 2 = 0, 'android', 'ios'), NULL)",
    "device_os_version": "IF(u % 5 <> 0, concat(u % 4, '.0'), NULL)",
    "device_language": "IF(u % 5 <> 0 AND u % 7 <> 0, 'en', NULL)",
    "geo_continent": "r_name",
    "geo_country": "n_name",
    "geo_region": "concat('region', u % 10)",
    "geo_city": "IF(u % 6 <> 0, concat('city', u % 12), NULL)",
    "traffic_source": "IF(u % 4 <> 0, concat('src', u % 4), NULL)",
    "traffic_medium": "IF(u % 4 <> 0, 'cpc', NULL)",
    "traffic_campaign": "IF(u % 4 <> 0, concat('camp', u % 3), NULL)",
    "param_level": """IF(t IN ('click', 'signup', 'error') OR (t = 'view' AND k % 4 IN (1, 2)),
        CAST(floor(k / 5) + 1 AS BIGINT), NULL)""",
    "param_score": "IF(t = 'view' AND k % 4 IN (1, 2), CAST(floor(v * 10) AS BIGINT), NULL)",
    "param_board": "IF(t IN ('click', 'error'), concat('b', k % 3), NULL)",
    "param_success":
        "IF(t = 'error' AND k % 4 <> 0, IF(k % 3 = 0, 'false', 'true'), NULL)",
    "param_value": "IF(t = 'purchase', v / 2, CAST(NULL AS DOUBLE))",
    "param_virtual_currency_name": "IF(t = 'purchase' AND k % 3 <> 0, 'coins', NULL)",
    "param_engagement_time_msec": "CAST(floor(v * 100) AS BIGINT) + copy",
    "param_firebase_screen": "IF(t = 'view', concat('screen', k % 5), NULL)",
    "param_firebase_screen_class": "IF(t = 'view', 'main', NULL)",
    "param_session_id": "CAST(u * 1000 + day(d) AS STRING)",
    "_ingestion_timestamp": "at + make_dt_interval(0, 1 + copy)",
    "_source_date_suffix": "date_format(d, 'yyyyMMdd')",
}


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat raw events plus ``event_key``, the id of the row each event came from.

    Every 50th event is there twice, the later copy slightly different.
    """
    # A player is active from day u % 8 for a span that ends on the last day at the latest; every
    # event is moved into it, so that installs and churn are staggered and none is left out.
    moved = (
        table(spark, sf_dir, "events")
        .selectExpr(
            "event_id",
            "user_id AS u",
            "event_type AS t",
            "value AS v",
            "CAST(get_json_object(props, '$.k') AS INT) AS k",
            "datediff(to_date(ts), DATE'2024-01-01') AS day",
            "hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS sod",
        )
        .withColumn("span", F.expr("least(8 + (u * 7) % 25, 29) - u % 8 + 1"))
        .withColumn(
            "d", F.expr("date_add(DATE'2024-01-01', CAST(u % 8 + pmod(day, span) AS INT))")
        )
    )
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    who = (
        table(spark, sf_dir, "customer")
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .join(region, F.expr("n_regionkey = r_regionkey"))
    )
    sent = moved.join(who, F.expr("u = c_custkey")).selectExpr(
        "*",
        "timestamp_seconds(unix_seconds(CAST(d AS TIMESTAMP)) + floor(sod / 12)) AS at",
        "explode(IF(event_id % 50 = 0, array(0, 1), array(0))) AS copy",
    )
    return sent.selectExpr(*[f"{e} AS {c}" for c, e in RAW_EVENT_COLUMNS.items()])


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events in their nested form, with the shard ``suffix`` as a column."""
    return nest(raw_events(spark, sf_dir))


def nest(flat: DataFrame) -> DataFrame:
    def param(key: str, column: str, slot: str) -> Column:
        value = F.struct(
            *[
                (F.col(column) if s == slot else F.lit(None)).cast(kind).alias(s)
                for s, kind in (
                    ("string_value", "string"),
                    ("int_value", "bigint"),
                    ("double_value", "double"),
                )
            ]
        )
        return F.when(
            F.col(column).isNotNull(), F.struct(F.lit(key).alias("key"), value.alias("value"))
        )

    even = F.substring("user_pseudo_id", 2, 20).cast("bigint") % 2 == 0
    params = F.array_compact(
        F.array(
            param("level", "param_level", "int_value"),
            param("score", "param_score", "int_value"),
            param("board", "param_board", "string_value"),
            param("success", "param_success", "string_value"),
            param("value", "param_value", "double_value"),
            param("virtual_currency_name", "param_virtual_currency_name", "string_value"),
            param("engagement_time_msec", "param_engagement_time_msec", "int_value"),
            param("firebase_screen", "param_firebase_screen", "string_value"),
            param("firebase_screen_class", "param_firebase_screen_class", "string_value"),
            # As text for half of the players, as a number for the others.
            F.when(even, param("ga_session_id", "param_session_id", "string_value")).otherwise(
                param("ga_session_id", "param_session_id", "int_value")
            ),
        )
    )
    nested = flat.select(
        F.date_format("event_date", "yyyyMMdd").alias("event_date"),
        F.unix_micros("event_timestamp").alias("event_timestamp"),
        "event_name",
        "event_value_in_usd",
        "user_pseudo_id",
        "user_id",
        F.unix_micros("user_first_touch_timestamp").alias("user_first_touch_timestamp"),
        "platform",
        "stream_id",
        F.struct(
            F.col("device_category").alias("category"),
            F.col("device_brand").alias("mobile_brand_name"),
            F.col("device_model").alias("mobile_model_name"),
            F.col("device_os").alias("operating_system"),
            F.col("device_os_version").alias("operating_system_version"),
            F.col("device_language").alias("language"),
        ).alias("device"),
        F.struct(
            F.col("geo_continent").alias("continent"),
            F.col("geo_country").alias("country"),
            F.col("geo_region").alias("region"),
            F.col("geo_city").alias("city"),
        ).alias("geo"),
        F.struct(
            F.col("traffic_source").alias("source"),
            F.col("traffic_medium").alias("medium"),
            F.col("traffic_campaign").alias("name"),
        ).alias("traffic_source"),
        params.cast(schemas.NESTED_EVENTS["event_params"].dataType).alias("event_params"),
        F.col("_source_date_suffix").alias("suffix"),
    )
    return nested


def installs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Install report rows from ``customer``; every fifth one is organic and free."""
    key = F.col("c_custkey")
    at = F.date_add(F.lit(EPOCH_DAY).cast("date"), (key % 30).cast("int")).cast("timestamp")
    paid = key % 5 != 0
    return table(spark, sf_dir, "customer").select(
        F.when(paid, "installs").otherwise("organic_installs").alias("report_type"),
        F.concat(F.lit("af"), key.cast("string")).alias("appsflyer_id"),
        at.alias("install_time"),
        at.alias("event_time"),
        F.lit("install").alias("event_name"),
        F.when(paid, F.lower("c_mktsegment")).otherwise("organic").alias("media_source"),
        F.when(paid, F.abs("c_acctbal") / 1000).otherwise(0.0).alias("cost_value"),
        F.when(key % 2 == 0, "android").otherwise("ios").alias("platform"),
        F.col("c_nationkey").cast("string").alias("country_code"),
    )


def attribution_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In-app event report rows from ``orders``; every tenth order was delivered twice."""
    key = F.col("o_orderkey")
    # Order priority to event name.
    name = (
        F.when(F.col("o_orderpriority").startswith("1"), "af_purchase")
        .when(F.col("o_orderpriority").startswith("2"), "af_level_achieved")
        .when(F.col("o_orderpriority").startswith("3"), "af_ad_view")
        .when(F.col("o_orderpriority").startswith("4"), "af_spent_credits")
        .otherwise("session_start")
    )
    rows = table(spark, sf_dir, "orders").select(
        key.alias("order_key"),
        F.concat(F.lit("af"), F.col("o_custkey").cast("string")).alias("appsflyer_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        name.alias("event_name"),
        F.when(F.col("o_orderpriority").startswith("1"), F.col("o_totalprice")).alias(
            "event_revenue"
        ),
        F.when(key % 3 == 0, "organic").otherwise("network").alias("media_source"),
        F.when(F.col("o_custkey") % 2 == 0, "android").otherwise("ios").alias("platform"),
        F.explode(
            F.when(key % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ).alias("copy"),
    )
    return rows.select(
        "*",
        (
            F.col("event_time") + F.make_dt_interval(hours=F.col("copy") + 1)
        ).alias("_ingestion_timestamp"),
    )
