"""Explicit schemas for every source; nothing is inferred."""

from pyspark.sql.types import (
    ArrayType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(18, 2)

# Event names and outcome statuses of the source log.
SESSION_START = "session_start"
LEVEL_START = "level_start"
LEVEL_COMPLETE = "level_complete"
LEVEL_FAIL = "level_fail"
AD_REWARD_CLAIM = "ad_reward_claim"
IAP_PURCHASE = "iap_purchase"
WIN = "Win"
FAIL = "Fail"

PARAM_VALUE = StructType(
    [
        StructField("int_value", LongType()),
        StructField("float_value", DoubleType()),
        StructField("double_value", DoubleType()),
        StructField("string_value", StringType()),
    ]
)
EVENT_PARAM = StructType([StructField("key", StringType()), StructField("value", PARAM_VALUE)])
EVENT_PARAMS = ArrayType(EVENT_PARAM)

# Nested event log, one JSON object per line.
RAW_EVENTS = StructType(
    [
        StructField("event_date", StringType()),  # yyyyMMdd, the session's date
        StructField("event_timestamp", LongType()),  # epoch microseconds
        StructField("user_id", StringType()),
        StructField("user_pseudo_id", StringType()),
        StructField("geo", StructType([StructField("country", StringType()), StructField("city", StringType())])),
        StructField(
            "device",
            StructType([StructField("category", StringType()), StructField("mobile_os", StringType())]),
        ),
        StructField("event_name", StringType()),
        StructField("event_params", EVENT_PARAMS),
    ]
)
CORRUPT_COLUMN = "_corrupt_record"
RAW_EVENTS_WITH_CORRUPT = StructType(RAW_EVENTS.fields + [StructField(CORRUPT_COLUMN, StringType())])

# Flat events CSV. level_id and gold_earned are written as floats ("1.0")
# when the column has gaps, so they are read as double and cast afterwards.
FLAT_EVENTS_CSV = StructType(
    [
        StructField("event_date", StringType()),
        StructField("event_timestamp", LongType()),
        StructField("event_name", StringType()),
        StructField("user_id", StringType()),
        StructField("country", StringType()),
        StructField("os", StringType()),
        StructField("level_id", DoubleType()),
        StructField("status", StringType()),
        StructField("weapon_used", StringType()),
        StructField("gold_earned", DoubleType()),
        StructField("price", DoubleType()),
        StructField("product_id", StringType()),
        StructField("duration", DoubleType()),
    ]
)

USER_ACQUISITION_CSV = StructType(
    [
        StructField("user_id", StringType()),
        StructField("install_date", StringType()),
        StructField("source", StringType()),
        StructField("campaign_id", StringType()),
        StructField("cpi", DoubleType()),
        StructField("tier", StringType()),
    ]
)

IAP_CSV = StructType(
    [
        StructField("user_id", StringType()),
        StructField("timestamp", StringType()),
        StructField("price", DoubleType()),
        StructField("pack", StringType()),
    ]
)

ADS_CSV = StructType(
    [
        StructField("user_id", StringType()),
        StructField("timestamp", StringType()),
        StructField("revenue", DoubleType()),
        StructField("placement", StringType()),
    ]
)

# Typed flattened fact table (the contract every KPI reads).
MASTER_EVENTS_COLUMNS = [
    "event_id",
    "user_id",
    "user_pseudo_id",
    "event_date",
    "event_ts",
    "event_name",
    "level_id",
    "win_loss_status",
    "gold_earned",
    "gold_reward",
    "revenue",
    "ad_revenue",
    "pack",
    "placement",
    "duration",
]

__all__ = [
    "MONEY",
    "SESSION_START",
    "LEVEL_START",
    "LEVEL_COMPLETE",
    "LEVEL_FAIL",
    "AD_REWARD_CLAIM",
    "IAP_PURCHASE",
    "WIN",
    "FAIL",
    "PARAM_VALUE",
    "EVENT_PARAM",
    "EVENT_PARAMS",
    "RAW_EVENTS",
    "RAW_EVENTS_WITH_CORRUPT",
    "CORRUPT_COLUMN",
    "FLAT_EVENTS_CSV",
    "USER_ACQUISITION_CSV",
    "IAP_CSV",
    "ADS_CSV",
    "MASTER_EVENTS_COLUMNS",
]
