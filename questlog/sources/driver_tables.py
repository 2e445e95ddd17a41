"""Map the generic driver tables (``events``, ``customer``) onto the game
data model, as specified in FIXTURES.md section B.

Every mapping is one narrow projection (no shuffle) except the
acquisition table, which is one aggregate per player plus one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import format_yyyymmdd
from ..functions.params import to_event_params
from ..schemas import AD_REWARD_CLAIM, IAP_PURCHASE, LEVEL_COMPLETE, LEVEL_FAIL, MASTER_EVENTS_COLUMNS, SESSION_START
from .staged import staged_place

# Driver event_type -> game event_name.
EVENT_NAME_BY_TYPE = {
    "view": SESSION_START,
    "click": LEVEL_COMPLETE,
    "error": LEVEL_FAIL,
    "purchase": IAP_PURCHASE,
    "signup": AD_REWARD_CLAIM,
}
# The segment that plays the organic (zero-cost) source,
# the install window used by the ROAS report, and the ad reward amount.
ORGANIC_SEGMENT = "BUILDING"
INSTALL_WINDOW = ("2024-01-01", "2024-01-30")
AD_GOLD_REWARD = 50
LEVEL_CYCLE = 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_name_sql() -> str:
    whens = " ".join(f"WHEN '{src}' THEN '{dst}'" for src, dst in EVENT_NAME_BY_TYPE.items())
    return f"CASE event_type {whens} END"


def master_events_from_driver(events: DataFrame) -> DataFrame:
    """``events`` -> typed ``master_events``.

    One narrow projection, written as SQL expressions (a single call into
    the JVM instead of hundreds of Column calls). ``props`` is parsed once
    per row in an inner projection; Catalyst keeps that projection separate
    because the parsed value is used several times."""
    keyed = events.selectExpr(
        "event_id",
        "ts",
        "event_type",
        "value",
        "CAST(user_id * 10 + CAST(get_json_object(props, '$.k') AS INT) % 10 AS BIGINT) AS _player",
        "CAST(get_json_object(props, '$.k') AS INT) AS _k",
    )
    return keyed.selectExpr(
        "event_id",
        "_player AS user_id",
        "_player AS user_pseudo_id",
        "CAST(ts AS DATE) AS event_date",
        "CAST(ts AS TIMESTAMP) AS event_ts",
        f"{_event_name_sql()} AS event_name",
        f"CASE WHEN event_type IN ('click', 'error') THEN CAST(event_id % {LEVEL_CYCLE} + 1 AS BIGINT) END AS level_id",
        "CASE event_type WHEN 'click' THEN 'Win' WHEN 'error' THEN 'Fail' END AS win_loss_status",
        "CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) END AS gold_earned",
        f"CASE WHEN event_type = 'signup' THEN CAST({AD_GOLD_REWARD} AS BIGINT) END AS gold_reward",
        "CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END AS revenue",
        "CASE WHEN event_type = 'signup' THEN CAST(value AS DECIMAL(18,2)) END AS ad_revenue",
        "CASE WHEN event_type = 'purchase' THEN concat('pack_', CAST(_k % 3 AS STRING)) END AS pack",
        "CASE WHEN event_type = 'signup' THEN concat('place_', CAST(_k % 4 AS STRING)) END AS placement",
        "CASE WHEN event_type = 'view' THEN value END AS duration",
    )


def user_acquisition_from_driver(master: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per player: first active date as install date, customer
    segment as source, nation as tier, balance as CPI (organic = 0)."""
    players = master.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.min("event_date").alias("install_date")
    )
    seg = F.col("c_mktsegment")
    cust = customer.select(
        F.col("c_custkey").alias("user_id"),
        seg.alias("source"),
        F.when(seg != ORGANIC_SEGMENT, F.concat(F.lit("CMP_"), (F.col("c_nationkey") % 6 + 100).cast("string"))).alias(
            "campaign_id"
        ),
        F.when(seg == ORGANIC_SEGMENT, F.lit(0).cast("decimal(18,2)"))
        .otherwise((F.abs(F.col("c_acctbal")) / 5000).cast("decimal(18,2)"))
        .alias("cpi"),
        F.concat(F.lit("Tier "), (F.col("c_nationkey") % 3 + 1).cast("string")).alias("tier"),
    )
    return players.join(cust, "user_id", "inner").select(
        "user_id", "install_date", "source", "campaign_id", "cpi", "tier"
    )


def iap_transactions_from_master(master: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Purchase rows in the IAP table's shape (``keep``: extra columns such
    as the user tags of the staged tagged events)."""
    return master.where(F.col("event_name") == IAP_PURCHASE).select(
        "user_id", F.col("event_ts").alias("timestamp"), F.col("revenue").alias("price"), "pack", *keep
    )


def ad_impressions_from_master(master: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Ad reward rows in the ad-impressions table's shape."""
    return master.where(F.col("event_name") == AD_REWARD_CLAIM).select(
        "user_id", F.col("event_ts").alias("timestamp"), F.col("ad_revenue").alias("revenue"), "placement", *keep
    )


# Param keys used when the driver events are packed into the nested log.
RAW_PARAM_KEYS = {
    "level_id": "level_id",
    "status": "win_loss_status",
    "gold_earned": "gold_earned",
    "gold_reward": "gold_reward",
    "price": "revenue",
    "ad_revenue": "ad_revenue",
    "product_id": "pack",
    "placement": "placement",
    "duration": "duration",
}


def raw_events_from_master(master: DataFrame) -> DataFrame:
    """Pack a typed event table back into the nested log shape (the
    ``raw_events`` schema), as a JSON writer of the source would."""
    return master.select(
        format_yyyymmdd("event_date").alias("event_date"),
        F.unix_micros("event_ts").alias("event_timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("user_pseudo_id").cast("string").alias("user_pseudo_id"),
        F.struct(F.lit(None).cast("string").alias("country"), F.lit(None).cast("string").alias("city")).alias("geo"),
        F.struct(F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("mobile_os")).alias(
            "device"
        ),
        F.col("event_name"),
        to_event_params(master, RAW_PARAM_KEYS).alias("event_params"),
        F.col("event_id"),
    )


MASTER_EVENTS_DDL = (
    "event_id BIGINT, user_id BIGINT, user_pseudo_id BIGINT, event_date DATE, event_ts TIMESTAMP, "
    "event_name STRING, level_id BIGINT, win_loss_status STRING, gold_earned BIGINT, gold_reward BIGINT, "
    "revenue DECIMAL(18,2), ad_revenue DECIMAL(18,2), pack STRING, placement STRING, duration DOUBLE"
)
ACQUIRED_EVENTS_DDL = MASTER_EVENTS_DDL + ", tier STRING, install_date DATE, in_ua BOOLEAN"
USER_ACQUISITION_DDL = (
    "user_id BIGINT, install_date DATE, source STRING, campaign_id STRING, cpi DECIMAL(18,2), tier STRING"
)


class DriverTables:
    """Lazy accessors over one scale-factor folder. Each DataFrame (a plan,
    not data) is built once per instance, so a query that needs the event
    table several times shares one subtree, and Spark can reuse its
    exchanges."""

    def __init__(self, spark: SparkSession, sf_dir: str, staged: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.staged = staged
        self._memo: dict[str, DataFrame] = {}

    def _path(self, name: str) -> str:
        return f"{self.sf_dir.rstrip('/')}/{name}.parquet"

    def _get(self, name: str, build) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    def events(self) -> DataFrame:
        return self._get("events", lambda: read_table(self.spark, self.sf_dir, "events"))

    def customer(self) -> DataFrame:
        return self._get("customer", lambda: read_table(self.spark, self.sf_dir, "customer"))

    def master_events_live(self) -> DataFrame:
        """The mapping computed from ``events`` on the fly (no stored table)."""
        return self._get("master_events_live", lambda: master_events_from_driver(self.events()))

    def master_events(self) -> DataFrame:
        """The typed events: the stored table without its user tags (a scan
        reads only the columns asked for), or the live mapping when ``staged`` is off."""
        if not self.staged:
            return self.master_events_live()
        return self._get("master_events", lambda: self.acquired_events().select(*MASTER_EVENTS_COLUMNS))

    def user_acquisition_live(self) -> DataFrame:
        return user_acquisition_from_driver(self.master_events_live(), self.customer())

    def user_acquisition(self) -> DataFrame:
        """One row per player (staged, sorted by user), or computed on the fly
        when ``staged`` is off."""
        if not self.staged:
            return self._get("ua", self.user_acquisition_live)
        return self._get("ua", lambda: self.spark.read.schema(USER_ACQUISITION_DDL).parquet(self.user_acquisition_place()))

    def user_acquisition_place(self) -> str:
        """The folder of the staged acquisition table."""
        return staged_place(
            self.spark,
            "user_acquisition",
            [self._path("events"), self._path("customer")],
            self.user_acquisition_live,
            sort_within=("user_id",),
            schema=USER_ACQUISITION_DDL,
            fixed=True,
        )

    def acquired_events_live(self) -> DataFrame:
        """Every event tagged with its user's tier,
        install date and whether the user is in the acquisition table: a left
        join on user, one row per user on the right (the acquisition aggregate
        and the customer key guarantee it), so no event is duplicated or lost. Events without a user are kept out of the join."""
        users = self.user_acquisition().where(F.col("user_id").isNotNull()).select(
            "user_id", "tier", "install_date", F.lit(True).alias("_in")
        )
        me = self.master_events_live()
        tagged = me.where(F.col("user_id").isNotNull()).join(users, "user_id", "left")
        tagged = tagged.select(*me.columns, "tier", "install_date", F.coalesce(F.col("_in"), F.lit(False)).alias("in_ua"))
        no_user = me.where(F.col("user_id").isNull()).select(
            *me.columns, F.lit(None).cast("string").alias("tier"), F.lit(None).cast("date").alias("install_date"), F.lit(False).alias("in_ua")
        )
        return tagged.unionByName(no_user)

    def acquired_events(self) -> DataFrame:
        """``acquired_events_live`` staged, partitioned by day and sorted by
        event name within one: the one stored fact table. The dashboard marts
        read it with a pushed-down ``in_ua`` / ``tier`` filter instead of
        joining every event to the user table per query."""
        if not self.staged:
            return self._get("acquired", self.acquired_events_live)
        return self._get("acquired", lambda: self.spark.read.schema(ACQUIRED_EVENTS_DDL).parquet(self.acquired_events_place()))

    def acquired_events_place(self) -> str:
        """The folder of the staged fact table, by ``event_date``."""
        return staged_place(
            self.spark,
            "tagged_events",
            [self._path("events"), self._path("customer")],
            self.acquired_events_live,
            partition_by=("event_date",),
            sort_within=("event_name", "user_id"),
            schema=ACQUIRED_EVENTS_DDL,
            fixed=True,
        )

    def iap(self) -> DataFrame:
        return self._get("iap", lambda: iap_transactions_from_master(self.master_events()))

    def ads(self) -> DataFrame:
        return self._get("ads", lambda: ad_impressions_from_master(self.master_events()))

    def raw_events(self) -> DataFrame:
        return self._get("raw", lambda: raw_events_from_master(self.master_events()))
