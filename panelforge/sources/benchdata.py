"""The benchmark tables seen as panel data.

Money amounts become whole cents, held as doubles: sums of whole numbers are
exact in any order, so results do not depend on how Spark splits the rows.
Parquet times come without a zone and are read as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.config import PLACES
from panelforge.operators.flows import net_flow
from panelforge.operators.joins import align
from panelforge.operators.resample import resample_mean
from panelforge.sources.tables import local_rows

KEYS = ["country", "index"]


# Declared, so that opening a table starts no job to infer its schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf.rstrip('/')}/{name}.parquet")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100)


def utc(column: str) -> Column:
    return F.col(column).cast("timestamp")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Raw sub-hour readings: the event type is the entity."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("country"),
        utc("ts").alias("index"),
        cents("value").alias("Actual_Load"),
        "event_id",
        "user_id",
    )


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    return resample_mean(readings(spark, sf), ["country"], values=["Actual_Load"])


def sparse_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Raw readings per user; the value is known for purchases only."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("country"),
        utc("ts").alias("index"),
        "event_id",
        F.when(F.col("event_type") == "purchase", cents("value")).alias("value"),
    )


def _with_nation(spark: SparkSession, sf: str, name: str, key: str, nation: str, out: str):
    """(key, nation name) of customers or suppliers: the small tables are joined
    first, so that a fact table needs one join."""
    nations = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias(nation), F.col("n_name").alias(out)
    )
    return table(spark, sf, name).select(key, nation).join(nations, nation).select(key, out)


def load_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by the customer's nation: the load, and its forecast for orders of
    the three leading priorities."""
    customers = _with_nation(spark, sf, "customer", "c_custkey", "c_nationkey", "country")
    ahead = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    return (
        table(spark, sf, "orders")
        .withColumnRenamed("o_custkey", "c_custkey")
        .join(customers, "c_custkey")
        .select(
            "country",
            utc("o_orderdate").alias("index"),
            cents("o_totalprice").alias("Actual_Load"),
            F.when(ahead, cents("o_totalprice")).alias("Forecasted_Load"),
        )
    )


def _monthly(rows: DataFrame, keys: list[str], *values: str, unit: str = "month") -> DataFrame:
    """Means by month (or ``unit``) in whole cents, so that sums of them stay exact too."""
    means = resample_mean(rows, keys, unit=unit, values=values)
    return means.withColumns({c: F.round(c) for c in values})


def load(spark: SparkSession, sf: str) -> DataFrame:
    return _monthly(load_readings(spark, sf), ["country"], "Actual_Load")


def forecast(spark: SparkSession, sf: str) -> DataFrame:
    rows = load_readings(spark, sf).filter(F.col("Forecasted_Load").isNotNull())
    return _monthly(rows, ["country"], "Forecasted_Load")


def load_and_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Both in one pass; periods without a forecast drop out, as in the join."""
    both = _monthly(load_readings(spark, sf), ["country"], "Actual_Load", "Forecasted_Load")
    return both.filter(F.col("Forecasted_Load").isNotNull())


def flow_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as flows from the supplier's to the customer's nation. Orders meet their
    customers first, so that the line items are shuffled once."""
    suppliers = _with_nation(spark, sf, "supplier", "s_suppkey", "s_nationkey", "from_country")
    customers = _with_nation(spark, sf, "customer", "c_custkey", "c_nationkey", "to_country")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")
    ).join(customers, "c_custkey").select("l_orderkey", "to_country")
    return (
        table(spark, sf, "lineitem")
        .select("l_orderkey", F.col("l_suppkey").alias("s_suppkey"), "l_shipdate", "l_extendedprice")
        .join(suppliers, "s_suppkey")
        .join(orders, "l_orderkey")
        .select(
            "from_country",
            "to_country",
            utc("l_shipdate").alias("index"),
            cents("l_extendedprice").alias("Value"),
        )
    )


def flow(spark: SparkSession, sf: str) -> DataFrame:
    return _monthly(flow_readings(spark, sf), ["from_country", "to_country"], "Value")


def supply_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Line items by the supplier's nation, with one column per measured series."""
    suppliers = _with_nation(spark, sf, "supplier", "s_suppkey", "s_nationkey", "country")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    size = F.col("p_size")
    return (
        table(spark, sf, "lineitem")
        .withColumnRenamed("l_suppkey", "s_suppkey")
        .join(suppliers, "s_suppkey")
        .join(parts, "l_partkey")
        .select(
            "country",
            utc("l_shipdate").alias("index"),
            cents("l_extendedprice").alias("price"),
            "l_quantity",
            cents("l_discount").alias("discount"),
            cents("l_tax").alias("tax"),
            F.when(size == 1, cents("l_extendedprice")).alias("nuclear"),
            F.when(size == 2, cents("l_extendedprice")).alias("solar"),
            F.when(size <= 10, F.col("l_quantity")).alias("biomass"),
        )
    )


GENERATION = {
    "Nuclear__Actual_Aggregated": "round(avg(nuclear))",
    "Solar__Actual_Aggregated": "round(avg(solar))",
    "Biomass__Actual_Consumption": "round(avg(biomass) * 100) / 100",
    "Marine__Actual_Aggregated": "CAST(NULL AS DOUBLE)",
}
WEATHER = {
    "mean_ssrd": "round(avg(price)) / 10000.0D",
    "mean_wind_speed": "avg(l_quantity) / 5.0D",
    "mean_temperature_c": "avg(discount) * 4.0D - 18.0D",
}
RENEWABLES = {"solar_forecast": "avg(tax)", "wind_forecast": "avg(discount)"}


def _supply(spark: SparkSession, sf: str, series: dict[str, str]) -> DataFrame:
    return _supply_means(supply_readings(spark, sf), series, "month")


def _supply_means(rows: DataFrame, series: dict[str, str], unit: str) -> DataFrame:
    return rows.groupBy("country", F.date_trunc(unit, "index").alias("index")).agg(
        *[F.expr(text).alias(n) for n, text in series.items()]
    )


def supply(spark: SparkSession, sf: str) -> DataFrame:
    """All supply series in one pass over the line items."""
    return _supply(spark, sf, {**WEATHER, **RENEWABLES, **GENERATION})


def generation(spark: SparkSession, sf: str) -> DataFrame:
    return _supply(spark, sf, GENERATION)


def weather(spark: SparkSession, sf: str) -> DataFrame:
    return _supply(spark, sf, WEATHER)


def renewables(spark: SparkSession, sf: str) -> DataFrame:
    return _supply(spark, sf, RENEWABLES)


def net(spark: SparkSession, sf: str) -> DataFrame:
    return net_flow(flow(spark, sf))



def panel(spark: SparkSession, sf: str, with_supply: bool = True) -> DataFrame:
    """The joined panel. Series from the same readings come from one pass."""
    frames = [load_and_forecast(spark, sf), net(spark, sf)]
    if with_supply:
        frames.append(supply(spark, sf))
    return align(frames, KEYS)


# ---- the same panel by hour, from the event stream ------------------------------
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def hour_load(spark: SparkSession, sf: str) -> DataFrame:
    """Load and forecast by event type and hour; users with odd ids are the forecast."""
    events = table(spark, sf, "events")
    rows = events.select(
        F.col("event_type").alias("country"), utc("ts").alias("index"), cents("value").alias("Actual_Load"),
        F.when(F.col("user_id") % 2 == 1, cents("value")).alias("Forecasted_Load"),
    )
    both = _monthly(rows, ["country"], "Actual_Load", "Forecasted_Load", unit="hour")
    return both.filter(F.col("Forecasted_Load").isNotNull())


def hour_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Flows from an event's type to the type that the user's id stands for."""
    to = F.element_at(F.lit(list(EVENT_TYPES)), (F.col("user_id") % len(EVENT_TYPES) + 1).cast("int"))
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("from_country"), to.alias("to_country"), utc("ts").alias("index"), cents("value").alias("Value")
    )
    return _monthly(rows.where("from_country <> to_country"), ["from_country", "to_country"], "Value", unit="hour")


def hour_supply(spark: SparkSession, sf: str) -> DataFrame:
    """Supply series by event type and hour, out of values and ids."""
    events, size = table(spark, sf, "events"), F.col("event_id") % 50 + 1
    price, quantity = cents("value"), (F.col("user_id") % 50).cast("double")
    rows = events.select(
        F.col("event_type").alias("country"), utc("ts").alias("index"), price.alias("price"), quantity.alias("l_quantity"),
        (F.col("event_id") % 11).cast("double").alias("discount"), (F.col("event_id") % 9).cast("double").alias("tax"),
        F.when(size == 1, price).alias("nuclear"), F.when(size == 2, price).alias("solar"), F.when(size <= 10, quantity).alias("biomass"),
    )
    return _supply_means(rows, {**WEATHER, **RENEWABLES, **GENERATION}, "hour")


def hour_panel(spark: SparkSession, sf: str, with_supply: bool = True) -> DataFrame:
    frames = [hour_load(spark, sf), net_flow(hour_flow(spark, sf))]
    return align([*frames, hour_supply(spark, sf)] if with_supply else frames, KEYS)


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as measuring points, with two measured values."""
    vector = F.col("embedding")
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        (F.lit(45.0) + vector[0].cast("double") * 20.0).alias("lat"),
        (F.lit(10.0) + vector[1].cast("double") * 20.0).alias("lon"),
        F.col("label").alias("slot"),
        vector[2].cast("double").alias("ssrd"),
        vector[3].cast("double").alias("wind_speed"),
        vector[4].cast("double").alias("temperature_c"),
    )


def places(spark: SparkSession) -> DataFrame:
    return local_rows(spark, PLACES, "place_id int, lat double, lon double, code string")


def grid_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Each embedding is one grid message: 8 x 8 values of one variable at one
    time. Variables rotate, so four vectors in a row share a time."""
    names = F.array(*[F.lit(v) for v in ("10u", "10v", "2t", "ssrd")])
    return table(spark, sf, "embeddings").select(
        F.timestamp_seconds(F.expr("(vec_id div 4) * 3600")).alias("timestamp"),
        F.element_at(names, (F.col("vec_id") % 4 + 1).cast("int")).alias("short_name"),
        F.transform("embedding", lambda x: x.cast("double")).alias("values"),
    )
