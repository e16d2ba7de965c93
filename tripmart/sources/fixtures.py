"""Raw trips and zones derived from the TPC-H-style test tables.

One trip per ``lineitem`` row and one zone per ``nation`` row, following
the mapping written down in FIXTURES.md (section 3).  The mapping is a
narrow projection: it scales with ``lineitem`` and adds no shuffle.
The landing month (``year``/``month``) is the ship month, i.e. the
"file" a trip arrives in; a trip picked up after midnight of the month's
last day therefore lands in one month and is curated into the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import RAW_LANDED, ZONE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def plus_seconds(ts: Column, n: Column) -> Column:
    """``ts`` (an instant) moved by ``n`` seconds, in plain long arithmetic."""
    return F.timestamp_seconds(F.unix_seconds(ts) + n)


def spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer splits than the cluster has cores.

    A test table stored as one parquet row group is read by one task; the
    per-row curation that follows would then use one core.  Only in that
    case are the rows dealt round-robin over the cores; a real input (many
    files or row groups) is left as scanned, with no shuffle.
    """
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip records with landing partition columns ``year``, ``month``."""
    li = spread(spark, table(spark, sf_dir, "lineitem"))
    okey, pkey, skey = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line = F.col("l_linenumber")
    # Ship dates are wall-clock (timestamp_ntz); read them as UTC instants.
    ship = F.col("l_shipdate").cast("timestamp")

    pk = plus_seconds(ship, (okey * 7919 + line * 104729) % 86400)
    tt = F.when(okey % 41 == 0, F.lit(0)).otherwise(F.col("l_quantity") * 61 + line * 7).cast("bigint")
    base = F.concat(F.lit("B"), skey.cast("string"))

    def null_when(cond: Column, value: Column) -> Column:
        return F.when(~cond, value)

    license_ = (
        F.when(pkey % 40 == 0, F.lit("HV0001"))
        .when(pkey % 40 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("HV000"), (F.lit(2) + pkey % 4).cast("string")))
    )
    request = (
        F.when(okey % 47 == 0, F.lit(None).cast("timestamp"))
        .when(okey % 53 == 0, plus_seconds(pk, F.lit(30)))
        .when(okey % 59 == 0, pk)
        .otherwise(plus_seconds(pk, -(F.lit(1) + okey % 600)))
    )
    miles = (
        F.when(pkey % 29 == 0, F.lit(None).cast("double"))
        .when(okey % 79 == 0, F.lit(-1.5))
        .when(okey % 83 == 0, F.lit(500.004))
        .when(okey % 89 == 0, F.lit(500.01))
        .otherwise(pkey / F.lit(64.0))
    )
    fare = (
        F.when(okey % 97 == 0, F.lit(None).cast("double"))
        .when(okey % 101 == 0, -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice") / F.lit(10.0))
    )
    airport = (
        F.when(pkey % 10 == 0, F.lit(2.5))
        .when(pkey % 10 == 1, F.lit(None).cast("double"))
        .otherwise(F.lit(0.0))
    )
    rflag, lstatus = F.col("l_returnflag"), F.col("l_linestatus")
    yn = lambda cond: F.when(cond, F.lit("Y")).otherwise(F.lit("N"))

    out = li.select(
        license_.alias("hvfhs_license_num"),
        base.alias("dispatching_base_num"),
        null_when(skey % 3 == 0, base).alias("originating_base_num"),
        request.alias("request_datetime"),
        null_when(skey % 4 == 0, plus_seconds(pk, -(okey % 60))).alias("on_scene_datetime"),
        null_when(okey % 61 == 0, pk).alias("pickup_datetime"),
        null_when(okey % 67 == 0, plus_seconds(pk, tt)).alias("dropoff_datetime"),
        null_when(pkey % 71 == 0, skey % 27).cast("int").alias("PULocationID"),
        null_when(pkey % 73 == 0, pkey % 26).cast("int").alias("DOLocationID"),
        miles.alias("trip_miles"),
        tt.alias("trip_time"),
        fare.alias("base_passenger_fare"),
        null_when(line == 1, F.col("l_tax") * 100).alias("tolls"),
        F.col("l_tax").alias("bcf"),
        (F.col("l_tax") * 3).alias("sales_tax"),
        F.when(pkey % 2 == 0, F.lit(2.75)).otherwise(F.lit(0.0)).alias("congestion_surcharge"),
        airport.alias("airport_fee"),
        (F.col("l_discount") * 10).alias("tips"),
        (F.col("l_extendedprice") * F.lit(0.07)).alias("driver_pay"),
        F.when(rflag == "A", F.lit("Y")).when(rflag == "N", F.lit("N")).alias("shared_request_flag"),
        yn((rflag == "A") & (lstatus == "F")).alias("shared_match_flag"),
        F.lit(" ").alias("access_a_ride_flag"),
        yn(lstatus == "O").alias("wav_request_flag"),
        F.when((lstatus == "O") & (pkey % 3 == 0), F.lit("Y"))
        .when(pkey % 3 == 1, F.lit("y"))
        .otherwise(F.lit("N"))
        .alias("wav_match_flag"),
        F.year(ship).alias("year"),
        F.month(ship).alias("month"),
    )
    # Raw timestamps are stored as instants; the source wall clock is UTC.
    return out.select(
        *[
            F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in RAW_LANDED.fields
        ]
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: one zone per nation, borough = its region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    service = (
        F.when(key % 3 == 0, F.lit("Yellow Zone"))
        .when(key % 3 == 1, F.lit("Boro Zone"))
        .otherwise(F.lit("Airports"))
    )
    out = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        key.alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        service.alias("service_zone"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ZONE.fields])
