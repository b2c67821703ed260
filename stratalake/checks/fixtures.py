"""Trips derived from ``lineitem``, with bad values put in by arithmetic on the order key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.config import TRIP_SCHEMA

# The total order that decides which duplicate survives, and the two file labels.
SURVIVOR_ORDER = ("total_amount", "l_orderkey", "l_partkey", "l_linenumber", "trip_distance")
LABELS = ("F", "O")

RAW_SCHEMA = T.StructType(
    TRIP_SCHEMA.fields
    + [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
    ]
)

_TRIPS = """
    SELECT l_suppkey AS vendorid,
           CASE WHEN l_orderkey % 17 = 0 THEN 'bad'
                ELSE date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') END AS tpep_pickup_datetime,
           date_format(l_shipdate + INTERVAL 1 DAY, 'yyyy-MM-dd HH:mm:ss') AS tpep_dropoff_datetime,
           CASE WHEN l_orderkey % 13 = 0 THEN 'x'
                ELSE concat(cast(l_linenumber AS string), '.0') END AS passenger_count,
           cast(l_quantity AS string) AS trip_distance,
           CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_returnflag END AS payment_type,
           l_extendedprice AS total_amount,
           l_linestatus AS source_file,
           l_orderkey, l_partkey, l_linenumber
    FROM {lineitem}
"""


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``lineitem`` as raw trips. Pins the session to UTC, on which the texts depend."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return spark.sql(_TRIPS, lineitem=lineitem)


def write_dropzone(trips: DataFrame, path: str, labels: tuple[str, ...] = LABELS) -> list[str]:
    """Write the trips of each label as delimited files below a folder of that name."""
    folders = []
    for label in labels:
        folder = f"{path}/{label}"
        part = trips.filter(F.col("source_file") == label).select(RAW_SCHEMA.names)
        part.write.mode("append").option("header", "true").csv(folder)
        folders.append(folder)
    return folders


# What is wrong with the records of long trips, by line number.
DAMAGE = {4: "amount", 5: "id", 6: "short", 7: "long"}


def write_damaged_dropzone(trips: DataFrame, path: str) -> str:
    """All trips as delimited text, in which some records have a bad amount or id, a value less or a value more."""
    wrong = F.when(F.col("trip_distance").cast("double") == 50, F.col("l_linenumber"))
    fields = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in RAW_SCHEMA.names}
    fields["total_amount"] = F.when(wrong == 4, F.lit("n/a")).otherwise(fields["total_amount"])
    fields["vendorid"] = F.when(wrong == 5, F.concat(F.lit("x"), fields["vendorid"])).otherwise(fields["vendorid"])
    whole = F.concat_ws(",", *fields.values())
    short = F.concat_ws(",", *list(fields.values())[:-1])
    line = F.when(wrong == 6, short).when(wrong == 7, F.concat(whole, F.lit(",more"))).otherwise(whole)
    # the first line of each file goes behind a header
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.lit(",".join(fields) + "\n")
    trips.select(F.when(first, F.concat(header, line)).otherwise(line).alias("value")).write.text(path)
    return path


def label_of(path_column: str = "source_file"):
    """The label folder a row's file lies in."""
    return F.regexp_extract(path_column, "/([^/]+)/[^/]+$", 1)
