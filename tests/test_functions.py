import pytest
from pyspark.sql import functions as F

from stratalake import functions as X
from stratalake.operators import (
    rejected_trips,
    typed_trips,
    with_lineage,
    with_pickup_date,
    with_trip_period,
    with_valid_dates,
)

CASTS = {"1.5": 1, "1.0": 1, "abc": None, "": None, "3e10": None, "NaN": None, "-1.9": -1, None: None}
STAMPS = {
    "2020-01-01 00:10:00": "2020-01-01 00:10:00",
    "2020-01-01": "2020-01-01 00:00:00",
    "2020-13-01 00:00:00": None,
    "01/02/2020 10:00:00": None,
    "garbage": None,
    "": None,
    None: None,
}


@pytest.fixture(autouse=True)
def ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_bad_numbers_become_null(spark):
    df = spark.createDataFrame([(x,) for x in CASTS], "x string")
    assert {r.x: r.i for r in df.select("x", X.to_int("x").alias("i")).collect()} == CASTS


@pytest.mark.parametrize("value", [3e10, float("nan")])
def test_double_out_of_int_range_is_null(spark, value):
    assert spark.createDataFrame([(value,)], "x double").select(X.to_int("x")).first()[0] is None


def test_timestamps(spark):
    df = spark.createDataFrame([(x,) for x in STAMPS], "x string")
    got = df.select("x", F.date_format(X.parse_timestamp("x"), "yyyy-MM-dd HH:mm:ss").alias("t")).collect()
    assert {r.x: r.t for r in got} == STAMPS


def test_timestamps_accept_typed_input(spark):
    df = spark.sql("SELECT timestamp'2020-01-01 01:02:03' AS t")
    row = df.select(X.parse_timestamp("t").alias("a"), X.parse_date("t").cast("string").alias("b")).first()
    assert str(row.a) == "2020-01-01 01:02:03" and row.b == "2020-01-01"


def test_amount_keeps_ten_places_and_has_no_nan(spark):
    df = spark.createDataFrame([(10.305,), (float("nan"),), (1e30,)], "x double")
    assert [None if v[0] is None else str(v[0]) for v in df.select(X.exact_amount("x")).collect()] == ["10.3050000000", None, None]


def trips(spark, pairs):
    rows = [(1, p, d, "2.0", "3.5", "cash", 1.0) for p, d in pairs]
    return spark.createDataFrame(
        rows,
        "vendorid bigint, tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count string, "
        "trip_distance string, payment_type string, total_amount double",
    )


def test_valid_and_rejected_split_all_rows(spark):
    good, bad = "2020-01-01 00:00:00", "bad"
    df = trips(spark, [(good, good), (bad, good), (good, bad), (bad, None)])
    assert with_valid_dates(typed_trips(df)).count() == 1
    reasons = sorted(r.reject_reason for r in rejected_trips(df).collect())
    assert reasons == ["dropoff not a timestamp", "pickup and dropoff not a timestamp", "pickup not a timestamp"]


def test_types_and_period(spark):
    row = with_trip_period(typed_trips(trips(spark, [("2020-02-03 23:59:59", "2020-02-04")]))).first()
    assert (row.passenger_count, row.trip_distance) == (2, 3.5)
    assert (row.ingestion_date, row.year, row.month) == ("2020-02-03", 2020, 2)


def test_pickup_date_of_unparsable_text_is_null(spark):
    row = with_pickup_date(trips(spark, [("bad", "bad")])).first()
    assert (row.pickup_date, row.year, row.month) == (None, None, None)


def test_lineage_names_the_file(spark, tmp_path):
    (tmp_path / "a file.csv").write_text("x\n1\n2\n")
    rows = with_lineage(spark.read.option("header", True).csv(str(tmp_path))).collect()
    assert {r.source_file.rsplit("/", 1)[1] for r in rows} == {"a%20file.csv"}
    assert all(len(r.ingestion_timestamp) == 19 for r in rows)


def test_filter_reaches_the_scan(spark, tmp_path, plan_of):
    trips(spark, [("2020-01-01", "2020-01-02")]).write.parquet(str(tmp_path / "t"))
    plan = plan_of(with_valid_dates(typed_trips(spark.read.parquet(str(tmp_path / "t")))))
    assert "IsNotNull(tpep_pickup_datetime)" in plan and "IsNotNull(tpep_dropoff_datetime)" in plan
    assert "Python" not in plan
