import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from stratalake.sources import (
    in_partitions,
    path_exists,
    read_delimited,
    read_layer,
    remove,
    schema_from_header,
    table_exists,
)

HEADER = "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,payment_type,total_amount,extra"
LINE = '1,2020-01-01 00:00:00,2020-01-01 00:10:00,1.0,2.5,"a,b",9.5,007'


def write(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def test_header_schema_lowers_names_and_keeps_extra_columns(spark, tmp_path):
    path = write(tmp_path, "a b.csv", HEADER, LINE, LINE, LINE.replace("1,", ",", 1))
    df = read_delimited(spark, path)
    assert df.columns[0] == "vendorid" and df.schema["vendorid"].dataType == T.LongType()
    rows = df.collect()
    assert len(rows) == 3 and rows[0].payment_type == "a,b" and rows[0].extra == "007"
    assert sorted(r.vendorid is None for r in rows) == [False, False, True]


def test_value_that_does_not_fit_is_null(spark, tmp_path):
    path = write(tmp_path, "a.csv", HEADER, LINE.replace("9.5", "oops"))
    assert read_delimited(spark, path).first().total_amount is None


def test_inference_is_available(spark, tmp_path):
    path = write(tmp_path, "a.csv", HEADER, LINE)
    schema = read_delimited(spark, path, infer_schema=True).schema
    assert schema["tpep_pickup_datetime"].dataType == T.TimestampType()
    assert schema["vendorid"].dataType == T.IntegerType()


def test_other_column_order_fails_instead_of_mixing_columns(spark, tmp_path):
    write(tmp_path, "a.csv", "a,b", "1,2")
    path = write(tmp_path, "b.csv", "b,a", "2,1")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    with pytest.raises(Exception, match="header"):
        read_delimited(spark, path, schema).collect()


def test_names_that_differ_only_in_case_are_refused(spark, tmp_path):
    path = write(tmp_path, "a.csv", "x,X", "1,2")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="case"):
            schema_from_header(spark, path)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_several_folders_and_header_only_file(spark, tmp_path):
    one = write(tmp_path / "one", "a.csv", HEADER, LINE)
    two = write(tmp_path / "two", "a.csv", HEADER)
    assert read_delimited(spark, [one, two]).count() == 1


def test_table_exists(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    spark.range(0).write.partitionBy().parquet(path + "/.pending/rows")
    assert not table_exists(spark, path)
    spark.range(1).write.mode("append").parquet(path)
    assert table_exists(spark, path)
    remove(spark, path)
    assert not path_exists(spark, path)


def test_failing_existence_check_raises(spark):
    with pytest.raises(Exception):
        table_exists(spark, "nosuchscheme://host/table")


def test_partition_filter_prunes_folders(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [(1, 2020, 1), (2, 2020, 2), (3, 2021, 1), (4, None, None)], "k int, year int, month int"
    )
    df.write.partitionBy("year", "month").parquet(path)
    table = read_layer(spark, path, ("year", "month"))
    some = [Row(year=2020, month=2), Row(year=None, month=None)]
    found = table.filter(in_partitions(some, ("year", "month")))
    assert sorted(r.k for r in found.collect()) == [2, 4]
    assert len(found.inputFiles()) == 4  # files before pruning; the plan does it
    plan = plan_of(found)
    assert "PartitionFilters: [(" in plan and "DataFilters: []" in plan
    assert table.filter(in_partitions([], ("year", "month"))).count() == 0


def test_filter_over_thousands_of_partitions(spark):
    many = [Row(year=y, month=m) for y in range(1000) for m in range(12)]
    df = spark.createDataFrame([(5, 3), (5, 13)], "year int, month int")
    assert df.filter(in_partitions(many, ("year", "month"))).count() == 1


def test_only_null_partitions_still_read_as_int(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, None, None)], "k int, year int, month int").write.partitionBy("year", "month").parquet(path)
    table = read_layer(spark, path, ("year", "month"))
    assert dict(table.dtypes) == {"k": "int", "year": "int", "month": "int"}
    assert table.first().year is None


def test_a_folder_without_files_gives_no_rows_of_the_declared_schema(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    rows = read_delimited(spark, str(tmp_path / "empty"))
    assert rows.count() == 0 and "vendorid" in rows.columns
    assert read_delimited(spark, str(tmp_path / "empty"), infer_schema=True).count() == 0
