"""Every registered query of the layers against its SQL in another engine; tests/llm has the others."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from stratalake.checks.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
SMALL, MEDIUM = Path("/root/testdata/sf0.001"), Path("/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def other_engine():
    connection = duckdb.connect()
    for file in SMALL.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_each_query_has_sql():
    assert set(QUERIES) <= set(entry_points.queries()) and set(QUERIES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, other_engine, name):
    df = entry_points.queries()[name](spark, str(SMALL))
    columns = sorted(df.columns)
    expected = other_engine.sql(entry_points.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    want = expected.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    got = [tuple(r) for r in df.select(columns).collect()]
    assert len(got) > 0
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_entry_totals(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 331 and sum(r.payment_type is None for r in rows) == 82
    assert round(sum(r.total_amount_collected for r in rows), 2) == 276187551.71


@pytest.mark.parametrize(
    ("name", "rows"),
    [
        ("valid_dates_filter", 56445),
        ("dedup_deterministic", 53299),
        ("silver_clean", 50463),
        ("merge_key_conflicts", 2836),
        ("silver_upsert", 50463),
        ("gold_upsert", 415),
        ("gold_upsert_nullsafe", 332),
    ],
)
def test_known_counts(spark, name, rows):
    assert entry_points.queries()[name](spark, str(MEDIUM)).count() == rows
