"""Exact sums of any doubles, and Gold kept up to date by adding and taking away."""

import math
import random
import struct
from collections import defaultdict
from dataclasses import replace
from fractions import Fraction

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalake.config import Layer, PipelineConfig, standard_layers
from stratalake.functions.exact_sum import bin_of, in_units, total_of
from stratalake.operators import Changes, monthly_summary
from stratalake.operators.summary import add_parts, summary_of_parts, summary_parts
from stratalake.plans import gold as gold_plan
from stratalake.plans import refresh_gold, run_all, run_gold
from stratalake.sinks import pending, upsert_table, write_partitioned
from stratalake.sources import read_layer
from stratalake.streaming import ingest_new_files, refresh_from_new_rows

SCHEMA = "year int, month int, payment_type string, total_amount double"


def bits(x):
    return None if x is None else "nan" if x != x else struct.pack(">d", x)


def rounded(values):
    exact = sum(map(Fraction, values))
    try:
        return exact.numerator / exact.denominator
    except OverflowError:
        return math.inf if exact > 0 else -math.inf


def amounts(seed):
    rng = random.Random(seed)
    kinds = {
        "cents": lambda: round(rng.uniform(0, 1e5), 2),
        "thirds": lambda: rng.uniform(-1, 1) / 3,
        "small": lambda: rng.choice([5e-324, -5e-324, 1e-322, 1e-310, -3e-309]),
        "large": lambda: rng.choice([-1, 1]) * rng.uniform(1e299, 1e300),
        "zeros": lambda: rng.choice([0.0, -0.0]),
        "whole": lambda: rng.randrange(10**15, 10**20) * 1.0,
        "overflowing": lambda: rng.uniform(1e307, 1.7e308),
    }
    return {k: [f() for _ in range(rng.randrange(2, 90))] for k, f in kinds.items()}


@pytest.mark.parametrize("seed", range(3))
def test_binary_sums_are_rounded_once(spark, seed):
    groups = amounts(seed)
    df = spark.createDataFrame([(2020, 1, k, x) for k, values in groups.items() for x in values], SCHEMA).repartition(6)
    got = {r.payment_type: r.total_amount_collected for r in monthly_summary(df, exact="binary").collect()}
    assert {k: x + 0.0 for k, x in got.items()} == {k: rounded(v) for k, v in groups.items()}


def test_every_power_of_two_is_a_whole_number_of_units(spark):
    powers = [(s * math.ldexp(m, e),) for e in range(-1073, 1024) for m in (0.5, 0.75, 1 - 2**-53) for s in (1, -1)]
    df = spark.createDataFrame(powers, "x double").withColumn("u", F.expr(bin_of("x"))).withColumn("n", F.expr(in_units("x", "u")))
    for r in df.collect():
        assert Fraction(r.x) == int(r.n) * Fraction(2) ** r.u and abs(r.n) < 2**62


@pytest.mark.parametrize("exact", [True, "binary"])
def test_no_order_of_the_rows_changes_a_bit(spark, exact):
    rng = random.Random(9)
    rows = []
    for g in "abcd":
        for _ in range(400):
            x = rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) if g != "a" else rng.uniform(0, 1e17)
            rows.append((2020, 1, g, x))
    seen = set()
    for n in (1, 3, 8, 17):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA).repartition(n)
        seen.add(tuple(sorted((r[2], bits(r[4])) for r in monthly_summary(df, exact).collect())))
    assert len(seen) == 1


def test_large_amounts_cancel(spark):
    rows = [(2020, 1, "x", v) for v in (1e300, 1.0, -1e300, 0.25)]
    assert monthly_summary(spark.createDataFrame(rows, SCHEMA)).first().total_amount_collected == 1.25


@pytest.mark.parametrize("exact", [True, "binary"])
def test_amounts_that_are_not_finite(spark, exact):
    nan, inf = float("nan"), float("inf")
    groups = {"n": [1.0, nan], "p": [inf, 2.0], "m": [-inf, None], "b": [inf, -inf], "none": [None, None], "z": [0.0]}
    df = spark.createDataFrame([(2020, 1, k, x) for k, v in groups.items() for x in v], SCHEMA)
    got = {r.payment_type: (r.total_trips, bits(r.total_amount_collected)) for r in monthly_summary(df, exact).collect()}
    want = {"n": (2, nan), "p": (2, inf), "m": (2, -inf), "b": (2, nan), "none": (2, None), "z": (1, 0.0)}
    assert got == {k: (n, bits(x)) for k, (n, x) in want.items()}


def test_total_of_far_apart_bins_is_added_smallest_first(spark):
    one = "named_struct('unit', {}, 'units', cast({} AS decimal(38,0)))".format
    bins = f"array({one(-1000, 3)}, {one(0, 5)}, {one(800, 1)})"
    assert spark.range(1).select(F.expr(total_of(bins))).first()[0] == 2.0**800
    rng = random.Random(2)
    values = [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(500)]
    df = spark.createDataFrame([(2020, 1, "x", v) for v in values], SCHEMA)
    assert math.isclose(monthly_summary(df).first().total_amount_collected, rounded(values), rel_tol=1e-15)


@pytest.mark.parametrize("binary", [False, True])
def test_parts_taken_away_leave_no_trace(spark, binary):
    rng = random.Random(4)
    kinds = [lambda: round(rng.uniform(0, 99), 2), lambda: rng.choice([None, math.nan, math.inf, 1e300, 7e16, 1e-320])]
    row = lambda: (2020, rng.randrange(1, 3), rng.choice([None, "a", "b"]), rng.choice(kinds)())
    stay, go = [row() for _ in range(60)], [row() for _ in range(60)]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    came = summary_parts(frame(stay + go), binary)
    gone = summary_parts(frame(go), binary, "-1")
    left = add_parts(came.unionByName(gone))
    want = summary_of_parts(summary_parts(frame(stay), binary))
    plain = lambda df: sorted(((*r[:4], bits(r[4])) for r in df.collect()), key=repr)
    assert plain(summary_of_parts(left)) == plain(want)
    assert add_parts(summary_parts(frame(go), binary).unionByName(gone)).count() == 0


# Gold by deltas

KEYS = ("k",)
TRIP = "k int, year int, month int, payment_type string, total_amount double"


@pytest.fixture
def config(spark, tmp_path):
    tag = tmp_path.name
    bronze, silver, gold = standard_layers(str(tmp_path), tuple(f"{x}_{tag}" for x in ("b", "s", "g")))
    yield PipelineConfig(
        str(tmp_path / "drop"), bronze, replace(silver, keys=KEYS), gold, gold_state=Layer(str(tmp_path / "state"))
    )
    for x in ("b", "s", "g"):
        spark.sql(f"DROP DATABASE IF EXISTS `{x}_{tag}` CASCADE")


def merge(spark, config, rows):
    changes = Changes(config.silver_changes, ("year", "month", "payment_type", "total_amount"))
    upsert_table(spark, spark.createDataFrame(rows, TRIP), config.silver, changes=changes)


def lots(seed, n=4):
    """Trips whose month follows from their key; later lots move some to another payment type or amount."""
    rng = random.Random(seed)
    for _ in range(n):
        keys = rng.sample(range(60), 20)
        amount = lambda: rng.choice([0.1, 0.2, 10.305, 1e18, 1e-12, None])
        yield [(k, 2020, 1 + k % 4, rng.choice(["a", "b", None]), amount()) for k in keys]


def gold_of(spark, config):
    rows = read_layer(spark, config.gold.path, ("year", "month"))
    rows = rows.select("year", "month", "payment_type", "total_trips", "total_amount_collected")
    return sorted(((*r[:4], bits(r[4])) for r in rows.collect()), key=repr)


def from_the_start(spark, config, tmp_path):
    fresh = replace(config, gold=Layer(str(tmp_path / "fresh"), keys=config.gold.keys), gold_state=None)
    run_gold(spark, fresh)
    return gold_of(spark, fresh)


@pytest.mark.parametrize("seed", range(2))
def test_refresh_from_changes_equals_a_run_from_the_start(spark, config, tmp_path, seed):
    for i, rows in enumerate(lots(seed)):
        merge(spark, config, rows)
        if i != 1:  # two lots at once
            refresh_gold(spark, config)
    assert gold_of(spark, config) == from_the_start(spark, config, tmp_path)
    assert refresh_gold(spark, config).rows == 0
    assert rows_of(spark.table(config.gold.qualified_name)) != []


def test_group_and_partition_that_lose_their_last_trip_go(spark, config):
    merge(spark, config, [(1, 2020, 1, "a", 5.0), (2, 2020, 2, "a", 6.0), (3, 2020, 2, "b", 7.0)])
    refresh_gold(spark, config)
    merge(spark, config, [(2, 2020, 2, "b", 6.5)])
    refresh_gold(spark, config)
    assert gold_of(spark, config) == [(2020, 1, "a", 1, bits(5.0)), (2020, 2, "b", 2, bits(13.5))]


def test_silver_is_not_read(spark, config, monkeypatch):
    for rows in lots(3, 2):
        merge(spark, config, rows)
    read = []
    real = gold_plan.read_files
    monkeypatch.setattr(gold_plan, "read_layer", lambda *a, **k: pytest.fail("a layer is read whole"))
    monkeypatch.setattr(gold_plan, "read_files", lambda s, path, *a: read.append(path) or real(s, path, *a))
    refresh_gold(spark, config)
    assert read == [config.gold_state.path]


@pytest.mark.parametrize("dies_at", range(7))
def test_refresh_that_dies_counts_each_change_once(spark, config, tmp_path, monkeypatch, dies_at):
    first, second = lots(8, 2)
    merge(spark, config, first)
    refresh_gold(spark, config)
    merge(spark, config, second)
    left = [dies_at]

    def counted(work):
        def run(*args):
            if left[0] <= 0:
                raise RuntimeError("driver lost")
            left[0] -= 1
            return work(*args)

        return run

    with monkeypatch.context() as patch:
        patch.setattr(pending, "each", lambda work, things: [work(x) for x in things])
        patch.setattr(pending, "move", counted(pending.move) if dies_at else pending.move)
        patch.setattr(gold_plan, "write_partitioned", counted(write_partitioned))
        try:
            refresh_gold(spark, config)
        except RuntimeError:
            pass
    refresh_gold(spark, config)
    assert gold_of(spark, config) == from_the_start(spark, config, tmp_path)


def test_plain_sums_cannot_be_taken_away(config):
    with pytest.raises(ValueError, match="exact"):
        replace(config, exact_amounts=False)


HEADER = "vendorid,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,payment_type,total_amount"


def trip(vendor, day, payment, amount):
    return f"{vendor},2020-01-{day:02} 00:00:00,2020-01-{day:02} 00:10:00,1,2.5,{payment},{amount}"


def drop(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


@pytest.mark.parametrize("how", ["batch", "incremental"])
def test_whole_runs_by_deltas(spark, config, tmp_path, how):
    config = replace(config, silver=replace(config.silver, keys=("vendorid", "pickup_ts", "dropoff_ts")))
    lots = [[trip(1, 1, "a", 0.1), trip(2, 1, "a", 0.2), trip(3, 2, "b", 5)], [trip(2, 1, "b", 0.3), trip(9, 9, "", 1)]]
    for i, lines in enumerate(lots):
        drop(tmp_path / "drop", f"{i}.csv", lines)
        if how == "batch":
            run_all(spark, config)
        else:
            ingest_new_files(spark, config, str(tmp_path / "ingest"))
            refresh_from_new_rows(spark, config, str(tmp_path / "refresh"))
    totals = defaultdict(float)
    for r in read_layer(spark, config.gold.path, ("year", "month")).collect():
        totals[r.payment_type] = (r.total_trips, r.total_amount_collected)
    assert totals == {"a": (1, 0.1), "b": (2, 5.3), None: (1, 1.0)}
