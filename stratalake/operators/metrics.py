"""Row counts per step, gathered while the rows are written."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession


@dataclass(frozen=True)
class StepCount:
    step: str
    rows: int


def measure_while(written: DataFrame, act: Callable[[DataFrame], None], /, **measures: Column) -> dict:
    """Run ``act`` on ``written`` and return aggregates over the rows it used, without a second pass.

    Hand over the frame that is written, above its last shuffle. There each task counts once,
    also when executors are lost and their tasks run again; below a shuffle, tasks that are
    repeated would be counted again.
    """
    seen = Observation()
    act(written.observe(seen, *[column.alias(name) for name, column in measures.items()]))
    return seen.get


def step_report(spark: SparkSession, steps: Sequence[StepCount]) -> DataFrame:
    """One row per step."""
    return spark.createDataFrame([(s.step, s.rows) for s in steps], "step string, rows bigint")
