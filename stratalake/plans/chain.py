"""The three layer runs in order."""

from __future__ import annotations

from pyspark.sql import SparkSession

from stratalake.config import PipelineConfig
from stratalake.operators.metrics import StepCount
from stratalake.plans.bronze import run_bronze
from stratalake.plans.gold import refresh_gold, run_gold
from stratalake.plans.silver import run_silver


def run_all(spark: SparkSession, config: PipelineConfig) -> list[StepCount]:
    """Bronze, Silver, Gold. A step that fails raises, and later steps do not run."""
    steps = [run_bronze(spark, config)]
    silver_steps, touched = run_silver(spark, config)
    steps += silver_steps
    steps.append(refresh_gold(spark, config) if config.gold_state else run_gold(spark, config, touched))
    return steps
