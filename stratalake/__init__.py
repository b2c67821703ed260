"""Layered (raw -> Bronze -> Silver -> Gold) data pipelines as plain PySpark."""

from stratalake.config import Layer, PipelineConfig
from stratalake.session import build_session, scratch_dir

__all__ = ["Layer", "PipelineConfig", "build_session", "scratch_dir"]
