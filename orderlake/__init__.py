"""Order analytics on Spark: raw orders -> bronze -> silver -> gold marts."""

from orderlake.session import checkpoint_dir, clear_scratch, get_session
from orderlake.plans.jobs import run_ingestion, run_load, run_transformation, validate_layers
from orderlake.plans.pipeline import ALL_STEPS, LayerPaths, run_pipeline

__all__ = [
    "ALL_STEPS",
    "LayerPaths",
    "checkpoint_dir",
    "clear_scratch",
    "get_session",
    "run_ingestion",
    "run_load",
    "run_pipeline",
    "run_transformation",
    "validate_layers",
]
