"""Data quality rules for Spark tables: derive, store, run, sample and report."""

from .plans.execute import RunOutcome, run_rules
from .plans.generate import generate_rules
from .plans.pipeline import generate_into, run_stored
from .session import build_session
from .sources.dataset import Dataset, load_database, load_dataset

__all__ = [
    "Dataset",
    "RunOutcome",
    "build_session",
    "generate_into",
    "generate_rules",
    "load_database",
    "load_dataset",
    "run_rules",
    "run_stored",
]
