"""The whole loop: derive rules, keep them, run them, keep what failed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from ..sources import store
from ..sources.dataset import Dataset
from .execute import RunOutcome, run_rules
from .generate import ForeignKey, generate_rules


def generate_into(
    dataset: Dataset,
    path: str,
    foreign_keys: Iterable[ForeignKey] = (),
    as_of: dt.date | None = None,
    forecasts: bool = True,
) -> None:
    """Replace the stored rules and models of a dataset."""
    store.ensure_store(dataset.spark, path)
    generated = generate_rules(dataset, foreign_keys, as_of, forecasts=forecasts)
    store.write_rules(generated.rules, path)
    if generated.models is not None:
        store.write_models(generated.models, path)


def run_stored(
    dataset: Dataset, path: str, as_of: dt.date | None = None, include_pass: bool = False
) -> RunOutcome:
    """Run the stored rules, replace the results table and add the samples."""
    spark = dataset.spark
    rules = store.read_rules(spark, path, engine_fields=True)
    has_models = store.store_has(spark, f"{path}/models")
    models = store.read_models(spark, path) if has_models else None
    outcome = run_rules(dataset, rules, models, as_of, include_pass=include_pass)
    store.write_results(outcome.results, path)
    store.append_samples(outcome.samples, path)
    return outcome
