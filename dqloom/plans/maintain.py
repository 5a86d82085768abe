"""Rule maintenance: create, find, update and delete rules of a rules table."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_frame
from ..sources.store import ENGINE_FIELDS, RULE_SCHEMA
from .generate import rule_id


def new_rule(
    like: DataFrame,
    table: str,
    metric: str,
    family: str,
    sql: str,
    description: str | None = None,
    failure_predicate: str | None = None,
    project: str = "local",
    dataset: str = "source_data",
) -> DataFrame:
    """One user-written rule. A row predicate lets it share scans and have samples."""
    given = {
        "source_project_id": project,
        "source_dataset_id": dataset,
        "source_table_id": table,
        "metric_column": metric,
        "rule_sql": sql,
        "rule_family": family,
        "rule_description": description,
        "failure_predicate": failure_predicate,
    }
    values = {k: F.lit(v) for k, v in given.items()}
    values["rule_generation_timestamp"] = F.current_timestamp()
    values["rule_id"] = rule_id(F.lit(table), F.lit(metric), F.lit(family), F.lit(sql))
    return like.sparkSession.range(1).select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RULE_SCHEMA]
    )


def create_rule(rules: DataFrame, new: DataFrame) -> DataFrame:
    """Rules with the new ones added; an id that exists already is left as it is."""
    fresh = new.join(rules.select("rule_id"), "rule_id", "left_anti")
    return rules.unionByName(fresh)


def find_rules(rules: DataFrame, where: Column | str) -> DataFrame:
    return rules.where(where)


def update_rule(rules: DataFrame, changes: DataFrame) -> DataFrame:
    """Rules with the non-null fields of ``changes`` put in, by ``rule_id``.

    The id stays, so results and samples of the rule keep pointing at it; the timestamp
    becomes the time of the change. New SQL without new engine fields is what runs from
    then on, so the engine fields of the rule are cleared.
    """
    changed = [c for c in changes.columns if c != "rule_id"]
    news = changes.select("rule_id", *[F.col(c).alias(f"new_{c}") for c in changed])
    news = news.withColumn("touched", F.lit(True))
    fields = {c: F.coalesce(F.col(f"new_{c}"), F.col(c)) for c in changed}
    if "rule_sql" in changed:
        given = [F.col(f"new_{c}").isNotNull() for c in changed if c in ENGINE_FIELDS]
        own = F.col("new_rule_sql").isNotNull() & ~reduce(Column.__or__, given, F.lit(False))
        for c in ENGINE_FIELDS:
            fields[c] = F.when(~F.coalesce(own, F.lit(False)), fields.get(c, F.col(c)))
    fields["rule_generation_timestamp"] = F.when(
        F.col("touched"), F.current_timestamp()
    ).otherwise(F.col("rule_generation_timestamp"))
    joined = rules.join(news, "rule_id", "left")
    return joined.select(
        *[fields.get(c, F.col(c)).alias(c) for c in rules.columns]
    )


def delete_rule(rules: DataFrame, ids: Iterable[str]) -> DataFrame:
    gone = small_frame(rules.sparkSession, [(i,) for i in ids], "rule_id string")
    return rules.join(gone, "rule_id", "left_anti")
