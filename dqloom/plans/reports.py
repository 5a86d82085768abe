"""Summary tables over results, samples and rules, and alert lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def failures_by_table(results: DataFrame) -> DataFrame:
    return results.where("status = 'FAIL'").groupBy("source_table_id").agg(
        F.count(F.lit(1)).alias("failed_rules"), F.sum("failed_rows").alias("failed_rows")
    )


def family_division(results: DataFrame) -> DataFrame:
    """Failing rules by table and family with totals; NULL stands for all."""
    return (
        results.where("status = 'FAIL'")
        .rollup("source_table_id", "rule_family")
        .agg(F.count(F.lit(1)).alias("failed_rules"))
    )


def failed_by_metric(results: DataFrame) -> DataFrame:
    return results.where("status = 'FAIL'").groupBy("source_table_id", "metric_column").agg(
        F.sum("failed_rows").alias("failed_rows")
    )


def rules_by_family(rules: DataFrame) -> DataFrame:
    return rules.groupBy("rule_family").agg(F.count(F.lit(1)).alias("rules"))


def sample_details(samples: DataFrame, rules: DataFrame) -> DataFrame:
    """Samples with the rule they belong to."""
    text = rules.select("rule_id", "rule_family", "rule_sql", "rule_description")
    return samples.join(text, "rule_id")


def alert_lines(results: DataFrame) -> DataFrame:
    """One line per dataset with failing columns."""
    columns = F.count_distinct("source_table_id", "metric_column")
    counted = (
        results.where("status = 'FAIL'")
        .groupBy("source_dataset_id")
        .agg(columns.alias("failed_columns"))
    )
    line = F.format_string(
        "%s is failing %d data quality columns", "source_dataset_id", "failed_columns"
    )
    return counted.withColumn("alert", line)


def error_alerts(results: DataFrame) -> DataFrame:
    """Rules that could not be executed."""
    return results.where("status = 'ERROR'").select(
        "source_dataset_id", "source_table_id", "metric_column", "rule_family", "error_message"
    )
