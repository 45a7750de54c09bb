"""What a source offers: resource URIs, total, truncated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.operators.ordered import limit_per_key, union_resources


def resources(parts: list[tuple[str, DataFrame, Column]]) -> DataFrame:
    """(connector_id, resource) from one landed table per connector."""
    named = [(name, df.select(F.lit(name).alias("connector_id"), uri.alias("resource")))
             for name, df, uri in parts]
    return union_resources(named).drop("resource_type", "resource_rank")


def totals(found: DataFrame) -> DataFrame:
    return found.groupBy("connector_id").agg(F.count("*").alias("total"))


def listed(found: DataFrame, at_most: int | None = None) -> DataFrame:
    """Resources with their connector's total and the truncated flag; without
    a limit nothing is truncated."""
    shown = found if at_most is None else limit_per_key(
        found, ["connector_id"], ["resource"], at_most)
    joined = shown.join(totals(found), "connector_id")
    cut = F.lit(False) if at_most is None else F.col("total") > at_most
    return joined.withColumn("truncated", cut)


def installation_repos(answers: DataFrame) -> DataFrame:
    """Installation answers wrap their repositories in one object."""
    repos = F.from_json(F.get_json_object("body", "$.repositories"),
                        "array<struct<full_name:string>>")
    return answers.select(F.explode(repos).alias("r")).select(F.col("r.full_name").alias("full_name"))
