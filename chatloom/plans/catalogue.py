"""All core queries by name."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

MODULES = [
    "chatloom.operators.tree_aggregate",
    "chatloom.sources.rejects",
    "chatloom.plans.text_queries",
    "chatloom.plans.log_queries",
    "chatloom.plans.pair_queries",
    "chatloom.plans.job_queries",
    "chatloom.plans.source_queries",
]


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        for key, value in getattr(importlib.import_module(name), attribute).items():
            if key in out:
                raise ValueError(f"{key} is defined twice")
            out[key] = value
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("SQL")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["unanswered_by_day"](spark, sf_dir)
