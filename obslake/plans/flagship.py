"""Flagship: does the panel tie to the reported total, and where not?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def panel_tie(spark: SparkSession, folder: str) -> DataFrame:
    from .q_quality import panel_checks

    from ..sources.landed import Tables

    return panel_checks(Tables(spark, folder))
