"""Rebuilding the star together with what is asked of it by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tianguis.plans.reporting import reporting_views
from tianguis.plans.star import build_star
from tianguis.schemas import MAX_LENGTHS
from tianguis.sources.warehouse import Lengths, Star, register_views


def rebuild(spark: SparkSession, staging: Mapping[str, DataFrame], folder: str, lengths: Lengths = MAX_LENGTHS) -> Star:
    """Write the star and register the reporting views over the new build, so the same view names give the new totals.
    A view that was planned before keeps reading the build it was planned over."""
    star = build_star(spark, staging, folder, lengths)
    register_views(reporting_views(star))
    return star
