"""The models built from raw rows, and how they follow from each other."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tallyward.operators import marts
from tallyward.operators.staging import stage
from tallyward.sources import storage


@dataclass(frozen=True)
class Models:
    """Staged rows, the common base of the marts, and the marts; all lazy."""

    staged: DataFrame
    base: DataFrame

    @property
    def country_metrics(self) -> DataFrame:
        return marts.country_metrics(self.base)

    @property
    def impact(self) -> DataFrame:
        return marts.pandemic_impact(self.base)

    @property
    def vaccination(self) -> DataFrame:
        return marts.vaccination_effectiveness(self.base)

    @property
    def government(self) -> DataFrame:
        return marts.government_response(self.base)


def build_models(raw: DataFrame, as_of: date | None = None) -> Models:
    staged = stage(raw, as_of)
    return Models(staged, marts.daily_country_base(staged))


def stored_marts(spark: SparkSession, base_path: str) -> dict[str, DataFrame]:
    """The marts by name, over the base that the last run stored: for any session, with or without a lasting catalog."""
    base = storage.read_version(spark, base_path)
    return {name: build(base) for name, build in marts.MARTS.items()}
