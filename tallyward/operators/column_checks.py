"""Declared column tests: a test counts the rows that violate it and passes at zero.

All ``not_null`` and ``accepted_values`` tests of a frame run in one aggregate. Result rows have the columns
(model, test, column_name, failures, passed).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.frames import rows_from_aggregate

# Columns declared not-null, by model.
NOT_NULL = {
    "stg_covid19": (
        "date",
        "country_code",
        "country_name",
        "new_confirmed",
        "new_deceased",
        "new_hospitalized_patients",
        "new_vaccine_doses_administered",
        "stringency_index",
    ),
    "mart_covid19_country_metrics": ("country_code", "date", "total_new_cases"),
    "mart_pandemic_impact": (
        "date",
        "country_code",
        "country_name",
        "total_new_cases",
        "total_new_deaths",
        "current_icu_patients",
        "current_ventilator_patients",
    ),
    "mart_vaccination_effectiveness": (
        "date",
        "country_code",
        "country_name",
        "total_new_vaccinated",
        "total_new_fully_vaccinated",
        "total_doses_pfizer",
        "total_doses_moderna",
        "total_doses_janssen",
        "total_new_cases",
        "total_new_deaths",
    ),
    "mart_government_response": (
        "date",
        "country_code",
        "country_name",
        "school_closing",
        "stay_at_home_requirements",
        "international_travel_controls",
        "total_new_cases",
        "total_new_deaths",
    ),
}

# Highest level of each policy measure; levels are whole numbers from 0.
POLICY_LEVELS = {
    "school_closing": 3,
    "workplace_closing": 3,
    "cancel_public_events": 2,
    "restrictions_on_gatherings": 4,
    "stay_at_home_requirements": 3,
    "international_travel_controls": 4,
}


def verdict(model: Column, test: str, column_name: Column, failures: Column) -> dict[str, Column]:
    return {
        "model": model,
        "test": F.lit(test),
        "column_name": column_name,
        "failures": failures,
        "passed": failures == 0,
    }


def not_null_rows(model: str, columns: Iterable[str]) -> list[dict[str, Column]]:
    """The not-null tests of one model as aggregate rows, for :func:`rows_from_aggregate`."""
    return [
        verdict(F.lit(model), "not_null", F.lit(name), F.count_if(F.col(name).isNull())) for name in columns
    ]


def not_null(df: DataFrame, model: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows with a NULL, per column; the columns default to those declared for ``model``."""
    return rows_from_aggregate(df, not_null_rows(model, NOT_NULL[model] if columns is None else columns))


def declared_tests(staged: DataFrame, base: DataFrame) -> DataFrame:
    """All 36 declared tests in two aggregates: one over the staged rows, one over the base of the marts.

    Marts are projections of the base and no declared mart column is a computed rate, so testing the base
    tests all four of them at once.
    """
    of_marts = [
        row for model, columns in NOT_NULL.items() if model != "stg_covid19" for row in not_null_rows(model, columns)
    ]
    return not_null(staged, "stg_covid19").unionByName(rows_from_aggregate(base, of_marts))


def accepted_values(df: DataFrame, model: str, values: Mapping[str, Iterable]) -> DataFrame:
    """Rows whose value is outside the list, per column. NULL passes, as ``not_null`` covers it."""
    return rows_from_aggregate(
        df,
        [
            verdict(F.lit(model), "accepted_values", F.lit(name), F.count_if(~F.col(name).isin(list(allowed))))
            for name, allowed in values.items()
        ],
    )


def policy_levels(df: DataFrame, model: str) -> DataFrame:
    return accepted_values(df, model, {name: range(top + 1) for name, top in POLICY_LEVELS.items()})


def unique(df: DataFrame, model: str, columns: Iterable[str]) -> DataFrame:
    """Keys that occur more than once. The key is one value: NULLs in it are equal to each other."""
    columns = list(columns)
    repeats = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    return rows_from_aggregate(
        repeats,
        [verdict(F.lit(model), "unique", F.lit(", ".join(columns)), F.count_if(F.col("copies") > 1))],
    )


def relationships(child: DataFrame, model: str, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Child rows whose value has no parent, for several columns: column -> (parent frame, its column).

    The child is read once: its values are laid out by column, shrink to the distinct ones (combined on the map side), and
    meet the distinct values of all parents in one join. A value held by a third of the rows costs the join one row.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in parents])
    values = child.select(F.explode(pairs).alias("_pair")).select("_pair.*").groupBy("column_name", "value")
    values = values.agg(F.count(F.lit(1)).alias("row_count"))
    known = reduce(
        DataFrame.unionByName,
        [
            parent.select(F.lit(c).alias("column_name"), F.col(name).cast("string").alias("value")).distinct()
            for c, (parent, name) in parents.items()
        ],
    )
    # A column without orphans has a row too; a missing value is no orphan.
    found = values.join(known.withColumn("_known", F.lit(True)), ["column_name", "value"], "left")
    orphan = F.col("value").isNotNull() & F.col("_known").isNull()
    counted = rows_from_aggregate(
        found,
        [
            {
                "column_name": F.lit(c),
                "failures": F.coalesce(F.sum(F.when(orphan & (F.col("column_name") == c), F.col("row_count"))), F.lit(0)),
            }
            for c in parents
        ],
    )
    return counted.select(
        F.lit(model).alias("model"),
        F.lit("relationships").alias("test"),
        "column_name",
        "failures",
        (F.col("failures") == 0).alias("passed"),
    )
