"""Cleaning step: validity filters on the source columns, null filling and renames on the output columns.

The filters look at the *source* value. A row whose case or death count is missing is therefore dropped although
the output column would be filled with zero; filtering after the fill would keep such rows.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.frames import day, rows_from_aggregate
from tallyward.sources.contract import RAW_CONTRACT

FIRST_DAY = date(2020, 1, 1)

# The staged columns in output order.
STAGED_COLUMNS = (
    "date",
    "country_code",
    "country_name",
    "subregion1_name",
    "new_confirmed",
    "new_deceased",
    "new_recovered",
    "cumulative_confirmed",
    "cumulative_deceased",
    "new_hospitalized_patients",
    "current_hospitalized_patients",
    "new_intensive_care_patients",
    "current_intensive_care_patients",
    "current_ventilator_patients",
    "hospital_beds_per_1000",
    "new_persons_vaccinated",
    "cumulative_persons_vaccinated",
    "new_persons_fully_vaccinated",
    "cumulative_persons_fully_vaccinated",
    "new_vaccine_doses_administered",
    "cumulative_vaccine_doses_administered",
    "new_doses_pfizer",
    "new_doses_moderna",
    "new_doses_janssen",
    "school_closing",
    "workplace_closing",
    "cancel_public_events",
    "restrictions_on_gatherings",
    "stay_at_home_requirements",
    "international_travel_controls",
    "stringency_index",
    "population",
    "gdp_per_capita_usd",
    "human_development_index",
)

# Staged name -> source name, where they differ.
SOURCE_NAMES = {
    "new_doses_pfizer": "new_vaccine_doses_administered_pfizer",
    "new_doses_moderna": "new_vaccine_doses_administered_moderna",
    "new_doses_janssen": "new_vaccine_doses_administered_janssen",
}

# Identifiers, and the four measures whose gaps must stay NULL so that averages skip them.
IDENTIFIERS = ("date", "country_code", "country_name", "subregion1_name")
LEFT_NULL = ("hospital_beds_per_1000", "population", "gdp_per_capita_usd", "human_development_index")
ZERO_FILLED = tuple(name for name in STAGED_COLUMNS if name not in IDENTIFIERS + LEFT_NULL)

DESCRIPTIONS = {
    "date": "Day the figures were reported for",
    "country_code": "Two-letter ISO code of the country",
    "country_name": "Country name in full",
    "new_confirmed": "Cases confirmed that day; 0 where missing",
    "new_deceased": "Deaths that day; 0 where missing",
    "new_hospitalized_patients": "Hospital admissions that day; 0 where missing",
    "new_vaccine_doses_administered": "Vaccine doses given that day; 0 where missing",
    "stringency_index": "Strictness of the government response, 0 to 100; 0 where missing",
}


def validity_rules(as_of: date | None = None) -> dict[str, Column]:
    """Every rule a raw row must meet, in order of checking. A rule that is NULL counts as broken."""
    reported = F.col("date")
    return {
        "missing_country_code": F.col("country_code").isNotNull(),
        "missing_date": reported.isNotNull(),
        "before_first_day": reported >= F.lit(FIRST_DAY),
        "after_as_of": reported <= day(as_of),
        "invalid_new_confirmed": F.col("new_confirmed") >= 0,
        "invalid_new_deceased": F.col("new_deceased") >= 0,
    }


def _staged(name: str) -> Column:
    source = F.col(SOURCE_NAMES.get(name, name)).cast(RAW_CONTRACT[SOURCE_NAMES.get(name, name)])
    return (F.coalesce(source, F.lit(0)) if name in ZERO_FILLED else source).alias(
        name, metadata={"comment": DESCRIPTIONS[name]} if name in DESCRIPTIONS else {}
    )


def stage(raw: DataFrame, as_of: date | None = None, row_filter: Column | None = None) -> DataFrame:
    """Clean ``raw`` (any number of columns) into the 34 staged columns; one row in, at most one row out.

    Country rows and subregion rows share the table and are both kept. ``row_filter`` may restrict the level,
    e.g. ``F.col("subregion1_name").isNull()``; it is off by default.
    """
    rules = [*validity_rules(as_of).values(), *([] if row_filter is None else [row_filter])]
    return raw.where(reduce(and_, rules)).select(*[_staged(name) for name in STAGED_COLUMNS])


def reject_reasons(raw: DataFrame, as_of: date | None = None) -> DataFrame:
    """Rows per outcome: ``accepted``, or the first rule a row breaks."""
    outcome = None
    for name, rule in validity_rules(as_of).items():
        broken = ~F.coalesce(rule, F.lit(False))
        outcome = F.when(broken, name) if outcome is None else outcome.when(broken, name)
    return raw.groupBy(outcome.otherwise("accepted").alias("outcome")).agg(F.count(F.lit(1)).alias("row_count"))


def gap_counts(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(column_name, null_count, zero_count, row_count) for each column, in one pass."""
    return rows_from_aggregate(
        df,
        [
            {
                "column_name": F.lit(name),
                "null_count": F.count_if(F.col(name).isNull()),
                "zero_count": F.count_if(F.col(name) == 0),
                "row_count": F.count(F.lit(1)),
            }
            for name in columns
        ],
    )
