"""The four daily country marts, all read off one aggregate.

Every mart has the grain (date, country_code, country_name), and together they use 29 measures. The measures are
declared once and computed by :func:`daily_country_base`; a mart is a projection of that frame. Asked for alone,
a mart costs only its own measures: Catalyst drops the unused aggregates and their columns from the scan.
Asked for together, write the base once and project from the table.

Sums, maxima and averages all combine on the map side, so a country-day holding a third of all rows reaches
the exchange as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.frames import describe
from tallyward.functions.rates import capped_percent, percent

GRAIN = ("date", "country_code", "country_name")

# Mart column <- staged column, by aggregate.
SUMS = {
    "total_new_cases": "new_confirmed",
    "total_new_deaths": "new_deceased",
    "total_new_recovered": "new_recovered",
    "total_new_hospitalized": "new_hospitalized_patients",
    "total_new_vaccinated": "new_persons_vaccinated",
    "total_new_fully_vaccinated": "new_persons_fully_vaccinated",
    "total_new_doses": "new_vaccine_doses_administered",
    "total_doses_pfizer": "new_doses_pfizer",
    "total_doses_moderna": "new_doses_moderna",
    "total_doses_janssen": "new_doses_janssen",
}
MAXIMA = {
    "total_cumulative_cases": "cumulative_confirmed",
    "total_cumulative_deaths": "cumulative_deceased",
    "current_hospitalized": "current_hospitalized_patients",
    "current_icu_patients": "current_intensive_care_patients",
    "current_ventilator_patients": "current_ventilator_patients",
    "total_cumulative_vaccinated": "cumulative_persons_vaccinated",
    "total_cumulative_fully_vaccinated": "cumulative_persons_fully_vaccinated",
    "total_cumulative_doses": "cumulative_vaccine_doses_administered",
    "school_closing": "school_closing",
    "workplace_closing": "workplace_closing",
    "cancel_public_events": "cancel_public_events",
    "restrictions_on_gatherings": "restrictions_on_gatherings",
    "stay_at_home_requirements": "stay_at_home_requirements",
    "international_travel_controls": "international_travel_controls",
    "population": "population",
}
AVERAGES = {
    "avg_hospital_beds_per_1000": "hospital_beds_per_1000",
    "avg_stringency_index": "stringency_index",
    "avg_gdp_per_capita": "gdp_per_capita_usd",
    "avg_hdi": "human_development_index",
}

# The columns of each mart, in output order.
COUNTRY_METRICS = (
    "country_code",
    "country_name",
    "date",
    "total_new_cases",
    "total_new_deaths",
    "total_new_recovered",
    "total_cumulative_cases",
    "total_cumulative_deaths",
    "population",
    "case_fatality_rate",
)
PANDEMIC_IMPACT = (
    "date",
    "country_code",
    "country_name",
    "total_new_cases",
    "total_new_deaths",
    "total_new_recovered",
    "total_cumulative_cases",
    "total_cumulative_deaths",
    "total_new_hospitalized",
    "current_hospitalized",
    "current_icu_patients",
    "current_ventilator_patients",
    "avg_hospital_beds_per_1000",
    "case_fatality_rate",
    "hospitalization_rate",
    "population",
)
VACCINATION_EFFECTIVENESS = (
    "date",
    "country_code",
    "country_name",
    "total_new_vaccinated",
    "total_new_fully_vaccinated",
    "total_cumulative_vaccinated",
    "total_cumulative_fully_vaccinated",
    "total_new_doses",
    "total_cumulative_doses",
    "total_doses_pfizer",
    "total_doses_moderna",
    "total_doses_janssen",
    "total_new_cases",
    "total_new_deaths",
    "vaccination_coverage_pct",
    "population",
)
GOVERNMENT_RESPONSE = (
    "date",
    "country_code",
    "country_name",
    "school_closing",
    "workplace_closing",
    "cancel_public_events",
    "restrictions_on_gatherings",
    "stay_at_home_requirements",
    "international_travel_controls",
    "avg_stringency_index",
    "total_new_cases",
    "total_new_deaths",
    "current_hospitalized",
    "case_fatality_rate",
    "population",
    "avg_gdp_per_capita",
    "avg_hdi",
)

DESCRIPTIONS = {
    "date": "Day the figures were reported for",
    "country_code": "Two-letter ISO code of the country",
    "country_name": "Country name in full",
    "total_new_cases": "Cases confirmed that day in the country",
    "total_new_deaths": "Deaths that day in the country",
    "case_fatality_rate": "Deaths per 100 confirmed cases",
    "hospitalization_rate": "Patients in hospital per 100 cases so far",
    "current_icu_patients": "Patients in intensive care",
    "current_ventilator_patients": "Patients on a ventilator",
    "avg_hospital_beds_per_1000": "Mean of reported hospital beds per 1000 people",
    "total_new_vaccinated": "People given a first dose that day",
    "total_new_fully_vaccinated": "People completing vaccination that day",
    "total_doses_pfizer": "Pfizer doses given that day",
    "total_doses_moderna": "Moderna doses given that day",
    "total_doses_janssen": "Janssen doses given that day",
    "vaccination_coverage_pct": "Fully vaccinated people per 100 inhabitants",
    "avg_stringency_index": "Mean strictness of the response, 0 to 100",
    "school_closing": "Strictest school closing level, 0 to 3",
    "stay_at_home_requirements": "Strictest stay-at-home level, 0 to 3",
    "international_travel_controls": "Strictest travel control level, 0 to 4",
    "avg_gdp_per_capita": "Mean of reported GDP per head, US dollars",
    "avg_hdi": "Mean of reported human development index",
}


def measures() -> list[Column]:
    """All 29 measures as aggregates of the staged columns."""
    found = [F.sum(source).alias(name) for name, source in SUMS.items()]
    found += [F.max(source).alias(name) for name, source in MAXIMA.items()]
    return found + [F.avg(source).alias(name) for name, source in AVERAGES.items()]


def daily_country_base(staged: DataFrame) -> DataFrame:
    """All 29 measures per country and day: one scan, one exchange."""
    return staged.groupBy(*GRAIN).agg(*measures())


def fatality_rate() -> Column:
    """Deaths per 100 cases; may exceed 100 where deaths are booked on a wider area than cases."""
    return percent(F.col("total_new_deaths"), F.col("total_new_cases"))


def capped_fatality_rate() -> Column:
    return capped_percent(F.col("total_new_deaths"), F.col("total_new_cases"))


def hospitalization_rate() -> Column:
    return percent(F.col("current_hospitalized"), F.col("total_cumulative_cases"))


def vaccination_coverage() -> Column:
    return percent(F.col("total_cumulative_fully_vaccinated"), F.col("population"))


def _mart(base: DataFrame, columns: tuple[str, ...], **rates: Column) -> DataFrame:
    return describe(base.withColumns(rates).select(*columns), DESCRIPTIONS)


def country_metrics(base: DataFrame) -> DataFrame:
    """Case figures by country and day, fatality rate uncapped."""
    return _mart(base, COUNTRY_METRICS, case_fatality_rate=fatality_rate())


def pandemic_impact(base: DataFrame) -> DataFrame:
    """Cases and hospital pressure; the only mart whose fatality rate is capped at 100."""
    return _mart(
        base,
        PANDEMIC_IMPACT,
        case_fatality_rate=capped_fatality_rate(),
        hospitalization_rate=hospitalization_rate(),
    )


def vaccination_effectiveness(base: DataFrame) -> DataFrame:
    """Vaccination progress, doses by brand, and outcomes on the same day."""
    return _mart(base, VACCINATION_EFFECTIVENESS, vaccination_coverage_pct=vaccination_coverage())


def government_response(base: DataFrame) -> DataFrame:
    """Strictest policy levels with outcomes and economic context; fatality rate uncapped."""
    return _mart(base, GOVERNMENT_RESPONSE, case_fatality_rate=fatality_rate())


MODEL_DESCRIPTIONS = {
    "stg_covid19": "Cleaned daily rows: valid days and counts only, gaps in reported figures filled with 0",
    "mart_covid19_country_metrics": "Cases, deaths and fatality rate of each country and day",
    "mart_pandemic_impact": "Cases and pressure on hospitals of each country and day, fatality rate capped at 100",
    "mart_vaccination_effectiveness": "Vaccinations, doses by brand and outcomes of each country and day",
    "mart_government_response": "Strictest policies with outcomes and economic context of each country and day",
}

# Mart names as their readers know them.
MARTS = {
    "mart_covid19_country_metrics": country_metrics,
    "mart_pandemic_impact": pandemic_impact,
    "mart_vaccination_effectiveness": vaccination_effectiveness,
    "mart_government_response": government_response,
}


def model_catalog(staged: DataFrame, base: DataFrame) -> DataFrame:
    """(model, model_description, column_name, data_type, description): what is documented about each model's columns.

    One row per column, read off the schemas and their comments.
    """
    frames = {"stg_covid19": staged, **{name: build(base) for name, build in MARTS.items()}}
    rows = [
        (name, MODEL_DESCRIPTIONS[name], f.name, f.dataType.simpleString(), f.metadata.get("comment"))
        for name, frame in frames.items()
        for f in frame.schema.fields
    ]
    return staged.sparkSession.createDataFrame(
        rows, "model string, model_description string, column_name string, data_type string, description string"
    )
