"""The data sets behind the three dashboard pages.

Each takes a mart (or the base all marts are read from) and returns what one chart shows. Countries are told apart
by code *and* name, since a code may come with several names; per pair, a mart has one row per day, so "latest" is
unambiguous. Filter a page with :func:`page_filter` first: the condition on the grouping columns passes below the
mart's aggregate, down to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.rates import capped_percent, percent

COUNTRY = ("country_code", "country_name")
DIGITS = 6


def page_filter(
    mart: DataFrame, countries: Iterable[str] | None = None, first: date | None = None, last: date | None = None
) -> DataFrame:
    """The country and date controls of a page; a control left out does not filter."""
    if countries is not None:
        mart = mart.where(F.col("country_code").isin(list(countries)))
    if first is not None:
        mart = mart.where(F.col("date") >= F.lit(first))
    if last is not None:
        mart = mart.where(F.col("date") <= F.lit(last))
    return mart


def _latest(mart: DataFrame, *columns: str) -> DataFrame:
    """The row of each country's last day: (country_code, country_name, last_date, *columns).

    One ``max_by`` per column keeps the buffers of fixed width, which a hash aggregate needs; a single ``max_by``
    of a struct would sort. All of them pick the same row, as a country has one row per day.
    """
    return mart.groupBy(*COUNTRY).agg(
        F.max("date").alias("last_date"), *[F.max_by(name, "date").alias(name) for name in columns]
    )


def _totals(mart: DataFrame, *keys: str) -> DataFrame:
    return mart.groupBy(*keys).agg(
        F.sum("total_new_cases").alias("total_new_cases"), F.sum("total_new_deaths").alias("total_new_deaths")
    )


# --- pandemic impact -------------------------------------------------------------------------------------------


def cumulative_by_country(impact: DataFrame) -> DataFrame:
    """Map: cumulative cases."""
    return impact.groupBy(*COUNTRY).agg(F.max("total_cumulative_cases").alias("total_cumulative_cases"))


def daily_cases_deaths(impact: DataFrame) -> DataFrame:
    """Time series over all countries."""
    return _totals(impact, "date").orderBy("date")


def top_fatality_rates(impact: DataFrame, count: int = 20) -> DataFrame:
    """Bars: the countries with the highest fatality rate, as a ratio of sums, capped at 100."""
    rates = _totals(impact, *COUNTRY).withColumn(
        "case_fatality_rate", capped_percent(F.col("total_new_deaths"), F.col("total_new_cases"))
    )
    return rates.orderBy(F.desc_nulls_last("case_fatality_rate"), *COUNTRY).limit(count)


def impact_scorecards(impact: DataFrame) -> DataFrame:
    """Patients on each country's last day, summed over countries."""
    measures = ("current_icu_patients", "current_ventilator_patients", "current_hospitalized")
    return _latest(impact, *measures).agg(
        *[F.sum(name).alias(name) for name in measures], F.count(F.lit(1)).alias("countries")
    )


# --- vaccination -----------------------------------------------------------------------------------------------


def coverage_scorecard(vaccination: DataFrame) -> DataFrame:
    """Coverage on the last day: per country, and over all of them (``scope`` = all)."""
    latest = _latest(vaccination, "total_cumulative_fully_vaccinated", "population")
    vaccinated, people = F.sum("total_cumulative_fully_vaccinated"), F.sum("population")
    pair = [F.col(name) for name in COUNTRY]
    return (
        latest.groupingSets([pair, []], *pair)
        .agg(
            F.grouping("country_code").alias("_all"),
            vaccinated.alias("fully_vaccinated"),
            people.alias("population"),
            percent(vaccinated, people).alias("vaccination_coverage_pct"),
        )
        .select(
            F.when(F.col("_all") == 1, "all").otherwise("country").alias("scope"),
            *COUNTRY,
            "fully_vaccinated",
            "population",
            "vaccination_coverage_pct",
        )
    )


def doses_by_brand(vaccination: DataFrame) -> DataFrame:
    """Pie: (brand, doses, share_pct)."""
    # Brand label -> mart column.
    brands = {"Pfizer": "total_doses_pfizer", "Moderna": "total_doses_moderna", "Janssen": "total_doses_janssen"}
    sums = vaccination.agg(*[F.sum(column).alias(column) for column in brands.values()])
    total = sum((F.coalesce(F.col(column), F.lit(0)) for column in brands.values()), F.lit(0))
    return sums.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("brand"),
                        F.col(column).alias("doses"),
                        percent(F.col(column), total).alias("share_pct"),
                    )
                    for label, column in brands.items()
                ]
            )
        )
    )


def vaccinations_vs_deaths(vaccination: DataFrame) -> DataFrame:
    """Time series of first doses against deaths."""
    return (
        vaccination.groupBy("date")
        .agg(
            F.sum("total_new_vaccinated").alias("total_new_vaccinated"),
            F.sum("total_new_deaths").alias("total_new_deaths"),
        )
        .orderBy("date")
    )


def vaccination_progress(vaccination: DataFrame) -> DataFrame:
    """Highest cumulative number so far, per country and day. A window group has one row per day."""
    so_far = Window.partitionBy(*COUNTRY).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return vaccination.select(
        *COUNTRY,
        "date",
        F.max("total_cumulative_vaccinated").over(so_far).alias("people_vaccinated"),
        F.max("total_cumulative_fully_vaccinated").over(so_far).alias("people_fully_vaccinated"),
    )


# --- government response ---------------------------------------------------------------------------------------


def stringency_vs_cases(government: DataFrame) -> DataFrame:
    """Time series: mean stringency over countries against new cases."""
    return (
        government.groupBy("date")
        .agg(
            F.round(F.avg("avg_stringency_index"), DIGITS).alias("avg_stringency_index"),
            F.sum("total_new_cases").alias("total_new_cases"),
        )
        .orderBy("date")
    )


def policy_scorecards(government: DataFrame) -> DataFrame:
    """Policy levels on each country's last day."""
    return _latest(government, "stay_at_home_requirements", "school_closing", "international_travel_controls")


def hdi_vs_fatality(government: DataFrame) -> DataFrame:
    """Scatter: mean human development index against the uncapped fatality rate, per country."""
    deaths, cases = F.sum("total_new_deaths"), F.sum("total_new_cases")
    return government.groupBy(*COUNTRY).agg(
        F.round(F.avg("avg_hdi"), DIGITS).alias("avg_hdi"), percent(deaths, cases).alias("case_fatality_rate")
    )


def hdi_fatality_correlation(government: DataFrame) -> DataFrame:
    """The correlation behind the scatter: (countries, correlation)."""
    points = hdi_vs_fatality(government).where(F.col("avg_hdi").isNotNull() & F.col("case_fatality_rate").isNotNull())
    return points.agg(
        F.count(F.lit(1)).alias("countries"),
        F.round(F.corr("avg_hdi", "case_fatality_rate"), DIGITS).alias("correlation"),
    )


def gdp_vs_coverage(government: DataFrame, vaccination: DataFrame) -> DataFrame:
    """Table: GDP per head against vaccination coverage on the last day, from two separately stored marts.

    Both sides are reduced to one row per country before the join; names compare NULL-safe.
    """
    gdp = _latest(government, "avg_gdp_per_capita").drop("last_date").alias("gdp")
    coverage = _latest(vaccination, "vaccination_coverage_pct").alias("coverage")
    same = (F.col("gdp.country_code") == F.col("coverage.country_code")) & F.col("gdp.country_name").eqNullSafe(
        F.col("coverage.country_name")
    )
    return gdp.join(coverage, same).select(
        "gdp.country_code",
        "gdp.country_name",
        "coverage.last_date",
        "gdp.avg_gdp_per_capita",
        "coverage.vaccination_coverage_pct",
    )


def gdp_vs_coverage_from_base(base: DataFrame) -> DataFrame:
    """The same table without a join, where the common base of the marts is at hand."""
    return (
        _latest(base, "avg_gdp_per_capita", "total_cumulative_fully_vaccinated", "population")
        .withColumn(
            "vaccination_coverage_pct", percent(F.col("total_cumulative_fully_vaccinated"), F.col("population"))
        )
        .drop("total_cumulative_fully_vaccinated", "population")
    )
