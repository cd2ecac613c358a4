from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyward.functions.rates import capped_percent, percent
from tallyward.operators import marts
from tallyward.plans.models import build_models
from tests.frames import AS_OF, MARCH, edge_rows


@pytest.fixture(scope="module")
def models(spark):
    return build_models(edge_rows(spark), AS_OF)


def on_march(mart, code):
    rows = mart.where((F.col("country_code") == code) & (F.col("date") == F.lit(MARCH))).collect()
    assert len(rows) == 1
    return rows[0]


def test_schemas(models):
    assert models.country_metrics.columns == list(marts.COUNTRY_METRICS)
    assert models.impact.columns == list(marts.PANDEMIC_IMPACT)
    assert models.vaccination.columns == list(marts.VACCINATION_EFFECTIVENESS)
    assert models.government.columns == list(marts.GOVERNMENT_RESPONSE)
    assert [len(m.columns) for m in (models.country_metrics, models.impact, models.vaccination, models.government)] == [
        10,
        16,
        16,
        17,
    ]
    doubles = {
        "avg_hospital_beds_per_1000",
        "case_fatality_rate",
        "hospitalization_rate",
        "vaccination_coverage_pct",
        "avg_stringency_index",
        "avg_gdp_per_capita",
        "avg_hdi",
    }
    for mart in (models.country_metrics, models.impact, models.vaccination, models.government):
        for name, data_type in mart.dtypes:
            if name == "date":
                assert data_type == "date"
            elif name.startswith("country_"):
                assert data_type == "string"
            else:
                assert data_type == ("double" if name in doubles else "bigint"), name


def test_base_has_29_measures(models):
    assert len(models.base.columns) == 3 + 29


def test_group_of_country_and_subregion_rows(models):
    alpha = on_march(models.impact, "AA")
    assert (alpha.total_new_cases, alpha.total_new_deaths, alpha.case_fatality_rate, alpha.population) == (40, 3, 7.5, 1000)


def test_no_cases_means_no_rate(models):
    for mart in (models.country_metrics, models.impact, models.government):
        assert on_march(mart, "BB").case_fatality_rate is None


def test_only_the_impact_mart_caps_the_rate(models):
    assert on_march(models.country_metrics, "CC").case_fatality_rate == 250.0
    assert on_march(models.government, "CC").case_fatality_rate == 250.0
    assert on_march(models.impact, "CC").case_fatality_rate == 100.0


def test_averages_count_filled_gaps_but_skip_open_ones(models):
    assert on_march(models.government, "FF").avg_stringency_index == 40.0
    assert on_march(models.impact, "FF").avg_hospital_beds_per_1000 == 3.0


def test_missing_name_is_a_group(models):
    assert models.impact.where("country_code = 'EE' and country_name is null").count() == 1


def test_zero_or_missing_denominators(models):
    assert on_march(models.impact, "GG").hospitalization_rate is None
    assert on_march(models.vaccination, "GG").vaccination_coverage_pct is None
    theta = on_march(models.vaccination, "HH")
    assert (theta.population, theta.vaccination_coverage_pct) == (None, None)


def test_hospitalization_rate_is_not_capped(models):
    assert on_march(models.impact, "II").hospitalization_rate == 150.0


def test_strictest_policy_wins(models):
    assert on_march(models.government, "JJ").school_closing == 3


def test_rounding_is_half_away_from_zero(spark):
    frame = spark.sql("select 1005L as part, 100000L as whole, -1005L as minus, 8375L as eighth")
    result = frame.select(
        percent(F.col("part"), F.col("whole")).alias("up"),
        percent(F.col("minus"), F.col("whole")).alias("down"),
        percent(F.col("eighth"), F.col("whole")).alias("tie"),
        capped_percent(F.col("whole"), F.col("part")).alias("capped"),
        capped_percent(F.col("whole"), F.lit(0)).alias("none"),
    ).first()
    assert tuple(result) == (1.01, -1.01, 8.38, 100.0, None)


def test_invariants(models):
    staged_cases = models.staged.agg(F.sum("new_confirmed")).first()[0]
    for mart in (models.country_metrics, models.impact, models.vaccination, models.government):
        assert mart.agg(F.sum("total_new_cases")).first()[0] == staged_cases
        assert mart.count() == mart.select(*marts.GRAIN).distinct().count() == models.base.count()
    joined = models.impact.alias("i").join(
        models.country_metrics.alias("c"),
        F.expr("i.date = c.date and i.country_code = c.country_code and i.country_name <=> c.country_name"),
    )
    assert joined.count() == models.base.count()
    assert joined.where("not (i.case_fatality_rate <=> if(c.case_fatality_rate > 100, 100.0D, c.case_fatality_rate))").count() == 0


def test_a_group_with_a_third_of_all_rows(spark):
    """The same figures whether a country-day is spread thin or holds a third of the rows in one run of files."""
    few = edge_rows(spark)
    hot = few.where("country_code = 'AA'").crossJoin(spark.range(3000)).drop("id").repartition(8)
    many = build_models(few.where("country_code <> 'AA'").unionByName(hot), AS_OF)
    alpha = on_march(many.impact, "AA")
    assert (alpha.total_new_cases, alpha.total_new_deaths, alpha.population) == (120_000, 9_000, 1000)


def test_descriptions_reach_the_catalog(spark, models, tmp_path):
    models.impact.write.mode("overwrite").option("path", str(tmp_path / "impact")).saveAsTable("described_impact")
    comments = {column.name: column.description for column in spark.catalog.listColumns("described_impact")}
    assert comments["total_new_cases"] == marts.DESCRIPTIONS["total_new_cases"]
