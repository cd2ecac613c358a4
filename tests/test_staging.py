from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyward.operators import staging
from tallyward.sources.contract import RAW_CONTRACT
from tests.frames import AS_OF, MARCH, edge_rows, raw_rows, row


def test_output_has_the_34_columns_in_order_with_source_types(spark):
    staged = staging.stage(edge_rows(spark), AS_OF)
    assert staged.columns == list(staging.STAGED_COLUMNS)
    assert len(staged.columns) == 34
    expected = {
        name: RAW_CONTRACT[staging.SOURCE_NAMES.get(name, name)] for name in staging.STAGED_COLUMNS
    }
    assert dict(staged.dtypes) == expected
    assert len(staging.ZERO_FILLED) == 26


def test_rows_with_missing_or_negative_counts_are_dropped(spark):
    days = staging.stage(edge_rows(spark), AS_OF).where("country_code = 'DD'").select("date").sort("date").collect()
    assert [day.date for day in days] == [date(2020, 1, 1), date(2021, 12, 31)]


def test_missing_code_is_dropped_and_missing_name_is_kept(spark):
    staged = staging.stage(edge_rows(spark), AS_OF)
    assert staged.where("country_name = 'Nowhere'").count() == 0
    assert staged.where("country_code = 'EE' and country_name is null").count() == 1


def test_gaps_are_filled_or_left(spark):
    only = staging.stage(raw_rows(spark, row(MARCH, "AA", "Alpha")), AS_OF).first()
    assert all(only[name] == 0 for name in staging.ZERO_FILLED if name not in ("new_confirmed",))
    assert all(only[name] is None for name in staging.LEFT_NULL)


def test_brand_columns_are_renamed(spark):
    cells = {f"new_vaccine_doses_administered_{brand}": n for n, brand in enumerate(("pfizer", "moderna", "janssen"), 1)}
    only = staging.stage(raw_rows(spark, row(MARCH, "AA", "Alpha", **cells)), AS_OF).first()
    assert (only.new_doses_pfizer, only.new_doses_moderna, only.new_doses_janssen) == (1, 2, 3)


def test_as_of_defaults_to_today(spark):
    raw = raw_rows(spark, row(date.today(), "AA", "Alpha"), row(date(2999, 1, 1), "AA", "Alpha"))
    assert staging.stage(raw).count() == 1


def test_outcomes_cover_every_row(spark):
    raw = edge_rows(spark)
    outcomes = {r.outcome: r.row_count for r in staging.reject_reasons(raw, AS_OF).collect()}
    assert sum(outcomes.values()) == raw.count()
    assert outcomes["accepted"] == staging.stage(raw, AS_OF).count()
    assert outcomes == {
        "accepted": 15,
        "missing_country_code": 1,
        "missing_date": 1,
        "before_first_day": 1,
        "after_as_of": 1,
        "invalid_new_confirmed": 2,
        "invalid_new_deceased": 2,
    }


def test_optional_row_filter(spark):
    raw = edge_rows(spark)
    country_level = staging.stage(raw, AS_OF, row_filter=F.col("subregion1_name").isNull())
    assert staging.stage(raw, AS_OF).count() - country_level.count() == 1


def test_gap_counts(spark):
    staged = staging.stage(edge_rows(spark), AS_OF)
    counts = {r.column_name: r for r in staging.gap_counts(staged, ("stringency_index", "population")).collect()}
    assert (counts["stringency_index"].null_count, counts["stringency_index"].zero_count) == (0, 14)
    assert (counts["population"].null_count, counts["population"].zero_count) == (12, 1)
