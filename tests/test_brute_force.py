"""Staging, marts and checks against plain Python on random rows."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tallyward.operators import column_checks, marts, observability, staging
from tallyward.plans import dashboards
from tallyward.plans.models import build_models
from tallyward.sources.contract import RAW_CONTRACT
from tests.frames import raw_rows

AS_OF = date(2020, 3, 31)


def random_rows(seed: int, count: int = 600) -> list[dict]:
    pick = random.Random(seed)
    rows = []
    for _ in range(count):
        row = {}
        for name, data_type in RAW_CONTRACT.items():
            if data_type == "bigint":
                row[name] = pick.choice([None, -1, 0, 0, pick.randrange(5), pick.randrange(1000)])
            elif data_type == "double":
                row[name] = pick.choice([None, pick.randrange(400) / 4])
        row["date"] = pick.choice([None] + [date(2019, 12, 28) + timedelta(days=pick.randrange(100))] * 9)
        row["country_code"] = pick.choice([None, "AA", "AA", "AA", "AA", "BB", "CC"])
        row["country_name"] = pick.choice([None, "x", "x", "y"])
        row["subregion1_name"] = pick.choice([None, "S1"])
        rows.append(row)
    return rows


def kept(rows: list[dict]) -> list[dict]:
    staged = []
    for row in rows:
        valid = (
            row["country_code"] is not None
            and row["date"] is not None
            and date(2020, 1, 1) <= row["date"] <= AS_OF
            and row["new_confirmed"] is not None
            and row["new_confirmed"] >= 0
            and row["new_deceased"] is not None
            and row["new_deceased"] >= 0
        )
        if valid:
            open_gaps = (*staging.IDENTIFIERS, *staging.LEFT_NULL)
            staged.append({name: 0 if value is None and name not in open_gaps else value for name, value in row.items()})
    return staged


def two_decimals(part, whole, cap=None):
    if not whole or part is None:
        return None
    rate = part / whole * 100
    rate = rate if cap is None else min(rate, cap)
    return float(Decimal(repr(rate)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def largest(values):
    return max((value for value in values if value is not None), default=None)


def average(values):
    present = [value for value in values if value is not None]
    return sum(present) / len(present) if present else None


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(request, spark):
    rows = random_rows(request.param)
    return rows, build_models(raw_rows(spark, *rows), AS_OF)


def grouped(rows: list[dict]) -> dict:
    groups = defaultdict(list)
    for row in kept(rows):
        groups[row["date"], row["country_code"], row["country_name"]].append(row)
    return groups


def test_marts(case):
    rows, models = case
    impact = {(r.date, r.country_code, r.country_name): r for r in models.impact.collect()}
    country = {(r.date, r.country_code, r.country_name): r for r in models.country_metrics.collect()}
    vaccination = {(r.date, r.country_code, r.country_name): r for r in models.vaccination.collect()}
    government = {(r.date, r.country_code, r.country_name): r for r in models.government.collect()}
    groups = grouped(rows)
    assert set(impact) == set(country) == set(vaccination) == set(government) == set(groups)
    for key, members in groups.items():
        def cells(name, members=members):
            return [member[name] for member in members]

        cases, deaths = sum(cells("new_confirmed")), sum(cells("new_deceased"))
        assert (impact[key].total_new_cases, impact[key].total_new_deaths) == (cases, deaths)
        assert country[key].total_new_recovered == sum(cells("new_recovered"))
        assert impact[key].case_fatality_rate == two_decimals(deaths, cases, 100)
        assert country[key].case_fatality_rate == government[key].case_fatality_rate == two_decimals(deaths, cases)
        assert impact[key].hospitalization_rate == two_decimals(
            max(cells("current_hospitalized_patients")), max(cells("cumulative_confirmed"))
        )
        assert impact[key].current_icu_patients == max(cells("current_intensive_care_patients"))
        assert impact[key].avg_hospital_beds_per_1000 == average(cells("hospital_beds_per_1000"))
        assert vaccination[key].total_doses_moderna == sum(cells("new_vaccine_doses_administered_moderna"))
        assert vaccination[key].vaccination_coverage_pct == two_decimals(
            max(cells("cumulative_persons_fully_vaccinated")), largest(cells("population"))
        )
        assert government[key].restrictions_on_gatherings == max(cells("restrictions_on_gatherings"))
        assert government[key].avg_stringency_index == average(cells("stringency_index"))
        assert government[key].avg_gdp_per_capita == average(cells("gdp_per_capita_usd"))
        assert government[key].population == largest(cells("population"))


def test_uniqueness_and_volume(case):
    rows, models = case
    staged = kept(rows)
    keys = defaultdict(int)
    days = defaultdict(int)
    for row in staged:
        days[row["date"]] += 1
        keys[row["date"], row["country_code"], row["subregion1_name"]] += 1
    repeated = column_checks.unique(models.staged, "stg", ["date", "country_code", "subregion1_name"]).first()
    assert repeated.failures == sum(copies > 1 for copies in keys.values())
    volume = {r.date: r.row_count for r in observability.daily_volume(models.staged, "stg").collect()}
    assert volume == days


def test_latest_and_progress(case):
    rows, models = case
    groups = grouped(rows)
    last = {}
    for day, code, name in groups:
        last[code, name] = max(last.get((code, name), day), day)
    cards = {(r.country_code, r.country_name): r for r in dashboards.policy_scorecards(models.government).collect()}
    assert set(cards) == set(last)
    for (code, name), day in last.items():
        assert cards[code, name].last_date == day
        assert cards[code, name].school_closing == max(m["school_closing"] for m in groups[day, code, name])
    for row in dashboards.vaccination_progress(models.vaccination).collect():
        earlier = [
            member["cumulative_persons_vaccinated"]
            for (day, code, name), members in groups.items()
            if (code, name) == (row.country_code, row.country_name) and day <= row.date
            for member in members
        ]
        assert row.people_vaccinated == max(earlier)


def test_grain(case):
    _, models = case
    assert column_checks.unique(models.impact, "m", marts.GRAIN).first().passed
