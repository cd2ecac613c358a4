"""Building blocks of the comparison statements: the same models once more, in SQL for another engine."""

from __future__ import annotations

from tallyward.sources.star_schema import RAW_EXPRESSIONS, ROW_NUMBER

TODAY = "2020-12-31"

_ITEMS = (
    f"(select *, {ROW_NUMBER} as k from lineitem"
    " join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey) as items"
)
_RAW_COLUMNS = ", ".join(f"{expression} as {name}" for name, expression in RAW_EXPRESSIONS.items())
RAW = f"raw as (select {_RAW_COLUMNS} from {_ITEMS})"
RAW_WITH_K = f"uncut as (select {_RAW_COLUMNS}, k from {_ITEMS})"
# The same with every tenth row corrected: 5 cases more, every hundredth invalid.
CORRECTED = (
    f"uncorrected as (select {_RAW_COLUMNS}, k from {_ITEMS}), raw as (select * exclude (k, new_confirmed),"
    " case when k % 100 = 0 then -1 when k % 10 = 0 then new_confirmed + 5 else new_confirmed end as new_confirmed"
    " from uncorrected)"
)

# Measures whose gaps become 0, by source name.
FILLED_SOURCES = (
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
    "new_persons_vaccinated",
    "cumulative_persons_vaccinated",
    "new_persons_fully_vaccinated",
    "cumulative_persons_fully_vaccinated",
    "new_vaccine_doses_administered",
    "cumulative_vaccine_doses_administered",
    "new_vaccine_doses_administered_pfizer",
    "new_vaccine_doses_administered_moderna",
    "new_vaccine_doses_administered_janssen",
    "school_closing",
    "workplace_closing",
    "cancel_public_events",
    "restrictions_on_gatherings",
    "stay_at_home_requirements",
    "international_travel_controls",
    "stringency_index",
)
# Staged name of those that are renamed.
RENAMED = {
    "new_vaccine_doses_administered_pfizer": "new_doses_pfizer",
    "new_vaccine_doses_administered_moderna": "new_doses_moderna",
    "new_vaccine_doses_administered_janssen": "new_doses_janssen",
}
FILLED = [RENAMED.get(name, name) for name in FILLED_SOURCES]
# Measures whose gaps stay.
KEPT = ["hospital_beds_per_1000", "population", "gdp_per_capita_usd", "human_development_index"]


def staged(today: str = TODAY, name: str = "stg") -> str:
    filled = [f"coalesce({source}, 0) as {RENAMED.get(source, source)}" for source in FILLED_SOURCES]
    columns = ["date", "country_code", "country_name", "subregion1_name", *filled, *KEPT]
    return (
        f"{name} as (select {', '.join(columns)} from raw"
        f" where raw.country_code is not null and raw.date between date '2020-01-01' and date '{today}'"
        " and raw.new_confirmed >= 0 and raw.new_deceased >= 0)"
    )


def total(column: str) -> str:
    return f"cast(sum({column}) as bigint)"


def base(source: str = "stg", name: str = "base") -> str:
    measures = {
        "total_new_cases": total("new_confirmed"),
        "total_new_deaths": total("new_deceased"),
        "total_new_recovered": total("new_recovered"),
        "total_new_hospitalized": total("new_hospitalized_patients"),
        "total_new_vaccinated": total("new_persons_vaccinated"),
        "total_new_fully_vaccinated": total("new_persons_fully_vaccinated"),
        "total_new_doses": total("new_vaccine_doses_administered"),
        "total_doses_pfizer": total("new_doses_pfizer"),
        "total_doses_moderna": total("new_doses_moderna"),
        "total_doses_janssen": total("new_doses_janssen"),
        "total_cumulative_cases": "max(cumulative_confirmed)",
        "total_cumulative_deaths": "max(cumulative_deceased)",
        "current_hospitalized": "max(current_hospitalized_patients)",
        "current_icu_patients": "max(current_intensive_care_patients)",
        "current_ventilator_patients": "max(current_ventilator_patients)",
        "total_cumulative_vaccinated": "max(cumulative_persons_vaccinated)",
        "total_cumulative_fully_vaccinated": "max(cumulative_persons_fully_vaccinated)",
        "total_cumulative_doses": "max(cumulative_vaccine_doses_administered)",
        "population": "max(population)",
        "avg_hospital_beds_per_1000": "avg(hospital_beds_per_1000)",
        "avg_stringency_index": "avg(stringency_index)",
        "avg_gdp_per_capita": "avg(gdp_per_capita_usd)",
        "avg_hdi": "avg(human_development_index)",
    }
    for policy in (
        "school_closing",
        "workplace_closing",
        "cancel_public_events",
        "restrictions_on_gatherings",
        "stay_at_home_requirements",
        "international_travel_controls",
    ):
        measures[policy] = f"max({policy})"
    listed = ", ".join(f"{expression} as {column}" for column, expression in measures.items())
    return (
        f"{name} as (select date, country_code, country_name, {listed} from {source}"
        " group by date, country_code, country_name)"
    )


def rounded(expression: str, digits: int) -> str:
    """Half away from zero on the decimal digits of the double, as Spark rounds."""
    return f"cast(round(cast(cast(({expression}) as varchar) as decimal(38, 18)), {digits}) as double)"


def ratio(part: str, whole: str) -> str:
    return f"cast({part} as double) / nullif({whole}, 0) * 100"


def pct(part: str, whole: str) -> str:
    return rounded(ratio(part, whole), 2)


def capped_pct(part: str, whole: str) -> str:
    rate = ratio(part, whole)
    return f"case when ({rate}) is not null then {rounded(f'least({rate}, 100.0)', 2)} end"


CFR = pct("total_new_deaths", "total_new_cases")
CAPPED_CFR = capped_pct("total_new_deaths", "total_new_cases")
HOSPITALIZATION = pct("current_hospitalized", "total_cumulative_cases")
COVERAGE = pct("total_cumulative_fully_vaccinated", "population")

KEYS = "date, country_code, country_name"
COUNTRY_METRICS = (
    "select country_code, country_name, date, total_new_cases, total_new_deaths, total_new_recovered,"
    f" total_cumulative_cases, total_cumulative_deaths, population, {CFR} as case_fatality_rate from base"
)
IMPACT = (
    f"select {KEYS}, total_new_cases, total_new_deaths, total_new_recovered, total_cumulative_cases,"
    " total_cumulative_deaths, total_new_hospitalized, current_hospitalized, current_icu_patients,"
    f" current_ventilator_patients, avg_hospital_beds_per_1000, {CAPPED_CFR} as case_fatality_rate,"
    f" {HOSPITALIZATION} as hospitalization_rate, population from base"
)
VACCINATION = (
    f"select {KEYS}, total_new_vaccinated, total_new_fully_vaccinated, total_cumulative_vaccinated,"
    " total_cumulative_fully_vaccinated, total_new_doses, total_cumulative_doses, total_doses_pfizer,"
    f" total_doses_moderna, total_doses_janssen, total_new_cases, total_new_deaths,"
    f" {COVERAGE} as vaccination_coverage_pct, population from base"
)
GOVERNMENT = (
    f"select {KEYS}, school_closing, workplace_closing, cancel_public_events, restrictions_on_gatherings,"
    " stay_at_home_requirements, international_travel_controls, avg_stringency_index, total_new_cases,"
    f" total_new_deaths, current_hospitalized, {CFR} as case_fatality_rate, population, avg_gdp_per_capita, avg_hdi"
    " from base"
)


def with_models(query: str, *more: str, today: str = TODAY) -> str:
    """``query`` over raw, stg, base and the four marts (impact, vaccination, government, country)."""
    parts = [
        RAW,
        staged(today),
        base(),
        f"impact as ({IMPACT})",
        f"vaccination as ({VACCINATION})",
        f"government as ({GOVERNMENT})",
        f"country as ({COUNTRY_METRICS})",
        *more,
    ]
    return f"with {', '.join(parts)} {query}"


def union(*queries: str) -> str:
    return " union all ".join(queries)
