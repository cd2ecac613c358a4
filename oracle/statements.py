"""One SQL statement per query, for a run of the same question on another engine."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from oracle.blocks import (
    CAPPED_CFR,
    CFR,
    CORRECTED,
    COVERAGE,
    FILLED,
    HOSPITALIZATION,
    KEPT,
    KEYS,
    RAW,
    RAW_WITH_K,
    base,
    capped_pct,
    pct,
    rounded,
    staged,
    union,
    with_models,
)
from tallyward.operators import marts, staging
from tallyward.sources.star_schema import RAW_EXPRESSIONS

RUN_DAYS = ("2020-01-15", "2020-06-30", "2020-12-31")

_LOOKBACK = "range between interval 14 days preceding and interval 1 day preceding"


# --- staging ---------------------------------------------------------------------------------------------------


def _gaps(columns: list[str]) -> str:
    return with_models(
        union(
            *[
                f"select '{name}' as column_name, count(*) filter (where {name} is null) as null_count,"
                f" count(*) filter (where {name} = 0) as zero_count, count(*) as row_count from stg"
                for name in columns
            ]
        )
    )


REJECTS = with_models(
    """select case when country_code is null then 'missing_country_code'
        when date is null then 'missing_date'
        when date < date '2020-01-01' then 'before_first_day'
        when date > date '2020-12-31' then 'after_as_of'
        when new_confirmed is null or new_confirmed < 0 then 'invalid_new_confirmed'
        when new_deceased is null or new_deceased < 0 then 'invalid_new_deceased'
        else 'accepted' end as outcome, count(*) as row_count
    from raw group by 1"""
)


# --- column tests ----------------------------------------------------------------------------------------------

# The block that a model is read from, and its columns that are tested.
_TESTED = {
    "stg_covid19": (
        "stg",
        (
            "date",
            "country_code",
            "country_name",
            "new_confirmed",
            "new_deceased",
            "new_hospitalized_patients",
            "new_vaccine_doses_administered",
            "stringency_index",
        ),
    ),
    "mart_covid19_country_metrics": ("country", ("country_code", "date", "total_new_cases")),
    "mart_pandemic_impact": (
        "impact",
        (
            "date",
            "country_code",
            "country_name",
            "total_new_cases",
            "total_new_deaths",
            "current_icu_patients",
            "current_ventilator_patients",
        ),
    ),
    "mart_vaccination_effectiveness": (
        "vaccination",
        (
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
    ),
    "mart_government_response": (
        "government",
        (
            "date",
            "country_code",
            "country_name",
            "school_closing",
            "stay_at_home_requirements",
            "international_travel_controls",
            "total_new_cases",
            "total_new_deaths",
        ),
    ),
}


def _test(model: str, test: str, column: str, failures: str, source: str) -> str:
    return (
        f"select '{model}' as model, '{test}' as test, '{column}' as column_name, {failures} as failures,"
        f" {failures} = 0 as passed from {source}"
    )


def _not_null_parts(model: str) -> list[str]:
    source, columns = _TESTED[model]
    return [
        _test(model, "not_null", column, f"count(*) filter (where {column} is null)", source)
        for column in columns
    ]


COLUMN_TESTS = union(*[part for model in _TESTED for part in _not_null_parts(model)])

POLICY_LEVELS = with_models(
    union(
        *[
            _test(
                "mart_government_response",
                "accepted_values",
                column,
                f"count(*) filter (where {column} not between 0 and {top})",
                "government",
            )
            for column, top in (
                ("school_closing", 3),
                ("workplace_closing", 3),
                ("cancel_public_events", 2),
                ("restrictions_on_gatherings", 4),
                ("stay_at_home_requirements", 3),
                ("international_travel_controls", 4),
            )
        ]
    )
)

UNIQUE = with_models(
    union(
        *[
            _test(
                model,
                "unique",
                columns,
                "count(*)",
                f"(select 1 from {source} group by {columns} having count(*) > 1) as repeats",
            )
            for model, source, columns in (
                ("mart_pandemic_impact", "impact", KEYS),
                ("stg_covid19", "stg", "date, country_code, subregion1_name"),
            )
        ]
    )
)

_KEY = "date, country_code, subregion1_name"
INCREMENTAL_UNIQUE = f"""with {RAW_WITH_K}, raw as (select * from uncut),
    valid as (select {_KEY}, k % 3 as batch from raw where country_code is not null
        and date between date '2020-01-01' and date '2020-12-31' and new_confirmed >= 0 and new_deceased >= 0),
    keyed as (select {_KEY}, batch, count(*) as n, min(batch) over (partition by {_KEY}) < batch as known from valid group by {_KEY}, batch)
    select batch, cast(sum(n) as bigint) as row_count, count(*) as key_count, count(*) filter (where n > 1) as repeated,
        count(*) filter (where known) as seen_before, count(*) filter (where n > 1 or known) = 0 as passed from keyed group by batch"""

_COUNTRIES = "(select {0} as country_code, n_name as country_name from nation) as countries".format(RAW_EXPRESSIONS["country_code"])

RELATIONSHIPS = with_models(
    union(
        *[
            _test(
                "stg_covid19",
                "relationships",
                column,
                "count(*)",
                f"stg where {column} is not null and {column} not in"
                f" (select {column} from {_COUNTRIES} where {column} is not null)",
            )
            for column in ("country_code", "country_name")
        ]
    )
)


# --- expectations ----------------------------------------------------------------------------------------------


class _Suite:
    """Statements of one suite, a select per rule."""

    def __init__(self, source: str, extra: str = "") -> None:
        self.source, self.extra, self.parts = source, extra, []

    def _add(self, rule: str, column: str | None, success: str, values: dict[str, str]) -> _Suite:
        listed = {
            "missing_count": "cast(null as bigint)",
            "unexpected_count": "cast(null as bigint)",
            "unexpected_percent": "cast(null as double)",
            "observed": "cast(null as double)",
        } | values
        name = f"'{column}'" if column else "cast(null as varchar)"
        self.parts.append(
            f"select {self.extra}{len(self.parts) + 1} as rule_id, '{rule}' as expectation, {name} as column_name,"
            f" {success} as success, count(*) as element_count, "
            + ", ".join(f"{expression} as {name}" for name, expression in listed.items())
            + f" from {self.source}"
        )
        return self

    def rows(self, at_least: int) -> _Suite:
        return self._add(
            "table_row_count_between", None, f"count(*) >= {at_least}", {"observed": "cast(count(*) as double)"}
        )

    def exists(self, column: str) -> _Suite:
        return self._add("column_exists", column, "true", {})

    def of_type(self, column: str) -> _Suite:
        return self._add("column_of_type", column, "true", {})

    def absent(self, rule: str, column: str) -> _Suite:
        return self._add(rule, column, "false", {})

    def not_null(self, column: str) -> _Suite:
        missing = f"count(*) filter (where {column} is null)"
        return self._add(
            "values_not_null",
            column,
            f"{missing} = 0",
            {
                "missing_count": missing,
                "unexpected_count": missing,
                "unexpected_percent": f"cast({missing} as double) / nullif(count(*), 0) * 100",
            },
        )

    def values(self, rule: str, column: str, good: str, mostly: float = 1.0) -> _Suite:
        bad = f"count(*) filter (where {column} is not null and not ({good}))"
        some = f"count({column})"
        return self._add(
            rule,
            column,
            f"({some} = 0 or cast({some} - {bad} as double) / nullif({some}, 0) >= {mostly})",
            {
                "missing_count": f"count(*) - {some}",
                "unexpected_count": bad,
                "unexpected_percent": f"cast({bad} as double) / nullif({some}, 0) * 100",
            },
        )

    def extreme(self, function: str, column: str, low: float, high: float | None = None) -> _Suite:
        value = f"{function}({column})"
        upper = f" and {value} <= {high}" if high is not None else ""
        return self._add(
            f"column_{function}_between",
            column,
            f"coalesce({value} >= {low}{upper}, false)",
            {"observed": f"cast({value} as double)"},
        )


def impact_suite(source: str = "impact", extra: str = "", hospital: bool = True) -> list[str]:
    suite = _Suite(source, extra).rows(1000)
    for column in ("date", "country_code", "country_name", "total_new_cases", "total_new_deaths"):
        suite.exists(column)
    suite.not_null("date").not_null("country_code")
    suite.values("value_lengths_between", "country_code", "length(country_code) = 2")
    suite.values("values_match_regex", "country_code", "regexp_matches(country_code, '^[A-Z]{2}$')")
    suite.extreme("min", "total_new_cases", 0).extreme("min", "total_new_deaths", 0)
    suite.values("values_between", "case_fatality_rate", "case_fatality_rate between 0 and 1000", 0.99)
    for column in ("current_icu_patients", "current_ventilator_patients"):
        if hospital:
            suite.extreme("min", column, 0)
        else:
            suite.absent("column_min_between", column)
    return suite.parts


def vaccination_suite() -> list[str]:
    suite = _Suite("vaccination").rows(1000).exists("vaccination_coverage_pct")
    suite.not_null("date").not_null("country_code")
    suite.values("values_match_regex", "country_code", "regexp_matches(country_code, '^[A-Z]{2}$')")
    suite.of_type("total_new_doses")
    for column in ("total_new_vaccinated", "total_new_fully_vaccinated", "total_new_doses"):
        suite.extreme("min", column, 0)
    return suite.values(
        "values_between", "vaccination_coverage_pct", "vaccination_coverage_pct between 0 and 100", 0.99
    ).parts


def government_suite() -> list[str]:
    suite = _Suite("government").rows(1000).exists("avg_stringency_index")
    suite.not_null("date").not_null("country_code")
    suite.values("values_match_regex", "country_code", "regexp_matches(country_code, '^[A-Z]{2}$')")
    suite.values("values_between", "avg_stringency_index", "avg_stringency_index between 0 and 100")
    for column, top in (("school_closing", 3), ("stay_at_home_requirements", 3), ("international_travel_controls", 4)):
        suite.extreme("max", column, 0, top)
    return suite.values("values_between", "avg_hdi", "avg_hdi between 0 and 1").parts


def _runs() -> tuple[list[str], str]:
    """Impact suite as of each run day: (blocks over raw, union of the results)."""
    blocks, results = [], []
    for number, today in enumerate(RUN_DAYS):
        blocks.append(staged(today, f"stg{number}"))
        blocks.append(base(f"stg{number}", f"base{number}"))
        blocks.append(
            f"impact{number} as (select *, {CAPPED_CFR} as case_fatality_rate from base{number})"
        )
        results += impact_suite(f"impact{number}", f"'{today}' as run_id, ")
    return blocks, union(*results)


_RUN_BLOCKS, _RUN_RESULTS = _runs()

_WITH_RUNS = ", ".join([RAW, *_RUN_BLOCKS])
VALIDATION_HISTORY = f"with {_WITH_RUNS} {_RUN_RESULTS}"

_TEST_HISTORY_ROWS = f"""select rule_id, expectation, column_name, count(*) as runs, count(*) filter (where success) as passes,
        {rounded("cast(count(*) filter (where success) as double) / count(*)", 6)} as pass_rate,
        max(run_id) as last_run, arg_max(success, run_id) as last_passed
    from ({_RUN_RESULTS}) as results group by rule_id, expectation, column_name"""
TEST_HISTORY = f"with {_WITH_RUNS} {_TEST_HISTORY_ROWS}"


def strict_suite(source: str, model: str, rules: int) -> list[str]:
    suite = _Suite(source, f"'{model}' as model, ").rows(1000).not_null("country_code")
    suite.values("values_between", "case_fatality_rate", "case_fatality_rate between 0 and 50")
    return suite.parts[:rules]


def _evidence(rule: int, name: str, column: str, breaks: str) -> str:
    return (
        f"select {rule} as rule_id, '{name}' as expectation, '{column}' as column_name, cast({column} as varchar) as value,"
        " count(*) as row_count, min('date=' || coalesce(cast(date as varchar), 'NULL') || ', country_code='"
        " || coalesce(country_code, 'NULL') || ', country_name=' || coalesce(country_name, 'NULL')) as example"
        f" from impact where {breaks} group by {column}"
    )


_BROKEN = union(
    _evidence(3, "values_not_null", "avg_hospital_beds_per_1000", "avg_hospital_beds_per_1000 is null"),
    _evidence(4, "value_lengths_between", "country_name", "length(country_name) > 7"),
    _evidence(5, "values_match_regex", "country_code", "not regexp_matches(country_code, '^[A-M][A-Z]$')"),
    _evidence(6, "values_between", "case_fatality_rate", "case_fatality_rate not between 0 and 20"),
    _evidence(7, "column_min_between", "total_new_cases", "total_new_cases < 30"),
    _evidence(8, "column_max_between", "total_new_deaths", "total_new_deaths > 10"),
    _evidence(9, "values_not_null", "date", "date is null"),
)
EVIDENCE = with_models(
    f"""select rule_id, expectation, column_name, cast(position as integer) as position, value, row_count, example
        from (select *, row_number() over (partition by rule_id order by md5(coalesce(value, '')), value nulls first) as position
            from ({_BROKEN}) as broken) as ranked where position <= 5"""
)


def _outcome(mode: str) -> str:
    rules = union(*strict_suite("impact", "mart_pandemic_impact", 3))
    failed = "count(*) filter (where not success)"
    raises = f"{failed} > 0" if mode == "raise" else "false"
    return f"select '{mode}' as on_bad_data, count(*) as evaluated, {failed} as failed, {raises} as raises from ({rules}) as results"


# --- observability ---------------------------------------------------------------------------------------------

_STRINGS = ("country_code", "country_name", "subregion1_name")


def _metric(column: str, metric: str, expression: str, source: str, keys: str = "") -> str:
    grouped = f" group by {keys}" if keys else ""
    prefix = f"{keys}, " if keys else ""
    return (
        f"select {prefix}'{column}' as column_name, '{metric}' as metric,"
        f" {rounded(f'cast({expression} as double)', 6)} as value from {source}{grouped}"
    )


def _column_metrics(source: str, columns: list[str], strings: tuple[str, ...]) -> str:
    parts = []
    for column in columns:
        metrics = {
            "row_count": "count(*)",
            "null_count": f"count(*) - count({column})",
            "null_percent": f"(cast(count(*) - count({column}) as double) / nullif(count(*), 0) * 100)",
        }
        if column in strings:
            metrics |= {
                "min_length": f"min(length({column}))",
                "max_length": f"max(length({column}))",
                "average_length": f"avg(length({column}))",
                "empty_count": f"count(*) filter (where {column} = '')",
            }
        elif column != "date":
            metrics |= {
                "min": f"min({column})",
                "max": f"max({column})",
                "average": f"avg({column})",
                "standard_deviation": f"stddev_samp({column})",
                "zero_count": f"count(*) filter (where {column} = 0)",
            }
        parts += [_metric(column, metric, expression, source) for metric, expression in metrics.items()]
    return union(*parts)


def _scored(source: str, keys: str, bucket: str, value: str, columns: str) -> str:
    window = f"(partition by {keys} order by {bucket} {_LOOKBACK})"
    return f"""select {columns}, history_count, {rounded("mean", 6)} as history_mean, anomaly_score,
        coalesce(abs(anomaly_score) > 3, false) as is_anomalous
    from (select *, case when history_count >= 7 and spread > 1e-9 * greatest(1.0, abs(mean))
            then {rounded(f"({value} - mean) / nullif(spread, 0)", 6)} end as anomaly_score
        from (select *, count({value}) over {window} as history_count, avg({value}) over {window} as mean,
                stddev_samp({value}) over {window} as spread from ({source}) as series) as windowed) as scored"""


_DOUBLES = ("hospital_beds_per_1000", "stringency_index", "human_development_index")


def _daily_metrics(column: str) -> str:
    """All statistics of a measure by day; the deviation from the sum of squares."""
    n, total = f"cast(count({column}) as double)", f"cast(sum({column}) as double)"
    squares = f"sum(cast({column} as double) * cast({column} as double))"
    variance = f"({n} * {squares} - {total} * {total}) / case when {n} > 1 then {n} * ({n} - 1) end"
    missing = f"count(*) - count({column})"
    metrics = {
        "row_count": "count(*)",
        "null_count": missing,
        "null_percent": f"(cast({missing} as double) / nullif(count(*), 0) * 100)",
        "min": f"min({column})",
        "max": f"max({column})",
        "average": f"({total} / nullif({n}, 0))",
        "standard_deviation": f"case when {n} > 1 then sqrt(greatest({variance}, 0)) end",
        "zero_count": f"count(*) filter (where {column} = 0)",
    }
    return union(*[_metric(column, metric, f"({expression})", "stg", "date") for metric, expression in metrics.items()])


_DAILY = union(*[_daily_metrics(column) for column in (*FILLED, *KEPT)])

_METRIC_SCORES = _scored(_DAILY, "column_name, metric", "date", "value", "date, column_name, metric, value")
METRIC_ANOMALY = with_models(_METRIC_SCORES)
METRIC_TESTS = with_models(
    f"""select column_name, metric, count(anomaly_score) as scored, count(*) filter (where is_anomalous) as anomalies,
        max(date) as last_bucket, not arg_max(is_anomalous, date) as passed
    from ({_METRIC_SCORES}) as scores group by column_name, metric"""
)

# Columns whose distributions are watched: texts, and numbers.
_WATCHED_TEXTS = ("subregion1_name",)
_WATCHED = ("new_confirmed", "cumulative_confirmed", "current_hospitalized_patients", "stringency_index", "population")
_PERIODS = {"day": "date", "month": "cast(date_trunc('month', date) as date)"}


def _by_period(select: str, columns: Iterable[str]) -> str:
    """A select per kind of period and column, with {column} in its place."""
    return union(
        *[
            f"select '{kind}' as kind, {period} as period, '{column}' as column_name, {select.format(column=column)} from stg group by {period}"
            for kind, period in _PERIODS.items()
            for column in columns
        ]
    )


DAILY_DISTINCT = with_models(_by_period("count(distinct {column}) as distinct_count, true as is_close", [*_WATCHED_TEXTS, *_WATCHED]))
_QUANTILES = union(
    *[
        _by_period(
            f"cast({quantile} as double) as quantile, count({{column}}) as value_count, {extreme} as extreme, true as is_close", _WATCHED
        )
        for quantile, extreme in (
            (0.0, "cast(min({column}) as double)"),
            (0.25, "cast(null as double)"),
            (0.5, "cast(null as double)"),
            (0.75, "cast(null as double)"),
            (0.95, "cast(null as double)"),
            (1.0, "cast(max({column}) as double)"),
        )
    ]
)
DAILY_QUANTILES = with_models(f"select * from ({_QUANTILES}) as quantiles where value_count > 0")
DAILY_LENGTHS = with_models(
    union(
        *[
            _by_period(f"'{metric}' as metric, {rounded(f'cast({value} as double)', 6)} as value", _WATCHED_TEXTS)
            for metric, value in {
                "value_count": "count({column})",
                "empty_count": "count(*) filter (where {column} = '')",
                "min_length": "min(length({column}))",
                "max_length": "max(length({column}))",
                "average_length": "avg(length({column}))",
            }.items()
        ]
    )
)

_CLASSES = union(
    *[
        f"""select date, '{column}' as column_name, classes.class, count({column}) filter (where class_of = classes.class) as n
            from (select date, {column}, case when {column} < 1 then 0
                when {column} >= 16384 then 15 else cast(floor(log2({column})) as integer) + 1 end as class_of from turned) as classed,
                (select unnest(range(16)) as class) as classes
            group by date, classes.class"""
        for column in _WATCHED
    ]
)
DISTRIBUTION_ANOMALY = with_models(
    f"""select date, column_name, cast(value_count as bigint) as value_count, history_days, cast(history_count as bigint) as history_count,
            case when history_days >= 7 then psi end as psi, case when history_days >= 7 then ks end as ks,
            coalesce(history_days >= 7 and psi > 0.2
                and ks > 1.63 * sqrt((value_count + history_count) / nullif(cast(value_count as double) * history_count, 0)), false) as is_anomalous
        from (select date, column_name, any_value(total) as value_count, any_value(days) as history_days, any_value(total_before) as history_count,
                {rounded("sum((now - past) * ln(now / past))", 6)} as psi, {rounded("max(abs(share - share_before))", 6)} as ks
            from (select *, (n + 0.5) / (total + 8.0) as now, (before + 0.5) / (total_before + 8.0) as past,
                    cast(sum(n) over upto as double) / nullif(total, 0) as share,
                    cast(sum(before) over upto as double) / nullif(total_before, 0) as share_before
                from (select *, cast(sum(n) over day as double) as total, cast(sum(before) over day as double) as total_before
                    from (select *, coalesce(sum(n) over earlier, 0) as before, count(n) over earlier as days from ({_CLASSES}) as classes
                        window earlier as (partition by column_name, class order by date {_LOOKBACK})) as moved
                    window day as (partition by column_name, date)) as totals
                window upto as (partition by column_name, date order by class)) as shares
            group by date, column_name) as compared""",
    "turned as (select * replace (case when date between date '2020-09-10' and date '2020-09-14' then 50 - new_confirmed"
    " else new_confirmed end as new_confirmed) from stg)",
)


def _volume_scores(counts: str, until: str) -> str:
    """Scores of the daily counts in (table_name, date, row_count), with a 0 for each absent day."""
    by_day = "partition by table_name order by date"
    daily = f"""select days.table_name, days.date, coalesce(counted.row_count, 0) as row_count
        from (select table_name, cast(unnest(generate_series(min(date), greatest(max(date), date '{until}'), interval 1 day)) as date) as date
            from ({counts}) as listed group by table_name) as days
        left join ({counts}) as counted on counted.table_name = days.table_name and counted.date = days.date"""
    moved = f"select *, row_count - lag(row_count) over ({by_day}) as change from ({daily}) as daily"
    trend = f"""select table_name, date, row_count, change,
            {rounded("avg(row_count) over recent", 6)} as trailing_mean,
            count(*) filter (where change < 0) over recent = 7 as is_declining
        from ({moved}) as moved window recent as ({by_day} rows between 6 preceding and current row)"""
    return _scored(
        trend, "table_name", "date", "row_count", "table_name, date, row_count, change, trailing_mean, is_declining"
    )


def _every_day(counts: str, until: str) -> str:
    return f"""select days.table_name, days.date, coalesce(counted.row_count, 0) as row_count
        from (select table_name, cast(unnest(generate_series(min(date), greatest(max(date), date '{until}'), interval 1 day)) as date) as date
            from ({counts}) as listed group by table_name) as days
        left join ({counts}) as counted on counted.table_name = days.table_name and counted.date = days.date"""


# The cut-off sums step by step, a day after the other.
_DECLINING = """thinned as (select * from uncut where date is not null
        and k % 1000 < floor(1000 * pow(cast(0.97 as double), greatest(0, date_diff('day', date '2020-09-30', date))))
        and (date_diff('day', date '2020-01-06', date) % 7 < 5 or k % 10 < 6))"""


def _change_points() -> str:
    counts = "select 'stg_covid19' as table_name, date, count(*) as row_count from stg group by date"
    return f"""with recursive {RAW_WITH_K}, {_DECLINING}, raw as (select * exclude (k) from thinned), {staged()},
        days as ({_every_day(counts, "2020-12-31")}),
        expected as (select *, avg(row_count) over (partition by table_name, dayofweek(date) order by date
            rows between 4 preceding and 1 preceding) as expected from days),
        differing as (select *, (row_count - expected) / greatest(expected, 1.0) as deviation from expected),
        spreads as (select *, stddev_samp(deviation) over before as spread, count(deviation) over before as usual,
                row_number() over (partition by table_name order by date) as day
            from differing window before as (partition by table_name order by date rows between 28 preceding and 1 preceding)),
        scored as (select *, case when usual >= 14 then cast(greatest(-3000000, least(3000000,
            round(deviation / greatest(spread, 0.01) * 1000000))) as bigint) end as score from spreads),
        sums as (
            select table_name, day, date, greatest(0, coalesce(-score - 1000000, 0)) as fall, greatest(0, coalesce(score - 1000000, 0)) as rise,
                case when coalesce(-score - 1000000, 0) > 0 then date else date + 1 end as fell,
                case when coalesce(score - 1000000, 0) > 0 then date else date + 1 end as rose
            from scored where day = 1
            union all
            select scored.table_name, scored.day, scored.date,
                greatest(0, sums.fall + coalesce(-score - 1000000, 0)), greatest(0, sums.rise + coalesce(score - 1000000, 0)),
                case when sums.fall + coalesce(-score - 1000000, 0) <= 0 then scored.date + 1 else sums.fell end,
                case when sums.rise + coalesce(score - 1000000, 0) <= 0 then scored.date + 1 else sums.rose end
            from sums join scored on scored.table_name = sums.table_name and scored.day = sums.day + 1),
        points as (select scored.*, sums.fall, sums.rise, fell, rose,
                case when fall >= 5000000 and fall >= rise then 'fall' when rise >= 5000000 then 'rise' end as change
            from scored join sums using (table_name, day))
        select table_name, points.date, row_count, {rounded("expected", 6)} as expected, score / 1000000.0::double as score,
            fall / 1000000.0::double as fall, rise / 1000000.0::double as rise, change,
            cast(case change when 'fall' then fell when 'rise' then rose end as date) as began from points"""


def _newest(scores: str, keys: str) -> str:
    """The last day of each series."""
    return f"select * from ({scores}) as scores qualify row_number() over (partition by {keys} order by date desc) = 1"


def _freshness(table: str, source: str, key: str, today: str, days: int) -> str:
    behind = f"date_diff('day', max(date), date '{today}')"
    return f"""select '{table}' as table_name, case when grouping({key}) = 1 then 'table' else 'key' end as level,
            {key}, max(date) as last_date, {behind} as days_behind, coalesce({behind} <= {days}, false) as is_fresh
        from {source} group by grouping sets (({key}), ())"""


_VOLUME_SCORES = _volume_scores(
    "select 'stg_covid19' as table_name, date, count(*) as row_count from stg group by date", "2020-12-31"
)
_OUTAGE_SCORES = _volume_scores(
    "select 'stg_covid19' as table_name, date, count(*) as row_count from stg"
    " where date not between date '2020-09-10' and date '2020-09-14' and date <= date '2020-12-28' group by date",
    "2020-12-31",
)
_FRESH = _freshness("stg_covid19", "stg", "country_code", "2020-12-31", 1)

_EVENTS = (
    "with occurred as (select event_id, user_id, event_type, value, props, cast(ts as date) as date from events) "
)



def _type(column: str) -> str:
    if column == "date":
        return "date"
    if column in _STRINGS:
        return "string"
    return "double" if column in _DOUBLES else "bigint"


def _drift(column: str, change: str, before: str | None, after: str | None) -> str:
    def quoted(text: str | None) -> str:
        return f"'{text}'" if text else "cast(null as varchar)"

    return (
        f"select 'covid19' as table_name, '{column}' as column_name, '{change}' as change,"
        f" {quoted(before)} as previous_type, {quoted(after)} as current_type,"
        " cast(null as bigint) as previous_rows, cast(null as bigint) as current_rows"
    )


_CHANGES = union(
    _drift("school_closing", "type_changed", "int", "bigint"),
    *[
        part
        for brand in ("pfizer", "moderna", "janssen")
        for part in (
            _drift(f"new_vaccine_doses_administered_{brand}", "removed", "bigint", None),
            _drift(f"new_doses_{brand}", "added", None, "bigint"),
        )
    ],
)


_LATER = {
    "deaths": "total_new_deaths",
    "icu_patients": "current_icu_patients",
    "cases_of_next_week": "total_new_cases + 1",
    "week": "extract(week from date)",
}


def _renames() -> str:
    """Exact shares of equal values of the same rows; each is far from the limit."""
    pairs = [(old, new) for old in ("total_new_deaths", "current_icu_patients", "population") for new in _LATER]
    shares = union(
        *[
            f"""select '{old}' as removed, '{new}' as added, count(*) filter (where later and {old} = {_LATER[new]}) / cast(
                    least(count({old}), count({_LATER[new]}) filter (where later)) as double) as common
                from (select *, date < date '2020-12-01' as later from impact) as states"""
            for old, new in pairs
        ]
    )
    return with_models(
        f"""select removed, added, 'number' as kind, common >= 0.9
                and row_number() over (partition by removed order by common desc, added) = 1
                and row_number() over (partition by added order by common desc, removed) = 1 as is_rename
            from ({shares}) as shares"""
    )


def _contract_row(name: str) -> str:
    actual, status = {
        "population": (None, "missing"),
        "school_closing": ("int", "ok"),
        "new_recovered": ("string", "wrong_type"),
    }.get(name, (_type(name), "ok"))
    shown = f"'{actual}'" if actual else "cast(null as varchar)"
    return (
        f"select 'covid19_raw' as table_name, '{name}' as column_name, '{_type(name)}' as expected_type,"
        f" {shown} as actual_type, '{status}' as status"
    )


_ODD_CONTRACT = union(
    *[_contract_row(name) for name in RAW_EXPRESSIONS],
    "select 'covid19_raw', 'remark', cast(null as varchar), 'string', 'not_in_contract'",
)

_CONTRACT = union(*[f"select 'ok' as status, count({name}) as filled from raw" for name in RAW_EXPRESSIONS])

_RATES = ("case_fatality_rate", "hospitalization_rate", "vaccination_coverage_pct")


def _catalog(model: str, columns: Iterable[str], texts: Mapping[str, str]) -> str:
    def row(column: str) -> str:
        kind = "double" if column.startswith("avg_") or column in _RATES else _type(column)
        text = f"'{texts[column]}'" if column in texts else "cast(null as varchar)"
        return (
            f"select '{model}' as model, '{marts.MODEL_DESCRIPTIONS[model]}' as model_description,"
            f" '{column}' as column_name, '{kind}' as data_type, {text} as description"
        )

    return union(*[row(column) for column in columns])


# The wording is the package's own documentation; which columns a model has, and their types, are said here once more.
MODEL_CATALOG = union(
    _catalog(
        "stg_covid19",
        ["date", "country_code", "country_name", "subregion1_name", *FILLED, *KEPT],
        staging.DESCRIPTIONS,
    ),
    _catalog("mart_covid19_country_metrics", marts.COUNTRY_METRICS, marts.DESCRIPTIONS),
    _catalog("mart_pandemic_impact", marts.PANDEMIC_IMPACT, marts.DESCRIPTIONS),
    _catalog("mart_vaccination_effectiveness", marts.VACCINATION_EFFECTIVENESS, marts.DESCRIPTIONS),
    _catalog("mart_government_response", marts.GOVERNMENT_RESPONSE, marts.DESCRIPTIONS),
)

# Runs, stages and times as they are in the events.
_LOG = """(select printf('%08d', event_id) as run_id, event_type as stage,
    case when event_id % 10 = 0 then 'failed' else 'succeeded' end as status, ts as started_at,
    cast(floor(value * 1000) as bigint) / 1000.0 as seconds from events) as log"""


def _times(kind: str) -> str:
    return f"""select stage, '{kind}' as kind, count(*) as runs, count(*) filter (where status = 'failed') as failures,
        {rounded("avg(cast(seconds as double))", 6)} as mean_seconds, max(cast(seconds as double)) as max_seconds,
        quantile_disc(cast(seconds as double), 0.5) as median_seconds,
        arg_max(status = 'failed', (started_at, run_id)) as last_failed
    from {_LOG} group by stage"""


def _area(area: str, source: str, good: str) -> str:
    bad = f"count(*) filter (where not coalesce({good}, false))"
    return (
        f"select '{area}' as area, count(*) as checked, {bad} as failed, {bad} = 0 and count(*) > 0 as passed"
        f" from ({source}) as results"
    )


MODEL_ROWS = union(
    "select 'stg_covid19' as model, count(*) as row_count from stg",
    "select 'daily_country_base' as model, count(*) as row_count from base",
    "select 'mart_covid19_country_metrics' as model, count(*) as row_count from country",
    "select 'mart_pandemic_impact' as model, count(*) as row_count from impact",
    "select 'mart_vaccination_effectiveness' as model, count(*) as row_count from vaccination",
    "select 'mart_government_response' as model, count(*) as row_count from government",
)
MODEL_ROW_COUNTS = with_models(MODEL_ROWS)

_ALL_COLUMNS = union(*[f"select '{name}' as column_name" for name in RAW_EXPRESSIONS])
_DRIFT_STATUS = f"select change from ({_ALL_COLUMNS}) as listed full join ({_CHANGES}) as changes using (column_name)"

# Blocks of the earlier runs lie beside those of this one; raw is common to both.
REPORT = with_models(
    union(
        _area("column_tests", COLUMN_TESTS, "passed"),
        _area("expectations", union(*impact_suite()), "success"),
        _area("freshness", _FRESH, "is_fresh"),
        _area("volume_anomalies", _newest(_VOLUME_SCORES, "table_name"), "not is_anomalous"),
        _area("metric_anomalies", _newest(_METRIC_SCORES, "column_name, metric"), "not is_anomalous"),
        _area("schema_contract", _CONTRACT, "status = 'ok'"),
        _area("test_history", _TEST_HISTORY_ROWS, "last_passed"),
        _area("run_log", f"select status from {_LOG}", "status <> 'failed'"),
        _area("model_row_counts", MODEL_ROWS, "row_count > 0"),
        _area("run_times", _times("stage"), "not last_failed"),
        _area("schema_changes", _DRIFT_STATUS, "change is null"),
    ),
    *_RUN_BLOCKS,
)

_STAGES = (
    ("extract", "(select count(*) from raw)"),
    ("load", None),
    ("freshness_gate", None),
    ("models", "(select count(*) from base)"),
    ("column_tests", "36"),
    ("expectations", "15"),
    ("report", None),
)


_SUMMARY = union(
    *[
        f"select {position} as position, '{stage}' as stage, 'succeeded' as status, cast({rows or 'null'} as bigint) as row_count"
        for position, (stage, rows) in enumerate(_STAGES, start=1)
    ]
)


# --- dashboards ------------------------------------------------------------------------------------------------


def _latest(source: str, columns: str) -> str:
    return (
        f"select country_code, country_name, date as last_date, {columns} from (select *, row_number() over"
        f" (partition by country_code, country_name order by date desc) as place from {source}) as ranked"
        " where place = 1"
    )


_CASES = "cast(sum(total_new_cases) as bigint)"
_DEATHS = "cast(sum(total_new_deaths) as bigint)"

_HDI = (
    f"select country_code, country_name, {rounded('avg(avg_hdi)', 6)} as avg_hdi,"
    f" {pct('sum(total_new_deaths)', 'sum(total_new_cases)')} as case_fatality_rate"
    " from government group by country_code, country_name"
)

_GDP = with_models(
    _latest("(select *, " + COVERAGE + " as vaccination_coverage_pct from base) as base_with_rate",
            "avg_gdp_per_capita, vaccination_coverage_pct")
)


def _brand(label: str) -> str:
    column = f"total_doses_{label.lower()}"
    everything = "sum(total_doses_pfizer) + sum(total_doses_moderna) + sum(total_doses_janssen)"
    return (
        f"select '{label}' as brand, cast(sum({column}) as bigint) as doses,"
        f" {pct(f'sum({column})', f'({everything})')} as share_pct from vaccination"
    )


_COVERED = "cast(sum(total_cumulative_fully_vaccinated) as bigint)"
_PEOPLE = "cast(sum(population) as bigint)"

_SO_FAR = "(partition by country_code, country_name order by date rows unbounded preceding)"


# --- versions --------------------------------------------------------------------------------------------------

_PROFILE = "school_closing, stay_at_home_requirements, international_travel_controls, population"


def _versions() -> str:
    blocks, profiles = [RAW], []
    for number, today in enumerate(RUN_DAYS):
        blocks += [staged(today, f"stg{number}"), base(f"stg{number}", f"base{number}")]
        profiles.append(
            f"select date '{today}' as run_day, country_code, country_name, {_PROFILE}"
            f" from ({_latest(f'base{number}', _PROFILE)}) as latest"
        )
    return f"""with {", ".join(blocks)}, profiles as ({union(*profiles)}),
        changes as (select * from (select *, lag(run_day) over w as previous_run,
                ({_PROFILE}) is distinct from (lag(school_closing) over w, lag(stay_at_home_requirements) over w,
                    lag(international_travel_controls) over w, lag(population) over w) as changed
            from profiles window w as (partition by country_code, country_name order by run_day)) as compared
            where previous_run is null or changed)
        select country_code, country_name, {_PROFILE}, run_day as valid_from,
            lead(run_day) over (partition by country_code, country_name order by run_day) as valid_to
        from changes"""


def _as_of() -> str:
    """Each row of the impact mart beside the version that holds on its day."""
    return with_models(
        f"""select impact.date, impact.country_code, impact.country_name, total_new_cases, total_new_deaths, school_closing,
            stay_at_home_requirements, international_travel_controls, versions.population as profile_population, valid_from, valid_to
        from impact left join ({_versions()}) as versions
            on impact.country_code is not distinct from versions.country_code
            and impact.country_name is not distinct from versions.country_name
            and impact.date >= versions.valid_from and (versions.valid_to is null or impact.date < versions.valid_to)"""
    )


# Gaps between the closed days of each country, and the silence that goes on at the end.
OUTAGES = with_models(
    """select country_code, kind, last_day, cast(case kind when 'silent' then last_day + 6 else following end as date) as day
        from gaps, (select unnest(['silent', 'back']) as kind) as kinds
        where (kind = 'silent' and (following > last_day + 5 or (following is null and last_day + 6 <= closed)))
            or (kind = 'back' and following > last_day + 5)""",
    """present as (select distinct country_code, date from stg
            where not (country_code = 'AN' and date between date '2020-05-10' and date '2020-05-25')
                and not (country_code = 'BO' and date >= date '2020-11-20')),
        gaps as (select country_code, date as last_day, lead(date) over (partition by country_code order by date) as following, closed
            from present, (select max(date) - 7 as closed from present) as closing where date <= closed)""",
)


def _rate(expression: str) -> str:
    return with_models(f"select {KEYS}, {expression} as rate from base")


_RAW_ROWS = f"with {RAW} select * from raw"
_BASE_ROWS = with_models("select * from base")

STATEMENTS: dict[str, str] = {
    "raw_scan": _RAW_ROWS,
    "raw_row_count": f"with {RAW} select count(*) as rows_written, count(*) as rows_in_zone from raw",
    "raw_zone_roundtrip": _RAW_ROWS,
    "raw_zone_by_day": _RAW_ROWS,
    "table_roundtrip": _RAW_ROWS,
    "registered_table": _RAW_ROWS,
    "stg_as_view": with_models("select * from stg"),
    "mart_as_table": with_models("select * from impact"),
    "validation_sample_count": with_models("select count(*) as row_count from impact"),
    "stg_covid19": with_models("select * from stg"),
    "stg_nulls_filled": _gaps(FILLED),
    "stg_nulls_kept": _gaps(KEPT),
    "stg_reject_reasons": REJECTS,
    "freshness_gate": f"with {RAW} select count(*) > 0 as passed from raw where date = date '2020-12-30'",
    "daily_country_base": _BASE_ROWS,
    "mart_country_metrics": with_models("select * from country"),
    "mart_pandemic_impact": with_models("select * from impact"),
    "mart_vaccination": with_models("select * from vaccination"),
    "mart_government": with_models("select * from government"),
    "cfr_uncapped": _rate(CFR),
    "cfr_capped": _rate(CAPPED_CFR),
    "hospitalization_rate": _rate(HOSPITALIZATION),
    "vaccination_coverage": _rate(COVERAGE),
    "impact_filtered": with_models(
        "select * from impact where country_code in ('AN', 'BO', 'HU')"
        " and date between date '2020-03-01' and date '2020-05-31'"
    ),
    "impact_clustered": with_models(
        "select *, 'country' as page from impact where country_code = 'BO'"
        " union all select *, 'day' as page from impact where date = date '2020-05-20'"
    ),
    "not_null_stg": with_models(union(*_not_null_parts("stg_covid19"))),
    "not_null_country": with_models(union(*_not_null_parts("mart_covid19_country_metrics"))),
    "not_null_impact": with_models(union(*_not_null_parts("mart_pandemic_impact"))),
    "not_null_vaccination": with_models(union(*_not_null_parts("mart_vaccination_effectiveness"))),
    "not_null_government": with_models(union(*_not_null_parts("mart_government_response"))),
    "column_tests": with_models(COLUMN_TESTS),
    "test_unique_grain": UNIQUE,
    "incremental_unique": INCREMENTAL_UNIQUE,
    "test_policy_levels": POLICY_LEVELS,
    "test_relationships": RELATIONSHIPS,
    "expectations_impact": with_models(union(*impact_suite())),
    "expectations_summary": with_models(
        "select bool_and(success) as success, count(*) as evaluated, count(*) filter (where success) as passed,"
        f" count(*) filter (where not success) as failed from ({union(*impact_suite())}) as results"
    ),
    "expectations_failures": with_models(
        f"select * from ({union(*impact_suite('country', hospital=False))}) as results where not success"
    ),
    "expectations_evidence": EVIDENCE,
    "expectations_vaccination": with_models(union(*vaccination_suite())),
    "expectations_government": with_models(union(*government_suite())),
    "validation_history": VALIDATION_HISTORY,
    "test_history": TEST_HISTORY,
    "suite_replaced": with_models(
        union(
            *strict_suite("impact", "mart_pandemic_impact", 3), *strict_suite("country", "mart_covid19_country_metrics", 2)
        )
    ),
    "validation_outcomes": with_models(union(_outcome("report"), _outcome("raise"))),
    "run_log": with_models(
        f"select *, cast(null as varchar) as detail, true as in_order from ({_SUMMARY}) as summary"
    ),
    "run_summary": with_models(_SUMMARY),
    "pipeline_summary": with_models(_SUMMARY),
    "monitoring_tables": with_models(
        union(
            *[
                f"select 'watch_{name}' as table_name, cast({rows} as bigint) as row_count"
                for name, rows in (
                    ("column_tests", "36"),
                    ("expectations", "15"),
                    ("schema_snapshot", "34"),
                    ("model_log", "5"),
                    ("model_row_counts", "6"),
                    ("arrivals", "(select count(*) from (select distinct date, country_code from stg) as pairs)"),
                    ("report", "12"),
                )
            ]
        )
    ),
    "model_run_times": union(_times("stage"), _times("model")),
    "model_row_counts": MODEL_ROW_COUNTS,
    "column_metrics": f"with {RAW} {_column_metrics('raw', list(RAW_EXPRESSIONS), _STRINGS)}",
    "metric_anomaly": METRIC_ANOMALY,
    "metric_anomaly_tests": METRIC_TESTS,
    "distinct_estimates": f"with {RAW} "
    + union(
        *[
            f"select '{name}' as column_name, count(distinct {name}) as distinct_count, true as is_close from raw"
            for name in RAW_EXPRESSIONS
        ]
    ),
    "daily_distinct": DAILY_DISTINCT,
    "daily_quantiles": DAILY_QUANTILES,
    "daily_lengths": DAILY_LENGTHS,
    "distribution_anomaly": DISTRIBUTION_ANOMALY,
    "volume_anomaly": with_models(_VOLUME_SCORES),
    "volume_outage": with_models(_OUTAGE_SCORES),
    "volume_change_point": _change_points(),
    "volume_change_episodes": "select table_name, change, began, min(date) as found, max(date) as last_day, count(*) as days,"
    f" min(row_count) as lowest, max(row_count) as highest from ({_change_points()}) as points"
    " where change is not null group by table_name, change, began",
    "freshness_empty": "select 'stg_covid19' as table_name, 'table' as level, cast(null as varchar) as country_code,"
    " cast(null as date) as last_date, cast(null as bigint) as days_behind, false as is_fresh",
    "freshness": with_models(_FRESH),
    "events_column_metrics": _EVENTS
    + _column_metrics(
        "occurred", ["event_id", "user_id", "event_type", "value", "props", "date"], ("event_type", "props")
    ),
    "events_volume_anomaly": _EVENTS
    + _volume_scores(
        "select event_type as table_name, date, count(*) as row_count from occurred group by event_type, date",
        "2024-02-01",
    ),
    "events_freshness": _EVENTS + _freshness("events", "occurred", "event_type", "2024-02-01", 2),
    "schema_changes": _CHANGES,
    "schema_renames": _renames(),
    "schema_contract": _ODD_CONTRACT,
    "contract_usage": f"with {RAW} "
    + union(
        *[
            f"select 'covid19_raw' as table_name, '{name}' as column_name, count({name}) as filled_rows from raw"
            for name in RAW_EXPRESSIONS
        ]
    ),
    "model_catalog": MODEL_CATALOG,
    "dq_report": REPORT,
    "cumulative_by_country": with_models(
        "select country_code, country_name, max(total_cumulative_cases) as total_cumulative_cases"
        " from impact group by country_code, country_name"
    ),
    "daily_cases_deaths": with_models(
        f"select date, {_CASES} as total_new_cases, {_DEATHS} as total_new_deaths from impact group by date"
    ),
    "cfr_top20": with_models(
        f"select country_code, country_name, {_CASES} as total_new_cases, {_DEATHS} as total_new_deaths,"
        f" {capped_pct('sum(total_new_deaths)', 'sum(total_new_cases)')} as case_fatality_rate"
        " from impact group by country_code, country_name"
        " order by case_fatality_rate desc nulls last, country_code, country_name limit 20"
    ),
    "impact_scorecards": with_models(
        "select cast(sum(current_icu_patients) as bigint) as current_icu_patients,"
        " cast(sum(current_ventilator_patients) as bigint) as current_ventilator_patients,"
        " cast(sum(current_hospitalized) as bigint) as current_hospitalized, count(*) as countries from ("
        + _latest("impact", "current_icu_patients, current_ventilator_patients, current_hospitalized")
        + ") as latest"
    ),
    "coverage_scorecard": with_models(
        "select case when grouping(country_code) = 1 then 'all' else 'country' end as scope, country_code, country_name,"
        f" {_COVERED} as fully_vaccinated, {_PEOPLE} as population,"
        f" {pct('sum(total_cumulative_fully_vaccinated)', 'sum(population)')} as vaccination_coverage_pct from ("
        + _latest("vaccination", "total_cumulative_fully_vaccinated, population")
        + ") as latest group by grouping sets ((country_code, country_name), ())"
    ),
    "doses_by_brand": with_models(union(*[_brand(label) for label in ("Pfizer", "Moderna", "Janssen")])),
    "vaccinations_vs_deaths": with_models(
        "select date, cast(sum(total_new_vaccinated) as bigint) as total_new_vaccinated,"
        f" {_DEATHS} as total_new_deaths from vaccination group by date"
    ),
    "vaccination_progress": with_models(
        f"select country_code, country_name, date, max(total_cumulative_vaccinated) over {_SO_FAR} as people_vaccinated,"
        f" max(total_cumulative_fully_vaccinated) over {_SO_FAR} as people_fully_vaccinated from vaccination"
    ),
    "stringency_vs_cases": with_models(
        f"select date, {rounded('avg(avg_stringency_index)', 6)} as avg_stringency_index,"
        f" {_CASES} as total_new_cases from government group by date"
    ),
    "policy_scorecards": with_models(
        _latest("government", "stay_at_home_requirements, school_closing, international_travel_controls")
    ),
    "hdi_vs_cfr": with_models(_HDI),
    "hdi_cfr_correlation": with_models(
        f"select count(*) as countries, {rounded('corr(avg_hdi, case_fatality_rate)', 6)} as correlation"
        f" from ({_HDI}) as points where avg_hdi is not null and case_fatality_rate is not null"
    ),
    "gdp_vs_coverage": _GDP,
    "gdp_vs_coverage_joined": _GDP,
    "incremental_refresh": _BASE_ROWS,
    "country_profile_history": _versions(),
    "impact_with_profile_as_of": _as_of(),
    "streaming_refresh": _BASE_ROWS,
    "incremental_emptied_day": with_models(
        "select * from base where date not in (date '2020-12-05', date '2020-12-31')"
    ),
    "streaming_corrections": f"with {CORRECTED}, {staged()}, {base()} select * from base",
    "streaming_outage": OUTAGES,
    "streaming_closed_days": with_models("select * from base where date <= (select max(date) from stg) - 7"),
}
