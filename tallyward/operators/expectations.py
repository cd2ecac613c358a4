"""Expectation suites: rules on a whole frame, all evaluated in a single distributed aggregate.

A rule says which aggregates it needs and when it succeeds; :func:`validate` puts the rules of a suite into one
``agg`` and unfolds the one result row into a row per rule. No row limit applies and no data reaches the driver.
Rules on values skip NULLs and succeed when the share of good values reaches ``mostly`` (also when there are no
values at all); rules on an aggregate fail when the aggregate is NULL.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyward.functions.frames import rows_from_aggregate


class ExpectationsFailed(Exception):
    """A suite had failing rules and the caller asked for an error."""


@dataclass(frozen=True)
class Rule:
    """One expectation. ``column`` is NULL for rules on the table."""

    column: str | None = None

    @property
    def name(self) -> str:
        raise NotImplementedError

    def outcome(self, schema: StructType) -> dict[str, Column]:
        """Aggregates for: success, missing_count, unexpected_count, unexpected_percent, observed."""
        raise NotImplementedError

    def unexpected(self, value: Column) -> Column | None:
        """Whether a value of the column breaks the rule; None for rules that no single value can break."""
        return None


def _outcome(
    success: Column,
    missing: Column | None = None,
    unexpected: Column | None = None,
    unexpected_percent: Column | None = None,
    observed: Column | None = None,
) -> dict[str, Column]:
    none = F.lit(None)
    return {
        "success": success,
        "missing_count": (none if missing is None else missing).cast("bigint"),
        "unexpected_count": (none if unexpected is None else unexpected).cast("bigint"),
        "unexpected_percent": (none if unexpected_percent is None else unexpected_percent).cast("double"),
        "observed": (none if observed is None else observed).cast("double"),
    }


def _within(value: Column, low: float | None, high: float | None) -> Column:
    """Inclusive bounds, open where missing; NULL stays NULL."""
    inside = value.isNotNull()
    if low is not None:
        inside = inside & (value >= low)
    if high is not None:
        inside = inside & (value <= high)
    return inside


@dataclass(frozen=True)
class RowCountBetween(Rule):
    min_value: int | None = None
    max_value: int | None = None
    name = "table_row_count_between"

    def outcome(self, schema: StructType) -> dict[str, Column]:
        rows = F.count(F.lit(1))
        return _outcome(_within(rows, self.min_value, self.max_value), observed=rows)


@dataclass(frozen=True)
class ColumnExists(Rule):
    name = "column_exists"

    def outcome(self, schema: StructType) -> dict[str, Column]:
        return _outcome(F.lit(self.column in schema.names))


@dataclass(frozen=True)
class OfType(Rule):
    """The column has this Spark type, e.g. ``bigint``."""

    type_name: str = ""
    name = "column_of_type"

    def outcome(self, schema: StructType) -> dict[str, Column]:
        found = self.column in schema.names and schema[self.column].dataType.simpleString() == self.type_name
        return _outcome(F.lit(found))


@dataclass(frozen=True)
class ValueRule(Rule):
    """A rule on single values. Subclasses say which non-NULL values are good."""

    mostly: float = 1.0

    def good(self, value: Column) -> Column:
        raise NotImplementedError

    def unexpected(self, value: Column) -> Column:
        return value.isNotNull() & ~self.good(value)

    def outcome(self, schema: StructType) -> dict[str, Column]:
        value = F.col(self.column)
        values = F.count(value)
        bad = F.count_if(self.unexpected(value))
        share_good = F.try_divide(values - bad, values)
        return _outcome(
            F.coalesce(share_good >= self.mostly, F.lit(True)),
            missing=F.count(F.lit(1)) - values,
            unexpected=bad,
            unexpected_percent=F.try_divide(bad, values) * 100,
        )


@dataclass(frozen=True)
class NotNull(ValueRule):
    name = "values_not_null"

    def unexpected(self, value: Column) -> Column:
        return value.isNull()

    def outcome(self, schema: StructType) -> dict[str, Column]:
        rows = F.count(F.lit(1))
        missing = rows - F.count(F.col(self.column))
        share_good = F.try_divide(rows - missing, rows)
        return _outcome(
            F.coalesce(share_good >= self.mostly, F.lit(True)),
            missing=missing,
            unexpected=missing,
            unexpected_percent=F.try_divide(missing, rows) * 100,
        )


@dataclass(frozen=True)
class ValuesBetween(ValueRule):
    min_value: float | None = None
    max_value: float | None = None
    name = "values_between"

    def good(self, value: Column) -> Column:
        return _within(value, self.min_value, self.max_value)


@dataclass(frozen=True)
class LengthsBetween(ValueRule):
    min_value: int | None = None
    max_value: int | None = None
    name = "value_lengths_between"

    def good(self, value: Column) -> Column:
        return _within(F.length(value), self.min_value, self.max_value)


@dataclass(frozen=True)
class MatchesRegex(ValueRule):
    regex: str = ""
    name = "values_match_regex"

    def good(self, value: Column) -> Column:
        return value.rlike(self.regex)


@dataclass(frozen=True)
class AggregateBetween(Rule):
    """A rule on one aggregate of a column."""

    min_value: float | None = None
    max_value: float | None = None

    def observed(self, value: Column) -> Column:
        raise NotImplementedError

    def outcome(self, schema: StructType) -> dict[str, Column]:
        observed = self.observed(F.col(self.column))
        return _outcome(_within(observed, self.min_value, self.max_value), observed=observed)


@dataclass(frozen=True)
class MinBetween(AggregateBetween):
    name = "column_min_between"

    def observed(self, value: Column) -> Column:
        return F.min(value)

    def unexpected(self, value: Column) -> Column | None:
        return None if self.min_value is None else value < self.min_value


@dataclass(frozen=True)
class MaxBetween(AggregateBetween):
    name = "column_max_between"

    def observed(self, value: Column) -> Column:
        return F.max(value)

    def unexpected(self, value: Column) -> Column | None:
        return None if self.max_value is None else value > self.max_value


# The rules of the impact suite, in order.
IMPACT_SUITE: tuple[Rule, ...] = (
    RowCountBetween(min_value=1000),
    ColumnExists("date"),
    ColumnExists("country_code"),
    ColumnExists("country_name"),
    ColumnExists("total_new_cases"),
    ColumnExists("total_new_deaths"),
    NotNull("date"),
    NotNull("country_code"),
    LengthsBetween("country_code", min_value=2, max_value=2),
    MatchesRegex("country_code", regex="^[A-Z]{2}$"),
    MinBetween("total_new_cases", min_value=0),
    MinBetween("total_new_deaths", min_value=0),
    ValuesBetween("case_fatality_rate", min_value=0, max_value=1000, mostly=0.99),
    MinBetween("current_icu_patients", min_value=0),
    MinBetween("current_ventilator_patients", min_value=0),
)

# The same checks carried over to the two marts that have no suite yet, plus bounds of their own measures.
VACCINATION_SUITE: tuple[Rule, ...] = (
    RowCountBetween(min_value=1000),
    ColumnExists("vaccination_coverage_pct"),
    NotNull("date"),
    NotNull("country_code"),
    MatchesRegex("country_code", regex="^[A-Z]{2}$"),
    OfType("total_new_doses", type_name="bigint"),
    MinBetween("total_new_vaccinated", min_value=0),
    MinBetween("total_new_fully_vaccinated", min_value=0),
    MinBetween("total_new_doses", min_value=0),
    ValuesBetween("vaccination_coverage_pct", min_value=0, max_value=100, mostly=0.99),
)
GOVERNMENT_SUITE: tuple[Rule, ...] = (
    RowCountBetween(min_value=1000),
    ColumnExists("avg_stringency_index"),
    NotNull("date"),
    NotNull("country_code"),
    MatchesRegex("country_code", regex="^[A-Z]{2}$"),
    ValuesBetween("avg_stringency_index", min_value=0, max_value=100),
    MaxBetween("school_closing", min_value=0, max_value=3),
    MaxBetween("stay_at_home_requirements", min_value=0, max_value=3),
    MaxBetween("international_travel_controls", min_value=0, max_value=4),
    ValuesBetween("avg_hdi", min_value=0, max_value=1),
)

SUITES: dict[str, tuple[Rule, ...]] = {
    "mart_pandemic_impact": IMPACT_SUITE,
    "mart_vaccination_effectiveness": VACCINATION_SUITE,
    "mart_government_response": GOVERNMENT_SUITE,
}


def bind(name: str, suite: Sequence[Rule], suites: Mapping[str, Sequence[Rule]] | None = None) -> dict[str, tuple[Rule, ...]]:
    """The bindings with ``name`` bound to ``suite``, added or in place of the one it has. The given ones are left as they are."""
    given = SUITES if suites is None else suites
    return {**{mart: tuple(rules) for mart, rules in given.items()}, name: tuple(suite)}


def validate(df: DataFrame, suite: Sequence[Rule]) -> DataFrame:
    """One row per rule: (rule_id, expectation, column_name, success, element_count, missing_count,
    unexpected_count, unexpected_percent, observed).

    A rule on a column the frame does not have fails; the other rules still run.
    """
    rows = []
    for number, rule in enumerate(suite, start=1):
        absent = rule.column is not None and rule.column not in df.columns
        outcome = _outcome(F.lit(False)) if absent else rule.outcome(df.schema)
        success = outcome.pop("success")
        rows.append(
            {
                "rule_id": F.lit(number),
                "expectation": F.lit(rule.name),
                "column_name": F.lit(rule.column).cast("string"),
                "success": success,
                "element_count": F.count(F.lit(1)),
                **outcome,
            }
        )
    return rows_from_aggregate(df, rows)


def validate_marts(marts: Mapping[str, DataFrame], suites: Mapping[str, Sequence[Rule]] | None = None) -> DataFrame:
    """Each mart against the suite bound to its name (in :data:`SUITES` by default); the results carry the ``model``."""
    bound = SUITES if suites is None else suites
    results = [validate(mart, bound[name]).withColumn("model", F.lit(name)) for name, mart in marts.items()]
    return reduce(DataFrame.unionByName, results)


def summarize(results: DataFrame) -> DataFrame:
    """Suite verdict: (success, evaluated, passed, failed)."""
    return results.agg(
        F.coalesce(F.every("success"), F.lit(True)).alias("success"),
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
    )


def failures(results: DataFrame) -> DataFrame:
    """Failing rules with their details."""
    return results.where(~F.col("success"))


def evidence(
    df: DataFrame,
    suite: Sequence[Rule],
    keys: Sequence[str] = (),
    limit: int = 20,
    only: Collection[int] | None = None,
) -> DataFrame:
    """The values that break the rules: (rule_id, expectation, column_name, position, value, row_count, example).

    All rules (or those in ``only``, by their ids) look at the rows in one scan. A rule shows at most ``limit`` different values, with
    all of their rows counted: those with the smallest hashes, so that the choice is the same in each run and does not favour any
    kind of value. ``example`` names, by ``keys``, the first of the rows that hold the value. Rules that no single value breaks (row
    counts, columns and their types, a minimum that is too high) have no evidence.

    Equal values are counted before they are exchanged, and each task sends on only the ``limit`` that can still be shown.
    """
    shown, names = [], {}
    for number, rule in enumerate(suite, start=1):
        if rule.column not in df.columns or (only is not None and number not in only):
            continue
        value = F.col(rule.column)
        if (breaks := rule.unexpected(value)) is not None:
            shown.append(F.when(breaks, F.struct(F.lit(number).alias("rule_id"), value.cast("string").alias("value"))))
            names[number] = (rule.name, rule.column)
    schema = "rule_id int, expectation string, column_name string, position int, value string, row_count bigint, example string"
    if not shown:
        return df.sparkSession.createDataFrame([], schema)
    row = F.concat_ws(", ", *[F.concat(F.lit(f"{key}="), F.coalesce(F.col(key).cast("string"), F.lit("NULL"))) for key in keys])
    found = df.select(row.alias("example"), F.explode(F.array_compact(F.array(*shown))).alias("_found"))
    counted = found.groupBy("_found").agg(F.count(F.lit(1)).alias("row_count"), F.min("example").alias("example"))
    chosen = Window.partitionBy("rule_id").orderBy(F.md5(F.coalesce("value", F.lit(""))), F.col("value").asc_nulls_first())
    ranked = counted.select("_found.*", "row_count", "example").withColumn("position", F.row_number().over(chosen))

    def named(place: int) -> Column:
        texts = F.create_map(*[F.lit(x) for number, name in names.items() for x in (number, name[place])])
        return F.element_at(texts, F.col("rule_id"))

    kept = ranked.where(F.col("position") <= limit)
    return kept.select("rule_id", named(0).alias("expectation"), named(1).alias("column_name"), "position", "value", "row_count", "example")


def require(results: DataFrame) -> None:
    """Raise :class:`ExpectationsFailed` when a rule failed. ``results`` holds one small row per rule."""
    failed = [
        f"{row.rule_id}: {row.expectation}({row.column_name or ''})"
        for row in failures(results).select("rule_id", "expectation", "column_name").collect()
    ]
    if failed:
        raise ExpectationsFailed("; ".join(failed))


def bounded_fetch(df: DataFrame, limit: int | None = None) -> DataFrame:
    """All rows, or at most ``limit`` in no particular order, for looking at data; :func:`validate` does not need it."""
    return df if limit is None else df.limit(limit)


def outcome(results: DataFrame, on_bad_data: str = "report") -> DataFrame:
    """What a run does with the results: (on_bad_data, evaluated, failed, raises)."""
    return summarize(results).select(
        F.lit(on_bad_data).alias("on_bad_data"),
        "evaluated",
        "failed",
        (F.lit(on_bad_data == "raise") & (F.col("failed") > 0)).alias("raises"),
    )
