from __future__ import annotations

import hashlib

import pytest

from tallyward.operators import column_checks as checks
from tallyward.operators import expectations as ex
from tallyward.plans.models import build_models
from tests.frames import AS_OF, MARCH, edge_rows


@pytest.fixture(scope="module")
def models(spark):
    return build_models(edge_rows(spark), AS_OF)


def test_36_declared_tests(models):
    results = checks.declared_tests(models.staged, models.base).collect()
    assert len(results) == 36
    per_model = {}
    for result in results:
        per_model[result.model] = per_model.get(result.model, 0) + 1
    assert sorted(per_model.values()) == [3, 7, 8, 8, 10]
    failed = {(r.model, r.column_name): r.failures for r in results if not r.passed}
    assert failed == {
        ("stg_covid19", "country_name"): 1,
        ("mart_pandemic_impact", "country_name"): 1,
        ("mart_vaccination_effectiveness", "country_name"): 1,
        ("mart_government_response", "country_name"): 1,
    }


@pytest.mark.parametrize(
    ("model", "frame"),
    [
        ("mart_covid19_country_metrics", "country_metrics"),
        ("mart_pandemic_impact", "impact"),
        ("mart_vaccination_effectiveness", "vaccination"),
        ("mart_government_response", "government"),
    ],
)
def test_tests_on_the_base_equal_tests_on_the_mart(models, model, frame):
    alone = checks.not_null(getattr(models, frame), model).collect()
    together = checks.declared_tests(models.staged, models.base).where(f"model = '{model}'").collect()
    assert sorted(alone) == sorted(together)


def test_accepted_values(spark):
    frame = spark.createDataFrame([(0,), (4,), (9,), (None,)], "level int")
    assert checks.accepted_values(frame, "m", {"level": range(5)}).first().failures == 1
    assert checks.accepted_values(frame, "m", {"level": [0, 4, 9]}).first().passed


def test_unique(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None)], "k int, v string")
    assert checks.unique(frame, "m", ["k", "v"]).first().failures == 2
    assert checks.unique(frame, "m", ["k"]).first().failures == 2


def test_relationships(spark):
    child = spark.createDataFrame([(1,), (1,), (3,), (3,), (3,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    result = checks.relationships(child, "m", {"k": (parent, "id")}).first()
    assert (result.column_name, result.failures, result.passed) == ("k", 3, False)
    assert checks.relationships(child.where("k = 1"), "m", {"k": (parent, "id")}).first().failures == 0


def test_relationships_of_several_columns_read_the_child_once(spark, tmp_path):
    spark.createDataFrame([(1, "x"), (2, None), (9, "y")], "k int, v string").write.parquet(str(tmp_path / "child"))
    child = spark.read.parquet(str(tmp_path / "child"))
    numbers = spark.createDataFrame([(1,), (2,)], "id int")
    letters = spark.createDataFrame([("x",), ("y",)], "letter string")
    results = checks.relationships(child, "m", {"k": (numbers, "id"), "v": (letters, "letter")})
    assert results._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {(r.column_name, r.failures) for r in results.collect()} == {("k", 1), ("v", 0)}


def test_identical_rows_without_a_subregion_are_no_unique_key(spark):
    frame = spark.createDataFrame([(MARCH, "AA", None)] * 3, "date date, country_code string, subregion1_name string")
    result = checks.unique(frame, "stg_covid19", ["date", "country_code", "subregion1_name"]).first()
    assert (result.failures, result.passed) == (1, False)


IMPACT = (
    "date date, country_code string, country_name string, total_new_cases bigint, total_new_deaths bigint,"
    " case_fatality_rate double, current_icu_patients bigint, current_ventilator_patients bigint"
)


def impact(spark, count=1000, **cells):
    """``count`` good impact rows; cells give a value for the first row, or a function of the row number."""
    good = {
        "date": MARCH,
        "country_code": "US",
        "country_name": "Somewhere",
        "total_new_cases": 1,
        "total_new_deaths": 1,
        "case_fatality_rate": 1.0,
        "current_icu_patients": 1,
        "current_ventilator_patients": 1,
    }
    rows = []
    for number in range(count):
        row = dict(good)
        for name, value in cells.items():
            if callable(value):
                row[name] = value(number)
            elif number == 0:
                row[name] = value
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, IMPACT)


def failing(frame):
    return [(r.expectation, r.column_name) for r in ex.failures(ex.validate(frame, ex.IMPACT_SUITE)).sort("rule_id").collect()]


def test_good_frame_passes_all_15(spark):
    summary = ex.summarize(ex.validate(impact(spark), ex.IMPACT_SUITE)).first()
    assert tuple(summary) == (True, 15, 15, 0)


def test_too_few_rows(spark):
    assert failing(impact(spark, 999)) == [("table_row_count_between", None)]


def test_absent_column(spark):
    assert failing(impact(spark).drop("date")) == [("column_exists", "date"), ("values_not_null", "date")]


def test_bad_codes(spark):
    assert failing(impact(spark, country_code="usa")) == [
        ("value_lengths_between", "country_code"),
        ("values_match_regex", "country_code"),
    ]
    assert failing(impact(spark, country_code="u1")) == [("values_match_regex", "country_code")]


def test_regex_accepts_a_trailing_line_break_which_the_length_rule_catches(spark):
    assert failing(impact(spark, country_code="US\n")) == [("value_lengths_between", "country_code")]


def test_null_key(spark):
    result = ex.validate(impact(spark, country_code=lambda n: None if n < 5 else "US"), ex.IMPACT_SUITE)
    row = result.where("expectation = 'values_not_null' and column_name = 'country_code'").first()
    assert (row.success, row.missing_count, row.unexpected_count, row.unexpected_percent) == (False, 5, 5, 0.5)


@pytest.mark.parametrize(
    "column", ["total_new_cases", "total_new_deaths", "current_icu_patients", "current_ventilator_patients"]
)
def test_negative_minimum(spark, column):
    assert failing(impact(spark, **{column: -1})) == [("column_min_between", column)]


def test_tolerance(spark):
    assert failing(impact(spark, case_fatality_rate=lambda n: 1001.0 if n < 10 else 1.0)) == []
    assert failing(impact(spark, case_fatality_rate=lambda n: 1001.0 if n < 20 else 1.0)) == [
        ("values_between", "case_fatality_rate")
    ]


def test_nulls_only(spark):
    assert failing(impact(spark, case_fatality_rate=lambda n: None)) == []
    assert failing(impact(spark, total_new_cases=lambda n: None)) == [("column_min_between", "total_new_cases")]


def test_rules_without_a_place_in_the_impact_suite(spark):
    suite = (
        ex.OfType("total_new_cases", type_name="bigint"),
        ex.OfType("total_new_cases", type_name="double"),
        ex.MaxBetween("total_new_cases", max_value=1),
        ex.MaxBetween("total_new_cases", min_value=2),
        ex.RowCountBetween(max_value=10),
    )
    assert [r.success for r in ex.validate(impact(spark), suite).sort("rule_id").collect()] == [True, False, True, False, False]


def test_require(spark):
    ex.require(ex.validate(impact(spark), ex.IMPACT_SUITE))
    with pytest.raises(ex.ExpectationsFailed, match="table_row_count_between"):
        ex.require(ex.validate(impact(spark, 3), ex.IMPACT_SUITE))


def evidence(frame, suite, keys=("date", "country_code"), **options):
    return sorted(tuple(row) for row in ex.evidence(frame, suite, keys, **options).collect())


def test_evidence_holds_the_values_that_break_a_rule(spark):
    frame = impact(
        spark,
        20,
        country_code=lambda n: None if n in (3, 4) else "usa" if n % 2 else "US",
        total_new_cases=lambda n: -n if n > 17 else n,
        case_fatality_rate=lambda n: None if n == 0 else 2000.5 if n == 1 else 1.0,
    )
    nulls, lengths, regex = ("values_not_null", "country_code"), ("value_lengths_between", "country_code"), ("values_match_regex", "country_code")
    # The codes of rows 3 and 4 are missing, which no rule on values counts; odd rows but row 3 hold the long code.
    assert evidence(frame, ex.IMPACT_SUITE) == [
        (8, *nulls, 1, None, 2, "date=2021-03-01, country_code=NULL"),
        (9, *lengths, 1, "usa", 9, "date=2021-03-01, country_code=usa"),
        (10, *regex, 1, "usa", 9, "date=2021-03-01, country_code=usa"),
        *[(11, "column_min_between", "total_new_cases", n, *rest) for n, rest in enumerate(by_hash("-18", "-19"), 1)],
        (13, "values_between", "case_fatality_rate", 1, "2000.5", 1, "date=2021-03-01, country_code=usa"),
    ]
    assert [row[0] for row in evidence(frame, ex.IMPACT_SUITE, only=[8, 13])] == [8, 13]
    assert evidence(frame, ex.IMPACT_SUITE[:6]) == []
    assert evidence(frame.limit(0), ex.IMPACT_SUITE) == []
    assert evidence(frame, ex.IMPACT_SUITE, keys=())[0][-1] == ""


def by_hash(*values):
    codes = {"-18": "US", "-19": "usa"}
    ordered = sorted(values, key=lambda value: hashlib.md5(value.encode()).hexdigest())
    return [(value, 1, f"date=2021-03-01, country_code={codes[value]}") for value in ordered]


def test_evidence_is_bounded_whatever_breaks_the_rule(spark):
    """A value in most rows, and thousands of different ones: both show as one line each, the rows are all counted."""
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, id, -1) as v", "id as k")
    suite = (ex.ValuesBetween("v", min_value=30_000), ex.MaxBetween("v", max_value=-2), ex.MinBetween("v", max_value=-5))
    found = evidence(rows, suite, ["k"], limit=7)
    values = ["-1", *map(str, range(0, 30_000, 3))]
    smallest = sorted(values, key=lambda value: hashlib.md5(value.encode()).hexdigest())[:7]
    assert [row[4] for row in found] == smallest * 2 and [row[0] for row in found] == [1] * 7 + [2] * 7
    assert all(row[5] == (20_000 if row[4] == "-1" else 1) for row in found)
    assert [row[4] for row in evidence(rows.repartition(13), suite, ["k"], limit=7)] == smallest * 2
    assert [row[5:] for row in evidence(rows, (ex.ValuesBetween("v", min_value=0),), ["k"])] == [(20_000, "k=1")]


def test_empty_frame(spark):
    results = {r.rule_id: r.success for r in ex.validate(impact(spark).where("false"), ex.IMPACT_SUITE).collect()}
    assert [number for number, success in results.items() if not success] == [1, 11, 12, 14, 15]


def test_bounded_fetch(spark):
    frame = spark.range(50)
    assert ex.bounded_fetch(frame, 20).count() == 20
    assert ex.bounded_fetch(frame).count() == 50
    assert ex.bounded_fetch(spark.range(100_001)).count() == 100_001


def test_bindings_are_added_and_replaced(spark):
    suites = ex.bind("mart_pandemic_impact", (ex.RowCountBetween(min_value=1),))
    suites = ex.bind("another", (ex.NotNull("date"), ex.ColumnExists("absent")), suites)
    results = ex.validate_marts({"mart_pandemic_impact": impact(spark, 5), "another": impact(spark, 5)}, suites)
    assert sorted((r.model, r.expectation, r.success) for r in results.collect()) == [
        ("another", "column_exists", False),
        ("another", "values_not_null", True),
        ("mart_pandemic_impact", "table_row_count_between", True),
    ]
    assert len(ex.SUITES["mart_pandemic_impact"]) == 15 and "another" not in ex.SUITES


def test_outcomes(spark):
    results = ex.validate(impact(spark, 3), ex.IMPACT_SUITE)
    assert tuple(ex.outcome(results).first()) == ("report", 15, 1, False)
    assert tuple(ex.outcome(results, "raise").first()) == ("raise", 15, 1, True)
