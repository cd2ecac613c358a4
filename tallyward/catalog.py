"""Every query by name. Each takes (spark, directory of the star schema) and works on all of its rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.config import Config
from tallyward.operators import (
    as_of,
    change_points,
    column_checks,
    expectations,
    history,
    layout,
    marts,
    observability,
    profile,
    renames,
    schemas,
    sketches,
    snapshots,
    staging,
    unique_index,
)
from tallyward.plans import dashboards, incremental, report
from tallyward.plans.daily_run import DailyRun
from tallyward.plans.models import Models, build_models
from tallyward.sources import storage
from tallyward.sources.contract import RAW_CONTRACT
from tallyward.sources.star_schema import RAW_EXPRESSIONS, TEST_DAY, raw_observations
from tallyward.streaming import daily_stream, outages

Query = Callable[[SparkSession, str], DataFrame]

EVENTS_DAY = date(2024, 2, 1)
# Orders hold line numbers more than once; these tell the rows apart.
ROW_KEY = ("l_partkey", "l_suppkey", "l_extendedprice")
RUN_DAYS = (date(2020, 1, 15), date(2020, 6, 30), TEST_DAY)


def _models(spark: SparkSession, directory: str, as_of: date = TEST_DAY) -> Models:
    return build_models(raw_observations(spark, directory), as_of)


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written once, read by everything that follows from it."""
    path = storage.new_path(df.sparkSession, purpose)
    storage.write_counted(df, path)
    return df.sparkSession.read.parquet(path)


def _profiled(spark: SparkSession, directory: str) -> DataFrame:
    return profile.profiled_base(_models(spark, directory).staged)


def _table_name(purpose: str) -> str:
    return f"{purpose}_{uuid.uuid4().hex}"


# --- sources and sinks -----------------------------------------------------------------------------------------


def raw_row_count(spark: SparkSession, directory: str) -> DataFrame:
    path = storage.new_path(spark, "raw")
    written = storage.write_counted(raw_observations(spark, directory), path)
    zone = storage.read_raw_zone(spark, path)
    return zone.agg(F.lit(written).cast("bigint").alias("rows_written"), F.count(F.lit(1)).alias("rows_in_zone"))


def raw_zone_roundtrip(spark: SparkSession, directory: str) -> DataFrame:
    path = storage.new_path(spark, "raw")
    storage.write_version(raw_observations(spark, directory), path)
    return storage.read_raw_zone(spark, path)


def raw_zone_by_day(spark: SparkSession, directory: str) -> DataFrame:
    raw = raw_observations(spark, directory)
    path = storage.new_path(spark, "raw-by-day")
    storage.write_counted(raw, path, partition_by=["date"])
    return storage.read_source(spark, path, "parquet").select(*raw.columns)


def table_roundtrip(spark: SparkSession, directory: str) -> DataFrame:
    name = _table_name("covid19_raw")
    storage.save_table(raw_observations(spark, directory), name, path=storage.new_path(spark, "table"))
    return spark.table(name)


def registered_table(spark: SparkSession, directory: str) -> DataFrame:
    path = storage.new_path(spark, "raw")
    storage.write_counted(raw_observations(spark, directory), path)
    return storage.register_table(spark, _table_name("covid19_raw"), path)


def mart_as_table(spark: SparkSession, directory: str) -> DataFrame:
    name = _table_name("mart_pandemic_impact")
    storage.save_table(_models(spark, directory).impact, name, path=storage.new_path(spark, "mart"))
    return spark.table(name)


def stg_as_view(spark: SparkSession, directory: str) -> DataFrame:
    return storage.materialize(_models(spark, directory).staged, "stg_covid19", "view")


def validation_sample_count(spark: SparkSession, directory: str) -> DataFrame:
    sample = expectations.bounded_fetch(_models(spark, directory).impact)
    return sample.agg(F.count(F.lit(1)).alias("row_count"))


# --- marts -----------------------------------------------------------------------------------------------------


def _rate(rate: Callable) -> Query:
    def query(spark: SparkSession, directory: str) -> DataFrame:
        base = _models(spark, directory).base
        return base.select(*marts.GRAIN, rate().alias("rate"))

    return query


def impact_filtered(spark: SparkSession, directory: str) -> DataFrame:
    impact = _models(spark, directory).impact
    return dashboards.page_filter(impact, ["AN", "BO", "HU"], date(2020, 3, 1), date(2020, 5, 31))


def impact_clustered(spark: SparkSession, directory: str) -> DataFrame:
    """The impact mart laid out by country and day, read once for a country over all days and once for a day over all countries."""
    impact = _stored(_models(spark, directory).impact, "impact")
    path = storage.new_path(spark, "impact-clustered")
    storage.write_version(layout.clustered_by(impact, ["country_code", "date"], files=64), path)
    laid = storage.read_version(spark, path)
    country = dashboards.page_filter(laid, ["BO"]).withColumn("page", F.lit("country"))
    day = dashboards.page_filter(laid, first=date(2020, 5, 20), last=date(2020, 5, 20)).withColumn("page", F.lit("day"))
    return country.unionByName(day)


# --- column tests ----------------------------------------------------------------------------------------------


def _not_null(model: str, frame: str) -> Query:
    return lambda spark, directory: column_checks.not_null(getattr(_models(spark, directory), frame), model)


def column_tests(spark: SparkSession, directory: str) -> DataFrame:
    models = _models(spark, directory)
    return column_checks.declared_tests(models.staged, models.base)


def test_unique_grain(spark: SparkSession, directory: str) -> DataFrame:
    models = _models(spark, directory)
    staged_key = ["date", "country_code", "subregion1_name"]
    return column_checks.unique(models.impact, "mart_pandemic_impact", marts.GRAIN).unionByName(
        column_checks.unique(models.staged, "stg_covid19", staged_key)
    )


def incremental_unique(spark: SparkSession, directory: str) -> DataFrame:
    """Three increments of the staged rows, each checked against those before it; the second is run twice."""
    raw = raw_observations(spark, directory, "k")
    keys = ["date", "country_code", "subregion1_name"]
    index = unique_index.KeyIndex(spark, _table_name("stg_keys"), storage.new_path(spark, "keys"), keys, buckets=8)
    results = []
    for batch in (0, 1, 1, 2):
        staged = staging.stage(raw.where(f"k % 3 = {batch}").drop("k"), TEST_DAY)
        results.append(index.add(staged, batch))
    return spark.createDataFrame([tuple(row) for row in (results[0], *results[2:])], unique_index.SUMMARY)


def test_relationships(spark: SparkSession, directory: str) -> DataFrame:
    """Codes and names of the staged rows against the countries there are, a table of its own."""
    nations = spark.read.parquet(f"{directory}/nation.parquet")
    countries = nations.selectExpr(f"{RAW_EXPRESSIONS['country_code']} as country_code", "n_name as country_name")
    parents = {"country_code": (countries, "country_code"), "country_name": (countries, "country_name")}
    return column_checks.relationships(_models(spark, directory).staged, "stg_covid19", parents)


# --- expectations ----------------------------------------------------------------------------------------------


def expectations_impact(spark: SparkSession, directory: str) -> DataFrame:
    return expectations.validate(_models(spark, directory).impact, expectations.IMPACT_SUITE)


def expectations_failures(spark: SparkSession, directory: str) -> DataFrame:
    """The impact suite on a mart without hospital columns: the rules on those columns must be listed."""
    results = expectations.validate(_models(spark, directory).country_metrics, expectations.IMPACT_SUITE)
    return expectations.failures(results)


def _impact_history(spark: SparkSession, directory: str) -> DataFrame:
    path = storage.new_path(spark, "expectations")
    for as_of in RUN_DAYS:
        results = expectations.validate(_models(spark, directory, as_of).impact, expectations.IMPACT_SUITE)
        started = datetime(as_of.year, as_of.month, as_of.day, tzinfo=UTC)
        history.append_run(results, path, as_of.isoformat(), run_started=started)
    return history.read_history(spark, path)


def test_history(spark: SparkSession, directory: str) -> DataFrame:
    results = _impact_history(spark, directory)
    return history.pass_rates(results, ["rule_id", "expectation", "column_name"], "success")


STRICT_SUITE = (
    expectations.RowCountBetween(min_value=1000),
    expectations.NotNull("country_code"),
    expectations.ValuesBetween("case_fatality_rate", min_value=0, max_value=50),
)


# Rules of every kind, most of them broken by some rows.
STRAINED_SUITE = (
    expectations.RowCountBetween(min_value=1000),
    expectations.ColumnExists("no_such_column"),
    expectations.NotNull("avg_hospital_beds_per_1000"),
    expectations.LengthsBetween("country_name", max_value=7),
    expectations.MatchesRegex("country_code", regex="^[A-M][A-Z]$"),
    expectations.ValuesBetween("case_fatality_rate", min_value=0, max_value=20),
    expectations.MinBetween("total_new_cases", min_value=30),
    expectations.MaxBetween("total_new_deaths", max_value=10),
    expectations.NotNull("date"),
)


def expectations_evidence(spark: SparkSession, directory: str) -> DataFrame:
    """The values behind the failing rules, five for each at most."""
    return expectations.evidence(_models(spark, directory).impact, STRAINED_SUITE, marts.GRAIN, limit=5)


def suite_replaced(spark: SparkSession, directory: str) -> DataFrame:
    """The impact mart under another suite, and a mart that had none under its first."""
    suites = expectations.bind("mart_pandemic_impact", STRICT_SUITE)
    suites = expectations.bind("mart_covid19_country_metrics", STRICT_SUITE[:2], suites)
    models = _models(spark, directory)
    frames = {"mart_pandemic_impact": models.impact, "mart_covid19_country_metrics": models.country_metrics}
    return expectations.validate_marts(frames, suites)


def validation_outcomes(spark: SparkSession, directory: str) -> DataFrame:
    """What a run does with the strict suite, by setting."""
    results = _stored(expectations.validate(_models(spark, directory).impact, STRICT_SUITE), "strict")
    return expectations.outcome(results, "report").unionByName(expectations.outcome(results, "raise"))


# --- runs ------------------------------------------------------------------------------------------------------


def _run(spark: SparkSession, directory: str, history_path: str = "", prefix: str = "monitoring_") -> DailyRun:
    config = Config(
        source_path=_source_view(spark, directory),
        source_format="table",
        raw_path=storage.new_path(spark, "raw"),
        raw_table=_table_name("covid19_raw"),
        history_path=history_path,
        monitoring_prefix=prefix,
        as_of=TEST_DAY,
    )
    return DailyRun(spark, config).execute()


def _source_view(spark: SparkSession, directory: str) -> str:
    name = _table_name("covid19_source")
    raw_observations(spark, directory).createOrReplaceTempView(name)
    return name


def run_log(spark: SparkSession, directory: str) -> DataFrame:
    """The log of a run; of its times, whether they are in order."""
    log = _run(spark, directory).log_frame()
    return log.select("position", "stage", "status", "row_count", "detail", (F.col("ended_at") >= F.col("started_at")).alias("in_order"))


def pipeline_summary(spark: SparkSession, directory: str) -> DataFrame:
    return _run(spark, directory).log_frame().select("position", "stage", "status", "row_count")


def monitoring_tables(spark: SparkSession, directory: str) -> DataFrame:
    """Tables that a run stores, under a prefix of their own, with their rows."""
    path = storage.new_path(spark, "history")
    _run(spark, directory, path, prefix="watch_")
    frames = [
        history.read_history(spark, f"{path}/watch_{name}").agg(
            F.lit(f"watch_{name}").alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        for name in ("column_tests", "expectations", "schema_snapshot", "model_log", "model_row_counts", "arrivals", "report")
    ]
    return reduce(DataFrame.unionByName, frames)


def _event_log(spark: SparkSession, directory: str) -> DataFrame:
    """A log of runs whose times other engines know too: users as runs, event types as stages, values as seconds."""
    events = spark.read.parquet(f"{directory}/events.parquet")
    started = F.col("ts").cast("timestamp")
    return events.select(
        F.format_string("%08d", "event_id").alias("run_id"),
        F.col("event_type").alias("stage"),
        F.when(F.col("event_id") % 10 == 0, "failed").otherwise("succeeded").alias("status"),
        started.alias("started_at"),
        F.timestamp_micros(F.unix_micros(started) + F.floor(F.col("value") * 1000) * 1000).alias("ended_at"),
    )


def model_run_times(spark: SparkSession, directory: str) -> DataFrame:
    """Times per stage over the logged runs, and per model where a log names models instead."""
    log = _event_log(spark, directory)
    per_stage = history.stage_times(log)
    per_model = history.stage_times(log.withColumnRenamed("stage", "model"), by="model")
    return per_stage.withColumn("kind", F.lit("stage")).unionByName(
        per_model.withColumnRenamed("model", "stage").withColumn("kind", F.lit("model"))
    )


# --- observability ---------------------------------------------------------------------------------------------


def metric_anomaly(spark: SparkSession, directory: str) -> DataFrame:
    """Every statistic of every staged measure, scored by day."""
    return observability.metric_anomalies(profile.daily_metrics(_stored(_profiled(spark, directory), "profile")))


def volume_anomaly(spark: SparkSession, directory: str) -> DataFrame:
    staged = _models(spark, directory).staged
    daily = observability.daily_volume(staged, "stg_covid19")
    return observability.volume_anomalies(observability.on_every_day(daily, TEST_DAY))


def volume_outage(spark: SparkSession, directory: str) -> DataFrame:
    """The same after an outage: no rows for five days, and none for the last three."""
    staged = _models(spark, directory).staged.where(
        "date not between date '2020-09-10' and date '2020-09-14' and date <= date '2020-12-28'"
    )
    daily = observability.daily_volume(staged, "stg_covid19")
    return observability.volume_anomalies(observability.on_every_day(daily, TEST_DAY))


def _declining_volume(spark: SparkSession, directory: str) -> DataFrame:
    """Daily counts of the staged rows if weekends had fewer, and if from October on each day had lost 3 % more of its rows."""
    raw = raw_observations(spark, directory, "k")
    weekday = "datediff(date, date '2020-01-06') % 7"
    kept = "floor(1000 * pow(0.97, greatest(0, datediff(date, date '2020-09-30'))))"
    thinned = raw.where(f"k % 1000 < {kept} and ({weekday} < 5 or k % 10 < 6)").drop("k")
    return observability.daily_volume(staging.stage(thinned, TEST_DAY), "stg_covid19")


def volume_change_point(spark: SparkSession, directory: str) -> DataFrame:
    """A decline of 3 % a day, which no day's score shows."""
    return change_points.change_points(observability.on_every_day(_declining_volume(spark, directory), TEST_DAY))


def freshness_empty(spark: SparkSession, directory: str) -> DataFrame:
    """A table that holds only days still to come has no staged rows."""
    staged = _models(spark, directory, date(2019, 1, 1)).staged
    return observability.freshness(staged, "stg_covid19", TEST_DAY)


def column_metrics(spark: SparkSession, directory: str) -> DataFrame:
    """The derived rows are stored first: each pass then reads its own columns of them."""
    return observability.column_metrics(_stored(raw_observations(spark, directory), "raw"))


def _events(spark: SparkSession, directory: str) -> DataFrame:
    """Another monitored table: its time of day is dropped, as it is watched per day and event type."""
    events = spark.read.parquet(f"{directory}/events.parquet")
    return events.withColumn("date", F.col("ts").cast("date")).drop("ts")


def events_volume_anomaly(spark: SparkSession, directory: str) -> DataFrame:
    """A series of daily counts for each event type."""
    counted = observability.arrivals(_events(spark, directory), key="event_type")
    daily = counted.withColumnRenamed("event_type", "table_name")
    return observability.volume_anomalies(observability.on_every_day(daily, EVENTS_DAY))


def events_freshness(spark: SparkSession, directory: str) -> DataFrame:
    return observability.freshness(_events(spark, directory), "events", EVENTS_DAY, max_days=2, key="event_type")


SKETCHED = ("subregion1_name", "new_confirmed", "cumulative_confirmed", "current_hospitalized_patients", "stringency_index", "population")


def _sketched(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """The base with sketches, stored, and the staged rows that it is checked against."""
    staged = _models(spark, directory).staged
    return _stored(profile.profiled_base(staged, SKETCHED), "sketches"), staged


def daily_distinct(spark: SparkSession, directory: str) -> DataFrame:
    """Distinct counts of days, and of months merged from the same sketches."""
    base, staged = _sketched(spark, directory)
    return sketches.distinct_checks(base, staged)


def daily_quantiles(spark: SparkSession, directory: str) -> DataFrame:
    """Quantiles of days, and of months merged from the same sketches."""
    base, staged = _sketched(spark, directory)
    return sketches.by_periods({kind: sketches.quantile_checks_by(base, staged, kind) for kind in sketches.PERIODS})


def daily_lengths(spark: SparkSession, directory: str) -> DataFrame:
    base, _ = _sketched(spark, directory)
    return sketches.by_periods({kind: sketches.lengths_by(base, kind) for kind in sketches.PERIODS})


def distribution_anomaly(spark: SparkSession, directory: str) -> DataFrame:
    """Drift of distributions, with five days of September on which the case counts are turned upside down."""
    odd = "date between date '2020-09-10' and date '2020-09-14'"
    staged = _models(spark, directory).staged
    turned = staged.withColumn("new_confirmed", F.expr(f"if({odd}, 50 - new_confirmed, new_confirmed)"))
    base = _stored(profile.profiled_base(turned, SKETCHED), "sketches")
    return sketches.distribution_anomalies(sketches.histograms_by(base))


def schema_changes(spark: SparkSession, directory: str) -> DataFrame:
    """Drift between the raw table and the staged one, taken as two states of one table. Schemas only."""
    raw = raw_observations(spark, directory)
    earlier = raw.withColumn("school_closing", F.col("school_closing").cast("int"))
    return schemas.schema_changes(
        schemas.schema_only(spark, earlier.schema, "covid19"),
        schemas.schema_only(spark, staging.stage(raw, TEST_DAY).schema, "covid19"),
    )


def schema_renames(spark: SparkSession, directory: str) -> DataFrame:
    """The impact mart and a later state of it: two columns renamed, one dropped, and two new ones of which one is nearly the same."""
    before = _models(spark, directory).impact
    after = before.withColumnsRenamed({"total_new_deaths": "deaths", "current_icu_patients": "icu_patients"})
    after = after.withColumn("cases_of_next_week", F.expr("total_new_cases + 1")).withColumn("week", F.expr("extract(week from date)"))
    after = after.drop("population").where("date < date '2020-12-01'")
    return renames.column_matches(before, after, marts.GRAIN).select("removed", "added", "kind", "is_rename")


def schema_contract(spark: SparkSession, directory: str) -> DataFrame:
    """A raw table with a narrower and a wrong type, one column short and one over."""
    raw = raw_observations(spark, directory).drop("population").withColumn("school_closing", F.col("school_closing").cast("int"))
    odd = raw.withColumn("new_recovered", F.col("new_recovered").cast("string")).withColumn("remark", F.lit("x"))
    return schemas.contract_report(spark, odd.schema, RAW_CONTRACT, "covid19_raw")


def dq_report(spark: SparkSession, directory: str) -> DataFrame:
    """The report, with the base stored once and everything read off it; times come from a log that other engines know."""
    raw = raw_observations(spark, directory)
    base = _stored(_profiled(spark, directory), "profile")
    arrivals = _stored(profile.arrivals(base), "arrivals")
    volume = observability.on_every_day(observability.daily_volume(arrivals, "stg_covid19", "row_count"), TEST_DAY)
    log = _event_log(spark, directory)
    return report.quality_report(
        tests=profile.declared_tests(base),
        expectations=expectations.validate(marts.pandemic_impact(base), expectations.IMPACT_SUITE),
        fresh=observability.freshness(arrivals, "stg_covid19", TEST_DAY),
        volume=observability.volume_anomalies(volume),
        metrics=observability.metric_anomalies(profile.daily_metrics(base)),
        contract=schemas.contract_report(spark, raw.schema, RAW_CONTRACT, "covid19_raw"),
        test_history=test_history(spark, directory),
        run_log=log,
        row_counts=profile.model_row_counts(base),
        run_times=history.stage_times(log),
        drift=schemas.drift_status(schemas.schema_only(spark, raw.schema, "covid19"), schema_changes(spark, directory)),
    )


# --- dashboards ------------------------------------------------------------------------------------------------


def _dashboard(build: Callable[[DataFrame], DataFrame], mart: str) -> Query:
    return lambda spark, directory: build(getattr(_models(spark, directory), mart))


def gdp_vs_coverage_joined(spark: SparkSession, directory: str) -> DataFrame:
    models = _models(spark, directory)
    return dashboards.gdp_vs_coverage(models.government, models.vaccination)


# --- incremental, versioned and streaming ----------------------------------------------------------------------


def incremental_refresh(spark: SparkSession, directory: str) -> DataFrame:
    """A base as of the end of November, then December refreshed into it."""
    raw = raw_observations(spark, directory)
    path = storage.new_path(spark, "base")
    incremental.refresh_base(raw, path, as_of=date(2020, 11, 30))
    incremental.refresh_base(raw, path, date(2020, 12, 1), TEST_DAY, as_of=TEST_DAY)
    return incremental.read_base(spark, path)


def incremental_emptied_day(spark: SparkSession, directory: str) -> DataFrame:
    """December refreshed after two of its days have lost all their rows."""
    raw = raw_observations(spark, directory)
    path = storage.new_path(spark, "base")
    incremental.refresh_base(raw, path, as_of=TEST_DAY)
    thinner = raw.where("date is null or date not in (date '2020-12-05', date '2020-12-31')")
    incremental.refresh_base(thinner, path, date(2020, 12, 1), TEST_DAY, as_of=TEST_DAY)
    return incremental.read_base(spark, path)


def country_profile_history(spark: SparkSession, directory: str) -> DataFrame:
    """Versions of each country's profile over three runs."""
    table = snapshots.SnapshotTable(spark, storage.new_path(spark, "profile"), ["country_code", "country_name"])
    for as_of in RUN_DAYS:
        table.apply(snapshots.country_profile(_models(spark, directory, as_of).government), as_of)
    return table.read()


def impact_with_profile_as_of(spark: SparkSession, directory: str) -> DataFrame:
    """Cases and deaths of each country and day under the policy levels that the profile then had."""
    impact = _models(spark, directory).impact.select(*marts.GRAIN, "total_new_cases", "total_new_deaths")
    profiles = country_profile_history(spark, directory).withColumnRenamed("population", "profile_population")
    return as_of.as_of_join(impact, profiles, ["country_code", "country_name"], "date")


def _finished(query) -> None:
    query.awaitTermination()


def streaming_refresh(spark: SparkSession, directory: str) -> DataFrame:
    """Two arrivals of an append-only source: odd and even orders."""
    raw = raw_observations(spark, directory)
    arrivals, partials, base, checkpoint = (
        storage.new_path(spark, f"stream-{name}") for name in ("arrivals", "partials", "base", "checkpoint")
    )
    for half in ("date is null or day(date) % 2 = 0 or new_confirmed % 2 = 0", "date is not null and day(date) % 2 = 1 and coalesce(new_confirmed, 1) % 2 <> 0"):
        raw.where(half).write.mode("append").parquet(arrivals)
        stream = daily_stream.raw_stream(spark, arrivals, raw.schema)
        _finished(daily_stream.refresh_appended(stream, partials, base, checkpoint))
    return incremental.read_base(spark, base, TEST_DAY)


def streaming_corrections(spark: SparkSession, directory: str) -> DataFrame:
    """All rows arrive, then every tenth again with 5 cases more, and every hundredth without a valid count."""
    raw = raw_observations(spark, directory, "k", *ROW_KEY)
    arrivals, rows, base, checkpoint = (
        storage.new_path(spark, f"stream-{name}") for name in ("arrivals", "rows", "base", "checkpoint")
    )
    again = raw.where("k % 10 = 0").withColumn("new_confirmed", F.expr("if(k % 100 = 0, -1, new_confirmed + 5)"))
    for arriving in (raw, again):
        arriving.write.mode("append").option("compression", "zstd").parquet(arrivals)
        stream = daily_stream.raw_stream(spark, arrivals, raw.schema)
        _finished(daily_stream.refresh_corrected(stream, rows, base, checkpoint, ["date", "k", *ROW_KEY]))
    return incremental.read_base(spark, base, TEST_DAY)


def streaming_closed_days(spark: SparkSession, directory: str) -> DataFrame:
    raw = raw_observations(spark, directory)
    arrivals, path = storage.new_path(spark, "arrivals"), storage.new_path(spark, "stream-closed")
    storage.write_counted(raw, arrivals)
    stream = daily_stream.staged_stream(spark, arrivals, raw.schema, TEST_DAY)
    _finished(
        daily_stream.closed_days(stream, lateness_days=7)
        .writeStream.format("parquet")
        .option("checkpointLocation", storage.new_path(spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start(path)
    )
    return spark.read.parquet(path)


def streaming_outage(spark: SparkSession, directory: str) -> DataFrame:
    """Alarms of a year that arrives in three parts, with a country that falls silent for a while and one that does for good."""
    raw = raw_observations(spark, directory).where(
        "not (country_code = 'AN' and date between date '2020-05-10' and date '2020-05-25')"
        " and not (country_code = 'BO' and date >= date '2020-11-20')"
    )
    arrivals, path, checkpoint = (storage.new_path(spark, f"outages-{name}") for name in ("arrivals", "alarms", "checkpoint"))
    for part in ("date < date '2020-05-12'", "date between date '2020-05-12' and date '2020-09-30'", "date > date '2020-09-30'"):
        raw.where(part).write.mode("append").parquet(arrivals)
        stream = daily_stream.staged_stream(spark, arrivals, raw.schema, TEST_DAY)
        _finished(outages.watch_outages(stream, path, checkpoint))
    return spark.read.schema(outages.ALARMS).parquet(path)


QUERIES: dict[str, Query] = {
    "raw_scan": lambda s, d: storage.read_source(s, _source_view(s, d), "table"),
    "raw_row_count": raw_row_count,
    "raw_zone_roundtrip": raw_zone_roundtrip,
    "raw_zone_by_day": raw_zone_by_day,
    "table_roundtrip": table_roundtrip,
    "registered_table": registered_table,
    "stg_as_view": stg_as_view,
    "mart_as_table": mart_as_table,
    "validation_sample_count": validation_sample_count,
    "stg_covid19": lambda spark, directory: _models(spark, directory).staged,
    "stg_nulls_filled": lambda s, d: staging.gap_counts(_models(s, d).staged, staging.ZERO_FILLED),
    "stg_nulls_kept": lambda s, d: staging.gap_counts(_models(s, d).staged, staging.LEFT_NULL),
    "stg_reject_reasons": lambda s, d: staging.reject_reasons(raw_observations(s, d), TEST_DAY),
    "freshness_gate": lambda s, d: observability.has_rows_for_yesterday(raw_observations(s, d), TEST_DAY),
    "daily_country_base": lambda s, d: _models(s, d).base,
    "mart_country_metrics": lambda s, d: _models(s, d).country_metrics,
    "mart_pandemic_impact": lambda s, d: _models(s, d).impact,
    "mart_vaccination": lambda s, d: _models(s, d).vaccination,
    "mart_government": lambda s, d: _models(s, d).government,
    "cfr_uncapped": _rate(marts.fatality_rate),
    "cfr_capped": _rate(marts.capped_fatality_rate),
    "hospitalization_rate": _rate(marts.hospitalization_rate),
    "vaccination_coverage": _rate(marts.vaccination_coverage),
    "impact_filtered": impact_filtered,
    "impact_clustered": impact_clustered,
    "not_null_stg": _not_null("stg_covid19", "staged"),
    "not_null_country": _not_null("mart_covid19_country_metrics", "country_metrics"),
    "not_null_impact": _not_null("mart_pandemic_impact", "impact"),
    "not_null_vaccination": _not_null("mart_vaccination_effectiveness", "vaccination"),
    "not_null_government": _not_null("mart_government_response", "government"),
    "column_tests": column_tests,
    "test_unique_grain": test_unique_grain,
    "incremental_unique": incremental_unique,
    "test_policy_levels": lambda s, d: column_checks.policy_levels(
        _models(s, d).government, "mart_government_response"
    ),
    "test_relationships": test_relationships,
    "expectations_impact": expectations_impact,
    "expectations_summary": lambda s, d: expectations.summarize(expectations_impact(s, d)),
    "expectations_failures": expectations_failures,
    "expectations_evidence": expectations_evidence,
    "expectations_vaccination": lambda s, d: expectations.validate(
        _models(s, d).vaccination, expectations.VACCINATION_SUITE
    ),
    "expectations_government": lambda s, d: expectations.validate(
        _models(s, d).government, expectations.GOVERNMENT_SUITE
    ),
    "suite_replaced": suite_replaced,
    "validation_outcomes": validation_outcomes,
    "validation_history": lambda s, d: _impact_history(s, d).drop("run_started"),
    "test_history": test_history,
    "run_log": run_log,
    "run_summary": pipeline_summary,
    "pipeline_summary": pipeline_summary,
    "monitoring_tables": monitoring_tables,
    "model_catalog": lambda s, d: marts.model_catalog(_models(s, d).staged, _models(s, d).base),
    "model_run_times": model_run_times,
    "model_row_counts": lambda s, d: profile.model_row_counts(_profiled(s, d)),
    "column_metrics": column_metrics,
    "distinct_estimates": lambda s, d: observability.distinct_checks(_stored(raw_observations(s, d), "raw")),
    "metric_anomaly": metric_anomaly,
    "metric_anomaly_tests": lambda s, d: observability.anomaly_tests(
        metric_anomaly(s, d), ["column_name", "metric"]
    ),
    "daily_distinct": daily_distinct,
    "daily_quantiles": daily_quantiles,
    "daily_lengths": daily_lengths,
    "distribution_anomaly": distribution_anomaly,
    "volume_anomaly": volume_anomaly,
    "volume_outage": volume_outage,
    "volume_change_point": volume_change_point,
    "volume_change_episodes": lambda s, d: change_points.change_episodes(volume_change_point(s, d)),
    "freshness_empty": freshness_empty,
    "freshness": lambda s, d: observability.freshness(_models(s, d).staged, "stg_covid19", TEST_DAY),
    "events_column_metrics": lambda s, d: observability.column_metrics(_events(s, d)),
    "events_volume_anomaly": events_volume_anomaly,
    "events_freshness": events_freshness,
    "schema_changes": schema_changes,
    "schema_renames": schema_renames,
    "schema_contract": schema_contract,
    "contract_usage": lambda s, d: schemas.contract_usage(raw_observations(s, d), RAW_CONTRACT, "covid19_raw"),
    "dq_report": dq_report,
    "cumulative_by_country": _dashboard(dashboards.cumulative_by_country, "impact"),
    "daily_cases_deaths": _dashboard(dashboards.daily_cases_deaths, "impact"),
    "cfr_top20": _dashboard(dashboards.top_fatality_rates, "impact"),
    "impact_scorecards": _dashboard(dashboards.impact_scorecards, "impact"),
    "coverage_scorecard": _dashboard(dashboards.coverage_scorecard, "vaccination"),
    "doses_by_brand": _dashboard(dashboards.doses_by_brand, "vaccination"),
    "vaccinations_vs_deaths": _dashboard(dashboards.vaccinations_vs_deaths, "vaccination"),
    "vaccination_progress": _dashboard(dashboards.vaccination_progress, "vaccination"),
    "stringency_vs_cases": _dashboard(dashboards.stringency_vs_cases, "government"),
    "policy_scorecards": _dashboard(dashboards.policy_scorecards, "government"),
    "hdi_vs_cfr": _dashboard(dashboards.hdi_vs_fatality, "government"),
    "hdi_cfr_correlation": _dashboard(dashboards.hdi_fatality_correlation, "government"),
    "gdp_vs_coverage": _dashboard(dashboards.gdp_vs_coverage_from_base, "base"),
    "gdp_vs_coverage_joined": gdp_vs_coverage_joined,
    "incremental_refresh": incremental_refresh,
    "incremental_emptied_day": incremental_emptied_day,
    "country_profile_history": country_profile_history,
    "impact_with_profile_as_of": impact_with_profile_as_of,
    "streaming_refresh": streaming_refresh,
    "streaming_corrections": streaming_corrections,
    "streaming_closed_days": streaming_closed_days,
    "streaming_outage": streaming_outage,
}
