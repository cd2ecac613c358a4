"""The daily run: extract, load, gate, models, column tests, expectations, report — in this order.

A failing stage stops the run; the stages after it are logged as skipped. When and how often to run, and retries,
are left to whatever submits the job.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyward.config import Config
from tallyward.functions.frames import describe
from tallyward.operators import (
    change_points,
    expectations,
    history,
    layout,
    marts,
    observability,
    profile,
    renames,
    schemas,
    sketches,
)
from tallyward.operators.staging import stage
from tallyward.plans.report import quality_report
from tallyward.session import settings
from tallyward.sources import storage, versions
from tallyward.sources.contract import RAW_CONTRACT


# What names a raw row, as far as anything does.
RAW_KEYS = ("date", "country_code", "country_name", "subregion1_name")


class StageFailed(Exception):
    """A check that gates the run did not pass."""


@dataclass
class DailyRun:
    """State and log of one run."""

    spark: SparkSession
    config: Config
    run_id: str = field(default_factory=lambda: f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}")
    log: list[tuple] = field(default_factory=list)
    verdicts: dict[str, DataFrame] = field(default_factory=dict)
    error: Exception | None = None
    started: datetime = field(default_factory=lambda: datetime.now(UTC))
    model_log: list[tuple] = field(default_factory=list)

    def stages(self) -> dict[str, Callable[[], int | None]]:
        return {
            "extract": self.extract,
            "load": self.load,
            "freshness_gate": self.freshness_gate,
            "models": self.models,
            "column_tests": self.column_tests,
            "expectations": self.expectations,
            "report": self.report,
        }

    def execute(self, only: Collection[str] | None = None) -> DailyRun:
        """Run all stages, or only the named ones (still in the fixed order)."""
        for position, (name, action) in enumerate(self.stages().items(), start=1):
            if only is not None and name not in only:
                continue
            if self.error is not None:
                self.log.append(history.log_entry(self.run_id, position, name, "skipped", None, None, None))
                continue
            started = datetime.now(UTC)
            try:
                rows, status, detail = action(), "succeeded", None
            except Exception as failure:
                self.error, rows, status, detail = failure, None, "failed", str(failure)
            self.log.append(
                history.log_entry(self.run_id, position, name, status, rows, started, datetime.now(UTC), detail)
            )
        self._store("run_log", self.log_frame(), parts=["stage"])
        return self

    def log_frame(self) -> DataFrame:
        return history.run_log_frame(self.spark, self.log)

    # --- stages: each returns the number of rows it handled, where it has one ------------------------------------

    def extract(self) -> int:
        """Copy the source to a new version of the raw zone; the row count comes out of the same pass."""
        config = self.config
        source = storage.read_source(self.spark, config.source_path, config.source_format, config.source_options)
        return storage.write_version(source, config.raw_path, partition_by=config.raw_partition_by)

    def load(self) -> int | None:
        """Publish the raw zone as the raw table if it keeps the contract: in place, or copied by a connector."""
        version = versions.current(self.spark, self.config.raw_path)
        table = self.config.table(self.config.raw_table)
        raw = storage.register_table(self.spark, table, version, self.config.raw_partition_by)
        self._store("schema_snapshot", schemas.schema_only(self.spark, raw.schema, self.config.raw_table))
        breaches = schemas.contract_breaches(raw.schema, RAW_CONTRACT)
        if breaches and self.config.enforce_contract:
            raise StageFailed("; ".join(breaches))
        if self.config.warehouse_format:
            return storage.write_sink(raw, self.config.warehouse_format, self.config.warehouse_options)
        return None

    def freshness_gate(self) -> None:
        with settings(self.spark, spark__sql__files__maxPartitionBytes=self.config.scan_split):
            if not observability.has_rows_for_yesterday(self._raw(), self.config.as_of).first().passed:
                raise StageFailed("no rows for the day before")

    def models(self) -> int:
        """Store the base, with all that later stages want to know about the staged rows, and publish the marts over it.

        This is the only pass over the raw rows. As views the marts are projections of the stored base; as tables each is written
        from it. Either way other sessions read them: :func:`tallyward.plans.models.stored_marts`, or the tables.
        """
        staged = storage.materialize(stage(self._raw(), self.config.as_of), "stg_covid19", "view")
        with settings(self.spark, spark__sql__files__maxPartitionBytes=self.config.scan_split):
            base = profile.profiled_base(staged, self.config.sketches)
            rows = self._timed("daily_country_base", lambda: storage.write_version(base, self.config.base_path))
        base = self._base()
        how = self.config.materialized
        for name, mart in marts.MARTS.items():
            if how == "table":
                self._timed(name, lambda name=name, mart=mart: self._publish(name, mart(base)))
            else:
                storage.materialize(mart(base), name, how)
                self.model_log.append((self.run_id, name, "view", rows, None, None))
        self._store("model_log", self.spark.createDataFrame(self.model_log, history.MODEL_LOG_SCHEMA))
        return rows

    def column_tests(self) -> int:
        return self._judge("column_tests", profile.declared_tests(self._base()), "passed", always_raise=True)

    def expectations(self) -> int:
        base = self._base()
        frames = {name: marts.MARTS[name](base) for name in self.config.suites}
        results = expectations.validate_marts(frames)
        return self._judge("expectations", results, "success", False, lambda failed: self._store_evidence(frames, failed))

    def report(self) -> None:
        """Store freshness, volume, metric scores, schema drift and, if all checks ran, the report. Everything is read off the base."""
        if not self.config.history_path:
            return
        base, table = self._base(), "stg_covid19"
        self._store("arrivals", profile.arrivals(base))
        counted = self._stored("arrivals")
        today = self.config.as_of or datetime.now(UTC).date()
        volume = observability.on_every_day(observability.daily_volume(counted, table, "row_count"), today - timedelta(days=1))
        daily = profile.daily_metrics(base)
        if self.config.profiled:
            daily = daily.where(F.col("column_name").isin(*self.config.profiled))
        self._store("freshness", observability.freshness(counted, table, self.config.as_of))
        self._store("volume", observability.volume_anomalies(volume))
        self._store("volume_changes", change_points.change_points(volume))
        self._store("metric_scores", observability.metric_anomalies(daily))
        self._store("model_row_counts", profile.model_row_counts(base))
        self._store_sketches(base)
        drift = self._store_drift()
        tests, rules = self._stored("column_tests"), self._stored("expectations")
        if tests is None or rules is None:
            return
        raw = self._raw()
        contract = schemas.contract_report(self.spark, raw.schema, RAW_CONTRACT, self.config.raw_table)
        log = self.log_frame() if self.log else self._stored("run_log")
        logged = self._history("run_log")
        self._store(
            "report",
            quality_report(
                tests=tests,
                expectations=rules,
                fresh=self._stored("freshness"),
                volume=self._stored("volume"),
                metrics=self._stored("metric_scores"),
                contract=contract.where("status <> 'not_in_contract'"),
                test_history=history.pass_rates(self._history("column_tests"), ["model", "test", "column_name"], "passed"),
                run_log=log,
                row_counts=self._stored("model_row_counts"),
                run_times=history.stage_times(log if logged is None else logged),
                drift=drift,
                changes=self._stored("volume_changes"),
                distributions=self._stored("distributions"),
            ),
        )

    def _store_sketches(self, base: DataFrame) -> None:
        """Store what the sketches of the base say by day, of each kind that it holds."""
        readers = {
            "distinct": lambda: sketches.distinct_by(base),
            "quantiles": lambda: sketches.quantiles_by(base),
            "lengths": lambda: sketches.lengths_by(base),
            "tails": lambda: sketches.distribution_anomalies(sketches.histograms_by(base)),
        }
        for kind, read in readers.items():
            if sketches.sketched(base, kind):
                self._store("distributions" if kind == "tails" else kind, read())

    def _store_drift(self) -> DataFrame | None:
        """Store what changed in the schema of the raw table since the run before; every column with its change."""
        snapshots = self._history("schema_snapshot")
        if snapshots is None:
            return None
        after = schemas.schema_only(self.spark, self._raw().schema, self.config.raw_table)
        earlier = history.run_before(snapshots, self.run_id)
        if earlier is None:
            return after.select("column_name", F.lit(None).cast("string").alias("change"))
        before = snapshots.where(F.col("run_id") == earlier).drop("run_id", "run_started")
        changes = schemas.schema_changes(before, after)
        self._store("schema_changes", changes)
        previous = versions.before(self.spark, self.config.raw_path)
        if previous is not None:
            # Rows are read only of columns that went and came.
            found = renames.column_matches(self.spark.read.parquet(previous), self._raw(), RAW_KEYS)
            self._store("schema_renames", found)
        return schemas.drift_status(after, changes)

    # --- helpers -------------------------------------------------------------------------------------------------

    def _raw(self) -> DataFrame:
        """The raw table, or the files behind it where the catalog does not know the table."""
        name = self.config.table(self.config.raw_table)
        if self.spark.catalog.tableExists(name):
            return self.spark.table(name)
        return storage.read_raw_zone(self.spark, self.config.raw_path)

    def _base(self) -> DataFrame:
        """The base that the models stage has stored, or its definition before any run has."""
        if versions.exists(self.spark, self.config.base_path):
            return storage.read_version(self.spark, self.config.base_path)
        return profile.profiled_base(stage(self._raw(), self.config.as_of), self.config.sketches)

    def _publish(self, name: str, mart: DataFrame) -> int:
        path, files = self.config.mart_path(name), self.config.cluster_files
        if files:
            mart = describe(layout.clustered_by(mart, ["country_code", "date"], files), marts.DESCRIPTIONS)
        rows = storage.write_version(mart, path)
        storage.register_table(self.spark, self.config.table(name), versions.current(self.spark, path))
        return rows

    def _timed(self, model: str, write: Callable[[], int]) -> int:
        started = datetime.now(UTC)
        rows = write()
        self.model_log.append((self.run_id, model, "succeeded", rows, started, datetime.now(UTC)))
        return rows

    def _store_evidence(self, frames: dict[str, DataFrame], failed: Sequence[Row]) -> None:
        """Store the values behind the failing rules; only the marts that have some are read again."""
        shown = []
        for name in {row["model"]: None for row in failed}:
            rules = [row["rule_id"] for row in failed if row["model"] == name]
            found = expectations.evidence(frames[name], expectations.SUITES[name], marts.GRAIN, only=rules)
            shown.append(found.select(F.lit(name).alias("model"), "*"))
        self._store("evidence", reduce(DataFrame.unionByName, shown))

    def _judge(
        self,
        name: str,
        results: DataFrame,
        passed: str,
        always_raise: bool,
        explain: Callable[[Sequence[Row]], None] | None = None,
    ) -> int:
        """Store the results of the checks, let ``explain`` look at those that failed, and raise if the run is set to."""
        rows = results.collect()  # one row per declared check
        self.verdicts[name] = self.spark.createDataFrame(rows, results.schema)
        self._store(name, self.verdicts[name])
        failed = [row for row in rows if not row[passed]]
        if failed and explain is not None:
            explain(failed)
        if failed and (always_raise or self.config.on_bad_data == "raise"):
            raise StageFailed(f"{len(failed)} of {len(rows)} checks failed")
        return len(rows)

    def _folder(self, name: str) -> str:
        return f"{self.config.history_path}/{self.config.monitoring_prefix}{name}"

    def _store(self, name: str, results: DataFrame, parts: Sequence[str] = ()) -> None:
        if self.config.history_path:
            history.append_run(results, self._folder(name), self.run_id, parts, self.started)

    def _history(self, name: str) -> DataFrame | None:
        """What all runs stored under ``name``, if any did."""
        return self._if_there(self._folder(name), lambda path: history.read_history(self.spark, path))

    def _stored(self, name: str) -> DataFrame | None:
        """What this run stored under ``name``."""
        place = f"{self._folder(name)}/run_id={self.run_id}"
        return self._if_there(place, lambda _: history.read_run(self.spark, self._folder(name), self.run_id))

    def _if_there(self, path: str, read: Callable[[str], DataFrame]) -> DataFrame | None:
        """Folders that nobody has written yet are not read: the failed query would be reported to listeners."""
        if not versions.exists(self.spark, path):
            return None
        try:
            return read(path)
        except AnalysisException:
            return None
