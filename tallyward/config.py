"""Settings of one run, read from the environment or given in code."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

MATERIALIZATIONS = ("view", "table")
FAILURE_MODES = ("report", "raise")


def _pairs(text: str) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in text.split(",") if pair)


@dataclass(frozen=True)
class Config:
    """Where a run reads and writes, and how it treats bad data.

    ``raw_path`` must not be empty, nor ``source_path`` unless the options of the connector name the source.
    ``models_path`` holds the stored base and, as tables, the marts; by default it lies beside the raw zone.
    ``as_of`` replaces today's date everywhere, so that a run can be repeated. ``raw_partition_by=("date",)`` lets the
    gate and refreshes of some days read those days only, for the price of one shuffle of the raw data; by default the
    raw zone is written as it comes. With a ``warehouse_format`` the raw zone is copied out through that connector;
    without, it is registered as a table in place. ``suites`` names the marts whose expectations are run.
    ``on_bad_data`` says what a failing expectation does: the default only reports it. ``enforce_contract`` says whether a raw table
    that breaks its contract stops the run. ``profiled`` names the measures whose daily metrics are scored, by default all.
    ``sketches`` names staged columns whose distinct counts, quantiles, distributions or text lengths a run watches by day; the base holds
    them, so that days add up to any period. ``cluster_files`` is the number of files over which marts that are written as tables are laid
    out by country and day, so that readers of either skip most of them; 0 writes them as they come. ``scan_split`` is the split size of scans that read few columns of wide files, e.g. ``512m``; it does not apply to
    copies of whole rows.
    """

    source_path: str
    raw_path: str
    source_format: str = "parquet"
    source_options: Mapping[str, str] = field(default_factory=dict)
    history_path: str = ""
    models_path: str = ""
    raw_table: str = "covid19_raw"
    raw_partition_by: tuple[str, ...] = ()
    warehouse_format: str = ""
    warehouse_options: Mapping[str, str] = field(default_factory=dict)
    database: str = ""
    monitoring_prefix: str = "monitoring_"
    as_of: date | None = None
    materialized: str = "view"
    on_bad_data: str = "report"
    suites: tuple[str, ...] = ("mart_pandemic_impact",)
    enforce_contract: bool = True
    profiled: tuple[str, ...] = ()
    sketches: tuple[str, ...] = ()
    cluster_files: int = 0
    scan_split: str = ""

    def __post_init__(self) -> None:
        if not self.raw_path:
            raise ValueError("raw_path must not be empty")
        if not self.source_path and not self.source_options:
            raise ValueError("source_path must not be empty unless source_options name the source")
        if self.materialized not in MATERIALIZATIONS:
            raise ValueError(f"materialized must be one of {MATERIALIZATIONS}")
        if self.on_bad_data not in FAILURE_MODES:
            raise ValueError(f"on_bad_data must be one of {FAILURE_MODES}")

    @classmethod
    def from_env(cls, prefix: str = "TALLYWARD_", env: Mapping[str, str] | None = None) -> Config:
        """Read ``<prefix>SOURCE_PATH``, ``<prefix>RAW_PATH``, ... ; missing optional names keep their default.

        Options are written ``name=value,name=value``, lists ``item,item``.
        """
        env = os.environ if env is None else env
        text = {
            name: env[prefix + name.upper()]
            for name in (
                "source_path",
                "raw_path",
                "source_format",
                "history_path",
                "models_path",
                "scan_split",
                "raw_table",
                "warehouse_format",
                "database",
                "monitoring_prefix",
                "materialized",
                "on_bad_data",
            )
            if prefix + name.upper() in env
        }
        options = {
            name: _pairs(env[prefix + name.upper()])
            for name in ("source_options", "warehouse_options")
            if prefix + name.upper() in env
        }
        as_of = env.get(prefix + "AS_OF")
        lists = {
            name: tuple(item for item in env[prefix + name.upper()].split(",") if item)
            for name in ("raw_partition_by", "suites", "profiled", "sketches")
            if prefix + name.upper() in env
        }
        switches = {
            name: env[prefix + name.upper()].lower() in ("1", "true", "yes")
            for name in ("enforce_contract",)
            if prefix + name.upper() in env
        }
        numbers = {name: int(env[prefix + name.upper()]) for name in ("cluster_files",) if prefix + name.upper() in env}
        return cls(
            **({"source_path": "", "raw_path": ""} | text | options | lists | switches | numbers),
            as_of=date.fromisoformat(as_of) if as_of else None,
        )

    @property
    def base_path(self) -> str:
        return f"{self.models_path or self.raw_path.rstrip('/') + '_models'}/daily_country_base"

    def mart_path(self, name: str) -> str:
        return f"{self.models_path or self.raw_path.rstrip('/') + '_models'}/{name}"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}" if self.database else name
