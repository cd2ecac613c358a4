"""Session settings the jobs are written for.

Everything here is a plain Spark setting; nothing in the library depends on it for right results, only
for speed and for a stable meaning of ``current_date()``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    # "today" must not depend on where the driver runs.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    # A fact-to-dimension join is followed by an aggregate that shuffles on other keys anyway, so splitting
    # a hot key never costs a second exchange; force it even where the planner is unsure.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM does not compile methods above 8000 bytes of bytecode. Projections of some 30 columns can pass that
    # when fused into one method; Spark then had better generate one method per operator (2.9 s against 0.5 s
    # for the 34 staged columns of 600,000 rows).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A wide aggregate can leave a row per group and map task: 20,000 tasks with 50,000 groups each are some 300 GB to
    # exchange. Start with many reducers; adaptive execution merges them to the advisory size (and not to the many
    # small ones that it prefers by default, as each writes a file). Streams, which cannot merge and keep a state
    # store per reducer, go by spark.sql.shuffle.partitions instead.
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    # Recording the Python call site of every column expression takes a third of the time to build these queries,
    # which consist of hundreds of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def local_sizes(cores: int | str) -> dict[str, str]:
    """Overrides for a session on one machine: as many reducers as cores."""
    return {
        "spark__sql__shuffle__partitions": str(cores),
        "spark__sql__adaptive__coalescePartitions__initialPartitionNum": str(cores),
    }


def build_session(app_name: str, master: str | None = None, **overrides: str) -> SparkSession:
    """A session with the defaults above; ``overrides`` use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SESSION_DEFAULTS | {name.replace("__", "."): value for name, value in overrides.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the jobs that are started inside; names use ``__`` in place of dots."""
    names = {name.replace("__", "."): value for name, value in values.items() if value}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
