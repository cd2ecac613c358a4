"""Folders that are replaced as a whole: each write makes a new version, readers see the newest complete one.

A write goes to a folder of its own name, an attempt, which readers pass over. When it is complete it claims the next number, which only one
writer can have, and is renamed to it: so two writers at once make two versions. What a writer that failed has left is pruned later.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

PREFIX = "v="
ATTEMPT = "_attempt-"
CLAIM = "_claim-"
# A number that somebody has claimed should become a version within these seconds; attempts that are older than these days are dead.
PATIENCE = 30.0
DEAD_DAYS = 7


def folder(spark: SparkSession, path: str):
    """The file system of ``path``, and the path on it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = folder(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    system, place = folder(spark, path)
    system.delete(place, True)


def _entries(spark: SparkSession, path: str) -> list:
    system, place = folder(spark, path)
    return list(system.listStatus(place)) if system.exists(place) else []


def _numbers(spark: SparkSession, path: str, complete: bool, prefix: str = PREFIX) -> list[int]:
    names = [entry.getPath().getName() for entry in _entries(spark, path)]
    found = [name for name in names if name.startswith(prefix) and name.removeprefix(prefix).isdigit()]
    if complete:
        found = [name for name in found if exists(spark, f"{path}/{name}/_SUCCESS")]
    return sorted(int(name.removeprefix(prefix)) for name in found)


def attempt(path: str) -> str:
    """Where a writer of the next version writes to."""
    return f"{path}/{ATTEMPT}{uuid.uuid4().hex}"


def _claim(spark: SparkSession, path: str, number: int) -> bool:
    """Make the file that stands for a number; False if somebody has."""
    system, place = folder(spark, f"{path}/{CLAIM}{number}")
    if system.exists(place):
        return False
    try:
        system.create(place, False).close()
    except Py4JJavaError as failure:
        if "FileAlreadyExists" not in str(failure.java_exception.getClass().getName()):
            raise
        return False
    return True


def complete_numbers(spark: SparkSession, path: str) -> list[int]:
    return _numbers(spark, path, complete=True)


def newest(spark: SparkSession, path: str) -> int:
    """The number of the newest complete version, 0 where there is none."""
    return max(_numbers(spark, path, complete=True), default=0)


def publish(spark: SparkSession, written: str, path: str, after: int | None = None) -> int | None:
    """Make a complete attempt the next version, and return its number.

    With ``after``, the number of the version that the attempt was made from, it is published only if that is still the newest one;
    otherwise nothing happens. A writer that claimed the number and died before it came to be is waited for, then passed over.
    """
    number = (max([0, *_numbers(spark, path, False), *_numbers(spark, path, False, CLAIM)]) if after is None else after) + 1
    while not _claim(spark, path, number):
        deadline = time.monotonic() + PATIENCE
        while after is not None and newest(spark, path) < number and time.monotonic() < deadline:
            time.sleep(0.2)
        if after is not None and newest(spark, path) >= number:
            return None
        number += 1
    if after is not None and newest(spark, path) != after:
        return None
    system, place = folder(spark, written)
    if not system.rename(place, folder(spark, f"{path}/{PREFIX}{number}")[1]):
        raise OSError(f"{written} could not be renamed to version {number}")
    return number


def following(spark: SparkSession, path: str) -> str:
    """Where the next version is to be written."""
    numbers = _numbers(spark, path, complete=False)
    return f"{path}/{PREFIX}{numbers[-1] + 1 if numbers else 1}"


def current(spark: SparkSession, path: str) -> str:
    """The newest complete version; ``path`` itself where there are no versions."""
    numbers = _numbers(spark, path, complete=True)
    return f"{path}/{PREFIX}{numbers[-1]}" if numbers else path


def before(spark: SparkSession, path: str) -> str | None:
    """The complete version before the newest one, if there is one."""
    numbers = _numbers(spark, path, complete=True)
    return f"{path}/{PREFIX}{numbers[-2]}" if len(numbers) > 1 else None


def complete(spark: SparkSession, path: str) -> None:
    """Say that a version is complete where its writer has not: one that replaced partitions of it."""
    system, place = folder(spark, f"{path}/_SUCCESS")
    system.create(place, True).close()


def prune(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all versions but the newest ``keep`` complete ones; readers of the one before the current can finish."""
    kept = _numbers(spark, path, complete=True)[-keep:]
    for number in _numbers(spark, path, complete=False):
        if number not in kept and number < max(kept, default=0):
            delete(spark, f"{path}/{PREFIX}{number}")
    for number in _numbers(spark, path, False, CLAIM):
        if number < min(kept, default=0):
            delete(spark, f"{path}/{CLAIM}{number}")
    dead = (time.time() - DEAD_DAYS * 86_400) * 1000
    for entry in _entries(spark, path):
        if entry.getPath().getName().startswith(ATTEMPT) and entry.getModificationTime() < dead:
            delete(spark, f"{path}/{entry.getPath().getName()}")
