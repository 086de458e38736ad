"""Intermediate tables in the folder all executors can write to."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from threading import Lock
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyproof.sources.registry import Source

SETTING = "spark.checkpoint.dir"
_RUN = "tallyproof.run_folder"


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names, or one in its warehouse, which is shared as well."""
    named = spark.conf.get(SETTING, None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"


def run_folder(spark: SparkSession) -> str:
    """Where to store now: the folder of the `intermediates` block around, or the shared one."""
    return spark.sparkContext.getLocalProperty(_RUN) or shared_folder(spark)


def _folder(spark: SparkSession, path: str):
    """A path and its file system, whatever that is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder."""
    folder, system = _folder(spark, path)
    system.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    folder, system = _folder(spark, path)
    return system.exists(folder)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[str]:
    """A folder for what is stored by this thread (and those that inherit its properties)
    until the end of the block, when it is removed.

    A check's DataFrame reads what was stored when it was built, so use it up inside."""
    context = spark.sparkContext
    outer = context.getLocalProperty(_RUN)
    path = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    context.setLocalProperty(_RUN, path)
    try:
        yield path
    finally:
        context.setLocalProperty(_RUN, outer)
        remove(spark, path)


@dataclass(frozen=True)
class Stored:
    """A written frame and the aggregates taken while it was written."""

    frame: DataFrame
    measures: dict[str, Any]


def store(frame: DataFrame, **measures: str) -> Stored:
    """Writes `frame` to the shared folder and reads it back.

    For results that are used twice, or that a large table is joined to next: the
    planner can only estimate their size and range, the `measures` (name -> aggregate
    in SQL) are exact. Being files, the rows also outlive the executors. Within
    `intermediates` they go with its folder, else they stay.
    """
    spark = frame.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    seen = Observation()
    aggregates = [F.expr(f"{sql} AS {name}") for name, sql in measures.items()]
    (frame.observe(seen, *aggregates) if aggregates else frame).write.parquet(path)
    return Stored(
        spark.read.schema(frame.schema).parquet(path), seen.get if aggregates else {}
    )


class SharedReads:
    """A source for the span of one report: what several checks read is made once."""

    def __init__(self, source: Source):
        self._source = source
        self._guard = Lock()
        self._locks: dict[Hashable, Lock] = {}
        self._made: dict[Hashable, Any] = {}

    def table(self, name: str) -> DataFrame:
        return self._source.table(name)

    def once(self, key: Hashable, make: Callable[[], Any]) -> Any:
        """The result of the first `make` for `key` that did not fail."""
        with self._guard:
            lock = self._locks.setdefault(key, Lock())
        with lock:
            if key not in self._made:
                self._made[key] = make()
            return self._made[key]
