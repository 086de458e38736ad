"""Databases by name, and where their tables are read from."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


# Tables that stay small: one row a branch, client or setting.
SMALL_TABLES = frozenset(
    f"database_{name}" for name in ("branch", "client", "sale_settings", "purchase_settings")
)


class Source(Protocol):
    """Anything that hands out the audited tables by name."""

    def table(self, name: str) -> DataFrame: ...


@dataclass(frozen=True)
class ParquetSource:
    """Tables stored as ``<root>/<table>``."""

    spark: SparkSession
    root: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")


@dataclass(frozen=True)
class ReadSplit:
    """Numeric column range a JDBC table is read in parallel by."""

    column: str
    lower: int
    upper: int
    partitions: int


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a live database.

    Tables named in `splits` are read by many tasks at once; the others by one, so only
    `dimensions` may do without. A condition in `where` (on its table's columns, in the
    database's SQL) is evaluated by the database, which keeps history that no check needs
    there: a day range for item tables, say. Gap checks look for numbers in all history,
    so a condition on a head table must keep every document of the series audited.
    """

    spark: SparkSession
    url: str
    options: dict[str, str] = field(default_factory=dict)
    splits: dict[str, ReadSplit] = field(default_factory=dict)
    where: dict[str, str] = field(default_factory=dict)
    dimensions: frozenset[str] = SMALL_TABLES

    def read_options(self, name: str) -> dict[str, str]:
        condition = self.where.get(name)
        read = f"(SELECT * FROM {name} WHERE {condition}) AS t" if condition else name
        chosen = {"fetchsize": "10000", **self.options, "url": self.url, "dbtable": read}
        split = self.splits.get(name)
        if split:
            chosen |= {
                "partitionColumn": split.column,
                "lowerBound": str(split.lower),
                "upperBound": str(split.upper),
                "numPartitions": str(split.partitions),
            }
        elif name not in self.dimensions:
            raise ValueError(f"{name} would be read by one task; name a ReadSplit for it")
        return chosen

    def table(self, name: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.read_options(name)).load()


class Registry:
    """Sources in report order. Names are looked up without regard to case."""

    def __init__(self, sources: dict[str, Source] | None = None):
        self._sources: dict[str, Source] = {}
        for name, source in (sources or {}).items():
            self.add(name, source)

    def add(self, name: str, source: Source) -> None:
        self._sources[name.upper()] = source

    def names(self) -> list[str]:
        return list(self._sources)

    def open(self, name: str) -> Source:
        try:
            return self._sources[name.upper()]
        except KeyError:
            raise ValueError(f"Unknown source: {name}") from None

    def load(self, name: str, table: str) -> DataFrame:
        return self.open(name).table(table)
