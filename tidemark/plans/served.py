"""Served tables: intervals and minutes that are built once from the raw events and then answer all questions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import EngineConfig
from tidemark.operators import minutes, sessions
from tidemark.sources import files
from tidemark.sources.adapters import sample_content, sample_events
from tidemark.sources.folders import file_system, remove, shared_folder

SOURCES = ("events", "part", "nation")


@dataclass(frozen=True)
class Served:
    """Where the tables lie, and the state of the sources that they were built from."""

    folder: str
    stamp: tuple

    def minutes(self, spark: SparkSession, first_minute: int | None = None, last_minute: int | None = None) -> DataFrame:
        return files.read_minutes(spark, f"{self.folder}/minutes", first_minute, last_minute).drop("minute_date")

    def totals(self, spark: SparkSession) -> DataFrame:
        """Counts of each minute over all dimensions."""
        return spark.read.parquet(f"{self.folder}/totals")

    def intervals(self, spark: SparkSession) -> DataFrame:
        return files.read_intervals(spark, f"{self.folder}/intervals")


#: By application, sources and configuration.
_TABLES: dict[tuple, Served] = {}


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    out = []
    for name in SOURCES:
        system, path = file_system(spark, f"{sf_dir}/{name}.parquet")
        out.append((system.getContentSummary(path).getLength(), system.getFileStatus(path).getModificationTime()))
    return tuple(out)


def build(spark: SparkSession, sf_dir: str, config: EngineConfig) -> Served:
    """Builds intervals from the events, and minutes and their totals from the intervals as stored."""
    served = Served(shared_folder(spark, "served"), _stamp(spark, sf_dir))
    events = sessions.normalize_events(sample_events(spark, sf_dir), sample_content(spark, sf_dir), config)
    files.write_intervals(sessions.active_intervals(events, config), f"{served.folder}/intervals")
    files.write_minutes(minutes.occupancy(served.intervals(spark), config.dims), f"{served.folder}/minutes")
    minutes.occupancy(served.intervals(spark), ()).repartition(1).sortWithinPartitions("minute_id").write.parquet(f"{served.folder}/totals")  # a row for each minute
    return served


def refresh(spark: SparkSession, sf_dir: str, config: EngineConfig) -> Served:
    """Builds the tables anew, in place of those that were served."""
    key = (spark.sparkContext.applicationId, sf_dir, config)
    old, _TABLES[key] = _TABLES.get(key), build(spark, sf_dir, config)
    if old:
        remove(spark, old.folder)
    return _TABLES[key]


def served(spark: SparkSession, sf_dir: str, config: EngineConfig) -> Served:
    """The tables of these sources; they are built at the first question, and again when a source has changed."""
    key = (spark.sparkContext.applicationId, sf_dir, config)
    if key not in _TABLES or _TABLES[key].stamp != _stamp(spark, sf_dir):
        return refresh(spark, sf_dir, config)
    return _TABLES[key]
