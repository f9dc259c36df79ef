"""Exactly-once available-now ingest of landed releases into append-only raw tables.

The CSV source aligns columns by position, and a file sink keeps one commit log per folder. So each
(dataset, release) has its own stream, checkpoint and segment folder under its own header, and a raw
table is the union of its segments by column name. A later header with new columns simply adds them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.entries import NumberedLog
from tidemark.operators.quality import enforce
from tidemark.sources import csv_release as csv

# What every ingested row must meet where a stream is declared with expectations.
RAW_EXPECTATIONS = {"valid_csv": f"{csv.RESCUED} IS NULL", "release_present": "release_tag IS NOT NULL"}


class RawStore:
    """Segments and checkpoints of the raw tables under one root."""

    def __init__(self, spark: SparkSession, landing: str, root: str):
        self.spark = spark
        self.landing = landing.rstrip("/")
        self.root = root.rstrip("/")

    def segment(self, dataset: str, tag: str) -> str:
        return f"{self.root}/segments/{dataset}/{tag}"

    def checkpoint(self, dataset: str, tag: str) -> str:
        return f"{self.root}/checkpoints/{dataset}/{tag}"

    def header(self, dataset: str, tag: str) -> NumberedLog:
        """The column names of a segment; the last entry counts."""
        return NumberedLog(self.spark, f"{self.root}/headers/{dataset}/{tag}", "columns array<string>")

    def counts(self, dataset: str, tag: str) -> NumberedLog:
        """Rows of a segment as of a committed micro-batch."""
        return NumberedLog(self.spark, f"{self.root}/counts/{dataset}/{tag}", "batch bigint, row_count bigint")

    def start(self, dataset: str, tag: str, strict: bool = True, max_files: int | None = None,
              expectations: Mapping[str, str] | None = None) -> StreamingQuery:
        """Start one stream. The checkpoint persists, so a second run finds nothing new.

        The header is stored next to the segment, so the raw table never asks the landing area again.
        """
        columns = csv.header(self.spark, csv.release_path(self.landing, dataset, tag))
        stored = self.header(dataset, tag).last()
        if stored is None or stored.columns != columns:
            self.header(dataset, tag).append({"columns": columns})
        rows = csv.stream_snapshot(self.spark, self.landing, dataset, tag, strict, max_files)
        if expectations:
            rows = enforce(rows, expectations)
        return (
            rows.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", self.checkpoint(dataset, tag))
            .trigger(availableNow=True)
            .start(self.segment(dataset, tag))
        )

    def ingest(self, datasets: Iterable[str], tags: Sequence[str] | None = None, strict: bool = True,
               max_files: int | None = None, expectations: Mapping[str, str] | None = None, parallel: int = 4) -> int:
        """Ingest the given releases (all landed ones by default); returns the rows added.

        At most ``parallel`` streams go side by side; if one fails, the others are stopped. Rows are counted in
        the segments, whatever the number of micro-batches, and only in those that have committed one since
        they were last counted.
        """
        wanted = [
            (dataset, tag)
            for dataset in datasets
            for tag in csv.landed_releases(self.spark, self.landing, dataset)
            if tags is None or tag in tags
        ]
        before = {release: self._rows(*release) for release in wanted}
        running: list[StreamingQuery] = []
        try:
            for dataset, tag in wanted:
                if len(running) >= parallel:
                    running.pop(0).awaitTermination()
                running.append(self.start(dataset, tag, strict, max_files, expectations))
            while running:
                running.pop(0).awaitTermination()
        except Exception:
            for stream in running:
                stream.stop()
            raise
        return sum(self._rows(*release) - before[release] for release in wanted)

    def _rows(self, dataset: str, tag: str) -> int:
        """Committed rows of a segment. A count holds until the sink commits another batch."""
        names = csv.names_in(self.spark, f"{self.segment(dataset, tag)}/_spark_metadata")
        batch = max((int(n.split(".")[0]) for n in names if n.split(".")[0].isdigit()), default=None)
        if batch is None:
            return 0
        known = self.counts(dataset, tag).last()
        if known is None or known.batch != batch:
            counted = self._read(dataset, tag, self.header(dataset, tag).last().columns).count()
            self.counts(dataset, tag).append({"batch": batch, "row_count": counted})
            return counted
        return known.row_count

    def _headers(self, dataset: str) -> dict[str, list[str]]:
        """Column names of each stored release, in the order of their tags."""
        found = {tag: self.header(dataset, tag).last() for tag in sorted(csv.names_in(self.spark, f"{self.root}/segments/{dataset}"))}
        return {tag: entry.columns for tag, entry in found.items() if entry is not None}

    def table(self, dataset: str, tags: Sequence[str] | None = None) -> DataFrame:
        """The raw table, from stored segments alone. Reading a segment honours its commit log; a
        filter on ``release_tag`` drops the other segments, since the tag is a constant of each."""
        stored = self._headers(dataset)
        parts = [self._read(dataset, tag, columns) for tag, columns in stored.items() if tags is None or tag in tags]
        if not parts:
            raise FileNotFoundError(f"no release of {dataset} under {self.root}")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def _read(self, dataset: str, tag: str, columns: Sequence[str]) -> DataFrame:
        rows = self.spark.read.schema(csv.raw_schema(columns)).parquet(self.segment(dataset, tag))
        return rows.withColumn("release_tag", F.lit(tag))
