"""Releases streamed straight into current tables: each micro-batch is merged once, whatever is replayed.

A file stream hands its micro-batches to a merge that is named after the release and the batch. A batch that was merged
before a crash, but not yet committed by the stream, comes again under the same number and is skipped. What the release
does not hold is deleted when the stream has reached its end, which may be repeated.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.releases import parse_tag
from tidemark.operators import quality
from tidemark.operators.snapshot import VersionedTable
from tidemark.plans import silver
from tidemark.plans.schema import DATASETS, POINTS
from tidemark.sources import csv_release as csv


class SnapshotStream:
    """The current table of one dataset, fed by the landed releases under ``landing``."""

    def __init__(self, spark: SparkSession, landing: str, root: str, dataset: str, min_season: int, points: str = POINTS):
        self.spark, self.landing, self.root, self.dataset = spark, landing, root.rstrip("/"), dataset
        self.min_season, self.points = min_season, points
        self.table = VersionedTable(spark, f"{self.root}/current/{dataset}")

    def merge_batch(self, tag: str, rows: DataFrame, batch: int) -> bool:
        """Gate, clean, check and merge one micro-batch; False if it was merged before."""
        keys = DATASETS[self.dataset].keys
        quality.raise_if_failed(silver.input_checks(self.dataset, rows, tag), f"raw {self.dataset}")
        cleaned = silver.clean(self.dataset, rows, tag, self.min_season, points=self.points)
        return self.table.merge_part(
            cleaned, keys, parse_tag(tag), f"{tag}#{batch}", silver.expectations(self.dataset, tag),
            lambda written: quality.unique_check(written, keys))

    def run(self, tag: str, parents: Mapping[str, DataFrame] | None = None, max_files: int | None = None) -> DataFrame:
        """Merge a release to its end and check its references; returns its ``(change, n)``."""
        stream = csv.stream_snapshot(self.spark, self.landing, self.dataset, tag, max_files=max_files)
        (stream.writeStream.foreachBatch(lambda rows, batch: self.merge_batch(tag, rows, batch))
         .option("checkpointLocation", f"{self.root}/checkpoints/{self.dataset}/{tag}")
         .trigger(availableNow=True).start().awaitTermination())
        self.table.merge_end(parse_tag(tag))
        # Keys were checked with each part that was merged, and the end only takes rows away.
        references = silver.reference_checks(self.dataset, self.table.read(), tag, parents) if parents else []
        if references:
            quality.raise_if_failed(quality.union_rows(references), f"current {self.dataset}")
        return self.table.changes_of(parse_tag(tag))
