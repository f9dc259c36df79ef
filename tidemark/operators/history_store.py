"""A stored type-2 history whose writes follow its changes.

Closed versions never change, so they are segments that are only added. Open versions lie in hash buckets of the key, one
folder each, and a release replaces only the buckets in which a version opens or closes. A log entry names the segments and
the folder of each bucket, so a release is visible as a whole or not at all, and one that changes nothing writes nothing.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.entries import NumberedLog, remove
from tidemark.operators.history import END, empty_history, version_changes
from tidemark.operators.quality import CheckFailed, failing, stop_on
from tidemark.sources.csv_release import names_in


class HistoryStore:
    """History of ``keys`` and ``tracked`` columns under one folder, in ``buckets`` buckets."""

    LOG = ("release_seq bigint, schema string, closed array<string>, open map<string, string>, rows_closed bigint, "
           "rows_opened bigint, buckets_replaced bigint, published_at timestamp")

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], tracked: Sequence[str], buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys, self.tracked, self.buckets = list(keys), list(tracked), buckets
        self.log = NumberedLog(spark, f"{self.root}/log", self.LOG)

    def exists(self) -> bool:
        return bool(self.log.numbers())

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _files(self, paths: Sequence[str], schema: StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _open(self, entry: SimpleNamespace, only: Sequence[int] | None = None) -> DataFrame:
        wanted = [p for b, p in entry.open.items() if only is None or int(b) in set(only)]
        return self._files(wanted, StructType.fromJson(json.loads(entry.schema)))

    def _whole(self, entry: SimpleNamespace) -> DataFrame:
        schema = StructType.fromJson(json.loads(entry.schema))
        return self._files([*entry.closed, *entry.open.values()], schema)

    def read(self) -> DataFrame:
        entry = self.log.last()
        if entry is None:
            raise FileNotFoundError(f"nothing published under {self.root}")
        return self._whole(entry)

    def writes(self) -> DataFrame:
        """What each release wrote."""
        return self.log.read().select("release_seq", "rows_closed", "rows_opened", "buckets_replaced")

    def apply(self, snapshot: DataFrame, seq: int, check: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, int]:
        """Advance to a complete snapshot of release ``seq``; applying it again changes nothing.

        Changes are computed and written once. ``check`` is asked about the whole history as it would be.
        """
        latest = self.log.last()
        if latest and latest.release_seq > seq:
            raise CheckFailed(f"{self.root}: no_older_snapshot: {seq} after {latest.release_seq}")
        empty = empty_history(snapshot, self.keys, self.tracked)
        known = self._open(latest) if latest else empty
        columns, base = empty.columns, f"{self.root}/data/{seq}-{uuid.uuid4().hex}"
        try:
            version_changes(known, snapshot, seq, self.keys, self.tracked).write.partitionBy("_kind").parquet(
                f"{base}/changes")
            kinds = names_in(self.spark, f"{base}/changes")
            closed = [f"{base}/changes/_kind=closed"] if "_kind=closed" in kinds else []
            opened = [f"{base}/changes/_kind=opened"] if "_kind=opened" in kinds else []
            entry = SimpleNamespace(closed=[*(latest.closed if latest else []), *closed],
                                    open=dict(latest.open) if latest else {}, schema=empty.schema.json())
            changed = self._files([*closed, *opened], empty.schema).withColumn("_bucket", self._bucket())
            # One row a bucket comes back, at most as many as there are buckets.
            told = changed.groupBy("_bucket").agg(F.count(END).alias("closed"), F.count_if(F.col(END).isNull()).alias("opened")).collect()
            counts = {"closed": sum(r["closed"] for r in told), "opened": sum(r["opened"] for r in told), "buckets": len(told)}
            if told:
                touched = [r["_bucket"] for r in told]
                gone = self._files(closed, empty.schema).select(*self.keys)
                stay = (self._open(latest, touched) if latest else empty).join(gone, self.keys, "left_anti")
                new = self._files(opened, empty.schema)
                stay.unionByName(new).withColumn("_bucket", self._bucket()).select(*columns, "_bucket").repartition(
                    "_bucket").write.partitionBy("_bucket").parquet(f"{base}/open")
                for b in touched:
                    entry.open.pop(str(b), None)
                for name in names_in(self.spark, f"{base}/open"):
                    if name.startswith("_bucket="):
                        entry.open[name.split("=", 1)[1]] = f"{base}/open/{name}"
            if check:
                stop_on(failing(check(self._whole(entry))), self.root)
            if told or latest is None:
                self.log.add((latest.number if latest else 0) + 1, {
                    "release_seq": seq, "schema": entry.schema, "closed": entry.closed, "open": entry.open,
                    "rows_closed": counts["closed"], "rows_opened": counts["opened"], "buckets_replaced": counts["buckets"],
                    "published_at": dt.datetime.now(dt.timezone.utc).isoformat()})
            else:
                remove(self.spark, base)
        except Exception:
            remove(self.spark, base)
            raise
        return counts
