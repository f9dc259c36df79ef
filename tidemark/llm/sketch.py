"""Count-min sketches of anchors, merged over partitions, as a prefilter for repeated windows.

A window of W items holds W - k + 1 runs of k items; its anchor is the run with the smallest hash. Equal windows have
equal anchors, so a window can only be repeated if its anchor is counted at least twice. Anchors are a small part
of all runs, since neighbouring windows share them.

Each task counts its anchors in a sketch of ``depth`` rows with ``cells`` counters that stop at two, and sends only what
it has touched, by slices of the rows. Slices are merged in parallel. What remains is one bit per counter.

A sketch of one size lets nearly everything through once the anchors outnumber its cells. So the anchors are split into
ranges of a hash, as many as keep ``load`` anchors a cell, and each range has a sketch of its own. All are counted in one pass
and written to a table in the shared folder. A task that asks holds what it found in many texts and opens one range after
the other, ``depth * cells / 8`` bytes at a time; nothing of them goes through the driver. Counters are only ever too
high: a repeated window is never held back.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import released
from tidemark.llm.rolling import mixed
from tidemark.session import scratch

FLUSH = 4_000_000
KEY_BYTES = 12              # of the key of a document


@dataclass(frozen=True)
class SketchShape:
    depth: int = 2
    cells: int = 1 << 28         # a row; a power of two. 2 rows of 2^28 bits are at most 64 MB, less while sparse
    slice_cells: int = 1 << 20
    load: float = 0.25           # anchors a cell: of those that occur once, (1 - exp(-load)) ** depth pass, here 5 %

    @property
    def slices(self) -> int:
        return self.cells // self.slice_cells

    def ranges(self, anchors: float) -> int:
        return max(1, math.ceil(anchors / (self.cells * self.load)))


#: Of documents there are far fewer than of anchors: 4 MB at most.
DOCUMENTS = SketchShape(cells=1 << 24)


_CODEC = pa.Codec("zstd", compression_level=4)


def squeezed(data: bytes) -> bytes:
    """The length, and the data compressed."""
    return struct.pack("<q", len(data)) + _CODEC.compress(data, asbytes=True)


def unsqueezed(data: bytes) -> bytes:
    return _CODEC.decompress(data[8:], struct.unpack("<q", data[:8])[0], asbytes=True)


class PackedBits:
    """The bits of a merged sketch, compressed on their way, expanded once in each process that asks for them."""

    def __init__(self, bits: np.ndarray) -> None:
        self.shape, self.data, self.open = bits.shape, squeezed(bits.tobytes()), None

    def __getstate__(self) -> tuple:
        return self.shape, self.data

    def __setstate__(self, state: tuple) -> None:
        self.shape, self.data = state
        self.open = None

    def bits(self) -> np.ndarray:
        if self.open is None:
            self.open = np.frombuffer(unsqueezed(self.data), np.uint8).reshape(self.shape)
        return self.open


def cells_of(hashes: np.ndarray, shape: SketchShape) -> Iterator[np.ndarray]:
    """The cell of each hash in each row."""
    for row in range(shape.depth):
        yield (mixed(hashes + np.uint64(row * 2 + 1)) & np.uint64(shape.cells - 1)).astype(np.int64)


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each hash, by other bits than its cells."""
    return ((mixed(hashes ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _sent(hashes: np.ndarray, shape: SketchShape, ranges: int) -> Iterator[pa.RecordBatch]:
    """Touched cells of one task's sketches: per range and slice, steps between cells counted once, and more than once."""
    names = ["range", "slice", "once", "often", "windows"]
    number = range_of(hashes, ranges)
    order = np.argsort(number, kind="stable")
    limits = np.searchsorted(number[order], np.arange(ranges + 1))
    for r in np.flatnonzero(np.diff(limits)).tolist():
        own = hashes if ranges == 1 else hashes[order[limits[r]:limits[r + 1]]]
        slices, once, often = [], [], []
        for row, cells in enumerate(cells_of(own, shape)):
            cell, n = np.unique(cells, return_counts=True)
            bounds = np.searchsorted(cell, np.arange(shape.slices + 1) * shape.slice_cells)
            for s in np.flatnonzero(np.diff(bounds)):
                part, many = cell[bounds[s]:bounds[s + 1]] - s * shape.slice_cells, n[bounds[s]:bounds[s + 1]] > 1
                slices.append(row * shape.slices + int(s))
                once.append(squeezed(np.diff(part[~many], prepend=0).astype("<u4").tobytes()))
                often.append(squeezed(np.diff(part[many], prepend=0).astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r] * len(slices), pa.int32()), pa.array(slices, pa.int32()), pa.array(once, pa.binary()),
             pa.array(often, pa.binary()), pa.array([0] * len(slices), pa.int64())], names=names)


def _merged(docs: DataFrame, anchors: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, int]]], shape: SketchShape,
            ranges: int, parts: int) -> DataFrame:
    """range, slice, bits: the counters that reached two; and, under range -1, windows: how many there are."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, windows = [], 0, 0
        for batch in batches:
            for hashes, n in anchors(batch):
                held.append(hashes)
                size, windows = size + len(hashes), windows + n
                if size >= FLUSH:
                    yield from _sent(np.concatenate(held), shape, ranges)
                    held, size = [], 0
        if held:
            yield from _sent(np.concatenate(held), shape, ranges)
        if windows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int32()), pa.array([0], pa.int32()), pa.array([b""], pa.binary()),
                 pa.array([b""], pa.binary()), pa.array([windows], pa.int64())], names=["range", "slice", "once", "often", "windows"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[tuple[int, int], np.ndarray] = {}
        total = 0
        for batch in batches:
            for r, s, once, often, windows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r < 0:
                    total += windows
                    continue
                if (r, s) not in counters:
                    counters[r, s] = np.zeros(shape.slice_cells, np.uint8)
                own = counters[r, s]
                at = np.cumsum(np.frombuffer(unsqueezed(once), "<u4").astype(np.int64))
                own[at] = np.minimum(2, own[at] + 1)
                own[np.cumsum(np.frombuffer(unsqueezed(often), "<u4").astype(np.int64))] = 2
        rows = [(r, s, squeezed(np.packbits(c > 1).tobytes()), 0) for (r, s), c in counters.items()]
        rows += [(-1, 0, b"", total)] if total else []
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in rows], k) for i, k in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.int64()))],
            names=["range", "slice", "bits", "windows"])

    touched = docs.mapInArrow(released(count), "range int, slice int, once binary, often binary, windows long")
    # A task merges some slices of one range, so that a range is a few files.
    return touched.repartition(parts * ranges, "range", F.col("slice") % parts).mapInArrow(released(merge), _SLICES)


_SLICES = "range int, slice int, bits binary, windows long"
_opened: dict[tuple[str, int], np.ndarray] = {}     # the one range that this process asked last


def forget() -> None:
    """For tasks after the last question: their process may still hold what an earlier task has asked."""
    _opened.clear()


@dataclass(frozen=True)
class StoredSketch:
    """Where the merged sketches are; small enough to go with every task."""

    path: str
    shape: SketchShape
    ranges: int

    def bits(self, number: int) -> np.ndarray:
        if (self.path, number) not in _opened:
            _opened.clear()
            shape = self.shape
            bits = np.zeros((shape.depth * shape.slices, shape.slice_cells // 8), np.uint8)
            system, root = fs.FileSystem.from_uri(self.path)
            for file in system.get_file_info(fs.FileSelector(f"{root}/range={number}", allow_not_found=True)):
                if file.base_name.endswith(".parquet"):
                    with system.open_input_file(file.path) as source:
                        for batch in pq.ParquetFile(source).iter_batches(16, columns=["slice", "bits"]):
                            for s, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                                bits[s] = np.frombuffer(unsqueezed(data), np.uint8)
            _opened[self.path, number] = bits.reshape(shape.depth, -1)
        return _opened[self.path, number]

    def maybe_repeated(self, hashes: np.ndarray) -> np.ndarray:
        """False only for hashes that were counted once at most."""
        if self.ranges == 1:
            return _hits(hashes, self.bits(0), self.shape)
        hit, number = np.zeros(len(hashes), bool), range_of(hashes, self.ranges)
        order = np.argsort(number, kind="stable")
        limits = np.searchsorted(number[order], np.arange(self.ranges + 1))
        for r in np.flatnonzero(np.diff(limits)).tolist():
            own = order[limits[r]:limits[r + 1]]
            hit[own] = _hits(hashes[own], self.bits(r), self.shape)
        return hit

    def screened(self, found: Iterator[tuple[int, np.ndarray, Any]], held: int) -> Iterator[tuple[np.ndarray, Any]]:
        """``found`` gives bytes of text, hashes, and anything; back come which hashes may be repeated, and the same thing.

        With several ranges about ``held`` bytes of text wait for each other, so that a range is opened once for all of them.
        """
        waiting: list[tuple[np.ndarray, Any]] = []
        size = 0

        def told() -> Iterator[tuple[np.ndarray, Any]]:
            hit = self.maybe_repeated(np.concatenate([h for h, _ in waiting])) if waiting else None
            done = 0
            while waiting:
                hashes, thing = waiting.pop(0)
                yield hit[done:done + len(hashes)], thing
                done += len(hashes)

        for n, hashes, thing in found:
            waiting.append((hashes, thing))
            size += n
            if self.ranges == 1 or size >= held:
                yield from told()
                size = 0
        yield from told()


def stored_sketch(docs: DataFrame, anchors: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, int]]],
                  shape: SketchShape, expected: float) -> tuple[StoredSketch, int]:
    """Sketches of the anchors, of which about ``expected`` will come, and the number of windows in all.

    ``anchors(batch)`` gives hashes of anchors, and the windows that they stand for. More anchors than expected only
    let more through.
    """
    spark, ranges = docs.sparkSession, shape.ranges(expected)
    path = scratch(spark, "llm-sketch")
    _merged(docs, anchors, shape, ranges, 16).write.partitionBy("range").parquet(path)
    windows = spark.read.schema(_SLICES).parquet(path).filter("range = -1").agg(F.sum("windows")).first()[0]
    return StoredSketch(path, shape, ranges), windows or 0


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _hits(hashes: np.ndarray, bits: np.ndarray, shape: SketchShape) -> np.ndarray:
    hit = np.ones(len(hashes), bool)
    for row, cells in enumerate(cells_of(hashes, shape)):
        hit &= (bits[row][cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)
    return hit


def _key_hashes(keys: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(keys[:, :8]).view("<u8")[:, 0]


def keys_present(packed: DataFrame) -> PackedBits:
    """A sketch of the document keys in a packed table: which documents have anything to remove."""
    def keys(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
        for own in batch.column("keys").to_pylist():
            yield np.repeat(_key_hashes(np.frombuffer(own, np.uint8).reshape(-1, KEY_BYTES)), 2), 0  # twice: seen is enough

    shape = DOCUMENTS
    bits = np.zeros((shape.depth * shape.slices, shape.slice_cells // 8), np.uint8)
    # The number of slices is fixed by the shape, so all that comes to the driver is the size of one sketch.
    for r in _merged(packed.select("keys"), keys, shape, 1, shape.depth * shape.slices).collect():
        bits[r["slice"]] = np.frombuffer(unsqueezed(r["bits"]), np.uint8)
    return PackedBits(bits.reshape(shape.depth, -1))


def maybe_present(keys: list[bytes], packed: PackedBits) -> np.ndarray:
    """False only for documents that have nothing to remove."""
    return _hits(_key_hashes(np.frombuffer(b"".join(keys), np.uint8).reshape(-1, KEY_BYTES)), packed.bits(), DOCUMENTS)


def hot_anchors(docs: DataFrame, kinds, held: int, bound: int, items: int) -> np.ndarray:
    """Anchors, in order, with at least ``bound`` kinds of neighbourhoods, each kind counted once every ``held`` items.

    ``kinds`` yields anchors and hashes of neighbourhoods for the batches of a task. A count is sent where it is a share of the bound that
    as many senders could add up to a quarter of it, so few rows travel, and no anchor above 5/4 of the bound is missed. At
    most ``items / bound`` anchors come to the driver.
    """
    senders = docs.rdd.getNumPartitions() + items // held
    least = max(1, bound // (4 * senders))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: list[np.ndarray] = []

        def told() -> Iterator[pa.RecordBatch]:
            if have:
                both = np.concatenate(have)
                have.clear()
                both = both[np.lexsort((both[:, 1], both[:, 0]))]
                new = np.ones(len(both), bool)
                new[1:] = (both[1:] != both[:-1]).any(axis=1)
                anchors, n = np.unique(both[new, 0], return_counts=True)
                many = n >= least
                yield pa.RecordBatch.from_arrays([pa.array(anchors[many].view(np.int64)), pa.array(n[many], pa.int64())], names=["anchor", "n"])

        size = 0
        for anchors, hashes in kinds(batches):
            have.append(np.stack([anchors, hashes], axis=1))
            size += len(anchors)
            if size >= held:
                yield from told()
                size = 0
        yield from told()

    rows = docs.mapInArrow(released(counted), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).filter(F.col("n") >= bound)
    return np.sort(np.array([r["anchor"] for r in rows.collect()], np.int64).view(np.uint64))


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in an ordered array."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values
