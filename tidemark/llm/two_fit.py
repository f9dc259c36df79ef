"""Packing of token pieces into sequences of fixed length, by best-two-fit.

A document is its ids and one closing id. Documents longer than a sequence are cut into pieces of a whole sequence, the
first of which takes what is over. A sequence is filled greedily: the longest piece that fits, again and again. Then, if it
holds several, its smallest piece is replaced by the two unpacked ones that fill the widened gap best, if they fill
it better.

Which pieces of one length are chosen is of no matter to the number of sequences, so the plan is made from the number of
pieces of each length, which is all that comes to the driver: at most ``capacity`` numbers. The same filling
is used as many times as the counts allow, which is what doing it one by one would give. A step uses up a length to below
its number in one sequence, so a plan has at most sum(capacity / length), some 17,000, kinds of sequences at 2,048 tokens,
whatever the size of the table; it goes to all tasks. There each piece finds its place by its number among the pieces of its
length: counted within a task when the pieces are written, and summed over the tasks before it.

Defined results: a null or empty text is its closing id. Special tokens written in a text are those tokens, as in the
library. Repeated rows and null ids are packed like any others. An empty table gives an empty result. Extra columns play
no part. Texts are encoded whole, however long.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_tokens import ByteEncoder
from tidemark.llm.common import kept, pick, texts_of
from tidemark.llm.rolling import slabs

CAPACITY = 2048
CLOSING = 0
_RANK_BITS = 48


@dataclass(frozen=True)
class Filling:
    """One kind of sequence: how many pieces of each length it holds, and how many such sequences there are."""

    lengths: tuple[tuple[int, int], ...]
    times: int


def best_two_fit(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Filling]:
    """The plan for so many pieces of each length."""
    left = {n: c for n, c in counts.items() if c}
    if left and not 0 < min(left) <= max(left) <= capacity:
        raise ValueError("a piece is at least one and at most a sequence long")
    # Bit n of ``open_`` is set if there are pieces of length n; ``turned`` holds the same bits from the other end.
    open_ = sum(1 << n for n in left)
    turned = sum(1 << capacity - n for n in left)
    plan = []
    while open_:
        free, back, gap, own = open_, turned, capacity, {}
        while fits := free & (2 << gap) - 1:
            n = fits.bit_length() - 1
            own[n] = min(gap // n, left[n])
            gap -= n * own[n]
            if own[n] == left[n]:
                free, back = free ^ 1 << n, back ^ 1 << capacity - n
        most = dict(own)
        if gap and sum(own.values()) > 1 and free:
            least = min(own)
            pair = _best_pair(free, back, gap + least, least, capacity, {n: left[n] - own.get(n, 0) for n in own}, left)
            if pair:
                own[least] -= 1
                for n in pair:
                    own[n] = own.get(n, 0) + 1
                most = {n: max(own.get(n, 0), most.get(n, 0)) for n in own}
        times = min(left[n] // c for n, c in most.items())
        plan.append(Filling(tuple((n, own[n]) for n in sorted(own, reverse=True) if own[n]), times))
        for n, c in own.items():
            left[n] -= c * times
            if not left[n] and open_ >> n & 1:
                open_, turned = open_ ^ 1 << n, turned ^ 1 << capacity - n
    return plan


def _best_pair(free: int, back: int, room: int, above: int, capacity: int, rest: Mapping[int, int],
               left: Mapping[int, int]) -> tuple[int, int] | None:
    """Two unpacked pieces that together are as long as possible, above ``above`` and within ``room``."""
    shortest = (free & -free).bit_length() - 1
    for total in range(room, max(above, 2 * shortest - 1), -1):
        # Bits x such that pieces of length x and of length total - x are unpacked.
        both = free & (back >> capacity - total if total <= capacity else back << total - capacity)
        if both:
            x = both.bit_length() - 1
            if 2 * x != total or rest.get(x, left[x]) > 1:
                return x, total - x
    return None


class Placing:
    """The plan as sorted arrays: pieces of one length take their places in the order of their numbers."""

    def __init__(self, plan: list[Filling]) -> None:
        ranges: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        first = 0
        for filling in plan:
            offset = 0
            for n, c in filling.lengths:
                ranges.setdefault(n, []).append((taken.get(n, 0), c, first, offset))
                taken[n] = taken.get(n, 0) + c * filling.times
                offset += n * c
            first += filling.times
        rows = [(n << _RANK_BITS | r[0], *r) for n in sorted(ranges) for r in ranges[n]]
        self.key, self.begin, self.each, self.first, self.offset = np.array(rows, np.int64).reshape(-1, 5).T.copy()

    def places(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces, by their length and their number in it."""
        row = np.searchsorted(self.key, lengths << _RANK_BITS | numbers, "right") - 1
        nth = numbers - self.begin[row]
        return self.first[row] + nth // self.each[row], self.offset[row] + nth % self.each[row] * lengths


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, closing: int = CLOSING, doc_id: str = "doc_id",
           text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids), ``part`` (a task) and ``nth``, counted in it by length."""
    docs = pick(documents, doc_id=doc_id, text=text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", *(["ids"] if with_ids else [])]
    end = np.array([closing], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = ByteEncoder.load(path, False), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = texts_of(batch)
            for a, b in slabs(texts):
                ids = [i + end for i in encoder.encode([t.decode() for t in texts[a:b]])]
                sizes = np.array([len(i) // 4 for i in ids], np.int64)
                many = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(ids)), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                first = sizes - (many - 1) * capacity
                start = np.where(piece > 0, first[doc] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, first[doc])
                data = [ids[d][4 * s:4 * (s + n)] for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                new = np.diff(length[order], prepend=0) != 0
                nth = np.empty(len(doc), np.int64)
                nth[order] = np.arange(len(doc)) - np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                columns = [batch.column("doc_id").slice(a, b - a).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                           pa.array(start), pa.array(length), pa.array([zlib.crc32(x) for x in data], pa.int64()),
                           pa.array(np.full(len(doc), part, np.int32)), pa.array(nth)]
                if with_ids:
                    flat = np.frombuffer(b"".join(data), "<u4").astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)).astype(np.int32)), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long"
                           + (", ids array<int>" if with_ids else ""))


def pack(documents: DataFrame, path: str, capacity: int = CAPACITY, closing: int = CLOSING, doc_id: str = "doc_id",
         text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of each piece, and its ids if asked for."""
    cut = kept(pieces(documents, path, capacity, closing, doc_id, text, with_ids), "token-pieces")
    counts = kept(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # One row per length, so at most ``capacity`` of them.
    plan = Placing(best_two_fit({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    starts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            sequence, offset = plan.places(length, number) if len(length) else (length, length)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    numbered = cut.join(starts, ["part", "length"]).select(*names, (F.col("earlier") + F.col("nth")).alias("number"))
    types = ", ".join(f"{n} {cut.schema[n].dataType.simpleString()}" for n in names)
    return numbered.mapInArrow(place, f"{types}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and doc_ids of each whole sequence, from pieces packed with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("_p")).select(
        "sequence_id", F.flatten("_p.ids").alias("ids"), F.col("_p.doc_id").alias("doc_ids"))
