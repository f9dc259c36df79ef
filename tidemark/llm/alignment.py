"""Alignment of two tokenizers over the same bytes, by interval coalescing.

The tokens of A (byte-level BPE) and B (sentencepiece) of a text are intervals of its bytes. All intervals are sorted by
their start; a group ends where a start reaches the largest end so far. Within a group each token of A is linked to the
tokens of B that it overlaps: a range, found by two searches. This is done for some megabytes of texts at a time, laid
end to end.

A pair of ids is counted by its links in all documents. A block of documents names each of its pairs once, with its count,
and its links by their number; blocks are written to the shared folder. The pairs of all blocks are summed, the highest
count of each id of B is found among its pairs (as many as A has ids at most), and the sums come back to the blocks that
asked for them, which are finished on their own. Nothing that grows with the table is broadcast; a common pair is a row a block.

Defined results: texts that are null or empty, or whose joined tokens of A or B are not the text behind one space, have no tokens:
zeros, and '' as digest. Special tokens written in a text are plain text. Repeated rows stay rows and count each; ids may be
null. An empty table gives an empty result. Extra columns play no part. Texts are aligned whole; one that is longer than a
block is a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_tokens import ByteEncoder
from tidemark.llm.common import kept, pick, texts_of
from tidemark.llm.packing import positions_of, steps_of
from tidemark.llm.rolling import slabs

BLOCK_BYTES = 3 << 20
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class PieceEncoder:
    """A sentencepiece model and the bytes of its pieces; one per worker process and file."""

    _loaded: dict[str, PieceEncoder] = {}

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                       for i, p in enumerate(map(self.model.id_to_piece, range(self.model.get_piece_size())))]
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)

    @classmethod
    def load(cls, path: str) -> PieceEncoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, given the ends of tokens that follow each other without gaps."""
    start = np.concatenate([[0], a_ends[:-1], [0], b_ends[:-1]])[:len(a_ends) + len(b_ends)] if len(a_ends) else np.zeros(0, np.int64)
    end = np.concatenate([a_ends, b_ends])
    order = np.lexsort((end, start))
    start, reach = start[order], np.maximum.accumulate(end[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = start[1:] >= reach[:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(fresh) - 1
    return number[:len(a_ends)], number[len(a_ends):]


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links: all pairs of a token of A and one of B (by number) that share a byte."""
    a_start, b_start = a_ends - np.diff(a_ends, prepend=0), b_ends - np.diff(b_ends, prepend=0)
    low = np.searchsorted(b_ends, a_start, "right")
    many = np.searchsorted(b_start, a_ends, "left") - low
    a = np.repeat(np.arange(len(a_ends)), many)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)


class Aligner:
    """Both tokenizers, and the decimal forms of their ids with what follows them in the text of groups."""

    _loaded: dict[tuple[str, str], Aligner] = {}

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteEncoder.load(path_a, True), PieceEncoder.load(path_b)
        self.written = [f"{i}{sign}" for i in range(len(self.a.tokens)) for sign in ",|"]
        self.written += [f"{i}{sign}" for i in range(len(self.b.tokens)) for sign in ",;"]

    @classmethod
    def load(cls, path_a: str, path_b: str) -> Aligner:
        if (path_a, path_b) not in cls._loaded:
            cls._loaded[path_a, path_b] = cls(path_a, path_b)
        return cls._loaded[path_a, path_b]

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of A and B of each text; none where there are none by definition."""
        full = [n for n, t in enumerate(texts) if t]
        spaced = [" " + texts[n] for n in full]
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(texts)
        for n, t, raw, b in zip(full, spaced, self.a.encode(spaced), self.b.encode([texts[n] for n in full]), strict=True):
            plain, a = t.encode(), np.frombuffer(raw, "<u4")
            if (b"".join(map(self.b.tokens.__getitem__, b)) == plain
                    and b"".join(map(self.a.tokens.__getitem__, a.tolist())) == plain):
                out[n] = a.astype(np.int64), np.array(b, np.int64)
        return out

    def block(self, texts: list[str]) -> tuple[list[tuple[int, int, int, int, str]], np.ndarray, np.ndarray, bytes]:
        """Of each text its counts and the digest of its groups; then the distinct pairs of ids (A << 32 | B) in order, their
        numbers of links, and the links, as sorted text * pairs + pair."""
        found = self.tokens(texts)
        have = [n for n, f in enumerate(found) if f is not None]
        rows: list[tuple[int, int, int, int, str]] = [(0, 0, 0, 0, "")] * len(texts)
        if not have:
            return rows, np.zeros(0, np.int64), np.zeros(0, np.int64), steps_of(np.zeros(0, np.int64))
        a, b = (np.concatenate([found[n][side] for n in have]) for side in (0, 1))
        # Both sides have the same bytes in each text, so the texts stay aligned end to end.
        a_ends, b_ends = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        first_a, first_b = (np.cumsum([0, *(len(found[n][side]) for n in have)]) for side in (0, 1))
        ga, gb = groups(a_ends, b_ends)
        left, right = overlaps(a_ends, b_ends)
        first_group = np.append(ga[first_a[:-1]], ga[-1] + 1)
        first_link = np.searchsorted(left, first_a)
        last_a, last_b = np.diff(ga, append=-1) != 0, np.diff(gb, append=-1) != 0
        line = np.empty(len(a) + len(b), np.int64)
        line[np.arange(len(a)) + np.searchsorted(gb, ga, "left")] = 2 * a + last_a
        line[np.arange(len(b)) + np.searchsorted(ga, gb, "right")] = 2 * (b + len(self.a.tokens)) + last_b
        for k, n in enumerate(have):
            written = "".join(map(self.written.__getitem__, line[first_a[k] + first_b[k]:first_a[k + 1] + first_b[k + 1]].tolist()))
            rows[n] = (int(first_a[k + 1] - first_a[k]), int(first_b[k + 1] - first_b[k]),
                       int(first_group[k + 1] - first_group[k]), int(first_link[k + 1] - first_link[k]),
                       hashlib.sha256(written[:-1].encode()).hexdigest())
        pairs, number, count = np.unique(a[left] << 32 | b[right], return_inverse=True, return_counts=True)
        of = np.repeat(np.array(have, np.int64), np.diff(first_link))
        return rows, pairs, count, steps_of(np.sort(of * len(pairs) + number))


def blocks(documents: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of documents: what is known of each, as arrays, the block's pairs with their counts, and its links."""
    docs = pick(documents, doc_id=doc_id, text=text)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner.load(path_a, path_b), TaskContext.get().partitionId() << 32

        def one(column: pa.Array) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)

        for batch in batches:
            texts = texts_of(batch)
            for x, y in slabs(texts, BLOCK_BYTES):
                rows, pairs, count, links = aligner.block([t.decode() for t in texts[x:y]])
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), one(batch.column("doc_id").slice(x, y - x)),
                    *(one(pa.array([r[i] for r in rows], pa.int64())) for i in range(4)),
                    one(pa.array([r[4] for r in rows], pa.string())),
                    *(one(pa.array(v, t)) for v, t in ((pairs >> 32, pa.int32()), (pairs & 0xFFFFFFFF, pa.int32()), (count, pa.int64()))),
                    pa.array([links], pa.binary())],
                    names=["block", "doc_id", *_COUNTS, "groups_sha256", "a", "b", "n", "links"])
                number += 1

    return docs.mapInArrow(work, f"block long, doc_id array<{kind}>, " + ", ".join(f"{c} array<long>" for c in _COUNTS)
                           + ", groups_sha256 array<string>, a array<int>, b array<int>, n array<long>, links binary")


def pair_counts(blocks_of_documents: DataFrame) -> DataFrame:
    """a, b, links of all documents, and whether no other id of A has more with this id of B."""
    each = blocks_of_documents.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.*")
    counts = each.groupBy("a", "b").agg(F.sum("n").alias("links"))
    # An id of B meets each id of A in one row, so a partition of this window is at most as large as A's vocabulary.
    return counts.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b")))


def align(documents: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document."""
    cut = kept(blocks(documents, path_a, path_b, doc_id, text), "token-blocks")
    asked = cut.select(F.col("block").alias("asker"), F.posexplode(F.arrays_zip("a", "b")).alias("at", "p")).select("asker", "at", "p.a", "p.b")
    told = asked.join(kept(pair_counts(cut), "pair-counts"), ["a", "b"]).select("asker", "at", "links", "best")
    kind = cut.schema["doc_id"].dataType.elementType.simpleString()

    def finish(own: pa.Table, answers: pa.Table) -> pa.Table:
        links, best = np.zeros(len(answers), np.int64), np.zeros(len(answers), np.int64)
        at = answers.column("at").to_numpy()
        links[at], best[at] = answers.column("links").to_numpy(), answers.column("best").to_numpy()
        row = own.slice(0, 1)
        flat = {c: row.column(c).combine_chunks().flatten() for c in ("doc_id", *_COUNTS, "groups_sha256")}
        key = positions_of(row.column("links")[0].as_py())
        pair = key % max(1, len(links))
        edge = np.searchsorted(key, np.arange(len(flat["n_a"]) + 1) * len(links)) if len(links) else np.zeros(len(flat["n_a"]) + 1, np.int64)
        sums = [np.diff(np.append(0, np.cumsum(v[pair]))[edge]) for v in (best, links)]
        return pa.table(flat | {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}).select(
            ["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    whole = cut.select("block", "doc_id", *_COUNTS, "groups_sha256", "links")
    return whole.groupBy("block").cogroup(told.groupBy("asker")).applyInArrow(
        finish, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", n_best long, count_sum long, groups_sha256 string")
