"""Removal of repeated word windows, with a count-min prefilter.

A window is ``width`` consecutive words of one document. Every word under a window whose words also start anywhere else,
in the same document too, is removed. Windows are judged on the input.

First pass: a sketch of the anchors of all windows (see ``sketch``). Second pass: windows whose anchor may be repeated
are grouped, by 128 bits of their words: both halves of each word's hash, joined by a tree that does not let values cancel out. The windows of an anchor share a bucket, but for anchors with more than
``HOT_WINDOWS`` of them, which are counted before: their windows are dealt by their own hash. A task groups its own windows first and sends one of each kind, so a
window that a third of all documents hold reaches its group once per task. Third pass: results meet the documents.
A second sketch, of the documents that lose something, lets only those carry their text through the shuffle.

Defined results: a null text counts as empty; texts with fewer words than a window lose nothing. Copies of a text lose
all windows, each row for itself. Null ids are allowed. Repeated rows stay rows. An empty table gives an empty
result. Extra columns play no part. Texts are read whole; groups and partitions are sized by what was counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept, pick, texts_of
from tidemark.llm.packing import by_group, counts_of, counts_to, distinct, group_of, key_of, keys_of, positions_of, split_by_key, steps_of
from tidemark.llm.rolling import joined_windows, slabs, sliding_argmin
from tidemark.llm.sketch import SketchShape, StoredSketch, among, hot_anchors, keys_present, maybe_present, squeezed, stored_sketch, text_bytes, unsqueezed

ANCHOR_WORDS = 10
WINDOWS_A_TASK = 1_000_000
HELD_WINDOWS = 3_000_000
HOT_WINDOWS = 1 << 18
HELD_TEXT = 16 << 20     # bytes of text that wait for the ranges of a sketch
WORD_BYTES = 4           # a word and its space have more on average; only a guess for the number of ranges
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True


class Words:
    """The words of some texts: where they stand, whose they are, and their hashes."""

    def __init__(self, texts: list[bytes]) -> None:
        self.data = b"".join(t + b" " for t in texts)
        self.raw = np.frombuffer(self.data, np.uint8)
        word = ~_SPACE[self.raw]
        edge = np.flatnonzero(np.diff(word, prepend=False))
        self.starts, self.ends = edge[0::2], edge[1::2]
        limits = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.first = np.searchsorted(self.starts, limits)  # first word of each text
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.digests: np.ndarray | None = None

    def hashes(self, which: int) -> np.ndarray:
        """One half, 0 or 1, of the 128-bit hashes of the words."""
        if self.digests is None:
            digest = xxhash.xxh3_128_digest
            self.digests = np.frombuffer(b"".join([digest(w) for w in self.data.split()]), "<u8").reshape(-1, 2)
        return self.digests[:, which].copy()

    def inside(self, width: int) -> np.ndarray:
        """Starts of windows that lie in one text."""
        n = len(self.starts) - width + 1
        return np.flatnonzero(self.owner[:n] == self.owner[width - 1:]) if n > 0 else np.zeros(0, np.int64)


def anchored(words: Words, width: int, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, the number of the anchor of each, and the hashes of the anchors."""
    starts = words.inside(width)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    runs = joined_windows(hashes, size)
    at = sliding_argmin(runs, width - size + 1)[starts]
    new = np.diff(at, prepend=-1) != 0  # anchors move forward, so equal ones are neighbours
    return starts, np.cumsum(new) - 1, runs[at[new]]


class _Candidates:
    """Windows that a task holds, to be grouped at home before one of each kind is sent."""

    def __init__(self, buckets: int, groups: int, hot: np.ndarray) -> None:
        self.buckets, self.groups, self.hot = buckets, groups, hot
        self.clear()

    def clear(self) -> None:
        self.high, self.low, self.bucket, self.doc, self.at = [], [], [], [], []
        self.keys: list[bytes] = []
        self.size = 0

    def add(self, high: np.ndarray, low: np.ndarray, anchor: np.ndarray, doc: np.ndarray, at: np.ndarray,
            keys: list[bytes]) -> None:
        self.high.append(high)
        self.low.append(low)
        anchor = np.where(among(anchor, self.hot), high, anchor)
        self.bucket.append((anchor % np.uint64(self.buckets)).astype(np.int32))
        self.doc.append(doc + len(self.keys))
        self.at.append(at)
        self.keys += keys
        self.size += len(high)

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        high, low, bucket, doc, at = (np.concatenate(x) for x in (self.high, self.low, self.bucket, self.doc, self.at))
        order = np.lexsort((low, high))
        h, g = high[order], low[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        first = np.flatnonzero(new)
        n = np.diff(first, append=len(h))
        again = np.repeat(n > 1, n)
        rows: list[tuple[int, bytes, bytes, bytes, bytes, bytes, bytes]] = []
        keys = keys_of(b"".join(self.keys))
        # What repeats at home is decided here; it travels as finished positions of documents.
        rows += [(g % self.buckets, own, counts, steps, b"", b"", b"") for g, own, counts, steps in by_group(
            doc[order][again], at[order][again], keys, self.groups)]
        # The bucket comes from the anchor, which equal windows share, so a run of windows stays together and its
        # document is named once; windows of a hot anchor go by their own hash.
        high, low, many = h[first], g[first], n > 1
        bucket, doc, at = bucket[order][first], doc[order][first], at[order][first]
        order = np.lexsort((at, doc, bucket))
        bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for b in np.flatnonzero(np.diff(bounds)):
            own = order[bounds[b]:bounds[b + 1]]
            docs, place = np.unique(doc[own], return_inverse=True)
            rows.append((int(b), keys[docs].tobytes(), counts_to(np.bincount(place)), steps_of(at[own]),
                         high[own].tobytes(), low[own].tobytes(), np.packbits(many[own]).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 7))],
            names=["bucket", "keys", "counts", "at", "high", "low", "many"])
        self.clear()


def repeated_windows(docs: DataFrame, width: int, anchor: int, sketch: StoredSketch, buckets: int, groups: int,
                     n_windows: int) -> DataFrame:
    """grp, keys, counts, at: window starts that are repeated, packed by group of documents."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            texts, ids = texts_of(batch), batch.column("doc_id").to_pylist()
            for a, b in slabs(texts):
                words = Words(texts[a:b])
                starts, number, anchors = anchored(words, width, anchor, words.hashes(0))
                if len(starts):
                    yield len(words.data), anchors, (words, starts, number, anchors, texts[a:b], ids[a:b])

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for hit, (words, starts, number, anchors, _, _) in sketch.screened(found(batches), HELD_TEXT):
            chosen = hit[number]
            yield anchors[number[chosen]], joined_windows(words.hashes(0), width)[starts[chosen]]

    hot = hot_anchors(docs, kinds, HELD_WINDOWS, HOT_WINDOWS, n_windows)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Candidates(buckets, groups, hot)
        for hit, (words, starts, number, anchors, texts, ids) in sketch.screened(found(batches), HELD_TEXT):
            chosen = hit[number]
            starts, number = starts[chosen], number[chosen]
            if not len(starts):
                continue
            owner = words.owner[starts]
            docs_here, place = np.unique(owner, return_inverse=True)
            high, low = (joined_windows(words.hashes(i), width)[starts] for i in (0, 1))
            held.add(high, low, anchors[number], place, starts - words.first[owner], [key_of(ids[d], texts[d]) for d in docs_here])
            if held.size >= HELD_WINDOWS:
                yield from held.send()
        yield from held.send()

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["grp", "keys", "counts", "at"], [pa.int32(), pa.binary(), pa.binary(), pa.binary()]

        def out(rows) -> pa.RecordBatch:
            rows = list(rows)
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        keys, doc, at, high, low, many = [], [], [], [], [], []
        n_keys = 0
        for batch in batches:
            for r in batch.to_pylist():
                own = keys_of(r["keys"])
                if not r["high"]:  # decided before; only passed on to its group
                    yield out([(int(group_of(own[:1], groups)[0]), r["keys"], r["counts"], r["at"])])
                    continue
                doc.append(np.repeat(np.arange(len(own)) + n_keys, counts_of(r["counts"])))
                n_keys += len(own)
                keys.append(own)
                at.append(positions_of(r["at"]))
                high.append(np.frombuffer(r["high"], np.uint64))
                low.append(np.frombuffer(r["low"], np.uint64))
                many.append(np.unpackbits(np.frombuffer(r["many"], np.uint8), count=len(at[-1])).astype(bool))
        if not keys:
            return
        doc, at, high, low, many = (np.concatenate(x) for x in (doc, at, high, low, many))
        order = np.lexsort((low, high))
        h, g = high[order], low[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        first = np.flatnonzero(new)
        again = order[np.repeat(np.diff(first, append=len(h)) > 1, np.diff(first, append=len(h)))]
        again = again[~many[again]]  # those repeated at home were decided there
        yield out(by_group(doc[again], at[again], np.concatenate(keys), groups))

    sent = docs.mapInArrow(candidates, "bucket int, keys binary, counts binary, at binary, high binary, low binary, many binary")
    return sent.repartition(max(1, buckets // 4), "bucket").mapInArrow(
        grouped, "grp int, keys binary, counts binary, at binary")


def remove_repeated(documents: DataFrame, width: int = 35, anchor: int = ANCHOR_WORDS,
                    shape: SketchShape = SketchShape(), doc_id: str = "doc_id", text: str = "text",
                    with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and the kept words as ``cleaned`` if asked for."""
    docs = pick(documents, doc_id=doc_id, text=text)
    spark = documents.sparkSession

    def sketched(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
        texts = texts_of(batch)
        for a, b in slabs(texts):
            words = Words(texts[a:b])
            starts, _, anchors = anchored(words, width, anchor, words.hashes(0))
            yield anchors, len(starts)

    # Of random hashes, two in width - anchor + 2 are the least of their window.
    sketch, n_windows = stored_sketch(docs, sketched, shape, text_bytes(docs) / WORD_BYTES * 2 / (width - anchor + 2))
    parts = max(8, n_windows // WINDOWS_A_TASK)  # sized by the windows that were counted
    repeats = kept(repeated_windows(docs, width, anchor, sketch, parts * 4, parts, n_windows), "repeated-windows")
    present = spark.sparkContext.broadcast(keys_present(repeats))
    kind = docs.schema["doc_id"].dataType.simpleString()
    results = ["doc_id", "n_words", "n_removed", "kept_sha256"] + (["cleaned"] if with_text else [])
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + (", cleaned string" if with_text else "")

    def told(words: list[bytes], starts: np.ndarray) -> tuple[int, int, str, str]:
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, starts, 1)
        np.add.at(gone, starts + width, -1)
        keep = np.cumsum(gone)[:-1] == 0
        line = b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])
        return len(words), int((~keep).sum()), hashlib.sha256(line).hexdigest(), line.decode() if with_text else ""

    none = np.zeros(0, np.int64)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All documents; those that lose nothing are finished here and travel without their text."""
        names = ["grp", "key", "text", "copies", *results]
        for batch in batches:
            texts, ids = texts_of(batch), batch.column("doc_id")
            for a, b in slabs(texts):
                keys = [key_of(i.as_py(), t) for i, t in zip(ids.slice(a, b - a), texts[a:b], strict=True)]
                open_docs = maybe_present(keys, present.value).tolist()
                # Equal rows that lose something go on as one, so that no group gets all copies of a row.
                stay, copies = distinct(keys, open_docs)
                keys, part = [keys[i] for i in stay], [texts[a + i] for i in stay]
                open_docs = [open_docs[i] for i in stay]
                done = [(None,) * 4 if o else told(t.split(), none) for o, t in zip(open_docs, part, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(group_of(keys_of(b"".join(keys)), parts), pa.int32()), pa.array(keys, pa.binary()),
                    pa.array([squeezed(t) if o else None for o, t in zip(open_docs, part, strict=True)], pa.binary()),
                    pa.array(copies, pa.int32()), ids.slice(a, b - a).take(pa.array(stay)),
                    *(pa.array([d[i] for d in done], k) for i, k in enumerate(
                        (pa.int64(), pa.int64(), pa.string(), pa.string())[:len(results) - 1]))], names=names)

    def finished(own: pa.Table, repeated: pa.Table) -> pa.Table:
        starts: dict[bytes, list[np.ndarray]] = {}
        for r in repeated.to_pylist():
            for key, at in split_by_key(r["keys"], r["counts"], r["at"]):
                starts.setdefault(key, []).append(at)
        columns = {n: own.column(n).to_pylist() for n in results[1:]}
        for i, (key, t) in enumerate(zip(own.column("key").to_pylist(), own.column("text").to_pylist(), strict=True)):
            if t is not None:
                at = starts.get(key)
                for n, v in zip(results[1:], told(unsqueezed(t).split(), np.unique(np.concatenate(at)) if at else none), strict=False):
                    columns[n][i] = v
        return pa.table({"copies": own.column("copies"), "doc_id": own.column("doc_id")} | {
            n: pa.array(columns[n], own.schema.field(n).type) for n in results[1:]})

    rows = docs.mapInArrow(marked, f"grp int, key binary, text binary, copies int, {schema}")
    told_once = rows.groupBy("grp").cogroup(repeats.groupBy("grp")).applyInArrow(finished, f"copies int, {schema}")
    return told_once.select(*results, F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_copy")).drop("_copy")
