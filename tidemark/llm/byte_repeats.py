"""Removal of byte strings that start in an earlier document too, by column-wise suffix sorting.

Every byte under a string of ``width`` bytes that also starts in a document with a smaller id is removed. Documents are
judged as they came, and strings never reach from one into the next.

The suffixes of a whole corpus are no single task's work, and one round per byte of the longest document would never
end, so the collection is cut first, and losslessly. Windows that could be equal share an anchor (see ``sketch``), a
count-min sketch drops the windows whose anchor occurs once, and neighbouring windows with one anchor make one fragment
of at most ``2 * width - anchor`` bytes. All fragments of an anchor go to one bucket, but for anchors with
more than ``HOT_FRAGMENTS`` distinct ones, which are counted before: their fragments are cut into single windows, and the hash of a
window stands for the anchor, so that equal windows still meet and no bucket holds all of them. In a bucket the distinct
fragments are one collection, whose Burrows-Wheeler transform and common prefixes are built column by column (see
``bwt``): as many rounds as a fragment has bytes, whatever the length of documents. Runs of common prefixes of
``width`` bytes or more are equal strings, and each run has its smallest document.

A task groups its own fragments first: where one occurs in several of its documents, only that of the smallest
document is sent, for the others are decided at home. So a fragment that a third of all documents hold reaches its
bucket once per task. A fragment whose anchor, or the hash of whose windows, no other distinct fragment has can equal
only itself and needs no sorting.

Defined results: a null text counts as empty; texts shorter than ``width`` lose nothing. A document with a null id comes
before and after none: it loses nothing and takes nothing from others. Of rows with one id, none is smaller.
Repeated rows stay rows. Bytes are removed wherever they stand, so what is left may not be valid UTF-8; ``cleaned``
is binary. An empty table gives an empty result. Extra columns play no part. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bwt import collection_bwt, suffix_rows
from tidemark.llm.common import kept, pick, released, texts_of
from tidemark.llm.packing import by_group, counts_of, counts_to, distinct, group_of, key_of, keys_of, positions_of, split_by_key, steps_of
from tidemark.llm.rolling import slabs, sliding_argmin, windows
from tidemark.llm.sketch import SketchShape, StoredSketch, among, forget, hot_anchors, keys_present, maybe_present, squeezed, stored_sketch, text_bytes, unsqueezed

ANCHOR_BYTES = 24
WINDOWS_A_BUCKET = 3_000_000
HELD_BYTES = 48 << 20
HELD_FRAGMENTS = 1_000_000
HOT_FRAGMENTS = 1 << 16
SOLVED_PIECES = 50_000   # fragments that are sorted together; all of one anchor, however many
SLAB = 1 << 19
HELD_TEXT = 48 << 20     # bytes of text that wait for the ranges of a sketch
_LENGTH_BITS = 8   # a run of windows in a fragment is at most 255 long


class Fragments:
    """Windows of some texts by anchor: where each fragment starts, how many windows it has, whose it is."""

    def __init__(self, texts: list[bytes], width: int, anchor: int) -> None:
        self.data = b"".join(texts)
        raw = np.frombuffer(self.data, np.uint8)
        self.first = np.cumsum([0, *map(len, texts)])
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(self.first))
        n = len(raw) - width + 1
        starts = np.flatnonzero(owner[:n] == owner[width - 1:]) if n > 0 else np.zeros(0, np.int64)
        self.windows = len(starts)
        if not self.windows:
            self.start = self.size = self.owner = np.zeros(0, np.int64)
            self.anchors = np.zeros(0, np.uint64)
            return
        runs = windows(raw, anchor)
        at = sliding_argmin(runs, width - anchor + 1)[starts]
        new = np.flatnonzero(np.diff(at, prepend=-1))
        self.anchors = runs[at[new]]
        self.start, self.size = starts[new], np.diff(new, append=len(starts))
        self.owner = owner[self.start]


class _Home:
    """Distinct fragments of a task, each with its smallest document; what the others lose is decided here."""

    def __init__(self, width: int, buckets: int, groups: int) -> None:
        self.width, self.buckets, self.groups = width, buckets, groups
        self.clear()

    def clear(self) -> None:
        self.table: dict[bytes, list] = {}
        self.keys: list[bytes] = []
        self.seen: set[bytes] = set()
        self.ids: list[int] = []
        self.gone_doc: list[int] = []
        self.gone_run: list[int] = []
        self.held = 0

    def add(self, piece: bytes, anchor: int, doc: int, at: int) -> None:
        entry = self.table.get(piece)
        if entry is None:
            self.table[piece] = [anchor, doc, [(doc, at)]]
            self.held += len(piece) + 300
            return
        run = len(piece) - self.width + 1
        if self.ids[doc] > self.ids[entry[1]]:
            self.gone_doc.append(doc)
            self.gone_run.append(at << _LENGTH_BITS | run)
        elif self.ids[doc] < self.ids[entry[1]]:
            self.gone_doc += [d for d, _ in entry[2]]
            self.gone_run += [a << _LENGTH_BITS | run for _, a in entry[2]]
            entry[1:] = [doc, [(doc, at)]]
        else:  # the same document, or another row with its id: neither is smaller, all wait for the bucket
            entry[2].append((doc, at))
        self.held += 80

    def send(self) -> Iterator[pa.RecordBatch]:
        keys, ids = keys_of(b"".join(self.keys)), np.array(self.ids, np.int64)
        rows = [(g % self.buckets, own, b"", counts, steps, b"", b"", b"") for g, own, counts, steps in by_group(
            np.array(self.gone_doc, np.int64), np.array(self.gone_run, np.int64), keys, self.groups)]
        flat = [(p, e[0], d, a) for p, e in self.table.items() for d, a in e[2]]
        if flat:
            pieces = np.array([p for p, *_ in flat], object)
            anchor = np.array([f[1] for f in flat], np.uint64)
            doc, at = (np.array([f[i] for f in flat], np.int64) for i in (2, 3))
            bucket = (anchor % np.uint64(self.buckets)).astype(np.int64)
            order = np.lexsort((at, doc, bucket))
            bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
            for b in np.flatnonzero(np.diff(bounds)):
                own = order[bounds[b]:bounds[b + 1]]
                docs, place = np.unique(doc[own], return_inverse=True)
                # Ids ascend as the documents of most tables do; 16 bits of an anchor tell most anchors of a bucket apart.
                rows.append((int(b), keys[docs].tobytes(), steps_of(ids[docs]),
                             counts_to(np.bincount(place)), steps_of(at[own]),
                             (anchor[own] >> np.uint64(32)).astype("<u2").tobytes(),
                             squeezed(bytes(map(len, pieces[own]))), squeezed(b"".join(pieces[own]))))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 8))],
                names=["bucket", "keys", "ids", "counts", "at", "anchors", "sizes", "data"])
        self.clear()


def smallest_owners(pieces: list[bytes], owners: np.ndarray, width: int) -> np.ndarray:
    """For each window of each piece (row, offset), the smallest owner of an equal window in any piece."""
    sizes = np.array([len(p) for p in pieces])
    longest = int(sizes.max())
    strings = np.frombuffer(b"".join(p.rjust(longest, b"\0") for p in pieces), np.uint8).reshape(len(pieces), longest)
    bwt, lcp = collection_bwt(strings, sizes)
    run = np.cumsum(lcp < width)          # suffixes that share their first ``width`` bytes have one number
    least = np.full(int(run[-1]) + 1, np.iinfo(np.int64).max)
    found = [(n, who, run[row]) for n, who, row in suffix_rows(bwt, len(pieces), longest) if n >= width]
    for _, who, number in found:
        np.minimum.at(least, number, owners[who])
    out = np.full((len(pieces), longest - width + 1), np.iinfo(np.int64).max)
    for n, who, number in found:
        out[who, sizes[who] - n] = least[number]
    return out


def _share_a_window(pieces: list[bytes], width: int) -> np.ndarray:
    """False only for pieces none of whose windows has the hash of another: those need no sorting."""
    if not pieces:
        return np.zeros(0, bool)
    owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    hashes = windows(np.frombuffer(b"".join(pieces), np.uint8), width)
    inside = np.flatnonzero(owner[:len(hashes)] == owner[width - 1:])
    order = inside[np.argsort(hashes[inside], kind="stable")]
    equal = hashes[order[1:]] == hashes[order[:-1]]
    shared = np.zeros(len(pieces), bool)
    shared[owner[order[1:][equal]]] = True
    shared[owner[order[:-1][equal]]] = True
    return shared


def _solved(pieces: list[bytes], anchors: np.ndarray, doc: np.ndarray, at: np.ndarray, ids: np.ndarray, width: int
            ) -> tuple[np.ndarray, np.ndarray]:
    """Documents and runs of windows that an earlier document has too, for all occurrences in a bucket."""
    index: dict[bytes, int] = {}
    of = np.fromiter((index.setdefault(p, len(index)) for p in pieces), np.int64, len(pieces))
    distinct = list(index)
    owner = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(owner, of, ids[doc])
    anchor = np.zeros(len(distinct), np.int64)
    anchor[of] = anchors
    _, inverse, n = np.unique(anchor, return_inverse=True, return_counts=True)
    several = np.flatnonzero(n[inverse] > 1)
    several = several[_share_a_window([distinct[i] for i in several], width)]
    sizes = np.array([len(p) for p in distinct])
    least = np.repeat(owner[:, None], int(sizes.max()) - width + 1, axis=1)
    if len(several):
        part = smallest_owners([distinct[i] for i in several], owner[several], width)
        least[several, :part.shape[1]] = part
    gone = least[of] < ids[doc][:, None]
    gone &= np.arange(gone.shape[1])[None, :] <= (sizes[of] - width)[:, None]
    edge = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return doc[row], (at[row] + begin) << _LENGTH_BITS | (end - begin)


def parts_of(anchors: list[np.ndarray], size: int) -> Iterator[np.ndarray]:
    """Which of the 16-bit anchors are in each part: neighbours, about ``size`` occurrences together, one anchor at least."""
    n = sum(np.bincount(a, minlength=1 << 16) for a in anchors)
    number = (np.cumsum(n) - n) // size
    for part in np.unique(number[n > 0]):
        yield (number == part) & (n > 0)


def repeated_runs(docs: DataFrame, width: int, anchor: int, sketch: StoredSketch, buckets: int, groups: int,
                  n_windows: int) -> DataFrame:
    """grp, keys, counts, at: runs of window starts to remove, packed by group of documents."""
    def screened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        def found() -> Iterator[tuple]:
            for batch in batches:
                texts, ids = texts_of(batch), batch.column("doc_id").to_pylist()
                for a, b in slabs(texts, SLAB):
                    own = Fragments(texts[a:b], width, anchor)
                    yield len(own.data), own.anchors, (own, texts[a:b], ids[a:b])

        for hit, thing in sketch.screened(found(), HELD_TEXT):
            yield np.flatnonzero(hit), *thing

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Two fragments of an anchor are alike if their first and last windows are."""
        for chosen, found, _, _ in screened(batches):
            if len(chosen):
                hashes = windows(np.frombuffer(found.data, np.uint8), width)
                start = found.start[chosen]
                yield found.anchors[chosen], hashes[start] + np.uint64(3) * hashes[start + found.size[chosen] - 1]

    hot = hot_anchors(docs, kinds, HELD_FRAGMENTS, HOT_FRAGMENTS, n_windows // 8)

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = _Home(width, buckets, groups)
        for chosen, found, texts, ids in screened(batches):
            known: dict[int, int] = {}
            much = among(found.anchors[chosen], hot).tolist()
            for s, n, o, h, m in zip(found.start[chosen].tolist(), found.size[chosen].tolist(), found.owner[chosen].tolist(),
                                     found.anchors[chosen].tolist(), much, strict=True):
                if ids[o] is None:
                    continue
                if o not in known:
                    key = key_of(ids[o], texts[o])
                    # What a row loses is known by its id and text: rows that repeat here have all been said.
                    known[o] = -1 if key in home.seen else len(home.ids)
                    if known[o] >= 0:
                        home.seen.add(key)
                        home.ids.append(ids[o])
                        home.keys.append(key)
                if known[o] < 0:
                    continue
                at = s - int(found.first[o])
                if m:
                    for i in range(n):
                        window = found.data[s + i:s + i + width]
                        home.add(window, xxhash.xxh64_intdigest(window), known[o], at + i)
                else:
                    home.add(found.data[s:s + n + width - 1], h, known[o], at)
            if home.held >= HELD_BYTES:
                yield from home.send()
        yield from home.send()

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows) -> pa.RecordBatch:
            rows = list(rows)
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3))],
                names=["grp", "keys", "counts", "at"])

        forget()
        keys, ids, doc, at, anchors, texts = [], [], [], [], [], []
        n_keys = 0
        for batch in batches:
            for r in batch.to_pylist():
                own = keys_of(r["keys"])
                if not r["ids"]:  # decided at home; only passed on to its group
                    yield out([(int(group_of(own[:1], groups)[0]), r["keys"], r["counts"], r["at"])])
                    continue
                doc.append(np.repeat(np.arange(len(own), dtype=np.int32) + n_keys, counts_of(r["counts"])))
                n_keys += len(own)
                keys.append(own)
                ids.append(positions_of(r["ids"]))
                at.append(positions_of(r["at"]).astype(np.int32))  # of bytes in a text, which is below 2 GiB
                anchors.append(np.frombuffer(r["anchors"], "<u2"))
                texts.append((r["sizes"], r["data"]))
        if not texts:
            return
        keys, ids = np.concatenate(keys), np.concatenate(ids)
        # Fragments wait as they came, and are opened and sorted by parts of the anchors: what can be equal is in one part.
        results = []
        for part in parts_of(anchors, SOLVED_PIECES):
            chosen = [np.flatnonzero(part[a]) for a in anchors]
            pieces: list[bytes] = []
            for own, (sizes, data) in zip(chosen, texts, strict=True):
                if len(own):
                    ends = np.cumsum(np.frombuffer(unsqueezed(sizes), np.uint8), dtype=np.int64)
                    opened = unsqueezed(data)
                    begin = np.concatenate([[0], ends[:-1]])
                    pieces += [opened[x:y] for x, y in zip(begin[own].tolist(), ends[own].tolist(), strict=True)]
            results.append(_solved(pieces, *(
                np.concatenate([x[own] for own, x in zip(chosen, column, strict=True)]).astype(np.int64)
                for column in (anchors, doc, at)), ids, width))
        yield out(by_group(*map(np.concatenate, zip(*results, strict=True)), keys, groups))

    sent = docs.mapInArrow(released(fragments), "bucket int, keys binary, ids binary, counts binary, at binary, anchors binary, "
                                      "sizes binary, data binary")
    return sent.repartition(buckets, "bucket").mapInArrow(released(solve), "grp int, keys binary, counts binary, at binary")


def remove_repeats(documents: DataFrame, width: int = 50, anchor: int = ANCHOR_BYTES, shape: SketchShape = SketchShape(),
                   doc_id: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the remaining bytes as ``cleaned`` if asked for."""
    if not 0 < anchor <= width <= 120:
        raise ValueError("anchors are at most as long as windows, and windows at most 120 bytes")
    docs = pick(documents, doc_id=doc_id, text=text).withColumn("text", F.col("text").cast("binary"))

    def sketched(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
        texts = texts_of(batch)
        for a, b in slabs(texts, SLAB):
            found = Fragments(texts[a:b], width, anchor)
            yield found.anchors, found.windows

    # Of random hashes, two in width - anchor + 2 are the least of their window.
    sketch, n_windows = stored_sketch(docs, sketched, shape, text_bytes(docs) * 2 / (width - anchor + 2))
    parts = max(8, n_windows // WINDOWS_A_BUCKET)  # sized by the windows that were counted
    repeats = kept(repeated_runs(docs, width, anchor, sketch, parts, parts, n_windows), "repeated-bytes")
    present = documents.sparkSession.sparkContext.broadcast(keys_present(repeats))
    kind = docs.schema["doc_id"].dataType.simpleString()
    results = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + (["cleaned"] if with_text else [])
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())[:len(results) - 1]
    schema = (f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
              + (", cleaned binary" if with_text else ""))

    def told(data: bytes, runs: np.ndarray) -> tuple[int, int, int, str, bytes]:
        if not len(runs):
            return len(data), 0, 0, hashlib.sha256(data).hexdigest(), data if with_text else b""
        edge = np.zeros(len(data) + 1, np.int64)
        begin = runs >> _LENGTH_BITS
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + (runs & ((1 << _LENGTH_BITS) - 1)) + width - 1, -1)
        gone = np.cumsum(edge)[:-1] > 0
        left = np.frombuffer(data, np.uint8)[~gone].tobytes()
        return (len(data), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()),
                hashlib.sha256(left).hexdigest(), left if with_text else b"")

    none = np.zeros(0, np.int64)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All documents; those that lose nothing are finished here and travel without their text."""
        forget()
        for batch in batches:
            texts, ids = texts_of(batch), batch.column("doc_id")
            for a, b in slabs(texts, SLAB):
                keys = [key_of(i.as_py(), t) for i, t in zip(ids.slice(a, b - a), texts[a:b], strict=True)]
                open_docs = maybe_present(keys, present.value).tolist()
                # Equal rows that lose something go on as one, so that no group gets all copies of a row.
                stay, copies = distinct(keys, open_docs)
                keys, part = [keys[i] for i in stay], [texts[a + i] for i in stay]
                open_docs = [open_docs[i] for i in stay]
                done = [(None,) * 5 if o else told(t, none) for o, t in zip(open_docs, part, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(group_of(keys_of(b"".join(keys)), parts), pa.int32()), pa.array(keys, pa.binary()),
                    pa.array([squeezed(t) if o else None for o, t in zip(open_docs, part, strict=True)], pa.binary()),
                    pa.array(copies, pa.int32()), ids.slice(a, b - a).take(pa.array(stay)),
                    *(pa.array([d[i] for d in done], k) for i, k in enumerate(kinds))],
                    names=["grp", "key", "text", "copies", *results])

    def finished(own: pa.Table, repeated: pa.Table) -> pa.Table:
        runs: dict[bytes, list[np.ndarray]] = {}
        for r in repeated.to_pylist():
            for key, at in split_by_key(r["keys"], r["counts"], r["at"]):
                runs.setdefault(key, []).append(at)
        columns = {n: own.column(n).to_pylist() for n in results[1:]}
        for i, (key, t) in enumerate(zip(own.column("key").to_pylist(), own.column("text").to_pylist(), strict=True)):
            if t is not None:
                at = runs.get(key)
                for n, v in zip(results[1:], told(unsqueezed(t), np.concatenate(at) if at else none), strict=False):
                    columns[n][i] = v
        return pa.table({"copies": own.column("copies"), "doc_id": own.column("doc_id")} | {
            n: pa.array(columns[n], k) for n, k in zip(results[1:], kinds, strict=True)})

    rows = docs.mapInArrow(released(marked), f"grp int, key binary, text binary, copies int, {schema}")
    told_once = rows.groupBy("grp").cogroup(repeats.groupBy("grp")).applyInArrow(finished, f"copies int, {schema}")
    return told_once.select(*results, F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_copy")).drop("_copy")
