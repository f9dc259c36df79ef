"""A quality classifier by nearest-neighbour voting in a latent semantic space.

Terms of a text are hashed byte trigrams, the shapes of its words (classes of characters, runs collapsed), and marks of
structure (repeated words, word triples and lines; lengths). Document frequencies come from all documents. A bounded
sample of labelled texts is weighted by them and reduced to latent vectors; those vectors, their labels and the
projection are broadcast, and their size is fixed by the parameters. Every document is projected the same way, its
cosine with every labelled vector is computed exactly, in blocks, and the nearest vote with their similarity as
weight.

Labels, language, source and id are no input of a score.

Defined results: a null text counts as empty; an empty text has structure marks only and is scored like any other.
Labels that are null or not 0 or 1 are not learnt from; of several labels of a document the lowest counts. Where there
is no usable label, every score is 0.5. Equal texts have equal scores. Repeated rows stay rows. An empty table gives an empty
result. Extra columns play no part. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, released, texts_of
from tidemark.llm.rolling import TABLE64, mixed, slabs

MARKS = 64           # term numbers for marks of structure; the rest is shared by trigrams and shapes
LEARNT = "crc32(cast(doc_id as string)) % 3 <> 1"


@dataclass(frozen=True)
class VoteSettings:
    """Bounds and weights. The broadcast holds sample * dimensions + terms * dimensions floats."""

    terms: int = 1024
    dimensions: int = 96
    sample: int = 6000       # labelled texts that are learnt from, chosen by a hash of their id
    neighbours: int = 15
    sharpness: float = 8.0   # a vote weighs similarity to this power
    block: int = 512


def _classes() -> np.ndarray:
    """Character class of each byte: white space 0, lower 1, upper 2, digit 3, above ASCII 4, signs by themselves."""
    kinds = np.arange(256) + 8
    kinds[list(b" \t\n\r\x0b\x0c")] = 0
    kinds[ord("a"):ord("z") + 1], kinds[ord("A"):ord("Z") + 1] = 1, 2
    kinds[ord("0"):ord("9") + 1], kinds[128:] = 3, 4
    return kinds


_CLASS = _classes()


def _bin(share: np.ndarray) -> np.ndarray:
    """Eight bins of a share, the first for zero."""
    return np.where(share <= 0, 0, 1 + np.minimum(6, (share * 7).astype(np.int64)))


def _shares_again(doc: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Share of the entries of each document whose key occurred before in it."""
    total = np.bincount(doc, minlength=n)
    if not len(doc):
        return np.zeros(n)
    pair = mixed(key ^ mixed(doc.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(pair, return_index=True)
    return np.where(total > 0, 1 - np.bincount(doc[first], minlength=n) / np.maximum(total, 1), 0.0)


def count_terms(texts: list[bytes], terms: int) -> np.ndarray:
    """One row of term counts per text."""
    n = len(texts)
    # A leading and a closing line feed keep trigrams, words and lines of neighbours apart.
    data = np.frombuffer(b"".join(b"\n" + t + b"\n" for t in texts), np.uint8)
    sizes = np.array([len(t) + 2 for t in texts])
    doc = np.repeat(np.arange(n), sizes)
    room = np.uint64(terms - MARKS)
    b = data.astype(np.uint64)
    grams = mixed(b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]) % room
    same = doc[:-2] == doc[2:]
    out = np.bincount(doc[:-2][same] * terms + grams[same].astype(np.int64), minlength=n * terms)

    kind = _CLASS[data]
    word = kind > 0
    starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    owner = doc[starts]
    n_words = np.bincount(owner, minlength=n)
    marks = np.zeros((n, MARKS), np.int64)
    rows = np.arange(n)
    # Shapes: runs of a class count once; place in the word tells "Ab" from "bA".
    run = np.flatnonzero(word[1:] & (kind[1:] != kind[:-1])) + 1
    of = np.searchsorted(starts, run, "right") - 1
    place = np.minimum(np.arange(len(run)) - np.searchsorted(of, of), 5)
    shape = np.zeros(len(starts), np.uint64)
    np.add.at(shape, of, mixed(kind[run].astype(np.uint64) * np.uint64(8) + place.astype(np.uint64)))
    np.add.at(out, owner * terms + (mixed(shape) % room).astype(np.int64), 3)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(TABLE64[data] * (np.arange(len(data), dtype=np.uint64)
                                                                                * np.uint64(2) + np.uint64(1)))])
    plain = np.concatenate([np.zeros(1, np.uint64), np.cumsum(TABLE64[data])])
    key = sums[ends] - sums[starts] - (plain[ends] - plain[starts]) * (starts.astype(np.uint64) * np.uint64(2))
    key = mixed(key)
    next_same = (key[1:] == key[:-1]) & (owner[1:] == owner[:-1])
    repeat = np.bincount(owner[1:][next_same], minlength=n) / np.maximum(n_words, 1)
    marks[rows, _bin(repeat)] = 1
    inside = owner[2:] == owner[:-2]
    triple = mixed(key[:-2] * np.uint64(3) + mixed(key[1:-1]) * np.uint64(5) + mixed(mixed(key[2:])))
    marks[rows, 8 + _bin(_shares_again(owner[:-2][inside], triple[inside], n))] = 1
    signs = np.bincount(doc[kind > 4], minlength=n) / np.maximum(n_words, 1)
    marks[rows, 16 + _bin(signs / 3)] = 1
    upper = np.bincount(doc[kind == 2], minlength=n) / np.maximum(n_words, 1)
    marks[rows, 24 + _bin(upper / 6)] = 1
    length = np.bincount(owner, ends - starts, minlength=n) / np.maximum(n_words, 1)
    marks[rows, 32 + np.minimum(7, (length / 2).astype(np.int64))] = 1
    lone = np.bincount(owner, ends - starts == 1, minlength=n) / np.maximum(n_words, 1)
    marks[rows, 40 + _bin(lone)] = 1
    line = np.flatnonzero(data == 10)
    digest = sums[line[1:]] - sums[line[:-1]] - (plain[line[1:]] - plain[line[:-1]]) * (line[:-1].astype(np.uint64)
                                                                                      * np.uint64(2))
    full = (line[1:] - line[:-1] > 1) & (doc[line[1:]] == doc[line[:-1]])
    marks[rows, 48 + _bin(_shares_again(doc[line[1:]][full], mixed(digest)[full], n))] = 1
    marks[rows, 56 + np.minimum(7, np.log2(n_words + 1).astype(np.int64) // 2)] = 1
    out = out.reshape(n, terms)
    out[:, terms - MARKS:] = marks * np.maximum(1, out.sum(axis=1) // 40)[:, None]
    return out


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Relative counts, square-rooted and weighted, at length one."""
    x = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True))).astype(np.float32) * idf
    return x / np.maximum(1e-9, np.linalg.norm(x, axis=1, keepdims=True))


def document_frequencies(docs: DataFrame, terms: int) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and documents in all: sums per task, merged by term."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(terms + 1, np.int64), 0
        for batch in batches:
            texts = texts_of(batch)
            for a, b in slabs(texts):
                seen[:terms] += (count_terms(texts[a:b], terms) > 0).sum(axis=0)
            n += len(texts)
        seen[terms] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(terms + 1)), pa.array(seen)], names=["term", "n"])

    merged = docs.select("text").mapInArrow(work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = np.zeros(terms + 1, np.int64)
    for r in merged.collect():  # one number per term
        found[r["term"]] = r["n"]
    return found[:terms], int(found[terms])


def labelled_sample(docs: DataFrame, labels: DataFrame, settings: VoteSettings, learn: Column) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of the sample. Ids are chosen first, from the labels alone."""
    usable = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & learn)
    chosen = (usable.groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample))
    terms = settings.terms

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for a, b in slabs(texts):
                counts = count_terms(texts[a:b], terms).astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    batch.column("label").slice(a, b - a), batch.column("doc_id").slice(a, b - a),
                    pa.array([row.tobytes() for row in counts], pa.binary())], names=["label", "doc_id", "counts"])

    # The chosen rows are at most ``sample``, so they are broadcast; one text each comes back as counts.
    found = docs.join(F.broadcast(chosen), "doc_id").select("label", F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "label int, doc_id long, counts binary")
    rows = found.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample).collect()
    counts = np.array([np.frombuffer(r["counts"], "<u4") for r in rows]) if rows else np.zeros((0, terms), np.uint32)
    return counts, np.array([r["label"] for r in rows], np.float32)


def fit(docs: DataFrame, labels: DataFrame, settings: VoteSettings, learn: Column) -> dict:
    """The model: idf, projection, labelled vectors, labels."""
    seen, n = document_frequencies(docs, settings.terms)
    idf = (np.log((n + 1) / (seen + 1)) + 0.3).astype(np.float32)
    counts, label = labelled_sample(docs, labels, settings, learn)
    x = _weighted(counts, idf)
    # Right singular vectors of the sample, from the matrix of terms, whose size the settings fix.
    _, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    projection = np.ascontiguousarray(vectors[:, ::-1][:, :settings.dimensions]).astype(np.float32)
    latent = x @ projection
    latent /= np.maximum(1e-9, np.linalg.norm(latent, axis=1, keepdims=True))
    return {"idf": idf, "projection": projection, "latent": latent, "label": label}


def votes(texts: list[bytes], model: dict, settings: VoteSettings) -> np.ndarray:
    """Scores of texts: exact cosines with all labelled vectors, block by block."""
    out = np.full(len(texts), 0.5)
    k = min(settings.neighbours, len(model["label"]))
    if not k:
        return out
    for a, b in slabs(texts):
        z = _weighted(count_terms(texts[a:b], settings.terms), model["idf"]) @ model["projection"]
        z /= np.maximum(1e-9, np.linalg.norm(z, axis=1, keepdims=True))
        for i in range(0, len(z), settings.block):
            cosine = z[i:i + settings.block] @ model["latent"].T
            near = np.argpartition(cosine, cosine.shape[1] - k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-3).astype(np.float64) ** settings.sharpness
            share = (weight * model["label"][near]).sum(axis=1) / weight.sum(axis=1)
            out[a + i:a + i + len(share)] = np.clip(share, 0.0, 1.0)
    return out


def classify(documents: DataFrame, labels: DataFrame, settings: VoteSettings = VoteSettings(), learn: str = LEARNT,
             doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """All columns of the documents, named by position ``_in0`` and on, with ``score`` last."""
    docs = pick(documents, doc_id=doc_id, text=text)
    marks = pick(labels, doc_id=doc_id, label=label)
    model = documents.sparkSession.sparkContext.broadcast(fit(docs, marks, settings, F.expr(learn)))
    place = list(documents.columns).index(text)
    inner = documents.toDF(*[f"_in{i}" for i in range(len(documents.columns))])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = votes(texts_of(batch, f"_in{place}"), model.value, settings)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])

    return inner.mapInArrow(released(work), f"{schema}, score double")


def scores(documents: DataFrame, labels: DataFrame, settings: VoteSettings = VoteSettings(), doc_id: str = "doc_id",
           text: str = "text", label: str = "quality") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = pick(documents, doc_id=doc_id, text=text)
    scored = classify(docs, labels, settings, label=label).toDF("doc_id", "text", "score")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def passing(documents: DataFrame, labels: DataFrame, settings: VoteSettings = VoteSettings()) -> DataFrame:
    """The documents that are not rejected, all columns unchanged."""
    names = list(documents.columns)
    return classify(documents, labels, settings).filter("score >= 0.5").drop("score").toDF(*names)
