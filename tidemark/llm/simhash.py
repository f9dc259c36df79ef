"""SimHash fingerprints, and their links by covering locality-sensitive hashing.

Covering masks: bit i carries a vector m(i) of radius + 1 bits, not all zero. For every v but zero, one table
keeps the bits with odd <m(i), v>. The at most ``radius`` vectors of the bits in which two fingerprints differ
span less than the whole space, so some v is orthogonal to all of them, and in that table both fall together.
No pair within the radius is missed, whatever the data.

Buckets stay bounded. Members of a bucket agree on the bits of its mask, so they differ in free bits only. A
bucket with more than ``bucket_limit`` members is covered again by the same construction on its free bits; with
64 bits and radius 2, three levels leave at most 5 free bits, that is 32 members. A bucket is then solved in a task,
which returns each member with the smallest member that it reaches inside: as many rows as members, never all
pairs. Links between components of a bucket cannot exist inside it, so connectivity is kept whole.

Defined results: a null, empty or blank text has fingerprint zero, which links like any other. A text with fewer
words than a shingle is one shingle. Equal texts and equal fingerprints are one node. Rows with a null doc_id get
a fingerprint, and the smallest doc_id that they reach (null if there is none). Repeated rows stay rows. An empty
table gives an empty result. Extra columns play no part. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import carry, kept, pick, texts_of
from tidemark.llm.components import components

BITS = 64


def _fingerprint(text: bytes, width: int, seed: int) -> int:
    """The majority bits of the hashes of all shingles. Words are split at the six white-space bytes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-width].tolist()]
    stops = (ends[width - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, stops, strict=True)), np.uint64, len(stops))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at:at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    on = np.flatnonzero(counts * 2 > len(hashes))
    return int(sum(1 << int(i) for i in on))


def fingerprints(documents: DataFrame, width: int = 3, seed: int = 42, text: str = "text",
                 **keep: str) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed long."""
    docs = pick(documents, **keep, **{"_text": text})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([_fingerprint(t, width, seed) for t in texts_of(batch, "_text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), pa.array(fps)], names=[*keep, "fp"])

    types = ", ".join(f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in keep)
    return docs.mapInArrow(work, f"{types}, fp long")


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """2^(radius+1) - 1 masks over the given bit positions."""
    vectors = (1 << (radius + 1)) - 1
    return [sum(1 << bit for i, bit in enumerate(bits) if ((i % vectors + 1) & v).bit_count() % 2)
            for v in range(1, vectors + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _solve(radius: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for members in batch.column("members").to_pylist():
                fps = np.unique(np.array(members, np.int64))
                u = fps.view(np.uint64)
                x = u[:, None] ^ u[None, :]
                near = np.bitwise_count(x) <= radius
                label = np.arange(len(u))
                while True:  # the smallest label reached inside the bucket
                    new = np.where(near, label[None, :], len(u)).min(axis=1)
                    new = new[new]
                    if (new == label).all():
                        break
                    label = new
                linked = np.flatnonzero(label != np.arange(len(u)))
                a.append(fps[linked])
                b.append(fps[label[linked]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (a, b)], names=["a", "b"])

    return work


def links(distinct: DataFrame, radius: int = 2, bucket_limit: int = 256) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect whatever lies within the radius.

    Buckets above the limit go to the next level of masks until the free bits alone bound them.
    """
    masks = [(0, 0)]
    current = distinct.select("fp", F.lit(0).alias("mask"), F.lit(0).cast("long").alias("bits"))
    found: DataFrame | None = None
    number = 0
    while True:
        # Every mask of the last level is covered anew on its free bits.
        parts: list[tuple[int, list[tuple[int, int]]]] = []
        for n, mask in masks:
            free = [i for i in range(BITS) if not mask >> i & 1]
            finer = []
            for extra in covering_masks(free, radius):
                number += 1
                finer.append((number, mask | extra))
            parts.append((n, finer))
        choice = None
        for n, finer in parts:
            keys = F.array(*[F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(
                F.lit(_signed(m)).cast("long")).alias("bits")) for k, m in finer])
            choice = F.when(F.col("mask") == n, keys) if choice is None else choice.when(F.col("mask") == n, keys)
        covered = current.select("fp", F.explode(choice).alias("k")).select("fp", "k.mask", "k.bits").distinct()
        covered = kept(covered, "buckets")
        masks = [x for _, finer in parts for x in finer]
        most_free = max(BITS - m.bit_count() for _, m in masks)
        sizes = covered.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        last = (1 << most_free) <= bucket_limit
        small = covered.join(sizes if last else sizes.filter(F.col("n") <= bucket_limit), ["mask", "bits"])
        solved = small.groupBy("mask", "bits").agg(F.collect_list("fp").alias("members")).select(
            "members").mapInArrow(_solve(radius), "a long, b long")
        found = solved if found is None else found.unionByName(solved)
        if last:
            return found
        large = kept(covered.join(sizes.filter(F.col("n") > bucket_limit), ["mask", "bits"]).select(
            "fp", "mask", "bits"), "large-buckets")
        if large.isEmpty():
            return found
        # The masks that still have a large bucket: at most as many as there are masks.
        open_masks = {r["mask"] for r in large.select("mask").distinct().collect()}
        masks = [x for x in masks if x[0] in open_masks]
        current = large


def _groups(prints: DataFrame, radius: int) -> DataFrame:
    """fp, first (smallest doc_id with that fingerprint), copies, and component_id of each distinct fingerprint."""
    distinct = kept(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")),
                    "distinct-fingerprints")
    edges = links(distinct, radius)
    reached = kept(components(edges), "components")
    # Components are named by fingerprints here; their name to the outside is the smallest doc_id.
    member = distinct.join(reached, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", "copies", F.coalesce("component", "fp").alias("component"))
    names = member.groupBy("component").agg(F.min("first").alias("component_id"))
    return member.join(names, "component")


def near_duplicates(documents: DataFrame, radius: int = 2, width: int = 3, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id and ``copies`` (rows with that fingerprint)."""
    docs = kept(fingerprints(documents, width, text=text, doc_id=doc_id), "fingerprints")
    named = _groups(docs, radius).select("fp", "copies", "component_id")
    return docs.join(named, "fp").select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"),
                                         "component_id", "copies")


def first_of_groups(documents: DataFrame, radius: int = 2, width: int = 3, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """The documents with one of each group of near duplicates, the one with the smallest id; columns unchanged.

    A group without any id keeps one document as well, and of repeated rows one stays.
    """
    inner, names = carry(documents)
    own = f"_in{names.index(doc_id)}"
    prints = kept(fingerprints(inner, width, text=f"_in{names.index(text)}", **{c: c for c in inner.columns}), "fingerprints")
    groups = _groups(prints.select("fp", F.col(own).alias("doc_id")), radius)
    first = groups.groupBy("component").agg(F.min_by(
        F.struct("fp", "first"), F.struct(F.col("first").isNull(), "first", "fp")).alias("of")).select(
        F.col("of.fp").alias("_fp"), F.col("of.first").alias("_first"))
    # The pair names a row but for repeats, so no key of this join is hot.
    chosen = prints.join(first, (F.col("fp") == F.col("_fp")) & F.col(own).eqNullSafe(F.col("_first")), "left_semi")
    text_column = f"_in{names.index(text)}"
    nth = F.row_number().over(Window.partitionBy("fp", own).orderBy(F.col(text_column)))
    return chosen.withColumn("_nth", nth).filter("_nth = 1").drop("_nth", "fp").toDF(*names)


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
