"""Positions in documents, packed for the way back to them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from tidemark.llm.sketch import KEY_BYTES, squeezed, unsqueezed


def key_of(doc_id: object, text: bytes) -> bytes:
    """The identity of a document: rows that agree in it are equal."""
    return xxhash.xxh3_128_digest(repr(doc_id).encode() + b"\0" + text)[:KEY_BYTES]


def distinct(keys: list[bytes], wanted: list[bool]) -> tuple[list[int], list[int]]:
    """Places of the keys to go on with, and how many each stands for: of equal wanted ones the first stands for all."""
    place: dict[bytes, int] = {}
    stay, copies = [], []
    for i, (key, want) in enumerate(zip(keys, wanted, strict=True)):
        at = place.setdefault(key, len(stay)) if want else len(stay)
        if at < len(stay):
            copies[at] += 1
        else:
            stay.append(i)
            copies.append(1)
    return stay, copies


def group_of(keys: np.ndarray, groups: int) -> np.ndarray:
    """The group of documents of each key."""
    return (np.ascontiguousarray(keys[:, :4]).view("<u4")[:, 0] % groups).astype(np.int64)


def keys_of(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint8).reshape(-1, KEY_BYTES)


def steps_of(at: np.ndarray) -> bytes:
    """Positions as differences, compressed: windows in a row are ones."""
    return squeezed(np.diff(at, prepend=0).astype("<i8").tobytes())


def positions_of(steps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(unsqueezed(steps), "<i8"))


def counts_to(counts: np.ndarray) -> bytes:
    return squeezed(counts.astype("<u4").tobytes())


def counts_of(packed: bytes) -> np.ndarray:
    return np.frombuffer(unsqueezed(packed), "<u4")


def split_by_key(keys: bytes, counts: bytes, steps: bytes) -> Iterator[tuple[bytes, np.ndarray]]:
    """Each key with its positions."""
    for i, at in enumerate(np.split(positions_of(steps), np.cumsum(counts_of(counts))[:-1])):
        yield keys[KEY_BYTES * i:KEY_BYTES * (i + 1)], at


def by_group(doc: np.ndarray, at: np.ndarray, keys: np.ndarray, groups: int
              ) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Positions packed by group of documents: group, keys, number of positions per key, positions."""
    if not len(doc):
        return
    group = group_of(keys, groups)[doc]
    order = np.lexsort((at, doc, group))
    doc, at, group = doc[order], at[order], group[order]
    first = np.flatnonzero(np.diff(doc, prepend=-1))  # documents of a group follow each other
    sizes = np.diff(first, append=len(doc))
    for g in np.unique(group).tolist():
        a, b = np.searchsorted(group, [g, g + 1])
        c, d = np.searchsorted(first, [a, b])
        yield g, keys[doc[first[c:d]]].tobytes(), counts_to(sizes[c:d]), steps_of(at[a:b])
