"""Burrows-Wheeler transform and common prefixes of a collection, built column by column.

All strings grow from their ends: round j puts the suffix of length j of every string into the sorted order of all
suffixes so far. Where it goes follows from where the suffix of length j - 1 stands: after all suffixes that start
with a smaller symbol, and after those that start with the same symbol and whose rest stands earlier. The transform
and the lengths of common prefixes between neighbours are held in sequential files: a round reads them from front to
back, twice, in blocks of fixed size, and writes new ones. Only the place of the newest suffix of each string is kept
in memory. The files stay in memory while they are small.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20
IN_MEMORY = 8 << 20
END = 0  # no byte of UTF-8 text is 255, so bytes are shifted by one and 0 marks where a string begins


class _Column:
    """A sequential file of bytes; a task's own and gone with it."""

    def __init__(self) -> None:
        self.file = tempfile.SpooledTemporaryFile(max_size=IN_MEMORY)
        self.rows = 0

    def append(self, values: np.ndarray) -> None:
        self.file.write(values.tobytes())
        self.rows += len(values)

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        self.file.seek(0)
        for at in range(0, self.rows, BLOCK):
            yield at, np.frombuffer(self.file.read(min(BLOCK, self.rows - at)), np.uint8)

    def all(self) -> np.ndarray:
        self.file.seek(0)
        return np.frombuffer(self.file.read(self.rows), np.uint8)

    def close(self) -> None:
        self.file.close()


class _Symbols:
    """What a forward pass knows of each symbol: how often it came, and the smallest prefix since the last time."""

    def __init__(self) -> None:
        self.seen = np.zeros(256, np.int64)
        self.since = np.full(256, 255, np.uint8)
        self.open = np.full(256, -1, np.int64)       # a new suffix that waits for the next one with its symbol
        self.open_since = np.full(256, 255, np.uint8)


def _range_min(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Smallest value in each range first..last. Ranges are taken from the last to the first of them, so that the
    gaps between them run backwards and cost one step each."""
    if not len(first):
        return np.zeros(0, np.uint8)
    order = np.argsort(first, kind="stable")[::-1]
    bounds = np.empty(2 * len(first), np.int64)
    bounds[0::2], bounds[1::2] = first[order], last[order] + 1
    padded = np.append(values, np.uint8(255))
    found = np.empty(len(first), np.uint8)
    found[order] = np.minimum.reduceat(padded, bounds)[0::2]
    return found


def _locate(bwt: _Column, lcp: _Column, at: np.ndarray, symbol: np.ndarray, before: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First pass of a round. ``at`` is sorted. Places of the new suffixes, and their common prefixes with the suffix
    in front of them and with the one behind."""
    place = np.empty(len(at), np.int64)
    front, behind = np.zeros(len(at), np.uint8), np.zeros(len(at), np.uint8)
    known = _Symbols()
    for (base, b), (_, low) in zip(bwt.blocks(), lcp.blocks(), strict=True):
        i, j = np.searchsorted(at, [base, base + len(b)])
        x, c = at[i:j] - base, symbol[i:j].astype(np.int64)
        b = b.copy()
        b[x] = symbol[i:j]
        order = np.argsort(b, kind="stable")
        count = np.bincount(b, minlength=256)
        begin = np.cumsum(count) - count
        index = np.empty(len(b), np.int64)
        index[order] = np.arange(len(b))
        k = index[x]
        rank = k - begin[c]
        place[i:j] = before[c] + known.seen[c] + rank
        inner, more = rank > 0, rank + 1 < count[c]
        front_here = np.zeros(len(x), np.uint8)
        front_here[inner] = 1 + _range_min(low, order[k[inner] - 1] + 1, x[inner])
        behind[np.flatnonzero(more) + i] = 1 + _range_min(low, x[more] + 1, order[k[more] + 1])
        if len(b) == bwt.rows:  # the only block: nothing reaches across
            front[i:j] = front_here
            break
        to_front = np.minimum.accumulate(low)
        to_back = np.minimum.accumulate(low[::-1])[::-1]
        present = np.flatnonzero(count)
        # Suffixes of earlier blocks that wait for the next one with their symbol.
        waiting = present[known.open[present] >= 0]
        behind[known.open[waiting]] = 1 + np.minimum(known.open_since[waiting], to_front[order[begin[waiting]]])
        known.open[waiting] = -1
        known.open_since = np.minimum(known.open_since, to_front[-1])

        outer = ~inner & (known.seen[c] > 0)
        front_here[outer] = 1 + np.minimum(known.since[c[outer]], to_front[x[outer]])
        front[i:j] = front_here
        last = ~more
        known.open[c[last]] = np.flatnonzero(last) + i
        known.open_since[c[last]] = np.append(to_back, np.uint8(255))[x[last] + 1]

        known.seen += count
        known.since = np.minimum(known.since, to_front[-1])
        ends = order[begin[present] + count[present] - 1]
        known.since[present] = np.append(to_back, np.uint8(255))[ends + 1]
    return place, front, behind


def _insert(bwt: _Column, lcp: _Column, at: np.ndarray, symbol: np.ndarray, place: np.ndarray, front: np.ndarray,
            behind: np.ndarray) -> tuple[_Column, _Column]:
    """Second pass of a round: the new suffixes, each still without a symbol, merged between the old ones."""
    order = np.argsort(place)
    into = place[order] - np.arange(len(place))  # the old row in front of which each goes
    last = np.append(into[1:] != into[:-1], True) if len(into) else np.zeros(0, bool)
    front, behind = front[order], behind[order]
    new_bwt, new_lcp = _Column(), _Column()
    for (base, b), (_, low) in zip(bwt.blocks(), lcp.blocks(), strict=True):
        i, j = np.searchsorted(at, [base, base + len(b)])
        b, low = b.copy(), low.copy()
        b[at[i:j] - base] = symbol[i:j]
        i, j = np.searchsorted(into, [base, base + len(b)])
        low[into[i:j][last[i:j]] - base] = behind[i:j][last[i:j]]
        new_bwt.append(np.insert(b, into[i:j] - base, np.uint8(END)))
        new_lcp.append(np.insert(low, into[i:j] - base, front[i:j]))
    tail = np.searchsorted(into, bwt.rows)
    new_bwt.append(np.full(len(into) - tail, END, np.uint8))
    new_lcp.append(front[tail:])
    bwt.close()
    lcp.close()
    return new_bwt, new_lcp


def collection_bwt(strings: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The transform and the common prefixes (up to 254) of strings given as right-aligned rows of bytes.

    Row i < n of the order is the empty suffix of string i; END stands in front of whole strings.
    """
    n, longest = strings.shape
    bwt, lcp = _Column(), _Column()
    bwt.append(np.full(n, END, np.uint8))
    lcp.append(np.zeros(n, np.uint8))
    at, who = np.arange(n), np.arange(n)   # places of the newest suffixes, in order, and whose they are
    counts = np.zeros(256, np.int64)
    for j in range(1, longest + 1):
        grow = lengths[who] >= j
        at, who = at[grow], who[grow]
        if not len(who):
            break
        symbol = strings[who, longest - j] + np.uint8(1)
        counts += np.bincount(symbol, minlength=256)
        before = n + np.cumsum(counts) - counts
        place, front, behind = _locate(bwt, lcp, at, symbol, before)
        bwt, lcp = _insert(bwt, lcp, at, symbol, place, front, behind)
        order = np.argsort(place)
        at, who = place[order], who[order]
    found = bwt.all(), lcp.all()
    bwt.close()
    lcp.close()
    return found


def suffix_rows(bwt: np.ndarray, n: int, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, strings, rows): where the suffixes of each length stand, by walking all strings back from their ends."""
    order = np.argsort(bwt, kind="stable")
    step = np.empty(len(bwt), np.int64)
    step[order] = np.arange(len(bwt))  # rows with END come first, as many as there are empty suffixes
    row, who = np.arange(n), np.arange(n)
    for length in range(1, longest + 1):
        more = bwt[row] != END
        row, who = step[row[more]], who[more]
        if not len(who):
            return
        yield length, who, row
