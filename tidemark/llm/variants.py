"""Spelling variants: words that differ by one inserted, deleted or replaced character, by permuterm rotations.

Words are marked with a terminator, and all their rotations are sorted. The rotation that starts behind a character ends
with it: for a word p c s it is ``s $ p c``. Words that have another character in the place of c share all of it but the end,
and the word p s without it has the rotation ``s $ p``. So each rotation without its last character is a prefix under which
one word stands whole, and the others by their edited character. Rotations are dealt by ranges of that prefix and sorted,
and a scan over each range tells every word of a group how many neighbours it has there and which is the most frequent.
A group has one word a character of the alphabet at most, and the word without it, so no group is large; nothing is compared
in pairs. Two words with different characters in one place meet in one group only. Taking any of several equal characters
in a row gives the same word, so only the first of them counts as left out.

Words carry numbers in their code-point order (ranges of a sort, numbered within each), so that ties need no words in the
scan. Prefixes above ``LONGEST_PLAIN`` characters are stood for by their value modulo a prime of 127 bits, taken from sums over
the word, so a word of any length costs a short row a character.

Defined results: a null text has no words; a null id is written as ``None`` in the hash that leaves characters out. Copies
and repeated rows count each. Of neighbours with equal counts the smallest in code-point order is the form. Words are
counted in whole texts, however long. An empty table gives an empty result. Extra columns play no part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept, pick, texts_of
from tidemark.llm.rolling import slabs

HELD_WORDS = 500_000
ROTATIONS_A_BATCH = 200_000
LONGEST_PLAIN = 64
TERMINATOR = 0                       # no word holds it
_PRIME = (1 << 127) - 1
_BASE = 0x2545F4914F6CDD1D9E3779B97F4A7C15
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LEAD = 0xC3                         # of the two bytes of U+00C0 to U+00FF


def runs_of(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The maximal runs of letters of each text, A-Z in lower case."""
    raw = np.frombuffer(b" ".join(texts).lower(), np.uint8)
    lead = raw == _LEAD
    letter = _LETTER[raw] | lead
    letter[1:] |= lead[:-1]
    plain = np.where(letter, raw, np.uint8(ord(" "))).tobytes()
    at = 0
    for t in texts:
        yield plain[at:at + len(t)].split()
        at += len(t) + 1


def _left_out(run: bytes, h: int) -> bytes:
    """The run without the code point that the hash names."""
    word = run.decode()
    at = h % len(word)
    return (word[:at] + word[at + 1:]).encode()


def occurrences(documents: DataFrame, leave_out: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the words of all texts, one character left out of each run whose hash ``leave_out`` divides (0: of none)."""
    docs = pick(documents, doc_id=doc_id, text=text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            texts, ids = texts_of(batch), batch.column("doc_id").to_pylist()
            for a, b in slabs(texts):
                for doc, runs in zip(ids[a:b], runs_of(texts[a:b]), strict=True):
                    start = zlib.crc32(f"{doc}:".encode())
                    for run, n in Counter(runs).items():
                        if leave_out and (h := zlib.crc32(run, start)) % leave_out == 0:
                            run = _left_out(run, h)
                        held[run] = held.get(run, 0) + n
                if len(held) > HELD_WORDS:
                    yield told()
                    held.clear()
        yield told()

    return docs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame) -> DataFrame:
    """The words with ``id``: numbers in the code-point order of the words."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(first, first + batch.num_rows)), *batch.columns], names=["id", *batch.schema.names])
            first += batch.num_rows

    return words.select("word", "n").repartitionByRange("word").sortWithinPartitions("word").mapInArrow(
        number, "id long, word string, n long")


def prefixes(word: str) -> Iterator[tuple[bytes, int, bool]]:
    """For each rotation of the marked word: the prefix it stands under, the edited character behind the prefix (-1 for a
    rotation that is all prefix), and whether leaving that character out counts."""
    size = len(word)
    if size < LONGEST_PLAIN:
        for i in range(size + 1):
            yield f"{word[i:]}\0{word[:i]}".encode(), -1, False
            if i < size:
                yield f"{word[i + 1:]}\0{word[:i]}".encode(), ord(word[i]), not i or word[i - 1] != word[i]
        return
    before, power = [0], [1]
    for c in word:
        before.append((before[-1] * _BASE + ord(c) + 1) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)

    def value(i: int, j: int) -> bytes:
        """What stands for word[i:], the terminator and word[:j]."""
        behind = (before[size] - before[i] * power[size - i]) % _PRIME
        both = ((behind * _BASE + TERMINATOR + 1) * power[j] + before[j]) % _PRIME
        return b"\1" + (size - i + j).to_bytes(8, "big") + both.to_bytes(16, "big")

    for i in range(size + 1):
        yield value(i, i), -1, False
        if i < size:  # a prefix of the last plain length is written out, as a shorter word would write it
            key = value(i + 1, i) if size > LONGEST_PLAIN else f"{word[i + 1:]}\0{word[:i]}".encode()
            yield key, ord(word[i]), not i or word[i - 1] != word[i]


def rotations(words: DataFrame) -> DataFrame:
    """prefix, edited, counts, id, n: all rotations of the words."""
    kinds = (pa.binary(), pa.int32(), pa.bool_(), pa.int64(), pa.int64())
    names = ["prefix", "edited", "counts", "id", "n"]

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[bytes, int, bool, int, int]] = []

        def told() -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for word, i, n in zip(*(batch.column(c).to_pylist() for c in ("word", "id", "n")), strict=True):
                for prefix in prefixes(word):
                    rows.append((*prefix, i, n))
                    if len(rows) >= ROTATIONS_A_BATCH:
                        yield told()
                        rows.clear()
        yield told()

    return words.select("id", "word", "n").mapInArrow(turn, "prefix binary, edited int, counts boolean, id long, n long")


def _scanned(table: pa.Table) -> pa.RecordBatch:
    """What the groups of whole, sorted prefixes tell their members: id, near, best_n, best."""
    prefix = table.column("prefix").combine_chunks()
    new = np.ones(len(prefix), bool)
    new[1:] = pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False)
    group = np.cumsum(new) - 1
    n_groups = int(group[-1]) + 1
    edited, counts, ids, n = (table.column(c).to_numpy() for c in ("edited", "counts", "id", "n"))
    is_edited = edited >= 0
    none = len(ids)
    ids, n = np.append(ids, -1), np.append(n, 0)

    def firsts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each group: how many of the rows are in it, the first of them, and the second."""
        many = np.bincount(group[rows], minlength=n_groups)
        at = np.cumsum(many) - many
        padded = np.append(rows, [none, none])
        return many, np.where(many > 0, padded[at], none), np.where(many > 1, padded[at + 1], none)

    # Rows of a group are in the order of the choice: the highest count, then the smallest number.
    edits, first, second = firsts(np.flatnonzero(is_edited))
    left_out, taken, _ = firsts(np.flatnonzero(is_edited & counts))
    whole = firsts(np.flatnonzero(~is_edited))[1]
    row = np.flatnonzero(is_edited)
    g = group[row]
    best = np.where(first[g] == row, second[g], first[g])
    shorter = np.where(counts[row], whole[g], none)
    swap = (n[shorter] > n[best]) | ((n[shorter] == n[best]) & (shorter != none) & (ids[shorter] < ids[best]))
    best = np.where(swap, shorter, best)
    near = edits[g] - 1 + (shorter != none)
    base = np.flatnonzero(~is_edited)
    out_id = np.append(ids[row], ids[base])
    out_near = np.append(near, left_out[group[base]])
    out_best = np.append(best, taken[group[base]])
    has = out_near > 0
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (out_id[has], out_near[has], n[out_best[has]], ids[out_best[has]])],
                                      names=["id", "near", "best_n", "best"])


def neighbours(words: DataFrame) -> DataFrame:
    """id, n_near, best_n, best: the number of near words of each word that has any, and the most frequent of them.

    ``words`` has id, word and n, each word once, with ids in the order of the words.
    """
    # One partition holds whole prefixes: equal values are never dealt to two ranges.
    turned = rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix", F.desc("n"), "id")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            prefix = table.column("prefix")
            last = pc.index(pc.equal(prefix, prefix[-1]), True).as_py()
            if last:  # the last group may go on in the next batch
                yield _scanned(table.slice(0, last))
            held = table.slice(last).to_batches()
        if held:
            yield _scanned(pa.Table.from_batches(held))

    told = turned.mapInArrow(scan, "id long, near long, best_n long, best long")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
    return told.groupBy("id").agg(F.sum("near").alias("n_near"), best).select(
        "id", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def roots(steps: DataFrame) -> DataFrame:
    """id, root: where the steps (id, form) lead in the end. A step leads to a higher count, so there are no rings; each round
    doubles the way."""
    current = kept(steps.select("id", F.col("form").alias("root")), "forms")
    while True:
        onward = current.select(F.col("id").alias("_at"), F.col("root").alias("_to"))
        moved = kept(current.join(onward, F.col("root") == F.col("_at"), "left").select(
            "id", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("went")), "forms")
        current = moved.select("id", "root")
        if moved.filter("went").isEmpty():
            return current


def spelling_forms(documents: DataFrame, leave_out: int = 97, shortest: int = 5, least: int = 3, times: int = 2,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of each word with ``shortest`` code points and ``least`` occurrences."""
    counted = occurrences(documents, leave_out, doc_id, text).filter((F.col("n") >= least) & (F.length("word") >= shortest))
    words = kept(numbered(counted), "words")
    near = neighbours(words)
    told = kept(words.select("id", "n").join(near, "id", "left"), "near-words")
    forms = told.filter(F.col("best_n") >= times * F.col("n")).select("id", F.col("best").alias("form"), F.col("best_n").alias("form_n"))
    led = forms.join(roots(forms), "id")
    name = words.select(F.col("id").alias("_id"), F.col("word").alias("_word"))
    named = led
    for column in ("form", "root"):
        named = named.join(name, F.col(column) == F.col("_id")).drop("_id", column).withColumnRenamed("_word", column)
    counts = words.join(told.select("id", "n_near"), "id").join(named, "id", "left")
    return counts.select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                         F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
