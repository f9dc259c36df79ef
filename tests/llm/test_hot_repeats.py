"""Repeated rows and hot anchors: much of one kind in one place."""

import random

import numpy as np

from tidemark.llm import byte_repeats, passages
from tidemark.llm.rolling import joined_windows, mixed
from tidemark.llm.shingles import shingle_sets


def runs(rows, spark, **more):
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], bytes(r["cleaned"])) for r in byte_repeats.remove_repeats(frame, **more).collect())


def test_byte_repeats_of_many_equal_ids(spark):
    """One id and text 5,000 times, and one id with 2,000 texts that share a passage, in one partition."""
    passage = "a passage of more than fifty bytes, which many rows of one id have"
    rows = [(7, passage)] * 5_000 + [(9, f"{i:05d}{passage}") for i in range(2_000)]
    assert runs(rows, spark) == sorted([(7, len(passage), 0, passage.encode())] * 5_000 + [
        (9, len(passage) + 5, len(passage), f"{i:05d}".encode()) for i in range(2_000)])
    rows = [(9, f"{i:05d}{passage}") for i in range(2_000)]
    assert {r[2] for r in runs(rows, spark)} == {0}


def hot_rows(between):
    """One phrase in ever other surroundings, some of which occur twice."""
    rng = random.Random(11)
    word = lambda: f"{rng.randrange(10**6):06d}"
    frames = [([word() for _ in range(30)], [word() for _ in range(30)]) for _ in range(120)]
    frames += frames[:20]
    return [(i, " ".join([*before, between, *after])) for i, (before, after) in enumerate(frames)]


def watched(monkeypatch, module):
    """The hot anchors that a run finds."""
    hot = []
    plain = module.hot_anchors
    monkeypatch.setattr(module, "hot_anchors", lambda *a: hot.append(plain(*a)) or hot[-1])
    return hot


def test_byte_repeats_with_hot_anchors(spark, monkeypatch):
    rows = hot_rows("- " * 40)
    expected = runs(rows, spark)
    monkeypatch.setattr(byte_repeats, "HOT_FRAGMENTS", 20)
    hot = watched(monkeypatch, byte_repeats)
    assert runs(rows, spark) == expected and len(hot[0])
    assert sum(r[2] for r in expected) > 0


def test_byte_repeats_sort_few_fragments_together(spark, monkeypatch):
    """What a task sorts at a time does not follow its bucket: before, a whole bucket was opened at once."""
    rng = random.Random(3)
    passages_ = ["".join(rng.choice("abcdefgh ") for _ in range(90)) for _ in range(60)]
    rows = [(i, passages_[i % 60] + f"{i:05d}" + passages_[i * 7 % 60]) for i in range(300)]
    expected = runs(rows, spark)
    solved = byte_repeats._solved

    def few(pieces, *more):
        assert len(pieces) <= 20, len(pieces)
        return solved(pieces, *more)

    monkeypatch.setattr(byte_repeats, "SOLVED_PIECES", 10, raising=False)
    monkeypatch.setattr(byte_repeats, "_solved", few)
    assert runs(rows, spark) == expected and sum(r[2] for r in expected) > 0


def test_passages_with_hot_anchors(spark, monkeypatch):
    rows = hot_rows("the " * 12)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = sorted(map(tuple, passages.remove_repeated(frame).collect()))
    monkeypatch.setattr(passages, "HOT_WINDOWS", 20)
    hot = watched(monkeypatch, passages)
    assert sorted(map(tuple, passages.remove_repeated(frame).collect())) == expected and len(hot[0])
    assert sum(r[2] for r in expected) > 0


def test_windows_of_a_hot_anchor_are_dealt(spark):
    """4,000 windows of one anchor go to many buckets if it is hot, and to one if not; equal windows share theirs."""
    anchor, high = np.full(4_000, 77, np.uint64), mixed(np.arange(4_000, dtype=np.uint64) // np.uint64(2))
    used = {}
    for hot in ([], [77]):
        held = passages._Candidates(64, 4, np.array(hot, np.uint64))
        held.add(high, high.astype(np.uint32), anchor, np.zeros(4_000, np.int64), np.arange(4_000), [b"k" * 16])
        bucket = held.bucket[0]
        assert (bucket[0::2] == bucket[1::2]).all()
        used[len(hot)] = len(set(bucket.tolist()))
    assert used == {0: 1, 1: 64}


def thue_morse():
    """1,024 letters and their complement: polynomial hashes modulo 2^64 are equal for every odd base."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_polynomial_hashes_confuse(spark):
    one, other = thue_morse()
    tail = " ".join(f"w{i}" for i in range(34))
    frame = spark.createDataFrame([(1, f"{one} {tail}"), (2, f"{other} {tail}")], "doc_id long, text string")
    assert [r["n_removed"] for r in passages.remove_repeated(frame).collect()] == [0, 0]
    swapped = [" ".join("xy"[b == "b"] for b in t) for t in (one, other)]
    assert not set(joined_windows(passages.Words([swapped[0].encode()]).hashes(0), 1024)) & set(
        joined_windows(passages.Words([swapped[1].encode()]).hashes(0), 1024))
    assert jaccard_of(one, other) == 0


def jaccard_of(one, other):
    a, b = shingle_sets([f"{t} p q r s u".encode() for t in (one, other)], 5)
    return len(np.intersect1d(a, b)) - 1  # the five words behind are shared
