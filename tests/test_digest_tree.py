"""Digests by byte range against plain digests of the files, and planted changes."""

import hashlib

import numpy as np
import pytest

from tidemark.sources import digest_tree as D

SIZES = {"a.bin": 0, "b.bin": 1, "c/d.bin": 1000, "c/e.bin": 1024, "g.bin": 70_001}
RANGE = 256


@pytest.fixture
def folder(tmp_path):
    data = np.random.default_rng(1)
    for name, size in SIZES.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data.integers(0, 256, size, np.uint8).tobytes())
    return tmp_path


@pytest.fixture
def read(spark):
    """Rows are taken at once, since the files change between two states."""
    return lambda folder: spark.createDataFrame(D.range_digests(spark, str(folder), RANGE, "*.bin", tasks=3).collect(), D.LEAVES)


def test_ranges_and_tree(folder, read):
    found = read(folder)
    levels = D.tree(found, fan_out=4)
    assert len(levels) == 6     # 274 ranges, 69, 18, 5, 2, 1 nodes
    for name, size in SIZES.items():
        data = (folder / name).read_bytes()
        own = found.filter(found.file == name).orderBy("number").collect()
        assert [(r["start"], r["length"], r["sha256"], r["line_feeds"]) for r in own] == [
            (k, len(data[k:k + RANGE]), hashlib.sha256(data[k:k + RANGE]).hexdigest(), data[k:k + RANGE].count(b"\n"))
            for k in range(0, size, RANGE)]
        expected = [r["sha256"] for r in own]
        for level in levels[1:]:
            expected = [hashlib.sha256("".join(expected[k:k + 4]).encode()).hexdigest() for k in range(0, len(expected), 4)]
            assert [r["sha256"] for r in level.filter(level.file == name).orderBy("number").collect()] == expected


def test_changes_are_found_where_they_are(folder, read):
    then = D.tree(read(folder), fan_out=4)
    data = bytearray((folder / "g.bin").read_bytes())
    data[5 * RANGE] ^= 1
    data[70_000] ^= 1
    (folder / "g.bin").write_bytes(data)
    (folder / "b.bin").write_bytes(b"x" * 300)                       # its one range changes, a second one comes
    (folder / "c/e.bin").write_bytes((folder / "c/e.bin").read_bytes()[:512])
    now = D.tree(read(folder), fan_out=4)
    got = sorted(tuple(r) for r in D.changed_ranges(now, then, fan_out=4).collect())
    assert got == [("b.bin", 0, "changed"), ("b.bin", 1, "added"), ("c/e.bin", 2, "missing"), ("c/e.bin", 3, "missing"),
                   ("g.bin", 5, "changed"), ("g.bin", 273, "changed")]
    assert D.changed_ranges(now, now, fan_out=4).isEmpty()


def test_trees_of_different_heights(folder, read):
    then = D.tree(read(folder), fan_out=4)
    (folder / "g.bin").write_bytes((folder / "g.bin").read_bytes() * 5)
    now = D.tree(read(folder), fan_out=4)
    assert len(now) > len(then)
    got = {(r["number"], r["change"]) for r in D.changed_ranges(now, then, fan_out=4).collect() if r["file"] == "g.bin"}
    assert got == {(273, "changed"), *((n, "added") for n in range(274, -(-70_001 * 5 // RANGE)))}
