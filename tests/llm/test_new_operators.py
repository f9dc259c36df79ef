"""Spelling variants, packing and alignment against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from test_llm_operators import bag

from tidemark.llm import alignment, two_fit, variants
from tidemark.llm.byte_tokens import ByteEncoder

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
CASE = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# Byte tokens

@pytest.mark.parametrize("special", [True, False])
def test_byte_tokens_equal_the_library(special):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = special
    rng = random.Random(1)
    signs = ["a", "B", "é", " ", "  ", "\n", "\t", "1", "'s", "<|endoftext|>", "☃", " ", "🙂", "_", "\x1c", "́", " ", "!", "x" * 70]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    encoder = ByteEncoder.load(BYTES, special)
    assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(texts)] == [
        e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


# Spelling variants

def plain_words(rows, leave_out):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(CASE)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % leave_out == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_forms(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in words}
    form = {}
    for w, n in words.items():
        top = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        yield w, form[w], root, n, len(near[w]), words.get(form[w])


def variant_rows(seed=6):
    """Words of few letters, so that every kind of neighbour, run of equal letters and tie occurs; chains of forms."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abÀé") for _ in range(rng.randint(4, 7))) for _ in range(250)]
    chain = ["letter" + "z" * k for k in range(5)]
    texts = [" ".join(rng.choice(base).upper() if k % 5 else rng.choice(base) for k in range(rng.randint(0, 80))) + "×÷é1b" for _ in range(90)]
    texts += [" ".join(w for k, w in enumerate(chain) for _ in range(3 * 2 ** k))]
    texts += ["q" * 64 + " " + "q" * 65 + "," + "q" * 63 + "r " + "q" * 63, "k" * 300 + "a " + "k" * 300 + "b " + "k" * 301 + "a"] * 3
    texts += ["y" * 20_000 + " " + "y" * 19_999] * 4 + [None, "", " \n", "İstanbul ŝ aaaaáaaaaa"] * 3
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, texts[3]), (3, texts[3]), (-5, texts[1])]
    return [(*r, "clash", 1) for r in rows]


@pytest.mark.parametrize("leave_out", [97, 3])
def test_spelling_forms(spark, leave_out):
    rows = variant_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string, word string, n long").repartition(3)
    words = plain_words([r[:2] for r in rows], leave_out)
    expected = list(plain_forms(words))
    got = variants.spelling_forms(frame, leave_out)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert bag(got.collect()) == bag(expected)
    assert sum(e[4] for e in expected) > 200 and any(e[1] for e in expected) and (leave_out == 3 or any(e[1] and e[1] != e[2] for e in expected))


def test_spelling_groups_over_batches(spark):
    """Groups that are cut by batches of the scan."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = variant_rows(7)
        got = variants.spelling_forms(spark.createDataFrame(rows, "doc_id long, text string, word string, n long").coalesce(1))
        assert bag(got.collect()) == bag(plain_forms(plain_words([r[:2] for r in rows], 97)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def test_spelling_empty(none):
    assert variants.spelling_forms(none).collect() == []


# Packing

def plain_two_fit(lengths, capacity):
    """One sequence at a time, over a sorted list."""
    left, out = sorted(lengths), []
    while left:
        own, gap = [], capacity
        while fits := [n for n in left if n <= gap]:
            own.append(fits[-1])
            left.remove(fits[-1])
            gap -= fits[-1]
        if gap and len(own) > 1:
            room = gap + min(own)
            pairs = [(left[i] + left[j], left[j], left[i]) for i in range(len(left)) for j in range(i + 1, len(left))
                     if min(own) < left[i] + left[j] <= room]
            if pairs:
                _, x, y = max(pairs)
                left = sorted([*left, min(own)])
                own.remove(min(own))
                for n in (x, y):
                    left.remove(n)
                    own.append(n)
        out.append(tuple(sorted(own, reverse=True)))
    return out


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_best_two_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 64])
    kinds = rng.sample(range(1, capacity + 1), rng.randint(1, min(9, capacity)))
    lengths = [rng.choice(kinds) for _ in range(rng.randint(0, 160))]
    plan = two_fit.best_two_fit(Counter(lengths), capacity)
    flat = [tuple(n for n, c in f.lengths for _ in range(c)) for f in plan for _ in range(f.times)]
    assert sorted(flat) == sorted(plain_two_fit(lengths, capacity))


def test_packing(spark, docs, plain):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTES)
    rows = two_fit.pack(docs, BYTES, with_ids=True).collect()
    expected = []
    for i, t, _ in plain:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        at = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)] if len(ids) > 2048 else [0, len(ids)]
        expected += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), ids[a:b]) for k, (a, b) in enumerate(zip(at, at[1:], strict=False))]
    assert bag(tuple(r)[:6] for r in rows) == bag(expected) and any(e[1] > 5 for e in expected)
    filled = defaultdict(list)
    for r in rows:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in filled.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    total = sum(e[3] for e in expected)
    assert -(-total // 2048) <= len(filled) <= -(-total // 2048) + 1
    whole = two_fit.sequences(two_fit.pack(docs, BYTES, with_ids=True)).collect()
    assert sum(len(r["ids"]) for r in whole) == total and max(len(r["ids"]) for r in whole) <= 2048


def test_packing_many_pieces_of_one_length(spark, none):
    frame = spark.createDataFrame([(None if i % 3 else i, "one two" if i % 3 else "three " * (i % 40)) for i in range(3000)],
                                  "doc_id long, text string").repartition(7)
    rows = two_fit.pack(frame, BYTES, capacity=64).collect()
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    for (s, o, n), (s2, o2, _) in zip(places, places[1:], strict=False):
        assert (s2, o2) == (s, o + n) or o2 == 0 and s2 > s and o + n <= 64
    assert places[0][:2] == (0, 0) and places[-1][0] + 1 <= -(-sum(p[2] for p in places) // 64) + 2
    assert two_fit.pack(none, BYTES).collect() == []


# Alignment

def plain_alignment(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    tokenizer, model = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    tokenizer.encode_special_tokens = True
    found, count = [], Counter()
    for i, t in rows:
        groups, links = [], []
        if t:
            a = [(x, len(tokenizer.id_to_token(x))) for x in tokenizer.encode(" " + t, add_special_tokens=False).ids]
            text_b = [(x, bytes([x - 3]) if 3 <= x < 259 else model.id_to_piece(x).replace("▁", " ").encode()) for x in model.encode(t)]
            if b"".join(p for _, p in text_b) == f" {t}".encode():
                spans = []
                for side in (a, [(x, len(p)) for x, p in text_b]):
                    at, own = 0, []
                    for x, n in side:
                        own.append((x, at, at + n))
                        at += n
                    spans.append(own)
                ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
                for low, high in zip([0, *ends], ends, strict=False):
                    parts = [[s for s in own if low <= s[1] and s[2] <= high] for own in spans]
                    groups.append("|".join(",".join(str(s[0]) for s in p) for p in parts))
                    links += [(x[0], y[0]) for x in parts[0] for y in parts[1] if x[1] < y[2] and y[1] < x[2]]
                found.append((i, len(spans[0]), len(spans[1]), groups, links))
                count.update(links)
                continue
        found.append((i, 0, 0, groups, links))
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    for i, n_a, n_b, groups, links in found:
        yield (i, n_a, n_b, len(groups), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
               hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")


@pytest.mark.parametrize("block", [3 << 20, 2_000])
def test_alignment(docs, plain, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    rows = [(i, t) for i, t, _ in plain if i not in (203, 204)]
    expected = list(plain_alignment(rows))
    got = alignment.align(docs.filter("doc_id is null or doc_id not in (203, 204)"), BYTES, PIECES)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert bag(got.collect()) == bag(expected) and sum(e[4] for e in expected) > 5000


def test_alignment_odd_texts(spark, docs, none):
    texts = [" ", "  a  b ", "▁u", "a▁", "<s>x</s> <unk> <0x41>", "<|endoftext|> z", "\0", "ﬁ ① ½", "☃🙂‍", "\r\n\t", "é́", "x" * 3000]
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, block int")
    assert bag(alignment.align(frame, BYTES, PIECES).collect()) == bag(plain_alignment(list(enumerate(texts))))
    long = {r["doc_id"]: r for r in alignment.align(docs.filter("doc_id in (203, 204)"), BYTES, PIECES).collect()}
    assert long[203]["n_groups"] > 20_000 and long[204]["n_a"] > 0 and len(long) == 2
    assert alignment.align(none, BYTES, PIECES).collect() == []
