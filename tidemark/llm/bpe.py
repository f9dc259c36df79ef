"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash of the last 32 bytes has nine zero bits, so equal passages are cut alike
wherever they stand. Documents that share chunks are brought together by their smallest chunk hash, and a task
encodes each distinct chunk once. A cut falls anywhere, often inside a word, so each chunk is held as what lies
between its outermost white space, which nothing outside can change, and two loose ends. At a join, the loose
ends are put together and re-encoded, the next chunk too if it has no white space, until the re-encoded part
meets white space on both sides: there the encodings agree exactly with that of the whole text.

White space is the six ASCII characters. A tokenizer qualifies if its words never reach across them, which holds
where white space is removed before merging; ``Encoder`` refuses one that keeps it. New words are encoded many
at once by the tokenizers library, and remembered up to a bound.

Defined results: a null or empty text has no tokens and decodes to an empty text. Special tokens written in a text
are those tokens, as in the library. Repeated rows stay rows. An empty table gives an empty result. Extra
columns play no part. Texts are encoded whole, however long.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.llm.common import pick, released, texts_of
from tidemark.llm.rolling import gear, slabs

CUT_BITS = 9                # chunks of 512 bytes on average
CHUNK_CACHE_BYTES = 24 << 20
WORD_CACHE = 100_000        # words of the newer half; the older half holds as many, and those of a step
STEP_BYTES = 2 << 20        # of texts that are encoded together
_SPACES = b" \t\n\r\x0b\x0c"


def cuts(data: bytes, h: np.ndarray) -> list[int]:
    """Ends of the chunks of one text; ``h`` holds its rolling hashes. Never inside a character."""
    raw = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(h[32:] >> np.uint32(32 - CUT_BITS) == 0) + 33
    ends = []
    for end in at.tolist():
        while end < len(data) and raw[end] & 0xC0 == 0x80:
            end += 1
        if end < len(data) and (not ends or end > ends[-1]):
            ends.append(end)
    return [*ends, len(data)]


def chunked(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The chunks of each text."""
    for first, last in slabs(texts):
        part = texts[first:last]
        h = gear(np.frombuffer(b"".join(part), np.uint8))
        at = 0
        for text in part:
            ends = cuts(text, h[at:at + len(text)]) if text else []
            yield [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            at += len(text)


class Encoder:
    """A tokenizer with remembered words and chunks; one per worker process."""

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.decoder is not None or self._ids("a \n b") != self._ids("a") + self._ids("b"):
            raise ValueError("this tokenizer keeps white space; its words can't be encoded alone")
        self.tokens = [(self.tokenizer.id_to_token(i) or "").encode()
                       for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, tuple[bytes, bytes, bytes, bytes]] = {}
        self.chunk_bytes = 0

    @classmethod
    def load(cls, path: str) -> Encoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, words: set[bytes]) -> None:
        """Makes the ids of the words known. New ones are encoded many in one text, kept apart by a sign that none
        of them holds. When the newer half of the memory is full, it takes the place of the older one; words that
        are still in use move over, so common words are never encoded twice."""
        if len(self.words) > WORD_CACHE:
            self.older, self.words = self.words, {}
        new = []
        for w in words:
            if w not in self.words:
                ids = self.older.get(w)
                if ids is None:
                    new.append(w)
                else:
                    self.words[w] = ids
        for at in range(0, len(new), 4000):
            part = new[at:at + 4000]
            plain = b" ".join(part)
            sign = next((s for s in "\x01\x02☃★☇" if s.encode() not in plain), None)
            if sign is None:
                for w in part:
                    self.words[w] = np.array(self._ids(w.decode()), "<u4").tobytes()
                continue
            mark = self._ids(sign)
            ids = np.array(self._ids(f" {sign} ".encode().join(part).decode()), "<u4")
            hits = np.ones(max(0, len(ids) - len(mark) + 1), bool)
            for k, m in enumerate(mark):
                hits &= ids[k:len(ids) - len(mark) + 1 + k] == m
            ends = [*np.flatnonzero(hits).tolist(), len(ids)]
            if len(ends) != len(part):
                raise AssertionError("words ran together")
            raw, begin = ids.tobytes(), 0
            for w, end in zip(part, ends, strict=True):
                self.words[w] = raw[4 * begin:4 * end]
                begin = end + len(mark)

    def _decoded(self, ids: bytes) -> bytes:
        return b" ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def encode(self, documents: list[list[bytes]]) -> Iterator[tuple[bytes, bytes]]:
        """Ids (little-endian, 32 bits) and decoded text of documents given as chunks."""
        if self.chunk_bytes > CHUNK_CACHE_BYTES:
            self.chunks, self.chunk_bytes = {}, 0
        fresh: dict[bytes, tuple[bytes, list[bytes], bytes]] = {}
        joins: list[list[bytes]] = []
        wanted: set[bytes] = set()
        for chunks in documents:
            own, carry = [], b""
            for chunk in chunks:
                cut = self.chunks.get(chunk)
                if cut is None and (cut := fresh.get(chunk)) is None:
                    words = chunk.split()
                    head = words.pop(0) if words and chunk[0] not in _SPACES else b""
                    # a chunk without white space is all head: its end is as loose as its start
                    tail = words.pop() if words and chunk[-1] not in _SPACES else b""
                    wanted.update(words)
                    cut = fresh[chunk] = (head, words, tail)
                if len(cut[0]) == len(chunk):
                    carry += chunk
                    own.append(None)
                    continue
                own.append(carry + cut[0])
                carry = cut[-1] if len(cut) == 3 else cut[3]
            own.append(carry)
            wanted.update(w for w in own if w)
            joins.append(own)
        self._learn(wanted)
        memo = self.words
        for chunk, (head, words, tail) in fresh.items():
            ids = b"".join([memo[w] for w in words])
            decoded = self._decoded(ids)
            self.chunks[chunk] = (head, ids, decoded, tail)
            self.chunk_bytes += 2 * len(chunk) + len(ids) + len(decoded) + 400
        for chunks, own in zip(documents, joins, strict=True):
            ids, decoded = [], []
            for chunk, join in zip([*chunks, None], own, strict=True):
                if join:
                    i = memo[join]
                    if i:
                        ids.append(i)
                        decoded.append(self._decoded(i))
                if chunk is not None and join is not None:
                    _, i, d, _ = self.chunks[chunk]
                    if i:
                        ids.append(i)
                        decoded.append(d)
            yield b"".join(ids), b" ".join(decoded)


@F.pandas_udf(LongType())
def chunk_key(texts: pd.Series) -> pd.Series:
    """The smallest hash of a text's chunks: texts with most chunks in common mostly have it in common."""
    plain = [b"" if t is None else bytes(t) for t in texts]
    digest = xxhash.xxh64_intdigest
    return pd.Series([min((digest(c) for c in chunks), default=0) - (1 << 63) for chunks in chunked(plain)], dtype="int64")


def encoded(documents: DataFrame, path: str, work, schema: str, text: str = "text", **keep: str) -> DataFrame:
    """Documents brought together by shared chunks, then ``work(batch, ids, decoded)`` on whole results.

    The rebalance splits a partition that one key has made large, so a group of copies is no single task.
    """
    docs = pick(documents, **keep, text=text).withColumn("text", F.col("text").cast("binary"))
    near = docs.withColumn("_key", chunk_key("text")).hint("rebalance", "_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.load(path)
        for batch in batches:
            texts = texts_of(batch)
            for first, last in slabs(texts, STEP_BYTES):
                results = list(encoder.encode(list(chunked(texts[first:last]))))
                yield work(batch.slice(first, last - first), results)

    return near.mapInArrow(released(run), schema)


def digests(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded text."""
    def work(batch: pa.RecordBatch, results: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"),
            pa.array([len(i) // 4 for i, _ in results], pa.int64()),
            pa.array([hashlib.sha256(i).hexdigest() for i, _ in results], pa.string()),
            pa.array([hashlib.sha256(d).hexdigest() for _, d in results], pa.string()),
        ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = pick(documents, doc_id=doc_id).schema["doc_id"].dataType.simpleString()
    return encoded(documents, path, work, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
                   text=text, doc_id=doc_id)


def tokens(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ``ids`` (array of int) and SHA-256 of the decoded text."""
    def work(batch: pa.RecordBatch, results: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        ends = np.cumsum([0, *(len(i) // 4 for i, _ in results)]).astype(np.int32)
        flat = np.frombuffer(b"".join(i for i, _ in results), "<u4").astype(np.int32)
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(np.diff(ends).astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            pa.array([hashlib.sha256(d).hexdigest() for _, d in results], pa.string()),
        ], names=["doc_id", "n_tokens", "ids", "decoded_sha256"])

    kind = pick(documents, doc_id=doc_id).schema["doc_id"].dataType.simpleString()
    return encoded(documents, path, work, f"doc_id {kind}, n_tokens long, ids array<int>, decoded_sha256 string",
                   text=text, doc_id=doc_id)
