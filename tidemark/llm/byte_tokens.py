"""Byte-level BPE of whole texts, word by word, with remembered words.

The words of a byte-level tokenizer take the space before them along, so a text may be cut before any space that a letter,
a digit or another printable sign follows: no word reaches across, whatever stands before the space. Pieces are encoded
once and remembered, new ones many at a time as one text that is cut again by the lengths of its tokens. The result
is that of the tokenizers library on the whole text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

import numpy as np

HELD_WORDS = 300_000     # of the newer half of the memory; the older half holds as many at most
LONGEST_HELD = 64        # characters; longer pieces are encoded each time
_LEARN = 4_000
_CUT = re.compile(r" (?=[\w!-~])")


def byte_signs() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable ones as they are, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    signs = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        signs[chr(256 + n)] = b
    return signs


class ByteEncoder:
    """A byte-level tokenizer of the tokenizers library; one per worker process, file and reading of special tokens."""

    _loaded: dict[tuple[str, bool], ByteEncoder] = {}

    def __init__(self, path: str, special_as_text: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = special_as_text
        if self._ids(["a b  c"]) != [[i for w in ("a", " b", " ", " c") for i in self._ids([w])[0]]]:
            raise ValueError("this tokenizer does not keep the space before a word with it")
        signs, added = byte_signs(), self.tokenizer.get_added_tokens_decoder()
        self.tokens = [added[i].content.encode() if i in added
                       else bytes(signs[c] for c in self.tokenizer.id_to_token(i) or "")
                       for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str, special_as_text: bool) -> ByteEncoder:
        if (path, special_as_text) not in cls._loaded:
            cls._loaded[path, special_as_text] = cls(path, special_as_text)
        return cls._loaded[path, special_as_text]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str], known: dict[str, bytes]) -> None:
        for at in range(0, len(new), _LEARN):
            part = new[at:at + _LEARN]
            ids = np.array(self._ids([" " + " ".join(part)])[0], "<u4")
            ends = np.cumsum([len(w.encode()) + 1 for w in part])
            cut = np.searchsorted(np.cumsum(self.lengths[ids]), ends, "left") + 1
            raw, begin = ids.tobytes(), 0
            for w, end in zip(part, cut.tolist(), strict=True):
                known[w] = raw[4 * begin:4 * end]
                begin = end

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text, little-endian, 32 bits each."""
        pieces = [_CUT.split(t) for t in texts]
        heads = [np.array(i, "<u4").tobytes() for i in self._ids([p[0] for p in pieces])]
        if len(self.words) > HELD_WORDS:
            self.older, self.words = self.words, {}
        known, new, long = self.words, [], []
        for w in {w for p in pieces for w in p[1:]}:
            if w not in known:
                ids = self.older.get(w)
                if ids is not None:
                    known[w] = ids
                else:
                    (new if len(w) <= LONGEST_HELD else long).append(w)
        self._learn(new, known)
        self._learn(long, known)
        out = [h + b"".join([known[w] for w in p[1:]]) for h, p in zip(heads, pieces, strict=True)]
        for w in long:
            del known[w]
        return out
