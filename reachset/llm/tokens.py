"""Encoding whole texts with a public tokenizer file, one worker-wide cache.

For tokenizers whose pre-tokenizer drops white space (the default
``word_bpe_49k.json``), a text's ids are those of its blank-separated chunks
put together, so each distinct chunk goes to the tokenizers library once per
worker.  Plain words, with or without punctuation after them, go to the
library's model alone, after the lower-casing and byte spelling that its
normalizer and pre-tokenizer would do; every other chunk goes through the
whole library.  The caches are bounded: at ``max_entries`` they start anew; a
chunk is kept from the second time on.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np
import pandas as pd

#: Chunks, and words, that a worker remembers (about 200 bytes each).
MAX_ENTRIES = 400_000
#: Chunks that must come out alike on both ways, or the shorter one is not used.
_PROBES = ("the", "Word,", "École", "straßen.", "añadió!?", "xqzvkj", "A.$%", "ÜBERMÄßIG", "œuvre")
#: A word and ASCII punctuation, without the apostrophe.
_PLAIN = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_spelling() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: itself if printable, else the next from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in shown else chr(next(spare)) for b in range(256)}


class _Known(dict):
    """Entries made when first asked for."""

    def __init__(self, make, max_entries: int):
        super().__init__()
        self.make, self.max_entries = make, max_entries

    def __missing__(self, key):
        if len(self) >= self.max_entries:
            self.clear()
        self[key] = value = self.make(key)
        return value


class _Repeated(_Known):
    """Entries kept from the second time on, so that those asked for once do not use them up.

    ``marks`` has a byte for each slot of hashes; it starts anew at a quarter of the slots."""

    SLOTS = 1 << 22

    def __init__(self, make, max_entries: int):
        super().__init__(make, max_entries)
        self.marks, self.marked = bytearray(self.SLOTS), 0

    def __missing__(self, key):
        value = self.make(key)
        slot = hash(key) % self.SLOTS
        if self.marks[slot]:
            if len(self) >= self.max_entries:
                self.clear()
            self[key] = value
            return value
        if self.marked >= self.SLOTS // 4:
            self.marks, self.marked = bytearray(self.SLOTS), 0
        self.marks[slot] = 1
        self.marked += 1
        return value


class ChunkEncoder:
    """Texts to little-endian uint32 ids, as bytes."""

    def __init__(self, path: str, max_entries: int = MAX_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # of bytes read as Latin-1, and of ids
        self.spelling = {b: ord(c) for b, c in byte_spelling().items()}
        most = max(self.tokenizer.get_vocab().values(), default=-1)
        self.packed = [i.to_bytes(4, "little") for i in range(most + 1)]
        self.words = _Known(self._word, max_entries)
        self.chunks = _Repeated(self._chunk, max_entries)
        self.plain = all(self._plain(p) == self._whole(p) for p in _PROBES)

    def _whole(self, chunk: str) -> bytes:
        ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.spelling)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(word)])

    def _plain(self, chunk: str) -> bytes | None:
        """A Latin word's ids, and those of punctuation after it; None for other chunks."""
        found = _PLAIN.fullmatch(chunk)
        if not found:
            return None
        word, mark = found.groups()
        if not word.isascii() and (not word.isalpha() or max(word) > "ſ" or "İ" in word):
            return None
        ids = self.words[word.lower()]
        return ids + self.words[mark] if mark else ids

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        ids = self._plain(text) if self.plain else None
        return self._whole(text) if ids is None else ids

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """One entry per text; a null text is empty."""
        chunk = self.chunks.__getitem__
        return [b"".join(map(chunk, t.encode().split())) if t else b"" for t in texts]


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """This worker's encoder for the file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def slices(batches: Iterable[pd.DataFrame], text: str, max_chars: int = 4_000_000):
    """Batches cut so that each holds about ``max_chars`` of text at most (one row at least)."""
    for batch in batches:
        weight = batch[text].str.len().fillna(0).astype("int64").cumsum() // max_chars
        for _, part in batch.groupby(weight, sort=True):
            yield part
