"""Token ids by the tokenizers library, a bounded store of known chunks beside it.

The byte-level pre-tokenizer splits a text at white space the same way whatever
stands around a chunk (an optional space and a run of other characters, or
white space alone), so a chunk's ids don't depend on its context. A chunk that
isn't known yet goes to the library: to its BPE model directly if it is a word
with punctuation behind it, which are two pieces whatever the word, else to the
whole tokenizer.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np

# The white space of the pre-tokenizer's pattern.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CHUNK = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable in Latin-1, else the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


#: Marks that form one piece behind a word. An apostrophe may begin a contraction, so it isn't one.
MARKS = ".,;:!?%&*$#)]}\"-"


class Known(dict):
    """Chunks and their ids; a chunk that isn't there is encoded, and kept while there is room."""

    def __init__(self, encode, most: int):
        self.encode, self.most = encode, most

    def __missing__(self, chunk: str):
        ids = self.encode(chunk)
        if len(self) < self.most and len(chunk) <= 64:
            self[chunk] = ids
        return ids


class ByteLevelEncoder:
    """definition: the JSON text of a byte-level BPE tokenizer with the usual pattern."""

    def __init__(self, definition: str, known_chunks: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parsed = json.loads(definition)
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        #: Without the usual pre-tokenizer the library encodes whole texts.
        self.by_chunk = parsed["normalizer"] is None and usual.items() <= (parsed["pre_tokenizer"] or {}).items()
        self.special = [t["content"] for t in parsed["added_tokens"]]
        wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype, self.code = np.dtype("<u4" if wide else "<u2"), "I" if wide else "H"
        self.piece = self.tokenizer.model.tokenize
        self.letters = dict(enumerate(byte_letters()))
        self.known = Known(self._chunk, known_chunks)

    def _packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _library(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _chunk(self, chunk: str) -> bytes:
        word = chunk.rstrip(MARKS)
        if not (word[1:] if word[:1] == " " else word).isalpha():
            return self._library(chunk)
        ids = [t.id for t in self.piece(word.encode().decode("latin-1").translate(self.letters))]
        if len(word) < len(chunk):
            ids += [t.id for t in self.piece(chunk[len(word) :])]
        return self._packed(ids)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Each text's ids, packed in self.dtype; a null text has none."""
        look = self.known.__getitem__
        for text in texts:
            if not text:
                yield b""
            elif self.by_chunk and not any(s in text for s in self.special):
                yield b"".join(map(look, CHUNK.findall(text)))
            else:
                yield self._library(text)


_encoders: dict[int, ByteLevelEncoder] = {}


def encoder(definition: str) -> ByteLevelEncoder:
    """This worker's encoder, kept from task to task."""
    key = hash(definition)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = ByteLevelEncoder(definition)
    return _encoders[key]
