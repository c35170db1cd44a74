"""Byte-pair encoding and decoding for vocabularies with word ends.

A word's merging keeps two contiguous arrays: its parts, as ids between one
boundary and the next, and the ranks of adjacent parts. The ranks are scanned for the
least, the boundary within that pair is deleted, which makes one part of the two,
and the two neighbouring ranks are refreshed. Words
longer than LONG parts take a heap with the same order instead, as scanning
would grow with the square of their length.

Normalization and the split into words are this module's own too. Only texts with
characters that Python's Unicode tables don't know yet are normalized and
split by the tokenizers library, whose tables may be newer; their words are
merged here like all others.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from itertools import chain

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import tokenizer_file
from .tokens import MARKS, WHITE, Known, byte_letters

LONG = 200
NONE = 1 << 60


def unassigned() -> str:
    """A character class of the code points that Python's Unicode tables don't know."""
    runs: list[list[int]] = []
    for c in range(0x110000):
        if unicodedata.category(chr(c)) == "Cn":
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]"


class WordBPE:
    """definition: the JSON text of a tokenizer that normalizes, splits words and marks their ends."""

    def __init__(self, definition: str, known_chunks: int = 800_000):
        d = json.loads(definition)
        model, pre = d["model"], d["pre_tokenizer"]["pretokenizers"]
        steps = [n["type"] for n in d["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in pre] != ["Split", "ByteLevel"] or d["decoder"] is not None:
            raise ValueError("this isn't a word-end BPE of the kind supported here")
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        #: The rank of a pair of ids, and the id that a rank's merge gives.
        self.ranks = {(self.vocab[a], self.vocab[b]): i for i, (a, b) in enumerate(merges)}
        self.merged = [self.vocab[a + b] for a, b in merges]
        self.words = regex.compile(pre[0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.tokens = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for t, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = t
        self.decimals = [str(i) for i in range(len(self.tokens))]
        self.letters = byte_letters()
        self.newer, self.definition, self.library = re.compile(unassigned()), definition, None
        self.chunks = re.compile(f"[^{WHITE}]+")
        self.known = Known(self._chunk, known_chunks)

    def merge(self, word: str) -> list[int]:
        """The ids of a word of at least one character."""
        return self.merge_letters("".join(map(self.letters.__getitem__, word.encode("utf-8", "surrogatepass"))))

    def merge_letters(self, s: str) -> list[int]:
        """The same for a word whose bytes are letters already."""
        vocab, merged, get = self.vocab, self.merged, self.ranks.get
        parts = [vocab[c] for c in s[:-1]]
        parts.append(vocab[s[-1] + self.end])
        if len(parts) > LONG:
            return self._merge_long(parts)
        ranks = [get(pair, NONE) for pair in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < NONE:
            i = ranks.index(least)
            parts[i] = merged[least]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), NONE)
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        get = self.ranks.get
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(len(parts) - 1) if (r := get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = self.merged[rank], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] >= 0 and (r := get((parts[x], parts[after[x]]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[after[x]]))
        return [p for p in parts if p >= 0]

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        """The ids of a run without white space. Marks behind a word are a piece of their own."""
        word = chunk.rstrip(MARKS)
        if word.isalpha() and len(word) < len(chunk):
            return self.known[word] + self.known[chunk[len(word) :]]
        words = [chunk] if chunk.isalpha() else self.words.findall(chunk)
        return tuple(p for w in words for p in self.merge(w))

    def _newer(self, text: str) -> bool:
        """Whether a character isn't in Python's tables. Most texts are Latin-1, which is quickly told."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.newer.search(text) is not None
        return False

    def _library_words(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.definition)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]

    def encode(self, text: str | None) -> list[int]:
        """The text's ids; a null text has none. Special tokens' strings give their ids."""
        text, ids, look = text or "", [], self.known.__getitem__
        for i, piece in enumerate(self.at_special.split(text) if self.at_special and self.at_special.search(text) else [text]):
            if i % 2:
                ids.append(self.special[piece])
                continue
            if self._newer(piece):
                ids.extend(p for w in self._library_words(piece) for p in self.merge_letters(w))
                continue
            if not piece.isascii():
                # Lower-casing goes by character: no final sigma.
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
            ids.extend(chain.from_iterable(map(look, self.chunks.findall(piece.lower()))))
        return ids

    def decode(self, ids: list[int]) -> str:
        """The tokens, special ones included, joined by a space: this kind of tokenizer has no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


_coders: dict[int, WordBPE] = {}


def coder(definition: str) -> WordBPE:
    """This worker's coder, kept from task to task."""
    key = hash(definition)
    if key not in _coders:
        _coders.clear()
        _coders[key] = WordBPE(definition)
    return _coders[key]


OUTPUTS = {"ids": "array<int>", "decoded": "string", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}


def coded(docs: DataFrame, outputs: list[str], tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, *outputs) of each row: its whole text encoded, and those ids decoded again.

    outputs are of OUTPUTS: the ids and the decoded text themselves, or their
    count and digests (of the decimal ids joined by a space, and of the decoded
    UTF-8), so that large columns need not leave the worker. A null text
    counts as empty: no ids. Repeated rows and null ids stay; an empty table gives
    an empty result. Other columns are ignored.
    """
    with open(tokenizer or tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()
    unknown = set(outputs) - OUTPUTS.keys()
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")

    def run(batches):
        import pyarrow as pa

        types = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}
        bpe = coder(shared.value)
        of = {
            "ids": lambda ids, text: ids,
            "decoded": lambda ids, text: text,
            "n_tokens": lambda ids, text: len(ids),
            "ids_sha256": lambda ids, text: hashlib.sha256(" ".join(map(bpe.decimals.__getitem__, ids)).encode()).hexdigest(),
            "decoded_sha256": lambda ids, text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
        }
        for b in batches:
            columns = {o: [] for o in outputs}
            for text in b.column(1).to_pylist():
                ids = bpe.encode(text)
                decoded = bpe.decode(ids)
                for o in outputs:
                    columns[o].append(of[o](ids, decoded))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(columns[o], types.get(o, pa.string())) for o in outputs)], names=[id_col, *outputs])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{o} {OUTPUTS[o]}" for o in outputs))
