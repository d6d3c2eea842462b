"""Token ids of whole texts.

A tokenizer that drops white space and never joins words across it gives a text the ids of its
words, one after the other. That is known of one way of normalising and cutting texts, which is
compared with that of the file; then each worker encodes a word once and looks it up afterwards.
With any other file it encodes whole texts.
"""

from __future__ import annotations

import json
import os
import string
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# The one kind of normalising and cutting whose words are known to stand alone. Texts
# are cut into letters, single digits and other signs, so an ASCII letter and a sign after it are cut
# apart too; other letters may end, once they are lower-cased, in a mark that joins the sign.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

BLANKS = " \t\n\r"
#: ASCII signs that begin a word after a letter: all but the one of contractions (and those in a file's added tokens).
SIGNS = string.punctuation.replace("'", "")
#: Letters below this code are Latin; none of them joins another one when it is normalised.
LATIN = 0x250
BLANK, SIGN, LETTER = 1, 2, 3

#: Words a worker remembers (about 200 bytes each); beyond it the memory starts afresh (same ids, more encoding).
MEMORY_WORDS = 800_000
#: Longer words are encoded but not remembered.
LONG_WORD = 64

_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of texts as little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Unsigned integers as this machine has them; all machines that Spark runs on put the low byte first.
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        with open(path, encoding="utf-8") as f:
            own = json.load(f)
        known = own["normalizer"] == NORMALIZER and own["pre_tokenizer"] == PRE_TOKENIZER
        self.by_word = known and self._same("it's 42 x", "it's", "42", "x") and self._same("É\n\té ,a  b", "É", "é", ",a", "b")
        added = [t["content"] for t in own["added_tokens"]]
        signs = [c for c in SIGNS if not any(c in t for t in added)]
        self.signs = "".join(signs) if self.by_word and all(self._same(f"Word{c}s", "Word", f"{c}s") for c in signs) else ""
        self.kinds = np.zeros(256, "u1")
        for kind, those in ((BLANK, BLANKS), (SIGN, self.signs), (LETTER, string.ascii_letters)):
            self.kinds[list(those.encode())] = kind
        self.tokenize = self.tokenizer.model.tokenize
        self.spelling = self._spelling() if self.by_word else {}
        self.letters = frozenset(map(chr, self.spelling))
        probe = ["the", "tokenization", "onhaworewhstting", "ÉTÉß"]
        if any(self.letters.issuperset(t) for t in added) or not all(self._ids([w])[0] == self._of_letters(w) for w in probe):
            self.letters = frozenset()
        self.memory, self.limit = _Memory(self), MEMORY_WORDS

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _same(self, whole: str, *parts: str) -> bool:
        found = self._ids([whole, *parts])
        return found[0] == [i for x in found[1:] for i in x]

    def _spelling(self) -> dict[int, str]:
        """How the file spells Latin letters for its model, for those that it never cuts off from other letters."""
        normalize, cut = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
        found = {c: [piece for piece, _ in cut(normalize(f"a{chr(c)}a"))] for c in range(LATIN) if chr(c).isalpha()}
        return {c: pieces[0][1:-1] for c, pieces in found.items() if len(pieces) == 1}

    def _of_letters(self, word: str) -> list[int]:
        return [t.id for t in self.tokenize(word.translate(self.spelling))]

    def word(self, word: str) -> bytes:
        """Ids of one word. Words of Latin letters alone need no normalising or cutting, they go straight to the model."""
        if word and self.letters.issuperset(word):
            return array(self.code, self._of_letters(word)).tobytes()
        return array(self.code, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def one(self, token_id: int) -> bytes:
        return array(self.code, [token_id]).tobytes()

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of each text; none for null or empty texts.

        Arrow finds the different words of all texts given, so that each is looked up once.
        """
        texts = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        if not self.by_word:
            return [array(self.code, ids).tobytes() for ids in self._ids(texts.to_pylist())]
        if len(self.memory) > self.limit:
            self.memory.clear()
        words, first = self._words(texts)
        if not len(words):
            return [b""] * len(texts)
        found = words.dictionary_encode()
        different = pc.ascii_rtrim(found.dictionary, BLANKS).to_numpy(zero_copy_only=False)
        ids = pa.array(list(map(self.memory.__getitem__, different)), pa.large_binary()).take(found.indices)
        ends, raw = np.frombuffer(ids.buffers()[1], "<i8")[first].tolist(), ids.buffers()[2].to_pybytes()
        return [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def _words(self, texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
        """Texts cut after blanks and between ASCII letters and signs, and how many words come before each text and its end."""
        if not len(texts) or not texts.buffers()[2]:
            return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
        ends = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
        text = np.frombuffer(texts.buffers()[2], "u1")[ends[0] : ends[-1]]
        kinds, begins = self.kinds[text], np.zeros(len(text) + 1, bool)
        begins[1:] = kinds == BLANK
        begins[1:-1] |= (kinds[1:] == SIGN) & (kinds[:-1] == LETTER)
        begins[ends - ends[0]] = True
        bounds = np.flatnonzero(begins)
        words = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(text))
        return words, np.searchsorted(bounds, ends - ends[0])


class _Memory(dict):
    """Ids of the words seen; unknown words are encoded when they are looked up, without the signs they end in and in small letters."""

    def __init__(self, own: Encoder) -> None:
        self.own = own

    def __missing__(self, word: str) -> bytes:
        own, base, low = self.own, word.rstrip(self.own.signs), word.lower() if word.isascii() else word
        if base and base != word and own.letters.issuperset(base):
            ids = self[base] + self[word[len(base) :]]
        elif low != word and own.letters.issuperset(word):
            ids = self[low]
        else:
            ids = own.word(word)
        if len(word) <= LONG_WORD:
            self[word] = ids
        return ids


def encoder(path: str, memory_words: int = MEMORY_WORDS) -> Encoder:
    """The worker's encoder for a file, kept between its tasks; it remembers about so many words."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    _encoders[path].limit = memory_words
    return _encoders[path]


def crc32_of_ids(ids: bytes, width: int) -> int:
    """crc32 of ids written as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids if width == 4 else np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())
