"""Language of whole texts: script ranges, per-word scores, and Viterbi spans.

What is learned are counts, over all learning documents, of the hashed character n-grams of the
words of each language (a table of fixed size), and of the letters of each script. Words are cut
where their letters change to another script, so text without blanks can be mixed. A word may only
be of a language that uses its script; among these its score is the log probability of its
n-grams. A switching penalty makes the best labelling of a text one of spans, found by Viterbi
search over all words; the texts of a batch take each step together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import segment_ids, slices, table
from tidemark.llm.quality import remainder
from tidemark.llm.text_bytes import Hashes

GRAMS = (2, 3, 4)
BUCKETS = 1 << 16
#: Added to every count; weight of a gram's log probability (grams overlap); cost of another language.
SMOOTH, WEIGHT, SWITCH = 0.5, 0.5, 12.0
#: A language uses a script if this share of its letters is of it. Score of a word in another script.
LEAST_SCRIPT, FOREIGN = 0.01, -60.0
UNKNOWN = "und"
#: Bytes of text whose words are scored and searched together: longer batches need fewer steps.
SLICE = 4 << 20

# First code points of blocks of scripts (Unicode), and the script from there on.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
]
NAMES = sorted({name for _, name in SCRIPTS})
_FIRST = np.array([code for code, _ in SCRIPTS])
_SCRIPT = np.array([NAMES.index(name) for _, name in SCRIPTS])


_SAME = {NAMES.index("kana"): NAMES.index("han")}  # written together within a word
_OTHER = NAMES.index("other")


@lru_cache(1 << 16)
def _letter_script(sign: str) -> int:
    """Script of a letter; -1 for what is no letter, or a letter of no one script."""
    kind = int(_SCRIPT[np.searchsorted(_FIRST, ord(sign), side="right") - 1])
    return _SAME.get(kind, kind) if sign.isalpha() and kind != _OTHER else -1


def _by_script(word: str) -> list[str]:
    """The word in pieces of one script; signs and digits stay with the letters before them."""
    pieces, start, own = [], 0, -1
    for i, sign in enumerate(word):
        kind = _letter_script(sign)
        if kind >= 0 and kind != own:
            if own >= 0:
                pieces.append(word[start:i])
                start = i
            own = kind
    return [*pieces, word[start:]]


class Words:
    """The words with letters of a batch of texts: the different ones, and which each text has.

    Words without letters count too if they have two characters of ``signs``. With ``cut``, a word
    ends where its letters change to another script.
    """

    def __init__(self, column: pa.Array, signs: str = "", cut: bool = False) -> None:
        lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(column, "").cast(pa.large_string())))
        encoded = lists.flatten().dictionary_encode()
        indices = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        all_words = encoded.dictionary.to_pylist()
        good = np.array([w.isalpha() or any(map(str.isalpha, w)) or (signs != "" and sum(c in signs for c in w) > 1) for w in all_words], bool)
        self.words = [w for w, g in zip(all_words, good) if g]
        number = np.cumsum(good) - 1
        has = good[indices] if len(indices) else np.zeros(0, bool)
        self.index = number[indices[has]] if len(indices) else np.zeros(0, np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(has)])[offsets] if len(indices) else np.zeros(len(column) + 1, np.int64)
        if cut:
            self._cut()
        self.length = np.array([len(w) for w in self.words], np.int64)

    @cached_property
    def script(self) -> np.ndarray:
        """The script of each word: that of its largest code point, so ASCII signs in it do not count."""
        codes = np.frombuffer("".join(self.words).encode("utf-32-le"), np.uint32)
        start = np.concatenate([[0], np.cumsum(self.length)])
        kind = _SCRIPT[np.searchsorted(_FIRST, codes, side="right") - 1]
        order = np.lexsort((codes, segment_ids(start)))
        return kind[order[start[1:] - 1]] if len(self.words) else np.zeros(0, np.int64)

    def _cut(self) -> None:
        """Part words of several scripts; each occurrence becomes as many words as there are parts."""
        parts = [[w] if w.isascii() else _by_script(w) for w in self.words]
        size = np.array([len(p) for p in parts], np.int64)
        if size.max(initial=1) == 1:
            return
        first, times = np.cumsum(size) - size, size[self.index]
        ends = np.concatenate([[0], np.cumsum(times)])
        inside = np.arange(ends[-1]) - np.repeat(ends[:-1], times)
        self.words = [w for p in parts for w in p]
        self.index, self.offsets = np.repeat(first[self.index], times) + inside, ends[self.offsets]

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of each n-gram (with the word's ends) and the word it is of, in order of words."""
        data = np.frombuffer((" " + "  ".join(self.words) + " ").encode(), np.uint8) if self.words else np.zeros(0, np.uint8)
        size = np.array([len(w.encode()) + 2 for w in self.words], np.int64)
        start = np.concatenate([[0], np.cumsum(size)])
        owner = segment_ids(start)
        hashes = Hashes(data)
        found, of = [], []
        for n in GRAMS:
            gram = hashes.windows(n)
            inside = np.arange(len(gram)) + n <= start[owner[: len(gram)] + 1]
            found.append((gram[inside] >> np.uint64(48)).astype(np.int64))
            of.append(owner[: len(gram)][inside])
        found, of = np.concatenate(found), np.concatenate(of)
        order = np.argsort(of, kind="stable")
        return found[order], of[order]


def learn(docs: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per language: counts of n-gram buckets and of letters by script, over all rows.

    A task adds up its own counts and sends one row for each language and bucket; the result has
    as many numbers as there are languages and buckets, whatever the size of the corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text", SLICE):
            words = Words(batch.column("text"), cut=True)
            bucket, of = words.grams()
            langs = batch.column("lang").to_pylist()
            owner = np.array(langs, object)[segment_ids(words.offsets)]
            for lang in set(langs):
                times = np.bincount(words.index[owner == lang], minlength=len(words.words)).astype(float)
                own = total.setdefault(lang, np.zeros(BUCKETS + len(NAMES)))
                own[:BUCKETS] += np.bincount(bucket, times[of], BUCKETS)
                own[BUCKETS:] += np.bincount(words.script, times * words.length, len(NAMES))
        for lang, own in sorted(total.items()):
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at])], ["lang", "at", "n"])

    counted = docs.select("text", "lang").mapInArrow(count, "lang string, at int, n double")
    rows = counted.groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()
    found = {}
    for lang, group in rows.groupby("lang"):
        own = np.zeros(BUCKETS + len(NAMES))
        own[group["at"].to_numpy()] = group["n"].to_numpy()
        found[lang] = own[:BUCKETS], own[BUCKETS:]
    return found


def viterbi(index: np.ndarray, offsets: np.ndarray, scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of each word: the sum of the words' scores, less ``switch`` for each change.

    ``scores`` has a row for each different word. All texts take a step together, longest first.
    """
    kind = np.min_scalar_type(scores.shape[1])
    labels = np.zeros(len(index), kind)
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    start, longest = offsets[:-1][order], int(size.max(initial=0))
    active = np.searchsorted(-size[order], -np.arange(1, longest + 1), side="right")  # texts with a word at each step
    moved, before = np.zeros((len(index), scores.shape[1]), bool), np.zeros(len(index), kind)
    value = np.zeros((len(size), scores.shape[1]))
    for t in range(longest):
        n = active[t]
        at, own = start[:n] + t, value[:n]
        if t:
            best = own.max(axis=1) - switch
            before[at] = own.argmax(axis=1)
            moved[at] = best[:, None] > own
            np.maximum(own, best[:, None], out=own)
        own += scores[index[at]]
    state = value.argmax(axis=1).astype(kind)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = start[:n] + t
        labels[at] = state[:n]
        state[:n] = np.where(moved[at, state[:n]], before[at], state[:n])
    return labels


def identify(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``lang_pred``, ``score`` and ``spans``.

    ``known`` has ``text`` and ``lang`` of the documents to learn from; null languages are left
    out. ``lang_pred`` has the most letters in the text's spans (the first by name among equals),
    ``score`` is its share of them. Null texts and texts without a letter are ``und`` with score 0
    and no spans, and so is everything if nothing could be learned. ``spans`` lists language,
    first word (of those with letters, cut at changes of script) and number of words. Every row gives a row.
    """
    learned = learn(known.filter("lang is not null and text is not null"))
    langs = sorted(learned)
    logs = np.zeros((BUCKETS, len(langs)), np.float32)
    allowed = np.zeros((len(NAMES), len(langs)), bool)
    for k, lang in enumerate(langs):
        grams, letters = learned[lang]
        logs[:, k] = WEIGHT * np.log((grams + SMOOTH) / (grams.sum() + SMOOTH * BUCKETS))
        allowed[:, k] = letters >= LEAST_SCRIPT * max(1.0, letters.sum())
    model = docs.sparkSession.sparkContext.broadcast((langs, logs, allowed))  # 256 KB for each language

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logs, allowed = model.value
        for batch in slices(batches, "text", SLICE):
            n = batch.num_rows
            if not langs:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([UNKNOWN] * n), pa.array(np.zeros(n)), pa.array([[]] * n, spans_type)], names)
                continue
            words = Words(batch.column("text"), cut=True)
            bucket, of = words.grams()
            scores = np.zeros((len(words.words), len(langs)), np.float64)
            first = np.searchsorted(of, np.arange(len(words.words)))
            for k in range(len(langs)):
                scores[:, k] = np.add.reduceat(logs[bucket, k], first) if len(first) else 0
            able = allowed[words.script] if len(words.script) else np.zeros((0, len(langs)), bool)
            scores[~able & able.any(axis=1)[:, None]] += FOREIGN
            label = viterbi(words.index, words.offsets, scores)
            owner, letters = segment_ids(words.offsets), words.length[words.index]
            share = np.bincount(owner * len(langs) + label.astype(np.int64), letters, n * len(langs)).reshape(n, len(langs))
            total = share.sum(axis=1)
            best = share.argmax(axis=1)
            new = np.ones(len(label), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (label[1:] != label[:-1])
            at = np.flatnonzero(new)
            fields = [pa.array([langs[x] for x in label[at]], pa.string()), pa.array((at - words.offsets[owner[at]]).astype(np.int32)), pa.array(np.diff(np.append(at, len(label))).astype(np.int32))]
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[at], np.arange(n + 1)).astype(np.int32)), pa.StructArray.from_arrays(fields, ["lang", "first", "words"]))
            pred = [langs[b] if t else UNKNOWN for b, t in zip(best, total)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(share[np.arange(n), best] / np.maximum(total, 1)), lists], names)

    names = ["doc_id", "lang_pred", "score", "spans"]
    spans_type = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(predict, "doc_id long, lang_pred string, score double, spans array<struct<lang: string, first: int, words: int>>")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their language, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    learning: Column = remainder("doc_id", 3) != 1
    found = identify(docs, docs.filter(learning).select("text", "lang"))
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
