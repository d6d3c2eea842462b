"""Toxicity of texts, after undoing leetspeak, spacing and repetition.

The noisy channel: what was meant is a string of letters, likely under a character trigram model
counted over all documents; what is seen has signs for letters, signs or spaces between letters,
and letters repeated, each at a cost. Runs of text that look so are turned into a lattice of what
each character may stand for, and Viterbi search finds the cheapest reading. The restored text is
scored by the log odds of the character 5-grams of its words, counted over labelled documents,
and boosted trees over the few highest of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import segment_ids, slices, stored, table
from tidemark.llm.filters import id_filter, in_filter
from tidemark.llm.language import Words
from tidemark.llm.quality import grow, remainder
from tidemark.llm.text_bytes import Hashes, utf8

# Letters that the character model tells apart, and the signs that stand for letters.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "<": "c", "^": "a", "#": "h",
}
BETWEEN = " .-_*~'"

#: Costs of the channel: a sign for a letter, a sign without meaning, a separator, one that ends a word, a letter twice and more often.
AS_LETTER, NO_MEANING, SEPARATOR, BREAK, DOUBLED, REPEATED = 0.7, 12.0, 0.2, 3.0, 4.0, 0.5
#: A sign without meaning at the start or end of a run, and one that usually stands there.
AT_EDGE, USUAL = 6.0, 1.0
SMOOTH = 0.5
#: Longer runs are decoded like others, but not remembered.
REMEMBERED = 48
SIZE = len(LETTERS) + 2  # boundary first, any other letter last
_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
_CODES = np.full(0x110000, SIZE - 1, np.int64)
for _c, _i in _CODE.items():
    _CODES[ord(_c)] = _i

_SIGN = "".join(map(re.escape, SIGNS))
#: A word that may be in disguise has a sign or a letter more than once in a row. Where each such
#: letter is there twice and none follows another, it is dropped or not by its neighbours alone.
_DISGUISED = re.compile(rf"[{_SIGN}]|([^\W\d_])\1")
_DOUBLE = re.compile(r"([^\W\d_])\1")
_LATTICE = re.compile(rf"[{_SIGN}]|([^\W\d_])\1(?:\1|([^\W\d_])\2)")
#: Single letters or signs with separators between them, four or more.
_SPACED = re.compile(rf"(?<![\w{_SIGN}])(?:[^\W_]|[{_SIGN}])(?:[ .\-_*~']{{1,2}}(?:[^\W_]|[{_SIGN}])(?![\w{_SIGN}])){{3,}}")
#: Separators two wide, which end words in a run that also has narrower ones.
_WIDE = re.compile(r"[ .\-_*~']{2}")
_MARKS = ".,;:!?\"'()[]{}"
#: Marks that stand for no letter, and all that can stand at the edge of a run without meaning.
_PLAIN_MARKS = "".join(c for c in _MARKS if c not in SIGNS)
_EDGE = "".join(SIGNS) + _PLAIN_MARKS
_USUAL_FIRST, _USUAL_LAST = "(<¡$£€#", "!"
#: Two of these make a word without letters one that may be in disguise; digits alone are numbers.
_SHAPES = "".join(c for c in SIGNS if not c.isdigit())

GRAM, BUCKETS = 5, 1 << 18
#: Labelled rows from which the trees are grown, at most.
TRAIN_ROWS = 40_000
TOP = 3
THRESHOLD = 0.5


def letter_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter trigrams (with word ends) over the words of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            times = np.bincount(words.index, minlength=len(words.words))
            text = "".join(f"\0\0{w}\0" for w in words.words)
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            kinds = np.where(codes == 0, 0, _CODES[codes])
            owner = segment_ids(np.concatenate([[0], np.cumsum(words.length + 3)]))
            if len(kinds):
                inside = owner[:-2] == owner[2:]
                triple = (kinds[:-2] * SIZE + kinds[1:-1]) * SIZE + kinds[2:]
                total += np.bincount(triple[inside], times[owner[:-2]][inside], SIZE**3).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["at", "n"])

    rows = docs.select("text").mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    found = np.zeros(SIZE**3)
    found[rows["at"].to_numpy()] = rows["n"].to_numpy()  # at most SIZE ** 3 rows
    return found.reshape(SIZE, SIZE, SIZE)


def letter_costs(counts: np.ndarray) -> np.ndarray:
    """Minus log probability of a letter after two others, smoothed by shorter contexts."""
    one = (counts.sum(axis=(0, 1)) + SMOOTH) / (counts.sum() + SMOOTH * SIZE)
    pair = counts.sum(axis=0)
    two = (pair + 5 * one) / (pair.sum(axis=1, keepdims=True) + 5)
    three = (counts + 5 * two[None]) / (counts.sum(axis=2, keepdims=True) + 5)
    return -np.log(three)


class Restorer:
    """Cheapest readings of disguised runs under a table of letter costs."""

    def __init__(self, costs: np.ndarray) -> None:
        self.costs = costs
        self.remembered = lru_cache(200_000)(self._decode)
        # What a letter twice costs more than once, by the letter before, itself and the one after.
        twice = np.einsum("pxx->px", costs)[:, :, None] + np.einsum("xxn->xn", costs)[None]
        self.once = twice - costs > DOUBLED

    def decode(self, run: str) -> str:
        """The cheapest reading of a run."""
        return self.remembered(run) if len(run) <= REMEMBERED else self._decode(run)

    def _options(self, run: str) -> list[list[tuple[str, float]]]:
        found = []
        first, last = len(run) - len(run.lstrip(_EDGE)), len(run.rstrip(_EDGE))
        apart = len(run) > 6 and run[1] in BETWEEN
        for i, c in enumerate(run):
            edge = i < first or i >= last
            if c in SIGNS:
                nothing = NO_MEANING
                if i > 1 and run[i - 2 : i] == c + c or edge and not c.isdigit() and c * 3 in run[max(0, i - 2) : i + 3]:
                    nothing = REPEATED
                elif edge and not c.isdigit():
                    nothing = USUAL if c in (_USUAL_FIRST if i < first else _USUAL_LAST) else AT_EDGE
                found.append([(x, AS_LETTER) for x in SIGNS[c]] + [("", nothing)])
            elif c in BETWEEN:
                found.append([("", SEPARATOR), (" ", BREAK)] if c == " " or apart else [("", SEPARATOR)])
            elif edge:
                found.append([("", 0.0)])
            elif i and run[i - 1] == c:
                found.append([(c, 0.0), ("", REPEATED if i > 1 and run[i - 2] == c else DOUBLED)])
            else:
                found.append([(c, 0.0)])
        return found

    def _decode(self, run: str) -> str:
        costs, options = self.costs, self._options(run)
        # Letters before the first choice cost the same in all readings.
        sure = next((i for i, o in enumerate(options) if len(o) > 1 or o[0][0] != run[i]), len(run))
        codes = [0, 0, *(_CODE.get(c, SIZE - 1) for c in run[max(0, sure - 2) : sure])]
        # Readings share their beginnings: each is its last piece and the reading before.
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(codes[-2], codes[-1]): (0.0, None)}
        for choices in options[sure:]:
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, text) in states.items():
                for out, extra in choices:
                    if out == "":
                        key, total = (a, b), cost + extra
                    else:
                        c = 0 if out == " " else _CODE.get(out, SIZE - 1)
                        key, total = ((0, 0) if c == 0 else (b, c)), cost + extra + costs.item(a, b, c)
                    old = after.get(key)
                    if old is None or total < old[0]:
                        after[key] = (total, (text, out) if out else text)
            states = after
        text = min(((cost + costs.item(a, b, 0), k, text) for k, ((a, b), (cost, text)) in enumerate(states.items())), key=lambda f: f[:2])[2]
        read = []
        while text is not None:
            text, out = text
            read.append(out)
        return run[:sure] + "".join(reversed(read))

    def _double(self, found: re.Match) -> str:
        text, at, end = found.string, found.start(), found.end()
        before = _CODE.get(text[at - 1], SIZE - 1) if at else 0
        after = _CODE.get(text[end], SIZE - 1) if end < len(text) else 0
        return found.group(1) if self.once[before, _CODE.get(found.group(1), SIZE - 1), after] else found.group()

    def word(self, word: str) -> str:
        """A word in lower case, read anew if it may be in disguise."""
        return self._anew(word) if _DISGUISED.search(word) else word

    def _anew(self, word: str) -> str:
        plain = word.strip(_PLAIN_MARKS)
        return self.decode(plain) if _LATTICE.search(plain) else _DOUBLE.sub(self._double, plain)

    def spaced(self, text: str) -> str:
        """The text in lower case, each run of single letters replaced by its cheapest reading."""
        return _SPACED.sub(lambda m: self._run(m.group()), text.lower())

    def _run(self, run: str) -> str:
        parts = _WIDE.split(run)
        return self.decode(run) if max(map(len, parts)) == 1 else " ".join(map(self.decode, parts))

    def restore(self, text: str) -> str:
        return " ".join(map(self.word, self.spaced(text).split()))


def may_be_spaced(column: pa.Array) -> np.ndarray:
    """Texts with four single characters in a row between separators, told from their bytes."""
    data, offsets = utf8(column)
    apart = np.isin(data, np.frombuffer((BETWEEN + "\n\t\r").encode(), np.uint8))
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    inside = ~apart
    start = np.flatnonzero(inside & (np.concatenate([[True], apart[:-1]]) | first[:-1])[: len(data)])
    end = np.flatnonzero(inside & (np.concatenate([apart[1:], [True]]) | first[1:])[: len(data)]) + 1
    tails = np.concatenate([[0], np.cumsum((data & 0xC0) == 0x80)])  # bytes that continue a character
    single = end - start - (tails[end] - tails[start]) == 1
    found = np.zeros(len(offsets) - 1, bool)
    if len(single) > 3:
        owner = np.searchsorted(offsets, start, side="right") - 1
        four = single[:-3] & single[1:-2] & single[2:-1] & single[3:] & (owner[:-3] == owner[3:])
        found[owner[:-3][four]] = True
    return found


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each 5-gram of the different words (with their ends) and the word it is of."""
    if not words.words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    plain = [f" {w.strip(_MARKS)} ".encode() for w in words.words]
    data = np.frombuffer(b"".join(plain), np.uint8)
    size = np.array([len(w) for w in plain], np.int64)
    start = np.concatenate([[0], np.cumsum(size)])
    owner = segment_ids(start)
    gram = Hashes(data).windows(GRAM)
    inside = np.arange(len(gram)) + GRAM <= start[owner[: len(gram)] + 1]
    return (gram[inside] >> np.uint64(64 - 18)).astype(np.int64), owner[: len(gram)][inside]


def _restored(column: pa.Array, restorer: Restorer) -> Words:
    """The words of a batch of texts after restoring; each different word is looked at once."""
    spaced = np.flatnonzero(may_be_spaced(column))
    if len(spaced):
        texts = column.to_pylist()
        for i in spaced:
            texts[i] = restorer.spaced(texts[i])
        column = pa.array(texts, pa.string())
    words = Words(column, _SHAPES)
    disguised, anew = _DISGUISED.search, restorer._anew
    words.words = [anew(w) if disguised(w) else w for w in words.words]
    return words


def gram_counts(labelled: DataFrame, costs: np.ndarray) -> np.ndarray:
    """Labelled documents that have each bucket, by label and half, and in the last row their number."""
    shared = labelled.sparkSession.sparkContext.broadcast(costs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, total = Restorer(shared.value), np.zeros((4, BUCKETS + 1), np.int64)
        for batch in slices(batches, "text"):
            words = _restored(batch.column("text"), restorer)
            bucket, of = _grams(words)
            kind = batch.column("kind").to_numpy()
            total[:, BUCKETS] += np.bincount(kind, minlength=4)
            # Different words of each text, then different buckets of each text.
            pairs = np.unique(segment_ids(words.offsets) * max(1, len(words.words)) + words.index)
            doc, word = pairs // max(1, len(words.words)), pairs % max(1, len(words.words))
            first = np.searchsorted(of, np.arange(len(words.words) + 1))
            times = np.diff(first)[word]
            at = np.repeat(first[word] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum()) if len(word) else np.zeros(0, np.int64)
            both = np.unique(np.repeat(doc, times) * BUCKETS + bucket[at])
            total[:, :BUCKETS] += np.bincount(kind[both // BUCKETS] * BUCKETS + both % BUCKETS, minlength=4 * BUCKETS).reshape(4, BUCKETS)
        at = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(t[at]) for t in total)], ["at", "n0", "n1", "n2", "n3"])

    counted = labelled.select("text", "kind").mapInArrow(count, "at int, n0 long, n1 long, n2 long, n3 long")
    rows = counted.groupBy("at").agg(*(F.sum(f"n{k}").alias(f"n{k}") for k in range(4))).toPandas()
    found = np.zeros((4, BUCKETS + 1))
    found[:, rows["at"].to_numpy()] = rows[["n0", "n1", "n2", "n3"]].to_numpy().T
    return found


def evidence(clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Lower bounds (one standard error) of the log odds ratio of each bucket; none below zero."""
    odds = np.log((toxic[:-1] + 0.5) / (toxic[-1] + 1)) - np.log((clean[:-1] + 0.5) / (clean[-1] + 1))
    return np.maximum(odds - np.sqrt(1 / (toxic[:-1] + 0.5) + 1 / (clean[:-1] + 0.5)), 0).astype(np.float32)


def _highest(words: Words, bucket: np.ndarray, of: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Per text: its ``TOP`` highest word weights, the number of weighty words, and their share."""
    found = np.zeros((n, TOP + 2), np.float32)
    if not len(words.index) or not len(bucket):
        return found
    weight = np.zeros(len(words.words), np.float32)
    np.maximum.at(weight, of, weights[bucket])
    owner, good = segment_ids(words.offsets), weight[words.index] > 1
    pairs = np.unique(owner[good] * len(words.words) + words.index[good])
    doc, own = pairs // len(words.words), weight[pairs % len(words.words)]
    order = np.lexsort((-own, doc))
    doc, own = doc[order], own[order]
    rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
    for k in range(TOP):
        found[doc[rank == k], k] = own[rank == k]
    found[:, TOP] = np.bincount(owner[good], minlength=n)
    found[:, TOP + 1] = found[:, TOP] / np.maximum(np.diff(words.offsets), 1)
    return found


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` (of label 1) and ``predicted``.

    Labels of held-out documents (crc32 of the id divisible by five) are not learned from; null
    labels are left out, a document labelled twice counts with its highest label. Null and empty
    texts, and texts without weighty words, get the score of texts without any. Without labels of
    both kinds all scores are equal.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    costs = letter_costs(letter_counts(source)).astype(np.float32)
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    known = stored(known.filter(remainder("doc_id", 5) != 0).select(F.col("doc_id").alias("id"), "label", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")), "labels")
    able = in_filter(source.filter("doc_id is not null"), "doc_id", id_filter(known, "id"))
    labelled = able.join(known, F.col("doc_id") == F.col("id")).select("text", (F.col("label") * 2 + F.col("half")).alias("kind"))
    counts = gram_counts(labelled, costs)
    # Each half of the labelled documents is measured by the other half's weights when the trees
    # are grown; a score is the mean over both, so that it rests on measures of the same kind.
    weights = [evidence(counts[1], counts[3]), evidence(counts[0], counts[2])]
    model = docs.sparkSession.sparkContext.broadcast((costs, weights))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, weights = model.value
        restorer = Restorer(costs)
        for batch in slices(batches, "text"):
            n = batch.num_rows
            words = _restored(batch.column("text"), restorer)
            bucket, of = _grams(words)
            rows = np.concatenate([_highest(words, bucket, of, w, n) for w in weights], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "found"])

    measured = stored(source.mapInArrow(measure, "doc_id long, found array<float>"), "measured")
    own = F.when(F.col("half") == 0, F.slice("found", 1, TOP + 2)).otherwise(F.slice("found", TOP + 3, TOP + 2))
    sample = measured.join(known, F.col("doc_id") == F.col("id")).select(own.alias("x"), "label", F.xxhash64("doc_id").alias("h"), "doc_id")
    rows = sample.orderBy("h", "doc_id").limit(TRAIN_ROWS).select("x", "label").toPandas()
    x = np.array(rows["x"].tolist(), np.float32).reshape(len(rows), TOP + 2)
    trees = grow(x, rows["label"].to_numpy(float), trees=40, depth=3)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = batch.column("found").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                mean = (trees.probability(found[:, : TOP + 2]) + trees.probability(found[:, TOP + 2 :])) / 2
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(mean)], ["doc_id", "score"])

    scored = measured.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored for toxicity."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
