"""Language: held-out accuracy, spans of mixed texts, and Viterbi search against all labellings."""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm.language import NAMES, Words, identify, op2_language, viterbi


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(6, 3)) * 3
    sizes = [0, 1, 5, 6, 3]
    index = rng.integers(0, 6, sum(sizes))
    offsets = np.cumsum([0, *sizes])
    found = viterbi(index, offsets, scores, 2.0)

    def worth(words, labels):
        return sum(scores[w, k] for w, k in zip(words, labels)) - 2.0 * sum(a != b for a, b in zip(labels, labels[1:]))

    for a, b in zip(offsets[:-1], offsets[1:]):
        words = index[a:b]
        best = max((worth(words, x) for x in itertools.product(range(3), repeat=len(words))), default=0)
        assert np.isclose(worth(words, found[a:b].tolist()), best)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("c"))
    rows = op2_language(spark, sf).join(truth, "doc_id").collect()
    assert len(rows) == truth.count() and all(r.held_out == (r.c % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.lang]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def learned(spark):
    rows = [("the house and the garden of the people with water", "en"), ("das haus und der garten mit dem wasser für die leute", "de"), ("дом и сад людей с водой", "ru"), (None, "fr"), ("alone", None)]
    return spark.createDataFrame(rows * 30, "text string, lang string")


def test_mixed_texts_and_edges(spark, make_docs):
    mixed = "the house and the garden with the people " * 3 + "das haus und der garten mit dem wasser " * 3
    rows = [(1, mixed), (2, None), (3, ""), (4, "12 34 !!"), (5, "дом людей"), (6, "the water"), (6, "the water"), (None, "das haus"), (8, "the house " * 20_000)]
    found = sorted(identify(make_docs(rows), learned(spark)).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    assert [s.lang for s in by_id[1].spans] == ["en", "de"] and by_id[1].spans[1].first == 24
    for i in (2, 3, 4):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].spans) == ("und", 0.0, [])
    assert (by_id[5].lang_pred, by_id[6].lang_pred, by_id[None].lang_pred, by_id[8].lang_pred) == ("ru", "en", "de", "en")
    assert by_id[8].spans[0].words == 40_000 and by_id[8].score == 1.0


def test_nothing_learned_and_empty(spark, make_docs):
    nothing = spark.createDataFrame([], "text string, lang string")
    assert [r.lang_pred for r in identify(make_docs([(1, "words")]), nothing).collect()] == ["und"]
    assert identify(make_docs([]), learned(spark)).collect() == []


def test_many_languages(spark, make_docs):
    """More labels than fit into a byte."""
    rows = [(f"{a}{b}{a}{b}{a} {b}{b}{a}{a}{b} {a}{a}{a}{b}", f"l{i:03d}") for i, (a, b) in enumerate(itertools.islice(itertools.permutations("bcdfghjklmnpqrstvwxz", 2), 300))]
    known = spark.createDataFrame(rows * 3, "text string, lang string")
    found = {r.doc_id: r.lang_pred for r in identify(make_docs([(i, t) for i, (t, _) in enumerate(rows)]), known).collect()}
    assert [found[i] for i in range(300)] == [lang for _, lang in rows]


def test_viterbi_keeps_large_labels():
    scores = np.zeros((2, 300))
    scores[0, 299] = scores[1, 256] = 50.0
    assert viterbi(np.array([0, 1, 0]), np.array([0, 2, 3]), scores, 2.0).tolist() == [299, 256, 299]


def test_words_are_cut_where_the_script_changes(spark, make_docs):
    words = Words(pa.array(["helloпривет, мир abc123где!", None, "東京タワーへ été ét", "x" * 5 + "дом" * 2, "!!"]), cut=True)
    assert [[words.words[i] for i in words.index[a:b]] for a, b in itertools.pairwise(words.offsets)] == [
        ["hello", "привет,", "мир", "abc123", "где!"], [], ["東京タワーへ", "été", "ét"], ["xxxxx", "домдом"], []]
    assert [NAMES[k] for k in words.script[words.index[:2]]] == ["latin", "cyrillic"]
    text = "theгарден" + "houseдом" * 3 + "садлюдей"
    found = {r.doc_id: r for r in identify(make_docs([(1, "theпеопле"), (2, "thehouseandthegardenдомисадлюдейсводой"), (3, text), (4, None)]), learned(spark)).collect()}
    assert [(s.lang, s.first, s.words) for s in found[2].spans] == [("en", 0, 1), ("ru", 1, 1)]
    assert [s.lang for s in found[1].spans] == ["en", "ru"] and [s.lang for s in found[3].spans] == ["en", "ru"] * 4
    assert found[2].score == 20 / 38 and found[4].spans == []
