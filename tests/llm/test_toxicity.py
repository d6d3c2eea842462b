"""Toxicity: restored texts, held-out results, edge rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity as tox
from tidemark.llm.toxicity import Restorer, letter_costs, letter_counts, may_be_spaced, op5_toxicity, score_toxicity

CLEAN = "the garden and the house were quiet in the morning while people walked along the water"
RUDE = "you are a stupid idiot and a pathetic loser"


@pytest.fixture(scope="module")
def restorer(spark):
    docs = spark.createDataFrame([(CLEAN,), (RUDE,), (None,), ("",)] * 20, "text string")
    return Restorer(letter_costs(letter_counts(docs)))


@pytest.mark.parametrize(
    ("seen", "meant"),
    [("1d10t", "idiot"), ("st00pid idi0t", "stoopid idiot"), ("$tupid", "stupid"), ("stuuuupid", "stupid"), ("s t u p i d", "stupid"), ("l.o.s.e.r", "loser"), ("p4th3t1c", "pathetic"), ("The Garden", "the garden"), ("", "")],
)
def test_restores(restorer, seen, meant):
    assert restorer.restore(seen) == meant


def test_viterbi_is_cheapest(restorer):
    def cost(run, text, extra):
        codes = [0, 0, *(tox._CODE[c] for c in text), 0]
        return extra + sum(restorer.costs[a, b, c] for a, b, c in zip(codes, codes[1:], codes[2:]))

    found = restorer.decode("1d1")
    every = {("i" if a else "l") + "d" + ("i" if b else "l") for a in (0, 1) for b in (0, 1)}
    best = min(every, key=lambda t: cost("1d1", t, 2 * tox.AS_LETTER))
    assert found == best


def test_spaced_filter_misses_nothing():
    texts = ["a b c d", "x s t u p i d y", "a b c", "é.a.ü.o", None, "", "ab cd ef gh", "l-o-s-e", "in a b c d word", "1 d 1 0 t"]
    found = may_be_spaced(pa.array(texts))
    assert all(f or not tox._SPACED.search(t or "") for t, f in zip(texts, found))
    assert not found[[2, 4, 5, 6]].any()


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = op5_toxicity(spark, sf)
    rows = found.join(labels, "doc_id").withColumn("c", F.crc32(F.col("doc_id").cast("string").cast("binary"))).collect()
    assert all(r.held_out == (r.c % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.97


def test_edges(spark, make_docs):
    clean, rude = CLEAN.split(), RUDE.split()
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.permutation(clean)) + (" " + rude[3 + i // 2 % 2] if i % 2 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    rows += [(1000, CLEAN + " 5tup1d"), (1001, CLEAN + " s t u p i d"), (1002, CLEAN), (1003, None), (1004, ""), (1004, ""), (1005, "the water " * 20_000), (None, CLEAN)]
    found = score_toxicity(make_docs(rows), labels).collect()
    assert len(found) == len(rows)
    score = {r.doc_id: r.score for r in found}
    assert min(score[1000], score[1001]) > 0.5 > max(score[1002], score[1003], score[1004], score[1005])
    assert score_toxicity(make_docs([]), labels).collect() == []
    assert len({r.score for r in score_toxicity(make_docs(rows[:20]), labels.limit(0)).collect()}) == 1


@pytest.mark.parametrize("gap", [" ", "  "])
@pytest.mark.parametrize("times", [1, 40])
def test_restores_long_spaced_runs(restorer, gap, times):
    seen = gap.join(" ".join(w) for w in [*RUDE.split()] * times)
    found = restorer.restore(seen)
    assert len(seen) > 60 and found.replace(" ", "") == "".join(RUDE.split()) * times
    assert found.split() == RUDE.split() * times if gap == "  " else found.count("pathetic") == times


def test_restores_long_repetitions(restorer):
    assert restorer.restore("st" + "u" * 60 + "pid") == "stupid"
    assert len(restorer.restore("x1" * 50_000)) > 0  # linear in the run


@pytest.mark.parametrize(
    ("seen", "meant"),
    [("idi0+", "idiot"), ("stuupid", "stupid"), ("iidiott", "idiot"), ("!diot", "idiot"), ("idiot!", "idiot"), ("(idiot!)", "idiot"), ("morning!", "morning"), ("|0$3®".replace("®", "r"), "loser"), ("!d!0+", "idiot")],
)
def test_restores_signs_anywhere(restorer, seen, meant):
    assert restorer.restore(seen) == meant


def test_words_without_letters_count(restorer):
    found = tox._restored(pa.array(["the !|)!0+ !|!0+ 12 $5 2024 .", None, "..."]), restorer)
    assert len(found.words) == 3 and found.offsets.tolist() == [0, 3, 3, 3]


def test_isolated_doubles_are_read_as_by_the_lattice(restorer):
    for word in ["garden", "looser", "stuupid", "iidiott", "peoplee", "wwater", "house", "moorningg", "ééidiot", "xxyxx"]:
        assert restorer.word(word) == restorer._decode(word)


def test_scripts_are_not_looked_up(restorer):
    words = tox._restored(pa.array(["The garden 1d10t", None, "s t u p i d"]), restorer)
    assert words.words and "idiot" in words.words and "stupid" in words.words
    assert "script" not in vars(words)
