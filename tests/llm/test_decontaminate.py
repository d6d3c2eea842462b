"""Decontamination: planted passages with substitutions, clean texts, and the seeds themselves."""

import itertools

import numpy as np
import pyarrow as pa

from tidemark.llm import decontaminate as dc


def test_masks_hit_any_two_substitutions():
    for wrong in itertools.combinations(range(dc.WINDOW), 2):
        places = [(m, s) for m in dc.MASKS for s in range(dc.WINDOW - len(m) + 1)]
        assert any(all(m[p - s] == "0" for p in wrong if 0 <= p - s < len(m)) for m, s in places)


def test_word_hashes_ignore_case_and_signs():
    hashed, offsets = dc.word_hashes(pa.array(["The (cat), sat -- Éte!", "the cat sat éte", None, "...", "it's"]))
    assert offsets.tolist() == [0, 4, 8, 8, 8, 9] and hashed[:4].tolist() == hashed[4:8].tolist()


def test_overlap_by_hand():
    item = np.arange(20, dtype=np.uint64)
    doc = np.concatenate([np.full(5, 99, np.uint64), item, np.full(3, 98, np.uint64)])
    assert dc.overlap(doc, item, 5) == (5, 20, 20)
    doc[8], doc[12] = 77, 77
    assert dc.overlap(doc, item, 5) == (5, 20, 18)
    assert dc.overlap(doc, item, 4) == (0, 0, 0)
    assert dc.overlap(item[:14], item, 0) == (0, 14, 14)
    assert dc.overlap(item[:12], item, 0) == (0, 0, 0)
    assert dc.overlap(item[:6], item[:6], 0) == (0, 6, 6)


def test_planted_passages(spark, make_docs, prose):
    items = [(i, prose(1000 + i, 14 + i)) for i in range(20)] + [(30, "five words are the item"), (31, None), (32, ""), (None, prose(1100, 20)), (2, prose(1002, 16))]
    rows, dirty = [], set()
    for k, (i, text) in enumerate(items[:20]):
        words = text.split()
        words[4], words[9] = "changed", "words"
        rows += [(100 + k, prose(k, 30) + ". " + text.upper() + ", " + prose(200 + k, 20)), (200 + k, prose(300 + k, 10) + "\n" + " ".join(words))]
        dirty |= {(100 + k, i), (200 + k, i)}
        rows.append((300 + k, prose(400 + k, 40) + " " + " ".join(words[:10])))  # too little of it
    rows += [(500, "so five words are the item."), (501, "five words are an item"), (502, items[23][1]), (503, None), (504, ""), (505, prose(9, 30_000)), (100, rows[0][1]), (None, items[4][1])]
    dirty |= {(500, 30), (502, None), (102, 2), (202, 2)}
    docs, benchmark = make_docs(rows), spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, seed string")
    found = dc.contaminated(docs, benchmark)
    kept = dc.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    bad = {i for i, _ in dirty}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted((i for i, t in rows if i not in bad and i is not None), key=str)
    from pyspark.sql import functions as F

    pairs = docs.select("doc_id", F.xxhash64("text").alias("text_key")).join(found, "text_key").select("doc_id", "item_id").distinct().collect()
    assert {(r.doc_id, r.item_id) for r in pairs if r.doc_id is not None} == dirty


def test_empty(spark, make_docs):
    items = spark.createDataFrame([(1, "some words of a test item that is long enough to be looked for")], "item_id long, text string")
    assert dc.contaminated(make_docs([]), items).collect() == []
    assert dc.decontaminate(make_docs([(1, "a")]), items.limit(0)).count() == 1


def plain_overlap(doc, item):
    """Longest accepted stretch over all shifts, word by word: (first word, words, equal words)."""
    size, best = min(dc.WINDOW, len(item)), (0, 0, 0)
    needed = 11 if size == dc.WINDOW else size
    for shift in range(-len(item) + 1, len(doc)):
        pairs = {k: doc[shift + k] == item[k] for k in range(len(item)) if 0 <= shift + k < len(doc)}
        starts = [k for k in pairs if k + size - 1 in pairs and sum(pairs[k + j] for j in range(size)) >= needed]
        runs = []
        for k in starts:
            if runs and k - runs[-1][-1] <= size:
                runs[-1].append(k)
            else:
                runs.append([k])
        for run in runs:
            equal = [k for k in range(run[0], run[-1] + size) if pairs[k]]
            best = max(best, (equal[-1] - equal[0] + 1, len(equal), -(shift + equal[0])))
    return (-best[2], best[0], best[1]) if best[0] else None


def test_equals_brute_force(spark, make_docs, prose):
    """Every text against every item at every shift; items share a template, so many hits must be refused."""
    rng = np.random.default_rng(3)
    pool, template = prose(1, 400).split(), prose(2, 9).split()
    items = [(i, template + pool[20 * i : 20 * i + 4 + i]) for i in range(16)] + [(20, pool[:5]), (21, pool[100:112]), (22, pool[50:90])]
    docs = []
    for k in range(60):
        words = [str(w) for w in rng.choice(pool[300:], 20)]
        own = list(items[k % len(items)][1])
        for at in rng.choice(len(own), min(len(own), k % 4), replace=False):
            own[at] = "other"
        cut = int(rng.integers(0, 4))
        docs.append((k, words[:k % 7] + own[cut:] + words[7:] + (template if k % 3 else own)))
    found = dc.contaminated(make_docs([(i, " ".join(w)) for i, w in docs]), spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string"))
    keys = {r.text_key: r.doc_id for r in make_docs([(i, " ".join(w)) for i, w in docs]).selectExpr("xxhash64(text) AS text_key", "doc_id").collect()}
    wanted = {(i, j): o for i, w in docs for j, v in items if (o := plain_overlap(w, v))}
    assert 40 < len(wanted) < len(docs) * len(items) / 2
    assert {(keys[r.text_key], r.item_id): (r.first_word, r.n_words, r.n_equal) for r in found.collect()} == wanted
