"""Near-duplicate groups against all pairs of sets; components against union-find."""

import random
import re

import pytest

from tidemark.llm import near_dup
from tidemark.llm.components import components

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, size):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return frozenset([tuple(words)] if 0 < len(words) < size else [tuple(words[i : i + size]) for i in range(len(words) - size + 1)])


def groups(pairs, nodes):
    label = {n: n for n in nodes}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        label[b] = a
    return {n: top(n) for n in nodes}


def brute(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    pairs = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k] if a and b and 100 * len(a & b) >= percent * len(a | b)]
    return groups(pairs, {i for i, _ in sets})


def noisy(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10_000)}"
    return " ".join(words)


def corpus(prose):
    rng = random.Random(5)
    rows = [(i, prose(i, 80)) for i in range(30)]
    base = prose(99, 120).split()
    rows += [(100 + i, noisy(rng, base, i % 9)) for i in range(80)]  # one large group of near copies
    chain = prose(98, 200).split()
    for i in range(12):  # each near the one before only
        rows.append((300 - i, " ".join(chain)))
        chain = noisy(rng, chain, 4).split()
    rows += [(400 + i, rows[3][1]) for i in range(20)] + [(420, rows[3][1].upper()), (421, " \n" + rows[3][1].replace(" ", "\t\n"))]
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "One"), (505, "one two"), (506, "é a"), (507, "É a"), (508, prose(50, 20_000)), (509, prose(50, 20_000) + " end")]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (None, "no id")]
    return rows


@pytest.mark.parametrize(("size", "percent", "cluster"), [(3, 85, 1024), (3, 85, 16), (5, 80, 7)])
def test_equals_brute_force(make_docs, prose, monkeypatch, size, percent, cluster):
    monkeypatch.setattr(near_dup, "CLUSTER_ROWS", cluster)
    rows = corpus(prose)
    found = near_dup.near_duplicates(make_docs(rows, 5), size, percent).collect()
    assert len(found) == len(rows)
    wanted = brute(rows, size, percent)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (wanted[r.doc_id], wanted[r.doc_id] == r.doc_id)
    sizes = sorted((r.n_shingles for r in found))
    assert sizes == sorted(len(shingles(t, size)) for _, t in rows)


def test_repeated_ids_with_different_texts(make_docs, prose):
    """Rows follow their text; texts whose smallest id is the same count as one document."""
    a, b, c, d = (prose(i, 40) for i in range(4))
    rows = [(3, b), (5, a), (5, b), (9, a), (20, c), (20, d), (21, c), (22, d), (20, c)]
    found = sorted((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(make_docs(rows), 3, 85).collect())
    assert found == [(3, 3, True), (5, 3, False), (5, 5, True), (9, 5, False), (20, 20, True), (20, 20, True), (20, 20, True), (21, 20, False), (22, 20, False)]


def test_empty(make_docs):
    assert near_dup.near_duplicates(make_docs([])).collect() == []
    assert [tuple(r) for r in near_dup.near_duplicates(make_docs([(1, "a b")])).collect()] == [(1, 1, 1, True)]


def test_bounds_prune_only_the_unlikely():
    least = near_dup.least_agreement(0.85)
    assert list(least) == list(range(near_dup.BATCH, near_dup.HASHES + 1, near_dup.BATCH))
    assert all(0 < m < 0.85 * n for n, m in least.items())


def test_components(spark):
    rng = random.Random(6)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500 + i) for i in range(1, 50)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    wanted = groups(pairs, {x for p in pairs if p[0] != p[1] for x in p})
    assert {r.node: r.component for r in components(edges).collect()} == wanted
    assert components(edges.limit(0)).collect() == []
