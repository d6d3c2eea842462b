"""Repeats against all windows of all texts, and the interval tree against all substrings."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from tidemark.llm import repeats


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    found = []
    for (doc_id, _), t in zip(rows, texts):
        covered = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                covered[p : p + length] = b"\1" * length
        kept = bytes(b for b, c in zip(t, covered) if not c)
        runs = len(bytes(covered).replace(b"\0", b" ").split())
        found.append((doc_id, len(t), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return found


def corpus(prose):
    rng = random.Random(8)
    passage, other = prose(1, 40), prose(2, 60)
    rows = [(i, prose(10 + i, 20) + " " + passage[rng.randrange(30) :] + " " + prose(50 + i, 15)) for i in range(30)]
    rows += [(100 + i, other[: 60 + 11 * i]) for i in range(12)] + [(200 + i, prose(300 + i, 30)) for i in range(10)]
    rows += [(250 + i, rows[2][1]) for i in range(5)] + [(260, "short copy"), (261, "short copy"), (262, "ab" * 400), (263, "c" * 700), (264, "é" * 130)]
    twice = prose(77, 30)
    rows += [(270, twice + " x " + twice), (271, None), (272, ""), (273, prose(78, 8000)), (274, other + "\0" + passage)]
    rows += [(rows[3][0], rows[3][1]), (rows[4][0], prose(90, 30)), (None, passage + "!"), (None, passage + "!")]
    return rows


@pytest.mark.parametrize(("length", "gram", "group_rows"), [(200, 64, 20_000), (50, 16, 20_000), (50, 16, 4), (60, 50, 7)])
def test_equals_brute_force(make_docs, prose, monkeypatch, length, gram, group_rows):
    monkeypatch.setattr(repeats, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(repeats, "CHUNK_ROWS", max(2, group_rows // 2))
    rows = corpus(prose)
    found = repeats.drop_repeats(make_docs(rows, 4), length, gram).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows, length), key=key)


def test_empty(make_docs):
    assert repeats.drop_repeats(make_docs([])).collect() == []


def test_intervals_are_the_tree():
    words = sorted(["banana", "bandana", "ban", "bananas", "can", "cane", "dog"])
    shared = [0, *(repeats.common(a.encode(), b.encode()) for a, b in zip(words, words[1:]))]
    found = {(n, words[a][:n], b - a + 1) for n, a, b in repeats.intervals(shared)}
    having = defaultdict(set)
    for w in words:
        for n in range(1, len(w) + 1):
            having[w[:n]].add(w)
    # A node is a prefix of several words that no longer prefix has all of.
    wanted = {(len(p), p, len(ws)) for p, ws in having.items() if len(ws) > 1 and not any(q != p and q.startswith(p) and having[q] == ws for q in having)}
    assert found == wanted


def test_repeats_are_maximal_and_whole():
    rng = random.Random(9)
    anchor = "ANCHOR"
    before = ["".join(rng.choices("ab", k=rng.randint(0, 6))) for _ in range(25)]
    after = [anchor + "".join(rng.choices("xy", k=rng.randint(0, 6))) for _ in range(25)]
    found = {(left, right, tuple(sorted(m))) for left, right, m in repeats.repeats([b[::-1].encode() for b in before], [a.encode() for a in after], 8)}
    having = defaultdict(set)
    for i, (b, a) in enumerate(zip(before, after)):
        for left in range(len(b) + 1):
            for right in range(len(anchor), len(a) + 1):
                if left + right >= 8:
                    having[b[len(b) - left :], a[:right]].add(i)
    wanted = set()
    for (b, a), who in having.items():
        longer = [k for k in having if k != (b, a) and k[0].endswith(b) and k[1].startswith(a) and having[k] == who]
        if len(who) > 1 and not longer:
            wanted.add((len(b), len(a), tuple(sorted(who))))
    assert found == wanted
