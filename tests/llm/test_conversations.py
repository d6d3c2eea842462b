"""Repaired conversations against a search through all edits and a plain dynamic program."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tidemark.llm import conversations as conv

KINDS = "conv_id long, turn long, role string, text string, name string, `key` string, kind int"
WHITE = " \t\n\v\f\r"


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        bare = text.strip(WHITE)
        found.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows, kinds):
    """Least cost, then least audit, by Dijkstra over (rows used, initials so far as a state)."""
    turn, user, assistant = {"": "u", "s": "u", "u": "a", "a": "u"}, ("user", ""), ("assistant", "")
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, made = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, made
        if (i, last) in done:
            continue
        done.add((i, last))
        nxt = turn[last]
        heapq.heappush(heap, (cost + 2, audit + "I", i, nxt, made + (user if nxt == "u" else assistant,)))
        if i == len(rows):
            continue
        role, text = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, made))
        if kinds[i] not in ("blank", "duplicate"):
            late = kinds[i] == "truncated"
            if role[:1] == nxt or (role[:1] == "s" and last == ""):
                heapq.heappush(heap, (cost + late, audit + "K", i + 1, role[:1], made + ((role, text),)))
            heapq.heappush(heap, (cost + late + 2, audit + "R", i + 1, nxt, made + (((user if nxt == "u" else assistant)[0], text),)))


def key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    """Expected rows, from damaged ones; ``rows`` has every conversation's id even if nothing is left."""
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in damaged(rows) if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], key(r[2], r[3])))
        turns = [r[1] for r in own if r[1] is not None]
        pairs = [(role, text) for _, _, role, text in own]
        kinds = faults(pairs)
        cost, audit, made = cheapest(pairs, kinds)
        initials = [r[:1] for r, _ in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[c] = (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
    return out


def found(df):
    pick = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    out = {r.conv_id: tuple(r[c] for c in pick) for r in rows}
    assert len(out) == len(rows)
    return out


def random_rows(seed, conversations=150, longest=12):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "unit"])
            text = rng.choice(["Yes.", "No", "No.", " \n", "", None, "Why?\t", "été!", " ", "x" * 3000, str(rng.random()) + "."])
            rows.append((rng.choice([c, c, c, 7, None]), rng.choice([t, t, t, None, -t, 5]), role, text))
    return rows + rows[:40]


@pytest.mark.parametrize("segment", [1, 3, 2048])
def test_equals_search(spark, segment):
    rows = random_rows(segment)
    df = spark.createDataFrame([(*r, "n", "k", 3) for r in rows], KINDS).repartition(5)
    assert found(conv.repaired_digests(conv.damage(df), segment)) == brute(rows)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(conv.op13_conversation_repair(spark, sf)) == brute(rows)


def test_one_conversation_with_many_turns(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"{t}.", f"{t}"])) for t in range(3000)] + [(2, 0, "user", "Hi.")]
    df = spark.createDataFrame([(*r, "n", "k", 3) for r in rows], KINDS).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    assert found(conv.repaired_digests(conv.damage(df), 64)) == brute(rows)


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "One."), (1, 1, "user", " "), (1, 2, "tool", "Two"), (1, 3, "user", "Three."), (2, None, None, None)]
    df = spark.createDataFrame([(*r, "n", "k", 3) for r in rows], KINDS)
    audits, repaired = conv.repair(df)
    assert {r.conv_id: (r.blank, r.truncated) for r in audits.collect()} == {1: (1, 1), 2: (1, 0)}
    made = sorted(map(tuple, repaired.collect()))
    pairs = [(r[2], r[3]) for r in rows[:4]]
    cost, audit, wanted = cheapest(pairs, faults(pairs))
    assert [(r[2], r[3]) for r in made if r[0] == 1] == list(wanted) and not [r for r in made if r[0] == 2]
    assert {r.conv_id: (r.cost, r.audit) for r in audits.collect()} == {1: (cost, audit), 2: (3, "D")}


def test_empty_table(spark):
    assert conv.repaired_digests(conv.damage(spark.createDataFrame([], KINDS))).collect() == []


def test_a_node_for_each_suffix():
    path, made = conv.Path(conv.Audits.root(1, conv.END_COSTS)), []
    before = conv.Audits.before
    words = sorted({bytes(random.Random(i).choices(b"ADGL", k=i % 7)) for i in range(300)})
    conv.Audits.before = lambda self, sign: made.append(1) or before(self, sign)
    try:
        for word in words:
            path.node(word)
    finally:
        conv.Audits.before = before
    assert len(made) == len({w[:n] for w in words for n in range(1, len(w) + 1)})
