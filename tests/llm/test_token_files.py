"""Token files against the tokenizer itself, file by file and id by id."""

import json
import random
import string
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_files
from tidemark.llm.packing import best_fit, first_prices, fractional, knapsack, pack, plan, rounded, solve
from tidemark.llm.tokens import TOKENIZER, Encoder

plain = Tokenizer.from_file(TOKENIZER)
MARKS = ".,!?;:"


def ids_of(text, end):
    return [*plain.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def edge_rows(prose):
    return [
        (5, prose(1, 50)), (3, None), (4, ""), (9, " \n\t "), (7, prose(2, 9000)), (6, "It's don't <|endoftext|>. ÉTÉ\x1cx y"),
        (2, prose(3, 40)), (2, prose(3, 40)), (2, "another text"), (None, "no id"), (8, "z" * 5000),
    ]


def test_encoder_equals_tokenizer(prose):
    own = Encoder(TOKENIZER)
    texts = ["Don't stop, İstanbul ΟΔΟΣ. I'LL 12.5%", "", None, "a  b\r\n\tc", "日本 語。 ẞ ﬁ Å̊ x́", "<|startoftext|>B<|endoftext|>!", prose(4, 3000)]
    for _ in range(2):  # the second time from memory
        for text, found in zip(texts, own.encode(texts)):
            assert np.frombuffer(found, f"<u{own.width}").tolist() == ids_of(text, 0)[:-1]


def test_any_letter_before_any_mark():
    """Every letter and combining mark of Unicode before marks, digits and special tokens."""
    letters = [chr(c) for c in range(0x20, 0x30000) if unicodedata.category(chr(c))[0] in "LM"]
    rng = random.Random(9)
    texts = [f"{a}{c}{rng.choice(MARKS)} {c.upper()}{rng.choice(MARKS)}{rng.choice('aZ9')}{rng.choice(MARKS)}" for c in letters for a in rng.sample("xÉ1", 1)]
    texts += ["".join(rng.choices(letters[:600] + list(MARKS) + [" ", "<|endoftext|>", "'s", "\u0307"], k=8)) for _ in range(20_000)]
    assert len(texts) > 100_000
    own = Encoder(TOKENIZER)
    assert own.by_word
    wanted = plain.encode_batch_fast(texts, add_special_tokens=False)
    assert [np.frombuffer(f, f"<u{own.width}").tolist() for f in own.encode(texts)] == [w.ids for w in wanted]


def test_any_sign_beside_letters():
    """Signs, Latin letters, marks, blanks and added tokens in any order, as slices of an Arrow column."""
    rng = random.Random(11)
    latin = [chr(c) for c in range(0xC0, 0x250)]
    parts = [*string.printable, *latin, *"aZé'<|>", "word", "'s", "<|endoftext|>", "\u0301", "\u0338", "\u0307", "$$$", " ", "\x1c", "\xa0", "\u1fef", "한", "Σ"]
    texts = [None, "", *("".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(40_000)), "", None]
    texts += [f"{a}{b}{c}" for a in "xZé" for b in string.punctuation for c in (*string.punctuation, "x", "É", " ", "7", "\u0338")]
    own, column = Encoder(TOKENIZER), pa.array(texts)
    found = [ids for start in range(0, len(texts), 7_000) for ids in own.encode(column.slice(start, 7_000))]
    wanted = plain.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
    assert own.by_word and own.signs and len(own.letters) > 400
    assert [np.frombuffer(f, f"<u{own.width}").tolist() for f in found] == [w.ids for w in wanted]
    fresh = Encoder(TOKENIZER)
    assert fresh.encode([]) == [] and fresh.encode([" "]) == [b""] and fresh.encode([None, "", "\n"]) == [b""] * 3 and fresh.encode(column[:2]) == [b"", b""]


def test_different_words_are_encoded_once(monkeypatch):
    """op1_token_files: signs after a word, capitals and letters beyond ASCII neither repeat nor lengthen the encoding."""
    own, seen = Encoder(TOKENIZER), []
    of_word = own.word
    monkeypatch.setattr(own, "word", lambda word: seen.append(word) or of_word(word))
    texts = ["Onwhing$$$ onwhing, naïve.", None, "onwhing### naïve, Onwhing naïve\tonwhing."]
    found = [np.frombuffer(f, f"<u{own.width}").tolist() for f in own.encode(texts)]
    assert found == [ids_of(text, 0)[:-1] for text in texts]
    assert sorted(seen) == sorted(["onwhing", "naïve", "$$$", "###", ",", "."])
    monkeypatch.setattr(own, "tokenizer", None)  # the model alone
    assert np.frombuffer(of_word("ÀNaïve"), f"<u{own.width}").tolist() == ids_of("ànaïve", 0)[:-1]


def test_other_tokenizers_read_whole_texts(tmp_path):
    with open(TOKENIZER, encoding="utf-8") as f:
        changed = json.load(f)
    changed["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = "[^,]+|,"
    (tmp_path / "t.json").write_text(json.dumps(changed))
    own, other = Encoder(str(tmp_path / "t.json")), Tokenizer.from_file(str(tmp_path / "t.json"))
    assert not own.by_word
    for text, found in zip(texts := ["a b, c", None, "x y"], own.encode(texts)):
        assert np.frombuffer(found, f"<u{own.width}").tolist() == other.encode(text or "", add_special_tokens=False).ids


def test_files_and_digest(spark, make_docs, prose, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 20_000)
    rows = edge_rows(prose)
    manifest = token_files.write_token_files(make_docs(rows), str(tmp_path))
    assert len(manifest["shards"]) > 1
    wanted = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    flat = [ids_of(text, 1) for _, text in wanted]
    stored = [np.fromfile(tmp_path / f"{s['name']}.bin", f"<u{manifest['width']}") for s in manifest["shards"]]
    assert np.concatenate(stored).tolist() == [i for ids in flat for i in ids]
    assert json.loads((tmp_path / "manifest.json").read_text()) == manifest
    found = sorted(token_files.read_token_files(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    starts = np.cumsum([0, *map(len, flat)])
    assert [tuple(r) for r in found] == [(d, s, len(i), crc(i)) for (d, _), s, i in zip(wanted, starts.tolist(), flat)]


def test_empty_table(spark, make_docs, tmp_path):
    token_files.write_token_files(make_docs([]), str(tmp_path))
    assert token_files.read_token_files(spark, str(tmp_path)).collect() == []
    assert pack(make_docs([])).collect() == []


def test_pack_is_whole_and_gapless(make_docs, prose):
    rows = edge_rows(prose)
    found = pack(make_docs(rows), capacity=256, with_ids=True).collect()
    wanted = []
    for doc_id, text in rows:
        ids = ids_of(text, 0)
        wanted += [(doc_id, n, s, len(ids[s : s + 256]), crc(ids[s : s + 256])) for n, s in enumerate(range(0, len(ids), 256))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=key) == sorted(wanted, key=key)
    assert all(len(r.ids) == 2 * r.length for r in found)
    ends = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 256 and len(ends) <= -(-sum(ends.values()) // 256) + 1


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(3)
    lengths = np.clip(rng.lognormal(5, 1, 30_000).astype(int), 1, 512)
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    found = plan(counts, 512)
    held = {}
    for configuration, sequences in found:
        assert sum(n * k for n, k in configuration) <= 512
        for n, k in configuration:
            held[n] = held.get(n, 0) + k * sequences
    assert held == counts
    bound = -(-int(lengths.sum()) // 512)
    assert bound <= sum(s for _, s in found) <= 1.002 * bound + 1


def test_parts_of_the_plan():
    prices = np.full(11, -np.inf)
    prices[[3, 7, 4]] = [3.0, 8.0, 4.5]
    assert knapsack(prices, 10)[10] == 11.0
    assert sum(best_fit([6, 6, 4, 4], 10).values()) == 2
    served = {}
    for configuration, share in fractional({6: 50, 4: 50}, 10).items():
        for n, k in configuration:
            served[n] = served.get(n, 0) + k * share
    assert all(served[n] <= 50 + 1e-6 for n in (4, 6))
    assert plan({}, 10) == [] and plan({10: 3}, 10) == [(((10, 1),), 3)]


def test_program_places_nearly_all_of_many_lengths():
    rng = np.random.default_rng(4)
    lengths = np.concatenate([np.clip(rng.lognormal(5.8, 1.2, 900_000).astype(int), 1, 2048), rng.integers(1, 2049, 100_000)])
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    assert len(counts) == 2048
    placed = sum(k * s for configuration, s in fractional(counts, 2048).items() for _, k in configuration)
    assert placed >= 0.95 * len(lengths)
    found = plan(counts, 2048)
    held = {}
    for configuration, sequences in found:
        assert sum(n * k for n, k in configuration) <= 2048
        for n, k in configuration:
            held[n] = held.get(n, 0) + k * sequences
    assert held == counts
    assert sum(s for _, s in found) <= 1.0005 * -(-int(lengths.sum()) // 2048)


def test_best_fit_of_counts():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 65, 5_000).tolist()
    rooms = []
    for length in sorted(lengths, reverse=True):  # one piece at a time
        fit = min((r for r in rooms if r >= length), default=None)
        if fit is not None:
            rooms.remove(fit)
        rooms.append((64 if fit is None else fit) - length)
    found = best_fit({n: lengths.count(n) for n in set(lengths)}, 64)
    assert sorted(64 - sum(n * k for n, k in c) for c, s in found.items() for _ in range(s)) == sorted(rooms)


HARD = {
    "halves": ({1026: 70_000, 700: 70_000, 350: 70_000, 148: 70_000}, 2048),
    "thirds": ({501: 700, 342: 700, 171: 700, 72: 700}, 1000),
    "mixed": ({51: 6000, 27: 6000, 26: 6000, 23: 12_000}, 100),
}


def all_configurations(lengths, capacity):
    if not lengths:
        return [()]
    first, rest = lengths[0], lengths[1:]
    return [((first, k), *c) if k else c for k in range(capacity // first + 1) for c in all_configurations(rest, capacity - k * first)]


@pytest.mark.parametrize("name", HARD)
def test_program_has_a_small_gap(name):
    counts, capacity = HARD[name]
    found = solve(counts, capacity)
    assert 0 <= found.gap <= 0.01
    whole = rounded(found.x, counts, capacity)
    assert sum(whole.values()) <= min(1.01 * found.dual + len(counts), sum(best_fit(counts, capacity).values()))
    served = {n: sum(dict(c).get(n, 0) * s for c, s in whole.items()) for n in counts}
    assert served == counts


def test_bound_holds_for_every_configuration():
    """Prices are checked against all configurations, shares against what they serve."""
    rng = np.random.default_rng(8)
    for _ in range(8):
        lengths = sorted(rng.choice(np.arange(12, 60), 5, replace=False).tolist())
        counts = {n: int(rng.integers(1, 400)) for n in lengths}
        demand = np.array([counts[n] for n in lengths], float)
        every = all_configurations(lengths, 100)
        price = dict(zip(lengths, first_prices(np.array(lengths), demand, 100)))
        assert max(sum(price[n] * k for n, k in c) for c in every) <= 1 + 1e-9
        found = solve(counts, 100)
        assert found.dual <= found.primal + 1e-6
        served = {n: sum(dict(c).get(n, 0) * s for c, s in found.x.items()) for n in lengths}
        assert all(served[n] <= counts[n] + 1e-6 for n in lengths)
        assert sum(rounded(found.x, counts, 100).values()) <= sum(best_fit(counts, 100).values())
        assert sum(rounded(found.x, counts, 100).values()) <= 1.02 * found.dual + len(lengths)


def test_halves_of_many_lengths_are_bounded():
    rng = np.random.default_rng(0)
    lengths, times = np.unique(rng.integers(700, 2049, 100_000), return_counts=True)
    assert solve(dict(zip(lengths.tolist(), times.tolist())), 2048).gap <= 0.01


def test_small_tables_use_the_program():
    rng = np.random.default_rng(2)
    lengths, times = np.unique(np.clip(rng.lognormal(5.5, 1, 1_000).astype(int), 1, 2048), return_counts=True)
    counts = dict(zip(lengths.tolist(), times.tolist()))
    found = solve(counts, 2048)
    placed = sum(k * int(s + 1e-6) for c, s in found.x.items() for _, k in c)
    assert placed >= 0.95 * sum(counts.values()) and found.gap <= 0.01
