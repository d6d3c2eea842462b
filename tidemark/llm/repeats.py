"""Repeated passages across a corpus: maximal repeats from sparse enhanced suffix arrays.

Only some suffixes are sorted. Each stretch of ``length`` bytes names one *anchor* in it, the
stretch of ``GRAM`` bytes with the smallest hash; equal stretches name the same anchor at the same
place. Suffixes that begin at anchors therefore suffice to find all repeats of that length.

1. Anchors of all texts are counted by hash; anchors that occur once are dropped.
2. The others are sent, with the bytes around them that stretches naming them can cover, to one
   task for each hash. It sorts the suffixes, computes common prefixes of neighbours and scans
   them with a stack, which yields the tree of common-prefix intervals. In each interval the texts
   before the anchors are compared as well: an interval whose suffixes can be extended to the left
   in different ways (or not at all) holds a maximal repeat, with all its occurrences.
3. Occurrences are merged by document.

Equal texts enter once. A hash with more than ``GROUP_ROWS`` anchors is split into chunks; what is
not repeated within a chunk is then matched across chunks by the hashes of single stretches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import mix64, segment_ids, slices, stored, table
from tidemark.llm.filters import id_filter, in_filter
from tidemark.llm.text_bytes import Hashes, utf8

LENGTH = 200
GRAM = 64
#: Anchors with one hash that meet in one task (each has up to 2 * LENGTH bytes); more are split into chunks.
GROUP_ROWS, CHUNK_ROWS = 20_000, 4_000
#: Bytes of text that a task works on at a time.
SLICE = 1 << 20


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """For each anchor: its hash, place, text, and the first and last start of the stretches naming it.

    Among equal hashes the leftmost is the anchor. Stretches lie within one text.
    """
    width = length - gram + 1
    hashes = Hashes(data).windows(gram)
    n = len(hashes) - width + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.astype(np.uint64), none, none, none, none
    ranked = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    padded = np.full(-(-len(ranked) // width) * width, np.uint64(2**64 - 1))
    padded[: len(ranked)] = ranked
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    least = np.minimum(ahead[:n], behind[width - 1 : width - 1 + n])
    owner = segment_ids(offsets)[:n]
    start = np.flatnonzero(np.arange(n) + length <= offsets[owner + 1])
    place = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(place)) - 1
    place = place[at] if len(place) else none
    return hashes[place], place, owner[start[at]] if len(at) else none, start[at], start[last] if len(at) else none


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (prefix, first, last) of a sorted array, children before parents.

    ``prefixes[i]`` is what entries ``i - 1`` and ``i`` share (the first is not looked at).
    """
    stack = [(0, 0)]
    for i in range(1, len(prefixes) + 1):
        own, first = (prefixes[i] if i < len(prefixes) else -1), i - 1
        while stack and stack[-1][0] > own:
            shared, first = stack.pop()
            if i - 1 > first and shared > 0:
                yield shared, first, i - 1
        if not stack or stack[-1][0] < own:
            stack.append((own, first))


def repeats(before: list[bytes], after: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats around anchors of one hash: bytes before it, bytes from it on, and who has it.

    ``before`` holds the bytes ahead of each anchor in reverse, ``after`` those from it on. Only
    repeats of at least ``length`` bytes are given, each with all its occurrences.
    """
    order = sorted(range(len(after)), key=after.__getitem__)
    shared = [0, *(common(after[i], after[j]) for i, j in zip(order, order[1:]))]
    for right, first, last in intervals(shared):
        members = order[first : last + 1]
        if right + max(len(before[i]) for i in members) < length:
            continue
        members.sort(key=before.__getitem__)
        left = [0, *(common(before[i], before[j]) for i, j in zip(members, members[1:]))]
        if right + max(left) < length and right < length:
            continue
        kinds = list(intervals(left))
        if not kinds or min(left[1:]) == 0:
            kinds.append((0, 0, len(members) - 1))  # differ, or begin, right at the anchor
        for extended, low, high in kinds:
            if extended + right < length:
                continue
            group = members[low : high + 1]
            # Right-maximal: some member leaves the others, or ends, after ``right`` bytes.
            if len(group) < len(members) and _share_more(group, after, right):
                continue
            yield extended, right, group


def _share_more(group: list[int], after: list[bytes], right: int) -> bool:
    texts = [after[i] for i in group]
    return common(min(texts), max(texts)) > right


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _groups(rows: Iterator[tuple], width: int) -> Iterator[list[tuple]]:
    """Consecutive rows with equal first ``width`` values."""
    group: list[tuple] = []
    for row in rows:
        if group and row[:width] != group[0][:width]:
            yield group
            group = []
        group.append(row)
    if group:
        yield group


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            _, once = np.unique(batch.column("text_key").to_numpy(), return_index=True)
            batch = batch.take(pa.array(np.sort(once)))  # copies within a slice
            data, offsets = utf8(batch.column("text"))
            hash_, place, owner, _, _ = anchors(data, offsets, length, gram)
            key = batch.column("text_key").to_numpy()[owner]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hash_.view(np.int64)), pa.array(key), pa.array((place - offsets[owner]).astype(np.int32))], ["hash", "text_key", "place"]
            )

    return texts.select("text_key", "text").mapInArrow(find, "hash long, text_key long, place int")


def _surroundings(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Candidate anchors of each text with the bytes around them.

    Equal surroundings within a slice of rows are sent once; the others are marked as repeated.
    """
    names = ["hash", "chunk", "doc_id", "place", "low", "high", "before", "after", "repeated", "split"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            data, offsets = utf8(batch.column("text"))
            raw = data.tobytes()
            hash_, place, owner, first, last = anchors(data, offsets, length, gram)
            wanted = batch.column("places").to_pylist()
            chunks = {(i, w["place"]): w["chunks"] for i, own in enumerate(wanted) for w in own}
            ids, rows, seen = batch.column("doc_id").to_pylist(), [], {}
            local = place - offsets[owner]
            salt = mix64(batch.column("text_key").to_numpy().view(np.uint64)[owner] + local.astype(np.uint64))
            for h, p, o, f, t, s, q in zip(hash_.view(np.int64).tolist(), place.tolist(), owner.tolist(), first.tolist(), last.tolist(), salt.tolist(), local.tolist()):
                split = chunks.get((o, q))
                if split is None:
                    continue
                start, end = int(offsets[o]), int(offsets[o + 1])
                before, after = raw[max(start, p - length + gram) : p][::-1], raw[p : min(end, p + length)]
                twin = seen.setdefault((before, after), len(rows))
                rows.append([h, s % split if split > 1 else 0, ids[o], q, p - t, p - f, before, after, twin != len(rows), split > 1])
                if twin < len(rows) - 1:
                    rows[twin][8] = True
            # Of equal surroundings the first is sent whole, the others as occurrences only.
            firsts = set(seen.values())
            for i, row in enumerate(rows):
                if i not in firsts:
                    row[6] = row[7] = None
            columns = list(zip(*rows)) or [()] * 10
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return texts.mapInArrow(cut, "hash long, chunk long, doc_id long, place int, low int, high int, before binary, after binary, repeated boolean, split boolean")


def _runs(offsets: list[tuple[int, int]]) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for low, high in sorted(offsets):
        if found and low <= found[-1][1] + 1:
            found[-1] = found[-1][0], max(high, found[-1][1])
        else:
            found.append((low, high))
    return found


def _scan(rows: DataFrame, length: int) -> DataFrame:
    """Per anchor the stretches that are repeated, as ranges of bytes before the anchor.

    Of split hashes, stretches come as well, for matching across chunks: those not repeated in
    their chunk, and one of each kind that is (``low`` is null for that one).
    """
    names = ["hash", "chunk", "doc_id", "place", "low", "high", "before", "after", "split"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for group in _groups(_rows(batches, names), 2):
            before, after = [r[6] for r in group], [r[7] for r in group]
            found: list[list[tuple[int, int]]] = [[] for _ in group]
            for left, right, members in repeats(before, after, length) if len(group) > 1 else ():
                for i in members:
                    low, high = max(group[i][4], length - right), min(group[i][5], left)
                    if low <= high:
                        found[i].append((low, high))
            own = [_runs(f) for f in found]
            out += [(r[2], r[3], low, high, None) for r, runs in zip(group, own) for low, high in runs]
            for row in _across(group, own, length) if group[0][8] else ():
                out.append(row)
                if len(out) > 10_000:
                    yield batch_of(out)
                    out = []
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "place", "low", "high", "stretch"])

    dealt = rows.repartition("hash", "chunk").sortWithinPartitions("hash", "chunk")
    return dealt.mapInArrow(scan, "doc_id long, place int, low int, high int, stretch binary")


def _across(group: list[tuple], own: list[list[tuple[int, int]]], length: int) -> Iterator[tuple]:
    kinds = set()
    for (_, _, doc_id, place, low, high, before, after, _), runs in zip(group, own):
        whole, at = before[::-1] + after, len(before)
        for o in range(low, high + 1):
            stretch = hashlib.blake2b(whole[at - o : at - o + length], digest_size=16, key=o.to_bytes(4, "big")).digest()
            if not any(a <= o <= b for a, b in runs):
                yield doc_id, place, o, o, stretch
            elif stretch not in kinds:
                kinds.add(stretch)
                yield doc_id, place, None, None, stretch


def repeated_spans(texts: DataFrame, firsts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id`` and ``spans`` (start, end), the bytes that repeated stretches cover.

    ``texts`` has ``own_id``, ``text_key`` (a 64-bit hash of the text) and ``text``; equal texts
    count once. ``firsts`` has a row for each text: ``text_key`` and ``first_id``, the ``own_id``
    of the row that stands for it. ``doc_id`` of the result is the text's key.
    """
    all_anchors = stored(_anchor_rows(texts, length, gram), "anchors")
    own = F.xxhash64("text_key", "place")
    counted = all_anchors.groupBy("hash").agg(F.min(own).alias("least"), F.max(own).alias("most"), F.count(F.lit(1)).alias("n"))
    chunks = F.when(F.col("n") > GROUP_ROWS, F.ceil(F.col("n") / CHUNK_ROWS)).otherwise(1).cast("int")
    # Written first: the join then shuffles both sides anew, and AQE can split a hot hash.
    twice = stored(counted.filter("least <> most").select("hash", chunks.alias("chunks")), "repeated-anchors")
    wanted = all_anchors.join(twice, "hash").groupBy("text_key", "place").agg(F.max("chunks").alias("chunks"))
    wanted = stored(wanted.groupBy("text_key").agg(F.collect_list(F.struct("place", "chunks")).alias("places")), "candidates")

    # Joined by key and row, so that copies, which may be a third of all rows, do not meet.
    able = in_filter(texts.select("own_id", "text_key", "text"), "text_key", id_filter(wanted, "text_key"))
    named = wanted.join(firsts, "text_key").select(F.col("text_key").alias("key"), "first_id", "places")
    one = able.join(named, (able["text_key"] == named["key"]) & able["own_id"].eqNullSafe(named["first_id"]))
    around = stored(_surroundings(one.select(F.col("text_key").alias("doc_id"), "text_key", "text", "places"), length, gram), "surroundings")
    hot = not wanted.filter(F.exists("places", lambda p: p["chunks"] > 1)).isEmpty()
    found = stored(_scan(around.filter("before is not null"), length), "repeats")
    spans = found.filter("stretch is null").select("doc_id", "place", "low", "high")
    spans = spans.union(around.filter("repeated").select("doc_id", "place", "low", "high"))
    if hot:
        more = found.filter("stretch is not null")
        again = more.groupBy("stretch").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("stretch")
        spans = spans.union(more.filter("low is not null").join(again, "stretch").select("doc_id", "place", "low", "high"))
    ends = spans.select("doc_id", (F.col("place") - F.col("high")).alias("start"), (F.col("place") - F.col("low") + length).alias("end"))
    return ends.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that spans (start, end) cover."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = found[-1][0], max(end, found[-1][1])
        else:
            found.append((start, end))
    return found


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def drop_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``.

    Bytes covered by a stretch of ``length`` bytes that also begins elsewhere, in the same or in
    another text, are removed. Null texts are empty. Rows with equal texts are copies of each other
    and lose everything if they have ``length`` bytes; ids may be repeated or null. An empty table
    gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("own_id"), text.alias("text"))
    # Equal texts are told by 128 bits; the number of a class is the first half of them.
    keyed = rows.select("own_id", "text", _key(F.col("text")).alias("text_key"), F.xxhash64(F.lit(1), "text").alias("key2"))
    narrow = stored(keyed.select("own_id", "text_key", "key2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "texts")
    classes = stored(narrow.groupBy("text_key", "key2").agg(F.count(F.lit(1)).alias("copies"), F.min("own_id").alias("first_id")), "classes")
    spans = stored(repeated_spans(keyed, classes.select("text_key", "first_id"), length, gram), "spans")
    partly = classes.filter("copies = 1").join(spans, F.col("text_key") == F.col("doc_id")).select("text_key", "key2", "spans")
    partly = stored(partly, "partly")

    able = in_filter(keyed.select("text_key", "key2", "text"), "text_key", id_filter(partly, "text_key"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
                raw, runs = text.as_buffer().to_pybytes(), merge([(s["start"], s["end"]) for s in spans])
                ends = [0, *(x for run in runs for x in run), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2]))
                found.append((len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*found)) or [()] * 3
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key"), batch.column("key2"), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["text_key", "key2", "n_removed", "n_spans", "cut_sha"]
            )

    done = able.join(partly, ["text_key", "key2"]).mapInArrow(cut, "text_key long, key2 long, n_removed long, n_spans long, cut_sha string")
    known = classes.drop("first_id").join(done, ["text_key", "key2"], "left")
    found = narrow.join(known, ["text_key", "key2"])
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    removed = F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0)))
    runs = F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0)))
    sha = F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha", "sha"))
    return found.select(F.col("own_id").alias("doc_id"), "n_bytes", removed.cast("long").alias("n_removed"), runs.cast("long").alias("n_spans"), sha.alias("kept_sha256"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 200 bytes that also occur elsewhere."""
    return drop_repeats(table(spark, sf_dir, "documents"))
