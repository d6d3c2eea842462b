"""Pack token pieces into sequences of fixed capacity.

The lengths' histogram is all the plan needs, and it has at most ``capacity`` entries, whatever
the number of pieces. A sequence's *configuration* is the multiset of lengths it holds. The
configuration linear program (fewest sequences that hold all pieces) is solved by multiplicative
weights: each length has a price that falls exponentially as it is served, and the configurations
worth most at these prices are found by dynamic programming (an unbounded knapsack). Prices at
which no configuration is worth more than one bound the optimum from below, so the solution comes
with its gap. It is rounded down, then up where pieces are left; only what no configuration of the
solution can take whole is placed by best fit. Pieces then find their places by their rank among
those of the same length.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored, table
from tidemark.llm.tokens import MEMORY_WORDS, TOKENIZER, crc32_of_ids, encoder

CAPACITY = 2048
END_ID = 0
#: Configurations used at the same prices: at least so many, and one for so many lengths not yet served.
PER_STEP, LENGTHS_PER_USE = 12, 16
#: How fast a price falls: so slowly that room left empty weighs more than a length served too little.
FALL = 0.5
#: Share of a length's pieces that one use serves at most.
STEP_SHARE = 0.05
#: Wanted gap between the solution and the bound; rounds of pricing, configurations found in each, and kept at most unless in use.
GAP, ROUNDS, NEW_EACH_ROUND, POOL = 0.002, 6, 256, 2_000

Configuration = tuple[tuple[int, int], ...]  # (length, how often), longest first


def knapsack(prices: np.ndarray, capacity: int) -> np.ndarray:
    """Most value that fits into each size up to ``capacity``; ``prices[n]`` is that of length ``n``."""
    best = np.zeros(capacity + 1)
    for size in range(1, capacity + 1):
        best[size] = max(best[size - 1], (prices[1 : size + 1] + best[size - 1 :: -1]).max())
    return best


def _trace(first: int, prices: np.ndarray, best: np.ndarray, left: np.ndarray) -> Configuration:
    """A best configuration that holds a piece of length ``first`` and no more pieces than are left."""
    found, room = Counter([first]), len(best) - 1 - first
    open_ = np.where(left > 0, prices, -np.inf)
    if left[first] == 1:
        open_[first] = -np.inf
    while room:
        values = open_[1 : room + 1] + best[room - 1 :: -1]
        length = room - int(np.argmax(values[::-1]))  # the longest among equals
        if values[length - 1] == -np.inf:
            break
        times = 1
        if open_[length] + best[room - length] >= best[room] * (1 - 1e-12) and 2 * length <= room and length * best[room] <= room * prices[length] * (1 + 1e-12):
            times = room // length  # nothing is worth more for its size: as often as it fits
        times = min(times, int(left[length]) - found[length])
        found[length] += times
        room -= times * length
        if found[length] == left[length]:
            open_[length] = -np.inf
    return tuple(sorted(found.items(), reverse=True))


def greedy(counts: Mapping[int, int], capacity: int, worth_of: Mapping[int, float] | None = None) -> Counter:
    """Whole sequences that hold all pieces, from configurations worth most at prices that fall as lengths are served.

    A first solution of the program, and the configurations it starts from.
    """
    lengths = np.array(sorted(n for n, c in counts.items() if c), np.int64)
    left = np.zeros(capacity + 1, np.int64)
    left[lengths] = [counts[n] for n in lengths.tolist()]
    demand, worth = left.astype(float), np.zeros(capacity + 1)
    worth[lengths] = lengths if worth_of is None else [max(worth_of[n], 1e-12) for n in lengths.tolist()]
    used: Counter = Counter()
    while left.any():
        open_ = lengths[left[lengths] > 0]
        served = 1 - left[open_] / demand[open_]
        prices = np.full(capacity + 1, -np.inf)
        prices[open_] = worth[open_] * np.exp(-FALL * (served - served.min()))
        best = knapsack(prices, capacity)
        first_worth = prices[open_] + best[capacity - open_]
        for first in open_[np.argsort(-first_worth, kind="stable")[: max(PER_STEP, len(open_) // LENGTHS_PER_USE)]]:
            if not left[first]:
                continue
            configuration = _trace(int(first), prices, best, left)
            own, times = np.array(configuration).T
            step = int(np.minimum(left[own] // times, np.maximum(1, STEP_SHARE * demand[own] / times)).min())
            used[configuration] += step
            left[own] -= step * times
    return used


def first_prices(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """The best of some prices at which no configuration can be worth more than one.

    Lengths themselves; lengths where those above a limit count as full and their complements not
    at all; and lengths rounded to parts of the capacity.
    """
    share = lengths / capacity
    best = share
    for limit in lengths[2 * lengths <= capacity].tolist():
        price = np.where(lengths > capacity - limit, 1.0, np.where(lengths < limit, 0.0, share))
        best = max(best, price, key=lambda y: float(y @ demand))
    for parts in range(1, 33):
        times = (parts + 1) * lengths
        price = np.where(times % capacity == 0, share, times // capacity / parts)
        best = max(best, price, key=lambda y: float(y @ demand))
    return best


@dataclass
class Program:
    """A solution of the configuration program: shares of configurations, and bounds of its optimum.

    ``x`` serves no length more than it occurs; ``primal`` is the value of a solution that serves
    all, ``dual`` that of prices at which no configuration is worth more than one.
    """

    x: dict[Configuration, float]
    primal: float
    dual: float

    @property
    def gap(self) -> float:
        return self.primal / self.dual - 1 if self.dual else 0.0


def _weights(a: np.ndarray, x: np.ndarray, start: np.ndarray, demand: np.ndarray, value: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiplicative weights on both sides of the program of known configurations (rows of ``a``).

    A length's weight falls exponentially as it is served, a configuration's rises with its worth.
    Each side takes its last gain twice, less the one before, so that the two do not chase each
    other; averages, later steps counting more, approach the program's prices and shares.
    """
    gain = a / demand * value
    rate = 0.5 / gain.max()
    log_q, log_u = np.log(np.maximum(x / x.sum(), 1e-6)), np.log(np.maximum(start * demand / (start @ demand), 1e-12))
    q_sum, u_sum, last_q, last_u = np.zeros(len(x)), np.zeros(len(demand)), 0.0, 0.0
    for step in range(1, steps + 1):
        q, u = np.exp(log_q - log_q.max()), np.exp(log_u - log_u.max())
        q, u = q / q.sum(), u / u.sum()
        to_q, to_u = gain @ u, q @ gain
        log_q += rate * (2 * to_q - last_q)
        log_u -= rate * (2 * to_u - last_u)
        last_q, last_u = to_q, to_u
        q_sum += step * q
        u_sum += step * u
    return u_sum / u_sum.sum() / demand, q_sum / q_sum.sum()


def _trimmed(pool: list[Configuration], x: np.ndarray, demand: dict[int, float]) -> dict[Configuration, float]:
    """Shares cut so that no length is served more than it occurs, largest first."""
    left, out = dict(demand), {}
    for i in np.argsort(-x, kind="stable").tolist():
        use = min(float(x[i]), min(left[n] / k for n, k in pool[i]))
        if use > 1e-9:
            out[pool[i]] = use
            for n, k in pool[i]:
                left[n] -= use * k
    return out


def solve(counts: Mapping[int, int], capacity: int, gap: float = GAP) -> Program:
    """The program's solution by multiplicative weights, to within ``gap`` of its optimum where rounds suffice.

    A first solution uses the lengths as prices, and best fit; if the better one is within the gap
    of the bound that simple prices give, it is the solution. Else weights on all configurations known so far give prices, the
    knapsack at these prices gives a bound and further configurations, and so on.
    """
    counts = {n: c for n, c in counts.items() if c}
    if not counts:
        return Program({}, 0.0, 0.0)
    used = greedy(counts, capacity)
    lengths = np.array(sorted(counts), np.int64)
    demand = np.array([counts[n] for n in lengths.tolist()], float)
    price = first_prices(lengths, demand, capacity)
    dual = float(price @ demand)
    found = Program({c: float(s) for c, s in used.items()}, float(sum(used.values())), dual)
    tight = best_fit(counts, capacity)
    if sum(tight.values()) < found.primal:
        found = Program({c: float(s) for c, s in tight.items()}, float(sum(tight.values())), dual)
    pool = list(dict.fromkeys([*used, *tight]))
    for round_ in range(ROUNDS):
        if found.gap <= gap:
            break
        place = {n: i for i, n in enumerate(lengths.tolist())}
        a = np.zeros((len(pool), len(lengths)))
        for i, configuration in enumerate(pool):
            for n, k in configuration:
                a[i, place[n]] = k
        known = np.array([max(found.x.get(c, 0.0), 1e-3) for c in pool])
        # Few configurations allow many steps.
        steps = int(min(6000, max(100, 2e8 / a.size)))
        price, x = _weights(a, known, price, demand, found.primal, steps)
        prices = np.full(capacity + 1, -np.inf)
        prices[lengths] = price
        best = knapsack(prices, capacity)
        dual = max(found.dual, float(price @ demand) / best[capacity])
        served = (x @ a) / demand
        shares, primal = _trimmed(pool, x / max(1e-12, float(np.quantile(served, 0.02))), dict(counts)), float(x.sum() / max(served.min(), 1e-12))
        whole = rounded(shares, counts, capacity)
        primal = min(primal, float(sum(whole.values())))
        found = Program(shares, primal, dual) if primal < found.primal else Program(found.x, found.primal, dual)
        # Further configurations: the best that hold each length.
        left = np.zeros(capacity + 1, np.int64)
        left[lengths] = demand.astype(np.int64)
        by_worth = lengths[np.argsort(-(price + best[capacity - lengths]), kind="stable")]
        new = [_trace(int(n), prices, best, left) for n in by_worth[:NEW_EACH_ROUND]]
        pool = list(dict.fromkeys([*(c for c, s in zip(pool, x) if s > 1e-6 * x.max() or len(pool) < POOL), *whole, *new]))
    return found


def fractional(counts: Mapping[int, int], capacity: int) -> dict[Configuration, float]:
    """Shares of configurations that solve the program; no length is served more than it occurs."""
    return solve(counts, capacity).x


def rounded(shares: Mapping[Configuration, float], counts: Mapping[int, int], capacity: int) -> Counter:
    """Whole sequences that hold exactly ``counts``.

    Shares are rounded down, then, largest remainder first, up where all pieces are still there.
    Best fit places what no configuration of the solution can take whole.
    """
    left, used = dict(counts), Counter()
    for up in (False, True):
        for configuration, share in sorted(shares.items(), key=lambda c: (-(c[1] % 1), c[0])):
            times = min(1 if up else int(share + 1e-6), min(left[n] // k for n, k in configuration))
            if times > 0:
                used[configuration] += times
                for n, k in configuration:
                    left[n] -= times * k
    used.update(best_fit({n: c for n, c in left.items() if c}, capacity))
    return used


def best_fit(lengths: Iterable[int] | Mapping[int, int], capacity: int) -> Counter:
    """Configurations of pieces (or counts of them), longest first, each put where the least room is left."""
    by_room: dict[int, Counter] = {}
    rooms = np.zeros(capacity + 1, np.int64)  # open sequences with so much room

    def put(configuration: Configuration, room: int, sequences: int) -> None:
        if sequences:
            by_room.setdefault(room, Counter())[configuration] += sequences
            rooms[room] += sequences

    for length, pieces in sorted(Counter(lengths).items(), reverse=True):
        while pieces:
            fit = np.flatnonzero(rooms[length:])
            if len(fit):
                room = length + int(fit[0])
                configuration, there = by_room[room].popitem()
                rooms[room] -= there
            else:
                room, configuration, there = capacity, (), pieces
            # The tightest sequence stays the tightest, so it takes as many pieces as fit.
            times = min(room // length, pieces)
            full = min(there, pieces // times)
            put((*configuration, (length, times)), room - times * length, full)
            if configuration:
                put(configuration, room, there - full)
            pieces -= full * times
    found: Counter = Counter()
    for group in by_room.values():
        found.update(group)
    return found


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Configuration, int]]:
    """Configurations and how many sequences have each; together they hold exactly ``counts``."""
    counts = {n: c for n, c in counts.items() if c}
    found = rounded(solve(counts, capacity).x, counts, capacity)
    return sorted((c, s) for c, s in found.items() if s)


def slots(found: list[tuple[Configuration, int]]) -> dict[str, np.ndarray]:
    """Places by length and rank: from ``rank`` on, ``times`` places in each sequence from ``sequence`` on."""
    rows, used, sequence = [], Counter(), 0
    for configuration, sequences in found:
        offset = 0
        for length, times in configuration:
            rows.append((length, used[length], times, sequence, offset))
            used[length] += times * sequences
            offset += length * times
        sequence += sequences
    rows.sort()
    names = ("length", "rank", "times", "sequence", "offset")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T))


def token_pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str = TOKENIZER, with_ids: bool = False, memory_words: int = MEMORY_WORDS
) -> DataFrame:
    """Pieces of the documents' ids, each document ended by ``end_id`` and cut every ``capacity`` ids.

    ``task`` and ``nth`` number the pieces of one length within the task that made them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = encoder(tokenizer, memory_words), TaskContext.get().partitionId()
        end, seen = own.one(end_id), Counter()
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), own.encode(batch.column("text"))):
                ids += end
                for piece, start in enumerate(range(0, len(ids), capacity * own.width)):
                    part = ids[start : start + capacity * own.width]
                    length = len(part) // own.width
                    rows.append((doc_id, piece, start // own.width, length, crc32_of_ids(part, own.width), task, seen[length], part if with_ids else None))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long, ids binary"
    return source.mapInArrow(cut, kinds)


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str = TOKENIZER, with_ids: bool = False, memory_words: int = MEMORY_WORDS) -> DataFrame:
    """Pieces of all documents with the sequence each is in and its offset there.

    Null and empty texts are the end id alone. Repeated or null ``doc_id`` give pieces each. An
    empty table gives no rows. ``with_ids`` adds the ids as bytes.
    """
    pieces = stored(token_pieces(docs, capacity, end_id, tokenizer, with_ids, memory_words), "pieces")
    counts = stored(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    found = slots(plan(histogram, capacity))
    keys = found["length"] << 44 | found["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            nth = rank - found["rank"][at]
            sequence = found["sequence"][at] + nth // found["times"][at]
            offset = found["offset"][at] + nth % found["times"][at] * length
            rest = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    # Ranks within a length: what earlier tasks have (a row for each task), then the task's own number.
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    ranked = pieces.join(bases, ["task", "length"]).select(*names, (F.col("base") + F.col("nth")).alias("rank"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))
