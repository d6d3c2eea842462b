"""Structure repair of conversations: faults are found, and the cheapest edits make turns alternate.

Each turn is reduced to a sign: its role's initial and its fault. The signs of a conversation are a
word, and all different words together form an automaton that shares suffixes: read from their ends,
sorted words differ from their neighbours only where a new branch begins, so each suffix is one node.
A node's right language is a single suffix, so no two nodes could be merged further. At a node, and
for each state of the grammar of legal role sequences, the least cost to go and the first of the
cheapest audits are worked out once, from its child's, for all conversations that end like this.

Words of more than ``SEGMENT`` signs are cut, counted from the end, so that neither a node's audits
nor a task's path grow with the longest conversation. A first pass over the automaton of the cut
words gives their cost from every state to every state; these chain, from the end, into the cost to
go behind every cut, and a second pass finds the audits given that.

The grammar has four states: 0 nothing yet, 1 after a system turn, 2 after a user, 3 after an
assistant. A conversation may end in 0 or 3. In each state just one of user and assistant is legal,
so an audit fixes the repaired turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import slices, stored, table

#: Signs of a piece of a word.
SEGMENT = 2048
#: ASCII white space.
BLANKS = " \t\n\v\f\r"
KEEP_TRUNCATED, REROLE, DELETE, INSERT = 1, 2, 3, 2

START, SYSTEM, USER, ASSISTANT = range(4)
#: In each state: the state after a rerole or an insertion, which is also the role that it gives.
TURN_TO = (USER, USER, ASSISTANT, USER)
#: State after a kept turn, by state and role (0 system, 1 user, 2 assistant, 3 other); -1 is illegal.
KEPT_TO = ((SYSTEM, USER, -1, -1), (-1, USER, -1, -1), (-1, -1, ASSISTANT, -1), (-1, USER, -1, -1))
ROLES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 40
#: Behind the last turn: cost and audit of what must be inserted in each state.
END_COSTS, END_AUDITS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
#: Signs are letters from ``A``: three times the role, plus the fault (0 none, 1 truncated, 2 must go).
MUST_GO = 11


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows hurt by the crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row (it stays here with ``gone``, so that its conversation is known), 1 empties its
    text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes its role ``user``. Null roles and
    texts, and nulls in the hashed key, count as one space; a null turn stays null.
    """
    name, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(name, F.lit(":"), turn).cast("binary")) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"), F.explode(copies))
    return out.drop("col")


def _key() -> Column:
    """Equal for turns of equal role and text."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))


# ---------------------------------------------------------------- the automaton


def step(symbol: int, child: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, int, bool], ...]]:
    """Cost to go of a node in each state, from its child's, and the first edit of the first audit.

    An edit is its letter, the state after it, and whether it moves on to the child. Edits of one
    state have different letters, so the letter alone decides between equal costs.
    """
    role, fault = divmod(symbol, 3)
    costs, edits = [0] * 4, [("", 0, True)] * 4
    for state in range(4):
        cost, edit = DELETE + child[state], ("D", state, True)
        if fault != 2:
            late = KEEP_TRUNCATED if fault else 0
            to = KEPT_TO[state][role]
            if to >= 0 and late + child[to] < cost:
                cost, edit = late + child[to], ("K", to, True)
            to = TURN_TO[state]
            if REROLE + late + child[to] < cost:
                cost, edit = REROLE + late + child[to], ("R", to, True)
        costs[state], edits[state] = cost, edit
    # Insertions stay at the node; user and assistant lead to each other, so one round settles these.
    own = tuple(costs)
    for state in (USER, ASSISTANT, START, SYSTEM):
        to = TURN_TO[state]
        cost = INSERT + (own[to] if state in (USER, ASSISTANT) else costs[to])
        if cost < costs[state] or cost == costs[state] and "I" < edits[state][0]:
            costs[state], edits[state] = cost, ("I", to, False)
    return tuple(costs), tuple(edits)


class Audits:
    """A node with its best audits: cost, audit and last state for each state of the grammar."""

    __slots__ = ("costs", "audits", "exits")

    def __init__(self, costs, audits, exits) -> None:
        self.costs, self.audits, self.exits = costs, audits, exits

    @classmethod
    def root(cls, last: int, costs: tuple[int, ...]) -> Audits:
        return cls(costs, END_AUDITS if last else ("",) * 4, (0, 1, 2, 3))

    def before(self, symbol: int) -> Audits:
        costs, edits = step(symbol, self.costs)
        audits, exits = [None] * 4, [0] * 4
        for state in sorted(range(4), key=lambda s: not edits[s][2]) + [START, SYSTEM]:  # insertions last
            letter, to, moves = edits[state]
            if moves:
                audits[state], exits[state] = letter + self.audits[to], self.exits[to]
            elif audits[to] is not None:
                audits[state], exits[state] = letter + audits[to], exits[to]
        return Audits(costs, tuple(audits), tuple(exits))


class Costs:
    """A node with the cost from each state to each state at the end of the word."""

    __slots__ = ("columns",)

    def __init__(self, columns) -> None:
        self.columns = columns

    @classmethod
    def root(cls) -> Costs:
        return cls(tuple(tuple(0 if s == e else FAR for s in range(4)) for e in range(4)))

    def before(self, symbol: int) -> Costs:
        return Costs(tuple(step(symbol, column)[0] for column in self.columns))


class Path:
    """The nodes from the root to the last word; sorted words, read from their ends, share what they can."""

    def __init__(self, root) -> None:
        self.word, self.nodes = b"", [root]

    def node(self, word: bytes):
        n, most = 0, min(len(word), len(self.word))
        while n < most and word[n] == self.word[n]:
            n += 1
        del self.nodes[n + 1 :]
        for sign in word[n:]:
            self.nodes.append(self.nodes[-1].before(sign - 65))
        self.word = word
        return self.nodes[-1]


def word_costs(words: DataFrame) -> DataFrame:
    """``word, costs``: for different reversed words, 16 costs (last state by last state)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = Path(Costs.root())
        for batch in batches:
            found = [[c for column in path.node(w).columns for c in column] for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(found, pa.list_(pa.int64()))], ["word", "costs"])

    spread = words.select("word").distinct().repartitionByRange("word").sortWithinPartitions("word")
    return spread.mapInArrow(run, "word binary, costs array<long>")


def word_audits(words: DataFrame) -> DataFrame:
    """``word, behind, cost, audits, exits`` for different reversed words and what lies ``behind`` them.

    ``behind`` holds whether the conversation ends there, and the cost to go from each state.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        behind, path = None, None
        for batch in batches:
            found = []
            for root, word in zip(batch.column("behind").to_pylist(), batch.column("word").to_pylist()):
                if root != behind:
                    behind, path = root, Path(Audits.root(root[0], tuple(root[1:])))
                node = path.node(word)
                found.append((node.costs[START], node.audits, node.exits))
            costs, audits, exits = zip(*found) if found else ((), (), ())
            columns = [pa.array(costs, pa.int64()), pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("behind"), *columns], ["word", "behind", "cost", "audits", "exits"])

    spread = words.select("behind", "word").distinct().repartitionByRange("behind", "word").sortWithinPartitions("behind", "word")
    return spread.mapInArrow(run, "word binary, behind array<long>, cost long, audits array<string>, exits array<int>")


def behind_cuts(segments: DataFrame) -> DataFrame:
    """``name, k, behind, offset``: for pieces of cut words, the cost to go behind each, less its least value."""
    costs = segments.join(stored(word_costs(segments), "word-costs"), "word").select("name", "k", "costs")
    chains = costs.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("k", "costs"))).alias("chain"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ks, behinds, offsets = [], [], [], []
            for i, chain in enumerate(batch.column("chain").to_pylist()):
                behind, offset, last = list(END_COSTS), 0, 1
                for piece in chain:
                    names.append(i), ks.append(piece["k"]), behinds.append([last, *behind]), offsets.append(offset)
                    c = piece["costs"]
                    ahead = [min(c[4 * e + s] + behind[e] for e in range(4)) for s in range(4)]
                    least, last = min(ahead), 0
                    behind, offset = [x - least for x in ahead], offset + least
            arrays = [batch.column("name").take(pa.array(names, pa.int64())), pa.array(ks, pa.int32()), pa.array(behinds, pa.list_(pa.int64())), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["name", "k", "behind", "offset"])

    kinds = T.StructType([chains.schema["name"], T.StructField("k", T.IntegerType()), T.StructField("behind", T.ArrayType(T.LongType())), T.StructField("offset", T.LongType())])
    return chains.mapInArrow(run, kinds)


# ---------------------------------------------------------------- faults and words


def _changes(column: pa.Array) -> np.ndarray:
    """For each row but the first, whether it differs from the row before; nulls are equal."""
    if len(column) < 2:
        return np.zeros(0, bool)
    before, after = column.slice(0, len(column) - 1), column.slice(1)
    other = pc.fill_null(pc.not_equal(before, after), False)
    return np.asarray(pc.or_(other, pc.xor(pc.is_null(before), pc.is_null(after))))


class _Tally:
    """What is known so far of the conversation that is being read."""

    def __init__(self) -> None:
        self.signs: list[bytes] = []
        self.counts = np.zeros(4, np.int64)  # blank, duplicate, truncated, illegal
        self.low = self.high = None
        self.turns = 0
        self.role = None

    def row(self) -> tuple:
        word = b"".join(self.signs)[::-1]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (word, gaps, *self.counts.tolist())


LEGAL = np.zeros((4, 4), bool)
LEGAL[0, 1] = LEGAL[1, 2] = LEGAL[2, 1] = True


def _read_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation: its word from the end, and its counts. Rows come in order."""
    own, before = None, None

    def made(names: list, rows: list) -> pa.RecordBatch:
        kinds = [pa.binary(), *[pa.int64()] * 5]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(names), *columns], ["name", "word", "gaps", "blank", "duplicate", "truncated", "illegal"])

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        if before is None:
            joined = batch
            new = np.concatenate([[True], _changes(batch.column("name"))])
            same = np.zeros(n, bool)
        else:
            joined = pa.Table.from_batches([before, batch]).combine_chunks().to_batches()[0]
            new = _changes(joined.column("name"))
        if joined.num_rows > 1:
            other = np.any([_changes(joined.column(c)) for c in ("name", "turn", "role", "key", "gone")], axis=0)
            same = ~other if before is not None else np.concatenate([[False], ~other])
        gone, blank, cut, later = (batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("gone", "blank", "truncated", "later"))
        role = batch.column("initial").to_numpy(zero_copy_only=False).astype(np.int64)
        repeated = ~blank & (later | same)
        cut = cut & ~blank & ~repeated
        signs = np.where(blank | repeated, MUST_GO, 3 * role + cut).astype(np.uint8) + 65
        turns = batch.column("turn").to_pylist()
        names, rows = [], []
        edges = np.flatnonzero(new).tolist()
        for a, b in zip([0, *edges] if not edges or edges[0] else edges, [*edges, n] if not edges or edges[0] else [*edges[1:], n]):
            if new[a]:
                if own is not None:
                    rows.append(own.row())
                    names.append(before.column("name") if a == 0 else batch.column("name").slice(a - 1, 1))
                own = _Tally()
            live = np.flatnonzero(~gone[a:b]) + a
            if not len(live):
                continue
            own.signs.append(signs[live].tobytes())
            roles = role[live] if own.role is None else np.concatenate([[own.role], role[live]])
            own.role = roles[-1]
            illegal = int((~LEGAL[roles[:-1], roles[1:]]).sum())
            own.counts += (int(blank[live].sum()), int(repeated[live].sum()), int(cut[live].sum()), illegal)
            for i in live.tolist():
                if turns[i] is not None and turns[i] != own.high:
                    own.low, own.high, own.turns = turns[i] if own.low is None else own.low, turns[i], own.turns + 1
        if rows:
            yield made(names, rows)
        before = batch.slice(n - 1, 1)
    if own is not None:
        yield made([before.column("name")], [own.row()])


def words_of(turns: DataFrame) -> DataFrame:
    """``name, word, gaps, blank, duplicate, truncated, illegal`` for each conversation of damaged turns.

    The rows that are sorted are narrow: texts have become a hash and two flags. Whether a turn
    was seen earlier is an aggregate by conversation, role and text, so no task remembers the
    turns of a conversation; a word has one byte for each.
    """
    bare = F.rtrim("text", F.lit(BLANKS))
    ends = F.substring(bare, -1, 1)
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = turns.select(
        F.col("conv_id").alias("name"), "turn", "role", _key().alias("key"), "gone", (bare == "").alias("blank"), (~ends.isin(".", "!", "?")).alias("truncated"), number.alias("initial")
    )
    narrow = stored(narrow, "turns")
    at = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    seen = narrow.filter("not gone").groupBy("name", "key").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
    seen = seen.filter("n > 1").select(F.col("name").alias("of"), F.col("key").alias("of_key"), "first")
    marked = narrow.join(seen, F.col("name").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")), "left")
    marked = marked.select(*narrow.columns, F.coalesce(at > F.col("first"), F.lit(False)).alias("later"))
    ordered = marked.repartition("name").sortWithinPartitions("name", "turn", "role", "key")
    kinds = T.StructType([marked.schema["name"], T.StructField("word", T.BinaryType()), *[T.StructField(c, T.LongType()) for c in COUNTS]])
    return stored(ordered.mapInArrow(_read_words, kinds), "words")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def audits_of(words: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``words`` with ``cost`` and ``audit``."""
    n = F.length("word")
    cuts = F.sequence(F.lit(0), F.greatest(F.ceil(n / segment).cast("int") - 1, F.lit(0)))
    pieces = words.filter(n > 0).select("name", "word", F.explode(cuts).alias("k"), (n > segment).alias("cut"))
    pieces = stored(pieces.select("name", "k", "cut", F.substring("word", F.col("k") * segment + 1, F.lit(segment)).alias("word")), "pieces")
    whole = pieces.filter("not cut").select("name", "k", "word", F.array(*map(F.lit, (1, *END_COSTS))).cast("array<long>").alias("behind"), F.lit(0).cast("long").alias("offset"))
    long = pieces.filter("cut")
    if not long.isEmpty():
        known = behind_cuts(long).select(F.col("name").alias("of"), F.col("k").alias("of_k"), "behind", "offset")
        joined = long.join(known, F.col("name").eqNullSafe(F.col("of")) & (F.col("k") == F.col("of_k")))
        whole = whole.unionByName(joined.select(*whole.columns))
    whole = stored(whole, "pieces-behind")
    found = stored(word_audits(whole), "audits")
    part = whole.join(found, ["word", "behind"]).select("name", "k", "offset", "cost", "audits", "exits")
    # From the first piece of a conversation, which has the largest k, to its last.
    order = F.reverse(F.array_sort(F.collect_list(F.struct("k", "offset", "cost", "audits", "exits"))))
    chains = part.groupBy("name").agg(order.alias("p"))
    first = F.struct(F.lit("").alias("audit"), F.lit(0).alias("state"))
    walked = F.aggregate("p", first, lambda a, x: F.struct(F.concat(a["audit"], x["audits"][a["state"]]).alias("audit"), x["exits"][a["state"]].alias("state")))
    done = chains.select(F.col("name").alias("of"), (F.col("p")[0]["cost"] + F.col("p")[0]["offset"]).alias("cost"), walked["audit"].alias("audit"))
    out = words.drop("word").join(done, F.col("name").eqNullSafe(F.col("of")), "left").drop("of")
    return out.select("name", *COUNTS, F.coalesce("cost", F.lit(0)).alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"))


# ---------------------------------------------------------------- repaired turns

HEAD = (*COUNTS, "cost")
REPAIRED = ("role", "text", "edit")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The header row of each conversation, then its repaired turns, in order."""
    audit, at, state = "", 0, START
    row_of, places, roles, texts, edits = [], [], [], [], []
    place = 0

    def insert(i: int) -> None:
        nonlocal at, state, place
        while at < len(audit) and audit[at] == "I":
            state, at = TURN_TO[state], at + 1
            row_of.append(i), places.append(place), roles.append(ROLES[state]), texts.append(""), edits.append("I")
            place += 1

    for big in batches:
        for batch in slices([big], "text"):
            row_of, places, roles, texts, edits = [], [], [], [], []
            audit_col = batch.column("audit")
            for i, (role, text) in enumerate(zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())):
                if text is None:  # a header
                    audit, at, state, place = audit_col[i].as_py(), 0, START, 0
                    row_of.append(i), places.append(None), roles.append(None), texts.append(None), edits.append(None)
                    insert(i)
                    continue
                letter = audit[at]
                at += 1
                if letter != "D":
                    state = TURN_TO[state] if letter == "R" else KEPT_TO[state]["sua".find(role[:1])]
                    row_of.append(i), places.append(place), roles.append(ROLES[state] if letter == "R" else role), texts.append(text), edits.append(letter)
                    place += 1
                insert(i)
            taken = pa.array(row_of, pa.int64())
            columns = [batch.column("name").take(taken), *(batch.column(c).take(taken) for c in (*HEAD, "audit"))]
            new = [pa.array(places, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string()), pa.array(edits, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *new], ["name", *HEAD, "audit", "place", *REPAIRED])


def _walked(turns: DataFrame, audits: DataFrame) -> DataFrame:
    none = F.lit(None)
    head = audits.select("name", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("binary").alias("key"), none.cast("string").alias("text"), *HEAD, "audit")
    rows = turns.filter("not gone").select(F.col("conv_id").alias("name"), F.lit(1).alias("kind"), "turn", "role", _key().alias("key"), "text", *[none.cast("long").alias(c) for c in HEAD], none.cast("string").alias("audit"))
    ordered = head.unionByName(rows).repartition("name").sortWithinPartitions("name", "kind", "turn", "role", "key")
    kinds = T.StructType(
        [ordered.schema["name"], *[T.StructField(c, T.LongType()) for c in HEAD], T.StructField("audit", T.StringType()), T.StructField("place", T.LongType()), *[T.StructField(c, T.StringType()) for c in REPAIRED]]
    )
    return ordered.mapInArrow(_apply, kinds)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each header: its columns, and the hash of the turns that follow it."""
    names = ["name", *HEAD, "audit"]
    head, sha, fresh = None, None, True

    def made(heads: list, hashes: list) -> pa.RecordBatch:
        whole = pa.Table.from_batches(heads).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays([*whole.columns, pa.array(hashes, pa.string())], [*names, "repaired_sha256"])

    for batch in batches:
        heads, hashes = [], []
        for i, (role, text) in enumerate(zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())):
            if text is None:
                if head is not None:
                    heads.append(head), hashes.append(sha.hexdigest())
                head, sha, fresh = batch.slice(i, 1).select(names), hashlib.sha256(), True
                continue
            sha.update(f"{'' if fresh else chr(10)}{role}:{text}".encode())
            fresh = False
        if heads:
            yield made(heads, hashes)
    if head is not None:
        yield made([head], [sha.hexdigest()])


def repair(turns: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Audits (a row for each conversation) and repaired turns of ``conv_id, turn, role, text[, gone]``.

    Turns are taken in the order of ``turn`` (nulls first), then of role and of the text's hash. The
    first fault of a row counts: blank, duplicate (role and text seen earlier), truncated (it does
    not end in ``.!?``). Audits hold ``gaps, blank, duplicate, truncated, illegal, cost, audit``;
    ``repaired`` has ``conv_id, place, role, text, edit``. A null ``conv_id`` is one conversation.
    A role that is empty, or has another initial than s, u and a, is legal nowhere. Null roles and
    texts count as one space. Empty tables give empty results; other columns are ignored.

    A conversation's turns are read in one stream, because its text is written as a whole; memory is
    a byte or two for each turn (its audit, which is one cell of the result) and one batch of rows.
    """
    if "gone" not in turns.columns:
        turns = turns.withColumn("gone", F.lit(False))
    fill = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), *fill, "gone")
    audits = stored(audits_of(words_of(turns), segment), "conversation-audits")
    walked = _walked(turns, audits)
    repaired = walked.filter("place is not null").select(F.col("name").alias("conv_id"), "place", *REPAIRED)
    return audits.withColumnRenamed("name", "conv_id"), repaired


def repaired_digests(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Audits and ``repaired_sha256``, the hash of each conversation's repaired ``role:text`` lines."""
    audits = stored(audits_of(words_of(turns), segment), "conversation-audits")
    walked = _walked(turns, audits)  # the stream goes on in the same tasks, without a further shuffle
    kinds = T.StructType([*walked.schema.fields[: len(HEAD) + 2], T.StructField("repaired_sha256", T.StringType())])
    return walked.mapInArrow(_digest, kinds).withColumnRenamed("name", "conv_id")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired: faults, cost, audit, and the hash of the repaired turns."""
    return repaired_digests(damage(table(spark, sf_dir, "conversations")))
