"""Conversation structure repair over a suffix-shared automaton.

A conversation is a list of messages. Each is seen as one symbol: the initial of
its role and whether it is sound, cut short, or has to go (blank, or a message
seen before). A signature is the string of a conversation's symbols. The cheapest
edits that make the roles ``(s?(ua)+)?`` depend on the rest of the signature and on
the state of this grammar only, so equal rests are one node of an automaton that
all conversations share, built from the end: a node is a symbol and the node of
what follows. For each node and grammar state the cost to go and the best edits
are found once; of the best audit a node holds the first letters and the state in
which the next node goes on, so a node has a fixed size.

In Spark: messages, with a digest for their text, meet their conversation and are
ordered; a task streams through them and puts out one signature a conversation.
The distinct signatures are range-partitioned by their reversal and sorted, so
those with a common end are neighbours; a task keeps the nodes of the current
signature on a stack and computes only nodes that the one before did not have. The
plans are joined back to the conversations that have the signature, and a last
pass streams each conversation's messages behind its plan. A task holds one
Arrow batch, one signature and its nodes, never a conversation's texts; a message
of its own is whole. A hot conversation is in one task in the passes that stream
it (its repaired text is one sequence by definition), with a disk-backed sort.

Nulls in any column count as one space, so a null conversation is one, a null turn
comes before all others, and a null role has the initial " ". Messages of one turn
are ordered by role and then by digest of the text. Repeated rows are messages
like others: the second is a duplicate. Empty texts are blank. Very long texts are
passed through whole. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import ship, stored
from tracelake.plans.joins import lookup_join

# The costs of edits, and of a message that is cut short and stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States of the grammar: nothing yet, after s, after u, after a. What each state
# accepts next as a written role, and the end costs by inserting what is missing.
WRITES = ("u", "u", "a", "u")
AFTER = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
ROLES = {"u": "user", "a": "assistant"}
ENDS = (0, 3)
# Symbols: initials of sound messages, upper case if cut short, and D if it has to go.
GONE = "D"
OTHER = "o"

SPACE = " \t\n\v\f\r"
SIGNATURES = (
    "conv_id bigint, signature string, gaps bigint, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint"
)
PLANS = "signature string, cost bigint, audit string"
REPAIRED = "conv_id bigint, position bigint, turn bigint, role string, text string, edit string"
# Signatures of one task, at least, and rows that go out at once.
PART_SIGNATURES = 20_000
OUT_ROWS = 4096


# --- faults ---------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Faults made on purpose, by a hash of conversation and turn.

    Of twenty messages one is dropped, one emptied, one loses its full stops,
    question and exclamation marks, one is repeated, one is said by the user. A
    dropped message leaves a row with ``there`` false, so that no conversation is
    lost.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    return (
        conversations.select(
            F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
            name("role").alias("role"), name("text").alias("text"), kind.alias("_kind"),
        )
        .withColumns({
            "there": F.col("_kind") != 0,
            "role": F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")),
            "text": F.when(F.col("_kind") == 1, F.lit(""))
            .when(F.col("_kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")),
            "_copies": F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
        })
        .drop("_kind", "_copies")
    )


def messages(conversations: DataFrame) -> DataFrame:
    """A table of conversations as it is, in the form that :func:`repair` reads."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        name("role").alias("role"), name("text").alias("text"), F.lit(True).alias("there"),
    )


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def signatures(rows: DataFrame) -> DataFrame:
    """One row a conversation: its signature and the counts of its faults."""
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    narrow = rows.select(
        "conv_id", "turn", "role", _digest().alias("digest"), "there",
        (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"),
    )
    # the window finds its rows where the conversation is
    same = Window.partitionBy("conv_id", "there", "role", "digest").orderBy("turn")
    seen = narrow.repartition(F.col("conv_id")).withColumn("seen", F.row_number().over(same) > 1)
    ordered = seen.sortWithinPartitions("conv_id", "turn", "role", "digest", "seen")
    return ordered.select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "there", "blank", "seen", "cut"
    ).mapInArrow(_sign, SIGNATURES)


LEGAL = {"su", "ua", "au"}


class _Signature:
    """What is known of one conversation while its messages pass."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.symbols: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.initial = None

    def add(self, turn: int | None, initial: str, blank: bool, seen: bool, cut: bool) -> None:
        if self.symbols and (self.initial + initial) not in LEGAL:
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        symbol = initial if initial in AFTER else OTHER
        if blank:
            self.blank += 1
            symbol = GONE
        elif seen:
            self.duplicate += 1
            symbol = GONE
        elif cut:
            self.truncated += 1
            symbol = symbol.upper()
        self.symbols.append(symbol)

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (
            self.conv_id, "".join(self.symbols), gaps, self.blank, self.duplicate, self.truncated, self.illegal
        )


def _table(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    columns = [c.split() for c in ddl.split(", ")]
    values = list(zip(*rows)) if rows else [()] * len(columns)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kinds[kind]) for v, (_, kind) in zip(values, columns)], [name for name, _ in columns]
    )


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, out = None, []
    for batch in batches:
        for conv_id, turn, initial, there, *faults in zip(*(c.to_pylist() for c in batch.columns)):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    out.append(current.row())
                current = _Signature(conv_id)
            if there:
                current.add(turn, initial, *faults)
        if len(out) >= OUT_ROWS:
            yield _table(out, SIGNATURES)
            out = []
    if current is not None:
        out.append(current.row())
    yield _table(out, SIGNATURES)


# --- the automaton --------------------------------------------------------------

class Node:
    """A symbol and all that follows: for each grammar state the cost to go, the
    letters of the best audit up to and with this symbol, and the state after it."""

    __slots__ = ("cost", "letters", "state", "following")

    def __init__(self, cost, letters, state, following):
        self.cost, self.letters, self.state, self.following = cost, letters, state, following


def _inserting(own: list[tuple[int, str, int]]) -> tuple:
    """Per state the best of its own option and of inserting a role first.

    An option is cost, letters and next state. Inserting leads from a state to
    that of the role written; two insertions are all that can be of use, as a
    third returns to a state that was left.
    """
    best = own
    for _ in range(2):
        inserted = [best[AFTER[WRITES[state]][state]] for state in range(4)]
        best = [
            min(option, (cost + INSERT, "I" + letters, after), key=lambda o: (o[0], o[1][:1]))
            for option, (cost, letters, after) in zip(own, inserted)
        ]
    return tuple(zip(*best))


FAR = 1 << 60
LAST = Node(*_inserting([(0, "", 0) if s in ENDS else (FAR, "~", s) for s in range(4)]), None)

_steps: dict[tuple, tuple] = {}


def node(symbol: str, following: Node) -> Node:
    """The node of a symbol before ``following``.

    Costs to go differ by a bounded amount between states, so few combinations of
    symbol and differences exist, and each is worked out once.
    """
    base = min(following.cost)
    relative = tuple(c - base for c in following.cost)
    known = _steps.get((symbol, relative))
    if known is None:
        initial, extra = symbol.lower(), TRUNCATED if symbol != GONE and symbol.isupper() else 0
        options = []
        for state in range(4):
            choices = [(relative[state] + DELETE, "D", state)]
            if symbol != GONE:
                kept = AFTER.get(initial, (None,) * 4)[state]
                if kept is not None:
                    choices.append((relative[kept] + extra, "K", kept))
                written = AFTER[WRITES[state]][state]
                choices.append((relative[written] + REROLE + extra, "R", written))
            options.append(min(choices))
        known = _steps[symbol, relative] = _inserting(options)
    cost, letters, state = known
    return Node(tuple(c + base for c in cost), letters, state, following)


def audit(first: Node) -> str:
    """The letters of the best audit, read along the automaton."""
    state, letters, at = 0, [], first
    while at is not None:
        letters.append(at.letters[state])
        state, at = at.state[state], at.following
    return "".join(letters)


class Automaton:
    """The nodes of a signature's ends, kept for the next signature in order."""

    def __init__(self) -> None:
        self._symbols = ""
        self._nodes = [LAST]
        self.made = 0

    def plan(self, signature: str) -> tuple[int, str]:
        backward = signature[::-1]
        shared = _shared(self._symbols, backward)
        del self._nodes[shared + 1 :]
        for symbol in backward[shared:]:
            self._nodes.append(node(symbol, self._nodes[-1]))
            self.made += 1
        self._symbols = backward
        return self._nodes[-1].cost[0], audit(self._nodes[-1])


def _shared(one: str, other: str) -> int:
    """Characters at the beginning that both have, by halving."""
    low, high = 0, min(len(one), len(other))
    while low < high:
        middle = low + high + 1 >> 1
        if one[low:middle] == other[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = Automaton()
    for batch in batches:
        found = batch.column(0).to_pylist()
        yield _table([(s, *automaton.plan(s)) for s in found], PLANS)


def plans(signed: DataFrame) -> DataFrame:
    """Cost and audit of each distinct signature."""
    distinct = stored(signed.select("signature").distinct(), "signatures")
    parts = max(1, -(-distinct.count() // PART_SIGNATURES))
    backward = F.reverse("signature")
    return (
        distinct.repartitionByRange(parts, backward)
        .sortWithinPartitions(backward)
        .mapInArrow(_plan, PLANS)
    )


# --- repair ---------------------------------------------------------------------

def audits(rows: DataFrame) -> DataFrame:
    """One row a conversation: counts of faults, cost of its repair and the audit.

    ``rows``: as :func:`messages` or :func:`damaged` give them.
    """
    ship(rows.sparkSession)
    signed = stored(signatures(rows), "signed")
    return lookup_join(signed, plans(signed), ["signature"], spread_by="conv_id")


def repair(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The repaired messages, in ``position`` order; ``edit`` is K, R or I.

    ``audited``: what :func:`audits` gave. Each conversation's plan travels in
    front of its messages.
    """
    ship(rows.sparkSession)
    none = lambda kind: F.lit(None).cast(kind)
    heads = audited.select(
        "conv_id", F.lit(0).alias("part"), none("bigint").alias("turn"), none("string").alias("role"),
        none("binary").alias("digest"), F.col("audit").alias("text"),
    )
    bodies = rows.where("there").select(
        "conv_id", F.lit(1).alias("part"), "turn", "role", _digest().alias("digest"), "text"
    )
    ordered = heads.unionByName(bodies).repartition(F.col("conv_id")).sortWithinPartitions(
        "conv_id", "part", "turn", "role", "digest"
    )
    return ordered.select("conv_id", "part", "turn", "role", "text").mapInArrow(_repair, REPAIRED)


class _Repair:
    """Follows an audit while the messages of its conversation pass."""

    def __init__(self, conv_id: int | None, audit: str):
        self.conv_id, self._audit = conv_id, audit
        self._at = self._state = self._position = 0

    def _row(self, turn, role: str, text: str, edit: str, initial: str) -> tuple:
        self._state = AFTER[initial][self._state]
        self._position += 1
        return self.conv_id, self._position - 1, turn, role, text, edit

    def inserted(self) -> Iterator[tuple]:
        while self._audit[self._at : self._at + 1] == "I":
            self._at += 1
            initial = WRITES[self._state]
            yield self._row(None, ROLES[initial], "", "I", initial)

    def message(self, turn, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self._audit[self._at]
        self._at += 1
        if edit == "K":
            yield self._row(turn, role, text, edit, role[0])
        elif edit == "R":
            initial = WRITES[self._state]
            yield self._row(turn, ROLES[initial], text, edit, initial)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current = None
    for batch in batches:
        out = []
        for conv_id, part, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if part == 0:
                if current is not None:
                    out.extend(current.inserted())
                current = _Repair(conv_id, text)
            else:
                out.extend(current.message(turn, role, text))
        yield _table(out, REPAIRED)
    if current is not None:
        yield _table(list(current.inserted()), REPAIRED)


# --- digests --------------------------------------------------------------------

def repaired_digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` over ``role:text``, joined by newlines.

    Takes what :func:`repair` gives as it comes, in order; a text is hashed as it
    passes. Conversations that have nothing left are not among the rows.
    """
    return repaired.select("conv_id", "role", "text").mapInArrow(
        _hash, "conv_id bigint, repaired_sha256 string"
    )


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ddl = "conv_id bigint, repaired_sha256 string"
    current, digest = None, None
    for batch in batches:
        out = []
        for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if digest is None or conv_id != current:
                if digest is not None:
                    out.append((current, digest.hexdigest()))
                current, digest = conv_id, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield _table(out, ddl)
    if digest is not None:
        yield _table([(current, digest.hexdigest())], ddl)


def audits_with_digests(rows: DataFrame) -> DataFrame:
    """:func:`audits`, and the digest of each repaired conversation."""
    audited = stored(audits(rows), "audits")
    digests = repaired_digests(repair(rows, audited)).withColumnRenamed("conv_id", "_conv_id")
    return (
        audited.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left")
        .drop("_conv_id")
        .withColumn(
            "repaired_sha256",
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())),
        )
    )
