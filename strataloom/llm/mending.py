"""Conversation structure repair by Hirschberg's divide and conquer.

The cheapest edits make the role initials of a conversation match ``(s?(ua)+)?``.  How
far a prefix has come is one of four states (nothing, after system, after user, after
assistant), so a prefix is known by four costs.  Costs from the front and costs from the
back meet in the middle; the best state to cross in is taken, and both halves are solved
the same way between fixed states.  Only the four costs of two fronts are held at a time,
never a table of all rows.

Of equally cheap edits the least audit is wanted.  Beside its cost a state carries the
rank of its least audit among the four.  Two audits of one prefix end in its last row's
edit and differ before that, so ranks are enough to order what follows.

A conversation may be longer than a task should hold.  Rows are dealt by ranges of
(conversation, turn) and cut into blocks.  A block is summed up by the four fronts it
leads to from each of the four states; the same meeting of front and back, over these
summaries, fixes the states at its borders, and then every block is solved on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_batch, stored

NEVER = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ENDS = (START, ASSISTANT)
# Costs of an edit; a row that stays although cut off costs one more.
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
TURN_INTO = {USER: "user", ASSISTANT: "assistant"}
# What may follow each state besides system.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
SPACE = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")


@dataclass(frozen=True)
class Settings:
    """``block``: rows of a conversation that are solved in one piece."""

    block: int = 4096


# A row is one character: its role's initial (or another one as x) with what is wrong.
def kind_of(initial: str, gone: bool, cut_off: bool) -> str:
    return chr(ord("A") + "suax".index(initial if initial in ("s", "u", "a") else "x") * 3 + (1 if gone else 2 * cut_off))


def kept_state(state: int, initial: str) -> int | None:
    """The state after a kept row, None if it may not follow."""
    if initial == "s":
        return SYSTEM if state == START else None
    after = NEXT[state]
    return after if initial == {USER: "u", ASSISTANT: "a"}[after] else None


@cache
def steps(kind: str) -> tuple[tuple[tuple[int, int, str], ...], ...]:
    """Per state reached by a row: (state before, cost, audit) of the cheapest way there."""
    which, wrong = divmod(ord(kind) - ord("A"), 3)
    initial, must_go, cut_off = "suax"[which], wrong == 1, CUT_OFF * (wrong == 2)
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in STATES:
        state = before
        for inserts in range(4):
            ways = [(state, DELETE, "D")]
            if not must_go:
                ways.append((NEXT[state], REROLE + cut_off, "R"))
                if (after := kept_state(state, initial)) is not None:
                    ways.append((after, cut_off, "K"))
            for after, cost, edit in ways:
                way = cost + INSERT * inserts, "I" * inserts + edit
                best[before, after] = min(best.get((before, after), way), way)
            state = NEXT[state]
    return tuple(
        tuple((b, *best[b, after]) for b in STATES if (b, after) in best) for after in STATES
    )


@cache
def tail(state: int) -> int:
    """Inserts after the last row."""
    n = 0
    while state not in ENDS:
        state, n = NEXT[state], n + 1
    return n


Front = tuple[list[int], list[int]]


def opened(state: int) -> Front:
    return [0 if s == state else NEVER for s in STATES], [0] * 4


def _ranked(found: list[tuple]) -> list[int]:
    order = {key: i for i, key in enumerate(sorted(found))}
    return [order[key] for key in found]


def forward(kinds: str, front: Front) -> Front:
    """Costs and audit ranks of the four states after ``kinds``."""
    for kind in kinds:
        cost, rank = front
        ways = [
            min((cost[b] + c, rank[b], audit) for b, c, audit in into) if into else (NEVER, 0, "")
            for into in steps(kind)
        ]
        front = [min(w[0], NEVER) for w in ways], _ranked([w[1:] for w in ways])
    return front


def backward(kinds: str, costs: list[int]) -> list[int]:
    """Cheapest costs from each state before ``kinds`` to the costs after it."""
    for kind in reversed(kinds):
        before = [NEVER] * 4
        for after, into in enumerate(steps(kind)):
            for b, c, _ in into:
                before[b] = min(before[b], c + costs[after])
        costs = before
    return costs


def crossing(front: Front, back: list[int]) -> int:
    """The state of a cheapest way; of several the one with the least audit so far."""
    return min(STATES, key=lambda s: (min(front[0][s] + back[s], NEVER), front[1][s]))


def edits(kinds: str, start: int, end: int) -> str:
    """The audit of the cheapest way from ``start`` to ``end``, in linear space."""
    if len(kinds) == 1:
        return next(audit for b, _, audit in steps(kinds)[end] if b == start)
    mid = len(kinds) // 2
    meet = crossing(forward(kinds[:mid], opened(start)), backward(kinds[mid:], opened(end)[0]))
    return edits(kinds[:mid], start, meet) + edits(kinds[mid:], meet, end)


# -- over many blocks ------------------------------------------------------------


def summary(kinds: str) -> tuple[list[int], list[int]]:
    """Costs and ranks from each of the four states, 16 numbers each."""
    fronts = [forward(kinds, opened(s)) for s in STATES]
    return [c for f in fronts for c in f[0]], [r for f in fronts for r in f[1]]


def over_block(front: Front, costs: list[int], ranks: list[int]) -> Front:
    """``forward`` over a whole block, by its summary."""
    ways = []
    for after in STATES:
        ways.append(min((front[0][b] + costs[4 * b + after], front[1][b], ranks[4 * b + after]) for b in STATES))
    return [min(w[0], NEVER) for w in ways], _ranked([w[1:] for w in ways])


def borders(costs: list[list[int]], ranks: list[list[int]]) -> list[int]:
    """The states before, between and after the blocks of one conversation."""

    def back(lo: int, hi: int, after: list[int]) -> list[int]:
        for at in range(hi - 1, lo - 1, -1):
            after = [min(min(costs[at][4 * b + s] + after[s] for s in STATES), NEVER) for b in STATES]
        return after

    def front(lo: int, hi: int, start: int) -> Front:
        found = opened(start)
        for at in range(lo, hi):
            found = over_block(found, costs[at], ranks[at])
        return found

    ends = [INSERT * tail(s) for s in STATES]
    states = [START] + [START] * len(costs)
    states[-1] = crossing(front(0, len(costs), START), ends)
    todo = [(0, len(costs))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo > 1:
            mid = (lo + hi) // 2
            states[mid] = crossing(front(lo, mid, states[lo]), back(mid, hi, opened(states[hi])[0]))
            todo += [(lo, mid), (mid, hi)]
    return states


# -- rows --------------------------------------------------------------------------


def conversation_key(conv: str) -> Column:
    """A key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))


def named_turns(turns: DataFrame) -> DataFrame:
    """``conv, turn, role, text, same``; NULL role and text are one space, ``same`` names both."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return turns.select(
        conversation_key("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("same"),
    )


# Ascending order has NULL first.
ORDER = ["conv", "turn", "same"]
BLOCK = (
    "conv string, part int, seq int, kinds string, first string, last string, blank long, "
    "duplicate long, truncated long, illegal long, costs array<long>, ranks array<int>"
)


def blocks(rows: DataFrame, settings: Settings) -> DataFrame:
    """The rows of all conversations without their texts, in blocks with summaries."""
    said = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    at = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    light = rows.select(
        "conv", "turn", "same", F.substring("role", 1, 1).alias("initial"),
        (F.length(said) == 0).alias("blank"), (~F.substring(said, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    again = light.groupBy(F.col("conv").alias("of"), F.col("same").alias("what")).agg(
        F.min(at).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    later = F.coalesce(at > F.col("first"), F.lit(False))
    marked = light.join(again, (F.col("conv") == F.col("of")) & (F.col("same") == F.col("what")), "left").select(
        *light.columns, later.alias("later")
    )
    dealt = marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    schema = pa.schema([
        ("conv", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("kinds", pa.string()),
        ("first", pa.string()), ("last", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()),
        ("truncated", pa.int64()), ("illegal", pa.int64()), ("costs", pa.list_(pa.int64())),
        ("ranks", pa.list_(pa.int32())),
    ])
    longest = settings.block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, conv, before, held = TaskContext.get().partitionId(), 0, None, None, []

        def block() -> tuple:
            kinds, initials = "".join(h[0] for h in held), [h[1] for h in held]
            faults = [h[2] for h in held]
            bad = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            return (
                conv, part, seq, kinds, initials[0], initials[-1], faults.count(1), faults.count(2),
                faults.count(3), bad, *summary(kinds),
            )

        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                own, turn, same, initial, blank, unended, seen = row
                if held and (own != conv or len(held) >= longest):
                    out.append(block())
                    held, seq = [], seq + 1
                seen = seen or (own, turn, same) == before
                fault = 1 if blank else 2 if seen else 3 if unended else 0
                held.append((kind_of(initial, fault in (1, 2), fault == 3), initial, fault))
                conv, before = own, (own, turn, same)
            if out:
                yield as_batch(out, schema)
        if held:
            yield as_batch([block()], schema)

    return stored(dealt.mapInArrow(run, BLOCK), "conversation-blocks")


BORDERS = (
    "conv string, part int, seq int, start int, end int, last boolean, piece string, cost long, "
    "illegal long, blank long, duplicate long, truncated long"
)


def block_edits(kinds: str, start: int, end: int, last: bool) -> str:
    return edits(kinds, start, end) + "I" * (tail(end) if last else 0)


def bordered(blocks: DataFrame) -> DataFrame:
    """Per block the states at both ends, from the summaries of its conversation.

    A conversation of one block is solved at once; the others have no ``piece`` yet.
    """
    names = [c.split()[0] for c in BORDERS.split(", ")]
    kinds = {"conv": pa.string(), "piece": pa.string(), "last": pa.bool_()}
    kinds |= {c: pa.int32() for c in ("part", "seq", "start", "end")}
    schema = pa.schema([(c, kinds.get(c, pa.int64())) for c in names])

    def solve(rows: list[dict]) -> Iterator[tuple]:
        states = borders([r["costs"] for r in rows], [r["ranks"] for r in rows])
        alone, before = len(rows) == 1, None
        for r, start, end in zip(rows, states, states[1:]):
            last = r is rows[-1]
            yield (
                r["conv"], r["part"], r["seq"], start, end, last,
                block_edits(r["kinds"], start, end, last) if alone else None,
                r["costs"][4 * start + end] + (INSERT * tail(end) if last else 0),
                r["illegal"] + (before is not None and before + r["first"] not in LEGAL),
                r["blank"], r["duplicate"], r["truncated"],
            )
            before = r["last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        rows, out = (row for batch in batches for row in batch.to_pylist()), []
        for _, own in groupby(rows, key=lambda r: r["conv"]):
            out += solve(list(own))
            if len(out) >= 1000:
                yield as_batch(out, schema)
                out = []
        if out:
            yield as_batch(out, schema)

    dealt = blocks.repartition("conv").sortWithinPartitions("conv", "part", "seq")
    return stored(dealt.mapInArrow(run, BORDERS), "conversation-borders")


def solved(rows: DataFrame, settings: Settings) -> DataFrame:
    """``BORDERS`` with every block's piece of the audit."""
    cut = blocks(rows, settings)
    ends = bordered(cut)
    names = [c.split()[0] for c in BORDERS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(n).to_pylist() for n in ("kinds", "start", "end", "last")}
            pieces = pa.array([block_edits(*x) for x in zip(*column.values())], pa.string())
            yield pa.RecordBatch.from_arrays([pieces if n == "piece" else batch.column(n) for n in names], names)

    key = ["conv", "part", "seq"]
    open_ = ends.where("piece IS NULL").join(cut.select(*key, "kinds"), key).select(*names, "kinds")
    return stored(ends.where("piece IS NOT NULL").unionAll(open_.mapInArrow(run, BORDERS)), "conversation-edits")


def applied(audit: Iterator[str], rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Repaired (role, text) of one conversation's rows, one by one."""
    state = START

    def inserted() -> tuple[str, str]:
        return TURN_INTO[NEXT[state]], ""

    for role, text in rows:
        for edit in audit:
            if edit != "I":
                break
            yield inserted()
            state = NEXT[state]
        if edit == "K":
            state = kept_state(state, role[:1])
            yield role, text
        elif edit == "R":
            state = NEXT[state]
            yield TURN_INTO[state], text
    for _ in audit:
        yield inserted()
        state = NEXT[state]


def _ordered(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Each conversation's pieces of audit followed by its rows; one shuffle of the texts."""
    none = F.lit(None)
    pieces = done.select(
        "conv", F.lit(0).alias("what"), "part", "seq", none.cast("long").alias("turn"),
        none.cast("string").alias("same"), "piece", none.cast("string").alias("text"),
    )
    texts = rows.select(
        "conv", F.lit(1).alias("what"), F.lit(0).alias("part"), F.lit(0).alias("seq"), "turn", "same",
        F.col("role").alias("piece"), "text",
    )
    order = ["conv", "what", "part", "seq", "turn", "same"]
    both = pieces.unionAll(texts).repartition("conv").sortWithinPartitions(*order)
    return both.select("conv", "what", "piece", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, Iterator]]:
    """(conversation, audit, its rows); rows are read as they are asked for."""
    from itertools import groupby

    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for conv, own in groupby(rows, key=lambda r: r[0]):
        pieces, first = [], None
        for row in own:
            if row[1]:
                first = row
                break
            pieces.append(row[2])
        yield conv, "".join(pieces), _texts(first, own)


def _texts(first: tuple, rest: Iterator[tuple]) -> Iterator[tuple[str, str]]:
    yield first[2:]
    for row in rest:
        yield row[2:]


def repaired_turns(turns: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``conv_id (as text), position, role, text``: the rows of the repaired conversations.

    Rows are taken as in ``repair``.  A conversation without conv_id has it NULL here.
    """
    rows = named_turns(turns)
    schema = pa.schema([("conv", pa.string()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, audit, texts in _conversations(batches):
            for n, (role, text) in enumerate(applied(iter(audit), texts)):
                out.append((conv, n, role, text))
                if len(out) >= 1000:
                    yield as_batch(out, schema)
                    out = []
        if out:
            yield as_batch(out, schema)

    out = _ordered(rows, solved(rows, settings)).mapInArrow(run, "conv string, position long, role string, text string")
    return out.select(F.nullif(F.expr("substring(conv, 2)"), F.when(F.col("conv") == "", "")).alias("conv_id"), "position", "role", "text")


def repair(turns: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired text, per conversation.

    ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``,
    ``conv`` being ``conversation_key``.  Rows are taken by turn, NULL first, equal turns
    by a digest of role and text, so repeated rows are neighbours.  A NULL role or text
    is one space; rows without conv_id are one conversation.  A row's first fault counts:
    blank, duplicate (role and text seen earlier) or truncated (last character other than
    white space not one of ``.!?``).  Keep costs 0, rerole 2, delete 3 (required for blank
    and duplicate rows), insert an empty turn 2, an undeleted truncated row 1 more.
    ``audit`` has one letter per edit, the least of all cheapest.  Conversations without
    rows are not returned.

    Edits are found without the texts, in blocks.  The texts are shuffled once, for the
    digest, which reads a conversation from its first to its last character as it must.
    """
    rows = named_turns(turns)
    done = solved(rows, settings)
    schema = pa.schema([("conv", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, audit, texts in _conversations(batches):
            digest, apart = sha256(), b""
            for role, text in applied(iter(audit), texts):
                digest.update(apart + f"{role}:{text}".encode())
                apart = b"\n"
            out.append((conv, audit, digest.hexdigest()))
            if len(out) >= 1000:
                yield as_batch(out, schema)
                out = []
        if out:
            yield as_batch(out, schema)

    texts = _ordered(rows, done).mapInArrow(run, "conv string, audit string, repaired_sha256 string")
    sums = done.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")])
    turns_of = rows.where("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1).alias("one"))
    gaps = turns_of.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    return texts.join(sums, "conv").join(gaps, "conv", "left").select(
        "conv", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), "blank", "duplicate", "truncated",
        "illegal", "cost", "audit", "repaired_sha256",
    )


# -- the query ------------------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """Rows spoiled by crc32 of ``conv_id:turn`` modulo 20 (NULL: one space): 0 is dropped, 1
    loses its text, 2 its ``.!?``, 3 comes twice, 4 is said by the user."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = (
        F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    times = F.when(F.col("lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    known = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), lot.alias("lot"))
    return known.where("lot <> 0").select(
        "conv_id", "turn", F.when(F.col("lot") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(times).alias("time"),
    ).drop("time")


def repair_damaged(turns: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``repair`` after ``damaged``, with every conv_id of ``turns``, one without rows too."""
    found = repair(damaged(turns), settings)
    ids = turns.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    joined = ids.join(found, conversation_key("conv_id") == F.col("conv"), "left")
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
