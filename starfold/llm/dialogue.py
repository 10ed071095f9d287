"""Repair of conversations: the cheapest edits that leave an optional system turn and then pairs of user and assistant.

Turns are taken in order (nulls first; turns of one number by role, then by the text's MD5) and have at most one fault: blank
(nothing but ASCII white space), duplicate (role and text seen earlier in the conversation), truncated (last mark is none of
``.!?``). Edits: K keep (0), R rerole to user or assistant (3), D delete (4; the only way with blank and duplicate turns),
I insert an empty user or assistant turn (3); a truncated turn that stays costs 3 more. The role initials of what is left must
be ``(s?(ua)+)?``. Among the cheapest ways the one with the least string of edit letters is taken.

Both are decided by one number. An edit weighs its cost, shifted above all letters, plus its letter's digit at the letter's
place in a string of fixed width; places not used are zero. So the least sum along the paths of the graph (place in the
conversation, what the roles so far ask for) has the least cost and, of those, the least letters. The integers are as wide as
they need to be. Two paths to one node differ in a letter before either ends: the letters fix the roles, and a path that went
on with insertions alone would come back to the node at a higher cost. So a node needs its least number only.

A conversation may hold much of the table: its turns are sorted by range, without texts, over all tasks, cut into pieces of at
most ``PIECE`` turns, and each piece gives its least number from every state to every other. One task then chains a
conversation's pieces; it holds letters, not texts. Texts meet their letters in order, as a stream, however long.

Null role and text are one space; a role without a first character fits nowhere and is reroled or deleted. A null conversation
id is a conversation. Turns without number count for no gap. Conversations without turns have zeros and no letters.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.llm.recovery import written

SPACES = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, REROLE, INSERT, DELETE, CUT_OFF = 0, 3, 3, 4, 3
LEGAL = {"su", "ua", "au"}
PIECE = 256

# What the roles so far are: none, a system turn, up to a user turn, up to an assistant turn; and what may follow.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
WANTED = {NOTHING: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
COMPLETE = (NOTHING, ASSISTANT)
# Digits in ASCII order of the letters, zero for places not used.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = {digit: letter for letter, digit in DIGITS.items()}
BITS = 3

# The least number of a node, and how many letters it has.
Best = tuple[int, int]


class Scale:
    """Weights for strings of at most ``width`` letters."""

    def __init__(self, width: int) -> None:
        self.width = width

    def add(self, best: Best, cost: int, letters: str) -> Best:
        number, used = best
        digits = 0
        for letter in letters:
            digits = digits << BITS | DIGITS[letter]
        used += len(letters)
        return number + (cost << BITS * self.width) + (digits << BITS * (self.width - used)), used

    def read(self, best: Best) -> tuple[int, str]:
        """Cost and letters."""
        number, used = best
        digits = (number & ((1 << BITS * self.width) - 1)) >> BITS * (self.width - used)
        # Three bits are an octal digit.
        text = f"{digits:o}" if used else ""
        return number >> BITS * self.width, text.translate(_OCTAL)


_OCTAL = {ord(str(digit)): letter for digit, letter in LETTERS.items()}


def least(reached: dict[int, Best], state: int, best: Best) -> None:
    if state not in reached or best < reached[state]:
        reached[state] = best


def with_inserts(reached: dict[int, Best], scale: Scale) -> dict[int, Best]:
    """States reached with none, one or two insertions; a third would only come back to where one led."""
    found, last = dict(reached), reached
    for _ in range(2):
        fresh: dict[int, Best] = {}
        for state, best in last.items():
            least(fresh, NEXT[state][WANTED[state]], scale.add(best, INSERT, "I"))
        for state, best in fresh.items():
            least(found, state, best)
        last = fresh
    return found


def after_turn(reached: dict[int, Best], initial: str, fault: int, scale: Scale) -> dict[int, Best]:
    """States after the insertions before a turn and the turn itself."""
    found: dict[int, Best] = {}
    for state, best in with_inserts(reached, scale).items():
        least(found, state, scale.add(best, DELETE, "D"))
        if fault in (BLANK, DUPLICATE):
            continue
        extra = CUT_OFF if fault == TRUNCATED else 0
        if initial in NEXT[state]:
            least(found, NEXT[state][initial], scale.add(best, KEEP + extra, "K"))
        least(found, NEXT[state][WANTED[state]], scale.add(best, REROLE + extra, "R"))
    return found


Way = tuple[int, int, int, str]


@functools.lru_cache(1 << 13)
def ways(turns: tuple[tuple[str, int], ...]) -> list[Way]:
    """From each state to each other over a piece of turns (initial, fault): from, to, cost, letters."""
    scale, found = Scale(3 * len(turns)), []
    for start in NEXT:
        reached = {start: (0, 0)}
        for initial, fault in turns:
            reached = after_turn(reached, initial, fault, scale)
        found += [(start, state, *scale.read(best)) for state, best in reached.items()]
    return found


def chained(pieces: list[list[Way]]) -> tuple[int, str]:
    """Cost and letters of the cheapest way through all pieces of a conversation."""
    scale = Scale(sum(max((len(way[3]) for way in piece), default=0) for piece in pieces) + 2)
    reached = {NOTHING: (0, 0)}
    for piece in pieces:
        found: dict[int, Best] = {}
        for start, state, cost, letters in piece:
            if start in reached:
                number, used = reached[start]
                end = used + len(letters)
                digits = int(letters.translate(_DIGITS), 8) << BITS * (scale.width - end)
                least(found, state, (number + (cost << BITS * scale.width) + digits, end))
        reached = found
    reached = with_inserts(reached, scale)
    return scale.read(min(reached[state] for state in COMPLETE if state in reached))


_DIGITS = {ord(letter): str(digit) for letter, digit in DIGITS.items()}


WAYS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("state", T.IntegerType()), T.StructField("cost", T.LongType()),
    T.StructField("letters", T.StringType()),
]))
COUNTS = ("blank", "duplicate", "truncated", "illegal")
ORDER = ("__turn", "__role", "__md5")


def turns_of(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return rows.select(
        F.col(conv).alias("__conv"), F.col(turn).cast("long").alias("__turn"), F.coalesce(role, F.lit(" ")).alias("__role"),
        F.coalesce(text, F.lit(" ")).alias("__text"),
    ).withColumn("__md5", F.unhex(F.md5(F.col("__text").cast("binary"))))


def marked(turns: DataFrame) -> DataFrame:
    """Turns without their texts, with their fault but for copies within one turn number."""
    end = F.substring(F.rtrim("__text", F.lit(SPACES)), -1, 1)
    narrow = turns.select(
        "__conv", *ORDER, F.when(end == "", BLANK).when(end.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED).alias("__fault")
    )
    # A struct with a null in it is no null, and the least one.
    first = narrow.groupBy(F.col("__conv").alias("__c"), F.col("__role").alias("__r"), F.col("__md5").alias("__m")).agg(
        F.min(F.struct("__turn")).alias("__first")
    )
    same = F.col("__conv").eqNullSafe(F.col("__c")) & (F.col("__role") == F.col("__r")) & (F.col("__md5") == F.col("__m"))
    later = ~F.col("__turn").eqNullSafe(F.col("__first.__turn"))
    met = narrow.join(first, same)
    fault = F.when((F.col("__fault") != BLANK) & later, DUPLICATE).otherwise(F.col("__fault"))
    return met.select("__conv", *ORDER, fault.alias("__fault"))


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def in_pieces(turns: DataFrame) -> DataFrame:
    """Turns in order, cut into pieces with their ways and what is counted over them."""
    conv = turns.schema["__conv"].dataType
    fields = [
        T.StructField("__conv", conv), *(turns.schema[name] for name in ORDER), T.StructField("__number", T.LongType()),
        T.StructField("__last_turn", T.LongType()), T.StructField("__least_turn", T.LongType()),
        T.StructField("__turns", T.LongType()), T.StructField("__first_initial", T.StringType()),
        T.StructField("__last_initial", T.StringType()), *(T.StructField(name, T.LongType()) for name in COUNTS),
        T.StructField("__ways", WAYS),
    ]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])

    def piece(rows: list[tuple], number: int) -> dict:
        initials, faults = [row[2][:1] for row in rows], [row[4] for row in rows]
        numbered = [row[1] for row in rows if row[1] is not None]
        values = (
            *rows[0][:4], number, rows[-1][1], min(numbered, default=None), len(set(numbered)), initials[0], initials[-1],
            faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED),
            sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            [dict(zip(WAYS.elementType.names, way)) for way in ways(tuple(zip(initials, faults)))],
        )
        return dict(zip(schema.names, values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, number, ready = [], None, 0, []
        for row in rows_of(batches):
            if held and (row[0] != held[0][0] or len(held) == PIECE):
                ready.append(piece(held, number))
                number, held = number + 1, []
                if len(ready) == PIECE:
                    yield to_batch(ready)
                    ready = []
            if before is not None and row[:4] == before[:4] and row[4] != BLANK:
                row = (*row[:4], DUPLICATE)
            held.append(row)
            before = row
        if held:
            ready.append(piece(held, number))
        if ready:
            yield to_batch(ready)

    arrow = arrow_schema(schema)

    def to_batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, arrow)

    ordered = turns.repartitionByRange("__conv", *ORDER).sortWithinPartitions("__conv", *ORDER)
    return ordered.mapInArrow(run, schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


SUMMARY = ("gaps", *COUNTS, "cost")


def decided(pieces: DataFrame) -> DataFrame:
    """One row per conversation that has turns: ``__conv``, counts, ``cost`` and ``audit``."""
    fields = [pieces.schema["__conv"], *(T.StructField(name, T.LongType()) for name in SUMMARY)]
    schema = T.StructType([*fields, T.StructField("audit", T.StringType())])
    names, arrow = pieces.columns, arrow_schema(schema)

    def summary(rows: list[dict]) -> dict:
        numbered = [row for row in rows if row["__least_turn"] is not None]
        gaps = 0
        if numbered:
            shared = sum(a["__last_turn"] == b["__least_turn"] for a, b in zip(numbered, numbered[1:]))
            distinct = sum(row["__turns"] for row in numbered) - shared
            gaps = numbered[-1]["__last_turn"] - numbered[0]["__least_turn"] + 1 - distinct
        counts = {name: sum(row[name] for row in rows) for name in COUNTS}
        counts["illegal"] += sum(
            a["__last_initial"] + b["__first_initial"] not in LEGAL for a, b in zip(rows, rows[1:])
        )
        cost, audit = chained([[tuple(way.values()) for way in row["__ways"]] for row in rows])
        return {"__conv": rows[0]["__conv"], "gaps": gaps, **counts, "cost": cost, "audit": audit}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            ready = []
            for values in rows_of([batch]):
                row = dict(zip(names, values))
                if held and row["__conv"] != held[0]["__conv"]:
                    ready.append(summary(held))
                    held = []
                held.append(row)
            if ready:
                yield pa.RecordBatch.from_pylist(ready, arrow)
        if held:
            yield pa.RecordBatch.from_pylist([summary(held)], arrow)

    order = ["__conv", *ORDER, "__number"]
    return pieces.repartition("__conv").sortWithinPartitions(*order).mapInArrow(run, schema)


def repaired(audit: str, turns: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """Letter, role and text of what is left, given the letters and the turns (role, text) in order."""
    state, at = NOTHING, 0

    def made(letter: str, role: str, text: str) -> tuple[str, str, str]:
        nonlocal state
        if letter != "K":
            role = ROLES[WANTED[state]]
        state = NEXT[state][role[:1]]
        return letter, role, text

    for role, text in turns:
        while audit[at] == "I":
            yield made("I", "", "")
            at += 1
        if audit[at] != "D":
            yield made(audit[at], role, text)
        at += 1
    for letter in audit[at:]:
        yield made(letter, "", "")


def turn_rows(conv, parts: Iterable[tuple[str, str, str]]) -> Iterator[tuple]:
    """The turns left of a conversation: id, new number, role, text, letter."""
    for place, (letter, role, text) in enumerate(parts):
        yield conv, place, role, text, letter


def digest_row(conv, parts: Iterable[tuple[str, str, str]]) -> Iterator[tuple]:
    """The SHA-256 of ``role:text`` lines of a conversation."""
    total, first = hashlib.sha256(), True
    for _, role, text in parts:
        total.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        first = False
    yield conv, total.hexdigest()


TURNS = "place long, role string, text string, edit string"
DIGEST = "repaired_sha256 string"


def repaired_as(
    turns: DataFrame, decisions: DataFrame, made: Callable[..., Iterator[tuple]] = turn_rows, columns: str = TURNS
) -> DataFrame:
    """What ``made`` makes of every conversation of ``decisions`` (``__conv``, ``audit``), from its turns as a stream."""
    kind = turns.schema["__conv"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T.DataType.fromDDL(columns)])
    nothing = [F.lit(None).cast(turns.schema[name].dataType).alias(name) for name in (*ORDER, "__text")]
    heads = decisions.select("__conv", F.lit(0).alias("__kind"), *nothing, "audit")
    rows = turns.select("__conv", F.lit(1).alias("__kind"), *ORDER, "__text", F.lit(None).cast("string").alias("audit"))
    both = heads.unionByName(rows).repartition("__conv").sortWithinPartitions("__conv", "__kind", *ORDER)
    both = both.select("__conv", "__kind", "__role", "__text", "audit")
    arrow = arrow_schema(schema)

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        rows = rows_of(batches)
        head = next(rows, None)

        def own() -> Iterator[tuple[str, str]]:
            nonlocal head
            for row in rows:
                if row[1] == 0:
                    head = row
                    return
                yield row[2], row[3]
            head = None

        while head is not None:
            conv, audit = head[0], head[4]
            yield from made(conv, repaired(audit, own()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, size = [], 0
        for row in conversations(batches):
            ready.append(row)
            size += sum(len(value) for value in row if isinstance(value, str))
            if len(ready) == 4096 or size > 1 << 24:
                yield to_batch(ready)
                ready, size = [], 0
        if ready:
            yield to_batch(ready)

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), arrow.types)]
        return pa.RecordBatch.from_arrays(columns, arrow.names)

    return both.mapInArrow(run, schema)


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The turns as compared, and per conversation its counts, cost and edit letters (a written table).

    ``repaired_as(turns, decisions)`` gives the turns that are left.
    """
    turns = turns_of(rows, conv, turn, role, text)
    pieces = written(in_pieces(marked(turns)), "conversation-pieces")
    return turns, written(decided(pieces), "conversation-edits")
