import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from starfold.llm import dialogue
from starfold.llm.queries import damaged, op13_conversation_repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(turns):
    """Cost and letters by trying all edits, cheapest first, letters as text."""
    heap = [(0, "", 0, "")]
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if at > len(turns):
            return cost, audit
        if at == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
            heapq.heappush(heap, (cost, audit, at + 1, roles))
        ways = [(3, "I", at, role) for role in "ua"]
        if at < len(turns):
            initial, fault = turns[at]
            ways.append((4, "D", at + 1, ""))
            if fault not in (dialogue.BLANK, dialogue.DUPLICATE):
                extra = 3 * (fault == dialogue.TRUNCATED)
                ways.append((extra, "K", at + 1, initial or "?"))
                ways += [(3 + extra, "R", at + 1, role) for role in "ua"]
        for more, letter, goes, role in ways:
            if re.fullmatch("s?(ua)*u?", roles + role):
                heapq.heappush(heap, (cost + more, audit + letter, goes, roles + role))


def plain(rows):
    """A conversation (turn, role, text), repaired without Spark."""
    rows = sorted(
        ((turn, " " if role is None else role, " " if text is None else text) for turn, role, text in rows),
        key=lambda row: (row[0] is not None, row[0] or 0, row[1], hashlib.md5(row[2].encode()).digest()),
    )
    faults, seen = [], set()
    for _, role, text in rows:
        end = text.strip(" \t\n\x0b\x0c\r")[-1:]
        faults.append(1 if not end else 2 if (role, text) in seen else 0 if end in ".!?" else 3)
        seen.add((role, text))
    numbered = [row[0] for row in rows if row[0] is not None]
    gaps = max(numbered) - min(numbered) + 1 - len(set(numbered)) if numbered else 0
    initials = [row[1][:1] for row in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest(list(zip(initials, faults)))
    left, at, previous = [], 0, ""
    for letter in audit:
        new = "user" if previous != "u" else "assistant"
        if letter == "I":
            role, text = new, ""
        else:
            _, role, text = rows[at]
            at += 1
            if letter == "D":
                continue
            role = new if letter == "R" else role
        previous = role[0]
        left.append((role, text))
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in left).encode()).hexdigest()
    return (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, digest), left


@pytest.mark.parametrize("seed", range(6))
def test_numbers_decide_as_trying_all_edits_does(seed):
    draws = random.Random(seed)
    for _ in range(40):
        turns = [(draws.choice(["s", "u", "a", "u", "a", "x", ""]), draws.choice([0, 0, 0, 1, 2, 3])) for _ in range(draws.randint(0, 6))]
        want = cheapest(turns)
        for cut in (1, 2, 9):
            assert dialogue.chained([dialogue.ways(tuple(turns[i : i + cut])) for i in range(0, len(turns), cut)]) == want


def test_pieces_chain_as_the_whole():
    draws = random.Random(9)
    turns = tuple((draws.choice("suauax"), draws.choice([0, 0, 0, 1, 2, 3])) for _ in range(600))
    whole = dialogue.chained([dialogue.ways(turns)])
    for cut in (1, 7, 256):
        assert dialogue.chained([dialogue.ways(turns[i : i + cut]) for i in range(0, 600, cut)]) == whole


def test_known_repairs():
    assert cheapest([("u", 0), ("a", 0)]) == (0, "KK") == dialogue.chained([dialogue.ways((("u", 0), ("a", 0)))])
    # Deleting one of two user turns costs more than inserting an assistant turn or changing a role.
    assert dialogue.chained([dialogue.ways((("u", 0), ("u", 0), ("a", 0), ("a", 0)))]) == (6, "KIKKIK")
    assert dialogue.chained([dialogue.ways((("s", 0),))]) == (4, "D")
    assert dialogue.chained([]) == (0, "")


def conversations(spark, seed, count=40):
    draws = random.Random(seed)
    texts = ["Yes.", "No", "", " \n", None, "What?", "Go on!", "open end", "Yes.", "é.\x0b"]
    rows = []
    for conv in range(count):
        for turn in range(draws.choice([0, 1, 2, 3, 5])):
            number = None if draws.random() < 0.1 else turn + draws.choice([0, 0, 0, 1, 3])
            rows.append((conv if conv else None, number, draws.choice(["user", "assistant", "system", "user", "assistant", None, "tool", ""]), draws.choice(texts)))
    rows += rows[:5]
    return spark.createDataFrame(rows, SCHEMA), rows


def repaired(spark, frame):
    turns, decisions = dialogue.repair(frame)
    digests = {row.conv_id: row.repaired_sha256 for row in dialogue.repaired_as(turns, decisions, dialogue.digest_row, dialogue.DIGEST).collect()}
    left = {}
    for row in dialogue.repaired_as(turns, decisions).orderBy("conv_id", "place").collect():
        assert row.place == len(left.setdefault(row.conv_id, []))
        left[row.conv_id].append((row.role, row.text))
    found = {row["__conv"]: (*(row[name] for name in dialogue.SUMMARY), row.audit, digests[row["__conv"]]) for row in decisions.collect()}
    assert set(found) == set(digests) >= set(left)
    return found, left


@pytest.mark.parametrize("piece", [1, 2, 256])
def test_awkward_conversations(spark, monkeypatch, piece):
    monkeypatch.setattr(dialogue, "PIECE", piece)
    frame, rows = conversations(spark, piece)
    found, left = repaired(spark, frame.withColumn("audit", F.lit("taken")).withColumn("cost", F.lit(-1)))
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(row)
    assert set(found) == set(groups)
    for conv, group in groups.items():
        want, turns = plain(group)
        assert found[conv] == want, conv
        assert left.get(conv, []) == turns
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in turns))


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(dialogue, "PIECE", 16)
    draws = random.Random(4)
    rows = [(7, i // 2, draws.choice(["user", "assistant"]), draws.choice(["Yes.", f"word {i}.", f"open {i}"])) for i in range(900)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    pieces = dialogue.in_pieces(dialogue.marked(dialogue.turns_of(frame, "conv_id", "turn", "role", "text")))
    assert pieces.count() > 900 // 16
    found, left = repaired(spark, frame)
    order = sorted(rows, key=lambda row: (row[1], row[2], hashlib.md5(row[3].encode()).digest()))
    seen, turns = set(), []
    for _, _, role, text in order:
        turns.append((role[0], 2 if (role, text) in seen else 0 if text.endswith(".") else 3))
        seen.add((role, text))
    assert found[7][5:7] == dialogue.chained([dialogue.ways(tuple(turns))])
    assert "".join(role[0] for role, _ in left[7]) == "ua" * (len(left[7]) // 2)


def test_nothing_at_all(spark):
    found, left = repaired(spark, spark.createDataFrame([], SCHEMA))
    assert found == {} and left == {}


def test_long_text(spark):
    long = "so it goes on. " * 200_000
    found, left = repaired(spark, spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", "Yes.")], SCHEMA))
    assert found[1][5:7] == (0, "KK") and left[1] == [("user", long), ("assistant", "Yes.")]


def harmed(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if value is None else value for value in (role, text))
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm == 4:
            role = "user"
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(harm, 1)


def test_damage(spark):
    frame, rows = conversations(spark, 11, 200)
    key = [str(row) for row in harmed(rows)]
    assert sorted(str(tuple(row)) for row in damaged(frame).collect()) == sorted(key)


def test_query(spark):
    groups = {}
    rows = [tuple(row) for row in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    for conv, *row in harmed(rows):
        groups.setdefault(conv, []).append(row)
    found = {row.conv_id: tuple(row)[1:] for row in op13_conversation_repair(spark, SF).collect()}
    assert set(found) == {row[0] for row in rows}
    for conv, values in found.items():
        assert values == plain(groups.get(conv, []))[0]
