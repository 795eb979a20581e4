"""Conversation repair against a plain search over every target length."""

import collections
import hashlib
import itertools
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import conversations as cv
from sensorlake.llm.catalog import ORACLE, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def plain_align(turns):
    """(cost, audit) of the best alignment of the letters to any string of the grammar, all cells of every table."""
    best = (2 * len(turns), "D" * len(turns))
    for length in range(2, 2 * len(turns) + 4):
        target = ("s" if length % 2 else "") + "ua" * (length // 2)
        table = {(0, 0): (0, "")}
        for i in range(len(turns) + 1):
            for j in range(length + 1):
                ways = [table[0, 0]] if i == j == 0 else []
                t = turns[i - 1] if i else ""
                if i and (i - 1, j) in table:
                    c, a = table[i - 1, j]
                    ways.append((c + 2, a + "D"))
                if j and target[j - 1] != "s" and (i, j - 1) in table:
                    c, a = table[i, j - 1]
                    ways.append((c + 5, a + "I"))
                if i and j and t != "x" and (i - 1, j - 1) in table:
                    c, a = table[i - 1, j - 1]
                    c += 5 * t.isupper()
                    if t.lower() == target[j - 1]:
                        ways.append((c, a + "K"))
                    elif target[j - 1] != "s":
                        ways.append((c + 1, a + "R"))
                if ways:
                    table[i, j] = min(ways)
        best = min(best, table.get((len(turns), length), best))
    return best


def plain_damage(rows):
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv_id, turn)).encode()) % 20
        if h == 1:
            text = ""
        if h == 2:
            text = "".join(c for c in text if c not in ".!?")
        if h == 4:
            role = "user"
        yield from [(conv_id, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)


def plain_report(rows, damaged):
    out, repaired = {}, {}
    own = collections.defaultdict(list)
    for conv_id, turn, role, text in damaged:
        own[conv_id].append((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text))
    for conv_id in {r[0] for r in rows}:
        turns = sorted(own[conv_id])
        faults, letters, seen = [0] * 4, "", set()
        for _, _, role, _, text in turns:
            end = text.rstrip(BLANK)
            fault = 1 if not end else 2 if (role, text) in seen else 3 if end[-1] not in ".!?" else 0
            seen.add((role, text))
            faults[fault] += 1
            letter = "x" if fault in (1, 2) else role[0] if role[:1] in ("s", "u", "a") else "o"
            letters += letter.upper() if fault == 3 else letter
        cost, audit = plain_align(letters)
        left, i = [], 0
        for edit in audit:
            role, text = (None, "") if edit == "I" else (turns[i][2], turns[i][4])
            i += edit != "I"
            if edit != "D":
                left.append((role if edit == "K" else None, text))
        odd = len(left) % 2
        left = [(r if r is not None else ("user", "assistant")[(p - odd) % 2], t) for p, (r, t) in enumerate(left)]
        initials = "".join(r[0] for r, _ in left)
        assert initials == ("s" if odd else "") + "ua" * (len(left) // 2) and len(left) != 1
        known = [t for ok, t, *_ in turns if ok]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in left)
        out[conv_id] = (gaps, *faults[1:], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
        repaired[conv_id] = left
    return out, repaired


def check(spark, rows, damaged=None, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    for extra in ("fault", "dropped", "_id", "seq", "audit", "report"):
        df = df.withColumn(extra, F.lit("x"))
    if damaged is None:
        report = cv.repair_report(cv.damage(df), "dropped", **options)
        turns = cv.repair_turns(cv.damage(df), "dropped", **options)
        damaged = list(plain_damage(rows))
    else:
        report, turns = cv.repair_report(df, **options), cv.repair_turns(df, **options)
    want, repaired = plain_report(rows, damaged)
    got = report.collect()
    assert len(got) == len(want) and {r[0]: tuple(r)[1:] for r in got} == want
    left = collections.defaultdict(list)
    for r in sorted(turns.collect(), key=lambda r: (r["seq"], r["place"])):
        left[r["conv_id"]].append((r["role"], r["text"]))
    assert dict(left) == {k: v for k, v in repaired.items() if v}


def conversations(seed, sizes, roles=("user", "assistant", "user", "assistant", "system", "tool", "", None)):
    rng = random.Random(seed)
    out = []
    for c, n in enumerate(sizes):
        role = "user"
        for t in range(n):
            role = rng.choice(roles) if rng.random() < 0.3 else {"user": "assistant"}.get(role, "user")
            text = rng.choice([f"some words {rng.randrange(99)}.", "yes!", "no end", " \t", "", "?", None, "cut off \n", "done.\n"])
            turn = rng.choice([t, t, t, t + rng.randrange(3), None])
            out.append((c, turn, role, text))
    rng.shuffle(out)
    return out


ODD = [
    (None, 1, "user", "hello."), (None, None, "assistant", None), (None, 2, None, "x."), (7, None, None, None), (7, None, None, None),
    (8, 3, "user", "same."), (8, 3, "user", "same."), (8, 3, "user", "same."), (9, 0, "system", "only."), (10, -5, "assistant", "Ünïcode ☃."),
    (10, 9_000_000_000, "user", "far away?"), (11, 1, "sysop", "s."), (11, 2, "umbrella", "u."), (11, 3, "a", "a."), (12, 0, "User", "capital."),
    (13, 0, "user", "x" * 100_000), (13, 1, "assistant", ("word " * 20_000) + "."),
]


def test_damaged_odd_rows(spark):
    check(spark, ODD + [(c, t, "user", "all of them go?") for c in range(100, 140) for t in range(2)])


def test_undamaged_odd_rows(spark):
    check(spark, ODD, [tuple(" " if x is None and k > 1 else x for k, x in enumerate(r)) for r in ODD])


@pytest.mark.parametrize("segment_turns", [1, 3, cv.SEGMENT_TURNS])
def test_random_conversations(spark, segment_turns):
    check(spark, conversations(5, [0, 1, 2, 3, 5, 8, 13, 40, 75] * 2), segment_turns=segment_turns)


def test_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


def test_one_hot_conversation(spark):
    """One conversation holds most rows, many of them equal; it is spread over tasks and segments."""
    rng = random.Random(2)
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(150)]
    rows += [(1, 70, "user", "again and again.")] * 50 + [(c, 0, "user", "a.") for c in range(20)]
    rng.shuffle(rows)
    check(spark, rows, segment_turns=20)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cv.repair_report(cv.damage(none), "dropped").count() == 0 and cv.repair_turns(none).count() == 0


def test_every_short_conversation():
    for n in range(5):
        for turns in map("".join, itertools.product("xsuaoSUAO", repeat=n)):
            assert cv.close(cv.part_map(turns, [cv.BEGIN])[cv.BEGIN]) == plain_align(turns), turns


def test_longer_conversations():
    rng = random.Random(8)
    for _ in range(300):
        turns = "".join(rng.choice(rng.choice(["uaua", "xsuaoSUAO", "xU", "ssaA"])) for _ in range(rng.randint(5, 22)))
        assert cv.close(cv.part_map(turns, [cv.BEGIN])[cv.BEGIN]) == plain_align(turns), turns


def test_chunk_maps_compose():
    """Any cut of a conversation gives the same map, and composing is associative."""
    rng = random.Random(4)
    for _ in range(60):
        turns = "".join(rng.choice("xsuauaoSUA") for _ in range(rng.randint(3, 24)))
        whole = {e: cv.chunk_map(turns, e) for e in range(4)}
        i, j = sorted(rng.sample(range(1, len(turns)), 2))
        a, b, c = ({e: cv.chunk_map(t, e) for e in range(4)} for t in (turns[:i], turns[i:j], turns[j:]))
        assert cv.compose(cv.compose(a, b), c) == cv.compose(a, cv.compose(b, c)) == whole


def test_query_equals_sql_on_odd_rows(spark, tmp_path):
    rows = ODD + conversations(6, [4, 7, 12, 1, 9])
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.execute(ORACLE["op11_conversation_repair"]).fetchall()))
