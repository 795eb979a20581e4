"""Repair of conversations: turns aligned to the strings of an alternating grammar.

A conversation is well formed when its roles' initials are an optional system turn and pairs of user and
assistant turns, or nothing: ``(s?(ua)+)?``. The strings of this grammar have one form for each even length
(``uaua...``) and one for each odd length from 3 on (``suaua...``). Turns are aligned to them by the
Wagner-Fischer recurrence, turns in rows and the string's letters in columns; as the strings of a form begin
one another, the last row holds the distance to each feasible length. Only the band of columns that a
bound on the cost can reach is filled (Ukkonen), and the bound grows until it holds what is found.

A long conversation is cut into chunks of turns. A chunk is aligned from each place in the grammar where it can
begin to each where it can end, and these results compose; so no task holds a whole conversation.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import cut_lineage

BLANKS = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of a truncated turn that stays.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: Places in the grammar: nothing yet, after s, after u, after a pair.
BEGIN, SYSTEM, USER, PAIR = range(4)
#: What must be inserted to end a conversation at a place.
CLOSING = {BEGIN: "", SYSTEM: "II", USER: "I", PAIR: ""}
LETTERS = {"s": "system", "u": "user", "a": "assistant"}
#: Turns aligned in one matrix, turns and text bytes in one segment (a row of the segments' table).
CHUNK, SEGMENT_TURNS, SEGMENT_BYTES = 32, 4096, 1 << 20
COUNT_BITS = 33

# A turn is one letter to the alignment: x must be deleted; s, u, a its role's initial (capital: truncated);
# o, O any other role.


def expected(place: int) -> str:
    """The letter that an inserted or re-roled turn gets at a place."""
    return "a" if place == USER else "u"


def after(letter: str) -> int:
    """The place after a letter."""
    return {"s": SYSTEM, "u": USER, "a": PAIR}[letter]


def _form(entry: int, system: bool):
    """Letter j of the strings that can follow an entry place."""
    if system:
        return lambda j: "s" if j == 0 else "ua"[(j - 1) % 2]
    return (lambda j: "au"[j % 2]) if entry == USER else (lambda j: "ua"[j % 2])


def align(turns: str, letter, bound: int) -> tuple[list[list[float]], int, list[str]]:
    """(distances, offset, letters): ``distances[i][k]`` is the Wagner-Fischer distance of the first i turns to the
    first j = i + offset + k letters, within the band of columns that a cost of ``bound`` can reach. No letter
    is inserted after the last turn."""
    n, low, high = len(turns), -(bound // DELETE), bound // INSERT
    width, inf = high - low + 1, float("inf")
    wanted = [letter(j) for j in range(n + high + 1)]
    rows = []
    for i in range(n + 1):
        row = [inf] * width
        turn = turns[i - 1] if i else ""
        stays = TRUNCATED if turn.isupper() else 0
        for k in range(max(0, -low - i), width):
            j = i + low + k
            best = 0 if i == j == 0 else inf
            if i and k + 1 < width:
                best = rows[-1][k + 1] + DELETE
            if i and j and turn != "x":
                same = turn.lower() == wanted[j - 1]
                if same or wanted[j - 1] != "s":
                    best = min(best, rows[-1][k] + stays + (0 if same else REROLE))
            if i < n and j and k and wanted[j - 1] != "s":
                best = min(best, row[k - 1] + INSERT)
            row[k] = best
        rows.append(row)
    return rows, low, wanted


def trace(turns: str, rows: list[list[float]], low: int, wanted: list[str], ends: list[int]) -> str:
    """The least audit (by ASCII) of the cheapest alignments to one of the ``ends`` (columns of the last row)."""
    n, width = len(turns), len(rows[0])
    on = [[False] * width for _ in rows]  # cells of a cheapest alignment
    for j in ends:
        on[n][j - n - low] = True
    moves: list[list[dict]] = [[{} for _ in range(width)] for _ in rows]
    for i in range(n, -1, -1):
        for k in range(width - 1, -1, -1):
            if not on[i][k]:
                continue
            j, d = i + low + k, rows[i][k]
            turn = turns[i - 1] if i else ""
            if i and k + 1 < width and rows[i - 1][k + 1] + DELETE == d:
                on[i - 1][k + 1] = True
                moves[i - 1][k + 1]["D"] = (i, k)
            if i and j > 0 and turn != "x":
                same = turn.lower() == wanted[j - 1]
                c = rows[i - 1][k] + (TRUNCATED if turn.isupper() else 0) + (0 if same else REROLE)
                if c == d and (same or wanted[j - 1] != "s"):
                    on[i - 1][k] = True
                    moves[i - 1][k]["K" if same else "R"] = (i, k)
            if i < n and j > 0 and k and wanted[j - 1] != "s" and rows[i][k - 1] + INSERT == d:
                on[i][k - 1] = True
                moves[i][k - 1]["I"] = (i, k)
    i, k, audit = 0, -low, []
    while i < n:
        letter = min(moves[i][k])  # D, I, K, R: each leads to one cell, so the least letter begins the least audit
        i, k = moves[i][k][letter]
        audit.append(letter)
    return "".join(audit)


@lru_cache(maxsize=20_000)
def chunk_map(turns: str, entry: int) -> dict[int, tuple[int, str]]:
    """Exit place -> (least cost, its least audit) of a chunk of one or more turns from an entry place.

    No turn is inserted after the chunk's last one, so that an insertion between chunks belongs to the later
    chunk alone, and no audit is the beginning of another of the same chunk.
    """
    n = len(turns)
    best = {entry: (DELETE * n, "D" * n)}  # no letter at all
    lone = [(DELETE * (n - 1) + TRUNCATED * (t == "S"), "D" * i + "K" + "D" * (n - 1 - i)) for i, t in enumerate(turns) if t in "sS"]
    if entry == BEGIN and lone:
        best[SYSTEM] = min(lone)  # a system turn alone
    for system in ((False, True) if entry == BEGIN and lone else (False,)):
        letter, bound = _form(entry, system), 8
        while True:
            rows, low, wanted = align(turns, letter, bound)
            exits: dict[int, dict[int, float]] = {}
            for k, d in enumerate(rows[n]):
                j = n + low + k
                if j > system:
                    exits.setdefault(after(letter(j - 1)), {})[j] = d
            # what costs no more than the bound is exact; 2 n + 12 reaches every place that can be reached
            if all(min(ds.values()) <= bound for ds in exits.values()) or bound > DELETE * n + 12:
                break
            bound *= 2
        for x, ds in exits.items():
            d = min(ds.values())
            if d < float("inf") and (x not in best or d <= best[x][0]):
                audit = trace(turns, rows, low, wanted, [j for j, c in ds.items() if c == d])
                best[x] = min(best.get(x, (d, audit)), (d, audit))
    return best


def compose(one: dict, two: dict) -> dict:
    """Maps entry -> exit -> (cost, audit) of two parts in a row as one."""
    out: dict[int, dict[int, tuple[int, str]]] = {}
    for entry, exits in one.items():
        to: dict[int, tuple[int, str]] = {}
        for middle, (cost, audit) in exits.items():
            for x, (more, rest) in two[middle].items():
                if x not in to or cost + more <= to[x][0]:
                    to[x] = min(to.get(x, (cost + more, audit + rest)), (cost + more, audit + rest))
        out[entry] = to
    return out


def part_map(turns: str, entries=range(4)) -> dict[int, dict[int, tuple[int, str]]]:
    """Entry -> exit -> (cost, audit) of any number of turns, composed from chunks."""
    parts = [turns[i:i + CHUNK] for i in range(0, len(turns), CHUNK)]
    if not parts:
        return {e: {e: (0, "")} for e in entries}
    found = {e: chunk_map(parts[0], e) for e in entries}
    for p in parts[1:]:
        found = compose(found, {e: chunk_map(p, e) for e in range(4)})
    return found


def close(exits: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The cheapest way to end: (cost, least audit)."""
    return min((cost + INSERT * len(CLOSING[x]), audit + CLOSING[x]) for x, (cost, audit) in exits.items())


def repaired(audit: str, roles: list[str], texts: list[str], place: int = BEGIN):
    """Turns that an audit leaves, (role, text), from a place on."""
    i = 0
    for edit in audit:
        if edit == "I":
            letter, role, text = expected(place), LETTERS[expected(place)], ""
        else:
            role, text = roles[i], texts[i]
            i += 1
            if edit == "D":
                continue
            letter = role[0] if edit == "K" else expected(place)
            role = role if edit == "K" else LETTERS[letter]
        place = after(letter)
        yield role, text


# damage ----------------------------------------------------------------------------------------------
def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: rows damaged by crc32(``conv_id:turn``) % 20.

    Nulls count as one space. 0 marks the row as dropped, 1 empties its text, 2 removes ``.!?``, 3 repeats
    the row, 4 makes it a user's.
    """
    def known(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    h = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), h.alias("_h"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_h") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_h") == 1, F.lit("")).when(F.col("_h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("_h") == 0).alias("dropped"),
        F.explode(F.when(F.col("_h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


# conversations -> segments ---------------------------------------------------------------------------
#: A row that says the next one, of the same key, is a duplicate.
REPEATS = -1


def judged(turns: DataFrame, dropped: str | None) -> DataFrame:
    """Turns with a number, ``_id``, and the first fault that each shows by itself (0 none, 1 blank, 3 truncated),
    and for every duplicate one more row of the same key without text, of fault ``REPEATS``.

    A duplicate's role and text were seen earlier in its conversation: the first row of each such digest is
    found by one aggregate, and only digests of several rows come back, so a hot conversation is not one group.
    Digests and numbers are shuffled for it, not texts.
    """
    rows = turns.select(
        "conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        (F.col(dropped) if dropped else F.lit(False)).alias("dropped"))
    rows = rows.withColumn("_tie", F.unhex(F.md5("text"))).withColumn("_id", F.monotonically_increasing_id())
    same = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.lit(":"), F.length("role").cast("string"),
                    F.lit(":"), "role", F.lit(":"), F.hex("_tie"))
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(bare == "", F.lit(1)).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), F.lit(3)).otherwise(F.lit(0))
    rows = cut_lineage(rows.withColumn("_digest", F.unhex(F.md5(same))).withColumn("fault", fault))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "_id")
    first = rows.filter(~F.col("dropped")).groupBy("_digest").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = first.filter("_n > 1").select(F.col("_digest").alias("_d"), F.col("_first._id").alias("_first"))
    key = ["conv_id", "turn", "role", "_tie", "_id"]
    again = rows.filter(~F.col("dropped")).select(*key, "_digest").join(first, F.col("_digest") == F.col("_d"), "inner")
    again = again.filter(F.col("_first") != F.col("_id")).select(*key, F.lit(REPEATS).alias("fault"))
    return rows.drop("_digest").unionByName(again, allowMissingColumns=True)


class Segment:
    """Turns of one conversation in order, not too many, and what is counted over them."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns, self.roles, self.texts = [], [], []
        self.faults = [0, 0, 0, 0]
        self.numbers, self.bytes, self.distinct = [], 0, 0

    def add(self, turn, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        letter = "x" if fault in (1, 2) else initial if initial and initial in "sua" else "o"
        self.turns.append(letter.upper() if fault == 3 else letter)
        self.roles.append(role)
        self.texts.append(text)
        self.faults[fault] += 1
        self.bytes += len(text) + len(role)
        if turn is not None:
            if not self.numbers or self.numbers[-1] != turn:
                self.distinct += 1
            self.numbers = [self.numbers[0] if self.numbers else turn, turn]

    def full(self, turns: int) -> bool:
        return len(self.turns) >= turns or self.bytes >= SEGMENT_BYTES

    def facts(self) -> dict:
        initials = [r[:1] for r in self.roles]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        return {"blank": self.faults[1], "duplicate": self.faults[2], "truncated": self.faults[3], "illegal": illegal,
                "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
                "least": self.numbers[0] if self.numbers else None, "most": self.numbers[-1] if self.numbers else None,
                "distinct": self.distinct}


def join_facts(parts: list[dict]) -> dict:
    """Counts of consecutive segments as one: pairs and equal turns across their edges included."""
    out = {k: sum(p[k] for p in parts) for k in ("blank", "duplicate", "truncated", "illegal", "distinct")}
    held = [p for p in parts if p["first"] is not None]
    out["illegal"] += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
    known = [p for p in parts if p["least"] is not None]
    out["distinct"] -= sum(a["most"] == b["least"] for a, b in zip(known, known[1:]))
    out["gaps"] = known[-1]["most"] - known[0]["least"] + 1 - out["distinct"] if known else 0
    return out


FACTS = {"blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(), "first": pa.string(),
         "last": pa.string(), "least": pa.int64(), "most": pa.int64(), "distinct": pa.int64()}
REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def segments(turns: DataFrame, dropped: str | None, with_turns: bool, segment_turns: int) -> DataFrame:
    """Rows of the segments' table, in order of ``seq``.

    Turns are dealt to tasks by ranges of (conversation, turn, ...), so a hot conversation spreads over many
    tasks, and sorted inside them. A conversation that lies whole in a task's rows and fits a segment is closed
    there (``report`` and ``audit`` are set); of others every segment is a row with the costs and audits
    between all places of the grammar, its letters and its turns.
    """
    rows = judged(turns, dropped)
    key = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("_tie").asc(), F.col("_id").asc()]
    rows = rows.repartitionByRange(*key).sortWithinPartitions(*key, "fault")  # a duplicate's mark comes before it
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches):
        number = TaskContext.get().partitionId() << COUNT_BITS
        done: list[tuple] = []
        held = 0  # bytes of the turns in done
        current, begun = None, True  # the task's first conversation may have begun in the task before
        marked = None

        def take(segment: Segment, whole: bool) -> None:
            nonlocal number, held
            letters = "".join(segment.turns)
            if whole:
                cost, audit = close(part_map(letters, [BEGIN])[BEGIN])
                left = list(repaired(audit, segment.roles, segment.texts))
                sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode("utf-8", "replace")).hexdigest()
                done.append((segment.conv_id, number, join_facts([segment.facts()]) | {"cost": cost}, audit, sha,
                             left if with_turns else None, None, None, None, None))
            else:
                found = part_map(letters)
                ways = [found[e].get(x, (-1, "")) for e in range(4) for x in range(4)]
                done.append((segment.conv_id, number, None, None, None, None, segment.facts(), [w[0] for w in ways],
                             [w[1] for w in ways], list(zip(segment.roles, segment.texts))))
            held += segment.bytes * (with_turns or not whole)
            number += 1

        for batch in batches:
            kind = batch.schema.field(0).type
            for conv_id, turn, role, text, gone, fault, number_ in zip(*(c.to_pylist() for c in batch.columns)):
                if fault == REPEATS:
                    marked = number_
                    continue
                if number_ == marked and fault != 1:
                    fault = 2
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        take(current, whole=not begun)
                        begun = False
                    current = Segment(conv_id)
                elif current.full(segment_turns):
                    take(current, whole=False)
                    begun, current = True, Segment(conv_id)
                if not gone:
                    current.add(turn, role, text, fault)
                if len(done) >= 1000 or held >= SEGMENT_BYTES:
                    yield _segments(done, kind)
                    done, held = [], 0
        if current is not None:
            take(current, whole=False)  # it may go on in the next task
            yield _segments(done, kind)

    out = (f"conv_id {kind}, seq long, report struct<{', '.join(f'{c}: long' for c in REPORT)}>, audit string, repaired_sha256 string, "
           "repaired array<struct<role: string, text: string>>, "
           f"facts struct<{', '.join(f'{c}: ' + ('string' if t == pa.string() else 'long') for c, t in FACTS.items())}>, "
           "costs array<long>, audits array<string>, turns array<struct<role: string, text: string>>")
    return rows.select("conv_id", "turn", "role", "text", "dropped", "fault", "_id").mapInArrow(run, out)


def _segments(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    def pairs(values):
        return pa.array([v if v is None else [{"role": r, "text": t} for r, t in v] for v in values], TURNS)

    cols = list(zip(*rows)) if rows else [()] * 10
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], kind), pa.array(cols[1], pa.int64()),
         pa.array([r and {c: r[c] for c in REPORT} for r in cols[2]], pa.struct([(c, pa.int64()) for c in REPORT])),
         pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string()), pairs(cols[5]),
         pa.array(cols[6], pa.struct(list(FACTS.items()))), pa.array(cols[7], pa.list_(pa.int64())),
         pa.array(cols[8], pa.list_(pa.string())), pairs(cols[9])],
        names=["conv_id", "seq", "report", "audit", "repaired_sha256", "repaired", "facts", "costs", "audits", "turns"])


# segments -> conversations ---------------------------------------------------------------------------
def choose(table: pa.Table) -> pa.Table:
    """Entry and exit place of each segment of one conversation on its cheapest, least audit, and its report.

    Costs to the end are summed from the last segment back; from the first on, the least of the audits that
    lead on at the least cost is taken. The group holds costs and the order of audits, no turns: one row a segment.
    """
    rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
    inf = float("inf")
    togo = [[INSERT * len(CLOSING[x]) for x in range(4)]]
    for r in reversed(rows):
        cost = r["costs"]
        togo.append([min(cost[4 * e + x] + togo[-1][x] if cost[4 * e + x] >= 0 else inf for x in range(4)) for e in range(4)])
    togo.reverse()
    report = join_facts([r["facts"] for r in rows]) | {"cost": togo[0][BEGIN]}
    place, out = BEGIN, []
    for i, r in enumerate(rows):
        ways = [x for x in range(4) if r["costs"][4 * place + x] >= 0
                and r["costs"][4 * place + x] + togo[i + 1][x] == togo[i][place]]
        to = min(ways, key=lambda x: r["ranks"][4 * place + x])
        last = i == len(rows) - 1
        out.append({"seq": r["seq"], "entry": place, "exit": to, "report": {c: int(report[c]) for c in REPORT} if last else None})
        place = to
    return pa.Table.from_pylist(out, schema=pa.schema([
        ("seq", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()), ("report", pa.struct([(c, pa.int64()) for c in REPORT]))]))


def _order(segments: DataFrame) -> DataFrame:
    """Segments' numbers, facts, costs and the audits' order (small columns; the audits stay where they are)."""
    ranks = F.transform("audits", lambda a: F.array_position(F.array_sort("audits"), a))
    return segments.select("conv_id", "seq", "facts", "costs", ranks.alias("ranks"))


def _chosen(table: DataFrame) -> DataFrame:
    """Segments of the conversations that were not closed in their task, with entry, exit and the last one's report."""
    open_ = table.filter("report is null")
    ways = _order(open_).groupBy("conv_id").applyInArrow(
        choose, f"seq long, entry int, exit int, report struct<{', '.join(f'{c}: long' for c in REPORT)}>")
    ways = ways.select(F.col("seq").alias("_seq"), "entry", "exit", F.col("report").alias("_report"))
    own = F.element_at("audits", F.col("entry") * 4 + F.col("exit") + 1)
    closing = F.when(F.col("_report").isNotNull(), F.element_at(
        F.array(*[F.lit(CLOSING[x]) for x in range(4)]), F.col("exit") + 1)).otherwise(F.lit(""))
    return open_.join(ways, F.col("seq") == F.col("_seq")).select(
        "conv_id", "seq", "turns", "entry", F.concat(own, closing).alias("audit"), F.col("_report").alias("report"))


def repair_report(turns: DataFrame, dropped: str | None = None, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    ``turns`` has conv_id, turn, role, text. ``dropped`` may name a boolean column: rows marked there only make
    their conversation known. Null roles and texts are one space; a null conv_id is a conversation of
    its own. Turns stand by turn (nulls first), role, text's md5; repeated rows one after the other. A turn's first
    fault counts: blank, duplicate (role and text seen earlier), truncated (does not end in ``.!?``). Blank
    and duplicate turns are deleted (2), others kept (0), re-roled to user or assistant (1) or deleted (2),
    user or assistant turns without text inserted (5); a truncated turn that stays costs 5. ``audit`` is the
    cheapest edits' initials in order, of equally cheap ones the least by ASCII, ``repaired_sha256`` the digest of
    the repaired ``role:text`` lines. gaps: turn numbers missing between the least and the greatest. illegal:
    adjacent roles whose initials are not su, ua or au. A role without s, u or a as its first character is never kept.
    No turns: zeros, empty audit, digest of nothing. Empty input: no rows. Further columns are not read.

    A hot conversation is spread over tasks by segments; only its digest, which is sequential by its nature, is
    computed by one task, a segment at a time.
    """
    table = cut_lineage(segments(turns, dropped, with_turns=False, segment_turns=segment_turns))
    names = ["conv_id", *REPORT, "audit", "repaired_sha256"]
    whole = table.filter("report is not null").select("conv_id", "report.*", "audit", "repaired_sha256")
    rows = _chosen(table).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "seq")
    kind = table.schema["conv_id"].dataType.simpleString()

    def run(batches):
        digest, audits, some = hashlib.sha256(), [], False
        for batch in batches:
            done = []
            for conv_id, turns_, entry, audit, report in zip(*(c.to_pylist() for c in batch.columns)):
                left = repaired(audit, [t["role"] for t in turns_], [t["text"] for t in turns_], entry)
                for role, text in left:
                    digest.update(("\n" * some + f"{role}:{text}").encode("utf-8", "replace"))
                    some = True
                audits.append(audit)
                if report is not None:
                    done.append((conv_id, *(report[c] for c in REPORT), "".join(audits), digest.hexdigest()))
                    digest, audits, some = hashlib.sha256(), [], False
            cols = list(zip(*done)) if done else [()] * len(names)
            kinds = [batch.schema.field(0).type, *[pa.int64()] * len(REPORT), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    out = f"conv_id {kind}, {', '.join(f'{c} long' for c in REPORT)}, audit string, repaired_sha256 string"
    long = rows.select("conv_id", "turns", "entry", "audit", "report").mapInArrow(run, out)
    return whole.select(*names).unionByName(long)


def repair_turns(turns: DataFrame, dropped: str | None = None, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """conv_id, seq, place, role, text: the repaired turns of every conversation (rules as in ``repair_report``);
    by (seq, place) they stand in order."""
    table = cut_lineage(segments(turns, dropped, with_turns=True, segment_turns=segment_turns))
    whole = table.filter("report is not null").select("conv_id", "seq", F.posexplode("repaired").alias("place", "_t"))
    kind = table.schema["conv_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = [(conv_id, seq, i, role, text)
                   for conv_id, seq, turns_, entry, audit in zip(*(c.to_pylist() for c in batch.columns))
                   for i, (role, text) in enumerate(repaired(audit, [t["role"] for t in turns_], [t["text"] for t in turns_], entry))]
            cols = list(zip(*out)) if out else [()] * 5
            kinds = [batch.schema.field(0).type, pa.int64(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["conv_id", "seq", "place", "role", "text"])

    rows = _chosen(table).select("conv_id", "seq", "turns", "entry", "audit")
    long = rows.mapInArrow(run, f"conv_id {kind}, seq long, place int, role string, text string")
    return whole.select("conv_id", "seq", "place", "_t.role", "_t.text").unionByName(long)


REPAIR_SQL = r"""
WITH RECURSIVE table32 AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hashed AS (
  SELECT named.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
           lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])), 4294967295) % 20 AS h FROM named, table32),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM hashed, range(2) c(copy) WHERE h <> 0 AND (copy = 0 OR h = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault,
         left(role, 1) AS initial, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS next FROM placed),
moves(place, letter, inserts, cost, edit) AS (  -- place 0 nothing yet, 1 after s, 2 after u, 3 after a pair
  SELECT p, c, n, 5 * n, repeat('I', n) FROM (VALUES
    (0, 's', 0), (0, 'u', 0), (1, 'u', 0), (2, 'a', 0), (3, 'u', 0),
    (0, 'a', 1), (1, 'a', 1), (2, 'u', 1), (3, 'a', 1), (0, 'u', 2), (1, 'u', 2)) v(p, c, n)),
inserted(place, reached, cost, edit) AS (
  VALUES (0, 2, 5, 'I'), (1, 2, 5, 'I'), (2, 3, 5, 'I'), (3, 2, 5, 'I'), (0, 3, 10, 'II'), (1, 3, 10, 'II')),
steps AS (  -- every way over one turn: from a place, to a place
  SELECT j.conv_id, j.i, m.place,
         CASE m.letter WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END AS reached,
         m.cost + CASE WHEN j.fault = 3 THEN 5 ELSE 0 END + CASE WHEN j.initial = m.letter THEN 0 ELSE 1 END AS cost,
         m.edit || CASE WHEN j.initial = m.letter THEN 'K' ELSE 'R' END AS edit
  FROM judged j, moves m WHERE j.fault NOT IN (1, 2) AND (m.letter <> 's' OR j.initial = 's')
  UNION ALL SELECT j.conv_id, j.i, p, p, 2, 'D' FROM judged j, range(4) q(p)
  UNION ALL SELECT j.conv_id, j.i, n.place, n.reached, n.cost + 2, n.edit || 'D' FROM judged j, inserted n),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0::BIGINT AS place, 0::BIGINT AS cost, '' AS audit FROM judged
  UNION ALL
  SELECT conv_id, i, reached, b.cost, b.audit FROM (
    SELECT s.conv_id, s.i, s.reached, min({'cost': w.cost + s.cost, 'audit': w.audit || s.edit}) AS b
    FROM walk w JOIN steps s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND s.i = w.i + 1 AND s.place = w.place
    GROUP BY ALL)),
sizes AS (
  SELECT conv_id, count(*) AS n, count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
         count(*) FILTER (WHERE fault = 3) AS truncated,
         count(*) FILTER (WHERE next IS NOT NULL AND initial || next NOT IN ('su', 'ua', 'au')) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM judged GROUP BY conv_id),
best AS (
  SELECT w.conv_id, min({'cost': w.cost + 5 * e.n, 'audit': w.audit || repeat('I', e.n::INT)}) AS b
  FROM walk w JOIN sizes z ON w.conv_id IS NOT DISTINCT FROM z.conv_id AND w.i = z.n
  JOIN (VALUES (0, 0), (1, 2), (2, 1), (3, 0)) e(place, n) ON e.place = w.place GROUP BY w.conv_id),
edits AS (
  SELECT conv_id, p, substr(b.audit, p::INT, 1) AS edit, length(replace(b.audit, 'D', '')) % 2 AS odd,
         p - length(replace(left(b.audit, p::INT), 'I', '')) AS skipped,
         length(replace(left(b.audit, p::INT), 'D', '')) - 1 AS at
  FROM (SELECT conv_id, b, unnest(range(1, length(b.audit) + 1)) AS p FROM best)),
lines AS (
  SELECT e.conv_id, e.p, CASE WHEN e.edit = 'K' THEN j.role WHEN (e.at - e.odd) % 2 = 0 THEN 'user' ELSE 'assistant' END
         || ':' || CASE WHEN e.edit = 'I' THEN '' ELSE j.text END AS line
  FROM edits e LEFT JOIN judged j ON e.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = e.p - e.skipped AND e.edit <> 'I'
  WHERE e.edit <> 'D'),
joined AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS whole FROM lines GROUP BY conv_id)
SELECT c.conv_id, coalesce(z.gaps, 0)::BIGINT AS gaps, coalesce(z.blank, 0)::BIGINT AS blank,
       coalesce(z.duplicate, 0)::BIGINT AS duplicate, coalesce(z.truncated, 0)::BIGINT AS truncated,
       coalesce(z.illegal, 0)::BIGINT AS illegal, coalesce(b.b.cost, 0)::BIGINT AS cost, coalesce(b.b.audit, '') AS audit,
       sha256(coalesce(l.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN sizes z ON c.conv_id IS NOT DISTINCT FROM z.conv_id
LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN joined l ON c.conv_id IS NOT DISTINCT FROM l.conv_id
"""
