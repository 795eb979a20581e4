"""Token counts of whole texts by a finite-state transducer compiled from a merge vocabulary."""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import cut_lineage
from sensorlake.llm.tokens import Known, groups, join_bytes, span_hashes

SPACE = "▁"
#: Longest pieces' lengths that a chunk is told of what comes before it.
OVERLAP = 4


def mark(text: str) -> str:
    """The model writes one space before a text and knows no other difference between space and its mark."""
    return " " + text.replace(SPACE, " ")


class Transducer:
    """Deterministic transducer over characters whose transitions carry emitted-token counts.

    The vocabulary's merges pick, for every prefix of a segment, one last token: the only piece ending
    there that the last token before it tolerates (two tokens tolerate each other when merging their
    joined text gives the two back). A state therefore needs no more than the longest suffix that may
    still begin a piece, and for each place in it the last token and the count up to there relative to
    now. States are numbered and transitions compiled when first met; a transition's count may be
    negative where a longer piece takes the place of several.

    A segment is a run of spaces and what follows up to the next run; no piece crosses its start (which
    is verified), so the transducer returns to its first state there. A character outside the
    vocabulary counts as its UTF-8 bytes and merges with nothing.
    """

    def __init__(self, path: str, keep: int = 1_500_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank: dict[str, float] = {}
        for i in range(model.vocab_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                self.rank[model.id_to_piece(i)] = model.get_score(i)
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("a piece crosses a segment's start")
        self.prefixes = {p[:i] for p in self.rank for i in range(1, len(p))}
        self.longest = max(map(len, self.rank))
        self.tolerated: dict[tuple[str, str], bool] = {}
        self.states: list[tuple] = [("", (None,), (0,))]
        self.number = {self.states[0]: 0}
        self.moves: dict[tuple[int, str], tuple[int, int]] = {}
        self.keep, self.known = keep, Known()  # counts of whole segments met before

    def merge(self, text: str) -> list[str]:
        """Merges of a short text: best piece first, leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            best = max(range(len(parts) - 1), key=lambda i: (self.rank.get(parts[i] + parts[i + 1], -np.inf), -i))
            if parts[best] + parts[best + 1] not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def tolerate(self, left: str, right: str) -> bool:
        key = (left, right)
        known = self.tolerated.get(key)
        if known is None:
            known = self.tolerated[key] = self.merge(left + right) == [left, right]
        return known

    def move(self, state: int, char: str) -> tuple[int, int]:
        """(next state, emitted count) of one transition, compiled here."""
        suffix, last, count = self.states[state]
        text = suffix + char
        for at in range(len(text)):
            piece = text[at:]
            if piece not in self.rank and len(piece) > 1:
                continue
            before = last[at]
            if before is None or len(piece) == 1 and piece not in self.rank or self.tolerate(before, piece):
                break
        else:
            raise AssertionError("no tokenization")
        emitted = count[at] + (1 if piece in self.rank else len(char.encode("utf-8", "replace")))
        keep = next((k for k in range(len(text)) if text[k:] in self.prefixes), len(text))
        new = (text[keep:], (*last, piece)[keep:], tuple(c - emitted for c in (*count, emitted)[keep:]))
        to = self.number.get(new)
        if to is None:
            to = self.number[new] = len(self.states)
            self.states.append(new)
        self.moves[state, char] = to, emitted
        return to, emitted

    def follow(self, state: int, text: str) -> tuple[int, int]:
        """(exit state, emitted count) of a text from a state."""
        total = 0
        moves = self.moves
        for char in text:
            state, n = moves.get((state, char)) or self.move(state, char)
            total += n
        return state, total

    def forget(self) -> None:
        """Drop the compiled states when there are many; they are compiled again when met again."""
        if len(self.states) > 250_000:
            del self.states[1:]
            self.number, self.moves, self.tolerated = {self.states[0]: 0}, {}, {}

    def run(self, segment: str) -> int:
        """Tokens of one whole segment, from the first state."""
        self.forget()
        return self.follow(0, segment)[1]

    def counts_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each segment of ``data`` (UTF-8, spaces as 0x20); a segment met before is not run again."""
        if not len(starts):
            return np.zeros(0, dtype=np.int64)
        if len(self.known.hash) > self.keep:
            self.known = Known()
        hashes, at, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        count = self.known.find(hashes)
        new = np.flatnonzero(count < 0)
        a, b = starts[at[new]], ends[at[new]]
        raw = data.tobytes()
        count[new] = [self.run(raw[x:y].decode().replace(" ", SPACE)) for x, y in zip(a.tolist(), b.tolist())]
        self.known.add(hashes[new], count[new])
        return count[which]

    # chunk state maps ------------------------------------------------------------------------------
    def move_on(self, text: str, entry: tuple) -> tuple[tuple, int]:
        """(exit state, emitted count) of a segment's part from a state, both as what a state stands for."""
        self.forget()
        state = self.number.get(entry)
        if state is None:  # forgotten since
            state = self.number[entry] = len(self.states)
            self.states.append(entry)
        state, total = self.follow(state, text.replace(" ", SPACE))
        return self.states[state], total

    def run_chunk(self, chunk: str, entry: tuple) -> tuple[tuple, int]:
        """A chunk's exit state and emitted count from one entry state.

        What comes before the first segment's start inside moves the entry state on, segments that begin
        and end inside are counted whole, and the last one, from the first state, gives the exit state.
        With no start inside, the whole chunk moves the entry state on."""
        data = np.frombuffer(chunk.encode("utf-8", "replace"), dtype=np.uint8)
        starts = np.flatnonzero((data[1:] == 32) & (data[:-1] != 32)) + 1
        if not len(starts):
            return self.move_on(chunk, entry)
        _, head = self.move_on(data[:starts[0]].tobytes().decode(), entry)
        inner = int(self.counts_of(data, starts[:-1], starts[1:]).sum())
        state, tail = self.move_on(data[starts[-1]:].tobytes().decode(), self.states[0])
        return state, head + inner + tail

    def entries(self, before: str, chunk: str) -> list[tuple]:
        """States in which a chunk may be entered, from the characters before it.

        Where a segment's start lies among them (or the text begins there) the state is certain: the transducer
        is in its first state at that start. Inside a longer segment the states reached from
        each of the first places are taken; transducers that start apart soon run together."""
        text = before + chunk[:1]
        at = next((i for i in range(len(text) - 1, 0, -1) if text[i] == " " and text[i - 1] != " "), None)
        if at is not None or not before:
            return [self.move_on(before[at or 0:], self.states[0])[0]]
        return list(dict.fromkeys(self.move_on(before[i:], self.states[0])[0] for i in range(min(4, len(before)))))

    def chunk_map(self, chunk: str, before: str) -> dict[str, tuple[str, int]]:
        """A chunk's state map: entry state -> (exit state, emitted count), states by name."""
        out = {}
        for entry in self.entries(before, chunk):
            leaves, n = self.run_chunk(chunk, entry)
            out[state_name(entry)] = (state_name(leaves), n)
        return out

    def count_in_a_row(self, chunks) -> int:
        """Tokens of one text, its chunks run one after the other, each from the state the one before leaves."""
        state, total, last = self.states[0], 0, " "
        for chunk in chunks:
            if chunk[0] == " " and last != " ":  # a segment begins with the chunk
                state = self.states[0]
            state, n = self.run_chunk(chunk, state)
            total, last = total + n, chunk[-1]
        return total

    def count_long(self, text: str, chunk: int) -> int:
        """Tokens of one text by a parallel prefix scan over its chunks' state maps."""
        parts = cut_chunks(text, chunk, OVERLAP * self.longest)
        total = total_count([self.chunk_map(own, before) for before, own in parts])
        return self.count_in_a_row(own for _, own in parts) if total is None else total

    def count(self, texts: list[str | None], chunk: int = 65536) -> np.ndarray:
        """Tokens of each text. Texts of up to ``chunk`` characters are one chunk each and run together."""
        marked = [mark(t) if t else "" for t in texts]
        out = np.zeros(len(texts), dtype=np.int64)
        short = [i for i, t in enumerate(marked) if 0 < len(t) <= chunk]
        for i, t in enumerate(marked):
            if len(t) > chunk:
                out[i] = self.count_long(t, chunk)
        if short:
            data, bounds = join_bytes([marked[i] for i in short])
            start = np.zeros(len(data), dtype=bool)
            start[1:] = (data[1:] == 32) & (data[:-1] != 32)
            start[bounds[:-1]] = True
            starts = np.flatnonzero(start)
            ends = np.append(starts[1:], len(data))
            n = self.counts_of(data, starts, ends)
            out[short] = np.add.reduceat(n, np.searchsorted(starts, bounds[:-1]))
        return out


def state_name(state: tuple) -> str:
    """What a state stands for, as text: the same in every worker."""
    return json.dumps(state)


def first_state() -> str:
    return state_name(("", (None,), (0,)))


def cut_chunks(text: str, chunk: int, before: int) -> list[tuple[str, str]]:
    """(up to ``before`` characters that come before, chunk) of a text's chunks."""
    return [(text[max(0, i - before):i], text[i:i + chunk]) for i in range(0, len(text), chunk)]


def compose(one: dict[str, tuple[str, int]], two: dict[str, tuple[str, int]]) -> dict[str, tuple[str, int]]:
    """The state map of two parts in a row. Maps are partial functions, and composing them is associative: an
    entry whose state at the seam the second map does not hold has no value."""
    return {entry: (two[seam][0], n + two[seam][1]) for entry, (seam, n) in one.items() if seam in two}


def prefix_scan(maps: list[dict[str, tuple[str, int]]]) -> list[dict[str, tuple[str, int]]]:
    """State maps of all beginnings of a row of parts (the first alone, the first two, ...): pairs are composed,
    scanned in the same way, and handed down; as many compositions as parts, twice, in any order."""
    if len(maps) < 2:
        return list(maps)
    pairs = prefix_scan([compose(maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)])
    out = [maps[0]]
    for i in range(1, len(maps)):
        out.append(pairs[i // 2] if i % 2 else compose(pairs[i // 2 - 1], maps[i]))
    return out


def total_count(maps: list[dict[str, tuple[str, int]]]) -> int | None:
    """Tokens of a text from its chunks' maps, None where a state at a seam was not foreseen."""
    found = prefix_scan(maps)[-1].get(first_state()) if maps else (first_state(), 0)
    return found and found[1]


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One a worker process and model."""
    return Transducer(path)


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, chunk: int = 65536, spread_chars: int = 1 << 21,
                 overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row's whole text.

    Null and empty text: 0 bytes, 0 tokens. Texts longer than ``chunk`` characters are cut into chunks, whose
    state maps (exit state and count for the entry states that the characters before them allow) are
    composed by a parallel prefix scan. Chunks of a text longer than ``spread_chars`` are counted by several tasks, and
    only their maps meet. Where a state at a seam was not foreseen (possible only inside a segment longer than ``overlap``
    of the longest pieces), that text's chunks are run one after the other. Rows with equal or null
    doc_ids stay separate rows. Empty input: no rows. Only doc_id and text are read.
    """

    def run(batches):
        machine = transducer(model_file)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in groups(texts):
                part = texts[a:b]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len((t or "").encode("utf-8", "replace")) for t in part], pa.int64()),
                     pa.array(machine.count(part, chunk))], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    long = F.length("text") > spread_chars
    rows = docs.select("doc_id", "text")
    counted = rows.filter(~F.coalesce(long, F.lit(False))).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    counted = counted.unionByName(_long_counts(rows.filter(long), model_file, chunk, overlap))
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


PART = "_row long, _part int, n_bytes long, _before string, _chunk string"
MAP = "array<struct<entry: string, leaves: string, n: bigint>>"


def _long_counts(docs: DataFrame, model_file: str, chunk: int, overlap: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens of long texts, whose chunks are dealt to tasks."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        longest = transducer(model_file).longest
        for batch in batches:
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                parts = cut_chunks(mark(text), chunk, overlap * longest)
                for at in range(0, len(parts), 64):
                    own = parts[at:at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id.as_py()] * len(own), batch.schema.field(1).type), pa.array([row] * len(own), pa.int64()),
                         pa.array(range(at, at + len(own)), pa.int32()),
                         pa.array([0 if at + i else len(text.encode("utf-8", "replace")) for i in range(len(own))], pa.int64()),
                         pa.array([p[0] for p in own], pa.string()), pa.array([p[1] for p in own], pa.string())],
                        names=["doc_id", "_row", "_part", "n_bytes", "_before", "_chunk"])

    def maps(batches):
        machine = transducer(model_file)
        for batch in batches:
            found = [machine.chunk_map(own, before) for before, own in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())]
            of = pa.array([[{"entry": e, "leaves": x, "n": n} for e, (x, n) in m.items()] for m in found],
                          pa.list_(pa.struct([("entry", pa.string()), ("leaves", pa.string()), ("n", pa.int64())])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], of], names=[*batch.schema.names[:4], "_map"])

    def scan(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["_part"])
        total = total_count([{m["entry"]: (m["leaves"], m["n"]) for m in r["_map"]} for r in rows])
        return table.slice(0, 1).select(["doc_id", "_row"]).append_column("n_bytes", pa.array([sum(r["n_bytes"] for r in rows)], pa.int64())) \
            .append_column("n_tokens", pa.array([total], pa.int64()))

    parts = cut_lineage(docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
                        .mapInArrow(cut, f"doc_id {kind}, {PART}").repartition("_row", "_part"))
    found = cut_lineage(parts.mapInArrow(maps, f"doc_id {kind}, _row long, _part int, n_bytes long, _map {MAP}")
                        .groupBy("_row").applyInArrow(scan, f"doc_id {kind}, _row long, n_bytes long, n_tokens long"))
    left = found.filter("n_tokens is null").select(F.col("_row").alias("_r"))
    if not left.limit(1).count():
        return found.select("doc_id", "n_bytes", "n_tokens")
    again = parts.join(left, F.col("_row") == F.col("_r"), "left_semi").repartition("_row").sortWithinPartitions("_row", "_part")
    rest = again.select("_row", "_part", "_chunk").mapInArrow(_rows_in_order(model_file), "_r long, _n long")
    return found.join(rest, F.col("_row") == F.col("_r"), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_tokens", "_n").alias("n_tokens"))


def _rows_in_order(model_file: str):
    """Counts of texts whose chunks come in order, one chunk in memory."""
    def run(batches):
        machine = transducer(model_file)
        chunks = ((r, c) for batch in batches for r, c in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
        for row, own in groupby(chunks, key=lambda x: x[0]):
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([machine.count_in_a_row(c for _, c in own)], pa.int64())],
                                             names=["_r", "_n"])
    return run
