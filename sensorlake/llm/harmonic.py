"""Harmonic packing: lengths in reciprocal-capacity classes, whose bins take a fixed number of pieces."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sensorlake.llm.tokens import groups, token_ids

END_ID = 0
#: Sequence numbers: a task's partition above these bits, its own count of sequences below.
COUNT_BITS = 33


def cut_sizes(n: int, capacity: int, finest: int) -> list[int]:
    """Lengths of a document's pieces, in order.

    Whole sequences first; what is left gives a half, a quarter, ... an ``finest``-th of a sequence while
    it is longer than the last of these. So only a rest below ``capacity / finest`` has a length that
    does not fill its class's bins exactly.
    """
    sizes = [capacity] * (n // capacity)
    n %= capacity
    part = 2
    while part <= finest and n:
        size = capacity // part
        while size and n >= size:
            sizes.append(size)
            n -= size
        part *= 2
    return sizes + [n] * (n > 0)


class Bins:
    """One worker's open bins, one for each class. Class k holds the lengths in (capacity / (k + 1),
    capacity / k]; its bin is closed when it has k pieces, which always fit."""

    def __init__(self, capacity: int, first: int = 0):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list[tuple]] = {}

    def add(self, piece: tuple, length: int) -> list[tuple] | None:
        """A piece (whose last part is its ids) goes to its class; the bin's placed pieces when that closes it."""
        k = self.capacity // length
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) < k:
            return None
        del self.open[k]
        return self.close(held)

    def close(self, held: list[tuple], padded: int | None = None) -> list[tuple]:
        """(*piece, sequence, offset, padded length) of pieces that form one sequence."""
        sequence, offset, out = self.next, 0, []
        self.next += 1
        total = sum(len(p[-1]) for p in held)
        padded = padded or (total if total & (total - 1) == 0 else self.capacity)
        for p in held:
            out.append((*p, sequence, offset, padded))
            offset += len(p[-1])
        return out

    def finish(self) -> list[tuple]:
        """What the open bins hold, cut anew: full sequences, then one for each binary digit of the rest,
        so that none is padded."""
        held = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        left = sum(len(p[-1]) for p in held)
        sizes = [self.capacity] * (left // self.capacity)
        left %= self.capacity
        sizes += [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
        out, at = [], 0
        for size in sizes:
            room, taken = size, []
            while room:
                doc, start, total, ids = held[at]
                n = min(room, len(ids))
                taken.append((doc, start, total, ids[:n]))
                room -= n
                if n < len(ids):
                    held[at] = (doc, start + n, total, ids[n:])
                else:
                    at += 1
            out += self.close(taken)
        return out


def pack(docs: DataFrame, tokenizer_file: str, max_tokens: int = 1024, finest: int = 16, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded (and ids, little-endian
    unsigned 32-bit) of each piece.

    A document is its whole text's ids and ``end_id``; null text counts as empty. Documents are cut at
    whole sequences, halves, quarters, down to a ``finest``-th of ``max_tokens``, and pieces fall into
    classes by the reciprocal of their length: k pieces of class k fill one bin. Every worker fills its
    bins for itself, whatever the others hold, so nothing is shuffled and a worker keeps at most one open
    bin a class (a bounded number of tokens). At the end of its rows it cuts the open bins' pieces into full
    sequences and sequences of a power of two, which need no padding. ``padded`` is a sequence's length after padding:
    ``max_tokens``, or its own where that is a power of two.

    Sequence numbers hold the partition and are unique. A task that runs again on the same rows gives the
    same pieces; where docs come in no fixed order, write the result before it is read twice. Rows with
    equal or null doc_ids are packed each by itself. Empty input: no rows. Only doc_id and text are read.
    """
    if max_tokens < 1 or finest < 1:
        raise ValueError("max_tokens and finest must be at least 1")

    def run(batches):
        encoder = token_ids(tokenizer_file)
        bins = Bins(max_tokens, TaskContext.get().partitionId() << COUNT_BITS)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in groups(texts):
                ids, cuts = encoder.many(texts[a:b])
                placed = []
                for i in range(b - a):
                    doc = np.append(ids[cuts[i]:cuts[i + 1]], np.uint32(end_id)).astype("<u4")
                    start = 0
                    for size in cut_sizes(len(doc), max_tokens, finest):
                        closed = bins.add((doc_ids[a + i], start, len(doc), doc[start:start + size]), size)
                        if closed:
                            placed += closed
                        start += size
                yield _rows(placed, kind, with_ids)
        if kind is not None:
            yield _rows(bins.finish(), kind, with_ids)

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
           "padded long" + ", ids binary" * with_ids)
    return docs.select("doc_id", "text").mapInArrow(run, out)


def _rows(placed: list[tuple], kind: pa.DataType, with_ids: bool) -> pa.RecordBatch:
    raw = [p[3].tobytes() for p in placed]
    long = [[p[1] for p in placed], [len(p[3]) for p in placed], [zlib.crc32(r) for r in raw], [p[2] for p in placed],
            [p[4] for p in placed], [p[5] for p in placed], [p[6] for p in placed]]
    cols = [pa.array([p[0] for p in placed], kind), *[pa.array(c, pa.int64()) for c in long]]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded"]
    if with_ids:
        cols, names = [*cols, pa.array(raw, pa.binary())], [*names, "ids"]
    return pa.RecordBatch.from_arrays(cols, names=names)
