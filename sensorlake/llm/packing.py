"""Best-fit packing of tokenised documents into sequences under several capacities."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import block_ranks, cut_lineage
from sensorlake.llm.tokens import groups, token_ids

END_ID = 2


def token_pieces(docs: DataFrame, tokenizer_file: str, max_tokens: int = 1024, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, little-endian unsigned 32-bit) per piece.

    A document is its whole text's ids and ``end_id``; null text counts as empty. A longer one is cut
    into pieces of ``max_tokens``, the first of which takes the remainder.
    """

    def run(batches):
        encoder = token_ids(tokenizer_file)
        for batch in batches:
            ids_col, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in groups(texts):
                ids, cuts = encoder.many(texts[a:b])
                rows, piece, start, length, crc, payload = [], [], [], [], [], []
                for i in range(b - a):
                    doc = np.append(ids[cuts[i]:cuts[i + 1]], np.uint32(end_id)).astype("<u4")
                    first = len(doc) % max_tokens or max_tokens
                    edges = [0, *range(min(first, len(doc)), len(doc), max_tokens), len(doc)]
                    for k, (s, e) in enumerate(zip(edges, edges[1:])):
                        raw = doc[s:e].tobytes()
                        rows.append(a + i)
                        piece.append(k)
                        start.append(s)
                        length.append(e - s)
                        crc.append(zlib.crc32(raw))
                        if with_ids:
                            payload.append(raw)
                cols = [ids_col.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array(payload, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, out)


def fit_plan(counts: dict[int, int], max_tokens: int = 1024, max_docs: int = 1024, max_cost: int = 1024 * 1024,
             weights: tuple[float, float, float] = (1.0, 0.001, 0.001), rule: str = "norm") -> tuple[np.ndarray, int]:
    """Vector best-fit decreasing over the numbers of pieces of each length.

    A piece of length n needs (n tokens, 1 document, n * n attention cost); a sequence has capacities
    (``max_tokens``, ``max_docs``, ``max_cost``). Among the open sequences where all three fit, ``norm``
    takes the one with the least weighted norm of what is left after, ``dot`` the one with the largest
    weighted dot product of what is left and what is needed. Sequences with the same content are one
    entry with a number, and equal pieces are placed many at a time, as one by one best-fit would place
    them; so the work depends on the number of lengths (at most ``max_tokens``), not of pieces.

    Returns rows (length, first rank, pieces, first sequence, offset) and the number of sequences.
    """
    cap = np.array([max_tokens, max_docs, max_cost], dtype=np.float64)
    scale = np.sqrt(np.array(weights)) / cap
    left = np.zeros((0, 3))
    number, first = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rows, bins = [], 0
    for n in sorted(counts, reverse=True):
        need = np.array([n, 1, n * n], dtype=np.float64)
        if (need > cap).any():
            raise ValueError(f"a piece of {n} tokens exceeds a sequence's capacities")
        todo, rank = counts[n], 0
        while todo:
            fits = np.flatnonzero((number > 0) & (left >= need).all(axis=1))
            if len(fits):
                if rule == "norm":
                    at = fits[np.argmin((((left[fits] - need) * scale) ** 2).sum(axis=1))]
                else:
                    at = fits[np.argmax(((left[fits] * scale) * (need * scale)).sum(axis=1))]
                space, have, begin = left[at].copy(), int(number[at]), int(first[at])
                number[at] = 0
            else:
                space, have, begin = cap.copy(), todo, bins  # new sequences, as many as get pieces
            each = min(int((space // need).min()), todo)
            full = min(have, todo // each)
            new = not len(fits)
            if new:
                have = full
            for j in range(each):
                rows.append((n, rank, full, begin, int(cap[0] - space[0]) + j * n))
                rank += full
            todo -= each * full
            add = [(space - each * need, full, begin)]
            if have > full:
                add.append((space, have - full, begin + full))
            if new:
                bins += full
            left = np.concatenate([left, np.array([a[0] for a in add])])
            number = np.concatenate([number, np.array([a[1] for a in add], dtype=np.int64)])
            first = np.concatenate([first, np.array([a[2] for a in add], dtype=np.int64)])
        open_ = (number > 0) & (left[:, 0] >= 1) & (left[:, 1] >= 1) & (left[:, 2] >= 1)
        left, number, first = left[open_], number[open_], first[open_]
    return np.array(rows, dtype=np.int64).reshape(-1, 5), bins


def pack(docs: DataFrame, tokenizer_file: str, max_tokens: int = 1024, max_docs: int | None = None,
         max_cost: int | None = None, weights: tuple[float, float, float] = (1.0, 0.001, 0.001), rule: str = "norm",
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of ``token_pieces`` with sequence_id and offset.

    The pieces' lengths are counted (at most ``max_tokens`` numbers, whatever the input), vector best-fit
    places the counts, and a piece finds its sequence by its rank among the pieces of its length. Ranks
    are counted in blocks, so one very common length is not one task. Without ``max_docs`` or
    ``max_cost`` those capacities are as large as ``max_tokens`` pieces, or one full piece, need.

    Null and empty texts are one piece that holds the end id. Rows with equal or null doc_ids are packed
    each by itself. Empty input: no rows. Only doc_id and text are read.
    """
    pieces = token_pieces(docs, tokenizer_file, max_tokens, end_id, with_ids)
    pieces = cut_lineage(pieces.withColumn("_deal", F.xxhash64(F.monotonically_increasing_id())))
    counted = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most max_tokens rows
    plan, _ = fit_plan({int(r["length"]): int(r["n"]) for r in counted}, max_tokens, max_docs or max_tokens,
                       max_cost or max_tokens * max_tokens, weights, rule)
    ranked = block_ranks(pieces, ["length"], F.lit(0).cast("long"), [F.col("doc_id"), F.col("piece")],
                         F.abs(F.col("_deal") % 1_000_003), "_rank")
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    plan = plan[order]
    span = int(plan[:, 1].max(initial=0) + plan[:, 2].max(initial=0)) + 1
    key = plan[:, 0] * span + plan[:, 1]

    def place(batches):
        for batch in batches:
            length, rank = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("length", "_rank"))
            at = np.searchsorted(key, length * span + rank - 1, side="right") - 1
            seq = plan[at, 3] + rank - 1 - plan[at, 1]
            kept = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != "_rank"]
            names = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(seq), pa.array(plan[at, 4])],
                                             names=[*names, "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = (f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
           + ", sequence_id long, offset long")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    return ranked.select(*cols, "_rank").mapInArrow(place, out)
