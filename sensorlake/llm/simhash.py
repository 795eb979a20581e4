"""SimHash near-duplicates: block pigeonhole on 64-bit fingerprints, Hamming check, components."""

from __future__ import annotations

from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import cut_lineage
from sensorlake.llm.components import components

#: Rows of one block key that are compared in one piece; larger keys are cut into pieces of this size.
PIECE = 4096


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles; 0 for null, empty or word-free text."""
    if not text:
        return 0
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, seed)], dtype="<u8")
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(line[a:b], seed) for a, b in
                           zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())], dtype="<u8")
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long) for every row; whole texts."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            fp = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def _blocks(n: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``n`` blocks that cover 64 bits."""
    cuts = [round(64 * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def spanning_forest(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components of rows a[i] and b[i] in ``label`` (row -> smallest row), in place."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jump = label[label]
            if np.array_equal(jump, label):
                break
            label[:] = jump


def _forest(fp: np.ndarray, key: np.ndarray, max_bits: int):
    """Links (within ``max_bits``) inside each run of equal ``key``, thinned to a spanning forest:
    index arrays (row, smallest row of its component)."""
    at = np.arange(len(fp))
    label = at.copy()
    step = 1
    alive = at[:-1][key[:-1] == key[1:]]
    while len(alive):
        other = alive + step
        near = np.bitwise_count(fp[alive] ^ fp[other]) <= max_bits
        spanning_forest(label, alive[near], other[near])
        step += 1
        alive = alive[alive + step < len(fp)]
        alive = alive[key[alive] == key[alive + step]]
    rows = np.flatnonzero(label != at)
    return rows, label[rows]


def near_links(distinct: DataFrame, max_bits: int = 4, blocks: int = 6) -> DataFrame:
    """a, b (a < b as signed longs): links between distinct fingerprints ``fp`` that differ in at most
    ``max_bits`` bits, thinned so that they connect the same fingerprints.

    Pigeonhole: of ``blocks`` blocks at least ``blocks - max_bits`` are equal in any close pair, so a
    pair meets under one of the combinations of that many blocks. Six blocks and 4 bits give 15 keys of
    about 21 bits a fingerprint; more blocks give longer keys for larger corpora. Keys are joined by a
    sort, every pair that shares a key is compared by Hamming distance, and a key's links leave the task
    as a spanning forest, never as pairs. A key with more than ``PIECE`` fingerprints is cut into pieces
    and each pair of pieces is a task's unit of its own.
    """
    parts = _blocks(blocks)
    keys = []
    for i, chosen in enumerate(combinations(range(blocks), blocks - max_bits)):
        value, width = F.lit(0).cast("long"), 0
        for first, bits in (parts[c] for c in chosen):
            piece = F.shiftrightunsigned(F.col("fp"), first).bitwiseAND(F.lit((1 << bits) - 1))
            value, width = F.shiftleft(value, bits).bitwiseOR(piece), width + bits
        if width > 56:
            raise ValueError("block keys of over 56 bits")
        keys.append(F.shiftleft(F.lit(i).cast("long"), width).bitwiseOR(value) if i else value)
    # the combination's number stands above the key's bits; widths differ by a bit or two, so it is kept apart
    keyed = distinct.select("fp", F.posexplode(F.array(*keys)).alias("c", "k"))
    sizes = (keyed.groupBy("c", "k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
             .select(F.col("c").alias("c2"), F.col("k").alias("k2"), F.ceil(F.col("n") / F.lit(PIECE)).cast("int").alias("pieces")))
    keyed = keyed.join(sizes, (F.col("c") == F.col("c2")) & (F.col("k") == F.col("k2")), "inner")
    own = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    pairs = keyed.select("fp", "c", "k", own.alias("own"), other.alias("other"))
    pairs = pairs.select("fp", F.xxhash64("c", "k", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
                         "c", "k", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_units = pairs.repartition(n, "unit").sortWithinPartitions("c", "k", "lo", "hi")

    def run(batches):
        held = None
        for batch in chain(_merged(batches), (None,)):
            if batch is not None:
                cols = [np.asarray(batch.column(i)) for i in range(5)]
                held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            if held is None or not len(held[0]):
                continue
            fp, c, k, lo, hi = held
            new = np.ones(len(fp), dtype=bool)
            new[1:] = (c[1:] != c[:-1]) | (k[1:] != k[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            end = len(fp) if batch is None else int(np.flatnonzero(new)[-1])  # the last unit may go on
            held = [x[end:] for x in held]
            if not end:
                continue
            fp = fp[:end]
            rows, to = _forest(fp.view(np.uint64), np.cumsum(new[:end]), max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(fp[rows], fp[to])), pa.array(np.maximum(fp[rows], fp[to]))], names=["a", "b"])

    return sorted_units.select("fp", "c", "k", "lo", "hi").mapInArrow(run, "a long, b long")


def _merged(batches, rows: int = 100_000):
    """Small Arrow batches joined to larger ones."""
    some, n = [], 0
    for b in batches:
        some.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(some).combine_chunks().to_batches()[0]
            some, n = [], 0
    if n:
        yield pa.Table.from_batches(some).combine_chunks().to_batches()[0]


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42, blocks: int = 6) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id reachable over fingerprints within ``max_bits`` bits.

    Copies share a fingerprint and are one node, so a group of copies costs one row from there on. Text
    without words (null, empty, white space) has fingerprint 0 and links like any other. Fewer words
    than a shingle: the whole sequence is the one shingle. A null doc_id keeps its row; it is never the
    smallest unless its component holds no other. Empty input: no rows. Only doc_id and text are read.
    """
    prints = cut_lineage(fingerprints(docs, shingle, seed))
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    links = cut_lineage(near_links(nodes.select("fp"), max_bits, blocks).distinct())
    member = components(links)  # node, root: fingerprints that have links
    joined = nodes.join(member, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = joined.join(smallest, "root").select(F.col("fp").alias("fp2"), "component_id")
    return prints.join(named, F.col("fp") == F.col("fp2"), "inner").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp):
    """16 lowercase hex digits of the unsigned fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
