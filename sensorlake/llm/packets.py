"""Corpus-wide questions about substrings: packed texts ask, hash buckets answer.

Texts are packed once into rows of a few megabytes and written, bucketed by their number, to a table in
the shared checkpoint folder; every later pass reads that table where it lies. A pass sends each bucket
of hash space one packet of sorted keys a row of texts (a key once, however often the texts hold it),
and gets back one bit or byte a key. So texts are never shuffled, a hot key costs one entry a row of
texts, and no task holds more than one row of texts or one bucket.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import cut_lineage, ensure_checkpoint_dir, spread, text_bytes

#: Texts in one packed row: bytes (a longer text is a row of its own) and number.
ROW_BYTES, ROW_TEXTS = 2 << 20, 8192
#: Bits of a key kept for comparison inside a row; the rest of 64 holds the text's rank.
KEY_BITS, RANK_BITS = 50, 14
MESSAGE = "bucket int, chunk long, kind int, n int, keys binary, extra binary, docs binary"
REPLY = "chunk long, bucket int, kind int, bits binary"


def five_bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def from_five_bytes(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def pack_texts(docs: DataFrame, carry: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(table of packed rows, number of key buckets, a power of two).

    Columns: chunk, doc_ids, ends (int64 ends of the texts in data), data (UTF-8, null text empty),
    carried (for each column of ``carry`` its values as strings). Texts of a row stand in order of
    doc_id, null ids last.
    """
    spark = docs.sparkSession
    size = text_bytes(docs)

    def pack(batches):
        held, n = [], 0

        def row():
            held.sort(key=lambda h: (h[0] is None, h[0] or 0, h[1]))
            ends = np.cumsum([len(h[1]) for h in held], dtype="<i8")
            return pa.RecordBatch.from_arrays(
                [pa.array([[h[0] for h in held]], pa.list_(pa.int64())), pa.array([ends.tobytes()], pa.binary()),
                 pa.array([b"".join(h[1] for h in held)], pa.binary()),
                 pa.array([[[h[2 + i] for h in held] for i in range(len(carry))]], pa.list_(pa.list_(pa.string())))],
                names=["doc_ids", "ends", "data", "carried"])

        for batch in batches:
            carried = [batch.column(2 + i).to_pylist() for i in range(len(carry))]
            for doc_id, text, *rest in zip(batch.column(0).to_pylist(), batch.column(1), *carried):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                if held and (n + len(raw) > ROW_BYTES or len(held) >= ROW_TEXTS):
                    yield row()
                    held, n = [], 0
                held.append((doc_id, raw, *rest))
                n += len(raw)
        if held:
            yield row()

    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))  # beyond it, more packed rows share a bucket
    buckets = min(most, max(spread(spark, size, 8 << 20), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    name = f"packed_{uuid.uuid4().hex}"
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(c).cast("string") for c in carry])
     .mapInArrow(pack, "doc_ids array<long>, ends binary, data binary, carried array<array<string>>")
     .withColumn("chunk", F.monotonically_increasing_id())
     .write.bucketBy(buckets, "chunk").format("parquet").option("compression", "zstd")
     .option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    return spark.table(name), 1 << max(0, (spread(spark, size, 4 << 20) - 1).bit_length())


class Texts:
    """One packed row: ids, bounds, bytes; ``rank`` is the dense rank of the doc_id, -1 if null."""

    def __init__(self, doc_ids: list[int | None], ends: bytes, data: bytes):
        self.doc_ids, self.raw = doc_ids, data
        self.ends = np.frombuffer(ends, dtype="<i8").astype(np.int64)
        self.starts = np.append(0, self.ends[:-1])
        self.data = np.frombuffer(data, dtype=np.uint8)
        known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
        self.distinct, rank = np.unique(known, return_inverse=True)
        self.rank = np.append(rank, np.full(len(doc_ids) - len(known), -1)).astype(np.int64)

    def text(self, i: int) -> bytes:
        return self.raw[self.starts[i]:self.ends[i]]


def copies(packed: DataFrame) -> DataFrame:
    """chunk, copies (places in the row): texts that equal one of a smaller doc_id, by 128-bit digest.

    Such a text needs no search: all that is long enough in it starts in the smaller one too.
    """

    def digest(batches):
        for batch in batches:
            for chunk, doc_ids, ends, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                t = Texts(doc_ids, ends, data)
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(doc_ids, pa.int64()),
                     pa.array([hashlib.blake2b(t.text(i), digest_size=16).digest() for i in range(n)], pa.binary())],
                    names=["chunk", "place", "doc_id", "digest"])

    rows = packed.select("chunk", "doc_ids", "ends", "data").mapInArrow(
        digest, "chunk long, place int, doc_id long, digest binary")
    rows = cut_lineage(rows.filter("doc_id is not null"))
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    least = cut_lineage(least.select(F.col("digest").alias("d"), "least"))  # a plain side: Spark splits a hot digest
    return cut_lineage(rows.join(least, F.col("digest") == F.col("d")).filter("doc_id > least")
                       .groupBy("chunk").agg(F.collect_list("place").alias("copies")))


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in a window of ``length`` that begins at one of ``starts``."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + length, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def message(bucket: int, chunk: int, keys: bytes, n: int, extra: bytes = b"", docs: bytes = b"", kind: int = 0) -> tuple:
    return bucket, chunk, kind, n, keys, extra, docs


def messages(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "chunk", "kind", "n", "keys", "extra", "docs"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def runs(values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, first place, place after the last) of each run of equal values."""
    if not len(values):
        return []
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return list(zip(values[first].tolist(), first.tolist(), np.append(first[1:], len(values)).tolist()))


def bucket_runs(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """Runs of ascending keys of ``KEY_BITS`` bits by bucket: only buckets that occur, so the work of a row of
    texts follows its keys, whatever the number of buckets."""
    return runs(keys // np.uint64((1 << KEY_BITS) // buckets))


def state(chunk: int, buckets: int, bits: bytes) -> tuple:
    """A message that comes back unchanged: what a row of texts keeps for its next pass."""
    return message(chunk % buckets, chunk, bits, 0, kind=1)


class Keys:
    """The distinct keys of a row of texts, in order; ``many`` tells that two doc_ids hold a key."""

    def __init__(self, hashes: np.ndarray, ranks: np.ndarray):
        packed = (hashes >> np.uint64(64 - KEY_BITS) << np.uint64(RANK_BITS)) | ranks.astype(np.uint64)
        packed.sort()
        key = packed >> np.uint64(RANK_BITS)
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(key))[:len(first)] - 1
        self.key = key[first]
        self.many = packed[first] != packed[last]

    def packets(self, chunk: int, buckets: int):
        for b, a, e in bucket_runs(self.key, buckets):
            yield message(b, chunk, five_bytes(self.key[a:e]), e - a, np.packbits(self.many[a:e]).tobytes())

    def answered(self, replies: dict[int, bytes], buckets: int) -> np.ndarray:
        """Answer byte of each key, in order."""
        out = np.zeros(len(self.key), dtype=np.uint8)
        for b, a, e in bucket_runs(self.key, buckets):
            out[a:e] = unpack_two(replies[b], e - a)
        return out

    def of(self, hashes: np.ndarray, answer: np.ndarray) -> np.ndarray:
        """Answer of each hash (all of them are among the keys)."""
        return answer[np.searchsorted(self.key, hashes >> np.uint64(64 - KEY_BITS))]


def pack_two(values: np.ndarray) -> bytes:
    """Values 0 to 3 as two runs of bits."""
    return np.packbits(np.concatenate([values & 1, values >> 1])).tobytes()


def unpack_two(raw: bytes, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8))[:2 * n]
    return bits[:n] | bits[n:] << 1


def repeated(many_rows: int):
    """Answers of a bucket: 0 a key of one doc_id, 1 repeated, 2 in at least ``many_rows`` rows of texts."""

    def answer(table: pa.Table) -> pa.Table:
        table, passed = _passed(table)
        if not len(table):
            return passed
        n = np.asarray(table["n"].combine_chunks(), dtype=np.int64)
        keys = np.concatenate([from_five_bytes(k) for k in table["keys"].to_pylist()])
        many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8))[:k] for x, k in zip(table["extra"].to_pylist(), n)])
        _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
        multiple = np.zeros(len(count), dtype=bool)
        multiple[which[many.astype(bool)]] = True
        value = np.where(count >= many_rows, 2, ((count > 1) | multiple)).astype(np.uint8)[which]
        cuts = np.append(0, np.cumsum(n))
        bits = [pack_two(value[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.concat_tables([passed, replies(table, bits)])

    return answer


def replies(table: pa.Table, bits: list[bytes]) -> pa.Table:
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "kind": table["kind"],
                     "bits": pa.chunked_array([pa.array(bits, pa.binary())])})


def _passed(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """(messages for the bucket, replies for the states that only pass)."""
    kind = np.asarray(table["kind"].combine_chunks())
    back = table.filter(pa.array(kind == 1))
    return table.filter(pa.array(kind == 0)), replies(back, back["keys"].to_pylist())


def ask(sent: DataFrame, answer) -> DataFrame:
    """Replies to messages, written to the shared folder and read back."""
    return cut_lineage(sent.groupBy("bucket").applyInArrow(answer, REPLY))


def asked(packed: DataFrame, replied: DataFrame | None, doubles: DataFrame | None, fn, schema: str,
          carry: bool = False) -> DataFrame:
    """``fn(chunk, Texts, replies by bucket, state, copies)`` yields record batches for each row of texts.

    The small side is gathered by chunk (at most one reply a bucket) and joined to the bucketed table,
    which stays where it lies.
    """
    rows = packed.select("chunk", "doc_ids", "ends", "data", *(["carried"] if carry else []))
    if replied is not None:
        got = replied.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "kind", "bits")).alias("replies"))
        rows = rows.join(got.hint("shuffle_hash"), "chunk", "left")
    else:
        rows = rows.withColumn("replies", F.lit(None).cast("array<struct<bucket:int,kind:int,bits:binary>>"))
    if doubles is not None:
        rows = rows.join(doubles.hint("shuffle_hash"), "chunk", "left")
    else:
        rows = rows.withColumn("copies", F.lit(None).cast("array<int>"))

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                chunk, doc_ids, ends, data, got, dup, *rest = (c[at].as_py() for c in batch.columns)
                by = {r["bucket"]: r["bits"] for r in got or () if r["kind"] == 0}
                kept = next((r["bits"] for r in got or () if r["kind"] == 1), b"")
                t = Texts(doc_ids, ends, data)
                t.carried = rest[0] if rest else []
                yield from fn(chunk, t, by, kept, dup or [])

    columns = ["chunk", "doc_ids", "ends", "data", "replies", "copies", *(["carried"] if carry else [])]
    return rows.select(*columns).mapInArrow(run, schema)
