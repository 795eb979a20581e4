"""Token-id files with directly addressable codes: any token is read without decoding a block."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import ensure_checkpoint_dir, spread, text_bytes
from sensorlake.llm.tokens import groups, token_ids

MAGIC = b"DAC1"
#: Bits between two entries of a rank directory.
RANK_STEP = 512


def dac_encode(ids: np.ndarray) -> bytes:
    """Directly addressable code of unsigned ids, eight bits a level.

    Level k holds byte k of the ids that have one, a bitmap of those that go on to level k + 1, and the
    bitmap's rank directory (ones before every ``RANK_STEP`` bits). Layout: magic, number of levels
    (u4), then for each level its length (u8), bytes, bitmap, directory (u8 each), little-endian.
    """
    rest, levels = np.ascontiguousarray(ids, dtype=np.uint64), []
    while True:
        more = rest >= 256
        bitmap = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(more, np.arange(0, len(more), RANK_STEP), dtype=np.int64) if len(more) else np.zeros(0, dtype=np.int64)
        ranks = (np.cumsum(blocks) - blocks).astype("<u8")
        levels.append(np.array([len(rest)], dtype="<u8").tobytes() + (rest & np.uint64(255)).astype(np.uint8).tobytes()
                      + bitmap.tobytes() + ranks.tobytes())
        if not more.any():
            return MAGIC + np.array([len(levels)], dtype="<u4").tobytes() + b"".join(levels)
        rest = rest[more] >> np.uint64(8)


class Dac:
    """Reader of ``dac_encode``'s bytes: ``len``, ``get(i)`` and ``slice(a, b)``."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a directly addressable code")
        n_levels, at, self.levels = int(np.frombuffer(raw, "<u4", 1, 4)[0]), 8, []
        for _ in range(n_levels):
            n = int(np.frombuffer(raw, "<u8", 1, at)[0])
            blocks = -(-n // RANK_STEP)
            low = np.frombuffer(raw, np.uint8, n, at + 8)
            bitmap = np.frombuffer(raw, np.uint8, -(-n // 8), at + 8 + n)
            ranks = np.frombuffer(raw, "<u8", blocks, at + 8 + n + len(bitmap))
            self.levels.append((low, bitmap, ranks))
            at += 8 + n + len(bitmap) + 8 * blocks

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Ones before bit i."""
        block = i // RANK_STEP
        if block == len(ranks):
            block -= 1
        begin = block * RANK_STEP
        if block < 0 or begin == i:
            return int(ranks[block]) if block >= 0 else 0
        bits = np.unpackbits(bitmap[begin // 8:-(-i // 8)], bitorder="little")[:i - begin]
        return int(ranks[block]) + int(bits.sum())

    def get(self, i: int) -> int:
        """Id at place i: one rank a level."""
        value, shift = 0, 0
        for low, bitmap, ranks in self.levels:
            value |= int(low[i]) << shift
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            i, shift = self._rank(bitmap, ranks, i), shift + 8
        return value

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids at places a to b - 1: one rank and one run of bits a level."""
        out = np.zeros(b - a, dtype=np.uint32)
        where, shift = np.arange(b - a), 0
        for low, bitmap, ranks in self.levels:
            if a >= b:
                break
            out[where] |= low[a:b].astype(np.uint32) << np.uint32(shift)
            more = np.unpackbits(bitmap[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a].astype(bool)
            a = self._rank(bitmap, ranks, a)
            where, shift = where[more], shift + 8
            b = a + len(where)
        return out


def write_token_files(docs: DataFrame, tokenizer_file: str, path: str | None = None, end_id: int = 2,
                      segment_tokens: int = 1_000_000, bytes_per_part: int = 8 << 20) -> str:
    """Write every document's ids and ``end_id`` in ascending doc_id order; returns the folder.

    Parts are ranges of doc_id of about equal numbers of rows; a part's task writes segments of about
    ``segment_tokens`` ids, each one row of the files: part, seg, the doc_ids, their numbers of ids, and
    the code. (part, seg) ascends with doc_id. Texts are tokenised where they are read; only ids move.
    Null text is empty, a null doc_id comes first, equal doc_ids follow each other by their ids.
    """
    spark = docs.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    parts = spread(spark, text_bytes(docs), bytes_per_part)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 10_000).alias("q")).first()["q"]
    cuts = np.unique(np.array(cuts or [], dtype=np.int64)) if parts > 1 else np.zeros(0, dtype=np.int64)

    def encode(batches):
        encoder = token_ids(tokenizer_file)
        small = encoder.library.get_vocab_size() <= 65536 and end_id < 65536
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            part = np.searchsorted(cuts, np.asarray(doc_ids.fill_null(-2 ** 63)), side="left").astype(np.int32)
            for a, b in groups(texts):
                ids, at = encoder.many(texts[a:b])
                ids = ids.astype("<u2" if small else "<u4")
                end = np.array([end_id], dtype=ids.dtype).tobytes()
                raw = [ids[at[i]:at[i + 1]].tobytes() + end for i in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(a, b - a), pa.array(part[a:b]), pa.array(raw, pa.binary()),
                     pa.array([2 if small else 4] * (b - a), pa.int32())], names=["doc_id", "part", "ids", "width"])

    def write(batches):
        held: list[tuple] = []
        size, seg, now = 0, 0, None

        def flush():
            nonlocal held, size, seg
            ids = np.concatenate([np.frombuffer(r, dtype=f"<u{w}") for _, r, w in held])
            counts = np.array([len(r) // w for _, r, w in held], dtype="<u4")
            row = pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([seg], pa.int32()), pa.array([[d for d, _, _ in held]], pa.list_(pa.int64())),
                 pa.array([counts.tobytes()], pa.binary()), pa.array([len(ids)], pa.int64()), pa.array([dac_encode(ids)], pa.binary())],
                names=["part", "seg", "doc_ids", "counts", "n_ids", "code"])
            held, size, seg = [], 0, seg + 1
            return row

        for batch in batches:
            for doc_id, part, raw, width in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held and (part != now or size >= segment_tokens):
                    yield flush()
                if part != now:
                    now, seg = part, 0
                held.append((doc_id, raw, width))
                size += len(raw) // width
        if held:
            yield flush()

    coded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        encode, "doc_id long, part int, ids binary, width int")
    (coded.repartition(len(cuts) + 1, "part").sortWithinPartitions("part", "doc_id", "ids")
     .mapInArrow(write, "part int, seg int, doc_ids array<long>, counts binary, n_ids long, code binary")
     .write.option("compression", "zstd").parquet(path))
    return path


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read back from the files.

    Each document's ids are read through the code's directories. ``start`` is summed over segments
    inside a part and over parts, from the small columns alone.
    """
    files = spark.read.parquet(path)

    def decode(batches):
        for batch in batches:
            for part, seg, doc_ids, counts, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
                code, counts = Dac(raw), np.frombuffer(counts, dtype="<u4").astype(np.int64)
                ends = np.cumsum(counts)
                crc = [zlib.crc32(code.slice(int(e - n), int(e)).astype("<u4").tobytes()) for n, e in zip(counts, ends)]
                k = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * k, pa.int32()), pa.array([seg] * k, pa.int32()), pa.array(doc_ids, pa.int64()),
                     pa.array(ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                    names=["part", "seg", "doc_id", "inside", "n_tokens", "ids_crc32"])

    sizes = files.select("part", "seg", "n_ids")
    by_part = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    at = sizes.withColumn("seg_start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    at = at.join(by_part, F.col("part") == F.col("p")).select(
        F.col("part").alias("p"), F.col("seg").alias("s"), (F.col("part_start") + F.col("seg_start")).alias("base"))
    docs = files.select("part", "seg", "doc_ids", "counts", "code").mapInArrow(
        decode, "part int, seg int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return docs.join(at, (F.col("part") == F.col("p")) & (F.col("seg") == F.col("s"))).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
