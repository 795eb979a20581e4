"""Substring deduplication over word windows by level-wise doubling."""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sensorlake.llm import packets
from sensorlake.llm.packets import Keys, Texts, message, messages
from sensorlake.llm.tokens import mix64, powers, span_hashes

BLANKS = np.zeros(256, dtype=bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
NEVER_MANY = 1 << 62


def levels(window: int, first: int) -> list[int]:
    """Window lengths: ``first``, doubled up to ``window``."""
    out = [min(first, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


class Words:
    """Words of a row of texts: hash, text and rank of each; null-id and copied texts take no part."""

    def __init__(self, t: Texts, skip: list[int]):
        blank = BLANKS[t.data]
        word = ~blank
        start = word.copy()
        start[1:] &= blank[:-1]
        inside = t.starts[t.starts < len(t.data)]
        start[inside] |= word[inside]
        end = word.copy()
        end[:-1] &= blank[1:]
        last = t.ends[t.ends > 0] - 1
        end[last] |= word[last]
        self.starts, self.ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.upto = np.searchsorted(self.starts, t.ends)
        self.n = np.diff(self.upto, prepend=0)
        self.text = np.repeat(np.arange(len(t.ends)), self.n)
        part = t.rank >= 0
        part[skip] = False
        self.takes_part = part[self.text]
        self.rank = t.rank[self.text]
        self.hash = mix64(span_hashes(t.data, self.starts, self.ends))
        self.sums = self._sums(self.hash)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        power, _ = powers(1 << max(16, int(len(values)).bit_length()))
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * power[:len(values)], out=out[1:])
        return out

    def windows(self, n: int) -> np.ndarray:
        """Places where a window of n words of one text begins."""
        at = np.arange(max(0, len(self.starts) - n + 1))
        return at[self.takes_part[at] & (self.text[at] == self.text[at + n - 1])]

    def window_hash(self, at: np.ndarray, n: int, sums: np.ndarray | None = None) -> np.ndarray:
        sums = self.sums if sums is None else sums
        _, inverse = powers(1 << max(16, int(len(self.hash)).bit_length()))
        return mix64((sums[at + n] - sums[at]) * inverse[at])

    def second_sums(self) -> np.ndarray:
        return self._sums(mix64(self.hash ^ np.uint64(0xA5A5A5A55A5A5A5A)))


def _bits(at: np.ndarray, n: int) -> bytes:
    mask = np.zeros(n, dtype=bool)
    mask[at] = True
    return np.packbits(mask).tobytes()


def _places(bits: bytes, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, dtype=np.uint8))[:n])


class Exact:
    """Keys of whole windows by two 64-bit hashes, each with the smallest rank that holds it."""

    def __init__(self, words: Words, at: np.ndarray, n: int):
        a = words.window_hash(at, n)
        b = words.window_hash(at, n, words.second_sums())
        order = np.lexsort((b, a))  # stable: ranks ascend in a key
        a, b = a[order], b[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = np.flatnonzero(new)
        self.a, self.b = a[first], b[first]
        self.rank = words.rank[at[order[first]]]
        self.key_of = np.empty(len(at), dtype=np.int64)
        self.key_of[order] = np.cumsum(new) - 1

    def runs(self, buckets: int) -> list[tuple[int, int, int]]:
        return packets.bucket_runs(self.a >> np.uint64(64 - packets.KEY_BITS), buckets)

    def packets(self, chunk: int, buckets: int, t: Texts):
        for k, s, e in self.runs(buckets):
            used, of = np.unique(self.rank[s:e], return_inverse=True)
            key = packets.five_bytes(self.a[s:e] >> np.uint64(14)) + packets.five_bytes(self.b[s:e])
            yield message(k, chunk, key, e - s, of.astype("<u2").tobytes(), t.distinct[used].astype("<i8").tobytes())


def smaller_elsewhere(table: pa.Table) -> pa.Table:
    """Answers of a bucket: 1 where a key is held by a smaller doc_id than the packet's own."""
    table, passed = packets._passed(table)
    if not len(table):
        return passed
    n = np.asarray(table["n"].combine_chunks(), dtype=np.int64)
    keys, docs = [], []
    for raw, of, ids, k in zip(table["keys"].to_pylist(), table["extra"].to_pylist(), table["docs"].to_pylist(), n.tolist()):
        pair = np.zeros(k, dtype=[("a", "<u8"), ("b", "<u8")])
        pair["a"], pair["b"] = packets.from_five_bytes(raw[:5 * k]), packets.from_five_bytes(raw[5 * k:])
        keys.append(pair)
        docs.append(np.frombuffer(ids, "<i8")[np.frombuffer(of, "<u2")])
    pair, doc = np.concatenate(keys), np.concatenate(docs)
    order = np.lexsort((doc, pair["b"], pair["a"]))
    a, b = pair["a"][order], pair["b"][order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    least = doc[order[np.flatnonzero(new)]][np.cumsum(new) - 1]
    removed = np.zeros(len(a), dtype=bool)
    removed[order] = least < doc[order]
    cuts = np.append(0, np.cumsum(n))
    bits = [np.packbits(removed[s:e]).tobytes() for s, e in zip(cuts[:-1], cuts[1:])]
    return pa.concat_tables([passed, packets.replies(table, bits)])


def remove_repeats(docs: DataFrame, window: int = 13, first: int = 4, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) of every row.

    Removes each word covered by a window of ``window`` words that also starts in a document with a
    smaller doc_id, judged on the input. Windows of ``first`` words are asked for over the whole corpus;
    only where all of a longer window's two halves repeat across documents is it asked for at twice the
    length, up to ``window``. Levels before the last compare keys of 40 bits and the bucket's, which can only let a window
    through to the next; the last compares 40 bits each of two hashes, the bucket's bits and the
    smallest doc_id.

    Words are runs of anything but space and 0x09-0x0D; kept words are joined by one space. Null text
    has no words. Rows with a null doc_id are kept whole and remove nothing; rows with equal doc_ids do
    not remove each other's words. Exact copies of a smaller doc_id are settled by digest. Empty input:
    no rows. Only doc_id and text are read.
    """
    lengths = levels(window, first)
    packed, buckets = packets.pack_texts(docs)
    doubles = packets.copies(packed)
    replied = None
    for step, n in enumerate(lengths):
        before = lengths[step - 1] if step else None
        last = step == len(lengths) - 1
        replied = packets.ask(packets.asked(packed, replied, doubles, _asker(n, before, last, buckets), packets.MESSAGE),
                              smaller_elsewhere if last else packets.repeated(NEVER_MANY))
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return packets.asked(packed, replied, doubles, _remover(window, buckets, with_text), out)


def _asker(n: int, before: int | None, last: bool, buckets: int):
    def run(chunk, t, replies, kept, dup):
        words = Words(t, dup)
        if before is None:
            at = words.windows(n)
        else:
            at = _places(kept, len(words.starts)) if kept else words.windows(before)
            hashes = words.window_hash(at, before)
            keys = Keys(hashes, words.rank[at])
            found = keys.of(hashes, keys.answered(replies, buckets)) > 0
            twice = np.zeros(len(words.starts) + 1, dtype=bool)
            twice[at[found]] = True
            at = words.windows(n)
            at = at[twice[at] & twice[at + n - before]]
        rows = [packets.state(chunk, buckets, _bits(at, len(words.starts)))] if before is not None or last else []
        if last:
            rows += Exact(words, at, n).packets(chunk, buckets, t)
        else:
            rows += Keys(words.window_hash(at, n), words.rank[at]).packets(chunk, buckets)
        yield messages(rows)
    return run


def _remover(n: int, buckets: int, with_text: bool):
    def run(chunk, t, replies, kept, dup):
        words = Words(t, dup)
        at = _places(kept, len(words.starts))
        exact = Exact(words, at, n)
        earlier = np.zeros(len(exact.a), dtype=bool)
        for b, s, e in exact.runs(buckets):
            earlier[s:e] = np.unpackbits(np.frombuffer(replies[b], np.uint8))[:e - s].astype(bool)
        gone = at[earlier[exact.key_of] | (words.rank[at] > exact.rank[exact.key_of])]
        removed = packets.covered(gone, n, len(words.starts))
        if dup:
            whole = np.zeros(len(t.ends), dtype=bool)
            whole[dup] = True
            removed |= (whole & (words.n >= n))[words.text]
        ends = words.upto
        rows = [[], [], [], [], []]
        for i, doc_id in enumerate(t.doc_ids):
            a, b = int(ends[i] - words.n[i]), int(ends[i])
            out = removed[a:b]
            own = t.text(i).split()
            if out.any():
                own = list(compress(own, (~out).tolist()))
            line = b" ".join(own)
            rows[0].append(doc_id)
            rows[1].append(b - a)
            rows[2].append(int(out.sum()))
            rows[3].append(hashlib.sha256(line).hexdigest())
            if with_text:
                rows[4].append(line.decode("utf-8", "replace"))
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][:4 + with_text]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds[:len(names)])], names=names)
    return run


REPEATS_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
starts AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
least AS (SELECT s, min(doc_id) AS m FROM starts GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + k AS i
         FROM (SELECT t.doc_id, t.i FROM starts t JOIN least l ON t.s = l.s AND l.m < t.doc_id), range(0, 13) r(k)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
marked AS (SELECT words.*, gone.i IS NOT NULL AS out FROM words LEFT JOIN gone USING (doc_id, i)),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE out) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT out), '') AS line
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(kept.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.line, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
