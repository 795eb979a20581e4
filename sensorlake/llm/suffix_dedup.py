"""Substring deduplication over bytes by sorting suffixes (deep-shallow)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sensorlake.llm import packets
from sensorlake.llm.packets import Keys, Texts, message, messages
from sensorlake.llm.tokens import BYTE_VALUES, mix64, powers

#: An anchor found in this many rows of texts has its windows sent one by one, by their own hash.
MANY_ROWS = 512


# deep-shallow sorting ------------------------------------------------------------------------------
def big_endian_words(data: np.ndarray) -> np.ndarray:
    """Eight bytes from every place, as integers that compare like the bytes; zeros past the end.
    There are eight more places than bytes, so that a suffix's last word has one."""
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    n = len(data) + 8
    out = padded[:n].astype(np.uint64)
    for j in range(1, 8):
        out <<= np.uint64(8)
        out |= padded[j:j + n]
    return out


def _masked(words: np.ndarray, at: np.ndarray, depth: int, length: int) -> np.ndarray:
    """Next eight bytes of each suffix from ``depth``, bytes past ``length`` as zero."""
    w = words[at + depth]
    over = depth + 8 - length
    return w if over <= 0 else w & np.uint64(~((1 << 8 * over) - 1) & (2 ** 64 - 1))


def deep_shallow(data: np.ndarray, starts: np.ndarray, length: int, shallow: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): the suffixes at ``starts`` in order of their first ``length`` bytes, and for each
    place of the order the number of its run of equal ones. Every suffix has ``length`` bytes.

    Shallow part: multikey quicksort with characters of eight bytes; a round sorts all groups that are
    still open by their next character. Suffixes still together at depth ``shallow`` go to blind tries:
    a group's first member is its leaf, the others' common prefixes with it give the depth of the first
    branch, and only the byte there parts the group; a trie node is no more than that depth and byte.
    All groups' nodes are made together, so the rounds are the height of the tries, not their size.
    """
    words = big_endian_words(data)
    n = len(starts)
    order = np.argsort(_masked(words, starts, 0, length), kind="quicksort")
    first = _masked(words, starts[order], 0, length)
    new = np.ones(n, dtype=bool)
    new[1:] = first[1:] != first[:-1]
    depth = 8
    while depth < min(shallow, length):
        at = _open(new)
        if not len(at):
            break
        group = np.cumsum(new)[at]
        char = _masked(words, starts[order[at]], depth, length)
        by = np.lexsort((char, group))
        order[at] = order[at[by]]
        char, group = char[by], group[by]
        split = np.zeros(len(at), dtype=bool)
        split[1:] = (char[1:] != char[:-1]) & (group[1:] == group[:-1])
        new[at[split]] = True
        depth += 8
    if depth < length:
        _blind_tries(words, starts, order, new, depth, length)
    return order, np.cumsum(new) - 1


def _open(new: np.ndarray) -> np.ndarray:
    """Places in groups of two or more."""
    alone = new.copy()
    alone[:-1] &= new[1:]
    return np.flatnonzero(~alone)


def _blind_tries(words: np.ndarray, starts: np.ndarray, order: np.ndarray, new: np.ndarray, depth: int, length: int) -> None:
    """Part every group of ``new`` down to ``length`` in place."""
    at = _open(new)
    while len(at):
        head = new[at]
        begin = np.flatnonzero(head)
        group = np.cumsum(head) - 1
        here = starts[order[at]]
        leaf = here[begin][group]
        common = np.full(len(at), length, dtype=np.int64)
        pending = np.arange(len(at))
        for d in range(depth, length, 8):
            differ = _masked(words, here[pending], d, length) ^ _masked(words, leaf[pending], d, length)
            apart = differ != 0
            common[pending[apart]] = d + _leading_bytes(differ[apart])
            pending = pending[~apart]
            if not len(pending):
                break
        branch = np.minimum.reduceat(common, begin)[group]
        open_ = branch < length  # the rest of the groups is equal to the full length
        at, here, group, branch = at[open_], here[open_], group[open_], branch[open_]
        if not len(at):
            break
        byte = words[here + branch] >> np.uint64(56)
        by = np.argsort((group.astype(np.uint64) << np.uint64(8)) | byte, kind="stable")
        order[at] = order[at[by]]
        byte, group = byte[by], group[by]
        split = np.zeros(len(at), dtype=bool)
        split[1:] = (byte[1:] != byte[:-1]) & (group[1:] == group[:-1])
        new[at[split]] = True
        alone = new[at].copy()
        follows = np.append(at[1:] == at[:-1] + 1, False)
        alone &= np.where(follows, np.append(new[at[1:]], True), True)
        at = at[~alone]


def _leading_bytes(x: np.ndarray) -> np.ndarray:
    """Number of zero bytes before the first other one (x is not zero)."""
    out = np.zeros(len(x), dtype=np.int64)
    for k in range(1, 8):
        out += x < np.uint64(1 << (64 - 8 * k))
    return out


# anchors and regions -------------------------------------------------------------------------------
class Anchors:
    """For each 50-byte window of a row of texts, the hash of its anchor: the least hash among the
    window's runs of ``size`` bytes. Equal windows have equal anchors."""

    def __init__(self, t: Texts, length: int, skip: list[int], size: int | None = None):
        size = size or max(1, length // 2 + 1)
        n, data = len(t.data), t.data
        self.length, self.t = length, t
        takes = (t.rank >= 0) & (t.ends - t.starts >= length)
        takes[skip] = False
        stops = np.where(takes, t.ends - length + 1, t.starts)
        change = np.zeros(n + 1, dtype=np.int32)
        np.add.at(change, t.starts[takes], 1)
        np.add.at(change, stops[takes], -1)
        self.at = np.flatnonzero(np.cumsum(change[:n]) > 0)  # windows' starts
        if not len(self.at):
            self.anchor = np.zeros(0, dtype=np.uint64)
            self.rank = np.zeros(0, dtype=np.int64)
            self.begin = self.end = np.zeros(0, dtype=np.int64)
            return
        power, inverse = powers(1 << max(16, n.bit_length()))
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * power[:n], out=total[1:])
        low = (total[size:] - total[:-size]) * inverse[:n + 1 - size]
        low = low * np.uint64(0x9FB21C651E98DF25)
        low ^= low >> np.uint64(29)
        width, span = length - size + 1, 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
        self.anchor = low[self.at]
        new = np.ones(len(self.at), dtype=bool)
        new[1:] = self.anchor[1:] != self.anchor[:-1]
        new[np.searchsorted(self.at, t.starts[takes])] = True
        self.begin = np.flatnonzero(new)  # runs of windows of one text with one anchor
        self.end = np.append(self.begin[1:], len(self.at))
        self.anchor = mix64(self.anchor[self.begin])
        self.rank = t.rank[np.searchsorted(t.ends, self.at[self.begin], side="right")]

    def keys(self) -> Keys:
        return Keys(self.anchor, self.rank)

    def regions(self, answer: np.ndarray) -> tuple[np.ndarray, ...]:
        """(first window, windows, rank, hash that names the bucket) of the runs whose anchor repeats;
        where it does in very many rows of texts, each window is a region by itself."""
        run = np.flatnonzero(answer == 1)
        first, count, rank, key = self.at[self.begin[run]], self.end[run] - self.begin[run], self.rank[run], self.anchor[run]
        hot = np.flatnonzero(answer == 2)
        if len(hot):
            n = self.end[hot] - self.begin[hot]
            place = np.repeat(self.begin[hot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            power, inverse = powers(1 << max(16, len(self.t.data).bit_length()))
            total = np.zeros(len(self.t.data) + 1, dtype=np.uint64)
            np.cumsum(BYTE_VALUES[self.t.data] * power[:len(self.t.data)], out=total[1:])
            one = self.at[place]
            own = mix64((total[one + self.length] - total[one]) * inverse[one])
            first, count = np.append(first, one), np.append(count, np.ones(len(one), dtype=np.int64))
            rank, key = np.append(rank, np.repeat(self.rank[hot], n)), np.append(key, own)
            order = np.argsort(first, kind="stable")
            first, count, rank, key = first[order], count[order], rank[order], key[order]
        return first, count, rank, key


class Regions:
    """Distinct regions of a row of texts, by bucket; ``first`` is each one's first place."""

    def __init__(self, anchors: Anchors, answer: np.ndarray, buckets: int):
        self.at, self.count, self.rank, key = anchors.regions(answer)
        self.length, self.t = anchors.length, anchors.t
        raw, seen = self.t.raw, {}
        ends = (self.at + self.count + self.length - 1).tolist()
        self.of = np.array([seen.setdefault(raw[a:e], i) for i, (a, e) in enumerate(zip(self.at.tolist(), ends))], dtype=np.int64)
        own = np.flatnonzero(self.of == np.arange(len(self.of)))
        bucket = (key >> np.uint64(64 - packets.KEY_BITS)) // np.uint64((1 << packets.KEY_BITS) // buckets)
        order = own[np.argsort(bucket[own], kind="stable")]
        self.by_bucket = {b: order[s:e] for b, s, e in packets.runs(bucket[order])}

    def packets(self, chunk: int):
        for b, which in self.by_bucket.items():
            used, of = np.unique(self.rank[which], return_inverse=True)
            texts = [self.t.raw[a:a + n + self.length - 1] for a, n in zip(self.at[which].tolist(), self.count[which].tolist())]
            extra = self.count[which].astype("<u4").tobytes() + of.astype("<u2").tobytes()
            yield message(b, chunk, b"".join(texts), len(which), extra, self.t.distinct[used].astype("<i8").tobytes())

    def removed(self, replies: dict[int, bytes]) -> np.ndarray:
        """Starts of the windows that also start in a smaller doc_id."""
        if not len(self.at):
            return np.zeros(0, dtype=np.int64)
        place, flat, n = np.zeros(len(self.at), dtype=np.int64), [], 0
        for b, which in self.by_bucket.items():
            size = self.count[which]
            place[which] = n + np.cumsum(size) - size
            n += int(size.sum())
            flat.append(np.unpackbits(np.frombuffer(replies[b], np.uint8))[:int(size.sum())])
        earlier = np.concatenate(flat).astype(bool)
        later = self.rank > self.rank[self.of]  # repeats a region of a smaller doc_id in this row
        inside = np.arange(int(self.count.sum())) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        gone = np.repeat(later, self.count) | earlier[np.repeat(place[self.of], self.count) + inside]
        return (np.repeat(self.at, self.count) + inside)[gone]


def sorter(length: int, shallow: int):
    """Answers of a bucket: one bit a window, 1 where the same bytes start in a smaller doc_id."""

    def answer(table: pa.Table) -> pa.Table:
        table, passed = packets._passed(table)
        if not len(table):
            return passed
        n = np.asarray(table["n"].combine_chunks(), dtype=np.int64)
        count, doc = [], []
        for extra, ids, k in zip(table["extra"].to_pylist(), table["docs"].to_pylist(), n.tolist()):
            count.append(np.frombuffer(extra, "<u4", k))
            doc.append(np.frombuffer(ids, "<i8")[np.frombuffer(extra, "<u2", k, 4 * k)])
        windows = np.concatenate(count).astype(np.int64)
        data = np.frombuffer(b"".join(table["keys"].to_pylist()), dtype=np.uint8)
        region = np.cumsum(windows + length - 1) - (windows + length - 1)
        upto = np.cumsum(windows)
        starts = np.repeat(region - (upto - windows), windows) + np.arange(upto[-1])
        order, group = deep_shallow(data, starts, length, shallow)
        holder = np.repeat(np.concatenate(doc), windows)
        sorted_holder = holder[order]
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        least = np.minimum.reduceat(sorted_holder, begin)[group]
        out = np.zeros(len(order), dtype=bool)
        out[order] = least < sorted_holder
        edges = np.append(0, upto)[np.append(0, np.cumsum(n))]
        bits = [np.packbits(out[s:e]).tobytes() for s, e in zip(edges[:-1], edges[1:])]
        return pa.concat_tables([passed, packets.replies(table, bits)])

    return answer


def remove_repeats(docs: DataFrame, length: int = 50, shallow: int = 16, many_rows: int = MANY_ROWS,
                   with_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_text, and ``carry`` as strings) of every row.

    Removes each byte covered by a string of ``length`` bytes that also starts in a document with a
    smaller doc_id, judged on the input; n_spans counts the maximal removed runs. Windows whose anchor
    (a content-chosen run of bytes inside them) occurs in one document alone cannot repeat and stay
    home. The others travel as the text they cover, once per row of texts however often it holds it, to
    the anchor's bucket, where their suffixes are sorted and runs of equal ones find their smallest
    doc_id. An anchor found in ``many_rows`` rows of texts is split by its windows' own hashes.

    Matches never cross texts. Null text is empty. Rows with a null doc_id are kept whole and remove
    nothing; rows with equal doc_ids do not remove each other's bytes. Exact copies of a smaller doc_id
    are settled by digest. kept_text keeps a character whole if any of its bytes is kept. Empty input:
    no rows. Only doc_id and text are read.
    """
    packed, buckets = packets.pack_texts(docs, carry)
    doubles = packets.copies(packed)

    def anchors(chunk, t, replies, kept, dup):
        yield messages(list(Anchors(t, length, dup).keys().packets(chunk, buckets)))

    def regions(chunk, t, replies, kept, dup):
        own = Anchors(t, length, dup)
        keys = own.keys()
        every = keys.answered(replies, buckets)
        found = Regions(own, keys.of(own.anchor, every), buckets)
        yield messages([packets.state(chunk, buckets, packets.pack_two(every)), *found.packets(chunk)])

    def remove(chunk, t, replies, kept, dup):
        own = Anchors(t, length, dup)
        keys = own.keys()
        every = packets.unpack_two(kept, len(keys.key))
        gone = Regions(own, keys.of(own.anchor, every), buckets).removed(replies)
        removed = packets.covered(gone, length, len(t.data))
        for i in dup:
            if t.ends[i] - t.starts[i] >= length:
                removed[t.starts[i]:t.ends[i]] = True
        rows = [[], [], [], [], [], []]
        for i, doc_id in enumerate(t.doc_ids):
            out = removed[t.starts[i]:t.ends[i]]
            raw = t.text(i)
            touched = bool(out.any())
            left = t.data[t.starts[i]:t.ends[i]][~out].tobytes() if touched else raw
            rows[0].append(doc_id)
            rows[1].append(len(raw))
            rows[2].append(int(out.sum()))
            rows[3].append(int(out[:1].sum() + (out[1:] & ~out[:-1]).sum()))
            rows[4].append(hashlib.sha256(left).hexdigest())
            if with_text:
                rows[5].append(whole_characters(raw, out) if touched else raw.decode("utf-8", "replace"))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"][:5 + with_text]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        cols = [pa.array(r, k) for r, k in zip(rows, kinds[:len(names)])] + [pa.array(c, pa.string()) for c in t.carried]
        yield pa.RecordBatch.from_arrays(cols, names=[*names, *carry])

    replied = packets.ask(packets.asked(packed, None, doubles, anchors, packets.MESSAGE), packets.repeated(many_rows))
    replied = packets.ask(packets.asked(packed, replied, doubles, regions, packets.MESSAGE), sorter(length, shallow))
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text
    out += "".join(f", `{c}` string" for c in carry)
    return packets.asked(packed, replied, doubles, remove, out, carry=bool(carry))


def whole_characters(raw: bytes, out: np.ndarray) -> str:
    """The text without its removed bytes; a character goes only if all its bytes do."""
    data = np.frombuffer(raw, dtype=np.uint8)
    first = np.flatnonzero((data & 0xC0) != 0x80)
    gone = np.repeat(np.logical_and.reduceat(out, first), np.diff(np.append(first, len(data))))
    return data[~gone].tobytes().decode("utf-8", "replace")

