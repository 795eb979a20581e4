"""Periodic runs of words: branching tandem repeats in an enhanced suffix array, merged into runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import WORD_PATTERN
from sensorlake.llm.tokens import groups

RUN = "struct<start:bigint,length:bigint,period:bigint>"


# enhanced suffix array ------------------------------------------------------------------------------
class SuffixArray:
    """Suffixes of several texts of words (numbers), one text after the other in the array.

    ``order`` is the suffix array, ``place`` its inverse, ``lcp[r]`` the words that the suffixes at r - 1
    and r have in common (0 between texts). ``levels[t]`` gives equal numbers to places whose next 2 ** t
    words lie in one text and are equal; prefix doubling sorts only the places that are not yet alone.
    """

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        n = len(words)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.first, self.last = bounds[:-1][text], bounds[1:][text]  # bounds of each place's text
        order = np.lexsort((words, text))
        new = np.ones(n, dtype=bool)
        new[1:] = (text[order[1:]] != text[order[:-1]]) | (words[order[1:]] != words[order[:-1]])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        self.levels = [rank.astype(np.int32)]
        alone = new & np.append(new[1:], True)
        open_, step = np.flatnonzero(~alone), 1  # places of the array in groups of several suffixes
        while len(open_):
            at = order[open_]
            beyond = at + step
            inside = beyond < self.last[at]
            after = np.where(inside, rank[np.minimum(beyond, n - 1)] + 1, 0)
            group = rank[at]
            by = np.argsort(group * (n + 1) + after, kind="stable")
            at, group, after = at[by], group[by], after[by]
            order[open_] = at
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
            rank[at] = open_[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
            self.levels.append(rank.astype(np.int32))
            open_ = open_[~(fresh & np.append(fresh[1:], True))]
            step *= 2
        self.order, self.place = order, rank
        self.lcp = np.zeros(n + 1, dtype=np.int64)
        if n > 1:
            self.lcp[1:n] = self.common(order[:-1], order[1:])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at a and b have in common."""
        a, b = a.copy(), b.copy()
        total = np.zeros(len(a), dtype=np.int64)
        for t in range(len(self.levels) - 1, -1, -1):
            level = self.levels[t]
            # a place at the end of its text has the number of the next text's first word, which no other place has
            within = (a < len(level)) & (b < len(level))
            same = np.flatnonzero(within)[level[a[within]] == level[b[within]]]
            for x in (a, b, total):
                x[same] += 1 << t
        return total

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words right before the places a and b of one text (a < b)."""
        a, b = a.copy(), b.copy()
        total = np.zeros(len(a), dtype=np.int64)
        first = self.first[a] if len(a) else a
        for t in range(len(self.levels) - 1, -1, -1):
            level, step = self.levels[t], 1 << t
            can = np.flatnonzero(a - step >= first)
            same = can[level[a[can] - step] == level[b[can] - step]]
            a[same] -= step
            b[same] -= step
            total[same] += step
        return total

    def intervals(self) -> tuple[np.ndarray, ...]:
        """(boundary, depth, left, right) of each place r with lcp[r] > 0: the LCP interval of that depth
        around it has the array's places left to right. Smaller neighbours are found by pointer jumping."""
        lcp, n = self.lcp, len(self.order)
        at = np.flatnonzero(lcp[:n])
        depth = lcp[at]
        left, right = np.arange(-1, n), np.arange(1, n + 2)  # nearest place with a smaller value, so far
        for near in (left, right):
            todo = at
            while len(todo):
                todo = todo[lcp[near[todo]] >= lcp[todo]]
                near[todo] = near[near[todo]]
        return at, depth, left[at], right[at] - 1


def tandems(array: SuffixArray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the branching tandem repeats whose period's interval has ``least`` suffixes or more.

    The suffixes i and i + d of a branching tandem repeat of period d part after exactly d words, so they
    lie in different children of one LCP interval of depth d. Of each interval all children but the
    largest are walked, and i + d and i - d looked up by the inverse suffix array.
    """
    at, depth, left, right = array.intervals()
    big = right - left + 1 >= least
    at, depth, left, right = at[big], depth[big], left[big], right[big]
    if not len(at):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    # boundaries of one interval in a row; they and its left end begin its children
    by = np.lexsort((at, right, left))
    at, depth, left, right = at[by], depth[by], left[by], right[by]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    interval = np.cumsum(new) - 1
    begin = np.concatenate([left[new], at])
    of = np.concatenate([np.arange(interval[-1] + 1), interval])
    by = np.lexsort((begin, of))
    begin, of = begin[by], of[by]
    end = np.append(begin[1:], 0) - 1
    closes = np.append(of[1:] != of[:-1], True)
    end[closes] = right[new]
    size = end - begin + 1
    by = np.lexsort((size, of))  # the last of an interval is its largest child
    largest = np.zeros(len(of), dtype=bool)
    largest[by[np.append(of[by][1:] != of[by][:-1], True)]] = True
    walk = np.flatnonzero(~largest)
    child = np.repeat(walk, size[walk])
    upto = np.cumsum(size[walk])
    place = np.arange(len(child)) - np.repeat(upto - size[walk], size[walk]) + begin[child]
    i, d = array.order[place], depth[new][of[child]]
    lo, hi = left[new][of[child]], right[new][of[child]]
    starts, periods = [], []
    for step in (1, -1):
        other = i + step * d
        inside = np.flatnonzero((other >= array.first[i]) & (other < array.last[i]))
        where = array.place[other[inside]]
        c = child[inside]
        hit = inside[(where >= lo[inside]) & (where <= hi[inside]) & ((where < begin[c]) | (where > end[c]))]
        starts.append(np.minimum(i[hit], other[hit]))
        periods.append(d[hit])
    return np.concatenate(starts), np.concatenate(periods)


def find_runs(words: np.ndarray, bounds: np.ndarray, min_words: int, min_repeats: int) -> tuple[np.ndarray, ...]:
    """(start, length, period) of the runs, by start, then period; starts count from the first text's first word.

    A branching tandem repeat is the right end of a run: rotated to the left as long as the words agree,
    it gives the whole run. Tandem repeats of a multiple of the smallest period give the same stretch, of which
    the smallest period stays.
    """
    array = SuffixArray(words, bounds)
    # a run has min_repeats suffixes that begin with its period's words
    at, period = tandems(array, max(2, min_repeats))
    grown = array.before(at, at + period)
    start, length = at - grown, grown + 2 * period
    keep = length >= np.maximum(min_words, min_repeats * period)
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def collapse(docs: DataFrame, min_words: int = 6, min_repeats: int = 4, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period; by start, then period), kept_text of every row, and
    the columns of ``carry`` as they are.

    Words are runs of anything but space and 0x09-0x0D, whole texts of them, numbered from 0. A run is a
    longest stretch of words with smallest period q, of at least ``min_words`` words and ``min_repeats``
    (2 or more) periods. A word that any run holds beyond the run's first period is dropped; the kept ones are joined by one space.

    Texts are sorted together, some 2 million characters at a time, but never compared with each other; a text
    longer than that is alone. It takes some 4 bytes a word for each doubling of its longest repeat. Null or empty
    text: no words, no runs, empty kept_text. Rows with equal or null doc_ids stay separate rows. Empty
    input: no rows. Only doc_id, text and ``carry`` are read.
    """
    if min_repeats < 2:
        raise ValueError("min_repeats must be at least 2")

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in groups(texts):
                split = [(t or "").encode("utf-8", "replace").split() for t in texts[a:b]]
                bounds = np.zeros(b - a + 1, dtype=np.int64)
                np.cumsum([len(w) for w in split], out=bounds[1:])
                number: dict[bytes, int] = {}
                words = np.fromiter((number.setdefault(w, len(number)) for s in split for w in s), np.int64, int(bounds[-1]))
                start, length, period = find_runs(words, bounds, min_words, min_repeats)
                change = np.bincount(start + period, minlength=len(words) + 1) - np.bincount(start + length, minlength=len(words) + 1)
                dropped = np.cumsum(change) > 0
                cuts = np.searchsorted(start, bounds)
                some = set(np.flatnonzero(np.diff(cuts)).tolist())
                kept, runs = [], []
                for i, own in enumerate(split):
                    if i in some:
                        gone = dropped[bounds[i]:bounds[i + 1]].tolist()
                        own = [w for w, g in zip(own, gone) if not g]
                        s, e = cuts[i], cuts[i + 1]
                        runs.append([{"start": x, "length": y, "period": z} for x, y, z in zip(
                            (start[s:e] - bounds[i]).tolist(), length[s:e].tolist(), period[s:e].tolist())])
                    else:
                        runs.append([])
                    kept.append(b" ".join(own).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(bounds)),
                     pa.array(runs, pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))),
                     pa.array(kept, pa.string()), *[batch.column(2 + k).slice(a, b - a) for k in range(len(carry))]],
                    names=["doc_id", "n_words", "runs", "kept_text", *carry])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    out = f"doc_id {kinds['doc_id']}, n_words long, runs array<{RUN}>, kept_text string"
    out += "".join(f", `{c}` {kinds[c]}" for c in carry)
    return docs.select("doc_id", "text", *carry).mapInArrow(run, out)


# planted repeats and digests ------------------------------------------------------------------------
def plant(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one document in ten (by crc32 of its doc_id) repeats some of its words.

    With h the crc32 of the decimal doc_id, g = floor(h / 10), n words: if h % 10 = 0 and n > 0, each word
    from a = g % n on becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)). Other texts, and
    those without doc_id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_w"), F.floor(h / 10).alias("_g"))
    n = F.size("_w")
    chosen = chosen.withColumn("_a", F.when(n > 0, F.pmod("_g", n)))
    chosen = chosen.withColumn("_p", 1 + F.floor((n - F.col("_a")) / (3 + F.pmod("_g", F.lit(8)))))
    again = F.expr("transform(_w, (w, i) -> CASE WHEN i >= _a THEN get(_w, CAST(_a + (i - _a) % _p AS INT)) ELSE w END)")
    return chosen.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def run_report(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (smallest start, then period, of several) and the digests of ``collapse``."""
    best = F.expr("array_max(transform(runs, r -> named_struct('length', r.length, 's', -r.start, 'p', -r.period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    found = found.withColumn("_best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.s")).alias("start"), F.col("_best.length").alias("length"),
        (-F.col("_best.p")).alias("period"),
        F.floor(1000 * F.col("_best.length") / -F.col("_best.p")).cast("long").alias("exponent_milli"),
        sha256(lines).alias("runs_sha256"), sha256(F.col("kept_text")).alias("collapsed_sha256"))
