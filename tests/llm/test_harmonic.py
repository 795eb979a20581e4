"""Harmonic packing against the library's ids: every id in one piece, sequences gapless, little padding."""

import collections
import random
import zlib

import numpy as np
import pytest
from llm_plain import ODD
from tokenizers import Tokenizer

from sensorlake.llm import harmonic
from sensorlake.llm.tokens import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def check(rows, df, capacity=1024, **options):
    """The packing's padding share; everything else is asserted."""
    got = harmonic.pack(df, PATH, capacity, with_ids=True, **options).collect()
    library = Tokenizer.from_file(PATH)
    want = collections.Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids) + (0,)) for i, t in rows)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert r["length"] == len(r["ids"]) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"])
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    if len({i for i, _ in rows}) == len(rows):
        for (i, total), pieces in by_doc.items():
            pieces.sort(key=lambda r: r["start"])
            ids = np.frombuffer(b"".join(r["ids"] for r in pieces), "<u4").tolist()
            assert [r["start"] for r in pieces] == [0, *np.cumsum([r["length"] for r in pieces])[:-1].tolist()]
            assert len(ids) == total and want[i, tuple(ids)] == 1
        assert len(by_doc) == len(rows)
    assert sum(r["length"] for r in got) == sum(len(k[1]) * n for k, n in want.items())
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in pieces])
        assert [r["offset"] for r in pieces] == [0, *ends[:-1].tolist()] and ends[-1] <= capacity
        total = int(ends[-1])
        assert {r["padded"] for r in pieces} == {total if total & (total - 1) == 0 else capacity}
        padding += pieces[0]["padded"] - total
    return padding / max(1, sum(r["length"] for r in got))


def test_odd_rows(odd_docs):
    check([(r[0], r[1]) for r in ODD], odd_docs)


def test_tables(spark, make_docs):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert check(rows, make_docs(rows)) < 0.005


@pytest.mark.parametrize("capacity,finest", [(1024, 1), (1024, 1024), (100, 4), (1, 16), (7, 3)])
def test_capacities(make_docs, capacity, finest):
    rng = random.Random(capacity)
    rows = [(i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([0, 1, 5, 60, 700])))) for i in range(60)]
    share = check(rows, make_docs(rows), capacity, finest=finest)
    assert share == 0 if finest == 1024 or capacity == 1 else share < 1


def test_empty(no_docs):
    assert harmonic.pack(no_docs, PATH).count() == 0


def test_bins_of_a_class_hold_a_fixed_number():
    bins = harmonic.Bins(1024)
    closed = [c for n in [300] * 7 + [341] * 2 + [60] * 17 if (c := bins.add((0, 0, n, np.zeros(n)), n))]
    assert [len(c) for c in closed] == [3, 3, 3, 17]  # 300 and 341 are of class 3, 60 of class 17
    assert [c[0][4] for c in closed] == [0, 1, 2, 3] and bins.finish() == []


def test_open_bins_end_without_padding():
    bins = harmonic.Bins(1024)
    for n in (700, 60, 300, 400, 61):
        bins.add((n, 0, n, np.arange(n)), n)
    out = bins.finish()
    sizes = collections.Counter()
    for p in out:
        sizes[p[4]] += len(p[3])
    # 700 closed its own bin; 821 tokens are left
    assert list(sizes.values()) == [512, 256, 32, 16, 4, 1]
    for n in (60, 300, 400, 61):
        assert np.concatenate([p[3] for p in out if p[0] == n]).tolist() == list(range(n))


def test_cut_sizes():
    assert harmonic.cut_sizes(1024, 1024, 16) == [1024]
    assert harmonic.cut_sizes(3000, 1024, 16) == [1024, 1024, 512, 256, 128, 56]
    assert harmonic.cut_sizes(63, 1024, 16) == [63]
    assert all(sum(harmonic.cut_sizes(n, 100, 4)) == n for n in range(1, 500))
