"""State maps of chunks: composing is associative, any cut gives the library's count, long texts spread over tasks."""

import base64
import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from sensorlake.llm import token_counts as tc
from sensorlake.llm.tokens import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def machine():
    return tc.Transducer(PATH)


def texts():
    rng = random.Random(11)
    raw = bytes(rng.randrange(256) for _ in range(3000))
    return [base64.b64encode(raw).decode(), "中文没有空格" * 300, "\n" * 900 + "x\n\n" * 400, "a" * 2500, " " * 700 + "word " * 300,
            "the quick brown fox jumps over it. " * 90, "".join(rng.choice("ab \n1▁é") for _ in range(4000)),
            "supercalifragilistic" * 100 + " end", "don't stop <s> ▁▁ here"]


def maps(machine, text, size):
    return [machine.chunk_map(own, before) for before, own in tc.cut_chunks(tc.mark(text), size, tc.OVERLAP * machine.longest)]


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_any_chunk_size_gives_the_librarys_count(machine, size):
    library = SentencePieceProcessor(model_file=PATH)
    for text in texts():
        want = len(library.encode(text))
        assert machine.count_long(tc.mark(text), size) == want
        total = tc.total_count(maps(machine, text, size))
        assert total in (want, None)
        assert machine.count_in_a_row([c for _, c in tc.cut_chunks(tc.mark(text), size, 0)]) == want


def test_composing_is_associative(machine):
    rng = random.Random(3)
    for text in texts():
        found = maps(machine, text, 50)
        for _ in range(20):
            i, j, k = (found[rng.randrange(len(found))] for _ in range(3))
            assert tc.compose(tc.compose(i, j), k) == tc.compose(i, tc.compose(j, k))
        left = found[0]
        for m in found[1:]:
            left = tc.compose(left, m)
        right = found[-1]
        for m in found[-2::-1]:
            right = tc.compose(m, right)
        assert left == right == tc.prefix_scan(found)[-1]


def test_scan_gives_every_beginning(machine):
    found = maps(machine, texts()[5], 100)
    upto, left = [], None
    for m in found:
        left = m if left is None else tc.compose(left, m)
        upto.append(left)
    assert tc.prefix_scan(found) == upto and len(found) > 20
    assert tc.prefix_scan([]) == [] and tc.total_count([]) == 0


@pytest.mark.parametrize("overlap", [tc.OVERLAP, 0])
def test_long_texts_in_several_tasks(make_docs, overlap):
    """With no overlap no state inside a segment is foreseen: those texts are run chunk by chunk."""
    library = SentencePieceProcessor(model_file=PATH)
    own = texts()
    rows = [(i % 7 if i % 3 else None, t) for i, t in enumerate(own)] + [(50, None), (51, "")]
    df = tc.token_counts(make_docs(rows), PATH, limit=500, chunk=300, spread_chars=1000, overlap=overlap)
    got = sorted(map(repr, map(tuple, df.collect())))
    want = [(i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 500) for i, t in rows]
    assert got == sorted(map(repr, want))


def test_states_have_one_name(machine):
    assert tc.state_name(machine.states[0]) == tc.first_state()
    assert np.array_equal(machine.count([None, "", "x"]), [0, 0, 1])
