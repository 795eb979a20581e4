"""Operators over documents against plain versions and the tokenizer libraries."""

import random
import zlib

import llm_plain as brute
import numpy as np
import pytest
from llm_plain import ODD
from pyspark.sql import functions as F

from sensorlake.llm import language, mixing, packing, simhash, substring, suffix_dedup, token_counts, token_files, tokens

SF = "/root/testdata/sf0.001"
PAIRS = [(r[0], r[1]) for r in ODD]


def key(row):
    return tuple((x is None, x) for x in row)


def small(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


def passages(seed, n=120):
    """Documents that share passages, hot lines and near copies of a few words."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(40)] + ["é%dü" % i for i in range(10)]
    shared = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(10, 40))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30))) for _ in range(3)]
        if rng.random() < 0.6:
            parts.insert(rng.randint(0, 3), rng.choice(shared))
        parts.insert(0, shared[0][:70])
        text = rng.choice([" ", "\n", "  "]).join(parts)
        out.append((i * 7 % n, text if rng.random() < 0.95 else None))
        if rng.random() < 0.2:
            out.append((n + i, text))
    return out


# SimHash -------------------------------------------------------------------------------------------
def check_simhash(rows, df, **options):
    got = simhash.near_duplicates(df, **options).select("doc_id", simhash.hex_fingerprint("fp"), "component_id").collect()
    prints = [brute.simhash(t) for _, t in rows]
    root = brute.groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = [(i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, root)]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_simhash_odd_rows(odd_docs):
    check_simhash(PAIRS, odd_docs)


def test_simhash_tables(spark, make_docs):
    rows = small(spark)
    check_simhash(rows, make_docs(rows))


def test_simhash_large_key_is_cut(make_docs, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 3)
    rng = random.Random(4)
    base = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(40):
        w = list(base)
        w[rng.randrange(300)] = f"other{i}"
        rows.append((i, " ".join(w)))
    check_simhash(rows, make_docs(rows))


def test_pigeonhole_finds_all_close_pairs(spark):
    rng = random.Random(1)
    values = []
    for _ in range(60):
        v = rng.getrandbits(64)
        values.append(v)
        for bits in (1, 3, 4, 5):
            w = v
            for b in rng.sample(range(64), bits):
                w ^= 1 << b
            values.append(w)
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    for blocks in (5, 6, 8):
        links = simhash.near_links(df, 4, blocks).collect()
        place = {s: i for i, s in enumerate(signed)}
        linked = {(max(place[r["a"]], place[r["b"]]), min(place[r["a"]], place[r["b"]])) for r in links}
        want = brute.groups(len(values), lambda i, j: (values[i] ^ values[j]).bit_count() <= 4)
        assert brute.groups(len(values), lambda i, j: (i, j) in linked) == want


def test_simhash_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


# substrings ----------------------------------------------------------------------------------------
@pytest.mark.parametrize("seed", [None, 1, 2])
def test_word_windows(odd_docs, make_docs, seed):
    rows, df = (PAIRS, odd_docs) if seed is None else ((r := passages(seed)), make_docs(r))
    got = substring.remove_repeats(df, with_text=True).collect()
    assert sorted([tuple(r)[:4] for r in got], key=key) == sorted(brute.word_repeats(rows), key=key)


@pytest.mark.parametrize("window,first", [(5, 2), (3, 4), (9, 1)])
def test_other_word_windows(make_docs, window, first):
    rows = passages(3, 60)
    got = substring.remove_repeats(make_docs(rows), window=window, first=first).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute.word_repeats(rows, window), key=key)


@pytest.mark.parametrize("seed,many_rows", [(None, 512), (1, 512), (2, 1), (3, 2)])
def test_byte_strings(odd_docs, make_docs, monkeypatch, seed, many_rows):
    from sensorlake.llm import packets
    rows, df = (PAIRS, odd_docs) if seed is None else ((r := passages(seed)), make_docs(r))
    if many_rows < 512:
        monkeypatch.setattr(packets, "ROW_BYTES", 4000)
    got = suffix_dedup.remove_repeats(df, many_rows=many_rows, with_text=True, carry=("source",)).collect()
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(brute.byte_repeats(rows), key=key)


def test_repeats_empty(no_docs):
    assert substring.remove_repeats(no_docs).count() == 0
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_deep_shallow_order():
    rng = np.random.default_rng(3)
    for alphabet, n in ((2, 400), (3, 1500), (200, 500)):
        data = rng.integers(97, 97 + min(alphabet, 26), n).astype(np.uint8)
        data = np.concatenate([data, data[50:250], np.full(120, 97, dtype=np.uint8), data[:100]])
        starts = np.arange(len(data) - 49)
        for shallow in (8, 16, 24, 48, 64):
            order, group = suffix_dedup.deep_shallow(data, starts, 50, shallow)
            got = [data[s:s + 50].tobytes() for s in starts[order]]
            assert got == sorted(got)
            assert [a != b for a, b in zip(got, got[1:])] == (np.diff(group) == 1).tolist()


def test_whole_characters():
    raw = "aéb☃c".encode()
    out = np.zeros(len(raw), dtype=bool)
    out[1:2] = True  # half of é
    out[4:8] = True  # all of ☃ and c
    assert suffix_dedup.whole_characters(raw, out) == "aéb"


# tokens --------------------------------------------------------------------------------------------
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(spark, name):
    own = tokens.token_ids(tokens.tokenizer_path(name))
    texts = [t for _, t in small(spark)] + [t for _, t in PAIRS] + [
        "a  b\t\tc \n\n d", " lead", "trail ", "12 345", "x,y;;  z!!", "é É ß œ Œ", "I'll  we've 'tis", "\r\n a", "−5 · 6"]
    ids, cuts = own.many(texts)
    for i, t in enumerate(texts):
        want = own.library.encode(t or "", add_special_tokens=False).ids
        assert ids[cuts[i]:cuts[i + 1]].tolist() == want, t


def test_ids_survive_a_full_cache(spark):
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    tight, wide = tokens.TokenIds(path, limit=10), tokens.TokenIds(path)
    for _, t in small(spark)[:40]:
        assert np.array_equal(tight(t), wide(t))


def test_counts_equal_the_library(spark):
    import sentencepiece

    path = tokens.tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    machine = token_counts.Transducer(path)
    rng = random.Random(2)
    bits = ["a", "th", "ing", " ", "    ", "\n", "é", "☃", "中文", "<s>", "<unk>", "<0x0A>", "▁", "23", "...", "x" * 20, "​"]
    texts = [t for _, t in small(spark)] + [t for _, t in PAIRS]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    want = [len(library.encode(t or "")) for t in texts]
    assert machine.count(texts).tolist() == want
    for chunk in (1, 3, 17):
        assert machine.count(texts[-400:], chunk=chunk).tolist() == want[-400:]
    machine.keep = 5
    assert machine.count(texts[:50]).tolist() == want[:50] == machine.count(texts[:50]).tolist()


def test_counts_of_long_texts_without_spaces():
    """Segments longer than many chunks: the library's counts, and memory that does not grow with its square."""
    import tracemalloc

    import sentencepiece

    path = tokens.tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    machine = token_counts.Transducer(path)
    rng = random.Random(8)
    bits = ["function(", "aGVsbG8", "return", "\n", "中文", "é", "==", "9", "ing"]
    line = "".join(rng.choice(bits) for _ in range(400))
    texts = [line * 30, "中文字\n" * 15_000, "x" * 40_000, " " * 3000 + line * 5 + "  " + line * 5 + " end"]
    want = [len(library.encode(t)) for t in texts]
    for chunk in (16, 1000):
        tracemalloc.start()
        got = machine.count(texts, chunk=chunk).tolist()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert got == want
        assert peak < 16_000_000


def test_token_count_rows(odd_docs, no_docs):
    path = tokens.tokenizer_path("piece_bpe_32k.model")
    got = token_counts.token_counts(odd_docs, path, limit=4096).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert r["over_limit"] == (r["n_tokens"] > 4096)
    assert {r["n_tokens"] for r in got if r["n_bytes"] == 0} == {0}
    assert token_counts.token_counts(no_docs, path).count() == 0


def test_codes_round_trip():
    rng = np.random.default_rng(5)
    for n in (0, 1, 7, 511, 512, 513, 5000):
        for top in (2, 256, 70_000, 2 ** 32 - 1):
            ids = rng.integers(0, top, n).astype(np.uint32)
            code = token_files.Dac(token_files.dac_encode(ids))
            assert len(code) == n
            assert code.slice(0, n).tolist() == ids.tolist()
            for i in rng.integers(0, n, 20 if n else 0).tolist():
                assert code.get(i) == ids[i]
                j = int(rng.integers(i, n + 1))
                assert code.slice(i, j).tolist() == ids[i:j].tolist()


def test_token_files(spark, odd_docs, no_docs):
    path = tokens.tokenizer_path("word_bpe_49k.json")
    own = tokens.token_ids(path)
    folder = token_files.write_token_files(odd_docs, path, segment_tokens=500, bytes_per_part=9000)
    got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    ids = sorted(((i is not None, i, np.append(own(t), 2).astype("<u4").tobytes()) for i, t in PAIRS), key=lambda x: x[:2] + (x[2],))
    start, want = 0, []
    for _, i, raw in ids:
        want.append((i, start, len(raw) // 4))
        start += len(raw) // 4
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in got] == want
    assert sorted(r["ids_crc32"] for r in got) == sorted(zlib.crc32(raw) for _, _, raw in ids)
    assert spark.read.parquet(folder).count() > 3
    empty = token_files.write_token_files(no_docs, path)
    assert token_files.read_token_files(spark, empty).count() == 0


# packing -------------------------------------------------------------------------------------------
def check_packing(rows, limit, max_docs=None, max_cost=None):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for seq in by.values():
        at = 0
        for r in sorted(seq, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= limit
        assert max_docs is None or len(seq) <= max_docs
        assert max_cost is None or sum(r["length"] ** 2 for r in seq) <= max_cost
    return len(by)


@pytest.mark.parametrize("limits", [{}, {"max_docs": 3}, {"max_cost": 40_000}, {"max_docs": 4, "max_cost": 60_000, "rule": "dot"}])
def test_packing(odd_docs, limits):
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    own = tokens.token_ids(path)
    rows = packing.pack(odd_docs, path, max_tokens=128, with_ids=True, **limits).collect()
    check_packing(rows, 128, limits.get("max_docs"), limits.get("max_cost"))
    pieces = {}
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        if r["piece"] == 0:
            pieces.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, pieces.values())) == len(ODD)
    for i, t in PAIRS:
        if i not in (None, 8):
            raw = b"".join(r["ids"] for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"]))
            assert np.frombuffer(raw, "<u4").tolist() == [*own(t).tolist(), 2]
            assert all(r["length"] == 128 for r in rows if r["doc_id"] == i and r["piece"])


def test_packing_is_best_fit():
    """The counted plan uses as many sequences as one-by-one best-fit decreasing."""
    rng = random.Random(6)
    for _ in range(20):
        sizes = sorted((rng.randint(1, 100) for _ in range(rng.randint(1, 400))), reverse=True)
        left = []
        for n in sizes:
            fits = [i for i, x in enumerate(left) if x >= n]
            if fits:
                left[min(fits, key=lambda i: left[i])] -= n
            else:
                left.append(100 - n)
        counts = {n: sizes.count(n) for n in set(sizes)}
        plan, bins = packing.fit_plan(counts, 100, 100, 10_000, weights=(1.0, 0.0, 0.0))
        assert bins == len(left)
        assert {int(n): int(plan[plan[:, 0] == n, 2].sum()) for n in set(sizes)} == counts


def test_production_weights_against_plain_best_fit():
    """The registered weights use at most 1 % and one sequence more than plain best-fit on tokens."""
    rng = random.Random(9)
    for _ in range(10):
        sizes = [min(1024, int(rng.lognormvariate(5, 1.2)) + 1) for _ in range(rng.randint(50, 1500))]
        counts = {n: sizes.count(n) for n in set(sizes)}
        plan, bins = packing.fit_plan(counts)
        _, plain = packing.fit_plan(counts, weights=(1.0, 0.0, 0.0))
        assert int(plan[:, 2].sum()) == len(sizes)
        assert -(-sum(sizes) // 1024) <= bins <= 1.01 * plain + 1


def test_packing_empty_and_too_small(no_docs):
    assert packing.pack(no_docs, tokens.tokenizer_path("byte_bpe_50k.json")).count() == 0
    with pytest.raises(ValueError):
        packing.fit_plan({10: 1}, 100, 100, 50)


# languages -----------------------------------------------------------------------------------------
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs.filter(~language.held_out(F.col("doc_id"))))
    got = language.identify(docs, model, ("doc_id", "lang")).filter(language.held_out(F.col("doc_id"))).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_mixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs, log_p = language.train(docs)
    table = language.odds_table(log_p)
    one = {r["lang"]: r["text"] for r in docs.filter("n_chars between 1500 and 2000").collect()}
    a, b = sorted(one)[:2]
    got = dict(language.infer(one[a] + "\n" + one[b], langs, table))
    assert set(got) == {a, b} and 0.25 < got[a] < 0.75
    assert language.infer(one[a], langs, table) == [(a, 1.0)]


def test_language_odd_rows(odd_docs, no_docs):
    model = language.train(odd_docs)
    got = {r["doc_id"]: r for r in language.identify(odd_docs, model).collect()}
    assert got[9]["lang_pred"] == got[7]["lang_pred"] == got[1]["lang_pred"] == "und" and got[9]["score"] == 0
    assert got[11]["lang_pred"] != "und"
    assert language.identify(odd_docs, language.train(no_docs)).filter("lang_pred <> 'und'").count() == 0
    assert language.identify(no_docs, model).count() == 0


# mixing --------------------------------------------------------------------------------------------
def test_targets_fill_and_cap(spark):
    sizes = [("a", 100), ("b", 1000), ("c", 10), (None, 5000), ("d", 300)]
    got = {r["source"]: r for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, size long")).collect()}
    assert [got[s]["weight"] for s in ("a", "b", "c", "d", None)] == [3, 1, 2, 3, 1]
    total = sum(n for _, n in sizes)
    share, left, free = {}, 1.5 * total, dict(sizes)
    while free:  # share again until none is above its limit
        weight = sum(got[s]["weight"] for s in free)
        over = [s for s in free if left * got[s]["weight"] / weight > 2 * free[s]]
        if not over:
            share.update({s: left * got[s]["weight"] / weight for s in free})
            break
        for s in over:
            share[s] = 2.0 * free.pop(s)
        left = 1.5 * total - sum(share.values())
    assert {s: r["target"] for s, r in got.items()} == pytest.approx(share)


def test_mix_meets_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs, rows_per_block=7).collect()
    again = mixing.mix(docs.repartition(5), rows_per_block=7).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    by = {}
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    for rows in by.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 2 * max(r["size"] for r in rows)


def test_mix_odd_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs).collect()
    assert len(got) == len(ODD)
    assert {r["size"] for r in got if r["doc_id"] in (9, 7, 1)} == {0}
    assert mixing.mix(no_docs).count() == 0
