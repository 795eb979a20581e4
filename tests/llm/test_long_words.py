"""Long words that a polynomial hash modulo a power of two takes for one another, and bounds on the work per row of texts."""

import numpy as np
import pytest

from sensorlake.llm import packets, packing, substring, token_counts, token_files
from sensorlake.llm.tokens import span_hashes, tokenizer_path


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


ONE, OTHER = thue_morse(1024), thue_morse(1024, "b", "a")


def test_span_hashes_tell_spans_apart():
    parts = [b"a", b"a\0", b"\0", b"\0\0", b"", b"12345678", b"123456780", b"1234567890123456", b"12345678901234567",
             ONE.encode(), OTHER.encode()]
    ends = np.cumsum([len(p) for p in parts])
    starts = np.append(0, ends[:-1])
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    h = span_hashes(data, starts, ends)
    assert len(set(h.tolist())) == len(parts)
    assert (span_hashes(data.copy(), starts, ends) == h).all()


def test_substring_dedup_keeps_other_long_words(make_docs):
    rest = " ".join(f"w{i}" for i in range(12))
    rows = {r["doc_id"]: r["n_removed"] for r in substring.remove_repeats(
        make_docs([(1, f"{ONE} {rest}"), (2, f"{OTHER} {rest}"), (3, f"x {ONE} {rest}")]), window=13).collect()}
    assert rows == {1: 0, 2: 0, 3: 13}


def test_tokens_of_long_words_are_the_librarys(make_docs):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    texts = {1: f"{ONE} {OTHER}", 2: f"{OTHER} x {ONE}"}
    docs = make_docs(list(texts.items()))
    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for r in packing.token_pieces(docs, path, max_tokens=1 << 20, with_ids=True).collect():
        want = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == [*want, packing.END_ID]
    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    found = token_files.read_token_files(docs.sparkSession, token_files.write_token_files(docs, path)).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {
        i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    path = tokenizer_path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, path).collect()}
    assert found == {i: len(library.encode(t)) for i, t in texts.items()}


def test_packed_table_keeps_to_sparks_bucket_limit(spark, make_docs):
    old = spark.conf.get("spark.sql.sources.bucketing.maxBuckets")
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "2")
    try:
        words = " ".join(f"w{i}" for i in range(30))
        got = substring.remove_repeats(make_docs([(i, words if i % 2 else f"{words} {i}") for i in range(40)])).collect()
    finally:
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", old)
    assert sum(r["n_removed"] for r in got) == 39 * 30


@pytest.mark.parametrize("buckets", [1, 1 << 10, 1 << 40])
def test_work_per_row_follows_its_keys(buckets):
    keys = packets.Keys(np.arange(1, 400, dtype=np.uint64) << np.uint64(55), np.zeros(399, dtype=np.int64))
    sent = list(packets.Keys.packets(keys, 7, buckets))
    assert len(sent) <= min(buckets, 399) and sum(m[3] for m in sent) == 399
    assert (keys.answered({m[0]: packets.pack_two(np.full(m[3], 1, dtype=np.uint8)) for m in sent}, buckets) == 1).all()
