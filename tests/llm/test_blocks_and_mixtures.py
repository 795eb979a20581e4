"""Even blocks whatever the ids, and language mixtures against an exhaustive plain version."""

import collections
import itertools
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import language, mixing, packing
from sensorlake.llm.tokens import tokenizer_path


@pytest.mark.parametrize("ids", ["steps", "null"])
def test_blocks_fill_evenly(make_docs, ids):
    """Ids in steps of 20, or none at all, leave no block of 20 with more than twice its share."""
    docs = make_docs([(i * 20 if ids == "steps" else None, f"text number {i}", "en", "a") for i in range(4000)])
    counts = [r["count"] for r in docs.groupBy((mixing.deal("doc_id", "text") % 20).alias("b")).count().collect()]
    assert len(counts) == 20 and max(counts) < 400


def test_mix_equals_sql_without_ids(spark, make_docs, tmp_path):
    rng = random.Random(1)
    rows = [(None if rng.random() < 0.4 else i * 20, "w " * rng.choice([0, 1, 1, 5, 1200]), "en", rng.choice("abc")) for i in range(400)]
    docs = make_docs(rows).select("doc_id", "text", "source")
    docs.write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    got = mixing.mix(spark.read.parquet(f"{tmp_path}/d")).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.execute(mixing.MIX_SQL).fetchall()))


def test_equal_documents_without_ids_are_packed(make_docs):
    docs = make_docs([(None, "same words here", "en", "a")] * 3000 + [(i, None) for i in range(50)])
    rows = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), max_tokens=16).collect()
    assert len(rows) == 3050
    fill = collections.Counter()
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 16 and len(fill) <= -(-3000 // 4) + 50


def plain_mixture(odds, weight, cost):
    """The set of languages with the highest penalised likelihood, all sets tried, and its proportions."""
    best = None
    for k in range(1, odds.shape[1] + 1):
        for chosen in itertools.combinations(range(odds.shape[1]), k):
            own, share = odds[:, chosen], np.full(k, 1 / k)
            for _ in range(2000):
                share = share * ((weight / (own @ share)) @ own) / weight.sum()
            value = weight @ np.log(own @ share) - cost * k
            if best is None or value > best[0]:
                best = (value, dict(zip(chosen, share)))
    return best[1]


WORDS = {"en": "the and of in to house river with their people from water over again", "de": "der und die nicht haus wasser über menschen wieder durch schön",
         "fr": "le et la dans maison rivière avec peuple eau encore être très", "es": "el y los casa río con gente agua otra vez más niño"}


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))


def test_mixtures_equal_the_exhaustive_choice(spark, make_docs):
    rng = random.Random(7)
    learn = [(i, sentence(rng, lang, 60), lang) for i, lang in enumerate(list(WORDS) * 30)]
    langs, log_p = language.train(make_docs(learn))
    table = language.odds_table(log_p)
    assert langs == sorted(WORDS)
    sizes = collections.Counter()
    for parts in [("en",), ("de",), ("en", "fr"), ("de", "es"), ("en", "de", "fr"), ("es", "fr", "en"), tuple(WORDS)] * 3:
        text = " ".join(sentence(rng, lang, rng.randint(60, 90)) for lang in parts)
        of, n = np.unique(language.features(text), return_counts=True)
        want = plain_mixture(table[of], n.astype(float), 6.0 * np.log(n.sum() + 1.0) / 2)
        got = dict(language.infer(text, langs, table))
        assert {langs[i] for i in want} == set(got) == set(parts)
        assert all(abs(got[langs[i]] - share) < 0.01 for i, share in want.items())
        sizes[len(got)] += 1
    assert sizes[3] == 6 and sizes[4] == 3


def test_sample_bound_holds_without_ids(make_docs):
    """Rows without doc_id are sampled by their text's hash, not all taken."""
    rng = random.Random(5)
    docs = make_docs([(None, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)), "en") for _ in range(4000)])
    _, few = language.train(docs, per_language=100)
    _, all_ = language.train(docs, per_language=10_000)
    seen = [(np.exp(p) > np.exp(p).min() * 1.5).sum() for p in (few, all_)]
    assert seen[0] < seen[1] / 3


def test_too_many_labels_are_an_error(make_docs, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    with pytest.raises(ValueError):
        language.train(make_docs([(i, "text", f"l{i}") for i in range(5)]))
    assert language.train(make_docs([(1, "text", "en")]).filter(F.lit(False)))[0] == []
