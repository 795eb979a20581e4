"""The pipeline's stages against plain versions, each on its own input."""

import llm_plain as brute
from llm_plain import ODD

import corpus_pipeline as pipeline
from sensorlake.llm import language, mixing
from sensorlake.llm.common import cut_lineage

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def check(spark, docs):
    stages = dict(pipeline.STAGES)
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "source_mixing", "best_fit_packing"]
    spoken = cut_lineage(stages["language_id"](spark, docs, SF))
    assert spoken.columns == COLUMNS
    given = rows(docs)
    kept = rows(spoken)
    assert all(any(c.isalpha() for c in t) for _, t in kept)
    assert sum(any(c.isalpha() for c in t or "") for _, t in given) - len(kept) <= 0.01 * len(given)

    single = cut_lineage(stages["simhash_near_dedup"](spark, spoken, SF))
    assert single.columns == COLUMNS
    prints = [brute.simhash(t) for _, t in kept]
    named = [k for k, (i, _) in enumerate(kept) if i is not None]
    root = brute.groups(len(named), lambda a, b: (prints[named[a]] ^ prints[named[b]]).bit_count() <= 4)
    least = {}
    for k, r in zip(named, root):
        least[r] = min(least.get(r, kept[k][0]), kept[k][0])
    want = set(least.values()) | ({None} if any(i is None for i, _ in kept) else set())
    assert {i for i, _ in rows(single)} == want

    clean = cut_lineage(stages["suffix_array_dedup"](spark, single, SF))
    assert clean.columns == COLUMNS
    before = rows(single)
    judged = brute.byte_repeats(before)
    after = {}
    for i, t in rows(clean):
        after.setdefault(i, []).append(t)
    assert sorted(map(str, after)) == sorted({str(i) for i, _ in before})
    for (i, t), (_, _, gone, _, _) in zip(before, judged):
        if i is not None and not gone:
            assert t in after[i]
        elif i is not None:
            size = len(after[i][0].encode())
            assert len(t.encode()) - gone <= size <= len(t.encode()) - gone + 8

    mixed = cut_lineage(stages["source_mixing"](spark, clean, SF))
    assert mixed.columns == COLUMNS
    taken = mixing.mix(clean).collect()
    assert mixed.count() == sum(r["copies"] for r in taken)
    words = sum(len(brute.words(t)) for _, t in rows(mixed))
    assert words == sum(r["taken"] for r in taken)

    packed = stages["best_fit_packing"](spark, mixed, SF).collect()
    assert sum(r["piece"] == 0 for r in packed) == mixed.count()
    by = {}
    for r in packed:
        by[r["sequence_id"]] = by.get(r["sequence_id"], 0) + r["length"]
    assert max(by.values(), default=0) <= pipeline.MAX_TOKENS


def test_stages_on_tables(spark):
    check(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_stages_on_odd_rows(spark, odd_docs):
    check(spark, odd_docs.unionByName(odd_docs.limit(0)))
    assert len(ODD) > 10


def test_language_stage_keeps_even_mixtures(spark):
    """Clean documents of three and four languages in about equal parts stay, though no share reaches 0.4."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*COLUMNS)
    one = {}
    for r in docs.filter("n_chars between 1500 and 2000").orderBy("doc_id").collect():
        one.setdefault(r["lang"], r["text"][:1500])
    de, en, es, fr = (one[k] for k in ("de", "en", "es", "fr"))
    given = [(-1, "\n".join((de, es, fr)), "de", "a"), (-2, "\n".join((de, en, es, fr)), "de", "a"), (-3, "12 34 --", "de", "a")]
    mixed = spark.createDataFrame([(*r, len(r[1])) for r in given], docs.schema)
    table = language.odds_table((model := language.train(docs.unionByName(mixed)))[1])
    for _, text, *_ in given[:2]:
        assert 3 <= len(found := language.infer(text, model[0], table)) and found[0][1] < 0.4
    kept = dict(pipeline.STAGES)["language_id"](spark, docs.unionByName(mixed), SF).filter("doc_id < 0").collect()
    assert {r["doc_id"]: r["text"] for r in kept} == {i: t for i, t, *_ in given[:2]}
    assert all(r["lang"] in ("de", "en", "es", "fr") for r in kept)


def test_simhash_stage_groups_rows_without_id(spark, make_docs):
    """Near copies without a doc_id leave one row; what is far from them stays."""
    base = [f"word{i}" for i in range(3000)]
    near = [" ".join(w if i != at else "other" for i, w in enumerate(base)) for at in (3, 250, 400)]
    prints = [brute.simhash(t) for t in near]
    assert all((prints[0] ^ p).bit_count() <= 4 for p in prints) and len(set(near)) == 3
    far = " ".join(f"else{i}" for i in range(300))
    assert (brute.simhash(far) ^ prints[0]).bit_count() > 4
    given = [(None, t) for t in (*near, near[0], far, far)] + [(5, "a b c"), (None, None), (None, "")]
    got = rows(dict(pipeline.STAGES)["simhash_near_dedup"](spark, make_docs(given), SF))
    assert [i for i, _ in got].count(5) == 1 and len(got) == 4
    texts = [t for i, t in got if i is None]
    assert texts.count(far) == 1 and sum(t in near for t in texts) == 1 and sum(not t for t in texts) == 1


def test_stages_on_no_rows(spark, no_docs):
    for _, stage in pipeline.STAGES:
        assert stage(spark, no_docs.select(*COLUMNS), SF).count() == 0


def test_run_equals_its_stages(spark):
    got = pipeline.run(spark, SF)
    assert got.count() > 0 and got.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert pipeline.ORACLE_SQL is None
