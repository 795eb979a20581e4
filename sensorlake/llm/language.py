"""Language identification by mixtures of languages over n-gram likelihoods."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import cut_lineage

UNKNOWN = "und"
BUCKETS = 1 << 16
MAX_LANGUAGES = 1000
ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(ASCII_LETTER.search(text)) or any(map(str.isalpha, text)))


def features(text: str) -> np.ndarray:
    """Hashed n-grams of a whole text: 3 and 4 bytes of the lower-cased UTF-8 text, runs of white space
    and digits as one space each, one space around. Features are bucket numbers below ``BUCKETS``."""
    data = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), dtype=np.uint8)
    blank = (data <= 32) | ((data >= 48) & (data <= 57))
    keep = ~blank
    keep[0] = True
    keep[1:] |= ~blank[:-1]
    data = np.where(blank, np.uint8(32), data)[keep].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, dtype=np.uint32)
    three = data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)
    four = three[:-1] | data[3:] << np.uint32(24)
    mixed = np.concatenate([three * np.uint32(0x9E3779B1), four * np.uint32(0x85EBCA77) ^ np.uint32(0x27D4EB2F)])
    mixed ^= mixed >> np.uint32(15)
    return mixed * np.uint32(0x2C1B3C6D) >> np.uint32(16)


def train(docs: DataFrame, per_language: int = 2000) -> tuple[list[str], np.ndarray]:
    """Languages and log P(feature | language), from rows with text and lang.

    The fit takes about ``per_language`` rows of each language (all, if fewer), chosen by a hash of the
    doc_id (of the text, where that is null), and their whole texts: a documented bound, as a classifier's sample may have. Counts are
    summed on Spark; what reaches the driver is at most languages x ``BUCKETS`` numbers. Labels are languages, so
    more than ``MAX_LANGUAGES`` of them are an error, not a table that no worker could hold.
    """
    usable = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = cut_lineage(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).select(F.col("lang").alias("l"), "n"))
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    if sizes.count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    share = F.pmod(spread, F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = usable.join(sizes, F.col("lang") == F.col("l")).filter(share * F.col("n") < F.lit(float(per_language)))

    def count(batches):
        for batch in batches:
            by: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(lang, []).append(features(text))
            for lang, parts in by.items():
                of, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(of), pa.string()), pa.array(of.astype(np.int32)), pa.array(n)],
                                                 names=["lang", "f", "n"])

    got = (sample.select("text", "lang").mapInArrow(count, "lang string, f int, n long")
           .groupBy("lang", "f").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(got["lang"].unique().tolist())
    place = {lang: i for i, lang in enumerate(langs)}
    counts = np.full((len(langs), BUCKETS), 0.2)
    if langs:
        np.add.at(counts, (got["lang"].map(place).to_numpy(), got["f"].to_numpy()), got["n"].to_numpy())
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def odds_table(log_p: np.ndarray) -> np.ndarray:
    """features x languages: likelihoods over each feature's best."""
    if not len(log_p):
        return np.zeros((BUCKETS, 0))
    return np.exp(log_p - log_p.max(axis=0)).T.astype(np.float64) + 1e-12


def _fit(odds: np.ndarray, weight: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """EM for the proportions of a mixture over n-grams with ``odds`` (n-grams x languages) and counts.
    Returns proportions and log likelihood (up to a constant of the text)."""
    k = odds.shape[1]
    share = np.full(k, 1.0 / k)
    total = weight.sum()
    for _ in range(rounds if k > 1 else 0):
        new = share * ((weight / (odds @ share)) @ odds) / total
        moved = np.abs(new - share).max()
        share = new
        if moved < 5e-4:
            break
    return share, float(weight @ np.log(odds @ share))


def infer(text: str | None, langs: list[str], table: np.ndarray, penalty: float = 6.0,
          rounds: int = 40) -> list[tuple[str, float]]:
    """Languages of a text with their proportions, largest first; empty if null or without letters.

    EM over all languages (``table`` from ``odds_table``) gives the proportions; languages are then left
    out, smallest first, as long as the log likelihood, less ``penalty`` * log(number of n-grams) / 2 a
    language, does not fall. Where the best language alone already reaches what any set of two could,
    the other fits are not needed.
    """
    if not langs or not has_letter(text):
        return []
    of, n = np.unique(features(text), return_counts=True)
    if not len(of):
        return []
    odds = table[of]
    weight = n.astype(np.float64)
    cost = penalty * np.log(weight.sum() + 1.0) / 2
    chosen = np.arange(len(langs))
    share, fit = _fit(odds, weight, rounds)
    best = int(np.argmax(weight @ np.log(odds)))
    if float(weight @ np.log(odds[:, best])) >= fit - cost:
        return [(langs[best], 1.0)]
    while len(chosen) > 1:
        out = int(np.argmin(share))
        rest = np.delete(np.arange(len(chosen)), out)
        less, worse = _fit(odds[:, chosen[rest]], weight, rounds)
        if worse + cost < fit:
            break
        chosen, share, fit = chosen[rest], less, worse
    order = np.argsort(-share, kind="stable")
    return [(langs[chosen[i]], float(share[i])) for i in order]


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], keep_columns: tuple[str, ...] = ("doc_id",),
             penalty: float = 6.0) -> DataFrame:
    """``keep_columns`` with lang_pred, score (its proportion, 0 to 1) and n_langs (languages selected).

    lang_pred is the language with the largest proportion; ``und`` with score 0 if the text is null, has
    no letters, or nothing was learned. Every row is predicted from its whole text alone. Empty input: no rows.
    """
    langs, log_p = model
    model_of = docs.sparkSession.sparkContext.broadcast(log_p)  # languages x BUCKETS floats

    def run(batches):
        table = odds_table(model_of.value)
        for batch in batches:
            got = [infer(t, langs, table, penalty) for t in batch.column(0).to_pylist()]
            cols = [pa.array([g[0][0] if g else UNKNOWN for g in got], pa.string()),
                    pa.array([min(1.0, g[0][1]) if g else 0.0 for g in got], pa.float64()),
                    pa.array([len(g) for g in got], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *cols],
                                             names=[*batch.schema.names[1:], "lang_pred", "score", "n_langs"])

    kept = docs.select(F.col("text").alias("_text"), *keep_columns)
    out = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep_columns)
    return kept.mapInArrow(run, f"{out}, lang_pred string, score double, n_langs int")


def held_out(doc_id) -> "F.Column":
    """crc32 of the doc_id as text, modulo 4, is 2 (null doc_id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
