"""Text files in splits, day tables that are appended to and rewritten, streams over them, exact medians, paged messages."""

import json
import math
import os
import random
import statistics

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sensorlake.operators import aggregates as ag
from sensorlake.plans import rules as ru
from sensorlake.session import local_frame
from sensorlake.sources import files, sinks

DAY = 86400


@pytest.fixture()
def conf(spark):
    """Settings changed for one test."""
    old = {}

    def put(key, value):
        old.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)
    yield put
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# text in splits (SR6) ------------------------------------------------------------------------------
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_text_file_larger_than_a_split(spark, tmp, conf, end):
    """A file in many splits, each line numbered as in the whole file."""
    rng = random.Random(1)
    want = {}
    for name in ("a", "b", "empty"):
        lines = [] if name == "empty" else ["x" * rng.randrange(60) + (" ü☃" if rng.random() < 0.2 else "") for _ in range(4000)]
        with open(os.path.join(tmp, f"{name}.txt"), "w", newline="", encoding="utf-8") as f:
            f.write(end.join(lines))
        want |= {(f"{name}.txt", i + 1): line for i, line in enumerate(lines)}
    conf("spark.sql.files.maxPartitionBytes", "4k")
    conf("spark.sql.files.openCostInBytes", "0")
    df = files.read_text_lines(spark, tmp)
    assert df.rdd.getNumPartitions() > 1
    splits = spark.read.option("lineSep", "\n").text(tmp).select("_metadata.file_block_start").distinct().count()
    assert splits > 20
    got = {(os.path.basename(r["file"]), r["line_no"]): r["value"] for r in df.collect()}
    assert got == {k: v for k, v in want.items()}


def test_blocks_of_a_split_file(spark, tmp, conf):
    text = "\n".join(["head"] + [f"BEGIN\nrow {i}\nrow {i}b\nEND\nbetween" for i in range(500)])
    with open(os.path.join(tmp, "t.txt"), "w") as f:
        f.write(text)
    conf("spark.sql.files.maxPartitionBytes", "1k")
    conf("spark.sql.files.openCostInBytes", "0")
    got = files.parse_block_text(files.read_text_lines(spark, tmp), "^BEGIN$", "^END$").collect()
    assert sorted((r["block_id"], r["value"]) for r in got) == sorted((i + 1, v) for i in range(500) for v in (f"row {i}", f"row {i}b"))


# day tables (SK5, SK7, GO7) ------------------------------------------------------------------------
def test_hot_day_in_many_files_with_pruning(spark, tmp, conf):
    """A day with nearly all rows is written by several tasks, in files of disjoint ranges of the cluster key."""
    path = os.path.join(tmp, "t")
    conf("spark.sql.shuffle.partitions", "6")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(30000).select((F.col("id") % 100).cast("int").alias("tag"), F.when(F.col("id") < 29900, F.col("id")).otherwise(
        DAY + F.col("id")).alias("t"), F.lit(1.0).alias("v"))
    sinks.replace_days(rows, path, "t", ["tag"])
    found = []
    for f in os.listdir(os.path.join(path, "day=1970-01-01")):
        if f.endswith(".parquet"):
            meta = pq.ParquetFile(os.path.join(path, "day=1970-01-01", f)).metadata
            s = [meta.row_group(g).column(0).statistics for g in range(meta.num_row_groups)]
            found.append((min(x.min for x in s), max(x.max for x in s)))
    found.sort()
    assert len(found) >= 4 and all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    change = rows.filter("tag = 7").withColumn("v", F.lit(2.0))
    sinks.upsert_days(spark, path, change, ["tag", "t"], "t")
    back = spark.read.parquet(path)
    assert back.groupBy("v").count().orderBy("v").collect() == [(1.0, 29700), (2.0, 300)]
    assert len([f for f in os.listdir(os.path.join(path, "day=1970-01-01")) if f.endswith(".parquet")]) >= 4
    plan = back.filter("tag = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(tag), EqualTo(tag,3)]" in plan


def test_stream_over_a_rewritten_table(spark, tmp):
    """Appended rows once each: days rewritten before and after the stream saw them, deleted days, no change rows."""
    path, out, ck = (os.path.join(tmp, x) for x in ("t", "out", "ck"))
    schema = "k long, t long, v double"

    def rows(lo, hi, v=1.0):
        return spark.range(lo, hi).select(F.col("id").alias("k"), (F.col("id") * 3600).alias("t"), F.lit(v).alias("v"))

    def run():
        sinks.write_stream(files.read_appended(spark, path, schema), out, ck, available_now=True).awaitTermination(120)

    def seen():
        return sorted((r["k"], r["v"]) for r in spark.read.parquet(out).collect())

    sinks.append_days(rows(0, 48), path, "t")
    run()
    assert seen() == [(k, 1.0) for k in range(48)]
    sinks.upsert_days(spark, path, rows(10, 20, 5.0), ["k", "t"], "t")  # its append was read
    run()
    sinks.append_days(rows(48, 72), path, "t")
    sinks.upsert_days(spark, path, rows(40, 60, 7.0), ["k", "t"], "t")  # of the second append nothing was read
    sinks.upsert_days(spark, path, rows(50, 52, 8.0), ["k", "t"], "t")
    run()
    assert seen() == [(k, 1.0) for k in range(72)]
    assert sinks.drop_days_before(spark, path, "1970-01-02") == ["1970-01-01"]
    sinks.append_days(rows(72, 73), path, "t")
    run()
    assert seen() == [(k, 1.0) for k in range(73)]
    table = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert table == {k: 8.0 if k in (50, 51) else 7.0 if 40 <= k < 60 else 1.0 for k in range(24, 73)}


def test_replacing_a_day_reads_itself(spark, tmp):
    path = os.path.join(tmp, "t")
    sinks.append_days(local_frame(spark, [(1, 0, 1.0), (2, 0, 2.0), (3, DAY, 3.0)], "k int, t long, v double"), path, "t")
    old = spark.read.parquet(path).drop("day")
    sinks.replace_days(old.filter("t = 0").withColumn("v", F.col("v") * 10), path, "t")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, 10.0), (2, 20.0), (3, 3.0)]
    assert not [f for f in os.listdir(path) if f.startswith("_staged")]


# exact median (AG3) --------------------------------------------------------------------------------
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_median(spark, seed):
    rng = random.Random(seed)
    rows = []
    for key, n in (("hot", 9001), ("even", 4000), ("one", 1), ("two", 2), ("ties", 3000), ("nulls", 5), (None, 77)):
        for _ in range(n):
            v = rng.choice([1.0, 2.0, 2.5]) if key == "ties" else None if key == "nulls" else rng.gauss(0, 1) * 10 ** rng.randrange(4)
            rows.append((key, v if rng.random() > 0.05 or n < 3 else None))
    rows += [("nan", float("nan")), ("nan", 1.0), ("nan", 2.0), ("inf", float("inf")), ("inf", 4.0)]
    df = local_frame(spark, rows, "key string, v double")
    got = {r["key"]: r["median"] for r in ag.exact_median(df, ["key"], "v").collect()}
    own = {r["key"]: r["m"] for r in df.groupBy("key").agg(F.median("v").alias("m")).collect()}
    for key, want in own.items():
        assert got.get(key) == want or math.isnan(want) and math.isnan(got[key]), key
    assert "nulls" not in got and got["nan"] == 2.0
    hot = [v for k, v in rows if k == "hot" and v is not None]
    assert got["hot"] == statistics.median(hot)
    every = ag.exact_median(df.filter("key = 'hot'"), [], "v").collect()
    assert [r["median"] for r in every] == [statistics.median(hot)]


def test_median_orders_only_the_bracket(spark):
    """Of a hot key's rows only those near the median reach the ordering window."""
    df = spark.range(200_000).select(F.lit("a").alias("key"), F.rand(3).alias("v"))
    out = ag.exact_median(df, ["key"], "v")
    assert out.collect()[0]["median"] == df.agg(F.median("v")).first()[0]
    assert ag.median_bracket(df, ["key"], "v").count() < 200_000 * 0.01


# messages (RU14) -----------------------------------------------------------------------------------
def test_pages_of_a_wildcard_rule(spark, conf):
    """A rule over all assets on one day: pages as if its anomalies were one sorted list, numbered in many tasks."""
    rng = random.Random(4)
    rows = [(1, rng.randrange(500), (t := rng.randrange(DAY)), t + rng.randrange(90)) for _ in range(3000)]
    rows += [(1, None, 5, 6), (1, 3, 2 * DAY, 2 * DAY), (2, 4, 1, 1)]
    an = local_frame(spark, rows, "rule_id int, asset_id long, start_time long, end_time long")
    header = local_frame(spark, [(1, 0, 99, "x"), (2, 0, 99, "y")], "rule_id int, start_time long, end_time long, name string")
    got = {}
    for r in ru.messages(an, header, page=100).collect():
        got.setdefault(r["rule_id"], {})[r["page"]] = json.loads(r["message"])["anomalies"]
    for rule in (1, 2):
        want = sorted((s, e, a is not None, a or 0) for i, a, s, e in rows if i == rule)
        pages = got[rule]
        assert sorted(pages) == list(range(-(-len(want) // 100)))
        for p, own in pages.items():
            assert [(x["start_time"], x["end_time"], x.get("asset_id")) for x in own] == [
                (s, e, a if known else None) for s, e, known, a in want[100 * p:100 * p + 100]]
    plan = ru.messages(an, header)._jdf.queryExecution().optimizedPlan().toString()
    assert "_cell" in plan
