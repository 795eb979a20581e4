"""Registered streams: availableNow runs over arrivals of the readings, late and repeated rows among them, with the
state carried from run to run by the checkpoint and the sink read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .catalog import DAY, register
from .session import ensure_checkpoint_dir, local_frame
from .sources import files, sinks
from .streaming import tags
from .tables import table

ARRIVALS = 3
DELAY = "2 days"
HOUR = 3600

#: Readings in the order in which they come in: a third of the time span each, one in ten a run late, one in ten
#: in the last run whatever its time, and one in six sent again a run later.
ARRIVALS_SQL = f"""
WITH t AS (SELECT min(floor(epoch(ts)))::BIGINT AS lo, max(floor(epoch(ts)))::BIGINT AS hi FROM events),
e AS (SELECT event_id, event_type AS tag_id, value, floor(epoch(ts))::BIGINT AS epoch,
             ({ARRIVALS} * (floor(epoch(ts))::BIGINT - lo)) // (hi - lo + 1) AS q FROM events, t),
a AS (SELECT event_id, tag_id, value, epoch, CASE event_id % 10 WHEN 7 THEN {ARRIVALS - 1} WHEN 3 THEN least({ARRIVALS - 1}, q + 1) ELSE q END AS arrival FROM e),
sent AS (SELECT * FROM a UNION ALL
         SELECT event_id, tag_id, value, epoch, arrival + 1 FROM a WHERE event_id % 6 = 0 AND arrival < {ARRIVALS - 1}),
wm AS (SELECT i AS arrival, coalesce((SELECT max(epoch) FROM sent WHERE arrival < i) - {2 * DAY}, 0) AS wm FROM range({ARRIVALS + 1}) r(i)),
kept AS (SELECT tag_id, value, epoch, min(arrival) AS arrival FROM sent JOIN wm USING (arrival) WHERE epoch > wm GROUP BY tag_id, value, epoch)"""


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """tag_id, value, timestamp (whole seconds), event_id, arrival (the run they come in at)."""
    ev = table(spark, sf, "events")
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    span = ev.select(F.struct(F.min(epoch).alias("lo"), F.max(epoch).alias("hi"))).scalar()
    e = ev.select("event_id", F.col("event_type").alias("tag_id"), "value", F.timestamp_seconds(epoch).alias("timestamp"),
                  epoch.alias("_e"), span.alias("_s"))
    third = F.floor(ARRIVALS * (F.col("_e") - F.col("_s.lo")) / (F.col("_s.hi") - F.col("_s.lo") + 1))
    late = F.pmod("event_id", F.lit(10))
    a = e.withColumn("arrival", F.when(late == 7, F.lit(ARRIVALS - 1)).when(late == 3, F.least(F.lit(ARRIVALS - 1), third + 1))
                     .otherwise(third).cast("int")).drop("_e", "_s")
    again = a.filter((F.pmod("event_id", F.lit(6)) == 0) & (F.col("arrival") < ARRIVALS - 1))
    return a.unionByName(again.withColumn("arrival", F.col("arrival") + 1))


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sensorlake-stream-{uuid.uuid4().hex}"


def run_arrivals(rows: DataFrame, start: Callable[[DataFrame, str], StreamingQuery]) -> str:
    """One availableNow run after each arrival's files: ``start(stream, folder)`` begins the query on the files so far,
    always with the same checkpoint. State is kept in no more partitions than twice the cores, as every batch
    visits them all. Returns the folder."""
    spark, folder = rows.sparkSession, _folder(rows.sparkSession)
    rows.write.partitionBy("arrival").parquet(f"{folder}/all")
    held = spark.read.parquet(f"{folder}/all")
    columns = [c for c in rows.columns if c != "arrival"]
    own = spark.conf.get("spark.sql.shuffle.partitions")
    for i in range(ARRIVALS):
        held.filter(F.col("arrival") == i).select(*columns).write.parquet(f"{folder}/in/{i}")
        stream = spark.readStream.schema(held.select(*columns).schema).parquet(f"{folder}/in/*")
        spark.conf.set("spark.sql.shuffle.partitions", str(min(int(own), 2 * spark.sparkContext.defaultParallelism)))
        try:
            query = start(stream, folder)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", own)
        query.awaitTermination()
    return folder


# ---------------------------------------------------------------- SM2 (SM1, SK1): de-duplicated silver

SM2_SQL = ARRIVALS_SQL + "\nSELECT tag_id, value, epoch FROM kept\n"


@register("sm2_dedup_stream", SM2_SQL)
def sm2_dedup_stream(spark: SparkSession, sf: str) -> DataFrame:
    """SM1/SM2/SK1: a silver stream over three runs; repeats within the watermark and late rows are dropped."""
    def start(stream, folder):
        silver = tags.dedup_silver(stream.drop("event_id"), watermark=DELAY)
        return sinks.write_stream(silver, f"{folder}/out", f"{folder}/ck", available_now=True)
    out = run_arrivals(arrivals(spark, sf), start)
    return spark.read.parquet(f"{out}/out").select("tag_id", "value", F.unix_seconds("timestamp").alias("epoch"))


# ---------------------------------------------------------------- SM3: soft tags in event-time windows

SM3_MAP = [("busy", "click", "average"), ("busy", "view", "average"), ("peak", "purchase", "maximum"),
           ("middle", "error", "median"), ("rate", "purchase", "sum"), ("rate", "signup", "sum")]
SM3_SQL = ARRIVALS_SQL + f""",
m AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in SM3_MAP)}) AS t(output_tag, tag_id, function)),
w AS (SELECT output_tag, function, value, epoch, epoch - epoch % {6 * HOUR} AS window_start, arrival
      FROM sent JOIN m USING (tag_id)),
g AS (SELECT output_tag, window_start, any_value(function) AS fn, avg(value) AS av, max(value) AS mx, median(value) AS md, sum(value) AS sm,
             max(epoch) AS epoch
      FROM w JOIN wm USING (arrival) WHERE window_start + {6 * HOUR} > wm GROUP BY ALL)
SELECT output_tag AS tag_id, window_start, epoch, 'Good' AS quality,
       round(CASE fn WHEN 'average' THEN av WHEN 'maximum' THEN mx WHEN 'median' THEN md ELSE sm END, 6) AS value
FROM g WHERE window_start + {6 * HOUR} <= (SELECT wm FROM wm WHERE arrival = {ARRIVALS})
"""


@register("sm3_soft_tag_stream", SM3_SQL)
def sm3_soft_tag_stream(spark: SparkSession, sf: str) -> DataFrame:
    """SM3/AG3: soft tags of six-hour windows, written when the watermark has closed a window."""
    mapping = local_frame(spark, SM3_MAP, "output_tag string, input_tag string, function string")

    def start(stream, folder):
        soft = tags.soft_tag_stream(stream, mapping, window="6 hours", watermark=DELAY)
        return sinks.write_stream(soft, f"{folder}/out", f"{folder}/ck", available_now=True)
    out = run_arrivals(arrivals(spark, sf), start)
    return spark.read.parquet(f"{out}/out").select(
        "tag_id", F.unix_seconds("window_start").alias("window_start"), F.unix_seconds("timestamp").alias("epoch"), "quality",
        F.round("value", 6).alias("value"))


# ---------------------------------------------------------------- SM4 (SK2): pivot of each micro-batch

SM4_TAGS = ["click", "view", "purchase"]
SM4_SQL = ARRIVALS_SQL + f""",
f AS (SELECT tag_id, value, epoch, epoch - epoch % {6 * HOUR} AS batch, arrival FROM kept WHERE tag_id IN ('click', 'view', 'purchase')),
p AS (SELECT arrival, batch, max(value) FILTER (WHERE tag_id = 'click') AS a, max(value) FILTER (WHERE tag_id = 'view') AS b,
             max(value) FILTER (WHERE tag_id = 'purchase') AS c, max(epoch) AS epoch FROM f GROUP BY arrival, batch)
SELECT 'derived' AS tag_id, round(100.0 - a - b - c, 6) AS value, epoch, 'Good' AS quality FROM p
"""


@register("sm4_pivot_batches", SM4_SQL)
def sm4_pivot_batches(spark: SparkSession, sf: str) -> DataFrame:
    """SM4/SK2: each micro-batch of the silver stream pivoted to a derived tag and written by its batch id."""
    derive = tags.pivot_batch(SM4_TAGS, lambda j: 100.0 - F.col("click") - F.col("view") - F.col("purchase"))

    def start(stream, folder):
        silver = tags.dedup_silver(stream.drop("event_id"), watermark=DELAY)
        epoch = F.unix_seconds("timestamp")
        silver = silver.withColumn("last_updated_date", epoch - F.pmod(epoch, F.lit(6 * HOUR)))
        write = sinks.idempotent_batch_writer(f"{folder}/out", derive)
        return sinks.write_stream_batch(silver, write, f"{folder}/ck", available_now=True)
    out = run_arrivals(arrivals(spark, sf), start)
    return spark.read.parquet(f"{out}/out").select("tag_id", F.round("value", 6).alias("value"), F.unix_seconds("timestamp").alias("epoch"), "quality")


# ---------------------------------------------------------------- SM5 (JN1, JN2): physical tags, enriched

SM5_NAMES = ["click", "error", "purchase", "signup", "view"]
SM5_SQL = ARRIVALS_SQL + f""",
names AS (SELECT [{", ".join(f"'{t}'" for t in SM5_NAMES)}][r_regionkey + 1] AS tag_id, r_name AS measurement_set_uuid FROM region)
SELECT tag_id, value, epoch, measurement_set_uuid FROM kept JOIN names USING (tag_id) WHERE tag_id <> 'signup'
"""


@register("sm5_enriched_stream", SM5_SQL)
def sm5_enriched_stream(spark: SparkSession, sf: str) -> DataFrame:
    """SM5/JN1/JN2/SK1: silver without aggregation tags, joined to the tags' metadata as a stream."""
    names = F.array(*[F.lit(t) for t in SM5_NAMES])
    meta = table(spark, sf, "region").select(F.element_at(names, F.col("r_regionkey") + 1).alias("source_tag_id"),
                                             F.col("r_name").alias("measurement_set_uuid"))
    calculated = local_frame(spark, [("signup",)], "tag_id string")

    def start(stream, folder):
        silver = tags.dedup_silver(stream.drop("event_id"), watermark=DELAY)
        gold = tags.enrich_gold(tags.physical_tags(silver, calculated), meta)
        return sinks.write_stream(gold, f"{folder}/out", f"{folder}/ck", available_now=True)
    out = run_arrivals(arrivals(spark, sf), start)
    return spark.read.parquet(f"{out}/out").select("tag_id", "value", F.unix_seconds("timestamp").alias("epoch"), "measurement_set_uuid")


# ---------------------------------------------------------------- SR4: appended rows of a table that is rewritten

SR4_SQL = """
SELECT event_id, event_type AS tag_id, floor(epoch(ts))::BIGINT AS epoch, value FROM events
"""


@register("sr4_appended_rows_stream", SR4_SQL)
def sr4_appended_rows_stream(spark: SparkSession, sf: str) -> DataFrame:
    """SR4/SK5/PB7: a stream over a table whose days are updated and dropped between its runs gives every
    appended row once, as it was appended."""
    folder = _folder(spark)
    path = f"{folder}/table"
    rows = arrivals(spark, sf).withColumn("epoch", F.unix_seconds("timestamp")).select("event_id", "tag_id", "epoch", "value", "arrival")
    rows = rows.groupBy("event_id", "tag_id", "epoch", "value").agg(F.min("arrival").alias("arrival"))
    rows.write.parquet(f"{folder}/all")
    held = spark.read.parquet(f"{folder}/all")
    schema = held.drop("arrival").schema

    def catch_up():
        stream = files.read_appended(spark, path, schema)
        sinks.write_stream(stream, f"{folder}/out", f"{folder}/ck", available_now=True).awaitTermination()

    def add(i):
        sinks.append_days(held.filter(F.col("arrival") == i).drop("arrival"), path, "epoch", ["tag_id"])

    def update(m):
        changed = held.filter((F.col("arrival") == 0) & (F.pmod("event_id", F.lit(50)) == m)).drop("arrival")
        sinks.upsert_days(spark, path, changed.withColumn("value", F.col("value") + 1), ["event_id", "epoch"], "epoch")

    add(0)
    catch_up()
    add(1)
    update(1)  # before the stream has seen the second append
    catch_up()
    update(2)
    add(2)
    sinks.drop_days_before(spark, path, "1970-01-02")
    catch_up()
    return spark.read.parquet(f"{folder}/out").select("event_id", "tag_id", "epoch", "value")
