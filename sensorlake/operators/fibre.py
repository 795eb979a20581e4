"""Fibre measurements: acoustic (DAS) silver and band registry, publish windows
and depth-by-time matrix products (DA1-DA2, SR7, PB1-PB8).

Matrices are built from aggregates, never by collecting raw rows: rows are
averaged per (asset, time bucket, depth) first, then one series per depth
(bounded by the bucket count) and one matrix per asset (bounded by
depths x buckets) are collected in position order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Publish windows in seconds: 30 min, 1 h, 1 day, 1 week, 1 month.
WINDOWS = {"30min": 1800, "1hour": 3600, "1day": 86400, "1week": 604800, "1month": 2592000}

# Marker for acoustic rows whose device has no asset.
MISSING_ASSET = "No_match_found_in_Asset_for_device_id"


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def window_bounds(t, window: int, kind: str = "dts") -> tuple[Column, Column]:
    """Publish window ``[start, end]`` (inclusive, epoch s) holding time ``t`` (PB1).

    Fixed windows floor to the window size. For temperature (``dts``) a week is
    Monday..Sunday and a month the calendar month; for acoustic (``das``) the
    week product runs on 6-hour chunks and the month product on days. UTC.
    """
    t = _c(t).cast("long")
    ts = F.timestamp_seconds(t)
    if window == WINDOWS["1week"]:
        if kind == "das":
            s = t - F.pmod(t, F.lit(21600))
            return s, s + 21600 - 1
        s = F.unix_seconds(F.date_trunc("week", ts))
        return s, s + 7 * 86400 - 1
    if window == WINDOWS["1month"]:
        if kind == "das":
            s = t - F.pmod(t, F.lit(86400))
            return s, s + 86400 - 1
        s = F.unix_seconds(F.date_trunc("month", ts))
        e = F.unix_seconds(F.date_trunc("month", F.timestamp_seconds(s) + F.expr("INTERVAL 1 MONTH"))) - 1
        return s, e
    s = t - F.pmod(t, F.lit(int(window)))
    return s, s + int(window) - 1


def window_start(t, window: int, previous: bool = False) -> Column:
    """Current (or previous) fixed window start for an "as of" time (PB2)."""
    s = _c(t).cast("long") - F.pmod(_c(t).cast("long"), F.lit(int(window)))
    return s - int(window) if previous else s


def publish_gates(as_of) -> tuple[Column, Column]:
    """S12: acoustic week product runs when hour mod 6 = 5 and minute > 30; month
    product at hour 23 and minute > 30 (on data time minus one engine period)."""
    ts = F.timestamp_seconds(_c(as_of).cast("long"))
    h, m = F.hour(ts), F.minute(ts)
    return (F.pmod(h, F.lit(6)) == 5) & (m > 30), (h == 23) & (m > 30)


def shape_das_bronze(df: DataFrame, bands: DataFrame, assets: DataFrame, band_col: str = "band_id",
                     device_col: str = "device_id", n_depth_col: str = "n_depth") -> DataFrame:
    """SR7: decoded acoustic rows -> (band label, asset, depth array).

    Band label = ``"<start>-<end>"`` from the band table; depth = ``sequence(0, n-1)``;
    a device without an asset gets the ``MISSING_ASSET`` marker.
    """
    b = bands.select(band_col, F.concat_ws("-", F.col("start").cast("string"),
                                                               F.col("end").cast("string")).alias("freq_band"))
    a = assets.select(device_col, "asset_id")
    out = df.join(b, band_col, "inner").join(a, device_col, "left")
    return (out.withColumn("asset_id", F.coalesce(F.col("asset_id").cast("string"), F.lit(MISSING_ASSET)))
               .withColumn("depth", F.sequence(F.lit(0), F.col(n_depth_col) - 1)))


def das_silver(bronze: DataFrame, keys: Sequence[str] = ("device_id", "asset_id", "freq_band"),
               time: str = "time", matrix: str = "source_data", depth: str = "depth") -> DataFrame:
    """DA1: explode each time sample with its matrix row and the row's own depths,
    microseconds -> seconds, floor to the minute, average per depth (AG11).

    Output ``keys..., time (bigint s), data array<double>, depth array<int>``,
    both in order of depth. A fibre whose length changes keeps each row's depths.
    """
    keys = list(keys)
    rows = bronze.select(*keys, depth, F.inline(F.arrays_zip(F.col(time).alias("t"), F.col(matrix).alias("row"))))
    rows = rows.withColumn("minute", F.floor(F.col("t") / 1_000_000 / 60).cast("long") * 60)
    ex = rows.select(*keys, "minute", F.inline(F.arrays_zip(F.col(depth).alias("_d"), F.col("row").alias("_v"))))
    avg = ex.filter(F.col("_d").isNotNull()).groupBy(*keys, "minute", "_d").agg(F.avg("_v").alias("_a"))
    lst = avg.groupBy(*keys, "minute").agg(F.sort_array(F.collect_list(F.struct("_d", "_a"))).alias("_l"))
    return lst.select(*keys, F.col("minute").alias("time"), F.transform("_l", lambda x: x["_a"]).alias("data"),
                      F.transform("_l", lambda x: x["_d"]).alias(depth))


def band_registry(silver: DataFrame, registry: DataFrame | None = None, time: str = "time") -> DataFrame:
    """DA2: latest epoch per (asset, band), upserted into an existing registry."""
    fresh = silver.groupBy("asset_id", "freq_band").agg(F.max(time).alias("latest_epoch"))
    if registry is None:
        return fresh
    kept = registry.join(fresh.select("asset_id", "freq_band"), ["asset_id", "freq_band"], "left_anti")
    return kept.unionByName(fresh)


def matrix_product(df: DataFrame, keys: Sequence[str], ts: str, depth: str, value: str, n: int) -> DataFrame:
    """PB3: per key ``time[]`` (first time of each of ``n`` equal-count buckets),
    ``depth[]`` (ascending) and ``data[][]`` depth-major (mean per bucket,
    null where a depth has no reading in a bucket).

    The bucket of every distinct time (``ntile_ranks``, one row per key and
    time, far smaller than the readings) is joined to the readings once.
    """
    from .windows import ntile_ranks

    keys = list(keys)
    t = ntile_ranks(df, keys, ts, n)
    return _assemble(df.join(t, [*keys, ts], "inner"), t, keys, ts, depth, value, n)


def _assemble(cells: DataFrame, t: DataFrame, keys: list[str], ts: str, depth: str, value: str, n: int) -> DataFrame:
    """Readings with their bucket, and the buckets' times, to one product row per key."""
    times = (t.groupBy(*keys, "bucket").agg(F.min(ts).alias("_bt"))
              .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("bucket", "_bt"))).alias("_t"))
              .select(*keys, F.transform("_t", lambda x: x["_bt"]).alias("time")))
    cell = cells.groupBy(*keys, "bucket", depth).agg(F.avg(value).alias("_v"), F.first("n_times").alias("_N"))
    series = (cell.groupBy(*keys, depth)
                  .agg(F.map_from_entries(F.collect_list(F.struct("bucket", "_v"))).alias("_m"),
                       F.first("_N").alias("_N"))
                  .select(*keys, depth, F.transform(F.sequence(F.lit(1), F.least(F.lit(n), F.col("_N")).cast("int")),
                                                    lambda bk: F.element_at(F.col("_m"), bk)).alias("_s")))
    mat = (series.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(depth, "_s"))).alias("_d"))
                 .select(*keys, F.transform("_d", lambda x: x[depth]).alias("depth"),
                         F.transform("_d", lambda x: x["_s"]).alias("data")))
    return times.join(mat, keys)


def array_matrix_product(df: DataFrame, keys: Sequence[str], ts: str, data: str, n: int) -> DataFrame:
    """PB4: acoustic product: rows carry a value array over depth positions;
    buckets by ``ntile(n)`` over times, element-wise mean per (bucket, position),
    then ``time[]`` and depth-major ``data[][]`` per key (no pivot). Times are
    ranked and joined on the array rows; positions are exploded last."""
    from .windows import ntile_ranks

    keys = list(keys)
    rows = df.select(*keys, ts, data)
    t = ntile_ranks(rows, keys, ts, n)
    j = rows.join(t, [*keys, ts], "inner")
    cells = j.select(*keys, "bucket", "n_times", F.posexplode(data).alias("_pos", "_v"))
    return _assemble(cells, t, keys, ts, "_pos", "_v", n).withColumnRenamed("depth", "position")


def append_product(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PB5: append a new product to an existing one: times concatenated and each
    depth's series extended. Depths are matched by value (not position); a
    depth missing on one side gets nulls for that side's times."""
    keys = list(keys)

    def side(df, p):
        t = df.select(*keys, F.col("time").alias(f"_{p}t"))
        x = df.select(*keys, F.inline(F.arrays_zip(F.col("depth").alias("depth"), F.col("data").alias(f"_{p}s"))))
        return t, x
    ot, ox = side(old, "o")
    nt, nx = side(new, "n")
    times = ot.join(nt, keys, "full")
    series = ox.join(nx, [*keys, "depth"], "full").join(times, keys, "left")
    pad = lambda t: F.transform(F.coalesce(F.col(t), F.array().cast("array<long>")), lambda _: F.lit(None).cast("double"))
    s = F.concat(F.coalesce(F.col("_os"), pad("_ot")), F.coalesce(F.col("_ns"), pad("_nt")))
    mat = (series.select(*keys, "depth", s.alias("_s"))
                 .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("depth", "_s"))).alias("_d")))
    return (times.join(mat, keys, "left")
                 .select(*keys, F.concat(F.coalesce("_ot", F.array().cast("array<long>")),
                                         F.coalesce("_nt", F.array().cast("array<long>"))).alias("time"),
                         F.transform("_d", lambda x: x["depth"]).alias("depth"),
                         F.transform("_d", lambda x: x["_s"]).alias("data")))


def retain(df: DataFrame, ts: str, cutoff) -> DataFrame:
    """PB7: rows at or after the cutoff (month or day start); rewritten per partition."""
    return df.filter(F.col(ts) >= _c(cutoff))


def publish_with_backfill(df: DataFrame, keys: Sequence[str], ts: str, as_of, window: int) -> DataFrame:
    """PB8: per key, rows of the current window if it has data, else of the
    previous window; one plan keyed by window id (no driver loop)."""
    cur = window_start(as_of, window)
    prev = cur - int(window)
    tagged = (df.filter((F.col(ts) >= prev) & (F.col(ts) < cur + int(window)))
                .withColumn("window_id", F.when(F.col(ts) >= cur, F.lit(0)).otherwise(F.lit(1))))
    pick = tagged.groupBy(*keys).agg(F.min("window_id").alias("window_id"))
    return tagged.join(pick, [*keys, "window_id"], "left_semi").withColumn(
        "window_start", F.when(F.col("window_id") == 0, cur).otherwise(prev))


def product_documents(products: DataFrame, key: str = "asset_id") -> DataFrame:
    """PB6 document form of a product: ``{"data": [[...]], "time": [...], "depth": ["..."]}``
    with depth labels as strings, one JSON document per key."""
    doc = F.struct(F.col("data"), F.col("time"), F.transform("depth", lambda d: d.cast("string")).alias("depth"))
    return products.select(key, F.to_json(doc).alias("value"))


def write_products(products: DataFrame, path: str, key: str = "asset_id") -> None:
    """PB6: one gzip JSON document per asset (``partitionBy``), Spark writer compression
    instead of zip packing on the driver."""
    (product_documents(products, key).write.mode("overwrite").partitionBy(key)
        .option("compression", "gzip").text(path))
