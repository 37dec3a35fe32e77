"""Reports over a request log: thread_id, request_index, ts, status_code, response_ms, success, error.

Nothing here sorts or gathers the requests of one thread or service in one task: windows
run over pre-aggregated rows or over buckets of bounded width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.config import Options
from weftline.operators.ranges import number_rows

# Bins of one narrowing step of the exact percentile; that many rows of each percentile reach the driver.
_BINS = 1 << 15


def _rounded(value: Column) -> Column:
    """Two decimals, halves to even."""
    return F.bround(value, 2)


def load_summary(log: DataFrame, batch_size: int, wall_seconds: float, contacts: int | None = None) -> DataFrame:
    """Totals and rates of a run. With ``contacts`` every request was an account with that many contacts."""
    per_request = batch_size if contacts is None else 1 + contacts
    totals = log.agg(
        F.count("*").alias("total_requests"),
        F.count_if("success").alias("successful_requests"),
    )
    n, ok, wall = F.col("total_requests"), F.col("successful_requests"), F.lit(float(wall_seconds))
    rate = lambda count: _rounded(F.when(wall > 0, count / wall).otherwise(0.0))
    return totals.select(
        n,
        (n * per_request).alias("total_payloads"),
        ok,
        (n - ok).alias("failed_requests"),
        _rounded(F.coalesce(F.try_divide(ok, n) * 100, F.lit(0.0))).alias("success_rate"),
        rate(n).alias("requests_per_second"),
        rate(n * per_request).alias("payloads_per_second"),
    )


def latency_stats(log: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    return log.agg(
        F.coalesce(_rounded(F.avg("response_ms")), zero).alias("avg_ms"),
        F.coalesce(_rounded(F.min("response_ms")), zero).alias("min_ms"),
        F.coalesce(_rounded(F.max("response_ms")), zero).alias("max_ms"),
    )


def nearest_rank(values: DataFrame, column: str, percents: Sequence[float]) -> dict[float, float]:
    """Exact nearest-rank percentiles of a column of any size, all in the same scans.

    A scan counts the values of the ranges that hold wanted ranks in ``_BINS`` bins each and every
    wanted rank moves on to its bin, until that holds one value. The first bins are even on a
    logarithmic scale, so a few extreme values leave the others apart; the next are even. That
    makes three or four scans for data of ordinary precision. At most ``_BINS`` rows for each
    percentile reach the driver in a scan. What is not a number is left out like null; infinite
    values rank first and last.
    """
    v = F.col(column).cast("double")
    base = values.where(v.isNotNull() & ~F.isnan(v)).select(v.alias("v"))
    finite = F.abs("v") < float("inf")
    total, below, low, high, inside = base.agg(
        F.count("*"), F.count_if(F.col("v") == float("-inf")), F.min(F.when(finite, F.col("v"))), F.max(F.when(finite, F.col("v"))), F.count_if(finite)
    ).first()
    if not total:
        return {p: 0.0 for p in percents}
    found: dict[float, float] = {}
    wanted: dict[float, tuple[float, float, int]] = {}  # range and rank inside it
    for p in percents:
        rank = int(max(-(-p * total // 100), 1))
        if rank <= below:
            found[p] = float("-inf")
        elif rank > below + inside:
            found[p] = float("inf")
        else:
            wanted[p] = low, high, rank - below
    scale = _logarithmic
    while wanted:
        found |= {p: low for p, (low, high, _) in wanted.items() if low == high}
        wanted = {p: w for p, w in wanted.items() if w[0] < w[1]}
        ranges = sorted({w[:2] for w in wanted.values()})
        if not ranges:
            break
        place = F.lit(None).cast("double")
        for i, (low, high) in enumerate(ranges):
            place = F.when(F.col("v").between(low, high), F.lit(i * _BINS) + scale(F.col("v"), low, high)).otherwise(place)
        bins = (
            base.select("v", place.alias("bin")).where(F.col("bin").isNotNull())
            .groupBy("bin").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .collect()
        )
        bins.sort(key=lambda b: b["bin"])
        for p, (low, high, rank) in wanted.items():
            first = ranges.index((low, high)) * _BINS
            for b in bins:
                if first <= b["bin"] < first + _BINS:
                    if rank <= b["n"]:
                        wanted[p] = b["low"], b["high"], rank
                        break
                    rank -= b["n"]
        scale = _even
    return found


def _binned(share: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.floor(share * _BINS).cast("double"), F.lit(float(_BINS - 1))))


def _logarithmic(v: Column, low: float, high: float) -> Column:
    """Bin of ``v`` in [low, high], even in sign(v) log(1 + |v|)."""
    scaled = lambda x: F.signum(x) * F.log1p(F.abs(x))
    first, last = scaled(F.lit(low)), scaled(F.lit(high))
    return _binned(F.coalesce(F.try_divide(scaled(v) - first, last - first), F.lit(0.0)))


def _even(v: Column, low: float, high: float) -> Column:
    """Bin of ``v`` in [low, high], even. Halves, as the difference of two large values may be no number."""
    if high / 2 - low / 2 == 0:
        return F.when(v > low, F.lit(1.0)).otherwise(F.lit(0.0))
    return _binned((v / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2))


def latency_percentiles(log: DataFrame, percents: Sequence[int] = (50, 95, 99)) -> DataFrame:
    """p50, p95, p99 of the response times: the smallest value at least p % of all are not above."""
    found = nearest_rank(log, "response_ms", percents)
    return log.sparkSession.range(1).select(*[F.lit(float(found[p])).alias(f"p{p}_ms") for p in percents])


def status_breakdown(log: DataFrame) -> DataFrame:
    label = F.coalesce(F.col("status_code").cast("string"), F.lit("(no status)"))
    return log.groupBy(label.alias("status")).agg(F.count("*").alias("requests")).orderBy("status")


def request_numbers(log: DataFrame) -> DataFrame:
    """Add ``n``: 0-based place of a request within its thread, by request index.

    Rows are numbered inside ranges of (thread, index), and ranges are shifted by what came before
    them, so one very long thread is spread over many tasks, also if its indexes repeat. Requests
    of one index go by their time, then by a hash of all they say, so the order of the input
    never matters. Rows without an index come first, rows without a thread are a thread of their own.
    """
    tied = log.withColumn("_tie", F.xxhash64(*log.columns))
    order = [c for c in ("request_index", "ts") if c in log.columns] + ["_tie"]
    return number_rows(tied, ["thread_id"], order, "n").drop("_tie")


def throttle_windows(numbered: DataFrame, size: int = 30, percent: float = 60) -> DataFrame:
    """Full windows of ``size`` requests per thread with their share of 429 answers."""
    window = F.floor(F.col("n") / size)
    share = F.bround(100.0 * F.col("throttled") / F.col("requests"), 2)
    return (
        numbered.groupBy("thread_id", window.alias("window_no"))
        .agg(F.count("*").alias("requests"), F.count_if(F.col("status_code") == 429).alias("throttled"))
        .where(F.col("requests") == size)
        .select("thread_id", "window_no", "requests", "throttled", share.alias("throttled_percent"), (share >= percent).alias("flagged"))
    )


def sustained_throttling(windows: DataFrame, consecutive: int = 2) -> DataFrame:
    """First window per thread that ends a run of ``consecutive`` flagged windows.

    Every flagged window votes for itself and for the windows right after it; a window with
    all votes ends such a run. That is two aggregates and no ordering of a thread.
    """
    votes = windows.where("flagged").select(
        "thread_id",
        F.explode(F.sequence(F.col("window_no"), F.col("window_no") + (consecutive - 1))).alias("window_no"),
    )
    ends = votes.groupBy("thread_id", "window_no").agg(F.count("*").alias("votes")).where(F.col("votes") == consecutive)
    return ends.groupBy("thread_id").agg(F.min("window_no").alias("cut_window"))


def until_sustained(numbered: DataFrame, cuts: DataFrame, size: int = 30) -> DataFrame:
    """The log without the requests a thread would not have sent after it gave up."""
    return (
        numbered.join(cuts, "thread_id", "left")
        .where(F.col("cut_window").isNull() | (F.floor(F.col("n") / size) <= F.col("cut_window")))
        .drop("cut_window")
    )


def sample_errors(log: DataFrame, limit: int = 10) -> DataFrame:
    return (
        log.where(~F.col("success"))
        .orderBy("thread_id", "request_index")
        .limit(limit)
        .select("thread_id", "request_index", "error")
    )


def failure_ratio_windows(
    calls: DataFrame, options: Options = Options(), service: str = "service", counted: str = "counted_failure"
) -> DataFrame:
    """Seconds at which, over the trailing window, enough calls failed in too large a share.

    Calls are first counted per service and second. The trailing sums then run inside time
    slices: each second also goes to the next slice as history, so a slice holds at most two
    window lengths of rows, however busy the service is.
    """
    span = options.failure_window_seconds
    seconds = calls.groupBy(F.col(service).alias("service"), F.unix_seconds("ts").alias("second")).agg(
        F.count("*").alias("n"), F.count_if(counted).alias("f")
    )
    width = span + 1
    own = F.floor(F.col("second") / width)
    sliced = seconds.withColumn("slice", F.explode(F.array(own, own + 1))).withColumn("_own", own)
    trailing = Window.partitionBy("service", "slice").orderBy("second").rangeBetween(-span, 0)
    return (
        sliced.withColumn("calls", F.sum("n").over(trailing))
        .withColumn("failures", F.sum("f").over(trailing))
        .where(F.col("slice") == F.col("_own"))
        .select(
            "service",
            "second",
            "calls",
            "failures",
            (
                (F.col("calls") >= options.failure_min_calls)
                & (F.col("failures") >= options.failure_ratio * F.col("calls"))
            ).alias("flagged"),
        )
    )


def rate_breaches(calls: DataFrame, limit: int = 300) -> DataFrame:
    """Seconds with more calls than allowed."""
    return (
        calls.groupBy(F.date_trunc("second", "ts").alias("second"))
        .agg(F.count("*").alias("calls"))
        .where(F.col("calls") > limit)
    )
