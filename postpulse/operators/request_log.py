"""Rate audits and endpoint health over a request log.

A log has the columns ``request_id`` (unique), ``client``, ``ts``, ``ok`` and
``response_time``. One client may own a large part of it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postpulse.config import RequestConfig
from postpulse.functions.lexicon import RATE_LIMIT_PHRASES
from postpulse.functions.timebuckets import micros
from postpulse.operators.frames import BROADCAST_ROWS
from postpulse.session import cut_lineage

SECOND = 1_000_000
MINUTE = 60_000_000
HOUR = 3_600_000_000
#: Calls of a client in an hour beyond which its log is cut finer than by hours.
CROWD = 200_000


def _hour(at: Column) -> Column:
    return F.floor(at / HOUR).cast("bigint")


def rate_audit(log: DataFrame, cfg: RequestConfig = RequestConfig(), crowd: int = CROWD) -> DataFrame:
    """Calls in the minute and hour before each call, whether a limit is reached, and for
    how long the call should have waited.

    A client's log is cut into hours, or, for a client with more than ``crowd`` calls in some hour, into minutes or seconds,
    so that the calls of one hour spread over many tasks. Clients are told apart by one count of the log first.
    """
    call = log.select("request_id", "client", micros(F.col("ts")).alias("at"))
    busy = busy_clients(call, crowd)
    if busy.isEmpty():
        return _verdicts(_by_hour(call), cfg)
    # At most ``BROADCAST_ROWS`` clients.
    few = F.broadcast(busy)
    calm = call.join(few, "client", "left_anti")
    return _verdicts(_by_hour(calm).unionByName(_by_slice(call.join(few, "client"))), cfg)


def _verdicts(counted: DataFrame, cfg: RequestConfig) -> DataFrame:
    over_minute = F.col("calls_minute") >= cfg.per_minute
    over_hour = F.col("calls_hour") >= cfg.per_hour

    def wait(span: int, over: Column, oldest: str) -> Column:
        return F.when(over, F.lit(span) - (F.col("at") - F.col(oldest))).otherwise(F.lit(0))

    waits = F.greatest(wait(MINUTE, over_minute, "oldest_minute"), wait(HOUR, over_hour, "oldest_hour"))
    return counted.select(
        "request_id", "client", "calls_minute", "calls_hour",
        (over_minute | over_hour).alias("limited"),
        (waits / F.lit(1e6)).alias("wait_seconds"),
    )


def _by_hour(call: DataFrame) -> DataFrame:
    """Counts and the oldest call of both ranges. Each hour also gets the calls of the hour before it, which is all the history its calls can
    look back on. All frames only ever grow, which costs one pass however many calls a range
    holds: a count inside a range is the difference of two counts from the start, and the
    oldest call inside it is a minimum that grows from the newest call backwards.
    """
    hour = _hour(F.col("at"))
    places = F.array(
        F.struct(hour.alias("hour"), F.lit(True).alias("own")),
        F.struct((hour + 1).alias("hour"), F.lit(False).alias("own")),
    )
    spread = call.withColumn("place", F.explode(places)).select(
        "request_id", "client", "at", (-F.col("at")).alias("age"), "place.hour", "place.own"
    )
    forward = Window.partitionBy("client", "hour").orderBy("at")
    backward = Window.partitionBy("client", "hour").orderBy("age")

    def calls_within(span: int) -> Column:
        before = F.count("*").over(forward.rangeBetween(Window.unboundedPreceding, -1))
        return before - F.count("*").over(forward.rangeBetween(Window.unboundedPreceding, -(span + 1)))

    def oldest(span: int) -> Column:
        return F.min("at").over(backward.rangeBetween(Window.unboundedPreceding, span))

    return spread.select(
        "request_id", "client", "at", "own",
        calls_within(MINUTE).alias("calls_minute"), calls_within(HOUR).alias("calls_hour"),
        oldest(MINUTE).alias("oldest_minute"), oldest(HOUR).alias("oldest_hour"),
    ).where("own").drop("own")


def busy_clients(call: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Clients with more than ``crowd`` calls in an hour, and the width of their slices: a second, if a minute holds as many, else a
    minute. Where so many clients are busy that they could not be broadcast, ``crowd`` grows with the log."""
    hours = cut_lineage(call.groupBy("client", _hour(F.col("at")).alias("hour")).agg(F.count("*").alias("n")).where(F.col("n") > crowd))
    if hours.isEmpty():
        return hours.select("client", F.lit(MINUTE).cast("bigint").alias("width"))
    # A client with more than ``limit`` calls takes that share of all these hours.
    limit = F.greatest(F.lit(crowd), hours.agg(F.floor(F.sum("n") / BROADCAST_ROWS)).scalar())
    busy = hours.where(F.col("n") > limit).select("client").distinct()
    minutes = call.join(F.broadcast(busy), "client").groupBy("client", F.floor(F.col("at") / MINUTE).alias("minute")).agg(F.count("*").alias("n"))
    return cut_lineage(minutes.groupBy("client").agg(F.when(F.max("n") > crowd, SECOND).otherwise(MINUTE).cast("bigint").alias("width")))


def _by_slice(call: DataFrame) -> DataFrame:
    """As ``_by_hour``, for calls with the ``width`` of their client's slices.

    A call enters its own slice, and leaves the two ranges in the slices a minute and an hour later, to which it is sent as well. A slice thus
    knows the calls at both edges of its ranges; those of the slices in between come as one row of carried counts and first times.
    """
    slot = F.floor(F.col("at") / F.col("width")).cast("bigint")
    sliced = call.withColumn("slot", slot)
    events = sliced.select(
        "request_id", "client",
        F.explode(
            F.array(
                *[
                    F.struct(
                        (F.col("slot") + F.floor(F.lit(span) / F.col("width")).cast("bigint")).alias("slot"),
                        (F.col("at") + span).alias("key"), F.lit(span).cast("bigint").alias("span"),
                    )
                    for span in (0, MINUTE, HOUR)
                ]
            )
        ).alias("e"),
    ).select("request_id", "client", "e.*")
    counts = cut_lineage(sliced.groupBy("client", "width", "slot").agg(F.count("*").alias("n"), F.min("at").alias("first")))
    carried = [_between(counts.where(F.col("width") == width), width) for width in (MINUTE, SECOND)]
    whole = events.unionByName(carried[0].unionByName(carried[1]), allowMissingColumns=True)
    forward = Window.partitionBy("client", "slot").orderBy("key")
    backward = Window.partitionBy("client", "slot").orderBy(-F.col("key"))
    upto = forward.rangeBetween(Window.unboundedPreceding, 0)
    later = backward.rangeBetween(Window.unboundedPreceding, 0)
    own = F.count_if(F.col("span") == 0).over(forward.rangeBetween(Window.unboundedPreceding, -1))
    first_own = F.min(F.when(F.col("span") == 0, F.col("key"))).over(upto)

    def calls(span: int, name: str) -> Column:
        """Own calls before, those at the far edge that are still inside, and those in between."""
        edge = F.count_if(F.col("span") == span).over(later)
        return (own + edge + F.coalesce(F.max(f"{name}_n").over(upto), F.lit(0))).alias(f"calls_{name}")

    def oldest(span: int, name: str) -> Column:
        edge = F.min(F.when(F.col("span") == span, F.col("key"))).over(later) - span
        return F.coalesce(edge, F.max(f"{name}_first").over(upto), first_own).alias(f"oldest_{name}")

    return whole.select(
        "request_id", "client", F.col("key").alias("at"), "span",
        calls(MINUTE, "minute"), calls(HOUR, "hour"), oldest(MINUTE, "minute"), oldest(HOUR, "hour"),
    ).where("span = 0").drop("span")


def _between(counts: DataFrame, width: int) -> DataFrame:
    """For each slice: calls, and the first of them, in the slices between it and the one a minute or an hour before."""
    forward = Window.partitionBy("client").orderBy("slot")
    backward = Window.partitionBy("client").orderBy(-F.col("slot"))
    made = [F.lit(None).cast("bigint").alias("span"), (F.col("slot") * width - 1).alias("key")]
    for name, span in (("minute", MINUTE), ("hour", HOUR)):
        far = span // width
        upto = lambda last: F.coalesce(F.sum("n").over(forward.rangeBetween(Window.unboundedPreceding, last)), F.lit(0))
        n = upto(-1) - upto(-far)
        first = F.min("first").over(backward.rangeBetween(Window.unboundedPreceding, far - 1))
        made += [n.alias(f"{name}_n"), F.when(n > 0, first).alias(f"{name}_first")]
    return counts.select("client", "slot", *made)


def endpoint_health(log: DataFrame) -> DataFrame:
    """Counts, response times, last events and trailing failures of each endpoint.

    Everything is first summed per endpoint and hour, so that a busy endpoint is no more
    than its hours. Failures after the last success are those of later hours, which are
    summed already, and those later in the same hour, for which the log is read once more.
    """
    event = log.select(
        F.col("client").alias("endpoint"), "ts", "ok", "response_time", _hour(micros(F.col("ts"))).alias("hour"),
        F.struct("ts", "request_id").alias("place"),
    )
    hours = cut_lineage(
        event.groupBy("endpoint", "hour").agg(
            F.count_if("ok").alias("success_count"),
            F.count_if(~F.col("ok")).alias("failure_count"),
            F.coalesce(F.sum(F.when(F.col("ok"), F.col("response_time"))), F.lit(0.0)).alias("total_response_time"),
            F.max("ts").alias("last_used"),
            F.max(F.when(F.col("ok"), F.col("ts"))).alias("last_success"),
            F.max(F.when(~F.col("ok"), F.col("ts"))).alias("last_failure"),
            F.max(F.when(F.col("ok"), F.col("place"))).alias("last_ok"),
        )
    )
    sums = ("success_count", "failure_count", "total_response_time")
    totals = hours.groupBy("endpoint").agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.max(c).alias(c) for c in ("last_used", "last_success", "last_failure", "last_ok")],
    )
    last = totals.select("endpoint", F.col("last_ok").alias("mark"), _hour(micros(F.col("last_ok.ts"))).alias("mark_hour"))
    later_hours = (
        hours.join(last, "endpoint")
        .where(F.col("mark").isNull() | (F.col("hour") > F.col("mark_hour")))
        .select("endpoint", F.col("failure_count").alias("n"))
    )
    same_hour = (
        event.where(~F.col("ok"))
        .join(last.withColumnRenamed("mark_hour", "hour"), ["endpoint", "hour"])
        .where(F.col("place") > F.col("mark"))
        .select("endpoint", F.lit(1).cast("bigint").alias("n"))
    )
    trailing = later_hours.unionByName(same_hour).groupBy("endpoint").agg(F.sum("n").alias("consecutive_failures"))
    attempts = F.col("success_count") + F.col("failure_count")
    return (
        totals.drop("last_ok")
        .join(trailing, "endpoint", "left")
        .withColumns(
            {
                "consecutive_failures": F.coalesce("consecutive_failures", F.lit(0)),
                "mean_response_time": F.try_divide(F.col("total_response_time"), F.col("success_count")),
                "success_rate": F.try_divide(F.col("success_count").cast("double"), attempts),
            }
        )
    )


def endpoint_active(health: DataFrame, cfg: RequestConfig = RequestConfig()) -> DataFrame:
    """Add ``is_active``: the last success decides by the rate up to it, and enough failures
    after it switch the endpoint off."""
    until_success = F.col("success_count") + F.col("failure_count") - F.col("consecutive_failures")
    rate = F.try_divide(F.col("success_count").cast("double"), until_success)
    fine = F.when(F.col("success_count") == 0, F.lit(True)).otherwise(rate >= cfg.min_success_rate)
    return health.withColumn("is_active", fine & (F.col("consecutive_failures") < cfg.max_failures))


def endpoint_score(health: DataFrame) -> DataFrame:
    penalised = F.col("success_rate") - F.col("consecutive_failures") * 0.1
    return health.withColumn("score", F.coalesce(penalised, F.lit(0.5)))


def endpoint_rank(health: DataFrame, k: int | None = None) -> DataFrame:
    """Endpoints by score, best first; equal scores by name. The first is the one to use."""
    ranked = endpoint_score(health).orderBy(F.desc("score"), "endpoint")
    return ranked if k is None else ranked.limit(k)


def endpoint_least_recent(health: DataFrame) -> DataFrame:
    """The endpoint unused for longest; one that was never used comes first."""
    return health.select("endpoint", "last_used").orderBy(F.asc_nulls_first("last_used"), "endpoint").limit(1)


def endpoint_summary(active: DataFrame) -> DataFrame:
    """One row of totals over all endpoints."""
    totals = active.agg(
        F.count("*").alias("total_endpoints"),
        F.count_if("is_active").alias("active_endpoints"),
        F.coalesce(F.sum("success_count"), F.lit(0)).alias("total_successful_requests"),
        F.coalesce(F.sum("failure_count"), F.lit(0)).alias("total_failed_requests"),
        F.coalesce(F.sum("total_response_time"), F.lit(0.0)).alias("_response_time"),
    )
    ok, bad = F.col("total_successful_requests"), F.col("total_failed_requests")

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))

    return totals.select(
        "total_endpoints", "active_endpoints",
        (ratio(F.col("active_endpoints"), F.col("total_endpoints")) * 100).alias("active_percentage"),
        ratio(ok, ok + bad).alias("avg_success_rate"),
        ratio(F.col("_response_time"), ok).alias("avg_response_time"),
        "total_successful_requests", "total_failed_requests",
    )


def is_rate_limit_error(message: Column) -> Column:
    lowered = F.lower(message)
    return reduce(or_, [F.contains(lowered, F.lit(p)) for p in RATE_LIMIT_PHRASES])


def rate_summary(audit: DataFrame) -> DataFrame:
    """Total calls, limited calls, total and mean waiting time."""
    return audit.agg(
        F.count("*").alias("total_calls"),
        F.count_if("limited").alias("limited_calls"),
        F.coalesce(F.sum("wait_seconds"), F.lit(0.0)).alias("total_wait_seconds"),
        F.coalesce(F.try_divide(F.sum("wait_seconds"), F.count("*")), F.lit(0.0)).alias("avg_wait_per_call"),
    )
