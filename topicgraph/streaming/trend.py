"""K2: topic trend — payments and distinct users per time window.

The batch form counts users exactly; the streaming forms run the same windows
with a watermark (rows later than it are dropped).  A streaming aggregation has
no exact distinct count, so ``topic_trend_exact_stream`` chains two stateful
operators: the payments of each user in a window, and then, of the closed windows,
the users and their payments.  ``topic_trend_stream`` is one aggregation with
``approx_count_distinct``; it holds less state and runs in every output mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _win(window: str, slide: str | None):
    return F.window("time_sended", window, slide) if slide else F.window("time_sended", window)


def topic_trend(matched: DataFrame, window: str = "7 days", slide: str | None = None) -> DataFrame:
    """Batch: ``(window_start, window_end, payments, users)``.

    Each payment contributes its actor and target; ``payments`` counts the
    actor side only.  One aggregate (partial combine per window)."""
    sides = matched.select(_win(window, slide).alias("w"),
                           F.explode(F.array(F.struct(F.lit(1).alias("first"), F.col("actor_id").alias("u")),
                                             F.struct(F.lit(0).alias("first"), F.col("target_id").alias("u"))))
                           .alias("s"))
    return (sides.groupBy("w")
            .agg(F.sum("s.first").cast("long").alias("payments"),
                 F.count_distinct("s.u").alias("users"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "payments", "users"))


def topic_trend_stream(matched_stream: DataFrame, window: str = "7 days", slide: str | None = None,
                       watermark: str = "1 day") -> DataFrame:
    """Streaming: same windows with a watermark; users approximate.

    Watermarks need an instant (``TIMESTAMP``): the wall-clock NTZ event
    time is taken as UTC through its epoch microseconds (independent of the
    session time zone) and window bounds go back the same way, so they
    equal the batch windows on the NTZ column."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', time_sended)")
    ev = matched_stream.withColumn("event_time", F.timestamp_micros(micros))
    w = (F.window("event_time", window, slide) if slide else F.window("event_time", window))
    sides = (ev.withWatermark("event_time", watermark)
             .select(w.alias("w"), F.explode(F.array(
                 F.struct(F.lit(1).alias("first"), F.col("actor_id").alias("u")),
                 F.struct(F.lit(0).alias("first"), F.col("target_id").alias("u")))).alias("s")))
    return (sides.groupBy("w")
            .agg(F.sum("s.first").cast("long").alias("payments"),
                 F.approx_count_distinct("s.u").alias("users"))
            .select(_ntz(F.col("w.start")).alias("window_start"), _ntz(F.col("w.end")).alias("window_end"),
                    "payments", "users"))


def topic_trend_exact_stream(matched_stream: DataFrame, window: str = "7 days", slide: str | None = None,
                             watermark: str = "1 day") -> DataFrame:
    """Streaming, append mode: payments and exact users of every window that
    the watermark has closed.  The state holds a row for each user of an open
    window."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', time_sended)")
    ev = matched_stream.withColumn("event_time", F.timestamp_micros(micros)).withWatermark("event_time", watermark)
    sides = ev.select("event_time", F.explode(F.array(
        F.struct(F.lit(1).alias("first"), F.col("actor_id").alias("u")),
        F.struct(F.lit(0).alias("first"), F.col("target_id").alias("u")))).alias("s"))
    w = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    users = sides.groupBy(w.alias("w"), F.col("s.u").alias("u")).agg(F.sum("s.first").alias("payments"))
    return (users.groupBy("w").agg(F.sum("payments").cast("long").alias("payments"), F.count("u").alias("users"))
            .select(_ntz(F.col("w.start")).alias("window_start"), _ntz(F.col("w.end")).alias("window_end"),
                    "payments", "users"))


def _ntz(instant):
    """Instant -> NTZ wall clock in UTC, without the session time zone."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(F.unix_micros(instant) / 1_000_000).cast("decimal(18,6)"))
