"""Gap-based chat sessions.

A message opens a session when it is the first of the day between two parties or when more
than ``gap`` minute boundaries passed since the message before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.functions.columns import minute_boundaries

PAIR_DAY = ("sender", "receiver", "msg_date")


def mark_sessions(messages: DataFrame, gap: int = 60, dedup: bool = True) -> DataFrame:
    """Flag each message with ``is_new_session``.

    Messages carry second-grained times, so after the de-duplication (done map-side first)
    one pair has at most 86,400 rows a day, however busy it is; that bounds the window.
    ``dedup=False`` gives repeated messages back, of which only the first can open a session.
    """
    keys = [*PAIR_DAY, "msgtime"]
    distinct = messages.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    before = F.lag("msgtime").over(Window.partitionBy(*PAIR_DAY).orderBy("msgtime"))
    opens = before.isNull() | (minute_boundaries(before, F.col("msgtime")) > gap)
    marked = distinct.withColumn("is_new_session", F.when(opens, 1).otherwise(0))
    if dedup:
        return marked.drop("_copies")
    copy = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")
    return marked.select(*keys, "is_new_session", copy).select(
        *keys, F.when(F.col("_copy") == 1, F.col("is_new_session")).otherwise(0).alias("is_new_session")
    )


def daily_sessions(messages: DataFrame, gap: int = 60) -> DataFrame:
    """Number of sessions per sender, receiver and day.

    Only the minute of a message matters for the count: messages within a minute never open
    a second session. Rows shrink to sets of at most 1,440 minutes in the map tasks, so one
    exchange on all three keys moves a set per pair, day and task.
    """
    return sessions_of_minutes(session_minutes(messages), gap)


def session_minutes(messages: DataFrame) -> DataFrame:
    """Sender, receiver, day and minute of the day of each message."""
    return messages.select(*PAIR_DAY, (F.hour("msgtime") * 60 + F.minute("msgtime")).alias("minute"))


def sessions_of_minutes(minutes: DataFrame, gap: int = 60) -> DataFrame:
    """Sessions per sender, receiver and day from the minutes with messages."""
    sets = minutes.groupBy(*PAIR_DAY).agg(F.sort_array(F.collect_set("minute")).alias("_minutes"))
    later = F.filter("_minutes", lambda m, i: m - F.get("_minutes", i - 1) > gap)
    return sets.select(*PAIR_DAY, (F.size(later) + 1).cast("long").alias("sessions"))
