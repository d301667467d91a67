"""Per-article state in a stream: which stages an article has gone through, and when it is late.

The state of a url is small and bounded: its first stage time, the stages seen and whether it was
reported. Every stage is reported once, however often its message comes. If stages are missing
when the watermark passes the first message's time plus ``patience``, a timer reports them once. State
goes when all stages were seen, or by a second timer ``forget`` after the first, so keys do not pile up.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from broadsheet.schemas import STAGES
from broadsheet.session import keyed_state
from broadsheet.streaming import jobs

EVENTS = "url string, event string, stages string, at timestamp"
STATE = "first_ms long, seen string, reported boolean"
Event = Row("url", "event", "stages", "at")
LAST = datetime.max.replace(tzinfo=timezone.utc)


class StageProgress(StatefulProcessor):
    """Emits ``stage`` when a stage is seen first, ``late`` once with what is missing, ``late stage``
    for a stage that comes after that."""

    def __init__(self, patience: timedelta, forget: timedelta):
        self.patience_ms = int(patience.total_seconds() * 1000)
        self.forget_ms = int(forget.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("progress", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # One time per stage is kept, whatever the number of copies.
        least: dict[str, datetime] = {}
        for _, stage, at in rows:
            if stage in STAGES and at is not None and at < least.get(stage, LAST):
                least[stage] = at
        if not least:
            return
        times = sorted(least.items(), key=lambda x: (x[1], STAGES.index(x[0])))
        stored = self.state.get()
        if stored:
            first, seen, reported = stored
            seen = seen.split(" ")
        else:
            first, seen, reported = int(times[0][1].timestamp() * 1000), [], False
        fresh = [(s, t) for s, t in times if s not in seen]
        seen = seen + [s for s, _ in fresh]
        # Each call to the store is a round trip: a key whose stages all come at once needs none.
        if not set(STAGES) <= set(seen):
            if not stored:
                self.handle.registerTimer(first + self.patience_ms)
                self.handle.registerTimer(first + self.forget_ms)
            if fresh:
                self.state.update((first, " ".join(seen), reported))
        elif stored:
            self.state.clear()
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        event = "late stage" if reported else "stage"
        for stage, at in fresh:
            yield Event(key[0], event, stage, at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        stored = self.state.get()
        if not stored:
            return
        first, seen, reported = stored
        due = expiredTimerInfo.getExpiryTimeInMs()
        if due >= first + self.forget_ms:
            self.state.clear()
        elif not reported:
            self.state.update((first, seen, True))
            missing = [s for s in STAGES if s not in seen.split(" ")]
            yield Event(key[0], "late", " ".join(missing), datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=due))

    def close(self) -> None:
        pass


def stage_progress(
    events: DataFrame, patience: timedelta, forget: timedelta, delay: str = "1 hour", ways: int = 0
) -> DataFrame:
    """Events (url, event, stages, at) from rows of (url, stage, at); ``at`` is the event time.

    Stages that are not known are passed over. Where a url may come in very many copies, ``ways``
    thins them before they are grouped by url: one per url, stage and way stays of the copies
    within the delay, and a stage's time is then that of one of the copies that stayed.
    """
    timed = events.select("url", "stage", F.col("at").cast("timestamp").alias("at")).withWatermark("at", delay)
    if ways:
        timed = timed.withColumn("_way", F.pmod(F.xxhash64("at"), F.lit(ways)))
        timed = timed.dropDuplicatesWithinWatermark(["url", "stage", "_way"]).drop("_way")
    return timed.groupBy("url").transformWithState(
        statefulProcessor=StageProgress(patience, forget),
        outputStructType=EVENTS,
        outputMode="Append",
        timeMode="EventTime",
    )


def progress_job(
    events: DataFrame,
    patience: timedelta,
    forget: timedelta,
    path: str,
    checkpoint: str,
    delay: str = "1 hour",
    ways: int = 0,
) -> None:
    """What ``stage_progress`` tells, into files; runs in any session, whatever its state store."""
    with keyed_state(events.sparkSession):
        jobs.to_files(stage_progress(events, patience, forget, delay, ways), path, checkpoint)
