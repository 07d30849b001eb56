"""Counts per pane, stored in segments that are merged by age and forgotten beyond a horizon.

A segment holds the counts of a run of batches, by day. Each micro-batch writes a segment of its
own; ``FAN`` neighbours of one tier become one segment of the next tier, so after ``n`` batches
there are about ``FAN * log(n)`` of them. A segment counts once its marker is written, and one
that spans others takes their place from then on, whether they are deleted yet or not: reads are
the same before, during and after a merge, and every step may be repeated.

Days that are closed take no more rows. Rows that come for them later are kept apart as late.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.functions.columns import day_label, seconds_in
from turnout.sinks.folders import delete_folder, is_whole, mark_whole, subfolders

#: Neighbouring segments of one tier that are merged.
FAN = 8
_NAME = re.compile(r"batches=(\d+)-(\d+)")
#: Where Spark puts rows without a day.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def day_of(label: str) -> date | None:
    """The day that a label names; None for rows without a time."""
    return None if label == _NO_DAY else date(*map(int, label.split(".")))


def label_of(day: date) -> str:
    return f"{day.year}.{day.month:02}.{day.day:02}"


@dataclass(frozen=True)
class Segment:
    path: str
    first: int
    last: int

    @property
    def tier(self) -> int:
        return int(log(self.last - self.first + 1, FAN) + 1e-9)


@dataclass(frozen=True)
class Segments:
    """The segments under a path; ``keys`` are the key columns with their types."""

    spark: SparkSession
    path: str
    keys: str

    @property
    def names(self) -> list[str]:
        return [key.split()[0] for key in self.keys.split(", ")]

    def write(self, panes: DataFrame, batch_id: int, closed_before: date | None = None) -> None:
        """Store a batch's counts (``pane_start``, keys, ``count``); repeating the batch replaces them.

        Counts of days before ``closed_before`` are stored as late.
        """
        self._store(panes.withColumn("late", _is_late(closed_before)), batch_id, batch_id)

    def _store(self, counts: DataFrame, first: int, last: int) -> None:
        at = f"{self.path}/batches={first}-{last}"
        (
            counts.withColumn("day", day_label(F.col("pane_start")))
            .hint("rebalance", "late", "day")
            .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("late", "day").parquet(at)
        )
        mark_whole(self.spark, at)

    def listed(self, up_to: int | None = None) -> list[Segment]:
        """Segments that count, in the order of their batches: of nested ones the widest."""
        found = []
        for name in subfolders(self.spark, self.path):
            if match := _NAME.fullmatch(name):
                found.append(Segment(f"{self.path}/{name}", int(match[1]), int(match[2])))
        chosen: list[Segment] = []
        for segment in sorted(found, key=lambda s: (s.first, -s.last)):
            inside = chosen and segment.last <= chosen[-1].last
            if not inside and (up_to is None or segment.last <= up_to) and is_whole(self.spark, segment.path):
                chosen.append(segment)
        return chosen

    def labels(self, segment: Segment, late: bool = False) -> list[str]:
        return [name.removeprefix("day=") for name in subfolders(self.spark, f"{segment.path}/late={str(late).lower()}")]

    def days(self, batch_id: int, late: bool = False) -> set[date]:
        """The days for which a batch, not merged yet, has counts."""
        own = Segment(f"{self.path}/batches={batch_id}-{batch_id}", batch_id, batch_id)
        return {day for label in self.labels(own, late) if (day := day_of(label))}

    def read(self, days: Iterable[date] | None = None, up_to: int | None = None, only: int | None = None,
             late: bool = False) -> DataFrame:
        """Stored counts; with ``days`` from those days' folders alone, and nothing else is listed.

        ``up_to`` leaves out later batches; ``only`` reads one batch that is not merged yet. Counts
        of a pane and key may be spread over several rows.
        """
        wanted = None if days is None else set(days)
        segments = self.listed(up_to) if only is None else [Segment(f"{self.path}/batches={only}-{only}", only, only)]
        paths = [
            f"{segment.path}/late={str(late).lower()}/day={label}"
            for segment in segments for label in self.labels(segment, late)
            if wanted is None or day_of(label) in wanted
        ]
        columns = f"pane_start timestamp, {self.keys}, count bigint"
        if not paths:
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(*paths)

    def closed_before(self, horizon: str | None, up_to: int) -> date | None:
        """The first day that is open, given the batches so far: ``horizon`` before the latest day.

        Days after today do not count, so that a wrong time in the future closes nothing.
        """
        if horizon is None:
            return None
        today = datetime.now(timezone.utc).date()
        seen = [day for segment in self.listed(up_to) for label in self.labels(segment) if (day := day_of(label)) and day <= today]
        back = timedelta(days=-(-seconds_in(horizon) // 86400))
        return max(seen) - back if seen and max(seen) - date.min > back else None

    def merge(self, up_to: int) -> None:
        """Merge neighbours tier by tier, among batches up to one that will not be repeated."""
        while run := _mergeable(self.listed(up_to)):
            self._merge(run)

    def _merge(self, run: list[Segment]) -> None:
        parts = []
        for late in (False, True):
            paths = [f"{s.path}/late={str(late).lower()}/day={label}" for s in run for label in self.labels(s, late)]
            if paths:
                columns = f"pane_start timestamp, {self.keys}, count bigint"
                parts.append(self.spark.read.schema(columns).parquet(*paths).withColumn("late", F.lit(late)))
        if not parts:
            parts = [self.read(days=()).withColumn("late", F.lit(False))]
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        merged = rows.groupBy("late", "pane_start", *self.names).agg(F.sum("count").alias("count"))
        self._store(merged, run[0].first, run[-1].last)
        for segment in run:
            delete_folder(self.spark, segment.path)

    def clean(self) -> None:
        """Delete what a merge that was cut short has left: segments that do not count."""
        kept = {segment.path for segment in self.listed()}
        last = max((segment.last for segment in self.listed()), default=-1)
        for name in subfolders(self.spark, self.path):
            match = _NAME.fullmatch(name)
            if match and f"{self.path}/{name}" not in kept and int(match[2]) <= last:
                delete_folder(self.spark, f"{self.path}/{name}")

    def forget(self, before: date) -> None:
        """Delete the counts of days before one that no open window reaches back to; late ones stay."""
        for segment in self.listed():
            for label in self.labels(segment):
                day = day_of(label)
                if day is not None and day < before:
                    delete_folder(self.spark, f"{segment.path}/late=false/day={label}")


def _is_late(closed_before: date | None) -> Column:
    if closed_before is None:
        return F.lit(False)
    edge = datetime(closed_before.year, closed_before.month, closed_before.day, tzinfo=timezone.utc)
    return F.coalesce(F.unix_micros("pane_start") < int(edge.timestamp()) * 1_000_000, F.lit(False))


def _mergeable(segments: list[Segment]) -> list[Segment] | None:
    """The oldest run of ``FAN`` neighbours of one tier, of the lowest tier that has one."""
    for tier in sorted({segment.tier for segment in segments}):
        run: list[Segment] = []
        for segment in segments:
            run = [*run, segment] if segment.tier == tier else []
            if len(run) == FAN:
                return run
    return None


def reach(days: Iterable[date], length: str) -> set[date]:
    """Days whose panes are in a window with a pane of one of ``days``."""
    span = -(-seconds_in(length) // 86400)
    out = set()
    for day in days:
        for off in range(-span, span + 1):
            ordinal = day.toordinal() + off
            if date.min.toordinal() <= ordinal <= date.max.toordinal():
                out.add(date.fromordinal(ordinal))
    return out


