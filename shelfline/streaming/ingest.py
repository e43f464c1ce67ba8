"""Incremental ingest: newly landed feed files update only the weeks they touch.

One new day changes its whole week (last observed day, stock-out count), so the
unit of work is the week. Every call lists the landing folder, compares it with
the ledger of what was taken in, and takes in new extracts and new versions of
old ones, in batches: their rows are added to the facts, the index says which
rows count, and the weeks whose days changed are built anew. Facts carry no week:
the calendar is joined when a week is built, so a calendar that grows or changes
dates old facts too.

Everything a batch makes is written aside and published by one small file (see
:mod:`shelfline.streaming.generations`); a batch that fails leaves the state
before it, and is run again by the next call.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.dates import day_lit
from shelfline.operators.calendar import DAY_COLUMNS, check_calendar
from shelfline.operators.inventory import StockPolicy, check_policy, dated_inventory
from shelfline.operators.sales import dated_sales
from shelfline.plans.weekly import weekly_table
from shelfline.schemas import FEED_TYPES, WEEKLY_COLUMNS, WEEKLY_SCHEMA
from shelfline.sources import files
from shelfline.sources.local import small_frame
from shelfline.sources.sinks import WEEK_PARTITION
from shelfline.streaming import facts, generations, ledger
from shelfline.streaming.facts import DIGEST, ENTRY, FACT_FEEDS, FACT_SCHEMA, INDEX_COLUMNS, INDEX_SCHEMA, span_of
from shelfline.streaming.generations import State

# Generations of a span that are read side by side before they are merged.
MERGE_AFTER = 8
# Largest index to broadcast: a row has a feed, a file name, a date and a number.
MAX_BROADCAST_ENTRIES = 200_000


class WeeklyStore:
    """Facts and the weekly table built from them, below one root folder.

    With ``cumulative`` each extract holds its feed's whole history, as the daily
    extracts do: the one with the newest stamp, and of equal stamps the one changed
    last, stands for its feed alone. Only days on which it differs from the one
    before are stored and only their weeks rebuilt. Otherwise every extract adds
    rows, and a new version of an extract replaces the rows of the old one.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        calendar: DataFrame,
        policy: StockPolicy = "last_snapshot",
        cumulative: bool = False,
        merge_after: int = MERGE_AFTER,
    ):
        check_policy(policy)
        self.spark = spark
        self.root = root.rstrip("/")
        self.policy = policy
        self.cumulative = cumulative
        self.merge_after = merge_after
        self.calendar = check_calendar(calendar)

    def ingest(self, landing: str, max_files_per_batch: int | None = None) -> None:
        """Take in all extracts landed or changed since the last call.

        The landing folder holds ``sales_<date>.csv`` and ``inventory_<date>.csv``,
        each a file or a folder of part files; the date may have single digits.
        With ``cumulative`` an extract without a date has no place in the order:
        it is not read, and :meth:`rejected` lists it. If the calendar is not the
        one of the last call, the weeks that differ are built anew.
        """
        self._follow_calendar()
        landed = ledger.landed_extracts(self.spark, landing.rstrip("/"))
        # Names only, of what is new.
        waiting = ledger.not_taken(landed, self.ledger()).orderBy("stamp", "changed", "name").collect()
        size = max_files_per_batch or len(waiting)
        for first in range(0, len(waiting), size or 1):
            self._take_in(waiting[first : first + size], first // size)

    def weekly(self, as_of: date) -> DataFrame:
        """The weekly table up to and including the week of ``as_of``, of the newest state."""
        week = check_calendar(self.calendar.frame, as_of).current_week
        weeks = generations.newest(self.spark, self.root).weeks
        paths = [f"{self._built(g)}/{WEEK_PARTITION}={w}" for w, g in weeks.items() if w <= week]
        if not paths:
            return self.spark.createDataFrame([], WEEKLY_SCHEMA)
        table = self.spark.read.schema(WEEKLY_SCHEMA).option("basePath", f"{self.root}/weekly")
        return table.parquet(*paths).select(WEEKLY_COLUMNS)

    def ledger(self) -> DataFrame:
        """The newest version of every extract that was looked at, and what became of it.

        ``status`` is ``taken``, ``older`` (than the extract that stands for the feed)
        or ``undated``.
        """
        return self._part("ledger", generations.newest(self.spark, self.root).ledger, ledger.TAKEN_SCHEMA)

    def rejected(self) -> DataFrame:
        """Extracts whose names hold no date, where the date decides."""
        return self.ledger().where("status = 'undated'").select("name", "path", "changed", "bytes")

    # Batches

    def _take_in(self, landed: Sequence[Row], batch_id: int) -> None:
        before = generations.newest(self.spark, self.root)
        state = before.next(ledger=before.generation + 1)
        self._clear(state.generation)
        status = self._standing(landed)
        taken = [e for e in landed if status[e["name"]] == "taken"]
        if taken:
            state = self._store(before, state, taken)
        rows = [(*e[:-1], status[e["name"]], state.generation) for e in landed]
        entries = ledger.with_taken(self.ledger(), small_frame(self.spark, rows, ledger.TAKEN_SCHEMA))
        entries.coalesce(1).write.mode("overwrite").parquet(self._part_path("ledger", state.generation))
        self._publish(state)
        self._merge()

    def _standing(self, landed: Sequence[Row]) -> dict[str, str]:
        """What is to become of each of the extracts."""
        if not self.cumulative:
            return {e["name"]: "taken" for e in landed}
        order = lambda e: (e["stamp"], e["changed"], e["name"])
        known = self.ledger().where("status = 'taken'").groupBy("feed")
        last = known.agg(F.max(F.struct("stamp", "changed", "name")).alias("last")).collect()
        newest = {row["feed"]: tuple(row["last"]) for row in last}
        dated = [e for e in landed if e["stamp"] is not None]
        for feed in FACT_FEEDS:
            there = [newest[feed]] if feed in newest else []
            newest[feed] = max([order(e) for e in dated if e["feed"] == feed] + there, default=None)
        return {
            e["name"]: "undated" if e["stamp"] is None else "taken" if order(e) == newest[e["feed"]] else "older"
            for e in landed
        }

    def _store(self, before: State, state: State, taken: Sequence[Row]) -> State:
        """Add the extracts' rows, index them and build the weeks whose days changed."""
        rows = facts.read_extracts(self.spark, taken, named=not self.cumulative)
        index = self._index(before)
        key, of = ("feed", "feed") if self.cumulative else ("extract", "name")
        replaced = index.where(F.col(key).isin([e[of] for e in taken]))
        # Only where there are days to compare with, files are parsed twice: for digests, and for what differs.
        compared = self.cumulative and not replaced.isEmpty()
        if not compared:
            facts.write_generation(rows, self.root, state.generation)
            rows = facts.read_generation(self.spark, self.root, state.generation)
        if self.cumulative:
            fresh = self._kept_aside("digests", state, facts.digests(rows))
            changed = facts.changed_days(fresh, replaced)
            if compared:
                # At most a row for each feed and day.
                there = F.broadcast(changed.where("there").select("feed", "day"))
                stored = rows.join(there, ["feed", "day"], "left_semi")
                facts.write_generation(stored, self.root, state.generation)
            added = fresh.join(changed.where("there"), ENTRY, "left_semi")
            kept = index.join(changed, ENTRY, "left_anti")
        else:
            added = self._kept_aside("digests", state, facts.entries_of(rows))
            changed = added.select(ENTRY).unionAll(replaced.select(ENTRY))
            kept = index.join(replaced, ENTRY, "left_anti")
        added = added.select(*ENTRY, F.lit(state.generation).cast("bigint").alias("generation"), *DIGEST)
        state = replace(state, dropped=self.cumulative or any(e["again"] for e in taken))
        state = self._write_index(state, kept.select(added.columns).unionAll(added))
        days = self.calendar.days.frame
        touched = days.join(changed, changed["day"] == days["CAL_DT"], "left_semi").select(WEEK_PARTITION)
        own = days.join(touched.distinct(), WEEK_PARTITION, "left_semi")
        # At most one value per calendar week.
        found = own.agg(F.collect_set(WEEK_PARTITION), F.min("CAL_DT"), F.max("CAL_DT")).first()
        files.remove(self.spark, self._part_path("digests", state.generation))
        return self._build(state, *found)

    def _kept_aside(self, kind: str, state: State, rows: DataFrame) -> DataFrame:
        """The rows, computed once, into a folder that the batch removes."""
        path = self._part_path(kind, state.generation)
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _merge(self) -> None:
        """Write spans that lie in many generations into one, so that their files stay few."""
        before = generations.newest(self.spark, self.root)
        if before.generation % self.merge_after:
            return
        index = self._index(before).withColumn("span", span_of(F.col("day")))
        crowded = index.groupBy("feed", "span").agg(F.count_distinct("generation").alias("n"))
        found = crowded.where(F.col("n") >= self.merge_after).select("feed", "span").collect()
        if not found:
            return
        state = before.next(dropped=True)
        self._clear(state.generation)
        # A row per span and feed.
        places = F.broadcast(small_frame(self.spark, found, "feed string, span int"))
        low, high = min(r["span"] for r in found), max(r["span"] for r in found)
        merged = self._live(before, F.col("span").between(low, high)).join(places, ["feed", "span"], "left_semi")
        facts.write_generation(merged.select(FACT_SCHEMA.fieldNames()), self.root, state.generation)
        moved = index.join(places.withColumn("to", F.lit(state.generation).cast("bigint")), ["feed", "span"], "left")
        entries = moved.withColumn("generation", F.coalesce("to", "generation")).drop("span", "to")
        self._publish(self._write_index(state, entries))

    # Parts of a state

    def _index(self, state: State) -> DataFrame:
        return self._part("index", state.index, INDEX_SCHEMA)

    def _write_index(self, state: State, entries: DataFrame) -> State:
        written = Observation()
        counted = entries.select(INDEX_COLUMNS).observe(written, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(self._part_path("index", state.generation))
        return replace(state, index=state.generation, entries=written.get["rows"])

    def _live(self, state: State, within) -> DataFrame:
        """The facts that count, of the days or spans that ``within`` holds for."""
        all_rows = self.spark.read.schema(FACT_SCHEMA).parquet(f"{self.root}/facts").where(within)
        entries = self._index(state).withColumn("span", span_of(F.col("day"))).where(within)
        entries = entries.select(*ENTRY, "generation", "span")
        if state.entries <= MAX_BROADCAST_ENTRIES:
            entries = F.broadcast(entries)
        return all_rows.join(entries, [*ENTRY, "generation", "span"], "left_semi")

    def _build(self, state: State, weeks: Sequence[int], first: date | None, last: date | None) -> State:
        """Build the weeks of these days from the state's facts; those without rows go."""
        kept = {w: g for w, g in state.weeks.items() if w not in weeks}
        if state.entries == 0 or not weeks:
            return replace(state, weeks=kept)
        own = self.calendar.days.frame.where(F.col(WEEK_PARTITION).isin(list(weeks)))
        days = replace(self.calendar.days, frame=own, first=first, last=last)
        low, high = day_lit(first), day_lit(last)
        within = F.col("day").between(low, high) & F.col("span").between(span_of(low), span_of(high))
        live = self._live(state, within)
        parts = {f: live.where(F.col("feed") == f).select(list(FEED_TYPES[f])) for f in FACT_FEEDS}
        table = weekly_table(
            dated_sales(parts["sales"], days), dated_inventory(parts["inventory"], days), self.policy
        )
        writer = table.hint("rebalance", WEEK_PARTITION).write.mode("overwrite")
        writer.partitionBy(WEEK_PARTITION).parquet(self._built(state.generation))
        made = [n.split("=")[1] for n in files.children(self.spark, self._built(state.generation))]
        new = {int(week): state.generation for week in made if week.lstrip("-").isdigit()}
        return replace(state, weeks={**kept, **new})

    def _follow_calendar(self) -> None:
        """Builds the weeks anew whose days in the calendar have changed."""
        days = self.calendar.frame.select(DAY_COLUMNS)
        row = F.xxhash64(*DAY_COLUMNS).bitwiseAND(F.lit((1 << 40) - 1))
        # A row per calendar week.
        found = (
            days.groupBy(WEEK_PARTITION)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("sum"), F.min("CAL_DT").alias("first"), F.max("CAL_DT").alias("last"))
            .collect()
        )
        before = generations.newest(self.spark, self.root)
        digest = f"{sum(w['n'] for w in found)}-{sum(w['sum'] for w in found)}"
        if before.calendar == digest:
            return
        digests = {w[WEEK_PARTITION]: f"{w['n']}-{w['sum']}" for w in found if w[WEEK_PARTITION] is not None}
        same = {w for w, of_days in digests.items() if before.days.get(w) == of_days}
        changed = [w for w in found if w[WEEK_PARTITION] in digests.keys() - same]
        state = before.next(calendar=digest, days=digests)
        self._clear(state.generation)
        # Weeks that are not in the calendar any more go too.
        state = replace(state, weeks={w: g for w, g in before.weeks.items() if w in same})
        first, last = min((w["first"] for w in changed), default=None), max((w["last"] for w in changed), default=None)
        self._publish(self._build(state, [w[WEEK_PARTITION] for w in changed], first, last))

    def _publish(self, state: State) -> None:
        """Make the state the newest, and remove what no kept state names."""
        gone = generations.publish(self.spark, self.root, state)
        kept = generations.published(self.spark, self.root)[-2:]
        for old in gone:
            if old.index is not None and kept[0].dropped:
                self._remove_facts(old, kept)
            for kind in ("index", "ledger"):
                if getattr(old, kind) not in {getattr(k, kind) for k in kept} | {None}:
                    files.remove(self.spark, self._part_path(kind, getattr(old, kind)))
            weeks = {(w, g) for k in kept for w, g in k.weeks.items()}
            for week, generation in set(old.weeks.items()) - weeks:
                files.remove(self.spark, f"{self._built(generation)}/{WEEK_PARTITION}={week}")
            generations.forget(self.spark, self.root, old)

    def _remove_facts(self, old: State, kept: Sequence[State]) -> None:
        """Remove the spans of facts that the old state names and no kept one."""
        places = ["generation", "feed", "span"]
        named = [
            self._index(state).select("generation", "feed", span_of(F.col("day")).alias("span")).distinct()
            for state in (old, *kept)
        ]
        live = reduce(DataFrame.unionAll, named[1:])
        dead = named[0].join(live, places, "left_anti").collect()  # a row per folder
        root = f"{self.root}/facts"
        for generation, feed, span in dead:
            files.remove(self.spark, f"{root}/generation={generation}/feed={feed}/span={span}")
        for generation in {row["generation"] for row in dead}:
            folder = f"{root}/generation={generation}"
            if not any(files.children(self.spark, f"{folder}/{f}") for f in files.children(self.spark, folder)):
                files.remove(self.spark, folder)

    def _clear(self, generation: int) -> None:
        """Remove what a failed run left under the number."""
        files.remove(self.spark, facts.generation_path(self.root, generation))
        files.remove(self.spark, self._built(generation))
        files.remove(self.spark, self._part_path("digests", generation))

    def _part(self, kind: str, generation: int | None, schema: str) -> DataFrame:
        if generation is None:
            return small_frame(self.spark, [], schema)
        return self.spark.read.schema(schema).parquet(self._part_path(kind, generation))

    def _part_path(self, kind: str, generation: int) -> str:
        return f"{self.root}/{kind}/{generation}"

    def _built(self, generation: int) -> str:
        return f"{self.root}/weekly/generation={generation}"
