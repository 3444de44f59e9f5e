"""Failure-streak state per source.

The state after a call depends on all calls before it, so a plain fold would put a source's whole
history into one task. Here a history is cut into time chunks that run in parallel:

1. Each chunk is read once, in time order, for every state it may be entered in at the same time.
   Entries whose states meet are carried on as one. The chunk's table of entry to exit is small:
   entries that exit alike are one row.
2. Per source, the chunk tables are chained, which gives the state each chunk is really entered in.
3. Each chunk is read again from that state, and its counts are summed per source.

Before Python sees them, runs of successes shrink to their last call in column expressions, which
leaves every outcome as it is: a call allowed anywhere in the run ends it closed.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Consecutive failures that open, seconds until a trial call.
MAX_FAILURES = 2
COOLDOWN = 300.0

# Chunk number of the state a history starts from.
_BEFORE = -(1 << 62)

_STREAM = ["source", "chunk", "start", "at", "ok", "entry_open", "entry_count", "entry_at"]
_TABLE_DDL = (
    "source string, chunk bigint, entry_count int, until bigint, exit_open boolean, exit_count int, exit_at bigint"
)
_ENTRY_DDL = "source string, chunk bigint, entry_open boolean, entry_count int, entry_at bigint"
_COUNT_DDL = (
    "source string, chunk bigint, trips bigint, reset boolean, failures bigint, exit_open boolean, "
    "exit_at bigint, last_failure bigint"
)


class _Paths:
    """All entries of one chunk at once; groups of entries with the same state are one list."""

    def __init__(self, start: int, max_failures: int, cooldown: int):
        self.max_failures, self.cooldown = max_failures, cooldown
        self.closed = {n: [("closed", n)] for n in range(max_failures)}
        self.open: deque[tuple[int, list]] = deque()
        self.last_spawn, self.horizon, self.spawning = None, start + cooldown, True

    @staticmethod
    def _join(groups: list[list]) -> list:
        groups = [g for g in groups if g]
        if not groups:
            return []
        big = max(groups, key=len)
        for g in groups:
            if g is not big:
                big.extend(g)
        return big

    def step(self, at: int, ok: bool) -> None:
        tried = []
        while self.open and self.open[0][0] + self.cooldown <= at:
            tried.append(self.open.popleft()[1])
        if self.spawning and at != self.last_spawn:
            # Entered open, with the cooldown ending after the call before this one.
            tried.append([("open", at)])
            self.last_spawn = at
            self.spawning = at < self.horizon
        if ok:
            merged = self._join([*self.closed.values(), *tried])
            self.closed = {0: merged} if merged else {}
            return
        opening, shifted = tried, {}
        for n, group in self.closed.items():
            if n + 1 >= self.max_failures:
                opening.append(group)
            else:
                shifted[n + 1] = group
        self.closed = shifted
        merged = self._join(opening)
        if merged:
            self.open.append((at, merged))

    def rows(self, source: str, chunk: int) -> list[tuple]:
        exits = [(label, (False, n, 0)) for n, group in self.closed.items() for label in group]
        exits += [(label, (True, 0, at)) for at, group in self.open for label in group]
        closed = [(source, chunk, n, None, *result) for (kind, n), result in exits if kind == "closed"]
        opened = sorted(((at, result) for (kind, at), result in exits if kind == "open"), key=lambda e: e[0])
        kept = [
            (source, chunk, None, at, *result)
            for i, (at, result) in enumerate(opened)
            if i + 1 == len(opened) or opened[i + 1][1] != result
        ]
        return closed + kept


class _Run:
    """One known entry state."""

    def __init__(self, opened: bool, count: int, at: int, max_failures: int, cooldown: int):
        self.opened, self.count, self.at = opened, count, at
        self.max_failures, self.cooldown = max_failures, cooldown
        self.trips, self.reset, self.failures, self.last_failure = 0, False, 0, None

    def step(self, at: int, ok: bool) -> None:
        if self.opened and at < self.at + self.cooldown:
            return
        if ok:
            self.opened, self.count, self.failures, self.reset = False, 0, 0, True
            return
        self.failures += 1
        self.last_failure = at
        if self.opened or self.count + 1 >= self.max_failures:
            self.opened, self.at, self.count = True, at, 0
            self.trips += 1
        else:
            self.count += 1

    def row(self, source: str, chunk: int) -> tuple:
        return (source, chunk, self.trips, self.reset, self.failures, self.opened, self.at, self.last_failure)


def _stream_groups(batches: Iterator[pd.DataFrame], open_group: Callable, columns: list[str]) -> Iterator[pd.DataFrame]:
    """Feed sorted rows to one state object per (source, chunk), holding only the current one."""
    key, state, done = None, None, []
    for batch in batches:
        for source, chunk, start, at, ok, *entry in batch[_STREAM].itertuples(index=False, name=None):
            if (source, chunk) != key:
                if state is not None:
                    done += state(None, None)
                key, state = (source, chunk), open_group(source, chunk, start, *entry)
            if ok is not None:
                state(at, ok)
        if len(done) > 10_000:
            yield pd.DataFrame(done, columns=columns)
            done = []
    if state is not None:
        done += state(None, None)
    if done:
        yield pd.DataFrame(done, columns=columns)


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


def breaker_states(
    calls: DataFrame,
    as_of: Column,
    *,
    source: str = "source",
    at: str = "ts",
    ok: str = "ok",
    order: list[str] | None = None,
    max_failures: int = MAX_FAILURES,
    cooldown: float = COOLDOWN,
    chunk_seconds: float | None = None,
    initial: DataFrame | None = None,
) -> DataFrame:
    """(source, state, failure_count, trips, last_failure_at) of every source at ``as_of``.

    ``calls`` is (source, at, ok); calls rejected while open leave the state alone. ``order``
    breaks ties in time. ``initial`` is an earlier result to go on from. Any chunk length is
    right; by default it is an hour or twelve cooldowns, so that entries are few, and a source
    with very many calls per hour wants shorter ones.
    """
    pause = int(cooldown * 1_000_000)
    width = max(int((chunk_seconds or max(3600, 12 * cooldown)) * 1_000_000), 1)
    stamp = F.unix_micros(F.col(at).cast("timestamp"))
    ties = [F.col(c).alias(f"tie_{i}") for i, c in enumerate(order or [])]
    tie_names = [f"tie_{i}" for i in range(len(ties))]
    rows = calls.select(
        F.col(source).cast("string").alias("source"), stamp.alias("at"), F.col(ok).alias("ok"), *ties
    ).withColumn("chunk", F.floor(F.col("at") / F.lit(width)).cast("bigint"))
    in_time = Window.partitionBy("source", "chunk").orderBy("at", *tie_names)
    thinned = rows.withColumn("next_ok", F.lead("ok").over(in_time)).where(
        ~F.col("ok") | ~F.coalesce("next_ok", F.lit(False))
    )
    none = {"entry_open": "boolean", "entry_count": "int", "entry_at": "bigint"}
    stream = thinned.select(
        "source", "chunk", (F.col("chunk") * width).alias("start"), "at", "ok",
        *[F.lit(None).cast(t).alias(n) for n, t in none.items()],
        F.lit(1).alias("rank"), *tie_names,
    )
    sort_keys = ["source", "chunk", "rank", "at", *tie_names]
    sorted_calls = stream.sortWithinPartitions(*sort_keys)

    def open_paths(src, chunk, start, *_):
        paths = _Paths(start, max_failures, pause)
        return lambda t, good: paths.rows(src, chunk) if t is None else paths.step(t, good)

    tables = sorted_calls.mapInPandas(
        lambda batches: _stream_groups(batches, open_paths, _names(_TABLE_DDL)), _TABLE_DDL
    )

    if initial is not None:
        opened, last = F.col("state") != "closed", F.unix_micros(F.col("last_failure_at").cast("timestamp"))
        tables = tables.unionByName(
            initial.select(
                "source",
                F.lit(_BEFORE).alias("chunk"),
                F.lit(None).cast("int").alias("entry_count"),
                F.lit(None).cast("bigint").alias("until"),
                opened.alias("exit_open"),
                F.when(opened, 0).otherwise(F.col("failure_count")).cast("int").alias("exit_count"),
                F.coalesce(last, F.lit(0)).alias("exit_at"),
            )
        )

    def chain(table: pd.DataFrame) -> pd.DataFrame:
        state, entries = (False, 0, 0), []
        ordered = table.sort_values(["chunk", "until"]).itertuples(index=False, name=None)
        for chunk, lines in groupby(ordered, key=lambda line: line[1]):
            lines = list(lines)
            if chunk == _BEFORE:
                state = (bool(lines[0][4]), int(lines[0][5]), int(lines[0][6]))
                continue
            entries.append((lines[0][0], chunk, *state))
            opened, count, since = state
            if opened:
                # NaN compares false, so lines of closed entries drop out.
                exit_ = next((line[4:] for line in lines if line[3] >= since + pause), None)
            else:
                exit_ = next(line[4:] for line in lines if line[2] == count)
            if exit_ is not None:
                state = (bool(exit_[0]), int(exit_[1]), int(exit_[2]))
        return pd.DataFrame(entries, columns=_names(_ENTRY_DDL))

    entries = tables.groupBy("source").applyInPandas(chain, _ENTRY_DDL)
    heads = entries.select(
        "source", "chunk", F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("at"),
        F.lit(None).cast("boolean").alias("ok"), "entry_open", "entry_count", "entry_at", F.lit(0).alias("rank"),
        *[F.lit(None).cast(stream.schema[n].dataType).alias(n) for n in tie_names],
    )
    with_heads = stream.unionByName(heads).repartition("source", "chunk").sortWithinPartitions(*sort_keys)

    def open_run(src, chunk, _start, opened, count, since):
        run = _Run(bool(opened), int(count), int(since), max_failures, pause)
        return lambda t, good: [run.row(src, chunk)] if t is None else run.step(int(t), good)

    counts = with_heads.mapInPandas(
        lambda batches: _stream_groups(batches, open_run, _names(_COUNT_DDL)), _COUNT_DDL
    )
    last_reset = Window.partitionBy("source")
    marked = counts.withColumn("since_chunk", F.max(F.when(F.col("reset"), F.col("chunk"))).over(last_reset))
    counted = F.col("since_chunk").isNull() | (F.col("chunk") >= F.col("since_chunk"))
    status = marked.groupBy("source").agg(
        F.sum("trips").alias("trips"),
        F.bool_or("reset").alias("reset"),
        F.coalesce(F.sum(F.when(counted, F.col("failures"))), F.lit(0)).cast("bigint").alias("failures"),
        F.max("last_failure").alias("last_failure"),
        F.max_by(F.struct("exit_open", "exit_at"), "chunk").alias("exit"),
    )
    if initial is not None:
        before = initial.select(
            "source",
            (F.col("state") != "closed").alias("was_open"),
            F.col("failure_count").alias("had_failures"),
            F.col("trips").alias("had_trips"),
            F.unix_micros(F.col("last_failure_at").cast("timestamp")).alias("had_last"),
        )
        went_on = ~F.coalesce("reset", F.lit(False))
        status = status.join(before, "source", "full").select(
            "source",
            (F.coalesce("trips", F.lit(0)) + F.coalesce("had_trips", F.lit(0))).alias("trips"),
            (F.coalesce("failures", F.lit(0)) + F.when(went_on, F.coalesce("had_failures", F.lit(0))).otherwise(0)).alias("failures"),
            F.coalesce("last_failure", "had_last").alias("last_failure"),
            F.coalesce("exit", F.struct(F.col("was_open").alias("exit_open"), F.col("had_last").alias("exit_at"))).alias("exit"),
        )
    cooled = F.unix_micros(as_of.cast("timestamp")) - F.col("exit.exit_at") >= pause
    return status.select(
        "source",
        F.when(~F.col("exit.exit_open"), "closed").when(cooled, "half_open").otherwise("open").alias("state"),
        F.col("failures").alias("failure_count"),
        "trips",
        F.timestamp_micros("last_failure").cast("timestamp_ntz").alias("last_failure_at"),
    )
