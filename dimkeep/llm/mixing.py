"""Mix sources to target weights by proportionate fair (Pfair) scheduling.

Every source is cut into blocks of rows, and time into slots that hold one block.
With a target weight of ``n`` slots in a period of ``Q``, block ``k`` of a source may
not start before slot ``floor(k * Q / n)``, its release, and must have run before
``ceil((k + 1) * Q / n)``, its deadline. Taking in each slot the released block of
the earliest deadline meets all deadlines, and at every slot each source is less
than one block away from its target.

The timetable of one period says all: it repeats. So a row's slot follows from its
number within its source, and the rows are numbered in parallel.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimkeep.llm.shared import free_name

#: Slots of a period at least: the finest weight is one in as many.
PERIOD = 10_000
#: Slots of a period for each source at least, so that one slot for the smallest takes little from the others.
_SLOTS = 16
#: A timetable of up to so many slots is broadcast.
_BROADCAST = 200_000
#: Rows of a block.
BLOCK = 32
#: Hash buckets in which the rows of one source are numbered.
_BUCKETS = 1024

Source = str | None


def target_weights(docs: DataFrame, *, source: str = "source", power: float = 0.5) -> dict[Source, float]:
    """Weights in proportion to a power of the sources' row counts: 1 as they are, 0 all alike.

    One number for each source comes to the driver, however many sources there are.
    """
    counts = docs.groupBy(F.col(source).cast("string").alias("source")).count().collect()
    return {r["source"]: float(r["count"]) ** power for r in counts}


def period_of(weights: Mapping[Source, float]) -> int:
    """Slots of a period for so many sources."""
    return max(PERIOD, _SLOTS * sum(w > 0 for w in weights.values()))


def quotas(weights: Mapping[Source, float], period: int = PERIOD) -> dict[Source, int]:
    """Slots of each source in a period, by largest remainders; a positive weight has one at least."""
    positive = {s: float(w) for s, w in weights.items() if w > 0}
    if not positive:
        return {}
    if len(positive) > period:
        raise ValueError(f"{len(positive)} sources do not fit a period of {period} slots")
    total = sum(positive.values())
    share = {s: w / total * period for s, w in positive.items()}
    slots = {s: max(1, int(v)) for s, v in share.items()}
    order = lambda s: (s is not None, s or "")
    while (spare := period - sum(slots.values())) != 0:
        step = 1 if spare > 0 else -1
        able = [s for s in slots if slots[s] + step >= 1]
        far = sorted(able, key=lambda s: (-step * (share[s] - slots[s]), order(s)))
        for s in far[: abs(spare)]:
            slots[s] += step
    return slots


def timetable(slots: Mapping[Source, int], period: int = PERIOD) -> list[tuple[Source, int, int, int, int]]:
    """(source, block of the period, release, deadline, slot) of every slot of a period, earliest deadline first."""
    order = sorted(slots, key=lambda s: (s is not None, s or ""))
    window = lambda at, k: (k * period // slots[order[at]], -(-(k + 1) * period // slots[order[at]]))
    waiting = [(0, at, 0) for at in range(len(order))]
    released: list[tuple[int, int, int, int]] = []
    heapq.heapify(waiting)
    out = []
    for slot in range(period if order else 0):
        while waiting and waiting[0][0] <= slot:
            release, at, k = heapq.heappop(waiting)
            heapq.heappush(released, (window(at, k)[1], at, k, release))
        deadline, at, k, release = heapq.heappop(released)
        out.append((order[at], k, release, deadline, slot))
        if k + 1 < slots[order[at]]:
            heapq.heappush(waiting, (window(at, k + 1)[0], at, k + 1))
    return out


def _number(docs: DataFrame, key: str, doc_id: str, out: str) -> DataFrame:
    """Rows of each source numbered from 0 in the order of a hash of the id, bucket by bucket."""
    hashed, bucket, before = (free_name(docs, n) for n in ("_hashed", "_bucket", "_before"))
    rows = docs.withColumn(hashed, F.xxhash64(doc_id)).withColumn(bucket, F.pmod(F.col(hashed), F.lit(_BUCKETS)))
    upto = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(key, bucket).agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select(key, bucket, F.coalesce(F.sum("_size").over(upto), F.lit(0)).alias(before))
    within = F.row_number().over(Window.partitionBy(key, bucket).orderBy(hashed, doc_id)) - 1
    numbered = rows.withColumn(out, within).join(starts, [key, bucket])
    return numbered.withColumn(out, F.col(out) + F.col(before)).drop(hashed, bucket, before)


def mix(
    docs: DataFrame,
    weights: Mapping[Source, float],
    *,
    source: str = "source",
    doc_id: str = "doc_id",
    block: int = BLOCK,
    period: int | None = None,
    out: str = "mix",
) -> DataFrame:
    """``docs`` with a struct ``out``: ``block`` (number in its source), ``release``, ``deadline``, ``slot``
    and ``position``, which orders the mixed rows (slot by slot, within a slot by turn).

    Every row has one place. Where a source has run out its slots stay empty, so
    the others keep their places. A null source is a source of its own. Rows of a
    source without a positive weight have only a block; the rest is null, and they
    come after all others. Null and repeated ids have places like others. No rows
    or no weights give no places, without failing. The ``period`` follows from the
    number of sources unless it is given; it must not be smaller than that number.
    """
    period = period_of(weights) if period is None else period
    spark = docs.sparkSession
    key, number, slots, nth, turn, when = (free_name(docs, n) for n in ("_source", "_number", "_slots", "_nth", "_turn", "_when"))
    named = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))
    name = lambda s: "null" if s is None else f"={s}"
    rows = _number(docs.withColumn(key, named), key, doc_id, number)
    per_period = quotas(weights, period)
    table = [(name(s), per_period[s], k, r, d, at) for s, k, r, d, at in timetable(per_period, period)]
    light = F.broadcast if len(table) <= _BROADCAST else lambda df: df
    plan = spark.createDataFrame(table, "source string, n int, nth int, release long, deadline long, slot long")
    share = plan.select(F.col("source").alias(key), F.col("n").alias(slots)).distinct()
    slot_of = plan.select(F.col("source").alias(key), F.col("nth").alias(nth), F.struct("release", "deadline", "slot").alias(when))
    count = F.col(number)
    placed = (
        rows.join(light(share), key, "left")
        .withColumn(nth, F.floor(count / block) % F.col(slots))
        .withColumn(turn, F.floor(F.floor(count / block) / F.col(slots)) * period)
        .join(light(slot_of), [key, nth], "left")
    )
    at = F.struct(
        F.floor(count / block).alias("block"),
        *((F.col(turn) + F.col(when)[c]).alias(c) for c in ("release", "deadline", "slot")),
        ((F.col(turn) + F.col(when)["slot"]) * block + count % block).alias("position"),
    )
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns if c != out], at.alias(out))


def in_order(mixed: DataFrame, position: Column) -> DataFrame:
    """Rows sorted over all partitions by position, those without one last; files written from it follow the mix."""
    return mixed.orderBy(position.asc_nulls_last())
