"""Approximate nearest neighbours in a hash-prefix forest (LSH forest).

Each tree gives a vector a long string of bits, the sides of random hyperplanes on
which it lies, and keeps all strings in one sorted array. Those that share the
query's first ``x`` bits are a range of the array. A search descends in every tree
to the longest prefix that is met, and then ascends in all trees together, one
bit at a time, until the ranges hold enough candidates; these are measured exactly.

The array of all trees is cut into runs of equal size by (tree, string, id), so no
string, however common, fills a run alone. Queries go to the runs that their ranges
touch, where vectors lie beside the strings, and only the best of each run travel on.
There are MAX_RUNS runs at most. A run that would be longer is cut into slices by a hash, and
the queries into parts, so that no task holds more than so many of either.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimkeep.llm.shared import stored

#: Trees, and bits of a string (63 at most, so that strings sort as longs).
TREES, BITS = 32, 48
#: Candidates, counted in every tree, at which the ascent ends, as a share of the indexed vectors.
SHARE = 1.3
#: Vectors from which the middle of each hyperplane's projections is taken; all are indexed.
SAMPLE = 4096
#: Entries of a slice of a run, runs (their bounds come to the driver), and queries that meet a slice at once; about.
RUN, MAX_RUNS, PART = 20_000, 65_536, 100_000
#: What a task holds at a time.
_GROUP = ("run", "slice", "part")


@dataclass(frozen=True)
class Hyperplanes:
    """Directions (dimensions, trees * bits) and the middle of the projections on each."""

    directions: np.ndarray
    middles: np.ndarray
    trees: int
    bits: int

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """A string for each vector and tree, as non-negative longs whose order is that of the bits."""
        above = (vectors @ self.directions > self.middles).reshape(len(vectors), self.trees, self.bits)
        return above @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))


def fit(vectors: DataFrame, dimensions: int, trees: int, bits: int) -> Hyperplanes:
    """Fixed random directions, halved at the median of a sample: the SAMPLE rows of smallest hash."""
    rows = vectors.select("vector").orderBy(F.xxhash64("digest")).limit(SAMPLE).collect()
    sample = np.array([r["vector"] for r in rows], np.float64).reshape(-1, dimensions)
    directions = np.random.default_rng(20).standard_normal((dimensions, trees * bits))
    return Hyperplanes(directions, np.median(sample @ directions, axis=0), trees, bits)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _kind(vectors: DataFrame, vector: str) -> str:
    """Single precision stays so, which halves what is moved; anything else becomes double."""
    return "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"


def usable(vectors: DataFrame, vec_id: str, vector: str, queries: Column) -> DataFrame:
    """Rows that take part: (vec_id, vector, asked, digest of the vector)."""
    v = F.col("vector")
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(_kind(vectors, vector)).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asked")
    ).filter(
        F.col("vec_id").isNotNull()
        & v.isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )

    @F.pandas_udf("binary")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            # + 0.0 makes the two zeros one
            yield pd.Series([xxhash.xxh3_128_digest((np.asarray(x, np.float64) + 0.0).tobytes()) for x in batch])

    return rows.withColumn("digest", digest(v))


def _distinct(rows: DataFrame, neighbours: int) -> DataFrame:
    """Distinct vectors: ``digest``, ``vector``, ``ids`` (the smallest ones, as many as an answer may need), ``asked``.

    A later id of a vector cannot be in an answer. Ids are made distinct before they
    are counted, and of a common vector each task hands on no more of them than that.
    """
    turn = F.row_number().over(Window.partitionBy("digest").orderBy("vec_id"))
    few = rows.select("digest", "vec_id").distinct().withColumn("_turn", turn).filter(F.col("_turn") <= neighbours + 1)
    ids = few.groupBy("digest").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    once = rows.groupBy("digest").agg(F.first("vector").alias("vector"), F.max("asked").alias("asked"))
    return once.join(ids, "digest").select("digest", "vector", "ids", "asked")


def _entries(distinct: DataFrame, planes: Hyperplanes) -> DataFrame:
    """The vectors once for each tree: (tree, string, digest, vector, ids, asked)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                strings = planes.strings(_matrix(batch.column(1)))
                for tree in range(planes.trees):
                    columns = [pa.array(np.full(batch.num_rows, tree, np.int32)), pa.array(strings[:, tree]), *batch.columns]
                    yield pa.record_batch(columns, names=["tree", "string", *batch.schema.names])

    kinds = f"digest binary, vector {_kind(distinct, 'vector')}, ids array<bigint>, asked boolean"
    return distinct.select("digest", "vector", "ids", "asked").mapInArrow(run, f"tree int, string bigint, {kinds}")


def _prefix(strings: np.ndarray, shared: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last string with the same first ``shared`` bits."""
    free = (np.int64(1) << (bits - shared).astype(np.int64)) - 1
    return strings & ~free, strings | free


@dataclass(frozen=True)
class _Runs:
    """Where the runs begin: their first (tree, string), and how many entries come before each. At most MAX_RUNS."""

    trees: np.ndarray
    strings: np.ndarray
    before: np.ndarray
    numbers: np.ndarray

    def _at(self, tree: np.ndarray, string: np.ndarray, after: bool) -> np.ndarray:
        """How many runs begin before (or, after, at or before) a place."""
        starts = self.trees.astype(object) * (1 << 64) + self.strings.astype(object)
        places = tree.astype(object) * (1 << 64) + string.astype(object)
        return np.searchsorted(starts, places, side="right" if after else "left")

    def touched(self, tree: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last run in which a place from low to high may lie."""
        return np.maximum(self._at(tree, low, False) - 1, 0), np.maximum(self._at(tree, high, True) - 1, 0)

    def around(self, tree: np.ndarray, string: np.ndarray, reach: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last run of those of a place's tree that hold ``reach`` entries on each side of it, or all of that side."""
        first, last = self.touched(tree, string, string)
        left = np.searchsorted(self.before, self.before[first] - reach, side="right") - 1
        right = np.searchsorted(self.before, self.before[np.minimum(last + 1, len(self.before) - 1)] + reach, side="left")
        begin, end = self.touched(tree, np.zeros_like(string), np.full_like(string, (1 << bits) - 1))
        return np.maximum(left, begin), np.minimum(right, end)


def _dealt(queries: DataFrame, columns: str, pick) -> DataFrame:
    """Query rows once for each run that ``pick`` names (first and last) for it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                first, last, numbers = pick(batch)
                times = last - first + 1
                out = batch.loc[batch.index.repeat(times)].reset_index(drop=True)
                nth = np.arange(len(out)) - np.repeat(np.cumsum(times) - times, times)
                yield out.assign(run=numbers[np.repeat(first, times) + nth])

    return queries.mapInPandas(run, f"{columns}, run int")


def _cut(number: int) -> Column:
    """One of ``number`` numbers from 0 on for each vector."""
    return F.pmod(F.xxhash64("digest"), F.lit(max(1, number))).cast("int")


def _each(number: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(max(1, number) - 1)))


def _levels(forest: DataFrame, queries: DataFrame, runs: _Runs, least: int, bits: int, cuts: tuple[int, int]) -> DataFrame:
    """The synchronous ascent: the most bits at which all trees together hold ``least`` entries, for each query."""

    def place(batch: pd.DataFrame):
        return *runs.around(batch["tree"].to_numpy(np.int64), batch["string"].to_numpy(np.int64), least, bits), runs.numbers

    def count(entries: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        digests, counts = [], []
        for tree, some in asked.groupby("tree"):
            array = np.sort(entries.loc[entries["tree"] == tree, "string"].to_numpy(np.int64))
            strings = some["string"].to_numpy(np.int64)
            found = np.zeros((len(strings), bits + 1), np.int64)
            for shared in range(bits + 1):
                low, high = _prefix(strings, np.full(len(strings), shared), bits)
                found[:, shared] = np.searchsorted(array, high, side="right") - np.searchsorted(array, low, side="left")
            digests += some["digest"].tolist()
            counts += list(found)
        return pd.DataFrame({"digest": digests, "found": counts})

    placed = _dealt(queries.select("digest", "tree", "string"), "digest binary, tree int, string bigint", place)
    placed = placed.select("*", _each(cuts[0]).alias("slice"), _cut(cuts[1]).alias("part"))
    counted = (
        forest.select("run", "slice", "tree", "string", _each(cuts[1]).alias("part"))
        .groupBy(*_GROUP)
        .cogroup(placed.groupBy(*_GROUP))
        .applyInPandas(count, "digest binary, found array<bigint>")
    )
    levels = range(bits + 1)
    totals = counted.groupBy("digest").agg(*[F.sum(F.col("found")[i]).alias(f"f{i}") for i in levels])
    # without enough entries in all, the root
    return totals.select("digest", F.greatest(*[F.when(F.col(f"f{i}") >= least, i).otherwise(0) for i in levels]).alias("shared"))


def _best(forest: DataFrame, queries: DataFrame, runs: _Runs, neighbours: int, bits: int, cuts: tuple[int, int]) -> DataFrame:
    """The nearest ids of each query in each run its ranges touch, each with its nearest vector: (digest, vec_id, score)."""

    def place(batch: pd.DataFrame):
        low, high = _prefix(batch["string"].to_numpy(np.int64), batch["shared"].to_numpy(np.int64), bits)
        return *runs.touched(batch["tree"].to_numpy(np.int64), low, high), runs.numbers

    def search(entries: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tree, some in asked.groupby("tree"):
            own = entries[entries["tree"] == tree].sort_values("string", kind="stable")
            if not len(own):
                continue
            array = own["string"].to_numpy(np.int64)
            vectors = np.stack(own["vector"].to_numpy()).astype(np.float64)
            squares = (vectors**2).sum(axis=1)
            ids = own["ids"].to_numpy()
            lengths = np.array([len(x) for x in ids])
            low, high = _prefix(some["string"].to_numpy(np.int64), some["shared"].to_numpy(np.int64), bits)
            begin, end = np.searchsorted(array, low, side="left"), np.searchsorted(array, high, side="right")
            asked_vectors, digests = np.stack(some["vector"].to_numpy()).astype(np.float64), some["digest"].to_numpy()
            for (a, b), group in pd.Series(np.arange(len(some))).groupby([begin, end]):
                if a >= b:
                    continue
                for q in group:
                    rough = squares[a:b] - 2 * (vectors[a:b] @ asked_vectors[q]) + asked_vectors[q] @ asked_vectors[q]
                    keep = min(neighbours + 1, b - a)
                    while True:
                        # near ties of the rough distance are all measured exactly
                        bound = np.partition(rough, keep - 1)[keep - 1] + 1e-9 * (1 + abs(squares[a:b]).max())
                        near = a + np.flatnonzero(rough <= bound)
                        named = np.concatenate(ids[near])
                        # vectors that share their ids do not fill the places of other ids
                        if len(near) == b - a or len(np.unique(named)) > neighbours:
                            break
                        keep = min(2 * len(near), b - a)
                    score = np.repeat(np.sqrt(((vectors[near] - asked_vectors[q]) ** 2).sum(axis=1)), lengths[near])
                    order = np.lexsort((named, score))
                    nearest_of_id = np.sort(np.unique(named[order], return_index=True)[1])
                    out += [(digests[q], int(named[i]), float(score[i])) for i in order[nearest_of_id[: neighbours + 1]]]
        return pd.DataFrame(out, columns=["digest", "vec_id", "score"])

    kinds = f"digest binary, tree int, string bigint, vector {_kind(queries, 'vector')}, shared int"
    placed = _dealt(queries.select("digest", "tree", "string", "vector", "shared"), kinds, place)
    placed = placed.select("*", _each(cuts[0]).alias("slice"), _cut(cuts[1]).alias("part"))
    return (
        forest.select("run", "slice", "tree", "string", "vector", "ids", _each(cuts[1]).alias("part"))
        .groupBy(*_GROUP)
        .cogroup(placed.groupBy(*_GROUP))
        .applyInPandas(search, "digest binary, vec_id bigint, score double")
    )


def nearest(
    vectors: DataFrame,
    queries: Column,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    neighbours: int = 10,
    trees: int = TREES,
    bits: int = BITS,
    share: float = SHARE,
) -> DataFrame:
    """The ``neighbours`` nearest found of each row for which ``queries`` holds, by Euclidean distance.

    A row for each: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (the distance on
    the original vectors, in double precision); nearest first, ties to the smaller
    id. A query's own id is no candidate. With too few candidates all are given.

    Null ids and vectors that are null, empty, zero or hold null or non-finite
    components take no part, nor do those of another length than most. Equal
    vectors are searched once. An id that occurs with several vectors is searched
    with each and found with each; its nearest counts. Other columns are not
    looked at. An empty table gives no rows.

    The ascent ends when the ranges of all trees hold ``share`` of the vectors,
    and twice the wanted neighbours for each tree; it ends at the root if there are fewer.
    On vectors without close neighbours, where every distance is much alike,
    that must be large for a recall of 0.9; on clustered ones far less does.
    """
    rows = stored(usable(vectors, vec_id, vector, queries))
    empty = "query_id long, rank int, vec_id long, score double"
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], empty)
    rows = rows.filter(F.size("vector") == lengths["d"])
    distinct = stored(_distinct(rows, neighbours))
    number, questions = distinct.agg(F.count(F.lit(1)), F.count_if("asked")).first()
    planes = fit(distinct, lengths["d"], trees, bits)
    entries = _entries(distinct, planes)  # worked out twice, for the bounds of the runs and for the runs, and not kept besides
    entry_runs = math.ceil(number * trees / RUN)
    parts = max(1, min(MAX_RUNS, entry_runs))
    cuts = math.ceil(entry_runs / parts), math.ceil(questions / PART)
    arrays = entries.repartitionByRange(parts, "tree", "string", "digest").sortWithinPartitions("tree", "string", "digest")
    forest = stored(arrays.withColumn("run", F.spark_partition_id()).withColumn("slice", _cut(cuts[0])))
    bounds = forest.groupBy("run").agg(F.min(F.struct("tree", "string")).alias("at"), F.count(F.lit(1)).alias("n")).orderBy("at", "run").toPandas()
    starts = bounds["at"].tolist()
    runs = _Runs(
        np.array([s["tree"] for s in starts], np.int64),
        np.array([s["string"] for s in starts], np.int64),
        np.concatenate([[0], np.cumsum(bounds["n"].to_numpy(np.int64))]),
        bounds["run"].to_numpy(np.int32),
    )
    asked = forest.filter("asked").select("digest", "tree", "string", "vector")
    levels = stored(_levels(forest, asked, runs, max(2 * neighbours * trees, math.ceil(share * number)), bits, cuts))
    found = stored(_best(forest, asked.join(levels, "digest"), runs, neighbours, bits, cuts))

    each = found.groupBy("digest", "vec_id").agg(F.min("score").alias("score"))
    turn = F.row_number().over(Window.partitionBy("digest").orderBy("score", "vec_id"))
    # one more than asked for, as the query's own id may be among them
    few = each.withColumn("_turn", turn).filter(F.col("_turn") <= neighbours + 1)
    answers = few.groupBy("digest").agg(F.collect_list(F.struct("score", "vec_id")).alias("all"))
    ids = rows.filter("asked").select(F.col("vec_id").alias("query_id"), "digest").distinct()
    pairs = ids.join(answers.hint("rebalance"), "digest").select("query_id", F.explode("all").alias("a"))
    pairs = pairs.filter("a.vec_id <> query_id").groupBy("query_id", F.col("a.vec_id").alias("vec_id")).agg(F.min("a.score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
