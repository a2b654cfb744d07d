"""Judge addresses by rules and by a list of sites held in a cascade of Bloom filters.

The first filter of a cascade holds the listed keys. All keys of the corpus go through
it, and only those that pass are looked up in the list. The second holds those of them that are
not listed, the third the listed ones that pass the second, and so on until none is left. Over the complete universe of
the corpus's keys, from which it was built, the answer is then exact: a key is
listed if the first filter that it fails has an even number. Judging an address
takes a few bit tests in filters a fraction of the list's size; nothing is joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeep.llm.shared import free_name, stored

#: Bits of all filters that one task holds at once; a longer list is cut into shards by a hash.
MAX_BITS = 1 << 26
_WORD = 32
_LEVELS = 200


@dataclass(frozen=True)
class Rule:
    """Addresses of a host and its subdomains whose path begins like this one's."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Filter:
    bits: int
    hashes: int
    words: np.ndarray  # unsigned 32-bit

    def passes(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.ones(len(low), bool)
        for i in range(self.hashes):
            at = (low + i * high) % self.bits
            out &= (self.words[at // _WORD] >> (at % _WORD).astype(np.uint32)) & np.uint32(1) == 1
        return out


def _halves(key: Column, level: int) -> tuple[Column, Column]:
    """Two 40-bit hashes of a key, of its own for each level."""
    return (
        F.shiftrightunsigned(F.xxhash64(key, F.lit(2 * level)), 24),
        F.shiftrightunsigned(F.xxhash64(key, F.lit(2 * level + 1)), 24).bitwiseOR(F.lit(1)),
    )


def _build(keys: DataFrame, count: int, chance: float, level: int) -> Filter:
    """A filter of the given keys (column ``key``); its bits are joined where the keys are."""
    bits = max(64, math.ceil(count * math.log2(1 / chance) / math.log(2)))
    hashes = max(1, round(math.log2(1 / chance)))
    low, high = _halves(F.col("key"), level)
    places = keys.select(F.explode(F.array(*[(low + i * high) % bits for i in range(hashes)])).alias("at"))
    set_ = places.groupBy(F.floor(F.col("at") / _WORD).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % _WORD).cast("int"))).alias("mask")
    )
    words = np.zeros(-(-bits // _WORD), np.uint32)
    found = set_.toPandas()  # at most bits / 32 rows, within MAX_BITS
    words[found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).astype(np.uint32)
    return Filter(bits, hashes, words)


def _passing(keys: DataFrame, one: Filter, level: int) -> DataFrame:
    held = keys.sparkSession.sparkContext.broadcast(one)

    @F.pandas_udf("boolean")
    def passes(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for low, high in batches:
            yield pd.Series(held.value.passes(low.to_numpy(np.int64), high.to_numpy(np.int64)))

    return keys.filter(passes(*_halves(F.col("key"), level)))


class Cascade:
    """Exact membership of a list over the keys it was built from."""

    def __init__(self, filters: Sequence[Filter]):
        self.filters = list(filters)

    @classmethod
    def build(cls, universe: DataFrame, listed: DataFrame) -> Cascade:
        """From distinct keys and distinct listed keys (``key``); a key that was not among the former may get either answer."""
        number, keys = listed.count(), universe.count()
        if not number:
            return cls([])
        # the first filter lets so many others pass as make the sum of all sizes least
        filters = [_build(listed, number, min(0.5, max(1e-9, number * math.sqrt(0.5) / max(1, keys))), 0)]
        marked = listed.select("key", F.lit(True).alias("listed"))
        passed = stored(_passing(universe, filters[0], 0).join(marked, "key", "left").select("key", F.coalesce("listed", F.lit(False)).alias("listed")))
        held, others = passed.filter("NOT listed").select("key"), passed.filter("listed").select("key")
        number = held.count()
        while number:
            if len(filters) == _LEVELS:
                raise RuntimeError("the cascade does not end")
            filters.append(_build(held, number, 0.5, len(filters)))
            wrong = stored(_passing(others, filters[-1], len(filters) - 1))
            held, others, number = wrong, held, wrong.count()
        return cls(filters)

    @property
    def bits(self) -> int:
        return sum(f.bits for f in self.filters)


def _listed(rows: DataFrame, cascade: Cascade, keys: Sequence[Column], out: str) -> DataFrame:
    """``rows`` with a flag: whether one of its keys (null: no key) is listed."""
    if not cascade.filters:
        return rows.withColumn(out, F.lit(False))
    held = rows.sparkSession.sparkContext.broadcast(cascade.filters)

    @F.pandas_udf("boolean")
    def listed(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for halves in batches:
            filters = held.value
            some = np.zeros(len(halves[0]), bool)
            step = 2 * len(filters)
            for at in range(0, len(halves), step + 1):
                undecided = halves[at].to_numpy(bool)
                answer = np.zeros(len(some), bool)
                for level, one in enumerate(filters):
                    low, high = (halves[at + 1 + 2 * level + i].to_numpy(np.int64) for i in (0, 1))
                    inside = one.passes(low, high)
                    # failing an even filter (counted from 1) says listed, failing an odd one not listed
                    answer |= undecided & ~inside & (level % 2 == 1)
                    undecided = undecided & inside
                answer |= undecided & (len(filters) % 2 == 1)
                some |= answer
            yield pd.Series(some)

    arguments: list[Column] = []
    for key in keys:
        arguments.append(key.isNotNull())
        for level in range(len(cascade.filters)):
            arguments += _halves(F.coalesce(key, F.lit("")), level)
    return rows.withColumn(out, listed(*arguments))


def with_address(pages: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """``pages`` with the host (A-Z in lower case) and the path of an address; both empty without ``://``."""
    whole = F.coalesce(F.col(url), F.lit(""))
    at = F.locate("://", whole)
    rest = F.when(at > 0, F.substring(whole, at + 3, F.length(whole))).otherwise("")
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return pages.withColumns(
        {
            host: F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), capitals, capitals.lower()),
            path: F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
        }
    )


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else nulls."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is asked first
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, "allow" if rule.allow else "block").otherwise(verdict)
    return name, verdict


def site_keys(host: Column, labels: Sequence[int]) -> list[Column]:
    """The host's last ``n`` labels for each n, null if it has fewer."""
    dots = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))
    return [F.when((host != "") & (dots >= n - 1), F.substring_index(host, ".", -n)) for n in labels]


def judge(
    pages: DataFrame, rules: Sequence[Rule], sites: DataFrame, *, page_id: str = "page_id", url: str = "url", site: str = "site"
) -> DataFrame:
    """A row for each row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``listed``.

    The verdict is that of the longest rule that fits, else block if the host or
    a domain above it is in ``sites``, else allow. ``listed`` says the latter for every row.

    Null addresses and those without ``://`` have an empty host and path, fit no rule with
    a host and are listed nowhere. Null ids and repeated rows stay. Null, empty and
    repeated sites do not matter. Other columns are not looked at; an empty table gives no rows.

    The universe is every key of every page: the ends of its host with as many
    labels as some listed site has. Keys are made distinct where they are read.
    """
    named = with_address(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")), "url", "host", "path").drop("url")
    listed_sites = sites.select(F.lower(F.col(site)).alias("key")).filter("key <> ''").distinct()
    depth = F.size(F.split("key", r"\.")).alias("n")
    labels = sorted(r["n"] for r in listed_sites.select(depth).distinct().collect())  # a host name has 127 labels at most
    keys = site_keys(F.col("host"), labels)
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    rows = named.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("_verdict"), F.lit(False).alias("listed"))
    if keys:
        listed_sites = stored(listed_sites)
        universe = stored(named.select(F.explode(F.array_compact(F.array(*keys))).alias("key")).distinct())
        number, size = listed_sites.count(), universe.count()
        # twice what a cascade takes: the first filter, and less than as much for all others
        expected = 2 * number * (1.5 * math.log2(max(2, size / max(1, number))) + 6)
        shards = max(1, math.ceil(expected / MAX_BITS))
        for shard in range(shards):
            inside = lambda key: key if shards == 1 else F.when(F.pmod(F.xxhash64(key, F.lit(-1)), shards) == shard, key)  # noqa: B023, E731
            part = lambda all_: all_ if shards == 1 else all_.filter(inside(F.col("key")).isNotNull())  # noqa: B023, E731
            flag = free_name(rows, "_flag")
            rows = _listed(rows, Cascade.build(part(universe), part(listed_sites)), [inside(k) for k in keys], flag)
            rows = rows.withColumn("listed", F.col("listed") | F.col(flag)).drop(flag)
            if shard + 1 < shards:
                rows = stored(rows)  # one shard is held at a time
    decided = F.coalesce("_verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", decided.alias("verdict"), "listed")
