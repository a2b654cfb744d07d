"""Centroid clustering, periodic runs and line deduplication against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimkeep.llm import centroids, line_dedup, periodic_runs
from dimkeep.llm.queries import ORACLES, planted, queries
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


# centroids


def plain_nearest(vectors, points):
    return [min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))[::-1] for v in vectors]


@pytest.mark.parametrize("dimension", [1, 2, 8, 64])
def test_search_on_coefficients_is_exact(dimension):
    draw = np.random.default_rng(dimension)
    for spread, kind in ((2, np.int64), (1000, np.int64), (1 << 27, np.int64)):  # the last is beyond 64-bit sums
        points = draw.integers(-spread, spread, (7, dimension)).astype(kind)
        points[5] = points[2]  # a tie for every vector
        vectors = np.concatenate((draw.integers(-spread, spread, (40, dimension)), points))
        chosen, distance, _ = centroids.nearest_centroids(vectors, points)
        assert [(int(c), int(d)) for c, d in zip(chosen, distance)] == plain_nearest(vectors.tolist(), points.tolist())


def test_transform_keeps_distances_and_starts_coarse():
    rows = np.random.default_rng(1).integers(-9, 9, (6, 16))
    out = centroids.walsh(rows)
    assert (out[:, 0] == rows.sum(axis=1)).all()
    assert (out[:, 1] == rows[:, :8].sum(axis=1) - rows[:, 8:].sum(axis=1)).all()  # one change of sign
    assert ((out**2).sum(axis=1) == 16 * (rows**2).sum(axis=1)).all()


def test_clustered_vectors_are_settled_by_few_coefficients():
    draw = np.random.default_rng(2)
    # smooth centroids: what tells them apart lies in the coarse coefficients
    points = np.repeat(draw.integers(-100, 100, (16, 4)), 16, axis=1)
    vectors = points[draw.integers(0, 16, 500)] + draw.integers(-3, 4, (500, 64))
    chosen, distance, taken = centroids.nearest_centroids(vectors, points)
    assert [(int(c), int(d)) for c, d in zip(chosen, distance)] == plain_nearest(vectors.tolist(), points.tolist())
    assert taken < 0.4 * 500 * 16 * 64


def plain_clusters(rows, clusters, rounds):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows]
    seed = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    points = [v for _, v in sorted(kept, key=seed)[:clusters]]
    for _ in range(rounds):
        own = defaultdict(list)
        for (_, v), (c, _) in zip(kept, plain_nearest([v for _, v in kept], points)):
            own[c].append(v)
        points = [[sum(x) // len(own[c]) for x in zip(*own[c])] if own[c] else p for c, p in enumerate(points)]
    found = plain_nearest([v for _, v in kept], points)
    total = defaultdict(int)
    for c, d in found:
        total[c] += d
    said = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, c, d, total[c], sum(total.values()), said[c]) for (i, _), (c, d) in zip(kept, found)), key=repr)


def test_clusters_of_odd_vectors(spark, rows):
    draw = random.Random(3)
    good = [(i, [float(draw.randrange(-4, 4)) / 8 for _ in range(8)]) for i in range(30)]
    good += good[:5] + [(None, [0.25] * 8), (3, [2.0] * 8), (90, [1e4] * 8), (91, [-3e5] * 8), (92, [0.0] * 8)]  # copies, null and shared ids
    odd = [(50, None), (51, [1.0] * 7), (52, [1.0] * 9), (53, []), (54, [None] + [1.0] * 7), (55, [float("nan")] * 8), (56, [float("inf")] * 8), (57, [float("-inf")] * 8)]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("x")).withColumn("V", F.lit(1)).withColumn("_cluster", F.lit(1))
    for clusters in (1, 5, 100):
        got = rows(centroids.cluster(df, dimension=8, clusters=clusters, rounds=3))
        assert got == plain_clusters(good, clusters, 3)
    assert rows(centroids.cluster(df.repartition(7), dimension=8, clusters=5)) == plain_clusters(good, 5, 3)
    assert centroids.cluster(df.limit(0), dimension=8).count() == 0
    assert centroids.cluster(df.filter("vec_id between 50 and 57"), dimension=8).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        centroids.cluster(df, dimension=7)


def test_an_empty_centroid_stays(spark, rows):
    same = [(i, [1.0, 1.0]) for i in range(4)] + [(9, [5.0, 5.0])]  # equal centroids: the second never gets a vector
    df = spark.createDataFrame(same, "vec_id long, embedding array<float>")
    assert rows(centroids.cluster(df, dimension=2, clusters=3)) == plain_clusters(same, 3, 3)


# periodic runs


def plain_runs(words):
    """Every period tried on the whole text."""
    place = {}
    ids = np.array([place.setdefault(w, len(place)) for w in words], np.int64)
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], ids[q:] == ids[:-q], [0]))))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = end - start + q
            stretch = ids[start : start + length]
            if length >= max(6, 4 * q) and not any((stretch[d:] == stretch[:-d]).all() for d in range(1, q)):
                out.append((start, length, q))
    return sorted(out)


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def some_words(draw):
    few, size, kind = draw.randint(1, 5), draw.randint(0, 90), draw.random()
    if kind < 0.4:
        return [f"w{draw.randrange(few)}" for _ in range(size)]
    words = []
    while len(words) < size:
        piece = [f"w{draw.randrange(few)}" for _ in range(draw.randint(1, 8))]
        words += piece * draw.randint(1, 9) + piece[: draw.randint(0, len(piece))]
    return words * draw.choice((1, 1, 4)) if kind > 0.8 else words


def test_runs_against_all_periods():
    draw, seen = random.Random(4), 0
    for _ in range(250):
        texts = [some_words(draw) for _ in range(draw.randint(1, 6))]  # searched together, and kept apart
        found = periodic_runs.runs_of(texts)
        assert found == [plain_runs(t) for t in texts]
        assert [periodic_runs.collapse(t, r) for t, r in zip(texts, found)] == [plain_collapse(t, r) for t, r in zip(texts, found)]
        seen += sum(map(len, found))
    assert seen > 500


def test_long_periods_and_long_runs():
    draw = random.Random(5)
    page = [str(draw.randrange(300)) for _ in range(1700)]
    fibonacci = ["a"]
    other = ["a", "b"]
    while len(other) < 3000:
        fibonacci, other = other, other + fibonacci
    texts = [["x"] * 30_000, page * 5 + page[:7], ["y"] + page * 4, page * 3, [str(i) for i in range(5000)], other, [c for i in range(800) for c in [str(i)] * 6]]
    assert periodic_runs.runs_of(texts) == [
        [(0, 30_000, 1)],
        [(0, 8507, 1700)],
        [(1, 6800, 1700)],
        [],
        [],
        [],  # no power of four in a Fibonacci word
        [(6 * i, 6, 1) for i in range(800)],
    ]


def test_equal_hashes_do_not_make_runs(monkeypatch):
    monkeypatch.setattr(periodic_runs._Stretches, "equal", lambda self, at, size, by: np.ones(len(at), bool))
    draw = random.Random(6)
    for _ in range(60):
        words = some_words(draw)
        assert set(periodic_runs.runs_of([words])[0]) == set(plain_runs(words))


def test_grammar_derives_its_texts():
    draw = random.Random(7)
    words = [some_words(draw) for _ in range(40)]
    place, ids, begins = {}, [], []
    for i, text in enumerate(t for t in words if t):
        begins.append(len(ids))
        ids += [place.setdefault((i, w), len(place)) for w in text]
    grammar = periodic_runs.re_pair(np.array(ids), np.array(begins))

    def derive(symbol):
        if symbol < grammar.words:
            return [symbol]
        rule = symbol - grammar.words
        assert rule < len(grammar.left)
        return derive(grammar.left[rule]) + derive(grammar.right[rule])

    assert [x for root in grammar.roots for x in derive(root)] == ids
    assert len(grammar.left) < len(ids) // 2  # repeats share their rules


def expected_row(doc_id, text):
    words = planted(doc_id, [w for w in re.split("[ \t-\r]+", text or "") if w])
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return doc_id, len(runs), *best, milli, sha(lines), sha(" ".join(plain_collapse(words, runs)))


def test_runs_query_on_the_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r[0]: tuple(r) for r in queries()["op12_periodic_runs"](spark, SF).drop("n_words").collect()}
    assert got.keys() == docs.keys()
    assert got == {i: expected_row(i, t) for i, t in docs.items()}
    assert sum(1 for r in got.values() if r[1]) > len(docs) // 20


def test_runs_of_odd_rows(spark, rows):
    long = "go " * 50_000
    data = [(1, None), (2, ""), (3, " \t\n "), (None, "a " * 8), (1, "a b " * 5), (1, "a b " * 5), (4, long), (5, "a b " * 6), (6, "x\x0bx\x0cx\rx\tx\nx")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("periodic", F.lit(1)).withColumn("KEY", F.lit(1))
    got = periodic_runs.periodic_runs(df).select("doc_id", "periodic.n_words", F.transform("periodic.runs", lambda r: F.array(r["start"], r["length"], r["period"])), "periodic.collapsed")
    assert rows(got) == sorted(
        [
            (1, 0, [], ""),
            (2, 0, [], ""),
            (3, 0, [], ""),
            (None, 8, [[0, 8, 1]], "a"),
            (1, 10, [[0, 10, 2]], "a b"),
            (1, 10, [[0, 10, 2]], "a b"),
            (4, 50_000, [[0, 50_000, 1]], "go"),
            (5, 6, [[0, 6, 1]], "a b"),
            (6, 6, [[0, 6, 1]], "x"),
        ],
        key=repr,
    )
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_planted_words():
    doc = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    words = [str(i) for i in range(100)]
    g = zlib.crc32(str(doc).encode()) // 10
    a = g % 100
    p = 1 + (100 - a) // (3 + g % 8)
    assert planted(doc, words) == [words[i] if i < a else words[a + (i - a) % p] for i in range(100)]
    assert planted(None, words) == words and planted(doc, []) == []


# lines


def plain_lines(data, least=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for doc, text in data:
        for line in (text or "").split("\n"):
            holders[key(line)].add((doc is None, doc or 0))
    out = []
    for doc, text in data:
        lines = (text or "").split("\n")
        stays = [ln for ln in lines if len(key(ln)) < least or min(holders[key(ln)]) == (doc is None, doc or 0)]
        out.append((doc, len(lines), len(lines) - len(stays), hashlib.sha256("\n".join(stays).encode()).hexdigest()))
    return sorted(out, key=repr)


def deduplicated(df):
    return line_dedup.digests(line_dedup.with_bitmaps(df, line_dedup.keep_bitmaps(df)))


ODD = [
    (7, "A line that two hold\nown line of seven\n\na line that two hold  "),
    (3, "\t a LINE that two hold\x0b\nshort\nshort"),
    (3, "a line that two hold\nanother text of the same id"),  # one id, two texts
    (7, "A line that two hold\nown line of seven\n\na line that two hold  "),  # a repeated row
    (9, None),
    (10, ""),
    (11, "123456789\n1234567890\nÄhnliche Zeile"),
    (12, "123456789\n 1234567890 \nähnliche Zeile\n 1234567890"),  # other letters and blanks stay as they are
    (13, "üüüüüüüüü\n" * 3),  # nine code points of two bytes
    (14, "üüüüüüüüü\n" + "only here, twice\n" * 2),
    (None, "a line that two hold\nof a row without id"),
    (None, "of a row without id\nshort"),
    (15, "x" * 200_000 + "\n1234567890"),
    (16, "x" * 200_000),
]


@pytest.mark.parametrize("partitions", [1, 2, 40])
def test_lines_of_odd_rows(spark, rows, partitions):
    df = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("hash", F.lit(1)).withColumn("Doc", F.lit("x")).withColumn("bitmap", F.lit(2))
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)  # borders fall inside groups
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows(deduplicated(df)) == plain_lines(ODD)
        many = [(i, f"one common line of all\nline {i % 9} of the group\nline {i} alone") for i in range(300)]
        assert rows(deduplicated(spark.createDataFrame(many, "doc_id long, text string").repartition(5))) == plain_lines(many)
    finally:
        for key, value in zip(("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"), before):
            spark.conf.set(key, value)
    assert deduplicated(df.limit(0)).count() == 0


def test_cut_texts(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("_bitmap", F.lit(5))
    got = line_dedup.without_repeated_lines(df)
    assert got.columns == df.columns
    said = sorted(((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in got.collect()), key=repr)
    assert said == sorted(((d, h) for d, _, _, h in plain_lines(ODD)), key=repr)


def test_bitmaps_round_trip():
    for positions, lines in (([0], 1), ([3, 9, 4], 12), ([99_999], 100_001), (list(range(50)), 50)):
        bitmap = line_dedup.pack_bits(np.array(positions))
        assert np.flatnonzero(~line_dedup.kept_lines(bitmap, lines)).tolist() == sorted(positions)
    assert len(line_dedup.pack_bits(np.array([1_000_000]))) < 1000


def test_queries_agree_with_sql_at_the_next_size(spark):
    for name in ("op11_centroids", "op13_line_dedup"):
        count, differences, _ = compare(queries()[name](spark, "/root/testdata/sf0.01"), connect("/root/testdata/sf0.01"), ORACLES[name])
        assert count > 0 and differences == []
