"""Nearest neighbours, near duplicates, mixing, chats, addresses and the pipeline against plain versions."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dimkeep.llm import chat, dart_minhash, mixing, near_duplicates, nearest, quality_classifier, url_filter
from dimkeep.llm.components import components
from dimkeep.llm.queries import ORACLES, queries
from dimkeep.llm.shared import free_name, stored
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    count, differences, _ = compare(queries()[name](spark, SF), connect(SF), ORACLES[name])
    assert count > 0 and differences == []


def test_free_name(spark):
    assert free_name(spark.createDataFrame([(1, 2)], "A int, a_ int"), "a") == "a__"


# nearest neighbours


def plain_nearest(rows, asked, k):
    out = {}
    for q, x in rows:
        if asked(q):
            found = sorted((math.dist(x, y), i) for i, y in rows if i != q)[:k]
            out[q] = [(i, d) for d, i in found]
    return out


def test_recall_against_all_pairs(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    want = plain_nearest(rows, lambda i: i % 100 == 0, 10)
    got = defaultdict(list)
    vectors = dict(rows)
    for r in sorted(queries()["op1_nearest"](spark, "/root/testdata/sf0.1").collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append(r.vec_id)
        assert r["rank"] == len(got[r.query_id]) and abs(r.score - math.dist(vectors[r.query_id], vectors[r.vec_id])) < 1e-9
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    assert sum(len({i for i, _ in want[q]} & set(got[q])) for q in want) >= 0.9 * 10 * len(want)


def test_search_of_odd_vectors(spark):
    rows = [(i, [1.0, float(i % 7), 0.5], "x") for i in range(40)]  # ties and copies
    rows += [(100, None, "x"), (101, [0.0, 0.0, 0.0], "x"), (102, [1.0, None, 1.0], "x"), (103, [float("nan"), 1.0, 1.0], "x")]
    rows += [(104, [float("inf"), 1.0, 1.0], "x"), (105, [1.0], "x"), (106, [], "x"), (None, [1.0, 1.0, 1.0], "x"), (0, [1.0, 0.0, 0.5], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, run string").withColumn("score", F.lit(1)).withColumn("digest", F.lit(1))
    got = defaultdict(list)
    for r in nearest.nearest(df, F.col("vec_id") % 5 == 0, neighbours=10).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = plain_nearest([(i, x) for i, x, _ in rows[:40]], lambda i: i % 5 == 0, 10)
    assert dict(got) == {q: [(i, pytest.approx(d)) for i, d in v] for q, v in want.items()}
    assert nearest.nearest(df.limit(0), F.lit(True)).count() == 0
    assert nearest.nearest(df.filter("vec_id IN (1, 101)"), F.lit(True)).count() == 0
    few = nearest.nearest(df.filter("vec_id IN (1, 2, 9)"), F.col("vec_id") == 1).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in few] == [(1, 1, 2), (1, 2, 9)]  # all there are


def test_slices_and_parts_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = sorted(map(tuple, nearest.nearest(df, F.col("vec_id") % 7 == 0).collect()))
    monkeypatch.setattr(nearest, "MAX_RUNS", 3)
    monkeypatch.setattr(nearest, "RUN", 700)  # 5 slices of each run
    monkeypatch.setattr(nearest, "PART", 20)  # 3 parts of the queries
    assert sorted(map(tuple, nearest.nearest(df, F.col("vec_id") % 7 == 0).collect())) == whole and len(whole) == 430


def test_search_counts_ids_and_not_rows(spark):
    shared = [(i, [1.0, float(i % 2), 0.5]) for i in range(30)]  # two vectors of fifteen ids each
    many = [(500, [1.0, 0.2, 0.5 + i / 1000]) for i in range(14)]  # one id with vectors nearer than all others
    again = [(-1, [1.0, 0.0, 0.5])] * 12  # one id that alone has as many rows as an answer may need
    far = [(1000 + i, [9.0, float(i), 9.0]) for i in range(20)]
    rows = 2 * (shared + many + far) + again
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in nearest.nearest(df, F.col("vec_id").isin(0, 1, 3, 29, 1000)).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    vectors = defaultdict(list)
    for i, x in rows:
        vectors[i].append(x)
    for q in (0, 1, 3, 29, 1000):
        want = sorted((min(math.dist(x, y) for x in vectors[q] for y in vectors[i]), i) for i in vectors if i != q)[:10]
        assert got[q] == [(i, pytest.approx(d)) for d, i in want]


# near duplicates


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    for spread, unit in ((1.5, 128), (0.05, 64)):
        true, found = [], []
        for _ in range(60):
            elements = rng.integers(0, 2**63, 60).astype(np.uint64)
            a = rng.gamma(1, spread, 60)
            b = a * rng.uniform(0.5, 1.3, 60)
            true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
            found.append((dart_minhash.signature(elements, a, unit) == dart_minhash.signature(elements, b, unit)).mean())
        assert abs(np.mean(true) - np.mean(found)) < 0.02
    order = rng.permutation(60)
    assert (dart_minhash.signature(elements, a, 64) == dart_minhash.signature(elements[order], a[order], 64)).all()


def plain_classes(texts, weighted=False):
    sets = {i: dart_minhash.shingles(dart_minhash.word_hashes(t or "")) for i, t in texts.items()}
    label = {i: i for i in texts}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            (a, ca), (b, cb) = sets[i], sets[j]
            if dart_minhash.similarity(a, b, *((ca, cb) if weighted else ())) >= 0.8:
                low, high = sorted((top(i), top(j)))
                label[high] = low
    return {i: top(i) for i in ids}


def test_classes_of_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r.class_id for r in queries()["op3_near_duplicates"](spark, SF).collect()}
    assert got == plain_classes(texts)


def test_texts_that_share_an_id(spark):
    word = lambda k: [f"w{k}_{i}" for i in range(120)]
    a, b, c = word(1), word(2), word(3)
    near = lambda words: " ".join(words[:-1] + ["other"])
    text = " ".join
    # one id with two texts; a near copy of the second under another id, then an exact one
    for copy in (near(b), text(b)):
        df = spark.createDataFrame([(5, text(a), "x"), (5, text(b), "x"), (9, copy, "x"), (7, text(c), "x"), (7, text(c), "y")], "doc_id long, text string, node string")
        got = sorted(tuple(r) for r in near_duplicates.near_duplicates(df).collect())
        assert got == [(5, 5), (5, 5), (7, 7), (7, 7), (9, 5)]
        kept = sorted((r.doc_id, r.text) for r in near_duplicates.one_of_each_class(df).collect())
        assert kept == sorted([(5, text(a)), (5, text(b)), (7, text(c))])


def test_classes_where_ids_repeat(spark):
    rng = np.random.default_rng(11)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    bases = [word(150) for _ in range(4)]
    rows = []
    for i in range(60):
        words = list(bases[rng.integers(0, 4)])
        for at in rng.integers(0, 150, rng.integers(0, 9)):
            words[at] = f"c{i}"
        rows.append((int(rng.integers(0, 25)), " ".join(words)))
    names = [f"{i}:{t}" for i, t in rows]
    by_text = plain_classes(dict(enumerate(t for _, t in rows)))
    smallest = defaultdict(lambda: 10**9)
    for n, (i, _) in enumerate(rows):
        smallest[by_text[n]] = min(smallest[by_text[n]], i)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in near_duplicates.near_duplicates(df).collect())
    assert got == sorted((i, smallest[by_text[n]]) for n, (i, _) in enumerate(rows))
    kept = near_duplicates.one_of_each_class(df).collect()
    place = {name: by_text[n] for n, name in enumerate(names)}
    assert sorted(place[f"{r.doc_id}:{r.text}"] for r in kept) == sorted(smallest)


@pytest.fixture
def copies(spark):
    """Chains and groups around the threshold, copies, short, empty, null and long texts, null and repeated ids."""
    rng = np.random.default_rng(7)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    base = word(300)
    rows = [(i, " ".join(base)) for i in range(5)]
    for i in range(10, 70):  # near copies of varying nearness, none of the smallest id alone
        changed = list(base)
        for at in rng.integers(0, 300, i % 14):
            changed[at] = f"c{i}"
        rows.append((i, " ".join(changed)))
    chain = word(200)
    for i in range(100, 115):
        rows.append((i, " ".join(chain)))
        chain = chain[15:] + word(15)
    passage = word(120)
    rows += [(200 + i, " ".join(word(40) + passage + word(40))) for i in range(30)]
    rows += [(300, "one two"), (301, " One\nTWO "), (307, "one, two!"), (302, "one two three"), (303, ""), (304, None), (305, " \n"), (306, "...")]
    rows += [(400, "again and again " * 20_000), (401, "again and again " * 20_001)]
    rows += [(None, "one two"), (None, None), (10, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("bucket", "label", "class_id", "_turn", "sig", "a", "b"):
        df = df.withColumn(name, F.lit("x"))
    return df


def test_classes_of_odd_rows(spark, copies, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 7)  # many blocks
    rows = near_duplicates.near_duplicates(copies).collect()
    texts = {r.doc_id: r.text for r in copies.collect() if r.doc_id is not None}
    assert len(rows) == copies.count()
    assert {r.doc_id: r.class_id for r in rows if r.doc_id is not None} == plain_classes(texts)
    assert [r.class_id for r in rows if r.doc_id is None] == [None, None]
    kept = near_duplicates.one_of_each_class(copies)
    assert kept.columns == copies.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(plain_classes(texts).values()))
    assert kept.filter("doc_id IS NULL").count() == 2
    assert near_duplicates.near_duplicates(copies.limit(0)).count() == 0
    weighted = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(copies.filter("doc_id < 300"), weighted=True).collect()}
    assert weighted == plain_classes({i: t for i, t in texts.items() if i < 300}, weighted=True)


def test_overlaps_are_exact(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 6, rng.integers(1, 40))) for _ in range(30)]
    sets = [dart_minhash.shingles(dart_minhash.word_hashes(t), 2) for t in texts]
    members = np.arange(0, 60, 2)  # others of the block are not looked at
    for together in (near_duplicates._TOGETHER, 5):
        monkeypatch.setattr(near_duplicates, "_TOGETHER", together)
        for weighted in (False, True):
            overlaps = near_duplicates._Overlaps(members, sets, 60, weighted)
            for n, i in enumerate(members):
                shared = overlaps.with_all(i)[members]
                found = shared / (overlaps.totals[i] + overlaps.totals[members] - shared)
                want = [dart_minhash.similarity(sets[n][0], b, *((sets[n][1], c) if weighted else ())) for b, c in sets]
                assert found.tolist() == want


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a long, b long")
    assert {r.node: r.label for r in components(links).collect()} == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}
    assert components(links.limit(0)).count() == 0


def test_rounds_are_written_in_few_files(spark, monkeypatch):
    """However many partitions shuffles have, a round has some files a core."""
    from dimkeep.llm import components as module

    written = []
    monkeypatch.setattr(module, "stored", lambda df: written.append(stored(df)) or written[-1])
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        labels = components(spark.range(2000).selectExpr("id AS a", "id + 2000 AS b"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert labels.where("label <> node % 2000").count() == 0 and labels.count() == 4000
    assert len(written) >= 3 and all(len(df.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism for df in written)


# mixing


def test_timetable_keeps_windows_and_deviation():
    for weights in ({"a": 1}, {"a": 3, "b": 1}, {f"s{i}": (i + 1) ** 3 for i in range(25)}, {None: 5, "a": 0, "b": 1e-9}):
        slots = mixing.quotas(weights, 500)
        assert sum(slots.values()) == 500 and all(n > 0 for n in slots.values())
        done = Counter()
        for source, k, release, deadline, slot in mixing.timetable(slots, 500):
            assert k == done[source] and release <= slot < deadline
            done[source] += 1
            assert all(abs(done[s] - (slot + 1) * n / 500) < 1 for s, n in slots.items())
        assert done == slots
    assert mixing.quotas({}, 5) == {} and mixing.timetable({}, 5) == []


def test_mixing_of_all_documents(spark):
    rows = queries()["op7_mixing"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = {r.source: r["count"] for r in docs.groupBy("source").count().collect()}
    assert Counter(r.source for r in rows) == counts and len({r.doc_id for r in rows}) == len(rows) == len({r.position for r in rows})
    per_block = Counter((r.source, r.block) for r in rows)
    for source, n in counts.items():
        assert [per_block[source, b] for b in range(-(-n // mixing.BLOCK))] == [min(mixing.BLOCK, n - b * mixing.BLOCK) for b in range(-(-n // mixing.BLOCK))]
    slots = mixing.quotas({s: n**0.5 for s, n in counts.items()})
    expected = {(s, k): (r, d, at) for s, k, r, d, at in mixing.timetable(slots)}
    for r in rows:
        turn, k = divmod(r.block, slots[r.source])
        assert (r.release, r.deadline, r.slot) == tuple(x + turn * mixing.PERIOD for x in expected[r.source, k])
        assert r.position // mixing.BLOCK == r.slot


def test_mixing_of_odd_rows(spark):
    rows = [(i % 9, "a" if i % 3 else None, None) for i in range(300)] + [(None, "b", "t"), (None, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, _number string")
    for name in ("mix", "_slots", "block", "slot", "position", "_turn"):
        df = df.withColumn(name, F.lit("x"))
    mixed = mixing.mix(df, {"a": 2.0, None: 1.0, "gone": 1.0}, block=4, period=8, out="at")
    got = mixed.collect()
    assert mixed.columns == [*df.columns, "at"] and len(got) == len(rows)
    placed = [r["at"].position for r in got if r.source == "a" or r.source is None]
    assert len(set(placed)) == len(placed) == 300
    assert all(r["at"].position is None and r["at"].block == 0 for r in got if r.source in ("b", ""))
    ordered = [r["at"].position for r in mixing.in_order(mixed, F.col("at.position")).collect()]
    assert ordered == sorted(placed) + [None, None]
    assert mixing.mix(df.limit(0), {}, out="at").count() == 0 and mixing.target_weights(df.limit(0)) == {}


def test_more_sources_than_slots(spark):
    rows = [(i, f"s{i}") for i in range(10_001)] + [(20_000 + i, "s0") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    weights = mixing.target_weights(df, power=1.0)
    assert len(weights) == 10_001
    slots = mixing.quotas(weights, mixing.period_of(weights))
    assert abs(slots["s0"] / sum(slots.values()) - 3001 / 13_001) < 0.01
    placed = mixing.mix(df, weights)
    assert placed.filter("mix.position IS NULL").count() == 0 and placed.select("mix.position").distinct().count() == 13_001


# chats


def test_chats_read_back_and_expand(spark):
    odd = ["", "\\", "\\\\", "\\n", "</turn>", "\\</turn>", "\\e", "\\\\e", "</turn>\\", "<turn user>\n", "a</turn>\n<turn b>\n", None, "日🙂</turn>", "\\" * 5 + "</turn>"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for r in ("user", "assistant", None, "a>\nb\\</turn>") for t in odd)]
    rows += [(2, 0, "user", "only asks"), (None, None, "assistant", "no id"), (3, 1, "assistant", "same"), (3, 1, "assistant", "same"), (3, 0, "user", "x" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("n", "segment", "all", "start", "examples"):
        df = df.withColumn(name, F.lit("x"))
    formatted = chat.format_conversations(df).cache()
    read = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.read_back(formatted).collect()}
    want = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or 0)):
        want[conv].append((role or "", text or ""))
    assert read == want
    text = {r.conv_id: r.text for r in formatted.collect()}
    examples = sorted(map(tuple, chat.examples_of(formatted).collect()), key=repr)
    assert len(examples) == sum(role == "assistant" for _, _, role, _ in rows)
    assert all(text[conv][start:end] == reply for conv, _, start, end, reply in examples)
    written = {(r.conv_id, r.turn): (r.context, r.reply) for r in chat.expand(formatted).collect()}
    assert written == {(conv, turn): (text[conv][:start], reply) for conv, turn, start, end, reply in examples}
    assert chat.format_conversations(df.limit(0)).count() == 0
    shifted = formatted.withColumn("examples", F.transform("examples", lambda e: F.struct(e["turn"], (e["start"] + 1).alias("start"), (e["end"] + 1).alias("end"))))
    assert all(text[conv][start:end].startswith(reply) for conv, _, start, end, reply in chat.examples_of(shifted).collect())
    assert sorted(map(tuple, chat.examples_of(shifted).collect()), key=repr) != examples


def test_the_odd_conversation(spark):
    row = [r for r in queries()["op4_chat_formatting"](spark, SF).collect() if r.conv_id == -7][0]
    said = "\\### Assistant: </turn> ok"
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())


# addresses


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 41 == 0).alias("listed")).cache()
    keys, listed = universe.select("key"), universe.filter("listed").select("key")
    elsewhere = spark.range(3000).select(F.concat(F.lit("e"), "id").alias("key"))  # listed, but on no page
    for sites in (listed, listed.union(elsewhere)):
        cascade = url_filter.Cascade.build(keys, sites)
        assert len(cascade.filters) > 1
        assert url_filter._listed(universe, cascade, [F.col("key")], "found").filter("found <> listed").count() == 0
    assert url_filter.Cascade.build(keys, listed.limit(0)).filters == []
    none = url_filter.Cascade.build(keys, elsewhere)
    assert url_filter._listed(keys, none, [F.col("key")], "found").filter("found").count() == 0
    assert url_filter._listed(listed, url_filter.Cascade.build(listed, listed), [F.col("key")], "found").filter("NOT found").count() == 0


@pytest.mark.parametrize("bits", [url_filter.MAX_BITS, 20])
def test_addresses_of_odd_rows(spark, monkeypatch, bits):
    monkeypatch.setattr(url_filter, "MAX_BITS", bits)  # 20: several shards
    urls = [None, "", "no scheme", "http://", "://NET/", "HTTP://A.Example.NET/en/x?y#z", "x://evil.com", "x://sub.EVIL.com:80/", "x://sub.evil.com/p", "x://notevil.com/", "x://net", "x://net?/", "x://org/fr/", "x://a..evil.com/", "x://ÄB.com/"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, urls[5]), (5, urls[5])]
    df = spark.createDataFrame(rows, "page_id long, url string")
    for name in ("host", "path", "listed", "_flag", "rule"):
        df = df.withColumn(name, F.lit("x"))
    rules = (url_filter.Rule("net", "/", False), url_filter.Rule("example.net", "/en/", True), url_filter.Rule("org", "/fr/", True))
    sites = spark.createDataFrame([("evil.com",), ("evil.com",), (None,), ("",), ("a.b.c.d",), ("net",)], "site string")
    got = url_filter.judge(df, rules, sites).collect()
    assert len(got) == len(rows)
    by = {r.page_id: tuple(r)[1:] for r in got if r.page_id is not None}
    assert by[0] == by[1] == by[2] == by[3] == ("", "", None, "allow", False)
    assert by[4] == ("net", "/", "net/", "block", True)
    assert by[5] == ("a.example.net", "/en/x", "example.net/en/", "allow", True)
    assert by[6] == ("evil.com", "", None, "block", True) and by[8] == ("sub.evil.com", "/p", None, "block", True)
    assert by[7] == ("sub.evil.com:80", "/", None, "allow", False) and by[9][3] == "allow"
    assert by[10] == ("net", "", None, "block", True) and by[12][2:4] == ("org/fr/", "allow") and by[13][3] == "block"
    assert by[14][0] == "Äb.com"
    assert url_filter.judge(df.limit(0), rules, sites).count() == 0
    assert {r.verdict for r in url_filter.judge(df, (), sites.limit(0)).collect()} == {"allow"}


# pipeline


def test_pipeline_by_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = docs.withColumn("_statistics", F.lit(1)).withColumn("_measures", F.lit(2)).withColumn("_mix", F.lit(3))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    columns, before = extra.columns, extra
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, folder).collect(), extra.schema)
        assert after.columns == columns
        had, has = ({r.doc_id for r in x.select("doc_id").collect()} for x in (before, after))
        assert has <= had and after.count() == len(has)
        if name.startswith("quality"):
            good = {r.doc_id for r in labels.filter("quality = 1").collect()} & had
            assert len(good & has) >= 0.95 * len(good)
        if name == "near duplicates":
            assert has == set(plain_classes({r.doc_id: r.text for r in before.collect()}).values()) if len(had) <= 1000 else has
        if name == "source mixing":
            assert has == had
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, folder)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == has


def test_classifying_takes_one_worker_a_task(spark):
    """Texts are measured and scored in one step, with the scores of the two steps."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.classify(spark, docs, SF)
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    known = quality_classifier.statistics(docs.filter(~quality_classifier.held_out("doc_id")))
    model = quality_classifier.fit(known, spark.read.parquet(f"{SF}/labels.parquet"))
    text = F.col("text")
    both = docs.select(quality_classifier.score_text(model, text).alias("a"), quality_classifier.score(model, quality_classifier.measure(text)).alias("b"))
    assert both.where("a <=> b").count() == docs.count()


def test_sequences_follow_the_mix_over_files_of_unequal_size(spark, tmp_path):
    rows = [(i, f"w{i} " * (20 + i), "big" if i % 10 else "small") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, mixing.target_weights(docs, power=corpus_pipeline.POWER))
    place = {r.doc_id: r.position for r in mixed.select("doc_id", "mix.position").collect()}
    at = sorted(place, key=place.get)
    path = str(tmp_path / "mixed")
    for part in (at[:100], at[100:900], at[900:]):  # the first file is the smallest
        spark.createDataFrame([rows[i] for i in part], docs.schema).coalesce(1).write.mode("append").parquet(path)
    # several partitions, however they come about
    confs = {"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {c: spark.conf.get(c) for c in confs}
    for c, value in confs.items():
        spark.conf.set(c, value)
    try:
        packed = corpus_pipeline.pack(spark, spark.read.parquet(path), "").select("doc_id", "sequence_id").collect()
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    parts = defaultdict(set)
    for r in packed:
        parts[r.sequence_id >> 40].add(place[r.doc_id])
    ranges = [(min(parts[p]), max(parts[p])) for p in sorted(parts)]
    assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert {r.doc_id for r in packed} == set(place)


def test_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_stages_on_empty_and_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    good = " ".join(f"Word{i} says one{i} thing and then{i} another{i}." for i in range(30))
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, good, None, "s", 1), (2, good, None, "s", 1), (None, good, "en", "s", 1)]
    for data in ([], rows):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(((r.doc_id, r.text == good) for r in docs.collect()), key=str) == ([(2, True), (None, True)] if data else [])
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert {r.doc_id for r in pieces} == ({2, None} if data else set())
