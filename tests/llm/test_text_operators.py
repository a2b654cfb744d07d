"""Token counts, packing, quality classifier, quality rules and language against plain versions."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dimkeep.llm import language_id, packing, quality_classifier, quality_rules, token_counts
from dimkeep.llm.word_ids import WordIds
from dimkeep.llm.queries import queries
from dimkeep.llm.shared import stored

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    "",
    " ",
    "a",
    "\n\n  a  b \n",
    "it's we'll 'tis don't 're",
    "x \x1c y\x0bz\x0c",
    "日本語 テスト é é 🙂🙂",
    "a<|endoftext|>b <|endoftext|> <|endoftex",
    "İstanbul ΣΑΣ   　x",
    "-" * 300,
    "THE!! *** ||| $$$%%% 1234 ½",
]


@pytest.fixture
def odd(spark):
    """Null ids, null and empty texts, repeated rows, a long text, and columns whose names operators use themselves."""
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(ODD)]
    rows += [(None, "no id", None, None, None), (7, None, None, "s", None), (3, ODD[3], "en", "s", 1), (3, ODD[3], "en", "s", 1)]
    rows += [(99, "a long text of words. " * 20_000, "en", "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("score", "kept", "m", "_m", "_words", "_statistics", "_measures", "_mix", "mix", "ids", "label", "_turn", "bucket"):
        df = df.withColumn(name, F.lit("x"))
    return df


# token counts


@pytest.fixture(scope="module")
def byte_tokens():
    path = public_tokenizers.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


def test_prefix_tables_are_the_library_s(byte_tokens):
    path, library = byte_tokens
    counter = token_counts.counter(path)
    rng = random.Random(3)
    letters = "aAbtheou 's.,!\n'  lr vemé 12<|>*# \t 日"
    texts = [t for t in ODD if len(t) < 200] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    for text in texts:
        want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counter.table(text).tolist() == want
        for budget in (-1, 0, 1, 3, 10, 1000):
            longest = max([i for i, n in enumerate(want) if n <= budget], default=0)
            assert counter.answers(text, (budget,)) == [want[-1], longest]


def test_token_counts_of_all_documents(spark, byte_tokens):
    path, library = byte_tokens
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries()["op9_token_counts"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)
        assert len(library.encode(docs[r.doc_id][: r.cut_1024], add_special_tokens=False).ids) <= 1024


def test_token_counts_of_odd_rows(spark, odd, byte_tokens):
    path, library = byte_tokens
    found = token_counts.count_prefixes(odd, path, budgets=(2,), keep_table=True)
    rows = found.withColumn("two", token_counts.tokens_of_prefix("prefix_tokens", 2)).withColumn("ok", token_counts.fits("prefix_tokens", 2, 1))
    want = Counter((r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in rows.collect()) == want
    null = [r for r in rows.collect() if r.doc_id == 7 and r.n_bytes == 0][0]
    assert (null.n_tokens, null.cut_2, null.prefix_tokens, null.two, null.ok) == (0, 0, [0], 0, True)
    assert token_counts.count_prefixes(odd.limit(0), path).count() == 0


# packing


def test_differencing_is_near_equal_and_whole():
    rng = random.Random(5)
    sizes = [rng.randint(1, 4095) for _ in range(300)]
    parts = packing.difference(sizes, 60)
    assert sorted(i for _, found in parts for i in found) == list(range(300))
    assert all(total == sum(sizes[i] for i in found) for total, found in parts)
    totals = [t for t, _ in parts]
    assert max(totals) - min(totals) < 0.05 * sum(sizes) / 60
    assert packing.difference([], 3) == [] and packing.difference([5, 5], 9) == [(5, [0]), (5, [1])]


def test_window_count_rises_with_the_capacity():
    assert len(packing.windows_of([6, 6, 6], 10)) == 3  # two would hold 18 of 20, but 12 exceeds 10
    assert max(t for t, _ in packing.windows_of([9, 8, 7, 3, 2, 1], 10)) <= 10


def check_packing(rows, tokens, capacity):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert sorted(pieces, key=str) == sorted((k for k, v in tokens.items() if v), key=str)
    for key, found in pieces.items():
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens * 4 == len(tokens[key])
            assert bytes(r.ids) == tokens[key][4 * at : 4 * (at + r.length)]
            at += r.length
        assert at == r.doc_tokens
    padding = 0
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding == 0


def test_packing_of_all_documents(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tokens = {r.doc_id: np.array(library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for r in docs.collect()}
    check_packing(packing.pack(docs, path).collect(), tokens, 4096)
    for r in queries()["op8_packing"](spark, SF).collect():
        assert r.ids_crc32 == zlib.crc32(tokens[r.doc_id][4 * r.start : 4 * (r.start + r.length)])


@pytest.mark.parametrize("name, end_id", [("word_bpe_49k.json", 2), ("byte_bpe_50k.json", None)])
def test_packing_of_odd_rows(spark, odd, name, end_id):
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    once = odd.filter("doc_id IS NOT NULL AND doc_id <> 7").dropDuplicates(["doc_id"])
    end = [] if end_id is None else [end_id]
    tokens = {r.doc_id: np.array(library.encode(r.text or "", add_special_tokens=False).ids + end, "<u4").tobytes() for r in once.collect()}
    check_packing(packing.pack(once, path, capacity=64, end_id=end_id).collect(), tokens, 64)
    whole = packing.pack(odd, path, capacity=64, end_id=end_id).agg(F.sum("length")).first()[0]
    assert whole == sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + len(end) for r in odd.collect())
    assert packing.pack(odd.limit(0), path).count() == 0


# quality classifier


def test_classifier_separates_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    scored = queries()["op5_quality_classifier"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = scored.filter("held_out").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert sum(g > b for g in good for b in bad) >= 0.98 * len(good) * len(bad)
    assert sum(r.predicted for r in rows if r.quality == 1) >= 0.98 * len(good)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored.collect())
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_discriminant_agrees_with_plain_densities(spark):
    rng = np.random.default_rng(1)
    d = len(quality_classifier.STATISTICS)
    x = {c: rng.normal(c, 1 + c, (200, d)) for c in (0, 1)}
    rows = [(200 * c + i, v.tolist()) for c in x for i, v in enumerate(x[c])]
    measured = spark.createDataFrame(rows, "doc_id long, statistics array<double>")
    labels = spark.createDataFrame([(200 * c + i, c) for c in x for i in range(200)], "doc_id long, quality int")
    model = quality_classifier.fit(measured, labels)
    overall = np.diag(np.var(np.concatenate([x[0], x[1]]), axis=0, ddof=1))
    densities = []
    for c in (0, 1):
        spread = (1 - quality_classifier.SHRINKAGE) * np.cov(x[c].T) + quality_classifier.SHRINKAGE * overall + quality_classifier.RIDGE * np.eye(d)
        off = x[1][:5] - x[c].mean(axis=0)
        densities.append(-0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(spread), off) - 0.5 * np.linalg.slogdet(spread)[1])
    assert np.allclose(model.score(x[1][:5]), 1 / (1 + np.exp(densities[0] - densities[1])))


def test_classifier_of_odd_rows(spark, odd):
    measured = stored(quality_classifier.statistics(odd))
    none = spark.createDataFrame([], "doc_id long, quality int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (5, 7), (None, 1), (6, 1), (8, 0)], "doc_id long, quality int")
    for known, expected in ((none, 0.5), (labels, None)):
        model = quality_classifier.fit(measured, known)
        rows = measured.select("doc_id", quality_classifier.score(model, F.col("statistics")).alias("s")).collect()
        assert len(rows) == odd.count() and all(0 <= r.s <= 1 for r in rows)
        assert expected is None or {r.s for r in rows} == {expected}
    assert quality_classifier.statistics_of("") == quality_classifier.statistics_of("")
    assert quality_classifier.statistics(odd.limit(0)).count() == 0


# quality rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def test_rules_counts_of_all_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries()["op6_quality_rules"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        n = plain_counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r.base_failed and r.kept)


def test_rules_keep_good_and_drop_bad(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries()["op6_quality_rules"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("NOT base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert sum(not r.kept for r in rows if r.quality == 0) >= 0.9 * sum(r.quality == 0 for r in rows)


def test_expectation_maximisation_learns_reliability():
    rules = ["sure", "also", "noisy"]
    patterns = {(1, 1, 1): 700, (1, 1, -1): 300, (-1, -1, 1): 60, (-1, -1, -1): 40, (0, 0, 0): 10}
    model = quality_rules.estimate(patterns, rules)
    assert model.errors["noisy"] > 0.2 > model.errors["sure"]
    assert model.posterior((1, 1, -1)) > 0.9 and model.posterior((-1, -1, 1)) < 0.1
    assert model.accuracies()["sure"] > model.accuracies()["noisy"]
    assert quality_rules.estimate({}, rules).good == quality_rules.FIRST_GOOD


def test_rules_of_odd_rows(spark, odd):
    measured = stored(quality_rules.with_measures(odd, "text", "measures"))
    assert measured.columns == [*odd.columns, "measures"]
    model = quality_rules.learn(measured, "measures")
    rows = measured.select("text", "measures", quality_rules.kept(model, "measures").alias("stays")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        m = r.measures
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == plain_counts(r.text)
        assert r.stays is False  # none has 50 words but the one that repeats itself
    nothing = quality_rules.with_measures(odd.limit(0), "text", "measures")
    assert quality_rules.learn(nothing, "measures").good == quality_rules.FIRST_GOOD


# language


def test_languages_of_all_documents_and_pages(spark):
    folder = "/root/testdata/sf0.01"
    found = queries()["op2_language_id"](spark, folder)
    docs, pages = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/pages.parquet")
    rows = found.filter("held_out AND doc_id IS NOT NULL").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.language == r.lang for r in rows) >= 0.98 * len(rows)
    assert found.filter("doc_id IS NOT NULL").count() == docs.count()
    named = found.join(pages.select("page_id", F.regexp_extract("html", 'lang="(\\w+)"', 1).alias("said")), "page_id").collect()
    assert len(named) == pages.count() and sum(r.language == r.said for r in named) >= 0.95 * len(named)


def test_evidence_outweighs_a_short_text(spark):
    model = language_id.LetterModel(("de", "en"), np.log(np.full((language_id.BUCKETS, 2), 1 / language_id.BUCKETS)))
    table = model.table.copy()
    for word, at in (("ja nein und der die das", 0), ("yes no and the that this", 1)):
        table[language_id.triples(word), at] += 5
    model = language_id.LetterModel(("de", "en"), table)
    rows = [(i, "ja nein und der die das", "de", "de", "a.de") for i in range(40)]
    rows += [(100 + i, "yes no and the that this", "en", "com", "b.com") for i in range(40)]
    rows += [(200, None, "de", "de", "a.de"), (201, "", None, None, None), (202, "und", "de", "de", "a.de"), (None, None, "zz", "zz", "new.zz"), (202, "und", "de", "de", "a.de")]
    df = spark.createDataFrame(rows, "key long, text string, declared string, suffix string, host string").withColumn("ll", F.lit(1))
    found = language_id.identify(df, model).collect()
    of = {r.key: r for r in found}
    assert len(found) == len(rows)
    assert of[200].language == "de" and of[200].confidence > 0.9 and of[202].language == "de"
    assert of[201].language in ("de", "en") and of[None].language in ("de", "en")
    assert language_id.identify(df.limit(0), model).count() == 0


def test_rare_languages_are_known_in_many_rows(spark):
    common = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the words of number "), F.col("id")).alias("text"), F.lit("en").alias("lang"))
    rare = [(30_000, "die Wörter und der Satz", "de"), (None, "les mots et la phrase", "FR"), (None, "las palabras y la frase", "es"), (None, "123", "xx")]
    docs = common.unionByName(spark.createDataFrame(rare, "doc_id long, text string, lang string"))
    model = language_id.fit(docs)
    assert model.languages == ("de", "en", "es", "fr")
    assert [model.languages[int(np.argmax(model.evidence(text)))] for _, text, _ in rare[:3]] == ["de", "fr", "es"]
    assert language_id.fit(docs, sample=1).languages == model.languages


def plain_languages(rows, model):
    """(language, confidence) of each row of text, declared, suffix and host, one row after another."""
    n, out = len(model.languages), []
    post = []
    for text, *_ in rows:
        ll = np.array(model.evidence(text or ""))
        post.append((ll, np.exp(ll) / np.exp(ll).sum()))
    domain = lambda host: ".".join(host.split(".")[::-1][:2]) if host is not None else None
    added = lambda some: sum((post[j][1] for j in some), np.zeros(n))
    usual = lambda some: (added(some) + 1) / (len(some) + n)
    every = range(len(rows))
    for i, row in enumerate(rows):
        prior = usual(every)
        if row[3] is not None:
            near = [j for j in every if domain(rows[j][3]) == domain(row[3])]
            prior = (added(near) + 10 * prior) / (len(near) + 10)
            others = [j for j in every if rows[j][3] == row[3] and j != i]
            prior = (added(others) + 10 * prior) / (len(others) + 10)
        score = post[i][0] + np.log(prior)
        for k in (1, 2):
            if row[k] is not None:
                p = usual([j for j in every if rows[j][k] is not None])
                others = [j for j in every if rows[j][k] == row[k] and j != i]
                score = score + np.log((added(others) + 5 * p) / ((len(others) + 5) * p))
        share = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
        out.append((model.languages[int(np.argmax(score))], share.max()))
    return out


def some_languages(spark, count):
    """A model of so many languages, each with words of its own letters, and rows of their words."""
    word = lambda i: "".join(chr(97 + i // 26**k % 26) * 2 for k in range(3))
    docs = spark.createDataFrame([(i * 10 + k, f"{word(i)} {word(i)} {word(i)[::-1]}", f"l{i:04d}") for i in range(count) for k in range(2)], "doc_id long, text string, lang string")
    return docs, language_id.fit(docs)


@pytest.mark.parametrize("per_pass", [256, 2])
def test_languages_against_a_plain_version(spark, monkeypatch, per_pass):
    monkeypatch.setattr(language_id, "PER_PASS", per_pass)
    docs, model = some_languages(spark, 5)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    rng = random.Random(5)
    pick = lambda *values: rng.choice(values)
    rows = [(pick(*texts, texts[0][:5], "", None), pick("x", "y", None), pick("de", "com/fr", None), pick("a.b.de", "c.b.de", "b.de", "com", None)) for _ in range(60)]
    rows.append((texts[2], "once", "seldom", "own.example"))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "key long, text string, declared string, suffix string, host string")
    found = {r.key: r for r in language_id.identify(df, model).collect()}
    for i, (language, confidence) in enumerate(plain_languages(rows, model)):
        assert found[i].confidence == pytest.approx(confidence, rel=1e-9)
        assert found[i].language == language


def test_hundreds_of_languages(spark):
    docs, model = some_languages(spark, 501)
    assert model.languages == tuple(f"l{i:04d}" for i in range(501))
    none = F.lit(None).cast("string")
    rows = docs.select("lang", F.col("doc_id").alias("key"), "text", none.alias("declared"), none.alias("suffix"), none.alias("host"))
    found = language_id.identify(rows, model).join(docs.withColumnRenamed("doc_id", "key"), "key").collect()
    best = lambda text: model.languages[int(np.argmax(model.evidence(text)))]
    assert len(found) == 1002 and all(r.by_text == best(r.text) for r in found)
    assert sum(r.language == r.lang for r in found) >= 0.98 * len(found)


def test_languages_of_odd_rows(spark, odd):
    model = language_id.fit(odd)
    assert model.languages == ("en",)
    assert language_id.fit(odd.limit(0)).languages == ()
    rows = odd.select(F.col("doc_id").alias("key"), "text", *[F.lit(None).cast("string").alias(c) for c in ("declared", "suffix")], F.col("source").alias("host"))
    assert {r.language for r in language_id.identify(rows, model).collect()} == {"en"}
    assert {r.language for r in language_id.identify(rows, language_id.fit(odd.limit(0))).collect()} == {None}
    pages = spark.createDataFrame([(None, None), ("x", "<HTML lang='FR-ca'><p>a&amp;b</p>"), ("http://a.b.de/en/1", "")], "url string, html string")
    assert [tuple(r) for r in pages.select(*language_id.page_evidence(pages)).collect()][1:] == [
        ("  a b ", "fr", None, None),
        ("", None, "de/en", "a.b.de"),
    ]


def test_each_distinct_word_is_looked_up_once():
    class Counted(dict):
        looked = 0

        def __getitem__(self, word):
            Counted.looked += 1
            return super().__getitem__(word)

    ids = WordIds(public_tokenizers.path("word_bpe_49k.json"))
    once = ids.encode(["one two\nthree"])[0]
    ids._place = Counted(ids._place)
    assert ids.encode(["one two\nthree"] * 500 + [""]) == [once] * 500 + [b""]
    assert Counted.looked <= 4


def test_a_small_memory_gives_the_same_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [[f"word{i} {'abc'[i % 3] * (i % 7 + 1)} the, {i}th" for i in range(at, at + 20)] for at in range(0, 400, 20)]
    few, many = WordIds(path, remembered=50), WordIds(path)
    assert [few.encode(t) for t in texts] == [many.encode(t) for t in texts]
    assert len(few._place) + len(few._older) < 200 < len(many._place)
