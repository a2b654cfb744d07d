"""Language of a text by Bayesian fusion of evidence.

Four kinds of evidence are added up as logarithms: how likely the text's letters
are in each language, the language that the markup declares, the suffix of the
address, and a prior for the host. What a declaration or a suffix is worth is
estimated from the corpus itself: from the languages that the other rows' texts alone
suggest. So is the host prior, which leans on its domain's, and that on the whole
corpus's, the more the fewer texts there are. All these are grouped sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeep.llm.shared import stored

#: Labelled texts of each language that the letter model is fitted to, about; chosen by a hash, all where there are fewer.
SAMPLE = 4000
#: Hash buckets of letter triples.
BUCKETS = 1 << 14
#: A text counts as so many independent triples at most, so that it can be outweighed.
MOST_TRIPLES = 60.0
#: Texts' worth of belief of a level in the level above, and of a declaration in the corpus's languages.
HOST_BELIEF, VALUE_BELIEF = 10.0, 5.0
#: Languages whose letters a task holds at a time (128 kB each); with more, texts are read once for every so many.
PER_PASS = 256

_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
#: Texts that ``triples`` finds something in: two bytes of letters at least.
_HAS_TRIPLE = r"[^\x00-\x7F]|[A-Za-z][^A-Za-z]*[A-Za-z]"


def triples(text: str) -> np.ndarray:
    """Buckets of the neighbouring three bytes of the letters in lower case, runs of other characters as one blank."""
    letters = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "
    b = np.frombuffer(letters, np.uint8).astype(np.uint32)
    if len(b) < 4:
        return np.zeros(0, np.int64)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - 14)).astype(np.int64)


@dataclass(frozen=True)
class LetterModel:
    """Languages, and the log probability of each bucket in each."""

    languages: tuple[str, ...]
    table: np.ndarray

    def likelihood(self, text: str) -> np.ndarray:
        """Log likelihood of a text in each language; zeros for a text without letters."""
        found = triples(text)
        counts = np.bincount(found, minlength=BUCKETS)
        some = np.flatnonzero(counts)
        return counts[some] @ self.table[some] * min(1.0, MOST_TRIPLES / max(1, len(found)))

    def evidence(self, text: str) -> list[float]:
        """``likelihood`` less the highest."""
        total = self.likelihood(text)
        return (total - total.max()).tolist()

    def blocks(self, size: int) -> Iterator[LetterModel]:
        """Models of ``size`` languages each, in order."""
        for at in range(0, len(self.languages), size):
            yield LetterModel(self.languages[at : at + size], np.ascontiguousarray(self.table[:, at : at + size]))


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE) -> LetterModel:
    """Count triples by language in about ``sample`` labelled texts of each language, or all where there are fewer.

    Rows without a text or a language take no part, nor do texts without a triple of
    letters. The languages are those of all other rows, however rare. Rows are chosen
    by a hash of id and text, so null and repeated ids are chosen like others.
    """
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.lower(F.col(lang)).alias("lang"))
    known = known.filter("lang <> ''").filter(F.col("text").rlike(_HAS_TRIPLE))
    known = known.select("lang", "text", F.xxhash64("doc_id", "text").alias("hashed"))
    sizes = known.select("lang", "hashed").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("hashed").alias("least"))
    # the share of all hashes that holds ``sample`` of a language's; its least is always in
    share = F.when(F.col("n") > sample, (F.lit(2.0 * sample) / F.col("n") - 1) * F.lit(2.0**63))
    upto = F.when(share.isNull(), F.lit(2**63 - 1)).otherwise(F.greatest("least", share.cast("long")))
    sizes = stored(sizes.select("lang", upto.alias("upto")))
    languages = sorted(r["lang"] for r in sizes.select("lang").collect())
    known = known.join(sizes, "lang").filter("hashed <= upto")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(language, np.zeros(BUCKETS, np.int64))
                counts[language] += np.bincount(triples(value), minlength=BUCKETS)
        for language, n in counts.items():
            some = np.flatnonzero(n)
            yield pa.record_batch([pa.array([language] * len(some)), pa.array(some), pa.array(n[some])], names=["lang", "bucket", "n"])

    counted = known.select("lang", "text").mapInArrow(run, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counted = stored(counted) if len(languages) > PER_PASS else counted
    table = np.full((BUCKETS, max(1, len(languages))), 0.5)
    at = {language: i for i, language in enumerate(languages)}
    for first in range(0, len(languages), PER_PASS):
        part = languages[first : first + PER_PASS]
        found = counted.filter(F.col("lang").between(part[0], part[-1])).toPandas()  # at most PER_PASS * BUCKETS rows
        table[found["bucket"].to_numpy(np.int64), found["lang"].map(at).to_numpy(np.int64)] += found["n"].to_numpy(np.float64)
    return LetterModel(tuple(languages), np.log(table / table.sum(axis=0)))


def page_evidence(pages: DataFrame, *, url: str = "url", html: str = "html") -> list[Column]:
    """Columns ``text``, ``declared``, ``suffix``, ``host`` of raw web pages.

    The suffix is the last label of the host, with the first step of the path if
    that has two letters, as in ``com/fr``. Missing parts are null.
    """
    page = F.coalesce(F.col(html), F.lit(""))
    text = page
    for pattern in (r"(?is)<(script|style)\b.*?</\1\s*>", r"(?s)<!--.*?-->", r"(?s)<[^>]*>", r"&#?\w+;"):
        text = F.regexp_replace(text, pattern, " ")
    declared = F.lower(F.regexp_extract(page, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1))
    host = F.lower(F.regexp_extract(F.col(url), r"://([^/?#:]*)", 1))
    step = F.regexp_extract(F.col(url), r"://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1)
    suffix = F.concat(F.element_at(F.split(host, r"\."), -1), F.when(step != "", F.concat(F.lit("/"), F.lower(step))).otherwise(""))
    some = lambda c: F.when(c != "", c)
    return [text.alias("text"), some(declared).alias("declared"), some(suffix).alias("suffix"), some(host).alias("host")]


def _sums(rows: DataFrame, *by: str) -> DataFrame:
    """``by``, ``c`` (the sum of beliefs in each language) and ``n`` (rows): the same for all rows where ``by`` is empty."""
    each = rows.select(*by, F.posexplode("post").alias("i", "p")).groupBy(*by, "i").agg(F.sum("p").alias("p"), F.count(F.lit(1)).alias("n"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("i", "p"))), lambda x: x["p"])  # one entry a language
    return each.groupBy(*by).agg(in_order.alias("c"), F.max("n").alias("n"))


def _shares(rows: DataFrame, n: int) -> list[float]:
    """The share of each of ``n`` languages in the rows, none of them zero."""
    found = _sums(rows).first()
    c, rows_ = (found["c"], found["n"]) if found and found["n"] else ([0.0] * n, 0)
    return [(x + 1.0) / (rows_ + n) for x in c]


def _of_others(c: Column, post: Column) -> Column:
    return F.zip_with(c, post, lambda x, own: F.greatest(x - own, F.lit(0.0)))


def _gain(c: Column, count: Column, usual: Column) -> Column:
    """Log of how much commoner than usual each language is in ``count`` rows with beliefs ``c``."""
    return F.zip_with(c, usual, lambda x, p: F.log((x + VALUE_BELIEF * p) / ((count + VALUE_BELIEF) * p)))


def identify(rows: DataFrame, model: LetterModel) -> DataFrame:
    """``key``, ``language``, ``confidence`` and ``by_text`` for rows of ``key``, ``text``, ``declared``, ``suffix`` and ``host``.

    ``confidence`` is the posterior probability of ``language``; ``by_text`` is what
    the text alone suggests. Null evidence says nothing: a row with none at all
    gets the corpus's commonest language, a null or empty text only its other
    evidence. Ties go to the first language in order. Repeated rows and keys stay
    rows of their own. A model without languages gives nulls. An empty table gives
    no rows.

    A row's own text is left out of what its host, declaration and suffix say: one
    that no other row has says nothing. Values and hosts are summed before they move,
    and joined as tables, however many there are. A task holds the letters of
    ``PER_PASS`` languages; for more, the rows are written once for every so many.
    """
    n = len(model.languages)
    if not n:
        none = F.lit(None).cast("string")
        return rows.select("key", none.alias("language"), F.lit(None).cast("double").alias("confidence"), none.alias("by_text"))

    first = rows.select("key", "text", "declared", "suffix", "host")
    for at, block in enumerate(model.blocks(PER_PASS)):
        if at:
            first = stored(first)
        first = first.withColumn("ll", F.concat("ll", _letters(block)(F.col("text"))) if at else _letters(block)(F.col("text")))
    first = first.withColumn("most", F.array_max("ll")).withColumn("ll", F.transform("ll", lambda x: x - F.col("most"))).drop("text", "most")
    total = F.aggregate("ll", F.lit(0.0), lambda done, x: done + F.exp(x))
    believed = first.withColumn("total", total).withColumn("post", F.transform("ll", lambda x: F.exp(x) / F.col("total"))).drop("total")
    domain = F.array_join(F.slice(F.reverse(F.split("host", r"\.")), 1, 2), ".")
    known = stored(believed.withColumn("domain", domain))

    prior = F.lit(_shares(known, n))
    leaning = lambda c, count, on: F.zip_with(c, on, lambda x, p: (x + HOST_BELIEF * p) / (count + HOST_BELIEF))
    domains = _sums(known.filter("domain IS NOT NULL"), "domain")
    domains = domains.select("domain", leaning(F.col("c"), F.col("n"), prior).alias("p_domain"))
    hosts = _sums(known.filter("host IS NOT NULL"), "domain", "host").join(domains, "domain").drop("domain")

    joined = known.join(hosts.hint("rebalance"), "host", "left")
    host_prior = F.coalesce(leaning(_of_others(F.col("c"), F.col("post")), F.col("n") - 1, F.col("p_domain")), prior)
    score = F.zip_with("ll", host_prior, lambda x, p: x + F.log(p))
    for value in ("declared", "suffix"):
        having = known.filter(F.col(value).isNotNull())
        sums = _sums(having, value).select(value, F.col("c").alias(f"c_{value}"), F.col("n").alias(f"n_{value}"))
        joined = joined.join(sums.hint("rebalance"), value, "left")
        others = _of_others(F.col(f"c_{value}"), F.col("post"))
        gain = _gain(others, F.col(f"n_{value}") - 1, F.lit(_shares(having, n)))
        score = F.coalesce(F.zip_with(score, gain, lambda x, w: x + w), score)
    scored = joined.select("key", "ll", score.alias("score")).withColumn("top", F.array_max("score"))
    names = F.lit(list(model.languages))
    best = lambda a: names[F.array_position(a, F.array_max(a)).cast("int") - 1]
    return scored.select(
        "key",
        best(F.col("score")).alias("language"),
        (1 / F.aggregate("score", F.lit(0.0), lambda done, x: done + F.exp(x - F.col("top")))).alias("confidence"),
        best(F.col("ll")).alias("by_text"),
    )


def _letters(model: LetterModel) -> Callable[[Column], Column]:
    """The likelihood of a text in each of the model's languages."""

    @F.pandas_udf("array<double>")
    def letters(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([model.likelihood(t or "") for t in batch])

    return letters
