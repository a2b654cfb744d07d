"""The operators of this package on their whole tables, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeep.llm import (
    centroids,
    chat,
    language_id,
    line_dedup,
    mixing,
    near_duplicates,
    nearest,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    token_counts,
    url_filter,
)
from dimkeep.llm.shared import stored, table

Query = Callable[[SparkSession, str], DataFrame]

#: SQL that must give the same rows, for those queries that SQL can express.
ORACLES: dict[str, str] = {}


def op1_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest of every hundredth embedding."""
    return nearest.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document and every page.

    Letters are learnt from the documents outside the held-out fifth. A document's
    source stands for its host; it has neither markup nor address.
    """
    docs, pages = table(spark, folder, "documents"), table(spark, folder, "pages")
    held_out = quality_classifier.held_out("doc_id")
    model = language_id.fit(docs.filter(~held_out))
    none = F.lit(None).cast("string")
    key = lambda doc, page: F.struct(doc.cast("long").alias("doc_id"), page.cast("long").alias("page_id"))
    of_docs = docs.select(key(F.col("doc_id"), F.lit(None)).alias("key"), "text", none.alias("declared"), none.alias("suffix"), F.col("source").alias("host"))
    of_pages = pages.select(key(F.lit(None), F.col("page_id")).alias("key"), *language_id.page_evidence(pages))
    found = language_id.identify(of_docs.unionByName(of_pages), model)
    out = found.select("key.doc_id", "key.page_id", "language", "confidence", "by_text")
    return out.withColumn("held_out", held_out)


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near duplicates of every document."""
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


#: Code points of a formatted turn, and what its text says in the output.
_ESCAPED = r"replace(replace(replace({}, '\', '\\'), '<turn ', '\b'), '</turn>', '\e')"

ORACLES["op4_chat_formatting"] = f"""
WITH rows_ AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), written AS (
    SELECT *, '<turn ' || replace({_ESCAPED.format("role")}, chr(10), '\\n') || '>' || chr(10) AS head,
           head || {_ESCAPED.format("text")} || '</turn>' || chr(10) AS segment,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n
    FROM rows_
), sized AS (
    SELECT *, length(segment) AS size,
           sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY n) - length(segment) + length(head) AS context,
           max(n) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS last
    FROM written
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS n_examples,
       CAST(coalesce(sum(context) FILTER (role = 'assistant'), 0) AS BIGINT) AS context_chars,
       sha256(coalesce(string_agg(CASE WHEN n < last THEN segment ELSE head END, '' ORDER BY n) FILTER (n <= last), '')) AS last_context_sha256
FROM sized GROUP BY conv_id
"""


def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations formatted, and digests of what is read back from the output."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    formatted = stored(chat.format_conversations(turns.unionByName(added)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    replies = chat.examples_of(formatted).select("conv_id", "turn", "start", chat.unescape(F.col("reply")).alias("reply"))
    under_mask = replies.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "reply"))), lambda r: r["reply"]), "").alias("said"),
        F.count(F.lit(1)).alias("n_examples"),
        F.sum("start").alias("context_chars"),
    )
    last = F.coalesce(F.try_element_at(F.col("examples.start"), F.lit(-1)), F.lit(0)).cast("int")
    whole = formatted.select(
        "conv_id",
        chat.turns_of(F.col("text")).alias("turns"),
        F.length("text").cast("long").alias("formatted_chars"),
        F.sha2(F.substring("text", F.lit(1), last), 256).alias("last_context_sha256"),  # all other contexts begin it
    )
    under_mask = under_mask.withColumnRenamed("conv_id", "_conv")
    loss = F.coalesce("said", F.lit(""))
    return whole.join(under_mask, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
        F.coalesce("n_examples", F.lit(0)).alias("n_examples"),
        F.coalesce("context_chars", F.lit(0)).alias("context_chars"),
        "last_context_sha256",
    )


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learnt from the labelled rows outside the held-out fifth."""
    measured = stored(quality_classifier.statistics(table(spark, folder, "documents")))
    model = quality_classifier.fit(measured.filter(~quality_classifier.held_out("doc_id")), table(spark, folder, "labels"))
    scored = measured.select(
        "doc_id",
        quality_classifier.held_out("doc_id").alias("held_out"),
        quality_classifier.score(model, F.col("statistics")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document, and whether the rules' votes speak for it."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    measured = stored(quality_rules.with_measures(docs, "text", "m").drop("text"))
    model = quality_rules.learn(measured, "m")
    return measured.select(
        "doc_id",
        *(F.col("m")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        quality_rules.base_failed("m").alias("base_failed"),
        quality_rules.kept(model, "m").alias("kept"),
        quality_rules.posterior(model, "m").alias("good"),
    )


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every document when sources are mixed by the square roots of their sizes."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    mixed = mixing.mix(docs, mixing.target_weights(docs, power=0.5))
    return mixed.select("doc_id", "source", "mix.*")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 4,096 tokens."""
    packed = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, and where to cut it for 1,024 tokens."""
    counted = token_counts.count_prefixes(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), budgets=(1024,))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "n_chars", "cut_1024")


# The rules, and some of the sites that are not wanted (with all below them).
_RULES = (
    url_filter.Rule("net", "/", allow=False),
    url_filter.Rule("example.net", "/en/", allow=True),
    url_filter.Rule("example.com", "/de/", allow=False),
    url_filter.Rule("org", "/fr/", allow=True),
)
_SITES = tuple(
    f"{name}.example.{end}"
    for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for end in ("com", "net", "org")
)

_HOST = "translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op10_url_filter"] = f"""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), address AS (
    SELECT page_id, {_HOST} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), hosts AS (SELECT DISTINCT host FROM address WHERE host <> ''),
rules(h, p, verdict) AS (VALUES {", ".join(f"('{r.host}', '{r.path}', '{'allow' if r.allow else 'block'}')" for r in _RULES)}),
sites AS (
    SELECT site FROM (VALUES {", ".join(f"('{s}')" for s in _SITES)}) AS _(site)
    UNION SELECT 'ads.' || host FROM hosts WHERE length(host) < 250
    UNION SELECT host FROM hosts WHERE length(host) < 250 AND md5(host) < '1'
), ends AS (
    SELECT host, string_split(host, '.') AS parts, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM hosts
), marked AS (
    SELECT DISTINCT host FROM ends JOIN sites ON site = array_to_string(parts[i:], '.')
), fit AS (
    SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
    FROM address LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    GROUP BY page_id, host, path
), told AS (SELECT fit.*, marked.host IS NOT NULL AS listed FROM fit LEFT JOIN marked USING (host))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed FROM told
"""


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each page's address is allowed, by the rules and else by the listed sites.

    The list grows with the pages: of every host a site for advertisements, which few pages
    are on, and of every sixteenth the host itself.
    """
    pages = table(spark, folder, "pages")
    hosts = url_filter.with_address(pages.select("url"), "url", "host", "path").select("host").distinct().filter("host <> '' AND length(host) < 250")
    own = hosts.select(F.explode(F.array_compact(F.array(F.concat(F.lit("ads."), "host"), F.when(F.md5("host") < "1", F.col("host"))))).alias("site"))
    return url_filter.judge(pages, _RULES, spark.createDataFrame([(s,) for s in _SITES], "site string").union(own))


def _rounds(count: int, before: str) -> str:
    """SQL of so many rounds of assignment and new means, from the centroids ``c0``, and of the last assignment."""
    out = before
    for i in range(count + 1):
        out += f""", d{i} AS (
    SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS best FROM (
        SELECT r, vec_id, kept.v, c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(kept.v, c{i}.v)])::BIGINT AS d FROM kept, c{i}
    ) GROUP BY r
)"""
        if i < count:
            out += f""", s{i} AS (
    SELECT best.c AS c, i, sum(x) AS s, count(*) AS n FROM (SELECT best, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM d{i}) GROUP BY ALL
), c{i + 1} AS (
    SELECT c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
        SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{i} GROUP BY c
    ) AS m USING (c)
)"""
    return out


ORACLES["op11_centroids"] = _rounds(
    3,
    """
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = 64
), c0 AS (
    SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) AS c, v
    FROM (SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT 16)
)""",
) + """
SELECT vec_id, best.c AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM d3 JOIN c3 ON c3.c = best.c
"""


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Sixteen clusters of all embeddings after three rounds."""
    return centroids.cluster(table(spark, folder, "embeddings"))


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    """The words of a document, for one id in ten periodic from some word on."""
    mark = zlib.crc32(str(doc_id).encode())
    if doc_id is None or mark % 10 or not words:
        return words
    n, g = len(words), mark // 10
    begin = g % n
    period = 1 + (n - begin) // (3 + g % 8)
    return words[:begin] + [words[begin + i % period] for i in range(n - begin)]


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The periodic runs of words in every document, the strongest of them, and the text without their repeats."""
    found = periodic_runs.periodic_runs(table(spark, folder, "documents"), prepare=planted).select("doc_id", "periodic.*")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", periodic_runs.strongest("runs"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


ORACLES["op13_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT any_value(k.doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (f.first < k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.first IS NULL OR f.first = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY r
"""


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every document, those that an earlier document holds, and a digest of the rest."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.digests(line_dedup.with_bitmaps(docs, line_dedup.keep_bitmaps(docs)))


def queries() -> dict[str, Query]:
    return {n: q for n, q in globals().items() if n.startswith("op") and n[2].isdigit()}
