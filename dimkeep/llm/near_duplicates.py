"""Classes of near-duplicate documents by banded DartMinHash signatures.

Texts of the same words are first folded into one; it goes by a digest of its words
in order, as do links and components, and ids come back only where classes are named.
Signatures are cut into bands; texts that agree in a band are candidates. A candidate pair is a link if the Jaccard similarity of its shingle
sets, computed exactly on the whole texts, reaches the threshold. Classes are the
connected components of the links.

Within a bucket not all pairs are looked at. Every document is first compared
with one smallest partner; only pairs that are still in different components are
compared after that, in blocks of bounded size. Pairs inside a component can add
nothing to the classes. Within a block every other pair is compared exactly: a text's
shingles are looked up in the lists of who holds each, which gives its overlap with
all others of the block at once.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimkeep.llm.components import components
from dimkeep.llm.dart_minhash import band_keys, shingles, signature, similarity, word_hashes
from dimkeep.llm.shared import free_name, stored

#: Bands and coordinates in each: a pair at similarity 0.8 meets in a band but for 5 in 10**8.
BANDS, ROWS = 32, 4
#: Members of a bucket that one block holds at most, on average.
BLOCK = 500
#: Holders of shingles that are counted together.
_TOGETHER = 1 << 22


def _text_key(text: Column) -> Column:
    """Names a text, as rows that share an id may hold several."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def sketch(docs: DataFrame, *, doc_id: str, text: str, size: int, weighted: bool) -> DataFrame:
    """(doc_id, key, node, bands) of each row; node is a digest of the words in order, bands is null without a word."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, bands = [], []
            for value in batch.column(2).to_pylist():
                words = word_hashes(value or "")
                digests.append(xxhash.xxh3_128_digest(words.tobytes()))
                elements, counts = shingles(words, size)
                if len(elements):
                    sig = signature(elements, counts if weighted else np.ones(len(elements)), BANDS * ROWS)
                    bands.append(band_keys(sig, ROWS))
                else:
                    bands.append(None)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "key", "node", "bands"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), _text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, key binary, node binary, bands array<bigint>")


def _linked_pairs(pairs: DataFrame, texts: DataFrame, size: int, threshold: float, weighted: bool) -> DataFrame:
    """Those pairs (a, b) whose texts reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last = None, None
        for batch in batches:
            keep = []
            b_keys = batch.column(1).to_pylist()
            for a_text, b_key, b_text in zip(batch.column(2).to_pylist(), b_keys, batch.column(3).to_pylist()):
                if b_key != last_key:  # many pairs share their smaller side
                    last_key, last = b_key, shingles(word_hashes(b_text or ""), size)
                one = shingles(word_hashes(a_text or ""), size)
                keep.append(similarity(one[0], last[0], *((one[1], last[1]) if weighted else ())) >= threshold)
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "_a", "_b")
    return both.mapInArrow(run, "a binary, b binary")


class _Overlaps:
    """The shingles of some texts of a block, and for each shingle those that hold it."""

    def __init__(self, members: np.ndarray, sets: list[tuple[np.ndarray, np.ndarray]], number: int, weighted: bool):
        lengths = np.array([len(elements) for elements, _ in sets])
        self.number = number
        self.ends = dict(zip(members.tolist(), np.cumsum(lengths).tolist()))
        self.lengths = dict(zip(members.tolist(), lengths.tolist()))
        self.codes = np.unique(np.concatenate([elements for elements, _ in sets]), return_inverse=True)[1].astype(np.int32)
        self.owners = np.repeat(members.astype(np.int32), lengths)
        self.weights = np.concatenate([counts for _, counts in sets]).astype(np.float64) if weighted else np.ones(len(self.codes))
        self.totals = np.bincount(self.owners, self.weights, minlength=number)
        self.by_code = np.argsort(self.codes, kind="stable").astype(np.int32)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(self.codes))])

    def with_all(self, i: int) -> np.ndarray:
        """Weight of the shingles that member ``i`` shares with each of the block."""
        mine = np.arange(self.ends[i] - self.lengths[i], self.ends[i])
        begins = self.starts[self.codes[mine]]
        holders = self.starts[self.codes[mine] + 1] - begins
        shared = np.zeros(self.number)
        cuts = np.searchsorted(np.cumsum(holders), np.arange(_TOGETHER, holders.sum() + _TOGETHER, _TOGETHER), side="left") + 1
        for low, high in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
            times = holders[low:high]
            place = np.arange(times.sum()) + np.repeat(begins[low:high] - (np.cumsum(times) - times), times)
            entries = self.by_code[place]
            least = np.minimum(self.weights[entries], np.repeat(self.weights[mine[low:high]], times))
            shared += np.bincount(self.owners[entries], least, minlength=self.number)
        return shared


def _links_of_block(ids, labels, sides, band: int, bands: np.ndarray, texts, size: int, threshold: float, weighted: bool):
    """Links between the components of one block; at most one fewer than it has components."""
    pairs: dict[int, np.ndarray] = {}
    for i in range(len(ids) - 1):
        others = i + 1 + np.flatnonzero((labels[i + 1 :] != labels[i]) & ((sides[i + 1 :] | sides[i]) == 1))
        # a pair that meets in several bands is compared in the first of them
        others = others[(bands[others] == bands[i]).argmax(axis=1) == band]
        if len(others):
            pairs[i] = others
    if not pairs:
        return
    members = np.unique(np.concatenate([np.array(list(pairs)), *pairs.values()]))
    overlaps = _Overlaps(members, [shingles(word_hashes(texts[i] or ""), size) for i in members], len(ids), weighted)
    group = labels.copy()
    for i, others in pairs.items():
        others = others[group[others] != group[i]]
        if not len(others):
            continue
        shared = overlaps.with_all(i)[others]
        for j in others[shared / (overlaps.totals[i] + overlaps.totals[others] - shared) >= threshold]:
            if group[i] != group[j]:
                group[group == group[j]] = group[i]
                yield ids[i], ids[j]


def _links_in_blocks(rows: DataFrame, size: int, threshold: float, weighted: bool) -> DataFrame:
    """Links between components inside each block of (bucket, i, j).

    A task gets whole blocks, one after the other; most are a few rows, so they
    are cut from the sorted rows without a frame for each.
    """
    order = ("bucket", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in itertools.chain(batches, (None,)):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                rest = table if rest is None else pa.concat_tables([rest, table])
            if rest is None or not rest.num_rows:
                continue
            keys = np.stack([rest.column(c).to_numpy() for c in order])
            ends = np.append(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, rest.num_rows)
            if batch is not None:
                ends = ends[:-1]  # the last block may go on in the next batch
            if not len(ends):
                continue
            whole = rest.slice(0, ends[-1])
            rest = rest.slice(ends[-1])
            labels = np.unique(whole.column("label").to_numpy(zero_copy_only=False), return_inverse=True)[1]
            sides, band = whole.column("side").to_numpy(), whole.column("band").to_numpy()
            ids, texts = whole.column("node").to_pylist(), whole.column("text").to_pylist()
            bands = whole.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            out = []
            for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
                part = slice(begin, end)
                out += _links_of_block(ids[part], labels[part], sides[part], int(band[begin]), bands[part], texts[part], size, threshold, weighted)
            if out:
                yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*out)], names=["a", "b"])

    dealt = rows.select(*order, "band", "node", "label", "side", "bands", "text").repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "a binary, b binary")


def _classes(docs: DataFrame, *, doc_id: str, text: str, size: int, threshold: float, weighted: bool) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows, and for each node with an id its class: (node, label, class_id)."""
    sketches = stored(sketch(docs, doc_id=doc_id, text=text, size=size, weighted=weighted))
    # equal nodes have equal bands
    folded = sketches.filter("doc_id IS NOT NULL").groupBy("node").agg(
        F.min(F.struct("doc_id", "key")).alias("row"), F.first("bands").alias("bands")
    )
    representatives = stored(folded)
    spread = representatives.filter("bands IS NOT NULL").select("node", F.posexplode("bands").alias("band", "bucket"))
    full = spread.groupBy("bucket").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    members = stored(spread.join(full.hint("rebalance"), "bucket"))

    # each text with the smallest partner of its buckets
    first = members.filter("node <> b").groupBy(F.col("node").alias("a")).agg(F.min("b").alias("b"))
    candidates = members.select("node").distinct()
    wanted = representatives.join(candidates, "node", "left_semi").select("row.doc_id", "row.key", "node")
    texts = docs.select(F.col(doc_id).alias("doc_id"), _text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    few = stored(texts.join(wanted, ["doc_id", "key"]).groupBy("node").agg(F.min("text").alias("text")))
    links = stored(_linked_pairs(first, few, size, threshold, weighted))
    labels = components(links)

    # what is still apart within a bucket
    labelled = members.join(labels.hint("rebalance"), "node", "left").select(
        "bucket", "band", "node", F.coalesce("label", "node").alias("label")
    )
    per_label = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    apart = (
        per_label.groupBy("bucket")
        .agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("labels"))
        .filter("labels > 1")
        .select("bucket", F.col("most.label").alias("main"), F.col("most.n").alias("in_main"), (F.col("all") - F.col("most.n")).alias("others"))
    )
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / BLOCK)).cast("int")
    placed = labelled.join(apart.hint("rebalance"), "bucket").select(
        "bucket",
        "band",
        "node",
        "label",
        (F.col("label") != F.col("main")).cast("int").alias("side"),
        blocks("in_main").alias("_mains"),
        blocks("others").alias("_others"),
    )
    own = F.when(F.col("side") == 0, F.pmod(F.xxhash64("node"), F.col("_mains"))).otherwise(F.pmod(F.xxhash64("node"), F.col("_others"))).cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    place = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    # the main component's blocks (numbered below 0) meet each block of others, and those meet one another
    places = F.when(F.col("side") == 0, F.transform(upto("_others"), lambda j: place(-1 - own, j))).otherwise(
        F.concat(
            F.transform(upto("_mains"), lambda i: place(-1 - i, own)),
            F.transform(upto("_others"), lambda j: place(F.least(own, j), F.greatest(own, j))),
        )
    )
    dealt = placed.select("bucket", "band", "node", "label", "side", F.explode(places).alias("_at")).select(
        "bucket", "band", "node", "label", "side", "_at.i", "_at.j"
    )
    carried = few.join(representatives.select("node", "bands"), "node")
    more = stored(_links_in_blocks(dealt.join(carried, "node"), size, threshold, weighted))
    final = labels if more.isEmpty() else components(links.union(more))

    named = representatives.select("node", "row.doc_id").join(final.hint("rebalance"), "node", "left")
    named = named.select("node", "doc_id", F.coalesce("label", "node").alias("label"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    return sketches, named.select("node", "label").join(smallest.hint("rebalance"), "label")


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    weighted: bool = False,
) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id`` and ``class_id``, the smallest id of its class.

    Two texts are linked if the Jaccard similarity of their sets of ``size``
    neighbouring words is at least ``threshold``; ``weighted`` takes how often a
    shingle occurs as its weight. Words are what white space divides, in lower
    case. Texts with the same words are copies, also those without a word (a
    null text is one), and a text of fewer than ``size`` words has one shingle.

    A row without an id is compared with nothing; its class is null. Repeated
    rows fall into one class. Rows that share an id but not a text are compared each
    by its own text, and each has the class of its text. Other columns are not looked
    at. An empty table gives no rows.
    """
    sketches, classes = _classes(docs, doc_id=doc_id, text=text, size=size, threshold=threshold, weighted=weighted)
    rows = sketches.filter("doc_id IS NOT NULL").select("doc_id", "node")
    named = rows.join(classes.hint("rebalance"), "node").select("doc_id", "class_id")
    return named.union(sketches.filter("doc_id IS NULL").select("doc_id", F.col("doc_id").alias("class_id")))


def one_of_each_class(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8, weighted: bool = False
) -> DataFrame:
    """``docs`` with one row of each class, in the same columns: that of the smallest id.

    Where that id has several texts in the class, one of them stays, and of repeated
    rows one. Texts of one id that are not alike are in different classes, so each class
    keeps a text. Rows without an id stay.
    """
    sketches, classes = _classes(docs, doc_id=doc_id, text=text, size=size, threshold=threshold, weighted=weighted)
    rows = sketches.filter("doc_id IS NOT NULL").select("doc_id", "key", "node").join(classes.select("node", "label").hint("rebalance"), "node")
    stays = rows.groupBy("label").agg(F.min(F.struct("doc_id", "key")).alias("row")).select("row.*")
    key, turn = free_name(docs, "_key"), free_name(docs, "_turn")
    keyed = docs.withColumn(key, _text_key(F.col(text)))
    kept = keyed.join(stays.select(F.col("doc_id").alias(doc_id), F.col("key").alias(key)), [doc_id, key], "left_semi")
    kept = kept.withColumn(turn, F.row_number().over(Window.partitionBy(doc_id, key).orderBy(text))).filter(F.col(turn) == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.filter(F.col(doc_id).isNull()))
