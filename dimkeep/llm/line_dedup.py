"""Exact line deduplication over documents: sorted line hashes in, keep bitmaps out.

A line is known by a 128-bit hash of its key. Lines are dealt to ranges of (hash,
document, position) and sorted so within a range; reading a range in order, the first
document of a hash is the one that keeps the line, and every later document loses it.
The document is part of the range's key, so a line that stands in a third of all
documents fills several ranges. Such a line runs over a border between ranges: each
range says which hash ends it and with which first document, one row a range, and
the rows of a range's first hash are judged by those.

No text moves for this. What comes back is a compressed bitmap of the kept lines for
each document that loses any, to be joined with the text where the text is wanted.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeep.llm.shared import free_name, stored

#: Code points that a key has at least to be compared.
LEAST = 10
_SPACE = b" \t\n\x0b\x0c\r"


def _key(line: bytes) -> bytes:
    """A line of UTF-8 as it is compared: without blanks at both ends, A-Z in lower case (other letters as they are)."""
    return line.strip(_SPACE).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _text_key(text: Column) -> Column:
    """Names the text of a row, as rows that share an id may hold several."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def line_hashes(docs: DataFrame, *, doc_id: str, text: str, least: int) -> DataFrame:
    """(hash, doc, text_key, position) of every line that is compared."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, rows, positions = [], [], []
            for row, value in enumerate(batch.column(2)):
                for position, line in enumerate((value.as_py() or "").encode().split(b"\n")):
                    key = _key(line)
                    if _long_enough(key, least):
                        hashes.append(xxhash.xxh3_128_digest(key))
                        rows.append(row)
                        positions.append(position)
            of = pa.array(rows, pa.int64())
            columns = [pa.array(hashes, pa.binary()), batch.column(0).take(of), batch.column(1).take(of), pa.array(positions, pa.int32())]
            yield pa.record_batch(columns, names=["hash", "doc", "text_key", "position"])

    rows = docs.select(F.col(doc_id).alias("doc"), _text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"hash binary, doc {kind}, text_key binary, position int")


def _streamed(lines: DataFrame) -> DataFrame:
    """What one pass over the sorted ranges finds.

    Rows with a position are lines of a document that is not the first of its hash in
    the range, and all lines of the range's first hash; ``owner`` is that first document.
    A row without a position tells a range's last hash and that hash's first document.
    """
    kind = lines.schema["doc"].dataType.simpleString()
    names = ["hash", "doc", "text_key", "position", "owner", "open"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = owner = None
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes, docs = batch.column(0), batch.column(1)
            fresh = np.ones(batch.num_rows, bool)
            fresh[1:] = pc.not_equal(hashes.slice(1), hashes.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            if last is None:
                first = hashes[0]
            elif hashes[0].equals(last):
                fresh[0] = False
            # where each row's hash began; -1: in an earlier batch
            begin = np.maximum.accumulate(np.where(fresh, np.arange(batch.num_rows), -1))
            known = docs.take(pa.array(np.maximum(begin, 0)))
            if (begin < 0).any():
                earlier = pa.array([owner] * int((begin < 0).sum()), docs.type)
                known = pa.concat_arrays([earlier, known.slice(len(earlier))])
            # nulls are one document, the last
            differ = pc.fill_null(pc.not_equal(docs, known), pc.xor(docs.is_null(), known.is_null()))
            is_open = pc.equal(hashes, first)
            out = pa.record_batch([hashes, docs, batch.column(2), batch.column(3), known, is_open], names=names)
            yield out.filter(pc.or_(differ, is_open))
            last, owner = hashes[batch.num_rows - 1], known[batch.num_rows - 1].as_py()
        if last is not None:
            types = [pa.binary(), docs.type, pa.binary(), pa.int32(), docs.type, pa.bool_()]
            yield pa.record_batch([pa.array([v], t) for v, t in zip((last.as_py(), None, None, None, owner, False), types)], names=names)

    return lines.mapInArrow(run, f"hash binary, doc {kind}, text_key binary, position int, owner {kind}, open boolean")


def dropped_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(doc, text_key, position) of every line that an earlier document holds; repeated rows may repeat."""
    order = [F.col("hash"), F.col("doc").asc_nulls_last(), F.col("position"), F.col("text_key")]
    lines = line_hashes(docs, doc_id=doc_id, text=text, least=least)
    seen = stored(_streamed(lines.repartitionByRange(*order).sortWithinPartitions(*order)))
    # a row for each range at most
    of_ranges = seen.filter("position IS NULL").groupBy("hash").agg(
        F.min("owner").alias("_owner")  # a null owner is the last, and passed over where another is known
    )
    rows = seen.filter("position IS NOT NULL")
    settled = rows.filter("NOT open").select("doc", "text_key", "position")
    at_border = rows.filter("open").join(F.broadcast(of_ranges), "hash", "left")
    return settled.union(at_border.filter(~F.col("doc").eqNullSafe(F.least("_owner", "owner"))).select("doc", "text_key", "position"))


def pack_bits(positions: np.ndarray) -> bytes:
    """A compressed bitmap of kept lines up to the last dropped one: bit 1 stays, and so does all that follows."""
    bits = np.ones(int(positions.max()) + 1, np.uint8)
    bits[positions] = 0
    return zlib.compress(np.packbits(bits).tobytes(), 1) + int(len(bits)).to_bytes(8, "little")


def kept_lines(bitmap: bytes, lines: int) -> np.ndarray:
    """Which of so many lines a bitmap keeps."""
    length = int.from_bytes(bitmap[-8:], "little")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap[:-8]), np.uint8), count=length).astype(bool)
    return np.append(bits, np.ones(max(0, lines - length), bool))[:lines]


def keep_bitmaps(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``doc``, ``text_key``, ``n_dropped`` and ``bitmap`` of every document text that loses a line.

    Texts are split at line feeds. A line is compared by its key: without blanks, tabs
    and line ends at both ends, A-Z in lower case. A key of ``least`` code points or
    more that stands in two documents or more stays in the one of smallest id and goes
    from all others; there, and if its key is shorter, all its lines stay.

    Rows that share an id are one document, so repeated rows lose nothing to one
    another; ``text_key`` tells their texts apart. Rows without an id are one document
    that comes after all others. Null and empty texts have no line that is compared.
    Other columns are not looked at; an empty table gives no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    lost = dropped_lines(docs, doc_id=doc_id, text=text, least=least)
    grouped = lost.groupBy("doc", "text_key").agg(F.collect_set("position").alias("positions"))  # of one text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.array(v, np.int64) for v in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array([len(v) for v in lists], pa.int64()), pa.array([pack_bits(v) for v in lists], pa.binary())]
            yield pa.record_batch(columns, names=["doc", "text_key", "n_dropped", "bitmap"])

    return grouped.mapInArrow(run, f"doc {kind}, text_key binary, n_dropped long, bitmap binary")


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, doc_id: str = "doc_id", text: str = "text", out: str = "bitmap") -> DataFrame:
    """``docs`` with a column ``out``: the bitmap of a row's text, null where all its lines stay."""
    key, doc, named = (free_name(docs, n) for n in ("_text_key", "_doc", "_bitmap"))
    renamed = bitmaps.select(F.col("doc").alias(doc), F.col("text_key").alias(key), F.col("bitmap").alias(named))
    rows = docs.withColumn(key + "_", _text_key(F.col(text)))
    joined = rows.join(renamed, F.col(doc_id).eqNullSafe(F.col(doc)) & (F.col(key + "_") == F.col(key)), "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns if c != out], F.col(named).alias(out))


def kept_text(text: str | None, bitmap: bytes | None) -> str:
    """The lines that stay, joined by line feeds."""
    lines = (text or "").split("\n")
    if bitmap is None:
        return "\n".join(lines)
    return "\n".join(line for line, stays in zip(lines, kept_lines(bitmap, len(lines)).tolist()) if stays)


def without_repeated_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with every text cut to the lines that stay (see ``keep_bitmaps``); a null text becomes empty."""
    name = free_name(docs, "_bitmap")
    marked = with_bitmaps(docs, keep_bitmaps(docs, doc_id=doc_id, text=text, least=least), doc_id=doc_id, text=text, out=name)
    cut = F.pandas_udf(lambda t, b: t.combine(b, kept_text), "string")
    return marked.withColumn(text, cut(F.col(text), F.col(name))).select(*[F.col(f"`{c}`") for c in docs.columns])


def digests(marked: DataFrame, *, doc_id: str = "doc_id", text: str = "text", bitmap: str = "bitmap") -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped`` and ``kept_sha256`` of texts beside their bitmaps."""
    kind = marked.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, digest = [], [], []
            for text_, bitmap_ in zip(batch.column(1), batch.column(2)):
                value, bits = text_.as_py() or "", bitmap_.as_py()
                n_lines.append(value.count("\n") + 1)
                n_dropped.append(0 if bits is None else int((~kept_lines(bits, n_lines[-1])).sum()))
                digest.append(hashlib.sha256((value if bits is None else kept_text(value, bits)).encode()).hexdigest())
            columns = [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(digest, pa.string())]
            yield pa.record_batch(columns, names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    rows = marked.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(bitmap).alias("bitmap"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_lines long, n_dropped long, kept_sha256 string")
