"""Pack token sequences into windows by multiway differencing (Karmarkar and Karp).

Documents are packed in groups of neighbours within a partition. A document's
whole windows stand alone; the rests are the numbers to be divided. Differencing
starts with one partial partition for each number and merges the two of the
largest spread, the fullest part of one with the emptiest of the other, until one
partition of near-equal parts is left. If a part is above the capacity, the number
of windows rises by one and differencing starts again.

The last tokens of room are then closed by cutting: the emptiest windows are
dissolved into the others. What is left goes on to the next group, and at the end
of a partition into windows whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeep.llm.word_ids import REMEMBERED, word_ids

#: Tokens, in windows, that one group may hold; differencing is done within a group.
GROUP_WINDOWS = 128
#: Texts encoded together.
_TEXTS = 256

Piece = tuple[int, int, int]  # document within the partition, first token, number of tokens


def difference(sizes: list[int], parts: int) -> list[tuple[int, list[int]]]:
    """Divide numbers into at most ``parts`` groups of near-equal sums: (sum, positions) of each group."""
    if not sizes:
        return []
    # a partial partition: its non-empty parts, largest first; a part is (sum, tree of positions)
    heap = [(-size, at, [(size, at)]) for at, size in enumerate(sizes)]
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        shared = max(0, len(a) + len(b) - parts)
        # the emptiest of one beside the fullest of the other; parts meet only where there is no free one
        merged = a[: len(a) - shared] + b[: len(b) - shared]
        merged += [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a[len(a) - shared :], reversed(b[len(b) - shared :]))]
        merged.sort(key=lambda part: -part[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == parts else 0)
        heapq.heappush(heap, (-spread, turn, merged))
        turn += 1
    return [(total, _positions(tree)) for total, tree in heap[0][2]]


def _positions(tree) -> list[int]:
    out, open_ = [], [tree]
    while open_:
        node = open_.pop()
        if isinstance(node, tuple):
            open_.extend(node)
        else:
            out.append(node)
    return sorted(out)


def windows_of(sizes: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """Near-equal windows; their number rises while one exceeds the capacity."""
    parts = max(1, -(-sum(sizes) // capacity))
    while True:
        found = difference(sizes, parts)
        if not found or max(total for total, _ in found) <= capacity:
            return found
        parts += 1


def _split(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The first ``at`` tokens of some pieces, and the rest."""
    head, used = [], 0
    for i, (doc, start, length) in enumerate(pieces):
        if used + length > at:
            cut = at - used
            rest = [(doc, start + cut, length - cut), *pieces[i + 1 :]]
            return (head + [(doc, start, cut)] if cut else head), rest
        head.append((doc, start, length))
        used += length
    return head, []


def pack_group(items: list[Piece], capacity: int, last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows of some pieces, each shorter than the capacity, and what goes on to the next group.

    The last group leaves nothing: its rest is cut into windows of powers of two
    (and, where the capacity is none, of the capacity first).
    """
    windows = [(total, [items[i] for i in found]) for total, found in windows_of([p[2] for p in items], capacity)]
    windows.sort(key=lambda w: -w[0])
    room = sum(capacity - total for total, _ in windows)
    spare: list[Piece] = []
    while windows and room > sum(p[2] for p in spare):
        total, pieces = windows.pop()
        room -= capacity - total
        spare += pieces
    full = []
    for total, pieces in windows:
        head, spare = _split(spare, capacity - total)
        full.append(pieces + head)
    while sum(p[2] for p in spare) >= capacity:
        head, spare = _split(spare, capacity)
        full.append(head)
    if last:
        while left := sum(p[2] for p in spare):
            head, spare = _split(spare, 1 << (left.bit_length() - 1))
            full.append(head)
    return full, spare


def _packed(sizes: Iterable[int], capacity: int) -> Iterator[tuple[int, list[list[Piece]]]]:
    """Windows as documents arrive, and the first document that later windows may still use."""
    items: list[Piece] = []
    held = 0
    for doc, size in enumerate(sizes):
        whole = size // capacity * capacity
        yield_now = [[(doc, start, capacity)] for start in range(0, whole, capacity)]
        if size > whole:
            items.append((doc, whole, size - whole))
            held += size - whole
        if held >= GROUP_WINDOWS * capacity:
            full, items = pack_group(items, capacity, last=False)
            held = sum(p[2] for p in items)
            yield_now += full
        yield min((p[0] for p in items), default=doc + 1), yield_now
    full, _ = pack_group(items, capacity, last=True)
    yield -1, full


def pack(
    docs: DataFrame,
    path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 4096,
    end_id: int | None = 2,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """A row for each piece of a document: ``doc_id``, ``start`` and ``length`` in the document's ids,
    ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset`` in its sequence.

    A document's ids are those of the tokenizers file at ``path``, then ``end_id``.
    Each id lies in exactly one piece, and a sequence has no gap. Sequences hold
    ``capacity`` ids, but for the last of a partition, which are powers of two.
    A worker remembers the ids of up to twice ``remembered`` words; fewer take less memory and more time.

    A null text counts as empty: it has the end id only, and without one no
    row. Null ids are kept; repeated rows are packed as documents of their own.
    Other columns are not looked at. An empty table gives no rows. Documents stay
    in their partition and a task holds one group at a time, so nothing is
    shuffled; a task that runs again makes the same sequences.
    """
    capacity = int(capacity)
    if capacity < 1:
        raise ValueError("a sequence holds one token at least")
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            *(T.StructField(c, T.LongType()) for c in ("start", "length")),
            T.StructField("ids", T.BinaryType()),
            *(T.StructField(c, T.LongType()) for c in ("doc_tokens", "sequence_id", "offset")),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path, remembered).encode
        end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        kept: dict[int, tuple[object, bytes]] = {}
        id_arrow = None

        def sizes() -> Iterator[int]:
            nonlocal id_arrow
            doc = 0
            for batch in batches:
                id_arrow = batch.schema.field(0).type
                for at in range(0, batch.num_rows, _TEXTS):
                    part = batch.slice(at, _TEXTS)
                    texts = [t or "" for t in part.column(1).to_pylist()]
                    for key, ids in zip(part.column(0).to_pylist(), encode(texts)):
                        kept[doc] = (key, ids + end)
                        yield len(kept[doc][1]) // 4
                        doc += 1

        sequence = TaskContext.get().partitionId() << 40
        oldest = 0
        for needed, windows in _packed(sizes(), capacity):
            rows = []
            for window in windows:
                offset = 0
                for doc, start, length in window:
                    key, ids = kept[doc]
                    rows.append((key, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4, sequence, offset))
                    offset += length
                sequence += 1
            while 0 <= oldest < needed:
                kept.pop(oldest, None)
                oldest += 1
            if rows:
                columns = list(zip(*rows))
                kinds = [id_arrow, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
