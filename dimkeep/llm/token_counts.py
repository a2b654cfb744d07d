"""Exact token counts at every prefix of a text, by dynamic programming over the text's bytes.

In byte-pair encoding the tokens of a text depend on neighbours only: a token
sequence is *the* encoding of its bytes exactly if each two neighbouring tokens
are the encoding of their joined bytes. So the last token of each prefix is found
from the last tokens of shorter prefixes, and with it the count:

    count[i] = count[i - len(t)] + 1, t the token that ends at i and fits last[i - len(t)]

The table holds the count of ``encode(text[:i])`` for every number ``i`` of code
points. How many tokens a text has, where to cut it for a budget and whether a
prefix fits are then look-ups.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# White space of the vocabulary's split pattern (Unicode White_Space).
_SPACE = "\t-\r \x85\xa0  -     　"
# The split pattern inside a run without white space, for characters below U+0250.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_HEAD = re.compile(f"[{_SPACE}]*")
_PIECE = re.compile(
    "|".join(_CONTRACTIONS)
    + f"| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACE}{_LETTERS}{_NUMBERS}]+"
)
_WIDE = re.compile("[ɐ-\U0010ffff]")

#: Chunks and token pairs that a Python worker remembers, in each of two generations.
REMEMBERED = 300_000
#: Longer chunks are worked out each time.
_REMEMBERED_LENGTH = 64
#: Pieces up to this length, are also kept by themselves.
_SHORT = 12


class PrefixCounter:
    """Prefix tables for one byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        of_char = {c: b for b, c in enumerate(_byte_alphabet())}
        as_bytes = lambda text: bytes(of_char[c] for c in text)
        model = described["model"]
        special = {t["content"] for t in described["added_tokens"]}
        self._ids = {as_bytes(t): i for t, i in model["vocab"].items() if t not in special}
        self._bytes = {i: t for t, i in self._ids.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._ranks = {(as_bytes(a), as_bytes(b)): n for n, (a, b) in enumerate(merges)}
        # every end of a token: the token it is itself, or -1
        self._suffixes = {t[i:]: -1 for t in self._ids for i in range(1, len(t))} | self._ids
        self._special = re.compile("|".join(re.escape(t) for t in sorted(special, key=len, reverse=True))) if special else None
        self._pairs: dict[int, bool] = {}
        self._runs = re.compile(f"[{_SPACE}]{{2}}|\0")
        # chunks and short pieces seen, with the tokens of each of their prefixes
        self._place: dict[str, bytes | array] = {}
        self._older: dict[str, bytes | array] = {}
        self._known: dict[str, list[int]] = {}


    def _merged(self, data: bytes) -> list[bytes]:
        """The encoding of a few bytes by the merges themselves, for neighbour tests."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self._ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, key: int) -> bool:
        """Whether two tokens, or one at the start (left: none), are the encoding of their bytes."""
        left, right = (key >> 32) - 1, key & 0xFFFFFFFF
        parts = [self._bytes[right]] if left < 0 else [self._bytes[left], self._bytes[right]]
        if len(self._pairs) >= REMEMBERED:
            self._pairs.clear()
        found = self._pairs[key] = self._merged(b"".join(parts)) == parts
        return found

    def _byte_counts(self, data: bytes) -> list[int]:
        """Tokens of each prefix of one piece, by bytes; position 0 is the empty prefix."""
        ids, known, check = self._suffixes, self._pairs, self._fits
        last, count = [0], [0]  # last: the id of the last token plus one, shifted; 0 before the first
        begun = 0
        for end in range(1, len(data) + 1):
            # mostly the last token of the prefix before grows by the byte
            token = ids.get(data[begun:end], -1)
            if token >= 0:
                key = last[begun] | token
                fits = known.get(key)
                if fits or fits is None and check(key):
                    last.append((token + 1) << 32)
                    count.append(count[begun] + 1)
                    continue
            start = end
            while start:
                start -= 1
                token = ids.get(data[start:end])
                if token is None:
                    raise ValueError(f"the vocabulary has no encoding of {data[:end]!r}")
                if token < 0 or start == begun:
                    continue
                key = last[start] | token
                fits = known.get(key)
                if fits or fits is None and check(key):
                    last.append((token + 1) << 32)
                    count.append(count[start] + 1)
                    begun = start
                    break
        return count

    def _piece(self, piece: str) -> list[int]:
        """Tokens of each non-empty prefix of one piece, by code points."""
        if len(piece) == 3 and piece in _CONTRACTIONS:
            # cut inside, it is an apostrophe and a letter
            return [1, 2, self._byte_counts(piece.encode())[-1]]
        found = self._known.get(piece)
        if found is None:
            data = piece.encode()
            count = self._byte_counts(data)
            found = count[1:] if len(data) == len(piece) else [count[e] for e in np.cumsum([len(c.encode()) for c in piece])]
            if len(piece) <= _SHORT:
                if len(self._known) >= REMEMBERED:
                    self._known.clear()
                self._known[piece] = found
        return found

    def _pieces(self, run: str) -> list[str]:
        if not _WIDE.search(run):
            return _PIECE.findall(run)
        return [run[a:b] for _, (a, b) in self._tokenizer.pre_tokenizer.pre_tokenize_str(run)]

    def _chunk(self, chunk: str) -> list[int]:
        """Prefix counts of white space and the run after it, which no token crosses on either side."""
        head = _HEAD.match(chunk).end()
        counts = self._piece(chunk[:head]) if head else []
        if head == len(chunk):
            return counts
        base, run = 0, chunk[head:]
        if head:
            # before a run, the last white space stands alone or, a blank, belongs to the run
            base = counts[head - 2] if head > 1 else 0
            if chunk[head - 1] == " ":
                run = " " + run
            else:
                base += self._piece(chunk[head - 1])[-1]
        inside: list[int] = []
        for piece in self._pieces(run):
            inside += [base + c for c in self._piece(piece)]
            base = inside[-1]
        return counts + (inside[1:] if len(run) > len(chunk) - head else inside)

    def _vectors(self, text: str) -> list[bytes | array]:
        """The prefix counts of each chunk, in order; together the chunks are the text."""
        if self._runs.search(text):
            keys = _CHUNK.findall(text)
        else:
            # each blank begins a chunk, and so does each line end; "\0" marks the blank
            first, *rest = text.replace("\n", " \n").split(" ")
            keys = [first] * bool(first) + [p if p[:1] == "\n" else "\0" + p for p in rest]
        found = list(map(self._place.get, keys))
        for at, vector in enumerate(found):
            if vector is None:
                found[at] = self._vector(keys[at])
        return found

    def _vector(self, key: str) -> bytes | array:
        vector = self._place.get(key)
        if vector is None and (vector := self._older.get(key)) is None:
            counts: list[int] = []
            for chunk in _CHUNK.findall(" " + key[1:] if key[0] == "\0" else key):
                base = counts[-1] if counts else 0
                counts += [base + c for c in self._chunk(chunk)] if base else self._chunk(chunk)
            vector = bytes(counts) if max(counts) < 256 else array("q", counts)
        if len(key) <= _REMEMBERED_LENGTH:
            if len(self._place) >= REMEMBERED:
                self._older, self._place = self._place, {}
            self._place[key] = vector
        return vector

    def _plain(self, text: str) -> np.ndarray:
        """Prefix counts of a text without special strings, from 0 to all code points."""
        vectors = self._vectors(text) if text else []
        totals = np.fromiter((v[-1] for v in vectors), np.int64, len(vectors))
        within = np.fromiter(chain.from_iterable(vectors), np.int64)
        base = np.repeat(np.cumsum(totals) - totals, np.fromiter(map(len, vectors), np.int64, len(vectors)))
        return np.concatenate([[0], within + base])

    def table(self, text: str) -> np.ndarray:
        """``len(encode(text[:i]))`` for i from 0 to the number of code points.

        A special string inside the text is one token, as by the library's
        default; a prefix that ends inside it is ordinary text.
        """
        if not self._has_special(text):
            return self._plain(text)
        out, base, at = [np.zeros(1, np.int64)], 0, 0
        for found in self._special.finditer(text):
            part = self._plain(text[at : found.end() - 1])
            out.append(base + part[1:])
            base += int(part[found.start() - at]) + 1
            out.append(np.array([base]))
            at = found.end()
        out.append(base + self._plain(text[at:])[1:])
        return np.concatenate(out)

    def _has_special(self, text: str) -> bool:
        return self._special is not None and self._special.search(text) is not None

    def answers(self, text: str, budgets: tuple[int, ...]) -> list[int]:
        """The number of tokens, and for each budget the longest prefix that keeps it.

        Only the chunk in which a budget ends is looked into: every prefix of a
        chunk has at least one token more than all chunks before it.
        """
        if self._has_special(text):
            counts = self.table(text)
            return [int(counts[-1]), *(longest_prefix(counts, b) for b in budgets)]
        if not text:
            return [0] * (1 + len(budgets))
        vectors = self._vectors(text)
        after = np.cumsum(np.fromiter((v[-1] for v in vectors), np.int64, len(vectors)))
        out = [int(after[-1])]
        for budget in budgets:
            if after[-1] <= budget:
                out.append(len(text))
                continue
            if budget <= 0:
                out.append(0)
                continue
            at = int(np.searchsorted(after, budget))  # the last chunk with fewer tokens than the budget before it
            before = int(after[at - 1]) if at else 0
            inside = longest_prefix(np.concatenate([[0], np.fromiter(vectors[at], np.int64)]), budget - before)
            out.append(sum(map(len, vectors[:at])) + inside)
        return out


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Most code points whose tokens fit the budget; a longer prefix may have fewer tokens than a shorter one."""
    return int(np.flatnonzero(counts <= budget)[-1]) if budget >= 0 else 0


def count_prefixes(
    docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", budgets: tuple[int, ...] = (1024,), keep_table: bool = False
) -> DataFrame:
    """A row for each row of ``docs``: its id, ``n_bytes``, ``n_chars``, ``n_tokens`` and, for each
    budget b, ``cut_b``: the most code points whose encoding has at most b tokens.

    ``keep_table`` adds ``prefix_tokens``, the whole table as an array (position
    i: tokens of the first i code points), for questions asked later
    (``tokens_of_prefix``, ``fits``). Counts are those of the tokenizers library
    without added special tokens. A null text counts as empty: 0 everywhere, and
    the table ``[0]``. Null ids and repeated rows stay as they are; other columns
    are not looked at. Work and memory are linear in the text; nothing is shuffled.
    """
    fields = ["n_tokens long", *(f"cut_{b} long" for b in budgets), *(["prefix_tokens array<int>"] if keep_table else [])]

    @F.pandas_udf(", ".join(fields))
    def tabulate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = counter(path)
        for batch in batches:
            rows = []
            for value in batch:
                row = tables.answers(value, budgets)
                rows.append([*row, tables.table(value).astype(np.int32)] if keep_table else row)
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in fields])

    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias(doc_id),
        F.octet_length(whole).cast("long").alias("n_bytes"),
        F.length(whole).cast("long").alias("n_chars"),
        tabulate(whole).alias("_counts"),
    ).select(doc_id, "n_bytes", "n_chars", "_counts.*")


def tokens_of_prefix(table: str, chars) -> F.Column:
    """Tokens of the first ``chars`` code points, from a kept table; of the whole text where it is shorter."""
    return F.element_at(F.col(table), (F.least(F.lit(chars), F.size(table) - 1) + 1).cast("int"))


def fits(table: str, chars, budget) -> F.Column:
    """Whether a prefix keeps within a budget, from a kept table."""
    return tokens_of_prefix(table, chars) <= F.lit(budget)
