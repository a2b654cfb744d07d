"""Token ids of whole texts from a tokenizers file, with a memory for words.

Where a vocabulary drops white space and splits only there and inside words, the
ids of a text are those of its words in turn; each distinct word is then encoded
once per worker. Any other file is used as it is, text by text.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a Python worker remembers, in each of two generations.
REMEMBERED = 400_000
_REMEMBERED_LENGTH = 64
#: Characters of texts, unless it is one text, that are dealt with together.
_CHARACTERS = 1 << 22
#: Words encoded in one call.
_TOGETHER = 500

# What the fast way relies on, as the vocabulary file describes itself.
_SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_END = "</w>"

# A run of Latin letters (composed, with plain lower case) and then marks without an apostrophe.
_SIMPLE = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]*)([!-&(-/:-@\[-`{-~]*)")


class WordIds:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self._by_word = self._drops_space(described)
        self._special = "<|" if described.get("added_tokens") else None
        self._remembered = remembered
        self._place: dict[str, bytes] = {"": b""}
        self._older: dict[str, bytes] = {}
        if self._by_word:
            # the same model behind a plainer split, for parts that are one run of letters or marks
            self._runs = Tokenizer.from_file(path)
            self._runs.normalizer = None
            self._runs.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )
            self._ends = np.zeros(self._tokenizer.get_vocab_size(), bool)
            for token, i in self._tokenizer.get_vocab().items():
                self._ends[i] = token.endswith(_WORD_END)

    @staticmethod
    def _drops_space(described: dict) -> bool:
        normal = described.get("normalizer") or {}
        split = described.get("pre_tokenizer") or {}
        kinds = [n["type"] for n in normal.get("normalizers", [])]
        first = (split.get("pretokenizers") or [{}])[0]
        return (
            described["model"].get("end_of_word_suffix") == _WORD_END
            and kinds == ["NFC", "Replace", "Lowercase"]
            and first.get("pattern") == {"Regex": _SPLIT_PATTERN}
            and first.get("behavior") == "Removed"
            and first.get("invert") is True
        )

    def _of_runs(self, runs: list[str]) -> dict[str, bytes]:
        """Ids of runs that are one piece each."""
        found = {}
        for at in range(0, len(runs), _TOGETHER):
            some = runs[at : at + _TOGETHER]
            ids = np.array(self._runs.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            raw, ends = ids.tobytes(), 4 * (np.flatnonzero(self._ends[ids]) + 1)
            if len(ends) != len(some):
                raise ValueError("a run of letters did not end with a word end")
            begun = 0
            for run, end in zip(some, ends.tolist()):
                found[run] = raw[begun:end]
                begun = end
        return found

    def _learn(self, words: set[str]) -> None:
        """Encode words not met before."""
        simple, odd = {}, []
        plain = {}
        for word in words:
            if word.isascii() and word.isalpha():
                plain[word] = word.lower()
                continue
            parts = _SIMPLE.fullmatch(word)
            if parts and not (self._special and self._special in word):
                simple[word] = (parts[1].lower(), parts[2])
            else:
                odd.append(word)
        runs = sorted({r for pair in simple.values() for r in pair if r}.union(plain.values()))
        ids = self._of_runs(runs)
        ids[""] = b""
        if len(self._place) + len(words) > self._remembered:
            self._older, self._place = self._place, {"": b""}
        self._place.update(zip(plain, map(ids.__getitem__, plain.values())))
        for word, (letters, marks) in simple.items():
            self._place[word] = ids[letters] + ids[marks]
        for at in range(0, len(odd), _TOGETHER):
            some = odd[at : at + _TOGETHER]
            for word, e in zip(some, self._tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self._place[word] = np.array(e.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, as the tokenizers library gives them."""
        if not self._by_word:
            return [np.array(e.ids, "<u4").tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if not texts:
            return []
        if len(texts) > 1 and sum(map(len, texts)) > _CHARACTERS:
            half = len(texts) // 2
            return self.encode(texts[:half]) + self.encode(texts[half:])
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        # each distinct word of these texts is looked up once; their ids are then dealt out by numbers
        named = split.values.dictionary_encode()
        words = named.dictionary.to_numpy(zero_copy_only=False).tolist()
        known, older = self._place, self._older
        missing = {w for w in words if w not in known}
        for word in [w for w in missing if w in older]:
            known[word] = older[word]
            missing.discard(word)
        if missing:
            self._learn(missing)
            if self._place is not known:
                # a new generation has begun; what these texts need is taken along
                self._place |= {w: v for w in words if (v := known.get(w)) is not None}
        of_word = list(map(self._place.__getitem__, words))
        for word in missing:
            if len(word) > _REMEMBERED_LENGTH:
                del self._place[word]
        return _dealt(of_word, named.indices.to_numpy(), split.offsets.to_numpy())


def _dealt(of_word: list[bytes], words: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The ids of each text: ``words`` numbers the words of all texts, ``offsets`` says where each text begins."""
    ids = np.frombuffer(b"".join(of_word), "<u4")
    sizes = np.fromiter(map(len, of_word), np.int64, len(of_word)) // 4
    firsts = np.cumsum(sizes) - sizes
    counts = sizes[words]
    ends = np.concatenate([[0], np.cumsum(counts)])
    places = np.arange(ends[-1]) + np.repeat(firsts[words] - ends[:-1], counts)
    out = ids[places].tobytes()
    borders = (4 * ends[offsets]).tolist()
    return [out[a:b] for a, b in zip(borders, borders[1:])]


@lru_cache(maxsize=2)
def word_ids(path: str, remembered: int = REMEMBERED) -> WordIds:
    return WordIds(path, remembered)
