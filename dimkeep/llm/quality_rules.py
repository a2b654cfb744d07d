"""Quality rules as weak supervision: rules vote, their reliability is estimated, the posterior decides.

A rule votes for (1) or against (-1) a text or abstains (0). The model has two
classes of texts and, for each class and rule, how often the rule votes against
such a text. Expectation-maximisation fits them, without labels, to the counts of the
vote patterns that occur, of which there are at most ``3 ** rules`` whatever the
corpus. A text is kept if the posterior probability of the good class is at least
a half: no rule must be passed by all, and a rule that errs often loses its say.

Everything that touches a text is a DataFrame function.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeep.llm.shared import free_name

# White space between words, and the characters counted as symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words

#: Rounds of expectation-maximisation; it ends before when nothing changes.
ROUNDS = 100
#: What is believed at first: the share of good texts, and how often a rule votes
#: against a good text and against a bad one, which most rules do not notice.
FIRST_GOOD, FIRST_ERROR, FIRST_HIT = 0.85, 0.0005, 0.11
#: Weight of the first belief, as a share of the texts.
BELIEF = 0.1

MEASURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_capitals n_exclamations n_marks n_doubled_words n_distinct_words n_bars"
).split()


def with_measures(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with a struct ``out`` of MEASURES (long) of each whole text; a null text has no word.

    Repeated windows are found by sorting the text's window hashes (64 bit)
    with their places, so a long text costs n log n and not its square.
    """
    names = {n: free_name(docs, n) for n in ("_words", "_lines", "_hashes", "_again", "_chars")}
    words, lines, again = F.col(names["_words"]), F.col(names["_lines"]), F.col(names["_again"])
    whole = F.coalesce(F.col(text), F.lit(""))
    no_places = F.array().cast("array<int>")

    def without(value: Column, characters: str) -> Column:
        return F.translate(value, characters, "")

    def count(characters: str) -> Column:
        return F.length(whole) - F.length(without(whole, characters))

    one = docs.withColumns(
        {
            names["_words"]: F.array_remove(F.split(F.translate(whole, SPACES[1:], " " * (len(SPACES) - 1)), " "), ""),
            names["_lines"]: F.filter(F.split(whole, "\n"), lambda line: without(line, SPACES) != ""),
            names["_chars"]: F.struct(
                F.length(without(whole, SPACES)).alias("word_chars"),
                count(SYMBOLS).alias("n_symbols"),
                count(_CAPITALS).alias("n_capitals"),
                count("!").alias("n_exclamations"),
                count(".,;:?").alias("n_marks"),
                count("|").alias("n_bars"),
            ),
        }
    )
    places = F.sequence(F.lit(0), F.size(words) - 3)
    hashed = F.transform(places, lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("hash"), i.alias("at")))
    two = one.withColumn(names["_hashes"], F.when(F.size(words) >= 3, F.sort_array(hashed)))
    sorted_ = F.col(names["_hashes"])
    # a window found twice or more has an equal neighbour in the sorted list
    equal = F.filter(F.sequence(F.lit(0), F.size(sorted_) - 2), lambda i: sorted_[i]["hash"] == sorted_[i + 1]["hash"])
    both = F.flatten(F.transform(equal, lambda i: F.array(sorted_[i]["at"], sorted_[i + 1]["at"])))
    three = two.withColumn(names["_again"], F.when(F.size(sorted_) >= 2, both).otherwise(no_places))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda at: F.array(at, at + 1, at + 2))))
    pairs = F.filter(F.sequence(F.lit(1), F.size(words) - 1), lambda i: words[i] == words[i - 1])
    found = {
        "n_words": F.size(words),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.size(covered),
        "n_lines": F.size(lines),
        "n_distinct_words": F.size(F.array_distinct(words)),
        "n_doubled_words": F.when(F.size(words) >= 2, F.size(pairs)).otherwise(F.lit(0)),
    }
    value = {n: found.get(n, F.col(names["_chars"])[n] if n not in found else None) for n in MEASURES}
    return three.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(*(v.cast("long").alias(n) for n, v in value.items())).alias(out))


def base_failed(m: str) -> Column:
    """Too few words, or too many of them in repeated windows."""
    n = F.col(m)["n_words"]
    return (n < MIN_WORDS) | (100 * F.col(m)["n_repeat_words"] > MAX_REPEATED * n)


def votes(m: str) -> dict[str, Column]:
    """The vote of each rule: against beyond one bound, for within another, abstaining between.

    Each kind of bad text that is known shows in two rules at least, so that
    their agreement can be learnt.
    """
    of = F.col(m)
    share = lambda part, whole: of[part] / F.greatest(of[whole], F.lit(1))
    vote = lambda against, for_: F.when(against, -1).when(for_, 1).otherwise(0)
    length, symbols = share("word_chars", "n_words"), share("n_symbols", "n_words")
    letters = 1 - (of["n_symbols"] + of["n_marks"] + of["n_exclamations"]) / F.greatest(of["word_chars"], F.lit(1))
    distinct = share("n_distinct_words", "n_words")
    lines, repeats = share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")
    capitals, calls = share("n_capitals", "word_chars"), share("n_exclamations", "n_words")
    marks, doubled, bars = share("n_marks", "n_words"), share("n_doubled_words", "n_words"), share("n_bars", "n_words")
    return {
        "word_length": vote((length < 2) | (length > 20), length.between(3, 12)),
        "symbols": vote(symbols > 0.3, symbols < 0.05),
        "letters": vote(letters < 0.75, letters > 0.85),
        "repeated_lines": vote((lines > 0.3) & (of["n_lines"] >= 3), (lines < 0.1) & (of["n_lines"] >= 2)),
        "repeated_windows": vote(repeats > 0.3, repeats < 0.05),
        "capitals": vote(capitals > 0.3, capitals < 0.1),
        "exclamations": vote(calls > 0.2, calls < 0.03),
        "punctuation": vote((marks < 0.01) | (marks > 1), marks.between(0.05, 0.5)),
        "doubled_words": vote(doubled > 0.2, doubled < 0.05),
        "distinct_words": vote((distinct < 0.55) & (of["n_words"] <= 400), distinct > 0.65),
        "bars": vote(bars > 0.1, bars < 0.01),
    }


@dataclass(frozen=True)
class Model:
    """Share of good texts, and of each rule how often it votes against a good and against a bad text.

    Both are shares of the votes it casts; whether it abstains says nothing.
    """

    good: float
    errors: Mapping[str, float]
    hits: Mapping[str, float]

    def accuracies(self) -> dict[str, float]:
        """How often each rule is right when it does not abstain."""
        return {r: self.good * (1 - self.errors[r]) + (1 - self.good) * self.hits[r] for r in self.errors}

    def weights(self, rule: str) -> tuple[float, float]:
        """Log evidence for the good class of a vote against and a vote for."""
        return math.log(self.errors[rule] / self.hits[rule]), math.log((1 - self.errors[rule]) / (1 - self.hits[rule]))

    def posterior(self, pattern: tuple[int, ...]) -> float:
        odds = math.log(self.good / (1 - self.good))
        for rule, vote in zip(self.errors, pattern):
            if vote:
                odds += self.weights(rule)[vote > 0]
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def estimate(patterns: Mapping[tuple[int, ...], int], rules: list[str]) -> Model:
    """Expectation-maximisation over the counts of vote patterns; without any, the first belief.

    The first belief stays as a prior, worth the share BELIEF of the texts (and
    one text): it tells the classes apart, and keeps one kind of bad text from
    taking a class for itself while the other kinds pass as good.
    """
    model = Model(FIRST_GOOD, dict.fromkeys(rules, FIRST_ERROR), dict.fromkeys(rules, FIRST_HIT))
    total = sum(patterns.values())
    belief = 1 + BELIEF * total
    for _ in range(ROUNDS):
        good = belief * FIRST_GOOD
        against = {r: [belief * FIRST_HIT, belief * FIRST_ERROR] for r in rules}
        cast = {r: [belief, belief] for r in rules}
        for pattern, n in sorted(patterns.items()):
            p = model.posterior(pattern)
            good += n * p
            for rule, vote in zip(rules, pattern):
                if vote:
                    for kind, weight in enumerate((n * (1 - p), n * p)):
                        cast[rule][kind] += weight
                        against[rule][kind] += weight * (vote < 0)
        rate = lambda kind: {r: against[r][kind] / cast[r][kind] for r in rules}
        new = Model(good / (total + belief), rate(1), rate(0))
        done = abs(new.good - model.good) < 1e-9
        model = new
        if done:
            break
    return model


def learn(measured: DataFrame, m: str) -> Model:
    """Fit to the rows that do not fail the base; only counts of vote patterns come to the driver."""
    cast = votes(m)
    rows = measured.filter(~base_failed(m)).groupBy(*(v.alias(r) for r, v in cast.items())).count().collect()
    return estimate({tuple(row[r] for r in cast): row["count"] for row in rows}, list(cast))


def posterior(model: Model, m: str) -> Column:
    """Probability of the good class, as a column."""
    odds = F.lit(math.log(model.good / (1 - model.good)))
    for rule, vote in votes(m).items():
        against, for_ = model.weights(rule)
        odds = odds + F.when(vote < 0, against).when(vote > 0, for_).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def kept(model: Model, m: str) -> Column:
    """The verdict: false if the base fails, else whether the posterior is at least a half."""
    return ~base_failed(m) & (posterior(model, m) >= 0.5)
