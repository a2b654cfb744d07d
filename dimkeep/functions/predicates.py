"""Change tests, sentinel defaults, whitelists and flags."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = -1


def differs(old: Column, new: Column, blank=None) -> Column:
    """Change test of one attribute.

    Without ``blank`` the answer is unknown as soon as one side is null, so such
    a row is not changed. With ``blank`` a null counts as that value: null and
    blank are equal, null and anything else differ.
    """
    if blank is None:
        return old != new
    return F.coalesce(old, F.lit(blank)) != F.coalesce(new, F.lit(blank))


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def or_unknown(value: Column, unknown=UNKNOWN) -> Column:
    """Sentinel for a missing code. The sentinel takes the type it is given in, so pass text for text."""
    return F.coalesce(value, F.lit(unknown))


def keep_known(code: Column, known: Iterable, unknown=UNKNOWN) -> Column:
    """The code itself if it is on the list, else the sentinel."""
    return F.when(code.isin(list(known)), code).otherwise(F.lit(unknown))


def first_known(*codes: Column, unknown=UNKNOWN) -> Column:
    """First code that is neither null nor the sentinel, else the sentinel."""
    return F.coalesce(*[F.when(c != F.lit(unknown), c) for c in codes], F.lit(unknown))


def flag(text: Column) -> Column:
    """Null is false, a number is true unless zero, TRUE/FALSE are taken as words; the rest fails."""
    word = F.upper(F.trim(text.cast("string")))
    return (
        F.when(text.isNull(), F.lit(False))
        .when(word == "TRUE", F.lit(True))
        .when(word == "FALSE", F.lit(False))
        .otherwise(word.cast("int") != 0)
    )
