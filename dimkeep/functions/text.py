"""Windows-1252 text read without the legacy charset switch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The charset differs from ISO-8859-1 only in 0x80-0x9F, where five bytes are undefined.
_DEFINED = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_LATIN = "".join(chr(b) for b in _DEFINED)
_WINDOWS = bytes(_DEFINED).decode("windows-1252")


def windows_text(latin: Column) -> Column:
    """Text decoded as ISO-8859-1 -> the text that windows-1252 meant."""
    return F.translate(latin, _LATIN, _WINDOWS)


def windows_name(latin: str) -> str:
    return latin.translate(str.maketrans(_LATIN, _WINDOWS))


def windows_line(raw: Column) -> Column:
    """A line of ``spark.read.text``, whose bytes are kept as they are in the file."""
    return windows_text(F.decode(raw.cast("binary"), "ISO-8859-1"))
