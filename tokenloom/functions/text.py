"""Column expressions over document text. All of them run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that a Unicode-aware strip removes.
WHITESPACE_CODE_POINTS = [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
WHITESPACE = "".join(map(chr, WHITESPACE_CODE_POINTS))


def ranges(points: list[int]) -> list[tuple[int, int]]:
    """First and last of the runs of consecutive numbers."""
    ordered = sorted(points)
    firsts = [p for p in ordered if p - 1 not in points]
    lasts = [p for p in ordered if p + 1 not in points]
    return list(zip(firsts, lasts))


# Fixed value: the visible mark that stands for a space inside a piece.
SPACE_MARK = "▁"

# The mark is folded like a space, as its own round trip cannot tell the two apart.
# Neighbours are one range, as a pattern tries the entries of a class one by one.
BLANK_CLASS = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges([*WHITESPACE_CODE_POINTS, ord(SPACE_MARK)])) + "]+"


def strip(text: Column) -> Column:
    """Text without surrounding white space; null counts as the empty document."""
    return F.trim(F.coalesce(text, F.lit("")), F.lit(WHITESPACE))


def characters(text: Column) -> Column:
    """The code points of a text as strings; the empty text gives no element."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def normalize(text: Column) -> Column:
    """Runs of white space folded to one space, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_CLASS, " "))


def units(text: Column) -> Column:
    """Space-separated units of the normalized text.

    A word opens with the space mark, and every ASCII digit is a unit of its own.
    """
    spaced = F.regexp_replace(normalize(text), " ", f" {SPACE_MARK}")
    marked = F.when(spaced == "", spaced).otherwise(F.concat(F.lit(SPACE_MARK), spaced))
    return F.trim(F.regexp_replace(F.regexp_replace(marked, "([0-9])", " $1 "), " +", " "))
