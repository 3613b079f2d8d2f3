"""Text expressions."""

from __future__ import annotations

import functools
import sys

from pyspark.sql import Column, functions as F

# Every character counted as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Text without leading and trailing white space."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and all-white-space text; never null."""
    return F.coalesce(strip(text) == "", F.lit(True))


def canonical_name(text: Column) -> Column:
    """Stripped lower-case form used to compare parameter names."""
    return F.lower(strip(text))


@functools.cache
def _foldings() -> tuple[str, str, dict[str, str]]:
    """Characters that fold to one other, those others, and foldings to several, by the Unicode rules that Python ships."""
    single, several = {}, {}
    for point in range(sys.maxunicode + 1):
        one = chr(point)
        folded = one.casefold()
        if len(folded) > 1:
            several[one] = folded
        elif folded != one:
            single[one] = folded
    return "".join(single), "".join(single.values()), several


def casefolded(text: Column) -> Column:
    """Full case folding: sharp s and ligatures are written out, every sigma is the same.

    An explicit map, because lower case of upper case is simplified to lower case by the
    optimizer. Texts without a letter that folds to several are only translated.
    """
    before, after, several = _foldings()
    folded = F.translate(text, before, after)
    written_out = folded
    for one, letters in several.items():
        written_out = F.replace(written_out, F.lit(one), F.lit(letters))
    return F.when(F.rlike(folded, F.lit(f"[{''.join(several)}]")), written_out).otherwise(folded)


def path_parts(path: Column) -> Column:
    """Sort key that orders paths component by component."""
    return F.split(path, "/", -1)


def compact(text: Column) -> Column:
    """Text without dots and white space."""
    return F.translate(text, "." + WHITESPACE, "")


def digits_only(text: Column) -> Column:
    """True when text holds ASCII digits only, ignoring surrounding space."""
    return strip(text).rlike("^[0-9]+$")
