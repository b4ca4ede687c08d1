"""Text rules of the reports: forgiving comparison, key clean-up, comma lists."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Greek letters with tonos or dialytika, their plain letters, and final sigma.
ACCENTED = "άέήίόύώϊϋΐΰς"
PLAIN = "αεηιουωιυιυσ"

# Texts a spreadsheet cell may hold in place of an empty key.
NULL_TOKENS = ("", "nan", "None", "<NA>")


def text_key(c: Column) -> Column:
    """Comparison form of a text: no case, no Greek accents, no trailing blanks.

    A plain binary string, so joins and groupings on it may still be broadcast
    or hashed (an explicit collation in the join condition forces a sort-merge
    join). NULL stays NULL.
    """
    return F.rtrim(F.translate(F.lower(c), ACCENTED, PLAIN))


def same_text(a: Column, b: Column) -> Column:
    return text_key(a) == text_key(b)


def collated_text(c: Column, collation: str = "UNICODE_CI_AI") -> Column:
    """A text under a Unicode collation that ignores case and every accent, trailing blanks cut.

    'Café' = 'cafe', 'Müller' = 'muller', 'Straße' = 'strasse', 'ΆΛΦΑ' = 'αλφα'. The value
    keeps its spelling; comparisons, groupings and joins follow the collation. Such a join
    is always a sort-merge join (never broadcast or hashed on the raw bytes), so use it
    where accents beyond Greek matter and :func:`text_key` where a broadcast pays off.
    """
    return F.collate(F.rtrim(c), collation)


def same_text_collated(a: Column, b: Column) -> Column:
    return collated_text(a) == collated_text(b)


def in_texts(c: Column, texts: Iterable[str]) -> Column:
    """``c IN (texts)`` under the comparison of :func:`text_key`; NULL in, NULL out."""
    return in_folded(text_key(c), texts)


def in_folded(key: Column, texts: Iterable[str]) -> Column:
    """:func:`in_texts` for a column that is a :func:`text_key` already."""
    return key.isin(*[_fold(t) for t in texts])


def matches_any(c: Column, patterns: Iterable[str]) -> Column:
    """True when ``c`` is LIKE one of the patterns, ignoring case; NULL in, NULL out."""
    return reduce(lambda a, b: a | b, [c.ilike(p) for p in patterns])


def _fold(text: str) -> str:
    return text.lower().translate(str.maketrans(ACCENTED, PLAIN)).rstrip(" ")


def normalise_key(c: Column) -> Column:
    """Key of a row between two exports: stripped text, '123.0' and '00123' become '123'.

    White space of any kind (blanks, tabs, line breaks, Unicode spaces) is stripped from both
    ends. Empty texts and null tokens become NULL; a number that is not whole, or that does
    not fit 64 bits, keeps its text.
    """
    text = F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", "")
    clean = F.when(~text.isin(*NULL_TOKENS), text)
    # 64-bit texts of digits go straight to bigint: a double would lose digits past 2^53
    digits = F.when(clean.rlike(r"^[+-]?[0-9]+$"), clean.try_cast("bigint"))
    number = clean.try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(digits.cast("string"), whole.cast("string"), clean)


def split_list(c: Column, drop_empty: bool = True) -> Column:
    """Comma list as an array of trimmed texts; NULL has no list."""
    parts = F.transform(F.split(c, ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "") if drop_empty else parts
