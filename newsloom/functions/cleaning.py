"""Transcript cleaning.

Java's ``\\s`` leaves out U+001C..U+001F even with ``(?U)``, hence ``BLANK``.
A time code starts and ends with a digit, so the word boundary around it is
written as "no letter, number or underscore next to it"; looking for the digit
first lets the search pass over letters quickly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.fixed_values import STAGE_MARKS

BLANK = r"[\s\x1c-\x1f]"
TIME_CODE = (
    r"(?=\p{Nd})(?<![\p{L}\p{N}_])\p{Nd}{1,2}:\p{Nd}{2}(?::\p{Nd}{2})?(?![\p{L}\p{N}_])"
)
STAGE_MARK = r"(?iud)\[(?:" + "|".join(STAGE_MARKS) + r").*?\]"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
# The characters BLANK stands for, for the functions that take a list.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _where(text: Column, mark: str, pattern: str) -> Column:
    """Delete the pattern, which needs ``mark``; a text without the mark is only scanned."""
    return F.when(
        F.contains(text, F.lit(mark)), F.regexp_replace(text, pattern, "")
    ).otherwise(text)


def drop_time_codes(text: Column) -> Column:
    return _where(text, ":", TIME_CODE)


def drop_stage_marks(text: Column) -> Column:
    """``[música ...]`` and the like, up to the next ``]`` of the same line."""
    return _where(text, "[", STAGE_MARK)


def fold_blanks(text: Column) -> Column:
    """Every run of Unicode blanks becomes one space; none at either end."""
    return F.trim(F.regexp_replace(text, f"(?U){BLANK}+", " "))


def clean_text(text: Column) -> Column:
    return fold_blanks(drop_stage_marks(drop_time_codes(text)))


def strip_left(text: Column) -> Column:
    return F.ltrim(text, F.lit(BLANKS))


def strip_right(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def lines(text: Column) -> Column:
    """The lines of a text; a break at its very end opens no further line.

    The lambda has the text split once, also where the expression is not compiled.
    """

    def without_last_empty(pieces: Column) -> Column:
        shorter = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
        return F.when(F.element_at(pieces, -1) == "", shorter).otherwise(pieces)

    return F.get(F.transform(F.array(F.split(text, LINE_BREAK)), without_last_empty), F.lit(0))
