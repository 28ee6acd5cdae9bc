"""Text, title and language of a stored HTML page.

The markup is taken apart with JVM regular expressions. Only the decoding of
entities, which Spark has no function for, is a pandas UDF. It takes every
text: choosing those with an ``&`` would work out the text again beside it.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.fixed_values import ARTICLE_MIN_CHARS
from newsloom.functions.cleaning import BLANK, fold_blanks, strip

COMMENT = r"(?s)<!--.*?-->"
ASIDE = (
    r"(?is)<(script|style|noscript|template|svg|head|title|nav|aside|header|footer|form)\b[^>]*>"
    r".*?</\1\s*>"
)
ARTICLE = r"(?is)<article\b[^>]*>(.*)</article\s*>"
MAIN = r"(?is)<main\b[^>]*>(.*)</main\s*>"
BLOCK_TAG = (
    r"(?i)</?(?:p|br|hr|div|section|article|main|ul|ol|li|dl|dt|dd|h[1-6]|table|tr|td|th|"
    r"blockquote|pre|figure|figcaption)\b[^>]*>"
)
TAG = r"(?s)<[a-zA-Z/!][^>]*>"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
SOCIAL_TITLE = r"""(?is)<meta\s[^>]*property=["']og:title["'][^>]*content=["']([^"']*)["']"""
PAGE_LANGUAGE = r"""(?is)<html\b[^>]*?\slang=["']?([A-Za-z0-9\-]+)"""


@F.pandas_udf(T.StringType())
def decode_entities(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def page_text(page: Column) -> Column:
    """Main text, one line per block element; null when nothing is left.

    Errs on the side of more text: all articles, else all of ``<main>``, else
    the whole page, without comments, scripts and page furniture.
    """
    bare = F.regexp_replace(F.regexp_replace(page, COMMENT, ""), ASIDE, "\n")
    article = F.regexp_extract(bare, ARTICLE, 1)
    main = F.regexp_extract(bare, MAIN, 1)
    region = F.coalesce(F.nullif(article, F.lit("")), F.nullif(main, F.lit("")), bare)
    flat = F.regexp_replace(region, f"(?U){BLANK}+", " ")
    broken = F.regexp_replace(F.regexp_replace(flat, BLOCK_TAG, "\n"), TAG, "")
    decoded = F.regexp_replace(decode_entities(broken), r"(?U)[\s\x1c-\x1f&&[^\n]]+", " ")
    return F.nullif(strip(F.regexp_replace(decoded, r" ?\n[ \n]*", "\n")), F.lit(""))


def page_title(page: Column) -> Column:
    social = F.regexp_extract(page, SOCIAL_TITLE, 1)
    title = F.when(social != "", social).otherwise(F.regexp_extract(page, TITLE, 1))
    return F.nullif(fold_blanks(decode_entities(title)), F.lit(""))


def page_language(page: Column) -> Column:
    return F.nullif(F.regexp_extract(page, PAGE_LANGUAGE, 1), F.lit(""))


def text_status(text: Column, min_chars: int = ARTICLE_MIN_CHARS) -> Column:
    """``ok`` for a text of some length, else ``extract-weak``."""
    return F.when(F.length(strip(text)) >= min_chars, "ok").otherwise("extract-weak")
