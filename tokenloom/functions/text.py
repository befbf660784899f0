"""Text cleaning as Column expressions: one projection, no shuffle, JVM-side.

Patterns spell out whitespace as the characters for which ``str.isspace`` holds, because
``\\s`` means ASCII only in Java.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# Patterns and thresholds that decide the results.
SPACE = r"\t-\r\x1c-\x20\x85\xa0  -     　"
URL_WEB = rf"http[^{SPACE}]+|www[^{SPACE}]+"
URL_DIALOG = rf"http[^{SPACE}]+"
TAG = r"<[^>\n]*>"
NOT_ALLOWED = rf"""[^a-zA-ZÀ-ÿ0-9.,!?;:'"()\-{SPACE}]+"""
NOT_WORD = r"[^a-zA-Z0-9éèàùç ]+"
FRENCH_MARKS = (" le ", " la ")
MIN_TEXT_LENGTH = 50
MIN_TURN_LENGTH = 10
ID_LIMIT = 100_000

# Every character that NFKC leaves alone and that never combines with its left neighbour.
NFKC_STABLE = r"\x00-\x7fÀ-ÿŒœ«»–—‘’“”€"


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_urls_web(text: ColumnOrName) -> Column:
    return F.regexp_replace(col(text), URL_WEB, "")


def strip_urls_dialog(text: ColumnOrName) -> Column:
    return F.regexp_replace(col(text), URL_DIALOG, "")


def strip_tags(text: ColumnOrName) -> Column:
    """Remove tags that open and close on one line."""
    return F.regexp_replace(col(text), TAG, "")


def char_whitelist(text: ColumnOrName) -> Column:
    return F.regexp_replace(col(text), NOT_ALLOWED, "")


def squeeze_ws(text: ColumnOrName) -> Column:
    return F.trim(F.regexp_replace(col(text), f"[{SPACE}]+", " "))


@F.pandas_udf(T.StringType())
def _normalize_nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def nfkc(text: ColumnOrName) -> Column:
    """Unicode NFKC. Rows of stable characters alone reach Python as nulls."""
    t = col(text)
    unstable = F.when(t.rlike(f"[^{NFKC_STABLE}]"), t)
    return F.coalesce(_normalize_nfkc(unstable), t)


def clean_web(text: ColumnOrName) -> Column:
    return squeeze_ws(char_whitelist(strip_tags(strip_urls_web(text))))


def clean_dialog(text: ColumnOrName) -> Column:
    """Clean one side of a dialog; a missing value turns into the text ``None``."""
    t = F.coalesce(col(text).cast("string"), F.lit("None"))
    return squeeze_ws(char_whitelist(strip_tags(strip_urls_dialog(nfkc(t)))))


def is_french(text: ColumnOrName) -> Column:
    """Rough language test on the raw text; runs before any cleaning."""
    t = col(text)
    first, second = FRENCH_MARKS
    return t.contains(first) | t.contains(second)


def is_long_enough(text: ColumnOrName, n: int = MIN_TEXT_LENGTH) -> Column:
    return F.length(col(text)) >= n


def is_turn_pair(prompt: ColumnOrName, response: ColumnOrName, n: int = MIN_TURN_LENGTH) -> Column:
    return (F.length(col(prompt)) > n) & (F.length(col(response)) > n)


def dialog_line(prompt: ColumnOrName, response: ColumnOrName) -> Column:
    """One dialog; with the line break that a text sink adds, a blank line ends it."""
    return F.concat(F.lit("User: "), col(prompt), F.lit("\nAssistant: "), col(response), F.lit("\n"))


def split_ws(text: ColumnOrName) -> Column:
    """Whitespace tokens of one text as an array."""
    return F.array_remove(F.split(col(text), f"[{SPACE}]+"), "")


def split_phrase(text: ColumnOrName) -> Column:
    """Lower-case words; every other character separates."""
    spaced = F.regexp_replace(F.lower(col(text)), NOT_WORD, " ")
    return F.array_remove(F.split(spaced, " +"), "")


def compress_id(token_id: ColumnOrName, limit: int = ID_LIMIT) -> Column:
    return F.pmod(col(token_id), F.lit(limit).cast("bigint"))


def utf8_bytes(text: ColumnOrName) -> Column:
    return F.octet_length(col(text)).cast("bigint")


def sentence(*words: ColumnOrName) -> Column:
    return F.concat_ws(" ", *[col(w) for w in words])
