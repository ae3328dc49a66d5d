"""Text columns: composing, trimming, shortening, tokenising."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

WHITESPACE = " \t\n\r\f\v"


def compose_text(title: Column, content: Column) -> Column:
    """Title, one space, content; not trimmed. A NULL part counts as empty."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(content, F.lit("")))


def strip(text: Column) -> Column:
    """Cut spaces, tabs and line breaks at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def ellipsize(text: Column, n: int) -> Column:
    """The first ``n`` characters and ``...`` when longer, else the text itself."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def abbrev_id(ident: Column) -> Column:
    """First 12 characters and ``...`` whatever the length; ``N/A`` when missing or empty."""
    short = F.concat(F.substring(ident, 1, 12), F.lit("..."))
    return F.when(ident != "", short).otherwise("N/A")


def rating_badge(rating: Column) -> Column:
    return F.concat(F.lit("⭐ "), F.coalesce(rating.cast("string"), F.lit("N/A")))


def tokens(text: Column, stopwords: Iterable[str]) -> Column:
    """Lower-case words split at whitespace, without empty strings and stop words."""
    drop = F.array(*[F.lit(word) for word in ("", *stopwords)])
    return F.filter(F.split(F.lower(text), r"\s+"), lambda word: ~F.array_contains(drop, word))
