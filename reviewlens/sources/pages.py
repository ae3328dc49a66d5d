"""Landed shop responses and web pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from reviewlens.schema import API_PRODUCT, API_REVIEW

# What a link to a product contains.
PRODUCT_MARKS = ("/product", "/item", "i.")
LINK = "<a[^>]*\\shref=[\"']([^\"']*)[\"']"


def explode_pages(pages: DataFrame, kind: str, body: str = "body") -> DataFrame:
    """One row per element of ``data`` of each response, with its ``rank`` in the page and ``total``.

    ``kind`` is ``reviews`` or ``products``. A page that is not valid JSON or has no data yields
    no row. Every row is built from its own page: no shuffle.
    """
    item = {"reviews": API_REVIEW, "products": API_PRODUCT}[kind]
    schema = f"struct<data: array<{item}>, paging: struct<total: bigint>>"
    rest = [name for name in pages.columns if name != body]
    parsed = pages.withColumn("_page", F.from_json(body, schema))
    return parsed.select(
        *rest, F.col("_page.paging.total").alias("total"), F.posexplode("_page.data").alias("rank", "_item")
    ).select(*rest, "total", "rank", "_item.*")


def product_links(pages: DataFrame, marks: Sequence[str] = PRODUCT_MARKS) -> DataFrame:
    """Distinct links per page that contain one of ``marks``; repeats are removed inside the row."""
    links = F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    chosen = F.filter(links, lambda link: _any_mark(link, marks))
    return pages.select("page_id", F.explode(chosen).alias("link"))


def _any_mark(link, marks):
    found = F.lit(False)
    for mark in marks:
        found = found | link.contains(mark)
    return found
