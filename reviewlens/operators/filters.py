"""Row filters. Plain comparisons on stored columns reach the parquet scan."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions import compose_text, naive_iso_time, review_instant, strip


def filter_content(reviews: DataFrame, min_chars: int = 3) -> DataFrame:
    """Content longer than ``min_chars`` characters; missing content is dropped."""
    return reviews.filter(F.length("content") > min_chars)


def filter_text(reviews: DataFrame, min_chars: int = 3) -> DataFrame:
    """Trimmed title and content together longer than ``min_chars``."""
    return reviews.filter(F.length(strip(compose_text(F.col("title"), F.col("content")))) > min_chars)


def where_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def filter_recent(
    reviews: DataFrame, days_back: int, as_of: datetime, mode: str = "lenient", column: str = "create_time"
) -> DataFrame:
    """Reviews not older than ``days_back`` days at ``as_of`` (wall clock, UTC).

    ``lenient`` cuts only zone-less ISO dates and keeps every other text; ``strict`` also reads
    epoch numbers and zoned times. A date that cannot be read is kept by both.
    """
    reader = {"lenient": naive_iso_time, "strict": review_instant}[mode]
    cutoff = F.lit((as_of - timedelta(days=days_back)).isoformat(sep=" ")).cast("timestamp_ntz")
    return reviews.filter(F.coalesce(reader(F.col(column)) >= cutoff, F.lit(True)))


def recent(reviews: DataFrame, as_of: datetime, minutes: int = 5) -> DataFrame:
    """Rows crawled in the last minutes; compares the stored number, so the scan can skip files."""
    since = as_of.replace(tzinfo=as_of.tzinfo or timezone.utc).timestamp() - minutes * 60
    return reviews.filter(F.col("crawled_at") >= since)


def brand_match(brand: str, brand_name: Column, brand_slug: Column, product_name: Column) -> Column:
    """Whether a product belongs to ``brand``, without regard to case.

    Equal brand name or slug; or a brand of up to three letters inside the brand name; or a longer
    one inside the product name.
    """
    wanted = brand.lower()

    def low(c: Column) -> Column:
        return F.lower(F.coalesce(c, F.lit("")))

    loose = low(brand_name) if len(brand) <= 3 else low(product_name)
    return (low(brand_name) == wanted) | (low(brand_slug) == wanted) | loose.contains(wanted)


def by_product(df: DataFrame, product_id: str | None = None, product_name: str | None = None) -> DataFrame:
    """Rows of one product, by id or by full name."""
    if (product_id is None) == (product_name is None):
        raise ValueError("give either product_id or product_name")
    return where_eq(df, "product_id", product_id) if product_id is not None else where_eq(
        df, "product_name", product_name
    )


def search_products(df: DataFrame, query: str, name: str = "product_name") -> DataFrame:
    """Rows whose product id is ``query``; if there are none, rows whose name matches it as a regex.

    Whether an exact hit exists is a scalar subquery over one column with a pushed-down filter; the
    main scan then runs once, and evaluates the regex only when the subquery found nothing.
    """
    exact = F.col("product_id") == F.lit(query)
    hits = df.filter(exact).select("product_id").limit(1).agg(F.count("*")).scalar()
    return df.filter(exact | ((hits == 0) & F.coalesce(F.col(name).rlike("(?iu)" + query), F.lit(False))))
