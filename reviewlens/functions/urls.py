"""Shop URLs and the stable hash used for routing and sampling."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# URL shapes of the shop.
PRODUCT_URL = ("https://tiki.vn/product-p", ".html")
BRAND_MARK, BRAND_ID = "/thuong-hieu/", "/thuong-hieu/([^./]+)"
STORE_MARK, STORE_ID = "/cua-hang/", "/cua-hang/([^/]+)"
CATEGORY_MARK, CATEGORY_ID = "/c", "/c([0-9]+)"


def product_url(product_id: Column) -> Column:
    prefix, suffix = PRODUCT_URL
    return F.when(product_id != "", F.concat(F.lit(prefix), product_id, F.lit(suffix))).otherwise("")


def classify_url(url: Column) -> Column:
    """``struct<source_type, source_id>``; the first mark found decides: brand, store, category.

    An id that does not match leaves ``source_id`` NULL; an unsupported URL leaves both NULL.
    """

    def ident(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))

    kind = (
        F.when(url.contains(BRAND_MARK), "brand")
        .when(url.contains(STORE_MARK), "store")
        .when(url.contains(CATEGORY_MARK), "category")
    )
    source_id = (
        F.when(kind == "brand", ident(BRAND_ID))
        .when(kind == "store", ident(STORE_ID))
        .when(kind == "category", ident(CATEGORY_ID))
    )
    return F.struct(kind.alias("source_type"), source_id.alias("source_id"))


def md5_mod(key: Column, n: int) -> Column:
    """The 128-bit md5 of ``key`` modulo ``n``, as a long.

    The digest is folded 32 bits at a time in long arithmetic, exact for ``n`` below 2**31. A
    power of two up to 2**32 needs the last 32 bits only.
    """
    if not 0 < n < 2**31:
        raise ValueError("n must be between 1 and 2**31 - 1")
    digest = F.md5(key)

    def word(i: int) -> Column:
        return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")

    if n & (n - 1) == 0:
        return word(3) % n
    rest = word(0) % n
    for i in (1, 2, 3):
        rest = (rest * F.lit(2**32) + word(i)) % n
    return rest
