"""Counts, summaries, trends and bursts."""

from __future__ import annotations

from datetime import datetime


from reviewlens.operators import analytics as A
from reviewlens.operators.filters import by_product, search_products
from reviewlens.plans.catalog import query
from reviewlens.plans.data import arrivals, predictions, scored_reviews, split_predictions, table
from reviewlens.plans.oracle import on_eval, on_pred, on_reviews, on_split

AS_OF = datetime(2025, 11, 30)
SHORT = "CASE WHEN length(product_name) > 40 THEN substring(product_name, 1, 40) || '...' ELSE product_name END"


@query(
    "table_counts",
    on_split("SELECT (SELECT count(*) FROM reviews) AS raw, (SELECT count(*) FROM split) AS pred"),
)
def table_counts(spark, sf_dir):
    return A.counts(arrivals(spark, sf_dir), split_predictions(spark, sf_dir))


@query("counts_by_model", on_split("SELECT model, count(*) AS n FROM split GROUP BY model"))
def counts_by_model(spark, sf_dir):
    return A.by_model(split_predictions(spark, sf_dir))


@query("counts_by_platform", on_reviews("SELECT platform, count(*) AS n FROM reviews GROUP BY platform"))
def counts_by_platform(spark, sf_dir):
    return A.by_platform(arrivals(spark, sf_dir))


@query(
    "status_snapshot",
    on_split("""
SELECT kind, name, n, CAST(1764460800 AS BIGINT) AS ts FROM (
  SELECT 'raw' AS kind, '' AS name, count(*) AS n FROM reviews
  UNION ALL SELECT 'pred', '', count(*) FROM split
  UNION ALL SELECT 'raw_platform', platform, count(*) FROM reviews GROUP BY platform
  UNION ALL SELECT 'pred_model', model, count(*) FROM split GROUP BY model) s"""),
)
def status_snapshot(spark, sf_dir):
    return A.snapshot(arrivals(spark, sf_dir), split_predictions(spark, sf_dir), AS_OF)


def _top_sql(name: str) -> str:
    return on_eval(
        """
SELECT display_name, pred_label_vn, count(*) AS n, max(total) AS total
FROM named JOIN top USING (display_name) GROUP BY display_name, pred_label_vn""",
        f"\nnamed AS (SELECT {name} AS display_name, pred_label_vn FROM eval)",
        "\ntop AS (SELECT display_name, count(*) AS total FROM named GROUP BY 1 ORDER BY total DESC, display_name LIMIT 10)",
    )


@query(
    "top_products_sentiment",
    on_eval(
        f"""
SELECT product_id, {SHORT} AS display_name, pred_label_vn, count(*) AS n, max(total) AS total
FROM eval JOIN top USING (product_id, product_name) GROUP BY product_id, product_name, pred_label_vn""",
        """
top AS (
  SELECT product_id, product_name, count(*) AS total FROM eval GROUP BY 1, 2
  ORDER BY total DESC, product_name, product_id LIMIT 10
)""",
    ),
)
def top_products_sentiment(spark, sf_dir):
    return A.top_products(scored_reviews(spark, sf_dir))


@query("top_products_display_name", _top_sql(SHORT))
def top_products_display_name(spark, sf_dir):
    return A.top_products(scored_reviews(spark, sf_dir), by="display")


@query("top_products_full_name", _top_sql("product_name"))
def top_products_full_name(spark, sf_dir):
    return A.top_products(scored_reviews(spark, sf_dir), by="full")


@query(
    "category_sentiment",
    on_eval("""
SELECT coalesce(category_name, 'Unknown') AS category_name, pred_label_vn, count(*) AS n FROM eval GROUP BY 1, 2"""),
)
def category_sentiment(spark, sf_dir):
    return A.by_category(scored_reviews(spark, sf_dir))


@query(
    "category_sentiment_wide",
    on_eval("""
SELECT coalesce(category_name, 'Unknown') AS category_name,
  count(*) FILTER (WHERE pred_label_vn = 'Tốt') AS "Tốt",
  count(*) FILTER (WHERE pred_label_vn = 'Trung bình') AS "Trung bình",
  count(*) FILTER (WHERE pred_label_vn = 'Không tốt') AS "Không tốt"
FROM eval GROUP BY 1"""),
)
def category_sentiment_wide(spark, sf_dir):
    return A.by_category_wide(scored_reviews(spark, sf_dir))


@query(
    "worst_products",
    on_eval(f"""
SELECT product_id, {SHORT} AS display_name, count(*) AS negative_count FROM eval WHERE pred_label_vn = 'Không tốt'
GROUP BY product_id, product_name ORDER BY negative_count DESC, product_name, product_id LIMIT 10"""),
)
def worst_products(spark, sf_dir):
    return A.worst_products(scored_reviews(spark, sf_dir))


@query(
    "worst_products_display_name",
    on_eval(f"""
SELECT {SHORT} AS display_name, count(*) AS negative_count FROM eval WHERE pred_label_vn = 'Không tốt'
GROUP BY 1 ORDER BY negative_count DESC, display_name LIMIT 10"""),
)
def worst_products_display_name(spark, sf_dir):
    return A.worst_products(scored_reviews(spark, sf_dir), by="display")


@query(
    "product_summary",
    on_eval("""
SELECT total, positive, neutral, negative, positive * 100.0::DOUBLE / total AS positive_pct,
  neutral * 100.0::DOUBLE / total AS neutral_pct, negative * 100.0::DOUBLE / total AS negative_pct
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE pred_label = 1) AS positive,
  count(*) FILTER (WHERE pred_label = 2) AS neutral, count(*) FILTER (WHERE pred_label = 0) AS negative
  FROM eval WHERE product_id = '7') t"""),
)
def product_summary(spark, sf_dir):
    return A.summary(by_product(scored_reviews(spark, sf_dir), product_id="7"))


@query("distinct_products", on_reviews("SELECT DISTINCT product_name FROM reviews"))
def distinct_products(spark, sf_dir):
    return A.product_names(arrivals(spark, sf_dir))


@query(
    "matched_products",
    on_reviews("""
SELECT count(*) AS matched, string_agg(product_name, ', ' ORDER BY product_name) FILTER (WHERE rn <= 3) AS names,
  greatest(count(*) - 3, 0) AS more
FROM (SELECT product_name, row_number() OVER (ORDER BY product_name) AS rn
  FROM (SELECT DISTINCT product_name FROM reviews WHERE regexp_matches(product_name, '(?i)edition no 1')) d) t"""),
)
def matched_products(spark, sf_dir):
    return A.matched_products(search_products(arrivals(spark, sf_dir), "edition no 1"))


@query("label_distribution", on_split("SELECT pred_label, count(*) AS n FROM split GROUP BY pred_label"))
def label_distribution(spark, sf_dir):
    return A.by_label(split_predictions(spark, sf_dir))


@query(
    "rating_distribution",
    on_reviews("""
SELECT mood, n, CAST(n AS DOUBLE) / sum(n) OVER () AS share FROM (
  SELECT CASE WHEN rating IN (4, 5) THEN 'positive' WHEN rating IN (1, 2) THEN 'negative' ELSE 'neutral' END AS mood,
    count(*) AS n
  FROM reviews WHERE rating BETWEEN 1 AND 5 GROUP BY 1) t"""),
)
def rating_distribution(spark, sf_dir):
    return A.rating_mix(arrivals(spark, sf_dir))


@query(
    "word_count",
    r"""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{M}\p{N}_]+')) AS word FROM documents) w
WHERE word <> '' GROUP BY word""",
)
def word_count(spark, sf_dir):
    return A.word_count(table(spark, sf_dir, "documents"), "text")


@query(
    "sentiment_trend",
    on_pred("""
SELECT CAST(floor(ts / 300) * 300 AS BIGINT) AS window_start, CAST(floor(ts / 300) * 300 + 300 AS BIGINT) AS window_end,
  pred_label_vn, count(*) AS n
FROM pred GROUP BY 1, 2, 3"""),
)
def sentiment_trend(spark, sf_dir):
    return A.sentiment_trend(predictions(spark, sf_dir))


@query(
    "negative_burst",
    on_pred("""
SELECT product_id, review_id, ts, burst_start FROM (
  SELECT product_id, review_id, ts, lag(ts, 2) OVER (PARTITION BY product_id ORDER BY ts, review_id) AS burst_start
  FROM pred WHERE pred_label = 0) t
WHERE ts - burst_start < 600"""),
)
def negative_burst(spark, sf_dir):
    return A.negative_burst(predictions(spark, sf_dir))
