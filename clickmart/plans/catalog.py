"""The built tables in the catalog: stored views over their newest versions, and functions for single users.

Views and functions are declared again after a build; who has read a view keeps the files that it named.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from clickmart.functions.expressions import STRENGTHS
from clickmart.sinks.tables import latest_version, replace_stored_view

# The views that reports read, and the built tables behind them.
VIEWS = {
    "VW_PRODUCT_POPULARITY": "product_popularity",
    "VW_USER_BEHAVIOR": "user_behavior",
    "VW_CATEGORY_PERFORMANCE": "category_performance",
    "VW_DAILY_PERFORMANCE": "daily_performance",
    "VW_BRAND_PERFORMANCE": "brand_performance",
    "VW_USER_JOURNEY": "user_journey",
    "VW_PRODUCT_AFFINITY": "product_affinity",
}

# Functions that list what was computed for a user: table behind it, columns that it returns, and the place in the list.
_LIST = "product_id STRING, recommendation_score DOUBLE, reason STRING, rank BIGINT"
_RANKED = "product_id, recommendation_score, reason, `rank`"
LISTS = {
    "similar_users_of": ("similar_users", "similar_user_id STRING, similarity_score DOUBLE, rank BIGINT", "similar_user_id, similarity_score, `rank`", "`rank`"),
    "content_recommendations_of": ("content_recommendations", _LIST, _RANKED, "`rank`"),
    "collaborative_recommendations_of": ("collaborative_recommendations", _LIST, _RANKED, "`rank`"),
    "hybrid_recommendations_of": ("hybrid_recommendations", _LIST, _RANKED, "`rank`"),
    "popularity_recommendations_of": (
        "popularity_recommendations",
        _LIST,
        "product_id, recommendation_score, recommendation_reason, rank_position",
        "rank_position",
    ),
}


def _newest(spark: SparkSession, out: str, table: str) -> str | None:
    version = latest_version(spark, f"{out}/{table}")
    return f"parquet.`{out}/{table}/version={version}`" if version else None


def publish_views(spark: SparkSession, out: str) -> list[str]:
    """Store a view over the newest version of each table that reports read; names of those that are there."""
    made = []
    for view, table in VIEWS.items():
        if source := _newest(spark, out, table):
            replace_stored_view(spark, view, f"SELECT * FROM {source}")
            made.append(view)
    return made


def publish_functions(spark: SparkSession, out: str) -> list[str]:
    """Declare the functions of this session over the newest versions; names of those whose tables are there.

    ``SELECT * FROM similar_users_of('7', 10)`` reads the rows of that user alone: the user is a filter at the scan.
    ``user_similarity_of('7', '9')`` compares two users by the interactions of both.
    """
    made = []
    for name, (table, returns, columns, place) in LISTS.items():
        if source := _newest(spark, out, table):
            spark.sql(
                f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted STRING, most INT) RETURNS TABLE({returns}) "
                f"RETURN SELECT {columns} FROM {source} WHERE user_id = {name}.wanted AND {place} <= {name}.most"
            )
            made.append(name)
    if source := _newest(spark, out, "user_product_interactions"):
        kinds = " ".join(f"WHEN '{kind}' THEN {value}" for kind, value in STRENGTHS.items())
        weights = (
            f"(SELECT user_id, product_id, sum(CASE interaction_type {kinds} END) AS w FROM {source} GROUP BY user_id, product_id)"
        )
        # One row per user: both vectors are looked up by their user, so no pair is made that was not asked for.
        vectors = f"(SELECT user_id, sum(w * w) AS norm, collect_list(named_struct('p', product_id, 'w', w)) AS entries FROM {weights} GROUP BY user_id)"
        # In the entries of both, sorted by product, a product that both have stands beside itself.
        begin = "named_struct('p', CAST(NULL AS STRING), 'w', 0L, 'dot', 0L)"
        step = "named_struct('p', e.p, 'w', e.w, 'dot', s.dot + if(s.p = e.p, coalesce(s.w * e.w, 0L), 0L))"
        spark.sql(
            "CREATE OR REPLACE TEMPORARY FUNCTION cosine_of(entries ARRAY<STRUCT<p: STRING, w: BIGINT>>, norm_1 BIGINT, norm_2 BIGINT) RETURNS DOUBLE "
            f"RETURN coalesce(round(aggregate(array_sort(entries), {begin}, (s, e) -> {step}, s -> s.dot) / sqrt(cast(norm_1 AS DOUBLE) * norm_2), 4), 0.0)"
        )
        spark.sql(
            "CREATE OR REPLACE TEMPORARY FUNCTION user_similarity_of(one STRING, other STRING) RETURNS DOUBLE RETURN cosine_of(concat("
            f"(SELECT any_value(entries) FROM {vectors} WHERE user_id = user_similarity_of.one), "
            f"(SELECT any_value(entries) FROM {vectors} WHERE user_id = user_similarity_of.other)), "
            f"(SELECT any_value(norm) FROM {vectors} WHERE user_id = user_similarity_of.one), "
            f"(SELECT any_value(norm) FROM {vectors} WHERE user_id = user_similarity_of.other))"
        )
        made.append("user_similarity_of")
    return made
