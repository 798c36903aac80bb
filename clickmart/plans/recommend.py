"""Content-based, collaborative, hybrid and popularity recommendations, for all users at once."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.functions import guarded_ratio
from clickmart.operators.blocks import add_up
from clickmart.operators.materialize import materialize
from clickmart.operators.ordered import number_rows
from clickmart.operators.ranking import top_n
from clickmart.plans.similarity import similar_users, write_vectors

# Weights and reasons of the recommenders.
RATING_WEIGHT = Decimal("0.4")
POPULARITY_WEIGHT = Decimal("0.6")
CONTENT_WEIGHT = Decimal("0.3")
COLLABORATIVE_WEIGHT = Decimal("0.7")
CONFIDENCE_FACTOR = Decimal("0.9")
CONTENT_REASON = "Content-based: High rating and popularity"
COLLABORATIVE_REASON = "Collaborative: Similar users liked this"
HYBRID_REASON = "Hybrid: Combined content and collaborative filtering"
POPULARITY_REASON = "Popularity-based recommendation"


def _exact(score: Column) -> Column:
    """Scores have four decimals; as decimals their weighted sums round the same way everywhere."""
    return score.cast("decimal(12,4)")


def _weighted(first: Column, weight_1: Decimal, second: Column, weight_2: Decimal) -> Column:
    total = _exact(first) * F.lit(weight_1) + _exact(second) * F.lit(weight_2)
    return F.round(total, 4).cast("double")


def product_features(catalogue: DataFrame, events: DataFrame) -> DataFrame:
    """Features of every product of the catalogue, which brings their ratings (``avg_rating``) along.

    Popularity is the share of the best seller's purchases, and views stand for reviews. Products
    that no event names have neither.
    """
    counts = (
        events.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count_if(F.col("event_type") == "purchase").alias("purchases"),
            F.count_if(F.col("event_type") == "view").alias("views"),
        )
    )
    top = counts.agg(F.max("purchases").alias("top_purchases"))
    share = F.round(F.try_divide("purchases", F.col("top_purchases")), 4)
    return (
        catalogue.join(counts, "product_id", "left")
        .withColumn("top_purchases", top.scalar())
        .select(
            "product_id",
            "brand",
            "category_code",
            "price",
            "avg_rating",
            F.coalesce("views", F.lit(0)).cast("long").alias("total_reviews"),
            F.coalesce(share, F.lit(0.0)).alias("popularity_score"),
        )
    )


def content_based(features: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Best rated and most popular products of a user's favourite category or brand.

    The score belongs to the product, so the best of a category or brand are found once and not
    per user: whatever is among a user's top ``k`` is among the top ``k`` of one of the two lists.
    """
    score = _weighted(
        F.col("avg_rating"), RATING_WEIGHT, F.col("popularity_score"), POPULARITY_WEIGHT
    )
    scored = products.select("product_id", "category_code", "brand", score.alias("score"))
    # Sorts by score downwards with missing scores last, then by product.
    entry = F.struct(
        F.col("score").isNull().alias("unscored"),
        (-F.col("score")).alias("low_first"),
        F.col("product_id"),
        F.col("score"),
    )

    def best_of(key: str, favorite: str, alias: str) -> DataFrame:
        order = [F.desc_nulls_last("score"), F.asc("product_id")]
        known = scored.where(F.col(key).isNotNull())
        return (
            top_n(known, [key], order, k, "rank")
            .groupBy(F.col(key).alias(favorite))
            .agg(F.collect_list(entry).alias(alias))
        )

    by_category = best_of("category_code", "favorite_category", "category_best")
    by_brand = best_of("brand", "favorite_brand", "brand_best")
    none = F.array().cast(by_brand.schema["brand_best"].dataType)
    both = F.concat(F.coalesce("category_best", none), F.coalesce("brand_best", none))
    return (
        features.select("user_id", "favorite_category", "favorite_brand")
        .join(by_category, "favorite_category", "left")
        .join(by_brand, "favorite_brand", "left")
        .select(
            "user_id",
            F.posexplode(F.slice(F.array_sort(F.array_distinct(both)), 1, k)).alias("i", "item"),
        )
        .select(
            "user_id",
            F.col("item.product_id").alias("product_id"),
            F.col("item.score").alias("recommendation_score"),
            F.lit(CONTENT_REASON).alias("reason"),
            (F.col("i") + 1).cast("long").alias("rank"),
        )
    )


def collaborative(
    interactions: DataFrame,
    k: int = 10,
    neighbors: int = 20,
    exclude_seen: bool = True,
    mode: str = "vector",
    neighborhood: DataFrame | None = None,
    targets: DataFrame | None = None,
) -> DataFrame:
    """Products that similar users interacted with, by average similarity times strength.

    ``exclude_seen`` leaves out what the user knows already. Pass ``neighborhood`` (the result of
    ``similar_users``) to use it for several calls. ``targets`` (a frame with ``user_id``) asks for these
    users only: then only what they and their neighbours did is read after the neighbours are known.

    Interactions are added up and written once. What the neighbours of a user did meets inside tasks (``add_up``) and is never
    rows that Spark exchanges, only the best ``k`` of a user are.
    """
    vectors = write_vectors(interactions)
    if targets is not None:
        targets = targets.select("user_id").distinct()
    if neighborhood is None:
        neighborhood = materialize(similar_users(None, neighbors, mode, targets, vectors=vectors))
    elif targets is not None:
        neighborhood = materialize(neighborhood.join(targets, "user_id", "left_semi"))
    liked = vectors
    if targets is not None:
        involved = targets.union(neighborhood.select("similar_user_id")).distinct()
        liked = materialize(vectors.join(involved, "user_id", "left_semi"))
    # Places follow the order of the products, which decides among equal scores; 0 stands for none.
    known = liked.select("product_id").where("product_id IS NOT NULL").distinct()
    products = materialize(number_rows(known, [F.asc("product_id")], "column"))
    entries = liked.join(products, "product_id", "left").select(
        F.col("user_id").alias("user"),
        F.coalesce("column", F.lit(0)).cast("long").alias("column"),
        "weight",
        F.col("interactions").alias("rows"),
    )
    # Similarities have four decimals. Counting in ten-thousandths keeps the average exact.
    units = F.round(F.col("similarity_score") * 10000).cast("long")
    near = neighborhood.select(
        F.col("user_id").alias("target"),
        F.col("similar_user_id").alias("other"),
        units.alias("units"),
    )
    best = add_up(near, entries, k, exclude_seen)
    scored = best.join(products, "column", "left").withColumnRenamed("target", "user_id")
    scored = scored.withColumn("recommendation_score", F.col("score") / F.lit(10000.0))
    order = [F.desc("recommendation_score"), F.asc("product_id")]
    return top_n(scored, ["user_id"], order, k, "rank").select(
        "user_id",
        "product_id",
        "recommendation_score",
        F.lit(COLLABORATIVE_REASON).alias("reason"),
        F.col("rank").cast("long").alias("rank"),
    )


def hybrid(
    content: DataFrame,
    collab: DataFrame,
    k: int = 10,
    w_content: Decimal = CONTENT_WEIGHT,
    w_collab: Decimal = COLLABORATIVE_WEIGHT,
    targets: DataFrame | None = None,
) -> DataFrame:
    """Content recommendations, weighted with their collaborative score (0 if they have none).

    ``targets`` (a frame with ``user_id``) asks for these users only.
    """
    if targets is not None:
        content = content.join(targets.select("user_id").distinct(), "user_id", "left_semi")
    content = content.select(
        "user_id", "product_id", F.col("recommendation_score").alias("content_score")
    )
    collab = collab.select(
        "user_id", "product_id", F.col("recommendation_score").alias("collab_score")
    )
    score = _weighted(
        F.col("content_score"), w_content, F.coalesce("collab_score", F.lit(0.0)), w_collab
    )
    combined = content.join(collab, ["user_id", "product_id"], "left").withColumn(
        "recommendation_score", score
    )
    order = [F.desc_nulls_last("recommendation_score"), F.asc("product_id")]
    return top_n(combined, ["user_id"], order, k, "rank").select(
        "user_id",
        "product_id",
        "recommendation_score",
        F.lit(HYBRID_REASON).alias("reason"),
        F.col("rank").cast("long").alias("rank"),
    )


def popularity_recs(
    users: DataFrame,
    products: DataFrame,
    interactions: DataFrame,
    k: int = 5,
    jitter: float | None = None,
    seed: int = 0,
    model_id: int = 1,
) -> DataFrame:
    """The most popular products a user has not touched yet.

    The catalogue is numbered by popularity once. The places that a user has touched, in order, leave
    gaps between them; the first ``k`` places in the gaps are the answer, however much of the
    catalogue the user knows.

    ``jitter=0.2`` spreads the score by up to a fifth either way, by seed and not by run.
    """
    by_popularity = [F.desc_nulls_last("popularity_score"), F.asc("product_id")]
    ranked = number_rows(products.select("product_id", "popularity_score"), by_popularity, "place")
    users = users.select("user_id").distinct()
    touched = (
        interactions.select("user_id", "product_id")
        .join(ranked.select("product_id", "place"), "product_id")
        .select("user_id", "place")
        .distinct()
        .join(users, "user_id", "left_semi")
    )
    end = ranked.agg(F.coalesce(F.max("place"), F.lit(0)) + 1).scalar()
    along = Window.partitionBy("user_id").orderBy("place")
    number = F.row_number().over(along)
    low = F.coalesce(F.lag("place").over(along), F.lit(0).cast("long"))
    # Up to the number-th touched place there are place - number others, and low + 1 - number before the gap.
    gaps = touched.union(users.withColumn("place", end)).select(
        "user_id", "place", low.alias("low"), (low + 1 - number).alias("have")
    )
    taken = F.least(F.col("place") - F.col("low") - 1, F.lit(k) - F.col("have"))
    free = F.sequence(F.lit(1).cast("long"), taken)
    picked = (
        gaps.where(taken > 0)
        .select("user_id", "low", "have", F.explode(free).alias("i"))
        .select("user_id", (F.col("low") + F.col("i")).alias("place"), (F.col("have") + F.col("i")).alias("rank"))
        .join(ranked, "place")
    )
    score = _exact(F.coalesce(F.round("popularity_score", 4), F.lit(0.0)))
    if jitter is not None:
        noise = F.pmod(F.xxhash64("user_id", "product_id", F.lit(seed)), F.lit(1_000_000)) / 1e6
        score = _exact(F.round(score.cast("double") * (1 - jitter + 2 * jitter * noise), 4))
    return picked.select(
        "user_id",
        "product_id",
        F.lit(model_id).alias("model_id"),
        score.cast("double").alias("recommendation_score"),
        F.round(score * F.lit(CONFIDENCE_FACTOR), 4).cast("double").alias("confidence_score"),
        F.lit(POPULARITY_REASON).alias("recommendation_reason"),
        F.col("rank").cast("long").alias("rank_position"),
    )


def recommendation_summary(features: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Recommendations, clicks and purchases per user, users without any included."""
    counts = recommendations.groupBy("user_id").agg(
        F.count("*").alias("total_recommendations"),
        F.avg("recommendation_score").alias("avg_recommendation_score"),
        F.count_if("is_clicked").alias("clicked_recommendations"),
        F.count_if("is_purchased").alias("purchased_recommendations"),
    )
    return (
        features.select("user_id", "favorite_category", "favorite_brand")
        .join(counts, "user_id", "left")
        .fillna(
            0, ["total_recommendations", "clicked_recommendations", "purchased_recommendations"]
        )
    )


def recommendation_performance(products: DataFrame, recommendations: DataFrame) -> DataFrame:
    """How often each product was recommended, clicked and bought, products without any included."""
    counts = recommendations.groupBy("product_id").agg(
        F.count("*").alias("times_recommended"),
        F.avg("recommendation_score").alias("avg_recommendation_score"),
        F.count_if("is_clicked").alias("times_clicked"),
        F.count_if("is_purchased").alias("times_purchased"),
    )
    return (
        products.select("product_id", "brand", "category_code", "avg_rating", "popularity_score")
        .join(counts, "product_id", "left")
        .fillna(0, ["times_recommended", "times_clicked", "times_purchased"])
        .withColumn(
            "conversion_rate", guarded_ratio(F.col("times_purchased"), F.col("times_recommended"))
        )
    )


def mark_outcomes(recommendations: DataFrame, events: DataFrame) -> DataFrame:
    """Flag recommendations the user viewed (clicked) or bought."""
    outcome = (
        events.where(F.col("event_type").isin("view", "purchase"))
        .groupBy("user_id", "product_id")
        .agg(
            F.bool_or(F.col("event_type") == "view").alias("is_clicked"),
            F.bool_or(F.col("event_type") == "purchase").alias("is_purchased"),
        )
    )
    return recommendations.join(outcome, ["user_id", "product_id"], "left").fillna(
        False, ["is_clicked", "is_purchased"]
    )
