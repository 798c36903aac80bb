"""Registered queries: every one runs over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.functions import (
    day_diff,
    minute_diff,
    parameter,
    safe_float,
    safe_int,
    segment,
    with_json,
    with_variant,
)
from clickmart.operators import (
    check_not_null,
    check_unique,
    insert_ignore,
    lead_by_key,
    observed,
    upsert,
)
from clickmart.operators.materialize import checkpoint_root
from clickmart.plans import (
    catalog,
    category_recs,
    daily_store,
    marts,
    profiles,
    recommend,
    serving,
    similarity,
    warehouse,
)
from clickmart.schema import DAILY_METRICS_SCHEMA, EVENT_TYPES, WIRE_SCHEMA, conform
from clickmart.sinks import (
    flat_items,
    publish_events,
    read_buckets,
    recency_items,
    recommendation_items,
    segment_items,
    upsert_buckets,
    write_buckets,
    write_version,
)
from clickmart.sources import (
    decode_events,
    encode_events,
    judge_messages,
    migrate_events,
    migrate_profiles,
    read_event_stream,
    read_events_csv,
    read_lake,
    star_schema,
    valid_events,
)
from clickmart.streaming import (
    compact_features,
    read_features,
    start_feature_refresh,
    start_ingest,
    start_rejects,
)

AS_OF = "2024-02-01"
REFRESH_DAY = "2024-01-15"


def tidy(df: DataFrame) -> DataFrame:
    """Comparable output: every whole number as BIGINT."""
    columns = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.IntegerType):
            c = c.cast("long")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def six_decimals(df: DataFrame, column: str) -> DataFrame:
    """For averages of doubles, whose last digits depend on the order of summation."""
    return df.withColumn(column, F.round(column, 6))


class Inputs:
    """The frames that several queries start from. All lazy."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def scratch(self, name: str) -> str:
        return f"{checkpoint_root(self.spark)}/{name}-{uuid.uuid4().hex}"

    @cached_property
    def lake(self) -> DataFrame:
        """Events of all types."""
        return star_schema.clickstream(self.spark, self.directory)

    @cached_property
    def events(self) -> DataFrame:
        """Events of the types that the marts are made of."""
        return star_schema.clickstream(self.spark, self.directory, EVENT_TYPES)

    @cached_property
    def history(self) -> DataFrame:
        return star_schema.purchase_history(self.spark, self.directory)

    @cached_property
    def staging(self) -> dict[str, DataFrame]:
        return warehouse.staging(self.lake)

    @cached_property
    def profile(self) -> DataFrame:
        return profiles.customer_360(self.lake)

    @cached_property
    def behavior(self) -> DataFrame:
        return marts.user_behavior(self.events)

    @cached_property
    def segments(self) -> DataFrame:
        return profiles.user_segments(self.profile)

    @cached_property
    def analytics(self) -> DataFrame:
        s = self.staging
        return marts.product_analytics(s["view"], s["cart"], s["purchase"])

    @cached_property
    def interactions(self) -> DataFrame:
        return similarity.interactions_from_events(self.events)

    @cached_property
    def history_interactions(self) -> DataFrame:
        return similarity.interactions_from_events(self.history)

    @cached_property
    def features(self) -> DataFrame:
        plain = profiles.user_behavior_features(self.interactions)
        return profiles.with_favorites(plain, self.profile)

    @cached_property
    def products(self) -> DataFrame:
        catalogue = star_schema.catalogue(self.spark, self.directory)
        return recommend.product_features(catalogue, self.events)

    @cached_property
    def category_recs(self) -> DataFrame:
        top = category_recs.category_top_products(self.events)
        return category_recs.recommend_by_category(self.profile, top, AS_OF)

    @cached_property
    def flat_recs(self) -> DataFrame:
        return category_recs.flat_recommendations(self.category_recs)

    @cached_property
    def outcomes(self) -> DataFrame:
        return recommend.mark_outcomes(self.flat_recs, self.events)

    @cached_property
    def summary(self) -> DataFrame:
        mart = recommend.recommendation_summary(self.features, self.outcomes)
        return six_decimals(mart, "avg_recommendation_score")

    @cached_property
    def popularity(self) -> DataFrame:
        return recommend.popularity_recs(self.features, self.products, self.interactions)

    @cached_property
    def co_buyers(self) -> DataFrame:
        """Pairs of users who came to the same product one after the other."""
        order = ["interaction_time", "user_id", "interaction_type"]
        visits = self.interactions.select("product_id", *order)
        steps = lead_by_key(visits, "product_id", order, "user_id", "user_2")
        return steps.where("user_2 <> user_id").select(
            F.col("user_id").alias("user_1"), "user_2"
        )


Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


EVENT_COLUMNS = [
    "event_time",
    "event_type",
    "product_id",
    "price",
    "brand",
    "category_code",
    "user_id",
]


# Sources, lake and staging


@query
def ingest_roundtrip(i: Inputs) -> DataFrame:
    return valid_events(decode_events(encode_events(i.lake))).select(*EVENT_COLUMNS)


@query
def stream_ingest(i: Inputs) -> DataFrame:
    wire, lake, checkpoint = (i.scratch(n) for n in ("wire", "lake", "ingest"))
    publish_events(i.lake, path=wire)
    start_ingest(read_event_stream(i.spark, path=wire), lake, checkpoint, None).awaitTermination()
    return read_lake(i.spark, lake).select(*EVENT_COLUMNS)


def messages(i: Inputs) -> DataFrame:
    """All events as messages, of which some are cut short and some have lost their user."""
    cut = encode_events(i.lake.where("event_id % 50 = 0")).select(F.expr("left(value, 40)").alias("value"))
    lost = encode_events(i.lake.where("event_id % 50 = 1").withColumn("user_id", F.lit(None).cast("string")))
    return encode_events(i.lake.where("event_id % 50 > 1")).unionByName(cut).unionByName(lost)


def by_reason(judged: DataFrame) -> DataFrame:
    reason = F.coalesce("reason", F.lit("accepted")).alias("outcome")
    return judged.groupBy(reason).agg(F.count("*").alias("messages"))


@query
def judged_messages(i: Inputs) -> DataFrame:
    """Messages by what becomes of them."""
    return by_reason(judge_messages(messages(i)))


@query
def rejected_stream(i: Inputs) -> DataFrame:
    """The same from the lake and the place of rejected messages, after both queries have run."""
    wire, lake, kept = (i.scratch(n) for n in ("wire", "lake", "rejected"))
    messages(i).write.text(wire)
    stream = read_event_stream(i.spark, path=wire)
    start_ingest(stream, lake, i.scratch("ingest"), None).awaitTermination()
    start_rejects(stream, kept, i.scratch("rejects"), None).awaitTermination()
    taken = read_lake(i.spark, lake).select(F.lit(None).cast("string").alias("reason"))
    return by_reason(taken.unionByName(i.spark.read.schema("reason string").json(kept)))


@query
def csv_dumps(i: Inputs) -> DataFrame:
    """Events written as dumps whose columns stand in different orders, and read back by header."""
    wire = encode_events(i.lake).select(F.from_json("value", WIRE_SCHEMA).alias("e")).select("e.*")
    dumps = i.scratch("dumps")
    for part, names in enumerate((wire.columns, wire.columns[::-1])):
        own = wire.where(F.pmod(F.xxhash64("user_id", "event_time"), F.lit(2)) == part)
        own.select(*names).write.option("header", True).option("escape", '"').csv(f"{dumps}/{part}")
    read = read_events_csv(i.spark, [f"{dumps}/0", f"{dumps}/1"])
    events = decode_events(read.select(F.to_json(F.struct("*")).alias("value")))
    return valid_events(events).select(*EVENT_COLUMNS)


@query
def event_parameters(i: Inputs) -> DataFrame:
    """The JSON of the events stored as VARIANT, filtered by a value inside, and written back as JSON."""
    stored = i.scratch("parameters")
    given = i.spark.read.parquet(f"{i.directory}/events.parquet").select("event_id", "props")
    with_variant(given, "props").write.parquet(stored)
    found = i.spark.read.parquet(stored).withColumn("k", parameter("props", "$.k", "bigint")).where("k % 3 = 1")
    return with_json(found, "props")


@query
def lake_view_partition(i: Inputs) -> DataFrame:
    lake = i.scratch("lake")
    i.lake.write.partitionBy("event_type").parquet(lake)
    return read_lake(i.spark, lake, ["view"]).select(*EVENT_COLUMNS)


@query
def migrated_events(i: Inputs) -> DataFrame:
    return marts.combined_events(*[migrate_events(df) for df in i.staging.values()])


@query
def migrated_profiles(i: Inputs) -> DataFrame:
    moved = migrate_profiles(i.profile)
    return moved.withColumn("user_id", F.col("user_id").cast("long"))


@query
def combined_events(i: Inputs) -> DataFrame:
    return marts.combined_events(*i.staging.values())


@query
def union_distinct_products(i: Inputs) -> DataFrame:
    return marts.distinct_products(*i.staging.values())


@query
def safe_numbers(i: Inputs) -> DataFrame:
    return i.lake.select(
        "event_id",
        safe_int(F.col("price")).alias("whole"),
        safe_float(F.col("price")).alias("amount"),
        safe_int(F.col("product_id")).alias("product_number"),
        segment(F.col("price") * 10).alias("price_segment"),
    )


# Profiles and segments


@query
def customer_360_rank(i: Inputs) -> DataFrame:
    return i.profile


@query
def customer_360_mode(i: Inputs) -> DataFrame:
    return profiles.customer_360(i.lake, "mode")


@query
def customer_360_max(i: Inputs) -> DataFrame:
    return profiles.customer_360(i.events, "max")


@query
def user_segments(i: Inputs) -> DataFrame:
    return i.segments


@query
def user_segments_activity(i: Inputs) -> DataFrame:
    return profiles.user_segments_with_activity(i.behavior, i.profile)


@query
def segment_distribution(i: Inputs) -> DataFrame:
    return profiles.segment_distribution(i.segments)


@query
def segment_export(i: Inputs) -> DataFrame:
    return profiles.segment_export(i.events, i.segments, AS_OF)


@query
def user_behavior_features(i: Inputs) -> DataFrame:
    return i.features


@query
def streamed_features(i: Inputs) -> DataFrame:
    source, root, checkpoint = (i.scratch(n) for n in ("interactions", "features", "refresh"))
    i.interactions.write.parquet(source)
    stream = i.spark.readStream.schema(i.interactions.schema).option("maxFilesPerTrigger", 4)
    start_feature_refresh(stream.parquet(source), root, checkpoint, None).awaitTermination()
    return read_features(i.spark, root)


@query
def features_over_checkpoints(i: Inputs) -> DataFrame:
    """Features of two streams, the second with a new checkpoint and only messages that the first has not seen."""
    root, table = i.scratch("features"), i.scratch("compacted")
    early = F.col("interaction_time") < REFRESH_DAY
    for part in (i.interactions.where(early), i.interactions.where(~early | F.col("interaction_time").isNull())):
        source = i.scratch("interactions")
        part.write.parquet(source)
        stream = i.spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 4).parquet(source)
        start_feature_refresh(stream, root, i.scratch("refresh"), None).awaitTermination()
        compact_features(i.spark, root, table)
    return read_features(i.spark, root)


# Marts


@query
def product_popularity(i: Inputs) -> DataFrame:
    return marts.product_popularity(i.events)


@query
def user_behavior(i: Inputs) -> DataFrame:
    return i.behavior


@query
def category_performance(i: Inputs) -> DataFrame:
    return marts.category_performance(i.events)


@query
def top_categories(i: Inputs) -> DataFrame:
    return marts.top_categories(i.events)


@query
def daily_performance(i: Inputs) -> DataFrame:
    return marts.daily_performance(i.events)


@query
def daily_metrics(i: Inputs) -> DataFrame:
    return marts.daily_metrics(i.events)


@query
def refresh_daily_metrics(i: Inputs) -> DataFrame:
    stale = marts.daily_metrics(i.events).withColumn("total_users", F.lit(0).cast("long"))
    target = conform(stale, DAILY_METRICS_SCHEMA)
    return warehouse.refresh_daily_metrics(target, i.events, REFRESH_DAY)


@query
def brand_performance(i: Inputs) -> DataFrame:
    return marts.brand_performance(i.events)


@query
def user_journey(i: Inputs) -> DataFrame:
    return marts.user_journey(i.events)


@query
def product_affinity(i: Inputs) -> DataFrame:
    return marts.product_affinity(i.events)


@query
def product_affinity_split(i: Inputs) -> DataFrame:
    """The same with more ranges than a task would choose, so that many users reach over several."""
    return marts.product_affinity(i.events, ranges=97)


@query
def product_catalog(i: Inputs) -> DataFrame:
    return marts.product_catalog(i.events, AS_OF)


@query
def product_analytics(i: Inputs) -> DataFrame:
    return i.analytics


@query
def brand_analytics(i: Inputs) -> DataFrame:
    mart = marts.brand_analytics(i.analytics, i.staging["purchase"])
    return six_decimals(mart, "avg_product_price")


@query
def category_analytics(i: Inputs) -> DataFrame:
    mart = marts.category_analytics(i.analytics, i.staging["purchase"])
    return six_decimals(mart, "avg_product_price")


# Recommendations


@query
def category_recs_list(i: Inputs) -> DataFrame:
    return i.category_recs.select(
        "user_id",
        F.array_join("recommended_products", ",").alias("recommended_products"),
        "recommendation_reason",
        "recommendation_date",
    )


@query
def category_recs_scored(i: Inputs) -> DataFrame:
    top = category_recs.category_top_products(i.events, tie_break="avg_price")
    scored = category_recs.recommend_by_category(i.profile, top, AS_OF)
    return scored.select(
        "user_id",
        F.array_join("recommended_products", ",").alias("recommended_products"),
        "recommendation_score",
    )


@query
def refresh_recommendations(i: Inputs) -> DataFrame:
    fresh = warehouse.refresh_recommendations(i.profile, i.events, AS_OF)
    return fresh.select(
        "user_id", F.array_join("recommended_products", ",").alias("recommended_products")
    )


@query
def flat_recommendations(i: Inputs) -> DataFrame:
    return i.flat_recs


@query
def interactions(i: Inputs) -> DataFrame:
    return i.interactions


@query
def user_similarity_rows(i: Inputs) -> DataFrame:
    return similarity.user_similarity(i.interactions, i.co_buyers, "rows")


@query
def user_similarity_vector(i: Inputs) -> DataFrame:
    return similarity.user_similarity(i.interactions, i.co_buyers, "vector")


@query
def similar_users(i: Inputs) -> DataFrame:
    return similarity.similar_users(i.interactions)


@query
def similar_users_rows(i: Inputs) -> DataFrame:
    return similarity.similar_users(i.interactions, mode="rows")


@query
def similar_users_probed(i: Inputs) -> DataFrame:
    """The same with all but the rarest products searched from their strongest users down."""
    return similarity.similar_users(i.interactions, block=20)


@query
def content_based(i: Inputs) -> DataFrame:
    return recommend.content_based(i.features, i.products)


@query
def collaborative_all(i: Inputs) -> DataFrame:
    return recommend.collaborative(i.interactions, exclude_seen=False)


@query
def collaborative_for_best_customers(i: Inputs) -> DataFrame:
    """The same for the ten users who spent most."""
    best = i.profile.orderBy(F.desc_nulls_last("total_spend"), "user_id").limit(10)
    return recommend.collaborative(i.interactions, neighbors=10, targets=best)


def built(i: Inputs) -> tuple[str, DataFrame]:
    """Folder and counts of a warehouse built from a lake of all given events."""
    lake, out = i.scratch("lake"), i.scratch("warehouse")
    i.lake.write.partitionBy("event_type").parquet(lake)
    ratings = star_schema.catalogue(i.spark, i.directory)
    return out, warehouse.build_warehouse(i.spark, lake, out, AS_OF, ratings=ratings)


@query
def warehouse_build(i: Inputs) -> DataFrame:
    """Row counts of all tables."""
    return built(i)[1].select("table_name", "row_count")


@query
def sql_similar_users(i: Inputs) -> DataFrame:
    """The SQL function over a stored table of similar users, for one user."""
    out = i.scratch("warehouse")
    write_version(similarity.similar_users(i.interactions), f"{out}/similar_users")
    catalog.publish_functions(i.spark, out)
    return i.spark.sql("SELECT * FROM similar_users_of('7', 10)")


@query
def sql_user_similarity(i: Inputs) -> DataFrame:
    """The SQL function that compares two users, for those who bought the same product."""
    out = i.scratch("warehouse")
    write_version(i.interactions, f"{out}/user_product_interactions")
    catalog.publish_functions(i.spark, out)
    i.co_buyers.select("user_1", "user_2").distinct().createOrReplaceTempView("co_buyers")
    return i.spark.sql("SELECT user_1, user_2, user_similarity_of(user_1, user_2) AS similarity_score FROM co_buyers")


@query
def stored_views(i: Inputs) -> DataFrame:
    """Rows and sums behind the stored views that reports read."""
    out = i.scratch("warehouse")
    write_version(marts.product_popularity(i.events), f"{out}/product_popularity")
    write_version(i.behavior, f"{out}/user_behavior")
    write_version(marts.user_journey(i.events), f"{out}/user_journey")
    catalog.publish_views(i.spark, out)
    return i.spark.sql(
        "SELECT 'VW_PRODUCT_POPULARITY' AS view_name, count(*) AS row_count, sum(purchase_count) AS total FROM VW_PRODUCT_POPULARITY "
        "UNION ALL SELECT 'VW_USER_BEHAVIOR', count(*), sum(total_events) FROM VW_USER_BEHAVIOR "
        "UNION ALL SELECT 'VW_USER_JOURNEY', count(*), sum(event_count) FROM VW_USER_JOURNEY"
    )


@query
def collaborative_unseen(i: Inputs) -> DataFrame:
    return recommend.collaborative(i.interactions)


@query
def hybrid(i: Inputs) -> DataFrame:
    content = recommend.content_based(i.features, i.products)
    return recommend.hybrid(content, recommend.collaborative(i.interactions, exclude_seen=False))


@query
def popularity_recs(i: Inputs) -> DataFrame:
    return i.popularity


@query
def recommendation_summary(i: Inputs) -> DataFrame:
    return i.summary


@query
def recommendation_performance(i: Inputs) -> DataFrame:
    mart = recommend.recommendation_performance(i.products, i.outcomes)
    return six_decimals(mart, "avg_recommendation_score")


# Marts from parts that are stored by day


def stored_by_day(i: Inputs, parts: Callable[[DataFrame], DataFrame]) -> str:
    """Parts of all events, stored in three steps; the second day of the refresh is stored twice, first without its purchases."""
    root = i.scratch("parts")
    day = F.coalesce(F.to_date("event_time"), F.lit("1970-01-01").cast("date"))
    cut, then = (F.lit(d).cast("date") for d in (REFRESH_DAY, "2024-01-16"))
    late = (day >= cut) & (day <= then)
    for step in (day < cut, late & (F.col("event_type") != "purchase"), day > then, late):
        daily_store.replace_days(parts(i.events.where(step)), root)
    return root


def close(estimate: str, exact: str) -> Column:
    """Whether an estimate is within three percent, four standard errors."""
    return F.abs(F.col(estimate) - F.col(exact)) <= 0.03 * F.col(exact)


@query
def stored_category_performance(i: Inputs) -> DataFrame:
    root = stored_by_day(i, lambda events: daily_store.funnel_parts(events, "category_code"))
    exact = marts.category_performance(i.events).select(
        "category_code", F.col("unique_users").alias("users"), F.col("unique_products").alias("products")
    )
    found = daily_store.category_performance(i.spark, root).join(exact, "category_code", "left")
    return found.select(
        *[c for c in found.columns if c not in ("unique_users", "unique_products", "users", "products")],
        close("unique_users", "users").alias("users_close"),
        close("unique_products", "products").alias("products_close"),
    )


@query
def stored_brand_span(i: Inputs) -> DataFrame:
    """Brands from the tenth to the nineteenth of the month."""
    root = stored_by_day(i, lambda events: daily_store.funnel_parts(events, "brand"))
    found = daily_store.brand_performance(i.spark, root, "2024-01-10", "2024-01-20")
    return found.drop("unique_customers", "unique_products")


@query
def stored_daily_metrics(i: Inputs) -> DataFrame:
    root = stored_by_day(i, daily_store.funnel_parts)
    exact = marts.daily_metrics(i.events).select("metric_date", F.col("total_users").alias("users"))
    found = daily_store.daily_metrics(i.spark, root).join(exact, "metric_date", "left")
    return found.withColumn("users_close", close("total_users", "users")).drop("total_users", "users")


@query
def stored_category_recs(i: Inputs) -> DataFrame:
    root = stored_by_day(i, daily_store.sales_parts)
    top = daily_store.category_top_products(i.spark, root, tie_break="avg_price")
    return top.withColumn("recommended_products", F.array_join("recommended_products", ","))


# Serving shapes, upserts and checks


@query
def segment_item_export(i: Inputs) -> DataFrame:
    return segment_items(i.segments, AS_OF)


@query
def recommendation_item_export(i: Inputs) -> DataFrame:
    items = recommendation_items(i.category_recs, AS_OF)
    as_text = F.array_join(F.col("recommended_products").cast("array<string>"), ",")
    return items.withColumn("recommended_products", as_text)


@query
def flat_item_export(i: Inputs) -> DataFrame:
    return flat_items(i.flat_recs, AS_OF)


@query
def recency_item_export(i: Inputs) -> DataFrame:
    return recency_items(profiles.segment_export(i.events, i.segments, AS_OF), AS_OF)


@query
def upsert_rows(i: Inputs) -> DataFrame:
    """Yesterday's behaviour with the users who bought replaced by the whole history."""
    before = marts.user_behavior(i.events.where(F.col("event_time") < REFRESH_DAY))
    return upsert(before, i.behavior.where("purchase_count > 10"), ["user_id"])


@query
def upsert_update_cols(i: Inputs) -> DataFrame:
    before = marts.user_behavior(i.events.where(F.col("event_time") < REFRESH_DAY))
    return upsert(before, i.behavior, ["user_id"], ["total_spend", "last_seen"])


@query
def bucketed_upsert(i: Inputs) -> DataFrame:
    """The same as ``upsert_rows`` in a table that rewrites only the buckets it touches."""
    root = i.scratch("buckets")
    write_buckets(marts.user_behavior(i.events.where(F.col("event_time") < REFRESH_DAY)), root, ["user_id"], 64)
    upsert_buckets(i.behavior.where("purchase_count > 10"), root, i.behavior.schema)
    return read_buckets(i.spark, root, i.behavior.schema)


@query
def insert_ignored(i: Inputs) -> DataFrame:
    early = i.interactions.where(F.col("interaction_time") < REFRESH_DAY)
    keys = ["user_id", "product_id", "interaction_type"]
    first = early.groupBy(*keys).agg(F.min("interaction_time").alias("interaction_time"))
    known = i.interactions.groupBy(*keys).agg(F.max("interaction_time").alias("interaction_time"))
    return insert_ignore(first, known, keys)


@query
def time_between(i: Inputs) -> DataFrame:
    """Calendar days and minutes from a user's first view to the last purchase."""
    first = F.min(F.when(F.col("event_type") == "view", F.col("event_time")))
    last = F.max(F.when(F.col("event_type") == "purchase", F.col("event_time")))
    return i.events.groupBy("user_id").agg(
        day_diff(first, last).alias("days"), minute_diff(first, last).alias("minutes")
    )


@query
def high_value_users(i: Inputs) -> DataFrame:
    return serving.high_value_users(i.behavior)


@query
def last_7_days(i: Inputs) -> DataFrame:
    return serving.last_days(marts.daily_performance(i.events), "2024-01-31")


@query
def user_recs_lookup(i: Inputs) -> DataFrame:
    return serving.recommendations_of(i.flat_recs, "7")


@query
def top_products_of_category(i: Inputs) -> DataFrame:
    return serving.top_products_of(marts.product_popularity(i.events), "ECONOMY")


@query
def most_popular_products(i: Inputs) -> DataFrame:
    return serving.most_popular_products(i.products)


@query
def top_spenders(i: Inputs) -> DataFrame:
    return serving.top_spenders(i.features)


@query
def best_served_users(i: Inputs) -> DataFrame:
    return serving.best_served_users(i.summary)


@query
def strongest_recommendations(i: Inputs) -> DataFrame:
    return serving.strongest_recommendations(i.popularity)


@query
def row_count_report(i: Inputs) -> DataFrame:
    """Rows of some tables, counted while they are written; each is made of those written before it."""
    counts = []

    def save(name: str, df: DataFrame) -> DataFrame:
        rows, seen = observed(df)
        path = i.scratch(name)
        rows.write.parquet(path)
        counts.append((name, seen.get["row_count"]))
        return i.spark.read.schema(df.schema).parquet(path)

    events = save("combined_events", i.events)
    profile = save("customer_360", i.profile)
    save("user_segments", profiles.user_segments(profile))
    top = category_recs.category_top_products(events)
    save("category_recommendations", category_recs.recommend_by_category(profile, top, AS_OF))
    save("daily_metrics", marts.daily_metrics(events))
    save("product_catalog", marts.product_catalog(events, AS_OF))
    return i.spark.createDataFrame(counts, "table_name string, row_count long")


@query
def duplicate_keys(i: Inputs) -> DataFrame:
    return check_unique(i.history, ["event_id"])


@query
def null_counts(i: Inputs) -> DataFrame:
    return check_not_null(i.lake, ["user_id", "price", "brand", "category_code"])


# The same marts over the line items, ten times the rows and many more users and products


@query
def history_customer_360(i: Inputs) -> DataFrame:
    return profiles.customer_360(i.history)


@query
def history_product_popularity(i: Inputs) -> DataFrame:
    return marts.product_popularity(i.history)


@query
def history_user_behavior(i: Inputs) -> DataFrame:
    return marts.user_behavior(i.history)


@query
def history_category_performance(i: Inputs) -> DataFrame:
    return marts.category_performance(i.history)


@query
def history_product_affinity(i: Inputs) -> DataFrame:
    return marts.product_affinity(i.history)


@query
def history_category_recs(i: Inputs) -> DataFrame:
    top = category_recs.category_top_products(i.history, tie_break="avg_price")
    return top.withColumn("recommended_products", F.array_join("recommended_products", ","))


@query
def history_similar_users(i: Inputs) -> DataFrame:
    return similarity.similar_users(i.history_interactions)


@query
def history_collaborative(i: Inputs) -> DataFrame:
    return recommend.collaborative(i.history_interactions)


def _runner(function: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        return tidy(function(Inputs(spark, directory)))

    run.__name__ = function.__name__
    return run


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(function) for name, function in QUERIES.items()}
