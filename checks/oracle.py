"""SQL twins of the registered queries, in the dialect of the checking database.

Named fragments build on one another; a query lists the ones it needs and the final SELECT.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-02-01'"
REFRESH_DAY = "TIMESTAMP '2024-01-15'"


def money(condition: str = "TRUE", column: str = "price", otherwise: str = "NULL") -> str:
    exact = f"CAST({column} AS DECIMAL(12,2))"
    return f"CAST(sum(CASE WHEN {condition} THEN {exact} ELSE {otherwise} END) AS DOUBLE)"


def average(condition: str = "TRUE", column: str = "price") -> str:
    return f"{money(condition, column)} / nullif(count(CASE WHEN {condition} THEN {column} END), 0)"


def ratio(n: str, d: str, scale: str = "100.0") -> str:
    return f"CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) * {scale} / {d} ELSE 0 END"


def number_of(event_type: str) -> str:
    return f"count(*) FILTER (event_type = '{event_type}')"


PURCHASE = "event_type = 'purchase'"
REVENUE = money(PURCHASE, otherwise="0")
PURCHASE_AVG = average(PURCHASE)


def ladder(spend: str) -> str:
    return (
        f"CASE WHEN {spend} >= 1000 THEN 'VIP' WHEN {spend} >= 500 THEN 'Premium' "
        f"WHEN {spend} >= 100 THEN 'Regular' ELSE 'New' END"
    )


FRAGMENTS = {
    "lake": """
        SELECT e.event_id, e.ts AS event_time, CAST(e.user_id AS VARCHAR) AS user_id,
               CASE e.event_type WHEN 'click' THEN 'cart' ELSE e.event_type END AS event_type,
               'prod_' || p.p_partkey AS product_id, e.value AS price,
               p.p_brand AS brand, p.p_type AS category_code
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e
        LEFT JOIN part p ON p.p_partkey = e.k""",
    "ev": "SELECT * FROM lake WHERE event_type IN ('view', 'cart', 'purchase')",
    "hist": """
        SELECT l_orderkey * 100 + l_linenumber AS event_id, o_orderdate AS event_time,
               CAST(o_custkey AS VARCHAR) AS user_id, 'purchase' AS event_type,
               'prod_' || l_partkey AS product_id, l_extendedprice AS price,
               p_brand AS brand, p_type AS category_code
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "part_features": f"""
        SELECT 'prod_' || p_partkey AS product_id, p_brand AS brand, p_type AS category_code,
               p_retailprice AS price, CAST(1 + (p_size % 9) * 0.5 AS DOUBLE) AS avg_rating,
               coalesce(round(c.bought / (SELECT max(n) FROM (SELECT {number_of("purchase")} AS n
                   FROM ev GROUP BY product_id)), 4), 0.0) AS popularity_score
        FROM part LEFT JOIN (SELECT product_id, {number_of("purchase")} AS bought
                             FROM ev GROUP BY product_id) c
             ON c.product_id = 'prod_' || p_partkey""",
    "sold": """
        SELECT * FROM part_features
        WHERE product_id IN (SELECT product_id FROM ev WHERE product_id IS NOT NULL)""",
    "seg": f"""
        SELECT user_id, total_spend, total_purchases, favorite_brand, most_viewed_category,
               last_seen_date, {ladder("total_spend")} AS segment FROM prof""",
    "seg_export": f"""
        SELECT s.user_id, s.segment, s.total_purchases, s.total_spend, b.last_purchase_date,
               date_diff('day', b.last_purchase_date, {AS_OF}) AS days_since_last_purchase
        FROM seg s LEFT JOIN (SELECT user_id, max(event_time) AS last_purchase_date FROM ev
                              WHERE {PURCHASE} GROUP BY user_id) b ON b.user_id = s.user_id""",
    "behavior": f"""
        SELECT user_id, count(*) AS total_events, {number_of("purchase")} AS purchase_count,
               {number_of("view")} AS view_count, {number_of("cart")} AS cart_count,
               {REVENUE} AS total_spend, {PURCHASE_AVG} AS avg_purchase_value,
               min(event_time) AS first_seen, max(event_time) AS last_seen,
               date_diff('day', min(event_time), max(event_time)) AS days_active,
               {ratio(number_of("view"), number_of("purchase"))} AS view_to_purchase_ratio
        FROM ev GROUP BY user_id""",
    "earlier": f"""
        SELECT user_id, count(*) AS total_events, {number_of("purchase")} AS purchase_count,
               {number_of("view")} AS view_count, {number_of("cart")} AS cart_count,
               {REVENUE} AS total_spend, {PURCHASE_AVG} AS avg_purchase_value,
               min(event_time) AS first_seen, max(event_time) AS last_seen,
               date_diff('day', min(event_time), max(event_time)) AS days_active,
               {ratio(number_of("view"), number_of("purchase"))} AS view_to_purchase_ratio
        FROM ev WHERE event_time < {REFRESH_DAY} GROUP BY user_id""",
    "popular": f"""
        SELECT product_id, category_code, count(*) AS purchase_count, {average()} AS avg_price,
               {money()} AS total_revenue, count(DISTINCT user_id) AS unique_buyers
        FROM {{events}} WHERE {PURCHASE} AND category_code IS NOT NULL
        GROUP BY product_id, category_code""",
    "daily": f"""
        SELECT CAST(event_time AS DATE) AS event_date,
               count(DISTINCT user_id) AS daily_active_users,
               {number_of("purchase")} AS daily_purchases, {REVENUE} AS daily_revenue,
               {PURCHASE_AVG} AS avg_order_value, {number_of("view")} AS daily_views,
               {number_of("cart")} AS daily_cart_additions,
               {ratio(number_of("purchase"), number_of("view"))} AS daily_conversion_rate
        FROM ev GROUP BY 1""",
    "analytics": f"""
        SELECT product_id, min(brand) AS brand, min(category_code) AS category_code,
               {number_of("view")} AS total_views, {number_of("cart")} AS total_cart_adds,
               {number_of("purchase")} AS total_purchases,
               coalesce({money(PURCHASE)}, 0) AS total_revenue,
               count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS unique_viewers,
               coalesce({money(PURCHASE)}
                   / nullif(count(CASE WHEN {PURCHASE} THEN price END), 0), 0) AS avg_price,
               round(CASE WHEN {number_of("view")} > 0
                     THEN {number_of("purchase")} / {number_of("view")} ELSE 0 END, 4)
                   AS conversion_rate
        FROM ev WHERE product_id IS NOT NULL GROUP BY product_id""",
    "cat_lists": """
        SELECT category_code, string_agg(product_id, ',' ORDER BY rn) AS recommended_products,
               avg(n) AS recommendation_score
        FROM (SELECT *, row_number() OVER (PARTITION BY category_code
                                           ORDER BY n DESC, {tie} product_id) AS rn
              FROM (SELECT category_code, product_id, count(*) AS n,
                           CAST(sum(CAST(price AS DECIMAL(12,2))) AS DOUBLE) / count(price)
                               AS avg_price
                    FROM {events} WHERE event_type = 'purchase' AND category_code IS NOT NULL
                    GROUP BY category_code, product_id))
        WHERE rn <= 5 GROUP BY category_code""",
    "cat_recs": f"""
        SELECT p.user_id, r.recommended_products, r.recommendation_score,
               'Top products in favorite category' AS recommendation_reason,
               {AS_OF} AS recommendation_date
        FROM prof p JOIN cat_lists r ON r.category_code = p.most_viewed_category""",
    "flat": """
        SELECT user_id, unnest(string_split(recommended_products, ',')) AS product_id,
               recommendation_score,
               generate_subscripts(string_split(recommended_products, ','), 1) AS "rank"
        FROM cat_recs""",
    "inter": """
        SELECT DISTINCT user_id, product_id, event_type AS interaction_type,
               CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 2 ELSE 3 END AS strength,
               event_time AS interaction_time
        FROM {events} WHERE product_id IS NOT NULL""",
    "vec": """
        SELECT user_id, product_id, CAST(sum(strength) AS BIGINT) AS w,
               CAST(sum(strength * strength) AS BIGINT) AS sq, count(*) AS n
        FROM inter GROUP BY user_id, product_id""",
    "norm": "SELECT user_id, CAST(sum({square}) AS BIGINT) AS n FROM vec GROUP BY user_id",
    "dots": """
        SELECT a.user_id AS u, b.user_id AS v, CAST(sum(a.w * b.w) AS DOUBLE) AS dot
        FROM vec a JOIN vec b ON a.product_id = b.product_id AND a.user_id <> b.user_id
        GROUP BY 1, 2""",
    "near": """
        SELECT u, v, score, rn FROM (
            SELECT a.user_id AS u, b.user_id AS v,
                   coalesce(round(dot / sqrt(CAST(a.n AS DOUBLE) * b.n), 4), 0.0) AS score,
                   row_number() OVER (PARTITION BY a.user_id
                       ORDER BY coalesce(dot * dot / b.n, 0) DESC, b.user_id) AS rn
            FROM norm a JOIN norm b ON a.user_id <> b.user_id
            LEFT JOIN dots ON dots.u = a.user_id AND dots.v = b.user_id)
        WHERE rn <= {neighbors}""",
    "collab": """
        SELECT user_id, product_id, score, rn FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) rn
            FROM (SELECT u AS user_id, product_id,
                         floor((2 * sum(CAST(round(score * 10000) AS BIGINT) * w) + sum(n))
                               / CAST(2 * sum(n) AS DOUBLE)) / 10000.0 AS score
                  FROM near JOIN vec ON vec.user_id = near.v GROUP BY 1, 2) s
            WHERE {seen})
        WHERE rn <= 10""",
    "features": """
        SELECT i.*, p.most_viewed_category AS favorite_category, p.favorite_brand
        FROM (SELECT user_id, count(*) FILTER (interaction_type = 'view') AS total_views,
                     count(*) FILTER (interaction_type = 'purchase') AS total_purchases,
                     CAST(count(*) FILTER (interaction_type = 'purchase') AS DOUBLE)
                         AS total_spend,
                     max(interaction_time) AS last_activity_date
              FROM inter GROUP BY user_id) i
        LEFT JOIN prof p ON p.user_id = i.user_id""",
    "content": """
        SELECT user_id, product_id, score, rn FROM (
            SELECT f.user_id, p.product_id, p.score,
                   row_number() OVER (PARTITION BY f.user_id
                                      ORDER BY p.score DESC NULLS LAST, p.product_id) AS rn
            FROM features f
            JOIN (SELECT *, CAST(round(CAST(avg_rating AS DECIMAL(12,4)) * 0.4
                                 + CAST(popularity_score AS DECIMAL(12,4)) * 0.6, 4) AS DOUBLE)
                             AS score
                  FROM {products}) p
              ON p.category_code = f.favorite_category OR p.brand = f.favorite_brand)
        WHERE rn <= 10""",
    "pop": """
        SELECT user_id, product_id, popularity_score AS score, rn FROM (
            SELECT f.user_id, p.product_id, p.popularity_score,
                   row_number() OVER (PARTITION BY f.user_id
                                      ORDER BY p.popularity_score DESC, p.product_id) AS rn
            FROM features f CROSS JOIN part_features p
            WHERE NOT EXISTS (SELECT 1 FROM inter i WHERE i.user_id = f.user_id
                                                      AND i.product_id = p.product_id))
        WHERE rn <= 5""",
    "outcomes": """
        SELECT r.*,
               EXISTS (SELECT 1 FROM ev WHERE ev.user_id = r.user_id
                       AND ev.product_id = r.product_id AND event_type = 'view') AS is_clicked,
               EXISTS (SELECT 1 FROM ev WHERE ev.user_id = r.user_id
                       AND ev.product_id = r.product_id AND event_type = 'purchase')
                   AS is_purchased
        FROM flat r""",
    "summary": """
        SELECT f.user_id, f.favorite_category, f.favorite_brand,
               count(r.product_id) AS total_recommendations,
               round(avg(r.recommendation_score), 6) AS avg_recommendation_score,
               count(*) FILTER (r.is_clicked) AS clicked_recommendations,
               count(*) FILTER (r.is_purchased) AS purchased_recommendations
        FROM features f LEFT JOIN outcomes r ON r.user_id = f.user_id GROUP BY 1, 2, 3""",
}

FAVORITE = """
    SELECT user_id, {column} AS favorite FROM (
        SELECT user_id, {column}, row_number() OVER (PARTITION BY user_id
                                                     ORDER BY count(*) DESC, {column}) AS rn
        FROM cleaned WHERE event_type = '{kind}' AND {column} IS NOT NULL
        GROUP BY user_id, {column}) WHERE rn = 1"""


def profile(events: str = "ev", rule: str = "price IS NOT NULL") -> dict[str, str]:
    """Fragments of the profile with counted favourites."""
    brand = FAVORITE.format(column="brand", kind="purchase")
    category = FAVORITE.format(column="category_code", kind="view")
    return {
        "cleaned": f"SELECT * FROM {events} WHERE {rule}",
        "prof": f"""
            SELECT s.user_id, b.favorite AS favorite_brand, c.favorite AS most_viewed_category,
                   m.total_purchases, m.total_spend, s.last_seen_date
            FROM (SELECT user_id, max(event_time) AS last_seen_date
                  FROM cleaned GROUP BY user_id) s
            LEFT JOIN ({brand}) b ON b.user_id = s.user_id
            LEFT JOIN ({category}) c ON c.user_id = s.user_id
            LEFT JOIN (SELECT user_id, count(*) AS total_purchases, {money()} AS total_spend
                       FROM cleaned WHERE {PURCHASE} GROUP BY user_id) m
                   ON m.user_id = s.user_id""",
    }


PLAIN = {
    "events": "ev",
    "tie": "",
    "square": "w * w",
    "neighbors": "10",
    "products": "part_features",
    "seen": "NOT EXISTS (SELECT 1 FROM vec x WHERE x.user_id = s.user_id "
    "AND x.product_id = s.product_id)",
}


def sql(names: str, select: str, **values: str) -> str:
    """WITH the named fragments, in the given order, and then the SELECT."""
    values = PLAIN | values
    parts = []
    for name in names.split():
        if name == "prof":
            people = "lake" if values["events"] == "ev" else values["events"]
            texts = profile(values.get("people", people), values.get("rule", "price IS NOT NULL"))
        elif name == "ev":
            texts = {"lake": FRAGMENTS["lake"], "ev": FRAGMENTS["ev"]}
        else:
            texts = {name: FRAGMENTS[name]}
        for key, text in texts.items():
            for slot in PLAIN:
                text = text.replace("{" + slot + "}", values[slot])
            parts.append(f"{key} AS ({text})")
    for slot in PLAIN:
        select = select.replace("{" + slot + "}", values[slot])
    return "WITH " + ",\n".join(parts) + "\n" + select


EVENT_COLUMNS = "event_time, event_type, product_id, price, brand, category_code, user_id"
SAME_EVENTS = sql("ev", f"SELECT {EVENT_COLUMNS} FROM ev")
WHOLE_LAKE = sql("ev", f"SELECT {EVENT_COLUMNS} FROM lake")
PROFILE_COLUMNS = (
    "user_id, favorite_brand, most_viewed_category, total_purchases, total_spend, last_seen_date"
)
BEHAVIOR_COLUMNS = [
    "total_events",
    "purchase_count",
    "view_count",
    "cart_count",
    "total_spend",
    "avg_purchase_value",
    "first_seen",
    "last_seen",
    "days_active",
    "view_to_purchase_ratio",
]
SIMILAR = (
    "SELECT u AS user_id, v AS similar_user_id, score AS similarity_score, rn AS \"rank\" FROM near"
)
COLLAB = (
    "SELECT user_id, product_id, score AS recommendation_score, "
    "'Collaborative: Similar users liked this' AS reason, rn AS \"rank\" FROM collab"
)


def category_mart(events: str) -> str:
    return f"""
        SELECT category_code, count(*) AS total_events, {number_of("purchase")} AS purchase_count,
               {number_of("view")} AS view_count, {number_of("cart")} AS cart_count,
               {REVENUE} AS total_revenue, {PURCHASE_AVG} AS avg_purchase_value,
               count(DISTINCT user_id) AS unique_users,
               count(DISTINCT product_id) AS unique_products,
               {ratio(number_of("purchase"), number_of("view"))} AS conversion_rate
        FROM {events} WHERE category_code IS NOT NULL GROUP BY category_code"""


def affinity(events: str) -> str:
    return f"""
        SELECT product_1, product_2, count(*) AS frequency FROM (
            SELECT product_id AS product_1,
                   lead(product_id) OVER (PARTITION BY user_id
                       ORDER BY event_time, event_id, product_id) AS product_2
            FROM {events} WHERE {PURCHASE} AND product_id IS NOT NULL)
        WHERE product_2 IS NOT NULL AND product_1 <> product_2 GROUP BY product_1, product_2"""


def rollup(key: str) -> str:
    return f"""
        SELECT a.{key}, count(DISTINCT product_id) AS total_products,
               CAST(sum(total_views) AS BIGINT) AS total_views,
               CAST(sum(total_cart_adds) AS BIGINT) AS total_cart_adds,
               CAST(sum(total_purchases) AS BIGINT) AS total_purchases,
               {money(column="total_revenue")} AS total_revenue,
               round(avg(avg_price), 6) AS avg_product_price,
               coalesce(max(c.users), 0) AS unique_customers
        FROM analytics a
        LEFT JOIN (SELECT {key}, count(DISTINCT user_id) AS users FROM ev
                   WHERE {PURCHASE} GROUP BY {key}) c ON c.{key} = a.{key}
        WHERE a.{key} IS NOT NULL GROUP BY a.{key}"""


def similarity(square: str) -> str:
    return sql(
        "ev inter vec norm",
        """
        SELECT p.user_1, p.user_2,
               coalesce(round(d.dot / sqrt(CAST(a.n AS DOUBLE) * b.n), 4), 0.0) AS similarity_score
        FROM (SELECT DISTINCT user_1, user_2 FROM (
                  SELECT user_id AS user_1,
                         lead(user_id) OVER (PARTITION BY product_id
                             ORDER BY interaction_time, user_id, interaction_type) AS user_2
                  FROM inter) WHERE user_1 <> user_2) p
        JOIN norm a ON a.user_id = p.user_1 JOIN norm b ON b.user_id = p.user_2
        LEFT JOIN (SELECT x.user_id AS u, y.user_id AS v, CAST(sum(x.w * y.w) AS DOUBLE) AS dot
                   FROM vec x JOIN vec y ON x.product_id = y.product_id GROUP BY 1, 2) d
               ON d.u = p.user_1 AND d.v = p.user_2""",
        square=square,
    )


def behavior_upsert() -> str:
    kept = ", ".join(BEHAVIOR_COLUMNS)
    return sql(
        "ev behavior earlier",
        f"""
        SELECT user_id, {kept} FROM earlier
        WHERE user_id NOT IN (SELECT user_id FROM behavior WHERE purchase_count > 10)
        UNION ALL SELECT user_id, {kept} FROM behavior WHERE purchase_count > 10""",
    )


def behavior_update() -> str:
    columns = []
    for name in BEHAVIOR_COLUMNS:
        first, second = ("b", "e") if name in ("total_spend", "last_seen") else ("e", "b")
        columns.append(
            f"CASE WHEN {first}.user_id IS NOT NULL THEN {first}.{name} "
            f"ELSE {second}.{name} END AS {name}"
        )
    return sql(
        "ev behavior earlier",
        f"SELECT coalesce(e.user_id, b.user_id) AS user_id, {', '.join(columns)} "
        "FROM earlier e FULL JOIN behavior b ON b.user_id = e.user_id",
    )


def text_time(column: str) -> str:
    return f"coalesce(strftime({column}, '%Y-%m-%d %H:%M:%S'), '')"


STAMP = "'2024-02-01T00:00:00'"
PRODUCT_COLUMNS = "product_id, brand, category_code, popularity_score, avg_rating"
RECS = "ev prof cat_lists cat_recs"


# Built tables whose rows are those of a query with a twin of its own.
SIZED_BY = {
    "category_performance": "category_performance",
    "daily_performance": "daily_performance",
    "brand_performance": "brand_performance",
    "user_journey": "user_journey",
    "product_affinity": "product_affinity",
    "product_catalog": "product_catalog",
    "user_activity_segments": "user_segments_activity",
    "segment_export": "segment_export",
    "category_recommendations": "category_recs_scored",
    "flat_recommendations": "flat_recommendations",
    "product_analytics": "product_analytics",
    "brand_analytics": "brand_analytics",
    "category_analytics": "category_analytics",
}


def oracle() -> dict[str, str]:
    texts = _texts()
    texts["sql_user_similarity"] = texts["user_similarity_vector"]
    for table, name in SIZED_BY.items():
        texts["warehouse_build"] += f"\nUNION ALL SELECT '{table}', (SELECT count(*) FROM ({texts[name]}))"
    return texts


def _texts() -> dict[str, str]:
    return {
        "ingest_roundtrip": WHOLE_LAKE,
        "stream_ingest": WHOLE_LAKE,
        "csv_dumps": WHOLE_LAKE,
        "lake_view_partition": WHOLE_LAKE + " WHERE event_type = 'view'",
        "migrated_events": SAME_EVENTS,
        "migrated_profiles": sql(
            "ev prof", f"SELECT {PROFILE_COLUMNS} FROM prof".replace(
                "user_id,", "CAST(user_id AS BIGINT) AS user_id,", 1
            )
        ),
        "combined_events": SAME_EVENTS,
        "union_distinct_products": sql(
            "ev",
            "SELECT DISTINCT product_id, brand, category_code FROM ev "
            "WHERE product_id IS NOT NULL",
        ),
        "safe_numbers": sql(
            "ev",
            f"""SELECT event_id, CAST(coalesce(trunc(price), 0) AS BIGINT) AS whole,
                   coalesce(price, 0.0) AS amount, CAST(0 AS BIGINT) AS product_number,
                   {ladder("price * 10")} AS price_segment FROM lake""",
        ),
        "customer_360_rank": sql("ev prof", "SELECT * FROM prof"),
        "customer_360_mode": sql(
            "ev prof", "SELECT * FROM prof", rule="price IS NOT NULL AND brand IS NOT NULL"
        ),
        "customer_360_max": sql(
            "ev",
            f"""SELECT user_id, max(CASE WHEN {PURCHASE} THEN brand END) AS favorite_brand,
                   max(CASE WHEN event_type = 'view' THEN category_code END)
                       AS most_viewed_category,
                   {number_of("purchase")} AS total_purchases, {REVENUE} AS total_spend,
                   max(event_time) AS last_seen_date FROM ev GROUP BY user_id""",
        ),
        "user_segments": sql("ev prof seg", "SELECT * FROM seg"),
        "user_segments_activity": sql(
            "ev prof behavior",
            f"""SELECT b.user_id, {ladder("b.total_spend")} AS segment, b.total_spend,
                   p.total_purchases, b.days_active, p.favorite_brand, p.most_viewed_category,
                   p.last_seen_date
                FROM behavior b LEFT JOIN prof p ON p.user_id = b.user_id""",
        ),
        "segment_distribution": sql(
            "ev prof seg",
            f"""SELECT segment, count(*) AS user_count, {average(column="total_spend")}
                   AS avg_spend FROM seg GROUP BY segment""",
        ),
        "segment_export": sql("ev prof seg seg_export", "SELECT * FROM seg_export"),
        "user_behavior_features": sql("ev prof inter features", "SELECT * FROM features"),
        "streamed_features": sql(
            "ev prof inter features",
            "SELECT user_id, total_views, total_purchases, total_spend, last_activity_date "
            "FROM features",
        ),
        "features_over_checkpoints": sql(
            "ev prof inter features",
            "SELECT user_id, total_views, total_purchases, total_spend, last_activity_date "
            "FROM features",
        ),
        "product_popularity": sql("ev popular", "SELECT * FROM popular"),
        "user_behavior": sql("ev behavior", "SELECT * FROM behavior"),
        "category_performance": sql("ev", category_mart("ev")),
        "top_categories": sql(
            "ev",
            f"""SELECT category_code, total_revenue, purchase_count, conversion_rate
                FROM ({category_mart("ev")}) ORDER BY total_revenue DESC, category_code LIMIT 5""",
        ),
        "daily_performance": sql("ev daily", "SELECT * FROM daily"),
        "daily_metrics": sql(
            "ev daily",
            """SELECT event_date AS metric_date, daily_active_users AS total_users,
                   daily_purchases AS total_purchases, daily_revenue AS total_revenue,
                   avg_order_value, daily_conversion_rate AS conversion_rate,
                   daily_views AS total_views, daily_cart_additions AS total_cart_additions
               FROM daily""",
        ),
        "refresh_daily_metrics": sql(
            "ev daily",
            f"""SELECT event_date AS metric_date,
                   CASE WHEN event_date = {REFRESH_DAY} THEN daily_active_users ELSE 0 END
                       AS total_users,
                   daily_purchases AS total_purchases, daily_revenue AS total_revenue,
                   avg_order_value,
                   CASE WHEN event_date = {REFRESH_DAY} THEN (
                       SELECT {ratio(number_of("purchase"), "count(*)")} FROM ev
                       WHERE CAST(event_time AS DATE) = {REFRESH_DAY})
                   ELSE daily_conversion_rate END AS conversion_rate FROM daily""",
        ),
        "brand_performance": sql(
            "ev",
            f"""SELECT brand, count(*) AS total_events, {number_of("purchase")} AS purchase_count,
                   {REVENUE} AS total_revenue, {PURCHASE_AVG} AS avg_purchase_value,
                   count(DISTINCT user_id) AS unique_customers,
                   count(DISTINCT product_id) AS unique_products
                FROM ev WHERE brand IS NOT NULL GROUP BY brand""",
        ),
        "user_journey": sql(
            "ev",
            """SELECT user_id, event_type, count(*) AS event_count,
                   min(event_time) AS first_event, max(event_time) AS last_event,
                   date_diff('minute', min(event_time), max(event_time))
                       AS session_duration_minutes
               FROM ev GROUP BY user_id, event_type""",
        ),
        "product_affinity": sql("ev", affinity("ev")),
        "product_affinity_split": sql("ev", affinity("ev")),
        "product_catalog": sql(
            "ev",
            f"""SELECT product_id, 'Product_' || product_id AS product_name, category_code, brand,
                   {average()} AS avg_price, count(*) AS total_purchases,
                   count(DISTINCT user_id) AS unique_buyers, TRUE AS is_active,
                   {AS_OF} AS created_date
                FROM ev WHERE product_id IS NOT NULL GROUP BY product_id, category_code, brand""",
        ),
        "product_analytics": sql("ev analytics", "SELECT * FROM analytics"),
        "brand_analytics": sql("ev analytics", rollup("brand")),
        "category_analytics": sql("ev analytics", rollup("category_code")),
        "stored_category_performance": sql(
            "ev",
            f"""SELECT * EXCLUDE (unique_users, unique_products), TRUE AS users_close, TRUE AS products_close
                FROM ({category_mart("ev")})""",
        ),
        "stored_brand_span": sql(
            "ev",
            f"""SELECT brand, count(*) AS total_events, {number_of("purchase")} AS purchase_count,
                   {REVENUE} AS total_revenue, {PURCHASE_AVG} AS avg_purchase_value
                FROM ev WHERE brand IS NOT NULL AND event_time >= TIMESTAMP '2024-01-10'
                    AND event_time < TIMESTAMP '2024-01-20' GROUP BY brand""",
        ),
        "stored_daily_metrics": sql(
            "ev daily",
            """SELECT event_date AS metric_date, TRUE AS users_close, daily_purchases AS total_purchases,
                   daily_revenue AS total_revenue, avg_order_value, daily_conversion_rate AS conversion_rate,
                   daily_views AS total_views, daily_cart_additions AS total_cart_additions
               FROM daily""",
        ),
        "stored_category_recs": sql(
            "ev cat_lists",
            "SELECT category_code, recommended_products, recommendation_score FROM cat_lists",
            tie="avg_price DESC,",
        ),
        "category_recs_list": sql(
            RECS,
            "SELECT user_id, recommended_products, recommendation_reason, recommendation_date "
            "FROM cat_recs",
        ),
        "category_recs_scored": sql(
            RECS,
            "SELECT user_id, recommended_products, "
            "recommendation_score FROM cat_recs",
            tie="avg_price DESC,",
        ),
        "refresh_recommendations": sql(RECS, "SELECT user_id, recommended_products FROM cat_recs"),
        "flat_recommendations": sql(f"{RECS} flat", "SELECT * FROM flat"),
        "interactions": sql(
            "ev inter",
            "SELECT user_id, product_id, interaction_type, CAST(strength AS BIGINT) AS "
            "interaction_strength, "
            "interaction_time FROM inter",
        ),
        "user_similarity_rows": similarity("sq"),
        "user_similarity_vector": similarity("w * w"),
        "similar_users": sql("ev inter vec norm dots near", SIMILAR),
        "similar_users_rows": sql("ev inter vec norm dots near", SIMILAR, square="sq"),
        "similar_users_probed": sql("ev inter vec norm dots near", SIMILAR),
        "content_based": sql(
            "ev prof inter features part_features content",
            "SELECT user_id, product_id, score AS recommendation_score, "
            "'Content-based: High rating and popularity' AS reason, rn AS \"rank\" FROM content",
        ),
        "collaborative_all": sql(
            "ev inter vec norm dots near collab", COLLAB, neighbors="20", seen="TRUE"
        ),
        "collaborative_unseen": sql(
            "ev inter vec norm dots near collab", COLLAB, neighbors="20"
        ),
        "collaborative_for_best_customers": sql(
            "ev prof inter vec norm dots near collab",
            COLLAB + " WHERE user_id IN (SELECT user_id FROM prof "
            "ORDER BY total_spend DESC NULLS LAST, user_id LIMIT 10)",
            neighbors="10",
        ),
        "sql_similar_users": sql(
            "ev inter vec norm dots near",
            'SELECT v AS similar_user_id, score AS similarity_score, rn AS "rank" FROM near WHERE u = \'7\'',
        ),
        "stored_views": sql(
            "ev behavior popular",
            """SELECT 'VW_PRODUCT_POPULARITY' AS view_name, count(*) AS row_count, CAST(sum(purchase_count) AS BIGINT) AS total FROM popular
               UNION ALL SELECT 'VW_USER_BEHAVIOR', count(*), CAST(sum(total_events) AS BIGINT) FROM behavior
               UNION ALL SELECT 'VW_USER_JOURNEY', count(*), CAST(sum(n) AS BIGINT) FROM (
                   SELECT count(*) AS n FROM ev WHERE user_id IS NOT NULL GROUP BY user_id, event_type)""",
        ),
        "warehouse_build": sql(
            "ev prof inter features part_features sold content vec norm dots near collab",
            f"""SELECT 'combined_events' AS table_name, count(*) AS row_count FROM ev
               UNION ALL SELECT 'customer_360', count(*) FROM prof
               UNION ALL SELECT 'user_segments', count(*) FROM prof
               UNION ALL SELECT 'user_behavior', count(DISTINCT user_id) FROM ev
               UNION ALL SELECT 'daily_metrics', count(DISTINCT CAST(event_time AS DATE)) FROM ev
               UNION ALL SELECT 'product_popularity', count(*) FROM (
                   SELECT DISTINCT product_id, category_code FROM ev WHERE {PURCHASE}
                   AND category_code IS NOT NULL AND product_id IS NOT NULL)
               UNION ALL SELECT 'user_product_interactions', count(*) FROM inter
               UNION ALL SELECT 'user_behavior_features', count(*) FROM features
               UNION ALL SELECT 'product_features', count(*) FROM sold
               UNION ALL SELECT 'similar_users', count(*) FROM near
               UNION ALL SELECT 'content_recommendations', count(*) FROM content
               UNION ALL SELECT 'collaborative_recommendations', count(*) FROM collab
               UNION ALL SELECT 'hybrid_recommendations', count(*) FROM content
               UNION ALL SELECT 'popularity_recommendations', CAST(sum(least(5,
                   (SELECT count(*) FROM sold) - known)) AS BIGINT) FROM (
                   SELECT user_id, count(DISTINCT product_id) AS known FROM inter GROUP BY user_id)
               UNION ALL SELECT 'recommendation_summary', count(*) FROM features
               UNION ALL SELECT 'recommendation_performance', count(*) FROM sold""",
            neighbors="20",
            products="sold",
        ),
        "hybrid": sql(
            "ev prof inter features part_features content vec norm dots near collab",
            """SELECT user_id, product_id, score AS recommendation_score,
                   'Hybrid: Combined content and collaborative filtering' AS reason,
                   row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id)
                       AS "rank"
               FROM (SELECT c.user_id, c.product_id,
                            CAST(round(CAST(c.score AS DECIMAL(12,4)) * 0.3
                                 + CAST(coalesce(f.score, 0) AS DECIMAL(12,4)) * 0.7, 4)
                                 AS DOUBLE) AS score
                     FROM content c LEFT JOIN collab f
                       ON f.user_id = c.user_id AND f.product_id = c.product_id)""",
            neighbors="20",
            seen="TRUE",
        ),
        "popularity_recs": sql(
            "ev prof inter features part_features pop",
            """SELECT user_id, product_id, CAST(1 AS BIGINT) AS model_id, score AS recommendation_score,
                   CAST(round(CAST(score AS DECIMAL(12,4)) * 0.9, 4) AS DOUBLE)
                       AS confidence_score,
                   'Popularity-based recommendation' AS recommendation_reason,
                   rn AS rank_position FROM pop""",
        ),
        "recommendation_summary": sql(
            "ev prof inter features cat_lists cat_recs flat outcomes summary",
            "SELECT * FROM summary",
        ),
        "recommendation_performance": sql(
            "ev prof cat_lists cat_recs flat outcomes part_features",
            """SELECT p.product_id, p.brand, p.category_code, p.avg_rating, p.popularity_score,
                   count(r.user_id) AS times_recommended,
                   round(avg(r.recommendation_score), 6) AS avg_recommendation_score,
                   count(*) FILTER (r.is_clicked) AS times_clicked,
                   count(*) FILTER (r.is_purchased) AS times_purchased,
                   CASE WHEN count(r.user_id) > 0
                        THEN CAST(count(*) FILTER (r.is_purchased) AS DOUBLE) * 100.0
                             / count(r.user_id)
                        ELSE 0 END AS conversion_rate
               FROM part_features p LEFT JOIN outcomes r ON r.product_id = p.product_id
               GROUP BY 1, 2, 3, 4, 5""",
        ),
        "segment_item_export": sql(
            "ev prof seg",
            f"""SELECT user_id, segment AS customer_segment,
                   coalesce(total_spend, 0.0) AS total_spend,
                   coalesce(total_purchases, 0) AS total_purchases,
                   coalesce(favorite_brand, '') AS favorite_brand,
                   coalesce(most_viewed_category, '') AS most_viewed_category,
                   {text_time("last_seen_date")} AS last_seen_date,
                   {STAMP} AS export_timestamp FROM seg""",
        ),
        "recommendation_item_export": sql(
            RECS,
            f"""SELECT user_id,
                   regexp_replace(recommended_products, 'prod_[0-9]+', '0', 'g')
                       AS recommended_products,
                   recommendation_reason,
                   {text_time("recommendation_date")} AS recommendation_date,
                   {STAMP} AS updated_at FROM cat_recs""",
        ),
        "flat_item_export": sql(
            f"{RECS} flat",
            f"""SELECT user_id, product_id, recommendation_score, "rank", {STAMP} AS updated_at
                FROM flat""",
        ),
        "recency_item_export": sql(
            "ev prof seg seg_export",
            f"""SELECT user_id, segment, coalesce(total_purchases, 0) AS total_purchases,
                   coalesce(total_spend, 0.0) AS total_spend,
                   {text_time("last_purchase_date")} AS last_purchase_date,
                   coalesce(days_since_last_purchase, 0) AS days_since_last_purchase,
                   {STAMP} AS updated_at FROM seg_export""",
        ),
        "event_parameters": """
            SELECT event_id, replace(replace(props, ': ', ':'), ', ', ',') AS props, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
            FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 = 1""",
        "judged_messages": sql(
            "ev",
            """SELECT CASE WHEN event_id % 50 = 0 THEN 'not valid JSON' WHEN event_id % 50 = 1 THEN 'no user' ELSE 'accepted' END
                   AS outcome, count(*) AS messages FROM lake GROUP BY 1""",
        ),
        "rejected_stream": sql(
            "ev",
            """SELECT CASE WHEN event_id % 50 = 0 THEN 'not valid JSON' WHEN event_id % 50 = 1 THEN 'no user' ELSE 'accepted' END
                   AS outcome, count(*) AS messages FROM lake GROUP BY 1""",
        ),
        "upsert_rows": behavior_upsert(),
        "bucketed_upsert": behavior_upsert(),
        "upsert_update_cols": behavior_update(),
        "insert_ignored": sql(
            "ev inter",
            f"""SELECT user_id, product_id, interaction_type,
                   coalesce(min(interaction_time) FILTER (interaction_time < {REFRESH_DAY}),
                            max(interaction_time)) AS interaction_time
                FROM inter GROUP BY 1, 2, 3""",
        ),
        "time_between": sql(
            "ev",
            f"""SELECT user_id, date_diff('day', first_view, last_buy) AS days,
                   date_diff('minute', first_view, last_buy) AS minutes
                FROM (SELECT user_id, min(event_time) FILTER (event_type = 'view') AS first_view,
                             max(event_time) FILTER ({PURCHASE}) AS last_buy
                      FROM ev GROUP BY user_id)""",
        ),
        "high_value_users": sql(
            "ev behavior", "SELECT * FROM behavior WHERE total_spend > 500"
        ),
        "last_7_days": sql(
            "ev daily", "SELECT * FROM daily WHERE event_date >= DATE '2024-01-24'"
        ),
        "user_recs_lookup": sql(f"{RECS} flat", "SELECT * FROM flat WHERE user_id = '7'"),
        "top_products_of_category": sql(
            "ev popular",
            "SELECT * FROM popular WHERE category_code = 'ECONOMY' "
            "ORDER BY purchase_count DESC, product_id LIMIT 10",
        ),
        "most_popular_products": sql(
            "ev part_features",
            f"""SELECT {PRODUCT_COLUMNS} FROM part_features
                ORDER BY popularity_score DESC, product_id LIMIT 10""",
        ),
        "top_spenders": sql(
            "ev prof inter features",
            """SELECT user_id, favorite_category, total_purchases, total_spend FROM features
               ORDER BY total_spend DESC, user_id LIMIT 10""",
        ),
        "best_served_users": sql(
            "ev prof inter features cat_lists cat_recs flat outcomes summary",
            """SELECT * FROM summary WHERE total_recommendations > 0
               ORDER BY avg_recommendation_score DESC, user_id LIMIT 10""",
        ),
        "strongest_recommendations": sql(
            "ev prof inter features part_features pop",
            """SELECT user_id, product_id, CAST(1 AS BIGINT) AS model_id, score AS recommendation_score,
                   CAST(round(CAST(score AS DECIMAL(12,4)) * 0.9, 4) AS DOUBLE)
                       AS confidence_score,
                   'Popularity-based recommendation' AS recommendation_reason,
                   rn AS rank_position
               FROM pop ORDER BY score DESC, user_id, product_id LIMIT 5""",
        ),
        "row_count_report": sql(
            RECS,
            """SELECT 'combined_events' AS table_name, count(*) AS row_count FROM ev
               UNION ALL SELECT 'customer_360', count(*) FROM prof
               UNION ALL SELECT 'user_segments', count(*) FROM prof
               UNION ALL SELECT 'category_recommendations', count(*) FROM cat_recs
               UNION ALL SELECT 'daily_metrics', count(DISTINCT CAST(event_time AS DATE)) FROM ev
               UNION ALL SELECT 'product_catalog', count(*) FROM (
                   SELECT DISTINCT product_id, category_code, brand FROM ev
                   WHERE product_id IS NOT NULL)""",
        ),
        "duplicate_keys": sql(
            "hist",
            "SELECT event_id, count(*) AS row_count FROM hist GROUP BY 1 HAVING count(*) > 1",
        ),
        "null_counts": sql(
            "ev",
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM lake"
                for c in ("user_id", "price", "brand", "category_code")
            ),
        ),
        "history_customer_360": sql("hist prof", "SELECT * FROM prof", events="hist"),
        "history_product_popularity": sql("hist popular", "SELECT * FROM popular", events="hist"),
        "history_user_behavior": sql("hist behavior", "SELECT * FROM behavior").replace(
            "FROM ev ", "FROM hist "
        ),
        "history_category_performance": sql("hist", category_mart("hist")),
        "history_product_affinity": sql("hist", affinity("hist")),
        "history_category_recs": sql(
            "hist cat_lists",
            "SELECT category_code, recommended_products, "
            "recommendation_score FROM cat_lists",
            events="hist",
            tie="avg_price DESC,",
        ),
        "history_similar_users": sql(
            "hist inter vec norm dots near", SIMILAR, events="hist"
        ),
        "history_collaborative": sql(
            "hist inter vec norm dots near collab", COLLAB, events="hist", neighbors="20"
        ),
    }
