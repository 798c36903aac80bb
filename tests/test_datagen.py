from __future__ import annotations

from conftest import rows

from clickmart.datagen import BRANDS, CATEGORIES, demo_events, sample_recommender
from clickmart.operators import check_unique
from clickmart.plans import recommend
from clickmart.schema import CANONICAL_SCHEMA


def test_demo_events(spark):
    df = demo_events(spark)
    assert df.schema.names == CANONICAL_SCHEMA.names and df.count() == 150
    assert rows(df) == rows(demo_events(spark)) != rows(demo_events(spark, seed=1))
    assert df.where("event_type = 'cart' AND (price IS NOT NULL OR category_code IS NOT NULL)").isEmpty()
    bought = df.where("event_type = 'purchase'")
    assert bought.where("price NOT BETWEEN 10 AND 500 OR category_code IS NOT NULL").isEmpty()
    viewed = df.where("event_type = 'view'")
    assert viewed.where("category_code IS NULL OR brand IS NOT NULL").isEmpty()
    assert {r.brand for r in bought.collect()} <= {*BRANDS, None}
    assert {r.category_code for r in viewed.collect()} <= set(CATEGORIES)


def test_sample_recommender(spark):
    tables = sample_recommender(spark, 20, 10, 300)
    assert tables["user_behavior_features"].count() == 20
    assert tables["product_features"].count() == 10
    keys = ["user_id", "product_id", "interaction_type", "interaction_time"]
    assert check_unique(tables["user_product_interactions"], keys).isEmpty()
    assert tables["recommendation_models"].count() == 3
    content = recommend.content_based(tables["user_behavior_features"], tables["product_features"])
    assert not content.isEmpty()
