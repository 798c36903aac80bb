from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickmart.operators import check_not_null
from clickmart.plans import catalog, similarity, warehouse
from clickmart.sinks import read_version
from clickmart.sources import star_schema


@pytest.fixture(scope="module")
def built(spark, data, tmp_path_factory):
    root = tmp_path_factory.mktemp("catalog")
    lake, out = str(root / "lake"), str(root / "out")
    star_schema.clickstream(spark, data).drop("event_id").write.partitionBy("event_type").parquet(lake)
    return out, warehouse.build_warehouse(spark, lake, out, "2024-02-01")


def test_counts_are_taken_while_writing(spark, built):
    out, counts = built
    counted = {r["table_name"]: r for r in counts.collect()}
    assert len(counted) == 29
    for name, row in counted.items():
        table = read_version(spark, f"{out}/{name}")
        assert row["row_count"] == table.count()
        assert row["null_counts"] == dict(check_not_null(table, table.columns).collect())


def test_the_build_keeps_its_keys(spark, built):
    report = {r["table_name"]: r for r in warehouse.check_warehouse(spark, *built).collect()}
    assert set(report) == set(warehouse.KEYS)
    assert all(r["has_rows"] and r["null_keys"] == 0 and r["repeated_keys"] == 0 for r in report.values())


def test_broken_keys_are_reported(spark, built, tmp_path, monkeypatch):
    out, counts = built
    from clickmart.sinks import write_version

    table = str(tmp_path / "customer_360")
    twice = read_version(spark, f"{out}/customer_360").limit(3)
    write_version(twice.union(twice).union(twice.limit(1).withColumn("user_id", F.lit(None).cast("string"))), table)
    monkeypatch.setattr(warehouse, "KEYS", {"customer_360": ["user_id"]})
    seen = counts.withColumn("null_counts", F.create_map(F.lit("user_id"), F.lit(1).cast("long")))
    assert [tuple(r) for r in warehouse.check_warehouse(spark, str(tmp_path), seen).collect()] == [("customer_360", True, 1, 3)]


def test_views_and_functions_over_the_build(spark, built):
    out, _ = built
    assert catalog.publish_views(spark, out) == list(catalog.VIEWS)
    for view, table in catalog.VIEWS.items():
        assert rows(spark.table(view)) == rows(read_version(spark, f"{out}/{table}"))
    assert catalog.publish_functions(spark, out) == [*catalog.LISTS, "user_similarity_of"]
    for name, (table, _, columns, place) in catalog.LISTS.items():
        stored = read_version(spark, f"{out}/{table}")
        user = stored.agg(F.min("user_id")).first()[0]
        wanted = stored.where((F.col("user_id") == user) & F.expr(f"{place} <= 3")).selectExpr(*columns.split(", "))
        found = spark.sql(f"SELECT * FROM {name}('{user}', 3)")
        assert rows(found) == rows(wanted) and found.count() > 0
        assert f"EqualTo(user_id,{user})" in found._jdf.queryExecution().toString()
    assert spark.sql("SELECT * FROM similar_users_of('nobody', 3)").collect() == []


def test_two_users_compared_from_sql(spark, built):
    out, _ = built
    catalog.publish_functions(spark, out)
    interactions = read_version(spark, f"{out}/user_product_interactions")
    users = [r[0] for r in interactions.select("user_id").distinct().orderBy("user_id").limit(3).collect()]
    pairs = spark.createDataFrame([(a, b) for a in [*users, "nobody"] for b in users], "user_1 string, user_2 string")
    wanted = similarity.user_similarity(interactions, pairs)
    pairs.createOrReplaceTempView("some_pairs")
    assert rows(spark.sql("SELECT *, user_similarity_of(user_1, user_2) FROM some_pairs")) == rows(wanted)


def test_what_is_not_built_has_no_view_or_function(spark, tmp_path):
    assert catalog.publish_views(spark, str(tmp_path)) == [] and catalog.publish_functions(spark, str(tmp_path)) == []


def test_function_of_two_users_makes_no_other_pairs(spark, built):
    out, _ = built
    catalog.publish_functions(spark, out)
    spark.sql("SELECT '1' AS a, '2' AS b").createOrReplaceTempView("one_pair")
    plan = spark.sql("SELECT user_similarity_of(a, b) FROM one_pair")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in plan and "Join Inner" not in plan
