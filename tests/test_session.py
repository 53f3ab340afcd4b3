"""Session settings that queries rely on."""

import catalogue.all_queries  # noqa: F401
from catalogue.registry import QUERIES


def test_a_query_keeps_methods_small_enough_to_be_compiled(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, "65535")  # as in a session of other hands
    QUERIES["safe_casts"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get(key) == "8000"
