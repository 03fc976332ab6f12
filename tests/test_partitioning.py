"""Results do not depend on the number of shuffle partitions (no tie leaks)."""

import pytest

from ledgerlens.plans.catalogue import QUERIES

from conftest import SF_SMALL

NAMES = ["op_type_index", "top3_op_types", "user_action_rank", "follow_rates",
         "dominant_follower", "merged_features"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_for_1_4_200_partitions(spark, name):
    seen = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "4", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(sorted(QUERIES[name](spark, SF_SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1] == seen[2]
