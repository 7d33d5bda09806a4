from candela.plans.sizing import bounded_count, broadcast_if_small
from candela.session import ensure_checkpoint_dir, scratch_path


def test_bounded_count_stops_at_the_bound(spark):
    df = spark.range(1000)
    assert bounded_count(df, 10) == 11
    assert bounded_count(spark.range(5), 10) == 5


def test_broadcast_only_under_the_bound(spark):
    big, small = spark.range(1000), spark.range(5)
    joined_small = spark.range(100).join(broadcast_if_small(small, 10), "id")
    joined_big = spark.range(100).join(broadcast_if_small(big, 10), "id")
    hint = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hint(joined_small) and not hint(joined_big)
    assert joined_small.count() == 5 and joined_big.count() == 100


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/"))
