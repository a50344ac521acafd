"""Session helper."""

from evenkeel.session import session

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_session_sizes_shuffles_by_input(spark):
    spark.conf.unset(INITIAL)  # jobs of other tests set it
    assert session().sparkContext is spark.sparkContext
    assert spark.conf.get(INITIAL, None) is None
    try:
        session(input_bytes=1 << 40)
        assert spark.conf.get(INITIAL) == str(-(-(1 << 40) // (200 << 20)))
        session(input_bytes=1)
        assert spark.conf.get(INITIAL) == "200"
        assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    finally:
        spark.conf.unset(INITIAL)
