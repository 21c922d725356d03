"""Cluster sizing and side-by-side helpers."""

import threading

import pytest

from daybook.session import REQUIRED_CONF, cluster_conf, together


def test_cluster_conf_sizes_partitions_to_the_input():
    tb = 1024**4
    conf = cluster_conf(100 * tb, total_cores=8000)
    parts = int(conf["spark.sql.shuffle.partitions"])
    # ~256 MB per task, whole waves of 8000 cores.
    assert parts % 8000 == 0
    assert 100 * tb / parts <= 256 * 1024**2
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == str(parts)
    for k, v in REQUIRED_CONF.items():
        if k != "spark.sql.objectHashAggregate.sortBased.fallbackThreshold":
            assert conf[k] == v


def test_cluster_conf_small_input_uses_one_wave():
    conf = cluster_conf(10 * 1024**2, total_cores=64)
    assert conf["spark.sql.shuffle.partitions"] == "64"


def test_steps_run_side_by_side_and_all_end_before_an_error_is_raised(spark):
    both, ended = threading.Barrier(2, timeout=60), []

    def step(n, fails=False):
        both.wait()  # passes only if the other step runs too
        rows = spark.range(n).count()
        if fails:
            raise ValueError("lost")
        ended.append(rows)
        return rows

    assert together(spark, lambda: step(2), lambda: step(3)) == [2, 3]
    ended.clear()
    with pytest.raises(ValueError, match="lost"):
        together(spark, lambda: step(1, fails=True), lambda: step(5))
    assert ended == [5]
