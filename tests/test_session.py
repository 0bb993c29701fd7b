"""Session helpers: shared scratch folder and cluster sizing."""

import pytest

from tripflow.jobs import main as job_main
from tripflow.session import checkpoint_root, cluster_conf, scratch_path


def test_scratch_lives_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/tripflow/x-")
    assert scratch_path(spark, "x", unique=False) == root.rstrip("/") + "/tripflow/x"


def test_cluster_conf_scales_with_input():
    small = cluster_conf(4000)
    assert small["spark.sql.shuffle.partitions"] == "12000"
    big = cluster_conf(4000, input_bytes=100 * 1024**4)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 * 1024**2)
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024**2)


def test_bronze_job_needs_a_landing_root(tmp_dir):
    with pytest.raises(SystemExit):
        job_main(["bronze", "--lake", tmp_dir, "--master", "local[1]"])


def test_public_api_imports():
    import tripflow

    for name in tripflow.__all__:
        assert getattr(tripflow, name) is not None
