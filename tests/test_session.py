import pytest

from tripmart.session import cluster_settings, shared_dir, shuffle_partitions

MB, GB, TB = 1024**2, 1024**3, 1024**4


def test_shuffle_partitions_follow_the_bytes():
    assert shuffle_partitions(1 * GB, slots=4) == 8
    assert shuffle_partitions(1 * MB, slots=16) == 16


@pytest.mark.parametrize(
    "size, slots, split", [(10 * GB, 8, 128 * MB), (2 * TB, 100, 419 * MB), (100 * TB, 1000, 1024 * MB)]
)
def test_scan_splits_grow_with_the_input(size, slots, split):
    settings = cluster_settings(size, 0, slots)
    assert int(settings["spark.sql.files.maxPartitionBytes"]) == pytest.approx(split, rel=0.01)
    assert settings["spark.sql.shuffle.partitions"] == str(slots)


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_no_machine_local_folder_on_a_cluster():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster)
