from quire.session import cluster_conf, work_dir


def test_cluster_conf_scales_with_input():
    small = cluster_conf(10 << 30, 10, 4)
    big = cluster_conf(100 * 10**12, 1000, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 120          # 3 waves of 40 slots
    assert int(big["spark.sql.shuffle.partitions"]) > 100_000
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_work_dir_reads_the_session_setting(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
