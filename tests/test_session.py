from ledgerline.session import partitions_for_size


def test_partitions_for_size(spark):
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions_for_size(spark, 0, 100) == base
    assert partitions_for_size(spark, None, 100) == base
    assert partitions_for_size(spark, 100 * (base + 5), 100) == base + 5
