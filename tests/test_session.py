from triplake.session import SQL_SETTINGS, configure

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITIONS = "spark.sql.shuffle.partitions"


def test_configure_keeps_what_the_owner_set(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.maxConcurrentOutputFileWriters", "3")
    session.conf.set(PARTITIONS, "17")
    configure(session)
    assert session.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "3"
    assert session.conf.get(PARTITIONS) == "17"
    assert INITIAL not in session.conf.getAll


def test_configure_sizes_shuffles_by_the_cluster(spark):
    session = spark.newSession()
    session.conf.unset(PARTITIONS)
    if PARTITIONS not in session.conf.getAll:
        configure(session)
        assert int(session.conf.get(INITIAL)) >= 200
    for key, value in SQL_SETTINGS.items():
        assert session.conf.get(key) == value
