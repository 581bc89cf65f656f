from shopsight import session


def test_bytes_of_a_task_are_bounded(spark):
    own = spark.newSession()
    for key, most in session.MOST_BYTES.items():
        own.conf.set(key, "1g")
        session.tune(own)
        assert session._bytes(own.conf.get(key)) == most
        own.conf.set(key, "2MB")
        session.tune(own)
        assert session._bytes(own.conf.get(key)) == 2 << 20
    assert {"spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"} == set(session.MOST_BYTES)
