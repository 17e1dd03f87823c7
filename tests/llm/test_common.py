from pyspark.sql import functions as F

from tillroll.llm.common import hash_sample, numbered


def test_hash_sample_is_exact_and_the_same_for_any_partitioning(spark):
    for rows in (30, 300, 5000):
        frame = spark.range(rows).select(F.col("id"), (F.col("id") % 7).alias("x"))
        expected = sorted(frame.select(F.xxhash64("id", "x"), "id").collect())[:40]
        for parts in (1, 7):
            found = hash_sample(frame.repartition(parts), ["id", "x"], 40)
            assert [r.id for r in found] == [i for _, i in expected]
    assert hash_sample(spark.range(0), ["id"], 5) == []
    equal = spark.range(1000).select(F.lit(None).cast("long").alias("n"))
    assert len(hash_sample(equal, ["n"], 40)) in (0, 40)


def test_numbers_follow_the_keys(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    frame = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), (F.col("id") % 3).alias("v"))
    rows = numbered(frame.repartition(5), ["v", "k"], "numbers").collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [(r.v, r.k) for r in sorted(rows, key=lambda r: r.position)] == sorted((r.v, r.k) for r in rows)
    assert sorted(r.position for r in rows) == list(range(1000)) and {r.total for r in rows} == {1000}
    assert numbered(frame.filter("false"), ["k"], "numbers").count() == 0
