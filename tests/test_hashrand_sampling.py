import pytest
from pyspark.sql import functions as F

from relearn.functions.hashrand import hash_index, hash_uniform
from relearn.operators import sampling


def test_uniform_range_and_repeatable(spark):
    df = spark.range(0, 20000).withColumn("u", hash_uniform("s", F.col("id")))
    stats = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0.0 <= stats[0] and stats[1] < 1.0
    assert abs(stats[2] - 0.5) < 0.02
    again = spark.range(0, 20000).repartition(7).withColumn("u", hash_uniform("s", F.col("id")))
    assert df.join(again, "id").filter(df.u != again.u).count() == 0


def test_hash_index_bounds(spark):
    df = spark.range(0, 5000).select(hash_index("b", 7, F.col("id")).alias("i"))
    r = df.agg(F.min("i"), F.max("i"), F.countDistinct("i")).first()
    assert r[0] == 0 and r[1] == 6 and r[2] == 7


def test_split_disjoint_complete_and_normalised(spark):
    df = spark.range(0, 30000)
    parts = sampling.split_parts(df, [0.005, 0.0001], "split", [F.col("id")])
    n = [p.count() for p in parts]
    assert sum(n) == 30000
    assert abs(n[0] / 30000 - 0.005 / 0.0051) < 0.01
    assert parts[0].join(parts[1], "id").count() == 0


def test_three_way_split(spark):
    tagged = sampling.weighted_split(spark.range(0, 9000), [1, 1, 1], "s", [F.col("id")], ["a", "b", "c"])
    counts = {r["split"]: r["n_rows"] for r in sampling.split_sizes(tagged).collect()}
    assert set(counts) == {"a", "b", "c"} and sum(counts.values()) == 9000


def test_arms_unchanged_by_repartition(spark):
    df = spark.range(0, 5000)
    a = sampling.assign_arms(df, 0.3, "arm", [F.col("id")])
    b = sampling.assign_arms(df.repartition(5), 0.3, "arm", [F.col("id")])
    assert a.join(b.withColumnRenamed("ab_group", "g2"), "id").filter("ab_group != g2").count() == 0
    sizes = sampling.arm_sizes(a).first()
    assert sizes.champion_count + sizes.challenger_count == 5000


def test_empty_arm_gives_zero(spark):
    a = sampling.assign_arms(spark.range(0, 100), 0.0, "arm", [F.col("id")])
    sizes = sampling.arm_sizes(a).first()
    assert sizes.challenger_count == 0 and sizes.champion_count == 100


def test_label_encoding_third_value_null(spark):
    df = spark.createDataFrame([("bad",), ("good",), ("ugly",), (None,)], "label string")
    out = {r.label: r.label_enc for r in sampling.encode_labels(df, "label").collect()}
    assert out == {"bad": 1, "good": 0, "ugly": None, None: None}


def test_sample_and_complement_partition_rows(spark):
    df = spark.range(0, 10000)
    s = sampling.sample_rows(df, 0.8, "x", [F.col("id")])
    c = sampling.sample_complement(df, 0.8, "x", [F.col("id")])
    assert s.count() + c.count() == 10000
    anti = sampling.anti_join_complement(df, s, ["id"])
    assert anti.exceptAll(c).count() == 0 and c.exceptAll(anti).count() == 0


def test_digest_lanes_are_uniform_and_uncorrelated(spark):
    from relearn.functions.hashrand import hash_digest, lane_uniform
    df = (spark.range(0, 40000).select(hash_digest("lanes", F.col("id")).alias("h"))
          .select(*[lane_uniform(F.col("h"), i).alias(f"u{i}") for i in range(4)]))
    row = df.agg(*[F.avg(f"u{i}").alias(f"m{i}") for i in range(4)],
                 *[F.corr(f"u{i}", f"u{j}").alias(f"c{i}{j}") for i in range(4) for j in range(i + 1, 4)],
                 F.min("u0").alias("lo"), F.max("u3").alias("hi")).first()
    assert all(abs(row[f"m{i}"] - 0.5) < 0.01 for i in range(4))
    assert all(abs(row[f"c{i}{j}"]) < 0.02 for i in range(4) for j in range(i + 1, 4))
    assert 0.0 <= row["lo"] and row["hi"] < 1.0
    # lane 0 is the plain hash uniform
    same = spark.range(0, 100).select((lane_uniform(hash_digest("s", F.col("id")), 0)
                                       == hash_uniform("s", F.col("id"))).alias("eq"))
    assert same.filter(~F.col("eq")).count() == 0


def test_xxhash_method_uniform_repeatable_and_switchable(spark):
    from relearn.functions import hashrand
    df = spark.range(0, 40000).withColumn("u", hash_uniform("s", F.col("id"), method="xxhash64"))
    r = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0.0 <= r[0] and r[1] < 1.0 and abs(r[2] - 0.5) < 0.01
    again = spark.range(0, 40000).repartition(5).withColumn("u2", hash_uniform("s", F.col("id"), method="xxhash64"))
    assert df.join(again, "id").filter(F.col("u") != F.col("u2")).count() == 0
    idx = spark.range(0, 5000).select(hash_index("s", 7, F.col("id"), method="xxhash64").alias("i"))
    assert {r.i for r in idx.distinct().collect()} == set(range(7))
    try:
        hashrand.use_hash("xxhash64")
        fast = sampling.sample_rows(spark.range(0, 20000), 0.3, "p", [F.col("id")]).count()
    finally:
        hashrand.use_hash("md5")
    assert 5600 < fast < 6400
    with pytest.raises(ValueError):
        hashrand.use_hash("crc")


def test_hash_index_beyond_two_to_the_31(spark):
    n = 3 * 2 ** 40 + 7
    got = spark.range(0, 2000).select("id", hash_index("s", n, F.col("id")).alias("i")).collect()
    import hashlib
    for r in got[:50]:
        top = int(hashlib.md5(f"s|{r.id}".encode()).hexdigest()[:15], 16)
        assert r.i == top * n >> 60
    assert 0 <= min(r.i for r in got) and max(r.i for r in got) < n
    assert 0.45 < sum(r.i for r in got) / len(got) / n < 0.55


def test_cells_of_counts_beyond_two_to_the_31(spark):
    from relearn.operators.bootstrap import cell_of
    counts = [2 ** 33, 5, 0, 2 ** 35, 1, 0, 0, 9]
    at = [0, 2 ** 33 - 1, 2 ** 33, 2 ** 33 + 4, 2 ** 33 + 5, 2 ** 33 + 5 + 2 ** 35, 2 ** 33 + 6 + 2 ** 35]
    rows = spark.createDataFrame([(i,) for i in at], "pos long").select("pos", cell_of(F.col("pos"), counts).alias("c")).collect()
    assert [r.c for r in rows] == [0, 0, 1, 1, 3, 4, 7]


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_null_keys_have_places(spark, method):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    u = [r[0] for r in df.select(hash_uniform("s", "x", "y", "z", method=method)).collect()]
    assert u[0] != u[1]
