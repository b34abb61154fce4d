"""Windowed join and decision."""

from pyspark.sql import functions as F

from conftest import full_df
from ordertide import REFERENCE_LIMITS as L
from ordertide import schema as S
from ordertide.operators import decision as dc


def _pair(spark, p_status, s_status, p_t=0, s_t=0, price=30000, s_id="o1"):
    p = full_df(spark, [("o1", "m", "c", 1, price, p_status, None, p_t)])
    s = full_df(spark, [(s_id, "m", "c", 1, price, s_status, None, s_t)])
    return dc.decisions(p, s, L).collect()


def test_accept_accept_confirmed(spark):
    [r] = _pair(spark, "ACCEPT", "ACCEPT")
    assert r.status == S.CONFIRMED and r.source is None and r.error is None


def test_window(spark):
    assert _pair(spark, "ACCEPT", "ACCEPT", 0, 15) == []
    assert len(_pair(spark, "ACCEPT", "ACCEPT", 0, 10)) == 1
    assert len(_pair(spark, "ACCEPT", "ACCEPT", 10, 0)) == 1


def test_key_mismatch(spark):
    assert _pair(spark, "ACCEPT", "ACCEPT", s_id="other") == []


def test_rejects(spark):
    assert _pair(spark, "REJECT", "REJECT")[0].status == S.REJECT
    r = _pair(spark, "REJECT", "ACCEPT")[0]
    assert (r.status, r.source) == (S.ROLLBACK, S.PAYMENT)
    r = _pair(spark, "ACCEPT", "REJECT")[0]
    assert (r.status, r.source) == (S.ROLLBACK, S.STOCK)


def test_price_guard(spark):
    r = _pair(spark, "NEW", "NEW", price=100000)[0]
    assert r.error == S.MSG_PRICE_HIGH


def test_every_pair_is_emitted(spark):
    p = full_df(spark, [("o1", "m", "c", 1, 1, "ACCEPT", None, 0)])
    s = full_df(spark, [("o1", "m", "c", 1, 1, "ACCEPT", None, 1), ("o1", "m", "c", 1, 1, "REJECT", None, 2)])
    out = dc.decisions(p, s, L)
    assert sorted(r.status for r in out.collect()) == [S.CONFIRMED, S.ROLLBACK]
    assert out.select(F.col("ts")).count() == 2


def test_pairs_by_time_of_a_hot_key(spark):
    """Stretches of time find the pairs of the plain join, each once, and count them."""
    import random
    rnd = random.Random(3)

    def rows(n):
        return [("hot" if rnd.random() < 0.9 else rnd.choice(["a", "b", None]), None if rnd.random() < 0.02 else rnd.randint(-5_000, 90_000)) for _ in range(n)]
    for kind in ("timestamp", "timestamp_ntz"):
        def times(n, name, kind=kind):
            df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows(n))], f"k string, t long, {name}_id int")
            return df.select("k", F.timestamp_millis(F.col("t") * 100).cast(kind).alias(f"{name}_ts"), f"{name}_id")
        left, right = times(300, "l"), times(400, "r")
        for seconds in (0, 1, 37, 3600):
            plain = dc.window_join(left, right, "k", "l_ts", "r_ts", seconds)
            want = sorted((r.l_id, r.r_id) for r in plain.collect())
            found = dc.window_join_by_time(left, right, "k", "l_ts", "r_ts", seconds)
            assert sorted((r.l_id, r.r_id) for r in found.collect()) == want and found.columns == plain.columns
            counts = dc.window_pair_counts(left, right, "k", "l_ts", "r_ts", seconds, {"key": F.col("k"), "third": F.col("l_id") % 3})
            got = {(r.key, r.third): (r.n_left, r.n_pairs) for r in counts.collect()}
            keys = {r.l_id: (r.k, r.l_id % 3) for r in left.collect()}
            assert got == {g: (sum(x == g for x in keys.values()), sum(keys[i] == g for i, _ in want)) for g in set(keys.values())}
    assert dc.window_pair_counts(left.limit(0), right, "k", "l_ts", "r_ts", 5, {"k": F.col("k")}).collect() == []


def test_stretches_spread_a_hot_key(spark):
    clicks = spark.range(20_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 40).alias("l_ts"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pairs = dc.window_join_by_time(clicks.hint("shuffle_hash"), clicks.withColumnRenamed("l_ts", "r_ts"), "k", "l_ts", "r_ts", 3600)
    sizes = sorted(r.n for r in pairs.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
    for k, v in before.items():
        spark.conf.set(k, v)
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]


def test_undecided_orders(spark):
    p = full_df(spark, [(i, "m", "c", 1, 5, "ACCEPT", None, 100) for i in ("in", "edge", "far", "only")])
    s = full_df(spark, [("in", "m", "c", 1, 5, "ACCEPT", None, 95), ("edge", "m", "c", 1, 5, "REJECT", None, 110),
                        ("far", "m", "c", 1, 5, "REJECT", None, 111), ("other", "m", "c", 1, 5, "ACCEPT", None, 100)])
    found = {r.id: (r.p_status, r.s_status, r.apart, r.reason) for r in dc.undecided(p, s, L).collect()}
    assert found == {"far": ("ACCEPT", "REJECT", 11.0, "too far apart"), "only": ("ACCEPT", None, None, "no stock reply"),
                     "other": (None, "ACCEPT", None, "no payment reply")}
    assert {r.id for r in dc.decisions(p, s, L).collect()} == {"in", "edge"}
