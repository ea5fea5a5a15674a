"""Join audits: partition identity, fan-out, sentinel, NOT IN semantics."""

from hypothesis import given, settings, strategies as st
from pyspark.sql.types import LongType, StructField, StructType

from baobab.operators import joins

KS = StructType([StructField("k", LongType()), StructField("amount", LongType())])
K1 = StructType([StructField("k", LongType())])


def test_partition_fanout_and_sentinel(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (None, 5)], KS)
    right = spark.createDataFrame([(1,), (1,), (2,), (None,)], K1)
    p = joins.partition_test(left, right, "k").first()
    assert (p.n_left, p.n_semi, p.n_anti, p.n_inner, p.fan_out, p.partition_ok, p.inner_ok) == (4, 2, 2, 3, 1, True, False)
    once = joins.partition_test(left, right.distinct(), "k").first()
    assert once.inner_ok and once.fan_out == 0
    s = joins.sentinel(left, right, "k", "amount").first()
    assert (s.ca_avant, s.ca_apres, s.ecart, s.ca_perdu, s.ca_duplique) == (65, 40, -25, 35, 10)
    r = joins.row_discipline(left, right, "k").first()
    assert (r.n_avant, r.n_apres, r.ecart) == (4, 3, -1)
    assert sorted(x.k for x in joins.duplicate_keys(right, "k").collect()) == [1]


def test_not_in_three_valued_logic(spark):
    left = spark.createDataFrame([(1, 0), (5, 0), (None, 0)], KS)
    clean = spark.createDataFrame([(1,), (2,)], K1)
    with_null = spark.createDataFrame([(1,), (None,)], K1)
    empty = spark.createDataFrame([], K1)
    a = joins.not_in_count(left, clean, "k").first()
    assert (a.n_not_in, a.n_anti) == (1, 2)  # NULL key is unknown for NOT IN
    b = joins.not_in_count(left, with_null, "k").first()
    assert (b.n_not_in, b.n_anti) == (0, 2)  # one NULL on the right: no row
    c = joins.not_in_count(left, empty, "k").first()
    assert (c.n_not_in, c.n_anti) == (3, 3)  # empty right: every row
    # Spark's own NOT IN agrees
    left.createOrReplaceTempView("l_ni")
    for right, exp in ((clean, 1), (with_null, 0), (empty, 3)):
        right.createOrReplaceTempView("r_ni")
        assert spark.sql("SELECT COUNT(*) FROM l_ni WHERE k NOT IN (SELECT k FROM r_ni)").first()[0] == exp


def test_orphans_unknown_refs(spark):
    left = spark.createDataFrame([(1, 10), (9, 90)], KS)
    right = spark.createDataFrame([(1,), (2,)], K1)
    assert [r.k for r in joins.orphans(left, right, "k").collect()] == [9]
    assert [r.k for r in joins.matched(left, right, "k").collect()] == [1]
    assert [r.k for r in joins.unused_keys(right, left, "k").collect()] == [2]
    u = joins.unknown_references(left, right, "k").first()
    assert (u.n_events, u.n_unknown) == (2, 1)
    s = joins.orphan_summary(left, right, "k", "amount").first()
    assert (s.nb_orphelines, s.part_pct, s.ca_orphelines) == (1, 50.0, 90)


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=12),
    st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=12),
)
def test_semi_plus_anti_equals_left(spark, lk, rk):
    left = spark.createDataFrame([(k, 1) for k in lk], KS)
    right = spark.createDataFrame([(k,) for k in rk], K1)
    p = joins.partition_test(left, right, "k").first()
    assert p.n_semi + p.n_anti == p.n_left == len(lk)
    rc = {}
    for k in rk:
        if k is not None:
            rc[k] = rc.get(k, 0) + 1
    assert p.n_inner == sum(rc.get(k, 0) for k in lk if k is not None)
    assert p.n_semi == joins.matched(left, right, "k").count()
