from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators.copy import contents_equal, multiset_delta, multiset_difference, schema_signature, verification_summary

SCHEMA = "r_regionkey LONG, r_name STRING"


def test_same_count_different_values(spark):
    a = spark.createDataFrame([(1, "AFRICA"), (1, "AFRICA"), (2, None)], SCHEMA)
    b = spark.createDataFrame([(1, "AFRICA"), (2, None), (3, "WRONG")], SCHEMA)
    assert not contents_equal(a, b)
    diff = sorted((r.r_regionkey, r._side) for r in multiset_difference(a, b).collect())
    assert diff == [(1, "source_only"), (3, "copy_only")]


def test_multiplicity_and_nulls(spark):
    a = spark.createDataFrame([(1, "AFRICA"), (2, None)], SCHEMA)
    b = spark.createDataFrame([(1, "AFRICA"), (2, None), (2, None)], SCHEMA)
    assert not contents_equal(a, b)
    delta = multiset_delta(a, b).collect()
    assert [(r.r_regionkey, r.source_count, r.copy_count) for r in delta] == [(2, 1, 2)]
    assert contents_equal(a, a.union(a.limit(0)))


def test_column_order_is_part_of_schema(spark):
    a = spark.createDataFrame([(1, "A")], SCHEMA)
    b = spark.createDataFrame([("A", 1)], "r_name STRING, r_regionkey LONG")
    assert schema_signature(a) != schema_signature(b)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=12),
       st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=12))
def test_delta_matches_counter(spark, xs, ys):
    from collections import Counter

    a = spark.createDataFrame(xs, SCHEMA)
    b = spark.createDataFrame(ys, SCHEMA)
    ca, cb = Counter(xs), Counter(ys)
    expected = {k: (ca[k], cb[k]) for k in set(ca) | set(cb) if ca[k] != cb[k]}
    got = {(r.r_regionkey, r.r_name): (r.source_count, r.copy_count) for r in multiset_delta(a, b).collect()}
    assert got == expected
    assert contents_equal(a, b) == (ca == cb)


def test_nested_nulls_differ(spark):
    a = spark.createDataFrame([([None, 1], (1, None))], "a array<int>, s struct<x:int,y:int>")
    b = spark.createDataFrame([([1, None], (1, None))], a.schema)
    c = spark.createDataFrame([([None, 1], (None, 1))], a.schema)
    assert contents_equal(a, a) and not contents_equal(a, b) and not contents_equal(a, c)


def test_difference_repeats_surplus_rows_and_summary_counts_them(spark):
    a = spark.createDataFrame([(7, "x")] * 5 + [(8, None)], SCHEMA)
    b = spark.createDataFrame([(7, "x")] * 2 + [(9, "y")], SCHEMA)
    rows = sorted((r.r_regionkey, r._side) for r in multiset_difference(a, b).collect())
    assert rows == [(7, "source_only")] * 3 + [(8, "source_only"), (9, "copy_only")]
    assert tuple(verification_summary(a, b).first()) == (6, 3, 3, False)
    assert tuple(verification_summary(a, a).first()) == (6, 6, 0, True)
    assert not verification_summary(a, a.toDF("r_regionkey", "other")).first().equal
