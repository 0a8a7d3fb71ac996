"""Data-quality checks (Q1-Q7) on small frames."""

from tallyspark.operators import checks


def test_checks_return_failing_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "zz"), (None, "b"), (None, "b")],
                               "k bigint, s string")
    assert sorted((str(r.k), r.s, r.n_records) for r in checks.check_unique_combination(df, ["k", "s"]).collect()) \
        == [("1", "a", 2), ("None", "b", 2)]
    assert checks.check_not_null(df, "s").count() == 1
    assert [tuple(r) for r in checks.check_unique(df, "k").collect()] == [(1, 2)]   # NULL ignored
    assert [tuple(r) for r in checks.check_accepted_values(df, "s", ["a", "b"]).collect()] == [("zz", 1)]
    parent = spark.createDataFrame([(1,), (3,)], "id bigint")
    assert sorted(r.k for r in checks.check_relationship(df, "k", parent, "id").collect()) == [2]


def test_run_checks_and_twin_diff(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a")], "k bigint, s string")
    suite = [checks.Check("uniq", "t", checks.check_unique_combination(df, ["k", "s"])),
             checks.Check("nn", "t", checks.check_not_null(df, "s"))]
    out = {r.check_name: (r.failing_rows, r.passed) for r in checks.run_checks(suite).collect()}
    assert out == {"uniq": (1, False), "nn": (0, True)}
    other = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, s string")
    r = checks.rebuild_equals_incremental("m", df, other).first()
    assert (r.full_rows, r.incremental_rows, r.n_diff) == (2, 2, 2)
    assert checks.differences(df, df).count() == 0


def test_rows_of_one_group_are_compared_as_a_multiset(spark):
    def diff(full, incremental, schema="k string, x double, y double"):
        r = checks.rebuild_equals_incremental("m", spark.createDataFrame(full, schema), spark.createDataFrame(incremental, schema)).first()
        return r.full_rows, r.incremental_rows, r.n_diff

    one = "k string, x double"
    assert diff([("a", 1.0), ("a", 3.0)], [("a", 2.0), ("a", 2.0)], one) == (2, 2, 4)
    assert diff([("a", 1.0), ("a", 3.0)], [("a", 3.0), ("a", 1.0)], one) == (2, 2, 0)
    assert diff([("a", 1.0), ("a", 1.0)], [("a", 1.0)], one) == (2, 1, 1)
    # the last bits of a sum are no difference, in any column and beside equal values
    assert diff([("a", 0.1 + 0.2, 5.0), ("a", 0.3, 6.0)], [("a", 0.3, 5.0), ("a", 0.1 + 0.2, 6.0)]) == (2, 2, 0)
    # values meet as rows: the columns of two rows changed about are a difference
    assert diff([("a", 1.0, 5.0), ("a", 2.0, 6.0)], [("a", 1.0, 6.0), ("a", 2.0, 5.0)]) == (2, 2, 4)
    # NULL, NaN and infinities are values
    nan, inf = float("nan"), float("inf")
    assert diff([("a", None), ("a", nan), ("a", inf)], [("a", nan), ("a", inf), ("a", None)], one) == (3, 3, 0)
    assert diff([("a", None)], [("a", 0.0)], one) == (1, 1, 2)
    assert diff([("a", None), ("a", None)], [("a", None), (None, None)], one) == (2, 2, 2)
    assert diff([], [], one) == (0, 0, 0)
    assert diff([(None, 1e-18)], [(None, 0.0)], one) == (1, 1, 0)


def test_checks_of_a_table_share_one_scan(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 9), (2, None, 1), (2, None, 2), (3, "zz", None), (None, "b", 1), (None, "b", 3)],
                               "k bigint, s string, _n bigint")
    parent = spark.createDataFrame([(1,), (1,), (9,), (None,)], "k bigint")
    spec = {"nn_s": checks.NotNull("s"), "nn_k": checks.NotNull("k"), "acc": checks.Accepted("s", ("a", "b")),
            "uniq": checks.Unique(("k", "s")), "uniq_k": checks.Unique(("k",), ignore_null=True),
            "rel": checks.Related("_n", parent, "k")}
    want = {"nn_s": 2, "nn_k": 2, "acc": 1, "uniq": 3, "uniq_k": 2, "rel": 2}
    for names in (list(spec), ["nn_s", "rel"], ["uniq", "nn_k"], ["acc"], ["uniq_k", "acc"]):
        out = checks.check_tables([checks.TableChecks("t", df, {n: spec[n] for n in names})]).collect()
        assert [(r.check_name, r.table_name) for r in out] and {r.check_name: r.failing_rows for r in out} == {n: want[n] for n in names}
        assert all(r.passed == (r.failing_rows == 0) for r in out)
    empty = checks.check_tables([checks.TableChecks("t", df.limit(0), spec)]).collect()
    assert {r.failing_rows for r in empty} == {0}
