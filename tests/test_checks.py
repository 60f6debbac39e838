"""Each check flags a violating row and lets a null through where it should."""

from marketlens.operators.checks import (
    Check,
    accepted_range_violations,
    accepted_values_violations,
    fused_report,
    not_null_violations,
    relationships_violations,
    unique_combination_violations,
    unique_violations,
)


def _df(spark):
    rows = [(1, "a", 0.5, "x"), (1, "b", 1.5, None), (2, "a", None, "y"), (None, "zz", -1.0, "x")]
    return spark.createDataFrame(rows, "k bigint, s string, r double, t string")


def test_unique_ignores_nulls(spark):
    assert [r.unique_field for r in unique_violations(_df(spark), "k").collect()] == [1]


def test_not_null(spark):
    assert not_null_violations(_df(spark), "k").count() == 1


def test_accepted_values_null_passes(spark):
    bad = accepted_values_violations(_df(spark), "s", ["a", "b"]).collect()
    assert [r.value_field for r in bad] == ["zz"]
    assert accepted_values_violations(_df(spark), "t", ["x", "y"]).count() == 0


def test_relationships_null_child_passes(spark):
    parent = spark.createDataFrame([(1,)], "id bigint")
    assert [r.from_field for r in relationships_violations(_df(spark), "k", parent, "id").collect()] == [2]


def test_unique_combination(spark):
    assert unique_combination_violations(_df(spark), ["k", "s"]).count() == 0
    assert unique_combination_violations(_df(spark), ["t"]).count() == 1


def test_accepted_range_inclusive_null_passes(spark):
    assert accepted_range_violations(_df(spark), "r", 0, 1).count() == 2
    assert accepted_range_violations(_df(spark), "r", 0.5, 1.5).count() == 1


def test_fused_report_matches_single_checks(spark):
    df = _df(spark)
    checks = [
        Check("t", "unique", ("k",)),
        Check("t", "not_null", ("k",)),
        Check("t", "accepted_values", ("s",), values=("a", "b")),
        Check("t", "accepted_range", ("r",), min_value=0, max_value=1),
        Check("t", "unique_combination", ("k", "s")),
        Check("t", "unique_combination", ("t",)),
    ]
    parts = fused_report(df, checks)
    got = {}
    for p in parts:
        for r in p.collect():
            got[(r.check_name, r.column_name)] = r.violations
    assert got == {
        ("unique", "k"): 1,
        ("not_null", "k"): 1,
        ("accepted_values", "s"): 1,
        ("accepted_range", "r"): 2,
        ("unique_combination", "k,s"): 0,
        ("unique_combination", "t"): 1,
    }


def test_declared_suite_size():
    from marketlens.plans.quality import CHECKS, DECLARED_CHECK_COUNT

    assert DECLARED_CHECK_COUNT == 78  # + the singular reconciliation = 79
    assert len(CHECKS) == 79  # one added relationship (line -> order)


def test_suite_is_clean_on_fixture_except_reconciliation(warehouse):
    from marketlens.plans.quality import dq_report, failing_checks

    from marketlens.plans.quality import assert_checks

    report = dq_report(warehouse)
    assert failing_checks(report) == []
    warn = assert_checks(report)
    assert len(warn) == 1 and warn[0].check_name == "assert_payment_matches_order_value" and warn[0].violations > 0


def test_error_severity_raises(spark):
    import pytest

    from marketlens.plans.quality import DataQualityError, assert_checks

    report = spark.createDataFrame(
        [("t", "unique", "k", "error", 2), ("t", "x", "k", "warn", 5)],
        "table_name string, check_name string, column_name string, severity string, violations bigint",
    )
    with pytest.raises(DataQualityError):
        assert_checks(report)


def test_uniqueness_moves_digests_as_bytes(spark):
    """Keys of all kinds are counted exactly; digests in hexadecimal travel at half their length."""
    digest = "0123456789abcdef" * 2
    keys = [digest, digest, digest.upper(), digest.upper(), "\0" * 17, "\0" * 17, digest + "\n", "a", "=a", "", None, None]
    df = spark.createDataFrame([(k, "x") for k in keys], "k string, c string")
    (part,) = fused_report(df, [Check("m", "unique", ("k",)), Check("m", "unique_combination", ("k", "c"))])
    assert [r.violations for r in part.orderBy("check_name").collect()] == [3, 4]
    assert "unhex" in part._jdf.queryExecution().executedPlan().toString()


def test_packed_keys_come_back(spark):
    from marketlens.functions.semantics import packed_key, unpacked_key

    keys = [None, "", "a", "=a", "0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "\0" * 17, "0123456789abcdef" * 2 + "\n", "é"]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", packed_key("k").alias("p"))
    found = rows.select("k", "p", unpacked_key("p").alias("back")).collect()
    assert all(r.k == r.back for r in found) and len({None if r.p is None else bytes(r.p) for r in found}) == len(keys)
