import datetime as dt

from pyspark.sql import functions as F

from docketlake.functions.labels import kilochars, megabytes, percent_label, spaced_label, title_label
from docketlake.operators import extraction as E, reports as R
from docketlake.schemas import ACTIONS, RESPONDENTS, SANCTIONS, VIOLATIONS


def actions(spark, *rows):
    """Rows of (action_type, settlement)."""
    day = dt.date(2000, 1, 31)
    return spark.createDataFrame(
        [(i, day, t, None, s, None, None, None, None, None, None) for i, (t, s) in enumerate(rows)], ACTIONS)


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_settlement_rate(spark):
    assert tuples(R.settlement_rate(actions(spark, ("a", True), ("a", False), ("a", None), ("a", True)))) == [
        (2, 3, 2 / 3, "67%")]
    assert tuples(R.settlement_rate(actions(spark, ("a", None)))) == [(0, 0, None, "—")]
    assert tuples(R.settlement_rate(actions(spark))) == [(None, None, None, None)]


def test_settlement_by_type(spark):
    df = actions(spark, ("civil", True), ("civil", False), ("criminal", False), ("other", None))
    assert tuples(R.settlement_by_type(df)) == [("civil", 1, 0.5, "Civil")]
    assert sorted(r.action_type for r in R.settlement_by_type(df, include_zero=True).collect()) == ["civil", "criminal"]


def test_months_and_types(spark):
    df = actions(spark, ("civil", None), ("civil", None), ("criminal", None))
    assert tuples(R.actions_by_month(df)) == [(dt.date(2000, 1, 1), 3)]
    assert sorted(tuples(R.action_types(df))) == [("civil", 2, 2 / 3, "Civil"), ("criminal", 1, 1 / 3, "Criminal")]
    assert tuples(R.action_types(actions(spark))) == []


def test_respondents(spark):
    rows = [("A", "company"), ("A", "company"), ("A", None), ("B", None), (None, "other")]
    df = spark.createDataFrame([(i, i, n, t, None) for i, (n, t) in enumerate(rows)], RESPONDENTS)
    assert R.unique_respondents(df).first().n == 2
    assert tuples(R.entity_types(df))[:2] == [("company", 2, 0.4, "Company"), ("unknown", 2, 0.4, "Unknown")]
    # Equal counts go by name, then type; a missing type is a group of its own.
    assert tuples(R.top_respondents(df)) == [
        ("A", "Company", 2), (None, "Other", 1), ("A", "Unknown", 1), ("B", "Unknown", 1)]
    assert len(R.top_respondents(df, k=2).collect()) == 2


def test_statutes_and_sanctions(spark):
    v = spark.createDataFrame([(i, i, s, None) for i, s in enumerate(["b", "a", None, "b", "c"])], VIOLATIONS)
    assert tuples(R.top_statutes(v, k=2)) == [("b", 2), ("a", 1)]
    kinds = ["fine"] * 3 + ["cease_and_desist"] * 2 + ["bar"] * 2 + [None] * 5 + ["other"]
    s = spark.createDataFrame([(i, i, k, None, None, None) for i, k in enumerate(kinds)], SANCTIONS)
    assert tuples(R.sanction_types(s)) == [
        ("fine", "Fine", 3, 3), ("bar", "Bar", 2, 2), ("cease_and_desist", "Cease And Desist", 2, 2),
        ("other", "Other", 1, 1)]


def test_coverage(spark):
    df = spark.createDataFrame([(1990, "completed"), (1990, "skipped"), (1990, "failed"), (1990, "pending"),
                                (1991, "pending")], "year INT, download_status STRING")
    assert sorted(tuples(R.coverage_by_year(df))) == [(1990, 2, 1, 1, 3, 2 / 3), (1991, 0, 0, 1, 0, None)]


def test_labels(spark):
    cases = [("cease-and-desist ORDER", "Cease-And-Desist Order"), ("a/b", "A/B"), ("o'brien", "O'brien"),
             ("cease_and_desist", "Cease_and_desist"), ("", "")]
    df = spark.createDataFrame([(c,) for c, _ in cases], "v STRING")
    got = {r[0]: (r[1], r[2]) for r in df.select("v", title_label(F.col("v")), spaced_label(F.col("v"))).collect()}
    for raw, label in cases:
        assert got[raw][0] == label
    assert got["cease_and_desist"][1] == "Cease And Desist"
    n = spark.createDataFrame([(0.125, 1572864, 1234567)], "r DOUBLE, b BIGINT, k BIGINT")
    assert tuples(n.select(percent_label(F.col("r")), megabytes(F.col("b")), kilochars(F.col("k")))) == [
        ("13%", "1.50", "1234.6")]


CALLS = [
    ([(200, True)], "ok", 1, None),
    ([(503, None), (200, True)], "ok", 2, None),
    ([(503, None), (200, False)], "failed", 2, "invalid answer"),
    ([(429, None)] * 5, "failed", 5, "HTTP 429"),
    ([(401, None), (200, True)], "failed", 1, "HTTP 401"),
    ([(503, None), (None, None)], "error", 2, "lost"),
]


def test_call_resolution(spark):
    rows = [(i, a, s, v, "lost" if s is None else None)
            for i, (log, *_) in enumerate(CALLS) for a, (s, v) in enumerate(log)]
    log = spark.createDataFrame(rows, "k INT, attempt INT, http_status INT, valid BOOLEAN, error STRING")
    got = {r.k: (r.status, r.attempts, r.message) for r in E.resolve_calls(log, "k", F.col("valid")).collect()}
    assert got == {i: c[1:] for i, c in enumerate(CALLS)}


def test_waits_are_repeatable_and_bounded(spark):
    log = spark.createDataFrame([(k, a, 503) for k in range(50) for a in range(5)], "k INT, attempt INT, http_status INT")
    first, again = (sorted(tuples(E.retry_schedule(log, "k"))) for _ in range(2))
    assert first == again
    for _, attempt, _, retryable, base, wait in first:
        assert retryable and base == 2.0 * 2 ** attempt and base <= wait <= 1.25 * base
