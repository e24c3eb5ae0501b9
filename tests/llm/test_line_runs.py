"""Line dedup against a brute-force version, and the runs on their own."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docketlake.llm.common import Staging
from docketlake.llm.line_runs import LineRuns, common_lines, dropped_lines, line_counts, without_lines

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def expected(texts, least, shortest=1):
    seen = Counter(k for t in texts for k in {key(line) for line in (t or "").split("\n")} if len(k) >= shortest)
    out = []
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        kept = [line for line in lines if seen[key(line)] < least]
        out.append((i, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def table(spark, texts):
    """Documents with columns whose names clash with those inside the operator."""
    return spark.createDataFrame([(i, t, "en", 1, 2, "x") for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, lang string, h1 bigint, t1 bigint, dropped string")


def got(spark, docs, **options):
    with Staging(spark, "lines") as staging:
        lost = dropped_lines(docs, common_lines(docs, staging, **options))
        rows = without_lines(docs, lost).select("doc_id", "text", "_n_lines", "_n_dropped", "h1", "t1", "dropped").collect()
    assert all((r.h1, r.t1, r.dropped) == (1, 2, "x") for r in rows)
    return sorted(tuple(r)[:4] for r in rows)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(7)
    lines = ["", " ", "Menu", " mENU\t", "© 2020", "É", "é", "a", "\x0bA ", "\xa0a", "x" * 50, *(f"line {i}" for i in range(30))]
    out = ["\n".join(rnd.choice(lines) for _ in range(rnd.randrange(1, 12))) for _ in range(70)]
    return [*out, None, "", "\n", "\n\n", None, *out[:4], *["copied\nMenu\nwhole"] * 12, "\n".join(f"own {i}\nMENU" for i in range(3000))]


@pytest.mark.parametrize("least, batches, fan", [(10, 8, 4), (3, 5, 2), (2, 1, 4), (1, 3, 2), (1000, 4, 3)])
def test_against_brute_force(spark, texts, least, batches, fan):
    assert got(spark, table(spark, texts), least=least, batches=batches, fan=fan) == expected(texts, least)


def test_longer_keys_only(spark, texts):
    assert got(spark, table(spark, texts), least=4, shortest=5) == expected(texts, 4, 5)


def test_repeated_and_missing_ids_and_no_rows(spark, texts):
    docs = table(spark, texts)
    odd = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.lit(7).cast("bigint")))
    want = sorted((t or "", n, d) for _, t, n, d in expected(texts, 10))
    assert sorted((t or "", n, d) for _, t, n, d in got_unordered(spark, odd)) == want
    assert got(spark, docs.limit(0)) == []


def got_unordered(spark, docs):
    with Staging(spark, "lines") as staging:
        lost = dropped_lines(docs, common_lines(docs, staging))
        return [tuple(r) for r in without_lines(docs, lost).select("doc_id", "text", "_n_lines", "_n_dropped").collect()]


def test_runs_are_levelled_and_settled_lines_counted_no_more(spark):
    rows = lambda *pairs: spark.createDataFrame([(h, h, n) for h, n in pairs], "h1 bigint, h2 bigint, docs bigint")
    with LineRuns(spark, least=3, fan=2) as runs:
        runs.add(rows((1, 5), (2, 1)))
        assert [len(x) for x in runs.levels] == [1]
        assert {r.h1 for r in runs.new_in(rows((1, 1), (2, 1), (3, 1))).collect()} == {2, 3}
        runs.add(rows((1, 1), (2, 2), (3, 1)))
        assert [len(x) for x in runs.levels] == [0, 1]
        assert {tuple(r) for r in next(runs.runs()).collect()} == {(1, 1, 5), (2, 2, 3), (3, 3, 1)}
        runs.add(rows((3, 1), (2, 9)))
        assert [len(x) for x in runs.levels] == [1, 1]
        assert {r.h1 for r in runs.settled().collect()} == {1, 2}
        runs.add(rows((3, 1)))
        assert [len(x) for x in runs.levels] == [0, 0, 1]
        assert {r.h1 for r in runs.settled().collect()} == {1, 2, 3}
        names = list(runs._paths)
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_run_side_of_the_merge_is_not_shuffled(spark):
    docs = table(spark, ["a\nb", "b\nc"] * 20)
    with LineRuns(spark, least=1) as runs:
        counts = line_counts(docs, 1).select("h1", "h2", "docs")
        runs.add(counts)
        plan = runs.new_in(counts)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange") == 1 and "Bucketed: true" in plan
        assert runs.new_in(counts).count() == 0
