"""The plans have the shape that large data needs."""

import os
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from docketlake.operators import load as L, reports as R
from docketlake.operators.keys import first_per_key, missing_from, top_per_group
from docketlake.session import scratch_path
from docketlake.schemas import ACTION_ELEMENT
from docketlake.sources import files
from docketlake.sources.pending import read_pending

ACTIONS = f"ARRAY<{ACTION_ELEMENT}>"
SF = "/root/testdata/sf0.001"
QUERIES = entry.QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# One-task steps over data with a proven bound: one row per range partition, and
# the distinct counts of a grouped table.
BOUNDED_WINDOWS = {"surrogate_ids", "surrogate_child_ids", "sanction_types"}
STORED = {"table_sink", "full_reload"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert ("MapInPandas" in text) == (name == "extract_apply")
    if name not in BOUNDED_WINDOWS:
        lines = text.split("\n")
        for above, below in zip(lines, lines[2:]):
            if re.search(r"\bWindow \[", above):
                assert "SinglePartition" not in below, text


def test_top_lists_do_not_sort_everything(spark):
    for name in ("top_respondents", "top_statutes"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


def test_orphans_hold_no_set_of_all_keys(spark):
    """Keys may be null or repeat; the actions' ids are neither broadcast nor joined."""
    actions = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id BIGINT")
    children = {
        "respondents": spark.createDataFrame([(1,), (2,), (2,)], "action_id BIGINT"),
        "violations": spark.createDataFrame([(3,), (3,), (-1,), (1,), (None,)], "action_id BIGINT"),
        "sanctions": spark.createDataFrame([(3,), (2,)], "action_id BIGINT")}
    lost = L.orphans(children, actions)
    assert {tuple(r) for r in lost.collect()} == {("violations", 4), ("sanctions", 1)} and lost.columns == ["table", "n"]
    assert L.orphans(children, actions.where("false")).agg(F.sum("n")).first()[0] == 10
    text = plan(QUERIES["fk_orphans"](spark, SF))
    assert "Broadcast" not in text and "Join" not in text


def test_scans_read_only_what_they_need(spark):
    text = plan(QUERIES["top_respondents"](spark, SF))
    assert "ReadSchema: struct<o_custkey:bigint>" in text
    text = plan(QUERIES["coverage_by_year"](spark, SF))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text


def test_a_year_reads_its_folder(spark):
    path = scratch_path(spark, "texts")
    files.write_texts(spark.range(10).select(
        (F.col("id") + 1990).cast("int").alias("year"), F.lit("t").alias("text")), path)
    text = plan(files.read_texts(spark, path, 1995))
    assert re.search(r"PartitionFilters: \[isnotnull\(year#\d+\), \(year#\d+ = 1995\)\]", text)


def skewed(spark, n=60000):
    """A third of the rows share one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 12).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("payload"), "id")


def test_anti_join_splits_a_hot_key(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
                  spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
                  spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB"):
        rows = skewed(spark)
        known = spark.range(0, 60000, 2).select(F.col("id").alias("k"))
        out = missing_from(rows, known, "k")
        got = out.collect()
        # Odd ids that keep their own key, and all rows of the hot key.
        assert len(got) == 20000 + sum(1 for i in range(60000) if i % 3 and i % 2)
        assert "skewed" in plan(out).lower()


def test_anti_join_keeps_null_keys(spark):
    rows = spark.createDataFrame([(None,), ("a",), ("b",)], "k STRING")
    known = spark.createDataFrame([("a",), (None,)], "k STRING")
    assert sorted(missing_from(rows, known, "k").collect(), key=str) == sorted([(None,), ("b",)], key=str)


def test_copies_are_reduced_before_the_shuffle(spark):
    text = plan(first_per_key(skewed(spark), "k", F.col("id")))
    assert text.index("Exchange hashpartitioning") < text.index("partial_min_by")


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, None, 5)], "k INT, v STRING, o INT")
    assert sorted(tuple(r) for r in first_per_key(df, "k", F.col("o")).collect()) == [(1, "a", 1), (2, None, 5)]
    assert sorted(tuple(r) for r in first_per_key(df, "k", F.col("o"), last=True).collect()) == [(1, "b", 2), (2, None, 5)]


def test_top_per_group_with_a_hot_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"), F.col("id").alias("o"))
    want = {}
    for r in sorted(df.collect(), key=lambda r: r.o):
        want.setdefault(r.g, []).append(r.o)
    got = {}
    for r in top_per_group(df, "g", "o", 7).orderBy("g", "rn").collect():
        got.setdefault(r.g, []).append(r.o)
    assert got == {g: o[:7] for g, o in want.items()}


def test_parse_quality_multiplies_copies(spark):
    parsing = spark.createDataFrame([("p", "completed")] * 3 + [("p", "failed"), ("q", "skipped"), ("lost", "completed"),
                                                               ("r", None)],
                                    "pdf_path STRING, parsing_status STRING")
    manifest = spark.createDataFrame([("p", 1990), ("p", 1990), ("p", 1991), ("q", None), ("r", 1991)],
                                     "local_path STRING, year INT")
    got = {(r.year, r.parsing_status): (r.n, r.total) for r in R.parse_quality(parsing, manifest).collect()}
    assert got == {(1990, "completed"): (6, 8), (1991, "completed"): (3, 5)}


def test_orphans_are_counted_by_action_first(spark):
    actions = spark.createDataFrame([(1,)], "id BIGINT")
    child = spark.createDataFrame([(1,), (2,), (2,), (3,)], "action_id BIGINT")
    assert [tuple(r) for r in L.orphans({"c": child}, actions).collect()] == [("c", 3)]


def test_nested_rows_move_once_for_their_offsets(spark):
    rows = spark.range(50).selectExpr("CAST(id AS STRING) AS f", f"CAST(NULL AS {ACTIONS}) AS actions")
    text = plan(L.with_offsets(rows, ["f"]))
    moved = [line for line in text.splitlines() if " Exchange " in line and "partitioning" in line]
    assert sum("hashpartitioning(_start" in line for line in moved) == 1 and "SortMergeJoin" not in text


def test_offsets_survive_recomputation(spark):
    """However the rows are dealt over ranges, the same offsets come out."""
    df = spark.range(500).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("f"),
                                 *[(F.col("id") % n).alias(f"n_{k}") for n, k in ((3, "actions"), (2, "respondents"),
                                                                                 (5, "violations"), (7, "sanctions"))])
    out = L.with_offsets(df, ["f"]).select("f", *[f"{k}_offset" for k in L.KINDS])
    first = sorted(tuple(r) for r in out.collect())
    assert first == sorted(tuple(r) for r in out.collect())
    total = 0
    for i, row in enumerate(first):
        assert row[1] == total
        total += i % 3


def test_ranges_follow_the_nested_rows(spark, monkeypatch):
    """More stored bytes are dealt over more ranges, and each digest still finds its own."""
    path = scratch_path(spark, "sized")
    spark.range(300).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("f"), F.repeat(F.uuid(), 20).alias("text"),
                            *[(F.col("id") % 3).alias(f"n_{k}") for k in L.KINDS]).write.parquet(path)
    df = spark.read.parquet(path)
    for size, most, parts in ((1 << 30, 4096, 8), (1, 37, 37), (1, 64, 64)):
        monkeypatch.setattr(L, "RANGE_BYTES", size)
        monkeypatch.setattr(L, "MOST_RANGES", most)
        out = L.with_offsets(df, ["f"])
        assert re.search(rf"rangepartitioning\(f#\d+ ASC NULLS FIRST, {parts}\)", plan(out))
        offsets = [r.actions_offset for r in out.select("f", "actions_offset").orderBy("f").collect()]
        assert offsets == [sum(j % 3 for j in range(i)) for i in range(300)]


def test_broadcast_of_dates_only(spark):
    from docketlake.operators.keys import known_keys

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()

    names = spark.range(10).select(F.col("id").cast("string").alias("k"))
    days = spark.range(10).select(F.date_add(F.current_date(), F.col("id").cast("int")).alias("k"))
    assert hinted(known_keys(days, "k")) and not hinted(known_keys(names, "k"))


def test_only_chosen_raw_files_are_opened(spark):
    root = scratch_path(spark, "raw")
    folder = root.removeprefix("file:") + "/1990"
    os.makedirs(folder)
    for i, suffix in enumerate(["txt", "htm", "html", "pdf", "TXT"] * 4):
        with open(f"{folder}/digest_{i} a%b.{suffix}", "wb") as f:
            f.write(b"x" * (i + 1))
    names = files.raw_files(spark, root, 1990).select("path", "file")
    assert "content" not in plan(names.where("path > ''")) and names.count() == 16
    for i in (0, 1, 2, 3):
        os.chmod(f"{folder}/digest_{i} a%b.{['txt', 'htm', 'html', 'pdf'][i]}", 0)
    os.remove(f"{folder}/digest_5 a%b.txt")
    some = read_pending(spark, names.where("NOT path RLIKE 'digest_[0-3] '"), scratch_path(spark, "names"), at_most=3)
    assert some.rdd.getNumPartitions() >= 4
    assert sorted(len(r.content) for r in some.collect()) == sorted(
        i + 1 for i in range(20) if i > 3 and i != 5 and i % 5 < 4)
    assert read_pending(spark, names.limit(0), scratch_path(spark, "names")).count() == 0
