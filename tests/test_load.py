import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from docketlake.operators import load as L
from docketlake.plans.stages import load_records
from docketlake.schemas import DIGEST
from docketlake.session import scratch_path
from docketlake.sources import tables as T

SCHEMA = f"file STRING, {DIGEST}"
ORDER = ["file"]


def action(n_resp=0, n_viol=0, n_sanc=0, kind="civil", settlement=None, tag="x"):
    return (kind, None, [(f"{tag}r{i}", None, None) for i in range(n_resp)],
            [(f"{tag}v{i}", None) for i in range(n_viol)],
            [("fine", f"{tag}s{i}", None, "$5") for i in range(n_sanc)],
            settlement, None, None, None, tag)


def digest(day, actions, has=True, notes=None, name=None):
    d = dt.date.fromisoformat(day) if day else None
    return (name or f"{(day or 'none')[:4]}/digest_{day}.json", d, has, actions, notes)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_golden_load(spark):
    base = scratch_path(spark, "test")
    first = [digest("2000-01-03", [action(tag="a")] * 10, name="1999/first")]
    load_records(spark, base, frame(spark, first), ORDER)
    # Ten actions stand; respondents get ids up to 7 through another date.
    more = [digest("1999-12-31", [action(7)], name="1999/z")]
    load_records(spark, base, frame(spark, more), ORDER)
    new = frame(spark, [
        digest("2000-01-03", [action(), action()]),
        digest("2000-01-04", []),
        digest("2000-01-05", [action(1, tag="p"), action(0, tag="q")]),
        digest("2000-01-06", [action(3, tag="t")]),
    ])
    stats = load_records(spark, base, new, ORDER).first()
    assert tuple(stats) == (2, 1, 1, 0, 3, 1, 0)
    tables = T.enforcement_tables(spark, base)
    actions = tables["enforcement_actions"].where("digest_date >= '2000-01-05'")
    assert rows_of(actions, "id", "full_text") == [(12, "p"), (13, "q"), (14, "t")]
    resp = tables["respondents"].where("action_id > 11")
    assert rows_of(resp, "id", "action_id", "name") == [
        (8, 12, "pr0"), (9, 14, "tr0"), (10, 14, "tr1"), (11, 14, "tr2")]
    again = load_records(spark, base, new, ORDER).first()
    assert tuple(again) == (0, 3, 1, 0, 0, 1, 0)
    assert T.enforcement_tables(spark, base)["enforcement_actions"].count() == 14


def brute_force(digests):
    """The tables by plain loops in file order."""
    out = {"actions": [], "respondents": [], "violations": [], "sanctions": []}
    for name, day, has, actions, notes in sorted(digests):
        for a in actions if has else []:
            aid = len(out["actions"]) + 1
            out["actions"].append((aid, day, a[9], notes))
            for kind, at in (("respondents", 2), ("violations", 3), ("sanctions", 4)):
                for c in a[at]:
                    out[kind].append((len(out[kind]) + 1, aid, c[0] if kind != "sanctions" else c[1]))
    return out


def test_ids_are_dense_and_in_order_with_a_hot_date(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        # A third of the digests share one date.
        day = "1990-06-01" if i % 3 == 0 else f"19{rng.randrange(60, 99)}-0{rng.randrange(1, 10)}-1{rng.randrange(10)}"
        acts = [action(rng.randrange(3), rng.randrange(3), rng.randrange(3), tag=f"{i}.{j}.")
                for j in range(rng.randrange(4))]
        rows.append(digest(day, acts, has=bool(acts), name=f"{day[:4]}/digest_{day}_{i:04d}", notes=f"n{i}"))
    base = scratch_path(spark, "test")
    load_records(spark, base, frame(spark, rows).repartition(7), ORDER)
    t, want = T.enforcement_tables(spark, base), brute_force(rows)
    assert rows_of(t["enforcement_actions"], "id", "digest_date", "full_text", "extraction_notes") == want["actions"]
    assert rows_of(t["respondents"], "id", "action_id", "name") == want["respondents"]
    assert rows_of(t["violations"], "id", "action_id", "statute") == want["violations"]
    assert rows_of(t["sanctions"], "id", "action_id", "description") == want["sanctions"]
    assert L.orphans({k: t[k] for k in L.CHILDREN}, t["enforcement_actions"]).count() == 0
    for r in L.key_violations(t).collect():
        assert (r.repeated_keys, r.null_rows) == (0, 0)


def test_what_is_not_loaded_is_counted_and_not_staged(spark, monkeypatch):
    from docketlake.plans import stages

    base, staged = scratch_path(spark, "test"), []
    load_records(spark, base, frame(spark, [digest("2001-01-01", [action(1)])]), ORDER)
    monkeypatch.setattr(stages, "drop_scratch", lambda spark, *paths: staged.extend(paths))
    rows = [digest("2001-01-01", [action(4)]), digest("2001-01-02", []), digest("2001-01-03", [action(2)]), digest(None, [action(1)])]
    stats = load_records(spark, base, frame(spark, rows), ORDER).first()
    assert tuple(stats) == (1, 1, 1, 1, 1, 1, 0)
    assert rows_of(spark.read.parquet(staged[0]), "load_outcome") == [("error",), ("loaded",)]


def test_same_record_twice_loads_twice(spark):
    base = scratch_path(spark, "test")
    twin = digest("2001-01-01", [action(1)])
    load_records(spark, base, frame(spark, [twin, twin]), ORDER)
    t = T.enforcement_tables(spark, base)
    assert rows_of(t["enforcement_actions"], "id") == [(1,), (2,)]
    assert rows_of(t["respondents"], "id", "action_id") == [(1, 1), (2, 2)]


def test_a_load_that_dies_leaves_nothing(spark, monkeypatch):
    base = scratch_path(spark, "test")
    load_records(spark, base, frame(spark, [digest("2001-01-01", [action(1)])]), ORDER)
    new = frame(spark, [digest("2001-01-02", [action(2)]), digest("2002-01-02", [action(1)])])

    real = T.balanced

    def dies_at_actions(df, *by):
        if "digest_date" in df.columns:
            raise RuntimeError("executor lost")
        return real(df, *by)

    monkeypatch.setattr(T, "balanced", dies_at_actions)
    with pytest.raises(RuntimeError):
        load_records(spark, base, new, ORDER)
    monkeypatch.undo()
    t = T.enforcement_tables(spark, base)
    assert rows_of(t["respondents"], "id") == [(1,)]
    # Other digests come first; what the dead run wrote for 2001 must not show up with them.
    load_records(spark, base, frame(spark, [digest("2002-03-03", [action(1, tag="later")])]), ORDER)
    t = T.enforcement_tables(spark, base)
    assert rows_of(t["respondents"], "id", "name") == [(1, "xr0"), (2, "laterr0")]
    load_records(spark, base, new, ORDER)
    t = T.enforcement_tables(spark, base)
    assert rows_of(t["respondents"], "id") == [(1,), (2,), (3,), (4,), (5,)]
    assert rows_of(t["enforcement_actions"], "id") == [(1,), (2,), (3,), (4,)]
    assert L.orphans({k: t[k] for k in L.CHILDREN}, t["enforcement_actions"]).count() == 0


def test_reload_replaces_only_its_years(spark):
    base = scratch_path(spark, "test")
    rows = [digest("2001-01-01", [action(1, tag="old")]), digest("2002-01-01", [action(1, tag="keep")])]
    load_records(spark, base, frame(spark, rows), ORDER)
    with pytest.raises(ValueError):
        load_records(spark, base, frame(spark, rows).where("false"), ORDER, replace_years=[2001])
    new = [digest("2001-01-01", [action(2, tag="new")]), digest("2002-01-01", [action(1, tag="no")])]
    load_records(spark, base, frame(spark, new), ORDER, replace_years=[2001])
    t = T.enforcement_tables(spark, base)
    assert [r[1] for r in rows_of(t["enforcement_actions"], "id", "full_text")] == ["keep", "new"]
    assert sorted(r[0] for r in rows_of(t["respondents"], "name")) == ["keepr0", "newr0", "newr1"]
    assert L.orphans({k: t[k] for k in L.CHILDREN}, t["enforcement_actions"]).count() == 0


def test_loaded_days_stand_for_the_dates(spark):
    """Leap days, ends of years, hot days; a look at them reads no action."""
    base = scratch_path(spark, "test")
    days = ["1956-01-01", "1956-12-31", "2000-02-29", "2000-12-31", "2001-01-01", "2001-12-31", "2014-06-07"]
    load_records(spark, base, frame(spark, [digest(d, [action(1)]) for d in days]), ORDER)
    near = ["1956-01-02", "1956-12-30", "2000-03-01", "2001-12-30", "2002-01-01"]
    stats = load_records(spark, base, frame(spark, [digest(d, [action(1)]) for d in [*days, *near, near[0]]]), ORDER).first()
    assert (stats.loaded, stats.skipped_existing, stats.repeated_dates) == (6, 7, 1)
    counts = {r.year: r.n for r in T.loaded_days(spark, base).select("year", F.bitmap_count("days").alias("n")).collect()}
    assert counts == {1956: 4, 2000: 3, 2001: 3, 2002: 1, 2014: 1}
    new = frame(spark, [digest("2014-06-07", [action(1)])])
    read = {f.split("/load=")[0].split("/")[-1] for f in L.classify(new, T.loaded_days(spark, base)).inputFiles() if "/load=" in f}
    assert read == {"loaded_days"}


def test_a_reload_frees_the_days_it_drops(spark):
    base = scratch_path(spark, "test")
    load_records(spark, base, frame(spark, [digest(d, [action(1)]) for d in ("2001-01-01", "2001-01-02")]), ORDER)
    load_records(spark, base, frame(spark, [digest("2001-01-02", [action(2)])]), ORDER, replace_years=[2001])
    stats = load_records(spark, base, frame(spark, [digest(d, [action(1)]) for d in ("2001-01-01", "2001-01-02")]), ORDER).first()
    assert (stats.loaded, stats.skipped_existing) == (1, 1)
    assert T.last_load(spark, base) == 3


@pytest.mark.parametrize("broken, message", [
    (lambda df: df.withColumn("action_id", F.col("action_id") + 100), "rows of no action"),
    (lambda df: df.withColumn("action_id", F.lit(1).cast("bigint") - 1), "rows of no action"),
    (lambda df: df.withColumn("id", F.when(F.col("id") == 4, F.lit(3).cast("bigint")).otherwise(F.col("id"))), "repeat"),
    (lambda df: df.withColumn("id", F.col("id") + 1), "repeat"),
    (lambda df: df.withColumn("name", F.lit(None).cast("string")), "nulls"),
    (lambda df: df.where("id <> 4"), "rows in place of"),
])
def test_a_load_that_breaks_keys_is_refused(spark, monkeypatch, broken, message):
    base = scratch_path(spark, "test")
    real = L.flatten_children

    def flatten(digests, kind, *args):
        rows = real(digests, kind, *args)
        return broken(rows) if kind == "respondents" else rows

    monkeypatch.setattr(L, "flatten_children", flatten)
    with pytest.raises(ValueError, match=message):
        load_records(spark, base, frame(spark, [digest("2001-01-01", [action(3), action(3)])]), ORDER)
    monkeypatch.undo()
    assert T.enforcement_tables(spark, base)["respondents"].count() == 0 and T.loads(spark, base).count() == 0
    assert load_records(spark, base, frame(spark, [digest("2001-01-01", [action(3), action(3)])]), ORDER).first().loaded == 1


def test_a_load_repeated_under_its_name_changes_nothing(spark):
    base = scratch_path(spark, "test")
    rows = frame(spark, [digest("2001-01-01", [action(2)]), digest("2001-01-02", [action(kind=None)]), digest("2001-01-03", [])])
    want = (1, 0, 1, 1, 1, 1, 0)
    for _ in range(2):
        assert tuple(load_records(spark, base, rows, ORDER, run="batch-7").first()) == want
    assert [r.reason for r in T.rejects(spark, base).collect()] == ["action without type"]
    assert T.loads(spark, base).count() == 1


def test_rejects_of_a_load_that_dies_are_not_seen(spark, monkeypatch):
    base = scratch_path(spark, "test")
    rows = frame(spark, [digest("2001-01-01", [action(1)]), digest(None, [action()])])
    with monkeypatch.context() as m:
        m.setattr(T, "commit_load", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):
            load_records(spark, base, rows, ORDER)
    assert T.rejects(spark, base).count() == 0
    load_records(spark, base, rows, ORDER)
    assert T.rejects(spark, base).count() == 1


def test_of_two_loads_at_once_one_is_refused(spark, monkeypatch):
    """Both see the same last commit up to the moment they commit."""
    base = scratch_path(spark, "test")
    monkeypatch.setattr(T, "last_load", lambda spark, base: 0)
    load_records(spark, base, frame(spark, [digest("2001-01-01", [action(1, tag="first")])]), ORDER)
    with pytest.raises(RuntimeError, match="another load"):
        load_records(spark, base, frame(spark, [digest("2001-01-02", [action(1, tag="second")])]), ORDER)
    monkeypatch.undo()
    assert rows_of(T.enforcement_tables(spark, base)["respondents"], "id", "name") == [(1, "firstr0")]


def test_faulty_digests_are_set_aside(spark):
    bad_name = ("civil", None, [(None, None, None)], [], [], None, None, None, None, "x")
    rows = frame(spark, [
        digest(None, [action()]), digest("2000-01-01", [action(kind=None)]),
        digest("2000-01-02", [bad_name]), digest("2000-01-03", [action()]),
        digest("2000-01-04", None, has=None), digest("2000-01-05", [action()], has=False),
        digest("2000-01-06", [action(kind=None)], name="known"),
    ])
    dates = spark.createDataFrame([(dt.date(2000, 1, 6),)], "digest_date DATE")
    got = {r.file[-10:]: (r.load_outcome, r.fault) for r in L.classify(rows, L.day_bitmaps(dates)).collect()}
    assert list(got.values()).count(("loaded", None)) == 1
    assert sorted(v for v in got.values() if v[0] == "error") == [
        ("error", "action without type"), ("error", "no digest date"), ("error", "respondent without name")]
    assert sorted(v[0] for v in got.values() if v[0] in ("no_actions", "skipped_existing")) == [
        "no_actions", "no_actions", "skipped_existing"]


def test_flatten_and_overview_agree(spark):
    rows = frame(spark, [digest("2000-01-01", [action(2, 1, 0), action(0, 0, 3)]), digest("2000-01-02", [action(1, 1, 1)])])
    profile = rows_of(L.action_profile(rows), "digest_date", "pos", "n_respondents", "n_violations", "n_sanctions")
    placed = L.with_offsets(rows, ORDER)
    children = {k: L.flatten_children(placed, k, 1, 1) for k in L.CHILDREN}
    pages = L.assemble_actions(L.flatten_actions(placed, 1), children, 2)
    assert [(r.id, r.page, len(r.respondents), len(r.violations), len(r.sanctions)) for r in pages.orderBy("id", "page").collect()] == [
        (1, 0, 2, 1, 0), (2, 0, 0, 0, 2), (2, 1, 0, 0, 1), (3, 0, 1, 1, 1)]
    over = L.action_overview(L.flatten_actions(placed, 1), *children.values())
    assert [p[2:] for p in profile] == [r[1:4] for r in rows_of(over, "id", "n_resp", "n_viol", "n_sanc")]


def test_assembly_of_an_action_with_a_third_of_all_children(spark):
    """All fields, in pages of bounded length, and no more than a block of ids in one group."""
    n, page = 3000, 7
    acts = [action(n // 3, 2, 0, tag="hot")] + [action(1, 0, 2, tag=f"t{i}") for i in range(n - n // 3)]
    placed = L.with_offsets(frame(spark, [digest("2000-01-01", acts, notes="n")]), ORDER)
    children = {k: L.flatten_children(placed, k, 1, 5).select("id", "action_id", *L.CHILDREN[k]) for k in L.CHILDREN}
    actions = L.flatten_actions(placed, 1)
    got = {(r.id, r.page): r for r in L.assemble_actions(actions, children, page).collect()}
    assert len(got) == n - n // 3 + -(-(n // 3) // page)
    names = [c.name for p in range(-(-(n // 3) // page)) for c in got[1, p].respondents]
    assert names == [f"hotr{i}" for i in range(n // 3)] and all(len(r.respondents) <= page for r in got.values())
    assert all(r.full_text == "hot" and r.extraction_notes == "n" for (i, _), r in got.items() if i == 1)
    assert [tuple(s)[2] for s in got[2, 0].sanctions] == ["t0s0", "t0s1"] and got[2, 0].violations == []
    small = L.child_pages(children["respondents"], "respondents", page, block=16)
    assert small.agg(F.sum(F.size("respondents"))).first()[0] == n // 3 + n - n // 3
    assert sorted(tuple(r) for r in small.collect()) == sorted(
        tuple(r) for r in L.child_pages(children["respondents"], "respondents", page).collect())


def test_assembly_without_children(spark):
    placed = L.with_offsets(frame(spark, [digest("2000-01-01", [action()])]), ORDER)
    children = {k: L.flatten_children(placed, k, 1, 1).select("id", "action_id", *L.CHILDREN[k]) for k in L.CHILDREN}
    rows = L.assemble_actions(L.flatten_actions(placed, 1), children).collect()
    assert [(r.page, r.respondents, r.violations, r.sanctions) for r in rows] == [(0, [], [], [])]


def test_next_ids_of_empty_tables(spark):
    assert set(L.next_ids(L.empty_tables(spark)).first()) == {1}
