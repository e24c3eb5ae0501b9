"""The whole pipeline over files, run twice, and fed as a stream."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from docketlake.operators import calls as C
from docketlake.plans import stages as S
from docketlake.schemas import MANIFEST, PARSING
from docketlake.session import scratch_path
from docketlake.sources import files, tables as T
from docketlake.streaming.incremental import load_new_files


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


class Busy(Exception):
    status_code = 503


def remembering(folder):
    """Clients that share what they were asked, however many tasks there are: name of a prompt -> times."""
    os.makedirs(folder, exist_ok=True)

    def asked(name):
        path = f"{folder}/{name}"
        with open(path, "a") as f:
            f.write("x")
        return os.path.getsize(path)

    return asked


def make_client(asked):
    def ask(prompt):
        if "flaky" in prompt and asked("flaky") < 3:
            raise Busy("busy")
        if "broken" in prompt:
            return "no json"
        if "odd" in prompt:
            return '{"actions": null}'
        return json.dumps({"actions": [{"action_type": "civil", "full_text": "t", "settlement": True,
                                        "respondents": [{"name": "A"}, {"name": "B"}]}]})

    return ask


def local(path):
    return path.removeprefix("file:")


def test_pipeline(spark, monkeypatch):
    monkeypatch.setattr("docketlake.operators.calls.INITIAL_DELAY", 0.0)
    base = scratch_path(spark, "pipeline")
    asked = remembering(f"{local(base)}-asked")

    def client():
        return make_client(asked)

    raw = f"{base}/raw"
    work = S.plan_downloads(spark, base, "http://x", 2006, 2007, raw)
    assert work.select("url").distinct().count() == 730
    urls = [r.url for r in work.where("cand_rank = 1").orderBy("date").limit(4).collect()]
    t = dt.datetime(2020, 1, 1)
    log = spark.createDataFrame(
        [(urls[0], urls[0], urls[0], 0, 1, 200, None, 5, t), (urls[1], urls[1], urls[1], 0, 1, 404, None, None, t),
         (urls[2], urls[2], urls[2], 0, 1, 503, None, None, t)],
        "url STRING, primary_url STRING, request_url STRING, attempt INT, cand_rank INT, http_status INT, "
        "error STRING, bytes BIGINT, fetched_at TIMESTAMP_NTZ")
    stats = S.record_downloads(spark, base, log).first()
    assert (stats.completed, stats.failed, stats.skipped, stats.skipped_failed, stats.total) == (1, 2, 0, 0, 365)
    again = S.plan_downloads(spark, base, "http://x", 2006, 2007, raw)
    assert again.select("url").distinct().count() == 728
    assert S.plan_downloads(spark, base, "http://x", 2006, 2007, raw, retry_non_404=True).select(
        "url").distinct().count() == 729

    head = "ADMINISTRATIVE PROCEEDINGS\n"
    pages = {"2006-01-01.txt": head + "plain", "2006-01-02.txt": head + "broken", "2006-01-03.txt": head + "odd",
             "2006-01-04.txt": "HOLDINGS", "2006-01-05.htm": "<p>civil proceedings</p>flaky"}
    for name, text in pages.items():
        write(f"{local(raw)}/2006/digest_{name}", text.encode())
    write(f"{local(raw)}/2006/digest_2006-01-06.pdf", b"%PDF")
    write(f"{local(raw)}/2006/notes.md", b"x")
    stats = S.parse_year(spark, base, raw, 2006).first()
    assert (stats.completed, stats.skipped, stats.needs_converter, stats.total) == (5, 0, 1, 6)
    stats = S.parse_year(spark, base, raw, 2006).first()
    assert (stats.completed, stats.skipped, stats.needs_converter) == (0, 5, 1)
    stored = T.read_or_empty(spark, f"{base}/parsing_results", PARSING)
    assert stored.where("parsing_status = 'skipped' AND parsed_at IS NOT NULL").count() == 5
    assert S.parse_year(spark, base, raw, 1999).first().total == 0

    outcome = {str(r.digest_date)[-1]: r.outcome for r in S.extract_texts(spark, base, client, 2006).collect()}
    assert outcome == {"1": "ok", "2": "failed", "3": "error", "5": "ok"}
    year, total = sorted(spark.read.parquet(f"{base}/extraction_stats").collect(), key=lambda r: r.year or 0)[::-1]
    assert (year.total, year.skipped, year.processed, year.with_actions, year.errors, year.failed) == (4, 0, 3, 3, 1, 1)
    assert (total.year, total.total) == (None, 4)
    kept = {r.outcome: r.error_path for r in spark.read.parquet(f"{base}/extraction_outcomes").collect()}
    assert kept["ok"] is None and kept["error"]
    # Only the one in error is still pending.
    assert [r.outcome for r in S.extract_texts(spark, base, client).collect()] == ["error"]
    assert sorted(r.outcome for r in S.extract_texts(spark, base, client, retry_failed=True).collect()) == [
        "error", "failed"]

    stats = S.load_extractions(spark, base).first()
    assert (stats.loaded, stats.no_actions, stats.total_actions) == (2, 2, 2)
    assert S.load_extractions(spark, base).first().loaded == 0
    assert S.load_extractions(spark, base, 2006, full_reload=True).first().loaded == 2
    reports = S.dashboard(spark, base)
    assert reports["total_actions"].first().n == 2
    assert reports["unique_respondents"].first().n == 2
    assert reports["settlement_rate"].first().label == "100%"
    quality = {(r.year, r.parsing_status): r.n for r in reports["parse_quality"].collect()}
    assert quality == {(2006, "skipped"): 4}  # the .htm file is no address the manifest expects


class Counted(Exception):
    pass


def test_output_path_names_a_digest(spark):
    """Second files of a stem, files without a date, several digests of a date."""
    base = scratch_path(spark, "identity")
    raw, head = f"{base}/raw", "ADMINISTRATIVE PROCEEDINGS\n"
    for name, text in {"digest_1985-01-07.htm": f"<p>{head}first</p>", "digest_1985-01-07.txt": head + "second",
                       "digest_1985-1-7.txt": head + "odd", "digest_1985-02-01.txt": head + "pdf failed",
                       "digest_undated.txt": head, "digest_none.txt": "HOLDINGS", "digest_1985-03-01.html": "<p>x</p>"}.items():
        write(f"{local(raw)}/1985/{name}", text.encode())
    write(f"{local(raw)}/1985/digest_1985-02-01.pdf", b"%PDF")
    stats = S.parse_year(spark, base, raw, 1985).first()
    assert (stats.completed, stats.skipped, stats.needs_converter, stats.total) == (6, 1, 1, 8)
    write(f"{local(raw)}/1985/digest_1985-03-01.txt", b"later")
    stats = S.parse_year(spark, base, raw, 1985).first()
    assert (stats.completed, stats.skipped, stats.needs_converter, stats.total) == (0, 9, 0, 9)
    texts = {r.out_path.split("/")[-1]: r.pdf_path.split("/")[-1] for r in spark.read.parquet(f"{base}/digest_text").collect()}
    assert texts == {"digest_1985-01-07.md": "digest_1985-01-07.htm", "digest_1985-1-7.md": "digest_1985-1-7.txt",
                     "digest_1985-02-01.md": "digest_1985-02-01.txt", "digest_undated.md": "digest_undated.txt",
                     "digest_none.md": "digest_none.txt", "digest_1985-03-01.md": "digest_1985-03-01.html"}

    def client():
        def ask(prompt):
            assert "odd" in prompt or "first" in prompt or "pdf failed" in prompt
            return '{"actions": null}' if "odd" in prompt else '{"actions": []}'
        return ask

    def names(rows):
        return {r.out_path.split("/")[-1]: (r.outcome, r.error_class, r.attempts) for r in rows.collect()}

    first = names(S.extract_texts(spark, base, client, 1985))
    error = {"digest_undated.md": ("error", "ValueError", 0)}
    assert {k: v[0] for k, v in first.items()} == {
        "digest_1985-01-07.md": "ok", "digest_1985-02-01.md": "ok", "digest_1985-1-7.md": "error", "digest_undated.md": "error"}
    assert first["digest_1985-01-07.md"][2] == 1 and first["digest_undated.md"] == error["digest_undated.md"]
    stored = files.read_extractions(spark, f"{base}/extractions")
    assert stored.count() == 2 and {str(r.digest_date) for r in stored.collect()} == {"1985-01-07", "1985-02-01"}

    def sane():
        return lambda prompt: '{"actions": []}'

    assert {k: v[0] for k, v in names(S.extract_texts(spark, base, sane)).items()} == {
        "digest_1985-1-7.md": "ok", "digest_undated.md": "error"}

    def none():
        def ask(prompt):
            raise Counted("a call for a digest that has a record")
        return ask

    assert names(S.extract_texts(spark, base, none)) == error
    assert files.read_extractions(spark, f"{base}/extractions").count() == 3
    assert files.marks(spark, f"{base}/call_log_open") == []


def test_paid_answers_survive_a_run_that_dies(spark, monkeypatch):
    base = scratch_path(spark, "paid")
    for day in ("01", "02"):
        write(f"{local(base)}/raw/1990/digest_1990-01-{day}.txt", b"CIVIL PROCEEDINGS\n")
    S.parse_year(spark, base, f"{base}/raw", 1990)

    def client():
        return lambda prompt: '{"actions": []}'

    with monkeypatch.context() as m:
        m.setattr(files, "write_extractions", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        try:
            S.extract_texts(spark, base, client)
        except RuntimeError as e:
            assert str(e) == "died"
    write(f"{local(base)}/raw/1990/digest_1990-01-03.txt", b"CIVIL PROCEEDINGS\nnew")
    S.parse_year(spark, base, f"{base}/raw", 1990)

    def only_new():
        def ask(prompt):
            assert "new" in prompt
            return '{"actions": []}'
        return ask

    assert [r.outcome for r in S.extract_texts(spark, base, only_new).collect()] == ["ok"] * 3
    assert files.read_extractions(spark, f"{base}/extractions").count() == 3
    assert S.extract_texts(spark, base, only_new).count() == 0


def test_reports_without_tables(spark):
    base = scratch_path(spark, "nothing")
    assert not T.tables_present(spark, base, ["enforcement_actions"])
    reports = S.dashboard(spark, base)
    assert reports["total_actions"].first().n == 0
    assert tuple(reports["settlement_rate"].first()) == (None, None, None, None)
    for report in reports.values():
        report.collect()


def record(day, *names):
    return {"digest_date": day, "has_enforcement_actions": bool(names), "extraction_notes": None, "unknown": 1,
            "actions": [{"action_type": "civil", "full_text": n, "respondents": [{"name": n}]} for n in names]}


def test_pretty_printed_files(spark):
    base = scratch_path(spark, "whole")
    for day, names in (("1999-01-02", "b"), ("1999-01-01", "a"), ("1998-05-05", "z"), ("1998-06-06", "")):
        path = f"{local(base)}/extractions/{day[:4]}/digest_{day}.json"
        write(path, json.dumps(record(day, *names), indent=2).encode())
    write(f"{local(base)}/extractions/1998/digest_1998-07-07.json", b"{ broken")
    stats = S.load_extractions(spark, base, whole_files=True).first()
    assert (stats.loaded, stats.no_actions, stats.errors) == (3, 1, 1)
    actions = T.enforcement_tables(spark, base)["enforcement_actions"].orderBy("id").collect()
    assert [a.full_text for a in actions] == ["z", "a", "b"]
    rejects = T.rejects(spark, base).collect()
    assert [(r.file.split("/")[-1], r.reason) for r in rejects] == [("digest_1998-07-07.json", "unreadable file")]
    stats = S.load_extractions(spark, base, whole_files=True, full_reload=True).first()
    assert (stats.loaded, stats.errors) == (3, 1)


def test_a_load_that_was_overtaken_is_refused(spark, monkeypatch):
    base = scratch_path(spark, "overtaken")
    day = json.dumps(record("1999-01-01", "a"))
    write(f"{local(base)}/extractions/1999/digest_1999-01-01.json", day.encode())
    write_load = T.write_load

    def overtaken(*args):
        monkeypatch.setattr(T, "write_load", write_load)
        assert S.load_extractions(spark, base, whole_files=True).first().loaded == 1
        return write_load(*args)

    monkeypatch.setattr(T, "write_load", overtaken)
    with pytest.raises(RuntimeError, match="another load"):
        S.load_extractions(spark, base, whole_files=True)
    assert T.enforcement_tables(spark, base)["enforcement_actions"].select("id").collect() == [(1,)]


def test_stream_of_new_files(spark):
    base, check = scratch_path(spark, "stream"), scratch_path(spark, "check")
    write(f"{local(base)}/extractions/year=1999/a.json", json.dumps(record("1999-01-01", "a")).encode())
    load_new_files(spark, f"{base}/extractions", base, check).awaitTermination()
    write(f"{local(base)}/extractions/year=1999/b.json",
          "\n".join(json.dumps(record(d, "b")) for d in ("1999-01-02", "1999-01-01")).encode())
    load_new_files(spark, f"{base}/extractions", base, check).awaitTermination()
    actions = T.enforcement_tables(spark, base)["enforcement_actions"]
    assert sorted((a.id, str(a.digest_date)) for a in actions.collect()) == [(1, "1999-01-01"), (2, "1999-01-02")]
    stored = files.read_extractions(spark, f"{base}/extractions", fmt="json").select(
        "digest_date", "has_enforcement_actions", "actions", "extraction_notes", F.lit("x.md").alias("out_path"), "year")
    files.write_extractions(stored, f"{base}/records")
    again = scratch_path(spark, "again")
    load_new_files(spark, f"{base}/records", again, f"{check}-parquet", fmt="parquet").awaitTermination()
    assert T.enforcement_tables(spark, again)["enforcement_actions"].count() == 3


def test_digests_without_sections_get_a_record(spark):
    base = scratch_path(spark, "negative")
    write(f"{local(base)}/raw/1990/digest_1990-01-01.txt", b"CIVIL PROCEEDINGS\n")
    write(f"{local(base)}/raw/1990/digest_1990-01-02.txt", b"HOLDINGS")
    S.parse_year(spark, base, f"{base}/raw", 1990)

    def client():
        return lambda prompt: '{"actions": []}'

    for _ in range(2):
        S.extract_texts(spark, base, client, store_negative=True)
    stored = {str(r.digest_date): (r.has_enforcement_actions, r.extraction_notes)
              for r in files.read_extractions(spark, f"{base}/extractions").collect()}
    assert files.read_extractions(spark, f"{base}/extractions").count() == 2
    assert stored["1990-01-02"] == (False, "No enforcement action sections detected by pre-filter")
    assert sorted((r.total, r.skipped) for r in spark.read.parquet(f"{base}/extraction_stats").where(
        "year IS NULL").collect()) == [(0, 2), (1, 0)]


def keyed(spark, year, *names):
    return spark.createDataFrame([(n, year) for n in names], "url STRING, year INT").selectExpr(
        *[f"CAST({'url' if c == 'url' else 'year' if c == 'year' else 'NULL'} AS {t}) AS {c}"
          for c, t in (x.split() for x in MANIFEST.split(", "))])


def urls_of(spark, base):
    return {r.url for r in T.read_or_empty(spark, f"{base}/download_manifest", MANIFEST).collect()}


def test_published_tables_change_together(spark, monkeypatch):
    base = scratch_path(spark, "state")

    def publish(df, other):
        T.publish(spark, base, {"download_manifest": (df, ["year"]), "other": (other, ["year"])})

    def others():
        return {r.url for r in spark.read.parquet(f"{base}/other").collect()}

    publish(keyed(spark, 2000, "a").unionByName(keyed(spark, 2001, "b")), keyed(spark, 2000, "o"))
    # Before everything is staged: nothing of it is ever seen.
    with monkeypatch.context() as m:
        m.setattr(T, "create_file", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):
            publish(keyed(spark, 2000, "x"), keyed(spark, 2000, "x"))
    assert urls_of(spark, base) == {"a", "b"}
    T.finish_published(spark, base)
    assert urls_of(spark, base) == {"a", "b"} and files.marks(spark, f"{base}/_staged") == []
    # Between the two tables: the next run finishes it.
    real, done = T.put_partitions, []

    def once(*args):
        if done:
            raise RuntimeError("died")
        done.append(real(*args))

    with monkeypatch.context() as m:
        m.setattr(T, "put_partitions", once)
        with pytest.raises(RuntimeError, match="died"):
            publish(keyed(spark, 2000, "c"), keyed(spark, 2000, "p").unionByName(keyed(spark, 2003, "q")))
    assert urls_of(spark, base) == {"b", "c"} and others() == {"o"}
    T.finish_published(spark, base)
    assert urls_of(spark, base) == {"b", "c"} and others() == {"p", "q"}
    assert files.marks(spark, f"{base}/_staged") == []


def test_a_parse_that_dies_between_texts_and_results_is_finished(spark, monkeypatch):
    base = scratch_path(spark, "publish")
    write(f"{local(base)}/raw/1990/digest_1990-01-01.pdf", b"%PDF")
    write(f"{local(base)}/raw/1990/digest_1990-01-02.txt", b"two")
    pages = spark.createDataFrame([(f"{base}/raw/1990/digest_1990-01-01.pdf", "one", 9)], "path STRING, text STRING, page_count INT")
    real, done = T.put_partitions, []

    def once(*args):
        if done:
            raise RuntimeError("died")
        done.append(real(*args))

    with monkeypatch.context() as m:
        m.setattr(T, "put_partitions", once)
        with pytest.raises(RuntimeError, match="died"):
            S.parse_year(spark, base, f"{base}/raw", 1990, pages)
    assert spark.read.parquet(f"{base}/digest_text").count() == 2
    stats = S.parse_year(spark, base, f"{base}/raw", 1990, pages).first()
    assert (stats.completed, stats.skipped, stats.total) == (0, 2, 2)
    stored = {r.pdf_path[-14:]: r for r in T.read_or_empty(spark, f"{base}/parsing_results", PARSING).collect()}
    assert stored["1990-01-01.pdf"].page_count == 9 and stored["1990-01-01.pdf"].parsed_at is not None
    assert spark.read.parquet(f"{base}/digest_text").count() == 2


def prompts_in(spark, base, n, batch):
    work = spark.range(n).selectExpr("concat('k', id) AS prompt_key", "concat('p', id) AS prompt").coalesce(1)
    C.store_prompts(work, f"{base}/prompts", batch)


def test_waiting_prompts_wait_together(spark):
    """100 prompts that are to be tried again take about as long as one."""
    took = {}
    for n in (1, 100):
        base = scratch_path(spark, f"wait{n}")
        asked = remembering(f"{local(base)}-asked")

        def client(asked=asked):
            def ask(prompt):
                if asked(prompt) < 3:
                    raise Busy("busy")
                return "fine"
            return ask

        prompts_in(spark, base, n, 1000)
        start = time.time()
        C.call_in_batches(spark, f"{base}/prompts", f"{base}/log", f"{base}/checkpoint", client, initial_delay=2.0, pause_s=0.5)
        took[n] = time.time() - start
        log = C.read_log(spark, f"{base}/log").groupBy("attempt", "http_status", "last").count().collect()
        assert {tuple(r) for r in log} == {(0, 503, False, n), (1, 503, False, n), (2, 200, True, n)}
    assert 6 <= took[100] < took[1] + 15


def test_tries_end(spark):
    base = scratch_path(spark, "tries")

    def client():
        def ask(prompt):
            error = Busy("no") if prompt == "p0" else ValueError("bad")
            raise error
        return ask

    prompts_in(spark, base, 2, 10)
    C.call_in_batches(spark, f"{base}/prompts", f"{base}/log", f"{base}/checkpoint", client, max_tries=3, initial_delay=0.0)
    log = sorted(tuple(r)[:3] + (r.last,) for r in C.read_log(spark, f"{base}/log").collect())
    assert log == [("k0", 0, 503, False), ("k0", 1, 503, False), ("k0", 2, 503, True), ("k1", 0, None, True)]


def test_a_run_that_dies_asks_again_for_one_batch_at_most(spark):
    base, batch = scratch_path(spark, "killed"), 5
    asked = remembering(f"{local(base)}-asked")
    fuse = f"{local(base)}-fuse"
    write(fuse, b"x")

    def client():
        def ask(prompt):
            if prompt == "p12" and os.path.exists(fuse):
                raise SystemExit("killed")   # no error of the call: the task dies
            asked(prompt)
            return f"answer {prompt}"
        return ask

    prompts_in(spark, base, 20, batch)
    args = (spark, f"{base}/prompts", f"{base}/log", f"{base}/checkpoint", client)
    with pytest.raises(Exception):
        C.call_in_batches(*args)
    stored = C.read_log(spark, f"{base}/log").count()
    assert stored % batch == 0 and stored < 20
    os.remove(fuse)
    C.call_in_batches(*args)
    assert sorted((r.prompt_key, r.response) for r in C.read_log(spark, f"{base}/log").collect()) == sorted(
        (f"k{i}", f"answer p{i}") for i in range(20))
    again = [n for n in range(20) if os.path.getsize(f"{local(base)}-asked/p{n}") > 1]
    assert len(again) <= batch
    C.call_in_batches(*args)   # nothing is left to ask
    assert sum(os.path.getsize(f"{local(base)}-asked/p{n}") for n in range(20)) <= 20 + 4 * batch


def test_a_batch_of_the_stream_that_is_replayed_changes_nothing(spark):
    base, check = scratch_path(spark, "replay"), scratch_path(spark, "check")
    lines = [record("1999-01-01", "a"), {**record("1999-01-02", "b"), "digest_date": None}]
    write(f"{local(base)}/extractions/a.json", "\n".join(map(json.dumps, lines)).encode())
    load_new_files(spark, f"{base}/extractions", base, check).awaitTermination()
    commits = f"{local(check)}/commits"
    for name in os.listdir(commits):   # as if the stream had died before it noted the batch
        os.remove(f"{commits}/{name}")
    load_new_files(spark, f"{base}/extractions", base, check).awaitTermination()
    assert T.loads(spark, base).count() == 1 and T.rejects(spark, base).count() == 1
    assert T.enforcement_tables(spark, base)["enforcement_actions"].count() == 1
