import datetime as dt

import pytest
from pyspark.sql import functions as F

from docketlake.functions import urls
from docketlake.operators import manifest as M, parsing as P
from docketlake.schemas import MANIFEST, PARSING

BASE = "http://x"

GOLDEN = [
    ("1985-01-07", "1985/dig010785.pdf", ["1985/dig010785.pdf", "dig010785.pdf"]),
    ("2002-01-31", "2002/dig013102.pdf", ["2002/dig013102.pdf", "dig013102.pdf"]),
    ("2002-02-01", "02-01.txt", ["02-01.txt"]),
    ("2003-01-01", "dig010103.txt",
     ["dig010103.txt", "2003/dig010103.txt", "2003/dig010103.htm", "dig010103.htm"]),
    ("2007-06-01", "2007/dig060107.htm",
     ["2007/dig060107.txt", "dig060107.txt", "2007/dig060107.htm", "dig060107.htm"]),
    ("2008-06-02", "2008/dig060208.htm",
     ["2008/dig060208.txt", "dig060208.txt", "2008/dig060208.htm", "dig060208.htm"]),
    ("2009-06-01", "2009/dig060109.htm",
     ["2009/dig060109.htm", "2009/dig060109.txt", "dig060109.txt", "dig060109.htm"]),
]


def test_addresses_by_era(spark):
    days = spark.createDataFrame([(g[0],) for g in GOLDEN], "d STRING").select(
        F.col("d").cast("date").alias("date"))
    day = F.col("date")
    rows = days.select(day.cast("string").alias("d"), urls.digest_url(day, BASE).alias("u"),
                       urls.candidate_urls(day, BASE).alias("c"), urls.local_path(day).alias("p")).collect()
    got = {r.d: r for r in rows}
    for d, primary, candidates in GOLDEN:
        assert got[d].u == f"{BASE}/{primary}"
        assert got[d].c == [f"{BASE}/{c}" for c in candidates]
        assert got[d].p == f"raw/{d[:4]}/digest_{d}.{primary[-3:]}"


def test_calendar_has_every_day(spark):
    years = spark.createDataFrame([(1956,), (1957,), (2000,)], "year INT")
    n = {r.year: r["count"] for r in M.calendar(years).groupBy("year").count().collect()}
    assert n == {1956: 366, 1957: 365, 2000: 366}


def test_year_bounds(spark):
    df = spark.range(3).select((F.col("id") + 1955).cast("int").alias("year"))
    assert [r.year for r in M.in_years(df).collect()] == [1956, 1957]
    for first, last in ((1955, 1960), (2000, 2015), (1980, 1970)):
        with pytest.raises(ValueError):
            M.in_years(df, first, last)


def test_insert_keeps_known_rows_and_the_first_copy(spark):
    target = spark.createDataFrame([("a", "failed", 0)], "url STRING, s STRING, o INT")
    batch = spark.createDataFrame([("b", "late", 2), ("b", "early", 1), ("a", "new", 0)], target.schema)
    rows = sorted(tuple(r) for r in M.insert_missing(target, batch, F.col("o")).collect())
    assert rows == [("a", "failed", 0), ("b", "early", 1)]
    again = M.insert_missing(M.insert_missing(target, batch, F.col("o")), batch, F.col("o"))
    assert sorted(tuple(r) for r in again.collect()) == rows


def test_update_keeps_time_and_message_on_skip(spark):
    t = dt.datetime(2020, 1, 1)
    target = spark.createDataFrame(
        [("a", 1985, None, "p", "completed", 5, t, "m"), ("b", 1985, None, "p", "pending", None, None, None),
         ("c", 1985, None, "p", "completed", 5, t, "m")], MANIFEST)
    results = spark.createDataFrame(
        [("a", "skipped", 6, None, None), ("b", "failed", None, None, "HTTP 503"),
         ("z", "completed", 1, t, None), ("c", "completed", 7, None, None)],
        "url STRING, download_status STRING, file_size_bytes BIGINT, downloaded_at TIMESTAMP_NTZ, error_message STRING")
    got = {r.url: r for r in M.update_manifest(target, results, F.col("downloaded_at")).collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"].download_status, got["a"].file_size_bytes, got["a"].downloaded_at,
            got["a"].error_message) == ("skipped", 6, t, "m")
    assert (got["b"].download_status, got["b"].error_message) == ("failed", "HTTP 503")
    assert (got["c"].downloaded_at, got["c"].error_message) == (None, None)


# attempts of two candidates: a status, None for a 404-free gap, text for an exception
FETCHES = [
    ([[200]], "completed", None, 1),
    ([[404, 200]], "completed", "Fallback URL used: u2", 1),
    ([[404, 404]], "failed", M.NOT_FOUND, 1),
    ([[503], [404, 200]], "completed", "Fallback URL used: u2", 2),
    ([[503], [503], [503]], "failed", "HTTP 503", 3),
    ([["timeout", 404], [404, 404]], "failed", M.NOT_FOUND, 2),
    ([["timeout", 404]] * 3, "failed", "timeout", 3),
    ([["timeout", 404]] * 2 + [["timeout", 500]], "failed", "HTTP 500", 3),
    ([["first", "second"]], "failed", "second", 1),
    ([["timeout", 200]], "completed", "Fallback URL used: u2", 1),
]


def test_fetch_resolution(spark):
    rows = []
    for i, (log, *_) in enumerate(FETCHES):
        for a, requests in enumerate(log):
            for r, x in enumerate(requests, 1):
                status, error = (x, None) if isinstance(x, int) else (None, x)
                rows.append((i, a, r, "u1", f"u{r}", status, error, 9, dt.datetime(2020, 1, 1)))
    log = spark.createDataFrame(
        rows, "url INT, attempt INT, cand_rank INT, primary_url STRING, request_url STRING, "
              "http_status INT, error STRING, bytes BIGINT, fetched_at TIMESTAMP_NTZ")
    got = {r.url: r for r in M.resolve_fetches(log).collect()}
    for i, (_, status, message, attempts) in enumerate(FETCHES):
        assert (got[i].status, got[i].message, got[i].attempts) == (status, message, attempts), FETCHES[i]
        assert got[i].file_size_bytes == (9 if status == "completed" else None)


PATHS = [
    ("raw/1985/digest_1985-01-07.pdf", ".pdf", "pdf", "1985", "m/1985/digest_1985-01-07.md"),
    ("raw/misc/a.b.HTM", ".htm", "html", "unknown", "m/unknown/a.b.md"),
    ("raw/2000/x", "", "unsupported", "2000", "m/2000/x.md"),
    ("raw/2000/.htm", "", "unsupported", "2000", "m/2000/.htm.md"),
    ("raw/2000/x.", "", "unsupported", "2000", "m/2000/x..md"),
    ("x.txt", ".txt", "text", "unknown", "m/unknown/x.md"),
]


def test_paths(spark):
    p = F.col("p")
    df = spark.createDataFrame([(x[0],) for x in PATHS], "p STRING").select(
        p, urls.file_suffix(p), urls.source_kind(p), urls.year_folder(p), urls.text_path(p, "m"))
    assert sorted(tuple(r) for r in df.collect()) == sorted(PATHS)


def test_dates_from_names(spark):
    names = [("a/digest_1985-01-07.md", dt.date(1985, 1, 7)), ("digest_1985-02-30.md", None),
             ("digest_850107.md", None), ("1985-01-07.md", dt.date(1985, 1, 7)), ("x.md", None),
             ("digest_1985-1-7.md", dt.date(1985, 1, 7)), ("digest_985-01-07.md", None), ("digest_1985-13-01.md", None)]
    df = spark.createDataFrame([(n,) for n, _ in names], "n STRING")
    got = {r.n: r.d for r in df.select("n", urls.digest_date_from_name(F.col("n")).alias("d")).collect()}
    assert got == dict(names)


def test_archive_links(spark):
    cases = [("/news/digest/1985/dig010785.PDF", True, None, False),
             ("/news/digest/1985/dig010785.pdf", True, (1985, "01", "07", "85"), False),
             ("/news/digest/1985/", False, None, True), ("/news/digest/1985", False, None, True),
             ("/1985/x", False, None, False)]
    c = F.col("u")
    df = spark.createDataFrame([(x[0],) for x in cases], "u STRING").select(
        c, c.rlike(urls.PDF_LINK), urls.digest_link_parts(c), c.rlike(urls.YEAR_INDEX_LINK))
    got = {r[0]: (r[1], tuple(r[2]) if r[2] else None, r[3]) for r in df.collect()}
    assert got == {x[0]: x[1:] for x in cases}


def test_parse_files_and_upsert(spark):
    raw = spark.createDataFrame(
        [("raw/1985/a.htm", bytearray(b"<p>x&amp;y</p>")), ("raw/1985/b.txt", bytearray(b"q\r\nr")),
         ("raw/1985/c.pdf", bytearray(b"%PDF")), ("raw/1985/d.pdf", bytearray(b"%PDF")),
         ("raw/1985/e.doc", bytearray(b"?"))], "path STRING, content BINARY")
    pdf = spark.createDataFrame([("raw/1985/d.pdf", "text", 3)], "path STRING, text STRING, page_count INT")
    got = {r.path[-5:]: r for r in P.parse_files(raw, pdf_text=pdf).collect()}
    assert got["a.htm"].text == "x&y" and got["b.txt"].text == "q\nr"
    assert [got[k].parsing_status for k in ("a.htm", "c.pdf", "d.pdf", "e.doc")] == [
        "completed", "needs_converter", "completed", "failed"]
    assert got["d.pdf"].page_count == 3 and got["e.doc"].error_message == "Unsupported file type: .doc"

    t = dt.datetime(2020, 1, 1)
    old = spark.createDataFrame([("a", "o", "completed", 4, 10, t, None), ("b", "o", "failed", None, None, None, "x")], PARSING)
    new = spark.createDataFrame([("a", "n", "skipped", None, 11, None, None), ("b", "n", "completed", 1, 2, t, None),
                                 ("c", "n", "failed", None, None, None, "y")], PARSING)
    rows = sorted(tuple(r) for r in P.upsert_results(old, new, F.col("parsed_at")).collect())
    assert rows == [("a", "n", "skipped", 4, 11, t, None), ("b", "n", "completed", 1, 2, t, None),
                    ("c", "n", "failed", None, None, None, "y")]


def test_the_last_result_wins_however_rows_lie(spark):
    t = [dt.datetime(2020, 1, d) for d in (1, 2, 3)]
    rows = [("a", "n", "completed", 1, d, t[d], None) for d in range(3)]
    old = spark.createDataFrame([], PARSING)
    for new in (rows, rows[::-1]):
        got = P.upsert_results(old, spark.createDataFrame(new, PARSING).repartition(3), F.col("parsed_at")).collect()
        assert [r.markdown_length for r in got] == [2]


def test_pages_without_links_are_counted(spark):
    from docketlake.operators.links import link_counts

    pages = spark.createDataFrame([(1, "u", "<p>none</p>"), (2, "u", '<a href="x.PDF">a</a><a href="y">b</a>'), (3, "u", None)],
                                  "page_id BIGINT, url STRING, html STRING")
    assert {tuple(r) for r in link_counts(pages).collect()} == {(1, 0, 0), (2, 2, 1), (3, 0, 0)}
