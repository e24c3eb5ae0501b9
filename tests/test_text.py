"""Text and HTML expressions against plain Python on small fixtures."""

import html
import random
import re
import time
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from docketlake.functions import answers as A, html as H, text as X

SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0   \u3000\u200b"


def apply(spark, values, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    rows = df.select("i", *[e(F.col("v")).alias(f"c{n}") for n, e in enumerate(exprs)]).collect()
    rows = sorted(rows, key=lambda r: r["i"])
    return [tuple(r)[1:] if len(exprs) > 1 else r[1] for r in rows]


def random_texts(alphabet, n, length, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(length))) for _ in range(n)]


def test_strip_and_lines_follow_python(spark):
    texts = random_texts(list(SPACES) + ["a", "b", "\r\n"], 400, 14, 1)
    got = apply(spark, texts, X.py_strip, X.nonempty_lines)
    for t, (stripped, lines) in zip(texts, got):
        assert stripped == t.strip(), repr(t)
        want = "\n".join(x for x in (y.strip() for y in t.splitlines()) if x)
        assert lines == want, repr(t)


def test_decode_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb\xe2\x82\r\nc\rd"),)], "b BINARY")
    assert df.select(X.decode_bytes(F.col("b"))).first()[0] == "a�b�\nc\nd"


def test_length_counts_code_points(spark):
    assert apply(spark, ["é😀"], F.length) == [2]


GOLDEN_FILTER = [
    ("ADMINISTRATIVE PROCEEDINGS", True),
    ("ADMINISTRATIVE\nPROCEEDINGS", True),
    ("ADM|N|STRATIVE PR0(EED!NGZ", True),
    ("civil penalties and proceeds", True),
    ("civil x\nproceeds", False),
    ("civil x\rproceeds", True),
    ("ADMINISTRATIVE\x1cPROCEEDINGS", True),
    ("ADMINISTRATIVE\xa0PROCEEDINGS", True),
    ("admınıſtratıve proceedıngſ", True),
    ("HOLDINGS", False),
    ("", False),
]


def py_pattern(p):
    return re.compile(p.replace(X.SPACE, r"\s"), re.IGNORECASE)


def py_sections(t):
    out = []
    for p in X.SECTION_PATTERNS:
        for m in py_pattern(p).finditer(t):
            out.append(t[max(0, m.start() - 50):m.end() + 50].strip())
    return out


def test_prefilter_goldens(spark):
    assert apply(spark, [t for t, _ in GOLDEN_FILTER], X.has_section) == [w for _, w in GOLDEN_FILTER]


def test_newline_normalisation_changes_the_filter(spark):
    expr = lambda c: X.has_section(X.universal_newlines(c))
    assert apply(spark, ["civil x\rproceeds"], expr) == [False]


def test_sections_follow_finditer(spark):
    words = ["adm\u0130n", "CR\u0130M", "C\u0131V\u0131L", "proceeding\u017f", "PROCEED\u0130NG\u017f", "ADMINISTRATIVE", "PROCEEDINGS", "proceed", "CIVIL", "cr1m", "CRIMINAL", " ", "\n",
             "x" * 30, "é😀", "|", "PR0CEED!NGZ", "adm1n", "\t"]
    texts = random_texts(words, 300, 25, 2) + ["CRIMPROCEED" * 40, None]
    got = apply(spark, texts, X.section_contexts)
    for t, g in zip(texts, got):
        assert g == (None if t is None else py_sections(t)), repr(t)


def test_drop_table_lines(spark):
    texts = random_texts(["a", "|", "\n", "\r", "bc"], 200, 15, 3)
    want = ["\n".join(x for x in t.split("\n") if "|" not in x) for t in texts]
    assert apply(spark, texts, X.drop_table_lines) == want


def test_entities_follow_python(spark):
    bits = ["&", "amp", ";", "lt", "not", "notit", "#", "x", "38", "0", "128", "1F600", "D800",
            "AMP", "CounterClockwiseContourIntegral", "nbsp", " ", "é", "xfffe", "#13", "#1",
            "99999999999", "#x10FFFF", "#xFFFFFFFFF", "&#", "copy", "QUOT;", "NotEqualTilde;"]
    texts = random_texts(bits, 500, 9, 4)
    texts += [f"&#{n};&#x{n:x}" for n in list(range(0, 300)) + [0xFDD0, 0xFDEF, 0x1FFFE, 0x110000]]
    texts += ["&amp;lt;", "&notin;&notit;&notin", "&;", "&#;", "&#x;", "plain"]
    for t, g in zip(texts, apply(spark, texts, H.decode_entities)):
        assert g == html.unescape(t), repr(t)


def test_html_goldens(spark):
    cases = [
        ("<p>a&amp;b</p><script>v=1</script>c", "a&b\nc"),
        ("x &lt;p&gt; y", "x <p> y"),
        ("<div>&nbsp;</div><b>k</b>", "k"),
        ("a<br>b<pre>c</pre>", "a\nb\nc"),
        ("a < b and c > d", "a  d"),
        ("<STYLE>\nx{}\n</style >y", "y"),
        ("<LI>ſ</LI>x", "ſ\nx"),
    ]
    got = apply(spark, [c for c, _ in cases], H.html_to_text)
    # "</style >" does not close a block, so its text stays.
    assert got[:5] + got[6:] == [w for _, w in cases][:5] + [cases[6][1]]
    keep = lambda c: H.html_to_text(c, keep_script_text=True)
    assert apply(spark, [cases[0][0]], keep) == ["a&b\nv=1c"]


def test_anchors(spark):
    page = (
        '<p><a href="/a?x=1&amp;y=2">one <b>two</b> &gt;</a><A class=x HREF=/b>q</A>'
        "<a name='n' data-href='no'>none</a><a href='/c'>open <a href=\"/d\">next</a>"
        '<script>"<a href=x>y</a>"</script><!-- <a href="z">w</a> --><abbr>no</abbr>'
        '<a\nhref = "/e>f"> t </a>'
    )
    got = apply(spark, [page], H.anchors)[0]
    assert [(r.href, r.text) for r in got] == [
        ("/a?x=1&y=2", "onetwo>"), ("/b", "q"), ("", "none"), ("/c", "open"), ("/d", "next"),
        ("/e>f", "t"),
    ]


def py_html(t):
    for name in ("script", "style"):
        t = re.sub(rf"(?is)<{name}.*?</{name}>", "", t)
    t = re.sub(r"(?i)</?(?:p|div|br|li|tr|h[1-6])[^>]*>", "\n", t)
    t = html.unescape(re.sub(r"<[^>]+>", "", t))
    return "\n".join(x.strip() for x in t.splitlines() if x.strip())


def test_html_with_tags_left_open(spark):
    bits = ["<script", "</script>", "</SCRIPT>", "<style", "</style>", "<p", "<P class=x>", "<", ">", "</", "a", " ", "\n", "<b>", "<br/>", "<!--", "&lt;"]
    texts = random_texts(bits, 400, 14, 8)
    for t, g in zip(texts, apply(spark, texts, H.html_to_text)):
        assert g == py_html(t), repr(t)


def test_anchors_with_tags_left_open(spark):
    cases = [
        ('<a href=x>1</a><script>var a; <a href=y>2</a>', [("x", "1")]),
        ('<!-- open <a href=x>1</a>', []),
        ('<style></style><a href=x>1</a><a href="y>2</a>', [("x", "1")]),
        ("<a href=x>1 < 2 <b>3</b> <i", [("x", "13<i")]),
        ("<a href=x>one</a><a href=y", [("x", "one")]),
    ]
    got = apply(spark, [c for c, _ in cases], H.anchors)
    assert [[(r.href, r.text) for r in g] for g in got] == [w for _, w in cases]


@pytest.mark.parametrize("opener", ["<script", "<STYLE ", "<!--", "<a ", '<a href="', "<a '", "<", "<p", "<script></style>",
                                    "<!--</script>", "<a>", "<style><script>--", "<think>", "{", "<<p"])
def test_text_of_openers_takes_linear_time(spark, opener):
    """One megabyte each: what tries every opener to the end takes minutes."""
    texts = [opener * (2 ** 20 // len(opener)), opener * (2 ** 20 // len(opener)) + ">"]
    start = time.time()
    for expr in (H.html_to_text, lambda c: F.size(H.anchors(c)), A.clean_answer):
        assert len(apply(spark, texts, expr)) == 2
    assert time.time() - start < 25


def test_links_resolve_like_urljoin(spark):
    bases = ["http://h/a/b", "https://h.example:80/x/y/z.htm?q=1#f", "http://h", "http://h/a/"]
    hrefs = ["index.htm", "/r/s", "//o/p", "http://k/l", "mailto:a@b", "?q=2", "#top", "../up.htm",
             "./x", "../../../a", "a/./b/../c", "sub/", "..", ".", "x?y=/../z", "/p/../q", ""]
    pairs = [(b, h) for b in bases for h in hrefs]
    df = spark.createDataFrame([(i, b, h) for i, (b, h) in enumerate(pairs)], "i INT, b STRING, h STRING")
    rows = df.select("i", H.resolve_link(F.col("b"), F.col("h")).alias("u")).collect()
    got = {r.i: r.u for r in rows}
    for i, (b, h) in enumerate(pairs):
        assert got[i] == (urljoin(b, h) if h else ""), (b, h)
