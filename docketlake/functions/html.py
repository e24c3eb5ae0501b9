"""HTML to text, entity decoding and link resolution as column expressions."""

from __future__ import annotations

import html as _html
import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column, functions as F

from docketlake.functions.text import in_head, let, nonempty_lines, py_strip

# A character reference as HTML5 tokenises it.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\x0c <&#;]{1,32};?)"
_REPLACEMENT = "\ufffd"


@lru_cache(maxsize=1)
def _named_references() -> tuple[str, str]:
    """The HTML5 name table as a JSON map, and a regex of the names that need no ``;``."""
    bare = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    # A map lookup scans in order, so the names in daily use come first.
    first = [n for b in bare for n in (b + ";", b)]
    ordered = {n: html5[n] for n in first} | html5
    return json.dumps(ordered), "|".join(bare)


@lru_cache(maxsize=1)
def _numeric_exceptions() -> str:
    """Code points below 256 whose reference does not stand for themselves, as a JSON map."""
    odd = {}
    for n in range(256):
        text = _html.unescape(f"&#{n};")
        if text != chr(n):
            odd[str(n)] = text
    return json.dumps(odd)


def _code_point(n: Column) -> Column:
    """A code point number to its character; null stands for "too large"."""
    odd = F.element_at(F.from_json(F.lit(_numeric_exceptions()), "map<string,string>"),
                       n.cast("string"))
    no_character = n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (
        F.when(n.isNull() | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit(_REPLACEMENT))
        .when(no_character, F.lit(""))
        .when(n < 256, F.coalesce(odd, char))
        .otherwise(char)
    )


def _decode_reference(ref: Column) -> Column:
    names_json, bare = _named_references()
    names = F.from_json(F.lit(names_json), "map<string,string>")
    body = F.substring(ref, 2, 1 << 30)

    def number(pattern: str, digits: int, base: int) -> Column:
        value = F.regexp_extract(ref, pattern, 1)
        short = F.when(F.length(value) <= digits, F.conv(
            F.when(value == "", F.lit("0")).otherwise(value), base, 10).cast("bigint"))
        return _code_point(short)

    prefix = F.regexp_extract(body, rf"^(?:{bare})", 0)
    named = F.coalesce(
        F.element_at(names, body),
        F.when(prefix != "", F.concat(F.element_at(names, prefix),
                                      F.substring(body, F.length(prefix) + 1, F.lit(1 << 30)))),
        ref,
    )
    return (
        F.when(ref.rlike("^&#[xX]"), number(r"^&#[xX]0*([0-9a-fA-F]*)", 6, 16))
        .when(F.startswith(ref, F.lit("&#")), number(r"^&#0*([0-9]*)", 7, 10))
        .otherwise(named)
    )


def decode_entities(c: Column) -> Column:
    """Decode character references once, as ``html.unescape`` does."""
    gaps = F.split(c, _REFERENCE, -1)
    refs = F.transform(F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0)), _decode_reference)
    pieces = F.flatten(
        F.transform(F.arrays_zip(gaps.alias("gap"), refs.alias("ref")),
                    lambda x: F.array(x["gap"], x["ref"]))
    )
    return F.when(F.contains(c, F.lit("&")), F.array_join(pieces, "")).otherwise(c)


_TAG = r"<[^>]+>"
_SCRIPT = r"(?is)<script.*?</script>"
_STYLE = r"(?is)<style.*?</style>"


def html_to_text(c: Column, keep_script_text: bool = False) -> Column:
    """Plain text of a simple HTML page.

    Script and style blocks go first (their tags only, with ``keep_script_text``),
    block tags become line breaks, other tags vanish, entities are decoded once,
    and the lines are stripped and the empty ones dropped.
    """
    if not keep_script_text:
        c = in_head(c, "</script>", lambda x: F.regexp_replace(x, _SCRIPT, ""))
        c = in_head(c, "</style>", lambda x: F.regexp_replace(x, _STYLE, ""))

    c = in_head(c, ">", lambda x: F.regexp_replace(x, r"(?iu)</?(?:p|div|br|li|tr|h[1-6])[^>]*>", "\n"))
    c = in_head(c, ">", lambda x: F.regexp_replace(x, _TAG, ""))
    return nonempty_lines(decode_entities(c))


# --- anchors -----------------------------------------------------------------

# What is opened and never closed reaches to the end of the page, so every pattern here is
# tried to the end once at most.
_HIDDEN = r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)"
_ATTRIBUTES = r"""((?:[^"'>]++|"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))*+)"""
# The text of an anchor ends at its end tag or where the next anchor starts.
_ANCHOR = rf"(?is)<a(?=[\s>/]){_ATTRIBUTES}(>|\z)((?:[^<]++|<(?!a[\s>/]|/a\b))*+)"
_HREF = r"""(?is)(?:^|[\s"'/])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def anchors(html: Column) -> Column:
    """All anchors of a page as ``array<struct<href, text>>`` in page order.

    Works on the tag level with regular expressions, not on a DOM. A script, style or
    comment that is never closed hides the rest of the page; a tag cut off is none.
    """
    visible = F.regexp_replace(html, _HIDDEN, "")

    def parse(x: Column) -> Column:
        href = F.concat(*[F.regexp_extract(x["attrs"], _HREF, g) for g in (1, 2, 3)])
        # Between the tags; what follows the last ">" belongs to the last piece.
        head = F.regexp_extract(x["inner"], r"(?s)\A.*>", 0)
        rest = F.substring(x["inner"], F.length(head) + 1, F.lit(1 << 30))
        pieces = let(F.split(head, _TAG, -1), lambda p: F.concat(
            F.slice(p, F.lit(1), F.size(p) - 1), F.array(F.concat(F.get(p, F.size(p) - 1), rest))))
        strings = F.transform(pieces, lambda s: py_strip(decode_entities(s)))
        return F.struct(decode_entities(href).alias("href"),
                        F.array_join(strings, "").alias("text"))

    def parse_all(text: Column) -> Column:
        found = F.arrays_zip(
            F.regexp_extract_all(text, F.lit(_ANCHOR), F.lit(1)).alias("attrs"),
            F.regexp_extract_all(text, F.lit(_ANCHOR), F.lit(2)).alias("close"),
            F.regexp_extract_all(text, F.lit(_ANCHOR), F.lit(3)).alias("inner"),
        )
        return F.transform(F.filter(found, lambda x: x["close"] != ""), parse)

    return let(visible, parse_all)


def _normalise_path(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    def step(done: Column, segment: Column) -> Column:
        return (
            F.when(segment == ".", done)
            .when(segment == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
            .otherwise(F.concat(done, F.array(segment)))
        )

    segments = F.split(path, "/", -1)
    kept = F.aggregate(F.slice(segments, 2, F.size(segments)), F.array(F.lit("")), step)
    # A path that ends in a dot segment names a directory.
    ends_in_dots = path.rlike(r"/\.\.?$")
    joined = F.array_join(F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept),
                          "/")
    return F.when(joined == "", F.lit("/")).otherwise(joined)


def resolve_link(base: Column, href: Column) -> Column:
    """Resolve a link against an absolute base address; an empty link stays empty."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    host = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    origin = F.concat(scheme, F.lit("://"), host)

    link_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    link_tail = F.substring(href, F.length(link_path) + 1, F.lit(1 << 30))
    folder = F.concat(F.lit("/"), F.regexp_extract(path, r"^/(.*/)", 1))
    return (
        F.when(href == "", F.lit(""))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")),
              F.concat(origin, _normalise_path(link_path), link_tail))
        .when(F.startswith(href, F.lit("?")), F.concat(origin, path, href))
        .when(F.startswith(href, F.lit("#")), F.concat(origin, path, query, href))
        .otherwise(F.concat(origin, _normalise_path(F.concat(folder, link_path)), link_tail))
    )
