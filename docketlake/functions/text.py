"""Text expressions with the whitespace and regex rules of Python's ``str``/``re``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values. Python's str.isspace: Unicode White_Space and the ASCII separators;
# str.splitlines breaks lines at some of them.
BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
SPACES = BREAKS + "\t\x1f \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
SPACE = f"[{SPACES}]"

# Headings that mark an enforcement section, tolerant of OCR errors.
# Three strict headings whose words may be split over lines, then three loose
# forms that must stay on one line.
SECTION_PATTERNS = [
    r"ADM[I1L|!]N[I1L|!][S5Z]TRAT[I1L|!][VY]E" + SPACE + r"+PR[O0Q][C(]EED[I1L|!]NG[S5Z]?",
    r"C[I1L|!][VY][I1L|!]L" + SPACE + r"+PR[O0Q][C(]EED[I1L|!]NG[S5Z]?",
    r"CR[I1L|!]M[I1L|!]NAL" + SPACE + r"+PR[O0Q][C(]EED[I1L|!]NG[S5Z]?",
    r"ADM[I1L|!]N.*?PROCEED",
    r"C[I1L|!]V[I1L|!]L.*?PROCEED",
    r"CR[I1L|!]M.*?PROCEED",
]
# i: ignore case, u: also outside ASCII, d: only \n ends a line.
_FLAGS = "(?iud)"
_COMMON_PART = r"PR[O0Q][C(]EED"
CONTEXT_CHARS = 50
# The shortest possible section match ("CRIM" + "PROCEED").
_SHORTEST_MATCH = 11


def in_head(c: Column, closer: str, change) -> Column:
    """Apply ``change`` up to the last match of ``closer``, the rest stays.

    There every opener has a closer after it. A lazy pattern from opener to closer is so
    linear in the text, where it would otherwise try every unclosed opener to the end.
    """
    def run(text: Column) -> Column:
        head = F.regexp_extract(text, rf"(?is)\A.*(?:{closer})", 0)
        return F.concat(change(head), F.substring(text, F.length(head) + 1, F.lit(1 << 30)))

    return let(c, run)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def py_strip(c: Column) -> Column:
    """Strip Unicode whitespace on both sides; looks at the ends only."""
    return F.trim(c, F.lit(SPACES))


def decode_bytes(content: Column) -> Column:
    """UTF-8 bytes to text: bad bytes become U+FFFD, newlines become ``\\n``."""
    return universal_newlines(F.make_valid_utf8(content.cast("string")))


def universal_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\r\n?", "\n")


def line_count(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1


def nonempty_lines(c: Column) -> Column:
    """Split into lines, strip each, drop the empty ones, join with ``\\n``."""
    lines = F.transform(F.split(c, f"[{BREAKS}]", -1), py_strip)
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def has_section(c: Column) -> Column:
    """True when any of the six section patterns occurs.

    All six contain the word of ``_COMMON_PART``: a text without it is rejected in
    one cheap pass.
    """
    return c.rlike(_FLAGS + _COMMON_PART) & c.rlike(_FLAGS + "|".join(SECTION_PATTERNS))


def section_contexts(c: Column) -> Column:
    """Every match of every pattern with up to 50 characters on each side, stripped.

    Patterns in their listed order, matches in text order. For each pattern the
    text is cut into gap, match, gap, ...; the context of a match is the tail of
    the few pieces before it and the head of the few pieces after it, so the work
    is linear in the text and no running offset is kept.
    """
    none = F.array().cast("array<string>")
    found = [F.when(c.rlike(_FLAGS + p), _contexts_of(c, _FLAGS + p)).otherwise(none)
             for p in SECTION_PATTERNS]
    return F.when(has_section(c), F.flatten(F.array(*found))).when(c.isNotNull(), none)


def _contexts_of(c: Column, pattern: str) -> Column:
    # Enough matches to cover the context even when every gap is empty.
    reach = 2 * (CONTEXT_CHARS // _SHORTEST_MATCH + 1) + 1
    gaps = F.split(c, pattern, -1)
    matches = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    pieces = F.flatten(
        F.transform(F.arrays_zip(gaps.alias("gap"), matches.alias("match")),
                    lambda x: F.array(x["gap"], x["match"]))
    )

    def contexts(parts: Column) -> Column:
        def around(piece: Column, i: Column) -> Column:
            # i is 0-based, so it is also the 1-based place of the piece before.
            start = F.greatest(F.lit(1), i - (reach - 1))
            before = F.slice(parts, start, i - start + 1)
            after = F.slice(parts, i + 2, F.lit(reach))
            is_match = (i % 2 == 1) & piece.isNotNull()
            return F.when(is_match, py_strip(F.concat(
                F.right(F.array_join(before, ""), F.lit(CONTEXT_CHARS)),
                piece,
                F.left(F.array_join(after, ""), F.lit(CONTEXT_CHARS)),
            )))

        return F.filter(F.transform(parts, around), lambda x: x.isNotNull())

    return let(pieces, contexts)


def drop_table_lines(c: Column) -> Column:
    """Remove every line that holds a ``|``; only ``\\n`` separates lines."""
    return F.array_join(
        F.filter(F.split(c, "\n", -1), lambda line: ~F.contains(line, F.lit("|"))), "\n"
    )


def preview(c: Column, n: int) -> Column:
    return F.left(c, F.lit(n))
