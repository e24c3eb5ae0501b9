"""Secret scan: fixed patterns, and strings that a primed compressor finds novel.

Patterns find assignments, access keys and long hexadecimal runs. Beyond them, every long
string that follows a sensitive word, or a secret found so, is measured: a zstandard compressor is primed with a
dictionary of identifiers and the text around the candidate, and the bytes that the
candidate adds are its novelty. Other copies of the candidate are left out of that text, so a
key that stands several times is reported at each of its places. Names made of known words add
few bytes; a random key adds about one per character, and from :data:`CODED` characters on,
where the compressor codes single characters, as many bits as its alphabet has. Candidates
above :data:`NOVEL` per character, or above :data:`SHARE` of those bits, are reported.

Each row is scanned on its own, without a shuffle. Null and empty texts give no spans.
Positions are code points, the end exclusive.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column

from docketlake.llm.common import text_udf

# Fixed: the base patterns. Runs of these lengths equal longer-or-dropped greedy runs.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "novel")

# Fixed: words that make what follows sensitive.
SENSITIVE = re.compile(r"passw|passphrase|pwd|secret|token|credential|private[ _-]?key|access[ _-]?key"
                       r"|api[ _-]?key|client[ _-]?key|bearer|authorization|auth[ _-]", re.IGNORECASE | re.ASCII)
HINTS = ("passw", "passphrase", "pwd", "secret", "token", "credential", "key", "bearer", "auth")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_-])")
#: The end of an armoured key that is too short for a candidate.
LAST_LINE = re.compile(r"\s{1,16}[A-Za-z0-9+/]{1,15}={0,2}(?=\s{0,16}-----END)")
#: Characters after a sensitive word, or after a secret found, in which a candidate may start.
REACH = 64
#: Characters of surrounding text on either side that prime the compressor.
AROUND = 1500
#: Marginal compressed bytes per character from which a candidate is reported.
NOVEL = 0.75
#: Length from which the compressor codes single characters, and the share of the bits of the
#: candidate's own alphabet from which one of that length is reported.
CODED, SHARE = 64, 0.92
#: Different characters that a candidate must have. Shorter ones than CODED need a digit and a
#: letter too, as names and numbers of that length can't be told from keys.
VARIETY = 10
# Fixed: the alphabets that keys are written in.
ALPHABETS = tuple(map(frozenset, (
    "0123456789", "0123456789ABCDEF", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")))

# Fixed: identifiers that occur in code and configuration without being secret.
IDENTIFIERS = b"""abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 authorization bearer
access_token refresh_token token_type expires_in client_id client_secret redirect_uri grant_type
authorization_code username password password_hash private_key public_key secret_key access_key api_key
session_id user_id request_id content_type application_json x_www_form_urlencoded multipart_form_data
environment production development staging configuration connection_string database_url hostname
localhost example placeholder changeme your_api_key_here insert_token_here undefined null true false
function return import export default class public static void string integer boolean object array
getElementById addEventListener createConnection authenticate initialize application component service
manager controller repository factory provider handler middleware interface implementation
aaaaaaaaaaaaaaaa xxxxxxxxxxxxxxxx 0000000000000000 1234567890 abcdef012345 deadbeef"""

SPANS = "array<struct<kind:string,start:int,end:int,value_start:int,novelty:double>>"


def _novelty(text: str, start: int, end: int) -> float:
    """Bytes per character that the candidate adds to its surroundings without its other copies."""
    own, far = text[start:end], AROUND + end - start   # copies that reach over the edge count too
    before = text[max(0, start - far): start].replace(own, " ")[-AROUND:]
    near = before + " " + text[end: end + far].replace(own, " ")[:AROUND]
    primer = zstandard.ZstdCompressionDict(IDENTIFIERS + near.encode("utf-8", "replace"),
                                           dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    press = zstandard.ZstdCompressor(level=3, dict_data=primer, write_content_size=False)
    added = len(press.compress(own.encode("utf-8", "replace"))) - len(press.compress(b""))
    return added / (end - start)


def _is_varied(value: str) -> bool:
    return len(set(value)) >= VARIETY and (
        len(value) >= CODED or any(c.isdigit() for c in value) and any(c.isalpha() for c in value))


def _least(value: str) -> float:
    """Novelty from which the candidate is reported."""
    if len(value) < CODED:
        return NOVEL
    symbols = set(value) - set("=")
    size = next((len(a) for a in ALPHABETS if symbols <= a), 64)
    return min(NOVEL, SHARE * math.log2(size) / 8)


def find_secrets(text: str) -> list[dict]:
    """Spans by start, then kind as in :data:`KINDS`."""
    found, lower = [], text.lower()

    def add(kind: str, start: int, end: int, value: int, novelty: float | None = None) -> None:
        found.append({"kind": kind, "start": start, "end": end, "value_start": value, "novelty": novelty})

    if any(n in lower for n in NAMES):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_VALUE:
                add("assign", m.start(), m.end(), m.start(2))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            add("access", m.start(), m.end(), m.start())
    for m in HEX.finditer(text):
        add("hex", m.start(), m.end(), m.start())
    if any(h in lower for h in HINTS):
        taken: list[list[int]] = []   # what is found so far, as intervals apart from each other
        for s in sorted(found, key=lambda s: s["start"]):
            if taken and s["start"] <= taken[-1][1]:
                taken[-1][1] = max(taken[-1][1], s["end"])
            else:
                taken.append([s["start"], s["end"]])
        words = SENSITIVE.finditer(text)
        word, at, reach = next(words, None), 0, -1
        for m in CANDIDATE.finditer(text, word.end()) if word else ():
            while word and word.end() <= m.start():
                reach, word = max(reach, word.end() + REACH), next(words, None)
            if m.start() > reach:
                if not word:
                    break
                continue
            while at < len(taken) and taken[at][1] <= m.start():
                at += 1
            if at < len(taken) and taken[at][0] < m.end():
                reach = max(reach, m.end() + REACH)
            elif _is_varied(m[0]) and (n := _novelty(text, m.start(), m.end())) >= _least(m[0]):
                tail = LAST_LINE.match(text, m.end())
                end = tail.end() if tail else m.end()
                add("novel", m.start(), end, m.start(), n)
                reach = max(reach, end + REACH)
    return sorted(found, key=lambda s: (s["start"], KINDS.index(s["kind"])))


def redact(text: str, mark: str = "[REDACTED]") -> str:
    """The text with the value of every secret replaced."""
    out, at = [], 0
    for s in sorted(find_secrets(text), key=lambda s: (s["value_start"], s["end"])):
        if s["value_start"] >= at:
            out += [text[at: s["value_start"]], mark]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def secret_spans(text: str | Column) -> Column:
    """``array<struct<kind, start, end, value_start, novelty>>`` of each whole text."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("value_start", pa.int32()), ("novelty", pa.float64())]))
    return text_udf(lambda: lambda texts: pa.array([find_secrets(t) for t in texts], kind), SPANS)(text)


def redacted(text: str | Column, mark: str = "[REDACTED]") -> Column:
    """Each text without the values of its secrets."""
    return text_udf(lambda: lambda texts: pa.array([redact(t, mark) for t in texts], pa.string()), "string")(text)
