import json
import random
import re

from pyspark.sql import functions as F

from docketlake.functions import answers as A
from tests.test_text import apply, random_texts

ACTION = '{"action_type":"civil","full_text":"x"}'


def with_action(**extra):
    a = {"action_type": "civil", "full_text": "x", **extra}
    return json.dumps({"actions": [{k: v for k, v in a.items() if v != "DROP"}]})


# response, outcome, number of actions, settlement
GOLDEN = [
    ('{"actions":[%s]}' % ACTION, "ok", 1),
    ('```json\n{"actions":[%s]}\n```' % ACTION, "ok", 1),
    ('<think>{"a":1}</think>{"actions":[%s]} done' % ACTION, "ok", 1),
    ('{"actions":[],"extraction_notes":"a } b"}', "ok", 0),
    ('<think>never closed {"actions":[%s]}' % ACTION, "failed", 0),
    ('{"actions":[%s' % ACTION, "failed", 0),
    ("{}", "ok", 0),
    ('{"actions":null}', "error", 0),
    ("[1]", "error", 0),
    ("[1] x", "failed", 0),
    ("[1] [2]", "failed", 0),
    ("null", "error", 0),
    ("", "failed", 0),
    ('{"actions":[7]}', "error", 0),
    ('{"actions":""}', "ok", 0),
    ('{"actions":{}}', "ok", 0),
    ('{"actions":"ab"}', "error", 0),
    ('{"actions":5}', "error", 0),
    ('{"actions":{"a":1}}', "error", 0),
    ('{"actions":[%s],"extraction_notes":5}' % ACTION, "failed", 0),
    ('{"actions":[%s,7]}' % ACTION, "error", 0),
    ('{"actions":[{"action_type":5},7]}', "failed", 0),
    (with_action(full_text="DROP"), "failed", 0),
    (with_action(action_type=5), "failed", 0),
    (with_action(action_type=None), "failed", 0),
    (with_action(title=5), "failed", 0),
    (with_action(respondents=None), "failed", 0),
    (with_action(respondents="x"), "failed", 0),
    (with_action(respondents=[{"name": None}]), "failed", 0),
    (with_action(respondents=[{"entity_type": "x"}]), "failed", 0),
    (with_action(respondents=["x"]), "failed", 0),
    (with_action(violations=[{}], sanctions=[{"amount": None}]), "ok", 1),
    (with_action(sanctions=[{"amount": 50}]), "failed", 0),
    (with_action(settlement=2), "failed", 0),
    (with_action(settlement=0.5), "failed", 0),
    (with_action(settlement=""), "failed", 0),
    (with_action(settlement="N/A"), "failed", 0),
    (with_action(settlement=" true "), "failed", 0),
    (with_action(settlement=[]), "failed", 0),
    (with_action(other=1), "ok", 1),
    ('{"actions":[%s,{"full_text":"y"}]}' % ACTION, "failed", 0),
    ('{"actions":[],"x":NaN,"y":-Infinity,"extraction_notes":"NaN"}', "ok", 0),
    ('{"actions":[],"x":-NaN}', "failed", 0),
    ('{"actions":5,"actions":[%s]}' % ACTION, "ok", 1),
]

BOOLEANS = [("yes", True), (1, True), (1.0, True), ("Off", False), ("t", True), (0, False),
            (True, True), (False, False), ("FALSE", False), (None, None), (0.0, False)]


def judge(spark, responses):
    parsed = A.parse_answer(A.clean_answer(F.col("v")))
    df = spark.createDataFrame([(i, r) for i, r in enumerate(responses)], "i INT, v STRING")
    df = df.withColumn("p", parsed).select("i", A.validate_answer(F.col("p")).alias("o"),
                                           A.answer_actions(F.col("p")).alias("a"))
    return sorted(df.collect(), key=lambda r: r.i)


def test_golden_answers(spark):
    for (text, outcome, n), row in zip(GOLDEN, judge(spark, [g[0] for g in GOLDEN])):
        assert row.o.outcome == outcome, (text, row.o)
        if outcome == "ok":
            assert len(row.a) == n, text


def test_error_paths(spark):
    rows = judge(spark, [
        with_action(respondents=[{"name": "a"}, {"name": None}]),
        '{"actions":[%s,{"full_text":"y"}]}' % ACTION,
        '{"actions":[%s,7]}' % ACTION,
        "nope",
    ])
    assert [(r.o.error_class, r.o.error_path) for r in rows] == [
        ("ValidationError", "actions[0].respondents[1].name"),
        ("ValidationError", "actions[1].action_type"),
        ("TypeError", "actions[1]"),
        ("JSONDecodeError", None),
    ]


def test_lax_booleans(spark):
    rows = judge(spark, [with_action(settlement=v) for v, _ in BOOLEANS])
    assert [r.o.outcome for r in rows] == ["ok"] * len(BOOLEANS)
    assert [r.a[0].settlement for r in rows] == [w for _, w in BOOLEANS]


def test_built_actions(spark):
    full = {
        "action_type": "civil", "title": "T", "full_text": "f", "court": None, "case_number": "1",
        "release_number": "34-1", "settlement": True,
        "respondents": [{"name": "n", "entity_type": "company", "location": None}],
        "violations": [{"statute": "s"}], "sanctions": [{"description": "d", "amount": "$5"}],
    }
    a = judge(spark, [json.dumps({"actions": [full]})])[0].a[0]
    assert (a.title, a.court, a.respondents[0].name, a.violations[0].statute,
            a.violations[0].description, a.sanctions[0].amount) == ("T", None, "n", "s", None, "$5")


def py_first_object(s):
    """Brute force: scan the text character by character."""
    if not s.startswith("{"):
        return s
    depth, quoted, i = 0, False, 0
    while i < len(s):
        ch = s[i]
        if quoted and ch == "\\":
            i += 2
            continue
        if ch == '"':
            quoted = not quoted
        elif not quoted and ch in "{}":
            depth += 1 if ch == "{" else -1
            if depth == 0:
                return s[:i + 1]
        i += 1
    return s


def py_clean(s):
    s = re.sub(r"(?s)<think>.*?</think>", "", s.strip()).strip()
    if s.startswith("```"):
        rest = s.split("\n")[1:]
        if rest and rest[-1].strip() == "```":
            rest.pop()
        s = "\n".join(rest)
    return py_first_object(s.strip())


def test_cleaning_matches_brute_force(spark):
    bits = ["{", "}", '"', "\\", "a", "\n", "```", "<think>", "</think>", " ", "é😀", "```json\n{"]
    texts = random_texts(bits, 500, 16, 5)
    rng = random.Random(6)
    texts += ["{" + "".join(rng.choice(['"', "\\", "{", "}", "a", "\n"]) for _ in range(30))
              for _ in range(300)]
    texts += ['{"a":"' + "x\\n" * 20000 + '"} tail']
    for t, g in zip(texts, apply(spark, texts, A.clean_answer)):
        assert g == py_clean(t), repr(t)
