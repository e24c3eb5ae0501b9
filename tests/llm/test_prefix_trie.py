"""The conversation trie against a brute-force version, and tree contraction on its own."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from docketlake.llm.common import Staging
from docketlake.llm.contraction import subtree_totals
from docketlake.llm.prefix_trie import ordered_turns, prefix_trie, with_family_start
from docketlake.llm.trie_queries import FAMILY, MOST

SCHEMA = "conv_id bigint, turn bigint, role string, text string, block int, depth string, id string, n bigint"


def table(spark, rows):
    """Conversations with columns whose names clash with those inside the operator."""
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)


def got(spark, rows):
    with Staging(spark, "trie") as staging:
        turns = ordered_turns(table(spark, rows), staging)
        return in_order(map(tuple, prefix_trie(*with_family_start(turns, FAMILY, MOST, staging), staging).collect()))


def in_order(rows):
    return sorted(rows, key=lambda r: r[:2])


def expected(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((-1 if turn is None else turn, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = (*own.get(c - c % 20, [])[:h], *turns[h:])
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in children[node])
        ends = ",".join(str(c) for c in sorted(members[node]) if len(whole[c]) == len(node))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                    len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return in_order(out)


def test_random_conversations(spark):
    rnd = random.Random(2)
    says = ["", "a", "a b", "hi\tyou\x0bthere", "é ü\xa0x", None]
    for most in (3, 8):
        rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(says[: rnd.randrange(1, 6)]))
                for c in rnd.sample(range(200), 60) for t in range(rnd.randrange(1, most))]
        rnd.shuffle(rows)
        assert got(spark, rows) == expected(rows)


def test_odd_conversations(spark):
    rows = [(None, 0, "u", "x"), (3, None, "u", "last words"), (3, None, "u", "last words"), (3, 0, "u", "x"), (3, 5, None, None),
            (20, 1, "u", "a b"), (21, 0, "u", "a b"), (22, 7, "u", "a b"), (39, 0, "u", "z"), (39, 1, "u", "y"),
            (10**12, 0, "u", "a b"), (10**12 + 7, 0, "u", ""), (10**12 + 9, 1, "", "ab"), (10**12 + 11, 1, "a", "b")]
    assert got(spark, rows) == expected(rows)
    assert got(spark, []) == [] and got(spark, rows[:1]) == []


def test_one_long_conversation_and_one_common_one(spark):
    rnd = random.Random(4)
    long = [(20, t, "u", f"w{rnd.randrange(3)} x") for t in range(600)]
    rows = long + [(c, t, "u", f"{t} y") for c in range(40, 6000, 20) for t in range(2)]
    assert got(spark, rows) == expected(rows)


@pytest.mark.parametrize("shape", ["path", "star", "random", "comb"])
def test_totals_of_subtrees(spark, shape):
    rnd, n = random.Random(6), 300
    parents = {"path": lambda i: i - 1, "star": lambda i: 0, "random": lambda i: rnd.randrange(i),
               "comb": lambda i: i - 1 if i % 2 else i - 2 if i > 1 else 0}[shape]
    up = [None, *(max(0, parents(i)) for i in range(1, n))]
    depth = [0] * n
    for i in range(1, n):
        depth[i] = depth[up[i]] + 1
    value = [rnd.randrange(100) for _ in range(n)]
    total = value[:]
    for i in sorted(range(1, n), key=depth.__getitem__, reverse=True):
        total[up[i]] += total[i]
    tree = spark.createDataFrame([(i, up[i], depth[i], value[i], 1) for i in range(n)],
                                 "id bigint, parent bigint, depth bigint, v bigint, one bigint")
    with Staging(spark, "tree") as staging:
        rows = subtree_totals(tree, ["v", "one"], staging).collect()
    assert sorted((r.id, r.v) for r in rows) == list(enumerate(total))
    assert {r.id: r.one for r in rows}[0] == n
