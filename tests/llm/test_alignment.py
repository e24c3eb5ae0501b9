"""Cross-tokenizer alignment against a brute-force version on a small table."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from docketlake.llm import alignment
from docketlake.llm.alignment import aligned

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def expected():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") else p.replace("▁", " ").encode()

    def tokens(text):
        """[(id, end)] of either side; none where they don't spell the text."""
        sides = []
        for ids, of in ((a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(byte[c] for c in a.id_to_token(i))),
                        (b.encode(text), piece)):
            end, side, data = 0, [], b""
            for i in ids:
                data += of(i)
                side.append((i, len(data)))
            if data != (" " + text).encode() or not text:
                return [], []
            sides.append(side)
        return sides

    def run(texts):
        found = [tokens(t or "") for t in texts]
        links = [[(i, j) for i, e in x for j, f in y if e == f] if len(x) < 400 else
                 [(i, dict((f, j) for j, f in y)[e]) for i, e in x if e in {f for _, f in y}] for x, y in found]
        counts = Counter(p for some in links for p in some)
        best = Counter()
        for (i, j), n in counts.items():
            best[j] = max(best[j], n)
        out = []
        for no, ((x, y), some) in enumerate(zip(found, links)):
            common = sorted({e for _, e in x} & {f for _, f in y})
            groups, low = [], 0
            for e in common:
                groups.append(",".join(str(i) for i, at in x if low < at <= e) + "|" + ",".join(str(j) for j, at in y if low < at <= e))
                low = e
            out.append((no, len(x), len(y), len(common), len(some), sum(counts[p] == best[p[1]] for p in some),
                        sum(counts[p] for p in some), hashlib.sha256(";".join(groups).encode()).hexdigest() if x else ""))
        return out

    return run


def got(spark, texts):
    rows = [(i, t, "en", 1, 2, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, copies bigint, k1 bigint, block string")
    return sorted(map(tuple, aligned(docs, A, B).collect()))


def test_against_brute_force(spark, expected):
    rnd = random.Random(9)
    words = ["the", "of", "Straße", "naïve", "日本語", "don't", "x1", "\n", "\t\t", "  ", "🙂", "<s>", "<|endoftext|>", "</s>", "ﬁ", "é"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 40))) for _ in range(60)]
    texts += [None, "", None, " ", "a", "a", "▁", "a▁b", "\x00", "<unk>", "<0x41>", "the of " * 60, " \x85", *texts[:9], *["same text"] * 30]
    assert got(spark, texts) == expected(texts)


def test_small_blocks_give_the_same(spark, expected, monkeypatch):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab c\ndé") for _ in range(rnd.randrange(80))) for _ in range(80)]
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 100)
    monkeypatch.setattr(alignment, "CALL_BYTES", 30)
    assert got(spark, texts) == expected(texts)


def test_the_quicker_library_gives_the_same_tokens():
    rnd, a = random.Random(3), alignment.Aligner(A, B)
    assert a.fast is not None
    parts = [" ", "a", "7", "'s", "'LL", "\n", "\x85", "\xa0", "\x1c", "<|endoftext|>", "the", "ß", "\u024f"]
    for _ in range(4000):
        t = "".join(rnd.choice(parts) if rnd.random() < 0.6 else chr(rnd.randrange(0x250)) for _ in range(rnd.randrange(30)))
        assert not alignment.LATIN.search(t)
        assert a.fast.encode_ordinary(" " + t) == a.a.encode(" " + t, add_special_tokens=False).ids, repr(t)
    assert alignment.LATIN.search("a\u0250") and alignment.LATIN.search("日")


def test_no_documents(spark):
    assert got(spark, []) == []
