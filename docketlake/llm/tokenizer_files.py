"""Reads the vocabulary files of public tokenizers; their place is a parameter."""

from __future__ import annotations

import json


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(shown))
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class Vocabulary:
    """Merge list, identifiers and special strings of a byte-level BPE in JSON form."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.merges = [tuple(m) for m in file["model"]["merges"]]
        self.ids: dict[str, int] = file["model"]["vocab"]
        self.word_end: str = file["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
