"""Ids of a byte-level vocabulary, by a merging library that keeps nothing between texts.

The ids are those that the ``tokenizers`` library gives by default for the same
file: special strings inside a text are their own ids, no special tokens are
added. The vocabulary file is read once in each worker.
"""

from __future__ import annotations

import json

import numpy as np

from quadloom.llm.common import held
from quadloom.llm.counts import WORDS, byte_signs


class ByteIds:
    """The ids of whole texts."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before, model, added = spec["pre_tokenizer"], spec["model"], spec["added_tokens"]
        plain = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        if spec["normalizer"] or not plain or model["type"] != "BPE" or model["ignore_merges"]:
            raise ValueError("the vocabulary must be of byte-level merges without changes to the text")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special strings must stand for themselves alone")
        byte = {sign: b for b, sign in enumerate(byte_signs())}
        special = {t["content"]: t["id"] for t in added}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in pairs]
        if made != sorted(made):
            raise ValueError("ids must be in the order of merges")
        self.library = tiktoken.Encoding(path, pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        """The ids of ``text`` as unsigned 32-bit integers."""
        return self.library.encode_to_numpy(text, allowed_special="all")


def load(path: str) -> ByteIds:
    return held("byte ids", ByteIds, path)
