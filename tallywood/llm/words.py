"""Memories of tokenised pieces of text, kept by a Python worker between its tasks."""

from __future__ import annotations

import os
from functools import cache

# Tasks share a machine; each worker encodes on its own core.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Entries of one generation of a memory, and the longest piece that is kept: a memory
# then holds at most some 120 MB, whatever the corpus.
MOST_KEPT = 300_000
LONGEST_KEPT = 64


@cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Memory(dict):
    """Values by piece, in two generations: the older one goes when the newer is full.

    What it forgets is computed again; no result depends on it.
    """

    def __init__(self, most: int = MOST_KEPT):
        super().__init__()
        self.most = most
        self.old: dict = {}

    def value(self, piece: str):
        """What a piece gives when it is not remembered; by subclasses."""
        raise KeyError(piece)

    def keep(self, piece: str, value) -> None:
        if len(piece) > LONGEST_KEPT:
            return
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[piece] = value

    def __missing__(self, piece: str):
        found = self.old.get(piece)
        if found is None:
            found = self.value(piece)
        self.keep(piece, found)
        return found
