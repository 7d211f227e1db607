"""Text cut into chunks that a byte-level BPE pattern never joins, with a bounded memo.

A match of the pattern holds white space only before its first other
character, and at most one space there.  So a text cut in front of single
spaces can be encoded chunk by chunk, and words that recur are encoded once.
Only where a space has white space on both sides (or ends the text after white
space) does a match span a cut; such texts are encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: A space that a match of the pattern may share with white space before it.
_SPANNING = re.compile(r"\s (?:\s|\Z)")
#: Entries of a memo that a worker keeps between tasks: its process stays and serves other stages too.
BETWEEN = 50_000
#: Entries of one generation of a memo; a worker keeps two.
MEMO = 200_000


class Memo(dict):
    """make(key), remembered in two generations of up to ``size`` keys.

    When the young one is full it becomes the old one; what is asked for again
    comes back from there, so common keys outlive the many that come once.
    """

    def __init__(self, make: Callable, size: int = MEMO):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self[key] = self.old[key] if key in self.old else self.make(key)
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()
        return value


    def rest(self) -> None:
        """Frees most of what is remembered; called when a task ends."""
        self.old = {}
        if len(self) > BETWEEN:
            self.clear()


class ChunkEncoder:
    """Packed ids (little-endian unsigned 32-bit) of whole texts; ``encode`` gives those of a chunk, ``whole`` those of any
    text, ``spaced`` those of a chunk with a space in front (default: by ``encode``)."""

    def __init__(self, encode: Callable[[str], bytes], whole: Callable[[str], bytes] | None = None, size: int = MEMO,
                 spaced: Callable[[str], bytes] | None = None):
        self.whole = whole or encode
        self.first = Memo(encode)
        self.spaced = Memo(spaced or (lambda chunk: encode(f" {chunk}")), size)

    def __call__(self, text: str) -> bytes:
        if _SPANNING.search(text):
            return self.whole(text)
        head, *chunks = text.split(" ")
        spaced = b"".join(map(self.spaced.__getitem__, chunks))
        return self.first[head] + spaced if head else spaced

    def rest(self) -> None:
        self.first.rest()
        self.spaced.rest()
