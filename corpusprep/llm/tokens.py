"""Cutting texts where a byte-level tokenizer cuts in any case, so that repeated parts are encoded once."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

# A space in front of a character that is no white space always starts a token of the patterns that
# byte-level vocabularies use, and white space in front of it ends there with or without it. The
# control characters are white space to one regex library and not to another: no cut there.
_CUT = re.compile(r" (?=[^\s\x1c-\x1f\x85])")
_ODD = re.compile(r" (?:[\s\x1c-\x1f\x85]|\Z)")


def cut(text: str) -> list[str]:
    """Parts of ``text``; every part but the first had one space in front, which is left out."""
    if _ODD.search(text) is None:
        return text.split(" ")
    return _CUT.split(text)


class PartEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, from an encoder of parts.

    ``encode_first`` takes the first part of a text, ``encode_rest`` a list of other parts, without their
    spaces. Encoded parts are kept up to a bound; then only those of the texts at hand are.
    """

    def __init__(
        self,
        encode_first: Callable[[str], bytes],
        encode_rest: Callable[[list[str]], list[bytes]],
        entries: int = 800_000,
        longest: int = 64,
        block: int = 1 << 18,
    ):
        self.encode_first, self.encode_rest = encode_first, encode_rest
        self.entries, self.longest, self.block = entries, longest, block
        self.known: dict[str, bytes] = {}

    def all(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        start, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= self.block or i == len(texts) - 1:
                yield from self._some(texts[start : i + 1])
                start, size = i + 1, 0

    def _some(self, texts: list[str]) -> Iterator[bytes]:
        parts = [cut(text) for text in texts]
        wanted: set[str] = set()
        for own in parts:
            wanted.update(own[1:])
        new = sorted(wanted.difference(self.known))
        if new:
            if len(self.known) + len(new) > self.entries:
                self.known = {p: self.known[p] for p in wanted if p in self.known}
            self.known.update(zip(new, self.encode_rest(new)))
        find = self.known.__getitem__
        for own in parts:
            yield (self.encode_first(own[0]) if own[0] else b"") + b"".join(map(find, own[1:]))
        for part in new:
            if len(part) > self.longest:
                del self.known[part]
