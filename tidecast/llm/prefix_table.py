"""The last token of every prefix, for merge-type vocabularies.

The encoding of a prefix ends in exactly one token: the vocabulary entry that ends there and
is compatible with the last token of what comes before it. Two tokens are compatible if their
joined text is encoded as just these two. So one pass over the automaton's matches gives the
last token of every prefix; walking back over the last tokens gives the ids, and counting
along the same links gives the token count of every prefix.
"""

from __future__ import annotations

from collections.abc import Callable

import ahocorasick


class PrefixTable:
    """Last tokens of all prefixes of a string of known characters.

    ``entries`` maps texts to ids; ``encode`` gives the ids of a short text by merging. Whether
    two tokens may follow each other is asked once per pair that meets: of ``compatible`` if it
    is given, else by encoding their joined text. At most ``memory`` pairs are remembered.
    """

    def __init__(
        self,
        entries: dict[str, int],
        encode: Callable[[str], list[int]],
        memory: int = 500_000,
        compatible: Callable[[str, str], bool] | None = None,
    ):
        self.encode, self.memory, self.compatible = encode, memory, compatible
        self.texts = {i: text for text, i in entries.items()}
        self.pairs: dict[int, bool] = {}
        self.matches = ahocorasick.Automaton()
        for text, i in entries.items():
            if len(text) == 1 or encode(text) == [i]:
                self.matches.add_word(text, (len(text), i))
        self.matches.make_automaton()

    def fits(self, left: int, right: int) -> bool:
        key = left << 24 | right
        known = self.pairs.get(key)
        if known is None:
            a, b = self.texts[left], self.texts[right]
            known = self.compatible(a, b) if self.compatible else self.encode(a + b) == [left, right]
            if len(self.pairs) >= self.memory:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def last_tokens(self, text: str) -> tuple[list[int], list[int]]:
        """For prefixes of 0..len(text) characters: the last token, and the token count."""
        last, count = [-1] * (len(text) + 1), [0] * (len(text) + 1)
        pairs, fits = self.pairs, self.fits
        for at, (length, token) in self.matches.iter(text):
            end = at + 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                known = pairs.get(last[start] << 24 | token)
                if not (fits(last[start], token) if known is None else known):
                    continue
            last[end], count[end] = token, count[start] + 1
        return last, count

    def ids(self, text: str) -> list[int]:
        """The tokens of the whole text, recovered from its end backwards."""
        last, _ = self.last_tokens(text)
        out, end = [], len(text)
        while end:
            out.append(last[end])
            end -= len(self.texts[last[end]])
        return out[::-1]
