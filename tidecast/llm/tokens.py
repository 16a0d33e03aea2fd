"""Token ids of whole texts from the tokenizers library, fast through a bounded word cache.

Both vocabularies split a text before any merge, so a blank can share a token with the
character before it only inside a run of white space. Few tokens do that (runs of blank and
no-break space do); which characters they join is read from the vocabulary. In front of all
other blanks a text may be cut and each piece encoded alone, with the ids of the whole text as
result. Pieces repeat (words do), so each distinct one goes through the library once and its
ids are kept, in two generations of bounded size.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterable

import numpy as np
import regex

from tidecast.llm.common import kept_in_worker

# The split patterns of the two tokenizer files.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# End of fixed values.

# Pieces of these characters (up to Latin Extended-A, composed) need no Unicode tables.
PLAIN = re.compile("[\n -~¡-¬®-įĲ-ľŁ-ňŊ-ž]*")
# Parts of words whose ids an encoder keeps.
PARTS = 200_000
BLANKS = re.compile(r" *[^ ]+| +")


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte value."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


TO_CHARACTERS = {b: c for b, c in enumerate(byte_characters())}


def joined_to_blanks(tokens: Iterable[str]) -> list[str]:
    """White space, other than blanks, that a byte-level token joins with a following blank.

    Tokens are bytes, so each such character whose last byte stands before a blank counts.
    """
    blank = TO_CHARACTERS[32]
    ends = {c for t in tokens for c, after in itertools.pairwise(t) if after == blank != c}
    spaces = (chr(i) for i in range(0x10000) if chr(i).isspace() and chr(i) != " ")
    return [c for c in spaces if TO_CHARACTERS[c.encode()[-1]] in ends]


def cut_pattern(joined: Iterable[str]) -> re.Pattern:
    """Like BLANKS, but without a cut between one of ``joined`` and a blank."""
    kept = "".join(map(re.escape, joined))
    if not kept:
        return BLANKS
    return re.compile(rf" *[^ ]+(?:(?<=[{kept}]) +[^ ]+)*(?:(?<=[{kept}]) +)?| +")


class WordCache:
    """word -> value in two generations: what was not used for a while falls out.

    ``size`` bounds the characters of the words of one generation.
    """

    def __init__(self, size: int):
        self.size, self.used, self.new, self.old = size, 0, {}, {}

    def missing(self, words: Iterable[str]) -> set[str]:
        """The words without a value; values of the older generation move up."""
        if self.used > self.size:
            self.used, self.new, self.old = 0, {}, self.new
        absent = set(words).difference(self.new)
        self.used += sum(map(len, absent))
        if self.old:
            # Looked up word by word: the older generation is far larger than ``absent``.
            known = [word for word in absent if word in self.old]
            self.new.update((word, self.old[word]) for word in known)
            absent.difference_update(known)
        return absent


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, as the library gives them.

    ``end_id`` follows each text. Nothing is truncated, padded or added otherwise; special
    strings inside texts are handled as the library does by default, or as ordinary text.
    """

    def __init__(
        self,
        path: str,
        end_id: int | None = None,
        cache_size: int = 5_000_000,
        special_is_text: bool = False,
    ):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.end = b"" if end_id is None else np.uint32(end_id).astype("<u4").tobytes()
        # Only the byte-level vocabulary keeps blanks; the other one drops them.
        self.blanks = self.library.normalizer is None
        # A blank ends a word: the byte-level pattern puts it before a part, the other one drops it.
        self.pattern = regex.compile(BYTE_PATTERN if self.blanks else WORD_PATTERN + "| ")
        joined = joined_to_blanks(self.library.get_vocab(with_added_tokens=False)) if self.blanks else []
        self.cuts = cut_pattern(joined)
        # A text without any of these is cut in front of every blank.
        self.runs = ["  ", *(c + " " for c in joined)]
        self.library.encode_special_tokens = special_is_text
        self.special = [] if special_is_text else [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.first, self.later = WordCache(cache_size // 8), WordCache(cache_size)
        self.parts: dict[str, bytes] = {}

    def learn_parts(self, parts: Iterable[str]) -> None:
        """Ids of strings that the split pattern leaves whole, from the merge model."""
        if len(self.parts) > PARTS:
            self.parts.clear()
        new = list(set(parts).difference(self.parts))
        # All are mapped to the vocabulary's characters at once; no plain text holds a null.
        mapped = "\0".join(new).encode().decode("latin-1").translate(TO_CHARACTERS)
        tokenize, ids, ends = self.model.tokenize, [], []
        for part in mapped.split(TO_CHARACTERS[0]) if new else ():
            ids += [t.id for t in tokenize(part)]
            ends.append(4 * len(ids))
        raw = np.array(ids, "<u4").tobytes()
        self.parts.update((p, raw[a:b]) for p, a, b in zip(new, [0, *ends], ends, strict=False))

    def fill_plain(self, cache: WordCache, words: list[str], joined: str, mark: str) -> None:
        """Words split by one call over all of them; ``mark`` begins each and stands nowhere else."""
        if not self.blanks:
            joined = joined.lower()
        split = self.pattern.findall(joined)
        self.learn_parts(split if self.blanks else filter(" ".__ne__, split))
        if not self.blanks:
            self.parts[" "] = b""
        raw = list(map(self.parts.__getitem__, split))
        begin = [i for i, part in enumerate(split) if part[0] == mark]
        ends = [*begin[1:], len(split)]
        cache.new.update((w, b"".join(raw[a:b])) for w, a, b in zip(words, begin, ends, strict=True))

    def is_plain(self, text: str) -> bool:
        """Nothing in it needs Unicode tables or may be a special string."""
        return bool(PLAIN.fullmatch(text)) and not any(s in text for s in self.special)

    def fill(self, cache: WordCache, words: Iterable[str], lead: str) -> None:
        plain, lines, odd = [], [], []
        after_blank = lead == " " or not self.blanks
        absent = list(cache.missing(words))
        joined = " ".join(absent)
        # Most often one look at all of them will do.
        if after_blank and joined.count(" ") == len(absent) - 1 and "" not in absent and self.is_plain(joined):
            plain, absent = absent, []
        for word in absent:
            if not word or " " in word or not self.is_plain(word):
                odd.append(word)
            elif after_blank:
                plain.append(word)
            elif word[0] == "\n" and word.count("\n") == 1 < len(word):
                lines.append(word)
            else:
                odd.append(word)
        if plain:
            self.fill_plain(cache, plain, " " + " ".join(plain), " ")
        if lines:
            self.fill_plain(cache, lines, "".join(lines), "\n")
        if odd:
            found = self.library.encode_batch_fast(
                [lead + word for word in odd], add_special_tokens=False
            )
            cache.new.update(
                (word, np.array(x.ids, "<u4").tobytes())
                for word, x in zip(odd, found, strict=True)
            )

    def has_runs(self, text: str) -> bool:
        return any(run in text for run in self.runs)

    def ids_of(self, cache: WordCache, words: list[str], lead: str) -> bytes:
        found = list(map(cache.new.get, words))
        if None in found:
            self.fill(cache, [w for w, raw in zip(words, found, strict=True) if raw is None], lead)
            new = cache.new
            found = [new[w] if raw is None else raw for w, raw in zip(words, found, strict=True)]
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """The ids of one text, with the end id."""
        if self.blanks and self.has_runs(text):
            return self.ids_of(self.first, self.cuts.findall(text), "") + self.end
        words = text.split(" ")
        if not self.blanks:
            return self.ids_of(self.later, words, "") + self.end
        return self.ids_of(self.first, words[:1], "") + self.ids_of(self.later, words[1:], " ") + self.end


_encoders: dict[tuple, Encoder] = kept_in_worker()


def encoder(path: str, end_id: int | None = None, special_is_text: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file; workers live on from task to task."""
    key = (path, end_id, special_is_text)
    if key not in _encoders:
        _encoders[key] = Encoder(path, end_id, special_is_text=special_is_text)
    return _encoders[key]
