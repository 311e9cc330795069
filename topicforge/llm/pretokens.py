"""Splitting texts into the pieces that a byte-pair tokenizer file merges separately.

Reads a tokenizer file (JSON of the public ``tokenizers`` format).  Two families occur: word pieces
with an end-of-word mark (text is NFC-normalised and lower-cased, white space dropped) and byte-level
pieces that keep white space.  A special token inside a text is a piece of its own, as the library does
by default.  The regular expressions below are the formats' own.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import regex
from tokenizers import Tokenizer

# Fixed values of the two formats.
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others take the letters from U+0100 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=1)
def unassigned() -> re.Pattern:
    """Matches code points for which tables of different Unicode versions may disagree: those that
    Python's tables do not know (classes) and combining marks past U+036F (order under NFC)."""
    ranges, start = [], None
    for c in range(sys.maxunicode + 2):
        kind = unicodedata.category(chr(c)) if c <= sys.maxunicode else ""
        unknown = kind == "Cn" or kind.startswith("M") and c > 0x36F
        if unknown and start is None:
            start = c
        elif not unknown and start is not None:
            ranges.append(f"{re.escape(chr(start))}-{re.escape(chr(c - 1))}")
            start = None
    return re.compile("[" + "".join(ranges) + "]")


#: Finds a character outside Latin script, its marks and common punctuation.
_BEYOND = re.compile("[^\x00-\u0377\u2000-\u2064]").search


def finder(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of a format's expression.  For texts within Latin script the classes are written out, which
    Python's own expressions find in a third of the time."""
    common = "".join(map(chr, (*range(0x378), *range(0x2000, 0x2065))))
    letter, number, space = (re.escape("".join(regex.findall(c, common))) for c in (r"\p{L}", r"\p{N}", r"\s"))
    near = pattern.replace(r"[^\s\p{L}\p{N}]", "OTHER").replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}")
    for c, written in ((r"\p{L}", f"[{letter}]"), (r"\p{N}", f"[{number}]"), (r"\S", f"[^{space}]"), (r"\s", f"[{space}]"),
                       ("OTHER", f"[^{space}{letter}{number}]")):
        near = near.replace(c, written)
    usual, general = re.compile(near).findall, regex.compile(pattern).findall
    return lambda text: usual(text) if text.isascii() or not _BEYOND(text) else general(text)


class Vocabulary:
    """A tokenizer file as bytes: ``tokens[i]`` is the byte string of id i, ``ends[i]`` whether it
    closes a word, ``merges`` the pairs of ids by rank, ``special`` the ids of special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of = {i: s for s, i in model["vocab"].items()} | {i: s for s, i in self.special.items()}
        self.size = max(self.text_of) + 1
        back = {c: b for b, c in enumerate(byte_letters())}
        self.symbols: dict[int, str] = {}  # id -> string over bytes 0-255, word-final bytes raised by 256
        for s, i in model["vocab"].items():
            final = bool(self.suffix) and s.endswith(self.suffix)
            codes = [back[c] for c in (s[: -len(self.suffix)] if final else s)]
            if final and codes:
                codes[-1] += 256
            self.symbols[i] = "".join(map(chr, codes))
        by_symbols = {s: i for i, s in self.symbols.items()}
        self.ids = by_symbols
        vocab = model["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}  # (left, right) -> (rank, merged id)
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])

    def spell(self, piece: str) -> str:
        """A piece as a string of the alphabet of ``symbols``."""
        raw = piece.encode("utf-8").decode("latin-1")
        return raw[:-1] + chr(ord(raw[-1]) + 256) if self.suffix and raw else raw


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def splitter(path: str) -> Callable[[str], list[str]]:
    """A function from a text to its pieces; special tokens come as their own string."""
    v = vocabulary(path)
    special = re.compile("(" + "|".join(map(re.escape, sorted(v.special, key=len, reverse=True))) + ")") if v.special else None
    marks = [s[:2] for s in v.special]
    odd = unassigned().search
    strange = lambda text: _BEYOND(text) and odd(text)
    back = {c: b for b, c in enumerate(byte_letters())}
    library = Tokenizer.from_file(path)

    def by_library(text: str) -> list[str]:
        text = library.normalizer.normalize_str(text) if library.normalizer else text
        return [bytes(map(back.__getitem__, p)).decode("utf-8") for p, _ in library.pre_tokenizer.pre_tokenize_str(text)]

    if v.suffix:
        find = finder(WORD_PIECES)

        def cut(text: str) -> list[str]:
            """``find``; letters up to white space, or up to one character before it, need no expression."""
            if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # Python splits there, the formats do not
                return find(text)
            out: list[str] = []
            for chunk in text.split():
                if chunk.isalpha():
                    out.append(chunk)
                elif (word := chunk[:-1]).isalpha():
                    out += word, chunk[-1]
                else:
                    out += find(chunk)
            return out

        def plain(text: str) -> list[str]:
            if not text.isascii():
                if strange(text):
                    return by_library(text)
                # The library lowers each character by itself: a final capital sigma is no exception.
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            return cut(text.lower())
    else:
        find = finder(BYTE_PIECES)

        def plain(text: str) -> list[str]:
            return by_library(text) if not text.isascii() and strange(text) else find(text)

    def split(text: str) -> list[str]:
        if special is None or not any(m in text for m in marks):
            return plain(text)
        out: list[str] = []
        for k, part in enumerate(special.split(text)):
            out += [part] if k % 2 else plain(part)
        return out

    return split


#: White space that Python splits at but the formats do not count as white space.
_NOT_SPACE = re.compile("[\x1c-\x1f]").search
#: A space beside other white space: there a byte-level piece may hold both.
_SPACE_RUN = re.compile(r" \s|[^\S ] ").search


def chunker(path: str) -> Callable[[str], tuple[str, list[str], str]]:
    """A function from a text to (head, chunks, mark): its pieces are those of ``head``, then those of
    ``mark + chunk`` for each chunk.  Chunks are cut at white space, where no piece continues, so what is
    known of a chunk holds wherever it stands.  Word pieces drop white space; byte-level pieces begin with
    the space before a word.  A text with unusual white space is one head."""
    if vocabulary(path).suffix:
        return lambda text: (text, [], "") if _NOT_SPACE(text) else ("", text.split(), "")

    def cut(text: str) -> tuple[str, list[str], str]:
        if _SPACE_RUN(text):
            return text, [], " "
        head, *rest = text.split(" ")
        return head, rest, " "

    return cut


class Memo(dict):
    """A dictionary that computes what it lacks.  Once it holds ``most`` entries it starts anew, but takes
    over what is asked for again from the entries before; keys longer than ``longest`` are not kept.  So its
    memory is bounded whatever the texts hold, and frequent keys stay."""

    def __init__(self, compute: Callable | None = None, most: int = 300_000, longest: int = 48):
        super().__init__()
        self.compute, self.most, self.longest, self.before = compute, most, longest, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if isinstance(key, str) and len(key) > self.longest:
            return
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[key] = value

    def renew(self, keys) -> set:
        """The ``keys`` that are unknown; those known from before are taken over."""
        before, out = self.before, set()
        for k in set(keys):  # one by one: a set's difference with a dictionary of another class reads all of it
            if k not in self:
                if k in before:
                    self[k] = before[k]
                else:
                    out.add(k)
        return out
