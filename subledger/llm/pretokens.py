"""Exact token counts and ids of a word-level BPE tokenizer from cached pieces.

A tokenizer file whose pre-tokenizer is one splitting pattern treats each piece on its own: the tokens of a text are those
of its pieces, one after another. Prose repeats its pieces, so looking them up is several times faster than encoding the
text, and gives the same ids. Only pieces not seen before reach the tokenizer's model.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import regex

#: Beyond these characters the tokenizer's and Python's character tables may differ. Finds one beyond.
_DISPUTED = re.compile("[^\x00-\x1b\x20-\u052f\u2000-\u206f]")
#: Beyond these a text may also have another composed form, or lower case that depends on the characters around.
_COMPOSED = re.compile("[^\x00-\x1b\x20-\u02ff\u2000-\u206f]")
#: Unicode's white space.
_SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The splitting pattern of the tokenizer files this module knows.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _plain_pattern() -> re.Pattern:
    """The same for texts that ``_COMPOSED`` finds nothing in, with the letters and numbers among them spelled out."""
    letters, numbers = ("".join(chr(c) for c in range(0x300) if unicodedata.category(chr(c))[0] == kind) for kind in "LN")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{_SPACE}{letters}{numbers}]+")


_PLAIN = _plain_pattern()
#: Entries a worker remembers, twice: beyond them a new table begins, and the one before is kept to look in. Bounds memory,
#: changes no result.
CACHE_ENTRIES = 400_000


class Pieces:
    """Splits a text as the tokenizer does."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = spec["pre_tokenizer"].get("pretokenizers", [])
        plain = [a for a in spec["added_tokens"] if not (a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"])]
        if len(steps) != 2 or steps[0].get("pattern") != {"Regex": PATTERN} or steps[1].get("use_regex") or len(plain) != len(spec["added_tokens"]):
            raise ValueError(f"{path}: not a tokenizer of single pieces")
        self.tokenizer = Tokenizer.from_file(path)
        self.special = {a["content"]: a["id"] for a in plain}
        suffix, vocabulary = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
        self.ends_word = np.zeros(max([*vocabulary.values(), *self.special.values()]) + 1, bool)
        self.ends_word[[n for t, n in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if plain else None
        self.split = regex.compile(PATTERN.replace(r"[^\s", f"[^{_SPACE}"))
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def parts(self, text: str) -> Iterator[list[str] | str]:
        """Special tokens as strings, and lists of pieces of what is between them."""
        if self.specials is None or not any(s in text for s in self.special):
            yield self.pieces(text)
            return
        for at, part in enumerate(self.specials.split(text)):
            if at % 2:
                yield part
            elif part:
                yield self.pieces(part)

    def pieces(self, text: str) -> list[str]:
        if not _COMPOSED.search(text):
            return _PLAIN.findall(text.lower())
        text = self.tokenizer.normalizer.normalize_str(text)
        if _DISPUTED.search(text):
            # Marked with a leading space, which no piece has: already in the model's alphabet of bytes.
            return [f" {p}" for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return self.split.findall(text)

    def ids(self, piece: str) -> list[int]:
        mapped = piece[1:] if piece[0] == " " else self.as_bytes.pre_tokenize_str(piece)[0][0]
        return [t.id for t in self.tokenizer.model.tokenize(mapped)]


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str | None) -> bytes:
        out = []
        for part in self.pieces.parts(text or ""):
            if isinstance(part, str):
                out.append(np.array([self.pieces.special[part]], "<u4").tobytes())
            else:
                out += self.of(part)
        return b"".join(out)

    def of(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece. Unknown pieces of a text are encoded together."""
        found = list(map(self.known.get, pieces))
        if None not in found:
            return found
        missing = [at for at, ids in enumerate(found) if ids is None]
        new = list(dict.fromkeys([pieces[at] for at in missing]))
        if len(self.known) + len(new) > CACHE_ENTRIES:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        if older:
            known.update((p, older[p]) for p in new if p in older)
            new = [p for p in new if p not in known]
        plain = [p for p in new if p[0] != " "]
        # A piece between spaces is split from its neighbours and from nothing else, and its last token ends a word.
        encoded = self.pieces.tokenizer.encode(" ".join(plain), add_special_tokens=False)
        numbers = np.array(encoded.ids, "<u4")
        ends = (4 * np.flatnonzero(self.pieces.ends_word[numbers]) + 4).tolist()
        if len(ends) == len(plain):
            ids = numbers.tobytes()
            known.update(zip(plain, [ids[start:end] for start, end in zip([0, *ends], ends)]))
        for piece in new:
            if piece not in known:
                known[piece] = np.array(self.pieces.ids(piece), "<u4").tobytes()
        for at in missing:
            found[at] = known[pieces[at]]
        return found


@cache
def worker_encoder(path: str) -> Encoder:
    """One encoder per worker and file: the tasks that a worker runs one after another share what it remembers."""
    return Encoder(path)


class Counter:
    """Token counts of whole texts: a given table of frequent pieces first, then the worker's own cache."""

    def __init__(self, path: str, frequent: dict[str, int]) -> None:
        self.encoder, self.frequent = Encoder(path), frequent

    def count(self, text: str | None) -> int:
        total = 0
        for part in self.encoder.pieces.parts(text or ""):
            if isinstance(part, str):
                total += 1
                continue
            lengths = list(map(self.frequent.get, part))
            if None in lengths:
                rare = [p for p, n in zip(part, lengths) if n is None]
                total += sum(filter(None, lengths)) + sum(map(len, self.encoder.of(rare))) // 4
            else:
                total += sum(lengths)
        return total
