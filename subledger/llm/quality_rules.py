"""Quality rules: how far zstandard shrinks a text must lie in a band that depends on its length.

Repetitive text shrinks too well, random characters hardly at all. Longer texts shrink better as the compressor sees
more of them, so both limits rise with the length. The whole text is judged, and its chunks of fixed size as well, which
finds a text half of which is fine.

What is too well compressed is told from a recoded text in which the letters of any alphabet take one byte each, so that
the same words in Latin, Cyrillic or Devanagari have the same ratio. What is hardly compressed is told from its UTF-8.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from subledger.llm.common import keep_rows, per_batch, words

_SYMBOLS = re.compile(r"[#*$%&|<>]")


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio of plain to compressed bytes at some lengths; between them they follow the logarithm of the
    length, beyond them they stay. Texts shorter than the first length are not judged by their ratio.

    The lower limits lie above encoded data. The upper ones lie above what prose, licences and manuals of these lengths
    reach; texts full of symbols are held to the narrower ones, just above prose without formal turns.
    """

    lengths: Sequence[int] = (256, 512, 1024, 2048, 4096, 8192, 16384, 32768, 131072)
    lowest: Sequence[float] = (1.05, 1.15, 1.25, 1.35, 1.40, 1.45, 1.50, 1.50, 1.50)
    highest: Sequence[float] = (2.80, 3.20, 3.60, 4.00, 4.60, 5.20, 5.80, 6.20, 6.60)
    highest_marked: Sequence[float] = (1.98, 2.09, 2.18, 2.29, 2.41, 2.51, 2.60, 2.68, 2.80)
    #: From more symbols a word than this on a text is held to ``highest_marked``.
    marks_a_word: float = 0.4
    chunk: int = 4096
    #: A text whose chunks outside the band hold more than this share of its chunked bytes is rejected.
    bad_share: float = 0.5
    level: int = 3

    def shrinks(self, plain: int, packed: int) -> bool:
        return plain < self.lengths[0] or plain / packed >= self._limit(plain, self.lowest)

    def repeats(self, plain: int, packed: int, marked: bool = False) -> bool:
        if plain < self.lengths[0]:
            return False
        return plain / packed > self._limit(plain, self.highest_marked if marked else self.highest)

    def _limit(self, plain: int, limits: Sequence[float]) -> float:
        return float(np.interp(np.log2(plain), np.log2(self.lengths), limits))


@dataclass(frozen=True)
class BaseRules:
    least_words: int = 50
    #: Words in repeated windows may be this share of all words, in hundredths.
    most_repeated: int = 50
    window: int = 3


def repeated_words(tokens: Sequence[str], window: int = 3) -> int:
    """Words covered by a window of words that occurs twice or more, its first occurrence included."""
    if len(tokens) <= window:
        return 0
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in tokens), np.int64, len(tokens))
    keys = ids[: len(ids) - window + 1]
    for at in range(1, window):
        keys = keys * len(known) + ids[at : len(ids) - window + 1 + at]
        if at + 1 < window and len(known) > 1 << 20:  # keep the next product within 64 bits
            keys = np.unique(keys, return_inverse=True)[1]
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    covered = np.zeros(len(ids) + 1, np.int64)
    again = np.flatnonzero(counts[which] > 1)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + window, -1)
    return int(np.count_nonzero(np.cumsum(covered[:-1])))


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if words(line)]
    return len(lines) - len(set(lines))


#: Recoded, so many characters beyond ASCII take one byte, the most frequent ones of a text; then so many take two.
_ONE, _TWO = 96, 31 << 8


def recoded(text: str) -> tuple[bytes, np.ndarray | None]:
    """The text with one byte for ASCII and its own frequent other characters, and the bytes of each character.

    A one-for-one change of the letters beyond ASCII changes which bytes stand for them, not how many or how they repeat.
    Different texts over the same characters have different bytes. Sizes are None where all are 1 and UTF-8 is the same.
    """
    if text.isascii():
        return text.encode(), None
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    wide = codes >= 128
    found, first, which, counts = np.unique(codes[wide], return_index=True, return_inverse=True, return_counts=True)
    rank = np.empty(len(found), np.int64)
    rank[np.lexsort((first, -counts))] = np.arange(len(found))  # ties by place, which no change of letters alters
    number = np.zeros(len(codes), np.int64)
    number[wide] = rank[which]
    sizes = 1 + (number >= _ONE) + 2 * (number >= _ONE + _TWO)
    ends = np.cumsum(sizes)
    out, at = np.zeros(ends[-1], np.uint8), ends - sizes
    out[at] = np.where(wide, 128 + np.minimum(number, _ONE - 1), codes)
    two, four = sizes == 2, sizes == 4
    rest = number - _ONE
    out[at[two]], out[at[two] + 1] = 224 + (rest[two] >> 8), rest[two] & 255
    out[at[four]] = 255
    for place in (1, 2, 3):
        out[at[four] + place] = (rest[four] >> 8 * (place - 1)) & 255
    return out.tobytes(), sizes


class Judge:
    """All figures of a text, and the verdict."""

    def __init__(self, bands: Bands, base: BaseRules) -> None:
        self.bands, self.base = bands, base
        self.packer = zstandard.ZstdCompressor(level=bands.level)

    def figures(self, text: str | None) -> dict:
        text = text or ""
        found = words(text)
        repeated = repeated_words(found, self.base.window)
        failed = len(found) < self.base.least_words or 100 * repeated > self.base.most_repeated * len(found)
        symbols = len(_SYMBOLS.findall(text))
        marked = symbols > self.bands.marks_a_word * len(found)
        raw = text.encode("utf-8", "surrogatepass")
        short, sizes = recoded(text)
        packed = len(self.packer.compress(raw))
        bad = self.bad_share(text, raw, short, sizes, marked)
        in_band = self.fits(raw, short, marked, packed) and bad <= self.bands.bad_share
        return {
            "n_words": len(found), "word_chars": sum(map(len, found)), "n_symbols": symbols,
            "n_dup_lines": duplicate_lines(text), "n_repeat_words": repeated, "base_failed": failed,
            "kept": not failed and in_band, "ratio": len(raw) / packed, "bad_chunk_share": bad,
        }

    def fits(self, raw: bytes, short: bytes, marked: bool, packed: int | None = None) -> bool:
        """Whether a text, given in UTF-8 and recoded, lies in the band. ``packed`` is the compressed size of ``raw``."""
        packed = len(self.packer.compress(raw)) if packed is None else packed
        if not self.bands.shrinks(len(raw), packed):
            return False
        tight = packed if len(short) == len(raw) else len(self.packer.compress(short))
        return not self.bands.repeats(len(short), tight, marked)

    def bad_share(self, text: str, raw: bytes, short: bytes, sizes: np.ndarray | None, marked: bool) -> float:
        """Share of the recoded bytes that lie in chunks outside the band. A short tail belongs to the chunk before it."""
        size, total = self.bands.chunk, len(short)
        if total < 2 * size:
            return 0.0
        starts = np.arange(0, total - size + 1, size)
        if sizes is None:
            parts = [(short[s:e], short[s:e]) for s, e in zip(starts, [*starts[1:], total])]
        else:
            ends = np.concatenate([[0], np.cumsum(sizes)])
            cuts = [*np.searchsorted(ends, starts).tolist(), len(text)]
            parts = [
                (text[a:b].encode("utf-8", "surrogatepass"), short[ends[a] : ends[b]]) for a, b in zip(cuts, cuts[1:])
            ]
        return sum(len(part) for plain, part in parts if not self.fits(plain, part, marked)) / total


def quality(df: DataFrame, bands: Bands = Bands(), base: BaseRules = BaseRules(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, counts, compression ratio, share of bad chunks, and whether it is kept.

    A null or empty text has no words, fails the base rules and has ratio 0. Long texts are read whole. Repeated rows are
    judged each, an empty table gives no rows, and other columns of the input are not looked at.
    """
    kind = df.schema[key].dataType.simpleString()

    def make():
        judge = Judge(bands, base)

        def run(batch):
            rows = [judge.figures(t) for t in batch["t"]]
            return {"id": batch["id"], **{c: [r[c] for r in rows] for c in _FIGURES}}

        return run

    schema = f"id {kind}, " + ", ".join(f"{c} {t}" for c, t in _FIGURES.items())
    return per_batch(df, [df[key].alias("id"), df[text].alias("t")], make, schema).withColumnRenamed("id", key)


_FIGURES = {
    "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint",
    "base_failed": "boolean", "kept": "boolean", "ratio": "double", "bad_chunk_share": "double",
}


def keep_good(df: DataFrame, bands: Bands = Bands(), base: BaseRules = BaseRules(), text: str = "text") -> DataFrame:
    """The documents that pass, all their columns unchanged.

    Null and empty texts have no words and go; very long ones are judged as a whole and in chunks. Repeated rows are judged
    alike, an empty table stays empty, columns of any name are passed on.
    """

    def make():
        judge = Judge(bands, base)
        return lambda batch: [judge.figures(t)["kept"] for t in batch[text]]

    return keep_rows(df, [text], make)
