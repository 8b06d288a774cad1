"""URL filters: all glob rules as one bit-parallel automaton.

Each rule is a glob over ``.host/path`` (the leading dot lets ``*.org`` mean org and everything below it). The atoms of
all rules are laid out as bits of a few 64-bit words. One Shift-And step per byte moves every rule at once:

    state = ((state << 1) & takes[byte]) | (state & stays[byte])

where ``takes`` has a bit for each atom that accepts the byte and ``stays`` one for each wildcard that may swallow it.
The step runs over a batch of URLs at a time, longest first, so finished ones drop out and nothing is padded.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import per_batch

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` a glob. In it, ``*`` is any run without a slash, ``**`` any run, ``?`` one byte but a slash.

    ``name`` is reported as the rule that decided; None for rules of a general kind that are not reported. ``weight``
    ranks rules that fit the same URL: the heaviest decides, the earliest of equals.
    """

    verdict: str
    glob: str
    weight: int
    name: str | None = None

    @classmethod
    def below(cls, verdict: str, host_path: str) -> Rule:
        """The rule for a host, its subdomains and paths that start as given: ``example.org/es/``."""
        return cls(verdict, f"*.{_escaped(host_path)}**", len(host_path), host_path)


def _escaped(text: str) -> str:
    return "".join(f"\\{c}" if c in "*?\\" else c for c in text)


class Automaton:
    """Masks of all rules, and the step over them."""

    def __init__(self, globs: Sequence[str]) -> None:
        atoms: list[set[int] | None] = []  # what the bit's atom accepts; None for the start of a rule
        loops: list[str] = []  # what a bit may swallow: "", "*" or "**"
        self.ends: list[int] = []
        starts = []
        for glob in globs:
            starts.append(len(atoms))
            atoms.append(None)
            loops.append("")
            at, raw = 0, glob.encode()
            while at < len(raw):
                if raw[at : at + 2] == b"**":
                    loops[-1], at = "**", at + 2
                elif raw[at : at + 1] == b"*":
                    loops[-1], at = loops[-1] or "*", at + 1
                else:
                    if raw[at : at + 1] == b"?":
                        accepted = set(range(256)) - {ord("/")}
                    else:
                        at += raw[at : at + 1] == b"\\"
                        accepted = {raw[at]}
                    atoms.append(accepted)
                    loops.append("")
                    at += 1
            self.ends.append(len(atoms) - 1)
        self.words = -(-len(atoms) // 64) or 1
        self.start = np.zeros(self.words, np.uint64)
        self.takes = np.zeros((256, self.words), np.uint64)
        self.stays = np.zeros((256, self.words), np.uint64)
        for bit, (accepted, loop) in enumerate(zip(atoms, loops)):
            word, mask = bit // 64, np.uint64(1 << (bit % 64))
            for byte in accepted or ():
                self.takes[byte, word] |= mask
            for byte in range(256) if loop else ():
                if loop == "**" or byte != ord("/"):
                    self.stays[byte, word] |= mask
        for bit in starts:
            self.start[bit // 64] |= np.uint64(1 << (bit % 64))

    def run(self, keys: Sequence[bytes]) -> np.ndarray:
        """Final states, one row of words per key."""
        lengths = np.fromiter((len(k) for k in keys), np.int64, len(keys))
        order = np.argsort(-lengths, kind="stable")
        text = np.frombuffer(b"".join(keys), np.uint8)
        begins = (np.cumsum(lengths) - lengths)[order]
        lengths = lengths[order]
        state = np.tile(self.start, (len(keys), 1))
        for at in range(int(lengths[0]) if len(keys) else 0):
            live = int(np.searchsorted(-lengths, -at, "left"))  # those longer than ``at``
            byte, now = text[begins[:live] + at], state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.takes[byte]) | (now & self.stays[byte])
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back]

    def accepts(self, states: np.ndarray, rule: int) -> np.ndarray:
        end = self.ends[rule]
        return (states[:, end // 64] >> np.uint64(end % 64)) & np.uint64(1) != 0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one or if null."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def filter_urls(df: DataFrame, rules: Sequence[Rule], default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule and verdict of every row.

    Null, empty and malformed URLs have empty host and path, and so the default verdict unless a glob takes the empty
    string after the dot. URLs of any length are read whole. Repeated rows are judged each, an empty table gives no rows,
    and columns of the input other than ``key`` and ``url`` are not looked at, whatever their names.
    """
    ranked = sorted(rules, key=lambda r: -r.weight)

    def make():
        automaton = Automaton([r.glob for r in ranked])

        def judge(batch):
            keys = [f".{h}{p}".encode() for h, p in zip(batch["host"], batch["path"])]
            states = automaton.run(keys)
            winner = np.full(len(keys), -1)
            for at in range(len(ranked) - 1, -1, -1):  # the heaviest writes last
                winner[automaton.accepts(states, at)] = at
            return {
                **{k: batch[k] for k in ("id", "host", "path")},
                "rule": [ranked[w].name if w >= 0 else None for w in winner],
                "verdict": [ranked[w].verdict if w >= 0 else default for w in winner],
            }

        return judge

    kind = df.schema[key].dataType.simpleString()
    columns = [F.col(key).alias("id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")]
    judged = per_batch(df, columns, make, f"id {kind}, host string, path string, rule string, verdict string")
    return judged.withColumnRenamed("id", key)


#: The published rule set: the longest that fits a URL decides.
RULES = [
    Rule.below("allow", "org/"),
    Rule.below("block", "example.org/es/"),
    Rule.below("block", "example.org/en/1"),
    Rule.below("allow", "com/fr/"),
    Rule.below("block", "com/de/"),
]
#: Kinds of host that are blocked where no rule above fits.
KINDS = [Rule("block", glob, 0) for glob in ("*.spam-**", "*.casino-**", "*.poker-**", "*-pills.**")]
