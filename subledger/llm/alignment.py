"""How two tokenizers cut the same bytes, and which of their tokens end together.

The offsets where a token of either ends cut a text into groups. A byte range of a text gives a *fragment*: the tokens up
to the first common end (an open prefix, which a range before it may complete), the groups closed within, and the tokens
after the last common end (an open suffix). Two fragments that follow each other make one: suffix and prefix close a group.
That is associative, so very long documents are cut into byte ranges which tasks tokenize apart, and their fragments are
combined in a tree; short documents are one range.

Ranges may start anywhere. To tokenize one, a task reads on to the nearest spaces that both tokenizers certainly cut at:
single ones between characters that are no white space. Neither tokenizer merges across them, so what is between two such
spaces has the same tokens wherever it stands, and a worker remembers those of words.

Counts of linked ids over the corpus are summed from counts per task. The most frequent pairs, a bounded number, are
broadcast; links of other pairs, none of which is frequent, are looked up by a join.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from functools import cache, reduce
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.llm.common import per_batch, with_row_id
from subledger.session import materialized

#: Bytes of a range. Longer documents are cut into ranges of this size.
RANGE = 65_536
#: Fragments that are combined at a time.
FAN = 16
#: Pairs of ids that are broadcast with their counts: 17 bytes each.
FREQUENT = 1_000_000
#: Words a worker remembers, twice (a new table begins when one is full, and the one before is kept to look in), and the
#: longest ones it does, in bytes.
CACHE_WORDS, CACHE_BYTES = 280_000, 64
#: Documents whose links a task holds as numbers at a time.
SCORED_ROWS = 256
#: Beyond these characters the two implementations of the first tokenizer may have other character tables. Finds one beyond.
_DISPUTED = re.compile("[^\x00-\x1b\x20-\u052f\u2000-\u206f]")
#: How byte-level tokenizers split a text. A fixed value.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space beyond ASCII in UTF-8, as any version of the character tables has it, and all else from U+2000 on.
_WIDE = [rb"\xc2[\x85\xa0]", rb"\xe1\x9a\x80", rb"\xe1\xa0\x8e", rb"\xe2\x80.", rb"\xe2\x81\x9f", rb"\xe3\x80\x80"]
#: A space that both tokenizers start a token at whatever surrounds the characters next to it.
SAFE = re.compile(
    rb"\x20(?=[\x21-\x7e\x80-\xff])(?!" + b"|".join(_WIDE) + rb")(?<![\x00-\x20\x7f]\x20)" + b"".join(rb"(?<!" + w + rb"\x20)" for w in _WIDE),
    re.DOTALL,
)


#: The character that the second tokenizer writes a space as, and what follows a token in the text of groups: another of its
#: group, the other tokenizer's, the next group, or nothing at the end of a part.
_MARK, _BETWEEN = "▁".encode(), (",", "|", ";", "")


class Closed(NamedTuple):
    """What lies between two safe spaces: its groups as text, numbers of tokens and links, and the linked pairs."""

    groups: str
    n_a: int
    n_b: int
    n_links: int
    links: bytes


class Fragment(NamedTuple):
    """A byte range. Without a common end (``cut`` false) all tokens are in the head. Ids are joined by commas."""

    valid: bool
    cut: bool
    head_a: str
    head_b: str
    body: str
    tail_a: str
    tail_b: str
    n_a: int
    n_b: int
    n_links: int
    links: bytes


_FRAGMENT = (
    "valid boolean, cut boolean, head_a string, head_b string, body string, tail_a string, tail_b string, "
    "n_a bigint, n_b bigint, n_links bigint, links binary"
)
#: The fragment of nothing.
EMPTY = Fragment(True, False, "", "", "", "", "", 0, 0, 0, b"")


def _joined(left: str, right: str, by: str = ",") -> str:
    return f"{left}{by}{right}" if left and right else left or right


def combine(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two ranges, one after the other."""
    sums = [left.n_a + right.n_a, left.n_b + right.n_b, left.n_links + right.n_links, left.links + right.links]
    valid = left.valid and right.valid
    if not left.cut:
        head = _joined(left.head_a, right.head_a), _joined(left.head_b, right.head_b)
        return Fragment(valid, right.cut, *head, right.body, right.tail_a, right.tail_b, *sums)
    tail = _joined(left.tail_a, right.head_a), _joined(left.tail_b, right.head_b)
    if not right.cut:
        return Fragment(valid, True, left.head_a, left.head_b, left.body, *tail, *sums)
    body = _joined(_joined(left.body, "|".join(tail), ";"), right.body, ";")
    return Fragment(valid, True, left.head_a, left.head_b, body, right.tail_a, right.tail_b, *sums)


class Pair:
    """Both tokenizers on one worker."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer, decoders

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.quick = _by_ranks(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.size_a, self.size_b = self.a.get_vocab_size(), self.b.get_piece_size()
        self.kind = "<u4" if self.size_a * self.size_b < 2**32 else "<u8"
        alphabet = _byte_alphabet()
        self.bytes_a = [_decoded(self.a.id_to_token(n) or "", alphabet) for n in range(self.size_a)]
        pieces = [self.b.id_to_piece(n) for n in range(self.size_b)]
        if any("▁" in p.lstrip("▁") for p in pieces) or not isinstance(self.a.decoder, decoders.ByteLevel):
            raise ValueError(f"{path_a}, {path_b}: tokens of these may go on across a space")
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)
        ]
        self.lengths_a, self.lengths_b = (np.array([len(r) for r in raw]) for raw in (self.bytes_a, self.bytes_b))
        #: An id in text, with each of what may follow it.
        self.written = [[f"{n}{follows}" for n in range(max(self.size_a, self.size_b))] for follows in _BETWEEN]
        self.known: dict[bytes, tuple | None] = {}
        self.older: dict[bytes, tuple | None] = {}

    def tokens(self, parts: Sequence[bytes]) -> list[tuple[list[int], list[int], list[int], list[int]] | None]:
        """Ids and ends of either tokenizer for each part, which starts with the space that is added or was there; None
        where the tokens do not give the bytes back."""
        texts = [p.decode("utf-8", "surrogatepass") for p in parts]
        out = []
        encoded_a = self.a.encode_batch(texts, add_special_tokens=False)
        for part, a, b in zip(parts, encoded_a, self.b.encode([t[1:] for t in texts], num_threads=1)):
            raw_a, raw_b = [self.bytes_a[n] for n in a.ids], [self.bytes_b[n] for n in b]
            same = b"".join(raw_a) == part == b"".join(raw_b)
            out.append((a.ids, _ends(raw_a), b, _ends(raw_b)) if same else None)
        return out

    def closed(self, parts: Sequence[bytes]) -> list[tuple | None]:
        """The fields of ``Closed`` for each part; None where it has no tokens."""
        known, older = self.known, self.older
        found = [known.get(p, False) for p in parts]
        if False not in found:
            return found
        new = dict.fromkeys(p for p, f in zip(parts, found) if f is False)
        made = {p: older[p] for p in new if p in older}
        made |= self._close([p for p in new if p not in made])
        if len(known) + len(made) > CACHE_WORDS:
            self.older, self.known = known, {}
        self.known.update((p, c) for p, c in made.items() if len(p) <= CACHE_BYTES)
        return [made[p] if f is False else f for p, f in zip(parts, found)]

    def _close(self, parts: Sequence[bytes]) -> dict[bytes, tuple | None]:
        """New parts, tokenized as one text if that text is cut into just these parts; else each by itself."""
        made: dict[bytes, tuple | None] = dict.fromkeys(parts)
        plain = [p for p in parts if _MARK not in p]  # which the second tokenizer takes for a space
        joined = b"".join(plain)
        found = self._aligned(plain, joined) if len(plain) > 1 and parts_of(joined) == plain else None
        for at, part in enumerate(plain):
            made[part] = found[at] if found else (self._aligned([part], part) or [None])[0]
        return made

    def _aligned(self, parts: Sequence[bytes], raw: bytes) -> list[tuple] | None:
        """The parts of one text; None where the tokens do not give its bytes back or go on across the end of a part."""
        text = raw.decode("utf-8", "surrogatepass")
        if self.quick and not _DISPUTED.search(text):
            a = self.quick.encode_ordinary(text)
        else:
            a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:])
        if not b"".join(map(self.bytes_a.__getitem__, a)) == raw == b"".join(map(self.bytes_b.__getitem__, b)):
            return None
        ids = np.array(a, np.int64), np.array(b, np.int64)
        ends = np.cumsum(self.lengths_a[ids[0]]), np.cumsum(self.lengths_b[ids[1]])
        common, part_ends = np.intersect1d(*ends, assume_unique=True), np.cumsum([len(p) for p in parts])
        last_groups = np.searchsorted(common, part_ends)
        if not np.array_equal(common[np.minimum(last_groups, len(common) - 1)], part_ends):
            return None
        # All tokens by group, first tokenizer first; what follows each; and which part it is in.
        group = np.concatenate([2 * np.searchsorted(common, ends[0]), 2 * np.searchsorted(common, ends[1]) + 1])
        order = np.argsort(group, kind="stable")
        group = group[order]
        closes = np.zeros(len(common), np.int64)
        closes[last_groups] = 1
        follows = np.where(np.append(group[1:] == group[:-1], False), 0, np.where(group % 2 == 0, 1, 2 + closes[group // 2]))
        table = self.written
        written = [table[f][n] for n, f in zip(np.concatenate(ids)[order].tolist(), follows.tolist())]
        cuts = [np.searchsorted(e, part_ends, "right") for e in (*ends, common)]
        pairs = ids[0][np.searchsorted(ends[0], common)] * self.size_b + ids[1][np.searchsorted(ends[1], common)]
        links, width = pairs.astype(self.kind).tobytes(), np.dtype(self.kind).itemsize
        out, before = [], (0, 0, 0)
        for now in zip(*(c.tolist() for c in cuts)):
            groups = "".join(written[before[0] + before[1] : now[0] + now[1]])
            counts = [y - x for x, y in zip(before, now)]
            # A plain tuple of strings and numbers, which the garbage collector need not visit among very many.
            out.append((groups, *counts, links[width * before[2] : width * now[2]]))
            before = now
        return out

    def _groups(self, a, ends_a, b, ends_b, common) -> tuple[list[tuple[str, str]], list[int]]:
        """The tokens up to each common end, and the pair that ends there."""
        groups, links, at_a, at_b = [], [], 0, 0
        for end in common:
            to_a, to_b = bisect_right(ends_a, end, at_a), bisect_right(ends_b, end, at_b)
            groups.append((",".join(map(str, a[at_a:to_a])), ",".join(map(str, b[at_b:to_b]))))
            links.append(a[to_a - 1] * self.size_b + b[to_b - 1])
            at_a, at_b = to_a, to_b
        return groups, links

    def partly(self, part: bytes, start: int, end: int) -> Fragment:
        """The tokens of ``part`` that end after ``start`` and not after ``end``."""
        found = self.tokens([part])[0]
        if found is None:
            return EMPTY._replace(valid=False)
        a, ends_a, b, ends_b = found
        in_a, in_b = (slice(bisect_right(e, start), bisect_right(e, end)) for e in (ends_a, ends_b))
        a, ends_a, b, ends_b = a[in_a], ends_a[in_a], b[in_b], ends_b[in_b]
        groups, links = self._groups(a, ends_a, b, ends_b, sorted(set(ends_a) & set(ends_b)))
        counts = len(a), len(b), len(links), np.array(links, self.kind).tobytes()
        if not groups:
            return Fragment(True, False, ",".join(map(str, a)), ",".join(map(str, b)), "", "", "", *counts)
        used_a, used_b = (sum(g[n].count(",") + 1 for g in groups) for n in (0, 1))
        body = ";".join(f"{x}|{y}" for x, y in groups[1:])
        return Fragment(True, True, *groups[0], body, ",".join(map(str, a[used_a:])), ",".join(map(str, b[used_b:])), *counts)

    def whole(self, raw: bytes) -> Closed | None:
        """A whole text, without its added space; None if it has no tokens."""
        found = self.closed(parts_of(b" " + raw)) if raw else [None]
        return None if None in found else _run(found)

    def fragment(self, window: bytes, start: int, end: int) -> Fragment:
        """The range from ``start`` to ``end`` of a window that begins and ends at safe spaces or a text's ends."""
        parts, places, at = parts_of(window), [], 0
        for part in parts:
            places.append((at, at + len(part)))
            at += len(part)
        first = bisect_left([p[0] for p in places], start)  # the first part that begins in the range
        last = bisect_right([p[1] for p in places], end)  # behind the last that ends in it
        if first > last:  # the range lies within one part
            return self.partly(parts[last], start - places[last][0], end - places[last][0])
        out = EMPTY
        if first and places[first - 1][1] > start:
            out = self.partly(parts[first - 1], start - places[first - 1][0], end - places[first - 1][0])
        if within := self.closed(parts[first:last]):
            if None in within:
                return EMPTY._replace(valid=False)
            run = _run(within)
            group, _, body = run.groups.partition(";")
            out = combine(out, Fragment(True, True, *group.split("|"), body, "", "", *run[1:]))
        if last < len(parts) and places[last][0] < end and last >= first:
            out = combine(out, self.partly(parts[last], 0, end - places[last][0]))
        return out


def parts_of(raw: bytes) -> list[bytes]:
    """A text that starts with a space, cut ahead of each safe space."""
    first, *others = SAFE.split(raw)
    return ([first] if first else []) + [b" " + p for p in others]


def _run(parts: Sequence[tuple]) -> Closed:
    groups, n_a, n_b, n_links, links = zip(*parts)
    return Closed(";".join(groups), sum(n_a), sum(n_b), sum(n_links), b"".join(links))


def _ends(raw: Sequence[bytes]) -> list[int]:
    return list(accumulate(map(len, raw)))


def _by_ranks(path: str):
    """The same tokenizer in the library that merges by rank, several times faster; None if its merges are not in the order
    of the ids they make, or it splits texts in another way."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocabulary, merges, split = spec["model"]["vocab"], spec["model"]["merges"], spec["pre_tokenizer"] or {}
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
    plain = spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    if not plain or made != sorted(made) or any(n >= made[0] for t, n in vocabulary.items() if len(t) == 1):
        return None
    alphabet = _byte_alphabet()
    return tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks={_decoded(t, alphabet): n for t, n in vocabulary.items()}, special_tokens={})


def _byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level tokenizers write bytes: printable ones as they are, the others from U+0100 on."""
    plain = [n for n in range(256) if 33 <= n <= 126 or 161 <= n <= 172 or n >= 174]
    others = [n for n in range(256) if n not in plain]
    return {chr(n): n for n in plain} | {chr(256 + at): n for at, n in enumerate(others)}


def _decoded(token: str, alphabet: dict[str, int]) -> bytes:
    return bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()


@cache
def pair(path_a: str, path_b: str) -> Pair:
    """One pair of tokenizers per worker and pair of files, with what it remembers."""
    return Pair(path_a, path_b)


def ranges(raw: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """Ranges of about ``size`` bytes: start, end, and where their windows start and end.

    A window reaches to the safe spaces around its range. An end with none within ``size`` bytes on both sides is no end:
    the ranges there are one, so that windows never overlap by more than they hold.
    """
    ends, before, after = [0], [0], [0]
    for end in range(size, len(raw), size):
        left = [m.start() for m in SAFE.finditer(raw, max(1, end - size), end + 1)][-1:]
        right = SAFE.search(raw, end, end + size)
        if left and right and left[0] > before[-1]:
            ends.append(end)
            before.append(left[0])
            after.append(right.start())
    return list(zip(ends, [*ends[1:], len(raw)], before, [*after[1:], len(raw)]))


def align(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_a, n_b (tokens of either), n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is a pair of tokens that end together; its count is how often the corpus links the two ids; ``n_best`` counts
    links whose count is the highest of their second id. Null and empty texts, and those that either tokenizer does not
    give back byte for byte, have no tokens: zeros and an empty string. Very long texts are cut and put together again,
    repeated rows count each, an empty table gives no rows; other columns of the input are not looked at. Both files must
    lie at their paths on every machine.
    """
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("t"))
    long = F.octet_length("t") > RANGE
    encoded = _short(docs.filter(F.coalesce(~long, F.lit(True))), path_a, path_b).unionByName(_long(docs.filter(long), path_a, path_b))
    encoded = with_row_id(encoded, "_row")
    both = pair(path_a, path_b)
    scored = _scored(encoded, _counts(encoded, both.kind, both.size_b), both.kind)
    return scored.select(F.col("id").alias(key), "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256")


def _encoded_schema(docs: DataFrame) -> str:
    return f"id {docs.schema['id'].dataType.simpleString()}, n_a bigint, n_b bigint, n_links bigint, groups_sha256 string, links binary"


def _digest(groups: str) -> str:
    return hashlib.sha256(groups.encode()).hexdigest()


def _short(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    def make():
        both = pair(path_a, path_b)

        def run(batch):
            out = {k: [] for k in ("id", "n_a", "n_b", "n_links", "groups_sha256", "links")}
            for doc, body in zip(batch["id"], batch["t"]):
                found = both.whole(body.encode("utf-8", "surrogatepass")) if body else None
                row = (doc, *found[1:4], _digest(found.groups), found.links) if found else (doc, 0, 0, 0, "", b"")
                for name, value in zip(out, row):
                    out[name].append(value)
            return out

        return run

    return per_batch(docs, ["id", "t"], make, _encoded_schema(docs))


def _long(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Ranges dealt to tasks, their fragments combined in a tree. A document's groups are hashed where they come together:
    that task holds the fragments of one document, about three times its bytes."""

    def cut():
        def run(batch):
            out = {k: [] for k in ("id", "doc", "at", "window", "from", "to")}
            for doc, number, body in zip(batch["id"], batch["doc"], batch["t"]):
                raw = b" " + body.encode("utf-8", "surrogatepass")
                for at, (start, end, first, last) in enumerate(ranges(raw, RANGE)):
                    for name, value in zip(out, (doc, number, at, raw[first:last], start - first, end - first)):
                        out[name].append(value)
            return out

        return run

    kind = docs.schema["id"].dataType.simpleString()
    windows = materialized(per_batch(
        docs, ["id", F.monotonically_increasing_id().alias("doc"), "t"], cut, f"id {kind}, doc bigint, at bigint, window binary, from bigint, to bigint"
    ))
    ids = windows.filter("at = 0").select("doc", "id")

    def encode():
        both = pair(path_a, path_b)

        def run(batch):
            made = [both.fragment(*row) for row in zip(batch["window"], batch["from"], batch["to"])]
            columns = dict(zip(Fragment._fields, map(list, zip(*made)))) if made else {k: [] for k in Fragment._fields}
            return {"doc": batch["doc"], "at": batch["at"], **columns}

        return run

    # As many partitions as shuffles have; ranges are dealt out singly, so a long document's go to many tasks.
    dealt = windows.repartition(F.col("doc"), F.col("at")).select("doc", "at", "window", "from", "to")
    fragments = per_batch(dealt, dealt.columns, encode, f"doc bigint, at bigint, {_FRAGMENT}")
    most = windows.agg(F.max("at")).first()[0] or 0
    while most:
        fragments, most = _combined(fragments), most // FAN
    found = fragments.withColumn("groups", F.concat_ws(
        ";", F.concat("head_a", F.lit("|"), "head_b"), F.when(F.col("body") != "", F.col("body"))
    ))
    # Fragments of whole documents: the end of a text is a common end, so nothing is left open.
    zero = lambda c: F.when(F.col("valid"), F.col(c)).otherwise(0).alias(c)
    return found.join(ids, "doc").select(
        "id", zero("n_a"), zero("n_b"), zero("n_links"), F.when(F.col("valid"), F.sha2("groups", 256)).otherwise("").alias("groups_sha256"),
        F.when(F.col("valid"), F.col("links")).otherwise(F.lit(b"")).alias("links"),
    )


def _combined(fragments: DataFrame) -> DataFrame:
    """Each run of ``FAN`` fragments of a document as one."""
    schema = T.StructType.fromDDL(f"doc bigint, at bigint, {_FRAGMENT}")

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["at"])
        made = reduce(combine, (Fragment(*(r[k] for k in Fragment._fields)) for r in rows))
        row = {"doc": rows[0]["doc"], "at": rows[0]["at"] // FAN, **made._asdict()}
        return pa.Table.from_pylist([row], schema=group.schema)

    return fragments.groupBy("doc", F.floor(F.col("at") / FAN)).applyInArrow(run, schema)


def _counts(encoded: DataFrame, kind: str, size_b: int) -> DataFrame:
    """Linked pairs: pair, n (links of it), best (whether no other first id has more links with its second), written once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            found, many = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(many.astype(np.int64))], names=["pair", "n"])

    counts = encoded.select("links").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialized(counts.withColumn("b", F.col("pair") % size_b))
    highest = counts.groupBy("b").agg(F.max("n").alias("most"))
    joined = counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    return materialized(joined)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SCORED_ROWS):
            yield batch.slice(at, SCORED_ROWS)


def _scored(encoded: DataFrame, counts: DataFrame, kind: str) -> DataFrame:
    """``encoded`` with n_best and count_sum."""
    # At most FREQUENT pairs reach the driver and the tasks.
    frequent = counts.orderBy(F.col("n").desc(), "pair").limit(FREQUENT).toArrow()
    order = np.argsort(frequent["pair"].to_numpy())
    table = tuple(frequent[c].to_numpy()[order] for c in ("pair", "n", "best"))
    sent = encoded.sparkSession.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, many, best = sent.value
        for batch in _sliced(batches):
            links = [np.frombuffer(raw, kind).astype(np.int64) for raw in batch.column(1).to_pylist()]
            flat = np.concatenate([*links, np.empty(0, np.int64)])
            row = np.repeat(np.arange(len(links)), [len(k) for k in links])
            at = np.minimum(np.searchsorted(pairs, flat), max(0, len(pairs) - 1))
            hit = pairs[at] == flat if len(pairs) else np.zeros(len(flat), bool)
            n_best = np.bincount(row[hit], best[at[hit]], len(links)).astype(np.int64)
            total = np.zeros(len(links), np.int64)
            np.add.at(total, row[hit], many[at[hit]])
            cuts = np.cumsum(np.bincount(row[~hit], minlength=len(links)))[:-1]
            missed = [m.tolist() for m in np.split(flat[~hit], cuts)] if len(links) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_best), pa.array(total), pa.array(missed, pa.list_(pa.int64()))], names=["_row", "n_best", "count_sum", "missed"]
            )

    other = [c for c in encoded.columns if c != "links"]
    if counts.count() <= FREQUENT:
        return _with_scores(encoded, score, other)
    scores = materialized(encoded.select("_row", "links").mapInArrow(score, "_row bigint, n_best bigint, count_sum bigint, missed array<bigint>"))
    # Rare pairs only: none of them is a hot key.
    rare = (
        scores.select("_row", F.explode("missed").alias("pair")).join(counts, "pair")
        .groupBy("_row").agg(F.sum(F.col("best").cast("bigint")).alias("more_best"), F.sum("n").alias("more"))
    )
    summed = scores.drop("missed").join(rare, "_row", "left").select(
        "_row", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum")
    )
    return encoded.select(*other).join(summed, "_row")


def _with_scores(encoded: DataFrame, score, other: list[str]) -> DataFrame:
    """The same without a join: every pair is in the table that was sent, so nothing is missed."""
    schema = T.StructType([*(encoded.schema[c] for c in other), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            own = batch.select(["_row", "links"])
            for made in score(iter([own])):
                columns = [batch.column(c) for c in other] + [made.column("n_best"), made.column("count_sum")]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return encoded.mapInArrow(run, schema)
