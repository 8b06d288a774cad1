"""Token counts by two tiers of piece lengths, on the map side alone.

The first tier is a table of the frequent pieces and their numbers of tokens, broadcast to every worker; its size is
bounded. The second is a cache of its own that each worker fills with the pieces it meets besides. Pieces are never
shuffled, and counting a text touches no other. The table only saves time: any sample gives the same counts.
"""

from __future__ import annotations

from collections import Counter as Tally

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import per_batch
from subledger.llm.pretokens import Counter, Pieces

#: Documents whose pieces are tallied for the broadcast table, and characters read of each: together they bound what
#: reaches the driver.
SAMPLE_DOCUMENTS, SAMPLE_CHARS = 1000, 20_000
#: Entries of the broadcast table.
FREQUENT = 32_768
#: Longer pieces are left to the second tier, so that the table's bytes are bounded too.
LONGEST = 32


def frequent_pieces(df: DataFrame, path: str, text: str = "text") -> dict[str, int]:
    """The most frequent pieces of a few documents with their numbers of tokens."""
    pieces, tally = Pieces(path), Tally()
    for row in df.select(F.substring(text, 1, SAMPLE_CHARS).alias("t")).filter("t is not null").take(SAMPLE_DOCUMENTS):
        for part in pieces.parts(row.t):
            if not isinstance(part, str):
                tally.update(p for p in part if len(p) <= LONGEST)
    return {p: len(pieces.ids(p)) for p, _ in tally.most_common(FREQUENT)}


def count_tokens(df: DataFrame, path: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, UTF-8 bytes, tokens, and whether they exceed ``limit``.

    A null or empty text has 0 of both. Special strings inside a text count as one token each, as the tokenizer's library
    has it by default. Long texts are read whole, repeated rows counted each, an empty table gives no rows; other columns
    of the input are not looked at. ``path`` must lead to the tokenizer's file on every machine.
    """
    table = df.sparkSession.sparkContext.broadcast(frequent_pieces(df, path, text))

    def make():
        counter = Counter(path, table.value)

        def run(batch):
            return {
                "id": batch["id"],
                "n_bytes": [len((t or "").encode("utf-8", "surrogatepass")) for t in batch["t"]],
                "n_tokens": [counter.count(t) for t in batch["t"]],
            }

        return run

    kind = df.schema[key].dataType.simpleString()
    counted = per_batch(df, [df[key].alias("id"), df[text].alias("t")], make, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
