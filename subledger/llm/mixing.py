"""Mixing sources to target weights by a min-cost flow over membership patterns.

Documents with the same set of sources are alike to the mix, so their words are summed by that pattern. A flow then sends
words from patterns to the quotas of their sources. The first repetition of a pattern's words is free, each further one
costs more than the one before, so nothing is repeated while something unused would do. What a pattern sends is laid on
its documents in seeded order, and a repetition of a document goes where its middle falls. One document per pattern is
turned in or out at last, if that brings the words taken nearer to the flow.
"""

from __future__ import annotations

import heapq
from collections.abc import Hashable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.common import WORD, with_row_id
from subledger.session import materialized

#: Patterns the driver may plan for. A mix has few sources; more patterns than this mean that the column is not a source.
MOST_PATTERNS = 100_000
_ROW = "_mix_row"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD.pattern)), F.lit(0)).cast("bigint")


def capped_targets(sizes: Mapping[Hashable, int], weights: Mapping[Hashable, float], total: float, most: float) -> dict[Hashable, float]:
    """Shares of ``total`` by weight, none above ``most`` times its source's size; the excess is shared again by weight."""
    targets, open_, left = {}, set(sizes), float(total)
    while open_:
        weight = sum(weights[s] for s in sizes if s in open_)
        share = {s: left * weights[s] / weight for s in sizes if s in open_}
        above = [s for s in share if share[s] > most * sizes[s]]
        if not above:
            return targets | share
        for s in above:
            targets[s] = float(most * sizes[s])
            open_.remove(s)
        left = total - sum(targets.values())
    return targets


def cheapest_flow(sizes: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], most: int) -> list[dict[int, int]]:
    """Words each pattern sends to each of its sources.

    Repetition r of a pattern's words costs r each, so the marginal cost rises and the flow is a convex one. Shortest
    augmenting paths with potentials; a path fills a repetition, a quota or the way back over an earlier choice.
    """
    start, end = 0, 1
    edges: list[list[int]] = []  # to, capacity left, cost; the reverse edge is the neighbour by the lowest bit
    out: list[list[int]] = [[] for _ in range(2 + len(sizes) + len(quotas))]

    def edge(a: int, b: int, capacity: int, cost: int) -> int:
        for frm, to, room, price in ((a, b, capacity, cost), (b, a, 0, -cost)):
            out[frm].append(len(edges))
            edges.append([to, room, price])
        return len(edges) - 2

    arcs = []
    for p, (size, sources) in enumerate(zip(sizes, members)):
        for r in range(most):
            edge(start, 2 + p, size, r)
        arcs.append({s: edge(2 + p, 2 + len(sizes) + s, most * size, 0) for s in sources})
    for s, quota in enumerate(quotas):
        edge(2 + len(sizes) + s, end, quota, 0)
    potential = [0] * len(out)
    while True:
        cost: dict[int, int] = {start: 0}
        came: dict[int, int] = {}
        heap, done = [(0, start)], set()
        while heap:
            at, node = heapq.heappop(heap)
            if node in done:
                continue
            done.add(node)
            for e in out[node]:
                to, room, price = edges[e]
                if room and to not in done and (way := at + price + potential[node] - potential[to]) < cost.get(to, way + 1):
                    cost[to], came[to] = way, e
                    heapq.heappush(heap, (way, to))
        if end not in done:
            return [{s: edges[e ^ 1][1] for s, e in by.items() if edges[e ^ 1][1]} for by in arcs]
        farthest = max(cost[n] for n in done)
        potential = [v + cost.get(n, farthest) if n in done else v + farthest for n, v in enumerate(potential)]
        path, node = [], end
        while node != start:
            path.append(came[node])
            node = edges[came[node] ^ 1][0]
        amount = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= amount
            edges[e ^ 1][1] += amount


class Mix:
    """The plan for a table of rows with ``sources`` (array of strings) and ``size``, and what each row gives to it."""

    def __init__(self, rows: DataFrame, key: str, cycle: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 7) -> None:
        """``rows`` must come from ``with_row_id`` under ``_ROW``. Sources take the weights of ``cycle`` in turn, by code
        point, null last, and together ``share`` times all words; no row is used more than ``most`` times.
        """
        self.rows, self.key, self.most, self.seed = rows, key, most, seed
        found = rows.groupBy("sources").agg(F.sum("size").alias("size")).limit(MOST_PATTERNS + 1).collect()
        if len(found) > MOST_PATTERNS:
            raise ValueError(f"more than {MOST_PATTERNS} sets of sources")
        order = lambda s: (s is None, s or "")
        found.sort(key=lambda r: [order(s) for s in r.sources])
        self.patterns = [list(r.sources) for r in found]
        self.sizes = [int(r["size"]) for r in found]
        self.sources = sorted({s for p in self.patterns for s in p}, key=order)
        self.source_sizes = {s: sum(n for p, n in zip(self.patterns, self.sizes) if s in p) for s in self.sources}
        weights = {s: cycle[at % len(cycle)] for at, s in enumerate(self.sources)}
        self.targets = capped_targets(self.source_sizes, weights, share * sum(self.sizes), most)
        number = {s: at for at, s in enumerate(self.sources)}
        self.flows = cheapest_flow(
            self.sizes, [[number[s] for s in p] for p in self.patterns], [int(self.targets[s]) for s in self.sources], most
        )

    def arcs(self) -> DataFrame:
        """One row per pattern and source that it feeds: from which to which word of the pattern's repeated words."""
        rows = []
        for pattern, size, flow in zip(self.patterns, self.sizes, self.flows):
            at, last = 0, max(flow, default=None)
            for s in sorted(flow):
                rows.append((pattern, self.sources[s], size, at, at + flow[s], s == last))
                at += flow[s]
        schema = "sources array<string>, source string, pattern_size bigint, low bigint, high bigint, last boolean"
        return self.rows.sparkSession.createDataFrame(rows, schema)

    def positions(self) -> DataFrame:
        """Rows with the words of their pattern that precede them in seeded order.

        The order is cut into 4096 spans by hash; spans are summed first, so a task orders one span of a pattern only.
        Rows without a key are spread by their number.
        """
        own = F.coalesce(F.col(self.key).cast("string"), F.concat(F.lit("#"), F.col(_ROW)))
        rows = self.rows.select(_ROW, "sources", "size", F.xxhash64(F.lit(self.seed), own, F.col("size")).alias("_u"))
        rows = rows.withColumn("_span", F.shiftright("_u", 52))
        before = Window.partitionBy("sources").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
        spans = rows.groupBy("sources", "_span").agg(F.sum("size").alias("_n")).select(
            F.col("sources").alias("_p"), F.col("_span").alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
        )
        within = Window.partitionBy("sources", "_span").orderBy("_u", _ROW).rowsBetween(Window.unboundedPreceding, -1)
        return (
            rows.withColumn("_at", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .join(spans, F.col("sources").eqNullSafe(F.col("_p")) & (F.col("_span") == F.col("_s")))
            .withColumn("_at", F.col("_at") + F.col("_shift"))
            .drop("_p", "_s", "_shift", "_span")
        )

    def taken(self) -> DataFrame:
        """One row per row of the table and source that it feeds (at least one, with source null, if it feeds none): its
        number, ``source`` and ``times``, how often that source takes it."""
        middle = F.col("_at") + F.col("size") / 2

        def inside(repetition: int) -> Column:
            at = F.lit(repetition) * F.col("pattern_size") + middle
            return ((at >= F.col("low")) & (at < F.col("high"))).cast("int")

        times = sum((inside(r) for r in range(self.most)), F.lit(0))
        placed = materialized(
            self.positions().join(self.arcs(), "sources", "left").withColumn("times", F.coalesce(times, F.lit(0)))
        )
        # Turn one row of each pattern's last source in or out where that brings the sum nearer.
        missing = placed.filter("last").groupBy("sources").agg(
            F.sum(F.col("times") * F.col("size")).alias("_got"), F.max(F.col("high") - F.col("low")).alias("_due")
        )
        missing = missing.select("sources", (F.col("_due") - F.col("_got")).alias("_gap"))
        step = F.when(F.col("_gap") > 0, F.col("size")).otherwise(-F.col("size"))
        # A row may come in once more if its own words still have a repetition to give beyond all that the pattern sends.
        spare = F.lit((self.most - 1)) * F.col("pattern_size") + middle >= F.col("high")
        movable = F.when(F.col("_gap") > 0, spare).otherwise(F.col("times") > 0)
        better = F.abs(F.col("_gap") - step) < F.abs(F.col("_gap"))
        turned = (
            placed.filter("last").join(missing, "sources").filter(movable & better)
            .groupBy("sources")
            .agg(F.min(F.struct(F.abs(F.col("_gap") - step).alias("far"), "_u", _ROW, F.signum("_gap").cast("int").alias("by"))).alias("_t"))
            .select(F.col(f"_t.{_ROW}").alias("_turned"), F.col("_t.by").alias("_by"))
        )
        turns = placed.join(turned, (F.col(_ROW) == F.col("_turned")) & F.col("last"), "left")
        return turns.select(_ROW, "source", (F.col("times") + F.coalesce("_by", F.lit(0))).alias("times"))


def _numbered(df: DataFrame, columns: Sequence[Column], source: str, text: str) -> DataFrame:
    sources = F.array_sort(F.array_distinct(F.col(source))) if df.schema[source].dataType.simpleString().startswith("array") else F.array(F.col(source))
    return with_row_id(df.select(*columns, sources.alias("_mix_sources"), word_count(F.col(text)).alias("_mix_size")), _ROW)


def _plan(rows: DataFrame, key: str, **options) -> Mix:
    light = rows.select(_ROW, F.col(key).alias("_mix_key"), F.col("_mix_sources").alias("sources"), F.col("_mix_size").alias("size"))
    return Mix(light, "_mix_key", **options)


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """Per document and source that takes it: key, source, size, source_size, target, and the words taken.

    ``source`` holds a name or an array of names; null is a source of its own, an empty array none. A null text has size
    0 and is never taken. Documents that no source takes have one row, with 0 words, under a source of theirs. Repeated
    rows are taken each on its own, and an empty table gives no rows. Other columns of the input are not looked at.
    """
    rows = _numbered(df, [F.col(key).alias("_mix_key")], source, text)
    plan = _plan(rows, "_mix_key", **options)
    facts = df.sparkSession.createDataFrame(
        [(s, plan.source_sizes[s], plan.targets[s]) for s in plan.sources], "_s string, source_size bigint, target double"
    )
    took = rows.join(plan.taken().withColumnRenamed("source", "_fed"), _ROW)
    own = F.coalesce("_fed", F.try_element_at("_mix_sources", F.lit(1)))
    return (
        took.withColumn("source", own)
        .join(facts, F.col("source").eqNullSafe(F.col("_s")), "left")
        .select(
            F.col("_mix_key").alias(key), "source", F.col("_mix_size").alias("size"), "source_size", "target",
            (F.col("times") * F.col("_mix_size")).cast("bigint").alias("taken"),
        )
    )


def mixed_documents(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The documents of the mix, all their columns unchanged, each as often as it is taken. Documents without words, which
    no quota counts, stay once; a null source is one. Repeated rows are documents of their own, an empty table stays empty;
    columns may have any name but ``_mix_row``, ``_mix_size``, ``_mix_times`` and ``_mix_copy``.
    """
    rows = _numbered(df, df.columns, source, text)
    times = _plan(rows, key, **options).taken().groupBy(_ROW).agg(F.sum("times").alias("_mix_times"))
    copies = F.when(F.col("_mix_size") == 0, 1).otherwise(F.col("_mix_times")).cast("int")
    took = rows.join(times, _ROW).filter(copies > 0)
    return took.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), copies))).select(*df.columns)
