"""Mixing overlapping sources to target weights.

Documents are added up by membership pattern: the set of sources that hold them. A
min-cost flow sends the patterns' words to the sources' quotas; taking a pattern a
k-th time costs k, so words are repeated only when no word is left to take less
often, and a pattern in several sources goes where it is needed. Seeded hashes then
choose the documents: those with the least hashes are taken once more, and the one
on the border in part or to the nearest whole.

Sizes are words (runs of other than ASCII white space); a null text has none. A null
source is a source of its own, after all others. Repeated rows are documents of their
own. A table without words has quotas of 0. The patterns go through the driver; there
may be ``MAX_PATTERNS`` of them, and more raise an error.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import write_table
from .common import WORD, whole_text

MAX_PATTERNS = 20_000
#: Leading bits that divide a pattern's hash range into parts; only the part on the border is ever sorted.
PART_BITS = 12
HASH_BITS = 60

Pattern = tuple[str | None, ...]


def source_targets(sizes: dict[str | None, int], weights: Sequence[int], total_percent: int, most_times: int) -> dict[str | None, Fraction]:
    """Targets of the sources, in the order of their names, null last.

    The total is shared by weight; a source stops at ``most_times`` its size, and
    the excess is shared by weight among the others until none is above.
    """
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_names = Fraction(total_percent * sum(sizes.values()), 100), list(names)
    targets: dict[str | None, Fraction] = {}
    while open_names:
        share = left / sum(weight[s] for s in open_names)
        full = [s for s in open_names if share * weight[s] > most_times * sizes[s]]
        if not full:
            return targets | {s: share * weight[s] for s in open_names}
        for s in full:
            targets[s] = Fraction(most_times * sizes[s])
            left -= targets[s]
        open_names = [s for s in open_names if s not in targets]
    return targets


def route(capacity: dict[Pattern, int], quota: dict[str | None, int], most_times: int) -> dict[tuple[Pattern, str | None], int]:
    """Words that each pattern gives to each of its sources, at least cost.

    The cost of a path lies on its first arc alone: k for the k-th time a pattern is
    taken. So shortest paths come in rounds: round k opens each pattern's k-th
    capacity and augments until no path is left.
    """
    flow: dict[tuple[Pattern, str | None], int] = {}
    holders: dict[str | None, set[Pattern]] = {s: set() for s in quota}  # patterns that give to a source
    need = dict(quota)
    for _ in range(most_times):
        free = dict(capacity)
        for pattern in capacity:
            while free[pattern] and (path := _path(pattern, need, holders)):
                sent = min(free[pattern], need[path[-1][1]], *(flow[back] for back in path[1::2]))
                for i, arc in enumerate(path):
                    flow[arc] = flow.get(arc, 0) + (sent if i % 2 == 0 else -sent)
                    (holders[arc[1]].add if flow[arc] else holders[arc[1]].discard)(arc[0])
                free[pattern] -= sent
                need[path[-1][1]] -= sent
    return {arc: words for arc, words in flow.items() if words}


def _path(start: Pattern, need: dict, holders: dict) -> list[tuple[Pattern, str | None]] | None:
    """A shortest path to a source in need: arcs forward, back, forward, ..."""
    came: dict = {}
    waiting = deque([start])
    seen = {start}
    while waiting:
        pattern = waiting.popleft()
        for source in pattern:
            if source in came:
                continue
            came[source] = pattern
            if need[source]:
                path = [(pattern, source)]
                while pattern != start:
                    path += [(pattern, came[pattern, "by"]), (came[came[pattern, "by"]], came[pattern, "by"])]
                    pattern = path[-1][0]
                return path[::-1]
            for other in sorted(holders[source], key=repr):
                if other not in seen:
                    seen.add(other)
                    came[other, "by"] = source
                    waiting.append(other)
    return None


def seeded_hash(identity: Column, seed: int) -> Column:
    """60 bits of the MD5 of seed and identity, as a number."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), identity).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def mix(
    documents: DataFrame,
    members: Column,
    weights: Sequence[int] = (1,),
    total_percent: int = 100,
    most_times: int = 2,
    seed: int = 17,
    identity: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """identity, ``keep``, size, sources (source, size, target of each member), taken
    and copies, one row for each row of ``documents``.

    ``members`` is the array of sources that hold a row, ``weights`` go to sources in
    the order of their names and repeat. ``taken`` counts words with repeats, the last
    document in part; ``copies`` takes whole documents only, that one if its part is
    half of it or more.
    """
    rows = write_table(
        documents.select(
            F.col(identity).alias("id"),
            *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
            F.array_sort(F.array_distinct(members)).alias("members"),
            F.regexp_count(whole_text(text), F.lit(WORD)).cast("bigint").alias("size"),
            # With the text, so that rows without an id, or of one id, are spread.
            seeded_hash(F.concat_ws(":", F.coalesce(F.col(identity).cast("string"), F.lit("")), F.md5(whole_text(text).cast("binary"))), seed).alias("hash"),
        ),
        "mix-sizes",
    )
    sums = rows.groupBy("members").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"there are over {MAX_PATTERNS} patterns of sources")
    capacity = {tuple(row["members"]): row["size"] for row in sums}
    sizes: dict[str | None, int] = {}
    for pattern, size in capacity.items():
        for source in pattern:
            sizes[source] = sizes.get(source, 0) + size
    order = lambda pattern: [(s is None, s or "") for s in pattern]
    capacity = {pattern: capacity[pattern] for pattern in sorted(capacity, key=order)}
    targets = source_targets(sizes, weights, total_percent, most_times)
    # Words of one pattern count in each of its sources' sizes, so quotas may be out of
    # reach there; the flow then comes as near as it can.
    flows = route(capacity, {s: int(t) for s, t in targets.items()}, most_times)
    spark = documents.sparkSession
    plan = []
    for number, (pattern, size) in enumerate(capacity.items()):
        sent = sum(flows.get((pattern, s), 0) for s in pattern)
        times, extra = divmod(sent, size) if size else (0, 0)
        plan.append((number, list(pattern), [(s, sizes[s], float(targets[s])) for s in pattern], times, extra))
    patterns = spark.createDataFrame(
        plan, "pattern int, members array<string>, sources array<struct<source: string, size: bigint, target: double>>, times bigint, extra bigint"
    )
    # At most MAX_PATTERNS rows of the plan above.
    placed = rows.withColumn("part", F.shiftright("hash", HASH_BITS - PART_BITS).cast("int")).join(F.broadcast(patterns), "members")
    parts = placed.groupBy("pattern", "part").agg(F.sum("size").alias("words"), F.first("extra").alias("extra"))
    up_to = Window.partitionBy("pattern").orderBy("part")
    border = (
        parts.withColumn("after", F.sum("words").over(up_to))
        .filter((F.col("after") > F.col("extra")) & (F.col("after") - F.col("words") <= F.col("extra")) & (F.col("words") > 0))
        .select("pattern", F.col("part").alias("border"), (F.col("extra") - (F.col("after") - F.col("words"))).alias("room"))
    )
    # One row for each pattern at most.
    placed = placed.join(F.broadcast(border), "pattern", "left")
    inside = placed.filter("part = border")
    in_order = Window.partitionBy("pattern").orderBy("hash", "size", *[f"k{i}" for i in range(len(keep))])
    inside = inside.withColumn("before", F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, -1)))
    inside = inside.withColumn("more", F.greatest(F.lit(0), F.least("size", F.col("room") - F.coalesce("before", F.lit(0)))))
    # With nothing extra to take, or all of it, there is no border.
    outside = placed.filter("border IS NULL OR part <> border").withColumn(
        "more", F.when(F.col("part") < F.col("border"), F.col("size")).otherwise(0)
    )
    taken = inside.drop("before").unionByName(outside)
    return taken.select(
        F.col("id").alias(identity),
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        "size",
        "sources",
        (F.col("times") * F.col("size") + F.col("more")).alias("taken"),
        (F.col("times") + ((F.col("more") * 2 >= F.col("size")) & (F.col("more") > 0)).cast("bigint")).alias("copies"),
    )

