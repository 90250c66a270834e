"""Connected components of links, by contraction.

In every round each node takes the least number among itself and its neighbours, and
links are carried over to those numbers. A node with very many neighbours is one row
in the minimum, and joins are between written tables, so that hot keys can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import write_table


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node of its component, for all nodes of ``links`` (a, b)."""
    links = _distinct(links)
    steps: list[DataFrame] = []
    while not steps or not links.isEmpty():
        ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
        least = ends.groupBy("node").agg(F.min("other").alias("other"))
        step = write_table(least.select("node", F.least("node", "other").alias("label")), "component-step")
        steps.append(step)
        of_a = step.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
        of_b = step.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
        links = _distinct(
            links.join(of_a, "a").join(of_b, "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
        )
    labels = steps[0]
    for step in steps[1:]:
        further = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = labels.join(further, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return write_table(labels, "components") if len(steps) > 1 else labels


def _distinct(links: DataFrame) -> DataFrame:
    ordered = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return write_table(ordered.distinct(), "component-links")
