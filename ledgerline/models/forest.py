"""Scoring with an averaged classification forest given as a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Node:
    """A node holds the test that leads into it from its parent; a root has neither parent nor test."""

    tree: int
    node: int
    parent: int | None
    feature: str | None
    op: str | None
    threshold: float | None
    class_counts: tuple[float, ...]


def read_nodes(table: DataFrame) -> list[Node]:
    """Nodes of a forest table; its size is that of the model, not of the data."""
    columns = ["tree", "node", "parent", "feature", "op", "threshold", "class_counts"]
    return [Node(*row[:6], tuple(row[6])) for row in table.select(columns).toLocalIterator()]


def _holds(node: Node) -> Column:
    value = F.col(node.feature)
    if node.op == "lessOrEqual":
        return value <= node.threshold
    if node.op == "greaterThan":
        return value > node.threshold
    raise ValueError(f"unknown operator {node.op!r}")


def tree_distribution(nodes: Sequence[Node]) -> Column:
    """Class distribution at the leaf a row reaches; at an inner node if no child test holds."""
    children: dict[int | None, list[Node]] = {}
    for node in nodes:
        children.setdefault(node.parent, []).append(node)

    def below(node: Node) -> Column:
        total = sum(node.class_counts)
        own = F.array(*[F.lit(c / total) for c in node.class_counts])
        branches = [(_holds(child), below(child)) for child in children.get(node.node, [])]
        if not branches:
            return own
        chain = F.when(*branches[0])
        for condition, value in branches[1:]:
            chain = chain.when(condition, value)
        return chain.otherwise(own)

    (root,) = children[None]
    return below(root)


def score_forest(df: DataFrame, nodes: Sequence[Node], classes: Sequence[str]) -> DataFrame:
    """Mean class distribution over the trees as ``probability_<class>`` and the most probable class."""
    trees: dict[int, list[Node]] = {}
    for node in nodes:
        trees.setdefault(node.tree, []).append(node)
    distributions = [tree_distribution(t) for t in trees.values()]
    # One array column per tree is computed first, so that each tree is walked once per row.
    staged = df.withColumns({f"_tree{i}": d for i, d in enumerate(distributions)})
    mean = [
        reduce(lambda a, b: a + b, [F.col(f"_tree{i}")[c] for i in range(len(distributions))]) / len(distributions)
        for c in range(len(classes))
    ]
    scored = staged.withColumns({f"probability_{name}": m for name, m in zip(classes, mean)})
    best = F.greatest(*[F.col(f"probability_{name}") for name in classes])
    label = reduce(
        lambda chain, name: chain.when(F.col(f"probability_{name}") == best, name),
        classes[1:],
        F.when(F.col(f"probability_{classes[0]}") == best, classes[0]),
    )
    return scored.withColumn("predicted", label).drop(*[f"_tree{i}" for i in range(len(distributions))])
