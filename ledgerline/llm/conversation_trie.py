"""The trie of all conversations' beginnings, and totals over its subtrees by parallel tree contraction.

A node is a distinct sequence of the first d turns. Sequences are told apart by two 64-bit sums (exclusive or) of
hashes of place and turn, which, unlike a chained hash, can be summed up in parallel within one long conversation. A node is named
by its smallest conversation and its depth.

Subtree totals: in each round all leaves are raked into their parents, and of the nodes with one child, those that come
before their neighbours in a fixed order are compressed: the child is hung below the grandparent and carries the
node's sum on its edge. Depths with fewer factors of two come first in that order, so a chain halves. When the root is
left, the rounds are gone through backwards, and each compressed node gets its total from its child's. All joins of a
round are on node names that occur once on either side, so no node with many children makes a large task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch
from ledgerline.operators.numbering import sequence_numbers

CHUNK = 8192  # rows of one conversation, or ids of one node, that are handled together
_SALTS = 32
_EDGE = ["conv_id", "depth", "up_conv", "up_depth", "n", "saved", "leaves", "edge_saved", "edge_leaves"]


def spread_join(many: DataFrame, one: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """``many`` joined with its one row of ``one``, inner. ``salt`` cuts the rows of a hot key into groups: ``one`` is first
    joined to the distinct (key, salt), and those to the rows, so a hot key's rows go to as many tasks as it has salts.
    """
    salted = many.withColumn("_salt", salt)
    pairs = salted.select(*keys, "_salt").distinct().join(one, keys)
    return salted.join(pairs, [*keys, "_salt"]).drop("_salt")


def placed_turns(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, place, n_turns, key_1, key_2, n_bytes``: each turn's place 1, 2, ... in its conversation, the conversation's
    length, two hashes of role and text, and the UTF-8 bytes of the text.

    Order is by ``turn``, null first, then role, then the hashes. All turns are numbered together, so the turns of one
    long conversation are sorted by many tasks. Rows without a ``conv_id`` belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    narrow = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id",
        "turn",
        role.alias("role"),
        F.xxhash64(role, text).alias("key_1"),
        F.xxhash64(F.lit("second"), text, role).alias("key_2"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    numbered = sequence_numbers(narrow, narrow.columns, "number")
    numbered = scratch.table(numbered.withColumn("part", F.floor(F.col("number") / CHUNK)))
    parts = numbered.groupBy("conv_id", "part").agg(F.min("number").alias("low"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("conv_id")
    parts = parts.select(
        "conv_id", "part", F.min("low").over(whole).alias("low"), F.sum("n").over(whole).alias("n_turns")
    )
    return scratch.table(
        numbered.join(parts, ["conv_id", "part"]).select(
            "conv_id", (F.col("number") - F.col("low") + 1).alias("place"), "n_turns", "key_1", "key_2", "n_bytes"
        )
    )


def _paths(placed: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """Each conversation's nodes from the root on: ``conv_id, depth, p1, p2`` (the sequence), ``q1, q2`` (without its last
    turn), ``n_bytes``, and ``last``, whether the conversation ends here."""
    steps = scratch.table(
        placed.select(
            "conv_id",
            F.col("place").alias("depth"),
            F.floor((F.col("place") - 1) / CHUNK).alias("part"),
            F.xxhash64("place", "key_1").alias("f1"),
            F.xxhash64("key_2", "place").alias("f2"),
            "n_bytes",
            (F.col("place") == F.col("n_turns")).alias("last"),
        )
    )
    sums = steps.groupBy("conv_id", "part").agg(F.bit_xor("f1").alias("f1"), F.bit_xor("f2").alias("f2"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "conv_id", "part", *[F.coalesce(F.bit_xor(f).over(before), F.lit(0)).alias(s) for f, s in (("f1", "s1"), ("f2", "s2"))]
    )
    here = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    found = steps.join(starts, ["conv_id", "part"]).select(
        "*",
        F.col("s1").bitwiseXOR(F.bit_xor("f1").over(here)).alias("p1"),
        F.col("s2").bitwiseXOR(F.bit_xor("f2").over(here)).alias("p2"),
    )
    found = found.select(
        "conv_id",
        "depth",
        "p1",
        "p2",
        F.col("p1").bitwiseXOR(F.col("f1")).alias("q1"),
        F.col("p2").bitwiseXOR(F.col("f2")).alias("q2"),
        "n_bytes",
        "last",
    )
    ended = placed.filter("place = 1").select("conv_id", F.lit(True).alias("has_turns"))
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "p1", "p2")]
    none = [F.lit(None).cast("long").alias(c) for c in ("q1", "q2")]
    roots = members.join(ended, "conv_id", "left").select(
        "conv_id", *zero, *none, F.lit(0).cast("long").alias("n_bytes"), F.col("has_turns").isNull().alias("last")
    )
    return scratch.table(found.unionByName(roots))


def _ends(paths: DataFrame) -> DataFrame:
    """``depth, p1, p2, ends_sha256``: the digest of the ids of the conversations that end at a node, ascending, joined by
    commas. The ids are sorted by node and id over all tasks and joined to texts of up to 8,192 ids where they are; a digest has to be taken in
    order, but its task then reads one row per text and holds one at a time."""
    keys = ["depth", "p1", "p2"]
    ends = paths.filter("last").select(*keys, "conv_id", F.col("conv_id").cast("string").alias("name"))
    kind = ends.schema["conv_id"].dataType.simpleString()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, names = None, None, []

        def result(rows: list, types: list) -> pa.RecordBatch:
            arrays = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            return pa.RecordBatch.from_arrays(arrays, [*keys, "first", "names"])

        types = None
        for batch in batches:
            done, types = [], [c.type for c in batch.columns]
            for depth, p1, p2, conv_id, name in zip(*(c.to_pylist() for c in batch.columns)):
                if names and ((depth, p1, p2) != now or len(names) == CHUNK):
                    done.append((*now, first, ",".join(names)))
                    names = []
                if not names:
                    now, first = (depth, p1, p2), conv_id
                names.append(name)
            if done:
                yield result(done, types)
        if names:
            yield result([(*now, first, ",".join(names))], types)

    ranged = ends.repartitionByRange(*keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
    pieces = ranged.mapInArrow(joined, f"depth long, p1 long, p2 long, first {kind}, names string")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, None

        def result(rows: list) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            return pa.RecordBatch.from_arrays(arrays, [*keys, "ends_sha256"])

        for batch in batches:
            done = []
            for depth, p1, p2, names in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4))):
                if (depth, p1, p2) == now:
                    running.update(b",")
                else:
                    if now is not None:
                        done.append((*now, running.hexdigest()))
                    now, running = (depth, p1, p2), hashlib.sha256()
                running.update(names.encode())
            if done:
                yield result(done)
        if now is not None:
            yield result([(*now, running.hexdigest())])

    ordered = pieces.repartition(*keys).sortWithinPartitions(*keys, "first")
    return ordered.mapInArrow(digests, "depth long, p1 long, p2 long, ends_sha256 string")


def _turn(conv: str, depth: str) -> Column:
    """A node's turn in the order of compressing: by the factors of two of its depth, then by a hash; the root last."""
    factors = F.bit_count(F.col(depth).bitwiseAND(-F.col(depth)) - 1).cast("long")
    return F.when(F.col(depth) == 0, F.lit(64 << 55)).otherwise(
        F.shiftleft(factors, 55) + F.shiftrightunsigned(F.xxhash64(conv, depth), 9)
    )


def _round(active: DataFrame) -> DataFrame:
    """One rake and compress: rows of ``kind`` *raked* (their ``saved, leaves`` are their totals), *compressed* (theirs lack
    the total of the node ``kid_conv, kid_depth``) and *active*."""
    leaf = F.col("n") == 0
    gained = [F.sum(F.when(leaf, F.col(c) + F.col(f"edge_{c}")).otherwise(0)).alias(f"raked_{c}") for c in ("saved", "leaves")]
    kid = F.struct(
        F.col("conv_id").alias("kid_conv"),
        F.col("depth").alias("kid_depth"),
        F.col("n").alias("kid_n"),
        F.col("edge_saved").alias("kid_saved"),
        F.col("edge_leaves").alias("kid_leaves"),
    )
    below = (
        active.filter("up_conv IS NOT NULL")
        .groupBy(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth"))
        .agg(F.count_if(leaf).alias("raked"), *gained, F.min(F.when(~leaf, kid)).alias("kid"))
        .select("conv_id", "depth", "raked", "raked_saved", "raked_leaves", "kid.*")
    )
    here = active.filter(~leaf).join(below, ["conv_id", "depth"])
    here = here.withColumns(
        {
            "saved": F.col("saved") + F.col("raked_saved"),
            "leaves": F.col("leaves") + F.col("raked_leaves"),
            "compressed": (F.col("n") == 1)
            & F.col("kid_conv").isNotNull()
            & F.col("up_conv").isNotNull()
            & (_turn("conv_id", "depth") < _turn("up_conv", "up_depth"))
            & ((F.col("kid_n") != 1) | (_turn("conv_id", "depth") < _turn("kid_conv", "kid_depth"))),
            "n": F.col("n") - F.col("raked"),
        }
    )
    moved = here.filter("compressed").select(
        F.col("kid_conv").alias("conv_id"),
        F.col("kid_depth").alias("depth"),
        F.col("up_conv").alias("new_conv"),
        F.col("up_depth").alias("new_depth"),
        (F.col("saved") + F.col("edge_saved")).alias("more_saved"),
        (F.col("leaves") + F.col("edge_leaves")).alias("more_leaves"),
    )
    nowhere = [F.lit(None).cast(active.schema["conv_id"].dataType).alias("kid_conv"), F.lit(None).cast("long").alias("kid_depth")]
    kept = here.join(moved, ["conv_id", "depth"], "left").select(
        F.when(F.col("compressed"), "compressed").otherwise("active").alias("kind"),
        "conv_id",
        "depth",
        F.coalesce("new_conv", "up_conv").alias("up_conv"),
        F.coalesce("new_depth", "up_depth").alias("up_depth"),
        "n",
        *[(F.col(c) + F.when(F.col("compressed"), F.col(f"kid_{c}")).otherwise(0)).alias(c) for c in ("saved", "leaves")],
        *[(F.col(f"edge_{c}") + F.coalesce(f"more_{c}", F.lit(0))).alias(f"edge_{c}") for c in ("saved", "leaves")],
        "kid_conv",
        "kid_depth",
    )
    raked = active.filter(leaf).select(F.lit("raked").alias("kind"), *_EDGE, *nowhere)
    return kept.unionByName(raked)


def subtree_totals(tree: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, depth, saved, leaves``: for each node of ``tree`` (``conv_id, depth, up_conv, up_depth, n_children, own``),
    the sum of ``own`` and the number of leaves over its subtree."""
    zero = F.lit(0).cast("long")
    active = tree.select(
        "conv_id",
        "depth",
        "up_conv",
        "up_depth",
        F.col("n_children").alias("n"),
        F.col("own").alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        zero.alias("edge_saved"),
        zero.alias("edge_leaves"),
    )
    rounds = []
    while True:
        done = scratch.table(_round(active))
        kinds = [F.count_if(F.col("kind") == kind).alias(kind) for kind in ("active", "compressed")]
        seen = done.agg(*kinds).first()
        rounds.append((done, seen["compressed"]))
        if not seen["active"]:
            break
        active = done.filter("kind = 'active'").select(*_EDGE)
    columns, known = ["conv_id", "depth", "saved", "leaves"], None
    for done, compressed in reversed(rounds):
        if compressed:
            kids = known.select(
                F.col("conv_id").alias("kid_conv"),
                F.col("depth").alias("kid_depth"),
                F.col("saved").alias("kid_saved"),
                F.col("leaves").alias("kid_leaves"),
            )
            found = done.filter("kind = 'compressed'").join(kids, ["kid_conv", "kid_depth"]).select(
                "conv_id",
                "depth",
                (F.col("saved") + F.col("kid_saved")).alias("saved"),
                (F.col("leaves") + F.col("kid_leaves")).alias("leaves"),
            )
            known = known.unionByName(scratch.table(found))
        raked = done.filter("kind = 'raked'").select(*columns)
        known = raked if known is None else known.unionByName(raked)
    return known


def trie_of_placed(placed: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """As :func:`prefix_trie`, from turns as :func:`placed_turns` gives them."""
    paths = _paths(placed, members.select("conv_id").filter("conv_id IS NOT NULL").distinct(), scratch)
    nodes = scratch.table(
        paths.groupBy("depth", "p1", "p2").agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("n_bytes").alias("n_bytes"),
            F.min("q1").alias("q1"),
            F.min("q2").alias("q2"),
        )
    )
    parents = nodes.select(
        F.col("conv_id").alias("up_conv"), F.col("depth").alias("up_depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2")
    )
    below = nodes.filter("depth > 0").withColumn("up_depth", F.col("depth") - 1)
    hung = spread_join(below, parents, ["up_depth", "q1", "q2"], F.pmod(F.xxhash64("conv_id"), F.lit(_SALTS)))
    root = nodes.filter("depth = 0").withColumns(
        {"up_conv": F.lit(None).cast(nodes.schema["conv_id"].dataType), "up_depth": F.lit(None).cast("long")}
    )
    hung = scratch.table(hung.unionByName(root).drop("q1", "q2"))
    kids = hung.filter("up_conv IS NOT NULL").groupBy(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth"))
    kids = kids.agg(F.count(F.lit(1)).alias("n_children"))
    tree = scratch.table(
        hung.join(kids, ["conv_id", "depth"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
        .withColumn("own", (F.col("n_convs") - 1) * F.col("n_bytes"))
    )
    totals = subtree_totals(tree, scratch)
    none = hashlib.sha256(b"").hexdigest()
    return (
        tree.join(totals, ["conv_id", "depth"])
        .join(_ends(paths), ["depth", "p1", "p2"], "left")
        .select(
            "conv_id",
            "depth",
            F.col("up_conv").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )


def prefix_trie(turns: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """One row per distinct sequence of first turns of ``turns`` (``conv_id, turn, role, text``).

    ``conv_id`` is the smallest conversation that starts so and names the node together with ``depth``; ``parent_conv_id``
    is null for the root; ``n_convs`` conversations start so, ``n_children`` longer ones follow and ``n_leaves`` childless nodes
    are in the subtree; ``saved_tokens`` sums (n_convs - 1) times the bytes of the node's last text over the subtree;
    ``ends_sha256`` is the digest of the ids of the conversations that end here.

    Turns are in the order of ``turn``, null first, ties by role and a hash of the text; a null role or text is
    empty; rows alike are turns each for itself; rows without a ``conv_id`` are left out. ``members`` may name
    conversations without turns. No conversation at all gives no rows.
    """
    scratch = Scratch(turns.sparkSession, "trie")
    placed = placed_turns(turns, scratch)
    return trie_of_placed(placed, turns if members is None else members, scratch)
