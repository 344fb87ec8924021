"""Exact Jaccard join of documents as sets of word n-grams, by universe partition and pigeonhole.

Sets are banded by size. In a band the universe of n-grams is dealt into segments by hash, two segments to a unit.
Linked sets differ in at most H n-grams, H from their sizes; over floor(H / 2) + 1 units, some unit then holds at most
one difference, so one of its segments is the same in both sets. Each set therefore indexes its segments' subsets, of
as many units as its size asks for, in its own band and, if a smaller partner can be there, in the band below.

Cost-based allocation: the subset of a segment that many sets share (none, or a common passage's part) costs too many
candidates. Where a unit has such a subset, both of its segments are indexed together instead, as their union and
its one-deletion neighbourhood, which meets every partner with at most one difference in the unit. All partners
share the costly subset, so both sides choose alike and no link is lost.

Each set also has a parity sketch: one bit per bucket of hashes, flipped by each n-gram in it. Two sketches differ in
no more bits than the sets differ in n-grams, so a pair whose sketches differ in more than H bits is dropped without
loss. What is left is verified on the whole texts.

Copies of a set are one class throughout. Only components are wanted, so the members of costly groups are first compared
with one of them, and from then on only members of separate components are. Groups are dealt out in blocks of a bounded
size; the sketches of two blocks are compared in one task, and only pairs that pass leave it: first the nearest ones
that span what can be joined, fewer than the blocks have members, then, once these have joined what they join, the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import quoted
from ledgerline.llm.common import Scratch, forget, sliced, text_key, texts, words
from ledgerline.llm.components import components

_U, _LAST = np.uint64, np.iinfo(np.int64).max
_STEP, _ONE, _TWO = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
FREQUENT = 16  # of 64 marks set: about 18 sets or more share a subset
BLOCK = 256  # members of a group that meet in one task, twice
LEAST = 6  # groups of a member that its rows name, so that a pair is not sent from each group it shares


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: each bit of the result depends on all of ``x``."""
    x = (x ^ (x >> _U(30))) * _ONE
    x = (x ^ (x >> _U(27))) * _TWO
    return x ^ (x >> _U(31))


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; for arrays this short a sort is several times as fast as ``np.unique``."""
    values = np.sort(values)
    first = np.ones(values.size, bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def shingle_set(found: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; fewer words than ``size`` make one n-gram of all. Words are
    hashed each time: that takes less than to look them up in a memo."""
    import xxhash

    if not found:
        return np.empty(0, _U)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), _U, len(found))
    size = min(size, len(found))
    n = len(found) - size + 1
    mixed = np.full(n, size, _U)
    for k in range(size):
        mixed = mixed * _STEP + hashes[k : k + n]
    return _distinct(_mix(mixed))


class Bands:
    """Bands of set sizes, and how many units a set needs in one, for a similarity of ``percent`` hundredths."""

    def __init__(self, percent: int) -> None:
        self.percent, self.starts = percent, [1]

    def differences(self, one: int, other: int) -> int:
        """The most elements in which linked sets of these sizes differ."""
        return (one + other) * (100 - self.percent) // (100 + self.percent)

    def of(self, n: int) -> int:
        while self.starts[-1] <= n:
            self.starts.append(self.starts[-1] * 10_000 // self.percent**2 + 1)
        low, high = 0, len(self.starts) - 1
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self.starts[middle] <= n else (low, middle)
        return low

    def units(self, band: int) -> int:
        """Into how many units a band's universe is dealt: enough for its largest sets and their partners."""
        largest = self.starts[band + 1] - 1
        return self.differences(largest, largest * 100 // self.percent) // 2 + 1

    def homes(self, n: int) -> list[tuple[int, int]]:
        """``(band, units used)`` for a set of ``n`` n-grams; none if only equal sets can be its partners."""
        most = self.differences(n, n * 100 // self.percent)
        if not most:
            return []
        band = self.of(n)
        homes = [(band, most // 2 + 1)]
        if band and -(-n * self.percent // 100) < self.starts[band]:
            homes.append((band - 1, self.differences(n, self.starts[band] - 1) // 2 + 1))
        return homes


def _segments(found: np.ndarray, bands: Bands, band: int, used: int) -> tuple[np.ndarray, ...]:
    """Segment of each n-gram, and per used segment the sum of its n-grams' hashes and their number."""
    segment = ((found >> _U(33)) % _U(2 * bands.units(band))).astype(np.int64)
    near = segment < 2 * used
    segment, own = segment[near], _mix(found[near] ^ _STEP)
    sums = np.zeros(2 * used, _U)
    np.add.at(sums, segment, own)
    return segment, own, sums, np.bincount(segment, minlength=2 * used).astype(_U)


def _subset(sums: np.ndarray, sizes: np.ndarray, kind: int, band: int, place: np.ndarray) -> np.ndarray:
    where = _mix((place.astype(_U) << _U(12)) + _U(2 * band + kind + 1))
    return _mix(_mix(sums + where) + sizes * _STEP + where)


def subsets(found: np.ndarray, bands: Bands) -> np.ndarray:
    """A number for each indexed segment's subset of a set."""
    out = []
    for band, used in bands.homes(found.size):
        _, _, sums, sizes = _segments(found, bands, band, used)
        out.append(_subset(sums, sizes, 0, band, np.arange(2 * used)))
    return np.concatenate(out) if out else np.empty(0, _U)


def neighbourhoods(found: np.ndarray, bands: Bands, costly: np.ndarray) -> np.ndarray:
    """For each unit with a costly subset: a number for its union, and for the union less each of its n-grams."""
    out = []
    for band, used in bands.homes(found.size):
        segment, own, sums, sizes = _segments(found, bands, band, used)
        hit = np.isin(_subset(sums, sizes, 0, band, np.arange(2 * used)), costly)
        chosen = hit[0::2] | hit[1::2]
        units = np.flatnonzero(chosen)
        if units.size:
            total, size = sums[0::2] + sums[1::2], sizes[0::2] + sizes[1::2]
            mine = chosen[segment // 2]
            of, less = segment[mine] // 2, own[mine]
            out.append(_subset(total[units], size[units], 1, band, units))
            out.append(_subset(total[of] - less, size[of] - _U(1), 1, band, of))
    return _distinct(np.concatenate(out)) if out else np.empty(0, _U)


def sketch(found: np.ndarray, bands: Bands) -> bytes:
    """Parities of a set's n-grams over a power of two of buckets, at least eight times as many as differences allowed."""
    allowed = bands.differences(found.size, found.size * 100 // bands.percent)
    bits = 1 << max(7, (8 * allowed).bit_length())
    at = ((found >> _U(7)) & _U(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of words, the longer ones folded to the shortest one's buckets."""
    size = min(map(len, sketches)) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(s, _U).reshape(-1, size), axis=0) for s in sketches])


def _signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = _signed(np.concatenate(arrays)) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per document: a row number, its set's size, 128-bit digest, subsets and sketch."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        forget()
        bands, at = Bands(percent), TaskContext.get().partitionId() << 33
        for batch in sliced(batches):
            found = [shingle_set(words(t), size) for t in batch.column(1).to_pylist()]
            digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in found]
            halves = [np.array([d >> s & 0xFFFFFFFFFFFFFFFF for d in digests], _U) for s in (64, 0)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(np.arange(at, at + len(found))),
                    pa.array([s.size for s in found], pa.int64()),
                    *[pa.array(_signed(h)) for h in halves],
                    _lists([subsets(s, bands) for s in found]),
                    pa.array([sketch(s, bands) for s in found], pa.binary()),
                ],
                ["doc_id", "text_key", "row", "n", "d1", "d2", "subsets", "sketch"],
            )
            at += len(found)

    narrow = texts(docs).select("doc_id", F.encode("text", "utf-8").alias("text"), text_key(F.col("text")).alias("text_key"))
    schema = f"doc_id {id_type}, text_key long, row long, n long, d1 long, d2 long, subsets array<long>, sketch binary"
    return narrow.mapInArrow(run, schema)


class Verifier:
    """Decides which candidate pairs ``a, b`` of rows are linked."""

    def __init__(self, docs: DataFrame, sets: DataFrame, size: int, percent: int, scratch: Scratch) -> None:
        self.sets, self.size, self.percent, self.scratch = sets, size, percent, scratch
        self.docs = texts(docs).select(
            F.col("doc_id").alias("_id"), F.encode("text", "utf-8").alias("text"), text_key(F.col("text")).alias("_key")
        )

    def whole(self, rows: DataFrame) -> DataFrame:
        """``row, text`` of the rows asked for."""
        asked = rows.join(self.sets.select("row", "doc_id", "text_key"), "row")
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("text_key"))
        return self.docs.join(asked, same).select("row", "text").dropDuplicates(["row"])

    def near(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and sketches allow a link."""
        sides = [
            self.sets.select(F.col("row").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
            for x in ("b", "a")
        ]
        both = pairs.join(sides[0], "b").join(sides[1], "a")
        both = both.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent)
        bands = Bands(self.percent)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = []
                for n, m, x, y in zip(*(batch.column(k).to_pylist() for k in range(2, 6))):
                    one, other = folded([x, y])
                    good.append(int(np.bitwise_count(one ^ other).sum()) <= bands.differences(n, m))
                yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

        return both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")

    def links(self, near: DataFrame) -> DataFrame:
        """Those of the pairs that are linked, decided on the whole texts."""
        if near.isEmpty():
            return near
        held = self.scratch.table(self.whole(near.select(F.explode(F.array("a", "b")).alias("row")).distinct()))
        one = held.select(F.col("row").alias("b"), F.col("text").alias("text_b"))
        both = near.join(one, "b").join(held.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
        size, percent = self.size, self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, mine = None, None
            for batch in sliced(batches):
                good = []
                for a, _, text_a, text_b in zip(*(batch.column(k).to_pylist() for k in range(4))):
                    if last != a:
                        last, mine = a, shingle_set(words(text_a), size)
                    theirs = shingle_set(words(text_b), size)
                    common = np.intersect1d(mine, theirs, assume_unique=True).size
                    good.append(100 * common >= percent * (mine.size + theirs.size - common))
                yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

        found = self.scratch.table(both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"))
        self.scratch.drop(held)
        return found


def _with_roots(rows: DataFrame, node: str, labels: DataFrame, name: str) -> DataFrame:
    return rows.join(labels.select(F.col("node").alias(node), F.col("root").alias(name)), node, "left").withColumn(
        name, F.coalesce(name, node)
    )


def _mixed(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """Members ``g, row, root`` of groups that span components, with the group's size."""
    rooted = _with_roots(groups, "row", labels, "root")
    spans = rooted.groupBy("g").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("members"))
    return rooted.join(spans.filter("low <> high").select("g", "members"), "g")


def _joined(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Labels after further links: components of the roots that the links join."""
    roots = _with_roots(_with_roots(links, "a", labels, "root_a"), "b", labels, "root_b")
    merged = components(roots, "root_a", "root_b", scratch)
    known = labels.join(merged.select(F.col("node").alias("root"), F.col("root").alias("new")), "root", "left")
    known = known.select("node", F.coalesce("new", "root").alias("root"))
    return scratch.table(known.unionByName(merged.join(labels, "node", "left_anti")))


def spanning(near: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int]]:
    """Of pairs ``(distance, a, b, root_a, root_b)``, the nearest ones that join all components which the pairs join."""
    above: dict[int, int] = {}

    def top(root: int) -> int:
        while (up := above.get(root, root)) != root:
            above[root] = root = above.get(up, up)
        return root

    found = []
    for _, a, b, root_a, root_b in sorted(near):
        one, other = top(root_a), top(root_b)
        if one != other:
            above[one] = other
            found.append((a, b))
    return found


def _candidates(members: DataFrame, sets: DataFrame, percent: int, span: bool) -> DataFrame:
    """Pairs ``a, b`` of a group's members of separate components whose sizes and sketches allow a link; with ``span``
    only a spanning forest of them for every two blocks, of the nearest pairs.

    A group is dealt into blocks by a hash of the member, and each member goes to the tasks of its block with every
    block of the group. A task holds two blocks at a time. Near copies share most of their groups: each member's rows name
    the first few of its groups, and two members that both name an earlier group are left to that one.
    """
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    least = members.groupBy("row").agg(F.slice(F.array_sort(F.collect_set("g")), 1, LEAST).alias("least"))
    sketches = sets.select("row", F.col("n").cast("long").alias("n"), "sketch").join(least, "row")
    dealt = (
        placed.join(sketches, "row")
        .select("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "row", "root", "n", "sketch", "least")
        .repartition("g", "i", "j")
        .sortWithinPartitions("g", "i", "j", "own", "row")
    )
    bands = Bands(percent)

    def few_compared(rows: list[tuple]) -> list[tuple[int, int]]:
        near, g = [], rows[0][0]
        for k, (*_, row, root, n, sketch_, named) in enumerate(rows):
            earlier = {x for x in named if x < g}
            for *_, row_, root_, n_, other, named_ in rows[k + 1 :]:
                if root != root_ and min(n, n_) * 100 >= max(n, n_) * percent:
                    if len(sketch_) == len(other):
                        apart = (int.from_bytes(sketch_) ^ int.from_bytes(other)).bit_count()
                    else:
                        one, two = folded([sketch_, other])
                        apart = int(np.bitwise_count(one ^ two).sum())
                    if apart <= bands.differences(n, n_) and earlier.isdisjoint(named_):
                        near.append((apart, min(row, row_), max(row, row_), root, root_))
        return spanning(near) if span else [pair[1:3] for pair in near]

    def compared(rows: list[tuple]) -> list[tuple[int, int]]:
        if len(rows) <= 12 and rows[0][1] == rows[0][2]:
            return few_compared(rows)
        g, i, j, own, row, root, n, sketches, named = (list(c) for c in zip(*rows))
        named = np.array([[*x, *[_LAST] * (LEAST - len(x))] for x in named], np.int64)
        own, row, root, n = (np.array(c, np.int64) for c in (own, row, root, n))
        bits, found, near = folded(sketches), [], []
        split = int((own == i[0]).sum())  # sorted by block: the first one, then the other
        for k in range(split if i[0] != j[0] else len(row) - 1):
            ahead = slice(split, None) if i[0] != j[0] else slice(k + 1, None)
            fits = (root[ahead] != root[k]) & (np.minimum(n[ahead], n[k]) * 100 >= np.maximum(n[ahead], n[k]) * percent)
            at = np.flatnonzero(fits) + ahead.start
            if not at.size:
                continue
            apart = np.bitwise_count(bits[at] ^ bits[k]).sum(1, dtype=np.int64)
            passed = apart <= (n[at] + n[k]) * (100 - percent) // (100 + percent)
            at, apart = at[passed], apart[passed]
            earlier = named[k][named[k] < g[0]]
            if at.size and earlier.size:
                alone = ~np.isin(named[at], earlier).any(axis=1)
                at, apart = at[alone], apart[alone]
            if not at.size:
                continue
            lower, upper = np.minimum(row[at], row[k]), np.maximum(row[at], row[k])
            if span:  # of one member's pairs with one component, the nearest will do
                order = np.lexsort((apart, root[at]))
                firsts = np.concatenate(([True], np.diff(root[at][order]) != 0))
                chosen = order[firsts]
                near += zip(apart[chosen].tolist(), lower[chosen].tolist(), upper[chosen].tolist(), [int(root[k])] * chosen.size, root[at][chosen].tolist())
            else:
                found += zip(lower.tolist(), upper.tolist())
        return spanning(near) if span else found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            pairs: list[tuple[int, int]] = []
            for member in zip(*(column.to_pylist() for column in batch.columns)):
                if held and held[-1][:3] != member[:3]:
                    pairs += compared(held) if len(held) > 1 else []
                    held = []
                held.append(member)
            yield _pairs(pairs)
        if len(held) > 1:
            yield _pairs(compared(held))

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array([int(p[k]) for p in pairs], pa.int64()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


def _resolved(groups: DataFrame, labels: DataFrame, verifier: Verifier, scratch: Scratch) -> DataFrame:
    """Labels once every pair of a group's members is known to be in one component or not similar: the pairs that span
    the groups first, then all others that are still in separate components."""
    tried = None
    for span in (True, False):
        members = scratch.table(_mixed(groups, labels))
        if members.isEmpty():
            break
        near = _candidates(members, verifier.sets, verifier.percent, span)
        near = scratch.table(near if tried is None else near.join(tried, ["a", "b"], "left_anti"))
        links = verifier.links(near)
        if not links.isEmpty():
            labels = _joined(labels, links, scratch)
        if span and near.isEmpty():
            break
        tried, groups = near, members.select("g", "row")
    return labels


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents linked by a Jaccard similarity of ``percent`` hundredths or more of their word n-gram
    sets: ``doc_id, text_key, n_shingles, component_id`` (the smallest id reached) and ``first``, true for one row of
    each component.

    A-Z count as a-z; words are ``[^\\x20\\x09-\\x0D]+``; fewer words than ``size`` are one n-gram. A null or wordless
    text has an empty set and links with nothing. Rows equal in id and text count each. Sets are compared as 64-bit
    hashes of n-grams and 128-bit digests of sets; subsets only propose candidates.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    sets = scratch.table(_sets(docs, size, percent))
    classes = scratch.table(
        sets.filter("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("class"), F.count(F.lit(1)).alias("copies"))
    )
    copies = (
        sets.select("row", "d1", "d2", "n").filter("n > 0")
        .join(classes.filter("copies > 1"), ["d1", "d2"])
        .filter("row <> class")
        .select("row")
    )
    indexed = sets.filter(F.size("subsets") > 0).join(scratch.table(copies), "row", "left_anti")
    entries = indexed.select(F.explode("subsets").alias("g"), "row")
    mark = F.expr("shiftleft(1L, cast(pmod(xxhash64(row), 64L) AS int))")
    shared = scratch.table(
        entries.withColumn("mark", mark)
        .groupBy("g")
        .agg(F.min("row").alias("low"), F.max("row").alias("high"), F.bit_or("mark").alias("marks"))
        .filter("low <> high")
        .select("g", F.col("low").alias("pivot"), (F.bit_count("marks") >= FREQUENT).alias("costly"))
    )
    groups = scratch.table(entries.join(shared, "g"))
    verifier = Verifier(docs, sets, size, percent, scratch)
    stars = groups.filter("costly AND row <> pivot").select(F.col("pivot").alias("a"), F.col("row").alias("b")).distinct()
    labels = scratch.table(components(verifier.links(scratch.table(verifier.near(stars))), "a", "b", scratch))
    costly = _mixed(groups.filter("costly").select("g", "row"), labels)
    costly = scratch.table(costly.groupBy("row").agg(F.collect_set("g").alias("costly")))
    costly = costly.join(verifier.whole(costly.select("row")), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in sliced(batches):
            rows, found = [], [np.empty(0, _U)]
            for row, text, subset in zip(*(batch.column(k).to_pylist() for k in range(3))):
                found.append(neighbourhoods(shingle_set(words(text), size), bands, np.array(subset, np.int64).view(_U)))
                rows.append(row)
            repeated = np.repeat(np.array(rows, np.int64), [f.size for f in found[1:]])
            yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(found))), pa.array(repeated)], ["g", "row"])

    wide = scratch.table(costly.select("row", "text", "costly").mapInArrow(run, "g long, row long"))
    few = groups.filter("NOT costly").select("g", "row")
    labels = _resolved(few.unionByName(wide), labels, verifier, scratch)

    members = sets.select("doc_id", "text_key", "row", "n", "d1", "d2").join(classes, ["d1", "d2"], "left")
    members = _with_roots(members.withColumn("class", F.coalesce("class", "row")), "class", labels, "root")
    members = scratch.table(members.withColumn("root", F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("row"))))
    scratch.keep_only(members)
    heads = members.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.min(F.struct("doc_id", "row")).alias("head"))
    return members.join(heads, "root").select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        "component_id",
        (F.col("row") == F.col("head.row")).alias("first"),
    )


def one_of_each_group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the first document of each component; documents without words all stay. Of rows equal in id and
    text one stays."""
    firsts = near_groups(docs, size, percent).filter("first").select(F.col("doc_id").alias("_ll_id"), F.col("text_key").alias("_ll_key"))
    keyed = docs.withColumn("_ll_text", text_key(F.col("text")))
    kept = keyed.join(firsts, F.col("doc_id").eqNullSafe(F.col("_ll_id")) & (F.col("_ll_text") == F.col("_ll_key")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_ll_text"]).select(*[quoted(c) for c in docs.columns])
