from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import table, texts

from ledgerline.llm import conversation_trie, mixing, resampling
from ledgerline.llm.common import Scratch

# mixing


def plain_targets(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in capped]
        level = (total - sum(most * sizes[s] for s in capped)) / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if level * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= over


def sourced(spark, rows):
    return spark.createDataFrame(
        [(i, t, s, "x", 1) for i, t, s in rows], "doc_id long, text string, source string, start string, rank long"
    )


def source_rows():
    rows = [(i, t, None if k % 5 == 0 else ["", "b", "é", "z"][k % 4]) for k, (i, t) in enumerate(texts())]
    rows += [(700 + k, "few words here", "tiny") for k in range(3)] + [(None, "a b c", "b")] * 2
    return rows + [(800 + k, "w " * (k * 13 % 90), "large") for k in range(400)] + [(900, "", "wordless")]


@pytest.mark.parametrize("block", [1, 7, 256])
def test_mix(spark, block):
    rows = source_rows()
    mixed = mixing.mix(sourced(spark, rows), block=block)
    got = mixing.taken_words(mixed).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, words(t)) for i, t, _ in rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    want = plain_targets(sizes, (3, 1, 2), 1.5, 2)
    names = {}
    for r in mixed.documents.collect():
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        names[r.source_no] = r.source
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    spans = mixed.spans.orderBy("slot", "at").collect()
    taken = Counter()
    for s in spans:
        taken[names[s.source_no]] += s.n_words
    assert taken == Counter({s: math.floor(w + 0.5) for s, w in want.items() if w >= 0.5})
    assert sum(r.taken for r in got) == sum(taken.values())
    ends = {}
    for s in spans:  # a slot is full and without a gap, but for the last one of a source
        assert s.at == ends.get(s.slot, 0) and s.at + s.n_words <= block
        ends[s.slot] = s.at + s.n_words
    assert sum(n < block for n in ends.values()) <= len(sizes)


def test_mix_is_even_along_the_schedule(spark):
    scratch = Scratch(spark, "test")
    shares = {1: 700, 2: 200, 3: 99, 4: 1, 5: 0}
    sources = spark.createDataFrame(list(shares.items()), "source_no long, slots long")
    got = mixing.schedule(spark, sources, scratch).orderBy("slot").collect()
    assert Counter(r.source_no for r in got) == {s: n for s, n in shares.items() if n}
    for source, slots in shares.items():
        ranks = [r["rank"] for r in got if r.source_no == source]
        assert ranks == list(range(slots))
    seen = Counter()
    for k, r in enumerate(got, 1):
        seen[r.source_no] += 1
        assert all(abs(seen[s] - k * n / 1000) < 6 for s, n in shares.items())


def test_mix_does_not_depend_on_partitions(spark, monkeypatch):
    rows = source_rows()
    one = mixing.taken_words(mixing.mix(sourced(spark, rows).coalesce(1), block=16))
    monkeypatch.setattr(mixing, "_GROUP", 10)  # many stretches and parts
    two = mixing.mix(sourced(spark, rows[::-1]).repartition(7), block=16)
    assert sorted(map(repr, one.collect())) != []
    sums = lambda f: sorted((repr(r.source_size), r.target, r["size"]) for r in f.collect())
    assert sums(one) == sums(mixing.taken_words(two))
    assert sum(r.n_words for r in two.spans.collect()) == sum(r.taken for r in one.collect())


def test_mix_of_nothing(spark):
    empty = mixing.mix(sourced(spark, []))
    assert mixing.taken_words(empty).count() == 0 and empty.spans.count() == 0
    wordless = mixing.taken_words(mixing.mix(sourced(spark, [(1, None, "a"), (2, " ", None)]))).collect()
    assert [(r["size"], r.target, r.taken) for r in wordless] == [(0, 0.0, 0)] * 2


# trie


def plain_trie(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    totals, out = {}, {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * (len(path[-1][1].encode()) if path else 0)
        below = [totals[child] for child in children[path]]
        totals[path] = (own + sum(s for s, _ in below), sum(n for _, n in below) or 1)
        ends = ",".join(str(c) for c in sorted(members[path]) if len(conversations[c]) == len(path))
        out[min(members[path]), len(path)] = (
            min(members[path[:-1]]) if path else None,
            len(members[path]),
            len(children[path]),
            totals[path][1],
            totals[path][0],
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return out


def trie_of(spark, conversations, **more):
    rows = [(c, k, r, t, "x", 1) for c, turns in conversations.items() for k, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    schema = "conv_id long, turn long, role string, text string, n string, place int"
    members = spark.createDataFrame([(c,) for c in conversations], "conv_id long")
    found = conversation_trie.prefix_trie(spark.createDataFrame(rows, schema), members).collect()
    assert len({(r.conv_id, r.depth) for r in found}) == len(found)
    return {(r.conv_id, r.depth): tuple(r)[2:] for r in found}


def random_conversations(seed, n, longest, choices):
    rng = random.Random(seed)
    return {
        c * 3 - 20: [(rng.choice("ua"), "é" * rng.randrange(choices)) for _ in range(rng.randrange(longest))]
        for c in range(n)
    }


@pytest.mark.parametrize("chunk", [3, 8192])
def test_trie_equals_plain_form(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversation_trie, "CHUNK", chunk)
    conversations = random_conversations(5, 150, 9, 2)
    conversations |= {1000 + k: [("u", "same")] * 4 for k in range(20)}  # copies
    conversations[2000] = []
    assert trie_of(spark, conversations) == plain_trie(conversations)


def test_trie_of_chains_and_combs(spark):
    chain = [("u", f"turn {k}") for k in range(120)]
    conversations = {1: chain, 2: chain[:60] + [("u", "leaves")] * 30}
    conversations |= {100 + k: chain[:k] + [("a", "tooth")] for k in range(0, 40)}  # a comb: every node has a leaf
    assert trie_of(spark, conversations) == plain_trie(conversations)


def test_trie_of_odd_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [
        (1, None, "u", "first"),  # null turn comes first
        (1, 0, None, None),
        (1, 0, None, None),  # a repeated row is a turn of its own
        (2, 0, "u", "first"),
        (2, 5, "", ""),
        (None, 0, "u", "nobody's"),
        (3, 1, "b", "tie"),
        (3, 1, "a", "tie"),
        (4, 0, "u", "y" * 300_000),
    ]
    turns = {1: [("u", "first"), ("", ""), ("", "")], 2: [("u", "first"), ("", "")], 3: [("a", "tie"), ("b", "tie")]}
    turns[4] = [("u", "y" * 300_000)]
    found = conversation_trie.prefix_trie(spark.createDataFrame(rows, schema)).collect()
    assert {(r.conv_id, r.depth): tuple(r)[2:] for r in found} == plain_trie(turns)
    assert conversation_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    alone = conversation_trie.prefix_trie(
        spark.createDataFrame([], schema), spark.createDataFrame([(9,), (8,)], "conv_id long")
    ).collect()
    assert [tuple(r)[:7] for r in alone] == [(8, 0, None, 2, 0, 1, 0)]
    assert alone[0].ends_sha256 == hashlib.sha256(b"8,9").hexdigest()


# resampling


def plain_features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())
    return words, [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def plain_resample(rows, target, longest, buckets, least, percent, seed):
    code = lambda f: zlib.crc32(f.encode()) % buckets
    raw = Counter(code(f) for _, t in rows for f in plain_features(t, longest)[1])
    aim = Counter(code(f) for t in target for f in plain_features(t, longest)[1])
    raw_all, aim_all = sum(raw.values()) + buckets, sum(aim.values()) + buckets

    def gain(b):
        return math.floor(1000 * math.log((aim[b] + 1) * raw_all / ((raw[b] + 1) * aim_all)))

    out = []
    for i, t in rows:
        words, features = plain_features(t, longest)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(code(f)) for f in features)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(features), weight, score, len(words) >= least))
    kept = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0]))
    drawn = kept[: len(kept) * percent // 100]
    left = Counter(out) - Counter(drawn)
    return Counter([(*r[:4], k) for k, r in enumerate(drawn, 1)]) + Counter({(*r[:4], None): n for r, n in left.items()})


@pytest.mark.parametrize("longest,percent,least", [(1, 10, 20), (3, 60, 1)])
def test_resample_equals_plain_form(spark, longest, percent, least):
    target = [sentence for _, sentence in texts()[5:8]] + [None, ""]
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")
    got = resampling.resample(spark, table(spark), wanted, longest, 997, least, percent)
    found = Counter(tuple(r) for r in got.collect())
    assert found == plain_resample(texts(), target, longest, 997, least, percent, 2024)


def test_resample_of_nothing(spark):
    none = table(spark, [])
    assert resampling.resample(spark, none, none).count() == 0
    only = resampling.resample(spark, table(spark, [(1, "a " * 30), (2, None)]), none, percent=100).collect()
    assert {r.doc_id: r["rank"] for r in only} == {1: 1, 2: None}


def test_features_of_stretches(monkeypatch):
    column = pa.array([t for _, t in texts()])
    monkeypatch.setattr(resampling, "_SEGMENT", 100)
    for longest in (1, 2):
        found = defaultdict(Counter)
        for codes, owners, _ in resampling.feature_buckets(column, longest, 1 << 32):
            for code, row in zip(codes.tolist(), owners.tolist()):
                found[row][code] += 1
        for row, (_, text) in enumerate(texts()):
            assert found[row] == Counter(zlib.crc32(f.encode()) for f in plain_features(text, longest)[1])


def test_crc_matrices():
    rng = np.random.default_rng(3)
    values = [rng.bytes(int(n)) for n in rng.integers(0, 40, 3000)] + [b"", b"x" * 5000, "é中".encode()]
    for kind in (pa.binary(), pa.large_binary()):
        found = resampling.crc32_rows(pa.array(values, kind)[5:])
        assert found.tolist() == [zlib.crc32(v) for v in values[5:]]
