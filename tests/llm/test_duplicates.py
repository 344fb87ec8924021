from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from odd_rows import PASSAGE, sentence, table, texts

from ledgerline.llm import chunk_dedup, components, jaccard_join
from ledgerline.llm.common import Scratch


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()


def plain_groups(rows, size, percent):
    """Union-find over all pairs; rows by their place."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids, default=None)))
    return out


def near_copies(seed, groups=12):
    """Groups of edited copies of many sizes, common passages, and chains."""
    random.seed(seed)
    rows, number = [], 1000
    for g in range(groups):
        words = sentence(seed * 100 + g, random.choice([3, 5, 9, 14, 30, 80, 200])).split()
        if g % 3 == 0:
            words += PASSAGE.split()[:25]
        for _ in range(random.randint(1, 9)):
            changed = list(words)
            for _ in range(random.randint(0, max(1, len(words) // 14))):
                at = random.randrange(len(changed))
                changed[at : at + random.randint(0, 1)] = [f"new{random.randint(0, 5)}"]
            rows.append((number, " ".join(changed)))
            number += 1
            if random.random() < 0.4:
                words = changed
    return rows


@pytest.mark.parametrize("size, percent, frequent, block", [(4, 85, 16, 256), (5, 80, 2, 2), (3, 70, 1, 3)])
def test_groups_equal_all_pairs(spark, monkeypatch, size, percent, frequent, block):
    """With low limits, costly subsets and groups of many blocks are the rule."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = [*texts(), *near_copies(size)]
    got = jaccard_join.near_groups(table(spark, rows), size, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(plain_groups(rows, size, percent))
    firsts = Counter(r.component_id for r in got if r.first and r.n_shingles)
    assert set(firsts.values()) <= {1}


def test_spanning_pairs():
    """The nearest pairs that join what all pairs join, and no more of them than there are components to join."""
    rng = random.Random(8)
    for _ in range(200):
        roots = [rng.randrange(1, 12) for _ in range(30)]
        pairs = sorted({tuple(sorted(rng.sample(range(30), 2))) for _ in range(rng.randrange(60))})
        near = [(rng.randrange(9), a, b, roots[a], roots[b]) for a, b in pairs if roots[a] != roots[b]]
        chosen = jaccard_join.spanning(near)

        def joined(some):
            of = {r: r for r in roots}
            for a, b in some:
                old, new = of[roots[a]], of[roots[b]]
                of = {r: new if t == old else t for r, t in of.items()}
            return {frozenset(r for r in of if of[r] == t) for t in of.values()}

        assert joined(chosen) == joined([p[1:3] for p in near])
        assert len(chosen) == len(set(roots)) - len(joined(chosen))
        weight = {(a, b): d for d, a, b, *_ in near}
        if near:
            assert weight[chosen[0]] == min(weight.values())


def test_linked_sets_always_share_an_index_entry():
    """The pigeonhole itself, on random sets at the limit, whichever subsets are costly."""
    rng = np.random.default_rng(3)
    for percent in (70, 80, 85, 95):
        bands = jaccard_join.Bands(percent)
        for _ in range(300):
            common = rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64)
            rest = int(common.size * (100 - percent) / percent)
            left = rng.integers(0, rest + 1)
            one = np.unique(np.concatenate((common, rng.integers(0, 2**63, left).astype(np.uint64))))
            other = np.unique(np.concatenate((common, rng.integers(0, 2**63, rest - left).astype(np.uint64))))
            if np.array_equal(one, other):
                continue
            entries = [jaccard_join.subsets(s, bands) for s in (one, other)]
            both = np.intersect1d(*entries)
            costly = both[rng.random(both.size) < rng.choice([0, 0.5, 1])]
            near = [jaccard_join.neighbourhoods(s, bands, costly) for s in (one, other)]
            assert np.setdiff1d(both, costly).size or np.intersect1d(*near).size


def test_stage_keeps_one_of_each_group(spark):
    docs = table(spark, [*texts(), *near_copies(7)])
    rows = docs.collect()
    out = jaccard_join.one_of_each_group(docs)
    assert out.dtypes == docs.dtypes
    groups = plain_groups([(r.doc_id, r.text) for r in rows], 5, 80)
    want = Counter(c for (_, n, c) in set(groups) if n)
    kept = Counter(r.doc_id for r in out.collect() if (r.text or "").split())
    assert set(kept) == set(want) and set(kept.values()) == {1}
    assert {1, 2, 3, 7} <= {r.doc_id for r in out.collect()}  # without words: all stay


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(200, 200 + k) for k in range(1, 50)] + [(300, 300)]
    random.shuffle(edges)
    links = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.components(links, "a", "b", Scratch(spark, "t")).collect()}
    assert got == {k: 0 for k in range(61)} | {200 + k: 200 for k in range(50)}


def plain_cut(rows, min_words):
    first, made = {}, []
    for i, t in rows:
        digests, chars, words = chunk_dedup.chunks((t or "").encode())
        made.append((digests, chars, words))
        if i is not None:
            for d in digests:
                first[d] = min(first.get(d, i), i)
    out = []
    for (i, t), (digests, chars, words) in zip(rows, made):
        seen, repeat, at, kept = set(), [], 0, []
        for d in digests:
            repeat.append(d in seen or (i is not None and first[d] != i))
            seen.add(d)
        k = 0
        places = [0, *np.cumsum(chars).tolist()]
        while k < len(digests):
            end = k
            while end < len(digests) and repeat[end]:
                end += 1
            if end > k and sum(words[k:end]) >= min_words:
                k = end
                continue
            end = max(end, k + 1)
            kept.append((t or "")[places[k] : places[end]])
            k = end
        out.append((i, "".join(kept)))
    return out


def test_cut_equals_plain(spark):
    rows = [*texts(), *near_copies(3), (5000, "w " * 300), (5001, sentence(5, 30_000)[500:9000])]
    got = chunk_dedup.cut_repeats(table(spark, rows)).collect()
    assert Counter((r.doc_id, r.kept_text) for r in got) == Counter(plain_cut(rows, 20))
    by_id = {r.doc_id: r for r in got}
    for i, t in rows:
        if i in by_id and i != 9:
            r = by_id[i]
            assert r.n_cut == sum(s.length for s in r.cut) == len(t or "") - len(r.kept_text) and r.n_chars == len(t or "")
    assert PASSAGE in by_id[20].kept_text and all(PASSAGE not in by_id[20 + k].kept_text for k in (1, 2, 3))
    assert by_id[21].first_docs == [20] and not by_id[10].n_cut


def test_chunks_cover_a_text_and_resist_shifts():
    for _, t in texts():
        raw = (t or "").encode()
        digests, chars, words = chunk_dedup.chunks(raw)
        wide = chunk_dedup.cuts(np.frombuffer(raw, np.uint8))[1] if raw else np.zeros(0, bool)
        assert sum(chars) == len(t or "") and len(digests) == len(chars) == len(wide)
        assert sum(words) == len(raw.split()) or wide.any()
    own = set(chunk_dedup.chunks(PASSAGE.encode())[0])
    moved = set(chunk_dedup.chunks(f"{sentence(1, 33)} {PASSAGE} tail".encode())[0])
    assert len(own & moved) >= len(own) - 6


def chinese(seed, n):
    rng = random.Random(seed)
    return "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))


def test_texts_without_blanks_are_cut(spark):
    same = chinese(1, 1500)
    own, moved = (set(chunk_dedup.chunks(t.encode())[0]) for t in (same, "两字" + same))
    assert len(own) > 100 and len(own & moved) >= len(own) - 6
    rows = [(1, same), (2, same), (3, "两字" + same), (4, chinese(4, 700) + same[300:700] + chinese(5, 300)), (5, chinese(6, 900))]
    got = {r.doc_id: r for r in chunk_dedup.cut_repeats(table(spark, rows)).collect()}
    assert got[1].n_cut == 0 and got[2].kept_text == "" and got[5].n_cut == 0
    assert got[3].n_cut > 1400 and 340 < got[4].n_cut <= 400
    plain = plain_repeats(rows, 40)
    assert all(plain[i] for i in (2, 3, 4)) and not plain[5]


def plain_repeats(rows, n):
    """Ids of texts, and whether ``n`` characters in a row of one stand in an earlier text; by every substring."""
    seen, out = set(), {}
    for i, t in rows:
        own = {t[k : k + n] for k in range(len(t) - n + 1)}
        out[i] = bool(own & seen)
        seen |= own
    return out


def test_what_is_cut_stands_earlier(spark):
    """An independent form: a text is cut only if a long part of it stands earlier, and then most of that part goes."""
    rng = random.Random(3)
    rows = [(k, sentence(k, 120)) for k in range(60)]
    rows += [(100 + k, f"{sentence(300 + k, 50)} {' '.join(rows[rng.randrange(60)][1].split()[20:90])} {sentence(400 + k, 50)}") for k in range(40)]
    got = {r.doc_id: r for r in chunk_dedup.cut_repeats(table(spark, rows)).collect()}
    plain = plain_repeats(rows, 150)
    assert {i for i, r in got.items() if r.n_cut} == {i for i, found in plain.items() if found}
    whole = "\n".join(t for i, t in rows if i < 100)
    for i, t in rows:
        for span in got[i].cut:
            assert t[span.start : span.start + span.length].strip() in whole
    passages = {i: len(" ".join(t.split()[50:120])) for i, t in rows if plain[i]}
    assert all(got[i].n_cut > 0.3 * n for i, n in passages.items())  # up to twenty words may stay at either end
    assert sum(got[i].n_cut for i in passages) > 0.7 * sum(passages.values())


def test_random_passages_are_found(spark):
    rows = [(k, f"{sentence(k, 40 + k)} {sentence(5000 + k // 2, 55)} {sentence(9000 + k, 40)}") for k in range(200)]
    got = {r.doc_id: r for r in chunk_dedup.cut_repeats(table(spark, rows)).collect()}
    assert all(not got[k].n_cut for k in range(0, 200, 2))
    assert sum(got[k].n_cut > 0 for k in range(1, 200, 2)) >= 98


def test_repeat_stage_and_empty_tables(spark):
    docs = table(spark)
    out = chunk_dedup.without_repeats(docs)
    assert out.dtypes == docs.dtypes and out.count() == docs.count()
    for step in (chunk_dedup.cut_repeats, chunk_dedup.without_repeats, jaccard_join.near_groups, jaccard_join.one_of_each_group):
        assert step(table(spark, [])).collect() == []
