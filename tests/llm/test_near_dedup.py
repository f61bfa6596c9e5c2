import random

import numpy as np
from llm_samples import components_of, shingle_set

from seismic_lake.llm import near_dedup

SIZE = 4


def edited(rnd, words, share):
    return [w if rnd.random() > share else "zz" + str(rnd.randint(0, 10**6)) for w in words]


def family(seed, groups=6, copies=8):
    rnd = random.Random(seed)
    texts = []
    for g in range(groups):
        base = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([6, 30, 120, 400]))]
        texts.append(" ".join(base))
        texts += [" ".join(edited(rnd, base, rnd.choice([0, 0.01, 0.02, 0.04, 0.06]))) for _ in range(copies)]
    rnd.shuffle(texts)
    return texts


def test_equals_all_pairs(spark, docs_of):
    texts = family(1) + family(2, groups=3, copies=20)
    got = {r["doc_id"]: r for r in near_dedup.link(docs_of(texts), SIZE).collect()}
    want = components_of(texts, SIZE)
    assert {k: r["component_id"] for k, r in got.items()} == want
    assert all(r["n_shingles"] == len(shingle_set(texts[k], SIZE)) and r["kept"] == (k == want[k]) for k, r in got.items())


def test_copies_that_only_a_middle_document_links(spark, docs_of):
    # Copies are linked to the base (least doc_id last), not to each other.
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(203)]
    texts = []
    for k in range(12):
        words = list(base)
        for at in range(2 + 16 * k, 2 + 16 * k + 14):
            if at < len(words):
                words[at] = f"v{k}"
        texts.append(" ".join(words))
    texts.append(" ".join(base))
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.link(docs_of(texts), SIZE).collect()}
    assert got == components_of(texts, SIZE) and rnd


def test_odd_rows(spark, odd, empty, clashing):
    rows = near_dedup.link(odd, SIZE).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert all(by_id[i]["n_shingles"] == 0 and by_id[i]["component_id"] == i and by_id[i]["kept"] for i in (0, 1, 2, 3))
    assert by_id[11]["component_id"] == 10 and not by_id[11]["kept"] and by_id[14]["component_id"] == 13
    assert all(r["component_id"] is None and r["kept"] for r in rows if r["doc_id"] is None)
    assert near_dedup.link(empty, SIZE).count() == 0
    assert near_dedup.remove(clashing).columns == clashing.columns and near_dedup.remove(clashing).count() == 6


def test_registers_merge_and_estimate():
    rnd = np.random.default_rng(5)
    pool = np.unique(rnd.integers(0, 2**63, 3000, dtype=np.uint64))
    a, b = pool[:2000], pool[200:2200]
    s = near_dedup.registers([a, b, np.union1d(a, b), pool[:0]])
    assert (near_dedup.merged(s[0], s[1]) == s[2]).all() and not s[3].any()
    n = np.array([2000.0])
    assert near_dedup.possible(s[:1], s[1:2], n, n)[0]  # likeness 0.82
    far = near_dedup.registers([pool[1000:3000]])
    assert not near_dedup.possible(s[:1], far, n, n)[0]  # likeness 0.33


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102)], "a long, b long")
    got = {r["node"]: r["component"] for r in near_dedup.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_a_template_of_many_is_not_held_pair_by_pair(spark, docs_of, monkeypatch):
    # 240 texts of one template, likeness 0.74 to each other, and a near copy of every twelfth.
    rnd = random.Random(8)
    template = [f"t{i}" for i in range(160)]
    texts = [" ".join(template + [f"u{k}x{i}" for i in range(24)]) for k in range(240)]
    texts += [t + " more" for t in texts[::12]]
    rnd.shuffle(texts)
    seen, likely = [], near_dedup._likely
    monkeypatch.setattr(near_dedup, "_likely", lambda pairs, reps: seen.append(pairs.count()) or likely(pairs, reps))
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.link(docs_of(texts), SIZE).collect()}
    assert got == components_of(texts, SIZE)
    assert seen[-1] < 100


def test_linked_sets_share_a_prefix_key():
    rnd = np.random.default_rng(9)
    order = rnd.integers(0, 5, near_dedup.CELLS).astype(np.int32)
    for n in [*range(1, 40), 99, 100, 450, 1300]:
        for m in {n, -(-4 * n // 5), (9 * n) // 10 or 1, 5 * n // 4}:
            common = -(-4 * (n + m) // 9)
            if common <= min(n, m):
                pool = rnd.integers(0, 2**63, n + m - common, dtype=np.uint64)
                a, b = pool[:n], pool[n - common :]
                assert len(b) == m and np.intersect1d(near_dedup.prefix_keys(a, order)[0], near_dedup.prefix_keys(b, order)[0]).size


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    # Bucket 1: all meet; bucket 2: one component; bucket 3: two sides; bucket 4: one side alone.
    rows = [(1, 0, i, 0 if i < 10 else i // 2) for i in range(24)] + [(2, 0, 5, 0), (2, 0, 6, 0)]
    rows += [(3, 1 + i % 2, 100 + i, 100 if i < 5 else 100 + i // 3) for i in range(20)] + [(4, 1, 200 + i, 200 + i) for i in range(9)]
    members = spark.createDataFrame(rows, "bucket long, side int, rep long, component long")
    members = members.selectExpr("*", "1L AS size", "1L AS left")  # sizes rule nothing out
    got = near_dedup._crossing(members, near_dedup._groups(members)).collect()
    meet = [(a, b) for p, s, a, x in rows for q, t, b, y in rows if p == q and a < b and x != y and (s == 0 or s + t == 3)]
    assert sorted((r["a"], r["b"]) for r in got) == sorted(meet)
