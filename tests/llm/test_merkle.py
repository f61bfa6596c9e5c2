"""The manifest against trees built from plain lists."""

import hashlib
import random

import numpy as np
import pytest
from llm_samples import odd_texts
from pyspark.sql import functions as F

from seismic_lake.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves):
    """Root of a list, and each leaf's path to it."""
    paths, nodes, under = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        above, above_under = [], []
        for i in range(0, len(nodes), 8):
            run = nodes[i : i + 8]
            for k in range(len(run)):
                for leaf in under[i + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h("".join(run)))
            above_under.append([x for u in under[i : i + 8] for x in u])
        nodes, under = above, above_under
    return nodes[0], paths


def leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain(rows):
    import zlib

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, out = {}, []
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[g] = tree([leaf(r, r[1]) for r in groups[g]])
    root, tops = tree([trees[g][0] for g in langs])
    for g, top in zip(langs, tops, strict=True):
        for r, path in zip(groups[g], trees[g][1], strict=True):
            path = path + top
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            folded = leaf(r, r[1].translate({c: c + 32 for c in range(65, 91)}) if tampered and r[1] else r[1])
            for left, right in path:
                folded = h(left + folded + right)
            out.append((r[0], leaf(r, r[1]), trees[g][0], root, h("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(out, key=str)


def rows_of(n, langs):
    rnd = random.Random(n)
    odd = odd_texts()
    out = [(i, rnd.choice(odd[:9] + ["Upper", "lower é"]), rnd.choice(langs), rnd.choice(["s", None, "é"]), rnd.choice([None, 3])) for i in rnd.sample(range(9 * n), n)]
    return out + [(None, None, None, None, None), (None, "x", "en", None, 0), (7, "tie", "en", "s", 1), (7, "tie", "en", "s", 1), (7, "Tie2", "en", "s", 1)]


@pytest.mark.parametrize("n,langs", [(1, ["en"]), (300, ["en", "en", "en", "é", None, ""]), (90, [chr(c) for c in range(65, 145)]), (5000, ["en"])])
def test_report(spark, n, langs):
    rows = rows_of(n, langs)
    got = merkle.report(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


@pytest.mark.parametrize("height", [1, 2, 3])
def test_levels_of_blocks(spark, height):
    """Low blocks give many levels; the trees are the same, and every path folds to the root."""
    rows = rows_of(200, ["en", "en", "de"])
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    m = merkle.manifest(df, "lang", ["doc_id"], merkle.leaf_of([F.col(c) for c in merkle.COLUMNS]), {"doc_id": F.col("doc_id")}, height)
    proven = merkle.prove(m, with_path=True).collect()
    want = plain(rows)
    assert {m.root()} == {r[3] for r in want} and len(m.groups) == -(-merkle.height_of(205) // height)
    assert sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["proof_sha256"]) for r in proven) == sorted((str(r[0]), r[1], r[2], r[4]) for r in want)
    for r in proven:
        assert merkle.fold(r["leaf"], [tuple(p) for p in r["path"]]) == r["folded_root"] == m.root()


def test_one_leaf_is_its_root_and_nothing_has_none(spark, empty, clashing):
    got = merkle.report(spark.createDataFrame([(1, "a", "en", "s", 1)], SCHEMA)).first()
    assert got["leaf"] == got["subroot"] == got["root"] == got["folded_root"] and got["proof_sha256"] == h("")
    assert merkle.report(empty).collect() == []
    wide = clashing.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "g": F.lit(1), "i": F.lit(2), "leaf": F.lit("x")})
    assert merkle.report(wide).where("leaf is not null and root is not null").count() == clashing.count()


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses(levels):
    """Every node has a place of its own, and a subtree below the upper half lies in one stretch."""
    places = np.concatenate([merkle.address(d, np.arange(8**d), levels) for d in range(levels)])
    assert sorted(places) == list(range(merkle.nodes_of(levels)))
    top = levels // 2
    for subtree in range(8**top if levels > 1 else 0):
        own = np.concatenate([merkle.address(d, np.arange(8**d).reshape(8**top, -1)[subtree], levels) for d in range(top, levels)])
        assert own.max() - own.min() + 1 == len(own) == merkle.nodes_of(levels - top)
