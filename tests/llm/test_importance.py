"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib

import pytest
from llm_samples import sentence

from seismic_lake.llm import importance

SCHEMA = "doc_id long, text string"


def plain(docs, target, share, longest, buckets, least_words, seed=2024, unit=1000):
    """Rows (doc_id, n_features, weight, score) and the drawn ones' places, with all rows in one list."""

    def found(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for b in found(text)[1]:
                counts[b] += 1
    gain = [math.floor(unit * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        n, own = found(text)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        rows.append((doc_id, len(own), weight, weight + math.floor(-unit * math.log(-math.log((h + 0.5) / 2**32))), n))
    order = sorted((r for r in rows if r[4] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = order[: share[0] * len(order) // share[1]]
    return sorted([(*r[:4], None) for r in rows], key=str), [r[:4] for r in drawn]


def texts(rnd, n):
    return [sentence(rnd, rnd.randint(0, 60)) for _ in range(n)]


@pytest.mark.parametrize("share,longest,buckets,least", [((10, 100), 1, 10_000, 20), ((1, 2), 2, 64, 1), ((1, 1), 3, 7, 0), ((1, 1000), 1, 50, 20)])
def test_against_a_plain_version(spark, share, longest, buckets, least):
    rnd = random.Random(longest)
    docs = list(enumerate(texts(rnd, 120))) + [(500, None), (501, ""), (502, "É é ÀB c3PO!"), (7, "tie " * 30), (None, "no id " * 20), (503, "word " * 20_000)]
    docs += [(9, "same " * 25)] * 9  # rows that repeat an id and a score
    target = [*texts(rnd, 10), None, ""]
    got = importance.resample(
        spark.createDataFrame(docs, SCHEMA).repartition(5), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"),
        share, longest, buckets, least,
    ).collect()
    rows, drawn = plain(docs, target, share, longest, buckets, least)
    assert sorted([(*tuple(r)[:4], None) for r in got], key=str) == rows
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [tuple(r)[:4] for r in ranked] == drawn


def test_empty_tables_and_other_columns(spark, empty, clashing):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(empty, nothing).count() == 0
    got = importance.resample(clashing, nothing, share=(1, 1), least_words=0)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, clashing.count() + 1))


def test_cutoff_counts(spark):
    rnd = random.Random(3)
    values = [(rnd.randint(-3, 3), rnd.choice([-(2**62), 0, 2**62]), i) for i in range(200)]
    rows, order = spark.createDataFrame(values, "a long, b long, c long"), sorted(values)
    for wanted in (1, 2, 50, 199, 200):
        assert tuple(importance.cutoff(rows, ["a", "b", "c"], wanted)) == order[wanted - 1]
    assert rows.where(importance.up_to(["a", "b", "c"], list(order[77]))).count() == 78
