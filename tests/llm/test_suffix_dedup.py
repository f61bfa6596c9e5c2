import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_samples import sentence

from seismic_lake.llm import suffix_dedup
from seismic_lake.llm.suffix_dedup import LENGTH, Stretches


def plain(texts):
    """(bytes, removed, runs, digest) of each text by comparing all windows."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + LENGTH] for r in raw for i in range(len(r) - LENGTH + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - LENGTH + 1):
            if seen[r[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(r, gone, strict=False) if not g)
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed):
    rnd = random.Random(seed)
    shared = [sentence(rnd, n) for n in (70, 90, 120, 200)] + ["ab" * 300, "é" * 250]
    texts = [None, "", "short", "x" * 399, "x" * 1000, sentence(rnd, 100)]
    for _ in range(40):
        text = [sentence(rnd, rnd.randint(0, 120))]
        for _ in range(rnd.randint(0, 3)):
            text += [rnd.choice(shared), sentence(rnd, rnd.randint(0, 30))]
        texts.append(" ".join(text))
    return texts + [texts[-1], texts[-2], texts[5]]


@pytest.mark.parametrize("hot", [1500, 2])
def test_against_all_windows(spark, docs_of, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)  # 2: common passages are split by longer grams
    texts = passages(1)
    rows = suffix_dedup.report(docs_of(texts)).orderBy("doc_id").collect()
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows] == plain(texts)


def test_suffix_array_and_common_prefixes():
    rnd = random.Random(2)
    for alphabet in (b"ab", b"a", bytes(range(256))):
        parts = [bytes(rnd.choice(alphabet) for _ in range(rnd.randint(1, 700))) for _ in range(4)] * 2
        s = Stretches(parts)
        own = [s.data[i : s.end[i]].tobytes() for i in range(s.n)]
        order = s.order.tolist()
        assert sorted(order) == list(range(s.n))
        assert all(own[a][:LENGTH] <= own[b][:LENGTH] for a, b in zip(order, order[1:], strict=False))
        for slot, shared in enumerate(s.common().tolist()):
            if slot:
                a, b = own[order[slot - 1]], own[order[slot]]
                n = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
                assert shared == min(n, LENGTH)


def test_blocks_are_merged_by_search():
    texts = [t for t in passages(3) if t]
    rows = [(i, 0, t.encode()) for i, t in enumerate(texts)]

    def bytes_of(spans):
        return {(u, k) for u, a, b in spans for k in range(a, b)}

    assert bytes_of(suffix_dedup.shard_spans(rows)) == bytes_of(suffix_dedup.shard_spans(rows, block_bytes=3000))


def test_odd_rows(spark, odd, empty, clashing):
    rows = suffix_dedup.report(odd).collect()
    texts = [r["text"] for r in odd.collect()]
    assert Counter((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows) == Counter(plain(texts))
    assert suffix_dedup.report(empty).count() == 0 and suffix_dedup.report(clashing).count() == 6


def test_a_window_is_in_one_region():
    texts = [t.encode() for t in passages(4) if t and len(t.encode()) >= LENGTH] + [b"abc" * 500]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    for gram in suffix_dedup.GRAMS:
        _, _, start, end = suffix_dedup.anchors(data, offsets, gram)
        windows = [w for a, b in zip(start.tolist(), end.tolist(), strict=True) for w in range(a, b - LENGTH + 1)]
        inside = [w for a, b in zip(offsets, offsets[1:], strict=False) for w in range(a, b - LENGTH + 1)]
        assert windows == inside


@pytest.mark.parametrize("unit", ["x", "ab", "Retionly "])
def test_a_run_of_one_unit_is_told_in_its_text(spark, docs_of, unit):
    """However long the run, it sends a few regions on."""
    rnd = random.Random(5)
    head, tail = sentence(rnd, 10), sentence(rnd, 10)
    sent = {}
    for n in (2000, 20_000):
        docs = docs_of([f"{head} {unit * (n // len(unit))} {tail}"]).selectExpr("doc_id", "text", "unhex(md5(text)) AS text_key")
        (row,) = suffix_dedup._from_texts(docs).collect()
        sent[n] = len(row["anchor"])
        ((a, b),) = zip(row["from"], row["to"], strict=True)
        assert b - a >= n - len(unit) - 1
    assert sent[2000] == sent[20_000] < 20
