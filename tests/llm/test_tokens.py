"""Token files, token counts, packing, and what they share."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_samples import odd_texts, sentence
from tokenizers import Tokenizer

from seismic_lake.llm import encoder, packing, token_counts, token_files

BYTE, WORDS, PIECES = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


@pytest.mark.parametrize("make,path", [(encoder.byte_bpe, BYTE), (encoder.word_bpe, WORDS)])
def test_pieces_encode_as_whole_texts(make, path, monkeypatch):
    monkeypatch.setattr(encoder, "MEMO", 500)  # forgets often
    rnd = random.Random(1)
    texts = odd_texts() + ["\nx\ny z\n", "a \n b", "don't  we'll\t\t a's", "thé Été, ÿþ. ıİ ŉ Ça,b; I", "Á ́x Ⅷ ǅ ΑΣ Σ", "​ x　y", "a\x85b"]
    texts += ["".join(rnd.choice("ab'sé1 \n\t .-Σ<|") for _ in range(60)) for _ in range(300)] + [sentence(rnd, 300) for _ in range(20)]
    own, whole = make(path), Tokenizer.from_file(path)
    for k in range(0, len(texts), 37):
        batch = texts[k : k + 37]
        ids, at = own.batch(batch)
        for i, text in enumerate(batch):
            assert ids[at[i] : at[i + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_planes_round_trip(planes):
    rnd = np.random.default_rng(3)
    for ids in ([0], [1, 0, 50256], rnd.integers(0, 2**32, 999), rnd.integers(0, 50257, 65536), [2**32 - 1]):
        ids = np.array(ids, dtype=np.uint32)
        width, raw = token_files.to_planes(ids, planes)
        assert (token_files.from_planes(width, raw, len(ids)) == ids).all()


def test_checksums_of_stretches_join():
    rnd = random.Random(2)
    for _ in range(50):
        a, b = (rnd.randbytes(rnd.randint(0, 3000)) for _ in range(2))
        assert token_files.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_files_read_back_in_order(spark, odd, empty, tmp_path):
    whole, start = Tokenizer.from_file(BYTE), 0
    for planes in ("bit", "byte"):
        path = str(tmp_path / planes)
        token_files.write(odd, path, BYTE, planes, chunk=64)  # documents cross many chunks
        got = token_files.read(spark, path).orderBy("start").collect()
        rows = sorted(odd.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or ""))
        start = 0
        for r, row in zip(got, rows, strict=True):
            ids = whole.encode(row["text"] or "", add_special_tokens=False).ids + [2]
            assert (r["doc_id"], r["start"], r["n_tokens"]) == (row["doc_id"], start, len(ids))
            assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
            start += len(ids)
    token_files.write(empty, str(tmp_path / "none"), BYTE)
    assert token_files.read(spark, str(tmp_path / "none")).count() == 0


def best_split(word, scores):
    """Best (score, minus tokens) by trying every piece at every place."""
    table = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        options = []
        if word[end - 1] not in scores:
            n = len(word[end - 1].encode())
            options.append((table[end - 1][0] + n * token_counts.BYTE, table[end - 1][1] - n))
        options += [(table[b][0] + scores[word[b:end]], table[b][1] - 1) for b in range(end) if word[b:end] in scores]
        table[end] = max(options)
    return table[-1]


def test_counts_against_every_split(spark, odd, empty, clashing, docs_of, monkeypatch):
    scores, longest = token_counts.vocabulary(PIECES)
    assert longest == max(map(len, scores))
    rows = token_counts.count(odd, PIECES).collect()
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    for r in rows:
        if r["doc_id"] is None:
            continue
        words = [token_counts.MARK + w for w in (texts[r["doc_id"]] or "").split()]
        best = {w: best_split(w, scores) for w in set(words)}
        assert r["n_pretokens"] == len(words) and r["n_tokens"] == -sum(best[w][1] for w in words)
        assert abs(r["log_probability"] - sum(best[w][0] for w in words)) < 1e-6 * (1 + len(words))
    monkeypatch.setattr(token_counts, "NODES", 10)
    trie = token_counts.Trie(scores, longest)
    assert trie.best("▁there") == best_split("▁there", scores) == trie.best("▁there")
    assert token_counts.count(empty, PIECES).count() == 0 and token_counts.count(clashing, PIECES).count() == 6


def test_long_pretokens_are_not_kept(monkeypatch):
    scores, longest = token_counts.vocabulary(PIECES)
    rnd = random.Random(12)
    trie = token_counts.Trie(scores, longest)
    for size in (token_counts.LONG - 1, token_counts.LONG, 3000):
        word = token_counts.MARK + "".join(rnd.choice(["the", "ing", "q", "漢", "1"]) for _ in range(size))[:size]
        assert trie.best(word) == best_split(word, scores) == trie.best(word)
    assert len(trie.nodes) + len(trie.words) <= 2 * token_counts.LONG
    monkeypatch.setattr(token_counts, "NODES", 200)
    for _ in range(300):  # the words of one text
        word = token_counts.MARK + sentence(rnd, 1)
        assert trie.best(word) == best_split(word, scores)
        assert len(trie.nodes) + len(trie.words) <= 200 + token_counts.LONG + 1


def valid(patterns, counts, capacity):
    placed = Counter()
    for times, content in patterns:
        assert times > 0 and sum(x * n for x, n in content) <= capacity
        for x, n in content:
            placed[x] += times * n
    assert placed == Counter({x: n for x, n in counts.items() if n})


def fewest(lengths, capacity):
    """Sequences of a best packing, by trying everything."""
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms)}.values():
            if rooms[k] >= lengths[i]:
                go(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1 :])
        go(i + 1, [*rooms, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    go(0, [])
    return best


def test_reduction_keeps_a_best_packing():
    rnd = random.Random(9)
    for _ in range(150):
        capacity = rnd.choice([10, 17, 30])
        counts = Counter(rnd.randint(1, capacity) for _ in range(rnd.randint(1, 9)))
        fixed, left = packing.reduce(dict(counts), capacity)
        rest = [x for x, n in left.items() for _ in range(n)]
        assert sum(t for t, _ in fixed) + (fewest(rest, capacity) if rest else 0) == fewest(list(counts.elements()), capacity)
        valid(packing.plan(dict(counts), capacity), counts, capacity)


def test_many_alike_are_packed_at_once():
    counts = {2048: 5, 1500: 10**9, 548: 10**9, 700: 7, 3: 10**6}
    patterns = packing.plan(dict(counts))
    valid(patterns, counts, 2048)
    assert len(patterns) < 50


def test_pieces_have_places(spark, odd, empty, clashing):
    rows = packing.pack(odd, WORDS).collect()
    whole, want = Tokenizer.from_file(WORDS), Counter()
    for r in odd.collect():
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            want[r["doc_id"], k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        own.sort()
        assert all(a + n == b for (a, n), (b, _) in zip([(0, 0), *own], own, strict=False)) and sum(n for _, n in own) <= 2048
    assert packing.pack(empty, WORDS).count() == 0 and packing.pack(clashing, WORDS).count() == 6
