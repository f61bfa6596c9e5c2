"""Odd texts, and plain versions to hold operators against."""

import random
import re


def words_of(text, pattern):
    return re.findall(pattern, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingle_set(text, size):
    words = words_of(text, r"[^\x20\x09-\x0D]+")
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def components_of(texts, size):
    sets = [shingle_set(t, size) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in range(len(texts))}


def sentence(rnd: random.Random, n: int) -> str:
    return " ".join("".join(rnd.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def odd_texts() -> list[str | None]:
    rnd = random.Random(7)
    long_ = sentence(rnd, 30_000)
    return [
        None, "", " ", "\n\n", "word", "A", "one two three", "é ü ñ 漢字", "a  b\t c", "x" * 5000,
        long_, long_, sentence(rnd, 40), "tie tie tie tie tie tie tie tie tie tie tie tie", "tie tie tie tie tie tie tie tie tie tie tie tie",
        "😀 emoji 😀", "<|endoftext|> a  <|endoftext|>b", "\x00 nul \x1f",
    ]
