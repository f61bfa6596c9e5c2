"""Byte-level BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from llm_samples import odd_texts, sentence
from tokenizers import Tokenizer

from seismic_lake.llm import bpe

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    return bpe.Bpe(BYTE), Tokenizer.from_file(BYTE)


def fuzz():
    rnd = random.Random(11)
    texts = odd_texts() + ["\nx\ny z\n", "a \n b", "don't  we'll\t\t a's", "thé Été, ÿþ. ıİ", "a\x85b", " \x1cab ᠎b ​c", "²³ ½ª º\xa0µ \xa0x"]
    texts += ["".join(rnd.choice("ab'sé1 \n\t .-Σ<|\x1c　́漢٣Ⅷ") for _ in range(60)) for _ in range(400)]
    texts += ["".join(chr(rnd.randrange(256)) for _ in range(50)) for _ in range(400)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(160, 12288), rnd.randrange(65536, 131072)])) for _ in range(50)) for _ in range(400)]
    return texts + [sentence(rnd, 400) for _ in range(10)]


def test_ids_and_texts_as_the_library_has_them(both, monkeypatch):
    own, library = both
    monkeypatch.setattr(bpe, "MEMO", 50)  # forgets often
    for text in fuzz():
        ids = library.encode(text or "", add_special_tokens=False).ids
        got = own.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == ids, text
        assert own.decode(got) == library.decode(ids, skip_special_tokens=False) == (text or "")


@pytest.mark.parametrize("n", [1, 2, bpe.SCANNED, bpe.SCANNED + 1, 2000])
def test_scanned_and_heaped_words_merge_alike(both, n):
    own, library = both
    rnd = random.Random(n)
    for letters in ("a", "ab", "the", "etaoinshrdlu", "-=_"):
        word = "".join(rnd.choice(letters) for _ in range(n))
        assert own.merge(word) == library.encode(word, add_special_tokens=False).ids
        assert own._merge_long([own.vocabulary[c] for c in word]) == own.merge(word)


def test_any_ids_decode_as_the_library_does(both):
    own, library = both
    rnd = random.Random(5)
    for _ in range(500):
        ids = [rnd.randrange(50_300) for _ in range(20)]  # broken UTF-8, and ids that are no token
        assert own.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_tables(spark, both, odd, empty, clashing):
    library = both[1]
    for docs in (odd, clashing):
        want = []
        for r in docs.collect():
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            want.append((r["doc_id"], len(ids), *[hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), (r["text"] or "").encode())]))
        assert sorted(map(tuple, bpe.report(docs, BYTE).collect()), key=str) == sorted(want, key=str)
    assert bpe.report(empty, BYTE).count() == 0
    encoded = bpe.encode(odd, BYTE)
    assert encoded.columns == ["doc_id", "n_tokens", "ids"] and bpe.decode(encoded, BYTE).where("decoded is null").count() == 0
