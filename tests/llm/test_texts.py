"""Licence scan, fingerprints, decontamination, toxicity and personal data."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from llm_samples import shingle_set, words_of
from pyspark.sql import functions as F

from seismic_lake.llm import decontaminate, fingerprints, license_scan, pii, toxicity

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


# --- Licences ------------------------------------------------------------------------------------


def test_license_labels(spark, docs_of):
    texts = {
        "Released under the MIT License.": ("mit", "mit", 1, 3),
        "Licensed under the Apache License, Version 2.0.": ("apache", "apache,apache-2.0", 1, 3),
        "This work is licensed under the GNU General Public License, version 3.": ("gpl", "gpl,gpl-3.0", 1, 7),
        "Licensed under CC BY-NC 4.0.": ("", "cc-by-nc", 0, None),
        "MIT license mit LICENSE": ("mit", "mit", 2, 0),
        "SPDX-License-Identifier: Apache-2.0": ("", "apache-2.0", 0, None),
        "nothing here": ("", "", 0, None),
        "general public": ("", "", 0, None),
    }
    for r, (base, labels, n, first) in zip(license_scan.scan(docs_of(list(texts))).orderBy("doc_id").collect(), texts.values(), strict=True):
        assert (r["base_labels"], r["labels"], r["n_base"], r["first_word"]) == (base, labels, n, first)
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(labels)


def test_license_odd_rows(spark, odd, empty, clashing):
    rows = license_scan.scan(odd).collect()
    assert len(rows) == odd.count() and all(r["labels"] == "" and r["score"] == 0 for r in rows)
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    assert all(r["n_words"] == len(words_of(texts[r["doc_id"]], WORD)) for r in rows if r["doc_id"] is not None)
    assert license_scan.scan(empty).count() == 0 and license_scan.scan(clashing).count() == 6


# --- Fingerprints --------------------------------------------------------------------------------


def test_fingerprints_against_exact_likeness(spark, docs_of, odd, empty):
    rnd = random.Random(2)
    texts = [" ".join(f"w{rnd.randint(0, 5000)}" for _ in range(rnd.choice([3, 5, 60, 400, 900]))) for _ in range(60)]
    rows = fingerprints.fingerprint(docs_of(texts)).orderBy("doc_id").collect()
    errors = []
    for i, r in enumerate(rows):
        quarter, after = len(texts[i]) // 4, texts[(i + 1) % len(texts)]
        edited = texts[i][: len(texts[i]) - quarter] + after[:quarter]
        assert (r["n_chars"], r["edited_sha256"]) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        a, b = shingle_set(texts[i], 5), shingle_set(edited, 5)
        errors.append(r["near_edited"] - len(a & b) / len(a | b))
        assert 0 <= r["near_next"] < 0.1
    assert abs(sum(errors) / len(errors)) < 0.02 and max(map(abs, errors)) < 0.25


def test_fingerprint_odd_rows(spark, odd, empty, clashing):
    rows = fingerprints.fingerprint(odd).collect()
    assert len(rows) == odd.count()
    prints = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert prints[10] == prints[11] and prints[13] == prints[14] and prints[0] == prints[1] == ""
    assert fingerprints.fingerprint(empty).count() == 0 and fingerprints.fingerprint(clashing).count() == 6
    one = fingerprints.fingerprint(odd.where("doc_id = 12").limit(1)).first()
    assert one["near_next"] == 1.0


# --- Decontamination -----------------------------------------------------------------------------


def brute_hits(text, items):
    words, hit, found = words_of(text, WORD), set(), set()
    for ident, item in items:
        own = words_of(item, WORD)
        n = min(10, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words)):
            if tuple(words[i : i + n]) in windows and i + n <= len(words):
                hit |= set(range(i, i + n))
                found.add(ident)
    listed = ",".join(sorted(map(str, found)))
    return len(words), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest()


@pytest.mark.parametrize("block", [1 << 24, 300])
def test_decontamination_against_brute_force(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", (block,))
    rnd = random.Random(4)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 2, 5, 9, 10, 11, 30])))) for i in range(25)]
    items = [(i, t) for i, t in items if len(t.split()) != 1] + [(50, "Only"), (51, None), (52, "")]
    texts = [None, "", "only", "ONLY the only"]
    for _ in range(40):
        text = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        if rnd.random() < 0.5:
            text += (rnd.choice(items)[1] or "").upper().split()
        texts.append(rnd.choice([" ", ", ", "\n"]).join(text))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(texts)
    rows = decontaminate.report(docs, benchmark).orderBy("doc_id").collect()
    for r, text in zip(rows, texts, strict=True):
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == brute_hits(text, items)
        assert r["contaminated"] == (r["n_hit"] > 0)
    kept = {r["doc_id"] for r in decontaminate.remove(docs, benchmark).collect()}
    assert kept == {r["doc_id"] for r in rows if not r["contaminated"]}


def test_decontamination_odd_rows(spark, odd, empty, clashing):
    benchmark = spark.createDataFrame([(1, "tie tie tie")], "item_id long, text string")
    rows = decontaminate.report(odd, benchmark).collect()
    assert len(rows) == odd.count() and {r["doc_id"] for r in rows if r["contaminated"]} == {13, 14}
    assert decontaminate.report(empty, benchmark).count() == 0
    assert decontaminate.remove(odd, benchmark.limit(0)).count() == odd.count()
    assert decontaminate.remove(clashing, benchmark).columns == clashing.columns


# --- Toxicity ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tox(spark, docs_of):
    rnd = random.Random(6)
    bad, plain = ["grumblewort", "snarkface", "dolt"], [f"p{i}q" for i in range(60)]
    texts, labels = [], []
    for i in range(600):
        words = [rnd.choice(plain) for _ in range(40)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words[rnd.randint(0, 39)] = rnd.choice(bad)
        texts.append(" ".join(words) + f" d{i}")
        labels.append((i, int(toxic), 1))
    return docs_of(texts), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_toxic_documents_are_found_and_clean_ones_left(spark, tox, docs_of):
    docs, labels = tox
    model = toxicity.fit(docs, labels)
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    held = {r["doc_id"]: r["toxic"] for r in labels.collect() if rows[r["doc_id"]]["held_out"]}
    assert sum(rows[i]["predicted"] == t for i, t in held.items()) / len(held) > 0.98
    cases = ["you gruumblewort and snarkfice you", "he said “grumblewort and snarkface are words” once", "a fine day", None, ""]
    misspelled, quoted, fine, null, blank = (r["score"] for r in toxicity.score(docs_of(cases), model).orderBy("doc_id").collect())
    assert misspelled >= 0.7 > quoted > fine == null == blank
    assert {r["doc_id"] for r in toxicity.remove(docs, model).collect()} == {i for i, r in rows.items() if not r["predicted"]}


def test_a_clean_variant_excepts_itself_alone(spark, tox, docs_of):
    # Clean texts quote a term and hold one word an edit away from it.
    docs, labels = tox
    more = [i for i in range(9_000, 9_060) if zlib.crc32(str(i).encode()) % 3 != 1]
    extra = [(i, "p1q grumblework p2q p3q", "en", "src", 1) for i in more[1:]] + [(more[0], "p1q grumblewort p4q", "en", "src", 1)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    model = toxicity.fit(docs, labels.union(spark.createDataFrame([(i, 0, 1) for i in more], labels.schema)))
    hits = toxicity.Scanner(model.terms, model.spared)._is_hit
    assert hits(b"grumblewort") and hits(b"grumblewrt") and hits(b"snarkfice") and not hits(b"grumblework")


def test_edits_within_a_stem():
    scanner = toxicity.Scanner([("snark", False, True), ("dolt", False, True), ("grumble", True, True)], frozenset({"shark"}))
    for word, hit in {"snarking": 1, "snrking": 1, "xsnarked": 1, "xnarkish": 1, "snaark": 1, "shark": 0, "sharks": 1, "doltish": 1, "doptish": 0, "grumbel": 0, "grumbl": 1, "narky": 1}.items():
        assert scanner._is_hit(word.encode()) == bool(hit), word
        data = toxicity.np.frombuffer(word.encode(), dtype=toxicity.np.uint8)
        possible = scanner.lexicon.possible(data, toxicity.np.array([0]), toxicity.np.array([len(data)]))[0]
        assert possible or not hit, word


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_near_against_plain_edit_distance():
    rnd = random.Random(8)

    def some(least, most):
        return "".join(rnd.choice("abcé") for _ in range(rnd.randint(least, most)))

    terms = [(some(4, 9), rnd.random() < 0.6, rnd.random() < 0.9) for _ in range(25)]
    lexicon = toxicity.Lexicon(terms)
    loose = [(t, whole) for t, whole, fuzzy in terms if fuzzy and len(t) >= toxicity.FUZZY]
    met = {some(1, 12) for _ in range(4_000)}
    for term, _ in loose:
        for i in range(len(term) + 1):
            met |= {term[:i] + c + term[i:] for c in "ab"} | {term[:i] + term[i + 1 :], term[:i] + "c" + term[i + 1 :], term[:i] + "b" + term[i + 2 :] + "cab"}
    found = 0
    for word in met - {""}:
        ends = range(len(word) + 1)
        plain = any(edits(t, word) <= 1 if whole else any(edits(t, word[:k]) <= 1 for k in ends if abs(k - len(t)) < 2) for t, whole in loose)
        assert lexicon.near(word) == plain, word
        found += plain
        data = toxicity.np.frombuffer(word.encode(), dtype=toxicity.np.uint8)
        possible = lexicon.possible(data, toxicity.np.array([0]), toxicity.np.array([len(data)]))[0]
        assert possible or not (plain or lexicon.exact(word)), word
    assert 200 < found < len(met)


def test_words_are_cut_at_unicode_letters_and_digits():
    texts = ["“Grumblewort” one’s—two… „drei“ vier_fünf", None, "", "ÀÉ٣ x\u0301 हिन्दी 😀seven", "a" * 5000]
    got = list(toxicity.word_sets(pa.array(texts)))
    assert got[0] == {"grumblewort", "one", "s", "two", "drei", "vier", "fünf"}
    assert got[1] == got[2] == set() and got[3] == {"àé٣", "x\u0301", "हिन्दी", "seven"} and got[4] == {"a" * 5000}


@pytest.mark.parametrize(
    ("text", "weight"),
    [
        ("you grumblewort there", 1.0),
        ("“grumblewort” it was", toxicity.QUOTED),
        ("a “so grumblewort” it was", toxicity.QUOTED),
        ("„grumblewort“ it was", toxicity.QUOTED),
        ("«grumblewort» it was", toxicity.QUOTED),
        ('so "grumblewort" it was', toxicity.QUOTED),
        ("“grumblewrt” it was", toxicity.QUOTED),
        ("“unclosed grumblewort there", 1.0),
        ("grumblewort’s fault", 1.0),
        ("you—grumblewort—there", 1.0),
        ("you grumblewort…", 1.0),
        ("you grumblewrt…", 1.0),
        ("it is ab there", 1.0),
        ("x" * 60 + " fine", 1.0),
        ("a fine day", 0.0),
    ],
)
def test_marks_around_a_term(text, weight):
    scanner = toxicity.Scanner([("grumblewort", True, True), ("ab", True, True), ("x" * 60, True, True)])
    assert scanner.weights(pa.array([text])).tolist() == [weight]


def test_a_text_labelled_twice_is_toxic(spark, docs_of):
    docs = docs_of(["same", "same", "other"])
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = docs.withColumn("doc_id", F.element_at(F.array(*[F.lit(i) for i in ids[:3]]), (F.col("doc_id") + 1).cast("int")))
    rows = [(ids[0], 0, 1), (ids[1], 1, 1), (ids[2], 0, 1), (ids[2], 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int, quality int")
    assert {(r["text"], r["toxic"]) for r in toxicity.training(docs, labels).collect()} == {("same", 1), ("other", 1)}


def test_toxicity_odd_rows(spark, tox, odd, empty, clashing):
    model = toxicity.fit(*tox)
    assert toxicity.score(odd, model).count() == odd.count() and toxicity.score(empty, model).count() == 0
    assert toxicity.remove(clashing, model).columns == clashing.columns and toxicity.remove(clashing, model).count() == 6
    untrained = toxicity.fit(empty, tox[1])
    assert toxicity.remove(odd, untrained).count() == odd.count()


def test_labels_of_held_out_rows_are_not_read(spark, tox):
    docs, labels = tox
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, flipped)


# --- Personal data -------------------------------------------------------------------------------


def plain_spans(text):
    def digits(s):
        return re.sub(r"[^0-9]", "", s)

    def luhn(d):
        return sum(int(c) if k % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for k, c in enumerate(reversed(d))) % 10 == 0

    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15],
    }


def test_base_spans_against_the_patterns():
    rnd = random.Random(8)
    for _ in range(20_000):
        text = "".join(rnd.choice("ab1234567890@@..-+ () _%é") for _ in range(rnd.randint(0, 70)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_disguises_map_back_to_the_source():
    cases = {
        "mail john.doe at mail dot example dot com now": ("email", "john.doe at mail dot example dot com"),
        "mail john[at]mail[dot]com now": ("email", "john[at]mail[dot]com"),
        "mail jоhn@mаil.com now": ("email", "jоhn@mаil.com"),
        "mail j​ohn@mail.com now": ("email", "j​ohn@mail.com"),
        "call plus one four two five five five five nine six eight four ok": ("phone", "plus one four two five five five five nine six eight four"),
        "ip one nine two dot one six eight dot one dot one end": ("ip", "one nine two dot one six eight dot one dot one"),
        "card ４５３９ ５７８７ ６３６２ １４８６ end": ("card", "４５３９ ５７８７ ６３６２ １４８６"),
    }
    for text, (kind, found) in cases.items():
        spans = pii.find(text)[1][kind]
        assert found in [text[a:b] for a, b in spans], text
        assert found not in pii.redacted(text) and pii.redacted(text).split()[0] == text.split()[0]
    for clean in ("look at google.com", "meet me at the station", "one two three", "at dot at dot", "a at b", "Ⅷ é ñ 漢字"):
        assert not any(pii.find(clean)[1].values()) and pii.redacted(clean) == clean


def test_disguises_are_found_whatever_else_a_text_holds():
    cases = {
        "email": ["john ( at ) example.com", "john [ at ] example.org", "john@example(punkt)de", "john at example[point]com", "john{at\t}example{ dot }com", "john @ Punkt"],
        "ip": ["one dot two dot three dot four", "one dot two dot three dot four five", "One point two point three point four"],
    }
    for kind, texts in cases.items():
        for text in texts:
            alone, beside = (pii.find(f"by {text} now{more}")[1] for more in ("", " \u2019"))
            assert alone == beside
            assert [f"by {text} now"[a:b] for a, b in alone[kind]] == ([] if text.endswith("@ Punkt") else [text]), text


def test_long_runs_are_linear():
    for text in ("9" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "a" * 300_000 + "@"):
        pii.find(text)


def test_pii_rows(spark, odd, empty, clashing, docs_of):
    rows = pii.report(odd).collect()
    assert len(rows) == odd.count() and all(r["spans"] == "" for r in rows)
    [r] = pii.report(docs_of(["é a@b.co +1 (425) 555-9684"])).collect()
    listed = "email:2:8,phone:9:26"
    assert (r["n_email"], r["n_phone"], r["spans"], r["base_sha256"]) == (1, 1, listed, hashlib.sha256(listed.encode()).hexdigest())
    [r] = pii.redact(docs_of(["é a@b.co!"])).collect()
    assert (r["text"], r["n_chars"]) == ("é [EMAIL]!", 10)
    assert pii.report(empty).count() == 0 and pii.redact(clashing).columns == clashing.columns
    assert pii.redact(odd).where("text IS NULL").count() == 2
