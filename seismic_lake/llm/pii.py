"""Personal data in texts, disguised forms included, with spans in the source.

Base detectors read the text as it is. A second pass reads it through transducers that undo disguises and
remember where each character came from: look-alike and full-width characters become ASCII, invisible
ones go, "[at]" or " at ... dot " become the signs, runs of spelled digits become digits. Identifiers
found there that hold a changed character are mapped back to source positions and added, unless a base
span of their kind holds them already. The transducers' own patterns are looked for in every text; only texts
that none of them changes skip the second pass.

Positions are code points, end exclusive. NULL and empty texts have no spans; repeated rows are read each
by itself; other columns, whatever their names, pass through :func:`redact` untouched except ``n_chars``,
which is counted anew.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns. A match begins at a run's first digit, so the look-behind
# changes no match and keeps long runs linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Letters of other scripts that look like a Latin one.
LOOKALIKE = str.maketrans(
    "АВЕЗКМНОРСТУХЅІЈԌԚԜаеорсухѕіјһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορυικ",
    "ABE3KMHOPCTYXSIJGQWaeopcyxsijhdqwABEZHIKMNOPTYXavopuik",
)
INVISIBLE = frozenset("­​‌‍⁠﻿")
# Names of the digits.
DIGITS = {w: str(n) for n, w in enumerate("zero one two three four five six seven eight nine".split())}

NUMBER = "(?:" + "|".join(DIGITS) + ")"
RUN = re.compile(rf"(?<![A-Za-z0-9])(?:plus[ ,-]+)?{NUMBER}(?:(?:[ ,-]+| ?- ?)(?:{NUMBER}|dot|point|dash)(?![A-Za-z0-9])){{6,}}", re.I)
SPELLED = re.compile(rf"{NUMBER}|dot|point|dash|plus", re.I)
OPEN, CLOSE = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
DOT = rf"(?:{OPEN}(?:dot|punkt|point){CLOSE}|[ \t](?:dot|punkt)[ \t])"
DISGUISED = re.compile(
    rf"(?P<at>{OPEN}(?:at|@){CLOSE}|[ \t]at[ \t](?=[A-Za-z0-9-]{{1,63}}{DOT})|@)(?P<domain>[A-Za-z0-9-]{{1,63}}(?:(?:{DOT}|\.)[A-Za-z0-9-]{{1,63}})+)", re.I
)
DOT_SIGN = re.compile(DOT, re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, by the '@' signs: a match's local part is the run before one."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out: dict[str, list[tuple[int, int]]] = {"email": emails(text) if "@" in text else []}
    out["ip"] = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    out["card"] = []
    for m in CARD.finditer(text):
        if len(m[0]) >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
    out["phone"] = []
    if "+" in text:
        out["phone"] = [m.span() for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


class Tape:
    """Text under rewriting: each character's source span, and whether it was changed."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.begin, self.end, self.changed = list(range(len(text))), list(range(1, len(text) + 1)), [False] * len(text)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace stretches, given in order; what comes in stands for the whole stretch."""
        if not edits:
            return
        text, begin, end, changed, last = [], [], [], [], 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            text.append(self.text[last:a] + new)
            begin += self.begin[last:a] + [self.begin[a]] * len(new) if new else self.begin[last:a]
            end += self.end[last:a] + [self.end[b - 1]] * len(new) if new else self.end[last:a]
            changed += self.changed[last:a] + [True] * len(new)
            last = b
        self.text, self.begin, self.end, self.changed = "".join(text), begin, end, changed


def _fold(char: str) -> str:
    if char in INVISIBLE:
        return ""
    plain = char.translate(LOOKALIKE)
    if plain == char:
        plain = unicodedata.normalize("NFKC", char)
        if not plain.isascii():
            digit = unicodedata.digit(char, None)
            plain = str(digit) if digit is not None else char
    return plain if plain.isascii() and len(plain) <= 1 else char


def _folded(text: str) -> list[tuple[int, int, str]]:
    if text.isascii() or max(text) <= "ɏ" and "\u00ad" not in text:
        return []
    return [(i, i + 1, new) for i, c in enumerate(text) if (c > "ɏ" or c == "­") and (new := _fold(c)) != c]


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Runs of spelled digits; a sign stands for its word, blanks between digits go."""
    edits = []
    for run in RUN.finditer(text):
        at = run.start()
        for word in SPELLED.finditer(text, run.start(), run.end()):
            name = word[0].lower()
            sign = DIGITS.get(name) or {"plus": "+", "dash": "-"}.get(name, ".")
            edits.append((at, word.end(), sign))
            at = word.end()
    return edits


def _signs(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in DISGUISED.finditer(text):
        if m["at"] != "@":
            edits.append((*m.span("at"), "@"))
        edits += [(*d.span(), ".") for d in DOT_SIGN.finditer(text, *m.span("domain"))]
    return edits


def added_spans(text: str, base: dict[str, list[tuple[int, int]]]) -> dict[str, list[tuple[int, int]]]:
    """Spans of disguised identifiers, in the source."""
    tape = None
    for step in (_folded, _spelled, _signs):
        if edits := step(tape.text if tape else text):
            tape = tape or Tape(text)
            tape.rewrite(edits)
    if tape is None:
        return {}
    if not any(tape.changed) and len(tape.text) == len(text):
        return {}
    out = {}
    for kind, spans in base_spans(tape.text).items():
        for a, b in spans:
            start, end = tape.begin[a], tape.end[b - 1]
            if (any(tape.changed[a:b]) or end - start > b - a) and not any(s <= start and end <= e for s, e in base[kind]):
                out.setdefault(kind, []).append((start, end))
    return out


def find(text: str | None) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """Base spans and all spans, by kind, in order."""
    if not text:
        empty = {k: [] for k in KINDS}
        return empty, empty
    base = base_spans(text)
    added = added_spans(text, base)
    return base, {k: sorted({*base[k], *added.get(k, [])}) for k in KINDS}


def listed(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def report(documents: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans."""
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find(text) for text in batch.column("text").to_pylist()]
            counts = [pa.array([len(base[k]) for base, _ in found], pa.int64()) for k in KINDS]
            digest = pa.array([hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found], pa.string())
            spans = pa.array([listed(all_) for _, all_ in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, digest, spans], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return documents.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {id_type}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )


def redacted(text: str | None) -> str | None:
    """The text with each span (overlapping ones as one) replaced by its kind in brackets."""
    _, spans = find(text)
    out, last = [], 0
    merged: list[list] = []
    for a, b, kind in sorted((a, b, k) for k in KINDS for a, b in spans[k]):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, kind])
    if not merged:
        return text
    for a, b, kind in merged:
        out.append(f"{text[last:a]}[{kind.upper()}]")
        last = b
    return "".join(out) + text[last:]


def redact(documents: DataFrame) -> DataFrame:
    """All rows and columns, personal data in ``text`` replaced."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [redacted(t) for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            if (at := batch.schema.get_field_index("n_chars")) >= 0:
                sizes = [None if t is None else len(t) for t in texts]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(sizes, batch.schema.field(at).type))
            yield batch

    return documents.mapInArrow(clean, documents.schema)
