"""Token ids by a file of the tokenizers library, each distinct piece of text encoded once per task.

Both vocabularies used here cut text before anything is merged, and a cut always falls before a space
that a non-space follows (byte-level pieces keep the space, word pieces drop it). So a text's ids are
the ids of its pieces between such spaces, laid end to end; ``tests/llm`` hold that against the library
on whole texts. Texts that hold a special token are given to the library whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

MEMO = 700_000  # pieces remembered; then those met less than thrice go. Bounds memory, changes no result
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")  # a word and its stops: two units of either vocabulary

OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x00\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


class _Numbers(dict):
    """Numbers for keys in order of appearance."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


class Encoder:
    """``keeps_space``: a piece starts with the space before it (byte level)."""

    def __init__(self, path: str, keeps_space: bool, special: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.space, self.special = " " if keeps_space else "", special
        self.model = self.tokenizer.model
        self.stops: dict[str, list[int]] = {}
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level text: bytes as printable characters
        self.shown = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in visible)}
        self.cut = re.compile(r" (?=\S)")
        self.blank = re.compile(r"[ \t\n\r]+")
        self._start()

    def _start(self) -> None:
        self.numbers = _Numbers()
        self.met = np.zeros(1 << 16, dtype=np.int64)
        self.pool = np.zeros(1 << 20, dtype=np.uint32)
        self.at = np.zeros(1 << 16, dtype=np.int64)
        self.count, self.used = 0, 0

    def _forget(self) -> None:
        numbers, pool, at = self.numbers, self.pool, self.at
        keep = np.flatnonzero(self.met[: self.count] >= 3)[: MEMO // 2]
        self._start()
        keys = list(numbers)
        for k in keep.tolist():
            self.numbers[keys[k]] = len(self.numbers)
        if len(keep):
            self._add(np.concatenate([pool[at[k] : at[k + 1]] for k in keep.tolist()]), at[keep + 1] - at[keep])

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.count + len(lengths) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
            self.met = np.concatenate([self.met, np.zeros_like(self.met)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.at[self.count + 1 : self.count + len(lengths) + 1] = self.used + np.cumsum(lengths)
        self.count += len(lengths)
        self.used += len(ids)

    def _units(self, text: str) -> list[int]:
        """Ids of one unit of the vocabulary's own cutting, by the library's merges."""
        shown = text.encode().decode("latin-1").translate(self.shown)
        return [t.id for t in self.model.tokenize(shown)]

    def _piece(self, piece: str | tuple[str]) -> list[int]:
        if isinstance(piece, tuple):  # the start of a text, with nothing before it
            return self.tokenizer.encode(piece[0], add_special_tokens=False).ids
        if piece.startswith("\n"):
            return self.line + self._after("", piece[1:])
        return self._after(self.space, piece)

    def _after(self, space: str, piece: str) -> list[int]:
        plain = PLAIN.fullmatch(piece)
        if not plain:
            return self.tokenizer.encode(space + piece, add_special_tokens=False).ids
        word, stops = plain.groups()
        if not stops:
            return self._word(space, word)
        if stops not in self.stops:
            self.stops[stops] = self._units(stops)
        known = self.numbers.get(word, self.count) if space == self.space else self.count
        ids = self._word(space, word) if known >= self.count else self.pool[self.at[known] : self.at[known + 1]].tolist()
        return ids + self.stops[stops]

    def _word(self, space: str, word: str) -> list[int]:
        if not self.space:
            word = word.lower()
        if word.isascii():
            return [t.id for t in self.model.tokenize("Ġ" + word if space else word)]
        return self._units(space + word)

    def _learn(self) -> None:
        new, self.numbers.new = self.numbers.new, []
        if new:
            each = [self._piece(p) for p in new]
            self._add(np.array([i for ids in each for i in ids], dtype=np.uint32), np.array([len(x) for x in each]))

    def _pieces(self, text: str) -> list:
        """A piece stands for the space before it, or starts with its line break; the first one is a tuple."""
        if not self.space:
            return [p for p in self.blank.split(text) if p]
        first, *rest = self.cut.split(text) if self._odd(text) else text.replace("\n", " \n").split(" ")
        return [(first,), *rest] if first else rest

    @staticmethod
    def _odd(text: str) -> bool:
        """White space in runs, at an end, or other than a space and a line break."""
        if text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return True
        return any(c in text for c in (OTHER_SPACE[:9] if text.isascii() else OTHER_SPACE))

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts laid end to end, and each text's first place (with a last entry)."""
        if len(self.numbers) > MEMO:
            self._forget()
        numbers: list[int] = []
        ends, wholes = [0], {}
        get = self.numbers.__getitem__
        for k, text in enumerate(texts):
            if text and self.special in text:
                wholes[k] = self.whole(text)
            elif text:
                numbers.extend(map(get, self._pieces(text)))
            ends.append(len(numbers))
        self._learn()
        which = np.array(numbers, dtype=np.int64)
        seen = np.bincount(which, minlength=1)
        self.met[: len(seen)] += seen
        begin = self.at[which]
        length = self.at[which + 1] - begin
        total = np.concatenate([[0], np.cumsum(length)])
        ids = self.pool[np.arange(total[-1]) + np.repeat(begin - total[:-1], length)]
        offsets = total[np.array(ends)]
        if wholes:
            parts = [wholes.get(k, ids[offsets[k] : offsets[k + 1]]) for k in range(len(texts))]
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            ids = np.concatenate(parts)
        return ids, offsets


@lru_cache(maxsize=1)  # kept between the tasks of a worker process, and so is what it remembers
def byte_bpe(path: str) -> Encoder:
    return Encoder(path, True, "<|endoftext|>")


@lru_cache(maxsize=1)
def word_bpe(path: str) -> Encoder:
    return Encoder(path, False, "<|endoftext|>")
