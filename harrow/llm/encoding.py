"""Whole-text tokenization with the ``tokenizers`` library, word by word.

Both supported kinds of tokenizer never join characters across a single space or line end
between two characters that are not white space, so a text's ids are the ids of its words in order.
Words repeat, so each worker process keeps the ids of the words that it has met, at most
``limit`` of them, and asks the library only for new words, many at once.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

_BLANK_RUN = re.compile(r"\s\s")
_ODD = re.compile(r"[\s|]|<\|")


class WordEncoder:
    """Encode texts with one tokenizer.

    A word is kept as it stands after a space; with a line end before it, it is a word at a line's start.
    """

    def __init__(self, path: str, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.limit = limit
        self.known: dict[str, bytes] = {}
        self.spaced = self._ids(" a") != self._ids("a")
        self.caseless = self._ids("A") == self._ids("a")
        #: a text between words that is one token of its own beside them
        self.between = "\n" if self.spaced else " | "
        self.mark = self._ids(self.between)
        self.line_end = self._bytes("\n")
        self.marks = {"": b""} | {c: self._bytes(c) for c in ".,!?;:"}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _bytes(self, text: str) -> bytes:
        return np.array(self._ids(text), self.dtype).tobytes()

    def _many(self, words: list[str]) -> list[bytes]:
        """The ids of words without blanks, from one text of all of them."""
        ids = np.array(self.tokenizer.encode_batch_fast([self.between.join(words)], add_special_tokens=False)[0].ids, self.dtype)
        ends = np.append(np.flatnonzero(ids == self.mark[0]), len(ids))
        if len(ends) != len(words):
            return [self._bytes(w) for w in words]
        data, size = ids.tobytes(), self.dtype.itemsize
        ends = (ends * size).tolist()
        return [data[a:b] for a, b in zip([0, *[e + size for e in ends]], ends)]

    def _learn(self, words: set[str]) -> None:
        known = self.known
        fresh = words.difference(known)
        if len(known) + len(fresh) > self.limit:
            known.clear()
            fresh = words
        plain, built = set(), []
        for w in fresh:
            start, core = ("\n", w[1:]) if w[:1] == "\n" else ("", w)
            # letters and a mark after them are always split; letters are mostly met before
            letters, end = (core, "") if core.isalpha() else (core[:-1], core[-1:])
            if letters.isalpha() and end in self.marks and (letters.isascii() or not self.caseless or letters.lower().isalpha()):
                if self.caseless and letters.isascii():
                    letters = letters.lower()
                letters = start + letters
                if letters == w:
                    plain.add(w)
                else:
                    built.append((w, letters, end))
                    if letters not in known:
                        plain.add(letters)
            elif not core or _ODD.search(core) or len(self.mark) != 1:
                known[w] = self.line_end + self._bytes(core) if start else self._bytes(" " + core if self.spaced else core)
            else:
                plain.add(w)
        todo = list(plain)
        for at in range(0, len(todo), 2048):
            block = todo[at : at + 2048]
            later = [w for w in block if w[0] != "\n"]
            known.update(zip(later, self._many([" " + w for w in later] if self.spaced else later)))
            first = [w for w in block if w[0] == "\n"]
            known.update((w, self.line_end + ids) for w, ids in zip(first, self._many([w[1:] for w in first])))
        for w, letters, end in built:
            known[w] = known[letters] + self.marks[end]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens, as arrays of ``dtype``."""
        split: list[list[str] | None] = []
        met: set[str] = set()
        for text in texts:
            if _BLANK_RUN.search(text):
                split.append(None)
                continue
            words = f"\n{text}".replace("\n", " \n").split(" ")[1:]
            met.update(words)
            split.append(words)
        self._learn(met)
        ids, skip = self.known.__getitem__, len(self.line_end)
        return [
            np.frombuffer(self._bytes(text) if words is None else b"".join(map(ids, words))[skip:], self.dtype)
            for text, words in zip(texts, split)
        ]


@lru_cache(maxsize=4)
def word_encoder(path: str, limit: int) -> WordEncoder:
    """The encoder of this worker process, which later tasks find warm."""
    return WordEncoder(path, limit)
