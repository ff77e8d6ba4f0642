"""Restoring obfuscated words: a character lattice decoded under a language model.

``char_counts`` counts character trigrams over the whole of all texts; tasks
count into one array of fixed size, so nothing that grows with the corpus
leaves them. ``CharModel`` turns the counts into smoothed probabilities.

``Decoder.restored`` looks for words with symbols between letters, letters
repeated three times or more, and rows of single letters. Each is spelt out as
a lattice: a symbol stands for itself or for the letters it resembles, a run
for one or two letters or itself, a mark or space between letters for itself
or nothing, a star also for a vowel. Every reading has a channel cost; Viterbi
finds the reading of least cost under the trigram model, in time linear in the
length of the word. Everything else in a text is passed through.

Letters are a-z and the letters U+00DF-U+00FF; all other letters are one class
to the model (and kept as they are). Texts are lower-cased.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OTHER = 60                  # every letter outside a-z and U+00DF-U+00FF
CLASSES = OTHER + 1         # class 0 is the edge of a word
SLICE = 1 << 20             # characters counted at a time

# Channel costs in nats: how surprising each kind of writing is.
LEET = 1.0     # a symbol for a letter
KEPT = 6.0     # a symbol inside a word that means itself
DROP = 1.0     # a mark or space between letters that means nothing
REPEAT = 1.0   # a letter written three times or more, meant once or twice
MASK = 2.0     # a star for a vowel
LONGEST_RUN = 8      # a longer run of one letter is never meant
REMEMBERED = 100_000  # readings a task remembers

# Letters that symbols resemble.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "il", "+": "t", "|": "il", "€": "e"}
VOWELS = "aeiou"


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point."""
    out = np.zeros(0x110000, np.uint8)
    for lo in range(0, 0x110000, 0x800):
        if lo != 0xD800:
            out[lo:lo + 0x800] = [OTHER * chr(c).isalpha() for c in range(lo, lo + 0x800)]
    out[97:123] = np.arange(1, 27)
    out[0xDF:0x100] = np.arange(27, 60)
    out[0xF7] = 0
    return out


def _trigrams(text: str) -> np.ndarray:
    """Codes of the trigrams of a lower-cased text; edges of words are one character."""
    c = _classes()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)].astype(np.int32)
    c = np.concatenate([[0], c, [0]])
    c = c[np.append(True, (c[1:] > 0) | (c[:-1] > 0))]
    if len(c) < 3:
        return np.empty(0, np.int64)
    before = np.concatenate([[0], c[:-2]])
    before[c[:-1] == 0] = 0  # a word starts afresh
    return (before.astype(np.int64) * CLASSES + c[:-1]) * CLASSES + c[1:]


def char_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(code, n): how often each character trigram occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(CLASSES ** 3, np.int64)
        some, size = [], 0  # texts to be counted together, apart by a line's end
        for batch in batches:
            for t in batch.column(0):
                t = (t.as_py() or "").lower()
                at = 0
                while at < len(t):
                    to = at + SLICE
                    while to < len(t) and t[to - 1].isalpha():  # never inside a word
                        to += 1
                    some.append(t[at:to])
                    size += len(some[-1])
                    if size >= SLICE:
                        held += np.bincount(_trigrams("\n".join(some)), minlength=CLASSES ** 3)
                        some, size = [], 0
                    at = to
        held += np.bincount(_trigrams("\n".join(some)), minlength=CLASSES ** 3)
        code = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(code, pa.int32()), pa.array(held[code])], names=["code", "n"])

    return docs.select(text).mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


def char_model(docs: DataFrame, text: str = "text") -> bytes:
    """Costs (-log probability) of all trigrams, from counts over all texts; a table of fixed size."""
    rows = char_counts(docs, text).toArrow()  # at most CLASSES ** 3 rows
    n = np.zeros(CLASSES ** 3)
    n[rows["code"].to_numpy()] = rows["n"].to_numpy()
    three = n.reshape(CLASSES, CLASSES, CLASSES)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + CLASSES)
    p2 = (two + 20 * p1) / (two.sum(1, keepdims=True) + 20)
    p3 = (three + 20 * p2) / (three.sum(2, keepdims=True) + 20)
    return (-np.log(p3)).astype(np.float32).tobytes()


_LETTER = r"[^\W\d_]"
_LIKE = "".join(re.escape(c) for c in LOOKS_LIKE)
#: What in a word may be obfuscated: symbols between letters, at its start or
#: (one or two, as three equal ones are ornament) at its end; long runs.
_HINT = re.compile(
    rf"{_LETTER}[^\w]{{1,3}}{_LETTER}|{_LETTER}[\d_{_LIKE}*]{{1,4}}{_LETTER}|^[0-9@$€]{{1,2}}{_LETTER}"
    rf"|{_LETTER}(?:[0134579]|[@$]{{1,2}})$|({_LETTER})\1\1")
_ROW = re.compile(r"(?<!\S)[^\W_](?: [^\W_]){2,}(?!\S)")  # three or more single characters
_MAYBE_ROW = re.compile(r" [^\W_] [^\W_]")
_RUN = re.compile(rf"({_LETTER})\1\1")
_MARKS = ".,;:!?()[]\"'"
_SPACE = re.compile(r"(\s+)")
_WORD = re.compile(_LETTER + "+")


class Decoder:
    def __init__(self, model: bytes) -> None:
        self.cost = np.frombuffer(model, np.float32).tolist()
        self.readings: dict[str, str] = {}
        self.word_lists: dict[str, tuple[str, ...]] = {}
        self.plain: set[str] = set()  # words seen that nothing can change

    def _lattice(self, word: str) -> list[list[tuple[str, float]]]:
        """Readings (letters, channel cost) of each run of equal characters."""
        runs = [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", word, re.S)]
        out = []
        for i, (c, n) in enumerate(runs):
            inner = 0 < i < len(runs) - 1
            if c.isalpha():
                reads = [(c * n, 0.0)] if n <= LONGEST_RUN else []
                reads += [(c * k, REPEAT) for k in (1, 2) if n > 2]
            elif c in LOOKS_LIKE:
                few = (n,) if n < 3 else (1, 2)
                reads = [(c, KEPT)] + [(x * k, LEET + REPEAT * (k != n)) for x in LOOKS_LIKE[c] for k in few]
                if inner and not c.isdigit():
                    reads.append(("", KEPT + DROP))
            else:
                reads = [(c, KEPT if inner else 0.0)]
                if inner:
                    reads.append(("", DROP))
                    if c == "*":
                        reads += [(v, MASK) for v in VOWELS]
            out.append(reads)
        return out

    def decode(self, word: str) -> str:
        """The reading of least cost."""
        table, cost = _classes(), self.cost
        states = {(0, 0): (0.0, None)}  # last two classes -> (cost, path back)
        for reads in self._lattice(word):
            after: dict = {}
            for (a, b), (spent, path) in states.items():
                for letters, extra in reads:
                    x, y, total = a, b, spent + extra
                    for ch in letters:
                        z = int(table[ord(ch)])
                        if z or y:
                            total += cost[(x * CLASSES + y) * CLASSES + z]
                        x, y = (y, z) if z else (0, 0)
                    if (x, y) not in after or total < after[x, y][0]:
                        after[x, y] = (total, (path, letters))
            states = after
        _, path = min(((spent + (cost[(a * CLASSES + b) * CLASSES] if b else 0.0), path)
                       for (a, b), (spent, path) in states.items()), key=lambda s: s[0])
        out = []
        while path:
            path, letters = path
            out.append(letters)
        return "".join(reversed(out))

    def _remembered(self, word: str, held: dict, make) -> object:
        found = held.get(word)
        if found is None:
            found = make(word)
            if len(word) <= 64:
                if len(held) >= REMEMBERED:
                    held.clear()
                held[word] = found
        return found

    def _restore(self, word: str) -> str:
        core = word.strip(_MARKS)  # punctuation around a word is no obfuscation
        if not _HINT.search(core):
            return word
        lo = word.index(core)
        return word[:lo] + self.decode(core) + word[lo + len(core):]

    def _words_of(self, word: str) -> tuple[str, ...]:
        return tuple(_WORD.findall(self._restore(word)))

    def _joined(self, text: str | None) -> str:
        """Lower-cased, rows of single characters restored."""
        text = (text or "").lower()
        return _ROW.sub(lambda m: self.decode(m[0]), text) if _MAYBE_ROW.search(text) else text

    def restored(self, text: str | None) -> str:
        """The whole text, lower-cased, its obfuscated words restored."""
        parts = _SPACE.split(self._joined(text))
        parts[::2] = [self._remembered(w, self.readings, self._restore) for w in parts[::2]]
        return "".join(parts)

    def words(self, text: str | None) -> set[str]:
        """Distinct words (runs of letters) of the restored text."""
        tokens = set(self._joined(text).split())
        out = tokens & self.plain
        for w in tokens - out:
            if w not in self.word_lists and w.isalpha() and not _RUN.search(w):
                out.add(w)
                if len(w) <= 64:
                    if len(self.plain) >= REMEMBERED:
                        self.plain.clear()
                    self.plain.add(w)
            else:
                out.update(self._remembered(w, self.word_lists, self._words_of))
        return out
