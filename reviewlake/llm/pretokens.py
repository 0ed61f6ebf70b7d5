"""Texts as chunks that byte-level tokenizers treat independently, and a growing table of what each chunk encodes to."""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np

_ODD_SPACE = re.compile(r"[^\S \n]")
WHOLE, START = "\x01", "\x00"
MARKS = START + WHOLE
REMEMBERED = 600_000


def chunk_keys(text: str) -> list[str]:
    """Keys of the chunks of ``text``, in order; ``chunk_text`` gives a key's text.

    A single space or line feed between other characters always begins a new match of the tokenizers'
    pattern, so the text is cut in front of each. A text with runs of white space, or with white space of
    another kind, is one chunk as a whole.
    """
    if not text:
        return []
    if (
        "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n"
        or START in text or WHOLE in text or _ODD_SPACE.search(text)
    ):
        return [WHOLE + text]
    keys = text.replace("\n", " \n").split(" ")
    keys[0] = START + keys[0]
    return keys


def chunk_text(key: str) -> str:
    """A key that begins with a line feed is its own text; others had a space in front, unless marked."""
    if key[0] == START or key[0] == WHOLE:
        return key[1:]
    return key if key[0] == "\n" else " " + key


class ChunkIds:
    """Ids of chunks, each encoded once; ``encode`` turns a list of keys into flat ids and their counts.

    Keys with a mark come first in the list that ``encode`` gets. The table starts anew above
    ``remembered`` chunks or the ids of very long whole texts, so it stays bounded.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], remembered: int = REMEMBERED):
        self._encode, self._remembered = encode, remembered
        self._reset()

    def _reset(self) -> None:
        self._known: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self._flat = np.zeros(0, np.uint32)
        self._counts = np.zeros(0, np.int64)
        self._starts = np.zeros(0, np.int64)

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text. The new chunks of all texts are encoded in one call before the first comes back."""
        if len(self._known) > self._remembered or len(self._flat) > 20 * self._remembered:
            self._reset()
        number = self._known.__getitem__
        rows = []
        for text in texts:
            keys = chunk_keys(text) if text else []
            rows.append(np.fromiter(map(number, keys), np.int32, len(keys)))
        self._learn(list(itertools.islice(self._known, len(self._counts), None)))
        return map(self._ids, rows)

    def _learn(self, keys: list[str]) -> None:
        if not keys:
            return
        marked = np.array([key[0] in MARKS for key in keys])
        order = np.argsort(~marked, kind="stable")
        flat, counts = self._encode([keys[i] for i in order.tolist()])
        starts = np.cumsum(counts) - counts + len(self._flat)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self._flat = np.concatenate((self._flat, flat))
        self._counts = np.concatenate((self._counts, counts[place]))
        self._starts = np.concatenate((self._starts, starts[place]))

    def _ids(self, row: np.ndarray) -> np.ndarray:
        counts = self._counts[row]
        ends = np.cumsum(counts)
        at = np.repeat(self._starts[row] - ends + counts, counts)
        return self._flat[at + np.arange(len(at))]
