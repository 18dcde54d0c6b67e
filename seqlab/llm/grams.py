"""Character n-grams of many texts at once, hashed with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from seqlab.llm.worker import slices, worker_state

#: Code points that are hashed at once.
MOST_CHARS = 1 << 16
CODE_POINTS = 0x110000


def letters() -> np.ndarray:
    """For every code point, whether it belongs to a word."""
    return worker_state("letters", lambda: np.array([chr(i).isalnum() for i in range(CODE_POINTS)]))


def word_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of lower-cased texts, every run of other characters as one 0, and the text that each belongs to.

    A text stands between zeros, so a gram that starts or ends with 0 is one at the start or the end of a word.
    """
    lowered = ["\0" + t.lower() + "\0" for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
    of = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    word = letters()[codes]
    codes = np.where(word, codes, 0).astype(np.uint32)
    keep = np.ones(len(codes), bool)
    keep[1:] = word[1:] | word[:-1] | (of[1:] != of[:-1])
    return codes[keep], of[keep]


def hashed_grams(texts: list[str], orders: range, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the hashes below 2**bits of all grams within words, and the text that each belongs to.

    A zero may only be the first or the last of a gram; of order 1 it is none.
    """
    codes, of = word_codes(texts)
    zero = codes == 0
    before = np.concatenate([[0], np.cumsum(zero)])
    value = codes * np.uint32(0x9E3779B1)
    for n in range(1, orders.stop):
        if n > 1:
            value = value[:-1] * np.uint32(0x01000193) ^ codes[n - 1 :] * np.uint32(0x85EBCA6B)
        if n not in orders or not len(value):
            continue
        inner = before[n - 1 : n - 1 + len(value)] - before[1 : 1 + len(value)] if n > 1 else zero.astype(np.int64)
        good = (inner == 0) & (of[: len(value)] == of[n - 1 :])
        if n == 2:
            good &= ~(zero[:-1] & zero[1:])
        mixed = value[good]
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        yield (mixed >> np.uint32(32 - bits)).astype(np.int64), of[: len(value)][good]


def in_slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose grams are hashed at once."""
    return slices(texts, MOST_CHARS)
