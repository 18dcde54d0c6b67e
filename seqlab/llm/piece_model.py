"""What a sentencepiece model file says: pieces, flags and the compiled character map."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

SPACE = "▁"
#: Kinds of pieces and of models in the file format.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _number(data, at)
        if key & 7 == 0:
            value, at = _number(data, at)
        else:
            size, at = _number(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """The compiled normalisation map: a double-array trie of source bytes and the texts that it points to."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest mapped prefix of ``data[at:]`` and the length of that prefix."""
        if not self.units:
            return None
        found = None
        unit = self.units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit & 256:
                found = (self.units[node] & 0x7FFFFFFF, i + 1 - at)
        if found is None:
            return None
        return self.texts[found[0] : self.texts.index(0, found[0])], found[1]


@dataclass
class PieceModel:
    """Pieces in the order of their ids; only byte-pair models with white space in front of words are read."""

    names: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    prefix: bool = True
    squeeze: bool = True
    characters: CharacterMap = field(default_factory=lambda: CharacterMap(b""))

    def normalised(self, text: str) -> tuple[str, np.ndarray | None]:
        """The text as the merges see it, and for each of its bytes and its end the byte of ``text`` that it comes from.

        At each place the longest prefix that the character map knows is replaced; another character stays as it is.
        The space in front of the text comes from byte 0. Without a map to apply the alignment is None: see ``identity``.
        """
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.characters.units and not self.squeeze:
            return (SPACE if self.prefix else "") + text.replace(" ", SPACE), None
        data, at, out, source = text.encode(), 0, [], []
        while at < len(data):
            hit = self.characters.longest(data, at)
            size = hit[1] if hit else 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
            for char in (hit[0] if hit else data[at : at + size]).decode():
                if not (self.squeeze and char == " " and (not out or out[-1] == SPACE)):
                    out.append(SPACE if char == " " else char)
                    source.append(at)
            at += size
        while self.squeeze and out and out[-1] == SPACE:
            out.pop()
            at = source.pop()
        if not out:
            return "", np.zeros(1, np.int64)
        if self.prefix:
            out.insert(0, SPACE)
            source.insert(0, source[0])
        return "".join(out), np.append(np.repeat(source, [len(c.encode()) for c in out]), at)


def identity(text: str, prefix: bool = True) -> np.ndarray:
    """The alignment of a text of which only the spaces are replaced, by three bytes each."""
    data = np.frombuffer(text.encode(), np.uint8)
    source = np.repeat(np.arange(len(data)), np.where(data == 32, 3, 1))
    return np.concatenate([np.zeros(3 * prefix, np.int64), source, [len(data)]])


def read_model(data: bytes) -> PieceModel:
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            model.names.append(piece[1].decode())
            model.scores.append(float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]))
            model.kinds.append(piece.get(3, NORMAL))
        elif number == 2 and dict(_fields(value)).get(3, 1) != BPE:
            raise ValueError("Only byte-pair models can be read.")
        elif number == 3:
            spec = dict(_fields(value))
            model.characters = CharacterMap(spec.get(2, b""))
            model.prefix, model.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
            if not spec.get(5, 1):
                raise ValueError("Only models that escape white space can be read.")
    if set(model.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("Models with user-defined or unused pieces can't be read.")
    if any(SPACE in name.lstrip(SPACE) for name, kind in zip(model.names, model.kinds, strict=True) if kind == NORMAL):
        raise ValueError("Only models whose pieces have white space in front can be read.")
    return model


def without_normaliser(data: bytes) -> bytes:
    """The model file for texts that are normalised already: no map, no space in front, none removed.

    Of a message that occurs twice in a file, the later fields count, so one is added at the end.
    """
    name = b"identity"
    fields = bytes([0x0A, len(name)]) + name + bytes([0x12, 0, 0x18, 0, 0x20, 0, 0x28, 1])  # name, map, prefix, squeeze, escape
    return data + bytes([0x1A, len(fields)]) + fields
