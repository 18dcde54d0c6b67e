"""Encoding and decoding with a sentencepiece model, with the span of every piece in the original text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from seqlab.llm.piece_model import BYTE, NORMAL, SPACE, identity, read_model, without_normaliser
from seqlab.llm.worker import append_columns, texts_of, worker_state

VOCABULARY = "piece_bpe_32k.model"


class Encoder:
    """Encodes whole texts with the library and places their pieces in them.

    A text is normalised here, through the character map, which gives the alignment of its bytes; the library merges the normalised
    text and changes nothing in it. The pieces follow each other in that text, so the ends of their widths are places that the
    alignment takes back to the text.
    """

    def __init__(self, data: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=without_normaliser(data))
        self.model = read_model(data)
        names, kinds = self.model.names, self.model.kinds
        if BYTE not in kinds:
            raise ValueError("Spans of unknown characters need a model with byte pieces.")
        self.end = self.library.eos_id()
        self.surface = [
            bytes([int(n[3:5], 16)]) if k == BYTE else n.replace(SPACE, " ").encode() if k == NORMAL else b"" for n, k in zip(names, kinds, strict=True)
        ]
        self.surface[self.library.unk_id()] = " ⁇ ".encode()
        self.width = np.array([1 if k == BYTE else len(n.encode()) if k == NORMAL else 0 for n, k in zip(names, kinds, strict=True)])
        self.text = [str(i) for i in range(len(names))]

    def encode(self, text: str) -> tuple[list[int], np.ndarray]:
        """The ids of a text and the bounds of their pieces in its bytes: piece i is bounds[i] to bounds[i + 1].

        The space in front belongs to no byte. The bytes of a character without a piece are pieces of one byte.
        """
        normal, source = self.model.normalised(text)
        ids = self.merger.encode(normal)
        source = identity(text, self.model.prefix) if source is None else source
        places = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.width[ids], out=places[1:]) if ids else None
        if places[-1] != len(source) - 1:
            raise ValueError("The pieces don't cover the normalised text.")
        return ids, source[places]

    def decode(self, ids: list[int]) -> str:
        """The text of any ids, as the library gives it; also of bytes that are no character."""
        return self.library.decode(ids)


def _encoder(sent) -> Encoder:
    return worker_state("piece encoder", lambda: Encoder(sent.value))


def _broadcast(docs: DataFrame, path: str | None):
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, pieces) of every row of ``docs``: an array of (id, begin, finish), the last two in bytes of the whole text.

    A null text is empty and has no pieces. Repeated rows get equal results; an empty table gives an empty table.
    """
    sent = _broadcast(docs, path)
    span = pa.struct([("id", pa.int32()), ("begin", pa.int64()), ("finish", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for at in range(0, len(texts), 200):
                ids, bounds = zip(*map(_encoder(sent).encode, texts[at : at + 200]), strict=True)
                parts = [np.concatenate(x) for x in (ids, [b[:-1] for b in bounds], [b[1:] for b in bounds])]
                flat = pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(parts, span, strict=True)], fields=list(span))
                offsets = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                rows = pa.ListArray.from_arrays(offsets, flat)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, 200), rows], names=["doc_id", "pieces"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, pieces array<struct<id: int, begin: long, finish: long>>")


def encoded_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, span_bytes): every whole text encoded, with an end id, and decoded again.

    span_bytes is the number of bytes of the text that the spans of its pieces cover, one after the other. A null text is
    empty and has the end id alone. Repeated rows get equal results; an empty table gives an empty table.
    """
    sent = _broadcast(docs, path)

    def columns(texts: list[str]) -> dict[str, pa.Array]:
        encoder = _encoder(sent)
        rows = []
        for text in texts:
            ids, bounds = encoder.encode(text)
            ids.append(encoder.end)
            written = " ".join(map(encoder.text.__getitem__, ids)).encode()
            decoded = encoder.decode(ids).encode()
            rows.append((len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(decoded).hexdigest(), int(np.diff(bounds).sum())))
        made = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64()]
        return {n: pa.array(x, k) for n, x, k in zip(("n_tokens", "ids_sha256", "decoded_sha256", "span_bytes"), made, kinds, strict=True)}

    return append_columns(docs, columns, "n_tokens long, ids_sha256 string, decoded_sha256 string, span_bytes long", ["doc_id"])
