"""Language identification with error-correcting output codes over character n-grams."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqlab.llm.grams import hashed_grams, in_slices
from seqlab.llm.toxicity import held_out
from seqlab.llm.worker import append_columns, keep_rows, texts_of
from seqlab.session import land

#: Grams of one to three characters within words, hashed to 2**BITS features.
ORDERS, BITS = range(1, 4), 13
#: The bounded sample to fit on: documents in all and of one language. Ids are looked for in so many stretches of their hashes.
SAMPLE, PER_LANGUAGE, HASH_BITS = 3200, 800, 12
STEPS, RATE, DECAY = 60, 0.05, 1e-4
#: A prediction is ambiguous if the nearest two codewords are closer in probability than this.
MARGIN = 0.1
UNKNOWN = "und"
#: A text of so many letters is in no learned language if the loss of the nearest codeword is above this for each bit. Of 2000
#: documents held out 0.1 % have a loss above 0.44, all of them short; texts in other scripts have 0.5 and more.
FAR, LEAST_LETTERS = 0.48, 20


def codewords(classes: int) -> np.ndarray:
    """One row of +1 and -1 for each class. Up to 7 classes: every split of the classes into two; more: seeded random rows,
    of several draws the one whose closest two rows are furthest apart."""
    if classes <= 7:
        columns = [c for c in product((1, -1), repeat=classes) if c[0] == 1 and -1 in c]
        return np.array(columns, np.int8).T.reshape(classes, -1)
    rng, bits = np.random.default_rng(11), math.ceil(10 * math.log2(classes))
    draws = [rng.choice(np.array([1, -1], np.int8), (classes, bits)) for _ in range(50)]
    apart = lambda code: (bits - (code.astype(int) @ code.T - 2 * bits * np.eye(classes))).min()
    return max(draws, key=apart)


@dataclass(frozen=True)
class Language:
    """Languages, their codewords, and a linear classifier for each bit."""

    names: list[str]
    code: np.ndarray
    weight: np.ndarray
    bias: np.ndarray

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, ambiguous) of every whole text; see ``judge``."""
        return self.judge(texts)[:3]

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, ambiguous, loss) of every whole text.

        The loss of a codeword is the sum over its bits of log(1 + exp(-bit * output)); the language of the least loss wins,
        the score is its share of exp(-loss). A text without a letter, and any if no language was learned, is ``und``
        with score 0 and not ambiguous. loss is that of the nearest codeword for each bit, 0 where nothing is predicted.
        """
        names, scores, unsure = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.zeros(len(texts), bool)
        losses = np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if self.names and any(map(str.isalpha, t))]
        for at in range(0, len(rows), 256):
            part = rows[at : at + 256]
            output = features([texts[i] for i in part]) @ self.weight + self.bias
            loss = np.logaddexp(0, -output[:, None, :] * self.code).sum(2)
            share = np.exp(loss.min(1, keepdims=True) - loss)
            share /= share.sum(1, keepdims=True)
            best = share.argmax(1)
            names[part] = np.array(self.names, object)[best]
            scores[part] = share.max(1)
            losses[part] = loss.min(1) / max(self.code.shape[1], 1)
            if len(self.names) > 1:
                two = np.sort(share, 1)[:, -2:]
                unsure[part] = two[:, 1] - two[:, 0] < MARGIN
        return names, scores, unsure, losses

    def known(self, texts: list[str]) -> np.ndarray:
        """Whether each text is in one of the languages: it has a letter, and if it has several its codeword is not far."""
        names, _, _, losses = self.judge(texts)
        far = losses > FAR
        return np.array([n != UNKNOWN and not (f and sum(map(str.isalpha, t)) >= LEAST_LETTERS) for n, f, t in zip(names, far, texts, strict=True)], bool)


def features(texts: list[str]) -> np.ndarray:
    """The square roots of the shares of the hashed grams, a row for each text."""
    counts = np.zeros((len(texts), 1 << BITS), np.float32)
    for a, b in in_slices(texts):
        for grams, of in hashed_grams(texts[a:b], ORDERS, BITS):
            counts[a:b] += np.bincount(of * (1 << BITS) + grams, minlength=(b - a) << BITS).reshape(b - a, -1)
    return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))


def train(rows: np.ndarray, langs: np.ndarray) -> Language:
    """Logistic classifiers of all bits at once, by full-batch Adam; languages weigh the same."""
    names = sorted(set(langs))
    if not names:
        return Language([], np.empty((0, 0)), np.empty((0, 0)), np.empty(0))
    index = np.array([names.index(x) for x in langs])
    code = codewords(len(names))
    target = code[index]
    share = (1 / np.bincount(index))[index][:, None] / len(names)
    state = [np.zeros((rows.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)]
    first, second = ([np.zeros_like(x) for x in state] for _ in range(2))
    for step in range(1, STEPS + 1):
        miss = -target * share / (1 + np.exp(np.clip(target * (rows @ state[0] + state[1]), -60, 60)))
        for k, g in enumerate((rows.T @ miss.astype(np.float32) + DECAY * state[0] / len(names), miss.sum(0))):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            state[k] -= RATE * 10 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Language(names, code, state[0].astype(np.float32), state[1].astype(np.float32))


def sampled_ids(known: DataFrame, sample: int, per_language: int) -> DataFrame:
    """(doc_id, lang) of the sample of ``known`` (doc_id, lang): of each language those of the smallest hash of doc_id, in turn.

    Rows are counted for each stretch of hashes before the shuffle; only ids below the stretch with the last wanted one are
    ranked, so no language, however large, is ranked whole. Raises if there are more languages than the sample can hold.
    """
    stretch = F.shiftright(F.xxhash64("doc_id"), 64 - HASH_BITS).alias("stretch")
    counts = land(known.groupBy("lang", stretch).count(), "language_stretches")
    upto = Window.partitionBy("lang").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    cuts = counts.withColumn("before", F.coalesce(F.sum("count").over(upto), F.lit(0))).where(F.col("before") < per_language)
    cuts = land(cuts.groupBy("lang").agg(F.max("stretch").alias("last")), "language_cuts")
    n = cuts.count()
    if n > sample:
        raise ValueError(f"{n} languages are more than the {sample} documents of the sample.")
    least = known.select("doc_id", "lang", stretch).join(cuts, "lang").where(F.col("stretch") <= F.col("last")).select("doc_id", "lang").distinct()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = least.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language)
    return ranked.orderBy("place", "lang").limit(sample).select("doc_id", "lang").distinct()


def fit(docs: DataFrame, sample: int = SAMPLE, per_language: int = PER_LANGUAGE) -> Language:
    """A model of the column lang over the whole texts of documents that are not held out.

    Fitted on at most ``sample`` documents, at most ``per_language`` of one language, see ``sampled_ids``, one row of each; only
    their gram shares come to the driver. Null languages and texts are not learned from.
    """
    known = docs.where("lang is not null and text is not null and doc_id is not null").where(~held_out())
    chosen = sampled_ids(known.select("doc_id", "lang"), sample, per_language)
    picked = known.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"])
    picked = picked.groupBy("doc_id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            at, found = [], []
            for k in range(0, len(texts), 256):
                for row in features(texts[k : k + 256]):
                    at.append(np.flatnonzero(row).astype(np.int32))
                    found.append(row[at[-1]])
            values = pa.array(found, pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(at, pa.list_(pa.int32())), values], names=["lang", "at", "share"])

    rows = picked.mapInArrow(shares, "lang string, at array<int>, share array<float>").toArrow()
    dense = np.zeros((rows.num_rows, 1 << BITS), np.float32)
    for i in range(rows.num_rows):
        dense[i, rows["at"][i].values.to_numpy()] = rows["share"][i].values.to_numpy()
    return train(dense, np.array(rows["lang"].to_pylist(), object))


def sent_model(docs: DataFrame, model: Language) -> Callable[[], Language]:
    """The model as tasks get it, a broadcast value of 2**BITS numbers for each code bit."""
    sent = docs.sparkSession.sparkContext.broadcast((model.names, model.code, model.weight, model.bias))
    return lambda: Language(*sent.value)


def identify(docs: DataFrame, model: Language) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of every row of ``docs`` (doc_id, text; other columns are not read).

    A null text is ``und``. Repeated rows get equal results; an empty table gives an empty table.
    """
    held = sent_model(docs, model)

    def columns(texts: list[str]) -> dict[str, pa.Array]:
        names, scores, unsure = held().predict(texts)
        return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64()), "ambiguous": pa.array(unsure)}

    made = append_columns(docs, columns, "lang_pred string, score double, ambiguous boolean", ["doc_id"])
    return made.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def drop_unknown(docs: DataFrame, model: Language) -> DataFrame:
    """``docs``, all columns, without the rows that are in no language: without a letter, or far from every codeword."""
    held = sent_model(docs, model)
    return keep_rows(docs, lambda texts: held().known(texts))
