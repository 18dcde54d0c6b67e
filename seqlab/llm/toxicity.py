"""Toxicity scores: bags of subword embeddings, averaged into a linear softmax."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.llm.grams import hashed_grams, in_slices
from seqlab.llm.worker import append_columns, keep_rows

#: Grams within words, from "<ab" to six letters; the number of embeddings is 2**BITS, each of DIMENSIONS numbers.
ORDERS, BITS, DIMENSIONS = range(3, 7), 20, 8
#: The bounded sample to fit on: so many labelled documents of either label at most, none above so many code points.
PER_LABEL, LONGEST = 3000, 20_000
#: A gram is learned if so many documents of the sample have it and its shares of the two labels differ by so many standard
#: errors, of all such grams those with the most; the embedding of any other stays zero but counts in the average, which is
#: scaled up. How fast an embedding grows shrinks with the errors that so many grams show by chance, and with the share that
#: the gram has in documents of the rarer label for it.
LEAST_DOCUMENTS, LEAST_ERRORS, MOST_GRAMS, SCALE, STEPS, RATE, DECAY = 4, 3.0, 1 << 15, 100.0, 200, 0.05, 1e-3
#: A text without evidence scores the share of toxic labels, and at most this.
MOST_PRIOR = 0.4


@dataclass(frozen=True)
class Toxicity:
    """What the scores need of the model: with two labels, an embedding counts by its product with the label difference."""

    value: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        """The probability of label 1, 0 to 1, of every whole text; a text without grams gets that of the bias alone."""
        out = np.empty(len(texts))
        for a, b in in_slices(texts):
            total, count = np.zeros(b - a), np.zeros(b - a)
            for grams, of in hashed_grams(texts[a:b], ORDERS, BITS):
                total += np.bincount(of, self.value[grams], b - a)
                count += np.bincount(of, minlength=b - a)
            out[a:b] = total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(out * SCALE + self.bias, -60, 60)))


def train(texts: Iterable[str | None], labels: np.ndarray, share: float | None = None) -> Toxicity:
    """Fit embeddings and softmax together on texts and their labels, by full-batch Adam.

    ``share`` is the share of label 1 in all labelled documents, of the given ones if it is None. It is what the softmax says
    without evidence, at most ``MOST_PRIOR``: no text is toxic because nothing is known of it. Evidence is whatever moves a
    score from there; texts of which too few are labelled, or whose labels they don't tell apart, give none. The gradient of
    embeddings and softmax runs through one number per gram, so a step costs two passes over the bags. The texts are read
    twice, so that only the grams that are learned are held for all of them.
    """
    labels = np.asarray(labels, float)
    share = share if share is not None else labels.mean() if len(labels) else 0.0
    prior = min(max(share, 1e-3), MOST_PRIOR)
    bias, value = float(np.log(prior / (1 - prior))), np.zeros(1 << BITS, np.float32)
    if not len(labels) or labels.min() == labels.max():
        return Toxicity(value, bias)
    seen, toxic = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for (grams, _), label in zip(map(bag, texts), labels, strict=True):
        seen[grams] += 1
        toxic[grams] += label > 0
    n, n1 = len(labels), labels.sum()
    error = np.sqrt(np.maximum(seen / n * (1 - seen / n), 1e-12) * (1 / n1 + 1 / (n - n1)))
    errors = np.where(seen >= LEAST_DOCUMENTS, np.abs(toxic / n1 - (seen - toxic) / (n - n1)) / error, 0)
    used = np.flatnonzero(errors >= LEAST_ERRORS)
    used = np.sort(used[np.argsort(-errors[used], kind="stable")[:MOST_GRAMS]])
    if not len(used):
        return Toxicity(value, bias)
    chance = 2 * np.log(max((seen >= LEAST_DOCUMENTS).sum(), 2))
    one, zero = toxic[used] / n1, (seen - toxic)[used] / (n - n1)
    trust = np.maximum(1 - chance / errors[used] ** 2, 0.02) * (1 - np.minimum(one, zero) / np.maximum(one, zero)) ** 2
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used))
    found = [(place[grams][kept], shares[kept]) for grams, shares in map(bag, texts) for kept in [place[grams] >= 0]]
    rows = np.repeat(np.arange(n), [len(c) for c, _ in found])
    cols = np.concatenate([c for c, _ in found])
    weighed = np.concatenate([s for _, s in found]).astype(np.float64) * SCALE * trust[cols]
    weight = np.where(labels > 0, prior / n1, (1 - prior) / (n - n1))
    rng = np.random.default_rng(7)
    state = {"e": rng.normal(0, 0.01, (len(used), DIMENSIONS)), "w": rng.normal(0, 1, (2, DIMENSIONS))}
    first, second = ({k: np.zeros_like(v) for k, v in state.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        side = state["w"][1] - state["w"][0]
        logit = np.bincount(rows, weighed * (state["e"] @ side)[cols], n) + bias
        miss = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - labels) * weight
        pull = np.bincount(cols, weighed * miss[rows], len(used))
        to_w = pull @ state["e"]
        grad = {"e": np.outer(pull, side) + DECAY / len(used) * state["e"], "w": np.stack([-to_w, to_w])}
        for k, g in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            state[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    value[used] = state["e"] @ (state["w"][1] - state["w"][0]) * trust
    return Toxicity(value, bias)


def held_out() -> F.Column:
    """Whether a document is kept from training: a fifth of all, by the checksum of its id. A null id is not kept from it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, longest: int = LONGEST) -> Toxicity:
    """A model of labels (doc_id, toxic) over the texts of documents that are not held out.

    Fitted on at most ``per_label`` documents of either label of at most ``longest`` code points, those of the smallest hash of
    doc_id, one row of each; their texts, fewer bytes than their grams, come to the driver. A document that is labelled repeatedly is toxic if one label
    says so; null labels and null ids are no labels. The share of toxic labels is that of all documents that could be chosen.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    bounded = docs.where(F.length(F.coalesce("text", F.lit(""))) <= longest).select("doc_id", "text")
    short = bounded.select("doc_id").join(known, "doc_id").distinct()
    share = short.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = short.where("toxic > 0").orderBy(*order).limit(per_label).union(short.where("toxic <= 0").orderBy(*order).limit(per_label))
    one = bounded.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    picked = one.orderBy(*order).select((F.col("toxic") > 0).cast("int").alias("toxic"), "text")

    rows = picked.toArrow()
    return train(rows.column("text"), rows.column("toxic").to_numpy(), share)


def bag(text: str | pa.StringScalar | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed grams of a text and the share of each; null is empty."""
    text = (text.as_py() if isinstance(text, pa.Scalar) else text) or ""
    grams = [g for a, b in in_slices([text]) for g, _ in hashed_grams([text][a:b], ORDERS, BITS)]
    found, count = np.unique(np.concatenate(grams), return_counts=True) if grams else (np.empty(0, np.int64), np.empty(0))
    return found.astype(np.int32), (count / max(count.sum(), 1)).astype(np.float32)


def scorer(docs: DataFrame, model: Toxicity) -> Callable[[list[str]], np.ndarray]:
    """A scoring function that tasks get with the model as a broadcast value of 2**BITS numbers."""
    sent = docs.sparkSession.sparkContext.broadcast((model.value, model.bias))
    return lambda texts: Toxicity(*sent.value).score(texts)


def score(docs: DataFrame, model: Toxicity) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text; other columns are ignored), whole texts.

    A null text is scored as the empty text. Repeated rows get equal scores; an empty table gives an empty table.
    """
    probability = scorer(docs, model)
    scored = append_columns(docs, lambda texts: {"score": pa.array(probability(texts), pa.float64())}, "score double", ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Toxicity) -> DataFrame:
    """``docs``, all columns, without the rows that score 0.5 or more."""
    probability = scorer(docs, model)
    return keep_rows(docs, lambda texts: probability(texts) < 0.5)
