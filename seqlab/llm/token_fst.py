"""Token counts by a deterministic transducer that is compiled from a byte-pair vocabulary.

A prefix of a word has one encoding, so each place of it has one last token. A token may end at a place if it fits the last
token at its start, which is a fact of the two alone. What the future of a prefix depends on is therefore finite: the
starts from which some piece may still grow, the last token at each, and how many tokens lie before each. Those are the
states. A transition emits the tokens that are settled by it, in number; a state has a number that is still open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlab.llm.piece_model import NORMAL, SPACE, PieceModel, read_model
from seqlab.llm.worker import append_columns, slices, worker_state

VOCABULARY = "piece_bpe_32k.model"
#: Code points of a chunk, code points that are run at once, and states that a worker keeps.
CHUNK, MOST_CHARS, MOST_STATES = 256, 1 << 21, 500_000
#: The first classes are characters without a piece, by their number of bytes; each is as many tokens.
BYTES = 4
#: Of the hash table of transitions.
MULTIPLIER, LEAST_BITS = 0x9E3779B97F4A7C15, 16


class Transducer:
    """States and transitions are made when a text first needs them, so only what occurs is compiled."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.rank = {n: s for n, s, k in zip(model.names, model.scores, model.kinds, strict=True) if k == NORMAL}
        self.grows = {n[:i] for n in self.rank for i in range(len(n))}
        self.chars = ["", *sorted(n for n in self.rank if len(n) == 1)]
        self.space = BYTES + self.chars.index(SPACE)
        code = np.arange(0x110000)
        self.classes = ((code >= 0x80).astype(np.int32) + (code >= 0x800) + (code >= 0x10000)).astype(np.int32)
        for i, char in enumerate(self.chars[1:], 1):
            self.classes[ord(char)] = BYTES + i
        self.classes[ord(" ")] = self.space
        self.shift = (BYTES + len(self.chars)).bit_length()
        self.fits: dict[tuple[str, str], bool] = {}
        self.clear()

    def clear(self) -> None:
        """Forget all states but the start of a word."""
        start = (("", "", 0),)  # (text since a start, last token before it, tokens before it), oldest start first
        self.number, self.states, self.open = {start: 0}, [start], np.zeros(1 << 10, np.int64)
        self.resize(LEAST_BITS)

    def resize(self, bits: int) -> None:
        """Hash the transitions anew into 2**bits slots; those that find their slot taken try the next, all at once."""
        full = np.flatnonzero(self.keys >= 0) if bits > LEAST_BITS else np.empty(0, np.int64)
        keys, values = (self.keys[full], self.values[full]) if len(full) else (full, full)
        self.bits, self.keys, self.values, self.filled = bits, np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64), len(full)
        slot = self.slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]], self.values[slot[free]] = keys[free], values[free]
            left = self.keys[slot] != keys
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & ((1 << bits) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(MULTIPLIER)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_fits(self, last: str, token: str) -> bool:
        """Whether the merges leave ``last`` and ``token`` side by side, or make ``token`` alone at the start of a word."""
        key = (last, token)
        if key not in self.fits:
            parts, rank = list(last + token), self.rank
            while True:
                best, at = None, 0
                for i in range(len(parts) - 1):
                    score = rank.get(parts[i] + parts[i + 1])
                    if score is not None and (best is None or score > best):
                        best, at = score, i
                if best is None:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.fits[key] = parts == ([last, token] if last else [token])
        return self.fits[key]

    def learn(self, key: int) -> None:
        """Make the transition of a (state, class)."""
        state, kind = key >> self.shift, key & ((1 << self.shift) - 1)
        emitted = 0
        rank, grows = self.rank, self.grows
        last = self.states[state][-1][1]
        if kind < BYTES:
            emitted, following = self.open[state] + kind + 1, 0
        else:
            if kind == self.space and last and not last.endswith(SPACE):  # no piece crosses this: a new word
                emitted, state = self.open[state], 0
            char, grown, ended = self.chars[kind - BYTES], [], None
            for text, before, count in self.states[state]:
                token = text + char
                if ended is None and token in rank and self.pair_fits(before, token):
                    ended = (token, count + 1)
                if token in grows:
                    grown.append((token, before, count))
            grown.append(("", *ended))
            settled = min(count for _, _, count in grown)
            emitted += settled
            found = tuple((text, before, count - settled) for text, before, count in grown)
            following = self.number.setdefault(found, len(self.states))
            if following == len(self.states):
                self.states.append(found)
                if following == len(self.open):
                    self.open = np.concatenate([self.open, np.zeros_like(self.open)])
                self.open[following] = found[-1][2]
        if 3 * self.filled > 1 << self.bits:
            self.resize(self.bits + 1)
        slot = (key * MULTIPLIER & (1 << 64) - 1) >> (64 - self.bits)
        while self.keys[slot] >= 0 and self.keys[slot] != key:
            slot = (slot + 1) & ((1 << self.bits) - 1)
        self.filled += self.keys[slot] < 0
        self.keys[slot], self.values[slot] = key, following << 8 | int(emitted)

    def step(self, state: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and emitted counts of many runs at once."""
        key = state << self.shift | kind
        slot = self.slot(key)
        wrong = np.flatnonzero(self.keys[slot] != key)
        while len(wrong):
            missing = wrong[self.keys[slot[wrong]] < 0]
            if len(missing):
                for new in np.unique(key[missing]).tolist():
                    self.learn(new)
                slot = self.slot(key)
                wrong = np.arange(len(key))
            else:
                slot[wrong] = (slot[wrong] + 1) & ((1 << self.bits) - 1)
            wrong = wrong[self.keys[slot[wrong]] != key[wrong]]
        value = self.values[slot]
        return value >> 8, value & 255

    def run(self, state: np.ndarray, start: np.ndarray, stop: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each run from its state over kinds[start:stop], all in lockstep; the states that they end in and what they emit."""
        size = stop - start
        order = np.argsort(-size, kind="stable")
        state, at, size, emitted = state[order], start[order], size[order], np.zeros(len(order), np.int64)
        for i in range(int(size[0]) if len(size) else 0):
            live = np.searchsorted(-size, -i)
            state[:live], more = self.step(state[:live], kinds[at[:live] + i])
            emitted[:live] += more
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], emitted[back]

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of every text.

        All texts are cut into chunks. A chunk's map of states has two parts: the head up to the first start of a word acts on
        the state that comes in; the body after it starts anew and has one number and one end state. The maps of neighbours
        compose to such a map, and a parallel prefix scan over the chunks of each text makes those of all its prefixes.
        """
        if len(self.states) > MOST_STATES:
            self.clear()
        texts = [self.model.normalised(t)[0] for t in texts]
        size = np.array([len(t) for t in texts], np.int64)
        total = np.zeros(len(texts), np.int64)
        rows = np.flatnonzero(size)
        if not len(rows):
            return total
        kinds = self.classes[np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)].astype(np.int64)
        ends = np.cumsum(size)[rows]
        begins = ends - size[rows]
        begin = np.zeros(len(kinds), bool)
        begin[1:] = (kinds[:-1] < BYTES) | ((kinds[1:] == self.space) & (kinds[:-1] != self.space))
        begin[begins] = True
        chunks = -(-size[rows] // CHUNK)
        of = np.repeat(np.arange(len(rows)), chunks)
        first = np.repeat(np.cumsum(chunks) - chunks, chunks)
        here = np.arange(len(of))
        start = begins[of] + (here - first) * CHUNK
        stop = np.minimum(start + CHUNK, ends[of])
        words = np.append(np.flatnonzero(begin), len(kinds))
        body = np.minimum(words[np.searchsorted(words, start)], stop)
        anew = body < stop
        head, state = start.copy(), np.zeros(len(of), np.int64)
        state, emitted = self.run(state, body, stop, kinds)
        step = 1
        while step < chunks.max():
            right = here[here - step >= first]
            left = right - step
            known = anew[left]
            a, b = left[known], right[known]
            through, more = self.run(state[a], head[b], body[b], kinds)
            whole = anew[b]
            new = {"state": state.copy(), "emitted": emitted.copy(), "head": head.copy(), "body": body.copy(), "anew": anew.copy()}
            new["emitted"][b] = emitted[a] + more + np.where(whole, self.open[through] + emitted[b], 0)
            new["state"][b] = np.where(whole, state[b], through)
            new["head"][right], new["anew"][b] = head[left], True
            new["body"][b] = body[a]
            state, emitted, head, body, anew = (new[k] for k in ("state", "emitted", "head", "body", "anew"))
            step *= 2
        final = np.cumsum(chunks) - 1
        total[rows] = emitted[final] + self.open[state[final]]
        return total


def count_tokens(docs: DataFrame, limit: int = 4096, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text; other columns are ignored), whole texts.

    The counts are those of the sentencepiece library without begin or end. A null text is empty and has no tokens. Repeated
    rows get equal results; an empty table gives an empty table.
    """
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def columns(texts: list[str]) -> dict[str, pa.Array]:
        transducer = worker_state("token transducer", lambda: Transducer(read_model(sent.value)))
        counts = [transducer.count(texts[a:b]) for a, b in slices(texts, MOST_CHARS)]
        return {"n_tokens": pa.array(np.concatenate(counts) if counts else [], pa.int64())}

    sized = docs.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    counted = append_columns(sized, columns, "n_tokens long", ["doc_id", "n_bytes"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
