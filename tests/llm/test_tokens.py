import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from seqlab.llm import packing, pieces, token_fst
from seqlab.llm.piece_model import CharacterMap, PieceModel, _fields, identity, read_model

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DATA = open(MODEL, "rb").read()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture
def texts(odd_texts):
    rng = random.Random(5)
    alphabet = list("abetnrsi  ▁\n\t<s>é中𝔘́ﬁth")
    return [t or "" for t in odd_texts] + ["".join(rng.choices(alphabet, k=rng.randrange(600))) for _ in range(300)]


@pytest.mark.parametrize("chunk", [1, 3, 50, token_fst.CHUNK])
def test_transducer_counts_like_the_library(library, texts, chunk, monkeypatch):
    monkeypatch.setattr(token_fst, "CHUNK", chunk)
    transducer = token_fst.Transducer(read_model(DATA))
    want = [len(library.encode(t)) for t in texts]
    assert transducer.count(texts).tolist() == want
    monkeypatch.setattr(token_fst, "MOST_STATES", 10)  # forgets them all
    assert transducer.count(texts[::-1]).tolist() == want[::-1]
    assert transducer.count([]).tolist() == [] and transducer.count([""]).tolist() == [0]


def test_token_counts(documents, library, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "x"), (1, "")]
    found = token_fst.count_tokens(documents(rows), limit=3).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows]
    assert sorted(map(repr, (tuple(r) for r in found))) == sorted(repr((*w, w[2] > 3)) for w in want)
    assert token_fst.count_tokens(documents([])).count() == 0


def test_pieces_and_spans(documents, library, texts):
    encoder = pieces.Encoder(DATA)
    for text in texts:
        ids, bounds = encoder.encode(text)
        assert ids == library.encode(text)
        data = text.encode()
        assert bounds[0] == 0 and bounds[-1] == len(data) and (np.diff(bounds) >= 0).all()
        spans = [data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert b"".join(spans) == data
        for i, span in zip(ids, spans, strict=True):
            assert span.replace("▁".encode(), b" ").lstrip(b" ") == encoder.surface[i].lstrip(b" ")
        assert encoder.decode([*ids, 2]) == library.decode([*ids, 2])


def test_the_merger_changes_no_text(library, texts):
    merger = pieces.Encoder(DATA).merger
    assert merger.encode("a  b ") != library.encode("a  b ")  # no space in front
    for text in texts:
        assert merger.encode(read_model(DATA).normalised(text)[0]) == library.encode(text)


def test_any_ids_are_decoded(library):
    encoder = pieces.Encoder(DATA)
    byte = {n: i for i in range(library.get_piece_size()) for n in [library.id_to_piece(i)] if library.is_byte(i)}
    for ids in ([byte["<0xE4>"], byte["<0xBD>"]], [byte["<0xFF>"]] * 3, [0, 1, 2], [], library.encode("a b")[::-1]):
        assert encoder.decode(ids) == library.decode(ids)


def test_encoded_documents(documents, library, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "x"), (1, "")]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_eos=True)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)), len((t or "").encode())))
    found = pieces.encoded_digests(documents(rows)).collect()
    assert sorted(map(repr, (tuple(r) for r in found))) == sorted(map(repr, want))
    listed = {r["doc_id"]: [p["id"] for p in r["pieces"]] for r in pieces.encode(documents(rows[:-2])).collect()}
    assert listed == {i: library.encode(t or "") for i, t in rows[:-2]}
    assert pieces.encoded_digests(documents([])).count() == 0 == pieces.encode(documents([])).count()


@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_character_map_against_the_library(rule, squeeze, texts):
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    blob = dict(_fields(dict(_fields(normaliser.serialized_model_proto()))[3]))[2]
    model = PieceModel(prefix=True, squeeze=squeeze, characters=CharacterMap(blob))
    for text in ["ﬁ ½ Ｆｕｌｌ ｗｉｄｔｈ", "é a", "ガ ㌔", "ABC ŵ", *texts]:
        text = text.replace("▁", "")
        got, source = model.normalised(text)
        assert got == normaliser.normalize(text), text
        assert len(source) == len(got.encode()) + 1 and (np.diff(source) >= 0).all() and source[-1] <= len(text.encode())


def test_identity_alignment():
    assert identity("a b").tolist() == [0, 0, 0, 0, 1, 1, 1, 2, 3]


def test_fast_ids_are_the_tokenizers(texts):
    path = public_tokenizers.path
    encoder = packing.Encoder(open(path("byte_bpe_50k.json"), encoding="utf-8").read(), open(path("byte_bpe_50k.tiktoken"), "rb").read())
    plain = Tokenizer.from_file(path("byte_bpe_50k.json"))
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = ["".join(f"a{chr(c)}b {chr(c)}{chr(c)}1 {chr(c)} \n{chr(c)}!" for c in codes[i : i + 400]) for i in range(0, len(codes), 400)]
    for text in [*texts, *every, " " * 1_200_000 + "a", "x<|endoftext|>y <|endoftext|>"]:
        assert encoder.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def check_packing(rows, most):
    """Every place of every sequence holds one token, gapless from 0."""
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert 0 < end <= most
    return len(held)


def test_packed_documents(documents, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "x y z"), (1, ""), (1, "")] + [(100 + i, "word " * (i % 37)) for i in range(200)]
    most = 64
    found = packing.pack(documents(rows), most).collect()
    n = check_packing(found, most)
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [(i, [*plain.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
    want = []
    for i, x in ids:
        first = (len(x) - 1) % most + 1
        cuts = [0, *range(first, len(x) + 1, most)]
        want += [(i, k, a, b - a) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    assert sorted(map(repr, ((r["doc_id"], r["piece"], r["start"], r["length"]) for r in found))) == sorted(map(repr, want))
    assert n <= -(-sum(len(x) for _, x in ids) // most) * 1.02 + 1
    assert packing.pack(documents([]), most).count() == 0


def test_one_hot_length(documents):
    found = packing.pack(documents([(i, "same words") for i in range(500)]), 8, bucket=125).collect()
    assert check_packing(found, 8) == 250 and len({(r["sequence_id"], r["offset"]) for r in found}) == 500


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    rng = random.Random(seed)
    most = rng.choice([10, 60, 1024])
    counts = {rng.randint(1, most): rng.choice([1, 2, 7, 1000, 10**9]) for _ in range(rng.randint(1, 80))}
    rows = packing.plan(counts, most)
    for length, n in counts.items():
        ranges = sorted((a, b) for x, a, b, _, _ in rows if x == length)
        assert ranges[0][0] == 0 and ranges[-1][1] == n - 1 and all(p[1] + 1 == q[0] for p, q in zip(ranges, ranges[1:], strict=False))
    used = {}
    for length, a, b, sequence, offset in rows:
        used.setdefault((sequence, b - a + 1), []).append((offset, length))
    total = 0
    for (_, times), parts in used.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= most
        total += times
    spans = sorted((s, s + n) for s, n in used)
    assert all(p[1] <= q[0] for p, q in zip(spans, spans[1:], strict=False))
    assert total >= -(-sum(k * v for k, v in counts.items()) // most)


def test_complements_are_exact():
    from collections import Counter

    counts = Counter({700: 3, 324: 1, 200: 2, 124: 2, 100: 2, 24: 2, 1024: 5})
    plan = packing.complements(counts, 1024)
    assert all(sum(lengths) == 1024 for _, lengths in plan)
    assert (5, (1024,)) in plan and (1, (700, 324)) in plan and (2, (700, 200, 124)) in plan and counts[700] == 0
    assert packing.complements(Counter({700: 4, 200: 4, 100: 4, 24: 4}), 1024) == [(4, (700, 200, 100, 24))]
