"""K-mer containment: which share of a sample's distinct k-mers occurs in a reference set, in full or by sketches."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIECE = 10_000
#: Bytes of text whose k-mers a task has in memory at a time.
SLICE = 1 << 20
#: Runs that a task knows, to send each of them once.
KNOWN = 1 << 18
#: Numbers that a task keeps to send each of them once.
HELD = 1 << 21
#: Letters of text whose runs a task gathers before it sends those of each bucket as one compressed row.
GATHERED = 1 << 23
#: Letters that are copied from the gathered ones, and bytes that are unpacked, at a time.
COPIED = 1 << 20
#: Buckets of minimizers for each shuffle partition.
BUCKETS = 8
#: K-mers of a bucket that are held before repeats are taken out, and different ones of a side that are compared at a time.
REPEATS, DIFFERENT = 1 << 22, 1 << 23
#: Letters of a minimizer, at most.
MINIMIZER = 8
#: The same for k-mers that go as text: the shorter it is, the fewer letters go twice, and the more k-mers one minimizer has.
SHORT_MINIMIZER = 6
#: Fixed odd factors of the hash of a minimizer.
FACTORS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def minimizers(codes: np.ndarray, k: int, m: int) -> np.ndarray:
    """For each k-mer of some letters (uint64) the least hash of ``m`` letters in it."""
    value = numbers_of(codes, m, FACTORS[0])
    value = (value ^ (value >> np.uint64(30))) * np.uint64(FACTORS[1])
    value = (value ^ (value >> np.uint64(27))) * np.uint64(FACTORS[2])
    size, most = 1, k - m + 1
    while 2 * size <= most:
        value = np.minimum(value[:-size], value[size:])
        size *= 2
    return np.minimum(value[: len(value) - (most - size)], value[most - size :])


def numbers_of(letters: np.ndarray, k: int, factor: int) -> np.ndarray:
    """The number of every ``k`` letters in a row, in the base ``factor``, modulo 2**64."""
    if k == 1:
        return letters.copy()
    half = numbers_of(letters, k // 2, factor)
    out = half[: len(half) - k // 2] * np.uint64(pow(factor, k // 2, 2**64)) + half[k // 2 :]
    return out[:-1] * np.uint64(factor) + letters[k - 1 :] if k % 2 else out


def runs(text: str, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, starts, minimizers): where stretches of k-mers start that follow each other and have one minimizer."""
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(letters) < k:
        return letters, np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = minimizers(letters, k, m)
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return letters, starts, least[starts].view(np.int64)


#: MD5: its start, the left rotations of its four rounds, which word each step adds, and the constants of its 64 steps.
MD5_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
MD5_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
MD5_WORDS = ((1, 0), (5, 1), (3, 5), (7, 0))
MD5_STEPS = (np.abs(np.sin(np.arange(1, 65, dtype=np.float64))) * 2**32).astype(np.uint32)


def md5_heads(data: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """The first 15 hexadecimal digits of the MD5 of the ``n`` bytes of ``data`` at each of ``starts``, as numbers."""
    if n > 55:  # More than one block.
        whole = data.tobytes()
        return np.array([int(hashlib.md5(whole[i : i + n]).hexdigest()[:15], 16) for i in starts.tolist()], np.int64)
    padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
    words = padded[:-3] | padded[1:-2] << 8 | padded[2:-1] << 16 | padded[3:] << 24
    out = np.empty(len(starts), np.int64)
    for i in range(0, len(starts), 1 << 14):
        out[i : i + (1 << 14)] = md5_block(words, starts[i : i + (1 << 14)], n)
    return out


def md5_block(words: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """``md5_heads`` of one block each; ``words`` has the four bytes from each place on."""
    full, rest = divmod(n, 4)
    message: dict[int, np.ndarray | int] = {j: words[starts + 4 * j] for j in range(full)} | {14: 8 * n}
    message[full] = (words[starts + 4 * full] & ((1 << 8 * rest) - 1)) | (0x80 << 8 * rest) if rest else 0x80
    a, b, c, d = (np.full(len(starts), x, np.uint32) for x in MD5_START)
    for i in range(64):
        kind = i // 16
        if kind == 0:
            mixed = d ^ (b & (c ^ d))
        elif kind == 1:
            mixed = c ^ (d & (b ^ c))
        elif kind == 2:
            mixed = b ^ c ^ d
        else:
            mixed = c ^ (b | ~d)
        factor, offset = MD5_WORDS[kind]
        word = message.get((factor * i + offset) % 16, 0)
        mixed += a
        if isinstance(word, np.ndarray):
            mixed += word
            word = 0
        mixed += np.uint32((int(MD5_STEPS[i]) + word) % 2**32)
        turn = MD5_TURNS[kind][i % 4]
        a, b, c, d = d, ((mixed << turn) | (mixed >> (32 - turn))) + b, b, c
    first, second = ((x + np.uint32(y)).byteswap().astype(np.int64) for x, y in ((a, MD5_START[0]), (b, MD5_START[1])))
    return first << 28 | second >> 4


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts whose texts ``piece`` have about SLICE bytes: a batch of full pieces has a hundred times as many."""
    for batch in batches:
        part = np.cumsum(pc.binary_length(batch.column("piece")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        yield from (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds): the texts one after the other in UTF-8, and where each starts, and the end; a null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def sets_of(batch: pa.RecordBatch, keys: list[str]) -> list[tuple]:
    """The keys of each row."""
    return list(zip(*(batch.column(c).to_pylist() for c in keys), strict=True)) if keys else [()] * len(batch)


def hashes_of(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every k-mer of texts as of ``bytes_of``."""
    letters = np.flatnonzero((data & 0xC0) != 0x80)
    if len(letters) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.append(letters, len(data))[k:]
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(letters, bounds)))
    within = text[: len(ends)] == text[k - 1 :]
    starts, ends, text = letters[: len(ends)][within], ends[within], text[: len(ends)][within]
    sizes, hashes = ends - starts, np.empty(len(starts), np.int64)
    for n in np.unique(sizes).tolist():
        hashes[sizes == n] = md5_heads(data, starts[sizes == n], n)
    return text, hashes


def distinct_numbers(
    pieces: DataFrame, keys: list[str], name: str, numbers: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], size: int | None = None
) -> DataFrame:
    """(keys, name): the different ``numbers`` of ``pieces`` (keys, piece), with ``size`` only the least of a key.

    A task sends a number of a key once, or again after it had HELD different ones and let go of them, so what is made of the rows
    has to take out repeats. ``numbers`` gets texts as of ``bytes_of`` and returns (text, number).
    """
    types = [f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in keys] + [f"`{name}` bigint"]

    def told(held: dict[tuple, list[np.ndarray]], kinds: list[pa.DataType]) -> pa.RecordBatch:
        found = {key: np.unique(np.concatenate(parts))[:size] for key, parts in held.items()}
        place = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found.values()]))
        columns = [pa.array([key[j] for key in found], kind).take(place) for j, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(list(found.values())))], names=[*keys, name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[np.ndarray]] = {}
        n, kinds = 0, []
        for batch in slices(batches):
            kinds = [batch.schema.field(c).type for c in keys]
            places: dict[tuple, int] = {}
            owner = np.array([places.setdefault(key, len(places)) for key in sets_of(batch, keys)], np.int32)
            text, found = numbers(*bytes_of(batch.column("piece")))
            group = owner[text]
            if size is not None:
                most = [held[key][0][-1] if key in held and len(held[key][0]) == size else np.iinfo(np.int64).max for key in places]
                near = found <= np.array(most)[group]
                group, found = group[near], found[near]
            order = np.argsort(group, kind="stable")
            for key, part in zip(places, np.split(found[order], np.cumsum(np.bincount(group, minlength=len(places)))[:-1]), strict=True):
                if not len(part):
                    continue
                known = held.setdefault(key, [])
                known.append(np.unique(part))
                n += len(known[-1])
                if size is not None:
                    n -= sum(map(len, known))
                    known[:] = [np.unique(np.concatenate(known))[:size]]
                    n += len(known[0])
            if n > HELD:
                held = {key: [np.unique(np.concatenate(parts))] for key, parts in held.items()}
                n = sum(len(parts[0]) for parts in held.values())
                if n > HELD // 2:
                    yield told(held, kinds)
                    held, n = {}, 0
        if held:
            yield told(held, kinds)

    return pieces.mapInArrow(run, ", ".join(types))


def pieces_of(df: DataFrame, text: str, k: int, *keys: str, tasks: int | None = None) -> DataFrame:
    """(keys, piece): the texts in pieces that overlap by k - 1 letters, dealt out evenly over ``tasks``; left where they are if these are 0.

    A text or a file with a third of all bases does not stay in one task.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (k - 1), F.lit(1)), F.lit(PIECE))
    pieces = df.select(*keys, F.col(text).alias("_t"), F.explode(starts).alias("_s")).select(
        *keys, F.substring(F.col("_t"), F.col("_s"), F.lit(PIECE + k - 1)).alias("piece")
    )
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if tasks is None else tasks
    return pieces.repartition(tasks) if tasks else pieces


def dealt_runs(pieces: DataFrame, k: int, keys: list[str], factor: int | None) -> DataFrame:
    """(keys, run, minimizer), partitioned by minimizer: what holds all k-mers of ``pieces`` (keys, piece).

    Neighbouring k-mers mostly share their minimizer, so they go as one row: as a stretch of text, n + k - 1 letters for n
    k-mers, or with ``factor`` as the numbers of the k-mers. Equal k-mers have equal
    minimizers and meet in a partition, so what is made of runs there needs no other shuffle. A task has the runs of
    SLICE bytes in memory at a time, however long its texts are, and sends a run that is among the last KNOWN ones not again.
    """
    m, kind = min(MINIMIZER, k), pa.string() if factor is None else pa.list_(pa.int64())
    types = [f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in keys] + [f"run {'string' if factor is None else 'array<bigint>'}", "minimizer bigint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, places = pd.DataFrame(), {}
        for batch in slices(batches):
            at, counts, least, values, texts = ([] for _ in range(5))
            for i, piece in enumerate(batch.column("piece").to_pylist()):
                letters, starts, found = runs(piece or "", k, m)
                if not len(starts):
                    continue
                ends = np.append(starts[1:], len(letters) - k + 1)
                at.append(np.full(len(starts), i, np.int32))
                counts.append(ends - starts)
                least.append(found)
                values.append(numbers_of(letters, k, factor or FACTORS[1]).view(np.int64))
                if factor is None:
                    texts += [piece[a : b + k - 1] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            joined = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
            at, counts, least, values = joined(at, np.int32), joined(counts, np.int64), joined(least, np.int64), joined(values, np.int64)
            stops = np.cumsum(counts)
            # The first and the last k-mer of a run mostly hold all its letters; of a long run, one minimizer again and again, they don't.
            # The numbers are sums of letters, so they are mixed before they are summed.
            mixed = values.view(np.uint64)
            mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(FACTORS[2])
            mixed = (mixed ^ (mixed >> np.uint64(27))).view(np.int64)
            total = np.add.reduceat(mixed, stops - counts) if len(counts) else mixed
            same = {"n": counts, "first": values[stops - counts], "last": values[stops - 1], "total": total}
            owner = [places.setdefault(key, len(places)) for key in sets_of(batch, keys)]
            seen = pd.concat([known, pd.DataFrame(same | {"owner": np.array(owner, np.int64)[at]})], ignore_index=True)
            repeated = seen.duplicated().to_numpy()
            new = pa.array(~repeated[len(known) :])
            known = seen[~repeated].iloc[-KNOWN:]
            if len(places) > KNOWN:
                known, places = pd.DataFrame(), {}
            if factor is None:
                told = pa.array(texts, kind)
            else:
                told = pa.ListArray.from_arrays(pa.array(np.append(0, stops), pa.int32()), pa.array(values))
            rows = pa.array(at).filter(new)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in keys), told.filter(new), pa.array(least).filter(new)], names=[*keys, "run", "minimizer"])

    return pieces.mapInArrow(run, ", ".join(types)).repartition("minimizer")


def kmers(df: DataFrame, text: str, k: int, *keys: str, scale: int = 1) -> DataFrame:
    """Distinct (keys, kmer) as text. ``scale`` > 1 keeps the k-mers of one of ``scale`` classes of a hash: a sketch whose
    containment estimates the full one."""
    pattern = F.lit(r"(?s)(?![\uDC00-\uDFFF])(?=(.{%d}))" % k)
    dealt = dealt_runs(pieces_of(df, text, k, *keys), k, list(keys), None)
    found = dealt.select(*keys, "minimizer", F.explode(F.regexp_extract_all("run", pattern, F.lit(1))).alias("kmer"))
    if scale > 1:
        found = found.where(F.pmod(F.xxhash64("kmer"), F.lit(scale)) == 0)
    return found.distinct().select(*keys, "kmer")


def numbered_kmers(pieces: DataFrame, k: int, keys: list[str], factor: int) -> DataFrame:
    """Distinct (keys, minimizer, kmer) of ``pieces``: kmer is the number of the letters, see ``dealt_runs``."""
    dealt = dealt_runs(pieces, k, keys, factor)
    return dealt.select(*keys, "minimizer", F.explode("run").alias("kmer")).distinct()


def letters_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(letters, text): the code points of texts one after the other, and which text each is of; a null is empty."""
    data, bounds = bytes_of(texts)
    letters = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    before = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    return letters, np.repeat(np.arange(len(bounds) - 1), np.diff(before[bounds]))


def stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of stretches of some sizes, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def bucketed_runs(pieces: DataFrame, k: int, key: str, buckets: int) -> DataFrame:
    """(bucket, owners, runs, kmers, size, letters): what holds all k-mers of ``pieces`` (key, piece), as compressed text.

    Neighbouring k-mers that share a minimizer are a run, n + k - 1 letters for n k-mers; ``bucket`` is of the minimizer, so equal
    k-mers have equal buckets. A row has the runs of a bucket among GATHERED letters of a task: ``runs`` says how many each of
    ``owners`` has, in their order, ``kmers`` (compressed) how many k-mers each run has, ``letters`` (compressed, ``size`` bytes) is
    the text of all runs.
    """
    m = min(SHORT_MINIMIZER, k)

    def told(held: list[tuple[np.ndarray, ...]], keys: pa.Array) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        sizes = [len(h[0]) for h in held]
        letters = np.concatenate([h[0] for h in held])
        starts = np.concatenate([h[1] + at for h, at in zip(held, np.cumsum(sizes) - sizes, strict=True)])
        counts, owner, bucket = (np.concatenate([h[i] for h in held]) for i in (2, 3, 4))
        held.clear()
        order = np.argsort(bucket * len(keys) + owner)
        starts, counts, owner, bucket = starts[order], counts[order], owner[order], bucket[order]
        cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        ends = np.append(0, np.cumsum(counts + k - 1))[cuts]
        for part in np.split(np.arange(len(cuts) - 1), np.flatnonzero(np.diff(ends[:-1] // COPIED)) + 1):
            low, high = cuts[part[0]], cuts[part[-1] + 1]
            copied = letters[stretches(starts[low:high], counts[low:high] + k - 1)]
            rows = []
            for i in part.tolist():
                a, b = cuts[i], cuts[i + 1]
                who = np.append(0, np.flatnonzero(np.diff(owner[a:b])) + 1)
                text = copied[ends[i] - ends[part[0]] : ends[i + 1] - ends[part[0]]].tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
                rows.append((bucket[a], keys.take(pa.array(owner[a:b][who])), np.diff(np.append(who, b - a)), codec.compress(counts[a:b].astype(np.int32), asbytes=True), len(text), codec.compress(text, asbytes=True)))
            ids, owners, runs, kmers, size, texts = zip(*rows, strict=True)
            whose = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(x) for x in owners])), pa.int32()), pa.concat_arrays(owners))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), whose, pa.array(runs, pa.list_(pa.int32())), pa.array(kmers, pa.binary()), pa.array(size, pa.int64()), pa.array(texts, pa.binary())],
                names=["bucket", "owners", "runs", "kmers", "size", "letters"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict = {}
        held, n, kind = [], 0, None
        for batch in slices(batches):
            kind = batch.schema.field(key).type
            letters, text = letters_of(batch.column("piece"))
            within = np.flatnonzero(text[: max(len(text) - k + 1, 0)] == text[k - 1 :])
            if not len(within):
                continue
            least, text = minimizers(letters.astype(np.uint64), k, m)[within], text[within]
            first = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (text[1:] != text[:-1])))
            owner = np.array([places.setdefault(x, len(places)) for x in batch.column(key).to_pylist()], np.int64)
            # The least of some hashes has small leading bits; those in the middle are even.
            bucket = (least[first] >> np.uint64(16)) % np.uint64(buckets)
            held.append((letters, within[first], np.diff(np.append(first, len(within))), owner[text[first]], bucket.astype(np.int64)))
            n += len(letters)
            if n >= GATHERED:
                yield from told(held, pa.array(list(places), kind))
                places, held, n = {}, [], 0
        if held:
            yield from told(held, pa.array(list(places), kind))

    kind = pieces.schema[key].dataType.simpleString()
    return pieces.mapInArrow(run, f"bucket bigint, owners array<{kind}>, runs array<int>, kmers binary, size bigint, letters binary")


def two_numbers(letters: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers of every ``k`` letters in a row (uint64), which together tell the numbers of both halves."""
    if k == 1:
        return letters, letters
    half = numbers_of(letters, k // 2, FACTORS[1])
    one, two = half[: len(letters) - 2 * (k // 2) + 1], half[k // 2 :]
    # One factor is odd and the other is even, so both numbers are equal only if both halves are.
    first, second = one * np.uint64(pow(FACTORS[1], k // 2, 2**64)) + two, one * np.uint64(FACTORS[2] - 1) + two
    if k % 2:
        first, second = (x[:-1] * np.uint64(f) + letters[k - 1 :] for x, f in ((first, FACTORS[1]), (second, FACTORS[0])))
    return first, second


def unrepeated(parts: list[np.ndarray]) -> np.ndarray:
    """The different values of some arrays, ascending; a sort is many times as fast as ``numpy.unique``."""
    found = np.concatenate(parts)
    found.sort()
    return found[np.append(True, found[1:] != found[:-1])] if len(found) else found


def owners_of(rows: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """(names, place): the different owners of a bucket, and the place of each entry of the column ``owners`` among them."""
    told = pc.list_flatten(rows.column("owners")).combine_chunks().dictionary_encode("encode")
    return told.dictionary, told.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def bucket_kmers(rows: pa.Table, owners: np.ndarray, k: int, bits: int, low: float, high: float, scale: int) -> np.ndarray | None:
    """The different (k-mer, owner) of a bucket as of ``bucketed_runs``, ascending; None if they are more than DIFFERENT.

    A value is a complex number of two whole ones of 53 bits: the leading bits of the first number of the k-mer, and those of the
    second one with the place of the owner as the last ``bits``. The first one is in ``low`` to before ``high``; ``scale`` keeps the
    k-mers of one of as many classes.
    """
    codec, held, n, most = pa.Codec("zstd"), [np.zeros(0, np.complex128)], 0, REPEATS
    size, runs = rows.column("size").to_numpy(), pc.list_flatten(rows.column("runs")).to_numpy()
    entries = np.append(0, np.cumsum(pc.list_value_length(rows.column("runs")).to_numpy()))
    before = np.append(0, np.cumsum(runs))[entries]
    for some in np.split(np.arange(len(size)), np.flatnonzero(np.diff(np.cumsum(size) // COPIED)) + 1):
        if not len(some):
            continue
        a, b = some[0], some[-1] + 1
        packed = zip(rows.column("kmers")[a:b], (4 * np.diff(before)[a:b]).tolist(), rows.column("letters")[a:b], size[a:b].tolist(), strict=True)
        unpacked = [(codec.decompress(x.as_buffer(), i, asbytes=True), codec.decompress(y.as_buffer(), j, asbytes=True)) for x, i, y, j in packed]
        counts = np.frombuffer(b"".join(x for x, _ in unpacked), np.int32).astype(np.int64)
        text = b"".join(x for _, x in unpacked).decode("utf-8", "surrogatepass")
        letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        at = stretches(np.cumsum(counts + k - 1) - counts - (k - 1), counts)
        # The last letters alone make little difference to the numbers, so these are mixed before their leading bits are taken.
        first, second = ((x ^ (x >> np.uint64(32))) * np.uint64(factor) for x, factor in zip((y[at] for y in two_numbers(letters, k)), FACTORS))
        whose = np.repeat(np.repeat(owners[entries[a] : entries[b]], runs[entries[a] : entries[b]]), counts).astype(np.uint64)
        found = np.empty(len(at), np.complex128)
        found.real = first >> np.uint64(11)
        found.imag = second >> np.uint64(11 + bits) << np.uint64(bits) | whose
        if scale > 1:
            found = found[found.real % scale == 0]
        if (low, high) != (0, 2.0**53):
            found = found[(found.real >= low) & (found.real < high)]
        held.append(found)
        n += len(found)
        if n > most:
            held = [unrepeated(held)]
            n = len(held[0])
            most = n + REPEATS
            if n > DIFFERENT:
                return None
    return unrepeated(held)


def compared(own: pa.Table, known: pa.Table, k: int, scale: int) -> Iterator[tuple[bool, pa.Array, pa.Array, np.ndarray]]:
    """(whole, samples, references, counts) of a bucket: how many k-mers each sample has as a whole, and how many each pair shares.

    If there are too many different k-mers, those in a range of their numbers are taken at a time.
    """
    (names, owners), (sets, members) = owners_of(own), owners_of(known)
    bits, parts, part = max(len(names), len(sets)).bit_length(), 1, 0
    while part < parts:
        low, high = part * 2.0**53 / parts, (part + 1) * 2.0**53 / parts
        left = bucket_kmers(own, owners, k, bits, low, high, scale)
        right = None if left is None else bucket_kmers(known, members, k, bits, low, high, scale)
        if right is None:
            parts, part = 2 * parts, 2 * part
            continue
        part += 1
        samples, references = (side.imag.astype(np.int64) % (1 << bits) for side in (left, right))
        counts = np.bincount(samples, minlength=len(names))
        there = np.flatnonzero(counts)
        yield True, names.take(pa.array(there)), pa.nulls(len(there), sets.type), counts[there]
        left.imag, right.imag = left.imag - samples, right.imag - references
        at, stop = np.searchsorted(left, right, "left"), np.searchsorted(left, right, "right")
        met = np.flatnonzero(stop > at)
        at, sizes, references = at[met], (stop - at)[met], references[met]
        for some in np.split(np.arange(len(met)), np.flatnonzero(np.diff(np.cumsum(sizes) // REPEATS)) + 1):
            if len(some):
                pairs = samples[stretches(at[some], sizes[some])] * len(sets) + np.repeat(references[some], sizes[some])
                pairs.sort()
                new = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
                one, two = np.divmod(pairs[new], len(sets))
                yield False, names.take(pa.array(one)), sets.take(pa.array(two)), np.diff(np.append(new, len(pairs)))


def kmer_containment(
    samples: DataFrame, references: DataFrame, sample: str, sample_text: str, reference: str, reference_text: str, k: int = 20, scale: int = 1
) -> DataFrame:
    """Share of each sample's distinct k-mers found in each reference set that it shares any with. ``scale`` > 1: of a sketch of both.

    K-mers go as compressed text to buckets of their minimizers, where they are made distinct, counted and compared; then what the
    buckets say of a pair is added up. In a bucket, k-mers are told apart by the leading 85 bits, or more, of two numbers of all their
    letters, as long as fewer than 2 million sets are in it.
    """
    spark = samples.sparkSession
    buckets, tasks = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    kinds, dealt = [], []
    for df, text, by in ((samples.where(F.col(sample).isNotNull()), sample_text, sample), (references, reference_text, reference)):
        # Only texts that fewer tasks read than can run at once are dealt out before.
        pieces = pieces_of(df, text, k, by, tasks=tasks if df.rdd.getNumPartitions() < tasks else 0)
        kinds.append(pieces.schema[by].dataType.simpleString())
        dealt.append(bucketed_runs(pieces, k, by, buckets).groupBy("bucket"))

    def run(own: pa.Table, known: pa.Table) -> pa.Table:
        types = [side.schema.field("owners").type.value_type for side in (own, known)]
        schema = pa.schema([(sample, types[0]), (reference, types[1]), ("_whole", pa.bool_()), ("_n", pa.int64())])
        told = compared(own, known, k, scale) if len(own) else []
        return pa.concat_tables([schema.empty_table(), *(pa.Table.from_arrays([a, b, pa.array([whole] * len(n), pa.bool_()), pa.array(n)], schema=schema) for whole, a, b, n in told)])

    counted = dealt[0].cogroup(dealt[1]).applyInArrow(run, f"`{sample}` {kinds[0]}, `{reference}` {kinds[1]}, _whole boolean, _n bigint")
    added = counted.groupBy(sample, reference, "_whole").agg(F.sum("_n").alias("n_shared"))
    n_kmers = F.max(F.when(F.col("_whole"), F.col("n_shared"))).over(Window.partitionBy(sample))
    return (
        added.select(sample, reference, n_kmers.alias("n_kmers"), "n_shared", "_whole")
        .where(~F.col("_whole"))
        .drop("_whole")
        .withColumn("containment", F.col("n_shared") / F.col("n_kmers"))
    )


def encoded_kmers(df: DataFrame, text: str, k: int, *keys: str) -> DataFrame:
    """Distinct (keys, kmer) of the k-mers of A, C, G and T, each as a number of two bits a base; k is 31 at most.

    Upper case only. A k-mer with any other character is none here: ``kmers`` keeps it as text. A task makes the numbers from the
    bytes of many texts at once and sends each number of a key once as far as it can hold them, so short k-mers cost what there are
    of them and not what there is of text.
    """
    if not 0 < k <= 31:
        raise ValueError("k is 1 to 31.")
    return distinct_numbers(pieces_of(df, text, k, *keys), list(keys), "kmer", lambda data, bounds: codes_of(data, bounds, k)).distinct()


def codes_of(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of every k-mer of A, C, G and T of texts as of ``bytes_of``."""
    if len(data) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    digits = np.full(256, 4, np.uint64)
    digits[[ord(c) for c in "ACGT"]] = range(4)
    letters = digits[data]
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    others = np.append(0, np.cumsum(letters == 4))
    within = (text[: len(text) - k + 1] == text[k - 1 :]) & (others[:-k] == others[k:])
    return text[: len(within)][within], numbers_of(letters, k, 4)[within].view(np.int64)


def sketches(df: DataFrame, text: str, k: int, size: int, *keys: str) -> DataFrame:
    """(keys, sketch): the ``size`` least hashes of the distinct k-mers of each set, ascending; of all, if it has fewer.

    Sketches merge: that of a union is made of the least of both. A k-mer's hash is 60 bits of the MD5 of its text, so hashes of
    different sets compare. Each task hashes its k-mers where it reads them and keeps the ``size`` least of each set, so hashes of
    sketches are all that is shuffled. A null text has none.
    """
    hashed = distinct_numbers(pieces_of(df, text, k, *keys), list(keys), "hash", lambda data, bounds: hashes_of(data, bounds, k), size)
    return least_hashes(hashed, size, *keys)


def least_hashes(hashed: DataFrame, size: int, *keys: str) -> DataFrame:
    """(keys, sketch) of (keys, hash): the ``size`` least different hashes of each set, ascending."""
    place = F.dense_rank().over(Window.partitionBy(*keys).orderBy("hash"))
    least = hashed.withColumn("_place", place).where(F.col("_place") <= size)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_set("hash")).alias("sketch"))


def merged_sketches(parts: DataFrame, key: str, size: int) -> DataFrame:
    """(key, sketch) of several sketches (key, sketch) of each key, as that of all their k-mers would be."""
    return least_hashes(parts.select(key, F.explode("sketch").alias("hash")), size, key)


def sketch_distances(left: DataFrame, right: DataFrame, left_key: str, right_key: str, size: int, k: int) -> DataFrame:
    """(left_key, right_key, n_compared, n_common, similarity, distance) of all pairs of sketches that share a hash.

    n_compared is the number of hashes of the sketch of both together, n_common how many of these both have; similarity is their
    share and estimates that of all k-mers. distance = -ln(2 s / (1 + s)) / k is the mutation rate that would leave it. Pairs are
    found by their hashes, so sets that share none cost nothing.
    """
    a, b = (s.select(F.col(c).alias(f"_{c}"), F.col("sketch").alias(f"_s{i}")) for i, (s, c) in enumerate(((left, left_key), (right, right_key))))
    one, two = (s.select(s.columns[0], F.explode(s.columns[1]).alias("_hash")) for s in (a, b))
    pairs = one.join(two, "_hash").select(one.columns[0], two.columns[0]).distinct()
    both = pairs.join(a, a.columns[0]).join(b, b.columns[0])
    merged = F.slice(F.array_sort(F.array_union("_s0", "_s1")), 1, size)
    met = both.withColumn("_merged", merged).withColumn("n_common", F.size(F.array_intersect(F.array_intersect("_s0", "_s1"), "_merged")).cast("bigint"))
    share = F.col("n_common") / F.col("n_compared")
    named = met.select(F.col(a.columns[0]).alias(left_key), F.col(b.columns[0]).alias(right_key), F.size("_merged").cast("bigint").alias("n_compared"), "n_common")
    distance = F.when(F.col("n_common") > 0, F.abs(F.log(2 * share / (1 + share))) / k)
    return named.withColumns({"similarity": share, "distance": distance})
