"""Document fingerprints of spot signatures: chains of content words that follow common words."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqlab.session import land

#: The common words of English, German, French and Spanish that anchor a chain.
ANCHORS = (
    "the", "a", "an", "of", "and", "to", "in", "is", "it", "that", "for", "on", "with", "as", "by", "at", "be", "this", "are", "was", "from", "or",
    "der", "die", "das", "und", "zu", "den", "von", "mit", "ist", "für", "nicht", "ein", "eine", "auf", "des", "im", "dem", "sich",
    "le", "la", "les", "du", "et", "un", "une", "en", "que", "qui", "dans", "pour", "pas", "est", "sur", "au", "avec",
    "el", "los", "las", "de", "y", "por", "con", "se", "del", "lo", "como", "no", "es", "para",
)
#: Content words of a chain, and the share of Jaccard that near-duplicates have in common.
CHAIN, THRESHOLD = 3, 0.8
#: Ranges of neighbouring ids for each shuffle partition, and in all at most.
RANGES, MOST_RANGES = 4, 4096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def signatures(text: Column, cover: bool = False) -> Column:
    """The sorted distinct signatures of a whole text, as hashes: an anchor and the next ``CHAIN`` words that are no anchors.

    Words are runs of letters and digits in lower case. The start of the text is an anchor too and a chain may be cut short
    by the end, so every text has a signature; null is empty. With ``cover`` a word that is in no chain of these anchors starts a
    chain of its own, so that every word is in a signature, in any language and script.
    """
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    # Anchors are glued in front of the word that follows: "^~of~the~house".
    glued = F.regexp_replace(F.concat(F.lit(" "), words, F.lit(" ")), f"(?<= )({'|'.join(ANCHORS)}) ", "$1~")
    items = F.split(F.concat(F.lit("^~"), F.trim(glued)), " ")

    def of_item(found: Column, content: Column) -> Callable[[Column, Column], Column]:
        def hashes(item: Column, i: Column) -> Column:
            chain = [F.get(content, i + k) for k in range(CHAIN)]
            anchors = F.split(item, "~")
            named = F.transform(F.slice(anchors, F.lit(1), F.size(anchors) - 1), lambda a: F.xxhash64(a, *chain))
            if not cover:
                return named
            bare = [~F.contains(F.get(found, i - k), F.lit("~")) for k in range(CHAIN)]  # the first item never is
            return F.when(reduce(and_, bare), F.array(F.xxhash64(F.lit("~"), *chain))).otherwise(named)

        return hashes

    contents = lambda found: F.transform(found, lambda item: F.substring_index(item, "~", -1))
    return let(items, lambda found: let(contents(found), lambda content: F.array_sort(F.array_distinct(F.flatten(F.transform(found, of_item(found, content)))))))


def fingerprint(hashes: Column) -> Column:
    """A string that holds the signatures, 16 hexadecimal digits each."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def jaccard(left: Column, right: Column, least: float = 0.0) -> Column:
    """The Jaccard similarity of two sets; 0 if it is below ``least``. Sets whose sizes alone rule ``least`` out aren't compared."""
    small, large = F.least(F.size(left), F.size(right)), F.greatest(F.size(left), F.size(right))
    shared = F.size(F.array_intersect(left, right))
    exact = let(shared, lambda n: n / (small + large - n))
    return F.when((small >= least * large) & (large > 0), F.when(exact >= least, exact).otherwise(0.0)).otherwise(0.0)


def length_partition(size: Column, threshold: float = THRESHOLD) -> Column:
    """The partition of a set by its size: similar sets are in the same one or in neighbours."""
    return F.floor(F.log(size.cast("double")) / math.log(1 / threshold) + 1e-9).cast("int")


def similar(docs: DataFrame, threshold: float = THRESHOLD, cover: bool = False) -> tuple[DataFrame, DataFrame]:
    """Near-duplicates by Jaccard of the signatures: (members, links) of ``docs`` (doc_id, text).

    ``cover`` is that of ``signatures``: without it, texts that differ only in words of no chain are one class. members has doc_id
    and class_id, the smallest doc_id with the same signatures; links has a, b (classes, a < b) and similarity.
    A set is looked up by its rarest signatures alone, as many as two similar sets can't both miss, under the length
    partitions that it may meet; candidates are compared through their sizes first. Copies are one class, so they cost no
    pairs. Rows without an id are no members; an empty table gives empty tables.
    """
    sets = docs.where("doc_id is not null").select("doc_id", signatures(F.col("text"), cover).alias("hashes"))
    keyed = land(sets.withColumn("set_id", F.md5(fingerprint(F.col("hashes")))), "signatures")
    classes = keyed.groupBy("set_id").agg(F.min("doc_id").alias("class_id"), F.first("hashes").alias("hashes"))
    classes = land(classes, "signature_classes")
    members = keyed.join(classes.select("set_id", "class_id"), "set_id").select("doc_id", "class_id")
    each = classes.select("class_id", F.size("hashes").alias("size"), F.explode("hashes").alias("hash"))
    rare = each.join(each.groupBy("hash").agg(F.count(F.lit(1)).alias("uses")), "hash")
    place = F.row_number().over(Window.partitionBy("class_id").orderBy("uses", "hash"))
    index = rare.withColumn("place", place).where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1)
    index = index.withColumn("part", length_partition(F.col("size"), threshold)).select("hash", "part", "class_id", "size")
    probes = index.select("hash", F.explode(F.array("part", F.col("part") + 1)).alias("part"), F.col("class_id").alias("a"), F.col("size").alias("size_a"))
    close = (F.col("size_a") <= F.col("size")) & (F.col("size_a") >= F.col("size") * threshold - 1e-9) & ((F.col("size_a") < F.col("size")) | (F.col("a") < F.col("class_id")))
    found = probes.join(index, ["hash", "part"]).where(close).select(F.least("a", "class_id").alias("a"), F.greatest("a", "class_id").alias("b")).distinct()
    one, two = (classes.select(F.col("class_id").alias(c), F.col("hashes").alias(f"{c}_hashes")) for c in "ab")
    links = found.join(one, "a").join(two, "b").select("a", "b", jaccard(F.col("a_hashes"), F.col("b_hashes"), threshold).alias("similarity"))
    return members, links.where("similarity > 0")


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) with the signatures of the text, and text and signatures of the next document: next_text, next_hashes.

    The next of a document is the one before it by doc_id, and after the last comes the first; null ids come last and equal ids
    by text, descending. Ids are cut into ranges of about equal size, whose bounds come from a narrow pass; the first
    document of each range is a guest at the end of the range before. So the texts are shuffled once and each range is a
    window of its own.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranges = ranges or min(MOST_RANGES, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5], 100_000)).first()[0]
    bounds = sorted(set(cuts or []))
    if bounds:
        steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
        held = F.array(*map(F.lit, bounds))
        further = lambda at, step: (at + step <= len(bounds)) & (F.get(held, at + step - 1) <= F.col("doc_id"))
        found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(further(at, step), at + step).otherwise(at))
    else:
        found = F.lit(0)
    placed = docs.withColumn("range", F.coalesce(F.when(F.col("doc_id").isNotNull(), found), F.lit(0)))
    firsts = sorted((r["range"], r["first"]) for r in placed.groupBy("range").agg(F.max("doc_id").alias("first")).collect())
    hosts = [(first, firsts[(i + 1) % len(firsts)][0]) for i, (_, first) in enumerate(firsts)]
    guests = spark.createDataFrame(hosts, f"first {docs.schema['doc_id'].dataType.simpleString()}, host int")
    guests = F.broadcast(guests)  # at most MOST_RANGES rows
    sent = placed.join(guests, placed["doc_id"].eqNullSafe(guests["first"]), "left")
    sent = sent.select("doc_id", "text", F.explode(F.when(F.col("host").isNull(), F.array(F.struct("range", F.lit(False).alias("guest")))).otherwise(
        F.array(F.struct("range", F.lit(False).alias("guest")), F.struct(F.col("host").alias("range"), F.lit(True).alias("guest"))))).alias("at"))
    dealt = sent.select("doc_id", "text", "at.range", "at.guest").repartition("range").withColumn("hashes", signatures(F.col("text"), cover=True))
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("text"))
    following = dealt.withColumns({"next_text": F.lead("text").over(order), "next_hashes": F.lead("hashes").over(order)})
    return following.where(~F.col("guest")).select("doc_id", "text", "hashes", "next_text", "next_hashes")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every whole text of ``docs`` (doc_id, text; other columns are ignored) and its edited text, fingerprinted and compared.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, signatures, length_partition). The
    edited text has its last third replaced by the first code points of the next document. A null text is empty; repeated
    rows are documents of their own; an empty table gives an empty table.
    """
    pairs = with_next(docs)
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.left("text", F.length("text") - third), F.left("next_text", third))
    made = pairs.withColumn("edited", edited).withColumn("edited_hashes", signatures(F.col("edited"), cover=True))
    return made.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("hashes")).alias("fingerprint"),
        fingerprint(F.col("edited_hashes")).alias("edited_fingerprint"),
        jaccard(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        jaccard(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
        F.size("hashes").alias("signatures"),
        length_partition(F.size("hashes")).alias("length_partition"),
    )
