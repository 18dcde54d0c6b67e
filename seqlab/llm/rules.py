"""Quality rules as a ledger: every rule is evaluated once, its failure is a bit, and policies are masks over the bits.

A policy or an ablation reads the narrow ledger, never a text. Everything is built-in functions in one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The characters between words, the class of words, and the symbols that are counted.
SPACES = " \t\n\x0b\x0c\r"
GAPS, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Words of a window that is looked for twice in a text.
WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """A rule with the bit of the ledger that its failure sets; a bit is never used again for another rule."""

    bit: int
    name: str
    fails: Callable[[], Column]


@dataclass(frozen=True)
class Policy:
    """A version of what is required: a document stays if it fails none of the rules in the mask."""

    version: int
    mask: int


def measure(name: str) -> Column:
    return F.col(name)


RULES = (
    Rule(0, "few_words", lambda: measure("n_words") < 10),
    Rule(1, "repeated_windows", lambda: 100 * measure("n_repeat_words") > 20 * measure("n_words")),
    Rule(2, "short_words", lambda: measure("word_chars") < 2 * measure("n_words")),
    Rule(3, "long_words", lambda: measure("word_chars") > 14 * measure("n_words")),
    Rule(4, "symbols", lambda: 10 * measure("n_symbols") > measure("n_words")),
    Rule(5, "repeated_lines", lambda: 10 * measure("n_dup_lines") > 3 * measure("n_lines")),
    Rule(6, "many_words", lambda: measure("n_words") > 100_000),
)
#: Version 1 is the base. Version 2 adds the shape of words, symbols and lines. Version 3 also bounds the length.
POLICIES = (Policy(1, 0b0000011), Policy(2, 0b0111111), Policy(3, 0b1111111))
BASE, PRODUCTION = POLICIES[0], POLICIES[1]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column) -> Column:
    """The words of a text; an empty array if it has none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAPS))


def equal_neighbours(ordered: Column, key: Callable[[Column], Column]) -> Column:
    """The elements of a sorted array whose key is that of the element before or after."""
    same = lambda x, other: F.coalesce(key(x) == key(other), F.lit(False))
    return F.filter(ordered, lambda x, i: same(x, F.get(ordered, i - 1)) | same(x, F.get(ordered, i + 1)))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words are in windows of ``window`` words that the text holds twice or more.

    Windows become numbers, 32 bits of a hash before 32 bits of their place, whose order puts equal windows side by side. The
    few that share a hash are compared as text. Each window then adds the words beyond the one before it.
    """
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(words) - window),
        lambda i: F.shiftleft(F.hash(*(F.get(words, i + k) for k in range(window))).cast("long"), 32).bitwiseOR(i.cast("long")),
    )
    place = lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    likely = let(F.sort_array(hashed), lambda codes: equal_neighbours(codes, lambda x: F.shiftright(x, 32)))
    told = F.transform(likely, lambda x: F.struct(F.array_join(F.slice(words, place(x) + 1, window), " ").alias("said"), place(x).alias("at")))
    found = let(F.array_sort(told), lambda t: equal_neighbours(t, lambda x: x["said"]))
    places = F.array_sort(F.transform(found, lambda x: x["at"]))
    start = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("words"))
    step = lambda a, at: F.struct(at.alias("last"), (a["words"] + F.least(F.lit(window), at - a["last"])).alias("words"))
    counted = F.aggregate(places, start, step, lambda a: a["words"])
    return F.when(F.size(words) > window, counted).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words), all counts long, of every whole text.

    Other columns are ignored; a null text has no words; repeated rows are measured each; an empty table gives an empty table.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)).alias("lines")
    parts = texts.select("doc_id", split_words(F.col("text")).alias("words"), F.regexp_count("text", F.lit(SYMBOLS)).alias("n_symbols"), lines)
    return parts.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        let(F.col("words"), lambda words: repeated_words(words, window)).alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measurements of every document and ``failures``, a long with the bit of each rule that it fails."""
    bits = [r.bit for r in rules]
    if len(set(bits)) < len(bits) or not all(0 <= b < 63 for b in bits):
        raise ValueError("Each rule needs a bit of its own from 0 to 62.")
    failed = F.lit(0).cast("long")
    for r in rules:
        failed = failed.bitwiseOR(F.when(r.fails(), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured(docs).withColumn("failures", failed)


def passes(failures: Column, policy: Policy) -> Column:
    """Whether a document stays under a policy."""
    return failures.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def decisive(failures: Column, policy: Policy) -> Column:
    """The bit of the one rule without which the policy would keep the document; null if none or several would be needed."""
    hit = failures.bitwiseAND(F.lit(policy.mask).cast("long"))
    return F.when(F.bit_count(hit) == 1, F.bit_count(hit - 1))


def ablations(entries: DataFrame, policies: tuple[Policy, ...] = POLICIES, rules: tuple[Rule, ...] = RULES, by: list[str] | None = None) -> DataFrame:
    """What each rule does in each policy that has it: (*by, version, rule, documents, kept, failing, decisive, kept_without).

    ``entries`` is a ledger, with the columns ``by`` if the counts are wanted for each of their values (null is a value). Equal
    masks are counted before the shuffle, so at most 2 ** rules rows of each value are left to be aggregated. failing counts the
    documents that fail the rule, decisive those that fail it alone; kept_without is kept + decisive. No documents give no rows.
    """
    by = by or []
    masks = entries.groupBy(*by, "failures").agg(F.count(F.lit(1)).alias("n"))
    pairs = [(p, r) for p in policies for r in rules if p.mask >> r.bit & 1]
    stated = F.array(*(F.struct(F.lit(p.version).alias("version"), F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("one"), F.lit(p.mask).cast("long").alias("mask")) for p, r in pairs))
    each = masks.select(*by, "failures", "n", F.inline(stated))
    hit, count = F.col("failures").bitwiseAND(F.col("mask")), lambda when: F.sum(F.when(when, F.col("n")).otherwise(F.lit(0).cast("long")))
    told = each.groupBy(*by, "version", "rule").agg(
        F.sum("n").alias("documents"), count(hit == 0).alias("kept"), count(F.col("failures").bitwiseAND(F.col("one")) != 0).alias("failing"), count(hit == F.col("one")).alias("decisive")
    )
    return told.withColumn("kept_without", F.col("kept") + F.col("decisive"))


def failed_by(entries: DataFrame, by: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(*by, some, every): the names of the rules that some, and that every, document of a value fails, by bitwise OR and AND."""
    merged = entries.groupBy(*by).agg(F.bit_or("failures").alias("some"), F.bit_and("failures").alias("every"))
    names = lambda c: F.filter(F.array(*(F.when(F.col(c).bitwiseAND(F.lit(1 << r.bit).cast("long")) != 0, F.lit(r.name)) for r in rules)), lambda x: x.isNotNull())
    return merged.select(*by, names("some").alias("some"), names("every").alias("every"))


def rule_verdicts(docs: DataFrame, production: Policy = PRODUCTION) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failures, decisive) of every row.

    kept is what the production policy says; its mask holds the base rules. decisive is the bit of the rule that alone rejects it.
    """
    entries = ledger(docs)
    failures = F.col("failures")
    return entries.select(
        "doc_id", *(m for m in MEASURES if m != "n_lines"), (~passes(failures, BASE)).alias("base_failed"),
        passes(failures, Policy(production.version, production.mask | BASE.mask)).alias("kept"), "failures", decisive(failures, production).alias("decisive"),
    )
