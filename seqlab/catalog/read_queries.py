"""Read operators on the driver tables: documents are single-end reads, conversations are paired reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlab.catalog.base import h, letters, percent_2dp, pick, query, randint, stream_draw, table, u
from seqlab.catalog.sheet_queries import n50_sql
from seqlab.functions import div, draw_choice, draw_int
from seqlab.operators import mixing, sampling, stats
from seqlab.operators import reads as read_ops
from seqlab.operators import screen
from seqlab.operators.screen import encoded_kmers
from seqlab.operators.screen import kmer_containment as containment
from seqlab.session import land

HOST, FOREIGN = "en", ["de", "es", "fr"]
SINGLE_END = "true"


def document_reads(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Documents as single-end reads of the sample ``source``; all qualities are 40."""
    text = F.col("text")
    return table(spark, sf, "documents").select(
        F.col("source").alias("sample_id"),
        F.col("doc_id").alias("pair_id"),
        F.lit(1).alias("mate"),
        F.concat(F.lit("@"), F.col("doc_id").cast("string")).alias("header"),
        text.alias("sequence"),
        F.lit("+").alias("plus"),
        F.repeat(F.lit("I"), F.length(text)).alias("quality"),
        *columns,
    )


READS = "reads AS (SELECT source AS sample_id, doc_id AS pair_id, lang, text AS sequence, repeat('I', length(text)) AS quality FROM documents)"


def host_and_foreign(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Host reads per source, and foreign reads whose sample is the language."""
    reads = document_reads(spark, sf, "lang")
    foreign = reads.where(F.col("lang") != HOST).withColumn("sample_id", F.col("lang"))
    return reads.where(F.col("lang") == HOST).drop("lang"), foreign.drop("lang")


# --- per-read transforms -------------------------------------------------------------------------------------


@query(f"WITH {READS} SELECT pair_id, substr(sequence, 1, 75) AS sequence, substr(quality, 1, 75) AS quality FROM reads")
def truncate_reads(spark: SparkSession, sf: str) -> DataFrame:
    return read_ops.truncate_reads(document_reads(spark, sf), 75).select("pair_id", "sequence", "quality")


def degraded_sql(sequence: str, stream: str, low: str, high: str) -> str:
    drop = f"CAST(floor(CAST(i AS DOUBLE) / length({sequence}) * ({high} - {low})) AS BIGINT)"
    value = f"{low} + (({stream_draw(stream, 'i')} * ({high} - {drop} - {low} + 1)) >> 32)"
    return f"array_to_string(list_transform(range(length({sequence})), lambda i: chr(CAST(33 + {value} AS INTEGER))), '')"


@query(f"""
WITH {READS}, s AS (SELECT pair_id, sequence, {h('quality', 'sample_id', 'pair_id', '1')} AS stream FROM reads)
SELECT pair_id, {degraded_sql('sequence', 'stream', '5', '30')} AS quality FROM s
""")
def degrade_quality(spark: SparkSession, sf: str) -> DataFrame:
    return read_ops.degrade_quality(document_reads(spark, sf), 5, 30).select("pair_id", "quality")


LADDER = "array_to_string(list_transform(range(94), lambda q: chr(CAST(33 + q AS INTEGER))), '')"


def decremented_sql(quality: str, points: str) -> str:
    return f"translate({quality}, {LADDER}, repeat('!', {points}) || substr({LADDER}, 1, 94 - {points}))"


@query(f"SELECT doc_id, {decremented_sql('text', '20')} AS quality FROM documents")
def decrement_quality(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "documents").select("doc_id", F.col("text").alias("quality"))
    return read_ops.decrement_quality(lines, 20)


def overwritten_sql(text: str, position: str) -> str:
    return f"substr({text}, 1, {position} - 1) || chr(0) || substr({text}, {position} + 1)"


@query(f"""
WITH p AS (SELECT doc_id, text, {randint(1, 'length(text)', 'corrupt', 'doc_id')} AS p FROM documents)
SELECT doc_id, CASE WHEN length(text) > 0 THEN {overwritten_sql('text', 'p')} ELSE text END AS text FROM p
""")
def corrupt_text(spark: SparkSession, sf: str) -> DataFrame:
    return read_ops.corrupt_text(table(spark, sf, "documents").select("doc_id", "text"), "text", "doc_id")


# --- sampling ------------------------------------------------------------------------------------------------

FIRST_TURN = "turn = 0"


@query(f"SELECT conv_id, turn, text FROM conversations WHERE {u('fraction', 'conv_id')} < CAST(0.3 AS DOUBLE)")
def subsample_fraction(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.subsample_fraction(table(spark, sf, "conversations").select("conv_id", "turn", "text"), "conv_id", 0.3)


@query(f"""
WITH pairs AS (SELECT conv_id, row_number() OVER (ORDER BY {h('count', "'all'", 'conv_id')}, conv_id) AS r
               FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT conv_id, turn, text FROM conversations WHERE conv_id IN (SELECT conv_id FROM pairs WHERE r <= 50)
""")
def subsample_count(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return sampling.subsample_count(turns, "conv_id", 50, first=FIRST_TURN)


@query(f"""
WITH q AS (SELECT source, count(*) // 3 AS quota FROM documents GROUP BY source),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {h('count', 'source', 'doc_id')}, doc_id) AS r FROM documents)
SELECT source, doc_id, text FROM r JOIN q USING (source) WHERE r <= quota
""")
def subsample_quota(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("source", "doc_id", "text")

    def third(sizes: DataFrame) -> DataFrame:
        return sizes.select("grp", F.lit("all").alias("slot"), div(F.col("pairs"), F.lit(3)).alias("quota"))

    return sampling.subsample_share(documents, "source", "doc_id", third, first=SINGLE_END)


@query(f"""
WITH t AS (SELECT CAST(conv_id % 10 AS VARCHAR) AS sample, * FROM conversations),
p AS (SELECT sample, conv_id, row_number() OVER (PARTITION BY sample ORDER BY {h('count', 'sample', 'conv_id')}, conv_id) AS r,
             count(*) OVER (PARTITION BY sample) AS n
      FROM (SELECT DISTINCT sample, conv_id FROM t)),
kept AS (SELECT conv_id FROM p WHERE r <= (n * {randint(1, 20, 'exam_coverage_percent', 'sample')}) // 100)
SELECT sample, conv_id, turn, text FROM t WHERE conv_id IN (SELECT conv_id FROM kept)
""")
def low_coverage(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select((F.col("conv_id") % 10).cast("string").alias("sample"), "conv_id", "turn", "text")
    samples = turns.select(F.col("sample").alias("grp")).distinct()
    percent = samples.withColumn("percent", draw_int(1, 20, 42, "exam_coverage_percent", "grp"))
    return sampling.low_coverage(turns, "sample", "conv_id", percent, first=FIRST_TURN)


# --- mixing --------------------------------------------------------------------------------------------------


def mixing_sql(plan: str) -> str:
    """CTEs sized and mixed for a plan (sample_id, contaminant_id, pct)."""
    own = h("mix", "'own'", "sample_id", "pair_id")
    other = h("mix", "'foreign'", "lang", "pair_id")
    return f"""{READS}, plan AS ({plan}),
own AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY {own}, pair_id) AS r,
               count(*) OVER (PARTITION BY sample_id) AS pairs FROM reads WHERE lang = '{HOST}'),
other AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {other}, pair_id) AS r FROM reads WHERE lang <> '{HOST}'),
sized AS (SELECT DISTINCT sample_id, contaminant_id, pct, pairs, pairs - (pairs * pct) // 100 AS n_own, (pairs * pct) // 100 AS n_foreign
          FROM plan JOIN own USING (sample_id)),
mixed AS (
  SELECT s.sample_id, o.pair_id, 'host' AS origin, o.sequence, o.quality FROM sized s JOIN own o ON o.sample_id = s.sample_id AND o.r <= s.n_own
  UNION ALL
  SELECT s.sample_id, o.pair_id, 'contaminant', o.sequence, o.quality FROM sized s JOIN other o ON o.lang = s.contaminant_id AND o.r <= s.n_foreign)"""


SOURCE_PLAN = (
    f"SELECT source AS sample_id, {pick(FOREIGN, randint(1, len(FOREIGN), 'contaminant', 'source'))} AS contaminant_id, "
    f"{randint(20, 80, 'contamination_percent', 'source')} AS pct FROM (SELECT DISTINCT source FROM documents)"
)


def source_plan(spark: SparkSession, sf: str) -> DataFrame:
    """A contaminant and a percentage for every source."""
    return table(spark, sf, "documents").select(F.col("source").alias("sample_id")).distinct().select(
        "sample_id",
        draw_choice(FOREIGN, 42, "contaminant", "sample_id").alias("contaminant_id"),
        draw_int(20, 80, 42, "contamination_percent", "sample_id").alias("pct"),
    )


@query(f"WITH {mixing_sql(SOURCE_PLAN)} SELECT sample_id, pair_id, origin, sequence FROM mixed")
def mix_contaminant(spark: SparkSession, sf: str) -> DataFrame:
    host, foreign = host_and_foreign(spark, sf)
    mixed, _ = mixing.mix_contaminant(host, foreign, source_plan(spark, sf), first=SINGLE_END)
    return mixed.select("sample_id", "pair_id", "origin", "sequence")


@query(f"""
WITH {mixing_sql(SOURCE_PLAN)}
SELECT s.*, count(*) FILTER (WHERE origin = 'host') AS got_own, count(*) FILTER (WHERE origin = 'contaminant') AS got_foreign
FROM sized s LEFT JOIN mixed m USING (sample_id) GROUP BY ALL
""")
def mixing_audit(spark: SparkSession, sf: str) -> DataFrame:
    host, foreign = host_and_foreign(spark, sf)
    mixed, mixture = mixing.mix_contaminant(host, foreign, source_plan(spark, sf), first=SINGLE_END)
    return mixing.mixing_audit(mixed, mixture.sized, SINGLE_END)


def series_sql(own: str, other: str, steps: int = 10) -> str:
    """CTE series over two relations with pair_id and sequence."""
    return f"""
own AS (SELECT *, row_number() OVER (ORDER BY {h('mix', "'own'", 'pair_id')}, pair_id) AS r FROM {own}),
other AS (SELECT *, row_number() OVER (ORDER BY {h('mix', "'foreign'", 'pair_id')}, pair_id) AS r FROM {other}),
steps AS (SELECT CAST(step AS INTEGER) AS step, (SELECT count(*) FROM own) AS n FROM unnest(range(1, {steps + 1})) AS t(step)),
series AS (
  SELECT step, pair_id, sequence, 'contaminant' AS origin FROM steps JOIN other ON r <= n * step // {steps}
  UNION ALL SELECT step, pair_id, sequence, 'host' FROM steps JOIN own ON r <= n - n * step // {steps})"""


@query(f"""
WITH {READS}, {series_sql("(SELECT * FROM reads WHERE lang = 'en')", "(SELECT * FROM reads WHERE lang = 'fr')")}
SELECT step, pair_id, origin, md5(sequence) AS sequence_md5 FROM series
""")
def contamination_series(spark: SparkSession, sf: str) -> DataFrame:
    reads = document_reads(spark, sf, "lang")
    host, foreign = reads.where(F.col("lang") == HOST), reads.where(F.col("lang") == "fr")
    series = mixing.contamination_series(host, foreign, 10, first=SINGLE_END)
    return series.select("step", "pair_id", "origin", F.md5(F.col("sequence").cast("binary")).alias("sequence_md5"))


# --- statistics ----------------------------------------------------------------------------------------------


@query("SELECT source AS sample_id, CAST(1 AS INTEGER) AS mate, count(*) AS n_reads FROM documents GROUP BY source")
def count_reads(spark: SparkSession, sf: str) -> DataFrame:
    return stats.count_reads(document_reads(spark, sf), "sample_id", "mate")


def assembly_sql(source: str, by: str) -> str:
    """Statistics of contigs (by, sequence)."""
    filled = f"(SELECT {by}, length(sequence) AS len, {letters('sequence', 'GCgc')} AS gc FROM {source} WHERE length(sequence) > 0)"
    return f"""
SELECT {by}, CAST(sum(len) AS BIGINT) AS total_bases, count(*) AS number_of_contigs, any_value(n50) AS n50,
       {percent_2dp('sum(gc)', 'sum(len)')} AS gc_content
FROM {filled} JOIN ({n50_sql(filled, by, 'len')}) USING ({by}) GROUP BY {by}"""


@query(assembly_sql("(SELECT source, text AS sequence FROM documents)", "source"))
def assembly_stats(spark: SparkSession, sf: str) -> DataFrame:
    contigs = table(spark, sf, "documents").select("source", F.col("text").alias("sequence"))
    return stats.assembly_stats(contigs, "source")


@query(f"""
SELECT doc_id, CASE WHEN length(text) > 0 THEN CAST({letters('text', 'GCgc')} AS DOUBLE) / length(text) * 100 ELSE CAST(0 AS DOUBLE) END AS gc
FROM documents
""")
def gc_content(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", stats.gc_percent("text").alias("gc"))


@query(f"""
SELECT source, genome_length, greatest(genome_length // 50, 10000) AS variable_sites
FROM (SELECT source, CAST(sum({letters('text', 'ATCG')}) AS BIGINT) AS genome_length FROM documents GROUP BY source)
""")
def genome_length(spark: SparkSession, sf: str) -> DataFrame:
    contigs = table(spark, sf, "documents").select("source", F.col("text").alias("sequence"))
    return stats.genome_length(contigs, "source")


def kmer_sql(source: str, by: str, k: int) -> str:
    return f"""SELECT DISTINCT {by}, substr(text, i, {k}) AS kmer FROM (
      SELECT {by}, text, unnest(range(1, length(text) - {k} + 2)) AS i FROM {source})"""


@query(f"""
WITH own AS ({kmer_sql('documents', 'source', 20)}),
known AS ({kmer_sql('(SELECT item_id % 4 AS panel, text FROM benchmark)', 'panel', 20)}),
totals AS (SELECT source, count(*) AS n_kmers FROM own GROUP BY source),
shared AS (SELECT source, panel, count(*) AS n_shared FROM own JOIN known USING (kmer) GROUP BY source, panel)
SELECT source, panel, n_shared, n_kmers, CAST(n_shared AS DOUBLE) / n_kmers AS containment FROM shared JOIN totals USING (source)
""")
def kmer_containment(spark: SparkSession, sf: str) -> DataFrame:
    panels = table(spark, sf, "benchmark").select((F.col("item_id") % 4).alias("panel"), "text")
    return containment(table(spark, sf, "documents"), panels, "source", "text", "panel", "text", 20)


@query("""
WITH bases AS (SELECT source, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS text FROM documents),
kmers AS (SELECT DISTINCT source, substr(text, i, 8) AS kmer FROM (SELECT source, text, unnest(range(1, length(text) - 6)) AS i FROM bases)),
codes AS (SELECT source, CAST(list_sum([CAST(strpos('ACGT', substr(kmer, p, 1)) - 1 AS BIGINT) << (2 * (8 - p)) FOR p IN [1, 2, 3, 4, 5, 6, 7, 8]]) AS BIGINT) AS kmer
          FROM kmers WHERE regexp_full_match(kmer, '[ACGT]{8}'))
SELECT source, count(*) AS n_kmers, CAST(sum(kmer) AS BIGINT) AS sum_kmers, min(kmer) AS least, max(kmer) AS most FROM codes GROUP BY source
""")
def kmer_codes(spark: SparkSession, sf: str) -> DataFrame:
    bases = F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")
    codes = encoded_kmers(table(spark, sf, "documents").select("source", bases.alias("text")), "text", 8, "source")
    counted = [F.count(F.lit(1)).alias("n_kmers"), F.sum("kmer").alias("sum_kmers"), F.min("kmer").alias("least"), F.max("kmer").alias("most")]
    return codes.groupBy("source").agg(*counted)


def sketch_sql(by: str, k: int, size: int) -> str:
    return f"""SELECT {by}, hash FROM (
      SELECT {by}, hash, row_number() OVER (PARTITION BY {by} ORDER BY hash) AS place
      FROM (SELECT DISTINCT {by}, CAST('0x' || substr(md5(kmer), 1, 15) AS BIGINT) AS hash FROM ({kmer_sql('documents', by, k)}))
    ) WHERE place <= {size}"""


@query(f"""
WITH a AS ({sketch_sql('source', 12, 1000)}),
b AS ({sketch_sql('lang', 12, 1000)}),
pairs AS (SELECT DISTINCT source, lang FROM a JOIN b USING (hash)),
merged AS (
  SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY hash) AS place FROM (
    SELECT source, lang, hash FROM pairs JOIN a USING (source) UNION SELECT source, lang, hash FROM pairs JOIN b USING (lang)
  )
),
counted AS (
  SELECT m.source, m.lang, count(*) AS n_compared, count(a.hash + b.hash) AS n_common
  FROM merged m LEFT JOIN a ON a.source = m.source AND a.hash = m.hash LEFT JOIN b ON b.lang = m.lang AND b.hash = m.hash
  WHERE place <= 1000 GROUP BY m.source, m.lang
)
SELECT *, n_common / n_compared AS similarity,
  CASE WHEN n_common > 0 THEN round(abs(ln(2 * (n_common / n_compared) / (1 + n_common / n_compared))) / 12, 9) END AS distance
FROM counted
""")
def sketch_distance(spark: SparkSession, sf: str) -> DataFrame:
    # Every text is hashed once: sketches of sources and of languages merge from those of both.
    parts = land(screen.sketches(table(spark, sf, "documents"), "text", 12, 1000, "source", "lang"), "sketches")
    left, right = (screen.merged_sketches(parts, by, 1000) for by in ("source", "lang"))
    return screen.sketch_distances(left, right, "source", "lang", 1000, 12).withColumn("distance", F.round("distance", 9))
