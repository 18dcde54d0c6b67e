"""Whole jobs on the driver tables: dataset sheet, error introduction, titration and the three exams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlab.catalog.base import h, pick, query, randint, table, u, zfill
from seqlab.catalog.read_queries import (
    HOST,
    SINGLE_END,
    decremented_sql,
    degraded_sql,
    document_reads,
    host_and_foreign,
    mixing_sql,
    overwritten_sql,
    series_sql,
)
from seqlab.catalog.sheet_queries import COPY, SPECIES, fraction_sql, labelled_sql, one_sql
from seqlab.operators.selection import choose_one
from seqlab.plans import errors, exams, simulate
from seqlab.plans import titration as titration_plan


def md5_of(column: str):
    return F.md5(F.col(column).cast("binary")).alias(f"{column}_md5")


# --- dataset sheet -------------------------------------------------------------------------------------------


DATASET_SQL = f"""
WITH rows AS (SELECT c_name AS sample_name, 'R' || c_custkey AS short_reads, 'GCA_' || c_custkey AS assembly, c_mktsegment AS species,
                     'ST' || c_nationkey AS st, 'Unknown' AS amr, CASE WHEN c_nationkey = 3 THEN 'TRUE' ELSE 'FALSE' END AS use_original_reads
              FROM customer WHERE c_mktsegment = '{SPECIES}'),
n AS (SELECT (SELECT count(*) FROM customer) // 4 AS n, (SELECT count(*) FROM rows) AS have),
indexed AS (SELECT *, row_number() OVER (ORDER BY {h('topup', 'sample_name')}, sample_name) AS i FROM rows),
extra AS (SELECT r.r AS replicate, {randint(1, 'have', 'topup draw', 'r.r')} AS i FROM n, unnest(range(1, n - have + 1)) AS r(r)),
chosen AS (SELECT *, sample_name AS public_name FROM rows
           UNION ALL SELECT indexed.* EXCLUDE (i), sample_name || '_' || replicate FROM extra JOIN indexed USING (i))
SELECT *, CASE WHEN use_original_reads = 'TRUE' THEN -1 ELSE {randint(40, 60, 'coverage', 'public_name')} END AS coverage,
       CAST(CASE WHEN use_original_reads = 'TRUE' THEN -1 ELSE 150 END AS INTEGER) AS read_length,
       CASE WHEN use_original_reads = 'TRUE' THEN 'Unknown' ELSE 'HS25' END AS platform,
       CAST(CASE WHEN use_original_reads = 'TRUE' THEN -1 ELSE 200 END AS INTEGER) AS fragment_length,
       CAST(CASE WHEN use_original_reads = 'TRUE' THEN -1 ELSE 10 END AS INTEGER) AS standard_deviation,
       CAST(CASE WHEN use_original_reads = 'TRUE' THEN -1 ELSE 42 END AS INTEGER) AS random_seed,
       'PASSED' AS qc, 'NONE' AS error, 'None' AS notes,
       public_name || '_R1.fastq.gz' AS r1, public_name || '_R2.fastq.gz' AS r2
FROM chosen
"""


@query(DATASET_SQL)
def dataset_sheet(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    catalogue = customers.select(
        F.col("c_name").alias("SAMPLE_NAME"),
        F.concat(F.lit("R"), key).alias("SHORT_READS"),
        F.concat(F.lit("GCA_"), key).alias("ASSEMBLY"),
        F.col("c_mktsegment").alias("SPECIES"),
        F.concat(F.lit("ST"), F.col("c_nationkey").cast("string")).alias("ST"),
        F.lit("Unknown").alias("AMR"),
        F.when(F.col("c_nationkey") == 3, F.lit("TRUE")).otherwise(F.lit("FALSE")).alias("USE_ORIGINAL_READS"),
    )
    return simulate.dataset_sheet(catalogue, SPECIES, customers.count() // 4)


# --- error introduction --------------------------------------------------------------------------------------


def document_error_parameters(spark: SparkSession, sf: str) -> DataFrame:
    """Every source is a sample of the host language; the other languages are contaminants."""
    documents = table(spark, sf, "documents").select("source", "lang")
    sheet = documents.where(F.col("lang") == HOST).select(F.col("source").alias("sample_name"), F.col("lang").alias("species")).distinct()
    contaminants = documents.select(
        F.col("lang").alias("sample_name"), F.col("lang").alias("species"), F.concat(F.lit("GCA_"), "lang").alias("assembly")
    ).distinct()
    return errors.error_parameters(sheet, contaminants, 0.6, 42)


ERROR_SHEET = f"""
sheet AS (SELECT DISTINCT source AS sample_name, lang AS species FROM documents WHERE lang = '{HOST}'),
labelled AS ({labelled_sql('sheet', 'sample_name')}),
dealt AS (SELECT sample_name, row_number() OVER (ORDER BY {h('deal', 'sample_name')}, sample_name) AS p FROM labelled WHERE error = 'CONTAMINATED'),
pool AS (SELECT contaminant, row_number() OVER (ORDER BY {h('pool', 'contaminant')}, contaminant) AS slot
         FROM (SELECT DISTINCT lang AS contaminant FROM documents WHERE lang <> '{HOST}')),
given AS (SELECT sample_name, contaminant FROM dealt JOIN pool ON slot = (p - 1) % (SELECT count(*) FROM pool) + 1)"""
TRUNCATE = randint(5, 100, "truncate_length", "sample_name")
PERCENT = randint(20, 80, "contamination_percent", "sample_name")
MATES = pick(("r1", "r2", "both"), randint(1, 3, "corrupt mates", "sample_name"))
MIN_Q, MAX_Q = randint(5, 9, "min_quality", "sample_name"), randint(10, 20, "max_quality", "sample_name")


def damaged_sql(names: str, extra_quality: str, own_rule: str, corrupt: str, hit: str = "") -> str:
    """Host reads of the samples in relation ``params`` (sample_name, ``names``), changed, plus foreign reads."""
    first = h("corrupt read", "sample_id", "pair_id", "1")
    position = randint(1, "length(sequence)", "corrupt base", "sample_id", "pair_id", "1")
    return f"""
spots AS (SELECT sample_id, pair_id FROM (
            SELECT sample_id, pair_id, row_number() OVER (PARTITION BY sample_id ORDER BY {first}, pair_id) AS spot FROM own) WHERE spot = 1),
joined AS (SELECT o.sample_id, o.pair_id, o.sequence, o.quality, o.r, p.* EXCLUDE (sample_name), s.n_own, spots.pair_id IS NOT NULL AS spot,
                  {h('quality', 'o.sample_id', 'o.pair_id', '1')} AS stream
           FROM own o JOIN params p ON o.sample_id = p.sample_name LEFT JOIN sized s ON s.sample_id = o.sample_id
           LEFT JOIN spots ON spots.sample_id = o.sample_id AND spots.pair_id = o.pair_id),
damaged AS (
  SELECT sample_id, pair_id, 'host' AS origin,
         CASE WHEN {names} = 'TRUNCATED' THEN substr(sequence, 1, cut) WHEN {names} = '{corrupt}' AND spot {hit} THEN {overwritten_sql('sequence', position)}
              ELSE sequence END AS sequence,
         CASE WHEN {names} = 'TRUNCATED' THEN substr(quality, 1, cut) {extra_quality} ELSE quality END AS quality
  FROM joined WHERE {own_rule}
  UNION ALL SELECT sample_id, pair_id, origin, sequence, quality FROM mixed WHERE origin = 'contaminant')"""


def _error_reads_sql() -> str:
    plan = f"SELECT sample_name AS sample_id, contaminant AS contaminant_id, {PERCENT} AS pct FROM given"
    quality = f"WHEN error = 'POOR_QUALITY' THEN {degraded_sql('sequence', 'stream', 'min_q', 'max_q')}"
    rule = f"(error <> 'LOW_COVERAGE' OR {u('keep', 'sample_id', 'pair_id')} < fraction) AND (error <> 'CONTAMINATED' OR r <= n_own)"
    return f"""
WITH {ERROR_SHEET}, {mixing_sql(plan)},
params AS (SELECT sample_name, error, {TRUNCATE} AS cut, {MIN_Q} AS min_q, {MAX_Q} AS max_q, {fraction_sql('sample_name')} AS fraction, {MATES} <> 'r2' AS first_mate FROM labelled),
{damaged_sql('error', quality, rule, 'CORRUPT', 'AND first_mate')}
SELECT sample_id, pair_id, origin, md5(sequence) AS sequence_md5, md5(quality) AS quality_md5 FROM damaged"""


@query(_error_reads_sql())
def introduce_errors(spark: SparkSession, sf: str) -> DataFrame:
    host, foreign = host_and_foreign(spark, sf)
    reads, _ = errors.damaged_reads(host, foreign, document_error_parameters(spark, sf), 42, SINGLE_END)
    return reads.select("sample_id", "pair_id", "origin", md5_of("sequence"), md5_of("quality"))


@query(f"""
WITH {ERROR_SHEET}, named AS (SELECT *, 'sample' || {zfill('row_number() OVER (ORDER BY sample_name)', 2)} AS public_name FROM labelled)
SELECT sample_name, species, public_name, public_name || '_R1.fastq.gz' AS r1, public_name || '_R2.fastq.gz' AS r2,
       CASE WHEN hit THEN 'FAILED' ELSE 'PASSED' END AS qc, error,
       CASE error WHEN 'NONE' THEN 'No changes.' WHEN 'TRUNCATED' THEN 'Truncated reads to ' || {TRUNCATE} || ' bp'
            WHEN 'CORRUPT' THEN 'Corrupted ' || CASE {MATES} WHEN 'both' THEN 'both reads' ELSE {MATES} END WHEN 'CONTAMINATED' THEN 'Contaminated with ' || contaminant || ' at ' || {PERCENT} || '%'
            WHEN 'POOR_QUALITY' THEN 'Error introduced Quality degraded to ' || {MIN_Q} || '-' || {MAX_Q}
            WHEN 'LOW_COVERAGE' THEN 'Low coverage at ' || round_even({fraction_sql('sample_name')}, 2) END AS notes
FROM named LEFT JOIN given USING (sample_name)
""")
def error_answers(spark: SparkSession, sf: str) -> DataFrame:
    return errors.error_answers(document_error_parameters(spark, sf), ["sample_name", "species"])


@query(f"""
WITH made AS ({DATASET_SQL}),
sheet AS (SELECT * EXCLUDE (sample_name, public_name, qc, error, notes, r1, r2), public_name AS sample_name FROM made),
labelled AS ({labelled_sql('sheet', 'sample_name')}),
named AS (SELECT *, 'sample' || {zfill('row_number() OVER (ORDER BY sample_name)', 2)} AS public_name FROM labelled),
dealt AS (SELECT sample_name, row_number() OVER (ORDER BY {h('deal', 'sample_name')}, sample_name) AS p FROM labelled WHERE error = 'CONTAMINATED'),
pool AS (SELECT contaminant, row_number() OVER (ORDER BY {h('pool', 'contaminant')}, contaminant) AS slot
         FROM (SELECT DISTINCT source AS contaminant FROM documents)),
given AS (SELECT sample_name, contaminant FROM dealt JOIN pool ON slot = (p - 1) % (SELECT count(*) FROM pool) + 1)
SELECT named.* EXCLUDE (hit, error), public_name || '_R1.fastq.gz' AS r1, public_name || '_R2.fastq.gz' AS r2,
       CASE WHEN hit THEN 'FAILED' ELSE 'PASSED' END AS qc, error,
       CASE error WHEN 'NONE' THEN 'No changes.' WHEN 'TRUNCATED' THEN 'Truncated reads to ' || {TRUNCATE} || ' bp'
            WHEN 'CORRUPT' THEN 'Corrupted ' || CASE {MATES} WHEN 'both' THEN 'both reads' ELSE {MATES} END
            WHEN 'CONTAMINATED' THEN 'Contaminated with ' || contaminant || ' at ' || {PERCENT} || '%'
            WHEN 'POOR_QUALITY' THEN 'Error introduced Quality degraded to ' || {MIN_Q} || '-' || {MAX_Q}
            WHEN 'LOW_COVERAGE' THEN 'Low coverage at ' || round_even({fraction_sql('sample_name')}, 2) END AS notes
FROM named LEFT JOIN given USING (sample_name)
""")
def dataset_to_errors(spark: SparkSession, sf: str) -> DataFrame:
    """The dataset sheet, with samples that were drawn again, goes on to the error job; sources are the contaminants."""
    reads = document_reads(spark, sf)
    sheet, _ = errors.one_output_per_row(dataset_sheet(spark, sf), reads)
    foes = reads.select(F.col("sample_id").alias("sample_name"), F.lit("other").alias("species"), F.lit("GCA").alias("assembly")).distinct()
    return errors.error_answers(errors.error_parameters(sheet, foes, 0.6, 42), sheet.columns)


# --- titration -----------------------------------------------------------------------------------------------

DOC_SHEET = "doc_sheet AS (SELECT DISTINCT source || '-' || lang AS sample_name, lang AS species, 'ST' || (CAST(substr(source, 4) AS BIGINT) % 7) AS st FROM documents)"


def document_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Sample = source and language, species = language, ST = a class of the source number."""
    return table(spark, sf, "documents").select(
        F.concat_ws("-", "source", "lang").alias("sample_name"),
        F.col("lang").alias("species"),
        F.concat(F.lit("ST"), (F.substring("source", 4, 9).cast("bigint") % 7).cast("string")).alias("st"),
    ).distinct()


TITRATION = f"""{DOC_SHEET},
own_species AS (SELECT * FROM doc_sheet WHERE species = '{HOST}'), main AS ({one_sql('own_species', 'main')}),
strains AS (SELECT s.* FROM doc_sheet s JOIN main m ON s.species = m.species AND s.st <> m.st), foe AS ({one_sql('strains', 'contaminant')})"""
MIXED = "(SELECT doc_id AS pair_id, text AS sequence FROM documents WHERE source || '-' || lang = (SELECT sample_name FROM {}))"


@query(f"""
WITH {TITRATION}, {series_sql(MIXED.format('main'), MIXED.format('foe'))}
SELECT 'sample' || {zfill('step', 2)} AS sample_id, pair_id, origin, md5(sequence) AS sequence_md5 FROM series
""")
def titration(spark: SparkSession, sf: str) -> DataFrame:
    reads = document_reads(spark, sf, "lang").withColumn("sample_id", F.concat_ws("-", "sample_id", "lang")).drop("lang")
    exam = titration_plan.titration(reads, document_sheet(spark, sf), HOST, "ST", 10, 42, SINGLE_END)
    return exam.reads.select("sample_id", "pair_id", "origin", md5_of("sequence"))


@query(f"""
WITH {TITRATION}, steps AS (SELECT CAST(s AS INTEGER) AS step, CAST(10 AS DOUBLE) * s AS percentage, 'sample' || {zfill('s', 2)} AS public_name
                            FROM unnest(range(1, 11)) AS t(s))
SELECT main.*, step, percentage, public_name, CASE WHEN percentage >= 10 THEN 'FAILED' ELSE 'PASSED' END AS qc,
       CASE WHEN percentage >= 10 THEN 'CONTAMINATION' ELSE 'NONE' END AS error,
       'Contamination with ' || (SELECT species FROM foe) || ' - ' || (SELECT sample_name FROM foe) || ' at ' || percentage || '%' AS notes,
       public_name || '_R1.fastq.gz' AS r1, public_name || '_R2.fastq.gz' AS r2
FROM main, steps
""")
def titration_sheets(spark: SparkSession, sf: str) -> DataFrame:
    main, contaminant = titration_plan.choose_samples(document_sheet(spark, sf), HOST, "ST", 42)
    return titration_plan.titration_sheet(main, contaminant, 10)


# --- typing exam ---------------------------------------------------------------------------------------------

TYPING = f"""{DOC_SHEET}, own_species AS (SELECT * FROM doc_sheet WHERE species = '{HOST}'),
per_st AS (SELECT *, row_number() OVER (PARTITION BY st ORDER BY {h('in group', 'sample_name')}, sample_name) AS r FROM own_species),
chosen AS (SELECT sample_name, species, st FROM per_st WHERE r = 1 ORDER BY {h('groups', 'st')}, st LIMIT 5),
contigs AS (SELECT source || '-' || lang AS sample_name, doc_id AS contig_index, text AS sequence FROM documents),
digests AS (SELECT sample_name, md5(sum(CAST(CAST('0x' || substr(md5(contig_index || ':' || md5(sequence)), 1, 12) AS BIGINT) AS HUGEINT)) || '|' ||
            sum(CAST(CAST('0x' || substr(md5(contig_index || ':' || md5(sequence)), 13, 12) AS BIGINT) AS HUGEINT)) || '|' || count(*)) AS digest
            FROM contigs JOIN chosen USING (sample_name) GROUP BY sample_name),
copies AS (SELECT sample_name, 'Sample_' || substr(digest, 1, 8) AS name FROM digests),
names AS (SELECT sample_name, {COPY} FROM (
            SELECT *, row_number() OVER (PARTITION BY name ORDER BY {h('copy', 'sample_name', seed=0)}, sample_name) AS copy FROM copies))"""


def document_typing(spark: SparkSession, sf: str) -> errors.Exam:
    documents = table(spark, sf, "documents")
    sample = F.concat_ws("-", "source", "lang")
    contigs = documents.select(
        sample.alias("sample_id"), F.col("doc_id").alias("contig_index"), F.lit("").alias("contig_name"), F.col("text").alias("sequence")
    )
    texts = {
        "mlst__ST": F.col("sample_name"),
        "kaptive__K_locus": F.concat(F.lit("KL"), F.col("n").cast("string")),
        "kaptive__K_type": F.concat(F.lit("K"), F.col("n").cast("string")),
        "wzi__wzi": F.concat(F.lit("wzi"), F.col("n").cast("string")),
        "kaptive__O_locus": F.lit("O1"),
        "kaptive__O_type": F.lit("O2"),
        "amr__Bla_Carb_acquired": F.lit("-"),
    }
    counted = documents.groupBy(sample.alias("sample_name")).agg(F.count(F.lit(1)).alias("n"))
    results = counted.select("sample_name", *[v.alias(f"klebsiella_pneumo_complex__{k}") for k, v in texts.items()])
    return exams.typing_exam(document_sheet(spark, sf), contigs, results, HOST, exams.PRACTICE_STS)


@query(f"""
WITH {TYPING}
SELECT public_name AS sample_id, contig_index,
       public_name || '_contig_' || {zfill('row_number() OVER (PARTITION BY public_name ORDER BY contig_index)', 4)} AS contig_name,
       md5(sequence) AS sequence_md5
FROM contigs JOIN names USING (sample_name)
""")
def typing_exam(spark: SparkSession, sf: str) -> DataFrame:
    return document_typing(spark, sf).reads.select("sample_id", "contig_index", "contig_name", md5_of("sequence"))


@query(f"""
WITH {TYPING}, n AS (SELECT sample_name, count(*) AS n FROM contigs GROUP BY sample_name)
SELECT sample_name, species, st, public_name, sample_name AS kleborate_st, 'KL' || n AS k_locus, 'K' || n AS capsule_type, 'wzi' || n AS wzi,
       'O1' AS o_locus, 'O2' AS o_type, '-' AS bla_carb
FROM chosen JOIN names USING (sample_name) JOIN n USING (sample_name)
""")
def typing_answers(spark: SparkSession, sf: str) -> DataFrame:
    return document_typing(spark, sf).answers


# --- assembly exam -------------------------------------------------------------------------------------------


def document_assembly_parameters(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("source")
    samples = table(spark, sf, "documents").where(F.col("lang") == HOST).select(
        name.alias("sample_name"),
        F.concat(F.lit("Sample_"), F.substring(F.md5(name.cast("binary")), 1, 8)).alias("public_name"),
        F.col("lang").alias("species"),
    ).distinct()
    others = table(spark, sf, "documents").where(F.col("lang") != HOST).select(F.col("lang").alias("sample_name")).distinct()
    contaminant = choose_one(others, "sample_name", 42, "contaminant")
    return exams.assembly_parameters(samples, contaminant, {**exams.REAL_LABELS, "CORRUPTED": 1}, 42)


ASSEMBLY = f"""
samples AS (SELECT DISTINCT source AS sample_name, 'Sample_' || substr(md5(source), 1, 8) AS public_name, lang AS species
            FROM documents WHERE lang = '{HOST}'),
others AS (SELECT DISTINCT lang AS sample_name FROM documents WHERE lang <> '{HOST}'), foe AS ({one_sql('others', 'contaminant')}),
placed AS (SELECT *, row_number() OVER (ORDER BY {h('labels', 'sample_name')}, sample_name) AS p FROM samples),
labelled AS (SELECT * EXCLUDE (p), CASE WHEN p <= 2 THEN 'CONTAMINATED' WHEN p <= 3 THEN 'POOR_QUALITY' WHEN p <= 4 THEN 'TRUNCATED'
                         WHEN p <= 5 THEN 'LOW_COVERAGE' WHEN p <= 6 THEN 'CORRUPTED' ELSE 'NORMAL' END AS label FROM placed),
dealt AS (SELECT *, CASE label WHEN 'TRUNCATED' THEN {randint(1, 50, 'exam_truncate_length', 'sample_name')}
                    WHEN 'LOW_COVERAGE' THEN {randint(1, 20, 'exam_coverage_percent', 'sample_name')}
                    WHEN 'CONTAMINATED' THEN {randint(60, 90, 'exam_contamination_percent', 'sample_name')}
                    WHEN 'POOR_QUALITY' THEN {randint(10, 30, 'exam_decrement', 'sample_name')} END AS parameter FROM labelled)"""


def _assembly_sql() -> str:
    plan = "SELECT sample_name AS sample_id, (SELECT sample_name FROM foe) AS contaminant_id, parameter AS pct FROM dealt WHERE label = 'CONTAMINATED'"
    rule = """(label <> 'CONTAMINATED' OR r <= n_own) AND
        (label <> 'LOW_COVERAGE' OR r <= ((SELECT count(*) FROM own x WHERE x.sample_id = joined.sample_id) * cut) // 100)"""
    return f"""
WITH {ASSEMBLY}, {mixing_sql(plan)}, params AS (SELECT sample_name, label, parameter AS cut FROM dealt),
{damaged_sql('label', f"WHEN label = 'POOR_QUALITY' THEN {decremented_sql('quality', 'cut')}", rule, 'CORRUPTED')}
SELECT sample_id, pair_id, origin, md5(sequence) AS sequence_md5, md5(quality) AS quality_md5 FROM damaged"""


@query(_assembly_sql())
def assembly_exam(spark: SparkSession, sf: str) -> DataFrame:
    host, foreign = host_and_foreign(spark, sf)
    reads = exams.assembly_reads(host, foreign, document_assembly_parameters(spark, sf), 42, SINGLE_END)
    return reads.select("sample_id", "pair_id", "origin", md5_of("sequence"), md5_of("quality"))


@query(f"""
WITH {ASSEMBLY}
SELECT sample_name, public_name, species, CASE WHEN label = 'NORMAL' THEN 'PASSED' ELSE 'FAILED' END AS qc,
       CASE label WHEN 'NORMAL' THEN 'NONE' WHEN 'POOR_QUALITY' THEN 'DEGRADED' ELSE label END AS error,
       CASE label WHEN 'NORMAL' THEN 'None' WHEN 'TRUNCATED' THEN 'Truncated reads to ' || parameter || ' bp'
            WHEN 'CONTAMINATED' THEN 'Contamined sample with ' || parameter || '% using ' || (SELECT sample_name FROM foe) || '_R1.fastq.gz and '
                 || (SELECT sample_name FROM foe) || '_R2.fastq.gz'
            WHEN 'POOR_QUALITY' THEN 'Degraded sample so base quality is decremented ' || parameter || ' points'
            WHEN 'LOW_COVERAGE' THEN 'Low coverage sample with ' || parameter || '%'
            WHEN 'CORRUPTED' THEN 'Corrupted sample with random bytes' END AS notes,
       public_name || '_R1.fastq.gz' AS r1, public_name || '_R2.fastq.gz' AS r2
FROM dealt
""")
def assembly_answers(spark: SparkSession, sf: str) -> DataFrame:
    return exams.assembly_answers(document_assembly_parameters(spark, sf))


# --- outbreak exam -------------------------------------------------------------------------------------------


def supplier_outbreak(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers as outbreak samples; suppliers of one nation have the same genome, so their names collide."""
    rows = table(spark, sf, "supplier")
    nation = F.col("s_nationkey").cast("string")
    metadata = rows.select(
        F.col("s_name").alias("Sample"),
        nation.alias("Cluster"),
        F.lit("Human").alias("Host"),
        F.concat(F.lit("L"), nation).alias("Location"),
        F.lit("2024-02-15").alias("Collection Date"),
        F.lit("A").alias("Phenotype"),
        F.lit("sp").alias("SPECIES"),
    )
    digests = rows.select(F.col("s_name").alias("Sample"), F.md5(nation.cast("binary")).alias("digest"))
    return exams.outbreak_sheets(metadata, digests)


OUTBREAK = f"""
named AS (SELECT *, 'Sample_' || substr(md5(CAST(s_nationkey AS VARCHAR)), 1, 8) || '12' AS name FROM supplier),
public AS (SELECT *, {COPY} FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY {h('copy', 's_name', seed=0)}, s_name) AS copy FROM named))"""
OUTBREAK_META = """'Human' AS "Host", 'L' || s_nationkey AS "Location", '2024-02-15' AS "Collection Date", 'A' AS "Phenotype", 'sp' AS "SPECIES\""""


@query(f"""
WITH {OUTBREAK} SELECT s_name AS "Sample", CAST(s_nationkey AS VARCHAR) AS "Cluster", {OUTBREAK_META}, public_name,
       public_name || '_R1.fastq.gz' AS "R1", public_name || '_R2.fastq.gz' AS "R2" FROM public
""")
def outbreak_answers(spark: SparkSession, sf: str) -> DataFrame:
    return supplier_outbreak(spark, sf)[0]


@query(f"""
WITH {OUTBREAK} SELECT public_name AS "Sample", '' AS "Cluster", {OUTBREAK_META}, '' AS "R1", '' AS "R2" FROM public
""")
def outbreak_sheets(spark: SparkSession, sf: str) -> DataFrame:
    return supplier_outbreak(spark, sf)[1]
