"""Sheet, selection, join, hit and report operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlab.catalog.base import h, letters, percent_2dp, pick, query, randint, table, u, zfill
from seqlab.functions import basename
from seqlab.operators import hits as hit_ops
from seqlab.operators import joins, reports, selection, sheet, validate
from seqlab.operators.sampling import sample_n as take_sample
from seqlab.operators.stats import assembler_report as make_assembler_report
from seqlab.operators.stats import n50_from_lengths

SPECIES = "BUILDING"


# --- reports and digests -------------------------------------------------------------------------------------


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_scan(spark: SparkSession, sf: str) -> DataFrame:
    parsed = F.from_json("props", "k bigint")
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


@query("SELECT doc_id, md5(text) AS digest FROM documents")
def text_digest(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


def event_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Nested report text made of event fields; k = 0 and empty names occur and count as missing."""
    k = F.from_json("props", "k bigint")["k"]
    organism = F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type"))
    report = F.struct(
        F.concat(F.lit("GCA_"), F.col("event_id").cast("string")).alias("accession"),
        F.struct(
            F.struct(F.concat(F.lit("SAMN"), F.col("user_id").cast("string")).alias("accession"), organism.alias("strain")).alias("biosample"),
            F.col("event_type").alias("bioprojectAccession"),
        ).alias("assemblyInfo"),
        F.struct(
            F.struct(F.struct((k % 3).alias("nonCoding"), k.alias("proteinCoding"), (k * 2).alias("total")).alias("geneCounts")).alias("stats")
        ).alias("annotationInfo"),
        F.struct((k * 1000).alias("contigN50"), F.col("user_id").alias("numberOfContigs")).alias("assemblyStats"),
        F.struct(
            F.when(k % 2 == 0, organism).alias("species"), F.col("user_id").alias("checkmSpeciesTaxId")
        ).alias("checkmInfo"),
        F.struct(organism.alias("organismName"), (k % 5).alias("taxId")).alias("organism"),
    )
    return table(spark, sf, "events").select("event_id", F.to_json(report).alias("json"))


K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
ORGANISM = "CASE WHEN event_type = 'error' THEN '' ELSE event_type END"


def _report_sql() -> str:
    known = {
        "accession": "'GCA_' || event_id",
        "assemblyInfo.biosample.accession": "'SAMN' || user_id",
        "assemblyInfo.biosample.strain": f"nullif({ORGANISM}, '')",
        "annotationInfo.stats.geneCounts.nonCoding": f"nullif(CAST({K} % 3 AS VARCHAR), '0')",
        "annotationInfo.stats.geneCounts.proteinCoding": f"nullif(CAST({K} AS VARCHAR), '0')",
        "annotationInfo.stats.geneCounts.total": f"nullif(CAST({K} * 2 AS VARCHAR), '0')",
        "assemblyInfo.bioprojectAccession": "event_type",
        "assemblyStats.contigN50": f"nullif(CAST({K} * 1000 AS VARCHAR), '0')",
        "assemblyStats.numberOfContigs": "nullif(CAST(user_id AS VARCHAR), '0')",
        "checkmInfo.species": f"coalesce(nullif(CASE WHEN {K} % 2 = 0 THEN {ORGANISM} END, ''), nullif(CAST(user_id AS VARCHAR), '0'))",
        "organism.organismName": f"nullif({ORGANISM}, '')",
        "organism.taxId": f"nullif(CAST({K} % 5 AS VARCHAR), '0')",
    }
    columns = [f'{known.get(p, "CAST(NULL AS VARCHAR)")} AS "{reports.flat_name(p)}"' for p in reports.REPORT_PATHS]
    return f"SELECT {', '.join(columns)} FROM events"


@query(_report_sql())
def report_table(spark: SparkSession, sf: str) -> DataFrame:
    parsed = reports.parse_reports(event_reports(spark, sf), "json")
    return reports.flatten_report(parsed, root="report")


@query(f"SELECT event_id, nullif(CAST({K} AS VARCHAR), '0') AS k FROM events")
def flatten_report(spark: SparkSession, sf: str) -> DataFrame:
    parsed = reports.parse_reports(table(spark, sf, "events").select("event_id", "props"), "props", ["k"])
    return reports.flatten_report(parsed, ["k"], root="report", keep=("event_id",), fallbacks={})


# --- validation ----------------------------------------------------------------------------------------------


@query("""
WITH sheet AS (
  SELECT c_name AS sample_name,
         CASE WHEN c_acctbal < 0 THEN '' WHEN c_nationkey <> 0 THEN c_name END AS assembly,
         CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE c_name END AS short_reads
  FROM customer)
SELECT sample_name, 'assembly or reads' AS rule FROM sheet
WHERE coalesce(assembly, '') = '' AND coalesce(short_reads, '') = ''
""")
def sheet_violations(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        F.col("c_name").alias("sample_name"),
        F.when(F.col("c_acctbal") < 0, "").when(F.col("c_nationkey") != 0, F.col("c_name")).alias("assembly"),
        F.when(F.col("c_nationkey") % 3 == 0, "").otherwise(F.col("c_name")).alias("short_reads"),
    )
    return validate.sheet_violations(rows, "sample_name")


def order_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as sheet rows, right and wrong ones."""
    status, priority, key = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderkey").cast("string")
    return table(spark, sf, "orders").select(
        key.alias("sample_name"),
        F.when(status == "P", F.concat(F.lit("GCA_"), key, F.lit(".1")))
        .when(status == "O", F.concat(F.lit("GCF-"), key))
        .alias("assembly"),
        F.when(priority != "5-LOW", priority).alias("species"),
        F.concat(F.when(priority == "1-URGENT", F.lit("T")).otherwise(F.lit("ST")), F.col("o_custkey").cast("string")).alias("st"),
        F.when(status == "F", F.lit("TRUE")).when(status == "O", F.lit("true")).otherwise(F.lit("FALSE")).alias("use_original_reads"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit("")).otherwise(key).alias("short_reads"),
    )


@query("""
WITH sheet AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS sample_name,
         CASE WHEN o_orderstatus = 'P' THEN 'GCA_' || o_orderkey || '.1' WHEN o_orderstatus = 'O' THEN 'GCF-' || o_orderkey END AS assembly,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS species,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'T' ELSE 'ST' END || o_custkey AS st,
         CASE o_orderstatus WHEN 'F' THEN 'TRUE' WHEN 'O' THEN 'true' ELSE 'FALSE' END AS flag,
         CASE WHEN o_custkey % 2 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS short_reads
  FROM orders)
SELECT sample_name, 'assembly' AS rule FROM sheet WHERE NOT coalesce(regexp_matches(assembly, '^GC\\w_\\d+(\\.\\d+)?'), false)
UNION ALL SELECT sample_name, 'species' FROM sheet WHERE species IS NULL
UNION ALL SELECT sample_name, 'st' FROM sheet WHERE NOT coalesce(regexp_matches(st, '^ST\\d+'), false)
UNION ALL SELECT sample_name, 'use_original_reads' FROM sheet WHERE flag NOT IN ('TRUE', 'FALSE')
UNION ALL SELECT sample_name, 'original reads' FROM sheet WHERE upper(flag) = 'TRUE' AND short_reads = ''
""")
def format_violations(spark: SparkSession, sf: str) -> DataFrame:
    rules = {**validate.format_rules(), **validate.original_reads_rule()}
    return validate.sheet_violations(order_sheet(spark, sf), "sample_name", rules)


# --- filters -------------------------------------------------------------------------------------------------


def customer_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("sample_name"), F.col("c_mktsegment").alias("species"), F.col("c_nationkey").alias("st")
    )


@query(f"SELECT c_custkey AS sample_name, c_mktsegment AS species, c_nationkey AS st FROM customer WHERE c_mktsegment = '{SPECIES}'")
def species_filter(spark: SparkSession, sf: str) -> DataFrame:
    return customer_sheet(spark, sf).where(F.col("species") == SPECIES)


@query(f"SELECT c_custkey AS sample_name, c_mktsegment AS species, c_nationkey AS st FROM customer WHERE c_mktsegment <> '{SPECIES}'")
def other_species(spark: SparkSession, sf: str) -> DataFrame:
    return customer_sheet(spark, sf).where(F.col("species") != SPECIES)


def one_sql(source: str, purpose: str, key: str = "sample_name") -> str:
    return f"SELECT * FROM {source} ORDER BY {h(purpose, key)}, {key} LIMIT 1"


CUSTOMER_SHEET = "sheet AS (SELECT c_custkey AS sample_name, c_mktsegment AS species, c_nationkey AS st FROM customer)"


@query(f"""
WITH {CUSTOMER_SHEET}, own AS (SELECT * FROM sheet WHERE species = '{SPECIES}'), main AS ({one_sql('own', 'main')})
SELECT s.* FROM sheet s JOIN main m ON s.species = m.species AND s.st <> m.st
""")
def strain_candidates(spark: SparkSession, sf: str) -> DataFrame:
    rows = customer_sheet(spark, sf)
    main = selection.choose_one(rows.where(F.col("species") == SPECIES), "sample_name", 42, "main")
    return joins.strain_candidates(rows, main)


# --- sheet building ------------------------------------------------------------------------------------------


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS "SAMPLE_NAME", p_brand AS "SHORT_READS", p_type AS "ASSEMBLY",
       replace(p_name || ' sensu stricto', ' sensu stricto', '') AS "SPECIES", replace('ST' || p_size || '~', '~', '') AS "ST",
       'Unknown' AS "AMR", 'FALSE' AS "USE_ORIGINAL_READS"
FROM part
""")
def tidy_sheet(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").withColumns(
        {
            "sample": F.col("p_partkey").cast("string"),
            "species": F.concat("p_name", F.lit(" sensu stricto")),
            "st": F.concat(F.lit("ST"), F.col("p_size").cast("string"), F.lit("~")),
        }
    )
    return sheet.tidy_sheet(rows, "sample", "p_brand", "p_type", "species", "st")


@query(f"""
SELECT c_custkey AS sample_name, CASE WHEN c_acctbal < 0 THEN 'true' ELSE 'FALSE' END AS use_original_reads,
       CASE WHEN c_acctbal < 0 THEN -1 ELSE {randint(40, 60, 'coverage', 'c_custkey')} END AS coverage,
       CAST(CASE WHEN c_acctbal < 0 THEN -1 ELSE 150 END AS INTEGER) AS read_length,
       CASE WHEN c_acctbal < 0 THEN 'Unknown' ELSE 'HS25' END AS platform,
       CAST(CASE WHEN c_acctbal < 0 THEN -1 ELSE 200 END AS INTEGER) AS fragment_length,
       CAST(CASE WHEN c_acctbal < 0 THEN -1 ELSE 10 END AS INTEGER) AS standard_deviation,
       CAST(CASE WHEN c_acctbal < 0 THEN -1 ELSE 42 END AS INTEGER) AS random_seed,
       'PASSED' AS qc, 'NONE' AS error, 'None' AS notes
FROM customer
""")
def run_params(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("sample_name"),
        F.when(F.col("c_acctbal") < 0, F.lit("true")).otherwise(F.lit("FALSE")).alias("use_original_reads"),
    )
    return sheet.with_run_params(rows, "sample_name")


@query(f"""
SELECT s_suppkey, s_name, 'sample' || {zfill('row_number() OVER (ORDER BY s_suppkey)', 2)} AS public_name FROM supplier
""")
def number_samples(spark: SparkSession, sf: str) -> DataFrame:
    return sheet.number_samples(table(spark, sf, "supplier").select("s_suppkey", "s_name"), "s_suppkey")


COPY = "CASE WHEN copy = 1 THEN name ELSE name || '_' || copy END AS public_name"


@query(f"""
WITH named AS (SELECT doc_id, 'Sample_' || substr(md5(text), 1, 8) AS name FROM documents),
placed AS (SELECT doc_id, name, row_number() OVER (PARTITION BY name ORDER BY {h('copy', 'doc_id', seed=0)}, doc_id) AS copy FROM named)
SELECT doc_id, {COPY} FROM placed
""")
def digest_names(spark: SparkSession, sf: str) -> DataFrame:
    return sheet.digest_names(text_digest(spark, sf), "digest", "doc_id")


@query(f"""
SELECT source, doc_id, source || '_contig_' || {zfill('row_number() OVER (PARTITION BY source ORDER BY doc_id)', 4)} AS contig_name
FROM documents
""")
def anonymise_contigs(spark: SparkSession, sf: str) -> DataFrame:
    return sheet.anonymise_contigs(table(spark, sf, "documents").select("source", "doc_id"), "source", "doc_id")


@query("""
SELECT c_name AS "ID", c_name || '_R1.fastq.gz' AS "R1", c_name || '_R2.fastq.gz' AS "R2", c_mktsegment AS "SPECIES",
       'Unknown' AS "QC", 'Unknown' AS "ERROR", 'Unknown' AS "ST", 'Unknown' AS "AMR", '' AS "Notes"
FROM customer
""")
def blank_sheet(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        F.col("c_name").alias("public_name"),
        F.col("c_mktsegment").alias("species"),
        *[F.concat("c_name", F.lit(f"_R{m}.fastq.gz")).alias(f"r{m}") for m in (1, 2)],
    )
    return sheet.blank_sheet(rows)


LABELS = ["NORMAL", "TRUNCATED", "CONTAMINATED", "POOR_QUALITY", "LOW_COVERAGE", "CORRUPTED"]


def _answers_sql() -> str:
    label = pick(LABELS, randint(1, len(LABELS), "label", "c_custkey"))
    return f"""
WITH drawn AS (SELECT *, {label} AS label, {randint(10, 30, 'exam_decrement', 'c_custkey')} AS parameter FROM customer)
SELECT c_custkey AS sample_name, CAST(NULL AS VARCHAR) AS short_reads, c_name AS public_name, 'GCA_' || c_custkey AS assembly,
       c_mktsegment AS species, 'ST' || c_nationkey AS st, CAST(42 AS INTEGER) AS random_seed, 'FALSE' AS use_original_reads,
       'out' AS output_dir, c_name || '.fasta' AS assembly_file, c_name || '_R1.fastq.gz' AS r1, c_name || '_R2.fastq.gz' AS r2,
       {randint(40, 60, 'coverage', 'c_custkey')} AS coverage, CAST(150 AS INTEGER) AS read_length, 'HS25' AS platform,
       CAST(200 AS INTEGER) AS fragment_length, CAST(10 AS INTEGER) AS standard_deviation,
       CASE WHEN label = 'NORMAL' THEN 'PASSED' ELSE 'FAILED' END AS qc,
       CASE label WHEN 'NORMAL' THEN 'NONE' WHEN 'POOR_QUALITY' THEN 'DEGRADED' ELSE label END AS error,
       CASE label WHEN 'NORMAL' THEN 'None' WHEN 'TRUNCATED' THEN 'Truncated reads to ' || parameter || ' bp'
            WHEN 'CONTAMINATED' THEN 'Contamined sample with ' || parameter || '% using f_R1.fastq.gz and f_R2.fastq.gz'
            WHEN 'POOR_QUALITY' THEN 'Degraded sample so base quality is decremented ' || parameter || ' points'
            WHEN 'LOW_COVERAGE' THEN 'Low coverage sample with ' || parameter || '%'
            WHEN 'CORRUPTED' THEN 'Corrupted sample with random bytes' END AS notes,
       CAST(NULL AS BIGINT) AS read_count
FROM drawn
"""


@query(_answers_sql())
def answer_sheet(spark: SparkSession, sf: str) -> DataFrame:
    from seqlab.functions import draw_choice

    name = F.col("c_name")
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("sample_name"),
        F.lit(None).cast("string").alias("short_reads"),
        name.alias("public_name"),
        F.concat(F.lit("GCA_"), F.col("c_custkey").cast("string")).alias("assembly"),
        F.col("c_mktsegment").alias("species"),
        F.concat(F.lit("ST"), F.col("c_nationkey").cast("string")).alias("st"),
        F.lit("FALSE").alias("use_original_reads"),
        F.lit("out").alias("output_dir"),
        F.concat(name, F.lit(".fasta")).alias("assembly_file"),
        *[F.concat(name, F.lit(f"_R{m}.fastq.gz")).alias(f"r{m}") for m in (1, 2)],
        *[F.lit(f"in/f_R{m}.fastq.gz").alias(f"foreign_r{m}") for m in (1, 2)],
        draw_choice(LABELS, 42, "label", "c_custkey").alias("label"),
        selection.drawn_parameter("exam_decrement", 42, "c_custkey").alias("parameter"),
        F.lit(None).cast("bigint").alias("read_count"),
    )
    return sheet.answer_sheet(sheet.with_run_params(rows, "sample_name"))


@query("SELECT page_id, regexp_extract(url, '[^/]*$') AS base FROM pages")
def url_basename(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", basename("url").alias("base"))


# --- selection -----------------------------------------------------------------------------------------------


@query(f"SELECT o_orderkey, o_orderstatus FROM orders ORDER BY {h('sample', 'o_orderkey')}, o_orderkey LIMIT 100")
def sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return take_sample(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), 100, "o_orderkey")


@query(f"""
WITH n AS (SELECT count(*) AS n FROM supplier),
indexed AS (SELECT s_suppkey, s_name, row_number() OVER (ORDER BY {h('topup', 's_suppkey')}, s_suppkey) AS i FROM supplier),
extra AS (SELECT r.r AS replicate, {randint(1, 'n', 'topup draw', 'r.r')} AS i FROM n, unnest(range(1, n // 2 + 1)) AS r(r))
SELECT s_suppkey, s_name, CAST(0 AS BIGINT) AS replicate FROM supplier
UNION ALL SELECT s_suppkey, s_name, replicate FROM extra JOIN indexed USING (i)
""")
def sample_topup(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    n = rows.count()
    return selection.sample_with_topup(rows, n + n // 2, "s_suppkey")


@query(f"WITH {CUSTOMER_SHEET} {one_sql('sheet', 'choose')}")
def choose_one(spark: SparkSession, sf: str) -> DataFrame:
    return selection.choose_one(customer_sheet(spark, sf), "sample_name")


@query(f"""
WITH {CUSTOMER_SHEET}, one AS (
  SELECT *, row_number() OVER (PARTITION BY st ORDER BY {h('in group', 'sample_name')}, sample_name) AS r FROM sheet)
SELECT sample_name, species, st FROM one WHERE r = 1 ORDER BY {h('groups', 'st')}, st LIMIT 10
""")
def sample_groups(spark: SparkSession, sf: str) -> DataFrame:
    return selection.sample_groups(customer_sheet(spark, sf), "st", "sample_name", 10)


def label_sql(key: str) -> str:
    other = pick(("TRUNCATED", "CORRUPT", "CONTAMINATED", "POOR_QUALITY", "LOW_COVERAGE"), randint(1, 5, "error type", key))
    return (
        f"CASE WHEN {u('contaminated', key)} < CAST(0.4 AS DOUBLE) THEN 'CONTAMINATED' "
        f"WHEN {u('low coverage', key)} < CAST(0.2 AS DOUBLE) THEN 'LOW_COVERAGE' ELSE {other} END"
    )


def labelled_sql(source: str, key: str, proportion: float = 0.6) -> str:
    """source plus error and hit (picked by the proportion)."""
    rank = f"row_number() OVER (ORDER BY {h('sample', key)}, {key})"
    return (
        f"SELECT *, CASE WHEN hit THEN {label_sql(key)} ELSE 'NONE' END AS error FROM ("
        f"SELECT *, {rank} <= floor(count(*) OVER () * CAST({proportion} AS DOUBLE)) AS hit FROM {source})"
    )


@query(f"""
WITH {CUSTOMER_SHEET}
SELECT sample_name, species, st, CASE WHEN hit THEN 'FAILED' ELSE 'PASSED' END AS qc, error,
       CASE WHEN hit THEN 'Error introduced' ELSE 'None' END AS notes
FROM ({labelled_sql('sheet', 'sample_name')})
""")
def assign_errors(spark: SparkSession, sf: str) -> DataFrame:
    return selection.assign_errors(customer_sheet(spark, sf), "sample_name", 0.6)


@query(f"""
WITH placed AS (SELECT s_suppkey, s_name, row_number() OVER (ORDER BY {h('labels', 's_suppkey')}, s_suppkey) AS p FROM supplier)
SELECT s_suppkey, s_name, CASE WHEN p <= 2 THEN 'CONTAMINATED' WHEN p <= 3 THEN 'POOR_QUALITY' WHEN p <= 4 THEN 'TRUNCATED'
       WHEN p <= 5 THEN 'LOW_COVERAGE' ELSE 'NORMAL' END AS label
FROM placed
""")
def deal_labels(spark: SparkSession, sf: str) -> DataFrame:
    from seqlab.plans.exams import REAL_LABELS

    return selection.deal_labels(table(spark, sf, "supplier").select("s_suppkey", "s_name"), "s_suppkey", REAL_LABELS)


@query(f"""
WITH placed AS (SELECT c_custkey, row_number() OVER (ORDER BY {h('deal', 'c_custkey')}, c_custkey) AS p FROM customer),
pool AS (SELECT s_suppkey, s_name, row_number() OVER (ORDER BY {h('pool', 's_suppkey')}, s_suppkey) AS slot FROM supplier)
SELECT c_custkey, s_suppkey, s_name FROM placed JOIN pool ON slot = (p - 1) % (SELECT count(*) FROM supplier) + 1
""")
def deal_pool(spark: SparkSession, sf: str) -> DataFrame:
    pool = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return selection.deal_pool(table(spark, sf, "customer").select("c_custkey"), "c_custkey", pool, "s_suppkey")


def _draws_sql() -> str:
    ranges = {
        "truncate_length": (5, 100), "contamination_percent": (20, 80), "min_quality": (5, 9), "max_quality": (10, 20), "coverage": (40, 60),
        "exam_truncate_length": (1, 50), "exam_coverage_percent": (1, 20), "exam_contamination_percent": (60, 90), "exam_decrement": (10, 30),
    }
    drawn = [f"{randint(a, b, name, 'c_custkey')} AS {name}" for name, (a, b) in ranges.items()]
    return f"SELECT c_custkey, {', '.join(drawn)}, {fraction_sql('c_custkey')} AS fraction FROM customer"


def fraction_sql(key: str) -> str:
    low, high = 0.1, 0.4
    return f"(CAST({low} AS DOUBLE) + {u('fraction', key)} * CAST({high - low!r} AS DOUBLE))"


@query(_draws_sql())
def draw_params(spark: SparkSession, sf: str) -> DataFrame:
    return selection.draw_params(table(spark, sf, "customer").select("c_custkey"), "c_custkey")


# --- layouts, splits and texts -------------------------------------------------------------------------------


def public_rows(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("c_name")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("sample_name"), name.alias("public_name"), F.col("c_mktsegment").alias("species"),
        *[F.concat(F.lit("d/"), name, F.lit(f"_R{m}.fastq.gz")).alias(f"r{m}") for m in (1, 2)], F.concat(F.lit("x/y/"), name, F.lit(".fna")).alias("assembly_file"),
    )


@query("""
SELECT c_name AS sample_name, c_mktsegment AS species, c_name || '_R1.fastq.gz' AS r1, c_name || '_R2.fastq.gz' AS r2, '' AS qc, '' AS error, '' AS st,
       '' AS notes, c_name || '.fasta' AS fasta FROM customer
""")
def basic_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return sheet.blank_sheet(public_rows(spark, sf), "basic")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS sample, '' AS st, '' AS k_locus, '' AS capsule_type, '' AS wzi, '' AS o_locus, '' AS o_type, '' AS bla_carb,
       c_name || '.fna' AS fasta FROM customer
""")
def typing_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return sheet.blank_sheet(public_rows(spark, sf), "typing", public=False)


@query("""
SELECT c_custkey AS sample_name, CASE WHEN c_nationkey % 3 = 0 THEN 'true' WHEN c_nationkey % 3 = 1 THEN 'FALSE' END AS use_original_reads,
       c_nationkey % 3 = 0 AS own FROM customer
""")
def split_by_reads(spark: SparkSession, sf: str) -> DataFrame:
    from seqlab.plans.simulate import split_by_reads as split

    kind = F.col("c_nationkey") % 3
    flag = F.when(kind == 0, F.lit("true")).when(kind == 1, F.lit("FALSE"))
    own, made = split(table(spark, sf, "customer").select(F.col("c_custkey").alias("sample_name"), flag.alias("use_original_reads")))
    return own.withColumn("own", F.lit(True)).unionByName(made.withColumn("own", F.lit(False)))


@query(f"""
WITH {CUSTOMER_SHEET}, placed AS (SELECT *, row_number() OVER (ORDER BY {h('topup', 'sample_name')}, sample_name) AS i FROM sheet)
SELECT sample_name, species, st, CAST(0 AS BIGINT) AS replicate FROM placed WHERE i <= 40
""")
def sample_without_topup(spark: SparkSession, sf: str) -> DataFrame:
    return selection.sample_with_topup(customer_sheet(spark, sf), 40, "sample_name")


@query("""
SELECT doc_id, md5(regexp_replace(line, '^[ \t\n\r]+|[ \t\n\r]+$', '', 'g')) AS stripped_md5
FROM (SELECT doc_id, chr(32) || chr(9) || text || chr(13) || chr(10) AS line FROM documents)
""")
def strip_text(spark: SparkSession, sf: str) -> DataFrame:
    from seqlab.functions import strip

    line = F.concat(F.lit(" \t"), "text", F.lit("\r\n"))
    return table(spark, sf, "documents").select("doc_id", F.md5(strip(line).cast("binary")).alias("stripped_md5"))


# --- joins ---------------------------------------------------------------------------------------------------


@query("""
SELECT 'sp' || s_suppkey AS species, s_name AS sample_name, CASE WHEN s_acctbal < 0 THEN '' ELSE s_name END AS assembly
FROM supplier WHERE s_acctbal >= 0 AND s_suppkey NOT IN (SELECT 3 * c_custkey FROM customer)
""")
def contaminant_pool(spark: SparkSession, sf: str) -> DataFrame:
    candidates = table(spark, sf, "supplier").select(
        F.concat(F.lit("sp"), F.col("s_suppkey").cast("string")).alias("species"),
        F.col("s_name").alias("sample_name"),
        F.when(F.col("s_acctbal") < 0, "").otherwise(F.col("s_name")).alias("assembly"),
    )
    # All customers are the sheet, under tripled keys: a third of the suppliers is of a species in it.
    species = F.concat(F.lit("sp"), (3 * F.col("c_custkey")).cast("string"))
    return joins.contaminant_pool(candidates, table(spark, sf, "customer").select(species.alias("species")))


@query("""
SELECT o_orderkey, o_custkey AS c_custkey, CASE WHEN c_custkey IS NOT NULL THEN 'Sample_' || substr(md5(c_name), 1, 8) END AS public_name
FROM orders LEFT JOIN (SELECT 2 * c_custkey AS c_custkey, c_name FROM customer) ON o_custkey = c_custkey
""")
def apply_names(spark: SparkSession, sf: str) -> DataFrame:
    digest = F.md5(F.col("c_name").cast("binary"))
    # All customers, under doubled keys: half of the orders find no name.
    names = table(spark, sf, "customer").select((2 * F.col("c_custkey")).alias("c_custkey"), sheet.digest_name(digest).alias("public_name"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return joins.apply_names(rows, names, "c_custkey")


@query("""
WITH prefixes AS (SELECT DISTINCT regexp_extract(url, '^https?://[^/]+') AS prefix FROM pages)
SELECT prefix, min(url) AS first_path, count(*) AS n_paths FROM prefixes JOIN pages ON starts_with(url, prefix)
WHERE prefix <> '' GROUP BY prefix
""")
def prefix_lookup(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("url")
    prefixes = pages.select(F.regexp_extract("url", "^https?://[^/]+", 0).alias("prefix"))
    return joins.prefix_lookup(prefixes, pages, "prefix", "url")


@query("""
WITH r AS (SELECT conv_id, turn // 2 AS pair, turn % 2 AS mate, role, text FROM conversations)
SELECT a.conv_id, a.pair, a.role AS role_1, a.text AS text_1, b.role AS role_2, b.text AS text_2
FROM r a JOIN r b ON a.conv_id = b.conv_id AND a.pair = b.pair AND a.mate = 0 AND b.mate = 1
""")
def mate_pairs(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select(
        "conv_id", F.shiftright("turn", 1).alias("pair"), (F.col("turn") % 2).alias("mate"), "role", "text"
    )
    return joins.mate_pairs(turns, "conv_id", "pair", "mate", ["role", "text"], (0, 1))


@query("""
WITH stats AS (SELECT l_orderkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
                      max(l_linestatus) AS o_orderstatus FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, CASE WHEN s.l_orderkey IS NOT NULL THEN s.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus,
       o.o_orderpriority, s.n_lines, s.quantity
FROM orders o LEFT JOIN stats s ON o.o_orderkey = s.l_orderkey
""")
def enrich_sheet(spark: SparkSession, sf: str) -> DataFrame:
    stats = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.max("l_linestatus").alias("o_orderstatus"),
    )
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return joins.enrich_sheet(rows, stats, "o_orderkey")


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def have_labels(spark: SparkSession, sf: str) -> DataFrame:
    return joins.have_table(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), "doc_id")


# --- hits ----------------------------------------------------------------------------------------------------


def line_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as alignment hits; returned items lie on the reverse strand."""
    start = F.floor("l_extendedprice").cast("bigint")
    span = F.col("l_quantity").cast("bigint") * 10
    back = F.col("l_returnflag") == "R"
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("allele"),
        F.col("l_partkey").alias("contig"),
        F.col("l_linenumber").alias("qstart"),
        F.col("l_suppkey").alias("qend"),
        F.when(back, start + span).otherwise(start).alias("sstart"),
        F.when(back, start).otherwise(start + span).alias("send"),
        F.col("l_quantity").alias("score"),
    )


HITS = """hits AS (
  SELECT l_orderkey AS allele, l_partkey AS contig, l_linenumber AS qstart, l_suppkey AS qend,
         CASE WHEN l_returnflag = 'R' THEN s + w ELSE s END AS sstart, CASE WHEN l_returnflag = 'R' THEN s ELSE s + w END AS send,
         l_quantity AS score
  FROM (SELECT *, CAST(floor(l_extendedprice) AS BIGINT) AS s, CAST(l_quantity AS BIGINT) * 10 AS w FROM lineitem)),
best AS (
  SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY allele ORDER BY score DESC, contig, sstart, send, qstart, qend) AS r FROM hits)
  WHERE r = 1)"""
FEATURE = "least(sstart, send) - 1 AS feat_start, greatest(sstart, send) AS feat_end, CAST(CASE WHEN sstart > send THEN -1 ELSE 1 END AS INTEGER) AS strand"
TIES = ["contig", "sstart", "send", "qstart", "qend"]


@query(f"WITH {HITS} SELECT * FROM best")
def best_hit(spark: SparkSession, sf: str) -> DataFrame:
    return hit_ops.best_hit(line_hits(spark, sf), "allele", "score", TIES)


@query(f"WITH {HITS} SELECT *, {FEATURE} FROM hits")
def strand_norm(spark: SparkSession, sf: str) -> DataFrame:
    return hit_ops.strand_norm(line_hits(spark, sf), "sstart", "send")


@query(f"WITH {HITS} SELECT contig, allele, {FEATURE} FROM hits ORDER BY feat_start, feat_end, contig, allele")
def sorted_features(spark: SparkSession, sf: str) -> DataFrame:
    features = hit_ops.strand_norm(line_hits(spark, sf), "sstart", "send").select("contig", "allele", "feat_start", "feat_end", "strand")
    return hit_ops.sorted_features(features, "feat_start", "feat_end", "contig", "allele")


@query(f"""
WITH {HITS}, f AS (SELECT contig, allele, qstart, qend, {FEATURE} FROM hits)
SELECT p_partkey AS contig, p_name, allele, qstart, qend, feat_start, feat_end, strand,
       CASE WHEN allele IS NOT NULL THEN row_number() OVER (PARTITION BY p_partkey ORDER BY feat_start, feat_end, allele, qstart, qend) END AS feature_number
FROM part LEFT JOIN f ON p_partkey = contig
""")
def contig_features(spark: SparkSession, sf: str) -> DataFrame:
    contigs = table(spark, sf, "part").select(F.col("p_partkey").alias("contig"), "p_name")
    features = hit_ops.strand_norm(line_hits(spark, sf), "sstart", "send").drop("sstart", "send", "score")
    return hit_ops.contig_features(contigs, features, "contig", "feat_start", ["feat_end", "allele", "qstart", "qend"])


@query(f"""
WITH {HITS}, f AS (SELECT contig, allele, {FEATURE} FROM best)
SELECT p_partkey AS contig, feat_start, feat_end, strand,
       CASE WHEN allele IS NOT NULL THEN 'gene' END AS type, allele AS locus, allele AS gene,
       CASE WHEN allele IS NOT NULL THEN 'Evidence:seqlab' END AS note, CASE WHEN allele IS NOT NULL THEN 'seqlab' END AS source,
       CASE WHEN allele IS NOT NULL THEN row_number() OVER (PARTITION BY p_partkey ORDER BY feat_start, allele) END AS feature_number
FROM part LEFT JOIN f ON p_partkey = contig
""")
def locus_annotation(spark: SparkSession, sf: str) -> DataFrame:
    contigs = table(spark, sf, "part").select(F.col("p_partkey").alias("contig"))
    return hit_ops.annotate(contigs, line_hits(spark, sf))


# --- statistics over sheets ----------------------------------------------------------------------------------


@query("SELECT DISTINCT c_mktsegment AS species FROM customer")
def distinct_species(spark: SparkSession, sf: str) -> DataFrame:
    return customer_sheet(spark, sf).select("species").distinct()


@query("SELECT c_nationkey AS st, count(*) AS n_samples FROM customer GROUP BY c_nationkey")
def group_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return customer_sheet(spark, sf).groupBy("st").agg(F.count(F.lit(1)).alias("n_samples"))


def n50_sql(source: str, by: str, length: str) -> str:
    return f"""
SELECT {by}, max(len) FILTER (WHERE upto * 2 >= total) AS n50 FROM (
  SELECT {by}, {length} AS len,
         sum({length}) OVER (PARTITION BY {by} ORDER BY {length} DESC RANGE UNBOUNDED PRECEDING) AS upto,
         sum({length}) OVER (PARTITION BY {by}) AS total
  FROM {source}) GROUP BY {by}"""


@query(n50_sql("(SELECT l_suppkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem)", "l_suppkey", "q"))
def n50(spark: SparkSession, sf: str) -> DataFrame:
    lengths = table(spark, sf, "lineitem").select("l_suppkey", F.col("l_quantity").cast("bigint").alias("q"))
    return n50_from_lengths(lengths, ["l_suppkey"], "q")


TOOLS = ["de", "en", "es", "fr"]


def _report_columns(tool: str) -> str:
    stat = f"FILTER (WHERE lang = '{tool}')"
    gc = percent_2dp(f"sum(gc) {stat}", f"sum(len) {stat}")
    return (
        f"CAST(sum(len) {stat} AS BIGINT) AS {tool}_total_bases, CASE WHEN count(*) {stat} > 0 THEN count(*) {stat} END AS {tool}_number_of_contigs, "
        f"max(len) FILTER (WHERE lang = '{tool}' AND upto * 2 >= total) AS {tool}_n50, {gc} AS {tool}_gc_content"
    )


@query(f"""
WITH c AS (
  SELECT source, lang, length(text) AS len, {letters('text', 'GCgc')} AS gc,
         sum(length(text)) OVER (PARTITION BY source, lang ORDER BY length(text) DESC RANGE UNBOUNDED PRECEDING) AS upto,
         sum(length(text)) OVER (PARTITION BY source, lang) AS total
  FROM documents WHERE length(text) > 0)
SELECT source, {', '.join(_report_columns(t) for t in TOOLS)}, source || '_scaffolds.fasta' AS en_assembly FROM c GROUP BY source
""")
def assembler_report(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("source", "lang", F.col("text").alias("sequence"))
    return make_assembler_report(documents.select("source").distinct(), documents, "source", "lang", TOOLS, {"en": "_scaffolds.fasta"})
