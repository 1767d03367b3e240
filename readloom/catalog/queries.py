"""Registered queries: operator, inputs and SQL oracle side by side.

Every query runs over whole driver tables through the fixture views. Ratios are
rounded to six decimals here, at the edge; operators return full doubles.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bases import phred
from ..operators import align, discovery, expression, features, manifest, overlap, reads_qc, report, trim
from ..plans import one_pass, workflow
from ..session import scratch_dir
from ..sources import fastq, reports, text_tables
from . import fixtures as fx
from .oracles import oracle

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    items: str  # operator ids of the inventory
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, items: str, sql: str | None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        QUERIES[name] = Query(items, run, oracle(sql) if sql else None)
        return run

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def chain(spark: SparkSession, sf: str) -> DataFrame:
    return trim.trim_chain(fx.reads(spark, sf))


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return trim.both_stages(chain(spark, sf))


STAGED = ("sample", "stage")


# --- sources, sinks, manifests ----------------------------------------------------


@query("fastq_round_trip", "S1 S16", "SELECT sample, read_id, seq, qual FROM reads")
def _(spark, sf):
    path = scratch_dir(spark, "fastq")
    fastq.write_fastq(fx.reads(spark, sf), path, by_sample=True)
    return fastq.read_fastq(spark, path)


@query(
    "sample_files",
    "S16 T8 T9",
    """SELECT c.*, r.n_reads AS before_reads, r.bases AS before_bases, r.q20_bases AS before_q20_bases,
    r.q30_bases AS before_q30_bases, r.gc_bases AS before_gc_bases, coalesce(t.n_reads, 0) AS after_reads,
    coalesce(t.bases, 0) AS after_bases, coalesce(t.q20_bases, 0) AS after_q20_bases,
    coalesce(t.q30_bases, 0) AS after_q30_bases, coalesce(t.gc_bases, 0) AS after_gc_bases,
    coalesce(t.n_reads, 0) AS file_reads, coalesce(t.bases, 0) AS file_bases
    FROM (SELECT sample, count(*) FILTER (reason = 'passed') AS passed, count(*) FILTER (reason = 'too_many_N') AS "too_many_N",
      count(*) FILTER (reason = 'low_quality') AS low_quality, count(*) FILTER (reason = 'too_short') AS too_short
      FROM chain GROUP BY 1) c
    JOIN totals r ON r.sample = c.sample AND r.stage = 'raw'
    LEFT JOIN totals t ON t.sample = c.sample AND t.stage = 'trimmed'""",
)
def _(spark, sf):
    path = f"{scratch_dir(spark, 'sample-files')}/trimmed"
    told = one_pass.write_trimmed(chain(spark, sf), path, fx.read_samples(spark, sf))
    files = fastq.read_fastq(spark, path).groupBy("sample").agg(
        F.count("*").alias("file_reads"), F.sum(F.length("seq").cast("long")).alias("file_bases")
    )
    return told.join(files, "sample", "left").fillna(0, ["file_reads", "file_bases"])


@query(
    "matrix_file",
    "S15 S17",
    """SELECT *, (SELECT count(DISTINCT gene_id) FROM counts) AS n_genes, CAST(3 AS BIGINT) AS n_samples,
    'A,N,R' AS sample_columns FROM (
      SELECT gene_id AS Geneid, length AS Length, coalesce(sum("count") FILTER (sample = 'A'), 0)::DOUBLE AS A,
        coalesce(sum("count") FILTER (sample = 'N'), 0)::DOUBLE AS N, coalesce(sum("count") FILTER (sample = 'R'), 0)::DOUBLE AS R
      FROM counts GROUP BY 1, 2)""",
)
def _(spark, sf):
    path = f"{scratch_dir(spark, 'matrix-file')}/tables"
    wide = expression.wide_table(fx.counts(spark, sf), "count", fx.samples(spark, sf)).orderBy("Geneid")
    shape = one_pass.write_matrix(wide, path, "counts").first().asDict()
    schema = ", ".join(f"`{c}` {'double' if c in ('A', 'N', 'R') else kind}" for c, kind in wide.dtypes)
    back = text_tables.read_matrix_tsv(spark, f"{path}/counts.tsv", schema)
    return back.withColumns({n: F.lit(v).cast("string" if n == "sample_columns" else "long") for n, v in shape.items()})


@query(
    "file_manifest",
    "S13 S16",
    """SELECT sample, CAST(sum(strlen(read_id) + 2 * strlen(seq) + 6) AS BIGINT) AS bytes FROM reads GROUP BY 1""",
)
def _(spark, sf):
    path = scratch_dir(spark, "manifest")
    fastq.write_fastq(fx.reads(spark, sf), path, compression="none", by_sample=True)
    return reports.read_manifest(spark, path).groupBy("sample").agg(F.sum("length").alias("bytes"))


@query(
    "gtf_features",
    "S2",
    """SELECT chrom, 'fixture' AS source, feature, start_pos, end_pos, strand, gene_id, 'protein_coding' AS gene_type,
    '2' AS level, 'basic' AS tag FROM features""",
)
def _(spark, sf):
    path = scratch_dir(spark, "gtf")
    fx.gtf_lines(spark, sf).unionByName(spark.range(1).select(F.lit("#!comment").alias("value"))).write.text(path)
    rows = text_tables.read_gtf(spark, path)
    for name in ("gene_id", "gene_type", "level", "tag"):
        rows = features.attribute(rows, name)
    return rows.select(
        "chrom", "source", "feature", "start_pos", "end_pos", "strand", "gene_id", "gene_type", "level", "tag"
    )


@query(
    "fasta_chunks",
    "S3",
    """SELECT concat('d', doc_id) AS chrom, CAST(c AS INTEGER) AS chunk_no, c * 1000 AS "offset",
    substr(t, c * 1000 + 1, 1000) AS seq
    FROM (SELECT doc_id, t, unnest(range(0, (length(t) + 999) // 1000)) AS c FROM letters)""",
)
def _(spark, sf):
    path = scratch_dir(spark, "fasta")
    letters = fx.letters_of("text")
    wrapped = F.regexp_replace(letters, "(.{60})", "$1\n")
    docs = fx.table(spark, sf, "documents", "doc_id", "text")
    docs.select(F.concat(F.lit(">d"), "doc_id", F.lit(" a document\n"), wrapped).alias("value")).write.text(path)
    return text_tables.read_fasta(spark, path, chunk=1000)


@query(
    "sam_alignments",
    "S4",
    """SELECT sample, read_id, flag, chrom, pos, mapq, cigar, nh, nm,
    array_to_string([x for x in ['NH=' || nh, 'NM=' || nm, 'XS=A'] if x IS NOT NULL], ',') AS tags FROM alignments""",
)
def _(spark, sf):
    path = scratch_dir(spark, "sam")
    c = F.col
    line = F.concat_ws(
        "\t",
        "read_id",
        c("flag").cast("string"),
        "chrom",
        c("pos").cast("string"),
        c("mapq").cast("string"),
        "cigar",
        F.lit("*\t0\t0\t*\t*"),
        F.concat(F.lit("NH:i:"), c("nh")),
        F.concat(F.lit("NM:i:"), c("nm")),
        F.lit("XS:Z:A"),
    )
    rows = fx.alignments(spark, sf).select("sample", line.alias("value"))
    header = rows.select("sample").distinct().select("sample", F.lit("@SQ\tSN:chr1\tLN:1000").alias("value"))
    rows.unionByName(header).write.partitionBy("sample").text(path)
    tags = F.transform(F.array_sort(F.map_entries("tags")), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    return text_tables.read_sam(spark, path).select(
        "sample", "read_id", "flag", "chrom", "pos", "mapq", "cigar", "nh", "nm", F.array_join(tags, ",").alias("tags")
    )


@query(
    "sam_dictionary",
    "S4",
    """SELECT chrom, CAST(length AS BIGINT) AS length,
    row_number() OVER (ORDER BY CASE WHEN chrom = 'chrM' THEN 5 ELSE CAST(substr(chrom, 4) AS INTEGER) END) - 1 AS ordinal
    FROM dictionary""",
)
def _(spark, sf):
    path = scratch_dir(spark, "dictionary")
    line = F.concat(F.lit("@SQ\tSN:"), "chrom", F.lit("\tLN:"), F.col("length").cast("string"))
    read = F.lit("r1\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n@SQ\tSN:late\tLN:1")
    lines = fx.dictionary(spark, sf).orderBy("ordinal").select(line.alias("value"))
    lines.coalesce(1).unionByName(spark.range(1).select(read.alias("value"))).coalesce(1).write.text(path)
    return text_tables.read_sam_dictionary(spark, path)


# Ending of the alignment files by which count tables name their columns.
def bam_paths(samples: list[str]) -> dict[str, str]:
    return {s: f"/x/{s}/{s}_Aligned.sortedByCoord.out.bam" for s in samples}


@query(
    "count_matrix_text",
    "S5 S15",
    """SELECT g.gene_id, s.sample, g.length, coalesce(c."count", 0) / 4.0::DOUBLE AS "count"
    FROM (SELECT DISTINCT gene_id, length FROM counts) g CROSS JOIN (SELECT DISTINCT sample FROM counts) s
    LEFT JOIN counts c ON c.gene_id = g.gene_id AND c.sample = s.sample""",
)
def _(spark, sf):
    # Fractional counts; genes that a sample lacks are written as empty cells and come back as 0.
    path, samples = scratch_dir(spark, "matrix"), fx.samples(spark, sf)
    quarters = fx.counts(spark, sf).withColumn("count", F.col("count") / 4.0)
    wide = expression.wide(quarters, "count", samples, fill=False)
    wide = wide.withColumnsRenamed({"gene_id": "Geneid", "length": "Length", **bam_paths(samples)})
    text_tables.write_matrix_tsv(wide, path)
    return expression.rename_by_sample(text_tables.read_count_matrix(spark, path), samples)


@query(
    "qc_report_cells",
    "S6",
    """SELECT DISTINCT sample, 'Kmer Content' AS module, 'pass' AS status, NULL::INTEGER AS row_no, NULL AS metric, NULL AS value
    FROM reads UNION ALL
    SELECT sample, 'Sequence Length Distribution' AS module, 'warn' AS status, CAST(row_no AS INTEGER) AS row_no, metric, value FROM (
      SELECT sample, row_no, unnest(['Length', 'Count']) AS metric,
        unnest([CAST(length AS VARCHAR), concat(n, '.0')]) AS value FROM (
        SELECT sample, length(seq) AS length, count(*) AS n,
          row_number() OVER (PARTITION BY sample ORDER BY length(seq)) AS row_no FROM reads GROUP BY 1, 2))
    UNION ALL SELECT DISTINCT sample, 'Sequence Length Distribution', 'warn', 0, 'Reads', 'all' FROM reads""",
)
def _(spark, sf):
    rows = reads_qc.length_distribution(fx.reads(spark, sf))
    line = F.concat(F.col("length").cast("string"), F.lit("\t"), F.col("n_reads").cast("string"), F.lit(".0"))
    lines = F.array_sort(F.collect_list(F.struct("length", line.alias("line"))))["line"]
    head = "##Report\t1\n>>Sequence Length Distribution\twarn\n#Reads\tall\n#Length\tCount\n"
    tail = "\n>>END_MODULE\n>>Kmer Content\tpass\n>>END_MODULE"
    text = F.concat(F.lit(head), F.array_join(lines, "\n"), F.lit(tail))
    path, report_folder = scratch_dir(spark, "qc"), F.concat("sample", F.lit(".sra_fastqc")).alias("report")
    rows.groupBy(report_folder).agg(text.alias("value")).write.partitionBy("report").text(path)
    return reports.read_qc_report(spark, path)


@query("qc_status_rows", "S7", "SELECT sample, module, status FROM qc_status WHERE stage = 'raw'")
def _(spark, sf):
    path = scratch_dir(spark, "status")
    rows = reads_qc.verdicts(reads_qc.qc_measures(fx.reads(spark, sf)))
    rows.select("status", "module", F.concat("sample", F.lit(".sra.fastq"))).write.option("sep", "\t").csv(path)
    return reports.read_qc_status(spark, path)


@query(
    "align_log_rates",
    "S8",
    """SELECT sample, label, concat(label, ' |', chr(9), n, '%') AS line, concat(n, '%') AS value FROM (
      SELECT sample, unnest(['Uniquely mapped reads %', '% of reads mapped to multiple loci', '% of reads unmapped: too short']) AS label,
        unnest([n_unique, n_multi, n_unmapped]) AS n FROM rates)""",
)
def _(spark, sf):
    rates = align.alignment_rates(fx.input_reads(spark, sf), fx.alignments(spark, sf))
    # Labels of the log's lines.
    labels = {
        "Number of input reads": "n_reads",
        "Uniquely mapped reads %": "n_unique",
        "% of reads mapped to multiple loci": "n_multi",
        "% of reads unmapped: too short": "n_unmapped",
    }
    lines = [F.concat(F.lit(f"     {k} |\t"), F.col(v).cast("string"), F.lit("%")) for k, v in labels.items()]
    path = scratch_dir(spark, "log")
    rates.select("sample", F.explode(F.array(*lines)).alias("value")).write.partitionBy("sample").text(path)
    return reports.read_align_log(spark, path)


@query(
    "flagstat_text",
    "S9",
    """SELECT sample, unnest([metric, metric || ' (mapQ>=5)']) AS label, unnest([passed, failed]) AS passed,
    unnest([failed, passed]) AS failed FROM flag_counts""",
)
def _(spark, sf):
    path = scratch_dir(spark, "flagstat")
    rows = align.flagstat(fx.alignments(spark, sf))

    def line(first: str, second: str, end: str):
        return F.concat(first, F.lit(" + "), second, F.lit(" "), "metric", F.lit(end))

    lines = F.array(line("passed", "failed", " (1.00% : N/A)"), line("failed", "passed", " (mapQ>=5)"))
    rows.select("sample", F.explode(lines).alias("value")).write.partitionBy("sample").text(path)
    return reports.read_flagstat(spark, path)


@query(
    "idxstats_text",
    "S9",
    "SELECT sample, chrom, CAST(length AS BIGINT) AS length, mapped, unmapped FROM contig_counts",
)
def _(spark, sf):
    path = scratch_dir(spark, "idxstats")
    rows = align.idxstats(fx.alignments(spark, sf), fx.dictionary(spark, sf))
    rows.select("sample", "chrom", "length", "mapped", "unmapped").write.partitionBy("sample").option("sep", "\t").csv(path)
    return reports.read_idxstats(spark, path)


@query(
    "count_summary_text",
    "S5 E3",
    """SELECT s.sample, x.status, count(o.read_id) AS n FROM samples s CROSS JOIN (SELECT unnest(['Assigned', 'Unassigned_Unmapped',
      'Unassigned_MappingQuality', 'Unassigned_MultiMapping', 'Unassigned_NoFeatures', 'Unassigned_Ambiguity']) AS status) x
    LEFT JOIN outcomes o ON o.sample = s.sample AND o.status = x.status GROUP BY 1, 2""",
)
def _(spark, sf):
    path, samples = scratch_dir(spark, "summary"), fx.samples(spark, sf)
    summary = overlap.assignment_summary(
        overlap.assigned_counts(fx.alignments(spark, sf), fx.exons(spark, sf), width=fx.BIN)
    )
    wide = expression.wide(summary, "n", samples, ("status",))
    wide = wide.withColumnsRenamed({"status": "Status", **bam_paths(samples)})
    text_tables.write_matrix_tsv(wide, path)
    return expression.rename_by_sample(reports.read_count_summary(spark, path), samples)


@query(
    "trim_report_json",
    "S10",
    """SELECT b.sample, b.n_reads AS before_total_reads, b.bases AS before_total_bases, b.q20_bases AS before_q20_bases,
    b.q30_bases AS before_q30_bases, round(b.gc_bases::DOUBLE / b.bases::DOUBLE, 6) AS before_gc_content,
    a.n_reads AS after_total_reads, a.bases AS after_total_bases, a.q20_bases AS after_q20_bases,
    a.q30_bases AS after_q30_bases, round(a.gc_bases::DOUBLE / a.bases::DOUBLE, 6) AS after_gc_content,
    c.passed AS passed_filter_reads, c.low_quality AS low_quality_reads, c.many_n AS "too_many_N_reads", c.short AS too_short_reads
    FROM totals b JOIN totals a ON a.sample = b.sample AND a.stage = 'trimmed' AND b.stage = 'raw'
    JOIN (SELECT sample, count(*) FILTER (reason = 'passed') AS passed, count(*) FILTER (reason = 'low_quality') AS low_quality,
      count(*) FILTER (reason = 'too_many_N') AS many_n, count(*) FILTER (reason = 'too_short') AS short
      FROM chain GROUP BY 1) c ON c.sample = b.sample""",
)
def _(spark, sf):
    path = scratch_dir(spark, "trim")
    workflow.trim_report(chain(spark, sf)).write.partitionBy("sample").json(path)
    return rounded(reports.read_trim_json(spark, path), "before_gc_content", "after_gc_content")


@query(
    "resolve_inputs",
    "S11",
    """SELECT sample, arg_min(path, priority) AS path, CASE WHEN min(priority) IS NULL THEN concat('not found: ', sample, '_1.fastq, ',
      sample, '_1.fastq.gz, ', sample, '.fastq, ', sample, '.fastq.gz, ', sample, '.sra.fastq, ', sample, '.sra.fastq.gz') END AS error
    FROM (SELECT l.sample, l.path, s.priority FROM listing l LEFT JOIN suffixes s ON l.path = concat(l.sample, s.suffix)) GROUP BY 1""",
)
def _(spark, sf):
    return manifest.resolve_inputs(fx.listing(spark, sf))


@query(
    "pending_accessions",
    "S12",
    """SELECT * FROM manifest WHERE sample NOT IN (SELECT sample FROM finished WHERE stage = 'raw' AND length > 0)""",
)
def _(spark, sf):
    done = fx.finished(spark, sf).where(F.col("stage") == "raw")
    return manifest.pending(fx.manifest(spark, sf), done)


@query("too_small_files", "S13", "SELECT * FROM listing WHERE length < 1000")
def _(spark, sf):
    return manifest.too_small(fx.listing(spark, sf), 1000)


@query("size_gate", "S13", "SELECT *, length >= 1000 AS passed FROM listing")
def _(spark, sf):
    return manifest.size_verdicts(fx.listing(spark, sf), 1000)


@query(
    "size_report",
    "S14",
    """SELECT sample, count(*) AS n_files, CAST(sum(length) AS BIGINT) AS bytes FROM listing GROUP BY ROLLUP (sample)""",
)
def _(spark, sf):
    return manifest.size_report(fx.listing(spark, sf))


@query(
    "matrix_shape",
    "S17",
    "SELECT count(DISTINCT gene_id) AS n_genes, CAST(3 AS BIGINT) AS n_samples, 'A,N,R' AS sample_columns FROM counts",
)
def _(spark, sf):
    return expression.shape_report(expression.counts_only(fx.counts(spark, sf), fx.samples(spark, sf)))


# --- projections, filters ---------------------------------------------------------


@query("contig_features", "P1", "SELECT * FROM features WHERE chrom = 'chr1'")
def _(spark, sf):
    return features.filter_contig(fx.features(spark, sf), "chr1")


@query("contig_lines", "P1", "SELECT chrom, count(*) AS n FROM features WHERE chrom = 'chr1' GROUP BY 1 UNION ALL SELECT '#!c', 1")
def _(spark, sf):
    lines = fx.gtf_lines(spark, sf).unionByName(spark.range(1).select(F.lit("#!c").alias("value")))
    kept = features.filter_contig_lines(lines, "chr1")
    return kept.groupBy(F.substring_index("value", "\t", 1).alias("chrom")).agg(F.count("*").alias("n"))


@query("contig_sequence", "P2", "SELECT * FROM contigs WHERE chrom = 'chr1'")
def _(spark, sf):
    headed = fx.contigs(spark, sf).withColumn("chrom", F.concat(F.lit(">"), "chrom", F.lit(" 1 REF")))
    named = headed.withColumn("chrom", features.contig_name("chrom"))
    return features.filter_contig(named, "chr1")


@query("exon_features", "P3", "SELECT * FROM features WHERE feature = 'exon'")
def _(spark, sf):
    return features.feature_type(fx.features(spark, sf))


@query("gene_id_attribute", "P4", "SELECT gene_id, feature, count(*) AS n FROM features GROUP BY 1, 2")
def _(spark, sf):
    text = F.element_at(F.split("value", "\t"), 9)
    kind = F.element_at(F.split("value", "\t"), 3)
    rows = fx.gtf_lines(spark, sf).select(kind.alias("feature"), features.parse_attributes(text).alias("attributes"))
    return features.attribute(rows, "gene_id").groupBy("gene_id", "feature").agg(F.count("*").alias("n"))


@query("mapq_filter", "P5", "SELECT * FROM alignments WHERE mapq >= 10")
def _(spark, sf):
    return align.mapq_filter(fx.alignments(spark, sf))


@query(
    "flag_bits",
    "P6",
    """SELECT sample, read_id, flag, flag & 4 <> 0 AS is_unmapped, flag & 16 <> 0 AS is_reverse, flag & 256 <> 0 AS is_secondary,
    flag & 512 <> 0 AS is_qcfail, flag & 1024 <> 0 AS is_duplicate, flag & 2048 <> 0 AS is_supplementary FROM alignments""",
)
def _(spark, sf):
    return align.flag_bits(fx.alignments(spark, sf).select("sample", "read_id", "flag"))


@query("numeric_cells", "P7", "SELECT event_id AS id, CASE WHEN event_id % 10 = 0 THEN 0.0::DOUBLE ELSE value END AS cell FROM events")
def _(spark, sf):
    return expression.coerce_numeric(fx.text_cells(spark, sf), ["cell"])


@query("sample_names", "P8", 'SELECT gene_id, sample, length, "count" FROM counts')
def _(spark, sf):
    return expression.rename_by_sample(fx.long_counts(spark, sf), fx.samples(spark, sf))


@query(
    "sample_columns",
    "P8",
    """SELECT gene_id AS Geneid, length AS Length, coalesce(max("count") FILTER (sample = 'A'), 0) AS A,
    coalesce(max("count") FILTER (sample = 'N'), 0) AS N, coalesce(max("count") FILTER (sample = 'R'), 0) AS R FROM counts GROUP BY 1, 2""",
)
def _(spark, sf):
    samples = fx.samples(spark, sf)
    wide = expression.counts_only(fx.counts(spark, sf), samples)
    return expression.rename_columns_by_sample(wide.withColumnsRenamed(bam_paths(samples)), samples)


@query("selected_samples", "P9", "SELECT * FROM counts WHERE sample IN ('N', 'R')")
def _(spark, sf):
    return expression.select_samples(fx.counts(spark, sf), ["N", "R", "absent"])


@query(
    "required_columns",
    "P10",
    """SELECT gene_id AS Geneid, length AS Length, coalesce(max("count") FILTER (sample = 'A'), 0) AS A,
    coalesce(max("count") FILTER (sample = 'N'), 0) AS N, coalesce(max("count") FILTER (sample = 'R'), 0) AS R FROM counts GROUP BY 1, 2""",
)
def _(spark, sf):
    wide = expression.counts_only(fx.counts(spark, sf), fx.samples(spark, sf))
    return expression.require_columns(wide, ["Geneid", "Length"])


@query(
    "matrix_without_metadata",
    "P11",
    """SELECT gene_id, coalesce(max("count") FILTER (sample = 'A'), 0) AS A,
    coalesce(max("count") FILTER (sample = 'N'), 0) AS N, coalesce(max("count") FILTER (sample = 'R'), 0) AS R
    FROM counts GROUP BY gene_id, length""",
)
def _(spark, sf):
    return expression.drop_metadata(expression.counts_only(fx.counts(spark, sf), fx.samples(spark, sf)))


@query(
    "matching_lines",
    "P12",
    "SELECT event_id AS id, concat(event_type, ' | ', user_id) AS line FROM events WHERE event_type IN ('click', 'error')",
)
def _(spark, sf):
    return features.grep_lines(fx.log_lines(spark, sf), "click|error", "line")


# --- trimming ---------------------------------------------------------------------


@query(
    "phred_scores",
    "T1",
    "SELECT read_id, array_to_string([ascii(c) - 33 for c in string_split(qual, '')], ',') AS scores FROM reads",
)
def _(spark, sf):
    scores = F.transform(phred("qual"), lambda q: q.cast("string"))
    return fx.reads(spark, sf).select("read_id", F.array_join(scores, ",").alias("scores"))


@query("cut_right", "T2", "SELECT read_id, sample, seq, qual FROM cut")
def _(spark, sf):
    return trim.cut_right(fx.reads(spark, sf))


@query(
    "poly_g_trimmed",
    "T3",
    """SELECT read_id, sample, regexp_replace(seq, 'G{10,}$', '') AS seq,
    substr(qual, 1, length(regexp_replace(seq, 'G{10,}$', ''))) AS qual FROM reads""",
)
def _(spark, sf):
    return trim.trim_poly_g(fx.reads(spark, sf))


@query(
    "adapter_trimmed",
    "T4",
    """SELECT read_id, sample, substr(seq, 1, keep) AS seq, substr(qual, 1, keep) AS qual FROM (
      SELECT *, CASE WHEN instr(seq, 'AGATCGGAAGAG') > 0 THEN instr(seq, 'AGATCGGAAGAG') - 1 ELSE length(seq) END AS keep FROM reads)""",
)
def _(spark, sf):
    return trim.trim_adapter(fx.reads(spark, sf))


@query(
    "low_quality_filtered",
    "T5",
    """SELECT * FROM reads WHERE NOT (length(qual) - length(regexp_replace(qual, '[!-4]', '', 'g'))) * 100 > 30 * length(qual)""",
)
def _(spark, sf):
    return trim.low_quality_filter(fx.reads(spark, sf))


@query("n_filtered", "T6", "SELECT * FROM reads WHERE length(seq) - length(replace(seq, 'N', '')) <= 5")
def _(spark, sf):
    return trim.n_filter(fx.reads(spark, sf))


@query("length_filtered", "T7", "SELECT * FROM reads WHERE length(seq) >= 36")
def _(spark, sf):
    return trim.length_filter(fx.reads(spark, sf))


@query(
    "filter_reasons",
    "T8",
    """SELECT s.sample, r.reason, count(c.read_id) AS n_reads FROM (SELECT DISTINCT sample FROM reads) s
    CROSS JOIN (SELECT unnest(['passed', 'too_many_N', 'low_quality', 'too_short']) AS reason) r
    LEFT JOIN chain c ON c.sample = s.sample AND c.reason = r.reason GROUP BY 1, 2""",
)
def _(spark, sf):
    return trim.filter_reasons(chain(spark, sf))


@query("trimmed_reads", "T2 T3 T4 T5 T6 T7", "SELECT read_id, sample, seq, qual FROM chain WHERE reason = 'passed'")
def _(spark, sf):
    return trim.trimmed_reads(chain(spark, sf))


@query("before_after", "T9", "SELECT *, round(bases::DOUBLE / n_reads::DOUBLE, 6) AS mean_length FROM totals")
def _(spark, sf):
    return rounded(trim.before_after(chain(spark, sf)), "mean_length")


@query(
    "overrepresented_kmers",
    "T10",
    """SELECT sample, kmer, n, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY sample ORDER BY n DESC, kmer) AS rank FROM (
        SELECT sample, substr(seq, i, 20) AS kmer, count(*) AS n FROM (
          SELECT sample, seq, unnest(range(1, length(seq) - 18)) AS i FROM reads) GROUP BY 1, 2)) WHERE rank <= 20""",
)
def _(spark, sf):
    return trim.overrepresented_kmers(fx.reads(spark, sf))


@query(
    "detected_adapter",
    "T11",
    """SELECT sample, arg_max(name, n * 10 - i) AS name, arg_max(probe, n * 10 - i) AS adapter, max(n) AS n_reads FROM (
      SELECT sample, i, name, probe, count(*) AS n FROM reads JOIN adapters ON contains(seq, probe) GROUP BY 1, 2, 3, 4) GROUP BY 1""",
)
def _(spark, sf):
    return trim.detect_adapter(fx.reads(spark, sf), reads_qc.ADAPTERS)


@query(
    "detected_adapter_trimmed",
    "T4 T11",
    """SELECT r.read_id, r.sample, substr(seq, 1, CASE WHEN instr(seq, probe) > 0 THEN instr(seq, probe) - 1 ELSE length(seq) END) AS seq,
    substr(qual, 1, CASE WHEN instr(seq, probe) > 0 THEN instr(seq, probe) - 1 ELSE length(seq) END) AS qual FROM reads r
    JOIN (SELECT sample, arg_max(probe, n * 10 - i) AS probe FROM (
      SELECT sample, i, probe, count(*) AS n FROM reads JOIN adapters ON contains(seq, probe) GROUP BY 1, 2, 3) GROUP BY 1) a USING (sample)""",
)
def _(spark, sf):
    r = fx.reads(spark, sf)
    return trim.trim_detected_adapter(r, trim.detect_adapter(r, reads_qc.ADAPTERS))


@query(
    "adapter_or_part_trimmed",
    "T4",
    """SELECT read_id, sample, substr(seq, 1, keep) AS seq, substr(qual, 1, keep) AS qual FROM (
      SELECT *, coalesce(list_min([p for p in range(1, length(seq) - 4) if hamming(
          substr(seq, p, least(33, length(seq) - p + 1)),
          substr('AGATCGGAAGAGCACACGTCTGAACTCCAGTCA', 1, least(33, length(seq) - p + 1))) <= least(33, length(seq) - p + 1) // 8]) - 1,
        length(seq)) AS keep FROM reads)""",
)
def _(spark, sf):
    return trim.trim_adapter_or_part(fx.reads(spark, sf), fx.ADAPTER, min_overlap=6, bases_for_one=8)


@query(
    "found_adapters",
    "T11",
    """SELECT sample, concat(reverse(before_path), seed, after_path) AS adapter, n AS n_reads FROM (
    WITH k AS (
      SELECT sample, substr(seq, p, 10) AS kmer, CASE WHEN p > 3 THEN substr(seq, p - 3, 3) END AS before, count(*) AS n FROM (
        SELECT sample, seq, unnest(range(1, length(seq) - 8)) AS p FROM reads) GROUP BY ALL
    ), top AS (
      SELECT sample, kmer FROM (SELECT sample, kmer, sum(n) AS n FROM k WHERE regexp_full_match(kmer, '[ACGT]{10}')
        AND len(list_distinct([substr(kmer, i, 2) for i in range(1, 10)])) >= 4
        AND list_max([length(kmer) - length(replace(kmer, c, '')) for c in ['A', 'C', 'G', 'T']]) <= 6 GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY sample ORDER BY n DESC, kmer) <= 256
    ), seed AS (
      SELECT sample, kmer AS seed FROM (
        SELECT sample, kmer, sum(n) - max(n) AS n FROM k JOIN top USING (sample, kmer) WHERE regexp_full_match(before, '[ACGT]{3}') GROUP BY ALL)
      WHERE n > 0 QUALIFY row_number() OVER (PARTITION BY sample ORDER BY n DESC, kmer) = 1
    ), hit AS (SELECT sample, seed, seq, instr(seq, seed) AS place FROM reads JOIN seed USING (sample) WHERE contains(seq, seed)),
    side AS (
      SELECT sample, 'after' AS side, substr(seq, place + 10, 40) AS t FROM hit
      UNION ALL SELECT sample, 'before', reverse(substr(seq, greatest(place - 40, 1), least(place - 1, 40))) FROM hit
    ), found AS (
      SELECT sample, seed, n FROM (SELECT sample, seed, count(*) AS n FROM hit GROUP BY ALL)
      JOIN (SELECT sample, count(*) AS every FROM reads GROUP BY 1) USING (sample) WHERE n >= 20 AND n * 100 >= every
    ),
    edge AS (
      SELECT *, sum(n) OVER (PARTITION BY sample, side, substr(path, 1, length(path) - 1)) AS total FROM (
        SELECT sample, side, path, count(*) AS n
        FROM (SELECT sample, side, substr(t, 1, unnest(range(1, length(t) + 1))) AS path FROM side) GROUP BY ALL)
    ), kept AS (
      SELECT e.* FROM edge e JOIN found f USING (sample) WHERE e.total >= f.n * 5 / 100 AND e.n >= 0.8::DOUBLE * e.total
    ), chain_of AS (
      SELECT sample, side, arg_max(path, length(path)) AS path FROM kept a
      WHERE (SELECT count(*) FROM kept b WHERE b.sample = a.sample AND b.side = a.side AND starts_with(a.path, b.path)) = length(path)
      GROUP BY ALL
    )
    SELECT f.*, coalesce((SELECT any_value(path) FROM chain_of c WHERE c.sample = f.sample AND side = 'before'), '') AS before_path,
      coalesce((SELECT any_value(path) FROM chain_of c WHERE c.sample = f.sample AND side = 'after'), '') AS after_path
    FROM found f) WHERE length(before_path) + length(after_path) >= 6""",
)
def _(spark, sf):
    return discovery.found_adapters(fx.reads(spark, sf))


# --- read QC ----------------------------------------------------------------------


@query(
    "basic_stats",
    "Q1",
    """SELECT sample, total_sequences, total_bases, (total_bases // 100000) / 10.0::DOUBLE AS total_mbp, min_len, max_len, pct_gc
    FROM basic WHERE stage = 'raw'""",
)
def _(spark, sf):
    return reads_qc.basic_stats(fx.reads(spark, sf))


@query(
    "per_base_quality",
    "Q2",
    "SELECT sample, pos, round(mean, 6) AS mean, median, q1, q3, p10, p90 FROM base_quality WHERE stage = 'raw'",
)
def _(spark, sf):
    return rounded(reads_qc.per_base_quality(fx.reads(spark, sf)), "mean")


@query(
    "per_sequence_quality",
    "Q3",
    """SELECT d.sample, CAST(d.q AS INTEGER) AS quality, coalesce(r.n, 0) AS n_reads FROM (
      SELECT sample, unnest(range(min(q), max(q) + 1)) AS q FROM read_quality WHERE stage = 'raw' GROUP BY 1) d
    LEFT JOIN read_quality r ON r.sample = d.sample AND r.stage = 'raw' AND r.q = d.q""",
)
def _(spark, sf):
    return reads_qc.per_sequence_quality(fx.reads(spark, sf))


@query(
    "per_base_content",
    "Q4",
    """SELECT sample, pos, round(pct_g, 6) AS pct_g, round(pct_a, 6) AS pct_a, round(pct_t, 6) AS pct_t, round(pct_c, 6) AS pct_c
    FROM base_content WHERE stage = 'raw'""",
)
def _(spark, sf):
    return rounded(reads_qc.per_base_content(fx.reads(spark, sf)), "pct_g", "pct_a", "pct_t", "pct_c")


@query("per_sequence_gc", "Q5", "SELECT sample, gc, n_reads FROM gc_hist WHERE stage = 'raw'")
def _(spark, sf):
    return reads_qc.per_sequence_gc(fx.reads(spark, sf))


@query(
    "per_sequence_gc_spread",
    "Q5",
    """SELECT s.sample, CAST(b.gc AS INTEGER) AS gc, round(coalesce(h.n_reads, 0)::DOUBLE, 6) AS n_reads
    FROM (SELECT DISTINCT sample FROM gc_reads WHERE stage = 'raw') s CROSS JOIN (SELECT unnest(range(0, 101)) AS gc) b
    LEFT JOIN (
      SELECT r.sample, k.gc, sum(1.0::DOUBLE / k.claims) AS n_reads FROM gc_reads r
      JOIN (SELECT n, g, gc, count(*) OVER (PARTITION BY n, gc) AS claims FROM (
        SELECT n, g, unnest(range((greatest(2 * g - 1, 0) * 100 + n) // (2 * n), (least(2 * g + 1, 2 * n) * 100 + n) // (2 * n) + 1)) AS gc
        FROM (SELECT n, unnest(range(0, n + 1)) AS g FROM (SELECT DISTINCT n FROM gc_reads WHERE stage = 'raw')))) k
      ON k.n = r.n AND k.g = r.g WHERE r.stage = 'raw' GROUP BY 1, 2) h ON h.sample = s.sample AND h.gc = b.gc""",
)
def _(spark, sf):
    return rounded(reads_qc.per_sequence_gc(fx.reads(spark, sf), spread=True), "n_reads")


@query("per_base_n", "Q6", "SELECT sample, pos, round(pct_n, 6) AS pct_n FROM base_n WHERE stage = 'raw'")
def _(spark, sf):
    return rounded(reads_qc.per_base_n(fx.reads(spark, sf)), "pct_n")


@query("length_distribution", "Q7", "SELECT sample, CAST(length(seq) AS INTEGER) AS length, count(*) AS n_reads FROM reads GROUP BY 1, 2")
def _(spark, sf):
    return reads_qc.length_distribution(fx.reads(spark, sf))


@query(
    "duplication_levels",
    "Q8",
    """SELECT t.sample, b.level, round(100.0::DOUBLE * coalesce(sum(c.copies), 0)::DOUBLE / max(t.total)::DOUBLE, 6) AS pct_of_total,
      round(100.0::DOUBLE * max(t.uniq)::DOUBLE / max(t.total)::DOUBLE, 6) AS dedup_pct
    FROM (SELECT sample, sum(copies) AS total, count(*) AS uniq FROM copies WHERE stage = 'raw' GROUP BY 1) t
    CROSS JOIN (VALUES ('1', 1, 1), ('2', 2, 2), ('3', 3, 3), ('4', 4, 4), ('5', 5, 5), ('6', 6, 6), ('7', 7, 7), ('8', 8, 8),
      ('9', 9, 9), ('>10', 10, 50), ('>50', 51, 100), ('>100', 101, 500), ('>500', 501, 1000), ('>1k', 1001, 5000),
      ('>5k', 5001, 10000), ('>10k+', 10001, 9000000000000)) AS b(level, lo, hi)
    LEFT JOIN copies c ON c.sample = t.sample AND c.stage = 'raw' AND c.copies BETWEEN b.lo AND b.hi GROUP BY 1, 2""",
)
def _(spark, sf):
    return rounded(reads_qc.duplication_levels(fx.reads(spark, sf)), "pct_of_total", "dedup_pct")


@query(
    "overrepresented_sequences",
    "Q9",
    """SELECT c.sample, seq_key AS sequence, copies AS n_reads, round(100.0::DOUBLE * copies::DOUBLE / total::DOUBLE, 6) AS pct,
      coalesce((SELECT arg_min(name, i) FROM adapters WHERE contains(seq_key, probe) OR contains(probe, seq_key)), 'No Hit') AS possible_source
    FROM copies c JOIN (SELECT sample, count(*) AS total FROM reads GROUP BY 1) t USING (sample)
    WHERE stage = 'raw' AND 100.0::DOUBLE * copies::DOUBLE / total::DOUBLE > 0.1""",
)
def _(spark, sf):
    return rounded(reads_qc.overrepresented(fx.reads(spark, sf)), "pct")


@query(
    "overrepresented_sources",
    "Q9",
    """SELECT sample, sequence, n_reads, round(pct, 6) AS pct, coalesce(hit.name, 'No Hit') AS possible_source,
    CAST(coalesce(hit.size - hit.off, 0) AS INTEGER) AS matched, CAST(coalesce(hit.size, 0) AS INTEGER) AS length FROM (
    WITH probes AS (
      SELECT i, name, probe FROM adapters
      UNION ALL VALUES (6, 'TruSeq Adapter, Read 1', 'AGATCGGAAGAGCACACGTCTGAACTCCAGTCA'),
        (7, 'TruSeq Adapter, Read 2', 'AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT'),
        (8, 'Nextera Transposase Adapter', 'CTGTCTCTTATACACATCTCCGAGCCCACGAGAC')
    ), found AS (
      SELECT sample, seq_key AS sequence, copies AS n_reads, 100.0::DOUBLE * copies::DOUBLE / total::DOUBLE AS pct
      FROM copies JOIN (SELECT sample, count(*) AS total FROM reads GROUP BY 1) USING (sample)
      WHERE stage = 'raw' AND 100.0::DOUBLE * copies::DOUBLE / total::DOUBLE > 0.1
    ), spans AS (
      SELECT DISTINCT sequence, i, name, probe, greatest(0, shift) AS b, least(length(sequence), shift + length(probe)) AS e, shift
      FROM (SELECT DISTINCT sequence FROM found), probes, range(-40, 60) AS r(shift) WHERE length(sequence) >= 20 AND length(probe) >= 20
    ), edges AS (
      SELECT *, list_concat([b - 1], [x for x in range(b, e) if substr(sequence, x + 1, 1) <> substr(probe, x - shift + 1, 1)], [e]) AS m
      FROM spans WHERE e - b >= 20
    ), sizes AS (
      SELECT sequence, i, name, list_max([m[x + 1] - m[x] - 1 for x in range(1, len(m))]) AS plain,
        coalesce(list_max([m[x + 1] - m[x - 1] - 1 for x in range(2, len(m))]), 0) AS one FROM edges
    ), hits AS (
      SELECT sequence, {'size': one, 'off': 1, 'i': i, 'name': name} AS hit FROM sizes WHERE one >= 20 AND one > plain
      UNION ALL SELECT sequence, {'size': plain, 'off': 0, 'i': i, 'name': name} FROM sizes WHERE plain >= 20 AND plain >= one
      UNION ALL SELECT sequence, {'size': least(length(sequence), length(probe)), 'off': 0, 'i': i, 'name': name}
      FROM (SELECT DISTINCT sequence FROM found), probes WHERE least(length(sequence), length(probe)) BETWEEN 1 AND 19
        AND (contains(sequence, probe) OR contains(probe, sequence))
    ), ranked AS (SELECT *, row_number() OVER (PARTITION BY sequence ORDER BY hit.size DESC, hit.off, hit.i) AS k FROM hits)
    SELECT f.*, r.hit FROM found f LEFT JOIN ranked r ON r.sequence = f.sequence AND k = 1)""",
)
def _(spark, sf):
    return rounded(reads_qc.overrepresented_sources(fx.reads(spark, sf)), "pct")


@query(
    "adapter_content",
    "Q10",
    "SELECT sample, CAST(pos AS INTEGER) AS pos, "
    + ", ".join(
        f"round(max(pct) FILTER (col = '{c}'), 6) AS {c}" for c in map(reads_qc.column_name, reads_qc.ADAPTERS)
    )
    + " FROM adapter_cells WHERE stage = 'raw' GROUP BY 1, 2",
)
def _(spark, sf):
    names = [reads_qc.column_name(a) for a in reads_qc.ADAPTERS]
    return rounded(reads_qc.adapter_content(fx.reads(spark, sf)), *names)


@query("qc_measures", "Q1-Q10 R3", "SELECT sample, stage, measure, round(value, 6) AS value FROM measures")
def _(spark, sf):
    return rounded(reads_qc.qc_measures(staged(spark, sf), STAGED), "value")


@query("qc_verdicts", "Q11", "SELECT sample, stage, module, status FROM qc_status")
def _(spark, sf):
    return reads_qc.verdicts(reads_qc.qc_measures(staged(spark, sf), STAGED), STAGED)


@query(
    "qc_compare",
    "Q12",
    """SELECT sample, measure AS metric, round(max(value) FILTER (stage = 'raw'), 6) AS before,
    round(max(value) FILTER (stage = 'trimmed'), 6) AS after,
    round(max(value) FILTER (stage = 'trimmed') - max(value) FILTER (stage = 'raw'), 6) AS delta FROM measures GROUP BY 1, 2""",
)
def _(spark, sf):
    measures = reads_qc.qc_measures(staged(spark, sf), STAGED).withColumnRenamed("measure", "metric")
    return rounded(reads_qc.qc_compare(measures), "before", "after", "delta")


# --- alignments -------------------------------------------------------------------


@query(
    "cigar_runs",
    "A1",
    """SELECT sample, op, CAST(len AS INTEGER) AS len, count(*) AS n FROM alignments JOIN cigar_runs USING (cigar) GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    rows = align.with_cigar_ops(fx.alignments(spark, sf)).select("sample", F.inline("ops"))
    return rows.groupBy("sample", "op", "len").agg(F.count("*").alias("n"))


@query(
    "ref_end",
    "A2",
    "SELECT sample, read_id, chrom, pos, cigar, CAST(pos + ref_len - 1 AS BIGINT) AS ref_end FROM alignments JOIN cigar_sizes USING (cigar)",
)
def _(spark, sf):
    rows = fx.alignments(spark, sf).select("sample", "read_id", "chrom", "pos", "cigar")
    return align.with_ref_end(rows)


@query(
    "aligned_blocks",
    "A3",
    "SELECT sample, read_id, chrom, pos + o1 AS b_start, pos + o2 AS b_end, matched FROM mapped JOIN cigar_blocks USING (cigar)",
)
def _(spark, sf):
    rows = align.aligned_blocks(fx.alignments(spark, sf))
    return rows.select("sample", "read_id", "chrom", "b_start", "b_end", "matched")


@query(
    "junctions",
    "A4",
    """SELECT sample, chrom, pos + i1 AS i_start, pos + i2 AS i_end, count(*) FILTER (nh = 1) AS n_unique,
    count(*) FILTER (nh > 1) AS n_multi FROM mapped JOIN cigar_introns USING (cigar) GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    return align.junctions(fx.alignments(spark, sf))


@query(
    "intron_length_filter",
    "A5",
    "SELECT * FROM alignments WHERE cigar NOT IN (SELECT cigar FROM cigar_runs WHERE op = 'N' AND NOT len BETWEEN 20 AND 1000000)",
)
def _(spark, sf):
    return align.intron_length_filter(fx.alignments(spark, sf))


@query(
    "junction_overhangs",
    "A6",
    """SELECT p.*, a.chrom IS NOT NULL AS annotated, overhang >= CASE WHEN a.chrom IS NULL THEN 8 ELSE 1 END AS enough
    FROM placed_introns p LEFT JOIN annotated a ON a.chrom = p.chrom AND a.i_start = p.i_start AND a.i_end = p.i_end""",
)
def _(spark, sf):
    known = align.annotated_junctions(fx.exons(spark, sf), "gene_id")
    return align.junction_overhangs(fx.alignments(spark, sf), known)


@query("annotated_junctions", "A6", "SELECT * FROM annotated")
def _(spark, sf):
    return align.annotated_junctions(fx.exons(spark, sf), "gene_id")


OVERHANG_SQL = """SELECT m.* FROM alignments m WHERE flag & 4 <> 0 OR NOT EXISTS (
    SELECT 1 FROM placed_introns p LEFT JOIN annotated a ON a.chrom = p.chrom AND a.i_start = p.i_start AND a.i_end = p.i_end
    WHERE p.chrom = m.chrom AND p.pos = m.pos AND p.cigar = m.cigar AND overhang < CASE WHEN a.chrom IS NULL THEN {0} ELSE 1 END)"""


@query("overhang_filter", "A6", OVERHANG_SQL.format(8))
def _(spark, sf):
    known = align.annotated_junctions(fx.exons(spark, sf), "gene_id")
    return align.overhang_filter(fx.alignments(spark, sf), known)


@query("overhang_filter_long", "A6", OVERHANG_SQL.format(12))
def _(spark, sf):
    known = align.annotated_junctions(fx.exons(spark, sf), "gene_id")
    return align.overhang_filter(fx.alignments(spark, sf), known, novel=12)


@query(
    "multimap_cap",
    "A7",
    """SELECT * EXCLUDE (over) REPLACE (CASE WHEN over THEN flag | 4 ELSE flag END AS flag, CASE WHEN NOT over THEN chrom END AS chrom,
      CASE WHEN NOT over THEN pos END AS pos, CASE WHEN over THEN '*' ELSE cigar END AS cigar,
      CASE WHEN over THEN 0 ELSE mapq END AS mapq)
    FROM (SELECT *, coalesce(nh > 20, false) AND flag & 4 = 0 AS over FROM alignments)""",
)
def _(spark, sf):
    return align.multimap_cap(fx.alignments(spark, sf))


@query(
    "mismatch_filter",
    "A8",
    "SELECT a.* FROM alignments a JOIN cigar_sizes USING (cigar) WHERE nm IS NULL OR nm <= 999 AND nm * 100 <= query_len * 4",
)
def _(spark, sf):
    return align.mismatch_filter(fx.alignments(spark, sf))


@query(
    "exact_mismatch_filter",
    "A8",
    """SELECT m.* FROM alignments_md m JOIN cigar_sizes USING (cigar)
    WHERE coalesce(length(regexp_replace(md, '\\^[A-Z]+|[0-9]+', '', 'g')), nm, 0) * 100 <= 4 * query_len""",
)
def _(spark, sf):
    return align.exact_mismatch_filter(fx.alignments_md(spark, sf))


@query(
    "mismatch_sites",
    "A8",
    """SELECT sample, chrom, CAST(pos + o1 + off - before AS BIGINT) AS ref_pos, base, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT sample, chrom, pos, cigar, md, count(*) AS n FROM alignments_md WHERE flag & 4 = 0 GROUP BY ALL) a
    JOIN md_sites USING (md)
    JOIN block_offsets b ON b.cigar = a.cigar AND off >= before AND off <= before + o2 - o1 GROUP BY ALL""",
)
def _(spark, sf):
    return align.mismatch_sites(fx.alignments_md(spark, sf))


@query(
    "noncanonical_filter",
    "A9",
    """SELECT m.* FROM alignments m WHERE flag & 4 <> 0 OR NOT EXISTS (SELECT 1 FROM placed_introns p
      LEFT JOIN intron_strands s ON s.chrom = p.chrom AND s.i_start = p.i_start AND s.i_end = p.i_end AND s.strand IS NOT NULL
      WHERE p.chrom = m.chrom AND p.pos = m.pos AND p.cigar = m.cigar AND s.strand IS NULL)""",
)
def _(spark, sf):
    return align.noncanonical_filter(fx.alignments(spark, sf), fx.contigs(spark, sf), fx.CONTIG_CHUNK)


@query(
    "strand_from_intron",
    "A10",
    """SELECT chrom, pos, cigar, count(*) AS n_junctions,
      coalesce(CASE WHEN min(strand) = max(strand) THEN min(strand) END, '.') AS strand FROM intron_strands GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    return align.strand_from_intron(fx.alignments(spark, sf), fx.contigs(spark, sf), fx.CONTIG_CHUNK)


@query(
    "coordinate_sort",
    "A11",
    """SELECT a.*, CAST(CASE WHEN chrom = 'chrM' THEN 5 ELSE CAST(substr(chrom, 4) AS INTEGER) END AS BIGINT) AS ordinal FROM alignments a""",
)
def _(spark, sf):
    return align.coordinate_sort(fx.alignments(spark, sf), fx.dictionary(spark, sf))


@query(
    "flagstat",
    "A12",
    """SELECT sample, metric, passed, failed, round(100.0::DOUBLE * passed::DOUBLE / rows_passed::DOUBLE, 6) AS passed_pct FROM flag_counts""",
)
def _(spark, sf):
    return rounded(align.flagstat(fx.alignments(spark, sf)), "passed_pct")


@query("idxstats", "A13", "SELECT sample, chrom, CAST(length AS BIGINT) AS length, mapped, unmapped FROM contig_counts")
def _(spark, sf):
    return align.idxstats(fx.alignments(spark, sf), fx.dictionary(spark, sf))


@query(
    "chrm_fraction",
    "A14",
    """SELECT sample, chrm_reads, mapped, round(100.0::DOUBLE * chrm_reads::DOUBLE / mapped::DOUBLE, 1) AS chrm_pct,
      round(100.0::DOUBLE * chrm_reads::DOUBLE / mapped::DOUBLE, 1) > 20.0 AS warn FROM (
      SELECT sample, count(*) FILTER (chrom = 'chrM') AS chrm_reads, count(*) AS mapped FROM mapped GROUP BY 1)""",
)
def _(spark, sf):
    return align.chrm_fraction(fx.alignments(spark, sf))


RATES_SQL = """SELECT sample, n_reads, n_unique, n_multi, n_unmapped, round(100.0::DOUBLE * n_unique::DOUBLE / n_reads::DOUBLE, 6) AS pct_unique,
    round(100.0::DOUBLE * n_multi::DOUBLE / n_reads::DOUBLE, 6) AS pct_multi,
    round(100.0::DOUBLE * n_unmapped::DOUBLE / n_reads::DOUBLE, 6) AS pct_unmapped FROM rates"""


@query("alignment_rates", "A15", RATES_SQL)
def _(spark, sf):
    rates = align.alignment_rates(fx.input_reads(spark, sf), fx.alignments(spark, sf))
    return rounded(rates, "pct_unique", "pct_multi", "pct_unmapped")


@query(
    "gene_counts_by_strand",
    "A16",
    """SELECT g.gene_id, s.sample, count(*) FILTER (t.rule = 'unstranded') AS unstranded,
      count(*) FILTER (t.rule = 'forward') AS forward, count(*) FILTER (t.rule = 'reverse') AS reverse
    FROM (SELECT DISTINCT gene_id FROM exons UNION ALL
          SELECT unnest(['N_unmapped', 'N_multimapping', 'N_noFeature', 'N_ambiguous'])) g CROSS JOIN samples s
    LEFT JOIN star_targets t ON t.sample = s.sample AND coalesce(t.early, t.late) = g.gene_id GROUP BY 1, 2""",
)
def _(spark, sf):
    return overlap.gene_counts_by_strand(
        fx.input_reads(spark, sf), fx.alignments(spark, sf), fx.exons(spark, sf), fx.BIN
    )


# --- quantification ---------------------------------------------------------------


@query("overlap_join", "E1", "SELECT chrom, pos, cigar, strand, gene_id, gene_strand FROM pairs")
def _(spark, sf):
    placed = overlap.placements(fx.alignments(spark, sf))
    return overlap.overlap_join(placed, fx.exons(spark, sf), fx.BIN)


@query(
    "assigned_reads",
    "E2",
    """SELECT m.sample, m.read_id, m.chrom, m.pos, m.cigar, m.strand, coalesce(g.n_genes, 0) AS n_genes,
      CASE WHEN g.n_genes = 1 THEN g.gene_id END AS gene_id,
      CASE WHEN g.n_genes = 1 THEN 'Assigned' WHEN g.n_genes > 1 THEN 'Unassigned_Ambiguity' ELSE 'Unassigned_NoFeatures' END AS status
    FROM mapped m LEFT JOIN placed_genes g USING (chrom, pos, cigar, strand)""",
)
def _(spark, sf):
    rows = overlap.assign_reads(fx.alignments(spark, sf), fx.exons(spark, sf), width=fx.BIN)
    return rows.select("sample", "read_id", "chrom", "pos", "cigar", "strand", "n_genes", "gene_id", "status")


@query(
    "assignment_summary",
    "E3",
    """SELECT s.sample, x.status, count(o.read_id) AS n FROM samples s CROSS JOIN (SELECT unnest(['Assigned', 'Unassigned_Unmapped',
      'Unassigned_MappingQuality', 'Unassigned_MultiMapping', 'Unassigned_NoFeatures', 'Unassigned_Ambiguity']) AS status) x
    LEFT JOIN outcomes o ON o.sample = s.sample AND o.status = x.status GROUP BY 1, 2""",
)
def _(spark, sf):
    return overlap.assignment_summary(
        overlap.assigned_counts(fx.alignments(spark, sf), fx.exons(spark, sf), width=fx.BIN)
    )


@query("gene_length", "E4", "SELECT gene_id, length FROM lengths")
def _(spark, sf):
    return overlap.gene_length(fx.exons(spark, sf), fx.BIN)


@query("assigned_count_matrix", "E5", 'SELECT gene_id, sample, "count", length FROM assigned_matrix')
def _(spark, sf):
    return workflow.quantify(fx.alignments(spark, sf), fx.exons(spark, sf), width=fx.BIN)


@query(
    "counts_only",
    "E6",
    """SELECT gene_id AS Geneid, length AS Length, coalesce(max("count") FILTER (sample = 'A'), 0) AS A,
    coalesce(max("count") FILTER (sample = 'N'), 0) AS N, coalesce(max("count") FILTER (sample = 'R'), 0) AS R FROM counts GROUP BY 1, 2""",
)
def _(spark, sf):
    return expression.counts_only(fx.counts(spark, sf), fx.samples(spark, sf))


@query(
    "unpivot_matrix",
    "E7",
    """SELECT g.gene_id AS Geneid, g.length AS Length, s.sample, coalesce(c."count", 0) AS "count"
    FROM (SELECT DISTINCT gene_id, length FROM counts) g CROSS JOIN (SELECT unnest(['A', 'N', 'R']) AS sample) s
    LEFT JOIN counts c ON c.gene_id = g.gene_id AND c.sample = s.sample""",
)
def _(spark, sf):
    samples = fx.samples(spark, sf)
    return expression.unpivot_matrix(expression.counts_only(fx.counts(spark, sf), samples), samples)


@query("library_size", "E8", "SELECT sample, library_size FROM sizes")
def _(spark, sf):
    return expression.library_size(fx.counts(spark, sf))


@query(
    "cpm",
    "E9",
    """SELECT gene_id, sample, length, "count", round(CAST("count" AS DOUBLE) / library_size::DOUBLE * 1000000, 6) AS cpm
    FROM counts JOIN sizes USING (sample)""",
)
def _(spark, sf):
    return rounded(expression.cpm(fx.counts(spark, sf)), "cpm")


@query("rpk", "E10", 'SELECT gene_id, sample, length, "count", round(rpk, 6) AS rpk FROM rpk')
def _(spark, sf):
    return rounded(expression.rpk(fx.counts(spark, sf)), "rpk")


@query(
    "tpm",
    "E11",
    'SELECT gene_id, sample, length, "count", round(rpk, 6) AS rpk, round(tpm, 6) AS tpm FROM tpm',
)
def _(spark, sf):
    return rounded(expression.tpm(fx.counts(spark, sf)), "rpk", "tpm")


@query("mean_tpm", "E12", "SELECT gene_id, length, round(mean_tpm, 6) AS mean_tpm FROM mean_tpm")
def _(spark, sf):
    return rounded(expression.mean_tpm(expression.tpm(fx.counts(spark, sf), with_samples=True)), "mean_tpm")


@query("tpm_top20", "E13", "SELECT gene_id, length, round(mean_tpm, 6) AS mean_tpm, rank FROM top_genes")
def _(spark, sf):
    return rounded(expression.top_genes(expression.tpm(fx.counts(spark, sf), with_samples=True)), "mean_tpm")


@query(
    "log2_matrix",
    "E14",
    "SELECT gene_id, round(log2(A + 1), 6) AS A, round(log2(N + 1), 6) AS N, round(log2(R + 1), 6) AS R FROM plotted",
)
def _(spark, sf):
    samples = fx.samples(spark, sf)
    return rounded(expression.log2_matrix(expression.tpm(fx.counts(spark, sf)), samples), *samples)


@query(
    "plot_table",
    "E15",
    """SELECT gene_id, length, round(mean_tpm, 6) AS mean_tpm, rank, round(A, 6) AS A, round(N, 6) AS N, round(R, 6) AS R FROM plotted""",
)
def _(spark, sf):
    samples = fx.samples(spark, sf)
    return rounded(expression.plot_table(expression.tpm(fx.counts(spark, sf)), samples), "mean_tpm", *samples)


WIDE_SQL = """SELECT gene_id AS Geneid, length AS Length, round(coalesce(max({0}) FILTER (sample = 'A'), 0), 6) AS A,
    round(coalesce(max({0}) FILTER (sample = 'N'), 0), 6) AS N, round(coalesce(max({0}) FILTER (sample = 'R'), 0), 6) AS R
    FROM {1} GROUP BY 1, 2"""


def written_table(spark, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a tab-separated table and read again."""
    path = scratch_dir(spark, name)
    text_tables.write_matrix_tsv(df, path)
    schema = ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes)
    return text_tables.read_matrix_tsv(spark, path, schema)


@query(
    "cpm_table",
    "E9 S15",
    WIDE_SQL.format("cpm", """(SELECT *, CAST("count" AS DOUBLE) / library_size::DOUBLE * 1000000 AS cpm
      FROM counts JOIN sizes USING (sample))"""),
)
def _(spark, sf):
    samples = fx.samples(spark, sf)
    wide = expression.wide_table(expression.cpm(fx.counts(spark, sf)), "cpm", samples)
    return written_table(spark, rounded(wide, *samples), "cpm")


@query("tpm_table", "E11 S15", WIDE_SQL.format("tpm", "tpm"))
def _(spark, sf):
    samples = fx.samples(spark, sf)
    wide = expression.wide_table(expression.tpm(fx.counts(spark, sf)), "tpm", samples)
    return written_table(spark, rounded(wide, *samples), "tpm")


@query(
    "top20_table",
    "E13 E15 S15",
    """SELECT gene_id AS Geneid, length AS Length, round(A, 6) AS A, round(N, 6) AS N, round(R, 6) AS R,
    round(mean_tpm, 6) AS "mean_TPM", rank FROM plotted""",
)
def _(spark, sf):
    samples = fx.samples(spark, sf)
    top = expression.top_table(expression.tpm(fx.counts(spark, sf)), samples)
    return written_table(spark, rounded(top, "mean_TPM", *samples), "top20")


@query(
    "expression_from_alignments",
    "E1-E5 E11-E13",
    """SELECT gene_id, length, round(sum(x) / 3, 6) AS mean_tpm,
      CAST(row_number() OVER (ORDER BY sum(x) / 3 DESC, gene_id) AS INTEGER) AS rank FROM (
      SELECT gene_id, length, r / (sum(r) OVER (PARTITION BY sample) / 1000000) AS x FROM (
        SELECT *, CAST("count" AS DOUBLE) / (CAST(length AS DOUBLE) / 1000.0::DOUBLE) AS r FROM assigned_matrix))
    GROUP BY 1, 2 ORDER BY sum(x) / 3 DESC, gene_id LIMIT 20""",
)
def _(spark, sf):
    matrix = workflow.quantify(fx.alignments(spark, sf), fx.exons(spark, sf), width=fx.BIN)
    return rounded(expression.top_genes(expression.tpm(matrix, with_samples=True)), "mean_tpm")


# --- reports ----------------------------------------------------------------------


@query(
    "general_stats",
    "R1",
    """SELECT coalesce(r.sample, a.sample, e.sample) AS sample, r.raw_reads, r.raw_bases, r.trimmed_reads, r.trimmed_bases,
      round(r.pass_pct, 6) AS pass_pct, round(a.pct_unique, 6) AS pct_unique, round(a.pct_multi, 6) AS pct_multi,
      round(a.pct_unmapped, 6) AS pct_unmapped, round(e.assigned_pct, 6) AS assigned_pct
    FROM (SELECT sample, max(n_reads) FILTER (stage = 'raw') AS raw_reads, max(bases) FILTER (stage = 'raw') AS raw_bases,
        max(n_reads) FILTER (stage = 'trimmed') AS trimmed_reads, max(bases) FILTER (stage = 'trimmed') AS trimmed_bases,
        100.0::DOUBLE * (max(n_reads) FILTER (stage = 'trimmed'))::DOUBLE / (max(n_reads) FILTER (stage = 'raw'))::DOUBLE AS pass_pct
      FROM totals GROUP BY 1) r
    FULL JOIN (SELECT sample, 100.0::DOUBLE * n_unique::DOUBLE / n_reads::DOUBLE AS pct_unique,
        100.0::DOUBLE * n_multi::DOUBLE / n_reads::DOUBLE AS pct_multi, 100.0::DOUBLE * n_unmapped::DOUBLE / n_reads::DOUBLE AS pct_unmapped
      FROM chain_rates) a ON a.sample = r.sample
    FULL JOIN (SELECT sample, 100.0::DOUBLE * (count(*) FILTER (status = 'Assigned'))::DOUBLE / count(*)::DOUBLE AS assigned_pct
      FROM chain_outcomes GROUP BY 1) e
      ON e.sample = coalesce(r.sample, a.sample)""",
)
def _(spark, sf):
    trimmed = workflow.materialise(chain(spark, sf), "chain")
    stats = workflow.general_stats(trimmed, fx.chain_alignments(trimmed), fx.exons(spark, sf), fx.BIN)
    return rounded(stats, "pass_pct", "pct_unique", "pct_multi", "pct_unmapped", "assigned_pct")


@query(
    "general_stats_of_reports",
    "R1 S8 S10",
    """SELECT r.sample, r.raw_reads, r.raw_bases, r.trimmed_reads, r.trimmed_bases, round(r.pass_pct, 6) AS pass_pct,
      floor(10000.0::DOUBLE * n_unique::DOUBLE / n_reads::DOUBLE) / 100 AS pct_unique,
      floor(10000.0::DOUBLE * n_multi::DOUBLE / n_reads::DOUBLE) / 100 AS pct_multi,
      floor(10000.0::DOUBLE * n_unmapped::DOUBLE / n_reads::DOUBLE) / 100 AS pct_unmapped, round(e.assigned_pct, 6) AS assigned_pct
    FROM (SELECT sample, max(n_reads) FILTER (stage = 'raw') AS raw_reads, max(bases) FILTER (stage = 'raw') AS raw_bases,
        max(n_reads) FILTER (stage = 'trimmed') AS trimmed_reads, max(bases) FILTER (stage = 'trimmed') AS trimmed_bases,
        100.0::DOUBLE * (max(n_reads) FILTER (stage = 'trimmed'))::DOUBLE / (max(n_reads) FILTER (stage = 'raw'))::DOUBLE AS pass_pct
      FROM totals GROUP BY 1) r
    LEFT JOIN chain_rates a ON a.sample = r.sample
    LEFT JOIN (SELECT sample, 100.0::DOUBLE * (count(*) FILTER (status = 'Assigned'))::DOUBLE / count(*)::DOUBLE AS assigned_pct
      FROM chain_outcomes GROUP BY 1) e ON e.sample = r.sample""",
)
def _(spark, sf):
    """Trimming reports, alignment logs and a counting summary, written, read and merged."""
    trimmed, root = chain(spark, sf), scratch_dir(spark, "merge")
    workflow.trim_report(trimmed).write.partitionBy("sample").json(f"{root}/trim")
    aligned = fx.chain_alignments(trimmed)
    rates = align.alignment_rates(trim.trimmed_reads(trimmed), aligned)
    # Labels of the log's lines.
    labels = {
        "Uniquely mapped reads %": "n_unique",
        "% of reads mapped to multiple loci": "n_multi",
        "% of reads unmapped: other": "n_unmapped",
    }

    def line(label: str, n: str):
        share = F.floor(10000.0 * F.col(n).cast("double") / F.col("n_reads").cast("double")) / 100
        return F.concat(F.lit(f"   {label} |\t"), share.cast("string"), F.lit("%"))

    lines = F.explode(F.array(*[line(label, n) for label, n in labels.items()])).alias("value")
    rates.select("sample", lines).write.partitionBy("sample").text(f"{root}/log")
    summary = overlap.assignment_summary(overlap.assigned_counts(aligned, fx.exons(spark, sf), width=fx.BIN))
    samples = sorted(r[0] for r in rates.select("sample").collect())
    wide = expression.wide(summary, "n", samples, ("status",))
    text_tables.write_matrix_tsv(wide.withColumnsRenamed({"status": "Status", **bam_paths(samples)}), f"{root}/summary")
    outcomes = reports.read_count_summary(spark, f"{root}/summary")
    stats = workflow.general_stats_of_reports(
        reports.read_trim_json(spark, f"{root}/trim"),
        reports.read_align_log(spark, f"{root}/log"),
        # The longest name last: src1 is also part of src10.
        expression.rename_by_sample(outcomes, sorted(samples, key=len)),
    )
    return rounded(stats, "pass_pct", "assigned_pct")


@query("status_matrix", "R2", "SELECT module, sample, status FROM qc_status WHERE stage = 'raw'")
def _(spark, sf):
    # One column per sample found in the data; back in long form for the comparison.
    grid = report.status_matrix(reads_qc.verdicts(reads_qc.qc_measures(fx.reads(spark, sf))))
    return grid.unpivot(["module"], [c for c in grid.columns if c != "module"], "sample", "status")


@query(
    "stage_union",
    "R3",
    "SELECT sample, stage, CAST(length(seq) AS INTEGER) AS length, count(*) AS n_reads FROM staged GROUP BY 1, 2, 3",
)
def _(spark, sf):
    both = reads_qc.length_distribution(trim.both_stages(chain(spark, sf)), STAGED)
    return report.stage_union({None: both})


@query(
    "summary_table",
    "R4",
    """SELECT sample, metric, round(before, 6) AS before, round(after, 6) AS after, round(after - before, 6) AS delta FROM compared""",
)
def _(spark, sf):
    return rounded(workflow.summary_table(staged(spark, sf)), "before", "after", "delta")


@query(
    "heatmap_cells",
    "R5",
    """SELECT CAST(row_number() OVER (ORDER BY mean_tpm DESC, gene_id) - 1 AS INTEGER) AS "row", gene_id,
      unnest([0, 1, 2]) AS col, unnest(['A', 'N', 'R']) AS sample,
      unnest([round(log2(A + 1), 6), round(log2(N + 1), 6), round(log2(R + 1), 6)]) AS value FROM plotted""",
)
def _(spark, sf):
    return rounded(expression.heatmap_cells(expression.tpm(fx.counts(spark, sf)), fx.samples(spark, sf)), "value")


@query(
    "completeness_check",
    "R6",
    """SELECT m.sample, s.stage FROM manifest m CROSS JOIN (SELECT unnest(['raw', 'trimmed', 'aligned']) AS stage) s
    WHERE NOT EXISTS (SELECT 1 FROM finished f WHERE f.sample = m.sample AND f.stage = s.stage AND f.length > 0)""",
)
def _(spark, sf):
    return manifest.completeness_check(
        fx.manifest(spark, sf), fx.finished(spark, sf), ["raw", "trimmed", "aligned"]
    )
