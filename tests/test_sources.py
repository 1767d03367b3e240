"""Readers and writers on small files, and on files cut at every possible place."""

import gzip
import json
import random
import time

import pytest

from readloom.operators import features, manifest
from readloom.session import scratch_dir
from readloom.sources import fastq, reports, text_tables


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


# --- FASTQ -------------------------------------------------------------------------


def records(n, seed=1):
    """Reads whose quality lines often start with '@' or '+'."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = rng.randrange(1, 30)
        qual = rng.choice("@+I") + "".join(rng.choice("@+#I5") for _ in range(k - 1))
        out.append((f"r{i}", "".join(rng.choice("ACGTN") for _ in range(k)), qual))
    return out


def fastq_text(rows, plus=""):
    return "".join(f"@{i} extra words\n{s}\n+{plus and i}\n{q}\n" for i, s, q in rows)


@pytest.mark.parametrize("plus", ["", "id"])
@pytest.mark.parametrize("step", [1, 7, 50, 333, 10_000])
def test_every_byte_range_split_gives_each_record_once(tmp_path, step, plus):
    rows = records(40)
    path = write(tmp_path / "SRR1_1.fastq", fastq_text(rows, plus))
    reader = fastq.FastqReader({"path": path, "rangebytes": str(step)})
    got = []
    for part in reader.partitions():
        for batch in reader.read(part):
            got += list(zip(*[batch.column(c).to_pylist() for c in (1, 2, 3)]))
    assert got == rows


@pytest.mark.parametrize("block", [16, 64, 200])
def test_small_read_blocks(tmp_path, monkeypatch, block):
    monkeypatch.setattr(fastq, "BLOCK", block)
    rows = records(60, 2)
    path = write(tmp_path / "a.fastq", fastq_text(rows))
    with gzip.open(tmp_path / "b.fastq.gz", "wb") as f:
        f.write(fastq_text(rows).encode())
    for name in (path, str(tmp_path / "b.fastq.gz")):
        reader = fastq.FastqReader({"path": name, "rangebytes": "500"})
        got = [x for p in reader.partitions() for b in reader.read(p) for x in b.column(1).to_pylist()]
        assert got == [r[0] for r in rows]


def test_missing_end_of_line_and_windows_lines(tmp_path):
    rows = records(5)
    plain = write(tmp_path / "a.fastq", fastq_text(rows).rstrip("\n"))
    dos = write(tmp_path / "b.fastq", fastq_text(rows).replace("\n", "\r\n"))
    for path in (plain, dos):
        for step in ("40", "9999"):
            reader = fastq.FastqReader({"path": path, "rangebytes": step})
            got = [x for p in reader.partitions() for b in reader.read(p) for x in b.column(3).to_pylist()]
            assert got == [r[2] for r in rows]


def test_broken_fastq_is_an_error(tmp_path):
    path = write(tmp_path / "a.fastq", "@r1\nACGT\n+\nIIII\n@r2\nAC\n")
    reader = fastq.FastqReader({"path": path})
    with pytest.raises(ValueError, match="broken"):
        [list(reader.read(p)) for p in reader.partitions()]
    with pytest.raises(FileNotFoundError):
        fastq.FastqReader({"path": str(tmp_path / "none.fastq")}).partitions()


@pytest.mark.parametrize("text", ["@r1\nACGT\nACGT\nIIII\n", "@r1\nACGT\n+\nIII\n", "@r1\nACG\n+\nIIII\n"])
def test_records_are_checked(tmp_path, text):
    reader = fastq.FastqReader({"path": write(tmp_path / "a.fastq", text)})
    with pytest.raises(ValueError, match="broken"):
        [list(reader.read(p)) for p in reader.partitions()]


def test_only_read_files_outside_hidden_folders(spark, tmp_path):
    write(tmp_path / "SRR1.fastq", fastq_text(records(3)))
    write(tmp_path / "_temporary" / "0" / "part-0.fastq", fastq_text(records(5)))
    write(tmp_path / ".cache" / "x.fq", fastq_text(records(5)))
    write(tmp_path / "SRR1.fastp.json", "{}")
    assert {r["sample"] for r in fastq.read_fastq(spark, str(tmp_path)).collect()} == {"SRR1"}
    assert fastq.read_fastq(spark, str(tmp_path)).count() == 3


def test_fastq_by_sample_keeps_the_names(spark, tmp_path):
    rows = [(s, *r) for s in ("a b", "SRR1+x", "ü%2") for r in records(5)] + [("empty", "r0", "", "")]
    df = spark.createDataFrame(rows, "sample string, read_id string, seq string, qual string")
    fastq.write_fastq(df, str(tmp_path / "out"), by_sample=True)
    back = fastq.read_fastq(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_read_fastq_folder(spark, tmp_path):
    write(tmp_path / "SRR1_1.fastq", fastq_text(records(10)))
    write(tmp_path / "SRR2.sra.fastq", fastq_text(records(20)))
    write(tmp_path / "_SUCCESS", "")
    with gzip.open(tmp_path / "SRR3.trimmed.fastq.gz", "wb") as f:
        f.write(fastq_text(records(30)).encode())
    got = fastq.read_fastq(spark, str(tmp_path), range_bytes=200).groupBy("sample").count().collect()
    assert {r["sample"]: r["count"] for r in got} == {"SRR1": 10, "SRR2": 20, "SRR3": 30}


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_fastq_round_trip(spark, tmp_path, compression):
    df = spark.createDataFrame([("s", *r) for r in records(50)], "sample string, read_id string, seq string, qual string")
    out = str(tmp_path / "out")
    fastq.write_fastq(df, out, compression)
    back = fastq.read_fastq(spark, out, range_bytes=300).drop("sample")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.drop("sample").collect()))


# --- FASTA, GTF, SAM, matrix -----------------------------------------------------------


@pytest.mark.parametrize("chunk", [4, 10, 1000])
@pytest.mark.parametrize("split", [20, 64, 1 << 20])
def test_fasta_chunks_do_not_depend_on_splits(spark, tmp_path, chunk, split):
    rng = random.Random(5)
    contigs = {f"chr{i}": "".join(rng.choice("ACGTN") for _ in range(rng.randrange(1, 150))) for i in range(1, 6)}
    text = ""
    for name, seq in contigs.items():
        text += f">{name} description of {name}\n" + "".join(seq[i : i + 13] + "\n" for i in range(0, len(seq), 13))
    path = write(tmp_path / "g.fa", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        rows = text_tables.read_fasta(spark, path, chunk).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {}
    for r in sorted(rows, key=lambda r: (r.chrom, r.chunk_no)):
        assert r.offset == r.chunk_no * chunk and len(r.seq) <= chunk
        got[r.chrom] = got.get(r.chrom, "") + r.seq
    assert got == contigs


def test_contig_filter_needs_the_whole_name(spark, tmp_path):
    path = write(tmp_path / "g.fa", ">chr1 GRCh38\nACGT\n>chr10\nTT\n>KI270\nGG\n")
    rows = features.filter_contig(text_tables.read_fasta(spark, path), "chr1").collect()
    assert [r.seq for r in rows] == ["ACGT"]


GTF = (
    "##format: gtf\n"
    'chr1\tHAVANA\tgene\t11\t20\t.\t+\t.\tgene_id "G1"; gene_name "A;B"; level 2;\n'
    'chr1\tHAVANA\texon\t11\t15\t0.5\t-\t0\tgene_id "G1"; tag "basic"; tag "CCDS"; transcript_id "T1"\n'
)


def test_gtf(spark, tmp_path):
    rows = text_tables.read_gtf(spark, write(tmp_path / "a.gtf", GTF)).orderBy("end_pos").collect()
    exon, gene = rows
    assert (gene.start_pos, gene.end_pos, gene.score, gene.feature) == (11, 20, None, "gene")
    assert exon.score == 0.5 and exon.strand == "-"
    assert exon.attributes == {"gene_id": "G1", "tag": "basic", "transcript_id": "T1"}
    assert gene.attributes["gene_id"] == "G1" and gene.attributes["level"] == "2"


def test_gtf_value_with_a_semicolon(spark, tmp_path):
    row = text_tables.read_gtf(spark, write(tmp_path / "a.gtf", GTF)).where("feature = 'gene'").first()
    assert row.attributes["gene_name"] == "A;B"


SAM = (
    "@HD\tVN:1.4\n@SQ\tSN:chr2\tLN:20\n@SQ\tSN:chr1\tLN:10\n"
    "r1\t16\tchr1\t5\t255\t3M\t*\t0\t0\tACG\tIII\tNH:i:1\tHI:i:1\tNM:i:2\tMD:Z:3\n"
    "r2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n"
)


def test_sam(spark, tmp_path):
    path = write(tmp_path / "S1_Aligned.sortedByCoord.out.sam", SAM)
    r1, r2 = text_tables.read_sam(spark, path).orderBy("read_id").collect()
    assert (r1.sample, r1.flag, r1.chrom, r1.pos, r1.mapq, r1.cigar, r1.nh, r1.nm) == ("S1", 16, "chr1", 5, 255, "3M", 1, 2)
    assert r1.tags["MD"] == "3"
    assert (r2.chrom, r2.nh, r2.tags) == (None, None, {})
    d = text_tables.read_sam_dictionary(spark, path).orderBy("ordinal").collect()
    assert [(r.chrom, r.length) for r in d] == [("chr2", 20), ("chr1", 10)]


def test_short_alignment_line_is_an_error(spark, tmp_path):
    path = write(tmp_path / "S1.sam", SAM + "r3\t0\tchr1\t5\t255\t3M\n")
    with pytest.raises(Exception, match="broken alignment line"):
        text_tables.read_sam(spark, path).collect()


def test_dictionary_of_several_files(spark, tmp_path):
    for name in ("b.sam", "a.sam"):
        write(tmp_path / name, SAM)
    with gzip.open(tmp_path / "0.sam.gz", "wb") as f:
        f.write(SAM.encode())
    d = text_tables.read_sam_dictionary(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [(r.chrom, r.length, r.ordinal) for r in d] == [("chr2", 20, 0), ("chr1", 10, 1)]


def test_sam_dictionary_of_files_with_unlike_headers(spark, tmp_path):
    row = "r1\t0\tchr1\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\n"
    (tmp_path / "sample=a").mkdir()
    (tmp_path / "sample=a" / "part-0.txt").write_text(row)
    (tmp_path / "sample=b").mkdir()
    (tmp_path / "sample=b" / "part-0.txt").write_text("@HD\tVN:1.6\n@SQ\tSN:chr2\tLN:90\n@SQ\tSN:chr1\tLN:100\n" + row)
    (tmp_path / "sample=b" / "part-1.txt").write_text("@SQ\tSN:chr1\tLN:100\n@SQ\tSN:chrM\tLN:16\n")
    found = text_tables.read_sam_dictionary(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [tuple(r) for r in found] == [("chr2", 90, 0), ("chr1", 100, 1), ("chrM", 16, 2)]
    (tmp_path / "sample=b" / "part-2.txt").write_text("@SQ\tSN:chr2\tLN:91\n")
    with pytest.raises(Exception, match="disagree on the length of contig chr2"):
        text_tables.read_sam_dictionary(spark, str(tmp_path)).collect()


def test_count_summary(spark, tmp_path):
    path = write(tmp_path / "c.summary", "Status\ta/S1.bam\tS2.bam\nAssigned\t5\t6\nUnassigned_Unmapped\t0\t1\n")
    got = {(r.path, r.status): r.n for r in reports.read_count_summary(spark, path).collect()}
    assert got[("a/S1.bam", "Assigned")] == 5 and got[("S2.bam", "Unassigned_Unmapped")] == 1 and len(got) == 4
    with pytest.raises(ValueError, match="Status"):
        reports.read_count_summary(spark, write(tmp_path / "d", "x.bam\n1\n"))


def test_count_matrix(spark, tmp_path):
    text = "# Program:x\nGeneid\tChr\tLength\ta/S1.bam\tb/S2.bam\ng1\tc\t10\t5\t2.75\ng2\tc\t20\tx\t\n"
    long = text_tables.read_count_matrix(spark, write(tmp_path / "m.txt", text))
    got = sorted((r.gene_id, r.length, r.path, r["count"]) for r in long.collect())
    assert got == [("g1", 10, "a/S1.bam", 5), ("g1", 10, "b/S2.bam", 2.75), ("g2", 20, "a/S1.bam", 0), ("g2", 20, "b/S2.bam", 0)]
    for bad, message in [("Geneid\tx.bam\ng\t1\n", "Length"), ("Geneid\tLength\ng\t1\n", "no count")]:
        with pytest.raises(ValueError, match=message):
            text_tables.read_count_matrix(spark, write(tmp_path / f"{message[:2]}.txt", bad))


def test_matrix_sink(spark, tmp_path):
    df = spark.createDataFrame([("g1", 10, 1.5)], "Geneid string, Length int, S1 double")
    text_tables.write_matrix_tsv(df, str(tmp_path / "o"), ["Geneid", "S1"])
    back = text_tables.read_matrix_tsv(spark, str(tmp_path / "o"), "Geneid string, S1 double")
    assert [tuple(r) for r in back.collect()] == [("g1", 1.5)]


# --- report files ------------------------------------------------------------------

# A few lines of a QC report.
QC_TEXT = """##FastQC\t0.12.1
>>Basic Statistics\tpass
#Measure\tValue
Total Sequences\t7085020
Total Bases\t357.7 Mbp
%GC\t49
>>END_MODULE
>>Sequence Duplication Levels\tfail
#Total Deduplicated Percentage\t44.92475128448297
#Duplication Level\tPercentage of total
1\t27.621747081977432
>10\t10.528331649493724
>>END_MODULE
>>Overrepresented sequences\tpass
>>END_MODULE
"""


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_qc_report(spark, tmp_path, newline):
    path = write(tmp_path / "SRR1.sra_fastqc" / "fastqc_data.txt", QC_TEXT.replace("\n", newline))
    rows = {(r.module, r.row_no, r.metric): r.value for r in reports.read_qc_report(spark, path).collect()}
    assert rows == {
        ("Basic Statistics", 1, "Measure"): "Total Sequences",
        ("Basic Statistics", 1, "Value"): "7085020",
        ("Basic Statistics", 2, "Measure"): "Total Bases",
        ("Basic Statistics", 2, "Value"): "357.7 Mbp",
        ("Basic Statistics", 3, "Measure"): "%GC",
        ("Basic Statistics", 3, "Value"): "49",
        ("Sequence Duplication Levels", 0, "Total Deduplicated Percentage"): "44.92475128448297",
        ("Sequence Duplication Levels", 1, "Duplication Level"): "1",
        ("Sequence Duplication Levels", 1, "Percentage of total"): "27.621747081977432",
        ("Sequence Duplication Levels", 2, "Duplication Level"): ">10",
        ("Sequence Duplication Levels", 2, "Percentage of total"): "10.528331649493724",
        ("Overrepresented sequences", None, None): None,
    }
    samples = {(r["sample"], r.status) for r in reports.read_qc_report(spark, path).collect()}
    assert samples == {("SRR1", "pass"), ("SRR1", "fail")}


def test_qc_status(spark, tmp_path):
    path = write(tmp_path / "summary.txt", "PASS\tBasic Statistics\tSRR1.sra.fastq\nFAIL\tAdapter Content\tSRR1.sra.fastq\n")
    got = [tuple(r) for r in reports.read_qc_status(spark, path).orderBy("module").collect()]
    assert got == [("SRR1", "Adapter Content", "FAIL"), ("SRR1", "Basic Statistics", "PASS")]


def test_align_log(spark, tmp_path):
    text = "  Number of input reads |\t10\n   Uniquely mapped reads % |\t90.00%\n     % of reads unmapped: other |\t1%\n"
    rows = reports.read_align_log(spark, write(tmp_path / "S1_Log.final.out", text)).orderBy("label").collect()
    assert [(r["sample"], r.label, r.value) for r in rows] == [
        ("S1", "% of reads unmapped: other", "1%"),
        ("S1", "Uniquely mapped reads %", "90.00%"),
    ]


def test_flagstat_and_idxstats(spark, tmp_path):
    text = "10 + 1 in total (QC-passed reads + QC-failed reads)\n8 + 0 primary\n7 + 1 mapped (70.00% : 100.00%)\n"
    text += "3 + 0 with mate mapped to a different chr\n2 + 0 with mate mapped to a different chr (mapQ>=5)\n"
    path = write(tmp_path / "S1_Aligned.sortedByCoord.out.flagstat.txt", text)
    rows = {r.label: (r["sample"], r.passed, r.failed) for r in reports.read_flagstat(spark, path).collect()}
    assert rows == {"in total": ("S1", 10, 1), "primary": ("S1", 8, 0), "mapped": ("S1", 7, 1)} | {
        "with mate mapped to a different chr": ("S1", 3, 0),
        "with mate mapped to a different chr (mapQ>=5)": ("S1", 2, 0),
    }
    path = write(tmp_path / "S1_Aligned.sortedByCoord.out.idxstats.txt", "chr1\t10\t3\t0\n*\t0\t0\t2\n")
    rows = [tuple(r) for r in reports.read_idxstats(spark, path).collect()]
    assert rows == [("S1", "chr1", 10, 3, 0), ("S1", "*", 0, 0, 2)]


def test_trim_json(spark, tmp_path):
    stage = {"total_reads": 10, "total_bases": 500, "q20_bases": 450, "q30_bases": 400, "gc_content": 0.49, "other": 1}
    report = {
        "summary": {"before_filtering": stage, "after_filtering": {**stage, "total_reads": 8}},
        "filtering_result": {"passed_filter_reads": 8, "low_quality_reads": 1, "too_many_N_reads": 0, "too_short_reads": 1},
        "adapter_cutting": {},
    }
    path = write(tmp_path / "S1.fastp.json", json.dumps(report, indent=2))
    r = reports.read_trim_json(spark, path).first()
    assert (r["sample"], r.before_total_reads, r.after_total_reads, r.too_short_reads) == ("S1", 10, 8, 1)


def test_manifest_reads_metadata(spark, tmp_path):
    write(tmp_path / "SRR1_1.fastq", "x" * 10)
    write(tmp_path / "SRR2.sra.fastq.gz", "x" * 3)
    rows = reports.read_manifest(spark, str(tmp_path))
    assert {r["sample"]: r.length for r in rows.collect()} == {"SRR1": 10, "SRR2": 3}
    assert [r["sample"] for r in manifest.too_small(rows, 10).collect()] == ["SRR2"]
    with pytest.raises(Exception, match="file too small"):
        manifest.size_gate(rows, 4).collect()
    assert manifest.size_gate(rows, 3).count() == 2
    assert {r["sample"]: r.passed for r in manifest.size_verdicts(rows, 10).collect()} == {"SRR1": True, "SRR2": False}


def test_resolve_inputs(spark):
    rows = [
        ("a", "/raw/a.sra.fastq"),
        ("a", "/raw/a.fastq"),
        ("a", "/raw/a_1.fastq.gz"),
        ("b", "/raw/b.txt"),
        ("c", None),
        ("d", "/raw/xd.fastq"),
    ]
    df = spark.createDataFrame(rows, "sample string, path string")
    got = {r["sample"]: r for r in manifest.resolve_inputs(df).collect()}
    assert got["a"].path == "/raw/a_1.fastq.gz" and got["a"].error is None
    assert got["b"].path is None and got["b"].error.startswith("not found: b_1.fastq, b_1.fastq.gz")
    assert got["c"].path is None and got["d"].path is None


def test_pending_and_completeness(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "sample string")
    done = spark.createDataFrame([("a", "raw", 5), ("b", "raw", 0)], "sample string, stage string, length long")
    assert sorted(r["sample"] for r in manifest.pending(wanted, done).collect()) == ["b", "c"]
    missing = manifest.completeness_check(wanted, done, ["raw", "aligned"])
    assert len(missing.collect()) == 5


def test_grep_lines(spark):
    df = spark.createDataFrame([("  \t mapped 1",), ("none",)], "value string")
    assert [r.value for r in features.grep_lines(df, "mapped|total").collect()] == ["mapped 1"]


def test_scratch_folder_comes_from_the_session():
    class Session:
        conf = {"spark.checkpoint.dir": "hdfs://shared/folder/"}

    first, second = scratch_dir(Session, "x"), scratch_dir(Session, "x")
    assert first.startswith("hdfs://shared/folder/x-") and first != second


def test_sample_of_a_long_path_takes_few_steps(spark):
    """A pattern tried at every character of a path takes the square of its length."""
    long = "/" + "ab" * 10_000
    paths = [f"{long}/{i}_1.fastq.gz" for i in range(40)] + ["x", "/a/", "/a/sample=p%20q/r.fq", "/a.gz/b.sra.fastq"]
    df = spark.createDataFrame([(p,) for p in paths], "path string").coalesce(1)
    begin = time.time()
    got = [r[0] for r in df.select(fastq.sample_of_path("path")).collect()]
    assert got == [str(i) for i in range(40)] + ["x", "", "p q", "b"]
    assert time.time() - begin < 10
