"""Whole files written by all tasks, and reports observed by the job that writes."""

import gzip
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from readloom.operators import trim
from readloom.plans import one_pass, workflow
from readloom.sources import fastq, text_tables
from readloom.sources.single_files import write_files


def many_reads(spark, n=3000):
    """Reads of three samples in many partitions; sample b has most of them."""
    df = spark.range(n, numPartitions=13)
    seq = F.concat(F.expr("substr(repeat('ACGTTGCA', 8), 1 + id % 8, 45)"), F.when(F.col("id") % 5 == 0, "NNNNNN").otherwise("ACGTAC"))
    return df.select(
        F.format_string("r%06d", "id").alias("read_id"),
        F.when(F.col("id") % 10 == 0, "a").when(F.col("id") % 10 == 1, "c").otherwise("b").alias("sample"),
        seq.alias("seq"),
        F.when(F.col("id") % 7 == 0, F.lit("#" * 51)).otherwise(F.lit("I" * 51)).alias("qual"),
    )


def test_one_file_for_each_name_in_order(spark, tmp_path):
    rows = spark.range(5000, numPartitions=17).select(
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("name"), F.format_string("line %06d", "id").alias("line")
    )
    told = write_files(rows, str(tmp_path / "out"), ".txt.gz", compress=True, header="top", names=["x", "z"])
    assert sorted(os.listdir(tmp_path / "out")) == ["x.txt.gz", "y.txt.gz", "z.txt.gz"]
    for name in "xyz":
        with gzip.open(tmp_path / "out" / f"{name}.txt.gz", "rt") as f:
            lines = f.read().splitlines()
        ids = [i for i in range(5000) if (i % 3 == 0) == (name == "x") and name != "z"]
        assert lines == ["top", *[f"line {i:06d}" for i in ids]]
    sizes = {r["file"]: (r["bytes"], r["lines"]) for r in told.collect()}
    assert sizes["z.txt.gz"][1] == 0 and sizes["x.txt.gz"][1] == 1667
    assert all(os.path.getsize(tmp_path / "out" / f) == n for f, (n, _) in sizes.items())


def test_small_pieces_and_many_names(spark, tmp_path, monkeypatch):
    from readloom.sources import single_files

    monkeypatch.setattr(single_files, "PIECE", 200)
    monkeypatch.setattr(single_files, "HELD", 1000)
    rows = spark.range(4000, numPartitions=5).select(F.concat(F.lit("n"), F.col("id") % 40).alias("name"), F.col("id").cast("string").alias("line"))
    write_files(rows, str(tmp_path / "out"))
    for k in (0, 17, 39):
        assert (tmp_path / "out" / f"n{k}").read_text().split() == [str(i) for i in range(k, 4000, 40)]


def test_wrong_names_and_taken_paths(spark, tmp_path):
    for name in ("../x", None, "", ".."):
        rows = spark.createDataFrame([(name, "line")], "name string, line string")
        with pytest.raises(Exception, match="no file name"):
            write_files(rows, str(tmp_path / "out"))
    os.makedirs(tmp_path / "taken")
    with pytest.raises(FileExistsError):
        write_files(spark.createDataFrame([("a", "b")], "name string, line string"), str(tmp_path / "taken"))
    with pytest.raises(Exception):
        write_files(spark.createDataFrame([("a", "b")], "name string, line string"), "viewfs://nowhere/out")


def test_a_repeated_task_leaves_no_trace(tmp_path):
    """First attempts write pieces and fail; what they wrote is in no file."""
    script = textwrap.dedent(
        f"""
        import sys
        sys.path.insert(0, {str(os.getcwd())!r})
        from pyspark.sql import SparkSession, functions as F
        from readloom.sources.single_files import write_files
        spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        def fail_first(batches):
            import pyarrow as pa
            from pyspark import TaskContext
            for batch in batches:
                yield batch
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("first attempt")
        rows = spark.range(60000, numPartitions=4).select(F.concat(F.lit("n"), F.col("id") % 2).alias("name"), F.format_string("%040d", "id").alias("line"))
        told = write_files(rows.mapInArrow(fail_first, "name string, line string"), {str(tmp_path / "out")!r}, ".gz", compress=True)
        print(sorted((r.file, r.lines) for r in told.collect()))
        """
    )
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert "[('n0.gz', 30000), ('n1.gz', 30000)]" in done.stdout, done.stderr[-2000:]
    for k in (0, 1):
        with gzip.open(tmp_path / "out" / f"n{k}.gz", "rt") as f:
            assert [int(x) for x in f] == list(range(k, 60000, 2))


@pytest.mark.parametrize("ending", [".trimmed.fastq.gz", ".fastq"])
def test_report_is_that_of_the_written_pass(spark, tmp_path, ending):
    chain = trim.trim_chain(many_reads(spark))
    told = {r["sample"]: r for r in one_pass.write_trimmed(chain, str(tmp_path / "t"), ["a", "b", "c", "none"], ending).collect()}
    expected = {r["sample"]: r for r in workflow.trim_report(chain).collect()}
    for name, r in expected.items():
        result, before, after = r["filtering_result"], r["summary"]["before_filtering"], r["summary"]["after_filtering"]
        own = told[name]
        assert (own["passed"], own["low_quality"]) == (result["passed_filter_reads"], result["low_quality_reads"])
        assert (own["too_many_N"], own["too_short"]) == (result["too_many_N_reads"], result["too_short_reads"])
        for when, stage in (("before", before), ("after", after)):
            assert [own[f"{when}_{m}"] for m in ("reads", "bases", "q20_bases", "q30_bases")] == list(stage)[:4]
    assert told["none"]["before_reads"] == 0 and sum(told["none"][1:]) == 0
    back = fastq.read_fastq(spark, str(tmp_path / "t"))
    kept = trim.trimmed_reads(chain).select("sample", "read_id", "seq", "qual")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, kept.collect()))
    opener = gzip.open if ending.endswith("gz") else open
    with opener(tmp_path / "t" / f"b{ending}", "rt") as f:
        ids = [x[1:].strip() for i, x in enumerate(f) if i % 4 == 0]
    assert ids == sorted(ids) and len(ids) == told["b"]["passed"]


def test_observed_plan_scans_once(spark, tmp_path):
    spark.range(100).select(
        F.concat(F.lit("r"), "id").alias("read_id"), F.lit("a").alias("sample"), F.lit("ACGT" * 12).alias("seq"), F.lit("I" * 48).alias("qual")
    ).write.parquet(str(tmp_path / "reads"))
    watched, _ = one_pass.observed(trim.trim_chain(spark.read.parquet(str(tmp_path / "reads"))), ["a"])
    plan = trim.trimmed_reads(watched)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan


def test_a_sample_that_is_not_named_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="none of the samples"):
        one_pass.write_trimmed(trim.trim_chain(many_reads(spark, 100)), str(tmp_path / "t"), ["a", "b"])
    assert not os.path.exists(tmp_path / "t")


def test_matrix_file_has_one_header(spark, tmp_path):
    matrix = spark.range(2000, numPartitions=6).selectExpr("format_string('G%05d', id) AS Geneid", "CAST(id % 9 AS INT) AS Length", "id * 0.5D AS `s.1`", "nullif(id, 7) AS s2")
    shape = one_pass.write_matrix(matrix.orderBy("Geneid"), str(tmp_path / "m"), "counts").first()
    assert tuple(shape) == (2000, 2, "s.1,s2")
    lines = (tmp_path / "m" / "counts.tsv").read_text().splitlines()
    assert lines[0] == "Geneid\tLength\ts.1\ts2" and lines[8] == "G00007\t7\t3.5\t" and len(lines) == 2001
    assert [x.split("\t")[0] for x in lines[1:]] == [f"G{i:05d}" for i in range(2000)]
    one_pass.write_matrix(matrix.where("false"), str(tmp_path / "empty"), "counts")
    assert (tmp_path / "empty" / "counts.tsv").read_text() == "Geneid\tLength\ts.1\ts2\n"
    with pytest.raises(Exception, match="a cell holds"):
        text_tables.write_matrix_file(spark.createDataFrame([("a\tb", 1)], "Geneid string, n int"), str(tmp_path / "bad"), "x")
