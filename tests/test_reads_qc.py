"""Known outcomes of two real QC reports, and invariants of the modules."""

import pytest
from pyspark.sql import functions as F

from readloom.catalog import fixtures as fx
from readloom.operators import reads_qc, trim
from readloom.plans import workflow
from readloom.sources import reports

# Lines of the QC reports of two sequencing runs: whole modules of a few lines, the GC histogram, and of
# long tables the rows with the extreme values.
GC_A = """1938.0 1111.5 285.0 286.0 351.5 460.0 515.0 806.5 1207.5 1461.5 1974.0 2451.0 2566.5 2914.5 3290.5 4289.0 5112.0
7466.0 10059.0 15206.5 20457.5 28010.0 35715.5 47572.0 59206.0 72581.5 96522.5 113396.5 132012.5 150248.0 168956.5 187487.0
206474.0 224640.5 243709.0 262308.0 277278.5 290273.0 298530.5 304266.5 310694.5 319321.5 325811.5 331729.0 338204.5 341859.5
344727.0 348826.5 355174.0 363505.0 380815.5 402308.0 421782.0 437532.5 472307.0 509085.0 523487.5 531931.0 523405.5 511848.5
469602.5 414562.5 355413.0 303277.5 252992.5 203976.5 160979.0 119276.0 95486.5 75319.0 63790.0 53865.5 45894.5 38276.5 31096.0
22377.0 18484.0 12705.5 6938.0 4087.5 1243.5 793.5 356.5 238.0 114.5 87.5 65.0 43.5 22.0 13.0 4.0 2.0 0.0 0.0 0.0 0.0 0.0 0.5
1.0 1.5 2.0"""
GC_B = """1427.0 803.0 179.0 189.0 243.5 296.5 314.0 550.0 872.0 1094.0 1482.0 1910.0 2069.0 2650.0 3301.5 4713.5 6078.5
9924.5 13862.5 21313.0 28920.0 40050.5 51279.5 68257.0 85181.0 102947.5 134686.5 156561.0 179354.5 200803.5 222018.0 242194.5
258840.0 274639.5 291601.5 306102.0 314747.0 322193.5 323156.5 321408.0 320293.0 320651.0 320836.0 321030.0 318487.5 311641.5
303235.0 296823.5 294231.5 294129.5 299126.5 305827.0 307463.5 306133.0 314098.0 322833.0 326691.0 329205.0 323604.0 317052.5
292694.0 261505.5 226430.5 195456.5 165197.5 135366.0 108215.0 81379.5 66652.0 54487.0 48178.5 42683.5 37090.5 31782.5 25659.5
17093.0 13185.5 9303.0 5403.0 3314.0 1241.5 768.0 296.5 220.0 137.5 86.5 48.0 29.0 10.0 5.5 1.0 0.5 0.0 0.5 1.0 0.5 0.0 0.0 0.0
0.0 0.0"""
REPORT = """##FastQC\t0.12.1
>>Basic Statistics\tpass
#Measure\tValue
Total Sequences\t{total}
Sequence length\t35-51
>>END_MODULE
>>Per base sequence quality\tpass
#Base\tMean\tMedian\tLower Quartile\tUpper Quartile\t10th Percentile\t90th Percentile
3\t{quality}\t27.0\t27.0\t37.0\t22.0\t37.0
>>END_MODULE
>>Per sequence quality scores\tpass
#Quality\tCount
{scores}
>>END_MODULE
>>Per base sequence content\tfail
#Base\tG\tA\tT\tC
{content}
>>END_MODULE
>>Per sequence GC content\tfail
#GC Content\tCount
{gc}
>>END_MODULE
>>Per base N content\tpass
#Base\tN-Count
35\t{unknown}
>>END_MODULE
>>Sequence Duplication Levels\t{duplication}
#Total Deduplicated Percentage\t{dedup}
#Duplication Level\tPercentage of total
>>END_MODULE
>>Overrepresented sequences\t{over}
>>END_MODULE
>>Adapter Content\tpass
#Position\tIllumina Universal Adapter\tIllumina Small RNA 3' Adapter\tIllumina Small RNA 5' Adapter\tNextera Transposase Sequence\tPolyA\tPolyG
40\t{adapters}
>>END_MODULE
"""


def gc_lines(counts):
    return "\n".join(f"{i}\t{n}" for i, n in enumerate(counts.split()))


REPORTS = {
    "a": REPORT.format(
        total=7085020,
        quality="28.55940844203686",
        scores="39\t1310837.0\n38\t1673272.0",
        content="51\t24.519505754961646\t0.0\t40.0621680373931\t35.41832620764525",
        gc=gc_lines(GC_A),
        unknown="0.11414223248487655",
        duplication="fail",
        dedup="44.92475128448297",
        over="warn\n#Sequence\tCount\tPercentage\tPossible Source\nCCGACCATAAACGATGCCGACCGGCGATGCGGCGGCGTTATTCCCATGAC\t8117\t0.11456566107082267\tNo Hit",
        adapters="0.004812971593587598\t0.0\t0.0\t1.1291428958563279E-4\t0.6350017360572023\t9.597714614778787E-4",
    ),
    "b": REPORT.format(
        total=6067311,
        quality="28.376387332048743",
        scores="37\t1123746.0\n38\t1418639.0",
        content="51\t22.810492004926335\t0.0\t44.54047545951943\t32.649032535554234",
        gc=gc_lines(GC_B),
        unknown="0.11568551537905342",
        duplication="warn",
        dedup="50.474677563667214",
        over="pass",
        adapters="0.004664339770946306\t0.0\t0.0\t4.9445297925225856E-5\t0.6482608193316611\t7.581612348534631E-4",
    ),
}
STATUS = {"pass": "PASS", "warn": "WARN", "fail": "FAIL"}


def test_verdicts_of_two_known_runs(spark):
    """Measures computed from the reports give the verdicts that the reports themselves state."""
    cells = reports.parse_qc_report(spark.createDataFrame(list(REPORTS.items()), "sample string, value string"))
    measures = workflow.report_measures(cells)
    values = {(r["sample"], r.measure): r.value for r in measures.collect()}
    assert values["a", "mode_quality"] == 38.0 and values["b", "length_spread"] == 16.0
    assert values["a", "max_base_difference"] == pytest.approx(40.0621680373931)
    assert 30 < values["b", "gc_deviation"] < 100 and 30 < values["a", "gc_deviation"] < 100
    got = {(r["sample"], r.module): r.status for r in reads_qc.verdicts(measures).collect()}
    stated = {(r["sample"], r.module): STATUS[r.status] for r in cells.select("sample", "module", "status").distinct().collect()}
    # The report is silent on over-represented sequences where there is none; lengths are told by the basic statistics.
    assert stated.pop(("b", "Overrepresented sequences")) == "PASS"
    assert got.pop(("a", "Sequence Length Distribution")) == got.pop(("b", "Sequence Length Distribution")) == "WARN"
    assert got == stated


def one_sample(spark, *rows):
    data = [("s", seq, qual) for seq, qual in rows]
    return spark.createDataFrame(data, "sample string, seq string, qual string")


def test_megabases_are_cut_not_rounded(spark):
    df = one_sample(spark, ("A" * 190_000, "I" * 190_000))
    assert reads_qc.basic_stats(df).first().total_mbp == 0.1


def test_gc_spread_shares_a_percentage_between_neighbours(spark):
    # Reads of 51 bases: 0 and 1 GC both claim 1 %, so each gives it half.
    rows = [("A" * 51, "I" * 51)] * 4 + [("G" + "A" * 50, "I" * 51)] * 2
    hist = {r.gc: r.n_reads for r in reads_qc.per_sequence_gc(one_sample(spark, *rows), spread=True).collect()}
    assert [hist[0], hist[1], hist[2]] == [4.0, 3.0, 2.0]
    assert len(hist) == 101


def test_quality_histogram_keeps_zero_rows(spark):
    df = one_sample(spark, ("AA", "II"), ("AA", "##"), ("", ""))
    hist = {r.quality: r.n_reads for r in reads_qc.per_sequence_quality(df).collect()}
    assert hist[40] == 1 and hist[2] == 1 and hist[20] == 0 and len(hist) == 39


def test_n_is_left_out_of_base_content(spark):
    df = one_sample(spark, ("NA", "II"), ("GA", "II"))
    rows = {r.pos: r for r in reads_qc.per_base_content(df).collect()}
    assert (rows[1].pct_g, rows[1].pct_a, rows[2].pct_a) == (100.0, 0.0, 100.0)
    assert {r.pos: r.pct_n for r in reads_qc.per_base_n(df).collect()} == {1: 50.0, 2: 0.0}


def test_percentiles_are_discrete(spark):
    df = one_sample(spark, *[("A", chr(33 + s)) for s in (10, 20, 30, 40)])
    r = reads_qc.per_base_quality(df).first()
    assert (r.mean, r.p10, r.q1, r.median, r.q3, r.p90) == (25.0, 10, 10, 20, 30, 40)


def test_adapter_positions_and_monotony(spark):
    probe = reads_qc.ADAPTERS["PolyG"]
    df = one_sample(spark, ("A" * 5 + probe + "A" * 34, "I" * 51), ("C" * 40, "I" * 40))
    rows = reads_qc.adapter_content(df).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, 41))
    assert [r.polyg for r in rows] == [0.0] * 5 + [50.0] * 35


def test_short_reads_have_no_adapter_positions(spark):
    assert reads_qc.adapter_content(one_sample(spark, ("ACGT", "IIII"))).count() == 0


@pytest.mark.parametrize("copies,level", [(9, "9"), (10, ">10"), (50, ">10"), (51, ">50"), (501, ">500")])
def test_duplication_bins(spark, copies, level):
    # 51 bases that differ only in the last one count as copies.
    rows = [("A" * 50 + "ACGT"[i % 4], "I" * 51) for i in range(copies)]
    found = {r.level: r for r in reads_qc.duplication_levels(one_sample(spark, *rows)).collect()}
    assert len(found) == 16
    assert found[level].pct_of_total == 100.0
    assert found[level].dedup_pct == pytest.approx(100.0 / copies)


def test_contaminant_names(spark):
    rows = [("CC" + "A" * 30, "I" * 32)] * 3 + [("CATCATCATCATCAT", "I" * 15)] * 2
    found = {r.sequence: r for r in reads_qc.overrepresented(one_sample(spark, *rows), min_pct=50.0).collect()}
    assert [r.possible_source for r in found.values()] == ["PolyA"]
    assert found["CC" + "A" * 30].n_reads == 3 and found["CC" + "A" * 30].pct == pytest.approx(60.0)


def test_invariants_on_both_stages(spark, sf_dir):
    by = ("sample", "stage")
    staged = workflow.materialise(trim.both_stages(trim.trim_chain(fx.reads(spark, sf_dir))), "staged")
    content = reads_qc.per_base_content(staged, by).withColumn("t", sum(F.col(f"pct_{b}") for b in "gatc"))
    assert content.where(F.abs(F.col("t") - 100) > 1e-9).count() == 0
    levels = reads_qc.duplication_levels(staged, by).groupBy(*by).agg(F.sum("pct_of_total").alias("t"))
    assert levels.where(F.abs(F.col("t") - 100) > 1e-9).count() == 0
    n = staged.count()
    for module in (reads_qc.length_distribution, reads_qc.per_sequence_quality, reads_qc.per_sequence_gc):
        assert module(staged, by).agg(F.sum("n_reads")).first()[0] == n


def test_one_hot_sequence_is_counted_exactly(spark):
    # A third of all reads are copies of one read.
    rows = spark.range(3000).select(
        F.lit("s").alias("sample"),
        F.when(F.col("id") % 3 == 0, "ACGT" * 12)
        .otherwise(F.translate(F.lpad(F.col("id").cast("string"), 48, "0"), "0123456789", "ACGTACGTAC"))
        .alias("seq"),
        F.lit("I" * 48).alias("qual"),
    )
    top = reads_qc.overrepresented(rows, min_pct=30.0).collect()
    assert [(r.sequence, r.n_reads) for r in top] == [("ACGT" * 12, 1000)]


def test_sources_with_a_mismatch(spark):
    from readloom.functions.contaminants import best_source

    adapter = reads_qc.CONTAMINANTS["TruSeq Adapter, Read 1"]
    rng = __import__("random").Random(5)

    def brute(seq, probes, least):
        best = (0, 0, 1)
        for number, probe in enumerate(probes.values()):
            if min(len(seq), len(probe)) < least:
                if seq and probe and (seq in probe or probe in seq):
                    best = max(best, (min(len(seq), len(probe)), 0, -number))
                continue
            for i in range(len(seq)):
                for j in range(len(probe)):
                    for size in range(least, min(len(seq) - i, len(probe) - j) + 1):
                        off = sum(a != b for a, b in zip(seq[i : i + size], probe[j : j + size]))
                        if off <= 1:
                            best = max(best, (size, -off, -number))
        names = list(probes)
        return (names[-best[2]] if best[2] < 1 else "No Hit", best[0] + best[1], best[0])

    seqs = [adapter, adapter[5:30], "T" + adapter[:20], adapter[:10] + "T" + adapter[11:], adapter[:19], "ACGT", "", None, "A" * 50]
    for _ in range(60):
        seq = list(adapter[rng.randrange(12) :] + "".join(rng.choice("ACGT") for _ in range(20)))
        for _ in range(rng.randrange(4)):
            seq[rng.randrange(len(seq))] = rng.choice("ACGTN")
        seqs.append("".join(seq))
    probes = reads_qc.ADAPTERS | reads_qc.CONTAMINANTS
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, s string")
    got = {r["i"]: tuple(r["hit"]) for r in df.select("i", best_source("s", probes).alias("hit")).collect()}
    assert got == {i: brute(s or "", probes, 20) for i, s in enumerate(seqs)}


def test_long_reads_are_counted_in_slices(spark, monkeypatch):
    """Cells don't depend on how many characters are looked at together."""
    df = spark.createDataFrame([("s", "ACGTN" * n, "IIFF#" * n) for n in (0, 1, 7, 40, 400)] + [("s", None, None)], "sample string, seq string, qual string")
    df = df.coalesce(1)
    whole = sorted(map(tuple, reads_qc.read_cells(df, kinds=(*reads_qc.ALL_KINDS, "mean")).collect()))
    monkeypatch.setattr(reads_qc, "CHARACTERS_AT_ONCE", 100)
    assert sorted(map(tuple, reads_qc.read_cells(df, kinds=(*reads_qc.ALL_KINDS, "mean")).collect())) == whole


def test_one_pass_gives_the_cells_and_the_copies(spark, monkeypatch):
    """The measures read the reads once; cells and copies are those of the two passes apart."""
    rows = [("s", "raw", "ACGTN" * n, "IIFF#" * n) for n in (0, 1, 1, 7, 40, 40, 400)]
    rows += [("s", "raw", "ACGTN" * 10 + x, "I" * 51) for x in "AC"]  # one key of 50 bases
    rows += [("s", "trimmed", "ACGT", "IIII"), (None, "raw", "ACGT", "IIII"), ("s", "raw", None, None), (None, "raw", None, None)]
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, "sample string, stage string, seq string, qual string").repartition(3)
    by = ("sample", "stage")
    want = reads_qc.sequence_counts(df, by).groupBy(*by).agg(F.count("*"), F.sum("copies"), F.max("copies"))
    plain = lambda table: sorted(map(repr, map(tuple, table.collect())))
    for most in (reads_qc.CHARACTERS_AT_ONCE, 100):
        monkeypatch.setattr(reads_qc, "CHARACTERS_AT_ONCE", most)
        cells, copies = reads_qc.cells_and_copies(df, by)
        assert plain(copies) == plain(want)
        assert plain(cells) == plain(reads_qc.read_cells(df, by))
    for measures in (reads_qc.qc_measures, reads_qc.stage_metrics):
        read.value = 0
        measures(df.mapInArrow(count, df.schema), by).collect()
        assert read.value == len(rows)
