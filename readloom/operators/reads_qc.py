"""Read QC modules (Q1-Q12).

Every module takes ``reads(sample, seq, qual, ...)`` and a list of grouping columns
(``sample`` by default, ``sample, stage`` to run raw and trimmed reads in one query)
and returns a long table. What counts characters or reads does so on Arrow batches
(:func:`read_cells`); windows and maps only ever see aggregated histograms, whose size
depends on the read length and never on the number of reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bases import (
    acgt_count,
    gc_count,
    gc_percent_rounded,
    int_div,
    percent,
)
from ..functions.contaminants import best_source
from ..functions.intervals import dense
from ..session import checkpoint

SAMPLE = ("sample",)

# Adapter names and 12-mers that the adapter module reports on.
ADAPTERS = {
    "Illumina Universal Adapter": "AGATCGGAAGAG",
    "Illumina Small RNA 3' Adapter": "TGGAATTCTCGG",
    "Illumina Small RNA 5' Adapter": "GATCGTCGGACT",
    "Nextera Transposase Sequence": "CTGTCTCTTATA",
    "PolyA": "AAAAAAAAAAAA",
    "PolyG": "GGGGGGGGGGGG",
}

# Longer sequences that reads may come from.
CONTAMINANTS = {
    "TruSeq Adapter, Read 1": "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA",
    "TruSeq Adapter, Read 2": "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT",
    "Nextera Transposase Adapter": "CTGTCTCTTATACACATCTCCGAGCCCACGAGAC",
}

# Label and largest multiplicity of the duplication bins.
DUPLICATION_BINS = [
    ("1", 1),
    ("2", 2),
    ("3", 3),
    ("4", 4),
    ("5", 5),
    ("6", 6),
    ("7", 7),
    ("8", 8),
    ("9", 9),
    (">10", 50),
    (">50", 100),
    (">100", 500),
    (">500", 1000),
    (">1k", 5000),
    (">5k", 10000),
    (">10k+", None),
]


def basic_stats(reads: DataFrame, by: Sequence[str] = SAMPLE) -> DataFrame:
    """Q1: counts, length range and %GC (rounded down) per sample.

    ``total_mbp`` is cut, not rounded, to a tenth of a megabase.
    """
    n = F.length("seq")
    return (
        reads.groupBy(*by)
        .agg(
            F.count("*").alias("total_sequences"),
            F.sum(n.cast("long")).alias("total_bases"),
            F.min(n).alias("min_len"),
            F.max(n).alias("max_len"),
            F.sum(gc_count("seq").cast("long")).alias("_gc"),
            F.sum(acgt_count("seq").cast("long")).alias("_acgt"),
        )
        .select(
            *by,
            "total_sequences",
            "total_bases",
            (int_div(F.col("total_bases"), 100000) / 10.0).alias("total_mbp"),
            "min_len",
            "max_len",
            int_div(100 * F.col("_gc"), F.col("_acgt")).alias("pct_gc"),
        )
    )


#: Characters that :func:`count_cells` looks at together.
CHARACTERS_AT_ONCE = 1 << 22


def count_cells(n_by: int, kinds: Sequence[str], probes: Sequence[str], key_len: int | None = None):
    """Function for ``mapInArrow``: batches of (by, seq, qual) to counted cells (by, kind, a, b, c, n).

    Kinds: ``base`` (position, character), ``score`` (position, Phred score), ``read``
    (length, mean score rounded down, rounded GC percentage; -1 for an empty read), ``mean``
    (the mean score alone, as b) and ``adapter`` (number of the probe, first place).
    Characters never become rows: numpy counts them on the batch's own buffers, some
    millions at a time however long the reads are. The function carries no reference to this
    package, so workers need not have it.

    With ``key_len`` the cells have one more column, ``seq_key``, null but for those of kind ``sequence``:
    the reads' first ``key_len`` bases and their copies in what is looked at together.
    """
    kinds, probes, most = tuple(kinds), tuple(probes), CHARACTERS_AT_ONCE

    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def flat(column):
            """Bytes of all values, where each begins, how long each is."""
            filled = pc.fill_null(column, "").cast(pa.large_binary())
            ends = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
            data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
            return data, ends[:-1] - ends[0], np.diff(ends)

        def counted(key, size):
            """Distinct keys below ``size`` and how often each occurs."""
            if size <= 1 << 22:
                found = np.bincount(key, minlength=1)
                at = np.flatnonzero(found)
                return at, found[at]
            return np.unique(key, return_counts=True)

        def slices(batch):
            """Runs of rows of about ``most`` characters, one row at least."""
            sizes = sum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False) for c in batch.columns[n_by:])
            upto, begin = np.cumsum(sizes, dtype=np.int64), 0
            while begin < batch.num_rows:
                end = int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + most, "right"))
                end = min(max(end, begin + 1), batch.num_rows)
                yield batch.slice(begin, end - begin)
                begin = end

        for batch in (part for whole in batches for part in slices(whole)):
            group = np.zeros(batch.num_rows, np.int64)
            for column in batch.columns[:n_by]:
                coded = column.dictionary_encode(null_encoding="encode")
                group = group * max(len(coded.dictionary), 1) + coded.indices.to_numpy(zero_copy_only=False)
            _, first, group = np.unique(group, return_index=True, return_inverse=True)
            bases, starts, lengths = flat(batch.column(n_by))
            scores, score_starts, score_lengths = flat(batch.column(n_by + 1))
            longest = int(max(lengths.max(), score_lengths.max(), 1))
            out = []

            def add(kind, groups, a, b, c, n, keys=None):
                zero = np.zeros(len(n), np.int64)
                by = [column.take(pa.array(first[groups])) for column in batch.columns[:n_by]]
                numbers = [pa.array(zero + x, pa.int32()) for x in (a, b, c)]
                name = pa.array([kind] * len(n), pa.string())
                columns = [*by, name, *numbers, pa.array(n, pa.int64())]
                names = [f"by{i}" for i in range(n_by)] + ["kind", "a", "b", "c", "n"]
                if key_len is not None:
                    columns.append(pa.nulls(len(n), pa.string()) if keys is None else keys)
                    names.append("seq_key")
                out.append(pa.RecordBatch.from_arrays(columns, names))

            for kind, data, begin, size, shift in (
                ("base", bases, starts, lengths, 0),
                ("score", scores, score_starts, score_lengths, 33),
            ):
                if kind in kinds:
                    place = np.arange(len(data)) - np.repeat(begin, size)
                    key = (np.repeat(group, size) * longest + place) * 256 + data
                    cell, n = counted(key, len(first) * longest * 256)
                    add(kind, cell // 256 // longest, cell // 256 % longest + 1, cell % 256 - shift, 0, n)
            if "read" in kinds:
                total = np.concatenate(([0], np.cumsum(scores.astype(np.int64) - 33)))
                total = total[score_starts + score_lengths] - total[score_starts]
                mean = np.where(score_lengths > 0, total // np.maximum(score_lengths, 1), -1)
                gc = np.concatenate(([0], np.cumsum((bases == 71) | (bases == 67))))
                gc = gc[starts + lengths] - gc[starts]
                share = np.where(lengths > 0, (200 * gc + lengths) // np.maximum(2 * lengths, 1), -1)
                key = ((group * (longest + 1) + lengths) * 256 + mean + 1) * 128 + share + 1
                cell, n = counted(key, len(first) * (longest + 1) * 256 * 128)
                length = cell // 128 // 256
                add("read", length // (longest + 1), length % (longest + 1), cell // 128 % 256 - 1, cell % 128 - 1, n)
            if "mean" in kinds:
                total = np.concatenate(([0], np.cumsum(scores.astype(np.int64) - 33)))
                total = total[score_starts + score_lengths] - total[score_starts]
                mean = np.where(score_lengths > 0, total // np.maximum(score_lengths, 1), -1)
                cell, n = counted(group * 256 + mean + 1, len(first) * 256)
                add("mean", cell // 256, 0, cell % 256 - 1, 0, n)
            if "adapter" in kinds:
                for i, probe in enumerate(probes):
                    at = pc.find_substring(pc.fill_null(batch.column(n_by), ""), probe).to_numpy(zero_copy_only=False)
                    hit = at >= 0
                    cell, n = counted(group[hit] * longest + at[hit], len(first) * longest)
                    add("adapter", cell // longest, i, cell % longest + 1, 0, n)
            if key_len is not None:
                # Null sequences are a key of their own; the code of a key stands for it in the count.
                keys = pc.utf8_slice_codeunits(batch.column(n_by).cast(pa.string()), 0, key_len)
                coded = keys.dictionary_encode(null_encoding="encode")
                code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                cell, n = counted(group * len(coded.dictionary) + code, len(first) * len(coded.dictionary))
                values = coded.dictionary.take(pa.array(cell % len(coded.dictionary)))
                add("sequence", cell // len(coded.dictionary), 0, 0, 0, n, values)
            yield from out

    return count


ALL_KINDS = ("base", "score", "read", "adapter")
#: Kinds that need no bases, and those that need no scores.
OF_SCORES, OF_BASES = {"score", "mean"}, {"base", "adapter"}


def read_cells(
    reads: DataFrame, by: Sequence[str] = SAMPLE, kinds: Sequence[str] = ALL_KINDS, adapters: dict[str, str] = ADAPTERS
) -> DataFrame:
    """(by, kind, a, b, c, n): all counts over the reads that Q2-Q6 and Q10 derive from, in one pass.

    Each batch sends its cells, a few thousand for each group, to the one shuffle. The
    optimizer does not push a condition on the kind below the generator here, so several
    tables that derive from the cells share that shuffle.
    """
    counted = reads.select(*by, *_read_columns(kinds)).mapInArrow(
        count_cells(len(by), kinds, list(adapters.values())), _cell_schema(reads, by)
    )
    cells = counted.groupBy(*by, F.col("kind").alias("_kind"), "a", "b", "c").agg(F.sum("n").alias("n"))
    return cells.select(*by, F.explode(F.array("_kind")).alias("kind"), "a", "b", "c", "n")


def _read_columns(kinds: Sequence[str]) -> list[Column]:
    """Bases and qualities, empty where none of the kinds needs them."""
    seq = F.lit("") if set(kinds) <= OF_SCORES else F.col("seq")
    qual = F.lit("") if set(kinds) <= OF_BASES else F.col("qual")
    return [seq.alias("seq"), qual.alias("qual")]


def _cell_schema(reads: DataFrame, by: Sequence[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(c, reads.schema[c].dataType) for c in by]
        + [T.StructField("kind", T.StringType())]
        + [T.StructField(c, T.IntegerType()) for c in "abc"]
        + [T.StructField("n", T.LongType())]
    )


def cells_and_copies(
    reads: DataFrame, by: Sequence[str] = SAMPLE, key_len: int = 50, adapters: dict[str, str] = ADAPTERS
) -> tuple[DataFrame, DataFrame]:
    """The cells of :func:`read_cells`, and (by, distinct, reads, most) of :func:`sequence_counts`, from one pass.

    A batch sends its cells and its distinct sequences to one shuffle, where the copies of each are added up; a
    second, small one adds up what the sequences of a group come to. Both results are computed at once and checkpointed.
    """
    schema = _cell_schema(reads, by).add("seq_key", T.StringType())
    counted = reads.select(*by, *_read_columns(ALL_KINDS)).mapInArrow(
        count_cells(len(by), ALL_KINDS, list(adapters.values()), key_len), schema
    )
    cell = [*by, "kind", "a", "b", "c"]
    summed = counted.groupBy(*cell, "seq_key").agg(F.sum("n").alias("n"))
    both = checkpoint(summed.groupBy(*cell).agg(F.sum("n").alias("n"), F.count("*").alias("distinct"), F.max("n").alias("most")))
    copies = both.where("kind = 'sequence'").select(*by, "distinct", F.col("n").alias("reads"), "most")
    return both.where("kind <> 'sequence'").select(*cell, "n"), copies


def _of_kind(cells: DataFrame, kind: str, by: Sequence[str], **names: str) -> DataFrame:
    """The cells of one kind, with names for a, b and c."""
    return cells.where(F.col("kind") == kind).select(*by, *[F.col(c).alias(n) for c, n in names.items()], "n")


def _bases(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, pos, symbol, n): how often each base stands at each read position."""
    return _of_kind(cells, "base", by, a="pos", b="symbol").withColumn("symbol", F.chr(F.col("symbol")))


def per_base_quality(reads: DataFrame, by: Sequence[str] = SAMPLE) -> DataFrame:
    """Q2: mean and discrete percentiles of the Phred score at each position.

    A percentile p is the smallest score whose running count reaches p % of the reads
    at that position. Window groups hold one row per distinct score.
    """
    return _score_percentiles(read_cells(reads, by, ("score",)), by)


def _score_percentiles(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    hist = _of_kind(cells, "score", by, a="pos", b="q")
    cell = Window.partitionBy(*by, "pos")
    running = hist.withColumn(
        "_cum", F.sum("n").over(cell.orderBy("q").rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("_total", F.sum("n").over(cell))

    def at(p: int) -> Column:
        return F.min(F.when(F.col("_cum") * 100 >= F.col("_total") * p, F.col("q")))

    return running.groupBy(*by, "pos").agg(
        (F.sum(F.col("q") * F.col("n")).cast("double") / F.sum("n")).alias("mean"),
        at(50).alias("median"),
        at(25).alias("q1"),
        at(75).alias("q3"),
        at(10).alias("p10"),
        at(90).alias("p90"),
    )


def per_sequence_quality(reads: DataFrame, by: Sequence[str] = SAMPLE) -> DataFrame:
    """Q3: reads per floor(mean Phred score), zero rows kept between the extremes."""
    means = _of_kind(read_cells(reads, by, ("mean",)), "mean", by, b="quality")
    hist = means.groupBy(*by, F.when(F.col("quality") >= 0, F.col("quality")).alias("quality")).agg(
        F.sum("n").alias("n_reads")
    )
    return dense(hist, by, "quality", "n_reads")


def per_base_content(reads: DataFrame, by: Sequence[str] = SAMPLE) -> DataFrame:
    """Q4: share of G, A, T, C at each position; N is left out of the denominator."""
    return _content(_bases(read_cells(reads, by, ("base",)), by), by)


def _content(hist: DataFrame, by: Sequence[str]) -> DataFrame:
    def n_of(base: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("symbol") == base, F.col("n"))), F.lit(0))

    called = F.sum(F.when(F.col("symbol") != "N", F.col("n")))
    return (
        hist.groupBy(*by, "pos")
        .agg(*[n_of(b).alias(f"_{b}") for b in "GATC"], called.alias("_called"))
        .where(F.col("_called") > 0)
        .select(*by, "pos", *[percent(F.col(f"_{b}"), F.col("_called")).alias(f"pct_{b.lower()}") for b in "GATC"])
    )


def per_base_n(reads: DataFrame, by: Sequence[str] = SAMPLE) -> DataFrame:
    """Q6: share of N among the reads that reach each position."""
    return _n_content(_bases(read_cells(reads, by, ("base",)), by), by)


def _n_content(hist: DataFrame, by: Sequence[str]) -> DataFrame:
    n = F.coalesce(F.sum(F.when(F.col("symbol") == "N", F.col("n"))), F.lit(0))
    return hist.groupBy(*by, "pos").agg(percent(n, F.sum("n")).alias("pct_n"))


def per_sequence_gc(reads: DataFrame, by: Sequence[str] = SAMPLE, spread: bool = False) -> DataFrame:
    """Q5: reads per GC percentage 0..100.

    By default a read falls into the one bin round(100 * gc / length). With ``spread``
    it adds to every percentage that its length cannot tell apart from its own, each
    divided by the number of GC counts that claim that percentage; the total then
    exceeds the number of reads.
    """
    if spread:
        return _gc_spread(reads, by)
    hist = (
        reads.groupBy(*by, gc_percent_rounded("seq").alias("gc"))
        .agg(F.count("*").alias("n_reads"))
    )
    return dense(hist, by, "gc", "n_reads", F.lit(0), F.lit(100))


def _percent_range(gc: Column, n: Column) -> Column:
    """Percentages between (gc - 1/2) / n and (gc + 1/2) / n, both rounded half up."""
    low = int_div(F.greatest(2 * gc - 1, F.lit(0)) * 100 + n, 2 * n)
    high = int_div(F.least(2 * gc + 1, 2 * n) * 100 + n, 2 * n)
    return F.sequence(low.cast("int"), high.cast("int"))


def _gc_spread(reads: DataFrame, by: Sequence[str]) -> DataFrame:
    n, g = F.col("_n"), F.col("_g")
    # One row per (sample, read length, GC count): small, whatever the number of reads.
    cells = (
        reads.select(*by, F.length("seq").alias("_n"), gc_count("seq").alias("_g"))
        .where(n > 0)
        .groupBy(*by, "_n", "_g")
        .agg(F.count("*").alias("_reads"))
    )
    claims = (
        cells.select("_n")
        .distinct()
        .select("_n", F.explode(F.sequence(F.lit(0), n)).alias("_g"))
        .select("_n", F.explode(_percent_range(g, n)).alias("gc"))
        .groupBy("_n", "gc")
        .agg(F.count("*").alias("_claims"))
    )
    hits = cells.select(*by, "_n", "_reads", F.explode(_percent_range(g, n)).alias("gc"))
    hist = (
        hits.join(claims, ["_n", "gc"])
        .groupBy(*by, "gc")
        .agg(F.sum(F.col("_reads") / F.col("_claims")).alias("n_reads"))
    )
    filled = dense(hist, by, "gc", "n_reads", F.lit(0), F.lit(100))
    return filled.withColumn("n_reads", F.col("n_reads").cast("double"))


def length_distribution(reads: DataFrame, by: Sequence[str] = SAMPLE) -> DataFrame:
    """Q7: reads per length."""
    return reads.groupBy(*by, F.length("seq").alias("length")).agg(F.count("*").alias("n_reads"))


def sequence_counts(reads: DataFrame, by: Sequence[str] = SAMPLE, key_len: int = 50) -> DataFrame:
    """Copies of each distinct sequence, cut to its first ``key_len`` bases.

    The one wide aggregate behind Q8 and Q9. Copies collapse on the map side, so a
    sequence that makes up a third of all reads costs one row per map task.
    """
    return reads.groupBy(*by, F.substring("seq", 1, key_len).alias("seq_key")).agg(F.count("*").alias("copies"))


def _duplication_bin(copies: Column) -> Column:
    label = F.lit(DUPLICATION_BINS[-1][0])
    for name, top in reversed(DUPLICATION_BINS[:-1]):
        label = F.when(copies <= top, F.lit(name)).otherwise(label)
    return label


def duplication_levels(reads: DataFrame, by: Sequence[str] = SAMPLE, key_len: int = 50) -> DataFrame:
    """Q8: share of all reads per duplication level, and the share left after
    deduplication (``dedup_pct``, the same in every row of a sample)."""
    per_bin = (
        sequence_counts(reads, by, key_len)
        .groupBy(*by, _duplication_bin(F.col("copies")).alias("level"))
        .agg(F.sum("copies").alias("_reads"), F.count("*").alias("_distinct"))
    )
    labels = F.array(*[F.lit(name) for name, _ in DUPLICATION_BINS])
    cells = per_bin.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("level", "_reads"))).alias("_cells"),
        F.sum("_reads").alias("_total"),
        F.sum("_distinct").alias("_distinct"),
    )
    return cells.withColumn("level", F.explode(labels)).select(
        *by,
        "level",
        percent(F.coalesce(F.element_at("_cells", F.col("level")), F.lit(0).cast("long")), F.col("_total")).alias("pct_of_total"),
        percent(F.col("_distinct"), F.col("_total")).alias("dedup_pct"),
    )


def possible_source(seq: Column, contaminants: dict[str, str]) -> Column:
    """Name of the first contaminant contained in ``seq`` or containing it."""
    source = F.lit("No Hit")
    for name, probe in reversed(list(contaminants.items())):
        source = F.when(seq.contains(probe) | F.lit(probe).contains(seq), F.lit(name)).otherwise(source)
    return source


def overrepresented(
    reads: DataFrame,
    by: Sequence[str] = SAMPLE,
    min_pct: float = 0.1,
    contaminants: dict[str, str] = ADAPTERS,
    key_len: int = 50,
) -> DataFrame:
    """Q9: sequences that make up more than ``min_pct`` percent of a sample.

    The total per sample comes from the same sequence aggregate; it is one row per
    sample and is joined back, never windowed over the distinct sequences.
    """
    counts = sequence_counts(reads, by, key_len)
    totals = reads.groupBy(*by).agg(F.count("*").alias("_total"))
    share = percent(F.col("copies"), F.col("_total"))
    return (
        counts.join(F.broadcast(totals), list(by))
        .where(share > min_pct)
        .select(
            *by,
            F.col("seq_key").alias("sequence"),
            F.col("copies").alias("n_reads"),
            share.alias("pct"),
            possible_source(F.col("seq_key"), contaminants).alias("possible_source"),
        )
    )


def overrepresented_sources(
    reads: DataFrame,
    by: Sequence[str] = SAMPLE,
    min_pct: float = 0.1,
    contaminants: dict[str, str] = ADAPTERS | CONTAMINANTS,
    least: int = 20,
) -> DataFrame:
    """Q9 with the sources found by stretches of ``least`` bases with one mismatch.

    (by, sequence, n_reads, pct, possible_source, matched, length): the hit's equal bases and its length.
    """
    found = overrepresented(reads, by, min_pct, {}).drop("possible_source")
    found = found.withColumn("_hit", best_source("sequence", contaminants, least))
    names = {"possible_source": "source", "matched": "matched", "length": "length"}
    return found.select(*by, "sequence", "n_reads", "pct", *[F.col(f"_hit.{c}").alias(n) for n, c in names.items()])


def column_name(adapter: str) -> str:
    """Adapter name as a column name: letters and digits in lower case, ``_`` between."""
    return "_".join("".join(c if c.isalnum() else " " for c in adapter.replace("'", "")).lower().split())


def adapter_content(
    reads: DataFrame, by: Sequence[str] = SAMPLE, adapters: dict[str, str] = ADAPTERS
) -> DataFrame:
    """Q10: cumulative share of reads whose first adapter hit starts at or before pos.

    One pass: a read gives one row that counts it (adapter null) and one row per
    adapter found. Positions run from 1 to the last start that fits the longest read.
    """
    width = max(len(a) for a in adapters.values())
    n = F.length("seq")
    entries = [F.struct(F.lit(-1).alias("adapter"), F.lit(0).alias("pos"), n.alias("len"))]
    for i, probe in enumerate(adapters.values()):
        entries.append(F.struct(F.lit(i).alias("adapter"), F.instr("seq", probe).alias("pos"), n.alias("len")))
    hist = (
        reads.select(*by, F.inline(F.array(*entries)))
        .where((F.col("adapter") < 0) | (F.col("pos") > 0))
        .groupBy(*by, "adapter", "pos")
        .agg(F.count("*").alias("n"), F.max("len").alias("max_len"))
    )
    # A counting row becomes one zero cell per position; a hit row stays as it is.
    last = F.col("max_len") - width + 1
    zeros = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    cells = hist.select(
        *by,
        "adapter",
        F.when(F.col("adapter") < 0, F.col("n")).otherwise(0).alias("reads"),
        F.when(F.col("adapter") >= 0, F.col("n")).otherwise(0).alias("hits"),
        F.explode(F.when(F.col("adapter") < 0, zeros).otherwise(F.array("pos"))).alias("pos"),
    )
    names = [column_name(a) for a in adapters]
    per_pos = cells.groupBy(*by, "pos").agg(
        F.max("reads").alias("_total"),
        *[F.sum(F.when(F.col("adapter") == i, F.col("hits")).otherwise(0)).alias(c) for i, c in enumerate(names)],
    )
    up_to = Window.partitionBy(*by).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return per_pos.select(
        *by, "pos", *[percent(F.sum(c).over(up_to), F.col("_total")).alias(c) for c in names]
    )


def gc_deviation(gc_hist: DataFrame, by: Sequence[str] = SAMPLE) -> DataFrame:
    """Sum of |observed - expected normal| over the GC histogram, as % of its total.

    The curve is centred on the histogram's peak: the middle of the bins next to the
    highest one that are above nine tenths of it; the highest bin itself if they reach an
    end of the scale. Its spread is that of the histogram around the peak.
    """
    n, x = F.col("n_reads").cast("double"), F.col("gc").cast("double")
    cell = Window.partitionBy(*by)  # the 101 bins of one sample
    top = F.first("gc").over(cell.orderBy(F.desc("n_reads"), "gc"))
    low = n <= 0.9 * F.col("_highest")
    # The nearest low bins on either side of the highest one.
    above = F.min(F.when(low & (x > F.col("_top")), x)).over(cell)
    below = F.max(F.when(low & (x < F.col("_top")), x)).over(cell)
    peak = F.coalesce((F.col("_above") + F.col("_below")) / 2.0, F.col("_top"))
    # A sample whose reads all have the same GC share gets a narrow curve, not 0 / 0.
    variance = F.greatest(F.col("_s2") / F.greatest(F.col("_total") - 1, F.lit(1.0)), F.lit(0.25))
    away = (x - F.col("_peak")) * (x - F.col("_peak"))
    expected = F.col("_total") * F.exp(-away / (2.0 * F.col("_variance"))) / F.sqrt(2.0 * F.pi() * F.col("_variance"))
    return (
        gc_hist.withColumn("_total", F.sum(n).over(cell))
        .withColumn("_highest", F.max(n).over(cell))
        .withColumn("_top", top.cast("double"))
        .withColumn("_above", above)
        .withColumn("_below", below)
        .withColumn("_peak", peak)
        .withColumn("_s2", F.sum(n * away).over(cell))
        .withColumn("_variance", variance)
        .groupBy(*by)
        .agg((100.0 * F.sum(F.abs(n - expected)) / F.max("_total")).alias("gc_deviation"))
    )


# Module, measure, side of the limit that is bad, WARN limit, FAIL limit (strict).
THRESHOLDS = [
    ("Basic Statistics", "total_sequences", "below", None, None),
    ("Per base sequence quality", "min_lower_quartile", "below", 10.0, 5.0),
    ("Per base sequence quality", "min_median", "below", 25.0, 20.0),
    ("Per sequence quality scores", "mode_quality", "below", 27.0, 20.0),
    ("Per base sequence content", "max_base_difference", "above", 10.0, 20.0),
    ("Per sequence GC content", "gc_deviation", "above", 15.0, 30.0),
    ("Per base N content", "max_pct_n", "above", 5.0, 20.0),
    ("Sequence Length Distribution", "length_spread", "above", 0.0, None),
    ("Sequence Length Distribution", "min_length", "below", None, 1.0),
    ("Sequence Duplication Levels", "dedup_pct", "below", 70.0, 50.0),
    ("Overrepresented sequences", "max_sequence_pct", "above", 0.1, 1.0),
    ("Adapter Content", "max_adapter_pct", "above", 5.0, 10.0),
]
THRESHOLD_SCHEMA = "module string, measure string, bad string, warn double, fail double"


def _long(row_per_sample: DataFrame, by: Sequence[str], measures: list[str]) -> DataFrame:
    pairs = [F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]
    return row_per_sample.select(*by, F.inline(F.array(*pairs)))


def _largest_adapter(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, max_adapter_pct): the adapter share at the last position, where all hits count.

    No row where no read is as long as a probe.
    """
    width = max(len(a) for a in ADAPTERS.values())
    is_read, is_hit = F.col("kind") == "read", F.col("kind") == "adapter"
    hits = [F.coalesce(F.sum(F.when(is_hit & (F.col("a") == i), F.col("n"))), F.lit(0)) for i in range(len(ADAPTERS))]
    totals = cells.groupBy(*by).agg(
        F.sum(F.when(is_read, F.col("n"))).alias("reads"),
        F.max(F.when(is_read, F.col("a"))).alias("last"),
        F.greatest(*hits).alias("hits"),
    )
    share = percent(F.col("hits"), F.col("reads"))
    return totals.where(F.col("last") >= width).select(*by, share.alias("max_adapter_pct"))


def stage_metrics(reads: DataFrame, by: Sequence[str] = ("sample", "stage")) -> DataFrame:
    """(by, metric, value) behind the summary table, from one pass over the reads.

    Read and base counts, mean length, Q20 %, Q30 %, %GC, share left after
    deduplication and the largest adapter share.
    """
    cells, copies = cells_and_copies(reads, by)

    def total(kind: str, counted: Column | None = None) -> Column:
        return F.coalesce(F.sum(F.when((F.col("kind") == kind) & (F.lit(True) if counted is None else counted), F.col("n"))), F.lit(0))

    symbol = F.chr(F.col("b"))
    sums = cells.groupBy(*by).agg(
        total("read").alias("reads"),
        total("base").alias("bases"),
        total("score").alias("_scores"),
        total("score", F.col("b") >= 20).alias("_q20"),
        total("score", F.col("b") >= 30).alias("_q30"),
        total("base", symbol.isin("G", "C")).alias("_gc"),
        total("base", symbol.isin("A", "C", "G", "T")).alias("_acgt"),
    )
    basic = sums.select(
        *by,
        "reads",
        "bases",
        (F.col("bases").cast("double") / F.col("reads")).alias("mean_length"),
        percent(F.col("_q20"), F.col("bases")).alias("q20_pct"),
        percent(F.col("_q30"), F.col("bases")).alias("q30_pct"),
        int_div(100 * F.col("_gc"), F.col("_acgt")).alias("gc_pct"),
    )
    copies = copies.select(*by, percent(F.col("distinct"), F.col("reads")).alias("dedup_pct"))
    out = _long(basic, by, ["reads", "bases", "mean_length", "q20_pct", "q30_pct", "gc_pct"])
    out = out.unionByName(_long(copies, by, ["dedup_pct"])).unionByName(_long(_largest_adapter(cells, by), by, ["max_adapter_pct"]))
    return out.withColumnRenamed("measure", "metric")


def qc_measures(reads: DataFrame, by: Sequence[str] = SAMPLE) -> DataFrame:
    """The numbers the verdicts are drawn from: (by, measure, value).

    One pass over the reads feeds all of them: the counted cells, and the copies per
    sequence. Both are computed at once and checkpointed, so that the measures, eight plans over
    the cells, are not planned on top of the reads' own plan eight times.
    """
    cells, copies = cells_and_copies(reads, by)
    each = _of_kind(cells, "read", by, a="length", b="quality", c="gc")
    basic = each.groupBy(*by).agg(
        F.sum("n").alias("total_sequences"),
        F.min("length").alias("min_length"),
        (F.max("length") - F.min("length")).alias("length_spread"),
    )
    # Conditions on a cell's values stand inside the aggregates: as filters they would be
    # pushed below the shuffle of the cells, which all measures are to share.
    per_score = each.groupBy(*by, "quality").agg(F.sum("n").alias("n_reads"))
    # Highest count wins, the lower score among equals.
    score = F.when(F.col("quality") >= 0, F.struct("n_reads", (-F.col("quality")).alias("q")))
    mode = per_score.groupBy(*by).agg((-F.max(score)["q"]).alias("mode_quality"))
    per_gc = each.groupBy(*by, F.when(F.col("gc") >= 0, F.col("gc")).alias("gc")).agg(F.sum("n").alias("n_reads"))
    gc = gc_deviation(dense(per_gc, by, "gc", "n_reads", F.lit(0), F.lit(100)), by)
    quality = (
        _score_percentiles(cells, by)
        .groupBy(*by)
        .agg(F.min("q1").alias("min_lower_quartile"), F.min("median").alias("min_median"))
    )
    bases = _bases(cells, by)
    content = (
        _content(bases, by)
        .groupBy(*by)
        .agg(
            F.max(
                F.greatest(F.abs(F.col("pct_a") - F.col("pct_t")), F.abs(F.col("pct_g") - F.col("pct_c")))
            ).alias("max_base_difference")
        )
    )
    unknown = _n_content(bases, by).groupBy(*by).agg(F.max("pct_n").alias("max_pct_n"))
    copies = copies.select(
        *by,
        percent(F.col("distinct"), F.col("reads")).alias("dedup_pct"),
        percent(F.col("most"), F.col("reads")).alias("max_sequence_pct"),
    )
    adapters = _largest_adapter(cells, by)
    out = _long(basic, by, ["total_sequences", "min_length", "length_spread"])
    for table, measures in [
        (quality, ["min_lower_quartile", "min_median"]),
        (mode, ["mode_quality"]),
        (content, ["max_base_difference"]),
        (unknown, ["max_pct_n"]),
        (gc, ["gc_deviation"]),
        (copies, ["dedup_pct", "max_sequence_pct"]),
        (adapters, ["max_adapter_pct"]),
    ]:
        out = out.unionByName(_long(table, by, measures))
    return out


def verdicts(measures: DataFrame, by: Sequence[str] = SAMPLE, thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """Q11: PASS / WARN / FAIL per module; a module takes its worst measure."""
    limits = measures.sparkSession.createDataFrame(thresholds, THRESHOLD_SCHEMA)

    def beyond(limit: str) -> Column:
        side = F.when(F.col("bad") == "above", F.col("value") > F.col(limit)).otherwise(F.col("value") < F.col(limit))
        return F.coalesce(side, F.lit(False))

    level = F.when(beyond("fail"), 2).when(beyond("warn"), 1).otherwise(0)
    return (
        measures.join(F.broadcast(limits), "measure")  # one row per threshold
        .groupBy(*by, "module")
        .agg(F.max(level).alias("_level"))
        .select(
            *by,
            "module",
            F.when(F.col("_level") == 2, "FAIL").when(F.col("_level") == 1, "WARN").otherwise("PASS").alias("status"),
        )
    )


def qc_compare(metrics: DataFrame, before: str = "raw", after: str = "trimmed") -> DataFrame:
    """Q12: (sample, metric, before, after, delta) from (sample, stage, metric, value)."""

    def at(stage: str) -> Column:
        return F.max(F.when(F.col("stage") == stage, F.col("value")))

    return (
        metrics.groupBy("sample", "metric")
        .agg(at(before).alias("before"), at(after).alias("after"))
        .withColumn("delta", F.col("after") - F.col("before"))
    )
