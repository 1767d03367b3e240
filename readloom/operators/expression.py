"""Count matrices and expression (E5-E15, S17, P7-P11 on matrices).

Matrices are long: (gene_id, sample, value). They are pivoted only where a wide table
is asked for. Per-sample totals have one row per sample; that is the proven bound
behind the broadcasts here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intervals import with_samples


def count_matrix(assigned: DataFrame, gene_lengths: DataFrame, samples: DataFrame) -> DataFrame:
    """E5: every annotated gene x every sample, 0 where nothing was counted.

    ``assigned(gene_id, sample, count)`` is already aggregated, ``samples`` any table
    with a sample column that names them all.
    """
    grid = with_samples(gene_lengths.select("gene_id", "length"), samples)
    return grid.join(assigned, ["gene_id", "sample"], "left").select(
        "gene_id", "sample", F.coalesce("count", F.lit(0).cast("long")).alias("count"), "length"
    )


def wide(
    matrix: DataFrame,
    value: str,
    samples: Sequence[str],
    keys: Sequence[str] = ("gene_id", "length"),
    fill: bool = True,
) -> DataFrame:
    """Long -> wide for a known list of samples; missing cells become 0."""
    def cell(sample: str) -> Column:
        x = F.max(F.when(F.col("sample") == sample, F.col(value)))
        return (F.coalesce(x, F.lit(0)) if fill else x).alias(sample)

    return matrix.groupBy(*keys).agg(*[cell(s) for s in samples])


def counts_only(counts: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Geneid, Length and one count column per sample."""
    return (
        wide(counts, "count", samples)
        .withColumnsRenamed({"gene_id": "Geneid", "length": "Length"})
        .select("Geneid", "Length", *samples)
    )


def unpivot_matrix(
    matrix: DataFrame, samples: Sequence[str], value: str = "count", keys: Sequence[str] = ("Geneid", "Length")
) -> DataFrame:
    """Wide -> long."""
    return matrix.unpivot(list(keys), list(samples), "sample", value)


def library_size(counts: DataFrame) -> DataFrame:
    """Total count per sample."""
    return counts.groupBy("sample").agg(F.sum("count").cast("long").alias("library_size"))


def cpm(counts: DataFrame) -> DataFrame:
    """Counts per million."""
    sizes = library_size(counts)
    value = F.col("count").cast("double") / F.nullif(F.col("library_size"), F.lit(0)) * 1_000_000
    return counts.join(F.broadcast(sizes), "sample").select("gene_id", "sample", "length", "count", value.alias("cpm"))


def _rpk() -> Column:
    return F.col("count").cast("double") / (F.col("length").cast("double") / 1000.0)


def rpk(counts: DataFrame) -> DataFrame:
    """Counts per kilobase of gene."""
    return counts.select("gene_id", "sample", "length", "count", _rpk().alias("rpk"))


def tpm(counts: DataFrame, with_samples: bool = False) -> DataFrame:
    """Rpk scaled so that each sample sums to one million.

    With ``with_samples`` each row also says how many samples there are, counted on the
    table of scales.
    """
    values = rpk(counts)
    scale = values.groupBy("sample").agg((F.sum("rpk") / 1_000_000).alias("_scale"))
    columns = ["gene_id", "sample", "length", "count", "rpk"]
    if with_samples:
        scale = scale.withColumn("n_samples", F.count("*").over(Window.partitionBy(F.lit(0))))  # one row per sample
        columns.append("n_samples")
    value = F.col("rpk") / F.nullif(F.col("_scale"), F.lit(0.0))
    return values.join(F.broadcast(scale), "sample").select(*columns, value.alias("tpm"))


def mean_tpm(tpm_matrix: DataFrame, n_samples: int | None = None) -> DataFrame:
    """Mean over all samples; a gene missing in a sample counts as 0 there.

    ``n_samples``: the number of sample columns, if it is known; else a column of that name
    in ``tpm_matrix`` says so.
    """
    if n_samples is None and "n_samples" not in tpm_matrix.columns:
        raise ValueError("name the number of samples, or make the matrix with_samples")
    n = F.lit(n_samples) if n_samples else F.max("n_samples")
    return tpm_matrix.groupBy("gene_id", "length").agg((F.sum("tpm") / n).alias("mean_tpm"))


def top_genes(tpm_matrix: DataFrame, n: int = 20, n_samples: int | None = None) -> DataFrame:
    """The ``n`` genes with the highest mean, gene id ascending among equals; ranked from 1.

    The ranking window runs over the ``n`` chosen genes only.
    """
    best = mean_tpm(tpm_matrix, n_samples).orderBy(F.desc("mean_tpm"), "gene_id").limit(n)
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("mean_tpm"), "gene_id")
    return best.withColumn("rank", F.row_number().over(order))


def plot_table(tpm_matrix: DataFrame, samples: Sequence[str], n: int = 20) -> DataFrame:
    """Top genes with rank, TPM per sample and the mean."""
    top = top_genes(tpm_matrix, n, len(samples)).select("gene_id", "mean_tpm", "rank")
    cells = tpm_matrix.join(F.broadcast(top), "gene_id")  # at most n genes
    return wide(cells, "tpm", samples, ("gene_id", "length", "mean_tpm", "rank"))


def wide_table(matrix: DataFrame, value: str, samples: Sequence[str]) -> DataFrame:
    """Wide CPM or TPM as the tables of the workflow have it: Geneid, Length, one column per sample."""
    return (
        wide(matrix, value, samples)
        .withColumnsRenamed({"gene_id": "Geneid", "length": "Length"})
        .select("Geneid", "Length", *samples)
    )


def top_table(tpm_matrix: DataFrame, samples: Sequence[str], n: int = 20) -> DataFrame:
    """The top genes as a wide TPM table with mean_TPM, best first."""
    table = plot_table(tpm_matrix, samples, n).withColumnsRenamed(
        {"gene_id": "Geneid", "length": "Length", "mean_tpm": "mean_TPM"}
    )
    return table.select("Geneid", "Length", *samples, "mean_TPM", "rank").orderBy("rank")


def log2_matrix(tpm_matrix: DataFrame, samples: Sequence[str], n: int = 20) -> DataFrame:
    """log2(TPM + 1) of the top genes, one column per sample."""
    table = plot_table(tpm_matrix, samples, n)
    return table.select("gene_id", *[F.log2(F.col(s) + 1).alias(s) for s in samples])


def heatmap_cells(tpm_matrix: DataFrame, samples: Sequence[str], n: int = 20) -> DataFrame:
    """(row, col, gene, sample, value) cells of the log2 heatmap.

    Rows follow the rank of the gene, columns the order of ``samples``.
    """
    table = plot_table(tpm_matrix, samples, n)
    cells = [
        F.struct(F.lit(i).alias("col"), F.lit(s).alias("sample"), F.log2(F.col(s) + 1).alias("value"))
        for i, s in enumerate(samples)
    ]
    return table.select((F.col("rank") - 1).alias("row"), "gene_id", F.inline(F.array(*cells)))


def shape_report(matrix: DataFrame, keys: Sequence[str] = ("Geneid", "Length")) -> DataFrame:
    """Genes x samples and the sample columns of a wide matrix."""
    samples = [c for c in matrix.columns if c not in keys]
    return matrix.agg(F.count("*").alias("n_genes")).select(
        "n_genes",
        F.lit(len(samples)).cast("long").alias("n_samples"),
        F.lit(",".join(samples)).alias("sample_columns"),
    )


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cells that are not numbers become 0."""
    return df.withColumns({c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in columns})


def _sample_of(path: Column, samples: Sequence[str]) -> Column:
    """The last name in ``samples`` that ``path`` contains; null if there is none."""
    return F.coalesce(*[F.when(F.contains(path, F.lit(s)), F.lit(s)) for s in reversed(samples)])


def rename_by_sample(long_counts: DataFrame, samples: Sequence[str], path: str = "path") -> DataFrame:
    """P8, long form: alignment-file paths become sample ids; other names stay."""
    name = F.col(path)
    renamed = F.when(F.endswith(name, F.lit(".bam")), F.coalesce(_sample_of(name, samples), name)).otherwise(name)
    return long_counts.withColumn("sample", renamed).drop(path)


def rename_columns_by_sample(matrix: DataFrame, samples: Sequence[str]) -> DataFrame:
    """P8, wide form: the same rule on column names (no job)."""
    renames = {}
    for c in matrix.columns:
        hits = [s for s in samples if s in c]
        if c.endswith(".bam") and hits:
            renames[c] = hits[-1]
    return matrix.withColumnsRenamed(renames)


def select_samples(df: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Keep listed samples that are present.

    A wide matrix is checked on its columns. A long one (with a ``sample`` column) is
    filtered, and the job fails if no listed sample is in it.
    """
    if "sample" not in df.columns:
        present = [s for s in samples if s in df.columns]
        if not present:
            raise ValueError(f"none of the samples {list(samples)} is a column")
        return df.select(*[c for c in df.columns if c in ("Geneid", "Length", "gene_id", "length")], *present)
    listed = F.col("sample").isin(*samples)
    hits = df.where(listed).agg(F.count("*")).scalar()
    message = F.lit(f"none of the samples {list(samples)} is present")
    return df.where(listed | F.when(hits == 0, F.raise_error(message).cast("boolean")).otherwise(False))


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P10: fail, without a job, if a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing expected columns: {missing}")
    return df


def drop_metadata(matrix: DataFrame, metadata: Sequence[str] = ("Length",)) -> DataFrame:
    """Counts only, with the gene column called gene_id."""
    return matrix.drop(*metadata).withColumnsRenamed({"Geneid": "gene_id"})
