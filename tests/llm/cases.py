"""Awkward rows for every operator: nulls, empty and long texts, repeats, clashing columns."""

LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))

AWKWARD = [
    (1, "plain words of a short text"),
    (2, None),
    (3, ""),
    (4, " \t\n\n "),
    (5, LONG),
    (None, "a text without an id"),
    (7, "plain words of a short text"),
    (7, "plain words of a short text"),
    (8, "one\ntwo\nthree\nfour\none\ntwo\nthree"),
    (9, "Ünïcödé \U0001f600 中文 \x00 ́"),
]


def documents(spark, rows=AWKWARD, **extra):
    """doc_id, text, lang, source, n_chars and constant columns with clashing names."""
    full = [(i, t, ("en", None)[n % 2], ("src0", None, "src1")[n % 3], None) for n, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    for name, value in extra.items():
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit(value))
    return df


def empty(spark):
    return documents(spark).where("false")


def rows(df, *columns):
    """Rows as tuples, ordered by their text form."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
