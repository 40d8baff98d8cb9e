"""Shared pieces of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsift.session import ensure_checkpoint_dir

#: White space of the operators' word rules, as a Java character class.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % F.lit(n), F.lit(0))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder that
    the cluster names; it is removed with the frame where the cluster's
    cleaner is on."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch, text_at: int, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of an Arrow batch whose texts hold about ``most`` bytes
    (one row at least, so a longer text forms a range of its own)."""
    import numpy as np
    import pyarrow.compute as pc

    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text_at)), 0)
    ends = np.cumsum(np.asarray(size, dtype=np.int64))
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield start, stop
        start = stop


def one_label(labels: DataFrame, id_col: str, label: Column) -> DataFrame:
    """(id, y), one row per id with a label: repeated rows count once, and an
    id whose rows disagree has none.  Repeats combine on the map side."""
    rows = labels.select(col(id_col).alias("id"), label.alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    return rows.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("most")).where("y = most").drop("most")


def bounded_sample(df: DataFrame, most: int, *by: Column) -> DataFrame:
    """The ``most`` distinct rows of the smallest hash of ``by`` (the same
    rows on every run); copies of a row count once.  ``by`` must tell distinct
    rows apart.  Only hashes are shuffled and, for the bound, sorted."""
    hashes = df.select(F.xxhash64(*by).alias("hash")).distinct().orderBy("hash").limit(most)
    last = hashes.agg(F.max("hash")).first()[0]
    if last is None:
        return df.limit(0)
    # a hash of two rows is split by the rows themselves
    return df.where(F.xxhash64(*by) <= last).distinct().orderBy(F.xxhash64(*by), *by).limit(most)


def release() -> None:
    """Give Arrow memory that a task no longer uses back to the system:
    idle Python workers stay on an executor and would keep it."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
