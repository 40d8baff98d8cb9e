"""SRC-5 as a connector: a Python ``DataSource`` over stored page documents.

A fetch stores the page documents of its commands (D5: command, page number,
results, continuation token and the wanted count) under ``fetch=<n>`` of a
shared folder, dealt by command into ``chains=<k>`` folders of Parquet files.
Pages of a command form a chain: each full page names the next one by its
continuation token.  A chain lies whole in one file, in page order.

The reader plans one partition per fetch and chains folder (a partition per
single chain would be millions of tasks), and in it follows every chain from its
first page along the tokens, holding one record batch at a time: a page is read
only if the page before was full and named it, and rows stop at the wanted
count.  Equality filters on ``command_id`` are pushed down: they leave out whole
folders when the partitions are planned, and row groups when they are read.

The stream reader's offset is the number of the last stored fetch.  A fetch
counts as stored once its ``_SUCCESS`` mark is there, so a write in progress is
read by a later batch.  Restarts resume behind the last committed offset.

Defined results: an empty folder gives no rows; a chain without its first page,
a page that no token names, and pages after a short one are not read; a null
wanted count reads nothing; null command ids are a chain of their own.  The
files are read through Arrow, so their store must be one that Arrow reads
(local or shared folders, HDFS, S3, GCS).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, In,
                                    InputPartition)

# executors need no copy of the package to run the reader
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "feedback_pages"
CHAINS = 8
SCHEMA = "command_id bigint, page_no bigint, pos bigint, review_id bigint"


# -- storing pages ----------------------------------------------------------

def chains_of(command_id: Column, n: int) -> Column:
    """The chains folder of a command."""
    return (F.crc32(F.coalesce(command_id.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def folder_of(command_id, n: int) -> int:
    from zlib import crc32

    return crc32(("" if command_id is None else str(command_id)).encode()) % n


def store_pages(pages: DataFrame, path: str, fetch: int = 0, chains: int = CHAINS) -> None:
    """Store a fetch: ``command_id, page_no, results (array of structs with a
    review_id), continuation_token, fetch_n``.  A repeated fetch number
    replaces that fetch."""
    docs = pages.select("command_id", "page_no", F.transform("results", lambda r: r["review_id"]).alias("results"),
                        "continuation_token", "fetch_n")
    key = F.coalesce(F.col("command_id").cast("string"), F.lit(""))
    (docs.withColumn("chains", chains_of(F.col("command_id"), chains))
     .repartition("chains", key).sortWithinPartitions("chains", "command_id", "page_no")
     .write.mode("overwrite").partitionBy("chains").parquet(f"{path.rstrip('/')}/fetch={int(fetch)}"))


# -- following chains -------------------------------------------------------

def walk(pages, page_size: int, state: dict) -> Iterator[tuple]:
    """(command_id, page_no, how many results to take, place in ``pages``) of
    the pages that are read, of pages (command_id, page_no, n results, token,
    wanted) in order.  ``state`` carries the chain over to the next call."""
    for i, (command, page, n, token, wanted) in enumerate(pages):
        if not state or state["command"] != command:
            state.update(command=command, seen=0, next=f"{command}:1")
        if state["next"] != f"{command}:{page}" or wanted is None or state["seen"] >= wanted:
            continue
        take = min(n, wanted - state["seen"])
        state.update(seen=state["seen"] + take, next=token if n == page_size else None)
        if take > 0:
            yield command, page, take, i


class Pages(InputPartition):
    def __init__(self, folder: str | None, commands: list | None):
        self.folder, self.commands = folder, commands


def read_folder(part: Pages, page_size: int, batch_rows: int) -> Iterator:
    """The rows of a chains folder as Arrow batches."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.dataset as ds

    kept = pc.field("command_id").isin(part.commands) if part.commands is not None else None
    names = ["command_id", "page_no", "results", "continuation_token", "fetch_n"]
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(uri_of(part.folder))
    for fragment in ds.dataset(folder, filesystem=store, format="parquet").get_fragments(filter=kept):
        state: dict = {}
        for batch in fragment.to_batches(columns=names, filter=kept, batch_size=batch_rows):
            results, rest = batch.column(2), [batch.column(i).to_pylist() for i in (0, 1, 3, 4)]
            sizes = np.asarray(pc.fill_null(pc.list_value_length(results), 0), np.int64)
            found = list(walk(zip(rest[0], rest[1], sizes.tolist(), rest[2], rest[3]), page_size, state))
            if not found:
                continue
            takes = np.array([f[2] for f in found])
            starts = np.cumsum(sizes) - sizes
            pos = np.arange(takes.sum()) - np.repeat(np.cumsum(takes) - takes, takes)
            at = np.repeat(starts[[f[3] for f in found]], takes) + pos
            yield pa.RecordBatch.from_arrays([
                pa.array([f[0] for f in found], pa.int64()).take(pa.array(np.repeat(np.arange(len(found)), takes))),
                pa.array(np.repeat(np.array([f[1] for f in found], np.int64), takes)),
                pa.array(pos + 1, pa.int64()),
                results.flatten().take(pa.array(at))], names=["command_id", "page_no", "pos", "review_id"])


# -- readers ----------------------------------------------------------------

def uri_of(path: str) -> str:
    """A plain path, or one with Hadoop's single slash, as a URI for Arrow."""
    if path.startswith("/"):
        return f"file://{path}"
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and "://" not in path else path


def list_names(path: str) -> list[str]:
    """Names inside a folder; none if it is not there."""
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(uri_of(path))
    return [x.base_name for x in store.get_file_info(fs.FileSelector(inner, allow_not_found=True))]


def stored(path: str) -> dict[int, list[str]]:
    """The chains folders of each stored fetch."""
    out = {}
    for name in list_names(path):
        if name.startswith("fetch="):
            inside = list_names(f"{path}/{name}")
            if "_SUCCESS" in inside:
                out[int(name[6:])] = sorted(f"{path}/{name}/{x}" for x in inside if x.startswith("chains="))
    return out


class Following:
    """What the two readers share."""

    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.page_size = int(options.get("page_size", 20))
        self.chains = int(options.get("chains", CHAINS))
        self.batch_rows = int(options.get("batch_rows", 4096))
        self.commands: list | None = None

    def planned(self, folders: list[str]) -> list[Pages]:
        if self.commands is not None:
            hit = {f"chains={folder_of(c, self.chains)}" for c in self.commands}
            folders = [f for f in folders if f.rsplit("/", 1)[1] in hit]
        # Spark wants a partition to read even if there is no folder
        return [Pages(f, self.commands) for f in folders] or [Pages(None, None)]

    def read(self, partition):
        return read_folder(partition, self.page_size, self.batch_rows) if partition.folder else iter(())


class PageReader(Following, DataSourceReader):
    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("command_id",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.commands = sorted(wanted if self.commands is None else wanted & set(self.commands))
            else:
                yield f

    def partitions(self):
        return self.planned([f for _, folders in sorted(stored(self.path).items()) for f in folders])


class PageStreamReader(Following, DataSourceStreamReader):
    def initialOffset(self):
        return {"fetch": -1}

    def latestOffset(self):
        return {"fetch": max(stored(self.path), default=-1)}

    def partitions(self, start, end):
        return self.planned([f for n, folders in sorted(stored(self.path).items())
                             if start["fetch"] < n <= end["fetch"] for f in folders])

    def commit(self, end):
        pass


class PageSource(DataSource):
    """``spark.read.format("feedback_pages").option("path", ...)``; options
    ``page_size``, ``chains`` (as stored) and ``batch_rows``."""

    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PageReader(self.options)

    def streamReader(self, schema):
        return PageStreamReader(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageSource)


def read_pages(spark: SparkSession, path: str, chains: int = CHAINS, page_size: int = 20) -> DataFrame:
    """The rows that a cursor read of all stored fetches gives: ``command_id,
    page_no, pos, review_id``."""
    register(spark)
    return spark.read.format(NAME).option("chains", chains).option("page_size", page_size).load(path)


def stream_pages(spark: SparkSession, path: str, chains: int = CHAINS, page_size: int = 20) -> DataFrame:
    """The same rows as a stream over fetches."""
    register(spark)
    return spark.readStream.format(NAME).option("chains", chains).option("page_size", page_size).load(path)
