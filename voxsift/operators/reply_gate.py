"""FLT-13 / SNK-6 / SNK-7: model replies split into accepted ones and rejects in one pass.

A step states which fields its reply needs and which JSON types they may have
(and, for an index, which values).  ``gate`` reads every reply of every step as
VARIANT and gives the first fault that applies: no reply, corrupt JSON, not an
object, a missing field, a field of another type, a value out of range.  The
decisions themselves stay fail-open (FLT-3, FLT-4): a reject is a record that a
reply could not be used as told, not a dropped review.

Plan: the steps' replies are one array in the row and one explode, so the input
is read once however many steps there are; there is no shuffle.  ``write_split``
writes both sides in the same pass, as partitions of one table, and counts them
as the rows flow.

Defined results: a null or blank reply is ``no reply``; extra fields are
allowed; every row and step gives one row, repeats too; an empty table gives
none; key columns may have any name but ``step``, ``reply``, ``error``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from voxsift.functions.replies import field_type, is_duplicate, match_index, parse_reply


@dataclass(frozen=True)
class Needs:
    """A field that a reply must have, and the JSON types that it may have."""

    field: str
    types: tuple[str, ...]


RELEVANCE = (Needs("relevance", ("string",)),)
#: Of a reply that says "duplicate", this field must be an index from 0.
INDEX = Needs("match_with", ("number", "string"))
DUPLICATE = (Needs("is_duplicate", ("string",)), INDEX)


def _fault(needs: tuple[Needs, ...], kinds: Mapping[str, Column]) -> Column:
    """The first fault of a reply that has been read, null if it has none."""
    blank = F.col("reply").isNull() | (F.trim("reply") == "")
    out = F.when(blank, "no reply").when(F.col("_whole").isNull(), "not JSON").when(
        ~F.col("_whole").startswith("OBJECT"), "not an object")
    for need in needs:
        kind = kinds[need.field]
        out = out.when(kind.isNull(), f"{need.field} missing").when(
            ~kind.isin(*need.types), F.concat(F.lit(f"{need.field} is "), kind))
    if INDEX in needs:
        out = out.when(F.col("_repeat") & (F.col("_at").isNull() | (F.col("_at") < 0)), "match_with is no index")
    return out


def gate(rows: DataFrame, key: list[str], replies: Mapping[str, tuple[str, tuple[Needs, ...]]],
         strip_fences: bool = True) -> DataFrame:
    """``(key, step, reply, error)``, one row for each row and step; ``replies``
    maps a step to its reply column and needs."""
    entries = F.array(*[F.struct(F.lit(step).alias("step"), F.col(name).alias("reply"))
                        for step, (name, _) in replies.items()])
    pairs = rows.select(*key, F.explode(entries).alias("_e")).select(*key, "_e.step", "_e.reply")
    # a reply is parsed once: Spark keeps a costly column that is used more than once
    read = pairs.withColumn("_v", parse_reply(F.col("reply"), strip_fences))
    fields = sorted({need.field for _, needs in replies.values() for need in needs})
    v = F.col("_v")
    known = read.select(*key, "step", "reply", F.schema_of_variant(v).alias("_whole"),
                        is_duplicate(v).alias("_repeat"), match_index(v).alias("_at"),
                        *[field_type(v, f).alias(f"_kind_{i}") for i, f in enumerate(fields)])
    kinds = {f: F.col(f"_kind_{i}") for i, f in enumerate(fields)}
    error = F.coalesce(*[F.when(F.col("step") == step, _fault(needs, kinds))
                         for step, (_, needs) in replies.items()])
    return known.select(*key, "step", "reply", error.alias("error"))


def rejects(gated: DataFrame, key: list[str]) -> DataFrame:
    """The reject rows ``(step, key, message, detail)`` of gated replies."""
    return gated.where(F.col("error").isNotNull()).select(
        "step", F.concat_ws(":", *key).alias("key"), F.col("error").alias("message"),
        F.to_json(F.struct("reply")).alias("detail"))


def write_split(gated: DataFrame, path: str) -> Observation:
    """Both sides as partitions ``accepted=.../step=...`` of one new table;
    ``.get`` of the result has the counts once the write is done."""
    seen = Observation()
    flagged = gated.withColumn("accepted", F.col("error").isNull())
    flagged.observe(seen, F.count("*").alias("rows"), F.count_if(~F.col("accepted")).alias("rejected")) \
        .write.partitionBy("accepted", "step").parquet(path)
    return seen
