"""What several operators of this package share."""

from __future__ import annotations

import re
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

import chatpulse
from chatpulse.settings import work_folder

#: Rows that one call of an operator's Python function holds at a time.
SLICE_ROWS = 256


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the tasks, once an application, as ``--py-files`` would.

    A package that came in an archive is there already.
    """
    context, root = spark.sparkContext, Path(chatpulse.__file__).resolve().parents[1]
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    folder = tempfile.mkdtemp(prefix="chatpulse-package-")
    context.addPyFile(shutil.make_archive(f"{folder}/chatpulse", "zip", root, "chatpulse"))
    _SHIPPED.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def frozen(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there.

    Cuts the lineage: what a lost executor held is read again, not computed again,
    and everything built on the rows sees the same ones.
    """
    path = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


#: Measured bytes of a table up to which every task gets all of it.
BROADCAST_BYTES = 10_000_000
#: What a row of a broadcast table takes besides its texts.
_ROW_BYTES = 64


def measured(table: DataFrame, row_bytes: Column) -> DataFrame:
    """The written table, marked for every task if its rows take ``BROADCAST_BYTES`` at most as measured."""
    size = table.agg(F.sum(row_bytes + _ROW_BYTES)).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The rows with the columns of a written table that has each key at most once; null where it has none.

    The table is measured. A small one goes to every task, so no row moves; a
    larger one is a join of its keys, in which adaptive execution splits those
    that many rows have.
    """
    text = F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0))
    return rows.join(measured(table, text), key, "left")


def column(rows: DataFrame, name: str) -> Column:
    """A column by its exact name, also if that holds dots or blanks."""
    return rows["`" + name.replace("`", "``") + "`"]


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text, by which rows are held out; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


#: How many times the rows wanted pass the first, coarse draw.
_SPARE = 8


def drawn(rows: DataFrame, group: str, by: list[str], limit: int) -> DataFrame:
    """Up to ``limit`` different rows of each group, those with the least hash of ``by``.

    Rows that are equal in ``by`` are one row, so the sample of a table is that of the
    table with every row repeated. The number of different rows of a group, as a
    sketch counts them, says which share of the hashes to look at: about eight times
    the limit reach the ranking, hashes alone, whatever part of the rows one group or
    one repeated row has. Every group is drawn from, however many there are; null
    groups are left out.
    """
    known = rows.filter(F.col(group).isNotNull()).withColumn("__draw", F.xxhash64(*by))
    counts = known.groupBy(group).agg(F.approx_count_distinct("__draw").alias("n")).filter(F.col("n") > _SPARE * limit)
    # The share of all 64-bit hashes, counted from the least.
    share = (F.lit(float(_SPARE * limit)) / F.col("n") * 2.0**64 - 2.0**63).cast("bigint").alias("__cut")
    cuts = frozen(counts.select(group, share), "sample-shares")
    some = looked_up(known.select(group, "__draw"), cuts, group)
    some = some.filter(F.col("__cut").isNull() | (F.col("__draw") < F.col("__cut"))).select(group, "__draw").distinct()
    nth = F.row_number().over(Window.partitionBy(group).orderBy("__draw"))
    some = frozen(some.withColumn("__nth", nth).filter(F.col("__nth") <= limit).drop("__nth"), "sample-draws")
    name = F.coalesce(F.octet_length(F.col(group).cast("string")), F.lit(0))
    chosen = known.join(measured(some, name + 8), [group, "__draw"], "left_semi")
    return chosen.dropDuplicates([group, "__draw"]).select(*rows.columns)


_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    return _WORD.findall((text or "").lower())


def word_shingles(words: list[str], width: int) -> list[str]:
    """Shingles of the words; fewer words than ``width`` make one shingle, none makes none."""
    if len(words) <= width:
        return [" ".join(words)] if words else []
    return [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
