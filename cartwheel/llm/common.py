"""Helpers shared by the text operators: table reads, shared storage, words.

Table-shaped intermediate results go to the folder named by
``spark.checkpoint.dir`` as Parquet (``materialise``), so a lost executor
costs a re-read and never a machine-local file.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most tasks a core that write a table of short rows.
WRITERS = 2
#: Characters that separate words: white space, or all ASCII but letters and digits.
SPACE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same of text that isn't lower-cased: capitals are letters, so words have the same places.
NOT_ALNUM_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder of its own
    only in local mode, where nothing is set (tests)."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    there = there or spark.sparkContext.getCheckpointDir()
    if there:
        return there
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cartwheel-llm-"))
    return spark.sparkContext.getCheckpointDir()


def materialise(df: DataFrame, few: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage).
    ``few``: a table of short rows, whose partitions are written by WRITERS
    tasks a core at most, one after the other. Each file costs its executor
    a forked chmod or two on a local file system, whatever is in it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/cartwheel-llm/{uuid.uuid4().hex}"
    (df.coalesce(WRITERS * spark.sparkContext.defaultParallelism) if few else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def words(col: Column, separators: str = SPACE) -> Column:
    """Array of the maximal runs between ``separators``; empty for null."""
    split = F.split(F.coalesce(col, F.lit("")), separators, -1)
    return F.filter(split, lambda w: w != "")


def of_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns of the caller can't
    clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row: an expression that is
    named inside a lambda would be computed again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan(values: Column, combine: Callable[[Column, Column], Column], zero: Column, block: int = 128) -> Column:
    """For each place of the array ``values`` what ``combine`` makes of all
    values before it (``zero`` at the first). Blocks keep this near linear: an
    array that grows by one element a step would be copied at every step."""
    def upto(x: Column, n: Column) -> Column:
        return F.aggregate(F.slice(x, F.lit(1), n), zero, combine)

    def cut(v: Column) -> Column:
        count = F.ceil(F.size(v) / F.lit(block)).cast("int")
        places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda k: F.slice(v, k * block + 1, F.lit(block)))

    def firsts(blocks: Column) -> Column:
        return bind(F.transform(blocks, lambda b: F.aggregate(b, zero, combine)), lambda totals: F.transform(totals, lambda t, k: upto(totals, k)))

    def inside(blocks: Column, before: Column) -> Column:
        return F.flatten(F.transform(blocks, lambda b, k: bind(F.get(before, k), lambda first: F.transform(
            b, lambda v, i: combine(first, upto(b, i))))))
    return bind(values, lambda v: bind(cut(v), lambda blocks: bind(firsts(blocks), lambda before: inside(blocks, before))))
