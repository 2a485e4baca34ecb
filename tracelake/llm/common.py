"""Helpers shared by the text operators."""

from __future__ import annotations

import gc
import pathlib
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tracelake
from tracelake.session import new_folder, scratch

# Characters of text that one step of a Python worker holds in its arrays.
STEP_CHARS = 1 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    Executors that have the package installed keep using theirs.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = pathlib.Path(tracelake.__file__).parent
    archive = shutil.make_archive(
        str(pathlib.Path(tempfile.mkdtemp(prefix="tracelake-")) / "tracelake"),
        "zip",
        root_dir=package.parent,
        base_dir=package.name,
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The table computed once and kept in the cluster's shared folder."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def finished(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``make`` gives, stored; what was stored on the way to it is deleted.

    Spark deletes the files of a shuffle when the driver's garbage that refers to it is
    collected, so it is collected here.
    """
    path = new_folder(spark, label)
    with scratch(spark):
        df = make()
        schema = df.schema
        df.write.parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def id_remainder(name: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    text = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def below(order: Column, share: Column) -> Column:
    """Whether a 64-bit hash is among the lowest ``share`` of all numbers."""
    return order.cast("double") < F.lit(-(2.0**63)) + share * F.lit(2.0**64)


def bounded_sample(rows: DataFrame, order: Column, bound: int) -> DataFrame:
    """At most ``bound`` rows, the lowest by a hash.

    A little more than the bound is taken by the hash alone; only these rows are
    ordered and cut, so no task meets many of them.
    """
    share = min(1.0, 1.2 * bound / max(rows.count(), 1))
    return rows.where(below(order, F.lit(share))).orderBy(order).limit(bound)


def steps(texts: pa.Array, bound: int = STEP_CHARS) -> Iterator[list[str]]:
    """The texts of a batch in lists of about ``bound`` characters; null is empty.

    A text is never cut: one longer than the bound makes a list by itself.
    """
    part: list[str] = []
    size = 0
    for scalar in texts:
        text = scalar.as_py() or ""
        if part and size + len(text) > bound:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def struct_array(columns: Iterable[tuple[str, pa.Array]]) -> pa.StructArray:
    names, arrays = zip(*columns)
    return pa.StructArray.from_arrays(list(arrays), names=list(names))


def with_result(df: DataFrame, result: Column, fields: dict[str, str]) -> DataFrame:
    """``df`` with the fields of a struct column added under the given names.

    A column of the input that has one of those names is replaced.
    """
    own = "_result"
    while own in df.columns:
        own += "_"
    held = df.withColumn(own, result)
    taken = {name.lower() for name in fields.values()}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return held.select(
        *kept, *[F.col(f"`{own}`.`{field}`").alias(name) for field, name in fields.items()]
    )
