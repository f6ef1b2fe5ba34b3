"""What the operators have in common: reading tables, written intermediate tables, Arrow batches."""

from __future__ import annotations

import os
import pickle
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *more: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id, the text and the named columns, so that other columns can't clash with ours."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder that the cluster names in ``spark.checkpoint.dir``.

    Where the setting is missing, a local master gets a folder of its own; a cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows from a written table: a lost executor then costs a read, not the lineage."""
    spark = df.sparkSession
    path = scratch(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Removes written tables that nothing reads any more, and lets Spark remove the shuffles that made them.

    Spark removes the files of a shuffle when the driver's JVM finds that no plan holds it, which may take long.
    """
    for df in tables:
        jvm = df.sparkSession._jvm
        for path in {os.path.dirname(file) for file in df.inputFiles()}:
            folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
            folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    tables[0].sparkSession._jvm.System.gc()


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about ``size`` bytes of text each, so that temporaries stay small.

    A single longer text comes alone and whole.
    """
    for batch in batches:
        column = batch.column(text)
        if column.nbytes <= size:
            yield batch
            continue
        lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        start = held = 0
        for row, length in enumerate(lengths):
            if held and held + length > size:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        yield batch.slice(start)


def worker_cache(purpose: str) -> dict:
    """What one operator keeps in a Python worker, which lives from task to task where Spark keeps workers.

    A worker keeps things for one purpose at a time: what another operator left behind is let go.
    """
    held = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache")).__dict__
    if purpose not in held:
        held.clear()
        held[purpose] = {}
    return held[purpose]


class Shipped:
    """A value that every executor gets once, with the classes of this package in it.

    A plain broadcast names classes by their module, which executors need not have.
    """

    def __init__(self, spark: SparkSession, value: object):
        self.held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if "read" not in self.__dict__:
            self.read = pickle.loads(self.held.value)
        return self.read


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, field.type)
        for c, field in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class KeyFilter:
    """A set of 64-bit keys in a fixed number of bits: says yes for every key in it, and for few others.

    Its size doesn't depend on the number of keys. With very many keys it lets more pass, which costs
    time but no correctness, as long as a join follows.
    """

    def __init__(self, keys: DataFrame, bits: int = 1 << 24):
        column = keys.columns[0]
        bit = F.pmod(F.col(column), F.lit(bits))
        words = (
            keys.select(bit.alias("bit"))
            .groupBy(F.shiftright("bit", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        )
        self.bits, self.words = bits, np.zeros(bits >> 6, np.int64)
        for row in words.collect():
            self.words[row.word] = row.bits

    def passes(self, key: int) -> bool:
        bit = key % self.bits
        return bool(int(self.words[bit >> 6]) >> (bit & 63) & 1)

    def passing(self, keys: np.ndarray) -> np.ndarray:
        bit = keys % self.bits
        return (self.words[bit >> 6] >> (bit & 63) & 1).astype(bool)
