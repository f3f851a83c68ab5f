"""Small helpers that the corpus operators share."""

import ctypes
import os
import shutil
import tempfile
from pathlib import Path

import pyarrow
from pyspark.sql import functions as F

from waybill.session import work_dir

_sent = set()
#: Spark's own bounds of what a Python worker is sent at a time, and those for whole documents:
#: a worker holds a batch as Arrow, as pandas and as what is made of it.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "250"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4m"),
}


def ship_code(spark):
    """Send this package to the executors, once per application: their Python workers run
    functions of it and need not have it installed. Batches for Python workers get small, unless
    the session has bounds of its own."""
    for name, (usual, small) in BATCHES.items():
        if spark.conf.get(name, None) == usual:
            spark.conf.set(name, small)
    context = spark.sparkContext
    if context.applicationId not in _sent:
        root = Path(__file__).resolve().parents[2]
        archive = os.path.join(os.path.realpath(tempfile.mkdtemp()), "waybill-code")
        context.addPyFile(shutil.make_archive(archive, "zip", root, "waybill"))
        _sent.add(context.applicationId)


def release():
    """Give the memory that a Python worker's earlier batches have left back to the system: a
    worker goes on to other tasks, and several of them share an executor's memory."""
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df, label, codec=None):
    """`df` written to the shared folder and read again: lineage ends here, and a lost
    executor costs the tasks after this point only."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value, then):
    """`then(value)` with `value` evaluated once per row, even where `then` is a lambda over
    elements. A plain column would be computed again for every element."""
    return F.transform(F.array(value), then)[0]


def span(start, stop):
    """The numbers from `start` up to, but not with, `stop`; none where there are none."""
    return F.when(stop > start, F.sequence(start, stop - 1)).otherwise(
        F.array().cast("array<int>")
    )


def text_of(df, name="text"):
    """The text column; null is empty text."""
    return F.coalesce(df[name], F.lit(""))


def fresh(df, *names):
    """Names for working columns that no column of `df` has."""
    taken = {name.lower() for name in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
