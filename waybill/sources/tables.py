"""Parquet tables of the silver and gold layers."""


def read_table(spark, path):
    return spark.read.parquet(path)


def write_table(df, path, partition_by=()):
    """Replace a table. `df` must not read from `path`."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_bucketed(df, name, path, key, buckets):
    """Replace a catalog table whose files are bucketed and sorted by a unique key.

    Joins on the key need no shuffle of this table as long as the other side's
    shuffle has as many partitions as the table has buckets. Not for keys of which
    one may hold a large share of the rows: it would fill one bucket.
    """
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def redistribute(df, partitions=None):
    """Spread rows evenly before a sink: over a given count, or over as many
    partitions as the data's size asks for."""
    return df.repartition(partitions) if partitions else df.hint("rebalance")
