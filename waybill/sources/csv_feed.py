"""CSV feeds with a header row; every value is text."""

from functools import reduce

from pyspark.sql import functions as F

from waybill.functions.parsing import quoted, stripped
from waybill.schemas import all_strings, with_text_field

BROKEN_ROW = "_corrupt_record"
#: The heads of so few files are read faster by the driver than by a job.
HEADS_ON_DRIVER = 16


def _csv(reader, multi_line):
    return (
        reader.option("header", True)
        # A file whose header differs from the schema is an error that names it, not a swap.
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN_ROW)
        # With pruning, a row would pass as complete whenever its wanted fields are there.
        .option("columnPruning", False)
    )


def header_schema(spark, path):
    """The first file's own column names; only its first line is read."""
    reader = spark.read.option("header", True).option("escape", '"')
    return all_strings(reader.csv(path).columns)


def _files(spark, path):
    """The files of a feed, by their own names."""
    jvm = spark._jvm
    found = spark.read.text(path).inputFiles()
    return sorted(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)).toString() for name in found)


def _first_line(spark, file):
    """The first line of a file that is not blank, read on the driver; None without one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
            spark._jsc.hadoopConfiguration()
        )
        codec = codecs.getCodec(path)
        plain = codec.createInputStream(stream) if codec else stream
        lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(plain, "UTF-8"))
        while (line := lines.readLine()) is not None:
            if line.strip():
                return line
        return None
    finally:
        stream.close()


def _first_lines(spark, files):
    """(file, first line) of many files, a task each, which ends with that line."""

    def first(batches):  # in here, so that executors need not have this package installed
        for batch in batches:
            for line in range(batch.num_rows):
                if batch.column(0)[line].as_py().strip():
                    yield batch.select([0, 1]).slice(line, 1)
                    return

    # A session of its own, whose settings no other query sees: every file is one split whole.
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    own.conf.set("spark.sql.files.openCostInBytes", str(1 << 50))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    # A task reads ahead until the pipe to its worker, some MB, is full. With ballast
    # that is after a few lines instead of a few MB of the file.
    ballast = F.repeat(F.lit(" "), F.lit(1 << 17)).alias("ballast")
    lines = own.read.text(files).select("value", "_metadata.file_path", ballast)
    heads = lines.mapInArrow(first, "value string, file_path string").collect()
    uri, path = spark._jvm.java.net.URI, spark._jvm.org.apache.hadoop.fs.Path
    return [(path(uri(row.file_path)).toString(), row.value) for row in heads]


def files_by_header(spark, path, heads_on_driver=HEADS_ON_DRIVER):
    """The files of a feed, grouped by their header lines; empty files are left out.

    Only the head of each file is read: of a few files on the driver, of many by a task each.
    What comes to the driver is a row per file, as many as it lists for any scan.
    """
    files = _files(spark, path)
    if len(files) <= heads_on_driver:
        heads = [(file, _first_line(spark, file)) for file in files]
    else:
        heads = _first_lines(spark, files)
    groups = {}
    for file, header in sorted(heads):
        if header is not None:
            groups.setdefault(header, []).append(file)
    return dict(sorted(groups.items()))


def clean_rows(raw):
    """Strip header names and values.

    An empty field of a complete row is empty text. The fields that a short row
    lacks stay null.
    """
    complete = F.col(BROKEN_ROW).isNull()

    def field(name):
        text = stripped(quoted(name))
        return F.when(complete, F.coalesce(text, F.lit(""))).otherwise(text).alias(name.strip())

    return raw.select(*[field(name) for name in raw.columns if name != BROKEN_ROW])


def _read(spark, paths, schema, multi_line):
    reader = _csv(spark.read, multi_line).schema(with_text_field(schema, BROKEN_ROW))
    return clean_rows(reader.csv(paths))


def read_csv_feed(spark, path, schema=None, multi_line=False):
    """A folder of CSV files, each with its columns by its own header: files of other column
    orders, or with more or fewer columns, fit together by name. With `schema` its columns
    are returned; columns that a file lacks are null.

    `multi_line` allows line breaks inside quotes, at the price of unsplittable files.
    """
    groups = list(files_by_header(spark, path).values())
    if len(groups) < 2:
        rows = _read(spark, path, header_schema(spark, groups[0][:1] if groups else path), multi_line)
    else:
        parts = [_read(spark, files, header_schema(spark, files[:1]), multi_line) for files in groups]
        rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    if schema is None:
        return rows
    names = [name.strip() for name in schema.names]
    return rows.select(
        *[quoted(name) if name in rows.columns else F.lit(None).cast("string").alias(name) for name in names]
    )


def stream_csv_feed(spark, path, schema=None, multi_line=False, **options):
    """Follow a folder of CSV files as one streaming table. `options` are those of a file source,
    for instance maxFilesPerTrigger, which splits a large backlog into several micro-batches.

    All files have the header of the first one, or that of `schema`; a file with another
    header ends the query with an error that names it. `each_csv_batch` takes any headers.
    """
    schema = schema or header_schema(spark, path)
    reader = _csv(spark.readStream, multi_line).schema(with_text_field(schema, BROKEN_ROW))
    return clean_rows(reader.options(**options).csv(path))


_FILE_ROW = "path string, modificationTime timestamp, length long, content binary"


def each_csv_batch(
    spark, path, checkpoint, land, schema=None, multi_line=False, trigger=None, **options
):
    """Follow a folder of CSV files whose headers may differ from file to file, and call
    `land(rows, name)` for the new files of each micro-batch.

    The stream is one of file names: its checkpoint says which files a batch has, so a batch
    that is run again after a failure has the same files, each with the columns of its own
    header, and the same `name`. `land` must bear to be called twice with a name.
    """
    reader = spark.readStream.format("binaryFile").schema(_FILE_ROW).options(**options)
    names = reader.load(path).where("length > 0").select("path")  # without what is in the files

    def run(batch, batch_id):
        # As many names as the driver lists for the batch anyway.
        files = sorted(row.path for row in batch.collect())
        if files:
            session = batch.sparkSession
            query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
            land(read_csv_feed(session, files, schema, multi_line), f"{query}-{batch_id:010d}")

    writer = names.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
