"""Message topics whose values are JSON objects.

The default format is Kafka, which needs its connector on the classpath. Any
format with a `value` column works, for instance a folder of text files.
Messages carry no key, so they spread evenly over the topic's partitions.
"""

from pyspark.sql import functions as F

from waybill.functions.parsing import quoted
from waybill.schemas import all_strings, with_text_field
from waybill.sources.files import exists, move

NOT_JSON = "_corrupt_record"


def to_messages(df):
    fields = F.struct(*[quoted(name) for name in df.columns])
    return df.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def parsed_once(text, schema, error_field):
    """One column `message` for `select`: JSON text as a struct under `schema`, with the
    text itself in `error_field` where it is not a JSON object.

    The struct comes out of a generator, which filters on its fields do not pass.
    As a plain expression it would be copied into each of them and parsed anew.
    """
    options = {"columnNameOfCorruptRecord": error_field}
    message = F.from_json(text, with_text_field(schema, error_field), options)
    return F.inline(F.array(F.struct(message.alias("message"))))


def judged(messages, schema=None):
    """Every value as text, and whether it is `sound`, a JSON object; each parsed once."""
    schema = schema or all_strings([])
    value = F.col("value").cast("string")
    decoded = messages.select(value.alias("value"), parsed_once(value, schema, NOT_JSON))
    sound = F.col("message").isNotNull() & F.col(f"message.{NOT_JSON}").isNull()
    return decoded.withColumn("sound", F.coalesce(sound, F.lit(False)))


def from_messages(messages, schema):
    """Decode the values; what is not a JSON object is left out (see `rejected`)."""
    decoded = judged(messages, schema)
    return decoded.filter("sound").select("message.*").drop(NOT_JSON)


def rejected(messages, schema=None):
    """The values that `from_messages` leaves out. Null values have no text to keep."""
    return judged(messages, schema).filter("NOT sound AND value IS NOT NULL").select("value")


def accepted(messages):
    """The values that are JSON objects, as they are: with every field, known or not."""
    return judged(messages).filter("sound").select("value")


def publish(df, fmt="kafka", path=None, **options):
    """Send every row of a batch as one message. Kafka takes its topic as option `topic`."""
    writer = to_messages(df).write.format(fmt).options(**options)
    if fmt != "kafka":
        writer = writer.mode("append")
    writer.save(path)


def publish_batch(df, name, fmt="kafka", path=None, **options):
    """Send a micro-batch. In formats other than Kafka a batch is a folder under its name, which
    appears whole and once: a batch that is run again leaves what has landed. Kafka takes a
    batch that is run again twice, as it does from any of Spark's streams."""
    if fmt == "kafka":
        publish(df, fmt, **options)
        return
    spark, root = df.sparkSession, path.rstrip("/")
    target = f"{root}/batch-{name}"
    if not exists(spark, target):
        # Readers of a folder pass over names with an underscore.
        staged = f"{root}/_staged/{name}"
        to_messages(df).write.format(fmt).options(**options).mode("overwrite").save(staged)
        move(spark, staged, target)


def publish_stream(df, checkpoint, fmt="kafka", path=None, trigger=None, **options):
    writer = (
        to_messages(df)
        .writeStream.format(fmt)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def _from_the_start(fmt, options):
    if fmt == "kafka":
        options.setdefault("startingOffsets", "earliest")
    else:
        options.setdefault("recursiveFileLookup", True)  # batches are folders


def follow(spark, fmt="kafka", path=None, **options):
    """Values of a topic from its earliest message on; progress lives in the query's checkpoint."""
    _from_the_start(fmt, options)
    return spark.readStream.format(fmt).options(**options).load(path).select("value")


def subscribe(spark, schema, fmt="kafka", path=None, **options):
    """`follow`, with the values decoded."""
    return from_messages(follow(spark, fmt, path, **options), schema)


def read_topic(spark, schema, fmt="kafka", path=None, **options):
    """All messages of a topic up to now, as a batch."""
    _from_the_start(fmt, options)
    return from_messages(spark.read.format(fmt).options(**options).load(path), schema)
