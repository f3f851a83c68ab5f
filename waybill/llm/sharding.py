"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has `VIRTUAL` places on a ring of `CELLS` cells. A document falls into the cell
of its id's hash and belongs to the shard that owns the next place clockwise. Shards take at
most their share of the rows (counts differ by one at most: the law is `rows`); documents
that a full shard cannot take continue clockwise to the next shard. Balance is therefore
exact, and a changed number of shards moves only the documents of the changed arcs and the
overflow.

The walk needs the number of rows in each cell only. It runs on a table of at most `CELLS`
rows, whatever the size of the input: each round offers what is left of each cell to the next
shard on its way. Afterwards every cell is cut into pieces by shard, and its rows are
numbered to find their piece. Rows are numbered within a cell, so no task sees a whole shard.

A document without an id is placed by its text; null text is empty text. Equal ids fall into
one cell, where ties are ordered by the hash of the text. An empty table gives no rows. Texts of
any length count whole. Columns other than doc_id and text are not looked at, whatever they
are called; `placed` returns the documents' own. Everything is built-in functions.
"""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waybill.llm.frames import fresh, stored, text_of

CELLS = 1 << 14
VIRTUAL = 32


def spread(*columns):
    """A cell by hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(CELLS)).cast("int")


def ring(spark, shards):
    """(from_cell, to_cell, way): the arcs of the ring, each with its shards clockwise."""
    number = F.col("id").cast("int")
    places = spark.range(shards * VIRTUAL).select(
        F.struct(
            spread(F.lit("place"), number).alias("cell"),
            F.floor(number / VIRTUAL).cast("int").alias("shard"),
        ).alias("place")
    )
    around = places.agg(F.sort_array(F.collect_list("place")).alias("ring"))
    arcs = around.select("ring", F.posexplode("ring").alias("at", "place"))
    turned = F.concat(
        F.slice("ring", F.col("at") + 1, F.size("ring")),
        F.slice("ring", F.lit(1), F.col("at")),
    )
    before = F.when(F.col("at") > 0, F.get("ring", F.col("at") - 1)["cell"]).otherwise(-1)
    way = F.array_distinct(F.transform(turned, lambda place: place["shard"]))
    own = arcs.select(
        (before + 1).alias("from_cell"), F.col("place.cell").alias("to_cell"), way.alias("way")
    )
    last = around.select(
        (F.element_at("ring", -1)["cell"] + 1).alias("from_cell"),
        F.lit(CELLS - 1).alias("to_cell"),
        F.array_distinct(F.transform("ring", lambda place: place["shard"])).alias("way"),
    )
    return own.unionByName(last).where("from_cell <= to_cell")


def walked(cells, shards):
    """`cells` (cell, n) with `pieces`: how many rows of the cell each shard takes."""
    spark = cells.sparkSession
    total = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ways = ring(spark, shards).select(
        "way", F.explode(F.sequence("from_cell", "to_cell")).alias("cell")
    )
    pieces = F.array().cast("array<struct<shard:int,taken:bigint>>")
    state = stored(
        cells.join(ways, "cell").select("cell", "n", "way", F.col("n").alias("left"), pieces.alias("pieces")),
        "ring",
    )
    for step in range(shards):
        taken = (
            state.select(F.explode("pieces").alias("piece"))
            .groupBy(F.col("piece.shard").alias("shard"))
            .agg(F.sum("piece.taken").alias("held"))
        )
        share = F.lit(total // shards) + (F.col("shard") < total % shards).cast("long")
        offered = state.withColumn("shard", F.get("way", F.lit(step))).join(taken, "shard", "left")
        room = share - F.coalesce("held", F.lit(0))
        order = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        earlier = F.coalesce(F.sum("left").over(order), F.lit(0))
        takes = F.greatest(F.lit(0), F.least(F.col("left"), room - earlier))
        piece = F.array(F.struct("shard", F.col("takes").alias("taken")))
        state = stored(
            offered.withColumn("takes", takes).select(
                "cell",
                "n",
                "way",
                (F.col("left") - F.col("takes")).alias("left"),
                F.when(F.col("takes") > 0, F.concat("pieces", piece)).otherwise(F.col("pieces")).alias("pieces"),
            ),
            "ring",
        )
        if not state.where("left > 0").limit(1).count():
            break
    return state.select("cell", "pieces")


def cut(walk):
    """(cell, shard, begin, end, slot): rows `begin` to before `end` of a cell and the slot
    of the first of them."""
    rows = walk.select("cell", F.posexplode("pieces").alias("at", "piece")).select("cell", "at", "piece.*")
    in_cell = Window.partitionBy("cell").orderBy("at")
    in_shard = Window.partitionBy("shard").orderBy("cell", "at")
    taken, before = F.col("taken"), Window.unboundedPreceding
    end = F.sum(taken).over(in_cell.rowsBetween(before, 0))
    slot = F.sum(taken).over(in_shard.rowsBetween(before, 0)) - taken
    return rows.select("cell", "shard", (end - taken).alias("begin"), end.alias("end"), slot.alias("slot"))


def placed(documents, shards):
    """`documents` with shard and slot, which replace columns of these names."""
    own = [name for name in documents.columns if name.lower() not in ("shard", "slot")]
    documents = documents.select(*[documents[name] for name in own])
    cell, rank, begin, end = fresh(documents, "cell", "rank", "begin", "end")
    text = text_of(documents)
    at = F.when(F.col("doc_id").isNull(), spread(text)).otherwise(spread("doc_id"))
    rows = documents.withColumn(cell, at)
    cells = rows.groupBy(F.col(cell).alias("cell")).agg(F.count("*").alias("n"))
    # At most a row per cell and per shard and round: bounded by the ring, not by the input.
    pieces = F.broadcast(
        cut(walked(cells, shards)).withColumnsRenamed({"cell": cell + "_", "begin": begin, "end": end, "slot": "slot"})
    )
    order = Window.partitionBy(cell).orderBy(F.xxhash64("doc_id", text), "doc_id")
    ranked = rows.withColumn(rank, (F.row_number().over(order) - 1).cast("long"))
    found = ranked.join(
        pieces,
        (F.col(cell) == F.col(cell + "_")) & (F.col(rank) >= F.col(begin)) & (F.col(rank) < F.col(end)),
    )
    return found.select(*own, "shard", (F.col("slot") + F.col(rank) - F.col(begin)).alias("slot"))


def sharded(documents, shards=24):
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = text_of(documents)
    rows = documents.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.when(F.col("doc_id").isNull(), text)
        .otherwise(F.xxhash64(text).cast("string"))
        .alias("text"),
    )
    return placed(rows, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
