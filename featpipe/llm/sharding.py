"""K-d tree sharding, with DataFrame functions only.

Documents are recursively split at exact weighted medians along the widest
metadata dimension of each node until every leaf holds about the target bytes.

Equal texts form groups. The tree splits units: a group, or where a group
weighs more than a unit may, one of the pieces its documents are dealt to by a
hash of their id. So copies share a shard unless there are too
many of them, and a group holding a third of all bytes spreads over many units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featpipe.llm.common import checked_broadcast, written
from featpipe.llm.prefix import prefix_sums

#: Largest weight of a unit as a share of a leaf's target bytes.
UNIT_SHARE = 1 / 200
#: Bytes a document takes besides its text.
OVERHEAD = 8
UNIT = ["_hash", "_crc", "_size", "_piece"]


def text_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with its group (hash, crc and bytes of the text, null as empty) as ``_hash``, ``_crc``, ``_size``."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return (docs.withColumn("_hash", F.xxhash64(text)).withColumn("_crc", F.crc32(text))
            .withColumn("_size", (F.octet_length(text) + OVERHEAD).cast("long")))


def _spread(name: str) -> Column:
    """Place of a text value on a line from 0 to 1: its hash. Equal values
    share a place; null has one of its own."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(name), F.lit("\0"))), F.lit(1 << 40)) / F.lit(float(1 << 40))


def heavy_groups(keyed: DataFrame, n_shards: int, share: float = UNIT_SHARE) -> DataFrame:
    """Groups that weigh more than a unit may, with their number of pieces.

    A unit may weigh ``share`` of a leaf, or as much as the largest document,
    which cannot be split anyway. At most ``n_shards / share`` groups are
    heavier (more would exceed the total); they are broadcast if they are small."""
    sums = keyed.agg(F.sum("_size").alias("total"), F.max("_size").alias("largest")).first()
    limit = max(1, int((sums.total or 0) / n_shards * share), sums.largest or 0)
    groups = keyed.groupBy(*UNIT[:3]).agg(F.sum("_size").alias("_bytes"))
    pieces = F.ceil(F.col("_bytes") / F.lit(limit)).cast("long").alias("_pieces")
    return checked_broadcast(written(groups.where(F.col("_bytes") > limit).select(*UNIT[:3], pieces), "shard-heavy"))


def into_units(keyed: DataFrame, heavy: DataFrame) -> DataFrame:
    """``keyed`` with ``_piece``: documents of a heavy group are dealt by a hash
    of id, source and language; all others are piece 0."""
    piece = F.pmod(F.xxhash64(F.lit("piece"), "doc_id", "source", "lang"), F.coalesce(F.col("_pieces"), F.lit(1)))
    return keyed.join(heavy, UNIT[:3], "left").withColumn("_piece", piece).drop("_pieces")


def units(placed: DataFrame) -> DataFrame:
    """One row per unit: its weight and the dimensions' coordinates."""
    return placed.groupBy(*UNIT).agg(
        F.sum("_size").alias("_weight"),
        F.min(_spread("source")).alias("_source"), F.min(_spread("lang")).alias("_lang"),
        F.log2(F.first("_size")).alias("_log_size"), F.min(F.col("doc_id").cast("double")).alias("_first_id"))


DIMENSIONS = ["_source", "_lang", "_log_size", "_first_id"]


def kd_tree(made: DataFrame, n_shards: int, dimensions: list[str]) -> DataFrame:
    """Units with their ``shard``.

    A node of k leaves is split into halves of k // 2 and k - k // 2 leaves at
    that share of its weight. Each level range-sorts the units by (node,
    coordinate) and reads the cut from distributed prefix sums; one row per
    node is broadcast while that is small. Widths are compared after scaling each
    dimension by its range over all units."""
    scale = made.agg(*[F.min(d).alias(f"min{d}") for d in dimensions], *[F.max(d).alias(f"max{d}") for d in dimensions]).first()
    rows = made
    for d in dimensions:
        low, high = scale[f"min{d}"], scale[f"max{d}"]
        width = (high - low) if low is not None and high > low else None
        rows = rows.withColumn(d, F.coalesce((F.col(d) - low) / width, F.lit(0.0)) if width else F.lit(0.0))
    rows = written(rows.withColumn("_node", F.lit(0).cast("long")).withColumn("_leaves", F.lit(n_shards).cast("long")),
                   "kd-units")
    depth = (n_shards - 1).bit_length()
    for level in range(depth):
        spans = [(F.max(d) - F.min(d)).alias(f"span{d}") for d in dimensions]
        nodes = rows.where("_leaves > 1").groupBy("_node").agg(F.sum("_weight").alias("_total"), *spans)
        widest = F.greatest(*[F.col(f"span{d}") for d in dimensions])
        number = F.coalesce(*[F.when(F.col(f"span{d}") == widest, F.lit(k)) for k, d in enumerate(dimensions)])
        nodes = written(nodes.select("_node", "_total", number.alias("_dimension")), f"kd-nodes{level}")
        nodes = checked_broadcast(nodes)  # n_shards rows at most
        along = F.coalesce(*[F.when(F.col("_dimension") == k, F.col(d)) for k, d in enumerate(dimensions)], F.lit(0.0))
        placed = rows.join(nodes, "_node", "left").withColumn("_along", along)
        placed = prefix_sums(placed, "_node", ["_along", *UNIT], "_weight", f"kd-level{level}")
        left = F.floor(F.col("_leaves") / 2)
        # a unit goes left when more than half of it lies before the cut
        goes_left = (F.col("before") + F.col("_weight") / 2) * F.col("_leaves") <= F.col("_total") * left
        split = F.col("_leaves") > 1
        rows = (placed.withColumn("_left", goes_left)
                .withColumn("_node", F.when(split & ~F.col("_left"), F.col("_node") + left).otherwise(F.col("_node")).cast("long"))
                .withColumn("_leaves", F.when(~split, F.col("_leaves"))
                            .otherwise(F.when(F.col("_left"), left).otherwise(F.col("_leaves") - left)).cast("long"))
                .drop("_total", "_dimension", "_along", "before", "_left"))
        rows = written(rows, f"kd-split{level}")
    return rows.select(*UNIT, F.col("_node").cast("int").alias("shard"))


def shard(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None,
          keep: tuple[str, ...] = ("doc_id",), dimensions: tuple[str, ...] = tuple(DIMENSIONS)) -> DataFrame:
    """Columns ``keep`` plus size, text_crc32 and shard for every document.

    Give the number of shards, or the bytes each should hold. Sizes differ by
    the units met at the cuts. Null texts are empty and count ``OVERHEAD``
    bytes; null ids, sources and languages are values of their own; rows equal
    in all of these go where their group goes. The texts are read, not
    shuffled, unless ``keep`` asks for them."""
    # ids and metadata are written once, without the texts
    narrow = written(text_keys(docs).select("doc_id", "source", "lang", *UNIT[:3]), "shard-rows")
    if n_shards is None:
        total = narrow.agg(F.sum("_size").alias("total")).first().total or 0
        n_shards = max(1, round(total / target_bytes))
    heavy = heavy_groups(narrow, n_shards)
    placed = into_units(narrow, heavy)
    tree = kd_tree(units(placed), n_shards, list(dimensions))
    if set(keep) <= {"doc_id", "source", "lang"}:
        rows = placed
    else:
        columns = dict.fromkeys([*keep, "doc_id", "source", "lang", "text"])
        rows = into_units(text_keys(docs.select(*columns)), heavy)
    return (rows.join(tree, UNIT)
            .select(*keep, F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), "shard"))


def with_slots(sharded: DataFrame) -> DataFrame:
    """``slot``: each document's place in its shard, from 0, by id."""
    ones = sharded.withColumn("_one", F.lit(1).cast("long"))
    return prefix_sums(ones, "shard", ["doc_id", "text_crc32", "size"], "_one", "shard-slots", "slot").drop("_one")
