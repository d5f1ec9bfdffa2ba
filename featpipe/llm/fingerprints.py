"""Document fingerprints by SimHash, with DataFrame functions only.

Every word of a text votes with its weight on the bits of two 64-bit words, for
a bit its hash has and against a bit its hash lacks. Texts that share most of
their long words so share most bits.

Fingerprints are near when one of their two words is within ``RADIUS`` bits.
Permuted block tables leave only words that agree with another one in enough
blocks to be within the radius. Two words at distance 2 at most have a point in
common from which neither differs in more than one bit, and words that have
such a point in common are within 2 of each other; so each word is dealt to its
65 points, and the words that meet in one are a group of at most 65 in which all
are near. No pair is made, and no link is lost, however large a group of near
copies is.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featpipe.llm.common import BETWEEN_WORDS, partitions, written
from featpipe.llm.components import components

#: Bits of one word of a fingerprint that may differ. The common points prove it for 2, no other radius.
RADIUS = 2
#: Blocks of a word, of which all but ``RADIUS`` agree in near words: 10 tables with keys of 38 bits or more.
BLOCKS = 5
#: Characters of a word that count; (16 * 16 + 15) div 16 votes at most. A text of 2**31 bytes so has fewer than
#: 2**31 votes: no 32-bit lane runs over.
LONGEST = 16
_LANES = 1 | 1 << 32
_LOW = (1 << 32) - 1
NO_ID = (1 << 63) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def term_weight(word: Column) -> Column:
    """Votes of a word: its squared length, in sixteenths, up to ``LONGEST`` characters; long words are rare words."""
    n = F.least(F.length(word), F.lit(LONGEST)).cast("long")
    return F.floor((n * n + 15) / 16).cast("long")


def simhashes(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` with the words ``a`` and ``b`` of the fingerprint of ``_text``; rows of equal keys have equal texts.

    The votes for two bits are added up in one long, a 32-bit lane each. Texts
    without a word get 0 and 0."""
    rows = texts.select(*keys, F.explode(F.split(F.lower("_text"), BETWEEN_WORDS)).alias("_word"))
    rows = rows.select(*keys, F.xxhash64("_word").alias("_a"), F.xxhash64(F.lit(1), "_word").alias("_b"),
                       term_weight(F.col("_word")).alias("_w"))
    lanes = [F.sum(F.shiftrightunsigned(f"_{c}", k).bitwiseAND(F.lit(_LANES)) * F.col("_w")).alias(f"_{c}{k}")
             for c in "ab" for k in range(32)]
    votes = rows.groupBy(*keys).agg(F.sum("_w").alias("_all"), *lanes)

    def word(c: str) -> Column:
        bits = []
        for k in range(32):
            for at, lane in ((k, F.col(f"_{c}{k}").bitwiseAND(F.lit(_LOW))), (k + 32, F.shiftrightunsigned(f"_{c}{k}", 32))):
                bits.append(F.shiftleft((lane * 2 > F.col("_all")).cast("long"), at))
        return reduce(Column.bitwiseOR, bits)

    return votes.select(*keys, word("a").alias("a"), word("b").alias("b"))


def hex_form(a: Column, b: Column) -> Column:
    """Both words as 32 hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def likeness(a: str, b: str, other_a: str, other_b: str) -> Column:
    """Share of equal bits."""
    return 1 - (F.bit_count(F.col(a).bitwiseXOR(F.col(other_a))) + F.bit_count(F.col(b).bitwiseXOR(F.col(other_b)))) / F.lit(128.0)


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, text with ``_order`` (the id, null last) and ``_key`` (hash of the text), which name a document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_order"),
                       F.xxhash64(text).alias("_key"), text.alias("_text"))


def successors(rows: DataFrame) -> DataFrame:
    """(_order, _key, n_chars, _next_order, _next_key): every document and the
    next one in ascending order; the first follows the last.

    The names are range-partitioned and written once; the next name is looked
    up inside each partition and, at its end, in the table of the partitions'
    first names (one row per partition)."""
    names = rows.select("_order", "_key", F.char_length("_text").cast("long").alias("n_chars")).distinct()
    names = written(names.repartitionByRange(partitions(rows.sparkSession), "_order", "_key")
                    .withColumn("_part", F.spark_partition_id()), "fingerprint-order")
    name = F.struct("_order", "_key")
    firsts = names.groupBy("_part").agg(F.min(name).alias("_first"))
    parts = Window.orderBy("_part")
    firsts = firsts.select("_part", F.coalesce(F.lead("_first").over(parts), F.first("_first").over(parts)).alias("_first"))
    inside = Window.partitionBy("_part").orderBy("_order", "_key")
    after = F.coalesce(F.col("_after"), F.col("_first"))
    return (names.withColumn("_after", F.lead(name).over(inside)).join(F.broadcast(firsts), "_part")
            .select("_order", "_key", "n_chars", after["_order"].alias("_next_order"), after["_key"].alias("_next_key")))


def edited_texts(rows: DataFrame, follows: DataFrame) -> DataFrame:
    """(_order, _key, _text, _edited): the last quarter of each text replaced by the first characters of the next text.

    Texts are shuffled by name once, for both joins; only the replacing
    characters are shuffled again."""
    texts = rows.select("_order", "_key", "_text")
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    wanted = follows.select(F.col("_order").alias("_of"), F.col("_key").alias("_of_key"), quarter.alias("_take"),
                            F.col("_next_order").alias("_order"), F.col("_next_key").alias("_key"))
    taken = (texts.join(wanted, ["_order", "_key"])
             .select(F.col("_of").alias("_order"), F.col("_of_key").alias("_key"), F.substring("_text", F.lit(1), F.col("_take")).alias("_head"))
             .groupBy("_order", "_key").agg(F.min("_head").alias("_head")))  # equal rows of one document
    n = F.char_length("_text")
    kept = F.substring("_text", F.lit(1), (n - F.floor(n / 4)).cast("int"))
    return texts.join(taken, ["_order", "_key"]).select("_order", "_key", "_text", F.concat(kept, "_head").alias("_edited"))


def block_keys(word: Column, blocks: int = BLOCKS, radius: int = RADIUS) -> Column:
    """A key per permuted table: which blocks it is of, and their bits."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    keys = []
    for t, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        keys.append(F.xxhash64(F.lit(t), word.bitwiseAND(F.lit(_signed(mask)))))
    return F.array(*keys)


def near_words(words: DataFrame) -> DataFrame:
    """(u, v): links that connect all distinct values of ``word`` within
    ``RADIUS`` bits of each other, ``u`` the least of a group that meets in a point."""
    tables = words.select("word", F.explode(block_keys(F.col("word"))).alias("_block"))
    shared = tables.groupBy("_block").agg(F.min("word").alias("_low"), F.max("word").alias("_high")).where("_low != _high").select("_block")
    some = written(tables.join(shared, "_block", "left_semi").select("word").distinct(), "fingerprint-met")
    points = F.array(F.col("word"), *[F.col("word").bitwiseXOR(F.lit(_signed(1 << k))) for k in range(64)])
    met = some.select("word", F.explode(points).alias("_point")).groupBy("_point").agg(F.collect_list("word").alias("_words"))
    least = F.array_min("_words")
    return (met.where(F.size("_words") > 1)  # 65 at most
            .select(least.alias("u"), F.explode("_words").alias("v")).where("u != v").distinct())


def near_groups(prints: DataFrame) -> DataFrame:
    """(fingerprint, group) of every distinct fingerprint (a, b): ``group`` is
    the least fingerprint reachable through near ones.

    A fingerprint is linked with the least one that has its word, and these
    with each other where their words are near."""
    prints = written(prints.select("a", "b", hex_form(F.col("a"), F.col("b")).alias("fingerprint")).distinct(), "fingerprints")
    links = None
    for c in "ab":
        owners = written(prints.groupBy(F.col(c).alias("word")).agg(F.min("fingerprint").alias("owner")), f"fingerprint-owners-{c}")
        own = prints.select(F.col(c).alias("word"), "fingerprint").join(owners, "word").select(F.col("owner").alias("u"), F.col("fingerprint").alias("v"))
        near = near_words(owners.select("word"))
        near = (near.join(owners.select(F.col("word").alias("u"), F.col("owner").alias("_u")), "u")
                .join(owners.select(F.col("word").alias("v"), F.col("owner").alias("_v")), "v").select("_u", "_v"))
        both = own.where("u != v").union(near)
        links = both if links is None else links.union(both)
    found = components(links, "u", "v", "fingerprint-links")
    return (prints.select("fingerprint").join(found, F.col("fingerprint") == F.col("node"), "left")
            .select("fingerprint", F.coalesce("component", "fingerprint").alias("group")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, class_id, group_id.

    ``class_id`` is the smallest doc_id with the same fingerprint, ``group_id``
    the smallest reachable through near fingerprints (null if none has an id).
    Null texts count as empty; texts without letters and digits have the
    fingerprint 0. Null ids come after all others, in the order of their texts'
    hashes; rows repeated in id and text are one document with several result
    rows, which all are alike. A single document is its own next one. An empty
    table gives an empty result. Long texts are exploded word by word, without
    a limit."""
    rows = _identified(docs)
    follows = written(successors(rows), "fingerprint-next")
    both = F.explode(F.array(F.struct(F.lit(0).alias("_which"), F.col("_text")),
                             F.struct(F.lit(1).alias("_which"), F.col("_edited").alias("_text")))).alias("_x")
    edited = edited_texts(rows, follows).select("_order", "_key", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"), both)
    keys = ["_order", "_key", "edited_sha256", "_which"]
    hashed = written(simhashes(edited.select("_order", "_key", "edited_sha256", "_x.*"), keys), "fingerprint-words")
    pick = lambda which, c: F.max(F.when(F.col("_which") == which, F.col(c)))
    prints = written(hashed.groupBy("_order", "_key", "edited_sha256").agg(
        pick(0, "a").alias("a"), pick(0, "b").alias("b"), pick(1, "a").alias("_ea"), pick(1, "b").alias("_eb")), "fingerprint-pairs")
    after = prints.select(F.col("_order").alias("_next_order"), F.col("_key").alias("_next_key"), F.col("a").alias("_na"), F.col("b").alias("_nb"))
    found = (follows.join(prints, ["_order", "_key"]).join(after, ["_next_order", "_next_key"])
             .select("_order", "_key", "n_chars", "edited_sha256", hex_form(F.col("a"), F.col("b")).alias("fingerprint"),
                     hex_form(F.col("_ea"), F.col("_eb")).alias("edited_fingerprint"),
                     likeness("a", "b", "_ea", "_eb").alias("near_edited"), likeness("a", "b", "_na", "_nb").alias("near_next")))
    found = written(found, "fingerprint-rows")
    classes = found.groupBy("fingerprint").agg(F.min("_order").alias("class_id"))
    classes = written(classes.join(near_groups(prints), "fingerprint"), "fingerprint-classes")
    groups = written(classes.groupBy("group").agg(F.min("class_id").alias("group_id")), "fingerprint-least")
    classes = written(classes.join(groups, "group").select("fingerprint", "class_id", "group_id"), "fingerprint-groups")
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return (rows.select("doc_id", "_order", "_key").join(found, ["_order", "_key"]).join(classes, "fingerprint")
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                    named("class_id"), named("group_id")))
