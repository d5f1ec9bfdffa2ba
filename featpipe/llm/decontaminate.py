"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

Masks of fixed shape are laid over every position of a token sequence; the
hash of the tokens a mask selects ignores those it skips, so a passage still
hits where a few words were replaced. Seeds of the documents are joined with
those of the benchmark, and around each hit the aligned tokens are compared
one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featpipe.llm.common import BETWEEN_WORDS, UNSPACED, checked_broadcast, free_name, written

#: Token offsets each mask selects. Any 14 tokens with three replaced ones, any 10 with two and any 8 with one still
#: hold a whole mask: all that the comparison accepts is hit.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 4, 6, 7), (0, 1, 2, 5, 6, 7), (0, 1, 3, 4, 6, 7), (0, 1, 2, 5, 9, 10),
         (0, 1, 3, 4, 5, 8), (0, 2, 3, 4, 5, 6))
REACH = 1 + max(m[-1] for m in MASKS)
#: Aligned tokens that are compared, and how many of them may differ.
SPAN = 14
REPLACED = 3
#: Benchmark items with fewer tokens only match whole and unchanged.
WHOLE = 8
#: Benchmark seeds that are broadcast (about 70 bytes each). More are joined by shuffle.
SEED_BLOCK = 100_000
#: A block of the filter before that shuffle: how many words of 64 bits, bits set by a seed, and seeds it is made for.
FILTER_WORDS, FILTER_BITS, FILTER_SEEDS = 16, 4, 40
#: Most blocks, of about 200 bytes each, that are broadcast. They then hold more seeds and let more pass.
FILTER_BLOCKS = 1 << 18


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits, and of each
    character where a script has no spaces; empty for null."""
    parted = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), UNSPACED, " $1 ")
    return F.transform(F.array_remove(F.split(parted, BETWEEN_WORDS), ""), lambda w: F.xxhash64(w))


def once(value: Column) -> Column:
    """``value`` behind a generator, over which neither filters nor other
    expressions are pushed: it is evaluated once per row."""
    return F.explode(F.array(value))


def _seeds(tokens: Column, at: Column, lengths: list[int]) -> list[Column]:
    """Hash of the tokens each mask selects at a position (0-based), and of the next n tokens for each of ``lengths``;
    null where they leave the text."""
    shapes = [*enumerate(MASKS), *[(-n, tuple(range(n))) for n in lengths]]
    return [F.when(at + (m[-1] + 1) <= F.size(tokens), F.xxhash64(F.lit(k), *[F.get(tokens, at + i) for i in m]))
            for k, m in shapes]


def _positions(rows: DataFrame, lengths: list[int] = ()) -> DataFrame:
    """One row per token position ``_at`` and mask or length, with its ``_seed``."""
    last = F.size("_tokens") - F.lit(min([m[-1] + 1 for m in MASKS] + list(lengths)))
    rows = rows.where(last >= 0).withColumn("_at", F.explode(F.sequence(F.lit(0), last)))
    return rows.withColumn("_seed", F.explode(F.array(*_seeds(F.col("_tokens"), F.col("_at"), list(lengths))))).where("_seed is not null")


def _around(tokens: Column, at: Column) -> Column:
    """Tokens from ``SPAN - 1`` before a position to ``SPAN + REACH`` after it; nulls outside the text."""
    places = F.sequence(at - (SPAN - 1), at + (SPAN + REACH - 1))
    return F.transform(places, lambda i: F.when((i >= 0) & (i < F.size(tokens)), F.get(tokens, i)))


def benchmark_items(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item, item_id) of every row with a token, and (item, _tokens) of every token sequence among them; ``item`` is
    its hash."""
    rows = benchmark.select("item_id", once(token_hashes(F.col("text"))).alias("_tokens")).where(F.size("_tokens") > 0)
    rows = written(rows.withColumn("item", F.xxhash64("_tokens")), "benchmark-tokens")
    return rows.select("item", "item_id"), written(rows.select("item", "_tokens").dropDuplicates(["item"]), "benchmark-items")


def benchmark_seeds(items: DataFrame) -> tuple[DataFrame, list[int]]:
    """(seed, item, item_at) of the items, and the lengths of those under ``WHOLE`` tokens."""
    n = F.size("_tokens")
    lengths = sorted(r[0] for r in items.where(n < WHOLE).select(n).distinct().collect())  # WHOLE - 1 at most
    seeds = _positions(items.where(n >= WHOLE))
    for length in lengths:
        whole = F.xxhash64(F.lit(-length), *[F.get("_tokens", F.lit(i)) for i in range(length)])
        seeds = seeds.unionByName(items.where(n == length).withColumns({"_at": F.lit(0), "_seed": whole}))
    return written(seeds.select(F.col("_seed").alias("seed"), "item", F.col("_at").alias("item_at")), "benchmark-seeds"), lengths


def _filter_bits(seed: Column) -> list[Column]:
    """Places of a seed's bits in its block."""
    return [F.shiftrightunsigned(F.xxhash64(seed), 10 * k).bitwiseAND(64 * FILTER_WORDS - 1).cast("int") for k in range(FILTER_BITS)]


def perhaps_seeded(places: DataFrame, seeds: DataFrame, n_seeds: int) -> DataFrame:
    """The rows of ``places`` whose ``_seed`` is one of ``seeds``, and about one in a thousand others.

    A Bloom filter in blocks: a seed has its bits in one block, which is one row of a bounded broadcast."""
    blocks = max(1, min(FILTER_BLOCKS, -(-n_seeds // FILTER_SEEDS)))
    bits = seeds.select(F.pmod("seed", F.lit(blocks)).alias("_block"), F.explode(F.array(*_filter_bits(F.col("seed")))).alias("_bit"))
    one = F.expr("shiftleft(1L, _bit & 63)")
    word = [F.coalesce(F.bit_or(F.when(F.shiftright("_bit", 6) == w, one)), F.lit(0).cast("long")) for w in range(FILTER_WORDS)]
    table = written(bits.groupBy("_block").agg(F.array(*word).alias("_words")), "benchmark-filter")
    here = F.pmod("_seed", F.lit(blocks)) == F.col("_block")
    for bit in _filter_bits(F.col("_seed")):
        at = F.get("_words", F.shiftright(bit, 6))
        here = here & (at.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63))) != 0)
    return places.join(F.broadcast(table), here).drop("_block", "_words")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, key, item_id, matched, compared, first, hits) of every document
    and item that overlap.

    They overlap when ``SPAN`` aligned tokens around a seed hit (or the whole
    item, if it is shorter) differ in ``REPLACED`` places at most (in
    proportion for shorter items; items under ``WHOLE`` tokens, one-token items
    included, overlap with texts that hold them unchanged). ``matched`` of ``compared`` tokens agree in the
    best such place, which starts at token ``first`` of the document; ``hits``
    counts the verified seeds. ``key`` is a hash of the text, which names rows
    without id. Null and empty texts overlap with nothing, nor do items without
    a token; rows repeated in id and text add up to one result. Long texts are
    seeded at every position. Documents are read once: up to ``SEED_BLOCK``
    seeds of the benchmark are broadcast, more are joined by shuffle with the
    positions that a bounded filter lets pass. Items of equal tokens are
    compared once."""
    rows = docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("key"),
                       once(token_hashes(F.col("text"))).alias("_tokens"))
    names, items = benchmark_items(benchmark)
    seeds, lengths = benchmark_seeds(items)
    places = _positions(rows, lengths)
    here = ["doc_id", "key", (F.col("_at") - (SPAN - 1)).alias("_from"), _around(F.col("_tokens"), F.col("_at")).alias("_here")]
    n_seeds = seeds.count()
    if n_seeds <= SEED_BLOCK:
        hits = places.join(F.broadcast(seeds), F.col("_seed") == F.col("seed")).select(*here, "item", "item_at")
    else:
        places = perhaps_seeded(places, seeds, n_seeds).select(*here, F.col("_seed").alias("seed"))
        hits = places.join(seeds.hint("merge"), "seed").drop("seed")
    hits = hits.join(checked_broadcast(items), "item").select(
        "doc_id", "key", "item", "_from", "_here", F.size("_tokens").alias("item_tokens"),
        _around(F.col("_tokens"), F.col("item_at")).alias("around"))
    return by_item_id(verify(hits), names)


def by_item_id(found: DataFrame, names: DataFrame) -> DataFrame:
    """Overlaps of token sequences as those of the rows that have them; rows of one id add up."""
    best = F.max(F.struct("matched", -F.col("first"), "compared"))
    return (found.join(checked_broadcast(names), "item").groupBy("doc_id", "key", "item_id").agg(best.alias("_best"), F.sum("hits").alias("hits"))
            .select("doc_id", "key", "item_id", F.col("_best.matched").alias("matched"),
                    F.col("_best.compared").alias("compared"), (-F.col("_best.col2")).alias("first"), "hits"))


def verify(hits: DataFrame) -> DataFrame:
    """(doc_id, key, item, matched, compared, first, hits): hits whose aligned tokens agree well enough, best place per
    document and item."""
    width = 2 * SPAN + REACH - 1
    same = F.zip_with("around", "_here", lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int"))
    compared = F.least(F.lit(SPAN), F.col("item_tokens"))
    allowed = F.when(F.col("item_tokens") < WHOLE, F.lit(0)).otherwise(F.floor(F.col("compared") * REPLACED / F.lit(float(SPAN))))
    sums = F.transform(F.sequence(F.lit(1), F.lit(width) - F.col("compared") + 1),
                       lambda i: F.aggregate(F.slice("_same", i, F.col("compared")), F.lit(0), lambda s, x: s + x))
    checked = (hits.withColumn("compared", compared).withColumn("_same", once(same)).withColumn("_sums", once(sums))
               .withColumn("matched", F.array_max("_sums"))
               .where(F.col("matched") >= F.col("compared") - allowed)
               .withColumn("first", (F.col("_from") + F.array_position("_sums", F.col("matched")) - 1).cast("long")))
    best = F.max(F.struct("matched", -F.col("first"), "compared"))
    return (checked.groupBy("doc_id", "key", "item").agg(best.alias("_best"), F.count(F.lit(1)).alias("hits"))
            .select("doc_id", "key", "item", F.col("_best.matched").alias("matched"),
                    F.col("_best.compared").alias("compared"), (-F.col("_best.col2")).alias("first"), "hits"))


def clean_documents(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without those that overlap with the benchmark (same id and text as a result)."""
    key = F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
    names = [free_name(docs, n) for n in ("_id", "_gone")]
    gone = found.select("doc_id", "key").distinct().toDF(*names)
    gone = checked_broadcast(written(gone, "benchmark-overlaps"), 1_000_000)
    own = free_name(docs, "_key")
    same = (F.col(own) == F.col(names[1])) & F.col("doc_id").eqNullSafe(F.col(names[0]))
    return docs.withColumn(own, key).join(gone, same, "left_anti").drop(own)
