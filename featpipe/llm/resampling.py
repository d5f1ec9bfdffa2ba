"""Importance resampling towards a target distribution over hashed n-grams.

Words and word pairs fall into buckets by crc32. The gain of a bucket says how
much more of the target than of the raw corpus lies in it; a document's weight
is the mean gain of its features, and a Gumbel draw keyed by the document's id
turns the highest sums of weight and noise into a sample without replacement.

Inside a task, the n-grams of a block of texts are interned in an
open-addressed NumPy table (xxHash64 keys, bytes verified); its slots carry
bucket and count, so a bucket is found once per distinct n-gram, counts are
added per bucket, and every occurrence takes its gain through its slot.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featpipe.llm import spans
from featpipe.llm.common import batches_by_size, written
from featpipe.llm.prefix import prefix_sums

BUCKETS = 10_000
#: Documents that may be drawn have this many words.
LEAST_WORDS = 20
#: Per cent of those documents that are drawn.
DRAWN = 25
SEED = 7
#: Text bytes of a batch that are held at a time.
BATCH_BYTES = 8 << 20


class Features:
    """Slots of one block's n-grams: ``bucket`` and ``count`` per slot, slot id and text per occurrence."""

    def __init__(self, parts: list[bytes], owners: list[int], carried: list[bool], buckets: int):
        words = spans.words_of(parts)
        whole = np.ones(len(words.starts), dtype=bool)
        # a carried word was counted with the part before
        firsts = np.flatnonzero(np.diff(words.piece, prepend=-1))
        whole[firsts[np.asarray(carried)[words.piece[firsts]]]] = False
        single = np.flatnonzero(whole)
        pair = np.flatnonzero(words.piece[1:] == words.piece[:-1])
        table = spans.Table(words.buffer, words.lanes, np.concatenate([words.starts[single], words.starts[pair]]),
                            np.concatenate([words.lengths[single], words.lengths[pair] + 1 + words.lengths[pair + 1]]))
        self.bucket = (table.crc32() % np.uint32(buckets)).astype(np.int64)
        self.count = table.counts
        self.slot = table.ids
        self.text = np.asarray(owners)[words.piece[np.concatenate([single, pair])]]


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts per bucket. A task adds up its texts and hands on one row per bucket."""
    def run(batches):
        import pyarrow as pa
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in batches_by_size(batch, 0, BATCH_BYTES):
                for block in spans.text_blocks(part.column(0).to_pylist(), carry=True):
                    f = Features(*block, buckets)
                    total += np.bincount(f.bucket, weights=f.count, minlength=buckets).astype(np.int64)
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    texts = docs.select(F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket: floor of 1000 times the log of the
    target's share over the corpus' share, both smoothed by one."""
    spark = docs.sparkSession
    both = (bucket_counts(docs, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
            .union(bucket_counts(target, buckets).select("bucket", F.lit(0).cast("long"), "n"))
            .union(spark.range(buckets).select("id", F.lit(0).cast("long"), F.lit(0).cast("long"))))
    counts = written(both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "resampling-counts")
    s_all, t_all = counts.agg(F.sum("s"), F.sum("t")).first()
    share = ((F.col("t") + 1).cast("double") * F.lit(float(s_all + buckets))
             / ((F.col("s") + 1).cast("double") * F.lit(float(t_all + buckets))))
    return counts.select("bucket", F.floor(F.lit(1000.0) * F.ln(share)).alias("gain"))


def weights(docs: DataFrame, gains: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, weight) of every document: the floored mean gain of
    its features, 0 without any. ``gains`` has one row per bucket and is handed
    to the tasks as an array."""
    table = np.zeros(buckets, dtype=np.int64)
    for bucket, gain in gains.collect():  # ``buckets`` rows
        table[bucket] = gain

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for part in batches_by_size(batch, 1, BATCH_BYTES):
                n = np.zeros(part.num_rows, dtype=np.int64)
                total = np.zeros(part.num_rows, dtype=np.int64)
                for block in spans.text_blocks(part.column(1).to_pylist(), carry=True):
                    f = Features(*block, buckets)
                    n += np.bincount(f.text, minlength=len(n))
                    # sums of whole numbers far below 2**53
                    total += np.bincount(f.text, weights=table[f.bucket][f.slot], minlength=len(n)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.array(total // np.maximum(n, 1))], ["doc_id", "n_features", "weight"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Floor of 1000 times standard Gumbel noise, a function of seed and id (a null id counts as no text)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, drawn: int = DRAWN, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document, ``rank``
    null when it is not drawn.

    Of the N documents with ``least_words`` words or more the floor of
    ``drawn`` * N / 100 with the highest scores are drawn, equal scores by
    ascending id (null last). Ranks come from prefix sums over the range-sorted
    scores, so no task sorts them all. Null and empty texts have no feature,
    weight 0 and are never drawn; rows repeated in full are drawn one by one;
    an empty table gives an empty result. Texts over ``spans.BLOCK_BYTES`` are
    cut between words, the last word carried into the next part, so no pair of
    words is lost; a task holds one batch and one block's table at a time."""
    spark = docs.sparkSession
    gains = bucket_gains(docs, target, buckets)
    scored = weights(docs, gains, buckets).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = written(scored, "resampling-scores")
    # n words have n + (n - 1) features
    enough = F.col("n_features") >= 2 * least_words - 1
    n = scored.where(enough).count() * drawn // 100
    rows = scored.where(enough).select(
        F.lit(0).alias("_all"), (-F.col("score")).alias("_down"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("_id"),
        "doc_id", "n_features", "weight", "score", F.lit(1).alias("_one"))
    ranked = prefix_sums(rows, "_all", ["_down", "_id", "n_features", "weight"], "_one", "resampling-order")
    rank = F.when(F.col("before") < n, (F.col("before") + 1).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return (ranked.select(*columns, rank.alias("rank"))
            .union(scored.where(~enough).select(*columns, F.lit(None).cast("long"))))


#: crc32 by a table of 256 entries, made by its rule and folded over the bytes of each distinct feature.
ORACLE = r"""
with recursive crc(i, k, c) as (
  select range, 0, range::ubigint from range(256)
  union all
  select i, k + 1, case when c & 1 = 1 then xor(3988292384::ubigint, c >> 1) else c >> 1 end from crc where k < 8),
tab as (select list(c order by i) as t from crc where k = 8),
texts as (
  select 0 as target, doc_id, row_number() over () as r, text from documents
  union all select 1, null, row_number() over (), text from benchmark),
words as (
  select target, doc_id, r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
features as (
  select target, doc_id, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f from words),
named as (select f, hex(encode(f)) as h from (select distinct f from features)),
coded as (
  select f, xor(list_reduce(list_transform(range(len(h) // 2), lambda i: (16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1)
                            + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)::ubigint),
                lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::bigint]), 4294967295::ubigint), 4294967295::ubigint) % 10000 as b
  from named, tab),
placed as (select target, doc_id, r, b from features join coded using (f)),
counted as (
  select x.range as b, count(*) filter (p.target = 0) as s, count(*) filter (p.target = 1) as t
  from range(10000) x left join placed p on p.b = x.range group by 1),
gains as (
  select b, cast(floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double / ((s + 1)::double * (sum(t) over () + 10000)::double))) as bigint) as gain
  from counted),
weighted as (
  select r, count(*) as n, sum(gain)::bigint as g from placed join gains using (b) where target = 0 group by r),
scored as (
  select d.doc_id, coalesce(n, 0)::bigint as n_features, coalesce(floor(g / n), 0)::bigint as weight,
         (coalesce(floor(g / n), 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(d.doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double))))::bigint as score
  from texts d left join weighted using (r) where d.target = 0),
ranked as (
  select *, row_number() over (partition by n_features >= 39 order by score desc, doc_id nulls last) as k,
         count(*) filter (n_features >= 39) over () as n from scored)
select doc_id, n_features, weight, score, case when n_features >= 39 and k <= 25 * n // 100 then k end as "rank" from ranked
"""
