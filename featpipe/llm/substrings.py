"""Substring dedup by relative Lempel-Ziv factors.

Every document is factored against the documents with smaller ids. A phrase is
a window of 50 consecutive words; the reference is indexed by phrase, in
blocks. The block of a phrase follows from its anchor, the least hash of the
25-word grams inside, so equal phrases of any two documents meet in one block,
and consecutive phrases mostly stay together; phrases of an anchor that very many
documents have are dealt out by their own hash. A block knows every phrase by the
document and the place it starts at. Documents are parsed greedily: a factor
starts at the first phrase that an earlier document holds, takes the place of its
first occurrence, and goes on word by word as long as that document does;
where it ends, the next factor starts with the window that reaches over the
boundary. So a factor is (first phrase, last phrase, reference document, place), its
words stand in the reference as they are, and factors of several blocks that
go on at the same place of the same reference are one.

Only phrases whose anchor occurs in two different texts can repeat, and whole
copies are settled by their text's key alone, so few phrases are ever moved.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featpipe.llm.common import (
    BASE_A, BASE_B, WORD, WordCodes, batches_by_size, ngram_hashes, partitions, written,
)
from featpipe.llm.jaccard import _signed

#: Words of a phrase: the least length of a repeated passage.
WINDOW = 50
#: Words of the grams anchors are chosen from.
ANCHOR = 25
#: Phrases a task sorts at a time.
PHRASES = 1_000_000
#: An anchor's phrases are dealt out one by one when this share of all documents has it, and this many at least.
HOT_SHARE = 0.01
HOT_ANCHOR = 500
#: A factor: phrases ``first`` to ``last`` of a document stand in another from its phrase ``place`` on.
FACTOR = "order long, key long, first long, last long, ref_order long, ref_key long, place long"
BATCH_BYTES = 4 << 20


def phrase_anchors(codes: np.ndarray) -> np.ndarray:
    """Anchor of each phrase: the least hash of its 25-word grams."""
    if len(codes) < WINDOW:
        return np.empty(0, dtype=np.uint64)
    least, width, wanted = ngram_hashes(codes, ANCHOR), 1, WINDOW - ANCHOR + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = wanted - width
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def with_keys(docs: DataFrame) -> DataFrame:
    """doc_id, text bytes, and what names a row: ``_order`` (the id; null is
    larger than any) and ``_key`` (hash of the text)."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("_order"),
                       F.xxhash64(text).alias("_key"), F.crc32(text).alias("_crc"), text.alias("_text"))


def _anchors(batches):
    """(anchor, order, key), each anchor of a document once."""
    import pyarrow as pa
    memo = WordCodes()
    for batch in batches:
        for part in batches_by_size(batch, 2, BATCH_BYTES):
            found = [np.unique(phrase_anchors(memo.codes(t.split()))) for t in part.column(2).to_pylist()]
            n = [len(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(np.concatenate(found))), pa.array(np.repeat(np.asarray(part.column(0)), n)),
                 pa.array(np.repeat(np.asarray(part.column(1)), n))], ["anchor", "order", "key"])


def _first_occurrences(h1, h2, order, key, start):
    """Row of each phrase's first occurrence: least order, key and start among equal phrases."""
    at = np.lexsort((start, key, order, h2, h1))
    a, b = h1[at], h2[at]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    source = np.empty(len(at), dtype=np.int64)
    source[at] = np.repeat(at[first], np.diff(np.r_[first, len(at)]))
    return source


class Block:
    """Phrases of many documents, indexed by hash and by place."""

    def __init__(self, order, key, start, h1, h2):
        at = np.lexsort((start, key, order))
        self.order, self.key, self.start, self.h1, self.h2 = (x[at] for x in (order, key, start, h1, h2))
        new = np.r_[True, (self.order[1:] != self.order[:-1]) | (self.key[1:] != self.key[:-1])]
        self.doc = np.cumsum(new) - 1
        self.place = (self.doc << 40) | self.start   # ascending
        source = _first_occurrences(self.h1, self.h2, self.order, self.key, self.start)
        #: Phrases that a document of smaller order holds, and where.
        self.held = self.order > self.order[source]
        self.source = source
        #: Rows as they were given.
        self.given = np.empty(len(at), dtype=np.int64)
        self.given[at] = np.arange(len(at))

    def _same(self, row: int, doc: int, start: int) -> bool:
        """Whether the phrase of ``row`` also starts at ``start`` of ``doc``."""
        at = int(np.searchsorted(self.place, (doc << 40) | start))
        return (at < len(self.place) and self.place[at] == (doc << 40) | start
                and self.h1[at] == self.h1[row] and self.h2[at] == self.h2[row])

    def factors(self):
        """Arrays of the greedy parse of every document, as in ``FACTOR``."""
        rows = np.flatnonzero(self.held)
        if not len(rows):
            return None
        doc, start, source = self.doc[rows], self.start[rows], self.source[rows]
        ref, shift = self.doc[source], self.start[source] - start
        # stretches whose first occurrences go on in one document
        new = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1) | (ref[1:] != ref[:-1]) | (shift[1:] != shift[:-1])]
        firsts = np.flatnonzero(new)
        lasts = np.r_[firsts[1:], len(rows)] - 1
        out = []
        open_ = None   # the factor that may go on: [row, last row, reference, shift]
        for a, b in zip(firsts.tolist(), lasts.tolist()):
            if open_ is not None and doc[a] == doc[open_[1]] and start[a] == start[open_[1]] + 1:
                # the open factor takes what its reference still holds, though it stands elsewhere earlier
                while a <= b and self._same(rows[a], open_[2], int(start[a]) + open_[3]):
                    open_[1] = a
                    a += 1
                if a > b:
                    continue
            if open_ is not None:
                out.append(open_)
            open_ = [a, b, int(ref[a]), int(shift[a])]
        out.append(open_)
        first, last, ref, shift = (np.array(x, dtype=np.int64) for x in zip(*out))
        name = rows[first]
        at = np.searchsorted(self.doc, ref)   # any row of the reference has its name
        return (self.order[name], self.key[name], start[first], start[last], self.order[at], self.key[at], start[first] + shift)


def _factor_batch(found):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(x) for x in found], [x.split()[0] for x in FACTOR.split(", ")])


PHRASE_ROWS = "block long, order long, key long, first long, h1 array<long>, h2 array<long>, ref_order long, ref_key long, place long, last long"


def _phrases(batches):
    """Phrases of the candidates, and the factors already known.

    Rows with hashes hold consecutive phrases of one block, from ``first`` on;
    rows without are factors. Phrases that repeat inside a task are decided
    there, so a passage that very many documents share is sent once per task."""
    import pyarrow as pa
    memo = WordCodes()
    kept, size = [], 0

    def flush():
        block, order, key, start, h1, h2 = (np.concatenate(x) for x in zip(*kept))
        known = Block(order, key, start, h1, h2)
        found = known.factors() or (np.empty(0, dtype=np.int64),) * 7
        held = known.held[known.given]
        block, order, key, start, h1, h2 = (x[~held] for x in (block, order, key, start, h1, h2))
        new = np.r_[True, (block[1:] != block[:-1]) | (order[1:] != order[:-1]) | (key[1:] != key[:-1])
                    | (start[1:] != start[:-1] + 1)][:len(block)]
        first = np.flatnonzero(new)
        n = len(found[0])
        offsets = np.r_[first, np.full(n + 1, len(block))].astype(np.int32)
        none = np.zeros(len(first), dtype=np.int64)
        f_order, f_key, f_first, f_last, r_order, r_key, place = found
        return pa.RecordBatch.from_arrays(
            [pa.array(np.r_[_signed(block[first]), f_key]), pa.array(np.r_[order[first], f_order]),
             pa.array(np.r_[key[first], f_key]), pa.array(np.r_[start[first], f_first]),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(h1))), pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(h2))),
             *[pa.array(np.r_[none, x]) for x in (r_order, r_key, place, f_last)]],
            [x.split()[0] for x in PHRASE_ROWS.split(", ")])

    for batch in batches:
        for part in batches_by_size(batch, 2, BATCH_BYTES):
            for order, key, text, shared, hot in zip(*(c.to_pylist() for c in part.columns[:3]), part.column(3), part.column(4)):
                codes = memo.codes(text.split())
                anchors = phrase_anchors(codes)
                hot = np.isin(anchors, hot.values.to_numpy().view(np.uint64))
                start = np.flatnonzero(hot | np.isin(anchors, shared.values.to_numpy().view(np.uint64)))
                if not len(start):
                    continue
                h1, h2 = ngram_hashes(codes, WINDOW, BASE_A)[start], ngram_hashes(codes, WINDOW, BASE_B)[start]
                kept.append((np.where(hot[start], h1, anchors[start]), np.full(len(start), order), np.full(len(start), key), start, h1, h2))
                size += len(start)
                if size >= PHRASES:
                    yield flush()
                    kept, size = [], 0
    if kept:
        yield flush()


def _factors(batches):
    """Greedy parse inside a block: its factors, and those that are already known."""
    names = [x.split()[0] for x in FACTOR.split(", ")]
    rows = []
    import pyarrow as pa
    for batch in batches:
        n = np.asarray(batch.column(4).value_lengths())
        done = n == 0
        if done.any():
            yield batch.select(names).filter(pa.array(done))
        order, key, first = (np.repeat(np.asarray(batch.column(k)), n) for k in (1, 2, 3))
        within = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
        if len(order):   # a task may hold nothing but known factors
            rows.append((order, key, first + within, np.asarray(batch.column(4).flatten()), np.asarray(batch.column(5).flatten())))
    if rows:
        found = Block(*(np.concatenate(x) for x in zip(*rows))).factors()
        if found:
            yield _factor_batch(found)


def factors(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(factors, copies) of ``with_keys`` rows: the columns of ``FACTOR``, and
    (order, key, ref_order) of rows whose whole text is in a document of smaller
    order. Phrases of copies are not looked for."""
    spark = docs.sparkSession
    names = written(docs.select("_order", "_key", "_crc"), "phrases-rows")
    least = names.groupBy("_key", "_crc").agg(F.min("_order").alias("_least"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    copies = written(names.join(least, ["_key", "_crc"]).where("_order > _least")
                     .select(F.col("_order").alias("order"), F.col("_key").alias("key"), F.col("_least").alias("ref_order")).distinct(),
                     "phrases-copies")
    anchors = written(docs.select("_order", "_key", "_text").mapInArrow(_anchors, "anchor long, order long, key long"), "phrases-anchors")
    hot = max(HOT_ANCHOR, int(names.count() * HOT_SHARE))
    shared = (anchors.groupBy("anchor").agg(F.min("key").alias("a"), F.max("key").alias("b"), F.count(F.lit(1)).alias("n"))
              .where("a != b").select("anchor", (F.col("n") >= hot).alias("hot")))
    wanted = (anchors.join(written(shared, "phrases-shared"), "anchor").join(copies, ["order", "key"], "left_anti")
              .groupBy(F.col("order").alias("_order"), F.col("key").alias("_key"))
              .agg(F.collect_set(F.when(~F.col("hot"), F.col("anchor"))).alias("_shared"),
                   F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("_hot")))
    # texts meet what is wanted of them by a shuffle at any size: what is wanted grows with the input
    wanted = written(wanted, "phrases-wanted").hint("merge")
    moved = (docs.select("_order", "_key", "_text").join(wanted, ["_order", "_key"])
             .select("_order", "_key", "_text", "_shared", "_hot").mapInArrow(_phrases, PHRASE_ROWS)
             .repartition(partitions(spark), "block"))
    return moved.mapInArrow(_factors, FACTOR), copies


def joined(found: list[tuple]) -> list[tuple]:
    """Factors (first, last, ref_order, ref_key, place) of one document, sorted; those that go on at the same place
    of the same reference are one, and none lies inside another."""
    out = []
    for first, last, order, key, place in sorted(found):
        if out:
            a, b, o, k, p = out[-1]
            if (o, k, place - first) == (order, key, p - a) and first <= b + 1:
                out[-1] = (a, max(b, last), o, k, p)
                continue
            if last <= b:
                continue
        out.append((first, last, order, key, place))
    return out


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans, factors of every document.

    Removes every word inside a window of 50 words that also starts in a
    document with a smaller id; all windows are judged on the input.
    ``spans`` lists the removed (first word, words), ``factors`` what they are made
    of: (first word, words, ref_id, ref_first), the document that holds them
    and the word there. Null texts are empty; null ids are larger than any other and
    equal to each other; rows repeated in id and text get equal results. Long texts
    are parsed whole. Two phrases are taken as equal when two 64-bit hashes of
    theirs agree."""
    named = with_keys(docs)
    found, copies = factors(named)
    # one row per document: its factors, or one that covers everything for a copy
    every = copies.select("order", "key", F.lit(0).cast("long").alias("first"), F.lit(1 << 62).alias("last"), "ref_order",
                          F.col("key").alias("ref_key"), F.lit(0).cast("long").alias("place"))
    part = F.struct("first", "last", "ref_order", "ref_key", "place")
    runs = found.union(every).groupBy(F.col("order").alias("_order"), F.col("key").alias("_key")).agg(F.collect_set(part).alias("_factors"))
    runs = written(runs, "phrases-factors").hint("merge")
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        import hashlib

        import pyarrow as pa
        place = pa.struct([("first", pa.int64()), ("words", pa.int64())])
        origin = pa.struct([*place, ("ref_id", pa.int64()), ("ref_first", pa.int64())])
        for batch in batches:
            for part in batches_by_size(batch, 1, BATCH_BYTES):
                rows = []
                for text, known in zip(*(c.to_pylist() for c in part.columns[1:])):
                    words = text.split()
                    n = len(words)
                    gone, made = [], []
                    for first, last, order, _, at in joined([tuple(x.values()) for x in known]) if known and n >= WINDOW else ():
                        end = min(last, n - WINDOW) + WINDOW
                        made.append({"first": first, "words": end - first, "ref_id": order, "ref_first": at})
                        if gone and first <= gone[-1][1]:
                            gone[-1][1] = max(gone[-1][1], end)
                        else:
                            gone.append([first, end])
                    kept, at = [], 0
                    for a, b in gone:
                        kept += words[at:a]
                        at = b
                    kept = b" ".join(kept + words[at:] if gone else words)
                    rows.append((n, sum(b - a for a, b in gone), hashlib.sha256(kept).hexdigest(),
                                 [{"first": a, "words": b - a} for a, b in gone], made))
                types = (pa.int64(), pa.int64(), pa.string(), pa.list_(place), pa.list_(origin))
                columns = [pa.array(x, t) for x, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns],
                                                 ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "factors"])

    spans = "array<struct<first: long, words: long>>"
    origins = "array<struct<first: long, words: long, ref_id: long, ref_first: long>>"
    return (named.select("doc_id", "_order", "_key", "_text").join(runs, ["_order", "_key"], "left")
            .select("doc_id", "_text", "_factors")
            .mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, spans {spans}, factors {origins}"))


def kept_text(text: Column, spans: Column) -> Column:
    """The words outside ``spans``, joined by one space."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    inside = lambda i: F.exists(spans, lambda s: (i >= s["first"]) & (i < s["first"] + s["words"]))
    return F.array_join(F.filter(words, lambda w, i: ~inside(i)), " ")
