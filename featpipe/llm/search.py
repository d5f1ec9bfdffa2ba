"""Ranked lexical search by dense matrix products.

Items (queries) are dealt into tiles; a tile has a compact vocabulary of its own
terms. A tile of documents becomes a dense matrix of impacts over that
vocabulary, and the product with the items' weights gives all scores of the two
tiles at once. Weights and impacts are whole numbers; vocabularies are cut so
that no partial sum reaches 2**53, so float64 products are exact, and the parts
are added up as 64-bit integers.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featpipe.llm import spans
from featpipe.llm.common import batches_by_size, partitions, written
from featpipe.llm.prefix import prefix_sums

TOP = 50
#: Items, terms and documents of a tile.
ITEM_TILE = 64
TERM_TILE = 2048
DOC_TILE = 512
#: Bytes of item terms that the tasks hold at a time; a larger benchmark is searched in several passes.
ITEM_BYTES = 8 << 20
#: Text bytes of a batch that are held at a time.
BATCH_BYTES = 8 << 20
#: Impacts are below this: (10**9 * tf) div (1000 * tf + 20 * m).
IMPACT = 10 ** 6
#: Sums of whole numbers below this are exact in float64.
EXACT = 1 << 53


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of every item that has one. Rows of one id (null too) are one item."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            ids, terms = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set()
                for parts, _, _ in spans.text_blocks([text]):
                    w = spans.words_of(parts)
                    whole = w.buffer.tobytes()
                    found.update(whole[s:s + n] for s, n in zip(w.starts.tolist(), w.lengths.tolist()))
                ids += [item] * len(found)
                terms += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], ["item_id", "term"])

    texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    rows = texts.where("text is not null").mapInArrow(run, "item_id long, term binary")
    return rows.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def item_blocks(items: DataFrame, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(block, item_id, terms): items in blocks of about ``item_bytes`` bytes of terms, one item at least."""
    rows = item_terms(items).select(
        F.lit(0).alias("_all"), F.coalesce("item_id", F.lit((1 << 63) - 1)).alias("_id"), "item_id", "terms",
        F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 8).alias("_bytes"))
    placed = prefix_sums(rows, "_all", ["_id"], "_bytes", "search-items")
    return placed.select(F.floor(F.col("before") / item_bytes).alias("block"), "item_id", "terms")


class Vocabulary:
    """Distinct terms of a block of items, for exact lookup."""

    def __init__(self, terms: list[bytes]):
        words = spans.words_of([b" ".join(terms)])
        self.table = spans.Table(words.buffer, words.lanes, words.starts, words.lengths)
        #: Place in ``terms`` of each distinct term of the table.
        self.place = np.empty(len(terms), dtype=np.int64)
        self.place[self.table.ids] = np.arange(len(terms))

    def counts(self, texts: list[bytes | None]):
        """(doc, term, tf) of the vocabulary's terms in the texts, and the number of all words per text."""
        n = np.zeros(len(texts), dtype=np.int64)
        size = len(self.place)
        keys, counts = [], []
        for parts, owners, _ in spans.text_blocks(texts):
            words = spans.words_of(parts)
            owner = np.asarray(owners)[words.piece]
            n += np.bincount(owner, minlength=len(n))
            found = self.table.find(words.buffer, words.lanes, words.starts, words.lengths)
            hit = np.flatnonzero(found >= 0)
            key, count = np.unique(owner[hit] * size + self.place[found[hit]], return_counts=True)
            keys.append(key)
            counts.append(count)
        if not keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), n
        key, back = np.unique(np.concatenate(keys), return_inverse=True)  # texts may reach over blocks
        tf = np.bincount(back, weights=np.concatenate(counts), minlength=len(key)).astype(np.int64)
        return key // size, key % size, tf, n


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def corpus_statistics(docs: DataFrame, terms: list[bytes]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each
    of ``terms``. A task adds up its documents and hands on a row per term."""
    def run(batches):
        import pyarrow as pa
        vocabulary = Vocabulary(terms)
        df = np.zeros(len(terms) + 2, dtype=np.int64)  # the last two: documents, and all terms
        for batch in batches:
            for part in batches_by_size(batch, 1, BATCH_BYTES):
                _, term, _, n = vocabulary.counts(part.column(1).to_pylist())
                df[:-2] += np.bincount(term, minlength=len(terms))
                df[-2] += np.count_nonzero(n)
                df[-1] += n.sum()
        used = np.flatnonzero(df)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(df[used])], ["term", "n"])

    out = np.zeros(len(terms) + 2, dtype=np.int64)
    rows = _texts(docs).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for term, n in rows.collect():  # a row per term of the block
        out[term] = n
    return int(out[-2]), int(out[-1]), out[:-2]


class Tile:
    """Items with a compact vocabulary, cut where a sum could reach 2**53."""

    def __init__(self, items: list[np.ndarray], weight: np.ndarray, term_tile: int = TERM_TILE):
        terms = np.unique(np.concatenate(items))
        most = int(max(1, weight[terms].max())) * IMPACT
        width = max(1, min(term_tile, (EXACT - 1) // most))
        self.local = np.full(len(weight), -1, dtype=np.int64)
        self.local[terms] = np.arange(len(terms))
        whole = np.zeros((len(items), len(terms)))
        for k, own in enumerate(items):
            whole[k, self.local[own]] = weight[own]
        self.parts = [(a, whole[:, a:a + width].copy()) for a in range(0, len(terms), width)]
        self.n = len(items)

    def scores(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
        """Items by documents, as integers."""
        place = self.local[term]
        own = place >= 0
        doc, place, impact = doc[own], place[own], impact[own]
        total = np.zeros((self.n, n_docs), dtype=np.int64)
        for a, weights in self.parts:
            inside = (place >= a) & (place < a + weights.shape[1])
            block = np.zeros((weights.shape[1], n_docs))
            block[place[inside] - a, doc[inside]] = impact[inside]
            total += (weights @ block).astype(np.int64)
        return total


class Best:
    """The highest scores per item so far; equal scores by ascending id."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.least = np.ones(n_items, dtype=np.int64)  # scores below this cannot be among them
        self.held = [np.zeros((0, 3), dtype=np.int64)]
        self.size = 0

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of the items from ``first`` on; ties with the last place stay."""
        least = self.least[first:first + len(scores)]
        if scores.shape[1] > self.top:
            least = np.maximum(least, np.partition(scores, -self.top, axis=1)[:, -self.top])
        item, doc = np.nonzero(scores >= least[:, None])
        self.held.append(np.column_stack([item + first, scores[item, doc], ids[doc]]))
        self.size += len(item)
        if self.size > 4 * self.top * len(self.least) + 100_000:
            self.settle()

    def settle(self) -> np.ndarray:
        """(item, score, id) of the best, sorted."""
        rows = np.concatenate(self.held)
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        start = np.searchsorted(rows[:, 0], rows[:, 0])
        rank = np.arange(len(rows)) - start
        rows = rows[rank < self.top]
        last = np.flatnonzero(rank[rank < self.top] == self.top - 1)
        self.least[rows[last, 0]] = rows[last, 1]
        self.held, self.size = [rows], len(rows)
        return rows


def _search_block(docs: DataFrame, items: list[tuple[int | None, list[bytes]]], top: int) -> DataFrame | None:
    """(item_id, doc_id, score, task): the best documents of each task for one block of items."""
    terms = sorted({t for _, own in items for t in own})
    number = {t: k for k, t in enumerate(terms)}
    names = [i for i, _ in items]
    own_terms = [np.array([number[t] for t in own]) for _, own in items]
    n_docs, n_terms, df = corpus_statistics(docs, terms)
    if not n_docs:
        return None
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)
    no_id = (1 << 63) - 1

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        vocabulary = Vocabulary(terms)
        tiles = [(a, Tile(own_terms[a:a + ITEM_TILE], weight)) for a in range(0, len(own_terms), ITEM_TILE)]
        best = Best(len(own_terms), top)
        for batch in batches:
            for part in batches_by_size(batch, 1, BATCH_BYTES):
                ids = np.array([no_id if x is None else x for x in part.column(0).to_pylist()], dtype=np.int64)
                texts = part.column(1).to_pylist()
                for a in range(0, len(texts), DOC_TILE):
                    here = ids[a:a + DOC_TILE]
                    doc, term, tf, n = vocabulary.counts(texts[a:a + DOC_TILE])
                    m = np.array([50 + 50 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)
                    impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
                    for first, tile in tiles:
                        best.add(first, tile.scores(doc, term, impact, len(here)), here)
        rows = best.settle()
        if len(rows):
            item = pa.array([names[k] for k in rows[:, 0].tolist()], pa.int64())
            doc = pa.array(rows[:, 2], mask=rows[:, 2] == no_id)
            task = pa.array(np.full(len(rows), TaskContext.get().partitionId(), dtype=np.int64))
            yield pa.RecordBatch.from_arrays([item, doc, pa.array(rows[:, 1]), task], ["item_id", "doc_id", "score", "task"])

    return _texts(docs).mapInArrow(run, "item_id long, doc_id long, score long, task long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents of highest
    score above 0, equal scores by ascending id (null last).

    Terms are lower-cased runs of ASCII letters, ASCII digits and all
    characters beyond ASCII, of whole texts. Null and empty texts have none; an item
    without terms and an empty table of either kind give no row. Documents
    repeated in full are ranked one by one. Long texts are counted in parts.
    The items are searched in blocks of ``item_bytes`` (the data handed to the
    tasks), each block in two passes over all documents; a task keeps ``top``
    documents per item, and these are merged by groups of tasks and then by item."""
    spark = docs.sparkSession
    blocks = written(item_blocks(items, item_bytes), "search-blocks")
    found = None
    for (block,) in blocks.select("block").distinct().orderBy("block").collect():
        rows = blocks.where(F.col("block") == block).select("item_id", "terms").collect()  # about ``item_bytes``
        items_here = sorted(((r.item_id, [bytes(t) for t in r.terms]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0))
        part = _search_block(docs, items_here, top)
        if part is not None:
            found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    groups = math.isqrt(partitions(spark)) + 1
    near = Window.partitionBy("item_id", F.pmod("task", F.lit(groups))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= top).drop("rank")
    whole = Window.partitionBy("item_id").orderBy(*order)
    return (found.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))


ORACLE = r"""
with lowered as (select doc_id, row_number() over () as r,
                        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
words as (select doc_id, r, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from lowered),
sizes as (select doc_id, r, len(w) as n, w from words where len(w) > 0),
totals as (select count(*) as n_docs, sum(n)::bigint as n_terms from sizes),
wanted as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
tf as (select r, term, count(*) as tf from (select r, unnest(w) as term from sizes) where term in (select term from wanted) group by 1, 2),
weights as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, totals group by term, n_docs),
impacts as (select r, term, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)) as i
            from tf join sizes using (r), totals),
scores as (select item_id, r, sum(w * i)::bigint as score from impacts join weights using (term) join wanted using (term) group by 1, 2),
ranked as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id nulls last) as k
           from scores join sizes using (r) where score > 0)
select item_id, k::integer as "rank", doc_id, score from ranked where k <= 50
"""
