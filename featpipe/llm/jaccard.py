"""Exact n-gram Jaccard join by a blocked sparse product of documents and n-grams.

The product of the document by n-gram incidence matrix with its transpose
holds the overlap of every two documents. Only a small part of it is ever
formed:

1. Equal shingle sets are one class; the rest works on classes.
2. A link needs an overlap of ``ceil(t * n)`` of a set's n shingles. In any
   order of the shingles, a prefix of each set must then hold a known number of
   common ones. Prefixes in hash order are matched over all documents; classes
   with too few shared shingles there are dropped (most are).
3. The rest are matched whole. A class whose shared shingles are under its
   bound is dropped; the others meet, by the rarest shingles of their sets, at
   a hub: of the documents holding a shingle, the one with most shared ones.
4. Overlaps with the hub are counted first. Jaccard distance is a metric: two
   classes that link with the hub need no look at each other, and one that
   links with it has no link with one at more than twice the distance. What
   is left is multiplied block by block, in column blocks; after each, pairs
   whose overlap can no longer reach their bound are discarded.
5. Links become components by alternating stars.

No step makes all pairs of a group: a block holds ``BLOCK`` classes at most
and gives back the links of a spanning forest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featpipe.llm.common import (WordCodes, batches_by_size, checked_broadcast, free_name, ngram_hashes, partitions, written)
from featpipe.llm.components import components

WORDS = 5
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Share of a set's shingles that must be common beyond the least in the first filter.
MARGIN = 0.15
#: Classes of a block of the product.
BLOCK = 200
#: Overlap increments of one column block.
PRODUCTS = 2_000_000
#: Postings a task sorts at a time.
POSTINGS = 2_000_000
#: Classes sharing a shingle within one task from which on it is sent as one marked row.
MANY = 8
BATCH_BYTES = 4 << 20


def shingle_set(text: bytes, memo: WordCodes, n: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a UTF-8 text in lower case (A-Z
    only); the whole sequence when it has fewer words; empty without words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(ngram_hashes(memo.codes(words), min(n, len(words))))


def class_key(grams: np.ndarray) -> int:
    """64-bit key of a set, never 0; sets with equal keys are taken as equal."""
    import xxhash
    return (xxhash.xxh3_64_intdigest(grams.tobytes()) or 1) - (1 << 63)


def least_overlap(n):
    """Fewest common shingles of a set of n with any partner."""
    return -(-PERCENT * n // 100)


def prefix_size(n):
    """Shingles of a set that the first filter looks at, and how many of them
    must be shared: partners hold 3/4 of the shingles at least, so 3/4 of the margin."""
    margin = np.ceil(MARGIN * n).astype(np.int64)
    smallest = least_overlap(n)
    return n - smallest + margin, np.ceil(MARGIN * smallest).astype(np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("binary"), F.lit(b"")))


def describe(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, key, n_shingles, class) per document; ``key`` is a hash of the
    text, ``class`` of the set (null when it is empty)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        import pyarrow as pa
        memo = WordCodes()
        for batch in batches:
            for part in batches_by_size(batch, 2, BATCH_BYTES):
                sets = [shingle_set(t or b"", memo) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([class_key(s) if len(s) else None for s in sets], pa.int64())],
                    ["doc_id", "key", "n_shingles", "class"])

    return (docs.select("doc_id", text_key(F.col(text)).alias("key"), F.col(text).cast("binary").alias("_text"))
            .mapInArrow(run, f"doc_id {kind}, key long, n_shingles long, class long"))


def _prefixes(batches):
    """Rows (gram, class, n): prefix postings with n = 0; for shingles that many
    classes of the task hold, one row of class 0, and the number of such
    shingles per class as n."""
    import pyarrow as pa
    memo = WordCodes()
    grams, owners, seen, size = [], [], set(), 0

    def flush():
        g = np.concatenate(grams)
        k = np.repeat(np.array([x for x, _ in owners], dtype=np.int64), [m for _, m in owners])
        order = np.argsort(g, kind="stable")
        ranked = g[order]
        first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        count = np.diff(np.r_[first, len(g)])
        many = np.empty(len(g), dtype=bool)
        many[order] = np.repeat(count >= MANY, count)
        at, n = np.unique(k[many], return_counts=True)
        marked = ranked[first[count >= MANY]]
        # the postings stay in the order of their sets, which compresses far better
        rows = (np.r_[_signed(g[~many]), _signed(marked), at], np.r_[k[~many], np.zeros(len(marked), np.int64), at],
                np.r_[np.zeros(len(g) - many.sum() + len(marked), np.int64), n])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["gram", "class", "n"])

    for batch in batches:
        for part in batches_by_size(batch, 0, BATCH_BYTES):
            for text in part.column(0).to_pylist():
                found = shingle_set(text or b"", memo)
                key = class_key(found) if len(found) else None
                if key is None or key in seen:
                    continue
                seen.add(key)
                if len(seen) > POSTINGS:
                    seen.clear()
                m = int(prefix_size(np.int64(len(found)))[0])
                grams.append(found[:m])
                owners.append((key, m))
                size += m
                if size >= POSTINGS:
                    yield flush()
                    grams, owners, size = [], [], 0
    if grams:
        yield flush()


def _shared(batches):
    """(class, n): shingles of a task's postings that two or more classes hold."""
    import pyarrow as pa
    parts = [[np.asarray(c) for c in b.columns] for b in batches]
    if not parts:
        return
    g, k, n = (np.concatenate(x) for x in zip(*parts))
    yield pa.RecordBatch.from_arrays([pa.array(k[n > 0]), pa.array(n[n > 0])], ["class", "n"])
    g, k = g[n == 0], k[n == 0]
    if not len(g):
        return
    order = np.lexsort((k, g))
    g, k = g[order], k[order]
    new = np.r_[True, (g[1:] != g[:-1]) | (k[1:] != k[:-1])]  # equal sets of several tasks
    g, k = g[new], k[new]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    count = np.diff(np.r_[first, len(g)])
    zero = np.add.reduceat(k == 0, first) > 0
    many = np.repeat((count > 1) | zero, count) & (k != 0)
    at, n = np.unique(k[many], return_counts=True)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], ["class", "n"])


def candidate_sets(docs: DataFrame, described: DataFrame, text: str = "text") -> DataFrame:
    """(class, n, score, grams) of the classes the first filter leaves.

    ``score`` is the share of the prefix that other classes hold. The texts are
    not shuffled: they are read again for one document of each class."""
    spark = docs.sparkSession
    postings = (docs.select(F.col(text).cast("binary").alias("_text"))
                .mapInArrow(_prefixes, "gram long, class long, n long")
                .repartition(partitions(spark), "gram"))
    shared = (postings.mapInArrow(_shared, "class long, n long").groupBy("class").agg(F.sum("n").alias("shared")))
    classes = (described.where("class is not null").groupBy("class")
               .agg(F.first("n_shingles").alias("n"), F.min("doc_id").alias("first_id")))
    n, ten = F.col("n"), F.lit(MARGIN)
    least = F.ceil(F.lit(PERCENT) * n / F.lit(100.0))
    kept = (shared.join(classes, "class").where(F.col("shared") >= F.ceil(ten * least))
            .withColumn("score", F.least(F.lit(1.0), F.col("shared") / (n - least + F.ceil(ten * n)))))
    kept = written(kept.select("class", "n", "first_id", "score"), "jaccard-candidates")
    ids = checked_broadcast(kept.where("first_id is not null").select(F.col("first_id").alias("_first_id")).distinct(),
                            max_rows=1_000_000)
    chosen = (docs.select("doc_id", F.col(text).cast("binary").alias("_text"))
              .join(ids, F.col("doc_id") == F.col("_first_id"), "left")
              .where("_first_id is not null or doc_id is null").select("_text"))

    def sets(batches):
        import pyarrow as pa
        memo = WordCodes()
        for batch in batches:
            for part in batches_by_size(batch, 0, BATCH_BYTES):
                found = [x for x in (shingle_set(t or b"", memo) for t in part.column(0).to_pylist()) if len(x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([class_key(x) for x in found], pa.int64()),
                     pa.array([_signed(x) for x in found], pa.list_(pa.int64()))], ["class", "grams"])

    # the candidates' narrow rows go to the sets, not the sets to them
    rows = checked_broadcast(kept.drop("first_id"), max_rows=500_000)
    found = written(chosen.mapInArrow(sets, "class long, grams array<long>").join(rows, "class"), "jaccard-sets")
    # several rows may carry one id, or one class have several rows without id
    if found.groupBy("class").count().where("count > 1").limit(1).count():
        found = written(found.dropDuplicates(["class"]), "jaccard-sets-once")
    return found


def hub_members(sets: DataFrame) -> DataFrame:
    """Distinct (hub, class): classes meet at the hub of each shingle in their prefix.

    Shingles are ordered by the number of classes that hold them, rarest first;
    shingles no other class holds come before all, and only take up places of
    the prefix. Linked classes share a shingle in both prefixes, hence a hub."""
    # a long that orders classes by score, ties by a hash: narrow rows for the widest shuffle
    rank = F.shiftleft(F.floor(F.col("score") * (1 << 20)).cast("long"), 32).bitwiseOR(F.xxhash64("class").bitwiseAND(F.lit((1 << 32) - 1)))
    rows = sets.select("class", rank.alias("rank"), F.explode("grams").alias("gram"))
    held = (rows.groupBy("gram").agg(F.count(F.lit(1)).alias("held"), F.max_by("class", "rank").alias("hub"))
            .where("held > 1"))
    # one long orders the shingles by the number of classes, then by hash; equal places are all taken
    place = F.shiftleft(F.least(F.col("held"), F.lit((1 << 20) - 1)), 43).bitwiseOR(F.shiftrightunsigned("gram", 21))
    met = rows.select("class", "gram").join(held.select("gram", "hub", place.alias("place")), "gram").select("class", "hub", "place")
    own = Window.partitionBy("class")
    least = F.ceil(F.lit(PERCENT) * F.col("n") / F.lit(100.0))
    ranked = (met.withColumn("rank", F.rank().over(own.orderBy("place"))).withColumn("shared", F.count(F.lit(1)).over(own))
              .where(F.col("rank") <= F.ceil(F.col("shared") * (100 - PERCENT) / 100.0) + 1))
    # of n shingles the n - shared of no other class come first in the order
    return (ranked.join(sets.select("class", "n"), "class")
            .where((F.col("shared") >= least) & (F.col("rank") <= F.col("shared") - least + 1)).select("hub", "class").distinct())


def _hub_overlaps(batches):
    """(hub, class, role): 0 linked with the hub, 1 within twice the distance, 2 beyond."""
    import pyarrow as pa
    for batch in batches:
        hub, key, a, b = (batch.column(k) for k in range(4))
        role = []
        for x, y in zip(a, b):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            common = len(np.intersect1d(x, y, assume_unique=True))
            union = len(x) + len(y) - common
            role.append(0 if 100 * common >= PERCENT * union else 1 if 100 * common >= (2 * PERCENT - 100) * union else 2)
        yield pa.RecordBatch.from_arrays([hub, key, pa.array(role, pa.int32())], ["hub", "class", "role"])


def product_links(a: list[np.ndarray], b: list[np.ndarray] | None) -> np.ndarray:
    """Links (row of a, row of b) between two blocks of sets, or inside one (b None).

    The rows are multiplied in column blocks of about ``PRODUCTS`` increments;
    after each, a pair is discarded when its overlap so far plus what the
    shorter rest of the two sets could add is under its bound."""
    same = b is None
    b = a if same else b
    n_a, n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    # 100 * o >= P * (n_a + n_b - o)
    bound = -(-PERCENT * (n_a[:, None] + n_b[None, :]) // (100 + PERCENT))
    alive = np.minimum(n_a[:, None], n_b[None, :]) >= bound
    if same:
        alive &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
    overlap = np.zeros(bound.shape, dtype=np.int64)
    ga, gb = np.concatenate(a), np.concatenate(b)
    ra, rb = np.repeat(np.arange(len(a)), n_a), np.repeat(np.arange(len(b)), n_b)
    left_a, left_b = n_a.copy(), n_b.copy()
    order = np.argsort(ga, kind="stable")
    ga, ra = ga[order], ra[order]
    order = np.argsort(gb, kind="stable")
    gb, rb = gb[order], rb[order]
    columns = np.intersect1d(ga, gb)
    a0, a1 = np.searchsorted(ga, columns), np.searchsorted(ga, columns, side="right")
    b0, b1 = np.searchsorted(gb, columns), np.searchsorted(gb, columns, side="right")
    made = np.cumsum((a1 - a0) * (b1 - b0))
    start = done_a = done_b = 0
    while start < len(columns) and alive.any():
        before = made[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(made, before + PRODUCTS, side="right")))
        sizes_b = np.repeat(b1[start:end] - b0[start:end], a1[start:end] - a0[start:end])
        rows = np.repeat(ra[np.concatenate([np.arange(x, y) for x, y in zip(a0[start:end], a1[start:end])])], sizes_b)
        first_b = np.repeat(b0[start:end], a1[start:end] - a0[start:end])
        within = np.arange(len(rows)) - np.repeat(np.cumsum(sizes_b) - sizes_b, sizes_b)
        cols = rb[np.repeat(first_b, sizes_b) + within]
        overlap += np.bincount(rows * len(b) + cols, minlength=overlap.size).reshape(overlap.shape)
        left_a -= np.bincount(ra[done_a:a1[end - 1]], minlength=len(a))
        left_b -= np.bincount(rb[done_b:b1[end - 1]], minlength=len(b))
        done_a, done_b = a1[end - 1], b1[end - 1]
        alive &= overlap + np.minimum(left_a[:, None], left_b[None, :]) >= bound
        start = end
    return np.argwhere(alive & (overlap >= bound))


def _forest(links, n: int):
    """Links that join two parts so far apart."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in links:
        p, q = find(x), find(y)
        if p != q:
            parent[p] = q
            yield x, y


def _block_links(table):
    """Spanning forest of the links of a pair of blocks (side 0 and 1, or 0 alone)."""
    import pyarrow as pa
    keys, side = np.asarray(table.column("class").combine_chunks()), np.asarray(table.column("side").combine_chunks())
    grams = [x.values.to_numpy() for x in table.column("grams").combine_chunks()]
    ia, ib = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(ia) or (len(ib) == 0 and len(ia) < 2):
        found = []
    else:
        links = product_links([grams[i] for i in ia], [grams[i] for i in ib] if len(ib) else None)
        other = ib if len(ib) else ia
        found = list(_forest(((ia[x], other[y]) for x, y in links), len(keys)))
    return pa.table({"a": pa.array([keys[x] for x, _ in found], pa.int64()),
                     "b": pa.array([keys[y] for _, y in found], pa.int64())})


def links(sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect exactly the classes connected by all links."""
    members = written(hub_members(sets), "jaccard-members")
    side = sets.select("class", "grams")
    some = checked_broadcast(members.select("hub").distinct(), max_rows=1_000_000)
    hubs = side.join(some, F.col("class") == F.col("hub"), "left_semi")
    hubs = hubs.select(F.col("class").alias("hub"), F.col("grams").alias("hub_grams"))
    pairs = members.join(side, "class").join(hubs, "hub").select("hub", "class", "grams", "hub_grams")
    roles = written(pairs.mapInArrow(_hub_overlaps, "hub long, class long, role int"), "jaccard-roles")
    to_hub = roles.where("role = 0 and hub != class").select(F.col("hub").alias("a"), F.col("class").alias("b"))
    # blocks of each role at each hub; linked classes are met only by those within twice the distance
    sizes = roles.groupBy("hub", "role").agg(F.count(F.lit(1)).alias("n"))
    blocks = sizes.select("hub", "role", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    listed = blocks.select("hub", "role", "n", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    x = listed.select("hub", *[F.col(c).alias(f"a_{c}") for c in ("role", "block", "n")])
    y = listed.select("hub", *[F.col(c).alias(f"b_{c}") for c in ("role", "block", "n")])
    tasks = x.join(y, "hub").where(
        "(a_role, b_role) in ((0, 1), (1, 2)) or "
        "(a_role = b_role and a_role > 0 and a_block <= b_block and (a_block < b_block or a_n > 1))")
    tasks = written(tasks.drop("a_n", "b_n").withColumn("task", F.xxhash64("hub", "a_role", "a_block", "b_role", "b_block")), "jaccard-tasks")
    sent = tasks.select("hub", F.col("a_role").alias("role"), F.col("a_block").alias("block"), "task", F.lit(0).alias("side")).union(
        tasks.where("a_role != b_role or a_block != b_block")
        .select("hub", F.col("b_role").alias("role"), F.col("b_block").alias("block"), "task", F.lit(1).alias("side")))
    placed = (roles.join(blocks.drop("n"), ["hub", "role"])
              .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "class"), F.col("blocks")).cast("int")))
    dealt = written(placed.select("hub", "role", "block", "class").join(sent, ["hub", "role", "block"])
                    .select("task", "side", "class"), "jaccard-dealt")
    needed = checked_broadcast(dealt.select("class").distinct(), max_rows=1_000_000)
    dealt = dealt.join(side.join(needed, "class", "left_semi"), "class")
    inner = dealt.groupBy("task").applyInArrow(_block_links, "a long, b long")
    return to_hub.union(inner)


def jaccard_components(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, key, n_shingles, class, group, component_id for every document.

    ``group`` is shared by the rows of a component of two rows or more, and
    null elsewhere.
    ``component_id`` is the smallest doc_id reachable by links, the document's
    own included; a document with an empty set is linked with nothing, not even
    with other empty ones. A null id counts as larger than any other: a
    component of rows without ids has a null component_id. Rows repeated in id
    or text are documents of their own and share a class."""
    described = written(describe(docs, text), "jaccard-described")
    sets = candidate_sets(docs, described, text)
    joined = components(links(sets), "a", "b", "jaccard-links")
    classes = (described.where("class is not null").groupBy("class")
               .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")))
    classes = classes.join(joined.withColumnRenamed("node", "class"), "class", "left")
    linked = classes.where("component is not null")
    first = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    # the classes of two rows or more, and those linked; every other row stands alone
    named = linked.join(first, "component").select("class", "component_id", F.col("component").alias("group")).union(
        classes.where("component is null and copies > 1").select("class", "first_id", "class"))
    named = written(named.withColumnRenamed("class", "_class"), "jaccard-named")
    return (described.join(named, F.col("class") == F.col("_class"), "left")
            .select("doc_id", "key", "n_shingles", "class", "group",
                    F.when(F.col("group").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Documents of ``docs`` that come first in their component: least id (null
    last), then least text hash. Of rows repeated in id and text one stays."""
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    rows = written(found.where("group is not null").select("group", order.alias("order"), "key"), "jaccard-grouped")
    first = written(rows.groupBy("group").agg(F.min(F.struct("order", "key")).alias("_first")), "jaccard-first")
    names = [free_name(docs, n) for n in ("_order", "_key")]
    gone = (rows.join(first, "group").where(F.struct("order", "key") != F.col("_first"))
            .select("order", "key").distinct().toDF(*names))
    gone = checked_broadcast(written(gone, "jaccard-gone"), 1_000_000)
    named = docs.withColumn(names[0], order).withColumn(names[1], text_key(F.col("text")))
    kept = named.join(gone, names, "left_anti")
    repeated = rows.groupBy("order", "key").count().where("count > 1").select("order", "key").toDF(*names)
    repeated = written(repeated, "jaccard-repeated")
    if repeated.limit(1).count():
        once = kept.join(repeated, names, "left_semi").dropDuplicates(names)
        kept = kept.join(repeated, names, "left_anti").unionByName(once)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
