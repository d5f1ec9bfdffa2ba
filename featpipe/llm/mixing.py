"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. The documents are range-sorted by
(source, key), distributed prefix sums of their word counts are formed, and
each source is cut where its budget ends; a budget beyond the source's size
takes whole epochs first and cuts the last one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featpipe.llm.common import checked_broadcast, free_name, n_words, written
from featpipe.llm.prefix import prefix_sums

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: Epochs a source may be repeated at most.
MAX_EPOCHS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source_no, source, source_size, target, budget) from rows (source, size).

    The targets share the sum of all sizes by weight; a target stops at
    ``max_epochs`` times its source's size and the excess is reshared by weight
    among the others until none is above. That fixed point gives every source
    ``min(cap, level * weight)`` for one common level: sources are taken in the
    order of cap / weight, and the level follows from the running sums. One row
    per source enters the windows.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (by_source.withColumn("source_no", F.row_number().over(rank).cast("long"))
              .withColumn("weight", F.element_at(listed, ((F.col("source_no") - 1) % len(weights) + 1).cast("int")))
              .withColumn("cap", F.col("source_size") * F.lit(max_epochs)))
    order = [F.col("cap") / F.col("weight"), F.col("source_no")]
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))))
    open_ = ranked.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("weight") <= F.col("cap"))
    # the first source that stays under its cap fixes the level of all after it
    first = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    settled = F.first(F.when(F.col("_open"), F.col("_level")), ignorenulls=True).over(first)
    target = F.coalesce(F.least(settled * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double"))
    return open_.select("source_no", "source", "source_size", target.alias("target"),
                        F.least(F.floor(target + 0.5), F.col("cap")).cast("long").alias("budget"))


def order_key(seed: str = "mix") -> Column:
    """Hash-random key of a document: from the seed, its id and its text."""
    text = F.md5(F.coalesce(F.col("text"), F.lit("")))
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, key, source, source_no, size, source_size,
    target, budget, epochs (whole ones), before (words of its source ahead of it) and taken.

    ``taken`` counts the words the mix takes of the document over all epochs;
    the last document of an epoch is cut, so that a source's taken words equal
    its rounded target. A null text has size 0 and takes part with no words;
    null sources form one source, ordered last. Rows equal in id and text have
    equal keys; which of them comes first does not change the result as a
    whole. An empty table gives an empty result."""
    rows = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), order_key(seed).alias("key")),
                   "mix-rows")
    targets = written(source_targets(rows.select("source", "size"), weights, max_epochs), "mix-targets")
    side = checked_broadcast(targets.withColumnRenamed("source", "_source"))
    placed = rows.join(side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = prefix_sums(placed, "source_no", ["key", "doc_id", "size"], "size", "mix-order")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.greatest(F.col("source_size"), F.lit(1))))
    placed = placed.withColumn("epochs", F.coalesce(whole, F.lit(0)).cast("long"))
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    last = F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size"))
    return placed.withColumn("taken", (F.col("epochs") * F.col("size") + last).cast("long"))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
            seed: str = "mix") -> DataFrame:
    """The rows of the mix, in whole documents: ``docs`` repeated as often as they are taken.

    The document at a source's cut is in the last epoch when at least half of
    it is inside the budget. Documents without words are left out. Each source
    comes down to its epochs and the key its last epoch ends at, so the texts
    are not shuffled."""
    mixed = mix(docs, weights, max_epochs, seed)
    extra = F.col("taken") - F.col("epochs") * F.col("size")
    cuts = mixed.where("size > 0").groupBy("source").agg(
        F.first("epochs").alias("_epochs"), F.min(F.when(2 * extra < F.col("size"), F.col("key"))).alias("_cut"))
    source, epochs, cut, own, copy = (free_name(docs, n) for n in ("_source", "_epochs", "_cut", "_key", "_copy"))
    cuts = checked_broadcast(written(cuts.toDF(source, epochs, cut), "mix-cuts"))
    last = F.when(F.col(cut).isNull() | (F.col(own) < F.col(cut)), 1).otherwise(0)
    copies = F.when(n_words(F.col("text")) > 0, F.col(epochs) + last).otherwise(0).cast("int")
    named = docs.withColumn(own, order_key(seed)).join(cuts, F.col("source").eqNullSafe(F.col(source)))
    return (named.withColumn(copy, copies).where(F.col(copy) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


ORACLE = r"""
with rows as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         md5('mix:' || coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as key
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from rows group by source),
r as (select *, row_number() over (order by source nulls last) as source_no from s),
w as (select *, cast((source_no - 1) % 3 + 1 as double) as weight, 3 * source_size as cap from r),
l as (select *, (sum(source_size) over () - coalesce(sum(cap) over o, 0))
                / (sum(weight) over () - coalesce(sum(weight) over o, 0)) as level
      from w window o as (order by cap / weight, source_no rows between unbounded preceding and 1 preceding)),
f as (select *, first_value(case when level * weight <= cap then level end ignore nulls)
                over (order by cap / weight, source_no rows between unbounded preceding and current row) as settled
      from l),
t as (select *, coalesce(least(settled * weight, cast(cap as double)), cast(cap as double)) as target from f),
b as (select *, least(cast(floor(target + 0.5) as bigint), cap) as budget from t),
p as (select rows.doc_id, rows.size, b.source_no, b.source_size, b.target, b.budget,
             coalesce(sum(rows.size) over (partition by b.source_no order by rows.key, rows.doc_id, rows.size
               rows between unbounded preceding and 1 preceding), 0) as before,
             case when b.source_size > 0 then b.budget // b.source_size else 0 end as epochs
      from rows join b on rows.source is not distinct from b.source)
select doc_id, cast(size as bigint) as size, source_size, floor(target * 1000 + 0.5) / 1000 as target,
       cast(epochs * size + least(greatest(budget - epochs * source_size - before, 0), size) as bigint) as taken
from p
"""
