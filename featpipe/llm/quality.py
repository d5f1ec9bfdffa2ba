"""Quality rules: base rules, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte n-grams are counted: one over every document
(the raw corpus), one over trusted documents (the target). A document's score
is the mean over its n-grams of ``log p_target - log p_raw``; a document whose
score is under ``min_score`` is rejected. The scores do not depend on the
layout of the data, so every document gets the same verdict in every run.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featpipe.llm.common import WordCodes, batches_by_size, ngram_hashes

#: Hash buckets of the multinomials (two counts each are brought to the driver).
BUCKETS = 1 << 16
#: Consecutive bytes of an n-gram.
GRAM = 4
#: Trusted documents the target multinomial is fitted on at most, chosen by a hash of their id.
TARGET_ROWS = 20_000
#: Weight of the corpus in the smoothed target: an n-gram the target lacks scores log(SMOOTHING).
SMOOTHING = 0.01
#: Lowest accepted score, in nats per n-gram. A text drawn like the target scores
#: about 0 or above; -0.6 means n-grams 1.8 times rarer in the target than in the
#: corpus, on (geometric) average.
MIN_SCORE = -0.6
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
BATCH_BYTES = 4 << 20

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, score double, kept boolean")


def buckets(text: bytes) -> np.ndarray:
    """Bucket of each n-gram of the text."""
    b = np.frombuffer(text, dtype=np.uint8)
    m = len(b) - GRAM + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint32)
    h = b[:m].astype(np.uint32)
    for k in range(1, GRAM):
        h |= b[k:k + m].astype(np.uint32) << np.uint32(8 * k)
    return (h * np.uint32(2654435761)) >> np.uint32(16)


def repeated_words(codes: np.ndarray, n: int = 3) -> int:
    """Words inside windows of ``n`` words that occur twice or more."""
    grams = ngram_hashes(codes, n)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams)
    ranked = grams[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(grams), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    covered = np.zeros(len(codes), dtype=bool)
    for k in range(n):
        covered[k:k + len(grams)] |= hit
    return int(covered.sum())


def base_counts(text: bytes, memo: WordCodes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = text.split()
    chars = len(text.translate(None, SPACES + bytes(range(0x80, 0xC0))))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(memo.codes(words))


def _counts(batches):
    """(bucket, raw, target) of all n-grams in a task's documents."""
    import pyarrow as pa
    raw, target = (np.zeros(BUCKETS, dtype=np.int64) for _ in range(2))
    for batch in batches:
        for part in batches_by_size(batch, 0, BATCH_BYTES):
            for text, trusted in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if text:
                    n = np.bincount(buckets(text), minlength=BUCKETS)
                    raw += n
                    if trusted:
                        target += n
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])],
                                     ["bucket", "raw", "target"])


def trusted_ids(labels: DataFrame, max_rows: int = TARGET_ROWS) -> DataFrame:
    """Ids of documents labelled good and not toxic; ``max_rows`` at most, by a hash of the id."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull()
    return (labels.where(good).select(F.col("doc_id").alias("_trusted_id")).distinct()
            .orderBy(F.xxhash64("_trusted_id"), "_trusted_id").limit(max_rows))


def fit(docs: DataFrame, labels: DataFrame, target_rows: int = TARGET_ROWS) -> np.ndarray:
    """Log-likelihood ratio per bucket; all zeros without trusted documents.

    The corpus side counts every document. The broadcast holds ``target_rows``
    ids at most; what comes to the driver is two counts per bucket."""
    ids = F.broadcast(trusted_ids(labels, target_rows))
    flagged = (docs.select(F.col("text").cast("binary").alias("_text"), F.col("doc_id").alias("_id"))
               .where("_text is not null")
               .join(ids, F.col("_id") == F.col("_trusted_id"), "left")
               .select("_text", F.col("_trusted_id").isNotNull().alias("_trusted")))
    counts = (flagged.mapInArrow(_counts, "bucket long, raw long, target long")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())
    raw, target = (np.zeros(BUCKETS) for _ in range(2))
    for r in counts:
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not target.sum():
        return np.zeros(BUCKETS)
    # the target is smoothed with the corpus by a share of its own size, so that an n-gram
    # it lacks counts the same at every size
    corpus = (raw + 1) / (raw.sum() + BUCKETS)
    p_target = (target / target.sum() + SMOOTHING * corpus) / (1 + SMOOTHING)
    return np.log(p_target / corpus)


def score_documents(docs: DataFrame, ratio: np.ndarray, min_score: float = MIN_SCORE,
                    keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` plus the base counts, ``base_failed``, ``score`` and ``kept``.

    A null or empty text has no words, so it fails the base rules; its score is 0."""
    ratio = ratio.astype(np.float64)
    kinds = dict(docs.dtypes)

    def run(batches):
        import pyarrow as pa
        memo = WordCodes()
        for batch in batches:
            for part in batches_by_size(batch, 0, BATCH_BYTES):
                rows = []
                for text in part.column(0).to_pylist():
                    text = text or b""
                    n, chars, symbols, dups, repeats = base_counts(text, memo)
                    failed = n < 50 or 100 * repeats > 50 * n
                    grams = buckets(text)
                    score = float(ratio[grams].mean()) if len(grams) else 0.0
                    rows.append((n, chars, symbols, dups, repeats, failed, score, not failed and score >= min_score))
                made = [pa.array(x) for x in zip(*rows)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *made],
                                                 [*keep, *[x.split()[0] for x in RESULT.split(", ")]])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), RESULT])
    return docs.select(F.col("text").cast("binary").alias("_text"), *keep).mapInArrow(run, schema)


def quality_rules(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE,
                  target_rows: int = TARGET_ROWS) -> DataFrame:
    """One row per document: doc_id, base counts, base_failed, score, kept.

    Documents with null ids are scored like any other; repeated rows give
    repeated results; an empty table gives an empty result."""
    return score_documents(docs, fit(docs, labels, target_rows), min_score)


def accepted(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE,
             target_rows: int = TARGET_ROWS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    columns = docs.columns
    clear = docs.toDF(*[f"_{k}" for k in range(len(columns))])
    clear = clear.withColumn("doc_id", F.col(f"_{columns.index('doc_id')}")).withColumn("text", F.col(f"_{columns.index('text')}"))
    scored = score_documents(clear, fit(clear, labels, target_rows), min_score, tuple(clear.columns[:len(columns)]))
    return scored.where("kept").select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(columns)])
