"""Language of mixed-language texts: script ranges, then Viterbi over per-word scores.

A naive Bayes model over hashed character trigrams gives each word a
log-probability per language. The script of a word's letters narrows the
candidates to languages seen in that script. Viterbi over a document's words,
with a penalty for each switch, labels spans; the document's language is the
one whose spans hold most letters.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featpipe.llm.common import batches_by_size

BUCKETS = 1 << 16
#: Labelled rows the model is fitted on, about, chosen by a hash of their id, per language.
TRAIN_ROWS = 10_000
#: Cost of a switch of language between two words, in nats.
SWITCH = 8.0
#: Share of a language's training letters a script needs to make the language a candidate.
SCRIPT_SHARE = 0.01
BATCH_BYTES = 2 << 20

# First and last code point of the main blocks of each script.
SCRIPTS = (
    ("latin", ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F),)),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF),)),
    ("hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF),)),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF))),
)
OTHER_SCRIPT = len(SCRIPTS) + 1


def letter_scripts() -> np.ndarray:
    """Per code point: 0 no letter, otherwise 1 + the script's number."""
    import regex
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(0x110000, dtype=np.uint8)
    letters = np.array([ord(c) for c in regex.findall(r"\p{L}", points)])
    kind = np.full(0x110000, OTHER_SCRIPT, dtype=np.uint8)
    for k, (_, ranges) in enumerate(SCRIPTS):
        for first, last in ranges:
            kind[first:last + 1] = k + 1
    out[letters] = kind[letters]
    return out


class Words:
    """Words of many texts: runs of letters, with their trigram buckets."""

    def __init__(self, texts: list[str], scripts: np.ndarray):
        lowered = [t.lower() for t in texts]
        sizes = np.fromiter(map(len, lowered), dtype=np.int64, count=len(lowered))
        whole = " " + "  ".join(lowered) + "  "
        points = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        first = 1 + np.concatenate(([0], np.cumsum(sizes[:-1] + 2))) if len(sizes) else np.empty(0, np.int64)
        self.script_of = scripts[points]
        letter = self.script_of > 0
        edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        self.start, self.stop = edge[::2], edge[1::2]  # starts and ends with a space
        self.doc = np.searchsorted(first, self.start, side="right") - 1
        clean = np.where(letter, points, 32).astype(np.uint32)
        h = clean[:-2] * np.uint32(0x9E3779B1) + clean[1:-1] * np.uint32(0x85EBCA77) + clean[2:] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        self.bucket = (h * np.uint32(0x27D4EB2F)) >> np.uint32(16)

    def letters(self) -> np.ndarray:
        return self.stop - self.start

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the words' trigrams (a space on either side belongs to the
        word), and the offset of each word's first."""
        n = self.letters()
        offset = np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else np.empty(0, np.int64)
        within = np.arange(int(n.sum())) - np.repeat(offset, n)
        return self.bucket[np.repeat(self.start - 1, n) + within], offset

    def script(self) -> np.ndarray:
        """Script of each word's first letter."""
        return self.script_of[self.start]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Model:
    """Log-probabilities by bucket and language, and the candidates by script."""

    def __init__(self, languages: list[str], grams: np.ndarray, letters: np.ndarray):
        self.languages = languages
        total = grams.sum(axis=0)
        self.log_p = np.log((grams + 0.5) / (total + 0.5 * BUCKETS)).astype(np.float32)
        share = letters / np.maximum(letters.sum(axis=0), 1)
        candidate = share >= SCRIPT_SHARE
        candidate[~candidate.any(axis=1)] = True  # a script no language was seen in
        self.barred = np.where(candidate, 0.0, -1e4).astype(np.float32)


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | None:
    """Model of the languages named in ``docs`` outside the held-out fold; None without any.

    At most about ``train_rows`` rows of each language are read, those with the
    lowest hash of the id. Trigram counts are summed per task first; what comes
    to the driver is one count per language and bucket."""
    scripts = letter_scripts()
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    totals = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return None
    languages = sorted(totals)
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, train_rows / totals[k])))])
    chance = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.where(chance < share[F.col("lang")]).select("lang", F.col("text").cast("binary").alias("_text"))
    number = {k: i for i, k in enumerate(languages)}

    def counts(batches):
        import pyarrow as pa
        grams = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        seen = np.zeros((len(languages), OTHER_SCRIPT + 1), dtype=np.int64)
        for batch in batches:
            for part in batches_by_size(batch, 1, BATCH_BYTES):
                names = part.column(0).to_pylist()
                words = Words([t.decode("utf-8", "replace") for t in part.column(1).to_pylist()], scripts)
                of = np.array([number[x] for x in names])[words.doc]
                bucket, _ = words.grams()
                n = words.letters()
                grams += np.bincount(np.repeat(of, n) * BUCKETS + bucket,
                                     minlength=grams.size).reshape(grams.shape)
                seen += np.bincount(of * seen.shape[1] + words.script(), weights=n,
                                    minlength=seen.size).reshape(seen.shape).astype(np.int64)
        table = np.concatenate([grams, seen], axis=1)
        at, bucket = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bucket), pa.array(table[at, bucket])],
                                         ["language", "bucket", "n"])

    found = (sample.mapInArrow(counts, "language long, bucket long, n long")
             .groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas())
    both = np.zeros((BUCKETS + OTHER_SCRIPT + 1, len(languages)))
    both[found.bucket.to_numpy(), found.language.to_numpy()] = found.n.to_numpy()
    return Model(languages, both[:BUCKETS], both[BUCKETS:])


def viterbi(scores: np.ndarray, doc: np.ndarray, switch: float) -> np.ndarray:
    """Best language of each word. ``doc`` is ascending; all documents advance
    one word at a time together, the longest first."""
    n_words, n_lang = scores.shape
    labels = np.zeros(n_words, dtype=np.int64)
    if not n_words:
        return labels
    _, first, sizes = np.unique(doc, return_index=True, return_counts=True)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    steps = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # documents longer than the step
    best = scores[first]
    moved = np.zeros((n_words, n_lang), dtype=bool)
    source = np.zeros(n_words, dtype=np.uint8 if n_lang <= 256 else np.int64)
    final = np.zeros(len(first), dtype=np.int64)
    for step in range(1, steps):
        k = active[step]
        if k < active[step - 1]:
            final[k:active[step - 1]] = best[k:].argmax(axis=1)
        best = best[:k]
        at = first[:k] + step
        top = best.argmax(axis=1)
        reach = best[np.arange(k), top][:, None] - np.float32(switch)
        moved[at] = best < reach
        source[at] = top
        best = scores[at] + np.maximum(best, reach)
        best -= best.max(axis=1, keepdims=True)
    final[:len(best)] = best.argmax(axis=1)
    now = final[:0]
    for step in range(steps - 1, -1, -1):
        k = active[step]
        if k > len(now):
            now = np.concatenate([now, final[len(now):k]])
        at = first[:k] + step
        labels[at] = now
        now = np.where(moved[at, now], source[at], now)
    return labels


def _predict(texts: list[str], model: Model, scripts: np.ndarray, switch: float):
    """Words, their labels, and the letters of each text by language."""
    words = Words(texts, scripts)
    bucket, offset = words.grams()
    if len(offset):
        scores = np.add.reduceat(model.log_p[bucket], offset, axis=0) + model.barred[words.script()]
    else:
        scores = np.zeros((0, len(model.languages)), dtype=np.float32)
    labels = viterbi(scores, words.doc, switch)
    width = len(model.languages)
    letters = np.bincount(words.doc * width + labels, weights=words.letters(),
                          minlength=len(texts) * width).reshape(len(texts), width)
    return words, labels, letters


def spans(texts: list[str], model: Model, scripts: np.ndarray, switch: float = SWITCH) -> list[list[tuple[int, str]]]:
    """Per text the (number of words, language) of its spans, in order."""
    words, labels, _ = _predict(texts, model, scripts, switch)
    out: list = [[] for _ in texts]
    cut = np.flatnonzero(np.diff(words.doc, prepend=-1) | np.diff(labels, prepend=-1))
    for a, b in zip(cut, [*cut[1:], len(labels)]):
        out[words.doc[a]].append((int(b - a), model.languages[labels[a]]))
    return out


def identify(docs: DataFrame, model: Model | None, switch: float = SWITCH) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans of every whole text.

    ``lang_pred`` is the language whose spans hold most letters, ``score`` its
    share of the letters. A null text, or one without letters, is ``und`` with
    score 0, and so is every text when there was nothing to learn from. Only
    the text enters the prediction."""
    kind = dict(docs.dtypes)["doc_id"]
    scripts = letter_scripts()

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for part in batches_by_size(batch, 2, BATCH_BYTES):
                texts = [(t or b"").decode("utf-8", "replace") for t in part.column(2).to_pylist()]
                if model is None:
                    name, score, n_spans = ["und"] * len(texts), [0.0] * len(texts), [0] * len(texts)
                else:
                    words, labels, letters = _predict(texts, model, scripts, switch)
                    total = letters.sum(axis=1)
                    top = letters.argmax(axis=1)
                    score = (letters.max(axis=1) / np.maximum(total, 1)).tolist()
                    name = [model.languages[k] if n else "und" for k, n in zip(top, total)]
                    cut = (np.diff(words.doc, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0)
                    n_spans = np.bincount(words.doc[cut], minlength=len(texts)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(name, pa.string()), pa.array(score, pa.float64()),
                     pa.array(n_spans, pa.int64())], ["doc_id", "held_out", "lang_pred", "score", "n_spans"])

    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("_text"))
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, n_spans long"))
