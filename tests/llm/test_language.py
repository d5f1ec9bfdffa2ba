import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from featpipe.llm import language
from tests.llm.conftest import make_docs

SYLLABLES = {"xx": "ka lo mi tu sen bar".split(), "yy": "pfe schü tze gro lich ung".split(), "zz": "жи ро ва ли сто при".split()}


def speak(lang, rng, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def corpus():
    rng = random.Random(0)
    rows = []
    for k in range(600):
        lang = rng.choice(["xx", "yy", "zz"])
        rows.append((k, speak(lang, rng, rng.randrange(5, 80)), lang if k % 11 else None, "s"))
    return rows, rng


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(make_docs(spark, corpus()[0]))


def test_held_out_accuracy(spark, model):
    rows, _ = corpus()
    out = {r.doc_id: r for r in language.identify(make_docs(spark, rows), model).collect()}
    assert len(out) == len(rows)
    for r in rows:
        assert out[r[0]].held_out == (zlib.crc32(str(r[0]).encode()) % 3 == 1)
    held = [r for r in rows if out[r[0]].held_out and r[2]]
    assert sum(out[r[0]].lang_pred == r[2] for r in held) >= 0.98 * len(held) and len(held) > 100
    assert all(0 <= r.score <= 1 for r in out.values())


def test_held_out_rows_and_other_columns_are_not_used(spark):
    rows, _ = corpus()
    lied = [(d, t, "lie" if zlib.crc32(str(d).encode()) % 3 == 1 else lang, f"s{d}") for d, t, lang, _ in rows]
    a, b = language.fit(make_docs(spark, rows)), language.fit(make_docs(spark, lied))
    assert a.languages == b.languages == ["xx", "yy", "zz"] and np.array_equal(a.log_p, b.log_p)
    moved = make_docs(spark, [(d + 10_000, t, "q", "r") for d, t, _, _ in rows])
    first = [(r.lang_pred, r.score) for r in language.identify(make_docs(spark, rows), a).orderBy("doc_id").collect()]
    assert first == [(r.lang_pred, r.score) for r in language.identify(moved, a).orderBy("doc_id").collect()]


def test_spans_of_mixed_text(model):
    rng = random.Random(3)
    text = speak("xx", rng, 30) + " " + speak("yy", rng, 25) + " " + speak("zz", rng, 10) + " " + speak("xx", rng, 40)
    found = language.spans([text, "", "1 2 3"], model, language.letter_scripts())
    assert [s[1] for s in found[0]] == ["xx", "yy", "zz", "xx"]
    assert all(abs(n - m) <= 2 for (n, _), m in zip(found[0], (30, 25, 10, 40)))
    assert found[1:] == [[], []]


def test_viterbi_matches_plain_search():
    rng = np.random.default_rng(1)
    for sizes in ([5, 1, 9, 3], [12], [2, 2]):
        scores = rng.normal(0, 4, (sum(sizes), 3)).astype(np.float32)
        got = language.viterbi(scores, np.repeat(np.arange(len(sizes)), sizes), 2.0)
        at = 0
        for n in sizes:
            s = scores[at:at + n].astype(float)
            best = [s[0]]
            for row in s[1:]:
                best.append(row + np.maximum(best[-1], best[-1].max() - 2.0))
            path = got[at:at + n]
            total = s[np.arange(n), path].sum() - 2.0 * (path[1:] != path[:-1]).sum()
            assert abs(total - best[-1].max()) < 1e-3
            at += n


def test_script_narrows_candidates(model):
    barred = model.barred
    scripts = language.letter_scripts()
    cyrillic, latin = scripts[ord("ж")], scripts[ord("a")]
    zz = model.languages.index("zz")
    assert barred[cyrillic, zz] == 0 and (np.delete(barred[cyrillic], zz) < 0).all()
    assert barred[latin, zz] < 0 and scripts[ord("1")] == 0 and scripts[ord("中")] not in (0, latin)


def test_edges(spark, model, awkward, no_docs):
    assert language.identify(no_docs, model).count() == 0 and language.fit(no_docs) is None
    out = language.identify(awkward, model)
    assert out.count() == awkward.count()
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect() if r.doc_id}
    assert got[3] == got[4] == got[5] == got[9] == ("und", 0.0)
    assert all(r.lang_pred == "und" for r in language.identify(awkward, None).collect())
    clash = awkward.withColumn("score", F.lit("x")).withColumn("_text", F.lit(1)).withColumn("held_out", F.lit(2))
    assert sorted(map(repr, language.identify(clash, model).collect())) == sorted(map(repr, out.collect()))
    assert language.fit(awkward).languages == ["de", "en", "fr"]
    few = language.fit(awkward, train_rows=1)
    assert few is not None and language.identify(awkward, few).count() == awkward.count()
