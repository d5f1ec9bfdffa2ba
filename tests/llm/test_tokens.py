import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from featpipe.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
COUNTER = tokens.Counter(PATH, tokens.character_classes())
LIBRARY = Tokenizer.from_file(PATH)


def library(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text(texts):
    assert COUNTER.count(texts).tolist() == library(texts)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=list("abst'relvmd ST0½\n\t　\x85é中\U0001f600!<|>"), max_size=120))
def test_contractions_spaces_and_runs(text):
    assert COUNTER.count([text]).tolist() == library([text])


def test_special_strings_chunks_and_long_runs():
    texts = ["<|endoftext|>", " <|endoftext|> a<|endoftext|><|endoftext|>b", "", "a" * 5000, " " * 129 + "x", "'s" * 200,
             "\n" * 64 + " y", "x" * 63 + "'s", "don't'd've'LL", "!'s ''re", " 's  's\n's"]
    assert COUNTER.count(texts).tolist() == library(texts)


def test_every_character_has_the_librarys_class():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    blocks = ["".join(f"a{c}1{c}!{c} " for c in points[k:k + 5000]) for k in range(0, len(points), 5000)]
    assert COUNTER.count(blocks).tolist() == library(blocks)


def test_forgetful_transducers_count_the_same(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdeth ") for _ in range(300)) for _ in range(20)]
    want = COUNTER.count(texts).tolist()
    monkeypatch.setattr(tokens, "MEMO_TOKENS", 3)
    monkeypatch.setattr(tokens, "MEMO_STATES", 5)
    assert tokens.Counter(PATH, tokens.character_classes()).count(texts).tolist() == want == library(texts)


def test_other_tokenizers_are_refused():
    with pytest.raises((ValueError, TypeError, KeyError)):
        tokens.Counter(public_tokenizers.path("word_bpe_49k.json"), tokens.character_classes())


def test_table(spark, awkward, no_docs):
    assert tokens.count_tokens(no_docs, PATH).count() == 0
    clash = awkward.withColumn("n_tokens", F.lit("x")).withColumn("_text", F.lit(1))
    want = [(r.doc_id, len((r.text or "").encode()), n, n > 1024) for r, n in zip(awkward.collect(), library([r.text or "" for r in awkward.collect()]))]
    got = [tuple(r) for r in tokens.count_tokens(clash, PATH).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
