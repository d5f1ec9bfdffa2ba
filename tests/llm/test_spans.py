import random
import re
import zlib

import numpy as np
import xxhash

from featpipe.llm import spans

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def random_words(seed, n):
    rng = random.Random(seed)
    lengths = [1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 24, 31, 32, 33, 40, 63, 64, 65, 90, 700]
    return [bytes(rng.choice(b"abXY09\xc3\xa9") for _ in range(rng.choice(lengths))) for _ in range(n)]


def test_words_hashes_and_ids():
    words = random_words(1, 2000)
    w = spans.words_of([b"  " + b" ,.".join(words) + b"!", b"", b"...", b"one Two one"])
    got = [w.buffer[s:s + n].tobytes() for s, n in zip(w.starts, w.lengths)]
    assert got == [x.lower() for x in words] + [b"one", b"two", b"one"]
    assert set(w.piece[-3:]) == {3} and set(w.piece[:-3]) == {0}
    table = spans.Table(w.buffer, w.lanes, w.starts, w.lengths)
    for key, s, n in zip(table.keys, table.starts, table.lengths):
        assert key == xxhash.xxh64_intdigest(w.buffer[s:s + n].tobytes())
    ids = dict(zip(got, table.ids))
    assert len(ids) == len(table.counts) == len(set(ids.values())) and all(ids[x] == i for x, i in zip(got, table.ids))
    crc = table.crc32()
    for x, i in ids.items():
        assert table.counts[i] == got.count(x) and crc[i] == zlib.crc32(x)


def test_equal_keys_are_told_apart_by_their_bytes(monkeypatch):
    """With all hashes equal, spans share a slot only when their bytes are equal."""
    monkeypatch.setattr(spans, "hashes", lambda buffer, lanes, starts, lengths: np.zeros(len(starts), dtype=np.uint64))
    words = random_words(2, 120) * 2
    w = spans.words_of([b" ".join(words)])
    table = spans.Table(w.buffer, w.lanes, w.starts, w.lengths)
    assert len(table.counts) == len({x.lower() for x in words})
    other = spans.words_of([b" ".join(words[:40] + [b"nothere", b"q"])])
    found = table.find(*other[:4])
    assert list(found[:40]) == list(table.ids[:40]) and list(found[40:]) == [-1, -1]


def test_texts_are_cut_between_words():
    words = random_words(3, 400)
    text = b" . ".join(words)
    for limit in (3, 10, 64, 500, 10_000):
        plain = [WORD.findall(part) for part, _ in spans.pieces(text, limit, False)]
        assert [x for p in plain for x in p] == words
        pairs, seen = [], []
        for part, carried in spans.pieces(text, limit, True):
            own = WORD.findall(part)
            pairs += list(zip(own, own[1:]))
            seen += own[1:] if carried else own
        assert seen == words and pairs == list(zip(words, words[1:]))
    assert list(spans.text_blocks([None, b"", b"a b"])) == [([b"a b"], [2], [False])]


def test_no_words():
    w = spans.words_of([b"..."])
    table = spans.Table(w.buffer, w.lanes, w.starts, w.lengths)
    assert len(table.counts) == 0 and len(table.crc32()) == 0
    other = spans.words_of([b"a b"])
    assert list(table.find(*other[:4])) == [-1, -1]
