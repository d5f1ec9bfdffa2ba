import hashlib
import random
import struct

import regex
import xxhash
from pyspark.sql import functions as F

from featpipe.llm import fingerprints as fp
from tests.llm.conftest import changed, make_docs, prose

SECOND = xxhash.xxh64_intdigest(struct.pack("<i", 1), seed=42)


def plain_simhash(text):
    words = regex.findall(r"[\p{L}\p{N}]+", text.lower())
    weight = [(min(len(w), 16) ** 2 + 15) // 16 for w in words]
    out = ""
    for seed in (42, SECOND):
        h = [xxhash.xxh64_intdigest(w.encode(), seed=seed) for w in words]
        bits = sum(1 << k for k in range(64) if 2 * sum(v for v, x in zip(weight, h) if x >> k & 1) > sum(weight))
        out += f"{bits:016x}"
    return out


def alike(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128


def near(a, b):
    x = int(a, 16) ^ int(b, 16)
    return min((x >> 64).bit_count(), (x & (1 << 64) - 1).bit_count()) <= fp.RADIUS


def brute(docs):
    """The contract for distinct (id, text) rows, and groups from all pairs."""
    order = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        q = len(text) // 4
        edited = text[:len(text) - q] + after[:q]
        a, b, c = plain_simhash(text), plain_simhash(edited), plain_simhash(after)
        out.append([doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, alike(a, b), alike(a, c)])
    group = {r[3]: r[3] for r in out}
    for _ in group:
        for a in group:
            group[a] = min([group[a]] + [group[b] for b in group if near(a, b)])
    for r in out:
        own = [s[0] for s in out if s[3] == r[3] and s[0] is not None]
        whole = [s[0] for s in out if group[s[3]] == group[r[3]] and s[0] is not None]
        r += [min(own, default=None), min(whole, default=None)]
    return sorted(map(tuple, out), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_matches_brute_force(spark):
    docs = [(3 * k, " ".join(prose(k, 3 + 11 * k % 160))) for k in range(60)]
    base = prose(500, 300)
    docs += [(1000 + k, " ".join(changed(base, k, k % 4))) for k in range(30)] + [(1100 + k, docs[k][1]) for k in range(9)]
    docs += [(2000, None), (2001, ""), (2002, "é日本 \U0001f600\n x"), (2003, "..."), (None, "Zeta eta"), (-5, "one two three four")]
    random.Random(1).shuffle(docs)
    got = rows_of(fp.fingerprints(make_docs(spark, docs).repartition(5)))
    assert got == brute(docs)
    assert len({r[8] for r in got}) < len({r[7] for r in got})  # some groups have several classes


def test_near_words_against_all_pairs(spark):
    """Groups from the common points are those of all pairs within the radius, chains and hot buckets included."""
    rng = random.Random(6)
    words = {rng.getrandbits(64) for _ in range(200)}
    for seed in list(words)[:12]:
        words |= {seed ^ sum(1 << k for k in rng.sample(range(64), n)) for n in (1, 2, 2, 3, 3, 4)}
    centre = rng.getrandbits(64)
    words |= {centre ^ sum(1 << k for k in rng.sample(range(64), rng.choice([1, 2, 3]))) for _ in range(250)}
    signed = [fp._signed(w) for w in words]
    found = fp.near_words(spark.createDataFrame([(w,) for w in signed], "word long").repartition(4)).collect()

    def roots(links):
        group = {w: w for w in signed}

        def top(w):
            while group[w] != w:
                w = group[w]
            return w
        for u, v in links:
            a, b = sorted((top(u), top(v)))
            group[b] = a
        return {w: top(w) for w in signed}

    close = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    assert all(close(u, v) <= 2 for u, v in found)
    pairs = [(a, b) for a in signed for b in signed if a < b and close(a, b) <= 2]
    assert roots(found) == roots(pairs) and len(pairs) > 500
    assert len(found) <= 65 * len(signed)


def test_edited_is_nearer_than_next(spark):
    docs = [(k, " ".join(prose(k, 250, 100_000))) for k in range(80)]
    rows = fp.fingerprints(make_docs(spark, docs)).collect()
    assert sum(r.near_edited > r.near_next for r in rows) >= 78
    assert min(r.near_edited for r in rows) > 0.6 > sum(r.near_next for r in rows) / len(rows)


def test_awkward_rows(spark, awkward, no_docs):
    clash = awkward.withColumn("fingerprint", F.lit("x")).withColumn("_order", F.lit(1)).withColumn("_key", F.lit(2)).withColumn("a", F.lit(0))
    got = fp.fingerprints(clash).collect()
    assert len(got) == awkward.count()
    texts = {r.text or "" for r in awkward.collect()}
    assert {r.fingerprint for r in got} == {plain_simhash(t) for t in texts}
    assert len({(r.doc_id, r.n_chars, r.fingerprint, r.edited_sha256) for r in got}) == len({(r.doc_id, r.text or "") for r in awkward.collect()})
    one = fp.fingerprints(make_docs(spark, [(4, "abcdefgh")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0
    assert fp.fingerprints(no_docs).count() == 0
