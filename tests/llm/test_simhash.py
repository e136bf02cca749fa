import random

import xxhash
from pyspark.sql import functions as F

from creditloom.llm import simhash
from creditloom.llm.components import components


def brute_print(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, linked):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {n: root(n) for n in nodes}


def texts(rng):
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([2, 40, 300, 900]))]
        for _ in range(rng.choice([1, 1, 4])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    return out + [None, "", "  \n", "One", "one", "É é", "a b", "A  b\t"]


def test_documents_against_brute_force(make_docs):
    rows = list(enumerate(texts(random.Random(1)), 5))
    prints = {i: brute_print(t) for i, t in rows}
    expected = brute_components([i for i, _ in rows], lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    docs = make_docs(rows, fp=F.lit("x"), component_id=F.lit(1), label=F.lit(2))
    for bucket in (2048, 2):  # the second sends nearly every bucket by its centres
        got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs, bucket=bucket).collect()}
        assert got == {i: (prints[i], expected[i]) for i in prints}


def test_dense_ball_of_fingerprints(spark):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 4, 6]))) for _ in range(300)}
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(50)})
    expected = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    df = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in fps], "fp long").repartition(4)
    for bucket in (2048, 10):
        labels = components(simhash.fingerprint_links(df, bucket=bucket))
        groups = {}
        for r in labels.collect():
            groups.setdefault(r.label, set()).add(r.node % 2**64)
        want = {}
        for n, root in expected.items():
            want.setdefault(root, set()).add(n)
        assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_other_bit_bounds(spark):
    rng = random.Random(3)
    fps = sorted({rng.getrandbits(64) for _ in range(30)} | {7, 6, 4, 0, 2**63, 2**63 + 31})
    df = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in fps], "fp long")
    for bits in (1, 2, 5):
        expected = brute_components(fps, lambda a, b, bits=bits: (a ^ b).bit_count() <= bits)
        groups = {}
        for r in components(simhash.fingerprint_links(df, max_bits=bits)).collect():
            groups.setdefault(r.label, set()).add(r.node % 2**64)
        want = {}
        for n, root in expected.items():
            want.setdefault(root, set()).add(n)
        assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_very_long_text_and_empty_table(make_docs):
    long = " ".join(str(i * 7919 % 1000) for i in range(70_000))
    assert simhash.fingerprint(long) == brute_print(long)
    empty = make_docs([(1, "a")]).filter("doc_id < 0")
    assert simhash.near_duplicates(empty).collect() == []


def test_keep_first(make_docs):
    text = " ".join(f"w{i}" for i in range(50))
    docs = make_docs([(3, text), (2, text), (2, text), (9, "other words here"), (None, text), (None, "alone"), (4, None), (5, "")])
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [(-1, "alone"), (2, text), (4, ""), (9, "other words here")]


def test_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100}
