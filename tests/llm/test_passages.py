import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from creditloom.llm import passages as ps
from creditloom.llm.common import words_of

SHORTEST, GRAM = 12, 6


def brute(docs):
    """{doc_id: word positions in a run of SHORTEST words that another document has}."""
    words = {(i, t): words_of(t or "") for i, t in docs}
    where = {}
    for d, w in words.items():
        for k in range(len(w) - SHORTEST + 1):
            where.setdefault(tuple(w[k : k + SHORTEST]), set()).add(d)
    out = {}
    for d, w in words.items():
        for k in range(len(w) - SHORTEST + 1):
            if len(where[tuple(w[k : k + SHORTEST])]) > 1:
                out.setdefault(d, set()).update(range(k, k + SHORTEST))
    return out


def check(docs, rows):
    words = {(i, t): words_of(t or "") for i, t in docs}
    expected = brute(docs)
    got = {}
    for r in rows:
        d = next(k for k in words if k[0] == r.doc_id and hash_of(k[1]) == r.text_key)
        assert r.n_words == r.end_word - r.first_word >= SHORTEST
        got.setdefault(d, set()).update(range(r.first_word, r.end_word))
    assert set(got) == set(expected)
    for d, places in expected.items():
        assert got[d] <= places  # nothing that no other document has
        missing = places - got[d]
        # only left ends, by up to SHORTEST - GRAM words
        assert all(any(k in got[d] for k in range(m, m + SHORTEST - GRAM + 1)) for m in missing)
    return sum(len(p - got[d]) for d, p in expected.items()) / max(1, sum(map(len, expected.values())))


HASHES = {}


def hash_of(text):
    return HASHES[text or ""]


def corpus(seed, n=90):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    pool = [text(k) for k in (11, 12, 13, 20, 31, 80, 200)]
    docs = []
    for i in range(n):
        words = text(rng.choice([0, 5, 30, 120]))
        for _ in range(rng.choice([0, 1, 1, 3])):
            part = rng.choice(pool)
            a = rng.randrange(len(part))
            part = part[a : a + rng.choice([8, 11, 12, 14, 25, 300])] if rng.random() < 0.7 else part
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        if docs and rng.random() < 0.15:
            words = docs[rng.randrange(len(docs))][1].split()
        if rng.random() < 0.1:
            words = ["echo", "echo"] * rng.choice([3, 9, 40])
        docs.append((i, " ".join(words)))
    return docs + [(500, None), (501, ""), (None, docs[3][1] + " more"), (502, "Echo, echo! " * 30), (503, docs[5][1]), (503, docs[6][1] + " end"), (503, docs[5][1])]


def remember(spark, docs):
    rows = spark.createDataFrame([(t or "",) for _, t in docs], "t string").select("t", F.xxhash64("t").alias("h")).collect()
    HASHES.update({r.t: r.h for r in rows})


def test_against_brute_force(spark, make_docs):
    docs = corpus(17)
    remember(spark, docs)
    frame = make_docs(docs, right=F.lit("x"), pos=F.lit(1), first=F.lit(None).cast("int"))
    rows = ps.shared_passages(frame, SHORTEST, GRAM).collect()
    assert check(docs, rows) < 0.1
    classes = {}
    for i, t in docs:
        classes.setdefault(" ".join(map(bytes.decode, words_of(t or ""))), set()).add(i)
    for r in rows:
        assert r.other_id is None or r.other_id != r.doc_id or r.doc_id == 503


def test_seams_between_partitions(spark, make_docs):
    docs = corpus(18, 40) + [(600 + i, " ".join(f"v{k}" for k in range(40))+ f" tail{i}") for i in range(30)]
    remember(spark, docs)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert check(docs, ps.shared_passages(make_docs(docs), SHORTEST, GRAM, filter_bits=64).collect()) < 0.1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_very_long_text_goes_by_parts():
    import numpy as np

    rng = np.random.default_rng(19)
    words = rng.integers(0, 50, 5000, np.uint64)
    whole = ps.minimisers([words], 50, 25)[0]
    bits, ps._PLACE_BITS = ps._PLACE_BITS, np.uint64(12)
    try:
        assert len(words) >= 1 << 12
    finally:
        ps._PLACE_BITS = bits
    # every run of 50 words has a minimiser, chosen by its words alone
    for k in range(0, 4900, 7):
        inside = set((whole[0][(whole[0] >= k) & (whole[0] <= k + 25)] - k).tolist())
        assert inside & set(ps.minimisers([words[k : k + 50]], 50, 25)[0][0].tolist())


def test_merging_and_empty_table(make_docs):
    batch = pa.RecordBatch.from_pylist(
        [{"doc_id": 1, "text_key": 2, "spans": [{"first": 5, "end": 9, "other": 3}, {"first": 0, "end": 5, "other": None}, {"first": 20, "end": 30, "other": 4}]}]
    )
    rows = next(ps._merged(iter([batch]))).to_pylist()
    assert [(r["first"], r["end"], r["other"]) for r in rows] == [(0, 9, None), (20, 30, 4)]
    assert ps.shared_passages(make_docs([(1, "a b")]).filter("doc_id < 0")).collect() == []


def test_tasks_hold_part_of_a_batch():
    n, each = 3_000, 100
    spans = pa.array([{"first": 3 * k, "end": 3 * k + 50, "other": k % 7 or None} for k in range(each)] * n)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * each + 1, each), pa.int32()), spans)
    ids = pa.array(range(n), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, lists], ["doc_id", "text_key", "spans"])
    tracemalloc.start()
    try:
        merged = [r for b in ps._merged(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert merged == [(i, i, 0, 3 * each + 47, None) for i in range(n)]
    assert peak < 16 * n * each

    rng = np.random.default_rng(20)
    words = lambda k: pa.array([rng.integers(0, 1 << 32, k, np.uint64).astype(">u4").tobytes() for _ in range(n)], pa.binary())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array([100] * n, pa.int32()), words(64), words(26)], ["doc_id", "text_key", "pos", "right", "left"])
    windows = list(ps._windows(iter([batch]), 50, 25))
    assert sum(b.num_rows for b in windows) == 26 * n
    assert max(b.num_rows for b in windows) <= 26 * 256
