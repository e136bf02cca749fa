import math
import pickle
import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.llm import toxicity as tx


def test_packed_vectors_come_back():
    terms, times = np.array([0, 3, 250_000, 3_000_000]), np.array([1, 70_000, 2, 1])
    for n in range(5):
        assert [x.tolist() for x in tx.unpacked(tx.packed(terms[:n], times[:n]))] == [terms[:n].tolist(), times[:n].tolist()]


@pytest.mark.parametrize("head", [0, 7, 1_024])
def test_index_against_all_pairs(monkeypatch, head):
    monkeypatch.setattr(tx, "HEAD", head)
    rng = random.Random(10)
    idf = np.array([rng.uniform(0.5, 6) for _ in range(40)])

    def vector():
        terms = sorted(rng.sample(range(40), rng.choice([1, 2, 2, 6, 15])))
        return terms, [rng.choice([1, 1, 2, 5]) for _ in terms]

    examples = [(i, rng.randrange(2), *vector()) for i in range(700)]
    examples += [(1000 + i, 0, *examples[5][2:]) for i in range(100)]  # ties over several blocks
    index = tx.Index(examples, idf)
    dense = np.zeros((len(examples), 40))
    for row, (_, _, terms, times) in zip(dense, examples):
        at, w = tx.unit_vector(terms, times, idf)
        row[at] = w
    ids = np.array([e[0] for e in examples])
    assert index.size < len(examples)  # equal vectors are one entry
    for q in [*(e for e in examples[::37]), (None, 0, *vector()), (5, 0, *examples[5][2:])]:
        at, w = tx.unit_vector(q[2], q[3], idf)
        cosine = dense[:, at] @ w
        want = sorted((-round(c, 9), i) for c, i in zip(cosine.tolist(), ids.tolist()) if c > 0)[:15]
        got = index.nearest([(at, w)] * 2, 15)[1]
        assert [(-round(c, 9), d) for c, d, _ in got] == want
        assert all(y == examples[d if d < 1000 else d - 300][1] for _, d, y in got)


def test_calibration_rises():
    votes = np.array([0.0, 0.1, 0.1, 0.5, 0.55, 0.9, 1.0, 1.0])
    at, share = tx.calibration(votes, np.array([0, 1, 0, 0, 1, 1, 1, 0.0]))
    assert at == sorted(at) and share == sorted(share) and all(0 < s < 1 for s in share)


def corpus():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(500)]
    bad = ["awful", "nasty", "vileness", "vilest", "rotten"]
    docs, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.choice([5, 60, 200]))]
        toxic = i % 6 == 0
        for _ in range(rng.choice([1, 3, 6]) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        docs.append((i, " ".join(text)))
        if i % 5 != 4:
            labels.append((i, int(toxic)))
    docs += [(2000, None), (2001, ""), (2002, "AWFUL! nasty, vilest"), (None, "awful nasty"), (2002, "plain"), (2003, "awful " * 50_000)]
    return docs, labels + [(None, 1), (2001, None)]


def test_held_out_accuracy_and_odd_rows(spark, make_docs):
    docs, labels = corpus()
    marks = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("x"))
    frame = make_docs(docs, toxic=F.lit(1), vote=F.lit("x"), terms=F.lit(1))
    rows = tx.classify(frame, marks).collect()
    assert len(rows) == len(docs)
    truth = {i: int(i % 6 == 0) for i in range(900)}
    out = [r for r in rows if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out for r in out) and len(out) > 100
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.doc_id not in r.evidence for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [by_id[i][0].predicted for i in (2000, 2001, 2003, None)] == [0, 0, 1, 1]
    assert sorted(r.predicted for r in by_id[2002]) == [0, 1]
    assert by_id[None][0].held_out is False


def test_no_labels_and_empty_tables(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in tx.classify(docs, none).collect()] == [(0.0, 0), (0.0, 0)]
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert len(tx.classify(docs, one).collect()) == 2
    assert tx.classify(docs.filter("doc_id < 0"), one).collect() == []


def test_whole_query_against_brute_force(spark, make_docs):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(120)]
    docs = {i: " ".join(rng.choices(words, k=rng.choice([4, 20, 60])) + ["vile"] * (i % 4 == 0)) for i in range(260)}
    docs |= {300 + i: docs[7] for i in range(30)}  # copies
    labels = {i: int(i % 4 == 0) for i in docs if i % 3}
    frame = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    limit = 40
    got = {r.doc_id: r for r in tx.classify(make_docs(list(docs.items())), frame, limit, 5).collect()}

    marks, stands_for = tx.labelled_sample(frame, limit)
    eligible = {i: y for i, y in labels.items() if zlib.crc32(str(i).encode()) % 5}
    for y in (0, 1):
        assert list(marks.values()).count(y) == min(limit, list(eligible.values()).count(y))
        assert stands_for[y] * list(marks.values()).count(y) == list(eligible.values()).count(y)
    assert all(eligible[i] == y for i, y in marks.items())
    counts = {i: {w: t.split().count(w) for w in t.split()} for i, t in docs.items()}
    total, toxic = len(marks), sum(marks.values())

    def weight(word, n):
        some = [i for i in marks if word in counts[i]]
        idf = math.log((len(docs) + 1) / (sum(word in c for c in counts.values()) + 1)) + 1
        if not some:
            return (1 + math.log(n)) * (math.log(len(docs) + 1) + 1) * tx.RELEVANCE_FLOOR
        x = np.corrcoef([word in counts[i] for i in marks], list(marks.values()))[0, 1] if len(some) < total else 0
        return (1 + math.log(n)) * idf * (tx.RELEVANCE_FLOOR + x * x)

    vectors = {i: {w: weight(w, n) for w, n in c.items()} for i, c in counts.items()}
    length = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in vectors.items()}
    votes = {}
    for i, v in vectors.items():
        cosine = {j: sum(x * vectors[j].get(w, 0) for w, x in v.items()) / length[i] / length[j] for j in marks if j != i}
        near = sorted((-round(c, 12), j) for j, c in cosine.items() if c > 0)[:5]
        assert np.allclose(got[i].cosines, [-c for c, _ in near])
        assert [round(c, 9) for c in got[i].cosines] == [round(-c, 9) for c, _ in near]
        assert got[i].evidence == [j for _, j in near]
        weights = [1 / (max(0, 1 + c) + tx.NEAREST) for c, _ in near]
        votes[i] = sum(w * marks[j] for w, (_, j) in zip(weights, near)) / sum(weights)
    own = sorted(marks)
    at, share = tx.calibration(*(np.array(x, float) for x in zip(*((votes[i], marks[i], stands_for[marks[i]]) for i in own))))
    assert all(abs(got[i].score - np.interp(votes[i], at, share)) < 1e-9 for i in docs)
    assert 0 < toxic < total and len({r.score for r in got.values()}) > 3


def test_only_texts_without_a_known_word_share_a_score(spark, make_docs):
    docs, labels = corpus()
    rows = tx.classify(make_docs([*docs, (3000, "unheard of")]), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    bare = [r for r in rows if not r.evidence]
    assert {r.doc_id for r in bare} == {2000, 2001, 2002, 3000}  # 2002's second row is one word that no example has
    assert len({r.score for r in bare}) == 1


def test_dense_matrix_is_made_where_it_is_read():
    rng = random.Random(13)
    examples = [(i, i % 2, sorted(rng.sample(range(1_000), 5)), [1] * 5) for i in range(3_000)]
    index = tx.Index(examples, np.ones(1_000))
    assert "dense" not in vars(index)
    query = [tx.unit_vector(*examples[8][2:], np.ones(1_000))]
    near = index.nearest(query, 5)
    sent = pickle.dumps(index)  # after it was read here, too
    assert len(sent) < index.dense.nbytes / 8
    assert pickle.loads(sent).nearest(query, 5) == near


def test_driver_holds_no_object_of_a_word(spark, make_docs):
    rng = random.Random(14)
    words = [f"w{i}" for i in range(20_000)]
    docs = [(i, " ".join(rng.sample(words, 1_500))) for i in range(150)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, toxic int")
    frame = make_docs(docs).cache()
    n = sum(len(t.split()) for i, t in docs if zlib.crc32(str(i).encode()) % 5)
    assert frame.count() == 150
    tracemalloc.start()
    try:
        rows = tx.classify(frame, labels).select("doc_id", "score")
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows.count() == 150
    frame.unpersist()
    assert peak < 160 * n, peak / n  # bytes for each word of an example; its numbers take 16
