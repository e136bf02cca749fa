import random

import pytest
from pyspark.sql import functions as F

from creditloom.llm import decontamination as dc
from creditloom.llm.common import words_of


def brute(docs, items):
    """{(doc_id, smallest item_id of equal words): containment} over whole documents."""
    first = {}
    for i, text in items:
        words = tuple(words_of(text or ""))
        if words and i is not None:
            first[words] = min(i, first.get(words, i))
    out = {}
    for d, text in docs:
        words = words_of(text or "")
        own = dc.shingles(words, 5)
        for item, i in first.items():
            if len(item) < 5:
                share = float(tuple(words) == item)
            else:
                want = dc.shingles(list(item), 5)
                share = len(want & own) / len(want)
            if share >= 0.8:
                out[d, i] = share
    return out


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefgh") + str(rng.randrange(200)) for _ in range(n))) for i, n in enumerate([5, 6, 9, 12, 20, 33, 47, 90, 200])]
    rows += [(20, rows[3][1].upper() + "!"), (21, "two words"), (22, ""), (23, None), (None, rows[4][1])]
    return rows


def test_against_brute_force(spark, make_docs, items):
    rng = random.Random(5)
    docs = []
    for d in range(120):
        words = [f"v{rng.randrange(5000)}" for _ in range(rng.choice([0, 3, 30, 400, 3000]))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            item = (items[rng.randrange(9)][1]).split()
            if rng.random() < 0.4:
                item[rng.randrange(len(item))] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = item
        docs.append((d, " ".join(words)))
    docs += [(900, "Two, words"), (901, "two words more"), (902, None), (903, ""), (904, items[4][1]), (904, "nothing of it here at all"), (905, items[0][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).repartition(2)
    got = dc.contaminated(make_docs(docs, item_id=F.lit(7), words=F.lit("x"), key=F.lit(1)), benchmark).collect()
    assert {(r.doc_id, r.item_id): r.containment for r in got} == pytest.approx(brute(docs, items))
    assert {r.item_id: r.n_items for r in got}.get(4) == 2
    # with a filter that lets everything through, the join decides alike
    again = dc.contaminated(make_docs(docs[:40]), benchmark, filter_bits=64).collect()
    assert {(r.doc_id, r.item_id): r.containment for r in again} == pytest.approx(brute(docs[:40], items))


def test_drop_and_empty_tables(spark, make_docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs([(1, "clean text of some words"), (2, items[5][1]), (3, None), (1, "clean text of some words"), (None, "x y")])
    kept = dc.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 1, 3]
    assert dc.drop_contaminated(docs, benchmark.filter("item_id < 0")).count() == 5
    assert dc.contaminated(docs.filter("doc_id < 0"), benchmark).collect() == []


def test_repeated_shingles_and_split_items(spark, make_docs):
    """A verbatim item that repeats shingles, and one that a long insertion splits, are held at any offset."""
    a, b, c = ([f"{x}{i}" for i in range(20)] for x in "abc")
    items = [(1, " ".join(a + ["0"] * 100 + b)), (2, " ".join(c + ["c"] + b))]
    docs = []
    for d in range(40):
        before = [f"v{d}n{i}" for i in range(d * 7)]
        docs.append((d, " ".join(before + items[0][1].split() + before)))
        docs.append((100 + d, " ".join(before + c + [f"w{d}n{i}" for i in range(2000)] + b)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.containment for r in dc.contaminated(make_docs(docs), benchmark).collect()}
    assert got == pytest.approx(brute(docs, items))
    assert {(d, 1) for d in range(40)} | {(100 + d, 2) for d in range(40)} <= set(got)
