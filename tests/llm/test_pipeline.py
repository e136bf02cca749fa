"""run() against the brute-force version of every stage, each on what the one before it kept."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import test_decontamination, test_lines, test_mixing, test_quality, test_simhash


def tables():
    rng = random.Random(15)
    common, rare = ["the", "of", "and", "in", "to"], [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(common if rng.random() < 0.4 else rare) for _ in range(n)]
    items = [(i, " ".join(rng.choice(rare) for _ in range(12 + 7 * i))) for i in range(4)]
    docs, labels = [], []
    for i in range(160):
        words = text(rng.choice([30, 120, 300]))
        if i % 11 == 3:
            words = [w + "###" for w in words]
        if i % 13 == 5 and docs:
            words = docs[rng.randrange(len(docs))][1].replace("\n", " ").split()
            words[rng.randrange(len(words))] = "changed"
        if i % 17 == 2:
            at = rng.randrange(len(words))
            words[at:at] = items[i % 4][1].split()
        lines = [" ".join(words[k : k + 25]) for k in range(0, len(words), 25)]
        docs.append((i, "\n".join(lines), rng.choice(["en", "de"]), rng.choice(["a", "b", "b", None])))
        if i % 2:
            labels.append((i, int(i % 11 != 3)))
    return docs + [(500, None, "en", "a"), (501, "", None, "c")], labels, items


def brute(docs, labels, items):
    """(doc_id, words taken) rows of the mix."""
    good = test_quality.brute([d[:3] for d in docs], labels, 0.998, 50)
    docs = [d for d in docs if good[d[0], d[1]][2]]
    kept = test_lines.brute([d[:2] for d in docs])
    docs = [(d[0], kept[d[0]][0], *d[2:]) for d in docs]
    prints = {d[0]: test_simhash.brute_print(d[1]) for d in docs}
    first = test_simhash.brute_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    docs = [d for d in docs if first[d[0]] == d[0]]
    held = {d for d, _ in test_decontamination.brute([d[:2] for d in docs], items)}
    docs = [d for d in docs if d[0] not in held]
    return docs, {r[0]: r[4] for r in test_mixing.sql_rows(docs) if r[4]}


def test_run_against_brute_force(spark, make_docs, tmp_path):
    docs, labels, items = tables()
    make_docs(docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left, taken = brute(docs, labels, items)
    assert 40 < len(left) < 150
    texts = {d[0]: (d[1] or "").split() for d in left}
    got = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        assert r.text.split(" ") == texts[r.doc_id][r.first_word : r.first_word + r.n_words]
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_words
    assert got == taken


def test_stages_keep_the_columns(spark, make_docs):
    docs = make_docs(tables()[0][:10])
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, "/root/testdata/sf0.001").schema.fieldNames() == docs.columns, name


def test_columns_with_clashing_names_go_through(spark, make_docs):
    docs = make_docs([(1, "a b\na b\nc", "en", "a"), (2, "c\nd", "en", "a")], n_lines=F.lit("x"), n_dropped=F.lit(7))
    rows = corpus_pipeline.line_dedup(spark, docs, "").orderBy("doc_id").collect()
    assert [(r.text, r.n_lines, r.n_dropped) for r in rows] == [("a b\nc", "x", 7), ("d", "x", 7)]


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_empty_tables(spark, make_docs, tmp_path, empty):
    """Without documents the mix is empty; without labels nothing is rejected; without items nothing is held."""
    frames = {
        "documents": make_docs([(i, f"word{i} " * (i + 2) + f"end{i}", "en", "a") for i in range(5)]),
        "labels": spark.createDataFrame([(i, 1) for i in range(5)], "doc_id long, quality int"),
        "benchmark": spark.createDataFrame([(1, "no document holds these words")], "item_id long, text string"),
    }
    for name, frame in frames.items():
        (frame.limit(0) if name == empty else frame).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == (set() if empty == "documents" else set(range(5)))
