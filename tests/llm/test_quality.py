import collections
import math
import pathlib
import random
import tracemalloc
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from creditloom.llm import quality as q
from creditloom.sources.staging import staging_root


def brute(docs, labels, quantile, prior):
    """Plain dictionaries: {(doc_id, text): (value, limit, kept)}."""
    grade = {}
    for i, g in labels:
        if i is not None:
            grade[i] = min(grade.get(i, 1), g or 0)
    good = {i for i, g in grade.items() if g == 1}
    out_of_training = {i for i in good if zlib.crc32(str(i).encode()) % 5 == 0}

    def pairs(text):
        c = [0, *map(int, q.word_classes((text or "").encode())), 0]
        return list(zip(c, c[1:]))

    n = collections.Counter(p for i, t, _ in docs if i in good - out_of_training for p in pairs(t))
    after, total, kinds = collections.Counter(w for _, w in n), collections.Counter(), collections.defaultdict(collections.Counter)
    for (c, _), k in n.items():
        total[c] += k
        kinds[c][min(k, 3)] += 1
    sizes = lambda values: q.discounts(*(sum(v == k for v in values) for k in (1, 2, 3, 4)))
    d, d1 = (0, *sizes(list(n.values()))), (0, *sizes(list(after.values())))
    n_after = sum(after.values())

    def cost(c, w):
        if n_after:
            spread = sum(d1[min(k, 3)] for k in after.values())
            p = (after[w] - d1[min(after[w], 3)]) / n_after + spread / n_after / q.CLASSES
        else:
            p = 1 / q.CLASSES
        if total[c]:
            k = n[c, w]
            left = sum(d[m] * times for m, times in kinds[c].items())
            p = (k - d[min(k, 3)]) / total[c] + left / total[c] * p
        return round(-math.log(p) * q.SCALE)

    costs = [(i, t, lang, len(pairs(t)), sum(cost(*p) for p in pairs(t))) for i, t, lang in docs]
    means, values = {}, collections.defaultdict(list)
    known = [x for x in costs if x[0] in out_of_training]
    for lang in {x[2] for x in known} | {"*"}:
        some = [x for x in known if lang == "*" or (x[2] == lang and lang is not None)]
        if some:
            means[lang] = sum(x[4] for x in some) / sum(x[3] for x in some)

    def value(x):
        mean = means.get(x[2], means.get("*", 0.0)) if x[2] is not None else means.get("*", 0.0)
        return math.floor((x[4] + prior * mean) / (x[3] + prior)) if x[3] > 1 else math.floor(mean)

    for x in known:
        if x[2] is not None:
            values[x[2]].append(value(x))
        values["*"].append(value(x))
    limit = {lang: sorted(v)[math.ceil(quantile * len(v) - 1e-12) - 1] for lang, v in values.items()}
    out = {}
    for x in costs:
        most = limit.get(x[2]) if x[2] is not None and x[2] in limit else limit.get("*")
        out[x[0], x[1]] = (value(x), most, most is None or value(x) <= most or x[3] == 1)
    return out


def corpus():
    rng = random.Random(6)
    common, rare = ["the", "of", "and", "in", "to"], [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(150):
        words = [rng.choice(common if rng.random() < 0.5 else rare) for _ in range(rng.choice([3, 40, 200]))]
        if i % 7 == 0:
            words = [w + "%%%" for w in words]
        docs.append((i, " ".join(words), rng.choice(["en", "de", None])))
        labels.append((i, int(i % 7 != 0)))
    docs += [(900, None, "en"), (901, "", "xx"), (902, "§§ ## $$ " * 30, "xx"), (None, "the of and", "en"), (5, "the other row", "en")]
    return docs, labels + [(5, None), (None, 1), (12, 0), (12, 1)]


def same(got, expected):
    assert len(got) == len(expected)
    for r in got:
        value, limit, kept = expected[r.doc_id, r.text]
        assert round(math.log(r.perplexity) * q.SCALE) == value and r.kept == kept
        assert (r.threshold is None) == (limit is None) and (limit is None or round(math.log(r.threshold) * q.SCALE) == limit)


def test_against_brute_force(spark, make_docs):
    quantile = 0.9
    docs, labels = corpus()
    frame = make_docs([(i, t, lang, "s") for i, t, lang in docs], block=F.lit(1), cost=F.lit("x"), mean=F.lit(0))
    marks = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("x"))
    keys = frame.select("doc_id", "lang", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    got = q.classify(frame, marks, quantile=quantile, prior_words=10)
    by_key = {(r.doc_id, r.text_key): r.text for r in keys.collect()}
    rows = [r.asDict() | {"text": by_key[r.doc_id, r.text_key]} for r in got.collect()]
    same([type("R", (), r) for r in rows], brute(docs, labels, quantile, 10))
    kept = q.keep_good(frame, marks, quantile=quantile, prior_words=10)
    assert kept.columns == frame.columns
    assert kept.count() == sum(r["kept"] for r in rows)


def test_probabilities_sum_to_one(spark, make_docs):
    """Over all words of the trained model, and the unseen ones of the uniform distribution below, in any context."""
    rng = random.Random(7)
    docs = [(i, " ".join(f"w{int(rng.expovariate(0.05))}" for _ in range(rng.choice([0, 1, 30, 90])))) for i in range(200)]
    model, scale = q.train(make_docs(docs), spark.createDataFrame([(i,) for i, _ in docs], "doc_id long"))
    counts = model.collect()
    rows = {r.key % 2**64: r for r in counts}
    assert len(rows) == len(counts)  # words and pairs, that of an empty text too, have keys of their own
    assert scale.pairs > 1000 and all(0 < d < k for k, d in enumerate(scale.pair, 1))
    known = np.unique(np.concatenate([np.zeros(1, np.uint64), *(q.word_classes(t.encode()) for _, t in docs)]))
    words = np.append(known, q.word_classes(b"unseen"))
    after = np.array([rows[w].after if w in rows else 0 for w in words.tolist()])
    below = q._below(after, scale.word, scale.pairs, scale.spread)
    assert below[:-1].sum() + (q.CLASSES - len(known)) * below[-1] == pytest.approx(1)
    for context in [*words[::9].tolist(), 0, int(words[-1])]:
        own = rows.get(context)
        total = own.n if own else 0
        left = sum(d * n for d, n in zip(scale.pair, (own.ones, own.twos, own.more))) if own else 0
        keys = q._pair_keys(np.full(len(words), context, np.uint64), words).tolist()
        n = np.array([rows[k].n if k in rows else 0 for k in keys])
        assert n.sum() == total
        p = np.exp(-q._costs(n, np.full(len(n), total), np.full(len(n), left), below, scale.pair) / q.SCALE)
        assert p[:-1].sum() + (q.CLASSES - len(known)) * p[-1] == pytest.approx(1, abs=2e-3)


def test_no_labels_and_empty_table(spark, make_docs):
    docs = make_docs([(1, "a b c"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.kept for r in q.classify(docs, none).collect()] == [True, True]
    assert q.classify(docs.filter("doc_id < 0"), none).collect() == []


def test_rare_words_share_no_counts(spark, make_docs):
    """Texts of words that no trusted text has, each a word of its own, are rejected however many words there are."""
    rng = random.Random(8)
    known = [f"word{i}" for i in range(4000)]
    docs = [(i, " ".join(rng.choice(known) for _ in range(200))) for i in range(400)]
    docs += [(1000 + i, " ".join(f"x{rng.randrange(10**9)}" for _ in range(200))) for i in range(20)]
    marks = spark.createDataFrame([(i, 1) for i in range(400)], "doc_id long, quality int")
    got = {r.doc_id: r for r in q.classify(make_docs(docs), marks).collect()}
    assert not any(got[1000 + i].kept for i in range(20))
    assert sum(got[i].kept for i in range(400)) >= 396
    assert len({h for w in known for h in q.word_classes(w.encode()).tolist()}) == len(known)


def test_words_of_a_stream_are_those_of_the_texts():
    texts = ["", " ", "a  b\ta", "\x0b\x0cé x \r\n", "a", " lead trail ", "\x1c\x1f"]
    words, lengths = q._split(pa.array(texts))
    tokens, vocabulary = q._stream([words.slice(0, 2), words.slice(2)], lengths)
    classes = [q.word_classes(t.encode()).tolist() for t in texts]
    assert lengths.tolist() == [len(c) for c in classes]
    assert vocabulary[tokens].tolist() == [0, *(x for c in classes for x in [*c, 0])]
    assert sorted(set(vocabulary.tolist())) == vocabulary.tolist()


def test_no_round_leaves_shuffle_files_or_counts(spark, make_docs, tmp_path):
    """What a round shuffled, and the counts by pair and word, are gone when the documents are scored."""
    rng = random.Random(9)
    docs = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(60))) for i in range(100)]
    frame, marks = make_docs(docs), spark.createDataFrame([(i, 1) for i in range(100)], "doc_id long, quality int")
    root = pathlib.Path(staging_root(spark).removeprefix("file:"))
    before = set(root.rglob("*-counts-*"))
    assert q.classify(frame, marks).count() == 100
    assert set(root.rglob("*-counts-*")) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


def test_counts_are_the_same_in_any_number_of_rounds(spark, make_docs, monkeypatch):
    docs, labels = corpus()
    frame = make_docs([(i, t, lang, "s") for i, t, lang in docs])
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    sums = lambda: sorted(map(tuple, q.classify(frame, marks).collect()), key=repr)
    expected = sums()
    monkeypatch.setattr(q, "COUNT_ROUNDS", 1)
    monkeypatch.setattr(q, "ROUNDS", 1)
    assert sums() == expected


def test_blocks_documents_are_dealt_over_the_shards(spark, make_docs):
    """The first blocks of all tasks are not carried by one shard, whose task would hold all words."""
    frame = make_docs([(i, f"a w{i} b") for i in range(400)]).withColumn("text_key", F.col("doc_id")).repartition(16)
    asked = frame.select("doc_id", "text_key", "lang", "text").mapInArrow(partial(q._blocks, shards=64), q._ASKED)
    carried = asked.filter("tokens is not null").select("block", "shard", F.size("doc_id").alias("n")).collect()
    assert len({r.block for r in carried}) == len(carried) == 16 and sum(r.n for r in carried) == 400
    assert len({r.shard for r in carried}) == 16


def test_a_task_holds_little_besides_its_keys_and_counts():
    """Pairs are dealt without the columns that only words have; what is dealt has all keys and counts."""
    rng = np.random.default_rng(10)
    keys = np.unique(rng.integers(1, 2**63, q.BLOCK_WORDS + 4096))
    rng.shuffle(keys)
    is_word = np.arange(len(keys)) % 16 == 0
    counts = [rng.integers(1, 9, len(keys)), *(np.where(is_word, rng.integers(1, 9, len(keys)), 0) for _ in q._COUNTS[1:])]
    rows = pa.table([pa.array(c) for c in (keys, *counts)], ["key", *q._COUNTS])
    batches = (pa.RecordBatch.from_pydict(b.to_pydict(), b.schema) for b in rows.to_batches(8192))
    tracemalloc.start()
    dealt = list(q._dealt(batches, 4))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 80e6
    for name, values, mask, k in (("words", "counts", is_word, 5), ("pairs", "times", ~is_word, 1)):
        order = np.argsort(keys[mask])
        parts = [q._merged(pa.Table.from_batches([d.slice(s, 1) for d in dealt])) for s in range(4)]
        got = np.concatenate([q._from_ascending(p.column(name)[0].as_py()) for p in parts])
        assert got.tolist() == keys[mask][order].tolist()
        found = np.concatenate([q._unpacked(p.column(values)[0].as_py(), np.int64).reshape(k, -1) for p in parts], axis=1)
        assert (found == np.stack(counts[:k])[:, mask][:, order]).all()
