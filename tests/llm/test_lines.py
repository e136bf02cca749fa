import random

import pyarrow as pa
from pyspark.sql import functions as F

from creditloom.llm import lines as ln


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs):
    """{doc_id: (kept text, its lines)}, comparing every line with every earlier one."""
    every = []
    for i, t in docs:
        every += [(i, t, k, ln.words_of_line(x.encode())) for k, x in enumerate((t or "").split("\n"))]
    gone = set()
    for i, t, k, words in every:
        for j, u, m, other in every:
            if words and other and (j, m) < (i, k):
                if words == other or (len(words) >= 8 and len(other) >= 8 and edit_distance(words, other) <= 1):
                    gone.add((i, t, k))
                    break
    left = {(i, t): [x for k, x in enumerate(t.split("\n")) if (i, t, k) not in gone] if t is not None else [] for i, t in docs}
    return {i: (t if t is None else "\n".join(kept), len(kept)) for (i, t), kept in left.items()}


def corpus():
    rng = random.Random(8)
    pool = [[rng.choice("abcdefghij") + str(rng.randrange(30)) for _ in range(rng.choice([2, 7, 8, 9, 12, 31]))] for _ in range(40)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rng.choice([1, 3, 9])):
            words = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 2])):
                at = rng.randrange(len(words))
                words[at : at + rng.choice([0, 1])] = [] if rng.random() < 0.4 else [f"new{rng.randrange(9)}"]
            lines.append("  ".join(words))
        docs.append((i, "\n".join(lines)))
    same = "a a a a b b b b c"
    docs += [(100, None), (101, ""), (102, "\n\n"), (103, same), (104, same[2:] + "\n" + same.upper()), (105, same + "\n" + same), (106, docs[3][1] + "\n")]
    return docs


def test_against_brute_force(make_docs):
    docs = corpus()
    frame = make_docs(docs, line=F.lit("x"), h1=F.lit(1), n_lines=F.lit(None).cast("string"))
    expected = brute(docs)
    for bits in (ln.FILTER_BITS, 64):
        out = ln.dedup_lines(frame, filter_bits=bits)
        assert set(out.columns) == {*frame.columns, "n_dropped"}
        got = {r.doc_id: (r.text, r.n_lines - r.n_dropped) for r in out.collect()}
        assert got == expected


def test_order_ties_and_nulls(make_docs):
    line = "one two three four five six seven eight nine"
    near = line.replace("five", "5")
    docs = make_docs([(None, near), (1, line), (2, near + "\nshort"), (2, near + "\nshort"), (3, "short\nother")])
    got = sorted((r.doc_id or 0, r.text) for r in ln.dedup_lines(docs).collect())
    assert got == [(0, near), (1, ""), (2, "short"), (2, "short"), (3, "other")]
    got = sorted((r.doc_id or 0, r.text) for r in ln.dedup_lines(docs, near=False).collect())
    assert got == [(0, near), (1, line), (2, "short"), (2, "short"), (3, "other")]


def test_one_long_line_and_empty_table(make_docs):
    long = " ".join(f"w{i}" for i in range(3000))
    docs = make_docs([(1, long), (2, long + " more"), (3, long.replace("w7 ", "x ")), (4, long.replace("w7 w9", "y"))])
    assert {r.doc_id: len(r.text) for r in ln.dedup_lines(docs).collect()} == {1: len(long), 2: 0, 3: 0, 4: 0}
    assert ln.dedup_lines(docs.filter("doc_id < 0")).collect() == []


def test_one_edit():
    a = [b"a", b"b", b"b", b"c"]
    for b in ([b"a", b"b", b"c"], [b"a", b"x", b"b", b"c"], [b"a", b"b", b"b", b"c", b"d"], [b"z", *a], a):
        assert ln.within_one_edit(a, b) and ln.within_one_edit(b, a)
    for b in ([b"a", b"c"], [b"b", b"a", b"b", b"c"], [b"x", b"b", b"b", b"y"], [b"x", b"a", b"b", b"c", b"d"]):
        assert not ln.within_one_edit(a, b) and not ln.within_one_edit(b, a)


def test_tasks_hold_the_lines_of_few_documents_at_once():
    """A batch of any size is worked on in pieces; together they are what the whole batch gives."""
    n = 3 * ln.DOCS_AT_ONCE + 5
    texts = [f"line {i} of some words that are many enough\nx\n\nrow {i % 7}" for i in range(n)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "text_key": list(range(n)), "text": texts})
    pieces = list(ln._lines(iter([batch]), ln.MIN_WORDS))
    assert len(pieces) == 4 and max(p.num_rows for p in pieces) <= 3 * ln.DOCS_AT_ONCE
    got = pa.Table.from_batches(pieces).to_pydict()
    assert list(zip(got["doc_id"], got["line"])) == [(i, k) for i in range(n) for k in (0, 1, 3)]
    cut = batch.append_column("__gone", pa.array([[1] if i % 2 else None for i in range(n)], pa.list_(pa.int32())))
    out = list(ln._cut(iter([cut]), ("a", "b")))
    assert [p.num_rows for p in out] == [ln.DOCS_AT_ONCE] * 3 + [5]
    assert pa.Table.from_batches(out).column("b").to_pylist() == [i % 2 for i in range(n)]
