import re

import duckdb
from pyspark.sql import functions as F

from creditloom.llm import mixing

ROWS = [
    (1, "a b  c\td", "en", "s1"), (2, "", "en", "s1"), (3, None, "en", "s0"), (4, "x " * 700, "en", "s0"), (4, "x " * 700, "en", "s0"),
    (None, "n n n", "en", None), (5, "é ü z", "de", None), (6, "one", "en", "tiny"), (7, "w " * 90, "en", "Z"), (8, "v " * 3000, "en", "s2"),
]


def sql_rows(rows, **kw):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [(r[0], r[1], r[3]) for r in rows])
    return sorted(con.execute(mixing.taken_sql(**kw)).fetchall(), key=str)


def test_against_sql(make_docs):
    docs = make_docs(ROWS, sid=F.lit(1), start=F.lit("x"), block=F.lit(None).cast("int"))
    for block in (512, 7):
        got = mixing.taken(docs, block_words=block)
        rows = [(r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in got.collect()]
        assert sorted(rows, key=str) == sql_rows(ROWS, block=block)


def test_targets_and_limits(make_docs):
    rows = [(i, "w " * (i % 37 + 1), "en", f"s{i % 5}" if i % 3 else "hot") for i in range(400)]
    got = mixing.taken(make_docs(rows), block_words=16).collect()
    assert len(got) == 400 and all(0 <= r.taken <= 3 * r["size"] for r in got)
    taken, target, size = {}, {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source], size[r.source] = r.target, r.source_size
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in taken)
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    free = sorted(s for s in target if target[s] < 3 * size[s] - 1e-9)
    weight = {s: (i % 3) + 1 for i, s in enumerate(sorted(target))}
    assert len({round(target[s] / weight[s], 6) for s in free}) == 1


def test_mixed_corpus_has_the_words_counted(make_docs):
    docs = make_docs(ROWS, shard=F.lit(9), text_key=F.lit(0))
    counted = {}
    for r in mixing.taken(docs, block_words=16).collect():
        counted[r.doc_id] = counted.get(r.doc_id, 0) + r.taken
    texts = {r[0]: re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in ROWS}
    mixed = mixing.mix(docs, block_words=16, shard_words=500).collect()
    for r in mixed:
        assert r.text.split(" ") == texts[r.doc_id][r.first_word : r.first_word + r.n_words]
        counted[r.doc_id] -= r.n_words
    assert set(counted.values()) == {0} and len({r.shard for r in mixed}) > 1
    again = mixing.mix(docs, block_words=16, shard_words=500).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixed))


def test_shards_draw_multinomial_source_counts(make_docs):
    """Full shards of equal size, whose source counts vary as multinomial draws do; every slot once."""
    rows = [(i, "w " * 64, "en", f"s{i % 4}") for i in range(1200)]
    _, placed = mixing.place(make_docs(rows))
    parts = mixing.pieces(placed, 8)
    dealt = mixing.dealt(parts, 100).collect()
    key = lambda r: (r.sid, r.epoch, r.block, r.words)
    assert sorted(map(key, dealt)) == sorted(map(key, mixing.slots(parts).collect()))
    shards, share = {}, {}
    for r in dealt:
        counts = shards.setdefault(r.shard, {})
        counts[r.sid] = counts.get(r.sid, 0) + 1
        share[r.sid] = share.get(r.sid, 0) + 1
    assert sorted(shards) == list(range(-(-len(dealt) // 100))) and {sum(c.values()) for c in list(shards.values())[:-1]} == {100}
    # chi-square over the shards that no settling has reached: (shards) x (sources - 1) degrees of freedom
    early = [shards[k] for k in sorted(shards)[: len(shards) * 3 // 4]]
    want = {s: 100 * n / len(dealt) for s, n in share.items()}
    free = len(early) * (len(share) - 1)
    chi = sum((c.get(s, 0) - w) ** 2 / w for c in early for s, w in want.items())
    assert abs(chi - free) < 4 * (2 * free) ** 0.5
    # a source's slots go through its epochs in order
    ends = {}
    for r in sorted((r for r in dealt if r.shard < len(early)), key=lambda r: (r.shard, r.epoch)):
        assert r.epoch >= ends.get(r.sid, 0) or r.shard == ends.get((r.sid, "at"))
        ends[r.sid], ends[r.sid, "at"] = r.epoch, r.shard


def test_the_query_takes_what_the_shards_take(make_docs, monkeypatch):
    asked = []
    monkeypatch.setattr(mixing, "dealt", lambda parts, n, real=mixing.dealt: (asked.append(n), real(parts, n))[1])
    rows = sorted(map(str, mixing.taken(make_docs(ROWS), block_words=7, shard_words=70).collect()))
    assert asked == [10] and rows == sorted(map(str, mixing.taken(make_docs(ROWS), block_words=7).collect()))


def test_empty_and_wordless_tables(make_docs):
    assert mixing.taken(make_docs(ROWS).filter("doc_id < 0")).collect() == []
    assert mixing.mix(make_docs(ROWS).filter("doc_id < 0")).collect() == []
    assert [r.taken for r in mixing.taken(make_docs([(1, None), (2, " ")])).collect()] == [0, 0]
