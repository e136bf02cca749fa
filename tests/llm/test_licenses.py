import random

import duckdb
from pyspark.sql import functions as F

from creditloom.llm import licenses
from creditloom.llm.common import words_of

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_links"]


def sql_rows(rows, containment):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    return sorted(con.execute(licenses.scan_sql(containment=containment)).fetchall(), key=str)


def texts():
    rng = random.Random(9)
    filler = "the of and version software is free license under this to a 2 0 word copy".split()
    rows = []
    for i in range(80):
        words = [rng.choice(filler) for _ in range(rng.choice([0, 4, 30, 300]))]
        for _ in range(rng.choice([0, 1, 2])):
            notice = rng.choice([*licenses.PHRASES, *(t for t, _ in licenses.TEMPLATES)]).split()
            for _ in range(rng.choice([0, 0, 1, 3])):
                notice[rng.randrange(len(notice))] = rng.choice(["x", "the"])
            at = rng.randrange(len(words) + 1)
            words[at:at] = notice
        rows.append((i, rng.choice([" ", "-", "\n", ", "]).join(words).upper() if i % 3 else " ".join(words)))
    rows += [(None, "Under the MIT License."), (7, "Under the MIT License."), (7, "Under the MIT License."), (90, None), (91, ""), (92, "...")]
    rows += [(93, "é under the under the mit-license İ"), (94, "cc by nc by nc cc by nc"), (95, "under the mit license " * 3000)]
    return rows


def test_against_sql(make_docs):
    rows = texts()
    docs = make_docs(rows, n_words=F.lit("x"), token=F.lit(1))
    for share in (0.8, 0.5):
        got = sorted([tuple(r[c] for c in COLUMNS) for r in licenses.scan(docs, share).collect()], key=str)
        assert got == sql_rows(rows, share)
    assert licenses.scan(docs.filter("doc_id < 0")).collect() == []


def blocks_by_force(text, share):
    """Every block of every template, then runs of overlapping spans of its tokens."""
    words, out = [w.decode() for w in words_of(text or "")], []
    for number, (notice, label) in enumerate(licenses.TEMPLATES):
        size, tokens, spans = 2 * len(notice.split()), set(notice.split()), []
        for start in range(1 - size, len(words)):
            own = [i for i in range(max(0, start), min(len(words), start + size)) if words[i] in tokens]
            met = len({words[i] for i in own})
            if met >= share * len(tokens) - 1e-9:
                spans.append((own[0], own[-1], met / len(tokens)))
        for i, (first, last, most) in enumerate(spans):
            if i and first <= run[1]:
                run[1], run[2] = max(run[1], last), max(run[2], most)
            else:
                run = [first, last, most]
                out.append((number, label, run))
    return sorted(((r[0], r[1], n, label, r[2]) for n, label, r in out))


def test_all_blocks_with_their_places(make_docs):
    mit = licenses.TEMPLATES[1][0]
    rows = [r for r in texts() if len(r[1] or "") < 5_000]
    rows += [(200, f"{mit} {'x ' * 100}{mit}"), (201, f"{mit} {mit}"), (202, " ".join(t for t, _ in licenses.TEMPLATES))]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    for share in (0.8, 0.5):
        got = {r.doc_id: r for r in licenses.find(make_docs(rows, blocks=F.lit(1)), share).collect()}
        for i, text in rows:
            found = [(b.first_word, b.last_word, b.template, b.label, b.share) for b in got[i].blocks]
            assert found == blocks_by_force(text, share), text
    twice = [b for b in got[len(rows) - 3].blocks if b.template == 1]
    assert [b.first_word for b in twice] == [0, len(mit.split()) + 100]


def test_positional_filter_leaves_out_lone_prefix_words():
    template = licenses._Template(0, "a b c d e", "x", {b"a": 1, b"b": 2, b"c": 9, b"d": 9, b"e": 9}, 0.8)
    assert template.prefix == [b"a", b"b"]
    places = {b"a": [5, 400], b"b": [401], b"c": [402, 800], b"d": [403], b"e": [900]}
    assert template.reaches(places) == [(391, 409)]
    assert template.matches(places, 1000) == [(400, 403, 4)]
