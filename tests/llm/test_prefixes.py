import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from creditloom.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = leaves.get(node, 0) or 1
        saved[node] = saved.get(node, 0) + ((len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
        if node:
            up = node[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(ids), len(node), parent, len(ids), children.get(node, 0), leaves[node], saved[node], sha))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def conversations(rng, n=120, longest=12):
    words = ["a", "b", "é é", "", None, "longer text"]
    rows = []
    for c in rng.sample(range(3 * n), n):
        if rows and rng.random() < 0.3:  # begins like an earlier one
            start = [r for r in rows if r[0] == rng.choice(rows)[0]]
        else:
            start = []
        length = rng.randrange(1, longest)
        for t in range(length):
            role, text = start[t][2:] if t < len(start) else (rng.choice(["user", "bot", None]), rng.choice(words))
            rows.append((c, t * 2, role, text))
    return rows + [(None, 0, "user", "no id"), (900, None, "user", "null turn"), (900, 0, "user", "x"), (901, 5, "u", "y"), (901, 5, "u", "y")]


@pytest.mark.parametrize("container, window, ids", [(1024, 128, 1024), (3, 4, 2), (1, 2, 1)])
def test_against_brute_force(spark, container, window, ids):
    rows = conversations(random.Random(container))
    rows += [(1000 + 5 * i, t, "user", f"same {t}") for i in range(30) for t in range(6)]  # copies
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({c: F.lit(1) for c in ("pos", "seq", "n", "rep", "kind", "depth")})
    assert found(prefixes.prefix_trie(df, container, window, ids)) == brute(rows)


def test_long_conversations_are_chains(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (5, 10, 15, 21) for t in range(60 + (c == 15))]
    rows += [(40, t, "user", f"turn {t if t < 30 else -t}") for t in range(50)] + [(44, 0, "a", "b")]
    got = found(prefixes.prefix_trie(spark.createDataFrame(rows, SCHEMA), window=8, ids=3))
    assert got == brute(rows)


def test_turnless_and_empty(spark):
    rows = [(6, 0, "u", "t"), (7, 0, "u", "t"), (11, 0, "u", "t")]  # all own turns fall to an absent conversation
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 9 > 0]
    assert rows and found(prefixes.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    empty = prefixes.prefix_trie(spark.createDataFrame([(None, 1, "u", "t")], SCHEMA))
    assert empty.collect() == [] and sorted(empty.columns) == sorted(COLUMNS)


def test_twin(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    cur = con.execute(prefixes.prefix_trie_sql())
    names = [d[0] for d in cur.description]
    want = sorted((tuple(dict(zip(names, r))[c] for c in COLUMNS) for r in cur.fetchall()), key=str)
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert found(prefixes.prefix_trie(df)) == want == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
