import random

from pyspark.sql import functions as F

from creditloom.llm import quotations as qt

SCHEMA = "conv_id long, turn int, role string, text string"


def brute(rows):
    """{(conv_id, turn, text): (parent, thread, depth, number of quotes, origins)} by looking through all messages."""
    own, quotes = {}, {}
    for c, t, _, text in rows:
        lines, passages = qt.split_quotes(text or "")
        if c is not None and t is not None:
            own.setdefault((c, t), set()).update(qt.units(lines))
        quotes[c, t, text] = passages
    out, parents = {}, {}
    for (c, t, text), passages in quotes.items():
        origins, words = [], {}
        for i, (level, lines) in enumerate(passages if c is not None and t is not None else []):
            weight = {}
            for unit, n in qt.units(lines).items():
                here = sorted(p for p, u in own.items() if unit in u and p[0] == c and p < (c, t))
                there = sorted(p for p, u in own.items() if unit in u and p[0] != c)
                # of another conversation, the first of its messages
                if here or there:
                    weight[(here or there)[0]] = weight.get((here or there)[0], 0) + n
            if weight:
                best = min(weight, key=lambda p: (-weight[p], p[0] != c, p))
                origins.append((i, level, *best))
                if level == 1 and best[0] == c:
                    words[best[1]] = words.get(best[1], 0) + weight[best]
        parent = min(words, key=lambda p: (-words[p], p)) if words else None
        out[c, t, text] = (parent, len(passages), origins)
        if parent is not None:
            parents[c, t] = min(parent, parents.get((c, t), parent))
    result = {}
    for (c, t, text), (parent, n, origins) in out.items():
        thread, depth = t, 0
        while (c, thread) in parents:
            thread, depth = parents[c, thread], depth + 1
        result[c, t, text] = (parent, thread, depth, n, origins)
    return result


def threads_of_mail():
    rng = random.Random(16)
    rows = []
    for c in range(12):
        said = []
        for t in range(rng.choice([1, 4, 12])):
            text = "\n".join(" ".join(rng.choice("red green blue one two three".split()) for _ in range(rng.choice([1, 4, 7]))) for _ in range(rng.choice([1, 2, 3])))
            for _ in range(rng.choice([0, 1, 1, 2]) if rows else 0):
                other = rng.choice(said if said and rng.random() < 0.8 else rows)[3]
                part = other.split("\n")[: rng.choice([1, 9])]
                quote = "\n".join(rng.choice(["> ", ">", ">>", "> > "]) + (x.upper() if rng.random() < 0.3 else x) for x in part)
                text = rng.choice([f"Ann wrote:\n{quote}\n{text}", f"{text}\n{quote}\n\n{text}", quote])
            said.append((c, t, rng.choice(["user", "assistant"]), text))
            rows.append(said[-1])
    return rows + [(90, 0, "user", None), (90, 1, None, ""), (None, 1, "user", "> red\nx"), (91, None, "user", "red"), (92, 0, "user", "> lost words"),
                   rows[3], (rows[3][0], rows[3][1], "user", "another at this place\n> one"), (93, 1, "user", "> again again"), (93, 2, "user", "again again")]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({"level": F.lit("x"), "passage": F.lit(1)}).repartition(3)


def test_against_brute_force(spark):
    rows = threads_of_mail()
    expected = brute(rows)
    df = frame(spark, rows)
    got = qt.reply_ordered(df).collect()
    assert len(got) == len(rows)
    plain = {}
    for c, t, text in expected:
        own, passages = qt.split_quotes(text or "")
        plain.setdefault((c, t, text if not passages else "\n".join(own).strip("\n")), []).append(expected[c, t, text])
    for r in got:
        origins = [(o.passage, o.level, o.conv_id, o.turn) for o in r.origins or []]
        assert (r.parent, r.thread, r.depth, r.n_quotes, origins) in plain[r.conv_id, r.turn, r.text]
        assert r.n_linked == len(origins)
    assert max(r.depth for r in got) > 1
    place = {}
    for i, r in enumerate(got):
        place.setdefault((r.conv_id, r.turn), i)
        if r.parent is not None:
            assert place[r.conv_id, r.parent] < i


def test_levels_and_attributions():
    text = "Hi,\nOn Monday Bob wrote:\n> > old\n>> older\n> new\n\n>mine too\nbye > all"
    assert qt.split_quotes(text) == (["Hi,", "", "bye > all"], [(2, ["old", "older"]), (1, ["new"]), (1, ["mine too"])])


def test_long_chain_and_hot_line(spark):
    rows = [(1, t, "user", f"> note number {t - 1}\nnote number {t}") for t in range(70)] + [(2, t, "user", "> same\nsame") for t in range(40)]
    got = {(r.conv_id, r.turn): r for r in qt.reply_ordered(frame(spark, rows)).collect()}
    assert [got[1, t].depth for t in range(70)] == list(range(70)) and {got[1, t].thread for t in range(70)} == {0}
    assert [got[2, t].parent for t in range(40)] == [None] + [0] * 39 and {r.text for r in got.values() if r.conv_id == 2} == {"same"}


def test_empty_table(spark):
    assert qt.reply_ordered(frame(spark, [(1, 0, "user", "x")]).filter("turn > 5")).collect() == []
