import math
import random

import numpy as np

from pyspark.sql import functions as F

from creditloom.llm import neighbours as nb


def brute(rows, k=5, every=50):
    def sound(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = {i: v for i, v in rows if i is not None and sound(v)}

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))

    return {
        q: sorted(((-round(cosine(v, w), 12), i) for i, w in good.items() if i != q))[:k] for q, v in good.items() if q % every == 0
    }


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"ids": F.lit("x"), "score": F.lit(1)}).repartition(3)


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((-round(r.score, 12), r.vec_id))
        assert len(out[r.query_id]) == r.rank
    return out


def test_small_tables_are_searched_whole(spark):
    rng = random.Random(12)
    common = [1.0, 2.0, -1.0]
    rows = [(i, [rng.randrange(-4, 5) * 0.5 for _ in range(3)]) for i in range(0, 120, 7)]
    rows += [(i, common) for i in (50, 51, 100, 103, 150, 151, 152)] + [(200, [2.0, 4.0, -2.0])]
    rows += [(300, None), (350, [0.0, 0.0, 0.0]), (400, [1.0, None, 2.0]), (450, [1.0, float("nan"), 0.0]), (None, common), (301, [float("inf"), 1.0, 1.0])]
    rows += [(302, [1.0, 1.0]), (50, common)]
    # under fewer pivots than are probed, everything is met; nothing is cut by footrule
    got = found(nb.nearest(frame(spark, rows), share=1.0))
    assert got == brute([r for r in rows if r[0] != 302])


def test_recall_and_long_lists(spark, monkeypatch):
    rng = random.Random(13)
    rows = [(i, [rng.gauss(0, 1) for _ in range(32)]) for i in range(1500)]
    rows += [(2000 + i, rows[3][1]) for i in range(300)]  # one very common vector
    expected = brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows])
    for block in (8192, 40):
        monkeypatch.setattr(nb, "VECTOR_BLOCK", block)
        monkeypatch.setattr(nb, "QUERY_BLOCK", block // 8)
        got = found(nb.nearest(frame(spark, rows)))
        assert set(got) == set(expected) and all(len(v) == 5 for v in got.values())
        hits = sum(len({i for _, i in got[q]} & {i for _, i in expected[q]}) for q in expected)
        assert hits >= 0.9 * 5 * len(expected)
        assert got[2000] == expected[2000] == [(-1.0, i) for i in (3, 2001, 2002, 2003, 2004)]


def test_few_found_looks_everywhere(spark):
    rng = random.Random(14)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(100)]
    assert found(nb.nearest(frame(spark, rows), k=60, n_pivots=64, probed=1)) == brute(
        [(i, [float(np.float32(x)) for x in v]) for i, v in rows], k=60
    )


def test_empty_and_single(spark):
    one = frame(spark, [(50, [1.0, 2.0])])
    assert nb.nearest(one).collect() == [] and nb.nearest(one.filter("vec_id < 0")).collect() == []
