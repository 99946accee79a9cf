"""Small inputs that every operator must take, and plain versions to compare with."""

import random

#: Nulls, empty and blank texts, repeated rows, ties, and columns whose names operators use themselves.
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "same text here twice over and over"), (6, "same text here twice over and over"), (5, "same text here twice over and over"), (None, "no key at all"), (7, "x " * 3000)]
SCHEMA = "doc_id long, text string, source string, key string, k1 string, score double"


def odd(spark, rows=None):
    return spark.createDataFrame([(i, t, None if i in (3, None) else "s", "k", "k", 0.5) for i, t in (ODD if rows is None else rows)], SCHEMA)


def passages(seed=3, n=60):
    """Texts of a small vocabulary with shared passages, periodic runs and copies."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(50)]
    base = [r.choice(words) for _ in range(400)]
    some = lambda most: [r.choice(words) for _ in range(r.randint(0, most))]
    rows = []
    for i in range(n):
        k = r.random()
        if k < 0.3:
            a = r.randint(0, 300)
            t = some(40) + base[a : a + r.randint(20, 100)] + some(40)
        elif k < 0.5:
            t = ["a"] * r.randint(30, 80)
        elif k < 0.6:
            t = ["a", "b", "c"] * r.randint(10, 30)
        elif k < 0.7:
            t = base[:120]
        else:
            t = some(90)
        rows.append((i, " ".join(t)))
    return [*rows, (100, None), (101, ""), (5, rows[5][1]), (102, rows[0][1].replace(" ", "\n"))]
