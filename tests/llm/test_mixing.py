import random
from collections import Counter

import pytest

from brute import targets, words
from foldframe.llm import mixing
from pyspark.sql import functions as F

SEED = 11


def table(spark, seed: int, sources: int, per: int, odd: bool):
    """Small sources; with `odd` a third of all rows have no doc_id, ids repeat, rows repeat."""
    r = random.Random(seed)
    rows = []
    for s in range(sources):
        name = None if s == 3 else f"s{s}"
        for _ in range(r.randint(1, per)):
            text = " ".join(r.choice("abcdef") * r.randint(1, 4) for _ in range(r.randint(0, 30)))
            i = None if odd and r.random() < 0.33 else r.randint(0, 20 if odd else 10**9)
            rows += [(i, text, name, len(text), "q", -1)] * (r.randint(1, 4) if odd and r.random() < 0.3 else 1)
    rows.append((5, None, "s0", 0, "q", -1))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, copies string, number int").repartition(4)


def brute_draw(spark, docs, weights, most, power=0.25) -> dict:
    """Copies of each (group, number), drawn source by source."""
    u = ((F.shiftrightunsigned(F.xxhash64("doc_id", "group", "number", F.lit(SEED)), 11) + F.lit(0.5)) * F.lit(2.0 ** -53)).alias("u")
    d = docs.select("doc_id", F.col("source").alias("s"), "text", mixing.row_group(docs).alias("group"))
    rows, count = [], Counter()
    for r in d.collect():
        count[r.group] += 1
        rows.append((r.doc_id, r.group, count[r.group], r.s, len(words(r.text))))
    at = spark.createDataFrame([x[:3] for x in rows], "doc_id long, group long, number long").select("group", F.col("number").cast("long"), u)
    # numbers are whole numbers of the operator's own type
    us = {(r.group, r.number): r.u for r in at.collect()}
    total = Counter()
    for *_, s, n in rows:
        total[s] += n
    goal, out = targets(total, weights, most), {}
    for s in {x[3] for x in rows}:
        own = [(g, k, n, max(1, n) ** power) for _, g, k, x, n in rows if x == s]
        full = set()
        while True:
            open_w = sum(n * w for g, k, n, w in own if (g, k) not in full)
            left = max(0.0, goal[s] - sum(n * most for g, k, n, _ in own if (g, k) in full))
            factor = left / open_w if open_w > 0 else float("inf")
            now = {(g, k) for g, k, _, w in own if factor * w >= most or (g, k) in full}
            if now == full:
                break
            full = now
        expect = {(g, k): min(most, factor * w) if n else 0.0 for g, k, n, w in own}
        sure = {key: int(e + 1e-9) for key, e in expect.items()}
        size = {(g, k): n for g, k, n, _ in own}
        opens = goal[s] - sum(sure[key] * size[key] for key in sure)
        q = {}
        for key, e in expect.items():
            p = e - sure[key]
            if p > 0:
                q[key] = us[key] * (1 - p) / (us[key] * (1 - p) + (1 - us[key]) * p)
        upto, extra = 0, dict.fromkeys(q, 0)
        for key in sorted(q, key=lambda x: (q[x], x)):
            upto += size[key]
            extra[key] = int(upto - size[key] / 2 <= opens)
        gap, used = opens - sum(extra[key] * size[key] for key in q), set()
        while abs(gap) > goal[s] * 0.005:
            can = [(abs(gap - (size[x] if not extra[x] else -size[x])), q[x], x) for x in q if x not in used and size[x]]
            can = [c for c in can if c[0] < abs(gap)]
            if not can:
                break
            key = min(can)[2]
            gap -= -size[key] if extra[key] else size[key]
            extra[key] = 1 - extra[key]
            used.add(key)
        for key in sure:
            out[key] = min(most, sure[key] + extra.get(key, 0)) if size[key] else 0
    return out


@pytest.mark.parametrize(("seed", "sources", "per", "odd"), [(1, 30, 6, False), (2, 30, 6, True), (3, 4, 200, True)])
def test_draw_equals_brute_force(spark, seed, sources, per, odd):
    rows, docs = table(spark, seed, sources, per, odd)
    got = {(r.group, r.number): r for r in mixing.decided(docs, (1.0, 2.0, 3.0), 3, mixing.longer_first(F.col("text")), SEED).collect()}
    assert len(got) == len(rows)
    want = brute_draw(spark, docs, (1, 2, 3), 3)
    assert {k: r.copies for k, r in got.items()} == want
    again = mixing.decided(docs.repartition(2), (1.0, 2.0, 3.0), 3, mixing.longer_first(F.col("text")), SEED)
    assert {(r.group, r.number): r.copies for r in again.collect()} == want


def test_mixed_rows_repeat_every_row_by_its_own_decision(spark):
    rows, docs = table(spark, 2, 30, 6, True)
    copies = Counter()
    for r in mixing.mix(docs, preference=mixing.longer_first(F.col("text"))).collect():
        copies[r.doc_id, r.size] += r.copies
    mixed = mixing.mixed_rows(docs, preference=mixing.longer_first(F.col("text")))
    assert mixed.columns == docs.columns
    out = Counter((r.doc_id, len(words(r.text))) for r in mixed.collect())
    assert out == +copies and any(i is None for i, _ in out)


def test_a_capped_source_has_nothing_to_draw_and_fills_no_window(spark):
    """The first source's target stops at 3 times its size: all its documents are certain."""
    rows = [(i, "w " * (1 + i % 7), "a" if i < 400 else "b") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    d = mixing.mix(docs, weights=(9.0, 1.0)).where("size > 0").toPandas()
    d["source"] = ["a" if i < 400 else "b" for i in d.doc_id]
    a = d[d.source == "a"]
    assert (a.copies == 3).all() and a.taken.sum() == a.target.iloc[0]
    assert d[d.source == "b"].taken.sum() == pytest.approx(d[d.source == "b"].target.iloc[0], rel=0.005)


def test_many_equal_rows_are_numbered_by_partition(spark):
    docs = spark.createDataFrame([(None, "a b c", "s")] * 3000 + [(1, "x y", "t")], "doc_id long, text string, source string").repartition(6)
    base = mixing.saved(docs.withColumn("g", mixing.row_group(docs)), "test-rows")
    numbers = Counter((r.g, r.n) for r in mixing.numbered(base, "g", "n").collect())
    assert set(numbers.values()) == {1} and sorted(n for g, n in numbers)[-1] == 3000
    got = mixing.mix(docs, weights=(1.0, 1.0)).toPandas()
    assert len(got) == 3001 and got[got["size"] == 3].taken.sum() == pytest.approx(got[got["size"] == 3].target.iloc[0], abs=3)
