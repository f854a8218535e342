import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from foldframe.llm import collocations
from foldframe.llm.collocations import Settings

AZ = {c: c + 32 for c in range(65, 91)}


def brute(docs: list[tuple], least: int, top: int, longest: int = 5) -> list[tuple]:
    """All rows, by counting every phrase."""
    f, n = {}, Counter()
    for text, lang in docs:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(AZ)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(w)
            own.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        cand = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        gone = {q[i:i + k] for q, b in cand.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if cand[q[i:i + k]] <= b}
        rows = []
        for p, a in cand.items():
            if p in gone:
                continue
            cuts = [(1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, r, p.decode(), -a, lf, rt, n[lang], -s) for r, (s, a, p, lf, rt) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def corpus(seed: int, n: int) -> list[tuple]:
    r = random.Random(seed)
    common = ["of the", "in spite of", "New York City", "a b c d e f g", "ÉTÉ été", "z z z z z z", "x"]
    docs = []
    for _ in range(n):
        part = []
        for _ in range(r.randint(0, 30)):
            part.append(r.choice(common) if r.random() < 0.6 else r.choice("pqrs") + str(r.randint(0, 200)))
            part.append(r.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "!", "\n", "\r\n", "\x0b"]))
        docs.append(("".join(part), r.choice(["en", "en", "en", "de", None, "und", ""])))
    return docs


@pytest.mark.parametrize("settings", [Settings(least=20), Settings(least=20, budget=40, units=4, fan=4, buffer=300, filter_bits=8, listed=1, mapped=2), Settings(least=3, least_share=10), Settings(least=20, mapped=5)])
def test_collocations_equal_brute_force(spark, settings):
    docs = [*corpus(3, 250), (None, "en"), ("", None), ("word", "fr"), (" \t.", "it"), ("long " * 40_000, "xx")]
    docs += [docs[0]] * 60
    df = spark.createDataFrame([(i, t, lang, 1, "q") for i, (t, lang) in enumerate(docs)], "doc_id long, text string, lang string, rank int, phrase string").repartition(3)
    for top in (2000, 7):
        got = sorted(tuple(r) for r in collocations.collocations(df, top, settings).collect())
        assert got == brute(docs, settings.least, top)
        assert got


def test_no_rows(spark, nothing):
    got = collocations.collocations(nothing)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() == 0


def test_scores_beyond_64_bits(spark):
    rows = [(3 * 10**15, 9 * 10**17, 7 * 10**12, 5 * 10**14), (10**12, 10**15, 10**12, 10**12)]
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").select(collocations.exact_score("a", "n", "l", "r")).collect()
    assert [r[0] for r in got] == [1000 * a * n // (lf * rt) for a, n, lf, rt in rows]


@pytest.mark.parametrize("listed", [0, 1000])
def test_prefixes_are_extended_and_subtrees_stay_small(spark, listed):
    """A third of all leaves start with one word; no subtree holds much more than the budget."""
    r = random.Random(2)
    rows = [(1 if k % 3 == 0 else r.randint(2, 50), *(r.randint(1, 40) for _ in range(4)), 1) for k in range(30_000)]
    rows += [(7, 8, 0, 0, 0, 5)]
    leaf = spark.createDataFrame(rows, "w1 long, w2 long, w3 long, w4 long, w5 long, n long")
    s = Settings(least=50, budget=500, units=16, fan=16, listed=listed)
    dealt = collocations.partitioned(leaf, s)
    assert dealt.count() == len(rows)
    assert dealt.groupBy("tree").count().agg({"count": "max"}).first()[0] <= 3 * s.budget
    assert dealt.where("w1 = 1").select("level").distinct().count() >= 1 and dealt.where("w1 = 1 and level > 1").count() == dealt.where("w1 = 1").count()
    prefixes = dealt.selectExpr("tree", "level", "slice(array(w1, w2, w3, w4, w5), 1, level) AS prefix").distinct()
    assert prefixes.groupBy("prefix").count().where("count > 1").isEmpty()
    want = Counter()
    for *w, n in rows:
        for d in range(2, 6):
            if w[d - 1]:
                want[tuple(w[:d])] += n
    got = {tuple(x.words): x.f for x in collocations.phrase_counts(leaf, s).collect()}
    assert got == {w: n for w, n in want.items() if n >= s.least}


def test_leaf_rows_do_not_grow_with_the_number_of_splits(spark):
    """Equal leaves of many splits meet in a task for each core before they become rows."""
    docs = spark.createDataFrame([(text, lang) for text, lang in corpus(5, 200)] * 8, "text string, lang string").repartition(40)
    every = [np.full(1 << 2, -1, np.int64).view(np.uint64)] * 3
    s = Settings(filter_bits=8)
    leaf = collocations.leaves(docs, every, s)
    names = [f"w{k}" for k in range(1, 6)]
    different = leaf.select(names).distinct().count()
    assert 0 < leaf.count() <= spark.sparkContext.defaultParallelism * different
    total = lambda df: {tuple(r) for r in df.groupBy(names).agg({"n": "sum"}).collect()}
    want = total(leaf)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        for buffer in (500, 3000, 5000):
            assert total(collocations.leaves(docs, every, s._replace(buffer=buffer))) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


class Given:
    """A table that keeps the function it is to be mapped by."""

    def __init__(self, spark):
        self.sparkSession = spark

    def select(self, *_):
        return self

    coalesce = select

    def mapInArrow(self, emit, _):
        return emit


@pytest.mark.parametrize("step", ["leaves", "pairs"])
def test_tasks_hold_leaves_once_and_give_them_out_in_parts(spark, step):
    """No batch that a task gives out is large, and to collect leaves it takes no more memory
    than twice its different ones (seven numbers each)."""
    every = [np.full(1 << 2, -1, np.int64).view(np.uint64)] * 3
    s = Settings(filter_bits=8, buffer=1 << 17)
    r = random.Random(4)
    texts = [" ".join(f"w{r.randrange(40_000)}" for _ in range(1_000)) for _ in range(150)]
    batches = [pa.RecordBatch.from_arrays([pa.array([x]), pa.array(["en"])], ["text", "lang"]) for x in texts]
    if step == "leaves":
        emit = collocations.leaves(Given(spark), every, s)
    else:
        emit = collocations.phrase_buckets(Given(spark), [np.full(1 << 14, -1, np.int64).view(np.uint64)], 2, s._replace(filter_bits=20))
    list(emit(iter(batches[:1])))
    sizes, total = [], 0
    tracemalloc.start()
    for out in emit(iter(batches)):
        sizes.append(len(out))
        total += pc.sum(out.column(out.num_columns - 1)).as_py()
        del out
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == len(texts) * 999 and max(sizes) <= 1 << 16
    assert step != "leaves" or peak <= 2 * 7 * 8 * total


def test_leaves_put_in_bit_by_bit_are_those_put_together_at_once():
    r = np.random.default_rng(1)
    rows = r.integers(0, 6, (5000, 3)).astype(np.uint64) << np.uint64(60)
    held = collocations.together(rows[:0])
    for part in np.split(rows, [0, 1, 2, 50, 50, 1000, 4999]):
        collocations.put_in(held, collocations.together(part))
    assert all(a.dtype == b.dtype and a.tolist() == b.tolist() for a, b in zip(held, collocations.together(rows), strict=True))
    assert Counter(map(tuple, rows.tolist())) == {tuple(w): n for *w, n in zip(*(x.tolist() for x in held[1:]))}


def test_subtree_counts_come_from_leaf_totals():
    words = np.array([[1, 2, 0], [1, 2, 3], [1, 2, 3], [4, 5, 6]])
    nodes, totals = collocations.subtree(words, np.array([1, 2, 3, 1]), np.array([1, 1, 1, 3]), 5)
    assert [x.tolist() for x in nodes] == [[[1, 2], [4, 5]], [[1, 2, 3]]] and [t.tolist() for t in totals] == [[6, 1], [5]]
