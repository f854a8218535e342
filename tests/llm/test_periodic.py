import hashlib
import random
from zlib import crc32

import pytest

from brute import words
from foldframe.llm import periodic
from foldframe.llm.queries import op13_periodic_runs


def runs_of(w: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by trying every period at every place."""
    found: dict[tuple, int] = {}
    for p in range(1, len(w) // 3 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(24, 3 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def expected(text: str | None) -> tuple:
    w = words(text)
    runs = sorted(runs_of(w), key=lambda r: (r[0], r[2]))
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(runs, key=lambda r: (r[0], r[2])))
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def got(row) -> tuple:
    return (row.n_runs, row.start, row.length, row.period, row.exponent_milli, row.runs_sha256, row.collapsed_sha256)


def made(seed: int) -> str:
    """Words with runs of many periods, next to, inside and across each other."""
    r = random.Random(seed)
    w = []
    for _ in range(r.randint(1, 6)):
        w += [r.choice("abcdefgh") + str(r.randint(0, 30)) for _ in range(r.randint(0, 40))]
        unit = [r.choice("ab" if r.random() < 0.5 else "abcdefg") for _ in range(r.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 24, 31, 33, 60]))]
        if r.random() < 0.3:
            unit = unit * 2 + [r.choice("xy")]
        part = unit * r.randint(1, 9)
        w += part[:len(part) - r.randrange(len(unit))]
    return " ".join(w)


def test_runs_equal_brute_force(spark):
    docs = {k: made(k) for k in range(300)}
    docs[300] = "same " * 700
    docs[301] = ("p q " * 40 + "z ") * 9
    docs[302] = " ".join(made(k) for k in range(25))
    docs[303] = " ".join(made(7).split() * 3)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r for r in periodic.periodic_runs(df).collect()}
    assert len(rows) == len(docs)
    wrong = [k for k, t in docs.items() if got(rows[k]) != expected(t)]
    assert not wrong
    for k, t in docs.items():
        r = rows[k]
        assert hashlib.sha256(r.text.encode()).hexdigest() == r.collapsed_sha256
        assert r.n_words == len(words(t)) and r.n_words - r.n_dropped == len(words(r.text))
        assert len(r.runs or []) == r.n_runs


def test_nulls_empty_long_texts_repeated_rows_and_clashing_columns(spark, documents, texts, nothing):
    slim = periodic.periodic_runs(documents, keep_text=False)
    rows = {r.doc_id: r for r in slim.collect()}
    for k, t in texts.items():
        if k in (72, 73):  # one word over and over
            n = len(words(t))
            assert (rows[k].n_runs, rows[k].start, rows[k].length, rows[k].period, rows[k].n_dropped) == (1, 0, n, 1, n - 1)
        elif len(words(t)) < 2000:
            assert got(rows[k]) == expected(t)
        else:
            assert rows[k].n_runs == 0 and rows[k].n_words == len(words(t))
    assert periodic.periodic_runs(nothing).count() == 0
    odd = spark.createDataFrame([(None, "a b " * 20, 1), (None, None, 2), (5, "a b " * 20, 3), (5, "a b " * 20, 3), (5, "c " * 30, 4)],
                                "doc_id long, text string, n_runs int")
    seen = sorted((r.doc_id or -1, r.n_runs, r.period or 0) for r in periodic.periodic_runs(odd).collect())
    assert seen == [(-1, 0, 0), (-1, 1, 2), (5, 1, 1), (5, 1, 2), (5, 1, 2)]


def test_a_long_document_is_solved_in_many_tiles(spark):
    unit = [f"w{i}" for i in range(5000)]
    text = " ".join(["x"] + unit * 4 + ["y"] + ["a", "b", "c"] * 30_000)
    tiles = periodic.exploded(spark.createDataFrame([(1, text)], "doc_id long, text string"), False).first().tiles
    assert len(tiles) > 50 and all(len(t.ids) <= (max(1024 // t.step, 8) + 5) * t.step for t in tiles)
    row = periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(1, 5000, 20_001), (20_002, 3, 110_002)]
    assert (row.start, row.length, row.period) == (20_002, 90_000, 3)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in op13_periodic_runs(spark, sf).collect()}
    assert set(rows) == set(docs)
    planted = 0
    for k, t in docs.items():
        w, h = words(t), crc32(str(k).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
            planted += 1
        if n < 3000:
            assert got(rows[k]) == expected(" ".join(w)), k
    assert planted
