import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from foldframe.llm import pii
from foldframe.llm.queries import op12_candidate_boosting

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def passes(kind: str, hit: str) -> bool:
    digits = re.sub(r"[^0-9]", "", hit)
    if kind == "ip":
        return all(int(x) <= 255 for x in hit.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base(text: str | None) -> list[tuple[str, int, int]]:
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def expected(text: str | None) -> tuple:
    found = base(text)
    return (*(sum(k == x for x, _, _ in found) for k in PATTERNS), hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest())


def card(r: random.Random) -> str:
    head = "4" + "".join(r.choice("0123456789") for _ in range(14))
    return next(head + c for c in "0123456789" if luhn(head + c))


def noise(seed: int) -> str:
    """Pieces that are like personal data, whole or broken, one against the other."""
    r = random.Random(seed)
    bits = [lambda: card(r), lambda: " ".join(re.findall("....", card(r))), lambda: str(r.randint(0, 10**r.randint(1, 20))), lambda: ".".join(str(r.randint(0, 300)) for _ in range(r.randint(2, 9))),
            lambda: f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}", lambda: f"a{r.randint(0, 9)}.b@mail.example.com", lambda: "a@b.c_x@d.e", lambda: "+-@..", lambda: "𝔘é",
            lambda: "+", lambda: "0001.2.3.0255", lambda: "x@y", lambda: "1-2 3", lambda: "word", lambda: "@", lambda: "%_a@b-.c.", lambda: "+49 (0) 30.123-45 x"]
    return "".join(r.choice(bits)() + r.choice(["", " ", " ", "-", ".", "\n", "  "]) for _ in range(r.randint(0, 25)))


def rows_of(df) -> dict:
    return {r.doc_id: r for r in df.collect()}


def test_strict_spans_equal_brute_force(spark):
    docs = {k: noise(k) for k in range(600)} | {600: None, 601: "", 602: "no digits", 603: "1 " * 4000, 604: "7" * 4000, 605: "a" * 4000 + "@", 606: "a.b@" * 2000, 607: "1." * 2000, 608: "+1" * 2000}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    rows = rows_of(pii.personal_data(df, pii.Settings(trees=3, depth=2)))
    assert set(rows) == set(docs)
    for k, t in docs.items():
        r = rows[k]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == expected(t), (k, t)
        spans = [(k2, int(a), int(b)) for k2, a, b in (x.split(":") for x in r.spans.split(",") if x)]
        assert set(base(t)) <= set(spans)
        assert spans == sorted(spans, key=lambda x: (list(PATTERNS).index(x[0]), x[1], x[2]))
        assert [(x.kind, x.start, x.stop) for x in r.found] == spans


def test_very_long_texts_need_no_stack_and_linear_time(spark):
    docs = ["1 " * 300_000, "7" * 300_000, "a" * 300_000 + "@", "a.b@" * 30_000, "1." * 100_000, "+1" * 100_000, ". " * 300_000 + "a@b.cc", "1-" * 100_000]
    rows = rows_of(pii.personal_data(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), pii.Settings(trees=2, depth=2)))
    assert [rows[k].n_email + rows[k].n_ip + rows[k].n_card + rows[k].n_phone for k in range(8)] == [0, 0, 0, 15_000, 25_000, 0, 1, 0]


def corpus(n: int) -> dict[int, str]:
    """Documents with one item each; every 25th has two that the strict rules run together,
    every 7th numbers that are no personal data."""
    r = random.Random(11)
    words = "the of and with that from this when where then".split()
    docs = {}
    for k in range(n):
        w = [r.choice(words) for _ in range(30)]
        item = [f"n{k}.{r.randint(10, 99)}@mail.example.com", ".".join(str(r.randint(1, 250)) for _ in range(4)), card(r), f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"][k % 4]
        w[r.randint(3, 25)] = item
        if k % 25 == 0:
            w[10] = f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)} {card(r)}"
        if k % 7 == 0:
            w[28] = "id" + str(r.randint(10**12, 10**13)) + "x"
            w[2] = next(x for x in (str(r.randint(10**15, 10**16 - 1)) for _ in range(99)) if not luhn(x))
        docs[k] = " ".join(w)
    return docs


def test_the_trees_find_what_the_strict_rules_run_together(spark):
    docs = corpus(1500)
    rows = rows_of(pii.personal_data(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)))
    found = wrong = joined = 0
    for k, t in docs.items():
        more = {(x.kind, x.start, x.stop) for x in rows[k].found} - set(base(t))
        hits = {(kind, t[a:b]) for kind, a, b in more}
        if k % 25 == 0:
            joined += 1
            m = re.search(r"(\+1 \(\d+\) 555-\d{4}) (\d{16})", t)
            found += ("card", m.group(2)) in hits and ("phone", m.group(1)) in hits
            hits -= {("card", m.group(2)), ("phone", m.group(1))}
        wrong += len(hits)
    assert found >= 0.9 * joined and wrong <= 0.01 * len(docs)


def test_masked_text(spark):
    docs = {1: "call +1 (438) 555-7372 é a@b.com!", 2: "plain", 3: None, 4: "a@b.com"}
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = pii.personal_data(d).select(F.col("doc_id").alias("f_id"), "found")
    got = {r.doc_id: r.out for r in d.join(found, F.col("doc_id") == F.col("f_id")).select("doc_id", pii.masked(F.col("text"), F.col("found")).alias("out")).collect()}
    assert got == {1: "call <PHONE> é <EMAIL>!", 2: "plain", 3: None, 4: "<EMAIL>"}


def test_repeated_rows_null_ids_extra_columns_no_rows_and_no_python(spark, documents, nothing):
    assert pii.personal_data(nothing).count() == 0
    assert pii.personal_data(documents).count() == documents.count()
    odd = spark.createDataFrame([(None, "a@b.cc", 1, "x"), (None, None, 2, "x"), (5, "a@b.cc", 3, "x"), (5, "a@b.cc", 3, "x"), (5, "1.2.3.4", 3, "x")], "doc_id long, text string, key int, found string")
    got = sorted((r.doc_id or -1, r.spans) for r in pii.personal_data(odd).collect())
    assert got == [(-1, ""), (-1, "email:0:6"), (5, "email:0:6"), (5, "email:0:6"), (5, "ip:0:7")]
    plan = pii.matched(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = rows_of(op12_candidate_boosting(spark, sf))
    assert set(rows) == set(docs)
    for k, t in docs.items():
        r = rows[k]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == expected(t)


def test_trees_are_fitted_on_half_of_all_proposals(spark, monkeypatch):
    class Seen(Exception):
        pass

    class Trees:
        def __init__(self, **_):
            pass

        def fit(self, rows):
            raise Seen(rows.count())

    monkeypatch.setattr(pii, "GBTClassifier", Trees)
    made = spark.range(50_000).selectExpr("'ip' AS kind", "id % 2 = 0 AS own", "id % 2 = 1 AS other", "string(id) AS hit", "'' AS tail", "'' AS head", "0.0 AS x")
    with pytest.raises(Seen) as seen:
        pii.fitted(made, pii.Settings())
    assert 24_000 < seen.value.args[0] < 26_000
