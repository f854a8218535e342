import random

import pytest

SYLLABLES = [a + b for a in "bdfgklmnprstvz" for b in ("a", "e", "i", "o", "u", "é")]


def prose(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="session")
def texts():
    """Documents with nulls, empty and long texts, copies, near copies and shared passages."""
    r = random.Random(5)
    base, passage = prose(1, 200), prose(2, 60)
    docs: dict[int, str | None] = {0: None, 1: "", 2: " \t\n ", 3: "one", 4: "one", 5: "two words here", 6: "\u00a0 \x1c nobreak"}
    docs[10] = " ".join(base)
    docs[11] = " ".join(base)
    parent = base
    for k in range(12, 40):  # copies of copies, each with some words changed
        src = base if k % 3 else parent
        w = list(src)
        for _ in range(r.randint(1, 5)):
            w[r.randrange(len(w))] = f"x{k}{r.randrange(99)}"
        parent = w
        docs[k] = "\n".join([" ".join(w[:80]), " ".join(w[80:])])
    for k in range(40, 60):
        own = prose(100 + k, r.randint(1, 150))
        at = r.randrange(len(own))
        docs[k] = " ".join(own[:at] + passage[r.randrange(0, 8):60 - r.randrange(0, 8)] + own[at:])
    docs[70] = " ".join(prose(7, 30_000))
    docs[71] = "x" * 200_000
    docs[72] = "same " * 3000
    docs[73] = "same " * 2900
    return docs


@pytest.fixture(scope="session")
def documents(spark, texts):
    """The texts as a table with further columns, two of them called like results."""
    rows = [(i, t, ["a", "b", None, "é"][i % 4], "en", i, "q", -1) for i, t in texts.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, class_id string, slot int").repartition(3)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.where("false")
