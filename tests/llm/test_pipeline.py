from collections import Counter

import corpus_pipeline
import pytest

from brute import classes
from test_texts import brute_templates
from foldframe.llm import mixing, quality
from foldframe.llm.queries import acceptable
from foldframe.session import saved
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), "test-stage")
        out.append(docs)
    return out


def test_every_stage_keeps_the_columns_of_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "MinHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    assert all(s.columns == stages[0].columns and s.count() for s in stages[:-1])


def test_stage_decisions_take_effect(spark, stages):
    docs, good, lined, single, mixed, packed = stages
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    keep = quality.classify(docs, labels, acceptable(), F.col("source"), F.col("lang")).where("keep")
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    assert ids(good) == ids(keep)
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in (good, lined))
    lost = brute_templates(before)
    assert after == {i: "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in lost) for i, t in before.items()}
    assert ids(single) == sorted(i for i, c in classes(after).items() if i == c)
    copies = {r.doc_id: r.copies for r in mixing.mix(single, preference=mixing.longer_first(F.col("text"))).collect()}
    assert ids(mixed) == sorted(i for i, n in copies.items() for _ in range(n))
    first = packed.where("piece = 0").select("doc_id")
    assert ids(first) == ids(mixed)
    assert packed.groupBy("sequence_id").sum("length").agg(F.max("sum(length)")).first()[0] <= 2048


def test_null_and_repeated_ids_and_no_rows_go_through_all_stages(spark, tmp_path):
    """Every row is decided on by itself: none is lost for its id or comes out squared."""
    base = spark.read.parquet(f"{SF}/documents.parquet")
    good = base.where("length(text) between 400 and 3000").orderBy("doc_id").limit(60).collect()
    cols = base.columns
    rows = [tuple(r) for r in good]
    at = {c: i for i, c in enumerate(cols)}
    odd = lambda r, **new: tuple(new.get(c, r[at[c]]) for c in cols)
    rows += [odd(rows[0], doc_id=None), odd(rows[1], doc_id=None)] + [odd(rows[1], doc_id=None)] * 2 + [rows[2]] * 3 + [odd(rows[3], doc_id=rows[4][at["doc_id"]])]
    rows += [odd(rows[5], doc_id=9001, text=None), odd(rows[5], doc_id=9002, text="")]
    sf = str(tmp_path / "sf")
    spark.createDataFrame(rows, base.schema).repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{sf}/labels.parquet")
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, sf), "test-odd")
        seen.append(docs)
    kept, lined, single, mixed, packed = seen
    count = lambda d: Counter((r.doc_id, r.text) for r in d.select("doc_id", "text").collect())
    judged = quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), acceptable(), F.col("source"), F.col("lang"))
    assert kept.count() == judged.where("keep").count() and count(kept) <= Counter((r[at["doc_id"]], r[at["text"]]) for r in rows)
    assert count(kept)[None, rows[1][at["text"]]] in (0, 3) and lined.count() == kept.count()
    nulls = [r for r in count(lined) if r[0] is None]
    assert all(count(single)[r] == count(lined)[r] for r in nulls)
    taken = Counter()
    for r in mixing.mix(single, preference=mixing.longer_first(F.col("text"))).collect():
        taken[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == +taken
    assert packed.where("piece = 0").count() == mixed.count()
    empty = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = saved(stage(spark, empty, sf), "test-empty")
        assert empty.count() == 0
