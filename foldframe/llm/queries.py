"""Registered queries of this folder: one thin query per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from . import bagminhash, collocations, exacttopk, linetemplates, mixing, packing, periodic, permutation, pii, quality, sharding, substring, urlfilter

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document: weights 1, 2, 3 over the sources,
    at most 3 copies, longer documents preferred by words to the power 0.25."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, weights=(1.0, 2.0, 3.0), max_copies=3, preference=mixing.longer_first(F.col("text")))


def op2_log_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of templates that recur across documents."""
    d = linetemplates.drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op3_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every 20th vector by the permutation index."""
    return permutation.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_cover_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that repeat 50 words of a smaller document."""
    return substring.remove_repeats(table(spark, sf_dir, "documents"), window=50, keep_text=False)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """The installed vocabulary file; workers have it at the same place."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op5_exact_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), size=2048)


def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 8 shards of nearly equal bytes, by 4096 virtual slots; the
    slot map is kept as a table of versions."""
    records, _ = sharding.shard(table(spark, sf_dir, "documents"), shards=8, map_path=scratch_path(spark, "slot-map"))
    return records.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"), "vslot")


def op7_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL by four rules and the aliases that its links make."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules).drop("alias_rule")


def op8_no_random_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every 50th vector, exactly."""
    return exacttopk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def acceptable() -> Column:
    """What the labels call a good document: of quality and not toxic."""
    return (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)


def op9_empirical_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior quality of every document; its source stands for the host, its source
    and language for the path. Fitted on at most 20,000 labelled rows."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), acceptable(), F.col("source"), F.col("lang")).drop("row_group")


def op10_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: five-word shingles with their counts,
    weighted Jaccard similarity of 0.8 or more."""
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"), similarity=0.8)


def op11_vertical_partitioning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of every language: phrases of 2 to 5 words that occur
    100 times or more."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the strict rules' spans and what the trees add."""
    return pii.personal_data(table(spark, sf_dir, "documents")).drop("found")


def repeated_tail(text: Column, doc_id: Column) -> Column:
    """The text; for the tenth of documents with h % 10 = 0, h = crc32 of the decimal
    doc_id, its words with those from number a on replaced by the p words there, again
    and again: g = floor(h / 10), a = g % n, p = 1 + floor((n - a) / (3 + g % 8))."""
    h = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.greatest(F.size(words), F.lit(1)).cast("long"), F.floor(h / 10)
    a = F.pmod(g, n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
    one = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.flatten(F.array_repeat(one, F.ceil((n - a) / p).cast("int")))
    new = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int")))
    return F.when((F.pmod(h, F.lit(10)) == 0) & text.isNotNull() & F.coalesce(F.size(words) > 0, F.lit(False)), F.array_join(new, " ")).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of them with a repeated tail."""
    docs = table(spark, sf_dir, "documents")
    return periodic.periodic_runs(docs.select("doc_id", repeated_tail(F.col("text"), F.col("doc_id")).alias("text")), keep_text=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pareto_mix": op1_pareto_mix,
    "op2_log_templates": op2_log_templates,
    "op3_permutation_index": op3_permutation_index,
    "op4_cover_anchors": op4_cover_anchors,
    "op5_exact_complement_packing": op5_exact_complement_packing,
    "op6_virtual_slots": op6_virtual_slots,
    "op7_redirect_equivalence": op7_redirect_equivalence,
    "op8_no_random_access": op8_no_random_access,
    "op9_empirical_bayes": op9_empirical_bayes,
    "op10_bag_minhash": op10_bag_minhash,
    "op11_vertical_partitioning": op11_vertical_partitioning,
    "op12_candidate_boosting": op12_candidate_boosting,
    "op13_periodic_runs": op13_periodic_runs,
}

# The others are beyond SQL (hashes of Spark's own, fitted models, tokenizers, components)
# and are held against brute force in tests/llm.
ORACLE: dict[str, str] = {
    "op4_cover_anchors": r"""
WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS word,
                  generate_subscripts(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, md5(array_to_string(list(word) OVER win, ' ')) AS h, count(*) OVER win AS n FROM w
      WINDOW win AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
m AS (SELECT h, min(doc_id) AS least FROM k WHERE n = 50 GROUP BY h),
g AS (SELECT DISTINCT k.doc_id, unnest(range(k.pos, k.pos + 50)) AS pos FROM k JOIN m USING (h) WHERE k.n = 50 AND m.least < k.doc_id),
r AS (SELECT w.doc_id, count(*) AS n_words, count(g.pos) AS n_removed, string_agg(w.word, ' ' ORDER BY w.pos) FILTER (WHERE g.pos IS NULL) AS kept
      FROM w LEFT JOIN g ON g.doc_id = w.doc_id AND g.pos = w.pos GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN r USING (doc_id)""",
    "op8_no_random_access": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE len(embedding) = (SELECT mode(len(embedding)) FROM embeddings)
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_vertical_partitioning": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, words FROM (
       SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words FROM documents)),
w AS (SELECT lang, piece, generate_subscripts(words, 1) AS i, words FROM p WHERE len(words) > 0),
f AS MATERIALIZED (SELECT lang, list_slice(words, i, i + d - 1) AS words, d, count(*) AS f FROM w, range(1, 6) AS x(d) WHERE i + d - 1 <= len(words)
      GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
c AS (SELECT * FROM f WHERE d > 1 AND NOT EXISTS (SELECT 1 FROM f AS g WHERE g.lang = f.lang AND g.d = f.d + 1 AND g.f = f.f
      AND f.words IN (list_slice(g.words, 1, f.d), list_slice(g.words, 2, f.d + 1)))),
k AS (SELECT lang, words, f AS a, unnest(range(1, d)) AS k FROM c),
s AS (SELECT k.lang, k.words, k.a, k.k, l.f AS l, r.f AS r, n.n, 1000::HUGEINT * k.a * n.n // (l.f::HUGEINT * r.f) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.words = list_slice(k.words, 1, k.k) JOIN f r ON r.lang = k.lang AND r.words = list_slice(k.words, k.k + 1, len(k.words)) JOIN n ON n.lang = k.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, words ORDER BY score, k) AS cut FROM s),
t AS (SELECT *, array_to_string(words, ' ') AS phrase FROM b WHERE cut = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM t)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM o WHERE rank <= 2000""",
}
