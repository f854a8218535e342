"""Quality classifier with hierarchical empirical Bayes.

A document's own evidence is the log-odds of a logistic regression on shape
features and a learned lexicon. Its site adds a prior: the mean quality of the
documents on its host, shrunk toward the global mean, and of those on its path,
shrunk toward the host. How far is learned from the corpus, by comparing how
much sites differ with how much documents of one site differ, so a sparse site
says little and a large one its own rate. All site statistics are grouped
aggregates over every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import saved
from .textblocks import Block, block_of, blocks, signed

# labelled rows that the classifier is fitted on, and words of its lexicon
SAMPLE, LEXICON = 20_000, 4096
# a word enters the lexicon if so many labelled documents hold it and its log-odds lie so many standard errors from 0
MIN_DOCS, MIN_Z = 5, 2.5
# and tells by so much: less is what a language's or topic's share of bad documents makes of all its words
MIN_ODDS = 3.0
PREFIX = 6
SHAPES = ("log_words", "upper", "signs", "digits", "word_bytes", "variety", "stutter", "edge_signs", "good_words", "bad_words")
NO_WORDS = -20.0

_byte = np.arange(256)
UPPER = (_byte >= 65) & (_byte <= 90)
LETTER = UPPER | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)
DIGIT = (_byte >= 48) & (_byte <= 57)
SIGN = (_byte > 32) & (_byte < 127) & ~LETTER & ~DIGIT
# for the lexicon: letters in lower case (ASCII), all else a blank
FOLDED = np.where(LETTER, np.where(UPPER, _byte + 32, _byte), 32).astype(np.uint8)


class Model(NamedTuple):
    words: np.ndarray  # sorted hashes
    odds: np.ndarray  # log-odds of a good document where the word occurs
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray  # the last one is the constant


def distinct_words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the different words and word beginnings of a block's texts, sorted
    by text. Words are runs of letters, whatever their case; a beginning is the first
    PREFIX bytes of a longer word, so that forms of a word count together."""
    b = block_of(block.first, FOLDED[block.data], block.offsets)
    text, h = np.repeat(np.arange(len(b.offsets) - 1), b.counts()), b.hashes()
    longer = np.flatnonzero(b.ends - b.starts > PREFIX)
    begun = b._replace(starts=b.starts[longer], ends=b.starts[longer] + PREFIX).hashes() ^ np.uint64(PREFIX)
    text, h = np.concatenate([text, text[longer]]), np.concatenate([h, begun])
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    return text[new], h[new]


def shapes(b: Block, words: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Feature matrix of a block's texts, one column per name in SHAPES."""
    n, texts = b.counts(), len(b.offsets) - 1
    safe = np.maximum(n, 1)

    def bytes_in(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind[b.data])])
        return np.diff(total[b.offsets])

    text = np.repeat(np.arange(texts), n)
    h = b.hashes()
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    signed_edge = SIGN[b.data[b.ends - 1]] & (b.ends - b.starts > 2) & SIGN[b.data[np.maximum(b.ends - 2, 0)]]
    of, word = distinct_words(b)
    at = np.minimum(np.searchsorted(words, word), max(len(words) - 1, 0))
    hit = words[at] == word if len(words) else np.zeros(len(word), dtype=bool)
    value = odds[at[hit]] if len(words) else np.zeros(0)
    per = lambda w: np.bincount(of[hit], weights=w, minlength=texts)
    size = np.diff(b.offsets)
    # different words as a power of all words does not depend much on a text's length
    variety = np.bincount(of, minlength=texts) / safe ** 0.8
    return np.stack([
        np.log1p(n), bytes_in(UPPER) / np.maximum(bytes_in(LETTER), 1), bytes_in(SIGN) / np.maximum(size, 1), bytes_in(DIGIT) / np.maximum(size, 1),
        np.minimum((size - bytes_in(_byte <= 32)) / safe, 40.0), variety, np.bincount(text[same], minlength=texts) / safe,
        np.bincount(text[signed_edge], minlength=texts) / safe, np.minimum(per(np.maximum(value, 0)), 20.0), np.maximum(per(np.minimum(value, 0)), -20.0)], axis=1)


def sample_of(labels: DataFrame, good: Column, most: int) -> DataFrame:
    """(l_id, good): at most `most` labelled rows, chosen by a hash of doc_id."""
    usable = labels.select(F.col("doc_id").alias("l_id"), good.alias("good")).where("l_id is not null and good is not null")
    return saved(usable.orderBy(F.xxhash64("l_id", F.lit(29)), "l_id").limit(most), "quality-sample")


def learn_lexicon(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Words (hashes, sorted) whose presence tells good and bad documents apart, at most
    LEXICON of them, with smoothed log-odds. `texts`: text, good."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = batch.column(1).to_numpy(zero_copy_only=False)
            for b in blocks(batch.column(0)):
                text, word = distinct_words(b)
                yield pa.RecordBatch.from_arrays([pa.array(signed(word)), pa.array(good[b.first + text])], ["word", "good"])

    n_good, n_bad = texts.agg(F.count(F.when(F.col("good"), 1)), F.count(F.when(~F.col("good"), 1))).first()
    seen = texts.select("text", "good").mapInArrow(emit, "word long, good boolean").groupBy("word").agg(
        F.count(F.when(F.col("good"), 1)).alias("g"), F.count(F.when(~F.col("good"), 1)).alias("b")).where(F.col("g") + F.col("b") >= MIN_DOCS)
    g, b = F.col("g") + 0.5, F.col("b") + 0.5
    odds = F.log(g / (n_good + 1 - g)) - F.log(b / (n_bad + 1 - b))
    z = odds / F.sqrt(1 / g + 1 / b)
    # the lexicon is bounded by LEXICON rows
    rows = (seen.select("word", odds.alias("odds"), F.abs(z).alias("z")).where((F.col("z") >= MIN_Z) & (F.abs("odds") >= MIN_ODDS))
            .orderBy(F.desc("z"), "word").limit(LEXICON).toPandas())
    words = rows["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], rows["odds"].to_numpy(float)[order]


def fit(docs: DataFrame, labels: DataFrame, good: Column, most: int = SAMPLE) -> Model | None:
    """Logistic regression on at most `most` labelled rows; None unless both kinds occur.

    `docs`: doc_id, text. `good` is a condition on the columns of `labels`."""
    sample = sample_of(labels, good, most)
    # bounded by `most` rows
    half = F.pmod(F.xxhash64("l_id", F.lit(31)), F.lit(2)).alias("half")
    texts = saved(docs.join(F.broadcast(sample), F.col("doc_id") == F.col("l_id")).select("text", "good", half), "quality-texts")
    kinds = {r["good"] for r in texts.select("good").distinct().collect()}
    if len(kinds) < 2:
        return None
    # each half's features come from the other half's lexicon, so that the regression
    # does not trust words more than they deserve
    rows = pd.concat([_features(texts.where(F.col("half") == h), *learn_lexicon(texts.where(F.col("half") != h))) for h in (0, 1)])
    words, odds = learn_lexicon(texts)
    x, y = rows[list(SHAPES)].to_numpy(), rows["good"].to_numpy()
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    return Model(words, odds, mean, scale, _logistic(np.clip((x - mean) / scale, -8, 8), y))


def _features(texts: DataFrame, words: np.ndarray, odds: np.ndarray) -> pd.DataFrame:
    """good and the columns SHAPES of every row of `texts`, a bounded sample."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            for b in blocks(batch.column(0)):
                x = shapes(b, words, odds)
                yield pa.RecordBatch.from_arrays([pa.array(good[b.first:b.first + len(x)])] + [pa.array(c) for c in np.ascontiguousarray(x.T)], ["good", *SHAPES])

    rows = texts.select("text", "good").mapInArrow(emit, "good double, " + ", ".join(f"{s} double" for s in SHAPES))
    return rows.toPandas()


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    """Penalised Newton steps for the weights and a constant."""
    a = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(a.shape[1]), np.full(a.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def row_group(doc_id: Column, host: Column, path: Column, text: Column) -> Column:
    """A hash of what the judgement on a row depends on: rows of one group are judged alike."""
    return F.xxhash64(doc_id.cast("long"), F.lit(0), host.cast("string"), F.lit(1), path.cast("string"), F.lit(2), text)


def evidence(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, host, path, row_group, evidence) for `docs` (doc_id, host, path, row_group,
    text): log-odds of being good by the text alone. Without a model they are 0; a text without words has
    NO_WORDS."""
    if model is None:
        return docs.select("doc_id", "host", "path", "row_group", F.lit(0.0).alias("evidence"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch.column(4)):
                x = np.clip((shapes(b, model.words, model.odds) - model.mean) / model.scale, -8, 8)
                score = np.where(b.counts() > 0, x @ model.weight[:-1] + model.weight[-1], NO_WORDS)
                rows = slice(b.first, b.first + len(score))
                yield pa.RecordBatch.from_arrays([*(batch.column(i)[rows] for i in range(4)), pa.array(np.clip(score, -20, 20))], ["doc_id", "host", "path", "row_group", "evidence"])

    return docs.select("doc_id", "host", "path", "row_group", "text").mapInArrow(emit, "doc_id long, host string, path string, row_group long, evidence double")


def _strength(groups: DataFrame, n: str, mean: str, prior: str, within: float) -> float:
    """Documents that a prior counts for: the variance of documents over that of the
    groups' true means, by the method of moments on (n, mean, prior) of every group."""
    k, total, squares, spread = groups.agg(
        F.count(F.lit(1)), F.sum(n), F.sum(F.col(n) * F.col(n)), F.sum(F.col(n) * (F.col(mean) - F.col(prior)) ** 2)).first()
    room = (total or 0) - (squares or 0) / max(total or 0, 1)
    between = ((spread or 0.0) - max(k - 1, 0) * within) / room if room > 0 else 0.0
    return float(np.clip(within / between, 1.0, 1e6)) if between > 0 else 1e6


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """((host, path, site_n, site_sum, host_post, path_strength) of every path, global mean).

    Site means are of p = 1 / (1 + exp(-evidence)) over all documents; a host's is
    shrunk toward the global mean, a path's toward its host's."""
    p = 1 / (1 + F.exp(-F.col("evidence")))
    paths = saved(scored.select("host", "path", p.alias("p")).groupBy("host", "path").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("s2")), "quality-paths")
    n, s, s2 = paths.agg(F.sum("n"), F.sum("s"), F.sum("s2")).first()
    n, mean = n or 0.0, (s or 0.0) / max(n or 0.0, 1.0)
    within = max((s2 or 0.0) / max(n, 1.0) - mean * mean, 1e-9)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s")).withColumn("m", F.col("host_s") / F.col("host_n"))
    strength = _strength(hosts.withColumn("prior", F.lit(mean)), "host_n", "m", "prior", within)
    hosts = saved(hosts.select(F.col("host").alias("h_host"), ((F.col("host_s") + strength * mean) / (F.col("host_n") + strength)).alias("host_post")), "quality-hosts")
    both = saved(paths.join(hosts, F.col("host").eqNullSafe(F.col("h_host"))).drop("h_host"), "quality-sites")
    inner = _strength(both.withColumn("m", F.col("s") / F.col("n")), "n", "m", "host_post", within)
    return both.select("host", "path", F.col("n").alias("site_n"), F.col("s").alias("site_sum"), "host_post", F.lit(inner).alias("path_strength")), mean


def classify(docs: DataFrame, labels: DataFrame, good: Column, host: Column, path: Column, most: int = SAMPLE) -> DataFrame:
    """doc_id, host, path, row_group, evidence, site_prior, posterior, keep for every document.

    `docs` needs doc_id, text and what `host` and `path` use; `labels` doc_id and what
    the condition `good` uses; other columns are ignored. The posterior log-odds are the
    evidence plus the log-odds of the site's rate against the global one; the site's
    rate leaves the document itself out. `keep` means a posterior of one half or more; one of exactly one half is kept.

    The classifier is fitted on at most `most` labelled rows; all else covers all
    documents. Null texts and texts without words are rejected, if there is a classifier.
    Null hosts or paths are sites of their own. Repeated rows and rows with a null doc_id
    are separate documents; equal ones are judged alike. Without labels of both kinds all
    evidence is 0 and everything is kept, texts without words too. An empty table gives an empty result."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"),
                       row_group(F.col("doc_id"), host, path, F.col("text")).alias("row_group"), "text")
    model = fit(base.select("doc_id", "text"), labels, good, most)
    return posteriors(saved(evidence(base, model), "quality-scored"))


def posteriors(scored: DataFrame) -> DataFrame:
    """The judgement on every row of `scored` (doc_id, host, path, row_group, evidence): its
    evidence and the rate of its site without itself, shrunk toward the host and the whole."""
    sites, mean = site_posteriors(scored)
    s = sites.select(F.col("host").alias("s_host"), F.col("path").alias("s_path"), "site_n", "site_sum", "host_post", "path_strength")
    d = scored.join(s, F.col("host").eqNullSafe(F.col("s_host")) & F.col("path").eqNullSafe(F.col("s_path")))
    own = 1 / (1 + F.exp(-F.col("evidence")))
    rate = (F.col("site_sum") - own + F.col("path_strength") * F.col("host_post")) / (F.col("site_n") - 1 + F.col("path_strength"))
    edge = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    shift = F.log(F.col("site_prior") / (1 - F.col("site_prior"))) - F.log(edge(F.lit(float(mean))) / (1 - edge(F.lit(float(mean)))))
    post = 1 / (1 + F.exp(-(F.col("evidence") + shift)))
    out = d.withColumn("site_prior", edge(rate)).withColumn("posterior", F.when(F.col("evidence") <= NO_WORDS, F.lit(0.0)).otherwise(post))
    return out.select("doc_id", "host", "path", "row_group", "evidence", "site_prior", "posterior", (F.col("posterior") >= 0.5).alias("keep"))
