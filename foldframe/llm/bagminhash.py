"""Near-duplicate classes by BagMinHash.

A document is the multiset of its word shingles. BagMinHash gives each shingle
a Poisson process over (time, weight): its weight axis is cut into the dyadic
strips [0,1), [1,2), [2,4), ... and every strip has points of its own at a rate
equal to its width. A point counts if its level lies below the shingle's count,
and falls to one of m components; a component keeps its earliest point. Two
documents agree in a component with a probability equal to their weighted Jaccard
similarity, sum(min) / sum(max). Points are made in order of time and only up to
the time at which all components have one, so a long text costs little more than
one random number per shingle.

Signatures are cut into bands; documents that share a band are compared by their
whole multisets. A band's documents are compared with its most connected one, not
with each other; an exact rule then finds the pairs that this may leave out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import saved
from .components import connected_components
from .textblocks import Block, blocks, mix64, signed, window_hashes

WORDS = 5
BANDS, ROWS = 20, 4


def shingle_counts(b: Block, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of a block, sorted by text and shingle. A text of
    fewer than `words` words has one shingle, the whole of it; one without words none."""
    h, n = b.hashes(), b.counts()
    at = np.arange(len(h)) - np.repeat(b.word_from[:-1], n)
    left = np.repeat(n, n) - at
    text = np.repeat(np.arange(len(n)), n)
    full = np.flatnonzero(left >= words)
    found = [(text[full], window_hashes(h, words)[full] if len(full) else np.zeros(0, np.uint64))]
    for k in range(1, words):
        short = b.word_from[:-1][n == k]
        if len(short):
            found.append((np.flatnonzero(n == k), mix64(window_hashes(h, k)[short] ^ np.uint64(k))))
    t, s = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((s, t))
    t, s = t[order], s[order]
    new = np.ones(len(t), dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
    first = np.flatnonzero(new)
    return t[first], s[first], np.diff(np.append(first, len(t)))


def _uniform(h: np.ndarray) -> np.ndarray:
    """(0, 1] from the upper bits."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def _strips(text: np.ndarray, shingle: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, key, rate, low, count) of each strip that a shingle's count reaches."""
    parts, j = [], 0
    live = np.arange(len(text))
    while len(live):
        low, width = (0, 1) if j == 0 else (1 << (j - 1), 1 << (j - 1))
        live = live[count[live] > low]
        key = mix64(shingle[live] ^ mix64(np.full(1, j, dtype=np.uint64)))
        parts.append((text[live], key, np.full(len(live), width), np.full(len(live), low), count[live]))
        j += 1
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def bag_minhash(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: int, m: int) -> np.ndarray:
    """Signatures (texts x m, 64-bit point identities) of weighted sets; rows of
    texts without shingles are 0."""
    sig = np.zeros((texts, m), dtype=np.uint64)
    if not len(text):
        return sig
    strips = _strips(text, shingle, count)
    weight = np.bincount(text, weights=count, minlength=texts)
    todo, slack = weight > 0, 2.0
    while todo.any():
        # by this time a process of the whole text's weight has filled all components, most likely
        limit = np.where(todo, m * (np.log(m) + slack) / np.maximum(weight, 1), -1.0)
        on = todo[strips[0]]
        doc, key, rate, low, c = (x[on] for x in strips)
        time = np.zeros(len(doc))
        points, k = [], 0
        while len(doc):
            k += 1
            h = mix64(key + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            time = time - np.log(_uniform(h)) / rate
            ok = time <= limit[doc]
            doc, key, rate, low, c, time, h = (x[ok] for x in (doc, key, rate, low, c, time, h))
            spot = mix64(h)
            level = low + (spot >> np.uint64(32)).astype(np.int64) % rate
            counts = level < c
            component = (spot & np.uint64(0xFFFFFFFF)).astype(np.int64) % m
            points.append(((doc * m + component)[counts], time[counts], mix64(spot)[counts]))
        slot, when, name = (np.concatenate(x) for x in zip(*points, strict=True))
        earliest = np.full(texts * m, np.inf)
        np.minimum.at(earliest, slot, when)
        best = when == earliest[slot]
        filled = np.isfinite(earliest).reshape(texts, m).all(axis=1) & todo
        done = best & filled[slot // m]
        sig.reshape(-1)[slot[done]] = name[done]
        todo &= ~filled
        slack = slack * 2 + 2
    return sig


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """doc_id, digest (of the whole text), n (shingles, repeats counted), bands (one key
    per band; empty for a text without words)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for b in blocks(batch.column(1)):
                texts = len(b.offsets) - 1
                t, s, c = shingle_counts(b, words)
                n = np.bincount(t, weights=c, minlength=texts).astype(np.int64)
                sig = bag_minhash(t, s, c, texts, bands * rows).reshape(texts, bands, rows)
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (texts, bands))
                for r in range(rows):
                    key = mix64(key ^ sig[:, :, r])
                size = np.where(n > 0, bands, 0)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                                                 pa.array(signed(np.ascontiguousarray(key[n > 0])).reshape(-1)))
                body = memoryview(b.data)
                digest = [hashlib.md5(body[x:y]).digest() for x, y in zip(b.offsets[:-1].tolist(), b.offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([ids[b.first:b.first + texts], pa.array(digest, pa.binary()), pa.array(n), lists],
                                                 ["doc_id", "digest", "n", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(emit, "doc_id long, digest binary, n long, bands array<long>")


def compared(pairs: DataFrame, texts: DataFrame, words: int = WORDS) -> DataFrame:
    """Weighted overlap of each pair (a, b): a, b, n_a, n_b, overlap, and the
    shingles that b has beyond a's (`rest`, with `weight`, how often beyond).

    Both texts are fetched by plain joins, so a document in very many pairs is
    split over tasks; texts are compared whole, a batch of pairs at a time."""
    t = texts.select(F.col("doc_id").alias("t_id"), F.col("text"))
    one = (pairs.join(t.hint("shuffle_merge"), F.col("b") == F.col("t_id")).select("a", "b", F.col("text").alias("text_b"))
           .join(t.hint("shuffle_merge"), F.col("a") == F.col("t_id")).select("a", "b", F.col("text").alias("text_a"), "text_b"))

    def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
        b = next(blocks(pa.array([text], pa.large_string())))
        _, s, c = shingle_counts(b, words)
        return s, c

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        # a few pairs at a time: texts may be long
        for part in (batch.slice(at, 128) for batch in batches for at in range(0, batch.num_rows, 128)):
            out = []
            for a, b, x, y in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if last != a:
                    last, held = a, bag(x)
                (s1, c1), (s2, c2) = held, bag(y)
                at = np.minimum(np.searchsorted(s1, s2), len(s1) - 1)
                common = np.where(s1[at] == s2, np.minimum(c1[at], c2), 0)
                out.append((a, b, int(c1.sum()), int(c2.sum()), int(common.sum()), signed(s2[common < c2]), (c2 - common)[common < c2]))
            names = ["a", "b", "n_a", "n_b", "overlap", "rest", "weight"]
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return one.mapInArrow(emit, "a long, b long, n_a long, n_b long, overlap long, rest array<long>, weight array<long>")


def one_text(base: DataFrame, sig: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`base` and `sig` with one row for each doc_id: of several rows the one whose text has
    the smallest digest. Where ids are unique, both are left as they are."""
    several = sig.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.min("digest").alias("first")).where("rows > 1")
    several = saved(several.select(F.col("doc_id").alias("s_id"), "first"), "near-several")
    if several.isEmpty():
        return base, sig
    again = lambda d: d.join(several.hint("shuffle_merge"), F.col("doc_id") == F.col("s_id"))
    alone = lambda d: d.join(several.hint("shuffle_merge"), F.col("doc_id") == F.col("s_id"), "left_anti")
    chosen = again(base).where(F.unhex(F.md5(F.encode("text", "UTF-8"))) == F.col("first"))
    texts = saved(chosen.groupBy("doc_id").agg(F.first("text").alias("text")), "near-texts")
    signs = again(sig).where(F.col("digest") == F.col("first")).drop("s_id", "first")
    signs = signs.groupBy("doc_id", "digest").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))
    return alone(base).unionByName(texts), saved(alone(sig).unionByName(signs.select(*sig.columns)), "near-signs")


def _similar(n_a: Column, n_b: Column, overlap: Column, similarity: float) -> Column:
    """overlap / (n_a + n_b - overlap) >= similarity, without a division."""
    return overlap * (1 + similarity) >= (n_a + n_b) * similarity - 1e-9


def _relabelled(links: DataFrame) -> DataFrame:
    """(c_id, component) of the documents that links join; others are their own."""
    c = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return c.select(F.col("node").alias("c_id"), "component")


def _mixed(stars: DataFrame, component: DataFrame, similarity: float) -> DataFrame:
    """Rows of `stars` whose members are in more than one component, with `label` (the
    component of b) and `linked` (b is similar to the centre a)."""
    label = F.coalesce("component", F.col("b"))
    s = stars.join(component.hint("shuffle_merge"), F.col("b") == F.col("c_id"), "left").withColumn("label", label).drop("c_id", "component")
    mixed = s.groupBy("a").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select(F.col("a").alias("m_a"))
    linked = _similar(F.col("n_a"), F.col("n_b"), F.col("overlap"), similarity)
    return saved(s.join(saved(mixed, "near-mixed").hint("shuffle_merge"), F.col("a") == F.col("m_a"), "left_semi").withColumn("linked", linked), "near-stars")


def _beyond(mixed: DataFrame, similarity: float) -> DataFrame:
    """Where members of one star may meet that are similar for what they share beyond
    its centre c: rows (a, shingle, b, label, n_b, overlap, linked).

    The overlap of two documents is at most the smaller one of their overlaps with c
    plus the weight that they share beyond c. A similar partner needs an overlap of at
    least `similarity` times a document's own size, so they share at least r = that
    size less the overlap with c (pairs that need nothing beyond c are left to
    `_by_size`). In one order of all shingles, rarest first, two such documents then meet
    in the shingles that come before the last r of weight. Shingles that only one
    component has, and all but one of those that the same documents have, are left out."""
    beyond = mixed.select("a", "b", "label", "n_b", "overlap", "linked",
                          F.greatest(F.ceil(F.col("n_b") * similarity - 1e-6) - F.col("overlap"), F.lit(1)).alias("r"),
                          F.explode(F.arrays_zip("rest", "weight")).alias("x"))
    beyond = beyond.select("*", F.col("x.rest").alias("shingle"), F.col("x.weight").alias("weight")).drop("x")
    often = saved(beyond.groupBy("a", "shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
                  .select(F.col("a").alias("o_a"), F.col("shingle").alias("o_shingle"), "often"), "near-often")
    ranked = beyond.join(often.hint("shuffle_merge"), (F.col("a") == F.col("o_a")) & (F.col("shingle") == F.col("o_shingle")), "left")
    order = Window.partitionBy("a", "b").orderBy(F.coalesce("often", F.lit(1)).desc(), F.col("shingle").desc())
    behind = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    each = saved(ranked.withColumn("behind", behind).where((F.col("behind") >= F.col("r")) & (F.col("often") > 1))
                 .select("a", "shingle", "b", "label", "n_b", "overlap", "linked"), "near-beyond")
    h = F.xxhash64("b")
    meet = (each.groupBy("a", "shingle").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"),
                                             F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64(h)).alias("y"))
            .where("lo < hi").groupBy("a", "n", "x", "y").agg(F.min("shingle").alias("shingle")))
    meet = saved(meet.select(F.col("a").alias("k_a"), F.col("shingle").alias("k_shingle")), "near-meet")
    return saved(each.join(meet.hint("shuffle_merge"), (F.col("a") == F.col("k_a")) & (F.col("shingle") == F.col("k_shingle")), "left_semi"), "near-meeting")


def _pairs_left(meeting: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of documents that meet and are in different components, at least one
    of them not similar to the star's centre, and whose sizes and overlaps with it allow
    the similarity: all that a comparison with centres may have left out."""
    f = similarity / (1 + similarity)
    need = (F.col("n_b") + F.col("x_n")) * f - 1e-9
    x = meeting.where("not linked").select(F.col("a").alias("x_a"), F.col("shingle").alias("x_shingle"), F.col("b").alias("x"),
                                           F.col("n_b").alias("x_n"), F.col("overlap").alias("x_o"), F.col("label").alias("x_l"))
    most = F.least("overlap", "x_o") + F.least(F.col("n_b") - F.col("overlap"), F.col("x_n") - F.col("x_o"))
    once = F.col("linked") | (F.col("x") < F.col("b"))
    return (meeting.join(x.hint("shuffle_merge"), (F.col("a") == F.col("x_a")) & (F.col("shingle") == F.col("x_shingle")) & once
                         & (F.col("x") != F.col("b")) & (F.col("x_l") != F.col("label")) & (F.least("n_b", "x_n", most) >= need))
            .select(F.least("b", "x").alias("a"), F.greatest("b", "x").alias("b")).distinct())


def size_class(n: Column) -> Column:
    """Sizes in steps of a thousandth; below a thousand every size is a class."""
    steps = F.floor(F.log(n / F.lit(1000.0)) / F.log(F.lit(1.001)) + 1e-9)
    return F.when(n < 1000, n.cast("long")).otherwise(F.lit(1000) + steps)


def _by_size(mixed: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of one star that can be similar although they share nothing beyond
    the centre: in different components, one of them not similar to the centre, and both
    overlaps with the centre as large as their sizes ask for. They meet by equal keys,
    (centre, class of size): the sizes of its partners lie between a document's own size
    times the similarity and what its overlap with the centre allows, which are at most
    some 600 classes however long the text is."""
    f = similarity / (1 + similarity)
    need = (F.col("n_b") + F.col("x_n")) * f - 1e-9
    most = F.floor(F.col("overlap") / f - F.col("n_b") + 1e-6)
    least = F.greatest(F.ceil(F.col("n_b") * similarity - 1e-6), F.lit(1))
    seek = (mixed.where(~F.col("linked")).withColumns({"most": most, "least": least}).where("most >= least")
            .withColumn("size", F.explode(F.sequence(size_class(F.col("least")), size_class(F.col("most"))))))
    x = seek.select(F.col("a").alias("x_a"), F.col("size").alias("x_size"), "least", "most", F.col("b").alias("x"), F.col("n_b").alias("x_n"),
                    F.col("overlap").alias("x_o"), F.col("label").alias("x_l"))
    offer = mixed.select("a", "b", "n_b", "overlap", "label", size_class(F.col("n_b")).alias("size"))
    return (offer.join(x.hint("shuffle_merge"), (F.col("a") == F.col("x_a")) & (F.col("size") == F.col("x_size")) & F.col("n_b").between(F.col("least"), F.col("most"))
                       & (F.col("x") != F.col("b")) & (F.col("x_l") != F.col("label")) & (F.least("overlap", "x_o") >= need))
            .select(F.least("b", "x").alias("a"), F.greatest("b", "x").alias("b")).distinct())


def near_duplicates(docs: DataFrame, similarity: float = 0.8, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """Class of every document: doc_id, class_id (smallest doc_id of the class), n_shingles.

    Documents are linked if the weighted Jaccard similarity of their multisets of
    `words`-word shingles is at least `similarity`, and classes are the connected
    components; a pair with similarity s meets in a band with a probability of
    1 - (1 - s**rows)**bands (0.99997 at 0.8 as set). Exact copies are put together
    first and only their smallest doc_id is compared.

    `docs` needs doc_id and text; other columns are ignored. Null texts and texts
    without words are classes of their own. Shorter texts than `words` words count as
    one shingle. Repeated rows come out repeated and are compared once; a doc_id with
    different texts stands for the one with the smallest MD5 digest, whose class all its
    rows get; rows with a null doc_id have a null class. An empty table gives an empty
    result."""
    every = saved(signatures(docs.select("doc_id", "text"), bands, rows, words), "near-signatures")
    base, sig = one_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), every)
    copies = saved(sig.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"))
                   .select(F.col("digest").alias("r_digest"), "rep"), "near-copies")
    member = saved(sig.join(copies.hint("shuffle_merge"), (F.col("digest") == F.col("r_digest")) & (F.col("n") > 0), "left")
                   .select("doc_id", F.coalesce("rep", "doc_id").alias("rep"), "n", "bands"), "near-members")

    # one row per distinct text and band; bands held by one text alone end here
    reps = member.where("doc_id = rep and n > 0").dropDuplicates(["doc_id"])
    band = reps.select("doc_id", "n", F.posexplode("bands").alias("band", "key"))
    size = saved(band.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
                 .select(F.col("band").alias("s_band"), F.col("key").alias("s_key"), "size"), "near-sizes")
    on = (F.col("band") == F.col("s_band")) & (F.col("key") == F.col("s_key"))
    full = saved(band.join(size.hint("shuffle_merge"), on).select("doc_id", "n", "band", "key", "size"), "near-bands")
    # the centre of a band is the text that shares its bands with most others
    fame = saved(full.groupBy("doc_id").agg(F.sum("size").alias("fame")).select(F.col("doc_id").alias("f_id"), "fame"), "near-fame")
    famed = full.join(fame.hint("shuffle_merge"), F.col("doc_id") == F.col("f_id"))
    centre = saved(famed.groupBy("band", "key").agg(F.max(F.struct("fame", (-F.col("doc_id")).alias("neg"))).alias("c"))
                   .select(F.col("band").alias("s_band"), F.col("key").alias("s_key"), (-F.col("c.neg")).alias("a")), "near-centres")
    pairs = saved(full.join(centre.hint("shuffle_merge"), on).where("doc_id != a").select("a", F.col("doc_id").alias("b")).distinct(), "near-pairs")

    linked = _similar(F.col("n_a"), F.col("n_b"), F.col("overlap"), similarity)
    first = saved(compared(pairs, base, words), "near-compared")
    links = first.where(linked).select("a", "b")
    component = saved(_relabelled(links), "near-components")
    mixed = _mixed(first, component, similarity)
    pairs = saved(_pairs_left(_beyond(mixed, similarity), similarity).unionByName(_by_size(mixed, similarity)).distinct(), "near-pairs")
    if not pairs.isEmpty():
        links = links.unionByName(compared(pairs, base, words).where(linked).select("a", "b"))
        component = saved(_relabelled(links), "near-components")
    out = member.join(component.hint("shuffle_merge"), F.col("rep") == F.col("c_id"), "left")
    out = out.select("doc_id", F.coalesce("component", "rep").alias("class_id"), F.col("n").alias("n_shingles"))
    if sig is every:
        return out
    # each row of a repeated id gets the id's class, and its own count of shingles
    of = out.select(F.col("doc_id").alias("o_id"), "class_id").where("o_id is not null")
    return every.select("doc_id", "n").join(of.hint("shuffle_merge"), F.col("doc_id") == F.col("o_id"), "left").select("doc_id", "class_id", F.col("n").alias("n_shingles"))


def one_of_each(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """`docs` with one document of each near-duplicate class, the one with the
    smallest doc_id; all columns are kept. All rows of a kept doc_id, also those with
    another text, and rows with a null doc_id stay."""
    classes = near_duplicates(docs, similarity).where("doc_id = class_id").select(F.col("doc_id").alias("keep_id")).distinct()
    known = docs.join(classes.hint("shuffle_merge"), docs["doc_id"] == F.col("keep_id"), "left_semi")
    return known.unionByName(docs.where("doc_id is null"))
