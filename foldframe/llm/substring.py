"""Repeated passages by difference-cover anchors.

Two equal passages may start anywhere in their documents. A difference cover D
of the period v has, for any shift, two members that differ by it; so if windows
of w words are hashed only where the position modulo v lies in D, any common
passage of w + v - 1 words holds a window that is hashed in both documents.
Documents meet on these anchors, then the match is extended word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import saved
from .textblocks import blocks, signed, window_hashes

PERIOD = 31
# perfect difference set modulo 31
COVER = (0, 1, 3, 8, 12, 18)


def is_cover(cover: tuple[int, ...], period: int) -> bool:
    """Whether every residue is a difference of two members."""
    return len({(a - b) % period for a in cover for b in cover}) == period


def anchor_width(window: int) -> int:
    if window < PERIOD:
        raise ValueError(f"a window needs at least {PERIOD} words")
    return window - PERIOD + 1


def anchors(docs: DataFrame, window: int) -> DataFrame:
    """(h, doc_id, pos): hash of the anchor at each cover position of every text
    that has at least `window` words."""
    width = anchor_width(window)
    on = np.zeros(PERIOD, dtype=bool)
    on[list(COVER)] = True

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for b in blocks(batch.column(1)):
                n = b.counts()
                pos = np.arange(len(b.starts)) - np.repeat(b.word_from[:-1], n)
                size = np.repeat(n, n)
                at = np.flatnonzero(on[pos % PERIOD] & (pos + width <= size) & (size >= window))
                if not len(at):
                    continue
                h = window_hashes(b.hashes(), width)
                row = np.repeat(np.arange(len(n)), n)[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(h)[at]), pa.array(ids[b.first + row]), pa.array(pos[at].astype(np.int32))], ["h", "doc_id", "pos"])

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(emit, "h long, doc_id long, pos int")


def shared_anchors(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, hits: of each document the anchors that another one has too, with the
    smallest document that has them and the place there. One row per document."""
    found = anchors(docs, window)
    first = F.min(F.struct("doc_id", "pos"))
    # a passage in very many documents is reduced in the map tasks to one row each
    least = (found.groupBy("h").agg(first.alias("first"), F.max("doc_id").alias("last"))
             .where(F.col("first.doc_id") < F.col("last"))
             .select(F.col("h").alias("s_h"), F.col("first.doc_id").alias("least"), F.col("first.pos").alias("least_pos")))
    # written first, so that the join reads two plain shuffles: Spark then splits
    # the rows of a very common anchor
    hit = found.join(saved(least, "repeat-anchors").hint("shuffle_merge"), F.col("h") == F.col("s_h"))
    return hit.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "least", "least_pos")).alias("hits"))


def _spread(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Mask of length n that is set from each lo to its hi, inclusive."""
    lo, hi = np.clip(lo, 0, n), np.clip(hi + 1, 0, n)
    ok = lo < hi
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, lo[ok], 1)
    np.add.at(step, hi[ok], -1)
    return np.cumsum(step[:-1]) > 0


def judged_windows(doc: int, n_words: int, hits: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Masks over the windows of a document (index = first word): those that a
    smaller document is sure to have, those to ask about, those to tell others.

    `hits`: rows (pos, least, least_pos). Anchors that follow each other at the
    same shift from one smaller document, without a gap between them, cover a
    stretch of words equal to its own; windows inside are sure. Other windows
    with an anchor of a smaller document are asked about by their whole hash."""
    width = anchor_width(window)
    n = n_words - window + 1
    pos, least, there = hits[:, 0], hits[:, 1], hits[:, 2]
    known = _spread(n, pos - (window - width), pos)
    older = least < doc
    asked = _spread(n, pos[older] - (window - width), pos[older])
    sure = np.zeros(n, dtype=bool)
    if older.any():
        p, l, s = pos[older], least[older], (pos - there)[older]
        order = np.lexsort((p, s, l))
        p, l, s = p[order], l[order], s[order]
        new = np.ones(len(p), dtype=bool)
        new[1:] = (l[1:] != l[:-1]) | (s[1:] != s[:-1]) | (p[1:] - p[:-1] > width)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(p)) - 1
        sure = _spread(n, p[begin], p[end] + width - window)
    return sure, asked & ~sure, known & ~sure


def _hit_rows(column: pa.Array, row: int) -> np.ndarray:
    """Rows (pos, least, least_pos) of one document."""
    s = column[row].values
    return np.stack([s.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)


def open_windows(docs_with_hits: DataFrame, window: int) -> DataFrame:
    """(h, doc_id, pos, asks): windows with a shared anchor that the anchors alone don't settle."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hits = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for b in blocks(batch.column(1)):
                h = signed(window_hashes(b.hashes(), window))
                out: list[tuple] = []
                for i, n in enumerate(b.counts().tolist()):
                    if n < window:
                        continue
                    doc = int(ids[b.first + i])
                    _, asks, tells = judged_windows(doc, n, _hit_rows(hits, b.first + i), window)
                    at = np.flatnonzero(tells | asks)
                    out.append((h[b.word_from[i] + at], np.full(len(at), doc), at.astype(np.int32), asks[at]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["h", "doc_id", "pos", "asks"])

    return docs_with_hits.mapInArrow(emit, "h long, doc_id long, pos int, asks boolean")


def remove_repeats(docs: DataFrame, window: int = 50, keep_text: bool = True) -> DataFrame:
    """Every document without the words that repeat a passage of a smaller one.

    A word goes if a window of `window` consecutive words covers it whose word
    sequence also starts in a document with a smaller doc_id; windows are judged on
    the input. Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words
    joined by one space, lowercase hex) and, with `keep_text`, kept_text.

    `docs` needs doc_id and text; other columns are ignored. A null or empty text
    has no words. Texts of fewer than `window` words are never touched. A doc_id
    identifies a text; repeated rows of one document are judged alike, none for the
    other's sake. Rows with a null doc_id are left as they are. Equality is that of
    64-bit hashes. An empty table gives an empty result."""
    if not is_cover(COVER, PERIOD):
        raise ValueError("COVER must be a difference cover of PERIOD")
    base = docs.select("doc_id", "text")
    hits = saved(shared_anchors(base, window), "repeat-hits")
    h = hits.select(F.col("doc_id").alias("h_id"), "hits")
    texts = base.join(h.hint("shuffle_merge"), F.col("doc_id") == F.col("h_id"), "left").drop("h_id")
    windows = saved(open_windows(texts.where("hits is not null"), window), "repeat-windows")
    least = saved(windows.groupBy("h").agg(F.min("doc_id").alias("least")).select(F.col("h").alias("s_h"), "least"), "repeat-least")
    old = (windows.where("asks").join(least.hint("shuffle_merge"), (F.col("h") == F.col("s_h")) & (F.col("least") < F.col("doc_id")))
           .groupBy("doc_id").agg(F.collect_set("pos").alias("old")).select(F.col("doc_id").alias("o_id"), "old"))
    joined = texts.join(old.hint("shuffle_merge"), F.col("doc_id") == F.col("o_id"), "left").select("doc_id", "text", "hits", "old")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hits, old = batch.column(0), batch.column(2), batch.column(3)
            rows: list[tuple] = []
            held = 0
            for i, text in enumerate(batch.column(1)):
                words = (text.as_py() or "").encode().split()
                n, removed = len(words), 0
                if n >= window and hits[i].is_valid:
                    sure, _, _ = judged_windows(ids[i].as_py(), n, _hit_rows(hits, i), window)
                    if old[i].is_valid:
                        at = old[i].values.to_numpy(zero_copy_only=False)
                        sure[at[at < len(sure)]] = True
                    first = np.flatnonzero(sure)
                    gone = _spread(n, first, first + window - 1)
                    removed = int(gone.sum())
                    if removed:
                        words = list(compress(words, (~gone).tolist()))
                kept = b" ".join(words)
                rows.append((ids[i].as_py(), n, removed, hashlib.sha256(kept).hexdigest()) + ((kept.decode(),) if keep_text else ()))
                held += len(kept) * keep_text
                if held > 1 << 24:
                    yield _batch(rows, keep_text)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, keep_text)

    return joined.mapInArrow(cut, schema)


def _batch(rows: list[tuple], keep_text: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.string()] * keep_text
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * keep_text
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
