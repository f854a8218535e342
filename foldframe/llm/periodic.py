"""Periodic runs of words by scale-tiled distribution.

A run is a stretch of words that repeats itself with a period. Periods are dealt with by
octave, [B, 2B) with B = 8, 16, 32, ... (the first octave also has the shorter ones). In
an octave every B-th word of a document is a boundary, and a run of at least three
periods lies over one or more of them. Two Z-functions at a boundary c tell for all
periods p of the octave how far w[c:] agrees with w[c + p:] and how far, backwards,
w[:c] agrees with w[:c + p]: together one fragment of a run of period p.

A document is exploded into overlapping tiles of some boundaries each, so a long one is
solved by many tasks. A tile sees 2B words to the left of its boundaries and 4B to the
right, and agreement is followed for 2B words; fragments of one run from adjacent
boundaries then overlap by at least its period. They are shuffled by document and period
and stitched by their overlap: two intervals of period p that share p words are one.

A boundary with no equal word window ahead in its octave can't lie in a run, and tiles
without any other boundary are not made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import saved
from .textblocks import Block, blocks, window_hashes

# words that must agree ahead of a boundary; also the first octave's step
AHEAD = 8
LEAST_WORDS, LEAST_PERIODS = 24, 3
# boundaries of a tile: at least so many, and as many as make so many words
TILE_BOUNDARIES, TILE_WORDS = 8, 1024

TILE = pa.struct([("step", pa.int32()), ("first", pa.int32()), ("words", pa.int32()), ("at", pa.list_(pa.int32())), ("ids", pa.list_(pa.int32()))])


def joined(b: Block, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words of a block that `keep` marks, those of one text joined by one
    space, and where each text starts in them."""
    at = np.flatnonzero(keep)
    text = np.searchsorted(b.word_from, at, side="right") - 1
    edge = np.zeros(len(b.data) + 1, dtype=np.int8)
    edge[b.starts[at]] = 1
    np.add.at(edge, b.ends[at], -1)
    mark = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    gap = b.ends[at[:-1][text[1:] == text[:-1]]]
    data = b.data.copy()
    data[gap], mark[gap] = 32, True
    return data[mark], np.concatenate([[0], np.cumsum(mark)])[b.offsets]


def boundaries(b: Block, h: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text, step, boundaries in it) that have an equal window of AHEAD words ahead, at
    the distance of a period of the step's octave."""
    n = b.counts()
    same = window_hashes(h, AHEAD)
    step = AHEAD
    while (n >= LEAST_PERIODS * step).any():
        long = np.flatnonzero(n >= LEAST_PERIODS * step)
        size = n[long] - AHEAD + 1  # windows that lie in the text
        text = np.repeat(long, size)
        i = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        start = b.word_from[text]
        here = same[start + i]
        for back in (0, 1) if step == AHEAD else (1,):
            c = (i // step - back) * step
            ok = (c >= 0) & (c < i)
            ok[ok] = same[(start + c)[ok]] == here[ok]
            found = np.unique(text[ok].astype(np.int64) << 40 | c[ok])
            if back == 0:
                first = found
        if step == AHEAD:
            found = np.union1d(first, found)
        owner = found >> 40
        for part in np.split(found, np.flatnonzero(np.diff(owner)) + 1):
            if len(part):
                yield int(part[0] >> 40), step, part & (1 << 40) - 1
        step *= 2


def tiles_of(h: np.ndarray, step: int, at: np.ndarray) -> Iterator[dict]:
    """Tiles over the boundaries `at` of one text with word hashes `h`."""
    many = max(TILE_BOUNDARIES, TILE_WORDS // step)
    for part in np.split(at, np.flatnonzero(np.diff(at // (step * many))) + 1):
        first = max(0, int(part[0]) - 2 * step)
        ids = np.unique(h[first:int(part[-1]) + 4 * step], return_inverse=True)[1].astype(np.int32)
        yield {"step": step, "first": first, "words": len(h), "at": part.astype(np.int32), "ids": ids}


def exploded(docs: DataFrame, keep_text: bool) -> DataFrame:
    """key (one per row), doc_id, n_words, plain_sha256 (of all words), words (joined by
    one space) and tiles; without `keep_text`, words is null where there are no tiles."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch.column(2)):
                h, texts = b.hashes(), len(b.offsets) - 1
                tiles: list[list[dict]] = [[] for _ in range(texts)]
                for t, step, at in boundaries(b, h):
                    tiles[t] += tiles_of(h[b.word_from[t]:b.word_from[t + 1]], step, at)
                data, where = joined(b, np.ones(len(b.starts), dtype=bool))
                parts = [data[x:y].tobytes() for x, y in zip(where[:-1], where[1:], strict=True)]
                own = slice(b.first, b.first + texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[own], batch.column(1)[own], pa.array(b.counts(), pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in parts]),
                     pa.array([x.decode() if t or keep_text else None for x, t in zip(parts, tiles, strict=True)], pa.string()),
                     pa.array(tiles, pa.list_(TILE))], ["key", "doc_id", "n_words", "plain_sha256", "words", "tiles"])

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return keyed.mapInArrow(emit, "key long, doc_id long, n_words long, plain_sha256 string, words string, "
                                  "tiles array<struct<step int, first int, words int, at array<int>, ids array<int>>>")


def z_function(s: list[int], upto: int) -> list[int]:
    """For i < upto, how many items s[i:] and s agree in (0 for i = 0)."""
    n, z, left, right = len(s), [0] * upto, 0, 0
    for i in range(1, upto):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


@cache
def prime_factors(n: int) -> list[int]:
    found, d = [], 2
    while d * d <= n:
        if n % d == 0:
            found.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return found + [n] * (n > 1)


def fragments(step: int, first: int, words: int, at: list[int], ids: list[int]) -> list[tuple[int, int, int]]:
    """(period, start, end) of the parts of runs around the boundaries `at` of one tile;
    those of one run that meet in the tile are put together."""
    found: dict[int, list[list[int]]] = {}
    low = 1 if step == AHEAD else step
    for c in (x - first for x in at):
        left, right = max(0, c - 2 * step), min(len(ids), c + 2 * step)
        ahead = z_function(ids[c:c + 4 * step], min(2 * step, len(ids) - c))
        periods = [p for p in range(low, len(ahead)) if ahead[p] >= AHEAD]
        # a period whose first words are a power of fewer words is not the smallest
        periods = [p for p in periods if not any(ahead[p // f] >= p - p // f for f in prime_factors(p))]
        if not periods:
            continue
        own, text = ids[left:c][::-1], ids[left:right][::-1]
        back = z_function([*own, -1, *text], len(own) + 1 + right - c - periods[0] + 1)
        for p in periods:
            forth, behind = min(ahead[p], 2 * step), back[len(own) + 1 + right - c - p]
            clipped = forth == 2 * step or behind == 2 * step
            if forth + behind < (p if clipped else max((LEAST_PERIODS - 1) * p, LEAST_WORDS - p)):
                continue
            a, e = c - behind + first, c + p + forth + first
            of_p = found.setdefault(p, [])
            if of_p and a <= of_p[-1][1] - p:
                of_p[-1][1] = max(e, of_p[-1][1])
            else:
                of_p.append([a, e])
    return [(p, a, e) for p, parts in found.items() for a, e in parts]


def solved(tiles: DataFrame) -> DataFrame:
    """(key, period, start, stop) of the fragments in `tiles` (key, tile)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                out += [(key, *x) for x in fragments(*t.as_py().values())]
            cols = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["key", "period", "start", "stop"])

    return tiles.select("key", "tile").mapInArrow(emit, "key long, period long, start long, stop long")


def stitched(parts: DataFrame) -> DataFrame:
    """(key, runs) from fragments: for each document its runs (start, stop, period) in
    order. Fragments of one period that overlap by at least the period are one run."""
    w = Window.partitionBy("key", "period").orderBy("start", "stop")
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = (reach.isNull() | (F.col("start") > reach - F.col("period"))).cast("int")
    runs = (parts.withColumn("new", new).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .groupBy("key", "period", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
            .where(F.col("stop") - F.col("start") >= F.greatest(F.lit(LEAST_WORDS), F.col("period") * LEAST_PERIODS)))
    return runs.groupBy(F.col("key").alias("r_key")).agg(F.sort_array(F.collect_list(F.struct("start", "period", "stop"))).alias("runs"))


RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string, n_words long, n_dropped long")


def described(found: DataFrame, keep_text: bool) -> DataFrame:
    """The result's rows of documents (doc_id, n_words, words, runs)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lists = batch.column(2).to_pylist()
            ids, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for b in blocks(batch.column(3)):
                keep = np.ones(len(b.starts), dtype=bool)
                texts = len(b.offsets) - 1
                for t in range(texts):
                    for r in lists[b.first + t] or []:
                        keep[b.word_from[t] + r["start"] + r["period"]:b.word_from[t] + r["stop"]] = False
                data, where = joined(b, keep)
                left = np.diff(np.concatenate([[0], np.cumsum(keep)])[b.word_from])
                for t in range(texts):
                    runs, body = lists[b.first + t] or [], data[where[t]:where[t + 1]].tobytes()
                    best = None
                    for r in runs:  # in order of start and period, so that the first of equal ones stays
                        size = r["stop"] - r["start"]
                        if best is None or size * best[2] > best[1] * r["period"]:
                            best = (r["start"], size, r["period"])
                    listed = "".join(f"{r['start']},{r['stop'] - r['start']},{r['period']}\n" for r in runs)
                    out.append((ids[b.first + t], len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                                hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(body).hexdigest(), counts[b.first + t],
                                counts[b.first + t] - int(left[t]), *([body.decode(), runs] if keep_text else [])))
            yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in out], schema=schema)

    names = [x.split()[0] for x in RESULT.split(", ")] + ["text", "runs"] * keep_text
    run = pa.struct([("start", pa.int64()), ("period", pa.int64()), ("stop", pa.int64())])
    schema = pa.schema([(n, pa.string() if n.endswith("256") or n == "text" else pa.list_(run) if n == "runs" else pa.int64()) for n in names])
    more = ", text string, runs array<struct<start bigint, period bigint, stop bigint>>" if keep_text else ""
    return found.select("doc_id", "n_words", "runs", "words").mapInArrow(emit, RESULT + more)


def periodic_runs(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Runs of every document, and the document with each run collapsed to one period.

    A run is a stretch of consecutive words with smallest period q (words q apart are
    equal) of at least max(24, 3 q) words that cannot be extended. Returns per row of
    `docs`: doc_id, n_runs; start (word number), length, period and exponent_milli of the
    run with the greatest length / period (equal ones: smallest start, then period; null
    without a run); runs_sha256 of all runs' `start,length,period` lines; collapsed_sha256
    of the words that are not in a run behind its first period, joined by one space;
    n_words, n_dropped; with `keep_text` also that collapsed text and the runs.

    `docs` needs doc_id and text; other columns are ignored. A null or empty text has no
    words and no runs. Repeated rows and null ids come out as they are, one row each. An
    empty table gives an empty result. Long texts are split into tiles over many tasks.
    Words are compared by 64-bit hashes."""
    texts = saved(exploded(docs, keep_text), "runs-texts")
    has = F.size("tiles") > 0
    tiles = texts.where(has).select("key", F.posexplode("tiles").alias("number", "tile"))
    # a long document's tiles go to many tasks
    parts = saved(solved(tiles.repartition(F.col("key"), F.col("number"))), "runs-parts")
    runs = stitched(parts)
    one = texts.where(has).select("key", "doc_id", "n_words", "words")
    found = described(one.join(runs.hint("shuffle_merge"), F.col("key") == F.col("r_key"), "left"), keep_text)
    empty = [F.col("words").alias("text"), F.lit(None).cast("array<struct<start:bigint,period:bigint,stop:bigint>>").alias("runs")]
    none = texts.where(~has).select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), *[F.lit(None).cast("long").alias(c) for c in ("start", "length", "period", "exponent_milli")],
        F.sha2(F.lit("").cast("binary"), 256).alias("runs_sha256"), F.col("plain_sha256").alias("collapsed_sha256"), "n_words",
        F.lit(0).cast("long").alias("n_dropped"), *(empty if keep_text else []))
    return none.unionByName(found)
