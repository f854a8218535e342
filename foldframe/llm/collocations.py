"""Phrase collocations by vertical partitioning of a suffix tree, built in parts.

Every word starts a suffix; of each only the first `longest` words count, so the tree is
cut at that depth. The tree of a corpus does not fit one machine. It is cut into subtrees
under word prefixes: a prefix that holds more leaves than the memory budget is extended by
a word, small ones are put together up to the budget, and every such group of prefixes is
a subtree that one task builds on its own. The totals of a node's leaves are the
occurrences of its phrase.

Leaves that can't reach a frequent node are not made: a suffix ends before a word, a pair
or three words that are not frequent. Which ones are is told by bit maps of fixed size,
filled from hashed counts, that may let through too much but never too little.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import saved
from .textblocks import Block, blocks, mix64, signed

# bytes that end a piece, and those between the words of one
BREAK = np.zeros(256, dtype=bool)
BREAK[[10, 11, 12, 13, *b".,;:!?"]] = True
BETWEEN = BREAK.copy()
BETWEEN[[9, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NO_LANG = "und"
# rows that a task gives out at once
GIVEN = 1 << 16


class Settings(NamedTuple):
    """A phrase needs `least` occurrences and 2 to `longest` words. Bit maps have
    2**filter_bits bits; there is one for phrases of each length up to `mapped`. A tree holds about `budget` leaves, on small tables no less than
    `least_share`; prefixes are told apart in `units` hash units, and a unit above the
    budget by `fan` units of the next word; up to `listed` such units are named in the
    plan. A task holds no more than about `buffer` different leaves."""
    least: int = 100
    longest: int = 5
    filter_bits: int = 26
    mapped: int = 3
    budget: int = 1 << 18
    least_share: int = 1024
    listed: int = 10_000
    units: int = 4096
    fan: int = 64
    buffer: int = 1 << 20


class Words(NamedTuple):
    ids: np.ndarray  # a 64-bit hash of language and word, never 0
    follows: np.ndarray  # whether a word is followed by another one in its piece
    lang: np.ndarray  # language of each word, as an index
    block: Block  # the words in lower case


def words_of(texts: pa.Array, langs: list[str | None]) -> Iterator[tuple[Words, list[str]]]:
    """The words of a batch by blocks, and the languages that their indexes mean."""
    names = sorted({x or NO_LANG if x is None else x for x in langs})
    number = {x: k for k, x in enumerate(names)}
    salt = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names], dtype=np.uint64)
    own = np.array([number[NO_LANG if x is None else x] for x in langs], dtype=np.int64)
    for b in blocks(texts, BETWEEN):
        b = b._replace(data=LOWER[b.data])
        n = b.counts()
        text = np.repeat(np.arange(len(n)), n)
        lang = own[b.first + text]
        ids = mix64(b.hashes() ^ salt[lang]) if len(text) else np.zeros(0, np.uint64)
        ids[ids == 0] = 1
        piece = np.cumsum(BREAK[b.data])[b.starts] if len(text) else np.zeros(0, np.int64)
        follows = np.zeros(len(ids), dtype=bool)
        follows[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        yield Words(ids, follows, lang, b), names


def spelled(b: Block, at: np.ndarray) -> pa.Array:
    """The words at `at` as strings."""
    size = b.ends[at] - b.starts[at]
    offsets = np.concatenate([[0], np.cumsum(size)])
    take = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - b.starts[at], size)
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(b.data[take])).cast(pa.string())


def word_counts(docs: DataFrame) -> DataFrame:
    """(id, lang, word, n) of all words; rows without an id have a language's words in all."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, names in words_of(batch.column(0), batch.column(1).to_pylist()):
                ids, at, n = np.unique(w.ids, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(ids)), pa.array(names, pa.string()).take(pa.array(w.lang[at])), spelled(w.block, at), pa.array(n)],
                                                 ["id", "lang", "word", "n"])
                whole = np.bincount(w.lang, minlength=len(names))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(names), pa.int64()), pa.array(names, pa.string()), pa.nulls(len(names), pa.string()), pa.array(whole)],
                                                 ["id", "lang", "word", "n"])

    rows = docs.select("text", "lang").mapInArrow(emit, "id long, lang string, word string, n long")
    return rows.groupBy("id", "lang").agg(F.any_value("word").alias("word"), F.sum("n").alias("n"))


def bit_map(counts: DataFrame, least: int, bits: int) -> np.ndarray:
    """From (bucket, n), the buckets of at least `least` as 2**bits bits: at most
    2**(bits - 6) rows, a bound set by a parameter, come to the driver."""
    full = counts.groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    one = F.expr("shiftleft(1L, cast(bucket & 63 AS int))")
    rows = full.groupBy(F.shiftright("bucket", 6).alias("at")).agg(F.bit_or(one).alias("bits")).toPandas()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[rows["at"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def bucket_of(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def inside(found: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return (found[bucket >> 6] >> (bucket & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def frequent_at(w: Words, maps: list[np.ndarray], bits: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a phrase of `length` words starts whose shorter parts may all be
    frequent by `maps` (of single words, pairs, ...), and the phrases' hashes."""
    ok = inside(maps[0], bucket_of(w.ids, bits))
    at, h = np.flatnonzero(ok), w.ids[ok]
    for k in range(2, length + 1):
        shorter = np.zeros(len(w.ids) + 1, dtype=bool)
        shorter[at] = True
        # the phrase without its last word and without its first one start here and one on
        both = w.follows[at + k - 2] & shorter[at + 1]
        h = mix64(h[both] * np.uint64(3) + w.ids[at[both] + k - 1])
        at = at[both]
        if k < length:
            known = inside(maps[k - 1], bucket_of(h, bits))
            at, h = at[known], h[known]
    return at, h


def phrase_buckets(docs: DataFrame, maps: list[np.ndarray], length: int, s: Settings) -> DataFrame:
    """(bucket, n) of the phrases of `length` words whose parts may be frequent."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (bucket_of(frequent_at(w, maps, s.filter_bits, length)[1], s.filter_bits)
                 for batch in batches for w, _ in words_of(batch.column(0), batch.column(1).to_pylist()))
        for bucket, n in summed(found, s.buffer):
            yield from given({"bucket": bucket, "n": n})

    def counted(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        x = np.concatenate(held)
        held.clear()
        x.sort()
        first = firsts(x)
        return x[first], np.diff(first, append=len(x))

    def summed(parts: Iterator[np.ndarray], buffer: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held, size = [], 0
        for x in parts:
            held.append(x)
            size += len(x)
            if size >= 4 * buffer:
                yield counted(held)
                size = 0
        if size:
            yield counted(held)

    return docs.select("text", "lang").mapInArrow(emit, "bucket long, n long")


def suffixes(w: Words, maps: list[np.ndarray], s: Settings) -> np.ndarray:
    """A row for each suffix of two or more words: its first words, cut before what can't
    be frequent; 0 behind the end."""
    goes = {}
    for k in range(2, len(maps) + 1):
        at, h = frequent_at(w, maps, s.filter_bits, k)
        goes[k] = np.zeros(len(w.ids) + s.longest, dtype=bool)
        goes[k][at] = inside(maps[k - 1], bucket_of(h, s.filter_bits))
    start = np.flatnonzero(goes[2])
    rows = np.zeros((len(start), s.longest), dtype=np.uint64)
    rows[:, 0] = w.ids[start]
    live = np.arange(len(start))
    for k in range(2, s.longest + 1):
        # the last words of the longer suffix, as many as the longest map tells of
        known = min(k, len(maps))
        live = live[goes[known][start[live] + k - known]]
        rows[live, k - 1] = w.ids[start[live] + k - 1]
    return rows


def firsts(x: np.ndarray) -> np.ndarray:
    """Where each value of sorted `x` comes first."""
    new = np.ones(len(x), dtype=bool)
    new[1:] = x[1:] != x[:-1]
    return np.flatnonzero(new)


def given(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The columns in batches of `GIVEN` rows, as the other side holds a batch whole."""
    for k in range(0, len(next(iter(columns.values()))), GIVEN):
        yield pa.RecordBatch.from_arrays([pa.array(x[k:k + GIVEN]) for x in columns.values()], list(columns))


def together(rows: np.ndarray) -> list[np.ndarray]:
    """Equal rows once, by columns: a hash of the row, ascending, its words, how often it is there."""
    h = np.zeros(len(rows), dtype=np.uint64)
    for k in range(rows.shape[1]):
        h = mix64(h ^ rows[:, k])
    order = np.argsort(h)
    h = h[order]
    first = firsts(h)
    return [h[first], *(rows[order[first], k] for k in range(rows.shape[1])), np.diff(first, append=len(h))]


def put_in(held: list[np.ndarray], more: list[np.ndarray]) -> None:
    """Adds the rows of `more` to `held`, both as `together` gives them. A column is
    replaced at a time, so that never all of them are there twice."""
    at = np.searchsorted(held[0], more[0])
    known = at < len(held[0])
    known[known] = held[0][at[known]] == more[0][known]
    held[-1][at[known]] += more[-1][known]
    at, new = at[~known], ~known
    for k in range(len(held)):
        held[k] = np.insert(held[k], at, more[k][new])


def leaves(docs: DataFrame, maps: list[np.ndarray], s: Settings) -> DataFrame:
    """(w1, w2, ..., n): the leaves of the tree, those of one task put together.

    A task for each core reads all of its part before it gives out its leaves, unless
    more than a buffer of them are different: rows are at most tasks times different
    leaves. With a task for each split both factors would grow with the input. Suffixes
    are put to the different leaves by an eighth of a buffer, so a task's memory is that
    of its different leaves, a buffer at most, and a block of texts."""
    names = [f"w{k}" for k in range(1, s.longest + 1)]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh, size = together(np.zeros((0, s.longest), np.uint64)), [], 0

        def settle() -> None:
            more = together(np.concatenate(fresh))
            fresh.clear()
            put_in(held, more)

        def out() -> Iterator[pa.RecordBatch]:
            return given({x: signed(y) if x != "n" else y for x, y in zip([*names, "n"], held[1:])})

        for batch in batches:
            for w, _ in words_of(batch.column(0), batch.column(1).to_pylist()):
                fresh.append(suffixes(w, maps, s))
                size += len(fresh[-1])
                if 8 * size >= s.buffer:
                    settle()
                    size = 0
                    if len(held[0]) > s.buffer:
                        yield from out()
                        held = together(np.zeros((0, s.longest), np.uint64))
        if size:
            settle()
        yield from out()

    parts = docs.select("text", "lang").coalesce(docs.sparkSession.sparkContext.defaultParallelism)
    return parts.mapInArrow(emit, ", ".join(f"{x} long" for x in [*names, "n"]))


def partitioned(leaf: DataFrame, s: Settings) -> DataFrame:
    """`leaf` with `level`, the words of the prefix that it is dealt by, and `tree`, the
    group of prefixes that are built together.

    A unit is a hash of prefixes. One that holds more leaves than the budget (on small
    tables: than a task's share of them) is told apart by a word more; at most leaves /
    budget of each level are. Units, none above the budget, are dealt to twice as many
    trees as the budget asks for, so that a tree holds about half of it."""
    total, tasks = leaf.count(), int(leaf.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(s.budget, max(s.least_share, total // (2 * tasks)))
    d = leaf.withColumn("unit", F.pmod("w1", F.lit(s.units))).withColumn("level", F.lit(1))
    for level in range(2, s.longest + 1):
        load = d.where(F.col("level") == level - 1).groupBy("unit").agg(F.count(F.lit(1)).alias("load"))
        over = saved(load.where(F.col("load") > share).select(F.col("unit").alias("o_unit")), "phrases-over")
        n = over.count()
        if not n:
            break
        # few prefixes become part of the plan, very many are a table of their own
        if n <= s.listed:
            split = F.col("unit").isin([r["o_unit"] for r in over.collect()])
        else:
            d = d.join(over, F.col("unit") == F.col("o_unit"), "left")
            split = F.col("o_unit").isNotNull()
        word = F.col(f"w{level}")
        child = F.when(word == 0, F.lit(0)).otherwise(F.lit(1) + F.pmod(F.xxhash64(word), F.lit(s.fan - 1)))
        # units of different levels never meet: each level has a range of its own
        finer = F.lit(level << 48) + F.pmod(F.xxhash64("unit"), F.lit(1 << 40)) * s.fan + child
        d = d.withColumn("_split", split & (F.col("level") == level - 1))
        d = d.select(*leaf.columns, F.when(F.col("_split"), finer).otherwise(F.col("unit")).alias("unit"),
                     F.when(F.col("_split"), F.lit(level)).otherwise(F.col("level")).alias("level"))
    trees = max(1, -(-2 * total // share))
    return d.withColumn("tree", F.pmod(F.xxhash64("unit", F.lit(3)), F.lit(trees))).drop("unit")


def subtree(words: np.ndarray, n: np.ndarray, level: np.ndarray, least: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The nodes of two or more words, by depth, that have `least` occurrences in the
    leaves, or are above the prefixes that the leaves were dealt by, and the occurrences."""
    order = np.lexsort(words.T[::-1])
    words, n, level = words[order], n[order], level[order]
    differs = words[1:] != words[:-1]
    nodes, totals = [], []
    for depth in range(2, words.shape[1] + 1):
        new = np.ones(len(words), dtype=bool)
        new[1:] = differs[:, :depth].any(axis=1)
        first = np.flatnonzero(new)
        total, part = np.add.reduceat(n, first), np.maximum.reduceat(level, first) > depth
        keep = (words[first, depth - 1] != 0) & ((total >= least) | part)
        nodes.append(words[first[keep], :depth])
        totals.append(total[keep])
    return nodes, totals


def phrase_counts(leaf: DataFrame, s: Settings) -> DataFrame:
    """(words, f): the phrases of two or more words that occur `least` times."""
    names = [f"w{k}" for k in range(1, s.longest + 1)]

    def build(t: pa.Table) -> pa.Table:
        words = np.stack([t.column(x).to_numpy() for x in names], axis=1)
        nodes, totals = subtree(words, t.column("n").to_numpy(), t.column("level").to_numpy(), s.least)
        size = np.concatenate([np.full(len(x), x.shape[1]) for x in nodes])
        flat = np.concatenate([x.reshape(-1) for x in nodes])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat))
        return pa.table({"words": lists, "f": pa.array(np.concatenate(totals), pa.int64())})

    parts = partitioned(leaf, s).groupBy("tree").applyInArrow(build, "words array<long>, f long")
    return parts.groupBy("words").agg(F.sum("f").alias("f")).where(F.col("f") >= s.least)


def exact_score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 * a * n / (left * right)) in whole numbers of up to 38 digits."""
    d = "CAST({} AS DECIMAL(19, 0))".format
    return F.expr(f"CAST((CAST(1000 AS DECIMAL(4, 0)) * {d(a)} * {d(n)}) DIV ({d(left)} * {d(right)}) AS BIGINT)")


def collocations(docs: DataFrame, top: int = 2000, settings: Settings = Settings()) -> DataFrame:
    """The best collocations of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    Letters A-Z are lower-cased, texts are split at . , ; : ! ? and line ends into pieces
    and those at blanks and tabs into words. n counts a language's words, f(phrase) all
    occurrences within pieces. Candidates are phrases of 2 to `longest` words with
    a = f(phrase) >= `least`, but those that a longer candidate of equal f contains. A
    cut after k words gives l and r, the occurrences of both parts, and a score
    floor(1000 a n / (l r)); the lowest counts, of equal ones the smallest k. The `top`
    first by score, a (both descending) and phrase (bytes, ascending) are returned.

    `docs` needs text and lang; other columns are ignored, doc_id too: repeated rows
    count as often as they are there. A null language is `und`, a null or empty text has
    no words; an empty table gives an empty result. Texts of any length are read whole.
    Words are told apart by 64-bit hashes."""
    s = settings
    counts = word_counts(docs)
    counts = saved(counts.where(F.col("id").isNull() | (F.col("n") >= s.least)), "phrases-words")
    words = counts.where(F.col("id").isNotNull())
    bucket = F.shiftrightunsigned("id", 64 - s.filter_bits)
    maps = [bit_map(words.select(bucket.alias("bucket"), "n"), s.least, s.filter_bits)]
    for length in range(2, min(s.mapped, s.longest) + 1):
        maps.append(bit_map(phrase_buckets(docs, maps, length, s), s.least, s.filter_bits))
    leaf = saved(leaves(docs, maps, s), "phrases-leaves")
    phrases = saved(phrase_counts(leaf, s), "phrases-counts")
    f = saved(phrases.unionByName(words.select(F.array("id").alias("words"), F.col("n").alias("f"))), "phrases-all")

    # a phrase inside a longer one of equal count is in one that has a word more, of equal count
    longer = phrases.where(F.size("words") > 2)
    ends = [F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words") - 1)]
    held = saved(longer.select(F.explode(F.array(*ends)).alias("h_words"), F.col("f").alias("h_f")).distinct(), "phrases-held")
    live = phrases.join(held.hint("shuffle_merge"), (F.col("words") == F.col("h_words")) & (F.col("f") == F.col("h_f")), "left_anti")

    cut = live.select("words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cut = cut.select("words", "a", "k", F.expr("slice(words, 1, k)").alias("one"), F.expr("slice(words, k + 1, size(words) - k)").alias("two"))
    part = lambda name, value: f.select(F.col("words").alias(name), F.col("f").alias(value)).hint("shuffle_merge")
    cut = cut.join(part("f_one", "l"), F.col("one") == F.col("f_one")).drop("one", "f_one")
    cut = cut.join(part("f_two", "r"), F.col("two") == F.col("f_two")).drop("two", "f_two")
    who = words.select(F.col("id").alias("w_id"), "lang")
    cut = cut.join(who.hint("shuffle_merge"), F.element_at("words", 1) == F.col("w_id")).drop("w_id")
    # a row per language, joined by its measured size
    size = saved(counts.where(F.col("id").isNull()).select(F.col("lang").alias("n_lang"), F.col("n").alias("n")), "phrases-langs")
    cut = cut.join(size, F.col("lang") == F.col("n_lang")).withColumn("score", exact_score("a", "n", "l", "r"))
    best = saved(cut.groupBy("words").agg(F.min(F.struct("score", "k", "l", "r", "a", "n", "lang")).alias("b")).select("words", "b.*"), "phrases-scored")

    # the limit acts in the map tasks; ties stay until the phrases are spelled out
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = saved(best.withColumn("place", F.rank().over(place)).where(F.col("place") <= top).drop("place"), "phrases-first")
    each = first.select("words", F.posexplode("words").alias("at", "id"))
    spell = words.select(F.col("id").alias("s_id"), "word")
    text = (each.join(spell.hint("shuffle_merge"), F.col("id") == F.col("s_id")).groupBy("words")
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
            .select(F.col("words").alias("p_words"), "phrase"))
    named = first.join(text.hint("shuffle_merge"), F.col("words") == F.col("p_words"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return (named.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
