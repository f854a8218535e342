"""Best-fit packing of token sequences with exact complements.

Documents are tokenized and only those longer than a sequence are cut. What is
packed then depends on lengths alone, and there are at most `size` different
ones: a plan is made on their counts. For each length, longest first, exact
complements are looked up by their sum, single lengths, then pairs, then
triples, and consumed while all of them are available; the residue goes by best
fit. The plan is a bounded table of bin patterns with repeat counts; pieces find
their place in it by their rank among pieces of equal length.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import saved
from .textblocks import SPACE, Block, blocks

# words longer than this and more than so many words are not remembered by the tokenizer's memo
MEMO_WORD, MEMO_WORDS = 40, 600_000
_byte = np.arange(256)
# ASCII letters and digits; signs that may end a word; capitals to small letters
PLAIN = ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122))
TAIL = np.isin(_byte, np.frombuffer(b".,!?;:%$#&*", dtype=np.uint8))
FOLD = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
# pieces of one length are ranked in so many groups
RANK_GROUPS = 1024


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    # a worker has one core: threads of its own would only wait for each other
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordEncoder:
    """Token ids of texts, word by word.

    For tokenizers that drop white space and never join pieces across it. The
    different words of a block are looked up in a memo; the others are encoded many
    at a time with a sign between them that has an id of its own. Where the tokenizer
    parts letters from signs or ignores case, so do the words of the memo; it is asked
    for that once. Signs that special tokens are written with stay as they are."""

    SIGN, TOGETHER = "|", 500

    def __init__(self, path: str):
        self.tokenizer, self.memo = _tokenizer(path), {}
        self.sign, upper, lower, both, core, tail = self._each([self.SIGN, "Ab", "ab", "ab.,", "ab", ".,"])
        self.joins, self.folds, self.parts = len(self.sign) == 4, upper == lower, both == core + tail

    def _each(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _together(self, words: list[str]) -> list[bytes]:
        ids = self._each([f" {self.SIGN} ".join(words)])[0]
        cut = np.flatnonzero(np.frombuffer(ids, dtype="<u4") == np.frombuffer(self.sign, dtype="<u4")) * 4
        return [ids[x:y] for x, y in zip([0, *(cut + 4).tolist()], [*cut.tolist(), len(ids)], strict=True)]

    def _learned(self, words: list[str]) -> dict[str, bytes]:
        plain = [w for w in words if self.joins and self.SIGN not in w]
        odd = [w for w in words if not (self.joins and self.SIGN not in w)]
        found = dict(zip(odd, self._each(odd), strict=True)) if odd else {}
        for at in range(0, len(plain), self.TOGETHER):
            some = plain[at:at + self.TOGETHER]
            found.update(zip(some, self._together(some), strict=True))
        return found

    def _words(self, b: Block) -> tuple[pa.LargeStringArray, np.ndarray]:
        """The block's words, and the index of each text's first one."""
        starts, ends, data = b.starts, b.ends, b.data
        if self.parts and len(starts):
            e = ends.copy()
            for _ in range(8):
                e -= (e - 1 > starts) & TAIL[data[e - 1]]
            last, before = data[e - 1], data[np.maximum(e - 2, 0)]
            letter = PLAIN[last] | ((before == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7))
            e = e[(e < ends) & letter]
            # a word's end is where its signs start
            starts, ends = np.sort(np.concatenate([starts, e])), np.sort(np.concatenate([ends, e]))
        if self.folds and not (data == ord(self.SIGN)).any():
            data = FOLD[data]
        where, body = np.concatenate([[0], np.cumsum(ends - starts)]), data[~SPACE[data]]
        return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(where), pa.py_buffer(body)), np.searchsorted(starts, b.offsets)

    def encode(self, b: Block) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of the block one after the other, where each text's start)."""
        words, word_from = self._words(b)
        if not len(words):
            return np.zeros(0, dtype="<u4"), np.zeros(len(b.offsets), dtype=np.int64)
        words = words.dictionary_encode()
        different, index = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy()
        ids = list(map(self.memo.get, different))
        new = [k for k, v in enumerate(ids) if v is None]
        found = self._learned([different[k] for k in new])
        for k in new:
            ids[k] = found[different[k]]
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
        self.memo.update((w, v) for w, v in found.items() if len(w) <= MEMO_WORD)
        n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        first, count = (np.cumsum(n) - n)[index], n[index]
        total = np.concatenate([[0], np.cumsum(count)])
        take = np.repeat(first - total[:-1], count) + np.arange(total[-1])
        return np.frombuffer(b"".join(ids), dtype="<u4")[take], total[word_from]


def tokenized(docs: DataFrame, tokenizer_path: str, size: int, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 and, with
    `keep_ids`, the ids. A document is its text's ids (null: none) and then `end_id`."""
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for b in blocks(batch.column(1)):
                all_ids, where = encoder.encode(b)
                body, rows = all_ids.tobytes(), []
                for i, (x, y) in enumerate(zip((where[:-1] * 4).tolist(), (where[1:] * 4).tolist(), strict=True)):
                    ids = body[x:y] + end
                    for k, at in enumerate(range(0, len(ids), 4 * size)):
                        part = ids[at:at + 4 * size]
                        rows.append((docs[b.first + i], k, at // 4, len(part) // 4, zlib.crc32(part)) + ((part,) if keep_ids else ()))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids
                names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(emit, schema)


def _exact_fill(gap: int, left: np.ndarray) -> tuple[int, ...] | None:
    """One to three available lengths that add up to `gap`, larger ones first; `left`
    holds how many pieces of each length there are."""
    if left[gap] > 0:
        return (gap,)
    have = left > 0

    def pair(total: int) -> tuple[int, int] | None:
        b = np.arange(1, total // 2 + 1)
        ok = have[total - b] & have[b] & ((total - b != b) | (left[b] > 1))
        at = np.flatnonzero(ok)
        return (int(total - b[at[0]]), int(b[at[0]])) if len(at) else None

    if two := pair(gap):
        return two
    for a in np.flatnonzero(have[:gap - 1])[::-1].tolist():
        left[a] -= 1
        was, have[a] = have[a], left[a] > 0
        two = pair(gap - a)
        left[a] += 1
        have[a] = was
        if two:
            return (a, *two)
    return None


def plan_bins(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a bin, number of such bins) for `counts` pieces of each length.

    Each step consumes a combination as often as it is available, so it uses up at
    least one length: the plan has at most a few times `size` patterns, whatever
    the counts are."""
    left = np.zeros(size + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    plan: list[tuple[tuple[int, ...], int]] = []
    if left[size]:
        plan.append(((size,), int(left[size])))
        left[size] = 0
    rest: list[tuple[int, int]] = []
    for length in range(size - 1, 0, -1):
        while left[length] > 0:
            left[length] -= 1
            fill = _exact_fill(size - length, left)
            left[length] += 1
            if fill is None:
                rest.append((length, int(left[length])))
                left[length] = 0
                break
            need = {x: (length, *fill).count(x) for x in (length, *fill)}
            n = min(int(left[x]) // k for x, k in need.items())
            for x, k in need.items():
                left[x] -= n * k
            plan.append(((length, *fill), n))
    return plan + _best_fit(rest, size)


def _best_fit(pieces: list[tuple[int, int]], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on (length, count), longest first: a piece goes to the
    fullest bin with room. Equal bins are kept together and split as needed."""
    gaps: list[int] = []
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(gap: int, pattern: tuple[int, ...], n: int) -> None:
        if gap not in bins:
            bins[gap] = []
            insort(gaps, gap)
        bins[gap].append((pattern, n))

    for length, n in pieces:
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                # as many to a fresh bin as it holds
                each = size // length
                if n >= each:
                    put(size - each * length, (length,) * each, n // each)
                    n %= each
                if n:
                    put(size - n * length, (length,) * n, 1)
                break
            gap = gaps[at]
            pattern, k = bins[gap].pop()
            used = min(k, n)
            if not bins[gap]:
                del bins[gap], gaps[at]
            if k > used:
                put(gap, pattern, k - used)
            put(gap - length, (*pattern, length), used)
            n -= used
    return [x for gap in gaps for x in bins[gap]]


def slot_table(plan: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """The plan as places: pieces of `length` with a rank from `first` on, `n` of them,
    go to the sequences from `sequence` on, at `offset`."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in plan:
        offset = 0
        for length in pattern:
            first = taken.get(length, 0)
            rows.append((length, first, n, sequence, offset))
            taken[length] = first + n
            offset += length
        sequence += n
    return pd.DataFrame(rows, columns=["length", "first", "n", "sequence", "offset"]).sort_values(["length", "first"], ignore_index=True)


def ranked_by_length(pieces: DataFrame) -> DataFrame:
    """Adds `rank` (from 0) of each piece among those of its length. A length is
    ranked in RANK_GROUPS groups, so a very common one is spread over tasks."""
    g = pieces.withColumn("_g", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANK_GROUPS)).cast("int"))
    w = Window.partitionBy("length").orderBy("_g").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = g.groupBy("length", "_g").agg(F.count(F.lit(1)).alias("n"))
    starts = saved(counts.select(F.col("length").alias("s_length"), F.col("_g").alias("s_g"), (F.sum("n").over(w) - F.col("n")).alias("before")), "pack-ranks")
    within = F.row_number().over(Window.partitionBy("length", "_g").orderBy("doc_id", "piece")) - 1
    return (g.withColumn("_at", within).join(starts, (F.col("length") == F.col("s_length")) & (F.col("_g") == F.col("s_g")))
            .withColumn("rank", F.col("before") + F.col("_at")).drop("_g", "_at", "s_length", "s_g", "before"))


def pack_pieces(pieces: DataFrame, size: int, planner: Callable[[dict[int, int], int], list] = plan_bins) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length <= size). The driver
    sees one count per length, at most `size` of them."""
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = slot_table(planner(counts, size))
    by_length = {int(k): tuple(v[c].to_numpy() for c in ("first", "sequence", "offset")) for k, v in slots.groupby("length")}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            length, rank = pdf["length"].to_numpy(), pdf["rank"].to_numpy()
            for v in np.unique(length):
                at = np.flatnonzero(length == v)
                first, seq, off = by_length[int(v)]
                k = np.searchsorted(first, rank[at], "right") - 1
                sequence[at], offset[at] = seq[k] + rank[at] - first[k], off[k]
            yield pdf.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    ranked = ranked_by_length(pieces)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return ranked.select(*pieces.columns, "rank").mapInPandas(place, schema)


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Packs every document: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset (and ids as little-endian 32-bit bytes with `keep_ids`).

    `docs` needs doc_id and text; other columns are ignored. A null or empty text is
    one piece that holds `end_id` alone. Only documents above `size` tokens are cut.
    Repeated rows are packed as often as they come. Ranks of equal lengths follow a
    hash of (doc_id, piece), then doc_id and piece. An empty table gives an empty result."""
    return pack_pieces(saved(tokenized(docs, tokenizer_path, size, end_id, keep_ids), "pack-pieces"), size)
