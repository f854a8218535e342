import hashlib
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from brute import bag, classes, repeats, words
from foldframe.llm import bagminhash, linetemplates, packing, sharding, substring
from foldframe.llm.queries import tokenizer_file
from foldframe.llm.textblocks import blocks, window_hashes
from pyspark.sql import functions as F


def test_words_and_windows_agree_with_a_plain_split(texts):
    column = pa.array(list(texts.values()))
    seen, hashes = [], {}
    for b in blocks(column):
        h = b.hashes()
        body = b.data.tobytes()
        for i in range(len(b.offsets) - 1):
            w = [body[s:e].decode() for s, e in zip(b.starts[b.word_from[i]:b.word_from[i + 1]], b.ends[b.word_from[i]:b.word_from[i + 1]])]
            seen.append(w)
            for x, v in zip(w, h[b.word_from[i]:b.word_from[i + 1]].tolist()):
                assert hashes.setdefault(x, v) == v
    assert seen == [words(t) for t in texts.values()]
    assert len(set(hashes.values())) == len(hashes)
    a = np.array([1, 2, 3, 1, 2, 3, 4], dtype=np.uint64)
    w = window_hashes(a, 3)
    assert w[0] == w[3] and len(set(w.tolist())) == 4


@pytest.mark.parametrize("window", [31, 50])
def test_repeats_equal_brute_force(documents, texts, window):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(documents, window).collect()}
    assert got == repeats(texts, window)


def test_repeats_with_repeated_rows_null_ids_and_no_rows(spark, documents, nothing):
    assert substring.remove_repeats(nothing, 50).count() == 0
    text = " ".join(f"w{i}" for i in range(70))
    rows = spark.createDataFrame([(5, text), (5, text), (None, text), (6, text)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_removed, r.kept_text == text) for r in substring.remove_repeats(rows, 50).collect())
    assert got == [(-1, 0, True), (5, 0, True), (5, 0, True), (6, 70, False)]


def test_cover_and_windows_that_are_too_short():
    assert substring.is_cover(substring.COVER, substring.PERIOD)
    with pytest.raises(ValueError):
        substring.anchor_width(30)


def test_near_duplicate_classes_equal_brute_force(documents, texts):
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(documents).collect()}
    assert got == classes(texts)
    kept = bagminhash.one_of_each(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, c in classes(texts).items() if i == c)


def test_near_duplicates_of_no_rows_and_repeated_rows(spark, nothing):
    assert bagminhash.near_duplicates(nothing).count() == 0
    rows = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b"), (2, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.class_id) for r in bagminhash.near_duplicates(rows).collect() if r.doc_id is not None)
    assert got == [(1, 1), (1, 1), (2, 1)]


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    shingle = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    c1, c2 = rng.integers(0, 9, 400), rng.integers(0, 9, 400)
    sigs = []
    for c in (c1, c2):
        on = c > 0
        sigs.append(bagminhash.bag_minhash(np.zeros(on.sum(), dtype=np.int64), shingle[on], c[on], 1, 4096)[0])
    true = np.minimum(c1, c2).sum() / np.maximum(c1, c2).sum()
    assert abs((sigs[0] == sigs[1]).mean() - true) < 0.04


def test_shingles_count_repeats(texts):
    for i in (3, 5, 10, 72):
        b = next(blocks(pa.array([texts[i]])))
        _, _, c = bagminhash.shingle_counts(b)
        assert sorted(c.tolist()) == sorted(bag(texts[i]).values())


def brute_templates(docs, min_families=linetemplates.MIN_FAMILIES, share=linetemplates.CONSTANT_SHARE):
    """(doc_id, pos) of the lines of recurring templates, by the rules as they stand: families
    by rare leaves, digit tokens that match beside a word, lines of numbers only if equal."""
    import xxhash

    def xx(seed, raw):
        h = xxhash.xxh64(raw, seed=seed % 2**64).intdigest()
        return h - 2**64 if h >= 2**63 else h

    digit = lambda x: any(c in "0123456789" for c in x)
    lines, leaves_of = [], defaultdict(list)
    for i, t in docs.items():
        for p, line in enumerate((t or "").split("\n") if t is not None else []):
            w = tuple(words(line))
            if len(w) >= linetemplates.MIN_TOKENS:
                lead = " ".join("<*>" if digit(x) else x for x in w[:linetemplates.LEAD])
                leaf = xx(xx(42, len(w).to_bytes(4, "little")), lead.encode())
                lines.append((i, p, leaf, w))
                leaves_of[i].append(leaf)
    whole = {i: tuple(sorted(x)) for i, x in leaves_of.items()}
    holders = defaultdict(set)
    for i, x in whole.items():
        for leaf in x:
            holders[leaf].add(x)
    busy = {leaf for leaf, x in holders.items() if len(x) >= min_families}
    order = lambda leaf, way: xx(xx(42, leaf.to_bytes(8, "little", signed=True)), way.to_bytes(4, "little"))
    family = {}
    for i, x in whole.items():
        rare = set(x) - busy
        family[i] = [min(order(leaf, way) for leaf in rare) if rare else x for way in range(linetemplates.WAYS)]
    live = [x for x in lines if x[2] in busy]
    seen = defaultdict(list)
    for i, _, leaf, w in live:
        for at, x in enumerate(w):
            seen[leaf, at, "<*>" if digit(x) else x].append(whole[i])
    constant = {k for k, v in seen.items() if len(v) >= min_families and len(set(v)) > 1}
    found = []
    for i, p, leaf, w in live:
        keys = ["<*>" if digit(x) else x for x in w]
        match = [(leaf, at, k) in constant for at, k in enumerate(keys)]
        fixed = [m and k != "<*>" for m, k in zip(match, keys)]
        worded = any(f and any(c.isalpha() for c in k) for f, k in zip(fixed, keys))
        if sum(fixed) >= share * len(w) or worded and sum(match) >= share * len(w):
            found.append((i, p, " ".join(k if m else "<*>" for k, m in zip(keys, match))))
        elif all(match):
            found.append((i, p, " ".join(w)))
    spread = defaultdict(set)
    for i, _, t in found:
        for way in range(linetemplates.WAYS):
            spread[t, way].add(family[i][way])
    good = {t for (t, _), x in spread.items() if len(x) >= min_families}
    return {(i, p) for i, p, t in found if t in good}


def lost_lines(table, docs):
    """(doc_id, pos) of the lines that go, by the operator."""
    keyed = table.select("doc_id", linetemplates.text_key(table["text"]).alias("k")).distinct()
    lost = linetemplates.recurring_lines(table)
    return {(r.doc_id, r.pos) for r in keyed.join(lost, keyed["k"] == lost["text_key"]).collect()}


@pytest.fixture(scope="session")
def lined(spark, texts):
    docs = dict(texts)
    for k in range(100, 130):
        own = texts[40 + k % 20].split()
        docs[k] = "\n".join([" ".join(own[j:j + 9]) for j in range(0, 60, 9)] + [f"Page {k} of the big report", "Released under the MIT License.", "Of.", ""]
                            + [f"Copyright {1990 + k} by the people of name{k} and friends, all rights kept"])
    return docs, spark.createDataFrame([(i, t, "keep") for i, t in docs.items()], "doc_id long, text string, n_dropped string").repartition(3)


def test_line_templates_equal_brute_force(lined):
    docs, table = lined
    lost = brute_templates(docs)
    assert lost_lines(table, docs) == lost
    boilerplate = {(i, p) for i in range(100, 130) for p, x in enumerate(docs[i].split("\n")) if x.startswith(("Page", "Released", "Copyright"))}
    assert boilerplate <= lost
    out = {r.doc_id: r for r in linetemplates.drop_recurring(table).collect()}
    assert out[0].text is None and out[0].n_lines == 0 and out[1].text == "" and out[10].text == docs[10]
    for i, t in docs.items():
        if t is not None:
            assert out[i].text == "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in lost)
            assert out[i].n_dropped == sum(j == i for j, _ in lost)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rare_leaves_and_digit_rules_equal_brute_force(spark, seed):
    """Shared blocks, near copies, tables of numbers, lines with digit fields, few own lines."""
    r = random.Random(seed)
    docs = {}
    for i in range(120):
        block = [f"shared block {chr(97 + j)} of the menu" for j in range(r.choice([0, 3, 12]))]
        own = [f"{r.choice('abcdefgh')}{r.choice('abcdefgh')} goes its own way {r.randint(0, 3)}" for _ in range(r.randint(0, 3))]
        fields = [f"Page {i} of {i % 9 + 9}", f"Posted {i % 30 + 1} May 2024", "0800 123 456", f"{i} {i * 7} {i * 9}", f"| {i % 4} | {r.randint(0, 2)} |", "Menu", "", "  "]
        docs[i] = "\n".join(r.sample(block + own + fields, r.randint(1, len(block + own + fields))))
    docs |= {200 + k: docs[k % 5] for k in range(40)} | {300 + k: docs[7] + f"\n{k}" for k in range(15)}
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    want = brute_templates(docs)
    assert lost_lines(table, docs) == want
    # the old rules, all leaves and no digit matches, would tell otherwise
    assert any(x in docs[i].split("\n")[p] for i, p in want for x in ("May 2024", "0800")) and want


def test_line_dedup_of_very_many_lines_repeated_rows_and_null_ids(spark):
    """A document of 200,000 lines costs time in proportion to them."""
    footer = "Brought to you by the people of the valley"
    long = "\n".join(f"own line {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)} {i} of it" if i % 5 else footer for i in range(200_000))
    rows = [(i, f"w{chr(97 + i)} goes its own way here\n{footer}", "x") for i in range(12)] + [(None, f"no id here at all\n{footer}", "x")] * 2
    rows += [(3, f"w{chr(97 + 3)} goes its own way here\n{footer}", "y"), (3, "another text of the same id", "z"), (50, long, "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, text_key string").repartition(3)
    began = time.time()
    out = linetemplates.drop_recurring(table)
    got = Counter((r.doc_id, r.text, r.text_key) for r in out.where("doc_id is null or doc_id < 50").collect())
    assert got == Counter((i, t.split("\n")[0], k) for i, t, k in rows if i != 50)
    big = out.where("doc_id = 50").first()
    assert big.n_lines == 200_000 and big.n_dropped >= 40_000 and footer not in big.text
    assert time.time() - began < 600


def test_copies_of_one_document_make_no_template(spark):
    body = "\n".join(f"the line number of this text is w{i} a b c d" for i in range(30))
    rows = [(i, body) for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert linetemplates.recurring_lines(table).count() == 0
    assert linetemplates.drop_recurring(table.where("false")).count() == 0


def plain_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file()).encode(text or "", add_special_tokens=False).ids + [0]


def test_packing_round_trip(documents, texts):
    rows = packing.pack(documents, tokenizer_file(), 256, keep_ids=True).collect()
    found = {}
    sequences = {}
    for r in rows:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(ids) == r.length <= 256
        found.setdefault(r.doc_id, {})[r.start] = ids
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, t in texts.items():
        joined = [x for s in sorted(found[i]) for x in found[i][s]]
        assert joined == plain_ids(t)
        assert sorted(found[i]) == list(range(0, len(joined), 256))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    gaps = []  # best-fit decreasing
    for n in sorted((r.length for r in rows), reverse=True):
        fits = [k for k, g in enumerate(gaps) if g >= n]
        k = min(fits, key=lambda k: gaps[k], default=None)
        if k is None:
            gaps.append(256 - n)
        else:
            gaps[k] -= n
    assert len(sequences) <= len(gaps)


def test_packing_plans_use_every_piece():
    rng = np.random.default_rng(1)
    for counts in ({}, {64: 5}, {33: 7}, {1: 3}, {63: 2, 1: 1}, {int(k): int(v) for k, v in zip(range(1, 65), rng.integers(0, 50, 64))},
                   {20: 9, 24: 9, 21: 3, 23: 2}, {40: 1000000, 12: 3000000}):
        plan = packing.plan_bins(counts, 64)
        used = {}
        for pattern, n in plan:
            assert sum(pattern) <= 64 and n > 0
            for x in pattern:
                used[x] = used.get(x, 0) + n
        assert used == {k: v for k, v in counts.items() if v}
    # 20 + 24 + 20 and 21 + 23 + 20 are exact triples
    plan = packing.plan_bins({20: 3, 24: 1, 21: 1, 23: 1}, 64)
    assert sorted(sum(p) for p, n in plan for _ in range(n)) == [64, 64]


def test_packing_no_rows_repeated_rows_and_odd_blanks(spark, nothing):
    assert packing.pack(nothing, tokenizer_file(), 64).count() == 0
    text = "a\u00a0b\x0bc  d\x1ce\u2003\u0301f <|endoftext|> Ünïcode's 12\r\nzzz"
    got = packing.pack(spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string"), tokenizer_file(), 64, keep_ids=True).collect()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == [plain_ids(text)] * 2
    assert len({(r.sequence_id, r.offset) for r in got}) == 2


def test_sharding_is_even_gapless_and_keeps_equal_texts_together(documents, texts):
    import zlib

    few = documents.where("doc_id not in (70, 71, 72, 73)")
    records, slot_map = sharding.shard(few, 3)
    rows = records.collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i in texts if i < 70)
    load = {}
    for r in rows:
        body = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(body) + 1, zlib.crc32(body))
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert max(load.values()) - min(load.values()) <= max(r.size for r in rows)
    for s in load:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert len({r.shard for r in rows if r.doc_id in (10, 11)}) == 1
    # rebalancing moves slots to the new shard and leaves the others where they are
    old = {(r.vslot, r.part): r.shard for r in slot_map.collect()}
    grown = sharding.rebalance(slot_map, 4).collect()
    assert {r.version for r in grown} == {2} and {(r.vslot, r.part) for r in grown} == set(old)
    moved = [r for r in grown if r.shard != old[r.vslot, r.part]]
    assert 0 < len(moved) < len(old) and any(r.shard == 3 for r in moved)
    size = {s: sum(r.bytes for r in grown if r.shard == s) for s in range(4)}
    assert max(size.values()) - min(size.values()) <= max(r.bytes for r in grown)


def test_sharding_splits_a_group_that_no_shard_can_hold(spark, nothing):
    assert sharding.shard(nothing, 3)[0].count() == 0
    rows = spark.createDataFrame([(i, "the same text of a large group") for i in range(600)] + [(i, f"text {i}") for i in range(600, 900)], "doc_id long, text string")
    got = sharding.shard(rows, 8)[0].groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == 8 and max(sizes) < 1.4 * min(sizes)


def test_only_the_hot_text_of_a_heavy_slot_is_split(spark):
    """A third of all rows hold one text; another text shares its slot, null ids and texts too."""
    hot = "the same text of a large group"
    rows = [(None if i % 2 else i, hot) for i in range(600)] + [(i, f"text {i % 300}") for i in range(600, 1500)] + [(None, None)] * 5 + [(7, "x"), (7, "x"), (7, "y")]
    docs = spark.createDataFrame([(*r, 0, "z") for r in rows], "doc_id long, text string, size int, spread string").repartition(3)
    records, slot_map = sharding.shard(docs, 8, slots=4)
    got = records.join(docs.selectExpr("text", "crc32(encode(coalesce(text, ''), 'UTF-8')) AS c").distinct(), F.col("text_crc32") == F.col("c")).collect()
    assert len(got) == len(rows)
    shards_of = defaultdict(set)
    for r in got:
        shards_of[r.text].add(r.shard)
    assert len(shards_of[hot]) > 2 and all(len(v) == 1 for t, v in shards_of.items() if t != hot)
    load = Counter()
    for r in got:
        load[r.shard] += r.size
    assert len(load) == 8 and max(load.values()) < 1.3 * min(load.values())
    for s in load:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert {r.vslot for r in slot_map.where("part >= 0").collect()} and slot_map.where("part = -1").count() <= 4


def test_versions_of_the_slot_map_are_a_table(spark, documents, tmp_path):
    path = str(tmp_path / "map")
    _, first = sharding.shard(documents.where("doc_id not in (70, 71, 72, 73)"), 3, map_path=path)
    sharding.write_map(sharding.rebalance(sharding.read_map(spark, path), 4), path)
    kept = sharding.read_map(spark, path)
    assert sorted(r.version for r in kept.select("version").distinct().collect()) == [1, 2]
    cols = ["vslot", "part", "bytes", "shard"]
    assert sorted(map(tuple, kept.where("version = 1").select(cols).collect())) == sorted(map(tuple, first.select(cols).collect()))
    assert sharding.newest(kept).select("shard").distinct().count() == 4


def test_repeated_rows_are_compared_once_and_an_id_has_one_text(spark, monkeypatch):
    from conftest import prose

    base = prose(9, 120)
    near, other = base[:60] + ["changed"] + base[61:], prose(10, 90)
    rows = [(1, " ".join(base))] * 40 + [(2, " ".join(near))] * 40 + [(3, " ".join(other)), (4, " ".join(other)), (4, " ".join(base) + " more")]
    seen = []
    plain = bagminhash.compared
    monkeypatch.setattr(bagminhash, "compared", lambda *a: seen.append(plain(*a)) or seen[-1])
    got = Counter(tuple(r) for r in bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).select("doc_id", "class_id").collect())
    assert sum(df.count() for df in seen) <= 6
    digest = lambda t: hashlib.md5(t.encode()).digest()
    first = min((rows[-1][1], rows[-2][1]), key=digest)
    assert got[1, 1] == 40 and got[2, 1] == 40
    assert got[4, 3 if first == rows[-2][1] else 1] == 2 and got[3, 3] == 1


def test_partners_by_size_equal_brute_force_also_for_long_texts(spark):
    r = random.Random(3)
    rows = []
    for b in range(1, 160):
        n = r.choice([5, 30, 99, 100, 2000, 2500, 100_000, 110_000, 400_000])
        n += r.randint(0, n // 10)
        overlap = int(n * r.choice([0.5, 0.75, 0.85, 0.95]))
        rows.append((r.choice([0, -1]), b, n, overlap, r.randint(1, 3), overlap > 0.9 * n))
    mixed = spark.createDataFrame(rows, "a long, b long, n_b long, overlap long, label long, linked boolean")
    got = {(x.a, x.b) for x in bagminhash._by_size(mixed, 0.8).collect()}
    f, want = 0.8 / 1.8, set()
    for a, b, n, o, label, linked in rows:
        for a2, x, m, o2, label2, linked2 in rows:
            if a == a2 and b != x and label != label2 and not linked2 and min(o, o2) >= (n + m) * f - 1e-9:
                want.add((min(b, x), max(b, x)))
    assert got == want and want
