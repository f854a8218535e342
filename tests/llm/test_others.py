import random
import re

import numpy as np
import pytest

from brute import components, targets, words
from foldframe.llm import exacttopk, mixing, permutation, quality, urlfilter
from foldframe.llm.components import connected_components
from pyspark.sql import functions as F


def test_mix_meets_its_targets(documents, texts):
    rows = mixing.mix(documents, preference=mixing.longer_first(F.col("text"))).collect()
    source = {i: ["a", "b", None, "é"][i % 4] for i in texts}
    sizes = {i: len(words(t)) for i, t in texts.items()}
    total = {s: sum(n for i, n in sizes.items() if source[i] == s) for s in set(source.values())}
    goal = targets(total)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    taken = {}
    for r in rows:
        assert (r.size, r.source_size) == (sizes[r.doc_id], total[source[r.doc_id]])
        assert r.target == pytest.approx(goal[source[r.doc_id]])
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    assert sum(goal.values()) == pytest.approx(sum(sizes.values()))
    largest = {s: max(n for i, n in sizes.items() if source[i] == s) for s in total}
    for s in total:
        assert abs(taken[s] - goal[s]) <= largest[s] / 2 + 1
    again = {r.doc_id: r.taken for r in mixing.mix(documents.repartition(2), preference=mixing.longer_first(F.col("text"))).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_mix_prefers_by_weight_and_takes_no_empty_tables(spark, nothing):
    assert mixing.mix(nothing).count() == 0
    rows = spark.createDataFrame([(i, "w " * 10, "s" if i < 1500 else "t") for i in range(3000)], "doc_id long, text string, source string")
    got = mixing.mix(rows, weights=(1.0, 3.0), preference=F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)).toPandas()
    s = got[got.doc_id < 1500]
    often, seldom = s[s.doc_id % 2 == 0].copies.mean(), s[s.doc_id % 2 == 1].copies.mean()
    assert often / seldom == pytest.approx(3, rel=0.15)
    assert s.taken.sum() == pytest.approx(s.target.iloc[0], rel=0.01)
    assert mixing.mixed_rows(rows).columns == rows.columns


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(0, k) for k in range(400, 450)] + [(k, k + 1) for k in range(500, 540)] + [(None, 1), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == components(edges)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def test_urls_are_judged_by_rules_and_aliases(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([
        (1, "http://a.Example.NET/en/x?y#z", None), (2, "https://example.net/fr/", ""), (3, "http://net", "x"), (4, "nowhere", "<p>"),
        (5, None, "<link rel='canonical' href='http://b.net/q'>"), (6, "http://x.com/1", '<link href="/2" rel="canonical">'),
        (7, "http://x.com/2#top", '<meta http-equiv="refresh" content="0; url=http://bad.net/a">'),
        (8, "http://x.com/3", '<!-- <link rel="canonical" href="http://bad.net/a"> -->'),
        (9, "http://y.com/1", '<link rel="canonical" href="//z.org/fr/1">'), (10, "http://y.com/2", '<link rel="canonical" href="1">'),
        (11, "https://y.com/2", '<link rel="alternate canonical" href="http://c.net/">'), (12, "http://example.community/de/", None),
        (13, "http://my.example.com/de/?a://b", None), (13, "http://my.example.com/de/?a://b", None), (14, "a?b://org/fr/", None), (15, "http://q.com?x=1", None),
    ], "page_id long, url string, html string").withColumn("rule", F.lit("clash"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, rules).collect()}
    assert got == {
        1: ("a.example.net", "/en/x", "example.net/en/", "allow"), 2: ("example.net", "/fr/", "net/", "block"), 3: ("net", "", None, "allow"),
        4: ("", "", None, "allow"), 5: ("", "", None, "block"), 6: ("x.com", "/1", None, "block"), 7: ("x.com", "/2", None, "block"),
        8: ("x.com", "/3", None, "allow"), 9: ("y.com", "/1", None, "allow"), 10: ("y.com", "/2", None, "allow"), 11: ("y.com", "/2", None, "allow"),
        12: ("example.community", "/de/", None, "allow"), 13: ("my.example.com", "/de/", "example.com/de/", "block"),
        14: ("org", "/fr/", "org/fr/", "allow"), 15: ("q.com", "", None, "allow")}
    more = spark.createDataFrame([("http://x.com/3", "http://bad.net/a")], "source_url string, target_url string")
    assert {r.page_id: r.verdict for r in urlfilter.judge(pages, rules, more).collect()}[8] == "block"
    assert urlfilter.judge(pages.where("false"), rules).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages, rules.where("false")).collect()} == {"allow"}


def brute_verdicts(pages, rules) -> dict:
    """page_id -> (rule, verdict), by trying every rule on every page and every alias."""
    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        return host.translate({c: c + 32 for c in range(65, 91)}), re.match(r"[^?#]*", rest[len(host):]).group()

    def best(host, path):
        fit = [(-len(h + p), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return min(fit)[1:] if fit else None

    def node(url):
        host, _ = parts(url)
        tail = re.match(r"[^#]*", url.split("://", 1)[1][len(host):]).group()
        return host + (tail if tail.startswith("/") else "/" + tail)

    edges = [(node(u), node(m.group(1))) for _, u, h in pages if u and (m := re.search(r'rel="canonical" href="([^"]*)"', h or ""))]
    group, verdicts = components(edges), {}
    for n, c in group.items():
        host, tail = n.split("/", 1)
        if hit := best(host, re.match(r"[^?]*", "/" + tail).group()):
            verdicts.setdefault(c, []).append(hit[0])
    out = {}
    for i, u, _ in pages:
        hit, alias = best(*parts(u)), verdicts.get(group.get(node(u))) if u else None
        out[i] = (hit[1], hit[0]) if hit else (None, min(alias) if alias else "allow")
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_verdicts_equal_brute_force(spark, seed):
    r = random.Random(seed)
    hosts = ["net", "a.net", "example.net", "www.Example.net", "example.com", "de.example.com", "org", "x.org", "other.io", "q.io", "z.dev"]
    paths = ["", "/", "/en/", "/en/x", "/de/1", "/fr/", "/fr/2?q=1", "/p?b=2", "?only=1", "/en"]
    url = lambda: f"http://{r.choice(hosts)}{r.choice(paths)}{r.choice(['', '', '#top'])}"
    html = lambda: f'<html><link rel="canonical" href="{url()}"></html>' if r.random() < 0.25 else r.choice(["<p>", None, "x" * 50_000])
    pages = [(i, url(), html()) for i in range(250)] + [(900, None, "<p>")]
    # with equally long rules: an allow goes first
    rules = [*RULES, ("other.io", "/en/", "block"), ("io", "/en/x", "block"), ("q.io", "/en", "allow"), ("q.io", "/e", "block"), ("z.dev", "/fr/", "block"), ("z.dev", "/fr/", "allow")]
    table = spark.createDataFrame(pages + pages[:5], "page_id long, url string, html string").repartition(3)
    got = {x.page_id: (x.rule, x.verdict) for x in urlfilter.judge(table, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    want = brute_verdicts(pages, rules)
    assert got == want and {v for _, v in want.values()} == {"allow", "block"}


@pytest.mark.parametrize("seed", [1, 2])
def test_posteriors_equal_brute_force(spark, seed):
    """Host and path means, their strengths and every document's posterior, summed in plain loops."""
    rng = np.random.default_rng(seed)
    rows = [(i, f"h{rng.integers(6)}" if rng.random() < 0.9 else None, ["en", None, "de"][rng.integers(3)], float(rng.normal(1, 2))) for i in range(400)]
    rows += [(400, "lone", "en", 3.0), (401, "h1", "en", -20.0), (None, "h2", "en", 0.5)] + [(7, "h3", "de", 0.0)] * 3
    scored = spark.createDataFrame([(*x[:3], n, x[3]) for n, x in enumerate(rows)], "doc_id long, host string, path string, row_group long, evidence double")
    p = [1 / (1 + np.exp(-x[3])) for x in rows]
    paths, hosts = {}, {}
    for x, v in zip(rows, p, strict=True):
        paths.setdefault((x[1], x[2]), []).append(v)
        hosts.setdefault(x[1], []).append(v)
    mean = np.mean(p)
    within = np.mean(np.square(p)) - mean ** 2

    def strength(groups):  # (n, mean, prior)
        n = np.array([g[0] for g in groups], float)
        spread = sum(k * (m - q) ** 2 for k, m, q in groups)
        between = (spread - (len(groups) - 1) * within) / (n.sum() - (n ** 2).sum() / n.sum())
        return float(np.clip(within / between, 1, 1e6)) if between > 0 else 1e6

    outer = strength([(len(v), np.mean(v), mean) for v in hosts.values()])
    host_post = {h: (sum(v) + outer * mean) / (len(v) + outer) for h, v in hosts.items()}
    inner = strength([(len(v), np.mean(v), host_post[k[0]]) for k, v in paths.items()])
    sites, found = quality.site_posteriors(scored)
    assert found == pytest.approx(mean)
    for s in sites.collect():
        v = paths[s.host, s.path]
        assert (s.site_n, s.site_sum, s.host_post, s.path_strength) == pytest.approx((len(v), sum(v), host_post[s.host], inner))
    out = {(r.row_group): r for r in quality.posteriors(scored).collect()}
    edge = lambda x: min(max(x, 1e-6), 1 - 1e-6)
    for n, (x, v) in enumerate(zip(rows, p, strict=True)):
        site = paths[x[1], x[2]]
        prior = edge((sum(site) - v + inner * host_post[x[1]]) / (len(site) - 1 + inner))
        logit = x[3] + np.log(prior / (1 - prior)) - np.log(edge(mean) / (1 - edge(mean)))
        want = 0.0 if x[3] <= quality.NO_WORDS else 1 / (1 + np.exp(-logit))
        assert out[n].site_prior == pytest.approx(prior) and out[n].posterior == pytest.approx(want) and out[n].keep == (out[n].posterior >= 0.5)


@pytest.fixture(scope="session")
def vectors(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 12)).astype(np.float32)
    x[100:500] = x[100]  # one vector many times
    x[600] = 0
    rows = [(i, v.tolist(), -1, "r") for i, v in enumerate(x)]
    rows += [(1000, None, 0, "r"), (1010, [1.0] * 11 + [None], 0, "r"), (1020, [1.0] * 11 + [float("nan")], 0, "r"), (1040, [1.0] * 11 + [float("inf")], 0, "r"),
             (1050, [1.0], 0, "r"), (1060, [], 0, "r")]
    return x.astype(float), spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int, rank string").repartition(4)


def exact(x, queries, k, skip=()):
    out = {}
    for q in queries:
        s = x @ x[q]
        out[q] = [int(i) for i in np.lexsort((np.arange(len(x)), -np.round(s, 9))) if i != q and i not in skip][:k]
    return out


def test_permutation_index_recall_and_ties(vectors):
    x, table = vectors
    rows = permutation.nearest(table, F.col("vec_id") % 20 == 0, 20).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id]))
    want = exact(x, [q for q in range(0, 900, 20) if q != 600], 20, skip={600})
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9
    assert got[120][:20] == want[120]  # ties of equal vectors go by vec_id, the own row left out


def test_permutation_index_on_few_and_no_rows(spark, vectors):
    _, table = vectors
    assert permutation.nearest(table.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert permutation.nearest(table.where("vec_id >= 1000"), F.lit(True), dim=12).count() == 0
    few = permutation.nearest(table.where("vec_id < 7"), F.col("vec_id") == 0, 20).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4, 5, 6]
    # files that hold too little: the query is compared with all rows
    narrow = permutation.Settings(posted=1, opened=1, order=4)
    some = permutation.nearest(table.where("vec_id < 100"), F.col("vec_id") == 0, 20, narrow).collect()
    assert len(some) == 20


def test_top_k_is_exact(vectors):
    x, table = vectors
    ints = np.floor(256 * x)
    got = {}
    for r in sorted(exacttopk.top_k(table, F.col("vec_id") % 50 == 0, 5).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r.score == int(ints[r.query_id] @ ints[r.vec_id])
    assert got == exact(ints, range(0, 900, 50), 5)
    assert exacttopk.top_k(table.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert exacttopk.top_k(table.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_searches_of_null_and_repeated_ids_and_clashing_columns(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(60, 6))
    rows = [(None if i in (7, 8) else 10 if i in (10, 11, 12) else i, v[i].tolist(), i, 1.0) for i in range(60)]
    rows += [(20, v[20].tolist(), 0, 1.0)] * 2
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, score double").repartition(3)
    by_id = [(i, np.array(x)) for i, x, *_ in rows if i is not None]
    once = {0: v[0], 20: v[20], 30: v[30], 40: v[40], 50: v[50]}

    def want(scale):
        out = []
        for q, x in once.items():
            scores = sorted((-float(scale(x) @ scale(y)), i) for i, y in by_id if i != q)[:5]
            out += [(q, k, i, round(-s, 9)) for k, (s, i) in enumerate(scores, 1)]
        return out

    def got(df):
        return sorted((r.query_id, r.rank, r.vec_id, round(float(r.score), 9)) for r in df.collect() if r.query_id in once)

    # so few vectors that every file is opened: the index is exact
    near, top = permutation.nearest(table, F.col("vec_id") % 10 == 0, 5), exacttopk.top_k(table, F.col("vec_id") % 10 == 0, 5)
    assert got(near) == want(lambda x: x) and got(top) == want(lambda x: np.floor(256 * x))
    for df in (near, top):
        assert {r.query_id for r in df.collect()} == {0, 10, 20, 30, 40, 50} and df.where('query_id = 10').count() == 15
        assert not any(r.vec_id is None or r.vec_id == r.query_id for r in df.collect())
    with pytest.raises(ValueError, match="2\\*\\*53"):
        exacttopk.top_k(spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>"), F.lit(True)).count()


def test_shares_of_files_and_reranks_grow_with_the_table():
    s = permutation.Settings()
    for n in (10_000, 1_000_000, 100_000_000):
        pivots = min(s.most_pivots, int(s.per_root * n ** 0.5))
        opened, held = max(s.opened, int(s.opened_share * pivots)), s.posted * n / pivots
        seen = opened * max(s.reranked, s.reranked_share * held) / n
        assert opened / pivots >= s.opened_share * 0.99 and seen >= 0.03


def test_bounds_hold_at_every_depth():
    rng = np.random.default_rng(2)
    x, q = rng.integers(-50, 50, (80, 6)), rng.integers(-50, 50, (9, 6)).astype(float)
    lists, true = exacttopk.SortedLists(x), x @ q.T
    for depth in (1, 10, 40, 79, 80):
        low, high = lists.bounds(q, depth)
        assert (low <= true).all() and (true <= high).all()
    for i, rows, score in exacttopk.search_block(x, q.astype(int), 4):
        best = np.sort(true[:, i])[-4:]
        assert sorted(score)[-4:] == best.tolist() and (score == true[rows, i]).all()


def quality_table(spark, n, seed):
    from conftest import prose

    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        w = prose(seed * 100_000 + i, int(rng.integers(20, 120)))
        kind = i % 5
        if kind == 3:
            w = [x.upper() + "!!" for x in w]
        elif kind == 4:
            for _ in range(4):
                w[int(rng.integers(len(w)))] = str(rng.choice(["vileword", "nastyword", "badword"]))
        rows.append((i, " ".join(w), f"h{i % 7}" if i % 11 else None, ["en", None][i % 2], int(kind != 3), int(kind == 4)))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, quality int, toxic int")


def test_quality_on_held_out_documents(spark):
    every = quality_table(spark, 1500, 3).cache()
    labels = every.where("doc_id % 2 = 0").select("doc_id", "quality", "toxic")
    docs = every.drop("quality", "toxic").unionByName(spark.createDataFrame([(9001, None, "h1", "en"), (9002, " ", "h1", "en"), (3, "x " * 50_000, None, None)],
                                                                             "doc_id long, text string, source string, lang string")).withColumn("keep", F.lit("clash"))
    got = quality.classify(docs, labels, (F.col("quality") == 1) & (F.col("toxic") == 0), F.col("source"), F.col("lang")).toPandas()
    assert len(got) == 1503 and not got[got.doc_id > 9000].keep.any()
    held = got[(got.doc_id % 2 == 1) & (got.doc_id < 9000)].drop_duplicates("doc_id")
    good = held.doc_id % 5 < 3
    assert held[good].keep.mean() > 0.97 and held[~good].keep.mean() < 0.05
    assert got.site_prior.between(0, 1).all()


def test_quality_without_labels_or_rows(spark):
    every = quality_table(spark, 40, 4)
    none = every.select("doc_id", "quality", "toxic").where("false")
    good = F.col("quality") == 1
    assert quality.classify(every, none, good, F.col("source"), F.col("lang")).where("keep").count() == 40
    assert quality.classify(every.where("false"), every, good, F.col("source"), F.col("lang")).count() == 0


def test_sites_shrink_by_their_size(spark):
    rng = np.random.default_rng(6)
    rows = []
    for h in range(40):
        rate = 0.95 if h % 2 else 0.2
        for i in range(400 if h < 38 else 2):
            rows.append((len(rows), f"h{h}", "p", 4.0 if rng.random() < rate else -4.0))
    scored = spark.createDataFrame(rows, "doc_id long, host string, path string, evidence double")
    sites, mean = quality.site_posteriors(scored)
    post = {r.host: r.host_post for r in sites.collect()}
    assert 0.5 < mean < 0.65 and post["h1"] > 0.85 and post["h0"] < 0.3
    assert abs(post["h38"] - mean) < abs(post["h0"] - mean) + 0.1
