"""Mixing sources to target weights by Pareto order sampling.

Every source gets a word target. Inside a source each document has an expected
number of copies proportional to its preference weight, at most `max_copies`;
the whole part of that number is certain, and the fraction is its inclusion
probability p in a fixed-size sample. Pareto order sampling ranks documents by
the odds of a uniform number over the odds of p, u/(1-u) : p/(1-p), and takes
the lowest ranks until the words that the certain copies left open are filled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ranking import global_rank
from ..session import saved

WORD = r"[^\x20\x09-\x0D]+"
# one source's ranks fall into so many buckets; only its boundary bucket is sorted
RANK_BUCKETS = 1 << 16


def word_count(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_copies: float) -> DataFrame:
    """Word target of each row of `sizes` (source, source_size).

    Sources in code-point order, null last, take `weights` in turn and share the
    sum of all sizes by weight. A target stops at `max_copies` times its source's
    size; what it leaves is shared again by weight among the others, until none
    is above. Returns source, source_size, target."""
    ranked = global_rank(sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], "place")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    # the bounded fixed weights are looked up by place; sources stay a distributed table
    t = saved(ranked.select("source", "source_size", pick.alias("w"),
                            (F.col("source_size") * F.lit(float(max_copies))).alias("most")), "mix-sources")
    total = t.agg(F.sum("source_size")).first()[0] or 0
    left, stopped = float(total), -1
    share = F.lit(0.0)
    # one row comes back per round: the words and weights still to share out
    while True:
        open_w, full, n = t.agg(F.sum(F.when(F.col("most") > share * F.col("w"), F.col("w"))),
                                F.sum(F.when(F.col("most") <= share * F.col("w"), F.col("most"))),
                                F.count(F.when(F.col("most") <= share * F.col("w"), 1))).first()
        if n == stopped or not open_w:
            break
        stopped, left = n, float(total) - (full or 0.0)
        share = F.lit(left / open_w)
    target = F.least(F.col("most"), share * F.col("w"))
    return t.select("source", "source_size", target.alias("target"))


def copies_per_weight(docs: DataFrame, max_copies: float) -> DataFrame:
    """Factor k of each source with sum(size * min(max_copies, k * pref)) = target.

    `docs`: source, target, size, pref. Documents at the maximum are set aside
    and k is solved for the rest, until no further one reaches the maximum (each
    round is one grouped aggregate; the set only grows). Returns source, k."""
    k, before = None, -1
    while True:
        d = docs if k is None else docs.join(k, docs["source"].eqNullSafe(k["k_source"]), "left").drop("k_source")
        at_most = F.lit(False) if k is None else F.col("k") * F.col("pref") >= max_copies
        sums = d.groupBy("source").agg(
            F.max("target").alias("target"),
            F.sum(F.when(at_most, F.col("size") * max_copies).otherwise(0.0)).alias("full"),
            F.sum(F.when(~at_most, F.col("size") * F.col("pref")).otherwise(0.0)).alias("open"),
            F.count(F.when(at_most, 1)).alias("n"))
        new = saved(sums.select(
            F.col("source").alias("k_source"), "n",
            F.when(F.col("open") > 0, F.greatest(F.lit(0.0), F.col("target") - F.col("full")) / F.col("open"))
            .otherwise(F.lit(float("inf"))).alias("k")), "mix-factor")
        n = new.agg(F.sum("n")).first()[0] or 0
        k = new.select("k_source", "k")
        if n == before:
            return k
        before = n


def row_group(docs: DataFrame) -> Column:
    """A hash of what tells a document's row from others: id, source and text. Rows of one
    group are exchangeable, so a decision on its k-th row fits any numbering of them."""
    return F.xxhash64(F.col("doc_id"), F.lit(0), F.col("source").cast("string"), F.lit(1), F.col("text"))


def numbered(df: DataFrame, group: str, out: str) -> DataFrame:
    """Numbers the rows of each `group` from 1. `df` is a saved table; groups are counted
    by its partitions, so that no task holds a whole group."""
    d = df.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    d = saved(d, "mix-numbered")
    counts = d.groupBy(F.col(group).alias("_n_group"), F.col("_part").alias("_n_part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("_n_group").orderBy("_n_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    later = counts.withColumn("_before", before).where(F.col("_before") > 0).drop("n")
    within = F.row_number().over(Window.partitionBy(group, "_part").orderBy("_at"))
    return (d.withColumn("_within", within).join(later, (F.col(group) == F.col("_n_group")) & (F.col("_part") == F.col("_n_part")), "left")
            .withColumn(out, F.col("_within") + F.coalesce("_before", F.lit(0))).drop("_part", "_at", "_within", "_n_group", "_n_part", "_before"))


def decided(docs: DataFrame, weights: tuple[float, ...], max_copies: int, preference: Column | None, seed: int) -> DataFrame:
    """The mix's decision on every row of `docs`: doc_id, group, number (together one row's
    key), size, source_size, target, copies."""
    size = word_count(F.col("text"))
    pref = F.lit(1.0) if preference is None else F.greatest(preference.cast("double"), F.lit(1e-6))
    base = saved(docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"),
                             pref.alias("pref"), row_group(docs).alias("group")), "mix-sizes")
    base = saved(numbered(base, "group", "number"), "mix-documents")
    # a hot source is summed by partial aggregates in the map tasks
    targets = source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_copies)
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    rows = saved(base.join(t, base["source"].eqNullSafe(t["t_source"]), "left").drop("t_source"), "mix-rows")
    k = copies_per_weight(rows, float(max_copies))

    expected = F.least(F.lit(float(max_copies)), F.col("k") * F.col("pref"))
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "group", "number", F.lit(seed)), 11) + F.lit(0.5)) * F.lit(2.0 ** -53)
    p = F.col("expected") - F.col("certain")
    # 1/(1+1/Q) = Q/(1+Q) keeps the order of the Pareto rank Q and lies in [0, 1]; a
    # document without a fraction to draw (a capped source, no words) has no rank
    odds = F.when(p > 0, (F.col("u") * (1 - p)) / (F.col("u") * (1 - p) + (1 - F.col("u")) * p))
    ranked = (rows.join(k, rows["source"].eqNullSafe(k["k_source"]), "left").drop("k_source")
              .withColumn("expected", F.when(F.col("size") > 0, expected).otherwise(F.lit(0.0)))
              .withColumn("certain", F.floor(F.col("expected") + 1e-9))
              .withColumn("u", u).withColumn("q", odds)
              .withColumn("bucket", F.least(F.floor(F.col("q") * RANK_BUCKETS), F.lit(RANK_BUCKETS - 1)).cast("int"))
              .select("doc_id", "source", "size", "source_size", "target", "certain", "q", "bucket", "group", "number"))
    ranked = saved(ranked, "mix-ranked")

    # words by rank bucket: the running sum of a source goes over at most RANK_BUCKETS small rows
    per_bucket = ranked.groupBy("source", "bucket").agg(
        F.sum("size").alias("words"), F.sum(F.col("certain") * F.col("size")).alias("sure"), F.max("target").alias("target"))
    w = Window.partitionBy("source")
    running = (per_bucket
               .withColumn("open", F.max("target").over(w) - F.sum("sure").over(w)).where("bucket is not null")
               .withColumn("before", F.sum("words").over(w.orderBy("bucket")) - F.col("words")))
    edge = saved(running.groupBy("source").agg(
        F.max("open").alias("open"),
        F.max(F.when(F.col("before") <= F.col("open"), F.struct("bucket", "before"))).alias("e"))
        .select(F.col("source").alias("e_source"), "open", F.col("e.bucket").alias("edge"), F.col("e.before").alias("before")), "mix-edge")
    d = ranked.where("q is not null").join(edge, ranked["source"].eqNullSafe(edge["e_source"]), "left").drop("e_source")
    # only the boundary bucket, a RANK_BUCKETS-th of a source, is put in order; there a
    # document is taken while more than half of it lies below the open words
    inside = Window.partitionBy("source", "bucket").orderBy("q", "group", "number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    boundary = (d.where(F.col("bucket") == F.col("edge"))
                .withColumn("upto", F.col("before") + F.sum("size").over(inside))
                .withColumn("extra", (F.col("upto") - F.col("size") / 2.0 <= F.col("open")).cast("int")))
    others = (d.where(F.col("edge").isNull() | (F.col("bucket") != F.col("edge")))
              .withColumn("extra", F.coalesce((F.col("bucket") < F.col("edge")).cast("int"), F.lit(0))))
    cols = ["doc_id", "source", "size", "source_size", "target", "certain", "open", "extra", "q", "group", "number"]
    drawn = saved(others.select(*cols).unionByName(boundary.select(*cols)), "mix-drawn")
    settled = closer(drawn)
    rest = ranked.where("q is null").withColumn("extra", F.lit(0))
    out = ["doc_id", "group", "number", "size", "source_size", "target"]
    copies = F.least(F.lit(max_copies), F.col("certain").cast("int") + F.col("extra"))
    # documents of no words fill nothing and are not taken
    copies = F.when(F.col("size") > 0, copies).otherwise(F.lit(0))
    return settled.select(*out, copies.alias("copies")).unionByName(rest.select(*out, copies.alias("copies")))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_copies: int = 3,
        preference: Column | None = None, seed: int = 11) -> DataFrame:
    """Copies of each document in the mix.

    `docs` needs doc_id, text, source; other columns are ignored. `preference`
    is a positive weight per document (default 1): expected copies follow it.
    Returns doc_id, size, source_size, target, copies, taken (= copies * size), one row
    per row of `docs`.

    A null text or one without words has size 0 and is not taken (copies 0).
    Null sources form one source. Equal ranks fall by a hash of the document. Repeated
    rows and rows with a null doc_id are separate documents, drawn each for itself;
    which of several equal rows a decision falls to is open. An empty table gives
    an empty result. The taken words of a source miss its target by at most half
    the document at the boundary, as a rule by a few words. Reruns with one seed agree."""
    d = decided(docs, weights, max_copies, preference, seed)
    return d.select("doc_id", F.col("size").cast("long").alias("size"), F.col("source_size").cast("long").alias("source_size"),
                    F.col("target").cast("double").alias("target"), "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def closer(drawn: DataFrame, within: float = 0.005) -> DataFrame:
    """Makes good what the boundary documents leave open or overfill.

    In each source further than `within` from its target, one document is taken or
    given back, the one whose size comes closest to the gap; again until no source
    gets closer. A document changes once, and every change makes a gap smaller, so
    this ends. One document's size is small against a large source, so it matters for
    small ones only. Changes are a small table of their own; documents are not rewritten."""
    gap = drawn.groupBy("source").agg((F.max("open") - F.sum(F.col("extra") * F.col("size"))).alias("gap"), F.max("target").alias("target"))
    gap = gap.select(F.col("source").alias("g_source"), "gap", "target")
    key = (F.col("group") == F.col("f_group")) & (F.col("number") == F.col("f_number"))
    changed: DataFrame | None = None
    change = F.when(F.col("extra") == 1, -F.col("size")).otherwise(F.col("size"))
    while True:
        gap = saved(gap.where(F.abs("gap") > F.col("target") * within), "mix-gaps")
        if gap.isEmpty():
            break
        free = drawn.drop("target").where("size > 0")
        if changed is not None:
            free = free.join(changed, key, "left_anti")
        swap = saved(free.join(gap, F.col("source").eqNullSafe(F.col("g_source")))
                     .withColumn("change", change).withColumn("off", F.abs(F.col("gap") - F.col("change"))).where(F.col("off") < F.abs("gap"))
                     .groupBy("g_source", "gap", "target").agg(F.min(F.struct("off", "q", "group", "number", "change")).alias("s"))
                     .select("g_source", "gap", "target", "s.*"), "mix-swaps")
        if swap.isEmpty():
            break
        now = swap.select(F.col("group").alias("f_group"), F.col("number").alias("f_number"))
        changed = now if changed is None else changed.unionByName(now)
        gap = swap.select("g_source", (F.col("gap") - F.col("change")).alias("gap"), "target")
    if changed is None:
        return drawn
    return (drawn.join(changed, key, "left")
            .withColumn("extra", F.when(F.col("f_group").isNotNull(), 1 - F.col("extra")).otherwise(F.col("extra"))).drop("f_group", "f_number"))


def longer_first(text: Column, power: float = 0.25) -> Column:
    """Mild preference for longer documents: words to the power `power`."""
    return F.pow(F.greatest(word_count(text), F.lit(1)).cast("double"), F.lit(power))


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_copies: int = 3,
               preference: Column | None = None, seed: int = 11) -> DataFrame:
    """`docs` with each row as often as the mix takes it, all columns kept; see `mix`.
    Repeated rows and rows with a null doc_id are decided on one by one."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    d = saved(decided(docs, weights, max_copies, preference, seed).select("group", "number", "copies"), "mix-decided")
    size = d.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    several = saved(size.where("n > 1").select(F.col("group").alias("_several")), "mix-several")
    one = d.join(several, F.col("group") == F.col("_several"), "left_anti").where("copies > 0").select(F.col("group").alias("_of"), F.col("copies").alias("_copies"))
    keyed = docs.withColumn("_group", row_group(docs)).hint("shuffle_merge")
    taken = keyed.join(one, F.col("_group") == F.col("_of")).select(*cols, "_copies")
    if not several.isEmpty():
        equal = saved(keyed.join(several, F.col("_group") == F.col("_several"), "left_semi"), "mix-equal")
        of = d.where("copies > 0").select(F.col("group").alias("_of"), F.col("number").alias("_of_number"), F.col("copies").alias("_copies"))
        each = numbered(equal, "_group", "_number").join(of, (F.col("_group") == F.col("_of")) & (F.col("_number") == F.col("_of_number")))
        taken = taken.unionByName(each.select(*cols, "_copies"))
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*cols)
