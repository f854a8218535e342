"""Personal data by generators of candidates and boosted trees.

Generators with a high recall propose spans for the kinds email, ip, card and phone; they
overlap each other. Boosted trees score a proposal by its format (digits, groups,
separators, check digit, ranges) and its context (the characters beside it and the text
before it). What the strict rules of a kind accept is redacted in any case, and it serves
as the labels: a proposal that meets a strict span of its kind is a positive, one that
meets a strict span of another kind a negative, and the others are unlabelled. Scores are
calibrated for positives that have no label: the mean score c of held-out positives is
what a sure positive gets, so a proposal's probability is score / c.

Texts are matched in one pass; what follows works on the matches alone. Places come from
the lengths of the pieces between matches, summed by a window over a document's matches.
Patterns are possessive and anchored at the start of a run, so that long runs of digits or
letters cost linear time and no stack. Only DataFrame and SQL functions are used, and the
trees of Spark's own library.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.quantiles import grouped_quantiles
from ..session import saved

KINDS = ("email", "ip", "card", "phone")
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

# the strict rules: leftmost matches per kind, which may fail a check afterwards
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# the generators: spelled-out addresses, four groups with other dots, grouped and plain
# runs of digits, national and international numbers
LOOSE = (
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)[A-Za-z0-9-]++"
              r"(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9])[0-9]{1,3}(?:\[\.\]|\(\.\)|\.|,)[0-9]{1,3}(?:\[\.\]|\(\.\)|\.|,)[0-9]{1,3}(?:\[\.\]|\(\.\)|\.|,)[0-9]{1,3}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20.-][0-9]{4}){3}(?![0-9])"),
    ("phone", r"(?<![0-9+])\+?[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])"),
    ("phone", r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
)


# words before personal data that tell its kind
CUES = (r"mail|contact|write", r"call|tel|phone|fax|mobil|ring", r"card|visa|pay|credit|debit", r"^ip$|host|server|address")


class Settings(NamedTuple):
    """Half of all proposals fit the trees, the others calibrate them. A proposal is redacted
    at a probability of `sure` or more, and never below the score that `spared` of the
    held-out negatives of its kind stay under."""
    trees: int = 20
    depth: int = 4
    rate: float = 0.2
    sure: float = 0.5
    spared: float = 0.999


def luhn(digits: Column) -> Column:
    """Whether a string of digits has the right check digit."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def is_card(hit: Column) -> Column:
    d = digits_of(hit)
    return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False))


def is_ip(hit: Column) -> Column:
    return hit.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")


def is_phone(hit: Column) -> Column:
    return F.length(digits_of(hit)).between(8, 15)


def strictly(kind: Column, hit: Column) -> Column:
    """Whether a match of a kind's strict pattern passes its check."""
    return (F.when(kind == "ip", is_ip(hit)).when(kind == "card", is_card(hit)).when(kind == "phone", is_phone(hit)).otherwise(F.lit(True)))


def matched(docs: DataFrame) -> DataFrame:
    """key (one per row), doc_id and the matches of all patterns, those that have any: the
    match, the length and the last characters of what lies before it and the first
    characters after it. Texts without a digit or an at-sign are not looked at."""
    text = F.when(F.col("text").rlike(r"[0-9@]|[\[(](?:at|AT)[\])]"), F.col("text"))
    patterns = [(k, p, True) for k, p in STRICT.items()] + [(k, p, False) for k, p in LOOSE]
    piece = lambda x: F.struct(F.length(x).alias("skip"), F.right(x, F.lit(40)).alias("tail"), F.left(x, F.lit(2)).alias("head"))
    # columns of their own, so that no pattern is matched again where its matches are used
    d = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id",
                    *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"hits{i}") for i, (_, p, _) in enumerate(patterns)],
                    *[F.transform(F.split(text, p, -1), piece).alias(f"pieces{i}") for i, (_, p, _) in enumerate(patterns)])

    def rows(i: int, kind: str, strict: bool) -> Column:
        hits, pieces = F.col(f"hits{i}"), F.col(f"pieces{i}")
        before = F.zip_with(hits, F.slice(pieces, F.lit(1), F.size(hits)), lambda h, p: F.struct(h.alias("hit"), p["skip"].alias("skip"), p["tail"].alias("tail")))
        every = F.zip_with(before, F.slice(pieces, F.lit(2), F.size(hits)), lambda b, p: F.struct(b["hit"].alias("hit"), b["skip"].alias("skip"), b["tail"].alias("tail"), p["head"].alias("head")))
        return F.struct(F.lit(kind).alias("kind"), F.lit(strict).alias("strict"), every.alias("rows"))

    found = F.filter(F.array(*[rows(i, k, strict) for i, (k, _, strict) in enumerate(patterns)]), lambda m: F.size(m["rows"]) > 0)
    return d.select("key", "doc_id", found.alias("found"))


def spans(found: DataFrame) -> DataFrame:
    """(key, kind, strict, start, stop, hit, tail, head), start and stop in code points,
    of the matches in `found`."""
    one = found.select("key", F.posexplode("found").alias("pattern", "m"))
    one = one.select("key", "pattern", F.col("m.kind").alias("kind"), F.col("m.strict").alias("strict"), F.posexplode("m.rows").alias("at", "r"))
    one = one.select("key", "pattern", "kind", "strict", "at", "r.hit", "r.skip", "r.tail", "r.head", F.length("r.hit").cast("long").alias("size"))
    w = Window.partitionBy("key", "pattern").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = one.withColumn("stop", F.sum(F.col("skip") + F.col("size")).over(w)).withColumn("start", F.col("stop") - F.col("size"))
    return placed.select("key", "kind", "strict", "start", "stop", "hit", "tail", "head")


def judged(all_spans: DataFrame) -> DataFrame:
    """The proposals with `own` and `other`: whether one meets a strict span of its own
    kind, or of another one. Strict spans of a kind do not overlap, so the furthest end of
    those that start before a proposal's end tells."""
    event = F.when(F.col("strict"), F.col("start")).otherwise(F.col("stop"))
    w = Window.partitionBy("key").orderBy("event", "strict").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = all_spans.withColumn("event", event)
    d = d.select("*", *[F.max(F.when(F.col("strict") & (F.col("kind") == k), F.col("stop"))).over(w).alias(f"to_{k}") for k in KINDS])
    meets = lambda k: F.coalesce(F.col(f"to_{k}") > F.col("start"), F.lit(False))
    own = reduce(lambda a, k: a.when(F.col("kind") == k, meets(k)), KINDS, F.when(F.lit(False), F.lit(False)))
    other = reduce(lambda a, k: a | ((F.col("kind") != k) & meets(k)), KINDS, F.lit(False))
    return d.withColumn("own", own).withColumn("other", other).where(~F.col("strict")).drop("event", *[f"to_{k}" for k in KINDS])


def features() -> Column:
    """Format and context of a proposal (kind, hit, tail, head). Digits before a
    proposal are passed over: they are why the strict rules miss one, so they would tell
    the label."""
    hit, tail, head = F.col("hit"), F.col("tail"), F.col("head")
    groups = F.filter(F.split(hit, "[^0-9]+"), lambda g: g != "")
    digits = digits_of(hit)
    last, word = F.right(tail, F.lit(1)), F.lower(F.regexp_extract(tail, r"([A-Za-z]+)[^A-Za-z]*$", 1))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    first = F.left(head, F.lit(1))
    fmt = [F.length(hit), F.length(digits), F.size(groups), F.length(F.coalesce(F.try_element_at(groups, F.lit(1)), F.lit(""))),
           F.length(F.coalesce(F.try_element_at(groups, F.lit(-1)), F.lit(""))), F.length(F.regexp_replace(hit, "[^A-Za-z]", ""))]
    checks = [is_card(hit), is_ip(hit), hit.startswith("+"), hit.contains("@"), hit.contains("("), hit.contains("["), hit.contains(" "), hit.contains("-"),
              hit.contains("."), hit.contains(",")]
    beside = [last.rlike(r"[A-Za-z0-9]"), last.rlike(r"[\"'=:#/_.,+-]"), tail == "", first.rlike(r"[A-Za-z0-9]"), first.rlike(r"[\"'/_@+-]"), head == "",
              *[word.rlike(w) for w in CUES]]
    before = [F.length(word)]
    kinds = [F.col("kind") == k for k in KINDS]
    return array_to_vector(F.array(*[c.cast("double") for c in fmt + before], *[flag(c) for c in checks + beside + kinds]))


class Model(NamedTuple):
    trees: GBTClassificationModel
    least: dict[str, float]  # per kind, the score from which a proposal is redacted


def fitted(proposals: DataFrame, s: Settings) -> Model | None:
    """Trees and thresholds from all proposals; None if positives or others are missing. A
    hash tells near halves of them apart: one fits the trees, the other calibrates."""
    h = F.xxhash64("hit", "tail", "head", "kind", F.lit(5))
    # the last bit of the hash shifted, as the halves have always been told apart
    known = saved(proposals.select("kind", "own", "other", "x", F.col("own").cast("double").alias("label"),
                                   (F.pmod(F.shiftrightunsigned(h, 1), F.lit(2)) == 0).alias("fit")), "pii-labelled")
    if known.where("fit").select("label").distinct().count() < 2:
        return None
    trees = GBTClassifier(featuresCol="x", labelCol="label", maxIter=s.trees, maxDepth=s.depth, stepSize=s.rate, seed=7).fit(known.where("fit").select("x", "label"))
    held = saved(scored(known.where("not fit"), trees).drop("x"), "pii-held")
    sure = {r["kind"]: r["c"] for r in held.where("own").groupBy("kind").agg(F.avg("score").alias("c")).collect()}
    spared = {r["kind"]: r["value"] for r in grouped_quantiles(held.where("not own and other"), ["kind"], ["score"], [s.spared]).collect()}
    return Model(trees, {k: max(s.sure * c, (spared.get(k) or 0.0) + 1e-9) for k, c in sure.items()})


def scored(proposals: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    """`proposals` with `score`, the trees' probability of a labelled positive."""
    return trees.transform(proposals).withColumn("score", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def redactions(all_spans: DataFrame, s: Settings) -> DataFrame:
    """(key, kind, start, stop, strict): the strict spans and the selected proposals. Of
    selected proposals that overlap, the longest stays, of equal ones that with the
    highest score, the first kind, the first place."""
    strict = all_spans.where("strict").select("key", "kind", "start", "stop", "strict")
    proposals = saved(judged(all_spans).withColumn("x", features()), "pii-proposals")
    model = fitted(proposals, s)
    if model is None:
        return strict
    least = reduce(lambda a, k: a.when(F.col("kind") == k, F.lit(model.least.get(k, 2.0))), KINDS, F.when(F.lit(False), F.lit(2.0)))
    # a proposal beside a strict span of its kind is that span, seen by another pattern
    new = scored(proposals.where(~F.col("own") & ~F.col("other")), model.trees).where(F.col("score") >= least)
    new = saved(new.select("key", "kind", "start", "stop", "strict", "score").distinct(), "pii-selected")
    # proposals that hang together by overlap form a chain; its longest one stays, and what does not touch that
    rank = [F.desc(F.col("stop") - F.col("start")), F.desc("score"), F.col("kind"), F.col("start")]
    kept, left = None, new
    while True:
        w = Window.partitionBy("key").orderBy("start", "stop", "kind")
        begins = F.coalesce(F.col("start") >= F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int")
        chain = left.withColumn("begins", begins).withColumn("chain", F.sum("begins").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        best = chain.withColumn("place", F.row_number().over(Window.partitionBy("key", "chain").orderBy(*rank)))
        best = best.withColumn("b_start", F.max(F.when(F.col("place") == 1, F.col("start"))).over(Window.partitionBy("key", "chain")))
        best = saved(best.withColumn("b_stop", F.max(F.when(F.col("place") == 1, F.col("stop"))).over(Window.partitionBy("key", "chain"))), "pii-best")
        won = best.where("place = 1").select(*left.columns)
        kept = won if kept is None else kept.unionByName(won)
        left = best.where("place > 1 and (stop <= b_start or start >= b_stop)").select(*left.columns)
        if left.isEmpty():
            return strict.unionByName(kept.select(*strict.columns))


def listed(kinds: Column) -> Column:
    """Place of a kind in the list of kinds."""
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kinds)


def personal_data(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Spans of personal data of every document, one row per row of `docs`: doc_id,
    n_email, n_ip, n_card, n_phone (spans of the strict rules), base_sha256 (of those,
    kind:start:end joined by commas, by kind and start), spans (all spans, the trees' ones
    too, written likewise) and found (the same as an array of kind, start, stop).

    Starts and ends are code points, the end exclusive. `docs` needs doc_id and text; other
    columns are ignored. A null or empty text has no spans. Repeated rows and null ids come
    out one row each. Without positives or without other proposals in the fitting half no trees
    are fitted and the strict spans are the result. Of selected proposals
    that overlap the longest stays. An empty table gives an empty result. Texts are matched
    whole; a document's matches are placed by one window."""
    found = saved(matched(docs.select("doc_id", "text")), "pii-matches")
    every = spans(found.where(F.size("found") > 0))
    # checks once; matches that fail them are dropped
    every = saved(every.where(~F.col("strict") | strictly(F.col("kind"), F.col("hit"))), "pii-spans")
    chosen = redactions(every, settings)
    item = F.struct(listed(F.col("kind")).alias("at"), "start", "stop", "kind", "strict")
    per = saved(chosen.groupBy("key").agg(F.sort_array(F.collect_list(item)).alias("all")).select(F.col("key").alias("p_key"), "all"), "pii-chosen")
    d = found.select("key", "doc_id").join(per.hint("shuffle_merge"), F.col("key") == F.col("p_key"), "left")
    every_span = F.coalesce("all", F.array().cast("array<struct<at:bigint,start:bigint,stop:bigint,kind:string,strict:boolean>>"))
    base = F.filter(every_span, lambda x: x["strict"])
    text = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
    is_kind = lambda k: lambda x: x["kind"] == k
    return d.select("doc_id", *[F.size(F.filter(base, is_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS],
                    F.sha2(F.encode(text(base), "UTF-8"), 256).alias("base_sha256"), text(every_span).alias("spans"),
                    F.transform(every_span, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"))).alias("found"))


def masked(text: Column, found: Column) -> Column:
    """The text with each stretch of found spans replaced by its first span's <KIND>."""
    order = F.sort_array(F.transform(found, lambda x: F.struct(x["start"].alias("start"), (-x["stop"]).alias("back"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a, x):
        piece = F.concat(F.substring(text, (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), F.lit("<"), F.upper(x["kind"]), F.lit(">"))
        out = F.when(x["start"] >= a["at"], F.concat(a["out"], F.array(piece))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], -x["back"]).alias("at"), out.alias("out"))

    return F.aggregate(order, start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
