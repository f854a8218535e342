"""Line dedup by a log-template tree of fixed depth.

A line goes down the tree by its number of tokens and its first `lead` tokens,
where tokens with digits count as a variable field. In a leaf, a token stays part
of the template if it recurs at its position in lines of different documents; the
other positions are variable fields. Tokens with digits recur as a field: it counts as
matched in lines that also have a recurring word. A line of recurring tokens without
one (numbers, table rows) is a template of its own, so that it takes the very same
line to recur. Lines whose template recurs across many
documents are dropped from all of them.

Copies of one document repeat all its lines, which makes none of them a
template: recurrence is counted over families of documents, told apart by what is
rare: the smallest hash of a document's leaves that fewer than `min_families`
different documents hold. Documents that share some rare leaves may or may not fall
into one family, so families are told apart in several ways and the largest count
holds. A document without a rare leaf is told apart by all its leaves, so that near
copies of it, which differ inside their lines only, stay one family.

Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import saved

BLANKS = r"[\x20\x09-\x0D]+"
FIELD = "<*>"
LEAD, MIN_TOKENS = 3, 1
# a template needs so many families and so large a part of constant or, beside a word, matched tokens
MIN_FAMILIES, CONSTANT_SHARE = 8, 0.6
# least part that the families are of a template's documents: 0, however many copies one of them has
FAMILY_SHARE = 0.0
# ways to tell families apart
WAYS = 4


def tokens_of(line: Column) -> Column:
    """Tokens of a line; a blank one has one empty token."""
    return F.split(F.btrim(line, F.lit(" \t\n\x0b\f\r")), BLANKS)


def leaf_of(tokens: Column, lead: int = LEAD) -> Column:
    """Leaf of a line in the tree, by token count and leading tokens."""
    # tried at the start of a token only: linear in a long one
    path = F.regexp_replace(F.array_join(F.slice(tokens, 1, lead), " "), r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", FIELD)
    return F.xxhash64(F.size(tokens), path)


def text_key(text: Column) -> Column:
    """What happens to a line depends on its text alone, so equal texts share one key."""
    return F.xxhash64(text)


def parsed(docs: DataFrame, lead: int, min_tokens: int) -> DataFrame:
    """(text_key, pos, leaf) of every line; leaf is null for blank lines and those that
    have too few tokens."""
    lines = docs.select(text_key(F.col("text")).alias("text_key"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    tokens = lines.select("text_key", "pos", tokens_of(F.col("line")).alias("tokens"))
    takes_part = (F.size("tokens") >= min_tokens) & (F.element_at("tokens", 1) != "")
    return tokens.select("text_key", "pos", F.when(takes_part, leaf_of(F.col("tokens"), lead)).alias("leaf"))


def by_line(marks: DataFrame, value: str, out: str) -> DataFrame:
    """(m_key, `out`): for each text key in `marks` (text_key, pos, value; a row for every
    line, also several equal ones) the values of its lines in order."""
    each = marks.groupBy("text_key", "pos").agg(F.max(value).alias(value))
    lists = each.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("pos", value))).alias(out))
    return lists.select(F.col("text_key").alias("m_key"), F.transform(out, lambda x: x[value]).alias(out))


def whole_of(leaves: DataFrame) -> DataFrame:
    """(f_key, whole): a hash of all leaves of a text, which near copies of it share."""
    h = F.xxhash64("leaf")
    sums = leaves.select("text_key", "pos", "leaf").distinct().groupBy("text_key").agg(F.sum(h.bitwiseAND(F.lit(0x7FFFFFFF))).alias("low"), F.sum(F.shiftrightunsigned(h, 32)).alias("high"))
    return sums.select(F.col("text_key").alias("f_key"), F.xxhash64("low", "high").alias("whole"))


def families(wholes: DataFrame, held: DataFrame, common: DataFrame) -> DataFrame:
    """`wholes` with `family`: for each way to tell families apart, the smallest hash of
    the leaves held that are not common; the hash of all leaves where none is left."""
    rare = held.join(common.hint("shuffle_merge"), F.col("leaf") == F.col("b_leaf"), "left_anti")
    least = [F.min(F.xxhash64("leaf", F.lit(way))) for way in range(WAYS)]
    own = saved(rare.groupBy("whole").agg(F.array(*least).alias("own")).withColumnRenamed("whole", "o_whole"), "lines-own")
    d = wholes.join(own.hint("shuffle_merge"), F.col("whole") == F.col("o_whole"), "left").drop("o_whole")
    return d.withColumn("family", F.coalesce("own", F.array_repeat("whole", WAYS))).drop("own")


def recurring_lines(docs: DataFrame, lead: int = LEAD, min_tokens: int = MIN_TOKENS, min_families: int = MIN_FAMILIES,
                    family_share: float = FAMILY_SHARE, constant_share: float = CONSTANT_SHARE) -> DataFrame:
    """(text_key, pos, template): the lines of recurring templates, once for equal texts."""
    every = saved(parsed(docs, lead, min_tokens), "lines-leaves")
    leaves = every.where("leaf is not null")
    wholes = saved(whole_of(leaves), "lines-wholes")
    held = saved(leaves.join(wholes.hint("shuffle_merge"), F.col("text_key") == F.col("f_key")).select("leaf", "whole").distinct(), "lines-held")
    # leaves that cannot hold a recurring template end here: most lines are not looked at again
    busy = saved(held.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_families)
                 .select(F.col("leaf").alias("b_leaf")), "lines-busy")
    known = saved(families(wholes, held, busy), "lines-families")
    # a text's lines and their busy leaves, line by line: nothing is looked up in a list
    marked = saved(every.join(busy.hint("shuffle_merge"), F.col("leaf") == F.col("b_leaf"), "left").select("text_key", "pos", "b_leaf"), "lines-marked")
    some = marked.where("b_leaf is not null").select(F.col("text_key").alias("s_key")).distinct()
    at = by_line(marked.join(some.hint("shuffle_merge"), F.col("text_key") == F.col("s_key"), "left_semi"), "b_leaf", "leaves")
    with_at = docs.select(text_key(F.col("text")).alias("text_key"), "text").join(at.hint("shuffle_merge"), F.col("text_key") == F.col("m_key"))
    one = with_at.select("text_key", F.posexplode(F.arrays_zip(F.split("text", "\n").alias("line"), F.col("leaves").alias("leaf"))).alias("pos", "x"))
    live = one.where("x.leaf is not null").select("text_key", "pos", F.col("x.leaf").alias("leaf"), tokens_of(F.col("x.line")).alias("tokens"))
    live = saved(live.join(known.hint("shuffle_merge"), F.col("text_key") == F.col("f_key")).drop("f_key"), "lines-live")

    # equal lines are put together before tokens are counted by position
    distinct = saved(live.groupBy("leaf", "tokens").agg(F.count(F.lit(1)).alias("n"), F.min("whole").alias("lo"), F.max("whole").alias("hi"))
                     .withColumn("line", F.md5(F.encode(F.concat_ws("\n", F.col("leaf").cast("string"), "tokens"), "UTF-8"))), "lines-distinct")
    token = distinct.select("line", "leaf", "n", "lo", "hi", F.posexplode("tokens").alias("at", "token"))
    token = token.withColumn("key", F.when(F.col("token").rlike(r"[0-9]"), F.lit(FIELD)).otherwise(F.col("token")))
    constant = saved(token.groupBy("leaf", "at", "key")
                     .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
                     .where((F.col("n") >= min_families) & (F.col("lo") < F.col("hi")))
                     .select(F.col("leaf").alias("c_leaf"), F.col("at").alias("c_at"), F.col("key").alias("c_key")), "lines-constant")
    seen = token.join(constant, (F.col("leaf") == F.col("c_leaf")) & (F.col("at") == F.col("c_at")) & (F.col("key") == F.col("c_key")), "left")
    matched = F.col("c_key").isNotNull()
    fixed = matched & (F.col("key") != FIELD)
    template = (seen.groupBy("line").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("c_key", F.lit(FIELD)).alias("t")))).alias("parts"),
                                         F.avg(fixed.cast("int")).alias("constant"), F.avg(matched.cast("int")).alias("matched"),
                                         F.max(fixed & F.col("key").rlike(r"\p{L}")).alias("worded"))
                .withColumn("general", (F.col("constant") >= constant_share) | (F.col("worded") & (F.col("matched") >= constant_share)))
                .where(F.col("general") | (F.col("matched") == 1))
                .select(F.col("line").alias("t_line"), F.when(F.col("general"), F.array_join(F.col("parts.t"), " ")).alias("template")))
    of_line = saved(distinct.join(template, F.col("line") == F.col("t_line"))
                    .select(F.col("leaf").alias("l_leaf"), F.col("tokens").alias("l_tokens"),
                            F.coalesce("template", F.array_join("tokens", " ")).alias("template")), "lines-templates")
    found = saved(live.join(of_line.hint("shuffle_merge"), (F.col("leaf") == F.col("l_leaf")) & (F.col("tokens") == F.col("l_tokens")))
                  .select("text_key", "pos", "family", "template"), "lines-found")

    docs_of = saved(found.select("template", "text_key", "family").distinct(), "lines-docs")
    spread = (docs_of.select("template", F.posexplode("family").alias("way", "family"))
              .groupBy("template", "way", "family").agg(F.count(F.lit(1)).alias("docs"))
              .groupBy("template", "way").agg(F.count(F.lit(1)).alias("families"), F.sum("docs").alias("docs"))
              .groupBy("template").agg(F.max("families").alias("families"), F.max("docs").alias("docs")))
    recurring = saved(spread.where((F.col("families") >= min_families) & (F.col("families") >= F.col("docs") * family_share))
                      .select(F.col("template").alias("r_template")), "lines-recurring")
    return found.join(recurring.hint("shuffle_merge"), F.col("template") == F.col("r_template"), "left_semi").select("text_key", "pos", "template").distinct()


def drop_recurring(docs: DataFrame, **settings) -> DataFrame:
    """`docs` with the lines of recurring templates taken out of `text`, and the columns
    n_lines and n_dropped; other columns stay.

    `docs` needs text; a column that is called n_lines or n_dropped is replaced. Lines end
    at \\n. Blank lines and lines of fewer than `min_tokens` tokens are never dropped. A
    null text stays null with no lines; an empty text has one empty line. A document that
    loses all lines keeps an empty text. Equal texts lose the same lines, so repeated rows
    and rows with a null or repeated doc_id need no rule of their own. Pages that differ
    in numbers only are one family. An empty table gives an empty result. The cost of a
    text is linear in its lines."""
    cols = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    lost = saved(recurring_lines(docs.select("text"), **settings).select("text_key", "pos", F.lit(True).alias("gone")), "lines-lost")
    # the texts that lose lines, with a mark for each of their lines
    some = lost.select(F.col("text_key").alias("s_key")).distinct()
    whole = docs.select(text_key(F.col("text")).alias("text_key"), F.size(F.split("text", "\n")).alias("n")).distinct()
    whole = whole.join(some.hint("shuffle_merge"), F.col("text_key") == F.col("s_key"), "left_semi")
    each = whole.select("text_key", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("pos"), F.lit(False).alias("gone"))
    marks = saved(by_line(each.unionByName(lost), "gone", "_gone"), "lines-marks")
    d = docs.select(*[F.col(f"`{c}`") for c in cols]).join(marks.hint("shuffle_merge"), text_key(F.col("text")) == F.col("m_key"), "left")
    lines = F.split("text", "\n")
    # a null line is left out of the joined text
    kept = F.array_join(F.zip_with(lines, F.col("_gone"), lambda x, gone: F.when(~gone, x)), "\n")
    d = d.withColumn("n_lines", F.coalesce(F.when(F.col("text").isNotNull(), F.size(lines)), F.lit(0)))
    d = d.withColumn("n_dropped", F.coalesce(F.when(F.col("_gone").isNotNull(), F.size(F.filter("_gone", lambda x: x))), F.lit(0)))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept)
    return d.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in cols], "n_lines", "n_dropped")
