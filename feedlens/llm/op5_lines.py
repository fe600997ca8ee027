"""Line dedup by a log-template tree, with DataFrame functions only.

A line is parsed like a log message. Fields with digits become ``<*>``; the
line falls into the leaf of its token count and its first LEADING tokens (the
fixed depth of the tree). In a leaf, lines that agree with the leaf's most
widespread line on SIMILAR of their positions are the same template, the other
positions being variable fields; if asked for, the lines left are compared with
the most widespread ones among them in the same way. Other lines are templates
of their own. If a
template occurs in MIN_DOCS different texts or more, the first document with it
keeps its lines and every document with another text loses them. Documents with
the same text count once and are treated alike.

Positions are compared through one letter per token, made of its ends and its
length, so the rows that are counted and shuffled are short whatever the lines
are; two different tokens can look alike, which SIMILAR allows for. Whole
texts are shuffled once, to meet the line numbers they lose.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import written

MIN_DOCS = 4     # different texts from which a template counts as recurring
LONG = 50        # words from which a line may have a number of texts of its own
MIN_TOKENS = 4   # shorter lines are left alone unless asked for
LEADING = 4      # leading tokens in the tree
SIMILAR = 0.8    # share of positions that lines of a template have in common


def _lines(docs: DataFrame, min_tokens: int) -> DataFrame:
    """(k, t, doc_id, pos, n, long, leaf, form, letters) of every line that is long enough."""
    masked = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", r"\S*[0-9]\S*", "<*>")).otherwise(F.col("line"))
    # counted by its spaces, so that a line is split only once and only if it is long enough
    tokens = F.char_length("line") - F.char_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    taken = tokens >= min_tokens
    if min_tokens < MIN_TOKENS:  # the leaf of a short line is all its tokens, digits and all
        masked = F.when(tokens >= MIN_TOKENS, masked).otherwise(F.col("line"))
        taken &= F.trim("line") != ""
    letter = lambda t: F.char(33 + (
        F.ascii(t) * 31 + F.ascii(F.substring(t, -1, 1)) * 17 + F.char_length(t) * 7) % 94)
    row = ["k", "t", "doc_id", "pos"]
    # repeated spaces make tokens, but no words
    long = F.when(F.size("w") >= LONG, F.size(F.array_remove("w", "")) >= LONG).otherwise(False)
    return docs.select("k", F.xxhash64("text").alias("t"), "doc_id",
                       F.posexplode(F.split(F.translate(F.coalesce("text", F.lit("")), "\t\r", "  "), "\n"))
                       .alias("pos", "line")) \
        .where(taken) \
        .select(*row, F.split(masked, " ").alias("w")).select(*row, F.size("w").alias("n"), long.alias("long"), "w") \
        .select(*row, "n", "long", F.xxhash64("n", F.slice("w", 1, LEADING)).alias("leaf"), F.xxhash64("w").alias("form"),
                F.array_join(F.transform("w", letter), "").alias("letters"))


def _templates(forms: DataFrame, enough: Column, all_templates: bool) -> DataFrame:
    """(leaf, form, template, long) of the forms of leaves with ``enough`` texts.

    The first center of a leaf is its most widespread form, and the only one
    unless ``all_templates``. Then, among the forms it does not take, every form that is the most widespread one in all of its
    blocks is a center, until no two forms left share a block. Blocks: similar
    lines differ in at most a fifth of their positions, so if the positions are
    dealt to one block more, they agree on all letters of one block at least.
    """
    # the most widespread form, the earliest of several
    order = F.struct("docs", (-F.col("at.doc_id")).alias("d"), (-F.col("at.pos")).alias("p"), "form", "letters")
    leaves = forms.groupBy("leaf").agg(F.sum("docs").alias("all_docs"), F.max("long").alias("long"), F.max(order).alias("top")) \
        .where(F.col("all_docs") >= enough).drop("all_docs", "long")
    same = F.size(F.filter(F.zip_with(F.split("letters", ""), F.split("top.letters", ""), lambda a, b: a == b),
                           lambda x: x))
    similar = (F.col("form") == F.col("top.form")) | (same >= SIMILAR * F.col("n"))
    row = ["leaf", "form", "n", "long", "letters", "docs", "at"]
    first = written(forms.join(leaves, "leaf").select(*row, F.when(similar, F.col("top.form")).alias("template")), "centers")
    known = [first.where("template IS NOT NULL").select("leaf", "form", "template", "long")]
    rest = first.where("template IS NULL").select(row)
    # letters behind the leading ones, which all forms of a leaf share, dealt to blocks in turn
    blocks = F.floor(F.col("n") * (1 - SIMILAR) + 1e-6).cast("int") + 1
    dealt = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(b.alias("b"), F.xxhash64(F.array_join(
        F.filter(F.split(F.substring("letters", LEADING + 1, 1 << 30), ""), lambda x, i: i % blocks == b), "")).alias("key")))
    while all_templates:
        # leaves whose forms left have too few texts are through, and so are forms that share no block
        left = rest.groupBy("leaf").agg(F.sum("docs").alias("all_docs"), F.max("long").alias("long")) \
            .where(F.col("all_docs") >= enough).select("leaf")
        keyed = rest.join(left, "leaf", "left_semi").select(*row, F.explode(dealt).alias("block")) \
            .select(*row, "block.b", "block.key")
        tops = keyed.groupBy("leaf", "n", "b", "key").agg(F.count("*").alias("c"), F.max(order).alias("top"))
        near = written(keyed.join(tops, ["leaf", "n", "b", "key"]).select(*row, "c", "top", similar.alias("similar")), "near")
        alone = near.groupBy("leaf", "form").agg(F.max("c").alias("c"), F.bool_and(F.col("top.form") == F.col("form")).alias("center"))
        alone = written(alone, "alone")
        shared = alone.where("c > 1").select("leaf", "form")
        if shared.isEmpty():
            break
        centers = alone.where("center AND c > 1").select("leaf", F.col("form").alias("template"))
        taken = near.where("similar").select("leaf", "form", "long", "top", F.col("top.form").alias("template")) \
            .join(centers, ["leaf", "template"], "left_semi") \
            .groupBy("leaf", "form", "long").agg(F.max("top").alias("top")) \
            .select("leaf", "form", F.col("top.form").alias("template"), "long")
        taken = written(taken, "taken")
        known.append(taken)
        rest = written(rest.join(shared, ["leaf", "form"], "left_semi").join(taken, ["leaf", "form"], "left_anti"), "rest")
    # what no center has taken is a template of its own
    own = first.where("template IS NULL").select("leaf", "form", F.col("form").alias("template"), "long")
    for taken in known[1:]:
        own = own.join(taken, ["leaf", "form"], "left_anti")
    return reduce(DataFrame.unionByName, known).unionByName(own)


def recurring_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS, long_docs: int = MIN_DOCS,
                    all_templates: bool = False) -> DataFrame:
    """(k, drop): the numbers of the lines that each document ``k`` loses."""
    enough = F.when(F.col("long"), long_docs).otherwise(MIN_DOCS)
    lines = written(_lines(docs, min_tokens), "lines")
    forms = lines.groupBy("leaf", "form", "n", "long", "letters", "t").agg(F.min(F.struct("doc_id", "pos")).alias("at")) \
        .groupBy("leaf", "form", "n", "long", "letters").agg(F.count("*").alias("docs"), F.min("at").alias("at"))
    forms = written(forms, "forms")
    known = _templates(forms, enough, all_templates)
    hits = written(lines.select("k", "t", "doc_id", "pos", "leaf", "form").join(known, ["leaf", "form"])
                   .select("k", "t", "doc_id", "pos", "leaf", "template", "long"), "hits")
    # the first document: smallest doc_id, null last, then smallest hash
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")
    often = hits.groupBy("leaf", "template", "t").agg(F.min(rank).alias("first"), F.max("long").alias("long")) \
        .groupBy("leaf", "template").agg(F.count("*").alias("docs"), F.min("first").alias("first"),
                                         F.max("long").alias("long")).where(F.col("docs") >= enough) \
        .select("leaf", "template", F.col("first.t").alias("keeper"))
    often = written(often, "recurring")  # so that the join below can split a very common template
    return hits.join(often, ["leaf", "template"]).where("t != keeper") \
        .groupBy("k").agg(F.collect_set("pos").alias("drop"))


def drop_recurring(docs: DataFrame, min_tokens: int = MIN_TOKENS, long_docs: int = MIN_DOCS,
                   all_templates: bool = False) -> DataFrame:
    """``docs`` with the recurring lines gone from ``text``, plus n_lines and
    n_dropped (longs).

    Needs ``doc_id`` and ``text``; other columns are carried along, unless they
    bear the name of one of the two counts, which then replaces them. A null text
    stays null (0 lines), an empty one is one empty line. Rows alike in doc_id
    and text are one document and are treated alike. Texts never gain or
    reorder lines; a text that loses all lines is empty. An empty table gives
    an empty result.

    Lines of fewer than ``min_tokens`` tokens stay. Below MIN_TOKENS, shorter
    lines are counted by their exact words, and blank lines always stay. A
    template of LONG words or more recurs from ``long_docs`` texts on.
    A leaf has one template with variable fields, or with ``all_templates`` any number.
    """
    keyed = docs.drop("n_lines", "n_dropped")
    names = keyed.columns
    key = F.xxhash64("doc_id", "text").alias("__k")
    drops = recurring_lines(keyed.select(key.alias("k"), "doc_id", "text"), min_tokens, long_docs, all_templates).withColumnRenamed("k", "__k") \
        .withColumnRenamed("drop", "__drop")
    split = F.split("text", "\n")
    kept = F.filter(split, lambda x, i: ~F.array_contains("__drop", i))
    # a hash join, so that the texts need not be sorted
    return keyed.select("*", key).join(drops.hint("shuffle_hash"), "__k", "left").select(
        *[F.when(F.col("__drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")
          if c == "text" else F.col(f"`{c}`") for c in names],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped"))
