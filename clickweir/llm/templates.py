"""Line deduplication by a fixed-depth tree of log templates.

A line goes down the tree by its number of tokens and its leading tokens, in which, as
everywhere, tokens with a digit are variable fields. At the leaf it joins a template, a line
that it equals in at least ``SIMILARITY`` percent of all positions; what differs is a wildcard.

Lines of a leaf are not compared with each other one by one. The positions after the leading
ones are cut into one more subset than positions may differ, so a line and its template
agree in one subset. For each subset a few lines are templates that the others meet on whole
token lists; a line that fits one is done, the others go on with the next templates,
until no subset has two lines left that have not met one. Equal lines are one line from
the start, and leaves that one document alone has are not looked at.

A template recurs if so many documents have it: more for short lines, fewer for long ones
(``required``). Documents are counted by id, copies too. Its lines are dropped everywhere
but in its first place, the smallest document id and line.

Counts combine before they are shuffled, so a line that a third of all documents share
is one row per task, and only hashes are shuffled, beside the distinct lines of shared leaves.

Defined results: null and empty texts have no lines and stay as they are; blank lines are
never dropped. Rows with equal id and text share their place; a null id comes first and is
one document. A text that loses all lines is empty. Lines of fewer than five tokens have
no room for a wildcard and recur as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.frames import position, shielded, unshielded
from clickweir.llm.scratch import Scratch
from clickweir.operators.columns import computed_once
from clickweir.operators.joins import bounded_broadcast
from clickweir.workspace import materialized

LEADING = 3
# A line joins a template if 100 * equal positions >= SIMILARITY * positions.
SIMILARITY = 80
FIELD = "<*>"
# A token with a digit; possessive, so a long token is read once.
DIGITS = "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"
# Documents that a template needs, by the number of tokens it has at least.
DOCUMENTS = ((1, 10), (5, 3), (50, 2))
MORE_TEMPLATES = 8
# Subsets of more lines are dealt to several tasks, about so many in each.
DEAL = 512
BROADCAST_BYTES = 64 * 1024 * 1024


def required(n: Column) -> Column:
    """How many documents a template of ``n`` tokens needs to recur."""
    out = F.lit(None)
    for least, documents in DOCUMENTS:
        out = F.when(n >= least, documents).otherwise(out)
    return out


def tokens(line: Column) -> Column:
    """The tokens of a line, those with a digit as variable fields."""
    plain = F.when(line.rlike("[\t\x0B\f\r]"), F.translate(line, "\t\v\f\r", "    ")).otherwise(line)
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(plain, DIGITS, FIELD)).otherwise(plain)
    return F.array_remove(F.split(masked, " "), "")


def _differing(n: Column) -> Column:
    return F.floor(n * (100 - SIMILARITY) / 100).cast("int")


def _exploded(docs: DataFrame, id_: str, text: str, *more: Column) -> DataFrame:
    return docs.select(F.col(id_).alias("id"), F.xxhash64(text).alias("content"), *more,
                       F.posexplode(F.split(text, "\n")).alias("line", "value"))


def hashed_lines(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """(id, doc, content, line, n, leaf, whole) of the lines that are not blank."""
    cut = computed_once(_exploded(docs, id_, text), "tokens", tokens(F.col("value")))
    n = F.size("tokens")
    return cut.where(n > 0).select(
        "id", F.xxhash64("id").alias("doc"), "content", "line", n.alias("n"),
        F.xxhash64(n, F.slice("tokens", 1, LEADING)).alias("leaf"),
        F.xxhash64(n, "tokens").alias("whole"))


def shared_lines(lines: DataFrame, docs: DataFrame, id_: str, text: str,
                 scratch: Scratch) -> DataFrame:
    """(whole, leaf, n, tokens): distinct lines of leaves that several documents have."""
    able = lines.where(_differing(F.col("n")) > 0)
    leaves = scratch.keep(able.groupBy("leaf").agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"),
        F.min("whole").alias("one"), F.max("whole").alias("other")).where(
        "low < high AND one < other").select("leaf"), "leaves")
    shown = scratch.keep(able.join(bounded_broadcast(leaves, BROADCAST_BYTES), "leaf").groupBy(
        "whole").agg(F.min(F.struct("id", "content", "line")).alias("at")).select(
        "whole", "at.id", "at.content", "at.line"), "shown")
    # The list of one document is bounded by its own lines.
    wanted = scratch.keep(shown.groupBy("id", "content").agg(
        F.collect_list("line").alias("lines")), "wanted")
    of = bounded_broadcast(wanted.select(
        F.col("id").alias("_id"), F.col("content").alias("_content"), "lines"), BROADCAST_BYTES)
    texts = docs.select(F.col(id_).alias("id"), F.col(text).alias("text")).join(
        of, F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_content")))
    cut = computed_once(_exploded(texts, "id", "text", F.col("lines")).where(
        F.array_contains("lines", F.col("line"))), "tokens", tokens(F.col("value")))
    n = F.size("tokens")
    # Repeated rows of a document show a line several times.
    return cut.select(
        F.xxhash64(n, "tokens").alias("whole"),
        F.xxhash64(n, F.slice("tokens", 1, LEADING)).alias("leaf"), n.alias("n"),
        "tokens").dropDuplicates(["whole"])


def _subsets(leaf: Column, words: Column, n: Column) -> Column:
    """Hashes of a line's leaf and the tokens at each subset of its later positions."""
    tail, parts = n - LEADING, _differing(n) + 1

    def subset(k: Column) -> Column:
        begin, end = F.floor(k * tail / parts), F.floor((k + 1) * tail / parts)
        return F.xxhash64(leaf, k, F.slice(words, (begin + LEADING + 1).cast("int"),
                                           (end - begin).cast("int")))

    return F.transform(F.sequence(F.lit(0), parts - 1), subset)


def _least(rows: DataFrame, group: list[str], n: int) -> DataFrame:
    window = Window.partitionBy(*group).orderBy("whole")
    return rows.withColumn("rank", F.row_number().over(window)).where(
        F.col("rank") <= n).drop("rank")


def _in_company(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(subset, whole, deals) of subsets that have several lines."""
    sizes = scratch.keep(rows.groupBy("subset").agg(F.count(F.lit(1)).alias("size")).where(
        "size > 1").select("subset", F.ceil(F.col("size") / DEAL).cast("long").alias("deals")),
        "sizes")
    return scratch.keep(rows.join(bounded_broadcast(sizes, BROADCAST_BYTES), "subset"), "company")


def fitting(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """(whole, template): stored ``lines`` that fit a template, itself the hash of a line."""
    of = lines.select("whole", "tokens")
    waiting = _in_company(lines.select("whole", F.explode(_subsets(
        F.col("leaf"), F.col("tokens"), F.col("n"))).alias("subset")).distinct(), scratch)
    found, templates = lines.select("whole", F.col("whole").alias("template")).limit(0), 1
    while not waiting.isEmpty():
        dealt = waiting.withColumn("deal", F.pmod(F.xxhash64("whole"), "deals"))
        chosen = scratch.keep(
            _least(_least(dealt, ["subset", "deal"], templates), ["subset"], templates).select(
                "subset", F.col("whole").alias("template"), "deals"), "templates")
        everywhere = chosen.select("subset", "template", F.explode(F.sequence(
            F.lit(0).cast("long"), F.col("deals") - 1)).alias("deal"))
        pairs = scratch.keep(dealt.join(everywhere, ["subset", "deal"]).where(
            "template < whole").select("whole", "template").distinct(), "pairs")
        equal = F.size(F.filter(F.zip_with("tokens", "of_template", lambda a, b: a == b),
                                lambda same: same))
        fits = scratch.keep(pairs.join(of, "whole").join(of.select(
            F.col("whole").alias("template"), F.col("tokens").alias("of_template")), "template").where(
            (F.size("tokens") == F.size("of_template"))
            & (100 * equal >= SIMILARITY * F.size("tokens"))).select("whole", "template"), "fits")
        found = found.union(fits)
        used = chosen.select("subset", F.col("template").alias("whole"))
        done = scratch.keep(fits.select("whole").distinct(), "done")
        waiting = _in_company(
            waiting.select("subset", "whole").join(used, ["subset", "whole"], "left_anti").join(
                bounded_broadcast(done, BROADCAST_BYTES), "whole", "left_anti"), scratch)
        templates *= MORE_TEMPLATES
    return found


def dropped_lines(docs: DataFrame, id_: str, text: str, scratch: Scratch) -> DataFrame:
    """(id, content, lines): the numbers of the lines to drop, from 0, per document."""
    lines = scratch.keep(hashed_lines(docs, id_, text), "lines")
    shared = scratch.keep(shared_lines(lines, docs, id_, text, scratch), "shared")
    fits = scratch.keep(fitting(shared, scratch), "fitting")
    own = lines.select("id", "doc", "content", "line", "n", F.col("whole").alias("template"))
    # A template's own line has it by its hash.
    keyed = own.union(lines.join(bounded_broadcast(fits, BROADCAST_BYTES), "whole").select(
        "id", "doc", "content", "line", "n", "template"))
    counted = keyed.groupBy("template", "doc").agg(
        F.min(F.struct("id", "line")).alias("place"), F.first("n").alias("n")).groupBy(
        "template").agg(F.count(F.lit(1)).alias("documents"), F.min("place").alias("first"),
                        F.first("n").alias("n"))
    recurring = scratch.keep(counted.where(
        F.col("documents") >= required(F.col("n"))).select("template", "first"), "recurring")
    elsewhere = ~F.struct("id", "line").eqNullSafe(F.col("first"))
    return keyed.join(bounded_broadcast(recurring, BROADCAST_BYTES), "template").where(
        elsewhere).groupBy("id", "content").agg(
        F.array_sort(F.collect_set("line")).alias("lines"))


def drop_recurring(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the remaining text, and n_lines and n_dropped."""
    scratch = Scratch(docs.sparkSession, "templates")
    # The list of one document is bounded by its own lines.
    dropped = materialized(dropped_lines(docs, id_, text, scratch), "dropped")
    scratch.close()
    rows, names = shielded(docs)
    key, body = position(docs, id_), position(docs, text)
    gone = bounded_broadcast(dropped.select(
        F.col("id").alias("_id"), F.col("content").alias("_content"), "lines"), BROADCAST_BYTES)
    found = rows.withColumn("_hash", F.xxhash64(body)).join(
        gone, F.col(key).eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_content")), "left")
    remaining = F.array_join(F.filter(
        F.split(body, "\n"), lambda _, k: ~F.array_contains("lines", k)), "\n")
    cut = found.withColumns({
        body: F.when(F.col("lines").isNull(), F.col(body)).otherwise(remaining),
        "n_lines": F.coalesce(F.when(F.col(body) != "", F.size(F.split(body, "\n"))), F.lit(0)),
        "n_dropped": F.coalesce(F.size("lines"), F.lit(0)),
    })
    return unshielded(cut, names, docs.columns, F.col("n_lines").cast("long").alias("n_lines"),
                      F.greatest("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))
