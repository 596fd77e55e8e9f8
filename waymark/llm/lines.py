"""Line deduplication with a log-template tree, in DataFrame functions only.

Every line walks a fixed path: its number of tokens, then its first `DEPTH` tokens, where a token with a digit
counts as a variable field. Below that leaf stand templates. A line is cut into parts, one token each for lines of up
to `PARTS` tokens, else `PARTS` equal runs of tokens, and belongs to these templates of its leaf: its literal form,
and, from `LEAST_PARTS` parts on, each form in which one part is variable (so at least 0.8 of the parts agree). A
leaf has as many templates as its lines have, whatever other lines stand below it.

A template found in at least `min_docs` documents recurs. A line is assigned to the recurring template of its own
that is found in most documents (ties: the literal form, then the earlier variable part). Of the lines assigned to a
template the first stays (smallest doc_id, then hash of the text, then line number; null ids first), every other is
dropped, so that no text is lost altogether.

Leaves and templates are told apart by two 64-bit hashes together; two different lines are only confused if both
collide. Tokens are separated by spaces. Defined results: null texts stay null; blank lines are no templates and stay;
repeated rows count as one document and are treated alike; a document may end up empty but its row stays; an empty
table stays empty; all other columns pass unchanged, but for those with the names of the two new ones, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, let, materialise, renamed, small_side

DEPTH, PARTS, LEAST_PARTS, MIN_DOCS = 3, 8, 5, 3
#: The variable part of a literal form.
NONE = -1


def _tokens(line: Column) -> Column:
    """Masked tokens of a line, cut at spaces; empty for a blank one."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", "<*>")).otherwise(line)
    return F.array_remove(F.split(masked, " "), "")


def line_table(docs: DataFrame) -> DataFrame:
    """(key, row, line, leaf, n, parts) of every line that has tokens; parts are hashes. docs: key, row, text."""
    lines = docs.select("key", "row", F.posexplode(F.split("text", "\n")).alias("line", "words"))
    lines = lines.where(F.trim("words") != "").select("key", "row", "line", _tokens(F.col("words")).alias("tokens"))
    lines = lines.select("*", F.size("tokens").alias("n"), F.least(F.size("tokens"), F.lit(PARTS)).alias("p"))

    def part(j: Column) -> Column:
        at = F.floor(j * F.col("n") / F.col("p")).cast("int")
        end = F.floor((j + 1) * F.col("n") / F.col("p")).cast("int")
        return F.xxhash64(F.slice("tokens", at + 1, end - at))

    parts = F.transform(F.sequence(F.lit(0), F.col("p") - 1), part)
    return lines.select("key", "row", "line", F.xxhash64("n", F.slice("tokens", 1, DEPTH)).alias("leaf"), "n", parts.alias("parts"))


def candidate_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Lines below leaves that hold at least min_docs lines: no other template can recur."""
    leaves = lines.groupBy("leaf").agg(F.count("*").alias("lines")).where(F.col("lines") >= min_docs)
    # leaves grow with the table: the same plan at every size, in which Spark can split a hot leaf's lines
    return lines.join(materialise(leaves.select("leaf")).hint("merge"), "leaf", "left_semi")


def memberships(lines: DataFrame) -> DataFrame:
    """(key, row, line, leaf, variable, form): every template that a line belongs to; variable numbers the part that may
    vary, which the hash in form covers."""
    p = F.size("parts")
    ends_beyond_the_path = F.filter(
        F.sequence(F.lit(0), p - 1), lambda j: (p >= LEAST_PARTS) & (F.floor((j + 1) * F.col("n") / p) > DEPTH)
    )

    def form(j: Column) -> Column:
        kept = F.transform("parts", lambda h, i: F.when(i == j, F.lit(0).cast("bigint")).otherwise(h))
        return F.struct(j.alias("variable"), F.xxhash64(j, kept).alias("form"))

    every = F.transform(F.concat(F.array(F.lit(NONE)), ends_beyond_the_path), form)
    return lines.select("key", "row", "line", "leaf", F.explode(every).alias("of")).select("key", "row", "line", "leaf", "of.*")


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(key, row, drops): numbers of the lines to drop, for documents that lose any. docs: key, row, text."""
    whole = materialise(line_table(docs))
    lines = materialise(candidate_lines(whole, min_docs))
    template = ["leaf", "form"]
    members = memberships(lines)
    found = members.select(*template, F.xxhash64("key", "row").alias("doc")).distinct().groupBy(*template).agg(F.count("*").alias("docs"))
    found = materialise(found.where(F.col("docs") >= min_docs))
    best = F.max(F.struct("docs", (-F.col("variable")).alias("first"), *template)).alias("best")
    assigned = members.join(small_side(found), template).groupBy("key", "row", "line").agg(best)
    assigned = materialise(assigned.select("key", "row", "line", *[F.col(f"best.{c}").alias(c) for c in template]))
    first = materialise(assigned.groupBy(*template).agg(F.min(F.struct("key", "row", "line")).alias("first")))
    later = assigned.join(small_side(first), template).where(~F.struct("key", "row", "line").eqNullSafe(F.col("first")))
    drops = materialise(later.groupBy("key", "row").agg(F.collect_set("line").alias("drops")))
    forget(whole, lines, found, assigned, first)
    return drops


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, names: tuple[str, str] = ("lines_in_", "lines_out_")
) -> DataFrame:
    """docs with recurring lines taken out of the text, and the numbers of lines before and after (0 for null) appended."""
    docs = docs.drop(*names)
    key_, row, lost = renamed(docs, "key__", "row__", "drops__")
    drops = dropped_lines(docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("row"), F.col(text).alias("text")), min_docs)
    drops = drops.select(F.col("key").alias(key_), F.col("row").alias(row), F.col("drops").alias(lost))
    joined = docs.join(drops, F.col(key).eqNullSafe(F.col(key_)) & (F.xxhash64(text) == F.col(row)), "left")

    def kept(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(lost))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    cut = F.when(F.col(lost).isNull(), F.col(text)).otherwise(let(F.split(text, "\n"), kept))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(F.col(text), "\n")))
    n_drops = F.when(F.col(lost).isNull(), 0).otherwise(F.size(lost))
    return joined.select(
        *[(cut if c == text else F.col(c)).alias(c) for c in docs.columns], n_lines.alias(names[0]), (n_lines - n_drops).alias(names[1])
    )
