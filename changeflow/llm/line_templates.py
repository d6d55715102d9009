"""Line dedup with a log-template tree of fixed depth.

A line goes down the tree by its number of tokens and its leading tokens to a leaf. In a leaf, a token that several
documents have at its place is constant, any other is a variable field; tokens with digits are variable everywhere. A line
becomes the template of its constants if these are most of the tokens behind the leading ones, else its own text is its
template. A line with no token behind the leading ones is judged by all of its tokens. Templates that recur across documents are dropped, but for the first document that has them.

Leaves, tokens and templates are only folded to the smallest and largest id that has them, so a line held by a third of
all documents is a row per task. Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.llm.common import documents, same_document, stage

LEAD = 3
MIN_TOKENS = 1
CONSTANT_PERCENT = 60
FIELD = "<*>"
_LAST = (1 << 63) - 1


def _several() -> Column:
    return F.min("ord") < F.max("ord")


def _parsed(rows: DataFrame, lead: int, min_tokens: int) -> DataFrame:
    """(doc_id, key, ord, at, masked, own, leaf) of every line with ``min_tokens`` tokens, at least one; ``at`` counts lines from 0. ``own`` is a
    hash of the line as it was before tokens with digits were masked, 0 where it has none.

    White space and fields are settled for the whole text at once, before it is cut into lines.
    """
    odd = F.contains(F.col("text"), F.lit("  "))
    for blank in "\t\x0b\x0c\r":
        odd = odd | F.contains(F.col("text"), F.lit(blank))
    spaced = F.regexp_replace("text", r"\x20[\x20\x09\x0B-\x0D]+|[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*", " ")
    rows = rows.select("doc_id", "key", "ord", F.when(odd, spaced).otherwise(F.col("text")).alias("spaced"))
    masked = F.regexp_replace("spaced", r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+", FIELD)
    masked = F.when(F.col("spaced").rlike("[0-9]"), masked).otherwise(F.col("spaced"))
    both = F.arrays_zip(F.split(masked, "\n", -1).alias("masked"), F.split("spaced", "\n", -1).alias("line"))
    lines = rows.select("doc_id", "key", "ord", F.posexplode_outer(both).alias("at", "x"))
    own = F.when(F.col("x.masked") != F.col("x.line"), F.xxhash64(F.trim("x.line"))).otherwise(0)
    lines = lines.select("doc_id", "key", "ord", "at", F.trim("x.masked").alias("masked"), own.alias("own"))
    spaces = F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit("")))
    lines = lines.filter((spaces >= min_tokens - 1) & (F.col("masked") != ""))
    return lines.select("doc_id", "key", "ord", "at", "masked", "own", F.xxhash64(spaces, F.substring_index("masked", " ", lead)).alias("leaf"))


def recurring_lines(docs: DataFrame, lead: int = LEAD, min_tokens: int = MIN_TOKENS, constant_percent: int = CONSTANT_PERCENT) -> DataFrame:
    """(doc_id, key, at) of the lines to drop, from ``common.documents``."""
    rows = docs.select("doc_id", "key", F.coalesce("doc_id", F.lit(_LAST)).alias("ord"), "text")
    parsed = _parsed(rows, lead, min_tokens)
    leaves = stage(parsed.groupBy("leaf").agg(_several().alias("w")).filter("w").select("leaf"), "leaves")
    lines = stage(parsed.join(leaves, "leaf"), "lines")

    kinds = stage(lines.groupBy("leaf", "masked").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).withColumn(
        "kind", F.monotonically_increasing_id()), "kinds")
    # a leaf of one kind needs no search for fields: all but the masked tokens are constant
    mixed = stage(kinds.groupBy("leaf").agg((F.count("*") > 1).alias("w")).filter("w").select("leaf"), "mixed")
    parts = F.split("masked", " ")
    tokens = kinds.join(mixed, "leaf").select("leaf", "kind", "lo", "hi", F.posexplode_outer(parts).alias("place", "token"))
    tokens = tokens.select("kind", "lo", "hi", "place", F.when(F.col("token") != FIELD, F.xxhash64("leaf", "place", "token")).alias("slot"))
    constants = stage(tokens.filter("slot IS NOT NULL").groupBy("slot").agg((F.min("lo") < F.max("hi")).alias("w")).filter("w").select("slot"), "constants")
    marked = tokens.join(constants.withColumn("constant", F.lit(1)), "slot", "left").withColumn("constant", F.coalesce("constant", F.lit(0)))
    behind = F.when(F.col("place") >= lead, F.col("constant"))
    share = lambda of: 100 * F.sum(of) >= constant_percent * F.count(of)
    fields = marked.groupBy("kind").agg(
        F.when(F.count("place") > lead, share(behind)).otherwise(share(F.col("constant"))).alias("fits"), F.sort_array(F.collect_list(2 * F.col("place") + F.col("constant"))).alias("flags"))
    general = F.array_join(F.zip_with(parts, "flags", lambda token, flag: F.when(flag % 2 == 1, token).otherwise(FIELD)), " ")
    rear = F.when(F.size(parts) <= lead, parts).otherwise(F.slice(parts, lead + 1, F.length("masked")))
    alone = 100 * F.size(F.filter(rear, lambda token: token != FIELD)) >= constant_percent * F.size(rear)
    templates = stage(kinds.join(fields, "kind", "left").select(
        "leaf", "masked", "lo", "hi", F.when(F.col("fits"), general).otherwise(F.col("masked")).alias("template"),
        (~F.coalesce("fits", alone) & F.contains(F.col("masked"), F.lit(FIELD))).alias("exact")), "templates")

    # too few constants: the line as it was is its template
    odd = stage(lines.join(templates.filter("exact").select("leaf", "masked"), ["leaf", "masked"]), "odd")
    forms = odd.groupBy("leaf", "masked", "own").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"))
    forms = forms.select("leaf", "masked", "own", "lo", "hi", F.col("masked").alias("template"), F.lit(True).alias("exact"))
    every = stage(templates.filter("NOT exact").select("leaf", "masked", F.lit(0).cast("long").alias("own"), "lo", "hi", "template", "exact").unionByName(forms), "forms")
    recurring = stage(every.groupBy("leaf", "template", "own").agg(F.min("lo").alias("first"), F.max("hi").alias("last")).filter("first < last"), "recurring")
    kinds = stage(every.join(recurring, ["leaf", "template", "own"]).select("leaf", "masked", "own", "first", "exact"), "dropped")
    same = stage(odd.join(kinds.filter("exact"), ["leaf", "masked", "own"]).filter("ord > first").select("doc_id", "key", "at"), "same")
    return lines.join(kinds.filter("NOT exact"), ["leaf", "masked"]).filter("ord > first").select("doc_id", "key", "at").unionByName(same)


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **tree: int) -> DataFrame:
    """Every row of ``docs`` as struct ``doc``, with ``lines`` (its lines), ``dropped`` (line numbers from 0, unsorted) and ``kept``,
    the other lines with a line feed between them.

    Lines end at line feeds; white space is one space for the comparison, kept lines are unchanged. Every line with a token is
    judged, unless ``min_tokens`` asks for more; blank lines stay. Null and empty texts have one empty line. A line may be as long
    as a cell. A row without an id comes after all others.
    Rows that share an id are one document: they do not make a line recur, and keep it together. An empty table gives no rows.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    drop = recurring_lines(documents(docs, doc_id, text), **tree).groupBy("doc_id", "key").agg(F.collect_set("at").alias("dropped"))
    rows = rows.join(drop, same_document(rows, drop), "left").select(
        "doc", F.split("text", "\n", -1).alias("lines"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    return rows.select("doc", "lines", "dropped", F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n").alias("kept"))
