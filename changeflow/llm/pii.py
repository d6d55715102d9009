"""Personal data: base patterns, and information-theoretic sanitisation of the words that give protected values away.

Base spans come from patterns with checks. The values they find are protected entities. Co-occurrence in the corpus tells
how much a term near an entity reveals of it: the disclosure of entity e by term t is their pointwise mutual information
over the information of e, log(n(e,t) N / (n(e) n(t))) / log(N / n(e)), at most 1, shrunk by n(e,t) / (n(e,t) + 1), as few
sightings prove less than many. All four count distinct texts. Terms above one threshold are generalised, above a higher
one removed, where they stand near that entity. Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.llm.common import same_document, stage

# Kinds in order, patterns and checks of the base spans. The look-behinds and possessive repeats keep long
# runs of one class from being tried from each of their characters; matches are the same as without.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERALISED, REMOVED = "generalised", "removed"
KINDS = (*PATTERNS, GENERALISED, REMOVED)

TERM = rf"{PATTERNS['email']}|\p{{L}}++"
CONTEXT = 240
# a term that only one text has, beside one value, comes to 0.5; two texts to 0.67, three to 0.75
THRESHOLDS = (0.45, 0.7)


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _holds(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda part: part.rlike("^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])$"))
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def located(rows: DataFrame, text: str, pattern: str, out: str, needs: str = "") -> DataFrame:
    """Adds ``out``: (start, end, hit) of every match of ``pattern``, in code points. Texts without ``needs`` have none.

    Starts are running sums of the lengths of gaps and hits, taken from sums at every sqrt(n)-th hit.
    """
    hits, gaps, lens, width, sums = (f"{out}_{x}" for x in ("hits", "gaps", "lens", "width", "sums"))
    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = rows.withColumn(hits, F.when(F.contains(F.col(text), F.lit(needs)), every) if needs else every)
    rows = rows.withColumn(gaps, F.when(F.size(hits) > 0, F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))))
    rows = rows.withColumn(lens, F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), (F.length(g) + F.length(h)).alias("all"))))
    rows = rows.withColumn(width, F.ceil(F.sqrt(F.size(lens))).cast("int"))
    total = lambda start, n: F.aggregate(F.slice(lens, start, n), F.lit(0), lambda a, x: a + x["all"])
    blocks = F.sequence(F.lit(0), F.floor((F.size(lens) - 1) / F.col(width)).cast("int"))
    rows = rows.withColumn(sums, F.when(F.size(lens) > 0, F.transform(blocks, lambda b: total(F.lit(1), b * F.col(width)))))

    def span(x: Column, i: Column) -> Column:
        block = F.floor(i / F.col(width)).cast("int")
        before = total(block * F.col(width) + 1, i % F.col(width))
        return F.struct((F.get(sums, block) + before + x["gap"]).alias("start"), (F.get(sums, block) + before + x["all"]).alias("end"),
                        F.get(hits, i).alias("hit"))

    found = F.coalesce(F.transform(lens, span), F.array().cast("array<struct<start:int,end:int,hit:string>>"))
    return rows.withColumn(out, found).drop(hits, gaps, lens, width, sums)


def _numbered(kind: str, n: int) -> Column:
    good = F.filter(kind, lambda x: _holds(kind, x["hit"]))
    return F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(n).alias("kind"), x["end"].alias("end"), x["hit"].alias("hit")))


def base_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` (the row), ``doc_id``, ``key``, ``text`` and ``base``: (start, kind, end, hit) by start and kind."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("key"), body.alias("text"))
    every = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        rows = located(rows, "text", pattern, kind, {"email": "@", "phone": "+", "ip": "."}.get(kind, ""))
        every.append(_numbered(kind, n))
    return rows.select("doc", "doc_id", "key", "text", F.sort_array(F.concat(*every)).alias("base"))


def _contexts(rows: DataFrame, width: int) -> DataFrame:
    """(doc_id, key, entity, term, start, end): the terms within ``width`` code points of each protected value, without words
    that the width cuts."""
    kind = F.element_at(F.array(*map(F.lit, PATTERNS)), F.col("x.kind") + 1)
    # outer explodes and tests of their rows: a filter on the arrays would be pushed down and compute them several times
    rows = rows.select("doc_id", "key", "text", "base", F.length("text").alias("size"))
    near = rows.select("doc_id", "key", "text", "size", F.explode_outer("base").alias("x")).filter("x IS NOT NULL")
    left = F.greatest(F.col("x.start") - width, F.lit(0))
    before = F.substring("text", left + 1, F.col("x.start") - left)
    after = F.substring("text", F.col("x.end") + 1, F.lit(width))
    inner = F.when(left > 0, F.regexp_replace(before, r"^[^\x20\x09-\x0D]+", "")).otherwise(before)
    after = F.when(F.col("x.end") + width < F.col("size"), F.regexp_replace(after, r"[^\x20\x09-\x0D]+$", "")).otherwise(after)
    sides = F.array(
        F.struct((F.col("x.start") - F.length(inner)).alias("at"), inner.alias("part")),
        F.struct(F.col("x.end").alias("at"), after.alias("part")))
    near = near.select("doc_id", "key", F.concat(kind, F.lit(":"), F.lower("x.hit")).alias("entity"), F.explode(sides).alias("side"))
    near = located(near.select("doc_id", "key", "entity", "side.at", "side.part"), "part", TERM, "words")
    terms = near.select("doc_id", "key", "entity", "at", F.explode_outer("words").alias("w")).filter("w IS NOT NULL AND NOT contains(w.hit, '@')")
    return terms.select("doc_id", "key", "entity", F.lower("w.hit").alias("term"), (F.col("at") + F.col("w.start")).alias("start"), (F.col("at") + F.col("w.end")).alias("end"))


def disclosures(rows: DataFrame, context: DataFrame, thresholds: tuple[float, float] = THRESHOLDS) -> DataFrame:
    """(entity, term, disclosure, kind) of the pairs above the lower threshold, from counts of distinct texts. An entity that
    every text has is no secret."""
    n = rows.select("key").distinct().count()
    together = context.select("entity", "term", "key").distinct().groupBy("entity", "term").agg(F.count("*").alias("n_et"))
    entities = context.select("entity", "key").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}++"), F.lit(0)))
    # copies fold to one row per task before the shuffle
    texts = rows.select("key", words.alias("words")).groupBy("key").agg(F.any_value("words").alias("words"))
    terms = texts.select(F.explode_outer("words").alias("term")).filter("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("n_t"))
    ratio = F.log(F.col("n_et") * F.lit(float(n)) / (F.col("n_e") * F.col("n_t"))) / F.log(F.lit(float(n)) / F.col("n_e"))
    pairs = together.join(entities, "entity").join(terms, "term").filter(F.col("n_e") < n)
    pairs = pairs.withColumn("disclosure", ratio * F.col("n_et") / (F.col("n_et") + 1))
    return pairs.filter(F.col("disclosure") >= thresholds[0]).select(
        "entity", "term", "disclosure", F.when(F.col("disclosure") >= thresholds[1], KINDS.index(REMOVED)).otherwise(KINDS.index(GENERALISED)).alias("kind"))


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", context: int = CONTEXT,
                  thresholds: tuple[float, float] = THRESHOLDS) -> DataFrame:
    """Every row of ``docs`` as struct ``doc``, with ``text``, ``base`` and ``spans``: (start, kind, end) by start and kind,
    ``kind`` an index of ``KINDS``, ends exclusive, code points.

    Null and empty texts have no spans. Terms are runs of letters, compared in lower case; a term that is protected near one
    entity stays elsewhere. Equal texts are one text for the counts and get equal spans, also without an id. A text may be as
    long as a cell. An empty table gives no rows.
    """
    rows = base_spans(docs, doc_id, text)
    near = stage(_contexts(rows, context), "contexts")
    pairs = stage(disclosures(rows, near, thresholds), "disclosures")
    found = near.join(pairs, ["entity", "term"]).groupBy("doc_id", "key", "start", "end").agg(F.max("kind").alias("kind"))
    found = found.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("terms"))
    base = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.join(found, same_document(rows, found), "left").select(
        "doc", "text", "base", F.sort_array(F.concat(base, F.coalesce("terms", none))).alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def sanitised(found: DataFrame) -> DataFrame:
    """``personal_data`` with ``clean``, the text with each span replaced by its kind; a generalised term keeps its first letter.

    Where spans overlap, the first stands for all, up to the furthest end.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    width = F.ceil(F.sqrt(F.size("spans"))).cast("int")
    most = lambda start, n: F.aggregate(F.slice("spans", start, n), F.lit(0), lambda a, x: F.greatest(a, x["end"]))
    rows = found.withColumn("width", width)
    blocks = F.sequence(F.lit(0), F.floor((F.size("spans") - 1) / F.col("width")).cast("int"))
    rows = rows.withColumn("ends", F.when(F.size("spans") > 0, F.transform(blocks, lambda b: most(F.lit(1), b * F.col("width")))))

    def reached(i: Column) -> Column:
        block = F.floor(i / F.col("width")).cast("int")
        return F.greatest(F.get("ends", block), most(block * F.col("width") + 1, i % F.col("width")))

    rows = rows.withColumn("cuts", F.transform("spans", lambda x, i: F.struct(
        reached(i).alias("from"), x["start"].alias("start"), F.greatest(reached(i), x["end"]).alias("upto"), x["kind"].alias("kind"))))

    def piece(x: Column) -> Column:
        label = F.when(x["kind"] == KINDS.index(GENERALISED), F.concat(F.substring("text", x["start"] + 1, F.lit(1)), F.lit("*"))).otherwise(F.element_at(names, x["kind"] + 1))
        return F.when(x["start"] < x["from"], F.lit("")).otherwise(F.concat(F.substring("text", x["from"] + 1, x["start"] - x["from"]), label))

    end = F.array_max("cuts.upto")
    clean = F.concat(F.array_join(F.transform("cuts", piece), ""), F.substring("text", end + 1, F.length("text")))
    return rows.withColumn("clean", F.when(F.size("cuts") > 0, clean).otherwise(F.col("text"))).drop("width", "ends", "cuts")


def remove_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, columns unchanged, with the text sanitised; texts without findings, null ones too, stay as they are."""
    rows = sanitised(personal_data(docs, doc_id, text))
    field = F.when(F.size("spans") > 0, F.col("clean")).otherwise(F.col(f"doc.`{text}`"))
    return rows.select(F.col("doc").withField(f"`{text}`", field).alias("doc")).select("doc.*")
