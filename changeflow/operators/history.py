"""Schema timeline: what a log of table statements makes of each table over time.

Statements are read with native regular expressions, so the whole log is worked in parallel.
The fold is a set of as-of joins and windows over (scn, item) order, no sequential replay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from changeflow.functions import ddl as d
from changeflow.model import LOB_TYPES, POSITION_FIELDS
from changeflow.operators.ranges import asof_join, carry_in_group, lag_in_group, lead_in_group
from changeflow.session import broadcast_if_small, cut_lineage

TABLE = ["schema_name", "table_name"]
#: Digits of the parts of an order key, a text that sorts as (SCN, position in the log, item of the statement) do.
SCN_DIGITS, PLACE_DIGITS, ITEM_DIGITS = 38, 20, 10
#: above every order key that begins like it
AFTER = "~"


def _statements(ddl: DataFrame) -> DataFrame:
    """Statements with ``kind``, table and ``path``. Staged, so that each text is worked on once."""
    rest = [c for c in ddl.columns if c not in TABLE]
    rows = ddl.withColumn("__text", d.clean(F.col("ddl_text")))
    rows = rows.withColumn("kind", d.statement_kind(F.col("__text"))).withColumn("path", d.path_names(F.col("__text")))
    on_column = F.col("__text").rlike(r"(?i)^COMMENT\s+ON\s+COLUMN")
    # the column of a comment is not part of the table's name
    rows = rows.withColumn("__n", F.size("path") - F.when(on_column, 1).otherwise(0))
    return rows.select(
        *rest,
        "__text",
        "kind",
        F.coalesce(F.get("path", F.col("__n") - 2), F.col("schema_name")).alias("schema_name"),
        F.get("path", F.col("__n") - 1).alias("table_name"),
        F.when(on_column, F.element_at("path", -1)).alias("__column"),
    )


def classify_ddl(ddl: DataFrame) -> DataFrame:
    """``kind`` and the table a statement is about. Input: scn, schema_name, ddl_text."""
    return _statements(ddl).drop("__text", "__column")


def with_parts(ddl: DataFrame) -> DataFrame:
    """Classified statements with the parts they consist of; null where a statement is not understood."""
    rows = _statements(ddl).withColumn("__body", F.when(F.col("kind").isin("create", "alter"), d.body(F.col("__text"))))
    rows = rows.withColumn("__items", F.when(F.col("kind") == "create", d.items(F.col("__body"))))
    parts = (
        F.when((F.col("kind") == "create") & (F.size("__items") > 0), d.create_parts(F.col("__items")))
        .when(F.col("kind") == "alter", d.alter_parts(F.col("__body")))
        .when(F.col("kind") == "drop", F.array(F.lit("DROP TABLE")))
        .when(F.col("kind") == "comment", F.array(F.col("__text")))
        .when(F.col("kind").isin("truncate", "other"), F.array().cast("array<string>"))
    )
    rows = rows.withColumn("__parts", parts)
    known = F.forall("__parts", lambda p: d.known_part(p))
    return rows.withColumn("parts", F.when(known, F.col("__parts"))).drop("__parts", "__items", "__body", "__text")


def column_changes(ddl: DataFrame, policy: str = "skip") -> DataFrame:
    """One row per change a statement makes: create, add, modify, rename, drop, set-pk, drop-pk, comment,
    rename-table, drop-table. ``stmt`` orders statements by SCN and, where ``ddl`` has its fields, by log position.

    Statements not understood are left to ``ddl_quarantine``; with policy ``reread`` they end what is known of their
    table, since its structure has to be read again.
    """
    # the outer form keeps the optimizer from testing the whole list expression a second time
    rows = with_parts(ddl)
    place = [F.lpad(F.coalesce(F.col(c), F.lit(0)).cast("string"), PLACE_DIGITS, "0") for c in POSITION_FIELDS[1:] if c in rows.columns]
    rows = rows.select("scn", F.concat(_scn_key(F.col("scn")), *place).alias("stmt"), *TABLE, "__column", F.col("parts").isNull().alias("__open"), F.posexplode_outer("parts").alias("seq", "part"))
    part = F.col("part")
    action = F.when(part.isNotNull(), d.part_action(part))
    if policy == "reread":
        action = F.when(F.col("__open") & F.col("table_name").isNotNull(), "reread").otherwise(action)
    rows = rows.withColumn("action", action).withColumn("seq", F.coalesce("seq", F.lit(0)))
    action = F.col("action")
    defines = action.isin("add", "modify")
    rest = F.regexp_extract(part, d.COLUMN_PART, 4)
    rows = rows.withColumn("__rest", F.when(defines, rest))
    # quoted text may hold any word, so constraint words are looked for outside of it
    bare = F.regexp_replace("__rest", r"'(?:[^']|'')*'", "''")
    default = F.regexp_extract("__rest", d.DEFAULT, 1)
    name = (
        F.when(defines, F.regexp_extract(part, d.COLUMN_PART, 2))
        .when(action == "rename", F.regexp_extract(part, d.RENAME_COLUMN_PART, 1))
        .when(action == "drop", F.regexp_extract(part, d.DROP_COLUMN_PART, 1))
    )
    new_name = F.when(action == "rename", F.regexp_extract(part, d.RENAME_COLUMN_PART, 2)).when(
        action == "rename-table", F.regexp_extract(part, d.RENAME_TABLE_PART, 1)
    )
    return rows.filter(action.isNotNull()).select(
        "scn",
        "stmt",
        "seq",
        *TABLE,
        "action",
        F.when(action == "comment", F.col("__column")).otherwise(d.unquote(name)).alias("column_name"),
        d.unquote(new_name).alias("new_name"),
        F.when(defines, F.upper(F.trim(F.regexp_replace(F.regexp_extract(part, d.COLUMN_PART, 3), r"\s+", " ")))).alias("type_text"),
        F.when(defines, ~bare.rlike(r"(?is)\bNOT\s+NULL\b")).alias("nullable"),
        F.when(defines & (default != ""), default).alias("default_text"),
        F.when(action == "comment", F.regexp_replace(F.regexp_extract(part, d.COMMENT_PART, 2), "''", "'")).alias("comment"),
        F.when(action == "set-pk", d.names(F.regexp_extract(part, d.KEY_PART, 1))).alias("key_columns"),
    )


def ddl_quarantine(ddl: DataFrame, policy: str = "skip") -> tuple[DataFrame, DataFrame]:
    """Understood statements, and the rest as a side table.

    ``skip`` sets the rest aside, ``reread`` also marks their tables, ``fail`` raises when read.
    """
    if policy not in ("skip", "reread", "fail"):
        raise ValueError(f"unknown policy {policy}")
    rows = with_parts(ddl).drop("__column").withColumn("understood", F.col("parts").isNotNull()).drop("parts")
    good = rows.filter("understood").drop("understood")
    bad = rows.filter("not understood").drop("understood")
    if policy == "fail":
        stop = F.raise_error(F.concat(F.lit("statement not understood: "), F.col("ddl_text")))
        good = rows.select(
            *[c for c in rows.columns if c not in ("understood", "ddl_text")],
            F.when(F.col("understood"), F.col("ddl_text")).otherwise(stop.cast("string")).alias("ddl_text"),
        )
    return good, bad.withColumn("reread_structure", F.lit(policy == "reread"))


# ---------------------------------------------------------------- type text

# Type word, JDBC type, stored type name, default length, default scale.
TYPE_TABLE = (
    ("INT", "INTEGER", "INTEGER", None, None),
    ("INTEGER", "INTEGER", "INTEGER", None, None),
    ("PLS_INTEGER", "INTEGER", "INTEGER", None, None),
    ("SMALLINT", "SMALLINT", "SMALLINT", None, None),
    ("BIGINT", "BIGINT", "BIGINT", None, None),
    ("TINYINT", "TINYINT", "TINYINT", None, None),
    ("BIT", "BIT", "BIT", None, None),
    ("BOOLEAN", "BOOLEAN", "BOOLEAN", None, None),
    ("NUMBER", "NUMERIC", "NUMBER", 38, None),
    ("FLOAT", "FLOAT", "FLOAT", 126, None),
    ("DOUBLE", "DOUBLE", "DOUBLE", 256, None),
    ("DATE", "TIMESTAMP", "DATE", None, None),
    ("TIMESTAMP", "TIMESTAMP", "TIMESTAMP", 6, None),
    ("JSON", "JSON", "JSON", None, None),
    ("VARCHAR", "VARCHAR", "VARCHAR2", 4000, None),
    ("VARCHAR2", "VARCHAR", "VARCHAR2", 4000, None),
    ("NVARCHAR", "NVARCHAR", "NVARCHAR", 4000, None),
    ("NCHAR", "NCHAR", "NCHAR", 1, None),
    ("CHAR", "CHAR", "CHAR", 1, None),
    ("BLOB", "BLOB", "BLOB", None, None),
    ("CLOB", "CLOB", "CLOB", None, None),
    ("NCLOB", "NCLOB", "NCLOB", None, None),
    ("RAW", "RAW", "RAW", None, None),
    ("ROWID", "VARCHAR", "ROWID", None, None),
    ("UROWID", "VARCHAR", "ROWID", None, None),
    ("XMLTYPE", "SQLXML", "XMLTYPE", None, None),
    ("INTERVAL YEAR TO MONTH", "YM_INTERVAL", "INTERVAL YEAR TO MONTH", 2, None),
    ("INTERVAL DAY TO SECOND", "DS_INTERVAL", "INTERVAL DAY TO SECOND", 2, 6),
    ("TIMESTAMP WITH TIME ZONE", "TIMESTAMP_TZ", "TIMESTAMP WITH TIME ZONE", 6, None),
    ("TIMESTAMP WITH LOCAL TIME ZONE", "TIMESTAMP_TZ", "TIMESTAMP WITH LOCAL TIME ZONE", 6, None),
)
UNSET_SCALE = -127


def resolve_types(cols: DataFrame, type_col: str = "type_text") -> DataFrame:
    """``jdbc_type``, ``type_name``, ``length`` and ``scale`` of a type text."""
    t = F.upper(F.trim(F.col(type_col)))
    word = F.trim(F.regexp_replace(F.regexp_replace(t, r"\s*\([^()]*\)", ""), r"\s+", " "))
    first = F.regexp_extract(t, r"\(([^()]*)\)", 1)
    number = lambda text, i: F.nullif(
        F.regexp_extract(text, r"^\s*(\d+|\*)\s*(?:CHAR|BYTE)?\s*(?:,\s*(-?\d+))?\s*(?:CHAR|BYTE)?\s*$", i), F.lit("")
    )
    p = F.when(number(first, 1) != "*", number(first, 1).try_cast("int"))
    s = number(first, 2).try_cast("int")
    second_arg = F.nullif(F.regexp_extract(t, r"\bSECOND\s*\(\s*(\d+)\s*\)", 1), F.lit("")).try_cast("int")
    day_arg = F.nullif(F.regexp_extract(t, r"\b(?:DAY|YEAR)\s*\(\s*(\d+)\s*\)", 1), F.lit("")).try_cast("int")

    known = F.create_map(
        *[
            x
            for w, jdbc, name, length, scale in TYPE_TABLE
            for x in (
                F.lit(w),
                F.struct(
                    F.lit(jdbc).alias("jdbc"), F.lit(name).alias("name"),
                    F.lit(length).cast("int").alias("len"), F.lit(scale).cast("int").alias("scale"),
                ),
            )
        ]
    )
    kind = known[word]
    jdbc = F.when(t.isNull(), "VARCHAR").otherwise(F.coalesce(kind["jdbc"], F.lit("OTHER")))
    name = F.when(t.isNull(), "UNKNOWN").otherwise(F.coalesce(kind["name"], t))
    sized = jdbc.isin("NUMERIC", "FLOAT", "DOUBLE", "TIMESTAMP_TZ", "VARCHAR", "NVARCHAR", "NCHAR", "CHAR", "RAW") | (
        name == "TIMESTAMP"
    )
    length = (
        F.when(jdbc.isin("YM_INTERVAL", "DS_INTERVAL"), F.coalesce(day_arg, kind["len"]))
        .when(sized & (name != "ROWID"), F.coalesce(p, kind["len"]))
        .otherwise(kind["len"])
    )
    scale = (
        F.when(jdbc == "DS_INTERVAL", F.coalesce(second_arg, kind["scale"]))
        # a number with any precision part has scale 0 unless it names one
        .when((jdbc == "NUMERIC") & (first != ""), F.coalesce(s, F.lit(0)))
    )
    scale = F.when(scale != UNSET_SCALE, scale)
    return cols.withColumns({"jdbc_type": jdbc, "type_name": name, "length": length, "scale": scale})


# ---------------------------------------------------------------- fold


def _scn_key(scn: Column) -> Column:
    return F.lpad(scn.cast(f"decimal({SCN_DIGITS},0)").cast("string"), SCN_DIGITS, "0")


def _ord(seq: Column) -> Column:
    return F.concat("stmt", F.lpad(seq.cast("string"), ITEM_DIGITS, "0"))


def _scn_of(order: Column) -> Column:
    """SCN of an order key, of any size."""
    return F.substring(order, 1, SCN_DIGITS).cast(f"decimal({SCN_DIGITS},0)")


#: up to this many changes a window over them fits one task
SMALL = 1_000_000


def _largest(rows: DataFrame, by: list[str]) -> int:
    """Rows of the largest group, counted before the shuffle."""
    return rows.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def _search(fits: bool) -> dict:
    """How the windows and as-of joins work: no search for hot keys where each group has been counted to fit one task. A
    search computes its input once more, and the sample goes to the driver."""
    return {"parts": 0, "small_limit": 0} if fits else {"parts": None, "small_limit": None}


def _segments(events: DataFrame, scope: list[str], name: str, parts: int | None) -> DataFrame:
    """Lives of names. ``events``: scope, name, new_name, ord, act in open / close / move.

    A move ends the life of ``name`` and starts one of ``new_name`` that continues it. Result:
    scope, name, from_ord, to_ord (null = still alive), seg, root (first segment of the chain).
    """
    key = [*scope, name]
    bad_moves = None
    while True:
        moves = events.filter(F.col("act") == "move")
        if bad_moves is not None:
            events = events.join(bad_moves, [*scope, "ord"], "left_anti")
            moves = events.filter(F.col("act") == "move")
        arrivals = moves.select(
            *scope, F.col("new_name").alias(name), "ord", F.lit("open").alias("act"), F.col(name).alias("from_name"),
            F.lit(True).alias("moved"),
        )
        life = events.select(
            *key, "ord", F.when(F.col("act") == "open", "open").otherwise("close").alias("act"),
            F.lit(None).cast("string").alias("from_name"), F.lit(False).alias("moved"),
            (F.col("act") == "move").alias("leaves"),
        ).unionByName(arrivals.withColumn("leaves", F.lit(False)))
        life = cut_lineage(lag_in_group(life, key, ["ord"], "act", "prev", parts))
        # a rename of a name that is not alive does nothing: take it out and look again
        bad_moves = life.filter(F.col("leaves") & ~F.col("prev").eqNullSafe("open")).select(*scope, "ord").distinct()
        if bad_moves.isEmpty():
            break
    # an open of a live name is ignored unless the name is taken over by a rename
    edges = life.filter((F.col("act") == "close") | F.col("moved") | ~F.col("prev").eqNullSafe("open"))
    edges = lead_in_group(edges, key, ["ord"], "ord", "to_ord", parts)
    segs = edges.filter(F.col("act") == "open").withColumn("seg", F.struct(*key, "ord"))
    # parent: the life of the old name that ended with the rename
    ended = segs.filter(F.col("to_ord").isNotNull()).select(
        *scope, F.col(name).alias("from_name"), F.col("to_ord").alias("ord"), F.col("seg").alias("root")
    )
    segs = segs.join(ended, [*scope, "from_name", "ord"], "left").withColumn("root", F.coalesce("root", "seg"))
    segs = cut_lineage(segs.select(*key, F.col("ord").alias("from_ord"), "to_ord", "seg", "root", "moved"))
    while True:  # pointer jumping: chains halve per round
        up = segs.filter("moved").select(F.col("seg").alias("root"), F.col("root").alias("up"))
        further = segs.join(up, "root").filter(F.col("up") != F.col("root"))
        if further.isEmpty():
            return segs
        segs = cut_lineage(segs.join(up, "root", "left").withColumn("root", F.coalesce("up", "root")).drop("up"))


def _name(key: Column) -> Column:
    """128 bits that name a life; as text it would be most of every row, since a column's key holds its table's."""
    return F.unhex(F.md5(F.to_json(key)))


def schema_timeline(changes: DataFrame, captured: DataFrame | None = None, with_comments: bool = True) -> DataFrame:
    """Every state of every column with the order range [from_ord, to_ord) in which it held.

    A created table that is already known is ignored, as are changes of unknown tables; a renamed
    table keeps its history. ``captured`` (schema_name, table_name) limits the tables.
    """
    if captured is not None:
        keep, _ = broadcast_if_small(captured.select(*TABLE).distinct())
        changes = changes.join(keep, TABLE, "left_semi")
    changes = cut_lineage(changes.withColumn("ord", _ord(F.col("seq"))))
    # counted, not assumed: few changes, or few of each table, need no search for hot keys. A rename counts for both names
    few = changes.count() <= SMALL
    moved_to = changes.filter(F.col("action") == "rename-table").select("schema_name", F.col("new_name").alias("table_name"))
    how = _search(few or _largest(changes.select(*TABLE).unionByName(moved_to), TABLE) <= SMALL)

    act = (
        F.when(F.col("action") == "create", "open")
        .when(F.col("action").isin("drop-table", "reread"), "close")
        .when(F.col("action") == "rename-table", "move")
    )
    tables = _segments(
        changes.select(*TABLE, "new_name", "ord", act.alias("act")).filter(F.col("act").isNotNull()),
        ["schema_name"],
        "table_name",
        how["parts"],
    )
    lives = tables.select(
        *TABLE, "from_ord", F.col("to_ord").alias("table_to"), F.col("from_ord").alias("opened"), "moved",
        _name(F.col("root")).alias("table_root"),
    )
    inner = changes.filter(~F.col("action").isin("create", "drop-table", "rename-table", "reread"))
    # the items of a create statement count only if the create did
    in_create = changes.filter(F.col("action") == "create").select(*TABLE, "stmt").distinct().withColumn("in_create", F.lit(True))
    inner = inner.join(in_create, [*TABLE, "stmt"], "left")
    placed = asof_join(inner, lives, TABLE, "ord", "from_ord", ["table_root", "opened", "table_to"], **how)
    alive = F.col("table_root").isNotNull() & (F.col("table_to").isNull() | (F.col("ord") < F.col("table_to")))
    own = F.col("in_create").isNull() | (F.col("opened") == _ord(F.lit(0)))
    placed = cut_lineage(placed.filter(alive & own).drop("opened", "table_to", "in_create"))
    # renames may have joined the changes of many names
    how = _search(few or _largest(placed, ["table_root"]) <= SMALL)

    act = F.when(F.col("action") == "add", "open").when(F.col("action") == "drop", "close").when(F.col("action") == "rename", "move")
    columns = _segments(
        placed.select("table_root", "column_name", "new_name", "ord", act.alias("act")).filter(F.col("act").isNotNull()),
        ["table_root"],
        "column_name",
        how["parts"],
    )
    col_lives = columns.select(
        "table_root", "column_name", F.col("from_ord").alias("col_from"), F.col("to_ord").alias("col_to"),
        _name(F.col("root")).alias("column_root"), F.col("root.ord").alias("column_ord"),
    )
    # attributes: from add and modify, comments on their own
    attrs = placed.filter(F.col("action").isin("add", "modify") | ((F.col("action") == "comment") & F.col("column_name").isNotNull()))
    if not with_comments:
        attrs = attrs.filter(F.col("action") != "comment")
    attrs = asof_join(
        attrs.select("table_root", "column_name", "ord", "action", "type_text", "nullable", "default_text", "comment"),
        col_lives.withColumn("start", F.col("col_from")),
        ["table_root", "column_name"], "ord", "start", ["column_root", "column_ord", "col_to"], **how,
    ).filter(F.col("column_root").isNotNull() & (F.col("col_to").isNull() | (F.col("ord") < F.col("col_to"))))
    defined = F.when(F.col("action") != "comment", F.struct("type_text", "nullable", "default_text"))
    points = attrs.select(
        "table_root", "column_root", "column_ord", "ord", F.lit(None).cast("string").alias("name"),
        defined.alias("def"), F.col("comment").alias("note"), F.lit(False).alias("ends"),
    ).unionByName(
        columns.select(
            "table_root", _name(F.col("root")).alias("column_root"), F.col("root.ord").alias("column_ord"),
            F.col("from_ord").alias("ord"), F.col("column_name").alias("name"),
            F.lit(None).cast("struct<type_text:string,nullable:boolean,default_text:string>").alias("def"),
            F.lit(None).cast("string").alias("note"), F.lit(False).alias("ends"),
        )
    )
    # the end of the last life of a column, and the end of its table
    next_life = columns.filter("moved").select("table_root", F.col("from_ord").alias("to_ord"), F.lit(True).alias("goes_on"))
    ends = (
        columns.filter(F.col("to_ord").isNotNull())
        .join(next_life, ["table_root", "to_ord"], "left_anti")
        .select(
            "table_root", _name(F.col("root")).alias("column_root"), F.col("root.ord").alias("column_ord"),
            F.col("to_ord").alias("ord"), F.lit(True).alias("ends"),
        )
    )
    points = points.unionByName(ends, allowMissingColumns=True)
    same = points.groupBy("table_root", "column_root", "column_ord", "ord").agg(
        F.max("name").alias("name"), F.max("def").alias("def"), F.max("note").alias("note"), F.max("ends").alias("ends")
    )
    states = carry_in_group(same, ["column_root"], ["ord"], {"name": "name", "def": "def", "note": "note"}, how["parts"])
    states = lead_in_group(states, ["column_root"], ["ord"], "ord", "to_ord", how["parts"]).filter(~F.coalesce("ends", F.lit(False)))
    # a column state is split where its table changes name
    spans = tables.select(
        "schema_name", "table_name", _name(F.col("root")).alias("table_root"), F.col("from_ord").alias("t_from"), F.col("to_ord").alias("t_to")
    )
    far = F.lit(AFTER)
    lo = F.greatest("ord", "t_from")
    hi = F.least(F.coalesce("to_ord", far), F.coalesce("t_to", far))
    joined = states.join(spans, "table_root").withColumn("from_ord", lo).withColumn("__hi", hi).filter("from_ord < __hi")
    keys = _key_spans(placed, col_lives, how)
    return (
        joined.select(
            "table_root", *TABLE, F.col("column_root"), "column_ord", F.col("name").alias("column_name"), "def.*",
            F.col("note").alias("comment"), "from_ord", F.when(F.col("__hi") < far, F.col("__hi")).alias("to_ord"),
        )
        .join(keys, ["table_root", "column_root"], "left")
        .withColumn("key_spans", F.coalesce("key_spans", F.array().cast("array<struct<k_from:string,k_to:string,idx:int>>")))
    )


def _key_spans(placed: DataFrame, col_lives: DataFrame, how: dict) -> DataFrame:
    """Per column the order ranges in which it was part of the primary key, with its place in it."""
    keys = placed.filter(F.col("action").isin("set-pk", "drop-pk")).select("table_root", "ord", "key_columns")
    keys = lead_in_group(keys, ["table_root"], ["ord"], "ord", "k_to", how["parts"])
    named = keys.select("table_root", "ord", "k_to", F.posexplode("key_columns").alias("idx", "column_name"))
    found = asof_join(
        named, col_lives, ["table_root", "column_name"], "ord", "col_from", ["column_root", "col_to"], **how
    ).filter(F.col("column_root").isNotNull() & (F.col("col_to").isNull() | (F.col("ord") < F.col("col_to"))))
    spans = F.collect_list(F.struct(F.col("ord").alias("k_from"), "k_to", "idx"))
    return found.groupBy("table_root", "column_root").agg(spans.alias("key_spans"))


def fold_schema(timeline: DataFrame, scn: int | None = None) -> DataFrame:
    """Structure of every table as of an SCN (all of it), or the latest."""
    at = F.lit(AFTER) if scn is None else F.concat(_scn_key(F.lit(scn).cast("decimal(38,0)")), F.lit(AFTER))
    open_end = F.col("to_ord").isNull()
    live = timeline.filter((F.col("from_ord") <= at) & (open_end | (F.col("to_ord") > at)))
    covers = lambda k: (k["k_from"] <= at) & (k["k_to"].isNull() | (k["k_to"] > at))
    place = F.get(F.filter("key_spans", covers), 0)["idx"]
    # a table's columns are bounded by the source database, so a window per table is
    in_table = Window.partitionBy(*TABLE).orderBy("column_ord")
    return live.select(
        *TABLE,
        F.row_number().over(in_table).alias("position"),
        "column_name", "type_text", "nullable", "default_text", "comment",
        (place + 1).alias("key_position"),
    )


def schema_versions(changes: DataFrame, timeline: DataFrame) -> DataFrame:
    """One row per table and SCN (a decimal, of any size) at which its structure changed, with the column names then valid.

    Only the columns of a version leave the join; a version whose table has none, as after a drop, has an empty list.
    The timeline is read three times, so its names and ranges are written once.
    """
    timeline = cut_lineage(timeline.select(*TABLE, "column_ord", "column_name", "from_ord", "to_ord"))
    starts = timeline.select(*TABLE, _scn_of(F.col("from_ord")).alias("version_scn"))
    ends = timeline.filter(F.col("to_ord").isNotNull()).select(*TABLE, _scn_of(F.col("to_ord")).alias("version_scn"))
    versions = starts.unionByName(ends).distinct().withColumn("__at", F.concat(_scn_key(F.col("version_scn")), F.lit(AFTER)))
    v, c = versions.alias("v"), timeline.alias("c")
    valid = (F.col("c.from_ord") <= F.col("v.__at")) & (F.col("c.to_ord").isNull() | (F.col("c.to_ord") > F.col("v.__at")))
    same = (F.col("v.schema_name") == F.col("c.schema_name")) & (F.col("v.table_name") == F.col("c.table_name"))
    found = v.join(c, same & valid, "left").groupBy("v.schema_name", "v.table_name", "v.version_scn").agg(
        F.array_sort(F.collect_list(F.when(F.col("c.column_name").isNotNull(), F.struct("c.column_ord", "c.column_name")))).alias("c")
    )
    names = F.transform("c", lambda c: c["column_name"])
    return found.select(*TABLE, "version_scn", names.alias("columns"))


def schema_at_event(events: DataFrame, versions: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    """Events with the table's columns as of their position, and the tables no version exists for.

    Positions are long integers, so versions beyond them come after every event. The versions are counted, searched for hot
    tables and joined, so they are written once.
    """
    reached = cut_lineage(versions.filter(F.col("version_scn") <= F.lit(2**63 - 1)).withColumn("version_scn", F.col("version_scn").cast("long")))
    joined = asof_join(events, reached.withColumn("from_scn", F.col("version_scn")), TABLE, "position_scn", "from_scn", ["version_scn", "columns"], **how)
    missing = joined.filter(F.col("version_scn").isNull()).groupBy(*TABLE).agg(F.count("*").alias("events"))
    return joined.filter(F.col("version_scn").isNotNull()), missing


def schema_change_rows(ddl: DataFrame) -> DataFrame:
    """Schema-change records as a table: alter is a rename only when the name changed."""
    rows = with_parts(ddl).filter(F.col("kind").isin("create", "alter", "drop", "truncate", "comment"))
    first = F.get("parts", 0)
    renames = (F.col("kind") == "alter") & first.rlike(d.RENAME_TABLE_PART)
    return rows.filter(F.col("parts").isNotNull()).select(
        "scn",
        *TABLE,
        F.when(renames, "rename").otherwise(F.col("kind")).alias("event_type"),
        F.when(renames, d.unquote(F.regexp_extract(first, d.RENAME_TABLE_PART, 1))).alias("new_table_name"),
        F.size("parts").alias("changes"),
        "ddl_text",
    )


def lob_columns(schemas: DataFrame) -> DataFrame:
    """Large-object columns per table; ``schemas`` has column_name, position and type_name."""
    found = schemas.filter(F.col("type_name").isin(*LOB_TYPES))
    return found.groupBy(*TABLE).agg(
        F.array_sort(F.collect_list(F.struct("position", "column_name", "type_name"))).alias("c")
    ).select(*TABLE, F.transform("c", lambda c: c["column_name"]).alias("lob_columns"))


def latest_ddl_scn(ddl: DataFrame, captured: DataFrame, clock: DataFrame) -> DataFrame:
    """SCN of the latest statement time over the captured tables; no row when there is none or it is 0."""
    from changeflow.operators.position import time_to_scn

    keep, _ = broadcast_if_small(captured.select(*TABLE).distinct())
    last = ddl.join(keep, TABLE, "left_semi").agg(F.max("ddl_ts").alias("ddl_ts"))
    found = time_to_scn(last, clock, "ddl_ts", "latest_ddl_scn")
    return found.filter(F.coalesce(F.col("latest_ddl_scn"), F.lit(0)) != 0)
