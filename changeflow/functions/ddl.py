"""Column expressions that read table statements as text. Native regular expressions only.

A statement becomes a list of parts, each with one verb: ``ADD name type ...``, ``DROP name``,
``RENAME COLUMN a TO b``. The parts are exploded to rows and read one by one, which keeps every
expression small.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

IDENT = r'(?:"[^"]+"|[A-Za-z_][A-Za-z0-9_$#]*+)'
PATH = rf"{IDENT}(?:\s*\.\s*{IDENT}){{0,2}}"
NAMES = rf"\(\s*({IDENT}(?:\s*,\s*{IDENT})*+)\s*\)"
# one element of a comma list: runs without special characters, quoted text, brackets up to three deep
_QUOTED = r"'(?:[^']++|'')*+'"
_PAREN0 = rf"\((?:[^()']++|{_QUOTED})*+\)"
_PAREN1 = rf"\((?:[^()']++|{_QUOTED}|{_PAREN0})*+\)"
_PAREN2 = rf"\((?:[^()']++|{_QUOTED}|{_PAREN1})*+\)"
ITEM = rf"""((?:[^,()'"]++|{_QUOTED}|"[^"]*+"|{_PAREN2})++)"""
TYPE = (
    r"(INTERVAL\s+(?:YEAR|DAY)\s*(?:\([^()]*\))?\s*TO\s+(?:MONTH|SECOND)\s*(?:\([^()]*\))?"
    r"|TIMESTAMP\s*(?:\([^()]*\))?\s+WITH\s+(?:LOCAL\s+)?TIME\s+ZONE"
    r"|[A-Za-z_][A-Za-z0-9_]*\s*(?:\([^()]*\))?)"
)
_TABLE = r"TABLE\s+(?:IF\s+(?:NOT\s+)?EXISTS\s+)?"
HEAD = rf"(?is)^(?:(?:CREATE|ALTER|DROP|TRUNCATE)\s+{_TABLE}|COMMENT\s+ON\s+(?:TABLE|COLUMN)\s+)({PATH})"

# Words that may follow CREATE / ALTER / DROP without concerning a table's columns.
OTHER_OBJECTS = (
    "INDEX", "VIEW", "SEQUENCE", "USER", "TABLESPACE", "SYNONYM", "PROCEDURE", "FUNCTION", "TRIGGER", "PACKAGE",
    "ROLE", "DATABASE", "PROFILE", "OUTLINE", "TYPE", "LIBRARY", "RESTORE", "SYSTEM", "SESSION", "AUDIT",
    "MATERIALIZED", "DIRECTORY", "DBLINK", "ACCESS",
)
OTHER_STATEMENTS = (
    "GRANT", "REVOKE", "ANALYZE", "AUDIT", "NOAUDIT", "BACKUP", "RESTORE", "RECOVER", "PURGE", "FLASHBACK", "LOCK",
)

# forms of one part
KEY_PART = rf"(?is)^ADD\s+(?:CONSTRAINT\s+{IDENT}\s+)?PRIMARY\s+KEY\s*(?:{IDENT}\s*)?{NAMES}"
DROP_KEY_PART = r"(?is)^DROP\s+PRIMARY\s+KEY$"
# partitions, indexes and constraints change no column
SILENT_PART = r"(?is)^(?:ADD|DROP)\s+(?:PARTITION|INDEX|KEY|UNIQUE|FOREIGN|CONSTRAINT|CHECK)\b"
RENAME_COLUMN_PART = rf"(?is)^RENAME\s+COLUMN\s+({IDENT})\s+TO\s+({IDENT})$"
RENAME_TABLE_PART = rf"(?is)^RENAME\s+(?:TO|AS)\s+(?:{IDENT}\s*\.\s*)?({IDENT})$"
DROP_COLUMN_PART = rf"(?is)^DROP\s+(?:COLUMN\s+)?({IDENT})$"
COLUMN_PART = rf"(?is)^(ADD|MODIFY)\s+(?:COLUMN\s+)?({IDENT})\s+{TYPE}(.*)$"
COMMENT_PART = r"(?is)^COMMENT\s+ON\s+(TABLE|COLUMN)\s.*?\sIS\s+'(.*)'$"
DEFAULT = r"(?is)\bDEFAULT\s+('(?:[^']|'')*'|\((?:[^()]|\([^()]*\))*\)|[^\s,']+(?:\s*\([^()]*\))?)"


def clean(text: Column) -> Column:
    """Statement without blanks around it and without the closing semicolon."""
    return F.regexp_replace(text, r"^\s+|[\s;]+$", "")


def unquote(name: Column) -> Column:
    """Identifier as stored: quoted keeps its case, unquoted is upper case."""
    return F.when(name.startswith('"'), F.btrim(name, F.lit('"'))).otherwise(F.upper(name))


def names(listed: Column) -> Column:
    """Identifiers of a list as an array."""
    return F.transform(F.regexp_extract_all(listed, F.lit(f"({IDENT})"), F.lit(1)), lambda n: unquote(n))


def statement_kind(t: Column) -> Column:
    """create, alter, drop, truncate, comment, other, or invalid. Takes a cleaned statement."""
    form = lambda verb, tail: t.rlike(rf"(?is)^{verb}\s+{_TABLE}{IDENT}(?:\s*\.\s*{IDENT})?{tail}$")
    objects, statements = "|".join(OTHER_OBJECTS), "|".join(OTHER_STATEMENTS)
    return (
        F.when(form("CREATE", r"\s*\(.*\).*"), "create")
        .when(form("ALTER", r"\s+\S.*"), "alter")
        .when(form("DROP", r"(?:\s.*)?"), "drop")
        .when(form("TRUNCATE", r"(?:\s.*)?"), "truncate")
        .when(t.rlike(rf"(?is)^COMMENT\s+ON\s+(?:TABLE|COLUMN)\s+{PATH}\s+IS\s+'.*'$"), "comment")
        .when(
            t.rlike(
                rf"(?is)^(?:(?:CREATE|ALTER|DROP)\s+(?:OR\s+REPLACE\s+)?(?:UNIQUE\s+|PUBLIC\s+|BITMAP\s+)?(?:{objects})"
                rf"|{statements}|COMMENT\s+ON\s+(?:VIEW|INDEX))\b"
            ),
            "other",
        )
        # CREATE TABLE ... AS SELECT ends here too: it has no column list to follow
        .otherwise("invalid")
    )


def path_names(t: Column) -> Column:
    """The dotted name a cleaned statement is about, as stored names; empty where there is none."""
    return names(F.regexp_extract(t, HEAD, 1))


def items(body: Column) -> Column:
    """Top-level comma list inside one pair of brackets."""
    inner = F.regexp_replace(body, r"(?s)^\(|\)$", "")
    return F.transform(F.regexp_extract_all(inner, F.lit(ITEM), F.lit(1)), lambda item: F.trim(item))


def body(t: Column) -> Column:
    """Column list of a CREATE (with its brackets), or the rest of an ALTER after the table name."""
    create = rf"(?is)^CREATE\s+{_TABLE}{IDENT}(?:\s*\.\s*{IDENT})?\s*({_PAREN2}).*$"
    alter = rf"(?is)^ALTER\s+TABLE\s+{IDENT}(?:\s*\.\s*{IDENT})?\s+(.*)$"
    return F.when(t.rlike("(?i)^CREATE"), F.regexp_extract(t, create, 1)).otherwise(F.regexp_extract(t, alter, 1))


def create_parts(listed: Column) -> Column:
    """Parts of a CREATE from its items. Inline key columns become one key part."""
    bare = lambda p: F.regexp_replace(p, _QUOTED, "")
    inline = F.filter(listed, lambda p: bare(p).rlike(rf"(?is)^{IDENT}\s.*\bPRIMARY\s+KEY\b(?!\s*\()"))
    inline_names = F.array_join(F.transform(inline, lambda p: F.regexp_extract(p, rf"^({IDENT})", 1)), ",")
    key = F.when(inline_names != "", F.array(F.concat(F.lit("ADD PRIMARY KEY ("), inline_names, F.lit(")"))))
    return F.concat(
        F.array(F.lit("CREATE")),
        F.transform(listed, lambda p: F.concat(F.lit("ADD "), p)),
        F.coalesce(key, F.array().cast("array<string>")),
    )


def alter_parts(act: Column) -> Column:
    """Parts of an ALTER from the text after the table name; most are a single part already."""
    many = rf"(?is)^(ADD|MODIFY)\s*{_PAREN2}$"
    change = rf"(?is)^CHANGE\s+(?:COLUMN\s+)?({IDENT})\s+({IDENT})\s+(.*)$"
    drop_list = rf"(?is)^DROP\s+(?:COLUMN\s*)?{NAMES}$"
    verb = F.concat(F.regexp_extract(act, r"^(\w+)", 1), F.lit(" "))
    return (
        F.when(act.rlike(many), F.transform(items(F.regexp_extract(act, r"(?s)^\w+\s*(.*)$", 1)), lambda p: F.concat(verb, p)))
        .when(
            act.rlike(drop_list),
            F.transform(F.regexp_extract_all(F.regexp_extract(act, drop_list, 1), F.lit(f"({IDENT})"), F.lit(1)), lambda n: F.concat(F.lit("DROP "), n)),
        )
        .when(
            act.rlike(change),
            F.array(
                F.regexp_replace(act, change, "RENAME COLUMN $1 TO $2"), F.regexp_replace(act, change, "MODIFY $2 $3")
            ),
        )
        .otherwise(F.array(act))
    )


def known_part(part: Column) -> Column:
    forms = (
        KEY_PART, DROP_KEY_PART, SILENT_PART, RENAME_COLUMN_PART, RENAME_TABLE_PART, DROP_COLUMN_PART, COLUMN_PART,
        COMMENT_PART, "^(?:CREATE|DROP TABLE)$",
    )
    return part.rlike("(?is)" + "|".join(f"(?:{f.removeprefix('(?is)')})" for f in forms))


def part_action(part: Column) -> Column:
    """What a known part does; null for parts without effect on columns."""
    return (
        F.when(part == "CREATE", "create")
        .when(part == "DROP TABLE", "drop-table")
        .when(part.rlike(KEY_PART), "set-pk")
        .when(part.rlike(DROP_KEY_PART), "drop-pk")
        .when(part.rlike(SILENT_PART), None)
        .when(part.rlike(RENAME_COLUMN_PART), "rename")
        .when(part.rlike(RENAME_TABLE_PART), "rename-table")
        .when(part.rlike(DROP_COLUMN_PART), "drop")
        .when(part.rlike(r"(?i)^COMMENT\s"), "comment")
        .otherwise(F.lower(F.regexp_extract(part, COLUMN_PART, 1)))
    )
