"""The corpus queries and the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from changeflow.llm import align, packing, pii, prefix_trie, quality, segment, sharding, warc
from changeflow.llm.common import one_space, stage, table
from changeflow.llm.exact_dedup import exact_dedup
from changeflow.llm.jaccard_join import jaccard_components
from changeflow.llm.line_templates import line_dedup
from changeflow.llm.substring_dedup import substring_dedup
from changeflow.llm.suffix_dedup import suffix_dedup

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op6_exact_dedup", r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(one_space(F.col("text")), 256).alias("text_sha256"))
    return exact_dedup(docs).select("doc.doc_id", "keep_id", "group_size", "kept", "doc.text_sha256")


@query("op8_rule_ledger", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) AS g,
  unnest(range(1, len(w) - 1)) AS i FROM d),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY doc_id),
lin AS (SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n FROM lin GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(n_lines, 0) AS n_lines,
  coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id LEFT JOIN dup ON d.doc_id = dup.doc_id),
f AS (SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
  + CASE WHEN n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
  + CASE WHEN word_chars > 20 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed, failures = 0 AS kept,
  failures::BIGINT AS failures FROM f""")
def op8_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_ledger(table(spark, sf_dir, "documents")).select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality.rejected(quality.BASE).alias("base_failed"), (~quality.rejected(quality.CURRENT)).alias("kept"), "failures")


@query("op9_pack_sequences")
def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, unnest([array_to_string(w[i:i + 12], ' ') for i in range(1, len(w) - 11)]) AS g, unnest(range(1, len(w) - 11)) AS i FROM d),
rep AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM rep),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def _places(source: str, by: str, pattern: str) -> str:
    """Matches of a pattern in column t of a table with their places, start included, end excluded."""
    return f"""SELECT {by}, v, gaps + before AS s, gaps + before + length(v) AS e FROM (
      SELECT {by}, v, sum(length(g)) OVER (PARTITION BY {by} ORDER BY i) AS gaps,
        coalesce(sum(length(v)) OVER (PARTITION BY {by} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM (SELECT {by}, unnest(h) AS v, unnest(g[1:len(h)]) AS g, unnest(range(1, len(h) + 1)) AS i
        FROM (SELECT {by}, regexp_extract_all(t, '{pattern}') AS h, regexp_split_to_array(t, '{pattern}') AS g FROM {source})))"""


_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
_BYTE = "0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"


@query("op4_sanitise", rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
email AS ({_places("d", "doc_id", _EMAIL)}),
ip AS ({_places("d", "doc_id", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")}),
card AS (SELECT *, reverse(regexp_replace(v, '[^0-9]', '', 'g')) AS r FROM ({_places("d", "doc_id", "[0-9]([ -]?[0-9])+")})),
phone AS ({_places("d", "doc_id", r"\+[0-9][ ().0-9-]+[0-9]")}),
base AS (
  SELECT doc_id, 0 AS k, 'email' AS kind, s, e, v FROM email
  UNION ALL SELECT doc_id, 1, 'ip', s, e, v FROM ip WHERE regexp_full_match(v, '{_BYTE}(\.{_BYTE}){{3}}')
  UNION ALL SELECT doc_id, 2, 'card', s, e, v FROM card WHERE length(r) BETWEEN 12 AND 19 AND list_sum([
    CASE WHEN i % 2 = 1 THEN substr(r, i, 1)::INT ELSE substr(r, i, 1)::INT * 2 - CASE WHEN substr(r, i, 1)::INT > 4 THEN 9 ELSE 0 END END
    for i in range(1, length(r) + 1)]) % 10 = 0
  UNION ALL SELECT doc_id, 3, 'phone', s, e, v FROM phone WHERE length(regexp_replace(v, '[^0-9]', '', 'g')) BETWEEN 9 AND 15),
around AS (SELECT base.*, t, substr(t, greatest(s - 240, 0)::BIGINT + 1, (s - greatest(s - 240, 0))::BIGINT) AS b, substr(t, e::BIGINT + 1, 240) AS a
  FROM base JOIN d USING (doc_id)),
part AS (SELECT doc_id, k, s AS own, kind || ':' || lower(v) AS entity, t AS whole,
    CASE WHEN s > 240 THEN regexp_replace(b, '^[^\x20\x09-\x0D]+', '') ELSE b END AS t, 0 AS side, s AS edge FROM around
  UNION ALL SELECT doc_id, k, s, kind || ':' || lower(v), t, CASE WHEN e + 240 < length(t) THEN regexp_replace(a, '[^\x20\x09-\x0D]+$', '') ELSE a END, 1, e FROM around),
word AS ({_places("part", "doc_id, k, own, side", _EMAIL + r"|\p{L}+")}),
near AS (SELECT doc_id, entity, whole, lower(v) AS term, edge - CASE side WHEN 0 THEN length(t) ELSE 0 END + w.s AS s,
  edge - CASE side WHEN 0 THEN length(t) ELSE 0 END + w.e AS e FROM word w JOIN part USING (doc_id, k, own, side) WHERE v NOT LIKE '%@%'),
n_et AS (SELECT entity, term, count(DISTINCT whole) AS n_et FROM near GROUP BY ALL),
n_e AS (SELECT entity, count(DISTINCT whole) AS n_e FROM near GROUP BY ALL),
u AS (SELECT DISTINCT t FROM d),
n_t AS (SELECT term, count(*) AS n_t FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(t), '\p{{L}}+'))) AS term FROM u) GROUP BY term),
ratio AS (SELECT entity, term, ln(n_et * n::DOUBLE / (n_e * n_t)) / ln(n::DOUBLE / n_e) * n_et / (n_et + 1) AS r
  FROM n_et JOIN n_e USING (entity) JOIN n_t USING (term), (SELECT count(*) AS n FROM u) WHERE n_e < n),
term AS (SELECT doc_id, s, e, max(CASE WHEN r >= 0.7 THEN 5 ELSE 4 END) AS k FROM near JOIN ratio USING (entity, term) WHERE r >= 0.45 GROUP BY ALL),
span AS (SELECT doc_id, k, kind, s, e FROM base UNION ALL SELECT doc_id, k, CASE k WHEN 4 THEN 'generalised' ELSE 'removed' END, s, e FROM term),
out AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip, count(*) FILTER (k = 2) AS n_card, count(*) FILTER (k = 3) AS n_phone,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (k < 4) AS b, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS spans
  FROM span GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN out USING (doc_id)""")
def op4_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(F.array_remove("base.kind", n)) for n in range(len(pii.PATTERNS))]
    counts = [(F.size("base") - other).cast("long").alias(f"n_{kind}") for other, kind in zip(counts, pii.PATTERNS, strict=True)]
    return found.select("doc.doc_id", *counts, F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("spans").alias("spans"))


@query("op7_line_templates", r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS line_no FROM d),
x AS (SELECT doc_id, line_no, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS x FROM l),
w AS (SELECT doc_id, line_no, array_to_string(x, ' ') AS own, [CASE WHEN regexp_matches(y, '[0-9]') THEN '<*>' ELSE y END for y in x] AS w FROM x),
p AS (SELECT doc_id, line_no, own, array_to_string(w, ' ') AS masked, w, len(w) AS n, array_to_string(w[1:3], ' ') AS lead FROM w WHERE len(w) > 0),
k AS (SELECT n, lead, masked, w, min(doc_id) AS lo, max(doc_id) AS hi FROM p GROUP BY ALL),
t AS (SELECT n, lead, masked, lo, hi, unnest(w) AS token, unnest(range(len(w))) AS place FROM k),
c AS (SELECT n, lead, place, token FROM t WHERE token <> '<*>' GROUP BY ALL HAVING min(lo) < max(hi)),
m AS (SELECT t.*, c.token IS NOT NULL AS constant, n <= 3 OR place >= 3 AS counts FROM t LEFT JOIN c USING (n, lead, place, token)),
templates AS (SELECT n, lead, masked, CASE WHEN 100 * count(*) FILTER (counts AND constant) >= 60 * count(*) FILTER (counts)
  THEN string_agg(CASE WHEN constant THEN token ELSE '<*>' END, ' ' ORDER BY place) END AS template FROM m GROUP BY n, lead, masked),
q AS (SELECT doc_id, line_no, n, lead, template IS NULL AS alone, coalesce(template, own) AS template FROM p JOIN templates USING (n, lead, masked)),
r AS (SELECT n, lead, alone, template, min(doc_id) AS first FROM q GROUP BY ALL HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, line_no FROM q JOIN r USING (n, lead, alone, template) WHERE doc_id > first),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS t, count(*) AS n FROM l ANTI JOIN gone USING (doc_id, line_no) GROUP BY doc_id)
SELECT d.doc_id, len(lines)::BIGINT AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""")
def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc.doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"),
        F.sha2("kept", 256).alias("kept_sha256"))


def _sha1(body: str) -> str:
    return f"""'sha1:' || (SELECT string_agg(substr('{warc.BASE32}', (v >> s) % 32 + 1, 1), '' ORDER BY g, s DESC) FROM
      (SELECT g, ('0x' || substr(sha1({body}), 5 * g + 1, 5))::INT AS v FROM range(8) AS groups(g)), (SELECT unnest([15, 10, 5, 0]) AS s))"""


def _urn(*parts: str) -> str:
    h = "md5(" + " || chr(0) || ".join(f"coalesce({p}, '')" for p in parts) + ")"
    return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'"


def _decoded(text: str) -> str:
    known = "MAP {" + ", ".join(f"'&{name};': '{char.replace(chr(39), chr(39) * 2)}'" for name, char in warc.ENTITIES.items()) + "}"
    one = f"""CASE WHEN e[2] <> '#' THEN coalesce({known}[e], e) ELSE chr(
      CASE WHEN number(e) = 0 OR number(e) BETWEEN 55296 AND 57343 OR number(e) > 1114111 THEN 65533 ELSE number(e) END) END"""
    number = "(CASE WHEN lower(e[3]) = 'x' THEN ('0x' || e[4:len(e) - 1])::INT ELSE e[3:len(e) - 1]::INT END)"
    one = one.replace("number(e)", number)
    pattern = warc._ENTITY
    return f"""(WITH x AS (SELECT regexp_split_to_array({text}, '{pattern}') AS g, regexp_extract_all({text}, '{pattern}') AS h)
      SELECT array_to_string([g[i] || coalesce([{one} for e in [h[i]]][1], '') for i in range(1, len(g) + 1)], '') FROM x)"""


def _tidy(text: str) -> str:
    blanks = f"regexp_replace({text}, '[ \\t\\x0B\\f\\r ]+', ' ', 'g')"
    return f"regexp_replace(regexp_replace({blanks}, ' ?\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+\\z', '', 'g')"


def _field(name: str, value: str) -> str:
    return f"coalesce('{name}: ' || {value} || e.crlf, '')"


_ONE_LINE = "regexp_replace(nullif({0}, ''), '[\\r\\n]+', ' ', 'g')"


@query("op1_warc_derivatives", rf"""
WITH e AS (SELECT chr(13) || chr(10) AS crlf),
p AS (SELECT page_id, url, coalesce(html, '') AS payload, {_urn("'response'", "page_id::VARCHAR", "url")} AS id,
  regexp_replace(coalesce(html, ''), '{warc._HIDDEN}', ' ', 'g') AS shown FROM pages),
q AS (SELECT *, regexp_replace(regexp_replace(shown, '{warc._BREAK}', chr(10), 'g'), '{warc._TAG}', '', 'g') AS plain,
  regexp_extract(payload, '(?is)<title([ \t\r\n/][^>]*)?>(.*?)</title', 2) AS title,
  regexp_extract(payload, '(?is)<html[^>]*[ \t\r\n]lang=["'']?([a-zA-Z-]+)', 1) AS language,
  regexp_extract_all(shown, '(?is)<a[ \t\r\n][^>]*href="([^"]*)"', 1) AS links FROM p),
r AS (SELECT *, {_tidy(_decoded("plain"))} AS text, {_tidy(_decoded("title"))} AS name FROM q),
s AS (SELECT r.*, {_sha1("payload")} AS payload_digest, 'HTTP/1.1 200 OK' || crlf || 'Content-Type: text/html; charset=utf-8' || crlf || 'Content-Length: '
  || strlen(payload) AS http, {_sha1("text")} AS text_digest, {_urn("'metadata'", "id")} AS metadata_id, {_urn("'conversion'", "id")} AS conversion_id FROM r, e),
t AS (SELECT *, {_sha1("http || crlf || crlf || payload")} AS source_digest FROM s, e),
rec AS (SELECT page_id, 'metadata' AS warc_type, metadata_id AS record_id, id AS refers_to, url, payload_digest, NULL AS concurrent, 'application/warc-fields' AS content_type,
    {_field("title", _ONE_LINE.format("name"))} || {_field("language", _ONE_LINE.format("language"))} || {_field("source-block-digest", "source_digest")}
    || {_field("source-payload-digest", "payload_digest")} || {_field("conversion", "conversion_id")} || {_field("conversion-digest", "text_digest")}
    || array_to_string(['source-header: ' || x || e.crlf for x in string_split(http, e.crlf)], '')
    || array_to_string(['outlink: ' || regexp_replace(x, '[\r\n]+', ' ', 'g') || e.crlf for x in links], '') AS block FROM t, e
  UNION ALL SELECT page_id, 'conversion', conversion_id, id, url, payload_digest, metadata_id, 'text/plain; charset=utf-8', text FROM t),
dig AS (SELECT *, {_sha1("block")} AS block_digest FROM rec)
SELECT page_id, warc_type, record_id, refers_to, block_digest, strlen(block)::BIGINT AS content_length, sha256(block) AS block_sha256,
  'WARC/1.1' || e.crlf || {_field("WARC-Type", "warc_type")} || {_field("WARC-Record-ID", "record_id")} || {_field("WARC-Date", "'2024-01-01T00:00:00Z'")}
  || {_field("WARC-Refers-To", "refers_to")} || {_field("WARC-Refers-To-Payload-Digest", "payload_digest")} || {_field("WARC-Concurrent-To", "concurrent")}
  || {_field("WARC-Target-URI", "url")} || {_field("WARC-Block-Digest", "block_digest")} || {_field("Content-Type", "content_type")}
  || {_field("Content-Length", "strlen(block)")} AS header
FROM dig, e""")
def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derivatives(warc.page_responses(table(spark, sf_dir, "pages")))
    return records.select(
        "source.page_id", "warc_type", "record_id", "refers_to", "block_digest", F.octet_length("block").cast("long").alias("content_length"),
        F.sha2("block", 256).alias("block_sha256"), "header")


@query("op5_sample_pieces")
def op5_sample_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = segment.decode(segment.encode(table(spark, sf_dir, "documents")))
    return back.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), F.crc32(F.array_join("pieces", ",").cast("binary")).alias("pieces_crc32"),
                       F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"))


_CRC32 = """xor(4294967295, list_reduce([4294967295::UBIGINT] || [ascii(x)::UBIGINT for x in string_split({0}::VARCHAR, '')],
  lambda c, x: list_reduce([xor(c, x)] || [0::UBIGINT for i in range(8)], lambda a, b: xor(a >> 1, 3988292384::UBIGINT * (a & 1)))))"""


@query("op13_prefix_trie", f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY i) AS turns FROM t GROUP BY conv_id),
c AS (SELECT conv_id, turns, {_CRC32.format("conv_id")} % 9 AS h FROM o),
s AS (SELECT c.conv_id, (coalesce(b.turns, []))[1:c.h] || c.turns[c.h + 1:] AS seq FROM c LEFT JOIN o b ON b.conv_id = c.conv_id - c.conv_id % 5),
p AS (SELECT conv_id, seq, d, seq[1:d] AS node FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM s)),
n AS (SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(strlen(any_value(node[d].t)), 0) AS bytes,
  coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = d), '') AS ends FROM p GROUP BY d, node),
k AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
u AS (SELECT node[1:e] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS e FROM f) GROUP BY ALL)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN u USING (node) LEFT JOIN f q ON f.d > 0 AND q.node = f.node[1:f.d - 1]""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stage(prefix_trie.rebuilt(prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))), "rebuilt")
    return prefix_trie.prefix_trie(turns)


@query("op11_shard_documents")
def op11_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op12_align_tokenizers")
def op12_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
