"""Registered queries over the given tables, and the SQL that gives the same rows.

The tables play the parts of manifests, traces and reports; each query says how. ``_sql`` texts are DuckDB's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import decode, gate, markup, markup_tree, rtf
from ..functions.paths import classify_location, matches_pattern, split_path, shortened
from ..operators import batches, convert, metrics, outcomes, verify
from ..sources import corpus, reports
from .registry import ORACLES, QUERIES, query, table


# --- pages as a corpus -------------------------------------------------------------------------------------------

FOLDER_SQL = "coalesce(nullif(regexp_extract(url, '://[^/]+/([^/?#]+)', 1), ''), 'root')"
SCRIPT_SQL = "regexp_replace(html, '(?i)<script\\b[^>]*>[\\s\\S]*?</script\\s*>', '', 'g')"


def page_files(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "pages")
    return p.select("page_id", corpus.url_folder(F.col("url")).alias("date_folder"), F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("length"))


@query(f"""SELECT {FOLDER_SQL} AS date_folder, count(*) AS documents, sum(strlen(html))::BIGINT AS bytes_in,
  sum(strlen({SCRIPT_SQL}))::BIGINT AS bytes_clean, count(*) AS succeeded, 0::BIGINT AS failed FROM pages GROUP BY 1""")
def folder_outcomes(s, d):
    """Documents, bytes and outcomes by folder after the clean-up."""
    files = decode.read_documents(corpus.pages_corpus(table(s, d, "pages")))
    error = F.coalesce("error", gate.content_error(F.col("text")))
    clean = markup.remove_empty_anchors(markup.remove_scripts(F.col("text")))
    rows = files.select("date_folder", "text", error.alias("error"), clean.alias("clean"))
    return rows.groupBy("date_folder").agg(
        F.count("*").alias("documents"),
        F.sum(F.octet_length("text")).cast("long").alias("bytes_in"),
        F.sum(F.octet_length("clean")).cast("long").alias("bytes_clean"),
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


@query(f"SELECT {FOLDER_SQL} AS date_folder, count(*) AS files, sum(strlen(html))::BIGINT AS bytes FROM pages GROUP BY 1")
def scan_folders(s, d):
    return metrics.scan_folders(page_files(s, d))


@query(f"""SELECT CASE WHEN grouping(f) = 1 THEN 'TOTAL' ELSE f END AS date_folder, count(*) AS files, sum(n)::BIGINT AS bytes
  FROM (SELECT {FOLDER_SQL} AS f, strlen(html) AS n FROM pages) GROUP BY ROLLUP (f)""")
def dry_run_report(s, d):
    return metrics.dry_run_report(page_files(s, d))


@query(f"""WITH n AS (SELECT {FOLDER_SQL} AS f, count(*) AS n FROM pages GROUP BY 1)
  SELECT floor(log2(n))::BIGINT AS size_class, n >= 8 AS fills_workers, count(*) AS folders FROM n GROUP BY 1, 2""")
def folder_shape(s, d):
    return metrics.folder_shape(page_files(s, d), 8)


@query("SELECT ceil(sum(strlen(html)) * 1.6)::BIGINT AS needed_bytes, ceil(sum(strlen(html)) * 1.6) > 1000000 AS short FROM pages")
def capacity_estimate(s, d):
    return metrics.capacity_estimate(metrics.scan_folders(page_files(s, d)), 1_000_000, base64=True)


@query("""WITH p AS (SELECT page_id, regexp_extract(url, '://[^/]+/([^?#]*)', 1) AS r FROM pages), q AS (SELECT *, regexp_extract(r, '([^/]*)$', 1) AS n FROM p)
  SELECT page_id, CASE WHEN contains(r, '/') THEN regexp_replace(r, '/[^/]*$', '') ELSE '' END AS sub_folder, n AS file_name,
  CASE WHEN contains(n, '.') THEN regexp_replace(n, '\\.[^.]*$', '') ELSE n END AS stem, regexp_extract(n, '(\\.[^.]*)$', 1) AS ext FROM q""")
def split_paths(s, d):
    rows = table(s, d, "pages").select("page_id", F.regexp_extract("url", "://[^/]+/([^?#]*)", 1).alias("rel_path"))
    return split_path(rows).drop("rel_path")


@query("""SELECT page_id, sha256(to_base64(encode(html))) AS envelope_sha256, sha256(html) AS text_sha256, strlen(to_base64(encode(html)))::BIGINT AS input_bytes FROM pages""")
def base64_round_trip(s, d):
    p = table(s, d, "pages").select("page_id", decode.base64_line(F.encode("html", "UTF-8")).cast("binary").alias("content"))
    out = decode.read_documents(p)
    return out.select("page_id", F.sha2("content", 256).alias("envelope_sha256"), F.sha2("text", 256).alias("text_sha256"), "input_bytes")


@query("""SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'The file is empty: there is no Base64 content to decode.' WHEN 1 THEN 'The file is not valid Base64 content.'
  WHEN 2 THEN 'The file is not valid Base64 content.' WHEN 5 THEN 'The file is not valid Base64 content.' END AS message,
  CASE WHEN page_id % 7 IN (3, 4, 6) THEN sha256(html) END AS text_sha256 FROM pages""")
def envelope_faults(s, d):
    """By page_id % 7: empty, raw markup, one character missing, wrapped lines, a mark before, a byte that is no ASCII, plain."""
    k, line = F.col("page_id") % 7, decode.base64_line(F.encode("html", "UTF-8"))
    content = F.when(k == 0, F.lit(b"")).when(k == 1, F.encode("html", "UTF-8")).when(k == 2, F.encode(F.expr("substring(line, 1, length(line) - 1)"), "UTF-8"))
    content = content.when(k == 3, F.encode(F.regexp_replace("line", "(.{60})", "$1\r\n"), "UTF-8")).when(k == 4, F.concat(F.lit(b"\xef\xbb\xbf"), F.encode("line", "UTF-8")))
    content = content.when(k == 5, F.concat(F.lit(b"\xe9"), F.encode("line", "UTF-8"))).otherwise(F.encode("line", "UTF-8"))
    rows = table(s, d, "pages").withColumn("line", line).select("page_id", content.alias("content"))
    return decode.read_documents(rows).select("page_id", F.col("error.message").alias("message"), F.sha2("text", 256).alias("text_sha256"))


@query("""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, doc_id % 5 AS k, regexp_matches(coalesce(text, ''), '[^\\x00-\\x7F\\x{A0}-\\x{FF}]') AS wide FROM documents)
  SELECT doc_id, sha256(CASE WHEN k = 3 THEN '<meta charset="utf-8">' || text ELSE text END) AS text_sha256,
  CASE WHEN k = 2 THEN 'UTF-16LE' WHEN k = 4 AND NOT wide AND regexp_matches(text, '[^\\x00-\\x7F]') THEN 'windows-1252' ELSE 'UTF-8' END AS encoding FROM t""")
def decode_charsets(s, d):
    """Texts by doc_id % 5: plain UTF-8, with a mark, UTF-16 with a mark, declared in a meta tag, Latin-1 undeclared where it holds the text (else UTF-8)."""
    k, t = F.col("doc_id") % 5, F.coalesce("text", F.lit(""))
    latin = (k == 4) & ~t.rlike("[^\\x00-\\x7F\\xA0-\\xFF]")
    data = F.when(k == 1, F.concat(F.lit(b"\xef\xbb\xbf"), F.encode(t, "UTF-8"))).when(k == 2, F.concat(F.lit(b"\xff\xfe"), F.encode(t, "UTF-16LE")))
    data = data.when(k == 3, F.encode(F.concat(F.lit('<meta charset="utf-8">'), t), "UTF-8")).when(latin, F.encode(F.when(latin, t).otherwise(""), "ISO-8859-1")).otherwise(F.encode(t, "UTF-8"))
    out = decode.decode_text(table(s, d, "documents").select("doc_id", data.alias("payload")))
    return out.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "encoding")


@query("""SELECT kind, id, CASE WHEN NOT regexp_matches(t, '[^\\s]') THEN 'empty' WHEN kind = 'binary' THEN 'binary' WHEN NOT regexp_matches(t, '<\\s*[a-zA-Z][a-zA-Z0-9:._-]*(\\s|/|>)') THEN 'no element' ELSE 'ok' END AS verdict
  FROM (SELECT 'page' AS kind, page_id AS id, html AS t FROM pages UNION ALL SELECT 'document', doc_id, text FROM documents
  UNION ALL SELECT 'blank', page_id, '  ' FROM pages UNION ALL SELECT 'binary', page_id, '<p>' || repeat(chr(1), 50) || html FROM pages)""")
def content_gate(s, d):
    """Pages pass, documents hold no markup; blank and binary texts are planted."""
    p = table(s, d, "pages")
    rows = p.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("t"))
    rows = rows.unionByName(table(s, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("t")))
    rows = rows.unionByName(p.select(F.lit("blank").alias("kind"), F.col("page_id").alias("id"), F.lit("  ").alias("t")))
    planted = F.concat(F.lit("<p>"), F.lit("\x01" * 50), "html")
    rows = rows.unionByName(p.select(F.lit("binary").alias("kind"), F.col("page_id").alias("id"), planted.alias("t")))
    said = F.col("e.message")
    short = F.when(said.isNull(), "ok").when(F.contains(said, F.lit("empty")), "empty").when(F.contains(said, F.lit("binary")), "binary").otherwise("no element")
    return rows.select("kind", "id", gate.content_error(F.col("t")).alias("e")).select("kind", "id", short.alias("verdict"))


# --- clean-up passes -----------------------------------------------------------------------------------------------


@query(f"SELECT page_id, sha256({SCRIPT_SQL}) AS text_sha256 FROM pages")
def remove_scripts(s, d):
    return table(s, d, "pages").select("page_id", F.sha2(markup.remove_scripts(F.col("html")), 256).alias("text_sha256"))


ESCAPED_SQL = "replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
PARAGRAPH = '<div style="margin-left: 32px; text-indent: -17px;">&#8226;&#160;'


def _shaped(s, d, *parts: str) -> DataFrame:
    """Documents as clinical-shaped markup: ``parts`` around the escaped text, which stands for ``{}``."""
    text = F.coalesce("text", F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    rows = table(s, d, "documents").select("doc_id", text.alias("escaped"))
    return rows.select("doc_id", F.concat(*[F.col("escaped") if p == "{}" else F.lit(p) for p in parts]).alias("text"))


def _shape_sql(*parts: str) -> str:
    body = " || ".join(ESCAPED_SQL if p == "{}" else "'" + p.replace("'", "''") + "'" for p in parts)
    return f"SELECT doc_id, sha256({body}) AS text_sha256 FROM documents"


def _hashed(rows: DataFrame, text) -> DataFrame:
    return rows.select("doc_id", text.alias("t")).select("doc_id", F.sha2("t", 256).alias("text_sha256"))


@query(_shape_sql('<html lang="x"><body xmlns:b="c"><p>', "{}", "</p></body></html>"))
def remove_root_namespaces(s, d):
    rows = _shaped(s, d, "<html xmlns=\"http://www.w3.org/1999/xhtml\" lang=\"x\" xmlns:v='urn:v'><body xmlns:b=\"c\"><p>", "{}", "</p></body></html>")
    return _hashed(rows, markup.remove_root_namespaces(F.col("text")))


@query(_shape_sql('<p>', "{}", '<a href="#y"></a><a name="k">kept</a></p><!-- <a name="c"></a> -->'))
def remove_empty_anchors(s, d):
    rows = _shaped(s, d, '<p><a name="_1"></a>', "{}", '<A NAME="b"/><a href="#y"></a><a data-href="#z" name="d"> </a><a name="k">kept</a></p><!-- <a name="c"></a> -->')
    return _hashed(rows, markup.remove_empty_anchors(F.col("text")))


@query(_shape_sql("<p>", "{}", "</p>"))
def remove_styled_elements(s, d):
    rows = _shaped(s, d, '<p><div style="DISPLAY : none;"><div>inner</div>hidden</div>', "{}", '<span style=\'color:red;display:none\'/></p>')
    return _hashed(rows, markup_tree.apply_pass(F.col("text"), "remove_styled_elements", "display:none"))


@query(_shape_sql('<span style="text-decoration: line-through;"><b><span style="text-decoration: underline;"><s>', "{}", "</s></span></b></span>"))
def keep_ancestor_strike(s, d):
    rows = _shaped(s, d, '<span style="text-decoration: line-through;"><b><span style="text-decoration: underline;">', "{}", "</span></b></span>")
    return _hashed(rows, markup_tree.apply_pass(F.col("text"), "keep_ancestor_strike"))


@query(_shape_sql("<div>", PARAGRAPH, "{}", "</div></div>"))
def bullet_tables(s, d):
    rows = _shaped(s, d, '<div><table><tbody><tr><td width="24"><span>&#8226;</span></td><td>&nbsp;</td><td><div>', "{}", "</div></td></tr></tbody></table></div>")
    return _hashed(rows, markup_tree.apply_pass(F.col("text"), "bullet_tables_to_paragraphs"))


@query(_shape_sql(PARAGRAPH, "<b>", "{}", "</b></div>", PARAGRAPH, "two</div>"))
def lists_to_paragraphs(s, d):
    rows = _shaped(s, d, '<ul style="list-style-type: disc"><li><b>', "{}", "</b></li> <li> two </li></ul>")
    return _hashed(rows, markup_tree.apply_pass(F.col("text"), "lists_to_paragraphs"))


@query(_shape_sql("<html><body>", PARAGRAPH, "<b>", "{}", "</b></div></body></html>"))
def normalize_chain(s, d):
    """All passes in their order; removing the hidden block empties an anchor, which then goes too."""
    rows = _shaped(s, d, '<html xmlns="urn:x"><body><script>x()</script><a name="q"><div style="display: none">h</div></a><ul><li><b>', "{}", "</b></li></ul></body></html>")
    return _hashed(rows, markup_tree.normalize(F.col("text"), markup_tree.CleanUp(styled="display:none"))["text"])


TAGS_SQL = """WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '<!--[\\s\\S]*?-->|<![^>]*>|</?[A-Za-z][A-Za-z0-9:._-]*\\b(?:"[^"]*"|''[^'']*''|[^''">])*>')) AS token,
  generate_subscripts(regexp_extract_all(html, '<!--[\\s\\S]*?-->|<![^>]*>|</?[A-Za-z][A-Za-z0-9:._-]*\\b(?:"[^"]*"|''[^'']*''|[^''">])*>'), 1) - 1 AS pos FROM pages),
  g AS (SELECT page_id, pos, lower(regexp_extract(token, '^</?([A-Za-z][A-Za-z0-9:._-]*)', 1)) AS name, starts_with(token, '</') AS closing,
  regexp_matches(token, '/\\s*>$') AS self_closing FROM t WHERE regexp_matches(token, '^</?[A-Za-z]'))"""
STEP_SQL = "CASE WHEN self_closing AND NOT closing THEN 0 WHEN closing THEN -1 ELSE 1 END"


def _tokens(s, d) -> DataFrame:
    return markup.markup_tokens(table(s, d, "pages"), "page_id", "html")


@query(TAGS_SQL + " SELECT page_id, pos::BIGINT AS pos, name, closing, self_closing FROM g")
def markup_tokens(s, d):
    return _tokens(s, d).select("page_id", F.col("pos").cast("long").alias("pos"), "name", "closing", "self_closing")


@query(TAGS_SQL + f", e AS (SELECT *, sum({STEP_SQL}) OVER (PARTITION BY page_id, name ORDER BY pos) AS depth FROM g) SELECT page_id, name, max(depth)::BIGINT AS deepest FROM e GROUP BY 1, 2")
def token_depth(s, d):
    return markup.token_depth(_tokens(s, d), "page_id").groupBy("page_id", "name").agg(F.max("depth").alias("deepest"))


OFFSETS_SQL = TAGS_SQL.replace("AS pos FROM pages)", "AS pos, html FROM pages)") + """, o AS (SELECT page_id, pos, token, length(token) AS n, length(string_split_regex(html, '<!--[\\s\\S]*?-->|<![^>]*>|</?[A-Za-z][A-Za-z0-9:._-]*\\b(?:"[^"]*"|''[^'']*''|[^''">])*>')[pos + 1]) AS gap FROM t),
  f AS (SELECT page_id, pos, n, sum(gap + n) OVER (PARTITION BY page_id ORDER BY pos) - n AS place FROM o), e AS (SELECT g.*, n, place, sum(CASE WHEN closing THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, name ORDER BY pos) + CASE WHEN closing THEN 1 ELSE 0 END AS level
  FROM g JOIN f USING (page_id, pos) WHERE closing OR NOT self_closing)"""


@query(OFFSETS_SQL + """ SELECT page_id, name, a.pos::BIGINT AS open, c.pos::BIGINT AS close, a.place::BIGINT AS open_offset, a.n::BIGINT AS open_length, c.place::BIGINT AS close_offset, c.n::BIGINT AS close_length
  FROM e a LEFT JOIN LATERAL (SELECT pos, place, n FROM e x WHERE x.page_id = a.page_id AND x.name = a.name AND x.level = a.level AND x.pos > a.pos AND x.closing ORDER BY pos LIMIT 1) c ON true WHERE NOT a.closing""")
def matching_closes(s, d):
    """Each opening tag of all pages with its close, and where both stand."""
    rows = markup.matching_closes(markup.token_offsets(table(s, d, "pages"), "page_id", "html"), "page_id")
    return rows.withColumns({"open": F.col("open").cast("long"), "close": F.col("close").cast("long")})


@query(TAGS_SQL + f" SELECT page_id, name, sum({STEP_SQL})::BIGINT AS open FROM g GROUP BY 1, 2 HAVING sum({STEP_SQL}) <> 0")
def unbalanced_tags(s, d):
    return markup.unbalanced_tags(_tokens(s, d), "page_id")


@query(TAGS_SQL + " SELECT name, count(*) AS tags, count(DISTINCT page_id) AS documents FROM g WHERE NOT closing GROUP BY 1")
def markup_profile(s, d):
    return markup.markup_profile(_tokens(s, d), "page_id")


SEVEN_SQL = """WITH n AS (SELECT doc_id % 8 AS k, count(*) AS n FROM documents GROUP BY 1), p AS (SELECT unnest(range(7)) AS k,
  unnest(['remove_scripts', 'remove_styled_elements', 'remove_root_namespaces', 'remove_empty_anchors', 'keep_ancestor_strike', 'bullet_tables_to_paragraphs', 'lists_to_paragraphs']) AS pass)"""


def faulty_documents(s, d) -> DataFrame:
    """Documents as markup, each with something for one of the seven passes by doc_id % 8; the eighth has nothing."""
    found = ["<script>x()</script>", '<div style="display: none">h</div>', "", '<a name="q"></a>', '<i style="text-decoration: line-through"><b style="text-decoration: underline">u</b></i>']
    found += ["<table><tr><td>&#8226;</td><td> </td><td>t</td></tr></table>", "<ul><li>i</li></ul>", ""]
    k = (F.col("doc_id") % 8).cast("int")
    rows = _shaped(s, d, "{}")
    part = F.element_at(F.array(*[F.lit(x) for x in found]), k + 1)
    return rows.select("doc_id", F.concat(F.when(k == 2, '<html xmlns="urn:x">').otherwise("<html>"), F.lit("<p>"), "text", part, F.lit("</p></html>")).alias("text"))


@query(SEVEN_SQL + " SELECT pass, n AS documents FROM p JOIN n USING (k)")
def changed_by_pass(s, d):
    """Documents that each of the seven passes, applied alone, alters."""
    rows = markup.changed_by_pass(faulty_documents(s, d), "doc_id", "text", markup_tree.all_passes(F.col("text"), "display:none"))
    return rows.groupBy("pass").agg(F.count("*").alias("documents"))


@query("""SELECT count(*) AS documents, count(*) FILTER (doc_id % 8 = 0) / count(*) AS scripts, count(*) FILTER (doc_id % 8 = 1) / count(*) AS hidden_blocks,
  count(*) FILTER (doc_id % 8 = 3) / count(*) AS empty_anchors, count(*) FILTER (doc_id % 8 = 5) / count(*) AS bullet_tables FROM documents""")
def markup_shares(s, d):
    """Shares of documents with scripts, hidden blocks, empty anchors and bullet tables."""
    return markup_tree.markup_shares(faulty_documents(s, d), "text", "display:none")


@query("""SELECT page_id, sha256(regexp_replace(regexp_replace(html, '<!--[\\s\\S]*?-->|<![^>]*>|</?[A-Za-z][A-Za-z0-9:._-]*\\b(?:"[^"]*"|''[^'']*''|[^''">])*>', '', 'g'), '^\\s+|\\s+$', '', 'g')) AS text_sha256 FROM pages""")
def strip_tags(s, d):
    return table(s, d, "pages").select("page_id", F.sha2(markup.strip_tags(F.col("html")), 256).alias("text_sha256"))


# ESCAPED and RTF forms of a text; characters beyond the 16-bit plane stand as two halves
RTF_TEXT_SQL = r"""replace(replace(replace(t, '\', '\\'), '{', '\{'), '}', '\}')"""


@query()
def render_pages(s, d):
    """Pages as RTF (E15): size, and whether each byte is ASCII."""
    rows = convert.convert(table(s, d, "pages").select("page_id", F.col("html").alias("text")), rtf.render_rtf)
    return rows.select("page_id", F.octet_length("rtf").cast("long").alias("output_bytes"), F.col("rtf").rlike("^\\{\\\\rtf1[\\x00-\\x7F]*$").alias("ascii"), "rtf_error")


@query("SELECT page_id % 4 = 1 AS faulty, count(*) AS documents, CASE WHEN page_id % 4 = 1 THEN 'Failed:Permanent' ELSE 'Succeeded' END AS outcome, CASE WHEN page_id % 4 = 1 THEN 'The file is not a decodable Base64 envelope' END AS reason FROM pages GROUP BY ALL")
def convert_corpus(s, d):
    """The whole conversion over pages; every fourth envelope is raw markup."""
    p = table(s, d, "pages")
    raw = F.when(F.col("page_id") % 4 == 1, F.encode("html", "UTF-8")).otherwise(decode.base64_line(F.encode("html", "UTF-8")).cast("binary"))
    out = convert.convert_files(p.select("page_id", raw.alias("content")))
    return out.groupBy((F.col("page_id") % 4 == 1).alias("faulty"), "outcome", "reason").agg(F.count("*").alias("documents"))


# --- documents as a manifest ---------------------------------------------------------------------------------------

NAME_SQL = "source || '_' || doc_id || CASE doc_id % 10 WHEN 0 THEN '.XHTML' WHEN 1 THEN '.pdf' WHEN 2 THEN '.xhtml.bak' ELSE '.xhtml' END"


def document_files(s, d) -> DataFrame:
    ext = F.when(F.col("doc_id") % 10 == 0, ".XHTML").when(F.col("doc_id") % 10 == 1, ".pdf").when(F.col("doc_id") % 10 == 2, ".xhtml.bak").otherwise(".xhtml")
    name = F.concat("source", F.lit("_"), F.col("doc_id").cast("string"), ext)
    rows = table(s, d, "documents").select("doc_id", F.col("lang").alias("date_folder"), F.concat_ws("/", "source", name).alias("rel_path"), F.col("n_chars").alias("length"), "text")
    return split_path(rows).withColumn("folder_path", F.concat(F.lit("/in/"), "date_folder")).withColumn("path", F.concat_ws("/", "folder_path", "rel_path"))


@query(f"SELECT doc_id, lower({NAME_SQL}) LIKE '%.xhtml' AS matched FROM documents")
def match_pattern(s, d):
    return document_files(s, d).select("doc_id", matches_pattern(F.col("file_name"), "*.xhtml").alias("matched"))


@query(f"""SELECT lang AS date_folder, source AS sub_folder, {NAME_SQL} AS file_name, 'scan' AS batch_id, 'Discovery' AS source, 0::BIGINT AS attempts,
  'File name does not match *.xhtml' AS reason FROM documents WHERE NOT lower({NAME_SQL}) LIKE '%.xhtml'""")
def quarantine_unmatched(s, d):
    return outcomes.quarantine_unmatched(document_files(s, d), "*.xhtml").select("date_folder", "sub_folder", "file_name", "batch_id", "source", "attempts", "reason")


@query(f"""WITH c AS (SELECT row_number() OVER (PARTITION BY lang ORDER BY source || '/' || {NAME_SQL} COLLATE "C") AS n, doc_id, lang FROM documents)
  SELECT doc_id, ((n - 1) // 100 + 1)::BIGINT AS batch_no, lang || '#' || lpad(((n - 1) // 100 + 1)::VARCHAR, 4, '0') AS batch_id FROM c""".replace(' COLLATE "C"', ""))
def assign_batches(s, d):
    return batches.assign_batches(document_files(s, d), 100).select("doc_id", "batch_no", "batch_id")


@query("SELECT lang AS date_folder, greatest(1, ceil(count(*) / 100))::BIGINT AS batches FROM documents GROUP BY 1")
def batch_count(s, d):
    n = document_files(s, d).groupBy("date_folder").agg(F.count("*").alias("n"))
    return n.select("date_folder", batches.batch_count("n", 100).alias("batches"))


@query("SELECT row_number() OVER (ORDER BY doc_id) AS row, doc_id FROM documents")
def global_row_numbers(s, d):
    return batches.number_rows(table(s, d, "documents").select("doc_id"), ["doc_id"])


@query(f"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'archived' WHEN 1 THEN 'error' WHEN 2 THEN 'unprocessed' END AS location FROM documents""")
def classify_locations(s, d):
    k = F.col("doc_id") % 4
    path = F.concat(F.lit("/in/x/"), F.when(k == 0, "archive/p/a.xhtml").when(k == 1, "error/a.xhtml").when(k == 2, "p/a.xhtml").otherwise("error/a.error.log"))
    return table(s, d, "documents").select("doc_id", classify_location(path).alias("location"))


@query(f"""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '/in/' || lang || '/archive/' || source || '/' || {NAME_SQL} WHEN doc_id % 3 = 1 THEN '/in/' || lang || '/error/' || source || '/' || {NAME_SQL} END AS destination FROM documents""")
def plan_disposition(s, d):
    k = F.col("doc_id") % 3
    rows = document_files(s, d).withColumn("outcome", F.when(k == 0, "Succeeded").when(k == 1, "Failed:Permanent").otherwise("Fatal"))
    return outcomes.plan_disposition(rows).select("doc_id", "destination")


@query("""WITH n AS (SELECT doc_id, '/archive/' || lang || '/' || source || '.xhtml' AS dest, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS k FROM documents),
  t AS (SELECT DISTINCT lang, source FROM documents WHERE source IN ('src0', 'src1')), m AS (SELECT n.*, CASE WHEN regexp_matches(dest, '/src[01]\\.') THEN k ELSE k - 1 END AS need FROM n)
  SELECT doc_id, CASE WHEN need = 0 THEN dest ELSE replace(dest, '.xhtml', '_' || (CASE WHEN regexp_matches(dest, '/src[01]\\.') AND need >= 2 THEN need + 1 ELSE need END) || '.xhtml') END AS final FROM m""")
def resolve_collisions(s, d):
    """Documents of a language and source go to one name; for two sources that name, and its number 2, are taken."""
    dest = F.concat(F.lit("/archive/"), "lang", F.lit("/"), "source", F.lit(".xhtml"))
    rows = table(s, d, "documents").select("doc_id", dest.alias("destination"), "source")
    taken = rows.where(F.col("source").isin("src0", "src1")).select(F.upper("destination").alias("destination")).distinct()
    taken = taken.unionByName(taken.select(F.replace("destination", F.lit(".XHTML"), F.lit("_2.xhtml")).alias("destination")))
    return outcomes.resolve_collisions(rows.drop("source"), taken, order="doc_id").select("doc_id", "final")


@query("""SELECT lower(lang || '/' || source || '/' || 'n' || (doc_id % 40 // 20) || '.rtf') AS output, count(*) AS inputs FROM documents GROUP BY 1 HAVING count(*) > 1""")
def output_name_clashes(s, d):
    rows = table(s, d, "documents").select(F.col("lang").alias("date_folder"), F.col("source").alias("sub_folder"), F.concat(F.lit("n"), F.floor(F.col("doc_id") % 40 / 20).cast("string")).alias("stem"))
    return outcomes.output_name_clashes(rows)


@query("SELECT doc_id FROM documents WHERE lang NOT IN ('fr', 'de')")
def skip_completed_folders(s, d):
    done = s.createDataFrame([("FR",), ("de",)], "date_folder string")
    return outcomes.skip_completed_folders(document_files(s, d), done).select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id % 2 = 1")
def skip_already_converted(s, d):
    files = document_files(s, d)
    from ..functions.paths import output_path_of

    there = files.where("doc_id % 2 = 0").select(output_path_of(F.col("date_folder"), F.col("sub_folder"), F.col("stem")).alias("output"))
    return outcomes.skip_already_converted(files, there).select("doc_id")


@query("""SELECT a.doc_id::VARCHAR AS rel_path, sha256(a.text) AS left_hash, CASE WHEN a.doc_id % 7 <> 0 THEN sha256(a.text || '!') END AS right_hash FROM documents a WHERE a.doc_id % 7 = 0 OR a.doc_id % 11 = 0""")
def tree_diff(s, d):
    """Two trees of the same texts: one lacks every seventh file, and differs in every eleventh."""
    left = table(s, d, "documents").select(F.col("doc_id").cast("string").alias("rel_path"), "doc_id", F.encode("text", "UTF-8").alias("content"))
    right = left.where("doc_id % 7 <> 0").select("rel_path", F.when(F.col("doc_id") % 11 == 0, F.concat("content", F.lit(b"!"))).otherwise(F.col("content")).alias("content"))
    return verify.tree_diff(left.select("rel_path", "content"), right)


@query("""WITH a AS (SELECT lang AS f, count(*) AS n FROM documents GROUP BY 1), b AS (SELECT lang AS f, count(*) AS n FROM documents WHERE doc_id % 50 <> 3 GROUP BY 1)
  SELECT coalesce(a.f, b.f) AS date_folder, coalesce(a.n, 0) AS scanned, coalesce(b.n, 0) AS processed, coalesce(b.n, 0) - coalesce(a.n, 0) AS drift FROM a FULL JOIN b USING (f) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def manifest_drift(s, d):
    files = document_files(s, d)
    return verify.manifest_drift(files, files.where("doc_id % 50 <> 3"))


@query("""SELECT doc_id::VARCHAR AS stem_path, CASE WHEN doc_id % 9 = 0 THEN 'input without output' ELSE 'output without input' END AS problem FROM documents WHERE (doc_id % 9 = 0) <> (doc_id % 13 = 0)""")
def archived_vs_rtf(s, d):
    ids = table(s, d, "documents").select(F.col("doc_id").cast("string").alias("stem_path"), "doc_id")
    return verify.archived_vs_rtf(ids.where("doc_id % 13 <> 0"), ids.where("doc_id % 9 <> 0"))


# --- orders and line items as a trace ------------------------------------------------------------------------------

TRACE_SQL = """WITH trace AS (SELECT l_suppkey % 8 AS worker_slot, strftime(l_shipdate, '%Y-%m') AS date_folder, strftime(l_shipdate, '%Y-%m') || '#' || printf('%04d', 9990 + l_orderkey % 20) AS batch_id,
  l_orderkey::VARCHAR AS sub_folder, 'doc_' || l_partkey || '.xhtml' AS file_name, epoch_us(l_shipdate) + l_orderkey * 1000 AS s, epoch_us(l_shipdate) + l_orderkey * 1000 + l_quantity::BIGINT * 10000 AS e,
  l_quantity * 10 AS duration_ms, l_linenumber AS attempts, CASE WHEN l_returnflag = 'R' THEN 'Failed:Permanent' WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'Fatal' WHEN l_returnflag = 'A' AND l_linenumber = 6 THEN 'Cancelled' ELSE 'Succeeded' END AS outcome, l_linestatus AS run_id,
  l_linenumber * 1000 AS bytes_in, l_quantity AS read_ms, l_linenumber::DOUBLE AS decode_ms, 1.0::DOUBLE AS validate_ms, l_quantity * 2 AS import_ms, l_quantity * 3 AS export_ms, 2.0::DOUBLE AS write_ms, 1.0::DOUBLE AS archive_ms FROM lineitem) """


def line_trace(s, d) -> DataFrame:
    """Line items as a trace: run by line status, folder by month of shipment, worker by supplier, outcome by return flag (fatal and cancelled ones
    among them), phases of whole milliseconds."""
    l = table(s, d, "lineitem")
    month = F.date_format("l_shipdate", "yyyy-MM")
    start = F.unix_micros(F.col("l_shipdate").cast("timestamp")) + F.col("l_orderkey") * 1000
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    outcome = F.when(flag == "R", "Failed:Permanent").when((flag == "A") & (line == 7), "Fatal").when((flag == "A") & (line == 6), "Cancelled").otherwise("Succeeded")
    rows = l.select(
        (F.col("l_suppkey") % 8).alias("worker_slot"),
        month.alias("date_folder"),
        F.format_string("%s#%04d", month, 9990 + F.col("l_orderkey") % 20).alias("batch_id"),
        F.col("l_orderkey").cast("string").alias("sub_folder"),
        F.concat(F.lit("doc_"), F.col("l_partkey").cast("string"), F.lit(".xhtml")).alias("file_name"),
        F.timestamp_micros(start).alias("start_utc"),
        (F.col("l_quantity") * 10).alias("duration_ms"),
        F.col("l_linenumber").alias("attempts"),
        outcome.alias("outcome"),
        F.col("l_linestatus").alias("run_id"),
        (F.col("l_linenumber") * 1000).cast("long").alias("bytes_in"),
        F.col("l_quantity").alias("read_ms"),
        F.col("l_linenumber").cast("double").alias("decode_ms"),
        F.lit(1.0).alias("validate_ms"),
        (F.col("l_quantity") * 2).alias("import_ms"),
        (F.col("l_quantity") * 3).alias("export_ms"),
        F.lit(2.0).alias("write_ms"),
        F.lit(1.0).alias("archive_ms"),
    )
    return rows.withColumn("end_utc", F.timestamp_micros(F.unix_micros("start_utc") + (F.col("duration_ms") * 1000).cast("long")))


@query(TRACE_SQL + "SELECT date_folder, count(*) AS total, count(*) FILTER (outcome = 'Succeeded') AS succeeded, count(*) FILTER (outcome LIKE 'Failed%') AS failed, (max(e) - min(s)) / 1000 AS elapsed_ms FROM trace GROUP BY 1")
def folder_breakdown(s, d):
    return metrics.folder_breakdown(line_trace(s, d))


@query(TRACE_SQL + """SELECT count(*) FILTER (outcome = 'Succeeded' OR outcome LIKE 'Failed%') AS processed, count(*) FILTER (outcome = 'Succeeded') AS succeeded, count(*) FILTER (outcome LIKE 'Failed%') AS failed,
  sum(attempts - 1)::BIGINT AS retries, sum(bytes_in) FILTER (outcome = 'Succeeded')::BIGINT AS bytes_in, greatest(0, 1000000 - count(*) FILTER (outcome = 'Succeeded' OR outcome LIKE 'Failed%'))::BIGINT AS remaining FROM trace""")
def run_totals(s, d):
    return metrics.run_totals(line_trace(s, d), 1_000_000)


@query(TRACE_SQL + """, r AS (SELECT (max(e) - min(s)) / 1000 AS run_ms FROM trace) SELECT worker_slot, count(*) AS processed, count(*) FILTER (outcome = 'Succeeded') AS succeeded,
  count(*) FILTER (outcome LIKE 'Failed%') AS failed, count(*) FILTER (outcome IN ('Fatal', 'Cancelled')) AS abandoned, sum(duration_ms) AS busy_ms, sum(duration_ms) / any_value(run_ms) * 100 AS busy_pct,
  sum(duration_ms) / count(*) AS avg_ms, count(*) / (sum(duration_ms) / 1000) AS files_per_s FROM trace, r GROUP BY 1""")
def worker_breakdown(s, d):
    return metrics.worker_breakdown(line_trace(s, d))


PHASES_SQL = TRACE_SQL + """, p AS (SELECT unnest(['read','decode','validate','import','export','write','archive']) AS phase, unnest(['Disk','CPU','CPU','CPU','CPU','Disk','Disk']) AS kind,
  unnest([read_ms, decode_ms, validate_ms, import_ms, export_ms, write_ms, archive_ms]) AS ms FROM trace WHERE outcome = 'Succeeded')"""


@query(PHASES_SQL + " SELECT phase, kind, sum(ms) / 1000 AS total_s, sum(ms) / (SELECT sum(ms) FROM p) * 100 AS pct, sum(ms) / count(*) AS avg_ms FROM p GROUP BY 1, 2")
def phase_breakdown(s, d):
    return metrics.phase_breakdown(line_trace(s, d))


@query(PHASES_SQL + """, t AS (SELECT count(*) FILTER (outcome = 'Succeeded') AS ok,
  sum(duration_ms) / count(*) * greatest(1, count(*) FILTER (outcome = 'Succeeded' OR outcome LIKE 'Failed%')) AS busy FROM trace), k AS (SELECT kind, sum(ms) AS ms FROM p GROUP BY 1
  UNION ALL SELECT 'Overhead', busy - (SELECT sum(ms) FROM p) FROM t WHERE busy - (SELECT sum(ms) FROM p) > 0) SELECT kind, round(ms / 1000, 6) AS total_s, round(ms / ok, 6) AS avg_ms FROM k, t""")
def cpu_disk_split(s, d):
    return metrics.cpu_disk_split(line_trace(s, d)).select("kind", F.round("total_s", 6).alias("total_s"), F.round("avg_ms", 6).alias("avg_ms"))


@query(TRACE_SQL + "SELECT sum(duration_ms) / ((max(e) - min(s)) / 1000) AS avg_workers, least(100.0::DOUBLE, sum(duration_ms) / ((max(e) - min(s)) / 1000) / 8 * 100) AS utilisation_pct FROM trace")
def average_concurrency(s, d):
    return metrics.average_concurrency(line_trace(s, d), 8)


@query(TRACE_SQL + "SELECT batch_id, count(*) AS documents, count(*) FILTER (outcome LIKE 'Failed%') AS errors FROM trace GROUP BY 1")
def error_rates_by_batch(s, d):
    return outcomes.error_rates_by_batch(line_trace(s, d))


@query(TRACE_SQL + """, b AS (SELECT run_id, batch_id, min(s) AS f, max(e) AS t, count(*) FILTER (outcome = 'Succeeded') AS ok, count(*) FILTER (outcome LIKE 'Failed%') AS bad FROM trace GROUP BY 1, 2)
  SELECT run_id, batch_id, CAST(sum(ok + bad) OVER w AS BIGINT) AS done, CAST(sum(ok) OVER w AS BIGINT) AS succeeded, CAST(sum(bad) OVER w AS BIGINT) AS failed,
  round(sum(ok + bad) OVER w / ((t - min(f) OVER (PARTITION BY run_id)) / 1000000.0::DOUBLE), 9) AS files_per_s FROM b WINDOW w AS (PARTITION BY run_id ORDER BY t, batch_id)""")
def batch_progress(s, d):
    return batches.batch_progress(line_trace(s, d), "run_id").drop("batch_end").withColumn("files_per_s", F.round("files_per_s", 9))


@query(TRACE_SQL + """, b AS (SELECT date_folder, batch_id, min(s) AS f, max(e) AS t FROM trace GROUP BY 1, 2)
  SELECT date_folder, batch_id, coalesce(f >= lag(t) OVER (PARTITION BY date_folder ORDER BY regexp_extract(batch_id, '([0-9]+)$', 1)::BIGINT), true) AS holds FROM b""")
def batch_barrier_check(s, d):
    return batches.batch_barrier_check(line_trace(s, d))


@query(TRACE_SQL + "SELECT worker_slot, date_folder, batch_id, sub_folder, file_name, s AS start_us, e AS end_us, duration_ms, attempts, outcome FROM trace")
def to_trace(s, d):
    out = outcomes.to_trace(line_trace(s, d).drop("end_utc"))
    return out.withColumns({"start_us": F.unix_micros("start_utc"), "end_us": F.unix_micros("end_utc")}).drop("start_utc", "end_utc")


@query(TRACE_SQL + "SELECT date_folder, '' AS sub_folder, file_name, count(*) AS times FROM trace GROUP BY 1, 2, 3 HAVING count(*) > 1 ORDER BY 1, 2, 3 LIMIT 10")
def duplicate_documents(s, d):
    """The report shows the first ten; that is its definition."""
    return verify.duplicate_documents(line_trace(s, d).withColumn("sub_folder", F.lit("")))


@query(TRACE_SQL + """, f AS (SELECT date_folder, sub_folder, file_name, batch_id, 'Permanent failure' AS reason, 'XmlException' AS error_type FROM trace WHERE outcome LIKE 'Failed%')
  SELECT date_folder, sub_folder, file_name, batch_id, outcome, reason, error_type FROM trace LEFT JOIN (SELECT DISTINCT * FROM f) USING (date_folder, sub_folder, file_name, batch_id)""")
def trace_with_errors(s, d):
    t = line_trace(s, d)
    f = t.where("outcome like 'Failed%'").withColumns({"reason": F.lit("Permanent failure"), "error_type": F.lit("XmlException")}).distinct()
    f = f.dropDuplicates(["date_folder", "sub_folder", "file_name", "batch_id"])
    return verify.trace_with_errors(t, f).select("date_folder", "sub_folder", "file_name", "batch_id", "outcome", "reason", "error_type")


@query("SELECT (SELECT count(*) FROM lineitem) AS traced, (SELECT count(*) FROM orders) AS found, (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM orders) AS complete")
def trace_coverage(s, d):
    return verify.trace_coverage(table(s, d, "lineitem"), table(s, d, "orders"))


@query("""SELECT count(*) / 100.0 AS files_per_s, count(*) / 100.0 * 60 AS files_per_min, count(*) / 100.0 * 3600 AS files_per_hour, (sum(l_linenumber * 2048) + count(*) * 1024) / 1048576.0 / 100.0 AS mb_per_s,
  sum(l_linenumber * 2048) / 1048576.0 / count(*) AS avg_file_mb, sum(l_quantity) / count(*) AS avg_service_ms, 1000 / (count(*) / 100.0) AS eta_s FROM lineitem""".replace("100.0", "100.0::DOUBLE").replace("1048576.0", "1048576.0::DOUBLE"))
def throughput(s, d):
    n = F.count("*")
    totals = table(s, d, "lineitem").agg(
        n.alias("processed"), n.alias("succeeded"), F.sum(F.col("l_linenumber") * 2048).alias("bytes_in"), (n * 1024).alias("bytes_out"), F.lit(100.0).alias("elapsed_s"),
        F.sum("l_quantity").alias("service_ms"), F.lit(1000).alias("remaining"),
    )
    return metrics.throughput(totals)


# --- events as intervals and attempts ------------------------------------------------------------------------------


@query("""WITH e AS (SELECT epoch_us(ts) AS s, epoch_us(ts) + (value * 1000000)::BIGINT AS f FROM events), x AS (SELECT s AS t, 1 AS d FROM e UNION ALL SELECT f, -1 FROM e)
  SELECT max(c)::BIGINT AS peak FROM (SELECT sum(d) OVER (ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS c FROM x)""")
def peak_concurrency(s, d):
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = table(s, d, "events").select(start.alias("start_us"), (start + F.round(F.col("value") * 1_000_000).cast("long")).alias("end_us"))
    return metrics.peak_concurrency(rows, bucket_us=3_600_000_000)


EVENT_ERROR_SQL = """WITH e AS (SELECT event_id, user_id, ts, CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN 'IOException' WHEN 2 THEN 'TimeoutException' WHEN 3 THEN 'UnauthorizedAccessException' WHEN 4 THEN 'FileNotFoundException'
  WHEN 5 THEN 'IOException' WHEN 6 THEN 'XmlException' WHEN 7 THEN 'IOException' ELSE CASE WHEN event_id % 27 = 8 THEN 'OperationCanceledException' ELSE 'OutOfMemoryException' END END AS error_type, event_id % 54 = 8 AS cancelled, CASE WHEN event_id % 9 = 5 THEN 112 ELSE 0 END AS h, CASE WHEN event_id % 90 = 7 THEN 'No LICENSE' ELSE event_type END AS m FROM events),
  c AS (SELECT *, CASE WHEN m ILIKE '%license%' THEN 'Fatal' WHEN error_type = 'UnauthorizedAccessException' THEN 'Fatal' WHEN error_type = 'IOException' AND h = 112 THEN 'Fatal'
  WHEN error_type IN ('IOException', 'TimeoutException', 'OutOfMemoryException', 'OperationCanceledException') THEN 'Transient' ELSE 'Permanent' END AS category FROM e)"""
REASON_SQL = """CASE error_type WHEN 'TimeoutException' THEN 'Conversion exceeded ConversionTimeoutSeconds' WHEN 'UnauthorizedAccessException' THEN 'Access denied to the file or the output folder'
  WHEN 'FileNotFoundException' THEN 'The file disappeared before it could be read' WHEN 'OutOfMemoryException' THEN 'Not enough memory to convert the document' WHEN 'OperationCanceledException' THEN 'Stopped while the document was being converted'
  WHEN 'IOException' THEN CASE WHEN category = 'Fatal' THEN 'The output volume is full or unreachable' ELSE 'The file is locked or the volume is unavailable' END ELSE 'Conversion failed (' || error_type || ')' END"""


def event_errors(s, d) -> DataFrame:
    """Events as an attempt log: by event_id % 9 a success or one of eight errors, one of them with a full disk; some messages name a licence, and some
    attempts are cancelled with their run."""
    names = ["IOException", "TimeoutException", "UnauthorizedAccessException", "FileNotFoundException", "IOException", "XmlException", "IOException", "OutOfMemoryException"]
    k = F.col("event_id") % 9
    kind = F.when(F.col("event_id") % 27 == 8, "OperationCanceledException").when(k > 0, F.element_at(F.array(*[F.lit(n) for n in names]), F.greatest(k, F.lit(1)).cast("int")))
    message = F.when(F.col("event_id") % 90 == 7, "No LICENSE").otherwise(F.col("event_type"))
    rows = table(s, d, "events").select("event_id", "user_id", "ts", kind.alias("error_type"), message.alias("m"), F.when(k == 5, 112).otherwise(0).alias("h"), (F.col("event_id") % 54 == 8).alias("cancelled"))
    return rows.withColumn("category", outcomes.classify_error(F.col("error_type"), F.array("m"), F.col("h"))).drop("m", "h")


@query(EVENT_ERROR_SQL + f" SELECT event_id, category, {REASON_SQL} AS reason FROM c WHERE error_type IS NOT NULL")
def classify_errors(s, d):
    rows = event_errors(s, d).where("error_type is not null")
    return rows.select("event_id", "category", outcomes.describe_reason(F.col("error_type"), F.col("category")).alias("reason"))


@query(EVENT_ERROR_SQL + f" SELECT {REASON_SQL} AS reason, count(*) AS failures FROM c WHERE error_type IS NOT NULL GROUP BY 1")
def failures_by_reason(s, d):
    rows = event_errors(s, d).where("error_type is not null")
    return verify.failures_by_reason(rows.select(outcomes.describe_reason(F.col("error_type"), F.col("category")).alias("reason")))


@query(EVENT_ERROR_SQL + """, r AS (SELECT *, row_number() OVER w AS n, coalesce(max(CASE WHEN error_type IS NULL OR category IN ('Permanent', 'Fatal') OR (cancelled AND error_type = 'OperationCanceledException') THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
  FROM c WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), u AS (SELECT user_id, max(n) AS attempts, arg_max({'c': category, 't': error_type, 's': cancelled AND error_type = 'OperationCanceledException'}, n) AS l FROM r WHERE o = 0 AND n <= 3 GROUP BY 1)
  SELECT user_id, attempts, attempts - 1 AS retries, (500 * (attempts - 1) * attempts // 2)::BIGINT AS backoff_ms, CASE WHEN l.t IS NOT NULL THEN l.c END AS category, l.t AS error_type,
  CASE WHEN l.t IS NULL THEN 'Succeeded' WHEN l.s THEN 'Cancelled' WHEN l.c = 'Fatal' THEN 'Fatal' ELSE 'Failed:' || l.c END AS outcome FROM u""")
def resolve_attempts(s, d):
    rows = event_errors(s, d).withColumn("attempt", F.struct("ts", "event_id"))
    return outcomes.resolve_attempts(rows, "user_id")


@query(EVENT_ERROR_SQL + """ SELECT event_id, coalesce(CASE WHEN event_id % 2 = 0 THEN 'given' END, category || ' failure (' || error_type || ')') AS reason_text, CASE WHEN event_id % 3 = 0 THEN 'e' || event_id ELSE 'f' || event_id END AS actual_file_name,
  CASE WHEN event_id % 3 = 0 AND event_id % 5 <> 0 THEN 'Yes' ELSE 'No' END AS moved_to_error, CASE WHEN event_id % 4 = 0 THEN 'x.error.log' ELSE '(none)' END AS error_log_name FROM c WHERE error_type IS NOT NULL""")
def error_rows(s, d):
    rows = event_errors(s, d).where("error_type is not null")
    i = F.col("event_id")
    rows = rows.withColumns(
        {
            "reason": F.when(i % 2 == 0, "given"), "file_name": F.concat(F.lit("f"), i.cast("string")), "error_file_name": F.when(i % 3 == 0, F.concat(F.lit("e"), i.cast("string"))),
            "error_file_path": F.when(i % 3 == 0, "/error/x"), "move_error": F.when(i % 5 == 0, "locked"), "error_log_file": F.when(i % 4 == 0, "x.error.log"),
        }
    )
    return outcomes.error_row_projection(rows).select("event_id", "reason_text", "actual_file_name", "moved_to_error", "error_log_name")


@query(EVENT_ERROR_SQL + """, f AS (SELECT 'Conversion' AS source, event_id AS id FROM c WHERE error_type IS NOT NULL UNION ALL SELECT 'Discovery', doc_id FROM documents WHERE doc_id % 10 IN (1, 2)) SELECT source, count(*) AS failures, min(id) AS first FROM f GROUP BY 1""")
def union_failures(s, d):
    a = event_errors(s, d).where("error_type is not null").select(F.lit("Conversion").alias("source"), F.col("event_id").alias("id"), "category")
    b = document_files(s, d).where(~matches_pattern(F.col("file_name"), "*.xhtml")).select(F.lit("Discovery").alias("source"), F.col("doc_id").alias("id"))
    return outcomes.union_failures(a, b).groupBy("source").agg(F.count("*").alias("failures"), F.min("id").alias("first"))


# --- orders as folders, completions and runs -----------------------------------------------------------------------


@query("""WITH f AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS f FROM orders), d AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS f, min('inst' || (o_custkey % 3)) AS i FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
  c AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS f FROM orders WHERE o_orderstatus = 'P')
  SELECT f.f AS date_folder, d.i AS owner, CASE WHEN d.i IS NOT NULL THEN 'completed' WHEN c.f IS NOT NULL THEN 'claimed' ELSE 'open' END AS state FROM f LEFT JOIN d USING (f) LEFT JOIN c ON f.f = c.f""")
def folder_ownership(s, d):
    """Days of orders as folders: an order of status F completes its day, one of status P claims it."""
    o = table(s, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_folder"), F.concat(F.lit("inst"), (F.col("o_custkey") % 3).cast("string")).alias("instance"), "o_orderstatus")
    return verify.folder_ownership(o, o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'P'"))


@query("""SELECT doc_id, CASE WHEN length(source || '/' || text) <= 24 THEN source || '/' || text ELSE left(source || '/' || text, 23) || '~' END AS shown FROM documents""")
def shortened_names(s, d):
    """Names that are too long for a column, cut with a tilde (§2.10)."""
    return table(s, d, "documents").select("doc_id", shortened(F.concat("source", F.lit("/"), "text"), 24).alias("shown"))


@query("""WITH d AS (SELECT strftime(o_orderdate, '%Y-%m') AS f, min('inst' || (o_custkey % 3)) AS i FROM orders GROUP BY 1)
  SELECT i AS instance, count(*) AS folders, string_agg(f, ', ' ORDER BY f) AS names FROM d GROUP BY 1""")
def work_distribution(s, d):
    o = table(s, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("date_folder"), F.concat(F.lit("inst"), (F.col("o_custkey") % 3).cast("string")).alias("instance"))
    return verify.work_distribution(o.groupBy("date_folder").agg(F.min("instance").alias("instance")))


@query("""WITH d AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS f, 'inst' || (o_custkey % 3) AS i FROM orders)
  SELECT i AS instance, row_number() OVER (PARTITION BY i ORDER BY f) AS nth, f AS date_folder, i = min(i) OVER (PARTITION BY f) AS first_taken FROM d""")
def folders_of_instances(s, d):
    """Customers as instances, order dates as folders that several of them report (G10, as rows)."""
    o = table(s, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_folder"), F.concat(F.lit("inst"), (F.col("o_custkey") % 3).cast("string")).alias("instance"))
    return verify.folders_of_instances(o)


@query("""WITH d AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS f, min('inst' || (o_custkey % 3)) AS i FROM orders GROUP BY 1), t AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS f, 'inst' || (o_custkey % 3) AS i FROM orders)
  SELECT d.f AS date_folder, d.i AS owner, t.i AS instance FROM d JOIN t USING (f) WHERE d.i <> t.i""")
def ownership_agreement(s, d):
    o = table(s, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_folder"), F.concat(F.lit("inst"), (F.col("o_custkey") % 3).cast("string")).alias("instance"))
    return verify.ownership_agreement(o.groupBy("date_folder").agg(F.min("instance").alias("instance")), o)


RUN_SQL = """WITH t AS (SELECT o_orderpriority AS run, count(*) AS found, count(*) FILTER (o_orderstatus <> 'P') AS succeeded, count(*) FILTER (o_orderstatus = 'P') AS failed, min(o_orderkey % 7)::BIGINT AS remaining FROM orders GROUP BY 1)"""


def run_rows(s, d) -> DataFrame:
    """Order priorities as runs: an order of status P failed."""
    ok = F.count_if(F.col("o_orderstatus") != "P")
    t = table(s, d, "orders").groupBy(F.col("o_orderpriority").alias("run")).agg(F.count("*").alias("found"), ok.alias("succeeded"), (F.count("*") - ok).alias("failed"), F.min(F.col("o_orderkey") % 7).alias("remaining"))
    return t.withColumns(
        {
            "status": F.lit("COMPLETED"), "exit_code": F.lit(0), "corpus": F.col("found"), "processed": F.col("found"), "rtf": F.col("succeeded"), "archived": F.col("succeeded"), "in_error": F.col("failed"),
            "error_rows": F.col("failed") + 1, "threads": F.lit(4), "peak": F.lit(4),
        }
    )


@query(RUN_SQL + """, c AS (SELECT run, unnest(['status', 'exit code', 'files found', 'found = succeeded + failed', 'processed = found', 'rtf written', 'archived', 'in error', 'left in input', 'error report rows', 'peak workers']) AS "check",
  unnest(['COMPLETED', CASE WHEN failed > 0 THEN '1' ELSE '0' END, found::VARCHAR, (succeeded + failed)::VARCHAR, found::VARCHAR, succeeded::VARCHAR, succeeded::VARCHAR, failed::VARCHAR, '0', failed::VARCHAR, '4']) AS expected,
  unnest(['COMPLETED', '0', found::VARCHAR, found::VARCHAR, found::VARCHAR, succeeded::VARCHAR, succeeded::VARCHAR, failed::VARCHAR, remaining::VARCHAR, (failed + 1)::VARCHAR, '4']) AS actual FROM t)
  SELECT "check", expected, actual, expected = actual AS pass FROM c""")
def reconcile(s, d):
    return verify.reconcile(run_rows(s, d))


@query("""SELECT o_orderpriority AS report, coalesce(max(CASE WHEN o_orderstatus = 'F' THEN n END)::VARCHAR, '') AS "F", coalesce(max(CASE WHEN o_orderstatus = 'O' THEN n END)::VARCHAR, '') AS "O", coalesce(max(CASE WHEN o_orderstatus = 'P' THEN n END)::VARCHAR, '') AS "P"
  FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""")
def thread_sweep_matrix(s, d):
    kv = table(s, d, "orders").groupBy(F.col("o_orderpriority").alias("report"), F.col("o_orderstatus").alias("name")).agg(F.count("*").cast("string").alias("value"))
    return verify.thread_sweep_matrix(kv, ["F", "O", "P"])


@query("""WITH r AS (SELECT o_orderpriority AS run, left(o_orderpriority, 1)::INT AS threads, sum(o_orderkey % 100)::DOUBLE / count(*) AS service_ms FROM orders GROUP BY 1, 2)
  SELECT run, threads, service_ms, service_ms / first_value(service_ms) OVER w AS vs_first, service_ms / lag(service_ms) OVER w AS vs_before FROM r WINDOW w AS (ORDER BY threads, run)""")
def scaling_test(s, d):
    r = table(s, d, "orders").groupBy(F.col("o_orderpriority").alias("run"), F.substring("o_orderpriority", 1, 1).cast("int").alias("threads")).agg((F.sum(F.col("o_orderkey") % 100).cast("double") / F.count("*")).alias("service_ms"))
    return verify.scaling_test(r)


@query(RUN_SQL + " SELECT run AS report, unnest(['found', 'succeeded', 'failed']) AS name, unnest([found, succeeded, failed])::VARCHAR AS value FROM t")
def report_kv(s, d):
    rows = run_rows(s, d).select("run", "found", "succeeded", "failed")
    return reports.report_kv(rows, "run")


__all__ = ["ORACLES", "QUERIES"]
