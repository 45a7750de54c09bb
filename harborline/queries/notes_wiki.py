"""Wiki and notes, derived from documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.functions.text import rich_text
from harborline.operators.filters import note_wanted
from harborline.queries import derive as D
from harborline.queries.crawl_web import MARKDOWN_SQL, wiki_markup
from harborline.queries.registry import Tables, query
from harborline.session import materialize
from harborline.sources import notes, wiki
from harborline.sources.common import iso, landed

# ----------------------------------------------------------------------- wiki


def wiki_content(t: Tables):
    m, k = wiki_markup(t), F.col("doc_id")
    payload = F.to_json(F.struct(
        F.concat(F.lit("p"), k).alias("id"), F.concat(F.lit("Title "), k).alias("title"),
        F.when(k % 4 == 0, "blogpost").otherwise("page").alias("type"),
        F.struct((k % 9 + 1).cast("int").alias("number"), iso(D.at(k * 60), "Z").alias("when")).alias("version"),
        F.struct(F.upper("source").alias("key")).alias("space"),
        F.array(F.struct(F.lit("Home").alias("title")), F.struct(F.col("lang").alias("title"))).alias("ancestors"),
        F.struct(F.concat(F.lit("/pages/"), k).alias("webui")).alias("_links"),
        F.struct(F.struct(F.when(k % 10 == 0, "").otherwise(F.col("html")).alias("value"))
                 .alias("storage")).alias("body")))
    return landed(m.select(k, payload.alias("payload")), wiki.CONTENT)


WIKI_SQL = MARKDOWN_SQL + """,
w AS (SELECT *, 'https://wiki.test/pages/' || doc_id AS uri,
  CASE WHEN doc_id % 4 = 0 THEN 'blogpost' ELSE 'page' END AS kind, upper(source) AS space,
  strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id * 60), '%Y-%m-%dT%H:%M:%S') || 'Z' AS modified,
  CASE WHEN doc_id % 10 = 0 THEN '' ELSE markdown END AS md_body,
  CASE WHEN doc_id % 10 = 0 THEN '' ELSE array_to_string(list_filter(['Head ' || doc_id, trim(body, ' '),
    'bold', 'and', 'it', 'one', 'x' || doc_id, 'link', 'end'], lambda x: x <> ''), chr(10)) END AS txt_body FROM md)"""


@query("src_wiki_content", f"""WITH {WIKI_SQL}
SELECT 'text' AS form, doc_id, uri, 'text/plain' AS content_type, (doc_id % 9 + 1)::VARCHAR AS version,
  modified AS cursor_value, kind || '|space:' || space AS tags, 'Home/' || lang AS ancestors,
  'Title ' || doc_id || chr(10) || chr(10) || txt_body AS content FROM w
UNION ALL SELECT 'markdown', doc_id, uri, 'text/markdown', (doc_id % 9 + 1)::VARCHAR, modified,
  kind || '|space:' || space, 'Home/' || lang, '# Title ' || doc_id || chr(10) || chr(10) || md_body FROM w
UNION ALL SELECT 'storage', doc_id, uri, 'text/html', (doc_id % 9 + 1)::VARCHAR, modified,
  kind || '|space:' || space, 'Home/' || lang, NULL FROM w WHERE doc_id % 10 <> 0""")
def src_wiki_content(t: Tables):
    rows = materialize(wiki_content(t).drop("payload"), "wiki")

    def form(name):
        docs = wiki.content_documents(rows, "https://wiki.test/", "k1", name, seq=F.col("doc_id"))
        up = F.from_json("source_metadata", "ancestors array<string>")["ancestors"]
        body = F.col("content").cast("string") if name != "storage" else F.lit(None).cast("string")
        return docs.select(
            F.lit(name).alias("form"), F.col("seq").alias("doc_id"), "source_ref.uri", "content_type",
            "source_ref.version", F.col("cursor.value").alias("cursor_value"),
            F.array_join("tags", "|").alias("tags"), F.array_join(up, "/").alias("ancestors"),
            body.alias("content"))
    return form("text").unionByName(form("markdown")).unionByName(form("storage"))


@query("src_wiki_spaces", """SELECT sha256('k1:https://wiki.test/display/' || upper(source) || '_' || lang) AS id,
  'https://wiki.test/display/' || upper(source) || '_' || lang AS uri, 'space' AS tags,
  source AS f_name, count(*) || ' documents' AS f_description FROM documents GROUP BY source, lang""")
def src_wiki_spaces(t: Tables):
    spaces = t.documents.groupBy("source", "lang").agg(F.count("*").alias("n")).select(
        F.concat_ws("_", F.upper("source"), "lang").alias("key"), F.col("source").alias("name"),
        F.concat(F.col("n").cast("string"), F.lit(" documents")).alias("description"))
    f = lambda n: F.get_json_object(F.col("content").cast("string"), f"$.{n}")
    return wiki.space_documents(spaces, "https://wiki.test", "k1").select(
        "id", "source_ref.uri", F.array_join("tags", "|").alias("tags"), f("name").alias("f_name"),
        f("description").alias("f_description"))


def wiki_comments(t: Tables):
    """Every fourth document a page, the others comments: half of a third on one
    page, replies to them, and chains of up to a hundred replies, some of which
    run into a circle."""
    k = F.col("doc_id")
    page, talk = (lambda n: F.concat(F.lit("p"), n)), (lambda n: F.concat(F.lit("c"), n))
    parent = (F.when(k % 8 == 1, page(F.lit(0))).when(k % 4 == 1, page(k - 1)).when(k % 4 == 2, talk(k - 1))
              .when(k % 400 == 3, page(k - 3)).when(k % 400 == 203, talk(k + 8)).otherwise(talk(k - 4)))
    pages = t.documents.where(k % 4 == 0).select(page(k).alias("id"))
    rows = t.documents.where(k % 4 != 0).select(
        k, talk(k).alias("comment_id"), parent.alias("parent_id"), F.concat(F.lit("u"), k % 7).alias("author"),
        iso(D.at(k * 60), "Z").alias("created"), F.concat(F.lit("<p>"), F.regexp_replace("text", "[<>&\\s]+", " "), F.lit("</p>")).alias("html"))
    return pages, rows


COMMENT_SQL = r"""wc AS (SELECT doc_id, 'c' || doc_id AS comment_id, CASE WHEN doc_id % 8 = 1 THEN 'p0'
    WHEN doc_id % 4 = 1 THEN 'p' || (doc_id - 1) WHEN doc_id % 4 = 2 THEN 'c' || (doc_id - 1)
    WHEN doc_id % 400 = 3 THEN 'p' || (doc_id - 3) WHEN doc_id % 400 = 203 THEN 'c' || (doc_id + 8)
    ELSE 'c' || (doc_id - 4) END AS parent_id,
  trim(regexp_replace(text, '[<>&\s]+', ' ', 'g'), ' ') AS body FROM documents WHERE doc_id % 4 <> 0),
wt(comment_id, page_id, depth, ancestors) AS (
  SELECT comment_id, parent_id, 0::BIGINT, '' FROM wc
  WHERE parent_id IN (SELECT 'p' || doc_id FROM documents WHERE doc_id % 4 = 0)
  UNION ALL SELECT c.comment_id, w.page_id, w.depth + 1, CASE WHEN w.ancestors = '' THEN w.comment_id
    ELSE w.ancestors || '/' || w.comment_id END FROM wt w JOIN wc c ON c.parent_id = w.comment_id)"""


@query("jn_wiki_comments", f"""WITH RECURSIVE {COMMENT_SQL} SELECT * FROM wt""")
def jn_wiki_comments(t: Tables):
    return wiki.comment_paths(*wiki_comments(t)).select(
        "comment_id", "page_id", "depth", F.array_join("ancestors", "/").alias("ancestors"))


@query("src_wiki_comments", f"""WITH RECURSIVE {COMMENT_SQL} SELECT doc_id,
  'https://wiki.test/pages/' || page_id || '#comment-' || comment_id AS uri, 'comment|page:' || page_id AS tags,
  depth::VARCHAR AS depth, parent_id, body AS content FROM wt JOIN wc USING (comment_id) WHERE body <> ''""")
def src_wiki_comments(t: Tables):
    docs = wiki.comment_documents(wiki.comment_paths(*wiki_comments(t)), "https://wiki.test", "k1", seq=F.col("doc_id"))
    m = lambda f: F.get_json_object("source_metadata", f"$.{f}").alias(f)
    return docs.select(F.col("seq").alias("doc_id"), "source_ref.uri", F.array_join("tags", "|").alias("tags"),
                       m("depth"), m("parent_id"), F.col("content").cast("string").alias("content"))


# ---------------------------------------------------------------------- notes

BLOCK_TYPES = ("heading_1", "heading_2", "heading_3", "paragraph", "bulleted_list_item",
               "numbered_list_item", "to_do", "toggle", "code", "quote", "divider", "callout")


def note_pages(t: Tables):
    """One page per document."""
    k = F.col("doc_id")
    title = F.array(F.struct(F.lit("Note ").alias("plain_text")),
                    F.struct(k.cast("string").alias("plain_text")))
    prop = lambda kind: F.struct(F.lit(kind).alias("type"), title.alias("title"))
    props = (F.when(k % 5 == 0, F.create_map(F.lit("Status"), prop("select")))
             .when(k % 5 == 1, F.create_map(F.lit("Name"), prop("title")))
             .when(k % 5 == 2, F.create_map(F.lit("Title"), prop("title"), F.lit("Name"), prop("rich_text")))
             .otherwise(F.create_map(F.lit("title"), prop("title"))))
    icon = (F.when(k % 3 == 0, F.struct(F.lit("emoji").alias("type"), F.lit("📄").alias("emoji"),
                                        F.lit(None).cast("struct<url:string>").alias("external")))
            .when(k % 3 == 1, F.struct(F.lit("external").alias("type"), F.lit(None).cast("string").alias("emoji"),
                                       F.struct(F.lit("https://i.test/x.png").alias("url")).alias("external"))))
    parent = (F.when(k % 4 == 0, F.struct(F.lit("workspace").alias("type"), F.lit(None).cast("string").alias("page_id")))
              .otherwise(F.struct(F.lit("page_id").alias("type"),
                                  F.concat(F.lit("n"), F.floor(k / 2)).alias("page_id"))))
    payload = F.to_json(F.struct(
        F.concat(F.lit("n"), k).alias("id"), F.concat(F.lit("https://notes.test/"), k).alias("url"),
        iso(D.at(k), "Z").alias("created_time"), iso(D.at(k * 60), "Z").alias("last_edited_time"),
        (k % 8 == 0).alias("archived"), parent.alias("parent"), icon.alias("icon"), props.alias("properties")))
    return landed(t.documents.select(k, payload.alias("payload")), notes.PAGE)


def note_blocks(t: Tables):
    """A chain of blocks seven deep on every page, two siblings a level; each
    has a fourteenth of the document's words."""
    k = F.col("doc_id")
    words = F.split(F.regexp_replace("text", r"[^\p{L} ]", ""), " +")
    part = F.ceil(F.size("w") / 14).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.lit(13)), lambda i: F.array_join(F.slice("w", i * part + 1, part), " "))
    rows = t.documents.select(k, words.alias("w")).select(k, F.posexplode(parts).alias("i", "text"))
    level, side = F.floor(F.col("i") / 2), F.col("i") % 2
    own = F.concat(F.lit("n"), k, F.lit("b"), F.col("i"))
    above = F.when(level == 0, F.concat(F.lit("n"), k)).otherwise(
        F.concat(F.lit("n"), k, F.lit("b"), (level - 1) * 2))
    kind = F.element_at(F.array(*map(F.lit, BLOCK_TYPES)), ((k + F.col("i")) % len(BLOCK_TYPES) + 1).cast("int"))
    # Landed as a table: the tree's thin columns and its texts are read apart.
    return materialize(rows.select(own.alias("block_id"), above.alias("parent_id"), side.cast("int").alias("ordinal"),
                       kind.alias("type"), "text",
                       ((side == 0) & (level < 6)).alias("has_children")), "landed-blocks")


# The chain nests under the first sibling of each
# level, so reading order is: firsts down the chain, then seconds back up.
BLOCK_SQL = f"""nb AS (SELECT doc_id, i, i // 2 AS depth, i % 2 AS side,
  'n' || doc_id || 'b' || i AS block_id,
  ({list(BLOCK_TYPES)})[((doc_id + i) % {len(BLOCK_TYPES)})::INT + 1] AS type,
  array_to_string(w[i * part + 1:(i + 1) * part], ' ') AS text
  FROM (SELECT doc_id, w, ceil(len(w) / 14)::INT AS part FROM (SELECT doc_id,
    string_split_regex(regexp_replace(text, '[^\\p{{L}} ]', '', 'g'), ' +') AS w FROM documents)), range(14) r(i)),
placed AS (SELECT *, CASE WHEN side = 0 THEN depth ELSE 20 - depth END AS pos FROM nb),
lines AS (SELECT doc_id, pos, CASE type WHEN 'heading_1' THEN '# ' || text WHEN 'heading_2' THEN '## ' || text
  WHEN 'heading_3' THEN '### ' || text
  WHEN 'bulleted_list_item' THEN repeat('  ', depth) || '- ' || text
  WHEN 'numbered_list_item' THEN repeat('  ', depth) || '1. ' || text
  WHEN 'to_do' THEN repeat('  ', depth) || '- [ ] ' || text WHEN 'toggle' THEN repeat('  ', depth) || '> ' || text
  WHEN 'code' THEN '```' || chr(10) || text || chr(10) || '```' WHEN 'quote' THEN '> ' || text
  WHEN 'divider' THEN '---' ELSE text END AS line FROM placed),
md AS (SELECT doc_id, string_agg(line, chr(10) || chr(10) ORDER BY pos) FILTER (line <> '') AS markdown
  FROM lines GROUP BY doc_id)"""


@query("jn_note_blocks", f"""WITH {BLOCK_SQL} SELECT block_id, 'n' || doc_id AS page_id, depth::INT AS depth,
  repeat('0.', depth::INT) || side AS path FROM placed""")
def jn_note_blocks(t: Tables):
    pages = note_pages(t).select("p.id")
    return notes.block_paths(pages, note_blocks(t)).select(
        "block_id", "page_id", "depth", F.array_join(F.transform("path", lambda x: x.cast("string")), ".").alias("path"))


@query("fn_blocks_to_markdown", f"""WITH {BLOCK_SQL} SELECT 'n' || doc_id AS id, coalesce(markdown, '') AS markdown
FROM documents LEFT JOIN md USING (doc_id)""")
def fn_blocks_to_markdown(t: Tables):
    return notes.pages_markdown(note_pages(t).select("p.id"), note_blocks(t)).select("id", "markdown")


NOTE_SQL = BLOCK_SQL + """,
np AS (SELECT doc_id, 'https://notes.test/' || doc_id AS uri, doc_id % 8 = 0 AS archived,
  strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id * 60), '%Y-%m-%dT%H:%M:%S') || 'Z' AS edited,
  CASE WHEN doc_id % 5 = 0 THEN 'Untitled' ELSE 'Note ' || doc_id END AS title,
  CASE doc_id % 3 WHEN 0 THEN '📄' WHEN 1 THEN 'https://i.test/x.png' END AS icon,
  CASE WHEN doc_id % 4 = 0 THEN 'workspace' ELSE 'page_id' END AS parent_type,
  CASE WHEN doc_id % 4 <> 0 THEN 'n' || (doc_id // 2) END AS parent_id, markdown
  FROM documents LEFT JOIN md USING (doc_id))"""


@query("src_note_pages", f"""WITH {NOTE_SQL} SELECT doc_id, sha256('n1:' || uri) AS id, edited AS version, title, icon,
  'page|parent:' || parent_type AS tags, parent_id, markdown, CASE WHEN markdown IS NULL THEN title END AS fallback_title
FROM np WHERE NOT archived AND edited > '2024-01-01T01:00:00Z'""")
def src_note_pages(t: Tables):
    pages = note_pages(t)
    md = notes.pages_markdown(pages.select("p.id"), note_blocks(t))
    docs = notes.page_documents(pages, md, "n1", since="2024-01-01T01:00:00Z", seq=F.col("doc_id"))
    body = F.col("content").cast("string")
    m = lambda f: F.get_json_object("source_metadata", f"$.{f}").alias(f)
    is_json = F.startswith(body, F.lit('{"title"'))
    return docs.select(
        F.col("seq").alias("doc_id"), "id", "source_ref.version", m("title"), m("icon"),
        F.array_join("tags", "|").alias("tags"), m("parent_id"), F.when(~is_json, body).alias("markdown"),
        F.when(is_json, F.get_json_object(body, "$.title")).alias("fallback_title"))


@query("flt_note_archived", f"""WITH {NOTE_SQL} SELECT doc_id FROM np
WHERE NOT archived AND edited > '2024-01-01T01:00:00Z'""")
def flt_note_archived(t: Tables):
    keep = note_wanted(F.col("p.archived"), F.col("p.last_edited_time"), "2024-01-01T01:00:00Z")
    return note_pages(t).where(keep).select("doc_id")


def note_databases(t: Tables):
    dbs = t.nation.select(
        F.concat(F.lit("db"), "n_nationkey").alias("db_id"),
        F.concat(F.lit("https://notes.test/db/"), "n_nationkey").alias("url"),
        F.when(F.col("n_nationkey") % 5 == 0, "").otherwise(F.col("n_name")).alias("title"),
        F.create_map(F.lit("Name"), F.lit("title"), F.lit("Balance"), F.lit("number")).alias("schema"),
        F.lit("2024-03-01T00:00:00Z").alias("last_edited_time"))
    rows = t.customer.where("c_nationkey <> 3").select(
        F.concat(F.lit("db"), "c_nationkey").alias("db_id"), F.concat(F.lit("r"), "c_custkey").alias("id"),
        F.col("c_name").alias("title"), iso(D.at(F.col("c_custkey") * 17 % 1000), "Z").alias("last_edited"))
    return dbs, rows


NOTE_DB_SQL = """r AS (SELECT 'db' || c_nationkey AS db_id, 'r' || c_custkey AS id, c_name AS title,
  strftime(TIMESTAMP '2024-01-01' + to_seconds(c_custkey * 17 % 1000), '%Y-%m-%dT%H:%M:%S') || 'Z' AS edited
  FROM customer WHERE c_nationkey <> 3),
g AS (SELECT db_id, count(*) AS n, string_agg(id, ',' ORDER BY edited, id) AS ids FROM r GROUP BY db_id)"""


@query("agg_note_rows", f"""WITH {NOTE_DB_SQL} SELECT 'db' || n_nationkey AS db_id, coalesce(n, 0) AS row_count,
  coalesce(ids, '') AS ids FROM nation LEFT JOIN g ON db_id = 'db' || n_nationkey""")
def agg_note_rows(t: Tables):
    return notes.database_rows(*note_databases(t)).select(
        "db_id", F.col("rows_count").alias("row_count"),
        F.array_join(F.transform("rows", lambda r: r["id"]), ",").alias("ids"))


@query("src_note_databases", f"""WITH {NOTE_DB_SQL} SELECT sha256('n1:https://notes.test/db/' || n_nationkey) AS id,
  CASE WHEN n_nationkey % 5 = 0 THEN 'Untitled DB' ELSE n_name END AS title, coalesce(n, 0)::VARCHAR AS row_count,
  split_part(ids, ',', 1) AS first_row, 'number' AS schema_balance
FROM nation LEFT JOIN g ON db_id = 'db' || n_nationkey""")
def src_note_databases(t: Tables):
    dbs, rows = note_databases(t)
    f = lambda p: F.get_json_object(F.col("content").cast("string"), p)
    return notes.database_documents(dbs, rows, "n1").select(
        "id", f("$.title").alias("title"), f("$.row_count").alias("row_count"),
        f("$.rows[0].id").alias("first_row"), f("$.schema.Balance").alias("schema_balance"))


@query("fn_rich_text", "SELECT conv_id, turn, role || ': ' || text AS text FROM conversations")
def fn_rich_text(t: Tables):
    run = lambda c: F.struct(c.alias("plain_text"))
    runs = F.array(run(F.col("role")), run(F.lit(": ")), run(F.col("text")),
                   run(F.lit(None).cast("string")))
    return t.conversations.select("conv_id", "turn", rich_text(runs).alias("text"))
