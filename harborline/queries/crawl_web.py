"""Web pages, API answers, feeds, markup, links, the crawl."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.functions.codec import feed_epoch, json_path
from harborline.functions.names import url_allowed, url_host
from harborline.functions.text import html_to_markdown, html_to_text
from harborline.operators import crawl as K
from harborline.queries import derive as D
from harborline.operators import robots
from harborline.queries.registry import Tables, query
from harborline.session import materialize
from harborline.sources import feeds, web

URL_HOST_SQL = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"


@query("src_web_docs", """SELECT sha256('w1:' || url) AS id, url AS uri, md5(html) AS version,
  octet_length(encode(html))::BIGINT AS size_bytes, sha256(html) AS checksum,
  'webpage|depth:' || (page_id % 4) AS tags, page_id % 4 AS depth FROM pages WHERE page_id % 7 <> 0""")
def src_web_docs(t: Tables):
    fetched = t.pages.select(
        "page_id", "url", F.lit("text/html").alias("content_type"),
        F.md5(F.encode("html", "UTF-8")).alias("etag"), (F.col("page_id") % 4).alias("depth"),
        F.when(F.col("page_id") % 7 == 0, "").otherwise(F.col("html")).alias("content"))
    docs = web.web_documents(fetched, "w1", seq=F.col("page_id"))
    return docs.select("id", "source_ref.uri", "source_ref.version", "size_bytes", "checksum",
                       F.array_join("tags", "|").alias("tags"),
                       F.get_json_object("source_metadata", "$.depth").cast("bigint").alias("depth"))


def api_answers(t: Tables):
    """Answer pages of orders: a list, a single object, or something else."""
    o = F.col("o_orderkey")
    item = F.struct(F.when(o % 3 != 0, o).alias("id"), F.when(o % 3 == 0, F.concat(F.lit("u"), o))
                    .alias("uuid"), F.col("o_orderstatus").alias("status"))
    pair = F.array(item, F.struct(F.when(o % 3 != 0, -o).alias("id"),
                                  F.when(o % 3 == 0, F.concat(F.lit("v"), o)).alias("uuid"),
                                  F.lit("dup").alias("status")))
    listed = F.to_json(F.struct(F.struct(pair.alias("items")).alias("data")))
    single = F.to_json(F.struct(F.struct(item.alias("items")).alias("data")))
    body = (F.when(o % 5 == 0, single).when(o % 5 == 1, F.lit('{"data": 7}'))
            .when(o % 5 == 2, F.lit('{"data": {"items": null}}')).otherwise(listed))
    return t.orders.select(F.concat(F.lit("/v1/"), F.lower("o_orderstatus")).alias("endpoint"),
                           o.alias("page_no"), body.alias("body"))


API_SQL = """a AS (SELECT o_orderkey AS page_no, '/v1/' || lower(o_orderstatus) AS endpoint,
  o_orderstatus, o_orderkey % 5 AS k FROM orders),
items AS (
  SELECT page_no, endpoint, 0 AS item_no, o_orderstatus AS status,
    CASE WHEN page_no % 3 = 0 THEN 'u' || page_no ELSE page_no::VARCHAR END AS item_id FROM a WHERE k IN (0, 3, 4)
  UNION ALL
  SELECT page_no, endpoint, 1, 'dup', CASE WHEN page_no % 3 = 0 THEN 'v' || page_no
    ELSE (-page_no)::VARCHAR END FROM a WHERE k IN (3, 4))"""


@query("src_api_items", f"""WITH {API_SQL} SELECT sha256('w1:https://api.test/v1/' || substr(endpoint, 5)
  || '/' || item_id) AS id, 'https://api.test' || endpoint || '/' || item_id AS uri,
  'api_item|endpoint:' || endpoint AS tags, item_id AS meta_item, status FROM items""")
def src_api_items(t: Tables):
    items = web.api_items(api_answers(t), "data.items")
    docs = web.api_documents(items, "https://api.test/", "w1", seq=F.col("page_no") * 2 + F.col("item_no"))
    return docs.select(
        "id", "source_ref.uri", F.array_join("tags", "|").alias("tags"),
        F.get_json_object("source_metadata", "$.item_id").alias("meta_item"),
        F.get_json_object(F.col("content").cast("string"), "$.status").alias("status"))


@query("fn_json_path", """SELECT event_id, (props::JSON->>'$.k') AS k, NULL::VARCHAR AS deep,
  CASE WHEN event_id % 2 = 0 THEN event_type END AS nested, props AS whole FROM events""")
def fn_json_path(t: Tables):
    doc = F.to_json(F.struct(F.struct(F.when(F.col("event_id") % 2 == 0, F.col("event_type"))
                                      .alias("kind")).alias("a")))
    return t.events.select("event_id", json_path(F.col("props"), "k").alias("k"),
                           json_path(F.col("props"), "k.x").alias("deep"),
                           json_path(doc, "a.kind").alias("nested"),
                           json_path(F.col("props"), "").alias("whole"))


# ---------------------------------------------------------------------- feeds


def landed_feeds(t: Tables):
    """One small feed per document, RSS and Atom in turn, in several date
    forms, some unreadable."""
    k = F.col("doc_id")
    when = D.at(k * 3600)
    stamp = (F.when(k % 4 == 0, F.concat(F.date_format(when, "E, dd MMM yyyy HH:mm:ss"), F.lit(" +0200")))
             .when(k % 4 == 1, F.concat(F.date_format(when, "E, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
             .when(k % 4 == 2, F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
             .otherwise(F.concat(F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00"))))
    stamp = F.when(k % 13 == 5, "soon").otherwise(stamp)
    body = F.concat(F.lit("<![CDATA["), F.regexp_replace("text", r"[^\p{L} ]", ""),
                    F.lit("]]>"))
    link = F.concat(F.lit("https://blog.test/"), k)
    rss_link = F.when(k % 6 == 0, "").otherwise(F.concat(F.lit("<link>"), link, F.lit("</link>")))
    rss = F.concat(F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>c</title><item><title>T'),
                   k, F.lit("</title>"), rss_link, F.lit("<description>"), body,
                   F.lit("</description><author>a@b.test</author><pubDate>"), stamp,
                   F.lit("</pubDate></item></channel></rss>"))
    atom_link = F.when(k % 7 == 1, "").otherwise(F.concat(F.lit('<link href="'), link, F.lit('"/>')))
    tag = F.when(k % 8 == 1, "summary").otherwise("content")
    atom = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><title>T'), k,
                    F.lit("</title>"), atom_link, F.lit("<id>urn:x:"), k, F.lit("</id><updated>"), stamp,
                    F.lit("</updated><"), tag, F.lit(">"), body, F.lit("</"), tag,
                    F.lit("></entry></feed>"))
    return t.documents.select(k, F.concat(F.lit("https://blog.test/feed/"), k).alias("feed_url"),
                              F.when(k % 3 == 1, atom).otherwise(rss).alias("xml"))


FEED_SQL = """f AS (SELECT doc_id, 'https://blog.test/feed/' || doc_id AS feed_url, 'T' || doc_id AS title,
  doc_id % 3 = 1 AS is_atom, 'https://blog.test/' || doc_id AS href,
  regexp_replace(text, '[^\\p{L} ]', '', 'g') AS content,
  CASE WHEN doc_id % 13 = 5 THEN 0 ELSE 1704067200 + doc_id * 3600 +
    CASE doc_id % 4 WHEN 0 THEN -7200 WHEN 3 THEN 18000 ELSE 0 END END::DOUBLE AS published_ts
  FROM documents),
i AS (SELECT *, CASE WHEN is_atom THEN CASE WHEN doc_id % 7 = 1 THEN '' ELSE href END
    ELSE CASE WHEN doc_id % 6 = 0 THEN '' ELSE href END END AS link,
  CASE WHEN is_atom THEN 'urn:x:' || doc_id ELSE '' END AS id,
  CASE WHEN is_atom THEN '' ELSE 'a@b.test' END AS author FROM f)"""


@query("src_feed_items", f"""WITH {FEED_SQL} SELECT doc_id, title, link, id, trim(content, ' ') AS content,
  author, published_ts FROM i""")
def src_feed_items(t: Tables):
    return feeds.feed_items(landed_feeds(t)).select(
        "doc_id", "title", "link", "id", F.trim("content").alias("content"), "author", "published_ts")


@query("src_feed_docs", f"""WITH {FEED_SQL} SELECT doc_id AS seq,
  CASE WHEN link <> '' THEN link WHEN id <> '' THEN id ELSE feed_url END AS uri, 'text/plain' AS content_type,
  published_ts AS cursor_value FROM i WHERE published_ts > 1704500000""")
def src_feed_docs(t: Tables):
    docs = feeds.feed_documents(feeds.feed_items(landed_feeds(t)), "r1", 1704500000.0,
                                seq=F.col("doc_id"))
    uri = F.col("source_ref.uri")
    # The digest of a nameless item is checked by its form, in tests by value.
    return docs.select("seq", F.regexp_replace(uri, "#[0-9a-f]{8}$", "").alias("uri"), "content_type",
                       F.col("cursor.value").cast("double").alias("cursor_value"))


@query("fn_feed_date", f"""WITH {FEED_SQL} SELECT doc_id, published_ts AS epoch FROM f""")
def fn_feed_date(t: Tables):
    stamp = F.regexp_extract("xml", "<(pubDate|updated)>([^<]*)<", 2)
    return landed_feeds(t).select("doc_id", feed_epoch(stamp).alias("epoch"))


# --------------------------------------------------------------------- markup

# The generator's pages hold one raw script with a tag-like string, comments
# and four kinds of references (of which one may lack its semicolon).  Some pages are cut off: an unfinished tag is
# no text, and neither is a last text that ends inside a reference.
TEXT_SQL = r"""
t1 AS (SELECT page_id, regexp_replace(regexp_replace(replace(html, 'var t="</p>";', 'var t="' || chr(1) || '/p>";'),
  '<!--.*?-->', '<x>', 'gs'), '<[A-Za-z/!][^>]*$', '<x>') AS h FROM pages),
t2 AS (SELECT page_id, string_split_regex(h, '<[A-Za-z/!][^>]*>') AS parts FROM t1),
t3 AS (SELECT page_id, list_transform(CASE WHEN regexp_matches(parts[-1], '&[^;\s]{0,33}$')
  THEN parts[:-2] ELSE parts END, lambda p: trim(regexp_replace(
    replace(replace(replace(replace(p, chr(1), '<'), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'),
    '&amp;?', '&', 'g'),
    ' ' || chr(10) || chr(9) || chr(13))) AS parts FROM t2)
SELECT page_id, array_to_string(list_filter(parts, lambda p: p <> ''), chr(10)) AS text FROM t3"""


@query("fn_html_to_text", f"WITH {TEXT_SQL}")
def fn_html_to_text(t: Tables):
    return t.pages.select("page_id", html_to_text(F.col("html")).alias("text"))


def wiki_markup(t: Tables):
    """Storage-format pages derived from documents."""
    k = F.col("doc_id")
    text = F.regexp_replace("text", r"[^\p{L} .]", "")
    html = F.concat(
        F.lit("<h2>"), F.concat(F.lit("Head "), k), F.lit("</h2><p>"), text,
        F.lit(' <strong>bold</strong> and <em>it</em></p><ul><li>one</li><li><code>x'), k,
        F.lit('</code></li></ul><br/><a href="/d/'), k, F.lit('">link</a>'
              '<ac:structured-macro ac:name="code"><ac:plain-text-body><![CDATA[a = '), k,
        F.lit("]]></ac:plain-text-body></ac:structured-macro><p>end</p>"))
    return t.documents.select(k, "text", "source", "lang", html.alias("html"))


MARKDOWN_SQL = r"""m AS (SELECT doc_id, source, lang, regexp_replace(text, '[^\p{L} .]', '', 'g') AS body
  FROM documents),
md AS (SELECT doc_id, source, lang, body, '## Head ' || doc_id || body || ' **bold** and *it*' || chr(10) ||
  '- one- `x' || doc_id || '`' || chr(10) || '[link](/d/' || doc_id || ')```' || chr(10) || 'a = ' || doc_id ||
  chr(10) || '```end' AS markdown FROM m)"""


@query("fn_html_to_markdown", f"WITH {MARKDOWN_SQL} SELECT doc_id, markdown FROM md")
def fn_html_to_markdown(t: Tables):
    return wiki_markup(t).select("doc_id", html_to_markdown(F.col("html")).alias("markdown"))


# ---------------------------------------------------------------------- links

LINKS_SQL = f"""l0 AS (SELECT page_id, url, {URL_HOST_SQL} AS host,
  regexp_extract(url, '^(https?://[^/?#]*)', 1) AS origin,
  regexp_extract_all(html, '(?i)href=["'']([^"''#]+)["'']', 1) AS hrefs FROM pages),
l1 AS (SELECT page_id, url, host, origin, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS n FROM l0),
l2 AS (SELECT page_id, url, host, origin || trim(href) AS link, min(n) AS n FROM l1
  WHERE NOT contains(split_part(href, '/', -1), '.') OR '.' || lower(split_part(href, '.', -1)) IN (
    '.html', '.htm', '.php', '.asp', '.aspx', '.pdf', '.md', '.txt', '.rst', '.doc', '.docx', '.json',
    '.xml', '.csv') GROUP BY ALL),
links AS (SELECT page_id, url, host, link, row_number() OVER (PARTITION BY page_id ORDER BY n) AS pos FROM l2)"""


@query("fn_extract_links", f"WITH {LINKS_SQL} SELECT page_id, pos, link FROM links")
def fn_extract_links(t: Tables):
    return K.page_links(t.pages).select("page_id", "pos", "link")


@query("set_distinct_links", f"WITH {LINKS_SQL} SELECT page_id, link, pos FROM links WHERE pos <= 3")
def set_distinct_links(t: Tables):
    twice = t.pages.withColumn("html", F.concat("html", "html"))
    return K.page_links(twice, max_links=3).select("page_id", "link", "pos")


@query("flt_url_allowed", f"""SELECT page_id, url FROM pages WHERE NOT regexp_matches(url,
  '\\.(png|jpg|jpeg|gif|ico|svg|webp|mp4|mp3|avi|zip|tar|gz|exe|bin)$')
  AND NOT regexp_matches(url, '/(login|logout|signin|signup|register|auth)')
  AND NOT regexp_matches(url, '[?&](utm_|fbclid|gclid)')
  AND {URL_HOST_SQL} LIKE '%.example.com'""")
def flt_url_allowed(t: Tables):
    ok = url_allowed(F.col("url"), F.endswith(url_host(F.col("url")), F.lit(".example.com")))
    return t.pages.where(ok).select("page_id", "url")


# Rules of the hosts' robots.txt by the length of the host's name modulo 3: for all
# agents, for ours, no file.
ROBOTS = (
    "User-agent: *\nDisallow: /en/\nAllow: /en/*5\nAllow: /en/9\nDisallow: /en/9\nDisallow: /*utm_\nDisallow: /*.html$\nAllow: /es\n",
    "User-agent: *\nDisallow: /\n\nUser-agent: other\nUser-agent: harbor\nDisallow: /*?\nAllow: /*?page=2\nDisallow: /de/1 # tens\n"
    "Disallow: /*/3$\n",
)
ROBOT_RULES = ((0, False, "/en/"), (0, True, "/en/*5"), (0, True, "/en/9"), (0, False, "/en/9"), (0, False, "/*utm_"),
               (0, False, "/*.html$"), (0, True, "/es"), (1, False, "/*?"), (1, True, "/*?page=2"), (1, False, "/de/1"), (1, False, "/*/3$"))
_RULE_ROWS = ", ".join(f"({n}, {str(allow).lower()}, '{x}', '^" + x.replace(".", "[.]").replace("?", "[?]").replace("*", ".*")
                       + "')" for n, allow, x in ROBOT_RULES)


@query("flt_robots", f"""WITH {LINKS_SQL},
u AS (SELECT DISTINCT link AS url FROM links),
ru AS (SELECT *, length(lower(regexp_extract(url, '://([^/?]*)', 1))) % 3 AS n,
  regexp_replace(regexp_replace(url, '#.*$', ''), '^[a-z]+://[^/?]*', '') AS path FROM u),
rr(n, allow, pattern, re) AS (VALUES {_RULE_ROWS}),
rm AS (SELECT url, allow, pattern, row_number() OVER (PARTITION BY url ORDER BY length(pattern) DESC, allow DESC) AS k
  FROM ru JOIN rr USING (n) WHERE regexp_matches(path, re))
SELECT url, coalesce(allow, true) AS allowed, CASE WHEN allow THEN 'Allow: ' ELSE 'Disallow: ' END || pattern AS rule
FROM u LEFT JOIN (FROM rm WHERE k = 1) USING (url)""")
def flt_robots(t: Tables):
    urls = materialize(K.page_links(t.pages.select("url", "html")).select(F.col("link").alias("url")).distinct(), "links")
    host = F.lower(url_host(F.col("url")))
    files = urls.select(host.alias("host")).distinct().where(F.length("host") % 3 < 2).select(
        "host", F.when(F.length("host") % 3 == 0, ROBOTS[0]).otherwise(ROBOTS[1]).alias("body"))
    return robots.allowed(urls, robots.rules(files, agent="harborline/1.0"))


@query("crawl_link_graph", f"""WITH {LINKS_SQL} SELECT DISTINCT url AS src, link AS dst FROM links
WHERE NOT regexp_matches(link, '\\.(png|jpg|jpeg|gif|ico|svg|webp|mp4|mp3|avi|zip|tar|gz|exe|bin)$')
  AND NOT regexp_matches(link, '/(login|logout|signin|signup|register|auth)')
  AND NOT regexp_matches(link, '[?&](utm_|fbclid|gclid)')""")
def crawl_link_graph(t: Tables):
    return K.link_graph(t.pages)


EDGES_SQL = f"""{LINKS_SQL}, edges AS (SELECT DISTINCT url AS src, link AS dst FROM links
WHERE NOT regexp_matches(link, '\\.(png|jpg|jpeg|gif|ico|svg|webp|mp4|mp3|avi|zip|tar|gz|exe|bin)$')
  AND NOT regexp_matches(link, '/(login|logout|signin|signup|register|auth)')
  AND NOT regexp_matches(link, '[?&](utm_|fbclid|gclid)')),
walk AS (
  SELECT DISTINCT url, 0 AS depth FROM pages WHERE page_id % 10 = 0
  UNION
  SELECT e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.url WHERE w.depth < 3),
reached AS (SELECT url, min(depth)::INT AS depth FROM walk GROUP BY url)"""


def seeds(t: Tables):
    return t.pages.where("page_id % 10 = 0").select("url")


@query("crawl_bfs_depth", f"WITH RECURSIVE {EDGES_SQL} SELECT url, depth FROM reached")
def crawl_bfs_depth(t: Tables):
    return K.bfs_depth(K.link_graph(t.pages), seeds(t))


@query("crawl_dfs_order", f"""WITH RECURSIVE {LINKS_SQL},
ep AS (SELECT url AS src, link AS dst, min(pos) AS pos FROM links
  WHERE NOT regexp_matches(link, '\\.(png|jpg|jpeg|gif|ico|svg|webp|mp4|mp3|avi|zip|tar|gz|exe|bin)$')
    AND NOT regexp_matches(link, '/(login|logout|signin|signup|register|auth)')
    AND NOT regexp_matches(link, '[?&](utm_|fbclid|gclid)') GROUP BY ALL),
hop AS (SELECT DISTINCT url, 0 AS depth FROM pages WHERE page_id % 10 = 0
  UNION SELECT e.dst, h.depth + 1 FROM hop h JOIN ep e ON e.src = h.url WHERE h.depth < 6),
got AS (SELECT url, min(depth) AS depth FROM hop GROUP BY url),
par AS (SELECT dst AS url, src AS parent, pos FROM (SELECT e.*, row_number() OVER (PARTITION BY dst
  ORDER BY g.depth, src, pos) AS n FROM ep e JOIN got g ON g.url = e.src) WHERE n = 1),
kid AS (SELECT url, depth, parent, pos FROM got LEFT JOIN par USING (url) WHERE depth > 0),
tree(url, depth, parent, pos, path) AS (SELECT url, depth::INT, NULL::VARCHAR, NULL::INT, url FROM got WHERE depth = 0
  UNION ALL SELECT k.url, k.depth::INT, k.parent, k.pos::INT, t.path || chr(1) || lpad(k.pos::VARCHAR, 9, '0') || chr(2) || k.url
  FROM tree t JOIN kid k ON k.parent = t.url)
SELECT url, depth, parent, pos, row_number() OVER (ORDER BY path) - 1 AS place FROM tree""")
def crawl_dfs_order(t: Tables):
    links = K.page_links(t.pages.select("url", "html"))
    edges = links.where(url_allowed(F.col("link"), F.lit(True))).groupBy(F.col("url").alias("src"), F.col("link").alias("dst")).agg(
        F.min("pos").alias("pos"))
    return K.dfs_order(materialize(edges, "edges"), seeds(t), max_depth=6)


@query("crawl_frontier", f"""WITH RECURSIVE {EDGES_SQL}, r2 AS (SELECT * FROM reached WHERE depth <= 1),
fetched AS (SELECT url FROM reached WHERE depth = 0)
SELECT e.dst AS url, (min(depth) + 1)::INT AS depth FROM r2 JOIN edges e ON e.src = r2.url
WHERE e.dst NOT IN (SELECT url FROM fetched) GROUP BY 1""")
def crawl_frontier(t: Tables):
    """Seeds are fetched, what they link to is known but not fetched yet."""
    edges = K.link_graph(t.pages)
    reached = K.bfs_depth(edges, seeds(t), max_depth=1)
    return K.frontier(edges, reached, reached.where("depth = 0"))


@query("crawl_changed", """SELECT page_id, url, CASE WHEN page_id % 5 = 0 THEN 'new' ELSE 'changed' END AS change
FROM pages WHERE page_id % 5 = 0 OR page_id % 5 = 1 OR page_id % 5 = 3""")
def crawl_changed(t: Tables):
    k = F.col("page_id") % 5
    sha = F.sha2(F.encode("html", "UTF-8"), 256)
    now = t.pages.select("page_id", "url", sha.alias("checksum"),
                         F.when(k >= 3, "").otherwise(F.concat(F.lit("e"), "page_id")).alias("etag"))
    # Pages 0 unknown; 1 new etag; 2 same etag; 3 no etag, other bytes; 4 no etag, same bytes.
    old = t.pages.where(k != 0).select(
        "url", F.when(k == 3, F.reverse(sha)).otherwise(sha).alias("checksum"),
        F.when(k == 1, "old").when(k >= 3, "").otherwise(F.concat(F.lit("e"), "page_id")).alias("etag"))
    return K.changed_pages(now, old).select("page_id", "url", "change")
