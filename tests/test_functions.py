import fnmatch
import hashlib
import hmac
import mimetypes
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from harborline.catalog import values as V
from harborline.functions import classify, codec, names, text
from harborline.operators.crawl import page_links


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", fn(F.col("v")).alias("o")).collect())]


PATHS = ["a.py", "src/x.MD", "README", "v1.2/bin", "x.tar.gz", "a.unknownext", "Makefile.dockerfile",
         "deep/er/file.json", ".gitignore", "pic.JPG", "end."]


def test_extension_is_text_after_last_dot(spark):
    want = ["." + p.rsplit(".", 1)[-1].lower() if "." in p else "" for p in PATHS]
    assert column(spark, PATHS, names.extension) == want


def test_code_mime(spark):
    got = dict(zip(PATHS, column(spark, PATHS, names.mime_by_extension)))
    assert got["a.py"] == "text/x-python" and got["src/x.MD"] == "text/markdown"
    assert got["README"] == "application/octet-stream" and got["deep/er/file.json"] == "application/json"
    assert got[".gitignore"] == "text/plain" and got["pic.JPG"] == "image/jpeg"


def test_object_mime_agrees_with_the_standard_library(spark):
    keys = ["a/b.txt", "x.tar.gz", "y.tgz", "n.json.gz", "noext", "a.b/c", "P.PDF", "d.html.br", "z.csv"]
    guess = mimetypes.MimeTypes().guess_type
    assert column(spark, keys, names.mime_by_object_key) == [
        guess(k)[0] or "application/octet-stream" for k in keys]


@pytest.mark.parametrize("patterns", [["*.py"], ["src/*", "*.md"], ["[!a]*"], ["?.py", "x.tar.*"]])
def test_globs_agree_with_fnmatch(spark, patterns):
    paths = PATHS + ["src/a/b.py", "z.py", "a\nb.py"]
    want = [any(fnmatch.fnmatch(p, g) for g in patterns) for p in paths]
    assert column(spark, paths, lambda c: names.matches_any_glob(c, patterns)) == want


@pytest.mark.parametrize("secret", ["s", "k" * 64, "long" * 40])
def test_hmac(spark, secret):
    bodies = ["", "hello", "é" * 500]
    want = [hmac.new(secret.encode(), b.encode(), hashlib.sha256).hexdigest() for b in bodies]
    assert column(spark, bodies, lambda c: codec.hmac_sha256(secret, F.encode(c, "UTF-8"))) == want


def test_chat_signature_rules(spark):
    body, ts = "payload", "1700000000"
    good = "v0=" + hmac.new(b"sec", f"v0:{ts}:{body}".encode(), hashlib.sha256).hexdigest()
    cases = [(ts, good, 1700000300.0, True), (ts, good, 1700000301.0, False),
             (ts, "v0=bad", 1700000000.0, False), ("", good, 1700000000.0, False),
             (ts, None, 1700000000.0, False), ("soon", good, 1700000000.0, False)]
    df = spark.createDataFrame([(i, body, *c) for i, c in enumerate(cases)],
                               "i int, b string, t string, s string, r double, want boolean")
    out = df.select("i", "want", codec.chat_signature_valid(
        "sec", F.encode("b", "UTF-8"), F.col("t"), F.col("s"), F.col("r")).alias("got")).collect()
    assert all(r.got == r.want for r in out)
    assert df.select(codec.chat_signature_valid(None, F.col("b"), F.col("t"), F.col("s"), F.col("r"))
                     .alias("x")).first().x is True


def test_body_signature_needs_its_prefix(spark):
    sig = hmac.new(b"k", b"b", hashlib.sha256).hexdigest()
    ok = lambda c: codec.body_signature_valid("k", F.lit(b"b"), c)
    assert column(spark, ["sha256=" + sig, sig, "sha256=00", None], ok) == [True, False, False, False]


def test_feed_dates(spark):
    dates = ["Mon, 01 Jan 2024 10:00:00 +0100", "Mon, 01 Jan 2024 10:00:00 GMT", "2024-01-01T10:00:00Z",
             "2024-01-01T10:00:00+01:00", "yesterday", "", None]
    assert column(spark, dates, codec.feed_epoch) == [
        1704099600.0, 1704103200.0, 1704103200.0, 1704099600.0, 0.0, 0.0, 0.0]


def test_base64_without_padding_and_with_bad_bytes(spark):
    got = column(spark, ["aGVsbG8", "w6nDqA==", "_-8="], codec.base64_urlsafe_text)
    assert got[:2] == ["hello", "éè"] and "�" in got[2]


def test_json_path(spark):
    doc = '{"a": {"b": [1, 2], "c": "x"}, "d": null}'
    at = lambda p: column(spark, [doc], lambda c: codec.json_path(c, p))[0]
    assert (at("a.b"), at("a.c"), at("a.z"), at("a.c.x"), at("d"), at("")) == (
        "[1,2]", "x", None, None, None, doc)


def test_headers_last_value_wins(spark):
    df = spark.createDataFrame([([("From", "a"), ("FROM", "b"), ("X", "1")],)],
                               "h array<struct<name:string,value:string>>")
    assert df.select(codec.header_map(F.col("h")).alias("m")).first().m == {"from": "b", "x": "1"}


def test_lsn_order_is_numeric(spark):
    assert column(spark, ["0/9", "0/10", "1/0", "A/FF"], codec.lsn_order) == [
        9, 16, 4294967296, 10 * 4294967296 + 255]


def reference_text(html):
    """The rule, spelled directly: text nodes, stripped, blanks dropped."""
    out = []

    class P(HTMLParser):
        def handle_data(self, data):
            if data.strip():
                out.append(data.strip())

    P().feed(html)
    return "\n".join(out)


HTML = ["", "plain", "<p>a</p><p> b </p>", "a &amp; b &lt;c&gt;", "<script>if (a<b) {}</script>x", "<!-- n -->t",
        'x<a title="1 > 0">y</a>', "1 < 2 and 3", "<p>cut <b", "tail &am", "<br/>a<br>b", "é <i> ü</i>",
        "<ul><li>1</li><li>2</li></ul>", "a</ b>c", "<P CLASS='x'>Q</P>", "l1\nl2 <b>z</b>\r\n"]


def test_html_to_text_of_random_markup(spark):
    import random
    from html.parser import HTMLParser

    rng = random.Random(4)
    bits = ["text ", " é\n", "<p>", "</p>", "<br/>", "<a href='x>y' b=\"1>2\">", "<a b='>", "<", " < ", "a<b ", "&amp;", "&amp", "&copyright;", "&nosuch;",
            "&#65;", "&#x1F600;", "&#150", "&#0;", "&#xD800;", "&#1;", "&#99999999999;", "&notit;", "&NotEqualTilde;", "& ", "&", "<!-- c > -->", "<!doctype html>",
            "<![CDATA[x > y]]>", "<?pi x?>", "</>", "</ p>", "<script>if (a<b) '&amp;'</script>", "<STYLE type='a'>p > a {}</Style >", "<script/>", "<scripted>",
            "<p class=x'y>", "<p a = 'b'c=\"d\">", ";", "&lt;i&gt;", "\u00a0", "<title>T &amp; U</title>"]
    tails = ["", "", "&am", "&amp", "<p", "<!-- open", "<script>open <b>", "x & y", "<", "&#12"]
    pages = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 14))) + rng.choice(tails) for _ in range(600)]

    def nodes(html):
        parts = []
        parser = HTMLParser()
        parser.handle_data = parts.append
        parser.feed(html)
        return "\n".join(filter(None, map(str.strip, parts)))

    got = column(spark, pages, text.html_to_text)
    differ = [(p, nodes(p), g) for p, g in zip(pages, got) if nodes(p) != g]
    assert not differ, (len(differ), differ[:4])


def test_html_to_text(spark):
    assert column(spark, HTML, text.html_to_text) == [reference_text(h) for h in HTML]


def test_html_to_markdown(spark):
    got = column(spark, ["<h1>Hi &amp; <b>you</b></h1><p>a <strong>b</strong></p>", "<em>x</em><br/>y",
                         '<a class="k" href="/u">t</a>', "<li>1</li>\n<li>2</li>", "<p>a</p><p></p><p></p><p>b</p>"],
                 text.html_to_markdown)
    assert got == ["# Hi &\nyoua **b**", "*x*\ny", "[t](/u)", "- 1\n- 2", "a\n\nb"]


def test_error_classes(spark):
    df = spark.createDataFrame([(403, "API rate limit exceeded"), (403, "Abuse"), (403, "no"), (404, None),
                                (504, ""), (418, "")], "s int, b string")
    kind = classify.http_error_type(F.col("s"), F.col("b"))
    rows = df.select(kind.alias("k"), classify.retryable(kind).alias("r")).collect()
    assert [(r.k, r.r) for r in rows] == [
        ("ConnectorRateLimitError", True), ("ConnectorRateLimitError", True),
        ("ConnectorAuthenticationError", False), ("ResourceNotFoundError", False),
        ("ConnectorTemporaryError", True), ("ConnectorNetworkError", True)]


def test_links_of_a_page(spark):
    html = ('<a href="/docs">1</a><A HREF=\'guide.html\'>2</A><a href="../up?x=1">3</a><a href="mailto:a@b">4</a>'
            '<a href="javascript:x()">5</a><a href="https://other.com/p">6</a><a href="/docs">7</a>'
            '<a href="/pic.png">8</a><a href="/a#frag">9</a><a href="https://ex.com/p;v=1?q">10</a>')
    df = spark.createDataFrame([("https://ex.com/d/e/", html)], "url string, html string")
    rows = page_links(df, ["ex.com"]).orderBy("pos").collect()
    assert [r.link for r in rows] == ["https://ex.com/docs", "https://ex.com/d/e/guide.html",
                                      "https://ex.com/d/up?x=1", "https://ex.com/p?q"]
    many = "".join(f'<a href="/p{i}">x</a>' for i in range(80))
    df = spark.createDataFrame([("https://ex.com/", many)], "url string, html string")
    assert page_links(df, max_links=50).count() == 50 < page_links(df).count()


def test_url_rules(spark):
    urls = ["https://ex.com/a", "https://ex.com/login", "https://ex.com/x.png", "https://ex.com/?utm_a=1",
            "https://no.com/a"]
    assert column(spark, urls, lambda c: names.url_allowed(c, ["ex.com"])) == [True] + [False] * 4
