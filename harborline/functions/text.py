"""Markup to text, in built-in functions only."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, functions as F

# Characters Python's strip() removes that trim() would leave.
_EDGE_SPACE = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$"


def strip(text: Column) -> Column:
    """Text without white space at either end, as Python's strip() has it."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


# A page as tokens.  A quote opens a value only behind an equals sign.  All loops are
# possessive or lazy over single characters, so a token of any length needs no recursion.
_ATTRIBUTES = r"""[^>"'=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+'|(?!["']))[^>"'=]*+|["'][^>"'=]*+)*+"""
_RAW = rf"<(?i:script|style)(?=[\s/>]){_ATTRIBUTES}(?<!/)>"
_TOKEN = "|".join((
    r"<!--[\s\S]*?--\s*+>", r"<!--[\s\S]*+",
    r"<!\[(?i:cdata|temp|ignore|include|rcdata)\[[\s\S]*?\]\s*+\]\s*+>",
    rf"(?=<[sS](?i:cript|tyle)[\s/>])(?:<(?i:script)(?=[\s/>]){_ATTRIBUTES}(?<!/)>[\s\S]*?</\s*+(?i:script)\s*+>"
    rf"|<(?i:style)(?=[\s/>]){_ATTRIBUTES}(?<!/)>[\s\S]*?</\s*+(?i:style)\s*+>)",
    rf"{_RAW}[\s\S]*+", rf"<[a-zA-Z]{_ATTRIBUTES}>", r"<[/!?][^>]*+>",
    r"<[a-zA-Z/!?][\s\S]*+", r"[^<]++", "<"))
_INSIDE = rf"^{_RAW}([\s\S]*)</[^<]*$"

# References, the common ones first, as a map is searched from its beginning.
_COMMON = ("amp;", "lt;", "gt;", "quot;", "nbsp;", "copy;", "middot;", "apos;", "hellip;", "mdash;", "ndash;", "amp")
_NAMED = {n: html5[n] for n in (*_COMMON, *sorted(html5))}
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
_REFERENCE = r"&(?:#[0-9]++;?+|#[xX][0-9a-fA-F]++;?+|[^\t\n\f <&#;]{1,32}+;?+)"
#: Numbers of a Windows code page, taken for what was meant.
_MEANT = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def _numbered(name: Column) -> Column:
    """Character of a numeric reference (without ampersand)."""
    digits = F.regexp_replace(F.regexp_extract(name, "^#[xX]?([0-9a-fA-F]+)", 1), "^0+(?=.)", "")
    digits = F.substring(digits, 1, 9)  # nine are too many for any character
    code = F.when(F.lower(F.substring(name, 2, 1)) == "x", F.conv(digits, 16, 10)).otherwise(digits)
    n = code.cast("bigint")
    plane = n.bitwiseAND(0xFFFE) == 0xFFFE
    meant = F.try_element_at(F.create_map(*[F.lit(x) for kv in _MEANT.items() for x in kv]), n.cast("int"))
    return (F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd").when(n.between(0x80, 0x9F), meant)
            .when(n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | plane, "")
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))


def unescape(text: Column) -> Column:
    """Text with its character references decoded, as browsers do: also some names
    that lack their semicolon."""
    names = F.create_map(*[F.lit(x) for kv in _NAMED.items() for x in kv])

    def value(reference: Column) -> Column:
        name = F.substring(reference, 2, 40)
        bare = F.regexp_extract(name, f"^(?:{_BARE})", 0)
        return (F.when(F.startswith(name, F.lit("#")), _numbered(F.substring(reference, 2, 1 << 30)))
                .otherwise(F.coalesce(F.try_element_at(names, name), F.when(bare != "", F.concat(
                    F.try_element_at(names, bare), F.regexp_replace(name, f"^(?:{_BARE})", ""))), reference)))

    found = F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)), value)
    whole = F.array_join(F.zip_with(F.split(text, _REFERENCE, -1), F.concat(found, F.array(F.lit(""))), lambda gap, x: F.concat(gap, x)), "")
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def html_to_text(html: Column) -> Column:
    """Text nodes, stripped, blanks dropped, one per line.

    Scripts and styles are text as they stand.  What is cut off at the end -- a tag, a
    comment, a script, a text that ends within a reference -- isn't there.
    """
    def text_of(token: Column) -> Column:
        raw = F.regexp_extract(token, _INSIDE, 1)
        return (F.when(~F.startswith(token, F.lit("<")) | (token == "<"), strip(unescape(token)))
                .when(token.rlike(rf"^{_RAW}"), strip(raw)).otherwise(F.lit("")))

    def closed(tokens: Column) -> Column:
        end = F.try_element_at(tokens, F.lit(-1))
        open_ = (end == "<") | (~F.startswith(end, F.lit("<")) & end.rlike(r"&[^\s;&]{0,33}\z"))
        return F.when(open_, F.slice(tokens, F.lit(1), F.size(tokens) - 1)).otherwise(tokens)

    # the one-element array has the tokens cut once
    tokens = F.get(F.transform(F.array(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0))), closed), 0)
    return F.array_join(F.filter(F.transform(tokens, text_of), lambda p: p != ""), "\n")


# A storage page as stretches: macros, headings, and what flows between them.
# Possessive, so that a stretch of any length is read without recursion.
_STRETCH = (r"(?s)<ac:structured-macro\b.*?</ac:structured-macro>|<h[1-6]\b.*?</h[1-6]>"
            r"|(?:[^<]++|<(?!ac:structured-macro\b|h[1-6]\b))++|.")
_LINK = r'<a\s[^>]*?href="([^"]+)"[^>]*>(.*?)</a>'
_FLOW_TOKEN = rf"(?s){_LINK.replace('(', '(?:').replace('(?:?', '(?')}|<[^>]*>|[^<]++|<"
_TAG_NAME = r"^</?([A-Za-z][A-Za-z0-9:-]*)"
# What an inline tag is in markdown, wherever it stands.
_MARKS = {"strong": "**", "em": "*", "code": "`"}
# References decoded in headings; the ampersand last.
_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}


def _decoded(text: Column) -> Column:
    for name, character in _REFERENCES.items():
        text = F.replace(text, F.lit(name), F.lit(character))
    return text


def _lines(markup: Column) -> Column:
    """Text between tags, stripped, blanks dropped, one per line."""
    return F.array_join(F.filter(F.transform(F.split(markup, r"<[^>]*>"), lambda t: strip(_decoded(t))),
                                 lambda t: t != ""), "\n")


def _inline(token: Column, link: Column) -> Column:
    """Markdown of one token of flowing text: a tag by its name, text as is."""
    name = F.lower(F.regexp_extract(token, _TAG_NAME, 1))
    closing = F.startswith(token, F.lit("</"))
    out = F.when(~F.startswith(token, F.lit("<")), token).when(
        (name == "a") & F.endswith(token, F.lit("</a>")) & ~closing, link)
    for tag, mark in _MARKS.items():
        out = out.when(name == tag, F.lit(mark))
    return (out.when((name == "li") & ~closing, F.lit("- ")).when(name == "br", F.lit("\n"))
            .when((name == "p") & closing, F.lit("\n")).otherwise(F.lit("")))


def _flow(markup: Column) -> Column:
    tokens = lambda text: F.regexp_extract_all(text, F.lit(_FLOW_TOKEN), F.lit(0))
    plain = lambda text: F.array_join(F.transform(tokens(text), lambda t: _inline(t, F.lit(""))), "")
    part = lambda t, n: F.regexp_extract(t, f"(?s){_LINK}", n)
    return F.array_join(F.transform(tokens(markup), lambda t: _inline(t, F.concat(
        F.lit("["), plain(part(t, 2)), F.lit("]("), part(t, 1), F.lit(")")))), "")


def _macro(markup: Column) -> Column:
    """A code macro's body in a fence; of other macros their text."""
    body = F.regexp_extract(markup, r"(?s)<ac:plain-text-body>\s*<!\[CDATA\[(.*?)\]\]>", 1)
    return F.when(markup.rlike(r'^<ac:structured-macro[^>]*\bac:name="code"'),
                  F.concat(F.lit("```\n"), body, F.lit("\n```"))).otherwise(_lines(markup))


def html_to_markdown(html: Column) -> Column:
    """Wiki storage markup -> markdown, in built-in functions, one pass over
    the page: each stretch is turned on its own and the results are joined."""
    level = lambda s: F.regexp_extract(s, r"^<h([1-6])\b", 1)
    turned = F.transform(F.regexp_extract_all(html, F.lit(_STRETCH), F.lit(0)), lambda s: (
        F.when(F.startswith(s, F.lit("<ac:structured-macro")), _macro(s))
        .when(level(s) != "", F.concat(F.repeat(F.lit("#"), level(s).cast("int")), F.lit(" "), _lines(s)))
        .otherwise(_flow(s))))
    return strip(F.regexp_replace(F.array_join(turned, ""), r"\n{3,}", "\n\n"))


def rich_text(runs: Column) -> Column:
    """Concatenated `plain_text` of a list of runs."""
    return F.array_join(F.transform(F.coalesce(runs, F.array()),
                                    lambda r: F.coalesce(r["plain_text"], F.lit(""))), "")
