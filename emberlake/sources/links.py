"""Links in a table of web pages."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# White space of the standard, for use in a class.
_SPACE = r"\t\n\f\r "
# Where text ends: a comment, a tag, or what is read as a comment up to the next ``>``.
_MARKUP = re.compile(rf"<(?:(?P<comment>!--)|(?P<end>/?)(?P<name>[a-zA-Z][^{_SPACE}/>]*)|[!?/])")
_COMMENT_END = re.compile(r"(?<=<!--)-?>|--!?>")
_BETWEEN = re.compile(rf"[{_SPACE}/]*")
_NAME = re.compile(rf"=?[^{_SPACE}/>=]*")
_EQUALS = re.compile(rf"[{_SPACE}]*=[{_SPACE}]*")
_VALUE = re.compile(rf"\"([^\"]*)\"|'([^']*)'|(?![\"'])([^{_SPACE}>]*)")
# Elements whose content is text up to their own end tag.
_TEXT_ONLY = {n: re.compile(rf"(?i)</{n}(?=[{_SPACE}/>])") for n in "script style title textarea xmp iframe noembed noframes".split()}
# A character reference in an attribute; a name without a semicolon counts only where neither = nor more letters follow.
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*(?:;|(?![=a-zA-Z0-9;])))")
_HAS_ANCHOR = rf"(?i)<a[{_SPACE}/]"


def _attribute(value: str) -> str:
    """``value`` with its character references decoded as in attributes: ``?a=1&copy=2`` stays as it is."""
    return _REFERENCE.sub(lambda m: unescape(m[0]) if m[0][1] == "#" else html5.get(m[0][1:], m[0]), value)


def hrefs_of(page: str) -> Iterator[str]:
    """The href of every anchor's start tag, in order, by the tokenising states of the HTML standard.

    Quoted values may hold ``>``; of a repeated attribute the first counts; an href without a value is empty. Comments
    and the content of scripts, styles, titles and text areas hold no tags, and an unclosed one runs to the end of the
    page, as does an unclosed tag. A script ends at its first end tag.
    """
    at = 0
    while opened := _MARKUP.search(page, at):
        at = opened.end()
        if opened["comment"]:
            close = _COMMENT_END.search(page, at)
        elif opened["name"] is None:
            close = re.compile(">").search(page, at)
        else:
            href = None
            while True:
                at = _BETWEEN.match(page, at).end()
                if at == len(page):
                    return
                if page[at] == ">":
                    at += 1
                    break
                name = _NAME.match(page, at)
                at, value = name.end(), ""
                if equals := _EQUALS.match(page, at):
                    found = _VALUE.match(page, equals.end())
                    if not found:  # a quote that never closes
                        return
                    at, value = found.end(), found[found.lastindex]
                if href is None and name[0].lower() == "href":
                    href = value
            tag = opened["name"].lower()
            if opened["end"]:
                continue
            if tag == "a" and href is not None:
                yield _attribute(href)
            if tag == "plaintext":
                return
            if tag not in _TEXT_ONLY:
                continue
            if close := _TEXT_ONLY[tag].search(page, at):
                at = close.start()
                continue
        if not close:
            return
        at = close.end()


@F.arrow_udf(ArrayType(StringType()))
def _hrefs(pages: pa.Array) -> pa.Array:
    # One page at a time as text of Python, however many a batch holds.
    return pa.array((list(hrefs_of(p.as_py() or "")) for p in pages), pa.list_(pa.string()))


# A character reference, text without one, or a lone ampersand.
_PIECE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
# Names that count without a semicolon too, the longest first.
_BARE = "^&(" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"
# Numbers that stand for another character, as browsers and the standard have it.
_MOVED = {0: "�"} | {n: bytes([n]).decode("cp1252") for n in range(0x80, 0xA0) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def _numbered(piece: Column) -> Column:
    """The character of a numeric reference."""
    digits = F.regexp_extract(piece, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
    code = F.when(F.lower(F.substring(piece, 3, 1)) == "x", F.conv(digits, 16, 10)).otherwise(digits)
    code = F.when(digits == "", F.lit(0)).when(F.length(digits) > 7, F.lit(0x110000)).otherwise(code.cast("int"))
    above = code - 0x10000
    # UTF-16, in hexadecimal digits.
    pair = F.concat(F.hex(F.shiftright(above, 10) + 0xD800), F.hex(above.bitwiseAND(0x3FF) + 0xDC00))
    char = F.decode(F.unhex(F.when(code < 0x10000, F.lpad(F.hex(code), 4, "0")).otherwise(pair)), "UTF-16BE")
    # Python's html module keeps these numbers of the range above and gives nothing for other control characters and noncharacters.
    kept = code.isin(0x09, 0x0A, 0x0C, 0x0D, 0x81, 0x8D, 0x8F, 0x90, 0x9D)
    control = (code < 0x20) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    moved = F.from_json(F.lit(json.dumps(_MOVED)), "map<string,string>")
    return (
        F.when((code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("�"))
        .when((code == 0) | (code.between(0x80, 0x9F) & ~kept), F.try_element_at(moved, code.cast("string")))
        .when(control & ~kept, F.lit(""))
        .otherwise(char)
    )


def decoded(text: Column) -> Column:
    """``text`` with every numeric and standard named character reference decoded once, as ``html.unescape`` does."""
    named = F.from_json(F.lit(json.dumps({f"&{k}": v for k, v in html5.items() if k.endswith(";")})), "map<string,string>")
    bare = F.from_json(F.lit(json.dumps({k: v for k, v in html5.items() if not k.endswith(";")})), "map<string,string>")

    def one(piece: Column) -> Column:
        prefix = F.regexp_extract(piece, _BARE, 1)
        cut = F.concat(F.try_element_at(bare, prefix), piece.substr(F.length(prefix) + 2, F.length(piece)))
        text = F.coalesce(F.try_element_at(named, piece), F.when(prefix != "", cut), piece)
        return F.when(~piece.startswith("&"), piece).when(piece.rlike("^&#[0-9xX]"), _numbered(piece)).otherwise(text)

    pieces = F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, one), "")).otherwise(text)


def extract_links(pages: DataFrame, url: str, html: str, suffix: str, link: str = "link") -> DataFrame:
    """One row per anchor whose href ends in ``suffix``, with the page address put before it.

    The address is concatenated, not resolved, and repeated links stay
    repeated. Only the page itself goes through Arrow, and only pages with
    an anchor; see :func:`hrefs_of` for what counts as one.
    """
    rest = [c for c in pages.columns if c != html]
    found = pages.where(F.col(html).rlike(_HAS_ANCHOR)).select(*rest, F.explode(_hrefs(F.col(html))).alias("__href"))
    found = found.filter(F.col("__href").endswith(suffix))
    return found.select(*rest, F.concat(F.col(url), F.col("__href")).alias(link))
