"""HTML to text, element tables and link resolution."""

from __future__ import annotations

import html as _html
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from hirelens.functions.text import arrow_text_function

ELEMENT = StructType([
    StructField("seq", IntegerType()),
    StructField("end_seq", IntegerType()),
    StructField("tag", StringType()),
    StructField("classes", ArrayType(StringType())),
    StructField("attrs", MapType(StringType(), StringType())),
    StructField("text", StringType()),
])
_ARROW_ELEMENTS = pa.list_(pa.struct([
    ("seq", pa.int32()),
    ("end_seq", pa.int32()),
    ("tag", pa.string()),
    ("classes", pa.list_(pa.string())),
    ("attrs", pa.map_(pa.string(), pa.string())),
    ("text", pa.string()),
]))

# Bytes of pages whose elements a task holds at a time.
SHRED_BYTES = 1_000_000

_COMMENT = r"(?s)<!--.*?-->"
_SILENT = r"(?is)<(script|style|template)\b[^>]*>.*?</\1\s*>"
_HAS_SILENT = r"(?i)<(script|style|template)"
_BREAK = r"(?i)<(?:br|p)(?=[\s>/])[^>]*>"
_TAG = r"""<[/!?a-zA-Z][^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""
# Entities decoded in the JVM; &amp; goes last so that nothing is decoded twice.
_COMMON_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#x27;": "'", "&#39;": "'",
    "&#x2F;": "/", "&nbsp;": " ", "&amp;": "&",
}


def unescape(c: Column) -> Column:
    """Decode character references; only texts with uncommon ones are handed to Python."""
    common = "|".join(name[1:-1] for name in _COMMON_ENTITIES)
    uncommon = F.regexp_replace(c, f"&({common});", "").rlike("&[#a-zA-Z]")
    plain = c
    for name, char in _COMMON_ENTITIES.items():
        plain = F.replace(plain, F.lit(name), F.lit(char))
    decoded = arrow_text_function(_html.unescape)(F.when(c.contains("&") & uncommon, c))
    return F.coalesce(decoded, F.when(c.contains("&"), plain).otherwise(c))


def strip_tags(c: Column) -> Column:
    """HTML fragment without tags, comments and scripts; ``<br>`` and ``<p>`` break lines."""
    shown = F.when(c.contains("<!--"), F.regexp_replace(c, _COMMENT, "")).otherwise(c)
    heard = F.when(shown.rlike(_HAS_SILENT), F.regexp_replace(shown, _SILENT, "")).otherwise(shown)
    plain = F.regexp_replace(F.regexp_replace(heard, _BREAK, "\n"), _TAG, "")
    return F.when(c.contains("<"), plain).otherwise(c)


def html_to_text(c: Column) -> Column:
    """HTML fragment -> text; ``<br>`` and the start of ``<p>`` become line breaks.

    On large tables put ``strip_tags`` and ``unescape`` in two selects: the second reads its
    input more than once.
    """
    return unescape(strip_tags(c))


def shred(html: Column, tags: Sequence[str] | None = None) -> Column:
    """Page -> its elements in document order, as one array per page.

    ``seq`` is the index in the array and ``end_seq`` the index of the last element inside,
    so "inside" is a slice. ``tags`` keeps only the element kinds a job asks for. ``text`` is
    the visible text with whitespace collapsed. Elements take many times the room of their page, so
    a task holds those of few pages at a time, whatever the size of its batches.
    """
    wanted = None if tags is None else frozenset(tags)
    most = SHRED_BYTES

    def batch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from html.parser import HTMLParser

        import pyarrow.compute as pc

        void = {
            "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
            "param", "source", "track", "wbr",
        }
        silent = {"script", "style", "template"}

        class Shredder(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.elements, self.pieces, self.stack = [], [], []

            def handle_starttag(self, tag, attrs):
                values = {k: v or "" for k, v in attrs}
                element = None
                if wanted is None or tag in wanted:
                    element = {
                        "seq": len(self.elements), "end_seq": len(self.elements), "tag": tag,
                        "classes": values.get("class", "").split(), "attrs": list(values.items()),
                        "text": "",
                    }
                    self.elements.append(element)
                if tag not in void:
                    self.stack.append((tag, element, len(self.pieces)))

            def handle_startendtag(self, tag, attrs):
                self.handle_starttag(tag, attrs)
                if tag not in void:
                    self.finish()

            def finish(self):
                tag, element, start = self.stack.pop()
                if element is not None:
                    element["end_seq"] = len(self.elements) - 1
                    own = tag if tag in silent else None
                    element["text"] = " ".join(
                        text for holder, text in self.pieces[start:] if holder == own
                    )

            def handle_endtag(self, tag):
                if any(name == tag for name, _, _ in self.stack):
                    while self.stack[-1][0] != tag:
                        self.finish()
                    self.finish()

            def handle_data(self, data):
                text = " ".join(data.split())
                if text:
                    holder = next((name for name, _, _ in reversed(self.stack) if name in silent), None)
                    self.pieces.append((holder, text))

        def elements(page):
            shredder = Shredder()
            shredder.feed(page)
            shredder.close()
            while shredder.stack:
                shredder.finish()
            return shredder.elements

        def pieces(pages):
            """The batch in parts of so many bytes, or one page where that has more; an empty batch is one part."""
            sizes = pages.cast(pa.binary()).fill_null(b"")
            start = held = 0
            for at, size in enumerate(pc.binary_length(sizes).to_pylist()):
                if at > start and held + size > most:
                    yield pages.slice(start, at - start)
                    start, held = at, 0
                held += size
            yield pages.slice(start)

        for pages in batches:
            for piece in pieces(pages):
                yield pa.array([None if page is None else elements(page) for page in piece.to_pylist()], _ARROW_ELEMENTS)

    # Non-deterministic only in name: pages must not be parsed again for a pushed-down filter.
    return F.arrow_udf(batch, ArrayType(ELEMENT)).asNondeterministic()(html)


# --- selectors ----------------------------------------------------------------------------


def selector_tags(selectors: Sequence[str]) -> list[str] | None:
    """Element kinds the selectors mention, or None if one of them accepts any kind."""
    kinds = [step.split(".")[0] for selector in selectors for step in selector.split()]
    return None if "" in kinds else sorted(set(kinds))


def element_matches(element: Column, selector: str, elements: Column) -> Column:
    """``tag``, ``tag.class``, ``.class`` and descendant chains of those."""
    *outer, last = selector.split()
    tag, *classes = last.split(".")
    fits = F.lit(True) if tag == "" else element["tag"] == tag
    for name in classes:
        fits = fits & F.array_contains(element["classes"], name)
    if outer:
        fits = fits & F.exists(
            elements,
            lambda a: (a["seq"] < element["seq"])
            & (element["seq"] <= a["end_seq"])
            & element_matches(a, " ".join(outer), elements),
        )
    return fits


# --- links ---------------------------------------------------------------------------------

_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_ORIGIN = r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)"


def _fold_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` and empty inner segments of an absolute path."""
    segments = F.split(path, "/")
    last = F.size(segments) - 1
    inner = F.filter(segments, lambda s, i: (s != "") | (i == 0) | (i == last))
    folded = F.aggregate(
        inner,
        F.array().cast("array<string>"),
        lambda kept, s: F.when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(s == ".", kept)
        .otherwise(F.concat(kept, F.array(s))),
    )
    ends_open = F.element_at(segments, -1).isin(".", "..")
    joined = F.array_join(F.when(ends_open, F.concat(folded, F.array(F.lit("")))).otherwise(folded), "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of a link found on ``base``."""
    origin = F.regexp_extract(base, _ORIGIN, 1)
    base_path = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    folder = F.concat(F.regexp_replace(base_path, r"[^/]*$", ""))
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    absolute = F.when(path.startswith("/"), path).otherwise(
        F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path)
    )
    return (
        F.when(href == "", base)
        .when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 1), F.lit(":"), href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(href.startswith("?"), F.concat(origin, base_path, href))
        .otherwise(F.concat(origin, _fold_dots(absolute), rest))
    )
