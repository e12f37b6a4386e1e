"""Text, location, URL and identity expressions (Column -> Column)."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType

from hirelens import fixed_values as V

# Text made only of these characters is already in NFKC form, so it never leaves the JVM.
NFKC_STABLE = r"^[\x00-\x7FÀ-ÖØ-öø-ÿ£©®°·–—‘’“”•€]*+\z"
_PRINTABLE = r"^[\x20-\x7E]*+\z"
# The same with the other characters of NFKC_STABLE, none of which is white space.
_STABLE_PRINTABLE = r"^[\x20-\x7EÀ-ÖØ-öø-ÿ£©®°·–—‘’“”•€]*+\z"
_ASCII = r"^[\x00-\x7F]*+\z"
# Everything Python's str.strip() removes.
_EDGE_CHARS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def arrow_text_function(convert: Callable[[str], str]):
    """Arrow function text -> text. ``convert`` must be a library function or a local one, so
    that executors need no copy of this package.

    It is declared non-deterministic to keep Spark from evaluating it again in every filter
    it would otherwise push below the projection.
    """

    return _arrow_function(convert, StringType(), pa.string())


def _arrow_function(convert: Callable, kind: DataType, arrow_kind: pa.DataType):
    def batch(values: pa.Array) -> pa.Array:
        if values.null_count == len(values):
            return pa.nulls(len(values), arrow_kind)
        # Only the values that are there become Python objects.
        made = pa.array([convert(v) for v in values.drop_null().to_pylist()], arrow_kind)
        there = values.is_valid().to_numpy(zero_copy_only=False)
        return made.take(pa.array(there.cumsum() - 1, mask=~there))

    return F.arrow_udf(batch, kind).asNondeterministic()


def _unstable(c: Column) -> Column:
    """The text if NFKC can change it, else null."""
    # Counting bytes and characters tells ASCII texts apart without a pattern.
    return F.when((F.octet_length(c) > F.char_length(c)) & ~c.rlike(NFKC_STABLE), c)


def nfkc(c: Column) -> Column:
    """Unicode NFKC form; Python sees only the values that can change, the rest arrive as nulls."""
    normalize = arrow_text_function(partial(unicodedata.normalize, "NFKC"))
    return F.coalesce(normalize(_unstable(c)), c)


def nfkc_list(columns: Sequence[Column]) -> Column:
    """NFKC forms of several texts of a row as one array; nulls for texts that NFKC cannot change, null if it can change none.

    One column goes to Python and back instead of one for each text, as JSON: Arrow lists take several times as long as
    strings, even where all of them are null.
    """
    normalize = partial(unicodedata.normalize, "NFKC")
    convert = arrow_text_function(
        lambda row: json.dumps([None if v is None else normalize(v) for v in json.loads(row)]))
    changed = F.array(*map(_unstable, columns))
    made = convert(F.when(F.coalesce(*map(_unstable, columns)).isNotNull(), F.to_json(changed)))
    return F.from_json(made, ArrayType(StringType()), {"maxStringLen": str(2**31 - 1)})


def strip_ws(c: Column) -> Column:
    """Remove Unicode whitespace from both ends."""
    return F.btrim(c, F.lit(_EDGE_CHARS))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for all its uses in ``use``."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_text(c: Column, composed: Column | None = None) -> Column:
    """NFKC, no zero-width characters, one space between words, blank -> null.

    ``composed`` is the text's entry of ``nfkc_list``, if that has been computed.
    """

    def collapse(text: Column) -> Column:
        return F.trim(F.regexp_replace(text, V.WHITESPACE + "+", " "))

    # Most values are plain words with single spaces and pass untouched.
    spaced = ~c.contains("  ") & ~c.startswith(" ") & ~c.endswith(" ")
    whole = nfkc(c) if composed is None else F.coalesce(composed, c)
    wide = collapse(F.regexp_replace(whole, V.ZERO_WIDTH, ""))
    return blank_to_null(F.when(spaced & c.rlike(_PRINTABLE), c).when(c.rlike(_ASCII), collapse(c)).when(
        spaced & c.rlike(_STABLE_PRINTABLE), c).otherwise(wide))


def truncate(c: Column, max_chars: int) -> Column:
    """At most ``max_chars`` characters; a cut text ends with an ellipsis."""
    cut = F.regexp_replace(F.left(c, F.lit(max_chars - 1)), V.WHITESPACE + "+$", "")
    return F.when(F.length(c) > max_chars, F.concat(cut, F.lit("…"))).otherwise(c)


def _fix_word_case(word: Column) -> Column:
    core = F.btrim(word, F.lit("()[]"))
    cased = F.upper(core) != F.lower(core)
    shouted = cased & (core == F.upper(core))
    short_code = shouted & ((F.length(core) <= 3) | core.isin(*V.LOCATION_ACRONYMS))
    whispered = cased & (core == F.lower(core))
    capital = F.concat(F.upper(F.left(core, F.lit(1))), F.lower(F.substring(core, 2, 1_000_000)))
    return F.when(~short_code & (shouted | whispered), F.replace(word, core, capital)).otherwise(word)


def standardize_location(text: Column) -> Column:
    """Location text that is already normalised -> even commas, no edge punctuation, word case."""
    commas = F.regexp_replace(text, r"\s*,\s*", ", ")
    bare = blank_to_null(F.regexp_replace(commas, V.LOCATION_EDGE, ""))
    return F.array_join(F.transform(F.split(bare, " "), _fix_word_case), " ")


def normalize_location(c: Column) -> Column:
    return standardize_location(normalize_text(c))


def web_url_only(text: Column) -> Column:
    """Keep http(s) addresses, everything else -> null (input already normalised)."""
    return F.when(F.lower(text).rlike("^https?://"), text)


def normalize_url(c: Column) -> Column:
    return bind(normalize_text(c), web_url_only)


def stable_hash(*parts: Column, length: int = V.JOB_ID_CHARS, stripped: bool = False) -> Column:
    """Short hash of the parts, blind to case and edge whitespace; null counts as empty."""
    clean = [F.coalesce(F.lower(p if stripped else strip_ws(p)), F.lit("")) for p in parts]
    return F.left(F.sha2(F.concat_ws("|", *clean), 256), F.lit(length))


def job_id(source: Column, title: Column, company: Column, location: Column, url: Column,
           length: int = V.JOB_ID_CHARS) -> Column:
    """Identity of a posting, from cleaned fields."""
    return stable_hash(source, title, company, location, url, length=length, stripped=True)


def split_list(c: Column, separator: str = ",") -> Column:
    """Delimited text -> array of trimmed, non-empty items."""
    return F.filter(F.transform(F.split(c, separator), lambda x: F.trim(x)), lambda x: x != "")
