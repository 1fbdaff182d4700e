"""Column functions on texts. Blanks are Unicode blanks throughout; offsets are code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundmill.common import norm_id

# Python counts the four separators U+001C to U+001F as blanks, Java's White_Space does not.
BLANK = r"[\s\x{1c}-\x{1f}]"
# Keywords that say nothing.
EMPTY_KEYWORDS = ("the", "a", "an", "and", "or", "of", "to", "in", "on", "for", "n/a", "none", "-")


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    return F.regexp_replace(_col(x), rf"(?U)^{BLANK}+|{BLANK}+$", "")


def collapse(x: Column | str) -> Column:
    return strip(F.regexp_replace(_col(x), rf"(?U){BLANK}+", " "))


def sha256_text(x: Column | str) -> Column:
    return F.sha2(_col(x), 256)


def none_if_blank(x: Column | str) -> Column:
    """Null for blank text and for the word null; any other text as it is."""
    return F.when(~F.lower(strip(x)).isin("", "null"), _col(x))


def quote_pattern(quote: Column | str) -> Column:
    """Pattern of a quote in which any run of blanks stands for any other."""
    words = F.split(collapse(quote), " ")
    literal = F.transform(words, lambda w: F.concat(F.lit("\\Q"), F.replace(w, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    return F.concat(F.lit("(?U)"), F.array_join(literal, f"{BLANK}+"))


def locate_quote(text: Column | str, quote: Column | str) -> Column:
    """STRUCT<start, end> of the first occurrence, exact or else with other blanks; null where there is none."""
    text, q = _col(text), strip(quote)
    exact = F.call_function("locate", q, text)
    loose = F.regexp_substr(text, quote_pattern(quote))
    at = F.call_function("locate", loose, text)
    found = F.when(exact > 0, F.struct((exact - 1).alias("start"), (exact - 1 + F.length(q)).alias("end"))).when(loose.isNotNull(), F.struct((at - 1).alias("start"), (at - 1 + F.length(loose)).alias("end")))
    return F.when(F.length(q) > 0, found)


def normalize_actor(x: Column | str) -> Column:
    return collapse(x)


def normalize_date(x: Column | str) -> Column:
    return strip(x)


def normalize_type(x: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(strip(x)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def normalize_keyword(x: Column | str) -> Column:
    return collapse(F.lower(_col(x)))


def clean_keyword(x: Column | str, empty: tuple[str, ...] = EMPTY_KEYWORDS) -> Column:
    """'' for a keyword to drop."""
    k = normalize_keyword(x)
    return F.when((F.length(k) < 2) | k.isin(*empty), F.lit("")).otherwise(k)


def parse_prose_label(x: Column | str) -> Column:
    t = F.lower(strip(x))
    no = t.contains("non_prose") | t.contains("non-prose") | t.contains("non prose") | t.startswith("non")
    return F.when(no, "non_prose").when(t.contains("prose"), "prose").otherwise("non_prose")


def page_range(name: Column | str) -> Column:
    """STRUCT<stem, lo, hi> of a file name; lo null where it has no range."""
    stem = F.regexp_replace(F.regexp_replace(_col(name), r"^.*/", ""), r"(?<=.)\.[^.]*$", "")
    part = lambda i: F.nullif(F.regexp_extract(stem, r"(\d+)-(\d+)", i), F.lit("")).try_cast("int")
    return F.struct(stem.alias("stem"), part(1).alias("lo"), part(2).alias("hi"))


def uuid_key(x: Column | str) -> Column:
    """The one form of a uuid, lower case with dashes, of any common spelling (blanks around, braces and urn:uuid: are
    optional, dashes too, letters of any case); null for any other text."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(strip(x)), r"^\{?(?:urn:)?(?:uuid:)?\{?|\}$", ""), "-", "")
    cut = lambda at, n: F.substring(bare, at, n)
    return F.when(bare.rlike("^[0-9a-f]{32}$"), F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12)))


def is_uuid(x: Column | str) -> Column:
    return uuid_key(x).isNotNull()


def any_id(x: Column | str) -> Column:
    """The one form of a uuid, and the normal form of any other id."""
    return F.coalesce(uuid_key(x), norm_id(x))


def identifier(x: Column | str) -> Column:
    """A label as part of a schema name."""
    return F.lower(F.regexp_replace(_col(x), "[^a-zA-Z0-9_]", "_"))


def haystack(span: Column, fields: Column, relevance: Column, actor: Column, date: Column) -> Column:
    return F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in (span, fields, relevance, actor, date)]))
