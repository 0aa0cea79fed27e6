"""Scalar functions on text, JSON, URIs and token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.identity import canonical_json


def word_tokens(c: Column) -> Column:
    """Runs of a-z and 0-9 in the lower-cased text."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))


def matches_any_word(content: Column, query: str, most: int = 256) -> Column:
    """Whether the text has any word of the query, case ignored; words with other characters than letters and digits are left out."""
    if len(query) > most:
        raise ValueError(f"a query has at most {most} characters")
    words = [w.lower() for w in query.split() if w.isalnum()]
    found = F.lit(False)
    for w in words:
        found = found | F.lower(content).contains(w)
    return found


def json_or_null(c: Column, schema: str) -> Column:
    """Parsed JSON, null where it is none."""
    return F.from_json(c, schema)


def json_object_in(c: Column) -> Column:
    """From the first { to the last } of a text, if that is JSON; else null."""
    part = F.nullif(F.regexp_extract(c, r"(?s)(\{.*\})", 1), F.lit(""))
    return F.when(F.try_parse_json(part).isNotNull(), part)


def quoted_name(c: Column) -> Column:
    """What follows 'name': ' up to the next quote (or the end); null without that mark."""
    return F.when(c.contains("'name': '"), F.regexp_extract(c, r"'name': '([^']*)", 1))


def before_dash(c: Column) -> Column:
    return F.substring_index(c, "-", 1)


def length_bin(n: Column) -> Column:
    return F.when(n <= 9, "short").when(n <= 15, "medium").otherwise("long")


def tags(c: Column, phrases: dict[str, str]) -> Column:
    """Tags of the phrases that the text contains."""
    return F.array_compact(F.array(*(F.when(c.contains(p), F.lit(t)) for p, t in phrases.items())))


def is_hex64(c: Column) -> Column:
    return c.rlike("^[0-9a-f]{64}$")


def uri_is_safe(c: Column) -> Column:
    """No credentials, absolute local path or step upwards; the scheme is none, cas, s3, gs or https."""
    scheme = F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return scheme.isin("", "cas", "s3", "gs", "https") & ~c.startswith("/") & ~c.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*@") & ~c.rlike(r"(^|/)\.\.(/|$)")


def major_version(c: Column) -> Column:
    return F.try_element_at(F.split(c, r"\."), F.lit(1)).try_cast("int")


def task_number(c: Column, prefix: str = "pilot") -> Column:
    return F.nullif(F.regexp_extract(c, rf"^{prefix}-(\d{{3}})$", 1), F.lit("")).try_cast("int")


def whole_or_zero(c: Column) -> Column:
    return F.coalesce(c.try_cast("long"), F.lit(0).cast("long"))


def span_start(haystack: Column, needle: Column) -> Column:
    """Where an array lies in another, from 0; null unless it does so exactly once."""
    n = F.size(needle)
    at = F.filter(F.sequence(F.lit(0), F.greatest(F.size(haystack) - n, F.lit(0))), lambda i: F.slice(haystack, i + 1, n) == needle)
    return F.when((n > 0) & (n <= F.size(haystack)) & (F.size(at) == 1), F.element_at(at, 1))


def span_mask(size: Column, spans: Column) -> Column:
    """Booleans of a sequence: whether each place is in any of spans, an array of struct(start, end), end exclusive."""
    return F.when(size > 0, F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.exists(spans, lambda s: (i >= s.start) & (i < s.end)))).otherwise(F.array().cast("array<boolean>"))


def right_pad(a: Column, n: Column, pad: Column) -> Column:
    return F.concat(a, F.array_repeat(pad, F.greatest(n - F.size(a), F.lit(0))))


def labels(ids: Column, mask: Column) -> Column:
    """Token ids where the mask holds, -100 elsewhere."""
    return F.zip_with(ids, mask, lambda i, m: F.when(m, i).otherwise(-100))


def ascii_escaped(c: Column) -> Column:
    """A JSON text in which every character beyond ASCII is \\uXXXX, two of them for what is beyond the basic plane."""
    unit = lambda x: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(x)), 4, "0"))

    def one(ch: Column) -> Column:
        code = F.ascii(ch)
        rest = code - 0x10000
        return F.when(code < 0x80, ch).when(code < 0x10000, unit(code)).otherwise(F.concat(unit(F.shiftright(rest, 10) + 0xD800), unit(rest.bitwiseAND(F.lit(0x3FF)) + 0xDC00)))

    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.array_join(F.transform(F.split(c, ""), one), ""))


def ascii_json(*names: str) -> Column:
    """Canonical JSON of columns in ASCII alone."""
    return ascii_escaped(canonical_json(*names))
