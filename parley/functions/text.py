"""Column functions for support text (all JVM-side, codegen-friendly).

Regexes are written with explicit character classes so that Java (Spark),
Python and RE2 (the DuckDB oracle) agree: Java's ``\\s``/``\\w``/``\\b`` are
ASCII by default while Python's are Unicode-aware.
"""

from __future__ import annotations

import html.entities
import json
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------
# Python's str whitespace set (what ``\s`` and ``str.split()`` use), spelled out.
WS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
NON_WS = WS.replace("[", "[^", 1)
# A "word character" as Python sees it for the texts we handle.
WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]"
HTML_TAG = r"<[^>]+>"
LEADING_MENTIONS = r"^(@[A-Za-z0-9_]+" + WS + r"*)+"
INLINE_MENTION = r"@[A-Za-z0-9_]+"
URL = r"https?://" + NON_WS + r"+|www\." + NON_WS + r"+"
ALNUM_ASCII = r"[a-zA-Z0-9]"
# A character reference after its ``&``, as HTML reads it.
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
BARE_NAME = 6   # no name that may stand without a semicolon is longer


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _literal(value: dict, kind: str) -> Column:
    """A map literal in one expression (folded to a constant when the query is planned)."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def entity_names() -> dict[str, str]:
    """HTML's named character references (name with its semicolon, if it needs one)."""
    return html.entities.html5


def odd_code_points() -> dict[int, str]:
    """Numeric references that do not mean their own code point: NUL, the C1 range, which
    HTML reads as Windows-1252, and code points that give nothing."""
    gone = [*range(0x1, 0x9), 0xB, *range(0xE, 0x20), *range(0x7F, 0xA0), *range(0xFDD0, 0xFDF0)]
    gone += [plane << 16 | last for plane in range(17) for last in (0xFFFE, 0xFFFF)]
    c1 = {k: bytes([k]).decode("cp1252", "ignore") or chr(k) for k in range(0x80, 0xA0)}
    return {**{k: "" for k in gone}, **c1, 0: "\ufffd"}


def _code_point(n: Column) -> Column:
    """The character of a code point (long); U+FFFD for surrogates and beyond the last one."""
    char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    odd = _literal({str(k): v for k, v in odd_code_points().items()}, "map<string,string>")
    bad = (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
    return F.coalesce(F.try_element_at(odd, n.cast("string")), F.when(bad, F.lit("\ufffd")).otherwise(char))


def _numeric(ref: Column) -> Column:
    digits = F.regexp_extract(ref, "^#[xX]?0*([0-9a-fA-F]*)", 1)
    # more than eight significant digits are beyond the last code point in either base
    short = F.when(F.length(digits) > 8, F.lit("99999999")).when(digits == "", F.lit("0")).otherwise(digits)
    base = F.when(ref.rlike("^#[xX]"), F.conv(short, 16, 10)).otherwise(F.conv(short, 10, 10))
    return _bind(base.cast("long"), _code_point)


def _named(ref: Column) -> Column:
    """A named reference: the whole name, else the longest name that it starts with, else itself."""
    by_first: dict[str, dict[str, str]] = {}
    for name, value in entity_names().items():
        by_first.setdefault(name[0], {})[name] = value
    bare = {name: value for name, value in entity_names().items() if not name.endswith(";")}
    own = F.try_element_at(_literal(by_first, "map<string,map<string,string>>"), F.substring(ref, 1, 1))
    starts = _literal(bare, "map<string,string>")
    prefixes = [F.when(F.length(ref) > n, F.concat(F.try_element_at(starts, F.substring(ref, 1, n)), F.substring(ref, n + 1, 64))) for n in range(BARE_NAME, 1, -1)]
    return F.coalesce(F.try_element_at(own, ref), *prefixes, F.concat(F.lit("&"), ref))


def _decoded(part: Column) -> Column:
    """What follows an ``&`` up to the next one, its reference decoded."""
    return _bind(F.regexp_extract(part, REFERENCE, 1), lambda ref: F.when(ref == "", F.concat(F.lit("&"), part)).otherwise(
        F.concat(F.when(F.startswith(ref, F.lit("#")), _numeric(ref)).otherwise(_named(ref)), F.substring(part, F.length(ref) + 1, F.length(part)))))


def unescape_entities(x) -> Column:
    """HTML character references, named (with or without semicolon, by longest prefix)
    and numeric, in one pass from left to right; texts without ``&`` are left alone."""
    c = _c(x)
    parts = F.split(c, "&")
    return F.when(F.contains(c, F.lit("&")), F.concat(F.get(parts, F.lit(0)), F.array_join(
        F.transform(F.slice(parts, F.lit(2), F.size(parts)), _decoded), ""))).otherwise(c)


def strip_tags(x) -> Column:
    """every ``<...>`` tag becomes one space."""
    return F.regexp_replace(_c(x), HTML_TAG, " ")


def strip_leading_mentions(x) -> Column:
    """drop routing handles at the start (``@Brand @123 hi`` -> ``hi``)."""
    return F.regexp_replace(_c(x), LEADING_MENTIONS, "")


def mask_mentions(x, token: str = "@user") -> Column:
    """inline handles become a fixed token (e-mail hosts too, as in the reference)."""
    return F.regexp_replace(_c(x), INLINE_MENTION, token)


def strip_ws(x) -> Column:
    """Python ``str.strip()``: trim the full whitespace set."""
    return F.regexp_replace(_c(x), "^" + WS + "+|" + WS + "+$", "")


def collapse_ws(x) -> Column:
    """whitespace runs -> one space, then trim."""
    return F.trim(F.regexp_replace(_c(x), WS + "+", " "))


def _cleaned(raw: Column, marked: Column) -> Column:
    """Collapsed text, null as empty. Only a text with an entity, tag or mention sign
    pays for the replacements (``marked``); all others are just collapsed."""
    signs = F.contains(raw, F.lit("&")) | F.contains(raw, F.lit("<")) | F.contains(raw, F.lit("@"))
    return F.coalesce(F.when(signs, collapse_ws(marked)).otherwise(collapse_ws(raw)), F.lit(""))


def clean_customer(x, remove_inline_mentions: bool = True) -> Column:
    """F8: unescape -> tags -> leading mentions -> strip -> mask mentions -> collapse."""
    raw = _c(x)
    c = strip_leading_mentions(strip_tags(unescape_entities(raw)))
    if remove_inline_mentions:
        c = mask_mentions(c)
    return _cleaned(raw, c)


def clean_support(x) -> Column:
    """unescape -> tags -> leading mentions -> collapse (URLs, signatures kept)."""
    raw = _c(x)
    return _cleaned(raw, strip_leading_mentions(strip_tags(unescape_entities(raw))))


def word_count(x) -> Column:
    """``len(s.split())`` for an already collapsed string."""
    c = _c(x)
    return F.when(c == "", F.lit(0)).otherwise(F.size(F.split(c, " ")))


def word_count_raw(x) -> Column:
    """F4 on uncollapsed text."""
    return word_count(collapse_ws(x))


def at_most_words(x, n: int) -> Column:
    """``word_count_raw(x) <= n`` without scanning the whole text: an anchored,
    possessive pattern that gives up after the (n+1)-th word (linear, no backtracking)."""
    if n <= 0:
        return F.coalesce(_c(x).rlike("^" + WS + "*+\\z"), F.lit(True))
    pattern = ("^" + WS + "*+(?:" + NON_WS + "++" + WS + "++){0," + str(n - 1) + "}+(?:" + NON_WS + "++)?+"
               + WS + "*+\\z")
    return F.coalesce(_c(x).rlike(pattern), F.lit(True))


def has_alnum(x) -> Column:
    return _c(x).rlike(ALNUM_ASCII)


def word_set(x) -> Column:
    """distinct lower-case word tokens (Unicode letters/digits/underscore)."""
    return F.array_distinct(F.regexp_extract_all(F.lower(_c(x)), F.lit("(" + WORD + "+)"), 1))


def extract_urls(x) -> Column:
    """all URLs in a text, in order."""
    return F.regexp_extract_all(_c(x), F.lit("(" + URL + ")"), 1)


def has_url(x) -> Column:
    return _c(x).rlike(URL)


def contains_any(x, words, regex: bool = False) -> Column:
    """Substring match of any keyword in the lower-cased text.

    Default: OR-ed ``contains`` (a JVM indexOf per keyword; fastest on long texts).
    ``regex=True``: one alternation of literal-quoted keywords, same answer, one
    expression -- for short texts given as long expressions, where the OR form
    would copy the expression once per keyword into the generated code."""
    if not words:
        return F.lit(False)
    if regex:
        pattern = "|".join(r"\Q" + w + r"\E" for w in words)
        return F.coalesce(F.lower(_c(x)).rlike(pattern), F.lit(False))
    low = F.lower(_c(x))
    return F.coalesce(reduce(lambda a, b: a | b, [low.contains(w) for w in words]), F.lit(False))


def word_regex(words) -> str:
    """P10 pattern: any of ``words`` as whole words (explicit Unicode boundaries)."""
    alt = "|".join(w.replace(".", r"\.") for w in words)
    return r"(^|" + NON_WORD + r")(" + alt + r")($|" + NON_WORD + r")"


def matches_words(x, words) -> Column:
    """P10: case-insensitive whole-word match, null-safe (null -> False)."""
    if not words:
        return F.lit(False)
    return F.coalesce(F.lower(_c(x)).rlike(word_regex(words)), F.lit(False))


def safe_ratio(num, den) -> Column:
    """``a / max(1, b)``."""
    return _c(num).cast("double") / F.greatest(F.lit(1), _c(den)).cast("double")


def truncate(x, n: int = 120) -> Column:
    """first ``n`` characters."""
    return F.substring(_c(x), 1, n)


def choice(x, mapping: dict, default=None) -> Column:
    """Dictionary-coded value lookup with a default (map literal)."""
    m = F.create_map(*[v for k, val in mapping.items() for v in (F.lit(k), F.lit(val))])
    return F.coalesce(m[_c(x)], F.lit(default))


def clamp(x, lo: float, hi: float) -> Column:
    """F16."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(x)))
