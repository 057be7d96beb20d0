"""Text expressions: cleaning, identifiers, links and place phrases.

All of them are built-in column expressions, so they stay inside the JVM and work
the same in batch and in streaming.
"""

from __future__ import annotations

import json
import zlib
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

_SPACE = r"[\s\x1c-\x1f\u0085   -     　]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardize_name(c) -> Column:
    """Title Case without outer spaces; inner double spaces stay."""
    return F.trim(F.initcap(_col(c)))


def clean_text(c) -> Column:
    """Lower case, each character that is no ASCII letter or space becomes one space."""
    return F.lower(F.regexp_replace(_col(c), r"[^a-zA-Z\s]", " "))


def document_text(*cols) -> Column:
    """Texts joined by one space, NULLs left out."""
    return F.concat_ws(" ", *[_col(c) for c in cols])


def normalize_key(c, words=("kecamatan", "kec.")) -> Column:
    """Lower-case join key without the first hit of each prefix word; NULL gives ''."""
    key = F.lower(F.coalesce(_col(c), F.lit("")))
    for word in words:
        key = F.regexp_replace(key, rf"(?s)^(.*?)\Q{word}\E", "$1")
    return F.trim(key)


def resolve_alias(c, aliases: dict[str, str] | None = None) -> Column:
    """Replace known spelling variants of a key by the accepted one."""
    aliases = fixed.DISTRICT_ALIASES if aliases is None else aliases
    if not aliases:
        return _col(c)
    pairs = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, _col(c)), _col(c))


# --- HTML ------------------------------------------------------------------------

# One alternation, so that the leftmost construct wins as it does in a parser.  A quote counts only
# after "=", and what is not closed ends with the text.
_MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
    r"|<[!?][^>]*>"
    r"""|</?[a-z](?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>"""
)
_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);?"
_NAME_GROUPS = 256


def _names() -> Column:
    """Names of character references to their text, as one constant: maps of a few names, by the CRC-32 of the name."""
    groups: list[dict[str, str]] = [{} for _ in range(_NAME_GROUPS)]
    for name, text in html5.items():
        name = name.rstrip(";")
        groups[zlib.crc32(name.encode()) % _NAME_GROUPS][name] = text
    return F.from_json(F.lit(json.dumps(groups)), "array<map<string,string>>")


def _windows_1252() -> Column:
    """The numbers 128 to 159 that stand for the characters of that code page."""
    known = {}
    for code in range(128, 160):
        try:
            known[str(code)] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            pass  # five numbers are not in use
    return F.from_json(F.lit(json.dumps(known)), "map<string,string>")


def _code_point(c: Column) -> Column:
    return F.decode(F.unhex(F.lpad(c, 8, "0")), "UTF-32")


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _character(reference: Column) -> Column:
    """The text of a reference; an unknown name stays as it is."""
    ref = F.replace(F.replace(reference, F.lit("&"), F.lit("")), F.lit(";"), F.lit(""))
    digits = F.regexp_replace(F.regexp_replace(ref, "^#[xX]?", ""), "^0+", "")
    hexa = F.when(ref.rlike("^#[xX]"), F.lower(digits)).when(F.length(digits) < 9, F.lower(F.conv(digits, 10, 16)))
    code = F.conv(F.when(F.length(hexa) < 8, hexa), 16, 10).cast("bigint")
    character = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    group = F.get(_names(), (F.crc32(ref.cast("binary")) % _NAME_GROUPS).cast("int"))
    return (F.when(ref.startswith("#"), F.coalesce(F.try_element_at(_windows_1252(), code.cast("string")),
                                                   F.when(character, _code_point(hexa)), F.lit("\ufffd")))
            .otherwise(F.coalesce(F.try_element_at(group, ref), reference)))


def decode_entities(c) -> Column:
    """Replace named and numeric character references, with or without ``;``, each exactly once.

    Numbers of any length are read; those that are no character become U+FFFD.  Unknown names stay.  The different
    references of a text are decoded once each and put back between the pieces around them.
    """
    def decoded(text: Column) -> Column:
        found = F.struct(F.split(text, _REFERENCE).alias("pieces"), F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)).alias("refs"))
        return _bound(found, lambda x: _bound(F.array_distinct(x["refs"]), lambda different: _bound(
            F.map_from_arrays(different, F.transform(different, _character)), lambda known: joined(x, known))))

    def joined(found: Column, known: Column) -> Column:
        return F.array_join(F.zip_with(found["pieces"], found["refs"], lambda piece, ref: F.concat(
            piece, F.coalesce(F.try_element_at(known, ref), F.lit("")))), "")

    return _bound(_col(c), lambda text: F.when(F.contains(text, F.lit("&")), decoded(text)).otherwise(text))


def html_to_text(c) -> Column:
    """Visible text: no markup, scripts, styles or comments; NULL and '' give ''."""
    text = decode_entities(F.regexp_replace(F.coalesce(_col(c), F.lit("")), _MARKUP, " "))
    return F.trim(F.regexp_replace(text, _SPACE, " "))


# --- news items --------------------------------------------------------------------

def stable_id(c, n: int = 16) -> Column:
    """First ``n`` hex digits of the SHA-256 of a link."""
    return F.substring(F.sha2(_col(c), 256), 1, n)


def publisher(source, title, default: str = "Unknown") -> Column:
    """Stated source, else the text after the last ' - ' of the title, else a default."""
    title = F.coalesce(_col(title), F.lit(""))
    tail = F.when(F.contains(title, F.lit(" - ")),
                  F.regexp_replace(F.regexp_extract(title, r"(?s)^.* - (.*)$", 1), r"^\s+|\s+$", ""))
    return F.coalesce(_col(source), tail, F.lit(default))


def to_ts(c) -> Column:
    """ISO text to timestamp, NULL if it is not one (never an error under ANSI)."""
    return _col(c).try_cast("timestamp")


# Weekday, day, month name, year, time, zone; what feeds write in place of the plain RFC-822 shape.
_FEED_DATE = (r"^\s*(?:[A-Za-z]+\.?,?\s+)?(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*\.?[\s-]+(\d{4}|\d{2}),?\s+"
              r"(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\.\d+)?\s*([A-Za-z]{1,5}|[+-]\d{2}:?\d{2})?\s*(?:\([^)]*\))?\s*$")
#: Zone names of RFC 822 and their offsets (fixed values).
ZONES = {"UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600",
         "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}


def parse_rfc822(c) -> Column:
    """Feed date to timestamp, or NULL: 'Mon, 02 Jan 2025 10:00:00 GMT' and its usual variants.

    Weekday and seconds may be missing, the year may have two digits (69 to 99 are the last century),
    the zone is a name of RFC 822 or an offset; without one it is UTC.
    """
    offsets = F.from_json(F.lit(json.dumps(ZONES)), "map<string,string>")

    def plain(parts: Column) -> Column:
        day, month, year, hour, minute, second, zone = (F.get(parts, F.lit(i)) for i in range(7))
        century = F.when(F.length(year) == 4, "").when(year >= "69", "19").otherwise("20")
        offset = F.when(zone == "", "+0000").when(zone.rlike("^[+-]"), F.replace(zone, F.lit(":"), F.lit(""))).otherwise(
            F.try_element_at(offsets, F.upper(zone)))
        return F.concat(day, F.lit(" "), F.initcap(month), F.lit(" "), century, year, F.lit(" "), hour, F.lit(":"), minute,
                        F.lit(":"), F.when(second == "", "00").otherwise(second), F.lit(" "), offset)

    # The parts are taken out once; a lambda binds them, so that no expression repeats the search.
    parts = F.split(F.when(_col(c).rlike(_FEED_DATE), F.regexp_replace(_col(c), _FEED_DATE, "$1|$2|$3|$4|$5|$6|$7")), r"\|")
    return F.try_to_timestamp(F.get(F.transform(F.array(parts), plain), F.lit(0)), F.lit("d MMM yyyy H:mm:ss Z"))


def iso_text(c) -> Column:
    """Timestamp to ISO text without a zone; NULL stays NULL."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss")


def published_at(c, now=None) -> Column:
    """Publication date as UTC ISO text, else the raw text, else ``now``."""
    raw = F.when(_col(c) != "", _col(c))

    def utc(stamp: Column) -> Column:
        return iso_text(F.to_utc_timestamp(stamp, F.current_timezone()))

    # ISO text without a zone is taken as UTC already, whatever the session's zone.
    zoned = raw.rlike(r":\d{2}.*(Z|[+-]\d{2}:?\d{2})$")
    iso = F.when(zoned, utc(to_ts(raw))).otherwise(iso_text(to_ts(raw)))
    return F.coalesce(utc(parse_rfc822(raw)), iso, raw, iso_text(F.current_timestamp() if now is None else _col(now)))


def contains_any(c, parts) -> Column:
    hit = F.lit(False)
    for part in parts:
        hit = hit | F.contains(_col(c), F.lit(part))
    return hit


def is_listing_page(c, parts=fixed.LISTING_PARTS) -> Column:
    """True for listing links; a missing link counts as one."""
    return F.coalesce(contains_any(c, parts) | (_col(c) == ""), F.lit(True))


def is_article_link(c, search_parts=fixed.SEARCH_PAGE_PARTS) -> Column:
    """True for a present link that is not a search page."""
    return F.coalesce((_col(c) != "") & ~contains_any(c, search_parts), F.lit(False))


def decode_redirect(c, parts=fixed.REDIRECT_PARTS) -> Column:
    """Target link packed as url-safe base64 after 'articles/'; the input if that fails."""
    link = _col(c)
    packed = F.translate(F.regexp_extract(link, r"articles/([^/?]+)", 1), "-_", "+/")
    size = F.length(packed)
    padded = F.rpad(packed, (F.ceil(size / 4) * 4).cast("int"), "=")
    text = F.decode(F.when(size % 4 != 1, F.try_to_binary(padded, F.lit("base64"))), "ISO-8859-1")
    target = F.regexp_extract(text, r"(https?://[a-zA-Z0-9\-._~:/?#\[\]@!$&'()*+,;=%]+)", 1)
    return F.when(contains_any(link, parts) & (target != ""), target).otherwise(link)


def search_phrase(title, suffix: str = fixed.CITY, stopwords=fixed.SEARCH_STOPWORDS,
                  min_length: int = 4, words: int = 5) -> Column:
    """First long words of a title that are no stop words, plus a suffix."""
    stop = F.array(*[F.lit(w) for w in stopwords])
    kept = F.filter(F.split(_col(title), r"[\s,]+"),
                    lambda w: (F.length(w) >= min_length) & ~F.array_contains(stop, F.lower(w)))
    return F.concat(F.array_join(F.slice(kept, 1, words), " "), F.lit(" " + suffix))


def url_component(c) -> Column:
    """Percent-encode a text as a URL component."""
    text = F.url_encode(_col(c))
    for code, char in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def search_url(title, **kwargs) -> Column:
    return F.concat(F.lit(fixed.SEARCH_URL_PREFIX), url_component(search_phrase(title, **kwargs)),
                    F.lit(fixed.SEARCH_URL_SUFFIX))


def place_phrase(*cols, suffix: str = fixed.CITY, streets=fixed.STREET_WORDS,
                 street_ends=fixed.STREET_END_WORDS, landmarks=fixed.LANDMARK_WORDS,
                 subdistricts=fixed.SUBDISTRICT_WORDS) -> Column:
    """Best place phrase of a text: street, else landmark, else sub-district, else NULL."""
    text = F.lower(F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("")) for c in cols]))

    def words(starts, more):
        return rf"(?:{'|'.join(starts)})\s+[a-z0-9]+(?:\s+[a-z0-9]+){{0,{more}}}"

    street = F.regexp_extract(text, words(streets, 3), 0)
    street = F.regexp_replace(F.trim(street), rf"\b({'|'.join(street_ends)})\b.*", "")
    street = F.regexp_replace(street, r"^\s+|\s+$", "")
    found = [F.when(F.length(street) > 5, street)]
    for word in landmarks:
        hit = F.regexp_extract(text, rf"{word}\S*(?:\s+\S+){{0,3}}", 0)
        hit = F.regexp_replace(F.regexp_replace(hit, r"\s+", " "), r"[^a-z0-9\s]", "")
        found.append(F.when(F.length(F.trim(hit)) > 4, F.trim(hit)))
    sub = F.trim(F.regexp_extract(text, words(subdistricts, 2), 0))
    found.append(F.when(sub != "", sub))
    return F.concat(F.coalesce(*found), F.lit(", " + suffix))
