"""Text-to-key and text-to-number column functions (F-01, F-02, F-03, F-05, H-11, V-08).

All are native Catalyst expressions so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from menulake.functions._util import col_of

# Patterns that must equal the reference's parsing rules.
NUMBER_PATTERN = r"([0-9]+\.?[0-9]*)"   # first run of digits with an optional fraction
UNIT_PATTERN = r"([a-zA-Z]+)"           # first run of ASCII letters
AMOUNT_STRIP_CHARS = ",<>"              # characters dropped before reading an amount
NON_WORD_RUN = r"[^\p{L}\p{N}]+"        # one underscore per run of non letters/digits
UNICODE_SPACE = r"(?U)^\s+|\s+$"        # Python str.strip() also strips tabs and newlines


def strip_ws(c) -> Column:
    """Trim every Unicode whitespace char at both ends (Spark ``trim`` trims spaces only)."""
    return F.regexp_replace(col_of(c), UNICODE_SPACE, "")


def snake_case(c) -> Column:
    """F-01: lower, runs of non letters/digits -> one ``_``, no ``_`` at the ends."""
    lowered = F.lower(strip_ws(c))
    return F.btrim(F.regexp_replace(lowered, NON_WORD_RUN, "_"), F.lit("_"))


def _first_number(text: Column) -> Column:
    # no match gives '', which try_cast turns into null
    return F.regexp_extract(text, NUMBER_PATTERN, 1)


def parse_amount(c) -> Column:
    """F-02: drop ``, < >``, read the first unsigned number; null when none.

    ``1,200 mg`` -> 1200.0, ``<1g`` -> 1.0, ``.5g`` -> 5.0, ``-5g`` -> 5.0.
    """
    cleaned = F.translate(col_of(c), AMOUNT_STRIP_CHARS, "")
    return _first_number(cleaned).try_cast("double")


def amount_or_zero(c) -> Column:
    """F-03: the second dialect. No comma removal, null or no number -> 0.0.

    ``1,200`` -> 1.0 (the reading stops at the comma).
    """
    return F.coalesce(_first_number(col_of(c).cast("string")).try_cast("double"), F.lit(0.0))


def parse_unit(c) -> Column:
    """F-05: first run of ASCII letters, lowered; null when none."""
    return F.nullif(F.lower(F.regexp_extract(col_of(c), UNIT_PATTERN, 1)), F.lit(""))


def _without_dots(path: Column, joined: bool) -> Column:
    """A path (from its first ``/``) with ``.`` and ``..`` resolved; a joined one loses empty segments."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    segments = F.concat(F.array(F.lit("")), F.filter(F.slice(parts, 1, F.size(parts) - 1), lambda s: s != ""), F.array(last)) if joined else parts
    up = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done).otherwise(F.concat(done, F.array(s))))
    text = F.array_join(F.when(last.isin(".", ".."), F.concat(up, F.array(F.lit("")))).otherwise(up), "/")
    out = F.when(text.startswith("/"), text).otherwise(F.concat(F.lit("/"), text))
    # most links have nothing to resolve, and never come here
    return F.when(path.rlike(r"/\.{1,2}(/|$)|//"), out).otherwise(path)


def resolve_url(href, base) -> Column:
    """H-11: absolute link for ``href`` seen on a page whose base is ``base``.

    ``base`` is a site or page url (text or Column). Absolute links pass,
    ``//host`` takes the base scheme, ``/path`` takes the base origin, an empty
    link is the base itself, ``?query`` and ``#part`` stay on the base's page,
    anything else replaces the last path segment. Dot segments are resolved.
    """
    h = col_of(href)
    b = F.lit(base) if isinstance(base, str) else base
    scheme = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1)
    origin = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    path = F.regexp_replace(F.substring(b, F.length(origin) + 1, F.length(b)), r"[?#].*$", "")
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    own, rest = F.regexp_extract(h, r"^([^?#]*)", 1), F.regexp_extract(h, r"^[^?#]*((?s:.*))$", 1)
    return (
        F.when(h.isNull(), F.lit(None).cast("string"))
        .when(h == "", b)
        .when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("?"), F.concat(origin, path, h))
        .when(h.startswith("#"), F.concat(F.regexp_replace(b, r"#.*$", ""), h))
        .when(h.startswith("/"), F.concat(origin, _without_dots(own, False), rest))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, own), True), rest))
    )


def check_url(c) -> Column:
    """V-08: true for http/https links and for null; false otherwise."""
    u = col_of(c)
    return F.when(u.isNull(), F.lit(True)).otherwise(u.rlike(r"^https?://[^\s/]+"))
