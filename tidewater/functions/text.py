"""String functions: casing rules, templates, signatures, path pieces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


# Fixed value: the default word delimiters of the warehouse INITCAP function
# (whitespace plus these characters).
INITCAP_DELIMITERS = " []{}()/|\\<>!?@\"^#$&~_,.:;*%+-"


def _capitalise_after(s: Column, boundary_regex: str) -> Column:
    # Split before every character that follows a boundary character
    # (zero-width look-behind), upper-case the first character of each piece.
    pieces = F.split(s, boundary_regex)
    fixed = F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                   F.substring(w, 2, 1 << 30)))
    return F.array_join(fixed, "")


def initcap_sql(c) -> Column:
    """FN-13: warehouse INITCAP: lower-case everything, upper-case the first
    character and every character after a delimiter (whitespace and
    ``INITCAP_DELIMITERS``; the apostrophe is *not* a delimiter).  Spark's
    own ``initcap`` only splits on blanks."""
    esc = "".join("\\" + ch if ch in "[]\\^-" else ch for ch in INITCAP_DELIMITERS)
    return _capitalise_after(F.lower(_c(c)), f"(?<=[\\s{esc}])")


# Letters that became cased after Unicode 13, in case the JVM's
# classes are older.
_NEWER_CASED = "ჼⰯⱟꟀꟁꟐꟑꟓꟕꟖꟗꟘꟙꟲꟳꟴꭩ"
_CASED = "[\\p{IsUppercase}\\p{IsLowercase}\\p{Lt}" + _NEWER_CASED + "]"


def _title_any(s: Column) -> Column:
    """``title_python`` character by character.  Each one goes with the one
    before it and with its form in the lower-cased whole (where a sigma depends
    on its surroundings).  Only ``İ`` has two characters in lower case; it is
    kept apart, so that the three arrays run alike."""
    low = F.split(F.lower(F.translate(s, "İ", "I")), "")
    trios = F.arrays_zip(F.split(s, "").alias("at"), F.split(F.concat(F.lit(" "), s), "").alias("before"), low.alias("low"))
    # initcap of one character is its title form (ŉ -> ʼN, ǆ -> ǅ, ß -> Ss);
    # the array of the characters before is one longer, its last trio is null
    return F.array_join(F.transform(trios, lambda t: F.when(~t["before"].rlike(_CASED), F.initcap(t["at"]))
                                    .when(t["at"] == "İ", F.lit("i\u0307")).otherwise(t["low"])), "")


def title_python(c) -> Column:
    """FN-14: Python ``str.title()``: a letter takes its title form when the
    previous character is not a cased one (Unicode's derived classes), every
    other letter is lower-cased (``o'neil`` -> ``O'Neil``, ``a1b`` -> ``A1B``).
    ASCII text is handled by words, other text by characters."""
    s = _c(c)
    return F.when(s.rlike(r"^\p{ASCII}*$"), _capitalise_after(F.lower(s), "(?<![A-Za-z])")).otherwise(_title_any(s))


def lower(c) -> Column:
    """FN-15."""
    return F.lower(_c(c))


def sha256_prefix(c, n: int = 12) -> Column:
    """FN-19: first ``n`` hex digits of SHA-256 of the UTF-8 text."""
    return F.substring(F.sha2(_c(c), 256), 1, n)


def greeting(name) -> Column:
    """FN-20: ``Hello, {name}!``."""
    return F.concat(F.lit("Hello, "), _c(name), F.lit("!"))


def basename(path) -> Column:
    """FN-23: last path segment."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def strip_json_suffix(name) -> Column:
    """FN-23: ``str.replace('.json', '')`` (every occurrence)."""
    return F.replace(_c(name), F.lit(".json"), F.lit(""))


def rstrip_slash(path) -> Column:
    """FN-23: ``str.rstrip('/')``."""
    return F.regexp_replace(_c(path), "/+$", "")
