"""Text helpers for keys, slugs, dates and suffixes (native Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.lenient import short_key  # noqa: F401  (C1 lives with the key readers)
from quire.functions.scripts import romanise
from quire.functions.translit import ONE_TO_MANY, ONE_TO_ONE

# Fixed values ---------------------------------------------------------------
SLUG_MAX_CHARS = 100      # slugs are clamped to this many characters
MAX_TITLE_CHARS = 1000    # works.title is clamped to this many characters
YEAR_MIN, YEAR_MAX = 1000, 2100   # plausible years in free-form dates
_YEAR = "(?<![0-9])(1[0-9]{3}|20[0-9]{2}|2100)(?![0-9])"   # a run of digits that is one of them
SUFFIX_SEPARATOR = "--"   # `base--N`; natural slugs never contain it
# -----------------------------------------------------------------------------

_FROM = "".join(ONE_TO_ONE)
_TO = "".join(ONE_TO_ONE.values())
_NOT_ASCII = r"[^\x00-\x7F]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def transliterate(c) -> Column:
    """ASCII romanisation of lowercase text; pure-ASCII strings skip the work."""
    c = _col(c)

    def listed(out: Column) -> Column:
        if_ascii = out
        for src, dst in ONE_TO_MANY.items():
            out = F.replace(out, F.lit(src), F.lit(dst))
        out = F.translate(out, _FROM, _TO)
        out = F.regexp_replace(out, r"\p{M}+", "")
        return F.when(if_ascii.rlike(_NOT_ASCII), out).otherwise(if_ascii)

    # Romanised before marks are dropped: vowel signs are marks.  An array of one, so that it is done once; what
    # is ASCII by then needs none of the many passes over the text.
    out = F.get(F.transform(F.array(romanise(c)), listed), 0)
    return F.when(c.rlike(_NOT_ASCII), out).otherwise(c)


def slugify(c, max_chars: int = SLUG_MAX_CHARS) -> Column:
    """Transliterate, lowercase, one ``-`` per run of non-alphanumerics, clamp.

    No leading or trailing ``-``; the clamp can expose a trailing ``-`` which is
    trimmed again.  An input with nothing alphanumeric gives the empty string.
    """
    s = transliterate(F.lower(_col(c)))
    s = F.regexp_replace(s, "[^a-z0-9]+", "-")
    s = F.ltrim(s, F.lit("-"))
    s = F.substring(s, 1, max_chars)
    return F.rtrim(s, F.lit("-"))


def clamp_chars(c, n: int = MAX_TITLE_CHARS) -> Column:
    """First ``n`` characters (code points)."""
    return F.substring(_col(c), 1, n)


def extract_year(c) -> Column:
    """C4: first run of exactly four ASCII digits whose value is in 1000..2100."""
    return F.nullif(F.regexp_extract(_col(c), _YEAR, 1), F.lit("")).cast("int")


def base_slug(text, key) -> Column:
    """Slug of the text, or the lowercased natural key when nothing survives."""
    return F.coalesce(F.nullif(slugify(text), F.lit("")), F.lower(_col(key)))


def edition_base_slug(isbn13, isbn10, title, key) -> Column:
    """``{isbn13|isbn10} {title}`` slugged; each half degrades, then the key."""
    text = F.concat_ws(" ", F.coalesce(_col(isbn13), _col(isbn10)), _col(title))
    return base_slug(text, key)


def split_slug(slug) -> tuple[Column, Column]:
    """C9 parse: (base, n) of a stored slug; ``base`` counts as 1, ``base--N`` as N."""
    slug = _col(slug)
    pattern = f"{SUFFIX_SEPARATOR}([0-9]+)$"
    base = F.regexp_replace(slug, pattern, "")
    n = F.when(slug == base, F.lit(1).cast("bigint")).otherwise(
        F.regexp_extract(slug, pattern, 1).try_cast("bigint"))
    return base, n


def compose_slug(base, n) -> Column:
    """C9 compose: ``base`` for the first, ``base--N`` after."""
    base, n = _col(base), _col(n)
    return F.when(n == 1, base).otherwise(F.concat(base, F.lit(SUFFIX_SEPARATOR), n.cast("string")))


def run_timestamp(run_ts) -> Column:
    """C11: the one run instant stamped on every row, as a zone-less timestamp."""
    return F.lit(str(run_ts)).cast("timestamp_ntz")
