"""Transliteration to ASCII for slugs, built from a rule plus short fixed lists.

The rule: a character maps to the ASCII letters/digits left after Unicode NFKD
decomposition, dropping combining marks (``é`` -> ``e``, ``ﬁ`` -> ``fi``).  Letters that
do not decompose (Latin extras, Cyrillic, Greek) come from the fixed lists below.
Characters with no mapping are left alone; slugify turns them into separators.

Slug text is lowercased before transliteration, so only lowercase forms matter.
The table is split into one-to-one pairs (one ``translate``) and one-to-many pairs
(a chain of ``replace`` calls that runs first).
"""

from __future__ import annotations

import unicodedata

# Fixed values ---------------------------------------------------------------
# Latin letters without a decomposition.
LATIN_EXTRA = {
    "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th",
    "ħ": "h", "ı": "i", "ĸ": "q", "ŋ": "ng", "ŧ": "t", "ƀ": "b", "ƒ": "f", "ə": "e",
    "ǝ": "e", "ɛ": "e", "ɔ": "o",
}
# Cyrillic (Russian, then Ukrainian/Belarusian/Serbian/Macedonian letters).
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "io", "ж": "zh",
    "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o",
    "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts",
    "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "'", "ы": "y", "ь": "'", "э": "e", "ю": "iu",
    "я": "ia",
    "є": "ie", "і": "i", "ї": "i", "ґ": "g", "ў": "u", "ђ": "d", "ј": "j", "љ": "lj",
    "њ": "nj", "ћ": "c", "џ": "dz", "ѕ": "dz", "ѓ": "g", "ќ": "k",
}
# Greek.
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th",
    "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "ks", "ο": "o", "π": "p",
    "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps",
    "ω": "o",
}
# Code point ranges scanned by the decomposition rule.
_RANGES = [
    (0x00A0, 0x052F),  # Latin-1 supplement, Latin extended A/B, IPA, Greek, Cyrillic
    (0x1E00, 0x1FFF),  # Latin extended additional (Vietnamese), Greek extended
    (0x2070, 0x209F),  # super- and subscripts
    (0xFB00, 0xFB06),  # Latin ligatures
    (0xFF10, 0xFF5A),  # fullwidth digits and letters
]
# -----------------------------------------------------------------------------

_FIXED = {**LATIN_EXTRA, **CYRILLIC, **GREEK}


def _romanise(ch: str) -> str | None:
    base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)).lower()
    if not base:
        return None
    out = "".join(_FIXED.get(c, c) for c in base)
    if out == ch or not all(c.isascii() for c in out):
        return None
    return out


def build_table() -> tuple[dict[str, str], dict[str, str]]:
    """Return (one_to_one, one_to_many) maps for lowercase input."""
    table: dict[str, str] = {}
    for lo, hi in _RANGES:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            if ch.lower() != ch:  # input is lowercased first
                continue
            out = _romanise(ch)
            if out is not None:
                table[ch] = out
    table.update(_FIXED)
    one = {k: v for k, v in table.items() if len(v) == 1}
    many = {k: v for k, v in table.items() if len(v) != 1}
    return one, many


ONE_TO_ONE, ONE_TO_MANY = build_table()
