"""Romanisation of scripts that need more than one letter at a time, as native expressions.

A text is cut into tokens by longest match: a kana with the marks that change its sound, a
consonant of an Indic script with its vowel sign, or one character.  Each token is then spelled by rule:

* Hangul: a syllable's place in Unicode gives its initial, vowel and final;
* kana: one table of sounds; a small ``tsu`` doubles what follows, small ``ya yu yo`` and small
  vowels replace the vowel before them, katakana are read as hiragana;
* nine Indic scripts share one layout, so one table of sounds serves all; a consonant has the
  vowel ``a`` unless a sign follows that is another vowel or the absence of one;
* alphabets with a block of their own (Armenian, Georgian, Hebrew, Arabic): the letter's place in it.

Texts without such letters are not cut.  Input is lowercase.  Marks and letters without a sound
(a glottal stop, a lengthening mark) vanish; what is not known (Han, Thai) stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sounds in the order of Unicode; ``-`` is none. ----------------------
HANGUL_INITIALS = "g gg n d dd r m b bb s ss - j jj c k t p h"
HANGUL_VOWELS = "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i"
HANGUL_FINALS = "- g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h"
# U+3041 .. U+3096, small letters as large ones.
KANA = ("a a i i u u e e o o ka ga ki gi ku gu ke ge ko go sa za shi ji su zu se ze so zo ta da chi ji - tsu zu te de to do "
        "na ni nu ne no ha ba pa hi bi pi fu bu pu he be pe ho bo po ma mi mu me mo ya ya yu yu yo yo ra ri ru re ro "
        "wa wa i e o n vu ka ke")
# Offsets in an Indic block: 01-14 signs and vowels, 15-39 consonants, 3E-4C vowel signs.
INDIC_VOWELS = "n m h - a aa i ii u uu ri li e e e ai o o o au"
INDIC_CONSONANTS = ("k kh g gh ng ch chh j jh ny t th d dh n t th d dh n n p ph b bh m y r r l l zh v sh sh s h")
INDIC_SIGNS = "aa i ii u uu ri ri e e e ai o o o au"
# U+0561 .. U+0587, U+10D0 .. U+10F0, U+05D0 .. U+05EA.
ARMENIAN = "a b g d e z e y t zh i l kh ts k h dz gh ch m y n sh o ch p j r s v t r ts w p k o f ev"
GEORGIAN = "a b g d e v z t i k l m n o p zh r s t u p k gh q sh ch ts dz ts ch kh j h"
HEBREW = "- b g d h v z kh t y k k l m m n n s - p p ts ts q r sh t"
# U+0621 .. U+0652: letters, a gap, the lengthening mark, letters, vowel marks.
ARABIC = ("- a a w i y a b a t th j h kh d dh r z s sh s d t z - gh - - - - - - f q k l m n h w a y an un in a u i - -")
# -----------------------------------------------------------------------------

INDIC_FIRST, INDIC_LAST, INDIC_BLOCK = 0x0900, 0x0D7F, 0x80
_BLOCKS = tuple(range(INDIC_FIRST, INDIC_LAST, INDIC_BLOCK))


def _sounds(text: str) -> list[str]:
    return ["" if x == "-" else x for x in text.split()]


#: Alphabets by the code point of their first letter.
ALPHABETS = {0x0561: _sounds(ARMENIAN), 0x10D0: _sounds(GEORGIAN), 0x05D0: _sounds(HEBREW), 0x0621: _sounds(ARABIC)}


def _span(first: int, last: int) -> str:
    return f"{chr(first)}-{chr(last)}"


def _indic(first: int, last: int) -> str:
    return "".join(_span(b + first, b + last) for b in _BLOCKS)


_SMALL_Y, _SMALL_VOWELS, _TSU = "ゃゅょャュョ", "ぁぃぅぇぉァィゥェォ", "っッ"
#: A class of two ranges without a few letters: one of single letters is tried letter by letter.
_BASE = rf"{_span(0x3041, 0x3096)}{_span(0x30A1, 0x30F6)}&&[^{_SMALL_Y}{_SMALL_VOWELS}{_TSU}]"
#: What may be read together with a neighbour, and the tokens, longest first.
JOINED = f"[{_span(INDIC_FIRST, INDIC_LAST)}{_span(0x3041, 0x30FC)}]"
TOKEN = (rf"(?!{JOINED})(?s:.)|[{_indic(0x15, 0x39)}][{_indic(0x3C, 0x3C)}]?[{_indic(0x3E, 0x4D)}]?"
         rf"|[{_TSU}]?[{_BASE}][{_SMALL_Y}{_SMALL_VOWELS}]?|(?s:.)")
#: What makes a text worth cutting.
LETTERS = "[" + "".join(_span(a, a + len(v) - 1) for a, v in ALPHABETS.items()) + \
    _span(INDIC_FIRST, INDIC_LAST) + _span(0x3041, 0x30FC) + _span(0xAC00, 0xD7A3) + "]"


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _of(values: list[str], at: Column) -> Column:
    return F.element_at(_array(values), (at + 1).cast("int"))


def _kana_sound(letter: Column) -> Column:
    code = F.ascii(letter)
    return _of(_sounds(KANA), F.when(code >= 0x30A1, code - 0x60).otherwise(code) - 0x3041)


def _kana(token: Column) -> Column:
    doubled = token.rlike(f"^[{_TSU}].")
    body = F.when(doubled, F.substr(token, F.lit(2))).otherwise(token)
    first, small = _kana_sound(F.left(body, F.lit(1))), F.substr(body, F.lit(2))
    sound = F.when(F.length(small) > 0, _kana_sound(small)).otherwise("")
    stem = F.left(first, F.length(first) - 1)
    changed = (F.when(small == "", first)
               # small ya, yu, yo after i; the y is heard unless the sound has it already
               .when(small.rlike(f"[{_SMALL_Y}]") & first.endswith("i"),
                     F.concat(stem, F.when(stem.isin("sh", "ch", "j"), F.substr(sound, F.lit(2))).otherwise(sound)))
               .when(small.rlike(f"[{_SMALL_Y}]"), F.concat(first, sound))
               .otherwise(F.concat(F.when(first == "u", "w").otherwise(stem), sound)))
    again = F.when(changed.startswith("ch"), "t").when(changed.rlike("^[bdfghjkmprstwyz]"), F.left(changed, F.lit(1))).otherwise("")
    return F.when(doubled, F.concat(again, changed)).otherwise(changed)


def _indic_sound(token: Column, code: Column) -> Column:
    offset = code % INDIC_BLOCK
    sign = F.ascii(F.right(token, F.lit(1))) % INDIC_BLOCK
    vowel = F.when((F.length(token) == 1) | (sign == 0x3C), "a").when(sign == 0x4D, "").otherwise(_of(_sounds(INDIC_SIGNS), F.greatest(sign - 0x3E, F.lit(0))))
    return (F.when(offset.between(0x15, 0x39), F.concat(_of(_sounds(INDIC_CONSONANTS), offset - 0x15), vowel))
            .when(offset.between(0x01, 0x14), _of(_sounds(INDIC_VOWELS), offset - 1))
            .when(offset.between(0x66, 0x6F), (offset - 0x66).cast("string")).otherwise(""))


def spelling(code: int) -> str | None:
    """The rules above for a letter that stands alone; None for one that stays as it is."""
    if 0xAC00 <= code <= 0xD7A3:
        at = code - 0xAC00
        return (_sounds(HANGUL_INITIALS)[at // 588] + _sounds(HANGUL_VOWELS)[at % 588 // 28] + _sounds(HANGUL_FINALS)[at % 28])
    if 0x3041 <= code <= 0x3096 or 0x30A1 <= code <= 0x30F6:
        return _sounds(KANA)[code - (0x60 if code >= 0x30A1 else 0) - 0x3041]
    if code == 0x30FC:
        return ""
    if INDIC_FIRST <= code <= INDIC_LAST:
        offset = code % INDIC_BLOCK
        if 0x15 <= offset <= 0x39:
            return _sounds(INDIC_CONSONANTS)[offset - 0x15] + "a"
        if 0x01 <= offset <= 0x14:
            return _sounds(INDIC_VOWELS)[offset - 1]
        return str(offset - 0x66) if 0x66 <= offset <= 0x6F else ""
    for first, sounds in ALPHABETS.items():
        if first <= code < first + len(sounds):
            return sounds[code - first]
    return None


#: Letters that stand alone are looked up by code point.
_ALONE = ((0x0561, 0x30FC), (0xAC00, 0xD7A3))


def _alone(token: Column) -> Column:
    def found(first: int, last: int) -> Column:
        # One literal, which the optimizer splits once; no entry holds a comma.
        entries = ",".join(chr(c) if (x := spelling(c)) is None else x for c in range(first, last + 1))
        return F.get(F.split(F.lit(entries), ","), F.ascii(token) - first)
    return F.coalesce(*[found(*span) for span in _ALONE], token)


def romanise(text: Column) -> Column:
    """ASCII spellings for the letters of the scripts above; everything else stays."""
    def spelled(token: Column) -> Column:
        code = F.ascii(token)
        kana = code.between(0x3041, 0x3096) | code.between(0x30A1, 0x30F6)
        return F.when(F.length(token) == 1, _alone(token)).when(kana, _kana(token)).otherwise(_indic_sound(token, code))

    cut = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return (F.when(text.rlike(JOINED), F.array_join(F.transform(cut, spelled), ""))
            .when(text.rlike(LETTERS), F.array_join(F.transform(F.split(text, ""), _alone), "")).otherwise(text))
