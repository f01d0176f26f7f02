"""Surrogates for personal data.

Personal data are found by patterns; every entity is replaced by a surrogate that depends
only on a secret key and the entity, so one entity reads the same everywhere (also when it
is written in another format), and that keeps its kind: e-mail addresses keep their shape
and share surrogate domains, numbers keep their grouping, card numbers their check digit,
secrets their length and case, names their script and the gender that the titles tell.  A name is
keyed by itself, whatever its titles, and is also replaced without one in a text that has it with one.

Surrogates are checked over all entities of the table, names of all genders together and also
domains: where two would share one, or one equals a real entity, a counter is raised until all
differ.  Names, e-mail addresses and domains get longer with the counter, so their surrogates never
run out; those of numbers keep their length, and only their first digits are let go.  (Domains and genders so depend on the other entities where those collide or disagree.)

Defined cases: a null text stays null; empty texts and texts without personal data stay as
they are; texts of any length are searched whole; copies get equal replacements; repeated
rows, null keys, other columns and empty tables pass through.  All columns are kept, whatever
their names.  Everything is DataFrame operations.
"""

from __future__ import annotations

import functools
import hashlib
import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import sized, table, written

KEY_SETTING = "spark.quire.surrogate.key"     # names the secret; without it every application draws its own
ROUNDS = 50         # times that colliding surrogates are made anew, at most
LONGER = 3          # after so many times each, a surrogate gets one more character or syllable
LETTERS = r"\p{Lu}\p{Ll}\p{Lt}\p{Lm}\p{M}"      # of scripts with upper and lower case

# Titles by the gender that they tell, name parts by script and gender.
TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Madam", "Fräulein",
               "Señorita", "Srta", "Dra", "Госпожа", "Г-жа", "Κυρία"],
          "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Mister", "Господин", "Г-н", "Κύριος"],
          "n": ["Dr", "Prof", "Doctor", "Doktor", "Professor"]}
STARTS = {"latin": ["Al", "Bel", "Cor", "Dan", "El", "Fer", "Gal", "Hal", "Il", "Jon", "Kar", "Lor", "Mar", "Nor", "Os",
                    "Per", "Quin", "Ros", "Sal", "Tor", "Ul", "Ver", "Wil", "Yor", "Zan"],
          "cyrillic": ["Ал", "Бел", "Вер", "Гал", "Дар", "Ел", "Жан", "Зор", "Ил", "Кир", "Лар", "Мар", "Нор", "Ол", "Пав",
                       "Рад", "Сав", "Тим", "Ул", "Фед"],
          "greek": ["Αλ", "Βασ", "Γαλ", "Δαρ", "Ελ", "Ζην", "Ηλ", "Θαν", "Ιλ", "Καλ", "Λαμ", "Μαρ", "Νικ", "Ορ", "Παν",
                    "Ροδ", "Σαβ", "Τιμ", "Φιλ", "Χαρ"],
          "han": list("王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗"), "kana": list("アイウエオカキクケコサシスセソタチツテト"),
          "hangul": list("김이박최정강조윤장임한오서신권황안송류전"), "arabic": list("بتجحدرسصطعفقكلمنهوي"),
          "hebrew": list("אבגדהוזחטיכלמנסעפצקרשת")}
MIDDLES = {"latin": ["a", "e", "i", "o", "u", "ani", "eri", "ima", "olo", "uve", "ari", "ene", "ito", "oda", "ula", "ami"],
           "cyrillic": ["а", "е", "и", "о", "у", "ани", "ери", "има", "оло", "уве", "ари", "ене", "ито", "ода", "ула", "ами"],
           "greek": ["α", "ε", "ι", "ο", "υ", "ανι", "ερι", "ιμα", "ολο", "υβε", "αρι", "ενε", "ιτο", "οδα", "υλα", "αμι"],
           "han": list("文明建国志永春海东山石云江平"), "kana": list("ナニヌネノハヒフヘホマミムメモ"),
           "hangul": list("가나다라마바사아자하도로모보"), "arabic": ["ا", "و", "ي", "ار", "ون", "يم", "ال", "اد"],
           "hebrew": ["א", "ו", "י", "אר", "ון", "ים", "אל", "עד"]}
ENDS = {"latin": {"f": ["na", "ra", "lia", "da", "sa"], "m": ["n", "r", "rd", "s", "ld"], "n": ["l", "n", "t", "m", "k"]},
        "cyrillic": {"f": ["на", "ра", "лия", "да", "са"], "m": ["н", "р", "рд", "с", "лд"], "n": ["л", "н", "т", "м", "к"]},
        "greek": {"f": ["να", "ρα", "λια", "δα", "σα"], "m": ["νος", "ρος", "δης", "σος", "λης"], "n": ["ν", "ρ", "λι", "τι", "κι"]},
        "han": {"f": list("芳娜丽英华"), "m": list("强军伟刚勇"), "n": list("宁安然乐清")},
        "kana": {"f": list("ヤユヨラリ"), "m": list("ルレロワン"), "n": list("ガギグゲゴ")},
        "hangul": {"f": list("미희숙영자"), "m": list("철호석준식"), "n": list("진현수민우")},
        "arabic": {"f": ["ة", "اء", "ية", "ى", "ات"], "m": ["ن", "ر", "د", "س", "ل"], "n": ["م", "ب", "ت", "ف", "ق"]},
        "hebrew": {"f": ["ה", "ית", "לה", "נה", "רה"], "m": ["ן", "ר", "ד", "ם", "ל"], "n": ["ב", "ת", "ק", "ש", "ט"]}}
#: The script of a name by its letters, in this order; names in any other get Latin surrogates.
SCRIPTS = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}", "kana": r"^[\p{IsHiragana}\p{IsKatakana}ー]", "han": r"\p{IsHan}",
           "hangul": r"\p{IsHangul}", "arabic": r"\p{IsArabic}", "hebrew": r"\p{IsHebrew}"}

_TITLE = "|".join(t for group in TITLES.values() for t in group)
_ONE = rf"(?:{_TITLE})\.?[ \u00a0]"
#: Repeats without a limit are possessive: Java's others recurse, once a repeat.
_TITLED = rf"(?:{_ONE})++"
_WORD = rf"\p{{Lu}}[{LETTERS}]*(?:['’]\p{{Lu}}[{LETTERS}]+|[{LETTERS}])"     # O'Brien, and Berg of Berg's
_INITIALS = r"(?:(?:\p{Lu}\.){1,4}[ \u00a0]?|\p{Lu}[ \u00a0](?=\p{Lu}))"
_PARTICLE = r"(?:(?:von|van|de|der|den|del|della|di|da|dos|du|la|le|zu|zur|ten|ter|bin|ibn|al|el)[ \u00a0]|al-|el-|[dl]['’])"
_PART = rf"{_INITIALS}{{0,3}}{_PARTICLE}{{0,2}}{_WORD}"
#: Scripts without case: so many characters where words are not spaced, otherwise one word.
_CASELESS = (r"(?:\p{IsHan}{1,4}|\p{IsHangul}{2,4}|[\p{IsHiragana}\p{IsKatakana}ー]{1,8}"
             r"|(?:(?![\p{IsHan}\p{IsHangul}\p{IsHiragana}\p{IsKatakana}])\p{Lo}\p{M}*+){2,}+)")
#: Titles in a row are one mention, tried at the first of them only.
NAME = (rf"(?<![\p{{L}}\p{{N}}])(?={_ONE})(?<!(?<![\p{{L}}\p{{N}}]){_ONE}){_TITLED}"
        rf"(?:{_PART}(?:[ \u00a0-]{_PART}){{0,3}}|{_CASELESS}|(?:\p{{Lu}}\.){{1,4}})")
#: What marks the keys of well-known services; their other characters are exchanged.
_MARK = (r"(?:gh[pousr]_|github_pat_|glpat-|hf_|npm_|xox[abeprs]-|AIza|ASIA|eyJ|sk-(?:[a-z]{2,8}-){0,2}"
         r"|[rsp]k_(?:live|test)_)")
KEYS = (r"(?:(?:gh[pousr]_|hf_|npm_|[rsp]k_(?:live|test)_)[A-Za-z0-9]{16,}+|github_pat_[A-Za-z0-9_]{20,}+|glpat-[A-Za-z0-9_-]{16,}+"
        r"|xox[abeprs]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{35}|ASIA[0-9A-Z]{16}|sk-(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{16,}+"
        r"|eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)")
_HEX = "[0-9A-Fa-f]{1,4}"
#: Eight groups, or some groups and ``::`` with a digit anywhere (without one it may be program text).
IPV6 = (rf"(?<![\p{{L}}\p{{N}}:.])(?:(?:{_HEX}:){{7}}{_HEX}"
        rf"|(?=[A-Fa-f:]*[0-9]){_HEX}(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\p{{L}}\p{{N}}:])")
#: With a country's code or an area in brackets; without either, dashes or groups of 3, 3 and 4 (other numbers
#: in groups are amounts and sizes).
_PLAIN = (r"(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}"
          r"|\([0-9]{2,4}\) ?[0-9]{3,4}[ .-][0-9]{3,4}|(?<![0-9][ .,-])(?:[0-9]{2,4}-[0-9]{3,4}-[0-9]{3,4}"
          r"|[0-9]{3}[ .][0-9]{3}[ .][0-9]{4})(?![ .,-]?[0-9]))(?![0-9])")
#: Calling codes of one and two digits (fixed values); all others have three.
COUNTRY = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
_GAP = r"(?:[ ./-]|[ .-]?\(|\)[ .-]?)?"
#: +E.164, 00 before a country's number, and national numbers after 0 in two groups or more (dates are not).
PHONE = (rf"(?<![\p{{N}}+])(?:{_PLAIN}|\+[1-9](?:{_GAP}[0-9]){{7,14}}(?![0-9])"
         rf"|(?<![\p{{L}}.,:/-])(?:00[1-9](?:{_GAP}[0-9]){{8,13}}"
         r"|(?![0-3]?[0-9][./-][01]?[0-9][./-][0-9]{4})(?=[0-9]{2,5}[ ./-])0[1-9](?:[ ./-]?[0-9]){7,10}"
         r"|\(0[0-9]{1,4}\) ?[0-9](?:[ ./-]?[0-9]){4,9})(?![0-9]))")
#: Patterns by kind, tried in this order at every place.
PATTERNS = {
    # No real domain has over 127 labels; longer chains are taken to their end.
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:(?=[\p{L}\p{N}.-]*\.\p{L}{2})(?:[\p{L}\p{N}-]++\.){127}+[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)*+"
             r"|(?:[\p{L}\p{N}-]++\.){1,127}\p{L}{2,})",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|AKIA[0-9A-Z]{16})(?![\p{L}\p{N}])",
    "key": rf"(?<![\p{{L}}\p{{N}}]){KEYS}(?![\p{{L}}\p{{N}}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9])",
    "ipv6": IPV6,
    "ssn": r"(?<![\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{N}-])",
    "card": r"(?<![\p{N}+])(?:[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}|3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5}"
            r"|3[0689][0-9]{2}[ -][0-9]{6}[ -][0-9]{4})(?![0-9])",
    "phone": PHONE,
    "name": NAME,
}
_NUMBERS = ("ip", "ssn", "card", "phone")
#: All kinds at once.  Most places of a text are inside a word, where no kind starts but those of numbers.
ANY = (r"(?<![\p{L}\p{N}])(?:" + "|".join(p for k, p in PATTERNS.items() if k not in _NUMBERS) + ")"
       r"|(?=[0-9+(])(?:" + "|".join(PATTERNS[k] for k in _NUMBERS) + ")")


def kind_of(mention: Column) -> Column:
    """The kind of a mention that the joint pattern found (the first that matches all of it)."""
    return F.coalesce(*[F.when(mention.rlike(rf"^(?:{p})$"), k) for k, p in PATTERNS.items()], F.lit("name"))


def _hash(seed: Column, at, n) -> Column:
    return F.pmod(F.xxhash64(seed, at), n)


def _pick(seed: Column, at, values: str) -> Column:
    return F.substring(F.lit(values), _hash(seed, at, F.lit(len(values))).cast("int") + 1, F.lit(1))


def _each(text: Column, change) -> Column:
    """A text with every character replaced by ``change(character, place)``."""
    letters = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))   # in one pass, whatever the length
    return F.when(text.isNotNull(), F.array_join(F.transform(letters, lambda c, i: change(c, i + 1)), ""))


def _shaped(text: Column, seed: Column) -> Column:
    """Other digits for digits and other letters for letters, of the same case, script and accent."""
    small = "abcdefghijklmnopqrstuvwxyz"
    return _each(text, lambda c, i: F.when(c.rlike("[0-9]"), _pick(seed, i, "0123456789"))
                 .when(c.rlike("[a-z]"), _pick(seed, i, small)).when(c.rlike("[A-Z]"), _pick(seed, i, small.upper()))
                 .when(c.rlike(r"\p{IsCyrillic}"), _pick(seed, i, "абвгдежзиклмнопрстуфхцчшэюя"))
                 .when(c.rlike(r"\p{IsGreek}"), _pick(seed, i, "αβγδεζηθικλμνξοπρστυφχψω"))
                 .when(c.rlike(r"\p{L}"), _pick(seed, i, "àáâäçèéêëìíîïñòóôöùúûü")).otherwise(c))


def _luhn(digits: Column) -> Column:
    """Sum of a number's digits as its check digit counts them."""
    worth = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), lambda i: F.substring(
        F.when(i % 2 == 1, F.lit("0246813579")).otherwise(F.lit("0123456789")),
        F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") + 1, F.lit(1)))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x.cast("int"))


def _by(column: Column, values: dict) -> Column:
    """The array of values of the key that a column holds."""
    return F.coalesce(*[F.when(column == k, F.array(*map(F.lit, v))) for k, v in values.items()])


def family(kind: Column) -> Column:
    """What entities are told apart within: names of all genders are one family."""
    return F.regexp_replace(kind, "-.*", "")


def with_surrogate(rows: DataFrame, key: str) -> DataFrame:
    """Add ``made``, the n-th surrogate of rows (kind, value, domain, n), in steps of a few columns;
    ``domain`` is the surrogate of an e-mail address's domain."""
    c, kept = F.col, rows.columns
    seeded = rows.withColumns({
        "seed": F.sha2(F.concat_ws("\x1f", F.lit(key), family(c("kind")), "value", c("n").cast("string")).cast("binary"), 256)})
    numbers = seeded.where(c("kind").isin("card", "phone", "ssn")).withColumn("number", F.concat(
        F.when(c("n") >= LONGER, _pick(c("seed"), F.lit(0), "123456789")).when(c("kind") == "ssn", "9")
        .otherwise(F.left("value", F.lit(1))), _shaped(F.substr("value", F.lit(2)), c("seed"))))
    numbers = numbers.withColumn("body", F.concat(F.left("number", F.length("number") - 1), F.lit("0"))) \
        .withColumns({"luhn": _luhn(c("body")), "valid": (c("kind") == "card") & (_luhn(c("value")) % 10 == 0)})
    numbers = numbers.withColumn("made", F.when(
        c("valid"), F.concat(F.left("body", F.length("body") - 1), ((10 - c("luhn") % 10) % 10).cast("string")))
        .otherwise(c("number")))
    times = F.floor(c("n") / LONGER).cast("int")
    longer = lambda one: F.when(times > 0, F.array_join(F.transform(F.sequence(F.lit(1), times), one), "")).otherwise("")
    more = longer(lambda i: _pick(c("seed"), -i, "abcdefghijklmnopqrstuvwxyz"))
    octet = lambda i: _hash(c("seed"), F.lit(i), F.lit(256)).cast("string")
    others = seeded.where(~c("kind").isin("card", "phone", "ssn") & ~c("kind").startswith("name-"))
    others = others.withColumn("mark", F.regexp_extract("value", f"^{_MARK}", 0)).withColumn(
        "made", F.when(c("kind") == "email", F.concat(
            _shaped(F.substring_index("value", "@", 1), c("seed")), more, F.lit("@"), c("domain")))
        .when(c("kind") == "domain", F.concat(
            _shaped(F.regexp_replace("value", r"\.[^.]*$", ""), c("seed")), more, F.lit(".example")))
        .when(c("value").startswith("akia"), F.concat(F.lit("akia"), _shaped(F.substr("value", F.lit(5)), c("seed"))))
        .when(c("kind") == "secret", _each(c("value"), lambda x, i: _pick(c("seed"), i, "0123456789abcdef")))
        .when(c("kind") == "key", F.concat(c("mark"), _shaped(F.substr("value", F.length("mark") + 1), c("seed"))))
        .when(c("kind") == "ipv6", F.concat(F.lit("2001:db8:"), F.concat_ws(":", *[
            F.lower(F.hex(_hash(c("seed"), F.lit(i), F.lit(1 << 16)))) for i in range(6)])))
        .when(c("kind") == "iban", F.concat(F.left("value", F.lit(2)), _shaped(F.substr("value", F.lit(3)), c("seed"))))
        .otherwise(F.concat_ws(".", F.when(times > 0, octet(0)).otherwise((_hash(c("seed"), F.lit(0), F.lit(15)) + 240).cast("string")), octet(1), octet(2), octet(3))))
    script = F.coalesce(*[F.when(c("value").rlike(p), k) for k, p in SCRIPTS.items()], F.lit("latin"))
    names = seeded.where(c("kind").startswith("name-")).withColumn("script", script).withColumns({
        "starts": _by(c("script"), STARTS), "middles": _by(c("script"), MIDDLES),
        "ends": _by(F.concat_ws("-", "script", F.substr("kind", F.lit(6))),
                    {f"{s}-{g}": v for s, own in ENDS.items() for g, v in own.items()})})
    one = lambda array, at: F.element_at(array, (_hash(c("seed"), F.lit(at), F.size(array)) + 1).cast("int"))
    names = names.withColumn("made", F.concat(
        one("starts", 1), one("middles", 2), F.lower(one("starts", 3)), one("middles", 4),
        longer(lambda i: F.element_at(c("middles"), (_hash(c("seed"), -i, F.size(c("middles"))) + 1).cast("int"))), one("ends", 5)))
    return numbers.select(*kept, "made").unionByName(others.select(*kept, "made")).unionByName(names.select(*kept, "made"))


def other_initials(token: Column, key: str) -> Column:
    """Each initial moved on by one keyed number of letters: equal ones stay equal, others apart."""
    alphabets = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", "ÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜÅØ"]
    step = int(hashlib.sha256(f"{key}\x1finitial".encode()).hexdigest(), 16)
    moved = [a[k:] + a[:k] for a in alphabets for k in [step % (len(a) - 1) + 1]]
    return F.translate(token, "".join(alphabets), "".join(moved))


def national(mention: Column) -> Column:
    """The digits of a phone number without its country's code and the zeros before the area, so that
    national and international forms are one entity."""
    abroad = F.regexp_replace(F.regexp_replace(mention, r"^\+|^00", "+"), "[^0-9+]", "")
    digits = F.regexp_replace(F.when(abroad.startswith("+"), F.regexp_replace(abroad, rf"^\+(?:{COUNTRY}|[0-9]{{3}})", ""))
                              .otherwise(abroad), "^0+(?=.)", "")
    return F.when(F.length(digits) > 0, digits).otherwise(F.regexp_replace(mention, "[^0-9]", ""))


def tokens_of(mentions: DataFrame, key: str) -> DataFrame:
    """(mention, at, token, kind, value): the entities in distinct mentions; titles, initials
    (exchanged already), particles and what stands between have no kind."""
    c = F.col
    rows = mentions.withColumn("kind", kind_of(c("mention")))
    gender = F.coalesce(*[F.when(c("mention").rlike(rf"^{_TITLED}") & c("mention").rlike(rf"^(?:.*[ \u00a0])?(?:{'|'.join(TITLES[g])})\.?[ \u00a0]"),
                                 f"name-{g}") for g in TITLES])
    titles = F.regexp_extract("mention", f"^{_TITLED}", 0)
    names = rows.where("kind = 'name'").select("mention", gender.alias("kind"), F.posexplode(F.concat(F.array(titles), F.regexp_extract_all(
        F.substr("mention", F.length(titles) + 1), F.lit("(?:al|el)-|[dl]['’]|(?:\\p{Lu}\\.)+|[^ \u00a0-]+|[ \u00a0-]"), F.lit(0)))).alias("at", "token"))
    initial = c("token").rlike(r"^(?:\p{Lu}|(?:\p{Lu}\.)+)$")
    named = (c("at") > 0) & c("token").rlike(r"^[\p{Lu}\p{Lo}]") & ~initial
    names = names.select("mention", "at", F.when((c("at") > 0) & initial, other_initials(c("token"), key)).otherwise(c("token")).alias("token"),
                         F.when(named, c("kind")).alias("kind"), F.when(named, c("token")).alias("value"))
    low = F.lower("mention")
    part = lambda at: F.filter(F.split(F.substring_index(low, "::", at), ":"), lambda x: x != "")
    groups = F.when(F.contains(low, F.lit("::")), F.concat(
        part(1), F.array_repeat(F.lit("0"), 8 - F.size(part(1)) - F.size(part(-1))), part(-1))).otherwise(F.split(low, ":"))
    address = F.array_join(F.transform(groups, lambda x: F.regexp_replace(x, "^0+(?=.)", "")), ":")
    digits = F.regexp_replace("mention", "[^0-9]", "")
    value = F.when(c("kind") == "phone", national(c("mention"))).when(c("kind").isin("card", "ssn"), digits).when(c("kind") == "ipv6", address) \
        .when(c("kind") == "iban", F.replace(c("mention"), F.lit(" "), F.lit(""))) \
        .when(c("kind").isin("email", "secret"), F.lower("mention")).otherwise(c("mention"))
    others = rows.where("kind <> 'name'").select("mention", F.lit(0).alias("at"), c("mention").alias("token"), "kind",
                                                 value.alias("value"))
    return others.unionByName(names)


def rendered() -> Column:
    """A surrogate (``made``) in the format of the token that it replaces."""
    c = F.col
    # Aligned at the end: what a surrogate does not reach (a country's code, zeros) stays.
    size = lambda keep: F.length(F.regexp_replace("token", f"[^{keep}]", "")) - F.length("made")
    poured = lambda keep: _each(c("token"), lambda x, i: F.when(
        x.rlike(f"[{keep}]") & (F.length(F.regexp_replace(F.left(c("token"), i), f"[^{keep}]", "")) > size(keep)), F.substring(
            c("made"), F.length(F.regexp_replace(F.left(c("token"), i), f"[^{keep}]", "")) - size(keep), F.lit(1))).otherwise(x))
    upper = (c("token") == F.upper("token")) & c("token").rlike("[A-Z]")
    return F.when(c("made").isNull(), c("token")).when(c("kind").isin("card", "phone", "ssn"), poured("0-9")) \
        .when(c("kind") == "iban", poured("A-Z0-9")).when(c("kind").isin("email", "secret", "ipv6") & upper, F.upper("made")) \
        .otherwise(c("made"))


def bare_names(names: Column) -> Column:
    """The pattern of an array of names (letters, marks and apostrophes only; longer ones before
    their beginnings): whole words, but anywhere in scripts that do not space words."""
    unspaced = r"^[\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー]"
    spaced = F.array_join(F.filter(names, lambda x: ~x.rlike(unspaced)), "|")
    other = F.array_join(F.filter(names, lambda x: x.rlike(unspaced)), "|")
    words = F.concat(F.lit(r"(?<![\p{L}\p{M}\p{N}])(?:"), spaced, F.lit(r")(?![\p{L}\p{M}\p{N}@])"))
    return F.concat_ws("|", F.when(spaced != "", words), F.when(other != "", other))


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """(kind, value, n, made) of entities (kind, value): no two entities of a family get the same
    surrogate, and none gets a real entity; two domains of e-mail addresses never share one
    either.  A name has one surrogate whatever its titles; its gender is theirs where those
    that tell one agree, and neutral otherwise."""
    c = F.col
    name = found.where(c("kind").startswith("name-")).groupBy("value").agg(
        F.max((c("kind") == "name-f").cast("int")).alias("f"), F.max((c("kind") == "name-m").cast("int")).alias("m"))
    name = name.select(F.when(c("f") > c("m"), "name-f").when(c("m") > c("f"), "name-m").otherwise("name-n").alias("kind"), "value")
    found = written(found.where(~c("kind").startswith("name-")).select("kind", "value").distinct().unionByName(name), "entities")
    domain = F.substring_index("value", "@", -1)
    domains = distinct_surrogates(found.where("kind = 'email'").select(F.lit("domain").alias("kind"), domain.alias("value"))
                                  .distinct().withColumn("domain", F.lit(None).cast("string")), key)
    domains = domains.select(c("value").alias("real"), c("made").alias("domain"))
    found = found.withColumn("real", F.when(c("kind") == "email", domain))
    found = found.where("real IS NULL").withColumn("domain", F.lit(None).cast("string")).unionByName(
        found.where("real IS NOT NULL").join(domains, "real")).select("kind", "value", "domain")
    return distinct_surrogates(written(found, "entities"), key).select("kind", "value", "n", "made")


def distinct_surrogates(found: DataFrame, key: str) -> DataFrame:
    """(kind, value, domain, n, made) of distinct entities (kind, value, domain)."""
    rows = written(with_surrogate(found.withColumn("n", F.lit(0)), key), "surrogates")
    of = family(F.col("kind"))
    real = found.select(of.alias("k"), F.col("value").alias("m"), F.lit(None).cast("string").alias("keeper"))
    for _ in range(ROUNDS):
        # Of entities with one surrogate the one with the fewest tries, then the smallest, keeps it.
        first = rows.groupBy(of.alias("k"), "made").agg(F.min(F.struct("n", "value")).alias("first"), F.count(F.lit(1)).alias("c")) \
            .where("c > 1").select("k", F.col("made").alias("m"), F.col("first.value").alias("keeper"))
        bad = rows.join(first.unionByName(real), (of == F.col("k")) & (F.col("made") == F.col("m"))) \
            .where("keeper IS NULL OR keeper <> value").select("kind", "value").distinct()
        bad = written(bad, "colliding")
        if bad.isEmpty():
            return rows
        again = with_surrogate(rows.join(bad, ["kind", "value"], "left_semi").select(*found.columns, (F.col("n") + 1).alias("n")), key)
        rows = written(rows.join(bad, ["kind", "value"], "left_anti").unionByName(again), "surrogates")
    raise ValueError("there are not enough surrogates for all entities")


@functools.cache
def _drawn(application: str) -> str:
    return secrets.token_hex(32)


def secret_key(spark: SparkSession) -> str:
    """The secret that surrogates depend on: from the session's settings, so that runs agree; unset, a random
    one that lasts as long as the application, never a known value."""
    return spark.conf.get(KEY_SETTING, None) or _drawn(spark.sparkContext.applicationId)


def replace(df: DataFrame, text: str = "text", key: str | None = None, count: str | None = None) -> DataFrame:
    """Replace the personal data in a text column; ``count`` names a column for the number of
    mentions.  Names found after a title are also replaced where the same text has them without.
    Rows of mentions, not texts, are shuffled; the replacements of a text reach it by its digest."""
    c, key = F.col, key or secret_key(df.sparkSession)
    own_, columns = "__", [*df.columns, count or ""]
    while any(x.startswith(own_) for x in columns):     # columns of our own, whatever the table's are called
        own_ += "_"
    d, at, new, names_, any_, found, gaps = (own_ + x for x in ("d", "key", "new", "names", "any", "found", "gaps"))
    digest = F.sha2(c(text).cast("binary"), 256)
    places = written(df.select(F.regexp_extract_all(c(text), F.lit(ANY), F.lit(0)).alias("mentions"), digest.alias("d"))
                     .where(F.size("mentions") > 0).select("d", F.explode("mentions").alias("mention")).distinct(), "mentions")
    tokens = written(tokens_of(places.select("mention").distinct(), key), "tokens")
    made = surrogates(tokens.where("kind IS NOT NULL").select("kind", "value").distinct(), key).select(
        family(c("kind")).alias("k"), c("value").alias("v"), "made")
    tokens = written(tokens.join(made, (family(c("kind")) == c("k")) & (c("value") == c("v")), "left")
                     .withColumn("new", rendered()), "rendered")
    made_ = tokens.groupBy("mention").agg(F.sort_array(F.collect_list(F.struct("at", "new"))).alias("parts")) \
        .select(c("mention").alias("m"), c("mention").alias("old"), F.array_join(c("parts.new"), "").alias("new"), F.lit(False).alias("name"))
    names = tokens.where("k = 'name'").where(F.length("token") > 1).select(
        c("mention").alias("m"), c("token").alias("old"), "new", F.lit(True).alias("name")).distinct()
    maps = places.join(made_.unionByName(names), c("mention") == c("m")).groupBy(c("d").alias(at)).agg(
        F.map_from_entries(F.collect_set(F.struct("old", "new"))).alias(new),
        F.sort_array(F.collect_set(F.when(c("name"), c("old"))), asc=False).alias(names_))
    pattern = F.when(F.size(names_) > 0, F.concat(F.lit(f"{ANY}|"), bare_names(c(names_)))).otherwise(ANY)
    rows = df.withColumn(d, digest).join(sized(written(maps, "replacements")), c(d) == c(at), "left") \
        .drop(d, at).withColumn(any_, pattern) \
        .withColumn(found, F.when(c(new).isNotNull(), F.regexp_extract_all(c(text), c(any_), F.lit(0)))) \
        .withColumn(gaps, F.when(c(new).isNotNull(), F.split(c(text), c(any_), -1)))
    joined = F.array_join(F.transform(gaps, lambda g, i: F.concat(
        g, F.coalesce(F.element_at(c(new), F.get(found, i)), F.get(found, i), F.lit("")))), "")
    if count:
        rows = rows.withColumn(count, F.coalesce(F.size(found), F.lit(0)).cast("long"))
    return rows.withColumn(text, F.when(c(new).isNotNull(), joined).otherwise(c(text))) \
        .drop(found, gaps, new, names_, any_)


def op3_surrogates(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace(rows, count="n_mentions").select("doc_id", "text", "n_mentions")
