"""Name normalisation and transliteration (native expressions)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.text import WHITESPACE, let, strip

# Latin spellings of Cyrillic letters. The soft and the hard sign
# are dropped.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "yo",
    "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m",
    "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u",
    "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch",
    "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
    "є": "ie", "і": "i", "ї": "i", "ґ": "g", "ў": "u",
    "ђ": "dj", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "c", "џ": "dz", "ѓ": "gj", "ќ": "kj", "ѕ": "dz",
    "ѐ": "e", "ѝ": "i", "қ": "q", "ғ": "gh", "ң": "ng", "ө": "o", "ұ": "u", "ү": "u", "һ": "h", "ә": "a",
    "ҷ": "j", "ҳ": "h", "ӣ": "i", "ӯ": "u",
}

# Latin spellings of Greek, Georgian and Armenian letters.
GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a v g d e z i th i k l m n x o p r s s t y f ch ps o".split()))
GEORGIAN = dict(
    zip("აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ",
        "a b g d e v z t i k l m n o p zh r s t u p k gh q sh ch ts dz ts ch kh j h".split())
)
ARMENIAN = dict(
    zip("աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփքօֆ",
        "a b g d e z e y t zh i l kh ts k h dz gh ch m y n sh o ch p j r s v t r ts u p k o f".split())
) | {"և": "ev"}

# Latin letters that do not decompose into a base letter and an accent.
LATIN_SPECIAL = {
    "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d",
    "þ": "th", "ł": "l", "ı": "i", "ħ": "h",
}


def accent_table() -> dict[str, str]:
    """Lower-case accented Latin and Greek letters mapped to their base letter, by decomposition."""
    table = {}
    for code in [*range(0x00DF, 0x0250), *range(0x0390, 0x03CF), *range(0x1E00, 0x2000)]:
        char = chr(code)
        base = unicodedata.normalize("NFD", char)[0]
        base = GREEK.get(base, base)
        if char != base and char not in GREEK and base.isascii() and base.isalpha() and char == char.lower():
            table[char] = base
    return table


def letter_table() -> dict[str, str]:
    return {**accent_table(), **LATIN_SPECIAL, **GREEK, **GEORGIAN, **ARMENIAN, **CYRILLIC}


def transliterate(col: Column) -> Column:
    """Fold lower-case Cyrillic and accented Latin letters to ASCII.

    ASCII text is as it was. Letters with one (or no) Latin letter go through a single ``translate``. Of
    those that need several letters, the ones that a text has are replaced one by
    one, so a text without any is only searched for them.
    """
    table = letter_table()
    single = {c: t for c, t in table.items() if len(t) == 1}
    dropped = [c for c, t in table.items() if t == ""]
    several = {c: t for c, t in table.items() if len(t) > 1}
    spelling = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])

    def spelled(text: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(f"[{''.join(several)}]"), F.lit(0)))
        return F.aggregate(found, text, lambda out, letter: F.replace(out, letter, F.element_at(spelling, letter)))

    def folded(text: Column) -> Column:
        other = F.translate(spelled(text), "".join(single) + "".join(dropped), "".join(single.values()))
        return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(other)

    return let(col, folded)


def normalize_name(col: Column) -> Column:
    """Strip, lower, drop punctuation, transliterate; null becomes ``''``.

    Letters, digits, underscores and whitespace survive the punctuation step.
    Non-ASCII whitespace is written as a plain space by the transliteration.
    """
    cleaned = F.regexp_replace(F.lower(strip(col)), rf"[^\p{{L}}\p{{N}}_{WHITESPACE}]", "")
    plain = F.regexp_replace(cleaned, r"[\x85\p{Z}]", " ")
    return F.coalesce(transliterate(plain), F.lit(""))


def name_tokens(norm: Column) -> Column:
    """Sorted distinct whitespace-separated tokens of a normalised name."""
    parts = F.split(norm, f"[{WHITESPACE}]+")
    return F.array_sort(F.array_distinct(F.filter(parts, lambda t: t != "")))
