"""Bengali script in rough Latin spelling, as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin spelling of each letter and sign.
CONSONANTS = {
    "ক": "k", "খ": "kh", "গ": "g", "ঘ": "gh", "ঙ": "ng", "চ": "ch", "ছ": "chh", "জ": "j", "ঝ": "jh", "ঞ": "n", "ট": "t", "ঠ": "th",
    "ড": "d", "ঢ": "dh", "ণ": "n", "ত": "t", "থ": "th", "দ": "d", "ধ": "dh", "ন": "n", "প": "p", "ফ": "ph", "ব": "b", "ভ": "bh",
    "ম": "m", "য": "j", "র": "r", "ল": "l", "শ": "sh", "ষ": "sh", "স": "s", "হ": "h", "\u09dc": "r", "\u09dd": "rh", "\u09df": "y",
}
VOWELS = {"অ": "a", "আ": "a", "ই": "i", "ঈ": "i", "উ": "u", "ঊ": "u", "ঋ": "ri", "এ": "e", "ঐ": "oi", "ও": "o", "ঔ": "ou"}
VOWEL_SIGNS = {
    "\u09be": "a", "\u09bf": "i", "\u09c0": "i", "\u09c1": "u", "\u09c2": "u", "\u09c3": "ri",
    "\u09c7": "e", "\u09c8": "oi", "\u09cb": "o", "\u09cc": "ou",
}
OTHERS = {"\u0982": "ng", "\u0983": "h", "\u09ce": "t"}
#: Two code points that stand for one.
COMPOSED = {
    "\u09a1\u09bc": "\u09dc", "\u09a2\u09bc": "\u09dd", "\u09af\u09bc": "\u09df", "\u09c7\u09be": "\u09cb", "\u09c7\u09d7": "\u09cc",
}
_GLIDE = "\ue000"  # stands for a virama with the letter ya while vowels are put in


def to_latin(text: Column) -> Column:
    """Null without a Bengali character; "a" only between two consonants; other scripts' letters fall out.

    Composition is that of Bengali; a Latin letter with combining accents falls out like a composed one.
    """
    s = F.regexp_replace(text, "[A-Za-z][\\u0300-\\u036f]+", "")
    for pair, one in COMPOSED.items():
        s = F.replace(s, F.lit(pair), F.lit(one))
    s = F.replace(s, F.lit("\u09cd\u09af"), F.lit(_GLIDE))
    letters = "[" + "".join(CONSONANTS) + "]"
    s = F.regexp_replace(s, f"({letters})(?={letters})", "$1a")
    s = F.regexp_replace(s, "[\\s\\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+", " ")
    spelt = CONSONANTS | VOWELS | VOWEL_SIGNS | OTHERS | {chr(0x09E6 + i): str(i) for i in range(10)} | {_GLIDE: "y"}
    table = F.create_map(*[F.lit(x) for pair in spelt.items() for x in pair])
    latin = F.transform(F.split(s, ""), lambda c: F.coalesce(F.try_element_at(table, c), F.when(c.rlike("^[\\x00-\\x7f]$"), c), F.lit("")))
    return F.when(text.rlike("[\\u0980-\\u09ff]"), F.trim(F.regexp_replace(F.array_join(latin, ""), " +", " ")))
