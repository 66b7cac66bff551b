"""Scripts of India: which one a text is in, and its romanisation. Every block is read through the layout that they share with Devanagari."""

from __future__ import annotations

import functools
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of the scripts; blocks of 0x80 characters from U+0900 on, in this order.
BLOCKS = ("devanagari", "bengali", "gurmukhi", "gujarati", "oriya", "tamil", "telugu", "kannada", "malayalam")
CODES = {"none": 0, "latin": 1, **{name: i + 2 for i, name in enumerate(BLOCKS)}, "other": 15}
FIRST, LAST = 0x0900, 0x0DFF
# Scripts that don't write the silent vowel at the end of a word.
SILENT_END = {"devanagari", "bengali", "gurmukhi", "gujarati", "oriya"}
# What each Devanagari letter sounds like in ASCII; consonants carry an a unless a sign follows.
VOWELS = {
    "अ": "a", "आ": "a", "इ": "i", "ई": "i", "उ": "u", "ऊ": "u", "ऋ": "ri", "ॠ": "ri", "ऌ": "l", "ऍ": "e", "ऎ": "e", "ए": "e", "ऐ": "ai", "ऑ": "o", "ऒ": "o", "ओ": "o", "औ": "au",
}
SIGNS = {"ा": "a", "ि": "i", "ी": "i", "ु": "u", "ू": "u", "ृ": "ri", "ॄ": "ri", "ॢ": "l", "ॅ": "e", "ॆ": "e", "े": "e", "ै": "ai", "ॉ": "o", "ॊ": "o", "ो": "o", "ौ": "au", "्": ""}
CONSONANTS = {
    "क": "k", "ख": "kh", "ग": "g", "घ": "gh", "ङ": "n", "च": "ch", "छ": "chh", "ज": "j", "झ": "jh", "ञ": "n", "ट": "t", "ठ": "th", "ड": "d", "ढ": "dh", "ण": "n",
    "त": "t", "थ": "th", "द": "d", "ध": "dh", "न": "n", "ऩ": "n", "प": "p", "फ": "ph", "ब": "b", "भ": "bh", "म": "m", "य": "y", "र": "r", "ऱ": "r", "ल": "l", "ळ": "l", "ऴ": "l",
    "व": "v", "श": "sh", "ष": "sh", "स": "s", "ह": "h",
}
OTHERS = {"ँ": "n", "ः": "h", "।": " ", "॥": " ", "ऽ": "'", **{chr(0x0966 + i): str(i) for i in range(10)}}
# Letters without a counterpart at the same place of the Devanagari block.
OWN_LETTERS = {
    "ৎ": "त्", "ੰ": "ं", "ੱ": "", "ൺ": "ण्", "ൻ": "न्", "ർ": "र्", "ൽ": "ल्", "ൾ": "ळ्", "ൿ": "क्", "‌": "", "‍": "",
}
NUKTA, VIRAMA, ANUSVARA, TRILL = "़", "्", "ं", "ऱ"
# Consonants with a dot below.
DOTTED = {"क": "q", "ख": "kh", "ग": "g", "ज": "z", "ड": "r", "ढ": "rh", "फ": "f", "य": "y", "न": "n", "र": "r", "ळ": "l"}
RUN = re.compile("[ऀ-෿][ऀ-෿‌‍]*")


def block_of(char: str) -> str | None:
    """The script of an Indic character; Sinhala and all others have none of the nine."""
    i = (ord(char) - FIRST) >> 7
    return BLOCKS[i] if 0 <= i < len(BLOCKS) else None


def majority(text: str) -> str | None:
    """The Indic script with most characters, the first of equals; None without any."""
    counts: dict[str, int] = {}
    for c in text:
        if name := block_of(c):
            counts[name] = counts.get(name, 0) + 1
    return max(counts, key=counts.get) if counts else None


@functools.lru_cache(maxsize=100_000)
def romanised_run(run: str) -> str:
    """A word of an Indic script in ASCII: letter by letter, with the inherent a where no sign follows. What has no sound is left out."""
    shared = ""
    for char in run:
        for c in OWN_LETTERS.get(char, char):
            c = chr(FIRST + (ord(c) - FIRST) % 0x80) if block_of(c) else "" if FIRST <= ord(c) <= LAST else c
            shared += unicodedata.normalize("NFD", c) if "\u0958" <= c <= "\u095f" else c
    out, i, script = [], 0, majority(run)
    while i < len(shared):
        c = shared[i]
        dotted = shared[i + 1 : i + 2] == NUKTA
        after = i + 1 + dotted
        if c in CONSONANTS:
            sound = DOTTED.get(c, CONSONANTS[c]) if dotted else CONSONANTS[c]
            if c == TRILL and shared[after : after + 2] == VIRAMA + TRILL:  # a doubled trill sounds as tt
                sound, after = "tt", after + 2
            sign = shared[after : after + 1]
            if sign in SIGNS and sign:
                out.append(sound + SIGNS[sign])
                after += 1
            else:
                out.append(sound + ("" if after >= len(shared) and script in SILENT_END else "a"))
        elif c == ANUSVARA:
            out.append("m" if CONSONANTS.get(shared[after : after + 1], " ")[0] in "pbm" else "n")
        else:
            out.append(VOWELS.get(c) or SIGNS.get(c) or OTHERS.get(c) or (c if not FIRST <= ord(c) <= LAST else ""))
        i = after
    return "".join(out).lower()


def romanised(text: str) -> str:
    """Indic runs in ASCII; everything else as it is."""
    return text if text.isascii() else RUN.sub(lambda m: romanised_run(m.group()), text)


def romanise(text: Column) -> Column:
    """Of each text; null as empty. Runs are remembered by the worker, and ASCII texts aren't looked at."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.fillna("").map(romanised)

    return run(text)
