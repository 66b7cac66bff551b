"""Fixed word lists and patterns of the normaliser. Values that results depend on, in their natural order."""

from __future__ import annotations

import re

# Tokens that mean nothing was entered.
JUNK = ("null", "n/a", "nil", "--", "-")

# Legal suffixes by country, in their cleaned form; India's with the spellings that romanisation gives.
LEGAL_SUFFIXES = {
    "US": ("inc", "llc", "corp", "ltd", "plc", "lp", "llp", "incorporated", "corporation", "limited", "l l c", "l l p"),
    "India": ("pvt", "private", "ltd", "limited", "llp", "and co", "praivet", "praibhet", "piraivet", "praivatt", "limitet", "limatid", "limittad", "pra li", "elelpi", "elaelapi"),
    "France": ("sarl", "sas", "sasu", "sa", "sci", "eurl", "snc"),
}
LEADING_SUFFIX_COUNTRIES = ("France",)

# Street words and their short forms.
STREET_TYPES = {
    "street": "st", "saint": "st", "road": "rd", "avenue": "ave", "av": "ave", "boulevard": "blvd", "bd": "blvd", "lane": "ln", "drive": "dr", "court": "ct",
    "square": "sq", "highway": "hwy", "suite": "ste", "apartment": "apt", "floor": "fl",
}
PO_BOX = r"(?U)\b(?:p\s?o|post)\s+box\b"

# States of India by code, with the spellings that occur.
INDIA_STATES = {
    "ap": ("andhra pradesh", "andhrapradesh", "ap"), "ar": ("arunachal pradesh", "ar"), "as": ("assam", "as"), "br": ("bihar", "br"),
    "cg": ("chhattisgarh", "chattisgarh", "chhatisgarh", "cg", "ct"), "ga": ("goa", "ga"), "gj": ("gujarat", "gj"), "hr": ("haryana", "hariyana", "hr"),
    "hp": ("himachal pradesh", "hp"), "jh": ("jharkhand", "jh"), "ka": ("karnataka", "karnatak", "ka"), "kl": ("kerala", "keralam", "keralan", "kl"),
    "mp": ("madhya pradesh", "madhy pradesh", "mp"), "mh": ("maharashtra", "maharashtr", "mh"), "mn": ("manipur", "mn"), "ml": ("meghalaya", "ml"),
    "mz": ("mizoram", "mz"), "nl": ("nagaland", "nl"), "od": ("odisha", "orissa", "orisha", "od", "or"), "pb": ("punjab", "panjab", "pb"),
    "rj": ("rajasthan", "rj"), "sk": ("sikkim", "sk"), "tn": ("tamil nadu", "tamilnadu", "tamilnatu", "tn"), "tg": ("telangana", "tg", "ts"),
    "tr": ("tripura", "tr"), "up": ("uttar pradesh", "up"), "uk": ("uttarakhand", "uttaranchal", "uk", "ut"), "wb": ("west bengal", "pashchimabang", "paschim banga", "wb"),
    "an": ("andaman and nicobar islands", "andaman and nicobar", "an"), "ch": ("chandigarh", "ch"),
    "dh": ("dadra and nagar haveli and daman and diu", "dadra and nagar haveli", "daman and diu", "dh", "dn", "dd"), "dl": ("delhi", "dilli", "nct of delhi", "dl"),
    "jk": ("jammu and kashmir", "jammu kashmir", "jk"), "la": ("ladakh", "la"), "ld": ("lakshadweep", "ld"), "py": ("puducherry", "pondicherry", "py"),
}
# Postal codes of the states and territories of the US.
US_STATES = {
    "al": "alabama", "ak": "alaska", "az": "arizona", "ar": "arkansas", "ca": "california", "co": "colorado", "ct": "connecticut", "de": "delaware", "dc": "district of columbia",
    "fl": "florida", "ga": "georgia", "hi": "hawaii", "id": "idaho", "il": "illinois", "in": "indiana", "ia": "iowa", "ks": "kansas", "ky": "kentucky", "la": "louisiana",
    "me": "maine", "md": "maryland", "ma": "massachusetts", "mi": "michigan", "mn": "minnesota", "ms": "mississippi", "mo": "missouri", "mt": "montana", "ne": "nebraska",
    "nv": "nevada", "nh": "new hampshire", "nj": "new jersey", "nm": "new mexico", "ny": "new york", "nc": "north carolina", "nd": "north dakota", "oh": "ohio", "ok": "oklahoma",
    "or": "oregon", "pa": "pennsylvania", "ri": "rhode island", "sc": "south carolina", "sd": "south dakota", "tn": "tennessee", "tx": "texas", "ut": "utah", "vt": "vermont",
    "va": "virginia", "wa": "washington", "wv": "west virginia", "wi": "wisconsin", "wy": "wyoming", "pr": "puerto rico", "gu": "guam", "vi": "virgin islands",
}
CODE_COUNTRIES = ("India", "US")

# Words that mark a part of an address as street, building or landmark.
STRUCTURE_WORDS = (
    "st", "street", "rd", "road", "ave", "avenue", "blvd", "boulevard", "ln", "lane", "dr", "drive", "ct", "court", "sq", "hwy", "highway", "ste", "suite", "apt", "apartment",
    "apartments", "fl", "floor", "pobox", "unit", "bldg", "building", "room", "tower", "wing", "shop", "complex", "plot", "flat", "house", "no", "block", "sector", "sec", "ward",
    "gali", "marg", "main", "cross", "near", "nr", "opp", "opposite", "behind", "beside", "c o", "residency", "society", "chs", "layout", "colony", "phase", "village", "vill",
    "post", "po", "dist", "district", "taluka", "tal", "tehsil", "mandal", "rue", "r", "av", "bd", "chemin", "allee", "place", "impasse", "route", "bp", "cs", "cedex", "bis",
)
# Postcodes, against a whole folded part of an address.
POSTCODES = {"US": r"^(?:[a-z ]+ )?(\d{5})(?: \d{4})?$", "India": r"^(?:[a-z ]+ )?([1-9]\d{5})$", "France": r"^((?:0[1-9]|[1-8]\d|9[0-8])\d{3})(?: [a-z][a-z ]*)?$"}
# House numbers, of segments joined by - or / with a digit somewhere; ordinals are none.
HOUSE_NUMBER = r"(?:[0-9a-z]+[-/])*[0-9a-z]*[0-9][0-9a-z]*(?:[-/][0-9a-z]+)*"
ORDINAL = r"^\d+(?:st|nd|rd|th)$"
# Endings of a domain name.
DOMAIN_END = r"\.(com|net|org|co\.in|co|io|in|fr|us|biz|info)$"


def folded_spelling(word: str) -> str:
    """A spelling as addresses are compared: runs of a vowel as one, ph as f."""
    return re.sub(r"([aeiou])\1+", r"\1", word).replace("ph", "f")


def state_spellings() -> list[tuple[str, str, str]]:
    """(country, folded spelling, code); the first code of a spelling counts."""
    every = [("India", w, code) for code, words in INDIA_STATES.items() for w in words] + [("US", w, code) for code, name in US_STATES.items() for w in (name, code)]
    found: dict[tuple[str, str], str] = {}
    for country, word, code in every:
        found.setdefault((country, folded_spelling(word)), code)
    return [(country, word, code) for (country, word), code in found.items()]


def alternatives(words) -> str:
    """The words as a pattern, the longest first."""
    return "|".join(w.replace(" ", r"\s") for w in sorted(words, key=len, reverse=True))
