"""The normaliser: cleaning, folding, legal suffixes, street words and address components as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions import lexicon as lx
from tallyweave.functions.kernels import fold_accents
from tallyweave.functions.script import romanise
from tallyweave.functions.text import acronym, phonetic_fold, script_of, tokens

NORM = ("entity_id", "name_norm", "name_roman", "name_tokens", "name_acronym", "addr_norm", "addr_roman", "addr_tokens", "street_num", "city_norm", "state_canon", "postcode", "country", "has_addr", "script", "name_suffix")


def compatible(text: Column) -> Column:
    """NFKC in lower case; null as empty. ASCII texts are only lowered."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.fillna("").map(lambda x: x.lower() if x.isascii() else unicodedata.normalize("NFKC", x).lower())

    return run(text)


def clean_expr(text: Column) -> Column:
    """NFKC, lower case, without tokens that mean nothing, single spaces, no repeated separators; null as empty."""
    sep = r"[\s,;]"
    out = F.regexp_replace(compatible(text), r"(?U)<<|\(\s*\)", " ")
    for _ in range(2):  # neighbouring tokens share a separator
        out = F.regexp_replace(out, rf"(?U)(^|{sep})(?:{'|'.join(lx.JUNK)})({sep}|$)", "$1 $2")
    out = F.regexp_replace(F.regexp_replace(out, r"(?U)\s+", " "), " ([,;])", "$1")
    return F.btrim(F.regexp_replace(out, "([,;])(?: ?[,;])+", "$1"), F.lit(" ,;"))


def spaced(folded: Column, keep_house_numbers: bool = False) -> Column:
    """Letters and digits with single spaces, & as and; - and / stay where a digit stands beside them, if asked for."""
    joiner = r"(?!(?<=\p{Nd})[-/](?=[0-9a-z])|(?<=[0-9a-z])[-/](?=\p{Nd}))" if keep_house_numbers else ""
    return F.trim(F.regexp_replace(F.replace(folded, F.lit("&"), F.lit(" and ")), rf"(?:{joiner}[^\p{{L}}\p{{N}}])+", " "))


def roman_base(text: Column, keep_house_numbers: bool = False) -> Column:
    """Folded letters and digits of a romanised text, separated by single spaces."""
    return spaced(fold_accents(text), keep_house_numbers)


def legal_suffix(name: Column, country: Column) -> tuple[Column, Column]:
    """A roman-base name without the legal suffixes of its country at the end (in France also at the beginning), and those suffixes. A name of suffixes alone stays whole."""
    stripped, removed = name, F.lit("")
    for key, words in lx.LEGAL_SUFFIXES.items():
        alts = lx.alternatives(words)
        trail, lead = rf"(?:^|\s)((?:{alts})(?:\s(?:{alts}))*)$", rf"^((?:{alts})(?:\s(?:{alts}))*)(?:\s|$)"
        rest, gone = F.regexp_replace(name, trail, ""), F.regexp_extract(name, trail, 1)
        if key in lx.LEADING_SUFFIX_COUNTRIES:
            gone = F.trim(F.concat_ws(" ", F.regexp_extract(rest, lead, 1), gone))
            rest = F.regexp_replace(rest, lead, "")
        rest = F.trim(rest)
        stripped = F.when(country == key, F.when(rest == "", name).otherwise(rest)).otherwise(stripped)
        removed = F.when(country == key, F.when(rest == "", F.lit("")).otherwise(gone)).otherwise(removed)
    return stripped, removed


def street(address: Column) -> Column:
    """Spellings of a post box to pobox, then each street word to its short form."""
    words = F.create_map(*[F.lit(x) for pair in lx.STREET_TYPES.items() for x in pair])
    return F.array_join(F.transform(F.split(F.regexp_replace(address, lx.PO_BOX, "pobox"), " "), lambda x: F.coalesce(F.element_at(words, x), x)), " ")


def state_table(spark: SparkSession) -> DataFrame:
    """(country, alpha, state): folded spellings and codes of states; under 200 rows."""
    return spark.createDataFrame(lx.state_spellings(), "country string, alpha string, state string")


def state_of(country: Column, alpha: Column) -> Column:
    """The code of a folded spelling; null if it has none."""
    out = F.lit(None).cast("string")
    for key in lx.CODE_COUNTRIES:
        known = F.create_map(*[F.lit(x) for c, word, code in lx.state_spellings() if c == key for x in (word, code)])
        out = F.when(country == key, F.element_at(known, alpha)).otherwise(out)
    return out


def _stop(text: Column) -> Column:
    words = sorted({lx.folded_spelling(w).replace(" ", r"\s") for w in lx.STRUCTURE_WORDS}, key=len, reverse=True)
    return F.rlike(text, F.lit(rf"(?U)\b(?:{'|'.join(words)})\b"))


def address_parts(folded: Column, country: Column) -> Column:
    """array<struct<pos, key, alpha, digit, state, pc>> of the comma-separated parts of an address whose accents are folded."""

    def keyed(part: Column) -> Column:
        key = phonetic_fold(spaced(part))
        alpha = F.trim(F.regexp_replace(F.regexp_replace(key, r"\S*\d\S*", " "), r"\s+", " "))
        return F.struct(key.alias("key"), alpha.alias("alpha"))

    def placed(x: Column, pos: Column) -> Column:
        key, alpha = x["key"], x["alpha"]
        digit, state = F.rlike(key, F.lit(r"\d")), state_of(country, alpha)
        code = F.lit(None).cast("string")
        for name, pattern in lx.POSTCODES.items():
            hit = (country == name) & F.rlike(key, F.lit(pattern))
            if name == "US":  # after a state, or alone but not first
                hit &= state.isNotNull() | ((alpha == "") & (pos > 0))
            if name == "France":
                hit &= ~_stop(key)
            code = F.when(hit, F.regexp_extract(key, pattern, 1)).otherwise(code)
        return F.struct(pos.alias("pos"), key.alias("key"), alpha.alias("alpha"), digit.alias("digit"), state.alias("state"), code.alias("pc"))

    return F.transform(F.transform(F.split(folded, ","), keyed), placed)


def address_components(rows: DataFrame, address: str = "addr_pre", country: str = "country") -> DataFrame:
    """rows with street_num, city_norm, state_canon and postcode of a cleaned, romanised address; empty where there is none. Each row stays one row; null addresses and countries are empty."""
    pre, land = F.coalesce(F.col(address), F.lit("")), F.coalesce(F.col(country), F.lit(""))
    out = rows.withColumn("__parts", address_parts(fold_accents(pre), land))
    first = lambda name, keep, field: F.get(F.filter("__parts", keep), F.lit(0))[field].alias(name)
    lone = lambda x: land.isin(*lx.CODE_COUNTRIES) & F.rlike(x["alpha"], F.lit("^[a-z]{2}$")) & ~x["digit"]
    mapped = lambda x: x["state"].isNotNull()
    out = out.withColumn("__found", F.struct(
        first("pc", lambda x: x["pc"].isNotNull(), "pc"), first("state", mapped, "state"), first("state_pos", mapped, "pos"),
        first("code", lone, "alpha"), first("code_pos", lone, "pos"), first("street_pos", lambda x: x["digit"] & x["pc"].isNull(), "pos"),
    ))
    at = F.coalesce("__found.state_pos", "__found.code_pos")
    anchor = F.coalesce(at, "__found.street_pos", F.lit(0))
    named = F.transform("__parts", lambda x: F.struct(F.abs(x["pos"] - anchor).alias("dist"), x["pos"].alias("pos"), F.when(~x["digit"], x["key"]).when(x["pc"].isNotNull(), x["alpha"]).alias("city"), x["state"].alias("state")))
    city = F.array_min(F.filter(named, lambda x: x["city"].isNotNull() & (x["city"] != "") & x["state"].isNull() & (x["pos"] != F.coalesce(at, F.lit(-1))) & ~_stop(x["city"]) & (F.regexp_count(x["city"], F.lit(" ")) < 4)))["city"]
    numbers = F.filter(F.regexp_extract_all(pre, F.lit(rf"(?:^|[^0-9a-z/\-])({lx.HOUSE_NUMBER})"), F.lit(1)), lambda x: ~F.rlike(x, F.lit(lx.ORDINAL)) & (x != F.coalesce("__found.pc", F.lit(""))))
    some = lambda c, name: F.coalesce(c, F.lit("")).alias(name)
    return out.select(*rows.columns, some(F.get(numbers, F.lit(0)), "street_num"), some(city, "city_norm"), some(F.coalesce("__found.state", "__found.code"), "state_canon"), some(F.col("__found.pc"), "postcode"))


def normalise_frame(records: DataFrame) -> DataFrame:
    """The 16 columns of NORM for each record (entity_id, business_name, business_address, country); other columns are left out.

    Null names, addresses and countries count as empty; rows that repeat an id stay rows; an empty table
    stays empty. script: code of the name plus 16 times that of the address.
    """
    base = records.select("entity_id", clean_expr(F.col("business_name")).alias("name_norm"), clean_expr(F.col("business_address")).alias("addr_norm"), F.coalesce("country", F.lit("")).alias("country"))
    pre = base.withColumns({"name_pre": romanise(F.col("name_norm")), "addr_pre": romanise(F.col("addr_norm"))})
    folded = pre.withColumns({"name_base": roman_base(F.col("name_pre")), "addr_base": roman_base(F.col("addr_pre"), keep_house_numbers=True)})
    stripped, removed = legal_suffix(F.col("name_base"), F.col("country"))
    rows = address_components(folded).withColumns({
        "name_roman": phonetic_fold(stripped), "name_suffix": removed, "addr_roman": phonetic_fold(street(F.col("addr_base"))),
        "script": (script_of(F.col("name_norm")) + 16 * script_of(F.col("addr_norm"))).cast("short"), "has_addr": F.col("addr_norm") != "",
    })
    rows = rows.withColumns({"name_tokens": tokens(F.col("name_roman")), "addr_tokens": tokens(F.col("addr_roman"))})
    return rows.withColumn("name_acronym", acronym(F.col("name_tokens"))).select(*NORM)


def normalise_record(spark: SparkSession, name: str | None, address: str | None, country: str | None) -> dict:
    """One record through normalise_frame, for looking at."""
    row = spark.createDataFrame([("x", name, address, country)], "entity_id string, business_name string, business_address string, country string")
    return normalise_frame(row).first().asDict()


def one(spark: SparkSession, expression, *values: str | None):
    """What an expression of columns gives for one row of strings, for looking at."""
    row = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(expression(*[F.col(c) for c in row.columns]).alias("x")).first()["x"]
