"""Scalar functions on names, places, ids, dates and marked-up text, as column expressions without Python."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space that Python's str.strip() takes off; Spark's trim takes spaces only.
_WHITE = r"[\s\x1C-\x1F]"
_STRIP = rf"(?U)^{_WHITE}+|{_WHITE}+$"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value worked out once a row, however often use names it, also inside of lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _STRIP, "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c.cast("string")), F.lit(""))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, f"(?U){_WHITE}+", " "))


@cache
def _decompositions() -> tuple[str, str, dict[str, str]]:
    """Characters that decompose to one ASCII letter, those letters, and characters that decompose to several."""
    one, to, several = [], [], {}
    for code in range(0x80, 0x30000):
        ch = chr(code)
        if 0xD800 <= code < 0xE000 or unicodedata.combining(ch):
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if plain != ch and any(x.isascii() and x.isalpha() for x in plain):
            if len(plain) == 1:
                one.append(ch)
                to.append(plain)
            else:
                several[ch] = plain
    return "".join(one), "".join(to), several


def unaccent(c: Column) -> Column:
    """Compatibility decomposition as far as it yields ASCII letters, without combining marks."""
    one, to, several = _decompositions()
    c = F.translate(F.regexp_replace(c, r"\p{Mn}", ""), one, to)
    table = F.create_map(*(F.lit(x) for pair in several.items() for x in pair))
    spelled = F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.element_at(table, x), x)), "")
    return F.when(c.rlike("[" + "".join(several) + "]"), spelled).otherwise(c)


def normalize_name(c: Column) -> Column:
    """Upper-case A-Z words, one space between them; null counts as empty."""
    return F.upper(F.trim(F.regexp_replace(unaccent(F.coalesce(c, F.lit(""))), "[^a-zA-Z]+", " ")))


def normalize_place(c: Column) -> Column:
    """Upper case, punctuation to spaces, accents and digits kept."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def phonetic_code(token: Column) -> Column:
    """How a Spanish speaker might spell the sound of a normalized token."""
    t = F.translate(F.lower(token), "v", "b")
    t = F.translate(F.replace(t, F.lit("ll"), F.lit("y")), "z", "s")
    t = F.regexp_replace(t, "c([ei])", "s$1")
    t = F.translate(F.replace(t, F.lit("qu"), F.lit("k")), "ch", "k")
    t = F.regexp_replace(F.regexp_replace(t, "g([ei])", "j$1"), "y$", "i")
    return F.regexp_replace(t, r"(.)\1+", "$1")


def name_tokens(normalized: Column) -> Column:
    return F.filter(F.split(normalized, " "), lambda x: x != "")


def phonetic_tokens(normalized: Column) -> Column:
    return F.array_distinct(F.transform(name_tokens(normalized), phonetic_code))


def digits(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")


def id_number(c: Column) -> Column:
    """Digits only, if there are 6 to 9 of them."""
    d = digits(c)
    return F.when(F.length(d).between(6, 9), d)


def stable_id(source: Column, *parts: Column) -> Column:
    key = F.concat_ws(":", source, *(F.coalesce(p, F.lit("")) for p in parts))
    return F.concat(source, F.lit(":"), F.substring(F.md5(key.cast("binary")), 1, 12))


def hashed_id(prefix: str, *parts: Column) -> Column:
    key = F.concat_ws("|", *(text_or_empty(p) for p in parts))
    return F.concat(F.lit(prefix + ":"), F.substring(F.sha2(key.cast("binary"), 256), 1, 16))


def labelled_notes(separator: str, *parts: tuple[str, Column]) -> Column:
    """Non-empty parts, each after its label, joined; an empty label gives the part alone."""
    return F.concat_ws(separator, *(F.when(text_or_empty(v) != "", F.concat(F.lit(f"{k}: " if k else ""), strip(v))) for k, v in parts))


def age_range(low: Column, high: Column, zero_is_missing: bool) -> Column:
    """low-high if both are there and differ, else low."""
    some = (lambda c: c.isNotNull() & (c != 0)) if zero_is_missing else (lambda c: c.isNotNull())
    return F.when(some(low) & some(high) & (low != high), F.concat_ws("-", low.cast("string"), high.cast("string"))).when(some(low), low.cast("string"))


def location_parts(c: Column, second_is_both: bool = False) -> Column:
    """parish, municipality, state from a comma list: first, second and last of three or more, the latter two of two, the
    state alone of one. second_is_both: the second of two is the municipality, too, as one of the registries has it."""
    p = F.transform(F.split(c, ","), lambda x: F.trim(x))
    n = F.size(p)
    return F.struct(
        F.when(n >= 3, F.get(p, F.lit(0))).otherwise("").alias("parroquia"),
        F.when(n >= 3, F.get(p, F.lit(1))).when(n == 2, F.get(p, F.lit(1 if second_is_both else 0))).otherwise("").alias("municipio"),
        F.try_element_at(p, F.lit(-1)).alias("estado"),
    )


#: The entities that pages use, decoded in this order.
ENTITIES = {"&nbsp;": " ", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&lt;": "<", "&gt;": ">", "&middot;": "·", "&copy;": "©", "&amp;": "&"}


def decode_entities(c: Column) -> Column:
    for entity, char in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


@F.pandas_udf(StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else html.unescape(t))


def unescape(c: Column) -> Column:
    """Every entity of HTML, by name and by number; texts without an ampersand stay in the JVM's hands."""
    return F.when(c.contains("&"), _unescaped(F.when(c.contains("&"), c))).otherwise(c)


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def strip_age_unit(c: Column) -> Column:
    return F.regexp_replace(c, r"(?iu)\s*a[ñn]os?\s*$", "")


def full_name(*parts: Column) -> Column:
    return F.concat_ws(" ", *(blank_to_null(p) for p in parts))


def query_number(url: Column, name: str) -> Column:
    """A whole-number parameter of a url's query as a long, 0 without one that fits."""
    return F.coalesce(F.regexp_extract(url, rf"[?&]{name}=(\d+)(?:[&#]|$)", 1).try_cast("long"), F.lit(0))


def iso_date(c: Column) -> Column:
    """DD-MM-YY as 20YY-MM-DD; other shapes stay."""
    return F.regexp_replace(c, r"^(\d\d)-(\d\d)-(\d\d)$", "20$3-$2-$1")


def valid_cron(c: Column) -> Column:
    return F.size(F.split(F.trim(c), r"\s+")) == 5


def fuzzy_key(fields: Column, *needles: str) -> Column:
    """The first non-empty value of a map whose key, lower-case and with e for é, holds one of the needles."""
    plain = lambda k: F.translate(F.lower(k), "é", "e")
    hit = lambda e: F.exists(F.array(*map(F.lit, needles)), lambda n: F.contains(plain(e["key"]), n)) & (text_or_empty(e["value"]) != "")
    return F.get(F.filter(F.map_entries(fields), hit), F.lit(0))["value"]


def name_variants(name: Column) -> Column:
    return F.filter(F.split(name, r"\s*/\s*"), lambda x: F.trim(x) != "")


#: What marks a slash-separated name as something else. The tool's own mark is a parameter.
MARKUP = r"(?i)<[a-zA-Z!/][^>]*>|javascript:|on(error|load)\s*="
ADMIN = r"(?i)C\.I\.\s*registrada|{mark}coincidencia\s*~?\d+%"
MESSAGE = r"^\s*\[\d{1,2}/\d{1,2},\s*\d{1,2}:\d{2}"


def slash_class(name: Column, mark: str | None = None) -> Column:
    admin = ADMIN.replace("{mark}", f"{mark}|" if mark else "")
    return F.when(name.rlike(MARKUP), "posible_inyeccion").when(name.rlike(admin), "notas_administrativas").when(name.rlike(MESSAGE), "mensaje_multiple").otherwise("variantes_ocr")


def suspicious_canonical(name: Column) -> Column:
    """The first variant is illegible, has two letters or fewer, or is under 0.4 of the longest further one."""
    v = name_variants(name)
    first, rest = F.get(v, F.lit(0)), F.slice(v, F.lit(2), F.size(v))
    letters = F.length(F.regexp_replace(first, "[^A-Za-zÀ-ÿ]", ""))
    longest = F.coalesce(F.array_max(F.transform(rest, F.length)), F.lit(0))
    return F.coalesce(F.lower(first).contains("ilegible") | (letters <= 2) | (F.length(first) * 10 < longest * 4), F.lit(True))


#: Fixed value: a part of a multipart body whose empty line follows its name at once; a part with more headers, such as an
#: uploaded file, is none. Its groups are the name and the value, up to the next boundary line.
PART = r'(?sU)name="([^"]+)"\s*\r?\n\r?\n(.*?)(?=\r?\n-{10,}|\z)'


def multipart_fields(blob: Column) -> Column:
    """name and value of each plain part of a multipart body, non-empty values only, the last of a name."""
    names, values = (F.regexp_extract_all(blob, F.lit(PART), F.lit(k)) for k in (1, 2))
    parts = F.filter(F.arrays_zip(names.alias("k"), F.transform(values, strip).alias("v")), lambda e: e["v"] != "")
    return bound(parts, lambda ps: F.map_from_entries(F.filter(ps, lambda e, i: ~F.exists(F.slice(ps, i + 2, F.size(ps)), lambda later: later["k"] == e["k"]))))
