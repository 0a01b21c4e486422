"""Text functions as column expressions: everything stays in the JVM unless a docstring says otherwise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Accented letters and their plain ones.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC"
#: Pairs of garbled and right letters, longest first.
REPAIRS = (("Ã¡", "á"), ("Ã©", "é"), ("Ã\xad", "í"), ("Ã³", "ó"), ("Ãº", "ú"), ("Ã±", "ñ"), ("Ã¼", "ü"))


def missing(c: Column) -> Column:
    """True for null, empty and blank strings."""
    return F.coalesce(F.trim(c), F.lit("")) == ""


def nonempty(c: Column) -> Column:
    """The trimmed string, null if nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def clean(c: Column) -> Column:
    """Null becomes empty; line breaks and runs of white space become one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))


def unaccent(c: Column) -> Column:
    """Latin letters without accents, by translation; see unaccent_any for the whole of Unicode."""
    return F.translate(c, ACCENTED, PLAIN)


@F.pandas_udf(T.StringType())
def unaccent_any(s: pd.Series) -> pd.Series:
    """Any letters without combining marks. Runs in Python, by Arrow batches; ASCII passes untouched."""
    return s.map(lambda x: x if x is None or x.isascii() else "".join(c for c in unicodedata.normalize("NFD", x) if not unicodedata.combining(c)))


@F.pandas_udf(T.StringType())
def compose(s: pd.Series) -> pd.Series:
    """Compatibility composition (NFKC). Runs in Python, by Arrow batches."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def key(c: Column) -> Column:
    """Lower case, plain letters, all but letters and digits one blank."""
    return F.trim(F.regexp_replace(unaccent(F.lower(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", " "))


def word_key(c: Column) -> Column:
    """As key, but Unicode word characters (with underscore and digits) stay."""
    return F.trim(F.regexp_replace(F.regexp_replace(unaccent(F.lower(F.coalesce(c, F.lit("")))), r"(?U)[^\w\s]", " "), r"\s+", " "))


def upper_key(c: Column, drop: str) -> Column:
    """Upper case, plain letters, without the word ``drop``."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(unaccent(F.coalesce(c, F.lit("")))), rf"\b{drop}\b", " "), r"\s+", " "))


def replace_all(c: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    """Literal replacements, one after the other."""
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def first_nonempty(*cs: Column) -> Column:
    return F.coalesce(*[nonempty(c) for c in cs])


def split_list(c: Column, sep: str = r"\|") -> Column:
    """Trimmed parts of a delimited list, empty ones left out; the empty array for null."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), sep), lambda x: F.trim(x)), lambda x: x != "")


def clean_list(c: Column, sep: str = r"\|") -> Column:
    """As split_list, each value once, where it is first seen."""
    return F.array_distinct(split_list(c, sep))


def invert_name(c: Column) -> Column:
    """``A, B`` becomes ``B A``; a name without a comma stays."""
    return F.when(F.instr(c, ",") > 0, F.trim(F.concat_ws(" ", F.trim(F.regexp_extract(c, r"(?s)^[^,]*,(.*)$", 1)), F.trim(F.substring_index(c, ",", 1))))).otherwise(F.trim(c))


def two_segments(c: Column) -> Column:
    """The first two of the parts between commas."""
    return F.substring_index(c, ",", 2)


def clean_name(c: Column) -> Column:
    """A person's name without subfield marks, roles, dates of life, closing punctuation and digits."""
    out = F.regexp_replace(clean(c), r"\$[a-z]", " ")
    out = F.regexp_replace(out, r"(?i),?\s*(asesora?|directora?|tutora?|autora?|sustentante)\.?$", "")
    out = F.regexp_replace(out, r",?\s*\d{4}\s*-?\s*(\d{4})?\.?$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"[\s.,;:/]+$", ""), r"\s+", " "))


def ui_label(values: Column, none: str) -> Column:
    """``X`` or ``X · +n más`` for an array of names, ``none`` for an empty one."""
    n = F.size(values)
    return F.when(n < 1, F.lit(none)).when(n == 1, F.try_element_at(values, F.lit(1))).otherwise(F.concat(F.try_element_at(values, F.lit(1)), F.lit(" · +"), (n - 1).cast("string"), F.lit(" más")))


def boolean(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c.cast("string"), F.lit("")))).isin("true", "1", "yes", "si", "sí")


def padded(c: Column, width: int) -> Column:
    """Left-padded with zeros; longer values stay whole."""
    t = F.trim(c)
    return F.when(F.length(t) >= width, t).otherwise(F.lpad(t, width, "0"))


def without_point_zero(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"\.0$", "")


def id_number(c: Column) -> Column:
    return F.try_to_number(F.substring(c, 4, 20), F.lit("9999999999")).cast("long")


def url_param(c: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(c, rf"[?&]{name}=(\d+)", 1), F.lit(""))


def objectives(c: Column) -> Column:
    """Objectives written on lines, or divided by semicolons or full stops."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\n|;|\.\s+"), lambda x: F.trim(x)), lambda x: x != "")


def sanitise(c: Column) -> Column:
    """Free text made safe to show: control, format and private characters gone, angle brackets harmless, runs of the
    same non-digit unit cut to three, runs of blanks single. Line breaks stay, at most two together, without blanks
    around them. Compose beforehand (see compose) for compatibility forms."""
    out = F.translate(F.coalesce(c, F.lit("")), "\t\r", "  ")
    out = F.regexp_replace(out, r"[\p{Cc}\p{Cf}\p{Co}\p{Cs}&&[^\n]]", "")
    out = F.translate(out, "<>", "‹›")
    for pattern, to in ((r"(?s)(\D{1,40}?)\1{4,}", "$1$1$1"), ("[ \u00a0]{2,}", " "), (" *\n *", "\n"), ("\n{3,}", "\n\n"), (r"^\s+|\s+$", "")):
        out = F.regexp_replace(out, pattern, to)
    return out


#: Patterns of texts that try to give orders to a reader, looked for after sanitise().
INJECTIONS = (
    r"(?i)\b(ignora|olvida|omite|descarta)\w*\s+(\w+\s+){0,3}(instrucci|indicaci|reglas|anterior)",
    r"(?i)\b(ignore|disregard|forget)\s+(\w+\s+){0,3}(instructions|rules|previous|above)",
    r"(?i)\b(system|developer)\s*(prompt|message|mensaje)",
    r"(?i)\bprompt\s+(del\s+)?sistema\b",
    r"(?im)^\s*(system|assistant|user|sistema|asistente)\s*:",
    r"(?i)\b(act[úuÚ]a|comp[óoÓ]rtate|responde)\s+como\b",
    r"(?i)\b(you are now|from now on|a partir de ahora eres)\b",
    r"(?i)‹/?\s*(entrada_usuario|system|instructions?|instrucciones)",
)


def injection_count(*cs: Column) -> Column:
    """How many of the known patterns stand in the texts put together."""
    joined = F.concat_ws("\n", *cs)
    total = F.lit(0)
    for p in INJECTIONS:
        total = total + joined.rlike(p).cast("int")
    return total


def local_day(ts: Column, hours: int = 6) -> Column:
    """Day of a time in a zone that many hours behind UTC."""
    return F.to_date(ts.cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS"))


def month_key(ts: Column, hours: int = 6) -> Column:
    return F.date_format(ts.cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS"), "yyyy-MM")


def next_month(ts: Column, hours: int = 6) -> Column:
    return F.add_months(F.trunc(local_day(ts, hours), "month"), 1)


def next_reset(ts: Column, hour: int = 6, minute: int = 5) -> Column:
    """The next time of day ``hour``:``minute`` after ``ts``."""
    t = ts.cast("timestamp")
    today = F.date_trunc("day", t) + F.expr(f"INTERVAL {hour} HOURS") + F.expr(f"INTERVAL {minute} MINUTES")
    return F.when(t < today, today).otherwise(today + F.expr("INTERVAL 1 DAY"))


def rate_key(ip: Column) -> Column:
    """An address as rate limits count it: IPv4 whole, IPv6 by its first four groups."""
    return F.when(ip.contains(":"), F.concat(F.array_join(F.slice(F.split(F.regexp_replace(ip, "::", ":0:0:0:0:"), ":"), 1, 4), ":"), F.lit("::/64"))).otherwise(ip)


#: Letters that sound alike in Spanish, in the order in which they become one; 1 stands for ch.
SOUNDS = (("[^a-z]", ""), ("ch", "1"), ("ll", "y"), ("qu", "k"), ("ph", "f"), ("c(?=[ei])", "s"), ("c", "k"), ("z", "s"), ("v", "b"), ("w", "u"), ("h", ""), ("y", "i"))


def phonetic(c: Column) -> Column:
    """Spanish sound key of all words together: letters that sound alike become one, doubled letters single."""
    out = unaccent(F.lower(c))
    for a, b in (*SOUNDS, (r"(.)\1+", "$1")):
        out = F.regexp_replace(out, a, b)
    return out
