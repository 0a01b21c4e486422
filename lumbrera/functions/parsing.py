"""Functions over JSON texts, labels with prefixes and lines of references."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip_prefixes(c: Column, prefixes: Sequence[str]) -> Column:
    """A text without the prefixes, one after the other and repeatedly ("tesis que para obtener el grado de ...")."""
    alt = "|".join(re.escape(p) for p in sorted(prefixes, key=len, reverse=True))
    return F.trim(F.regexp_replace(F.trim(c), rf"(?i)^(?:(?:{alt})\s+)+", ""))


def by_keyword(c: Column, rules: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """The value of the first rule (pattern, value) that a text matches."""
    out = None
    for pattern, value in rules:
        out = F.when(c.rlike(pattern), value) if out is None else out.when(c.rlike(pattern), value)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def first_object(text: str | None) -> str | None:
    """The first JSON object in a text, as JSON; null if none parses."""
    t = text or ""
    for m in re.finditer(r"\{", t):
        try:
            value, _ = json.JSONDecoder().raw_decode(t[m.start() :])
        except ValueError:
            continue
        return json.dumps(value, ensure_ascii=False)
    return None


@F.pandas_udf(T.StringType())
def json_object(s: pd.Series) -> pd.Series:
    return s.map(first_object)


def json_safe(value):
    """A value without numbers that JSON can't hold: NaN and infinities become null."""
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, dict):
        return {str(k): json_safe(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [json_safe(v) for v in value]
    return value


def whitelist(value: dict, fields: dict[str, tuple[type, int]]) -> dict:
    """Known fields of the right type, texts and lists cut to their length."""
    return {k: value[k][:n] if kind in (str, list) else value[k] for k, (kind, n) in fields.items() if isinstance(value.get(k), kind)}


def in_json_list(c: Column, array_text: Column) -> Column:
    """Whether a value is in a JSON array of strings."""
    return F.coalesce(F.array_contains(F.from_json(array_text, "array<string>"), c), F.lit(False))


#: Fixed value: how a line of references begins or what it holds.
_REFERENCE = re.compile(r"^(?:\[?\d+[\].)]\s*)?[A-ZÁÉÍÓÚÑ][\w'’-]+(?:\s[A-ZÁÉÍÓÚÑ][\w'’-]+)?,\s.+\(?\b(?:1[5-9]|20)\d\d\b")


def references(text: str | None, most: int = 15) -> list[str]:
    """Lines that are references, cleaned, each once, in order; ``most`` is what a page shows."""
    out: list[str] = []
    for line in re.split(r"[\n\r]+", text or ""):
        t = re.sub(r"\s+", " ", re.sub(r"^\s*(?:[-•*]|\[?\d+[\].)])\s*", "", line)).strip()
        if _REFERENCE.match(t) and t not in out:
            out.append(t)
    return out[:most]


@F.pandas_udf(T.ArrayType(T.StringType()))
def reference_lines(s: pd.Series) -> pd.Series:
    return s.map(references)


def origin(note: Column, home: str) -> Column:
    """Where a document comes from by its note: ``home`` in it means our own, any other note another institution."""
    return F.when(F.coalesce(note, F.lit("")).contains(home), "propia").when(F.coalesce(F.trim(note), F.lit("")) != "", "externa/incorporada").otherwise("")


def normalised(body: Column, fields: dict[str, tuple[Sequence[str], str, str]]) -> Column:
    """struct: a JSON object's fields under their standard names. ``fields`` maps a name to (names it may have, in order
    of preference, its type, its default as text); what is missing, null or of another type takes the default."""
    out = []
    for name, (aliases, kind, default) in fields.items():
        found = [F.get_json_object(body, f"$.{a}").try_cast(kind) for a in aliases]
        out.append(F.coalesce(*found, F.lit(default).cast(kind)).alias(name))
    return F.struct(*out)
