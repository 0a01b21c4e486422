"""Keeping people's names out of what is published."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HIDDEN = "(título no disponible)"
#: Phrases after which a title names people.
_ROLE = r"(?:tesis que|tesina que|presentada? por|para obtener|para optar|que presenta|autor(?:a|es)?|asesor(?:a|es)?|director(?:a)?(?: de tesis)?|sustentante)"
_STRONG = re.compile(rf"\s/\s*(?:{_ROLE}|por\b|[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+(?:\s[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+){{1,4}}\s*(?:[;,.]|$))", re.I)
_PHRASE = re.compile(rf"[\s,.:;]+(?:{_ROLE})\b", re.I)
LEAK = rf"(?i)\s/\s*\S|\b(?:tesis que|presentada? por|para obtener el|asesor(?:a|es)?\s*:|sustentante)\b"


def cut_title(title: str | None) -> str | None:
    """A title without its statement of responsibility: at a slash that names a role or people, else at the last slash
    with blanks around it, else at a phrase that begins such a statement. A slash inside a word group stays."""
    if title is None:
        return None
    t = title.strip()
    m = _STRONG.search(t)
    if m and m.start() > 5:
        t = t[: m.start()]
    elif " / " in t:
        t = t[: t.rindex(" / ")]
    m = _PHRASE.search(t)
    if m and m.start() > 15:
        t = t[: m.start()]
    return t.strip(" /,;:") or None


@F.pandas_udf(T.StringType())
def title_only(s: pd.Series) -> pd.Series:
    return s.map(cut_title)


def simple_cut(title: Column) -> Column:
    """The part before the first slash with blanks around it."""
    return F.trim(F.substring_index(title, " / ", 1))


_PERSON = re.compile(r"[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+\s+[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+")


def cut_mention(title: str | None) -> str | None:
    """A title cut at the first mark beyond its 15th character that a person's name follows."""
    if title is None:
        return None
    places = [m.start() for m in re.finditer(r"\s[/|]\s|\.\s|;\s", title) if m.start() > 15 and _PERSON.search(title, m.end()) and re.search(rf"(?i){_ROLE}", title[m.end() :])]
    return title[: min(places)].strip() if places else title


@F.pandas_udf(T.StringType())
def without_mentions(s: pd.Series) -> pd.Series:
    return s.map(cut_mention)


def leaks(title: Column) -> Column:
    return F.coalesce(title.rlike(LEAK), F.lit(False))


def suppressed(title: Column) -> Column:
    """The title, or a fixed text where it would name someone."""
    return F.when(leaks(title), F.lit(HIDDEN)).otherwise(title)


def forbidden_fields(df: DataFrame, names: set[str]) -> list[str]:
    """Paths of fields, at any depth, whose name is forbidden."""
    found: list[str] = []

    def walk(kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                p = f"{path}.{f.name}".lstrip(".")
                if f.name.lower() in names:
                    found.append(p)
                walk(f.dataType, p)
        elif isinstance(kind, T.ArrayType):
            walk(kind.elementType, path + "[]")
        elif isinstance(kind, T.MapType):
            walk(kind.valueType, path + "{}")

    walk(df.schema, "")
    return found
