"""Reading tables, lines, arrays, pages and blobs."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def columns(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """A parquet table's named columns; only they are read."""
    return spark.read.parquet(path).select(*[F.col(f"`{c}`") for c in names])


def sql_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM parquet.`{path}`")


def batches(df: DataFrame, f, schema: str, size: int = 10_000) -> DataFrame:
    """``f`` over Arrow batches of at most ``size`` rows, each a pandas frame."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for lo in range(0, len(pdf), size):
                yield f(pdf.iloc[lo : lo + size])

    return df.mapInPandas(run, schema)


def json_lines(spark: SparkSession, glob: str, schema: str, without: Sequence[str] = ()) -> DataFrame:
    """JSON lines of all files of a pattern; lines that don't parse come out as rows of nulls."""
    return spark.read.schema(schema).json(glob).drop(*without)


def json_documents(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """One JSON document a file, with the file's path."""
    return spark.read.schema(schema).option("multiLine", True).json(folder).withColumn("path", F.input_file_name())


def csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all columns strings, nothing null."""
    return spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').csv(path).na.fill("")


def _npy_head(head: bytes) -> tuple[int, np.dtype, tuple[int, int]]:
    """(where the data begin, type, shape) from the first bytes of a .npy file."""
    import io

    f = io.BytesIO(head)
    version = np.lib.format.read_magic(f)
    shape, fortran, dtype = np.lib.format.read_array_header_1_0(f) if version == (1, 0) else np.lib.format.read_array_header_2_0(f)
    if fortran or len(shape) != 2:
        raise ValueError("only two-dimensional arrays in row order")
    return f.tell(), dtype, shape


def npy(spark: SparkSession, path: str, rows: int = 4096) -> DataFrame:
    """(path, row, v): rows of two-dimensional float .npy files (of all files of a folder, numbered within each file).

    Files are read where Spark reads files, on any storage: each task gets the content of its files and turns it into
    batches of ``rows``. A single file may hold 2 GB at most; larger collections are written as several."""

    def read(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for name, content in zip(pdf["path"], pdf["content"]):
                at, dtype, (n, d) = _npy_head(content[:4096])
                x = np.frombuffer(content, dtype, n * d, at).reshape(n, d)
                for lo in range(0, n, rows):
                    yield pd.DataFrame({"path": name, "row": np.arange(lo, min(lo + rows, n)), "v": pd.Series(list(x[lo : lo + rows].astype(np.float32)), dtype=object)})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, "path string, row long, v array<float>")


def blob(content: bytes, manifest: list[dict]) -> dict[str, np.ndarray]:
    """Arrays of a packed file, by a manifest of name, dtype, byteOffset and count."""
    return {m["name"]: np.frombuffer(content, dtype=np.dtype(m["dtype"]).newbyteorder("<"), count=m["count"], offset=m["byteOffset"]) for m in manifest}


# Pages -------------------------------------------------------------------------------------------------------------

# The head of a field: a tag of three digits, up to three indicators, a dash and the label.
_TAG = re.compile(r"(?P<tag>\d{3})(?P<ind>[^-]*)-(?P<label>.*)", re.S)
FIELDS = T.ArrayType(T.StructType([T.StructField("tag", T.StringType()), T.StructField("ind", T.StringType()), T.StructField("label", T.StringType()), T.StructField("subfields", T.ArrayType(T.StringType()))]))


def _text(html: str) -> str:
    return re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]+>", " ", html))).strip()


def parse_marc(html: str | None) -> list[tuple[str, str, str, list[str]]]:
    """Fields of a record page: rows whose first cell is ``tag ind - label`` and whose other cells are subfields; rows
    without such a cell go on with the field before."""
    out: list[tuple[str, str, str, list[str]]] = []
    for row in re.findall(r"(?is)<tr[^>]*>(.*?)</tr>", html or ""):
        cells = [_text(c) for c in re.findall(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>", row)]
        if not cells:
            continue
        m = _TAG.match(cells[0])
        ind = m["ind"].strip() if m else ""
        if m and m["label"].strip() and len(ind) <= 3 and all(c.isalnum() or c in "# " for c in ind):
            out.append((m["tag"], ind, m["label"].strip(), [c for c in cells[1:] if c]))
        elif out:
            out[-1][3].extend(c for c in cells if c)
    return out


@F.pandas_udf(FIELDS)
def marc_fields(html: pd.Series) -> pd.Series:
    return html.map(parse_marc)


RESULT = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("biblionumber", "title", "year", "authors", "advisors", "url")]))


def parse_results(html: str | None) -> list[tuple]:
    """Entries of a page of search results: the number in the link, the linked title, the year, and labelled people."""
    out = []
    for entry in re.split(r"(?i)(?=<a[^>]+biblionumber=)", html or "")[1:]:
        link = re.match(r'(?is)<a[^>]+href="([^"]*biblionumber=(\d+)[^"]*)"[^>]*>(.*?)</a>', entry)
        if not link:
            continue
        rest = _text(entry[link.end() :])
        year = re.search(r"\b(1[5-9]\d\d|20\d\d)\b", rest)
        named = lambda label, rest=rest: (m[1].strip() if (m := re.search(rf"(?i){label}\s*:\s*([^|;]+?)(?=\s*(?:\||;|\w+\s*:|$))", rest)) else "")
        out.append((link[2], _text(link[3]), year[1] if year else "", named("autor(?:es)?"), named("asesor(?:es)?"), unescape(link[1])))
    return out


@F.pandas_udf(RESULT)
def search_results(html: pd.Series) -> pd.Series:
    return html.map(parse_results)


DETAIL = T.StructType([T.StructField(n, T.StringType()) for n in ("doc_number", "full_text", "year", "labels")])


def parse_detail(html: str | None) -> tuple:
    """(document number, link to the full text, year, labels) of a record's detail page; the year falls back to the
    first one in the text."""
    h = html or ""
    number = re.search(r"doc_number=(\d+)", h)
    link = re.search(r'(?i)href="([^"]+\.pdf[^"]*)"', h)
    labels = dict(re.findall(r"(?is)<t[hd][^>]*>\s*([^<:]{2,40}):?\s*</t[hd]>\s*<td[^>]*>(.*?)</td>", h))
    year = re.search(r"\b(?:1[5-9]|20)\d\d\b", " ".join(v for k, v in labels.items() if re.search(r"(?i)año|fecha|year", k)) or _text(h))
    return number[1] if number else None, unescape(link[1]) if link else None, year[0] if year else None, "|".join(f"{k.strip()}={_text(v)}" for k, v in labels.items())


@F.pandas_udf(DETAIL)
def details(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse_detail(h) for h in html], columns=["doc_number", "full_text", "year", "labels"])


def manifest_status(biblionumber: Column, year: Column, target: Column, listed: Column) -> Column:
    """What becomes of a row of search results."""
    blank = F.coalesce(F.trim(biblionumber), F.lit("")) == ""
    return F.when(blank, "missing_biblionumber").when(year.isNotNull() & (year != target), "out_of_year").when(listed, "already_in_manifest").otherwise("pending_detail")


def stop_after(pages: Sequence[Sequence[str]], last: int, empty: int = 3, same: int = 3) -> int:
    """How many pages of results to read: until ``empty`` empty ones in a row, ``same`` repeats of one page's entries,
    or the last offset."""
    blank = repeated = 0
    before = None
    for k, p in enumerate(pages):
        blank = blank + 1 if not p else 0
        repeated = repeated + 1 if p and tuple(p) == before else 0
        before = tuple(p) if p else before
        if blank >= empty or repeated >= same or k >= last:
            return k + 1
    return len(pages)


REQUEST = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("problematiza", T.StringType()), T.StructField("keywords", T.ArrayType(T.StringType())),
    T.StructField("objectives", T.ArrayType(T.StringType())), T.StructField("program", T.StringType()), T.StructField("degree", T.StringType()),
    T.StructField("study_period", T.StructType([T.StructField("applies", T.BooleanType()), T.StructField("start_year", T.IntegerType()), T.StructField("end_year", T.IntegerType()), T.StructField("label", T.StringType())])),
])


def requests(df: DataFrame, body: str) -> DataFrame:
    """Request bodies (JSON text) as rows, with the list of what is wrong with each; bodies that don't parse are
    reported, not dropped."""
    r = df.withColumn("r", F.from_json(body, REQUEST))
    n = lambda c: F.length(F.trim(F.coalesce(c, F.lit(""))))
    wrong = F.filter(F.array(
        F.when(F.col("r").isNull() | F.col("r.title").isNull(), F.lit("title missing")), F.when(F.col("r.title").isNotNull() & (n(F.col("r.title")) < 3), F.lit("title too short")), F.when(n(F.col("r.title")) > 400, F.lit("title too long")),
        F.when(n(F.col("r.problematiza")) > 2000, F.lit("problematiza too long")), F.when(F.size("r.keywords") > 12, F.lit("too many keywords")), F.when(F.size("r.objectives") > 8, F.lit("too many objectives")),
        F.when(n(F.col("r.program")) > 160, F.lit("program too long")), F.when(n(F.col("r.degree")) > 40, F.lit("degree too long")),
        F.when(n(F.col("r.study_period.label")) > 40, F.lit("study period's label too long")), F.when(F.col("r.study_period.start_year") > F.col("r.study_period.end_year"), F.lit("study period ends before it starts")),
    ), lambda x: x.isNotNull())
    return r.withColumn("errors", wrong)


#: What a keyword of a schema asks of a value: (the values it speaks of, whether they keep it, what is said if not).
_KINDS = {"object": dict, "array": list, "string": str, "number": (int, float), "integer": int, "boolean": bool}
_SIZED = {"minLength": (str, len, -1), "maxLength": (str, len, 1), "minItems": (list, len, -1), "maxItems": (list, len, 1), "minimum": ((int, float), abs, -1), "maximum": ((int, float), abs, 1)}


def _flat(schema: dict, path: str = "$") -> dict[str, dict]:
    """Each place of a schema by its path; ``[]`` stands for any element."""
    out = {path: schema}
    for name, inner in schema.get("properties", {}).items():
        out |= _flat(inner, f"{path}.{name}")
    return out | (_flat(schema["items"], f"{path}[]") if "items" in schema else {})


def schema_errors(value, schema: dict) -> list[str]:
    """What a JSON value breaks of a schema (type, required, properties, items, enum, lengths and bounds)."""
    places = _flat(schema)
    out: list[str] = []
    stack = [("$", "$", value)]
    while stack:
        path, place, v = stack.pop()
        rules = places.get(place)
        if rules is None:
            out.append(f"{path}: unknown")
            continue
        kind = rules.get("type")
        if kind and (not isinstance(v, _KINDS[kind]) or isinstance(v, bool) and kind != "boolean"):
            out.append(f"{path}: not {kind}")
            continue
        if v not in rules.get("enum", (v,)):
            out.append(f"{path}: not allowed")
        for word, (speaks_of, measure, sign) in _SIZED.items():
            if word in rules and isinstance(v, speaks_of) and not isinstance(v, bool):
                size = v if measure is abs else measure(v)
                if (size - rules[word]) * sign > 0:
                    out.append(f"{path}: too {'small' if sign < 0 else 'large'}")
        if isinstance(v, dict):
            out += [f"{path}.{k}: missing" for k in rules.get("required", ()) if k not in v]
            known = rules.get("properties", {})
            stack += [(f"{path}.{k}", f"{place}.{k}", x) for k, x in reversed(v.items()) if k in known or rules.get("additionalProperties") is False]
        elif isinstance(v, list) and "items" in rules:
            stack += [(f"{path}[{i}]", f"{place}[]", x) for i, x in reversed(list(enumerate(v)))]
    return out


def schema_checked(body: Column, schema: dict) -> Column:
    """array<string>: what each JSON text breaks of a schema; a text that isn't JSON breaks it as a whole, null stays."""
    import json

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def check(texts: pd.Series) -> pd.Series:
        def errors(t):
            try:
                return None if t is None else schema_errors(json.loads(t), schema)
            except ValueError:
                return ["$: not JSON"]

        return pd.Series([errors(t) for t in texts], dtype=object)

    return check(body)
