"""Encoding a corpus with a public byte-level BPE, as a reduction over a monoid of encoded pieces.

An encoded piece is a text with its ids. Two neighbours are joined by re-encoding a window around their border, grown
until both its ends are cuts whose outside can't change: a place where white space follows a character that is none.
There the pattern that splits text before merging always begins a new match, whatever stands on either side, and
merges never cross matches. So the ids outside the window are final, and ids(a + b) doesn't depend on where the text
was divided. Joining is associative, so pieces of one text can be encoded in different tasks and joined in any order.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = os.environ.get("LUMBRERA_TOKENIZERS", "/opt/tokenizers")
#: Characters encoded at once at a leaf of the tree, and characters of the pieces that tasks share.
LEAF = 2048
PIECE = 1 << 18
_LOADED: dict[str, object] = {}

#: Fixed value: the splitting pattern of the public byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(name: str = "byte_bpe_50k", folder: str = TOKENIZERS):
    """The tokenizer of ``<folder>/<name>.tiktoken``, loaded once in a process."""
    key = f"{folder}/{name}"
    if key not in _LOADED:
        import tiktoken

        with open(f"{key}.tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _LOADED[key] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return _LOADED[key]


def _is_cut(left: str, right: str) -> bool:
    """True only where a match surely begins between the two characters. Narrower than need be: white space other
    than blank and line feed, and characters whose class is in doubt, never count."""
    return right in " \n" and (left.isalnum() or left in ".,;:!?)]}\"'-_/%*#")


def _last_cut(text: str, window: int) -> int:
    """The start of the shortest tail, of about ``window`` characters or more, that begins at a cut; 0 if none does."""
    for i in range(max(len(text) - window, 0), 0, -1):
        if _is_cut(text[i - 1], text[i]):
            return i
    return 0


def _first_cut(text: str, window: int) -> int:
    for i in range(max(window, 1), len(text)):
        if _is_cut(text[i - 1], text[i]):
            return i
    return len(text)


def join(a: tuple[str, list[int]], b: tuple[str, list[int]], encode, window: int = 16) -> tuple[str, list[int]]:
    """The encoded piece of the two texts put together. ``window`` is where the border's window starts to grow."""
    (left, x), (right, y) = a, b
    if not left or not right:
        return b if not left else a
    i, j = _last_cut(left, window), _first_cut(right, window)
    n, m = len(encode(left[i:])) if i else len(x), len(encode(right[:j])) if j < len(right) else len(y)
    return left + right, x[: len(x) - n] + encode(left[i:] + right[:j]) + y[m:]


def encode_tree(text: str, encode, leaf: int = LEAF) -> list[int]:
    """Ids of a text by halves: each half is encoded by the same rule, then both are joined."""

    def piece(lo: int, hi: int) -> tuple[str, list[int]]:
        if hi - lo <= leaf:
            return text[lo:hi], encode(text[lo:hi])
        mid = (lo + hi) // 2
        return join(piece(lo, mid), piece(mid, hi), encode)

    return piece(0, len(text))[1] if text else []


def reduce_pieces(pieces: list[tuple[str, list[int]]], encode) -> list[int]:
    """Joins encoded pieces of one text, in order, pairwise up a tree."""
    while len(pieces) > 1:
        pieces = [join(pieces[k], pieces[k + 1], encode) if k + 1 < len(pieces) else pieces[k] for k in range(0, len(pieces), 2)]
    return pieces[0][1] if pieces else []


def encode_corpus(docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, piece: int = PIECE) -> DataFrame:
    """(key, ids) of every row: the ids of ``text`` without special tokens.

    Null and empty texts have an empty list. Rows with equal keys stay separate as long as their texts fit one piece;
    longer texts are put together by key, which must then be unique. Other columns are dropped, whatever their names.
    Texts beyond ``piece`` characters are encoded piecewise in different tasks and joined by key; all others are
    encoded where they are read, without a shuffle.
    """
    src = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    kind = src.schema["k"].dataType.simpleString()

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, folder)
        for pdf in batches:
            yield pd.DataFrame({"k": pdf["k"], "ids": [encode_tree(t, encode) for t in pdf["t"]]})

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, folder)
        for pdf in batches:
            yield pdf.assign(ids=[encode_tree(t, encode) for t in pdf["t"]])

    def rejoin(pdf: pd.DataFrame) -> pd.DataFrame:
        encode = encoder(tokenizer, folder)
        pdf = pdf.sort_values("at")
        return pd.DataFrame({"k": pdf["k"].iloc[:1], "ids": [reduce_pieces([(t, list(i)) for t, i in zip(pdf["t"], pdf["ids"], strict=True)], encode)]})

    short = src.where(F.length("t") <= piece).mapInPandas(whole, f"k {kind}, ids array<int>")
    long = (
        src.where(F.length("t") > piece)
        .select("k", "t", F.explode(F.sequence(F.lit(0), F.floor((F.length("t") - 1) / piece).cast("int"))).alias("at"))
        .select("k", "at", F.expr(f"substring(t, at * {piece} + 1, {piece})").alias("t"))
        .repartition("k", "at")
        .mapInPandas(part, f"k {kind}, at int, t string, ids array<int>")
        .groupBy("k")
        .applyInPandas(rejoin, f"k {kind}, ids array<int>")
    )
    return short.unionByName(long).withColumnRenamed("k", key)


def decode(ids: list[int], tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> str:
    """The text of a list of ids."""
    table = _LOADED.get(f"{folder}/{tokenizer}/bytes")
    if table is None:
        with open(f"{folder}/{tokenizer}.tiktoken", "rb") as f:
            table = {int(b): base64.b64decode(a) for a, b in (line.split() for line in f if line.strip())}
        _LOADED[f"{folder}/{tokenizer}/bytes"] = table
    return b"".join(table[i] for i in ids).decode("utf-8", "replace")
