"""Text read in a wrong encoding: finding it and restoring it by minimum description length.

Each name-like segment of a value is decoded along every chain of steps that its characters allow. A step undoes one
misreading: the characters go back to the bytes of the encoding they were read in, and these bytes are read as what
they were. A candidate costs its size under the cheapest per-language zstandard dictionary, a price for characters
outside that language's alphabet, and a price for each step; the cheapest candidate wins, and a tie keeps the text.
One more channel loses letters for good: marks inside a name (replacement marks, question marks at letters, symbols)
stand for accented letters, priced as plain ones and a few bits a mark; where that description is the cheaper one, the segment is reported, and
the original comes back where exactly one clean value of the table fits the letters that are left.

Every segment beyond ASCII competes. Left out is only what can't win: decodings from UTF-8 need two neighbours beyond
ASCII, and a candidate whose prices alone reach the cost of the text needs no compression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import md5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbrera.plans.lineage import cut, spread

#: Occurrences of words that a language's dictionary is trained on, in proportion to their counts in all clean values; bits for a step, a character of another language, one of no language, an inner capital.
DIGEST = 60_000
DICTIONARY = 1 << 15  # bytes
STEP_UTF8, STEP_BYTE, FOREIGN, SYMBOL, INNER = 4, 16, 12, 20, 8
#: Bits for the channel that loses letters and for each letter lost, its accent included; what a mark may stand for.
STEP_LOST, LOST = 8, 4
FILLS = "aeioun"
DEPTH = 3
#: Letters beyond ASCII of the languages that have a dictionary of their own.
ALPHABETS = {"es": "áéíóúüñÁÉÍÓÚÜÑ", "pt": "áéíóúüñÁÉÍÓÚÜÑãõâêôàçÃÕÂÊÔÀÇ"}
OTHER_BITS = {"es": 0, "pt": 4, "other": 12}
#: Fixed values: (read as, written as), the likelier first: each later one of the byte steps costs a bit more.
UTF8_READ_AS = ("cp1252", "mac_roman", "cp437", "cp850", "cp1251", "cp1250")
BYTES_READ_AS = (("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1251", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp850"), ("koi8_r", "cp1252"), ("cp1253", "cp1252"))
_SEQUENCE = re.compile("[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
_DELIMITER = re.compile(r'(\s[ye&/]\s|\s//\s|[|;/\n\r\t"\[\]])')
_ASKED = re.compile(r"(?<=[^\W\d_])\?|\?(?=\?*[^\W\d_])")
_LOST = re.compile("�|" + _ASKED.pattern)
_TWO, _BEYOND = re.compile("[^\x00-\x7f]{2}"), re.compile("[^\x00-\x7f]")
#: Symbols that stand in no name: box drawing, mathematics, controls of the upper half, signs of the Latin-1 block.
_SYMBOL = re.compile(r"[\x80-\x9f∀-⋿─-▟⌐⌠⌡©®±³²¹¼½¾¬¶¤¦§¨¯´¸¡¿\xad√∫≠≤≥]")


def _table(codec: str) -> dict[str, int]:
    """Characters of the upper half; bytes without one stand for themselves, as browsers read them."""
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
        if codec == "cp1252" and b < 0xA0:
            out[chr(b)] = b  # as Latin-1 has it
    return out


_TABLES = {c: _table(c) for c in {*UTF8_READ_AS, *(x for p in BYTES_READ_AS for x in p)}}
_BACK = {c: {b: ch for ch, b in reversed(t.items())} for c, t in _TABLES.items()}


# A character of a lead byte before one of a continuation byte: without it a text holds no sequence.
_LEADS = {c: re.compile(f"[{''.join(re.escape(ch) for ch, b in t.items() if 0xC2 <= b <= 0xF4)}][{''.join(re.escape(ch) for ch, b in t.items() if 0x80 <= b <= 0xBF)}]") for c, t in _TABLES.items()}


def _tidy(text: str, at: set[int]) -> str:
    """Letter case after a value was recased while garbled: a restored letter starts no new capital inside a word."""
    out = list(text)
    for i in sorted(at):
        if 0 < i < len(out) and out[i - 1].islower() and out[i] not in "ÃÂ":
            out[i] = out[i].lower()
            if i + 1 < len(out) and out[i + 1].isupper() and not (i + 2 < len(out) and out[i + 2].isupper()):
                out[i + 1] = out[i + 1].lower()
    return "".join(out)


def undo_utf8(text: str, codec: str) -> str:
    """Characters that are bytes of UTF-8 sequences become the sequences' characters; all others stay."""
    if not _LEADS[codec].search(text):
        return text
    table = _TABLES[codec]
    raw = "".join(c if c < "\x80" else chr(table.get(c, 0x100)) for c in text)
    out, at, last, restored = [], 0, 0, set()
    for m in _SEQUENCE.finditer(raw):
        out.append(text[last : m.start()])
        at += m.start() - last
        try:
            ch = m[0].encode("latin-1").decode("utf-8")
        except UnicodeDecodeError:
            ch = text[m.start() : m.end()]
        restored.add(at)
        out.append(ch)
        at += len(ch)
        last = m.end()
    out.append(text[last:])
    return _tidy("".join(out), restored) if last else text


_BYTES = {(a, b): {c: _BACK[b][n] for c, n in _TABLES[a].items()} for a, b in BYTES_READ_AS}


def undo_bytes(text: str, read_as: str, written_as: str) -> str | None:
    """Every character beyond ASCII is replaced; None if one of them can't come from such bytes."""
    table, found = _BYTES[read_as, written_as], set(_BEYOND.findall(text))
    if not found <= table.keys():
        return None
    for c in found if len(found) == 1 else ():
        return text.replace(c, table[c])
    return text.translate({ord(c): table[c] for c in found})


_RECASED = re.compile("[ãâ](?=[^\\w\\s.,]|[\x80-\x9f]|º|ª|²|³|¹|¼|š|œ|ž|ƒ)")


def candidates(text: str, depth: int = DEPTH, most: float = float("inf")) -> dict[str, tuple[int, str]]:
    """Decoded text -> (bits of its chain, chain), the text itself with an empty chain included. Byte steps whose own
    price and characters' prices reach ``most`` are left out where no further step could follow them."""
    out = {text: (0, "")}
    front = [text]
    for _ in range(depth):
        new = []
        for t in front:
            bits, chain = out[t]
            tried = []
            if _TWO.search(t):
                tried = [(undo_utf8(t, c), STEP_UTF8, f"utf-8<{c}") for c in UTF8_READ_AS]
                recased = _RECASED.sub(lambda m: m[0].upper(), t)
                if recased != t:
                    tried += [(undo_utf8(recased, "cp1252"), STEP_UTF8, "utf-8<cp1252 recased")]
            if not chain:
                last = not tried
                beyond = _BEYOND.findall(t)
                for k, (a, b) in enumerate(BYTES_READ_AS):
                    if not last or STEP_BYTE + k + _least_price(beyond, a, b) < most:
                        tried.append((undo_bytes(t, a, b), STEP_BYTE + k, f"{b}<{a}"))
            for got, price, name in tried:
                if got is not None and got != t and (got not in out or out[got][0] > bits + price):
                    out[got] = (bits + price, f"{chain} {name}".strip())
                    new.append(got)
        front = new
    return out


_SMALL, _BEYOND_CAPITAL = "ß-öø-ÿа-яёά-ώ", "À-ÖØ-ÞА-ЯЁΑ-Ω"
_INNER = re.compile(f"(?<=[a-z{_SMALL}])[A-Z{_BEYOND_CAPITAL}]|(?<=[A-Z{_BEYOND_CAPITAL}])[{_BEYOND_CAPITAL}](?=[a-z{_SMALL}])")


def inner_capitals(text: str) -> int:
    """Capitals behind a small letter, or those beyond ASCII between a capital and a small letter (Latin-1, Cyrillic, Greek)."""
    return len(_INNER.findall(text))


@lru_cache(maxsize=1 << 14)
def _character(c: str) -> tuple[int, int, int]:
    """Bits beside the compressed size of a character beyond ASCII: in any language, in Spanish, in Portuguese."""
    if c in _TYPOGRAPHIC:
        return 0, 0, 0
    symbol = SYMBOL if _SYMBOL.match(c) or not c.isalpha() or ord(c) > 0x24F else 0
    return symbol, 0 if c in ALPHABETS["es"] else FOREIGN, 0 if c in ALPHABETS["pt"] else FOREIGN


def _least_price(beyond: list[str], read_as: str, written_as: str) -> float:
    """Bits beside the compressed size that the characters of a byte step cost at least; infinite if it can't be."""
    table, common, spanish, portuguese = _BYTES[read_as, written_as], 0, OTHER_BITS["es"], OTHER_BITS["pt"]
    for c in beyond:
        if c not in table:
            return float("inf")
        x, y, z = _character(table[c])
        common, spanish, portuguese = common + x, spanish + y, portuguese + z
    return common + min(spanish, portuguese, OTHER_BITS["other"])


class Coder:
    """Description lengths under one dictionary a language."""

    def __init__(self, samples: dict[str, list[str]]) -> None:
        import zstandard as z

        self.coders = {}
        for lang, values in samples.items():
            raw = [v.encode() for v in values]
            try:
                d = z.train_dictionary(DICTIONARY, raw)
            except z.ZstdError:  # too few values to train on: their text serves as it is
                d = z.ZstdCompressionDict(b"\n".join(raw) or b"-" * 8, dict_type=z.DICT_TYPE_RAWCONTENT)
            params = z.ZstdCompressionParameters.from_level(19, source_size=64, dict_size=len(d.as_bytes()), format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
            d.precompute_compress(compression_params=params)
            self.coders[lang] = z.ZstdCompressor(dict_data=d, compression_params=params)
        self.least = {lang: 8 * len(c.compress(b"a")) for lang, c in self.coders.items()}  # no text takes less
        # Other languages have too few values for a dictionary, and garbled ones would slip into it: Spanish's serves
        # them, without a price for their letters but for their being others.

    def bits(self, text: str, most: float = float("inf")) -> float:
        """Description length; infinite if the prices alone reach ``most``."""
        common, spanish, portuguese = INNER * inner_capitals(text) + SYMBOL * len(_INNER_MARK.findall(text)) + (SYMBOL * len(_ASKED.findall(text)) if "?" in text else 0), 0, 0
        for c in _BEYOND.findall(text):
            x, y, z = _character(c)
            common, spanish, portuguese = common + x, spanish + y, portuguese + z
        spanish, portuguese = common + min(spanish + OTHER_BITS["es"], OTHER_BITS["other"]), common + portuguese + OTHER_BITS["pt"]
        best, raw = float("inf"), None
        for price, lang in ((spanish, "es"), (portuguese, "pt")):
            if price + self.least[lang] < min(most, best):
                raw = raw or text.encode("utf-8", "replace")
                best = min(best, 8 * len(self.coders[lang].compress(raw)) + price)
        return best


_TYPOGRAPHIC = "…–—’"
_INNER_MARK = re.compile(r"(?<=[a-zà-öø-ÿ])[–—’](?=[a-zà-öø-ÿ]|$|[\s,])")  # Luc’a, Sim—n: what stands at a letter's place


_INSIDE = re.compile(r"(?<=[a-zà-öø-ÿ])[À-ÖØ-Þ]")  # a capital beyond ASCII behind a small letter


_MARKS = re.compile(_LOST.pattern + "|" + _SYMBOL.pattern)


def lost_bits(text: str, coder: Coder, most: float) -> float:
    """Description length of a text some of whose letters were lost: its marks are letters, at a price; infinite if it
    has none, or no other letter."""
    marks = len(_LOST.findall(text)) + len(_SYMBOL.findall(text))
    if not marks or not re.search(r"[^\W\d_]", text):
        return float("inf")
    price = STEP_LOST + LOST * marks
    if sum(map(str.isupper, text)) > sum(map(str.islower, text)):
        return min(price + coder.bits(_SYMBOL.sub(x, _LOST.sub(x, text)), most - price) for x in FILLS.upper())
    return min(price + coder.bits(_SYMBOL.sub(x, _LOST.sub(x, text)), most - price) for x in FILLS)


def restore(text: str, coder: Coder) -> tuple[str, str, bool]:
    """(restored value, chains, whether it was garbled)."""
    out, chains, garbled = [], [], False
    for k, part in enumerate(_DELIMITER.split(text)):
        if k % 2 or part.isascii() and "?" not in part:
            out.append(part)
            continue
        best, least = part, coder.bits(part)
        for t, (bits, chain) in sorted(candidates(part, most=least).items(), key=lambda x: (x[1][0], x[0])):
            bits += INNER * max(0, len(_INSIDE.findall(t)) - len(_INSIDE.findall(part)))  # a decoding makes no such letters
            if t != part and (cost := coder.bits(t, least - bits) + bits) < least:
                best, least, won = t, cost, chain
        if best != part:
            garbled = True
            chains.append(won)
        if _MARKS.search(best) and lost_bits(best, coder, kept := coder.bits(best)) < kept:
            garbled = True
            chains.append("lost")
        out.append(best)
    return "".join(out), "; ".join(chains), garbled


def _language(value: Column) -> Column:
    return F.when(value.rlike("[ãõçÃÕÇâêôÂÊÔ]"), "pt").when(value.rlike("[äößøåæřěšžčłęąāēīūşğı]|[ÄÖØÅÆŘŠŽČŁŞ]"), "other").otherwise("es")


def _hole_key(value: Column) -> Column:
    """Letters beyond ASCII and lost ones look alike."""
    return F.regexp_replace(value, r"[^\x00-\x7f]|\?", "?")


def digests(clean: DataFrame, least: int = 0) -> dict[str, list[str]]:
    """Training text of each language's dictionary, lines of four words: every word occurs as often as its count in all
    values (v) asks for, the whole scaled to DIGEST occurrences where there are more. Counting covers every value; a
    word whose share makes less than half an occurrence has ``least``: with 1, no word of any value is left out, and
    what is collected is the vocabulary, which hardly grows with the number of values."""
    words = clean.select(_language(F.col("v")).alias("lang"), F.explode(F.split(F.trim("v"), r"\s+")).alias("w")).where(F.col("w") != "")
    counts = cut(words.groupBy("lang", "w").agg(F.count("*").alias("n")), "word-counts")
    out: dict[str, list[str]] = {lang: [] for lang in ALPHABETS}
    for lang, total in counts.groupBy("lang").agg(F.sum("n")).collect():  # a row a language
        if lang in out:
            times = F.greatest(F.round(F.col("n") * (min(DIGEST, total) / total)).cast("int"), F.lit(least))
            rows = counts.where((F.col("lang") == lang) & (times > 0)).select("w", times).collect()
            mixed = [w for _, w in sorted((md5(f"{w} {i}".encode()).digest(), w) for w, n in rows for i in range(n))]
            out[lang] = [" ".join(mixed[i : i + 4]) for i in range(0, len(mixed), 4)]
    return out


def find_garbled(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """(key, campo, valor, restaurado, cadena) for each value garbled by a wrong encoding.

    ``restaurado`` is the original as far as it can be restored, null where letters are lost for good. Null, empty
    and plain ASCII values (without question marks inside words) are never garbled. Equal values get equal results;
    work is done once per distinct value. The dictionaries are built from the counts of all words of all clean values,
    rare ones included; counting, decoding and matching cover all rows.
    """
    spark = df.sparkSession
    cells = df.select(F.col(f"`{key}`").alias("k"), F.explode(F.array(*[F.struct(F.lit(c).alias("campo"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])).alias("f")).select("k", "f.campo", "f.v")
    cells = cells.where(F.col("v").rlike(r"[^\x00-\x7f]|\?"))
    distinct = cut(spread(cells.select("v").distinct()), "garbled-values")
    clean = distinct.where(~F.col("v").rlike(r'[?\x{fffd}|;/&"\[\]\n\t]') & F.col("v").rlike(r"^[\p{IsLatin}\s.,'()\-]+$") & ~F.col("v").rlike(r"[\p{Ll}]\p{Lu}|Ã[\u0080-¿]|[Ââã][^\p{L}\s]"))
    shared = spark.sparkContext.broadcast(digests(clean, least=1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(shared.value)
        for pdf in batches:
            got = [(v, *r) for v, r in ((v, restore(v, coder)) for v in pdf["v"]) if r[2]]
            if got:
                yield pd.DataFrame([(v, t, c) for v, t, c, _ in got], columns=["v", "restaurado", "cadena"])

    found = cut(distinct.mapInPandas(run, "v string, restaurado string, cadena string"), "garbled-found")
    lost = found.where(F.col("cadena").contains("lost"))
    whole = distinct.join(found.select("v"), "v", "left_anti").select(_hole_key(F.col("v")).alias("hole"), "v")
    fits = whole.join(lost.select(_hole_key(F.col("restaurado")).alias("hole")).distinct(), "hole", "left_semi")
    fits = fits.groupBy("hole").agg(F.count("*").alias("n"), F.min("v").alias("fit")).where("n = 1")
    mended = lost.select("v", "cadena", _hole_key(F.col("restaurado")).alias("hole")).join(fits, "hole", "left").select("v", F.col("fit").alias("restaurado"), "cadena")
    all_found = found.where(~F.col("cadena").contains("lost")).unionByName(mended.select("v", "restaurado", "cadena"))
    return cells.join(all_found, "v").select(F.col("k").alias(key), "campo", F.col("v").alias("valor"), "restaurado", "cadena")
