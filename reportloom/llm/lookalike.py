"""Problem 8: one consistent form for text that looks alike but is stored differently.

The skeleton of a text is: decompose, replace every character by the prototype of its
look-alike class, decompose again.  Originals with equal skeletons look the same.

What stays visible, and therefore distinct: letter case, digits, accents, superscripts,
subscripts, fractions, enclosed characters and punctuation of another shape.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportloom.session import kept

# Letters of other scripts drawn like a basic Latin letter.
CYRILLIC = "АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝ"
CYRILLIC_AS = "ABESIJKMHOPCTYXaesijopcyxhdqw"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορικγυ"
GREEK_AS = "ABEZHIKMNOPTYXavopikyu"
# Rarer letters of the same shape, in Cyrillic, Greek, Armenian, Cherokee, Latin extensions, Lisu and Coptic.
RARER = (
    ("\u04c0\u04cf\u0474\u0475\u04ae\u04af\u051a\u051c\u050c\u04d4\u04d5\u04d8\u04d9", "IlVvYyQWG\u00c6\u00e6\u018f\u0259"),
    ("\u03f9\u03f2\u03f3\u037f\u03dc", "CcjJF"),
    ("\u0585\u057d\u0555\u054d\u053c\u054f\u0570\u0578\u0566\u0581\u0575", "ouOULShnqgj"),
    ("\u13a0\u13a1\u13a2\u13a5\u13aa\u13ab\u13ac\u13b3\u13b7\u13bb\u13bd\u13c0\u13c2\u13c3\u13cf\u13d2\u13d4\u13d5\u13d9\u13da\u13de\u13df\u13e2\u13e6\u13e7\u13f3\u13f4", "DRTiAJEWMHYGhZbRWSVSLCPKdGB"),
    ("\u0261\u0251\u1d0f\u1d04\u1d20\u1d21\u1d22\ua731\u0131\u0237", "gaocvwzsij"),
    ("\ua4d0\ua4d1\ua4d3\ua4d4\ua4d6\ua4d7\ua4d9\ua4da\ua4dc\ua4dd\ua4df\ua4e0\ua4e1\ua4e2\ua4e3\ua4e6\ua4e7\ua4ea\ua4eb\ua4ec\ua4ee\ua4f0\ua4f2\ua4f3\ua4f4", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    ("\u2c8e\u2c92\u2c94\u2c98\u2c9a\u2c9e\u2c9f\u2ca2\u2ca3\u2ca4\u2ca5\u2ca6\u2ca8\u2cac", "HIKMNOoPpCcTYX"),
)
# Marks drawn like another mark.
MARKS = "\u2010\u2011\u2212\ua789\u2236\u066a\u2215\u037e\u2223"
MARKS_AS = "---::%/;|"
# Compatibility decompositions that do not change how a character looks.
SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>")
# Spacing accents whose compatibility decomposition begins with a blank.
SPACING_ACCENTS = "¨¯´¸˘˙˚˛˜˝ͺ΄‗‾"


def _prototype(ch: str) -> str | None:
    """The replacement of one decomposed character; None if it stands for itself."""
    cat = unicodedata.category(ch)
    if ch == "‍":  # joins emoji; the text-level pass decides
        return None
    if cat == "Cf" or "︀" <= ch <= "️" or "\U000e0100" <= ch <= "\U000e01ef" or ch in "͏ᅟᅠㅤﾠ":
        return ""
    if cat == "Zs":
        return " "
    if cat in ("Zl", "Zp") or ch in "\x0b\x0c\x85":
        return "\n"
    if cat == "Cc" and ch not in "\t\n\r":
        return ""
    form = unicodedata.decomposition(ch)
    if form.startswith(SAME_LOOK) and ch not in SPACING_ACCENTS:
        return "".join(_prototype(c) or c for c in map(lambda h: chr(int(h, 16)), form.split()[1:]))
    return None


@lru_cache(maxsize=1)
def prototypes() -> dict[int, str]:
    """Code point -> prototype.  Built by rule from the Unicode data of the interpreter,
    with the look-alike letters above laid over it."""
    table = {}
    for cp in range(128, sys.maxunicode + 1):
        if 0x3400 <= cp <= 0x9FFF or 0xAC00 <= cp <= 0xD7A3 or 0xE000 <= cp <= 0xF8FF or 0x20000 <= cp <= 0xDFFFF:
            continue
        p = _prototype(chr(cp))
        if p is not None:
            table[cp] = p
    for cp in (*range(0, 9), 11, 12, *range(14, 32), 127):
        table[cp] = _prototype(chr(cp)) or ""
    for a, b in zip(CYRILLIC + GREEK + MARKS, CYRILLIC_AS + GREEK_AS + MARKS_AS, strict=True):
        table[ord(a)] = b
    table.update((ord(a), b) for letters, as_ in RARER for a, b in zip(letters, as_, strict=True))
    # a compatibility form of a look-alike letter goes all the way to its prototype
    for cp, s in list(table.items()):
        table[cp] = "".join(table.get(ord(c), c) for c in s)
    return table


_EMOJI_JOIN = re.compile("(?<![\U0001f000-\U0001faff☀-➿️])‍|‍(?![\U0001f000-\U0001faff☀-➿])")
_LINE_END = re.compile(r"(?<![ \t])[ \t]*(?:\r\n?|\n)")
_PLAIN = re.compile(r"[\n -~]*\Z")


def skeleton(text: str | None) -> str | None:
    """The consistent form of a text; null stays null.

    Line ends become ``\\n``, blanks before a line end and at both ends of the text are
    dropped (they are not visible); other blanks are kept one for one.
    """
    if text is None:
        return None
    if not _PLAIN.match(text):
        text = unicodedata.normalize("NFD", text)
        if "‍" in text:
            text = _EMOJI_JOIN.sub("", text)
        text = unicodedata.normalize("NFD", text.translate(prototypes()))
    return _LINE_END.sub("\n", text).strip("\t\n\r ")


#: Parts the texts of a batch while they are folded together; no character, so in no proper text.
_PART = "\ufdd0"
_GONE = 0xFFFFFFFF


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: the prototype (itself where there is none, _GONE where it is dropped), whether the
    prototype has several characters, and whether the character is a mark without width."""
    to = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    several = np.zeros(len(to), bool)
    for cp, s in prototypes().items():
        to[cp] = ord(s) if len(s) == 1 else _GONE
        several[cp] = len(s) > 1
    mark = np.fromiter((unicodedata.category(chr(cp)) == "Mn" for cp in range(len(to))), bool, len(to))
    return to, several, mark


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<u4")


def _string(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def _decomposed(joined: str) -> str:
    """Decomposition, prototypes and decomposition again of joined texts, by table."""
    s = unicodedata.normalize("NFD", joined)
    if "‍" in s:
        s = _EMOJI_JOIN.sub("", s)
    to, several, _ = _tables()
    codes = _codes(s)
    if several[codes].any():
        for cp in np.unique(codes[several[codes]]).tolist():
            s = s.replace(chr(cp), prototypes()[cp])
        codes = _codes(s)
    codes = to[codes]
    return unicodedata.normalize("NFD", _string(codes[codes != _GONE]))


def unmarked(joined: str) -> str:
    """Joined texts with prototypes for look-alikes and without marks."""
    codes = _codes(unicodedata.normalize("NFKD", _decomposed(joined)))
    return _string(codes[~_tables()[2][codes]])


def in_parts(texts: list[str], fold: Callable[[str], str]) -> list[str]:
    """``fold`` of texts joined to one string; texts that hold the parting character go one by one."""
    joined = _PART.join(texts)
    if joined.count(_PART) != max(len(texts) - 1, 0):
        return [fold(t) for t in texts]
    return fold(joined).split(_PART) if texts else []


def skeletons(texts: list[str | None]) -> list[str | None]:
    """skeleton of every text of a batch."""
    known = [k for k, t in enumerate(texts) if t is not None]
    out: list[str | None] = [None] * len(texts)
    for k, s in zip(known, in_parts([texts[k] for k in known], _decomposed), strict=True):
        out[k] = (_LINE_END.sub("\n", s) if "\r" in s or " \n" in s or "\t\n" in s else s).strip("\t\n\r ")
    return out


@F.pandas_udf(T.StringType())
def skeleton_udf(texts: pd.Series) -> pd.Series:
    return pd.Series(skeletons([t if isinstance(t, str) else None for t in texts]), dtype=object)


def skeleton_of(text: Column) -> Column:
    """The consistent form as an expression; texts of plain characters only take no step in Python."""
    plain = text.rlike(r"\A[\t\n\r -~]*\z")
    lines = F.regexp_replace(text, r"(?<![ \t])[ \t]*+(?:\r\n?|\n)", "\n")
    return F.when(plain, F.btrim(lines, F.lit("\t\n\r "))).otherwise(skeleton_udf(F.when(~plain, text)))


def with_skeleton(df: DataFrame, text: str = "text", out: str = "skeleton") -> DataFrame:
    """All columns of ``df`` and the consistent form of ``text``."""
    return df.withColumn(out, skeleton_of(F.col(text)))


def _digest(c: Column) -> Column:
    return F.unhex(F.md5(F.encode(c, "utf-8")))


def keyed(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, cls, spell): 128-bit digests of skeleton and of text, of the documents with
    visible text.  Texts are dropped here, so later exchanges carry about 50 bytes a row."""
    base = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text is not null and doc_id is not null")
    skel = base.select("doc_id", "text", skeleton_of(F.col("text")).alias("sk"))
    return skel.where("sk <> ''").select("doc_id", _digest(F.col("sk")).alias("cls"), _digest(F.col("text")).alias("spell"))


def spellings(keys: DataFrame) -> DataFrame:
    """One row per distinct string: (cls, spell, rep, n); rep is its smallest doc_id.
    The map-side combine reduces a hot group of copies before the exchange."""
    return keys.groupBy("cls", "spell").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))


def lookalike_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_spellings, n_documents): one row per document with visible text.
    class_id is the smallest doc_id whose text looks the same."""
    keys = kept(keyed(df, doc_id, text))
    cls = spellings(keys).groupBy("cls").agg(
        F.min("rep").alias("class_id"), F.count(F.lit(1)).alias("n_spellings"), F.sum("n").alias("n_documents")
    )
    return keys.join(cls, "cls").select("doc_id", "class_id", "n_spellings", "n_documents")


def class_pairs(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id_1, doc_id_2): each spelling's representative (smallest doc_id) with that of its class, so k
    spellings of one look give k - 1 pairs; lookalike_classes has the membership."""
    spell = spellings(keyed(df, doc_id, text)).select("cls", "rep")
    first = spell.groupBy("cls").agg(F.min("rep").alias("first"))
    pairs = spell.join(first, "cls").where("rep <> first")
    return pairs.select(F.least("first", "rep").alias("doc_id_1"), F.greatest("first", "rep").alias("doc_id_2"))


def lookalike_pairs(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id_1 < doc_id_2): documents that look the same but are not the same string.

    Every document is paired with the representative (smallest doc_id) of every *other*
    spelling of its class.  A link between two different strings is never lost, and any
    pair of which one text is unique comes out as such; only pairs between two groups of
    exact copies are reduced to pairs with a representative, so a group that holds a third
    of all rows costs a multiple of its size, not its square.  Different spellings of one look are
    all paired, since each such pair is a case; where only the groups matter, class_pairs has one
    pair a spelling.
    Nulls and texts without visible characters make no pair; a repeated doc_id with one
    text counts once.
    """
    keys = kept(keyed(df, doc_id, text))  # read three times, made once
    spell = spellings(keys)
    several = spell.groupBy("cls").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("cls")
    mine = spell.join(several, "cls", "left_semi")
    other = mine.select("cls", F.col("spell").alias("spell_2"), F.col("rep").alias("rep_2"))
    docs = keys.join(several, "cls", "left_semi")
    pairs = docs.join(other, "cls").where("spell <> spell_2 and doc_id <> rep_2")
    return pairs.select(
        F.least("doc_id", "rep_2").alias("doc_id_1"), F.greatest("doc_id", "rep_2").alias("doc_id_2")
    ).distinct()
