"""Text functions as column expressions; Python only where Spark has no counterpart."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's str.isspace sees it.
SPACE = r"[\p{Z}\x09-\x0d\x1c-\x1f\x85]"
CJK = r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}"

#: Units whose places are gathered together.
UNITS_AT_ONCE = 128

# Fixed values.
LANGUAGE_NAMES = {"zh": "Chinese", "en": "English", "ja": "Japanese", "ko": "Korean", "de": "German", "fr": "French"}
WRITTEN_FORM = r"[\p{Nd}%℃$¥€]"
PAUSE_PUNCTUATION = "，。、；：？！…—,.;:?!\"'“”‘’()（）《》〈〉[]【】~～· "


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def is_blank(text: Column) -> Column:
    return F.coalesce(~F.rlike(text, F.lit("(?s)" + SPACE.replace("[", "[^", 1))), F.lit(True))


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def normalize_text(text: Column, compatible: bool = False) -> Column:
    """Lower-cased words of a text between single spaces. compatible: the text is known to be in NFKC, so no Python is needed."""
    t = text if compatible else nfkc(text)
    t = strip(F.lower(F.regexp_replace(t, rf"[^\p{{L}}\p{{N}}_{CJK}]+", " ")))
    return F.regexp_replace(F.translate(t, "_", " "), f"{SPACE}+", " ")


def to_units(text: Column, compatible: bool = False) -> Column:
    """Units of error rates: single CJK characters, other text by words; none for null."""
    spaced = F.regexp_replace(normalize_text(F.coalesce(text, F.lit("")), compatible), f"([{CJK}])", " $1 ")
    return F.array_remove(F.split(spaced, " +"), "")


def let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once a row, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance of two arrays of strings: each distinct unit becomes one character, of the first 256 where they
    are few, else from U+4E00, surrogates left out. An error beyond the 1,092,096 distinct units a pair that Unicode has room for."""

    def coded(x: Column) -> Column:
        distance = lambda code: F.levenshtein(*(F.array_join(F.transform(x[side], lambda u: code(F.array_position(x["words"], u))), "") for side in "ab"))
        too_many = F.raise_error(F.lit("edit_distance: more than 1,092,096 distinct units")).cast("int")
        few = distance(lambda position: F.char(position + 32))
        return F.when(F.size(x["words"]) > 1_092_096, too_many).when(F.size(x["words"]) <= 200, few).otherwise(distance(code))

    def code(position: Column) -> Column:
        at = position + 19967 + F.when(position > 35328, F.lit(2048)).otherwise(F.lit(0))
        return F.decode(F.unhex(F.lpad(F.hex(at), 8, "0")), "UTF-32")

    pair = F.struct(a.alias("a"), b.alias("b"))
    return let(let(pair, lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), F.array_distinct(F.concat(x["a"], x["b"])).alias("words"))), coded)


def error_rate(reference: Column, hypothesis: Column) -> Column:
    """Unit errors over the reference's length: infinite without a reference, 1 without a hypothesis."""

    def rate(x: Column) -> Column:
        whole = edit_distance(x["a"], x["b"]) / F.size(x["a"])
        return F.when(F.size(x["a"]) == 0, F.lit(float("inf"))).when(F.size(x["b"]) == 0, F.lit(1.0)).otherwise(whole)

    return let(F.struct(reference.alias("a"), hypothesis.alias("b")), rate)


def unit_errors(reference: Column, hypothesis: Column, compatible: bool = False) -> Column:
    """struct<errors, units, heard>: unit errors, and the units of either text, each worked out once."""
    sized = lambda x: F.struct(edit_distance(x["a"], x["b"]).alias("errors"), F.size(x["a"]).alias("units"), F.size(x["b"]).alias("heard"))
    return let(F.struct(to_units(reference, compatible).alias("a"), to_units(hypothesis, compatible).alias("b")), sized)


def counted_rate(counts: Column) -> Column:
    """``error_rate`` from what ``unit_errors`` gives; null for null."""
    rate = F.when(counts["units"] == 0, F.lit(float("inf"))).when(counts["heard"] == 0, F.lit(1.0)).otherwise(counts["errors"] / F.nullif(counts["units"], F.lit(0)))
    return F.when(counts.isNotNull(), rate)


def compute_wer(reference: Column, hypothesis: Column, phonetic: bool = False, compatible: bool = False, readings: dict[str, str] | None = None) -> Column:
    if phonetic:
        reference, hypothesis = numbers_to_chinese(F.coalesce(reference, F.lit(""))), numbers_to_chinese(F.coalesce(hypothesis, F.lit("")))
    units = [to_units(t, compatible) for t in (reference, hypothesis)]
    return error_rate(*(to_pinyin(u, readings) for u in units)) if phonetic else error_rate(*units)


def language_name(code: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in LANGUAGE_NAMES.items() for x in pair))
    return F.coalesce(F.try_element_at(names, F.lower(code)), code)


# Fixed values.
_DIGITS = "零一二三四五六七八九"
_PLACES = ("", "十", "百", "千")
_GROUPS = ("", "万", "亿", "万亿")


def chinese_integer(digits: str) -> str:
    """The reading of a whole number as a quantity; beyond 16 digits, digit by digit."""
    digits = digits.lstrip("0") or "0"
    if digits == "0" or len(digits) > 16:
        return "".join(_DIGITS[int(d)] for d in digits)
    out, gap = "", False
    for k, d in enumerate(digits):
        group, place = divmod(len(digits) - 1 - k, 4)
        if d == "0":
            gap = True
        else:
            out += ("零" if gap and out else "") + _DIGITS[int(d)] + _PLACES[place]
            gap = False
        start = max(0, len(digits) - 4 * (group + 1))
        if place == 0 and group and digits[start : k + 1].strip("0"):
            out, gap = out + _GROUPS[group], False
    return out[1:] if out.startswith("一十") else out


def chinese_numbers(text: str) -> str:
    """Arabic numerals as Chinese readings: years digit by digit, percentages, decimals, quantities."""
    text = re.sub(r"(?<![0-9])([0-9]{4})(?=年)", lambda m: "".join(_DIGITS[int(d)] for d in m[1]), text)

    def number(m: re.Match) -> str:
        whole, part = chinese_integer(m[1]), m[2]
        return whole + ("点" + "".join(_DIGITS[int(d)] for d in part) if part else "")

    text = re.sub(r"([0-9]+)(?:\.([0-9]+))?%", lambda m: "百分之" + number(m), text)
    return re.sub(r"([0-9]+)(?:\.([0-9]+))?", number, text)


@F.pandas_udf(T.StringType())
def numbers_to_chinese(text: pd.Series) -> pd.Series:
    """Uses the package cn2an where it is installed, else ``chinese_numbers``; a text that fails stays as it is."""
    try:
        from cn2an import transform
    except ImportError:
        return text.map(lambda t: chinese_numbers(t) if t else t)

    def one(t):
        try:
            return transform(t, "an2cn")
        except Exception:  # noqa: BLE001  the package raises many kinds
            return t

    return text.map(one)


def load_readings(path: str) -> dict[str, str]:
    """Characters and their toneless readings from a file of lines ``character<TAB>reading``; the first of several counts.

    There are no more of them than Unicode has characters, so they go to every worker with its task.
    """
    out: dict[str, str] = {}
    with open(path, encoding="utf-8") as f:
        for line in f:
            character, tab, reading = line.rstrip("\n").partition("\t")
            if not tab or len(character) != 1:
                raise ValueError(f"{path}: not a character, a tab and its reading: {line!r}")
            out.setdefault(character, reading)
    return out


def to_pinyin(units: Column, readings: dict[str, str] | None = None) -> Column:
    """Toneless readings of CJK units: those of ``readings`` if given, else of the package pypinyin where it is installed.
    Units without a reading stay as they are."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def read(units: pd.Series) -> pd.Series:
        if readings is not None:
            return units.map(lambda u: [readings.get(x, x) for x in u])
        try:
            from pypinyin import lazy_pinyin
        except ImportError:
            return units
        return units.map(lambda u: ["".join(lazy_pinyin(x)) for x in u])

    return read(units)


def needs_rewrite(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(WRITTEN_FORM)), F.lit(False))


def valid_rewrite(before: Column, after: Column) -> Column:
    """A rewrite is kept if it is not empty, holds no written form and has 0.5 to 3 times the length."""
    ratio = F.length(after) / F.greatest(F.length(before), F.lit(1))
    return F.coalesce((after != "") & ~needs_rewrite(after) & ratio.between(0.5, 3.0), F.lit(False))


def unit_spans(text: Column, items: Column) -> Column:
    """array<struct<start, stop>> (from 0) of the aligned units in a text, left to right; null if one is missing."""
    begin = F.struct(F.lit(0).alias("at"), F.lit(True).alias("ok"), F.expr("cast(array() as array<struct<start:int,stop:int>>)").alias("spans"))

    def step(acc: Column, item: Column) -> Column:
        unit = F.coalesce(item["text"], F.lit(""))
        found = F.when(unit == "", acc["at"]).otherwise(F.call_function("locate", unit, text, acc["at"] + 1) - 1)
        stop = found + F.length(unit)
        return F.struct(stop.alias("at"), (acc["ok"] & (found >= 0)).alias("ok"), F.concat(acc["spans"], F.array(F.struct(found.alias("start"), stop.alias("stop")))).alias("spans"))

    def part(acc: Column, some: Column) -> Column:
        # the spans of a few units are gathered on their own, so that the whole list is not copied for each unit
        start = F.struct(acc["at"].alias("at"), acc["ok"].alias("ok"), begin["spans"].alias("spans"))
        return let(F.aggregate(some, start, step), lambda x: F.struct(x["at"].alias("at"), x["ok"].alias("ok"), F.concat(acc["spans"], x["spans"]).alias("spans")))

    firsts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(UNITS_AT_ONCE))).otherwise(F.expr("cast(array() as array<int>)"))
    folded = F.aggregate(F.transform(firsts, lambda i: F.slice(items, i, UNITS_AT_ONCE)), begin, part)
    return let(folded, lambda x: F.when(x["ok"], x["spans"]))


def pause_insertions(text: Column, items: Column, spans: Column, comma: float, period: float) -> Column:
    """array<struct<pos, char, gap>> of marks for pauses between neighbouring units that have none between them."""
    index = F.when(F.size(items) > 1, F.sequence(F.lit(0), F.size(items) - 2)).otherwise(F.expr("cast(array() as array<int>)"))
    marks = "[" + re.sub(r"([\[\]\\^\-&~])", r"\\\1", PAUSE_PUNCTUATION) + "]"

    def one(i: Column) -> Column:
        gap = F.get(items, i + 1)["start"] - F.get(items, i)["end"]
        stop = F.get(spans, i)["stop"]
        between = F.substring(text, stop + 1, F.greatest(F.lit(0), F.get(spans, i + 1)["start"] - stop))
        wanted = (gap >= comma) & ~F.rlike(between, F.lit(marks))
        return F.when(wanted, F.struct(stop.alias("pos"), F.when(gap >= period, "。").otherwise("，").alias("char"), gap.alias("gap")))

    return F.filter(F.transform(index, one), lambda x: x.isNotNull())


def insert_marks(text: Column, marks: Column) -> Column:
    """``text`` with each mark's character put in at its place in the original text."""
    before = lambda i: F.coalesce(F.get(marks, i - 1)["pos"], F.lit(0))
    pieces = F.transform(marks, lambda m, i: F.concat(F.substring(text, before(i) + 1, m["pos"] - before(i)), m["char"]))
    last = F.coalesce(F.try_element_at(marks, F.lit(-1))["pos"], F.lit(0))
    return F.concat(F.array_join(pieces, ""), F.substring(text, last + 1, F.length(text)))
