"""The cleaning stages: what each decides, as column expressions over annotations that are already there.

Every function takes and returns a DataFrame of samples. Model output comes from ``models.annotate`` or a join; these
functions only judge it, so each can be checked against plain SQL.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .reject import alive, reject

EDGE_TOLERANCE = 0.05
# Fixed value: a speaker's line, whole; lines with more or less on them are not segments.
_SEGMENT = r"^([\d.]+)\s+([\d.]+)\s+(\S+)$"


def duration_filter(df: DataFrame, min_sec: float = 2.0, max_sec: float = 30.0, require_text: bool = True) -> DataFrame:
    """Rejects empty_text, too_short and too_long; bounds pass. ``duration`` is stored with three decimals, but judged whole."""
    exact = df.withColumn("_exact", F.col("duration"))
    blank = tx.is_blank(F.col("text")) if require_text else F.lit(False)
    exact = exact.withColumn("duration", F.when(alive() & ~blank, F.round("duration", 3)).otherwise(F.col("duration")))
    cases = [(blank, "empty_text", F.lit(None)), (F.col("_exact") < min_sec, "too_short", F.col("_exact")), (F.col("_exact") > max_sec, "too_long", F.col("_exact"))]
    return reject(exact, "duration", cases).drop("_exact")


def quality_filter(df: DataFrame, min_pq: float | None = 6.5, min_ce: float | None = None, min_cu: float | None = None, max_pc: float | None = None) -> DataFrame:
    """Judges the scores of the map ``quality`` (PQ, CE, CU, PC); stores them in ``audiobox`` with three decimals. NaN passes;
    a row without scores, or without one that is judged, is rejected as audiobox_missing."""
    cases, judged = [], []
    for axis, least, most in (("PQ", min_pq, None), ("CE", min_ce, None), ("CU", min_cu, None), ("PC", None, max_pc)):
        score = F.try_element_at("quality", F.lit(axis))
        if least is not None or most is not None:
            bad = score < least if least is not None else score > most
            cases.append((bad & ~F.isnan(score), f"audiobox_{axis}", score))
            judged.append(score.isNull())
    df = df.withColumn("audiobox", F.when(alive(), F.transform_values("quality", lambda _, v: F.round(v, 3))))
    return reject(df, "audiobox", [*cases, (reduce(or_, judged), "audiobox_missing", F.lit(None))]) if cases else df


def speaker_seconds(segments: Column) -> Column:
    """map<speaker, seconds> of 'start end speaker' lines; other lines, and those whose numbers are none (1.2.3), are passed over."""
    lines = F.filter(F.transform(F.coalesce(segments, F.expr("cast(array() as array<string>)")), tx.strip), lambda s: F.rlike(s, F.lit(_SEGMENT)))
    parts = F.transform(lines, lambda s: F.struct(F.regexp_extract(s, _SEGMENT, 3).alias("who"), (F.regexp_extract(s, _SEGMENT, 2).try_cast("double") - F.regexp_extract(s, _SEGMENT, 1).try_cast("double")).alias("sec")))
    parts = F.filter(parts, lambda x: x["sec"].isNotNull())
    total = lambda rows, who: F.aggregate(F.filter(rows, lambda x: x["who"] == who), F.lit(0.0), lambda s, x: s + x["sec"])
    who = lambda rows: F.array_distinct(F.transform(rows, lambda x: x["who"]))
    return tx.let(parts, lambda rows: F.map_from_arrays(who(rows), F.transform(who(rows), lambda w: total(rows, w))))


def speaker_filter(df: DataFrame, max_speakers: int = 1, min_speaker_sec: float = 0.5) -> DataFrame:
    """Counts the speakers of ``segments`` who speak long enough; more than ``max_speakers`` are rejected, none is not."""
    active = F.map_filter(speaker_seconds(F.col("segments")), lambda _, v: v >= min_speaker_sec)
    df = df.withColumn("_active", F.when(alive(), active))
    n = F.size("_active")
    stored = F.struct(n.alias("num_speakers"), F.transform_values("_active", lambda _, v: F.round(v, 2)).alias("speaker_seconds"))
    df = df.withColumn("diarization", F.when(F.col("_active").isNotNull(), stored))
    return reject(df, "multi_speaker", [(n > max_speakers, "multi_speaker", n)]).drop("_active")


def transcript_filter(df: DataFrame, max_wer: float = 0.1, phonetic: bool = True, adopt_text: bool = True, source: str = "second-transcript", compatible: bool = False, readings: dict[str, str] | None = None, counts: str | None = None) -> DataFrame:
    """Judges ``transcript`` (struct<text, language>) against ``text`` by unit errors; adopts it if it passes and is not blank.
    phonetic: units are compared by their readings (``text.to_pinyin``). counts: a column to keep the plain ``text.unit_errors`` in."""
    heard, counted = F.coalesce("transcript.text", F.lit("")), counts or "_counts"
    df = df.withColumn(counted, F.when(alive(), tx.unit_errors(F.col("text"), heard, compatible)))
    df = df.withColumn("_char", tx.counted_rate(F.col(counted)))
    df = df.withColumn("_wer", F.when(alive(), tx.compute_wer(F.col("text"), heard, True, readings=readings)) if phonetic else F.col("_char"))
    stored = lambda c: F.when(F.col(c) != float("inf"), F.round(c, 4))
    asr = F.struct(F.col("transcript.text").alias("text"), F.col("transcript.language").alias("language"), stored("_wer").alias("wer"), stored("_char").alias("char_wer"))
    df = reject(df.withColumn("asr", F.when(alive(), asr)), "asr_wer", [(F.col("_wer") > max_wer, "wer", F.col("_wer"))])
    adopt = alive() & ~tx.is_blank(F.col("transcript.text")) & F.lit(adopt_text)
    return df.withColumns({"orig_text": F.when(adopt, F.col("text")), "text_source": F.when(adopt, source), "text": F.when(adopt, F.col("transcript.text")).otherwise(F.col("text"))}).drop("_char", "_wer", "_counts")


def text_rewrite(df: DataFrame) -> DataFrame:
    """Takes over ``rewrite`` where the text holds written forms and the rewrite is valid; never rejects."""
    gate = alive() & tx.needs_rewrite(F.col("text"))
    new = tx.strip(F.col("rewrite"))
    df = df.withColumn("_new", F.when(gate & tx.valid_rewrite(F.col("text"), new) & (new != F.col("text")), new))
    note = F.when(F.col("_new").isNotNull(), F.struct(F.col("text").alias("text_before"), F.lit(None).cast("boolean").alias("unchanged")))
    note = note.when(gate, F.struct(F.lit(None).cast("string").alias("text_before"), F.lit(True).alias("unchanged")))
    return df.withColumns({"tn": note, "text": F.coalesce("_new", "text")}).drop("_new")


def alignment_filter(df: DataFrame) -> DataFrame:
    """Rejects rows that the aligner gave up on (null); times are kept with three decimals, which later stages see."""
    times = F.transform("alignment", lambda x: F.struct(x["text"].alias("text"), F.round(x["start"], 3).alias("start"), F.round(x["end"], 3).alias("end")))
    return reject(df.withColumn("alignment", times), "align", [(F.col("alignment").isNull(), "align_failed", F.lit(None))])


def trim_plan(df: DataFrame, head: float = 0.1, tail: float = 0.3, wordless: bool = False) -> DataFrame:
    """Adds ``_trim`` (cut_start, cut_end, pad_head, pad_tail, exact) for rows whose edges are off by more than the tolerance.
    wordless: rows whose alignment is empty are planned too; nothing is cut off and the tail's silence follows the whole."""
    d, items = F.col("audio_duration"), F.col("alignment")
    # without words both are null, which greatest and least pass over
    begin, end = F.get(items, F.lit(0))["start"], F.least(F.try_element_at(items, F.lit(-1))["end"], d)
    usable = alive() & (F.size(items) >= (0 if wordless else 1))
    df = df.withColumn("_edge", F.when(usable, F.struct(begin.alias("s"), end.alias("e"), F.greatest(F.lit(0.0), begin - head).alias("cs"), F.least(d, end + tail).alias("ce"))))
    e = F.col("_edge")
    pads = F.struct(e["cs"].alias("cut_start"), e["ce"].alias("cut_end"), F.greatest(F.lit(0.0), F.lit(head) - (e["s"] - e["cs"])).alias("pad_head"), F.greatest(F.lit(0.0), F.lit(tail) - (e["ce"] - e["e"])).alias("pad_tail"))
    df = df.withColumn("_trim", F.when(e.isNotNull(), pads)).drop("_edge")
    t = F.col("_trim")
    small = (t["cut_start"] < EDGE_TOLERANCE) & (d - t["cut_end"] < EDGE_TOLERANCE) & (t["pad_head"] < EDGE_TOLERANCE) & (t["pad_tail"] < EDGE_TOLERANCE)
    return df.withColumn("_trim", F.when(t.isNotNull() & ~small, t))


def apply_trim(df: DataFrame) -> DataFrame:
    """Moves times and durations by ``_trim``; ``new_duration`` is the length of the rewritten audio where bytes were cut.

    Without it the length follows from the plan. Times are rounded to three decimals, as the pause stage sees them.
    """
    t, d = F.col("_trim"), F.col("audio_duration")
    shift = t["cut_start"] - t["pad_head"]
    moved = F.transform("alignment", lambda x: F.struct(x["text"].alias("text"), F.round(F.greatest(F.lit(0.0), x["start"] - shift), 3).alias("start"), F.round(F.greatest(F.lit(0.0), x["end"] - shift), 3).alias("end")))
    planned = t["cut_end"] - t["cut_start"] + t["pad_head"] + t["pad_tail"]
    length = F.coalesce("new_duration", planned) if "new_duration" in df.columns else planned
    note = F.struct(F.round(d, 3).alias("orig_duration"), F.round(t["cut_start"], 3).alias("cut_head"), F.round(d - t["cut_end"], 3).alias("cut_tail"), F.round(t["pad_head"], 3).alias("pad_head"), F.round(t["pad_tail"], 3).alias("pad_tail"))
    cut = t.isNotNull()
    out = {"trim": F.when(cut, note), "alignment": F.when(cut, moved).otherwise(F.col("alignment")), "duration": F.when(cut, F.round(length, 3)).otherwise(F.col("duration")), "audio_duration": F.when(cut, length).otherwise(d)}
    return df.withColumns(out).drop("_trim", "new_duration")


def pause_filter(df: DataFrame, max_gap_sec: float = 1.5, max_edge_silence_sec: float = 1.0) -> DataFrame:
    """Rejects pause_no_alignment, then the longest gap, the head and the tail beyond their limits."""
    items = F.col("alignment")
    usable = F.coalesce(F.size(items) > 0, F.lit(False))
    index = F.when(F.size(items) > 1, F.sequence(F.lit(0), F.size(items) - 2)).otherwise(F.expr("cast(array() as array<int>)"))
    gap = F.aggregate(index, F.lit(0.0), lambda m, i: F.greatest(m, F.get(items, i + 1)["start"] - F.get(items, i)["end"]))
    head, tail = F.get(items, F.lit(0))["start"], F.greatest(F.lit(0.0), F.col("audio_duration") - F.element_at(items, -1)["end"])
    df = df.withColumn("_pause", F.when(alive() & usable, F.struct(gap.alias("gap"), head.alias("head"), tail.alias("tail"))))
    p = F.col("_pause")
    df = df.withColumn("pause", F.when(p.isNotNull(), F.struct(F.round(p["gap"], 3).alias("max_gap"), F.round(p["head"], 3).alias("head_silence"), F.round(p["tail"], 3).alias("tail_silence"))))
    cases = [(~usable, "pause_no_alignment", F.lit(None)), (p["gap"] > max_gap_sec, "pause_gap", p["gap"]), (p["head"] > max_edge_silence_sec, "pause_head", p["head"]), (p["tail"] > max_edge_silence_sec, "pause_tail", p["tail"])]
    return reject(df, "pause", cases).drop("_pause")


def pause_punctuation(df: DataFrame, comma_gap_sec: float = 0.3, period_gap_sec: float = 0.8) -> DataFrame:
    """Puts marks into the text at pauses that have none; text that the alignment does not fit stays as it is."""
    usable = alive() & (F.size("alignment") > 0) & (F.coalesce("text", F.lit("")) != "")
    df = df.withColumn("_spans", F.when(usable, tx.unit_spans(F.col("text"), F.col("alignment"))))
    df = df.withColumn("_marks", F.when(F.col("_spans").isNotNull(), tx.pause_insertions(F.col("text"), F.col("alignment"), F.col("_spans"), comma_gap_sec, period_gap_sec)))
    some = F.coalesce(F.size("_marks") > 0, F.lit(False))
    shown = F.transform("_marks", lambda m: F.struct(m["pos"].alias("pos"), m["char"].alias("char"), F.round(m["gap"], 3).alias("gap")))
    note = F.when(some, F.struct(F.size("_marks").alias("n_inserted"), shown.alias("inserted"), F.col("text").alias("text_before")))
    return df.withColumns({"punct_fix": note, "text": F.when(some, tx.insert_marks(F.col("text"), F.col("_marks"))).otherwise(F.col("text"))}).drop("_spans", "_marks")
