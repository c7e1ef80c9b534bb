"""Run settings from YAML, and the chain of stages they ask for."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import audio
from ..functions import text as tx
from ..operators import models, stages
from ..operators.reject import reject


@dataclass(frozen=True)
class Step:
    """One stage: its name, and a function from samples to samples."""

    name: str
    apply: Callable[[DataFrame], DataFrame]


@dataclass
class Settings:
    sections: dict = field(default_factory=dict)

    @property
    def batch_size(self) -> int:
        return int(self.sections.get("batch_size", 64))

    def section(self, name: str) -> dict | None:
        """A section that is switched on; ``duration`` is on if it is there."""
        s = self.sections.get(name)
        return s if s is not None and (name == "duration" or s.get("enabled")) else None

    def thresholds(self) -> dict:
        s = self.section("audiobox") or {}
        return {"PQ": s.get("min_pq"), "CE": s.get("min_ce"), "CU": s.get("min_cu"), "PC": s.get("max_pc")}


def load(path: str) -> Settings:
    import yaml

    with open(path, encoding="utf-8") as f:
        return Settings(yaml.safe_load(f) or {})


_EXTRA: list[Step] = []


def register_stage(name: str, apply: Callable[[DataFrame], DataFrame]) -> None:
    """Adds a stage that runs after the built-in ones."""
    _EXTRA.append(Step(name, apply))


def build_steps(settings: Settings, backends: dict | None = None) -> list[Step]:
    """The stages in order of cost. backends: factory or registered name for each kind of annotation that is not a column yet."""
    backends, out = backends or {}, []

    def model(df: DataFrame, kind: str, inputs: list[str], size: int, gate=None) -> DataFrame:
        return models.annotate(df, kind, backends[kind], inputs, size, gate) if kind in backends else df

    if (s := settings.section("duration")) is not None:
        out.append(Step("duration", lambda df, s=s: stages.duration_filter(df, s["min_sec"], s["max_sec"])))
    if s := settings.section("audiobox"):
        out.append(Step("audiobox", lambda df, s=s: stages.quality_filter(model(df, "quality", ["audio"], s.get("batch_size", 32)), s.get("min_pq"), s.get("min_ce"), s.get("min_cu"), s.get("max_pc"))))
    if s := settings.section("diarization"):
        out.append(Step("multi_speaker", lambda df, s=s: stages.speaker_filter(model(df, "segments", ["audio"], s.get("batch_size", 16)), s.get("max_speakers", 1), s.get("min_speaker_sec", 0.5))))
    if s := settings.section("asr"):
        readings = tx.load_readings(s["readings"]) if s.get("readings") else None

        def asr(df, s=s):
            df = df.withColumns({"asr_context": F.lit(s.get("context", "")), "asr_language": tx.language_name(F.col("language"))})
            df = model(df, "transcript", ["audio", "asr_language", "asr_context"], s.get("batch_size", 16)).drop("asr_context", "asr_language")
            return stages.transcript_filter(df, s.get("max_wer", 0.1), s.get("phonetic", True), s.get("adopt_text", True), s.get("text_source", "qwen3-asr"), readings=readings)

        out.append(Step("asr_wer", asr))
    if s := settings.section("tn"):

        def rewrite(df, s=s):
            df = df if "orig_text" in df.columns else df.withColumn("orig_text", F.lit(None).cast("string"))
            return stages.text_rewrite(model(df, "rewrite", ["text", "orig_text"], s.get("batch_size", 8), tx.needs_rewrite(F.col("text"))))

        out.append(Step("tn", rewrite))
    if s := settings.section("align"):

        def align(df, s=s):
            df = df.withColumns({"align_text": F.coalesce("text", F.lit("")), "align_language": F.coalesce(tx.language_name(F.col("language")), F.lit("Chinese"))})
            return stages.alignment_filter(model(df, "alignment", ["audio", "align_text", "align_language"], s.get("batch_size", 32)).drop("align_text", "align_language"))

        out.append(Step("align", align))
    if s := settings.section("trim"):

        def trim(df, s=s):
            df = stages.trim_plan(df, s.get("head_silence_sec", 0.1), s.get("tail_silence_sec", 0.3))
            df = audio.with_trimmed(df)
            df = reject(df, "trim", [(F.col("trim_error").isNotNull(), F.concat(F.lit("trim_decode_error:"), "trim_error"), F.lit(None))])
            return stages.apply_trim(df.withColumn("_trim", F.when(F.col("trim_error").isNull(), F.col("_trim"))).drop("trim_error"))

        out.append(Step("trim", trim))
    if s := settings.section("pause"):
        out.append(Step("pause", lambda df, s=s: stages.pause_filter(df, s.get("max_gap_sec", 1.5), s.get("max_edge_silence_sec", 1.0))))
    if s := settings.section("punct"):
        out.append(Step("punct", lambda df, s=s: stages.pause_punctuation(df, s.get("comma_gap_sec", 0.3), s.get("period_gap_sec", 0.8))))
    return out + _EXTRA


def run_steps(df: DataFrame, steps: list[Step]) -> DataFrame:
    for step in steps:
        df = df.transform(step.apply)
    return df
