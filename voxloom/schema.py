"""The row that flows through a cleaning run.

A sample is one utterance. Stages add columns and never drop rows: a rejected row keeps its first reject and is passed
over by later stages, so the models above it run once whatever the sinks read.
"""

from __future__ import annotations

SAMPLE = "shard string, ord long, key string, stem string, ext string, audio binary, text string, language string, source_duration double, speaker string, dnsmos double, source string, unread string"
ALIGNMENT = "array<struct<text:string,start:double,end:double>>"
REJECT = "reject_stage string, reject_code string, reject_value double"
#: Annotation columns, in the order in which they appear in written metadata.
ANNOTATIONS = ("audiobox", "diarization", "asr", "orig_text", "text_source", "tn", "alignment", "trim", "pause", "punct_fix")
