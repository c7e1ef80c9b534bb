"""Audio bytes: WAV by the standard library; other codecs through the optional package soundfile."""

from __future__ import annotations

import io
import wave

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MODEL_RATE = 16_000
#: New audio that a worker holds before it hands it on.
NEW_BYTES = 4 << 20


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """(frames x channels float32, rate). Other codecs than PCM WAV need soundfile."""
    if data[:4] == b"RIFF":
        with wave.open(io.BytesIO(data)) as w:
            width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
            raw = w.readframes(w.getnframes())
        if width == 1:
            x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
        elif width == 3:
            b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
            x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
        else:
            x = np.frombuffer(raw, f"<i{width}").astype(np.float32) / (1 << (8 * width - 1))
        return x.reshape(-1, channels), rate
    import soundfile

    return soundfile.read(io.BytesIO(data), dtype="float32", always_2d=True)


def encode_wav(x: np.ndarray, rate: int) -> bytes:
    """16-bit PCM WAV."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(x.shape[1])
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(np.round(x * 32768), -32768, 32767)).astype("<i2").tobytes())
    return out.getvalue()


def encode(x: np.ndarray, rate: int) -> tuple[bytes, str]:
    """Lossless bytes and their extension: FLAC where soundfile is installed, else WAV."""
    try:
        import soundfile
    except ImportError:
        return encode_wav(x, rate), "wav"
    out = io.BytesIO()
    soundfile.write(out, x, rate, format="FLAC", subtype="PCM_16")
    return out.getvalue(), "flac"


def mono_16k(x: np.ndarray, rate: int) -> np.ndarray:
    """Mean of the channels at the models' rate; resampling is linear unless librosa is installed."""
    y = x.mean(axis=1) if x.shape[1] else np.zeros(len(x), np.float32)
    if rate == MODEL_RATE or not len(y):
        return y.astype(np.float32)
    try:
        import librosa
    except ImportError:
        n = int(np.ceil(len(y) * MODEL_RATE / rate))
        return np.interp(np.arange(n) * rate / MODEL_RATE, np.arange(len(y)), y).astype(np.float32)
    return librosa.resample(y, orig_sr=rate, target_sr=MODEL_RATE)


def cut(x: np.ndarray, rate: int, start: float, end: float, pad_head: float, pad_tail: float) -> np.ndarray:
    """A stretch of the audio with silence before and after; places are cut off to whole frames."""
    silence = [np.zeros((int(p * rate), x.shape[1]), np.float32) for p in (pad_head, pad_tail)]
    return np.concatenate([silence[0], x[int(start * rate) : int(end * rate)], silence[1]])


def _extended(df: DataFrame, *fields: T.StructField) -> T.StructType:
    names = {f.name for f in fields}
    return T.StructType([f for f in df.schema.fields if f.name not in names] + list(fields))


def with_durations(df: DataFrame) -> DataFrame:
    """Adds duration and audio_duration (seconds) from the bytes in ``audio``, and decode_error (the exception's name)."""
    schema = _extended(df, T.StructField("duration", T.DoubleType()), T.StructField("audio_duration", T.DoubleType()), T.StructField("decode_error", T.StringType()))
    kept = [f.name for f in schema.fields[:-3]]

    def run(batches):
        for b in batches:
            seconds, native, errors = [], [], []
            for data in b.column(b.schema.get_field_index("audio")):
                try:
                    x, rate = decode(data.as_py())
                    seconds.append(len(mono_16k(x, rate)) / MODEL_RATE)
                    native.append(len(x) / rate)
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  any failure is that row's alone
                    seconds.append(None)
                    native.append(None)
                    errors.append(type(e).__name__)
            yield pa.record_batch([*(b.column(b.schema.get_field_index(c)) for c in kept), pa.array(seconds, pa.float64()), pa.array(native, pa.float64()), pa.array(errors, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)


def with_trimmed(df: DataFrame) -> DataFrame:
    """Cuts ``audio`` as ``_trim`` says: new audio, ext and new_duration; trim_error names what went wrong."""
    schema = _extended(df, T.StructField("audio", T.BinaryType()), T.StructField("ext", T.StringType()), T.StructField("new_duration", T.DoubleType()), T.StructField("trim_error", T.StringType()))
    kept = [f.name for f in schema.fields[:-4]]
    kinds = (pa.binary(), pa.string(), pa.float64(), pa.string())

    def trimmed(data, ext, plan):
        if plan is None:
            return data, ext, None, None
        try:
            x, rate = decode(data)
        except Exception as e:  # noqa: BLE001
            return data, ext, None, type(e).__name__
        y = cut(x, rate, plan["cut_start"], plan["cut_end"], plan["pad_head"], plan["pad_tail"])
        return *encode(y, rate), len(y) / rate, None

    def run(batches):
        for b in batches:
            rows, held, first = [], 0, 0
            get = lambda c: b.column(b.schema.get_field_index(c))  # noqa: B023, E731
            for k, row in enumerate(zip(get("audio"), get("ext"), get("_trim"), strict=True)):
                rows.append(trimmed(*(x.as_py() for x in row)))
                held += len(rows[-1][0] or b"")
                if held >= NEW_BYTES or k + 1 == b.num_rows:
                    columns = zip(*rows, strict=True)
                    yield pa.record_batch([*(get(c).slice(first, len(rows)) for c in kept), *(pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True))], names=schema.names)
                    rows, held, first = [], 0, k + 1

    return df.mapInArrow(run, schema)
