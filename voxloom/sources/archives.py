"""Archive scans as Python data sources: one input partition a shard.

``read_samples`` pairs metadata and audio in one pass over each archive, in member order, the latest of a repeated stem
winning until its pair is complete. ``read_index`` lists members with their offsets and no payload. Both resolve the
pattern with the file system of the machine that plans the read; archives must lie in a folder that executors share.
"""

from __future__ import annotations

import glob
import json
import os
import tarfile
from collections.abc import Callable, Iterator
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schema import SAMPLE

#: Rows of a batch that a scan hands on, or fewer that hold so many bytes.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
AUDIO = ("mp3", "wav", "flac")
# What written metadata calls the source of each layout.
SOURCES = {"json_audio": "emilia", "txt_wav": "wenetspeech4tts"}
INDEX = "shard string, ord long, stem string, ext string, path string, offset long, size long, compressed boolean"
_LAYOUTS: dict[str, Callable[[tarfile.TarFile, dict], Iterator[dict]]] = {}


def register_layout(name: str, members: Callable[[tarfile.TarFile, dict], Iterator[dict]]) -> None:
    """Adds a layout: a function from an open archive and a dict of counters to dicts with fields of the sample schema."""
    _LAYOUTS[name] = members


def shard_name(path: str) -> str:
    name = os.path.basename(path)
    for end in (".tar.gz", ".tgz", ".tar"):
        if name.endswith(end):
            return name[: -len(end)]
    return name


def _files(archive: tarfile.TarFile) -> Iterator[tuple[tarfile.TarInfo, str, str]]:
    while (member := archive.next()) is not None:
        archive.members.clear()  # else the archive keeps every member that it has read
        if member.isfile():
            name = PurePosixPath(member.name)
            yield member, name.stem, name.suffix.lower().lstrip(".")


def _paired(archive: tarfile.TarFile, counters: dict, kinds: tuple[str, ...], meta_kind: str) -> Iterator[tuple[str, bytes, bytes, str]]:
    """(stem, metadata, audio, audio's extension) as pairs become complete; leftovers are counted."""
    meta, audio = {}, {}
    for member, stem, ext in _files(archive):
        if ext == meta_kind:
            meta[stem] = archive.extractfile(member).read()
        elif ext in kinds:
            audio[stem] = (archive.extractfile(member).read(), ext)
        if stem in meta and stem in audio:
            yield stem, meta.pop(stem), *audio.pop(stem)
    counters["unpaired_meta"], counters["unpaired_audio"] = len(meta), len(audio)


def _number(value) -> float | None:
    return float(value) if isinstance(value, int | float) and not isinstance(value, bool) else None


def _string(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _json_audio(archive: tarfile.TarFile, counters: dict) -> Iterator[dict]:
    known = {"id", "text", "language", "duration", "speaker", "dnsmos", "wav"}
    for stem, raw, audio, ext in _paired(archive, counters, AUDIO, "json"):
        info = json.loads(raw)
        rest = {k: v for k, v in info.items() if k not in known}
        yield {"key": _string(info.get("id", stem)), "stem": stem, "ext": ext, "audio": audio, "text": info.get("text"), "language": info.get("language"), "source_duration": _number(info.get("duration")), "speaker": _string(info.get("speaker")), "dnsmos": _number(info.get("dnsmos")), "source": SOURCES["json_audio"], "unread": json.dumps(rest, ensure_ascii=False) if rest else None}


def transcript_line(raw: bytes) -> str | None:
    """The first line's part after its first tab (all of it without a tab), stripped; null for an empty file."""
    lines = raw.decode("utf-8", "replace").splitlines()
    return lines[0].partition("\t")[2].strip() if lines and "\t" in lines[0] else lines[0].strip() if lines else None


def _txt_wav(archive: tarfile.TarFile, counters: dict) -> Iterator[dict]:
    for stem, raw, audio, _ in _paired(archive, counters, ("wav",), "txt"):
        yield {"key": stem, "stem": stem, "ext": "wav", "audio": audio, "text": transcript_line(raw), "language": "zh", "source": SOURCES["txt_wav"]}


register_layout("json_audio", _json_audio)
register_layout("txt_wav", _txt_wav)
_SAMPLE_FIELDS = dict(f.split() for f in SAMPLE.split(", "))


def _as_text(value) -> str | None:
    return value if value is None or isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def _sample_batch(rows: list[dict]):
    """Rows as an Arrow batch of the sample schema; what is no text in a string column is written as Spark does."""
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    columns = [pa.array([_as_text(r.get(f)) if kind == "string" else r.get(f) for r in rows], kinds[kind]) for f, kind in _SAMPLE_FIELDS.items()]
    return pa.record_batch(columns, names=list(_SAMPLE_FIELDS))


class _Shard(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.layout = _LAYOUTS.get(options.get("layout", "json_audio"))

    def partitions(self):
        paths = sorted(p for one in self.options["path"].split(",") for p in glob.glob(one))
        done = set(json.loads(self.options.get("done", "[]")))
        if not paths:
            raise FileNotFoundError(f"no archive matches {self.options['path']}")
        return [_Shard(p) for p in paths if shard_name(p) not in done] or [_Shard("")]

    def read(self, partition):
        if partition.path:
            with tarfile.open(partition.path) as archive:
                yield from (self.index(archive, partition.path) if self.options["mode"] == "index" else self.samples(archive, partition.path))

    def samples(self, archive, path):
        limit, shard = int(self.options.get("limit", "0") or 0), shard_name(path)
        rows, held = [], 0
        for k, row in enumerate(self.layout(archive, {})):
            rows.append({**row, "shard": shard, "ord": k})
            held += sum(len(v) for v in row.values() if isinstance(v, bytes | str))
            if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                yield _sample_batch(rows)
                rows, held = [], 0
            if limit and k + 1 >= limit:
                break
        if rows:
            yield _sample_batch(rows)

    def index(self, archive, path):
        packed = path.endswith("gz")
        for k, (member, stem, ext) in enumerate(_files(archive)):
            yield shard_name(path), k, stem, ext, path, None if packed else member.offset_data, member.size, packed


class ArchiveSource(DataSource):
    """format("voxloom_archive"): options path (glob), layout, mode (samples or index), limit, done (JSON list of shards)."""

    @classmethod
    def name(cls):
        return "voxloom_archive"

    def schema(self):
        return INDEX if self.options.get("mode") == "index" else SAMPLE

    def reader(self, schema):
        return _Reader({"mode": "samples", **self.options})


def _load(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("voxloom_archive").options(**options).load(path)


def read_samples(spark: SparkSession, path: str, layout: str = "json_audio", limit: int | None = None, done: list[str] | None = None) -> DataFrame:
    return _load(spark, path, mode="samples", layout=layout, limit=str(limit or 0), done=json.dumps(done or []))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return _load(spark, path, mode="index")


def unpaired_counts(spark: SparkSession, path: str, layout: str = "json_audio") -> DataFrame:
    """(shard, unpaired_meta, unpaired_audio) by anti-joins over the index, where stems do not repeat."""
    from pyspark.sql import functions as F

    meta = "json" if layout == "json_audio" else "txt"
    kinds = AUDIO if layout == "json_audio" else ("wav",)
    sides = read_index(spark, path).groupBy("shard", "stem").agg(F.count_if(F.col("ext") == meta).alias("m"), F.count_if(F.col("ext").isin(*kinds)).alias("a"))
    return sides.groupBy("shard").agg(F.count_if((F.col("m") > 0) & (F.col("a") == 0)).alias("unpaired_meta"), F.count_if((F.col("a") > 0) & (F.col("m") == 0)).alias("unpaired_audio"))


def read_bytes(pointers: DataFrame) -> DataFrame:
    """Adds ``payload`` to rows with path, offset, size (a null offset gives null): random access in plain archives."""
    import pyarrow as pa

    columns = pointers.columns
    places = [columns.index(c) for c in ("path", "offset", "size")]

    def run(batches):
        for b in batches:
            out = []
            for path, offset, size in zip(*(b.column(i).to_pylist() for i in places), strict=True):
                if offset is None or path is None:
                    out.append(None)
                    continue
                with open(path, "rb") as f:
                    f.seek(offset)
                    out.append(f.read(size))
            yield pa.record_batch([*b.columns, pa.array(out, pa.binary())], names=[*columns, "payload"])

    from pyspark.sql import types as T

    return pointers.mapInArrow(run, T.StructType([*pointers.schema.fields, T.StructField("payload", T.BinaryType())]))


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, stem, ext, payload) of audio kept as ``folder/shard/stem.ext``."""
    from pyspark.sql import functions as F

    files = spark.read.format("binaryFile").load(f"{folder}/*/*")
    parts = [F.regexp_extract("path", r"/([^/]+)/([^/]+)\.([^./]+)$", k).alias(c) for k, c in ((1, "shard"), (2, "stem"), (3, "ext"))]
    return files.select(*parts, F.col("content").alias("payload")).where(F.col("ext").isin(*AUDIO))


def passed_audio(spark: SparkSession, path: str) -> DataFrame:
    """(shard, key, ext, payload) of the samples in written archives."""
    return read_bytes(read_clean(spark, path).where("offset is not null").select("shard", "key", "ext", "path", "offset", "size")).select("shard", "key", "ext", "payload")


def source_audio(spark: SparkSession, drops: DataFrame, path: str, cached: DataFrame | None = None) -> DataFrame:
    """Dropped rows (shard, stem) with their source audio: from ``cached`` (as ``read_cache`` gives it) where it is there,
    else by offset in plain archives, by a scan in compressed ones."""
    stems = drops.select("shard", "stem").distinct()
    if cached is not None:
        held = stems.join(cached.select("shard", "stem", "ext", "payload"), ["shard", "stem"])
        rest = stems.join(cached.select("shard", "stem").distinct(), ["shard", "stem"], "left_anti")
        return held.unionByName(source_audio(spark, rest, path))
    index = read_index(spark, path).where("ext in ('mp3', 'wav', 'flac')").select("shard", "stem", "ext", "path", "offset", "size", "compressed")
    wanted = stems.join(index, ["shard", "stem"])
    plain = read_bytes(wanted.where("not compressed")).select("shard", "stem", "ext", "payload")
    packed = wanted.where("compressed").select("shard", "stem", "ext", "path")
    import pyarrow as pa

    def scan(batches):
        need: dict[str, dict] = {}
        for b in batches:
            for shard, stem, ext, p in zip(*(c.to_pylist() for c in b.columns), strict=True):
                need.setdefault(p, {})[stem, ext] = shard
        for p, keys in need.items():
            left = dict(keys)
            with tarfile.open(p) as archive:
                for member, stem, ext in _files(archive):
                    if (stem, ext) in left:
                        row = (left.pop((stem, ext)), stem, ext, archive.extractfile(member).read())
                        yield pa.record_batch([pa.array([x]) for x in row], names=["shard", "stem", "ext", "payload"])
                    if not left:
                        break

    return plain.unionByName(packed.repartition("path").mapInArrow(scan, "shard string, stem string, ext string, payload binary"))


def count_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(shard, n): members that end in .json."""
    from pyspark.sql import functions as F

    return read_index(spark, path).groupBy("shard").agg(F.count_if(F.col("ext") == "json").alias("n"))


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """(shard, ord, key, meta, path, offset, size, ext) of written archives: metadata as JSON text, audio by pointer.

    A metadata member without audio still counts.
    """
    from pyspark.sql import functions as F

    members = read_index(spark, path)
    meta = read_bytes(members.where("ext = 'json'")).select(F.regexp_replace("shard", "-clean$", "").alias("shard"), "ord", F.col("stem").alias("key"), F.decode("payload", "UTF-8").alias("meta"))
    audio = members.where("ext <> 'json'").select(F.regexp_replace("shard", "-clean$", "").alias("shard"), F.col("stem").alias("key"), "path", "offset", "size", "ext")
    return meta.join(audio, ["shard", "key"], "left")


def read_drops(spark: SparkSession, path: str) -> DataFrame:
    """(shard, key, stage, reason, meta) of reject files; blank lines are skipped, meta is JSON text or {}."""
    from pyspark.sql import functions as F

    rows = spark.read.text(path).select("value", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)-drops\.jsonl$", 1).alias("shard")).where(F.trim("value") != "")
    got = lambda name: F.get_json_object("value", f"$.{name}").alias(name)
    return rows.select("shard", got("key"), got("stage"), got("reason"), F.coalesce(F.get_json_object("value", "$.meta"), F.lit("{}")).alias("meta"))


