"""A cleaning run over archives, end to end, with resume."""

from __future__ import annotations

import argparse
import logging
import os
import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from ..functions.audio import with_durations
from ..operators.models import device_memory, timed_rows
from ..operators.pairing import assign_workers
from ..operators.reject import counters, render_counters, throughput, with_rejects
from ..sources import archives, sinks
from .config import Settings, build_steps, load, run_steps

log = logging.getLogger(__name__)
#: Shards that are cleaned, and lost or finished, together; several times the tasks that the cluster runs at once.
WAVE = 256


def clean(spark: SparkSession, path: str, settings: Settings, layout: str = "json_audio", backends: dict | None = None, limit: int | None = None, done: list[str] | None = None) -> DataFrame:
    """Annotated and judged samples of all archives that ``path`` matches; rejected rows carry their reason."""
    rows = archives.read_samples(spark, path, layout, limit, done)
    return run_steps(with_rejects(with_durations(rows)), build_steps(settings, backends))


def run_shards(spark: SparkSession, path: str, folder: str, settings: Settings, layout: str = "json_audio", backends: dict | None = None, limit: int | None = None, worker: int = 0, workers: int = 1, wave: int = WAVE) -> str:
    """Cleans the shards of ``path`` that have no marker in ``folder`` and writes their outputs; returns the counters as text.

    Shards run in waves of at most ``wave``, each one job, and are marked as their wave's files are committed: a failure
    later on leaves them finished. The shards of a wave that fails are run again one by one, so that only those
    that fail alone are left; when all others are done, an error names them.
    """
    import glob

    paths = sorted(p for one in path.split(",") for p in glob.glob(one))
    if not paths:
        raise FileNotFoundError(f"no archive matches {path}")
    names: dict[str, str] = {}
    for p in paths:
        if names.setdefault(archives.shard_name(p), p) != p:
            raise ValueError(f"two archives are called {archives.shard_name(p)}: {names[archives.shard_name(p)]} and {p}")
    if workers > 1:
        dealt = assign_workers(spark.createDataFrame([(n,) for n in names], "shard string"), workers)
        mine = {r.shard for r in dealt.collect() if r.worker == worker}
        names = {n: p for n, p in names.items() if n in mine}
    finished = set(sinks.done_shards(folder))
    left = sorted(set(names) - finished)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(settings.batch_size))  # rows hold audio
    total: Counter[str] = Counter()
    failed: dict[str, Exception] = {}

    def run(shards: list[str]) -> None:
        total.update(_run_wave(spark, {n: names[n] for n in shards}, folder, settings, layout, backends, limit))

    for lo in range(0, len(left), wave):
        shards = left[lo : lo + wave]
        try:
            run(shards)
        except Exception as e:  # noqa: BLE001  any failure is told of below
            if len(shards) == 1:
                failed[shards[0]] = e
                continue
            log.warning("a wave of %d shards failed (%s), running them one by one", len(shards), type(e).__name__)
            for one in shards:
                try:
                    run([one])
                except Exception as alone:  # noqa: BLE001
                    failed[one] = alone
    said = render_counters(dict(total))
    log.info("done. totals: %s", said)
    if backends:
        for r in device_memory(spark).orderBy("device").collect():  # a row a GPU of one machine
            log.info("gpu %d peak memory: allocated %.1f GB / reserved %.1f GB", r.device, r.allocated / 2**30, r.reserved / 2**30)
    if failed:
        raise RuntimeError(f"{len(failed)} of {len(left)} shards failed: {', '.join(sorted(failed))}; {said}") from next(iter(failed.values()))
    return said


def _run_wave(spark: SparkSession, paths: dict[str, str], folder: str, settings: Settings, layout: str, backends: dict | None, limit: int | None) -> dict[str, int]:
    """Cleans, writes and marks some shards; their counters."""
    rows = clean(spark, ",".join(paths.values()), settings, layout, backends, limit)
    base = spark.conf.get("spark.checkpoint.dir", None) or f"file://{os.path.abspath(folder)}/.work"
    held = f"{base}/clean-{uuid.uuid4().hex}"
    rows.write.parquet(held)  # models run once, whatever the sinks read
    rows = spark.read.schema(rows.schema).parquet(held)
    sinks.write_run(rows, folder, sorted(paths), settings.thresholds())
    for r in sinks.shard_log(spark, rows).collect():  # a row a shard of the wave
        log.info("%s: %d -> %d kept (%.1f%%)", r.shard, r.n_in, r.n_out, r.kept_percent)
    if "timing" in rows.columns:
        for r in throughput(timed_rows(rows)).collect():  # a row a stage
            log.info("timing | %s: %.1fs (%.0f%%) %.1f samples/s, %.1fx realtime", r.stage, r.seconds, 100 * (r.share or 0), r.items_per_sec or 0, r.times_real_time or 0)
    return {r.name: r.n for r in counters(rows).collect()}


def setup_logging(verbose: bool = False) -> None:
    logging.basicConfig(level=logging.DEBUG if verbose else logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Clean speech archives.")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--config", required=True)
    p.add_argument("--layout", default="json_audio")
    p.add_argument("--worker-id", type=int, default=0)
    p.add_argument("--num-workers", type=int, default=1)
    p.add_argument("--limit-samples", type=int, default=None)
    p.add_argument("--verbose", action="store_true")
    a = p.parse_args(argv)
    setup_logging(a.verbose)
    spark = SparkSession.builder.appName("voxloom").getOrCreate()
    print(run_shards(spark, a.input, a.output, load(a.config), a.layout, None, a.limit_samples, a.worker_id, a.num_workers))


if __name__ == "__main__":
    main()
