"""Session helpers.

The library never changes the configuration of a session it is handed;
``get_session`` is for tests, the bench and command-line use only.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import SparkConf
from pyspark.sql import SparkSession

_CHECKPOINT_LOCK = threading.Lock()

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # dense keys checkpoint their slices; drop the files once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "starloom", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the toolkit expects.

    Under ``spark-submit`` the submitted master and the cluster's own
    ``spark.sql.shuffle.partitions`` are kept (size it for the largest fact,
    about 128-256 MB per partition); a local session gets 8 partitions unless
    ``shuffle_partitions`` says otherwise.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None or SparkConf().get("spark.master", None) is None:
        master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
        builder = (builder.master(master)
                   .config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEMORY", "16g")))
        shuffle_partitions = shuffle_partitions or 8
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (see ``ensure_checkpoint_dir``)."""
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only where none is set.

    On a cluster the operator names shared storage in ``spark.checkpoint.dir``
    and it is only read here.  A fresh local folder is used only for a
    ``local[...]`` master (tests, the bench); elsewhere a missing setting is
    an error rather than a machine-local fallback.
    """
    sc = spark.sparkContext
    with _CHECKPOINT_LOCK:  # dimensions may be keyed from several threads at once
        current = sc.getCheckpointDir()
        if current:
            return current
        conf = (spark.conf.get("spark.checkpoint.dir", None)
                or sc.getConf().get("spark.checkpoint.dir", None))
        if conf:
            sc.setCheckpointDir(conf)
        elif sc.master.startswith("local"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-ckpt-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (needed for dense keys)")
        return sc.getCheckpointDir()


def run_concurrently(actions: dict[str, Callable[[], object]], parallel: int | None = None,
                     spark: SparkSession | None = None) -> dict:
    """Run independent Spark actions (one per table) from a small thread
    pool, so their jobs share the cluster: cores that one job's last tasks
    leave idle go to the others.  When one action fails, the Spark jobs of
    the others are cancelled (one job group per call) rather than left to run
    to the end; every action has returned before that failure is raised, so
    a caller never acts on a half-done set.  ``parallel=1`` runs them one
    after another.  Without ``spark`` (plain Python actions) nothing is
    cancelled."""
    n = min(parallel or len(actions), len(actions))
    if n <= 1:
        return {k: f() for k, f in actions.items()}
    sc = spark.sparkContext if spark is not None else None
    # nested calls (a group of tables whose own steps run concurrently) share
    # the outer job group, so one failure cancels every sibling job
    inherited = sc.getLocalProperty("spark.jobGroup.id") if sc is not None else None
    group = (inherited if inherited and inherited.startswith("starloom-")
             else f"starloom-{uuid.uuid4().hex}")

    def in_group(f):
        def run():
            if sc is not None:
                sc.setJobGroup(group, "starloom concurrent table jobs")
            return f()
        return run

    with ThreadPoolExecutor(max_workers=n) as pool:
        futures = {k: pool.submit(in_group(f)) for k, f in actions.items()}
        done, _ = wait(futures.values(), return_when=FIRST_EXCEPTION)
        failed = [f for f in done if f.exception() is not None]
        if failed and sc is not None:
            sc.cancelJobGroup(group)
        wait(futures.values())
    if failed:
        raise failed[0].exception()  # the cause, not a sibling's cancellation
    return {k: f.result() for k, f in futures.items()}
