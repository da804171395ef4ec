"""Session set-up, shared scratch folders and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_test_folders: dict[str, str] = {}


def build_session(app_name: str = "tagloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Partition settings for reading ``input_bytes`` on ``cores``.

    Shuffles start with partitions of about 256 MB, were all the input shuffled, and at least two
    waves of tasks; AQE merges those that turn out small.  The upper limit keeps the number of
    shuffle blocks (map tasks x partitions) within what the shuffle service can index.
    """
    wanted = max(2 * cores, -(-input_bytes // (256 << 20)))
    return {
        "spark.sql.shuffle.partitions": str(min(wanted, 50_000)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
        "spark.sql.files.maxPartitionBytes": "256MB" if input_bytes > 1 << 40 else "128MB",
    }


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder, which goes with the process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    app = context.applicationId
    if app not in _test_folders:
        _test_folders[app] = tempfile.mkdtemp(prefix="tagloom-")
        atexit.register(shutil.rmtree, _test_folders[app], ignore_errors=True)
    return _test_folders[app]


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared root that no other run uses; ``release`` removes those of an application."""
    return f"{_run_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/tagloom/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Remove everything this application wrote below the shared root; call it when its results are stored."""
    remove_path(spark, _run_folder(spark))


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame, purpose: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps then start from the files: a lost executor does not restart the plan before them,
    repeated passes do not repeat it, and Catalyst knows the size.
    """
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
