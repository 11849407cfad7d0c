"""Spark session helpers.

The library never creates a cluster session itself in production code
paths; ``get_session`` is for tests, the bench and the entry point.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed processing timestamp used wherever the source system calls "now()",
# so that runs are deterministic and comparable with the SQL oracle.
AS_OF = "2025-01-01 00:00:00"
AS_OF_DATE = "2025-01-01"


def get_session(master: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName("jobsift")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (distributed) folder and is
    respected as is.  Only when it is unset (local tests) a fresh scratch
    folder is created and registered.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="jobsift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


#: Bytes of a generated method beyond which HotSpot leaves it to its interpreter.
COMPILED_METHOD_BYTES = 8000


def compiled_stages(spark: SparkSession) -> None:
    """Lower the session's bound on a whole stage's generated method to what the
    JVM compiles; a stage over it runs by its operators, whose code is split into
    small methods, instead of being interpreted row by row."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key, "65535")) > COMPILED_METHOD_BYTES:
        spark.conf.set(key, str(COMPILED_METHOD_BYTES))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: cuts the lineage so later stages reread a stored table instead of
    recomputing the plan (and survive executor loss)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem (works for HDFS/S3/local)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` ([] when it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, through the Hadoop FileSystem."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small text file as a whole: it is written beside ``path`` and
    renamed, which fails when ``path`` is there already."""
    jvm = spark.sparkContext._jvm
    fs, target = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    keep[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        files.rename(draft, target, keep)
    except Exception:
        fs.delete(draft, False)
        raise FileExistsError(path) if fs.exists(target) else OSError(f"cannot create {path}") from None


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path`` ([] when it does not exist)."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()] if fs.exists(p) else []


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, path: str, target: str) -> None:
    """Rename within one file system; the folder of ``target`` is made first."""
    fs, source = _fs(spark, path)
    goal = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(goal.getParent())
    if not fs.rename(source, goal):
        raise OSError(f"cannot move {path} to {target}")
