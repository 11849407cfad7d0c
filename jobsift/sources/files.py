"""File sources and sinks: CSV drops, JSON payloads, crawl-history text,
run CSVs, table append / replicate, dual sink (S1-S14, S16, S19)."""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixtures import STAGING_COLUMNS
from ..functions.text import py_strip

# raw posting CSV header (21 columns; one site adds ChuyenMon after CongViec)
RAW_CSV_COLUMNS = ("CongViec", "ViTri", "YeuCauKinhNghiem", "MucLuong", "ThoiGianLamViec", "GioiTinh", "CapBac",
                   "HinhThucLamViec", "CongTy", "LinkCongTy", "QuyMoCongTy", "SoLuongTuyen", "HocVan", "YeuCauUngVien",
                   "MoTaCongViec", "QuyenLoi", "HanNopHoSo", "LinkBaiTuyenDung", "Nguon", "NgayCaoDuLieu", "LinhVuc")


def text_schema(columns) -> T.StructType:
    """All-text schema (explicit, never inferred)."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, columns=None, infer: bool = False) -> DataFrame:
    """Header CSV with quoted multi-line fields; a UTF-8 BOM on the
    header is tolerated; unreadable files are skipped (``ignoreCorruptFiles``)
    and an empty file contributes no rows.  Without ``infer`` every value is
    text (the reader never guesses types).  ``columns`` aligns by *name*:
    wanted columns a file lacks become NULL, extra ones are dropped."""
    r = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
         .option("encoding", "UTF-8").option("ignoreCorruptFiles", True))
    if infer:
        r = r.option("inferSchema", True)
    groups = header_groups(spark, path)
    df = union_by_name([r.csv(files) for files in groups]) if len(groups) > 1 else r.csv(path)
    if columns is None:
        return df
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def header_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of a drop by header line, as sites write other columns; files
    without a line are in no group.  One pass finds the first line of each
    file; only paths and headers reach the driver, which lists the files
    anyway."""
    heads = (spark.read.option("ignoreCorruptFiles", True).text(path)
             .select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
             .filter("block = 0").groupBy("file").agg(F.min_by("value", "place").alias("header")))
    by_header = (heads.groupBy(F.regexp_replace("header", "^\ufeff|\\s+$", "").alias("header"))
                 .agg(F.sort_array(F.collect_list(F.expr("url_decode(replace(file, '+', '%2B'))"))).alias("files")))
    return [r["files"] for r in by_header.orderBy("header").collect()]


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV that round-trips values exactly (no white-space trimming)."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_run_csv(df: DataFrame, out_dir: str, site: str, when: _dt.datetime | None = None) -> str | None:
    """Per-run CSV named ``<site>_jobs_<yyyy-MM-dd_HH-mm-ss>``; nothing
    is written when the run found no rows."""
    if df.isEmpty():
        return None
    when = when or _dt.datetime.now(_dt.timezone.utc)
    path = f"{out_dir.rstrip('/')}/{site}_jobs_{when.strftime('%Y-%m-%d_%H-%M-%S')}"
    write_csv(df, path)
    return path


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """One id (or URL) per line -> stripped, non-blank, distinct."""
    t = spark.read.text(path)
    v = py_strip(F.col("value"))
    return t.select(v.alias("id")).filter(F.col("id") != "").distinct()


def write_history(ids: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``append`` adds this run's accepted ids; ``overwrite`` rewrites
    the whole set."""
    ids.select(F.col(ids.columns[0]).cast("string").alias("value")).write.mode(mode).text(path)


def append_table(df: DataFrame, path: str) -> bool:
    """Append; an empty input is a no-op (returns False)."""
    if df.isEmpty():
        return False
    df.write.mode("append").parquet(path)
    return True


def replicate_full(spark: SparkSession, source: DataFrame, path: str) -> int:
    """Overwrite a full replica (non-numeric columns as text); the
    row count comes from an ``observe`` on the write, not a second scan."""
    from pyspark.sql import Observation
    if source.isEmpty():
        return 0  # an empty source leaves the replica as it is
    cols = [F.col(f.name) if isinstance(f.dataType, T.NumericType) or isinstance(f.dataType, (T.DateType,
            T.TimestampType, T.TimestampNTZType)) else F.col(f.name).cast("string").alias(f.name)
            for f in source.schema.fields]
    obs = Observation("replica")
    source.select(*cols).observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return int(obs.get["n"])


def project_existing(df: DataFrame, wanted) -> DataFrame:
    """Keep the wanted columns that exist, in wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def union_by_name(frames) -> DataFrame:
    """L4: union of frames with different columns (missing -> NULL)."""
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


#: Spark decides by these endings that a file is packed.
PACKED = r"\.(gz|bz2|zst|lz4|snappy|deflate)$"
QUARANTINE = T.StructType([T.StructField("path", T.StringType()), T.StructField("error", T.StringType())])


def inspect_files(spark: SparkSession, files: list[str]) -> list:
    """``(path, header, problem)`` of each file of a drop; only these reach the
    driver, which lists the files anyway.  A file without a header line or that is
    no UTF-8 text is a problem; packed files show theirs when read.

    Files are read by lines and in blocks, so a task holds a line, or sorts the
    lines of one block, however large a file is.  No UTF-8 sequence goes over a
    line break, so a file is UTF-8 text when each of its lines is.
    """
    listed = spark.read.format("binaryFile").load(files)
    paths = sorted(r["path"] for r in listed.select("path", "length").where("length > 0").collect())  # without the contents
    lines = (spark.read.option("lineSep", "\n").text(files)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
             .filter(~F.col("file").rlike(PACKED)))  # packed files are not opened
    text = {_plain(r["file"]): r["valid"] for r in lines.groupBy("file").agg(F.bool_and(F.is_valid_utf8("value")).alias("valid")).collect()}
    first = (lines.filter("block = 0").select("file", "value", F.monotonically_increasing_id().alias("place"))
             .groupBy("file").agg(F.regexp_replace(F.min_by("value", "place"), "^\ufeff|\\s+$", "").alias("header")))
    heads = {_plain(r["file"]): r["header"] for r in first.collect()}
    packed = [p for p in paths if re.search(PACKED, p)]
    heads |= {_plain(p, False): h for h, p in _packed_headers(spark, packed)} if packed else {}

    def problem(p: str) -> str | None:
        if re.search(PACKED, p):
            return None
        at = _plain(p, False)
        return "no header line" if not heads.get(at) else None if text[at] else "not UTF-8 text"

    # a file of no bytes is listed but gives no row
    empty = {_plain(f): unquote(f) for f in listed.inputFiles()}
    for p in paths:
        empty.pop(_plain(p, False), None)
    return [(p, heads.get(_plain(p, False)), problem(p)) for p in paths] + [(p, None, "no header line") for p in empty.values()]


def _plain(path: str, quoted: bool = True) -> str:
    """A path as one spelling: listings write ``file:/x`` and ``file:///x``."""
    return (unquote(path) if quoted else path).replace("///", "/", 1)


def _packed_headers(spark: SparkSession, files: list[str]) -> list[tuple[str, str]]:
    heads = (spark.read.option("ignoreCorruptFiles", True).text(files)
             .select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"))
             .groupBy("file").agg(F.min_by("value", "place").alias("header")).collect())
    plain = {_plain(f, False): f for f in files}
    return [(r["header"].strip("\ufeff \r\n\t"), plain[_plain(r["file"])]) for r in heads]


def _strict(spark: SparkSession, files: list[str]) -> DataFrame:
    """Rows of files with one header, all text; a file that breaks off fails the read."""
    r = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").option("ignoreCorruptFiles", False))
    return r.csv(files)


def backup_drop(spark: SparkSession, files: list[str], path: str) -> tuple[int, list[str], list[tuple[str, str]]]:
    """Write the full rows of all files of a drop to ``path`` as one table, with
    the file each came from in ``_file``; returns (rows, files read, (file, error)
    of those that cannot be read).

    All files are read in one job, strictly.  Only if that fails is each file read
    by itself, some at a time, to find which; their rows are then left out as a
    whole, so no half of a damaged file is loaded.
    """
    from pyspark.sql import Observation

    looked = inspect_files(spark, files)
    bad = [(p, problem) for p, _, problem in looked if problem]
    good = {p: h for p, h, problem in looked if not problem}
    damaged: list[tuple[str, str]] = []
    while good:
        groups: dict[str, list[str]] = {}
        for p, h in good.items():
            groups.setdefault(h or p, []).append(p)
        seen = Observation(f"drop-{uuid.uuid4().hex}")
        try:
            rows = union_by_name([_strict(spark, g).withColumn("_file", F.col("_metadata.file_path")) for g in groups.values()])
            rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
            return int(seen.get["n"]), sorted(good), bad + damaged
        except Exception:
            with ThreadPoolExecutor(8) as pool:
                errors = dict(zip(good, pool.map(lambda p: _error(spark, p), list(good)), strict=True))
            now = [(p, e) for p, e in errors.items() if e]
            if not now:
                raise
            damaged += now
            good = {p: h for p, h in good.items() if not errors[p]}
    return 0, [], bad + damaged


def _error(spark: SparkSession, path: str) -> str | None:
    """What goes wrong when all of a file is read; None if nothing does."""
    try:
        _strict(spark, [path]).write.format("noop").mode("overwrite").save()
    except Exception as e:  # noqa: BLE001 - any failure makes the file unreadable
        return str(e)
    return None


def quarantine(spark: SparkSession, bad: list[tuple[str, str]], path: str) -> None:
    """S3: the files that could not be read, and why; they stay where they are."""
    spark.createDataFrame(bad, QUARANTINE).coalesce(1).write.mode("overwrite").parquet(path)


def dual_sink(spark: SparkSession, files: list[str], backup_root: str, staging_path: str,
              columns=STAGING_COLUMNS, run_id: str | None = None) -> DataFrame:
    """The files' full rows go to the backup sink as one table; projected to
    the staging columns that exist they go to staging.  The backup keeps every
    run in its own ``run=<id>`` folder (a retry that passes the same id replaces
    only its own); files that cannot be read are listed in ``<backup>-quarantine``.
    Files are archived by the caller only after both writes succeed."""
    run_id = run_id or uuid.uuid4().hex[:12]
    backup = f"{backup_root.rstrip('/')}/run={run_id}"
    _, read, bad = backup_drop(spark, files, backup)
    if bad:
        quarantine(spark, bad, f"{backup_root.rstrip('/')}-quarantine/run={run_id}")
    if read:
        project_existing(spark.read.parquet(backup), columns).write.mode("append").parquet(staging_path)
    return spark.read.parquet(staging_path)


def page_watermark(state: DataFrame, col: str, default: int, step: int) -> DataFrame:
    """Stored page number, default when absent or not numeric, +step."""
    v = F.coalesce(F.col(col).cast("string").try_cast("int"), F.lit(default))
    return state.withColumn("next_page", (v + F.lit(step)).cast("int"))


REJECTS = "doc string, pos int, field string, value string"


def import_documents(docs: DataFrame, doc: str, col: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Documents that hold a JSON array of objects (or one object) as typed
    rows, and the table of what did not convert.

    Each document is read as a whole and its elements become rows ``(doc, pos,
    fields)``; a key that an element lacks is NULL.  Every field is first read as
    the text it is, then converted: a value that is there and does not convert is
    NULL in the row and one row ``(doc, pos, field, value)`` of the rejects.  A
    document that is no JSON is one reject without field.
    """
    texts = T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    parsed = docs.select(F.col(doc).cast("string").alias("doc"), F.col(col).alias("_raw"), F.from_json(F.col(col), texts).alias("_all"))
    given = parsed.select("doc", F.posexplode("_all").alias("pos", "_one"))
    typed = {f.name: F.col(f"_one.`{f.name}`").try_cast(f.dataType) for f in schema.fields}
    rows = given.select("doc", "pos", *[c.alias(n) for n, c in typed.items()])
    bad = F.array(*[F.when(F.col(f"_one.`{n}`").isNotNull() & c.isNull(), F.struct(F.lit(n).alias("field"), F.col(f"_one.`{n}`").alias("value"))) for n, c in typed.items()])
    rejects = given.select("doc", "pos", F.inline(F.array_compact(bad)))
    unread = parsed.where(F.col("_raw").isNotNull() & F.col("_all").isNull()).select(
        "doc", F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("field"), F.col("_raw").alias("value"))
    return rows, rejects.unionByName(unread)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc, content)``: each file as one text, named by its path."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("doc"), F.col("value").alias("content"))


# API payload
API_SCHEMA = T.StructType([
    T.StructField("jobId", T.LongType()), T.StructField("jobTitle", T.StringType()),
    T.StructField("companyName", T.StringType()), T.StructField("prettySalary", T.StringType()),
    T.StructField("jobUrl", T.StringType()),
    T.StructField("skills", T.ArrayType(T.StructType([T.StructField("skillName", T.StringType())]))),
    T.StructField("locations", T.ArrayType(T.StructType([T.StructField("locationNameVI", T.StringType())]))),
    T.StructField("jobDescription", T.StringType()), T.StructField("jobRequirement", T.StringType())])


def api_flatten(payload: DataFrame, col: str = "payload") -> DataFrame:
    """Typed parse, 'N/A' for missing keys and for missing or empty
    lists, lists joined, HTML to text ('' when missing); rows without an id
    are dropped."""
    from ..functions.html import html_to_text
    p = payload.select(F.from_json(F.col(col), API_SCHEMA).alias("j")).select("j.*").filter(F.col("jobId").isNotNull())
    na = F.lit("N/A")

    def joined(items: str, field: str):
        present = F.filter(items, lambda s: s.isNotNull())
        text = F.array_join(F.transform(present, lambda s: F.coalesce(s[field], F.lit(""))), ", ")
        return F.when(F.size(items) > 0, text).otherwise(na)

    return p.select(
        "jobId",
        F.coalesce("jobTitle", na).alias("CongViec"), F.coalesce("companyName", na).alias("CongTy"),
        F.coalesce("prettySalary", na).alias("MucLuong"), F.coalesce("jobUrl", na).alias("LinkBaiTuyenDung"),
        joined("skills", "skillName").alias("KyNang"), joined("locations", "locationNameVI").alias("ViTri"),
        F.coalesce(html_to_text(F.col("jobDescription")), F.lit("")).alias("MoTaCongViec"),
        F.coalesce(html_to_text(F.col("jobRequirement")), F.lit("")).alias("YeuCauUngVien"))
