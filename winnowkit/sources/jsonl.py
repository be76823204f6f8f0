"""JSON lines in and out, each record kept as it came."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bits of a place in a file: 8 TB; the rest number up to a million files.
_PLACE_BITS = 43


class BadRecord(ValueError):
    """A line isn't a JSON object."""


def scan(spark: SparkSession, path: str) -> DataFrame:
    """(ord, line, record, file): blank lines skipped, ord by file name, then by place in the file.

    Within a file, a row's number is where its split begins plus its number in the task. A split that
    isn't its file's last has the full split size and so a task of its own, and a line has more
    than no bytes, so the numbers rise with the lines whatever the sizes and the parallelism.
    """
    files = sorted(spark.read.text(path).inputFiles())
    if len(files) > 1 << (63 - _PLACE_BITS):
        raise ValueError(f"{len(files)} files are more than one order can number: read them in parts")
    plain = lambda c: F.regexp_replace(c, r"^(\w+):/+", "$1:/")
    lines = _placed(spark, path).select((F.col("start") + F.col("row")).alias("place"), "line", "file")
    lines = lines.where(F.rlike("line", F.lit(r"(?U)\S")))
    ranks = spark.createDataFrame(list(enumerate(files)), "rank bigint, path string").select("rank", plain(F.col("path")).alias("path"))
    ranked = lines.join(F.broadcast(ranks), plain(F.col("file")) == F.col("path"))  # a row a file
    number = F.shiftleft(F.col("rank"), _PLACE_BITS) + F.col("place")
    return ranked.select(number.alias("ord"), "line", "file", F.try_parse_json("line").alias("record"))


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, row, line) of all lines: where the split begins, and the number in the task."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), row.alias("row"), F.col("value").alias("line"))


def line_number(spark: SparkSession, path: str, file: str, place: int) -> int:
    """The number from 1, blank lines counted, of the line of ``file`` at a place (``ord`` without the file's rank).

    The lines of the file are counted by split, a row a split; those of the splits before are added up.
    """
    splits = _placed(spark, path).where(F.col("file") == file).groupBy("start").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("start").collect()
    before = 0
    for s in splits:
        if s["start"] + s["first"] <= place < s["start"] + s["first"] + s["n"]:
            return before + place - s["start"] - s["first"] + 1
        before += s["n"]
    raise ValueError(f"{file} has no line at {place}")


def malformed(records: DataFrame) -> DataFrame:
    """Lines that aren't JSON objects: those that don't parse, and other values. What parses and begins with a brace is one; of the others the type is asked for."""
    other = ~F.rlike("line", F.lit(r"^[ \t\r\n]*\{")) & ~F.startswith(F.schema_of_variant("record"), F.lit("OBJECT"))
    return records.where(F.col("record").isNull() | other).select("file", "ord", "line")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``scan``, failing with the first malformed line."""
    found = scan(spark, path)
    bad = malformed(found).orderBy("ord").first()
    if bad is not None:
        number = line_number(spark, path, bad["file"], bad["ord"] & ((1 << _PLACE_BITS) - 1))
        raise BadRecord(f"{bad['file']}, line {number}: not a JSON object: {bad['line'][:160]}")
    return found


def agreed(path: str, compress: bool) -> str:
    """``path`` with the codec's suffix if ``compress``, without it if not; a path that agrees stays as it is."""
    bare = path.rstrip("/").removesuffix(".gz")
    return f"{bare}.gz" if compress else bare


def write(df: DataFrame, path: str, compress: bool | None = None, mode: str = "errorifexists") -> str:
    """One compact JSON object a line, nulls kept; the path written, whose suffix and codec agree.

    Without ``compress`` the path's suffix tells; with it, it tells and the path follows.
    """
    path = agreed(path, path.rstrip("/").endswith(".gz") if compress is None else compress)
    codec = "gzip" if path.endswith(".gz") else "uncompressed"
    df.write.mode(mode).option("ignoreNullFields", "false").option("compression", codec).json(path)
    return path


def newest(spark: SparkSession, pattern: str, missing_ok: bool = False) -> str | None:
    """The most recently changed path that matches."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    best = max(found or [], key=lambda s: (s.getModificationTime(), s.getPath().toString()), default=None)
    if best is None:
        if missing_ok:
            return None
        raise FileNotFoundError(pattern)
    return best.getPath().toString()


def unique_path(spark: SparkSession, path: str) -> str:
    """``path``, or the first of path-2, path-3, ... that doesn't exist; the number goes before the extensions."""
    jvm = spark.sparkContext._jvm
    head, _, name = path.rpartition("/")
    stem, dot, ends = name.partition(".")
    n = 1
    while True:
        found = f"{head}{'/' if head else ''}{stem}{f'-{n}' if n > 1 else ''}{dot}{ends}"
        p = jvm.org.apache.hadoop.fs.Path(found)
        if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return found
        n += 1
