"""FASTQ, FASTA and SAM files as tables.

``spark.dataSource.register(FastqDataSource)``, then ``spark.read.format("readpairs").load(folder_or_glob)``.
One partition a file: compressed FASTQ can't be split, and files are written in chunks of a bounded number of pairs.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from readloom.functions.seqs import bare

#: Pairs of one Arrow batch.
BATCH_PAIRS = 10_000
#: Longest name of a source.
MAX_NAME = 245
PAIR_SCHEMA = "source string, ordinal bigint, read_id string, fwd_header string, fwd_seq string, fwd_qual string, rev_header string, rev_seq string, rev_qual string"
_READS = (".fastq.zst", ".fq.zst", ".fastq.gz", ".fq.gz", ".fastq", ".fq")


class FilePartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path on it: local, or by its scheme (file, s3, s3a, gs, hdfs)."""
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def read_files(path: str) -> list[str]:
    """The FASTQ files of a folder, or of a name with wildcards, as they are opened; sorted."""
    scheme = path[: path.index("://") + 3] if "://" in path else ""
    folder, _, name = path.rpartition("/")
    wild = any(c in name for c in "*?[")
    system, at = _opened(folder or "." if wild else path)
    info = system.get_file_info(at)
    if not wild and info.type == fs.FileType.File:
        found = [at]
    else:
        listed = system.get_file_info(fs.FileSelector(at, allow_not_found=True))
        found = [x.path for x in listed if x.type == fs.FileType.File and (not wild or fnmatch.fnmatch(x.base_name, name))]
    return sorted(scheme + x for x in found if x.lower().endswith(_READS))


def _lines(path: str) -> Iterator[str]:
    low = path.lower()
    kind = "zstd" if low.endswith(".zst") else "gzip" if low.endswith(".gz") else None
    system, at = _opened(path)
    with system.open_input_stream(at, compression=kind) as stream:
        rest = b""
        while chunk := stream.read(1 << 20):
            *whole, rest = (rest + chunk).split(b"\n")
            yield from (x.rstrip(b"\r").decode() for x in whole)
        if rest:
            yield rest.rstrip(b"\r").decode()


def _fastq(path: str) -> Iterator[tuple[str, str, str]]:
    """(header, sequence, quality) of each record; an error where the file isn't made of four-line records."""
    four: list[str] = []
    for line in _lines(path):
        four.append(line)
        if len(four) == 4:
            if four[0][:1] != "@" or four[2][:1] != "+":
                raise ValueError(f"{path}: not a FASTQ record: {four[0][:60]!r}")
            yield four[0], four[1], four[3]
            four = []
    if [x for x in four if x]:
        raise ValueError(f"{path}: the last record is not whole")


class PairReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = read_files(options["path"])

    def partitions(self) -> list[InputPartition]:
        return [FilePartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PAIR_SCHEMA.split(", ")]
        source = name_of_path(partition.path)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "ordinal" else pa.string()) for n, c in zip(names, cols)], names)

        records = _fastq(partition.path)
        for ordinal, fwd in enumerate(records):
            rev = next(records, None)
            if rev is None:
                raise ValueError(f"{partition.path}: a forward read has no mate")
            rows.append((source, ordinal, re.sub(r"/[12]$", "", fwd[0][1:].split(None, 1)[0] if len(fwd[0]) > 1 else ""), *fwd, *rev))
            if len(rows) >= BATCH_PAIRS:
                yield batch()
        if rows:
            yield batch()


class FastqDataSource(DataSource):
    """Interleaved read pairs of FASTQ files, plain, gzip or zstd: one row a pair, numbered within its file."""

    @classmethod
    def name(cls) -> str:
        return "readpairs"

    def schema(self) -> str:
        return PAIR_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PairReader(self.options)


def name_of_path(path: str) -> str:
    """The name of a source: its path's parts joined by ``-``, without the scheme and the last two extensions."""
    parts = [x for x in re.sub(r"^\w+:/+", "", path).split("/") if x]
    return re.sub(r"(?:\.[^.]*){1,2}$", "", "-".join(parts)) if parts else ""


def source_name(path: Column) -> Column:
    """``name_of_path`` as a column expression."""
    parts = F.filter(F.split(F.regexp_replace(path, r"^\w+:/+", ""), "/"), lambda x: x != "")
    return F.regexp_replace(F.array_join(parts, "-"), r"(?:\.[^.]*){1,2}$", "")


def source_records(paths: DataFrame, col: str = "s3_path") -> DataFrame:
    """``(s3_path, filename, problem)`` of each distinct path; problem is null for a good one.

    A path needs a scheme s3 or file, a name that ends in .fastq.zst or .fq.zst in any case, and a source name of at
    most ``MAX_NAME`` letters that no other path has.
    """
    rows = paths.where(F.col(col).isNotNull()).select(bare(F.col(col)).alias("s3_path")).where("s3_path != ''").distinct().withColumn("filename", source_name(F.col("s3_path")))
    shared = rows.groupBy("filename").agg(F.count("*").alias("n"))
    problem = F.when(~F.col("s3_path").rlike(r"^(?:s3|file):/"), "scheme").when(~F.lower("s3_path").rlike(r"\.(?:fastq|fq)\.zst$"), "extension").when(F.length("filename") > MAX_NAME, "length").when(F.col("n") > 1, "repeated")
    return rows.join(shared, "filename").select("s3_path", "filename", problem.alias("problem"))


def list_files(spark: SparkSession, path: str, suffix: str = ".fastq.zst") -> DataFrame:
    """``(path, length)`` of the files under a prefix, by Spark's own listing: local, s3 or any Hadoop file system."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path).select("path", "length")


def uris(files: DataFrame, prefix: str) -> DataFrame:
    """``(path, s3_path)``: the address of each listed file under an s3 prefix."""
    if not prefix.startswith("s3://"):
        raise ValueError(f"not an s3 address: {prefix}")
    return files.select("path", F.concat(F.lit(prefix.rstrip("/") + "/"), F.element_at(F.split("path", "/"), -1)).alias("s3_path"))


def sample_name(path: Column) -> Column:
    """The name of a sample: its file's name without what marks a mate's file."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"_[12]\.fastq$", "")


def missing_priorities(paths: DataFrame) -> DataFrame:
    """``(priority)``: the numbers from 1 to the largest priority that no path has."""
    top = paths.agg(F.max("priority").alias("top")).where("top >= 1")
    return top.select(F.explode(F.sequence(F.lit(1), F.col("top").cast("int"))).alias("priority")).join(paths.select(F.col("priority").cast("int").alias("priority")), "priority", "left_anti")


def paths_by_priority(paths: DataFrame, priority: int) -> DataFrame:
    """The rows of a priority, after a check that priorities are 1 to the largest without gaps."""
    low, high, kinds = paths.agg(F.min("priority"), F.max("priority"), F.count_distinct("priority")).first()
    if low is not None and (low != 1 or high != kinds):
        first = [str(r[0]) for r in missing_priorities(paths).orderBy("priority").limit(20).collect()]
        raise ValueError(f"priorities must be 1 to {high} without gaps; missing: {', '.join(first) or 'none'}; smallest: {low}")
    return paths.where(F.col("priority") == priority)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``(idx, id, description, seq)`` of FASTA files; records may span lines; idx grows in the order of the records.

    Spark divides the files between records, so only a record must fit a task.
    """
    text = spark.read.option("lineSep", "\n>").text(path)
    records = text.select(F.monotonically_increasing_id().alias("idx"), F.regexp_replace("value", r"^\s*>", "").alias("r")).where("length(trim(r)) > 0")
    header = F.trim(F.regexp_extract("r", r"^([^\r\n]*)", 1))
    return records.select("idx", F.regexp_extract(header, r"^(\S*)", 1).alias("id"), header.alias("description"), F.regexp_replace(F.regexp_replace("r", r"^[^\r\n]*", ""), r"\s", "").alias("seq"))


def contig_by_name(seqs: DataFrame, name: str) -> DataFrame:
    """``(idx, id, description, seq)`` of the first sequence whose whole header or first word is the name, in upper case; an error if there is none."""
    found = seqs.where((F.col("description") == name) | (F.col("id") == name)).orderBy("idx").limit(1).withColumn("seq", F.upper("seq"))
    if found.isEmpty():
        raise ValueError(f"no sequence is named {name}")
    return found.select("idx", "id", "description", "seq")


def read_sam(spark: SparkSession, path: str, contig: str | None = None) -> DataFrame:
    """``(qname, flag, ref_name, pos, cigar, seq)`` of SAM text, of one contig if it is named; pos counts from 0, cigar is an array of (op, len)."""
    rows = spark.read.text(path).where(~F.col("value").startswith("@")).select(F.split("value", "\t").alias("f")).where("size(f) >= 10")
    pieces = F.expr("transform(regexp_extract_all(f[5], '([0-9]+)([MIDNSHP=X])', 0), x -> named_struct('op', right(x, 1), 'len', int(left(x, length(x) - 1))))")
    out = rows.select(F.col("f")[0].alias("qname"), F.col("f")[1].cast("int").alias("flag"), F.col("f")[2].alias("ref_name"), (F.col("f")[3].cast("int") - 1).alias("pos"), pieces.alias("cigar"), F.col("f")[9].alias("seq"))
    return out if contig is None else out.where(F.col("ref_name") == contig)
