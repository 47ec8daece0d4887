"""Readers and writers of snapshots, dimensions and artifacts."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a file that are read at a time.
BLOCK = 4 << 20
MANIFEST = "country_code string, snapshot_date date, files array<struct<name:string,sha256:string,bytes:long>>"


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores (one file with one row group, say) is dealt to all of them; any other
    is left as it is, so a large table isn't shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names; in a temporary folder only where Spark runs in this process."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and outlives executors. Ids are hex digits, which only an entropy coder shortens."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Take away a folder of ``shared_path`` that nothing will read again."""
    path_ = spark._jvm.org.apache.hadoop.fs.Path(path)
    path_.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path_, True)


def few_files(df: DataFrame, name: str) -> DataFrame:
    """``written`` by at most four tasks for each core, so that files aren't small, however small the partitions are that adaptive execution makes."""
    return written(df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism), name)


def by_texts(rows: DataFrame, texts: list[str], make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` with what ``make`` gives for the columns ``texts``, in their place: it sees each distinct set of their values once, as a list has
    few texts for its rows. What it makes is written, so its size decides how the rows meet it."""
    key = lambda k: f"_text_{k}"
    told = rows.select(*[F.col(f"`{c}`").alias(key(k)) for k, c in enumerate(texts)]).distinct()
    made = make(told.select("*", *[F.col(key(k)).alias(c) for k, c in enumerate(texts)]))
    new = [c for c in made.columns if not c.startswith("_text_")]
    made = written(made.withColumnsRenamed({key(k): f"_of{key(k)}" for k in range(len(texts))}), "texts")
    same = None
    for k in range(len(texts)):
        one = F.col(key(k)).eqNullSafe(F.col(f"_of{key(k)}"))
        same = one if same is None else same & one
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in texts and c not in new]
    own = rows.select(*rest, *[F.col(f"`{c}`").alias(key(k)) for k, c in enumerate(texts)])
    return own.join(made, same, "left").select(*rest, *[F.col(f"`{c}`") for c in new])


def read_delimited(spark: SparkSession, path: str, columns: list[str], separator: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """A list with a header, every column as text; quoted fields may hold separators and line ends."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).csv(path, header=True, sep=separator, encoding=encoding, quote='"', escape='"', multiLine=True, enforceSchema=False)


def read_json_records(spark: SparkSession, path: str, schema: str, price: str | None = None) -> DataFrame:
    """JSON lines without blank lines, rows with _error, or (where named) rows without a price."""
    rows = spark.read.schema(f"{schema}, _error string").json(path).where("_error is null").drop("_error")
    return rows if price is None else rows.where(F.coalesce(F.trim(F.col(price).cast("string")), F.lit("")).isin("", "0", "0.0") == F.lit(False))


def read_records(spark: SparkSession, path: str, schema: str, price: str = "price_amount") -> DataFrame:
    """Canonical records under a declared schema, the price as a decimal; an empty frame if the folder doesn't exist."""
    path_ = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = path_.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path_)
    rows = spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
    return rows.withColumn(price, F.col(price).try_cast("decimal(18,6)"))


def read_dimension(spark: SparkSession, path: str, schema: str, lines: bool = True) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=not lines)


def with_path_value(df: DataFrame, pattern: str, name: str) -> DataFrame:
    """Add the part of each row's file path that group 1 of ``pattern`` matches, and the file name."""
    path = F.col("_metadata.file_path")
    return df.select("*", F.regexp_extract(path, pattern, 1).alias(name), F.element_at(F.split(path, "/"), -1).alias("file_name"))


def manifest_files(manifests: DataFrame) -> DataFrame:
    return manifests.select("country_code", "snapshot_date", F.explode("files").alias("file")).select("country_code", "snapshot_date", "file.*")


def file_digests(spark: SparkSession, folder: str, opener: Callable[[str], BinaryIO] | None = None) -> DataFrame:
    """(name, bytes, sha256) of every file below ``folder`` that isn't empty, the name being its path below it.

    Spark lists the files without reading them (it passes over empty ones); a task then streams each of its files in blocks, so a file of
    any size is digested in constant memory. ``opener`` opens a path on an executor; by default that is a path of a mounted folder (file:).
    A store that only Spark reads needs an opener of its own, else its files are read as one value each, of 2 GB at most.
    """
    below = re.escape(folder.rstrip("/").split("://")[-1].removeprefix("file:")) + "/(.+)$"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_extract("path", below, 1).alias("name")
    if opener is None and not _mounted(folder):
        return files.select(name, F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return _digested(files.select("path", name), opener)


def _digested(files: DataFrame, opener: Callable[[str], BinaryIO] | None) -> DataFrame:
    """(name, bytes, sha256) of the files (path, name) that can be opened."""
    open_path = opener or (lambda path: open(re.sub("^file:/*", "/", path), "rb"))  # sent to executors by value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                digest, size = hashlib.sha256(), 0
                try:
                    f = open_path(path)
                except FileNotFoundError:
                    continue
                with f:
                    while block := f.read(BLOCK):
                        digest.update(block)
                        size += len(block)
                yield pa.RecordBatch.from_pydict({"name": [name], "bytes": pa.array([size], pa.int64()), "sha256": [digest.hexdigest()]})

    return files.repartition(files.sparkSession.sparkContext.defaultParallelism, "path").mapInArrow(run, "name string, bytes long, sha256 string")


def _mounted(folder: str) -> bool:
    return bool(re.match("(file:)?/", folder))


def verify_files(spark: SparkSession, folder: str, manifests: DataFrame, opener: Callable[[str], BinaryIO] | None = None) -> DataFrame:
    """(country_code, snapshot_date, name, status) of the manifests' files, named by their paths below ``folder``: ok, missing
    or mismatch (see file_digests). What isn't listed is looked for once more by its name, as empty files aren't."""
    told = manifest_files(manifests)
    seen = file_digests(spark, folder, opener).select("name", "sha256")
    if opener or _mounted(folder):
        seen = written(seen, "digests")
        rest = told.select("name").distinct().join(seen, "name", "left_anti")
        seen = seen.unionByName(_digested(rest.select(F.concat(F.lit(f"{folder.rstrip('/')}/"), "name").alias("path"), "name"), opener).select("name", "sha256"))
    j = told.join(seen.withColumnRenamed("sha256", "_sha"), "name", "left")
    return j.select("country_code", "snapshot_date", "name", F.when(F.col("_sha").isNull(), "missing").when(F.col("_sha") != F.lower("sha256"), "mismatch").otherwise("ok").alias("status"))


def write_json(df: DataFrame, path: str, by: list[str] | None = None, compression: str = "none") -> None:
    (df.write.partitionBy(*by) if by else df.write).mode("errorifexists").json(path, compression=compression)


def write_candidates(candidates: DataFrame, evidence: DataFrame, rules: DataFrame, path: str) -> None:
    """Candidates (Parquet), their evidence and the rules behind it, each rule once (JSON lines), by ``window``."""
    candidates.write.mode("errorifexists").partitionBy("window").parquet(f"{path}/candidates")
    write_json(evidence, f"{path}/evidence", ["window"])
    write_json(rules.dropDuplicates(["window", "id"]), f"{path}/rules", ["window"])


def write_reviews(assessments: DataFrame, queue: DataFrame, path: str) -> None:
    """Assessments and the queue of those that need a look, as JSON lines by ``window``."""
    write_json(assessments, f"{path}/assessments", ["window"])
    write_json(queue, f"{path}/queue", ["window"])


def write_profiles(profiles: DataFrame, statuses: DataFrame, path: str) -> None:
    """One JSON line for each snapshot: its status as a header, then its profiles as a nested array."""
    keys = ["country_code", "snapshot_date"]
    rest = [c for c in profiles.columns if c not in keys]
    nested = profiles.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*rest))).alias("profiles"))
    write_json(statuses.select(*keys, F.col("status").alias("snapshot_status")).join(nested, keys), path, ["country_code"])


def append_rates(rates: DataFrame, path: str) -> None:
    rates.write.mode("append").json(path)


def snapshot_key(snapshots: DataFrame) -> str:
    """One key for a set of (country_code, snapshot_date), whatever their order; a row for each snapshot comes to the driver."""
    one = F.concat_ws("=", "country_code", F.col("snapshot_date").cast("string"))
    return snapshots.agg(F.sha2(F.array_join(F.sort_array(F.collect_set(one)), ","), 256)).first()[0]


def files_key(spark: SparkSession, paths: list[str]) -> str:
    """One key for the files at ``paths``, by name, length and time of change, whatever their order: no file is read and no list gathered."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    one = F.xxhash64("path", "length", "modificationTime")
    return "-".join(str(x) for x in files.agg(F.count("*"), F.bit_xor(one), F.sum(one.cast("decimal(20,0)"))).first())


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` and committed."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def materialised(spark: SparkSession, folder: str, snapshots: DataFrame, build) -> DataFrame:
    """The table built from exactly these snapshots: read if it was built before, else built and written."""
    path = f"{folder}/{snapshot_key(snapshots)}"
    if not complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def not_done(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def available(df: DataFrame, name: str) -> DataFrame:
    """The distinct values of a column in order (the molecules that have candidates, say)."""
    return df.select(name).distinct().orderBy(name)


def windows(spark: SparkSession, path: str, name: str = "window") -> list[str]:
    """The values of a partitioned table's first partition column, in order, from the names of its folders: no file is read."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}=*")) or []
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return sorted(names.unescapePathName(f.getPath().getName().split("=", 1)[1]) for f in found)


def in_window(df: DataFrame, window: Column) -> DataFrame:
    return df.withColumn("window", window)
