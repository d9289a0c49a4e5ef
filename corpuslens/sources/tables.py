"""Reading and writing corpora, result tables, metrics and text files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from corpuslens.functions.text import strip

def read_table(spark: SparkSession, folder: str, name: str, by: str | None = None, spread: str | None = None) -> DataFrame:
    """A parquet table of the folder.

    ``by`` hash-partitions a corpus by document before its texts are taken apart: whatever is later
    grouped by document finds its rows in place, so the text moves once instead of its many times
    larger terms. ``spread`` only helps a file that loads as fewer partitions than there are cores,
    by hashing that column; on larger inputs it does nothing.
    """
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    key = by or spread
    if key is None:
        return df
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, key)
    return df.repartition(by) if by else df


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, in local runs and tests, a
    temporary folder of this machine is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="corpuslens-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def keep_table(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write the rows to the shared folder once and go on from there.

    Used where a result is read several times: the plan behind it is cut, columns not needed later
    are not read again, and a lost executor costs nothing. With ``by`` the table is bucketed by that
    column, so that later joins and groups on it find their rows in place. The files belong to the
    run and go when the folder is cleared.
    """
    spark = df.sparkSession
    name = f"corpuslens_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark).rstrip('/')}/{name}"
    if by is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    # As many buckets as shuffle partitions; on one machine no more than its cores are of use.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.sparkContext.master.startswith("local"):
        buckets = min(buckets, cores)
    df.repartition(buckets, by).write.bucketBy(buckets, by).option("path", path).saveAsTable(name)
    return spark.table(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, quoted fields over several lines, doubled quotes. The schema is declared."""
    return (
        spark.read.schema(schema)
        .options(header=True, multiLine=True, quote='"', escape='"', lineSep="\n")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, quote='"', escape='"', quoteAll=True).csv(path)


def append_records(records: DataFrame, path: str) -> None:
    """Add rows to a results table."""
    records.write.mode("append").parquet(path)


def back_up(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Copy a results table to ``path + '_prev'`` before a new run; rows copied."""
    try:
        current = spark.read.schema(schema).parquet(path)
    except Exception as error:  # no earlier run
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return 0
    current.write.mode("overwrite").parquet(f"{path}_prev")
    return spark.read.schema(schema).parquet(f"{path}_prev").count()


def start_results(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Back up an earlier results table and leave an empty one; rows backed up."""
    kept = back_up(spark, path, schema)
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return kept


def to_json_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Each row as one JSON document."""
    return df.select(F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"}).alias("value"))


def write_json(df: DataFrame, path: str) -> None:
    to_json_rows(df).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.text(path).select(F.from_json("value", schema).alias("r")).select("r.*")


def decode_text(content: Column) -> Column:
    """File bytes to text: UTF-8 where valid, else Latin-1, which accepts every byte; ends stripped."""
    text = F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8")).otherwise(F.decode(content, "ISO-8859-1"))
    return strip(text)


def write_text_files(files: DataFrame, folder: str) -> int:
    """A file for each row of ``name, content`` below the folder, by the tasks that hold the rows; files written.

    Names are final and no folder is made for a file alone, so nothing is renamed by the driver and listing
    takes a step per folder. A task that is repeated writes the same files again.
    """
    spark = files.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()

    def write(batches):
        import re

        import pyarrow as pa
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(re.sub("^file:/+", "/", where))
        made = set()
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                below = name.rpartition("/")[0]
                if below not in made:
                    system.create_dir(f"{root}/{below}", recursive=True)
                    made.add(below)
                with system.open_output_stream(f"{root}/{name}", compression=None) as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return files.select("name", "content").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, text`` of plain-text files, one row per file; folders are read recursively."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", decode_text(F.col("content")).alias("text"))


def list_documents(files: DataFrame) -> DataFrame:
    """Folder name as class, file stem as id, copy marker ``(1)``, content hash; from ``path, content``."""
    stem = F.regexp_extract("path", r"([^/]+?)(?: ?\(\d+\))?\.[^./]+$", 1)
    return files.select(
        "path",
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"),
        stem.alias("stem"),
        F.col("path").rlike(r" ?\(\d+\)\.[^./]+$").alias("is_copy"),
        F.sha2("content", 256).alias("content_key"),
    )


def reconcile(listing: DataFrame, table: DataFrame, id_col: str = "doc_id", label: str = "lang") -> DataFrame:
    """One row per document of either side: files, distinct contents, presence and class agreement.

    Copies are folded per stem before the join, so a document with many copies is one row.
    """
    files = listing.groupBy("stem").agg(
        F.count("*").alias("n_files"),
        F.count_if("is_copy").alias("n_copies"),
        F.count_distinct("content_key").alias("n_contents"),
        F.min("folder").alias("folder"),
    )
    rows = table.select(F.col(id_col).cast("string").alias("stem"), F.col(label).alias("table_label"))
    return files.join(rows, "stem", "full_outer").select(
        F.col("stem").alias("document"),
        F.coalesce("n_files", F.lit(0)).alias("n_files"),
        F.coalesce("n_copies", F.lit(0)).alias("n_copies"),
        F.coalesce("n_contents", F.lit(0)).alias("n_contents"),
        F.when(F.col("n_files").isNull(), "table only").when(F.col("table_label").isNull(), "files only").otherwise("both").alias("presence"),
        F.coalesce(F.col("folder") == F.col("table_label"), F.lit(False)).alias("same_class"),
    )
