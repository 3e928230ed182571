"""Document-set configurations: nested JSON files, one ``documents`` array each."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelweave.functions.scale import numbered
from modelweave.schemas import DOCUMENT_SET, struct

DOCUMENTS_PER_FILE = 10_000
# Documents of a set that one task numbers; more are numbered by ranges.
PLACES = 10_000


def document_schema():
    return struct(DOCUMENT_SET)["documents"].dataType.elementType


def _uri(spark: SparkSession, path: str) -> str:
    """The path as the reader names it, with one slash behind its scheme."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given)
    return re.sub(r"^(\w+):/+", r"\1:/", whole.toUri().toString())


def _all_sets(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All files in one read; a file's set is found by its own path or that of its folder.

    A path given twice is a set each time.
    """
    manifest = spark.createDataFrame(
        [(_uri(spark, path), number) for number, path in enumerate(paths)], "_path string, set int"
    )
    files = (
        spark.read.schema(struct(DOCUMENT_SET)).option("multiLine", True).option("mode", "FAILFAST")
        .option("recursiveFileLookup", True).json(list(dict.fromkeys(paths)))
        .select("documents", F.col("_metadata.file_path").alias("file"))
    )
    own = F.regexp_replace("file", r"^(\w+):/+", "$1:/")
    folder = F.regexp_replace(own, r"(/block=\d+)?/[^/]*$", "")  # a set of several files has a folder for each
    block = F.coalesce(F.regexp_extract("file", r"/block=(\d+)/[^/]*$", 1).try_cast("int"), F.lit(0))
    placed = files.withColumn("block", block).withColumn("_path", F.explode(F.array(own, folder)))
    rows = placed.join(F.broadcast(manifest), "_path")  # one row per path given
    rows = rows.select("set", "block", "file", F.posexplode("documents").alias("place", "d"))
    return rows.select("set", "block", "file", "place", "d.*")


def read_document_sets(spark: SparkSession, paths: list[str], selection: DataFrame | None = None) -> DataFrame:
    """Documents of all files with their set (the path's place in ``paths``), block, file and place in the file.

    One malformed file fails the read; no path at all gives no documents. ``selection`` is appended as the
    last set, in the order of its package URIs.
    """
    if paths:
        documents = _all_sets(spark, paths)
    else:
        documents = spark.createDataFrame([], document_schema()).select(
            F.lit(0).alias("set"), F.lit(0).alias("block"), F.lit(None).cast("string").alias("file"),
            F.lit(0).alias("place"), "*",
        )
    if selection is None:
        return documents
    order = [F.col("characteristics.packageURI").asc_nulls_first(), F.col("toolSpecificPackageID").asc_nulls_first()]
    extra = numbered(selection.withColumn("set", F.lit(len(paths))), ["set"], order, out="place", hot_rows=PLACES)
    return documents.unionByName(extra.withColumn("block", F.lit(0)).withColumn("file", F.lit(None).cast("string")))


def read_document_set(spark: SparkSession, path: str | None) -> DataFrame:
    return read_document_sets(spark, [] if path is None else [path])


def write_document_set(rows: DataFrame, folder: str, documents_per_file: int = DOCUMENTS_PER_FILE) -> None:
    """Write configuration rows as nested JSON files of ``documents_per_file`` documents.

    An ordinary document set is a single file; a larger one is continued in further files, one folder
    ``block=n`` each, which ``read_document_sets`` reads together.
    """
    fields = document_schema().fieldNames()
    order = F.col("characteristics.packageURI")
    placed = numbered(rows.withColumn("_set", F.lit(0)), ["_set"], [order, "toolSpecificPackageID"], out="_place",
                      hot_rows=PLACES)
    block = F.floor(F.col("_place") / documents_per_file)
    entry = F.struct("_place", F.struct(*fields).alias("d"))
    sets = placed.groupBy(block.alias("_block")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    documents = sets.select(F.col("_block").alias("block"), F.transform("entries", lambda e: e["d"]).alias("documents"))
    documents.write.mode("overwrite").partitionBy("block").json(folder)
