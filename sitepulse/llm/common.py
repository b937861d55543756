"""Helpers shared by the corpus operators: stored tables, batches of texts, components of links."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitepulse.session import scratch_folder

#: A word is a run of anything but the six ASCII white-space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Texts can be long, so few of them go to a Python worker at a time.
ROWS_PER_BATCH = 256


def lower_ascii(text: str) -> str:
    """Lower-case A-Z and nothing else."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def stored(table: DataFrame, name: str) -> DataFrame:
    """Write a table below the folder that the cluster shares and read it back.

    The lineage ends there, so a lost executor costs no repeat, and both sides of a later join are
    plain shuffles, which Spark can split where a key is hot.
    """
    spark = table.sparkSession
    path = scratch_folder(spark, name)
    schema = table.schema
    table.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def stored_by(table: DataFrame, name: str, key: str) -> DataFrame:
    """As ``stored``, in as many buckets of ``key`` as a shuffle has partitions, so that a join by it doesn't move the rows.

    The files are below the shared folder; the session's catalogue knows them under a name of their own.
    """
    spark = table.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entry = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    writer = table.write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", scratch_folder(spark, name)).format("parquet").saveAsTable(entry)
    return spark.table(entry)


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that no later stage reads, so that they don't fill the shared disk.

    Those deleted before are passed over.
    """
    for table in tables:
        jvm = table.sparkSession._jvm
        configuration = table.sparkSession._jsc.hadoopConfiguration()
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(configuration).delete(path, True)


def map_batches(table: DataFrame, work: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Apply ``work`` to Arrow batches, given and returned as a list per column.

    Batches are cut by ``ROWS_PER_BATCH`` inside the task, so their size doesn't hang on settings.
    """
    table.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    kinds = table.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kinds)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(at, ROWS_PER_BATCH)
                columns = {name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)}
                made = work(columns)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[field.name], field.type) for field in arrow], schema=arrow
                )

    return table.mapInArrow(run, schema)


def add_columns(
    table: DataFrame, needs: list[str], work: Callable[[dict[str, list]], dict[str, list]], schema: str
) -> DataFrame:
    """``table`` with the columns that ``work`` makes from batches of ``needs``; the other columns pass untouched."""
    table.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    kinds = table.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kinds)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(at, ROWS_PER_BATCH)
                made = work({name: part.column(part.schema.get_field_index(name)).to_pylist() for name in needs})
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(made[field.name], field.type) for field in arrow]],
                    names=[*part.schema.names, *arrow.names],
                )

    return table.mapInArrow(run, StructType([*table.schema.fields, *kinds.fields]))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of the links (a, b); component is its smallest reachable node.

    Contraction: every node moves to its smallest neighbour, links between moved nodes remain, until
    none is left. At least half of the linked nodes go in each round. The minimum of a node's links is
    an aggregate, so a node with very many links costs no more than others. Links from a node to
    itself are allowed; no links give no rows.
    """
    found = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    both = found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    left = stored(both, f"{name}-links")
    labels = left.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    while not left.isEmpty():
        moves = stored(
            left.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("to")), f"{name}-moves"
        )
        labels = stored(
            labels.join(moves, labels.component == moves.a, "left").select(
                "node", F.coalesce("to", "component").alias("component")
            ),
            f"{name}-labels",
        )
        start = moves.select("a", F.col("to").alias("start"))
        end = moves.select(F.col("a").alias("b"), F.col("to").alias("end"))
        left = stored(
            left.join(start, "a")
            .join(end, "b")
            .where("start != end")
            .select(F.col("start").alias("a"), F.col("end").alias("b"))
            .distinct(),
            f"{name}-links",
        )
    return labels
