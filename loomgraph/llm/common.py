"""What the operators share: the shared folder, arrow helpers, grouped streaming over sorted partitions."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker takes at a time; a longer text is taken alone and whole.
PIECE_BYTES = 1 << 20


def attach(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it lies, also if the driver only put it on sys.path."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application in the one that the cluster names in spark.checkpoint.dir; where it names none (tests), under the warehouse. What is left there goes when the driver ends."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    base = named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.shared"
    if not named:
        if not spark.sparkContext.master.startswith("local") and base.startswith(("file:", "/")):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all machines share")
        if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(base)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/loomgraph-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: lineage ends there and later scans read only their columns."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete what stored() wrote, once nothing reads it any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return attach(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts in each hold PIECE_BYTES at most, or one row."""
    for batch in batches:
        col = batch.column(text)
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
        at, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > PIECE_BYTES:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += n
        yield batch.slice(at)


def groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of rows with equal key from batches that are sorted by it. The caller bounds the size of a group."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = pc.run_end_encode(batch.column(key))
        start = 0
        for value, end in zip(codes.values.to_pylist(), codes.run_ends.to_pylist(), strict=True):
            if held and value != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last, start = value, end
    if held:
        yield pa.Table.from_batches(held)


def map_groups(df: DataFrame, key: str, f: Callable[[pa.Table], pa.RecordBatch | None], schema: str, order: tuple[str, ...] = ()) -> DataFrame:
    """f on the rows of each key, in one sorted pass for each partition: no cost for each group beyond f."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, key):
            if (out := f(group)) is not None:
                yield out

    return df.repartition(F.col(key)).sortWithinPartitions(key, *order).mapInArrow(run, schema)
