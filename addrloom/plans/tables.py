"""Reading the input tables, sharing intermediate tables, and size checks before a broadcast."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which a table may be broadcast; every operator that uses the hint has a shuffle join beyond either.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole table `name` of the folder `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, least: int | None = None) -> DataFrame:
    """`df` in at least as many partitions as the cluster has cores, so that a single large file doesn't run as one task.

    Only a scan with too few splits is shuffled; other inputs pass through."""
    want = least or df.sparkSession.sparkContext.defaultParallelism
    have = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if have >= want else df.repartition(want)


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: `spark.checkpoint.dir` of the session. Where it is unset, a local session (tests) gets one of its
    own; on a cluster that is an error, as a machine's own folder would lose rows."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        known = sc._jsc.sc().getCheckpointDir()
        if known.isDefined():
            root = known.get()
        elif sc.master.startswith("local"):
            import tempfile

            root = "file://" + tempfile.mkdtemp(prefix="addrloom-")
            sc.setCheckpointDir(root)
        else:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    return root.rstrip("/")


def shared(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet to the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/addrloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """`df` with a broadcast hint if it has at most `rows` rows of at most `size` bytes in all, else unchanged (the join then shuffles).

    Counting stops one row beyond the bound, so the check itself stays small. Texts count by length, lists and structs as JSON."""
    width = F.lit(0)
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        width = width + (F.coalesce(F.octet_length(c), F.lit(0)) if kind in ("string", "binary") else F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)) if kind in ("array", "struct", "map") else F.lit(8))
    got = df.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).collect()[0]
    return F.broadcast(df) if got.n <= rows and got.b <= size else df


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; the folder is the parameter ADDRLOOM_TOKENIZERS, /opt/tokenizers by default."""
    return os.path.join(os.environ.get("ADDRLOOM_TOKENIZERS", "/opt/tokenizers"), name)
