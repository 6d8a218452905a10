"""Session helpers: configuration defaults and shipping the package to executors."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def build_session(app: str = "docframe", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution on; a cluster's own settings win over these defaults."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Serve this package to the executors' Python once per application, wherever the driver started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, str(path.relative_to(root.parent)))
    target = os.path.join(tempfile.mkdtemp(prefix="docframe-"), "docframe.zip")
    Path(target).write_bytes(buffer.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset on a local master (tests), a temporary one, set for the session."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "")
    if conf:
        return conf.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="docframe-shared-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


#: Most rows of a table of rules or fields, which every task is sent.
MAX_CONFIG = 1000


def small(config: DataFrame, most: int = MAX_CONFIG) -> DataFrame:
    """The table of rules or fields, to be sent to every task; an error where it has more rows than that allows."""
    if config.limit(most + 1).count() > most:
        raise ValueError(f"a table of rules or fields may have {most} rows")
    return F.broadcast(config)


def shuffled(df: DataFrame) -> DataFrame:
    """df, to be joined by shuffling both sides. Documents and what is read from them are many times as large as Spark guesses from
    the columns or packed files they come from; by that guess whole tables would be sent through the driver to every task."""
    return df.hint("merge")


#: Rows of a partition that is dealt by rows.
DEAL = 200_000


def dealt(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """df by key in partitions of about DEAL rows, whatever the session's number of partitions and however few bytes the rows take: a
    partition whose rows are then paired or sorted grows with its rows, and adaptive execution would put partitions together by bytes."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, rows // DEAL + 1), *key)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and losing an executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docframe/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
