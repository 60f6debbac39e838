"""Helpers shared by the operators: shared-folder tables and code shipping."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import checkpoint_root, track_scratch


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application (``addPyFile``),
    so that their Python workers import the same code as the driver."""
    sc = spark.sparkContext
    if getattr(sc, "_marketlens_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="marketlens-ship-"), "marketlens_pkg.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("marketlens", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._marketlens_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder; ``clear_scratch``
    of ``marketlens.session`` deletes such folders when they are done with."""
    return track_scratch(spark, f"{checkpoint_root(spark)}/llm-{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the
    lineage ends there, and a lost executor costs no recomputation of it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def split_words(texts):
    """Words ``[^\\x20\\x09-\\x0D]+`` of an Arrow array of texts, one after
    another, and the bounds of each text's words among them."""
    import numpy as np
    import pyarrow.compute as pc

    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    edges = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return flat.filter(real), edges[split.offsets.to_numpy() - split.offsets[0].as_py()]


def document_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` with null as empty; other columns go.

    Rows whose doc_id is null keep a null id: the operators order and join by
    id, so such rows are left out there (``where doc_id is not null``)."""
    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
