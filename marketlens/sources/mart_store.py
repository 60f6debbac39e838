"""Stored marts: versioned folders, one manifest a version, bucketed facts.

::

    <root>/builds/<id>/<mart>/...      the tables of one build
    <root>/manifests/00000007.json     which build version 7 is, and its tables

A build writes into a folder of its own and is published last, by renaming its
manifest to the next free number.  Until then readers see the version before,
and a build that fails leaves it as it was.  The newest ``KEPT`` versions stay,
so that a reader which has opened one can finish; older ones go.

A manifest holds for each table its rows, schema, partition column, bucket
column and number of buckets.  With these any session registers a bucketed
table again from its location (``CREATE TABLE ... CLUSTERED BY ... LOCATION``),
so two facts that are bucketed alike meet without an exchange.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.session import shuffles_go

KEPT = 2
CODEC = "zstd"  # about half of what the default takes for keys in hexadecimal
BUCKETS_CONF = "marketlens.store.buckets"


class NoPublishedMarts(FileNotFoundError):
    pass


def bucket_count(spark: SparkSession) -> int:
    """Buckets of a stored fact: ``marketlens.store.buckets``, by default a
    quarter of the shuffle partitions, as a bucket has a file for each
    partition value and a task reads all of them."""
    return int(spark.conf.get(BUCKETS_CONF, None) or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4))


class MartStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(conf)
        # renaming here fails if the target exists, so no version is published twice
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    # -- manifests ---------------------------------------------------------------
    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        folder = self._path(f"{self.root}/manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, by default the newest."""
        published = self.versions()
        if not published or version not in (None, *published):
            raise NoPublishedMarts(f"no published marts{'' if version is None else f' of version {version}'} under {self.root}")
        stream = self._fs.open(self._path(self._manifest_path(published[-1] if version is None else version)))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:08d}.json"

    def publish(self, build: "Build") -> int:
        """Make a finished build the newest version; returns its number."""
        own = f"{self.root}/manifests/.{uuid.uuid4().hex}.tmp"
        version = max(self.versions(), default=0) + 1
        while True:
            content = {"version": version, "build": build.folder, "marts": build.marts}
            stream = self._fs.create(self._path(own), True)
            try:
                stream.write(bytearray(json.dumps(content, indent=1).encode()))
            finally:
                stream.close()
            try:
                none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
                self._context.rename(self._path(own), self._path(self._manifest_path(version)), none)
                break
            except Exception as e:  # another build was published as this number
                if "FileAlreadyExists" not in str(e):
                    raise
                version += 1
        self._forget(self.versions()[:-KEPT])
        return version

    def _forget(self, versions: list[int]) -> None:
        for v in versions:
            old = self.manifest(v)
            folder = old["build"]
            for mart, entry in old["marts"].items():
                if entry["bucket_by"]:
                    self.spark.sql(f"DROP TABLE IF EXISTS {_table_name(f'{self.root}/{folder}/{mart}')}")
            self._fs.delete(self._path(self._manifest_path(v)), False)  # first, so that no reader finds half a version
            self._fs.delete(self._path(f"{self.root}/{folder}"), True)

    # -- tables ------------------------------------------------------------------
    def path(self, mart: str, version: int | None = None) -> str:
        return f"{self.root}/{self.manifest(version)['build']}/{mart}"

    def read(self, mart: str, manifest: dict | None = None) -> DataFrame:
        """A stored table, with its partition column."""
        manifest = manifest or self.manifest()
        return _read(self.spark, f"{self.root}/{manifest['build']}/{mart}", manifest["marts"][mart])


class Build:
    """One refresh: ``with Build(store) as b``, then ``b.write(...)`` for each
    table.  Leaving the block publishes; an exception deletes the build's folder."""

    def __init__(self, store: MartStore):
        self.store, self.folder = store, f"builds/{uuid.uuid4().hex}"
        self.marts: dict[str, dict] = {}
        self.version: int | None = None

    def __enter__(self) -> "Build":
        return self

    def __exit__(self, kind, value, trace) -> None:
        if kind is None:
            self.version = self.store.publish(self)
        else:
            self.store._fs.delete(self.store._path(f"{self.store.root}/{self.folder}"), True)

    def write(
        self, name: str, df: DataFrame, partition_by: str | None = None, bucket_by: str | None = None, dealt: int | None = None
    ) -> DataFrame:
        """Write a table of this build and return it as stored.  A bucketed one
        is dealt out by the bucket column first, so a task writes one bucket:
        one file, sorted by it, for each partition value.  ``dealt``: ``df`` has
        been dealt out so, into as many partitions, by its builder."""
        path = f"{self.store.root}/{self.folder}/{name}"
        obs = Observation(f"store_{name}")
        observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        buckets = (dealt or bucket_count(self.store.spark)) if bucket_by else None
        if bucket_by:
            rows = observed if dealt else observed.repartition(buckets, bucket_by)
            writer = rows.write.bucketBy(buckets, bucket_by).sortBy(bucket_by)
        else:
            writer = observed.write
        writer = writer.option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        with shuffles_go(self.store.spark):
            if bucket_by:
                writer.format("parquet").option("path", path).saveAsTable(_table_name(path))
            else:
                writer.parquet(path)
        columns = [f for f in df.schema.fields if f.name != partition_by] + [f for f in df.schema.fields if f.name == partition_by]
        self.marts[name] = {
            "rows": int(obs.get["rows"]),
            "schema": T.StructType(columns).jsonValue(),
            "partition_by": partition_by,
            "bucket_by": bucket_by,
            "buckets": buckets,
        }
        return _read(self.store.spark, path, self.marts[name])


def _table_name(path: str) -> str:
    return f"marketlens_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def _read(spark: SparkSession, path: str, entry: dict) -> DataFrame:
    schema = T.StructType.fromJson(entry["schema"])
    if not entry["bucket_by"]:
        return spark.read.schema(schema).parquet(path)
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        partitioned = f"PARTITIONED BY (`{entry['partition_by']}`)" if entry["partition_by"] else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitioned} "
            f"CLUSTERED BY (`{entry['bucket_by']}`) SORTED BY (`{entry['bucket_by']}`) INTO {entry['buckets']} BUCKETS "
            f"LOCATION '{path}'"
        )
        if entry["partition_by"]:
            spark.catalog.recoverPartitions(name)
    return spark.table(name)
