"""URL rules, and a blocked Bloom filter before an exact join with a list.

``judged`` applies host and path rules (the longest that fits wins).  A page
that no rule fits is blocked if its canonical URL is in ``listed``:

* every listed URL sets ``BITS`` bits inside one 512-bit block of a filter of
  fixed size (``n_blocks``, 64 bytes each: the bound of what is broadcast);
* pages whose bits are all set may be listed and go on to an exact join with
  the list, which removes the filter's false positives; all others are done.

A list too long for the filter makes more false positives, never a wrong row.
Canonical URL: lower-cased host without ``www.`` and default port, then the
path without a trailing slash; scheme, query and fragment do not count.

Null URLs and URLs without ``://`` have an empty host and path, fit no rule and
are allowed.  Null entries of the list are ignored, repeated entries count
once.  Extra columns of the pages are ignored; repeated pages stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package

BITS, BLOCKS = 8, 1 << 17
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``action`` (allow or block) for a host with its subdomains and a path prefix."""

    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def canonical(host: Column, path: Column) -> Column:
    """Null where there is no host."""
    plain = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    return F.when(host != "", F.concat(plain, F.regexp_replace(path, r"/$", "")))


def best_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits (a blocking one first
    where two are of one length), null where none does."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.action == "block")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, action = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.action)).otherwise(action)
    return text, action


def _places(h: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each 64-bit hash, and its BITS bit positions in [0, 512)."""
    h = h.view(np.uint64)
    block = ((h >> np.uint64(32)) * np.uint64(n_blocks) >> np.uint64(32)).astype(np.int64)
    x = (h * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    steps = [(x >> np.uint64(9 * i % 55)) * np.uint64(0xD1342543DE82EF95) >> np.uint64(55) for i in range(BITS)]
    return block, np.stack(steps, 1).astype(np.int64)


def build_filter(listed: DataFrame, n_blocks: int = BLOCKS) -> np.ndarray:
    """The filter's bits as n_blocks x 8 words.  ``listed`` has column canonical.
    Each task sets bits in its own copy; the words are or-ed in a group-by with
    at most 8 * n_blocks rows, whatever the length of the list."""

    def partial(batches):
        words = np.zeros(n_blocks * 8, np.uint64)
        for batch in batches:
            block, bits = _places(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), n_blocks)
            np.bitwise_or.at(words, (block[:, None] * 8 + bits // 64).ravel(), np.uint64(1) << (bits % 64).ravel().astype(np.uint64))
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at].view(np.int64))], ["at", "word"])

    rows = (
        listed.where(F.col("canonical").isNotNull())
        .select(F.xxhash64("canonical").alias("h"))
        .mapInArrow(partial, "at long, word long")
        .groupBy("at")
        .agg(F.expr("bit_or(word)").alias("word"))
        .toArrow()
    )
    words = np.zeros(n_blocks * 8, np.uint64)
    words[rows.column("at").to_numpy()] = rows.column("word").to_numpy().view(np.uint64)
    return words


def may_contain(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    block, bits = _places(h, len(words) // 8)
    got = words[block[:, None] * 8 + bits // 64] >> (bits % 64).astype(np.uint64) & np.uint64(1)
    return got.all(axis=1)


def judged(pages: DataFrame, rules: list[Rule], listed: DataFrame, n_blocks: int = BLOCKS) -> DataFrame:
    """page_id, host, path, rule, verdict, listed (null where a rule decided)."""
    spark = pages.sparkSession
    ship_package(spark)
    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    text, action = best_rule(F.col("host"), F.col("path"), rules)
    parts = parts.select("page_id", "host", "path", text.alias("rule"), action.alias("action"), canonical(F.col("host"), F.col("path")).alias("canonical"))
    words = spark.sparkContext.broadcast(build_filter(listed, n_blocks))  # 64 bytes * n_blocks

    def test(batches):
        for batch in batches:
            h = batch.column(batch.schema.get_field_index("h")).to_numpy(zero_copy_only=False).astype(np.int64)
            hit = may_contain(words.value, h)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hit)], [*batch.schema.names[:-1], "maybe"])

    hashed = parts.withColumn("h", F.xxhash64("canonical"))
    schema = "page_id long, host string, path string, rule string, action string, canonical string, maybe boolean"
    tested = hashed.mapInArrow(test, schema)
    maybe = F.col("maybe") & F.col("action").isNull() & F.col("canonical").isNotNull()
    exact = listed.where(F.col("canonical").isNotNull()).select("canonical").distinct().withColumn("is_listed", F.lit(True))
    # only possible hits are shuffled; the test of the others is done where they are read
    asked = tested.where(maybe).join(exact, "canonical", "left")
    joined = tested.where(~maybe).withColumn("is_listed", F.lit(False)).unionByName(asked.select(*tested.columns, "is_listed"))
    found = F.coalesce(F.col("is_listed"), F.lit(False))
    return joined.select(
        "page_id", "host", "path", "rule",
        F.coalesce(F.col("action"), F.when(found, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("action").isNull(), found).alias("listed"),
    )
