"""Exact and near deduplication with a defined order: the survivor of a group is its first row by the order columns."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.session import materialise, small_batches

PRIME = (1 << 31) - 1


@dataclass(frozen=True)
class LshConfig:
    """Minima and bands. For a threshold of 0.8 over 128 minima, the split with the least sum of false-positive and
    false-negative area is 9 bands of 13 rows; the threshold is soft unless `verify` is set. Then a text falls only to an earlier
    kept one of its buckets whose word set has a Jaccard similarity of at least the threshold."""

    threshold: float = 0.8
    permutations: int = 128
    bands: int | None = None
    rows: int | None = None
    verify: bool = False

    def split(self) -> tuple[int, int]:
        return (self.bands, self.rows) if self.bands and self.rows else best_split(self.threshold, self.permutations)


def best_split(threshold: float, permutations: int) -> tuple[int, int]:
    """(bands, rows) that minimise the false-positive area below the threshold plus the false-negative area above it."""
    x = (np.arange(2000) + 0.5) / 2000
    low = x < threshold
    best = (float("inf"), 1, 1)
    for bands in range(1, permutations + 1):
        for rows in range(1, permutations // bands + 1):
            hit = 1 - (1 - x**rows) ** bands
            best = min(best, (float(hit[low].sum() + (1 - hit[~low]).sum()) / 2000, bands, rows))
    return best[1], best[2]


def exact_dedup(df: DataFrame, order: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Add text_sha256 and is_duplicate: true on all but the first row, by `order`, of equal texts.

    Null texts are a group of their own. A first row is
    found by a partial aggregation over hash and order columns, and only hashes that occur twice are joined back, so a text that fills a third of the table does not meet in one task. Rows that are equal in
    text and order columns are told apart by their place in the scan; if df may have such rows, it should be a scan or a
    written table, whose places do not change between its two uses here.
    """
    tagged = df.withColumn("text_sha256", F.sha2(F.col(text), 256)).withColumn("__at", F.monotonically_increasing_id())
    place = F.struct(*order, "__at")
    groups = tagged.groupBy("text_sha256").agg(F.min(place).alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    joined = tagged.join(groups.withColumnRenamed("text_sha256", "__sha"), F.col("text_sha256").eqNullSafe(F.col("__sha")), "left")
    return joined.withColumn("is_duplicate", F.coalesce(place != F.col("__first"), F.lit(False))).drop("__at", "__first", "__sha")


def duplicate_groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """text_sha256, group_size and first_id of the texts that occur more than once."""
    return df.groupBy(F.sha2(F.col(text), 256).alias("text_sha256")).agg(F.count("*").alias("group_size"), F.min(key).alias("first_id")).where("group_size > 1")


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    number = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:8], 16) & 0x7FFFFFFF
    return np.array([1 + number(f"a:{i}") % (PRIME - 1) for i in range(n)], np.uint64), np.array([number(f"b:{i}") % PRIME for i in range(n)], np.uint64)


def _residues(x: np.ndarray) -> np.ndarray:
    """x mod 2^31 - 1, in place, for x below 2^62: the prime is one less than a power of two, so bits are folded instead of divided."""
    p, shift = np.uint64(PRIME), np.uint64(31)
    for _ in range(2):
        high = x >> shift
        x &= p
        x += high
    x[x >= p] -= p
    return x


#: Words whose hashes are taken together: bounds a worker's memory (512 bytes a word at 128 minima) whatever the texts.
BLOCK_WORDS = 1 << 14


def _numbers(words: pa.Array) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.md5(w.encode("utf-8", "replace")).digest()[:4], "big") & 0x7FFFFFFF for w in words.to_pylist()], np.uint64)


def _minima(sets: pa.ListArray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A row of minima for each set of words; PRIME throughout for an empty one. The sets' words go through in blocks, which may
    cut a set; a word that a block holds several times is hashed once."""
    words, ends = sets.flatten(), np.cumsum(sets.value_lengths().to_numpy(zero_copy_only=False))
    low = np.full((len(sets), len(a)), PRIME, np.uint32)
    for at in range(0, len(words), BLOCK_WORDS):
        block = words.slice(at, BLOCK_WORDS).dictionary_encode()
        table, places = np.empty((len(block.dictionary), len(a)), np.uint32), block.indices.to_numpy()
        h = _numbers(block.dictionary)
        for i in range(0, len(h), 256):  # blocks that stay in the cache
            table[i : i + 256] = _residues(h[i : i + 256, None] * a + b)
        first, last = np.searchsorted(ends, [at, at + len(block) - 1], "right")
        for row in range(first, last + 1):
            lo = max(at, ends[row - 1] if row else 0) - at
            if lo < ends[row] - at:
                np.minimum(low[row], table[places[lo : ends[row] - at]].min(0), out=low[row])
    return low


def minhash(df: DataFrame, permutations: int = 128, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and signature (array<long>): minima of (a·h + b) mod (2^31 - 1) over the set of lower-cased words.

    h: the first 31 bits of a word's md5. A text without words has an empty signature. Words reach Python in bounded batches and
    stay Arrow arrays, but for the different ones of a block.
    """
    small_batches(df.sparkSession)

    def run(batches):
        a, b = _coefficients(permutations)
        for batch in batches:
            sets = batch.column(1)
            low = _minima(sets, a, b)
            some = sets.value_lengths().to_numpy(zero_copy_only=False) > 0
            ends = np.concatenate([[0], np.cumsum(some * permutations)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, low[some].astype(np.int64).ravel())], names=["key", "signature"])

    from loamline.functions.text import words

    source = df.select(F.col(key).alias("key"), F.array_distinct(words(F.lower(F.coalesce(F.col(text), F.lit(""))))).alias("words"))
    return source.mapInArrow(run, f"key {dict(source.dtypes)['key']}, signature array<long>").withColumnRenamed("key", key)


def lsh_members(signatures: DataFrame, bands: int, rows: int, key: str = "doc_id") -> DataFrame:
    """band, bucket and key: a row for each band of each signature."""
    pieces = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.md5(F.concat_ws(",", F.transform(F.slice("signature", i * rows + 1, rows), lambda x: x.cast("string")))))
    return signatures.where(F.size("signature") > 0).select(key, F.posexplode(pieces).alias("band", "bucket"))


def lsh_first_links(members: DataFrame, key: str = "doc_id") -> DataFrame:
    """Distinct (first, key): each member of a shared bucket with the bucket's first member. Pairs within a bucket are not expanded.

    members is used twice, so it should be a written table."""
    firsts = members.groupBy("band", "bucket").agg(F.min(key).alias("first"), F.count("*").alias("n")).where("n > 1")
    return members.join(firsts, ["band", "bucket"]).where(F.col(key) != F.col("first")).select("first", key).distinct()


def jaccard(a, b):
    """|A∩B| / |A∪B| of two array columns of distinct values; 0 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def verified_links(df: DataFrame, links: DataFrame, threshold: float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The links whose word sets have a similarity of at least the threshold, with it."""
    from loamline.functions.text import words

    sets = df.select(key, F.array_distinct(words(F.lower(F.coalesce(F.col(text), F.lit(""))))).alias("__w"))
    first = sets.select(F.col(key).alias("first"), F.col("__w").alias("__f"))
    return links.join(sets, key).join(first, "first").withColumn("jaccard", jaccard(F.col("__f"), F.col("__w"))).where(F.col("jaccard") >= threshold).select("first", key, "jaccard")


def _walk(rest: DataFrame, key: str) -> DataFrame:
    """The keys that fall, by the sequential rule over all rows in one task; for a rest of bounded size."""

    def walk(table: pa.Table) -> pa.Table:
        buckets: dict = {}
        for band, bucket, k in zip(table["band"].to_pylist(), table["bucket"].to_pylist(), table["key"].to_pylist(), strict=True):
            place = tuple((v is not None, v) for v in (k.values() if isinstance(k, dict) else (k,)))  # nulls first, as in Spark
            buckets.setdefault(place, (k, []))[1].append((band, bucket))
        taken: set = set()
        fallen = []
        for at in sorted(buckets):
            k, own = buckets[at]
            if taken.isdisjoint(own):
                taken.update(own)
            else:
                fallen.append(k)
        return pa.table({"key": pa.array(fallen, table.schema.field("key").type)})

    kind = rest.schema[key].dataType.simpleString()
    return rest.select("band", "bucket", F.col(key).alias("key"), F.lit(0).alias("all")).groupBy("all").applyInArrow(walk, f"key {kind}").withColumnRenamed("key", key)


def greedy_near_dedup(members: DataFrame, key: str = "doc_id", finish_rows: int = 200_000) -> DataFrame:
    """Keys that the greedy rule removes: in key order, a key falls if it shares a bucket with an earlier kept one.

    Each round keeps the keys that are first in all of their buckets and removes all others of these buckets, which is what the
    sequential rule does; removed keys then no longer stand before others. No pairs are made. The rest of each round is a
    table in the shared folder. Every round settles the least undecided key at least, so the rounds end; once finish_rows rows
    or fewer are left, as of long chains, one task settles them in key order.
    """
    rest = materialise(shared_members(members).distinct(), "greedy")
    fallen: DataFrame | None = None
    while (left := rest.count()) > 0:
        if left <= finish_rows:
            lost = _walk(rest, key)
        else:
            firsts = rest.groupBy("band", "bucket").agg(F.min(key).alias("first"))
            placed = rest.join(firsts, ["band", "bucket"])
            kept = placed.groupBy(key).agg(F.min((F.col(key) == F.col("first")).cast("int")).alias("all")).where("all = 1").select(key)
            won = rest.join(kept, key, "left_semi").select("band", "bucket").distinct()
            lost = materialise(rest.join(won, ["band", "bucket"], "left_semi").select(key).distinct().join(kept, key, "left_anti"), "greedy-lost")
            rest = materialise(rest.join(kept, key, "left_anti").join(lost, key, "left_anti"), "greedy")
        fallen = lost if fallen is None else fallen.unionByName(lost)
        if left <= finish_rows:
            break
    return fallen if fallen is not None else members.select(key).limit(0)


def verified_members(df: DataFrame, members: DataFrame, threshold: float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Buckets of two for the greedy rule: one for each pair of a bucket's keys that reaches the threshold on whole word sets.

    Keys with the same word set fall to the first of them, whatever becomes of it, so pairs are made of first keys only. Their
    number can grow with the square of a bucket's different word sets; it is not capped, since a cap would lose links.
    """
    from loamline.functions.text import words

    low = F.array_sort(F.array_distinct(words(F.lower(F.coalesce(F.col(text), F.lit(""))))))
    sets = df.where(F.size(low) > 0).select(key, F.sha2(F.concat_ws(" ", low), 256).alias("__set"))
    copies = materialise(sets.join(sets.groupBy("__set").agg(F.min(key).alias("first")), "__set").select("first", key).distinct(), "same-sets")
    alone = members.join(copies.where(F.col(key) == F.col("first")).select(key), key, "left_semi")
    pairs = alone.select("band", "bucket", F.col(key).alias("first")).join(alone, ["band", "bucket"]).where(F.col("first") < F.col(key)).select("first", key).distinct()
    links = verified_links(df, pairs, threshold, key, text).select("first", key).unionByName(copies.where(F.col(key) != F.col("first"))).distinct()
    bucket = F.sha2(F.to_json(F.struct(F.col("first").alias("a"), F.col(key).alias("b"))), 256)
    return links.select(F.lit(0).alias("band"), bucket.alias("bucket"), F.explode(F.array("first", key)).alias(key))


def shared_members(members: DataFrame) -> DataFrame:
    """The members of buckets that have two or more; the others decide nothing. members is used twice, so it should be a written table."""
    return members.join(members.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1").drop("n"), ["band", "bucket"])


def near_dedup(df: DataFrame, config: LshConfig = LshConfig(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and is_near_duplicate for every distinct key of df under the greedy rule on LSH buckets, or on their verified links."""
    bands, rows = config.split()
    members = materialise(lsh_members(minhash(df, config.permutations, key, text), bands, rows, key), "members")
    if config.verify:
        members = materialise(verified_members(df, shared_members(members).distinct(), config.threshold, key, text), "verified")
    fallen = greedy_near_dedup(members, key).withColumn("__out", F.lit(True))
    return df.select(key).distinct().join(fallen, key, "left").select(key, F.coalesce("__out", F.lit(False)).alias("is_near_duplicate"))
