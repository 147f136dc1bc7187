"""Near-duplicates: universal-hash minima in bands, verified on full shingle sets, grouped by connected components."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BoundedCache, Scratch, release_memory, small_batches

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Settings:
    """shingle: words a shingle. percent: the least similarity, 100 |A∩B| >= percent |A∪B|.

    With bands x rows minima, a pair at similarity s shares a bucket with probability 1 - (1 - s^rows)^bands; for
    32 x 4 and s = 0.8 it is missed once in 2·10^7. agree: the least number of equal bytes in the sketches (the low byte
    of every minimum) for a pair to be verified: of 128, 102 are expected at 0.8, with a deviation of 4.5. block: rows that
    a block of a bucket holds when sketches or sets are compared in a task; block_shingles: its shingles.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    agree: int = 76
    block: int = 512
    block_shingles: int = 1_000_000
    broadcast_ids: int = 1_000_000
    seed: int = 11


def word_hashes(text: str | None, cache: BoundedCache) -> np.ndarray:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of a whole text, A-Z in lower case."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; with fewer words the whole sequence is one; none without words."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(k, n)
    out = np.full(n - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        out = (out * _MIX) ^ hashes[i : n - width + 1 + i]
        out ^= out >> np.uint64(29)
        out *= _STEP
    out ^= out >> np.uint64(32)
    return np.unique(out)


def hash_family(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(settings.seed)
    n = settings.bands * settings.rows
    return rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least of (a·x + b mod 2^64) >> 32 over the set, for every (a, b) of the family; blocks keep to the cache."""
    a, b = family
    out = np.full(len(a), np.uint32(0xFFFFFFFF), np.uint32)
    for at in range(0, len(shingles), 2048):
        part = shingles[None, at : at + 2048]
        for lo in range(0, len(a), 16):
            high = (a[lo : lo + 16, None] * part + b[lo : lo + 16, None]).min(1) >> np.uint64(32)
            out[lo : lo + 16] = np.minimum(out[lo : lo + 16], high.astype(np.uint32))
    return out


def band_keys(minima: np.ndarray, settings: Settings) -> np.ndarray:
    """A 64-bit key of each band's minima."""
    parts = minima.reshape(settings.bands, settings.rows).astype(np.uint64)
    out = np.arange(settings.bands, dtype=np.uint64)
    for i in range(settings.rows):
        out = (out * _MIX) ^ parts[:, i]
        out ^= out >> np.uint64(31)
        out *= _STEP
    return (out ^ out >> np.uint64(32)).view(np.int64)


def _cache() -> BoundedCache:
    return BoundedCache(lambda w: xxhash.xxh3_64_intdigest(w))


def signatures(docs: DataFrame, settings: Settings, key: str, text: str) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the whole set), sketch (a byte of each minimum) and bands (a key each) of every row."""
    small_batches(docs.sparkSession)

    def run(batches):
        cache, family = _cache(), hash_family(settings)
        for batch in batches:
            counts, keys, sketches, bands = [], [], [], []
            for t in batch.column(1).to_pylist():
                s = shingle_set(word_hashes(t, cache), settings.shingle)
                counts.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                minima = signature(s, family) if len(s) else None
                sketches.append(None if minima is None else minima.astype(np.uint8).view(np.int8))
                bands.append(None if minima is None else band_keys(minima, settings))
                cache.trim()
            columns = [pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.list_(pa.int8())), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_shingles", "set_key", "sketch", "bands"])
        del cache
        release_memory()

    source = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, n_shingles long, set_key binary, sketch array<tinyint>, bands array<long>")


def shingles_of(docs: DataFrame, ids: DataFrame, settings: Settings, key: str, text: str) -> DataFrame:
    """id, shingles (array of long) of the documents whose id is listed; an id with several texts has a row for each.

    The list is broadcast only while a count finds it within settings.broadcast_ids; beyond that both sides are shuffled.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        cache = _cache()
        for batch in batches:
            sets = []
            for t in batch.column(1).to_pylist():
                sets.append(np.sort(shingle_set(word_hashes(t, cache), settings.shingle).view(np.int64)))  # sorted as signed, for searches
                cache.trim()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])
        del cache
        release_memory()

    source = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    few = ids.count() <= settings.broadcast_ids
    return source.join(F.broadcast(ids) if few else ids, "id").mapInArrow(run, f"id {dict(source.dtypes)['id']}, shingles array<long>")


def verify(pairs: DataFrame, docs: DataFrame, settings: Settings, key: str, text: str) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. pairs is read several times, so it should be a written table."""
    side = lambda c: shingles_of(docs, pairs.select(F.col(c).alias("id")).distinct(), settings, key, text).select(F.col("id").alias(c), F.col("shingles").alias(f"s{c}"))
    both = F.size(F.array_intersect("sa", "sb"))
    alike = pairs.join(side("b"), "b").join(side("a"), "a").where(100 * both >= settings.percent * (F.size("sa") + F.size("sb") - both))
    return alike.select("a", "b")


def _agreeing(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs whose lengths allow the similarity and whose sketches have at least settings.agree bytes in common."""
    side = lambda c: sets.select(F.col("id").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    same = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    near = 100 * F.least("na", "nb") >= settings.percent * F.greatest("na", "nb")
    return pairs.join(side("b"), "b").join(side("a"), "a").where(near).where(same >= settings.agree).select("a", "b")


def components(links: DataFrame, limit: int | None = None) -> DataFrame:
    """node, root (the least node reachable) for every node of the links (a, b): alternating large-star and small-star.

    Each round is two aggregations and two joins of the links, with no list of neighbours, and ends in a table in the
    shared folder; the table before it is removed. It stops when neither star changes a link, which takes a number of rounds that
    grows with the square of the logarithm of the nodes at most; `limit`, if given, raises an error beyond so many rounds.
    """
    work = Scratch(links.sparkSession, "stars")
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = work.write(edges, "0")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    before = None
    for n in itertools.count(1):
        # large-star: every larger neighbour goes to the least node around
        around = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small-star: every smaller neighbour, and the node itself, go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        edges = work.write(small.where("u <> v").distinct(), str(n))
        work.drop(str(n - 1))
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")).first())
        if now == before and now[0] == now[2]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        if n == limit:
            raise RuntimeError(f"no stable components after {limit} rounds")
        before = now


def _deal(rows: DataFrame, light: DataFrame, by: str, load: Column, settings: Settings) -> DataFrame:
    """The rows, each as often as it takes part in a comparison, with x and y: the pair of blocks compared there, and its own block.

    rows: `by` (a group), id, root and what else the comparison reads; light: the same rows with the columns that load reads. Only rows of different roots are compared. A group whose load
    is 1 at most is one block. In a larger one the most frequent root is the main one: its rows are cut into blocks that
    meet only blocks of the others, which meet each other as well. So no group meets in one task however large it is,
    and a group that is nearly one component is hardly copied.
    """
    counts = light.withColumn("__load", load).groupBy(by, "root").agg(F.count("*").alias("n"), F.sum("__load").alias("load"))
    main = F.max(F.struct("n", "root", "load"))
    sizes = counts.groupBy(by).agg(main.alias("m"), F.sum("load").alias("load"), F.count("*").alias("roots")).where("roots > 1")
    rest = F.greatest(F.ceil(F.col("load") - F.col("m.load")), F.lit(1)).cast("int")
    one = F.col("load") <= 1
    sizes = sizes.select(by, F.col("m.root").alias("main"), F.when(one, 1).otherwise(rest).alias("others"), F.when(one, 0).otherwise(F.ceil("m.load")).cast("int").alias("mains"))
    few = sizes.count() <= settings.broadcast_ids
    cut = rows.join(F.broadcast(sizes) if few else sizes, by)
    pick = F.xxhash64("id", F.lit(by))
    is_main = (F.col("root") == F.col("main")) & (F.col("mains") > 0)
    own = F.when(is_main, F.col("others") + F.pmod(pick, F.greatest("mains", F.lit(1)))).otherwise(F.pmod(pick, F.col("others"))).cast("int")
    last = F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    dealt = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return dealt.select(*rows.columns, "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))


class _Block:
    """The rows that a task compares: their roots as codes in ascending order, joined as candidates or links are found."""

    def __init__(self, table: pa.Table, settings: Settings):
        self.settings = settings
        self.ids, self.own = table["id"].to_numpy(), table["own"].to_numpy()
        self.roots, self.code, self.counts = np.unique(table["root"].to_numpy(), return_inverse=True, return_counts=True)
        self.size = table["n_shingles"].to_numpy()
        self.sketch = table["sketch"].combine_chunks().flatten().to_numpy().reshape(len(self.ids), -1)
        self.across = table["x"][0].as_py() != table["y"][0].as_py()
        self.up = list(range(len(self.roots)))

    def top(self, row: int) -> int:
        c = self.code[row]
        while self.up[c] != c:
            self.up[c] = c = self.up[self.up[c]]
        return c

    def join(self, one: int, two: int) -> bool:
        a, b = self.top(one), self.top(two)
        self.up[max(a, b)] = min(a, b)
        return a != b

    def candidates(self):
        """For each row outside the most frequent root: the rows of other roots whose length and sketch allow a link, each pair once."""
        main, size = self.counts.argmax(), self.size
        for i in np.flatnonzero(self.code != main) if len(self.roots) > 1 else ():
            j = (self.code != self.code[i]) & ((self.code == main) | (self.ids > self.ids[i]))
            j &= 100 * np.minimum(size, size[i]) >= self.settings.percent * np.maximum(size, size[i])
            if self.across:
                j &= self.own != self.own[i]
            j = np.flatnonzero(j)
            if len(j):
                j = j[np.count_nonzero(self.sketch[j] == self.sketch[i], axis=1) >= self.settings.agree]
            if len(j):
                yield i, j


def _screen(rows: DataFrame, settings: Settings) -> DataFrame:
    """id, root, tag of the rows that have a candidate of another root in a bucket; tags chain the roots of candidates.

    rows: bucket, id, root, n_shingles, sketch. Pairs stay in the task: a row leaves once, with the least root of its class.
    """
    kind = dict(rows.dtypes)["id"]

    def compare(table: pa.Table) -> pa.Table:
        block, form = _Block(table, settings), table.schema.field("id").type
        marked = np.zeros(len(block.ids), bool)
        for i, j in block.candidates():
            marked[i] = marked[j] = True
            for k in j[np.unique(block.code[j], return_index=True)[1]]:
                block.join(i, k)
        out = np.flatnonzero(marked)
        tags = block.roots[np.array([block.top(k) for k in out], np.int64)]
        return pa.table({"id": pa.array(block.ids[out], form), "root": pa.array(block.roots[block.code[out]], form), "tag": pa.array(tags, form)})

    dealt = _deal(rows, rows, "bucket", F.lit(1 / settings.block), settings)
    return dealt.groupBy("bucket", "x", "y").applyInArrow(compare, f"id {kind}, root {kind}, tag {kind}").distinct()


def _links_between(rows: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between rows of different roots in a cluster, enough to join all that are linked.

    rows: cluster, id, root, n_shingles, sketch; sets: id, shingles. Full sets are compared in the task, and only links that join
    roots leave it.
    """
    kind = dict(rows.dtypes)["id"]

    def compare(table: pa.Table) -> pa.Table:
        block, form = _Block(table, settings), table.schema.field("id").type
        lists = table["shingles"].combine_chunks()
        begin, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        found = []
        for i, j in block.candidates():
            one = values[begin[i] : begin[i + 1]]
            for at in range(0, len(j), 256):
                part = [k for k in j[at : at + 256] if block.top(k) != block.top(i)]
                if not part:
                    continue
                others = np.concatenate([values[begin[k] : begin[k + 1]] for k in part])
                hit = one[np.minimum(np.searchsorted(one, others), len(one) - 1)] == others
                lengths = block.size[part]
                both = np.add.reduceat(hit, np.cumsum(lengths) - lengths, dtype=np.int64)
                for k in np.flatnonzero(100 * both >= settings.percent * (lengths + len(one) - both)):
                    if block.join(i, part[k]):
                        found.append((min(block.ids[i], block.ids[part[k]]), max(block.ids[i], block.ids[part[k]])))
        return pa.table({"a": pa.array([f[0] for f in found], form), "b": pa.array([f[1] for f in found], form)})

    load = F.lit(1 / settings.block) + F.col("n_shingles") / settings.block_shingles
    full = rows.join(sets, "id").where(F.size("shingles") == F.col("n_shingles"))
    return _deal(full, rows, "cluster", load, settings).groupBy("cluster", "x", "y").applyInArrow(compare, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) for every row of docs.

    Links join documents whose shingle sets are similar enough; component_id is the least doc_id reachable.
    1. Rows with equal sets collapse to the least id. 2. In every bucket of every band each member pairs with the
    bucket's least id; pairs whose sketches agree are verified on full sets and joined by components. 3. In buckets that
    still hold more than one component, sketches of different components are compared within tasks; the components that
    have candidates for each other form clusters, and the full sets of a cluster's candidates are compared within tasks,
    once a cluster and not once a bucket. So a link that does not pass through a bucket's least member is found as
    well. No bucket is capped, no bucket's pairs are emitted; a bucket of one component, such as a large group of near
    copies, is not compared at all.
    Null and empty texts, or texts without words, have 0 shingles and link with nothing: their component is their own
    id. Rows that repeat an id are one document: whatever any of its texts is linked with is its component. Rows with a null id
    keep a null component and are not kept. Other columns are ignored. An empty table gives an empty result.
    """
    work = Scratch(docs.sparkSession, "near")
    signed = work.write(signatures(docs, settings, key, text), "signed")
    firsts = [F.first(c).alias(c) for c in ("n_shingles", "sketch", "bands")]
    sets = work.write(signed.where("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("id"), *firsts), "sets")
    # rows without a set get a key that no set has, so that they don't meet in one task
    alone = F.concat(F.lit(b"\0"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.monotonically_increasing_id().cast("string"))).cast("binary"))
    rows = signed.select("doc_id", "n_shingles", F.coalesce("set_key", alone).alias("set_key")).join(sets.select("set_key", "id"), "set_key", "left")
    rows = work.write(rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id")).alias("node")), "rows")
    work.drop("signed")
    members = sets.select("id", F.explode("bands").alias("bucket"))  # cheap to make twice, large to store
    several = members.groupBy("bucket").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    shared = work.write(members.join(several.select("bucket", "least"), "bucket").hint("rebalance"), "shared")
    pairs = shared.where("id > least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    pairs = work.write(_agreeing(pairs, sets, settings), "pairs")
    repeated = rows.where("node IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("doc_id")
    same = rows.join(repeated, "doc_id", "left_semi").where("node < doc_id").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    found = components(verify(pairs, docs, settings, key, text).unionByName(same))
    work.drop("pairs")
    rooted = shared.join(found.withColumnRenamed("node", "id"), "id", "left").select("bucket", "id", F.coalesce("root", "id").alias("root"))
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).where("lo < hi AND n > 2").select("bucket")
    small = sets.select("id", "n_shingles", "sketch")
    again = work.write(rooted.join(mixed, "bucket").join(small, "id").hint("rebalance"), "mixed")
    work.drop("shared")
    marked = work.write(_screen(again, settings), "marked")
    work.drop("mixed")
    if not marked.isEmpty():
        tops = components(marked.select(F.col("root").alias("a"), F.col("tag").alias("b")).distinct())
        apart = marked.select("id", "root").distinct().join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
        apart = work.write(apart.select("id", "root", F.coalesce("top", "root").alias("cluster")).join(small, "id"), "apart")
        full = shingles_of(docs, apart.select("id").distinct(), settings, key, text)
        more = _links_between(apart, full, settings)
        found = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
        work.drop("apart")
    out = rows.join(found, "node", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("root", "node").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def drop_near_duplicates(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, one of each class of near-duplicates: the one with the least id.

    Rows that repeat an id are one document: all its texts go if the document's class has a lesser id, and else the least of its rows stays (by text, then the other columns). Rows with a null id all stay, since
    nothing names them. Texts without words are kept. The columns are those of docs. The list of ids that go is broadcast only while
    a count finds it within settings.broadcast_ids; beyond that both sides are shuffled.
    """
    by_id = near_duplicates(docs, settings, key, text).where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).agg(F.max("kept").alias("__kept"), F.count("*").alias("__n"))
    special = Scratch(docs.sparkSession, "near").write(by_id.where("NOT __kept OR __n > 1"), "special")
    few = special.count() <= settings.broadcast_ids
    out = docs.join(F.broadcast(special.select(key)) if few else special.select(key), key, "left_anti").select(docs.columns)
    repeated = special.where("__kept").select(key)
    if not repeated.isEmpty():
        order = [text, *[c for c in docs.columns if c not in (key, text)]]
        least = docs.join(repeated, key, "left_semi").groupBy(key).agg(F.min(F.struct(*order)).alias("__row"))
        out = out.unionByName(least.select(key, "__row.*").select(docs.columns))
    return out
