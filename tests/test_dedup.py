import random

from loamline.operators import dedup as de


def test_split():
    assert de.best_split(0.8, 128) == (9, 13)


def greedy(buckets):
    """The sequential rule: key → falls if an earlier kept key shares a bucket."""
    kept, out = set(), []
    for key in sorted(buckets):
        if buckets[key] & kept:
            out.append(key)
        else:
            kept |= buckets[key]
    return out


def test_greedy_is_the_sequential_rule(spark):
    random.seed(3)
    for n, m in ((30, 10), (60, 80)):
        buckets = {i: {(b, random.randrange(m)) for b in range(3)} for i in range(n)}
        rows = [(b, str(v), i) for i, s in buckets.items() for b, v in s]
        for finish in (0, 20, 200_000):
            got = de.greedy_near_dedup(spark.createDataFrame(rows, "band int, bucket string, doc_id long"), finish_rows=finish).collect()
            assert sorted(r[0] for r in got) == greedy(buckets)


def test_long_chain(spark):
    """Every key shares a bucket with the next: each second one falls, however long the chain is."""
    rows = [(0, f"b{i}", k) for i in range(3000) for k in (i, i + 1)]
    got = de.greedy_near_dedup(spark.createDataFrame(rows, "band int, bucket string, doc_id long")).collect()
    assert sorted(r[0] for r in got) == list(range(1, 3001, 2))


def test_middle_of_a_chain_falls_alone(spark):
    rows = [(0, "x", 1), (0, "x", 2), (1, "y", 2), (1, "y", 3)]
    assert [r[0] for r in de.greedy_near_dedup(spark.createDataFrame(rows, "band int, bucket string, doc_id long")).collect()] == [2]


def test_exact_edges(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (1, "a"), (5, "A")], "doc_id long, text string")
    out = de.exact_dedup(df).collect()
    assert len(out) == 6 and sum(not r.is_duplicate for r in out) == 3
    assert de.exact_dedup(df.limit(0)).count() == 0
    assert de.near_dedup(df).count() == 5 and de.near_dedup(df.limit(0)).count() == 0


def test_near_dedup_drops_later_copies(spark):
    base = " ".join(f"w{i}" for i in range(200))
    df = spark.createDataFrame([(1, base), (2, base + " more"), (3, "other text of its own"), (4, "")], "doc_id long, text string")
    assert {r.doc_id: r.is_near_duplicate for r in de.near_dedup(df).collect()} == {1: False, 2: True, 3: False, 4: False}


def test_verify_keeps_texts_below_the_threshold(spark):
    random.seed(8)
    texts = {}
    for i in range(60):
        base = [f"w{i % 6}x{j}" for j in range(60)]
        texts[i] = " ".join(base[random.randrange(14) :] + [f"own{i}y{j}" for j in range(random.randrange(10))])
    texts |= {60: texts[0], 61: " ".join(reversed(texts[0].split())), 62: "", 63: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    # one row a band: all texts that share a minimum meet
    got = {r.doc_id for r in de.near_dedup(df, de.LshConfig(threshold=0.8, bands=128, rows=1, verify=True)).collect() if r.is_near_duplicate}
    sets, kept, falls = {i: set(t.split()) for i, t in texts.items()}, [], set()
    for i in sorted(texts):
        if any(sets[i] and len(sets[i] & sets[k]) >= 0.8 * len(sets[i] | sets[k]) for k in kept):
            falls.add(i)
        else:
            kept.append(i)
    assert got == falls and {60, 61} <= falls and not {62, 63} & falls
    soft = {r.doc_id for r in de.near_dedup(df, de.LshConfig(threshold=0.8, bands=128, rows=1)).collect() if r.is_near_duplicate}
    assert soft > got


def test_minima_in_blocks(spark):
    """Sets that a block cuts, empty ones and words of several sets; a worker holds no more for more texts."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    random.seed(5)
    sets = [[], ["a"], [f"w{i}" for i in range(3 * de.BLOCK_WORDS)], [], ["a", "é", "w1"], *[[f"w{i}" for i in random.sample(range(5000), 300)] for _ in range(2000)], []]
    a, b = de._coefficients(128)
    got = de._minima(pa.array(sets, pa.list_(pa.string())), a, b)
    flat = sorted(set().union(*sets))
    number = dict(zip(flat, map(int, de._numbers(pa.array(flat))), strict=True))
    for s, row in zip(sets[:40] + sets[-1:], [*got[:40], got[-1]], strict=True):
        want = np.array([[(int(x) * number[w] + int(y)) % de.PRIME for x, y in zip(a[::16], b[::16], strict=True)] for w in s] or [[de.PRIME] * 8]).min(0)
        assert (row[::16] == want).all()
    assert (de._minima(pa.array(sets[:9], pa.list_(pa.string())).slice(1, 5), a, b) == got[1:6]).all()

    def peak(n):
        part = pa.array(sets[5 : 5 + n], pa.list_(pa.string()))
        tracemalloc.start()
        de._minima(part, a, b)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    assert peak(1600) < 1.3 * peak(400)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    de.minhash(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000


def test_verified_links_hold_all_pairs_in_small_batches(spark):
    """Links to the first of a bucket against brute force, over batches smaller than the table."""
    random.seed(9)
    base = [[f"w{g}x{j}" for j in range(80)] for g in range(5)]
    texts = {i: " ".join(random.sample(b := base[i % 5], len(b)) + [f"own{i}"] * (i % 3)) for i in range(200)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, "7")
    try:
        members = de.lsh_members(de.minhash(df), *de.LshConfig().split())
        assert spark.conf.get(key) == "7"  # a tighter bound stays
        got = {(r.first, r.doc_id): r.jaccard for r in de.verified_links(df, de.lsh_first_links(de.materialise(members, "members")), 0.8).collect()}
    finally:
        spark.conf.set(key, before)
    sets = {i: set(t.split()) for i, t in texts.items()}
    assert all(j == len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for (a, b), j in got.items())
    assert {(i % 5, i) for i in range(5, 200) if sets[i] == sets[i % 5]} <= set(got)


WORKER_PEAKS = """
import os, sys
import __spark_entry__ as entry
from pyspark.sql import SparkSession, functions as F

spark = (
    SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.driver.memory", "1g")
    .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "1").config("spark.sql.files.maxPartitionBytes", "1g").config("spark.sql.files.openCostInBytes", "1g").getOrCreate()
)

def peak(batches):
    import pyarrow as pa

    for _ in batches:
        pass
    kb = next(int(line.split()[1]) for line in open("/proc/self/status") if line.startswith("VmHWM"))
    yield pa.RecordBatch.from_pydict({"kb": [kb], "pid": [os.getpid()]})

for n in (500, 8000):
    folder = f"{sys.argv[1]}/{n}"
    # 400 words each, of 20,000 different ones; every tenth text is a copy of the one before
    k = F.when(F.col("id") % 10 == 9, F.col("id") - 1).otherwise(F.col("id"))
    word = lambda i: F.concat(F.lit("word"), F.pmod(F.hash(k, i), F.lit(20000)).cast("string"))
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(400)), word), " ")
    spark.range(0, n, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text")).write.parquet(f"{folder}/documents.parquet")
    links = entry.queries()["jaccard_links"](spark, folder).collect()
    kb, pid = spark.range(1).mapInArrow(peak, "kb long, pid long").collect()[0]
    print("PEAK", n, kb, pid, sum(r.doc_id - r.first == 1 and r.jaccard == 1 for r in links), len(links), flush=True)
"""


def test_worker_of_jaccard_links_holds_no_more_for_more_texts(tmp_path):
    """The peak of a session's only Python worker after few texts and after many, which one task reads."""
    import os
    import subprocess
    import sys

    said = subprocess.run([sys.executable, "-c", WORKER_PEAKS, str(tmp_path)], cwd=os.environ["PYTHONPATH"].split(os.pathsep)[0], capture_output=True, text=True, timeout=300)
    rows = [list(map(int, line.split()[1:])) for line in said.stdout.splitlines() if line.startswith("PEAK")]
    assert len(rows) == 2, said.stderr[-2000:]
    assert all(copies == links == n // 10 for n, _, _, copies, links in rows)
    assert len({pid for _, _, pid, *_ in rows}) == 1
    assert rows[1][1] - rows[0][1] < 80 << 10
