"""Mixing sources to target weights: iterative proportional fitting of token weights, then sampling by calibrated probabilities.

DataFrame functions only.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

DIMENSIONS = ("source", "lang", "topic")
#: A target is an exponent (shares in proportion to tokens^exponent) or the shares by value.
TARGETS = {"source": 0.5, "lang": 0.7, "topic": 0.5}
#: Raking goes on in blocks of rounds until every marginal is within GAP of its target, as a share of all tokens.
ROUNDS = 6
GAP = 1e-4
CALIBRATIONS = 12  # of the SQL form
#: Raking under caps: blocks of rounds at most, and the gap of a marginal, as a share of all tokens, that ends them.
CAPPED_BLOCKS = 8
CAPPED_GAP = 1e-6
#: Cells up to this many are broadcast to the documents; beyond, the join is shuffled and skewed keys are split.
BROADCAST_CELLS = 200_000


def topic_of(text: Column) -> Column:
    """A coarse topic for tables that have none: legal, contact, settings or general. Null texts are general."""
    return (
        F.when(text.contains("icense"), "legal").when(text.contains("@"), "contact").when(text.contains(" = "), "settings").otherwise("general")
    )


def token_count(text: Column) -> Column:
    """Words between spaces, as a long; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) that only the key and the seed decide: 48 bits of an md5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def _weight(name: str, target: float | Mapping[str, float], held: Column) -> Column:
    """The target weight of a dimension's value that holds `held` tokens."""
    if isinstance(target, Mapping):
        share = F.lit(0.0)
        for value, s in target.items():
            share = F.when(F.col(name).eqNullSafe(F.lit(value)), F.lit(float(s))).otherwise(share)
        return share
    return F.when(held > 0, F.pow(held.cast("double"), F.lit(float(target)))).otherwise(0.0)


def rake(cells: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TARGETS, rounds: int = ROUNDS, gap: float = GAP) -> DataFrame:
    """Add `factor`: raked tokens over tokens, from fits of each dimension in turn.

    After every `rounds` of fits the marginals are compared with their targets. It ends once the greatest difference is within `gap`
    of all tokens, or hardly shrinks any more, as where targets contradict each other; then a warning names the difference.

    cells: one row per combination of the targets' columns, with `tokens` (long). Null is a value of its own. Shares are
    scaled to the values that occur; a value without a stated share gets none. A cell without tokens, and every
    cell where all shares are 0, has factor 0; a cell whose dimension sums to 0 keeps its weight.
    """
    out = cells.withColumn("r", F.col("tokens").cast("double"))
    totals = {}
    for name, target in targets.items():
        # the share of each value, on every cell
        share = _weight(name, target, F.sum("tokens").over(Window.partitionBy(name)))
        totals[name] = share
    for name, share in totals.items():
        out = out.withColumn(f"__{name}", share).withColumn(f"__first_{name}", F.row_number().over(Window.partitionBy(name).orderBy(*[c for c in targets])) == 1)
    sums = out.agg(F.sum("tokens").cast("double").alias("__all"), *[F.sum(F.when(F.col(f"__first_{n}"), F.col(f"__{n}")).otherwise(0.0)).alias(f"__sum_{n}") for n in targets])
    whole = sums.first()  # one row of sums
    fitted = [n for n in targets if whole[f"__sum_{n}"]]
    aims = {n: F.lit(whole["__all"]) * F.col(f"__{n}") / F.lit(whole[f"__sum_{n}"]) for n in fitted}
    before = None
    while fitted and rounds:
        for _ in range(rounds):
            for name in fitted:
                now = F.sum("r").over(Window.partitionBy(name))
                out = out.withColumn("r", F.when(now > 0, F.col("r") * aims[name] / now).otherwise(F.col("r")))
        out = materialise(out, "raked")
        off = [out.groupBy(n).agg(F.abs(F.sum("r") - F.first(aims[n])).alias("gap")).agg(F.max("gap")).first()[0] for n in fitted]
        now_off = max(off) / whole["__all"]
        if now_off <= gap:
            break
        if before is not None and now_off > 0.98 * before:
            warnings.warn(f"raking stops {now_off:.2g} of all tokens away from its targets", stacklevel=2)
            break
        before = now_off
    return out.select(*cells.columns, F.when(F.col("tokens") > 0, F.col("r") / F.col("tokens")).otherwise(0.0).alias("factor"))


def calibrate(cells: DataFrame, share: float) -> float:
    """The multiplier c for which the expected tokens, sum of tokens·min(1, c·factor), are `share` of all tokens.

    Each round settles the cells that reach probability 1 and solves for the rest; it ends when nothing changes, which it
    does, since settled cells stay so. Only sums, one row a round, reach the driver. 0 where there are no tokens.
    """
    c = None
    while True:
        full = F.lit(False) if c is None else F.col("factor") * c >= 1
        row = cells.agg(
            F.sum("tokens").alias("all"),
            F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("factor"))).alias("rest"),
        ).first()
        if not row["all"] or not row["rest"]:
            return c or 0.0
        now = max(0.0, (share * row["all"] - row["full"]) / row["rest"])
        if c is not None and now <= c:
            return c
        c = now


def rake_capped(cells: DataFrame, share: float, targets: Mapping[str, float | Mapping[str, float]] = TARGETS, rounds: int = ROUNDS, blocks: int = CAPPED_BLOCKS) -> DataFrame:
    """Add `probability`: raking of the expected kept tokens, where no cell gives more than it holds.

    A value's aim is its target share of the kept tokens, or all its tokens where they are fewer; what is missing then goes to the
    other values in proportion to their targets. Each step multiplies the cells of a value by the number for which their
    tokens·min(1, factor) sum to the aim, so the caps count while raking. Blocks of `rounds` end when every aim is met
    within CAPPED_GAP of all tokens, or after `blocks` where the aims contradict each other; marginals() shows what is left.
    """
    cells = materialise(cells, "cells")
    names, columns = list(targets), cells.columns
    held = {n: F.sum("tokens").over(Window.partitionBy(n)) for n in names}
    out = cells.select("*", *[_weight(n, targets[n], held[n]).alias(f"__{n}") for n in names])
    allowed = F.col("tokens") > 0
    for n in names:
        allowed = allowed & (F.col(f"__{n}") > 0)
    out = out.withColumn("t", F.when(allowed, F.col("tokens")).otherwise(0).cast("double"))
    few = cells.count() <= BROADCAST_CELLS
    out = materialise(out.withColumn("f", F.when(allowed, F.lit(float(share))).otherwise(0.0)), "capped")
    sums = out.agg(F.sum("tokens").alias("all"), F.sum("t").alias("t")).first()
    if not sums["t"]:
        return cells.withColumn("probability", F.lit(0.0))
    part, aims = min(1.0, share * sums["all"] / sums["t"]), {}
    for n in names:
        values = out.groupBy(n).agg(F.sum("t").alias("tokens"), F.first(f"__{n}").alias("w")).where("tokens > 0").withColumn("factor", F.col("w") / F.col("tokens"))
        aims[n] = calibrate(values, part)
    out = out.select("*", *[F.least(F.sum("t").over(Window.partitionBy(n)), F.col(f"__{n}") * F.lit(float(aims[n]))).alias(f"__aim_{n}") for n in names])
    order = [F.col(n) for n in names]
    for _ in range(blocks):
        if few:
            out = out.coalesce(1)  # the windows need no shuffle
        for _ in range(rounds):
            for n in names:
                # with the cells of greatest factor capped, the others need (aim - capped) / rest: the greatest of these is right
                down = Window.partitionBy(n).orderBy(F.col("f").desc(), *order)
                full = F.coalesce(F.sum("t").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
                rest = F.sum(F.col("t") * F.col("f")).over(down.rowsBetween(0, Window.unboundedFollowing))
                out = out.withColumn("__need", F.when(rest > 0, (F.col(f"__aim_{n}") - full) / rest))
                most = F.coalesce(F.max("__need").over(Window.partitionBy(n)), F.lit(1.0))
                out = out.withColumn("f", F.col("f") * F.greatest(most, F.lit(0.0))).drop("__need")
        out = materialise(out, "capped")
        kept = F.sum(F.col("t") * F.least(F.lit(1.0), F.col("f")))
        gaps = [out.groupBy(n).agg(F.abs(kept - F.first(f"__aim_{n}")).alias("gap")).agg(F.max("gap")).first()[0] for n in names]
        if max(gaps) <= CAPPED_GAP * sums["all"]:
            break
    return out.select(*columns, F.when(F.col("t") > 0, F.least(F.lit(1.0), F.col("f"))).otherwise(0.0).alias("probability"))


def marginals(mixed: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TARGETS) -> DataFrame:
    """dimension, value, tokens, target, expected and kept shares, and reachable: whether the value holds as many tokens as its
    target share of the expected kept tokens. mixed: the rows of mix(), read once a dimension."""
    parts = []
    for n, target in targets.items():
        chance = F.coalesce("probability", F.lit(0.0))
        by = mixed.groupBy(n).agg(F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * chance).alias("e"), F.sum(F.when(F.col("kept"), F.col("tokens")).otherwise(0)).alias("k"))
        by = materialise(by.withColumn("w", _weight(n, target, F.col("tokens"))), "marginals")
        s = by.agg(F.sum("w"), F.sum("e"), F.sum("k")).first()
        aim, e, k = [F.col(c) / F.lit(float(x)) if x else F.lit(0.0) for c, x in zip(("w", "e", "k"), s)]
        parts.append(by.select(F.lit(n).alias("dimension"), F.col(n).cast("string").alias("value"), "tokens", aim.alias("target"), e.alias("expected"), k.alias("kept"), (F.col("tokens") >= aim * F.lit(float(s[1] or 0))).alias("reachable")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, share: float = 0.5, targets: Mapping[str, float | Mapping[str, float]] = TARGETS, key: str = "doc_id", text: str = "text", seed: str = "mix", rounds: int = ROUNDS, capped: bool = False, topic: Callable[[Column], Column] = topic_of) -> DataFrame:
    """Every row of docs with its topic (made from the text by `topic` unless docs has one), tokens, probability and kept.

    Tokens are summed per cell of the targets' dimensions before they are shuffled, and the cells are raked. A document is kept
    where the uniform number of its key is below its cell's probability, so runs agree and repeated rows share a fate.
    Null source, language or topic is a value of its own; null and empty texts have 0 tokens and take their cell's
    probability (0 in a cell without tokens). Other columns stay; input columns named as a new one give way.
    capped: rake under the caps (rake_capped), so that the kept tokens meet all targets that `share` leaves reachable, as in
    oracle_capped(); without it the caps come after the raking, as in oracle().
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    rest = [c for c in docs.columns if c not in ("tokens", "probability", "kept")]
    rows = docs.select(*rest, token_count(F.col(text)).alias("tokens"))
    if "topic" in targets and "topic" not in rest:
        rows = rows.withColumn("topic", topic(F.col(text)))
    dims = list(targets)
    cells = rows.groupBy(*dims).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n_docs"))
    if capped:
        cells = rake_capped(cells, share, targets, rounds)
        chance = F.col("probability")
    else:
        cells = rake(materialise(cells, "cells"), targets, rounds)
        chance = F.least(F.lit(1.0), F.col("factor") * F.lit(float(calibrate(cells, share))))
    chances = cells.select(*[F.col(d).alias(f"__{d}") for d in dims], chance.alias("probability"))
    few = cells.count() <= BROADCAST_CELLS
    same = [F.col(d).eqNullSafe(F.col(f"__{d}")) for d in dims]
    joined = rows.join(F.broadcast(chances) if few else chances, same, "left").drop(*[f"__{d}" for d in dims])
    return joined.withColumn("kept", F.coalesce(uniform(F.col(key), seed) < F.col("probability"), F.lit(False)))


def _cells_sql(dims: str, docs: str) -> list[str]:
    """The documents with tokens and topic (d) and their cells (g)."""
    return [
        f"d AS (SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens, CASE WHEN contains(text, 'icense') THEN 'legal' WHEN contains(text, '@') THEN 'contact' WHEN contains(text, ' = ') THEN 'settings' ELSE 'general' END AS topic FROM {docs})",
        f"g AS (SELECT {dims}, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY {dims})",
    ]


def _sample_sql(targets: Mapping[str, float], seed: str) -> str:
    """The documents with the probability of their cell (p), and whether their number is below it."""
    same = " AND ".join(f"d.{n} IS NOT DISTINCT FROM p.{n}" for n in targets)
    u = f"('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT / 281474976710656.0"
    return f"SELECT doc_id, d.source, d.lang, d.topic, d.tokens, round(probability, 6) AS probability, coalesce({u} < probability, false) AS kept FROM d LEFT JOIN p ON {same}"


def _calibration_sql(name: str, cells: str, share: str, rounds: int) -> list[str]:
    """calibrate() as tables name0, name1 and so on, each with one row c; later ones no longer change."""
    out = [f"{name}0 AS (SELECT {share} * sum(tokens) / sum(tokens * factor) AS c FROM {cells})"]
    for i in range(rounds - 1):
        c = f"{name}{i}"
        out.append(f"{name}{i + 1} AS (SELECT greatest(any_value({c}.c), coalesce(({share} * sum(tokens) - sum(CASE WHEN factor * {c}.c >= 1 THEN tokens ELSE 0 END)) / nullif(sum(CASE WHEN factor * {c}.c >= 1 THEN 0 ELSE tokens * factor END), 0), 0)) AS c FROM {cells}, {c})")
    return out


def oracle(share: float, targets: Mapping[str, float], rounds: int = ROUNDS, calibrations: int = CALIBRATIONS, docs: str = "documents", seed: str = "mix") -> str:
    """DuckDB SQL of mix() with exponents as targets: doc_id, source, lang, topic, tokens, probability, kept."""
    dims = ", ".join(targets)
    out = _cells_sql(dims, docs)
    for name, power in targets.items():
        out.append(f"t_{name} AS (SELECT {name}, CASE WHEN s > 0 THEN pow(s, {power}) ELSE 0 END AS a FROM (SELECT {name}, sum(tokens) AS s FROM g GROUP BY {name}))")
    joins = " ".join(f"LEFT JOIN t_{n} ON g.{n} IS NOT DISTINCT FROM t_{n}.{n}" for n in targets)
    aims = ", ".join(f"(SELECT sum(tokens) FROM g) * t_{n}.a / (SELECT sum(a) FROM t_{n}) AS aim_{n}" for n in targets)
    out.append(f"r0 AS (SELECT {', '.join('g.' + n for n in targets)}, g.tokens, g.tokens AS r, {aims} FROM g {joins})")
    k = 0
    for _ in range(rounds):
        for name in targets:
            now = f"SELECT *, sum(r) OVER (PARTITION BY {name}) AS now FROM r{k}"
            out.append(f"r{k + 1} AS (SELECT * EXCLUDE (now) REPLACE (CASE WHEN now > 0 THEN r * aim_{name} / now ELSE r END AS r) FROM ({now}))")
            k += 1
    out.append(f"f AS (SELECT {dims}, tokens, CASE WHEN tokens > 0 THEN r / tokens ELSE 0 END AS factor FROM r{k})")
    out += _calibration_sql("c", "f", str(share), calibrations)
    out.append(f"p AS (SELECT {dims}, least(1.0, factor * c) AS probability FROM f, c{calibrations - 1})")
    return "WITH " + ",\n".join(out) + "\n" + _sample_sql(targets, seed)


def oracle_capped(share: float, targets: Mapping[str, float], rounds: int = ROUNDS, blocks: int = CAPPED_BLOCKS, calibrations: int = CALIBRATIONS, docs: str = "documents", seed: str = "mix") -> str:
    """DuckDB SQL of mix(capped=True) with exponents as targets, the same columns.

    The raking is a recursion over all cells: step i fits dimension i modulo their number, and after each block of rounds the
    gaps decide, as in rake_capped, whether it goes on.
    """
    dims, names = ", ".join(targets), list(targets)
    held = ", ".join(f"pow(sum(tokens) OVER (PARTITION BY {n}), {power}) AS w_{n}" for n, power in targets.items())
    allowed = " AND ".join(["tokens > 0", *[f"w_{n} > 0" for n in names]])
    out = _cells_sql(dims, docs)
    out.append(f"w AS (SELECT *, CASE WHEN {allowed} THEN tokens ELSE 0 END AS t FROM (SELECT *, {held} FROM g))")
    out.append(f"part AS (SELECT least(1.0, {share} * sum(tokens) / sum(t)) AS part, sum(tokens) AS every FROM w)")
    for n in names:
        out.append(f"v_{n} AS (SELECT {n}, sum(t) AS tokens, any_value(w_{n}) / sum(t) AS factor FROM w GROUP BY {n} HAVING sum(t) > 0)")
        out += _calibration_sql(f"c_{n}_", f"v_{n}", "(SELECT part FROM part)", calibrations)
    aims = ", ".join(f"least(sum(t) OVER (PARTITION BY {n}), w_{n} * (SELECT c FROM c_{n}_{calibrations - 1})) AS aim_{n}" for n in names)
    out.append(f"b AS (SELECT {dims}, t, {aims}, CASE WHEN t > 0 THEN {share}::DOUBLE ELSE 0 END AS f FROM w)")
    which = lambda c: "CASE i % " + str(len(names)) + " " + " ".join(f"WHEN {j} THEN {c(n)}" for j, n in enumerate(names)) + " END"
    key, aim, own = which(lambda n: n), which(lambda n: f"aim_{n}"), ", ".join(f"aim_{n}" for n in names)
    gaps = ", ".join(f"max(abs(kept_{n} - aim_{n})) OVER ()" for n in names)
    kept = ", ".join(f"sum(t * least(1.0, f)) OVER (PARTITION BY {n}) AS kept_{n}" for n in names)
    block = rounds * len(names)
    out.append(f"""k AS (SELECT 0 AS i, false AS done, {dims}, t, {own}, f FROM b
  UNION ALL SELECT i + 1, (i + 1) % {block} = 0 AND greatest({gaps}) <= {CAPPED_GAP} * (SELECT every FROM part), {dims}, t, {own}, f FROM (SELECT *, {kept} FROM (
  SELECT i, {dims}, t, {own}, f * greatest(coalesce(max(need) OVER (PARTITION BY key), 1.0), 0.0) AS f FROM (SELECT *, CASE WHEN rest > 0 THEN (aim - coalesce(whole, 0)) / rest END AS need FROM (
  SELECT *, sum(t) OVER (PARTITION BY key ORDER BY f DESC, {dims} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS whole, sum(t * f) OVER (PARTITION BY key ORDER BY f DESC, {dims} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM (SELECT *, {key} AS key, {aim} AS aim FROM k WHERE NOT done AND i < {blocks * block}))))))""")
    out.append(f"p AS (SELECT {dims}, CASE WHEN t > 0 THEN least(1.0, f) ELSE 0 END AS probability FROM k WHERE i = (SELECT max(i) FROM k))")
    return "WITH RECURSIVE " + ",\n".join(out) + "\n" + _sample_sql(targets, seed)
