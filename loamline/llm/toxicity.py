"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration."""

from __future__ import annotations

import string
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BoundedCache, map_texts

#: Bounds of the training: labelled rows, and learned lexicon entries.
MAX_LABELLED = 20_000
MAX_LEXICON = 600

# A small seed lexicon and the second-person words of four languages.
SEED_LEXICON = frozenset("asshole bastard bitch clown crap cretin damn disgusting dumb fool garbage hate idiot imbecile jerk kill liar loser moron pathetic pig retard scum shut stupid suck sucks trash ugly useless vermin worthless".split())
SECOND_PERSON = frozenset("you your yours yourself youre u du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos usted ustedes tú ti tuyo vosotros".split())
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "$": "s", "@": "a", "!": "i"})
STEMS = (4, 5, 6, 8)

FEATURES = (
    "seed_hits", "seed_density", "learned_hits", "learned_density", "weak_density", "distinct_hits", "closest_hits",
    "you_density", "hits_near_you", "capitals", "shouted_hits", "bangs", "questions", "obfuscated", "masked_hits", "symbols", "log_words",
)

SEED, LEARNED, WEAK, YOU, SHOUT, OBFUSCATED, MASKED = (1 << i for i in range(7))


def plain(token: str) -> str:
    """A token in lower case without the punctuation around it."""
    return token.lower().strip(string.punctuation + "“”„‘’«»¡¿…–—")


def entries_of(token: str) -> list[str]:
    """What a token can match in a learned lexicon: the word and its stems (marked with a trailing hyphen)."""
    word = plain(token)
    return ([word] if len(word) >= 2 else []) + [word[:k] + "-" for k in STEMS if len(word) > k]


@dataclass(frozen=True)
class Lexicon:
    strong: frozenset = frozenset()
    weak: frozenset = frozenset()

    def flags(self, token: str) -> int:
        word = plain(token)
        if not word:
            return 0
        out = YOU * (word in SECOND_PERSON) | SHOUT * (len(word) > 2 and token.isupper())
        entries = entries_of(token)
        out |= SEED * (word in SEED_LEXICON) | LEARNED * any(e in self.strong for e in entries) | WEAK * any(e in self.weak for e in entries)
        if not word.isalpha() and any(c.isalpha() for c in word):
            out |= OBFUSCATED
            bare = "".join(c for c in word.translate(LOOKALIKES) if c.isalpha())
            if not out & (SEED | LEARNED) and (bare in SEED_LEXICON or bare in self.strong):
                out |= MASKED | SEED
        return out


def distinct_up_to(words: Iterable[str], most: int) -> int:
    """How many different words there are, or `most` if there are as many or more; ends at that."""
    raw, seen = set(), set()
    for word in words:
        if word not in raw:
            raw.add(word)
            seen.add(plain(word))
            if len(seen) == most:
                break
    return len(seen)


def features_of(text: str | None, flags: BoundedCache) -> list[float]:
    """The feature vector of a whole text; null counts as empty. Nothing but the text enters."""
    text = text or ""
    tokens = text.split()
    n = len(tokens)
    if not n:
        return [0.0] * len(FEATURES)
    marks = np.fromiter(map(flags.__getitem__, tokens), np.int64, n)
    hits = np.flatnonzero(marks & (SEED | LEARNED))
    you = np.flatnonzero(marks & YOU)
    count = lambda bit: int(np.count_nonzero(marks & bit))
    per = 100.0 / n
    near = together = distinct = shouted = 0
    if len(hits):
        distinct = distinct_up_to((tokens[i] for i in hits), 20)
        together = int((np.searchsorted(hits, hits + 50, "left") - np.arange(len(hits))).max())
        shouted = int(np.count_nonzero(marks[hits] & SHOUT))
        if len(you):
            at = np.searchsorted(you, hits)
            left = np.abs(hits - you[np.maximum(at - 1, 0)])
            right = np.abs(you[np.minimum(at, len(you) - 1)] - hits)
            near = int(np.count_nonzero(np.minimum(left, right) <= 5))
    return [
        min(20.0, count(SEED)), count(SEED) * per,
        min(20.0, count(LEARNED)), count(LEARNED) * per,
        count(WEAK) * per, min(20.0, distinct), min(20.0, together),
        len(you) * per, min(20.0, near),
        count(SHOUT) * per, min(20.0, shouted),
        text.count("!") * per, text.count("?") * per,
        count(OBFUSCATED) * per, float(count(MASKED)), sum(map(text.count, "#*$%&|<>")) * per, float(np.log1p(n)),
    ]


def feature_maker(lexicon: Lexicon):
    def start():
        flags = BoundedCache(lexicon.flags)

        def make(texts):
            out = [features_of(t, flags) for t in texts]
            flags.trim()
            return {"features": out}

        return make

    return start


@dataclass(frozen=True)
class Forest:
    """Trees of fixed depth over binned splits, and the isotonic steps that turn their sum into a probability."""

    trees: list = field(default_factory=list)  # (features, cuts, leaves) a tree, nodes in breadth-first order
    base: float = 0.0
    steps_at: tuple = ()
    steps_value: tuple = ()

    def margin(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float).reshape(-1, len(FEATURES))
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range((len(leaf)).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        m = self.margin(x)
        if not self.steps_at:
            return 1 / (1 + np.exp(-m))
        return np.interp(m, self.steps_at, self.steps_value)


def _grow(bins: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray, depth: int, least: float, ridge: float):
    n_nodes = 2**depth - 1
    feature, cut = np.zeros(n_nodes, np.int64), np.full(n_nodes, np.inf)
    at = np.zeros(len(bins), np.int64)
    for level in range(depth):
        first, width = 2**level - 1, 2**level
        best = np.full(width, 1e-9)
        choice = np.full((width, 2), -1, np.int64)
        local = at - first
        for f, edges in enumerate(cuts):
            k = len(edges) + 1
            if k < 2:
                continue
            g = np.bincount(local * k + bins[:, f], gradient, width * k).reshape(width, k).cumsum(1)
            h = np.bincount(local * k + bins[:, f], weight, width * k).reshape(width, k).cumsum(1)
            gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least) | (ht - hl < least)] = 0
            top = gain.argmax(1)
            better = gain[np.arange(width), top] > best
            best[better] = gain[np.arange(width), top][better]
            choice[better] = np.stack([np.full(width, f), top], 1)[better]
        split = choice[:, 0] >= 0
        feature[first + np.flatnonzero(split)] = choice[split, 0]
        for i in np.flatnonzero(split):
            cut[first + i] = cuts[choice[i, 0]][choice[i, 1]]
        f_of, b_of = np.where(split, choice[:, 0], 0), np.where(split, choice[:, 1], 1 << 30)
        at = 2 * at + 1 + (bins[np.arange(len(bins)), f_of[local]] > b_of[local])
    local = at - n_nodes
    g, h = np.bincount(local, gradient, 2**depth), np.bincount(local, weight, 2**depth)
    return feature, cut, g / (h + ridge), local


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the non-decreasing step values with the least squared error, and their places."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # weight, mean, first x, last x
    for value, target in zip(np.asarray(x, float)[order], np.asarray(y, float)[order]):
        if blocks and blocks[-1][3] == value:
            b = blocks[-1]
            b[1] = (b[1] * b[0] + target) / (b[0] + 1)
            b[0] += 1
        else:
            blocks.append([1.0, target, value, value])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w, m, _, last = blocks.pop()
            b = blocks[-1]
            b[1] = (b[1] * b[0] + m * w) / (b[0] + w)
            b[0] += w
            b[3] = last
    at = np.array([v for b in blocks for v in (b[2], b[3])])
    values = np.array([v for b in blocks for v in (b[1], b[1])])
    return at, values


def fit(x: np.ndarray, labels: np.ndarray, calibrate: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, n_bins: int = 32, ridge: float = 1.0, least: float = 1.0) -> Forest:
    """Boost on the rows where `calibrate` is false, fit the isotonic steps on the others (on all, where a part has one class only).

    Without rows every text scores 0; with one class only, that class.
    """
    x, labels, calibrate = np.asarray(x, float).reshape(-1, len(FEATURES)), np.asarray(labels, float), np.asarray(calibrate, bool)
    if not len(x) or labels.min() == labels.max():
        p = float(labels[0]) if len(x) else 0.0
        return Forest([], 0.0, (0.0,), (p,))
    if len(set(labels[~calibrate])) < 2 or len(set(labels[calibrate])) < 2:
        grow = hold = np.ones(len(x), bool)
    else:
        grow, hold = ~calibrate, calibrate
    tx, ty = x[grow], labels[grow]
    cuts = []
    for f in range(x.shape[1]):
        values = np.unique(np.quantile(tx[:, f], np.linspace(0, 1, n_bins + 1)[1:-1], method="lower"))
        positive = tx[tx[:, f] > 0, f]
        if len(positive):  # rare features: quantiles of what is not zero as well
            values = np.unique(np.concatenate([values, [0.0], np.quantile(positive, [0.1, 0.3, 0.5, 0.7, 0.9], method="lower")]))
        cuts.append(values[values < tx[:, f].max()] if len(tx) else values)
    bins = np.stack([np.searchsorted(c, tx[:, f], "left") for f, c in enumerate(cuts)], 1)
    base = float(np.log(ty.mean() / (1 - ty.mean())))
    margin, trees = np.full(len(tx), base), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        feature, cut, leaf, local = _grow(bins, cuts, ty - p, p * (1 - p), depth, least, ridge)
        trees.append((feature, cut, rate * leaf))
        margin += rate * leaf[local]
    forest = Forest(trees, base)
    at, values = isotonic(forest.margin(x[hold]), labels[hold])
    return Forest(trees, base, tuple(at), tuple(np.clip(values, 0, 1)))


def _in_calibration(key: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("calibration"), key), F.lit(5)) == 0


def learn_lexicon(rows: DataFrame, max_entries: int = MAX_LEXICON, least: int = 4) -> tuple[Lexicon, Lexicon, Lexicon]:
    """Words and stems that mark label 1, from the texts (`__text`, `__label`) of a bounded training sample.

    Each task sums the documents per entry before anything is shuffled. strong: at least `least` toxic documents and 97 of
    100 (smoothed, at equal class sizes) toxic; weak: 85 of 100. At most max_entries of each, the most telling first.
    The second lexicon is what a toxic document of the sample would find without itself, the third the same for a clean
    one: features of the sample's own rows come from these, so trees do not trust entries that only restate a label.
    """

    def count(batches):
        import collections

        import pyarrow as pa

        toxic, clean = collections.Counter(), collections.Counter()
        entries = BoundedCache(entries_of)
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set()
                for token in set((text or "").split()):
                    found.update(entries[token])
                (toxic if label else clean).update(found)
                entries.trim()
        keys = list(toxic.keys() | clean.keys())
        for i in range(0, len(keys), 20_000):
            part = keys[i : i + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([toxic[k] for k in part], pa.int64()), pa.array([clean[k] for k in part], pa.int64())], names=["entry", "toxic", "clean"])

    totals = rows.groupBy().agg(F.coalesce(F.sum("__label"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    n_toxic, n_clean = int(totals["t"]), int(totals["n"] - totals["t"])
    if not n_toxic or not n_clean:
        return Lexicon(), Lexicon(), Lexicon()
    counts = rows.select("__text", "__label").mapInArrow(count, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share_t, share_c = F.col("toxic") / n_toxic, (F.greatest(F.col("clean") - 1, F.lit(0)) + 0.5) / n_clean
    hopeful = counts.where((F.col("toxic") >= least) & (share_t / (share_t + share_c) >= 0.85))
    found = hopeful.orderBy(F.desc(F.col("toxic") * F.log(2 * share_t / (share_t + share_c))), "entry").limit(2 * max_entries).collect()

    def chosen(less_toxic: int, less_clean: int) -> Lexicon:
        strong, weak = [], []
        for r in found:
            t, c = (r["toxic"] - less_toxic) / n_toxic, (max(0, r["clean"] - less_clean) + 0.5) / n_clean
            if r["toxic"] - less_toxic >= least and t / (t + c) >= 0.85:
                (strong if t / (t + c) >= 0.97 else weak).append(r["entry"])
        return Lexicon(frozenset(strong[:max_entries]), frozenset(weak[:max_entries]))

    return chosen(0, 0), chosen(1, 0), chosen(0, 1)


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", key: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED) -> tuple[Lexicon, Forest]:
    """Learn the lexicon and the trees on at most `max_labelled` labelled rows, those with the least hash of their id.

    usable: condition on the label rows' key. The lexicon and the trees see four fifths of these rows (each without
    its own share in the lexicon), the isotonic steps the rest. Rows with a null key or label take no part; of repeated labels the greatest counts.
    """
    chosen = (
        labels.select(F.col(key).alias("__key"), F.col(label).alias("__label"))
        .where(F.col("__key").isNotNull() & F.col("__label").isNotNull())
        .groupBy("__key").agg(F.max("__label").alias("__label"))
        .withColumn(key, F.col("__key")).where(usable).drop(key)
        .orderBy(F.xxhash64("__key"), "__key").limit(max_labelled)
    )
    from .common import materialise

    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__key")
    rows = materialise(rows.withColumn("__hold", _in_calibration(F.col("__key"))), "toxic-sample")
    lexicon, for_toxic, for_clean = learn_lexicon(rows.where("NOT __hold"))
    parts = (("__hold", lexicon), ("NOT __hold AND __label = 1", for_toxic), ("NOT __hold AND __label <> 1", for_clean))
    made = [map_texts(rows.where(c), feature_maker(x), [("features", T.ArrayType(T.DoubleType()))], "__text", ["__key", "__label", "__hold"]) for c, x in parts]
    every = made[0].unionByName(made[1]).unionByName(made[2])
    got = every.orderBy(F.xxhash64("__key"), "__key", "features").limit(max_labelled).select("__label", "__hold", "features").collect()
    return lexicon, fit(np.array([r[2] for r in got], float), np.array([r[0] for r in got], float), np.array([r[1] for r in got], bool))


def score(docs: DataFrame, lexicon: Lexicon, forest: Forest, text: str = "text", cutoff: float = 0.3) -> DataFrame:
    """Add score (0 to 1; null and empty texts too) and predicted (1 where score >= cutoff) to every row.

    Input columns of these names give way; the others stay, and repeated rows stay.
    """
    start = feature_maker(lexicon)

    def make():
        features = start()

        def run(texts):
            s = forest.scores(features(texts)["features"])
            return {"score": s, "predicted": (s >= cutoff).astype("int32")}

        return run

    return map_texts(docs, make, [("score", T.DoubleType()), ("predicted", T.IntegerType())], text)
