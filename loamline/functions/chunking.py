"""Splitting texts into chunks by sentence, paragraph or fixed word count: native folds over arrays."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import is_blank, stable_id, strip, word_count, words

METHODS = ("sentence", "paragraph", "fixed")
#: A text below min_words is one chunk from this many words on, and none below.
SHORT_TEXT_WORDS = 50


@dataclass(frozen=True)
class ChunkConfig:
    method: str = "fixed"
    min_words: int = 50
    max_words: int = 100_000
    overlap_words: int = 0

    def __post_init__(self) -> None:
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}")
        if self.max_words < 1 or not 0 <= self.overlap_words < self.max_words:
            raise ValueError("overlap_words must lie between 0 and max_words - 1")


def sentences(c: Column) -> Column:
    """Parts between runs of .!? that are followed by white space, stripped, without empties; the runs go."""
    return F.filter(F.transform(F.split(c, r"(?U)[.!?]+[\s\n]+"), strip), lambda x: x != "")


def paragraphs(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "\n\n"), strip), lambda x: x != "")


_NONE = "cast(array() as array<string>)"
_BOUNDS = "cast(array() as array<struct<lo:int,hi:int,large:boolean>>)"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _tail(sizes: Column, lo: Column, hi: Column, limit: int) -> Column:
    """How many last parts of lo..hi-1 have at most `limit` words together, and their words."""
    start = F.struct(F.lit(0).alias("parts"), F.lit(0).alias("words"), F.lit(True).alias("open"))

    def step(acc: Column, k: Column) -> Column:
        fits = acc["open"] & (acc["words"] + k <= limit)
        return F.struct((acc["parts"] + fits.cast("int")).alias("parts"), (acc["words"] + F.when(fits, k).otherwise(0)).alias("words"), fits.alias("open"))

    return F.aggregate(F.reverse(F.slice(sizes, lo + 1, hi - lo)), start, step)


def _bounds(sizes: Column, config: ChunkConfig, split_large: bool) -> Column:
    """Greedy groups over the parts' word counts: bounds of the full ones (lo to hi - 1), and from where the last one runs, with its words.

    Only places are carried from part to part; texts are cut and joined once the groups are known.
    """
    at = lambda bounds, lo, i, n: F.struct(bounds.alias("bounds"), lo.cast("int").alias("lo"), i.cast("int").alias("i"), n.cast("int").alias("n"))
    bound = lambda lo, hi, large: F.array(F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), F.lit(large).alias("large")))

    def step(acc: Column, k: Column) -> Column:
        bounds, lo, i, n = acc["bounds"], acc["lo"], acc["i"], acc["n"]
        closed = F.concat(bounds, bound(lo, i, False))
        if config.overlap_words:
            following = bind(_tail(sizes, lo, i, config.overlap_words), lambda t: at(closed, i - t["parts"], i + 1, t["words"] + k))
        else:
            following = at(closed, i, i + 1, k)
        out = F.when((i > lo) & (n + k > config.max_words), following).otherwise(at(bounds, lo, i + 1, n + k))
        if split_large:
            alone = at(F.concat(F.when(i > lo, closed).otherwise(bounds), bound(i, i + 1, True)), i + 1, i + 1, F.lit(0))
            out = F.when(k > config.max_words, alone).otherwise(out)
        return out

    return F.aggregate(sizes, at(F.expr(_BOUNDS), F.lit(0), F.lit(0), F.lit(0)), step)


def _pieces(chunks: Column, short: Column) -> Column:
    return F.struct(chunks.alias("chunks"), short.alias("short"))


def _packed(parts: Column, config: ChunkConfig, joiner: str, split: Callable[[Column], Column] | None = None) -> Column:
    """Greedy packing of parts into chunks of at most max_words (a single longer part stands alone, or gives the pieces that `split` makes of it).

    A full group starts the next with its last parts up to overlap_words. The last group stays only from min_words on; a shorter
    one goes to `short`. A part that is split flushes the group and leaves none behind.
    """

    def cut(texts: Column, g: Column) -> Column:
        joined = lambda lo, hi: F.array(F.array_join(F.slice(texts, lo + 1, hi - lo), joiner))
        none, last = F.expr(_NONE), joined(g["lo"], g["i"])
        some, long = g["i"] > g["lo"], g["n"] >= config.min_words
        tail = _pieces(F.when(some & long, last).otherwise(none), F.when(some & ~long, last).otherwise(none))
        whole = lambda b: joined(b["lo"], b["hi"])
        if split is None:
            return _pieces(F.concat(F.flatten(F.transform(g["bounds"], whole)), tail["chunks"]), tail["short"])
        made = F.transform(g["bounds"], lambda b: F.when(b["large"], split(texts[b["lo"]])).otherwise(_pieces(whole(b), none)))
        every = lambda m, name: F.concat(F.flatten(F.transform(m, lambda x: x[name])), tail[name])
        return bind(made, lambda m: _pieces(every(m, "chunks"), every(m, "short")))

    sizes = lambda texts: F.transform(texts, lambda x: F.size(words(x)))
    return bind(parts, lambda texts: bind(sizes(texts), lambda ks: bind(_bounds(ks, config, split is not None), lambda g: cut(texts, g))))


def _unless_short(c: Column, config: ChunkConfig, pieces: Callable[[Column], Column]) -> Column:
    """The pieces of a text; below min_words the whole text from SHORT_TEXT_WORDS on, and nothing below."""
    none = F.expr(_NONE)
    some = lambda n: F.when(n < config.min_words, _pieces(F.when(n >= SHORT_TEXT_WORDS, F.array(c)).otherwise(none), none)).otherwise(pieces(c))
    return bind(F.size(words(c)), some)


def by_sentence(c: Column, config: ChunkConfig) -> Column:
    return _unless_short(c, config, lambda t: _packed(sentences(t), config, " "))


def by_paragraph(c: Column, config: ChunkConfig) -> Column:
    return _unless_short(c, config, lambda t: _packed(paragraphs(t), config, "\n\n", lambda p: by_sentence(p, config)))


def by_size(c: Column, config: ChunkConfig) -> Column:
    """Windows of max_words words that step by max_words - overlap_words and end with the first that reaches the last word."""
    step = config.max_words - config.overlap_words

    def windows(w: Column) -> Column:
        last = F.greatest(F.lit(0), F.ceil((F.size(w) - config.overlap_words) / step).cast("int") - 1)
        made = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(w, i * step + 1, config.max_words), " "))
        return _pieces(F.when(F.size(w) > 0, made).otherwise(F.expr(_NONE)), F.expr(_NONE))

    return bind(words(c), windows)


def pieces_of(c: Column, config: ChunkConfig) -> Column:
    """The chunks of a text and the last groups that are too short to be one: a struct of two arrays."""
    make = {"sentence": by_sentence, "paragraph": by_paragraph, "fixed": by_size}[config.method]
    return bind(F.coalesce(c, F.lit("")), lambda t: make(t, config))


def chunks_of(c: Column, config: ChunkConfig) -> Column:
    """The chunks of a text as an array; null gives none."""
    return pieces_of(c, config)["chunks"]


def chunk(df: DataFrame, config: ChunkConfig = ChunkConfig(), text: str = "text", key: str = "doc_id", lost: str | None = None) -> DataFrame:
    """One row per chunk: the other columns, chunk_id, text, chunk_index (from 0), total_chunks, chunking_method, word_count, char_count.

    lost names a struct column (stage, reason) of df: rows where it is set are not chunked but stay, and what chunking drops joins
    them as rows with stage chunking: short last groups, and texts without a chunk. Such rows have no chunk_id and no chunk_index.
    """
    rest = [c for c in df.columns if c not in (text, "chunk_id", "chunk_index", "total_chunks", "chunking_method", "word_count", "char_count")]
    if lost is None:
        # outer: else the optimizer infers a filter that computes the chunks a second time
        made = df.select(*rest, chunks_of(F.col(text), config).alias("__chunks"))
        rows = made.select(*rest, F.size("__chunks").alias("total_chunks"), F.posexplode_outer("__chunks").alias("chunk_index", "text")).where(~is_blank(F.col("text")))
    else:
        rest.remove(lost)
        gone = F.col(lost)
        made = df.select(*rest, lost, F.col(text).alias("__text"), F.when(gone.isNull(), pieces_of(F.col(text), config)).alias("__made"))
        piece = lambda t, i, why: F.struct(i.cast("int").alias("i"), t.alias("t"), why.alias("why"))
        drop = lambda t, reason: piece(t, F.lit(None), F.struct(F.lit("chunking").alias("stage"), reason.alias("reason")))
        fine = F.lit(None).cast("struct<stage:string,reason:string>")
        kept = F.transform(F.col("__made.chunks"), lambda t, i: piece(t, i, fine))
        short = F.transform(F.col("__made.short"), lambda t: drop(t, F.lit("short_last_group")))
        whole = F.array(drop(F.col("__text"), F.when(is_blank(F.col("__text")), "no_words").otherwise("too_few_words")))
        found = F.concat(kept, short)
        pieces = F.when(gone.isNotNull(), F.array(piece(F.col("__text"), F.lit(None), gone))).when(F.size(found) > 0, found).otherwise(whole)
        rows = made.select(*rest, F.coalesce(F.size("__made.chunks"), F.lit(0)).alias("total_chunks"), F.explode_outer(pieces).alias("__p"))
        rows = rows.select(*rest, "total_chunks", F.col("__p.i").alias("chunk_index"), F.col("__p.t").alias("text"), F.col("__p.why").alias(lost))
        rest.append(lost)
    made_id = stable_id(F.col(key), F.col("chunk_index"), F.col("text"))
    return rows.select(
        *rest, (made_id if lost is None else F.when(F.col(lost).isNull(), made_id)).alias("chunk_id"), "text", "chunk_index", "total_chunks",
        F.lit(config.method).alias("chunking_method"), word_count(F.col("text")).alias("word_count"), F.length("text").cast("long").alias("char_count"),
    )
