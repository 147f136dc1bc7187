"""The preparation pipeline: extract or take documents, clean, chunk, deduplicate, gate, shard and export.

Every dropped row keeps its stage and reason.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.functions.chunking import ChunkConfig, chunk
from loamline.functions.cleaning import MIN_CLEANED, CleanConfig, clean
from loamline.functions.language import readability
from loamline.functions.quality import QualityConfig, gate_reason, with_metrics
from loamline.functions.text import strip, word_count
from loamline.operators.annotate import CATEGORIES, annotation_records, categorise, count_by
from loamline.operators.dedup import LshConfig, greedy_near_dedup, lsh_members, minhash, shared_members, verified_members
from loamline.operators.guard import FilterConfig, apply_filter
from loamline.operators.shards import ShardConfig, write_shards
from loamline.session import materialise
from loamline.sources.io import write_json_lines


@dataclass(frozen=True)
class PipelineConfig:
    clean: CleanConfig = CleanConfig()
    chunk: ChunkConfig = ChunkConfig()
    quality: QualityConfig = QualityConfig()
    lsh: LshConfig | None = LshConfig()
    filter: FilterConfig = FilterConfig(enabled=False)
    shards: ShardConfig = ShardConfig()
    categories: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(CATEGORIES))

    @staticmethod
    def of(sections: Mapping[str, Mapping]) -> PipelineConfig:
        """From nested mappings (as a YAML file gives them), one a field; unknown keys are errors, found on the driver."""
        kinds = {"clean": CleanConfig, "chunk": ChunkConfig, "quality": QualityConfig, "lsh": LshConfig, "filter": FilterConfig, "shards": ShardConfig}
        made = {}
        for name, values in sections.items():
            if name == "categories":
                made[name] = {k: tuple(v) for k, v in values.items()}
                continue
            if name not in kinds:
                raise ValueError(f"unknown section {name}")
            known = {f.name for f in fields(kinds[name])}
            if unknown := set(values) - known:
                raise ValueError(f"unknown keys in {name}: {sorted(unknown)}")
            made[name] = kinds[name](**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})
        return PipelineConfig(**made)


def gate_chunks(chunks: DataFrame, config: PipelineConfig, order: tuple[str, ...] = ("doc_id", "chunk_index"), key: str = "chunk_id") -> DataFrame:
    """Every chunk with its metrics, `stage` and `reason`, null for kept ones.

    Order of the checks: content filter, least length, exact duplicate, near duplicate, quality. A hash counts as seen
    from the length check on, so a copy of a chunk that fails later is still an exact duplicate. The chunks are written to
    the shared folder first, with their metrics, since several checks read them. Rows whose __lost (stage, reason) is set were dropped before and only pass through.
    """
    rows = apply_filter(chunks, config.filter, "filtering")
    early = F.when(F.col("filter_action") == "rejected", F.struct(F.lit("filter").alias("stage"), F.lit("rejected").alias("reason")))
    early = early.when(F.length(F.coalesce("text", F.lit(""))) < config.quality.min_text_length, F.struct(F.lit("length").alias("stage"), F.lit("too_short").alias("reason")))
    if "__lost" in chunks.columns:
        early = F.coalesce("__lost", early)
    ease = readability(F.col("text")) if config.quality.min_readability is not None else None
    rows = with_metrics(rows.withColumn("__early", early).drop("__lost")).withColumn("__gate", gate_reason(config.quality, ease))
    rows = materialise(rows.withColumn("text_sha256", F.sha2("text", 256)).withColumn("__at", F.monotonically_increasing_id()), "chunks")
    live = rows.where("__early IS NULL")
    # copies and near copies are found on narrow rows, and texts are joined once, with what falls
    narrow, place = live.select(*order, key, "text_sha256", "__at"), F.struct(*order, "__at")
    groups = narrow.groupBy(F.col("text_sha256").alias("__sha")).agg(F.min(place).alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    copies = narrow.join(groups, F.col("text_sha256").eqNullSafe(F.col("__sha"))).where(place != F.col("__first")).select("__at")
    copies = materialise(copies, "copies")
    falls = copies.withColumn("__falls", F.lit("exact_duplicate"))
    if config.lsh is not None:
        near = _near_copies(live, narrow, copies, config.lsh, order, key)
        falls = falls.unionByName(near.withColumn("__falls", F.lit("near_duplicate")))
    falls = falls.groupBy("__at").agg(F.min("__falls").alias("__falls"))
    why = lambda stage, reason: F.struct(F.lit(stage).alias("stage"), reason.alias("reason"))
    late = F.coalesce("__early", F.when(F.col("__falls").isNotNull(), why("dedup", F.col("__falls"))), F.when(F.col("__gate").isNotNull(), why("quality", F.col("__gate"))))
    out = rows.join(falls, "__at", "left").withColumn("__late", late)
    return out.withColumn("stage", F.col("__late.stage")).withColumn("reason", F.col("__late.reason")).drop("__at", "__early", "__gate", "__falls", "__late")


def _near_copies(live: DataFrame, narrow: DataFrame, copies: DataFrame, config: LshConfig, order: tuple[str, ...], key: str) -> DataFrame:
    """__at of the rows whose key falls under the greedy rule among the rows that are no copies.

    Minima are taken of all rows, so that no text is shuffled to leave the copies out; only rows of shared buckets, where copies
    are always, go on, by their number alone. The rule goes by the order of the pipeline; a struct of order and id keeps it.
    """
    bands, rows = config.split()
    members = materialise(lsh_members(minhash(live, config.permutations, "__at"), bands, rows, "__at"), "members")
    keys = narrow.join(copies, "__at", "left_anti").select("__at", F.struct(*order, key).alias("at"))
    shared = materialise(shared_members(members).join(keys, "__at").drop("__at").distinct(), "shared")
    if config.verify:
        texts = live.join(copies, "__at", "left_anti").select(F.struct(*order, key).alias("at"), "text")
        shared = materialise(verified_members(texts, shared_members(shared), config.threshold, "at"), "verified")
    fallen = greedy_near_dedup(shared, "at").select(F.col(f"at.{key}").alias(key))
    return narrow.join(fallen, key, "left_semi").select("__at")


def filter_chunks(chunks: DataFrame, config: FilterConfig, lost: str) -> DataFrame:
    """The filter's chunking stage: chunks that it rejects, or that have under MIN_CLEANED characters after it, get a stage and a reason in `lost`.

    Rows where `lost` is set already pass as they are. The counts are those of the filtered text.
    """
    if not config.active("chunking"):
        return chunks
    columns = chunks.columns
    out = apply_filter(chunks.withColumn("__seen", F.when(F.col(lost).isNull(), F.col("text"))), config, "chunking", "__seen")
    why = F.when(F.col("filter_action") == "rejected", "filter_rejected").when(F.length(strip(F.col("__seen"))) < MIN_CLEANED, "too_short_after_filter")
    fresh = F.col(lost).isNull()
    out = out.withColumn("text", F.when(fresh & F.col("__seen").isNotNull(), F.col("__seen")).otherwise(F.col("text")))
    out = out.withColumn(lost, F.when(fresh & why.isNotNull(), F.struct(F.lit("chunking").alias("stage"), why.alias("reason"))).otherwise(F.col(lost)))
    return out.withColumn("word_count", word_count(F.col("text"))).withColumn("char_count", F.length("text").cast("long")).select(columns)


def prepare(docs: DataFrame, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Chunks of the cleaned documents with stage and reason of what is dropped; null reason: kept.

    Every document has a row: one that fails cleaning, or has no chunk, is a row without chunk_id, as is a last group that is too short.
    The filter runs on cleaned texts, on chunks, and before the gate, in the stages that its configuration names.
    """
    cleaned = clean(docs, config.clean, guard=lambda rows: apply_filter(rows, config.filter, "cleaning", "cleaned"))
    lost = F.when(~F.col("cleaning_success"), F.struct(F.lit("cleaning").alias("stage"), F.col("cleaning_reason").alias("reason")))
    texts = cleaned.select(*[c for c in docs.columns if c != "text"], F.col("cleaned").alias("text"), lost.alias("__lost"))
    return gate_chunks(filter_chunks(chunk(texts, config.chunk, lost="__lost"), config.filter, "__lost"), config)


def removal_report(gated: DataFrame) -> DataFrame:
    """stage, reason and n; kept chunks under kept."""
    return gated.groupBy(F.coalesce("stage", F.lit("kept")).alias("stage"), F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def run(docs: DataFrame, out: str, config: PipelineConfig = PipelineConfig()) -> dict[str, DataFrame]:
    """Write gated chunks, shards, annotation lines and the metadata of both below `out`; returns the report, shard metadata and counts by category."""
    spark = docs.sparkSession
    prepare(docs, config).write.mode("overwrite").parquet(f"{out}/chunks")
    gated = spark.read.parquet(f"{out}/chunks")
    kept = gated.where("reason IS NULL").withColumn("id", F.col("chunk_id"))
    meta = write_shards(kept, f"{out}/shards", config.shards, "chunk_id")
    exported = annotation_records(categorise(kept, config.categories))
    write_json_lines(exported, f"{out}/annotations", "niche")
    counts = count_by(exported)
    now = F.current_timestamp().alias("created_at")
    meta.withColumn("created_at", now).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(f"{out}/shards_metadata")  # one row
    export = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_chunks"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("niche", "n")))).alias("niches"))
    export.withColumn("export_timestamp", now).coalesce(1).write.mode("overwrite").json(f"{out}/export_metadata")  # a row with an entry for each category
    return {"report": removal_report(gated), "shards": meta, "categories": counts}
