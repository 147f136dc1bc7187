"""Byte-level BPE encoding and decoding; long texts by tree concatenation.

A text longer than a leaf is halved until its parts fit, the parts are encoded in parallel tasks, and neighbours are
joined pairwise up the tree. Where the cut lies at a boundary that the pre-tokenizer makes whatever stands around it, the
parts' tokens only follow each other. Where it lies inside unsplit text (one long run of letters, digits, spaces or
signs), a window of tokens around the join is encoded anew and grows until its first and last token are those of both
sides: tokens are an encoding of a run exactly if each neighbouring pair is one, and then every pair is.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_memory, small_batches

LEAF = 32_768
#: Characters around a wanted cut that are searched for a boundary.
REACH = 64
_CLASS = regex.compile(r"(\s)|(\p{L})|(\p{N})|(.)", regex.S)
_RUNS = {1: regex.compile(r"\s+"), 2: regex.compile(r"\p{L}+"), 3: regex.compile(r"\p{N}+"), 4: regex.compile(r"[^\s\p{L}\p{N}]+")}
SPACE, LETTER, DIGIT, SIGN = 1, 2, 3, 4
# Fixed value: the pre-tokenizer's pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The printable letter that a byte-level vocabulary writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@lru_cache(2)
def load(path: str) -> tuple[tiktoken.Encoding, dict[str, int]]:
    """The encoder of a byte-level BPE file (JSON) and its special tokens. Ids must rise with the merges' ranks."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    letters = _byte_letters()
    special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
    as_bytes = lambda s: bytes(letters[c] for c in s)
    ranks = {as_bytes(s): i for s, i in data["model"]["vocab"].items() if s not in special}
    made = [ranks[as_bytes(a) + as_bytes(b)] for a, b in (m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"])]
    if made != sorted(made):
        raise ValueError("merge ranks and ids differ in order")
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special), special


def encode_leaf(encoder: tiktoken.Encoding, text: str) -> list[int]:
    return encoder.encode(text, allowed_special="all", disallowed_special=())


def decode_ids(encoder: tiktoken.Encoding, ids: bytes) -> str:
    return encoder.decode_bytes(np.frombuffer(ids, "<u4").tolist()).decode("utf-8", "replace")


def _kind(c: str) -> int:
    return _CLASS.match(c).lastindex


def _free(before: str, after: str) -> bool:
    """Whether the pre-tokenizer ends a piece between the two characters whatever stands around them."""
    a, b = _kind(before), _kind(after)
    if a == b:
        return False
    if b == SPACE or a in (LETTER, DIGIT):
        return True
    return a == SIGN and before != "'"


def _cut(text: str, lo: int, hi: int) -> tuple[int, bool]:
    """A cut near the middle of text[lo:hi]: (place, free)."""
    middle = (lo + hi) // 2
    for d in range(REACH):
        for p in (middle + d, middle - d):
            if lo < p < hi and _free(text[p - 1], text[p]):
                return p, True
    for p in range(max(lo + 9, middle - REACH), min(hi - 9, middle + REACH)):
        if len({_kind(c) for c in text[p - 8 : p + 8]}) == 1:
            return p, False
    return 0, False


def leaves(text: str, leaf: int = LEAF, special: tuple[str, ...] = ()) -> list[tuple[str, int, int]]:
    """The parts of a text, in order: (part, left, right). left and right tell of the join to the part before: how many
    UTF-8 bytes of one unsplit run lie on each side, or 0 and 0 where nothing crosses the join."""
    pieces = regex.split("(" + "|".join(map(regex.escape, special)) + ")", text) if special else [text]
    out: list[tuple[str, int, int]] = []

    def size(s: str) -> int:
        return len(s.encode("utf-8"))

    def run_around(s: str, p: int) -> tuple[int, int]:
        kind = _kind(s[p])
        end = _RUNS[kind].match(s, p).end()
        start = p
        step = 4096
        while start > 0:  # back in growing strides
            lo = max(0, start - step)
            tail = list(_RUNS[kind].finditer(s, lo, start))
            if not tail or tail[-1].end() != start:
                break
            start = tail[-1].start()
            if start > lo:
                break
        end -= kind == SPACE and end < len(s)  # the last space may go with what follows
        return size(s[start:p]), size(s[p:end]) if end > p else 0

    def halve(s: str, lo: int, hi: int, join: tuple[int, int]) -> None:
        cut, free = _cut(s, lo, hi) if hi - lo > leaf else (0, False)
        if not cut:
            out.append((s[lo:hi], *join))
            return
        halve(s, lo, cut, join)
        halve(s, cut, hi, (0, 0) if free else run_around(s, cut))

    for piece in pieces:
        if piece:
            halve(piece, 0, len(piece), (0, 0))
    return out


def join(encoder: tiktoken.Encoding, a: list[int], b: list[int], left: int, right: int) -> list[int]:
    """The encoding of two neighbouring parts' text. left, right: bytes of the unsplit run on each side of the join."""
    if not left or not right or not a or not b:
        return a + b
    size = lambda t: len(encoder.decode_single_token_bytes(t))
    i = j = used_left = used_right = 0  # tokens, and their bytes, in the window
    width = 4
    while True:
        full_left = full_right = False
        while i < width and not full_left:
            n = size(a[-1 - i]) if i < len(a) else left + 1
            full_left = used_left + n > left
            if not full_left:
                i, used_left = i + 1, used_left + n
        while j < width and not full_right:
            n = size(b[j]) if j < len(b) else right + 1
            full_right = used_right + n > right
            if not full_right:
                j, used_right = j + 1, used_right + n
        lead = 0
        if full_left and i < len(a):  # the space before a run is of the same piece; a contraction before it is not
            before = encoder.decode_single_token_bytes(a[-1 - i])
            lead = int(before.startswith(b" ") if used_left < left else before == b" ")
        window = a[len(a) - i - lead :] + b[:j]
        again = encoder._encode_single_piece(b"".join(map(encoder.decode_single_token_bytes, window)))
        agrees_left = full_left or (i and again and again[0] == window[0])
        agrees_right = full_right or (j and again and again[-1] == window[-1])
        if agrees_left and agrees_right:
            return a[: len(a) - i - lead] + again + b[j:]
        width *= 2


def join_tree(encoder: tiktoken.Encoding, parts: list[list[int]], joins: list[tuple[int, int]]) -> list[int]:
    """Join neighbours pairwise until one is left; joins[i] tells of the join before part i."""
    while len(parts) > 1:
        parts, joins = (
            [join(encoder, parts[i], parts[i + 1], *joins[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)],
            joins[::2],
        )
    return parts[0] if parts else []


def as_ids(tokens: list[int]) -> bytes:
    return np.asarray(tokens, "<u4").tobytes()


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, leaf: int = LEAF, decoded: str | None = None) -> DataFrame:
    """The kept columns (all but the text by default) and ids: the text's token ids as little-endian unsigned 32-bit.

    decoded: the name of one more column, the text that the stored ids decode to, made in the same pass (see decode()).
    Special tokens' strings in a text get their ids; none are added. A null or empty text has no ids (an empty binary).
    Each row, repeated or not, is encoded on its own; a kept column named ids gives way. path must exist on every
    executor. Texts longer than `leaf` characters are cut, encoded in parallel and joined; the others stay where
    they are, without a shuffle.
    """
    small_batches(docs.sparkSession)
    stay = [c for c in (keep if keep is not None else docs.columns) if c not in ("ids", decoded) and (keep is not None or c != text)]
    source = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(stay)], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    kinds = dict(source.dtypes)
    kept = [f"k{i}" for i in range(len(stay))]
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in kept], "ids binary", *["__decoded string"] * bool(decoded)])

    def made(encoder, ids):
        """The new columns of a list of ids."""
        return [pa.array(ids, pa.binary()), *([pa.array([decode_ids(encoder, x) for x in ids], pa.string())] if decoded else [])]

    names = [*kept, "ids", *["__decoded"] * bool(decoded)]

    def whole(batches):
        encoder, _ = load(path)
        for batch in batches:
            ids = [as_ids(encode_leaf(encoder, t)) for t in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made(encoder, ids)], names=names)
        release_memory()

    def cut(batches):
        _, special = load(path)
        for batch in batches:
            for i, (row, t) in enumerate(zip(batch.column(len(kept) + 1).to_pylist(), batch.column(len(kept)).to_pylist())):
                parts = leaves(t, leaf, tuple(special))
                n = len(parts)
                own = [pa.concat_arrays([batch.column(k).slice(i, 1)] * n) for k in range(len(kept))]
                columns = [pa.array([row] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([p[0] for p in parts]), pa.array([p[1] for p in parts], pa.int64()), pa.array([p[2] for p in parts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*own, *columns], names=[*kept, "__row", "__leaf", "__part", "__left", "__right"])

    def encode_parts(batches):
        encoder, _ = load(path)
        for batch in batches:
            at = batch.schema.get_field_index("__part")
            ids = [as_ids(encode_leaf(encoder, t)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, "__part", pa.array(ids, pa.binary()))
        release_memory()

    def combine(table: pa.Table) -> pa.Table:
        encoder, _ = load(path)
        table = table.sort_by("__leaf")
        parts = [np.frombuffer(p, "<u4").tolist() for p in table["__part"].to_pylist()]
        ids = join_tree(encoder, parts, list(zip(table["__left"].to_pylist(), table["__right"].to_pylist())))
        first = table.slice(0, 1)
        return pa.table([*[first[c] for c in kept], *made(encoder, [as_ids(ids)])], names=names)

    own = ", ".join(f"`{c}` {kinds[c]}, " for c in kept).replace(", , ", ", ")
    short = source.where(F.length("__text") <= leaf).mapInArrow(whole, schema)
    rest = "__row long, __leaf int, __part {}, __left long, __right long"
    long = (
        source.where(F.length("__text") > leaf)
        .withColumn("__row", F.monotonically_increasing_id())
        .mapInArrow(cut, own + rest.format("string"))
        .repartition("__row", "__leaf")
        .mapInArrow(encode_parts, own + rest.format("binary"))
        .groupBy("__row")
        .applyInArrow(combine, schema)
    )
    return short.unionByName(long).select(*[F.col(c).alias(name) for c, name in zip(kept, stay)], "ids", *([F.col("__decoded").alias(decoded)] if decoded else []))


def decode(encoded: DataFrame, path: str, column: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """Add the decoded text of `ids` to the kept columns (all by default); null ids give a null text, bytes that are no
    UTF-8 give U+FFFD. Special tokens are written out. An input column named as the new one gives way."""
    small_batches(encoded.sparkSession)
    stay = [c for c in (keep if keep is not None else encoded.columns) if c != column]
    source = encoded.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(stay)], F.col("ids").alias("__ids"))
    kinds = dict(source.dtypes)

    def run(batches):
        encoder, _ = load(path)
        for batch in batches:
            texts = [None if ids is None else decode_ids(encoder, ids) for ids in batch.column(len(stay)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*[f"k{i}" for i in range(len(stay))], "__out"])

    schema = ", ".join([*[f"k{i} {kinds[f'k{i}']}" for i in range(len(stay))], "__out string"])
    out = source.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(stay)], F.col("__out").alias(column))


def digests(encoded: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 beside the other columns of a decoded frame."""
    rest = [c for c in encoded.columns if c not in ("ids", "decoded")]
    return encoded.select(
        *rest,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
