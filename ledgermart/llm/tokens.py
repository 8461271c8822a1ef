"""Token-id output: canonical Huffman blocks from global counts, read back block by block.

Texts are encoded once, in tasks over the input.  The ids travel once, to ranges of ascending doc_id
whose bounds are quantiles of the ids, and both readers of that shuffle - the global counts and the block
writer - use its files; this is why an RDD of the shuffled rows is kept instead of a DataFrame that would be
planned, and encoded, twice.  The counts become one canonical code of at most ``MAX_BITS`` bits (its size
is the vocabulary's).  A block holds whole documents, about ``BLOCK`` ids, and can be decoded alone.

File format: a Parquet table of blocks in a folder ``blocks`` (``slice, block`` give the order, ``doc_ids``
and ``doc_sizes`` the documents, ``checkpoints`` bit offsets, ``payload`` the bits) and ``lengths`` (code
length per id), from which the code follows.  Parquet carries the bytes so that any store Spark can
reach will do.

Defined cases: a null or empty text is its end id alone; null doc_ids come first; rows that repeat are all
written, next to each other; equal doc_ids are ordered by their ids' hash; an empty table gives empty
files; extra columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import huffman
from .common import slices, stage_path, table

BLOCK = 1 << 18
END = 0
VOCABULARY = "byte_bpe_50k.json"
#: words that the library encodes at once, and words in one string of these
REMEMBERED = 8192
PIECES = 512
#: Fixed value: letters at a word's start, before an ASCII character that is none
LETTERS = r"^(?s)(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<rest>[\x00-@\[-`{-\x7F].*)$"
#: bytes of text that are encoded at once, bytes of ids that are counted at once, and words whose ids are laid out at once
PART = 16 << 20
COUNTED = 4 << 20
GATHERED = 1 << 18
_ENCODERS: dict = {}
_TABLES: dict = {}


def byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


class Encoder:
    """A byte-level BPE tokenizer of the ``tokenizers`` library that encodes each different word of a batch once.

    The tokenizer cuts a text into pieces before it merges, and a space that a visible character follows
    always begins a piece.  So a text's ids are those of its space-separated words.  Arrow splits a batch
    and numbers its different words, the library encodes these, many in one string, and numpy lays the
    ids out in the order of the words.  Where a word's ids end in the string follows from the number of bytes
    that each id stands for.  Nothing is kept from batch to batch.  Texts that hold an added token, separator
    controls or a space before white space, and tokenizers that cut in another way, are encoded whole.
    """

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = t = Tokenizer.from_file(path)
        cut, added = t.pre_tokenizer, [token.content for token in t.get_added_tokens_decoder().values()]
        plain = t.normalizer is None and t.post_processor is None and t.truncation is None and t.padding is None
        known = all(t.token_to_id(c) is not None for c in byte_alphabet().values()) and not any(" " in a for a in added)
        self.by_word = plain and known and isinstance(cut, ByteLevel) and cut.use_regex and not cut.add_prefix_space
        self.size = t.get_vocab_size()
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        # a character of a byte-level token is a byte
        self.n_bytes = np.array([len(t.id_to_token(i) or " ") for i in range(self.size)])
        blank = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
        self.odd = "|".join([rf"[\x1C-\x1F]| (?:[{blank}]|\z)", *map(re.escape, added)])

    def each(self, strings: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that follow a space, end to end, and how many each word has."""
        listed, found = words.to_pylist(), [np.zeros(0, self.kind)]
        for at in range(0, len(listed), REMEMBERED):
            some = listed[at : at + REMEMBERED]
            found += self.each([" " + " ".join(some[k : k + PIECES]) for k in range(0, len(some), PIECES)])
        ids = np.concatenate(found)
        ends = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        reached = np.cumsum(self.n_bytes[ids])
        last = np.searchsorted(reached, ends)
        if len(ends) and (reached[-1] != ends[-1] or (reached[last] != ends).any()):
            raise ValueError("the ids of two words can't be told apart")
        return ids, np.diff(last, prepend=-1)

    def after_space(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same, with a word's letters apart from what follows them: there the tokenizer cuts in any case."""
        cut = pc.extract_regex(words, LETTERS)
        parted = cut.is_valid().to_numpy(zero_copy_only=False)
        at = np.flatnonzero(parted)
        heads = pc.if_else(cut.is_valid(), pc.struct_field(cut, "letters"), words).dictionary_encode()
        tails = pc.struct_field(cut, "rest").take(pa.array(at)).dictionary_encode()
        ids, sizes = self.joined(heads.dictionary)
        known = len(sizes)
        behind = self.each(tails.dictionary.to_pylist())
        ids, sizes = np.concatenate([ids, *behind]), np.concatenate([sizes, [*map(len, behind), 0]])
        order = np.full((len(words), 2), len(sizes) - 1)  # the last one, of no ids, where nothing follows
        order[:, 0] = heads.indices.to_numpy()
        order[at, 1] = known + tails.indices.to_numpy()
        return self.laid(ids, sizes, order.ravel()), sizes[order].sum(1)

    def laid(self, flat: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
        """The ids of parts, given end to end with their sizes, in another order."""
        starts, ends = np.cumsum(sizes) - sizes, np.cumsum(sizes[order])
        ids = np.empty(ends[-1] if len(ends) else 0, self.kind)
        for at in range(0, len(order), GATHERED):
            some = order[at : at + GATHERED]
            size, begin = sizes[some], ends[at] - sizes[order[at]]
            last = ends[at + len(some) - 1]
            shift = starts[some] - (ends[at : at + len(some)] - size - begin)
            ids[begin:last] = flat[np.repeat(shift, size) + np.arange(last - begin)]
        return ids

    def encode(self, texts: pa.Array) -> pa.Array:
        """Packed ids of each text, with the end id; a null text has the end id alone."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, self.odd) if self.by_word else pa.array([True] * len(texts))
        others = odd.to_numpy(zero_copy_only=False)
        # an odd text is one word of its own; of the others, words after the first follow a space
        lists = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        split = lists.flatten().dictionary_encode()
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        codes, n = split.indices.to_numpy(), len(texts)
        later = np.ones(len(codes), bool)
        later[bounds[:-1]] = False
        known = split.dictionary
        followed = np.zeros(len(known), bool)
        followed[codes[later]] = True
        followed = np.flatnonzero(followed)
        found, counts = self.after_space(known.take(pa.array(followed)))
        heads = self.each(known.take(pa.array(codes[~later])).to_pylist())
        for i in np.flatnonzero(others).tolist():
            heads[i] = self.each([texts[i].as_py()])[0]
        # the ids of the words that follow a space, of each text's own first word, and the end id
        flat = np.concatenate([found, *heads, np.array([END], self.kind)])
        sizes = np.zeros(len(known) + n + 1, np.int64)
        sizes[followed] = counts
        sizes[len(known) :] = [*map(len, heads), 1]
        # the codes with each text's own first word, and the end id behind each text
        order = np.full(len(codes) + n, len(sizes) - 1)
        number = np.repeat(np.arange(n), np.diff(bounds))
        order[np.arange(len(codes)) + number] = np.where(later, codes, len(known) + number)
        ids = self.laid(flat, sizes, order)
        limits = np.zeros(n + 1, np.int32)
        limits[1:] = np.cumsum(sizes[order])[bounds[1:] + np.arange(n)] * np.dtype(self.kind).itemsize
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(limits), pa.py_buffer(ids)])


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Stretches of a batch with about ``PART`` bytes of text; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = (np.cumsum(sizes) - sizes) // PART
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for at, end in zip(cuts, cuts[1:]):
        if at < end:
            yield batch.slice(at, end - at)


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: packed little-endian ids (2 bytes each for up to 65,536 ids) with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path)
        for batch in batches:
            for part in parts_of(batch):
                ids = made.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def _slice_of(docs: DataFrame, parts: int):
    """Slice number by ascending doc_id: how many of the bounds are at or below it."""
    shares = [i / parts for i in range(1, parts)]
    bounds = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, 10_000)).first()[0] if shares else None
    bounds = sorted(set(bounds or []))
    if not bounds:
        return F.lit(0)
    # Java's binary search: the index, or -(insertion point) - 1
    return F.coalesce(
        F.expr(f"array_size(filter(array({','.join(f'{b}L' for b in bounds)}), b -> b <= doc_id))"), F.lit(0)
    )


BLOCKS = (
    "slice int, block int, n_ids long, doc_ids array<long>, doc_sizes array<long>, checkpoints array<long>, payload binary"
)


def write_ids(docs: DataFrame, path: str, target: str) -> None:
    """Encode ``docs`` and write ``target/blocks`` and ``target/lengths``."""
    spark = docs.sparkSession
    parts = slices(spark)
    kind, size = (lambda e: (e.kind, e.size))(encoder(path))
    placed = token_ids(docs, path).withColumn("slice", _slice_of(docs, parts).cast("int"))
    order = ["slice", "doc_id", "hash"]
    placed = placed.withColumn("hash", F.xxhash64("ids")).repartitionById(parts, "slice").sortWithinPartitions(*order)
    rows = placed.select("slice", "doc_id", "ids").rdd  # its shuffle files serve both passes below
    step = 4096

    def count(batch):
        total, held, length = np.zeros(size, np.int64), [], 0
        for row in batch:
            held.append(row["ids"])
            length += len(held[-1])
            if length >= COUNTED:  # one array of counts for many documents
                total += np.bincount(np.frombuffer(b"".join(held), kind), minlength=size)
                held, length = [], 0
        total += np.bincount(np.frombuffer(b"".join(held), kind), minlength=size)
        return ((at, total[at : at + step]) for at in range(0, size, step))

    counts = np.zeros(size, np.int64)
    for at, part in rows.mapPartitions(count).reduceByKey(lambda a, b: a + b).collect():
        counts[at : at + step] = part
    lengths = huffman.code_lengths(counts)
    code = huffman.codes(lengths)
    shared = spark.sparkContext.broadcast((lengths, code))

    def blocks(batch):
        lengths, code = shared.value
        part, number, ids, held = None, 0, [], 0
        pieces: list[np.ndarray] = []

        def out():
            payload, checkpoints = huffman.encode(np.concatenate(pieces), lengths, code)
            return part, number, held, ids, [len(p) for p in pieces], checkpoints.tolist(), bytearray(payload)

        for row in batch:
            if pieces and (row["slice"] != part or held >= BLOCK):
                yield out()
                number = number + 1 if row["slice"] == part else 0
                pieces, ids, held = [], [], 0
            elif row["slice"] != part:
                number = 0
            part = row["slice"]
            pieces.append(np.frombuffer(row["ids"], kind))
            ids.append(row["doc_id"])
            held += len(pieces[-1])
        if pieces:
            yield out()

    spark.createDataFrame(rows.mapPartitions(blocks), BLOCKS).write.parquet(f"{target}/blocks")
    coded = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(coded, "id int, length int").coalesce(1).write.parquet(f"{target}/lengths")
    shared.unpersist()


def _code_lengths(spark: SparkSession, target: str) -> np.ndarray:
    rows = spark.read.parquet(f"{target}/lengths").collect()  # at most one row per id of the vocabulary
    out = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.uint8)
    for r in rows:
        out[r["id"]] = r["length"]
    return out


def decoding_table(lengths: np.ndarray):
    """The table of a code; a worker process keeps that of the last one."""
    key = lengths.tobytes()
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = huffman.decoding_table(lengths)
    return _TABLES[key]


def read_ids(spark: SparkSession, target: str, digests: bool = False) -> DataFrame:
    """The documents of the files: ``slice, block, at, doc_id, n_tokens`` and ``ids`` or ``ids_crc32``.

    ``at`` counts the ids of the block before the document; every block is decoded for itself.
    """
    shared = spark.sparkContext.broadcast(_code_lengths(spark, target))
    last = ("ids_crc32", pa.int64()) if digests else ("ids", pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = decoding_table(shared.value)
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                ids = huffman.decode(row["payload"], row["n_ids"], np.array(row["checkpoints"]), made)
                sizes = np.array(row["doc_sizes"], np.int64)
                ends = np.cumsum(sizes)
                parts = [ids[e - n : e] for e, n in zip(ends, sizes, strict=True)]
                value = [zlib.crc32(p.astype("<u4").tobytes()) for p in parts] if digests else [p.tolist() for p in parts]
                k = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["slice"]] * k, pa.int32()), pa.array([row["block"]] * k, pa.int32()), pa.array(ends - sizes),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(sizes), pa.array(value, last[1])],
                    ["slice", "block", "at", "doc_id", "n_tokens", last[0]],
                )

    kind = "ids_crc32 long" if digests else "ids array<long>"
    stored = spark.read.parquet(f"{target}/blocks")
    return stored.mapInArrow(run, f"slice int, block int, at long, doc_id long, n_tokens long, {kind}")


def block_starts(spark: SparkSession, target: str) -> DataFrame:
    """``slice, block, before``: ids of all blocks before.  One row per slice meets in one window."""
    sizes = spark.read.parquet(f"{target}/blocks").select("slice", "block", "n_ids")
    totals = sizes.groupBy("slice").agg(F.sum("n_ids").alias("n"))
    totals = totals.select("slice", (F.sum("n").over(Window.orderBy("slice")) - F.col("n")).alias("of_slice"))
    inside = F.sum("n_ids").over(Window.partitionBy("slice").orderBy("block")) - F.col("n_ids")
    return sizes.withColumn("inside", inside).join(totals, "slice").select(
        "slice", "block", (F.col("of_slice") + F.col("inside")).alias("before")
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Write ``docs`` to the shared folder, read the files back: ``doc_id, start, n_tokens, ids_crc32``."""
    spark = docs.sparkSession
    target = stage_path(spark, "token-ids")
    write_ids(docs, path, target)
    rows = read_ids(spark, target, digests=True).join(block_starts(spark, target), ["slice", "block"])
    return rows.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_ids(spark: SparkSession, directory: str) -> DataFrame:
    return round_trip(table(spark, directory, "documents").select("doc_id", "text"), vocabulary())
