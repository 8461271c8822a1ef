"""Language identification by a string kernel, Nystroem landmarks and kernel ridge regression.

A text is the set of its byte n-grams (orders 1 to 4, ASCII letters lower-cased, other ASCII characters
one symbol), hashed to 0/1 vectors.  The blended-spectrum presence kernel of two texts is the mean over
the orders of ``|x & y| / sqrt(|x| |y|)``.  Landmarks, a few texts per language, give Nystroem features
``K(x, L) K(L, L)^(-1/2)``; one ridge regression per language against the rest is solved on them.  Scoring is
a matrix product of a batch of 0/1 vectors with the landmarks and one with the folded weights.

The model learns every language of the training fold, from at most ``PER_LANGUAGE`` labelled documents and
``LANDMARKS`` landmarks of each, first by a hash of the id.  Above ``MANY`` languages each has fewer of both, in
proportion, but one at least; what reaches the driver are packed bit vectors, unpacked block by block.
All texts are scored whole: a long text is hashed in pieces into one vector.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any usable training
document every text is ``und``; rows that repeat are scored each; null ids are held out never and train
never; an empty table gives no rows; extra columns are kept by :func:`predicted` unless they carry a
result's name, which then is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

ORDERS = (1, 2, 3, 4)
WIDTHS = (256, 2048, 8192, 8192)
PER_LANGUAGE = 800
LANDMARKS = 32  # per language
MANY = 50  # languages; of more, each has a smaller share of the rows and landmarks
RIDGE = 1e-2
SHARPNESS = 4.0
UNKNOWN = "und"
PIECE = 1 << 20
BATCH = 128
BLOCK = 2048

_STARTS = np.cumsum((0, *WIDTHS))
_SYMBOL = np.arange(256, dtype=np.uint32)
_SYMBOL[:128] = [ord(chr(i).lower()) if chr(i).isalpha() else 32 for i in range(128)]


def presence(text: bytes, out: np.ndarray) -> None:
    """Set the bits of a text's n-grams in ``out`` (one row of ``sum(WIDTHS)`` cells)."""
    for at in range(0, max(len(text), 1), PIECE):
        piece = _SYMBOL[np.frombuffer(text[at : at + PIECE + ORDERS[-1] - 1], np.uint8)]
        gram = np.zeros(len(piece), np.uint32)
        for order, width, start in zip(ORDERS, WIDTHS, _STARTS, strict=False):
            if len(piece) < order:
                break
            gram = piece if order == 1 else gram[:-1] * np.uint32(257) + piece[order - 1 :]
            cells = gram if order == 1 else (gram * np.uint32(2654435769)) >> np.uint32(32 - width.bit_length() + 1)
            out[start + cells] = 1


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Blended presence kernel between rows of 0/1 cells."""
    out = np.zeros((len(x), len(landmarks)))
    for start, end in zip(_STARTS[:-1], _STARTS[1:], strict=True):
        a, b = x[:, start:end].astype(np.float32), landmarks[:, start:end].astype(np.float32)
        size = np.sqrt(np.maximum(a.sum(1), 1))[:, None] * np.sqrt(np.maximum(b.sum(1), 1))[None, :]
        out += (a @ b.T) / size
    return out / len(ORDERS)


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray  # landmarks x languages, Nystroem map and regressions folded into one matrix

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Shares of the languages for rows of cells."""
        decided = SHARPNESS * np.column_stack([kernel(x, self.landmarks), np.ones(len(x))]) @ self.weights
        decided = np.exp(decided - decided.max(1, keepdims=True))
        return decided / decided.sum(1, keepdims=True)


def share_of(most: int, languages: int) -> int:
    """How many rows or landmarks one of so many languages has."""
    return max(1, most * min(languages, MANY) // max(languages, 1))


def _unpacked(cells: np.ndarray) -> np.ndarray:
    return cells if cells.shape[1] == _STARTS[-1] else np.unpackbits(cells, axis=1)[:, : _STARTS[-1]]


def fit(cells: np.ndarray, languages: list[str]) -> Model:
    """One ridge regression per language on Nystroem features; the first rows of each are landmarks.

    ``cells`` are rows of cells, or of packed ones.
    """
    names = sorted(set(languages))
    number = {name: k for k, name in enumerate(names)}
    of = np.array([number[v] for v in languages])
    each = share_of(LANDMARKS, len(names))
    by_language = np.argsort(of, kind="stable")
    place = np.arange(len(of)) - np.searchsorted(of[by_language], of[by_language])
    landmarks = _unpacked(cells[by_language[place < each]])
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks))
    values = np.maximum(values, 1e-6)
    root = vectors / np.sqrt(values) @ vectors.T
    size = len(landmarks) + 1
    left, right = np.zeros((size, size)), np.zeros((size, len(names)))
    # each language weighs the same, however many documents it has
    weight = (1.0 / np.bincount(of))[of] * len(cells) / len(names)
    for at in range(0, len(cells), BLOCK):
        mine = of[at : at + BLOCK]
        features = np.column_stack([kernel(_unpacked(cells[at : at + BLOCK]), landmarks) @ root, np.ones(len(mine))])
        wanted = np.where(mine[:, None] == np.arange(len(names))[None, :], 1.0, -1.0)
        weighed = (weight[at : at + BLOCK][:, None] * features).T
        left += weighed @ features
        right += weighed @ wanted
    solved = np.linalg.solve(left + RIDGE * len(cells) * np.eye(size) / 100, right)
    return Model(names, landmarks, np.vstack([root @ solved[:-1], solved[-1:]]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_cells(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[np.ndarray, list[str]]:
    """Packed 0/1 rows of labelled documents of every language, a bounded sample of each, by language in hash order."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.where(F.col("text").rlike(r"\p{L}"))
    counts = usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()  # one row per language
    if not counts:
        return np.zeros((0, _STARTS[-1]), np.uint8), []
    each = share_of(per_language, len(counts))
    # about one and a half times the rows wanted, and some, pass this test, so a frequent language ranks no more of them
    drawn = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 20))
    reach = [(r["lang"], -(-((3 * each // 2 + 32) << 20) // max(r["n"], 1))) for r in counts]
    reach = docs.sparkSession.createDataFrame(reach, "lang string, reach long")
    first = Window.partitionBy("lang").orderBy(drawn, "doc_id")
    chosen = usable.select("doc_id", "lang").join(F.broadcast(reach), "lang").where(drawn < F.col("reach")).select("doc_id", "lang").distinct()
    chosen = chosen.withColumn("place", F.row_number().over(first)).where(F.col("place") <= each)
    chosen = chosen.select("doc_id", F.col("lang").alias("taught"), "place")
    texts = usable.join(F.broadcast(chosen), "doc_id").where(F.col("lang") == F.col("taught"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, packed = [], []
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                if has_letter(text):
                    cells = np.zeros(_STARTS[-1], np.uint8)
                    presence(text.encode(), cells)
                    keep.append(i)
                    packed.append(np.packbits(cells).tobytes())
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column("taught"), part.column("place"), pa.array(packed, pa.binary())],
                ["lang", "place", "cells"],
            )

    found = texts.select("taught", F.col("place").cast("long").alias("place"), "text")
    rows = found.mapInArrow(run, "lang string, place long, cells binary")
    rows = rows.groupBy("lang", "place").agg(F.min("cells").alias("cells")).collect()  # a repeated doc_id is one row
    rows = sorted(rows, key=lambda r: (r["lang"], r["place"]))
    return np.array([np.frombuffer(r["cells"], np.uint8) for r in rows]), [r["lang"] for r in rows]


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score``; looks at the text alone."""
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        cells = np.zeros((BATCH, _STARTS[-1]), np.uint8)
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH):
                part = batch.slice(begin, BATCH)
                names, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                texts = part.column(at).to_pylist()
                known = [i for i, t in enumerate(texts) if has_letter(t)] if fitted else []
                cells[: len(known)] = 0
                for row, i in enumerate(known):
                    presence(texts[i].encode(), cells[row])
                if known:
                    share = fitted.scores(cells[: len(known)])
                    best = share.argmax(1)
                    for row, i in enumerate(known):
                        names[i] = fitted.languages[best[row]]
                        scores[i] = round(float(share[row, best[row]]), 4)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(scores)], [*part.schema.names, "lang_pred", "score"]
                )

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def fitted_model(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    cells, languages = training_cells(docs, per_language)
    return fit(cells, languages) if languages else None


def op3_language_id(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    model = fitted_model(docs.select("doc_id", "lang", "text"))
    found = predicted(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
