"""Quality scores by co-training two classifiers, one on the text and one on what is known about the page.

Both are logistic regressions, fitted on bounded samples of documents with and without label. In each round, either gives the labels it is most
sure of, on documents without a label, to the other. Each view is calibrated on labelled documents that no round trained
on, and a third regression combines the calibrated views. All documents are then scored in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from shelfledger.llm.common import fields_of, whole_row
from shelfledger.llm.shingles import runs, word_hashes

#: Documents to fit on, on average: so many with a label, and so many without; of either never more than twice as many.
SAMPLE = 20_000
ROUNDS, SURE, GIVEN_SHARE = 3, 0.95, 0.1
#: Every fifth labelled document calibrates.
CALIBRATION = 5
#: Next to no penalty: it would pull calibrated scores towards a half.
CALIBRATION_RIDGE = 0.01
#: The threshold is a half, or lower where that would lose more of the good documents that calibrate.
KEPT_GOOD = 0.99
WORD_SLOTS, SOURCE_SLOTS, LANG_SLOTS = 64, 32, 8
#: Shares are taken by the logarithm of 1 + this multiple, so that what is rare in prose tells.
RARE = 100.0

CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b",.;:", b"!?", b"|/\\_=<>{}[]", b"%$#*&@^~+", bytes(range(128, 256)), b"\n"]
IN_CLASS = np.zeros((len(CLASSES), 256), np.float32)
for _number, _members in enumerate(CLASSES):
    IN_CLASS[_number, list(_members)] = 1


def text_features(texts: pa.Array) -> np.ndarray:
    """Shares of kinds of bytes, how words repeat, and the shares of words by hash."""
    found = []
    for run, begins in runs(texts):
        n = len(begins)
        sizes = np.maximum(1, np.diff([*begins, len(run)]) - 1)
        shares = [np.log1p(RARE * np.add.reduceat(kind[run], begins) / sizes) for kind in IN_CLASS]
        starts, words = word_hashes(run)
        owner = np.searchsorted(begins, starts, "right") - 1
        counts = np.bincount(owner, minlength=n)
        some = np.maximum(1, counts)
        order = np.lexsort((words, owner))
        fresh = np.ones(len(words), bool)
        fresh[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        distinct = np.bincount(owner[order][fresh], minlength=n)
        repeats = np.flatnonzero((words[1:] == words[:-1]) & (owner[1:] == owner[:-1]))
        adjacent = np.bincount(owner[repeats], minlength=n) if len(repeats) else np.zeros(n)
        # Longer texts repeat more words anyway, so distinct words are held against a power of the count.
        richness = distinct / some**0.75
        slots = owner * WORD_SLOTS + (words % np.uint64(WORD_SLOTS)).astype(np.int64)
        by_slot = np.bincount(slots, minlength=n * WORD_SLOTS).reshape(n, WORD_SLOTS) / some[:, None]
        length = sizes / some
        repeated = np.log1p(RARE * adjacent / some)
        sizes_of_words = [np.log1p(counts), np.log1p(length)]
        found.append(np.column_stack([*shares, distinct / some, richness, repeated, *sizes_of_words, by_slot]))
    width = len(CLASSES) + 5 + WORD_SLOTS
    return np.concatenate(found).astype(np.float32) if found else np.empty((0, width), np.float32)


def _one_of(values: pa.Array, slots: int) -> np.ndarray:
    codes = values.dictionary_encode()
    slot = [xxhash.xxh32_intdigest(str(value)) % slots for value in codes.dictionary.to_pylist()] + [slots]
    at = pc.fill_null(codes.indices, len(slot) - 1).to_numpy(zero_copy_only=False)
    return np.eye(slots + 1, dtype=np.float32)[np.array(slot)[at]]


def page_features(source: pa.Array, lang: pa.Array, n_chars: pa.Array, n_lines: pa.Array) -> np.ndarray:
    """Where the page is from, its language, and its size and layout; a null is a value of its own."""
    chars = pc.fill_null(n_chars, 0).to_numpy(zero_copy_only=False).astype(np.float64)
    lines = pc.fill_null(n_lines, 0).to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = [np.log1p(np.maximum(0, chars)), np.log1p(lines), np.log1p(np.maximum(0, chars) / np.maximum(1, lines))]
    return np.column_stack([*sizes, _one_of(source, SOURCE_SLOTS), _one_of(lang, LANG_SLOTS)]).astype(np.float32)


@dataclass
class Regression:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Regression:
        """Newton steps on standardized features, with a penalty on all weights but the intercept."""
        x = x.astype(np.float64)
        mean, scale = x.mean(0), x.std(0)
        scale[scale < 1e-9] = 1.0
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        weights = np.zeros(z.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
            gradient = z.T @ (p - y) + penalty * weights
            step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), gradient)
            weights -= step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
            if np.abs(step).max() < 1e-6:
                break
        return Regression(mean, scale, weights)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1], -30, 30)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


@dataclass
class CoTrained:
    views: tuple[Regression, Regression]
    calibrations: tuple[Regression, Regression]
    combination: Regression
    threshold: float
    given: tuple[int, int]

    def scores(self, *views: np.ndarray) -> list[np.ndarray]:
        """The calibrated views, and their combination."""
        logits = [c.logit(v.logit(x)[:, None]) for v, c, x in zip(self.views, self.calibrations, views, strict=True)]
        return [1 / (1 + np.exp(-logit)) for logit in logits] + [self.combination.probability(np.column_stack(logits))]


def co_train(views: tuple[np.ndarray, np.ndarray], labels: np.ndarray, calibrates: np.ndarray) -> CoTrained | None:
    """Labels are 0, 1 or NaN. None unless both kinds are among the rows to fit on and among those to calibrate with."""
    known = ~np.isnan(labels)
    held = known & calibrates
    trained = known & ~calibrates
    if any(len(np.unique(labels[rows])) < 2 for rows in (held, trained)):
        return None
    taught = [labels.copy(), labels.copy()]
    usable = [trained.copy(), trained.copy()]
    given = [0, 0]
    for turn in range(ROUNDS + 1):
        models = tuple(Regression.fit(x[rows], y[rows]) for x, rows, y in zip(views, usable, taught, strict=True))
        if turn == ROUNDS:
            break
        for teacher, pupil in ((0, 1), (1, 0)):
            open_rows = np.flatnonzero(~known & ~usable[pupil])
            p = models[teacher].probability(views[teacher][open_rows])
            for kind, sureness in ((1, p), (0, 1 - p)):
                # In proportion to the kind's share of labels, so that the pupil's classes keep their sizes.
                most = int(np.ceil(GIVEN_SHARE * (labels[trained] == kind).sum()))
                chosen = np.argsort(-sureness, kind="stable")[:most]
                chosen = open_rows[chosen[sureness[chosen] >= SURE]]
                taught[pupil][chosen], usable[pupil][chosen] = kind, True
                given[pupil] += len(chosen)
    y = labels[held]
    raw = [model.logit(x[held])[:, None] for model, x in zip(models, views, strict=True)]
    calibrations = tuple(Regression.fit(x, y, CALIBRATION_RIDGE) for x in raw)
    logits = np.column_stack([c.logit(x) for c, x in zip(calibrations, raw, strict=True)])
    combination = Regression.fit(logits, y, CALIBRATION_RIDGE)
    good = np.sort(combination.probability(logits)[y == 1])
    threshold = min(0.5, float(good[int((1 - KEPT_GOOD) * len(good))]) - 1e-9)
    return CoTrained(models, calibrations, combination, threshold, (given[0], given[1]))


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = {name: batch.column(n) for n, name in enumerate(batch.schema.names)}
    page = page_features(column["_source"], column["_lang"], column["_n_chars"], column["_n_lines"])
    return text_features(column["_text"]), page


def _prepared(documents: DataFrame, *kept: Column | str) -> DataFrame:
    """What is kept, and the columns of both views; those that a table lacks are null."""

    def column(name: str, kind: str):
        return (F.col(name) if name in documents.columns else F.lit(None)).cast(kind).alias(f"_{name}")

    text = column("text", "string")
    lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("_n_lines")
    return documents.select(*kept, text, column("source", "string"), column("lang", "string"), column("n_chars", "long"), lines)


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id") -> CoTrained | None:
    """Fit on about ``sample`` documents with a label and as many without, each chosen by a fixed part of their ids' hashes.

    Labels that are null or contradict each other are left out. Ids that are null take no part. Only ids meet the labels;
    texts meet the ids that are chosen.
    """
    rows = documents.where(F.col(id_column).isNotNull())
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    known = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").alias("_quality"), F.max("quality").alias("_most"))
    known = known.where("_quality = _most").select("_id", F.col("_quality").cast("double").alias("_quality"))
    ids = rows.select(F.col(id_column).cast("long").alias("_id")).join(known, "_id", "left")
    counts = {row.labelled: row.n for row in ids.groupBy(F.col("_quality").isNotNull().alias("labelled")).agg(F.count(F.lit(1)).alias("n")).collect()}
    hashed = F.pmod(F.xxhash64("_id"), F.lit(1 << 40))
    columns = [F.col(id_column).cast("long").alias("_id"), *[c for c in ("text", "source", "lang", "n_chars") if c in documents.columns]]
    calibrates = (F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(CALIBRATION)) == 0).alias("_calibrates")

    def chosen(labelled: bool) -> DataFrame:
        share = min(1.0, sample / max(1, counts.get(labelled, 0)))
        some = ids.where((F.col("_quality").isNotNull() == labelled) & (hashed < int(share * (1 << 40)))).dropDuplicates(["_id"])
        found = rows.select(columns).join(F.broadcast(some), "_id")  # about sample ids
        # Of rows that repeat an id, the least, so that no order of tasks decides; repeats go before they move.
        one = F.min(F.struct(*[c for c in found.columns if c != "_id"])).alias("one")
        found = found.groupBy("_id").agg(one).select("_id", "one.*")
        return _prepared(found, "_id", "_quality").withColumn("_calibrates", calibrates)

    names = ["_id", "_quality", "_calibrates", "_text", "_source", "_lang", "_n_chars", "_n_lines"]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, page = _views(batch)
            lists = [pa.array(list(x), pa.list_(pa.float32())) for x in (text, page)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in range(3)), *lists], ["id", "quality", "calibrates", "text", "page"])

    schema = "id long, quality double, calibrates boolean, text array<float>, page array<float>"
    found = [chosen(labelled).select(names).mapInArrow(features, schema).toArrow() for labelled in (True, False)]
    found = pa.concat_tables(found)
    if not found.num_rows:
        return None
    order = np.argsort(found.column("id").to_numpy(), kind="stable")
    views = tuple(np.stack(found.column(name).to_numpy())[order] for name in ("text", "page"))
    quality = found.column("quality").to_numpy()[order].astype(np.float64)
    calibrates = found.column("calibrates").to_numpy()[order].astype(bool)
    del found
    pa.default_memory_pool().release_unused()
    return co_train(views, quality, calibrates)


def score(documents: DataFrame, model: CoTrained | None, carried: list[str] | None = None) -> DataFrame:
    """The documents with ``text_score``, ``page_score``, ``score`` (all 0.5 without a model) and ``kept``; replaced if present.

    ``carried`` names the columns to keep, all by default. One pass, without a shuffle. A null text scores as an empty one.
    """
    added = ("text_score", "page_score", "score", "kept")
    others = [name for name in (carried or documents.columns) if name not in added]
    prepared = _prepared(documents, whole_row(others, "_row"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            if fitted is None:
                scores = [np.full(batch.num_rows, 0.5)] * 3
            else:
                scores = fitted.scores(*_views(batch))
            kept = scores[2] >= (fitted.threshold if fitted else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, scores), pa.array(kept)], ["_row", *added])

    schema = StructType([prepared.schema["_row"], *[StructField(name, DoubleType()) for name in added[:3]], StructField("kept", BooleanType())])
    return prepared.mapInArrow(apply, schema).select(*fields_of("_row", others), *added)


def classify(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, carried: list[str] | None = None) -> DataFrame:
    """Fit on bounded samples and score all documents; see :func:`fit` and :func:`score`.

    Columns used: doc_id, text, source, lang, n_chars; of labels: doc_id, quality. Rows with null or repeated ids are scored
    as any. Without labels of both kinds, every document scores 0.5 and is kept.
    """
    return score(documents, fit(documents, labels, sample), carried)
