"""Mixing sources to target shares: raking of token weights, then sampling of documents.

Documents are counted by source, language and topic. Iterative proportional fitting scales the cells' tokens until their
sums over each of the three match target shares; a document is sampled with a probability in proportion to the weight of
its cell.

The margin with the most values stays a table, one row for each value with its cells. The factors of the other two are held
by the driver, which needs one sum for each pair of their values from a round: one job, whose sums also tell how far the
targets are met. Where even those pairs are too many, cells and margins are tables all the way.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfledger.llm.common import Stage, fields_of, whole_row
from shelfledger.llm.shingles import runs, word_hashes

LOG = logging.getLogger("shelfledger")
MARGINS = ("source", "lang", "topic")
#: Default targets: shares to this power, scaled to one again. 1 keeps the mix, 0 makes all equal.
TEMPER = 0.7
TOLERANCE, MAX_ROUNDS = 1e-3, 30
KEPT_TOKENS = 0.8
SEED = 17
TOPICS, WORD_SLOTS, TOPIC_SAMPLE, TOPIC_STEPS = 6, 64, 10_000, 20
#: Passes end when no number of a centre moves by so much. Sums are added in units of 1 / SUM_UNITS.
TOPIC_MOVE, SUM_UNITS = 1e-4, 1 << 30
ROUND_UNITS = 1 << 20
STEPS_PER_OCTAVE = 64
#: Pairs of values of the two smaller margins that the driver may hold.
HELD_PAIRS, HELD_ROUNDS = 1 << 20, 100
OUTPUTS = ("m_source", "m_lang", "m_topic", "m_tokens", "m_probability", "m_weight", "m_sampled")


def word_shares(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of words of each text, and the square roots of its words' shares by hash (rows of length 1, or 0)."""
    counts, shares = [], []
    for run, begins in runs(texts):
        starts, words = word_hashes(run)
        owner = np.searchsorted(begins, starts, "right") - 1
        slots = owner * WORD_SLOTS + (words % np.uint64(WORD_SLOTS)).astype(np.int64)
        by_slot = np.bincount(slots, minlength=len(begins) * WORD_SLOTS).reshape(-1, WORD_SLOTS)
        total = by_slot.sum(1)
        counts.append(total)
        shares.append(np.sqrt(by_slot / np.maximum(1, total)[:, None]))
    if not counts:
        return np.empty(0, np.int64), np.empty((0, WORD_SLOTS))
    return np.concatenate(counts), np.concatenate(shares)


def vectors_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The vectors that were written as bytes, which Spark passes on whole, not number by number."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, WORD_SLOTS)


def first_centres(shares: DataFrame, n: int, topics: int, sample: int) -> np.ndarray:
    """Points of a bounded sample, by their hashes, that lie far from each other, then moved to the middle of their own."""
    part = F.col("at") < int(min(1.0, sample / n) * (1 << 40))
    found = shares.where(part).limit(2 * sample).toArrow()
    if not found.num_rows:
        found = shares.limit(1).toArrow()
    points = vectors_of(found.column("shares"))[np.argsort(found.column("at").to_numpy(), kind="stable")]
    del found
    pa.default_memory_pool().release_unused()
    centres = points[:1]
    while len(centres) < topics:  # the point furthest from all centres so far
        centres = np.vstack([centres, points[np.argmin((points @ centres.T).max(1))]])
    for _ in range(TOPIC_STEPS):
        centres = moved(centres, *sums_by_centre(points, centres))
    return centres


def sums_by_centre(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the points nearest to each centre, and their number."""
    nearest = (points @ centres.T).argmax(1)
    return np.stack([points[nearest == n].sum(0) for n in range(len(centres))]), np.bincount(nearest, minlength=len(centres))


def moved(centres: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The directions of the sums; a centre without points stays."""
    sums = np.where(counts[:, None] > 0, sums, centres)
    return sums / np.maximum(1e-12, np.linalg.norm(sums, axis=1))[:, None]


def margins(documents: DataFrame) -> list[Column]:
    """Source and language; the empty text where they are null or the column is missing."""
    return [
        F.coalesce(F.col(name).cast("string") if name in documents.columns else F.lit(None), F.lit("")).alias(f"m_{name}")
        for name in MARGINS[:2]
    ]


def word_points(documents: DataFrame) -> DataFrame:
    """``at`` (a hash of the id), the margins, the number of words and their shares, of every document, written once."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, shares = word_shares(batch.column(3))
            found = [pa.array(counts, pa.int64()), pa.array([row.tobytes() for row in shares.astype(np.float32)], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *found], ["at", "m_source", "m_lang", "m_tokens", "shares"])

    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("at")
    rows = documents.select(hashed, *margins(documents), F.col("text").cast("string").alias("text"))
    schema = "at long, m_source string, m_lang string, m_tokens long, shares binary"
    return Stage(documents.sparkSession)(rows.mapInArrow(vectors, schema))


def topics_of(shares: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre, the first of equally near ones; shares as they were written, so that every pass finds the same."""
    return np.round(shares.astype(np.float32).astype(np.float64) @ centres.T, 9).argmax(1) if len(shares) else np.empty(0, np.int64)


def topic_centres(documents: DataFrame, topics: int = TOPICS, sample: int = TOPIC_SAMPLE) -> np.ndarray:
    return centres_of(word_points(documents), topics, sample)


def centres_of(points: DataFrame, topics: int = TOPICS, sample: int = TOPIC_SAMPLE) -> np.ndarray:
    """Centres of topics: begun on a bounded sample, then moved by passes over all documents until they stay.

    There are TOPIC_STEPS passes at most. A pass brings the driver one row of sums for each centre.
    """
    spark = points.sparkSession
    n = points.count()
    if not n:
        return np.zeros((1, WORD_SLOTS))
    centres = first_centres(points.select("at", "shares"), n, topics, sample)
    shares = points.select("shares")
    for _ in range(TOPIC_STEPS):
        shared = spark.sparkContext.broadcast(centres)

        def sums(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            totals, counts = np.zeros(shared.value.shape), np.zeros(len(shared.value), np.int64)
            for batch in batches:
                more = sums_by_centre(vectors_of(batch.column(0)).astype(np.float64), shared.value)
                totals, counts = totals + more[0], counts + more[1]
            columns = [pa.array(np.arange(len(counts)), pa.int32()), pa.array(counts), pa.array(list(totals), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["centre", "n", "sums"])

        found = shares.mapInArrow(sums, "centre int, n long, sums array<double>").select("centre", "n", F.posexplode("sums").alias("slot", "sum"))
        # Summed as whole numbers, so that the order of tasks changes nothing.
        found = found.groupBy("centre", "slot").agg(F.sum("n").alias("n"), F.sum(F.round(F.col("sum") * SUM_UNITS).cast("decimal(38,0)")).alias("sum"))
        totals, counts = np.zeros(centres.shape), np.zeros(len(centres), np.int64)
        for row in found.collect():
            totals[row.centre, row.slot], counts[row.centre] = float(row.sum) / SUM_UNITS, row.n
        shared.unpersist()
        before, centres = centres, moved(centres, totals, counts)
        if np.abs(centres - before).max() < TOPIC_MOVE:
            break
    return centres


def counted_cells(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """Tokens by source, language and topic, from the shares that are written."""
    shared = points.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            topics = topics_of(vectors_of(batch.column(3)), shared.value)
            names = pa.array([f"topic{n}" for n in topics.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], names], ["m_source", "m_lang", "m_tokens", "m_topic"])

    rows = points.select("m_source", "m_lang", "m_tokens", "shares")
    rows = rows.mapInArrow(assign, "m_source string, m_lang string, m_tokens long, m_topic string")
    return rows.groupBy(*(f"m_{name}" for name in MARGINS)).agg(F.sum("m_tokens").alias("tokens"))


def with_topics(documents: DataFrame, centres: np.ndarray, kept: list[str]) -> DataFrame:
    """``m_row`` with the columns to keep, ``m_id``, the three margins and the number of words."""
    shared = documents.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, shares = word_shares(batch.column(0))
            found = [pa.array([f"topic{n}" for n in topics_of(shares, shared.value).tolist()], pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *found], [*batch.schema.names[1:], "m_topic", "m_tokens"])

    text, own = F.col("text").cast("string").alias("m_text"), F.col("doc_id").alias("m_id")
    rows = documents.select(text, whole_row(kept, "m_row"), own, *margins(documents))
    schema = StructType([*rows.schema.fields[1:], StructField("m_topic", StringType()), StructField("m_tokens", LongType())])
    return rows.mapInArrow(assign, schema)


def tempered(cells: DataFrame, margin: str, power: float = TEMPER) -> DataFrame:
    """``value`` and ``share``: the margin's shares of tokens to a power, scaled to one."""
    sums = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").alias("tokens"))
    sums = sums.where("tokens > 0").withColumn("mass", F.pow("tokens", F.lit(power)))
    mass = sums.agg(F.sum("mass")).first()[0]
    return sums.select("value", (F.col("mass") / F.lit(mass)).alias("share"))


def rake(
    cells: DataFrame,
    targets: dict[str, DataFrame],
    stage: Stage,
    tolerance: float = TOLERANCE,
    max_rounds: int = MAX_ROUNDS,
    held_pairs: int = HELD_PAIRS,
) -> DataFrame:
    """Scale ``weight``, at first the cell's ``tokens``, until its sums match the target shares of all tokens.

    A value without a target, or a target of zero, gives weight 0; a target for a value without tokens cannot be met and is
    left out. Ends when every sum is within ``tolerance`` of its target, by its ratio, or after ``max_rounds``, then with a
    warning.
    """
    names = list(targets)
    counts = cells.agg(F.sum("tokens").alias("tokens"), *[F.count_distinct(name).alias(name) for name in names]).first()
    long, *held = sorted(names, key=lambda name: -counts[name])
    total = float(counts["tokens"] or 0)
    if not total:
        return cells.withColumn("weight", F.col("tokens").cast("double"))
    if counts[held[0]] * counts[held[1]] > held_pairs:
        return rake_tables(cells, targets, stage, tolerance, max_rounds)
    # At most HELD_PAIRS values of each of the two.
    values = [[row[0] for row in cells.select(name).distinct().orderBy(name).collect()] for name in held]
    shares = [{row["value"]: row["share"] for row in targets[name].collect()} for name in held]
    wanted = [np.array([shares[n].get(value) or 0.0 for value in values[n]]) * total for n in range(2)]
    places = [{value: at for at, value in enumerate(found)} for found in values]
    shared = cells.sparkSession.sparkContext.broadcast(places)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = shared.value
        for batch in batches:
            pairs = [left[a] * len(right) + right[b] for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pairs, pa.int64()), batch.column(3)], ["value", "pair", "tokens"])

    rows = cells.select(F.col(long).alias("value"), *held, "tokens").mapInArrow(numbered, "value string, pair long, tokens long")
    rows = rows.groupBy("value").agg(F.collect_list(F.struct("pair", "tokens")).alias("cells"))
    rows = stage(rows.join(targets[long].select("value", "share"), "value", "left").select(
        "value", (F.coalesce("share", F.lit(0.0)) * total).alias("wanted"), "cells.pair", "cells.tokens"
    ))
    shape = (len(values[0]), len(values[1]))
    factors, before, met = [np.ones(n) for n in shape], None, False
    for _ in range(max_rounds):
        sums, off = pair_sums(rows, np.outer(*factors).ravel(), before, stage)
        if before is not None and off <= tolerance and _off(margin_sums(held_sums, factors), wanted) <= tolerance:
            met = True
            break
        held_sums, before = sums.reshape(shape), np.outer(*factors).ravel()
        for _ in range(HELD_ROUNDS):  # these two are fitted to each other without a job
            for n in range(2):
                at = margin_sums(held_sums, factors, n)
                factors[n] = factors[n] * np.divide(wanted[n], at, out=np.zeros(shape[n]), where=at > 0)
            if _off(margin_sums(held_sums, factors), wanted) <= tolerance / 10:
                break
    if not met:
        LOG.warning("target shares are not met within %s after %s rounds", tolerance, max_rounds)
    return weighted(rows, np.outer(*factors).ravel(), before, values, long, held)


def margin_sums(sums: np.ndarray, factors: list[np.ndarray], only: int | None = None):
    """Weights by the value of each held margin. ``sums`` has the tokens of its pairs, times the factors of the long margin."""
    found = [(sums * np.outer(*factors)).sum(1 - n) for n in range(2)]
    return found if only is None else found[only]


def _off(sums: list[np.ndarray], wanted: list[np.ndarray]) -> float:
    """How far sums are from their targets, by their ratio; values without tokens cannot meet theirs."""
    there = [(s > 0) & (w > 0) for s, w in zip(sums, wanted, strict=True)]
    return max((float(np.abs(s[t] / w[t] - 1).max()) for s, w, t in zip(sums, wanted, there, strict=True) if t.any()), default=0.0)


def _row_sums(batch: pa.RecordBatch, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pair, tokens and owner of each cell, and the sum over each row's cells of tokens times the factor of their pair."""
    lists = batch.column("pair")
    pair, tokens = lists.flatten().to_numpy(), batch.column("tokens").flatten().to_numpy().astype(np.float64)
    owner = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(lists).to_numpy())
    return pair, tokens, owner, np.bincount(owner, tokens * factors[pair], batch.num_rows)


def _scaled(wanted: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return np.divide(wanted, sums, out=np.zeros(len(sums)), where=sums > 0)


def pair_sums(rows: DataFrame, factors: np.ndarray, before: np.ndarray | None, stage: Stage) -> tuple[np.ndarray, float]:
    """One round over the long margin: its new factors times the tokens, summed by pair of the others' values.

    Also how far its sums are from their targets with the factors that it had for those ``before``.
    """
    shared = rows.sparkSession.sparkContext.broadcast((factors, before))  # at most HELD_PAIRS numbers each

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, then = shared.value
        totals, off = np.zeros(len(now)), 0.0
        for batch in batches:
            wanted = batch.column("wanted").to_numpy()
            pair, tokens, owner, sums = _row_sums(batch, now)
            totals += np.bincount(pair, tokens * _scaled(wanted, sums)[owner], len(now))
            if then is not None:
                held = _scaled(wanted, _row_sums(batch, then)[3]) * sums
                off = max(off, _off([held], [wanted]))
        seen = np.flatnonzero(totals)
        columns = [pa.array(np.append(seen, -1), pa.int64()), pa.array(np.append(totals[seen], off))]
        yield pa.RecordBatch.from_arrays(columns, ["pair", "sum"])

    found = rows.mapInArrow(add, "pair long, sum double")
    # Summed as whole numbers, so that the order of tasks changes nothing.
    units = F.round(F.col("sum") * ROUND_UNITS).cast("decimal(38,0)")
    found = found.groupBy("pair").agg(F.sum(units).alias("units"), F.max("sum").alias("most"))
    sums, off = np.zeros(len(factors)), 0.0
    for row in found.collect():
        if row.pair < 0:
            off = row.most
        else:
            sums[row.pair] = float(row.units) / ROUND_UNITS
    shared.unpersist()
    return sums, off


def weighted(
    rows: DataFrame, factors: np.ndarray, before: np.ndarray, values: list[list[str]], long: str, held: list[str]
) -> DataFrame:
    """The cells with their weights: the long margin's factors are those of its last round."""
    shared = rows.sparkSession.sparkContext.broadcast((factors, before, values))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, then, names = shared.value
        for batch in batches:
            pair, tokens, owner, sums = _row_sums(batch, then)
            weights = tokens * now[pair] * _scaled(batch.column("wanted").to_numpy(), sums)[owner]
            columns = [batch.column("value").take(pa.array(owner)), pa.array([names[0][n] for n in (pair // len(names[1])).tolist()], pa.string())]
            columns += [pa.array([names[1][n] for n in (pair % len(names[1])).tolist()], pa.string()), pa.array(tokens.astype(np.int64)), pa.array(weights)]
            yield pa.RecordBatch.from_arrays(columns, [long, *held, "tokens", "weight"])

    schema = f"{long} string, {held[0]} string, {held[1]} string, tokens long, weight double"
    return rows.mapInArrow(weigh, schema)


def rake_tables(
    cells: DataFrame, targets: dict[str, DataFrame], stage: Stage, tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS
) -> DataFrame:
    """As ``rake``, with a table for each margin: three joins and groupings in a round."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    cells = cells.withColumn("weight", F.col("tokens").cast("double"))
    wanted = stage(reduce(DataFrame.union, [shares.select(F.lit(m).alias("margin"), "value", "share") for m, shares in targets.items()]))
    for _ in range(max_rounds if total else 0):
        for margin in targets:
            shares = wanted.where(F.col("margin") == margin)
            sums = cells.groupBy(margin).agg(F.sum("weight").alias("sum")).where("sum > 0")
            scale = sums.join(shares.select(F.col("value").alias(margin), "share"), margin).select(margin, (F.col("share") * total / F.col("sum")).alias("scale"))
            cells = cells.join(scale, margin, "left").withColumn("weight", F.col("weight") * F.coalesce("scale", F.lit(0.0))).drop("scale")
        cells = stage(cells)
        sides = [F.struct(F.lit(margin).alias("margin"), F.col(margin).alias("value")) for margin in targets]
        sums = cells.select("weight", F.inline(F.array(*sides))).groupBy("margin", "value").agg(F.sum("weight").alias("sum"))
        off = sums.where("sum > 0").join(wanted, ["margin", "value"])
        furthest = off.agg(F.max(F.abs(F.col("sum") / (F.col("share") * total) - 1))).first()[0] or 0.0
        if furthest <= tolerance:
            break
    return cells


def scale_for(cells: DataFrame, kept_tokens: float) -> float:
    """What ratios of weight to tokens are multiplied by, so that this share of all tokens is expected; at most 1 each.

    Cells are summed by the ratio's logarithm, in 64 steps to an octave, so the driver sees a few hundred rows; the expected
    share is met to about one part in a hundred.
    """
    ratio = F.col("weight") / F.col("tokens")
    step = F.round(F.log2(ratio) * STEPS_PER_OCTAVE).cast("int")
    rows = cells.where("tokens > 0 and weight > 0").groupBy(step.alias("step")).agg(F.sum("tokens").alias("tokens")).collect()
    if not rows:
        return 1.0
    ratios = np.exp2(np.array([row.step for row in rows]) / STEPS_PER_OCTAVE)
    tokens = np.array([row.tokens for row in rows], float)
    wanted = kept_tokens * (cells.agg(F.sum("tokens")).first()[0])
    low, high = 0.0, 1.0 / ratios.min()
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (tokens * np.minimum(1, middle * ratios)).sum() < wanted else (low, middle)
    return high


def mix(
    documents: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    kept_tokens: float = KEPT_TOKENS,
    seed: int = SEED,
    carried: list[str] | None = None,
) -> DataFrame:
    """The documents with ``m_source``, ``m_lang``, ``m_topic``, ``m_tokens`` (words), ``m_probability``, ``m_weight``, ``m_sampled``.

    ``targets`` gives for any of source, lang and topic a table of ``value`` and ``share``; tempered shares by default.
    A document is sampled if a hash of its id and the seed falls below its probability, so equal ids fare alike, and a run
    that is repeated gives the same sample. ``m_weight`` is 1 for most; where a probability would exceed 1, it is that
    excess, by which a sampled token counts more. Null source and language are values of their own (the empty text); a null
    or empty text has no tokens, and the ratio 1 if its cell has none. ``carried`` names the columns to keep, all by default;
    any names but those of the seven new columns stay as they are.
    """
    stage = Stage(documents.sparkSession)
    kept = [name for name in (carried or documents.columns) if name not in OUTPUTS]
    points = word_points(documents)
    centres = centres_of(points)
    names = [f"m_{name}" for name in MARGINS]
    cells = stage(counted_cells(points, centres))
    wanted = {f"m_{name}": shares for name, shares in (targets or {}).items()}
    wanted = {name: wanted[name] if name in wanted else tempered(cells, name) for name in names}
    raked = stage(rake(cells, wanted, stage))
    scale = scale_for(raked, kept_tokens)
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(1.0) * scale
    raked = raked.select(*names, F.least(ratio, F.lit(1.0)).alias("m_probability"), F.greatest(ratio, F.lit(1.0)).alias("m_weight"))
    draw = F.pmod(F.xxhash64("m_id", F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    rows = with_topics(documents, centres, kept)
    rows = rows.join(raked, names, "left").withColumn("m_sampled", draw < F.col("m_probability"))
    return rows.select(*fields_of("m_row", kept), *OUTPUTS)
