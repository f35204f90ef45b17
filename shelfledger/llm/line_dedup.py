"""Removal of passages that repeat across documents, by content-defined chunks of lines.

A rolling hash over the hashes of the last lines ends a chunk where it is divisible by ``divisor``; a line of several words is
a chunk of its own. So the same lines give the same chunks wherever they stand, but for short ones at the edges. What is
compared are chunks of several lines or many words, and every two adjacent chunks: units that occur again, by hash and then
byte by byte, are removed but for their first occurrence. So a repeated passage goes as far as its whole chunks reach, also
where each of them is a short line. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfledger.llm.common import Stage, fields_of, whole_row

WINDOW, DIVISOR, FACTOR = 2, 2, 31
MIN_LINES, MIN_WORDS = 2, 50
#: Words of a line that is a chunk by itself.
SOLO_WORDS = 8
KEY = ["key_id", "key_text"]


def keyed(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """A row per document with text: its id, a hash of its text, and the text as bytes."""
    text = F.col(text_column).cast("string")
    rows = documents.where(F.col(text_column).isNotNull())
    return rows.select(F.col(id_column).alias("key_id"), F.xxhash64(text).alias("key_text"), text.alias("text"))


def line_hash(line: Column) -> Column:
    """28 bits, of MD5 so that other engines can compute it."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def chunks(rows: DataFrame, window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """The chunks of each text: number, first byte, bytes, lines, words and a hash that depends on the order of lines.

    ``pair_`` columns say the same of a chunk together with the one that follows it; null for the last.
    """
    line = F.col("line")
    lines = rows.select(*KEY, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).select(
        *KEY,
        "pos",
        line_hash(line.cast("binary")).alias("hash"),
        F.xxhash64(line).alias("content"),
        F.octet_length(line).cast("long").alias("bytes"),
        (F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("long").alias("words"),
    )
    lines = lines.repartition(*KEY).dropDuplicates([*KEY, "pos"])
    in_order = Window.partitionBy(*KEY).orderBy("pos")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    rolled = sum((F.lag("hash", n, 0).over(in_order) * FACTOR**n for n in range(1, window)), F.col("hash"))
    start = F.coalesce(F.sum(F.col("bytes") + 1).over(before), F.lit(0))
    alone = F.col("words") >= SOLO_WORDS
    ends = (rolled % divisor == 0) | alone | F.coalesce(F.lead(alone).over(in_order), F.lit(False))
    lines = lines.withColumns({"ends": ends.cast("int"), "at": start})
    lines = lines.withColumn("chunk", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    inside = Window.partitionBy(*KEY, "chunk").orderBy("pos")
    lines = lines.withColumn("place", F.row_number().over(inside))
    found = lines.groupBy(*KEY, "chunk").agg(
        F.min("at").alias("at"),
        (F.sum(F.col("bytes") + 1) - 1).alias("bytes"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("words").alias("words"),
        F.bit_xor(F.xxhash64("content", "place")).alias("hash"),
    )
    chunk_order = Window.partitionBy(*KEY).orderBy("chunk")
    after = {name: F.lead(name).over(chunk_order) for name in ("bytes", "lines", "words", "hash")}
    return found.select(
        "*",
        (F.col("bytes") + 1 + after["bytes"]).alias("pair_bytes"),
        (F.col("lines") + after["lines"]).alias("pair_lines"),
        (F.col("words") + after["words"]).alias("pair_words"),
        F.when(after["hash"].isNotNull(), F.xxhash64("hash", after["hash"], "bytes", "lines")).alias("pair_hash"),
    )


def units(all_chunks: DataFrame) -> DataFrame:
    """What is compared: each chunk (``span`` 1) and each two adjacent ones (2)."""
    names = ("bytes", "lines", "words", "hash")
    one = F.struct(F.lit(1).alias("span"), *names)
    two = F.struct(F.lit(2).alias("span"), *[F.col(f"pair_{name}").alias(name) for name in names])
    return all_chunks.select(*KEY, "chunk", "at", F.inline(F.array(one, two))).where("hash is not null")


def _null_safe(left: str, right: str, names: list[str]) -> list[Column]:
    return [F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in names]


def _bytes(place: Column) -> Column:
    """These bytes of a text, without reading it from its start."""
    return F.substring(F.col("t.data"), (place["at"] + 1).cast("int"), place["bytes"].cast("int"))


def repeated_chunks(rows: DataFrame, all_chunks: DataFrame, min_lines: int, min_words: int, stage: Stage) -> DataFrame:
    """key_id, key_text, chunk and ``gone`` of those that, alone or with a neighbour, equal an earlier unit byte by byte."""
    counted = units(all_chunks).where((F.col("lines") >= min_lines) | (F.col("words") >= min_words))
    same = ["span", "hash", "bytes", "lines"]
    place = F.struct(F.col("key_id").isNull().alias("unnamed"), "key_id", "key_text", "chunk")
    groups = counted.groupBy(*same).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    groups = groups.where("first <> last").drop("last")
    again = counted.join(groups, same).withColumn("is_first", place.eqNullSafe(F.col("first")))
    again = again.groupBy(*KEY).agg(F.collect_list(F.struct("chunk", "at", *same, "is_first")).alias("places"))
    texts = rows.select(*KEY, F.col("text").cast("binary").alias("data"))
    joined = texts.alias("t").join(again.alias("w"), _null_safe("t", "w", KEY))
    found = F.transform("w.places", lambda p: F.struct(*(p[x].alias(x) for x in ("chunk", *same, "is_first")), _bytes(p).alias("part")))
    found = stage(joined.select("t.key_id", "t.key_text", F.inline(found)))
    firsts = found.where("is_first").select(*same, F.col("part").alias("first_part")).dropDuplicates(same)
    copies = found.where("not is_first").join(firsts, same).where("part = first_part")
    both = F.explode(F.sequence(F.col("chunk"), F.col("chunk") + F.col("span") - 1)).alias("chunk")
    gone = stage(copies.select(*KEY, both).distinct().withColumn("gone", F.lit(True)))
    stage.forget(found)  # it holds the bytes of all that repeats
    return gone


def dedup_lines(
    documents: DataFrame,
    window: int = WINDOW,
    divisor: int = DIVISOR,
    min_lines: int = MIN_LINES,
    min_words: int = MIN_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The documents with repeated chunks removed, and ``n_lines`` and ``n_removed_lines`` (replaced if present).

    A chunk, or two adjacent ones, count if they have at least ``min_lines`` lines, or at least ``min_words`` words (spaces +
    1). Their first occurrence in order of id (null last), hash of the text and place stays; the rest go, also within a text.
    A text of which nothing
    is left is empty. A null text stays null, with 0 lines; an empty one has one line. Rows with equal id and text are one
    document: each is returned, none counts as a copy of the other. Other columns are kept.

    No text is grouped whole: chunks are compared by hash first, and only those that occur again carry their bytes. A chunk
    in very many documents is counted before it moves, and meets its one first occurrence in a join that adaptive
    execution splits. A task holds the lines of one document at most.
    """
    stage = Stage(documents.sparkSession)
    rows = keyed(documents, id_column, text_column)
    all_chunks = stage(chunks(rows, window, divisor))
    gone = repeated_chunks(rows, all_chunks, min_lines, min_words, stage)
    marked = all_chunks.alias("c").join(gone.alias("g"), _null_safe("c", "g", [*KEY, "chunk"]), "left").select("c.*", "gone")
    kept = F.when(F.col("gone").isNull(), F.struct("at", "bytes"))
    by_document = marked.groupBy(*KEY).agg(
        F.sum("lines").alias("n_lines"),
        F.coalesce(F.sum(F.when(F.col("gone"), F.col("lines"))), F.lit(0)).alias("n_removed_lines"),
        F.sort_array(F.collect_list(kept)).alias("kept"),
    )
    untouched = F.col("n_removed_lines") == 0
    by_document = by_document.withColumn("kept", F.when(~untouched, F.col("kept")))
    others = [name for name in documents.columns if name not in ("n_lines", "n_removed_lines")]
    untold = [name for name in others if name != text_column]
    text = F.col(text_column).cast("string")
    keys = [F.col(id_column).alias("key_id"), F.xxhash64(text).alias("key_text"), text.cast("binary").alias("data")]
    joined = documents.select(whole_row(untold, "row"), *keys).alias("t").join(by_document.alias("w"), _null_safe("t", "w", KEY), "left")
    left = F.array_join(F.transform("w.kept", lambda p: _bytes(p).cast("string")), "\n")
    new_text = F.when(F.col("w.kept").isNull(), F.col("t.data").cast("string")).otherwise(left)
    counts = [F.coalesce(f"w.{name}", F.lit(0)).alias(name) for name in ("n_lines", "n_removed_lines")]
    columns = dict(zip(untold, fields_of("row", untold, "t."), strict=True))
    return joined.select(*(new_text.alias(name) if name == text_column else columns[name] for name in others), *counts)


ORACLE_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
), hashed AS (
  SELECT doc_id, pos, line, ('0x' || substr(md5(line), 1, 7))::BIGINT AS hash FROM lines
), worded AS (
  SELECT *, length(line) - length(replace(line, ' ', '')) + 1 AS words FROM hashed
), ended AS (
  SELECT *, (hash + {FACTOR} * lag(hash, 1, 0) OVER (PARTITION BY doc_id ORDER BY pos)) % {DIVISOR} = 0
    OR words >= {SOLO_WORDS} OR coalesce(lead(words) OVER (PARTITION BY doc_id ORDER BY pos) >= {SOLO_WORDS}, false) AS ends
  FROM worded
), placed AS (
  SELECT doc_id, pos, line, words, coalesce(sum(ends::INT) OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
  FROM ended
), chunks AS (
  SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY pos) AS part, count(*) AS lines, sum(words) AS words
  FROM placed GROUP BY doc_id, chunk
), paired AS (
  SELECT *, lead(part) OVER w AS part2, lead(lines) OVER w AS lines2, lead(words) OVER w AS words2
  FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY chunk)
), single AS (
  SELECT *, row_number() OVER (PARTITION BY part, lines ORDER BY doc_id, chunk) > 1
         AND (lines >= {MIN_LINES} OR words >= {MIN_WORDS}) AS again,
         row_number() OVER (PARTITION BY part, lines, part2, lines2 ORDER BY doc_id, chunk) > 1 AND part2 IS NOT NULL
         AND (lines + lines2 >= {MIN_LINES} OR words + words2 >= {MIN_WORDS}) AS pair_again
  FROM paired
), ranked AS (
  SELECT *, again OR pair_again OR coalesce(lag(pair_again) OVER (PARTITION BY doc_id ORDER BY chunk), false) AS gone
  FROM single
), rebuilt AS (
  SELECT doc_id, coalesce(string_agg(part, chr(10) ORDER BY chunk) FILTER (NOT gone), '') AS text,
         sum(lines)::BIGINT AS n_lines, coalesce(sum(lines) FILTER (gone), 0)::BIGINT AS n_removed_lines
  FROM ranked GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN r.text END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_removed_lines, 0) AS n_removed_lines
FROM documents d LEFT JOIN rebuilt r USING (doc_id)
"""
