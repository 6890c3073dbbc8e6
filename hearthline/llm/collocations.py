"""Collocations: frequent word sequences scored against their parts.

Every text is cut into pieces at punctuation and line ends, and each sequence of up to
``max_words`` words of a piece is a gram. Grams are dealt to partitions by their hash. Each
partition merges the tasks' counts in a Misra-Gries summary whose capacity exceeds the
partition's mass divided by the threshold, so no frequent gram is lost. What survives
is marked in a bitmap of fixed size; a second pass over the texts counts the marked grams by their
words. Only that count decides, so neither a hash that two grams share nor a full bitmap
changes a result: both cost counting.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.tokens import LOWER, Piece, Spans, before_end, mix, pieces, span_hashes
from hearthline.scratch import materialize

MAX_WORDS, THRESHOLD, TOP = 3, 10, 2000
COVERED_PERCENT = 50  # of a phrase's occurrences inside one longer phrase
PART_BYTES = 8 << 20  # of text for each hash partition
FLUSH = 1 << 21  # grams that a task collects before it sorts and counts them
BITMAP_BITS = 27  # 2^27 bits, 16 MB; more keep the second pass selective on a larger corpus
NO_LANGUAGE = "und"

_CUTS = np.zeros(256, bool)
_CUTS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAPS = _CUTS.copy()
_GAPS[[0x20, 0x09]] = True
_FIRST, _SECOND = np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5)


class Grams(NamedTuple):
    """Grams of one size in a piece: first and last word, text and two independent hashes."""

    size: int
    first: np.ndarray
    last: np.ndarray
    text: np.ndarray
    key: np.ndarray
    check: np.ndarray


def piece_words(piece: Piece) -> tuple[Spans, np.ndarray]:
    """Words, and for each the number of cuts before it in the piece, texts' beginnings included."""
    gap = _GAPS[piece.data]
    before = np.empty(len(gap) + 1, bool)
    before[0] = True
    before[1:] = gap
    before[piece.starts] = True
    begin = np.flatnonzero(~gap & before[:-1])
    end = np.flatnonzero(~gap & before_end(gap, piece.starts)) + 1
    cuts = np.concatenate([[0], np.cumsum(_CUTS[piece.data])])
    found = Spans(begin, end, np.searchsorted(begin, piece.starts))
    return found, cuts[begin] + found.owners * (len(piece.data) + 1)


def piece_grams(piece: Piece, language: np.ndarray, max_words: int) -> Iterator[Grams]:
    """All grams of a piece; ``language`` is a hash for each text."""
    found, place = piece_words(piece)
    hashes = span_hashes(piece.data, found.begin, found.end)
    owner = found.owners
    key, check = mix(hashes ^ language[owner]), mix(hashes * _SECOND + language[owner])
    first = np.arange(len(hashes))
    for size in range(1, max_words + 1):
        if size > 1:
            together = place[first] == place[np.minimum(first + size - 1, len(hashes) - 1)]
            together &= first + size - 1 < len(hashes)
            first, key, check = first[together], key[together], check[together]
            following = hashes[first + size - 1]
            key, check = mix(key * _FIRST + following), mix((check ^ following) * _SECOND)
        yield Grams(size, first, first + size - 1, owner[first], key, check)


def _languages(column: pa.Array) -> np.ndarray:
    """A hash of each row's language."""
    out = np.zeros(len(column), np.uint64)
    for piece in pieces(column):
        out[piece.first : piece.first + piece.rows] = span_hashes(piece.data, piece.starts[:-1], piece.starts[1:])
    return out


def _lowered(batch: pa.RecordBatch) -> Iterator[tuple[Piece, np.ndarray]]:
    language = _languages(batch.column(0))
    for piece in pieces(batch.column(1)):
        yield piece._replace(data=LOWER[piece.data]), language[piece.first : piece.first + piece.rows]


# --- summaries ------------------------------------------------------------------------------


def _total(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


class Summary:
    """A Misra-Gries summary: every key's true count lies in [count, count + error].

    ``error`` stays below the mass taken in divided by ``capacity`` + 1.
    """

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, error: int = 0) -> Summary:
        """Take in another summary, or plain counts."""
        self.keys, self.counts = _total(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        self.error += error
        if len(self.keys) > self.capacity:
            place = len(self.counts) - self.capacity - 1
            less = int(np.partition(self.counts, place)[place])
            kept = self.counts > less
            self.keys, self.counts = self.keys[kept], self.counts[kept] - less
            self.error += less
        return self

    def frequent(self, threshold: int) -> np.ndarray:
        """All keys with ``threshold`` or more, and some others."""
        return self.keys[self.counts + self.error >= threshold]


def _planes(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte: the high bytes are mostly zero and compress."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def local_counts(docs: DataFrame, parts: int, max_words: int) -> DataFrame:
    """Counts of gram hashes, each task's by hash partition: part, keys, counts, width."""
    shift = np.uint64(64 - (parts.bit_length() - 1))

    def flush(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(np.concatenate(found), return_counts=True)
        part = (keys >> shift).astype(np.int64) if parts > 1 else np.zeros(len(keys), np.int64)
        starts = np.searchsorted(part, np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(starts)):
            mine = slice(starts[p], starts[p + 1])
            width = next(w for w in (1, 2, 4, 8) if counts[mine].max() < 1 << 8 * w)
            row = {
                "part": [int(p)],
                "keys": [_planes(keys[mine])],
                "counts": [counts[mine].astype(f"u{width}").tobytes()],
                "width": pa.array([width], pa.int32()),
            }
            yield pa.RecordBatch.from_pydict(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for batch in batches:
            for piece, language in _lowered(batch):
                for grams in piece_grams(piece, language, max_words):
                    found.append(grams.key)
                    n += len(grams.key)
                if n >= FLUSH:
                    yield from flush(found)
                    found, n = [], 0
        if n:
            yield from flush(found)

    return docs.select("lang", "text").mapInArrow(run, "part long, keys binary, counts binary, width int")


def frequent_bitmap(docs: DataFrame, threshold: int, max_words: int, bits: int) -> np.ndarray:
    """One bit for each value of the first ``bits`` bits of a hash, set for those of all frequent grams."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    wanted = max(-(-size // PART_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = 1 << min(bits - 3, (wanted - 1).bit_length())
    slice_bits = bits - (parts.bit_length() - 1)

    def survivors(table: pa.Table) -> pa.Table:
        """Some PART_BYTES of text by construction, so the rows of a part fit a task."""
        part = table.column("part")[0].as_py()
        widths = table.column("width").to_pylist()
        found = [
            (_unplaned(k), np.frombuffer(c, f"u{w}").astype(np.int64))
            for k, c, w in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist(), widths, strict=True)
        ]
        mass = sum(int(c.sum()) for _, c in found)
        summary, waiting, n = Summary(mass // threshold + 1), [], 0
        for keys, counts in found:
            waiting.append((keys, counts))
            n += len(keys)
            if n >= max(1 << 18, len(summary.keys)):
                summary.merge(*(np.concatenate(c) for c in zip(*waiting, strict=True)))
                waiting, n = [], 0
        if waiting:
            summary.merge(*(np.concatenate(c) for c in zip(*waiting, strict=True)))
        marks = np.zeros(1 << slice_bits, np.uint8)
        places = (summary.frequent(threshold) >> np.uint64(64 - bits)).astype(np.int64)
        marks[places & ((1 << slice_bits) - 1)] = 1
        row = {"part": pa.array([part], pa.int64()), "marks": pa.array([np.packbits(marks).tobytes()], pa.binary())}
        return pa.table(row)

    slices = local_counts(docs, parts, max_words).groupBy("part").applyInArrow(survivors, "part long, marks binary")
    bitmap = np.zeros((parts, 1 << slice_bits >> 3), np.uint8)
    for row in slices.toLocalIterator():  # 2^bits bits in all
        bitmap[row["part"]] = np.frombuffer(bytes(row["marks"]), np.uint8)
    return bitmap.ravel()


# --- exact counts ---------------------------------------------------------------------------


def _phrases(piece: Piece, found: Spans, grams: Grams, some: np.ndarray) -> pa.Array:
    """Words of some grams, joined by single spaces."""
    first, size = grams.first[some], grams.size
    word = (first[:, None] + np.arange(size)).ravel()
    begin, length = found.begin[word], found.end[word] - found.begin[word]
    gap = np.ones(len(word), np.int64)
    gap[size - 1 :: size] = 0  # none after the last word
    ends = np.cumsum(length + gap)
    starts = ends - length - gap
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(starts, length) + inside] = piece.data[np.repeat(begin, length) + inside]
    offsets = np.concatenate([[0], ends[size - 1 :: size]]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())]
    return pa.Array.from_buffers(pa.large_string(), len(some), buffers)


def _distinct(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by both hashes, and where each pair begins in it."""
    order = np.lexsort((check, key))
    k, c = key[order], check[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    return order, np.flatnonzero(new)


def marked_counts(docs: DataFrame, bitmap: np.ndarray, max_words: int, bits: int) -> DataFrame:
    """Counts of the marked grams: lang, phrase, f; a null phrase has the number of words."""
    marks = docs.sparkSession.sparkContext.broadcast(bitmap)  # 2^bits bits

    def merged(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, check, count = (np.concatenate([f[i] for f in found]) for i in range(3))
        order, starts = _distinct(key, check)
        some = pa.array(order[starts])
        columns = {
            "lang": pa.concat_arrays([f[3] for f in found]).take(some).cast(pa.string()),
            "phrase": pa.concat_arrays([f[4] for f in found]).take(some).cast(pa.string()),
            "f": np.add.reduceat(count[order], starts),
        }
        yield pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, found, n = marks.value, [], 0
        n_words: dict[str, int] = {}
        for batch in batches:
            names = batch.column(0).cast(pa.large_string())
            for piece, language in _lowered(batch):
                spans, _ = piece_words(piece)
                for name, words in zip(names.slice(piece.first, piece.rows).to_pylist(), np.diff(spans.offsets), strict=True):
                    n_words[name] = n_words.get(name, 0) + int(words)
                for grams in piece_grams(piece, language, max_words):
                    place = (grams.key >> np.uint64(64 - bits)).astype(np.int64)
                    hit = np.flatnonzero(bitmap[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1)
                    if not len(hit):
                        continue
                    order, starts = _distinct(grams.key[hit], grams.check[hit])
                    one = hit[order[starts]]
                    count = np.diff(np.r_[starts, len(hit)])
                    owners = names.take(pa.array(piece.first + grams.text[one]))
                    found.append((grams.key[one], grams.check[one], count, owners, _phrases(piece, spans, grams, one)))
                    n += len(one)
                if n >= FLUSH >> 4:  # Spark adds up what a task sends
                    yield from merged(found)
                    found, n = [], 0
        if found:
            yield from merged(found)
        if n_words:
            nothing = pa.nulls(len(n_words), pa.string())
            rows = {"lang": list(n_words), "phrase": nothing, "f": pa.array(n_words.values(), pa.int64())}
            yield pa.RecordBatch.from_pydict(rows)

    return docs.select("lang", "text").mapInArrow(run, "lang string, phrase string, f long")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), in 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = F.lit(1_000_000).cast("decimal(7,0)") * wide(a) * wide(a)
    return F.call_function("div", top, wide(left) * wide(right))


def collocations(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    covered_percent: int = COVERED_PERCENT,
    bits: int = BITMAP_BITS,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Phrases have 2 to ``max_words`` words and occur ``threshold`` times or more. Of the ways to
    cut a phrase in two, the lowest score counts, then the shortest first part. A phrase goes if one longer
    frequent phrase holds ``covered_percent`` of its occurrences. Rows come by score, count and
    phrase (bytes of UTF-8). A null language is ``und``, a null or empty text has no words; repeated rows
    count each. No words, or no frequent phrase, give no rows. A text of any length is read whole.
    Other columns are not read.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_col).alias("text")
    )
    bitmap = frequent_bitmap(texts, threshold, max_words, bits)
    counted = marked_counts(texts, bitmap, max_words, bits).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    counts = materialize(counted.filter((F.col("f") >= threshold) | F.col("phrase").isNull()), "collocation-counts")
    totals = counts.filter("phrase IS NULL").select("lang", F.col("f").alias("n"))
    words = F.split("phrase", " ")
    known = counts.filter("phrase IS NOT NULL")
    phrases = known.select("lang", "phrase", F.col("f").alias("a"), words.alias("words")).filter(F.size("words") > 1)
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("rest"),
    )
    # A part occurs at least as often as its phrase, so its count is there.
    lefts = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rights = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(lefts, ["lang", "first"]).join(rights, ["lang", "rest"])
    scored = scored.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    if max_words > 2:
        size = F.size("words")
        inside = F.flatten(
            F.transform(
                F.sequence(F.lit(2), size - 1),
                lambda n: F.transform(
                    F.sequence(F.lit(1), size - n + 1), lambda at: F.array_join(F.slice("words", at, n), " ")
                ),
            )
        )
        longer = phrases.filter(size > 2).select("lang", F.explode(inside).alias("phrase"), F.col("a").alias("longer"))
        most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        best = best.join(most, ["lang", "phrase"], "left")
        best = best.filter(F.coalesce(100 * F.col("longer") < covered_percent * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    # One row for each language.
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
