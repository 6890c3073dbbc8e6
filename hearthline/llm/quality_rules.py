"""Quality rules: text statistics, and a hashed n-gram log-likelihood ratio.

Words and word pairs, lower-cased, are hashed into a fixed number of buckets. Two
multinomials are estimated with add-one smoothing: the trusted target from all documents
labelled good, the raw corpus from all documents. A document's score is the mean over
its n-grams of log(target / raw), so length does not matter; it is kept if the score
reaches a fixed threshold. Nothing is drawn at random.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.arrow import map_batches
from hearthline.llm.ngram_join import BLOOM_FILTER, settings
from hearthline.llm.tokens import IS_SPACE, LOWER, Piece, Spans, lines, mix, pieces, span_hashes, words

BUCKETS = 1 << 14
THRESHOLD = -0.05
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"  # fixed values
ID_FILTER = BLOOM_FILTER | {  # the largest that Spark makes, of 8 MB
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
}
_PAIR = np.uint64(0xD1342543DE82EF95)
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def ngram_buckets(piece: Piece, found: Spans) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word and word pair, and the text each belongs to."""
    hashes, owner = span_hashes(LOWER[piece.data], found.begin, found.end), found.owners
    pair = owner[1:] == owner[:-1]
    both = np.concatenate([hashes, mix(hashes[:-1] * _PAIR + hashes[1:])[pair]])
    return (both >> np.uint64(40)).astype(np.int64) % BUCKETS, np.concatenate([owner, owner[:-1][pair]])


def per_text(marks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many marks lie in each text."""
    sums = np.concatenate([[0], np.cumsum(marks)])
    return sums[starts[1:]] - sums[starts[:-1]]


def repeated_lines(piece: Piece) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    found = lines(piece)
    word_bytes = np.concatenate([[0], np.cumsum(~IS_SPACE[piece.data])])
    worded = word_bytes[found.end] > word_bytes[found.begin]
    owner = found.owners[worded]
    hashes = span_hashes(piece.data, found.begin[worded], found.end[worded])
    order = np.lexsort((hashes, owner))
    again = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.bincount(owner[order][1:][again], minlength=piece.rows)


def repeated_words(piece: Piece, found: Spans, window: int = 3) -> np.ndarray:
    """Words in windows of ``window`` words that the text has twice or more."""
    hashes, owner = span_hashes(piece.data, found.begin, found.end), found.owners
    n = len(hashes) - window + 1
    if n < 1:
        return np.zeros(piece.rows, np.int64)
    rolled = hashes[:n]
    for k in range(1, window):
        rolled = mix(rolled * _PAIR + hashes[k : n + k])
    at = np.flatnonzero(owner[:n] == owner[window - 1 :])
    at = at[np.lexsort((rolled[at], owner[at]))]
    same = np.zeros(len(at) + 1, bool)
    same[1:-1] = (rolled[at][1:] == rolled[at][:-1]) & (owner[at][1:] == owner[at][:-1])
    often = at[same[:-1] | same[1:]]
    covered = np.zeros(len(hashes), bool)
    for k in range(window):
        covered[often + k] = True
    return np.bincount(owner[covered], minlength=piece.rows)


def corpus_counts(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each bucket in the trusted rows and in all rows; BUCKETS rows reach the driver."""

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        total = np.zeros(BUCKETS, np.int64)
        for piece in pieces(batch.column(0)):
            total += np.bincount(ngram_buckets(piece, words(piece))[0], minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield {"bucket": pa.array(seen, pa.int32()), "n": pa.array(total[seen], pa.int64())}

    def of(rows: DataFrame) -> np.ndarray:
        counts = map_batches(rows.select(text_col), count, "bucket int, n long")
        out = np.zeros(BUCKETS, np.int64)
        for bucket, n in counts.groupBy("bucket").agg(F.sum("n")).collect():
            out[bucket] = n
        return out

    # Spark broadcasts the ids if they are few. Else it drops most other texts by a Bloom filter
    # of the ids before it shuffles, but builds none from an aggregate, so the ids are not made distinct.
    target = docs.select(F.col(id_col).alias("trusted_id"), text_col).join(trusted, "trusted_id", "left_semi")
    with settings(docs.sparkSession, ID_FILTER):
        return of(target), of(docs)


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    def logs(counts):
        return np.log(counts + 1) - np.log(counts.sum() + BUCKETS)

    return logs(target) - logs(raw)


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Statistics, score and verdict of every row.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    score (mean log ratio; 0 for a text without words) and kept.

    ``labels`` has doc_id and quality. The target is counted over all rows with a label that
    says good, once each however often it does; the raw corpus over all rows. Without good
    rows both are the same up to smoothing, and only the base rules decide. Null, empty and
    blank texts have zeros and fail the base rules; repeated rows each get their row; an
    empty table gives none. Other columns of ``docs`` are not read.
    """
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL")
    trusted = good.select(F.col("doc_id").alias("trusted_id"))
    target, raw = corpus_counts(docs, trusted, id_col, text_col)
    ratios = log_ratios(target, raw) if target.sum() else np.zeros(BUCKETS)

    def judge(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, texts = batch.columns
        for piece in pieces(texts):
            found = words(piece)
            n = np.diff(found.offsets)
            chars = ((piece.data & 0xC0) != 0x80) & ~IS_SPACE[piece.data]
            repeated = repeated_words(piece, found)
            buckets, owner = ngram_buckets(piece, found)
            grams = np.bincount(owner, minlength=piece.rows)
            score = np.bincount(owner, ratios[buckets], minlength=piece.rows) / np.maximum(grams, 1)
            failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)
            yield {
                "doc_id": ids.slice(piece.first, piece.rows),
                "n_words": n,
                "word_chars": per_text(chars, piece.starts),
                "n_symbols": per_text(_IS_SYMBOL[piece.data], piece.starts),
                "n_dup_lines": repeated_lines(piece),
                "n_repeat_words": repeated,
                "base_failed": failed,
                "score": score,
                "kept": ~failed & (score >= threshold),
            }

    kind = dict(docs.dtypes)[id_col]
    return map_batches(
        docs.select(id_col, text_col),
        judge,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, score double, kept boolean",
    )
