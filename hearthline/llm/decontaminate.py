"""Benchmark decontamination: block-max WAND over a BM25 index of the test items.

The index holds the items, cut into segments of at most PASSAGE / 2 words. Every
passage of every document (PASSAGE words, each half overlapping the next) is a query; all
segments whose BM25 score reaches a share of the score that the segment gives its own
text are retrieved. As in WAND, a segment's rarest terms are essential: its other terms
together stay below its threshold. Segments are grouped in blocks; the sum of a
passage's block maxima over essential terms, with the most that the others may add,
rules most blocks out, the same sum for each segment most of the rest, and what remains is
scored in full. A retrieved item counts as leaked if both its question and its answer
(its last sentence or sentences) have most of their word trigrams in the document.

A large benchmark is indexed a part at a time. How common a word is, and how long a segment,
is counted over the whole benchmark, so scores do not depend on the parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.tokens import LOWER, Piece, mix, pieces, span_hashes, words
from hearthline.scratch import drop, materialize

PASSAGE = 128
SHARE = 0.5  # of a segment's own score
OVERLAP = 0.6  # of the word trigrams of question and answer, each
GRAM_WORDS = 3
ANSWER_WORDS = 5
MIN_WORDS = 5  # shorter items can't be told from ordinary text
BLOCK = 16  # segments
INDEX_ITEMS, INDEX_BYTES = 20_000, 8 << 20  # about what one index holds at most
FULL_SCORES = 1 << 21  # terms of pairs that are scored at once
K1, B = 1.2, 0.75
_GRAM = np.uint64(0xD1342543DE82EF95)

_WORDS = LOWER.copy()
_WORDS[:128][[not chr(c).isalnum() for c in range(128)]] = 32


class Postings(NamedTuple):
    """For every term, what it adds to which targets."""

    starts: np.ndarray
    target: np.ndarray
    value: np.ndarray

    def expand(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of ``terms`` each posting comes from, its target and its value."""
        n = self.starts[terms + 1] - self.starts[terms]
        row = np.repeat(np.arange(len(terms)), n)
        at = np.repeat(self.starts[terms] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return row, self.target[at], self.value[at]


class Index(NamedTuple):
    vocabulary: np.ndarray  # sorted word hashes
    by_block: Postings  # essential terms, block maxima
    block_rest: np.ndarray  # the most that other terms add in a block
    block_threshold: np.ndarray
    by_segment: Postings  # essential terms
    segment_rest: np.ndarray
    threshold: np.ndarray
    by_term: Postings  # terms and impacts of each segment
    own_score: np.ndarray  # of each segment
    item: np.ndarray  # of each segment
    item_ids: list
    parts: list[list[tuple[int, np.ndarray]]]  # size and hashes of each item's question's and answer's runs

    @property
    def whole(self) -> list[tuple[np.ndarray, np.ndarray]]:
        at = self.by_term.starts
        return [(self.by_term.target[a:b], self.by_term.value[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


class Statistics(NamedTuple):
    """Of all segments of a benchmark, for the words of some of its items."""

    segments: int
    mean_words: float
    words: np.ndarray  # sorted hashes
    with_word: np.ndarray  # segments


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the distinct runs of ``size`` words."""
    n = max(0, len(hashes) - size + 1)
    out = hashes[:n]
    for k in range(1, size):
        out = mix(out * _GRAM + hashes[k : k + n])
    return np.unique(out)


def text_words(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words without punctuation, and where each text's begin."""
    piece = piece._replace(data=_WORDS[piece.data])
    found = words(piece)
    return span_hashes(piece.data, found.begin, found.end), found.offsets


def all_words(texts: Sequence[str]) -> list[np.ndarray]:
    out = []
    for piece in pieces(pc.utf8_lower(pa.array(texts, pa.large_string()))):
        hashes, offsets = text_words(piece)
        out += [hashes[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return out


def question_and_answer(text: str) -> tuple[str, str]:
    """The answer is the last sentence, with those before it until it has ANSWER_WORDS words;
    if that leaves no question, the last third of the words."""
    sentences = [s for s in re.split(r"(?<=[.?!])\s+|\n+", text.strip()) if s.strip()]
    for cut in range(len(sentences) - 1, 0, -1):
        if len(" ".join(sentences[cut:]).split()) >= ANSWER_WORDS:
            return " ".join(sentences[:cut]), " ".join(sentences[cut:])
    found = text.split()
    cut = len(found) - max(1, len(found) // 3)
    return " ".join(found[:cut]), " ".join(found[cut:])


def _postings(n_terms: int, rows: list[tuple[int, int, float]]) -> Postings:
    rows.sort()
    term = np.array([r[0] for r in rows], np.int64)
    return Postings(
        np.searchsorted(term, np.arange(n_terms + 1)),
        np.array([r[1] for r in rows], np.int64),
        np.array([r[2] for r in rows], np.float64),
    )


def item_segments(text_words: np.ndarray, passage: int) -> list[np.ndarray]:
    """An item's words in segments of at most half a passage; none if it is too short."""
    if len(text_words) < MIN_WORDS:
        return []
    return np.array_split(text_words, -(-len(text_words) // (passage // 2)))


def segment_statistics(segments: Sequence[np.ndarray]) -> Statistics:
    found, counts = np.unique(np.concatenate([np.unique(s) for s in segments]), return_counts=True)
    return Statistics(len(segments), sum(map(len, segments)) / len(segments), found, counts)


def build_index(
    items: Sequence[tuple[object, str | None]],
    passage: int = PASSAGE,
    share: float = SHARE,
    statistics: Statistics | None = None,
) -> Index | None:
    """Index of (id, text); None if no item has enough words. ``statistics`` default to those of these items."""
    ids, parts, segments, owner = [], [], [], []
    texts = [(i, t) for i, t in items if t]
    for (item_id, text), found in zip(texts, all_words([t for _, t in texts]), strict=True):
        cut = item_segments(found, passage)
        if not cut:
            continue
        segments += cut
        owner += [len(ids)] * len(cut)
        ids.append(item_id)
        halves = [(max(1, min(GRAM_WORDS, len(w))), w) for w in all_words(question_and_answer(text))]
        parts.append([(size, grams(w, size)) for size, w in halves])
    if not ids:
        return None
    n_segments, mean, known, with_word = statistics or segment_statistics(segments)
    vocabulary = np.unique(np.concatenate(segments))
    df = with_word[np.searchsorted(known, vocabulary)]
    idf = np.log1p((n_segments - df + 0.5) / (df + 0.5))
    whole, threshold, rest, rows = [], [], [], []
    for s, segment in enumerate(segments):
        terms, tf = np.unique(np.searchsorted(vocabulary, segment), return_counts=True)
        impact = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(segment) / mean))
        whole.append((terms, impact))
        threshold.append(share * impact.sum())
        order = np.lexsort((terms, -impact))
        left = impact.sum() - np.cumsum(impact[order])
        essential = order[: int(np.argmax(left < threshold[-1])) + 1]
        rest.append(max(0.0, impact.sum() - impact[essential].sum()))
        rows += [(int(terms[i]), s, float(impact[i])) for i in essential]
    blocks: dict[tuple[int, int], float] = {}
    for term, s, value in rows:
        key = (term, s // BLOCK)
        blocks[key] = max(blocks.get(key, 0.0), value)
    firsts = np.arange(0, len(segments), BLOCK)
    return Index(
        vocabulary,
        _postings(len(vocabulary), [(t, b, v) for (t, b), v in blocks.items()]),
        np.maximum.reduceat(rest, firsts),
        np.minimum.reduceat(threshold, firsts),
        _postings(len(vocabulary), rows),
        np.array(rest),
        np.array(threshold),
        Postings(
            np.concatenate([[0], np.cumsum([len(t) for t, _ in whole])]),
            np.concatenate([t for t, _ in whole]),
            np.concatenate([v for _, v in whole]),
        ),
        np.array([v.sum() for _, v in whole]),
        np.array(owner),
        ids,
        parts,
    )


def _sums(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(key, return_inverse=True)
    return keys, np.bincount(back, value, minlength=len(keys))


def retrieve(index: Index, hashes: np.ndarray, offsets: np.ndarray, passage: int = PASSAGE) -> list[tuple[int, int, float]]:
    """(text, segment, score) of every passage and segment at or above its threshold."""
    slack = 1e-9
    step = passage // 2
    n = np.diff(offsets)
    first = np.concatenate([[0], np.cumsum(-(-n // step))])  # passages before each text
    term = np.searchsorted(index.vocabulary, hashes)
    term[term == len(index.vocabulary)] = 0
    known = index.vocabulary[term] == hashes
    essential = np.diff(index.by_block.starts) > 0
    at = np.flatnonzero(known & essential[term])
    owner = np.searchsorted(offsets, at, "right") - 1
    part = first[owner] + (at - offsets[owner]) // step
    earlier = part > first[owner]
    n_terms = len(index.vocabulary)
    # Words lie in the passage that begins in their half and in the one before.
    pair = np.unique(np.concatenate([part * n_terms + term[at], ((part - 1) * n_terms + term[at])[earlier]]))
    query, term_of = pair // n_terms, pair % n_terms
    n_blocks, n_segments = len(index.block_rest), len(index.threshold)
    row, block, value = index.by_block.expand(term_of)
    key, bound = _sums(query[row] * n_blocks + block, value)
    key = key[bound + index.block_rest[key % n_blocks] >= index.block_threshold[key % n_blocks] - slack]
    if not len(key):
        return []
    hit = np.isin(query, key // n_blocks)
    query, term_of = query[hit], term_of[hit]
    row, segment, value = index.by_segment.expand(term_of)
    kept = np.isin(query[row] * n_blocks + segment // BLOCK, key)
    key, bound = _sums((query[row] * n_segments + segment)[kept], value[kept])
    key = key[bound + index.segment_rest[key % n_segments] >= index.threshold[key % n_segments] - slack]
    passage_id, s = key // n_segments, key % n_segments
    # The words, essential or not, of the passages that are left.
    wanted = np.zeros(int(first[-1]) + 1, bool)
    wanted[passage_id] = True
    at = np.flatnonzero(known)
    owner = np.searchsorted(offsets, at, "right") - 1
    part = first[owner] + (at - offsets[owner]) // step
    earlier = (part > first[owner]) & wanted[part - 1]
    here = wanted[part]
    has = np.unique(np.concatenate([(part * n_terms + term[at])[here], ((part - 1) * n_terms + term[at])[earlier]]))
    score = np.zeros(len(key))
    size = np.cumsum(np.diff(index.by_term.starts)[s])
    low = 0
    while low < len(key):
        before = size[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(size, before + FULL_SCORES, "right")))
        row, of_segment, impact = index.by_term.expand(s[low:high])
        asked = passage_id[low:high][row] * n_terms + of_segment
        there = has[np.minimum(np.searchsorted(has, asked), len(has) - 1)] == asked
        score[low:high] = np.bincount(row[there], impact[there], high - low)
        low = high
    found = np.flatnonzero(score >= index.threshold[s] - slack)
    text = np.searchsorted(first, passage_id[found], "right") - 1
    return list(zip(text.tolist(), s[found].tolist(), score[found].tolist(), strict=True))


def leaks(index: Index, piece: Piece, overlap: float = OVERLAP) -> list[tuple[int, int, float, float, float]]:
    """(text, item, share of the segment's own score, question overlap, answer overlap) of leaked items."""
    hashes, offsets = text_words(piece)
    best: dict[tuple[int, int], float] = {}
    for text, s, score in retrieve(index, hashes, offsets):
        key = (text, int(index.item[s]))
        best[key] = max(best.get(key, 0.0), score / float(index.own_score[s]))
    out, of, seen = [], None, {}
    for (text, item), score in sorted(best.items()):
        if of != text:
            of, seen = text, {}
        both = []
        for size, part in index.parts[item]:
            if size not in seen:
                seen[size] = grams(hashes[offsets[text] : offsets[text + 1]], size)
            both.append(float(np.isin(part, seen[size]).mean()) if len(part) else 1.0)
        question, answer = both
        if question >= overlap and answer >= overlap:
            out.append((text, item, score, question, answer))
    return out


def _benchmark_statistics(items: DataFrame, part: DataFrame, passage: int) -> Statistics:
    """Of the segments of all ``items``, for the words of ``part``, which reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments = [s for found in all_words(batch.column(0).to_pylist()) for s in item_segments(found, passage)]
            if segments:
                word = np.concatenate([np.unique(s) for s in segments])
                # A word of null has the number of segments and of words.
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array([None, *word.view(np.int64).tolist()], pa.int64()),
                        "n": np.append(len(segments), np.ones(len(word), np.int64)),
                        "words": np.append(sum(map(len, segments)), np.zeros(len(word), np.int64)),
                    }
                )

    counts = [
        x.select("text").mapInArrow(count, "word long, n long, words long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
        for x in (items, part)
    ]
    known = counts[0].join(counts[1].select(F.col("word").alias("mine")), F.col("word").eqNullSafe(F.col("mine")))
    rows = known.select("word", "n", "words").collect()
    total = next(r for r in rows if r["word"] is None)
    words_of = np.array([r["word"] for r in rows if r["word"] is not None], np.int64).view(np.uint64)
    with_word = np.array([r["n"] for r in rows if r["word"] is not None], np.int64)
    order = np.argsort(words_of)
    return Statistics(total["n"], total["words"] / total["n"], words_of[order], with_word[order])


def indexes(benchmark: DataFrame, index_items: int, index_bytes: int) -> tuple[int, Iterator[Index]]:
    """How many indexes there are, and one after another; their items are named by the digest of their text.

    Distinct texts are dealt to them by a hash, so many that one holds about ``index_items``
    items and ``index_bytes`` of text at most.
    """
    items = benchmark.select("text").filter(F.col("text").isNotNull()).distinct()
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n_blocks = max(1, -(-count // index_items), -(-size // index_bytes))

    def build() -> Iterator[Index]:
        for i in range(n_blocks):
            part = items.filter(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == i)
            rows = sorted((r[0], r[1]) for r in part.select(_digest(), "text").collect())
            if all(len(found) < MIN_WORDS for found in all_words([t for _, t in rows])):
                continue
            statistics = _benchmark_statistics(items, part, PASSAGE) if n_blocks > 1 else None
            yield build_index(rows, statistics=statistics)

    return n_blocks, build()


def _digest():
    return F.sha2("text", 256).alias("item")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    index_items: int = INDEX_ITEMS,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """Leaked items of every row: doc_id, item_id, score, question_overlap, answer_overlap.

    Score is the best passage's share of the score that the item's segment gives its own text.
    Texts are read whole, whatever their length. Null and empty texts leak nothing, items that
    are null or shorter than MIN_WORDS words are never leaked, items with equal texts are each
    reported, and so is every repeated row. Without documents or items there are no rows. Other
    columns are not read. An index is what the driver and a task hold besides texts; where there
    are more, the leaks of one are written before the next is built, and every document is read
    for each.
    """
    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, item string, score double, question_overlap double, answer_overlap double"

    def search(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(pc.utf8_lower(batch.column(1))):
                    found = leaks(index, piece)
                    rows = pa.array([piece.first + f[0] for f in found], pa.int64())
                    columns = {
                        "doc_id": batch.column(0).take(rows),
                        "item": pa.array([index.item_ids[f[1]] for f in found], pa.string()),
                    }
                    for k, name in enumerate(("score", "question_overlap", "answer_overlap"), 2):
                        columns[name] = pa.array([f[k] for f in found], pa.float64())
                    yield pa.RecordBatch.from_pydict(columns)

        return docs.select(id_col, text_col).mapInArrow(run, schema)

    n_blocks, built = indexes(benchmark, index_items, index_bytes)
    result = None
    for index in built:
        found = search(index)
        if n_blocks > 1:
            found = materialize(found, "leaks")
        result = found if result is None else result.union(found)
    if result is None:
        result = docs.sparkSession.createDataFrame([], schema)
    named = benchmark.select("item_id", _digest())
    return result.join(named, "item").select("doc_id", "item_id", "score", "question_overlap", "answer_overlap")


def remove_leaking(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    index_items: int = INDEX_ITEMS,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """The rows of ``docs``, all columns, that leak no item. Nothing is shuffled.

    Where there is more than one index, what one leaves is written before the next is built.
    """
    at = docs.columns.index(text_col)

    def without(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for piece in pieces(pc.utf8_lower(batch.column(at))):
                    keep[[piece.first + f[0] for f in leaks(index, piece)]] = False
                yield batch.filter(pa.array(keep))

        return run

    n_blocks, built = indexes(benchmark, index_items, index_bytes)
    kept = docs
    for index in built:
        fewer = kept.mapInArrow(without(index), docs.schema)
        if n_blocks > 1:
            fewer = materialize(fewer, "without-leaks")
            if kept is not docs:
                drop(kept)
        kept = fewer
    return kept
