"""Toxicity by non-negative positive-unlabelled learning.

Known are confirmed toxic texts, and texts of which nothing is known. A text is the
density of its words and word beginnings, hashed. Kept are the places that stand in more of the
confirmed texts than their share of all texts lets expect: counted over every row, with a spread
that no rare word makes zero, near copies among the confirmed texts counted once. A logistic
classifier in numpy minimises the non-negative risk estimate
``prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])``, the second mean over
all rows: each step sums their gradients in tasks. Those sums are of whole numbers, so that the
model does not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.arrow import map_batches
from hearthline.llm.tokens import LOWER, Piece, mix, pieces, shingles, span_hashes, words
from hearthline.llm.vectors import merged_state, task_states
from hearthline.scratch import drop, materialize

PLACES = 1 << 18
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes
MIN_Z, PRIOR_SPREAD = 3.5, 2.0  # as if so many texts more or fewer were common chance
MIN_LIFT = 0.25  # of the way from a word of all texts to a word of toxic texts only
MAX_POSITIVE = 3000  # labelled texts
SATURATION = 50  # one word in so many is as toxic as can be
CORNER = 0.1  # of the prior: over such a width the risk's corner at zero is rounded
DECAY = 0.1  # times the prior, for each confirmed text: a weak belief in small weights
STEPS, MEMORY = 60, 8
UNIT, SLOPE_UNIT = 1 << 12, 1 << 24  # densities and slopes are whole multiples of one in so many
TABLE_ENTRIES = 1 << 20  # densities in one row of the table that is trained on

_WORDS = LOWER.copy()
_WORDS[:128][[not chr(c).isalnum() for c in range(128)]] = 32


class ToxicityModel(NamedTuple):
    places: np.ndarray
    weights: np.ndarray
    bias: float


class Rows(NamedTuple):
    """Densities of the kept places, as whole multiples of 1 / UNIT; rows without any are only counted."""

    n: int
    starts: np.ndarray
    column: np.ndarray
    value: np.ndarray

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        owner = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        return np.bincount(owner, self.value * weights[self.column] / UNIT, len(self.starts) - 1) + bias

    def weighed(self, slope: np.ndarray, n_columns: int) -> np.ndarray:
        """Sums of a whole-numbered slope of each row times its values."""
        out = np.zeros(n_columns, np.int64)
        np.add.at(out, self.column, np.repeat(slope, np.diff(self.starts)) * self.value)
        return out


def word_places(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all words and word beginnings, the text of each, and the texts' word counts."""
    piece = piece._replace(data=_WORDS[piece.data])
    found = words(piece)
    owner, length = found.owners, found.end - found.begin
    hashes, owners = [span_hashes(piece.data, found.begin, found.end)], [owner]
    for n in BEGINNINGS:
        longer = length > n
        begin = found.begin[longer]
        hashes.append(mix(span_hashes(piece.data, begin, begin + n) + np.uint64(n)))
        owners.append(owner[longer])
    places = (np.concatenate(hashes) >> np.uint64(40)).astype(np.int64) % PLACES
    return places, np.concatenate(owners), np.diff(found.offsets)


def densities(piece: Piece, column: np.ndarray) -> Rows:
    """Of every text of a piece; ``column`` is the number of a kept place, -1 for others. Empty rows included."""
    place, owner, n_words = word_places(piece)
    at = column[place]
    kept = at >= 0
    width = max(1, int(column.max()) + 1)
    key, count = np.unique(owner[kept] * width + at[kept], return_counts=True)
    row = key // width
    density = np.minimum(1, count * SATURATION / np.maximum(n_words[row], SATURATION))
    value = np.rint(np.sqrt(density) * UNIT).astype(np.int64)
    return Rows(piece.rows, np.searchsorted(row, np.arange(piece.rows + 1)), key % width, value)


def column_of(places: np.ndarray) -> np.ndarray:
    column = np.full(PLACES, -1, np.int64)
    column[places] = np.arange(len(places))
    return column


def place_counts(texts: DataFrame) -> tuple[float, np.ndarray]:
    """Weight of all texts, and of those that hold each place; of text and, if there is a second column, weight."""

    def state(batches):
        total, sums = 0.0, np.zeros(PLACES)
        for batch in batches:
            weight = batch.column(1).to_numpy(zero_copy_only=False) if batch.num_columns > 1 else np.ones(batch.num_rows)
            total += float(weight.sum())
            for piece in pieces(batch.column(0)):
                place, owner, _ = word_places(piece)
                key = np.unique(owner * PLACES + place)
                sums += np.bincount(key % PLACES, weight[piece.first + key // PLACES], PLACES)
        return np.append(sums, total).tobytes()

    def merge(states):
        return sum(np.frombuffer(s) for s in states).tobytes()

    found = merged_state(task_states(texts, state), merge)
    sums = np.frombuffer(found) if found else np.zeros(PLACES + 1)
    return float(sums[-1]), sums[:-1]


def select_places(toxic: tuple[float, np.ndarray], all_rows: tuple[float, np.ndarray], prior: float) -> np.ndarray:
    """Places of more toxic texts than chance and a slight preference explain."""
    (n_toxic, in_toxic), (n_all, in_all) = toxic, all_rows
    if not n_toxic or not n_all:
        return np.zeros(0, np.int64)
    share = np.minimum(1, in_all / n_all)
    expected = n_toxic * share
    spread = np.sqrt(expected * (1 - share) * (1 + n_toxic / n_all) + PRIOR_SPREAD)
    z = (in_toxic - expected) / spread
    lift = 1 + MIN_LIFT * (1 / max(prior, 1e-9) - 1)
    return np.flatnonzero((np.round(z, 6) >= MIN_Z) & (in_toxic >= lift * expected))


def text_key(batch: pa.RecordBatch) -> Iterator[dict]:
    """The smallest of a text's shingle hashes, which most near copies share."""
    for piece in pieces(batch.column(0)):
        piece = piece._replace(data=_WORDS[piece.data])
        found = words(piece)
        hashes, starts = shingles(span_hashes(piece.data, found.begin, found.end), found.offsets)
        key = np.zeros(piece.rows, np.uint64)
        some = np.diff(starts) > 0
        key[some] = hashes[starts[:-1][some]]  # they are sorted
        yield {"text": batch.column(0).slice(piece.first, piece.rows), "key": key.astype(np.int64)}


def confirmed_texts(docs: DataFrame, known: DataFrame, learn: Column, max_positive: int) -> DataFrame:
    """Up to ``max_positive`` labelled toxic texts, equal rows once: text, weight; near copies share a weight of one."""
    toxic = known.filter("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_positive).select("doc_id")
    rows = docs.filter(learn).select("doc_id", "text").join(F.broadcast(toxic), "doc_id")  # max_positive ids at most
    texts = rows.distinct().orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(max_positive).select("text")
    keyed = map_batches(texts.filter("text IS NOT NULL"), text_key, "text string, key long")
    copies = F.count("*").over(Window.partitionBy("key"))
    return materialize(keyed.select("text", (1 / copies).alias("weight")), "toxicity-confirmed")


def density_table(texts: DataFrame, places: np.ndarray) -> DataFrame:
    """Densities of many rows in each row of a table: n, sizes, columns, values; the texts without any only in n."""
    column = column_of(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, found, entries = 0, [], 0

        def packed():
            sizes, columns, values = (np.concatenate([f[i] for f in found] or [[]]).astype(np.int32) for i in range(3))
            row = {"n": pa.array([n], pa.int64()), "sizes": [sizes.tobytes()], "columns": [columns.tobytes()]}
            return pa.RecordBatch.from_pydict({**row, "values": [values.tobytes()]})

        for batch in batches:
            for piece in pieces(batch.column(0)):
                rows = densities(piece, column)
                sizes = np.diff(rows.starts)
                n += rows.n
                found.append((sizes[sizes > 0], rows.column, rows.value))
                entries += len(rows.column)
                if entries >= TABLE_ENTRIES:
                    yield packed()
                    n, found, entries = 0, [], 0
        if n:
            yield packed()

    return texts.select("text").mapInArrow(run, "n long, sizes binary, columns binary, values binary")


def unpacked(n: int, sizes: bytes, columns: bytes, values: bytes) -> Rows:
    size, column, value = (np.frombuffer(b, np.int32).astype(np.int64) for b in (sizes, columns, values))
    return Rows(n, np.concatenate([[0], np.cumsum(size)]), column, value)


def negative_sums(rows: Rows, theta: np.ndarray) -> np.ndarray:
    """Sums of the loss as non-toxic and of its slopes, as whole multiples of 1 / SLOPE_UNIT (by UNIT for densities)."""
    logits = rows.logits(theta[:-1], theta[-1])
    empty = rows.n - len(logits)
    slope = np.rint(_sigmoid(logits) * SLOPE_UNIT).astype(np.int64)
    alone = np.rint(np.array([np.logaddexp(0, theta[-1]), _sigmoid(theta[-1])]) * SLOPE_UNIT).astype(np.int64) * empty
    loss = np.rint(np.logaddexp(0, logits) * SLOPE_UNIT).astype(np.int64).sum() + alone[0]
    return np.concatenate([[loss], rows.weighed(slope, len(theta) - 1), [slope.sum() + alone[1]]])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def summed_over_tasks(table: DataFrame, theta: np.ndarray) -> np.ndarray:
    """``negative_sums`` of all rows; a task sends one array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = negative_sums(unpacked(*row), theta)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    found = table.mapInArrow(run, "sums binary").collect()
    return sum((np.frombuffer(bytes(r["sums"]), np.int64).astype(object) for r in found), np.zeros(len(theta) + 1, object))


def minimise(
    objective: Callable[[np.ndarray], tuple[float, np.ndarray]], theta: np.ndarray, steps: int = STEPS
) -> np.ndarray:
    """Limited-memory quasi-Newton steps, each halved until the objective falls."""
    value, slope = objective(theta)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(slope).max() < 1e-6:
            return theta
        way, scales = -slope, []
        for moved, turned in reversed(past):
            scales.append(moved @ way / (moved @ turned))
            way = way - scales[-1] * turned
        if past:
            moved, turned = past[-1]
            way = way * (moved @ turned) / (turned @ turned)
        for (moved, turned), scale in zip(past, reversed(scales), strict=True):
            way = way + moved * (scale - turned @ way / (moved @ turned))
        length = 1.0 if past else min(1.0, 1 / np.abs(way).sum())
        for _ in range(8):
            new_value, new_slope = objective(theta + length * way)
            if new_value <= value + 1e-4 * length * (slope @ way):
                break
            length /= 2
        else:
            return theta
        moved, turned = length * way, new_slope - slope
        if moved @ turned > 1e-12 * np.sqrt((moved @ moved) * (turned @ turned)):
            past = [*past, (moved, turned)][-MEMORY:]
        flat = value - new_value < 1e-4 * value
        theta, value, slope = theta + moved, new_value, new_slope
        if flat:
            break
    return theta


def risk(toxic: Rows, n_all: int, sums: Callable[[np.ndarray], np.ndarray], prior: float):
    """The non-negative risk and its slope. Where its second part is negative, the way leads back up from there."""

    decay, width = DECAY * prior / toxic.n, CORNER * prior

    def objective(theta: np.ndarray) -> tuple[float, np.ndarray]:
        unlabelled = sums(theta)
        scale = np.concatenate([[1.0], np.full(len(theta) - 1, 1 / UNIT), [1.0]]) / SLOPE_UNIT / n_all
        unlabelled = unlabelled.astype(float) * scale
        as_plain = negative_sums(toxic, theta).astype(float) * scale * n_all / toxic.n
        # The loss as toxic is that as non-toxic less the logit.
        mean = np.append(toxic.weighed(np.ones(len(toxic.starts) - 1, np.int64), len(theta) - 1) / UNIT / toxic.n, 1.0)
        as_toxic = np.concatenate([[as_plain[0] - mean @ theta], as_plain[1:] - mean])
        rest = unlabelled - prior * as_plain
        corner = float(np.hypot(rest[0], width))
        value = prior * as_toxic[0] + corner + decay / 2 * theta[:-1] @ theta[:-1]
        return float(value), prior * as_toxic[1:] + rest[0] / corner * rest[1:] + decay * np.append(theta[:-1], 0)

    return objective


def train(toxic: Rows, n_all: int, sums: Callable[[np.ndarray], np.ndarray], prior: float, n_columns: int) -> np.ndarray:
    """Weights and bias."""
    start = np.append(np.zeros(n_columns), np.log(prior / (1 - prior)) if prior < 1 else 0.0)
    return minimise(risk(toxic, n_all, sums, prior), start)


def learn_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, max_positive: int) -> ToxicityModel | None:
    known = labels.filter(learn & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg("toxic")).first()[0]
    if not prior:
        return None
    confirmed = confirmed_texts(docs, known, learn, max_positive)
    unlabelled = docs.filter(learn).select("text")
    all_rows = place_counts(unlabelled)
    places = select_places(place_counts(confirmed), all_rows, prior)
    if not len(places):
        drop(confirmed)
        return None
    table = materialize(density_table(unlabelled, places), "toxicity-densities")
    n_all = int(all_rows[0])
    packed = density_table(confirmed.orderBy(F.xxhash64("text"), "text"), places).collect()  # max_positive texts at most
    parts = [unpacked(r["n"], *(bytes(r[c]) for c in ("sizes", "columns", "values"))) for r in packed]
    sizes = np.concatenate([np.diff(p.starts) for p in parts])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    toxic = Rows(sum(p.n for p in parts), starts, *(np.concatenate([p[i] for p in parts]) for i in (2, 3)))
    theta = train(toxic, n_all, lambda theta: summed_over_tasks(table, theta), prior, len(places))
    drop(table)
    drop(confirmed)
    return ToxicityModel(places, theta[:-1], float(theta[-1]))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, learn: Column, max_positive: int = MAX_POSITIVE
) -> DataFrame:
    """Toxicity of every row: doc_id, score, predicted.

    ``labels`` has doc_id and toxic. Learned from are all rows where ``learn`` (on doc_id) holds as
    unlabelled texts, of the labelled toxic ones among them the ``max_positive`` that come first by a
    hash, and the share of toxic labels as class prior. A null or empty text scores as one
    without any telling word. Without toxic rows, or without words that tell them apart, every
    score is 0. Repeated rows each get their row; an empty table gives none. Other columns are
    not read.
    """
    model = learn_toxicity(docs, labels, learn, max_positive)
    column = None if model is None else column_of(model.places)

    def judge(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, texts = batch.columns
        for piece in pieces(texts):
            score = np.zeros(piece.rows)
            if model is not None:
                logits = densities(piece, column).logits(model.weights, model.bias)
                score = np.round(_sigmoid(logits), 9)
            yield {
                "doc_id": ids.slice(piece.first, piece.rows),
                "score": score,
                "predicted": (score >= 0.5).astype(np.int32),
            }

    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(docs.select("doc_id", "text"), judge, f"doc_id {kind}, score double, predicted int")
