"""Mix sources to target weights: equal-token blocks, apportioned by Sainte-Laguë.

A source's documents, in a seeded order, are one stream of words cut into blocks of
equal length. Seats (blocks of the mix) go to sources by the highest quotients
``target / 1, target / 3, target / 5 ...``; the method is house monotone, so the seats
of output shard k are those of the first k shards less those of the first k - 1. A
source's blocks are handed out from a seeded start, round and round: shard after shard
takes as many as it has seats. In all that is whole epochs and one run of blocks, so all but
two of a source's documents are taken equally often in all their words.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK_WORDS = 16
OUTPUT_SHARDS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: Sequence[int], weights: Sequence[int], max_epochs: int = MAX_EPOCHS) -> list[float]:
    """Words wanted of each source: shares by weight, none above ``max_epochs`` times its size."""
    capped = [size == 0 for size in sizes]
    while True:
        left = sum(sizes) - sum(max_epochs * s for s, c in zip(sizes, capped, strict=True) if c)
        weight = sum(w for w, c in zip(weights, capped, strict=True) if not c)
        targets = [
            float(max_epochs * s) if c else w * (left / weight)
            for s, w, c in zip(sizes, weights, capped, strict=True)
        ]
        over = [not c and t > max_epochs * s for t, s, c in zip(targets, sizes, capped, strict=True)]
        if not any(over):
            return targets
        capped = [c or o for c, o in zip(capped, over, strict=True)]


def apportion(targets: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Sainte-Laguë: ``seats`` by highest quotient, at most ``most`` each; earlier sources win ties."""
    target, most = np.asarray(targets, float), np.asarray(most, np.int64)

    def won(price):
        return np.minimum(np.floor((target / price + 1) / 2).astype(np.int64), most)

    low, high = 1e-12, 2 * max(float(target.max(initial=0)), 1.0)  # at the high price none is won
    for _ in range(200):
        price = (low + high) / 2
        low, high = (low, price) if won(price).sum() <= seats else (price, high)
    got = won(high)
    queue = [(-t / (2 * g + 1), i) for i, (t, g) in enumerate(zip(target, got, strict=True)) if g < most[i] and t]
    heapq.heapify(queue)
    for _ in range(seats - int(got.sum())):  # what one price leaves: ties
        if not queue:
            break
        _, i = heapq.heappop(queue)
        got[i] += 1
        if got[i] < most[i]:
            heapq.heappush(queue, (-target[i] / (2 * got[i] + 1), i))
    return got.tolist()


def seeded(seed: int, name: str, below: int) -> int:
    return int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[:8], 16) % below


def shard_ranges(upto: Sequence[int], start: int, blocks: int, block_words: int, n: int) -> list[tuple[int, int, int]]:
    """The words of a source's stream, from and up to, that each output shard takes.

    ``upto`` are the blocks of all earlier shards; shard k goes on where shard k - 1 stopped, at the
    stream's end from its beginning.
    """
    out = []
    for shard, (first, last) in enumerate(zip(upto[:-1], upto[1:], strict=True)):
        at, end = start + first, start + last
        while at < end:
            stop = min(end, (at // blocks + 1) * blocks)
            out.append((shard, at % blocks * block_words, min(((stop - 1) % blocks + 1) * block_words, n)))
            at = stop
    return out


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    block_words: int = BLOCK_WORDS,
    output_shards: int = OUTPUT_SHARDS,
    seed: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    key_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """What the mix takes of every row, and the seats of every source in every output shard.

    First result: doc_id, source, size (words), source_size, target, taken (words,
    repeats counted), epochs (whole passes), runs (first and last word, from 1, of what
    is taken besides: none, one or two) and shard_runs (output shard, first and last word, of
    all that is taken). Second: output_shard, source, blocks.

    ``weights`` repeat over the sources in code point order, null last. The driver holds
    one row for each source. Null, empty and blank texts have size 0 and nothing of them
    is taken; repeated rows count each; an empty table gives no rows. A source that is all
    blank still uses up its weight. The seeded order is by id, or the text where there is none. With
    ``key_col`` the first result has that column too, as ``row_key``, to find its row by.
    """
    spark = docs.sparkSession
    name = F.col("source")
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            F.xxhash64(text_col).alias("text_hash"),
            *([F.col(f"`{key_col}`").alias("row_key")] if key_col else []),
        )
        # A key that is never null, and the bucket of the seeded order.
        .withColumn("mix_key", F.when(name.isNull(), "n").otherwise(F.concat(F.lit("s"), name)))
        .withColumn(
            "part",
            F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.col("text_hash").cast("string")))), 1, 3),
        ),
        "mix-rows",
    )
    parts = rows.groupBy("mix_key", "part").agg(F.sum("size").alias("part_size"))
    sources = sorted(
        (r["mix_key"], r["n"]) for r in parts.groupBy("mix_key").agg(F.sum("part_size").alias("n")).collect()
    )
    sources = [s for s in sources if s[0] != "n"] + [s for s in sources if s[0] == "n"]
    sizes = [n for _, n in sources]
    wanted = [weights[i % len(weights)] for i in range(len(sources))]
    total = sum(sizes)
    targets = source_targets(sizes, wanted, max_epochs) if total else [0.0] * len(sources)
    blocks = [-(-n // block_words) for n in sizes]
    most = [max_epochs * b for b in blocks]
    seats = (total + block_words // 2) // block_words
    upto = [apportion(targets, seats * k // output_shards, most) for k in range(output_shards + 1)]
    plan, quotas = [], []
    for i, (key, n) in enumerate(sources):
        source = None if key == "n" else key[1:]
        epochs, rest = divmod(upto[-1][i], blocks[i]) if blocks[i] else (0, 0)
        start = seeded(seed, key, blocks[i]) if blocks[i] else 0
        end = start + rest
        run = (start * block_words, min(end * block_words, n), max(0, end - blocks[i]) * block_words)
        ranges = shard_ranges([u[i] for u in upto], start, blocks[i], block_words, n)
        plan.append((key, n, targets[i], epochs, *run, ranges))
        quotas += [(k, source, upto[k + 1][i] - upto[k][i]) for k in range(output_shards)]
    schema = "mix_key string, source_size long, target double, epochs long, run_from long, run_to long, wrap_to long, ranges array<struct<shard:int,low:long,high:long>>"
    offsets = parts.withColumn(
        "before", F.sum("part_size").over(Window.partitionBy("mix_key").orderBy("part")) - F.col("part_size")
    ).drop("part_size")
    offsets = offsets.join(spark.createDataFrame(plan, schema), "mix_key")
    inside = Window.partitionBy("mix_key", "part").orderBy("doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("inside", F.sum("size").over(inside)).join(offsets, ["mix_key", "part"])
    begin = F.col("before") + F.col("inside") - F.col("size")
    end = F.col("before") + F.col("inside")
    # The run, and what of it goes round to the start of the stream, as words of the document.
    low, high = F.greatest(begin, "run_from"), F.least(end, F.col("run_to"))
    run = F.greatest(F.lit(0), high - low)
    wrap = F.greatest(F.lit(0), F.least(end, F.col("wrap_to")) - begin)
    taken = F.col("epochs") * F.col("size") + run + wrap
    one = F.when(run > 0, F.struct((low - begin + 1).alias("first"), (high - begin).alias("last")))
    two = F.when(wrap > 0, F.struct(F.lit(1).cast("long").alias("first"), wrap.alias("last")))
    mine = F.filter("ranges", lambda r: (r["high"] > begin) & (r["low"] < end))
    by_shard = F.transform(
        mine,
        lambda r: F.struct(
            r["shard"].alias("shard"),
            (F.greatest(r["low"], begin) - begin + 1).alias("first"),
            (F.least(r["high"], end) - begin).alias("last"),
        ),
    )
    mixed = placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        "epochs",
        F.array_compact(F.array(one, two)).alias("runs"),
        by_shard.alias("shard_runs"),
        *(["row_key"] if key_col else []),
    )
    return mixed, spark.createDataFrame(quotas, "output_shard int, source string, blocks long")


def mixed_rows(docs: DataFrame, mixed: DataFrame, key_col: str) -> DataFrame:
    """``docs``, without their key, as the mix takes them: a row for each whole pass, and one for each further run.

    ``key_col`` tells the rows of ``docs`` apart, and ``mixed`` was made with it. The row of a run
    has the words of the run as its text, with single spaces; there are at most two such documents
    in a source. ``n_chars``, where there is one, follows the text.
    """
    columns = [name for name in docs.columns if name != key_col]
    whole = F.struct(F.lit(1).cast("long").alias("first"), F.col("size").alias("last"))
    taken = mixed.filter("taken > 0").select(
        "row_key", "size", F.concat(F.array_repeat(whole, F.col("epochs").cast("int")), "runs").alias("copies")
    )
    # The caller's columns in one struct: none of their names can clash with those of here.
    own = docs.select(F.col(f"`{key_col}`").alias("row_key"), F.struct(*(F.col(f"`{c}`") for c in columns)).alias("doc"))
    rows = own.join(taken, "row_key").select("doc", "size", F.explode("copies").alias("run"))
    words = F.regexp_extract_all("doc.text", F.lit(WORD), F.lit(0))
    length = (F.col("run.last") - F.col("run.first") + 1).cast("int")
    part = F.array_join(F.slice(words, F.col("run.first").cast("int"), length), " ")
    cut = length < F.col("size")
    changed = {"text": F.when(cut, part).otherwise(F.col("doc.text"))}
    if "n_chars" in columns:
        n_chars = F.length(part).cast(dict(docs.dtypes)["n_chars"])
        changed["n_chars"] = F.when(cut, n_chars).otherwise(F.col("doc.n_chars"))
    return rows.select(*(changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in columns))
