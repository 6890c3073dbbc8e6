"""Brute force for the n-gram join, decontamination and the pipeline; every registered query."""

import collections
import random
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from hearthline.llm import decontaminate
from hearthline.llm.ngram_join import components, ngram_join
from hearthline.llm.queries import ORACLES, QUERIES

GIVEN = Path("/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def normal(frame):
    """Rows in order, columns by name, whole numbers as such whatever pandas made of their nulls."""
    columns = sorted(frame.columns)

    def value(cell):
        if pd.isna(cell):
            return ""
        return str(int(cell)) if isinstance(cell, float) and cell.is_integer() else str(cell)

    return columns, sorted([value(cell) for cell in row] for row in frame[columns].astype(object).values.tolist())


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed):
    """Texts at and around the threshold: copies of copies, a shared passage, tiny texts."""
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghij") + str(draw.randrange(300))
    passage = [word() for _ in range(40)]
    texts = [None, "", " \t", "one", "ONE", "one two", "a b c d e", "a b c d e f", "Ä b c d e", "ä b c d e"]
    for _ in range(8):
        base = [word() for _ in range(draw.choice([12, 60, 150]))]
        family = [base]
        for _ in range(14):
            copy = list(draw.choice(family))
            for _ in range(draw.randrange(1 + len(base) // 25)):
                at = draw.randrange(len(copy))
                copy[at : at + draw.randrange(2)] = [word()]
            family.append(copy)
        texts += [" ".join(f) for f in family]
    texts += [" ".join([word() for _ in range(draw.randrange(5, 30))] + passage) for _ in range(40)]
    texts += [texts[20].upper(), texts[20].replace(" ", "\n"), " ".join(passage * 3)]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_join_gives_the_components_of_brute_force(spark, seed):
    rows = near_copies(seed)
    docs = docs_of(spark, rows).withColumns({"node": F.lit("clash"), "n": F.lit(0), "component": F.lit(1)})
    docs = docs.union(docs.filter("doc_id % 9 = 0"))
    found = ngram_join(docs).collect()
    assert len(found) == docs.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows)


def test_join_of_nothing_of_long_texts_and_of_rows_without_id(spark):
    docs = docs_of(spark, [(1, "x")])
    assert ngram_join(docs.limit(0)).count() == 0
    long = [f"w{i}" for i in range(50_000)]
    rows = [(5, " ".join(long)), (3, " ".join(long[:42_000])), (4, " ".join(long[:39_000])), (None, " ".join(long)), (7, None)]
    found = {r.doc_id: r.component_id for r in ngram_join(docs_of(spark, rows)).collect()}
    assert found == {5: 3, 3: 3, 4: 3, None: None, 7: 7}


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 202), (202, 200)]
    random.Random(1).shuffle(links)
    frame = spark.createDataFrame(links + links[:5], "a long, b long")
    found = {r.node: r.component for r in components(frame).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), **dict.fromkeys(range(200, 203), 200)}
    assert components(frame.limit(0)).count() == 0


def item_texts(draw, n):
    def sentence(k):
        return " ".join("".join(draw.choices(["ba", "ke", "li", "mo", "nu", "ta", "si"], k=draw.randrange(1, 5))) for _ in range(k)) + "."

    return [" ".join([sentence(draw.randrange(6, 20)), sentence(draw.randrange(6, 90)), sentence(draw.randrange(5, 9))]) for _ in range(n)], sentence


def test_leaks_are_found_wherever_they_stand_and_clean_texts_left(spark):
    draw = random.Random(7)
    items, sentence = item_texts(draw, 60)
    rows, planted = [], set()
    for i in range(240):
        text = [sentence(draw.randrange(5, 40)) for _ in range(draw.randrange(1, 30))]
        if i % 4 == 0:
            item = draw.randrange(60)
            leak = items[item].upper() if i % 8 == 0 else items[item].replace(" ", "  ").replace(".", " !!")
            text.insert(draw.randrange(len(text) + 1), leak)
            planted.add((i, item))
        if i % 4 == 1:  # the question alone is no leak
            text.append(" ".join(items[i % 60].split()[:6]))
        rows.append((i, " ".join(text)))
    rows += [(1000, None), (1001, ""), (1002, "x" * 100_000), (1003, " ".join([*["filler words"] * 30_000, items[3]]))]
    planted.add((1003, 3))
    benchmark = spark.createDataFrame([*enumerate(items), (100, None), (101, ""), (102, "too short")], "item_id long, text string")
    docs = docs_of(spark, rows).withColumn("item_id", F.lit("clash"))
    docs = docs.union(docs.filter("doc_id = 0"))
    found = decontaminate.find_leaks(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == planted
    assert sum(r.doc_id == 0 for r in found) == 2
    kept = decontaminate.remove_leaking(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in planted}
    for empty in (decontaminate.find_leaks(docs.limit(0), benchmark), decontaminate.find_leaks(docs, benchmark.limit(0))):
        assert empty.count() == 0
    assert decontaminate.remove_leaking(docs, benchmark.limit(0)).count() == docs.count()


def test_parts_of_a_benchmark_find_what_one_index_finds(spark):
    """Scores too: how common a word is does not depend on the part. Items of equal texts each count."""
    draw = random.Random(9)
    items, sentence = item_texts(draw, 40)
    items += items[:3] + [items[5]] * 20
    rows = [(i, " ".join([sentence(30), items[i % 40], sentence(20), items[(i * 7) % 40]])) for i in range(60)]
    rows += [(100 + i, sentence(60)) for i in range(20)] + [(200, None)]
    benchmark = spark.createDataFrame([*enumerate(items), (900, None), (901, "too short")], "item_id long, text string")
    docs = docs_of(spark, rows)

    def found(**limits):
        return sorted(map(tuple, decontaminate.find_leaks(docs, benchmark, **limits).collect()))

    whole = found()
    assert {(i, k) for i, k, *_ in whole} == {
        (i, k) for i in range(60) for k, text in enumerate(items) if text in (items[i % 40], items[(i * 7) % 40])
    }
    size = sum(map(len, set(items)))
    for limits in ({"index_items": 14}, {"index_bytes": size // 3 + 1}, {"index_bytes": size // 10}):
        parts = found(**limits)
        assert [r[:2] for r in parts] == [r[:2] for r in whole]
        for a, b in zip(parts, whole, strict=True):
            assert a[2:] == pytest.approx(b[2:], abs=1e-12)
        kept = decontaminate.remove_leaking(docs, benchmark, **limits)
        assert {r.doc_id for r in kept.collect()} == {*range(100, 120), 200}


def test_retrieval_is_that_of_scoring_everything():
    """Block-max pruning drops no passage and segment that reaches the threshold."""
    draw = random.Random(8)
    items, sentence = item_texts(draw, 50)
    index = decontaminate.build_index(list(enumerate(items)), passage=32, share=0.3)
    texts = [" ".join([sentence(draw.randrange(5, 60)), *draw.sample(items, draw.randrange(3))]) for _ in range(60)]
    hashes = decontaminate.all_words(texts)
    offsets = decontaminate.np.cumsum([0, *map(len, hashes)])
    flat = decontaminate.np.concatenate(hashes)
    expected = collections.Counter()
    for t, found in enumerate(hashes):
        for low in range(0, len(found), 16):
            here = set(found[low : low + 32].tolist())
            for s, (terms, impact) in enumerate(index.whole):
                score = sum(v for term, v in zip(terms, impact, strict=True) if int(index.vocabulary[term]) in here)
                if score >= index.threshold[s]:
                    expected[t, s, round(score, 6)] += 1
    got = collections.Counter((t, s, round(score, 6)) for t, s, score in decontaminate.retrieve(index, flat, offsets, passage=32))
    assert got == expected and len(expected) > 20


@pytest.mark.skipif(not GIVEN.is_dir(), reason="given tables are not here")
def test_stages_of_the_pipeline(spark, tmp_path):
    """Each stage on what the one before kept, against a plain count of what it has to do."""
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet").withColumn("shard", F.lit("clash"))
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], str(GIVEN)).write.parquet(f"{tmp_path}/{name}")
        seen.append(spark.read.parquet(f"{tmp_path}/{name}"))
    for before, after in zip(seen[:4], seen[1:5], strict=True):
        assert after.columns == before.columns
    labels = spark.read.parquet(f"{GIVEN}/labels.parquet")
    good = {r.doc_id for r in seen[1].join(labels, "doc_id").filter("quality = 1").select("doc_id").collect()}
    assert len(good) >= 0.97 * labels.join(docs, "doc_id").filter("quality = 1").count()
    rows = [(r.doc_id, r.text) for r in seen[1].collect()]
    firsts = {i for i, (_, c) in brute_components(rows).items() if i == c}
    assert {r.doc_id for r in seen[2].collect()} == firsts
    benchmark = spark.read.parquet(f"{GIVEN}/benchmark.parquet")
    leaking = {r.doc_id for r in decontaminate.find_leaks(seen[2], benchmark).collect()}
    assert {r.doc_id for r in seen[3].collect()} == firsts - leaking
    assert seen[5].count() == seen[4].count()
    sizes = [r.b for r in seen[5].groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 16


def test_every_query_is_registered():
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in queries()) == 1
    assert "pipeline" in queries() and set(ORACLES) <= set(QUERIES) <= set(queries())
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in oracle_sql()


@pytest.mark.skipif(not GIVEN.is_dir(), reason="given tables are not here")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, str(GIVEN)).toPandas()
    table = "pages" if name in ("op1_url_rules", "op7_warc") else "documents"
    connection = duckdb.connect()
    for file in GIVEN.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    if name == "op11_whitening":
        assert len(got) == 32 * connection.execute("SELECT count(*) FROM embeddings").fetchone()[0]
    elif name not in ("op2_decontaminate", "op12_collocations", "op13_top_k", "pipeline"):
        assert len(got) == connection.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
    if name in ORACLES:
        assert normal(got) == normal(connection.execute(ORACLES[name]).df())
