"""Edge cases and brute force for the operators that shuffle little: words, rules, mixing, shards, WARC."""

import base64
import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hearthline.llm import mixing, quality_rules, sharding, url_rules, warc
from hearthline.llm.rows import keyed_rows
from hearthline.llm.tokens import lines, pieces, shingles, span_hashes, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))


def docs_of(spark, texts, sources=None):
    rows = [(i, t, "en", sources[i] if sources else "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def mixed_texts(seed=1, n=150):
    draw = random.Random(seed)
    vocabulary = ["a", "bb", "ccc", "Äö", "x|y", "#1", "\u00a0odd", "end."]
    texts = [None, "", "   ", "\n\n", "one", LONG, "same text here", "same text here"]
    while len(texts) < n:
        joined = [draw.choice(vocabulary) + draw.choice([" ", "  ", "\n", "\t", "\x1f"]) for _ in range(draw.randrange(120))]
        texts.append("".join(joined))
    return texts


def test_words_lines_and_shingles_are_those_of_plain_python():
    column = pa.array(mixed_texts())
    for piece in pieces(column, 3000):
        found, rows = words(piece), lines(piece)
        values, offsets = shingles(span_hashes(piece.data, found.begin, found.end), found.offsets)
        for i in range(piece.rows):
            text = (column[piece.first + i].as_py() or "").encode()
            spans = slice(found.offsets[i], found.offsets[i + 1])
            got = [bytes(piece.data[a:b]) for a, b in zip(found.begin[spans], found.end[spans], strict=True)]
            assert got == text.split()
            spans = slice(rows.offsets[i], rows.offsets[i + 1])
            got_lines = [bytes(piece.data[a:b]) for a, b in zip(rows.begin[spans], rows.end[spans], strict=True)]
            assert got_lines == text.split(b"\n")
            expected = {tuple(got[k : k + 5]) for k in range(max(1, len(got) - 4))} if got else ()
            assert offsets[i + 1] - offsets[i] == len(expected)


def base_columns(text):
    text = text or ""
    found = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(zip(found, found[1:], found[2:], strict=False))
    covered = {i + k for i, w in enumerate(zip(found, found[1:], found[2:], strict=False)) if windows[w] > 1 for k in range(3)}
    n = len(found)
    return (n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_quality_rules_columns_and_score(spark):
    texts = mixed_texts()
    docs = docs_of(spark, texts).withColumn("score", F.lit("clash")).withColumn("kept", F.lit(1))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 150, 3)], "doc_id long, quality int, toxic int")
    rows = quality_rules.quality_rules(docs, labels, threshold=0.0).collect()
    assert len(rows) == len(texts)
    # Brute force of the score, with the same buckets.
    grams = []
    for piece in pieces(pa.array(texts)):
        buckets, owner = quality_rules.ngram_buckets(piece, words(piece))
        grams += [buckets[owner == i] for i in range(piece.rows)]
    raw, target = (np.bincount(np.concatenate(g), minlength=quality_rules.BUCKETS) for g in (grams, grams[::3]))
    ratio = np.log((target + 1) / (target.sum() + len(target)) / ((raw + 1) / (raw.sum() + len(raw))))
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_columns(texts[r.doc_id])
        score = ratio[grams[r.doc_id]].mean() if len(grams[r.doc_id]) else 0.0
        assert r.score == pytest.approx(score)
        assert r.kept == (not r.base_failed and r.score >= 0)
    none = quality_rules.quality_rules(docs, labels.limit(0))
    assert all(r.score == 0 and r.kept != r.base_failed for r in none.collect())
    assert quality_rules.quality_rules(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("most_broadcast", ["1g", "-1"])
def test_quality_rules_count_every_row_labelled_good(spark, tmp_path, most_broadcast):
    # 24,000 good ids, among them ids labelled twice or good and bad; rows without an id, rows that repeat.
    n = 30_000
    rows = [(i, f"w{i % 61} v{i * i % 37} u{i}", i % 5 > 0) for i in range(n)]
    rows += [(None, "no id", False)] * 2 + [(7, "again w7", True), (5, "again bad", False)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/docs")
    labels = spark.range(n).selectExpr("id AS doc_id", "int(id % 5 > 0) AS quality")
    more = spark.createDataFrame([(7, 1), (7, 1), (8, 0), (8, None), (None, 1), (n + 9, 1)], "doc_id long, quality int")
    labels.union(more).write.parquet(f"{tmp_path}/labels")
    docs, labels = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("docs", "labels"))
    grams = []
    for piece in pieces(pa.array([text for _, text, _ in rows])):
        buckets, owner = quality_rules.ngram_buckets(piece, words(piece))
        grams += np.split(buckets[np.argsort(owner, kind="stable")], np.cumsum(np.bincount(owner))[:-1])
    target = np.concatenate([g for g, (*_, good) in zip(grams, rows, strict=True) if good])
    raw, target = (np.bincount(g, minlength=quality_rules.BUCKETS) for g in (np.concatenate(grams), target))
    ratio = np.log((target + 1) / (target.sum() + len(target)) / ((raw + 1) / (raw.sum() + len(raw))))
    expected = sorted((-1 if i is None else i, ratio[g].mean()) for (i, *_), g in zip(rows, grams, strict=True))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most_broadcast)
    try:
        got = quality_rules.quality_rules(docs, labels).select("doc_id", "score").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.score) for r in got)
    assert [i for i, _ in got] == [i for i, _ in expected]
    assert np.allclose([x for _, x in got], [x for _, x in expected], rtol=0, atol=1e-9)


def test_sainte_lague_gives_the_highest_quotients():
    draw = random.Random(3)
    for _ in range(60):
        targets = [draw.choice([0, 1.5, draw.random() * 50]) for _ in range(draw.randrange(1, 8))]
        most = [draw.randrange(0, 40) for _ in targets]
        seats = draw.randrange(0, 60)
        quotients = sorted((-t / (2 * k - 1), i, k) for i, t in enumerate(targets) if t for k in range(1, most[i] + 1))
        expected = collections.Counter(i for _, i, _ in quotients[:seats])
        assert mixing.apportion(targets, seats, most) == [expected[i] for i in range(len(targets))]


def test_targets_stop_at_three_times_the_size():
    assert mixing.source_targets([10, 1000, 990], [5, 2, 1]) == [30.0, 2 * 1970 / 3, 1970 / 3]
    assert mixing.source_targets([0, 8], [5, 2]) == [0.0, 8.0]


def test_mix_takes_near_the_target_and_repeats_itself(spark):
    draw = random.Random(5)
    texts = [None, "", LONG] + [" ".join("w" * draw.randrange(1, 60)) for _ in range(400)]
    sources = [draw.choice(["b", "a", "a", "a", None, "é", "Z"]) for _ in texts]
    docs = docs_of(spark, texts, sources).withColumn("size", F.lit("clash"))
    docs = docs.union(docs.filter("doc_id in (1, 7, 8)"))  # repeated rows
    mixed, quotas = mixing.mix_sources(docs, block_words=4)
    rows = mixed.collect()
    again = mixing.mix_sources(docs.repartition(7), block_words=4)[0].collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert len(rows) == docs.count()
    names = sorted({r.source for r in rows if r.source is not None}) + [None]
    weights = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total = sum(r["size"] for r in rows)
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
        assert r.taken <= 3 * r["size"] and r["size"] == len(WORD.findall(texts[r.doc_id] or ""))
        assert r.taken == r.epochs * r["size"] + sum(x.last - x.first + 1 for x in r.runs)
        assert r.taken == sum(x.last - x.first + 1 for x in r.shard_runs)
    targets = mixing.source_targets([sum(r["size"] for r in by_source[n]) for n in names], [weights[n] for n in names])
    for name, target in zip(names, targets, strict=True):
        assert by_source[name][0].target == target
        assert abs(sum(r.taken for r in by_source[name]) - target) <= 12
    assert sum(targets) == pytest.approx(total)
    seats = {r.source: r.n for r in quotas.groupBy("source").agg(F.sum("blocks").alias("n")).collect()}
    assert sum(seats.values()) == (total + 2) // 4
    # Every shard takes its quota: so many blocks, each of four words but for a source's last.
    words = collections.Counter()
    for r in rows:
        for x in r.shard_runs:
            words[x.shard, r.source] += x.last - x.first + 1
    for q in quotas.collect():
        got = words[q.output_shard, q.source]
        laps = -(-q.blocks * 4 // max(1, sum(r["size"] for r in by_source[q.source])))
        assert q.blocks * 4 - 3 * (laps + 1) <= got <= q.blocks * 4
    assert mixing.mix_sources(docs.limit(0))[0].count() == 0
    blank = mixing.mix_sources(docs_of(spark, [None, ""], ["x", None]))[0].collect()
    assert [r.taken for r in blank] == [0, 0]
    keyed, name = keyed_rows(docs)
    taken = mixing.mixed_rows(keyed, mixing.mix_sources(keyed, block_words=4, key_col=name)[0], name)
    assert taken.columns == docs.columns
    words_of = {d: n for d, n in taken.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text")))).collect()}
    wanted = collections.Counter()
    for r in rows:
        wanted[r.doc_id] += r.taken
    assert {d: n for d, n in words_of.items() if n} == {d: n for d, n in wanted.items() if n}


def test_rows_without_an_id_and_clashing_names_are_mixed_to_the_targets(spark, tmp_path):
    draw = random.Random(6)
    rows = [(None if i % 2 else i // 4, " ".join(f"w{draw.randrange(9)}" for _ in range(draw.randrange(30))), draw.choice("ab")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("run", "mix", "mix_size", "size", "row_key", "doc", "copies", "n_chars"):
        docs = docs.withColumn(name, F.col("doc_id"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.mixed(spark, docs, "")
    assert got.columns == docs.columns
    size = {s: sum(len(t.split()) for _, t, of in rows if of == s) for s in "ab"}
    targets = mixing.source_targets([size["a"], size["b"]], [5, 2])
    words = dict(got.groupBy("source").agg(F.sum(mixing.word_count(F.col("text")))).collect())
    assert abs(words["a"] - targets[0]) <= 2 * mixing.BLOCK_WORDS and abs(words["b"] - targets[1]) <= 2 * mixing.BLOCK_WORDS
    again = corpus_pipeline.mixed(spark, docs.repartition(5), "")
    assert sorted(map(str, again.drop("n_chars").collect())) == sorted(map(str, got.drop("n_chars").collect()))


def test_near_duplicates_are_judged_by_row(spark, tmp_path):
    text, other, third = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyz")
    near = text.replace("x30", "edited")
    rows = [(None, text), (None, text), (5, text), (5, other), (None, other), (6, near), (7, third), (None, None), (None, ""), (7, third), (None, "")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, row_key int")
    docs.coalesce(1).write.parquet(f"{tmp_path}/d")
    got = corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{tmp_path}/d"), "")
    assert got.columns == docs.columns
    kept = sorted(r.row_key for r in got.collect())
    # One of text and near (the first without an id), one of other, one of third; nothing to compare in 7, 8, 10.
    assert kept == [0, 4, 6, 7, 8, 10]
    memory = corpus_pipeline.near_duplicates(spark, docs, "")  # not read from files
    assert sorted(r.text or "" for r in memory.collect()) == sorted(rows[n][1] or "" for n in kept)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0


def best_capacity(sizes, n):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, parts, filled = (low + high) // 2, 1, 0
        for s in sizes:
            if filled + s > middle:
                parts, filled = parts + 1, 0
            filled += s
        low, high = (low, middle) if parts <= n else (middle + 1, high)
    return low


@pytest.mark.parametrize("hot", [0, 900])
def test_shards_are_the_best_contiguous_partition(spark, hot):
    draw = random.Random(hot)
    texts = [None, "", "x", "x", LONG[:3000]] + ["y" * draw.randrange(1, 90) + str(draw.randrange(400)) for _ in range(900)]
    texts += ["hot " * 12] * hot
    docs = docs_of(spark, texts).withColumn("shard", F.lit("clash"))
    rows = sharding.assign_shards(docs, 8).collect()
    groups = collections.Counter()
    for t in texts:
        groups[hashlib.sha256((t or "").encode()).digest()] += len((t or "").encode()) + 1
    shard_of = {}
    for r in rows:
        t = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(t) + 1, zlib.crc32(t))
        assert shard_of.setdefault(hashlib.sha256(t).digest(), r.shard) == r.shard
    by_shard = collections.defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
    for shard in by_shard.values():
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
    sizes = {s: sum(r["size"] for r in rows_) for s, rows_ in by_shard.items()}
    ordered = [groups[k] for k in sorted(groups)]
    if hot:  # the hot group alone, the others in the shards that remain
        alone = max(ordered)
        assert alone == sizes.pop(0)
        ordered.remove(alone)
    assert max(sizes.values()) == best_capacity(ordered, 7 if hot else 8)


def test_shards_of_few_rows(spark):
    docs = docs_of(spark, ["a", "a", None])
    assert sharding.assign_shards(docs.limit(0), 4).count() == 0
    rows = sharding.assign_shards(docs.union(docs), 16).collect()
    assert len({(r.shard, r.slot) for r in rows}) == 6
    assert len({r.shard for r in rows if r.doc_id in (0, 1)}) == 1


PAGES = "page_id long, url string, html string"


def test_warc_round_trip(spark, tmp_path):
    big = "ß" * 300_000
    pages = [(i, f"http://h{i}.org/\r\nWARC-Type: x", f"<p>{i % 7}</p>\r\n\r\n") for i in range(200)]
    pages += [(1000, None, None), (1001, "u", ""), (5_000_000_000, "u", big), (None, "u", "no id"), (3, "twice", "<p>3</p>\r\n\r\n")]
    frame = spark.createDataFrame(pages, PAGES).withColumn("digest", F.lit("clash"))
    folder = f"file://{tmp_path}/warc"
    manifest = warc.write_warc(frame, folder, file_bytes=4000, shard_bytes=20_000)
    rows = warc.read_warc(warc.open_manifest(spark, folder)).collect()
    kept = {}
    for i, _, html in pages:
        kept[html or ""] = max([x for x in (i, kept.get(html or "")) if x is not None], default=None)
    assert len(rows) == len(pages)
    texts = {(i, html or "") for i, _, html in pages}
    for r in rows:
        html = next(h for i, h in texts if i == r.page_id and base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() == r.payload_digest)
        assert r.payload_bytes == len(html.encode())
        first = r.page_id == kept[html]
        assert (r.record_type, r.refers_to) == (("response", None) if first else ("revisit", kept[html]))
        assert (bytes(r.payload) if r.payload is not None else None) == (html.encode() if first else None)
    files = sorted(map(tuple, manifest.files.collect()))
    other = warc.write_warc(frame.repartition(5), f"file://{tmp_path}/again", file_bytes=4000, shard_bytes=20_000)
    assert files == sorted(map(tuple, other.files.collect()))  # the same bytes from another partitioning
    assert len(files) > 3
    assert not [p for p in (tmp_path / "warc").iterdir() if p.name.endswith(".tmp")]
    (tmp_path / "warc" / files[0][0]).write_bytes(b"torn")
    with pytest.raises(Exception, match="archive ends|differs|incorrect header"):
        warc.read_warc(manifest).collect()
    assert warc.read_warc(warc.write_warc(frame.limit(0), f"file://{tmp_path}/none")).count() == 0
    small = warc.read_warc(warc.write_warc(frame.filter("page_id < 200"), f"file://{tmp_path}/min", min_revisit_bytes=1000))
    assert small.filter("record_type = 'revisit'").count() == 0


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://A.Example.org/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://badexample.org/en/1", "badexample.org", "/en/1", "org/", "allow"),
        ("x://y.com/fr/", "y.com", "/fr/", "com/fr/", "allow"),
        ("x://y.com/de/a://b", "y.com", "/de/a://b", "com/de/", "block"),
        ("http://a.org", "a.org", "", None, "allow"),
        ("http://ÄB.org?x/y", "Äb.org", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://" + "x" * 50_000 + ".com/de/", "x" * 50_000 + ".com", "/de/", "com/de/", "block"),
    ],
)
def test_fixed_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, None), (1, url, None)], PAGES).withColumn("verdict", F.lit(0))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = url_rules.filter_urls(pages, labels).collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [(host, path, rule, verdict)] * 2


def test_mined_rules_block_what_they_cover(spark):
    pages, labels = [], []
    for i in range(400):
        bad = i % 8 == 0
        pages.append((i, f"http://{'pills' if bad else 'news'}.site{i % 5}.net/{'buy' if bad else 'read'}/{i}?id={i}", ""))
        labels.append((i, 0 if bad else 1, 0))
    pages.append((1000, "http://pills.other.net/buy/1?id=2", ""))  # not labelled
    found = url_rules.filter_urls(
        spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    )
    verdicts = {r.page_id: r.verdict for r in found.collect()}
    assert verdicts == {i: "block" if i == 1000 or i % 8 == 0 else "allow" for i, _, _ in pages}
    rules = url_rules.mine_rules(spark.createDataFrame([("http://a.net/x", True)] * 3 + [("http://a.net/y", False)], "url string, bad boolean"))
    best = {tuple(r.tokens): (r.confidence, r.support) for r in rules.collect()}
    assert best["p:x",] == (1.0, 0.75) and best["h:a",] == (0.75, 0.75) and ("p:y",) not in best
    assert url_rules.filter_urls(spark.createDataFrame([], PAGES), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_a_rule_of_four_tokens_blocks(spark):
    """Bad only where all four parts stand together; each three of them are good more often than bad."""
    parts = ["http://a{}.net/", "b{}/", "c{}/", "d{}"]
    pages, labels = [], []
    for i in range(200):
        off = i % 5  # four in five lack one part
        pages.append((i, "".join(x.format("x" if off == k + 1 else "") for k, x in enumerate(parts)), ""))
        labels.append((i, int(off > 0), 0))
    pages.append((1000, "http://a.net/b/c/d", ""))  # not labelled
    found = url_rules.filter_urls(
        spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    ).collect()
    assert {r.page_id: r.verdict for r in found} == {i: "block" if i % 5 == 0 else "allow" for i, _, _ in pages}
    # "h:net" is in every url and adds nothing: the shorter rule is named.
    assert {r.mined_rule for r in found if r.mined_rule} == {"h:a p:b p:c p:d"}


def test_rules_are_those_of_counted_itemsets(spark):
    """Every combination that has the support and confidence, less those of which a part says as much."""
    draw = random.Random(5)
    for _ in range(3):
        rows = []
        for _ in range(60):
            keys = [k for k in "abcdef" if draw.random() < 0.5]
            keys += ["g", "h"] if "a" in keys else []  # always together with a
            rows.append(("http://x.net/?" + "&".join(keys), draw.random() < (0.9 if {"a", "b"} <= set(keys) else 0.3)))
        has = [({"h:x", "h:net", *(f"q:{k}" for k in url.split("?")[1].split("&") if k)}, bad) for url, bad in rows]
        counted = {}
        tokens = sorted(set().union(*(t for t, _ in has)))
        for size in range(1, 7):
            for some in itertools.combinations(tokens, size):
                hits = [bad for t, bad in has if t.issuperset(some)]
                if sum(hits) >= 6 and sum(hits) / len(hits) >= 0.5:
                    counted[frozenset(some)] = (sum(hits) / len(hits), sum(hits) / 60)
        minimal = {s: v for s, v in counted.items() if not any(p < s and counted[p][0] >= v[0] for p in counted)}
        found = url_rules.mine_rules(spark.createDataFrame(rows, "url string, bad boolean"), 0.1, 0.5).collect()
        expanded = {}
        for r in found:
            for some in itertools.product(*r.members):
                expanded[frozenset(some)] = (r.confidence, r.support)
        assert expanded == minimal


def test_thirty_constant_query_keys_are_mined_in_no_time(spark):
    keys = "&".join(f"key{i}=1" for i in range(30))
    pages = [(i, f"http://t.net/{'buy' if i % 2 else 'read'}?{keys}" if i % 5 == 0 else f"http://t.net/{i}/news", "") for i in range(500)]
    pages += [(1000, "http://u.net/buy?key7=2", ""), (1001, "http://u.net/sell?key7=2", "")]
    labels = [(i, int(not (i % 5 == 0 and i % 2)), 0) for i in range(500)]
    found = url_rules.filter_urls(
        spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    )
    verdicts = {r.page_id: r.verdict for r in found.collect()}
    assert all(verdicts[i] == ("block" if i % 5 == 0 and i % 2 else "allow") for i in range(500))
    assert verdicts[1000] == "block" and verdicts[1001] == "allow"


def test_warc_ids_of_any_size_and_even_shards(spark, tmp_path):
    ids = [-(2**63), 2**63 - 1, 10**15, None, None, *([7] * 150), *range(1000)]
    pages = [(i, f"u{n}", f"{n} " + "x" * 2000) for n, i in enumerate(ids)]
    frame = spark.createDataFrame(pages, PAGES)
    bounds = warc.shard_bounds(warc.linked(frame), 100_000)
    manifest = warc.write_warc(frame, f"file://{tmp_path}/w", shard_bytes=100_000)
    rows = warc.read_warc(manifest).collect()
    assert sorted(((r.page_id, r.url, bytes(r.payload).decode()) for r in rows), key=str) == sorted(pages, key=str)
    shards = collections.Counter()
    for file, records, *_ in manifest.files.collect():
        shards[file.split("-")[1]] += records
    assert len(shards) == len(bounds) + 1 > 20
    assert max(shards.values()) <= 2 * len(ids) / len(shards), "an outlier, and one id of many pages, skew nothing"
