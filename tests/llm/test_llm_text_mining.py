"""Decontamination and collocations against brute force."""

import re
from collections import Counter, defaultdict
from itertools import product

import edges
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import collocations, common, decontamination, tokens

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    common.ship(spark)
    return edges.documents(spark).cache()


def texts():
    return [(r[0], r[1] or "") for r in edges.rows()]


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


# Words


@pytest.mark.parametrize("gaps, pattern", [
    (decontamination.GAPS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
    (collocations.GAPS, r"[^\x20\x09.,;:!?\x0A-\x0D]+")])
def test_words_of_texts(gaps, pattern):
    import pyarrow as pa

    given = ["", "a", *[t for _, t in texts()], "", "end", "İX ÉÀ a b", ""]
    found = tokens.split(pa.array(given), gaps)
    got = [found.words[a:b].to_pylist() for a, b in zip(found.bounds, found.bounds[1:])]
    assert got == [re.findall(pattern, t.translate(UPPER)) for t in given]
    assert tokens.split(pa.array(given).slice(3, 4), gaps).words.to_pylist() == sum(got[3:7], [])
    assert len(tokens.split(pa.array([], pa.string()), gaps).words) == 0


# Decontamination


def item_rows():
    whole = texts()
    return [(1, None), (2, ""), (3, "one"), (4, "TWO words"), (5, whole[8][1]), (6, whole[8][1]),
            (10, "no such words stand in any of the documents of this table at all"),
            (7, " ".join(words_of(whole[19][1])[150:190])), (None, "x \U0001f600 é̈"),
            (8, "line line line line line line line line line line line"), (8, "aaa"), (9, "###"),
            (11, whole[5][1][:300] + " unheard of " + whole[9][1][-200:])]


def matches(text, slack):
    """(words hit, ids of items) of a document, word by word."""
    doc, hit, named = words_of(text), set(), set()
    for item_id, item in item_rows():
        item = words_of(item)
        if not item:
            continue
        for window in {tuple(item[i:i + 10]) for i in range(max(len(item) - 9, 1))}:
            n = len(window)
            for p in range(-slack, len(doc) - n + 1 + slack):
                if all(any(0 <= p + k + s < len(doc) and doc[p + k + s] == w
                           for s in range(-slack, slack + 1)) for k, w in enumerate(window)):
                    hit |= set(range(max(p - slack, 0), min(p + n + slack, len(doc))))
                    named.add("" if item_id is None else str(item_id))
    return hit, named


@pytest.mark.parametrize("slack, part_bytes", [(0, 1 << 20), (0, 400), (1, 1 << 20), (2, 400)])
def test_phrases_and_proximity(spark, docs, slack, part_bytes):
    items = spark.createDataFrame([(i, t, "x") for i, t in item_rows()],
                                  "item_id long, text string, items string")
    found = decontamination.phrases(decontamination.build_index(docs), items, slack=slack,
                                    part_bytes=part_bytes).collect()
    expected = []
    for doc_id, text in texts():
        hit, named = matches(text, slack)
        expected.append((doc_id, len(words_of(text)), tuple(sorted(hit)), tuple(sorted(named))))
    got = [(r.doc_id, r.n_words, tuple(k for s in r.spans for k in range(s.start, s.end)),
            tuple(r["items"])) for r in found]
    assert Counter(got) == Counter(expected)
    assert all(a.end < b.start for r in found for a, b in zip(r.spans, r.spans[1:]))
    assert sum(len(g[3]) for g in got) > 10


def test_decontamination_of_no_rows(spark, docs):
    items = spark.createDataFrame(item_rows(), "item_id long, text string")
    none = decontamination.build_index(edges.empty(spark))
    assert decontamination.phrases(none, items).count() == 0
    found = decontamination.phrases(decontamination.build_index(docs), items.limit(0)).collect()
    assert len(found) == len(texts()) and not any(r.spans or r["items"] for r in found)


def test_long_texts(spark, docs):
    """Texts beyond a block and words whose list is longer than a step."""
    long = "word " * 1_500_000
    rows = spark.createDataFrame(
        [(1, long + "a needle in it"), (2, "needle"), (3, "a needle in it")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "word " * 12), (2, "needle in it")], "item_id long, text string")
    found = decontamination.phrases(decontamination.build_index(rows), items).collect()
    assert {r.doc_id: ([tuple(s) for s in r.spans], r["items"]) for r in found} == {
        1: ([(0, 1_500_000), (1_500_001, 1_500_004)], ["1", "2"]), 2: ([], []), 3: ([(1, 4)], ["2"])}


def test_row_groups_of_the_index(spark, docs):
    """A task with many blocks writes, and so reads again, one at a time."""
    from urllib.parse import urlparse

    import pyarrow.parquet as pq

    rows = spark.range(0, 300, 1, 1).selectExpr(
        "id AS doc_id", "array_join(transform(sequence(1, 20000), x -> hex(x * (id + 1))), ' ') AS text")
    index = decontamination.build_index(rows)
    stored = [pq.ParquetFile(urlparse(f).path).metadata for f in index.inputFiles()]
    groups = [m.row_group(g) for m in stored for g in range(m.num_row_groups)]
    assert len(groups) > 6 and {g.num_rows for g in groups} == {1}
    assert not any(g.column(c).is_stats_set for g in groups for c in range(g.num_columns))
    items = rows.where("doc_id = 7").selectExpr(
        "doc_id AS item_id", "concat_ws(' ', slice(split(text, ' '), 100, 12)) AS text")
    found = decontamination.phrases(index, items).collect()
    assert len(found) == 300 and {r.n_words for r in found} == {20000}
    assert [(r.doc_id, [tuple(s) for s in r.spans], r["items"]) for r in found if r.spans] == [
        (7, [(99, 111)], ["7"])]


def test_blocks_without_words(spark, docs):
    rows = spark.createDataFrame([(None, None), (1, " .!"), (2, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "needle"), (2, "")], "item_id long, text string")
    found = decontamination.phrases(decontamination.build_index(rows.coalesce(1)), items).collect()
    assert sorted((str(r.doc_id), r.n_words, r.spans, r["items"]) for r in found) == [
        ("1", 0, [], []), ("2", 0, [], []), ("None", 0, [], [])]


# Collocations


def mined(rows, least, covered, top):
    """The ranked phrases of (lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    frequent = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    inside = defaultdict(int)
    for (lang, phrase), v in frequent.items():
        for i, j in product(range(len(phrase)), range(2, len(phrase))):
            if i + j <= len(phrase):
                inside[lang, phrase[i:i + j]] = max(inside[lang, phrase[i:i + j]], v)
    found = defaultdict(list)
    for (lang, p), a in frequent.items():
        if 100 * inside[lang, p] >= covered * a and inside[lang, p]:
            continue
        score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        found[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return Counter((lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                   for lang, ranked in found.items()
                   for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top]))


PHRASES = ["new york city hall", "of the", "in the end of it", "Ünder dér Brücke", "\U0001f600 ￮ x"]


def phrase_rows():
    import random

    rnd = random.Random(5)
    rows = [(None if k % 7 == 0 else ["en", "de", "und"][k % 3],
             "".join(rnd.choice([*PHRASES, "the", "of", "york", "a b"]) + rnd.choice(
                 [" ", "  ", "\t", ". ", ", ", "\n", "; "]) for _ in range(rnd.randint(0, 60))))
            for k in range(150)]
    return [*rows, ("en", None), (None, ""), ("fr", " . ,\n"), ("it", "solo"), ("en", "the " * 3000)]


@pytest.mark.parametrize("batch, settings", [
    (10_000, collocations.Settings()), (3, collocations.Settings(top=7)),
    (50, collocations.Settings(least=5, covered=60))])
def test_collocations(spark, batch, settings):
    """Small Arrow batches cut stripes at every place."""
    common.ship(spark)
    rows = spark.createDataFrame([(k, a, b, "x") for k, (a, b) in enumerate(phrase_rows())],
                                 "doc_id long, lang string, text string, phrase string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = collocations.collocations(rows, settings).select(
            "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = mined(phrase_rows(), settings.least, settings.covered, settings.top)
    assert Counter(tuple(r) for r in got) == expected
    assert len({len(r.phrase.split(" ")) for r in got}) == 3


def test_collocations_of_edge_rows(spark, docs):
    got = collocations.collocations(docs, collocations.Settings(least=3)).collect()
    want = mined([(r[2], r[1]) for r in edges.rows()], 3, 80, 2000)
    assert Counter((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == want
    assert collocations.collocations(edges.empty(spark)).count() == 0


def test_counts_beyond_64_bits(spark):
    """Scores and subsumption stay exact where products pass 64 bits."""
    big = 3 * 10**14
    assert spark.range(1).select(F.expr(
        f"bigint((2000000BD * cast({big}L AS decimal(38, 0))) div "
        f"(cast({2 * big}L AS decimal(38, 0)) + cast({big}L AS decimal(38, 0))))")).first()[0] == (
            2000000 * big // (3 * big))
