"""Cases at the limits: long runs of blanks, equal hashes, groups of near copies, spread reads."""

import random

import edges
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, common, minhash, queries, secrets, suffix_dedup, warc


# Byte-level BPE


def encoder():
    import public_tokenizers

    ranks = queries.vocabulary("byte_bpe_multi_50k.tiktoken")
    return bpe.encoding(ranks, public_tokenizers.PATTERN), ranks, public_tokenizers.PATTERN


def test_runs_of_blanks_equal_the_library(monkeypatch):
    """Every kind of run, wherever the library can encode it."""
    library, *_ = encoder()
    monkeypatch.setattr(bpe, "LONG_RUN", 3)
    rnd = random.Random(8)
    parts = [" ", "  ", "   ", "\n", "\r\n", "\t\t\t", " 　 ", "\x1c", "\x85  ", "a", "Ü1", "'s",
             "!?", " b", "\U0001f600"]
    for _ in range(3000):
        text = "".join(rnd.choices(parts, k=rnd.randint(0, 12)))
        assert bpe.encode_text(library, text) == library.encode_ordinary(text), text


def test_a_million_blanks(spark):
    common.ship(spark)
    library, ranks, pattern = encoder()
    n = 1_000_000
    texts = [" " * n, " " * n + "word", "a" + " " * n + "\n", "x\n" * 10 + "\t" * n + "  y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, ranks, pattern), ranks, pattern).select(
        "doc_id", F.size("ids").alias("n"), F.slice("ids", -4, 4).alias("last"), "decoded").collect()}
    assert [bytes(got[k].decoded).decode() for k in range(4)] == texts
    assert got[0].n == n and got[1].n == n - 1 + len(library.encode_ordinary(" word"))
    assert got[1].last[-1] == library.encode_ordinary(" word")[-1]


# WARC


def test_ranges_are_read_by_many_tasks(spark, tmp_path):
    common.ship(spark)
    pages = spark.createDataFrame(
        [(k, "u", f"{k} " + edges.prose(k, 60)) for k in range(120)],
        "page_id long, url string, html string").repartition(2)
    archives = warc.write_archives(pages, str(tmp_path / "w"))
    assert warc.locate(archives, 600).count() >= 50
    spark.conf.set("spark.sql.adaptive.enabled", True)
    read = warc.read_records(archives, 600).withColumn("task", F.spark_partition_id())
    assert read.select("task").distinct().count() > 8 and read.count() == 120


# Suffix-array dedup


def test_equal_short_hashes_are_not_one_document(spark):
    """Two texts without id whose 32-bit hashes are equal: only the later one loses its passage."""
    common.ship(spark)
    passage = "p" + edges.prose(70, 40)[:129]
    made = spark.range(400_000).select(
        F.concat(F.lit(passage), F.col("id").cast("string")).alias("text")).withColumn(
            "hash", F.hash("text"))
    twins = made.groupBy("hash").agg(F.collect_list("text").alias("texts")).where(
        "size(texts) = 2").first().texts
    docs = spark.createDataFrame([(None, t) for t in twins], "doc_id long, text string")
    removed = sorted(r.n_removed for r in suffix_dedup.remove_repeats(docs).collect())
    assert removed[0] == 0 and removed[1] >= len(passage.encode())


# Secret scans


def test_missing_rules_are_scanned_at_once(spark, tmp_path):
    common.ship(spark)
    docs = edges.documents(spark)
    ledger = secrets.Ledger(spark, str(tmp_path / "ledger"))
    ledger.update(docs.where("doc_id < 10"), secrets.RULES[:2])
    ledger.update(docs, secrets.RULES)
    whole = secrets.Ledger(spark, str(tmp_path / "whole"))
    whole.update(docs, secrets.RULES)

    def rows(of):
        return sorted(map(repr, of.rows().collect()))

    assert rows(ledger) == rows(whole)
    before = ledger.rows().count()
    ledger.update(docs, secrets.RULES)
    assert ledger.rows().count() == before


def test_redaction_keeps_clashing_columns(spark, tmp_path):
    common.ship(spark)
    docs = edges.documents(spark).withColumn("_spans_cut", F.lit("mine")).withColumn(
        "_cut", F.lit("own")).withColumn("_spans", F.lit(3))
    left = secrets.redact(docs, secrets.Ledger(spark, str(tmp_path / "ledger")))
    assert left.columns == docs.columns and left.schema == docs.schema
    assert left.select("_spans_cut", "_cut", "_spans").distinct().collect() == [("mine", "own", 3)]


# Near-duplicates


def near_texts(n):
    """Copies of one text of 150 words with up to 25 of them changed."""
    rnd = random.Random(12)
    base = edges.prose(90, 150).split()
    found = []
    for k in range(n):
        words = list(base)
        for at in rnd.sample(range(150), rnd.randint(0, 14)):
            words[at] = f"w{rnd.randint(0, 30)}x{at}"
        found.append(" ".join(words))
    return found


def roots(texts, words, percent):
    """The component of each text, by comparing all pairs."""
    sets = [minhash.shingles(t, words) for t in texts]
    known = {v: i for i, v in enumerate(sorted({int(v) for s in sets for v in s}))}
    held = np.zeros((len(sets), len(known)), np.float32)
    for k, s in enumerate(sets):
        held[k, [known[int(v)] for v in s]] = 1
    shared = held @ held.T
    n = held.sum(axis=1)
    linked = 100 * shared >= percent * (n[:, None] + n - shared)
    found = list(range(len(texts)))
    for k in range(len(texts)):
        todo = [k] if found[k] == k else []
        while todo:
            more = [j for j in np.flatnonzero(linked[todo.pop()]) if found[j] > k]
            for j in more:
                found[j] = k
            todo += more
    return found


@pytest.mark.parametrize("block, settings", [
    (minhash.BLOCK, minhash.Settings()), (60_000, minhash.Settings()),
    (60_000, minhash.Settings(words=5, percent=80, tables=14))])
def test_near_copies_around_the_threshold(spark, monkeypatch, block, settings):
    """Crowded nodes, in one block and in many, against all pairs."""
    common.ship(spark)
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = near_texts(2_000 if block == minhash.BLOCK and settings.words == 3 else 700)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, settings).collect()}
    expected = roots(texts, settings.words, settings.percent)
    assert [got[k] for k in range(len(texts))] == expected
    assert 50 < len(set(expected)) < len(texts) - 50
