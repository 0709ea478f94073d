"""The corpus pipeline, stage by stage on the smallest documents and on hard cases."""

from collections import Counter, defaultdict

import brute
import corpus_pipeline
import edges

from ledgerloom.llm import queries, sharding
from ledgerloom.llm.common import ship

TESTDATA = "/root/testdata/sf0.001"


def stages(spark, docs, folder):
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, TESTDATA).write.parquet(f"{folder}/{name}")
        docs = found[name] = spark.read.parquet(f"{folder}/{name}")
    return found


def test_decisions_take_effect(spark, tmp_path):
    ship(spark)
    docs = edges.documents(spark)
    found = stages(spark, docs, tmp_path)
    kept = {r.doc_id: r.text for r in found["quality_rules"].collect()}
    assert 6 in kept and 7 in kept and 1 not in kept and 14 not in kept
    one = [r.doc_id for r in found["near_dedup"].collect()]
    assert 6 in one and 7 not in one and 8 not in one and len(one) == len(set(one))
    left = {r.doc_id: r.text for r in found["repeated_passages"].collect()}
    assert set(left) == set(one)
    assert len(left[10]) < len(kept[10]) and left[9] == kept[9]
    assert {r.doc_id for r in found["secret_scans"].collect()} == set(one)
    for name in list(found)[:-1]:
        assert found[name].columns == docs.columns
    packed = found["packing"].groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in packed} == set(one)


def test_no_documents(spark, tmp_path):
    found = stages(spark, edges.empty(spark), tmp_path)
    assert all(f.count() == 0 for f in found.values())


def test_run_on_the_smallest_tables(spark):
    rows = corpus_pipeline.run(spark, TESTDATA).collect()
    texts = {r.doc_id for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    assert rows and {r.doc_id for r in rows} <= texts


# Every stage against plain Python, on what the stage before it left


def near_kept(texts, words, percent):
    """Ids that stay of texts by id: the smallest of each group of linked texts."""
    def grams(text):
        w = [x.translate(brute_lower) for x in brute.words(text)]
        return {tuple(w[i:i + words]) for i in range(max(len(w) - words + 1, 1))} if w else set()

    brute_lower = {k: k + 32 for k in range(65, 91)}
    sets = {k: grams(t) for k, t in texts.items()}
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * len(sets[a] | sets[b]):
                    one, two = sorted((find(a), find(b)))
                    root[two] = one
    return {k for k in texts if find(k) == k}


def without_repeats(texts, length=100):
    """Texts by id without the bytes of windows that start earlier."""
    seen, left = set(), {}
    for k in sorted(texts):
        raw, gone = texts[k].encode(), set()
        for i in range(len(raw) - length + 1):
            window = raw[i:i + length]
            if window in seen:
                gone.update(range(i, i + length))
            seen.add(window)
        parts, part = [], bytearray()
        for i, byte in enumerate(raw):
            if i in gone:
                parts.append(bytes(part))
                part = bytearray()
            else:
                part.append(byte)
        left[k] = "".join(p.decode("utf-8", "ignore") for p in [*parts, bytes(part)])
    return left


def test_stages_against_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    ship(spark)
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    found = stages(spark, docs, tmp_path)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    by = {name: {r.doc_id: r.text for r in found[name].collect()} for name in list(found)[:-1]}

    passed = {}
    for k, text in texts.items():
        n, chars, symbols, again, repeated = brute.quality(text)
        lines = sum(bool(brute.words(line)) for line in text.split("\n"))
        if (n >= 50 and 100 * repeated <= 50 * n and 10 * symbols <= chars
                and 100 * again <= 50 * lines and 2 * n <= chars <= 25 * n):
            passed[k] = text
    assert by["quality_rules"] == passed and 0 < len(passed) < len(texts)

    assert set(by["near_dedup"]) == near_kept(passed, 5, 80)
    assert by["near_dedup"] == {k: passed[k] for k in by["near_dedup"]}
    assert by["repeated_passages"] == without_repeats(by["near_dedup"])

    masked = by["secret_scans"]
    assert set(masked) == set(by["repeated_passages"])
    for k, text in by["repeated_passages"].items():
        spans = brute.base_spans(text)
        assert not any(s[3] != "assign" for s in brute.base_spans(masked[k]))
        assert ("[SECRET]" in masked[k]) or not spans
        if masked[k] == text:
            assert not spans

    tokenizer = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    pieces, places = defaultdict(list), defaultdict(list)
    for r in found["packing"].collect():
        ids = [int.from_bytes(r.input_ids[i:i + 4], "little") for i in range(0, len(r.input_ids), 4)]
        assert len(ids) == r.length
        pieces[r.doc_id].append((r.start, ids))
        places[r.sequence_id].append((r.offset, r.length))
    for k, text in masked.items():
        whole = [i for _, part in sorted(pieces.pop(k)) for i in part]
        assert whole == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    assert not pieces
    for held in places.values():
        held.sort()
        assert [at for at, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
        assert sum(n for _, n in held) <= 2048


def test_shards_against_a_plain_placement(spark):
    """Seeded hashes, fractional ranks and cuts by plain Python."""
    import hashlib
    import zlib

    def number(text, digits):
        return int(hashlib.md5(text.encode()).hexdigest()[:digits], 16)

    ship(spark)
    rows = [(r.doc_id, r.source, (r.text or "").encode())
            for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    by_source = defaultdict(list)
    for doc_id, source, raw in rows:
        crc = zlib.crc32(raw)
        shown = "" if doc_id is None else str(doc_id)
        by_source[source].append((number(f"0|{shown}|{crc}", sharding.HASH_BITS // 4), doc_id, crc,
                                  len(raw) + 8))
    placed = []
    for source, held in by_source.items():
        start = number(f"0|{source or ''}", 5)
        for rank, (_, doc_id, crc, size) in enumerate(sorted(held)):
            at = ((rank << 20) + start) * (1 << (sharding.HASH_BITS - 20)) // len(held)
            placed.append((at, source or "", rank, doc_id, crc, size))
    want, total = [], len(rows)
    for position, (*_, doc_id, crc, size) in enumerate(sorted(placed)):
        shard = position * queries.SHARDS // total
        want.append((doc_id, size, crc, "rows", shard, position - -(-shard * total // queries.SHARDS),
                     None))
    got = queries.op8_sharding(spark, TESTDATA).collect()
    assert Counter(tuple(r) for r in got) == Counter(want)
