"""Every operator on documents, against brute force, with nulls, repeats, ties and clashing names."""

import base64
import hashlib
import struct
import sys
import zlib
from collections import Counter, defaultdict

import brute
import edges
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    common,
    fingerprints,
    minhash,
    packing,
    quality,
    queries,
    secrets,
    sharding,
    suffix_arrays,
    suffix_dedup,
)

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    common.ship(spark)
    return edges.documents(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    common.ship(spark)
    return edges.empty(spark)


def pairs():
    """(doc_id, text) of every row, null texts as empty."""
    return [(r[0], r[1] or "") for r in edges.rows()]


def table_texts(spark):
    rows = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


# Byte-level BPE


def _tiktoken():
    import public_tokenizers

    return bpe.encoding(queries.vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.mark.parametrize("sizes", [{}, {"chunk_chars": 200, "overlap": 40}])
def test_bpe_round_trip(docs, sizes):
    import public_tokenizers

    ranks, pattern = queries.vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    got = bpe.decode(bpe.encode(docs, ranks, pattern, **sizes), ranks, pattern).collect()
    expected = Counter((d, tuple(_tiktoken().encode_ordinary(t)), t.encode()) for d, t in pairs())
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == expected


def test_bpe_of_no_rows(none):
    import public_tokenizers

    ranks = queries.vocabulary("byte_bpe_multi_50k.tiktoken")
    assert bpe.encode(none, ranks, public_tokenizers.PATTERN).count() == 0


def test_bpe_chunks_are_cut_at_true_boundaries(spark, docs):
    import public_tokenizers

    text = edges.texts()[11]
    cuts = bpe._cuts(spark.createDataFrame([("k", text)], "digest string, text string"),
                     public_tokenizers.PATTERN, 300, 60).first().cuts
    true = set(bpe.boundaries(text, public_tokenizers.PATTERN))
    assert len(cuts) >= len(text) // 300 and set(cuts) <= true


def test_bpe_pieces_with_blanks_at_a_chunk_start(spark):
    import public_tokenizers

    common.ship(spark)
    ranks, pattern = queries.vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    # Chunks of 200 characters start at 160 and 320; the blanks end there or run across.
    texts = [edges.prose(20, 60)[:160 - len(blanks) + k].rstrip() + blanks + edges.prose(21, 60)
             for blanks in (" \xa0", "  \xa0", "\n \u2003", " " * 60 + "\xa0", "\xa0\xa0", " \n")
             for k in range(3)]
    texts += [("a" * (160 - len(blanks)) + blanks + "b" * 8 + " c" * 60)
              for blanks in (" \xa0", "  \xa0", "\t\xa0", "\xa0\xa0")]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in bpe.encode(
        frame, ranks, pattern, chunk_chars=200, overlap=40).collect()}
    assert got == {i: _tiktoken().encode_ordinary(t) for i, t in enumerate(texts)}


def test_op1_query(spark):
    expected = {d: (_tiktoken().encode_ordinary(t), t) for d, t in table_texts(spark).items()}
    for r in queries.op1_bpe(spark, TESTDATA).collect():
        ids, text = expected.pop(r.doc_id)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == brute.sha(",".join(map(str, ids)))
        assert r.decoded_sha256 == brute.sha(text)
    assert not expected


# Packing


def _word_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text, add_special_tokens=False).ids + [1]


def test_lookup_equals_the_tokenizer():
    lookup = packing.Lookup(queries.vocabulary("word_bpe_49k.json"), 50)
    odd = ["Straße.", "ÉCOLE!!", "it's.", "don'T.", "3,5", "a.b,", "x²!!", "İ.", "ΣΑΣ.", "'S.", "a'S",
           "---", "_a_", "\x1c,", "a\x85b", "K.", "a\xad.", "\xb5,", "\xaa,", "1\xbd.", "a\x00b", "é̈."]
    odd += [" ".join(odd), edges.texts()[16], edges.prose(8, 300)]
    for text in odd:
        assert lookup.ids([text])[0] == np.array(_word_ids(text)[:-1], "<u4").tobytes(), repr(text)


def test_lookup_remembers_a_bounded_number_of_bytes():
    lookup = packing.Lookup(queries.vocabulary("word_bpe_49k.json"), 1_000_000, 20_000)
    for i in range(40):
        words = " ".join(f"w{i}x{k}" for k in range(50))
        whole = "".join(f"字{i}句{k}" for k in range(200))
        for text in (words, whole, f"{words} {whole}"):
            assert lookup.ids([text])[0] == np.array(_word_ids(text)[:-1], "<u4").tobytes()
    known = lookup._known
    assert max(map(len, known)) <= 64 and "w0x0" in known
    assert sum(sys.getsizeof(s) + sys.getsizeof(ids) for s, ids in known.items()) <= 20_000


def test_added_tokens_are_one_id_as_in_the_plain_call(spark):
    from tokenizers import Tokenizer

    common.ship(spark)
    vocabulary = queries.vocabulary("word_bpe_49k.json")
    plain = Tokenizer.from_file(vocabulary)
    odd = ["a<|endoftext|>b", "A<|ENDOFTEXT|>b", "A<|endoftext|>B.", "<|endoftext|>", "<|EndOfText|>x,",
           "x<|startoftext|>.", "<|endoftext|><|startoftext|>!!", "\x00<|endoftext|>", "é<|endoftext|>Ü",
           "a<|endoftext|", "<|end\noftext|>", "a\x85<|endoftext|>\x85b", "İ<|endoftext|>"]
    odd.append(" and\n".join([*odd, "plain", "words."]))
    frame = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    found = defaultdict(dict)
    for r in packing.pack(frame, vocabulary).collect():
        found[r.doc_id].update(enumerate(struct.unpack(f"<{r.length}I", r.input_ids), r.start))
    for i, text in enumerate(odd):
        expected = [*plain.encode(text, add_special_tokens=False).ids, 1]
        assert [x for _, x in sorted(found[i].items())] == expected, repr(text)
    assert 49407 in found[0].values() and 49407 not in found[1].values()


@pytest.mark.parametrize("capacity,window", [(2048, 4096), (64, 5)])
def test_packing_places_every_token_once(docs, capacity, window):
    got = packing.pack(docs, queries.vocabulary("word_bpe_49k.json"), capacity=capacity,
                       window_pieces=window).collect()
    by_sequence, tokens = defaultdict(list), Counter()
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        ids = struct.unpack(f"<{r.length}I", r.input_ids)
        tokens.update((r.doc_id, r.doc_tokens, r.start + i, t) for i, t in enumerate(ids))
    expected = Counter()
    for d, t in pairs():
        ids = _word_ids(t)
        expected.update((d, len(ids), i, x) for i, x in enumerate(ids))
    assert tokens == expected
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at and length > 0
            at += length
        assert at <= capacity


def test_assignment_balances_cost_and_wastes_less_than_a_sequence():
    lengths = np.random.default_rng(5).integers(1, 2048, 500)
    placed = packing.assign(lengths, 2048, 1.0, 1 / 2048)
    count = -(-int(lengths.sum()) // 2048)
    assert {s for *_, s, _ in placed} == set(range(count))
    assert sum(n for _, _, n, _, _ in placed) == lengths.sum()
    cost = np.zeros(count)
    for _, _, n, s, _ in placed:
        cost[s] += n + n * n / 2048
    assert cost.max() < 2 * cost.mean()


def test_packing_of_no_rows(none):
    assert packing.pack(none, queries.vocabulary("word_bpe_49k.json")).count() == 0


def test_op3_query(spark):
    ids = {d: _word_ids(t) for d, t in table_texts(spark).items()}
    rows = queries.op3_packing(spark, TESTDATA).collect()
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == brute.crc32_ids(part) and r.doc_tokens == len(ids[r.doc_id])
    total = sum(map(len, ids.values()))
    assert sum(r.length for r in rows) == total
    assert len({r.sequence_id for r in rows}) <= total // 2048 + 1


# Suffix arrays


def test_suffix_array_and_common_prefixes():
    rnd = np.random.default_rng(3)
    for n in (1, 2, 50, 400):
        strings = [bytes(rnd.integers(97, 99, rnd.integers(0, n)).astype(np.uint8)) for _ in range(4)]
        strings.append(b"ab" * n)
        joined = b"\0".join(strings) + b"\0"
        symbols = np.frombuffer(joined, np.uint8).astype(np.int64)
        order = suffix_arrays.suffix_array(symbols)
        assert order.tolist() == sorted(range(len(joined)), key=lambda i: joined[i:])
        bounds = np.cumsum([0, *(len(s) + 1 for s in strings)])
        found = suffix_arrays.common_prefixes(symbols, order, bounds, 10).tolist()

        def shared(a, b, joined=joined):
            k = 0
            while k < 10 and max(a, b) + k < len(joined) and joined[a + k] == joined[b + k]:
                k += 1
            return k

        assert found == [0, *(shared(a, b) for a, b in zip(order, order[1:]))]


def removed(texts, length):
    """What goes from (key, text) pairs in order; equal keys and texts are one document."""
    seen, out = set(), {}
    for key, text in texts:
        if (key, text) in out:
            continue
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            part = raw[i:i + length]
            if part in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(part)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[key, text] = (len(raw), sum(gone), len(bytes(gone).replace(b"\0", b" ").split()), kept)
    return out


def in_order():
    return sorted(set(pairs()), key=lambda p: (p[0] is not None, p[0] or 0))


@pytest.mark.parametrize("settings", [
    suffix_dedup.Settings(),
    suffix_dedup.Settings(stretch_bytes=256, block_segments=4, heavy_in_block=1, heavy_segments=3,
                          shard_bytes=2000, salts=3),
    suffix_dedup.Settings(length=20, gram=8, heavy_in_block=2, heavy_segments=2),
])
def test_repeats_against_brute_force(docs, settings):
    expected = removed(in_order(), settings.length)
    got = suffix_dedup.remove_repeats(docs, settings).select(
        "row.*", "n_bytes", "n_removed", "n_spans", "kept").select(
            "doc_id", "n_bytes", "n_removed", "n_spans", docs.columns[-1]).count()
    assert got == len(edges.rows())
    rows = suffix_dedup.remove_repeats(docs, settings).select(
        F.col("row.doc_id").alias("d"), "n_bytes", "n_removed", "n_spans",
        F.col("kept").alias("left")).collect()
    wanted = Counter((d, *expected[d, t]) for d, t in pairs())
    assert Counter((r.d, r.n_bytes, r.n_removed, r.n_spans, bytes(r.left)) for r in rows) == wanted


def test_deduplicate_keeps_columns(docs, none):
    left = suffix_dedup.deduplicate(docs)
    assert left.columns == docs.columns and left.count() == len(edges.rows())
    assert left.where("n_chars <> length(text)").isEmpty()
    assert suffix_dedup.deduplicate(none).count() == 0


# Fingerprints


def likeness(a, b):
    x, y = set(fingerprints.units(a).tolist()), set(fingerprints.units(b).tolist())
    return len(x & y) / len(x | y) if x | y else 1.0


def test_differences_recover_the_digests():
    rnd = np.random.default_rng(1)
    pool = rnd.integers(0, 2**64, 3000, dtype=np.uint64)
    sets = [np.unique(rnd.choice(pool, n)) for n in (0, 1, 5, 40, 700, 2500)]
    sides = [(a, b) for a in sets for b in sets]
    for (a, b), (gone, new) in zip(sides, fingerprints.differences(sides), strict=True):
        assert set(gone) == set(a) - set(b) and set(new) == set(b) - set(a)


@pytest.mark.parametrize("range_rows", [1_000, 3])
def test_next_document(docs, range_rows):
    got = fingerprints.with_next(docs, range_rows=range_rows).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(pairs())
    follow = {}
    ordered = sorted(pairs(), key=lambda p: (p[0] is not None, p[0] or 0))
    for i, (d, _) in enumerate(ordered):
        follow.setdefault(d, set()).add(ordered[(i + 1) % len(ordered)][1])
    assert all(r.next_text in follow[r.doc_id] for r in got)


def test_fingerprints_compare(docs, none):
    versions = fingerprints.with_next(docs).withColumn("edited", fingerprints.edited())
    prints = {}
    for r in fingerprints.compare(versions.withColumn("copy", F.col("text")), "text",
                                  ["edited", "copy"], carry={"text": "string"}).collect():
        assert prints.setdefault(r.text, r.text_fingerprint) == r.text_fingerprint
        assert r.copy_likeness == 1.0 and r.copy_fingerprint == r.text_fingerprint
        assert not r.copy_removed and not r.copy_added and 0 <= r.edited_likeness <= 1
    assert fingerprints.compare(fingerprints.with_next(none), "text", ["next_text"]).count() == 0


def test_units_cover_every_character_and_count_repeats():
    odd = [*filter(None, edges.texts().values()), "!!!", "\n\n.a", "...,b\n\n\nc", "一。二，三！？\n四、五"]
    for text in odd:
        assert "".join(fingerprints.UNIT.findall(text)) == text
    assert likeness("", "!!!") == 0 and likeness("line\n", "line\n" * 1000) == 0.001
    assert likeness("a.b.", "\na.b.") < 1 and likeness("a.b.", "b.a.") == 1
    wide = "。".join(f"第{i}句話說得很長很長，第{i}句" for i in range(100))
    assert likeness(wide, "新" + wide) > 0.98


def test_op6_query(spark):
    ordered = sorted(table_texts(spark).items())
    got = {r.doc_id: r for r in queries.op6_fingerprints(spark, TESTDATA).collect()}
    assert len(got) == len(ordered)
    for i, (d, text) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        r = got[d]
        assert r.n_chars == len(text) and r.edited_sha256 == brute.sha(edited)
        assert r.near_edited == pytest.approx(likeness(text, edited))
        assert r.near_next == pytest.approx(likeness(text, after))
        n, cells = r.fingerprint.split(":")
        assert int(n) == len(fingerprints.units(text)) and len(base64.b64decode(cells)) == 24 * 16


# Secrets


def test_secret_spans(spark, docs, tmp_path):
    ledger = secrets.Ledger(spark, str(tmp_path / "ledger"))
    got = secrets.scan(docs, ledger).select("doc_id", "blob", *queries.span_columns()).collect()
    expected = Counter((d, brute.sha(t), brute.base_digest(t)) for d, t in pairs())
    assert Counter((r.doc_id, r.blob, r.base_sha256) for r in got) == expected
    spans = {r.doc_id: r.spans for r in got}
    assert spans[18].startswith("assign:") and "access:" in spans[18] and "hex:" in spans[18]


def test_only_unseen_pairs_are_scanned(spark, docs, none, tmp_path):
    ledger = secrets.Ledger(spark, str(tmp_path / "ledger"))
    ledger.update(none)
    assert ledger.rows().count() == 0
    few = docs.where("doc_id <= 6")
    ledger.update(few)
    first = ledger.rows().count()
    assert first == few.select("text").na.fill("").distinct().count() * len(secrets.RULES)
    ledger.update(few)
    assert ledger.rows().count() == first
    ledger.update(docs)
    blobs = len({t for _, t in pairs()})
    assert ledger.rows().count() == blobs * len(secrets.RULES)
    newer = secrets.Rule("hex", 2, r"[0-9a-f]{40,}")
    ledger.update(docs, [newer])
    assert ledger.rows().count() == blobs * (len(secrets.RULES) + 1)
    # Findings of the version asked for.
    found = ledger.findings([newer]).collect()
    assert {s.end - s.start for r in found for s in r.spans} == {40, 700}


def test_redaction(spark, docs, none, tmp_path):
    ledger = secrets.Ledger(spark, str(tmp_path / "ledger"))
    left = secrets.redact(docs, ledger)
    assert left.columns == docs.columns
    rows = left.collect()
    assert len(rows) == len(edges.rows())
    by_id = {r.doc_id: r.text for r in rows}
    assert by_id[1] is None and by_id[6] == edges.texts()[6]
    assert by_id[18] == '[SECRET]" [SECRET] password:short [SECRET] [SECRET]'
    assert secrets.redact(none, secrets.Ledger(spark, str(tmp_path / "other"))).count() == 0


# Sharding


@pytest.mark.parametrize("range_rows", [20_000, 3])
def test_shards_match_the_mixture(docs, none, range_rows):
    got = sharding.interleave(docs, 4, range_rows=range_rows).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t in pairs())
    slots, sources = defaultdict(list), defaultdict(Counter)
    for r in got:
        slots[r.shard].append(r.slot)
        sources[r.source][r.shard] += 1
    sizes = [len(s) for s in slots.values()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for per_shard in sources.values():
        share = sum(per_shard.values()) / 4
        assert all(abs(per_shard[k] - share) < 2 for k in range(4))
    assert sharding.interleave(none, 4).count() == 0


def test_op8_query_ignores_the_ranges(spark):
    rows = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    common.ship(spark)
    one = sharding.interleave(rows, 24).select("doc_id", "shard", "slot").collect()
    two = sharding.interleave(rows, 24, range_rows=7).select("doc_id", "shard", "slot").collect()
    assert sorted(one) == sorted(two)


# Quality


def test_quality_measures(docs, none):
    got = quality.ledger(docs).collect()
    assert Counter((r.doc_id, *[r[m] for m in quality.MEASURES[:5]]) for r in got) == Counter(
        (d, *brute.quality(t)) for d, t in pairs())
    assert quality.ledger(none).count() == 0


def clashing_window(spark, first):
    """A window of three other words whose 64-bit hash is that of the words ``first``."""
    mask, p1, p2, p3 = 2**64 - 1, 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
    p4, p5 = 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5

    def turn(v, n):
        return (v << n | v >> (64 - n)) & mask

    # The last steps of xxHash64 backwards, for one block of eight bytes.
    v = spark.range(1).select(F.xxhash64(*map(F.lit, first))).first()[0] & mask
    v ^= v >> 32
    v = v * pow(p3, -1, 2**64) & mask
    v ^= v >> 29 ^ v >> 58
    v = v * pow(p2, -1, 2**64) & mask
    v ^= v >> 33
    mixed = turn((v - p4) * pow(p1, -1, 2**64) & mask, 64 - 27)
    for i, seed in spark.range(100_000).selectExpr("id", "xxhash64('x', concat('w', id))").collect():
        v = mixed ^ ((seed & mask) + p5 + 8 & mask)
        v = turn(v * pow(p1, -1, 2**64) & mask, 64 - 31) * pow(p2, -1, 2**64) & mask
        third = v.to_bytes(8, "little")
        if all(32 < c < 127 for c in third):
            return ["x", f"w{i}", third.decode()]
    raise AssertionError("no plain word")


def test_windows_of_equal_hash_hide_no_repeat(spark):
    first = ["one", "two", "three"]
    other = clashing_window(spark, first)
    assert spark.range(1).select(F.xxhash64(*map(F.lit, first)) == F.xxhash64(
        *map(F.lit, other))).first()[0]
    text = " ".join([*first, *other, *first])
    frame = spark.createDataFrame([(1, text), (2, f"{text} {text}")], "doc_id long, text string")
    got = {r.doc_id: tuple(r[m] for m in quality.MEASURES[:5]) for r in quality.ledger(frame).collect()}
    assert got == {1: brute.quality(text), 2: brute.quality(f"{text} {text}")}
    assert got[1][4] == 6


def test_policies_and_ablations(docs):
    stored = quality.ledger(docs).cache()
    rows = stored.collect()
    for r in quality.ablations(stored, [quality.BASE, quality.DEFAULT]).collect():
        policy = quality.BASE if r.policy == "base" else quality.DEFAULT
        mask, bit = policy.mask(), 1 << list(quality.RULES).index(r.rule)
        assert r.kept == sum(x.failed_bits & mask == 0 for x in rows)
        assert r.kept_without == sum(x.failed_bits & mask & ~bit == 0 for x in rows)
        assert r.failing == sum(x.failed_bits & bit != 0 for x in rows)
    assert quality.apply_policy(stored, quality.BASE).where("kept").count() == sum(
        x.failed_bits & 3 == 0 for x in rows)


def test_kept_documents_pass_unchanged(docs, none):
    kept = quality.keep_documents(docs)
    assert kept.columns == docs.columns and quality.keep_documents(none).count() == 0
    good = {(r.doc_id) for r in quality.ledger(docs).collect() if r.failed_bits == 0}
    assert Counter(tuple(r) for r in kept.collect()) == Counter(
        r for r in edges.rows() if r[0] in good)


# MinHash


def groups(words, percent):
    def shingles(text):
        w = brute.words("".join(c.lower() if c.isascii() else c for c in text))
        return frozenset([tuple(w)] if 0 < len(w) < words else
                         [tuple(w[i:i + words]) for i in range(len(w) - words + 1)] if w else [])

    found = [(d, shingles(t)) for d, t in pairs()]
    group = list(range(len(found)))
    for i, (_, a) in enumerate(found):
        for j, (_, b) in enumerate(found[:i]):
            if a and 100 * len(a & b) >= percent * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (d, _), g in zip(found, group):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    return Counter((d, len(s), least.get(g) if s else d, (least.get(g) if s else d) == d)
                   for (d, s), g in zip(found, group))


@pytest.mark.parametrize("settings", [
    minhash.Settings(), minhash.Settings(words=5, percent=80, tables=14), minhash.Settings(near=1)])
def test_near_duplicates_against_brute_force(docs, settings):
    got = minhash.near_duplicates(docs, settings).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == groups(
        settings.words, settings.percent)


def test_large_tables_lose_no_link(spark):
    """Near copies of two texts that share a passage, with tables that are larger than ``near``."""
    common.ship(spark)
    one, two = edges.prose(50, 200).split(), edges.prose(51, 200).split()
    two[:90] = one[:90]
    rows = []
    for i in range(60):
        words = list((one, two)[i % 2])
        words[100 + i] = f"new{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id
           for r in minhash.near_duplicates(docs, minhash.Settings(near=2)).collect()}
    assert got == {i: i % 2 for i in range(60)}


def test_one_of_each_group_is_kept(docs, none):
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 6 in ids and 7 not in ids and 8 not in ids
    assert {1, 2, 3, 4, 5, 13, 16, 17, 18} <= set(ids)
    assert minhash.keep_one(none).count() == 0
    assert minhash.near_duplicates(none).count() == 0


def test_one_row_of_a_group_is_kept_whatever_its_ids(spark):
    common.ship(spark)

    def near(seed):
        words = edges.prose(seed, 200).split()
        return [" ".join([*words[:k], f"new{k}", *words[k + 1:]]) for k in (20, 90, 160)]

    nameless, shared, mixed = near(60), near(61), near(62)
    rows = [*[(None, t) for t in nameless], (None, nameless[0].replace("the", "THE")),
            *[(7, t) for t in shared], (8, shared[0]), (7, shared[0]),
            (None, mixed[0]), (9, mixed[1]), (10, mixed[2]), (None, None), (11, ""), (12, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = Counter((r.doc_id, next((i for i, group in enumerate((nameless, shared, mixed))
                                    if (r.text or "").lower() in {t.lower() for t in group}), r.text))
                   for r in minhash.keep_one(docs).collect())
    assert kept == Counter([(None, 0), (7, 1), (9, 2), (None, None), (11, ""), (12, " ")])


def test_address_is_the_content():
    assert hashlib.sha256(b"").hexdigest() == brute.sha("")
