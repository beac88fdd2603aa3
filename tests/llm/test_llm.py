"""The training-data operators against brute force, round trips and held-out labels, with odd rows."""

import hashlib
import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulselake.llm import bpe, components, cotraining, imatch, line_dedup, lists, minhash, multi_index, packing, suffix_dedup, toxicity, warc, word_ids

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, n int"


def docs_of(spark, rows):
    """(doc_id, text[, source]) rows with columns whose names clash with the operators' own."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 0.5, 7) for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(rng, n, letters="abcdefghijkl"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


ODD = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "null id here"), (4, " \n\t "), (5, "é" * 300 + "<|endoftext|>"), (6, "word " * 3000)]


@pytest.mark.parametrize("alphabet", ["a", "ab", "etaoin shrdlu", " ", "=-", "\n", "é", "aé日1 "])
def test_bpe_equals_the_library(alphabet):
    merges, library = bpe.MergeTable(BYTES), Tokenizer.from_file(BYTES)
    rng = random.Random(3)
    for n in (0, 1, 50, 6000):
        text = "".join(rng.choice(alphabet) for _ in range(n)) + "<|endoftext|>don't"
        got = [i for b in merges.encode(text) for i in struct.unpack(f"<{len(b) // 4}I", b)]
        assert got == library.encode(text, add_special_tokens=False).ids


def test_bpe_stream_emits_what_the_whole_gives():
    merges = bpe.MergeTable(BYTES)
    rng = random.Random(5)
    for letters in ("ab", "ing", "etaoinshrd"):
        data = "".join(rng.choice(letters) for _ in range(3 * merges.window)).encode()
        assert [t for part in merges.encode_run(data) for t in part] == merges.merge_window(data)


def test_decoder_holds_split_characters():
    tool = bpe.ByteToText([b"\xe6", b"\x97", b"\xa5", b"\xff"])
    assert [tool.feed([0]), tool.feed([1]), tool.feed([2, 3]), tool.finish()] == ["", "", "日�", ""]


def test_bpe_query_on_odd_rows(spark):
    library = Tokenizer.from_file(BYTES)
    got = bpe.encode_documents(docs_of(spark, ODD), BYTES).collect()
    assert len(got) == len(ODD)
    want = []
    for i, t in ODD:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.encode_documents(docs_of(spark, []), BYTES).count() == 0


def test_word_ids_equal_the_library():
    words = word_ids.WordIds(WORDS)
    for text in ["", "ΣΑΣ Σ ὈΔΥΣΣΕΎΣ", "It's 2024!! <|endoftext|>x", "\x00\x1f a\x85b", "İstanbul ﬁ Å", *(f"aB{chr(c)}1{chr(c)} {chr(c)}" for c in range(0, 0xD000, 37))]:
        assert list(struct.unpack(f"<{len(b := words.encode(text)) // 4}I", b)) == words.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("targets", [None, {"a": 0.7, "b": 0.2, "c": 0.1}])
def test_packing_is_whole_gapless_and_mixed(spark, targets):
    rng = random.Random(9)
    rows = [(k, prose(rng, rng.randint(0, 200)), rng.choice("abc")) for k in range(60)] + [(None, None), (7, ""), (61, "tail", None)]
    words = word_ids.WordIds(WORDS)
    got = packing.pack(docs_of(spark, rows), WORDS, seq_len=128, round_sequences=2, targets=targets, keep_ids=True).collect()
    by_doc = {}
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    want = Counter((k, len(words.encode(t)) // 4 + 1) for k, t, *_ in rows)
    assert {k: sum(r.length for r in v) for k, v in by_doc.items()} == {(k, n): n * c for (k, n), c in want.items()}
    texts = {(k, len(words.encode(t)) // 4 + 1): words.encode(t) + struct.pack("<I", 1) for k, t, *_ in rows}
    for key, pieces in by_doc.items():
        if want[key] == 1:
            assert b"".join(r.ids for r in sorted(pieces, key=lambda r: r.start)) == texts[key]
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in seqs.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at == 128 or at & (at - 1) == 0 and at < 128
    assert sorted(seqs) == list(range(len(seqs)))
    assert packing.pack(docs_of(spark, []), WORDS).count() == 0


def test_packing_keeps_targets_with_more_sources_than_queues(spark, monkeypatch):
    monkeypatch.setattr(packing, "MOST_QUEUES", 4)
    rng = random.Random(10)
    sources = {k: "ab"[k % 2] if k < 40 else f"s{k % 20}" for k in range(120)}
    rows = [(k, prose(rng, 60), s) for k, s in sources.items()]
    got = packing.pack(docs_of(spark, rows), WORDS, seq_len=128, round_sequences=2, targets={"a": 0.75, "b": 0.25}).collect()
    assert {r.doc_id: r.doc_tokens for r in got}.keys() == sources.keys() and sum(r.length for r in got) == sum({r.doc_id: r.doc_tokens for r in got}.values())
    first = Counter()
    for r in got:
        if r.sequence_id < 8:
            first[sources[r.doc_id]] += r.length
    assert set(first) == {"a", "b"} and abs(first["a"] / sum(first.values()) - 0.75) < 0.02


def test_every_full_sequence_holds_its_targets(spark):
    rng = random.Random(20)
    rows = [(k, prose(rng, rng.randint(20, 300)), rng.choice("aaaabbc")) for k in range(300)]
    source = {k: s for k, _, s in rows}
    for targets in (None, {"a": 0.5, "b": 0.3, "c": 0.2}):
        got = packing.pack(docs_of(spark, rows), WORDS, seq_len=128, targets=targets).collect()
        total = Counter()
        for r in got:
            total[source[r.doc_id]] += r.length
        sequences: dict = {}
        for r in got:
            sequences.setdefault(r.sequence_id, Counter())[source[r.doc_id]] += r.length
        shares = {q: n / sum(total.values()) for q, n in total.items()} if targets is None else targets
        first = int(min(total[q] / shares[q] for q in shares)) // 128  # until the first queue is empty
        for k in range(first - 1):
            assert all(abs(sequences[k][q] - 128 * shares[q]) <= len(shares) for q in shares), (k, sequences[k])


def test_schedule_keeps_proportions():
    totals = {"a": 70_000, "b": 20_000, "c": 10_000}
    schedule = packing.Schedule(packing.phases(totals, None, 1000))
    owner = np.empty(100_000, "<U1")
    for q, n in totals.items():
        for g, length in schedule.runs(q, 0, n):
            owner[g : g + length] = q
    for at in range(0, 100_000, 1000):
        counts = Counter(owner[at : at + 1000])
        assert abs(counts["a"] - 700) <= 3 and abs(counts["b"] - 200) <= 3 and abs(counts["c"] - 100) <= 3


def test_warc_round_trip(spark):
    same = "<p>" + "s" * 200
    pages = [(9, "u9", same), (4, "u%0A\r\nx", same), (5, None, same), (6, "u", None), (7, "u", ""), (8, "u", "short"), (10, "u", "short"), (11, "u", "é" * 400_000), (12, "v", "é" * 400_000)]
    df = spark.createDataFrame([(*p, "clash", 3) for p in pages], "page_id long, url string, html string, digest string, n int")
    manifest = warc.write_archives(warc.decide(df), warc.new_path(spark, "warc"), file_bytes=100)
    chunks = warc.read_archives(manifest, chunk=1000)
    got = {r.page_id: r for r in warc.records(chunks).collect()}
    for page_id, url, html in pages:
        data = (html or "").encode()
        first = min(p for p, _, h in pages if (h or "") == (html or ""))
        r = got[page_id]
        assert (r.payload_bytes, r.payload_digest, r.url) == (len(data), hashlib.sha256(data).hexdigest(), url)
        assert (r.record_type, r.refers_to) == (("revisit", first) if len(data) >= 100 and first != page_id else ("response", None))
    parts = sorted((r.chunk_no, r.data, r.payload_digest, r.payload_bytes) for r in chunks.where("page_id = 11").collect())
    data, at = ("é" * 400_000).encode(), 0
    for k, (no, part, digest, upto) in enumerate(parts):
        at += len(part)
        assert no == k and len(part) <= 1000 and upto == at and digest == hashlib.sha256(data[:at]).hexdigest()
    assert b"".join(p for _, p, _, _ in parts) == data
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(empty).count() == 0


def brute_components(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return [find(k) for k in range(n)]


@pytest.mark.parametrize("shape", ["random", "path", "star", "none"])
def test_components(spark, shape):
    rng = random.Random(1)
    n = 60
    links = {"random": [(rng.randrange(n), rng.randrange(n)) for _ in range(40)], "path": [(k, k + 1) for k in range(n - 1)], "star": [(30, k) for k in range(n)], "none": []}[shape]
    got = {r.node: r.root for r in components.components(spark.createDataFrame([*links, (None, 1)], "a int, b int")).collect()}
    want = brute_components(n, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {k: want[k] for k in linked}


def near_copies(rng, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


@pytest.mark.parametrize("width", [2, 5])
def test_minhash_equals_all_pairs(spark, width):
    rng = random.Random(11)
    rows = [(k, t) for k, t in ODD if k != 3] + [(100 + k, prose(rng, rng.randint(1, 12), "ab")) for k in range(60)]
    for b in range(6):
        base = prose(rng, 120)
        rows += [(200 + 30 * b + k, near_copies(rng, base, rng.randint(0, 14))) for k in range(24)]
    rows += [(900, "Some Text"), (901, "some  text"), (903, "same"), (902, "SAME")]
    got = {r.doc_id: r for r in minhash.near_duplicates(docs_of(spark, rows), width, 80).collect()}
    sets = [minhash.shingles(minhash.words_of(t), width) for _, t in rows]
    ids = [i for i, _ in rows]
    order = sorted(range(len(rows)), key=lambda k: (ids[k] is None, ids[k] or 0))
    links = [(x, y) for x in range(len(rows)) for y in range(x) if (a := sets[order[x]]) and (b := sets[order[y]]) and 100 * len(a & b) >= 80 * len(a | b)]
    roots = brute_components(len(rows), links)
    for x, k in enumerate(order):
        r = got[ids[k]]
        assert (r.n_shingles, r.component_id) == (len(sets[k]), ids[order[roots[x]]]), rows[k]
        assert r.kept == (roots[x] == x)
    assert minhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_minhash_large_group_of_near_copies(spark):
    rng = random.Random(4)
    base = prose(rng, 150)
    rows = [(k, near_copies(rng, base, rng.randint(0, 6))) for k in range(300)] + [(1000 + k, prose(rng, 150)) for k in range(50)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(spark, rows), 2, 80).collect()}
    assert {got[k] for k in range(300)} == {0} and all(got[1000 + k] == 1000 + k for k in range(50))


def test_minhash_of_many_pairs_on_one_passage(spark):
    """Pairs of near copies in lists that mostly hold other documents with the same passage."""
    rng = random.Random(12)
    passage, rows = prose(rng, 140), []
    for k in range(400):
        own = prose(rng, 60)
        rows += [(2 * k, f"{passage} {own}"), (2 * k + 1, f"{passage} {own.rsplit(' ', 8)[0]} {prose(rng, 8)}")]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(spark, rows), 2, 80).collect()}
    assert got == {k: k - k % 2 for k in range(800)}


def test_lines_of_rows_that_share_a_doc_id(spark):
    line = "this is the line that comes again and again"
    rows = [(1, line, "a", 1), (2, line + "\nown", "b", 2), (2, "another first line\nown", "c", 3), (None, "own\nx", "d", 4), (None, None, "e", 5), (3, "", "f", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, marks string, key int")
    got = sorted(map(tuple, line_dedup.without_repeated_lines(docs).collect()), key=lambda r: r[3])
    assert got == [(1, line, "a", 1), (2, "own", "b", 2), (2, "another first line\nown", "c", 3), (None, "x", "d", 4), (None, None, "e", 5), (3, "", "f", 6)]


@pytest.mark.parametrize("few", [64, 0])
def test_minhash_of_short_pairs_under_one_template(spark, monkeypatch, few):
    """30 shared words and 12 own ones, of which a pair differs in one; crowded lists go to the prefix filter."""
    monkeypatch.setattr(minhash, "FEW", few)
    rng = random.Random(13)
    template, rows = prose(rng, 30, "abcdefghijklmnopqrstuvw"), []
    for k in range(400):
        own = prose(rng, 12, "abcdefghijklmnopqrstuvw").split()
        rows += [(2 * k, f"{template} {' '.join(own)}"), (2 * k + 1, f"{template} {' '.join(own[:-1])} {prose(rng, 1)}")]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(spark, rows), 2, 80).collect()}
    sets = [minhash.shingles(minhash.words_of(t), 2) for _, t in rows]
    roots = brute_components(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    assert sum(roots[k] != k for k in range(800)) > 390 and got == dict(enumerate(roots))


def test_parities_bound_the_difference():
    rng = np.random.default_rng(3)
    for n in (1, 40, 700):
        a, b = (np.unique(rng.integers(0, 2**64, n, np.uint64)) for _ in range(2))
        b = np.union1d(b, a[: n // 2])
        differ = sum(int(x).bit_count() for x in (minhash.parities(a) ^ minhash.parities(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b)) and not (minhash.parities(a) ^ minhash.parities(a)).any()


def test_line_dedup_equals_all_pairs(spark):
    rng = random.Random(2)
    lines = [prose(rng, rng.randint(3, 14)) for _ in range(60)] + ["{", "", "日本語" * 12, "x" * 300]
    for _ in range(80):
        s = list(rng.choice(lines[:60]))
        for _ in range(rng.randint(0, 3)):
            s[rng.randrange(len(s))] = "z"
        lines.append("".join(s))
    rows = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 8)))) for k in range(50)] + [(900, None), (None, lines[0]), (901, lines[63] + "\n" + lines[63])]
    docs = docs_of(spark, rows)
    got = {(r.doc_id, r.line_no): (r.kept, r.first_doc_id, r.first_line_no) for r in line_dedup.line_decisions(docs).collect()}
    places = sorted(((i, k, x) for i, t in rows for k, x in enumerate((t or "").split("\n"))), key=lambda p: (p[0] is None, p[0] or 0, p[1]))
    sets = [{x[k : k + 8] for k in range(len(x) - 7)} for _, _, x in places]
    long_ = [k for k, p in enumerate(places) if p[2].strip()]
    for k in long_:
        sets[k] = sets[k] or {places[k][2]}
    roots = brute_components(len(places), [(a, b) for a in long_ for b in long_ if b < a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9])
    want = {(i, n): (roots[k] == k, *places[roots[k]][:2]) for k, (i, n, _) in enumerate(places)}
    assert got == want
    out = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(docs).collect()}
    assert out == {i: t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if want[i, n][0]) for i, t in rows}
    assert line_dedup.line_decisions(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("template", [30, 50, 70])
def test_line_dedup_of_many_families_under_one_template(spark, template, monkeypatch):
    """Pairs of near copies whose bands mostly hold unrelated lines; the brute force takes all pairs."""
    monkeypatch.setattr(lists, "BLOCK", 1 << 12)
    monkeypatch.setattr(line_dedup, "FEW", 8)
    rng = random.Random(template)
    shared = prose(rng, 40)[: 2 * template]
    lines = []
    for _ in range(300):
        own = prose(rng, 60)[: 2 * (100 - template)]
        lines += [f"{shared} {own}", f"{shared} {own[:-9]}{prose(rng, 4)[:9]}"]
    order = list(range(len(lines)))
    rng.shuffle(order)
    got = {r.doc_id: r.first_doc_id for r in line_dedup.line_decisions(docs_of(spark, [(k, lines[j]) for k, j in enumerate(order)])).collect()}
    sets = [{lines[j][k : k + 8] for k in range(len(lines[j]) - 7)} for j in order]
    roots = brute_components(len(lines), [(a, b) for a in range(len(lines)) for b in range(a) if len(sets[a] & sets[b]) >= 0.85 * len(sets[a] | sets[b])])
    joined = [k for k in range(len(lines)) if roots[k] != k]
    assert len(joined) > 250 and sum(got[k] == roots[k] for k in joined) >= 0.99 * len(joined)
    assert sum(got[k] != k for k in range(len(lines))) <= 300


def test_line_dedup_of_short_lines(spark):
    rows = [(1, "Les.\n\n  \n句子很短\nshort line 1"), (2, "Les.\n\n  \n句子很短\nshort line 2"), (3, "Les\nthis is a short line\nthis is a short lin"), (4, "this is a short line.")]
    got = {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no) for r in line_dedup.line_decisions(docs_of(spark, rows)).collect() if not r.kept}
    assert got == {(2, 0): (1, 0), (2, 3): (1, 3), (3, 2): (3, 1), (4, 0): (3, 1)}


def test_pairs_of_lists_are_dropped_where_they_are_made(spark):
    rows = [(k, key, 1, c, 0, [key, *range(100 * (k % 2), 100 * (k % 2) + 15)]) for key, c in ((1, 4), (2, 40)) for k in range(c)]
    bands = spark.createDataFrame(rows, "node long, key long, n int, c long, low long, sig array<int>")
    got = set(map(tuple, lists.first_pairs(bands, 0.8, ["sig"], line_dedup.likely("sig", "_sig", 16)).collect()))
    plain = set(map(tuple, lists.first_pairs(bands, 0.8).collect()))
    assert got == {(a, b) for a, b in plain if (b - a) % 2 == 0} and {(0, 2), (1, 3)} <= got < plain


def test_signatures_are_short_and_in_the_order_of_long_hashes(spark):
    words = [f"{prose(random.Random(k), 12)}" for k in range(20)]
    lines = line_dedup.lines_of(docs_of(spark, list(enumerate(words))))
    signed = line_dedup.signed(lines)
    assert dict(signed.dtypes)["sig"] == "array<int>"
    assert all(list(r.sig) == sorted(set(r.sig)) and 0 < len(r.sig) <= line_dedup.SIGNED for r in signed.collect())


def test_parities_drop_no_similar_pair(spark):
    rng = random.Random(5)
    lines = [prose(rng, n) for n in (3, 20, 60, 200) for _ in range(6)]
    lines += [x[: len(x) - cut] + "z" * (cut // 2) for x in lines for cut in (2, 12, 40)] + ["", "short"]
    sets = [{x[k : k + line_dedup.WIDTH] for k in range(len(x) - line_dedup.WIDTH + 1)} for x in lines]
    rows = spark.createDataFrame(list(enumerate(lines)), "node long, line string").select("node", line_dedup.parities("line").alias("p"))
    held = {r.node: r.p for r in rows.collect()}
    assert [held[k].n for k in range(len(lines))] == [len(x) for x in sets]
    side = lambda x: rows.select(F.col("node").alias(x), F.col("p").alias(f"p{x}"))
    near = set(map(tuple, side("a").crossJoin(side("b")).where("a < b").where(line_dedup.near_parities("pa", "pb")).select("a", "b").collect()))
    pairs = [(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines)) if sets[a] | sets[b]]
    for a, b in pairs:
        differ = sum(bin((held[a][f"b{i}"] ^ held[b][f"b{i}"]) & (2**64 - 1)).count("1") for i in range(line_dedup.BITS // 64))
        assert differ <= len(sets[a] ^ sets[b])
    alike = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert alike and alike <= near and len(near) < len(pairs) / 2


def test_parities_over_rows_are_those_of_the_lines(spark):
    rng = random.Random(7)
    lines = [prose(rng, n) for n in (2, 20, 60, 200, 500) for _ in range(4)] + ["", "short", "x" * 50, "日本語" * 12]
    rows = spark.createDataFrame(list(enumerate(lines)), "node long, line string")
    want = {r.node: tuple(r.p) for r in rows.select("node", line_dedup.parities("line").alias("p")).collect() if len(lines[r.node]) >= line_dedup.WIDTH}
    assert {r.node: tuple(r.p) for r in line_dedup.with_parities(rows).collect()} == want


def test_parities_tell_long_lines_apart(spark):
    """Lines of 900 characters at Jaccard 0.7: sets that differ in more elements than 256 classes can show."""
    rng = random.Random(11)
    base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(900))
    lines = [base] + [base[:740] + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(160)) for _ in range(5)]
    bits = line_dedup.with_parities(spark.createDataFrame(list(enumerate(lines)), "node long, line string"))
    side = lambda x: bits.select(F.col("node").alias(x), F.col("p").alias(f"p{x}"))
    assert side("a").crossJoin(side("b")).where("a < b").where(line_dedup.near_parities("pa", "pb")).isEmpty()


def test_line_dedup_is_native(spark, monkeypatch):
    """Every table that is written on the way and the result come from plans without Python."""
    plans, write = [], line_dedup.written

    def noted(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args)

    for module in (line_dedup, lists, components):
        monkeypatch.setattr(module, "written", noted)
    rng = random.Random(3)
    template = prose(rng, 10)
    out = line_dedup.without_repeated_lines(docs_of(spark, [(k, f"{template} {prose(rng, 10)}") for k in range(100)]))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 10
    assert not any(x in p for p in plans for x in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian"))


def test_suffix_sort_orders_suffixes():
    rng = random.Random(6)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 60))).encode() for _ in range(200)]
    offsets = np.array([rng.randrange(len(p)) for p in parts])
    order = suffix_dedup.SuffixSorter(parts, offsets).sort()
    got = [parts[k][offsets[k] :] for k in order]
    assert got == sorted(got)


def brute_repeats(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + 200] for b in data for k in range(len(b) - 199))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("sorted_kinds", "paired"), [(20_000, 64), (20_000, 3), (3, 64)])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, sorted_kinds, paired):
    monkeypatch.setattr(suffix_dedup, "SORTED", sorted_kinds)
    monkeypatch.setattr(suffix_dedup, "PAIRED", paired)
    rng = random.Random(8)
    passage = prose(rng, 90)
    texts = [None, "", "a" * 450, "ab" * 250, "a" * 199, "a" * 201, "é" * 300, "x" + "é" * 160, passage]
    texts += [f"{prose(rng, rng.randint(0, 50))} {passage[rng.randint(0, 120):]} {prose(rng, rng.randint(0, 50))}" for _ in range(40)]
    base = prose(rng, 150)
    texts += [near_copies(rng, base, rng.randint(0, 6)) for _ in range(12)]
    rows = [*enumerate(texts), (None, passage), (3, "ab" * 250)]
    got = sorted(map(tuple, suffix_dedup.remove_repeats(docs_of(spark, rows)).collect()), key=str)
    want = sorted(((i, *x) for (i, _), x in zip(rows, brute_repeats([t for _, t in rows]))), key=str)
    assert got == want
    clash = docs_of(spark, rows).withColumnsRenamed({"lang": "ranges", "score": "k", "n_chars": "salt", "source": "row"})
    assert sorted(suffix_dedup.without_repeats(clash).select("doc_id", "text").collect(), key=str) == sorted(suffix_dedup.without_repeats(docs_of(spark, rows)).select("doc_id", "text").collect(), key=str)
    kept = {r.doc_id: r for r in suffix_dedup.without_repeats(docs_of(spark, rows)).collect()}
    assert len(kept) == len({i for i, _ in rows}) and kept[0].text is None and kept[4].text == ""[:0] + kept[4].text and kept[1].n == 7
    assert suffix_dedup.remove_repeats(docs_of(spark, [])).count() == 0


def test_long_text_in_blocks(monkeypatch):
    rng = random.Random(1)
    text = prose(rng, 3000).encode()
    data = np.frombuffer(text, np.uint8)
    whole = [s for s in suffix_dedup.segments(data)]
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    parts = [s for s in suffix_dedup.segments(data)]
    cover = lambda ss: sum(int(s[3].sum()) for s in ss)
    assert cover(whole) == cover(parts) == len(data) - 199


def test_multi_index_equals_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 16))
    near = [base[k % 20] + rng.normal(size=16) * s for k, s in enumerate(rng.uniform(0, 0.25, 200))]
    vectors = [*base, *near, *[base[0]] * 30, base[1] * 3]
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(vectors)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15), (904, []), (905, [1.0, 2.0]), (906, [2.0, 4.0])]
    df = spark.createDataFrame([(k, v, "c") for k, v in rows], "vec_id long, embedding array<float>, label string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in multi_index.near_vectors(df).collect()}
    x = np.array([v for _, v in rows[: len(vectors)]], np.float32).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.95
    np.fill_diagonal(hit, False)
    roots = brute_components(len(x), list(zip(*np.nonzero(hit))))
    found = sum(got[k][0] for k in range(len(x)))
    assert found <= hit.sum() and found >= 0.98 * hit.sum() and found % 2 == 0
    assert np.mean([got[k][1] == roots[k] for k in range(len(x))]) > 0.98
    assert all(got[k] == (0, k, True) for k in range(900, 905)) and got[905] == (1, 905, True) and got[906] == (1, 905, False)
    assert multi_index.near_vectors(df.limit(0)).count() == 0


def test_multi_index_counts_links_from_both_ends(spark):
    """Many pairs at the threshold: a link counts at both ends or at none, whoever visited whom."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(1500, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    step = rng.normal(size=base.shape)
    step -= (step * base).sum(1, keepdims=True) * base
    step /= np.linalg.norm(step, axis=1, keepdims=True)
    x = np.concatenate([base, 0.9501 * base + np.sqrt(1 - 0.9501**2) * step]).astype(np.float32)
    df = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in multi_index.near_vectors(df).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.95
    np.fill_diagonal(hit, False)
    assert sum(got[k].n_links for k in got) >= 0.98 * hit.sum()
    for k in range(1500):
        if hit[k].sum() == hit[k + 1500].sum() == 1 and hit[k, k + 1500]:
            assert got[k].n_links == got[k + 1500].n_links and (got[k + 1500].component_id == k) == (got[k].n_links == 1)


def test_traversal_is_nearest_first():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = multi_index.MultiIndex(x, 6, 0.95, 0.99)
    a, b = index.distances(x[:50])
    for p, q in zip(a, b):
        cost = (p[:, None] + q[None, :]).ravel()
        got = index.visits(p, q)
        assert np.allclose(np.sort(cost)[: len(got)], cost[got]) and (cost <= cost.min() + index.margin).sum() == len(got)


def test_imatch_edits_and_order(spark):
    rng = random.Random(4)
    texts = {k: prose(rng, rng.randint(20, 200)) for k in range(80)} | {80: "", 81: None, 90: "same text", 91: "same text"}
    got = {r.doc_id: r for r in imatch.fingerprint_documents(docs_of(spark, list(texts.items()))).collect()}
    ids = sorted(texts, reverse=True)
    for i, j in zip(ids, ids[1:] + ids[:1]):
        text, other, r = texts[i] or "", texts[j] or "", got[i]
        n = len(text) // 3
        edited = text[: len(text) - n] + other[:n]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and (edited != text or r.near_edited == 1)
    assert got[90].fingerprint == got[91].fingerprint and got[91].near_next == 1
    long_ = [r for r in got.values() if r.n_chars > 300]
    assert np.mean([r.near_edited > r.near_next for r in long_]) > 0.95
    alone = imatch.fingerprint_documents(docs_of(spark, [(5, "one text only")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1
    assert imatch.fingerprint_documents(docs_of(spark, ODD)).count() == len(ODD)
    assert imatch.fingerprint_documents(docs_of(spark, [])).count() == 0


def labelled(seed=1, n=400):
    rng = random.Random(seed)
    insults = ["gropnik", "dulvaster", "mizzeker"]
    rows, labels = [], []
    for k in range(n):
        text = prose(rng, 60, "abcdefghijklmnoprstu")
        toxic, good = int(k % 8 == 0), int(k % 5 > 0)
        if toxic:
            words = text.split()
            words.insert(rng.randrange(len(words)), rng.choice(insults))
            text = " ".join(words)
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split())
        rows.append((k, text, f"s{k % 3}"))
        labels.append((k, good, toxic))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = labelled()
    rows += [(1000, None), (1001, ""), (None, "gropnik"), (1002, "you g-r-o-p-n-i-k"), (1003, "a gropnnik"), (1004, "x" * 100_000)]
    docs, table = docs_of(spark, rows), spark.createDataFrame([*labels, (None, 1, 1), (1000, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, toxicity.fit(docs, table)).collect()}
    assert len(got) == len(rows)
    for k, _, toxic in labels:
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0)
    held = [(got[k].predicted, t) for k, _, t in labels if got[k].held_out]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert got[1000].predicted == 0 and got[1001].predicted == 0 and got[1002].predicted == 1 and got[1003].predicted == 1
    assert toxicity.fit(docs, table.limit(0)) is None
    assert toxicity.score_documents(docs.limit(0), None).count() == 0
    kept = toxicity.keep_clean(docs, toxicity.fit(docs, table))
    assert kept.columns == docs.columns and 0.8 * len(rows) < kept.count() < len(rows)


def test_toxicity_scores_equal_plain_sums(spark):
    """Scores of the workers against a plain sum over the words of a text."""
    rows, labels = labelled(4, 160)
    docs = docs_of(spark, rows + [(900, "gropnik " * 50), (901, None)])
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    for k, text, _ in rows[:40]:
        decided = [float(model.decide([w])[0]) for w in toxicity.units(text)]
        evidence = np.array([max(0.0, max(decided)), np.log1p(sum(d > 0 for d in decided)), 10 * sum(d > 0 for d in decided) / max(10, len(decided)), 1.0])
        assert abs(got[k] - 1 / (1 + np.exp(-np.dot(model.calibration, evidence)))) < 1e-4


def test_folded_weights_equal_the_kernel():
    words = ["gropnik", "banana", "bandana", "xyz", "abcabcabc"]
    marks = toxicity.Landmarks(words[:3])
    alpha = np.array([0.5, -1.0, 2.0])
    model = toxicity.Model(marks, np.linalg.lstsq(marks.map, alpha, rcond=None)[0], 0.0)
    assert np.allclose(model.decide(words), np.clip(marks.kernel(words) @ alpha, -3, 3), atol=1e-5)

    def slow(a, b):
        def phi(w):
            out = Counter()
            for i in range(len(w)):
                for j in range(i + 1, min(len(w), i + toxicity.SPAN)):
                    for k in range(j + 1, min(len(w), i + toxicity.SPAN)):
                        out[w[i] + w[j] + w[k]] += toxicity.DECAY ** (k - i + 1)
            return out

        norm = lambda w: np.linalg.norm(toxicity.DECAY ** np.array([k - i + 1.0 for i in range(len(w)) for j in range(i + 1, min(len(w), i + toxicity.SPAN)) for k in range(j + 1, min(len(w), i + toxicity.SPAN))]))
        x, y = phi(a), phi(b)
        return sum(v * y[u] for u, v in x.items()) / norm(a) / norm(b)

    assert np.allclose(marks.kernel(words), [[slow(a, b) for b in words[:3]] for a in words])


def test_cotraining_on_held_out_rows(spark):
    rows, labels = labelled(2)
    unlabelled = [(2000 + k, t, s) for k, (_, t, s) in enumerate(labelled(3)[0])]
    docs = docs_of(spark, rows + unlabelled + [(5000, None), (None, ""), (5001, "y" * 50_000)])
    table = spark.createDataFrame([*labels, (5000, None, 1)], "doc_id long, quality int, toxic int")
    model = cotraining.fit(docs, table)
    got = {r.doc_id: r for r in cotraining.score_documents(docs, model).collect()}
    assert len(got) == len(rows) + len(unlabelled) + 3
    held = [(got[k].kept, bool(q)) for k, q, _ in labels if got[k].held_out]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert cotraining.fit(docs, table.limit(0)) is None
    assert cotraining.score_documents(docs.limit(0), None).count() == 0


def test_cotraining_scores_equal_plain_views(spark):
    """The margins that the workers add up word by word are those of the two views."""
    rows, labels = labelled(5, 150)
    docs = docs_of(spark, rows)
    model = cotraining.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r for r in cotraining.score_documents(docs, model).collect()}
    for k, text, source in rows:
        margins = cotraining.margin(model.text, cotraining.text_view(text, text.split(), {})), cotraining.margin(model.meta, cotraining.metadata_view(text, "en", source))
        assert np.allclose((got[k].text_score, got[k].metadata_score, got[k].score), model.scores(*map(float, margins)), atol=1e-3)


def test_imatch_fingerprints_equal_brute_force(spark):
    """Lexicon, subsets and hashes by a plain reading of the method."""
    rng = random.Random(14)
    texts = {k: prose(rng, rng.randint(5, 80), "abcde") for k in range(60)}
    docs = docs_of(spark, list(texts.items()))
    terms = {k: set(t.split()) for k, t in texts.items()}
    counts = Counter(t for ts in terms.values() for t in ts)
    lexicon = {t for t, c in counts.items() if 0.05 * 60 <= c <= 0.5 * 60}
    assert set(imatch.choose_lexicon(docs, 0.05, 0.5)) == lexicon and 20 < len(lexicon) < len(counts)
    tool = imatch.Lexicon(lexicon)
    for r in imatch.fingerprint_documents(docs, 0.05, 0.5).collect():
        known = sorted(terms[r.doc_id] & lexicon)
        digest = lambda ts, n: hashlib.blake2b("\n".join(ts).encode(), digest_size=n // 2).hexdigest() if ts else "-" * n
        want = digest(known, 16) + "".join(digest([t for t in known if j in tool[t]], 4) for j in range(len(imatch.LIMITS)))
        assert not known or r.fingerprint == want


def test_cotraining_sees_the_whole_of_long_words():
    rng = np.random.default_rng(3)
    model = cotraining.Model(rng.normal(size=cotraining.DIMENSIONS + cotraining.FORMS + 1).astype(np.float32), np.zeros(1), np.zeros(3), [])
    head = "日本語の文章" * 12
    words = [head + "良い頁です" * 30, head + "悪い頁です" * 30]
    views = [cotraining.text_view(w, [w], {})[: cotraining.DIMENSIONS] for w in words]
    assert not np.allclose(*views) and abs(model.word(words[0]) - model.word(words[1])) > 1e-3
    assert all(np.isclose(v @ model.text[: cotraining.DIMENSIONS], model.word(w), atol=1e-4) for v, w in zip(views, words))


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rows, labels = labelled(7, 200)
    rows += [(1000 + k, rows[3][1], "s") for k in range(5)] + [(2000, rows[1][1] + "\nan own line that is long enough to be compared"), (3000, None), (3001, "")]
    docs = docs_of(spark, rows).drop("score", "n")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, before = spark.read.parquet(f"{tmp_path}/documents.parquet"), None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minhash_near_dedup", "suffix_array_dedup", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.written(stage(spark, docs, str(tmp_path)), name)
        if k < 4:
            assert out.columns == docs.columns
            assert {r.doc_id for r in out.select("doc_id").collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "toxicity":
            left, toxic = {r.doc_id for r in out.collect()}, {i for i, _, t in labels if t}
            assert not left & toxic and len({i for i, _, t in labels if not t} - left) <= 4
        if name == "line_dedup":
            assert out.count() == docs.count()
            texts = {r.doc_id: r.text for r in out.collect()}
            assert texts[1000] == "" and texts[2000] == "an own line that is long enough to be compared" and texts[3000] is None
        docs = out
    assert docs.where("length > 0").count() == docs.count() > 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """Null and repeated ids, null, empty and repeated texts, clashing column names, an empty table."""
    import corpus_pipeline

    rows, labels = labelled(8, 120)
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rng = random.Random(5)
    a, b = prose(rng, 40), prose(rng, 40)
    odd = [(1, a), (5, a), (5, b), (None, a), (None, None), (6, ""), (6, None), (7, "x"), (7, "x"), (8, " \n\t"), (9, "é" * 400)]
    names = ["row", "key", "marks", "k", "salt", "ranges", "node", "root", "_doc"]
    docs = spark.createDataFrame([(i, t, "s", len(t or ""), *[n] * len(names)) for n, (i, t) in enumerate(odd)], "doc_id long, text string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path)).collect()
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        if name == "packing":
            assert {r.doc_id for r in out} == {i for i, _ in odd} and sum(r.length for r in out if r.start == 0) >= len(odd)
            continue
        got = sorted(((r.row, r.doc_id, r.text) for r in out), key=lambda r: r[0])
        assert list(out[0].asDict()) == docs.columns
        if name == "toxicity":
            assert got == [(n, i, t) for n, (i, t) in enumerate(odd)]
        if name == "line_dedup":
            lines = {1: "", 3: ""}
            assert got == [(n, i, lines.get(n, t)) for n, (i, t) in enumerate(odd)]
        if name == "minhash_near_dedup":
            assert got == [(n, i, t) for n, (i, t) in enumerate(odd) if n not in (1, 3)]
        if name == "suffix_array_dedup":
            cut = brute_repeats([t for _, t in odd])
            assert [len((t or "").encode()) for _, _, t in got] == [n - gone for n, gone, _, _ in cut]
