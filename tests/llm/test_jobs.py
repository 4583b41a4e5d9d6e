"""Operators that shuffle, against brute force on small tables."""

import base64
import gzip
import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from riskloom.llm import catalog, decontaminate, minhash, packing, pii, quality, secrets, sharding, suffix, tokens, warc
from riskloom.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- near duplicates -----------------------------------------------------------------


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(zip(*(w[i:] for i in range(k)), strict=False)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def groups(rows, k, percent=80):
    """Smallest id of each row's component, by comparing all pairs that share a shingle."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for pair in {(a, b) for v in holders.values() for a in v for b in v if a < b}:
        a, b = (sets[i] for i in pair)
        if 100 * len(a & b) >= percent * len(a | b):
            parent[find(pair[0])] = find(pair[1])
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), doc), doc)
    return [(doc, len(s), low[find(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))]


def edited(base, n, edits, seed):
    """Copies of a text, each with its own random words put in."""
    rnd, out = random.Random(seed), []
    for c in range(n):
        w = base.split()
        for _ in range(edits):
            w[rnd.randrange(len(w))] = f"e{c}x{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_components(documents, odd, k, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)  # several blocks a star
    rnd = random.Random(5)
    base = " ".join(f"w{rnd.randrange(3000)}" for _ in range(200))
    rows = [(1000 + i, t) for i, t in enumerate(edited(base, 40, 4, 1) + edited(base[::-1], 40, 9, 2))]
    rows += [(-1, ""), (-2, None), (-3, "One"), (-4, "one"), (-5, " \n"), (-6, "a b"), (-6, "a b"), (-6, "another text under one id")]
    docs = odd(documents.limit(150), rows).repartition(5)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in minhash.report(docs, shingle_words=k).collect())
    assert got == sorted(groups([(r.doc_id, r.text) for r in docs.collect()], k))


def test_blocks_of_different_roots_meet(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rnd = random.Random(8)
    rows = [(star, 100 * star + i, 10, rnd.choice([0, 0, 0, 1, 1, *range(2, 9)])) for star in range(3) for i in range(60)] + [(9, 900 + i, 10, 5) for i in range(20)]
    met = defaultdict(set)
    for r in minhash.meetings(spark.createDataFrame(rows, "star long, node long, n long, root long")).collect():
        assert r.x_group != r.y_group or r.x_group == -1  # two blocks of one root do not meet
        met[tuple(r[:5])].add(r.node)
    for star in (0, 1, 2):
        mine = [r for r in rows if r[0] == star]
        assert all(any({a[1], b[1]} <= m for m in met.values()) for a in mine for b in mine if a[3] < b[3])
    assert not any(k[0] == 9 for k in met)  # one component


def test_a_stray_does_not_multiply_its_star(spark):
    star = spark.range(100_000).select(F.lit(0).cast("long").alias("star"), F.col("id").alias("node"), F.lit(50).cast("long").alias("n"), (F.col("id") == 77_777).cast("long").alias("root"))
    assert minhash.meetings(star).count() == 99_999 + 391 + 1  # each member once, the stray once a block and in its own


def test_blocks_of_long_texts_are_small(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 1000)
    rows = [(0, i, 500, i % 2) for i in range(40)]
    met = minhash.meetings(spark.createDataFrame(rows, "star long, node long, n long, root long"))
    assert met.groupBy("x_group", "x_block").agg(F.countDistinct("node").alias("n")).count() == 10
    assert met.where("x_group = -1").isEmpty()


def test_components_of_nothing(empty):
    assert minhash.report(empty).count() == 0
    assert minhash.deduplicate(empty).count() == 0


def test_one_row_of_each_group_stays_as_it_was(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(3, text, "a", 1.5), (3, text, "b", None), (2, text + " more", "c", 2.5), (None, text, "d", 0.0), (9, None, "e", 1.0), (9, None, "f", 1.0), (8, "", "x0", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, z string, x0 double")
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=lambda r: r[2]) == sorted([rows[2], *rows[4:]], key=lambda r: r[2])


def test_signature_estimates_similarity():
    rnd = np.random.Generator(np.random.PCG64(1))
    same, a, b = (rnd.integers(1 << 63, size=n, dtype=np.uint64) for n in (800, 100, 100))
    x, y = minhash.signature(np.concatenate([same, a]), 4000), minhash.signature(np.concatenate([same, b]), 4000)
    assert abs((x == y).mean() - 0.8) < 0.05  # also where most bins are empty and densified


def test_intersections_in_stretches(monkeypatch):
    monkeypatch.setattr(minhash, "_STRETCH", 7)
    rnd = np.random.Generator(np.random.PCG64(2))
    sets = [np.unique(rnd.integers(60, size=n)).astype(np.uint64) for n in (5, 30, 40, 1)]
    both = minhash.intersections(sets)
    assert all(both[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(4) for j in range(4) if i != j)


# --- packing -------------------------------------------------------------------------


def test_fill_is_the_best(spark):
    rnd = random.Random(3)
    for capacity in (10, 50):
        for _ in range(100):
            counts = {rnd.randint(1, capacity): rnd.randint(1, 4) for _ in range(4)}
            used = packing.closest_fill(capacity, sorted(counts, reverse=True), counts)
            sums = {0}
            for k, v in counts.items():
                sums = {s + k * i for s in sums for i in range(v + 1) if s + k * i <= capacity}
            assert sum(k * v for k, v in used.items()) == max(sums) and all(used[k] <= counts[k] for k in used)


@pytest.mark.parametrize("counts", [{5: 1}, {3000: 1000}, {4095: 7, 1: 3}, {2048: 5, 1024: 1, 100: 2}, {17: 900, 4000: 100, 81: 3}, {}])
def test_plan_places_each_token_once(counts):
    plan, held = packing.Plan(counts), defaultdict(list)
    for length, n in counts.items():
        for i in range(n):
            at = 0
            for start, size, sequence, offset in plan.place(length, i):
                assert start == at and size > 0
                at += size
                held[sequence].append((offset, size))
            assert at == length
    padding = 0
    for pieces in held.values():
        end = 0
        for offset, size in sorted(pieces):
            assert offset == end
            end += size
        assert end <= 4096
        padding += 4096 - end if end & (end - 1) else 0
    assert padding == 0


def test_packing_query(documents, odd, empty):
    docs = odd(documents, [(-1, ""), (-2, None), (-3, "One <|endoftext|>x　y\x1cz  é Σας İ it's"), (-4, "a b " * 9000), (-5, " \n")])
    out = packing.pack(docs, chunk_rows=50).collect()
    library = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for r in docs.collect():
        ids, at = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4"), 0
        for p in sorted(by_doc[r.doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        end = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        assert end == 4096 or end & (end - 1) == 0
    assert packing.pack(empty).count() == 0


# --- archives ------------------------------------------------------------------------


def test_archive_round_trip(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet").withColumn("payload", F.lit("clash"))
    odd = [(-5, "u\n v", "", "x"), (-4, None, None, "x"), (10**6, "http://a", "dup", "x"), (10**6 + 1, "http://b", "dup", "x"), (None, "http://c", "dup", "x")]
    pages = pages.unionByName(spark.createDataFrame(odd, "page_id long, url string, html string, payload string"))
    root = scratch_path(spark, "test-warc")
    manifest = warc.write(pages.repartition(3), root, roll_bytes=20_000)
    assert manifest.count() > 1 and manifest.agg(F.sum("records")).first()[0] == pages.count()
    got = {r.page_id: r for r in warc.read(spark, root).collect()}
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    first = {}
    for i, html in rows:
        if i is not None:
            first[html] = min(first.get(html, i), i)
    for i, html in rows:
        r, response = got[i], first[html] == i
        assert (r.payload_bytes, r.payload_digest) == (len(html), base64.b32encode(hashlib.sha1(html).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if response else ("revisit", first[html]))
        assert (bytes(r.payload) == html) if response else r.payload is None
    assert not [f for f in os.listdir(root) if f.startswith("_temporary")]


def test_archives_do_not_depend_on_the_layout(spark, sf_small):
    """Equal names and bytes from any partitions, with and without adaptive plans; nothing temporary is left."""
    pages, made, before = spark.read.parquet(f"{sf_small}/pages.parquet"), [], {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for parts, adaptive in ((2, "true"), (8, "false"), (211, "true")):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            root = scratch_path(spark, "test-warc")
            os.makedirs(root)
            open(f"{root}/_temporary-00000000-77", "w").close()  # of a failed attempt
            names = sorted(r.file for r in warc.write(pages.repartition(parts % 5 + 1), root, roll_bytes=8_000).collect())
            made.append({n: open(f"{root}/{n}", "rb").read() for n in names})
            assert sorted(n for n in os.listdir(root) if not n.startswith((".", "_manifest"))) == names
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert made[0] == made[1] == made[2] and len(made[0]) > 5


def test_archive_of_nothing(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- repeated strings ----------------------------------------------------------------


@pytest.mark.parametrize("class_contexts, range_starts, stretch", [(1, 4096, 1 << 20), (3, 37, 1 << 20), (4096, 4096, 1 << 20), (4096, 100, 250)])
def test_repeats(documents, odd, class_contexts, range_starts, stretch):
    random.seed(3)
    base = "".join(random.choice("abcdefgh ") for _ in range(900))
    rows = [(-1, ""), (-2, None), (-3, "a" * 1000), (-4, "ab" * 150 + "c"), (-5, base[:450] + "X" + base[100:700]), (-6, "é" * 30 + base[200:640])]
    rows += [(-7, base[:399]), (-8, base[:400]), (-9, "xyz" * 300), (-10, "q" * 399), (-11, "w" * 400), (-11, "w" * 400), (-12, "v" * 401), (-13, base[300:])]
    docs = odd(documents.limit(120), rows)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.remove_repeats(docs, class_contexts=class_contexts, shard_bytes=20_000, range_starts=range_starts, stretch=stretch).collect())
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    count = Counter(t[i : i + 400] for _, t in texts for i in range(len(t) - 399))
    want = []
    for doc, t in texts:
        cover = bytearray(len(t))
        for i in range(len(t) - 399):
            if count[t[i : i + 400]] > 1:
                cover[i : i + 400] = b"\1" * 400
        kept = bytes(x for x, c in zip(t, cover, strict=True) if not c)
        runs = sum(1 for i, c in enumerate(cover) if c and (i == 0 or not cover[i - 1]))
        want.append((doc, len(t), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)


def test_long_texts_that_repeat_themselves(spark):
    """Runs of one byte and of short periods, 10 MB together: bounded contexts, nothing kept."""
    texts = ["a" * 6_000_000, "abcdefg" * 400_000, "xyz" * 400_000 + "!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in suffix.remove_repeats(docs).collect()}
    assert [(got[i].n_removed, got[i].n_spans) for i in range(2)] == [(len(t), 1) for t in texts[:2]]
    assert (got[2].n_removed, got[2].n_spans, got[2].kept_sha256) == (len(texts[2]) - 1, 1, hashlib.sha256(b"!").hexdigest())
    value, first, last, _ = suffix.long_ranges(texts[0].encode(), 400, 64, 4096, 1 << 20)
    assert len(set(value.tolist())) == 1 and int((last - first).max()) < 4096
    assert first[0] == 0 and last[-1] == len(texts[0]) - 400 and (first[1:] == last[:-1] + 1).all()


def test_no_repeats_in_nothing(empty):
    assert suffix.remove_repeats(empty).count() == 0


def test_suffix_array_and_prefixes():
    rnd = np.random.Generator(np.random.PCG64(4))
    for letters in (1, 2, 5):
        data = rnd.integers(97, 97 + letters, 300).astype(np.uint8)
        sa, key = suffix.suffix_array(data, 64)
        raw = data.tobytes()
        assert [raw[i : i + 64] for i in sa] == sorted(raw[i : i + 64] for i in range(300))
        first, count = np.array([0, 150]), np.array([100, 80])
        starts = np.concatenate([np.arange(0, 100), np.arange(150, 230)])
        order = sa[np.isin(sa, starts)]
        lcp = suffix.neighbours_share(data, key, order, first, count, 20)
        for a, b in zip(order, order[1:], strict=False):
            n = 0
            while n < 20 and b + n < 300 and a + n < 300 and raw[a + n] == raw[b + n]:
                n += 1
            assert lcp[b] == n or max(a, b) + 20 > 300


def test_passages_that_end_their_document_make_no_false_copies():
    rnd = random.Random(6)
    raw = lambda n: bytes(rnd.choices(b"abcd", k=n))
    passages = [raw(rnd.randint(400, 520)) for _ in range(300)]
    bodies = [raw(20) + p for p in passages] + [raw(20) + p + raw(60) for p in passages]
    bodies += [x for p in (raw(512) for _ in range(100)) for x in (p + b"a" + raw(40), b"z" + p + b"b" + raw(40))]  # agree in 512 bytes
    rnd.shuffle(bodies)
    count = Counter(b[i : i + 400] for b in bodies for i in range(len(b) - 399))
    for b, flags in zip(bodies, suffix.copies_in_shard(bodies, [1] * len(bodies), 400), strict=True):
        assert flags.tolist() == [count[b[i : i + 400]] > 1 for i in range(len(b) - 399)]


# --- contamination -------------------------------------------------------------------


def test_leaks(spark, documents, odd, empty):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    b = items.orderBy("item_id").first().text.split()
    rows = [(-1, ""), (-2, None), (-3, " ".join(b[3:])), (-4, "zz " + " ".join(b[:-1]) + " qq ww"), (-5, " ".join(b[:-2] + ["zz"] + b[-2:])), (-6, "well Hello world foo")]
    rows += [(-7, " ".join(b)), (-7, "the same id without a leak"), (None, "x " + " ".join(b))]
    docs = odd(documents, rows)
    items = items.unionByName(spark.createDataFrame([(9001, "hello world"), (9002, None), (9003, ""), (9004, "hello world")], items.schema))
    held = {}
    for r in items.collect():
        w = WORD.findall((r.text or "").lower())
        k = min(5, len(w))
        if w:
            held[r.item_id] = (len(w), k, Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)))
    want = []
    for r in docs.collect():
        w, found = WORD.findall((r.text or "").lower()), []
        for i, (n, k, c) in held.items():
            for s in range(max(1, len(w) - n + 1)):  # every window
                x = w[s : s + n]
                d = Counter(tuple(x[q : q + k]) for q in range(len(x) - k + 1))
                both = sum((d & c).values())
                if both and both >= 0.8 * (sum(d.values()) + sum(c.values()) - both):
                    found.append(i)
                    break
        want.append((r.doc_id is None, r.doc_id, sorted(found)))
    got = decontaminate.report(docs, items).collect()
    key = lambda x: (x[0], x[1] or 0, x[2])
    assert sorted(((r.doc_id is None, r.doc_id, r.item_ids) for r in got), key=key) == sorted(want, key=key)
    kept = decontaminate.without_leaks(docs, items)
    assert kept.columns == docs.columns and kept.count() == sum(not f for *_, f in want)
    assert decontaminate.report(empty, items).count() == 0
    assert not any(r.leaked for r in decontaminate.report(documents, items.limit(0)).collect())


def test_leaks_of_items_with_repeated_shingles(spark):
    """Against every window: repeated shingles in items, some of them missing or moved in the documents."""
    rnd = random.Random(12)
    word = lambda n: [f"t{rnd.randrange(10**6)}" for _ in range(n)]
    items, docs = [], []
    for i in range(12):
        refrain = word(5 + i % 4)
        body = [*refrain, *word(30), *refrain * (i % 5), *word(20), *refrain * 2]
        items.append((i, " ".join(body)))
        for j in range(12):
            copy = list(body)
            for _ in range(rnd.randrange(5)):
                at = rnd.randrange(len(copy))
                copy[at : at + rnd.randrange(3)] = word(rnd.randrange(3))
            if j % 3 == 0 and i % 5:  # a refrain less
                copy = copy[: 5 + i % 4 + 30] + copy[2 * (5 + i % 4) + 30 :]
            docs.append((1000 * i + j, " ".join([*word(rnd.randrange(30)), *copy, *word(rnd.randrange(30))])))
    held = {}
    for i, t in items:
        w = t.split()
        held[i] = (len(w), Counter(tuple(w[q : q + 5]) for q in range(len(w) - 4)))
    want = set()
    for d, t in docs:
        w = t.split()
        for i, (n, c) in held.items():
            for s in range(max(1, len(w) - n + 1)):
                x = w[s : s + n]
                k = Counter(tuple(x[q : q + 5]) for q in range(len(x) - 4))
                both = sum((k & c).values())
                if both >= 0.8 * (sum(k.values()) + sum(c.values()) - both):
                    want.add((d, i))
                    break
    assert 30 < len(want) < 140
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_an_item_with_ten_equal_shingles_is_found(spark):
    """Similarity 0.8 and more where only repetitions differ: 40 documents, none is missed."""
    rnd = random.Random(5)
    item = ["la"] * 14 + [f"u{i}" for i in range(80)]  # one shingle ten times
    docs = [(d, " ".join([*(f"v{rnd.randrange(10**6)}" for _ in range(30)), *["la"] * 4, *item[14:], *(f"v{rnd.randrange(10**6)}" for _ in range(20))])) for d in range(40)]
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = decontaminate.report(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert all(r.leaked for r in got) and len({r.similarity for r in got}) == 1 and 0.8 <= got[0].similarity < 0.9


def test_hamming_blocks(spark):
    """Pairs within the radius, and the distances at similarity 0.8."""
    rnd = random.Random(3)
    rows, items = [], []
    for i, n in enumerate([9, 18, 27, 45, 90, 180, 360] * 40):  # so many features, a ninth of them others: similarity 0.8
        x = [rnd.getrandbits(62) for _ in range(n)]
        items.append((i, n, x))
        rows.append((i, n, [*x[: n - n // 9], *(rnd.getrandbits(62) for _ in range(n // 9))]))
    prints = lambda r, key: decontaminate.fingerprints(decontaminate.counted(spark.createDataFrame(r, f"{key} long, length long, shingles array<long>"), key), [key, "length"])
    windows, targets = prints(rows, "window").cache(), prints(items, "item").cache()
    got = {tuple(r) for r in decontaminate.near(windows, targets).collect()}
    bits = lambda df, key: {r[key]: (r.length, [r[f"f{j}"] & (1 << 64) - 1 for j in range(decontaminate.WORDS)]) for r in df.collect()}
    w, t = bits(windows, "window"), bits(targets, "item")
    apart = {(a, b): sum((x ^ y).bit_count() for x, y in zip(w[a][1], t[b][1], strict=True)) for a in w for b in t if w[a][0] == t[b][0]}
    assert got == {p for p, d in apart.items() if d <= decontaminate.RADIUS} == {(i, i) for i in w}
    same = np.array([apart[i, i] for i in w])
    assert same.mean() + 5 * same.std() < decontaminate.RADIUS and same.max() < decontaminate.RADIUS - 10
    windows.unpersist(), targets.unpersist()


# --- shards --------------------------------------------------------------------------


def least_capacity(sizes, shards):
    def fits(c):
        n, held = 1, 0
        for s in sizes:
            if held + s > c:
                n, held = n + 1, 0
            held += s
        return n <= shards

    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def minimax_shards(sizes, capacity):
    out, held = [], 0
    for k, x in enumerate(sizes):
        if held and held + x > capacity:
            out.append(k - 1)
            held = 0
        held += x
    return [*out, len(sizes) - 1]


@pytest.mark.parametrize("n, shards, split_cells", [(5, 3, 256), (300, 40, 256), (1500, 40, 16), (1, 40, 256), (50_000, 40, 256), (250_000, 40, 256), (50_000, 7, 8)])
def test_capacity_is_the_least(spark, monkeypatch, n, shards, split_cells):
    """Few and many groups of long-tailed sizes; what a round sends to the driver is bounded."""
    rnd = np.random.Generator(np.random.PCG64(n + shards))
    h = np.unique(rnd.integers(-(1 << 63), (1 << 63) - 1, n))
    sizes = np.minimum(16 + 300 * rnd.pareto(1.1, len(h)), 122_000).astype(np.int64) if n > 2000 else rnd.choice([1, 5, 1000, 40_000], len(h))
    groups_ = spark.createDataFrame(pd.DataFrame({"h": h, "bytes": sizes})).repartition(4).cache()
    sent, split = [], sharding._split
    monkeypatch.setattr(sharding, "_split", lambda g, c: sent.append(len(c)) or split(g, c))
    cuts, capacity = sharding.minimax_cuts(groups_, shards, split_cells)
    assert capacity == least_capacity(sizes.tolist(), shards) and len(cuts) <= shards
    assert cuts == h[minimax_shards(sizes.tolist(), capacity)].tolist()
    assert max(sent, default=0) <= split_cells and len(sent) <= 60
    groups_.unpersist()


def test_shards(spark, documents, odd, empty):
    rows = [(-1, ""), (-2, None), (-3, None)] + [(5000 + i, "one very common text " * 40) for i in range(150)]
    docs = odd(documents, rows)
    out = sharding.assign(docs, chunk_rows=40).collect()
    texts, of = {r.doc_id: r.text for r in docs.collect()}, defaultdict(set)
    slots = defaultdict(list)
    for r in out:
        t = texts[r.doc_id]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "bytes", None)
        of[t].add(r.shard)
        slots[r.shard].append(r.slot)
    assert len(out) == docs.count() and all(len(x) == 1 for x in of.values())
    assert set(slots) <= set(range(40)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    hot = sum(r.size for r in out if r.doc_id >= 5000)
    loads = Counter()
    for r in out:
        loads[r.shard] += r.size
    rest = sorted(loads.values())[:-1]
    assert max(loads.values()) == hot and len(loads) == 40 and max(rest) < 2 * sum(rest) / len(rest)
    assert sharding.assign(empty).count() == 0


# --- pipeline and registered queries -------------------------------------------------


def test_pipeline_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_dedup", "decontamination", "personal_data", "packing"]
    from riskloom.llm import quality
    from riskloom.llm.common import materialize

    good = materialize(stages["quality_rules"](spark, docs, sf_small), "test-stage")
    verdict = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, k in verdict.items() if k} and good.columns == docs.columns
    once = materialize(stages["near_dedup"](spark, good, sf_small), "test-stage")
    want = {low for _, _, low in groups([(r.doc_id, r.text) for r in good.collect()], 5)}
    assert sorted(r.doc_id for r in once.collect()) == sorted(want) and once.columns == docs.columns
    clean = materialize(stages["decontamination"](spark, once, sf_small), "test-stage")
    leaked = {r.doc_id for r in decontaminate.report(once, items).where("leaked").collect()}
    assert {r.doc_id for r in clean.collect()} == want - leaked and leaked
    hidden = materialize(stages["personal_data"](spark, clean, sf_small), "test-stage")
    assert hidden.count() == clean.count() and hidden.columns == docs.columns
    assert hidden.where("n_chars <> char_length(text)").count() == 0
    packed = stages["packing"](spark, hidden, sf_small)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == want - leaked


INSIDE = (
    "row", "node", "class", "context", "v_id", "v_host", "v_lines", "v_key", "r_id", "r_text", "host", "lines", "kept", "l_id", "l_key", "window", "item", "s", "z", "w", "a", "b", "m", "n", "h",
    "bytes", "shard", "chunk", "local", "size", "token", "length", "start", "spans", "first", "last", "own", "text_key", "text_id", "sha", "words", "root", "star", "band", "c", "x",
)


@pytest.fixture(scope="module")
def clashing(documents, odd):
    """A table with columns named as the operators name their own, and a very long text."""
    rnd = random.Random(9)
    words = [f"q{rnd.randrange(5000)}" for _ in range(60_000)]
    plain = odd(documents.limit(40), [(-1, ""), (-2, None), (-3, " ".join(words)), (-4, " ".join(words[:300])), (-4, " ".join(words[:300]))])
    wide = plain
    for c in INSIDE:
        wide = wide.withColumn(c, F.col("doc_id"))
    return plain.cache(), wide.cache()


OPERATORS = {
    "tokens": lambda d, items: tokens.count_tokens(d), "minhash": lambda d, items: minhash.report(d), "pii": lambda d, items: pii.report(d), "packing": lambda d, items: packing.pack(d).groupBy("doc_id").agg(F.sum("length").alias("length")),
    "quality": lambda d, items: quality.judge(d).drop("lines"), "suffix": lambda d, items: suffix.remove_repeats(d), "secrets": lambda d, items: secrets.report(d),
    "decontaminate": decontaminate.report, "sharding": lambda d, items: sharding.assign(d).drop("slot"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_with_names_used_inside(spark, clashing, sf_small, name):
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    made = [sorted(map(repr, map(tuple, OPERATORS[name](d, items).collect()))) for d in clashing]
    assert made[0] == made[1] and made[0]


@pytest.mark.parametrize("name", [k for k, _ in corpus_pipeline.STAGES])
def test_stages_with_names_used_inside(spark, clashing, sf_small, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    plain, wide = (stage(spark, d, sf_small) for d in clashing)
    if name == "packing":
        return
    assert wide.columns == [*plain.columns, *INSIDE]
    assert sorted(map(repr, map(tuple, wide.select(*plain.columns).collect()))) == sorted(map(repr, map(tuple, plain.collect())))
    assert wide.where("not (v_id <=> doc_id)").count() == 0


def test_catalog_names():
    numbers = sorted(int(k[2:].split("_")[0]) for k in catalog.QUERIES)
    assert numbers == list(range(1, 14))
