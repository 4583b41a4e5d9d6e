"""Divergence audit, resampling and chat formatting against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskloom.llm import chat, divergence, resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- source divergence -----------------------------------------------------------------


def audit(rows, min_docs, top):
    """(lang, source, part, item, value, rank) by the definition, over all kept terms."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs, occ, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source, found = lang or "", source or "", term.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        docs[lang].update(set(found))
        occ[lang, source].update(found)
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        every = sum((occ[g] for g in groups if g[0] == lang), Counter())

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        mine, f = shares(occ[lang, source]), lambda p, q: (p - q) ** 2 // (p + q)
        pair = []
        for other in (s for g, s in groups if g == lang and s != source):
            theirs = shares(occ[lang, other])
            pair.append((other, sum(f(mine[t], theirs[t]) for t in kept)))
        whole = shares(every)
        terms = [(t, f(mine[t], whole[t])) for t in kept if occ[lang, source][t] and mine[t] > whole[t]]
        for part, items, most in (("pair", pair, len(pair)), ("term", terms, top)):
            for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                out.append((lang, source, part, item, value, rank))
    return sorted(out)


def odd_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang", "source").limit(120)
    rnd = random.Random(2)
    words = [f"{w}{'' if rnd.random() < 0.5 else '.'}" for w in ("alpha", "Beta", "gamma", "Éta", "ÉTA", "x-ray", "don't") for _ in range(6)]
    rows = [(None, None, None, None), (-1, "", "", ""), (-2, "solo", "qq", "only"), (-3, None, "zz", "a"), (-3, None, "zz", "a"), (-4, "a\x00b 😀c\x1fd\x7fe 3f_g", None, "b")]
    rows += [(1000 + i, " ".join(rnd.choices(words, k=5)), "xx", f"s{i % 4}") for i in range(30)]
    rows += [(2000, "wörd " * 900_000 + "Wörd,wörd", "xx", "long"), (2001, "y" * 300_000, "xx", "long"), (2002, "p,q;" * 30_000, "xx", "long")]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema))


@pytest.mark.parametrize("task_chunks", [50, 2_000_000])
def test_divergence(spark, sf_small, task_chunks):
    docs = odd_documents(spark, sf_small)
    for c in ("chunk", "term", "n", "row", "ids", "value", "p"):  # names that are used inside
        docs = docs.withColumn(c, docs.doc_id)
    got = divergence.audit(docs.repartition(5), min_docs=4, top=6, task_chunks=task_chunks)
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert sorted(map(tuple, got.collect())) == audit(rows, 4, 6)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_divergence_writes_no_rare_chunks(spark, monkeypatch):
    rows = [(" ".join([f"q{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j)}x" for j in range(20)] + ["common", "Common,", "(common"]), "en", f"s{i % 3}") for i in range(200)]
    rows += [("edge edge, edge. almost", "en", "s0")] * 9 + [("edge; (edge) none", "en", "s1")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    written, write = [], divergence.materialize
    monkeypatch.setattr(divergence, "materialize", lambda df, name: written.append(write(df, name)) or written[-1])
    monkeypatch.setattr(divergence, "release", lambda table: None)
    got = sorted(map(tuple, divergence.audit(docs).collect()))
    assert got == audit(rows, 10, 10)
    assert {r[3] for r in got if r[2] == "term"} <= {"common", "edge"}
    assert sum(t.count() for t in written) < 100  # 4,000 chunks stand in one document each


def test_divergence_of_nothing(empty):
    assert divergence.audit(empty.selectExpr("*", "text as lang")).count() == 0


# --- resampling ------------------------------------------------------------------------


def test_crc_of_spans():
    rnd = np.random.Generator(np.random.PCG64(3))
    data = rnd.integers(0, 256, 60_000).astype(np.uint8)
    sizes = [1, 2, 63, 64, 65, 127, 128, 129, 192, 1000, 4097, 20_000, 3, *range(5, 60)]
    first = np.cumsum([0, *sizes[:-1]])
    last = first + sizes
    assert resample.span_crcs(data, first, last).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(first, last, strict=True)]
    assert resample._long_crc(data) == zlib.crc32(data.tobytes())
    assert resample._length_constant(200_001) == zlib.crc32(bytes(200_001))


def grams(text, words):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return [" ".join(w[i : i + k]) for k in range(1, words + 1) for i in range(len(w) - k + 1)], len(w)


@pytest.mark.parametrize("words", [1, 2, 3])
def test_features_in_stretches(monkeypatch, words):
    rnd = random.Random(1)
    texts = ["", " ", "One", "é1 " * 40, "x" * 500, " ".join(rnd.choice(["a", "Bb", "cé", "d" * 90, "--"]) for _ in range(300)), "end"]
    want = [Counter(zlib.crc32(g.encode()) % 97 for g in grams(t, words)[0]) for t in texts]
    for stretch in (16, 100, 1 << 20):
        monkeypatch.setattr(resample, "STRETCH", stretch)
        got, single = [Counter() for _ in texts], 0
        for of, bucket, n in resample.features([t.encode() for t in texts], words, 97):
            single += n
            for i, b in zip(of.tolist(), bucket.tolist(), strict=True):
                got[i][b] += 1
        assert got == want and single == sum(grams(t, 1)[1] for t in texts)


@pytest.mark.parametrize("words, buckets, percent", [(1, 10_000, 10), (2, 50, 35)])
def test_resampling(spark, sf_small, documents, odd, words, buckets, percent):
    rows = [(None, "w " * 30), (-1, ""), (-2, None), (-3, "Tie " * 25), (-3, "Tie " * 25), (-3, "tie " * 25 + "more"), (-5, "é" * 200_000 + " " + "z" * 3_000_000), (-6, "A1 b2 " * 200_000)]
    docs = odd(documents, rows)
    for c in ("bucket", "n", "weight", "eligible", "place", "part"):
        docs = docs.withColumn(c, docs.doc_id)
    target = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    got = resample.resample(docs.repartition(3), target, words=words, buckets=buckets, percent=percent).collect()
    held = [(r.doc_id, *grams(r.text, words)) for r in docs.collect()]
    of = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = Counter(of(g) for _, f, _ in held for g in f), Counter(of(g) for r in target.collect() for g in grams(r.text, words)[0])
    S, T = sum(s.values()), sum(t.values())  # noqa: N806
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    want = []
    for i, f, n in held:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[of(g)] for g in f)
        want.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 20])
    last = lambda x: (x is None, x or 0)
    order = sorted((x for x in want if x[4]), key=lambda x: (-x[3], last(x[0]), -x[2], -x[1]))
    ranks = [(*x[:4], k if k <= percent * len(order) // 100 else None) for k, x in enumerate(order, 1)]
    ranks += [(*x[:4], None) for x in want if not x[4]]
    key = lambda r: tuple(last(x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(ranks, key=key)


def test_resampling_of_nothing(spark, empty, documents):
    target = spark.createDataFrame([], "text string")
    assert resample.resample(empty, target).count() == 0
    assert resample.resample(documents, target).count() == documents.count()


# --- chat ------------------------------------------------------------------------------

MARKS = re.compile(r"<~*/?s>|\[~*(?:/?INST|IMG|AUDIO|DOC)\]")


def guarded(text):
    return MARKS.sub(lambda m: m[0][0] + "~" + m[0][1:], text)


def test_chat(spark, sf_small):
    rnd = random.Random(4)
    bits = ["<", "[", "~", "/", "s>", "INST]", "IMG]", "</s>", "<s>", "[INST]", "[/INST]", "<~s>", "[~~/INST]", "[DOC]", "\n", "é😀", " ok ", "$1", "\\"]
    rows = [(9000 + i, k, rnd.choice(["user", "assistant", "system", "t[INST]</s>ool", None, ""]), rnd.choice([None, "", "".join(rnd.choices(bits, k=rnd.randint(1, 30)))])) for i in range(60) for k in range(rnd.randint(1, 6))]
    rows += [(None, 0, "user", "no id"), (None, None, "assistant", "no turn"), (7000, 1, "assistant", "same"), (7000, 1, "assistant", "same"), (7000, 1, "assistant", "other")]
    rows += [(7001, 0, "assistant", "</s>" * 200_000 + "~" * 500_000)] + [(7002, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(5000)]
    plain = spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text")
    talk = plain.unionByName(spark.createDataFrame(rows, plain.schema))
    for c in ("parts", "head", "content", "formatted", "mask", "turns"):
        talk = talk.withColumn(c, talk.conv_id)
    by = defaultdict(list)
    for r in talk.collect():
        role, text = r.role or "", r.text or ""
        piece = f"[INST]{guarded(role)}[/INST]{guarded(text)}</s>"
        by[r.conv_id].append(((r.turn is not None, r.turn or 0, piece.encode()), role, text, piece))
    sha, want = lambda t: hashlib.sha256(t.encode()).hexdigest(), []
    for i, turns in by.items():
        turns = [x[1:] for x in sorted(turns)]
        loss = "".join(t for r, t, _ in turns if r == "assistant")
        want.append((i, len(turns), sha("".join(f"{r}\n{t}\n" for r, t, _ in turns)), len(loss), sha(loss), 3 + sum(len(p) for *_, p in turns)))
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(map(tuple, chat.report(talk.repartition(4)).collect()), key=key)
    assert got == sorted(want, key=key)


def test_chat_parts(spark):
    part = lambda kind, text=None, ref=None, **size: (kind, text, ref, size.get("width"), size.get("height"), size.get("seconds"), size.get("pages"))
    rows = [
        (1, 0, "user", [part("text", "look: [IMG] "), part("image", None, "a.png", width=56, height=29), part("text", " and "), part("audio", None, "b.wav", seconds=2.1)]),
        (1, 1, "assistant", [part("document", "unused", "c.pdf", pages=3), part("other", "as text</s>"), part(None, None)]),
        (2, 0, "user", None), (2, 1, "user", [part("image", None, None)]), (3, 0, None, []),
    ]
    made = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")).collect()}
    assert made[1].formatted == "<s>[INST]user[/INST]look: [~IMG] [IMG] and [AUDIO]</s>[INST]assistant[/INST][DOC]as text<~/s></s>"
    assert [tuple(a) for a in made[1].attachments] == [(0, 1, "image", "a.png", 4), (0, 3, "audio", "b.wav", 27), (1, 0, "document", "c.pdf", 1536)]
    assert made[1].expanded_tokens == 4 + 27 + 1536 and [m.loss_chars for m in made[1].mask] == [0, 17]
    assert made[2].formatted == "<s>[INST]user[/INST]</s>[INST]user[/INST][IMG]</s>" and [tuple(a) for a in made[2].attachments] == [(1, 0, "image", None, 1)]
    assert (made[3].formatted, made[3].attachments, made[3].expanded_tokens) == ("<s>[INST][/INST]</s>", [], 0)


def test_chat_of_nothing(spark):
    assert chat.report(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_escaping_holds_no_control_string(spark):
    rnd = random.Random(8)
    texts = ["".join(rnd.choices(["<", "[", "~", "/", "s>", "INST]", "AUDIO]"], k=12)) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, e, back in rows.select("t", chat.escape(rows.t).alias("e"), chat.unescape(chat.escape(rows.t)).alias("b")).collect():
        assert back == t and e == guarded(t)
        assert not re.search(r"</?s>|\[(/?INST|IMG|AUDIO|DOC)\]", e)
