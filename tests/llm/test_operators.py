"""The training-data operators on small tables: brute force, round trips and edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayguard.llm import (fixity, licences, packing, parity_join, pii, repetition, sampled_pieces, template_html, topk,
                          toxicity)
from dayguard.llm.queries import REGISTRY, TOKENIZERS

DOCS = "doc_id long, text string, score double, n int, doc string"  # extra columns whose names the operators use inside


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, 0.5, 1, "x") for i, t in texts], DOCS)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


EDGE = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "null id"),
        (6, "long " * 30_000), (7, prose(1, 200)), (8, "é 😀 İ   x")]


# 1
@pytest.fixture(scope="module")
def pieces_model():
    return sampled_pieces.model(f"{TOKENIZERS}/piece_bpe_32k.model")


def test_samples_are_distinct_ordered_and_decode(spark, pieces_model):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")
    for i, text in enumerate(["the cat  sat\n\non 😀 é", "a", "", " ", "\t", prose(3, 60)]):
        got = sampled_pieces.sample(pieces_model.lattices(text), 4, np.random.default_rng(i))
        assert len({tuple(x[0]) for x in got}) == len(got) >= 1
        assert all(a[2] >= b[2] for a, b in itertools.pairwise(got))
        assert all(pieces_model.decode(x[0]) == text == sp.decode(x[0]) and 0 < x[3] <= 1 for x in got)


def test_sampling_follows_the_lattice(pieces_model):
    lattice = pieces_model.lattices("than e")

    def every(c=0, i=0, ids=(), p=0.0):
        if c == len(lattice):
            yield ids, p
        elif i == len(lattice[c]):
            yield from every(c + 1, 0, ids, p)
        else:
            for k, j in enumerate(lattice[c][i][1]):
                yield from every(c, j, ids + lattice[c][i][2][k], p + lattice[c][i][3][k])

    exact = dict(every())
    assert math.isclose(sum(map(math.exp, exact.values())), 1, rel_tol=1e-9)
    n, first, second = 4000, collections.Counter(), collections.Counter()
    for s in range(n):
        a, b = sampled_pieces.sample(lattice, 2, np.random.default_rng(s))
        first[tuple(a[0])] += 1
        second[tuple(b[0])] += 1
    for ids in sorted(exact, key=exact.get)[-2:]:
        p = math.exp(exact[ids])
        q = sum(math.exp(v) * p / (1 - math.exp(v)) for k, v in exact.items() if k != ids)
        assert abs(first[ids] / n - p) < 0.02 and abs(second[ids] / n - q) < 0.03


def test_encode_edges(spark):
    df = docs_of(spark, [(1, None), (2, ""), (3, "a b"), (3, "a b")])
    rows = sampled_pieces.encode(df, F.col("doc_id"), F.col("text"), f"{TOKENIZERS}/piece_bpe_32k.model", k=3).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r["key"]].append((r["sample"], tuple(r["ids"])))
    assert "1" not in by and by["2"] == [(0, ())] and len(by["3"]) == 2 * len(set(by["3"]))


# 2
def test_topk_brute_force(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=(300, 8)) * r.choice([0.1, 1, 5], 300)[:, None]
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(base)] + [(300, [0.0] * 8, "x"), (301, None, "x"), (302, [None] * 8, "x"),
            (303, [float("nan")] * 8, "x"), (350, [1.0, 2.0], "x"), (351, [2.0, 2.0], "x"), (7, [float(x) for x in base[7]], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").where(topk.usable(F.col("embedding")))
    got = topk.search(df.select("vec_id", topk.quantised(F.col("embedding")).alias("v")), F.col("vec_id") % 50 == 0, 5)
    got = [tuple(x) for x in got.orderBy("query_id", "rank").collect()]
    m = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v, _ in rows if v and None not in v and np.isfinite(v).all()}
    want = []
    for q in sorted(k for k in m if k % 50 == 0):
        s = sorted((-int(m[q] @ v), i) for i, v in m.items() if i != q and len(v) == len(m[q]))[:5]
        want += [(q, k + 1, i, -x) for k, (x, i) in enumerate(s)]
    assert got == want


def test_bucket_pruning_keeps_every_hit():
    r = np.random.default_rng(5)
    p = r.integers(-300, 300, (500, 6)) * r.integers(1, 20, 500)[:, None]
    q = r.integers(-300, 300, (40, 6))
    pid, qid = np.arange(500), np.arange(1000, 1040)
    for share in (0.2, 0.9, 0.999, 1.0):
        s = q @ p.T
        bound = np.quantile(s, share, axis=1)
        a, b, got = topk.search_bucket(q, qid, bound, p, pid, 5)
        for i in range(40):
            want = sorted((-int(x), j) for j, x in enumerate(s[i]) if x >= bound[i])[:5]
            assert sorted((-int(x), int(j)) for k, j, x in zip(a, b, got) if k == i) == want


def test_topk_empty(spark):
    df = spark.createDataFrame([], "vec_id long, v array<long>")
    assert topk.search(df, F.col("vec_id") % 50 == 0).count() == 0


# 3
def test_chunk_ids_equal_the_tokenizer():
    e = packing.encoder(f"{TOKENIZERS}/word_bpe_49k.json")
    for t in ["The, cat's 12.5 don't!!", "a <|endoftext|> b", "É é ﬁ I'm\tx y  ", "", "abc... x.,", "İx ΑΣ, ß", "a1, b2. C3;", "x\x1cy"]:
        assert e.text(t) == e.whole(t)


def test_packing_is_whole_and_tight(spark):
    df = docs_of(spark, [*EDGE, *((100 + i, prose(i, 5 + 37 * (i % 60))) for i in range(300))])
    rows = packing.pack(packing.pieces(df, f"{TOKENIZERS}/word_bpe_49k.json")).collect()
    e = packing.encoder(f"{TOKENIZERS}/word_bpe_49k.json")
    want = collections.Counter()
    for r in df.collect():
        raw = e.text(r["text"]) + (1).to_bytes(4, "little")
        for k, at in enumerate(range(0, len(raw) // 4, 4096)):
            cut = raw[4 * at:4 * at + 16384]
            want[(r["doc_id"], k, at, len(cut) // 4, zlib.crc32(cut))] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    seqs = collections.defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 4096
    plain = packing.Plan(collections.Counter(r["length"] for r in rows), share=0.0)  # best fit alone
    assert len(seqs) <= 1.005 * plain.sequences + 1


def test_plan_on_hard_histograms():
    for h in ({}, {4096: 5}, {1: 3}, {2049: 7}, {1366: 9, 1365: 9}, {1000: 1, 3096: 1}):
        plan = packing.Plan(h)
        used = collections.Counter()
        for n, r, c, s, at in plan.runs().tolist():
            assert at + n <= 4096
            used[n] += c
        assert used == collections.Counter(h)
    assert packing.Plan({2049: 7}).sequences == 7 and packing.Plan({1000: 1, 3096: 1}).sequences == 1


def test_packing_empty(spark):
    assert packing.pack(packing.pieces(spark.createDataFrame([], DOCS), f"{TOKENIZERS}/word_bpe_49k.json")).count() == 0


# 4
def test_fixity_audit(spark):
    rows = [(i, f"http://a/{i}", "<html>" + "x" * (i * 37 % 5000)) for i in range(2000)] + [(None, None, None), (2001, "u", "")]
    p = spark.createDataFrame(rows, "record_id long, url string, html string")
    idx = lambda body: fixity.index(p.select("record_id", fixity.warc_record(F.col("url"), F.col("record_id"), body).alias("bytes")), 512)
    a = idx(F.col("html"))
    assert fixity.audit(a, a).count() == 0
    b = idx(F.when(F.col("record_id").isin(5, 1999), F.lit("<html>").cast("string")).otherwise(F.col("html")))
    hurt = F.when(F.col("record_id") == 700, F.expr("overlay(html placing '!' from 1 for 1)")).otherwise(F.col("html"))
    whole, p = p, p.where("record_id IS NULL OR record_id <> 1300")  # lost: all later records of the file move up
    c = idx(hurt)
    p = whole
    got = {(r["record_id"], r["status"]) for r in fixity.audit(a, c).collect()}
    assert got == {(700, "changed"), (1300, "missing")}
    assert {r["status"] for r in fixity.audit(c, a).collect()} == {"changed", "extra"}
    assert fixity.audit(a, b).where("record_id = 5").count() >= 1
    assert fixity.audit(a.where("false"), a.where("false")).count() == 0


def test_fixity_of_repeated_negative_and_missing_ids(spark):
    def idx(rows):
        return fixity.index(spark.createDataFrame([(i, t.encode(), 1, "x") for i, t in rows], "record_id long, bytes binary, part int, digest_ string"), 4)
    rows = [(i, f"r{i}" * 9000) for i in range(40)] + [(-7, "minus"), (-700, "far"), (None, "n1"), (None, "n2"), (None, "n2"), (3, "again"), (3, "again")]
    a = idx(rows)
    lost = [r for r in rows if r != (None, "n1")]
    lost.remove((3, "again"))
    lost = [(i, t + "!") if i in (-700, 20) else (i, t) for i, t in lost] + [(50, "new")]
    got = sorted(((r["record_id"], r["status"]) for r in fixity.audit(a, idx(lost)).collect()), key=repr)
    assert got == sorted([(None, "missing"), (3, "missing"), (-700, "changed"), (20, "changed"), (50, "extra")], key=repr)
    assert fixity.audit(a, idx(rows[::-1])).count() == 0
    deep = fixity.depth(a)
    assert fixity.tree(a, deep).where(F.col("level") == sum(deep)).count() == 1  # one root


# 5
def test_repetition_against_brute_force(spark):
    texts = [*EDGE, (20, "a b c d e f g h i j " * 30), (21, prose(4, 60) + "\n" + prose(4, 60) + "\n" + prose(5, 300)),
             (22, "same line of words\n" * 40), *((30 + i, prose(i, 80, 6)) for i in range(20))]
    got = repetition.judge(docs_of(spark, texts)).select("doc_id", "text", "quality.*").collect()
    assert len(got) == len(texts)
    for r in got:
        t = r["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        n = len(w)
        if n > 5000:
            continue

        def found(h):
            c = collections.Counter(tuple(w[i:i + h]) for i in range(n - h + 1))
            return [i for i in range(n - h + 1) if c[tuple(w[i:i + h])] > 1]

        def words(h):
            return len({i + j for i in found(h) for j in range(h)})

        seen, dup = set(), 0
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        longest = next((h - 1 for h in range(1, n + 2) if not found(h)), 0)
        assert (r["n_words"], r["n_repeat_words"], r["n_covered"], r["longest_repeat"], r["n_dup_lines"]) == (
            n, words(8), words(5), longest, dup)
        assert r["word_chars"] == sum(map(len, w)) and r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t))
        assert r["base_failed"] == (n < 20 or 100 * words(8) > 30 * n)
        assert r["kept"] == (not r["base_failed"] and 100 * words(5) <= 30 * n and longest <= 100)
        assert sum(s["end"] - s["start"] for s in r["spans"]) == words(5)


# 6
def jaccard_components(rows, spec):
    sets = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(parity_join.A_TO_Z))
        k = min(spec.width, len(w))
        if i is not None:
            sets.setdefault(i, {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and spec.den * len(x & y) >= spec.num * len(x | y):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("spec", [parity_join.JoinSpec(3, 90, 100), parity_join.JoinSpec(5, 80, 100)])
def test_join_against_brute_force(spark, spec):
    r = random.Random(9)
    rows = [(1, None), (2, ""), (3, "One two"), (4, "one  TWO"), (5, "one"), (6, prose(0, 3000, 900)), (None, "x")]
    for g in range(12):
        words = prose(g, r.choice([6, 20, 60, 300])).split()
        for k in range(12):
            w = list(words)
            for _ in range(k * len(w) // 100):
                w[r.randrange(len(w))] = f"n{r.randrange(999)}"
            rows.append((100 * (g + 1) + k, " ".join(w)))
    members, links = parity_join.join(docs_of(spark, rows), spec)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in members.collect()}
    assert got == jaccard_components(rows, spec)
    assert links.where("a >= b").count() == 0


@pytest.mark.parametrize("spec", [parity_join.JoinSpec(3, 90, 100), parity_join.JoinSpec(5, 80, 100)])
def test_join_gives_every_link(spark, spec):
    r = random.Random(21)
    rows = [(1, None), (2, "one two"), (3, "one TWO")]
    base = prose(77, 300, 900).split()
    for k in range(30):  # one group of near copies, most of whose links are inside one component
        w = list(base)
        for _ in range(k % 7):
            w[r.randrange(300)] = f"n{r.randrange(999)}"
        rows.append((r.randrange(10_000) * 100 + k, " ".join(w)))
    rows += [(2_000_000, rows[5][1]), (2_000_001, rows[5][1].upper())]  # copies are no links of different texts
    sets = {i: frozenset(zip(*(t.lower().split()[j:] for j in range(spec.width)))) for i, t in rows if i > 3}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    want = {(a, b) for a, b in itertools.combinations(sorted(first.values()), 2)
            if spec.den * len(sets[a] & sets[b]) >= spec.num * len(sets[a] | sets[b])}
    members, links = parity_join.join(docs_of(spark, rows), spec)
    assert sorted(tuple(x) for x in links.select("a", "b").collect()) == sorted(want) and len(want) > 60
    n = collections.Counter(itertools.chain(*want))
    got = {x["doc_id"]: (x["n_links"], x["component_id"]) for x in members.collect()}
    assert got == {i: (n[first[sets[i]]] if i in sets else 0, jaccard_components(rows, spec)[i][1]) for i, _ in rows}
    some, fewer = parity_join.component_join(docs_of(spark, rows), spec)
    assert {x["doc_id"]: x["component_id"] for x in some.collect()} == {i: c for i, (_, c) in got.items()}
    assert {tuple(x) for x in fewer.select("a", "b").collect()} <= want


def test_component_join_against_brute_force(spark):
    spec, r = parity_join.JoinSpec(3, 90, 100), random.Random(9)
    rows = [(1, None), (3, "One two"), (4, "one  TWO"), (6, prose(0, 3000, 900)), (None, "x")]
    for g in range(8):
        words = prose(g, r.choice([20, 60, 300])).split()
        for k in range(12):
            w = list(words)
            for _ in range(k * len(w) // 100):
                w[r.randrange(len(w))] = f"n{r.randrange(999)}"
            rows.append((100 * (g + 1) + k, " ".join(w)))
    members, _ = parity_join.component_join(docs_of(spark, rows), spec)
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in members.collect()} == jaccard_components(rows, spec)


def test_join_empty(spark):
    members, links = parity_join.join(spark.createDataFrame([], DOCS))
    assert members.count() == 0 and links.count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 102), (102, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in parity_join.components(edges).collect()}
    assert all(got[i] == 0 for i in range(51)) and {got[i] for i in (100, 101, 102)} == {100}


def test_join_sketches_few_texts_at_a_time():
    import pyarrow as pa
    texts = [" ".join(f"w{i}x{j}" for j in range(500)) for i in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    for made in (parity_join._summaries(parity_join.JoinSpec(5, 80, 100)), parity_join._sets(5)):
        sizes = [out.num_rows for out in made(iter([batch]))]
        assert sum(sizes) == 400 and max(sizes) <= 100


# 7
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 14 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(digits(m.group())) <= 15]
    return [(pii.KINDS[k], s, e) for s, k, e in sorted(out)]


def test_rules_against_plain_patterns():
    r = random.Random(1)
    for _ in range(5000):
        t = "".join(r.choice("ab1290.@.@+- ()%é") for _ in range(r.randrange(40)))
        assert pii.base_spans(t) == plain_spans(t)
    t = "pay 4539 1488 0343 6467, call +1 (555) 123-4567, a.b@c.de 10.0.255.1 10.0.256.1"
    assert [k for k, _, _ in pii.base_spans(t)] == [k for k, _, _ in plain_spans(t)] == ["card", "phone", "email", "ip"]
    assert pii.base_spans("9" * 50_000 + "a" * 50_000 + "@") == []


def test_gradients_by_differences():
    r = np.random.default_rng(0)
    p = {k: v.astype(float) for k, v in pii.new_params(3).items()}
    ids, tags = pii.training_windows(["call +1 (555) 123-4567 or a.b@c.de 10.2.3.4 " * 3], 4, 1)
    _, g = pii.gradients(p, ids, tags)
    for k in p:
        for _ in range(3):
            i = tuple(int(r.integers(n)) for n in p[k].shape)
            if k == "tr" and not pii.ALLOWED[i]:
                continue
            old, e = p[k][i], 1e-5
            p[k][i] = old + e
            up = pii.gradients(p, ids, tags)[0]
            p[k][i] = old - e
            down = pii.gradients(p, ids, tags)[0]
            p[k][i] = old
            assert math.isclose((up - down) / (2 * e), g[k][i], rel_tol=1e-4, abs_tol=1e-6)


def with_data(i):
    r = random.Random(i)
    card = "4539148803436467"
    some = [f"{prose(i, 1)}.{r.randrange(99)}@mail{r.randrange(9)}.example.org", f"+1 ({r.randrange(200, 999)}) {r.randrange(200, 999)}-{r.randrange(1000, 9999)}",
            card, f"10.{r.randrange(256)}.{r.randrange(256)}.7"]
    words = [w.replace("w", "word ") if r.random() < 0.05 else "abcdefgh"[r.randrange(3):r.randrange(4, 8)] for w in prose(i, 80).split()]
    for x in some:
        words.insert(r.randrange(len(words)), x)
    return " ".join(words)


def test_tagger_learns_held_out_spans_and_adds_variants(spark):
    texts = [(i, with_data(i)) for i in range(160)]
    df = docs_of(spark, texts)
    model = pii.fit(df, sample=160)
    fresh = [with_data(i) for i in range(1000, 1030)]
    alone = pii.added_spans(fresh, [[] for _ in fresh], model, 0.9)
    want = [pii.base_spans(t) for t in fresh]
    hit = sum(len(set(a) & set(b)) for a, b in zip(alone, want))
    assert hit >= 0.8 * sum(map(len, want))
    clean = [prose(i, 100).replace("w", "word ") for i in range(20)]
    assert sum(map(len, pii.added_spans(clean, [[] for _ in clean], model, 0.98))) == 0
    found = pii.find(docs_of(spark, [*EDGE, *texts[:20]]), model)
    rows = found.withColumn("red", pii.redacted(F.col("text"), F.col("pii"))).collect()
    assert len(rows) == len(EDGE) + 20
    for r in rows:
        assert [(x["kind"], x["start"], x["end"]) for x in r["pii"] if x["base"]] == plain_spans(r["text"] or "")
        if r["text"]:
            assert not plain_spans(r["red"])


def test_training_texts_are_different_whole_and_hold_spans(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(pii, "train", lambda ids, tags, seed: "model")
    keep = pii.training_windows
    monkeypatch.setattr(pii, "training_windows", lambda texts, most, seed: taken.append(texts) or keep(texts, most, seed))
    hot = [(i, f"copy {c} of 1 text") for c in range(20) for i in range(30 * c, 30 * c + 30)]
    assert pii.fit(docs_of(spark, [*hot, *((1000 + i, with_data(i)) for i in range(30))]), sample=40) == "model"
    assert len(set(taken[0])) == len(taken[0]) == 40 and sum(bool(pii.base_spans(t)) for t in taken[0]) >= 20
    long = ["word " * 9_000 + f"write to ann{i}@mail.example.org now " + "word " * 9_000 for i in range(3)]
    assert pii.fit(docs_of(spark, list(enumerate(long)))) == "model"
    assert all(len(t) <= 20_000 and "mail.example.org" in t for t in taken[1])
    ids, _ = keep(["9 " + "a" * 30 + " " + " ".join(f"{i} {'b' * 40}" for i in range(40)) + " z" * 40 + " 7 end"] * 20, 1_000, 1)
    first, _ = keep(["9 " + "a" * 30 + " " + " ".join(f"{i} {'b' * 40}" for i in range(12))] * 1, 1_000, 1)
    assert len({x.tobytes() for x in ids}) > 2 * len(first)  # not only the first 12 marks


def test_no_labelled_span(spark):
    df = docs_of(spark, [(1, "no data here"), (2, None)])
    assert pii.fit(df) is None and pii.find(df, None).where(F.size("pii") > 0).count() == 0


# 8
def test_licences(spark):
    mit, apache = "Released under the MIT License.", "x\nLicensed under the Apache License, Version 2.0.\ny"
    rows = [(1, "s/a/LICENSE", mit), (2, "s/a/b/c/f.txt", "plain"), (3, "s/a/b/LICENSE", apache), (4, "s/a/x.txt", None),
            (5, "s/z.txt", ""), (6, "s/a/b/c/g.txt", mit), (7, None, "plain"), (8, "s/a/LICENSE", mit), (9, "s/ab/q.txt", "plain"),
            (10, "s/a/w.txt", "you need a licence to fish here")]
    files = spark.createDataFrame([(*r, "x") for r in rows], "key long, path string, text string, licence string")
    got = {r["key"]: (r["licence"], r["how"], r["from_dir"]) for r in licences.scan(files.drop("licence")).collect()}
    assert got == {1: ("MIT", "own", None), 2: ("Apache-2.0", "inherited", "s/a/b"), 3: ("Apache-2.0", "own", None),
                   4: ("MIT", "inherited", "s/a"), 5: (None, "none", None), 6: ("MIT", "own", None), 7: (None, "none", None),
                   8: ("MIT", "own", None), 9: (None, "none", None), 10: ("MIT", "inherited", "s/a")}
    assert licences.scan(files.drop("licence").where("false")).count() == 0


def test_licences_without_a_gate_word_wrapped_and_whole(spark):
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    mit = (licences.TEXTS / "MIT.txt").read_text()
    rows = [(1, "s/a/f.c", f"plain\n{bsd}\nplain"), (2, "s/b/f.c", "# This work is licensed under\n# the GNU General Public\n# License, version 3.\ncode"),
            (3, "s/c/LICENSE.md", "Copyright 2020 Ann\n" + mit.replace("\n", " ")), (4, "s/c/d/f.c", "plain"),
            (5, "s/e/LICENCE", "Released under the MIT License."), (6, "s/e/f.c", "plain"), (7, "s/g/COPYING", (licences.TEXTS / "GPL-3.0.txt").read_text()),
            (8, "s/h/license.py", "Released under the MIT License."), (9, "s/h/f.c", "plain")]
    got = {r["key"]: (r["licence"], r["how"]) for r in licences.scan(spark.createDataFrame(rows, "key long, path string, text string")).collect()}
    assert got == {1: ("BSD", "own"), 2: ("GPL-3.0", "own"), 3: ("MIT", "own"), 4: ("MIT", "inherited"), 5: ("MIT", "own"),
                   6: ("MIT", "inherited"), 7: ("GPL-3.0", "own"), 8: ("MIT", "own"), 9: (None, "none")}


def test_licence_candidates_are_few_and_none_is_lost(spark):
    prose = "\n".join("the cat and the dog of this work may not be in the garden with you or by the public house " * 4 + f"row {i}" for i in range(12))
    texts = spark.createDataFrame([(1, prose), (2, f"{prose}\n# This work is licensed under\n# the GNU General Public\n# License, version 3.\n{prose}"),
                                   (3, ""), (4, None), (5, "Released under the MIT License."), (6, "x MIT.License 1.2.0 .. v"),
                                   (7, "\n".join(["the licence of this work and you may not be in or by the public with it"] * 200))], "key long, text string")
    spoken = licences.spoken_lines(texts)
    n, t = spoken.count(), licences.template_terms(spark, licences.TEMPLATES)
    seen = spoken.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = t.select("term").distinct().join(seen, "term", "left").select("term", (F.log(F.lit(n + 1.0) / (F.coalesce("df", F.lit(0)) + 1)) + 1).alias("idf"))
    tv, rarest = licences.weighted(t, idf), math.log(n + 1.0) + 1
    lines = texts.select("key", F.split("text", "\n").alias("lines"))
    measures = licences.measured(F.col("lines"), tv, idf, rarest)
    got = {r["key"]: r["runs"] for r in lines.select("key", "lines", measures.alias("m")).select(
        "key", licences.near_runs(F.col("lines"), F.col("m"), len(licences.TEMPLATES)).alias("runs")).collect()}
    assert got[1] == [] and got[3] == [] and not got[4] and len(got[2]) <= 6
    every = [(k, i, " ".join(r["lines"][i:i + w])) for r in lines.where("lines IS NOT NULL").collect() for k in [r["key"]]
             for i in range(len(r["lines"])) for w in range(1, licences.WRAP + 1) if i + w <= len(r["lines"])]
    rows = spark.createDataFrame([(j, 0, x) for j, (_, _, x) in enumerate(every)], "key int, line int, x string").select(
        "key", "line", licences.terms(F.col("x")).alias("terms"))
    reach = licences.cosines(rows, tv, idf, F.lit(rarest), licences.MIN_COSINE).collect()
    assert {every[r["key"]][0] for r in reach} >= {2, 5}
    assert all(every[r["key"]][2] in got[every[r["key"]][0]] for r in reach)


# 9
def test_maximal_segments_by_definition():
    r = random.Random(3)
    for _ in range(300):
        s = [r.choice([-2.0, -1.0, 1.0, 3.0]) for _ in range(r.randrange(1, 14))]

        def parts(lo, hi):  # the recursive definition: the best sum, then left and right of it
            best = max(((sum(s[a:b]), -(b - a), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0,))
            return parts(lo, best[2]) + [(best[2], best[3] - 1, best[0])] + parts(best[3], hi) if best[0] > 0 else []

        got = toxicity.maximal_segments(np.array(s))
        assert sum(x[2] for x in got) >= sum(x[2] for x in parts(0, len(s))) - 1e-9
        assert max((x[2] for x in got), default=0) == max((x[2] for x in parts(0, len(s))), default=0)
        assert all(a[1] < b[0] for a, b in itertools.pairwise(got))


def test_toxicity_separates(spark):
    r = random.Random(4)
    def text(i, bad):
        words = prose(i, 120, 900).replace("w", "word").split()
        words = ["".join("abcdefghij"[int(c)] if c.isdigit() else c for c in w) for w in words]
        for _ in range(4 if bad else 0):
            words.insert(r.randrange(len(words)), r.choice(["Idiot", "scum,", "morons"]))
        return " ".join(words)

    rows = [(i, text(i, i % 5 == 0)) for i in range(600)]
    df = docs_of(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 5 == 0), 1) for i in range(400)] + [(401, None, 1), (9999, 1, 1), (None, 1, 1)],
                                   "doc_id long, toxic int, text int")
    model = toxicity.fit(df.where("doc_id < 400"), labels)
    got = {x["doc_id"]: x["tox"] for x in toxicity.score(df.where("doc_id >= 400"), model).collect()}
    assert all((t["score"] >= 0.3) == (i % 5 == 0) for i, t in got.items())
    texts = dict(rows)
    for i, t in got.items():
        for p in t["passages"]:
            assert re.match("idiot|scum|moron", texts[i][p["start"]:p["end"]].lower())
    edge = toxicity.score(docs_of(spark, EDGE), model).select("tox.score").collect()
    assert len(edge) == len(EDGE) and all(0 <= x["score"] < 0.3 for x in edge)


def test_toxicity_without_rows(spark):
    model = toxicity.fit(spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs_of(spark, EDGE), model).where("tox.score > 0.3").count() == 0


def test_every_strong_token_has_a_weight(spark):
    some = lambda letters: ["".join(w) for w in itertools.islice(itertools.product(letters, repeat=4), 21_000)]
    clean, toxic = some("abcdefghijklm"), some("nopqrstuvwxyz")
    rows = [(i, " ".join([*(clean if i % 2 else toxic), *(["zap"] if i < 32 and i % 2 == 0 else []), "y" * (i + 1)])) for i in range(64)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(spark, rows), labels)
    assert set(clean) | set(toxic) | {"zap"} <= set(model.weights) and model.weights["zap"] > model.drift


# 10
def page(i, body, extra=""):
    return (f"<html><head><title>t</title><style>p{{}}</style><script>var x='</p>';</script></head><body><nav><ul><li><a href=/a>menu {i}</a></ul></nav>"
            f"<div class='cookie-notice'>we use cookies</div>{extra}<article><h1>Head &amp; {i}</h1>{body}<div class=note>Read more on our site</div></article>"
            f"<aside>side</aside><section id=comments><article class=comment><p>me too</p></article></section><form><p>mail</p></form><footer>&copy; x</footer></body></html>")


def test_main_text(spark):
    rows = [(i, f"http://h.example/{i}", page(i, f"<p>text  {i} one<br>two</p><p><b>open {i}<p>last")) for i in range(12)]
    rows += [(100, None, None), (101, "http://one.example/x", ""), (102, "u", "plain < 3 &lt;b&gt;"), (103, "http://solo.example", "<p>a<p>b<!-- c"),
             (0, "http://h.example/0", rows[0][2])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = collections.defaultdict(list)
    for r in template_html.main_text(df).collect():
        got[r["page_id"]].append(r["text"])
    assert got[3] == ["Head & 3\ntext 3 one two\nopen 3\nlast"]  # the constant note is template text
    assert len(got[0]) == 2 and len(set(got[0])) == 1
    assert (got[100], got[101], got[102], got[103]) == ([""], [""], ["plain < 3 <b>"], ["a\nb"])
    assert template_html.main_text(df.where("false")).count() == 0


def test_main_text_of_hosts_with_copies(spark):
    def at(host, i, head, body, menu=""):
        return i, f"http://{host}/{i}", f"<html><body>{menu}<article><h1>{head}</h1><p>By Ann</p>{body}</article></body></html>"

    rows = [at("mirror", i, "Head", "<p>one</p><div class=para>two</div>") for i in range(7)]
    rows += [at("menus", 100 + i, "Head", "<p>one</p>", f"<nav>menu {i}</nav>") for i in range(7)]
    rows += [at("shared", 200 + i, "Daily", f"<p>text {i}</p>") for i in range(8)]
    rows += [at("near", 300 + i, "Head", f"<p>one</p><p>two</p><p>{i} views</p>") for i in range(6)]
    note = "<div class=note>Read more</div>"
    rows += [at("paths", 400 + i, f"Head {i}", f"<p>text {i}</p>{note}" + ("<div class=quote>Read more</div>" if i == 3 else "")) for i in range(8)]
    rows += [(500 + i, f"http://one/{i}", "<article><p>only this</p></article>") for i in range(9)]
    got = {r["page_id"]: r["text"] for r in template_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "Head\nBy Ann\none\ntwo" for i in range(7))
    assert all(got[100 + i] == "Head\nBy Ann\none" for i in range(7))
    assert all(got[200 + i] == f"Daily\nBy Ann\ntext {i}" for i in range(8))
    assert all(got[300 + i] == f"Head\nBy Ann\none\ntwo\n{i} views" for i in range(6))
    assert got[400] == "Head 0\nBy Ann\ntext 0" and got[403] == "Head 3\nBy Ann\ntext 3\nRead more"
    assert all(got[500 + i] == "only this" for i in range(9))


# all
def test_registry_names():
    found = sorted(int(m[1]) for k in REGISTRY if (m := re.match(r"op(\d+)_", k)))
    assert found == list(range(1, 11))


def test_digest_format():
    assert pii.digest([("email", 0, 5), ("ip", 7, 9)]) == hashlib.sha256(b"email:0:5,ip:7:9").hexdigest()


def test_secrets_come_from_the_tagger_alone():
    """Keys are found under names, quotes and lengths that no training text has; none in clean prose."""
    r = random.Random(8)
    key = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    named = ('token = "{}"', "secret: '{}'", "api_key={}", 'password: "{}"')
    texts = [f"{prose(i, 20)} {named[i % 4].format(key(40))} {prose(i + 1, 20)} mail a{i}.b@host{i}.org at 10.0.{i % 250}.7 on +1 555 010 {1000 + i}" for i in range(160)]
    ids, tags = pii.training_windows(texts, 1_000, 7)
    model = pii.train(ids, tags, seed=7)
    keys = [key(n) for n in (28, 32, 40, 64, 96) for _ in range(6)]
    fresh = [f"{prose(900 + i, 15)} {('auth', 'sig', 'hash', 'id')[i % 4]}: '{k}', {prose(800 + i, 15)}" for i, k in enumerate(keys)]
    got = pii.added_spans(fresh, [pii.base_spans(t) for t in fresh], model, 0.98)
    hit = sum(("secret", t.index(k), t.index(k) + len(k)) in g for t, k, g in zip(fresh, keys, got))
    assert hit >= 0.8 * len(keys)
    assert all(k == "secret" for g in got for k, _, _ in g) and pii.KINDS == ("email", "ip", "card", "phone")
    clean = [prose(3000 + i, 60) + f" in {1900 + i} and {i} more" for i in range(60)]
    assert sum(map(len, pii.added_spans(clean, [[] for _ in clean], model, 0.98))) == 0


def test_decode_is_the_best_path_of_all():
    """Viterbi path and confidence against every allowed tag sequence of short windows."""
    r = np.random.default_rng(5)
    p = {k: v.astype(float) for k, v in pii.new_params(11).items()}
    p["wo"], p["tr"] = 3 * r.normal(size=p["wo"].shape), r.normal(size=p["tr"].shape)
    model, ids = pii.Tagger(p), r.integers(1, pii.N_CLASS, size=(6, 4))
    em, _ = pii._emissions(p, ids)
    tr, st = pii._masked(p)
    for w, spans in enumerate(pii.decode(model, ids)):
        paths = [x for x in itertools.product(range(pii.N_TAGS), repeat=4)
                 if pii.START_OK[x[0]] and all(pii.ALLOWED[a, b] for a, b in itertools.pairwise(x))]
        score = np.array([st[x[0]] + sum(em[t, w, x[t]] for t in range(4)) + sum(tr[a, b] for a, b in itertools.pairwise(x)) for x in paths])
        weight = np.exp(score - score.max())
        best = paths[int(score.argmax())]
        want, t = [], 0
        while t < 4:
            if best[t] == 0:
                t += 1
                continue
            s, k = t, (best[t] - 1) // 2
            t += 1
            while t < 4 and best[t] == 2 * k + 2:
                t += 1
            sure = min(weight[[x[i] == best[i] for x in paths]].sum() / weight.sum() for i in range(s, t))
            want.append((k, s, t, sure))
        assert [x[:3] for x in spans] == [x[:3] for x in want]
        assert np.allclose([x[3] for x in spans], [x[3] for x in want], atol=1e-6)
