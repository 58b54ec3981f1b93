"""Corpus operators against brute force and on awkward input."""

import hashlib
import random
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tilewright.llm import bpe, lines, lmscore, merkle, mixing, quality, simhash, tokencount, topk, urlrules
from tilewright.llm.common import shared_dir
from tilewright.operators import graph

DOCS = "doc_id long, text string, source string, lang string, _h int, rank int, key string"


def docs(spark, rows):
    """(doc_id, text[, source]) with more columns whose names the operators use themselves."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "a", "en", 1, 2, "k") for r in rows], DOCS)


rng = random.Random(5)
VOCAB = [f"w{i}" for i in range(60)]
LONG = " ".join(rng.choices(VOCAB, k=30_000))
BASE = [" ".join(rng.choices(VOCAB, k=60)) for _ in range(6)]
NEAR = [" ".join([*b.split()[:30], f"x{i}", *b.split()[31:]]) for i in range(3) for b in BASE[:2]]
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Two words"), (6, LONG), (7, BASE[0]), (7, BASE[0]), (8, BASE[0]), (None, BASE[1]), (None, None), (9, "Ünï çödé 文字 😀\x00")]
ROWS = [*ODD, *((20 + i, t, rng.choice(["a", "b", None])) for i, t in enumerate(BASE + NEAR))]


def test_simhash(spark):
    got = simhash.near_duplicates(docs(spark, ROWS)).collect()
    assert len(got) == len(ROWS)
    fps = sorted({simhash.fingerprint(r[1]) for r in ROWS})
    comp = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            comp[i] = min(comp[j] for j, b in enumerate(fps) if (a ^ b).bit_count() <= 3)
    least = {}
    for r in ROWS:
        c = comp[fps.index(simhash.fingerprint(r[1]))]
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = sorted((str(r[0]), f"{simhash.fingerprint(r[1]):016x}", least.get(comp[fps.index(simhash.fingerprint(r[1]))])) for r in ROWS)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("split", [1024, 8])
def test_links_join_all_within_radius(spark, split, monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT_RUN", split)
    r = np.random.default_rng(1)
    centres = r.integers(0, 2**63, 5, dtype=np.uint64)
    fps = set(centres.tolist())
    for c in centres.tolist():
        for _ in range(60):
            fps.add(c ^ sum(1 << int(b) for b in r.choice(64, r.integers(1, 6), replace=False)))
    fps = np.array(sorted(fps), np.uint64)
    out = []
    simhash._forest(fps, 2**64 - 1, 3, out)
    pairs = {(int(a), int(b)) for u, v in out for a, b in zip(u.tolist(), v.tolist(), strict=True)}

    def roots(links):
        root = {int(x): int(x) for x in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        return {x: find(x) for x in root}

    every = [(int(a), int(b)) for i, a in enumerate(fps) for b in fps[:i] if int(a ^ b).bit_count() <= 3]
    assert roots(pairs) == roots(every)
    if split == 1024:
        df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
        got = [(r.u % 2**64, r.v % 2**64) for r in simhash.links(df).collect()]
        assert roots(got) == roots(every)


def test_masks_cover():
    masks = simhash.covering_masks(list(range(64)), 3).tolist()
    for _ in range(2000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
        assert any(not diff & m for m in masks)


@pytest.mark.parametrize("local", [0, 1 << 20])
def test_components(spark, monkeypatch, local):
    monkeypatch.setattr(graph, "LOCAL", local)
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3)]
    got = {r.node: r.root for r in graph.connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102)}}
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)]
    root = {i: i for i in range(300)}
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {x.node: x.root for x in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: root[i] for a, b in edges if a != b for i in (a, b)}
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_top_k(spark):
    r = np.random.default_rng(2)
    vecs = [(i, r.normal(size=8).tolist()) for i in range(300)] + [(1000 + i, [0.5] * 8) for i in range(60)]
    odd = [(400, None), (401, [None] * 8), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, [1.0] * 8), (404, []), (405, [1.0]), (3, vecs[3][1])]
    df = spark.createDataFrame(vecs + odd, "vec_id long, embedding array<float>")
    asks = df.filter("vec_id % 20 = 0 OR vec_id IN (3, 404)")
    fine = [(i, np.floor(64 * np.float64(np.float32((v + [0.0] * 8)[:8]))).astype(int)) for i, v in vecs + odd[5:]]
    want = []
    for q, v in {i: v for i, v in fine if i % 20 == 0 or i in (3, 404)}.items():
        best = sorted((-int(v @ x), i) for i, x in fine if i != q)[:20]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    more = df.select("*", F.lit(1).alias("v"), F.lit(2).alias("cell"), F.lit("x").alias("rank"))
    for cell, block in ((2048, 1 << 15), (20, 7), (20, 64)):
        topk.CELL_ROWS, topk.BLOCK_ROWS = cell, block
        assert sorted(map(tuple, topk.top_k(more, more.filter("vec_id % 20 = 0 OR vec_id IN (3, 404)")).collect())) == sorted(want)
    topk.CELL_ROWS, topk.BLOCK_ROWS = 2048, 1 << 15
    assert topk.top_k(df.filter("false"), asks).count() == 0
    assert topk.top_k(df.filter("vec_id < 5"), df.filter("vec_id = 1")).count() == 5


def test_bounds_skip_far_cells(spark):
    r = np.random.default_rng(3)
    centres = np.eye(8)[:4] * 40
    vecs = [(i, (centres[i % 4] + r.normal(size=8) * 0.01).tolist()) for i in range(400)]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    topk.CELL_ROWS = 10
    got = sorted(map(tuple, topk.top_k(df, df.filter("vec_id < 8")).collect()))
    topk.CELL_ROWS = 2048
    x = np.floor(64 * np.array([v for _, v in vecs])).astype(int)
    want = [(q, k + 1, i, -s) for q in range(8) for k, (s, i) in enumerate(sorted((-int(x[q] @ x[i]), i) for i in range(400) if i != q)[:20])]
    assert got == want


def test_bounds_leave_out_rows_of_the_own_id(spark, monkeypatch):
    r = np.random.default_rng(4)
    centres = np.eye(8)[:4] * 40
    vecs = [(i, (centres[i % 4] + r.normal(size=8) * 0.01).tolist()) for i in range(200)]
    ids = spark.range(990, 1190).select("id", F.xxhash64("id").alias("h")).collect()
    drawn = sorted(x.h for x in spark.range(200).select(F.xxhash64("id").alias("h")).collect())
    many = next(x.id for x in ids if drawn[8] < x.h < drawn[14])  # some of the pivots are its rows, some are others
    vecs += [(many, [0.0] * 7 + [90.0])] * 30
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    monkeypatch.setattr(topk, "CELL_ROWS", 10)
    got = sorted(map(tuple, topk.top_k(df, df.filter(F.col("vec_id").isin(1, many))).collect()))
    x = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in vecs]
    want = []
    for q, a in dict(x).items():
        if q in (1, many):
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted((-int(a @ v), i) for i, v in x if i != q)[:20])]
    assert got == sorted(want) and len(got) == 40


def test_query_groups_are_bounded(spark, monkeypatch):
    first, cuts = topk.groups_of(np.array([10, 3 * topk.QUERY_ROWS + 1, 0, 20, topk.QUERY_ROWS, 5]), topk.QUERY_ROWS)
    assert cuts.tolist() == [1, 4, 1, 1, 1, 1] and first.tolist() == [0, 1, 4, 5, 6, 7]  # a home without queries may have any
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    monkeypatch.setattr(topk, "CELL_ROWS", 20)
    r = np.random.default_rng(5)
    df = spark.createDataFrame([(i, (r.normal(size=4) * 0.01 + (1 if i % 3 else 5)).tolist()) for i in range(200)], "vec_id long, embedding array<double>")
    few = sorted(map(tuple, topk.top_k(df, df).collect()))
    monkeypatch.setattr(topk, "QUERY_ROWS", 4096)
    assert len(few) == 4000 and few == sorted(map(tuple, topk.top_k(df, df).collect()))


def test_url_rules(spark):
    urls = [
        None, "", "no scheme.org/en/", "http://org/x", "HTTP://A.Example.ORG/es/1?x#y", "http://example.org", "http://example.org/en/12", "http://notexample.org/en/1",
        "ftp://x.com/fr/", "ftp://com/de/q", "http://x.com/de", "http://" + "a." * 300 + "com/fr/" + "z" * 5000, "http://[::1]/fr/", "http://u@b.org:80/", "x://y://org/", "http://x.com/fr/\ud83d\ude00".encode("utf-16", "surrogatepass").decode("utf-16"),
    ]
    rows = [(i, u) for i, u in enumerate(urls)] + [(5, urls[5]), (None, urls[6]), (7, "http://org/x?2"), (7, "http://org/x?3")]
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in rows], "page_id long, url string, host string, path string")
    rules = spark.createDataFrame(urlrules.RULES, "host string, path string, verdict string")

    def split(u):
        if u is None or "://" not in u:
            return "", ""
        rest = u.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        path = rest[n:].split("?")[0].split("#")[0]
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n]), path

    want = []
    for i, u in rows:
        host, path = split(u)
        fit = [(len(h + p), h + p, v) for h, p, v in urlrules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want.append((str(i), host, path, *(max(fit)[1:] if fit else (None, "allow"))))
    got = [(str(r.page_id), r.host, r.path, r.rule, r.verdict) for r in urlrules.judge(pages, rules).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert urlrules.judge(pages.filter("false"), rules).count() == 0
    assert {r.verdict for r in urlrules.judge(pages, rules.filter("false"), "block").collect()} == {"block"}


def test_url_rules_of_any_depth(spark):
    hosts = [".".join(["x"] * n + ["org"]) for n in range(300)]
    rules = spark.createDataFrame([(h, "/", f"v{n}") for n, h in enumerate(hosts)], "host string, path string, verdict string")
    pages = spark.createDataFrame([(n, f"http://{h}/a") for n, h in enumerate(hosts)] + [(900, "http://" + "y." * 500 + "org/"), (901, "http://com/")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urlrules.judge(pages, rules).collect()}
    assert got == {**{n: f"v{n}" for n in range(300)}, 900: "v0", 901: "allow"}


def test_bpe_equals_library(spark):
    tok = Tokenizer.from_file(bpe.VOCABULARY)
    texts = [r[1] for r in ROWS] + ["a<|endoftext|>B <|startoftext|>", "aaaaaaa!!!! 's I'LL don't", "ΑΣ ΑΣΑ İ ﬁ é e\u0301", "x" * 20_000, "1234 ½ ² ١", "\x1c a\x85b\u3000c", "<|end", "the" * 50]
    rows = [(i, t) for i, t in enumerate(texts)]
    short = {r.doc_id: r for r in bpe.encode(docs(spark, rows), full=False).collect()}
    full = {r.doc_id: r for r in bpe.encode(docs(spark, rows)).collect()}
    for i, t in rows:
        e = tok.encode(t or "", add_special_tokens=False).ids
        assert full[i].ids == e and full[i].n_tokens == short[i].n_tokens == len(e), t
        assert full[i].decoded == tok.decode(e, skip_special_tokens=False)
        assert short[i].ids_sha256 == hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest()
        assert short[i].decoded_sha256 == hashlib.sha256(full[i].decoded.encode()).hexdigest()
    assert bpe.encode(docs(spark, [])).count() == 0


def test_bpe_forgets_rightly(monkeypatch):
    monkeypatch.setattr(bpe, "CHUNKS", 5)
    monkeypatch.setattr(bpe, "WORDS", 5)
    b, tok = bpe.Bpe(bpe.VOCABULARY), Tokenizer.from_file(bpe.VOCABULARY)
    for t in BASE:
        assert b.encode([t])[0].tolist() == tok.encode(t, add_special_tokens=False).ids


def test_bpe_rows_and_late_letters(spark):
    tok = Tokenizer.from_file(bpe.VOCABULARY)
    late = "".join(map(chr, bpe.LATE_LOWER)) + "a\U00010940b \u0558\U0003d000 Z\ua7ce1"
    rows = [(None, "a b"), (None, None), (3, "twice"), (3, "twice"), (4, late), (5, late + " <|endoftext|>" + late)]
    got = bpe.encode(docs(spark, rows).withColumn("n_tokens", F.lit(1)).withColumn("ids", F.lit("x")))
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    want = sorted((str(i), tok.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    assert sorted((str(r.doc_id), r.ids) for r in got.collect()) == want


def test_bpe_merges_many_words_at_once():
    b, tok = bpe.Bpe(bpe.VOCABULARY), Tokenizer.from_file(bpe.VOCABULARY)
    r = random.Random(1)
    words = list({"".join(r.choices(["th", "he", "a", "aa", "an", "ion", "z", "é"], k=r.randint(1, 9))) for _ in range(3000)})
    assert [np.frombuffer(x, np.int32).tolist() for x in b.encode_words(words)] == [tok.encode(w, add_special_tokens=False).ids for w in words]
    assert b.encode_words([]) == []


def test_quality(spark):
    r = random.Random(3)
    good = [(i, " ".join(r.choices(VOCAB, k=80)) + ".") for i in range(240)]
    bad = [(1000 + i, " ".join(f"{w.upper()}!!" for w in r.choices(VOCAB, k=80))) for i in range(120)]
    d = docs(spark, good + bad + [(5000 + (r_[0] or 0), r_[1]) for r_ in ODD])
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (3, None), (7, 1)], "doc_id long, quality int")
    got = quality.score(d, quality.train(d, labels)).collect()
    assert len(got) == len(good) + len(bad) + len(ODD) and all(0 <= x.score <= 1 for x in got)
    held = [x for x in got if x.held_out and x.doc_id < 2000]
    assert np.mean([(x.predicted == 1) == (x.doc_id < 1000) for x in held]) > 0.97 and len(held) > 50
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in got)
    none = quality.train(d, labels.filter("false"))
    assert {round(x.score, 6) for x in quality.score(d, none).collect()} == {0.5}
    assert quality.score(docs(spark, []), none).count() == 0


def test_quality_features_brute(spark):
    texts = [t for _, t in ODD] + BASE + ["Two two!! 3rd x" + "y" * 200 + "Z a", "A1" * 300]
    base = quality.index_vectors().astype(np.float64)
    memo = quality.Rows()

    def rows(text):
        found = []
        for c in (text or "").encode().split():
            word, shape = c.lower().strip(b".,;:!?\"'()#$%&*|"), []
            for k in map(quality._kind, c):
                if not shape or shape[-1] != k:
                    shape.append(k)
            shape = ["", *shape[1:]] if shape[:2] == ["A", "a"] else ["AA"] if shape == ["A"] and len(c) > 1 else shape
            at = [zlib.crc32(word) % quality.ROWS, zlib.crc32(b"\0" + "".join(shape).encode()) % quality.ROWS]
            found.append([at[0], quality.REPEAT if found and found[-1][0] == at[0] else at[1]])
        return found

    sums = np.zeros_like(base)
    for t in texts:
        r = rows(t)
        assert memo.of(t).tolist() == r
        for x, y in zip(r, r[1:], strict=False):
            for a in x:
                for b in y:
                    sums[a] += base[b]
                    sums[b] += base[a]
    want = base / 2
    used = np.abs(sums).sum(axis=1) > 0
    want[used] += sums[used] / np.linalg.norm(sums[used], axis=1, keepdims=True)
    got = quality.word_vectors(docs(spark, list(enumerate(texts))))
    assert np.allclose(got, want, atol=1e-5)
    r = np.array(rows(BASE[0]))
    pool = [*want[r[:, 0]].mean(axis=0), *want[r[:, 1]].mean(axis=0), np.log1p(len(r)) / 10]
    assert np.allclose(quality.pooled(memo.of(BASE[0]), got), pool, atol=1e-5) and not quality.pooled(memo.of(" "), got).any()


def test_quality_temperature():
    r = np.random.default_rng(3)
    x = r.normal(size=(600, 2 * quality.DIM + 1))
    y = (x[:, 0] + r.normal(size=600) > 0).astype(float)
    net = quality.fit(x, y, quality.index_vectors())
    hold = np.random.default_rng(11).permutation(600)[:150]
    loss = lambda t: np.mean(np.logaddexp(0, np.where(y[hold] == 1, -1, 1) * net.logits(x[hold]) / t))
    assert all(loss(net.temperature) <= loss(t) + 1e-9 for t in np.exp(np.linspace(np.log(0.25), np.log(8), 40)))
    assert abs(net.score(x[hold]).mean() - y[hold].mean()) < 0.12 and net.temperature > 1


def test_lines(spark):
    line = " ".join(VOCAB[:12])
    near = " ".join([*VOCAB[:5], "zz", *VOCAB[6:12]])
    longer, shorter = line + " more", " ".join(VOCAB[1:12])
    rows = [(1, f"{line}\nshort one\n"), (2, f"{near}\nshort one\nkeep this"), (3, f"{line}\n{longer}"), (4, shorter), (5, f"a b c d e\n\n{line}"), (6, "a b c d e"), (7, None), (8, ""), (None, line), (9, line), (9, line)]
    got = {(r.doc_id, r.text): (r.n_lines, r.n_copies, r.n_near) for r in lines.dedup_lines(docs(spark, rows)).collect()}
    assert got == {
        (1, f"{line}\nshort one\n"): (3, 0, 0), (2, "keep this"): (3, 1, 1), (3, ""): (2, 1, 1), (4, ""): (1, 0, 1), (5, "a b c d e\n"): (3, 1, 0), (6, ""): (1, 1, 0), (7, None): (0, 0, 0), (8, ""): (1, 0, 0),
        (None, ""): (1, 1, 0), (9, ""): (1, 1, 0),
    }
    assert lines.dedup_lines(docs(spark, [])).count() == 0
    exact = {r.doc_id: r.n_near for r in lines.dedup_lines(docs(spark, rows), max_edits=0).collect()}
    assert set(exact.values()) == {0}


def lines_that_go(rows, min_words, near_words):
    """{(row, line, kind)} by comparing all pairs of lines, as the docstring of duplicate_lines has it."""
    at = [(i, k, tuple(x.encode().split())) for i, (_, t) in enumerate(rows) for k, x in enumerate((t or "").split("\n"))]
    order = lambda x: (rows[x[0]][0] is None, rows[x[0]][0] or 0, x[1])
    at = sorted((x for x in at if len(x[2]) >= min_words), key=order)
    found = set()
    for n, x in enumerate(at):
        earlier = [y for y in at[:n] if order(y) < order(x)]
        if any(y[2] == x[2] for y in earlier):
            found.add((*x[:2], "copy"))
        elif len(x[2]) >= near_words and any(len(y[2]) >= near_words - 1 and lines.within_one(list(y[2]), list(x[2])) for y in earlier):
            found.add((*x[:2], "near"))
    return found


@pytest.mark.parametrize("min_words, near_words, together", [(1, 5, 4096), (5, 10, 4096), (1, 5, 3), (3, 12, 50)])
def test_lines_brute(spark, tmp_path, monkeypatch, min_words, near_words, together):
    monkeypatch.setattr(lines, "TOGETHER", together)
    r = random.Random(min_words + together)
    pool = [r.choices("abcdefgh", k=r.randint(1, 13)) for _ in range(90)]
    for _ in range(150):
        w = list(r.choice(pool))
        i = r.randrange(len(w) or 1)
        w[i : i + r.randint(0, 1)] = r.choice([[], ["z"], w[i : i + 1], ["q"]])
        pool.append(w)
    pool += [[*"abcdef", f"n{i}", *"hijk"] for i in range(60)]  # lines that all share a variant
    long_ = r.choices(VOCAB, k=9000)
    texts = ["\n".join(" ".join(r.choice(pool)) for _ in range(3)) for _ in range(120)]
    texts += ["All rights reserved.\n\n ", "All rights reserved.\n\n ", " ".join(long_), " ".join([*long_[:4000], *long_[4001:]]), None, ""]
    rows = [(None if i == 7 else i if i != 9 else 10, t) for i, t in enumerate(texts)]
    want = lines_that_go(rows, min_words, near_words)
    assert {len(texts[i].split("\n")[k].split()) for i, k, kind in want if kind == "near"} >= {near_words, 8999}
    d = docs(spark, rows)
    keys = {x.k: x.n for x in d.select(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("k"), F.expr("struct(doc_id, text)").alias("n")).collect()}
    got = {(rows.index(tuple(keys[x.dkey])), x.line, x.kind) for x in lines.duplicate_lines(d, 1, min_words, near_words).collect()}
    assert got == want
    if (min_words, near_words) == (1, 5):
        d.write.parquet(f"{tmp_path}/documents.parquet")
        counts = sorted((str(x.doc_id), x.n_copies, x.n_near) for x in lines.op9_lines(spark, str(tmp_path)).collect())
        assert counts == sorted((str(i), *(sum(n == m and k == kind for m, _, k in want) for kind in ("copy", "near"))) for n, (i, _) in enumerate(rows))


def test_within_one():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            old, row = row, [i + 1]
            for j, y in enumerate(b):
                row.append(min(old[j] + (x != y), old[j + 1] + 1, row[j] + 1))
        return row[-1]

    for _ in range(3000):
        a, b = (rng.choices([b"a", b"b"], k=rng.randint(0, 5)) for _ in range(2))
        assert lines.within_one(a, b) == (distance(a, b) <= 1)


def test_merkle(spark):
    got = merkle.fingerprint_edits(docs(spark, ROWS)).collect()
    assert len(got) == len(ROWS)
    same = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert same.setdefault(r.fingerprint, r.n_chars) == r.n_chars
    order = sorted([(r[0], r[1] or "") for r in ROWS if r[0] is not None and r[0] not in (7, 8)], reverse=True)
    by = {r.doc_id: r for r in got}
    for (i, t), (_, nxt) in zip(order, order[1:], strict=False):
        if i == 9:
            nxt = BASE[0]
        n = len(t)
        assert by[i].edited_sha256 == hashlib.sha256((t[: n - n // 3] + nxt[: n // 3]).encode()).hexdigest()
        assert by[i].n_chars == n
    assert merkle.fingerprint_edits(docs(spark, [])).count() == 0
    alone = merkle.fingerprint_edits(docs(spark, [(1, "abcdef")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and alone.near_next == 1.0


def test_fingerprints_tell_where_texts_differ(spark):
    words = rng.choices(VOCAB + ["is", "at", "my"], k=200)
    text = "\n\n".join("\n".join(" ".join(words[a + 20 * k : a + 20 * k + 20]) for k in range(5)) for a in (0, 100))
    first, second = text.split("\n\n")
    swapped = "\n".join(second.split("\n")[i] for i in (1, 0, 2, 3, 4))
    cases = {"same": text, "before": "extra " + text, "swapped": first + "\n\n" + swapped, "changed": text.replace(second.split("\n")[2], "something else here"), "other": " ".join(reversed(words)), "none": ""}
    df = spark.createDataFrame([(k, text, t) for k, t in cases.items()], "name string, a string, b string")
    df = df.select("name", merkle.fingerprint(F.col("a")).alias("a"), merkle.fingerprint(F.col("b")).alias("b"))
    got = {r.name: r for r in df.select("name", (F.col("a") == F.col("b")).alias("eq"), merkle.likeness(merkle.levels(F.col("a")), merkle.levels(F.col("b"))).alias("like"), merkle.edits(merkle.levels(F.col("a")), F.col("b")).alias("at")).collect()}
    assert got["same"].eq and got["same"].like == 1 and got["same"].at == ""
    assert not got["before"].eq and 0.8 < got["before"].like < 1 and got["before"].at == "0.0"
    assert 0.8 < got["swapped"].like < 1 and got["swapped"].at == ""  # both lines are known
    assert 0.7 < got["changed"].like < 1 and got["changed"].at == "1.2"
    assert got["other"].like < 0.2 and got["none"].like == 0 and got["none"].at == "0.0"


def test_mix(spark):
    r = random.Random(6)
    rows = ROWS + [(100 + i, " ".join(r.choices(VOCAB, k=r.randint(1, 400))), r.choice(["a", "a", "a", "b", "c", None])) for i in range(300)]
    got = mixing.mix(docs(spark, rows)).collect()
    assert len(got) == len(rows) and all(x.taken <= 3 * x.size for x in got)
    by = {}
    for x in got:
        by.setdefault((x.target, x.source_size), []).append(x.taken)
    assert len(by) == 4 and all(abs(sum(t) - target) < 0.02 * target + 40 for (target, _), t in by.items())
    assert abs(sum(target for target, _ in by) - sum(x.size for x in got)) < 1e-6
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs(spark, rows).repartition(3)).collect()))
    assert mixing.mix(docs(spark, [])).count() == 0 and mixing.mix(docs(spark, [(1, None), (2, "")])).count() == 2
    again = mixing.remix(docs(spark, rows))
    assert again.columns == docs(spark, []).columns and again.filter("doc_id = 2").count() == 1


@pytest.mark.parametrize("n_sources", [5, 400])
def test_mix_brute(spark, n_sources):
    """Targets, order, schedule and words taken by a plain loop over sources, slots and documents."""
    r = random.Random(n_sources)
    names = [None, "", "Z", "a", "é", *(f"s{i}" for i in range(n_sources))]
    rows = ROWS + [(100 + i, " ".join(r.choices(VOCAB, k=r.randint(1, 90) if i % 50 else 3000)), names[min(int(r.expovariate(8 / len(names))), len(names) - 1)]) for i in range(900)]
    d = docs(spark, rows)
    hashed = d.select("doc_id", "text", "source", F.xxhash64("doc_id", "text").alias("h"), F.expr("shiftrightunsigned(xxhash64(xxhash64(doc_id, text)), 54)").alias("c")).collect()
    size_of = lambda x: len((x.text or "").encode().split())
    sources = sorted({x.source for x in hashed}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(size_of(x) for x in hashed if x.source == s) for s in sources}
    total, weight = sum(size.values()), {s: 1 + i % 3 for i, s in enumerate(sources)}
    target = {}
    while True:
        free = [s for s in sources if s not in target]
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[o] for o in free) for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        target.update({s: 3.0 * size[s] for s in over})
        if not over:
            target.update(share)
            break
    block = min(max(total // mixing.SLOTS, 16), mixing.MAX_BLOCK)
    edges = np.cumsum([target[s] for s in sources])
    whole, edges = edges[-1], edges / edges[-1]
    nth, times = Counter(), Counter()
    for i in range(int(np.ceil(whole / block))):
        s = sources[min(int(np.searchsorted(edges, (i + 1) * mixing.GOLDEN % 1, side="right")), len(sources) - 1)]
        n = -(-size[s] // block)
        if nth[s] < 3 * n:
            times[s, nth[s] % n] += 1
        nth[s] += 1
    want, at = [], Counter()
    for x in sorted(hashed, key=lambda x: (x.c, x.h, x.doc_id is not None, x.doc_id or 0, size_of(x))):
        start, n = at[x.source], size_of(x)
        at[x.source] += n
        want.append((x.doc_id, n, size[x.source], target[x.source], sum(times[x.source, w // block] for w in range(start, start + n))))
    got = [tuple(x) for x in mixing.mix(d).collect()]
    key = lambda x: (str(x[0]), x[1], x[2], x[4])
    assert [key(x) for x in sorted(got, key=key)] == [key(x) for x in sorted(want, key=key)]
    assert np.allclose(sorted(x[3] for x in got), sorted(x[3] for x in want))
    assert len(size) > n_sources / 4 and any(t == 3 * size[s] for s, t in target.items())


@pytest.mark.parametrize("block", [2, 6, 1 << 22])
def test_token_counts(spark, block):
    rows = ROWS + [(50, None), (51, ""), (51, "again"), (None, "no id")]
    if block < 100:  # a block of a few bytes each, so the very long text stays with the large block
        rows = [r for r in rows if r[1] != LONG]
    enc = tokencount.encoder(tokencount.VOCABULARY)
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    named = tokencount.write_token_files(docs(spark, rows).withColumn("file", F.lit("f")).repartition(3), folder)
    got = sorted((str(r.doc_id), r.n_tokens) for r in tokencount.count_tokens(spark, folder, block=block).join(named, ["file", "ordinal"]).collect())
    assert got == sorted((str(r[0]), len(enc.encode_ordinary(r[1] or ""))) for r in rows)


def test_no_token_files(spark):
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    assert tokencount.write_token_files(docs(spark, []), folder).count() == 0
    assert tokencount.count_tokens(spark, folder).count() == 0


def test_tokens_after_the_last_separator(spark, tmp_path):
    for name, ids in (("a.bin", [1, 2, 9, 9, 3]), ("b.bin", []), ("c.bin", [4]), ("d.bin", [9])):
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    for block in (2, 4, 1024):
        got = {(r.file, r.ordinal): r.n_tokens for r in tokencount.count_tokens(spark, f"file://{tmp_path}", end=9, block=block).collect()}
        assert got == {("a.bin", 0): 2, ("a.bin", 1): 0, ("a.bin", 2): 1, ("c.bin", 0): 1, ("d.bin", 0): 0}


@pytest.mark.parametrize("heavy", [4096, 3])
def test_lm(spark, monkeypatch, heavy):
    monkeypatch.setattr(lmscore, "HEAVY", heavy)
    monkeypatch.setattr(lmscore, "STEP", 1 if heavy == 3 else 1 << 18)
    rows = [(i, t[1]) for i, t in enumerate(ROWS)] + [(7, ROWS[6][1]), (None, "w1 w2"), (None, "w1 w2"), (90, "w1 " * 500)]
    target = {i for i in range(12, 100)}
    d = docs(spark, rows).withColumn("row", F.lit(1)).withColumn("n", F.lit("x"))
    got = sorted(map(tuple, lmscore.cross_entropy(d, spark.createDataFrame([(i,) for i in target] + [(None,)] * 2, "doc_id long")).collect()), key=str)
    ids = [lmscore.words_of(t).tolist() for _, t in rows]
    want = []
    counts = []
    for part in ([x for (i, _), x in zip(rows, ids, strict=True) if i in target], ids):
        single, history, pairs = Counter(), Counter(), Counter()
        for x in part:
            single.update(x)
            history.update([0, *x][:-1] if x else [])
            pairs.update(zip([0, *x], x, strict=False))
        counts.append((single, history, pairs, sum(single.values())))
    for (i, _), x in zip(rows, ids, strict=True):
        loss = []
        for single, history, pairs, n in counts:
            p = [(pairs[a, b] + lmscore.BACKOFF * (single[b] + 1) / (n + lmscore.VOCABULARY)) / (history[a] + lmscore.BACKOFF) for a, b in zip([0, *x], x, strict=False)]
            loss.append(-np.log(p).mean() if p else 0.0)
        want.append((i, len(x), *loss, loss[0] - loss[1]))
    want = sorted(want, key=str)
    assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2:] for x in got], [x[2:] for x in want], atol=1e-8)
    if heavy == 4096:
        none = spark.createDataFrame([], "doc_id long")
        assert lmscore.cross_entropy(d.filter("false"), none).count() == 0
        assert lmscore.cross_entropy(d, none, background=none).count() == len(rows)
