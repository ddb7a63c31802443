"""Operators that SQL can't express, against plain versions of their methods; clashing columns, ties and copies."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import op01_mixing, op02_quality, op06_langid, op07_url, op09_license, op10_sharding
from plumbline.llm.common import shared_dir

SF = "/root/testdata/sf0.001"


def test_op1_posteriors_and_copies(spark):
    """Naive Bayes over word buckets, recomputed in Python from the same buckets."""
    labelled = [("red red blue", "a"), ("red sky", "a"), ("green grass, GREEN", "b"), ("x", "other"), (None, "b")]
    texts = [(1, "red green"), (2, "blue!"), (3, ""), (None, None), (None, "grass grass grass"), (4, "Red RED sky"), (4, "Red RED sky")]
    model = op01_mixing.learn_domains(spark.createDataFrame(labelled, "text string, domain string"), ["a", "b"])
    words = sorted({w for t in [*labelled, *[(t, 0) for _, t in texts]] for w in re.findall(r"\w+", (t[0] or "").lower())})
    bucket = {r.w: r.b for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", op01_mixing._bucket(F.col("w")).alias("b")).collect()}
    count = {d: Counter(bucket[w] for t, e in labelled if e == d for w in re.findall(r"\w+", (t or "").lower())) for d in "ab"}
    n_docs = Counter(e for _, e in labelled if e in "ab")

    def posterior(text):
        logs = []
        for d in "ab":
            total = sum(count[d].values()) + op01_mixing.BUCKETS
            logs.append(math.log((n_docs[d] + 1) / (sum(n_docs.values()) + 2)) + sum(math.log((count[d][bucket[w]] + 1) / total) for w in re.findall(r"\w+", (text or "").lower())))
        e = [math.exp(x - max(logs)) for x in logs]
        return [x / sum(e) for x in e]

    docs = spark.createDataFrame([(i, t, "h", 1, 2) for i, t in texts], "doc_id long, text string, _h string, copies int, row int")
    got = op01_mixing.mixture(docs, spark.createDataFrame(labelled, "text string, domain string"), {"a": 1.0, "b": 1.0})
    by_text = {r.text_hash: r for r in got.collect()}
    hashes = {r.h: r.text for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    assert len(by_text) == len(set(texts))
    for h, r in by_text.items():
        assert r.n_tokens == len(re.findall(r"\w+", hashes[h] or "")) and np.allclose(r.posterior, posterior(hashes[h]), atol=1e-9)
        assert r.copies in (math.floor(r.rate), math.floor(r.rate) + 1)
    mixed = op01_mixing.mix(docs, spark.createDataFrame(labelled, "text string, domain string"), {"a": 1.0, "b": 1.0})
    want = Counter()
    for i, t in texts:
        want[i, t] += next(r.copies for h, r in by_text.items() if hashes[h] == t and r.doc_id == i)
    assert mixed.columns == docs.columns and Counter((r.doc_id, r.text) for r in mixed.collect()) == +want
    with pytest.warns(RuntimeWarning, match="no rates meet"):
        one = spark.createDataFrame([(1, "red"), (2, "red green")], "doc_id long, text string")
        op01_mixing.mixture(one, spark.createDataFrame(labelled, "text string, domain string"), {"a": 0.0001, "b": 0.9999})


def test_op2_network_against_loops():
    """The score of a text, with every filter and chunk in plain loops; long texts in blocks give the same gradients."""
    net = op02_quality.Net(9)
    W, S, H, K, D = op02_quality.WIDTH, op02_quality.STEP, op02_quality.HALF, op02_quality.FILTERS, op02_quality.HIDDEN
    for text in (b"", b"short", bytes(range(32, 127)) * 6):
        n = max(2, -(-len(text) // H))
        data = text + bytes(n * H + W - len(text))
        halves = []
        for i in range(n):
            z = [[max(0.0, sum(float(net.E[data[i * H + p * S + j]][q]) * float(net.W[j * op02_quality.DIM + q, f]) for j in range(W) for q in range(op02_quality.DIM)) + float(net.b[f])) for f in range(K)] for p in range(H // S)]
            halves.append((np.mean(z, axis=0), np.max(z, axis=0)))
        chunks = [np.concatenate([(a[0] + b[0]) / 2, np.maximum(a[1], b[1])]) for a, b in zip(halves, halves[1:])]
        h = np.maximum(np.array(chunks) @ net.V + net.c, 0)
        want = 1 / (1 + math.exp(-float(np.concatenate([h.max(axis=0), h.mean(axis=0)]) @ net.u + net.o[0])))
        assert h.shape[1] == D and abs(net.score(op02_quality._halves(np.frombuffer(text, np.uint8)), np.array([0]))[0] - want) < 1e-4
    rows = [op02_quality._halves(np.frombuffer(bytes(np.random.default_rng(k).integers(32, 127, 900 * (k + 1), dtype=np.uint8)), np.uint8)) for k in range(3)]
    at, y = np.concatenate(([0], np.cumsum([len(x) for x in rows])[:-1])), np.array([1, 0, 1], np.float32)
    whole, parts = (net.gradients(np.concatenate(rows), at, y, block)[0] for block in (10_000, 3))
    assert all(np.allclose(whole[k], parts[k], atol=1e-5) for k in whole)


def plain_grams(text):
    """One to three letters of each run of letters, with an edge before and after a run; most frequent first, ties by code."""
    runs = re.findall(r"[^\W\d_]+", text.lower())
    out = Counter()
    for w in runs:
        x = " " + w + " "
        out.update(w)
        out.update(x[i : i + 2] for i in range(len(x) - 1))
        out.update(x[i : i + 3] for i in range(len(x) - 2))
    code = lambda g: sum(ord(c) << (21 * (len(g) - 1 - k)) for k, c in enumerate(g))
    return [g for g, _ in sorted(out.items(), key=lambda kv: (-kv[1], code(kv[0])))][: op06_langid.TOP]


def test_op6_distance_against_plain_ranks(spark):
    learn = [(1, "the cat sat on the mat and the dog sat too", "en"), (2, "der hund und die katze sind auf der matte", "de"), (3, "le chat est sur le tapis avec le chien", "fr")]
    texts = ["the dog and the cat", "die katze und der hund", "le chien est le chat", "zzz qqq", "a1b2", "Der THE le"]
    docs = spark.createDataFrame(learn, "doc_id long, text string, lang string")
    profiles = op06_langid.fit_profiles(docs, F.lit(True))
    ranks = {lang: {g: i for i, g in enumerate(plain_grams(t))} for _, t, lang in learn}
    odd = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("_judged", F.lit("mine")).withColumn("row", F.lit(1))
    got = op06_langid.identify(odd, profiles)
    assert got.columns == ["doc_id", "text", "_judged", "row", "lang_pred", "score"]
    for r in got.collect():
        own = plain_grams(r.text)
        far = {lang: sum(abs(rank[g] - i) if g in rank else op06_langid.TOP for i, g in enumerate(own)) for lang, rank in ranks.items()}
        best = min(sorted(far), key=far.get)
        assert (r.lang_pred, r._judged) == (best, "mine") and abs(r.score - (1 - far[best] / (op06_langid.TOP * len(own)))) < 1e-9


def test_op6_learns_a_language_of_copies(spark):
    rows = [(i, "der hund und die katze sind auf der matte", "de") for i in range(3000)] + [(9000 + i, f"the cat number {i} sat on the mat", "en") for i in range(50)] + [(None, None, "xx"), (1, "12", "yy")]
    p = op06_langid.fit_profiles(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), per_lang=20)
    assert {"de", "en"} <= set(p.langs) and p.judge("die matte und der hund")[0] == "de"


def test_op7_rules_ties_and_long_lists(spark):
    rules = [("allow", "com/ab"), ("block", "x.com/"), ("block", "com/a"), ("allow", "d.org/q/"), ("block", "org/")]
    urls = ["http://x.com/ab", "http://y.com/ab", "http://com/a", "https://c.d.org/q/z", "http://d.org/", "http://e.net/", None, "x"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").select("page_id", "url", op07_url.host_of(F.col("url")).alias("host"), op07_url.path_of(F.col("url")).alias("path"))
    want = {0: ("com/ab", "allow"), 1: ("com/ab", "allow"), 2: ("com/a", "block"), 3: ("d.org/q/", "allow"), 4: ("org/", "block")}
    for most in (op07_url.MAX_RULES, 0):  # 0: the join
        got = {r.page_id: (r.rule, r.action) for r in op07_url.with_rules(rows, rules, most).collect()}
        assert got == {i: want.get(i, (None, None)) for i in range(len(urls))}


def test_op7_trees_against_plain_boosting(spark, monkeypatch):
    """One feature that decides and one of noise: boosted trees grown in loops give the same log-odds."""
    monkeypatch.setattr(op07_url, "FEATURES", ["f_len", "f_digits"])
    r = np.random.default_rng(3)
    x = np.stack([r.integers(0, 12, 160).astype(float), r.integers(0, 3, 160).astype(float)], 1)
    y = ((x[:, 0] > 6) ^ (r.random(160) < 0.15)).astype(int)
    table = spark.createDataFrame([(int(b), *map(float, a)) for a, b in zip(x, y)], "y int, f_len double, f_digits double")
    got = np.array([s[0] for s in table.select(op07_url.grow(table, trees=2, depth=2)).collect()])
    cuts = [sorted(set(np.sort(x[:, f], kind="stable")[math.ceil(i / op07_url.BINS * 160) - 1] for i in range(1, op07_url.BINS))) for f in range(2)]
    bins = np.array([[sum(v > c for c in cuts[f]) for f, v in enumerate(row)] for row in x])
    total = np.full(160, math.log((y.sum() + 1) / (160 - y.sum() + 1)))
    for _ in range(2):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)

        def grow(rows, depth):
            best = (op07_url.MIN_GAIN, None)
            for f in range(2) if depth < 2 else ():
                for b in sorted(set(bins[rows, f])):
                    left, right = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                    if h[left].sum() > 1e-3 and h[right].sum() > 1e-3:
                        gain = sum(g[s].sum() ** 2 / (h[s].sum() + op07_url.L2) for s in (left, right)) - g[rows].sum() ** 2 / (h[rows].sum() + op07_url.L2)
                        if gain > best[0] + 1e-9:
                            best = (gain, (left, right))
            if best[1] is None:
                step[rows] = -op07_url.RATE * g[rows].sum() / (h[rows].sum() + op07_url.L2)
            else:
                for part in best[1]:
                    grow(part, depth + 1)

        step = np.zeros(160)
        grow(np.arange(160), 0)
        total = total + step
    assert np.allclose(got, total, atol=1e-6)


def test_op9_predictions_against_plain_model(spark):
    """Every line's family by the model's own weights in Python, then the templates; and notices inside other words."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = op09_license.train_scanner(docs)
    place = {g: i for i, g in enumerate(model.vocabulary)}
    texts = [(i, t) for i, t in ((r.doc_id, r.text) for r in docs.limit(300).collect()) if t] + [
        (90_001, "Copyright (c) 2019 The Example Project Authors. All rights reserved."),
        (90_002, "see the notes\nthis library is Released under the MIT License. by its authors\nx"),
        (90_003, "redistribution and use in source and binary forms with or without changes are not permitted"), (90_004, "mit"), (90_005, "License license LICENSE"),
    ]
    found = {r.doc_id: r for r in op09_license.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    for i, text in texts:
        sure, loose, where = set(), 0, []
        for k, line in enumerate(text.split("\n")):
            words = re.findall(r"[a-z0-9]+", line.lower())
            grams = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
            own = [place[g] for g in grams if g in place]
            if not own:
                continue
            z = model.weights[own].sum(axis=0) / math.sqrt(len(grams)) + (1 - len(own) / len(grams)) * model.weights[-1] + model.bias
            e = np.exp(z - z.max())
            best = int(z.argmax())
            if best == len(op09_license.FAMILIES) or (e / e.sum())[best] < model.level:
                continue
            family = op09_license.FAMILIES[best]
            if any(len(set(words) & set(w)) >= math.ceil(op09_license.CONFIRM * len(set(w))) for w in (re.findall(r"[a-z0-9]+", t.lower()) for t in op09_license.TEMPLATES[family])):
                sure.add(family)
                where.append(k)
            else:
                loose += 1
        r = found[i]
        assert (r.licenses, r.license_lines, r.n_license, r.n_unconfirmed) == (sorted(sure), where, len(where), loose)
    assert found[90_001].licenses == ["all-rights-reserved"] and found[90_002].licenses == ["MIT"] and found[90_004].n_license == 0


def test_op10_deep_directories_and_clashing_columns(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 50), "b", "d", i) for i in range(300)], "doc_id long, text string, bits string, _d string, row int").withColumn("_bits", F.lit("z"))
    tables = [op10_sharding.shard(docs, limit=120, **more).orderBy("doc_id").collect() for more in ({}, {"max_slot_bits": 0}, {"max_slot_bits": 0, "max_broadcast_rows": 0}, {"max_broadcast_rows": 0})]
    assert all(t == tables[0] for t in tables) and tables[0][5]._bits == "z" and tables[0][5].row == 5 and len(tables[0]) == 300
    null = spark.createDataFrame([(None, "y" * 40) for _ in range(500)] + [(1, "z" * 30)], "doc_id long, text string")
    got = op10_sharding.shard(null, limit=100).groupBy("shard", "shard_page").agg(F.sum("text_bytes").alias("b"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in got) == 501 and max(r.b for r in got) <= 100


def test_shared_folder_is_not_a_machines_own_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        def __init__(self, **settings):
            self.settings, self.sparkContext, self.conf = Conf({k.replace("_", "."): v for k, v in settings.items()}), self, Conf()

        def getConf(self):
            return self.settings

    with pytest.raises(RuntimeError):
        shared_dir(Session(spark_master="spark://h:7077"))
    assert shared_dir(Session(spark_master="spark://h:7077", spark_checkpoint_dir="s3a://b/x/")) == "s3a://b/x"
