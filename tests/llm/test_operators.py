"""The training-data operators against brute force, exact round trips, held-out
accuracy and their SQL, and the defined results of edge cases."""

import hashlib
import pkgutil
import random
import re
import textwrap

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from eddyline.llm import ann, bpe, common, licences, mixing, simhash, sketch, token_counts, toxicity, urlfilter, warc
from eddyline.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path
from tools.compare import compare, duck

SF = "/root/testdata/sf0.01"
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, _fp STRING, rate DOUBLE"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def edge_docs(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    rows = [(1, "a b c d e f", "en", "s", 11), (2, "A B C D E F", "en", "s", 11), (None, "x y z", None, None, 5),
            (3, None, "en", "s", 0), (4, "", "en", "s", 0), (4, "", "en", "s", 0), (5, long, "en", "s", len(long)),
            (6, long, "en", "t", len(long)), (7, "one", "en", "t", 3)]
    return spark.createDataFrame([(*r, "own", 0.5) for r in rows], DOCS)


def plain_simhash(text, words=3):
    w = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    sh = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or ([" ".join(w)] if w else [])
    if not sh:
        return 0
    h = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in sh], dtype=np.uint64)
    on = ((h[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(axis=0)
    return sum(1 << i for i in range(64) if 2 * int(on[i]) > len(sh))


def plain_groups(values, bits):
    up = {v: v for v in values}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    vs = sorted(up)
    for i, a in enumerate(vs):
        for b in vs[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {v: root(v) for v in vs}


# ---- 1 SimHash ----

def test_simhash_equals_brute_force(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    fp = {r.doc_id: plain_simhash(r.text) for r in rows}
    group = plain_groups(set(fp.values()), 2)
    low = {}
    for i, v in fp.items():
        low[group[v]] = min(low.get(group[v], i), i)
    got = {r.doc_id: r for r in QUERIES["op1_simhash"](spark, SF).collect()}
    assert len(got) == len(rows)
    assert all(got[i].fingerprint == f"{v:016x}" and got[i].component_id == low[group[v]] for i, v in fp.items())


@pytest.mark.parametrize("limit", [3, 50, 4096])
def test_linked_fingerprints_equal_brute_force(spark, limit):
    rnd = random.Random(limit)
    values = set()
    for _ in range(12):
        c = rnd.getrandbits(64)
        values |= {c ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(25)}
    values |= {rnd.getrandbits(64) for _ in range(200)}
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    df = spark.createDataFrame([(i, s) for i, s in enumerate(signed.values())], "id BIGINT, fp BIGINT")
    label = {r.fp: r.component_id for r in simhash.fingerprint_groups(df, 2, limit).collect()}
    want = plain_groups(values, 2)
    seen = {}
    for v in values:
        assert seen.setdefault(want[v], label[signed[v]]) == label[signed[v]]
    assert len(set(label.values())) == len(set(want.values()))


def test_simhash_edges(spark):
    d = edge_docs(spark)
    got = simhash.near_duplicates(d).collect()
    assert len(got) == 9
    by = {}
    for r in got:
        by.setdefault(r.doc_id, r)
    assert by[1].fingerprint == by[2].fingerprint and by[2].component_id == 1
    assert by[3].fingerprint == by[4].fingerprint == "0" * 16 and by[4].component_id == 3
    assert by[6].component_id == 5 and by[None].component_id is None
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 3), (False, 5), (False, 7), (True, 0)]
    assert simhash.near_duplicates(d.limit(0)).count() == 0
    assert simhash.keep_one(d.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    e = spark.range(0, 400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = common.components(e.unionByName(spark.createDataFrame([(900, 901), (7, 7)], "a BIGINT, b BIGINT"))).collect()
    assert {r.node: r.label for r in got} == {**{i: 0 for i in range(401)}, 900: 900, 901: 900}


def test_components_of_a_million_links(spark):
    e = spark.range(1_000_000).select((F.col("id") * 2 + 1).alias("a"), (F.col("id") * 2).alias("b"))
    got = common.components(e)
    assert got.count() == 2_000_000
    assert got.where(F.col("label") != F.col("node") - F.col("node") % 2).count() == 0


# ---- 2 sketches ----

def test_edited_texts_and_sketches(spark, docs):
    rows = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), reverse=True)
    got = {r.doc_id: r for r in QUERIES["op2_sketch"](spark, SF).collect()}
    assert len(got) == len(rows)
    off = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        h = len(t) // 2
        e = t[:len(t) - h] + nxt[:h]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        a, b = (set(zip(*(x.lower().encode().split()[j:] for j in range(5)))) for x in (t, e))
        if len(a) > 50 and len(b) > 50:
            off.append(abs(len(a & b) / len(a | b) - got[i].near_edited))
    assert np.mean(off) < 0.05


def test_sketch_round_trip_and_merge():
    text = " ".join(str(i * i) for i in range(3000)).encode()
    half = " ".join(str(i * i) for i in range(1500)).encode()
    a, b = sketch.Sketch.of(text), sketch.Sketch.of(half)
    assert sketch.Sketch.parse(a.text()).hashes.tolist() == a.hashes.tolist()
    assert b.containment(a) == 1.0 and 0.35 < a.containment(b) < 0.65
    assert a.merge(b).hashes.tolist() == a.hashes.tolist()
    none, one = sketch.Sketch.of(b""), sketch.Sketch.of(b"one")
    assert none.likeness(none) == 1.0 and none.likeness(one) == 0.0 and one.likeness(one) == 1.0


def test_sketch_edges(spark):
    d = edge_docs(spark)
    got = sketch.compare_with_edited(d, part_rows=2).collect()
    assert len(got) == 9 and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    assert sketch.compare_with_edited(d.limit(0)).count() == 0
    one = sketch.compare_with_edited(d.where("doc_id = 1")).collect()
    assert one[0].near_next == 1.0


def test_containment_of_a_short_text_is_known_or_null(spark):
    words = [str(i * i) for i in range(30_000)]
    long = sketch.Sketch.of(" ".join(words).encode())
    got = [sketch.Sketch.of(" ".join(words[i:i + 14]).encode()).containment(long) for i in range(0, 29_000, 100)]
    assert set(got) == {1.0, None} and 0.15 < got.count(None) / len(got) < 0.4
    i = 100 * got.index(None)
    rows = [(2, " ".join(words[i:i + 14])), (1, " ".join(words))]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    seen = {r.doc_id: r for r in sketch.compare_with_edited(df).collect()}
    assert seen[2].contained_next is None and seen[1].contained_next is not None


# ---- 3 nearest neighbours ----

def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((12, 24))
    x = centre[rng.integers(0, 12, 6000)] + 0.8 * rng.standard_normal((6000, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = ann.nearest(df, F.col("vec_id") % 50 == 0, k=5, sample=4096).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 6000, 50):
        s = u @ u[q]
        s[q] = -9
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r[0] for r in mine] == [1, 2, 3, 4, 5]
        assert all(abs(s[v] - c) < 1e-12 for _, v, c in mine)
        hits += len(set(np.argsort(-s)[:5].tolist()) & {r[1] for r in mine})
    assert hits / 600 >= 0.9


def test_neighbours_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, float("nan")]), (5, [1.0, None]),
            (6, [1.0, 1.0, 1.0]), (7, [3.0, 0.0]), (7, [3.0, 0.0]), (None, [1.0, 0.0]), (50, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = ann.nearest(df, F.col("vec_id") % 50 == 0, k=5).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [
        (0, 1, 1, 1.0), (0, 2, 7, 1.0), (0, 3, 50, 0.0), (50, 1, 0, 0.0), (50, 2, 1, 0.0), (50, 3, 7, 0.0)]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_neighbours_among_repeated_rows(spark):
    rng = np.random.default_rng(8)
    x = {i: rng.standard_normal(6) for i in range(40)}
    rows = [(i, v) for i, v in x.items()]
    near = sorted((i for i in x if i), key=lambda i: -ann.cosine_many(x[0], x[i][None, :])[0])
    rows += [(0, x[0])] * 9 + [(near[0], x[near[0]])] * 30 + [(near[1], x[near[1]])] * 2
    # Other vectors of one id, some of them nearer than the next ids; its best one counts.
    rows += [(near[2], x[0] + e * x[near[2]]) for e in (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>").coalesce(1)
    best = {}
    for i, v in rows:
        if i:
            best[i] = max(best.get(i, -9), float(ann.cosine_many(x[0], v[None, :])[0]))
    want = sorted(best, key=lambda i: (-best[i], i))[:5]
    got = sorted((r["rank"], r.vec_id, r.score) for r in ann.nearest(df, F.col("vec_id") == 0, k=5).collect())
    assert [r[:2] for r in got] == list(enumerate(want, 1))
    assert all(abs(best[i] - s) < 1e-12 for _, i, s in got)


# ---- 4, 7, 9, 10: SQL ----

@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF, duck(SF))
    assert r["schema_match"] and r["value_match"], r


def test_licence_spellings_and_copyright_lines(spark):
    text = "Copyright (c) 2020 Someone\n\n" + licences.KNOWN["ISC"].upper().replace("COPYRIGHT NOTICE", "copyright   notice")
    rows = [(1, text), (2, "released under the mit LICENCE!"), (3, None), (4, ""), (5, "MIT License"), (None, "Released under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = sorted((r.doc_id or 0, r.unit, r.licence) for r in licences.scan_licences(df).collect())
    assert got == [(0, 0, "MIT notice"), (1, 0, "ISC"), (2, 0, "MIT notice")]
    assert licences.scan_licences(df.limit(0)).count() == 0


def test_wrapped_titled_and_full_licences(spark):
    def wrapped(text, width):
        return "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))
    want, rows = {}, []

    def add(name, text):
        want[len(rows)] = name
        rows.append((len(rows), text))
    for name in ("MIT", "ISC"):
        for width in range(30, 100):
            add(name, wrapped(licences.KNOWN[name], width))
    isc = ("ISC License\n\nCopyright (c) 2004-2020 by Some Body\nCopyright Jane Doe\n\n"
           + licences.KNOWN["ISC"].replace("permission notice", "permission\nnotice").replace("above copyright", "above\ncopyright"))
    assert "\ncopyright notice and this permission\nnotice appear" in isc
    add("ISC", isc)
    add("MIT", "The MIT License (MIT)\n\nCopyright © 2020 X, Inc.\nAll rights reserved.\n\n"
        + licences.KNOWN["MIT"].replace("OR COPYRIGHT", "OR\nCOPYRIGHT"))
    for name in licences.FULL_TEXTS:
        text = pkgutil.get_data("eddyline.llm", f"texts/{name}.txt").decode()
        add(name, text)
        if name in ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause"):
            add(name, wrapped(text, 1000).replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2021 Jane Doe"))
    add("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2017, The Authors\nAll rights reserved.\n\n"
        + pkgutil.get_data("eddyline.llm", "texts/BSD-3-Clause.txt").decode())
    for line in ("Copyright", "copyright notice", "COPYRIGHT HOLDERS BE", "(c) You must retain", "Copyright Act of 1976",
                 "all rights reserved by us"):
        add(None, f"{line}\n{licences.KNOWN['MIT']}")
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {r.doc_id: r.licence for r in licences.scan_licences(df).where("unit = 0").collect()}
    assert {i: n for i, n in want.items() if got.get(i) != n} == {}


def test_mixing_means_and_edges(spark):
    d = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("source"))
    got = {r.source: r["count"] for r in mixing.poisson_mix(d, {"a": 1.0, "b": 3.0}).groupBy("source").count().collect()}
    assert abs(got["a"] - 1000) < 150 and abs(got["b"] - 3000) < 250
    big = mixing.poisson_mix(d.where("source = 'b'").limit(50), {"b": 1.0}, epochs=40.0).count()
    assert abs(big - 2000) < 250
    e = edge_docs(spark)
    first, again = (sorted(str(r) for r in mixing.poisson_mix(e).drop("text").collect()) for _ in range(2))
    assert first == again and mixing.poisson_mix(e, copy_col=None, key_col=None).columns == e.columns
    assert mixing.poisson_mix(e.limit(0)).count() == 0


def test_url_rules_and_edges(spark):
    rows = [(1, "https://WWW.Example.com/en/1"), (2, "http://a.example.com/en/2?x"), (3, "ftp://x.net/es/#a"), (4, "http://net/fr/"),
            (5, "http://com"), (6, "no scheme"), (7, None), (8, "http://x.org/net/es/"), (8, "http://x.org/net/es/")]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING").withColumn("host", F.lit("clash"))
    got = {r.page_id: (r.host, r.path, r.rule) for r in urlfilter.judge_urls(df).collect()}
    assert got == {1: ("www.example.com", "/en/1", "www.example.com/en/"), 2: ("a.example.com", "/en/2", "example.com/en/"),
                   3: ("x.net", "/es/", "net/es/"), 4: ("net", "/fr/", "net/fr/"), 5: ("com", "", None), 6: ("", "", None),
                   7: ("", "", None), 8: ("x.org", "/net/es/", None)}
    assert urlfilter.judge_urls(df.limit(0)).count() == 0


def test_revisit_edges(spark):
    rows = [(1, "http://A.com/x/", 100, "response", "e1", {"etag": "e1", "x": "1"}, "p1"),
            (2, "https://www.a.com/x?utm_source=q", 200, "revisit", "e1", {"Date": "d", "x": "2"}, None),
            (3, "http://a.com/x", 90_000, "revisit", "e2", None, None), (4, None, 300, "revisit", None, None, None),
            (5, "http://a.com/y", 50, "revisit", None, None, None), (6, "http://a.com/x", None, "revisit", None, None, None)]
    df = spark.createDataFrame(rows, "record_id BIGINT, url STRING, at BIGINT, kind STRING, etag STRING, headers MAP<STRING,STRING>, payload_digest STRING")
    df = df.withColumn("fetched_at", F.timestamp_seconds("at")).withColumn("last_modified", F.lit(None).cast("timestamp"))
    got = {r.record_id: r for r in warc.resolve_revisits(df, bucket_seconds=60).collect()}
    assert {i: r.resolution for i, r in got.items()} == {
        1: "full", 2: "resolved", 3: "etag differs", 4: "no url or time", 5: "no earlier response", 6: "no url or time"}
    assert got[2].refers_to == 1 and got[2].resolved_headers == {"etag": "e1", "x": "1", "date": "d"}


def test_revisit_validators(spark):
    rows = [(1, 0, "response", None, 10), (2, 1, "revisit", "e", 20), (3, 2, "revisit", "e", 10), (4, 3, "revisit", None, 20),
            (5, 4, "revisit", "e", None), (6, 10, "response", "e", 10), (7, 11, "revisit", "e", 20), (8, 12, "revisit", "f", 10)]
    df = spark.createDataFrame(rows, "record_id BIGINT, at BIGINT, kind STRING, etag STRING, lm BIGINT").select(
        "record_id", F.lit("http://a.com/").alias("url"), F.timestamp_seconds("at").alias("fetched_at"), "kind", "etag",
        F.timestamp_seconds("lm").alias("last_modified"), F.lit(None).cast("map<string,string>").alias("headers"),
        F.lit("p").alias("payload_digest"))
    assert {r.record_id: r.resolution for r in warc.resolve_revisits(df).collect()} == {
        1: "full", 2: "last-modified differs", 3: "resolved", 4: "last-modified differs", 5: "resolved",
        6: "full", 7: "resolved", 8: "etag differs"}


# ---- 5 and 6 tokens ----

def test_bpe_equals_the_library(spark, docs):
    whole = Tokenizer.from_file(tokenizer_path())
    got = {r.doc_id: r for r in QUERIES["op5_bpe"](spark, SF).collect()}
    for r in docs.select("doc_id", "text").collect():
        ids = whole.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        text = whole.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_odd_characters():
    coder, whole = bpe.ForcedBoundaryBPE(open(tokenizer_path()).read()), Tokenizer.from_file(tokenizer_path())
    pool = ["a", "B", "'s", "'ll", " ", "\n", "\x1c", "\x85", "\xa0", "é", "É", "é", "Σ", "ς", "İ", "ß", "中", "🙂",
            "<|endoftext|>", "<|startoftext|>", "1", "½", "_", "-", "…", "​", "﻿", " ", "ﬁ", "the", "ing"]
    rnd = random.Random(5)
    for _ in range(1500):
        x = "".join(rnd.choice(pool) for _ in range(rnd.randrange(14)))
        ids = whole.encode(x, add_special_tokens=False).ids
        assert bpe.unpack_ids(coder.encode(x)) == ids, repr(x)
        assert coder.decode(coder.encode(x)) == whole.decode(ids, skip_special_tokens=False)
    assert bpe.unpack_ids(coder.encode("x" * 50_000)) == whole.encode("x" * 50_000, add_special_tokens=False).ids
    assert any(len(coder.fragments(w)) > 1 for w in (b"zqxj", b"thqzing", b"wvkq"))


def test_token_counts_equal_brute_force(spark):
    d = edge_docs(spark)
    out = bpe.encode_documents(d, tokenizer_path())
    assert out.count() == 9 and out.where("doc_id = 3").first().n_tokens == 0
    lengths = [r.n_tokens for r in out.select("n_tokens").collect()]
    counts = token_counts.token_counts(d, tokenizer_path()).cache()
    for r in counts.collect():
        limit = r.n_tokens
        assert r.n_docs == lengths.count(limit) and r.docs_cut == sum(n > limit for n in lengths)
        assert r.tokens_kept == sum(min(n, limit) for n in lengths)
        assert r.tokens_from == sum(n for n in lengths if n >= limit) and r.total_tokens == sum(lengths)
    for limit in (0, 2, 5, 1000, 10**7):
        got = token_counts.at_limit(counts, limit).first()
        assert tuple(got) == (sum(n > limit for n in lengths), sum(min(n, limit) for n in lengths))
    assert token_counts.length_quantile(counts, 0.5).first()[0] == sorted(lengths)[4]
    assert token_counts.token_counts(d.limit(0), tokenizer_path()).count() == 0


# ---- 8 toxicity ----

def test_toxicity_held_out(spark):
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    bad = ["grunk", "splorf", "vextu", "moddle"]
    rows = []
    for i in range(1500):
        y = int(rnd.random() < 0.2)
        t = [rnd.choice(words) for _ in range(rnd.randrange(5, 80))]
        if y:
            t[rnd.randrange(len(t))] = rnd.choice(bad) + rnd.choice(["", "a", "en"])
        rows.append((i, " ".join(t), y))
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, toxic INT")
    out = toxicity.score_documents(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    out = out.join(df.select("doc_id", "toxic"), "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    hits = sum(r.predicted == r.toxic for r in out) / len(out)
    assert hits >= 0.97, hits
    flagged = sum(1 for r in out if r.predicted == 1 and r.toxic == 0)
    assert flagged <= 2


def test_toxicity_edges(spark):
    d = edge_docs(spark)
    none = spark.createDataFrame([], "doc_id BIGINT, toxic INT")
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 5), (3, 1), (3, 0)], "doc_id BIGINT, toxic INT")
    for labels in (none, odd):
        rows = toxicity.score_documents(d, labels).collect()
        assert len(rows) == 9 and all(r.score == 0.0 and r.predicted == 0 for r in rows)
    assert toxicity.drop_toxic(d, none).columns == d.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity.score_documents(d, labels).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_documents(d.limit(0), labels).count() == 0


# ---- the pipeline ----

def test_pipeline_equals_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    bad = {r.doc_id for r in QUERIES["op8_toxicity"](spark, SF).where("predicted = 1").collect()}
    fp = {i: plain_simhash(r.text) for i, r in docs.items() if i not in bad}
    group = plain_groups(set(fp.values()), 2)
    low = {}
    for i, v in fp.items():
        low[group[v]] = min(low.get(group[v], i), i)
    kept = sorted(low.values())
    n = {}
    for i in kept:
        n[docs[i].source] = n.get(docs[i].source, 0) + 1
    weight = {s: int(c ** 0.5 * mixing.WEIGHT_UNIT) for s, c in n.items()}
    want = {}
    for i in kept:
        s = docs[i].source
        mean = len(kept) * weight[s] / sum(weight.values()) / n[s]
        key = f"{mixing.SEED}|{i}|{hashlib.md5(docs[i].text.encode()).hexdigest()}|n|1"
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / (1 << 52)
        p = c = np.exp(-mean)
        k = 0
        while c <= u:
            k += 1
            p *= mean / k
            c += p
        if k:
            want[i] = k
    got = {}
    whole = Tokenizer.from_file(tokenizer_path())
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
        if got[r.doc_id] == 1 and r.doc_id % 5 == 0:
            assert bpe.unpack_ids(bytes(r.token_ids)) == whole.encode(docs[r.doc_id].text, add_special_tokens=False).ids
    assert got == want


def test_pipeline_stages_keep_the_columns(spark):
    d = edge_docs(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, d, SF).columns == d.columns
        assert stage(spark, d.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, d, SF).count() == 9
