"""Ranked lexical search, the Jaccard join and tokenizer alignment against brute force and
their edge cases; measured faults of earlier operators that must not come back."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.llm import alignment, ann, jaccard, lexical, mixing, simhash, urlfilter, warc
from eddyline.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path
from tools.compare import compare, duck

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
CLASHING = "rid LONG, key STRING, x INT, doc_id LONG, text STRING, hashes STRING, n INT"


def clashing(spark, rows):
    return spark.createDataFrame([(7, "k", 1, i, t, "h", 2) for i, t in rows], CLASHING)


# ---- 11 ranked lexical search ----

@pytest.mark.parametrize("name", ["op11_lexical"])
def test_search_equals_sql(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF, duck(SF))
    assert r["schema_match"] and r["value_match"], r


def plain_ranking(docs, items, k):
    bags = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    total = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    want = defaultdict(set)
    for i, t in items:
        want[i] |= set(TERM.findall((t or "").translate(LOWER)))
    out = {}
    for item, ts in want.items():
        scores = []
        for i, b in bags:
            n = b.total()
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10 ** 9 * b[t]) // (1000 * b[t] + 20 * (50 + (50 * n * n_docs) // total))) for t in ts if t in b)
            if s > 0:
                scores.append((s, i))
        scores.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        if scores:
            out[item] = scores[:k]
    return out


@pytest.mark.parametrize("chunk_terms", [1 << 18, 7])
def test_search_equals_brute_force_at_the_edges(spark, chunk_terms, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)] + ["É漢", "A1", "a1"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(300)]
    docs += [(5, "w1 w1 w2"), (5, "w1 w1 w2"), (None, "w1 w1 w2"), (900, None), (901, ""), (902, "--- ..."),
             (903, "w3," * 50_000), (904, "w1 w1 w2")]
    items = [(1, "w1 W2,w3"), (2, "É漢 a1 A1"), (3, None), (4, "zzz"), (None, "w4"), (None, "w5 w4"),
             (6, " ".join(words)), (7, "w9"), (7, "w9")]
    monkeypatch.setattr(lexical, "BLOCK_ROWS", 16)
    got = lexical.rank_documents(clashing(spark, docs), spark.createDataFrame(items, "item_id LONG, text STRING"), k=8,
                                 chunk_terms=chunk_terms).collect()
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: r.rank):
        found[r.item_id].append((r.rank, r.score, r.doc_id))
    want = {i: [(n, s, d) for n, (s, d) in enumerate(v, 1)] for i, v in plain_ranking(docs, items, 8).items()}
    assert dict(found) == want


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id LONG, text STRING")
    items = spark.createDataFrame([(1, "a")], "item_id LONG, text STRING")
    assert lexical.rank_documents(none, items).count() == 0
    assert lexical.rank_documents(spark.createDataFrame([(1, "a")], "doc_id LONG, text STRING"),
                                  items.where("false")).count() == 0


def test_masks_group_documents():
    bits = np.array([[1, 1, 0, 0, 1], [0, 1, 0, 0, 0], [1, 1, 0, 0, 1]], dtype=np.uint8)
    masks, docs, first = lexical.mask_groups(np.packbits(bits, axis=1), 5)
    groups = {frozenset(g.tolist()) for g in np.split(docs, first[1:])}
    assert groups == {frozenset({0, 4}), frozenset({1})} and masks.shape[1] == 2


# ---- 12 Jaccard join ----

def plain_sets(rows, words=3):
    out = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        out.append((i, {" ".join(w[k:k + words]) for k in range(len(w) - words + 1)} or ({" ".join(w)} if w else set())))
    return out


def plain_components(sets, percent=90):
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        ids = [j for j in (low.get(root(k)), i) if j is not None]
        low[root(k)] = min(ids) if ids else None
    return sorted(((i, len(s), low[root(k)]) for k, (i, s) in enumerate(sets)), key=str)


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
    return " ".join(w)


@pytest.mark.parametrize("percent", [90])
def test_join_equals_brute_force(spark, percent, monkeypatch):
    monkeypatch.setattr(jaccard, "SHARE_ROWS", 3)
    rng = random.Random(percent)
    rows, n = [], 0
    for g in range(6):                   # groups of edited copies, some of them chained
        base = [f"g{g}w{rng.randrange(60)}" for _ in range(rng.choice([12, 60, 150]))]
        for _ in range(25):
            rows.append((n, edited(rng, base, rng.choice([0, 1, 1, 2, 4, 8]))))
            if rng.random() < 0.4:
                base = rows[-1][1].split()
            n += 1
    shared = " ".join(f"s{i}" for i in range(60))          # a passage that many texts hold
    rows += [(n + i, shared + " " + " ".join(f"u{i}_{j}" for j in range(rng.choice([3, 5, 8, 90])))) for i in range(40)]
    rows += [(1000, None), (1001, ""), (1002, "one"), (1003, "ONE"), (1004, "one two"), (None, "one two"), (None, " "),
             (1002, "one"), (1005, "x " * 3000), (1006, "x " * 9000)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id)
                  for r in jaccard.jaccard_components(clashing(spark, rows), percent=percent).collect()), key=str)
    assert got == plain_components(plain_sets(rows), percent)


def test_query_of_the_join_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op12_jaccard"](spark, SMALL).collect()), key=str)
    assert got == plain_components(plain_sets(rows))


def test_join_of_a_large_group_of_edited_copies_compares_few_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHARE_ROWS", 3)
    rng = random.Random(12)
    base, rows = [f"b{i}" for i in range(150)], []

    def copy(words, n):
        w = list(words)
        for k in rng.sample(range(len(w)), n):
            w[k] = f"c{rng.randrange(1 << 30)}" if rng.random() < 0.7 else f"e{rng.randrange(9)}"
        return w

    for _ in range(150):                 # most are far from one another and near the middle
        rows.append((len(rows), " ".join(copy(base, rng.choice([0, 1, 2, 3, 4, 4, 5, 5, 5])))))
    other = copy(base, 4)                # a group of its own near the first one
    for _ in range(60):
        rows.append((len(rows), " ".join(copy(other, rng.choice([0, 1, 1, 2])))))
    plain, compared = jaccard._similar, []

    def counting(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(jaccard, "_similar", counting)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id)
                  for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()), key=str)
    assert got == plain_components(plain_sets(rows))
    assert sum(compared) < 8 * len(rows), compared


def test_join_of_an_empty_table(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id LONG, text STRING")).count() == 0


def test_prefix_length():
    assert [jaccard.prefix_length(n, 90) for n in (0, 1, 9, 10, 11, 100)] == [0, 1, 1, 2, 2, 11]


# ---- 13 alignment ----

@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    back = {c: i for i, c in enumerate(alignment.byte_symbols())}

    def tokens(text):
        ia = a.encode(" " + text, add_special_tokens=False).ids
        ib = b.encode(text)
        pa = [bytes(back[c] for c in a.id_to_token(i)) for i in ia]
        pb = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
              for i in ib]
        whole = (" " + text).encode()
        return (ia, pa, ib, pb) if b"".join(pa) == whole == b"".join(pb) else None
    return tokens


def plain_alignment(rows, tokens):
    per, count = [], Counter()
    for i, t in rows:
        made = tokens(t) if t else None
        if made is None:
            per.append((i, 0, 0, 0, [], ""))
            continue
        ia, pa, ib, pb = made
        ea, eb = np.cumsum([len(x) for x in pa]).tolist(), np.cumsum([len(x) for x in pb]).tolist()
        at_a, at_b = {e: k + 1 for k, e in enumerate(ea)}, {e: k + 1 for k, e in enumerate(eb)}
        links, spans, x, y = [], [], 0, 0
        for e in sorted(set(ea) & set(eb)):
            ga, gb = ia[x:at_a[e]], ib[y:at_b[e]]
            x, y = at_a[e], at_b[e]
            links += [(p, q) for p in ga for q in gb]
            spans.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        count.update(set(links))
        per.append((i, len(ia), len(ib), len(spans), links, hashlib.sha256(";".join(spans).encode()).hexdigest()))
    top = defaultdict(int)
    for (p, _), c in count.items():
        top[p] = max(top[p], c)
    return sorted(((i, a, b, g, len(links), sum(count[x] == top[x[0]] for x in links), sum(count[x] for x in links), h)
                   for i, a, b, g, links, h in per), key=str), count


ODD = [(-1, None), (-2, ""), (-3, "▁x y"), (-4, "a  b \n c\td <|endoftext|> <s> é😀 漢字"), (-5, " "), (-6, "a" * 3000),
       (-7, "it's  a 'test' x"), (-8, " 　lead and  trail "), (-9, "x " * 300 + "é" * 90 + " ▁"), (-9, "same"),
       (-9, "same"), (None, "no id\x00\x01 ﬁ ① é"), (-10, "\n\nx\r\n y \u0085z\x1c w"), (-11, "x" * 100 + " " + "y" * 100)]


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 0])
def test_alignment_equals_the_libraries(spark, libraries, limit):
    rows = ODD + [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    out, pairs = alignment.align(clashing(spark, rows), tokenizer_path("byte_bpe_50k.json"),
                                 tokenizer_path("piece_bpe_32k.model"), broadcast_pairs=limit)
    got = sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                  for r in out.collect()), key=str)
    want, count = plain_alignment(rows, libraries)
    assert got == want
    assert {(r.a, r.b): r.c for r in pairs.collect()} == dict(count)


def test_query_of_the_alignment_equals_the_libraries(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted((tuple(r) for r in QUERIES["op13_alignment"](spark, SMALL).select(*cols).collect()), key=str)
    assert got == plain_alignment(rows, libraries)[0]


def test_pieces_kept_in_two_generations(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "TABLE_ENTRIES", 5)
    with open(tokenizer_path("byte_bpe_50k.json")) as a, open(tokenizer_path("piece_bpe_32k.model"), "rb") as b:
        both = alignment.Aligner(a.read(), b.read())
    texts = [" ".join(f"t{i}x{j}" for j in range(i, i + 4)) for i in range(12)] * 2
    got = [(n_a, n_b, g, h) for t in texts for n_a, n_b, g, _, h in both.documents([t])]
    want = [r[1:4] + (r[5],) for r in [(0, *x) for x in [
        (w[1], w[2], w[3], None, w[7]) for t in texts for w in plain_alignment([(0, t)], libraries)[0]]]]
    assert got == want


def test_alignment_of_an_empty_table(spark):
    out, pairs = alignment.align(spark.createDataFrame([], "doc_id LONG, text STRING"),
                                 tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    assert out.count() == 0 and pairs.count() == 0


def test_galloping_finds_common_values():
    rng = np.random.default_rng(1)
    for n, m in [(0, 5), (1, 1), (5, 9000), (3000, 9000), (9000, 9000)]:
        a, b = (np.unique(rng.integers(0, 12_000, k)) for k in (n, m))
        ia, ib = alignment.gallop(a, b)
        assert a[ia].tolist() == np.intersect1d(a, b).tolist() == b[ib].tolist()


def test_packed_pairs():
    codes = np.array([0, 3, 1 << 31, (1 << 40) + 5], dtype=np.uint64)
    back, times = alignment.unpack(alignment.pack(codes, np.array([1, 2, 3, 70_000])))
    assert back.tolist() == codes.tolist() and times.tolist() == [1, 2, 3, 70_000]


# ---- earlier operators: results that were lost ----

def test_neighbours_are_complete_when_the_routed_parts_hold_few_ids(spark):
    rng = np.random.default_rng(0)
    near, far = rng.normal(size=8), rng.normal(size=(3998, 8))
    rows = [(0, near.tolist())] + [(1, (near + 1e-3).tolist())] * 1500 + [(i + 2, v.tolist()) for i, v in enumerate(far)]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")
    got = ann.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r.rank for r in got] == [1, 2, 3, 4, 5] and got[0].vec_id == 1 and len({r.vec_id for r in got}) == 5
    x = np.array([v for _, v in rows])
    c = x @ near / np.linalg.norm(x, axis=1) / np.linalg.norm(near)
    best = sorted({(-round(s, 12), i) for (i, _), s in zip(rows, c) if i})[:5]
    assert [r.vec_id for r in got] == [i for _, i in best]


def test_an_index_of_fewer_vectors_than_neighbours():
    assert ann.fit_index(np.random.default_rng(0).normal(size=(130, 4)), k=120).parts >= 1


def test_rows_that_differ_in_the_place_of_a_null_are_not_one(spark):
    t = "one two three four"
    df = spark.createDataFrame([(4, t, None, "s", {"a": 1}), (4, None, t, "s", {"a": 1}), (4, t, None, "s", {"a": 1})],
                               "doc_id LONG, text STRING, lang STRING, source STRING, extra MAP<STRING,INT>")
    assert sorted(r.text or "" for r in simhash.keep_one(df).collect()) == ["", t]


def test_a_hot_shard_is_cut_and_loses_no_link(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 42, 4000, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, base[:500] ^ np.uint64(1 << 7), base[:300] ^ np.uint64((1 << 40) | 1)]))
    df = spark.createDataFrame([(int(v),) for v in fps.view(np.int64)], "fp LONG")
    for limit in (4096, 300, 7):
        up = {int(v): int(v) for v in fps}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x
        for r in simhash.fingerprint_links(df, 2, limit).collect():
            assert (r.a ^ r.b).bit_count() >= 1
            up[root(r.a)] = root(r.b)
        for v in base[:500].tolist():
            assert root(v) == root(v ^ (1 << 7))
        for v in base[:300].tolist():
            assert root(v) == root(v ^ ((1 << 40) | 1))


def test_urls_are_judged_whole_and_in_linear_time(spark):
    rows = [(i, f"http://a.com/x{i}") for i in range(40)] + [(100 + i, f"http://b.net/es/casino{i}?evil=1") for i in range(40)]
    rows += [(200, "http://q.org/a?x=1"), (201, "http://q.org/a?evil=casino"), (202, "junk one"), (203, "casino casino"),
             (204, None), (205, "http://q.org/" + "ab" * 600_000)]
    df = spark.createDataFrame([(*r, "own", 1) for r in rows], "page_id LONG, url STRING, text STRING, _lm INT")
    got = {r.page_id: r for r in urlfilter.judge_urls(df).collect()}
    assert len(got) == len(rows) and {"text", "_lm"} <= set(got[0].asDict()) and got[0].text == "own"
    assert got[200].score != got[201].score and got[202].score != got[203].score
    assert got[201].verdict == "block" and got[202].host == "" and got[204].path == ""


def test_threshold_is_set_on_urls_held_back(spark):
    scored = urlfilter.score_urls(spark.read.parquet(f"{SF}/pages.parquet"))
    found = urlfilter.accuracy(scored, urlfilter.threshold(scored))
    assert set(found) == {"allow", "block"} and all(n > 0 and right / n > 0.6 for right, n in found.values())


RECORDS = ("record_id LONG, url STRING, fetched_at TIMESTAMP, kind STRING, etag STRING, last_modified TIMESTAMP, "
           "headers MAP<STRING,STRING>, payload_digest STRING, _k STRING, _b INT, _carry INT")


def test_revisits_with_clashing_columns_schemes_and_header_names(spark):
    rows = [(1, "https://a.com:80/x?ref=v2", 10, "response", None, None, {"Date": "1", "date": "2", "X": "y"}, "d1"),
            (2, "ftp://a.com/x?ref=v1", 20, "revisit", None, None, {"Date": "3", "date": "4"}, None),
            (3, "HTTPS://www.A.com:80/x/?ref=v2&utm_a=1#f", 30, "revisit", None, None, {"Date": "5", "date": "6"}, None),
            (3, "https://a.com:80/x?ref=v2", 30 + 86_400 * 3, "revisit", None, None, None, None),
            (4, "https://a.com:443/", 40, "response", None, None, None, "d4"),
            (5, "http://a.com:80", 50, "revisit", None, None, None, None)]
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], RECORDS.replace("fetched_at TIMESTAMP", "fetched_at LONG"))
    df = df.withColumn("fetched_at", F.timestamp_seconds("fetched_at"))
    got = sorted(warc.resolve_revisits(df).collect(), key=lambda r: (r.record_id, r.fetched_at))
    assert [r.resolution for r in got] == ["full", "no earlier response", "resolved", "resolved", "full", "resolved"]
    assert [r.refers_to for r in got] == [None, None, 1, 1, None, 4]
    assert got[2].resolved_headers == {"X": "y", "date": "6"} and (got[0]._k, got[0]._b, got[0]._carry) == ("k", 1, 2)
    assert warc.resolve_revisits(df.where("false")).count() == 0
    assert warc.resolve_revisits(df.unionAll(df)).count() == 12


def test_mixing_with_clashing_columns(spark):
    schema = "doc_id LONG, text STRING, source STRING, _rate_parts INT, copy STRING, _salt INT, m MAP<STRING,INT>"
    df = spark.createDataFrame([(i, f"t{i}", "ab"[i % 2], 1, "c", 2, {"k": 1}) for i in range(200)], schema)
    out = mixing.poisson_mix(df, epochs=2.0)
    assert Counter(c.lower() for c in out.columns).most_common(1)[0][1] == 1
    assert isinstance(out.schema["copy"].dataType, T.LongType) and out.where("_rate_parts = 1").count() > 300
    rows = out.collect()
    assert [r.shuffle_key for r in rows] == sorted(r.shuffle_key for r in rows)
    few = spark.createDataFrame([(1, "a", "s")] * 3, "doc_id LONG, text STRING, source STRING")
    assert mixing.poisson_mix(few.where("false")).count() == 0
    assert all(v % 3 == 0 for v in Counter((r.doc_id, r.copy) for r in mixing.poisson_mix(few, epochs=3.0).collect()).values())
