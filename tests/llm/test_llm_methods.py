"""Each operator against a brute-force version, a round trip or held-out accuracy."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle_check import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from corpusprep.llm import bpe_transducer, common, embed_dedup, exact_index, graph, hash_tree, html_main, labelled_urls, langid, minhash_forest, packing, queries, suffix, suffix_dedup, url_filter
from corpusprep.llm.common import drop_rows, maybe_in, on_workers
from corpusprep.llm.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def documents(spark):
    on_workers(spark)
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.mark.parametrize("name", ORACLE)
def test_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, queries.QUERIES[name], ORACLE[name]) is None


# Suffix arrays


@pytest.mark.parametrize("size", [1, 2, 7, 60, 300])
@pytest.mark.parametrize("kinds", [1, 2, 5])
def test_suffix_array(size, kinds):
    text = np.random.default_rng(size).integers(0, kinds, size)
    order, _ = suffix.suffix_array(text, size + 1)
    assert order.tolist() == sorted(range(size), key=lambda i: text[i:].tolist())
    common = suffix.common_prefixes(text, order, size, lanes=5)
    for at in range(1, size):
        a, b = text[order[at - 1] :].tolist(), text[order[at] :].tolist()
        n = common[at]
        assert a[:n] == b[:n] and (n == len(a) or n == len(b) or a[n] != b[n])


def test_documents_without_id_are_dealt_out():
    rng = np.random.default_rng(1)
    groups = suffix_dedup.group_of(np.full(7000, suffix_dedup.LAST_ID), rng.integers(0, 1 << 60, 7000), 7)
    assert (np.bincount(groups, minlength=7) > 800).all()


def test_groups_of_documents_agree(spark):
    rows = [(i, t) for i in (-5, 0, 3, suffix_dedup.LAST_ID) for t in (0, 12345678901234567, (1 << 60) - 1)]
    found = spark.createDataFrame(rows, "id long, tag long").withColumn("group", suffix_dedup._group_column(7)).collect()
    assert all(r.group == suffix_dedup.group_of(np.array([r.id]), np.array([r.tag]), 7)[0] for r in found)


def test_frequent_stretches_leave_a_task_once(spark):
    on_workers(spark)
    passage = "".join(random.Random(7).choice("abcdefgh ") for _ in range(400))
    rows = [(i if i % 3 else None, i, passage if i % 2 else "x" * 500) for i in range(200)]
    runs = suffix_dedup._runs(spark.createDataFrame(rows, "id long, tag long, text string").fillna(suffix_dedup.LAST_ID, ["id"]).coalesce(1), 3).collect()
    sent = [d for r in runs if not r.known for d in np.frombuffer(r.digest, np.uint64).tolist()]
    assert sent and len(sent) == len(set(sent))
    assert sum(len(r.n) for r in runs if r.known) > 100 * len(sent)


def test_suffix_array_of_bounded_depth():
    text = np.random.default_rng(1).integers(0, 2, 200)
    _, rank = suffix.suffix_array(text, 5)
    for i in range(200):
        for j in range(200):
            assert (rank[i] == rank[j]) == (text[i : i + 5].tolist() == text[j : j + 5].tolist())


def removed(corpus, length=100):
    """(bytes removed, runs, digest of the rest) by looking every string up among the earlier ones."""
    seen, out = set(), {}
    for key in sorted(corpus):
        data = corpus[key]
        covered = np.zeros(len(data) + 1, np.int64)
        for p in range(max(0, len(data) - length + 1)):
            string = data[p : p + length]
            if string in seen:
                covered[p : p + length] = 1
            seen.add(string)
        covered = covered[:-1]
        rest = bytes(np.frombuffer(data, np.uint8)[covered == 0])
        out[key] = (int(covered.sum()), int((np.diff(np.concatenate([[0], covered])) == 1).sum()), hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize("bounds", [{}, {"group_bytes": 20_000, "shard_bytes": 5_000, "most_alike": 2}])
def test_suffix_dedup(spark, documents, texts, bounds):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8)))
    passage = " ".join(word() for _ in range(60))
    corpus = dict(list(texts.items())[:120])
    for i in range(40):
        # A passage in many surroundings, whole and in part, periodic texts, and copies.
        a = rng.randint(0, 40)
        corpus[1000 + i] = " ".join(word() for _ in range(20)) + passage[a : a + rng.randint(90, 300)] + " ".join(word() for _ in range(20))
    corpus |= {2000: "ab" * 300, 2001: "ba" * 200 + "c" * 150, 2002: corpus[1003], 2003: "x" * 99, 2004: "x" * 100, 2005: "x" * 100}
    docs = spark.createDataFrame(list(corpus.items()), "doc_id long, text string").repartition(5)
    want = removed({i: t.encode() for i, t in corpus.items()})
    for r in suffix_dedup.clean(docs, **bounds).collect():
        got = (sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
        assert got == want[r.id], r.id


def alike_windows(number):
    """Windows of which parts are in others too, as at the ends of repeated passages."""
    rng = np.random.default_rng(5)
    passage = rng.integers(97, 123, 400, dtype=np.uint8).tobytes()
    return [rng.integers(97, 123, 20, dtype=np.uint8).tobytes() + passage[a : a + 115] for a in rng.integers(0, 280, number).tolist()]


def test_suffix_arrays_of_windows_take_little_memory():
    windows = alike_windows(2000)
    tracemalloc.start()
    try:
        suffix_dedup.repeated_starts(windows, np.full(len(windows), 36))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 64 * sum(map(len, windows))


def test_digests_of_strings_are_made_in_blocks(monkeypatch):
    windows = alike_windows(2000)
    chosen = np.arange(0, 36 * len(windows), 7)
    monkeypatch.setattr(common, "_POWERS", {})
    got = suffix_dedup._strings(windows, np.full(len(windows), 36), chosen)
    assert max(len(table[0]) for table in common._POWERS.values()) <= 2 * (suffix_dedup.BLOCK_BYTES + 100)
    for k in range(0, len(chosen), 997):
        window, start = divmod(int(chosen[k]), 36)
        own = suffix_dedup._strings([windows[window][start : start + 100]], np.ones(1, np.int64), np.zeros(1, np.int64))
        assert all(got[name][k] == own[name][0] for name in ("first", "second"))


def test_rows_without_repeated_passages_come_from_one_python_stage(spark):
    passage = "".join(random.Random(6).choices("abcdefgh", k=150))
    rows = [(1, 5, "one " + passage + "\u00e9"), (2, 6, "two " + passage + "\u00e8 end"), (3, 7, None), (4, 8, "short"), (5, 9, "short"), (6, 0, "one " + passage + "\u00e9")]
    kept = suffix_dedup.keep(spark.createDataFrame(rows, "doc_id long, n int, text string"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow" not in plan
    # The characters differ in their second byte; what is left of one goes with the passage.
    assert sorted(map(tuple, kept.collect())) == [(1, 5, rows[0][2]), (2, 6, "two end"), (3, 7, ""), (4, 8, "short"), (5, 9, "short"), (6, 0, "")]


def test_merge_sorted():
    rng = np.random.default_rng(2)
    runs = []
    for _ in range(6):
        n = 200
        first = np.sort(rng.choice(500, n, replace=False)).astype(np.uint64)
        runs.append({"first": first, "second": first * np.uint64(3), "id": rng.integers(0, 10**6, n), "tag": np.zeros(n, np.int64), "start": np.arange(n, dtype=np.uint32)})
    earliest = {}
    for run in runs:
        for d, i, s in zip(run["first"].tolist(), run["id"].tolist(), run["start"].tolist()):
            earliest[d] = min(earliest.get(d, (i, s)), (i, s))
    for run, later in zip(runs, suffix_dedup.merge_sorted(runs)):
        for d, i, s, x in zip(run["first"].tolist(), run["id"].tolist(), run["start"].tolist(), later):
            assert x == (earliest[d] != (i, s))


def test_far_least_agrees_in_parts():
    hashed = np.random.default_rng(0).integers(0, 1 << 63, 3000, dtype=np.uint64)
    want = [i + int(hashed[i : i + 69].argmin()) for i in range(len(hashed) - 68)]
    assert suffix_dedup._far_least(hashed, 69).tolist() == want


# Hash tree


def test_hash_tree_movement(spark):
    ids = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    shards = hash_tree.balanced(8)

    def placed(tree):
        return {r.doc_id: r.s for r in ids.select("doc_id", hash_tree.place([F.col("doc_id")], tree).alias("s")).collect()}

    before = placed(shards)
    assert all(400 < n < 600 for n in Counter(before.values()).values()) and len(set(before.values())) == 8
    after = placed(hash_tree.joined(shards, 8))
    assert all(after[i] in (before[i], 8) for i in before)
    assert 340 < sum(after[i] == 8 for i in before) < 550
    # A change of weight in one rack leaves alone what stays outside its region.
    changed = [hash_tree.Shard(s.region, s.rack, s.number, 3.0 if s.number == 0 else 1.0) for s in shards]
    moved = placed(changed)
    inside = {s.number for s in shards if s.region == "r0"}
    assert all(moved[i] == before[i] or moved[i] in inside for i in before)
    assert placed([hash_tree.Shard(s.region, s.rack, s.number, 0.0 if s.number else 1.0) for s in shards]) == dict.fromkeys(before, 0)


def test_hash_tree_columns(spark, documents, texts):
    rows = queries.op2_hash_tree(spark, SF_DIR).collect()
    slots = defaultdict(list)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key") and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == len(texts)


# Embeddings


def test_embeddings(spark):
    on_workers(spark)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 16))
    rows = [base[rng.integers(30)] + rng.normal(size=16) * rng.choice([0, 0.05, 0.2, 0.3]) for _ in range(400)]
    v = np.array(rows, np.float32).astype(np.float64)
    u = v / np.linalg.norm(v, axis=1)[:, None]
    links = u @ u.T >= 0.95
    label = np.arange(len(v))
    for _ in range(len(v)):
        label = np.where(links, label[None, :], len(v)).min(1)
    vectors = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "vec_id long, embedding array<float>")
    for band in (4096, 50):
        for r in embed_dedup.link(vectors, 0.95, band=band).collect():
            assert (r.n_links, r.component_id, r.kept) == (links[r.id].sum() - 1, label[r.id], label[r.id] == r.id)


@given(st.integers(1, 80), st.integers(0, 10**6))
@settings(max_examples=40, deadline=None)
def test_quantisation_bound(size, seed):
    rng = np.random.default_rng(seed)
    a, b = (x / np.linalg.norm(x, axis=1)[:, None] for x in rng.normal(size=(2, 5, size)) ** 3 + 1e-3)
    (qa, sa, ea), (qb, sb, eb) = embed_dedup.quantise(a), embed_dedup.quantise(b)
    gap = np.abs((qa @ qb.T) * sa[:, None] * sb[None] - a @ b.T)
    assert (gap <= ea[:, None] + eb[None] + ea[:, None] * eb[None] + 1e-9).all()


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000 + i, 2000) for i in range(50)]
    label = {}
    for a, b in links:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(100):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "x long, y long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {n: c for n, c in label.items() if n in linked}


# Packing


def test_packing(spark, documents, texts):
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}
    rows = packing.pack(documents, JSON).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r.id][r.start : r.start + r.length]
        data = np.array(own, "<u4").tobytes()
        assert bytes(r.ids) == data and r.ids_crc32 == zlib.crc32(data)
        docs[r.id].append(r)
        sequences[r.sequence_id].append(r)
    for i, pieces in docs.items():
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert sum(r.length for r in pieces) == len(ids[i]) and all(r.length == 1024 for r in pieces[1:])
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert sum(r.length for r in pieces) <= 1024
    assert set(docs) == set(texts) and len(sequences) <= 1.02 * sum(map(len, ids.values())) / 1024 + 1


@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 6))
@settings(max_examples=60, deadline=None)
def test_best_fit_rules(lengths, open_bins):
    bins, free = packing.BestFit(50, open_bins), {}
    opened = []
    for length in lengths:
        fitting = [f for b, f in free.items() if f >= length]
        at, offset = bins.place(length)
        if fitting:
            assert free[at] == min(fitting) and offset == 50 - free[at]
            free[at] -= length
        else:
            assert offset == 0 and at not in opened
            if len(free) >= open_bins:  # the fullest has closed
                del free[min(free, key=lambda b: (free[b], -opened.index(b)))]
            opened.append(at)
            free[at] = 50 - length
        free = {b: f for b, f in free.items() if f}
        assert sorted(free.values()) == sorted(f for f, own in enumerate(bins.by_free) for _ in own) and len(free) <= open_bins


# The hash tree


def test_draws_of_the_hash_tree(spark, texts):
    """Shards worked out draw by draw with another implementation of the hash."""

    def drawn(doc_id, level, child, weight):
        h = xxhash.xxh64_intdigest((doc_id or 0).to_bytes(8, "little", signed=True), 42) if doc_id is not None else 42
        h = xxhash.xxh64_intdigest(level.encode(), h)
        h = xxhash.xxh64_intdigest(child.encode() if isinstance(child, str) else child.to_bytes(4, "little"), h)
        return -math.log(((h >> 11) + 0.5) / float(1 << 53)) / weight

    def descended(doc_id, shards):
        level_of = {"region": lambda s: s.region, "rack": lambda s: s.rack, "shard": lambda s: s.number}
        for level, name in level_of.items():
            weights = defaultdict(float)
            for s in shards:
                weights[name(s)] += s.weight
            best = min((drawn(doc_id, level, child, w), child) for child, w in weights.items() if w)[1]
            shards = [s for s in shards if name(s) == best]
        return shards[0].number

    shards = [hash_tree.Shard(f"r{i // 4}", f"k{i // 2}", i, 1 + i % 3) for i in range(8)] + [hash_tree.Shard("r9", "k9", 8, 0.0)]
    docs = spark.createDataFrame([*texts.items(), (None, "x"), (-5, "y")], "doc_id long, text string")
    for r in hash_tree.shard(docs, shards, hash_tree.joined(shards, 9, 2.0)).collect():
        assert (r.shard, r.grown_shard) == (descended(r.id, shards), descended(r.id, hash_tree.joined(shards, 9, 2.0)))
    query = queries.op2_hash_tree(spark, SF_DIR).collect()
    even = hash_tree.balanced(8)
    assert all((r.shard, r.grown_shard) == (descended(r.doc_id, even), descended(r.doc_id, hash_tree.joined(even, 8))) for r in query)


# URLs


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        ("http://Example.ORG/es/a?q", "example.org", "/es/a", "example.org/es/"),
        ("https://a.example.org/en/17#x", "a.example.org", "/en/17", "example.org/en/1"),
        ("https://a.example.org/en/27", "a.example.org", "/en/27", "org/"),
        ("https://notexample.org/es/", "notexample.org", "/es/", "org/"),
        ("https://x.org", "x.org", "", None),
        ("https://x.org?/a", "x.org", "", None),
        ("https://xorg/", "xorg", "/", None),
        ("http://b.com/fr/1", "b.com", "/fr/1", "com/fr/"),
        ("http://b.com/de/1", "b.com", "/de/1", "com/de/"),
        ("http://b.com/de", "b.com", "/de", None),
        ("x://y://z/w", "y:", "//z/w", None),
        ("no scheme", "", "", None),
    ],
)
def test_url_rules(spark, url, host, path, rule):
    h, p = url_filter.host_and_path(F.lit(url))
    r = url_filter.fitting_rule(h, p, url_filter.RULES)
    row = spark.range(1).select(h.alias("h"), p.alias("p"), r["name"].alias("r")).first()
    assert tuple(row) == (host, path, rule)


def test_url_model():
    model = url_filter.train()
    blocked = [("free-casino.example", "/poker/bonus"), ("adult-cams.example", "/en/17.html"), ("www.warez-keygen.example", "/"), ("tools.example", "/porn/free-sex-clips")]
    allowed = [("news.city.example", "/2023/08/council-meeting"), ("wiki.example", "/en/History"), ("m.thereon.example", "/books/17.html"), ("", "")]
    assert all(model.score(*u) >= url_filter.LIMIT for u in blocked) and all(model.score(*u) < url_filter.LIMIT for u in allowed)


def test_url_model_on_words_it_never_saw():
    """Every word is left out once with all rows that it makes; hosts made of it are judged by what the others taught."""
    rows = labelled_urls.labelled()
    words = [(w, True) for w in labelled_urls.BLOCKED_WORDS] + [(w, False) for w in labelled_urls.FINE_WORDS]
    # Names chosen for the letters that they share with blocked ones come after the ordinary ones.
    ordinary = set(labelled_urls.FINE_WORDS[: labelled_urls.FINE_WORDS.index("essex")])
    found, mistaken = [], []
    for fold in range(8):
        held = words[fold::8]
        out = {w for w, _ in held}
        model = url_filter.train([r for r in rows if r[3] not in out])
        for word, block in held:
            for host in (f"{word}.example.com", f"www.{word}-club.example.net", f"get{word}.example.org"):
                verdict = model.score(host, "/en/17.html") >= url_filter.LIMIT
                if block:
                    found.append(verdict)
                elif word in ordinary:
                    mistaken.append(verdict)
    assert len(found) > 900 and np.mean(found) >= 0.8 and len(mistaken) > 200 and np.mean(mistaken) < 0.02


def test_url_verdicts_one_by_one(spark):
    """Hosts, paths, rules and scores of the table's URLs worked out without the operator's functions."""
    model = url_filter.train()
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()}
    verdicts = set()
    for r in queries.op5_url_filter(spark, SF_DIR).collect():
        host, path = "", ""
        if "://" in (urls[r.page_id] or ""):
            rest = re.split("[?#]", urls[r.page_id].split("://", 1)[1])[0]
            host, _, path = rest.partition("/")
            host, path = host.lower(), ("/" + path if "/" in rest else "")
        fits = [(len(h + p), h + p, v) for h, p, v in rules if f".{host}".endswith(f".{h}") and path.startswith(p)]
        z = url_filter.PRIOR
        for text, seed in ((host, 1), (path, 2)):
            grams = {f"^{text.lower()}$".encode()[i : i + n] for n in (3, 4, 5) for i in range(len(text) + 3 - n)} if text else set()
            places = {zlib.crc32(g, seed) % len(model.weights) for g in grams}
            z += sum(model.weights[k] for k in places) / max(1, len(places)) ** 0.5
        score = 1 / (1 + math.exp(-z))
        _, rule, verdict = max(fits, default=(0, None, "block" if score >= url_filter.LIMIT else "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict) and r.score == pytest.approx(score, abs=1e-9)
        verdicts.add((rule is None, verdict))
    assert verdicts == {(a, b) for a in (True, False) for b in ("allow", "block")}


# Pages


def test_main_text_by_markup():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><header><a>Site</a></header><nav><ul><li>Menu</ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><aside>Side</aside><article><header><h1>Head&amp;line</h1></header>"
        "<p>One <b>tw</b>o\n three&nbsp;four<br>five<p>Six<script>var x='</p>'</script><div class='ad-box'>Buy</div><form>Mail</form>"
        "<ul><li>a<li>b</ul><section id=comments><p>First!</p></section></article><div id=sidebar>More</div><footer>&copy;</footer>"
    )
    assert html_main.main_texts([page]) == ["Head&line\n\nOne two three four five\n\nSix\n\na\n\nb"]


def test_main_text_by_repeats():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    body = [" ".join(word() for _ in range(40)) for _ in range(12)]
    top, end = "Welcome to our site of many fine things", "All rights reserved by the owners of this site"
    pages = [f"<div>{top}</div><div>{b}</div><div>{end}</div>" for b in body]
    assert html_main.main_texts(pages) == body
    # Articles stay, however often they occur.
    assert html_main.main_texts([f"<div>{top}</div><article>{body[0]}</article>"] * 6) == [body[0]] * 6


def test_main_text_beside_an_article():
    words = [" ".join(f"w{i}x{j}" for j in range(20)) for i in range(12)]
    top = "Welcome to our site of many fine things"
    pages = [f"<div>{top}</div><div>{words[i]}</div><article>{words[i + 6]}</article>" for i in range(6)]
    assert html_main.main_texts(pages) == [f"{words[i]}\n\n{words[i + 6]}" for i in range(6)]
    pages = [f"<div>{top}</div><main><p>{words[i]}</p><article>{words[i + 6]}</article></main>" for i in range(6)]
    assert html_main.main_texts(pages) == [f"{words[i]}\n\n{words[i + 6]}" for i in range(6)]


@pytest.mark.parametrize("around", ["div class='layout has-sidebar'", "div class=no-comments", "div class='page search-results'", "section id=toc-wrapper", "form", "div role=form", "div class=related"])
@pytest.mark.parametrize("name", ["article", "main"])
def test_main_text_in_named_elements(around, name):
    page = f"<{around}><div class=ad>Buy</div><{name}><p>The text<div class=share>Share</div></{name}><nav>Menu</nav></{around.split()[0]}>"
    assert html_main.main_texts([page]) == ["The text"]
    page = f"<{around}><h1>Head</h1><p>One <span class=ad>buy</span>two</p><{name}>The text</{name}></{around.split()[0]}>"
    assert html_main.main_texts([page]) == ["Head\n\nOne two\n\nThe text"]


def test_main_text_with_other_articles():
    others = "<div class=related><article>Another page</article></div>"
    page = f"<article>The text<section class=comments><article>First!</article></section></article>{others}<aside><article>Hint</article></aside>"
    assert html_main.main_texts([page]) == ["The text"]
    assert html_main.main_texts([f"<div class='page search-results'><article>The text</article></div>{others}"]) == ["The text"]


@pytest.mark.parametrize("chunk", [1 << 20, 2000, 300])
def test_main_text_counts_repeats_over_the_whole_host(spark, chunk):
    on_workers(spark)
    body = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(120)]
    # Ten of 120 pages share a line, which is over the limit of six; five share another.
    shared, rare = "A line that many pages of this host share", "Some words that too few pages here have in common"
    page = lambda i: f"<div>{shared if i % 12 == 0 else ''}</div><div>{rare if i % 24 == 1 else ''}</div><div>{body[i]}</div>"
    rows = [(i, f"http://{host}/{i}", page(i)) for host in ("a.org", "b.org") for i in range(120)]
    rows += [(i, f"http://c.org/{i}", f"<article>{shared}</article>") for i in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    found = {(r.url): r.text for r in html_main.extract(pages, chunk_bytes=chunk).collect()}
    assert len(found) == len(rows)
    for i, url, _ in rows:
        expected = shared if "c.org" in url else f"{rare}\n\n{body[i]}" if i % 24 == 1 else body[i]
        assert found[url] == expected


@pytest.mark.parametrize("chunk", [1 << 20, 2000, 300])
def test_all_pages_go_through_the_suffix_arrays(spark, chunk, monkeypatch):
    """Pages on which markup decides all, too: their hosts' shared stretches are those of a plain count."""
    on_workers(spark)
    rng = random.Random(5)
    lines = [" ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(40)) for _ in range(7)) for _ in range(30)]
    rows = [(i, f"http://{'ab'[i % 2]}.org/{i}", f"<article><p>{'</p><p>'.join(rng.sample(lines, 1 + i % 4))}</article>") for i in range(120)]
    rows += [(None, None, None), (7, "http://c.org/", "<article>one two three four five six</article>")] + [(8, "http://c.org/", "<article>one two three four five</article>")] * 3
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    shared = html_main.boilerplate_of
    kept = []
    monkeypatch.setattr(html_main, "boilerplate_of", lambda dealt: kept.append(shared(dealt)) or kept[-1])
    found = html_main.extract(pages, chunk_bytes=chunk)
    assert sorted(r.text for r in found.collect()) == sorted(re.sub("<[^>]*>", "", (h or "").replace("</p><p>", "\n\n")) for _, _, h in rows)
    want = Counter()
    for host in ("a.org", "b.org", "c.org"):
        of_host = [h for _, u, h in rows if u and host in u]
        on = Counter()
        for h in of_host:
            said = re.sub("<[^>]*>", " ", h).split()
            on.update({tuple(said[i : i + 5]) for i in range(len(said) - 4)})
        want[host] = sum(n >= html_main.least(len(of_host)) for n in on.values())
    got = Counter(r.host for r in kept[0].select("host", "stretch").collect())
    assert len(kept) == 1 and got == +want and set(got) == {"a.org", "b.org", "c.org"}


def test_main_text_of_the_table(spark):
    on_workers(spark)
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for chunk in (1 << 20, 5000):
        for r in html_main.extract(spark.read.parquet(f"{SF_DIR}/pages.parquet"), chunk_bytes=chunk).collect():
            inner = re.search(r"<article>(.*?)</article>", rows[r.id], re.S)[1]
            cut = [html_main.html.unescape(re.sub(r"<[^>]*>", "", x)) for x in re.split(r"</?(?:p|h1)>", inner)]
            assert r.text == "\n\n".join(" ".join(c.split()) for c in cut if c.strip()) and r.n_chars == len(r.text)


def plain_divs(page):
    """The page without the tags and classes that name its parts."""
    page = re.sub(r"<(/?)(?:article|main|nav|header|footer|aside|section|form|noscript)\b[^>]*>", r"<\1div>", page)
    return re.sub(r"\s(?:class|id|role|style|hidden)=?(?:'[^']*'|\"[^\"]*\"|[^\s>]*)?", "", page)


@pytest.mark.parametrize("chunk", [1 << 18, 4000])
def test_main_text_without_telling_markup(spark, chunk):
    """With all parts of the pages made plain, repeats alone find the article: precision and recall of its words."""
    on_workers(spark)
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").filter("page_id < 1000")
    want = {r.id: Counter(r.text.split()) for r in html_main.extract(pages).collect()}
    plain = spark.createDataFrame([(r.page_id, r.url, plain_divs(r.html)) for r in pages.collect()], "page_id long, url string, html string").repartition(4)
    right = found = wanted = 0
    for r in html_main.extract(plain, chunk_bytes=chunk).collect():
        own = Counter(r.text.split())
        right += sum((own & want[r.id]).values())
        found += sum(own.values())
        wanted += sum(want[r.id].values())
    assert right >= 0.9 * found and right >= 0.9 * wanted


# Near duplicates


def test_near_duplicates_refuse_what_the_forest_would_lose(documents):
    with pytest.raises(ValueError):
        minhash_forest.near(documents, 5, 70)
    with pytest.raises(ValueError):
        minhash_forest.keep(documents, 5, 79)


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


@pytest.mark.parametrize(("width", "bounds"), [(2, {}), (5, {}), (2, {"region": 3, "weight": 300})])
def test_near_duplicates(spark, texts, width, bounds):
    on_workers(spark)
    rng = random.Random(width)
    corpus = dict(list(texts.items())[:80])
    base = [t.split() for t in list(texts.values())[:6] if len(t.split()) > 30]
    for i in range(120):
        words = list(rng.choice(base)[:200])
        for _ in range(rng.choice([0, 1, 3, len(words) // 12])):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 50)}"
        corpus[1000 + i] = rng.choice([" ", "\n", "  "]).join(words)
    sets = {i: shingles(t, width) for i, t in corpus.items()}
    label = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in range(30):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    docs = spark.createDataFrame(list(corpus.items()), "doc_id long, text string").repartition(4)
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in minhash_forest.near(docs, width, 80, **bounds).collect()}
    assert got == {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


@pytest.mark.parametrize("width", [1, 2, 3, 5, 9])
def test_shingle_sets_of_few_words(width):
    """A block may hold a few words in all; the sets of its texts are those that they have among longer texts."""
    long = " ".join(f"w{i}" for i in range(40))
    for n in range(12):
        whole = " ".join("abcdefghijkl"[:n])
        for some in ([whole], [whole, None], ["", whole], whole.split() or [" "], [whole[:3], whole[3:]]):
            alone, among = (minhash_forest.shingle_sets(texts, width) for texts in (some, [*some, long]))
            assert np.diff(alone[1]).tolist() == [len(shingles(t, width)) for t in some]
            assert alone[0].tolist() == among[0][: among[1][len(some)]].tolist()


@pytest.mark.parametrize("text", ["Therti onor.", "Ly. Th heing."])
def test_near_copies_of_few_words(spark, text):
    """Texts of two and three words, each alone in its task and so in its block."""
    on_workers(spark)
    rows = [(1, text), (2, f"{text} "), (3, f"{text} more"), (4, "other words"), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(len(rows), "doc_id")
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, SF_DIR).collect()) == [1, 3, 4, 5, 6]


# Byte-level BPE


@pytest.fixture(scope="module")
def both():
    ranks = bpe_transducer.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe_transducer.Codec(ranks, public_tokenizers.PATTERN)


@given(st.text(st.one_of(st.sampled_from("ab c'stéè\n\t \x1c\x85漢🎉<|endoftext|>"), st.characters(exclude_categories=["Cs"])), max_size=60))
@settings(max_examples=300, deadline=None)
def test_transducer_round_trip(both, text):
    known, own = both
    ids = own.encode(text)
    assert list(memoryview(ids).cast("I")) == known.encode_ordinary(text) and "".join(own.decode(ids)) == text


def test_transducer_forgets_and_streams(both, texts):
    known, own = both
    small = bpe_transducer.Transducer(own.transducer.ranks, max_states=40)
    for text in list(texts.values())[:10]:
        for word in re.findall(r"[^\W\d_]+", text)[:200]:
            assert small.encode(word.encode()) == known.encode_ordinary(word)
    long = ("a" * 9000 + "thethe" * 3000).encode()
    assert small.encode(long) == known.encode_ordinary(long.decode())
    early = list(own.transducer.stream(long, block=64))
    assert len(early) > 200 and all(early[:-1])  # tokens come after bounded lookahead


@given(st.binary(max_size=40), st.lists(st.integers(1, 5), max_size=40))
@settings(max_examples=300, deadline=None)
def test_utf8_stream(data, steps):
    machine, out, at = bpe_transducer.Utf8Stream(), "", 0
    for step in [*steps, len(data)]:
        out += machine.feed(data[at : at + step])
        at += step
    assert out + machine.close() == data.decode("utf-8", "replace")


def test_transducer_query(spark, documents, texts):
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_transducer.read_ranks(RANKS), special_tokens={})
    for r in queries.op8_transducer(spark, SF_DIR).collect():
        ids = np.array(known.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    coded = bpe_transducer.encode(documents, RANKS, public_tokenizers.PATTERN)
    assert {r.id: r.text for r in bpe_transducer.decode(coded, RANKS, public_tokenizers.PATTERN).collect()} == texts


# Language


def test_language(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()
    lang = {r.doc_id: r.lang for r in rows}
    out = queries.op9_language(spark, "/root/testdata/sf0.01").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out) and len(out) == len(lang)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert sum(r.rejected for r in out) <= 0.005 * len(out) and all(0 <= r.score <= 1 for r in out)


def test_language_is_the_same_in_any_company():
    model = langid.train(["the cat sat on the mat " * 5, "le chat est sur la table " * 5] * 20, ["en", "fr"] * 20)
    words = langid.WordScores(model, entries=3)
    texts = ["the mat", "la table", "chat-sur(la) TABLE", "x" * 200 + " the", "the cat sat on the mat and more words than there is room for"]
    alone = [langid.WordScores(model).predict(t) for t in texts]
    for (a, p, _), (b, q, _) in zip(alone, words.predict_all(texts)):
        assert a == b and p == pytest.approx(q, abs=1e-9)
    assert [a for a, *_ in alone[:3]] == ["en", "fr", "fr"]


@pytest.fixture(scope="module")
def language_model(spark):
    on_workers(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return langid.fit(docs, ~queries.held_out())


def plain_subwords(text):
    """Runs of letters and their n-grams, marks at both ends; what is no letter is a mark."""
    out = []
    for run in re.findall(r"[^\W\d_]+", text.lower()):
        marked = f" {run} "
        out += [marked[i : i + n] for n in langid.NGRAMS for i in range(len(marked) - n + 1)] + ["=" + run]
    return out


def test_language_score_is_average_and_softmax(language_model):
    """The query's way, word by word and cached, against one average over all subwords of the text."""
    texts = ["the re and of then the", "une de laou la et", "x", "éa ñé ß the", "der die und " * 300]
    for text, (lang, score, _) in zip(texts, langid.WordScores(language_model).predict_all(texts)):
        found, owner = langid.features(text.split())
        assert len(found) == len(plain_subwords(text)) and len(set(owner)) == len(text.split())
        z = (language_model.scores[found].mean(axis=0) + language_model.bias) / language_model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert lang == language_model.languages[int(p.argmax())] and score == pytest.approx(float(p.max()), abs=1e-9)


STRANGERS = {
    "sv": "Det var en gång en liten flicka som bodde i ett rött hus vid skogen och hon tyckte mycket om att plocka blommor på ängen varje morgon innan solen gick upp.",
    "pl": "Dawno temu w małej wiosce nad rzeką mieszkał stary rybak, który każdego dnia wypływał na jezioro, aby łowić ryby dla swojej rodziny i sąsiadów.",
    "uk": "Колись давно у маленькому селі біля річки жив старий рибалка, який щодня виходив на озеро ловити рибу для своєї родини.",
    "ja": "むかしむかし、あるところにおじいさんとおばあさんが住んでいました。おじいさんは山へ芝刈りに、おばあさんは川へ洗濯に行きました。",
}


def test_unlearned_languages_and_noise_are_rejected(spark, language_model):
    rng = random.Random(6)
    noise = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 9))) for _ in range(60)) for _ in range(20)]
    words = langid.WordScores(language_model)
    # Six times over, as texts of some length: a few words alone are no evidence.
    assert [t[:20] for t in [*STRANGERS.values(), *noise] if not words.predict(" ".join([t] * 6))[2]] == []
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r.rejected for r in langid.predict(docs.filter(queries.held_out()), language_model).collect()]
    assert len(held) > 200 and sum(held) <= 0.005 * len(held)


def test_a_language_that_was_left_out_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, F.col("lang") != "es")
    found = langid.predict(docs.filter("lang = 'es' and n_chars > 400"), model).select("rejected").collect()
    kept = langid.predict(docs.filter("lang <> 'es'"), model).select("rejected").collect()
    assert sum(r.rejected for r in found) > 0.5 * len(found) and sum(r.rejected for r in kept) <= 0.005 * len(kept)


@pytest.mark.parametrize("doc_id", ["CAST(NULL AS BIGINT)", "7L"])
def test_languages_are_learned_without_ids(spark, doc_id):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").withColumn("doc_id", F.expr(doc_id))
    rows = langid.sample(docs, F.lit(True), "doc_id", "text", "lang").groupBy("lang").count().collect()
    assert {r.lang for r in rows} == {"de", "en", "es", "fr"} and all(150 < r["count"] <= 300 for r in rows)


def test_many_rows_alike_leave_room_for_others(spark):
    rows = [(1, "the same text", "en")] * 3000 + [(i, f"le texte {i}", "fr") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang for r in langid.sample(docs, F.lit(True), "doc_id", "text", "lang", 100).collect()} >= {"fr"}


# Exact copies


def test_index_over_batches(spark):
    first = spark.createDataFrame([(5, "a  b"), (6, "a b"), (7, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(8, "a\tb"), (9, "d"), (10, "d ")], "doc_id long, text string")
    index = exact_index.DigestIndex(spark, buckets=4)
    exact_index.dedup(first, index=index).collect()
    found = {r.id: (r.keep_id, r.group_size, r.kept) for r in exact_index.dedup(second, index=index).collect()}
    assert found == {8: (5, 1, False), 9: (9, 1, True), 10: (10, 1, True)}
    assert index.rows().count() == 4
    index.add(exact_index.digests(first))
    assert index.rows().count() == 4
    again = exact_index.DigestIndex(spark, index.path, 4)
    assert again.rows().count() == 4


def test_index_is_read_by_bucket(spark):
    index = exact_index.DigestIndex(spark, buckets=4)
    index.add(exact_index.digests(spark.createDataFrame([(1, "a")], "doc_id long, text string")))
    plan = index.new(exact_index.digests(spark.createDataFrame([(2, "b")], "doc_id long, text string")))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "SortMergeJoin LeftAnti" in plan and "Bucketed: true" in plan


# Filters in front of joins


@pytest.mark.parametrize("words", [1, 64, 1 << 10])
def test_drop_rows(spark, words):
    rows = spark.createDataFrame([(i if i % 50 else None, i % 7) for i in range(500)], "doc_id long, kind int")
    dropped = spark.createDataFrame([(3 * i, i % 2) for i in range(100)] + [(None, 0)], "gone long, parity int")
    ids = {3 * i for i in range(100)}
    kept = drop_rows(rows, dropped, "doc_id", "gone", words=words)
    assert kept.columns == rows.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((tuple(r) for r in rows.collect() if r.doc_id not in ids), key=str)
    odd = drop_rows(rows, dropped, "doc_id", "gone", F.col("kind") == F.col("parity"), words)
    gone = {(3 * i, i % 2) for i in range(100)}
    assert sorted(map(tuple, odd.collect()), key=str) == sorted((tuple(r) for r in rows.collect() if tuple(r) not in gone), key=str)
    maybe = {r.doc_id for r in maybe_in(rows, dropped.select(F.col("gone").alias("doc_id")), "doc_id", words).collect()}
    assert {i for i in ids if i % 50 and i < 500} <= maybe


# The pipeline


def plain_pipeline(rows):
    """The pieces of the documents that all stages leave, worked out one after the other."""
    # Language: what has letters stays (the clean documents of the table, as the other tests show, are all recognised).
    kept = {i: t for i, t in rows if t and any(c.isalpha() for c in t)}
    # Exact copies, white space aside.
    first = {}
    for i in sorted(kept):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", kept[i]), i)
    kept = {i: kept[i] for i in first.values()}
    # Near copies: the least of each group.
    sets = {i: shingles(t, 5) for i, t in kept.items()}
    label = {i: i for i in kept}
    links = [(a, b) for a in kept for b in kept if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in range(20):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    kept = {i: t for i, t in kept.items() if label[i] == i}
    # Repeated passages; a character that loses a byte goes whole.
    seen, pieces = set(), set()
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    for i in sorted(kept):
        data = kept[i].encode()
        covered = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                covered[p : p + 100] = True
            seen.add(data[p : p + 100])
        left = bytes(b for b, gone in zip(data, covered) if not gone).decode("utf-8", "ignore")
        ids = [*tokenizer.encode(left, add_special_tokens=False).ids, 2]
        start = 0
        for piece, end in enumerate(range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)):
            pieces.add((i, piece, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
            start = end
    return pieces


def test_pipeline_is_its_stages_one_after_the_other(spark, tmp_path):
    on_workers(spark)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang is not null and n_chars < 6000").orderBy("doc_id").limit(200).collect()
    rng = random.Random(8)
    rows = [tuple(r) for r in table]
    base = [r for r in rows if 60 < len(r[1].split()) < 400]
    passage = " ".join(base[0][1].split()[:50])
    for k in range(30):
        _, text, lang, source, _ = rng.choice(base)
        words = text.split(" ")
        if k % 3 == 0:
            text = text.replace(" ", "  ")  # an exact copy, white space aside
        elif k % 3 == 1:
            words[rng.randrange(len(words))] = "changed"  # a near copy
            text = " ".join(words)
        else:
            text = " ".join(words[: len(words) // 3]) + " " + passage + " new " + " ".join(reversed(words))
        rows.append((10_000 + k, text, lang, source, len(text)))
    rows += [(20_000, None, None, "s", None), (20_001, "123 456 !!", "en", "s", 10), (20_002, "", "de", "s", 0)]
    schema = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").schema
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(out) == len({(r.doc_id, r.piece) for r in out})
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out} == plain_pipeline([r[:2] for r in rows])
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in out)
    assert {10_000, 10_001, 20_000, 20_001, 20_002}.isdisjoint({r.doc_id for r in out}) and 10_002 in {r.doc_id for r in out}
