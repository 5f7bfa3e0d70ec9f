"""Each operator against brute force on small tables, with nulls, empty and long texts, ties, repeated rows and empty tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from coverspark.llm import queries
from coverspark.llm.chat import chat_format, fit_chat, parse_chat, transcript_lines
from coverspark.llm.exact_dedup import boundaries, drop_exact_duplicates, exact_dedup
from coverspark.llm.graph import components
from coverspark.llm.jaccard_join import drop_near_duplicates, jaccard_join, runs_for
from coverspark.llm.mixing import mix, split_quotas, take_mix
from coverspark.llm.packing import fullest, pack, plan
from coverspark.llm.quality import keep_quality, quality_classifier
from coverspark.llm.ranks import spread_rank
from coverspark.llm.sharding import best_fit_decreasing, into_bins, shard_by_bytes
from coverspark.llm.shingles import texts_shingles
from coverspark.llm.tokens import Encoder, _library, count_spliced, token_counts
from coverspark.llm.toxicity import fit_ordinal, toxicity
from coverspark.llm.vector_dedup import vector_dedup
from tests.oracle import differences

DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k * k % 9973}" for k in range(40_000))
ODD = [(1, None), (2, ""), (3, "Same Text"), (4, "same text"), (5, "SAME TEXT"), (None, "same text"), (None, None), (6, "É"), (7, "é"), (8, LONG), (9, LONG.upper()), (9, LONG.upper()), (10, " "), (11, "a<|endoftext|>b"), (12, "don't  stop\n\n now, 'tis 　 fine, Éa, ×, x×,.")]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s" if i is None else f"s{i % 2}", None) for i, t in rows], DOCS)


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


# exact dedup


@pytest.mark.parametrize("digest_bytes", [16, 1])
def test_exact_dedup(spark, digest_bytes):
    rows = ODD + [(100 + k, "word " * (500 * k) + str(k % 3)) for k in range(12)]
    got = exact_dedup(docs(spark, rows), digest_bytes=digest_bytes).collect()
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    want = Counter()
    for i, t in rows:
        ids = [x for x in groups[lower(t)] if x is not None]
        keep = max(ids) if ids else None
        want[(i, keep, len(groups[lower(t)]), i == keep)] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == want


def test_exact_dedup_empty_and_rows(spark):
    assert exact_dedup(docs(spark, [])).count() == 0
    kept = drop_exact_duplicates(docs(spark, ODD).withColumnRenamed("lang", "keep_id"))
    assert kept.columns == ["doc_id", "text", "keep_id", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [2, 5, 6, 7, 9, 9, 10, 11, 12]


def test_rows_that_share_an_id_or_have_none(spark):
    import corpus_pipeline as P

    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(7, a), (9, a), (7, b), (None, b), (None, c), (None, c), (9, a), (9, a + " end")]
    left = lambda df: sorted((r.doc_id or 0, r.text) for r in df.collect())
    one_each = [(0, c), (7, b), (9, a), (9, a + " end")]
    assert left(P.exact(spark, docs(spark, rows), DIR)) == one_each
    assert left(drop_exact_duplicates(docs(spark, rows))) == sorted([*one_each, (0, c), (9, a)])
    assert left(P.near(spark, docs(spark, rows), DIR)) == [(0, c), (7, a), (7, b)]


def test_boundaries_depend_on_content():
    data = LONG.encode()
    ends = boundaries(data)
    assert ends[-1] == len(data) and all(0 < b - a <= 8192 for a, b in zip([0, *ends], ends))
    moved = boundaries(b"x" * 700 + data)
    assert len({e - 700 for e in moved} & set(ends)) > 0.9 * len(ends)
    assert len(boundaries(b"a" * 100_000)) >= 12


# vectors


def brute_vectors(rows, threshold=0.9):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = Counter(), {i: i for i, _ in rows if i is not None}
    pairs = [(a, b) for k, (a, x) in enumerate(ok) for b, y in ok[k + 1 :] if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    for _ in rows:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return links, root


def test_vector_dedup(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 16))
    rows = [(k, base[k % 30] + rng.normal(size=16) * (0.02 * (k % 5))) for k in range(300)]
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in rows]
    rows += [(1000 + k, rows[3][1]) for k in range(40)] + [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None] + [1.0] * 15), (2005, [1.0, 2.0]), (2006, [2.0, 4.0]), (2007, [3e38] * 16)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, id string")
    got = by_id(vector_dedup(df), "vec_id")
    links, root = brute_vectors([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    assert {i: (r["n_links"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (links[i], root[i], root[i] == i) for i, _ in rows}
    assert vector_dedup(df.limit(0)).count() == 0


def test_vector_recall_at_threshold(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(800, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r = rng.normal(size=a.shape)
    r -= (r * a).sum(1, keepdims=True) * a
    r /= np.linalg.norm(r, axis=1, keepdims=True)
    b = 0.905 * a + np.sqrt(1 - 0.905**2) * r
    df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(np.concatenate([a, b]))], "vec_id long, embedding array<double>")
    assert vector_dedup(df).where("n_links > 0").count() >= 0.9 * 1600


@pytest.mark.parametrize("share", [0.1, 0.33])
def test_vector_recall_in_a_large_cluster(spark, share):
    rng = np.random.default_rng(5)
    n, hot = 2400, int(2400 * share)
    x = rng.normal(size=(n, 64))
    centre = x[0] / np.linalg.norm(x[0])
    x[:hot] = centre + x[:hot] * 0.27 / 8  # cosines around 0.93, most of them 0.9 or more
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= 0.9).sum(1) - 1
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = by_id(vector_dedup(df), "vec_id")
    links = np.array([got[k]["n_links"] for k in range(n)])
    assert want[:hot].mean() > hot / 2
    assert (links <= want).all() and links.sum() >= 0.99 * want.sum()


@pytest.mark.parametrize("common", [0.0, 1.0])
def test_vector_recall_of_a_large_table(spark, common):
    """20,000 vectors with planted pairs at cosines of 0.9 to 0.95, with and without a direction that all share."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(20_000, 32)) / np.sqrt(32) + common * np.eye(32)[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, away = x[:8000], x[rng.permutation(8000)]
    away = away - (away * a).sum(1, keepdims=True) * a
    cosine = rng.uniform(0.9, 0.95, (8000, 1))
    x[8000:16_000] = cosine * a + np.sqrt(1 - cosine**2) * away / np.maximum(1e-9, np.linalg.norm(away, axis=1, keepdims=True))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = np.concatenate([(part @ x.T >= 0.9).sum(1) for part in np.split(x, 20)]) - 1
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    links = np.zeros(len(x), int)
    for r in vector_dedup(df).select("vec_id", "n_links").collect():
        links[r.vec_id] = r.n_links
    assert want.sum() > 10_000 and (links <= want).all() and links.sum() >= 0.95 * want.sum()


def test_listed_pivots_meet():
    from coverspark.llm.vector_dedup import listed_under

    rng = np.random.default_rng(8)
    near = np.array([rng.permutation(12)[:6] for _ in range(300)])
    for common in (1, 2, 3):
        under = listed_under(near, common)
        for a, b in rng.integers(0, 300, (500, 2)):
            if len(set(near[a]) & set(near[b])) >= common:
                assert set(under[a]) & set(under[b])


def test_vectors_that_are_all_close(spark):
    rng = np.random.default_rng(6)
    x = np.ones(32) + 0.3 * rng.normal(size=(700, 32))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = by_id(vector_dedup(df), "vec_id")
    assert [got[k]["n_links"] for k in range(700)] == ((u @ u.T >= 0.9).sum(1) - 1).tolist()


# similarity join


def shingle_set(t, n=5):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    n = min(n, len(w))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else frozenset()


def brute_join(rows, threshold=0.8):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    pairs = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1 :] if x and y and len(x & y) >= threshold * len(x | y)]
    links, root = Counter(), {i: i for i, _ in sets}
    for a, b in pairs:
        if a != b:
            links[a] += 1
            links[b] += 1
    for _ in rows:
        before = dict(root)
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    return links, root


def near_copies(n, seed, words=120, edits=3):
    rng = np.random.default_rng(seed)
    base = [f"t{x}" for x in rng.integers(0, 5000, words)]
    out = []
    for _ in range(n):
        w = list(base)
        for k in rng.integers(0, words, rng.integers(0, edits + 1)):
            w[k] = f"e{rng.integers(0, 10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("limit", [256, 8])
def test_jaccard_join(spark, limit):
    shared = " ".join(f"passage{k}" for k in range(60))
    texts = near_copies(60, 1) + near_copies(25, 2, 60, 2) + [f"{shared} " + " ".join(f"u{k}x{j}" for j in range(90)) for k in range(40)] + ["one two", "One, two!", "", None, "...", LONG]
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, None)]
    got = jaccard_join(docs(spark, rows).withColumnRenamed("lang", "digest"), limit=limit).collect()
    links, root = brute_join(rows)
    assert {r.doc_id: (r.n_links, r.component_id, r.kept) for r in got if r.doc_id is not None} == {i: (links[i], root[i], root[i] == i) for i in root}
    assert [(r.component_id, r.n_links) for r in got if r.doc_id is None] == [(None, 0)] * 2


def test_text_ids(spark):
    """Ids that are texts: links and components as with numbers, under the least text."""
    from pyspark.sql import functions as F

    texts = near_copies(20, 3) + ["one two", "One, two!", "", None]
    rows = list(enumerate(texts)) + [(None, texts[0])]
    name = lambda i: None if i is None else f"d{i:03d}"
    as_text = lambda df, c: df.withColumn(c, F.format_string("d%03d", F.col(c))).withColumn(c, F.when(F.col(c) != "dnull", F.col(c)))
    links, root = brute_join(rows)
    got = jaccard_join(as_text(docs(spark, rows), "doc_id").withColumnRenamed("lang", "component_id")).collect()
    assert {r.doc_id: (r.n_links, r.component_id, r.kept) for r in got if r.doc_id} == {name(i): (links[i], name(root[i]), root[i] == i) for i in root}
    assert [(r.component_id, r.n_links) for r in got if r.doc_id is None] == [(None, 0)]
    v = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0]), (3, None), (None, [1.0, 0.0])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<double>")
    got = vector_dedup(as_text(df, "vec_id"), "vec_id").collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {"d000": (1, "d000"), "d001": (1, "d000"), "d002": (0, "d002"), "d003": (0, "d003"), None: (0, None)}
    labels = spark.createDataFrame([(f"d{k:03d}", k % 2) for k in range(20)], "doc_id string, quality int")
    assert quality_classifier(as_text(docs(spark, rows), "doc_id"), labels).count() == len(rows)
    turns = spark.createDataFrame([("x", 0, "user", "hi?"), ("x", 1, "assistant", "User: no\nno"), ("y", 0, "user", "a"), (None, 0, "user", "a")], "conv_id string, turn int, role string, text string")
    assert sorted((r.conv_id or "", r.turn, r.line) for r in chat_format(turns).collect()) == [("", 0, 0), ("x", 0, 0), ("x", 1, 0), ("x", 1, 1), ("y", 0, 0)]


def test_jaccard_join_on_documents(spark):
    df = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    links, root = brute_join(rows)
    assert {r.doc_id: (r.n_links, r.component_id) for r in jaccard_join(df).collect()} == {i: (links[i], root[i]) for i in root}
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i in root if root[i] == i}
    assert jaccard_join(df.limit(0)).count() == 0
    assert runs_for(0.8, 0.99999, 2) >= 8


def test_shingles_of_long_texts_are_the_same():
    text = " ".join(f"w{k % 7919}" for k in range(300_000))
    assert len(text) > 1 << 20
    assert len(texts_shingles([text], 5)[0]) == len(shingle_set(text))


# tokens and packing


def test_token_counts(spark):
    lib = _library("byte_bpe_50k.json")
    rows = ODD + [(50, "long text, " * 9000), (51, "a" * 70_000), (52, "é, " * 40_000)]
    got = token_counts(docs(spark, rows).withColumnRenamed("lang", "n_tokens"))
    want = Counter((i, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in rows)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()) == want
    assert token_counts(docs(spark, [])).count() == 0


def test_encoder_is_the_library():
    rng = np.random.default_rng(3)
    signs = list("abcXYZ éÉñß×÷0129'\"!?.,;:|<>#$%&*-_ \n\t\r 　 中文😀") + ["'s", "'ll", " the", "<|endoftext|>", "  ", "\n\n"]
    texts = ["".join(rng.choice(signs, rng.integers(0, 60))) for _ in range(3000)] + [None, ""]
    lib = _library("byte_bpe_50k.json")
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in Encoder("byte_bpe_50k.json").encode(texts)] == want
    assert Encoder("byte_bpe_50k.json").count(texts) == [len(x) for x in want]
    joined = " ".join(t for t in texts if t)
    assert count_spliced(joined, "byte_bpe_50k.json", chunk=500, overlap=20) == len(lib.encode(joined, add_special_tokens=False).ids)


def test_token_counts_of_long_texts(spark):
    """Texts of many chunks: with few stable places, with none, with special strings and wide characters at the borders."""
    lib = _library("byte_bpe_50k.json")
    rng = np.random.default_rng(10)
    parts = ["word ", "é" * 9, "中文", "<|endoftext|>", "don't", "\n\n", "  ", "a" * 90, "x, y", "😀", "0129", "'s ", "Ünï "]
    rows = [(k, "".join(rng.choice(parts, 2000 if k % 2 else 300))) for k in range(12)]
    rows += [(50, "a" * 9000), (51, "中" * 5000), (52, " " * 9000), (53, ("a" * 1500 + " ") * 12), (54, "<|endoftext|>" * 900), (55, LONG)]
    want = {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in rows}
    for chunk, overlap in ((4096, 256), (512, 16), (200, 3)):
        got = token_counts(docs(spark, rows), chunk=chunk, overlap=overlap)
        assert {r.doc_id: r.n_tokens for r in got.collect()} == want


def test_pack(spark):
    lib = _library("byte_bpe_50k.json")
    rows = ODD + [(200 + k, "some words here " * (37 * k % 900)) for k in range(120)]
    got = pack(docs(spark, rows).withColumnRenamed("lang", "offset")).collect()
    want = Counter()
    for i, t in rows:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for s in range(0, len(ids), 2048):
            want[(i, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences: dict[int, list] = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 2048
    total = sum(n for p in sequences.values() for _, n in p)
    assert len(sequences) <= -(-total // 2048) + 2
    assert pack(docs(spark, [])).count() == 0


def test_fullest_is_the_best_sum():
    rng = np.random.default_rng(4)
    for _ in range(60):
        counts = {int(k): int(v) for k, v in zip(rng.integers(1, 40, 6), rng.integers(1, 4, 6))}
        chosen = fullest(counts, 60)
        sums = {max(counts)}
        for k, v in counts.items():
            for _ in range(v - (k == max(counts))):
                sums |= {s + k for s in sums if s + k <= 60}
        assert sum(k * v for k, v in chosen.items()) == max(sums) and all(v <= counts[k] for k, v in chosen.items())
        used = Counter()
        for times, c in plan(counts, 60):
            used.update({k: v * times for k, v in c.items()})
        assert dict(used) == counts


# mixing


def brute_targets(sizes):
    names = sorted([s for s in sizes if s is not None], key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    left, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_} if open_ else {}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return share | {s: 3.0 * sizes[s] for s in full}
        full |= set(over)
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)


def test_mix(spark):
    rng = np.random.default_rng(5)
    rows = [(k, " \n".join(["wörd　x"] * int(rng.integers(1, 40))), "en", ["a", "b", "c", "Z", None, "tiny"][min(5, k % 7) if k % 7 != 6 else 0] if k % 97 else "rare", None) for k in range(4000)]
    rows += [(9001, None, "en", "empty", None), (9002, " \t", "en", "empty", None), (None, "x y z", "en", "a", None), (7, rows[7][1], "en", rows[7][3], None)]
    df = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "block")
    got = mix(df).collect()
    sizes: dict = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    targets, source = brute_targets(sizes), {r[0]: r[3] for r in rows}
    taken: dict = {}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - targets[s]) < 1e-6 and r.taken <= 3 * r.size and len(r.places) * r.size == r.taken
        taken[s] = taken.get(s, 0) + r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - targets[s]) <= 40 for s in sizes)
    assert sorted(map(str, mix(df.repartition(7)).collect())) == sorted(map(str, got))
    shards = Counter(p.shard for r in got for p in r.places)
    assert len(shards) == 8
    copies = Counter(r.doc_id for r in take_mix(df).collect())
    assert take_mix(df).columns == df.columns and sum(copies.values()) > 0
    assert mix(df.limit(0)).count() == 0


def test_mix_draws_are_the_rows_taken(spark):
    """Sources with few rows, most of them blank, have blocks without words among those that a share ends in."""
    rows = [(1000 * s + k, " ".join(["w"] * (k % 9 + 1)) if k % 4 == 0 else " ", "en", f"s{s}", None) for s in range(12) for k in range(120)]
    df = spark.createDataFrame(rows, DOCS)
    got = mix(df).collect()
    source = {r[0]: r[3] for r in rows}
    for s in {r[3] for r in rows}:
        own = [r for r in got if source[r.doc_id] == s]
        assert abs(sum(r["size"] * len(r.places) for r in own) - own[0].target) <= 5
    assert all(r.taken == r["size"] * len(r.places) for r in got)
    places = sorted((p.shard, p.position, r.doc_id) for r in got for p in r.places)
    assert {p[0] for p in places} == set(range(8))
    assert [r.doc_id for r in take_mix(df).collect()] == [p[2] for p in places]
    assert "places" in queries.op7_mixing(spark, DIR).columns


def test_mix_by_row(spark):
    """Ids that are null or stand in several sources, and sources of a few rows of uneven length."""
    rows = [(None, f"w{k} x y z", "en", "A", None) for k in range(40)] + [(k % 20, " ".join(["b"] * (1 + 37 * k % 300)), "en", "B" if k % 2 else "C", None) for k in range(90)]
    df = spark.createDataFrame(rows, DOCS).withColumnsRenamed({"lang": "places", "n_chars": "_doc"})
    got = mix(df).collect()
    by_size = {r.source_size: r.target for r in got}
    taken: Counter = Counter()
    for r in got:
        taken[r.source_size] += r.taken
    assert len(by_size) == 3 and all(abs(taken[s] - t) <= 0.01 * t + 5 for s, t in by_size.items())
    mixed = take_mix(df)
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(r.text.split())
    own = Counter()
    for r in rows:
        own[r[3]] += len(r[1].split())
    assert mixed.columns == df.columns and {own[s]: n for s, n in words.items()} == dict(taken)


def test_split_quotas(spark):
    quotas = {"a": 300, "b": 7, None: 45, "c": 0}
    got = split_quotas(spark.createDataFrame(list(quotas.items()), "source string, quota long"), 8, 3).collect()
    for s, q in quotas.items():
        own = sorted((r.shard, r.draws_from, r.draws) for r in got if r.source == s)
        assert sum(d for _, _, d in own) == q and [f for _, f, _ in own] == np.cumsum([0, *(d for _, _, d in own)])[:-1].tolist()
    per = Counter()
    for r in got:
        per[r.shard] += r.draws
    assert max(per.values()) - min(per.values()) <= 3


# sharding


def test_shard_by_bytes(spark):
    rng = np.random.default_rng(6)
    rows = ODD + [(1000 + k, "x" * int(rng.integers(1, 3000)) + str(k % 900)) for k in range(3000)] + [(5000 + k, "the same " * 20) for k in range(300)]
    got = shard_by_bytes(docs(spark, rows).withColumnRenamed("lang", "shard"), parcels=512).collect()
    text = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == text
    where: dict = {}
    for r in got:
        where.setdefault((r.text_crc32, r["size"]), set()).add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    loads = Counter()
    for r in got:
        loads[r.shard] += r["size"]
    assert sorted(loads) == list(range(8)) and max(loads.values()) < 1.02 * min(loads.values())
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert shard_by_bytes(docs(spark, [])).count() == 0


def test_best_fit():
    assert best_fit_decreasing([5, 4, 3, 2, 1], 6) == [0, 1, 2, 1, 0]
    assert into_bins([], 8) == [] and max(into_bins([9, 1, 1, 1, 1, 1, 1, 1, 1], 2)) == 1


def test_spread_rank(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(k % 3, k // 2) for k in range(200)], "g int, v long")
    got = spread_rank(df, ["g"], [F.col("v")], "r", 8).collect()
    for g in range(3):
        assert sorted(r.r for r in got if r.g == g) == list(range(sum(r.g == g for r in got)))


def test_components(spark):
    rng = np.random.default_rng(8)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(k, k + 1) for k in range(1000, 1100)] + [(5, 5), (3, 4), (3, 4)]
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {i: got.get(i, i) for i in root} == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# classifiers


def test_quality_on_documents(spark):
    d = "/root/testdata/sf0.1"
    df, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = by_id(quality_classifier(df, labels))
    assert len(got) == df.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id]["held_out"]]
    good, bad = [g["predicted"] for q, g in held if q == 1], [g["predicted"] for q, g in held if q == 0]
    assert np.mean(good) > 0.985 and np.mean(bad) < 0.2
    odd = docs(spark, ODD).withColumnRenamed("lang", "score")
    assert quality_classifier(odd, labels).count() == len(ODD) and keep_quality(odd, labels).columns == odd.columns
    assert quality_classifier(docs(spark, []), labels).count() == 0 and quality_classifier(odd, labels.limit(0)).count() == len(ODD)


def test_toxicity_on_documents(spark):
    d = "/root/testdata/sf0.1"
    df, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    train = labels.where("doc_id % 2 = 0")
    got = by_id(toxicity(df, train))
    held = [(r.toxic, got[r.doc_id]) for r in labels.where("doc_id % 2 = 1").collect()]
    hit, false = np.mean([g["toxic"] for t, g in held if t == 1]), np.mean([g["toxic"] for t, g in held if t == 0])
    assert hit > 0.9 and false < 0.015
    assert all(0 <= g["severity"] <= 3 for g in got.values())
    odd = docs(spark, ODD).withColumnRenamed("lang", "grade")
    assert toxicity(odd, labels).count() == len(ODD) and toxicity(docs(spark, []), labels.limit(0)).count() == 0


def test_fit_ordinal_orders_grades():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 4))
    grade = np.searchsorted([-1.0, 0.5, 2.0], x @ np.array([1.0, -2.0, 0.5, 0.0]) + rng.logistic(size=3000))
    w, t = fit_ordinal(x, grade, np.ones(3000), 4)
    assert np.abs(w - [1.0, -2.0, 0.5, 0.0]).max() < 0.25 and np.abs(t - [-1.0, 0.5, 2.0]).max() < 0.25


def test_toxicity_is_the_model_of_the_text(spark):
    """severity, grade and toxic of every text, recomputed word by word from the fitted weights and thresholds."""
    from math import exp, log1p

    from coverspark.llm.toxicity import fit_toxicity, score_toxicity

    d = "/root/testdata/sf0.01"
    df, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = fit_toxicity(df, labels, vocabulary=300)
    df = df.unionByName(docs(spark, ODD))
    want = Counter()
    for r in df.collect():
        times: Counter = Counter()
        for w in re.findall(r"[a-z\x80-\U0010ffff]+", (r.text or "").lower()):
            times.update([f for f in (w, *(w[:k] + "^" for k in range(3, 8) if len(w) > k)) if f in model.weights])
        z = sum(model.weights[f] * log1p(n) for f, n in times.items())
        above = [1.0, *(1 / (1 + exp(min(30, max(-30, t - z)))) for t in model.thresholds), 0.0]
        each = [a - b for a, b in zip(above, above[1:])]
        want[(r.doc_id, round(sum(above[1:]), 6), each.index(max(each)), int(above[1] >= 0.5))] += 1
    got = Counter((r.doc_id, round(r.severity, 6), r.grade, r.toxic) for r in score_toxicity(df, model).collect())
    assert got == want and len({r[2] for r in want}) > 1


def test_quality_is_the_model_of_the_text(spark):
    """Scores of every text against dictionaries and curve applied by hand; a stage that filters leaves odd columns alone."""
    import zstandard

    from coverspark.llm.quality import fit_quality, score_quality

    d = "/root/testdata/sf0.01"
    df, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = fit_quality(df, labels, per_class=60, calibration=100)
    good, bad = (zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(x), write_content_size=False, write_checksum=False, write_dict_id=False) for x in (model.good, model.bad))
    df = df.unionByName(docs(spark, ODD))
    want = Counter()
    for r in df.collect():
        data = (r.text or "").encode()
        parts = [data[a : a + 2048] for a in range(0, len(data), 2048)]
        x = (sum(len(bad.compress(p)) - len(good.compress(p)) for p in parts) / (len(data) + 128)) if parts else 0.0
        score = 1 / (1 + np.exp(-(model.offset + model.slope * x)))
        want[(r.doc_id, round(float(score), 6), int(score >= 0.5))] += 1
    assert Counter((r.doc_id, round(r.score, 6), r.predicted) for r in score_quality(df, model).collect()) == want
    odd = df.withColumnsRenamed({"lang": "_d", "source": "_d_text", "n_chars": "score"})
    kept = keep_quality(odd, labels, "doc_id", "text")
    assert kept.columns == odd.columns and set(kept.collect()) <= set(odd.collect()) and 0 < kept.count() < odd.count()


# chat


def brute_viterbi(model, scores):
    delta, back = model.first + scores[0], []
    for e in scores[1:]:
        through = delta[:, None] + model.following
        back.append(through.argmax(0))
        delta = through.max(0) + e
    path = [int(delta.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_chat_on_conversations(spark):
    from coverspark.llm.chat import ROLES, _features, _scores
    from pyspark.sql import functions as F

    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    model = fit_chat(turns.where("conv_id % 2 = 0"))
    got = {(r.conv_id, r.turn): r for r in parse_chat(turns, model).collect()}
    truth = {(r.conv_id, r.turn): r.role for r in turns.collect()}
    assert len(got) == len(truth) and np.mean([got[k].role == v for k, v in truth.items() if k[0] % 2]) > 0.95
    # one long conversation over many segments
    long = turns.select(F.lit(1).cast("long").alias("conv_id"), F.row_number().over(__import__("pyspark").sql.Window.orderBy("conv_id", "turn")).cast("long").alias("turn"), "text", "role")
    rows = long.orderBy("turn").select(_scores(model, _features(F.col("text"))).alias("s")).collect()
    path = [ROLES[k] for k in brute_viterbi(model, np.array([r.s for r in rows]))]
    parsed = sorted(parse_chat(long, model).collect(), key=lambda r: r.turn)
    assert [r.role for r in parsed] == path
    assert [r.turn_no for r in parsed] == np.cumsum([a != b for a, b in zip([None, *path], path)]).astype(int).__sub__(1).tolist()


def test_chat_markers_and_odd_rows(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    text = "System: be kind\nUser: hello there\nstill me\nAssistant: hi\nHuman: bye\nAI: bye"
    lines = transcript_lines(spark.createDataFrame([(1, text), (2, None), (3, "")], "conv_id long, text string"))
    got = sorted(parse_chat(lines, fit_chat(turns)).collect(), key=lambda r: r.turn)
    assert [r.role for r in got if "me" not in r.rendered] == ["system", "user", "assistant", "user", "assistant"]
    assert got[0].rendered == "<|im_start|>system\nbe kind" and got[1].rendered == "<|im_end|>\n<|im_start|>user\nhello there"
    odd = spark.createDataFrame([(None, 1, "user", "x", 1), (1, None, None, None, 1), (1, 1, "user", "", 1), (1, 1, "user", "", 1)], "conv_id long, turn int, role string, text string, segment int")
    assert chat_format(odd).count() == 4 and chat_format(odd.limit(0)).count() == 0


def test_chat_of_whole_transcripts(spark):
    """Roles of lines of conversations, by models of other conversations; the path over lines with and without gaps by brute force."""
    from coverspark.llm.chat import ROLES, _features, _scores, turn_lines
    from pyspark.sql import functions as F

    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = {(r.conv_id, r.turn, r.line): r for r in chat_format(turns).collect()}
    truth = {(r.conv_id, r.turn, r.line): r.role for r in turn_lines(turns).collect()}
    assert got.keys() == truth.keys() and np.mean([got[k].role == v for k, v in truth.items()]) > 0.9
    assert {k[:2] for k in got} == {(r.conv_id, r.turn) for r in turns.collect()}
    lines = turn_lines(turns)
    model = fit_chat(lines)
    one = turn_lines(turns.select(F.lit(3).cast("long").alias("conv_id"), (F.col("conv_id") * 1000 + F.col("turn")).alias("turn"), "role", "text")).cache()
    rows = one.orderBy("turn", "line").select("gap", (_features(F.col("text"))["marker"] > 0).alias("marker"), _scores(model, _features(F.col("text"))).alias("s")).collect()
    delta, back = model.first + np.array(rows[0].s), []
    for r in rows[1:]:
        through = delta[:, None] + (model.following if r.gap or r.marker else model.within)
        back.append(through.argmax(0))
        delta = through.max(0) + np.array(r.s)
    path = [int(delta.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path = [ROLES[k] for k in path[::-1]]
    parsed = sorted(parse_chat(one, model).collect(), key=lambda r: (r.turn, r.line))
    assert len(path) > 1000 and [r.role for r in parsed] == path
    assert [r.turn_no for r in parsed] == (np.cumsum([a != b for a, b in zip([None, *path], path)]) - 1).tolist()
    text = "".join(r.rendered for r in parsed)
    assert text.count("<|im_start|>") == parsed[-1].turn_no + 1 == text.count("<|im_end|>") + 1


# the registered queries


@pytest.mark.parametrize("name", sorted(set(queries.ORACLE_SQL)))
def test_same_as_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, DIR), queries.ORACLE_SQL[name], DIR) == []


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_rows(spark, stage):
    """Nulls in any column, empty and long texts, ties, repeated rows and ids, names that the stage itself uses, and no rows."""
    import corpus_pipeline as P

    name, run = P.STAGES[stage]
    names = [("_row_key", "_d"), ("_d_text", "_first"), ("_id", "component_id"), ("mark", "place"), ("_rank", "length")][stage]
    rows = ODD + [(7, "seven " * 40), (7, "other " * 50), (None, "seven " * 40), (None, None), (3, "Same Text")]
    df = docs(spark, rows).withColumnsRenamed(dict(zip(("lang", "n_chars"), names)))
    out = run(spark, df, DIR)
    got = out.collect()
    if name == "packing":
        assert Counter(r.doc_id for r in got if r.start == 0) == Counter(i for i, _ in rows)
    else:
        assert out.columns == df.columns and {(r.doc_id, r.text) for r in got} <= set(rows)
    if name == "exact dedup":
        assert Counter(lower(r.text) for r in got) == Counter({lower(t) for _, t in rows})
    if name == "n-gram Jaccard join":
        assert {shingle_set(r.text) for r in got} == {shingle_set(t) for _, t in rows}
    if name == "mixing sources":
        most = Counter(rows)
        assert all(n <= 3 * most[k] for k, n in Counter((r.doc_id, r.text) for r in got).items())
    assert run(spark, df.limit(0), DIR).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as P

    df = spark.read.parquet(f"{DIR}/documents.parquet")
    kept = df
    for k, (_, stage) in enumerate(P.STAGES):
        before, kept = kept, stage(spark, kept, DIR)
        if k < len(P.STAGES) - 1:
            assert kept.columns == df.columns
            kept = kept.cache()
            ids = {r.doc_id for r in before.collect()}
            assert {r.doc_id for r in kept.collect()} <= ids
    assert Counter(r.doc_id for r in kept.where("start = 0").collect()) == Counter(r.doc_id for r in before.collect())
    assert P.run(spark, DIR).count() > 0
