"""Hard negatives, files of token ids and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverspark.llm import queries
from coverspark.llm.hard_negatives import first_in_windows, hard_negatives, hilbert_keys
from coverspark.llm.ranks import global_rank
from coverspark.llm.resample import feature_counts, importance_resample, words_of
from coverspark.llm.token_files import EliasFano, TokenFile, WordEncoder, file_bytes, read_boundaries, read_documents, token_files, write_token_files
from coverspark.llm.tokens import _library
from coverspark.session import scratch_path
from tests.llm.test_llm import DIR, LONG, ODD, docs, lower
from tests.oracle import differences

# hard negatives


def brute_negatives(rows, every=50, n_positives=5, n_negatives=3):
    """rows of (id, label, vector), all usable."""
    x = [(i, label, np.floor(256 * np.array(v, float)).astype(object)) for i, label, v in rows]
    want = Counter()
    for i, label, v in x:
        if i % every:
            continue
        others = sorted(((-int((w * v).sum()), j, m) for j, m, w in x if j != i and len(w) == len(v)))
        for s, p, _ in [o for o in others if o[2] == label][:n_positives]:
            found = [o for o in others if o[2] != label and 50 * -s <= 100 * -o[0] <= 95 * -s]
            for k, (t, n, _) in enumerate(found[:n_negatives]):
                want[i, p, k + 1, n, -s, -t] += 1
    return want


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], label, "x") for i, label, v in rows], "vec_id long, embedding array<double>, label int, _key string")


def mined(spark, rows, **more):
    return Counter(map(tuple, hard_negatives(vectors(spark, rows), F.col("vec_id") % 50 == 0, **more).collect()))


@pytest.mark.parametrize("bits,d", [(1, 6), (2, 2), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(bits, d):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
    keys = [k.tobytes() for k in hilbert_keys(grid, bits)]
    assert len(set(keys)) == len(keys)
    assert (np.abs(np.diff(grid[sorted(range(len(keys)), key=keys.__getitem__)], axis=0)).sum(1) == 1).all()


def test_windows_against_sorting():
    rng = np.random.default_rng(3)
    for scale in (3, 2**30):
        x, y = (rng.integers(-3, 4, (n, 5)).astype(float) * scale for n in (7, 40))
        allowed = rng.random((7, 40)) < 0.6
        at, low = np.repeat(np.arange(7), 3), rng.integers(-20, 10, 21) * scale**2
        high = low + rng.integers(-2, 30, 21) * scale**2
        got = list(zip(*(a.tolist() for a in first_in_windows(x, y, allowed, at, low, high, 4))))
        want = []
        for w in range(21):
            s = sorted((-int(x[at[w]] @ y[j]), j) for j in range(40) if allowed[at[w], j] and low[w] <= x[at[w]] @ y[j] <= high[w])
            want += [(w, j, -v) for v, j in s[:4]]
        assert got == want


@pytest.mark.parametrize("spread", [1.0, 0.05])
def test_hard_negatives(spark, spread):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8)) * 0.3
    rows = [(k, int(k % 3 if k % 4 else 0), centres[k % 12] + rng.normal(size=8) * 0.3 * spread) for k in range(1500)]
    rows += [(5000 + k, k % 2, rows[1][2]) for k in range(400)]  # one hot vector, all ties
    rows += [rows[50], rows[7], (6001, 1, [0.5, 0.5]), (6050, 2, [0.5, 0.25]), (6003, 2, [1.0, 1.0]), (6004, 3, [0.7, 0.2]), (6100, 9, [])]
    odd = [(7000, 1, None), (7050, None, rows[0][2]), (None, 1, rows[0][2]), (7100, 0, [float("nan")] * 8), (7150, 0, [None] + [1.0] * 7), (7200, 0, [float("inf")] * 8)]
    assert mined(spark, rows + odd) == brute_negatives(rows)
    assert len(brute_negatives(rows)) > 100


def test_hard_negatives_of_few_rows(spark):
    assert mined(spark, []) == Counter()
    assert mined(spark, [(50, None, None)]) == Counter()
    assert mined(spark, [(50, 1, [1.0])]) == Counter()
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 1, [-1.0, 0.0]), (3, 2, [0.9, 0.1]), (4, 2, [0.95, 0.0]), (5, 2, [0.5, 9.0]), (6, 2, [0.49, 0.0])]
    assert mined(spark, rows) == brute_negatives(rows) and len(brute_negatives(rows)) == 3
    far = [(0, 1, [3e38, 1.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.75, 0.0])]
    assert {r[3] for r in mined(spark, far)} <= {2}
    text = vectors(spark, rows).withColumn("label", F.concat(F.lit("l"), F.col("label")))
    assert Counter(map(tuple, hard_negatives(text, F.col("vec_id") == 0).collect())) == brute_negatives(rows)


# files of token ids


@pytest.mark.parametrize("top", [0, 1, 5, 1000, 2**40, 2**63])
def test_elias_fano(top):
    rng = np.random.default_rng(7)
    for n in (0, 1, 2, 255, 256, 257, 3000, 70_000):
        x = np.sort(rng.integers(0, top + 1, n, dtype=np.uint64))
        code = EliasFano.of(x)
        data = code.to_bytes()
        read, end = EliasFano.read(b"xx" + data, 2)
        assert end == len(data) + 2 and (read.numbers() == x).all()
        for i in rng.integers(0, max(1, n), min(n, 50)).tolist():
            assert read[i] == int(x[i]) and read.first_from(int(x[i])) == int(np.searchsorted(x, x[i]))
        assert read.first_from(2**64) == n
        with pytest.raises(IndexError):
            read[n]
        if n >= 255:  # near the least space: 2 + log2(largest / n) bits a number, and an eighth for select
            assert len(data) <= n * (2.2 + max(0.0, math.log2(max(1, top) / n))) / 8 + 64


def test_token_file_in_memory():
    ids = [np.array(k, np.uint32) for k in ([5, 1], [1], [7] * 300 + [1], [2, 1])]
    own = TokenFile.read(file_bytes(3, [None, -4, -4, 10**12], ids, 2) + b"\n")
    assert own.doc_ids() == [None, -4, -4, 10**12] == [own.doc_id(k) for k in range(4)]
    assert [own.ids(k).tolist() for k in range(4)] == [i.tolist() for i in ids]
    assert [list(own.places(a, b)) for a, b in ((-4, -4), (-3, 9), (0, 10**12), (-(2**63), 2**63 - 1))] == [[1, 2], [], [3], [1, 2, 3]]
    with pytest.raises(ValueError):
        TokenFile.read(file_bytes(0, [1], ids[:1], 4)[:-1])


@pytest.mark.parametrize("file_ids", [1 << 22, 500])
def test_token_files(spark, file_ids):
    rows = ODD + [(-5, "a  b's <|endoftext|> é ≠ ≠ İx 12345 don't　stop")]
    table = docs(spark, rows).withColumnRenamed("lang", "start").withColumnRenamed("source", "file")
    folder = scratch_path(spark)
    write_token_files(table, folder, file_ids=file_ids)
    got = sorted(map(tuple, read_boundaries(spark, folder).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    library = _library("word_bpe_49k.json")
    ids = {t: [*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows}
    crc = lambda t: zlib.crc32(np.array(ids[t], "<u4").tobytes())
    assert Counter((i, n, c) for _, i, n, c in got) == Counter((i, len(ids[t]), crc(t)) for i, t in rows)
    assert [i is not None for _, i, _, _ in got] == sorted(i is not None for i, _ in rows) and [i for _, i, _, _ in got if i is not None] == sorted(i for i, _ in rows if i is not None)
    assert [s for s, _, _, _ in got] == np.cumsum([0, *(n for _, _, n, _ in got[:-1])]).tolist()
    assert Counter((r.doc_id, tuple(r.ids)) for r in read_documents(spark, folder, 2, 9).collect()) == Counter((i, tuple(ids[t])) for i, t in rows if i is not None and 2 <= i <= 9)


def test_word_encoder():
    rng = np.random.default_rng(13)
    marks = [" ", "\n", "  ", "A", "b", "É", "ß", "İ", "H\u0331", "e\u0301", "'s", "'LL", "don't", "12", "½", "\u00a0", "\u3000", "<|endoftext|>", "<|ENDOFTEXT|>", "\x01", "\x02", "ſ", "Σ", "中文", ",", "...", "word", "Žluť", "=\u0338", "\u2019", "\x85", "ŉ", "|", "€"]
    texts = ["".join(rng.choice(marks, rng.integers(0, 30))) for _ in range(3000)] + [None, ""]
    own, library = WordEncoder("word_bpe_49k.json"), _library("word_bpe_49k.json")
    assert own.words is not None
    for a in range(0, len(texts), 500):
        part = texts[a : a + 500]
        assert [x.tolist() for x in own.encode(part)] == [library.encode(t or "", add_special_tokens=False).ids for t in part]
    assert WordEncoder("byte_bpe_50k.json").words is None


def test_token_files_of_no_rows(spark):
    assert token_files(docs(spark, [])).count() == 0
    with pytest.raises(TypeError):
        token_files(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_token_files_on_documents(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op12_token_files"](spark, DIR).collect()}
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect())
    at = 0
    for (i, _), e in zip(rows, _library("word_bpe_49k.json").encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        ids = np.array([*e.ids, 1], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(rows)


# importance resampling


def brute_resample(rows, target, longest, least_words, percent, buckets=10_000):
    def features(t):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t))
        return w, [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = (Counter(b for x in texts for b in features(x)[1]) for texts in ([x for _, x in rows], target))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s}
    out = []
    for i, x in rows:
        w, f = features(x)
        weight = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    able = sorted((r for r in out if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("longest,least_words,percent", [(1, 20, 10), (1, 0, 100), (3, 2, 50)])
def test_resample(spark, longest, least_words, percent):
    rng = np.random.default_rng(9)
    rows = ODD + [(100 + k, " ".join(f"w{x}" for x in rng.integers(0, 40, 5 + k))) for k in range(60)] + [(-3, "Éa bé a-b A_B 1,5")]
    target = [None, "", "w1 w2 w3 w1 w2", "same text"]
    table = docs(spark, rows).withColumnRenamed("lang", "rank").withColumnRenamed("n_chars", "score")
    got = importance_resample(table, spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, least_words=least_words, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_resample(rows, target, longest, least_words, percent)


def test_resample_of_no_rows(spark):
    none = spark.createDataFrame([], "text string")
    assert importance_resample(docs(spark, []), none).count() == 0
    assert Counter(map(tuple, importance_resample(docs(spark, ODD), none, least_words=0).collect())) == brute_resample(ODD, [], 1, 0, 10)


def test_features_of_bytes():
    words = words_of("A bÉ　C d'e \x00f".encode())
    assert [w.decode() for w in words] == ["a", "bÉ　c", "d", "e", "f"]
    runs = [" ".join(["a", "b", "a"][i : i + n]) for n in (1, 2, 3) for i in range(4 - n)]
    assert feature_counts([b"a", b"b", b"a"], 3) == Counter(zlib.crc32(r.encode()) for r in runs)


def test_global_rank(spark):
    rows = [(k * 7919 % 1000 // 3, k) for k in range(5000)] + [(None, 1)] * 3
    got = sorted(map(tuple, global_rank(spark.createDataFrame(rows, "a int, b int"), [F.desc("a"), F.asc("b")], "place").select("place", "a", "b").collect()))
    assert [g[0] for g in got] == list(range(1, 5004))
    assert [g[1:] for g in got] == sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_resample"])
def test_new_queries_against_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, DIR), queries.ORACLE_SQL[name], DIR) == []
