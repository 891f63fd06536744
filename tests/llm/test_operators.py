"""The ten operators and the pipeline against brute force on small tables
with NULLs, empty and long texts, ties, repeated rows, clashing columns and
no rows at all."""

import collections
import hashlib
import math
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from healthmart.llm import (bag_minhash, bloom_dedup, byte_cnn, class_lm, line_chunks, max_plus, packing,
                            pivot_index, pu_quality, suffix_dedup)

SF = "/root/testdata/sf0.001"
LINES = ["alpha beta gamma delta one", "second line of words here", "third line, with more words", "fourth and last line"]
PASSAGE = " ".join(f"word{i}" for i in range(40))


def _texts():
    long = " ".join(f"w{i % 997} x{i % 89}" for i in range(4000))
    return [(0, "Same Text"), (1, "same text"), (2, None), (3, ""), (4, "\n".join(LINES * 2)), (5, "top\n" + "\n".join(LINES * 2)),
            (6, PASSAGE), (7, "before " + PASSAGE + " after"), (8, long), (9, long + " tail"), (10, "é" * 300), (11, "123 ?"),
            (12, "naïve Ünï x"), (None, "same text"), (13, "aaaa " * 200)]


@pytest.fixture(scope="module")
def docs(spark):
    """Clashing names on purpose: id, row, text_sha256, k, label, bucket."""
    rows = [(i, t, "en", "s", 1, 2, "z", 3, 4, 5) for i, t in _texts()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id int, row int, "
                                       "text_sha256 string, k int, label int, bucket int").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def _by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}


def test_exact_dedup(docs, none):
    got = _by_id(bloom_dedup.exact_dedup(docs), "keep_id", "group_size", "kept", "text_sha256")
    assert got[0][:3] == (1, 3, False) and got[1][:3] == (1, 3, True) and got[None][:3] == (1, 3, False)
    assert got[2][:3] == (3, 2, False) and got[3][:3] == (3, 2, True)
    assert got[12][3] == hashlib.sha256("naïve Ünï x".replace("U", "u").encode()).hexdigest()
    assert bloom_dedup.exact_dedup(docs, bits=64).count() == 15  # a full filter shuffles more rows, with the same result
    assert _by_id(bloom_dedup.exact_dedup(docs, bits=64), "keep_id") == {k: v[0] for k, v in got.items()}
    assert bloom_dedup.exact_dedup(none).count() == 0


def test_line_chunks(docs, none):
    out = line_chunks.dedup_lines(docs)
    assert out.columns[:10] == docs.columns
    got = _by_id(out, "text", "n_lines", "n_removed")
    assert got[2] == (None, 1, 0) and got[3] == ("", 1, 0)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [x for x in _texts() if x[0] is not None])
    want = {r[0]: r[1:] for r in con.execute(line_chunks.sql("documents", "SELECT doc_id, kept, n_lines, n_removed FROM doc")).fetchall()}
    assert {i: (t or "", *rest) for i, (t, *rest) in got.items() if i is not None} == want
    assert sum(v[2] for v in want.values()) > 0
    assert line_chunks.dedup_lines(none).count() == 0


def test_packing(docs, none, spark):
    rows = packing.pack_rows(docs.select("doc_id", "text")).collect()
    enc = packing.encoder(*packing._vocab())
    for i, t in _texts():
        ids = np.array(enc.slow.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["start"] for r in mine] == [s for s, _ in packing.cut_points(len(ids), 2048)]
        assert [r["ids_crc32"] for r in mine] == [zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in mine]
        assert all(r["length"] == 2048 for r in mine[1:])
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 2048
    assert len(bins) == math.ceil(sum(r["length"] for r in rows) / 2048)
    assert packing.pack_rows(none.select("doc_id", "text")).count() == 0


def test_packing_of_a_run_the_fast_reader_refuses(spark):
    enc = packing.encoder(*packing._vocab())
    rows = [(i, c * 1_000_000) for i, c in enumerate(" \n")] + [(2, "plain text")]
    got = packing.pack_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for i, t in rows:
        ids = np.array(enc.slow.encode(t, add_special_tokens=False).ids + [0], "<u4")
        mine = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        assert sum(r["length"] for r in mine) == len(ids)
        assert [r["ids_crc32"] for r in mine] == [zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in mine]


@pytest.mark.parametrize("stop", [KeyboardInterrupt, SystemExit, GeneratorExit])
def test_encoder_can_be_stopped(stop):
    enc = packing.Encoder(packing._vocab()[0])

    class Fast:
        def encode_ordinary(self, text):
            raise stop

    enc.fast = Fast()
    with pytest.raises(stop):
        enc("text")


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_keeps_every_constraint(rule):
    rng = np.random.default_rng(1)
    counts = collections.Counter(rng.integers(1, 76, 3000).tolist())
    runs = packing.plan_bins(counts, 100, max_docs=4, max_attention=6000, weights=(1, 0.5, 0.5), rule=rule)
    bins, placed = collections.defaultdict(list), collections.Counter()
    for length, _, n, first, offset, slot in runs:
        placed[length] += n
        for i in range(n):
            bins[first + i].append((offset, length, slot))
    assert placed == counts
    for b in bins.values():
        b.sort()
        assert [x[0] for x in b] == [sum(y[1] for y in b[:k]) for k in range(len(b))] and [x[2] for x in b] == list(range(len(b)))
        assert sum(x[1] for x in b) <= 100 and len(b) <= 4 and sum(x[1] ** 2 for x in b) <= 6000


def test_pivot_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(400)] + [(i, [0.5] * 8) for i in range(400, 700)]
    rows += [(900, None), (920, [float("nan")] * 8), (940, [None] * 8), (960, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F
    q = pivot_index.quantised(df, "vec_id", "embedding")
    got = pivot_index.top_k(q, F.col("id") % 20 == 0)
    v = {i: np.floor(64 * np.array(x)).astype(int) for i, x in rows[:700]}
    want = set()
    for i in range(0, 700, 20):
        best = sorted((-int(v[i] @ v[j]), j) for j in v if j != i)[:20]
        want |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    assert {tuple(r) for r in got.collect()} == want
    assert pivot_index.top_k(q.limit(0), F.col("id") % 20 == 0).count() == 0


def test_class_lm(docs, none):
    got = _by_id(class_lm.score_texts(docs), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    tokens = {i: (t or "").encode().lower().split() + [b""] for i, t in _texts()}
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i in tokens}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert got[i][:4] == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert got[i][4] == pytest.approx(base) and got[i][5] < 0
    assert class_lm.score_texts(none).count() == 0


def test_class_model_is_a_distribution(docs):
    model, counts = class_lm.train(class_lm._texts(docs, "doc_id", "text"))
    total = np.zeros(class_lm.CLASSES)
    for w, n in ((bytes(r["w"]), r["n"]) for r in counts.collect()):
        c = model.known[w][1]
        p = model.step[:, c] * (1 - model.spare[c]) * n / model.size[c]
        total += class_lm.MIX * p + (1 - class_lm.MIX) * (n + 0.5) / model.base_of
    total += class_lm.MIX * model.step @ model.spare + (1 - class_lm.MIX) * 0.5 / model.base_of
    used = model.size > 0
    assert total[used] == pytest.approx(np.ones(used.sum()))


def _rare_words():
    """9,000 frequent words that end alike, and 200 rarer ones that end
    alike too: the even ones stand between left and lefty, the odd ones
    between right and righty. Every text is in the learning fold."""
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 != 1][:60]
    texts = [" ".join(f"f{i}zz" for i in range(k % 20, 9000, 20)) for k in range(len(ids))]
    rare = [f"left {i}qq lefty" if i % 2 == 0 else f"right {i}qq righty" for i in range(200)]
    return [(i, t + " " + " ".join(rare if k < 2 else [])) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]


def test_class_lm_clusters_rare_words(spark, monkeypatch):
    sent, frame = [], type(spark.range(0))
    monkeypatch.setattr(frame, "toPandas", lambda self, f=frame.toPandas: sent.append(len(out := f(self))) or out)
    monkeypatch.setattr(class_lm, "ENTRIES", 1000, raising=False)  # many parts of the words
    docs = spark.createDataFrame(_rare_words(), "doc_id long, text string").repartition(3)
    model, counts = class_lm.train(class_lm._texts(docs, "doc_id", "text"))
    c = collections.Counter(w for _, t in _rare_words() for w in [*t.encode().split(), b""])
    assert {bytes(r["w"]): r["n"] for r in counts.collect()} == c
    even, odd = (collections.Counter(model.known[b"%dqq" % i][1] for i in range(k, 200, 2)) for k in (0, 1))
    assert even.most_common(1)[0][0] != odd.most_common(1)[0][0]
    assert sum((even & odd).values()) < 20
    assert max(sent) <= class_lm.CLASSES ** 2  # no list of words reaches the driver


def test_class_score_by_brute_force(docs, monkeypatch):
    monkeypatch.setattr(class_lm, "ENTRIES", 100, raising=False)
    got = _by_id(class_lm.score_texts(docs), "score")
    model, counts = class_lm.train(class_lm._texts(docs, "doc_id", "text"))
    known = {bytes(r["w"]): model.known[bytes(r["w"])] for r in counts.collect()}
    joint = np.zeros((class_lm.CLASSES, class_lm.CLASSES))
    tokens = {i: [b"", *(t or "").encode().lower().split(), b""] for i, t in _texts()}
    for i, ws in tokens.items():
        if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1:
            for a, z in zip(ws, ws[1:], strict=False):
                joint[known[a][1], known[z][1]] += 1
    assert (joint.sum(0) == model.size).all()
    step = (joint + class_lm.PRIOR * model.size / model.tokens) / (joint.sum(1, keepdims=True) + class_lm.PRIOR)
    for i, ws in tokens.items():
        want = 0
        for a, z in zip(ws, ws[1:], strict=False):
            (_, b), (n, k) = (known.get(w, (0, int(model.ending[class_lm._ending(w)]))) for w in (a, z))
            p = step[b, k] * (1 - model.spare[k]) * n / model.size[k] if n else step[b] @ model.spare
            want += math.log10(class_lm.MIX * p + (1 - class_lm.MIX) * (n + 0.5) / model.base_of)
        assert got[i] == pytest.approx(want)


def _bag(t):
    w = (t or "").encode().lower().split()
    return collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else collections.Counter([tuple(w)] if w else [])


def test_near_classes(docs, none):
    got = _by_id(bag_minhash.near_classes(docs), "class_id", "kept")
    bags = {i: _bag(t) for i, t in _texts() if i is not None}
    root = {i: i for i in bags}
    for a in sorted(bags):
        for b in sorted(bags):
            both = sum((bags[a] & bags[b]).values())
            if a < b and both and both >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - both):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if x == old else x for k, x in root.items()}
    assert {i: c for i, (c, _) in got.items() if i is not None} == root
    assert got[None] == (None, True) and all(k == (c == i) for i, (c, k) in got.items())
    assert bag_minhash.near_classes(none).count() == 0


def test_bag_minhash_estimates_weighted_jaccard():
    rng = np.random.default_rng(2)
    off = []
    for _ in range(100):
        e = rng.integers(1, 2**63, 60, dtype=np.uint64)
        a, b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
        s = bag_minhash.bag_minhash(np.repeat([0, 1], 60), np.r_[e, e], np.r_[a, b], 2, 128)
        off.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(off)) < 0.02


def test_max_plus(docs, none):
    """Ids are those of one whole pass, wherever a text is cut and however
    many chunks make a run."""
    import public_tokenizers as P
    model = P.path("piece_bpe_32k.model")
    p = max_plus.pieces(model)
    want = {}
    for i, t in _texts():
        whole = max_plus.prepared(t or "")
        want[i, t] = p.trace(whole, 0, p.paths(whole, 0, len(whole), {0: 0.0})[1], len(whole))
        assert p.decode(want[i, t]) == (" " + t if t else "")
    for chunk, run in ((64, 2), (64, 32), (100, 3), (1000, 32), (16384, 32), (10 ** 6, 32)):
        out = max_plus.encode_texts(docs, model, chunk=chunk, run=run).collect()
        assert all(r["round_trip"] for r in out)
        if chunk == 64:
            assert max(r["chunk"] for r in out) > 100
        for i, t in _texts():
            ids = [x for r in sorted((r for r in out if r["id"] == i), key=lambda r: r["chunk"]) for x in r["ids"]]
            assert ids == want[i, t], (chunk, i)
    assert max_plus.encode_texts(none, model).count() == 0


def test_max_plus_without_blanks(spark):
    """Texts without units: states at borders come from the scans alone."""
    import random

    import public_tokenizers as P
    model = P.path("piece_bpe_32k.model")
    p = max_plus.pieces(model)
    rng = random.Random(2)
    texts = ["".join(rng.choice(a) for _ in range(400)) for a in ("ab", "tionerstahing", "日本語中国人x", "aAzZ09+/")] * 3
    rows = [(i, t) for i, t in enumerate(texts)]
    for chunk in (20, 33):
        out = max_plus.encode_texts(spark.createDataFrame(rows, "doc_id long, text string"), model, chunk=chunk, run=3).collect()
        for i, t in rows:
            whole = max_plus.prepared(t)
            ids = [x for r in sorted((r for r in out if r["id"] == i), key=lambda r: r["chunk"]) for x in r["ids"]]
            assert ids == p.trace(whole, 0, p.paths(whole, 0, len(whole), {0: 0.0})[1], len(whole))


def test_matrices_combine_associatively():
    rng = np.random.default_rng(0)
    a, b, c = (rng.normal(size=(4, 4)) for _ in range(3))
    m = max_plus.max_plus
    assert np.allclose(m(m(a, b), c), m(a, m(b, c)))


def test_language(spark, docs, none):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    out = byte_cnn.op7_byte_cnn_language(spark, SF).join(d.select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.9 and out.score.between(0, 1).all()
    got = _by_id(byte_cnn.identify(docs, byte_cnn.train(docs)), "lang_pred", "score")
    assert got[2] == ("und", 0.0) and got[3] == ("und", 0.0) and got[11][0] == "und" and got[10][0] == "en"
    assert byte_cnn.identify(none, byte_cnn.train(none)).count() == 0


def test_quality(spark, docs, none):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = pu_quality.op8_pu_quality(spark, SF).join(labels, "doc_id").toPandas()
    assert (out.predicted[out.quality == 1] == 1).mean() > 0.95
    assert out.score[out.quality == 1].mean() > out.score[out.quality == 0].mean() + 0.15
    model = pu_quality.train(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    got = pu_quality.score_quality(docs, model).collect()
    assert len(got) == 15 and all(0 <= r["score"] <= 1 for r in got)
    assert pu_quality.score_quality(none, pu_quality.train(none, labels)).count() == 0


def _removed(rows):
    seen, out = set(), {}
    for i, t in sorted((i, (t or "").encode()) for i, t in rows):
        cov = np.zeros(len(t) + 1, int)
        for k in range(len(t) - 99):
            w = t[k:k + 100]
            if w in seen:
                cov[k] += 1
                cov[k + 100] -= 1
            seen.add(w)
        c = np.cumsum(cov)[:len(t)] > 0
        keep = np.frombuffer(t, np.uint8)[~c].tobytes() if t else b""
        out[i] = (len(t), int(c.sum()), int((np.diff(np.append(0, c.astype(int))) == 1).sum()), hashlib.sha256(keep).hexdigest())
    return out


def test_suffix_dedup(docs, none, monkeypatch):
    cols = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    rows = [x for x in _texts() if x[0] is not None]
    got = _by_id(suffix_dedup.remove_repeats(docs, with_text=False), *cols)
    assert {i: v for i, v in got.items() if i is not None} == _removed(rows)
    assert sum(v[1] for v in got.values()) > 1000
    texts = _by_id(suffix_dedup.remove_repeats(docs), "text")
    assert texts[2] is None and texts[6] == PASSAGE and texts[7] == "before  after".replace("  ", texts[7][7:-6] if len(texts[7]) > 13 else "  ")
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_strips_of_short_blocks():
    for n in range(110):
        got = suffix_dedup.strips(np.zeros(n, np.uint8), np.array([0, n // 2, n]))
        assert all(len(x) == 0 for x in got)
        assert suffix_dedup.strips(np.zeros(n, np.uint8), np.array([0, n]))[2].sum() == max(n - 99, 0)


def test_suffix_dedup_of_short_texts(spark):
    cols = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    for text in (None, "", "x" * 50):
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        assert _by_id(suffix_dedup.remove_repeats(df, with_text=False), *cols) == _removed([(1, text)])
    rng = np.random.default_rng(5)
    a, b = (rng.integers(97, 123, 1_000_100, dtype=np.uint8).tobytes().decode() for _ in range(2))
    rows = [(0, a), (1, "short"), (2, b[:500] + a[:200] + b[500:])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = _by_id(suffix_dedup.remove_repeats(df, with_text=False), *cols)
    assert got == _removed(rows) and [got[i][1] for i in range(3)] == [0, 0, 200]


@pytest.mark.parametrize("size", [60, 130])
def test_suffix_dedup_of_a_hot_anchor(spark, monkeypatch, size):
    rng = np.random.default_rng(size)
    word = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes().decode()
    phrase, passage = word(size), word(300)
    rows = [(i, word(150) + phrase + word(150) + (passage if i % 3 == 0 else "")) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(suffix_dedup, "HOT", 8)
    settle, limit = suffix_dedup._settle, 8

    def checked(n_buckets):
        run = settle(n_buckets)

        def group(t):
            per = collections.Counter(np.frombuffer(b"".join(t["anchor"].to_pylist()), np.uint64).tolist())
            assert max(per.values(), default=0) <= limit, "strips of one anchor in one group"
            return run(t)
        return group

    monkeypatch.setattr(suffix_dedup, "_settle", checked)
    got = _by_id(suffix_dedup.remove_repeats(df, with_text=False), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == _removed(rows) and sum(v[1] for v in got.values()) > 29 * 300


def test_suffix_dedup_sorts_only_windows_that_may_repeat(spark, monkeypatch):
    rng = np.random.default_rng(7)
    word = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes().decode()
    phrase, left, right = word(60), word(40), word(40)
    rows = [(i, word(150) + phrase + word(150)) for i in range(90)]
    rows += [(i, word(150) + left + phrase + right + word(150)) for i in (90, 91, 92)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(suffix_dedup, "HOT", 8)
    sort = suffix_dedup._sort

    def few(n_buckets):
        run = sort(n_buckets)

        def group(t):
            assert len(b"".join(t["start"].to_pylist())) // 4 <= 60, "windows of a hot anchor that occur once"
            return run(t)
        return group

    monkeypatch.setattr(suffix_dedup, "_sort", few)
    got = _by_id(suffix_dedup.remove_repeats(df, with_text=False), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == _removed(rows) and got[90][1] == 0 and min(got[91][1], got[92][1]) >= 140


def test_passages_travel_in_pieces_that_do_not_multiply(spark, monkeypatch):
    rng = np.random.default_rng(8)
    word = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes().decode()
    shared = [word(300) for _ in range(300)]
    rows = [(i, "".join(word(60) + shared[k] for k in rng.integers(0, 300, 3)) + word(60)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    fetch = suffix_dedup._fetch
    monkeypatch.setattr(suffix_dedup, "SORTED", 300)

    def counted(*sizes):
        run = fetch(*sizes)

        def group(docs, want):
            out = run(docs, want)
            assert out.num_rows <= 20, "a piece for almost every strip"
            return out
        return group

    monkeypatch.setattr(suffix_dedup, "_fetch", counted)
    got = _by_id(suffix_dedup.remove_repeats(df), "text")
    want = _removed(rows)
    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in got.items()} == {i: v[3] for i, v in want.items()}
    assert sum(v[1] for v in want.values()) > 300 * 300


def test_ids_have_one_bucket_everywhere(spark):
    ids = [None, 0, 1, -1, 7, 2**31, 2**32 - 1, -2**63, 2**63 - 1, *range(10**12, 10**12 + 64_000, 64)]
    df = spark.createDataFrame([(i,) for i in ids], "id long").select("id", suffix_dedup._id_bucket(F.col("id"), 16).alias("b"))
    t = df.toArrow()
    assert t["b"].to_pylist() == suffix_dedup._bucket(suffix_dedup._ids(t["id"].combine_chunks()), 16).tolist()
    assert max(collections.Counter(t["b"].to_pylist()).values()) < 120


@pytest.mark.parametrize("letters", [1, 2, 256])
def test_suffix_array(letters):
    rng = np.random.default_rng(letters)
    for n in (1, 2, 7, 300):
        t = rng.integers(0, letters, n).astype(np.uint8)
        sa, b = suffix_dedup.suffix_array(t), t.tobytes()
        assert sorted(sa.tolist()) == list(range(n))
        assert all(b[x:x + 100] <= b[y:y + 100] for x, y in zip(sa, sa[1:], strict=False))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = corpus_pipeline.cut(stage(spark, docs, SF))
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == cols and set(after) <= set(before)
        if name in ("line_dedup", "passages"):
            assert set(after) == set(before) and all(len(after[i]) <= len(before[i]) for i in after)
        else:
            assert all(after[i] == before[i] for i in after)
        if name == "passages":
            assert {i: len(t.encode()) for i, t in after.items()}.keys() == _removed(before.items()).keys()
    packed = corpus_pipeline.packed(spark, docs, SF).toPandas()
    assert set(packed.doc_id) == set(after)


def _without_repeats(rows):
    """Texts without the characters whose bytes all go."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        t = text.encode()
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 99):
            if t[k:k + 100] in seen:
                gone[k:k + 100] = True
            seen.add(t[k:k + 100])
        ends = np.cumsum([len(c.encode()) for c in text]).astype(int)
        out[i] = "".join(c for c, e in zip(text, ends, strict=True) if not gone[e - len(c.encode()):e].all())
    return out


def _near_kept(texts):
    bags = {i: _bag(t) for i, t in texts.items()}
    root = {i: i for i in bags}
    for a in sorted(bags):
        for b in sorted(bags):
            both = sum((bags[a] & bags[b]).values()) if a < b else 0
            if both and both >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - both):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if x == old else x for k, x in root.items()}
    return {i for i in root if root[i] == i}


def test_pipeline_against_brute_force(spark, scratch, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    rows = docs.collect()
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    long = sorted((r for r in rows if r["doc_id"] in good and len(r["text"]) > 1500), key=lambda r: r["doc_id"])[:6]
    assert len(long) == 6
    near = [r["text"] + " changed" for r in long[:3]]
    cut_in = [a["text"][:700] + " é " + b["text"][300:700] + " " + a["text"][700:] + b["text"][::-1] for a, b in zip(long[3:], long, strict=False)]
    lined = [r["text"] + "\n" + "\n".join(LINES * 3) for r in long[3:]]
    top = max(r["doc_id"] for r in rows) + 1
    rows += [type(long[0])(doc_id=top + i, text=t, lang=long[0]["lang"], source=long[0]["source"], n_chars=len(t))
             for i, t in enumerate([*near, *cut_in, *lined])]
    spark.createDataFrame(rows, docs.schema).repartition(3).write.parquet(f"{scratch}/documents.parquet")
    labels.write.parquet(f"{scratch}/labels.parquet")
    given = {}

    def noted(name, stage):
        def run(spark, docs, sf_dir):
            got = docs.collect()
            assert all(r["n_chars"] == len(r["text"]) for r in got)
            given[name] = {r["doc_id"]: r["text"] for r in got}
            return stage(spark, docs, sf_dir)
        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [noted(*s) for s in corpus_pipeline.STAGES])
    packed = corpus_pipeline.run(spark, scratch).collect()
    all_, kept, lines, near, last = (given[n] for n in ("quality", "line_dedup", "near_dedup", "passages", "packing"))

    there = spark.read.parquet(f"{scratch}/documents.parquet")
    judged = pu_quality.score_quality(there, pu_quality.train(there, labels)).collect()
    assert kept == {i: all_[i] for i in (r["doc_id"] for r in judged if r["predicted"] == 1)} and 0 < len(kept) < len(all_)

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(kept.items()))
    assert lines == dict(con.execute(line_chunks.sql("documents", "SELECT doc_id, kept FROM doc")).fetchall()) != kept

    assert near == {i: lines[i] for i in _near_kept(lines)} and len(near) < len(lines)
    assert last == _without_repeats(near.items()) != near

    enc, bins = packing.encoder(*packing._vocab()), collections.defaultdict(list)
    for i, t in last.items():
        ids = np.array(enc.slow.encode(t, add_special_tokens=False).ids + [0], "<u4")
        mine = sorted((r for r in packed if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in mine] == packing.cut_points(len(ids), 2048)
        assert [r["ids_crc32"] for r in mine] == [zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in mine]
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {r["doc_id"] for r in packed} == set(last) and sorted(bins) == list(range(len(bins)))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 2048


def test_columns_named_like_the_operators_own(spark):
    """Dots, blanks and the operators' own names: every input column comes
    through the four filtering stages with its own values."""
    own = ["score", "predicted", "kept", "class_id", "n_lines", "n_bytes", "n_spans", "kept_sha256", "row", "carried", "a.b", "x y", "id"]
    texts = [(i, t) for i, t in _texts() if i is not None]
    schema = "doc_id long, text string, n_chars long, " + ", ".join(f"`{c}` string" for c in own)
    docs = spark.createDataFrame([(i, t, len(t or ""), *[f"mine {c} {i}" for c in own]) for i, t in texts], schema).repartition(2)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema == docs.schema or [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        kept[name] = out.collect()
        for r in kept[name]:
            assert [r[c] for c in own] == [f"mine {c} {r['doc_id']}" for c in own]
            assert r["n_chars"] == (None if r["text"] is None and name in ("line_dedup", "passages") else len(r["text"] or "")) or r["text"] is None
    assert len(kept["line_dedup"]) == len(kept["passages"]) == len(texts)
    assert all(sum(x["doc_id"] in (0, 1) for x in kept["near_dedup"]) == 1 for _ in (0,))


def test_packing_keeps_columns_of_any_name(spark):
    pieces = spark.createDataFrame([(i, 0, 100 + i, "p", "r", "b", "q") for i in range(50)],
                                   "id long, piece int, length long, _part string, _rank string, _before string, `rank x.y` string")
    out = packing.best_fit_pack(pieces)
    assert out.columns == [*pieces.columns, "sequence_id", "offset", "slot"]
    assert {(r["_part"], r["_rank"], r["_before"], r["rank x.y"]) for r in out.collect()} == {("p", "r", "b", "q")}
    again = packing.best_fit_pack(out)  # its own columns give way
    assert again.columns == out.columns and again.count() == 50


def test_names_with_dots_and_blanks(spark):
    docs = spark.createDataFrame([(1, "some words here", "en", 1), (2, None, None, 2)], "doc_id long, text string, lang string, `a.b c` int")
    model = pu_quality.fit_nnpu(np.zeros((0, 1)), np.zeros((0, 1)), 0.5)
    model = pu_quality.Model(np.zeros(pu_quality.N_FEATURES), np.ones(pu_quality.N_FEATURES), np.zeros(pu_quality.N_FEATURES), model.b, 0.5)
    assert sorted(r["a.b c"] for r in pu_quality.score_quality(docs, model).collect()) == [1, 2]
    assert sorted(r["a.b c"] for r in byte_cnn.identify(docs, byte_cnn.train(docs)).collect()) == [1, 2]
    assert sorted(r["a.b c"] for r in suffix_dedup.remove_repeats(docs).collect()) == [1, 2]


def test_all_residuals_select_and_cost_no_sequence():
    rng = np.random.default_rng(4)
    counts = collections.Counter(np.minimum(2048, rng.lognormal(5, 1, 3000).astype(int) + 1).tolist())
    least = math.ceil(sum(n * k for n, k in counts.items()) / packing.CAPACITY)
    plans = {w: packing.plan_bins(dict(counts), weights=w) for w in (packing.WEIGHTS, (1.0, 0.0, 0.0))}
    assert plans[packing.WEIGHTS] != plans[1.0, 0.0, 0.0]
    for runs in plans.values():
        assert max(r[2] + r[3] for r in runs) == least
