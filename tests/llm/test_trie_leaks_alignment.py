"""Prefix trie, benchmark decontamination and token alignment against brute
force on small tables with NULLs, empty and long texts, ties, repeated rows,
clashing columns and no rows at all."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest

from healthmart.llm import decontaminate, prefix_trie, token_align

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _same_as_sql(df, sql, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.collect()) and want


# ---- prefix trie

def _turns():
    rows = []
    for c in list(range(0, 12)) + [99, 100, 101, 102, 150, 205, 300, 399]:
        for t in range(c % 7):
            rows.append((c, t if c != 5 else None, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c % 3}"))
    rows += [(c, t, "user", "same words") for c in range(600, 640) for t in range(4)]  # one large group of copies
    rows += [(700, None, None, None), (700, None, None, None), (700, 1, "user", ""), (None, 0, "user", "nobody's"), (701, 3, "user", "é" * 500)]
    rows += [(800, t, "user", f"long {t}") for t in range(60)]
    return rows


def _brute_trie(rows):
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((t is not None, t or 0, role, sha(f"{len(role)}:{role}{text}")), role, text))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + mine[h:]
    node = collections.defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            node[tuple(seq[:d])].append(c)
    out = []
    for seq, members in node.items():
        under = [k for k in node if k[:len(seq)] == seq]
        kids = {k for k in under if len(k) == len(seq) + 1}
        leaves = [k for k in under if not any(j[:len(k)] == k and len(j) > len(k) for j in under)]
        saved = sum((len(node[k]) - 1) * len(k[-1][1]) for k in under if k)
        ends = sorted(c for c in members if len(built[c]) == len(seq))
        out.append((min(members), len(seq), min(node[seq[:-1]]) if seq else None, len(members), len(kids), len(leaves), saved,
                    sha(",".join(map(str, ends)))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def turns(spark):
    rows = [(*r, 1, "k") for r in _turns()]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int, key string").repartition(5)


@pytest.mark.parametrize("block,broadcast", [(8192, 1 << 18), (3, 0), (1, 1 << 18)])
def test_prefix_trie(turns, block, broadcast):
    out = prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.sequences(turns)), block=block, broadcast=broadcast)
    assert sorted(map(tuple, out.collect()), key=repr) == _brute_trie(_turns())


def test_prefix_trie_edges(turns, spark):
    empty = prefix_trie.sequences(turns.limit(0))
    assert prefix_trie.prefix_trie(empty).count() == 0
    alone = spark.createDataFrame([(-3, None, None, None)], turns.select("conv_id", "turn", "role", "text").schema)
    got = prefix_trie.prefix_trie(prefix_trie.sequences(alone)).orderBy("depth").collect()
    assert [tuple(r) for r in got] == [(-3, 0, None, 1, 1, 1, 0, sha("")), (-3, 1, -3, 1, 0, 1, 0, sha("-3"))]


def test_forest_of_sorted_sequences():
    def key(s):
        return b"".join(hashlib.md5(c.encode()).digest() for c in s)

    assert prefix_trie.lcp(key("abcd"), key("abxd")) == 2 and prefix_trie.lcp(key("ab"), key("abc")) == 2 and prefix_trie.lcp(b"", key("a")) == 0
    words = sorted(map(key, ["", "a", "ab", "ab", "abc", "abd", "b", "xyz"]))
    f = prefix_trie.Forest(words)
    live = {f.depth[v]: 0 for v, _ in f.preorder()}
    for v, _ in f.preorder():
        live[f.depth[v]] += 1
    assert live == {0: 1, 1: 2, 2: 1, 3: 3} and len(f.ends[f.root]) == 1


def test_prefix_trie_sql(spark):
    _same_as_sql(prefix_trie.op11_prefix_trie(spark, SF), prefix_trie.OP11_SQL, "conversations")


# ---- benchmark decontamination

ITEMS = [(1, " ".join(f"w{i}" for i in range(25))), (2, " ".join(f"w{i}" for i in range(25))), (3, "tiny Item"), (4, "solo"), (5, ""),
         (6, None), (7, "the cat the cat the cat the cat the cat the cat"), (8, "!!! ???"), (9, "alpha beta gamma delta epsilon zeta eta"),
         (9, "a second text of item nine"), (None, "item without any id at all"), (10, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w99"),
         (11, "naïve Ünï 日本 x y z")]
DOCS = [(0, " ".join(f"w{i}" for i in range(3, 40))), (1, "nothing here"), (2, None), (3, ""), (4, "TINY, item! and SOLO;solo"),
        (5, "the cat " * 40), (6, " ".join(f"W{i}" for i in range(9))), (6, " ".join(f"W{i}" for i in range(9))), (7, "alpha-beta gamma delta epsilon zeta eta tiny"),
        (8, "x " * 20000 + " ".join(f"w{i}" for i in range(10)) + " y" * 20000), (None, "item without any id at all; a second text of item nine"),
        (9, "alpha beta gamma delta epsilon zeta"), (10, "naïve\x00Ünï 日本 X Y Z"), (11, "Naïve ünï 日本 x y z"), (12, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"),
        (0, "another text of id nought: solo")]


def _brute_leaks(docs, items):
    def ws(t):
        return re.findall(decontaminate.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    wins = collections.defaultdict(set)
    for i, t in items:
        w = ws(t)
        n = min(len(w), 10)
        for s in range(len(w) - n + 1 if n else 0):
            wins[tuple(w[s:s + n])].add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = ws(t), set(), set()
        for n in {len(k) for k in wins}:
            for s in range(len(w) - n + 1):
                got = wins.get(tuple(w[s:s + n]))
                if got:
                    hit |= set(range(s, s + n))
                    found |= got
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").repartition(3)


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_contaminated(spark, bench, broadcast):
    docs = spark.createDataFrame([(*d, 1, "x", 2) for d in DOCS], "doc_id long, text string, n int, h string, spans int").repartition(4)
    rows = decontaminate.contaminated(docs, bench, broadcast=broadcast).collect()
    got = sorted(((r["doc_id"], r["n_words"], sum(s["n"] for s in r["spans"]), r["items"]) for r in rows), key=repr)
    assert got == _brute_leaks(DOCS, ITEMS)
    assert sum(g[2] > 0 for g in got) >= 8
    for r in rows:
        at = [(s["start"], s["start"] + s["n"]) for s in r["spans"]]
        assert all(x[1] <= y[0] for x, y in zip(at, at[1:]))


def test_contaminated_without_rows(spark, bench):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert all(r["spans"] == [] and r["items"] == [] for r in decontaminate.contaminated(docs, bench.limit(0)).collect())


def test_decontamination_sql_and_plan(spark):
    df = decontaminate.op12_prefix_decontaminate(spark, SF)
    assert not re.search("Python|ArrowEval|MapInArrow", df._jdf.queryExecution().executedPlan().toString())
    _same_as_sql(df, decontaminate.OP12_SQL, "documents", "benchmark")


# ---- cross-tokenizer alignment

TEXTS = [(0, "Plain words, twice: words."), (1, None), (2, ""), (3, "<|endoftext|> and <s> </s> <0x41>"), (4, "a▁b"), (5, "日本語 ünï 👩‍👩‍👧 naïve"),
         (6, "\n\n\n   \t\t  x" * 30), (7, " leading"), (8, "plain words"), (8, "plain words"), (None, "plain words"), (9, "word " * 3000), (10, "x" * 4000),
         (11, "0123456789 " * 50), (12, "é​﻿"), (13, "¶§ → ∑ 𝛼𝛽")]


def _brute_alignment(t, rows):
    docs, count = [], collections.Counter()
    for i, text in rows:
        raw = (" " + (text or "")).encode()
        a = t.a.slow.encode(" " + (text or ""), add_special_tokens=False).ids
        b = t.b.encode(text or "")
        if not text or b"".join(t.a_bytes[x] for x in a) != raw or b"".join(t.b_bytes[x] for x in b) != raw:
            docs.append((i, [], collections.Counter()))
            continue
        groups, at = [([], [])], 0
        a_at, b_at = [0, *np.cumsum([len(t.a_bytes[x]) for x in a])], [0, *np.cumsum([len(t.b_bytes[x]) for x in b])]
        both = sorted(set(a_at) & set(b_at))
        groups = [([x for x, e in zip(a, a_at[1:]) if lo < e <= hi], [x for x, e in zip(b, b_at[1:]) if lo < e <= hi]) for lo, hi in zip(both, both[1:])]
        links = collections.Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        count.update(links.keys())
        docs.append((i, groups, links))
    most = collections.defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return sorted(((i, sum(len(g[0]) for g in gs), sum(len(g[1]) for g in gs), len(gs), sum(links.values()),
                    sum(n for p, n in links.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in links.items()),
                    sha(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)) if gs else "") for i, gs, links in docs), key=repr)


def _files():
    import public_tokenizers as P
    return P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def test_merge_path_pieces():
    rng = np.random.default_rng(5)
    for work in (1, 2, 7, 50):
        a, b = (np.unique(rng.integers(1, 300, n)) for n in (90, 40))
        pieces = token_align.merge_path(a, b, work)
        assert [x for p in pieces for x in range(p[0], p[1])] == list(range(len(a)))
        assert [x for p in pieces for x in range(p[2], p[3])] == list(range(len(b)))
        assert all(p[1] - p[0] + p[3] - p[2] <= work + 1 for p in pieces)
        for p, q in zip(pieces, pieces[1:]):  # all ends of a piece lie before those of the next
            assert max([*a[p[0]:p[1]], *b[p[2]:p[3]]]) < min([*a[q[0]:q[1]], *b[q[2]:q[3]]])


@pytest.mark.parametrize("work,block", [(16384, 1 << 21), (5, 40), (64, 500)])
def test_alignment(spark, work, block):
    vocab, model, ranks, pattern = _files()
    df = spark.createDataFrame([(i, t, 1, "x", 3) for i, t in TEXTS], "doc_id long, text string, doc int, groups string, pair int").repartition(3)
    got = token_align.by_document(token_align.align(df, vocab, model, ranks, pattern, work=work, block_tokens=block, with_groups=False))
    want = _brute_alignment(token_align.tokenizers(vocab, ranks, pattern, model), TEXTS)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert [w[1] for w in want if w[0] == 4] == [0]


def test_alignment_groups_of_a_long_document(spark):
    vocab, model, ranks, pattern = _files()
    df = spark.createDataFrame([(9, "word, " * 300)], "doc_id long, text string")
    units = token_align.align(df, vocab, model, ranks, pattern, work=64).orderBy("piece", "part").collect()
    assert len(units) > 4
    text = ";".join(bytes(u["groups"]).decode() for u in units)
    assert sha(text) == _brute_alignment(token_align.tokenizers(vocab, ranks, pattern, model), [(9, "word, " * 300)])[0][-1]
    assert token_align.by_document(token_align.align(df.limit(0), vocab, model, ranks, pattern)).count() == 0


def test_long_groups_list_distinct_pairs(monkeypatch):
    vocab, model, ranks, pattern = _files()
    t = token_align.tokenizers(vocab, ranks, pattern, model)
    ab = t(["日本語 ünï 👩‍👩‍👧 naïve words and words", "more 日本"])
    args = [x for s in (0, 1) for x in (np.concatenate([np.array(y[s], "<u2") for y in ab]), np.array([len(y[s]) for y in ab]))]
    want = token_align.Units(t, *args).pairs()
    for limit in (1, 2, 5):
        monkeypatch.setattr(token_align, "LINKS", limit)
        got = token_align.Units(t, *args).pairs()
        assert [x.tolist() for x in got] == [x.tolist() for x in want]
