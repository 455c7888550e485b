"""Conversation tries, spelling variants and token files against brute force, on odd rows; repeated ids in the Jaccard join."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from tidemark.llm import convtrie, jaccard, spelling, tokenfile


# ---- op11

def brute_trie(rows):
    """rows: (conv_id, turn, role, text); ties in any order that the rows don't tell apart."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            turns[c].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [x[3:] for x in sorted(t)] for c, t in turns.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        paths[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        weight = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += weight
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


ODD_TURNS = [(1, None, "user", "first of all"), (1, 0, None, None), (1, 0, None, None), (1, 5, "user", "x " * 3000), (2, 0, "user", ""), (2, 1, "a", "b"),
             (2, 1, "ab", ""), (None, 0, "user", "lost"), (None, None, None, None), (20, 0, "user", "hello there"), (20, 1, "bot", "hi"), (21, 0, "user", "only one"),
             (41, 3, "user", "no base"), (-7, 0, "u", "negative"), (45, 0, "u", "a\tb"), (46, 0, "u", "a\tb")]


@pytest.mark.parametrize("fan", [2, 64])
def test_trie(spark, monkeypatch, fan):
    monkeypatch.setattr(convtrie, "FAN", fan)
    monkeypatch.setattr(convtrie, "CHUNK", 7)
    rows = ODD_TURNS + [(100 + i, t, "u", f"word {t} more") for i in range(60) for t in range(3)] + [(300, t, "u", f"{t} {t % 3}") for t in range(400)]
    rows += [(400 + i, t, "u", f"{(i * 7 + t) % 3} same") for i in range(50) for t in range(i % 6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit(1) for c in ("words", "path", "pos", "id", "base", "n", "digest", "shard")}).repartition(3)
    got = [tuple(r) for r in convtrie.trie(convtrie.rebuilt(df)).collect()]
    assert sorted(got, key=lambda r: (r[0], r[1])) == sorted(brute_trie(rows), key=lambda r: (r[0], r[1]))


def test_trie_of_nothing(spark):
    df = spark.createDataFrame(ODD_TURNS, "conv_id long, turn long, role string, text string")
    assert convtrie.trie(convtrie.rebuilt(df.limit(0))).count() == 0
    assert convtrie.trie(convtrie.rebuilt(df.filter("conv_id IS NULL"))).count() == 0


def test_ternary_tree_is_balanced_and_in_order():
    paths = [[a, b] for a in range(64) for b in range(3)]
    tree = convtrie.TernaryTree()
    for m in convtrie._medians(len(paths)):
        tree.insert(paths[m], [1, 1])

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.low[at]), height(tree.high[at]))

    assert height(tree.equal[0]) <= 8
    order = tree.in_order()
    assert [tree.code[x] for x in order if tree.depth[x] == 1] == list(range(64))
    assert len(order) == 1 + 64 + 192 and all(order.index(tree.parent[x]) < order.index(x) for x in order[1:])


# ---- op12

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    form, close = {}, {}
    for w in n:
        close[w] = sorted((-n[x], x) for x in n if near(w, x))
        form[w] = close[w][0][1] if close[w] and n[close[w][0][1]] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def test_spelling(spark):
    rng = np.random.default_rng(3)
    base = ["abcdefg", "abcdefgh", "aaaaaaa", "aaaaaaaa", "éàüßçñö", "Schiffahrt", "schifffahrt", "x" * 300, "x" * 299, "x" * 301, "zabcdefg", "abcxdefg", "abdcefg"]
    made = set(base)
    for w in base:
        for _ in range(25):
            i, c = int(rng.integers(0, len(w) + 1)), chr(97 + int(rng.integers(0, 3)))
            made |= {w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]}
    times = {w: int(rng.choice([1, 2, 3, 20, 25, 300])) for w in sorted(made)}
    rows = [(i, " ".join([w] * t)) for i, (w, t) in enumerate(times.items())] + [(None, None), (None, "Abcdefg abcdefG"), (7, ""), (7, "× ÷×÷×÷×÷ ×÷×÷×÷×÷")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("word", "n", "key", "run", "form", "root")})
    got = spelling.variants(df)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_variants(rows)
    assert spelling.variants(df.limit(0)).count() == 0


def test_forms_lead_to_the_last(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)], "word string, form string")
    assert {r["root"] for r in spelling.roots(forms).collect()} == {"w9"}


# ---- op13

IDS = [np.zeros(0, "u4"), np.array([5], "u4"), np.random.default_rng(0).zipf(1.3, 5000).clip(0, 2**32 - 1).astype("u4"), np.full(3000, 2**32 - 1, "u4"),
       np.random.default_rng(0).integers(0, 2**32, 2500).astype("u4"), np.tile([7, 7, 7, 9_000_000], 2000).astype("u4")]


@pytest.mark.parametrize("ids", IDS)
def test_blocks(ids):
    content = tokenfile.segment_bytes(4, 2, [9], [len(ids)], ids) + b"\n" + tokenfile.segment_bytes(4, 3, [None], [len(ids)], ids) + b"\n"
    one, two = tokenfile.segments(content)
    for s in (one, two):
        assert (s.ids_between(0, len(ids)) == ids).all() and (s.ids_between(1000, 1100) == ids[1000:1100]).all()
        assert [len(x) for *_, x in s.documents()] == [len(ids)]
    assert two.doc_ids == [None] and (one.shard, one.number) == (4, 2)


def test_blocks_are_small():
    ids = np.random.default_rng(1).integers(0, 60, 1 << 16).astype("u4")
    ids[::50] = 1 << 30  # outliers go to the exceptions
    assert len(tokenfile.segment_bytes(0, 0, [1], [len(ids)], ids)) < (1 << 16) * 1.1


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(tokenfile.VOCABULARY))


ODD = [None, "", " \t\n\r\x0b\x0c", "Don't stop <|endoftext|> x<|endoftext|>y, a'b 'tis I'LL we've…", "“quoted”, ”x foo'", "é T̈ İstanbul ΣΑΣ ﬁ ½ x² 3.14abc,", "a\x1cb\x85c\xa0d e",
       "\x01\x7f é.", "日本語 テキスト。 ", "'s 't 'S x's, 's,", "a,b c.d. e-f- __ --", "ª º µ ß ÿ × ÷ ×, Àé!", "𝔘𝔫𝔦 😀😀.", "ſ K Å", "word " * 30_000, "y" * 5000, "same", "same"]


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(tokenfile, "SEGMENT", 3000)
    rows = [(i * 10 % 7 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "three again"), (3, "three again"), (-5, "minus")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("start", "n_tokens", "data", "_h")}).repartition(3)
    path = tokenfile.folder(spark)
    tokenfile.write_tokens(df, public_tokenizers.path(tokenfile.VOCABULARY), path)
    got = tokenfile.read_documents(spark, path, lambda ids: (ids.tolist(),), "ids array<bigint>").orderBy("start").collect()
    lib = library()
    want = Counter((d, tuple(lib.encode(t or "", add_special_tokens=False).ids) + (2,)) for d, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:i]) for i in range(len(got))]
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert order == sorted(order)
    path = tokenfile.folder(spark)
    tokenfile.write_tokens(df.limit(0), public_tokenizers.path(tokenfile.VOCABULARY), path)
    assert tokenfile.read_documents(spark, path, lambda ids: (1,), "one int").count() == 0


def test_token_files_against_the_library(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    lib, at, want = library(), 0, []
    for d, t in docs:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, tokenfile.op13_token_files(spark, SMOKE).collect())) == want


# ---- op1

def test_ids_with_several_texts(spark):
    a, b = " ".join(map(str, range(100))), " ".join(map(str, range(500, 600)))
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (4, None), (4, None), (5, "alone here"), (5, "alone here"), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit("clash"))
    got = Counter(tuple(r) for r in jaccard.classes(df).select("doc_id", "class_id", "n_links").collect())
    assert got == Counter([(1, 1, 1), (2, 1, 1), (2, 2, 1), (3, 2, 1), (4, 4, 0), (4, 4, 0), (5, 5, 1), (5, 5, 1), (None, None, 0)])
    kept = jaccard.one_of_each(df)
    assert kept.columns == ["doc_id", "text", "h"]
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([(1, a), (2, b), (4, None), (4, None), (5, "alone here"), (None, a)])


def test_large_group_of_near_copies(spark, monkeypatch):
    """Many chunks: every link between different texts counts once."""
    monkeypatch.setattr(jaccard, "TILE", 16)
    base = [str(i) for i in range(300)]
    texts = [" ".join(base[:i] + ["new"] + base[i + 1 :]) for i in range(3, 290, 2)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = jaccard.classes(df).collect()
    assert {(r["class_id"], r["n_links"]) for r in got} == {(0, len(texts) - 1)}


def test_spelling_broadcasts_nothing(spark):
    words = spelling.stored(spark.createDataFrame([(f"tidemark{i}", 2 + i) for i in range(50)], "word string, n bigint"))
    docs = spark.createDataFrame([("a", "benchmark benchmark benchmarks benchmarks")], "doc_id string, text string")
    for df in (spelling.near_pairs(words), spelling.variants(docs)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
