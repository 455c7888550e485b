"""The training-data operators against brute force, on odd rows: nulls, empty and long texts, ties, repeated rows, empty
tables, and columns whose names clash."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from tests.oracle_compare import compare, duck
from tidemark.llm import bpe, classifier, common, jaccard, mixing, pii, preferences, quality_rules, queries, topk, toxicity, urlfilter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMOKE}/documents.parquet")


def odd(spark, texts):
    """Rows with ids from 1, a null id at the end, and clashing names."""
    rows = [(i + 1, t, None if i % 3 else "en", None if i % 4 else "a") for i, t in enumerate(texts)] + [(None, "no id here", "en", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit(1) for c in ("score", "size", "words", "y", "_t", "_row", "block", "n_chars", "kind")})


TEXTS = [None, "", " \t\n", "a b", "a b", "word " * 3000, "x" * 5000, "one two three four five six seven eight nine ten\n" * 3, "😀 ünï ²½  end"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    compare(spark, duck(SMOKE), queries.QUERIES[name], queries.ORACLES[name], SMOKE)


def brute_statistics(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, docs):
    for df in (docs, odd(spark, TEXTS)):
        got = quality_rules.judged(df).toPandas()
        want = sorted(map(brute_statistics, df.toPandas()["text"]))
        assert sorted(zip(got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words)) == want
        failed = (got.n_words < 20) | (100 * got.n_repeat_words > 30 * got.n_words)
        assert (got.base_failed == failed).all() and not got.kept[failed].any()
    assert quality_rules.judged(docs.limit(0)).count() == 0


def test_robust_estimate_ignores_outliers(spark):
    rng = np.random.default_rng(1)
    good = rng.normal(0, 1, (300, 5)) * [1, 0.4, 0.2, 0.4, 0.4] * 1024
    bad = rng.normal(0, 1, (60, 5)) * 50 + 12_000
    rows = spark.createDataFrame([("g", *map(int, r)) for r in np.vstack([good, bad])], "_g string, " + ", ".join(f"{c} long" for c in quality_rules.X))
    d = quality_rules.distances(rows, quality_rules.mcd(rows), ["_g"]).toPandas()
    far = d["_x0"] > 8_000
    assert (d["_d2"][far] > quality_rules.CUT).all() and (d["_d2"][~far] <= quality_rules.CUT).mean() > 0.99


def test_moderate_outliers_go(spark):
    """One text for each dimension that stands out in it alone, among 300 usual ones."""
    rng = np.random.default_rng(2)

    def words(n, size=0):
        return ["".join(chr(97 + c) for c in rng.integers(0, 26, size or int(rng.integers(3, 9)))) for _ in range(n)]

    def text(w):
        return "\n".join(" ".join(w[i : i + 4]) for i in range(0, len(w), 4))

    usual = [text(words(int(100 * np.exp(rng.normal(0, 0.3))) + 20)) for _ in range(300)]
    line, block = words(4), words(15)
    lines = text([x for _ in range(10) for x in [*line, *words(4)]] + [*line, *words(16)])  # 10 of 25 lines are copies
    again = text([*block, *words(34), *block, *words(36)])  # 30 of 100 words, no line twice
    symbols = text([w + "#" * (i % 3 == 0) for i, w in enumerate(words(100, 5))])  # 34 of 534 characters
    odd_ones = [text(words(1200)), text(words(100, 8)), symbols, lines, again]
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(odd_ones + usual)], "doc_id long, text string, lang string, source string")
    got = quality_rules.judged(df).toPandas().set_index("doc_id").sort_index()
    assert not got.base_failed.any() and not got.kept[: len(odd_ones)].any()
    assert got.kept[len(odd_ones) :].mean() > 0.97


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for order, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
            fine = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False, "phone": 9 <= len(d) <= 15,
                    "card": 12 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in twice) % 10 == 0}[kind]
            if fine:
                out.append((m.start(), order, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_pii(spark, docs):
    tricky = ["a@b.c%x@y.zz a.b.c@d.e.f. +1 (988) 555-2485 or 4111 1111 1111 1111, 1.2.3.4.5.6.7.8 300.1.1.1 😀 ü@x.de", "9" * 600 + "a@" + "b" * 600, "1 " * 500, "1." * 500, "+1" * 300 + "(" * 900]
    df = odd(spark, TEXTS + tricky)
    got = pii.detect(df).select("doc_id", pii.listed(F.col("_base")).alias("b"), pii.listed(F.col("_all")).alias("a"))
    want = {r["doc_id"]: brute_spans(r["text"]) for r in df.collect()}
    for r in got.collect():
        assert r["b"] == want[r["doc_id"]]
        assert set(filter(None, r["b"].split(","))) <= set(r["a"].split(","))
    clean = pii.redacted(df)
    assert clean.columns == df.columns and clean.count() == df.count()
    assert clean.filter("doc_id = 10").first()["text"].startswith("<email><email> <email>. <phone> or <card>, <ip>.<ip>")
    assert pii.detect(docs.limit(0)).count() == 0


LONG = ["token=" + "aZ09+/b_" * 62 + "Q8k1", "token=" + "aZ09+/b_" * 12_500, "token=" + ".".join(["eyJhbGciOiJIUzI1NiJ9"] * 25), "secret: " + "Zm9vYmFy" * 40 + "==",
        "Kontakt: " + "ab" * 50 + " (at) " + "c" * 70 + " (dot) d (dot) ee (dot) ff (dot) gg (dot) hh (dot) org"]
OVERLAPS = ["password=Tr0ub4dor&3@db.example.com", "10.0.0.0 4111 1111 1111 1111"]


def masked(spark, texts):
    df = spark.createDataFrame([(i, f"x {t} y", "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    found = {r["doc_id"]: (r["b"], r["a"]) for r in pii.detect(df).select("doc_id", pii.listed(F.col("_base")).alias("b"), pii.listed(F.col("_all")).alias("a")).collect()}
    new = {r["doc_id"]: r["text"] for r in pii.redacted(df).collect()}
    return [(*found[i], new[i]) for i in range(len(texts))]


def test_pii_long_values(spark):
    for t, (_, spans, text) in zip(LONG, masked(spark, LONG)):
        kind, start = ("email_text", 11) if "(at)" in t else ("secret", 2)
        assert f"{kind}:{start}:{2 + len(t)}" in spans.split(",")
        assert text == f"x {t[: start - 2]}<{kind}> y"


def test_pii_overlaps(spark):
    (base, spans, text), (base2, spans2, text2) = masked(spark, OVERLAPS)
    assert base == "email:21:37" and spans == "secret:2:37,email:21:37" and text == "x <secret> y"
    assert base2 == spans2 == "ip:2:10,card:9:30" and text2 == "x <ip><card> y"


def test_mixing(spark, docs):
    for df in (docs, odd(spark, TEXTS)):
        full, filled = mixing.mix(df)
        rows = full.toPandas()
        assert sorted(rows["size"]) == sorted(len(WORD.findall(t or "")) for t in df.toPandas()["text"])
        assert abs(rows.groupby("_sk")["target"].first().sum() - 1.5 * rows["size"].sum()) < 1e-6
        assert (rows["target"] <= 2 * rows["source_size"] + 1e-9).all()
        slots = filled.toPandas()
        assert not slots.duplicated(["_sk", "index"]).any() and slots.groupby(["_sk", "block"]).size().max() <= 2
        taken = slots.groupby("_sk")["words"].sum()
        target = rows.groupby("_sk")["target"].first()
        assert all(abs(taken.get(k, 0) - t) <= 0.5 for k, t in target.items())
        out = mixing.mixed_documents(df)
        assert out.columns == df.columns
        assert sum(len(WORD.findall(t)) for t in out.toPandas()["text"]) == taken.sum()
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_mixing_keeps_texts(spark, docs):
    """A document's parts, in order, are its text, separators and all."""
    gaps = ["  two\t\tspaces \n\n  and lines\r\n" * 400, " \n lead", "trail \t\n", "a\u00a0b \x0b😀\x0c c"]
    for df in (docs, odd(spark, TEXTS + gaps)):
        sizes = {hashlib.sha256((r["text"] or "").encode()).hexdigest(): r["text"] or "" for r in df.collect()}
        rows = mixing.mixed_parts(df.withColumn("sha", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))).collect()
        parts = {}
        for r in rows:
            text = sizes[r["_doc"]["sha"]]
            w = [m.start() for m in WORD.finditer(text)]
            lo, n = r["_first_word"], r["_n_words"]
            begin, end = 0 if lo == 0 else w[lo], len(text) if lo + n == len(w) else w[lo + n]
            assert len(w) == r["_size"] and r["_text"] == text[begin:end]
            parts.setdefault((r["_doc"]["sha"], r["_doc"]["doc_id"]), {})[lo, n] = r["_text"]
        whole = 0
        for (sha, _), p in parts.items():
            if sum(n for _, n in p) == len(WORD.findall(sizes[sha])) and len({lo for lo, _ in p}) == len(p):
                assert "".join(p[k] for k in sorted(p)) == sizes[sha]
                whole += 1
        assert whole
        assert Counter(mixing.mixed_documents(df).toPandas()["text"]) == Counter(r["_text"] for r in rows)


def test_mixing_targets_reshare(spark):
    table = mixing.targets(spark.createDataFrame([("1a", "a", 10), ("1b", "b", 1000), ("0", None, 1000)], "_sk string, source string, size long"))
    got = {r["source"]: r["target"] for r in table.collect()}
    assert got["a"] == 20.0
    assert abs(got["b"] - 2 / 3 * (1.5 * 2010 - 20)) < 1e-9 and abs(got[None] - 1 / 3 * (1.5 * 2010 - 20)) < 1e-9


def test_bpe(spark, docs):
    tiktoken = pytest.importorskip("tiktoken")
    path = bpe.public_tokenizers.path(bpe.VOCABULARY)
    peer = tiktoken.Encoding("own", pat_str=bpe.public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    for df in (docs.limit(60), odd(spark, [*TEXTS, "!?" * 900, " " * 900, "ñ" * 300, "x\x1cy <|endoftext|>\x00"])):
        want = Counter((tuple(peer.encode_ordinary(r["text"] or "")), r["doc_id"]) for r in df.collect())
        ids = bpe.encode(df, path)
        assert Counter((tuple(r["ids"]), r["doc_id"]) for r in ids.collect()) == want
        text = {r["doc_id"]: (r["text"] or "").encode() for r in df.collect()}
        assert all(bytes(r["data"]) == text[r["doc_id"]] for r in bpe.decode(ids, path).collect())
    assert bpe.encoded_digests(docs.limit(0)).count() == 0
    empty = bpe.encoded_digests(odd(spark, [None])).filter("doc_id = 1").first()
    assert empty["n_tokens"] == 0 and empty["ids_sha256"] == hashlib.sha256(b"").hexdigest()


def test_jaccard(spark, docs):
    base = [" ".join(map(str, range(200))) + f" {i}" for i in range(jaccard.SMALL + jaccard.TILE + 20)]
    df = odd(spark, [None, "", "a b", "a  b\n", "c d", " ".join(map(str, range(9000))), " ".join(map(str, range(9000))) + " z", *base])
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.classes(df).collect()}
    assert got[1] == (1, 0) and got[2] == (2, 0) and got[3] == got[4] == (3, 1) and got[5] == (5, 0)
    assert got[6] == got[7] == (6, 1) and got[None] == (None, 0)
    assert {got[i] for i in range(8, 8 + len(base))} == {(8, len(base) - 1)}
    assert jaccard.one_of_each(df).count() == 6 + 1
    assert jaccard.classes(docs.limit(0)).count() == 0


def test_jaccard_against_brute_force(spark, docs):
    rows = docs.collect()
    sets = {}
    for r in rows:
        w = WORD.findall(r["text"])
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    links = Counter()
    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i != j and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
    got = {r["doc_id"]: r["n_links"] for r in jaccard.classes(docs).collect()}
    assert got == {i: links[i] for i in ids}


def test_classifier_and_toxicity(spark):
    folder = SMOKE.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    for name, label, least in (("op8_quality_classifier", "quality", 0.95), ("op4_toxicity", "toxic", 0.85)):
        got = queries.QUERIES[name](spark, folder).toPandas().merge(labels, on="doc_id")
        held = got[got.held_out]
        assert got.score.between(0, 1).all()
        assert (held.predicted == held[label]).mean() >= least


def test_scores_of_odd_rows(spark):
    df = odd(spark, TEXTS)
    none = spark.createDataFrame([(1, None, None), (None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    for labels in (none, none.limit(0)):
        got = classifier.scored(df, labels).toPandas()
        assert len(got) == len(TEXTS) + 1 and got.score.between(0, 1).all()
        field = toxicity.fit(df, labels, "toxic", F.lit(True))
        assert toxicity.tagged(df, field).filter("score >= 0.7").isEmpty()
    assert classifier.scored(df.limit(0), none).count() == 0


def test_marginals_match_enumeration():
    field = toxicity.Field()
    field.trans, field.start = np.array([[0.2, -1.0], [0.4, 0.7]]), -0.5
    e = np.array([0.3, -1.2, 2.0, 0.1])
    total, one = 0.0, np.zeros(4)
    for n in range(16):
        y = [n >> i & 1 for i in range(4)]
        w = np.exp(y[0] * field.start + sum(a * b for a, b in zip(y, e)) + sum(field.trans[a, b] for a, b in zip(y, y[1:])))
        total += w
        one += w * np.array(y)
    got = 1 / (1 + np.exp(-field.marginals(e, np.array([4]))))
    assert np.allclose(got, one / total)
    both = field.marginals(np.concatenate([e, e[:2]]), np.array([4, 2]))
    assert np.allclose(1 / (1 + np.exp(-both[:4])), one / total)


def test_topk_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (50, None), (100, [1.0]), (1, [0.5, float("nan")]), (2, [0.5, None]), (3, []), (4, [0.25, 1.0]), (4, [0.25, 1.0]), (None, [1.0, 1.0]), (150, [2.0])]
    df = spark.createDataFrame(rows + [(i, [0.5, 0.5]) for i in range(10, 20)], "vec_id long, embedding array<float>").withColumn("v", F.lit(1))
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.nearest(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, i + 1, 10 + i, 32768) for i in range(5)] + [(100, 1, 150, 131072), (150, 1, 100, 131072)]
    assert topk.nearest(df.limit(0)).count() == 0


def test_url_intervals(spark):
    entries = spark.createDataFrame([("l", "domain", "x.com", a, d) for a, d in (("add", 1), ("add", 3), ("remove", 5), ("remove", 6), ("add", 8), ("add", 9), ("remove", 9))] + [(None, "url", "k", "add", 1)],
                                    "list string, kind string, key string, action string, day int")
    assert [(r["since"], r["until"]) for r in urlfilter.intervals(entries).orderBy("since").collect()] == [(1, 5), (8, 9)]
    caps = spark.createDataFrame([("http://a.x.com/p", 4), ("http://a.x.com/p", 5), ("http://a.x.com/p", 4), (None, 4), ("nonsense", 4), ("http://a.x.com/p", None), ("http://notx.com", 4)], "url string, day int")
    got = Counter((r["url"], r["day"], r["blocked"]) for r in urlfilter.evaluated(caps, urlfilter.intervals(entries)).collect())
    assert got["http://a.x.com/p", 4, True] == 2 and sum(n for k, n in got.items() if not k[2]) == 5
    assert urlfilter.evaluated(caps.limit(0), urlfilter.intervals(entries.limit(0))).count() == 0


def test_preferences(spark):
    shape = "pair_id long, turn long, role string, text string"
    a = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "yes"), (1, 1, "assistant", "yes"), (2, 0, None, None), (None, 0, "user", "x")], shape)
    b = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "no"), (2, 0, "", "")], shape)
    got = {r["pair_id"]: r for r in preferences.formatted(preferences.turns_of(a, "pair_id"), preferences.turns_of(b, "pair_id")).collect()}
    assert got[1]["prompt"] == "<|user|>\nq<|end|>\n" and got[1]["n_common"] == 1
    lo, hi = map(int, got[1]["chosen_mask"].split(":"))
    assert got[1]["chosen"][lo:hi] == "yes<|end|>" and got[1]["rejected"][slice(*map(int, got[1]["rejected_mask"].split(":")))] == "no<|end|>"
    assert got[2]["chosen"] == got[2]["rejected"] == "" and got[2]["n_common"] == 1 and set(got) == {1, 2}
    assert preferences.formatted(a.limit(0), b.limit(0)).count() == 0


def test_running_sum_over_buckets(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("k"), F.xxhash64("id").alias("h"))
    got = common.running_sum(df, ["k"], "h", ["id"], "id", "s", rows_per_bucket=50, rank="r").toPandas()
    got["u"] = got["h"].astype("uint64")
    for _, g in got.groupby("k"):
        g = g.sort_values("u")
        assert (g["s"].to_numpy() == g["id"].cumsum().to_numpy() - g["id"].to_numpy()).all() and (g["r"].to_numpy() == np.arange(len(g))).all()


def test_pipeline(spark):
    import corpus_pipeline as p

    out = p.run(spark, SMOKE).toPandas()
    assert len(out) and [n for n, _ in p.STAGES] == ["quality_classifier", "ngram_jaccard", "pii", "mixing", "byte_bpe"]
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        assert stage(spark, docs, SMOKE).columns == docs.columns, name


def test_pipeline_against_brute_force(spark):
    """Each stage over the rows that brute force keeps of the stage before; scores, spans and slots as the models give them."""
    import corpus_pipeline as p

    tiktoken = pytest.importorskip("tiktoken")
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    scores = {r["doc_id"]: r["score"] for r in classifier.scored(docs, spark.read.parquet(f"{SMOKE}/labels.parquet")).collect()}
    rows = {r["doc_id"]: r for r in docs.collect() if scores[r["doc_id"]] >= classifier.THRESHOLD}
    sets = {}
    for i, r in rows.items():
        w = WORD.findall(r["text"])
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in rows:
        for j in rows:
            if i < j and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and top(i) != top(j):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    kept = spark.createDataFrame([r for i, r in rows.items() if root[i] == i], docs.schema)
    clean = {}
    for r in pii.chosen(pii.with_spans(kept), pii.fit(pii.with_spans(kept))).collect():
        out, at = [], 0
        for s, _, e, kind in sorted(r["_all"]):
            if e > at:
                out += [r["text"][at : max(at, s)], f"<{kind}>"]
                at = e
        clean[r["doc_id"]] = "".join(out) + r["text"][at:]
    full, filled = mixing.mix(spark.createDataFrame([r.asDict() | {"text": clean[r["doc_id"]]} for r in kept.collect()], docs.schema))
    streams = {}
    for r in full.collect():
        ends = [m.start() for m in WORD.finditer(clean[r["doc_id"]])]
        streams.setdefault(r["_sk"], []).extend([(r["_start"] + j, r["doc_id"], a if j else 0, b) for j, (a, b) in enumerate(zip(ends, [*ends[1:], len(clean[r["doc_id"]])]))])
    streams = {k: [x[1:] for x in sorted(v)] for k, v in streams.items()}
    path = bpe.public_tokenizers.path(bpe.VOCABULARY)
    peer = tiktoken.Encoding("own", pat_str=bpe.public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    want = Counter()
    for r in filled.collect():
        taken = {}
        for i, a, b in streams[r["_sk"]][r["block"] * mixing.BLOCK_WORDS :][: r["words"]]:
            taken[i] = taken.get(i, "") + clean[i][a:b]
        for i, text in taken.items():
            want[i, len(peer.encode_ordinary(text)), hashlib.sha256(text.encode()).hexdigest()] += 1
    got = Counter((r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in p.run(spark, SMOKE).collect())
    assert want == got and len(got)
