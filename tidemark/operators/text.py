"""Corpus operators: vocabularies, encoders, TF-IDF, n-grams, co-occurrence.

Token arrays stay per document (a row) for the local steps; only corpus-wide
statistics shuffle, and they do so on the token key with map-side partial
aggregation.  Vocabularies are bounded by their size parameter `V`, which is
what makes broadcasting them safe.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import fround

from tidemark.functions import text as T
from tidemark.plans.ordered import global_positions
from tidemark.plans.scale import topn_per, written

#: Tokens that are cut into pieces at a time.
CUT = 200_000


def with_words(corpus: DataFrame, col: str = "text", out: str = "tokens", stop: bool = True) -> DataFrame:
    return corpus.withColumn(out, T.words(F.col(col), stop=stop))


def long_tokens(docs: DataFrame, tokens: str = "tokens", key: str = "doc_id") -> DataFrame:
    """(doc_id, pos, token) with 0-based positions."""
    return docs.select(key, F.posexplode(tokens).alias("pos", "token"))


def token_counts(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    return (
        docs.select(F.explode(tokens).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def _ranked_top(counts: DataFrame, n: int, first_id: int) -> DataFrame:
    """Top-n tokens by count desc, token asc with ids first_id.. in that order.

    orderBy+limit is a per-partition top-n followed by a merge of n rows per
    partition, so only n rows ever meet in one task."""
    top = counts.orderBy(F.col("count").desc(), F.col("token")).limit(n)
    w = Window.orderBy(F.col("count").desc(), F.col("token"))
    return top.select(
        "token", (F.row_number().over(w) + F.lit(first_id - 1)).cast("int").alias("id"), "count"
    )


def build_vocab(docs: DataFrame, V: int, tokens: str = "tokens") -> DataFrame:
    """A5: PAD = id 0 plus the V-1 most frequent tokens as ids 1..V-1."""
    spark = docs.sparkSession
    pad = spark.createDataFrame([(T.SPECIAL_TOKENS[0], 0, None)], "token string, id int, count bigint")
    return pad.unionByName(_ranked_top(token_counts(docs, tokens), V - 1, 1))


def build_vocab_special(docs: DataFrame, V: int, tokens: str = "tokens") -> DataFrame:
    """_PAD/_GO/_EOS/_UNK = 0..3, then the V-4 most frequent tokens."""
    spark = docs.sparkSession
    specials = spark.createDataFrame(
        [(t, i, None) for i, t in enumerate(T.SPECIAL_TOKENS)], "token string, id int, count bigint"
    )
    return specials.unionByName(_ranked_top(token_counts(docs, tokens), V - len(T.SPECIAL_TOKENS), len(T.SPECIAL_TOKENS)))


def encode(docs: DataFrame, vocab: DataFrame, tokens: str = "tokens", unk: int | None = None,
           key: str = "doc_id") -> DataFrame:
    """J6 (unk=None: drop OOV) / J7 (OOV -> unk): (doc_id, ids array<int>).

    The vocabulary is bounded by V, so each task holds it; a row's tokens are
    looked up where they are, a whole Arrow batch at a time, without a shuffle.
    """
    known = vocab.select("token", "id").collect()  # V rows
    kind = docs.schema[key].dataType.simpleString()

    def look_up(batches):
        words = pa.array([r["token"] for r in known], pa.string())
        id_of = np.array([r["id"] for r in known] + [-1 if unk is None else unk], np.int32)
        for b in batches:
            lens = pc.fill_null(pc.list_value_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
            at = pc.fill_null(pc.index_in(b.column(1).flatten(), value_set=words), len(known))
            ids = id_of[at.to_numpy(zero_copy_only=False)]
            ends = np.concatenate([[0], np.cumsum(lens)])
            if unk is None:
                stays = ids >= 0
                ends = np.concatenate([[0], np.cumsum(stays)])[ends]
                ids = ids[stays]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=[key, "ids"])

    return docs.select(key, tokens).mapInArrow(look_up, f"`{key}` {kind}, ids array<int>")


def term_freq(docs: DataFrame, tokens: str = "tokens", key: str = "doc_id") -> DataFrame:
    """(doc_id, token, tf)."""
    return (
        docs.select(key, F.explode(tokens).alias("token"))
        .groupBy(key, "token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def doc_freq(tf: DataFrame) -> DataFrame:
    """A10: (token, df) from a term-frequency table (one row per doc, token)."""
    return tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def tfidf(tf: DataFrame, n_docs: int, key: str = "doc_id") -> DataFrame:
    """note form tf*ln(N/(df+1)) and smoothed tf*(ln((1+N)/(1+df))+1)
    with per-document L2 normalisation."""
    df = doc_freq(tf)
    x = tf.join(df, "token").select(
        key, "token", "tf", "df",
        (F.col("tf") * F.log(F.lit(float(n_docs)) / (F.col("df") + 1))).alias("tfidf_note"),
        (F.col("tf") * (F.log((F.lit(1.0 + n_docs)) / (F.col("df") + 1)) + 1)).alias("_raw"),
    )
    x = x.filter(F.col(key).isNotNull())
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(key)))  # a document's distinct tokens
    return x.select(key, "token", "tf", "df", "tfidf_note", (F.col("_raw") / norm).alias("tfidf"))


def keywords(tfidf_df: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """Top-n TF-IDF terms per document (score desc, token asc)."""
    return topn_per(tfidf_df, key, [fround("tfidf", 9).desc(), F.col("token")], n)


def _zip_at(t: F.Column, d: int) -> F.Column:
    """(w1, w2, d) structs for every position pair at distance d, left to
    right, from two aligned slices (arrays_zip: no per-element lambda)."""
    n = F.greatest(F.size(t) - d, F.lit(0))
    return F.arrays_zip(F.slice(t, 1, n).alias("w1"), F.slice(t, 1 + d, n).alias("w2"), F.array_repeat(F.lit(d), n).alias("d"))


def cooccurrence(docs: DataFrame, window: int = 2, tokens: str = "tokens") -> DataFrame:
    """Symmetric-window word co-occurrence: plain count and 1/d weight.

    The counts are symmetric, so pairs are summed under the smaller word only
    and mirrored after the shuffle; a word beside itself counts in both
    directions."""
    forward = F.concat(*[_zip_at(F.col(tokens), d) for d in range(1, window + 1)])
    pairs = docs.select(F.explode(forward).alias("p")).select(
        F.least("p.w1", "p.w2").alias("a"), F.greatest("p.w1", "p.w2").alias("b"), F.col("p.d").alias("d"))
    half = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.sum(1.0 / F.col("d")).alias("w"))
    twice = F.when(F.col("a") == F.col("b"), 2).otherwise(1)
    one, other = F.struct(F.col("a").alias("w1"), F.col("b").alias("w2")), F.struct(F.col("b").alias("w1"), F.col("a").alias("w2"))
    both = F.array_distinct(F.array(one, other))
    return half.select(F.explode(both).alias("p"), (F.col("n") * twice).alias("count"), (F.col("w") * twice).alias("weight")).select(
        "p.w1", "p.w2", "count", "weight")


def ngram_structs(tokens: F.Column, n: int) -> F.Column:
    """Array of structs (g0 .. g{n-1}) of the consecutive n-grams."""
    m = F.greatest(F.size(tokens) - n + 1, F.lit(0))
    return F.arrays_zip(*[F.slice(tokens, 1 + i, m).alias(f"g{i}") for i in range(n)])


def context_centre_pairs(docs: DataFrame, window: int, tokens: str = "tokens") -> DataFrame:
    """A26 (context to centre): (words up to `window` before and after, word)
    counts.  Centre to context is `cooccurrence`, whose pairs are ordered."""
    edge = F.array(*[F.lit("")] * window)
    g = docs.select(F.explode(ngram_structs(F.concat(edge, F.col(tokens), edge), 2 * window + 1)).alias("g"))
    around = F.array(*[F.col(f"g.g{i}") for i in range(2 * window + 1) if i != window])
    return (
        g.select(F.array_join(F.array_remove(around, ""), " ").alias("context"), F.col(f"g.g{window}").alias("target"))
        .groupBy("context", "target").agg(F.count(F.lit(1)).alias("count"))
    )


def ngram_lm_pairs(docs: DataFrame, n: int, tokens: str = "tokens") -> DataFrame:
    """A26 (n-gram mode): (previous n-1 words, next word) pair counts."""
    g = docs.select(F.explode(ngram_structs(F.col(tokens), n)).alias("g"))
    return (
        g.select(F.concat_ws(" ", *[F.col(f"g.g{i}") for i in range(n - 1)]).alias("context"),
                 F.col(f"g.g{n - 1}").alias("target"))
        .groupBy("context", "target")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def ngram_counts(docs: DataFrame, n: int, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """per document n-gram counts (space-joined n-grams)."""
    g = docs.select(key, F.explode(ngram_structs(F.col(tokens), n)).alias("g"))
    return g.select(key, F.concat_ws(" ", *[F.col(f"g.g{i}") for i in range(n)]).alias("ngram")).groupBy(
        key, "ngram").agg(F.count(F.lit(1)).alias("count"))


def negative_table(vocab: DataFrame, power: float = 0.75) -> DataFrame:
    """Share proportional to count^power with cumulative [lo, hi) ranges.

    The running sum is over the bounded vocabulary (V rows)."""
    v = vocab.filter(F.col("count").isNotNull()).withColumn("_w", F.pow("count", F.lit(power)))
    w_all = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w_run = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v = v.withColumn("_tot", F.sum("_w").over(w_all)).withColumn("_cum", F.sum("_w").over(w_run))
    return v.select(
        "token", "id", "count",
        (F.col("_w") / F.col("_tot")).alias("share"),
        ((F.col("_cum") - F.col("_w")) / F.col("_tot")).alias("lo"),
        (F.col("_cum") / F.col("_tot")).alias("hi"),
    )


def unit_hash(*parts, chunk: int = 0) -> F.Column:
    """Deterministic uniform [0, 1) from md5 of ':'-joined parts (8 hex digits
    starting at chunk*8)."""
    h = F.md5(F.concat_ws(":", *[p if isinstance(p, F.Column) else F.lit(str(p)) for p in parts]))
    return F.conv(F.substring(h, chunk * 8 + 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def mask_tokens(docs: DataFrame, vocab: DataFrame, seed: int, V: int,
                rate: float = 0.15, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """md5-keyed masking: a position is picked when u1 < rate; picked
    positions become [MASK] (u2 < 0.8), a vocabulary word with id
    1 + r mod (V-1) (u2 < 0.9) or stay unchanged.  Output only picked rows:
    (doc_id, pos, token, replacement, action)."""
    lt = long_tokens(docs, tokens, key)
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col("pos").cast("string")))
    u = lt.select(
        key, "pos", "token",
        (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)).alias("u1"),
        (F.conv(F.substring(h, 9, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)).alias("u2"),
        F.conv(F.substring(h, 17, 8), 16, 10).cast("bigint").alias("r"),
    ).filter(F.col("u1") < rate)
    u = u.withColumn("_rid", (F.lit(1) + F.pmod(F.col("r"), F.lit(V - 1))).cast("int"))
    rnd = F.broadcast(vocab.select(F.col("id").alias("_rid"), F.col("token").alias("_rtok")))
    j = u.join(rnd, "_rid", "left")
    action = F.when(F.col("u2") < 0.8, "mask").when(F.col("u2") < 0.9, "random").otherwise("keep")
    repl = F.when(F.col("u2") < 0.8, F.lit("[MASK]")).when(F.col("u2") < 0.9, F.col("_rtok")).otherwise(F.col("token"))
    return j.select(key, "pos", "token", repl.alias("replacement"), action.alias("action"))


# ---------------------------------------------------------------- pages, filters

# HTML entities decoded by the page-to-text extractor.
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def html_to_text(html: F.Column) -> F.Column:
    """Drop script/style/comment blocks, replace tags by spaces, decode
    the common entities (&amp; last), collapse whitespace."""
    t = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>", " ")
    t = F.regexp_replace(t, r"(?is)<style[^>]*>.*?</style>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"<[^>]*>", " ")
    for ent, ch in HTML_ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def term_log_odds(docs: DataFrame, flag: str, tokens: str = "tokens", min_df: int = 3, alpha: float = 1.0) -> DataFrame:
    """Per term: document frequency in flagged / unflagged documents and the
    smoothed log-odds ratio ln((a + alpha) / (A - a + alpha)) - ln((b + alpha) / (B - b + alpha))."""
    tot = docs.agg(F.sum(F.col(flag).cast("bigint")).alias("A"), F.sum((~F.col(flag)).cast("bigint")).alias("B")).first()
    A, B = tot["A"] or 0, tot["B"] or 0
    per = docs.select(flag, F.explode(F.array_distinct(tokens)).alias("term")).groupBy("term").agg(
        F.sum(F.col(flag).cast("bigint")).alias("a"), F.sum((~F.col(flag)).cast("bigint")).alias("b"))
    per = per.filter(F.col("a") + F.col("b") >= min_df)
    lo = (F.log((F.col("a") + alpha) / (F.lit(A) - F.col("a") + alpha))
          - F.log((F.col("b") + alpha) / (F.lit(B) - F.col("b") + alpha)))
    return per.withColumn("log_odds", lo)


def filter_terms(docs: DataFrame, dictionary: DataFrame, tokens: str = "tokens", key: str = "doc_id") -> DataFrame:
    """Hit report of dictionary terms per document (term join against
    the bounded dictionary) plus a flag; documents without hits are kept
    with zero hits."""
    hits = (
        docs.select(key, F.explode(tokens).alias("term"))
        .join(F.broadcast(dictionary.select("term")), "term")
        .groupBy(key).agg(F.count(F.lit(1)).alias("hits"), F.countDistinct("term").alias("distinct_terms"))
    )
    return docs.select(key).join(hits, key, "left").fillna(0, ["hits", "distinct_terms"]).withColumn(
        "flagged", F.col("hits") > 0)


def decode_ids(docs: DataFrame, vocab: DataFrame, ids: str = "ids", key: str = "doc_id", eos: int | None = None) -> DataFrame:
    """ids back to tokens through the (bounded) vocabulary, in order,
    cut at the first EOS when given."""
    ex = docs.select(key, F.posexplode(ids).alias("pos", "id"))
    if eos is not None:
        first_eos = ex.filter(F.col("id") == eos).groupBy(key).agg(F.min("pos").alias("_cut"))
        ex = ex.join(first_eos, key, "left").filter(F.col("_cut").isNull() | (F.col("pos") < F.col("_cut")))
    j = ex.join(F.broadcast(vocab.select("id", "token")), "id", "left")
    g = j.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("_t"))
    return docs.select(key).join(g.select(key, F.col("_t.token").alias("tokens")), key, "left").select(
        key, F.coalesce(F.col("tokens"), F.array().cast("array<string>")).alias("tokens"))


def seq2seq_batch(enc_ids: F.Column, dec_ids: F.Column, enc_len: int, dec_len: int,
                  pad: int = 0, go: int = 1):
    """encoder input = ids right-padded to enc_len, then reversed;
    decoder input = GO + ids right-padded to dec_len; target weight 1 except
    where the next decoder token is PAD (and at the last step)."""
    enc = F.reverse(F.concat(enc_ids, F.array_repeat(F.lit(pad), F.greatest(F.lit(enc_len) - F.size(enc_ids), F.lit(0)))))
    d = F.concat(F.array(F.lit(go)), dec_ids)
    dec = F.concat(d, F.array_repeat(F.lit(pad), F.greatest(F.lit(dec_len) - F.size(d), F.lit(0))))
    weights = F.transform(dec, lambda x, i: F.when(
        (i < dec_len - 1) & (F.element_at(dec, i + 2) != pad), F.lit(1.0)).otherwise(F.lit(0.0)))
    return enc, dec, weights


def glove_cells(cooc: DataFrame, x_max: float = 100.0, power: float = 0.75) -> DataFrame:
    """GloVe inputs for cells with X > 0: weight f(X) = min(1, (X/x_max)^power)
    and target ln X (X = the 1/d-weighted co-occurrence)."""
    return cooc.filter(F.col("weight") > 0).select(
        "w1", "w2", F.col("weight").alias("x"),
        F.least(F.lit(1.0), F.pow(F.col("weight") / x_max, F.lit(power))).alias("f"),
        F.log("weight").alias("target"))


def jaccard(a: F.Column, b: F.Column) -> F.Column:
    """U4: |A n B| / |A u B| of two token sets (null for two empty sets)."""
    u = F.size(F.array_union(F.array_distinct(a), F.array_distinct(b)))
    return F.when(u > 0, F.size(F.array_intersect(a, b)) / u)


def nsp_pairs(sents: DataFrame, seed: int = 5, key: str = "doc_id") -> DataFrame:
    """for every sentence that has a successor: with probability 1/2
    (md5) the true next sentence (is_next = 1), otherwise a sentence of
    another document (is_next = 0).

    All sentences get dense positions in (document, sentence) order, so a
    document is one run of positions; a negative is a hash draw among the
    positions outside that run, each equally likely.  Pairs then meet in one
    equi-join on the position.  Without a second document there are no
    negatives.  sents: (doc_id, sent_pos, sentence), positions 1..n."""
    at = global_positions(sents.select(key, "sent_pos", "sentence"), [key, "sent_pos"], pos="_at")
    total = at.count()
    size = at.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col("sent_pos").cast("string")))
    base = at.join(size, key).filter(F.col("sent_pos") < F.col("_n")).withColumn("_h", h)
    coin = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") < F.lit(1 << 31)
    others = F.nullif(F.lit(total) - F.col("_n"), F.lit(0))
    draw = F.pmod(F.conv(F.substring("_h", 9, 15), 16, 10).cast("bigint"), others)
    start = F.col("_at") - F.col("sent_pos") + 1
    base = base.withColumn("is_next", coin.cast("int")).withColumn("_draw", draw)
    partner = F.when(F.col("is_next") == 1, F.col("_at") + 1).when(F.col("_draw") < start, F.col("_draw")).otherwise(
        F.col("_draw") + F.col("_n"))
    second = at.select(F.col("_at").alias("_p"), F.col("sentence").alias("b"))
    return base.withColumn("_p", partner).join(second, "_p").select(
        key, "sent_pos", F.col("sentence").alias("a"), "b", "is_next")


def wordpiece_vocab(docs: DataFrame, n_words: int, n_pieces: int, tokens: str = "tokens") -> DataFrame:
    """A bounded sub-word vocabulary from the corpus: the n_words most
    frequent words, every single character (initial and '##'), and the
    n_pieces most frequent continuation pieces of 2-4 characters."""
    words = written(token_counts(docs, tokens))  # read five times
    top = words.orderBy(F.col("count").desc(), "token").limit(n_words).select(F.col("token").alias("piece"))
    chars = words.select(F.explode(F.array_remove(F.split("token", ""), "")).alias("c")).distinct()
    singles = chars.select(F.col("c").alias("piece")).unionByName(chars.select(F.concat(F.lit("##"), "c").alias("piece")))
    subs = []
    for n in (2, 3, 4):
        g = words.select("count", F.explode(ngram_structs(F.array_remove(F.split("token", ""), ""), n)).alias("g"))
        subs.append(g.select(
            F.concat(F.lit("##"), F.concat_ws("", *[F.col(f"g.g{i}") for i in range(n)])).alias("piece"), "count"))
    allsub = subs[0].unionByName(subs[1]).unionByName(subs[2]).groupBy("piece").agg(F.sum("count").alias("count"))
    topsub = allsub.orderBy(F.col("count").desc(), "piece").limit(n_pieces).select("piece")
    return top.unionByName(singles).unionByName(topsub).distinct()


def wordpiece(docs: DataFrame, vocab_pieces: list[str], tokens: str = "tokens", key: str = "doc_id") -> DataFrame:
    """the pieces of every occurrence: (token, key, pos, pieces).

    Rows are cut where they are, `CUT` tokens at a time, each distinct word of those once; neither the occurrences nor the
    words are shuffled or sent to other tasks, only the bounded vocabulary is."""
    from tidemark.functions.wordpiece import PieceTrie

    kind = docs.schema[key].dataType.simpleString()

    def cut(batches):
        trie = PieceTrie(vocab_pieces)
        for b in batches:
            size = pc.fill_null(pc.list_value_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)
            lo = 0
            while lo < len(size):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CUT, "right")))
                n = size[lo:hi]
                words = b.column(1).slice(lo, hi - lo).flatten().dictionary_encode()
                row = np.repeat(np.arange(lo, hi), n)
                pos = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                pieces = pa.array([trie.split(w) for w in words.dictionary.to_pylist()], pa.list_(pa.string()))
                rows = pa.RecordBatch.from_arrays([words.dictionary.take(words.indices), b.column(0).take(pa.array(row)), pa.array(pos, pa.int32()),
                                                   pieces.take(words.indices)], names=["token", key, "pos", "pieces"])
                yield rows.filter(pc.is_valid(rows.column(0)))
                lo = hi

    return docs.select(key, tokens).mapInArrow(cut, f"token string, `{key}` {kind}, pos int, pieces array<string>")
