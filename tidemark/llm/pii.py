"""Personal data by weak supervision, with DataFrame functions only.

Patterns propose spans.  Labelers - strict format, gazetteer, context before the span, variety of characters, and
the characters around it - vote for, against, or abstain.  Expectation-maximisation over the counts of vote
patterns (at most kinds x 3^labelers rows, whatever the corpus) estimates each labeler's reliability and each
kind's share of true spans; with these posteriors as soft labels a naive Bayes classifier over votes and span
features is trained, which decides on proposed spans.  Spans that the base rules give always stay; proposed
spans that score at least `THRESHOLD` join them, also where they overlap.

Cases: null text counts as empty; repeated rows are documents of their own; an empty table gives no rows and a
classifier that nothing changes; other columns are ignored, or kept by `redacted`.  Patterns run in linear time
on long runs of one kind of character.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import read, saved, text_of

BASE = ("email", "ip", "card", "phone")
#: The base patterns match what these do: e-mail [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, address
#: [0-9]+(\.[0-9]+){3}, card [0-9]([ -]?[0-9])+, phone \+[0-9][ ().0-9-]+[0-9].  Possessive repeats and the look-behinds
#: (a match can only begin at the head of a run, or where the last match ended) keep long runs linear.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_text": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:(?:\x20?(?:\(dot\)|\[dot\])\x20?|\.)[A-Za-z0-9-]++)++",
    "phone_local": r"(?<![0-9+.-])(?<![0-9]\x20)(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])",
    "id_number": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?i:\b(?:password|passwd|pwd|token|api[_-]?key|secret)\b\x20?[=:]\x20?[\"']?[^\x20\x09-\x0D\"']{8,}+)|\bAKIA[0-9A-Z]{16}\b",
}
KINDS = tuple(PATTERNS)
#: A text without such a mark holds no span of the kind.
NEEDS = {
    "email": lambda t: t.contains("@"), "ip": lambda t: t.rlike("[0-9]"), "card": lambda t: t.rlike("[0-9]"), "phone": lambda t: t.contains("+"),
    "email_text": lambda t: t.rlike(r"(?i)[(\[]at[)\]]"), "phone_local": lambda t: t.rlike("[0-9]{3}[.-][0-9]{4}"),
    "id_number": lambda t: t.rlike("[0-9]-[0-9]{2}-[0-9]"), "secret": lambda t: t.rlike(r"(?i)AKIA|password|passwd|pwd|token|api[_-]?key|secret"),
}
#: Gazetteers: usual ends of hosts, card issuers' first digits, words that keys begin with.
HOST_ENDS = r"(?i)[.\])\x20](?:com|org|net|edu|gov|info|io|eu|de|fr|es|uk|us|ch|at)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
SECRET_WORDS = r"(?i)^(?:password|passwd|token|secret|api[_-]?key|AKIA)"
#: Words that announce a span, in the corpus languages.
CONTEXT = {
    "email": r"(?i)e-?mail|contact|write to|correo|kontakt|courriel", "email_text": r"(?i)e-?mail|contact|write to|correo|kontakt|courriel",
    "ip": r"(?i)\bip\b|address|host|server|login|adresse", "card": r"(?i)card|visa|pay|karte|carte|tarjeta",
    "phone": r"(?i)tel|phone|call|fax|mobil|llam|appel", "phone_local": r"(?i)tel|phone|call|fax|mobil|llam|appel",
    "id_number": r"(?i)ssn|social|\bid\b|number|nummer", "secret": r"(?i)login|user|key|credential|export|config",
}
LABELERS = ("format", "gazetteer", "context", "variety", "edges")
#: Matches whose places are gathered at a time, and code points of a piece of text.
PART, PIECE = 256, 4096
ROUNDS = 6
THRESHOLD = 0.5


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(v: Column) -> Column:
    """Whether 12 to 19 digits pass the check sum; false for other lengths."""
    back = F.reverse(digits(v))
    one = lambda i: F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
    total = F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), lambda a, i: a + one(i) - F.when(one(i) > 9, 9).otherwise(0))
    return F.when(F.length(back).between(12, 19), total % 10 == 0).otherwise(False)


def valid(kind: str, v: Column) -> Column:
    """Whether a match of a base kind is a base span."""
    if kind == "ip":
        return v.rlike(r"^(?:0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}")
    if kind == "card":
        return luhn(v)
    if kind == "phone":
        return F.length(digits(v)).between(9, 15)
    return F.lit(True)


def votes(kind: str, v: Column, before: Column, after: Column) -> list[Column]:
    """+1, -1 or 0 of each labeler."""
    vote = lambda yes, no=None: F.when(yes, 1).when(~yes if no is None else no, -1).otherwise(0)
    n = F.length(digits(v))
    form = {"email": v.rlike(r"\.[A-Za-z]{2,24}$"), "email_text": v.rlike(r"[A-Za-z]{2,24}$"), "secret": v.rlike(r"AKIA|[=:]\x20?[\"']?[A-Za-z0-9+/_.-]{12,}={0,2}$")}.get(kind)
    form = vote(valid(kind, v) if form is None else form) if kind in BASE or form is not None else vote(n >= 9)
    known = {
        "email": vote(v.rlike(HOST_ENDS), F.lit(False)), "email_text": vote(v.rlike(HOST_ENDS), F.lit(False)), "card": vote(digits(v).rlike(ISSUERS)),
        "ip": vote(v.rlike(r"^(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\."), v.rlike(r"^0")), "phone": vote(v.rlike(r"^\+[1-9]")),
        "phone_local": vote(digits(v).rlike("^[2-9][0-9]{2}[2-9]")), "id_number": vote(~v.rlike("^(?:000|666|9)")), "secret": vote(v.rlike(SECRET_WORDS), F.lit(False)),
    }[kind]
    told = vote(before.rlike(CONTEXT[kind]), F.lit(False))
    varied = vote(F.size(F.array_distinct(F.split(v, ""))) >= F.least(F.lit(6), F.length(v) / 2))
    edges = vote(~(before.rlike(r"[\p{L}0-9_=/.-]$") | after.rlike(r"^[\p{L}0-9_/-]")))
    return [form, known, told, varied, edges]


def _cut(x: Column, at: Column) -> Column:
    """Part number `at` of an array cut into parts of `PART`."""
    return F.slice(x, at * PART + 1, F.lit(PART))


def _places(m: Column, g: Column) -> Column:
    """Array of (s, e) of the matches m between the gaps g.

    Arrays grow by copies, so places are gathered for `PART` matches at a time and the parts are joined at the end.
    """
    none = F.array().cast("array<struct<s:int,e:int>>")

    def step(a, x):
        s = a["at"] + F.length(x["g"])
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(a["out"], F.array(F.struct(s.alias("s"), e.alias("e")))).alias("out"))

    def part(a, x):
        found = F.aggregate(F.arrays_zip(x["m"].alias("m"), x["g"].alias("g")), F.struct(a["at"].alias("at"), none.alias("out")), step)
        return F.struct(found["at"].alias("at"), F.concat(a["out"], F.array(found["out"])).alias("out"))

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / PART).cast("int")), lambda i: F.struct(_cut(m, i).alias("m"), F.slice(g, i * PART + 1, F.size(_cut(m, i))).alias("g")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<s:int,e:int>>>").alias("out"))
    return F.when(F.size(m) > 0, F.flatten(F.aggregate(parts, start, part, lambda a: a["out"])))


def _described(k: str):
    """The lambda that makes a span of kind k of a place and its number."""
    m, g = F.col(f"_m_{k}"), F.col(f"_g_{k}")

    def span(x, i):
        v, before, after = F.get(m, i), F.right(F.get(g, i), F.lit(24)), F.left(F.get(g, i + 1), F.lit(2))
        return F.struct(F.lit(k).alias("kind"), x["s"].alias("start"), x["e"].alias("end"), (valid(k, v) if k in BASE else F.lit(False)).alias("base"),
                        F.array(*votes(k, v, before, after)).alias("votes"),
                        F.least(F.floor(F.log2(F.length(v).cast("double"))), F.lit(8)).cast("int").alias("long"),
                        F.floor(F.length(digits(v)) * 4 / F.length(v)).cast("int").alias("digits"))

    return span


def with_spans(docs: DataFrame) -> DataFrame:
    """Adds `_spans`: array of (kind, start, end, base, votes, length class, digits class), starts and ends in code
    points, ends exclusive.  A pattern's matches and the gaps between them, taken by the same rule, add up to places."""
    d = docs.withColumn("_t", text_of(docs))
    d = d.withColumns({f"_m_{k}": F.when(NEEDS[k](F.col("_t")), F.regexp_extract_all("_t", F.lit(p), F.lit(0))) for k, p in PATTERNS.items()})
    d = d.withColumns({f"_g_{k}": F.when(F.size(f"_m_{k}") > 0, F.split("_t", p, -1)) for k, p in PATTERNS.items()})
    d = d.withColumns({f"_p_{k}": _places(F.col(f"_m_{k}"), F.col(f"_g_{k}")) for k in KINDS})
    spans = [F.coalesce(F.transform(f"_p_{k}", _described(k)), F.array()) for k in KINDS]
    return d.withColumn("_spans", F.concat(*spans)).drop("_t", *[f"_{x}_{k}" for x in "mgp" for k in KINDS])


def fit(spanned: DataFrame) -> dict:
    """Expectation-maximisation on the counts of vote patterns, then the classifier's tables.

    Only sums over the counted patterns come to the driver, some hundred numbers a round.
    """
    one = spanned.select(F.explode("_spans").alias("x"))
    seen = saved(one.groupBy("x.kind", "x.votes", "x.long", "x.digits").agg(F.count(F.lit(1)).alias("n")))
    labels = [(j, v) for j, v in product(range(len(LABELERS)), (-1, 1))]
    share = dict.fromkeys(KINDS, 0.5)
    odds = {(j, v, y): 0.7 if (v > 0) == y else 0.3 for j, v in labels for y in (True, False)}
    for _ in range(ROUNDS):
        given = seen.withColumn("p", posterior(share, odds))
        named = F.concat(F.array(F.concat(F.lit("k/"), F.col("kind"))), F.transform("votes", lambda v, j: F.concat_ws("/", j.cast("string"), v.cast("string"))))
        sums = given.select(F.explode(named).alias("f"), "n", "p").groupBy("f").agg(F.sum(F.col("n") * F.col("p")).alias("a"), F.sum(F.col("n") * (1 - F.col("p"))).alias("b"))
        got = {r["f"]: (r["a"], r["b"]) for r in sums.collect()}
        none = (0.0, 0.0)
        share = {k: (got.get(f"k/{k}", none)[0] + 1) / (sum(got.get(f"k/{k}", none)) + 2) for k in KINDS}
        for j, y in product(range(len(LABELERS)), (True, False)):
            yes, no = (got.get(f"{j}/{v}", none)[0 if y else 1] for v in (1, -1))
            prior = 7.0 if y else 3.0  # a labeler is taken for better than chance until counts say otherwise
            odds[j, 1, y] = (yes + prior) / (yes + no + 10.0)
            odds[j, -1, y] = 1 - odds[j, 1, y]
    # soft counts of the classifier's features
    given = seen.withColumn("p", posterior(share, odds))
    feats = F.concat(F.transform("votes", lambda v, j: F.concat_ws("/", F.lit("v"), j.cast("string"), v.cast("string"))),
                     F.array(F.concat_ws("/", F.lit("l"), "kind", F.col("long").cast("string")), F.concat_ws("/", F.lit("d"), "kind", F.col("digits").cast("string")), F.concat_ws("/", F.lit("k"), "kind")))
    soft = given.select(F.explode(feats).alias("f"), (F.col("n") * F.col("p")).alias("a"), (F.col("n") * (1 - F.col("p"))).alias("b"))
    table = soft.groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()
    all_ = given.agg(F.sum(F.col("n") * F.col("p")).alias("a"), F.sum(F.col("n") * (1 - F.col("p"))).alias("b")).first()
    a, b = (all_["a"] or 0.0) + 2, (all_["b"] or 0.0) + 2
    weight = {r["f"]: math.log((r["a"] + 1) / a) - math.log((r["b"] + 1) / b) for r in table}
    return {"share": share, "odds": {f"{LABELERS[j]}{v:+d}|{y}": round(p, 4) for (j, v, y), p in odds.items()}, "weight": weight, "bias": math.log(a / b)}


def posterior(share: dict, odds: dict) -> Column:
    z = F.element_at(F.create_map(*[F.lit(x) for k in KINDS for x in (k, math.log(share[k] / (1 - share[k])))]), F.col("kind"))
    for j in range(len(LABELERS)):
        for v in (-1, 1):
            z = z + F.when(F.col("votes")[j] == v, F.lit(math.log(odds[j, v, True] / odds[j, v, False]))).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def chosen(spanned: DataFrame, model: dict) -> DataFrame:
    """Adds `_base` and `_all`: arrays of (start, order, end, kind), sorted."""
    weights = F.create_map(*[F.lit(x) for f, w in model["weight"].items() for x in (f, float(w))]) if model["weight"] else F.create_map().cast("map<string,double>")
    d = spanned.withColumn("_w", F.when(F.size("_spans") > 0, weights))
    order = F.array(*map(F.lit, KINDS))
    flat = lambda x: F.struct(x["start"].alias("start"), (F.array_position(order, x["kind"])).alias("order"), x["end"].alias("end"), x["kind"].alias("kind"))

    def score(x):
        feats = F.concat(F.transform(x["votes"], lambda v, j: F.concat_ws("/", F.lit("v"), j.cast("string"), v.cast("string"))),
                         F.array(F.concat_ws("/", F.lit("l"), x["kind"], x["long"].cast("string")), F.concat_ws("/", F.lit("d"), x["kind"], x["digits"].cast("string")), F.concat_ws("/", F.lit("k"), x["kind"])))
        z = F.aggregate(feats, F.lit(float(model["bias"])), lambda a, f: a + F.coalesce(F.element_at("_w", f), F.lit(0.0)))
        return 1 / (1 + F.exp(-z))

    d = d.withColumn("_base", F.array_sort(F.transform(F.filter("_spans", lambda x: x["base"]), flat)))
    more = F.filter("_spans", lambda x: (~x["kind"].isin(*BASE)) & (score(x) >= THRESHOLD))
    return d.withColumn("_all", F.array_sort(F.concat("_base", F.transform(more, flat)))).drop("_spans", "_w")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, `_base`, `_all` for each document."""
    spanned = saved(with_spans(docs.select("doc_id", "text")).select("doc_id", "_spans"))
    return chosen(spanned, fit(spanned))


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every span that was found replaced by `<kind>`; n_chars follows the new text.  Rows and other
    columns stay.  Of spans that overlap, all characters go: what a span adds to those before it becomes its `<kind>`."""
    model = fit(saved(with_spans(docs.select("doc_id", "text")).select("_spans")))
    d = chosen(with_spans(docs.select(F.struct(*docs.columns).alias("_doc"), "text")), model)

    # a text's code points are counted from its beginning each time, so it is cut into pieces first
    d = d.withColumn("_cut", F.when(F.size("_all") > 0, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))))
    empty = F.array().cast("array<string>")

    def between(start, end):
        def piece(c):
            lo, hi = F.greatest(start - c * PIECE, F.lit(0)), F.least(end - c * PIECE, F.lit(PIECE))
            return F.substring(F.get("_cut", c), lo + 1, hi - lo)

        number = lambda at: F.floor(at / PIECE).cast("int")
        return F.when(end > start, F.array_join(F.transform(F.sequence(number(start), number(end - 1)), piece), "")).otherwise("")

    def step(a, x):
        more = F.array(between(a["at"], x["start"]), F.concat(F.lit("<"), x["kind"], F.lit(">")))
        return F.when(x["end"] > a["at"], F.struct(x["end"].alias("at"), F.concat(a["out"], more).alias("out"))).otherwise(a)

    def part(a, x):
        shown = F.aggregate(x, F.struct(a["at"].alias("at"), empty.alias("out")), step)
        return F.struct(shown["at"].alias("at"), F.concat(a["out"], F.array(F.array_join(shown["out"], ""))).alias("out"))

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("_all") - 1) / PART).cast("int")), lambda i: _cut(F.col("_all"), i))
    done = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("out")), part, lambda a: F.concat(F.array_join(a["out"], ""), between(a["at"], F.length("text"))))
    d = d.withColumn("_new", F.when(F.size("_all") > 0, done).otherwise(F.col("text")))
    return d.select(*[F.col("_new").alias(c) if c == "text" else F.length("_new").cast("long").alias(c) if c == "n_chars" else F.col("_doc")[c].alias(c) for c in docs.columns])


def op6_pii(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans."""
    d = detect(read(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("_base", lambda x: x["kind"] == k)).cast("long")
    return d.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("_all")).alias("spans"))
