"""Secret scans: fixed rules, and two character Markov models compared by
their log-likelihood ratio.  DataFrame functions only.

Base kinds: assign (a credential word, an assignment sign and a value of 8 or
more characters), access (AKIA key ids), hex (32 or more hex digits).  Added
kind markov: a run of 16 or more key characters, with or without digits, whose
log-likelihood ratio (random string against ordinary identifier) exceeds
``EVIDENCE`` in total and ``THRESHOLD`` per character pair, outside the base spans:
a short run needs a higher mean.  Offsets count code points, ends are exclusive.

The models are bigram tables over ASCII.  Labelled samples come from the
corpus: values found by the base rules are random strings, words of texts that
the base rules' matches are cut from are ordinary, as they are and in capitals.  The random model is half
uniform over the key characters, as most values found are hex digits and other
keys are not.  Both samples take distinct texts by a threshold on the text's
hash, so that about ``SECRET_DOCS`` and ``PLAIN_DOCS`` texts are taken however
large the corpus is, and no task orders them; the table has at most 95 x 95 cells.

Null text counts as empty (no spans).  Empty tables give empty results (the
models are then their priors).  Repeated rows give repeated results; other
columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")

ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
KEY_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

#: Distinct texts that the two labelled samples hold, on average over the hash.
SECRET_DOCS, PLAIN_DOCS = 5000, 1000
#: Log-likelihood ratio above which a run is a secret: mean per character pair, total.
THRESHOLD, EVIDENCE = 0.5, 12.0
#: Share of the uniform distribution in the random-string model; weight of the
#: uniform prior of the ordinary one.
UNIFORM, PLAIN_PRIOR = 0.5, 4.0


def _located(text: Column, regex: str, keep=None) -> Column:
    """Array of (start, end, value): the leftmost non-overlapping matches of
    ``regex``.  The pieces between matches and the matches themselves
    alternate, so their lengths add up to the positions.  ``keep`` tests a
    match's value."""
    hits = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    gaps = F.split(text, regex, -1)
    parts = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits,
                       lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit")))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(acc, p):
        s = acc["at"] + p["gap"]
        e = s + F.length(p["hit"])
        more = F.concat(acc["found"], F.array(F.struct(s.alias("start"), e.alias("end"), p["hit"].alias("value"))))
        # only kept matches are gathered: the array is copied at each
        found = F.when(keep(p["hit"]), more).otherwise(acc["found"]) if keep else more
        return F.struct(e.alias("at"), found.alias("found"))

    return F.aggregate(parts, start, step, lambda acc: acc["found"])


def _spans(kind: str, found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"),
        F.lit(kind).alias("kind"), s["value"].alias("value")))


_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def _where(cond: Column, spans: Column) -> Column:
    return F.when(cond, spans).otherwise(F.array().cast(_SPAN))


def base_spans(docs: DataFrame, keep=("doc_id",)) -> DataFrame:
    """``keep``, ``__text`` and ``__base``: spans of the base rules by start, then
    kind.  Cheap tests (a literal, an assignment sign) go before each rule."""
    text = F.col("__text")
    # group 2 of the rule: what follows the sign and an optional quote
    long_value = lambda v: F.length(F.regexp_extract(v, ASSIGN, 1)) >= 8
    assign = _where((text.contains("=") | text.contains(":")) & text.rlike(ASSIGN),
                    _spans("assign", _located(text, ASSIGN, long_value)))
    access = _where(text.contains("AKIA"), _spans("access", _located(text, ACCESS)))
    hexes = _where(text.rlike(HEX), _spans("hex", _located(text, HEX)))
    return (docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
            .withColumn("__base", F.array_sort(F.concat(assign, access, hexes))))


def _pairs(tokens: DataFrame) -> DataFrame:
    """Character pairs (a, b) of the column ``token`` with their counts."""
    at = F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("i")
    return (tokens.where(F.length("token") >= 2).select("label", "token", at)
            .select("label", F.ascii(F.substring("token", F.col("i"), F.lit(1))).alias("a"),
                    F.ascii(F.substring("token", F.col("i") + 1, F.lit(1))).alias("b"))
            .groupBy("label", "a", "b").agg(F.count(F.lit(1)).alias("n")))


def _sample(texts: DataFrame, which: Column, kinds: int, n: int) -> DataFrame:
    """The distinct texts with ``which``, of whose ``kinds`` about ``n`` are taken by hash."""
    share = F.shiftrightunsigned("h", 11) < F.lit(int(min(1.0, n / max(kinds, 1)) * 2 ** 53))
    return texts.where(which & share).groupBy("h").agg(F.min("text").alias("text"))


def train(docs: DataFrame, secret_docs: int = SECRET_DOCS, plain_docs: int = PLAIN_DOCS) -> list[float]:
    """The 128 x 128 table of log P(b | a, random) - log P(b | a, ordinary)."""
    text = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = text.withColumn("h", F.xxhash64("text"))
    hit = (F.col("text").rlike(HEX) | F.col("text").contains("AKIA")
           | ((F.col("text").contains("=") | F.col("text").contains(":")) & F.col("text").rlike(ASSIGN)))
    n_hit, n_all = text.agg(F.approx_count_distinct(F.when(hit, F.col("h"))), F.approx_count_distinct("h")).first()
    secret = base_spans(_sample(text, hit, n_hit, secret_docs), ())
    values = F.transform("__base", lambda s: F.when(s["kind"] == "assign", F.regexp_extract(
        s["value"], ASSIGN, 1)).otherwise(s["value"]))
    secret = secret.select(F.lit(1).alias("label"), F.explode(F.array_distinct(values)).alias("token"))
    clean = F.regexp_replace(F.col("text"), f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    words = F.regexp_extract_all(clean, F.lit(r"[A-Za-z0-9+/_=-]{4,}"), F.lit(0))
    words = F.concat(words, F.transform(words, F.upper))  # names in capitals are ordinary too
    plain = _sample(text, F.lit(True), n_all, plain_docs).select(F.lit(0).alias("label"), F.explode(words).alias("token"))
    counts = {(r["label"], r["a"], r["b"]): r["n"] for r in _pairs(secret.unionByName(plain)).collect()}
    rows: dict[tuple[int, int], int] = {}
    for (label, a, _), n in counts.items():
        rows[label, a] = rows.get((label, a), 0) + n
    size = len(KEY_CHARS)
    table = [0.0] * (128 * 128)
    for a in map(ord, KEY_CHARS):
        for b in map(ord, KEY_CHARS):
            seen = rows.get((1, a), 0)
            p = UNIFORM / size + (1 - UNIFORM) * (counts.get((1, a, b), 0) / seen if seen else 1 / size)
            q = (counts.get((0, a, b), 0) + PLAIN_PRIOR / size) / (rows.get((0, a), 0) + PLAIN_PRIOR)
            table[a * 128 + b] = round(math.log(p) - math.log(q), 4)
    return table


def _ratio(token: Column, table: Column) -> Column:
    """Sum over the character pairs of a run, in one pass however long it is."""
    def step(acc, char):
        b = F.ascii(char)
        pair = F.when(acc["a"] >= 0, F.get(table, acc["a"] * 128 + b)).otherwise(0.0)
        return F.struct(b.alias("a"), (acc["sum"] + pair).alias("sum"))
    start = F.struct(F.lit(-1).alias("a"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.split(token, "(?!^)(?!$)"), start, step, lambda acc: acc["sum"])


def scan(docs: DataFrame, table: list[float] | None = None, threshold: float = THRESHOLD,
         evidence: float = EVIDENCE, keep=("doc_id",), name: str = "spans") -> DataFrame:
    """The columns ``keep`` and ``name``: array of (start, rank, end, kind, value)
    by start, then kind as listed in KINDS."""
    if table is None:
        table = train(docs)
    # one literal, parsed once when the plan is optimised
    llr = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")
    text = F.col("__text")
    likely = lambda v: _ratio(v, llr) > F.greatest(F.lit(evidence), threshold * (F.length(v) - 1))
    found = _where(text.rlike(CANDIDATE), _spans("markov", _located(text, CANDIDATE, likely)))
    apart = F.filter("__more", lambda m: ~F.exists(
        "__base", lambda b: (m["start"] < b["end"]) & (b["start"] < m["end"])))
    return (base_spans(docs, keep).withColumn("__more", found)
            .select(*keep, F.array_sort(F.concat(F.col("__base"), apart)).alias(name)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return scanned.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        count("markov").alias("n_markov"))
