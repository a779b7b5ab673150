"""Personal data by weak supervision, in DataFrame functions only.

Base spans (e-mail, IP, card, phone) are the leftmost matches of fixed patterns that pass fixed checks; they
always stay. Further candidates are keys and passwords, national ids and local phone numbers. Regex, gazetteer
and context labelers vote on every candidate; expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is; a logistic classifier over a span's kind, length, digits and context
is fitted to the posteriors, and candidates that it gives ``ACCEPT`` or more are added.

The vote patterns and feature patterns that reach the driver are counts in bounded tables: KINDS x 3^labelers
and KINDS x the feature buckets, whatever the corpus. All documents are counted. The fitted classifier is a
Column, so spans are found and judged in the row of their document, without a join.

Spans count code points, end exclusive. Null and empty texts have no spans; spans of different kinds may
overlap, added ones overlap no base span; repeated rows are judged alike; an empty table gives no rows, and nothing
is added where there is nothing to learn from; reruns agree. Long texts are searched whole. Other columns pass
through; those named like an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm._frames import aside

BASE = ("email", "ip", "card", "phone")
ADDED = ("local_phone", "national_id", "secret")
KINDS = BASE + ADDED
ACCEPT, ROUNDS = 0.5, 50
CONTEXT = 32
#: Elements that an array grows by at the most, and code points of a piece of a text.
WIDTH, PIECE = 64, 1000

# The base patterns. Possessive quantifiers and look-behinds change no match: they stop Java from backtracking
# into a run, or from starting again within one that has failed.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text with a valid match holds; others are not searched.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
SHAPES = {
    "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "local_phone": r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
    "secret": r"(?<![0-9A-Za-z_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[0-9A-Za-z_-]{16,}+",
}
# Common top-level domains, calling codes, cue words for personal data, and words before plain numbers.
DOMAINS = "com org net edu gov io co uk de fr es it eu us ca info biz example".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 98".split()
CUES = "mail|contact|phone|tel|call|mobile|fax|card|visa|ssn|social|passport|token|key|secret|password|passwd|pwd|auth|login|user"
PLAIN = "version|section|chapter|isbn|issue|page|fig|table|doi|commit|build"
#: What a labeler says of a span: for, against, or nothing.
LABELERS = ("pattern", "gazetteer", "cue", "plain", "digits")
FEATURES = ("kind", "size", "share", "near")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is then computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scanned(items: Column, out: str, step: Callable[[Column, Column], tuple[Column, Column]], shift: Callable[[Column, Column], Column], join: Callable[[Column, Column], Column]) -> Column:
    """A running figure over an array of any length, and what step makes of it and of each item, as an array of type ``out``.

    An array that grows by one element at a time is copied each time, so only short ones grow: runs of WIDTH items are scanned by
    themselves from 0, then runs of runs, then those; shift adds to an element what comes before its run."""

    def level(array: Column, kind: str, one: Callable[[Column, Column], tuple[Column, Column]], body: Callable[[Column], Column]) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))

        def run(a: Column, k: Column) -> Column:
            own = F.transform(F.sequence(k * WIDTH, F.least(k * WIDTH + WIDTH, F.size(a)) - 1), lambda i: F.get(a, i))

            def add(acc: Column, item: Column) -> Column:
                at, made = one(acc["at"], item)
                return F.struct(at.alias("at"), F.concat(acc["out"], F.array(made)).alias("out"))

            return F.aggregate(own, zero, add)

        runs = lambda a: F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / WIDTH).cast("int")), lambda k: run(a, k))
        return _let(array, lambda a: _let(runs(a), body))

    lift = lambda inner: lambda at, r: (join(at, r["at"]), F.transform(r["out"], inner(at)))
    one_deep = lambda at: lambda o: shift(at, o)
    two_deep = lambda at: lambda os: F.transform(os, one_deep(at))
    last = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<array<{out}>>>").alias("out"))

    def top(runs: Column) -> Column:
        def add(acc: Column, r: Column) -> Column:
            at, made = lift(two_deep)(acc["at"], r)
            return F.struct(at.alias("at"), F.concat(acc["out"], F.array(made)).alias("out"))

        return F.flatten(F.flatten(F.aggregate(runs, last, add)["out"]))

    some = lambda a: level(a, out, step, lambda runs: level(runs, f"array<{out}>", lift(one_deep), top))
    return _let(items, lambda a: F.when(F.size(a) > 0, some(a)).otherwise(F.array().cast(f"array<{out}>")))


SPAN = "struct<kind:string,s:int,e:int,x:string>"


def _spans(kind: str, pattern: str, text: Column, hint: Column) -> Column:
    """Matches with their places. Parts between matches and matches alternate, so their lengths give the places."""
    matches, parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def step(at: Column, pair: Column) -> tuple[Column, Column]:
        s = at + F.length(pair["p"])
        e = s + F.length(pair["m"])
        return e, F.struct(F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"), pair["m"].alias("x"))

    def shift(at: Column, o: Column) -> Column:
        return F.struct(o["kind"].alias("kind"), (o["s"] + at).alias("s"), (o["e"] + at).alias("e"), o["x"].alias("x"))

    # parts has one more element than matches; the last pair has no match
    pairs = F.filter(F.zip_with(parts, matches, lambda p, m: F.struct(p.alias("p"), m.alias("m"))), lambda z: z["m"].isNotNull())
    return F.when(hint, _scanned(pairs, SPAN, step, shift, lambda a, b: a + b)).otherwise(F.array().cast(f"array<{SPAN}>"))


def _pieces(text: Column) -> Column:
    """The text in pieces of PIECE code points, from which any stretch is cut without a walk from the text's start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """Code points start to end - 1 of the text whose pieces are given."""
    first, last = F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
    part = lambda k: F.substring(F.get(pieces, k), F.greatest(F.lit(0), start - k * PIECE) + 1, F.least(F.lit(PIECE), end - k * PIECE) - F.greatest(F.lit(0), start - k * PIECE))
    return F.when(end > start, F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise(F.lit(""))


def _overlaps(base: Column, c: Column) -> Column:
    """Whether c overlaps one of base's spans, which are in order and apart: only the last that begins before c's end can, and halving
    the array finds it."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(base) + 1.0)).cast("int"))

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        before = (acc["lo"] < acc["hi"]) & (F.get(base, mid)["s"] < c["e"])
        return F.struct(F.when(before, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(before | (acc["lo"] >= acc["hi"]), acc["hi"]).otherwise(mid).alias("hi"))

    found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(base).alias("hi")), halve, lambda acc: acc["lo"])
    return (F.size(base) > 0) & F.coalesce(F.get(base, found - 1)["e"] > c["s"], F.lit(False))


def _luhn(match: Column) -> Column:
    digits = F.split(F.reverse(F.regexp_replace(match, "[^0-9]", "")), "")
    digits = F.filter(digits, lambda d: d != "")
    doubled = F.transform(digits, lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(F.regexp_replace(x, "[^0-9]", "")).between(13, 19) & _luhn(x)
    if kind == "phone":
        return F.length(F.regexp_replace(x, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _candidates(documents: DataFrame) -> DataFrame:
    """documents with __tg_t (the text), __tg_base and __tg_more: arrays of (kind, s, e, x)."""
    text = F.col("__tg_t")
    out = documents.withColumn("__tg_t", F.coalesce("text", F.lit("")))
    has = {k: text.contains(h) if k == "email" else text.rlike(h) for k, h in HINTS.items()}
    checked = lambda k: F.filter(_spans(k, PATTERNS[k], text, has[k]), lambda z: _valid(k, z["x"]))
    out = out.withColumns({f"__tg_{k}": checked(k) for k in BASE})
    digits = text.rlike("[0-9]")
    out = out.withColumns({f"__tg_{k}": _spans(k, SHAPES[k], text, digits) for k in ADDED})
    by_kind = F.struct(*(F.col(f"__tg_{k}").alias(k) for k in BASE))
    more = _let(by_kind, lambda b: F.filter(F.concat(*(F.col(f"__tg_{k}") for k in ADDED)), lambda c: ~any_of([_overlaps(b[k], c) for k in BASE])))
    return out.withColumns({"__tg_base": F.concat(*(F.col(f"__tg_{k}") for k in BASE)), "__tg_more": more})


def any_of(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _votes(kind: Column, x: Column, before: Column) -> dict[str, Column]:
    """-1, 0 or 1 of each labeler."""
    n_digits = F.regexp_count(x, F.lit("[0-9]"))
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    strong = kind.isin(*BASE) | (kind == "national_id") | ((kind == "secret") & (x.rlike("^[0-9a-f]{32,}$") | x.rlike("^[A-Z]{4}[0-9A-Z]{16}$")))
    listed = (
        F.when(kind == "email", F.lower(F.substring_index(x, ".", -1)).isin(DOMAINS))
        .when(kind == "phone", F.regexp_extract(x, r"^\+([0-9]{1,2})", 1).isin(CALLING_CODES) | F.substring(x, 2, 1).isin(CALLING_CODES))
        .when(kind == "card", F.substring(x, 1, 1).isin("2", "3", "4", "5", "6"))
        .when(kind == "secret", x.rlike("^(?:AKIA|ASIA|ghp_|xox|sk-)"))
        .otherwise(F.lit(False))
    )
    share = n_digits / F.length(x)
    return {
        "pattern": F.when(strong, yes).otherwise(none),
        "gazetteer": F.when(listed, yes).otherwise(none),
        "cue": F.when(before.rlike(f"(?i)(?:{CUES})"), yes).otherwise(none),
        "plain": F.when(before.rlike(rf"(?i)\b(?:{PLAIN})\W*$"), no).otherwise(none),
        "digits": F.when((kind == "secret") & (n_digits <= 2), no).when((kind == "secret") & share.between(0.15, 0.85), yes).otherwise(none),
    }


def _features(kind: Column, x: Column, before: Column) -> dict[str, Column]:
    share = F.regexp_count(x, F.lit("[0-9]")) / F.length(x)
    return {
        "kind": kind,
        "size": F.least(F.lit(4), F.floor(F.log2(F.length(x).cast("double")) - 2)).cast("int"),
        "share": F.floor(share * 3.999).cast("int"),
        "near": F.when(before.rlike(f"(?i)(?:{CUES})"), 1).when(before.rlike(rf"(?i)\b(?:{PLAIN})\W*$"), 2).otherwise(0),
    }


def _before(pieces: Column, span: Column) -> Column:
    return _cut(pieces, F.greatest(F.lit(0), span["s"] - CONTEXT), span["s"])


def estimate_reliabilities(patterns: list[tuple[str, tuple[int, ...], int]]) -> dict[tuple[str, tuple[int, ...]], float]:
    """The posterior of each (kind, votes), by expectation-maximisation: each kind has its prior, each labeler the
    chance of each vote for either truth; a vote's chance starts in favour of what it says."""
    vote = (-1, 0, 1)
    prior = dict.fromkeys(KINDS, 0.5)
    chance = [{True: {-1: 0.1, 0: 0.4, 1: 0.5}, False: {-1: 0.3, 0: 0.6, 1: 0.1}} for _ in LABELERS]
    post: dict[tuple[str, tuple[int, ...]], float] = {}
    for _ in range(ROUNDS):
        for kind, votes, _n in patterns:
            like = {y: math.prod(chance[j][y][v] for j, v in enumerate(votes)) * (prior[kind] if y else 1 - prior[kind]) for y in (True, False)}
            post[kind, votes] = like[True] / (like[True] + like[False])
        for kind in KINDS:
            n = sum(c for k, _, c in patterns if k == kind)
            prior[kind] = (1 + sum(c * post[k, v] for k, v, c in patterns if k == kind)) / (2 + n)
        for j in range(len(LABELERS)):
            for y in (True, False):
                weight = {v: 1.0 for v in vote}
                for kind, votes, n in patterns:
                    p = post[kind, votes]
                    weight[votes[j]] += n * (p if y else 1 - p)
                total = sum(weight.values())
                chance[j][y] = {v: w / total for v, w in weight.items()}
    return post


def fit_classifier(rows: list[tuple[tuple, float, float]]) -> dict[tuple[str, object], float]:
    """Weights of a logistic model over FEATURES' values, by gradient ascent on (values, positive mass, all mass)."""
    weights: dict[tuple[str, object], float] = {}
    total = sum(n for _, _, n in rows) or 1.0
    for step in range(400):
        slope: dict[tuple[str, object], float] = {}
        mass: dict[tuple[str, object], float] = {}
        for values, positive, n in rows:
            keys = list(zip(FEATURES, values, strict=True))
            p = 1 / (1 + math.exp(-sum(weights.get(k, 0.0) for k in keys)))
            for k in keys:
                slope[k] = slope.get(k, 0.0) + positive - n * p
                mass[k] = mass.get(k, 0.0) + n
        for k, g in slope.items():  # scaled by the feature's own mass, with a small ridge
            weights[k] = weights.get(k, 0.0) + 2.0 * (g / mass[k] - 1e-3 * weights.get(k, 0.0)) / (1 + step / 100)
    return weights if total else {}


def learn_spans(documents: DataFrame) -> dict[tuple[str, object], float]:
    """The span classifier's weights, from every candidate of documents. Only bounded tables of counts are collected."""
    every = F.concat("__tg_base", "__tg_more")
    near = lambda p: F.transform(every, lambda c: F.struct(c["kind"].alias("kind"), c["x"].alias("x"), _before(p, c).alias("before")))
    found = _candidates(documents.select("text")).select(F.inline(F.when(F.size(every) > 0, _let(_pieces(F.col("__tg_t")), near))))
    votes, features = (f(F.col("kind"), F.col("x"), F.col("before")) for f in (_votes, _features))
    counts = found.select(*(v.alias(f"v_{k}") for k, v in votes.items()), *(f.alias(k) for k, f in features.items())).groupBy(*(f"v_{k}" for k in votes), *features).count().collect()
    counts.sort(key=str)  # sums of floating-point numbers don't depend on the order of tasks
    by_votes: dict[tuple[str, tuple[int, ...]], int] = {}
    for r in counts:
        key = (r["kind"], tuple(r[f"v_{k}"] for k in LABELERS))
        by_votes[key] = by_votes.get(key, 0) + r["count"]
    post = estimate_reliabilities([(k, v, n) for (k, v), n in by_votes.items()])
    by_features: dict[tuple, list[float]] = {}
    for r in counts:
        had = by_features.setdefault(tuple(r[f] for f in FEATURES), [0.0, 0.0])
        had[0] += r["count"] * post[r["kind"], tuple(r[f"v_{k}"] for k in LABELERS)]
        had[1] += r["count"]
    return fit_classifier([(k, p, n) for k, (p, n) in by_features.items()])


def _accepted(weights: dict[tuple[str, object], float], kind: Column, x: Column, before: Column) -> Column:
    """Whether the classifier gives a span ACCEPT or more; a span of values never seen is not added."""
    if not weights:
        return F.lit(False)
    total: Column = F.lit(0.0)
    for name, value in _features(kind, x, before).items():
        own = [(v, w) for (n, v), w in weights.items() if n == name]
        case = F.when(F.lit(False), 0.0)
        for v, w in own:
            case = case.when(value == F.lit(v), F.lit(w))
        total = total + case.otherwise(F.lit(-100.0))
    return total >= math.log(ACCEPT / (1 - ACCEPT))


def find_spans(documents: DataFrame, weights: dict[tuple[str, object], float]) -> DataFrame:
    """documents with base_spans and spans: arrays of (kind, s, e), by kind, then start."""
    kept = [c for c in documents.columns if c.lower() not in ("base_spans", "spans")]
    found = _candidates(documents.select(*(F.col(f"`{c}`") for c in kept)))
    judged = _let(_pieces(F.col("__tg_t")), lambda p: F.filter("__tg_more", lambda c: _let(_before(p, c), lambda before: _accepted(weights, c["kind"], c["x"], before))))
    added = F.when(F.size("__tg_more") > 0, judged).otherwise(F.col("__tg_more"))
    slim = lambda spans: F.transform(spans, lambda c: F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e")))
    return found.select(*(F.col(f"`{c}`") for c in kept), slim(F.col("__tg_base")).alias("base_spans"), slim(F.concat(F.col("__tg_base"), added)).alias("spans"))


def listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["s"].cast("string"), c["e"].cast("string"))), ",")


def mask_spans(documents: DataFrame, weights: dict[tuple[str, object], float] | None = None) -> DataFrame:
    """documents, in their own columns, with each span of text replaced by its kind in brackets; n_chars follows."""
    moved, own = aside(documents, ["base_spans", "spans"])
    found = find_spans(moved, learn_spans(documents) if weights is None else weights)
    text = F.col("text")
    ordered = F.array_sort(F.transform("spans", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["kind"].alias("kind"))))
    # before: the greatest end of the spans that come first; a span that begins before it is in one that is masked already
    kind = "struct<s:int,e:int,kind:string,before:int>"
    step = lambda at, c: (F.greatest(at, c["e"]), F.struct(c["s"].alias("s"), c["e"].alias("e"), c["kind"].alias("kind"), at.alias("before")))
    shift = lambda at, o: F.struct(o["s"].alias("s"), o["e"].alias("e"), o["kind"].alias("kind"), F.greatest(at, o["before"]).alias("before"))
    placed = _scanned(ordered, kind, step, shift, F.greatest)
    masks = lambda p: F.transform(F.filter(placed, lambda c: c["s"] >= c["before"]), lambda c: F.concat(_cut(p, c["before"], c["s"]), F.lit("["), F.upper(c["kind"]), F.lit("]")))
    rest = lambda p: _cut(p, F.array_max(F.transform("spans", lambda c: c["e"])), F.length(text))
    masked = _let(_pieces(text), lambda p: F.concat(F.array_join(masks(p), ""), rest(p)))
    out = found.withColumn("text", F.when(F.size("spans") > 0, masked).otherwise(text))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(documents.schema["n_chars"].dataType))
    return out.select(*own)
