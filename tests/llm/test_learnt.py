"""What is learnt and decoded, against plain Python: lattices, evidence, profiles, votes, posteriors and added spans; reruns agree."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import jaccard_join, language_id, mixing, pii, substring_dedup, toxicity
from tidegrid.llm._words import ALNUM, Words

CORPUS = "the stupid idiot said worthless things to a moron and hello to the clown of class tall ball "


def decoder(spark):
    return toxicity.Decoder(toxicity.count_trigrams(spark.createDataFrame([(CORPUS * 20,)], "text string")))


def readings(token, apart, model):
    """The best chance of every string that a token's lattice has, by walking all of its paths."""
    best = {}

    def step(out, letters, chance, a, b):
        for x in letters:
            code = toxicity.symbol(x)
            if code or b:  # boundaries in a row are one
                chance += model.log[a][b][code]
                a, b, out = b, code, out + x
        return out, chance, a, b

    runs = []
    for k, g in groupby(token.lower()):
        n = len(list(g))
        runs += [(k, 1, n)] * n if apart or k in toxicity.MASKS else [(k, n, n)]

    def walk(i, out, chance, a, b):
        if i == len(runs):
            total = chance + (model.log[a][b][0] if b else 0.0)
            best[out] = max(total, best.get(out, -math.inf))
            return
        ch, n, whole = runs[i]
        own = model._options(ch)
        if ch in toxicity.MASKS and whole <= 3 and not apart:
            own = [(x, toxicity.CHANGED) for x in "abcdefghijklmnopqrstuvwxyz"] + own
        if apart and own[-1][0] == "":
            own = [(" ", 0.0)] if ch == "\n" else [*own, (" ", toxicity.SEPARATED)]
        if n > 1:
            one, two = (toxicity.DOUBLE, toxicity.KEPT) if n == 2 else (toxicity.DRAWN, toxicity.DOUBLE)
            own = [(x, c + one) for x, c in own] + [(x + x, c + two) for x, c in own if x]
        for letters, cost in own:
            walk(i + 1, *step(out, letters, chance + cost, a, b))
            if apart and b and letters not in ("", " ") and letters == out[-1]:
                walk(i + 1, out, chance + cost + toxicity.DOUBLE, a, b)

    walk(0, "", 0.0, 0, 0)
    return best


def test_viterbi_finds_the_best_paths(spark):
    own, draw = decoder(spark), random.Random(5)
    tokens = ["1d10t", "s-t-u-p-i-d", "m0r0n", "cl@$$", "b@ll", "stuupid", "t4111", "!d!ot", "h3ll0", "a", "(1a$s", "x", "1l|", "11l|", "cl*wn", "i##ot", "c***n", "m****n", "ïdïot", "сlown", "étá", "a--b"]
    tokens += ["".join(draw.choice("aeilstbd01!$-.4|ïс") for _ in range(draw.randrange(1, 8))) for _ in range(150)]
    for token in tokens:
        for apart in (False, True):
            every = readings(token, apart, own)
            ranked = sorted(every.values(), reverse=True)[: toxicity.BEST]
            near = [c for c in ranked if c >= ranked[0] - toxicity.MARGIN]
            got = own._viterbi(token, apart)
            assert len({w for w, _ in got}) == len(got) and [c for _, c in got] == pytest.approx(near), (token, apart, got)
            assert [every[w] for w, _ in got] == pytest.approx(near), (token, apart, got)


def test_evidence_by_plain_python(spark):
    own = decoder(spark)
    weights = {"idiot": 3.0, "moro": 4.0, "stupi": 2.5, "worthl": 5.0}  # a word, and starts of 4, 5 and 6 bytes
    hashes = {}
    for w in weights:
        words = Words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]), ALNUM, fold=True)
        hashes[w] = words.hashes()[0] if w == "idiot" else words.prefix_hashes(len(w))[1][0]
    order = sorted(weights, key=lambda w: hashes[w])
    model = toxicity.Model(np.array([hashes[w] for w in order], np.uint64), np.array([weights[w] for w in order]), np.zeros(4))
    plain = ["An IDIOT and a moron, morons!", "nothing here at all", "", None, "stupid stupids stupified worthless " * 3, "idiots"]
    for text, got in zip(plain, toxicity.evidence(pa.array(plain), own, model), strict=True):
        words = [w.lower() for w in re.findall(r"[A-Za-z0-9]+", text or "")]
        found = [max((x for k, x in weights.items() if (w == k if k == "idiot" else w.startswith(k))), default=0.0) for w in words]
        n = sum(x > 0 for x in found)
        assert got.tolist() == pytest.approx([1, math.log1p(n), min(10, 100 * n / max(1, len(words))), max(found, default=0.0)])
    # a disguised word counts as the word that it stands for
    a, b = toxicity.evidence(pa.array(["an idiot spoke", "an 1d10t spoke"]), own, model)
    assert a.tolist() == pytest.approx(b.tolist())


def labelled(spark, parts):
    draw, rows = random.Random(11), []
    for i in range(400):
        words = [f"word{draw.randrange(200)}" for _ in range(30)] + (["idiot", "moron"] if i % 4 == 0 else [])
        rows.append((i, " ".join(words) if i % 7 else " ".join(rows[-1][1].split()) if rows else "x", int(i % 4 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return frame.orderBy(F.xxhash64("doc_id", F.lit(parts))).repartition(parts)


def test_toxicity_reruns_agree(spark):
    found = []
    for parts in (1, 3, 5):
        docs = labelled(spark, parts)
        own = toxicity.Decoder(toxicity.count_trigrams(docs))
        model = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), own)
        found.append((model.bias.tolist(), model.features.tolist(), sorted((r["doc_id"], r["score"]) for r in toxicity.score_toxicity(docs, own, model).collect())))
    assert found[0] == found[1] == found[2] and len(found[0][1]) > 0


def test_learning_by_plain_python(spark):
    docs = labelled(spark, 3).where("doc_id % 7 <> 0").cache()  # the others repeat a text
    own = toxicity.Decoder(toxicity.count_trigrams(docs))
    model = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), own)
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("doc_id").cast("string")), F.lit(3))
    rows = docs.select("text", "toxic", fold.alias("fold")).collect()

    def features(text):
        out = set()
        for w in re.findall("[a-z0-9]+", text):
            for seen in {w, *(x for x in toxicity._readings(w.encode(), own) if len(x) >= 3 and re.search(r"\d|(.)\1\1", w))}:
                out |= {(seen, 0), *((seen[:n], n) for n in toxicity.PREFIXES if len(seen) >= n)}
        return out

    bad, good, sizes = Counter(), Counter(), Counter()
    for r in rows:
        if r["fold"] < 2:
            sizes[r["toxic"]] += 1
            (bad if r["toxic"] else good).update(features(r["text"]))
    weights = {f: math.log((n + 0.5) / (sizes[1] + 1)) - math.log((good[f] + 0.5) / (sizes[0] + 1)) for f, n in bad.items() if n >= toxicity.SUPPORT}
    weights = {f: w for f, w in weights.items() if w >= toxicity.WEIGHT}
    hashed = {}
    for (w, n), weight in weights.items():
        words = Words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]), ALNUM, fold=True)
        hashed[int(words.prefix_hashes(n)[1][0] if n else words.hashes()[0])] = weight
    assert {("idiot", 0), ("moron", 0), ("idio", 4)} <= set(weights)
    assert dict(zip(model.features.tolist(), model.weights.tolist(), strict=True)) == pytest.approx(hashed)
    # the fit stands where the slope of the balanced, ridged likelihood is none
    held = [r for r in rows if r["fold"] == 2]
    x = toxicity.evidence(pa.array([r["text"] for r in held]), own, model).tolist()
    n = Counter(r["toxic"] for r in held)
    for k in range(4):
        slope = -1e-4 * model.bias[k]
        for r, own_x in zip(held, x, strict=True):
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(own_x, model.bias, strict=True))))
            slope += 0.5 / n[r["toxic"]] * (r["toxic"] - p) * own_x[k]
        assert abs(slope) < 1e-5


# --- language profiles

LETTER = language_id.EDGE


def grams(text):
    out, low = [], re.sub(" +", " ", "".join(c.lower() if c.isalpha() else " " for c in f" {text or ''} "))
    code = lambda c: int(LETTER) if c == " " else ord(c)
    for n in (1, 2, 3):
        for k in range(len(low) - n + 1):
            g = low[k : k + n]
            if g != " " and not (n == 3 and g[1] == " ") and low.strip():
                out.append(sum(code(c) << (21 * (n - 1 - j)) for j, c in enumerate(g)))
    return out


def ranking(counts, top):
    return sorted(counts, key=lambda g: (-counts[g], g))[:top]


def test_profiles_distances_and_scores(spark):
    texts = [("en", "the cat and the dog of the house"), ("en", "there is the thing that they think"), ("de", "der hund und die katze, das Haus"), ("de", "schön ist es über die Straße"), ("fr", "le chat et le chien de la maison"), (None, "nothing learnt"), ("fr", None)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    learnt = language_id.learn_profiles(docs)
    counts = defaultdict(Counter)
    for lang, t in texts:
        if lang and t:
            counts[lang].update(grams(t))
    profiles = {lang: {g: r for r, g in enumerate(ranking(c, language_id.PROFILE))} for lang, c in counts.items()}
    asked = ["the house of that man", "und der Hund", "la maison", "Ω", "1 2", None, "x"]
    out = language_id.predict_language(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), learnt).collect()
    for r in out:
        own = ranking(Counter(grams(asked[r["doc_id"]])), language_id.TOP)
        if not own:
            assert (r["lang_pred"], r["score"], r["distance"]) == ("und", 0.0, None)
            continue
        far = {lang: sum(abs(p[g] - k) if g in p else language_id.PROFILE for k, g in enumerate(own)) / (language_id.PROFILE * len(own)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        rest = (sum(far.values()) - far[best]) / (len(far) - 1)
        assert r["lang_pred"] == best and r["distance"] == pytest.approx(far[best]) and r["score"] == pytest.approx(min(1, max(0, 1 - far[best] / rest)))


# --- personal data


def person_texts():
    draw, out = random.Random(8), []
    for i in range(160):
        key = "".join(draw.choice("0123456789abcdef") for _ in range(40))
        long_key = "k" * 70 + "7" + "".join(draw.choice("0123456789abcXYZ") for _ in range(20))
        out.append(draw.choice([f"token = {key} and more", f"password {key[:20]}, a{i}@b.org", f"section internationalisation2 of {i}", "call (415) 555-0134 now", f"ssn 123-45-67{i % 90 + 10} given", "version 415-555-0134 of it", f"secret: {long_key}", "plain words only", f"see commit {key}", "Mail me: x@y.com, +49 30 1234567", "build_number_2_of_the_long_identifier"]))
    return out


def candidates(text):
    """(kind, start, end, match, before) of the base spans and of the further candidates that overlap none."""
    digits = lambda x: sum(c.isdigit() for c in x)
    base = []
    for kind, pattern in {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}.items():
        for m in re.finditer(pattern, text):
            luhn = [int(c) * (1 + k % 2) for k, c in enumerate(re.sub("[^0-9]", "", m[0])[::-1])]
            ok = {"email": True, "ip": all(int(p) < 256 for p in m[0].split(".")) if kind == "ip" else True, "card": 13 <= digits(m[0]) <= 19 and sum(d - 9 * (d > 9) for d in luhn) % 10 == 0, "phone": 9 <= digits(m[0]) <= 15}[kind]
            base += [(kind, m.start(), m.end(), m[0])] if ok else []
    more = []
    for kind, pattern in {"local_phone": r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])", "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", "secret": r"(?<![0-9A-Za-z_-])[0-9A-Za-z_-]{16,}"}.items():
        for m in re.finditer(pattern, text):
            if (kind != "secret" or (digits(m[0]) and re.search("[A-Za-z]", m[0]))) and all(m.end() <= s or e <= m.start() for _, s, e, _ in base):
                more.append((kind, m.start(), m.end(), m[0]))
    return [(*c, text[max(0, c[1] - pii.CONTEXT) : c[1]]) for c in base], [(*c, text[max(0, c[1] - pii.CONTEXT) : c[1]]) for c in more]


def votes(kind, x, before):
    n = sum(c.isdigit() for c in x)
    strong = kind in pii.BASE or kind == "national_id" or (kind == "secret" and re.search("^[0-9a-f]{32,}$|^[A-Z]{4}[0-9A-Z]{16}$", x))
    code = re.search(r"^\+([0-9]{1,2})", x)
    listed = {"email": x.rsplit(".", 1)[-1].lower() in pii.DOMAINS, "phone": (code and code[1] in pii.CALLING_CODES) or x[1:2] in pii.CALLING_CODES, "card": x[0] in "23456", "secret": re.search("^(?:AKIA|ASIA|ghp_|xox|sk-)", x)}.get(kind)
    cue, plain = re.search(f"(?i)(?:{pii.CUES})", before), re.search(rf"(?i)\b(?:{pii.PLAIN})\W*$", before)
    by_digits = 0 if kind != "secret" else -1 if n <= 2 else 1 if 0.15 <= n / len(x) <= 0.85 else 0
    return (int(bool(strong)), int(bool(listed)), int(bool(cue)), -int(bool(plain)), by_digits)


def features(kind, x, before):
    share = sum(c.isdigit() for c in x) / len(x)
    near = 1 if re.search(f"(?i)(?:{pii.CUES})", before) else 2 if re.search(rf"(?i)\b(?:{pii.PLAIN})\W*$", before) else 0
    return (kind, min(4, math.floor(math.log2(len(x)) - 2)), math.floor(share * 3.999), near)


def posteriors(every):
    """Expectation-maximisation with arrays: P(y) of each candidate."""
    kinds = np.array([pii.KINDS.index(k) for k, _ in every])
    v = np.array([w for _, w in every]) + 1  # 0, 1, 2 for -1, 0, 1
    prior = np.full(len(pii.KINDS), 0.5)
    chance = np.array([[[0.3, 0.6, 0.1], [0.1, 0.4, 0.5]]] * v.shape[1])  # labeler, truth, vote
    for _ in range(pii.ROUNDS):
        like = np.stack([np.prod([chance[j, y, v[:, j]] for j in range(v.shape[1])], axis=0) * (prior[kinds] if y else 1 - prior[kinds]) for y in (0, 1)])
        p = like[1] / like.sum(0)
        prior = np.array([(1 + p[kinds == k].sum()) / (2 + (kinds == k).sum()) for k in range(len(prior))])
        for j in range(v.shape[1]):
            for y, own in ((0, 1 - p), (1, p)):
                weight = 1 + np.bincount(v[:, j], own, 3)
                chance[j, y] = weight / weight.sum()
    return p


def test_votes_posteriors_and_added_spans(spark):
    texts = person_texts()
    found = [candidates(t) for t in texts]
    every = [c for base, more in found for c in (*base, *more)]
    p = posteriors([(c[0], votes(c[0], c[3], c[4])) for c in every])
    by_votes = Counter((c[0], votes(c[0], c[3], c[4])) for c in every)
    post = pii.estimate_reliabilities([(k, v, n) for (k, v), n in by_votes.items()])
    assert [post[c[0], votes(c[0], c[3], c[4])] for c in every] == pytest.approx(p.tolist(), abs=1e-9)
    mass = {}
    for c, q in zip(every, p, strict=True):
        had = mass.setdefault(features(c[0], c[3], c[4]), [0.0, 0])
        had[0] += q
        had[1] += 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    weights = pii.learn_spans(docs)
    plain = pii.fit_classifier([(k, a, n) for k, (a, n) in sorted(mass.items(), key=str)])
    assert {k: pytest.approx(w, abs=1e-6) for k, w in plain.items()} == weights
    # the fit is that of the penalised likelihood: its slope is nearly level
    for key in plain:
        rows = [(f, a, n) for f, (a, n) in mass.items() if key in zip(pii.FEATURES, f, strict=True)]
        slope = sum(a - n / (1 + math.exp(-sum(plain[k] for k in zip(pii.FEATURES, f, strict=True)))) for f, a, n in rows) / sum(n for _, _, n in rows)
        assert abs(slope - 1e-3 * plain[key]) < 0.02
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find_spans(docs, weights).collect()}
    for i, (base, more) in enumerate(found):
        kept = [c for c in more if sum(plain[k] for k in zip(pii.FEATURES, features(c[0], c[3], c[4]), strict=True)) >= 0]
        assert sorted(got[i]) == sorted(c[:3] for c in (*base, *kept)), texts[i]
    assert any(c[0] == "secret" and len(c[3]) > 80 for _, more in found for c in more)
    assert pii.learn_spans(docs.repartition(1)) == pii.learn_spans(docs.repartition(5)) == weights


# --- repeated ids


def test_rows_of_one_id_are_told_apart(spark):
    rows = [(1, "a b c d e f g"), (1, "q r s t u v w"), (2, "a b c d e f g"), (3, "q r s t u v w x y z"), (None, "a b c d e f g"), (4, None)]
    takes = []
    for parts in (1, 4):
        docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string").repartition(parts)
        takes.append(sorted((str(r["doc_id"]), str(r["text"]), r["taken"], r["position"]) for r in mixing.mix_documents(docs).collect()))
    assert takes[0] == takes[1]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    linked = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicate_groups(docs).collect())
    assert linked == [("1", 5, 1), ("1", 5, 1), ("2", 5, 1), ("3", 8, 3), ("4", 0, 4), ("None", 5, 1)]
    one, two = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    near = spark.createDataFrame([(1, one), (1, two), (2, f"{one} tail"), (3, f"{two} tail"), (4, "other words")], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in jaccard_join.near_duplicate_groups(near).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}
    cut = {(r["doc_id"], r["n_removed"]) for r in substring_dedup.remove_repeats(docs, 5).collect()}
    assert cut == {(1, 0), (2, 7), (3, 7), (4, 0), (None, 7)}
