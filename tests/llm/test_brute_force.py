"""Operators that SQL cannot express, against plain Python on small or odd texts."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidegrid.llm import decontaminate, jaccard_join, language_id, license_scan, pii, substring_dedup, token_counts, toxicity
from tidegrid.llm._words import ALNUM, NOT_SPACE, Words, covered, sliding_min
from tidegrid.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def near_copies(seed=3, groups=12, copies=10, words=80, vocabulary=3000):
    """Texts in groups: a base, and copies with some words changed, moved or dropped."""
    draw, out = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{draw.randrange(vocabulary)}" for _ in range(words + draw.randrange(60))]
        for _ in range(copies):
            own = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                own[draw.randrange(len(own))] = f"x{draw.randrange(10**6)}"
            out.append(" ".join(own[: len(own) - draw.choice([0, 0, 0, 3])]))
    out += ["a", "a b", "a b", "A B", "a b c", "a b c d", " ", ""]
    draw.shuffle(out)
    return list(enumerate(out))


def components(rows, n, threshold):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= threshold * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("n", "threshold", "seed", "tiers"), [(3, 90, 3, 5), (5, 80, 4, 1), (3, 80, 5, 5)])
def test_jaccard_components(spark, monkeypatch, n, threshold, seed, tiers):
    monkeypatch.setattr(jaccard_join, "TIERS", tiers)  # with one, many counts are broadcast
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicate_groups(docs, n, threshold).collect()}
    assert got == components(rows, n, threshold)


def crowded(draw, size, n_cells, cells):
    """Features that lie in few cells of the domain."""
    low = draw.integers(0, 2**32, size, dtype=np.uint64)
    cell = draw.choice(cells, size).astype(np.uint64)
    width = np.uint64((1 << 32) // n_cells)
    return np.unique(((cell * width + draw.integers(1, int(width), size, dtype=np.uint64)) << np.uint64(32)) | low)


@pytest.mark.parametrize("threshold", [90, 80])
def test_signatures_lose_no_pair(threshold):
    """Linked sets share as many signatures as either asks for: with features anywhere, and with features crowded into few groups."""
    draw, signer, linked = np.random.default_rng(threshold), jaccard_join.Signatures(threshold), 0
    for turn in range(1500):
        size = int(draw.integers(1, 120))
        if turn % 2:
            a = np.unique(draw.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            extra = draw.integers(0, 2**63, int(draw.integers(0, 1 + size // 8)), dtype=np.uint64)
        else:
            band = int(np.searchsorted(signer.edges, size, "right")) - 1
            cells = 3 * signer.groups(band)[1]
            a = crowded(draw, size, cells, draw.choice(cells, int(draw.integers(1, 4))))
            extra = crowded(draw, int(draw.integers(0, 1 + size // 8)), cells, np.arange(cells)) if size > 7 else a[:0]
        keep = a[draw.random(len(a)) > draw.choice([0, 0.03, 0.08, 0.15])]
        b = np.unique(np.concatenate([keep, extra]))
        if len(b) and 100 * len(np.intersect1d(a, b)) >= threshold * len(np.union1d(a, b)):
            linked += 1
            (x, p, u), (y, q, v) = signer.of(a), signer.of(b)
            pair = int(signer.shared(np.array([len(a)]), np.array([len(b)]), np.array([min(u, v)]))[0])
            assert np.intersect1d(x, y).size >= max(p, q, pair) >= 1 and max(u, v) < 64
    assert linked > 400


def crowded_pair(threshold, n):
    """Texts of linked sets of which the one signs subsets without features and the other does not."""
    signer, draw = jaccard_join.Signatures(threshold), random.Random(1)
    for k in range(60_000):
        words = [f"s{k}w{i}" for i in range(n + 11)]
        a, b = (next(jaccard_join.sets_of(pa.array([" ".join(words[:m])]), n)) for m in (n + 9, n + 11))
        k_band, groups, spare = signer.groups(int(np.searchsorted(signer.edges, len(a), "right")) - 1)

        def weak(x, groups=groups):
            cell = np.unique(((x >> np.uint64(32)) * np.uint64(3 * groups)) >> np.uint64(32)) // np.uint64(3)
            return groups - (np.unique(cell, return_counts=True)[1] >= 2).sum()

        if weak(a) > spare >= weak(b):
            return " ".join(words[: n + 9]), " ".join(words)
    raise AssertionError("no such pair")


def test_sets_on_both_sides_of_the_spare_groups_link(spark):
    a, b = crowded_pair(80, 5)
    signer = jaccard_join.Signatures(80)
    (x, p, _), (y, q, _) = (signer.of(next(jaccard_join.sets_of(pa.array([t]), 5))) for t in (a, b))
    assert np.intersect1d(x, y).size >= max(p, q)
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert {r["component_id"] for r in jaccard_join.near_duplicate_groups(docs, 5, 80).collect()} == {1}


def substring_removal(rows, window):
    first = {}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in rows}
    for i, w in words.items():
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(i, first.get(key, i))
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = (len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize(("window", "hot"), [(50, 1000), (12, 2), (3, 1)])
def test_substring_removal(spark, monkeypatch, window, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)  # hot minimisers take the second way
    rows = near_copies(7, words=150) + [(1000, "z " * 300), (1001, "z " * 200 + "end"), (1002, "q " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in substring_dedup.remove_repeats(docs, window).collect()}
    assert got == substring_removal(rows, window)


def test_windows_of_one_hash_are_told_apart():
    texts = ["a b c d", "x y c d", "a b c d"]
    data = " ".join(texts).encode()
    words = Words(np.frombuffer(data, np.uint8), np.array([0, 8, 16, len(data)]))
    starts, zeros = words.windows(3), np.zeros(6, np.uint64)
    order, head = substring_dedup._alike(words, starts, np.zeros(6, np.int64), zeros, zeros, 3)
    groups = [{words.text(s, s + 3) for s in starts[own]} for own in np.split(order, head[1:])]
    assert sorted(groups, key=str) == [{b"a b c"}, {b"b c d"}, {b"x y c"}, {b"y c d"}]


def contamination(rows, items, n=10):
    """n_words, n_hit and the items of each text, in plain Python."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = {}
    for i, t in items:
        w = split(t)
        k = min(n, len(w))
        for s in range(len(w) - k + 1) if k else ():
            grams.setdefault(tuple(w[s : s + k]), set()).update(() if i is None else (str(i),))
    out = []
    for i, t in rows:
        w, hit, own = split(t), set(), set()
        for k in {len(g) for g in grams}:
            for s in range(len(w) - k + 1):
                if (found := grams.get(tuple(w[s : s + k]))) is not None:
                    hit.update(range(s, s + k)), own.update(found)
        out.append((str(i), len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("max_broadcast", [1 << 20, 0])
def test_contamination(spark, max_broadcast):
    rows = near_copies(9) + [(None, "A b, then"), (7000, None), (7001, "twice the words of no item here"), (7001, "twice the words of no item here")]
    items = [(k, " ".join(t.split()[5:22])) for k, (_, t) in enumerate(rows[:40])] + [(99, "a b"), (98, ""), (97, None), (None, "words of no item"), (96, rows[0][1]), (96, rows[3][1])]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, n_hit string, met string").repartition(3)
    found = decontaminate.find_contamination(docs, spark.createDataFrame(items, "item_id long, text string"), max_broadcast=max_broadcast)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in found.collect())
    assert got == contamination(rows, items) and any(r[-1] for r in got) and found.columns.count("met") == 1
    assert any(r[2] and not r[3] for r in got)  # hit by an item without id


def test_colliding_grams_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontaminate, "_gram_hashes", lambda grams: np.full(len(grams), 7, np.uint64))
    monkeypatch.setattr(Words, "window_hashes", lambda self, starts, k, which=0: np.full(len(starts), 7, np.uint64))
    grams = decontaminate._Grams(pa.table({"gram": ["a b", "c d", "e f"], "k": [2, 2, 2], "items": [["1"], ["2"], []]}))
    assert [(s, grams.items[g].as_py()) for s, _, g in grams.find(Words(np.frombuffer(b"x C D a b", np.uint8), np.array([0, 9]), ALNUM, fold=True))] == [(1, ["2"]), (3, ["1"])]


def test_removed_passages_are_gone(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"Before it, {passage.upper()}! After it: {' '.join('abcdefghijklmnop')}", 0), (2, passage, 0), (3, "clean", 5)], "doc_id long, text string, n_chars long")
    out = {r["doc_id"]: r for r in decontaminate.remove_contamination(docs, spark.createDataFrame([(1, passage)], "item_id long, text string")).collect()}
    assert set(out) == {1, 3} and out[1]["text"] == f"Before it, After it: {' '.join('abcdefghijklmnop')}" and out[1]["n_chars"] == len(out[1]["text"])


def luhn(x):
    d = [int(c) for c in x if c.isdigit()][::-1]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(d)) % 10 == 0


def digits(x):
    return sum(c.isdigit() for c in x)


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda x: 13 <= digits(x) <= 19 and luhn(x)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 9 <= digits(x) <= 15),
}


def base_spans(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, (r, ok) in BASE.items() for m in re.finditer(r, text or "") if ok(m[0]))


def test_base_spans(spark):
    draw = random.Random(2)
    odd = ["a@b.c._z@w.net x@y.com+q@w.org", "1.2.3.4.5.6.7.8 999.1.1.1 001.2.3.4", "4111 1111 1111 1111-1 4111-1111-1111-1111", "+1 (415) 555-0100. +49 30 1234567)", "é1.2.3.4ü \U0001f600 a@b.de", None, ""]
    alphabet = ["1", "4", "0", ".", "-", " ", "@", "a", "b", "+", "(", ")", "é", "%", "_", "4111 1111 1111 1111", "x@y.org", "10.0.0.1"]
    odd += ["".join(draw.choice(alphabet) for _ in range(60)) for _ in range(300)]
    rows = list(enumerate(odd)) + [(10**6, "1 " * 60_000), (10**6 + 1, "a." * 60_000 + "@")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["b"] for r in pii.find_spans(docs, {}).select("doc_id", pii.listed("base_spans").alias("b")).collect()}
    assert got == {i: base_spans(t) if i < 10**6 else "" for i, t in rows}


def test_spans_of_any_number_are_found_overlapped_and_masked_alike(spark, monkeypatch):
    """Runs of runs of matches and pieces of text, made short, against plain Python."""
    monkeypatch.setattr(pii, "WIDTH", 3)
    monkeypatch.setattr(pii, "PIECE", 7)
    monkeypatch.setattr(pii, "_accepted", lambda weights, kind, x, before: before.contains("call"))
    draw = random.Random(9)
    bits = ["call 555-123-4567", "(415) 555-0100", "see 212.555.0199", "a@b.org", "10.0.0.1", "+49 30 1234567", "\U0001f600é", "123-45-6789", "4111 1111 1111 1111", "x", "+1 555-123-4567 9"]
    rows = [(i, "; ".join(draw.choices(bits, k=draw.choice([0, 1, 4, 40, 150])))) for i in range(30)] + [(99, None), (100, "call " + "é" * 50 + " 555-123-4567")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find_spans(docs, {}).collect()}
    masked = {r["doc_id"]: r["text"] for r in pii.mask_spans(docs, {}).collect()}
    shapes = {k: re.compile(v.replace("*+", "*").replace("}+", "}")) for k, v in pii.SHAPES.items()}
    for i, text in rows:
        t = text or ""
        base = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in base_spans(text).split(",") if x)]
        more = [(k, m.start(), m.end()) for k in pii.ADDED for m in shapes[k].finditer(t)]
        more = [c for c in more if not any(b[1] < c[2] and c[1] < b[2] for b in base) and "call" in t[max(0, c[1] - 32) : c[1]]]
        assert [tuple(s) for s in got[i]["spans"]] == base + more
        out, at = "", 0
        for s, e, kind in sorted((s, e, k) for k, s, e in base + more):
            if s >= at:
                out += t[at:s] + f"[{kind.upper()}]"
            at = max(at, e)
        assert masked[i] == (out + t[at:] if base + more else text)


def test_keys_are_added_and_words_are_not(spark):
    key = "token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    rows = [(i, f"text {key} more a{i}@b.org") for i in range(40)] + [(100 + i, "chapter internationalisation2 of the book") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.find_spans(docs, pii.learn_spans(docs)).collect()}
    assert out[3] == ["email", "secret"] and out[105] == []
    masked = {r["doc_id"]: r["text"] for r in pii.mask_spans(docs).collect()}
    assert masked[3] == "text token = [SECRET] more [EMAIL]" and masked[105] == rows[45][1]


def test_reliabilities_favour_agreeing_labelers():
    post = pii.estimate_reliabilities([("secret", (1, 0, 1, 0, 1), 50), ("secret", (0, 0, 0, -1, -1), 50), ("secret", (0, 0, 0, 0, 1), 5)])
    assert post["secret", (1, 0, 1, 0, 1)] > 0.9 and post["secret", (0, 0, 0, -1, -1)] < 0.1


def test_decoder_restores_words(spark):
    docs = spark.createDataFrame([("the stupid idiot said worthless things to a moron and hello to the clown " * 50,)], "text string")
    decoder = toxicity.Decoder(toxicity.count_trigrams(docs))
    for seen, meant in {"1d10t": "idiot", "s-t-u-p-i-d": "stupid", "m0r0n": "moron", "stuuuupid": "stupid", "cl0wn": "clown", "w0rthl3ss": "worthless", "hello": "hello"}.items():
        assert decoder.decode(seen) == meant


def test_disguised_tokens():
    text = b"an 1d10t and s t u p i d so m.0.r.o.n and loooser thing### HELLO!! 1 2 +1 (415) 555 fine words, e.g. here"
    found = {t for _, t in toxicity.disguised(Words(np.frombuffer(text, np.uint8), np.array([0, len(text)])))}
    assert {b"1d10t", b"stupid", b"m.0.r.o.n", b"loooser"} <= found
    assert not {b"thing", b"HELLO", b"fine", b"words"} & found


def test_every_reading_reaches_the_lattice(spark):
    text = "the stupid idiot said that you are shit and an ass or an asshole to the moron and hello to you the clown a worthless loser "
    decoder = toxicity.Decoder(toxicity.count_trigrams(spark.createDataFrame([(text * 50,)], "text string")))
    cases = {
        "st" + "u" * 90 + "pid": "stupid",
        "-.*_-.*_-.*_-.*_".join("worthless"): "worthless",  # over 64 bytes
        "$h1+": "shit",
        "@$$h0l3": "asshole",
        "a$$": "ass",
        "s h ! t": "shit",
        "y o u i d i o t": "idiot",
        "i d i o t  y o u": "you",
        "you_1d10t": "idiot",
        "(1d10t)": "idiot",
        "idi-ot": "idiot",
        "ïdïot": "idiot",
        "i\u0308di\u0308ot": "idiot",
        "ｉｄｉｏｔ": "idiot",
        "ｉ ｄ ｉ ｏ ｔ": "idiot",
        "іdiоt": "idiot",
        "i\u200bd\u200biot": "idiot",
        "sh*t": "shit",
        "m#r#n": "moron",
        "!d!0t": "idiot",
    }
    for seen, meant in cases.items():
        words, _ = toxicity._restored(Words(np.frombuffer(seen.encode(), np.uint8), np.array([0, len(seen.encode())])), decoder)
        assert meant.encode() in {words.text(k, k + 1) for k in range(len(words.start))}, seen
    assert len(decoder.decode("ab1c" * 20_000)) == 80_000 and not toxicity._readings(b"hello!!", decoder)


def test_honest_letters_get_no_reading(spark):
    text = "für den schönen Garten über die Brücke, größer und älter; это слово и тут, the fur of a naïve clown was found "
    decoder = toxicity.Decoder(toxicity.count_trigrams(spark.createDataFrame([(text * 50,)], "text string")))
    raw = text.encode()
    words, _ = toxicity._restored(Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])), decoder)
    assert not len(words.start)
    # a letter's neighbours in another text change nothing
    two = ["schö", "nïdïot"]
    joined = "".join(two).encode()
    both, _ = toxicity._restored(Words(np.frombuffer(joined, np.uint8), np.array([0, len(two[0].encode()), len(joined)])), decoder)
    apart = [toxicity._restored(Words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])), decoder)[0] for t in two]
    assert [both.text(k, k + 1) for k in range(len(both.start))] == [w.text(k, k + 1) for w in apart for k in range(len(w.start))]


def test_toxicity_on_held_out_and_disguised(spark):
    draw = random.Random(1)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        words = [draw.choice(plain) for _ in range(60)]
        bad = i % 5 == 0
        if bad:
            for w in ("idiot", "moron", draw.choice(["scum", "loser"])):
                words.insert(draw.randrange(60), w)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    rows += [(10_000, " ".join(plain[:40]) + " you 1d10t and m0r0n, such s c u m"), (10_001, ""), (10_002, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([x for x in labels if zlib.crc32(str(x[0]).encode()) % 3 != 1], "doc_id long, toxic int")
    decoder = toxicity.Decoder(toxicity.count_trigrams(docs))
    out = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.score_toxicity(docs, decoder, toxicity.learn(docs, known, decoder)).collect()}
    held = [(y, out[i][1]) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([y == p for y, p in held]) > 0.98
    assert out[10_000][1] == 1 and out[10_001][1] == out[10_002][1] == 0
    assert all(0 <= s <= 1 for s, _ in out.values())


def test_languages_on_held_out(spark):
    out = QUERIES["op5_language_id"](spark, DATA).collect()
    true = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert np.mean([true[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97


def test_grams_by_brute_force():
    import pyarrow as pa

    text = "Aé b, ÉÄ1\n"
    low = " aé b éä "
    want = Counter()
    for n in (1, 2, 3):
        for k in range(len(low) - n + 1):
            g = low[k : k + n]
            if g != " " and not (n == 3 and g[1] == " "):
                want[g] += 1
    edge = int(language_id.EDGE)
    letters = lambda g: [(g >> s) & 0x1FFFFF for s in (42, 21, 0) if g >> s]
    got = Counter("".join(" " if c == edge else chr(c) for c in letters(g)) for g in next(language_id.grams_of(pa.array([text]))).tolist())
    assert got == want


def test_token_counts_and_cache(spark, tmp_path):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    texts = ["Hello  world", "Hello  world", "", None, "a <|endoftext|> b", "ünïcode \U0001f600" * 50, "x" * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/cache"
    library = Tokenizer.from_file(path)
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    for _ in range(2):  # the second time from the cache alone
        assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, path, cache).collect()} == want
    assert spark.read.parquet(cache).count() == len({t or "" for t in texts})
    more = docs.unionByName(spark.createDataFrame([(50, "new one")], "doc_id long, text string"))
    assert {r["doc_id"] for r in token_counts.count_tokens(more, path, cache).collect()} == {*want, 50}
    assert spark.read.parquet(cache).count() == len({t or "" for t in texts}) + 1
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert got == {i: len(pieces.encode(t or "")) for i, t in enumerate(texts)}


def test_notices(spark):
    cases = {
        "Licensed under the Apache License, Version 2.0 (the License)": "apache-2.0-notice",
        "licensed under the APACHE license version 2.0": "apache-2.0-notice",
        "licensed under the apache license version 1 0": "",
        "Copyright (c) 2001, 2002, 2003, 2004 The Regents of the University of California. All rights reserved.": "copyright-notice,reserved",
        "Copyright (c) " + "x " * 500 + "all rights reserved": "copyright-notice,reserved",
        "Copyright (c) 2020. Some rights reserved": "",
        "All rights reserved. Copyright (c) 2020": "reserved",
        "Licensed under the Creative Commons Attribution-NonCommercial 4.0 International License": "cc-notice",
        "under the BSD 3-Clause license": "bsd-notice",
        "This work is licensed under the terms of the GNU Lesser General Public License, version 3": "gpl,gpl-notice",
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, for non-commercial use": "",
    }
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan_licenses(docs).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def instance(wording, draw, most):
    """A text of the template, and the places of its mandatory words."""
    out, fixed, depth, skip = [], [], 0, False
    for token in wording.split():
        if token == "{optional":
            depth, skip = 1, draw.random() < 0.5
        elif token == "}":
            depth, skip = 0, False
        elif token == "{any}":
            out += [f"n{k}" for k in range(draw.randrange(most + 1))]
        elif not skip:
            fixed += [] if depth else [len(out)]
            out.append(token)
    return out, fixed


def stands(wording, words):
    """Whether a template stands anywhere in words: all places that can be reached, token by token of the markup."""
    now, kept = set(range(len(words) + 1)), []
    for token in wording.split():
        if token == "{optional":
            kept.append(now)
        elif token == "}":
            now = now | kept.pop()
        elif token == "{any}":
            now = set(range(min(now), len(words) + 1)) if now else now
        else:
            now = {p + 1 for p in now if p < len(words) and words[p] == token}
    return bool(now)


@pytest.mark.parametrize(("label", "wording"), license_scan.LICENSES)
def test_whole_licenses_need_every_mandatory_word(spark, label, wording):
    draw, rows = random.Random(label), []
    for most in (0, 3, 17, 500):
        words, fixed = instance(wording, draw, most)
        rows.append(f"before, {' '.join(words).upper()}. After")
        rows += [f"before {' '.join([*words[:k], 'changedword', *words[k + 1 :]])} after" for k in fixed]
        k = draw.choice(fixed[2:])
        rows += [" ".join(words[:k] + words[k + 1 :]), " ".join([*words[:k], "except", "on", "sundays", *words[k:]])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(docs).collect()}
    want = [stands(wording, re.findall("[a-z0-9]+", r.lower())) for r in rows]
    assert [label in got[i]["labels"].split(",") for i in range(len(rows))] == want and want[0] and not want[1]
    assert got[0]["score"] == 1.0


@pytest.mark.parametrize(("label", "wording"), license_scan.NOTICES)
def test_notices_name_a_licence_and_are_none(spark, label, wording):
    draw = random.Random(label)
    texts = [" ".join(instance(wording, draw, 30)[0]) for _ in range(5)]
    got = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(label in r["labels"].split(",") and r["score"] == 0.8 for r in got) and label.endswith(("-notice", "-header"))


def test_scrambled_wording_is_judged_as_the_markup_says(spark):
    """Pieces of templates in any order, repeated and cut, against every reachable place."""
    draw = random.Random(12)
    templates = [("a", "one two {any} three four {optional five } six {any} one two"), ("b", "two three {optional three four } four"), ("c", "four five {any} five four"), ("d", "six {optional one } two {any} x")]
    words = ["one", "two", "three", "four", "five", "six", "x"]
    rows = [draw.choices(words, k=draw.randrange(40)) for _ in range(400)]
    docs = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan_licenses(docs, templates).collect()}
    want = [",".join(label for label, wording in templates if stands(wording, r)) for r in rows]
    assert [got[i] for i in range(len(rows))] == want and {"a", "b", "c", "d"} <= {x for w in want for x in w.split(",")}


def test_many_openings_of_a_long_text_are_read_once():
    text = ("copyright c " * 200_000).encode()
    words = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), ALNUM, fold=True)
    assert license_scan.Scanner(license_scan.TEMPLATES).scan(words)[1] == {0: set()}


def test_bad_template_is_refused():
    for bad in ("{optional one } two", "one two } three", "one two {any}", "one two {optional three"):
        with pytest.raises(ValueError):
            license_scan.automata(bad)


@pytest.mark.parametrize("mask", [NOT_SPACE, ALNUM])
def test_words_equal_regex(mask):
    pattern = r"[^\x20\x09-\x0D]+" if mask is NOT_SPACE else r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    texts = ["", "abc", "def ghi", "", "é-ü x", " ", "A.b\x0bc d", "end"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    words = Words(np.frombuffer(data, np.uint8), offsets, mask, fold=mask is ALNUM)
    fold = (lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)) if mask is ALNUM else (lambda t: t)
    want = [[w.encode() for w in re.findall(pattern, fold(t))] for t in texts]
    got = [[data[words.start[k] : words.end[k]] for k in range(words.first[i], words.first[i + 1])] for i in range(len(texts))]
    assert [[w.lower() for w in d] for d in got] == [[w.lower() for w in d] for d in want]


def test_windows_slide():
    x = np.random.default_rng(0).integers(0, 1000, 300).astype(np.uint64)
    for width in (1, 2, 7, 43, 64):
        assert sliding_min(x, width).tolist() == [x[i : i + width].min() for i in range(300 - width + 1)]
    assert covered(np.array([1, 2, 6]), 3, 10).tolist() == [False, True, True, True, True, False, True, True, True, False]


def test_pipeline_against_plain_python(spark):
    """Every stage's decisions on its own input: languages by letters, components, windows and base spans by brute force."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = {tuple(w[k : k + 10]) for t in items for w in [re.findall(word, t.lower())] for k in range(max(1, len(w) - 9))}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        rows = out.collect()
        after = {r["doc_id"]: r["text"] for r in rows}
        if name == "language_id":
            assert set(after) == {i for i, t in before.items() if any(c.isalpha() for c in t)}
        elif name == "jaccard_join":
            groups = components(list(before.items()), 5, 80)
            assert set(after) == {i for i, (n, c) in groups.items() if c == i or not n}
        elif name == "decontamination":
            for i, t in after.items():
                w = re.findall(word, before[i].lower())
                hit = any(tuple(w[k : k + 10]) in windows for k in range(len(w) - 9))
                assert hit or t == before[i]
                assert not hit or t != before[i]
            assert len(after) >= 0.9 * len(before)
        elif name == "pii":
            assert set(after) == set(before)
            assert all(not base_spans(t) for t in after.values())
            assert all(t == before[i] for i, t in after.items() if not re.search(r"[0-9@]", before[i]))
        else:
            assert sum(r["taken"] for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows), rel=0.01)
        if name != "mixing":
            assert out.columns == docs.columns
            path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}"
            out.write.mode("overwrite").parquet(path)
            docs, before = spark.read.parquet(path), after


def test_digests_follow_the_contract(spark):
    out = QUERIES["op2_substring_dedup"](spark, DATA).where("n_words = 0").collect()
    assert all(r["kept_sha256"] == hashlib.sha256(b"").hexdigest() for r in out)


def test_sets_are_ranked_in_pieces(monkeypatch):
    monkeypatch.setattr(jaccard_join, "RANKED", 10)
    sizes = [4, 6, 1, 25, 3, 0, 7, 9]
    batch = pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array([list(range(n)) for n in sizes], pa.list_(pa.int64()))], names=["n", "features"])
    found = list(jaccard_join._pieces(batch))
    assert [p.column("n").to_pylist() for p in found] == [[4, 6], [1], [25], [3, 0, 7], [9]]
    assert [x for p in found for x in p.column("features").to_pylist()] == batch.column("features").to_pylist()
    assert [len(p.column("features").flatten()) for p in found] == [10, 1, 25, 10, 9] and not list(jaccard_join._pieces(batch.slice(0, 0)))
