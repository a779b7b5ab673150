"""Toxicity by noisy-channel deobfuscation.

Tokens of any length that may be read otherwise (digits or signs for letters, signs between letters, letters drawn out,
single letters in a row with spaces between) become lattices of the characters that they may stand for; a Viterbi
decode under a character trigram model picks the likeliest words, ``BEST`` at the most and none that is far less likely
than the first. Where something stands between letters, a second lattice lets it be a boundary of words as well. Signs at
a token's edge may be letters or punctuation: it is read with and without them. Letters of other forms (full width, mathematical) are
read as plain ones; accented letters and, beside Latin letters, those of other scripts that look Latin may be honest or a disguise,
which the model decides by its counts of accented and other letters and of each accented one: words that corpora are full of get no reading. A mask (``f*ck``) within a token stands
for any letter; in a run of more than ``MASKED_RUN`` it is a separator, as at an edge.
The model is counted over the whole corpus. The text's own words and the restored words are then scored.

Scoring: a word's features are itself and its first 4, 5 and 6 bytes. Features that labelled toxic documents
have far more often than others carry weight; a document's evidence is the number, share and strength of such words,
and a logistic model turns it into a score. Features and model are fitted on about ``PER_CLASS`` labelled
documents of each class, chosen by a hash of their id: a documented bound. Labels, language, source and id
are no inputs of a score.

The sample and the fits depend on no order of rows, so reruns agree. Null and empty texts have no evidence and the score of that; repeated rows score alike; labels of equal ids count as toxic if one does;
without labels of both kinds every score is 0; an empty table gives no rows. Long texts are scored whole. Other
columns pass through; those named like an output are replaced.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm._frames import map_column, saved, small_batches
from tidegrid.llm._words import ALNUM, NOT_SPACE, Words, chunks

PER_CLASS = 6000
#: Toxic documents of the sample that a feature needs, and the log-odds.
SUPPORT, WEIGHT = 5, 2.5
PREFIXES = (4, 5, 6)
CUT = 0.7
OUTPUT = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

# What a sign or digit may stand for.
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SIGNS = "0123456789@$!|+("
MASKS = "*#"
LOOKS_LIKE = {"а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ԝ": "w", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i"}
#: Log chances of the channel: a letter as it is, disguised, drawn out by one more, doubled and meant so, a sign between.
KEPT, CHANGED, DRAWN, DOUBLE, SEPARATED = 0.0, -0.5, -0.3, -0.7, -0.3
#: Log chance of a letter disguised as one with an accent; an honest one has that of its share of all accented letters of the corpus.
ACCENT = -6.0
#: Readings of a lattice at the most, and how far behind the likeliest one their log chance may be.
BEST, MARGIN = 3, 3.0
MASKED_RUN = 3

#: Characters of the tokens that a decoder remembers, a bound of its memory alone.
REMEMBERED = 64

#: The model's alphabet: 0 a boundary, 1-26 letters of any form without an accent, 27 any other letter, 28 a Latin letter with an accent.
SYMBOLS, OTHER, ACCENTED = 29, 27, 28
#: Accented letters are counted after the trigrams, each in lower case at its code point; those from the last one on together.
CODES = 0x2000
_FOLD: list[np.ndarray] = []


def plain_letter(ch: str) -> str:
    """The character's first part without its marks and form, in lower case."""
    return unicodedata.normalize("NFKD", ch)[0].lower()


def fold_table() -> np.ndarray:
    if not _FOLD:
        table = np.zeros(0x110000, np.int64)
        for c in range(0x110000):
            if (x := chr(c)).isalpha():
                plain = plain_letter(x)
                table[c] = OTHER if not "a" <= plain <= "z" else ord(plain) - 96 if len(unicodedata.normalize("NFKD", x)) == 1 else ACCENTED
        _FOLD.append(table)
    return _FOLD[0]


def lower(ch: str) -> str:
    """In lower case, if that is one character."""
    return low if len(low := ch.lower()) == 1 else ch


def symbol(ch: str) -> int:
    """The model's symbol of a lattice's character."""
    return 0 if ch == " " else int(fold_table()[ord(ch)])


def count_trigrams(documents: DataFrame) -> np.ndarray:
    """Counts of symbol trigrams, then of accented letters, over all documents. Tasks sum their own; a table of SYMBOLS cubed and CODES rows at the most is collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3 + CODES, np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
                at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
                plain = fold_table()[points]
                kinds, n = np.unique(points[plain == ACCENTED], return_counts=True)
                np.add.at(total, SYMBOLS**3 + np.array([min(ord(lower(chr(c))), CODES - 1) for c in kinds.tolist()], np.int64), n)
                x = np.insert(plain, at, 0)  # a boundary around each text
                x = np.concatenate([[0], x])
                x = x[np.concatenate([[True, True], (x[2:] != 0) | (x[1:-1] != 0) | (x[:-2] != 0)])]
                total += np.bincount((x[:-2] * SYMBOLS + x[1:-1]) * SYMBOLS + x[2:], minlength=len(total))
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(total[has])], names=["gram", "n"])

    small_batches(documents.sparkSession)
    counted = documents.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    out = np.zeros(SYMBOLS**3 + CODES, np.int64)
    for r in counted.collect():
        out[r["gram"]] = r["n"]
    return out


class Decoder:
    """Viterbi decoding of disguised tokens under the trigram model."""

    def __init__(self, counts: np.ndarray):
        cube = counts[: SYMBOLS**3].reshape((SYMBOLS,) * 3).astype(float)
        two = cube.sum(0)
        one = two.sum(0)
        base = (one + 1) / (one.sum() + SYMBOLS)
        pair = (two + 5 * base) / (two.sum(1, keepdims=True) + 5)
        self.table = np.log((cube + 5 * pair) / (cube.sum(2, keepdims=True) + 5))
        self.log = self.table.tolist()
        accented = counts[SYMBOLS**3 :].astype(float)
        self.honest = np.log((accented + 1) / (accented.sum() + 100))
        self.memo: dict[str, list[str]] = {}

    def decode(self, token: str) -> str:
        """The likeliest word of folded letters behind a token."""
        return self._known(token, False)[0]

    def split(self, token: str) -> list[str]:
        """The likeliest words, if what stands between letters may be a boundary of words. A line feed always is one."""
        return self._known(token, True)[0].split()

    def words(self, token: str, joined: str) -> set[str]:
        """The words of all readings: of joined as one word, and of token as one or more."""
        return {*self._known(joined, False), *(w for r in self._known(token, True) for w in r.split())}

    def _known(self, token: str, apart: bool) -> list[str]:
        key = "\n" + token if apart else token
        if (known := self.memo.get(key)) is None:
            known = [w for w, _ in self._viterbi(unicodedata.normalize("NFC", token), apart)]
            if len(token) <= REMEMBERED:
                if len(self.memo) > 100_000:
                    self.memo.clear()
                self.memo[key] = known
        return known

    def _options(self, ch: str) -> list[tuple[str, float]]:
        low = lower(ch)
        code = symbol(ch)
        if code == ACCENTED:
            return [(low, float(self.honest[min(ord(low), CODES - 1)])), (plain_letter(ch), ACCENT)]
        if low in LOOKS_LIKE:
            return [(low, KEPT), (LOOKS_LIKE[low], CHANGED)]
        if code:
            return [(low if code == OTHER else chr(96 + code), KEPT)]
        if low in STANDS_FOR:
            return [(x, CHANGED) for x in STANDS_FOR[low]] + ([("", 4 * SEPARATED)] if low in "!|" else [])
        return [("", SEPARATED)]

    def _viterbi(self, token: str, apart: bool) -> list[tuple[str, float]]:
        """The likeliest readings and their log chances, best first."""
        # the last two symbols -> the BEST paths of different letters: (log chance, hash of the letters, chain of them (chain, letters))
        paths: dict[tuple[int, int], list[tuple[float, int, tuple | None]]] = {(0, 0): [(0.0, 0, None)]}

        def keep(out: dict, state: tuple[int, int], path: tuple[float, int, tuple | None]) -> None:
            had = out.get(state)
            if had is None:
                out[state] = [path]
                return
            least = 0
            for k, other in enumerate(had):
                if other[1] == path[1]:
                    if path[0] > other[0]:
                        had[k] = path
                    return
                if other[0] < had[least][0]:
                    least = k
            if len(had) < BEST:
                had.append(path)
            elif path[0] > had[least][0]:
                had[least] = path

        def step(paths: dict, options: list[tuple[str, float]]) -> dict:
            out: dict[tuple[int, int], list[tuple[float, int, tuple | None]]] = {}
            coded = [(letters, [symbol(x) for x in letters], cost) for letters, cost in options]
            for (a, b), own in paths.items():
                for letters, codes, cost in coded:
                    p, q, total = a, b, cost
                    written = letters
                    for code in codes:
                        if code or q:
                            total += self.log[p][q][code]
                            p, q = q, code
                        else:
                            written = ""  # a boundary is one, however many signs stand for it
                    drawn = apart and q and letters and q == b and letters != " "  # the same letter again: drawn out
                    for chance, mark, chain in own:
                        after = mark
                        for x in written:
                            after = hash((after, x))
                        keep(out, (p, q), (chance + total, after, (chain, written) if written else chain))
                        if drawn and written == (chain and chain[1]):
                            keep(out, (a, b), (chance + cost + DOUBLE, mark, chain))
            return out

        i = 0
        while i < len(token):
            n = 1
            while i + n < len(token) and token[i + n].lower() == token[i].lower():
                n += 1
            if token[i] in MASKS:
                letters = [(chr(c), CHANGED) for c in range(97, 123)] if n <= MASKED_RUN and not apart else []
                single = [*letters, ("", SEPARATED)]
            else:
                n = 1 if apart else n
                single = self._options(token[i])
            if apart and single[-1][0] == "":  # what may be left out may be a boundary
                single = [(" ", 0.0)] if token[i] == "\n" else [*single, (" ", SEPARATED)]
            if token[i] in MASKS:
                for _ in range(n):
                    paths = step(paths, single)
            elif n > 1:  # one letter drawn out, or a double one
                one, two = (DOUBLE, KEPT) if n == 2 else (DRAWN, DOUBLE)
                drawn = [(x, c + one) for x, c in single]
                double = [(x + x, c + two) for x, c in single if x]
                paths = step(paths, drawn + double)
            else:
                paths = step(paths, single)
            i += n
        ends = [(c + (self.log[a][b][0] if b else 0.0), k, w) for k, ((a, b), c, w) in enumerate((s, c, w) for s, own in paths.items() for c, _, w in own)]
        ends.sort(key=lambda x: (-x[0], x[1]))
        out = []
        for chance, _, chain in ends[:BEST]:
            if chance < ends[0][0] - MARGIN:
                break
            letters = []
            while chain is not None:
                chain, own = chain
                letters.append(own)
            out.append(("".join(letters[::-1]), chance))
        return out


_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in SIGNS]] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[128:] = True
_TAIL = np.zeros(256, bool)
_TAIL[[ord(c) for c in ".,!?;:'\")%&#*]}>$|"]] = True
_LATIN = np.zeros(256, bool)
_LATIN[65:91] = _LATIN[97:123] = True
_MASK = np.zeros(256, bool)
_MASK[[ord(c) for c in MASKS]] = True
#: Bytes that no letter has: ASCII ones, and what begins the signs of Latin-1 and U+2000 to U+2FFF, the pound and the euro too.
_ODD = ~_ALPHA
_ODD[[0xC2, 0xE2]] = True


def _sums(mask: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])


def _up_to_last(mask: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each range, one past its last byte in mask; its start if there is none."""
    sums = _sums(mask)
    return np.where(sums[end] > sums[start], np.searchsorted(sums, sums[end], "left"), start)


def _from_first(mask: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each range, its first byte in mask; its end if there is none."""
    sums = _sums(mask)
    return np.where(sums[end] > sums[start], np.searchsorted(sums, sums[start], "right") - 1, end)


def _spaced(words: Words, cut: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(text, run) of the runs of single letters: a space between them, a line feed where more stands than the least gap of the run."""
    data, start, end = words.data, words.start, words.end
    size = cut - start
    one = end - start == 1
    lone = ((size == 1) | one) & (_ALPHA[data[start]] | _SIGN[data[start]])
    lone |= (size == 2) & (data[start] >= 0xC3)  # one letter of two bytes
    lone |= (size == 3) & (data[start] == 0xEF)  # one of full width
    lone |= (end - start == 2) & (data[start] == 0xC2) | (end - start == 3) & (data[start] == 0xE2)  # a pound, a euro
    stop_at = np.where(one, end, cut)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], lone.astype(np.int8), [0]])))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        while a < b:
            stop = min(b, int(words.first[words.doc[a] + 1]))
            if stop - a >= 3:
                gaps = start[a + 1 : stop] - stop_at[a : stop - 1]
                between = np.where(gaps > gaps.min(), "\n", " ").tolist()
                letters = [data[start[i] : stop_at[i]].tobytes() for i in range(a, stop)]
                yield int(words.doc[a]), letters[0] + b"".join(g.encode() + x for g, x in zip(between, letters[1:], strict=True))
            a = stop


_LOOKS = np.array(sorted({ord(y) for x in LOOKS_LIKE for y in (x, x.upper()) if not y.isascii()}), np.uint32)


def _folded(words: Words, decoder: Decoder) -> tuple[np.ndarray, np.ndarray]:
    """Two masks over bytes: where a letter begins that is a plain one in another form, or has an accent that the model finds
    less likely there than the plain letter in disguise; and where one begins that looks Latin."""
    odd, looks = np.zeros((2, len(words.data)), bool)
    if not (words.data >= 0xC3).any():
        return odd, looks
    points = np.frombuffer(words.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    begins = (words.data & 0xC0) != 0x80
    place = np.flatnonzero(begins)
    at = np.concatenate([[0], np.cumsum(begins)])[words.offsets]
    plain = fold_table()[points]
    x = np.concatenate([[0, 0], np.insert(plain, at, 0), [0, 0]])  # a boundary around each text
    index = np.flatnonzero(np.insert(np.ones(len(points), bool), at, False)) + 2
    odd[place[(points >= 128) & (plain >= 1) & (plain <= 26) | (points >= 0x300) & (points < 0x370)]] = True  # and an accent that is a character
    looks[place[np.isin(points, _LOOKS)]] = True
    accented = np.flatnonzero(plain == ACCENTED)
    if len(accented):
        kinds, which = np.unique(points[accented], return_inverse=True)
        letter = np.array([ord(plain_letter(chr(c))) - 96 for c in kinds.tolist()])[which]
        honest = decoder.honest[[min(ord(lower(chr(c))), CODES - 1) for c in kinds.tolist()]][which]
        k = index[accented]
        before, after = x[k - 1], x[k + 1]
        first, last = np.where(before == 0, 0, x[k - 2]), x[k + 2]

        def chance(own: np.ndarray | int) -> np.ndarray:
            log = decoder.table
            return log[first, before, own] + log[before, own, after] + np.where(after == 0, 0.0, log[own, after, last])

        odd[place[accented[chance(letter) + ACCENT > chance(ACCENTED) + honest]]] = True
    return odd, looks


def _candidates(words: Words, decoder: Decoder | None = None) -> tuple[list[tuple[int, int, bytes]], list[tuple[int, bytes]]]:
    """(text, word, token) of the tokens that have a reading besides the one as written, and the spaced runs. words: split at white space.

    Without a decoder, letters with accents, of other forms and of other scripts are as written.
    """
    data, start, end = words.data, words.start, words.end
    if not len(start):
        return [], []
    cut = _up_to_last(~_TAIL[data], start, end)  # without closing signs
    letter = _ALPHA[data] | _SIGN[data]
    far = _up_to_last(letter, start, end)  # with those that may be letters
    near = _from_first(letter, start, end)
    bare = _from_first(_ALPHA[data] | ((data >= 48) & (data < 58)), start, end)  # without opening signs that may be letters
    own_odd, looks = _folded(words, decoder) if decoder is not None else np.zeros((2, len(data)), bool)
    odd, n_letter = _sums(_ODD[data] | own_odd), _sums(letter | _MASK[data])
    looks, latin = _sums(looks), _sums(_LATIN[data])
    triple = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        lower = np.where((data >= 65) & (data < 91), data + 32, data)
        triple[: len(data) - 2] = (lower[:-2] == lower[1:-1]) & (lower[1:-1] == lower[2:]) & (data[:-2] < 128) & _ALPHA[data[:-2]]
    runs = _sums(triple)
    found: list[tuple[int, int, bytes]] = []
    seen = []
    for a, b in ((bare, cut), (near, cut), (bare, far), (near, far)):
        b = np.maximum(a, b)
        reads = (odd[b] > odd[a]) | (runs[np.maximum(a, b - 2)] > runs[a]) | (looks[b] > looks[a]) & (latin[b] > latin[a])
        reads &= n_letter[b] - n_letter[a] >= 3  # fewer give no word of three letters
        for c, d in seen:
            reads &= (a != c) | (b != d)
        seen.append((a, b))
        found += [(int(words.doc[i]), i, data[a[i] : b[i]].tobytes()) for i in np.flatnonzero(reads).tolist()]
    return found, list(_spaced(words, cut))


def disguised(words: Words) -> list[tuple[int, bytes]]:
    """(text, token) of the tokens that look disguised, spaced runs joined. words: split at white space."""
    found, runs = _candidates(words)
    return [(d, t) for d, _, t in found] + [(d, re.sub(rb"[ \n]", b"", t)) for d, t in runs]


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: np.ndarray  # of 1, log(1 + n), share, strongest


_NO_MODEL = Model(np.zeros(0, np.uint64), np.zeros(0), np.array([-1e9, 0, 0, 0]))


_PLAIN = re.compile(rb"[A-Za-z0-9\x80-\xff]+")


def _readings(token: bytes, decoder: Decoder) -> set[str]:
    """The words behind a token that do not stand there as written."""
    text = token.decode("utf-8", "ignore")
    out = decoder.words(text, text)
    return out - {w.decode("utf-8", "ignore").lower() for w in _PLAIN.findall(token)} - set(re.findall(r"\w+", unicodedata.normalize("NFC", text).lower()))


def _restored(words: Words, decoder: Decoder) -> tuple[Words, np.ndarray]:
    """The decoded words, and the text of each; a place gives a word once."""
    tokens, runs = _candidates(words, decoder)
    places: dict[tuple[int, int], set[str]] = {}
    for d, i, t in tokens:
        places.setdefault((d, i), set()).update(_readings(t, decoder))
    for k, (d, t) in enumerate(runs):
        places[d, -1 - k] = decoder.words(t.decode("utf-8", "ignore"), re.sub(rb"[ \n]", b"", t).decode("utf-8", "ignore"))
    found = [(d, w.encode()) for (d, _), own in places.items() for w in sorted(own) if len(w) >= 3]
    data = np.frombuffer(b" ".join(w for _, w in found), np.uint8)
    return Words(data, np.array([0, len(data)]), ALNUM, fold=True), np.array([d for d, _ in found], np.int64)


def word_features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, their hashes) for each kind of feature."""
    yield np.arange(len(words.start)), words.hashes()
    for n in PREFIXES:
        yield words.prefix_hashes(n)


def _parts(column: pa.Array, decoder: Decoder) -> Iterator[tuple[int, np.ndarray, list[tuple[Words, np.ndarray]]]]:
    """Of each chunk: texts, words of each, and (words, text of each word) as written and as restored."""
    for row, last, data, offsets in chunks(column):
        own = Words(data, offsets, ALNUM, fold=True)
        restored = _restored(Words(data, offsets, NOT_SPACE), decoder)
        yield last - row, own.n, [(own, own.doc), restored]


def evidence(column: pa.Array, decoder: Decoder, model: Model) -> np.ndarray:
    """For each text: 1, log(1 + words with weight), their share in percent (cut at 10), the greatest weight."""
    bits = np.zeros(1 << 20, bool)
    bits[model.features & np.uint64((1 << 20) - 1)] = True
    out = [np.zeros((0, 4))]
    for n, n_words, parts in _parts(column, decoder):
        count, most = np.zeros(n), np.zeros(n)
        for words, doc in parts:
            best = np.zeros(len(words.start))
            for own, hashes in word_features(words):
                maybe = np.flatnonzero(bits[hashes & np.uint64((1 << 20) - 1)])
                if len(maybe):
                    at = np.minimum(np.searchsorted(model.features, hashes[maybe]), len(model.features) - 1)
                    hit = model.features[at] == hashes[maybe]
                    np.maximum.at(best, own[maybe[hit]], model.weights[at[hit]])
            found = np.flatnonzero(best)
            np.add.at(count, doc[found], 1)
            np.maximum.at(most, doc[found], best[found])
        out.append(np.stack([np.ones(n), np.log1p(count), np.minimum(10, 100 * count / np.maximum(1, n_words)), most], axis=1))
    return np.concatenate(out)


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, toxic, fold and family, the least hash of a text's 5-word windows: near copies mostly share it."""
    for batch in batches:
        out = []
        for row, last, data, offsets in chunks(batch.column("text")):
            words = Words(data, offsets, ALNUM, fold=True)
            hashes = words.window_hashes(np.arange(len(words.start) - 4), 5) if len(words.start) > 4 else np.zeros(0, np.uint64)
            for d in range(last - row):
                own = hashes[words.first[d] : max(words.first[d], words.first[d + 1] - 4)]
                out.append(own.min() if len(own) else words.range_hashes(words.first[d : d + 1], words.first[d + 1 : d + 2])[0])
        family = pa.array(np.array(out, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("text"), batch.column("toxic").cast(pa.int32()), batch.column("fold"), family], names=["doc_id", "text", "toxic", "fold", "family"])


def learn(documents: DataFrame, labels: DataFrame, decoder: Decoder, per_class: int = PER_CLASS) -> Model:
    """The model from documents (doc_id, text) and labels (doc_id, toxic), about per_class labels of each class."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect() if r["toxic"] in (0, 1)}
    if len(sizes) < 2:
        return _NO_MODEL
    rate = F.when(F.col("toxic") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0]))
    drawn = known.where(F.col("toxic").isin(0, 1) & (F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < rate * (1 << 20)))
    drawn = drawn.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), F.col("doc_id").cast("string")), F.lit(3)).cast("int"))
    sample = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "toxic", "fold")  # 2 per_class ids are sent
    # one document of each family of near copies, else the words of a copied text look like evidence; the least id, so that reruns agree
    sample = sample.mapInArrow(_families, "doc_id long, text string, toxic int, fold int, family long")
    sample = sample.groupBy("family").agg(F.min(F.struct("doc_id", "text", "toxic", "fold")).alias("least")).select("least.text", "least.toxic", "least.fold")
    sample = saved(sample.withColumn("toxic", F.col("toxic").cast("int")), "toxicity-sample")
    first, second = sample.where("fold < 2"), sample.where("fold = 2")  # features from the first, the logistic model from the second

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, row = batch.column("toxic").to_numpy(), 0
            for n, _, parts in _parts(batch.column("text"), decoder):  # sums of one chunk at a time
                pairs = [np.stack([doc[own].astype(np.uint64), h]) for words, doc in parts for own, h in word_features(words)]
                pairs = np.unique(np.concatenate(pairs, axis=1), axis=1)
                values, where = np.unique(pairs[1], return_inverse=True)
                bad = np.bincount(where, toxic[row : row + n][pairs[0].astype(np.int64)], len(values)).astype(np.int64)
                every = np.bincount(where, minlength=len(values))
                row += n
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(bad), pa.array(every - bad)], names=["feature", "bad", "good"])

    n_bad, n_good = (int(r) for r in first.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first())
    if not n_bad or not n_good:
        return _NO_MODEL
    counted = first.mapInArrow(count, "feature long, bad long, good long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    weight = F.log((F.col("bad") + 0.5) / (n_bad + 1.0)) - F.log((F.col("good") + 0.5) / (n_good + 1.0))
    best = counted.where(F.col("bad") >= SUPPORT).withColumn("weight", weight).where(F.col("weight") >= WEIGHT).select("feature", "weight").collect()
    best.sort(key=lambda r: np.uint64(r["feature"] & ((1 << 64) - 1)))
    features = np.array([r["feature"] for r in best], np.int64).view(np.uint64)
    model = Model(features, np.array([r["weight"] for r in best]), np.array([-1e9, 0, 0, 0]))

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = evidence(batch.column("text"), decoder, model)
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), *(pa.array(x[:, k]) for k in range(4))], names=["y", "a", "b", "c", "d"])

    # sorted, so that sums of floating-point numbers don't depend on the order of tasks
    fitted = np.array(sorted(tuple(r) for r in second.mapInArrow(stats, "y int, a double, b double, c double, d double").collect())).reshape(-1, 5)
    if len(set(fitted[:, 0])) < 2:
        return _NO_MODEL
    model.bias = _logistic(fitted[:, 1:], fitted[:, 0])
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's steps, classes balanced."""
    w = np.zeros(x.shape[1])
    each = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (each * (y - p)) - 1e-4 * w
        curve = (x * (each * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    return w


def score_toxicity(documents: DataFrame, decoder: Decoder, model: Model, cut: float = CUT) -> DataFrame:
    """documents with score and predicted."""
    shared = documents.sparkSession.sparkContext.broadcast((decoder, model))

    def fn(column: pa.Array) -> list[pa.Array]:
        own, fitted = shared.value
        score = 1 / (1 + np.exp(-np.clip(evidence(column, own, fitted) @ fitted.bias, -700, 700)))
        return [pa.array(score, pa.float64()), pa.array((score >= cut).astype(np.int32), pa.int32())]

    return map_column(documents, "text", OUTPUT, fn)
