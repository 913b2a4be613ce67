"""Toxic documents by a support vector machine on a subsequence string kernel.

The kernel of two short strings sums, over all subsequences of three characters they share,
a decay to the power of the stretches these span (Lodhi et al., 2002), normalised to 1 for
equal strings; gaps and inserted characters only weaken it. Landmarks are stretches of words
that tell the labelled classes apart. A sentence is described by its best kernel value with
every landmark, whitened by the landmarks' own kernel matrix (Nyström), and scored by a linear
machine with squared hinge loss. A toxic document is one with a toxic sentence, so each round
of training takes the sentence of a toxic document found worst so far and all sentences of
clean ones (Andrews et al., 2003). Every training document is learnt from twice, as it is and by its
closest sentences with a letter inserted in each longer word: an inserted letter is then no sign of either class, and
what it weakens still lies on its side. A document scores as its worst sentence, through a
logistic curve fitted on all of these.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix.llm.common import filled, fresh, give_back, ready, sole_cache

WINDOW = 6
ORDER = 3
DECAY = 0.6
LANDMARKS = 96
CANDIDATES = 3_000
ALIKE = 0.85
FIT_DOCS = 2_500
FIT_SENTENCES = 24
ALTERED_SENTENCES = 8
INSERTED_FROM = 4
INSERTIONS = 8
MIN_DOCS = 3
ROUNDS = 3
RIDGE = 1e-4
SPELLED = 3
CACHE_WORDS = 160_000
CACHE_WINDOWS = 200_000
CHUNK = 256
GATHER_WORDS = 200_000
FIT_ROWS = 8_192
STEPS = 64
SENTENCE_ENDS = (".", "!", "?")

_combinations = np.array(list(combinations(range(WINDOW), ORDER)))
_weights = DECAY ** (_combinations[:, -1] - _combinations[:, 0] + 1.0)
_not_word = re.compile(r"[\W_]+")

_readers: dict[tuple[str, ...], Reader] = {}


def plain(word: str) -> str:
    """Letters and digits of a word in lower case."""
    return word if word.isalpha() and word.islower() else _not_word.sub("", word.lower())


def windows(word: str) -> list[str]:
    """All stretches of ``WINDOW`` characters of a word between spaces; a shorter one is its only one."""
    edged = f" {word} " if word else ""
    return [edged[i:i + WINDOW] for i in range(max(1, len(edged) - WINDOW + 1))]


def words_of(text: str) -> set[str]:
    return {w for w in map(plain, set(text.split())) if w}


def with_insertions(text: str) -> str:
    """The text with a letter inserted in every word of ``INSERTED_FROM`` or more characters.

    Place and letter follow from the word and one of ``INSERTIONS`` keys that the text picks, so
    a vocabulary has a bounded number of altered words.
    """
    key = zlib.crc32(text.encode()) % INSERTIONS

    def altered(word: str) -> str:
        if len(word) < INSERTED_FROM:
            return word
        draw = zlib.crc32(f"{key} {word}".encode())
        place = 1 + draw % (len(word) - 1)
        return word[:place] + chr(ord("a") + (draw >> 8) % 26) + word[place:]

    return "\n".join(" ".join(map(altered, line.split())) for line in text.split("\n"))


def codes_of(strings: Sequence[str]) -> np.ndarray:
    """The characters of strings of at most ``WINDOW`` characters, 0 past the end."""
    return np.array(strings, f"U{WINDOW}").view(np.uint32).reshape(-1, WINDOW)


def window_codes(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """What ``windows`` cuts each word into, as ``codes_of``, and the first window of each word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    text = "".join(f" {w} \0" for w in words) + "\0" * WINDOW
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum(sizes + 1) - sizes - 1
    counts = np.maximum(1, sizes - WINDOW + 1)
    firsts = np.cumsum(counts) - counts
    at = np.repeat(begins - firsts, counts) + np.arange(counts.sum())
    out = codes[at[:, None] + np.arange(WINDOW)]
    short = np.repeat(sizes < WINDOW, counts)
    out[short] = np.where(np.logical_or.accumulate(out[short] == 0, axis=1), 0, out[short])
    return out, firsts


def features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the subsequences of coded strings and their weights, 0 past the end."""
    picked = codes.astype(np.uint64)[:, _combinations]
    ids = picked[..., 0] | picked[..., 1] << np.uint64(21) | picked[..., 2] << np.uint64(42)
    return ids, np.where((picked > 0).all(axis=2), _weights, 0.0)


def _window_keys(codes: np.ndarray) -> np.ndarray:
    """64 bits that tell coded strings apart."""
    out = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for c in range(WINDOW):
            out = (out ^ codes[:, c]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def own_kernel(ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The kernel of each string with itself, equal subsequences added up."""
    total = np.zeros(len(ids))
    for a in range(ids.shape[1]):
        total += weights[:, a] * ((ids == ids[:, a:a + 1]) * weights).sum(axis=1)
    return total


class Kernel:
    """Normalised kernel values with fixed landmarks."""

    def __init__(self, landmarks: Sequence[str]):
        ids, weights = features(codes_of(landmarks))
        self.codes, place = np.unique(ids, return_inverse=True)
        self.table = np.zeros((len(self.codes) + 1, len(landmarks)), np.float32)
        norm = np.sqrt(np.maximum(own_kernel(ids, weights), 1e-12))
        rows = np.repeat(np.arange(len(landmarks)), ids.shape[1])
        np.add.at(self.table, (place.ravel(), rows), (weights / norm[:, None]).ravel())

    def __call__(self, strings: Sequence[str] | np.ndarray) -> np.ndarray:
        """One row per string (or row of codes), one column per landmark."""
        codes = strings if isinstance(strings, np.ndarray) else codes_of(strings)
        out = np.zeros((len(codes), self.table.shape[1]), np.float32)
        for at in range(0, len(codes), 20_000):
            ids, weights = features(codes[at:at + 20_000])
            found = np.minimum(np.searchsorted(self.codes, ids), len(self.codes) - 1)
            found = np.where(self.codes[found] == ids, found, len(self.codes))
            part = out[at:at + 20_000]
            for c in range(ids.shape[1]):
                part += weights[:, c:c + 1].astype(np.float32) * self.table[found[:, c]]
            norm = np.sqrt(own_kernel(ids, weights))
            part /= np.where(norm > 0, norm, 1.0)[:, None].astype(np.float32)
        return out


def largest(values: np.ndarray, rows: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The column-wise maximum of ``values[rows]`` over stretches that begin at ``firsts``.

    Stretches advance together, the longest first, so each step is one array operation; what
    a stretch holds beyond ``STEPS`` rows is reduced on its own, in parts of bounded size.
    """
    sizes = np.diff(np.append(firsts, len(rows)))
    order = np.argsort(-sizes, kind="stable")
    begins, left = firsts[order], sizes[order]
    out = values[rows[begins]]
    for k in range(1, min(STEPS, int(left[0]))):
        active = int(np.searchsorted(-left, -k))
        np.maximum(out[:active], values[rows[begins[:active] + k]], out=out[:active])
    for i in range(int(np.searchsorted(-left, -STEPS))):
        for at in range(begins[i] + STEPS, begins[i] + left[i], GATHER_WORDS):
            part = rows[at:min(at + GATHER_WORDS, begins[i] + left[i])]
            np.maximum(out[i], values[part].max(axis=0), out=out[i])
    back = np.empty_like(out)
    back[order] = out
    return back


class Rows:
    """A growing table of landmark values by key; row 0 is that of the empty key."""

    def __init__(self, width: int):
        self.rows: dict = {"": 0}
        self.values = np.zeros((1, width), np.uint8)

    def add(self, keys: list, values: np.ndarray) -> None:
        at, to = len(self.rows), len(self.rows) + len(keys)
        if to > len(self.values):
            grown = np.zeros((max(len(self.values) * 5 // 4, to), self.values.shape[1]), np.uint8)
            grown[:at] = self.values[:at]
            self.values = grown
        self.values[at:to] = values
        self.rows.update(zip(keys, range(at, to)))


class Reader:
    """Describes sentences by landmark; keeps the values of words it has met, in steps of 1/255.

    A token is a run without white space. Its code holds the row of its word, whether the
    word is a single character, and whether the token ends a sentence. Row 0 is that of no word.
    """

    def __init__(self, landmarks: Sequence[str]):
        self.kernel, self.width = Kernel(landmarks), len(landmarks)
        self.windows = Rows(self.width)
        self._forget()

    def _forget(self) -> None:
        self.tokens: dict[str, int] = {"": 0}
        self.words = Rows(self.width)

    def _learn_words(self, words: list[str]) -> None:
        codes, firsts = window_codes(words)
        if len(self.windows.rows) > CACHE_WINDOWS:
            self.windows = Rows(self.width)
        keys, place, number = np.unique(_window_keys(codes), return_index=True, return_inverse=True)
        found = [self.windows.rows.get(k) for k in keys.tolist()]
        new = [i for i, f in enumerate(found) if f is None]
        if new:
            values = np.rint(255 * np.minimum(1.0, self.kernel(codes[place[new]]))).astype(np.uint8)
            self.windows.add(keys[new].tolist(), values)
            found = [self.windows.rows[k] for k in keys.tolist()]
        self.words.add(words, largest(self.windows.values, np.array(found, np.int64)[number], firsts))

    def _learn_tokens(self, tokens: set[str]) -> None:
        new = tokens.difference(self.tokens)
        if len(self.tokens) + len(new) > CACHE_WORDS:
            self._forget()
            new = tokens.difference(self.tokens)
        words = {t: plain(t) for t in new}
        if missing := list(set(words.values()).difference(self.words.rows)):
            self._learn_words(missing)
        for t, w in words.items():
            self.tokens[t] = self.words.rows[w] << 2 | (len(w) == 1) << 1 | (t[-1:] in SENTENCE_ENDS)

    def _join_spelled(self, code: np.ndarray, flat: list[str], line: np.ndarray) -> np.ndarray:
        """The rows of the tokens; three or more single characters in a row of a line are one word.

        Tokens without letters and digits between them are passed over.
        """
        rows = code >> 2
        single = np.flatnonzero(code & 2)
        if len(single) < SPELLED:
            return rows
        place, own_line = np.cumsum(rows > 0)[single], line[single]
        begins = np.flatnonzero(np.append(True, (np.diff(place) > 1) | (np.diff(own_line) > 0)))
        sizes = np.diff(np.append(begins, len(single)))
        long = sizes >= SPELLED
        runs = [single[b:b + n] for b, n in zip(begins[long].tolist(), sizes[long].tolist())]
        spelled = ["".join(plain(flat[i]) for i in run) for run in runs]
        if missing := list(set(spelled).difference(self.words.rows)):
            self._learn_words(missing)
        for run, word in zip(runs, spelled):
            rows[run] = 0
            rows[run[0]] = self.words.rows[word]
        return rows

    def describe(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of landmark values, one per sentence, and the first row of each text.

        Lines end sentences too. A text without words has one row of zeros.
        """
        lines: list[list[str]] = []
        first_line = []
        for text in texts:
            first_line.append(len(lines))
            lines += [tokens for part in text.split("\n") if (tokens := part.split())] or [[""]]
        flat = list(chain.from_iterable(lines))
        self._learn_tokens(set(flat))
        code = np.fromiter(map(self.tokens.__getitem__, flat), np.int64, len(flat))
        sizes = np.fromiter(map(len, lines), np.int64, len(lines))
        begins = np.cumsum(sizes) - sizes
        starts = np.zeros(len(flat), bool)
        starts[1:] = code[:-1] & 1
        starts[begins] = True
        rows = self._join_spelled(code, flat, np.repeat(np.arange(len(lines)), sizes))
        starts = np.flatnonzero(starts)
        return largest(self.words.values, rows, starts), np.searchsorted(starts, begins[first_line])


def reader(landmarks: Sequence[str]) -> Reader:
    key = tuple(landmarks)
    sole_cache("toxicity", _readers.clear)
    if key not in _readers:
        _readers.clear()
        _readers[key] = Reader(key)
    return _readers[key]


@dataclass(frozen=True)
class Model:
    """``sigmoid(slope * (max over sentences of values @ weights + bias) + offset)``."""

    landmarks: tuple[str, ...]
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        if not self.landmarks:
            return np.full(len(texts), _sigmoid(np.array(self.offset)))
        rows, firsts = reader(self.landmarks).describe(texts)
        worst = np.maximum.reduceat(rows.astype(np.float32) @ self.weights + self.bias, firsts)
        return _sigmoid(self.slope * worst.astype(np.float64) + self.offset)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def held_out(id_col: str) -> Column:
    """Rows that no label is learnt from: the CRC-32 of the id as text is a multiple of 5."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                  fit_docs: int) -> tuple[DataFrame, float]:
    """``id, text, toxic`` of about ``fit_docs`` labelled documents of each class, at most twice that,
    and the share of toxic ones among all labels to learn from.

    Drawn by a hash of the id among those not held out. A document with labels of both
    classes counts as toxic.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(
        F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).limit(10).collect()}
    draw = F.pmod(F.xxhash64(F.lit(8), F.col("id")), F.lit(1 << 30))
    drawn = None
    for toxic in (0, 1):
        share = min(1.0, fit_docs / max(1, sizes.get(toxic, 0)))
        part = known.where((F.col("toxic") == toxic) & (draw < int(share * (1 << 30)))).limit(2 * fit_docs)
        drawn = part if drawn is None else drawn.union(part)
    texts = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    return texts.join(F.broadcast(drawn), "id"), share


def choose_landmarks(rows: DataFrame, wanted: int) -> tuple[list[str], int]:
    """Word stretches with the largest weight of evidence for a class, no two much alike.

    Those that speak for toxicity come first; their number comes with them.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = list({x for w in words_of(text) if len(w) >= ORDER for x in windows(w)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array([toxic] * len(found), pa.int32())], ["window", "toxic"])

    sizes = rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    if not sizes[0] or not sizes[1]:
        return [], 0
    counts = rows.select("text", "toxic").mapInArrow(cut, "window string, toxic int").groupBy("window").agg(
        F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n")).where(F.col("p") + F.col("n") >= MIN_DOCS)
    ratio = F.log((F.col("p") + 0.5) / (sizes[0] + 1)) - F.log((F.col("n") + 0.5) / (sizes[1] + 1))
    table = counts.withColumns({
        "evidence": F.abs(ratio) * (F.col("p") / sizes[0] + F.col("n") / sizes[1]), "toxic": ratio > 0,
    }).orderBy(F.desc("evidence"), "window").limit(CANDIDATES).select("window", "toxic").toArrow()
    best, speaks = table["window"].to_pylist(), table["toxic"].to_pylist()
    chosen = sorted(unlike(best, wanted), key=lambda i: (not speaks[i], i))
    return [best[i] for i in chosen], sum(speaks[i] for i in chosen)


def unlike(strings: Sequence[str], wanted: int) -> list[int]:
    """The numbers of the first ``wanted`` strings that are not much alike to an earlier one of them.

    What is left is compared with its first ``LANDMARKS`` strings at a time, never all with all.
    """
    codes, left = codes_of(strings), np.arange(len(strings))
    chosen: list[int] = []
    while len(left) and len(chosen) < wanted:
        block = left[:LANDMARKS]
        alike = Kernel([strings[i] for i in block])(codes[left]) >= ALIKE
        free = np.ones(len(left), bool)
        for k, i in enumerate(block.tolist()):
            if free[k] and len(chosen) < wanted:
                chosen.append(i)
                free &= ~alike[:, k]
        left = left[len(block):][free[len(block):]]
    return chosen


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", landmarks: int = LANDMARKS, fit_docs: int = FIT_DOCS) -> Model:
    """Learn from at most ``2 * fit_docs`` labelled documents of each class.

    Of a training document up to ``FIT_SENTENCES`` sentences are used, those closest to the
    landmarks of toxicity, and ``ALTERED_SENTENCES`` of these again with inserted letters. With labels
    of one class only, or none, every text gets that class' share.
    """
    ready(docs.sparkSession)
    rows, share = training_rows(docs, labels, id_col, text_col, label_col, fit_docs)
    # the few thousand rows of the fit are read twice
    rows = rows.persist()
    try:
        found, toxic_marks = choose_landmarks(rows, landmarks)
        picked, marks = tuple(found), max(1, toxic_marks)
        if not picked:
            share = min(max(share, 1e-3), 1 - 1e-3)
            return Model((), np.zeros(0, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(at, CHUNK)
                    texts = part.column(0).to_pylist()
                    bags, closest = nearest_sentences(picked, marks, texts, FIT_SENTENCES)
                    altered = ["\n".join(sentences_of(t)[i] for i in found[:ALTERED_SENTENCES])
                               for t, found in zip(texts, closest)]
                    again, _ = nearest_sentences(picked, marks, [*map(with_insertions, altered)], ALTERED_SENTENCES)
                    for found in (bags, again):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(found, pa.binary()), part.column(1)], ["bag", "toxic"])
            give_back()

        table = rows.select("text", "toxic").mapInArrow(describe, "bag binary, toxic int").toArrow()
    finally:
        rows.unpersist()
    bags = [np.frombuffer(b, np.uint8).reshape(-1, len(picked)) for b in table["bag"].to_pylist()]
    toxic = np.array(table["toxic"].to_pylist())
    del table
    model = train(picked, bags, toxic, share, marks)
    give_back()
    return model


def sentences_of(text: str) -> list[str]:
    """What ``Reader.describe`` has a row for."""
    out = []
    for line in text.split("\n"):
        tokens = line.split()
        ends = [i + 1 for i, t in enumerate(tokens) if t[-1] in SENTENCE_ENDS or i == len(tokens) - 1]
        out += [" ".join(tokens[a:b]) for a, b in zip([0, *ends], ends)]
    return out or [""]


def nearest_sentences(landmarks: tuple[str, ...], marks: int, texts: Sequence[str],
                      most: int) -> tuple[list[bytes], list[list[int]]]:
    """Different rows of each text, the ``most`` closest to the first ``marks`` landmarks, and their numbers."""
    values, firsts = reader(landmarks).describe(texts)
    bags, numbers = [], []
    for a, b in zip(firsts, [*firsts[1:], len(values)]):
        bag, number = np.unique(values[a:b], axis=0, return_index=True)
        close = np.argsort(-bag[:, :marks].max(axis=1), kind="stable")[:most]
        bags.append(bag[close].tobytes())
        numbers.append(number[close].tolist())
    return bags, numbers


def train(landmarks: tuple[str, ...], bags: Sequence[np.ndarray], toxic: np.ndarray, share: float,
          marks: int) -> Model:
    """Alternate the choice of worst sentences and the fit; then fit the logistic curve.

    ``share`` is the part of toxic documents among all that are labelled; the curve follows it.
    The first choice of sentences goes by the first ``marks`` landmarks.
    """
    values = np.linalg.eigh(Kernel(landmarks)(landmarks).astype(np.float64))
    root = values[1] / np.sqrt(np.maximum(values[0], 1e-3))  # Nyström: inverse root of the kernel matrix
    firsts = np.cumsum([0, *map(len, bags)])[:-1]
    x = np.concatenate(bags)
    owner = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    clean = toxic[owner] == 0
    score = x[:, :marks].max(axis=1).astype(np.float64)
    for _ in range(ROUNDS):
        worst = np.array([a + int(np.argmax(score[a:b])) for a, b in zip(firsts, [*firsts[1:], len(x)])])
        rows = clean.copy()
        rows[worst] = True
        weights, bias = squared_hinge(x, rows, clean, root / 255.0)
        score = products(x, weights) + bias
    best = np.maximum.reduceat(score, firsts)
    slope, offset = logistic_curve(best, toxic, share)
    return Model(landmarks, weights.astype(np.float32), float(bias), slope, offset)


def products(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``x @ weights``; of the bytes in ``x`` only ``FIT_ROWS`` rows at a time become doubles."""
    out = np.empty(len(x))
    for at in range(0, len(x), FIT_ROWS):
        out[at:at + FIT_ROWS] = x[at:at + FIT_ROWS].astype(np.float64) @ weights
    return out


def moments(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of the outer products of the marked rows, each with a 1 behind it: of bytes, so it is exact."""
    places = np.flatnonzero(rows)
    part = np.ones((min(FIT_ROWS, len(places)), x.shape[1] + 1))
    total = np.zeros((x.shape[1] + 1, x.shape[1] + 1))
    for at in range(0, len(places), FIT_ROWS):
        picked = places[at:at + FIT_ROWS]
        part[:len(picked), :-1] = x[picked]
        total += part[:len(picked)].T @ part[:len(picked)]
    return total


def squared_hinge(x: np.ndarray, rows: np.ndarray, clean: np.ndarray, root: np.ndarray,
                  rounds: int = 50) -> tuple[np.ndarray, float]:
    """Linear machine on the marked rows of ``x @ root`` by Newton steps on its margin violators.

    Both classes weigh the same. Returns the weights of the columns of ``x``. The rows stay bytes: a
    step needs the sums of the violators' outer products only, which are turned by ``root`` at the end.
    """
    turn = np.eye(len(root) + 1)
    turn[:-1, :-1] = root
    weight = {c: 0.5 / max(1, (rows & (clean == c)).sum()) for c in (False, True)}
    ridge = RIDGE * np.eye(len(turn))
    ridge[-1, -1] = 1e-9
    sign = np.where(clean, -1.0, 1.0)
    w = np.zeros(len(turn))
    inside = rows
    for _ in range(rounds):
        above, below = (weight[c] * moments(x, inside & (clean == c)) for c in (False, True))
        w = turn @ np.linalg.solve(ridge + turn.T @ (above + below) @ turn, turn.T @ (above[-1] - below[-1]))
        now = rows & (sign * (products(x, w[:-1]) + w[-1]) < 1)
        if (now == inside).all() or not now.any():
            break
        inside = now
    return w[:-1], float(w[-1])


def logistic_curve(score: np.ndarray, toxic: np.ndarray, share: float, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of the class over the score, with Platt's softened targets, by Newton steps."""
    positive, negative = (toxic == 1).sum(), (toxic == 0).sum()
    target = np.where(toxic == 1, (positive + 1.0) / (positive + 2.0), 1.0 / (negative + 2.0))
    # the sample is drawn by class
    weight = np.where(toxic == 1, share / max(1, positive), (1 - share) / max(1, negative))
    design = np.stack([score, np.ones(len(score))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = _sigmoid(design @ theta)
        gradient = design.T @ (weight * (p - target)) + 1e-6 * theta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta = theta - step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 1e-6)), float(theta[1])


def with_scores(docs: DataFrame, model: Model, text_col: str, out: str) -> DataFrame:
    """Add the score of every whole text; missing texts score as empty ones."""
    ready(docs.sparkSession)
    at = docs.columns.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK):
                part = batch.slice(begin, CHUNK)
                found = model.scores([t or "" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.float64())], [*part.schema.names, out])
        give_back()

    from pyspark.sql import types as T
    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", id_col: str = "doc_id",
               threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more. Rows without text are kept or
    dropped as empty texts score; repeated rows share their fate; an empty table stays empty."""
    score = fresh(docs, "_score")
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    return with_scores(docs, model, text_col, score).where(F.col(score) < threshold).drop(score)
