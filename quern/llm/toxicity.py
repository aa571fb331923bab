"""Toxicity: a support vector machine on a gap-weighted subsequence kernel of sentences.

The kernel of two words sums, over the three-letter subsequences that they share, a decay to the
power of the spans, so inserted characters and gaps weaken a match but don't undo it; that of two
sentences sums it over their words. Labels mark whole texts, so the machine learns in rounds which
sentences of a toxic text are the toxic ones: those that it finds most toxic itself. Nyström
landmarks, drawn from the sentences, turn the kernel into features for a linear machine. Its
decision is a weighted sum of kernels to landmarks, so it collapses into one weight for each
subsequence, and scoring is a table look-up at every position of a text, over all gaps, in numpy.
A document's score is a logistic function of its most toxic sentence and of how many there are.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quern.llm.storage import materialize

DECAY = 0.6
#: The longest span of a subsequence, in characters.
SPAN = 6
#: Letters of a word that are scored together; longer ones are scored in stretches of this length.
STRETCH = 20
#: Words of a sentence that are judged together; longer sentences are taken in stretches.
WORDS = 5
LANDMARKS = 500
COST, ROUNDS = 4.0, 3
#: Sentences of a text that its first round learns from, and its witnesses in later ones.
FIRST, WITNESSES = 12, 4
#: Margin from which a sentence adds to its text's score.
MARGIN = 0.0
#: Margins beyond this say no more.
LARGE = 3.0
#: Parts of the labelled texts; each is judged for the logistic function by a machine of the others.
FOLDS = 3
#: Labelled documents learnt from: at most so many of each label, none longer than so many characters.
SAMPLE, SAMPLE_CHARS = 2000, 8_000
#: Characters scored at once.
CHUNK = 1 << 18
SEPARATOR, SYMBOLS = 63, 64
STOPS = np.array([ord(c) for c in ".!?"], dtype="<u4")


def _symbol_table() -> np.ndarray:
    """Symbol of each code point of lower-cased text: 0 dropped, 1-26 letters, 27 digits, 28-62
    other letters by their number, 63 white space."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for cp in range(0x20000):
        c = chr(cp)
        if "a" <= c <= "z":
            table[cp] = cp - 96
        elif c.isdigit():
            table[cp] = 27
        elif c.isspace():
            table[cp] = SEPARATOR
        elif c.isalpha():
            table[cp] = 28 + cp % 35
    table[0x20000:0x32000] = 28
    return table


_TABLE: list[np.ndarray] = []
#: Factors of the places in a word, for a digest of its symbols.
POWERS = np.cumprod(np.full(2 * STRETCH + 2, 0x9E3779B1, dtype=np.uint64)).astype(np.uint32)


class Words:
    """Texts as symbols, each text and word led by a separator; ``starts`` has the place of each
    word's separator, ``lengths`` its letters, ``sentence`` its sentence's number, and ``first`` the
    first sentence of each text.

    Punctuation is dropped, so that marks inside a word don't part it; runs of words of one letter
    are joined, so that a spelt-out word is one. A sentence ends at a line's end, or at a stop that
    white space follows.
    """

    def __init__(self, texts: list[str]):
        if not _TABLE:
            _TABLE.append(_symbol_table())
        lowered = ["\n" + t.lower() for t in texts]
        raw = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), dtype="<u4")
        head = np.zeros(len(raw), dtype=bool)
        head[np.cumsum([0, *map(len, lowered)])[:-1]] = True
        s = _TABLE[0][raw]
        ends = raw == 10
        ends[1:] |= np.isin(raw[:-1], STOPS)
        kept = s != 0
        s, head, ends = s[kept], head[kept], ends[kept]
        space = s == SEPARATOR
        again = space & ~head
        again[1:] &= space[:-1]
        runs = np.flatnonzero(~again)
        ends = np.logical_or.reduceat(ends & space, runs)
        s, head = s[runs], head[runs]
        spots = np.flatnonzero(s == SEPARATOR)
        lone = np.diff(spots, append=len(s)) == 2
        join = np.zeros(len(spots), dtype=bool)
        join[1:] = lone[1:] & lone[:-1]
        join &= ~head[spots] & ~ends[spots]
        if join.any():
            stay = np.ones(len(s), dtype=bool)
            stay[spots[join]] = False
            s, head, ends = s[stay], head[stay], ends[stay]
        spots = np.flatnonzero(s == SEPARATOR)
        lengths = np.diff(spots, append=len(s)) - 1
        opens, heads = ends[spots] | head[spots], head[spots]
        if (lengths > STRETCH).any():  # long words in stretches
            pieces = np.maximum(1, -(-lengths // STRETCH))
            owner = np.repeat(np.arange(len(spots)), pieces)
            rank = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            lengths = np.minimum(STRETCH, lengths[owner] - rank * STRETCH)
            spots = spots[owner] + rank * STRETCH + (rank > 0)
            opens, heads = opens[owner] & (rank == 0), heads[owner] & (rank == 0)
        begins = np.flatnonzero(opens)
        within = np.arange(len(spots)) - np.repeat(begins, np.diff(begins, append=len(spots)))
        self.symbols, self.starts, self.lengths = s, spots.astype(np.int32), lengths.astype(np.int32)
        self.sentence = np.cumsum(within % WORDS == 0, dtype=np.int32) - 1
        self.first = self.sentence[heads]

    def norms(self) -> np.ndarray:
        """The norm of every sentence, as if its words were alike only where they are equal: the root
        of the number of equal pairs, each word with itself among them; 0 without a word."""
        full = self.lengths > 0
        spot = np.arange(len(self.symbols)) - np.repeat(self.starts, np.diff(self.starts, append=len(self.symbols)))
        digest = np.add.reduceat(self.symbols * POWERS[spot], self.starts) if len(self.starts) else np.empty(0)
        pairs = np.bincount(self.sentence, weights=full, minlength=self.sentences)
        for d in range(1, WORDS):
            same = (digest[d:] == digest[:-d]) & (self.sentence[d:] == self.sentence[:-d]) & full[d:]
            pairs += 2 * np.bincount(self.sentence[d:][same], minlength=self.sentences)
        return np.sqrt(pairs)

    @property
    def sentences(self) -> int:
        return int(self.sentence[-1]) + 1 if len(self.sentence) else 0

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last symbol's place of every sentence."""
        firsts = np.flatnonzero(np.diff(self.sentence, prepend=-1))
        lo = self.starts[firsts]
        return lo, np.append(lo[1:], len(self.symbols))


def _combos(s: np.ndarray):
    """(weight, count, codes, ok) of the subsequences of each span: codes is a list over the place
    of the middle symbol; ok where no separator lies inside."""
    a, b, c = s.astype(np.int32) * (SYMBOLS * SYMBOLS), s.astype(np.int32) * SYMBOLS, s.astype(np.int32)
    seps = np.cumsum(s == SEPARATOR, dtype=np.int32)
    for reach in range(2, SPAN):
        n = len(s) - reach
        if n <= 0:
            return
        ok = seps[reach - 1 : reach - 1 + n] == seps[:n]
        yield DECAY ** (reach + 1), n, [a[:n] + b[m : m + n] + c[reach : reach + n] for m in range(1, reach)], ok


def _norms() -> np.ndarray:
    """The kernel norm of a word by its length, as if its subsequences were distinct."""
    out = np.full(4 * STRETCH, np.inf)
    for n in range(1, len(out)):
        size = n + 2
        out[n] = np.sqrt(sum((r - 1) * max(0, size - r) * DECAY ** (2 * (r + 1)) for r in range(2, SPAN))) or np.inf
    return out


NORMS = _norms()


class Features:
    """Sentences' kernel features in rows: codes, values, and where each sentence's begin."""

    def __init__(self, texts: Words):
        s = np.append(texts.symbols, np.uint8(SEPARATOR))
        scale = np.where(texts.lengths > 0, 1 / NORMS[texts.lengths], 0.0)
        word = np.repeat(np.arange(len(texts.starts)), np.diff(texts.starts, append=len(texts.symbols)))
        rows, values = [], []
        for weight, n, codes, ok in _combos(s):
            at = np.flatnonzero(ok)
            own = word[at]
            for code in codes:
                rows.append(texts.sentence[own].astype(np.int64) * SYMBOLS**3 + code[at])
                values.append((weight * scale[own]).astype(np.float32))
        keys, place = np.unique(np.concatenate([np.empty(0, np.int64), *rows]), return_inverse=True)
        self.values = np.bincount(place, weights=np.concatenate([np.empty(0, np.float32), *values]), minlength=len(keys)).astype(np.float32)
        self.codes = (keys % SYMBOLS**3).astype(np.int32)
        self.begins = np.searchsorted(keys // SYMBOLS**3, np.arange(texts.sentences + 1))
        self.values /= np.repeat(np.maximum(1, texts.norms()), np.diff(self.begins)).astype(np.float32)

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.begins[i], self.begins[i + 1])
        return self.codes[at], self.values[at]

    def times(self, table: np.ndarray, index: np.ndarray) -> np.ndarray:
        """The features times ``table``, whose rows belong to the codes by ``index`` (-1: none)."""
        out = np.zeros((len(self.begins) - 1, table.shape[1]), dtype=np.float32)
        for i in range(len(out)):
            codes, values = self.row(i)
            places = index[codes]
            held = places >= 0
            out[i] = values[held] @ table[places[held]]
        return out


class Model:
    """Subsequence weights, bias, and the logistic weights of a document's facts."""

    def __init__(self, weights: np.ndarray, bias: float, logistic: np.ndarray | None = None):
        self.weights, self.bias, self.logistic = weights.astype(np.float32), float(bias), logistic

    def margins(self, texts: Words) -> np.ndarray:
        """The margin of every sentence; that of one without a word is -1."""
        s = np.append(texts.symbols, np.uint8(SEPARATOR))
        total = np.zeros(len(texts.symbols), dtype=np.float32)
        for lo in range(0, len(total), CHUNK):
            part = s[lo : lo + CHUNK + SPAN - 1]
            for weight, n, codes, ok in _combos(part):
                n = min(n, CHUNK, len(total) - lo)
                got = self.weights[codes[0][:n]]
                for code in codes[1:]:
                    got = got + self.weights[code[:n]]
                total[lo : lo + n] += np.float32(weight) * got * ok[:n]
        full = texts.lengths > 0
        by_word = np.where(full, np.add.reduceat(total, texts.starts) / NORMS[np.maximum(1, texts.lengths)], 0.0)
        norms = texts.norms()
        sums = np.bincount(texts.sentence, weights=by_word, minlength=texts.sentences)
        return np.where(norms > 0, self.bias + sums / np.maximum(1, norms), -1.0)

    def facts(self, texts: Words) -> np.ndarray:
        """For each text: its largest sentence margin, within -LARGE and LARGE, and the logarithm of 1 + the
        sum of what its sentences' margins, at most LARGE, have above MARGIN."""
        margins = self.margins(texts)
        over = np.clip(margins, MARGIN, LARGE) - MARGIN
        return np.column_stack([np.clip(np.maximum.reduceat(margins, texts.first), -LARGE, LARGE), np.log1p(np.add.reduceat(over, texts.first))])

    def score(self, texts: list[str]) -> np.ndarray:
        z = np.column_stack([self.facts(Words(texts)), np.ones(len(texts))]) @ self.logistic
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, weights=self.weights, bias=self.bias, logistic=self.logistic)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Model:
        parts = np.load(io.BytesIO(raw))
        return cls(parts["weights"], float(parts["bias"]), parts["logistic"])


def _newton_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Squared-hinge support vector machine in the primal; the last column of x is the bias."""
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        xs, cs = x[inside], cost[inside]
        new = np.linalg.solve(ridge + (xs * cs[:, None]).T @ xs, (xs * cs[:, None]).T @ y[inside])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    return w


def _monotone(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights, none negative but the last's: more of a fact never lowers the score. The
    most negative fact is left out until none is."""
    used = list(range(x.shape[1]))
    while True:
        w = _logistic(x[:, used], y)
        worst = int(np.argmin(w[:-1])) if len(used) > 1 else -1
        if worst < 0 or w[worst] >= 0:
            out = np.zeros(x.shape[1])
            out[used] = w
            return out
        used.pop(worst)


def without_copies(rows: list[tuple[str, int]], words: int = 5) -> list[tuple[str, int]]:
    """The rows but for those of which half the word shingles or more stood in rows before them.

    Copies of one toxic text would make its harmless sentences look toxic."""
    seen: set[int] = set()
    out = []
    for text, y in rows:
        w = re.findall(r"\w+", text)
        shingles = {hash(tuple(w[i : i + words])) for i in range(max(1, len(w) - words + 1))}
        if 2 * len(shingles - seen) > len(shingles):
            out.append((text, y))
        seen |= shingles
    return out


class Bags:
    """Labelled texts as groups of symbols, of which sentences can be drawn by number."""

    def __init__(self, rows: list[tuple[str, int]], group: int = 200):
        self.groups = [Words([t for t, _ in rows[k : k + group]]) for k in range(0, len(rows), group)]
        self.labels = np.array([y for _, y in rows])
        sizes = [np.diff(g.first, append=g.sentences) for g in self.groups]
        self.sizes = np.concatenate(sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.offsets = np.cumsum([0, *(g.sentences for g in self.groups)])

    def margins(self, model: Model) -> np.ndarray:
        return np.concatenate([model.margins(g) for g in self.groups])

    def facts(self, model: Model) -> np.ndarray:
        return np.concatenate([model.facts(g) for g in self.groups])

    def features(self, sentences: np.ndarray) -> Features:
        """The features of sentences, given in ascending order."""
        parts, owner = [], []
        texts = Words.__new__(Words)
        starts, lengths, numbers, at, done = [], [], [], 0, 0
        for g, words in enumerate(self.groups):
            own = sentences[(sentences >= self.offsets[g]) & (sentences < self.offsets[g + 1])] - self.offsets[g]
            lo, hi = words.spans()
            bounds = np.searchsorted(words.sentence, np.arange(words.sentences + 1))
            for k in own:
                w = slice(bounds[k], bounds[k + 1])
                piece = words.symbols[lo[k] : hi[k]]
                if piece[0] != SEPARATOR:  # the sentence begins within a long word
                    piece = np.concatenate([[np.uint8(SEPARATOR)], piece])
                    starts.append(np.maximum(words.starts[w] - lo[k] + 1 + at, at))
                    starts[-1][0] = at
                else:
                    starts.append(words.starts[w] - lo[k] + at)
                parts.append(piece)
                lengths.append(words.lengths[w])
                numbers.append(np.full(w.stop - w.start, done))
                at, done = at + len(piece), done + 1
        texts.symbols, texts.starts = np.concatenate(parts), np.concatenate(starts)
        texts.lengths, texts.sentence = np.concatenate(lengths), np.concatenate(numbers)
        return Features(texts)

    def best(self, margins: np.ndarray, label: int, n: int) -> np.ndarray:
        """The ``n`` sentences of highest margin of each text of a label."""
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        order = np.lexsort((np.arange(len(margins)), -margins, text))
        rank = np.arange(len(order)) - np.repeat(self.first, self.sizes)
        return order[(rank < n) & (self.labels[text] == label)]

    def spread(self, label: int, n: int) -> np.ndarray:
        """``n`` sentences at even distances of each text of a label."""
        own = self.labels == label
        at = (np.arange(n)[None, :] * self.sizes[own][:, None] // n + self.first[own][:, None]).reshape(-1)
        return np.unique(at)


def _thin(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` of the values, at even distances."""
    return values if len(values) <= most else values[np.arange(most) * len(values) // most]


def machine(bags: Bags, rounds: int = ROUNDS) -> Model:
    """Learn which sentences are toxic.

    In the first round sentences have their text's label. In further ones, the sentences that the
    machine finds most toxic in each toxic text are the toxic ones, and of other texts those that it
    took for the most toxic, with an even draw, are the clean ones.
    """
    if not 0 < bags.labels.sum() < len(bags.labels):
        return Model(np.zeros(SYMBOLS**3), -1.0)
    most = 2 * SAMPLE
    toxic, clean = bags.spread(1, FIRST), bags.spread(0, FIRST)
    model = None
    for k in range(rounds):
        if model is not None:
            margins = bags.margins(model)
            toxic = np.sort(bags.best(margins, 1, WITNESSES))
            clean = np.union1d(_thin(bags.best(margins, 0, 1), most), _thin(bags.spread(0, 2), most))
        toxic, clean = _thin(toxic, most), _thin(clean, 2 * most)
        model = _fit_sentences(bags.features(toxic), bags.features(clean))
    return model


def _fit_sentences(toxic: Features, clean: Features) -> Model:
    """The machine of toxic and clean sentences; landmarks are an even draw of either."""
    marks = [f.row(int(i)) for f in (toxic, clean) for i in _thin(np.arange(len(f.begins) - 1), LANDMARKS // 2)]
    codes = np.unique(np.concatenate([c for c, _ in marks]))
    index = np.full(SYMBOLS**3, -1, dtype=np.int32)
    index[codes] = np.arange(len(codes))
    landmark = np.zeros((len(codes), len(marks)), dtype=np.float32)
    for j, (c, v) in enumerate(marks):
        landmark[index[c], j] = v
    values, vectors = np.linalg.eigh(landmark.T.astype(float) @ landmark)
    good = values > 1e-5 * max(values.max(), 1e-12)
    half = (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)
    table = landmark @ half
    a, b = toxic.times(table, index), clean.times(table, index)
    n_toxic, n_clean = len(a), len(b)
    x = np.ones((n_toxic + n_clean, table.shape[1] + 1))  # filled in place: no second copy is held
    x[:n_toxic, :-1], x[n_toxic:, :-1] = a, b
    del a, b
    y = np.concatenate([np.ones(n_toxic), -np.ones(n_clean)])
    w = _newton_svm(x, y, np.where(y > 0, COST * min(10.0, max(1.0, n_clean / n_toxic)), COST))
    weights = np.zeros(SYMBOLS**3, dtype=np.float32)
    weights[codes] = table @ w[:-1]
    return Model(weights, w[-1])


def fit(rows: list[tuple[str, int]]) -> Model:
    """Learn from labelled texts.

    The logistic function is fitted on facts that each part of the texts gets from a machine of the
    others; the machine that stays has learnt from all. With one label alone, or none, every score
    is the same, on that label's side (none: clean).
    """
    rows = without_copies([(t.lower(), y) for t, y in rows])
    labels = np.array([y for _, y in rows], dtype=float)
    if not 0 < labels.sum() < len(labels):
        return Model(np.zeros(SYMBOLS**3), -1.0, np.array([0.0, 0.0, 5.0 if labels.sum() else -5.0]))
    facts = np.zeros((len(rows), 2))
    place = np.arange(len(rows))
    for label in (0, 1):  # either label is dealt out evenly
        place[labels == label] = np.arange(int((labels == label).sum()))
    for part in range(FOLDS):
        held = place % FOLDS == part
        if held.any() and not held.all():
            learnt = machine(Bags([r for r, h in zip(rows, held) if not h]))
            facts[held] = Bags([r for r, h in zip(rows, held) if h]).facts(learnt)
    model = machine(Bags(rows))
    model.logistic = _monotone(np.column_stack([facts, np.ones(len(facts))]), labels)
    return model


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, most_chars: int = SAMPLE_CHARS) -> Model:
    """Fit on a bounded sample of labelled rows: by the order of a hash of the key, ``sample`` of
    label 1 and twice as many of label 0, of which texts up to ``most_chars`` characters are used.

    Rows of ``labels`` with a null key or label are left out; the bounded sample is broadcast. The
    texts go to one task, which returns the fitted weights alone, so the driver never holds them.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).distinct()
    order = (F.xxhash64("_key"), "_key", "_label")
    chosen = usable.filter("_label = 1").orderBy(*order).limit(sample).union(usable.filter("_label = 0").orderBy(*order).limit(2 * sample))
    known = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), F.col("_id") == F.col("_key")).filter(F.length("_text") <= most_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([fit(sorted(rows)).dump()], pa.binary())], names=["model"])

    # written first, so that a lost executor repeats the fit and not the scan
    rows = materialize(known.select("_text", "_label"), "toxicity-sample")
    found = rows.repartition(1).mapInArrow(run, "model binary").first()
    return Model.load(found["model"]) if found else fit([])


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", out: str = "score") -> DataFrame:
    """Columns ``keep`` and ``out`` (0 to 1, toxic likelier when higher) of every row's whole text.

    Null texts count as empty and get the score of a text without a word. Repeated rows stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores: list[float] = []
            group: list[str] = []
            size = 0
            for t in batch.column(len(keep)):
                group.append(t.as_py() or "")
                size += len(group[-1])
                if size >= 4 * CHUNK:
                    scores += model.score(group).tolist()
                    group, size = [], 0
            if group:
                scores += model.score(group).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(scores, pa.float64())], names=[*keep, out])

    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField(out, T.DoubleType())])
    return docs.select(*keep, F.col(text).alias("_body")).mapInArrow(run, schema)


def remainder(key: Column, n: int) -> Column:
    """CRC-32 of the key as text (null: empty), modulo n."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n
