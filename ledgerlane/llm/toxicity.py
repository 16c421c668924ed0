"""Toxicity: a support vector machine over a string-subsequence kernel, with Nystroem landmarks.

A text is cut into units: words in lower case without digits and punctuation, and runs of single letters joined into one
(``i d i o t``). Letters are code points of any script; runs of a script written without spaces are cut into all their pieces of
``PIECES`` letters. The kernel of two units counts the subsequences of ``ORDER`` letters they share, also with gaps, each weighted
by ``DECAY`` per letter left out, at most ``SPAN`` letters wide and with the unit's borders as letters, normalised to 1 for equal units. So a gap or an
inserted letter keeps most of the kernel.

Training takes labelled sentences: those of toxic documents are bags of which some unit is the cause, those of other documents have none. The
kernel is approximated by its values at landmark units; a linear machine with squared hinge loss is fitted on the
mapped units, causes are chosen anew by its decision, and it is fitted again. As the mapped machine is linear in the
subsequences, it becomes one table of subsequence weights. A logistic curve over the two highest decisions of a document's units and the logarithm of how
often units with a positive decision stand in it, fitted on whole labelled documents, gives its score.

NULL, empty texts and texts without letters have no unit and get the score of the lowest decisions. Without labelled documents of
both classes every score is the share of label 1 (0.5 without labels). Rows without an id are scored and are not held out. A
repeated row is scored each time. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from heapq import nlargest
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import chunks, drop_rows, ship, texts_of
from ledgerlane.llm.training import held_out, labelled_sample

#: Training bound: documents a class, of which all sentences count; and units a sentence, longer ones are cut.
DOCUMENTS, UNITS = 1500, 24
LANDMARKS = 256
#: Letters of a unit that are compared at once; longer units are cut into overlapping pieces.
LONGEST = 24
ORDER, SPAN, DECAY = 3, 5, 0.6
#: Standard errors by which a unit must be more frequent in toxic documents to be taken for a first cause.
EVIDENCE = 4.0
#: Times that it must be more frequent there.
RATIO = 4.0
#: Words without evidence that the machine is fitted on, and its penalty on large weights.
OTHERS, RIDGE = 12_000, 1e-5
#: Rounds of fitting, and how much more a word counts that was mistaken for a cause.
ROUNDS, HARD = 5, 100.0
#: Beyond these a unit's decision says no more.
LOWEST, HIGHEST = -2.0, 1.0
REMEMBERED = 400_000

#: Sizes of the pieces of a run of a script without spaces.
PIECES = (2, 3, 4)

_TABLE = bytes(ord(chr(c).lower()) if c < 128 else c for c in range(256))
_DELETE = bytes(c for c in range(128) if not chr(c).isalpha() and c not in b" \t\n\x0b\x0c\r")
_SPELLED = re.compile(r"(?<!\S)\S(?:\s+\S(?!\S)){2,}")
#: Thai, Lao, Tibetan, Burmese, Khmer, Kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")


class _Letters(dict):
    """Letters and marks stay, ASCII digits and punctuation go, anything else parts words."""

    def __missing__(self, code: int) -> str:
        sort = unicodedata.category(chr(code))[0]
        self[code] = found = chr(code) if sort in "LM" else "" if code < 128 and code in _DELETE else " "
        return found


_KEPT = _Letters()
_SENTENCE = re.compile("[.!?\n]+|(?:\u3002|\uff01|\uff1f|\u061f|\u06d4|\u0964)+".encode())
_SPACE = re.compile(r"\s+")


def _letters(text: bytes) -> str:
    """A text's letters and white space."""
    return text.translate(_TABLE, _DELETE).decode() if text.isascii() else text.decode("utf-8", "replace").lower().translate(_KEPT)


def _parts(unit: str) -> list[str]:
    """What a word is compared as: itself, pieces of runs without spaces, overlapping pieces of long ones."""
    found = [unit]
    if not unit.isascii() and _UNSPACED.search(unit):
        found = _UNSPACED.sub(" ", unit).split()
        for run in _UNSPACED.findall(unit):
            found += [run[k : k + size] for size in PIECES for k in range(max(1, len(run) - size + 1))]
    if max(map(len, found), default=0) <= LONGEST:
        return found
    short = [part for part in found if len(part) <= LONGEST]
    long = [part for part in found if len(part) > LONGEST]
    return short + [part[k : k + LONGEST] for part in long for k in range(0, len(part) - LONGEST // 2, LONGEST // 2)]


def _spelled(plain: str) -> list[str]:
    return [_SPACE.sub("", run.group()) for run in _SPELLED.finditer(plain)]


def units(text: bytes) -> set[bytes]:
    """The distinct units of a text."""
    plain = _letters(text)
    found = set(plain.split())
    found.update(_spelled(plain))
    if not plain.isascii() or max(map(len, found), default=0) > LONGEST:
        found = {part for unit in found for part in _parts(unit)}
    return {unit.encode() for unit in found}


def occurrences(text: bytes, wanted: set[bytes]) -> int:
    """How many words, and words spelled letter by letter, of a text hold one of the given units."""
    plain, some = _letters(text), {unit.decode() for unit in wanted}
    times = Counter(plain.split())
    times.update(_spelled(plain))
    return sum(n for unit, n in times.items() if not some.isdisjoint(_parts(unit)))


def subsequences(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length of word: the words' places in the list, codes of their subsequences (a row each), and weights divided by the norm."""
    words = [word.decode() for word in words]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        letters = np.zeros((len(places), size + 2), np.int64)  # code points, 0 for the border
        letters[:, 1:-1] = np.frombuffer("".join(words[k] for k in places).encode("utf-32-le"), "<u4").reshape(len(places), size)
        codes, weights = [], []
        for offsets in combinations(range(1, SPAN), ORDER - 1):
            for k in range(size + 2 - offsets[-1]):
                code = letters[:, k]
                for offset in offsets:
                    code = (code << 21) | letters[:, k + offset]  # a code point has 21 bits, so codes are exact
                codes.append(code)
                weights.append(DECAY ** (offsets[-1] + 1 - ORDER))
        if not codes:
            continue  # shorter than any subsequence
        codes, weights = np.stack(codes, axis=1), np.array(weights, np.float32)
        order = np.argsort(codes, axis=1, kind="stable")
        codes, each = np.take_along_axis(codes, order, axis=1), weights[order]
        # The norm needs equal codes of a word together: sums over runs of equal codes in the sorted rows.
        first = np.ones(codes.shape, bool)
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]
        runs = np.add.reduceat(each.ravel(), np.flatnonzero(first.ravel()))
        norms = np.sqrt(np.bincount(np.nonzero(first)[0], weights=runs * runs, minlength=len(places)))
        yield places, codes, (each / norms[:, None]).astype(np.float32)


def kernel(words: list[bytes], landmarks: list[bytes]) -> np.ndarray:
    """Normalised kernel of every word with every landmark."""
    out = np.zeros((len(words), len(landmarks)), np.float32)
    known, table = spectrum(landmarks)
    for start in range(0, len(words), 2048):
        for places, codes, weights in subsequences(words[start : start + 2048]):
            row, column = np.nonzero(shared := np.isin(codes, known))
            if len(row):
                found = table[np.searchsorted(known, codes[shared])] * weights[row, column][:, None]
                first = np.flatnonzero(np.diff(row, prepend=-1))
                out[start + places[row[first]]] = np.add.reduceat(found, first, axis=0)
    return out


def spectrum(landmarks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The subsequences of the landmarks, sorted, and their weights in each landmark."""
    found = list(subsequences(landmarks))
    known = np.unique(np.concatenate([codes.ravel() for _, codes, _ in found] or [np.empty(0, np.int64)]))
    table = np.zeros((len(known), len(landmarks)), np.float32)
    for places, codes, weights in found:
        for place, row, weight in zip(places, codes, weights):
            np.add.at(table[:, place], np.searchsorted(known, row), weight)
    return known, table


@dataclass(frozen=True)
class Model:
    """``table``: weight of each subsequence in ``known`` (sorted; others weigh 0); ``bias``; ``curve``: weights of a text's two highest
    decisions and of its number of high units, and the offset."""

    table: np.ndarray
    bias: float
    curve: tuple[float, float, float, float] = (1.0, 1.0, 0.0, 0.0)
    known: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    @property
    def token(self) -> int:
        """Tells models apart: a hash of all that makes up a score."""
        return xxhash.xxh3_64_intdigest(self.known.tobytes() + self.table.tobytes() + np.array([self.bias, *self.curve]).tobytes())

    def decide(self, words: list[bytes]) -> np.ndarray:
        out = np.full(len(words), self.bias)
        for places, codes, weights in subsequences(words):
            if len(self.known):
                found = np.minimum(np.searchsorted(self.known, codes), len(self.known) - 1)
                out[places] += (np.where(self.known[found] == codes, self.table[found], 0) * weights).sum(axis=1)
        return np.clip(out, LOWEST, HIGHEST)

    def score(self, decisions: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(decisions @ np.array(self.curve[:3]) + self.curve[3])))


class Scorer:
    """Decisions of texts; those of units seen before are kept, at most ``REMEMBERED`` of them."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}

    def decide(self, texts: list[bytes]) -> np.ndarray:
        """Per text the two highest decisions of its units, and the logarithm of one more than the number of times a high one occurs."""
        return np.vstack([np.zeros((0, 3)), *(self._decide(part) for part in chunks(texts))])

    def _decide(self, texts: list[bytes]) -> np.ndarray:
        rows, known = [units(text) for text in texts], self.known
        if len(known) > REMEMBERED:
            known.clear()
        new = list(set().union(*rows).difference(known))
        for start in range(0, len(new), 8192):
            part = new[start : start + 8192]
            known.update(zip(part, self.model.decide(part).tolist()))
        found = []
        for text, row in zip(texts, rows):
            first, second = [*nlargest(2, map(known.__getitem__, row)), LOWEST, LOWEST][:2]
            times = occurrences(text, {unit for unit in row if known[unit] > 0}) if first > 0 else 0
            found.append((first, second, np.log1p(times)))
        return np.array(found).reshape(-1, 3)


def sentences(text: bytes) -> list[bytes]:
    """A text's distinct sentences, each as its units joined by spaces; long ones in parts."""
    found = set()
    for sentence in _SENTENCE.split(text):
        row = sorted(units(sentence))
        found.update(b" ".join(row[k : k + UNITS]) for k in range(0, len(row), UNITS))
    return sorted(found)


def _fit_linear(features: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Weights and bias (last) of a linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    rows = np.hstack([features.astype(np.float64), np.ones((len(features), 1))])
    penalty = ridge * np.eye(rows.shape[1])
    penalty[-1, -1] = 1e-9
    found, active = np.zeros(rows.shape[1]), np.ones(len(rows), bool)
    for _ in range(30):
        own, mass = rows[active], weight[active]
        found = np.linalg.solve(own.T @ (own * mass[:, None]) + penalty, own.T @ (mass * target[active]))
        inside = target * (rows @ found) < 1
        if (inside == active).all():
            break
        active = inside
    return found


def misspelt(word: bytes) -> set[bytes]:
    """The word with a letter inserted or doubled inside it."""
    text = word.decode()
    return {(text[:k] + extra + text[k:]).encode() for k in range(1, len(text)) for extra in ("x", text[k - 1])}


def _more_often(seen1: np.ndarray, seen0: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """By how many standard errors the first share is the larger; 0 if not many times as large."""
    share = (seen1 + seen0) / (n1 + n0)
    spread = np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0)) + 1e-12
    evidence = (seen1 / n1 - seen0 / n0) / spread
    # A word of the language that toxic texts happen to share is more frequent in them too, but not many times.
    evidence[(seen1 + 0.5) / n1 < RATIO * (seen0 + 0.5) / n0] = 0
    return evidence


def _by_document(bags: list[tuple[int, list[bytes]]], place: dict[bytes, int]) -> np.ndarray:
    """The evidence when a word counts once a document, as the sentences of one share its topic, and copies of a document once."""
    counts, sizes = np.zeros((2, len(place))), [0, 0]
    for label, *rows in {(label, *rows) for label, rows in bags}:
        sizes[label] += 1
        counts[label, [place[word] for word in {word for row in rows for word in row.split()}]] += 1
    return _more_often(counts[1], counts[0], max(1, sizes[1]), max(1, sizes[0]))


def fit(bags: list[tuple[int, list[bytes]]]) -> Model | None:
    """The machine, from the sentences of each labelled document. None if no unit stands out."""
    votes: dict[bytes, list[int]] = {}
    for label, rows in bags:
        for row in rows:
            votes.setdefault(row, []).append(label)
    # A sentence of several documents is toxic if most of them are; copies count once.
    rows = sorted(votes)
    toxic = np.array([2 * sum(votes[row]) > len(votes[row]) for row in rows], bool)
    words = sorted({word for row in rows for word in row.split()})
    place = {word: k for k, word in enumerate(words)}
    member = np.fromiter((place[word] for row in rows for word in row.split()), np.int64)
    owner = np.repeat(np.arange(len(rows)), [row.count(b" ") + 1 for row in rows])
    inside = toxic[owner]
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    seen1, seen0 = (np.bincount(member[mask], minlength=len(words)) for mask in (inside, ~inside))
    # By sentence, so that long documents don't look rich in words, and by document; the lesser counts.
    evidence = np.minimum(_more_often(seen1, seen0, n1, n0), _by_document(bags, place))
    order = np.lexsort((np.arange(len(words)), -evidence))
    causes = order[: LANDMARKS // 2][evidence[order[: LANDMARKS // 2]] >= EVIDENCE]
    if not len(causes):
        causes = order[:1] if len(order) and evidence[order[0]] > 0 else order[:0]
    by_hash = np.argsort(np.array([xxhash.xxh3_64_intdigest(word) for word in words], np.uint64), kind="stable")
    usual = by_hash[evidence[by_hash] < EVIDENCE]
    if not len(causes) or not len(usual):
        return None
    landmarks = [words[k] for k in dict.fromkeys([*causes, *usual[: LANDMARKS - len(causes)]])]
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    keep = values > 1e-3 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    known, weights = spectrum(landmarks)

    def mapped(some: list[bytes]) -> np.ndarray:
        return kernel(some, landmarks).astype(np.float64) @ whiten

    def machine(found: np.ndarray) -> Model:
        return Model((weights @ (whiten @ found[:-1])).astype(np.float32), float(found[-1]), known=known)

    cause, hard = np.zeros(len(words), bool), np.zeros(len(words), bool)
    cause[causes] = True
    # The machine's rows: what may be a cause, the words most often seen, others by hash, and after each round the worst mistaken.
    often = np.lexsort((np.arange(len(words)), -(seen1 + seen0)))[: OTHERS // 4]
    used = np.unique(np.concatenate([np.flatnonzero(evidence > 0.75 * EVIDENCE), often, usual[:OTHERS]]))
    features = mapped([words[k] for k in used])
    # Misspelt causes count as causes, half as much as all causes as they are.
    odd = sorted({variant for k in causes for variant in misspelt(words[k])}.difference(place))
    odd_features = mapped(odd)
    for _ in range(ROUNDS):
        # Both classes weigh the same in all; within one, words weigh as often as they are seen.
        own = cause[used]
        amount = np.sqrt(np.where(own, seen1[used], seen1[used] + seen0[used])) * np.where(hard[used] & ~own, HARD, 1.0)
        amount[own] *= amount[~own].sum() / amount[own].sum()
        target = np.concatenate([np.where(own, 1.0, -1.0), np.ones(len(odd))])
        mass = np.concatenate([amount, np.full(len(odd), amount[own].sum() / 2 / max(1, len(odd)))])
        model = machine(_fit_linear(np.vstack([features, odd_features]), target, mass / mass.sum(), RIDGE))
        decision = np.concatenate([model.decide(words[k : k + 8192]) for k in range(0, len(words), 8192)])
        again = (decision > 0) & (evidence > 0.75 * EVIDENCE)
        worst = np.flatnonzero((decision > -0.5) & ~again & (seen0 > 0))
        worst = worst[np.lexsort((worst, -decision[worst]))][: OTHERS // 4]
        if (again == cause).all() and hard[worst].all() or not again.any():
            break
        cause, hard[worst] = again, True
        more = np.setdiff1d(worst, used)
        used, features = np.concatenate([used, more]), np.vstack([features, mapped([words[k] for k in more])])
    return model


def calibrate(decisions: np.ndarray, labels: np.ndarray, totals: dict[int, int]) -> tuple[float, float, float, float]:
    """The logistic curve over a text's figures, with both classes weighted as they are in all labelled rows."""
    size = {value: max(1, int((labels == value).sum())) for value in (0, 1)}
    weight = np.where(labels == 1, totals.get(1, 0) / size[1], totals.get(0, 0) / size[0])
    target = np.where(labels == 1, (size[1] + 1) / (size[1] + 2), 1 / (size[0] + 2))
    rows, found = np.hstack([decisions, np.ones((len(decisions), 1))]), np.zeros(4)
    weight, penalty = weight / weight.mean(), 1e-3 * np.eye(4)
    for _ in range(100):
        chance = 1 / (1 + np.exp(-rows @ found))
        slope = rows.T @ (weight * (chance - target)) + penalty @ found
        curve = rows.T @ (rows * (weight * chance * (1 - chance))[:, None]) + penalty
        step = np.linalg.solve(curve, slope)
        found = found - step / max(1.0, np.abs(step).max())
    return tuple(found.tolist())


@lru_cache(maxsize=1)
def _scorer(token: int, shared) -> Scorer:
    """One scorer per worker process and model, kept from task to task."""
    return Scorer(shared.value)


class _Shared:
    """A broadcast that is equal to others of the same model, so that a worker keeps its scorer."""

    def __init__(self, broadcast) -> None:
        self.broadcast = broadcast

    @property
    def value(self):
        return self.broadcast.value

    def __hash__(self) -> int:
        return 0

    def __eq__(self, other) -> bool:
        return True


def train(docs: DataFrame, labels: DataFrame, folds: int = 3, kept_back: int = 1, documents: int = DOCUMENTS) -> Model:
    """Fit on at most ``documents`` labelled documents a class outside the fold kept back."""
    ship(docs.sparkSession)
    sample, totals = labelled_sample(docs, labels, "toxic", folds, kept_back, documents)
    share = totals.get(1, 0) / (sum(totals.values()) or 1) if totals else 0.5
    flat = Model(np.empty(0, np.float32), 0.0, (0.0, 0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))))
    if sample.select("label").distinct().count() < 2:
        return flat

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sentences(text) for text in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.binary()))], ["label", "sentences"])

    bags = sample.mapInArrow(cut, "label int, sentences array<binary>").collect()
    model = fit([(bag.label, [bytes(row) for row in bag.sentences]) for bag in bags])
    if model is None:
        return flat
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = scorer.decide(texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("label"), *(pa.array(found[:, k]) for k in range(3))], ["label", "first", "second", "times"])

    seen = np.array(sorted(map(tuple, sample.mapInArrow(decide, "label int, first double, second double, times double").collect())))
    return Model(model.table, model.bias, calibrate(seen[:, 1:], seen[:, 0], totals), model.known)


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.7, folds: int = 3, kept_back: int = 1) -> DataFrame:
    """doc_id, text_hash, held_out, score and predicted of every row."""
    ship(docs.sparkSession)
    shared, token = docs.sparkSession.sparkContext.broadcast(model), model.token

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(token, _Shared(shared))
        for batch in batches:
            found = scorer.model.score(scorer.decide(texts_of(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found)], ["doc_id", "text_hash", "score"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    found = rows.mapInArrow(score, "doc_id long, text_hash long, score double")
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return found.select("doc_id", "text_hash", held_out(F.col("doc_id"), folds, kept_back).alias("held_out"), "score", predicted.alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` without the documents that a model trained on their labels predicts to be toxic."""
    return drop_rows(docs, score_documents(docs, train(docs, labels), threshold).where("predicted = 1").select("doc_id", "text_hash"))
