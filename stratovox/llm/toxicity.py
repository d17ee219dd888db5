"""Toxicity: a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel of two tokens sums, over all subsequences of four letters with gaps, products of ``DECAY`` to
the number of skipped letters, normalised to 1 for equal tokens. So "id-iot", "idxiot" and "i d i o t" stay
close to "idiot" (marks inside a token are skipped, runs of single letters are read as one token).

Training uses labelled sentences; each has the label of its document. Toxic examples are the tokens that explain toxic
sentences: each time the one in most sentences that no chosen token explains yet, among tokens that clean documents
hardly have, as long as it explains SUPPORT of them; they are also given with inserted letters. Clean examples are
all tokens of one sentence of each clean document, and then all strongest tokens of clean sentences that the machine
doesn't reject clearly. Landmarks are chosen among the examples by greedy kernel distance;
the machine is linear in the whitened landmark kernels. As the kernel is a product of subsequence vectors,
the trained machine folds into one weight per subsequence, so scoring never evaluates a landmark.
A document's probability is a logistic curve over its three strongest tokens, the number of positive ones and
its number of tokens.

Limits: ``SAMPLE`` labelled documents are used for fitting, with all their sentences; scoring reads every token of every
text. A token without three letters has no subsequence of four, so it counts as FLOOR.

Defined cases: null and empty texts have no token and get the curve's value at the least margins; repeated
rows get equal scores; repeated labels of a document count as their mean; without labels of both classes
every score is the smoothed share of toxic labels; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import lru_cache
from heapq import heapify, heappop, heappush, nlargest
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratovox.llm.common import saved
from stratovox.llm.quality import SAMPLE, labelled

DECAY, SPAN, CODES = 0.6, 6, 64
#: Landmarks of the kernel, and toxic sentences that a toxic example has to explain.
LANDMARKS, SUPPORT = 300, 3
#: Tokens of a step of the fit, on the driver.
ROWS = 4096
#: Longer tokens are read in overlapping windows of this many letters.
LONG = 20
#: Tokens whose margin a Python worker remembers.
REMEMBERED = 400_000
FLOOR = -3.0
#: Ends of sentences: line feeds, and marks before white space.
SENTENCE = re.compile(r"\n+|(?<=[.!?])\s+")


def tokens(text: str | None) -> list[str]:
    """Lower-case tokens at white space; runs of three or more single letters also count as one token."""
    words = text.lower().split() if text else []
    run: list[str] = []
    joined = []
    for word in [*words, ""]:
        if len(word) == 1 or (0 < len(word) <= 3 and sum(map(str.isalnum, word)) == 1):
            run.append(word)
        elif run:
            if len(run) >= 3:
                joined.append("".join(run))
            run = []
    return words + joined


def _code(letter: str) -> int:
    n = ord(letter)
    return n - 96 if 97 <= n <= 122 else 27 + n - 48 if 48 <= n <= 57 else 37 + n % 26


def letters(token: str) -> np.ndarray:
    """Codes of a token's letters and digits after a mark for its start."""
    return np.array([63, *(_code(c) for c in token if c.isalnum())], np.int64)


@lru_cache(maxsize=256)
def _places(n: int) -> tuple[np.ndarray, ...]:
    """Rising index quadruples within SPAN letters, and the weight of each."""
    found = [(i, *rest) for i in range(n) for rest in combinations(range(i + 1, min(n, i + SPAN)), 3)]
    places = np.array(found, np.int64).reshape(-1, 4).T
    return (*places, DECAY ** (places[3] - places[0] - 3.0))


def vectors(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(subsequence numbers, weights) of equally long tokens, one row each; equal numbers of a row aren't merged yet."""
    *places, weight = _places(codes.shape[1])
    number = np.zeros((len(codes), len(weight)), np.int64)
    for place in places:
        number = number * CODES + codes[:, place]
    return number, weight


def vector(token: str) -> dict[int, float]:
    """The normalised subsequence vector of one token."""
    out: dict[int, float] = defaultdict(float)
    numbers, weight = vectors(letters(token)[None, :])
    for number, w in zip(numbers[0].tolist(), weight.tolist()):
        out[number] += w
    norm = sum(v * v for v in out.values()) ** 0.5
    return {u: v / norm for u, v in out.items()} if norm else {}


def _norms(numbers: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Lengths of the rows' subsequence vectors, repeated subsequences merged."""
    order = numbers.argsort(axis=1, kind="stable")
    ranked, w = np.take_along_axis(numbers, order, 1), weight[order]
    sums = np.cumsum(w, axis=1)
    last = np.concatenate([ranked[:, 1:] != ranked[:, :-1], np.ones((len(ranked), 1), bool)], axis=1)
    row, column = np.nonzero(last)
    total = sums[row, column]
    before = np.concatenate([[0], total[:-1]])
    before[np.concatenate([[True], row[1:] != row[:-1]])] = 0
    return np.sqrt(np.bincount(row, weights=(total - before) ** 2, minlength=len(numbers)))


@dataclass
class Machine:
    """Sorted subsequence numbers and their weights, the machine's offset, and the curve that makes a probability of margins."""

    numbers: np.ndarray
    weights: np.ndarray
    offset: float
    curve: np.ndarray | None = None
    share: float = 0.5

    def margins(self, found: list[str]) -> np.ndarray:
        """Margin of each token; FLOOR for tokens of fewer than three letters."""
        out, by_length = np.full(len(found), FLOOR), defaultdict(list)
        for at, token in enumerate(found):
            codes = letters(token)
            for i in range(0, max(1, len(codes) - LONG // 2), LONG // 2):
                part = codes[i : i + LONG]
                if len(part) >= 4:
                    by_length[len(part)].append((at, part))
        for rows in by_length.values():
            for i in range(0, len(rows), 2000):
                part = rows[i : i + 2000]
                numbers, weight = vectors(np.stack([r[1] for r in part]))
                at = np.minimum(np.searchsorted(self.numbers, numbers), len(self.numbers) - 1)
                known = np.where(self.numbers[at] == numbers, self.weights[at], 0.0)
                value = (known * weight).sum(axis=1) / np.maximum(_norms(numbers, weight), 1e-9) + self.offset
                np.maximum.at(out, [r[0] for r in part], value)
        return out

    def probability(self, features: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(features), self.share)
        return 1 / (1 + np.exp(-np.clip(features @ self.curve[:-1] + self.curve[-1], -30, 30)))


class Reader:
    """Margins of a text's tokens; each distinct token is computed once per worker and remembered."""

    def __init__(self, machine: Machine):
        self.machine, self.known = machine, {}

    def features(self, texts: list[str | None]) -> tuple[np.ndarray, list[str]]:
        """A row for each text (three strongest tokens, positive tokens, tokens), and its strongest token."""
        split = [set(tokens(t)) for t in texts]
        new = [w for w in set().union(*split) if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(set().union(*split))
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            self.known.update(zip(part, self.machine.margins(part).tolist()))
        rows, best = np.full((len(texts), 5), FLOOR), [""] * len(texts)
        for at, words in enumerate(split):
            margins = [self.known[w] for w in words]
            for k, m in enumerate(nlargest(3, margins)):
                rows[at, k] = max(FLOOR, m)
            rows[at, 3] = np.log1p(sum(m > 0 for m in margins))
            rows[at, 4] = np.log1p(len(words))
            best[at] = max(zip(margins, words))[1] if words else ""
        return rows, best


def _vectors(found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, subsequence number, weight) of the normalised vectors of tokens; longer ones than LONG letters by their first window."""
    by_length: dict[int, list[int]] = defaultdict(list)
    codes = [letters(t)[:LONG] for t in found]
    for i, c in enumerate(codes):
        by_length[len(c)].append(i)
    out = []
    for rows in by_length.values():
        for i in range(0, len(rows), 2000):
            part = np.array(rows[i : i + 2000])
            numbers, weight = vectors(np.stack([codes[k] for k in part]))
            row = np.repeat(part, len(weight))
            both, place = np.unique(np.stack([row, numbers.ravel()]), axis=1, return_inverse=True)
            value = np.bincount(place.ravel(), np.tile(weight, len(part)))
            norm = np.sqrt(np.bincount(both[0], value * value, len(found)))
            out.append((both[0], both[1], value / norm[both[0]]))
    parts = [list(c) for c in zip(*out)]
    del out
    order = np.argsort(np.concatenate(parts[0]).astype(np.int32), kind="stable").astype(np.int32)
    return tuple(np.concatenate(parts.pop(0))[order] for _ in range(3))  # each column's parts go as it is put in order


def nystroem_machine(positive: list[str], negative: list[str], landmarks: int = LANDMARKS, ridge: float = 2e-4) -> Machine:
    """Fit the machine on tokens of both classes: squared hinge loss, classes weighted equally."""
    found = [(sign, t) for sign, t in [*((1.0, t) for t in positive), *((-1.0, t) for t in negative)] if len(letters(t)) >= 4]
    y = np.array([sign for sign, _ in found])
    row, number, value = _vectors([t for _, t in found])
    starts = np.searchsorted(row, np.arange(len(found)))
    ends = np.append(starts[1:], len(row))
    del row
    numbers = np.unique(number)
    column = np.searchsorted(numbers, number).astype(np.int32)
    del number

    def kernel(mark: int) -> np.ndarray:
        dense = np.zeros(len(numbers))
        dense[column[starts[mark] : ends[mark]]] = value[starts[mark] : ends[mark]]
        out = np.empty(len(found))
        for i in range(0, len(found), ROWS):
            a, b = starts[i], ends[min(i + ROWS, len(found)) - 1]
            out[i : i + ROWS] = np.add.reduceat(dense[column[a:b]] * value[a:b], starts[i : i + ROWS] - a)
        return out

    near, marks = np.zeros(len(found)), []  # greedy: the token that is farthest from all landmarks, positive tokens first
    k = np.empty((min(landmarks, len(found)), len(found)))
    for at in range(len(k)):
        far = (1 - near) * np.where(y > 0, 2.0, 1.0)
        far[marks] = -1
        marks.append(int(np.argmax(far)))
        k[at] = kernel(marks[-1])
        np.maximum(near, k[at], out=near)
    values, axes = np.linalg.eigh(k[:, marks].T)
    white = axes / np.sqrt(np.maximum(values, 1e-6))
    z = np.ones((len(found), len(marks) + 1))
    np.matmul(k.T, white, out=z[:, :-1])
    del k
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    w = np.zeros(z.shape[1])
    for _ in range(30):  # Newton steps on the violated tokens
        active = np.flatnonzero(y * (z @ w) < 1)
        square, side = ridge * len(y) * np.eye(len(w)), np.zeros(len(w))
        for i in range(0, len(active), ROWS):  # sums over rows, so that no copies of all of them are held
            part = active[i : i + ROWS]
            rows = z[part]
            weighted = rows * weight[part, None]
            square += weighted.T @ rows
            side += weighted.T @ y[part]
        new = np.linalg.solve(square, side)
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    beta, weights = white @ w[:-1], np.zeros(len(numbers))
    for mark, b in zip(marks, beta):
        weights[column[starts[mark] : ends[mark]]] += b * value[starts[mark] : ends[mark]]
    return Machine(numbers[weights != 0], weights[weights != 0], float(w[-1]))


def disguised(token: str) -> list[str]:
    """The token with a foreign letter inserted at two places; the machine learns to see through it."""
    return [token[:i] + letter + token[i:] for i, letter in ((len(token) // 2, "x"), ((len(token) + 1) // 3, "q"))]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    z, w = np.concatenate([x, np.ones((len(x), 1))], axis=1), np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + ridge * np.eye(len(w)) * ([1] * x.shape[1] + [1e-6])
        step = np.linalg.solve(h, z.T @ (y - p) - ridge * np.append(w[:-1], 0))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _plain(word: str) -> str:
    return "".join(filter(str.isalnum, word))


def _token_counts(rows: DataFrame) -> DataFrame:
    """``(token, toxic, clean)``: documents of each class that have the token."""

    def count(batches):
        for batch in batches:
            seen = [Counter(), Counter()]
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[y >= 0.5].update({_plain(w) for w in tokens(t)})
            every = [w for w in {*seen[0], *seen[1]} if len(w) > 2]
            yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), *(pa.array([s[w] for w in every], pa.int64()) for s in (seen[1], seen[0]))], names=["token", "toxic", "clean"])

    counted = rows.select("y", "t").mapInArrow(count, "token string, toxic long, clean long")
    return counted.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _sentences(rows: DataFrame, candidates: list[str]) -> tuple[list[str], list[str]]:
    """The candidates in each toxic sentence that has any, distinct lists joined by spaces; the tokens of one sentence of each clean document."""
    shipped = rows.sparkSession.sparkContext.broadcast(frozenset(candidates))

    def holding(batches):
        for batch in batches:
            kind, held = [], []
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sentences = [s for s in SENTENCE.split(text) if s]
                if y >= 0.5:
                    found = (sorted({_plain(w) for w in tokens(s)} & shipped.value) for s in sentences)
                    held += [" ".join(f) for f in found if f]
                elif sentences:
                    held += {_plain(w) for w in tokens(min(sentences, key=lambda s: xxhash.xxh3_64_intdigest(s.encode())))}
                kind += [y >= 0.5] * (len(held) - len(kind))
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.bool_()), pa.array(held, pa.string())], names=["toxic", "held"])

    found = rows.select("y", "t").mapInArrow(holding, "toxic boolean, held string")
    toxic = found.where("toxic").orderBy("held").toPandas()["held"]
    return toxic.to_list(), sorted(r.held for r in found.where("not toxic").distinct().collect())


def _explaining(sentences: list[str]) -> list[str]:
    """Tokens in the order in which they explain most of the sentences (their candidate tokens) that aren't explained yet."""
    holders: dict[str, list[int]] = defaultdict(list)
    for d, held in enumerate(sentences):
        for w in held.split():
            holders[w].append(d)
    left, out = np.ones(len(sentences), bool), []
    heap = [(-len(d), w) for w, d in holders.items()]
    heapify(heap)
    while heap:
        gain, w = heappop(heap)
        new = int(left[holders[w]].sum())
        if new < SUPPORT:
            continue
        if new < -gain:
            heappush(heap, (-new, w))
            continue
        out.append(w)
        left[holders[w]] = False
    return out


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", folds: int = 5, sample: int = SAMPLE) -> Machine:
    """Fit on rows whose crc32(id) modulo ``folds`` isn't 0, at most ``sample`` of them."""
    rows = saved(labelled(docs, labels, label_col, id_col, text_col, folds, sample).select("y", F.col("t").cast("string").alias("t")).where("t is not null").distinct(), "labelled")
    n = {r["k"]: r["n"] for r in rows.groupBy((F.col("y") >= 0.5).alias("k")).agg(F.count("*").alias("n")).collect()}
    share = (n.get(True, 0) + 0.5) / (sum(n.values()) + 1)
    nothing = Machine(np.zeros(1, np.int64), np.zeros(1), 0.0, None, share)
    if len(n) < 2:
        return nothing
    odds = F.log((F.col("toxic") + 0.5) / (n[True] + 1)) - F.log((F.col("clean") + 0.5) / (n[False] + 1))
    odd = saved(_token_counts(rows), "tokens").where((F.col("toxic") >= SUPPORT) & (odds > 2))
    toxic, clean = _sentences(rows, [r.token for r in odd.select("token").collect()])
    positive = _explaining(toxic)
    if not positive:
        return nothing
    positive += [v for w in positive if len(w) >= 4 for v in disguised(w)]
    negative = set(clean) - set(positive)
    machine = nystroem_machine(positive, sorted(negative))
    for again in (True, True, False):
        found = _features(rows, machine)
        x, y = np.stack(found["x"].to_list()), (found["y"] >= 0.5).to_numpy().astype(float)
        if again:  # negatives that are rejected clearly leave, strongest tokens of clean documents that aren't rejected so join
            near = found[(found["y"] < 0.5) & (found["x"].str[0] > -1)]
            kept = sorted(negative)
            negative = {t for t, m in zip(kept, machine.margins(kept)) if m > -1} | set(near["best"].map(_plain)) - set(positive) - {""}
            machine = nystroem_machine(positive, sorted(negative))
    machine.curve, machine.share = logistic(x, y), share
    return machine


def _features(rows: DataFrame, machine: Machine):
    shipped = rows.sparkSession.sparkContext.broadcast(machine)

    def scan(batches):
        reader = Reader(shipped.value)
        for batch in batches:
            x, best = reader.features(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(best, pa.string())], names=["y", "x", "best"])

    return rows.select("y", "t").mapInArrow(scan, "y double, x array<double>, best string").toPandas().sort_values(["best", "y"], kind="stable")


def scored(docs: DataFrame, machine: Machine, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the probability, in one pass without a shuffle. ``name`` must not be a column yet."""
    shipped, place = docs.sparkSession.sparkContext.broadcast(machine), docs.columns.index(text_col)

    def scan(batches):
        reader = Reader(shipped.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                x, _ = reader.features(part.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shipped.value.probability(x), pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
