"""Secret scans: fixed patterns, then character Markov models compared by log-likelihood ratio.

Candidates are all runs of at least ``LEAST`` letters, digits and ``+/_=-``; the models alone decide about them.

* The model of ordinary identifiers is a first-order chain over letters, regardless of case, and digits, with a second
  one for changes of case.  Its samples are all words, names and numbers of all documents, outside of what
  the fixed patterns found.  Every step is mixed with a uniform one, so that a step that the corpus lacks, as from a
  letter to a digit, costs a bounded amount; ``_``, ``-`` and the like stand between words.
* The model of random strings is a mixture: a chain like the first, whose samples are what the fixed patterns
  found, and strings drawn evenly from the alphabets that keys are written in.

A candidate becomes a span of kind ``random`` when the logarithm of the ratio of its likelihoods is over the threshold.
Spans of the fixed patterns are never changed, and a candidate that touches one is dropped.

Defined results: a null or empty text has no spans; without samples a model is uniform; repeated rows are
scanned one by one; no documents give no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sensorloom.llm.arrow_rows import columns_of, portions

KINDS = ("assign", "access", "hex", "random")

# The base patterns and their least lengths.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_KEYWORDS = ("passw", "secret", "token", "api_key", "apikey")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

#: Least length of candidates; what the logarithm of the ratio must exceed.
LEAST, THRESHOLD = 8, 14.0
#: Share of the uniform step in each step of a chain.
MIXED = 0.05

_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
#: States of the chains: 26 letters, 10 digits, and what stands between words; cases of a character.
_STATES, _BREAK = 37, 36
_STATE = np.full(256, _BREAK, np.int64)
_CASE = np.full(256, 2, np.int64)  # lower, upper, none
for _place, _letter in enumerate("abcdefghijklmnopqrstuvwxyz"):
    _STATE[[ord(_letter), ord(_letter.upper())]] = _place
    _CASE[ord(_letter)], _CASE[ord(_letter.upper())] = 0, 1
_STATE[48:58] = np.arange(26, 36)
#: Counts of a chain: steps between states, then steps between cases.
_COUNTS = _STATES * _STATES + 4
#: Size of each alphabet, and the classes that it has: hexadecimal small letters, other small ones, capitals, digits.
_ALPHABETS = ((16, (0, 3)), (26, (0, 1)), (36, (0, 1, 3)), (36, (2, 3)), (52, (0, 1, 2)), (62, (0, 1, 2, 3)))
_CLASS = np.full(256, 4, np.int64)
_CLASS[ord("a"): ord("g")], _CLASS[ord("g"): ord("z") + 1] = 0, 1
_CLASS[ord("A"): ord("Z") + 1], _CLASS[48:58] = 2, 3


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; kinds are numbered as in KINDS."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in _KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def _bytes(text: str) -> np.ndarray:
    """One byte per character; characters beyond a byte become question marks, which stand between words."""
    return np.frombuffer(text.encode("latin-1", "replace"), np.uint8)


def _steps(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places with a letter or digit and the step to each; places with a letter after a letter and its step of case."""
    state, case = _STATE[raw], _CASE[raw]
    before = np.r_[_BREAK, state[:-1]][: len(state)]
    inside = np.flatnonzero(state != _BREAK)
    letters = np.flatnonzero((case < 2) & (np.r_[2, case[:-1]][: len(case)] < 2))
    return inside, before[inside] * _STATES + state[inside], letters, case[letters - 1] * 2 + case[letters]


def _counted(text: str) -> np.ndarray:
    _, steps, _, cases = _steps(_bytes(text))
    return np.r_[np.bincount(steps, minlength=_STATES * _STATES), np.bincount(cases, minlength=4)]


def _samples(batches):
    """Steps of the samples with their label: 1 for found secrets, 0 for everything else."""
    for batch in batches:
        counts = np.zeros((2, _COUNTS), np.int64)
        for text in batch.column(0).to_pylist():
            at, plain, found = 0, [], []
            for start, kind, end in base_spans(text):
                found.append(_ASSIGN.match(text[start:end]).group(2) if kind == 0 else text[start:end])
                plain.append(text[at:start])
                at = max(at, end)
            counts[0] += _counted(" ".join([*plain, text[at:]]))
            if found:
                counts[1] += _counted(" ".join(found))
        label, step = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "label": pa.array(label, pa.int32()), "step": pa.array(step, pa.int32()),
            "n": pa.array(counts[label, step], pa.int64())})


def _chain(counts: np.ndarray) -> np.ndarray:
    """Logarithms of the likelihoods of all steps."""
    steps, cases = counts[:-4].reshape(_STATES, _STATES) + 0.01, counts[-4:].reshape(2, 2) + 0.01
    steps[:, _BREAK] = 0  # where a word ends is left out of both models
    steps = (1 - MIXED) * steps / steps.sum(axis=1, keepdims=True) + MIXED / (_STATES - 1)
    cases = (1 - MIXED) * cases / cases.sum(axis=1, keepdims=True) + MIXED / 2
    return np.r_[np.log(steps).ravel(), np.log(cases).ravel()]


def train(documents: DataFrame) -> np.ndarray:
    """The chains of ordinary and of random strings, as two rows of logarithms.

    All documents are counted.  The counts are added up by Spark; the driver gets one number for each label
    and step.
    """
    chosen = documents.filter(F.col("text").isNotNull()).select("text")
    summed = chosen.mapInArrow(_samples, "label int, step int, n long").groupBy("label", "step").agg(F.sum("n").alias("n"))
    totals = np.zeros((2, _COUNTS))
    for row in summed.collect():
        totals[row["label"], row["step"]] = row["n"]
    return np.stack([_chain(counts) for counts in totals])


def log_ratios(strings: list[str], chains: np.ndarray) -> np.ndarray:
    """Logarithm of the likelihood of each string as a random one over that as an ordinary one."""
    raw = _bytes("\n".join(strings))
    sizes = np.array([len(string) + 1 for string in strings])
    owner = np.repeat(np.arange(len(strings)), sizes)[: len(raw)]
    inside, steps, letters, cases = _steps(raw)

    def total(chain: np.ndarray) -> np.ndarray:
        out = np.bincount(owner[inside], chain[steps], len(strings))
        return out + np.bincount(owner[letters], chain[_STATES * _STATES + cases], len(strings))

    ordinary, found = total(chains[0]), total(chains[1])
    has = np.zeros((len(strings), 5), bool)
    has[owner, _CLASS[raw]] = True
    drawn = np.bincount(owner[inside], minlength=len(strings))
    random = [found]
    for size, classes in _ALPHABETS:
        others = [c for c in range(4) if c not in classes]
        random.append(np.where(has[:, others].any(axis=1), -np.inf, -drawn * np.log(size)))
    return np.logaddexp.reduce(np.stack(random)) - np.log(len(random)) - ordinary


def model_spans(texts: list[str], bases: list[list], chains: np.ndarray, threshold: float = THRESHOLD) -> list[list]:
    """For every text the candidates that the models call random and that touch no fixed span."""
    places, strings = [], []
    for k, text in enumerate(texts):
        for match in _CANDIDATE.finditer(text):
            places.append((k, match.start(), match.end()))
            strings.append(match.group())
    spans: list[list] = [[] for _ in texts]
    if strings:
        for at in np.flatnonzero(log_ratios(strings, chains) > threshold).tolist():
            k, start, end = places[at]
            if not any(a < end and start < b for a, _, b in bases[k]):
                spans[k].append((start, 3, end))
    return spans


SPANS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def scan(documents: DataFrame, chains: np.ndarray, threshold: float = THRESHOLD, text: str = "text",
         into: str = "spans") -> DataFrame:
    """The rows with all spans in code points, sorted by start and kind; the text is dropped."""
    kept = [field for field in documents.schema.fields if field.name not in (text, into)]
    schema = T.StructType([*kept, T.StructField(into, SPANS)])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def scanned(batches):
        for batch, texts in portions(batches, "__text"):
            bases = [base_spans(one) for one in texts]
            spans = [sorted([*base, *more]) for base, more in zip(bases, model_spans(texts, bases, chains, threshold))]
            found = [[{"start": start, "kind": kind, "end": end} for start, kind, end in own] for own in spans]
            yield pa.RecordBatch.from_arrays(
                [*columns_of(batch, schema.names[:-1]), pa.array(found, arrow)], schema.names)

    return documents.select(*[f"`{field.name}`" for field in kept], documents[text].alias("__text")).mapInArrow(
        scanned, schema)


def written(spans, kinds: tuple[int, ...] | None = None):
    """``kind:start:end`` of the spans, joined by commas."""
    chosen = F.filter(spans, lambda span: span["kind"].isin(*kinds)) if kinds else spans
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(chosen, lambda span: F.concat_ws(
        ":", F.get(name, span["kind"]), span["start"].cast("string"), span["end"].cast("string"))), ",")


def counted(spans, kind: int):
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")
