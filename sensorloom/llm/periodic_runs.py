"""Runs of repeated words: maximal stretches that a word sequence repeats at least twice.

Phase one of Baier's suffix sorter groups the positions of a sequence by their longest Lyndon words, and so
gives the Lyndon array directly.  Every run has a Lyndon root under one of the two orders of the words, so the
arrays of both orders name all candidates; each is extended to both sides by longest common extensions.

Words are worked on in portions of many documents.  A run of 12 words or more lies in a stretch that is covered by
six-word windows that occur twice in the document; only such stretches are grouped.  This is exact: windows are
compared by hash, and a collision only adds a stretch.

A null text has no words.  Rows with equal doc_ids are judged each for itself.  With ``altered``, a null doc_id has no
number and its words stay as they are.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.arrow_rows import portions

#: Least length of a run in words, and the window whose repetition it implies.
LEAST = 12
WINDOW = LEAST // 2

RUN_COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def lyndon_lengths(letters: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each position; 0 is the letter of separators, below all others.

    Groups of equal contexts are taken from the highest down.  A position leaves the list of open positions with its
    group; the open position before it then has the group's context behind its own, as often as positions of
    the group have pointed to it, and moves to a higher group with the longer context.
    """
    size = len(letters)
    order = np.argsort(letters, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(letters[order]) != 0]) if size else np.zeros(0, np.int64)
    members = [part.tolist() for part in np.split(order, starts[1:])] if size else []
    group = np.empty(size, np.int64)
    group[order] = np.repeat(np.arange(len(members)), np.diff(np.r_[starts, size]))
    group = group.tolist()
    context = [1] * len(members)
    below = list(range(-1, len(members) - 1))  # the next lower group of each
    above = [*range(1, len(members)), -1]
    left, right = list(range(-1, size)), list(range(1, size + 2))
    lengths = [1] * size
    at = len(members) - 1
    separators = 0 if size and letters[order[0]] == 0 else -1
    while at != separators:
        length = context[at]
        pointed: dict[int, int] = {}
        for i in members[at]:
            if group[i] != at:
                continue
            lengths[i] = length
            j, k = left[i], right[i]
            left[k], right[j] = j, k
            pointed[j] = pointed.get(j, 0) + 1
        pointed.pop(-1, None)
        members[at] = []
        by_times: dict[int, list[int]] = {}
        for j, times in pointed.items():
            by_times.setdefault(times, []).append(j)
        for times in sorted(by_times, reverse=True):
            into: dict[int, int] = {}
            for j in by_times[times]:
                old = group[j]
                if old == separators:
                    continue
                new = into.get(old)
                if new is None:
                    new = into[old] = len(members)
                    members.append([])
                    context.append(context[old] + times * length)
                    higher = above[old]
                    below.append(old)
                    above.append(higher)
                    above[old] = new
                    if higher >= 0:
                        below[higher] = new
                group[j] = new
                members[new].append(j)
        at = below[at]
    return np.array(lengths, np.int64)


class Extensions:
    """Longest common extensions by ranks of the words of 1, 2, 4, ... letters from each position."""

    def __init__(self, letters: np.ndarray, longest: int):
        self.size = len(letters)
        self.ranks = [letters.astype(np.int64)]
        width = 1
        while width * 2 <= longest:
            ranks = self.ranks[-1]
            pair = np.full(self.size, -1, np.int64)  # no word of this width starts so close to the end
            if self.size >= 2 * width:
                pair[: self.size - 2 * width + 1] = ranks[: self.size - 2 * width + 1] * (self.size + 1) + ranks[width: self.size - width + 1]
            self.ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
            width *= 2

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many letters from i on equal those from j on, i < j."""
        length = np.zeros(len(i), np.int64)
        # Separators are letters of their own, so an extension never has the width of all of the text.
        for level in reversed(range(len(self.ranks))):
            width = 1 << level
            a, b = i + length, j + length
            fits = b + width <= self.size
            same = fits.copy()
            same[fits] = self.ranks[level][a[fits]] == self.ranks[level][b[fits]]
            length += np.where(same, width, 0)
        return length

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many letters before i equal those before j, i < j."""
        length = np.zeros(len(i), np.int64)
        for level in reversed(range(len(self.ranks))):
            width = 1 << level
            a, b = i - length - width, j - length - width
            fits = a >= 0
            same = fits.copy()
            same[fits] = self.ranks[level][a[fits]] == self.ranks[level][b[fits]]
            length += np.where(same, width, 0)
        return length


def runs_of(letters: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) by start and period of the runs in letters with separators 0 in between."""
    words = letters > 0
    if not words.any():
        return np.zeros((0, 3), np.int64)
    highest = int(letters.max())
    told_apart = letters.astype(np.int64)
    told_apart[~words] = highest + 1 + np.arange((~words).sum())
    told_apart = np.unique(told_apart, return_inverse=True)[1]
    bounds = np.flatnonzero(np.r_[True, ~words, True])
    extend = Extensions(told_apart, int(np.diff(bounds).max()) + 1)
    found = []
    for ordered in (letters, np.where(words, highest + 1 - letters, 0)):
        lengths = lyndon_lengths(ordered)
        i = np.flatnonzero(words)
        period = lengths[i]
        inside = i + period < len(letters)
        i, period = i[inside], period[inside]
        ahead = extend.forward(i, i + period)
        behind = extend.backward(i, i + period)
        length = behind + period + ahead
        run = length >= np.maximum(2 * period, least)
        found.append(np.stack([(i - behind)[run], length[run], period[run]], axis=1))
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _covered(letters: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Positions inside windows that occur twice in their document."""
    size = len(letters) - WINDOW + 1
    covered = np.zeros(len(letters) + 1, np.int64)
    if size <= 1:
        return covered[:-1] > 0
    key = np.zeros(size, np.uint64)
    for at in range(WINDOW):
        key = (key * np.uint64(0x9E3779B97F4A7C15) + letters[at: at + size].astype(np.uint64) + np.uint64(1)) ^ (key >> np.uint64(29))
    key = (key ^ document[:size].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    whole = np.flatnonzero(document[:size] == document[WINDOW - 1:])
    order = whole[np.argsort(key[whole], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    twice = order[(np.r_[same, False] | np.r_[False, same])[: len(order)]]
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + WINDOW, -1)
    return np.cumsum(covered[:-1]) > 0


def document_runs(letters: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs (start, length, period) in the concatenated letters of many documents, and the document of each."""
    covered = _covered(letters, document)
    if not covered.any():
        return np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(covered)
    new = np.r_[True, (np.diff(at) > 1) | (np.diff(document[at]) != 0)]
    places = np.arange(len(at)) + np.cumsum(new)  # a separator before each stretch
    dense = np.unique(letters[at], return_inverse=True)[1] + 1
    stretch = np.zeros(places[-1] + 2, np.int64)
    stretch[places] = dense
    origin = np.zeros(len(stretch), np.int64)
    origin[places] = at
    runs = runs_of(stretch)
    runs[:, 0] = origin[runs[:, 0]]
    return runs, document[runs[:, 0]]


def _altered(counts: np.ndarray, ids: list) -> np.ndarray:
    """For each word of the texts the place of the word that it becomes."""
    starts = np.r_[0, np.cumsum(counts)[:-1]]
    source = np.arange(int(counts.sum()))
    for start, n, doc_id in zip(starts.tolist(), counts.tolist(), ids):
        if not n or doc_id is None:
            continue
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            period = 1 + (n - a) // (3 + g % 8)
            source[start + a: start + n] = start + a + np.arange(n - a) % period
    return source


def _judged(part: pa.RecordBatch, texts: list[str], altered: bool) -> pa.RecordBatch:
    ids = part.column(0)
    pieces = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
    flat, owner = pieces.flatten(), pc.list_parent_indices(pieces).to_numpy()
    word = pc.binary_length(flat).to_numpy() > 0
    flat, owner = flat.filter(pa.array(word)), owner[word]
    counts = np.bincount(owner, minlength=len(texts))
    source = _altered(counts, ids.to_pylist()) if altered else np.arange(len(flat))
    letters = flat.dictionary_encode().indices.to_numpy()[source] if len(flat) else np.zeros(0, np.int64)
    document = np.repeat(np.arange(len(texts)), counts)
    runs, run_document = document_runs(letters, document)
    starts = np.r_[0, np.cumsum(counts)]
    dropped = np.zeros(len(letters) + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(dropped[:-1]) == 0
    left = np.r_[0, np.cumsum(np.bincount(document[keep], minlength=len(texts)))]
    kept = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), flat.take(pa.array(source[keep])))
    collapsed = pc.binary_join(kept, pa.scalar(" ", pa.large_string()))
    rows = [[] for _ in range(6)]
    bounds = np.searchsorted(run_document, np.arange(len(texts) + 1))
    for k in range(len(texts)):
        own = runs[bounds[k]: bounds[k + 1]] - [starts[k], 0, 0]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in own.tolist())
        best = own[np.lexsort((own[:, 2], own[:, 0], -own[:, 1]))[0]].tolist() if len(own) else [None] * 3
        for column, value in zip(rows, [
                len(own), *best, 1000 * best[1] // best[2] if len(own) else None, hashlib.sha256(lines.encode()).hexdigest()]):
            column.append(value)
    digests = [hashlib.sha256(text.as_buffer() or b"").hexdigest() for text in collapsed]
    longs = [pa.array(column, pa.int64()) for column in rows[:5]]
    return pa.RecordBatch.from_arrays(
        [ids, *longs, pa.array(rows[5]), pa.array(digests), collapsed.cast(pa.string())],
        ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed"])


def find_runs(documents: DataFrame, altered: bool = False, texts: bool = True) -> DataFrame:
    """Per row of (doc_id, text): number of runs, the longest one, the digest of all, and the text without repetitions.

    The longest run is given by its first word, length and period, with its exponent in thousandths; ties go to the
    smaller start, then period; without a run these are null.  A word is dropped if a run has it after the
    run's first period; the words that stay are joined by one space as ``collapsed`` (not with ``texts=False``).
    With ``altered`` a tenth of the documents, by the checksum of their doc_id, end in a periodic stretch instead of
    their own last words.
    """
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def judge(batches):
        for part, whole in portions(batches, "text"):
            out = _judged(part, whole, altered)
            yield out if texts else out.select(out.schema.names[:-1])

    schema = f"doc_id {id_type}, {RUN_COLUMNS}" + (", collapsed string" if texts else "")
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(judge, schema)
