"""Removal of long strings that an earlier document has, by longest previous factors in suffix order.

Texts are bytes; a string of LENGTH bytes counts as repeated when it also starts in a document with a
smaller doc_id.  Every string of that length belongs to its anchor: the gram of GRAM bytes in it with
the least hash, the leftmost one of several.  Equal strings have equal anchors, so it is enough to
compare strings below one anchor, and anchors that only one text has need no comparison at all.
A cutting is a run of strings with one anchor.  Equal texts travel as one, with all their doc_ids: all
but the smallest lose everything.

1. Anchors go to ranges of hash values, which send back those of two texts or more.
2. Each text sends its cuttings below such anchors to the ranges of the anchors.
3. There, equal cuttings are one kind, with their smallest document.  Where several kinds meet below one
   anchor, their suffixes are put in order by LENGTH bytes.  The previous and the next smaller document in this
   order give each suffix its longest previous factor; a string is removed if that has LENGTH bytes or more, so
   the first document keeps it.  Suffixes are compared by no more than LENGTH bytes, as that alone is asked.
4. The covered bytes go back to the documents, which merge them and keep the rest.

What a thousandth of all documents or more have is known beforehand, and bounded in number.  A cutting of
this kind is removed on the spot from all documents but its first.  The other cuttings below an anchor of
this kind are sent string by string to the ranges of the strings' own hashes, so that no anchor gathers a large
part of the documents in one task.

Defined results: a null or empty text has no bytes and loses none; texts under LENGTH bytes lose none; rows
with the same doc_id take nothing from each other; a null doc_id counts as larger than all others; no
documents give no rows.  Kept bytes need not be valid UTF-8.  Kinds are told apart by 64-bit hashes
below one anchor, texts by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm import blobs, shared_features
from sensorloom.llm.arrow_rows import PARCEL_PORTION, PORTION, portions
from sensorloom.llm.common import routes_for, stored
from sensorloom.llm.shared_features import BITS, PARCEL, batch_of, is_in

LENGTH, GRAM = 50, 24
#: Bytes of cuttings that are compared at once, unless more lie below one anchor.
AT_ONCE = 1 << 20
#: Ranges of anchors that cuttings go to, for each range of keys: cuttings are larger than what others send.
FINER = 4

_WITHIN = LENGTH - GRAM + 1
_LAST = np.iinfo(np.int64).max
_WORDS = (0, 8, 16, 24, 32, 40, 42)
_MIX = tuple(np.uint64(factor) for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_BASE = 0x2545F4914F6CDD1D
_LETTERS = np.array([xxhash.xxh3_64_intdigest(bytes([byte]), seed=50) for byte in range(256)], np.uint64)


class _Powers:
    """Powers of the base of a rolling hash, and of its inverse modulo 2 ** 64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > len(self.up):
            steps = np.full(2 * size, 1, np.uint64)
            steps[1:] = np.uint64(_BASE)
            self.up = np.multiply.accumulate(steps)
            steps[1:] = np.uint64(pow(_BASE, -1, 1 << 64))
            self.down = np.multiply.accumulate(steps)
        return self.up[:size], self.down[:size]


_POWERS = _Powers()


def _words(buffer: np.ndarray, kind: str) -> np.ndarray:
    """The eight bytes from every place on, as numbers."""
    padded = np.r_[buffer, np.zeros(8, np.uint8)]
    return np.ascontiguousarray(np.ndarray(len(buffer), kind, padded, strides=(1,)))


def _contents(buffer: np.ndarray, firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of substrings, by differences of a running sum."""
    up, down = _POWERS(len(buffer))
    running = np.r_[np.uint64(0), np.cumsum(_LETTERS[buffer] * up, dtype=np.uint64)]
    value = (running[firsts + lengths] - running[firsts]) * down[firsts] + lengths.astype(np.uint64)
    value = (value ^ (value >> np.uint64(32))) * _MIX[1]
    return value ^ (value >> np.uint64(29))


def anchors(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every string of LENGTH bytes: the place of its anchor; and the hash of the gram at every place."""
    words = _words(buffer, "<u8")
    count = len(buffer) - GRAM + 1
    grams = words[:count] * _MIX[0]
    for step, factor in zip((8, 16), _MIX[1:]):
        grams = ((grams ^ (grams >> np.uint64(32))) + words[step: step + count]) * factor
    grams = (grams ^ (grams >> np.uint64(29))) * _MIX[0] >> np.uint64(64 - BITS)
    least, place, width = grams, np.arange(count), 1
    while width < _WITHIN:
        step = min(width, _WITHIN - width)
        size = len(least) - step
        left = least[:size] <= least[step:]
        least, place = np.where(left, least[:size], least[step:]), np.where(left, place[:size], place[step:])
        width += step
    return place, grams


def cuttings(buffer: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that lie one after the other: text, anchor, first place in the buffer, number of strings."""
    if len(buffer) < LENGTH:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), *np.zeros((2, 0), np.int64))
    place, grams = anchors(buffer)
    owner = np.repeat(np.arange(len(lengths)), lengths)[: len(place)]
    inside = np.flatnonzero(np.cumsum(lengths)[owner] - np.arange(len(place)) >= LENGTH)
    place, owner = place[inside], owner[inside]
    fresh = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])][: len(place)])
    return owner[fresh], grams[place[fresh]], inside[fresh], np.diff(np.r_[fresh, len(place)])


def _key(raw: bytes) -> int:
    """Identity of a text; its copies count as one until the end."""
    return xxhash.xxh3_64_intdigest(raw)


def _joined(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(raws), np.uint8), np.fromiter(map(len, raws), np.int64, len(raws))


def _distinct(batches):
    """The texts of portions of rows with the doc_ids of each."""
    for batch, texts in portions(batches, "text", PARCEL_PORTION):
        found: dict[bytes, list[int]] = {}
        for order, text in zip(batch.column(0).to_pylist(), texts):
            found.setdefault(text.encode(), []).append(_LAST if order is None else order)
        yield found


def _members(raws: list[bytes], contents: bool):
    """Place, distinct anchors and distinct contents of each text that has any."""
    for a, b in _runs(np.cumsum([len(raw) for raw in raws]) // PORTION):
        buffer, lengths = _joined(raws[a:b])
        owner, grams, first, count = cuttings(buffer, lengths)
        content = _contents(buffer, first, count + LENGTH - 1) if contents else grams
        for x, y in _runs(owner):
            yield a + int(owner[x]), np.unique(grams[x:y]), np.unique(content[x:y])


def _runs(group: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal numbers start and end."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)]).tolist()
    return list(zip(starts, [*starts[1:], len(group)]))


def _reported(batches):
    """Anchors and contents that may be common; contents with their smallest document."""
    for texts in _distinct(batches):
        orders = [min(ids) for ids in texts.values()]
        found = list(_members(list(texts), True))
        if not found:
            continue
        grams, gram_owners = shared_features.often_seen([one[1] for one in found])
        values, owners = shared_features.often_seen([one[2] for one in found])
        flat = np.concatenate([one[2] for one in found])
        order = np.repeat([orders[one[0]] for one in found], [len(one[2]) for one in found])
        mine = is_in(values, flat)
        least = np.full(len(values), _LAST)
        np.minimum.at(least, np.searchsorted(values, flat[mine]), order[mine])
        yield pa.RecordBatch.from_pydict({
            "content": pa.array(np.r_[np.zeros(len(grams), bool), np.ones(len(values), bool)]),
            "feature": pa.array(np.r_[grams, values].view(np.int64)),
            "owners": pa.array(np.r_[gram_owners, owners]), "least": pa.array(np.r_[np.zeros(len(grams), np.int64), least])})


def _anchors_sent(common: np.ndarray, routes: int):
    """Anchors of each distinct text."""

    def sent(batches):
        for texts in _distinct(batches):
            raws = list(texts)
            members = {_key(raws[place]): grams for place, grams, _ in _members(raws, False)}
            if members:
                keys = np.sort(np.array(list(members), np.uint64))
                yield batch_of(shared_features.send(keys, [members[key] for key in keys.tolist()], common, routes))

    return sent


_TEXT = b"text"


def _texts_sent(routes: int):
    """Distinct texts for the ranges of their keys: a compressed texts, b their lengths, c the doc_ids of all
    their rows, d a mark and how many rows each has."""

    def sent(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for texts in _distinct(batches):
            raws, ids = list(texts), list(texts.values())
            route = blobs.bucket(np.array([_key(raw) for raw in raws], np.uint64), routes)
            rows = []
            for to in np.unique(route).tolist():
                mine = np.flatnonzero(route == to).tolist()
                rows.append((
                    routes + to, packer.compress(b"".join([raws[i] for i in mine])),
                    blobs.pack(np.array([len(raws[i]) for i in mine])),
                    np.concatenate([np.array(ids[i], np.int64) for i in mine]).tobytes(),
                    _TEXT + blobs.pack(np.array([len(ids[i]) for i in mine]))))
            yield batch_of(rows)

    return sent


def _texts(table: pa.Table) -> tuple[dict[int, tuple[bytes, list[int]]], list[dict]]:
    """The distinct texts of the text parcels with their doc_ids, under their keys, and the other parcels."""
    unpacker, others = zstandard.ZstdDecompressor(), []
    texts: dict[int, tuple[bytes, list[int]]] = {}
    for row in table.to_pylist():
        if row["c"] is None or not row["d"].startswith(_TEXT):
            others.append(row)
            continue
        whole, ids, at, place = unpacker.decompress(row["a"]), np.frombuffer(row["c"], np.int64).tolist(), 0, 0
        for length, rows in zip(blobs.unpack(row["b"]).tolist(), blobs.unpack(row["d"][len(_TEXT):]).tolist()):
            raw = whole[at: at + length]
            texts.setdefault(_key(raw), (raw, []))[1].extend(ids[place: place + rows])
            at, place = at + length, place + rows
    return texts, others


def _pieces(buffer: np.ndarray, firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Substrings one after the other."""
    starts = np.cumsum(lengths) - lengths
    return buffer[np.repeat(firsts - starts, lengths) + np.arange(int(lengths.sum()))]


def _pair(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return (keys ^ (hashes * _MIX[0])) * _MIX[1]


def _covers(keys: np.ndarray, firsts: np.ndarray, lengths: np.ndarray, routes: int) -> list[tuple]:
    """Parcels of covered places for the ranges of keys: a keys, b first places, d lengths."""
    order = np.argsort(keys, kind="stable")
    keys, firsts, lengths = keys[order], firsts[order], lengths[order]
    cuts = np.searchsorted(blobs.bucket(keys, routes), np.arange(routes + 1)).tolist()
    return [(routes + to, blobs.pack_sorted(keys[a:b]), blobs.pack(firsts[a:b]), None, blobs.pack(lengths[a:b]))
            for to, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]


def _cuttings_sent(common: np.ndarray, contents: np.ndarray, least: np.ndarray, routes: int):
    """For one range of keys: cuttings below anchors that others have too, for the ranges of anchors, whose
    routes are negative.

    a compressed bytes, b anchors in order, c numbers of strings, d keys, doc_ids and first places.
    """

    def cut(table: pa.Table) -> pa.Table:
        found, replies = _texts(table)
        texts = [(key, raw, min(ids)) for key, (raw, ids) in found.items()]
        shared = np.sort(np.concatenate([np.zeros(0, np.uint64), *[
            _pair(blobs.unpack_sorted(row["a"]), blobs.unpack(row["b"])) for row in replies]]))
        rows, packer = [], zstandard.ZstdCompressor(level=1)
        ends = np.cumsum([len(raw) for _, raw, _ in texts])
        for x, y in _runs(ends // PORTION):
            buffer, lengths = _joined([raw for _, raw, _ in texts[x:y]])
            keys = np.array([key for key, _, _ in texts[x:y]], np.uint64)
            orders = np.array([order for _, _, order in texts[x:y]], np.int64)
            owner, grams, first, count = cuttings(buffer, lengths)
            hot = is_in(common, grams)
            mine = hot | is_in(shared, _pair(keys[owner], grams))
            owner, grams, first, count, hot = owner[mine], grams[mine], first[mine], count[mine], hot[mine]
            if not len(owner):
                continue
            begin = np.cumsum(lengths) - lengths
            if hot.any():
                content = _contents(buffer, first, count + LENGTH - 1)
                place = np.minimum(np.searchsorted(contents, content), max(0, len(contents) - 1))
                later = is_in(contents, content)
                later[later] = least[place[later]] < orders[owner[later]]
                rows += _covers(
                    keys[owner[later]], first[later] - begin[owner[later]], count[later] + LENGTH - 1, routes)
                apart = hot & ~later
                sizes = count[apart]
                inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                alone = np.repeat(first[apart], sizes) + inner
                values = _contents(buffer, alone, np.full(len(alone), LENGTH)) >> np.uint64(64 - BITS)
                plain = ~hot
                owner = np.r_[owner[plain], np.repeat(owner[apart], sizes)]
                grams, first = np.r_[grams[plain], values], np.r_[first[plain], alone]
                count = np.r_[count[plain], np.ones(len(alone), np.int64)]
            order = np.argsort(grams, kind="stable")
            owner, grams, first, count = owner[order], grams[order], first[order], count[order]
            cuts = np.searchsorted(blobs.bucket(grams, FINER * routes, BITS), np.arange(FINER * routes + 1)).tolist()
            for to, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    who = owner[a:b]
                    rows.append((
                        -1 - to, packer.compress(_pieces(buffer, first[a:b], count[a:b] + LENGTH - 1).tobytes()),
                        blobs.pack_sorted(grams[a:b]), blobs.pack(count[a:b]), packer.compress(np.concatenate([
                            keys[who], orders[who].view(np.uint64), (first[a:b] - begin[who]).view(np.uint64)]).tobytes())))
        return pa.Table.from_batches([batch_of(rows)])

    return cut


def smaller_before(values: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it with a smaller value, -1 where there is none.

    All places look at once: who has found no smaller value goes on from where the place he looked at has got to,
    as everything in between is at least as large.  So the distance about doubles in each round.
    """
    before = np.arange(-1, len(values) - 1)
    looking = np.arange(len(values))
    while len(looking := looking[before[looking] >= 0]):
        looking = looking[values[before[looking]] >= values[looking]]
        before[looking] = before[before[looking]]
    return before


def factors_reach(raw: np.ndarray, firsts: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Whether the longest previous factor of each place, in documents before its own, has LENGTH bytes or more.

    The suffixes at the places are brought into order by their first LENGTH bytes; longer common prefixes need
    not be told apart.  The longest common prefix with a suffix of a smaller document is that with the previous or
    with the next one in suffix order, and it is the least of the common prefixes of neighbours in between.
    """
    words = _words(raw, ">u8")
    columns = [words[firsts + step].astype(np.uint64) for step in _WORDS]
    order = np.lexsort(columns[::-1])
    short = np.zeros(len(firsts), bool)  # the common prefix with the suffix before is shorter than LENGTH
    for column in columns:
        ordered = column[order]
        short[1:] |= ordered[1:] != ordered[:-1]
    shorter = np.cumsum(short)
    ordered = documents[order]
    previous = smaller_before(ordered)
    following = len(ordered) - 1 - smaller_before(ordered[::-1])[::-1]
    reach = np.zeros(len(firsts), bool)
    for other, there in ((previous, previous >= 0), (following, following < len(ordered))):
        reach[there] |= shorter[other[there]] == shorter[there]
    out = np.empty(len(firsts), bool)
    out[order] = reach
    return out


def _repeated(raw, grams, counts, keys, orders, places):
    """Covered places (key, first, length) of the cuttings below some anchors."""
    lengths = counts + LENGTH - 1
    starts = np.cumsum(lengths) - lengths
    content = _contents(raw, starts, lengths)
    # Cuttings with the same bytes below the same anchor are one kind, with their smallest document.
    order = np.lexsort((orders, content, grams))
    fresh = np.r_[True, (grams[order][1:] != grams[order][:-1]) | (content[order][1:] != content[order][:-1])]
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(fresh) - 1
    sample = order[fresh]
    # Only the smallest document of a kind keeps its strings, unless other kinds lie below the anchor: then the
    # longest previous factors of the kind's strings decide.
    sizes = counts[sample]
    offsets = np.cumsum(sizes) - sizes
    earlier = np.zeros(int(sizes.sum()), bool)
    same = np.r_[False, grams[sample][1:] == grams[sample][:-1]]
    mixed = np.repeat(same | np.r_[same[1:], False], sizes)
    if mixed.any():
        firsts = np.repeat(starts[sample] - offsets, sizes) + np.arange(int(sizes.sum()))
        earlier[mixed] = factors_reach(raw, firsts[mixed], np.repeat(orders[sample], sizes)[mixed])
    # All strings of all cuttings, and the runs of those that a smaller document has.
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(int(ends[-1])) - (ends - counts)[owner]
    hit = earlier[offsets[kind][owner] + inner] | (orders[sample][kind] < orders)[owner]
    edge = np.zeros(len(hit) + 1, bool)
    edge[ends - counts] = True
    edge[-1] = True
    starting = hit & (edge[:-1] | ~np.r_[False, hit[:-1]])
    ending = hit & (edge[1:] | ~np.r_[hit[1:], False])
    first = places[owner[starting]] + inner[starting]
    last = places[owner[ending]] + inner[ending] + LENGTH
    return keys[owner[starting]], first, last - first


def _matches(routes: int):
    """For one range of anchors: covered places, for the ranges of keys.  Other parcels pass as they are."""

    def matched(table: pa.Table) -> pa.Table:
        if table.column("route")[0].as_py() >= 0:
            return table
        unpacker = zstandard.ZstdDecompressor()
        raws, grams, counts, numbers = [], [], [], []
        for a, b, c, d in zip(*(table.column(name).to_pylist() for name in "abcd")):
            raws.append(unpacker.decompress(a))
            grams.append(blobs.unpack_sorted(b))
            counts.append(blobs.unpack(c).astype(np.int64))
            numbers.append(np.frombuffer(unpacker.decompress(d), np.uint64).reshape(3, -1))
        raw, grams, counts = np.frombuffer(b"".join(raws), np.uint8), np.concatenate(grams), np.concatenate(counts)
        keys, orders, places = np.concatenate(numbers, axis=1)
        del raws, numbers
        orders, places = orders.view(np.int64), places.view(np.int64)
        lengths = counts + LENGTH - 1
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(grams, kind="stable")
        # Runs of anchors with about AT_ONCE bytes.
        fresh = np.flatnonzero(np.r_[True, grams[order][1:] != grams[order][:-1]])
        before = (np.cumsum(lengths[order]) - lengths[order])[fresh] // AT_ONCE
        found = []
        for a, b in _runs(before):
            some = order[fresh[a]: fresh[b] if b < len(fresh) else len(order)]
            pieces = _pieces(raw, starts[some], lengths[some])
            found.append(_repeated(pieces, grams[some], counts[some], keys[some], orders[some], places[some]))
        return pa.Table.from_batches([batch_of(_covers(*map(np.concatenate, zip(*found)), routes))])

    return matched


def _kept(schema: pa.Schema):
    """For one range of keys: what is left of each text."""

    def kept(table: pa.Table) -> pa.Table:
        texts, covers = _texts(table)
        empty = np.zeros(0, np.uint64)
        keys, first, size = (
            np.concatenate([empty, *[unpack(row[name]) for row in covers]])
            for name, unpack in (("a", blobs.unpack_sorted), ("b", blobs.unpack), ("d", blobs.unpack)))
        order = np.argsort(keys, kind="stable")
        keys, first, last = keys[order], first[order].astype(np.int64), (first + size)[order].astype(np.int64)
        own = np.array(list(texts), np.uint64)
        begins, ends = np.searchsorted(keys, own), np.searchsorted(keys, own, "right")
        out = []
        for (raw, ids), a, b in zip(texts.values(), begins.tolist(), ends.tolist()):
            removed, spans, left = 0, 0, raw
            if a < b:
                edges = np.bincount(first[a:b], minlength=len(raw) + 1) - np.bincount(last[a:b], minlength=len(raw) + 1)
                gone = np.cumsum(edges)[:-1] > 0
                removed, spans = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            least, gone = min(ids), (len(raw), 1, b"") if len(raw) >= LENGTH else (0, 0, raw)
            for order in ids:
                result = (removed, spans, left) if order == least else gone
                out.append((None if order == _LAST else order, len(raw), *result))
        columns = list(zip(*out)) if out else [()] * len(schema)
        return pa.table([pa.array(column, field.type) for column, field in zip(columns, schema)], schema)

    return kept


def dedup(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every row."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    routes = routes_for(texts)
    size = texts.count()
    reports = stored(texts.mapInArrow(_reported, "content boolean, feature long, owners long, least long"), "anchors")
    common = shared_features.common_features(reports.filter("NOT content"), size)
    contents, least = shared_features.common_with_least(reports.filter("content"), size)
    sent = texts.mapInArrow(_texts_sent(routes), PARCEL)
    replies = texts.mapInArrow(_anchors_sent(common, routes), PARCEL).groupBy("route").applyInArrow(
        shared_features.shared(routes), PARCEL)
    cut = sent.unionAll(replies).groupBy("route").applyInArrow(_cuttings_sent(common, contents, least, routes), PARCEL)
    covers = cut.groupBy("route").applyInArrow(_matches(routes), PARCEL)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept", pa.binary())])
    return sent.unionAll(covers).groupBy("route").applyInArrow(
        _kept(schema), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
