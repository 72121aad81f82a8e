"""Removal of repeated byte strings by suffix arrays.

A string of LENGTH bytes that starts at two places is found in two steps.

Every window of LENGTH bytes has an anchor, the smallest hash of the strings of
ANCHOR bytes in it; equal windows have equal anchors. Stretches of windows
whose anchor occurs at one place only are left out. The others go, with their
bytes, to a shard by their anchor.

Each shard builds the suffix array of its different stretches, as far as they
have windows of one hash in common, by the refinement of Larsson and Sadakane:
ranks by a few bytes, then twice as many in each round, sorting again only what
is still tied. Kasai's walk gives the common prefixes of neighbours. An anchor
with too many bytes for one shard is split over several, with whole stretches;
each then puts the digest of one window of each of its classes into a sorted
list. The lists are cut into ranges of digests, as many as the
number of different windows asks for, and merged by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.llm.common import cut, join_classes

# Production parameters. ANCHOR must be a power of two below LENGTH.
LENGTH, ANCHOR = 400, 64
SHARD_BYTES = 1_000_000  # of stretches that a shard holds, before equal ones become one
STRETCH = 2_048  # windows in a stretch, at most
WALK = 64  # places that one step of the common-prefix walk takes in each of many stretches
BLOCK = 1 << 20  # bytes of a text that are hashed at once
GROUP = 1 << 16  # bytes of short texts that are hashed side by side, about
RANGE_WINDOWS = 1 << 16  # windows of an anchor's lists that are merged at once, about
DIGEST = "S16"  # of a window, as a numpy type

MIX, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)


def string_hashes(data: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the string of ``length`` bytes at each place, from hashes of powers of two."""
    last = len(data) - length + 1
    level, size, out, at = (data.astype(np.uint64) + np.uint64(seed * 2 + 1)) * STEP, 1, None, 0
    while True:
        if length & size:
            part = level[at:at + last]
            out = part if out is None else (out * STEP) ^ (part + (out >> np.uint64(31)))
            at += size
        if size * 2 > length:
            return out
        left, right = level[:-size], level[size:]
        level = ((left * STEP) ^ (right + (left >> np.uint64(29)))) * MIX
        level ^= level >> np.uint64(31)
        size *= 2


def window_digests(data: np.ndarray) -> np.ndarray:
    """128 bits for the window of LENGTH bytes at each place: two hashes side by side, to be compared as one."""
    pair = np.stack([string_hashes(data, LENGTH, seed) for seed in (1, 2)], axis=1)
    return np.ascontiguousarray(pair.astype(">u8")).view(DIGEST)[:, 0]


def anchors_of(texts: list[bytes], length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Stretches of windows with one anchor: number of the text, first window, number of windows, anchor, and whether it is there
    at several places.

    A window's anchor is the leftmost of those with the smallest hash (as far
    as its upper bits go); the places of equal anchors in a row make one stretch.
    Short texts are hashed side by side, windows over the end of one left out.
    """
    found = []
    sizes = np.array([len(t) for t in texts], np.int64)
    wide = length - anchor + 1  # anchors in a window
    low = np.uint64(2 * BLOCK - 1)
    edges = np.flatnonzero(np.append(True, np.diff((np.cumsum(sizes) - sizes) // GROUP) > 0)).tolist() if len(texts) else []
    for a, b in zip(edges, [*edges[1:], len(texts)]):
        bytes_ = np.frombuffer(b"".join(texts[a:b]), dtype=np.uint8)
        ends = np.cumsum(sizes[a:b])
        owners = np.repeat(np.arange(b - a), sizes[a:b])
        for at in range(0, len(bytes_) - length + 1, BLOCK):
            own = string_hashes(bytes_[at:at + BLOCK + length - 1], anchor)
            n = len(own) - wide + 1
            window = np.flatnonzero(ends[owners[at:at + n]] - np.arange(at, at + n) >= length)
            if not len(window):
                continue
            padded = np.full(-(-len(own) // wide) * wide, np.iinfo(np.uint64).max, dtype=np.uint64)
            padded[:len(own)] = own & ~low | np.arange(len(own), dtype=np.uint64)
            rows = padded.reshape(-1, wide)
            ahead = np.minimum.accumulate(rows, axis=1).ravel()
            behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
            place = (np.minimum(behind[:n], ahead[wide - 1:wide - 1 + n])[window] & low).astype(np.int64)
            moved = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            hashes, owner = own[place[moved]], owners[at + place[moved]]
            new = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])))
            first, places = moved[new], np.diff(np.append(new, len(moved)))
            size = np.diff(np.append(first, len(window)))
            pieces = -(-size // STRETCH)  # long repetitive stretches, in pieces
            which = np.repeat(np.arange(len(first)), pieces)
            k = (np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * STRETCH
            text = owner[new][which]
            found.append((text + a, window[first][which] + k + at - (ends - sizes[a:b])[text], np.minimum(size[which] - k, STRETCH),
                          hashes[new][which], places[which] > 1))
    if not found:
        return tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, bool))
    return tuple(np.concatenate(x) for x in zip(*found))


def anchors(data: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """The stretches of one text, without its number."""
    return anchors_of([data], length, anchor)[1:]


def suffix_array(data: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse of strings that each end with a separator.

    ``rest``: bytes up to the separator, 0 at it. Separators come before all
    bytes and among themselves in order of place.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key |= np.where(rest > j, padded[j:j + n], np.uint64(0)) << np.uint64(8 * (7 - j))
    key |= np.minimum(rest, 7).astype(np.uint64)
    sa = np.argsort(key)
    ended = np.flatnonzero(rest[sa] < 7)  # the key holds their separator: sorted but for its place
    sa[ended] = sa[ended][np.lexsort((sa[ended], key[sa[ended]]))]
    key = key[sa]
    first = np.append(True, key[1:] != key[:-1]) | (rest[sa] < 7)
    sa = sa.astype(np.int32)
    rank = np.empty(n, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(first, np.arange(n, dtype=np.int32), 0))
    tied = np.flatnonzero(~(first & np.append(first[1:], True))).astype(np.int32)
    h = 7
    while len(tied):
        place = sa[tied]
        pair = (rank[place].astype(np.int64) << 32) | rank[place + h]
        order = np.argsort(pair)
        place, pair = place[order], pair[order]
        sa[tied] = place
        first = np.append(True, pair[1:] != pair[:-1])
        rank[place] = tied[np.maximum.accumulate(np.where(first, np.arange(len(tied), dtype=np.int32), 0))]
        tied = tied[~(first & np.append(first[1:], True))]
        h *= 2
    return sa, rank


def common_prefixes(data: np.ndarray, rest: np.ndarray, starts: np.ndarray, sa: np.ndarray, rank: np.ndarray,
                    most: int, least: int = 1) -> np.ndarray:
    """For each place with ``least`` bytes or more up to its separator, the common prefix (up to ``most``) with the suffix before
    it in the array; 0 for the others.

    Kasai's walk: one place further in a string, the common prefix is shorter by
    one byte at most. All stretches of WALK places are walked at once.
    """
    n = len(data)
    words = np.zeros(n + most + 16, np.uint64)
    padded = np.concatenate([data, np.zeros(most + 24, np.uint8)]).astype(np.uint64)
    for j in range(8):
        words |= padded[j:j + len(words)] << np.uint64(8 * (7 - j))
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, np.int32)
    places = np.maximum(rest[starts] - least + 1, 0)
    pieces = -(-places // WALK)
    k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    lengths = np.minimum(np.repeat(places, pieces) - k * WALK, WALK)
    starts = np.repeat(starts, pieces) + k * WALK
    order = np.argsort(-lengths)
    starts, lengths = starts[order], lengths[order]
    same = np.zeros(len(starts), np.int64)
    for j in range(WALK):
        m = int(np.searchsorted(-lengths, -j, "left"))  # stretches longer than j
        i = starts[:m] + j
        q = before[i]
        same = np.where(q >= 0, np.maximum(same[:m] - 1, 0), 0)
        go = np.flatnonzero((q >= 0) & (same < most))
        while len(go):
            x = words[i[go] + same[go]] ^ words[q[go] + same[go]]
            # leading equal bytes, from the place of the highest bit (the one below it off, so that no rounding moves it)
            more = (64 - np.frexp((x & ~(x >> np.uint64(1))).astype(np.float64))[1].astype(np.int64)) >> 3
            same[go] += more
            go = go[(more == 8) & (same[go] < most)]
        same = np.minimum(np.minimum(same, most), np.minimum(rest[i], np.where(q >= 0, rest[q], 0)))
        out[i] = same
    return out


def repeats(strings: list[bytes], length: int = LENGTH) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each string: which of its windows occur in more than one place, and which stand for their class.

    A string has len - length + 1 windows.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    data = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    rest = np.repeat(starts + sizes, sizes + 1) - np.arange(len(data))
    sa, rank = suffix_array(data, rest)
    joined = common_prefixes(data, rest, starts, sa, rank, length, length)[sa] >= length
    repeated, leads = np.zeros(len(data), bool), np.zeros(len(data), bool)
    repeated[sa] = joined | np.append(joined[1:], False)
    leads[sa] = ~joined
    spans = [slice(a, a + max(n - length + 1, 0)) for a, n in zip(starts.tolist(), sizes.tolist())]
    return [repeated[s] for s in spans], [leads[s] for s in spans]


def shared(strings: list[bytes], length: int = LENGTH) -> list[tuple[int, int]]:
    """For each string (of ``length`` bytes or more) the part that holds all windows whose hash occurs in another place too; (0, 0)
    if there is none.

    Equal windows have equal hashes, so what lies outside occurs once.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    counts = sizes - length + 1
    ends = np.cumsum(counts)
    window = np.arange(ends[-1]) + np.repeat(np.cumsum(sizes) - sizes - ends + counts, counts)
    hashes = np.concatenate([string_hashes(data[at:at + GROUP + length - 1], length) for at in range(0, len(data) - length + 1, GROUP)])[window]
    order = np.argsort(hashes)
    equal = np.diff(hashes[order]) == 0
    again = np.zeros(len(hashes), bool)
    again[order] = np.append(equal, False) | np.append(False, equal)
    found = np.flatnonzero(again)
    a, b = np.searchsorted(found, ends - counts), np.searchsorted(found, ends)
    return [(int(found[i] - start), int(found[j - 1] - start) + length) if i < j else (0, 0)
            for i, j, start in zip(a.tolist(), b.tolist(), (ends - counts).tolist())]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of runs of true flags, and the places after their last."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


# ---------------------------------------------------------------- tasks

ANCHORS = "t binary, at int, n int, h long, several boolean"
STRETCHES = "g long, part int, h long, parts int, t binary, at int, s binary"
FOUND = "t binary, a int, b int, h long, n long, keys binary, which binary, place binary, owners array<binary>"
FOUND_SCHEMA = pa.schema([("t", pa.binary()), ("a", pa.int32()), ("b", pa.int32()), ("h", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()),
                          ("which", pa.binary()), ("place", pa.binary()), ("owners", pa.list_(pa.binary()))])
LISTS = "h long, range int, keys binary, which binary, place binary, owners array<binary>"


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(t, text) -> the texts' stretches."""
    for batch in batches:
        which, at, n, h, several = anchors_of(batch.column(1).cast(pa.binary()).to_pylist())
        if len(which):
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which)), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)),
                                              pa.array(h.view(np.int64)), pa.array(several)], names=["t", "at", "n", "h", "several"])


def _stretches(shards: int):
    """(t, packed text, its suspicious stretches) -> their bytes, dealt to shards.

    Those of a split anchor are dealt by their place, so that no shard gets more
    than its part, however many are equal.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for t, z, found in zip(*(c.to_pylist() for c in batch.columns)):
                data, rows = unpack(z), []
                for c in found:
                    s = data[c["at"]:c["at"] + c["n"] + LENGTH - 1]
                    split = c["parts"] > 1
                    place = hashlib.blake2b(t + c["at"].to_bytes(8), digest_size=8).digest()
                    part = int.from_bytes(place) % c["parts"] if split else -1
                    rows.append((c["h"] if split else c["h"] % shards, part, c["h"], c["parts"], t, c["at"], s))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary()))],
                    names=["g", "part", "h", "parts", "t", "at", "s"])
    return run


def _found(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[] for _ in FOUND_SCHEMA]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, FOUND_SCHEMA)], schema=FOUND_SCHEMA)


def _places(rows: list[tuple]) -> pa.Table:
    """Places of repeated windows, as (t, a, b)."""
    return _found([(*r, None, None, None, None, None, None) for r in rows])


def _sharded(shard: pa.Table) -> pa.Table:
    """A shard's stretches -> places of repeated windows, and for a split anchor a sorted list of its classes."""
    where: dict[bytes, list[tuple[bytes, int]]] = {}
    for t, at, s in zip(*(shard.column(c).to_pylist() for c in ("t", "at", "s"))):
        where.setdefault(s, []).append((t, at))
    strings = list(where)
    h, parts = shard.column("h")[0].as_py(), shard.column("parts")[0].as_py()
    if parts > 1:  # the others of the anchor's shards have to see all classes
        repeated, leads = repeats(strings)
    else:
        repeated, leads = [np.zeros(len(s) - LENGTH + 1, bool) for s in strings], []
        spans = [(k, a, b) for k, (a, b) in enumerate(shared(strings)) if a < b]
        for (k, a, b), flags in zip(spans, repeats([strings[k][a:b] for k, a, b in spans])[0] if spans else []):
            repeated[k][a:b - LENGTH + 1] = flags
    rows: list[tuple] = []
    keys, which, place = [], [], []
    for k, s in enumerate(strings):
        flags = repeated[k] if len(where[s]) == 1 else np.ones(len(repeated[k]), bool)
        for a, b in zip(*runs(flags)):
            rows += [(t, at + int(a), at + int(b)) for t, at in where[s]]
        if parts > 1:
            lead = np.flatnonzero(leads[k])
            keys.append(window_digests(np.frombuffer(s, dtype=np.uint8))[lead])
            # what is known to be repeated only has to be seen by the others: no owner
            which.append(np.where(flags[lead], -1, k))
            place.append(lead + where[s][0][1])
    out = _places(rows)
    if keys:
        keys, which, place = (np.concatenate(x) for x in (keys, which, place))
        order = np.argsort(keys, kind="stable")
        names, number = np.unique(which[order], return_inverse=True)
        owner = number - int(names[0] < 0)  # -1 stays the first of all
        owners = [where[strings[k]][0][0] for k in names.tolist() if k >= 0]
        out = pa.concat_tables([out, _found([(None, None, None, h, len(keys), keys[order].tobytes(), owner.astype(np.int32).tobytes(),
                                             place[order].astype(np.int32).tobytes(), owners)])])
    return out


def _ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted lists (h, ranges, keys, ...) -> their parts by range of keys; empty ones are none."""
    for batch in batches:
        for row in batch.to_pylist():
            keys = np.frombuffer(row["keys"], DIGEST)
            which, place = (np.frombuffer(row[c], np.int32) for c in ("which", "place"))
            high = np.frombuffer(row["keys"], ">u4")[::4].astype(np.uint64)  # the first four bytes of each digest
            ranges = (high * np.uint64(row["ranges"]) >> np.uint64(32)).astype(np.int64)
            edges = np.flatnonzero(np.append(True, np.diff(ranges) != 0))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(keys)]):
                names, number = np.unique(which[a:b], return_inverse=True)
                owner = (number - int(names[0] < 0)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["h"]]), pa.array([int(ranges[a])], pa.int32()), pa.array([keys[a:b].tobytes()], pa.binary()),
                     pa.array([owner.tobytes()], pa.binary()), pa.array([place[a:b].tobytes()], pa.binary()),
                     pa.array([[row["owners"][k] for k in names.tolist() if k >= 0]], pa.list_(pa.binary()))],
                    names=["h", "range", "keys", "which", "place", "owners"])


def _merged(lists: pa.Table) -> pa.Table:
    """Sorted lists of an anchor's shards in one range of keys -> places of windows that are in several."""
    keys, which, place = ([np.frombuffer(x, kind) for x in lists.column(c).to_pylist()]
                          for c, kind in (("keys", DIGEST), ("which", np.int32), ("place", np.int32)))
    every = np.sort(np.concatenate(keys), kind="stable")  # merges sorted lists
    rows = []
    for k, w, p, names in zip(keys, which, place, lists.column("owners").to_pylist()):
        several = np.searchsorted(every, k, "right") - np.searchsorted(every, k, "left") > 1
        found = np.flatnonzero(several & (w >= 0))
        found = found[np.lexsort((p[found], w[found]))]
        # windows in a row of one owner make one run
        new = np.append(True, (np.diff(w[found]) != 0) | (np.diff(p[found]) != 1)) if len(found) else np.empty(0, bool)
        first = np.flatnonzero(new)
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(found)]):
            rows.append((names[w[found[a]]], int(p[found[a]]), int(p[found[b - 1]]) + 1))
    return _places(rows)


RESULT = T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                       T.StructField("kept", T.BinaryType())])


def without(data: bytes, a: np.ndarray, b: np.ndarray) -> tuple[int, int, bytes]:
    """Removed bytes, removed runs and what is left, if the windows from a to b (exclusive) go."""
    step = np.zeros(len(data) + 1, np.int64)
    np.add.at(step, a, 1)
    np.add.at(step, b - 1 + LENGTH, -1)
    gone = np.cumsum(step)[:-1] > 0
    kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
    return int(gone.sum()), len(runs(gone)[0]), kept


@F.arrow_udf(T.BinaryType())
def _packed(texts: pa.Array) -> pa.Array:
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    return pa.array([pack(t.encode()) for t in texts.to_pylist()], pa.binary())


@F.arrow_udf(RESULT)
def _rest(texts: pa.Array, windows: pa.Array) -> pa.Array:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    rows = []
    for z, found in zip(texts.to_pylist(), windows.to_pylist()):
        a, b = (np.array([w[c] for w in found], np.int64) for c in ("a", "b"))
        rows.append(dict(zip(RESULT.names, without(unpack(z), a, b))))
    return pa.array(rows, pa.struct([("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]))


def repeated_windows(texts: DataFrame, packed: DataFrame) -> DataFrame:
    """(t, a, b): in text ``t`` the windows from a to b (exclusive) also start elsewhere.

    ``texts``: (t, text), rows of one ``t`` being equal; ``packed``: one row of
    (t, z) for each.
    """
    stretches = texts.filter(F.octet_length("text") >= LENGTH).mapInArrow(_anchored, ANCHORS)
    place = F.xxhash64("t", "at")
    size = (F.col("n") + LENGTH - 1).cast("long")
    often = cut(stretches.groupBy("h").agg(F.min(place).alias("p"), F.max(place).alias("q"), F.sum(size).alias("size"),
                                              F.max("several").alias("several"), F.count("*").alias("n_stretches"))
                .filter("p != q or several").select("h", "size", "n_stretches", F.ceil(F.col("size") / SHARD_BYTES).cast("int").alias("parts")))
    total, most = often.agg(F.sum("size"), F.max("parts")).first()
    shards = -(-(total or 0) // SHARD_BYTES) or 1
    # an anchor may be in every text: its stretches are spread
    suspicious = join_classes(stretches, often.select("h", "parts", "n_stretches"), "h", "n_stretches", ["t", "at"]).groupBy("t").agg(
        F.collect_set(F.struct("at", "n", "h", "parts")).alias("found"))
    dealt = packed.join(suspicious, "t").select("t", "z", "found").mapInArrow(_stretches(shards), STRETCHES)
    found = cut(dealt.groupBy("g", "part").applyInArrow(_sharded, FOUND))
    out = found.filter("t is not null").select("t", "a", "b")
    if (most or 1) > 1:
        lists = found.filter("t is null")
        ranges = lists.groupBy("h").agg(F.sum("n").alias("all")).select("h", F.ceil(F.col("all") / RANGE_WINDOWS).cast("long").alias("ranges"))
        lists = lists.join(ranges, "h").select("h", "ranges", "keys", "which", "place", "owners").mapInArrow(_ranged, LISTS)
        out = out.union(lists.groupBy("h", "range").applyInArrow(_merged, FOUND).select("t", "a", "b"))
    return out


def _removals(docs: DataFrame, kept) -> DataFrame:
    """Every row with what is removed from it; ``kept`` makes of the bytes left what is carried on."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    name = F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, 16)
    texts = base.select(name.alias("t"), "text")
    packed = texts.filter(F.octet_length("text") >= LENGTH).select("t", _packed("text").alias("z")).groupBy("t").agg(
        F.any_value("z").alias("z"))
    windows = repeated_windows(texts, packed).groupBy("t").agg(F.collect_list(F.struct("a", "b")).alias("w"))
    done = packed.join(windows, "t").select("t", _rest("z", "w").alias("r")).select(
        "t", "r.n_removed", "r.n_spans", kept(F.col("r.kept")).alias("kept"))
    rows = base.select("doc_id", name.alias("t"), F.octet_length("text").cast("long").alias("n_bytes"),
                       kept(F.col("text").cast("binary")).alias("whole"))
    what = cut(rows.groupBy("t").agg(F.count("*").alias("copies")).join(done, "t", "left"))
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    return join_classes(rows, what, "t", "copies", ["doc_id"]).select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, kept(F.lit(b""))).otherwise(F.coalesce("kept", "whole")).alias("kept"))


def dedup_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes that are left) of every row.

    A byte goes if it lies in a string of LENGTH bytes that also starts anywhere
    else; all is judged on the input. Null texts count as empty. Of equal texts
    of LENGTH bytes or more nothing is left, in repeated rows too. An empty
    table stays empty.
    """
    return _removals(docs, lambda data: data)


def dedup_report(docs: DataFrame) -> DataFrame:
    """``dedup_repeats`` with a digest in place of the bytes, which then need not be moved."""
    return _removals(docs, lambda data: F.sha2(data, 256)).withColumnRenamed("kept", "kept_sha256")
