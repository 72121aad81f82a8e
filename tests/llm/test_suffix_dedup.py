import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from boxoffice.llm import suffix_dedup as sd
from boxoffice.llm.common import pick
from tests.conftest import SF_SMALL


def brute(texts, length=400):
    """For each text (bytes removed, runs removed, digest of the rest), from a table of all strings."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((len(d), int(gone.sum()), len(sd.runs(gone)[0]), hashlib.sha256(kept).hexdigest()))
    return out


def words(rng, n):
    return " ".join(rng.choice(["alpha", "bé", "gamma", "de", "epsilon", "ζ", "eta"]) + str(rng.randrange(1000)) for _ in range(n))


def check(df, texts):
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.dedup_report(df).collect())
    assert got == Counter((i, *b) for i, b in zip([i for i, _ in texts], brute([t for _, t in texts])))


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_and_common_prefixes(seed):
    rng = random.Random(seed)
    strings = [bytes(rng.choice(b"ab\0" if seed % 2 else b"abcdefgh") for _ in range(rng.randrange(0, 60))) for _ in range(12)]
    strings += [strings[0] * 2, b"a" * 100, b"a" * 90]
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    sizes = np.array([len(s) for s in strings])
    starts = np.cumsum(sizes + 1) - sizes - 1
    rest = np.repeat(starts + sizes, sizes + 1) - np.arange(len(data))
    sa, rank = sd.suffix_array(data, rest)
    # separators are negative and differ
    text = [(-1000 + int(np.searchsorted(starts, i, "right"))) if rest[i] == 0 else int(data[i]) for i in range(len(data))]
    order = sorted(range(len(data)), key=lambda i: text[i:])
    assert sa.tolist() == order and rank[sa].tolist() == list(range(len(data)))
    lcp = sd.common_prefixes(data, rest, starts, sa, rank, 50)
    for a, b in zip(order, order[1:]):
        if rest[b]:
            k = 0
            while text[a + k] == text[b + k] and k < 50:
                k += 1
            assert lcp[b] == k


def test_anchors_cover_every_window_once():
    rng = random.Random(3)
    for data in (words(rng, 900).encode(), b"a" * 9000, b"ab" * 4000 + b"c" * 500, b"x" * 400, b"x" * 399, b""):
        at, n, h, several = sd.anchors(data)
        covered = [a + k for a, m in zip(at.tolist(), n.tolist()) for k in range(m)]
        assert covered == list(range(max(0, len(data) - 399)))
        assert not len(n) or n.max() <= sd.STRETCH
    assert several.shape == (0,) and sd.anchors(b"a" * 9000)[3].all()


def test_short_texts_are_hashed_side_by_side(monkeypatch):
    rng = random.Random(5)
    texts = [words(rng, rng.randrange(0, 200)).encode() for _ in range(120)] + [b"", b"x" * 399, b"x" * 400, b"a" * 70_000, b"ab" * 600] * 2
    want = [(k, *x) for k, t in enumerate(texts) for x in zip(*(c.tolist() for c in sd.anchors(t)))]
    sizes, hashes = [], sd.string_hashes
    monkeypatch.setattr(sd, "string_hashes", lambda data, *a: sizes.append(len(data)) or hashes(data, *a))
    batch = pa.RecordBatch.from_arrays([pa.array([b"%d" % k for k in range(len(texts))]), pa.array([t.decode() for t in texts])], names=["t", "text"])
    got = pa.Table.from_batches(list(sd._anchored(iter([batch])))).to_pydict()
    assert list(zip([int(t) for t in got["t"]], got["at"], got["n"], np.array(got["h"], np.int64).view(np.uint64).tolist(), got["several"])) == want
    assert len(sizes) < 10  # not one by one
    monkeypatch.setattr(sd, "BLOCK", 1024)  # within a block, too
    which, at, n, _, _ = sd.anchors_of(texts)
    covered = [(k, a + j) for k, a, m in zip(which.tolist(), at.tolist(), n.tolist()) for j in range(m)]
    assert covered == [(k, j) for k, t in enumerate(texts) for j in range(max(0, len(t) - 399))]


def test_common_prefixes_of_long_enough_suffixes():
    rng = random.Random(7)
    strings = [bytes(rng.choice(b"ab\xff\x80\0") for _ in range(rng.randrange(0, 90))) for _ in range(9)] + [b"a" * 150, b"\xff" * 200]
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    sizes = np.array([len(s) for s in strings])
    starts = np.cumsum(sizes + 1) - sizes - 1
    rest = np.repeat(starts + sizes, sizes + 1) - np.arange(len(data))
    sa, rank = sd.suffix_array(data, rest)
    every = sd.common_prefixes(data, rest, starts, sa, rank, 70)
    assert (sd.common_prefixes(data, rest, starts, sa, rank, 70, 40) == np.where(rest >= 40, every, 0)).all()


def test_a_shard_sorts_only_what_may_be_repeated(monkeypatch):
    """Of stretches with a common anchor only the windows with a common hash get a suffix array."""
    rng = random.Random(11)
    anchor, passage = words(rng, 12), words(rng, 70)
    texts = [words(rng, 60) + anchor + words(rng, 60) for _ in range(20)] + [words(rng, 90) + passage + words(rng, 90) for _ in range(2)]
    texts += [texts[0]]
    rows = [(0, -1, 5, 1, b"%d" % k, 7 * k, t.encode()) for k, t in enumerate(texts)]
    shard = pa.table([list(c) for c in zip(*rows)], names=["g", "part", "h", "parts", "t", "at", "s"])
    sorted_, build = [], sd.suffix_array
    monkeypatch.setattr(sd, "suffix_array", lambda data, rest: sorted_.append(len(data)) or build(data, rest))
    found = sd._sharded(shard)
    got = {(int(t), x - 7 * int(t)) for t, a, b in zip(*(found.column(c).to_pylist() for c in ("t", "a", "b"))) for x in range(a, b)}
    data = [t.encode() for t in texts]
    seen = Counter(d[i:i + 400] for d in data for i in range(len(d) - 399))
    assert got == {(k, i) for k, d in enumerate(data) for i in range(len(d) - 399) if seen[d[i:i + 400]] > 1}
    assert sum(sorted_) < 2 * len(passage.encode()) + 10
    assert sd._sharded(shard.slice(1, 19)).num_rows == 0 and len(sorted_) == 1


def planted():
    rng = random.Random(9)
    passage, line = words(rng, 150), words(rng, 12)
    rows = [(i, words(rng, rng.randrange(5, 200)) + "\n" + line + "\n" + words(rng, 40)) for i in range(40)]
    rows += [(100 + i, words(rng, 30) + passage + words(rng, 60)) for i in range(12)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, rows[5][1][:450] + "x" + rows[5][1][450:]), (203, passage[:400]),
             (204, passage[:399]), (205, None), (206, ""), (None, "z" * 2000), (207, words(rng, 20) + passage + passage),
             (200, rows[3][1]), (208, "ab" * 3000 + words(rng, 50) + "ab" * 300), (209, "é" * 199 + "aé" + "é" * 199)]
    return rows


def test_planted_repeats(make, clash):
    rows = planted()
    check(pick(clash(make(rows)), "doc_id", "text"), rows)
    kept = Counter((r.doc_id, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in sd.dedup_repeats(make(rows)).collect())
    assert kept == Counter((i, b[3]) for (i, _), b in zip(rows, brute([t for _, t in rows])))
    assert sd.dedup_report(make([])).count() == 0
    assert sd.dedup_report(make([(1, None)])).collect()[0][1:4] == (0, 0, 0)


@pytest.mark.parametrize("windows", [1 << 16, 37])
def test_anchors_split_over_shards(make, monkeypatch, windows):
    """Tiny shards: common anchors are split, and the shards' lists are merged, in one range or in many."""
    monkeypatch.setattr(sd, "SHARD_BYTES", 1500)
    monkeypatch.setattr(sd, "RANGE_WINDOWS", windows)
    rows = planted()
    check(make(rows), rows)


def test_one_anchor_in_every_document(make, monkeypatch):
    """A passage in all texts, with and without what follows it, over many shards."""
    monkeypatch.setattr(sd, "SHARD_BYTES", 4000)
    rng = random.Random(4)
    passage = words(rng, 90)
    rows = [(i, words(rng, rng.randrange(3)) + passage[:rng.choice([380, 420, 500, len(passage)])] + words(rng, 5)) for i in range(90)]
    check(make(rows), rows)


def test_digests_tell_windows_apart():
    rng = random.Random(8)
    data = np.frombuffer((words(rng, 300) + "a" * 900 + words(rng, 50)).encode() * 2, np.uint8)
    digests = sd.window_digests(data).tolist()
    windows = [data[i:i + 400].tobytes() for i in range(len(data) - 399)]
    assert len(set(zip(digests, windows))) == len(set(digests)) == len(set(windows)) < len(windows)


def _list(h, windows, owners):
    """A shard's sorted list: {window: (owner number or -1, place)}."""
    keys = np.array([hashlib.blake2b(w, digest_size=16).digest() for w in windows], sd.DIGEST)
    order = np.argsort(keys)
    which, place = (np.array(x, np.int32)[order] for x in zip(*windows.values()))
    return {"h": h, "ranges": 5, "keys": keys[order].tobytes(), "which": which.tobytes(), "place": place.tobytes(), "owners": owners}


def test_lists_are_merged_by_whole_digests_into_runs():
    rng = random.Random(6)
    all_ = [rng.randbytes(8) for _ in range(300)]
    one = _list(7, {w: (0 if i % 50 else -1, i) for i, w in enumerate(all_[:200])}, [b"t1"])
    two = _list(7, {w: (i % 2, 1000 + i) for i, w in enumerate(all_[150:])}, [b"t2", b"t3"])
    lists = pa.Table.from_batches([pa.RecordBatch.from_pylist([r], schema=pa.schema([
        ("h", pa.int64()), ("ranges", pa.int64()), ("keys", pa.binary()), ("which", pa.binary()), ("place", pa.binary()), ("owners", pa.list_(pa.binary()))]))
        for r in (one, two)])
    ranged = pa.Table.from_batches(list(sd._ranged(iter(lists.to_batches()))))
    assert len(ranged) == 10 and set(ranged.column("range").to_pylist()) == set(range(5))
    got = set()
    for r in range(5):
        part = sd._merged(ranged.filter(pa.compute.equal(ranged.column("range"), r)))
        got |= {(t, x) for t, a, b in zip(*(part.column(c).to_pylist() for c in ("t", "a", "b"))) for x in range(a, b)}
    assert got == {(b"t1", i) for i in range(150, 200) if i % 50} | {((b"t2", b"t3")[i % 2], 1000 + i) for i in range(50)}
    whole = lists.select(["h", "keys", "which", "place", "owners"])
    assert sd._merged(whole).num_rows == 1 + 50  # t1's places follow each other, the others' do not


def test_query(spark):
    from boxoffice.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op2_suffix_dedup"](spark, SF_SMALL).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    assert got == {i: b for (i, _), b in zip(rows, brute([t for _, t in rows]))}
