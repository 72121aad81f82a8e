import random

import xxhash

from boxoffice.llm import simhash as sh
from boxoffice.llm.common import pick
from boxoffice.llm.components import components


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """[(doc_id, fp)] -> component of each row, comparing all with all."""
    fps = sorted({fp for _, fp in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for d, fp in rows:
        if d is not None:
            least[find(fp)] = min(d, least.get(find(fp), d))
    return [least.get(find(fp)) for _, fp in rows]


def check(df, rows):
    want = [(d, brute_print(t)) for d, t in rows]
    want = sorted(((d, f"{fp:016x}", c) for (d, fp), c in zip(want, brute_components(want))), key=str)
    assert sorted((tuple(r) for r in sh.near_duplicates(df).collect()), key=str) == want


def test_small_tables(make, clash):
    rows = [(5, "a b c d"), (3, "A B  C\tD"), (9, None), (7, ""), (8, "  \n"), (1, "one"), (2, "one two"),
            (None, "only null id"), (4, "ONE"), (6, "x " * 30_000), (5, "a b c d"), (11, "é È"), (12, "É È")]
    check(pick(clash(make(rows)), "doc_id", "text"), rows)
    assert sh.near_duplicates(make([])).count() == 0


def test_given_documents(spark):
    from boxoffice.llm.queries import QUERIES
    from tests.conftest import SF_SMALL

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = [(d, brute_print(t)) for d, t in rows]
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in QUERIES["op6_simhash"](spark, SF_SMALL).collect()}
    assert got == {d: (fp, c) for (d, fp), c in zip(want, brute_components(want))}


def planted(n, seed=1):
    """Random fingerprints, chains and dense balls of near ones, and some just too far."""
    rng = random.Random(seed)
    out = set()
    for _ in range(n):
        x = rng.getrandbits(64)
        out.add(x)
        for _ in range(rng.choice([0, 0, 1, 5])):
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 3, 4])):
                x ^= 1 << b
            out.add(x)
    center = rng.getrandbits(64)
    out |= {center ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(0, 64, 9)}
    return sorted(out)


def linked(spark, fps, **options):
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in components(sh.near_links(df, **options)).collect()}
    groups = {}
    for f in fps:
        s = f - (1 << 64) if f >> 63 else f
        groups.setdefault(roots.get(s, s), set()).add(f)
    return sorted(map(sorted, groups.values()))


def test_links_equal_all_pairs(spark):
    fps = planted(400)
    group = {}
    for f, c in zip(fps, brute_components([(i, f) for i, f in enumerate(fps)])):
        group.setdefault(c, set()).add(f)
    want = sorted(map(sorted, group.values()))
    assert linked(spark, fps) == want
    # crowded cells cut into tiles give the same
    assert linked(spark, fps, limit=32) == want


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 50)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(make, clash):
    rows = [(5, "a b c d", "en", "s"), (3, "A B C D", "en", "s"), (3, "A B C D", "en", "s"), (None, "a b c d"),
            (9, "other words here now"), (None, "no id at all here"), (8, None), (7, "")]
    df = clash(make(rows))
    out = sh.keep_one(df)
    assert out.columns == df.columns and out.schema == df.schema
    assert sorted((r[0] or -1, r[1]) for r in out.collect()) == [
        (-1, "no id at all here"), (3, "A B C D"), (7, ""), (9, "other words here now")]
