from collections import Counter, defaultdict

import pytest

from boxoffice.llm import mixing as mx


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """{source: size} -> {source: target}, by sharing the excess again and again."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    spare, open_ = share * sum(sizes.values()), set(order)
    while spare > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        for s in open_:
            target[s] += spare * w[s] / total
        spare = 0.0
        for s in list(open_):
            if target[s] > most * sizes[s]:
                spare += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
        open_ = {s for s in open_ if target[s] < most * sizes[s]}
    return target


def size(text):
    return len((text or "").encode().split())


def check(rows, texts_sources):
    sizes = defaultdict(int)
    for _, text, source in texts_sources:
        sizes[source] += size(text)
    targets, taken = brute_targets(sizes), Counter()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((d, size(t)) for d, t, _ in texts_sources)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    return targets, taken


def test_given_documents(spark):
    from tests.conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = mx.mixture(docs).collect()
    targets, taken = check(rows, [(r.doc_id, r.text, r.source) for r in docs.collect()])
    assert all(taken[s] == round(targets[s]) for s in targets)
    # the whole epochs come first, and one document of a source at most is cut
    for s in targets:
        own = [r for r in rows if r.source == s and r.size]
        assert sum(r.taken % r.size != 0 for r in own) <= 1
        assert max(r.taken // r.size for r in own) - min(r.taken // r.size for r in own) <= 1
    again = mx.mixture(docs.repartition(7)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_odd_rows(make, clash):
    rows = [(1, "a b c", "en", "s"), (2, None, "en", "s"), (3, "", "en", "s"), (None, "d e", "en", "s"),
            (4, "one two three four five six", "en", None), (4, "one two three four five six", "en", None),
            (5, "x " * 3000, "en", "t"), (6, " \n ", "en", "empty"), (7, "é\x0bü", "en", "é"), (1, "a b c", "en", "s")]
    df = clash(make(rows))
    got = mx.mixture(df).collect()
    targets, taken = check(got, [(r[0], r[1], r[3]) for r in rows])
    for s in targets:
        assert targets[s] - 3 < taken[s] <= targets[s] + 1
    assert mx.mixture(make([])).count() == 0
    assert mx.mixture(make([(1, None), (2, "")])).agg({"taken": "sum"}).first()[0] == 0


def test_hot_source_of_many_copies(make):
    rows = [(7, "a b c d", None, "hot")] * 200 + [(i, "w " * i, None, f"s{i % 4}") for i in range(40)]
    got = mx.mixture(make(rows)).collect()
    targets, taken = check(got, [(r[0], r[1], r[3]) for r in rows])
    assert targets["hot"] - 200 < taken["hot"] <= targets["hot"] + 1


def test_mixed_documents(make, clash):
    rows = [(i, f" w{i}\ta b  c d{i} ", "en", f"s{i % 3}") for i in range(30)]
    df = clash(make(rows))
    out = mx.mixed_documents(df)
    assert out.schema == df.schema
    taken = {r.doc_id: r.taken for r in mx.mixture(df).collect()}
    got, whole = Counter(), {r[0]: r[1] for r in rows}
    for r in out.collect():
        assert whole[r[0]].startswith(r[1]) and r[4] == len(r[1])
        got[r[0]] += size(r[1])
    assert got == {d: t for d, t in taken.items() if t}
