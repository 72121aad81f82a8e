from collections import Counter

import pytest

from boxoffice.llm import line_dedup as ld
from boxoffice.llm.common import pick
from tests.conftest import SF_MID, SF_SMALL
from tests.oracle_compare import compare


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_equals_sql(spark, sf):
    ok, msg = compare(spark, "op8_line_dedup", sf)
    assert ok, msg


def brute(rows, least, sep="\n"):
    """Counts all units, then walks the texts in order of rank with a set of what has been seen."""
    import hashlib

    norm = lambda unit: " ".join(w.decode() for w in unit.encode().lower().split())
    rows = [(d, t or "") for d, t in rows]
    times = Counter(norm(u) for _, t in rows for u in t.split(sep))
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1].encode()).digest()))
    seen, out = set(), []
    for d, t in order:
        units = [norm(u) for u in t.split(sep)]
        counting, at = set(), 0
        while at < len(units):  # a run: repeated or empty units
            to = at
            while to < len(units) and (not units[to] or times[units[to]] > 1):
                to += 1
            run = [i for i in range(at, to) if units[i]]
            if sum(len(units[i].split()) for i in run) >= least:
                counting.update(run)
            at = to + 1
        place, kept, spans = 0, "", []
        for i, raw in enumerate(t.split(sep)):
            piece = raw + sep * (i < len(units) - 1)
            if i in counting and units[i] in seen:
                spans = spans[:-1] + [(spans[-1][0], place + len(piece))] if spans and spans[-1][1] == place else spans + [(place, place + len(piece))]
            else:
                kept += piece
            seen.add(units[i])
            place += len(piece)
        out.append((d, t, kept, ",".join(f"{a}:{b}" for a, b in spans if a < b), sum(len(units[i].split()) for i in counting)))
    return Counter(out)


ODD = [(3, "One line\nother\n\none  LINE\t\nlast"), (1, "other\nfresh é\n"), (2, None), (4, ""), (None, "other\nq"),
       (5, "\n\n \n"), (1, "other\nfresh é\n"), (6, "x\n" * 5000), (7, "É\né\nfresh é"), (None, "other\nq"), (8, "last"),
       (9, "a b c\n\nd e f\nown\nother"), (10, "a b c\nd e f\nother\nmore")]


@pytest.mark.parametrize("least", [1, 2, 6])
def test_odd_rows(make, clash, least):
    df = pick(clash(make(ODD)), "doc_id", "text")
    got = ld.dedup_units(df, min_run_words=least).collect()
    assert Counter((r.doc_id, r.text, r.kept, r.spans, r.n_repeated_words) for r in got) == brute(ODD, least)
    for r in got:
        spans = [tuple(map(int, s.split(":"))) for s in r.spans.split(",") if s]
        assert r.n_spans == len(spans) and r.n_removed == sum(len(r.text[a:b].encode()) for a, b in spans)
    assert ld.dedup_units(make([])).count() == 0


def test_short_common_lines_stay_and_passages_go(make):
    passage = "\n".join(f"line {i} of a passage" for i in range(6))
    rows = [(1, f"own words here\n{passage}\nOf."), (2, f"Of.\nsomething else\n{passage}"), (3, "Of.\nquite different")]
    got = {r.doc_id: r for r in ld.dedup_units(make(rows)).collect()}
    assert got[1].kept == rows[0][1] and got[1].n_repeated_words == 31  # the kept copy is told as well
    assert got[2].kept == "Of.\nsomething else\n" and got[3].kept == rows[2][1] and got[3].n_repeated_words == 0


def test_paragraphs(make):
    rows = [(1, "a b\nc\n\nd"), (2, "A  b\nC\n\ne"), (3, "d\n\nd")]
    got = ld.dedup_units(make(rows), "\n\n", 1).collect()
    assert {r.doc_id: r.kept for r in got} == {1: "a b\nc\n\nd", 2: "e", 3: ""}
    assert Counter((r.doc_id, r.text, r.kept, r.spans, r.n_repeated_words) for r in got) == brute(rows, 1, "\n\n")
