import hashlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as cp
from boxoffice.llm import mixing, secret_scan as ss, toxicity as tx
from boxoffice.llm.common import pick, table, vocabulary_path
from boxoffice.llm.token_counts import read_ranks
from tests.conftest import SF_MID
from tests.llm.test_simhash import brute_components, brute_print

PEER = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                         mergeable_ranks=read_ranks(vocabulary_path("byte_bpe_50k.tiktoken")))


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Every stage's rows, each written as Parquet and read again."""
    docs, out = table(spark, SF_MID, "documents"), []
    for k, (_, stage) in enumerate(cp.STAGES):
        out.append(docs)
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF_MID).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*out, docs]


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_stages_return_the_columns_of_documents(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns and df.dtypes == steps[0].dtypes


def test_toxicity(spark, steps):
    before, after = steps[0], rows(steps[1])
    predicted = {r.doc_id: r.predicted for r in tx.toxicity(
        pick(before, "doc_id", "text"), pick(table(spark, SF_MID, "labels"), "doc_id", "toxic")).collect()}
    assert Counter(after) == Counter(r for r in rows(before) if not predicted[r[0]])
    assert len(after) < before.count()


def test_near_duplicates(steps):
    before, after = rows(steps[1]), rows(steps[2])
    group = brute_components([(r[0], brute_print(r[1])) for r in before])
    assert Counter(after) == Counter(r for r, c in zip(before, group) if r[0] == c)


def test_secrets(steps):
    want = Counter()
    for d, text, lang, source, n in rows(steps[2]):
        new = ss.redact(text)
        want[(d, new, lang, source, n if new == text else len(new))] += 1
    assert Counter(rows(steps[3])) == want


def test_mixing(steps):
    before, after = rows(steps[3]), rows(steps[4])
    size = lambda t: len((t or "").encode().split())
    taken, whole = Counter(), {r[0]: r for r in before}
    for d, text, _, source, n in after:
        assert whole[d][1].startswith(text) and whole[d][3] == source and (text != whole[d][1] or n == whole[d][4])
        taken[d] += size(text)
    own = {r.doc_id: r for r in mixing.mixture(steps[3]).collect()}
    assert taken == Counter({d: r.taken for d, r in own.items() if r.taken})
    by_source = Counter()
    for d, t in taken.items():
        by_source[whole[d][3]] += t
    for r in own.values():
        assert abs(by_source[r.source] - r.target) <= 1


def test_encoding_and_run(spark, steps):
    want = Counter()
    for d, text, _, source, _ in rows(steps[4]):
        ids = PEER.encode_ordinary(text)
        want[(d, source, tuple(ids), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(text.encode()).hexdigest())] += 1
    got = lambda df: Counter((r.doc_id, r.source, tuple(r.ids), r.n_tokens, r.ids_sha256, r.decoded_sha256)
                             for r in df.collect())
    assert got(steps[5]) == want
    assert got(cp.run(spark, SF_MID)) == want


def test_odd_documents(spark, make, clash):
    odd = clash(make([(1, None), (2, ""), (None, "no id"), (3, "password=abcdefgh x", "en", "s"), (3, "password=abcdefgh x", "en", "s"),
                      (4, "w " * 3000, None, "t")]))
    empty = make([])
    for docs in (odd, empty):
        columns = docs.columns
        for k, (_, stage) in enumerate(cp.STAGES):
            docs = stage(spark, docs, SF_MID)
            if k < 4:
                assert docs.columns == columns
        docs.count()
