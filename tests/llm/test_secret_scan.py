import hashlib
import re

import pytest

from boxoffice.llm import secret_scan as ss
from boxoffice.llm.common import pick

GOOD = "Zx" * 15
TOKEN = "ghp_" + GOOD + ss.checksum62(GOOD)


def brute(text):
    """Base spans by scanning the whole text with each expression, without a prefilter."""
    text = text or ""
    spans = [("assign", m.start(), m.end()) for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text, re.I | re.A) if len(m[2]) >= 6]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


CASES = [
    None, "", "password=hunter22", "PassWord' : \"abcdef\" passwd=abc secret:token=abcdefg",
    "api_key=abcdefAPIKEY = 123456", "xAKIA" + "Z" * 16 + " AKIA" + "Z" * 15, "AKIAAKIA" + "1" * 16,
    "é" * 5 + "0123456789abcdef01234567" + "İ secret=abcdef", "toKen=abcdefg", "secretoken=abcdefgh",
    "f" * 23 + "g" + "f" * 24, TOKEN, TOKEN + "x", TOKEN[:-1] + "!", "password" + " " * 5000 + "x",
    "token=" + "a" * 50_000, "password " * 3000 + "=abcdef",
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_equal_a_full_scan(text):
    assert [s for s in ss.find_secrets(text) if s[0] in ss.BASE_KINDS] == brute(text)


def test_checksum_decides():
    assert ("github", 3, 43) in ss.find_secrets("x: " + TOKEN + " y")
    wrong = TOKEN[:-1] + ("0" if TOKEN[-1] != "0" else "1")
    assert not ss.find_secrets("x: " + wrong)
    body = "B" * 30
    assert ss.find_secrets("npm_" + body + ss.checksum62(body))[0][0] == "npm"


def test_report(make, clash):
    df = clash(make([(i, t) for i, t in enumerate(CASES)] + [(None, CASES[2]), (2, CASES[2])]))
    rows = ss.secret_report(pick(df, "doc_id", "text")).collect()
    assert len(rows) == len(CASES) + 2
    texts = dict(enumerate(CASES))
    for r in rows:
        spans = brute(texts.get(r.doc_id, CASES[2]))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in spans) for k in ss.BASE_KINDS)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert ss.secret_report(pick(make([]), "doc_id", "text")).count() == 0


def test_redaction(make, clash):
    df = clash(make([(1, "a password=hunter22 b", "en"), (2, "clean"), (3, None), (4, "")]))
    out = ss.redact_secrets(df)
    assert out.columns == df.columns and out.schema == df.schema
    got = {r[0]: (r[1], r[4]) for r in out.collect()}
    assert got == {1: ("a [secret] b", 12), 2: ("clean", 5), 3: (None, None), 4: ("", 0)}
    for text in CASES:
        assert not ss.find_secrets(ss.redact(text))
