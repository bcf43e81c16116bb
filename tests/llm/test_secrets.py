import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stagetally.llm import queries, secrets

from .conftest import ODD

WORD = "".join
ASSIGN = re.compile(
    "(" + "|".join(WORD(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY])"
    + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def slow_base(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


def slow_runs(candidate, c):
    """Merged windows whose entropy, counted from nothing each time, is high."""
    runs = []
    for i in range(len(candidate) - c.window + 1):
        counts = Counter(candidate[i : i + c.window])
        bits = -sum(n / c.window * math.log2(n / c.window) for n in counts.values())
        if bits >= c.bits - 1e-9:
            if runs and runs[-1][1] >= i:
                runs[-1][1] = i + c.window
            else:
                runs.append([i, i + c.window])
    return runs


def slow_all(text):
    found = slow_base(text)
    whole = re.compile("|".join(f"(?:{a})" for a in (r"(.)\1*", *secrets.ALLOWED[1:])))
    for k, c in enumerate(secrets.CLASSES):
        for m in re.finditer(c.regex, text):
            if not whole.fullmatch(m.group()):
                found += [(m.start() + a, 3 + k, c.kind, m.start() + b) for a, b in slow_runs(m.group(), c)]
    return sorted(found)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


HEX = hashlib.sha256(b"1").hexdigest()
MIX = "qT7bZ2mX9cR4vK1pL8sW3nY6dF5gH0jA+e/uI_oE-rB"
TEXTS = [
    f'é\U0001f600 token = "{HEX[:40]}" and PassWord:abc passwd=abcdef; api_key: x.y-z=9+/_',
    "token=token:abcdefg secret=secret=abcdef apikey 'APIKEY' : 'aaaaaa'",
    "AKIA" + "Z9" * 8 + " AKIA" + "Z9" * 7 + " xAKIAAKIA" + "Q" * 16,
    f"{HEX}0 {HEX[:23]} {HEX[:24]} g{HEX[:30]}g {HEX.upper()}",
    f"see {MIX} and {MIX[:23]} or {'ab' * 40} {MIX}{'a' * 60}{MIX[::-1]}",
    "the-quick-brown-fox-jumps-over-the-lazy-dog 0123456789012345678901234567 Donaudampfschifffahrtsgesellschaft",
    "550e8400-e29b-41d4-a716-446655440000 " + "=" * 50,
    "K" + "tokeN = abcdefgh ſecret: abcdefgh",
]


@pytest.fixture(scope="module")
def rows():
    return ODD + [(20 + i, t) for i, t in enumerate(TEXTS)]


def test_query_against_brute_force(spark, docs, folder, rows):
    got = queries.op9_secrets(spark, folder(documents=docs(rows))).collect()
    assert len(got) == len(rows)
    found = {r["doc_id"]: r for r in got}
    for key, text in rows:
        base, r = slow_base(text or ""), found[key]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[2] == k for x in base) for k in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest()
        assert r["spans"] == joined(slow_all(text or ""))
    kinds = Counter(s.split(":")[0] for r in got for s in r["spans"].split(",") if s)
    assert set(kinds) == {"assign", "access", "hex", "entropy_hex", "entropy_text"}


def test_no_python_in_the_plan(spark, docs, folder, rows):
    plan = queries.op9_secrets(spark, folder(documents=docs(rows)))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_words_and_identifiers_are_no_secrets(spark, docs):
    df = secrets.secret_spans(docs([(1, TEXTS[5]), (2, TEXTS[6])]), "doc_id", "text")
    assert df.where(F.exists("all", lambda s: s["kind"].startswith("entropy"))).count() == 0


def test_empty_table(spark, docs, folder):
    assert queries.op9_secrets(spark, folder(documents=docs([]))).count() == 0
