"""Secret scan against Python's re and a plain recount of every window."""
import math
import re
from collections import Counter

from ripplet.llm import secrets
from ripplet.sources.tables import read_table
from tests.conftest import SF_SMALL


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    for k, c in enumerate(secrets.CLASSES):
        for m in re.finditer(c.pattern, text):
            if not re.search("[0-9]", m[0]) or re.search(secrets.ALLOW, m[0]):
                continue
            spans = []
            for i in range(len(m[0]) - c.width + 1):
                n = Counter(m[0][i:i + c.width]).values()
                bits = math.log2(c.width) - sum(x * math.log2(x) for x in n) / c.width
                if bits >= c.bits - 1e-9:
                    if spans and spans[-1][1] >= i:
                        spans[-1][1] = i + c.width
                    else:
                        spans.append([i, i + c.width])
            out += [(m.start() + a, 3 + k, m.start() + b, c.kind) for a, b in spans]
    return sorted(out)


def got(df):
    return [(r.doc_id, [tuple(s) for s in r.secrets]) for r in secrets.find_secrets(df).collect()]


def test_the_table(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {i: s for i, s in got(docs)} == {i: brute(t) for i, t in texts.items()}


def test_edges(spark):
    texts = [None, "", "password = 'abc' password: hunter22, API_KEY=\"x1y2z3\"", "token: token: abcdefgh", "\U0001F600é secret=abcdef é",
             "AKIA" + "Z" * 16 + " AKIAAKIA" + "0" * 15, "x" + "\ue000" + "deadbeef" * 3 + "\ue001 secret\ue000=abcdefg", "q8Zr4Kp0Lx2Vn7Bt5Wm9 and more",
             "550e8400-e29b-41d4-a716-446655440000", "EXAMPLEq8Zr4Kp0Lx2Vn7Bt5Wm9", "AbCdEfGhIjKlMnOpQrStUvWxYz", "q8Zr4Kp0Lx2Vn7Bt5Wm9" * 400,
             "a1" * 40 + "q8Zr4Kp0Lx2Vn7Bt5Wm9" + "b2" * 40, "SECRET:" + "A" * 5, "\n".join(["passwd=longenough"] * 300)]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(None, texts[2], "s"), (2, texts[2], "s")], "doc_id long, text string, secrets string")
    out = got(df)
    assert len(out) == len(texts) + 2
    for i, spans in out:
        assert spans == brute(texts[2 if i is None else i]), i
    assert any(s[3] == "entropy_token" for _, x in out for s in x)
    assert secrets.find_secrets(df.limit(0)).count() == 0


def test_main_path_is_native(spark):
    plan = secrets.find_secrets(read_table(spark, SF_SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
