"""Secret scans against plain searches of each text."""

import math
import random
import re
import time

from tidemark.llm import secrets

BASE = {
    "assign": (re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
               lambda m: len(m[2]) >= 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
}


ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_-"


def entropy(window):
    return -sum(window.count(c) / len(window) * math.log2(window.count(c) / len(window)) for c in set(window))


def brute(text):
    text = text or ""
    out = [(m.start(), k, m.end()) for k, kind in enumerate(BASE) for m in BASE[kind][0].finditer(text) if BASE[kind][1](m)]
    allowed = "|".join(f"(?:{p})" for p in secrets.ALLOW)
    for run in re.finditer(secrets.CANDIDATE, text):
        cuts = [(0, 0), *[m.span() for m in re.finditer(allowed, run[0])], (len(run[0]), len(run[0]))]
        for (_, a), (b, _) in zip(cuts, cuts[1:]):
            v = run[0][a:b]
            if not re.search("[0-9]", v) or not re.search("[A-Za-z]", v):
                continue
            least = secrets.THRESHOLDS["hex" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", v) else "mixed"]
            hit = [i for i in range(len(v) - secrets.WINDOW + 1) if entropy(v[i:i + secrets.WINDOW]) >= least]
            if hit:
                out.append((run.start() + a + hit[0], 3, run.start() + a + hit[-1] + secrets.WINDOW))
    return sorted(out)


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan(docs).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute(t), repr(t)


def test_forms(spark):
    check(spark, [
        None, "", "password=short", "password: token: abcdefghijklmnop", 'x "API_KEY": "abcdef.GHIJKL-12"', "tokentoken=abcdefghijkl",
        "token=secret=abcdefghijklmnop", "AKIA" + "A" * 13, "AKIA" + "B" * 14, "AKIAAKIA" + "C" * 14, "é漢 AKIA" + "D" * 16 + "漢 token=" + "x" * 12,
        "0123456789abcdef", "g" + "a" * 15, "g" + "a" * 16 + "G" + "0" * 40, "deadbeef" * 20, "password=" + "Zx9+" * 8 + " passwd : 'q.w=e-r/t_y1'",
    ])


def test_entropy_and_the_allow_list(spark):
    rng = random.Random(5)
    token = "".join(rng.choice(ALPHABET) for _ in range(40))
    check(spark, [
        token, "a" * 30 + "1", "q1" * 20, "a1" * 20, token + "a" * 30, "a" * 30 + token + "b" * 30, "123e4567-e89b-12d3-a456-426614174000",
        token + "EXAMPLE", "2024-01-02T10:11:12Z-abcdef", "/usr/lib/python3/dist-packages/some_long_module_name", "ABCDEF0123456789" * 3,
        " ".join("".join(rng.choice("abcdef0123456789") for _ in range(rng.randint(10, 70))) for _ in range(60)),
    ])
    assert brute(token) and not brute("q1" * 20)


def test_only_the_allowed_stretch_is_left_out(spark):
    rng = random.Random(8)
    key = "".join(rng.choice(ALPHABET[:62]) for _ in range(32))
    texts = [f"example/app/{key}", f"2024-01-02/{key}", f"{key}EXAMPLE", f"{key}/dummy/{key}", f"0123456789{key}", "example" * 9, f"dummy{key[:10]}example{key[:10]}"]
    check(spark, texts)
    for t in texts[:5]:
        assert [s for s in brute(t) if s[1] == 3]
    assert not brute(texts[5]) and not brute(texts[6])


def test_a_very_long_run_takes_linear_time(spark):
    """A run of a megabyte, and spans that begin and end at and across block borders."""
    rng = random.Random(9)
    token = "".join(rng.choice(ALPHABET[:62]) for _ in range(40))
    check(spark, ["a1" * n + token + "b2" * m for n, m in ((120, 400), (124, 1), (128, 300), (250, 3), (0, 128))])
    long = "".join(rng.choice(ALPHABET) for _ in range(1_000_000))
    docs = spark.createDataFrame([(1, long), (2, "x1" * 50_000 + token)], "doc_id long, text string")
    began = time.perf_counter()
    got = {r.doc_id: [tuple(s) for s in r.spans if s.kind == 3] for r in secrets.scan(docs).collect()}
    assert time.perf_counter() - began < 120
    assert got[1][0][0] < 100 and got[1][0][2] > 999_900
    assert got[2][0][0] > 99_980 and got[2][0][2] == 100_040


def test_random_texts(spark):
    rng = random.Random(6)
    parts = ["password", "=", ":", " ", "token", "AKIA", "0af3" * 5, "Zz9", "é", "\n", '"', "secret_", "api_key", "A1" * 9, "xY7+/_q8w3"]
    check(spark, ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(400)])


def test_a_long_text_with_very_many_matches(spark):
    check(spark, [" ".join(f"{i:016x}" for i in range(3000)), "z" * 300_000 + " token=" + "q" * 20])


def test_rows_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "a" * 16, "x"), (1, "a" * 16, "y"), (None, "0" * 16, "z")], "doc_id long, text string, spans string")
    assert [[tuple(s) for s in r.spans] for r in secrets.scan(docs).collect()] == [[(0, 2, 16)]] * 3
    assert secrets.scan(docs.limit(0)).count() == 0
