"""Secret scans: against one expression per kind, checksums, replacement, odd inputs."""

import base64
import hashlib
import json
import random
import re
import time
import zlib

import pytest

from veritab.llm import secret_scan as s

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)


def brute(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[1], s.BASE_KINDS.index(x[0])))


def base(spans):
    return [x for x in spans if x[0] in s.BASE_KINDS]


def test_scanner_matches_the_expressions_on_random_texts():
    rng = random.Random(11)
    bits = ["password", "PassWord", "passwd", "secret", "token", "api_key", "apikey", "ApI_kEy", "AKIA", "akia",
            "=", ":", " ", "  ", "\t", '"', "'", "abc123", "A1B2C3", "0f" * 12, "deadbeef", "Z", "ſecret", "toKen",
            "İ", "é", "\n", "x", "AKIA" + "Q7" * 9, ".", "-", "==", "secretpassword"]
    scan = s.Scanner()
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert base(scan(text)) == brute(text), text


def checksummed(kind, body):
    return kind + body + s.base62(zlib.crc32(body.encode())).rjust(6, "0")


def test_added_kinds_need_what_they_carry():
    scan = s.Scanner()
    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    good = checksummed("ghp_", body)
    assert ("github", 3, 3 + len(good)) in scan("by " + good + ".")
    assert ("npm", 0, 40) in scan(checksummed("npm_", body))
    assert not any(x[0] == "github" for x in scan("by " + good[:-1] + ("A" if good[-1] != "A" else "B")))
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).decode().rstrip("=")
    assert [x[0] for x in scan(f"{head}.e30.c2ln")] == ["jwt"]
    other = base64.urlsafe_b64encode(b'{"x": 1}').decode().rstrip("=")
    assert scan(f"{other}.e30.c2ln") == [] and scan("eyJ.eyJ.eyJ") == []
    pem = "-----BEGIN RSA PRIVATE KEY-----\nMIIB\n-----END RSA PRIVATE KEY-----"
    assert [x[0] for x in scan("k " + pem)] == ["private_key"]


ROWS = [(1, "token = abcdef7 and İ secret: 'q w"), (2, None), (3, ""), (4, "x" * 300_000 + " AKIA" + "B2" * 10),
        (1, "token = abcdef7 and İ secret: 'q w"), (None, "0123456789abcdef01234567"), (6, "clean words only")]


def test_digest_rows(spark):
    docs = spark.createDataFrame([(*r, 7, "kind") for r in ROWS], "doc_id long, text string, spans int, start string")
    got = s.digest(docs).collect()
    assert len(got) == len(ROWS)
    want = sorted(str((i, sum(x[0] == "assign" for x in b), sum(x[0] == "access" for x in b),
                       sum(x[0] == "hex" for x in b),
                       hashlib.sha256(",".join("%s:%d:%d" % x for x in b).encode()).hexdigest()))
                  for i, t in ROWS for b in [brute(t or "")])
    assert sorted(str(tuple(r)[:5]) for r in got) == want
    assert s.digest(docs.limit(0)).collect() == []


def test_redact_replaces_and_keeps_the_rest(spark):
    docs = spark.createDataFrame([(*r, len(r[1] or ""), "c") for r in ROWS],
                                 "doc_id long, text string, n_chars long, clean string")
    out = s.redact(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = out.collect()
    assert len(got) == len(ROWS) and all(r["clean"] == "c" for r in got)
    for r in got:
        assert r["text"] is None or base(s.Scanner()(r["text"])) == []
        assert r["n_chars"] == len(r["text"] or "")
    texts = {r["doc_id"]: r["text"] for r in got}
    assert texts[1] == "[assign] and İ secret: 'q w" and texts[6] == "clean words only" and texts[2] is None
    assert s.merged([("assign", 0, 9), ("hex", 5, 12), ("hex", 12, 14)]) == [("assign", 0, 12), ("hex", 12, 14)]


@pytest.mark.parametrize("unit, n", [("eyJ", 1_000_000), ("eyJa.", 600_000), ("eyJ_" * 50 + ".", 15_000), ("token ", 500_000),
                                     ("akia", 750_000), ("ghp_", 750_000), ("-----BEGIN PRIVATE KEY-----", 110_000)])
def test_texts_of_nothing_but_keywords_take_linear_time(unit, n):
    began = time.perf_counter()
    s.Scanner()(unit * n)
    assert time.perf_counter() - began < 20


def test_a_failed_run_hides_no_later_token():
    head = base64.urlsafe_b64encode(b'{"alg": "none"}').decode().rstrip("=")
    token = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", re.A)
    rng, scan, seen = random.Random(4), s.Scanner(), 0
    for _ in range(3000):
        text = "".join(rng.choices(["eyJ", ".", "a", "-", " ", head, f"{head}.e30.", "EYJ"], k=rng.randint(1, 14)))
        want, free = [], 0
        for at in range(len(text)):      # from every place that no match before took
            m = token.match(text, at) if at >= free else None
            if m is not None:
                free = m.end()
                if s.jwt_header_ok(m):
                    want.append(m.span())
        assert [x[1:] for x in scan(text) if x[0] == "jwt"] == want, text
        seen += len(want)
    assert seen > 200


def test_a_keyword_in_other_case_hides_no_token_behind_it():
    head = base64.urlsafe_b64encode(b'{"alg": "none"}').decode().rstrip("=")
    for before in ("EYJ", "EyJ", "a-eyj_", "EYJEYJ"):
        text = f"{before}{head}.e30.x"
        assert s.Scanner()(text) == [("jwt", len(before), len(text))], text
    began = time.perf_counter()
    assert s.Scanner()("EYJeyJ" * 200_000) == []
    assert time.perf_counter() - began < 20
