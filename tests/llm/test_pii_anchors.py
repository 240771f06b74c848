"""Personal data against plain regular expressions."""

import hashlib
import random
import re

import duckdb
import pytest

from tidewatch.llm import pii_anchors, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(number):
    total = 0
    for i, d in enumerate(reversed(number)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p.lstrip("0")[:5] or 0) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def texts():
    rng = random.Random(3)
    out = [None, "", "a@b.c@d.e", "@x.y", "x@@y.z", "a..b@-.-.", "1.2.3.4.5.6.7.8", "999.1.2.3.4", "1.2.3..4", "+1", "+12", "+1 2", "+1 (2) 34-567.89 ", "++12345678", "+1+2345678901",
           "0" * 5000 + ".1.2.3", "4432507379035540", "4432-5073-7903-5540 ", "4432  5073790355400000", "é @ ü+49 30 1234567 x", "1." * 9 + "1", "+1" + "." * 50]
    for alphabet in ("ab@.-+ 1", "0123456789. ", "0123456789- ", "+0123456789().- x", "a1@.é+ -\n"):
        out += ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(2000)]
    for _ in range(500):
        body = "".join(rng.choices("0123456789", k=rng.randrange(14, 20)))
        last = next(d for d in "0123456789" if luhn(body + d))
        out.append(rng.choice(["", "x", "7 "]) + re.sub(r"(....)", rng.choice([r"\1 ", r"\1-", r"\1"]), body + last) + rng.choice(["", ".", " y"]))
    return out


def test_base_is_that_of_expressions():
    finder = pii_anchors.Finder()
    kinds = set()
    for t in filter(None, texts()):
        got = [s for s in finder.spans(t) if s[0] in pii_anchors.BASE]
        assert got == plain(t), t
        kinds |= {k for k, *_ in got}
    assert kinds == set(pii_anchors.BASE)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("IBAN: DE89 3704 0044 0532 0130 00.", ["iban:DE89 3704 0044 0532 0130 00"]),
        ("iban DE89370400440532013001", []),
        ("Account no. 12345678, then", ["account:12345678"]),
        ("accountant 12345678", []),
        ("ssn 123-45-6789; SSN 000-45-6789", ["ssn:123-45-6789"]),
        ("see ftp://bob:pw@files.example/x and http://example.org/a@b", ["login:bob:pw"]),
        ('token = "6df57b16f87eabefefcab67b433efd90636bb6bd" x', ["secret:6df57b16f87eabefefcab67b433efd90636bb6bd"]),
        ("the token was given to a member", []),
    ],
)
def test_added_kinds(text, want):
    found = pii_anchors.Finder().spans(text)
    assert [f"{k}:{text[a:b]}" for k, a, b in found if k not in pii_anchors.BASE] == want


def test_redaction_and_columns(spark):
    rows = [(1, "mail bob@x.org or +49 30 1234567", "p", "q"), (2, None, "p", None), (3, "", "p", None), (4, "ftp://a:b@c.d/ x", None, None), (5, "clean text", None, None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, pii string, n_redacted string")
    got = {r["doc_id"]: (r["text"], r["n_redacted"]) for r in pii_anchors.redact(df).collect()}
    assert got == {1: ("mail <email> or <phone>", 2), 2: (None, 0), 3: ("", 0), 4: ("ftp://<login>/ x", 1), 5: ("clean text", 0)}
    assert pii_anchors.redact(df).count() == 10 and pii_anchors.detect(df.limit(0)).count() == 0
    assert {len(r["pii"]) for r in pii_anchors.detect(df).filter("doc_id in (2, 3, 5)").collect()} == {0}


def test_query_against_expressions(spark):
    sf = "/root/testdata/sf0.001"
    known = duckdb.sql(f"select doc_id, coalesce(text, '') from '{sf}/documents.parquet'").fetchall()
    got = {r["doc_id"]: r for r in queries.op12_pii_anchors(spark, sf).collect()}
    assert len(got) == len(known)
    seen = 0
    for i, t in known:
        want = plain(t)
        seen += len(want)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii_anchors.BASE] == [sum(x == k for x, *_ in want) for k in pii_anchors.BASE]
        assert [s for s in got[i]["spans"].split(",") if s.split(":")[0] in pii_anchors.BASE] == [f"{k}:{a}:{b}" for k, a, b in want]
    assert seen


def test_very_long_texts_stay_linear():
    finder = pii_anchors.Finder()
    for t in ("1-" * 300_000, "a" * 600_000 + "@", "+1" + "(" * 400_000, "1." * 300_000 + "1", "a@" * 200_000, "token " * 60_000):
        assert [s for s in finder.spans(t) if s[0] in pii_anchors.BASE] == (plain(t) if t[0] == "1" else [])
