"""Personal data by anchor expansion.

An Aho-Corasick automaton walks a text once and reports anchors: at-signs, digits, plus signs, ``://`` of
schemes, and cues of identifiers (``iban``, ``account``, ``ssn``, ``token`` and the like). From each anchor a
deterministic parser moves to the boundaries of what may stand there, and validates it. No parser goes back behind
what it has taken, so a text costs one walk and the length of its candidates.

Base kinds, each leftmost and without overlaps of its own kind:

* ``email``: from an at-sign left over the local part, right over at least two labels;
* ``ip``: from a digit over the dotted chain, four numbers at a time, each at most 255;
* ``card``: from a digit over digits with at most one space or hyphen between, 16 to 19 that pass Luhn;
* ``phone``: from a plus sign over digits, spaces, dots, hyphens and brackets, 8 to 15 digits.

Added kinds, which need a scheme or a cue and so leave other text alone: ``login`` (user and password of an address
with a scheme), ``iban`` (check digits tested), ``account`` (6 to 17 digits after a cue of an account), ``ssn`` (nine digits in
three, two and four) and ``secret`` (16 characters or more assigned to a cue of a secret). Positions are code points, ends exclusive.

Cases: a null text is the empty one (no spans); texts of any length are searched whole; spans of different
kinds may overlap; repeated rows each get the same result; an empty table gives an empty result; an input column with the name of a result is replaced.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import with_columns

#: Kinds in the order of results; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "login", "iban", "account", "ssn", "secret")
BASE = KINDS[:4]
#: Cues by kind, in lower case.
CUES = {
    "iban": ("iban",),
    "account": ("account", "acct", "customer no", "member id", "passport"),
    "ssn": ("ssn", "social security"),
    "secret": ("token", "api_key", "api-key", "apikey", "secret", "password", "passwd"),
}
AT, DIGIT, PLUS, SCHEME = "@", "digit", "+", "://"
#: Digits of a card and of a phone number.
CARD, PHONE = range(16, 20), range(8, 16)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
# Scanners start at a fixed place and never give back what they took.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])*+")
DIALLED = re.compile(r"[\x20().0-9-]++")
AUTHORITY = re.compile(r"[^\s/?#\"'<>\\]++")
BETWEEN = re.compile(r"(?i:[\s:#=.\-]|no\b|nr\b|number\b|is\b){0,8}")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"[A-Z]{0,2}[0-9](?:[\x20-]?[0-9]){5,16}(?![0-9A-Za-z])")
SSN = re.compile(r"(?!000|666|9)[0-9]{3}([\x20-]?)(?!00)[0-9]{2}\1(?!0000)[0-9]{4}(?![0-9])")
ASSIGNED = re.compile(r"[\"']?\s{0,4}(?:=|:|\bis\b)\s{0,4}[\"']?")
SECRET = re.compile(r"[A-Za-z0-9_+/=.\-]{16,}+")
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
SPANS = (T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])), pa.list_(SPAN))


def automaton() -> ahocorasick.Automaton:
    """The anchors; a match's value is its kind of anchor and its length."""
    found = ahocorasick.Automaton()
    for word, what in [(AT, AT), (PLUS, PLUS), (SCHEME, SCHEME), *((d, DIGIT) for d in "0123456789")]:
        found.add_word(word, (what, len(word)))
    for kind, cues in CUES.items():
        for cue in cues:
            for form in {cue, cue.upper(), cue.title(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def iban_valid(code: str) -> bool:
    """Whether a code's check digits hold."""
    plain = code.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


class Finder:
    """Spans (kind, start, end) of texts."""

    def __init__(self) -> None:
        self.anchors = automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """All spans of one text, by kind and start."""
        found: list[tuple[str, int, int]] = []
        done = dict.fromkeys(KINDS, 0)
        for last, (what, size) in self.anchors.iter(text):
            if what is DIGIT:
                if last >= done["ip"]:
                    done["ip"] = self._addresses(text, last, found)
                if last >= done["card"]:
                    done["card"] = self._card(text, last, found)
            elif what is AT:
                done["email"] = self._email(text, last, done["email"], found)
            elif what is PLUS:
                if last >= done["phone"]:
                    done["phone"] = self._phone(text, last, found)
            elif what is SCHEME:
                self._login(text, last - 2, last + 1, found)
            elif last >= done[what]:
                done[what] = self._cued(what, text, last + 1 - size, last + 1, found)
        return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1])) if len(found) > 1 else found

    def _email(self, text: str, at: int, free: int, found: list) -> int:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start == at or not (domain := DOMAIN.match(text, at + 1)):
            return max(free, at + 1) if start == at else free
        found.append(("email", start, domain.end()))
        return domain.end()

    def _addresses(self, text: str, start: int, found: list) -> int:
        end = DOTTED.match(text, start).end()
        if end - start >= 7 and text.count(".", start, end) >= 3:
            parts, at = text[start:end].split("."), start
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                to = at + sum(map(len, four)) + 3
                if all(map(_octet, four)):
                    found.append(("ip", at, to))
                at = to + 1
        return end

    def _card(self, text: str, start: int, found: list) -> int:
        end = CHAIN.match(text, start).end()
        if end - start >= CARD.start:
            digits = text[start:end].replace(" ", "").replace("-", "")
            if len(digits) in CARD and luhn(digits):
                found.append(("card", start, end))
        return end

    def _phone(self, text: str, plus: int, found: list) -> int:
        if not ("0" <= text[plus + 1 : plus + 2] <= "9") or not (run := DIALLED.match(text, plus + 2)):
            return plus + 1
        body = run[0].rstrip(" ().-")
        if len(body) < 2:
            return plus + 1
        end = plus + 2 + len(body)
        if 1 + sum(map(body.count, "0123456789")) in PHONE:
            found.append(("phone", plus, end))
        return end

    def _login(self, text: str, at: int, after: int, found: list) -> None:
        if at == 0 or text[at - 1] not in SCHEME_CHARS or not (whole := AUTHORITY.match(text, after)):
            return
        user, sign, host = whole[0].rpartition("@")
        if sign and user and host:
            found.append(("login", after, after + len(user)))

    def _cued(self, kind: str, text: str, start: int, end: int, found: list) -> int:
        """What stands after a cue that begins a word; until where cues of the kind are done with."""
        if start and text[start - 1].isalpha():
            return end
        if kind == "secret":
            between = ASSIGNED.match(text, end)
            value = between and SECRET.match(text, between.end())
        else:
            value = {"iban": IBAN, "account": ACCOUNT, "ssn": SSN}[kind].match(text, BETWEEN.match(text, end).end())
        if not value or kind == "iban" and not iban_valid(value[0]):
            return end
        found.append((kind, *value.span()))
        return value.end()


def detect(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``pii``: the spans (kind, start, end) of every text."""

    def start():
        finder = Finder()
        return lambda texts: [[[{"kind": k, "start": a, "end": b} for k, a, b in finder.spans(t)] if t else [] for t in texts]]

    return with_columns(df, text_col, {"pii": SPANS}, start)


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with every span of personal data in its texts replaced by its kind in angle brackets; null texts stay.

    Of overlapping spans the first (the longest of those that start together) names the whole stretch. ``n_redacted`` counts the stretches.
    """

    def start():
        finder = Finder()

        def clean(text: str | None) -> tuple[str | None, int]:
            if not text:
                return text, 0
            made, at, n = [], 0, 0
            for kind, a, b in sorted(finder.spans(text), key=lambda s: (s[1], -s[2])):
                if a >= at:
                    made += [text[at:a], f"<{kind}>"]
                    n += 1
                at = max(at, b)
            return "".join([*made, text[at:]]), n

        return lambda texts: [list(x) for x in zip(*map(clean, texts), strict=True)] if texts else [[], []]

    return with_columns(df, text_col, {text_col: (T.StringType(), pa.string()), "n_redacted": (T.LongType(), pa.int64())}, start)


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, how many spans each base kind has, a digest of the base spans, and all spans."""
    found = detect(df.select(id_col, text_col), text_col)
    of = lambda *kinds: F.filter("pii", lambda s: s["kind"].isin(*kinds))
    return found.select(id_col, *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE), F.sha2(listed(of(*BASE)), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"))
