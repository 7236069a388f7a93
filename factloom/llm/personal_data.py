"""Operator 3: personal data by patterns, checksums and nearby words.

A pattern proposes a span, a validator confirms it and words around it adjust
its score.  Spans of the base kinds (email, ip, card, phone) that pass their
validator always stay.  The further kinds stay from ``THRESHOLD`` on.

The patterns scan a text once: they are written with possessive repeats, and
e-mail addresses are found from the at sign outwards, so no text makes them
slow.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("iban", "national", "secret")
THRESHOLD = 0.6
#: Characters on either side in which context words count.
NEARBY = 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """Luhn checksum of a string of digits."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def mod97(code: str) -> bool:
    """ISO 13616 checksum of an account number without spaces."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping addresses."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        next_from = at + 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            found.append((start, domain.end()))
            done = next_from = domain.end()
        else:
            done = at + 1
        at = text.find("@", next_from)
    return found


def ips(text: str) -> list[tuple[int, int]]:
    spans, at = [], 0
    while m := _IP.search(text, at):
        at = m.end()
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            spans.append(m.span())
    return spans


def cards(text: str) -> list[tuple[int, int]]:
    return [
        m.span()
        for m in _CARD.finditer(text)
        if m.end() - m.start() <= 37
        and 12 <= len(digits := _digits(m[0])) <= 19
        and luhn(digits)
    ]


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]


@dataclass(frozen=True)
class Rule:
    """A further kind: its pattern, its validator, its score and its context."""

    kind: str
    pattern: re.Pattern
    valid: object
    score: float
    words: frozenset

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = []
        for m in self.pattern.finditer(text):
            if self.valid(m[0]) and self.scored(text, *m.span()) >= THRESHOLD:
                found.append(m.span())
        return found

    def scored(self, text: str, start: int, end: int) -> float:
        around = text[max(0, start - NEARBY) : start] + " " + text[end : end + NEARBY]
        near = set(re.findall(r"\w+", around.lower()))
        return min(1.0, self.score + 0.35 * bool(near & self.words))


RULES = (
    Rule(
        "iban",
        re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"),
        lambda t: mod97(t.replace(" ", "")),
        0.8,
        frozenset("iban account konto compte cuenta bank".split()),
    ),
    Rule(
        "national",
        re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
        lambda t: t[:3] not in ("000", "666") and t[0] != "9" and t[4:6] != "00",
        0.4,
        frozenset("ssn social security sozialversicherung seguro securite".split()),
    ),
    Rule(
        "secret",
        re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{18,64}|[A-Za-z0-9_]{20,64})(?![A-Za-z0-9_])"),
        lambda t: sum(c.isdigit() for c in t) >= 4 and len(set(t)) >= 8 and not t.isdigit(),
        0.3,
        frozenset("token password passwd secret key api apikey credential".split()),
    ),
)
_FURTHER = {"iban": re.compile(r"[A-Z]{2}[0-9]{2}"), "national": _DIGIT, "secret": _DIGIT}


def find(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind in ``text``, in code points, end exclusive."""
    found = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    if _DIGIT.search(text):
        found["ip"], found["card"] = ips(text), cards(text)
        if "+" in text:
            found["phone"] = phones(text)
        for rule in RULES:
            if _FURTHER[rule.kind].search(text):
                found[rule.kind] = rule.spans(text)
    return found


def listed(found: dict[str, list], kinds: tuple[str, ...]) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of the kinds in order of start, then of kind."""
    return sorted((s, KINDS.index(k), e) for k in kinds for s, e in found[k])


def masked(text: str, found: dict[str, list]) -> str:
    """``text`` with each run of overlapping spans replaced by its first kind."""
    out, done = [], 0
    for start, kind, end in listed(found, KINDS):
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    out.append(text[done:])
    return "".join(out)


def spans(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id and its spans (kind, start, end), in order.

    Other columns are ignored.  A null text is empty; a document without
    personal data has an empty list.  Each row is judged alone, so repeated rows
    and null ids stay as they are.
    """

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def seek(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda t: [
                {"kind": KINDS[k], "start": s, "end": e}
                for s, k, e in listed(find(t or ""), KINDS)
            ]
        )

    return documents.select("doc_id", seek(F.col("text")).alias("spans"))


def without_personal_data(documents: DataFrame) -> DataFrame:
    """``documents`` with ``text`` masked and ``n_chars`` counted again.

    A text without personal data, a null one included, stays as it is.
    """

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else masked(t, find(t)))

    return documents.withColumn("text", mask(F.col("text"))).withColumn(
        "n_chars", F.length("text").cast(documents.schema["n_chars"].dataType)
    )


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans."""
    found = spans(spark.read.parquet(f"{folder}/documents.parquet"))

    def text(kinds: tuple[str, ...]):
        some = F.filter("spans", lambda s: s["kind"].isin(*kinds))
        return F.concat_ws(
            ",", F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        )

    def number(kind: str):
        some = F.filter("spans", lambda s: s["kind"] == kind)
        return F.size(some).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, BASE),
        F.sha2(text(BASE).cast("binary"), 256).alias("base_sha256"),
        text(KINDS).alias("spans"),
    )
