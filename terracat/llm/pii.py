"""Personal data: regular expressions propose spans, checksums confirm them,
and nearby context words adjust a span's score.

Base kinds (always reported when their rule holds): email, ip, card (16 to 19
digits, Luhn), phone (+, 8 to 15 digits).  Added kinds: iban (mod-97), short
card numbers of 13 to 15 digits (Luhn, kept only beside a card word) and
national phone numbers (kept only beside a phone word).  Offsets count code
points, ends are exclusive.

Null text counts as empty (no spans).  Repeated rows give repeated results.
Extra columns of the input are ignored.  Texts are scanned whole; every scan
is linear in the text's length.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "shortcard", "tel")
KINDS = BASE_KINDS + ADDED_KINDS

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_TEL = re.compile(r"(?<![0-9+.])\(?[0-9]{2,5}\)?(?:[\x20.-][0-9]{2,5}){1,4}(?![0-9])")
_ANY = re.compile(r"[0-9@]")

#: Words that raise a span's score when they stand in the 40 code points before it.
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "shortcard": ("card", "visa", "amex", "credit", "payment"),
    "tel": ("phone", "tel", "call", "mobile", "fax"),
}
#: Score without and gain with a context word; added kinds need KEEP to stay.
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "shortcard": 0.3, "tel": 0.2}
GAIN, KEEP, NEAR = 0.3, 0.5, 40


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 13616: country and check digits moved to the end, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str):
    free = 0  # a local part does not reach into the match before
    for m in _DOMAIN.finditer(text):
        at = s = m.start()
        while s > free and text[s - 1] in _LOCAL:
            s -= 1
        if s < at:
            free = m.end()
            yield s, free


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def propose(text: str):
    """(kind, start, end) of every span whose checks hold, by kind, then start."""
    found = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    found += [("ip", *m.span()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    short = []
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            found.append(("card", *m.span()))
        elif 13 <= len(d) <= 15 and luhn(d):
            short.append(("shortcard", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    for m in _IBAN.finditer(text):
        packed = m[0].replace(" ", "")
        if 15 <= len(packed) <= 34 and mod97(packed):
            found.append(("iban", *m.span()))
    found += short
    found += [("tel", *m.span()) for m in _TEL.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """Scored spans of one text: base spans all stay, added ones need KEEP."""
    if not text or not _ANY.search(text):
        return []
    out, base_ends = [], []
    for kind, s, e in propose(text):
        before = text[max(0, s - NEAR):s].lower()
        score = min(1.0, BASE_SCORE[kind] + GAIN * any(w in before for w in CONTEXT[kind]))
        if kind in BASE_KINDS:
            base_ends.append((s, e))
        elif score < KEEP or any(s < y and x < e for x, y in base_ends):
            continue
        out.append((kind, s, e, round(score, 3)))
    return out


def _spans_of(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [{"kind": k, "start": s, "end": e, "score": v} for k, s, e, v in find_spans(t)])


def detect(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: array of (kind, start, end, score), by kind as
    listed in KINDS, then start."""
    return docs.select("doc_id", F.pandas_udf(_spans_of, SPANS)(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(detected: DataFrame) -> DataFrame:
    """One row per document: counts by base kind, the hash of the base spans,
    all spans joined, and the number and best score of the spans."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return detected.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("best_score"))
