"""Personal data: patterns propose, checksums confirm, nearby words score.

Regular expressions propose spans per kind; validators (parts of an address,
Luhn, digit counts, mod-97) confirm them; words within WINDOW characters
move the score of a span up. The base kinds (email, ip, card, phone) are kept
whatever their score; the added kinds (iban, ssn) are kept from KEEP on. Each
text is read whole and on its own, so the job is one pass without a shuffle;
every scan is linear in the text, also on long runs of letters or digits.

Defined results: null and empty texts have no spans; spans of one kind never
overlap, of different kinds they may; repeated rows are judged alike; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from indicata.llm.common import ship

#: Kinds in output order; the first four are the base of the contract.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = 4

# Proposal patterns. An address is found from its "@": the name
# before it is the longest run, back to the last match, of NAME characters.
NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9][0-9.]+")
QUAD = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Score without context and the words that raise it.
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": ("contact", "email", "mail", "write"),
    "ip": ("address", "host", "ip", "server"),
    "card": ("card", "credit", "mastercard", "payment", "visa"),
    "phone": ("call", "fax", "mobile", "phone", "tel"),
    "iban": ("account", "bank", "iban", "transfer"),
    "ssn": ("security", "social", "ssn"),
}
WINDOW, BONUS, KEEP = 40, 0.3, 0.5
WORD = re.compile(r"[A-Za-z]+")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number fits."""
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an account number's check digits fit (spaces allowed)."""
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in NAME:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            # what stands before this "@" can belong to no later match
            done = at + 1
        at = text.find("@", done)


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and (not part or int(part) <= 255)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for run in DOTTED.finditer(text):
        if run.group().count(".") >= 3:
            for m in QUAD.finditer(text, run.start(), run.end()):
                if all(map(_byte, m.group().split("."))):
                    yield m.span()


def _digits(text: str) -> str:
    return "".join(ch for ch in text if "0" <= ch <= "9")


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in IBAN.finditer(text):
        if mod97(m.group()):
            yield m.span()


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


FIND = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _ssns}


def scored(text: str, kind: str, start: int, end: int) -> float:
    """Score of a confirmed span, raised by a context word near it."""
    near = text[max(0, start - WINDOW):start] + " " + text[end:end + WINDOW]
    words = {w.lower() for w in WORD.findall(near)}
    return min(1.0, SCORE[kind] + BONUS * bool(words.intersection(CONTEXT[kind])))


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans of a text: (kind, start, end, score), by kind, then start."""
    if not text:
        return []
    out = []
    for i, kind in enumerate(KINDS):
        for start, end in FIND[kind](text):
            score = scored(text, kind, start, end)
            if i < BASE or score >= KEEP:
                out.append((kind, start, end, score))
    return out


SPAN = "array<struct<kind:string,start:long,end:long,score:double>>"


def detect(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, spans, redacted): spans with scores, and the text without them.

    ``redacted`` has ``[KIND]`` in place of each span; where spans overlap, the
    earlier (of equal starts the longer) one names the gap.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        for b in batches:
            found, clean = [], []
            for text in b.column(1).to_pylist():
                spans = find(text)
                found.append([dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans])
                clean.append(redact(text, spans))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(found, arrow), pa.array(clean, pa.string())],
                ["id", "spans", "redacted"])

    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")) \
        .mapInArrow(run, f"id {kind}, spans {SPAN}, redacted string") \
        .withColumnRenamed("id", id_col)


def redact(text: str | None, spans) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds and span digests of the rows of ``detect``."""
    each = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS[:BASE]))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, each))
    return found.select(
        id_col, *[count(k).alias(f"n_{k}") for k in KINDS[:BASE]],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.round(F.coalesce(F.array_max(F.transform("spans", lambda x: x["score"])), F.lit(0.0)), 3)
        .alias("top_score"))


ship(__name__)
