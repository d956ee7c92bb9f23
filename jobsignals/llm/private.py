"""Personal data: patterns propose, checksums confirm, context words adjust the score.

Four base kinds (email, ip, card, phone) are decided by pattern and validator alone and always
stay. The method adds spans whose pattern is weaker: bank account numbers confirmed by mod-97,
and numbers of identity papers or telephones without a country code, which need a word such as
"passport" or "call" close by. Added spans never overlap one that is already there.

Defined cases: a null text is empty and has no spans. Texts are scanned whole; a match that fails
its validator is dropped and not tried again at another length. Offsets are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignals.llm.common import ship

KINDS = ("email", "ip", "card", "phone", "iban", "tel", "ssn", "passport")

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile(r"[0-9]")
# A match can only begin where digits begin; with that said, long digit runs take linear time.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: kind: pattern, score of a bare match, words that raise it, words that lower it
WEAK = {
    "iban": (re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"),
             0.6, ("iban", "bank", "account", "konto", "cuenta", "compte"), ()),
    "tel": (re.compile(r"(?<![\w+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])"),
            0.2, ("tel", "phone", "call", "mobile", "fax", "whatsapp"), ("isbn", "order", "item")),
    "ssn": (re.compile(r"(?<![\w-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![\w-])"),
            0.3, ("ssn", "social", "security"), ("order", "part", "item")),
    "passport": (re.compile(r"(?<![A-Za-z0-9])[A-Z]{1,2}[0-9]{7,8}(?![A-Za-z0-9])"),
                 0.1, ("passport", "reisepass", "passeport", "pasaporte"), ("order", "part")),
}
RAISE, LOWER, ENOUGH = 0.4, 0.4, 0.5
#: How many characters around a match are searched for context words.
AROUND = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of a bank account number: letters count as 10 to 35, remainder 1."""
    rest = 0
    for c in iban[4:] + iban[:4]:
        rest = int(str(rest) + str(int(c, 36))) % 97
    return rest == 1


def small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, each looked for from the start of the run before its @."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := EMAIL.match(text, start)):
            yield m.span()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(a, b, "email") for a, b in emails(text)]
    if not DIGIT.search(text):
        return found
    found += [(*m.span(), "ip") for m in IP.finditer(text) if all(map(small_part, m.groups()))]
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), "card"))
    if "+" in text:
        found += [(*m.span(), "phone") for m in PHONE.finditer(text)
                  if 9 <= len(digits_of(m[0])) <= 15]
    return found


def context_score(text: str, start: int, end: int, score: float, good: tuple, bad: tuple) -> float:
    near = re.findall(r"[^\W\d_]+", (text[max(0, start - AROUND):start] + " "
                                     + text[end:end + AROUND]).lower())
    return (score + RAISE * any(w in good for w in near) - LOWER * any(w in bad for w in near))


def added_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    found: list[tuple[int, int, str]] = []
    if not DIGIT.search(text):
        return found
    for kind, (pattern, score, good, bad) in WEAK.items():
        for m in pattern.finditer(text):
            if kind == "iban" and not mod97(m[0].replace(" ", "")):
                continue
            a, b = m.span()
            if (context_score(text, a, b, score, good, bad) >= ENOUGH
                    and not any(a < y and x < b for x, y, _ in taken + found)):
                found.append((a, b, kind))
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    spans = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_private(docs: DataFrame) -> DataFrame:
    """doc_id, base and added spans of every row as arrays of (start, end, kind)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            base, added = [], []
            for t in b.column("text"):
                text = t.as_py()
                mine = base_spans(text)
                base.append(mine)
                added.append(added_spans(text, mine))
            as_rows = [[[{"start": x, "end": y, "kind": k} for x, y, k in s] for s in side]
                       for side in (base, added)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(as_rows[0], span), pa.array(as_rows[1], span),
                 pa.array([hashlib.sha256(joined(s).encode()).hexdigest() for s in base]),
                 pa.array([joined(s + t) for s, t in zip(base, added)])],
                ["doc_id", "base", "added", "base_sha256", "spans"])

    spans = "array<struct<start: long, end: long, kind: string>>"
    return rows.mapInArrow(run, f"doc_id long, base {spans}, added {spans}, "
                                "base_sha256 string, spans string")


def private_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}")
              for k in ("email", "ip", "card", "phone")]
    return find_private(docs).select("doc_id", *counts, "base_sha256", "spans")
