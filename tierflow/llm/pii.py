"""Personal data by anchor expansion: an Aho-Corasick automaton finds at-signs,
schemes, digits and identifier cues; local parsers expand each anchor to its
maximal surroundings and validate the span.

Base kinds (email, ip, card, phone) are exactly the leftmost non-overlapping
matches of their patterns: an email's local part is the run before its at-sign, and a
number lies inside the maximal run of characters that numbers are written
with, so parsing that run alone gives the matches of the whole text. The cues
add three kinds: url (after a scheme), iban and account (after a cue word),
and address (house number and street).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: In the order that breaks ties of equal starts.
BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "iban", "account", "address")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMERIC = re.compile(r"[0-9 ().+-]+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
URL = re.compile(r"://(?:[^\s/?#<>\"'@]+@)?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)(?::[0-9]{1,5})?(?:[/?#][^\s<>\"']*)?")
SCHEMES = ("https", "http", "ftp", "wss", "ws")
IBAN = re.compile(r"[\s:#.]{0,4}([A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?)(?![0-9A-Za-z])")
ACCOUNT = re.compile(r"(?: ?(?:number|no\.?|nr\.?|id))?[\s:#.]{0,4}([0-9][0-9 -]{4,22}[0-9])(?![0-9])", re.IGNORECASE)
STREET = re.compile(r"(?:[0-9]{1,5}[A-Za-z]?,? )(?:[A-Z][\w'-]*\.? ){1,4}$")
CUES = {"iban": "iban", "account": "account", "acct": "account", "konto": "account", "street": "address", "avenue": "address", "road": "address", "boulevard": "address"}


LOWER = {c: c + 32 for c in range(65, 91)}


def _automaton():
    """Anchors, to be searched in texts with A-Z as a-z."""
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", ("@", 1))
    found.add_word("://", ("://", 3))
    for digit in "0123456789":
        found.add_word(digit, ("0", 1))
    for cue, kind in CUES.items():
        found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def iban_valid(text: str) -> bool:
    code = text.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _numbers(text: str, lo: int, hi: int) -> Iterator[tuple[str, int, int]]:
    """Base matches within one numeric run."""
    if text.count(".", lo, hi) >= 3:
        for m in IP.finditer(text, lo, hi):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                yield "ip", m.start(), m.end()
    if hi - lo >= 14:
        for m in CARD.finditer(text, lo, hi):
            if m.end() - m.start() >= 14 and 14 <= len(number := _digits(m[0])) <= 19 and luhn(number):
                yield "card", m.start(), m.end()
    if text.find("+", lo, hi) >= 0:
        for m in PHONE.finditer(text, lo, hi):
            if 10 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()


_FOUND: list = []


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, end exclusive, by start and then kind as listed."""
    if not text:
        return []
    if not _FOUND:
        _FOUND.append(_automaton())
    out: list[tuple[str, int, int]] = []
    run_end = mail_end = url_end = 0
    ends = dict.fromkeys(ADDED, 0)
    low = text.lower() if text.isascii() else text.translate(LOWER)  # as long as the text
    for last, (kind, size) in _FOUND[0].iter(low):
        at = last - size + 1
        if kind == "0":
            if at >= run_end:
                lo = at - 1 if at and text[at - 1] == "+" else at
                run_end = NUMERIC.match(text, at).end()
                if run_end - lo >= 7:
                    out.extend(_numbers(text, lo, run_end))
        elif kind == "@":
            start = at
            while start > mail_end and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at)):
                mail_end = m.end()
                out.append(("email", start, mail_end))
        elif kind == "://":
            scheme = next((s for s in SCHEMES if text[max(0, at - len(s)):at].lower() == s), None)
            if scheme and at - len(scheme) >= url_end and (m := URL.match(text, at)) and ("." in m[1] or m[1] == "localhost"):
                url_end = m.end() - (len(m[0]) - len(m[0].rstrip(".,;:!?)")))
                out.append(("url", at - len(scheme), url_end))
        elif kind == "address":
            line = at
            for _ in range(6 if text[at - 1:at] == " " else 0):  # the number and up to four names, each before a space
                line = text.rfind(" ", 0, max(line, 0)) if line > 0 else -1
            line = max(line + 1, 0) if line < at else at
            if text[last + 1:last + 2].isalnum() is False and (m := STREET.search(text[line:at])) and line + m.start() >= ends[kind]:
                begin = line + m.start()
                if not (begin and text[begin - 1].isalnum()):
                    ends[kind] = last + 1
                    out.append((kind, begin, last + 1))
        elif not (at and text[at - 1].isalnum()):
            m = (IBAN if kind == "iban" else ACCOUNT).match(text, last + 1)
            if m and m.start(1) >= ends[kind]:
                good = iban_valid(m[1]) if kind == "iban" else 6 <= len(_digits(m[1])) <= 18
                if good:
                    ends[kind] = m.end(1)
                    out.append((kind, m.start(1), m.end(1)))
    order = {k: i for i, k in enumerate(BASE + ADDED)}
    return sorted(out, key=lambda s: (s[1], order[s[0]]))


def redact(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first stays."""
    out, at = [], 0
    for kind, start, end in found:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
            at = end
    return "".join([*out, text[at:]])


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", redacted: bool = False) -> DataFrame:
    """One row per row of ``docs``: id_col, kinds, starts, ends (arrays, sorted by start
    and then kind) and, with ``redacted``, the text with the spans replaced.

    A null text counts as empty (and stays null when redacted); it has empty
    arrays. Rows are judged one by one, so repeated rows and null ids need
    no rule. Other columns are not read; an empty table gives no rows.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [spans(t) for t in texts]
            columns = [batch.column(0), pa.array([[s[0] for s in f] for f in found], pa.list_(pa.string())),
                       pa.array([[s[1] for s in f] for f in found], pa.list_(pa.int64())), pa.array([[s[2] for s in f] for f in found], pa.list_(pa.int64()))]
            if redacted:
                columns.append(pa.array([None if t is None else redact(t, f) for t, f in zip(texts, found)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "kinds", "starts", "ends", "redacted"][:len(columns)])
    schema = f"id {src.schema['id'].dataType.simpleString()}, kinds array<string>, starts array<long>, ends array<long>" + ", redacted string" * redacted
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the hash of the base spans and all spans as text."""
    marks = F.transform(F.arrays_zip("kinds", "starts", "ends"), lambda s: F.concat_ws(":", s["kinds"], s["starts"], s["ends"]))
    base = F.filter(marks, lambda m: F.split_part(m, F.lit(":"), F.lit(1)).isin(*BASE))
    count = [(F.size("kinds") - F.size(F.array_remove("kinds", kind))).cast("long").alias(f"n_{kind}") for kind in BASE + ADDED]
    return found.select(id_col, *count, F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"), F.array_join(marks, ",").alias("spans"))
