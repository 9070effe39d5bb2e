"""Personal data by anchor expansion: one automaton finds anchors, local parsers find and check the borders.

Anchors are the at-sign, the plus sign, digits, the ``://`` of a scheme, and cue words. From an anchor a
parser walks left or right over the characters its kind allows and checks what it found. The base kinds
are ``email``, ``ip``, ``card`` and ``phone``; the method adds ``account`` (an IBAN with right check digits,
or a number behind a cue), ``secret`` (a value behind a cue and an equals sign or colon) and ``login`` (user
and password in an address behind a scheme).

A null text counts as the empty one and has no spans; texts of any length are read whole and in one pass;
spans of different kinds may overlap, spans of one kind never do; repeated rows give equal results; an
empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored by ``find``, and
kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from boxweave.llm.common import keyed_texts, map_batches

# Kinds in the order in which spans of equal start are listed
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "account", "secret", "login")
# Cue words in front of an identifier
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "ssn")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey")
FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

DIGITS = frozenset("0123456789")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
SPACED = re.compile(r"[0-9](?:[ -]?[0-9])*")
DIALLED = re.compile(r"[ ().0-9-]+")
AUTHORITY = re.compile(r"[^\s/?#]+")
ASSIGNED = re.compile(r"[\"']?[ \t]*[:=][ \t]*[\"']?([A-Za-z0-9_+/.-]{8,})")
NUMBERED = re.compile(r"[ \t]*(?:(?:no|nr|number)\.?)?[ \t]*[:=#]?[ \t]*([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}|[0-9](?:[ -]?[0-9]){5,16})")


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled, digits of the results added up, divisible by ten."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def iban(value: str) -> bool:
    """Country and check digits moved behind, letters as two digits: 1 modulo 97."""
    plain = value.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


class Finder:
    """All spans of a text, ordered by start and then kind."""

    def __init__(self):
        import ahocorasick

        self.anchors = ahocorasick.Automaton()
        for d in DIGITS:
            self.anchors.add_word(d, ("digit", 1))
        self.anchors.add_word("@", ("at", 1))
        self.anchors.add_word("+", ("plus", 1))
        self.anchors.add_word("://", ("scheme", 3))
        for kind, cues in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
            for cue in cues:
                for form in {cue, cue.upper(), cue.capitalize()}:
                    self.anchors.add_word(form, (kind, len(cue)))
        self.anchors.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind number, end) with the end exclusive."""
        out: list[tuple[int, int, int]] = []
        ends = dict.fromkeys(("email", "ip", "card", "account", "secret"), 0)
        for last, (anchor, size) in self.anchors.iter(text):
            at = last - size + 1
            if anchor == "digit":
                if at >= ends["ip"]:
                    ends["ip"] = self._dotted(text, at, out)
                if at >= ends["card"]:
                    ends["card"] = self._spaced(text, at, out)
            elif anchor == "at":
                ends["email"] = self._email(text, at, ends["email"], out)
            elif anchor == "plus":
                self._phone(text, at, out)
            elif anchor == "scheme":
                self._login(text, last + 1, out)
            else:
                ends[anchor] = self._cued(text, at, last + 1, anchor, ends[anchor], out)
        out.sort()
        return out

    def _email(self, text: str, at: int, floor: int, out: list) -> int:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if not domain:
            return floor
        out.append((start, 0, domain.end()))
        return domain.end()

    def _dotted(self, text: str, at: int, out: list) -> int:
        """Four parts at a time of a run of dotted numbers."""
        run = DOTTED.match(text, at)
        parts, place = run[0].split("."), at
        for i in range(0, len(parts) - len(parts) % 4, 4):
            four = parts[i : i + 4]
            end = place + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                out.append((place, 1, end))
            place = end + 1
        return run.end()

    def _spaced(self, text: str, at: int, out: list) -> int:
        run = SPACED.match(text, at)
        digits = run[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((at, 2, run.end()))
        return run.end()

    def _phone(self, text: str, at: int, out: list) -> None:
        if text[at + 1 : at + 2] not in DIGITS:
            return
        run = DIALLED.match(text, at + 2)
        body = run[0].rstrip(" ().-") if run else ""
        if len(body) >= 2 and 10 <= 1 + sum(c in DIGITS for c in body) <= 15:
            out.append((at, 3, at + 2 + len(body)))

    def _login(self, text: str, at: int, out: list) -> None:
        run = AUTHORITY.match(text, at)
        user = run[0].rpartition("@")[0] if run else ""
        if ":" in user.strip(":"):
            out.append((at, KINDS.index("login"), at + len(user)))

    def _cued(self, text: str, at: int, end: int, kind: str, floor: int, out: list) -> int:
        if at < floor or (at and text[at - 1].isalnum()) or text[end : end + 1].isalnum():
            return floor
        found = (NUMBERED if kind == "account" else ASSIGNED).match(text, end)
        if not found:
            return floor
        value = found[1]
        good = any(c in DIGITS for c in value) if kind == "secret" else (iban(value) if value[0].isalpha() else True)
        if good:
            out.append((found.start(1), KINDS.index(kind), found.end(1)))
        return found.end(1) if good else floor


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by the kind of its first."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def find(docs: DataFrame) -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans; one scan, no shuffle."""

    def make():
        finder = Finder()

        def step(batch):
            found = [finder.spans(t) for t in batch.column(1).to_pylist()]
            base = [[s for s in spans if s[1] < len(BASE)] for spans in found]
            counts = [pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64()) for k in range(len(BASE))]
            digests = pa.array([hashlib.sha256(listed(s).encode()).hexdigest() for s in base], pa.string())
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *counts, digests, pa.array(map(listed, found), pa.string())],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

        return step

    return map_batches(keyed_texts(docs), make, FOUND)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; a null text stays null."""
    columns = docs.columns

    def make():
        finder, at = Finder(), columns.index("text")

        def step(batch):
            texts = [t if t is None else redacted(t, finder.spans(t)) for t in batch.column(at).to_pylist()]
            return batch.set_column(at, columns[at], pa.array(texts, batch.column(at).type))

        return step

    return map_batches(docs, make, docs.schema)
