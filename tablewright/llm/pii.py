"""Personal data by anchor expansion: an Aho-Corasick automaton finds anchors, local parsers find the boundaries.

Anchors are at-signs, plus signs, digits, scheme marks and words that announce an identifier. At each anchor a parser
reads to the left and right and validates what it has read. No parser reads a stretch of text twice for the same kind,
so the work grows with the text.
"""

from __future__ import annotations

import hashlib
import re
import string
from bisect import bisect_right
from collections.abc import Iterable
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import add_columns, col, fresh

BASE_KINDS = ("email", "ip", "card", "phone")
#: Added by the anchors: an address with a scheme that carries a user's name, an account or identity number after its cue.
KINDS = (*BASE_KINDS, "url", "account")
_RANK = {k: i for i, k in enumerate(KINDS)}

#: Words that announce a number, in small letters; they are found in any mixture of small and capital letters.
CUES = ("account", "acct", "iban", "konto", "kontonummer", "compte", "cuenta", "ssn", "social security", "passport", "tax id")

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_SCHEME = frozenset(string.ascii_letters + string.digits + "+.-")
_DIGITS = frozenset(string.digits)
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_run = re.compile(r"[0-9]+").match
_ip_rest = re.compile(r"\.([0-9]+)\.([0-9]+)\.([0-9]+)").match
_card = re.compile(r"[0-9](?:[ -]?[0-9])+").match
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").match
# a user part ends before a slash, so those behind two scheme marks never share a character
_user_address = re.compile(r"[^\s/?#@<>\"']++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]{1,5})?(?:/[^\s<>\"']*)?").match
_joint = re.compile(r"(?:[ \t]{0,4}(?:number|num\.?|no\.?|nr\.?|id|is|:|#|=|-)){0,4}[ \t]{0,4}", re.I).match
_iban = re.compile(r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])").match
_account = re.compile(r"[0-9](?:[ -]?[0-9]){5,16}(?![0-9A-Za-z])").match


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, patterns in (
        ("@", ["@"]), ("+", ["+"]), ("0", list(string.digits)), (":", ["://"]),
        ("cue", list(CUES)),
    ):
        for p in patterns:
            found.add_word(p, (kind, len(p)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """The text with A to Z in small letters, of equal length."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def iban_valid(text: str) -> bool:
    x = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def spans(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """All (start, end, kind) of one text by start and kind, in code points, ends exclusive."""
    out: list[tuple[int, int, str]] = []
    extra: list[tuple[int, int, str]] = []
    email_from = ip_from = card_from = phone_from = extra_from = 0
    for last, (kind, length) in anchors.iter(lowered(text)):
        if kind == "0":
            if last >= card_from and (m := _card(text, last)):
                card_from = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((last, card_from, "card"))
            if last >= ip_from:
                first = _run(text, last)
                ip_from = first.end()
                if m := _ip_rest(text, ip_from):
                    ip_from = m.end()
                    if all(len(x := p.lstrip("0")) <= 3 and int(x or "0") <= 255 for p in (first[0], *m.groups())):
                        out.append((last, ip_from, "ip"))
        elif kind == "@":
            start = last
            while start > email_from and text[start - 1] in _LOCAL:
                start -= 1
            if start < last and (m := _domain(text, last + 1)):
                email_from = m.end()
                out.append((start, email_from, "email"))
        elif kind == "+":
            if last >= phone_from and (m := _phone(text, last)):
                phone_from = m.end()
                if 9 <= sum(c in _DIGITS for c in m[0]) <= 15:
                    out.append((last, phone_from, "phone"))
        elif kind == ":":
            at = start = last - 2
            while start > max(0, at - 32) and text[start - 1] in _SCHEME:
                start -= 1
            if start < at and last + 1 >= extra_from and (m := _user_address(text, last + 1)):
                extra_from = m.end()
                extra.append((start, extra_from, "url"))
        elif last + 1 >= extra_from:
            before = last - length
            if before >= 0 and text[before].isalnum():
                continue
            start = _joint(text, last + 1).end()
            if start == last + 1:
                continue
            m = _iban(text, start)
            if not (m and iban_valid(m[0])):
                m = _account(text, start)
            if m:
                extra_from = m.end()
                extra.append((start, extra_from, "account"))
    if extra and out:
        starts = [s for s, _, _ in sorted(out)]
        ends = list(accumulate((e for _, e, _ in sorted(out)), max))
        # a base span has all of it if one of those that begin no later ends no sooner
        extra = [x for x in extra if not (i := bisect_right(starts, x[0])) or ends[i - 1] < x[1]]
    return sorted(out + extra, key=lambda s: (s[0], _RANK[s[2]], s[1]))


def joined(found: Iterable[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def redacted(text: str, found: list[tuple[int, int, str]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in capitals."""
    parts, at = [], 0
    i = 0
    while i < len(found):
        start, end, kind = found[i]
        i += 1
        while i < len(found) and found[i][0] < end:
            end = max(end, found[i][1])
            i += 1
        parts += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*parts, text[at:]])


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_url, n_account.

    Null and empty texts have no spans. Every row stays, repeated ones and null ids too. Spans of kinds beyond the base
    ones are left out where a base span has them.
    """
    roles = [f"n_{k}" for k in BASE_KINDS] + ["base_sha256", "spans", "n_url", "n_account"]

    def make():
        anchors = automaton()

        def work(texts):
            rows = []
            for text in texts:
                found = spans(text, anchors) if text else []
                base = [s for s in found if s[2] in BASE_KINDS]
                n = {k: 0 for k in KINDS}
                for s in found:
                    n[s[2]] += 1
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*(n[k] for k in BASE_KINDS), digest, joined(found), n["url"], n["account"]))
            return [list(x) for x in zip(*rows, strict=True)] if rows else [[] for _ in roles]

        return work

    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2
    rows = docs.select("doc_id", col("text").cast("string").alias("text"))
    return add_columns(rows, ["text"], list(zip(roles, kinds, strict=True)), make).drop("text")


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in its texts, and with ``n_chars`` to match where it has that column.

    All columns keep their names and order; null texts stay null.
    """
    (new,) = fresh(docs, "redacted")

    def make():
        anchors = automaton()
        return lambda texts: [[redacted(t, spans(t, anchors)) if t else t for t in texts]]

    out = add_columns(docs, [text], [(new, pa.string())], make)
    put = {text: col(new)}
    if n_chars in docs.columns:
        put[n_chars] = F.length(col(new)).cast(docs.schema[n_chars].dataType)
    return out.select(*((put[c] if c in put else col(c)).alias(c) for c in docs.columns))
