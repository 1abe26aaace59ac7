"""Personal data: rules, candidate spans, boosted trees and calibrated thresholds.

Every text is searched by the four base rules (email, ip, card, phone), whose spans
always stay.  Looser patterns propose further spans of these kinds and of others (secrets
such as keys and tokens, identity and account numbers, IPv6 addresses), which may
overlap; each gets features of its format and of the characters around it, and boosted
trees score it.  A span is added if its score reaches the threshold of its kind and it
overlaps no base span; of overlapping ones the best stays.

Features know no formats, only counts: of digits, letters, groups and their lengths,
separators, changes between letters and digits, different characters; and whether a word
that introduces such data stands before.  Labels are weak.  In the table a proposed span is a
positive if it overlaps a base span, or is assigned to a word for secrets; texts made by
rule add other ways to write such data, with and without such words, and decoys (dates,
amounts, checksums, versions, times, numbers that fail a checksum, ...) as negatives.
``held_out_texts`` are made by other rules, with formats and words that training does not
see; precision and recall are measured on them (``measure``).
Training reads every proposed span of every row of the table: equal features are counted,
and trees and thresholds rest on the counts of all of them.  So that a large table does
not drown the made texts, its spans share a weight (``TEXTS``, ``SPANS``), but none is
left out.  The threshold of a kind is set on the half of the texts that the trees
did not see, by the spans without base overlap alone, as only those can be added; without
any such evidence of ``PRECISION`` none of the kind is added.  Trees are grown by Spark
where the query is planned, a pass over the counted features for each level; only sums
by bin and score reach the driver.  In the tasks that find spans there are DataFrame
functions only, the trees being nested conditions.

Finding is within the row: nothing is shuffled, and a text without a digit or an @
is left after one look.  Patterns are possessive, so their time is linear in the text.

Edge cases: a NULL or empty text has no span; ``redact`` leaves a NULL text NULL.
Spans that start together are ordered by kind.  Repeated rows get equal spans.  Other
columns pass through, and columns named like a result are replaced.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetable.llm import boosting
from facetable.llm.tables import settled

KINDS = ("email", "ip", "card", "phone")
#: Kinds that only the trees find.
MORE_KINDS = ("secret", "id", "ipv6")
ALL_KINDS = KINDS + MORE_KINDS
#: As many texts the table weighs at most beside the made ones, however many it has.
TEXTS = 2_000
#: As many spans those of a kind weigh at most, and as many those without base overlap.
SPANS = 5_000
PRECISION = 0.98
THRESHOLDS = np.linspace(0.5, 0.95, 10)

#: A text without a match has no span of any kind.
LOOK = r"[0-9@]|::|[(\[{]at[)\]}]"

# The base rules, so written that a failed start is not tried again letter by letter:
# an address starts where a run of its letters starts, or where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A whole run of digits with single separators, of 14 to 19 digits.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])",
    # All digits from the plus to the end of the run, 10 to 15 of them.
    "phone": r"\+[0-9](?:[ ().-]*+[0-9]){9,14}(?![ ().-]*+[0-9])",
}
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$"

# Looser forms, for candidates.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]++"
    r"(?:(?:\.| ?(?:\(dot\)|\[dot\]|\{dot\}) ?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ .-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+?[0-9]{1,3}[ .-])?\(?[0-9]{2,5}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,512}+={0,2}(?![A-Za-z0-9_+/=-])",
    "id": r"(?<![0-9A-Za-z-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![0-9A-Za-z-])",
    "ipv6": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4})?(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])",
}
CUE = (
    r"(?i)(?:phone|tel|call|fax|mobile|mail|contact|card|visa|account|acct|host|addr|reach|ring|dial|text"
    r"|ssn|security|iban|passport|ident)[a-z.]{0,8}[^\p{L}\p{N}]{0,4}$"
)
SECRET_CUE = (
    r"(?i)(?:token|key|secret|passw(?:or)?d|pwd|bearer|credential|auth)[a-z_-]{0,10}[\"']?\s{0,2}"
    r"(?:[:=]|=>|:=)?\s{0,2}[\"']?$"
)
AROUND = 24

SPAN = "array<struct<start:int,end:int,kind:int,m:string,before:string,after:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(text: Column, kind: str, pattern: str) -> Column:
    """All matches of a pattern with their places in code points.

    What stands between matches gives the places: the pattern splits the text and
    finds its matches in the same order.
    """
    pieces, found = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def place(both: Column) -> Column:
        pieces, found = both["pieces"], both["found"]
        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

        def step(seen: Column, i: Column) -> Column:
            piece, m = F.get(pieces, i), F.get(found, i)
            begin = seen["at"] + F.length(piece)
            span = F.struct(
                begin.alias("start"),
                (begin + F.length(m)).alias("end"),
                F.lit(ALL_KINDS.index(kind)).alias("kind"),
                m.alias("m"),
                F.right(piece, F.lit(AROUND)).alias("before"),
                F.left(F.get(pieces, i + 1), F.lit(AROUND)).alias("after"),
            )
            return F.struct(
                (begin + F.length(m)).alias("at"),
                F.concat(seen["spans"], F.array(span)).cast(SPAN).alias("spans"),
            )

        steps = F.when(F.size(found) > 0, F.sequence(F.lit(0), F.size(found) - 1))
        swept = F.aggregate(F.coalesce(steps, F.array().cast("array<int>")), start, step)
        return swept["spans"]

    return _let(F.struct(pieces.alias("pieces"), found.alias("found")), place)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """Whether the digits of a match pass the checksum of card numbers."""

    def total(digits: Column) -> Column:
        def add(seen: Column, i: Column) -> Column:
            d = F.substring(digits, i, F.lit(1)).cast("int")
            twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
            return seen + F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(d)

        return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0

    return F.coalesce(_let(_digits(m), total), F.lit(False))


def _flat(*arrays: Column) -> Column:
    none = F.array().cast(SPAN)
    return F.flatten(F.array(*[F.coalesce(a, none) for a in arrays]))


def base_spans(text: Column) -> Column:
    """The spans of the base rules, ordered by start, then kind."""
    email = F.when(text.contains("@"), _spans(text, "email", BASE["email"]))
    ip = F.when(
        text.rlike(r"[0-9]\.[0-9]"),
        F.filter(_spans(text, "ip", BASE["ip"]), lambda s: s["m"].rlike(OCTETS)),
    )
    card = F.when(
        text.rlike(r"[0-9](?:[ -]?[0-9]){13}"),
        F.filter(_spans(text, "card", BASE["card"]), lambda s: _luhn(s["m"])),
    )
    phone = F.when(text.rlike(r"\+[0-9]"), _spans(text, "phone", BASE["phone"]))
    return _ordered(_flat(email, ip, card, phone))


def _ordered(spans: Column) -> Column:
    keyed = F.transform(
        spans,
        lambda s: F.named_struct(
            F.lit("start"), s["start"], F.lit("kind"), s["kind"], F.lit("span"), s
        ),
    )
    return F.transform(F.array_sort(keyed), lambda k: k["span"])


def candidate_spans(text: Column) -> Column:
    """The spans the looser patterns propose; kinds may overlap."""

    def of(kind: str) -> Column:
        found = _spans(text, kind, LOOSE[kind])
        if kind == "secret":
            return F.filter(found, lambda s: s["m"].rlike("[0-9]") & s["m"].rlike("[A-Za-z]"))
        if kind == "phone":
            return F.filter(found, lambda s: F.length(_digits(s["m"])).between(9, 15))
        return found

    return _flat(*map(of, LOOSE))


def _count(m: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(m, F.lit(pattern), F.lit(0)))


def features(s: Column) -> list[Column]:
    """Format and context of a candidate, as numbers."""
    m, before, after = s["m"], s["before"], s["after"]
    digits = F.length(_digits(m))
    groups = F.transform(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0)), F.length)
    numbers = [
        s["kind"],
        F.length(m),
        digits,
        F.length(F.regexp_replace(m, r"[^ .()-]", "")),
        F.length(F.regexp_replace(m, r"[^A-Za-z]", "")),
        (digits >= 12) & _luhn(m),
        m.rlike(OCTETS),
        m.contains("@"),
        m.rlike(r"[(\[{](?:at|dot)[)\]}]"),
        F.size(groups),
        F.get(groups, F.lit(0)),
        F.try_element_at(groups, F.lit(-1)),
        F.array_max(groups),
        F.array_min(groups),
        m.rlike(r"^\+"),
        m.contains("("),
        m.rlike(r"^[^0-9]?0"),
        m.rlike(r"^\(?[0-9]{2,5}\)"),
        F.size(F.array_distinct(F.regexp_extract_all(m, F.lit(r"[ .-]"), F.lit(0)))),
        F.length(F.regexp_replace(m, "[^A-Z]", "")),
        F.size(F.array_distinct(F.split(m, ""))),
        m.rlike("^[0-9A-Fa-f]+$"),
        m.rlike("^[A-Za-z0-9]+$"),
        _count(m, ":"),
        m.contains("::"),
        _count(m, "[0-9][A-Za-z]|[A-Za-z][0-9]"),
        _count(m, "[A-Za-z]{4,}"),
        before.rlike(r"[\p{L}\p{N}$€£#.,/:-]$"),
        after.rlike(r"^(?:[\p{L}\p{N}%/:]|[,.-][0-9])"),
        before.rlike(r"(?i)(?:eur|usd|gbp|chf|[$€£])\s?$"),
        before.rlike(r"[0-9][ .-]$"),
        after.rlike(r"^[ .-][0-9]"),
        before.rlike(CUE),
        before.rlike(SECRET_CUE),
        before.rlike("[\"']$"),
        before.rlike(r"(?i)(?:commit|sha[0-9-]*|md5|hash|digest|uuid|guid|build|version|etag|isbn|issn|no|nr|order|ref|serial|model|file)\b[^\p{L}\p{N}]{0,4}$"),
    ]
    return [F.coalesce(x.cast("double"), F.lit(0.0)) for x in numbers]


@dataclass
class Model:
    forest: boosting.Forest
    thresholds: list[float]  # by kind

    def score(self, values: Column) -> Column:
        """Log odds of a candidate from the array of its features."""

        def node(tree: int, k: int) -> Column:
            inner = self.forest.feature.shape[1]
            if k >= inner:
                return F.lit(float(self.forest.leaf[tree, k - inner]))
            cut = float(self.forest.threshold[tree, k])
            if not np.isfinite(cut):
                return node(tree, 2 * k + 1)
            value = F.get(values, F.lit(int(self.forest.feature[tree, k])))
            return F.when(value > cut, node(tree, 2 * k + 2)).otherwise(node(tree, 2 * k + 1))

        total = F.lit(self.forest.start)
        for tree in range(len(self.forest.leaf)):
            total = total + node(tree, 0)
        return total


class Maker:
    """Random parts of texts that are made by rule."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def d(self, n: int) -> str:
        return "".join(self.rng.choice("0123456789") for _ in range(n))

    def w(self, n: int) -> str:
        return "".join(self.rng.choice("abcdefghiklmnoprstuvw") for _ in range(n))

    def of(self, letters: str, n: int) -> str:
        """Letters with at least one digit and one letter."""
        while True:
            text = "".join(self.rng.choice(letters) for _ in range(n))
            if any(c.isdigit() for c in text) and any(c.isalpha() for c in text):
                return text

    def hex(self, n: int) -> str:
        return self.of("0123456789abcdef", n)

    def alnum(self, n: int) -> str:
        return self.of("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", n)

    def card(self) -> str:
        number = self.rng.choice("345") + self.d(14)
        total = sum(int(c) if i % 2 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(number))
        return number + str(-total % 10)

    def group(self, n: int) -> str:
        return self.of("0123456789abcdef", n) if n > 1 else self.rng.choice("123456789abcdef")

    def pick(self, *texts: str) -> str:
        return self.rng.choice(texts)


OPEN, CLOSE = "⟦", "⟧"


def plain_spans(text: str, kind: str | None) -> tuple[str, list[tuple[int, int, int]]]:
    """A text without its marks, and the spans that stood between them: start, end, kind."""
    plain, spans, start = "", [], 0
    for c in text:
        if c == OPEN:
            start = len(plain)
        elif c == CLOSE:
            spans.append((start, len(plain), ALL_KINDS.index(kind)))
        else:
            plain += c
    return plain, spans


def made_texts(n: int = 60, seed: int = 5) -> list[tuple[str, str | None]]:
    """Texts for training: other ways to write personal data, between marks and with its
    kind, and things that look like it."""
    m, out = Maker(seed), []
    d, w, rng = m.d, m.w, m.rng
    for _ in range(n):
        number = m.card()
        cue = m.pick("phone: ", "tel ", "call ", "mobile ", "fax. ", f"{w(5)} ", f"{w(7)} ")
        assign = m.pick('token = "', "api_key: ", "password=", "secret='", "Bearer ", 'auth_token="', "key = ")
        iban = m.pick("iban ", "account ", "acct. ", "")
        good = [
            ("phone", f"{cue}⟦({rng.randint(2, 9)}{d(2)}) {d(3)}-{d(4)}⟧ {w(4)}"),
            ("phone", f"{cue}⟦{rng.randint(2, 9)}{d(2)}-{d(3)}-{d(4)}⟧ {w(4)}"),
            ("phone", f"{cue}⟦0{d(2)} {d(4)} {d(4)}⟧ {w(4)}"),
            ("phone", f"{cue}⟦(0{d(2)}) {d(4)}-{d(4)}⟧, {w(4)}"),
            ("phone", f"{cue}⟦0{d(4)} {d(6)}⟧ {w(4)}"),
            ("phone", f"{cue}⟦{rng.randint(2, 9)}{d(2)}.{d(3)}.{d(4)}⟧ {w(4)}"),
            ("phone", f"{cue}⟦0{d(2)} {d(3)} {d(4)}⟧ {w(4)}"),
            ("phone", f"{cue}⟦0{d(3)}-{d(3)}-{d(4)}⟧ {w(4)}"),
            ("phone", f"{cue}⟦(0{d(2)}){d(3)}-{d(4)}⟧, {w(4)}"),
            ("phone", f"{cue}⟦({rng.randint(2, 9)}{d(2)}) {d(3)} {d(4)}⟧ {w(4)}"),
            ("phone", f"{cue}⟦{rng.randint(2, 9)}{d(2)}-{d(3)} {d(4)}⟧ {w(4)}"),
            ("phone", f"{cue}⟦(0{d(3)}) {d(6)}⟧ {w(4)}"),
            ("phone", f"{cue}⟦0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}⟧ {w(4)}"),
            ("email", f"{w(4)} ⟦{w(6)}.{w(4)} (at) {w(6)}.{w(3)}⟧ {w(5)}"),
            ("email", f"{w(4)} ⟦{w(6)}{d(2)}[at]{w(6)} [dot] {w(3)}⟧ {w(5)}"),
            ("card", f"{w(4)} ⟦{number}⟧ ⟦{m.card()}⟧ {w(5)}"),
            ("card", f"{w(4)} ⟦{number[:4]}.{number[4:8]}.{number[8:12]}.{number[12:]}⟧ {w(5)}"),
            ("secret", f"{w(4)} {assign}⟦{m.hex(m.rng.choice([32, 40, 64]))}⟧{m.pick('', chr(34))} {w(4)}"),
            ("secret", f"{w(4)} {assign}⟦{m.alnum(rng.randint(20, 48))}⟧ {w(4)}"),
            ("secret", f"{w(4)} ⟦AKIA{m.of('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 16)}⟧ {w(4)}"),
            ("id", f"{w(4)} {m.pick('ssn ', 'ident. ', '', '')}⟦{rng.randint(1, 6)}{d(2)}-{rng.randint(10, 99)}-{d(4)}⟧ {w(4)}"),
            ("id", f"{w(4)} {iban}⟦DE{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}⟧ {w(4)}"),
            ("id", f"{w(4)} {iban}⟦GB{d(2)} {m.pick('ABCD', 'NWBK', 'LOYD')} {d(4)} {d(4)} {d(4)} {d(2)}⟧ {w(4)}"),
            ("id", f"{w(4)} {iban}⟦NL{d(2)}{m.pick('ABNA', 'INGB')}{d(4)}{d(4)}{d(2)}⟧ {w(4)}"),
            ("id", f"{w(4)} {iban}⟦PL{d(2)} {' '.join(d(4) for _ in range(rng.randint(3, 6)))}⟧ {w(4)}"),
            ("ipv6", f"{w(4)} {m.pick('addr ', 'host ', '')}⟦{m.group(4)}:{m.group(3)}::{m.group(2)}⟧ {w(4)}"),
            ("ipv6", f"{w(4)} ⟦{m.group(4)}::{':'.join(m.group(rng.randint(1, 4)) for _ in range(rng.randint(1, 4)))}⟧ {w(4)}"),
            ("ipv6", f"{w(4)} ⟦{':'.join(m.group(rng.randint(1, 4)) for _ in range(rng.randint(2, 4)))}::{m.group(4)}⟧ {w(4)}"),
            ("ipv6", f"{w(4)} ⟦{':'.join(m.group(4) for _ in range(8))}⟧ {w(4)}"),
        ]
        bad = [
            f"{w(2)} 20{d(2)}-{rng.randint(10, 12)}-{rng.randint(10, 28)} {d(2)}:{d(2)} {w(2)}",
            f"{w(2)} {rng.randint(10, 28)}-{rng.randint(10, 12)}-20{d(2)} {d(2)} {d(2)} {w(2)}",
            f"{w(3)} $ {d(3)}.{d(3)}.{d(3)} {w(4)}",
            f"{w(3)} {d(2)}.{d(3)}.{d(3)} {w(4)} {d(3)} {d(3)} {d(3)} {d(3)} {w(2)}",
            f"{w(5)} no. {rng.randint(3, 9)}{d(14)}7 {w(3)}",
            f"{w(5)} order {d(5)} {d(5)} {w(3)}",
            f"{w(4)} {d(2)}-{d(3)}-{d(5)}/{d(2)} {w(2)}",
            f"{w(7)} {rng.randint(300, 999)}.{d(3)}.{d(2)}.{d(3)} {w(4)}",
            f"{w(5)} {d(4)} {d(4)} {d(4)} {w(3)}",
            f"{w(5)} {d(3)}.{d(4)} {d(4)} {w(3)}",
            f"{w(5)} {d(9)} {w(3)} {d(11)} {w(2)}",
            f"{w(5)} {d(6)} {d(6)} {w(3)} {d(4)}-{d(4)} {w(2)} {d(5)}-{d(4)} {w(2)}",
            f"{w(5)} {m.pick('USD ', 'CHF ', '€')}{d(2)}.{d(3)}.{d(3)},{d(2)} {w(3)} {d(3)} {d(3)} {d(3)} {w(2)}",
            f"{w(5)} {d(1)}.{d(5)} {d(5)} {w(3)} {d(3)} {d(2)} {d(4)} {w(2)}",
            f"ISBN 978-{d(1)}-{d(2)}-{d(6)}-{d(1)} {w(3)}",
            f"{w(3)} commit {m.hex(40)} {w(3)}",
            f"{w(3)} sha256: {m.hex(64)} {w(3)}",
            f"{w(3)} {m.pick('md5 ', 'etag ', '')}{m.hex(32)} {w(3)}",
            f"{w(3)} {m.hex(8)}-{m.hex(4)}-{m.hex(4)}-{m.hex(4)}-{m.hex(12)} {w(3)}",
            f"{w(3)} {w(5)}-{w(6)}-{w(4)}-{d(4)} {w(3)} IMG_20{d(6)}_{d(6)} {w(2)}",
            f"{w(3)} {m.pick('key ', 'token ')}{w(8)}-{w(8)}-{d(2)} {w(3)}",
            f"{w(3)} {w(6)}_{w(7)}_{w(5)}{d(3)} {w(3)}",
            f"{w(3)} {rng.randint(10, 23)}:{d(2)}:{d(2)} {w(3)} {d(1)}:{d(2)}:{d(2)}:{d(3)} {w(2)}",
            f"{w(3)} {':'.join(m.group(2) for _ in range(6))} {w(3)} a::b std::{w(4)} {w(2)}",
            f"{w(3)} part 9{d(2)}-{d(2)}-{d(4)} {w(3)} 000-{d(2)}-{d(4)} {w(3)}",
            f"{w(3)} XK{d(2)} {d(4)} {d(4)} {w(3)}",
        ]
        out += [(text, kind) for kind, text in good] + [(text, None) for text in bad]
    return out


def held_out_texts(n: int = 40, seed: int = 77) -> list[tuple[str, str | None]]:
    """The same, by formats and words that ``made_texts`` does not use."""
    m, out = Maker(seed), []
    d, w, rng = m.d, m.w, m.rng
    for _ in range(n):
        number = m.card()
        out += [
            (f"{w(5)} reach us at ⟦0{d(3)} {d(3)} {d(3)}⟧ {w(4)}", "phone"),
            (f"{w(5)} dial ⟦({rng.randint(2, 9)}{d(2)}){d(3)}-{d(4)}⟧, {w(4)}", "phone"),
            (f"{w(5)} {w(3)} ⟦{rng.randint(2, 9)}{d(2)} {d(3)}-{d(4)}⟧ {w(4)}", "phone"),
            (f"{w(5)} ring ⟦(0{d(3)}) {d(3)}-{d(4)}⟧. {w(4)}", "phone"),
            (f"{w(4)} ⟦{w(5)}_{w(4)} [at] {w(7)}.{w(2)}⟧ {w(5)}", "email"),
            (f"{w(4)} ⟦{w(8)}(at){w(6)}(dot){w(3)}⟧, {w(5)}", "email"),
            (f"{w(4)} visa ⟦{number[:4]}.{number[4:8]}.{number[8:12]}.{number[12:]}⟧; {w(5)}", "card"),
            (f'{w(4)} access_token: "⟦{m.alnum(rng.randint(24, 40))}⟧" {w(4)}', "secret"),
            (f"{w(4)} client_secret => '⟦{m.hex(48)}⟧' {w(4)}", "secret"),
            (f"{w(4)} X-Api-Key: ⟦{m.alnum(32)}⟧ {w(4)}", "secret"),
            (f"{w(4)} passwd=⟦{m.alnum(20)}⟧ {w(4)}", "secret"),
            (f"{w(4)} social security ⟦{rng.randint(1, 6)}{d(2)}-{rng.randint(10, 99)}-{d(4)}⟧. {w(4)}", "id"),
            (f"{w(4)} passport, ⟦FR{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(4)}⟧ {w(4)}", "id"),
            (f"{w(4)} reach ⟦fe80::{m.group(4)}:{m.group(4)}:{m.group(4)}⟧ {w(4)}", "ipv6"),
            (f"{w(4)} ⟦{m.group(4)}:{m.group(4)}:{m.group(2)}::{m.group(1)}:{m.group(3)}⟧ {w(4)}", "ipv6"),
            (f"{w(3)} {d(4)}/{d(2)}/{d(2)} {d(2)}:{d(2)}:{d(2)} {w(3)}", None),
            (f"{w(3)} EUR {d(2)}.{d(3)}.{d(3)},{d(2)} {w(3)}", None),
            (f"{w(3)} sha1 {m.hex(40)} {w(3)}", None),
            (f"{w(3)} guid {m.hex(8)}-{m.hex(4)}-{m.hex(4)}-{m.hex(4)}-{m.hex(12)} {w(3)}", None),
            (f"{w(3)} {w(5)}/{w(7)}/{w(6)}-{d(3)} {w(3)}", None),
            (f"{w(3)} ISSN {d(4)}-{d(4)}, serial {d(6)} {d(6)} {w(3)}", None),
            (f"{w(3)} {d(1)}:{d(2)}:{d(2)} and {rng.randint(10, 23)}:{d(2)}:{d(2)} {w(3)}", None),
            (f"{w(3)} model 9{d(2)}-{d(2)}-{d(4)} {w(3)}", None),
            (f"{w(3)} pi 3.14159 26535 {w(3)} {d(3)} {d(2)} {d(3)} {w(3)}", None),
        ]
    return out


def measure(spark: SparkSession, model: Model) -> dict[str, tuple[float, float, int, int]]:
    """Precision and recall of the added spans of each kind on ``held_out_texts``, and how
    many were added and wanted."""
    texts = [plain_spans(*t) for t in held_out_texts()]
    rows = [(k, text) for k, (text, _) in enumerate(texts)]
    want = {(k, ALL_KINDS[kind], start, end) for k, (_, spans) in enumerate(texts) for start, end, kind in spans}
    found = find(spark.createDataFrame(rows, "doc_id bigint, text string"), model).select(
        "doc_id", F.explode(F.array_except("spans", "base_spans")).alias("s")
    )
    got = {(r.doc_id, r.s["kind"], r.s["start"], r.s["end"]) for r in found.collect()}
    out = {}
    for kind in ALL_KINDS:
        mine, wanted = ({x for x in side if x[1] == kind} for side in (got, want))
        right = len(mine & wanted)
        out[kind] = (right / max(len(mine), 1), right / max(len(wanted), 1), len(mine), len(wanted))
    return out


def evidence(docs: DataFrame) -> DataFrame:
    """All proposed spans of the table and of the made texts, equal ones counted in ``n``:
    their features ``x``, whether they are positives (``y``), overlap a base span (``hit``),
    are from a made text (``made``) and are of the half the trees learn from (``seen``)."""
    spark: SparkSession = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    wanted = "array<struct<start:int,end:int,kind:int>>"
    real = docs.where(text.rlike(LOOK)).select(text.alias("text"), F.lit(None).cast(wanted).alias("made"))
    made = spark.createDataFrame([plain_spans(*t) for t in made_texts()], f"text string, made {wanted}")
    both = real.union(made).select(
        "made", F.xxhash64("text").alias("h"), base_spans(F.col("text")).alias("base"),
        F.explode(candidate_spans(F.col("text"))).alias("c"),
    )
    hit = F.exists(
        "base", lambda b: (b["start"] < F.col("c.end")) & (b["end"] > F.col("c.start"))
    )
    assigned = (F.col("c.kind") == ALL_KINDS.index("secret")) & F.col("c.before").rlike(SECRET_CUE + r"(?<=[:=\"' ])")
    mine = F.struct("c.start", "c.end", "c.kind")
    label = F.coalesce(F.exists("made", lambda w: w == mine), hit | assigned)
    proposed = both.select(
        F.col("made").isNotNull().alias("made"), (F.col("h") % 2 == 0).alias("seen"), label.alias("y"),
        hit.alias("hit"), "c.kind", F.array(*features(F.col("c"))).alias("x"),
    )
    # Of the kinds without base rules, what overlaps a base span is never added.
    proposed = proposed.where((F.col("kind") < len(KINDS)) | ~F.col("hit"))
    return proposed.groupBy("made", "seen", "y", "hit", "kind", "x").agg(F.count("*").alias("n"))


def weights(rows: DataFrame, n_texts: int) -> np.ndarray:
    """The weight of one span by whether its text is made, its kind, and base overlap."""
    counts = np.zeros((2, len(ALL_KINDS), 2))
    for r in rows.groupBy("made", "kind", "hit").agg(F.sum("n").alias("n")).collect():  # of three small sets
        counts[int(r["made"]), r["kind"], int(r["hit"])] = r["n"]
    of_text = np.array([min(1.0, TEXTS / max(n_texts, 1)), 1.0])[:, None, None]
    return of_text * np.minimum(1.0, SPANS / np.maximum((of_text * counts).sum(0), 1.0))


def fit(docs: DataFrame) -> Model:
    """Trees and thresholds from all rows of the table and the made texts."""
    rows = settled(evidence(docs))
    weight = weights(rows, docs.where(F.col("text").rlike(LOOK)).count())
    units = np.rint(weight * boosting.UNIT).astype(int).ravel().tolist()
    place = (F.col("made").cast("int") * len(ALL_KINDS) + F.col("kind")) * 2 + F.col("hit").cast("int")
    rows = rows.withColumn("units", F.get(F.array(*[F.lit(u).cast("long") for u in units]), place) * F.col("n"))
    n_features = len(features(F.struct(*[F.lit("").alias(c) for c in ("kind", "m", "before", "after")])))
    forest = boosting.train_over(rows.where("seen"), n_features, trees=30, depth=4, rate=0.3)

    limits = F.array(*[F.lit(float(np.log(t / (1 - t)))) for t in THRESHOLDS])
    score = _let(F.col("x"), Model(forest, []).score)
    level = _let(score, lambda score: F.size(F.filter(limits, lambda limit: limit <= score)))
    free = (~F.col("seen") & ~F.col("hit")).alias("free")
    summed = (
        rows.select("kind", "y", free, level.alias("level"), "units")
        .groupBy("kind", "y", "free", "level").agg(F.sum("units").alias("units"))
        .orderBy("kind", "y", "free", "level").collect()  # of four small sets
    )
    at = np.concatenate([[0.0], THRESHOLDS])  # a score below all stands for those not reached
    kinds = np.array([r["kind"] for r in summed], dtype=float)
    y = np.array([r["y"] for r in summed], dtype=float)
    score = np.array([at[r["level"]] for r in summed], dtype=float)
    use = np.array([r["free"] * r["units"] / boosting.UNIT for r in summed], dtype=float)
    return Model(forest, calibrated(kinds, y, score, use))


def calibrated(kinds: np.ndarray, y: np.ndarray, score: np.ndarray, use: np.ndarray) -> list[float]:
    """For each kind, the least threshold that has the precision among the spans in use.

    ``use`` is the weight of each, so one may stand for many, and 0 is not in use.
    """
    thresholds = []
    for kind in range(len(ALL_KINDS)):
        fit_at = []
        for t in THRESHOLDS:
            reached = np.where((kinds == kind) & (score >= t), use, 0.0)
            if reached.any() and (reached * y).sum() >= PRECISION * reached.sum():
                fit_at.append(t)
        thresholds.append(float(fit_at[0]) if fit_at else 2.0)  # 2: none is added
    return thresholds


def all_spans(text: Column, base: Column, model: Model) -> Column:
    """Base spans and the added ones, ordered by start, then kind."""

    def scored(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
            _let(F.array(*features(s)), model.score).alias("score"), F.lit(False).alias("base"),
        )

    limits = F.array(
        *[F.lit(float(np.log(t / (1 - t))) if t < 1 else float("inf")) for t in model.thresholds]
    )
    added = F.filter(
        F.transform(candidate_spans(text), scored), lambda s: s["score"] >= F.get(limits, s["kind"])
    )
    fixed = F.transform(
        base,
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
            F.lit(0.0).alias("score"), F.lit(True).alias("base"),
        ),
    )
    kind = "array<struct<start:int,end:int,kind:int,score:double,base:boolean>>"
    both = F.array_sort(F.concat(added.cast(kind), fixed.cast(kind)))

    def sweep(seen: Column, x: Column) -> Column:
        spans = seen["spans"]
        last = F.try_element_at(spans, F.lit(-1))
        clash = F.coalesce(~last["base"] & (last["end"] > x["start"]), F.lit(False))
        better = x["base"] | (x["score"] > last["score"])
        most = F.greatest(F.size(spans) - 1, F.lit(0))
        kept = F.when(clash & better, F.slice(spans, F.lit(1), most)).otherwise(spans)
        skip = ~x["base"] & ((x["start"] < seen["until"]) | (clash & ~better))
        return F.struct(
            F.when(x["base"], F.greatest(seen["until"], x["end"])).otherwise(seen["until"]).alias("until"),
            F.when(skip, spans).otherwise(F.concat(kept, F.array(x))).cast(kind).alias("spans"),
        )

    start = F.struct(F.lit(0).alias("until"), F.array().cast(kind).alias("spans"))
    swept = F.aggregate(both, start, sweep)["spans"]
    return _ordered(swept)


def find(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``, arrays of start, end and kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = [c for c in docs.columns if c not in ("base_spans", "spans")]
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    looked = docs.select(
        F.struct(*kept).alias("row"),  # so that no name of theirs meets one used here
        text.alias("text"),
        F.when(text.rlike(LOOK), base_spans(text)).alias("base"),
    )
    more = all_spans(F.col("text"), F.col("base"), model)
    found = looked.withColumn("all", F.when(F.col("base").isNotNull(), more))

    def named(spans: Column) -> Column:
        names = F.array(*map(F.lit, ALL_KINDS))
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["kind"]).alias("kind")
            ),
        )

    return found.select(
        "row.*",
        F.coalesce(named(F.col("base")), none).alias("base_spans"),
        F.coalesce(named(F.col("all")), none).alias("spans"),
    )


def digest(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, as in ``[EMAIL]``."""
    text = F.col(text_col)

    def step(seen: Column, s: Column) -> Column:
        new = s["start"] >= seen["at"]
        between = F.substring(text, seen["at"] + 1, s["start"] - seen["at"])
        return F.struct(
            F.greatest(seen["at"], s["end"]).alias("at"),
            F.when(new, F.concat(seen["out"], between, F.lit("["), F.upper(s["kind"]), F.lit("]")))
            .otherwise(seen["out"])
            .alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        "spans", start, step, lambda seen: F.concat(seen["out"], F.substring(text, seen["at"] + 1, F.length(text)))
    )
    found = find(docs, model, text_col)
    return found.withColumn(text_col, F.when(F.size("spans") > 0, clean).otherwise(text)).drop("base_spans", "spans")
