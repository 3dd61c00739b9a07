"""Personal data by weak supervision (operator 9).

Strict patterns find the base spans (e-mail, IP address, card, phone). Looser patterns propose more: disguised
e-mail addresses, cards inside longer runs of digits, phone numbers without a country code, IP addresses of version 6,
national numbers, account numbers and secrets. On every proposed span, four labelers vote yes, no or nothing: a format
check, a gazetteer of domain ends, number prefixes and countries, the words around it (in four languages), and its
neighbouring characters. Expectation-maximisation over all spans of the corpus estimates how reliable
each labeler is, and a logistic span classifier is trained on the resulting probabilities. Spans that it accepts are
added; base spans always stay.

One pass over the texts writes spans with votes to a table. Estimation and training only need how often each
combination of kind, votes and shape (traits of the span's own characters) occurs: some thousands of counts, whatever the
size of the corpus.

Positions are code points, ends are exclusive. A null text counts as empty. Each row is judged by itself, so
nulls, ties and repeated rows in other columns have no effect. Matching takes time in proportion to the text.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausemill.llm.common import stored

# The kinds in the order of ties; the first four are the base kinds.
KINDS = ["email", "ip", "card", "phone", "national_id", "iban", "secret"]
BASE = KINDS[:4]
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The same matches as without its first and its doubled marks, which keep it from trying inside a run of digits.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser patterns, and the gazetteers and words that vote.
AT = re.compile(r"[\[(]\s?at\s?[\])]", re.IGNORECASE)
BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?$")
AFTER_AT = re.compile(r"\s?[A-Za-z0-9-]{1,63}(?:\s?(?:[\[(]\s?dot\s?[\])]|\.)\s?[A-Za-z0-9-]{2,63})+", re.IGNORECASE)
NUMBER = re.compile(r"(?<![0-9])(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{2,3}[ .-][0-9]{4}(?![0-9])")
PHONE_FORM = re.compile(r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}")
NATIONAL_FORM = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
LETTERED = re.compile(r"(?<![A-Za-z0-9])[0-9]{8}-?[A-Z](?![A-Za-z0-9])")  # eight digits and the letter of their remainder
KEYED = re.compile(r"(?<![0-9])[12] ?[0-9]{2} ?[0-9]{2} ?[0-9]{2} ?[0-9]{3} ?[0-9]{3} ?[0-9]{2}(?![0-9])")  # 13 digits, a key of two
REMAINDER_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
IPV6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
DIGITS = re.compile(r"[0-9]+")
SECRET = re.compile(r"[:=][ \t]*[\"']?([A-Za-z0-9_/+-]{16,})")
DOMAIN_ENDS = set("com org net edu gov io info biz eu de fr es uk us it nl pl ch at be se no dk fi pt br mx ca au jp cn in ru".split())
ACCOUNT_COUNTRIES = set("AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK SM TR".split())
CARD_STARTS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38")
CUES = {
    "email": "mail e-mail email contact write address reach courriel adresse écrire schreiben kontakt correo escribir",
    "ip": "ip ipv6 address host server login from client addr serveur adresse servidor dirección",
    "card": "card visa credit debit amex mastercard payment pay carte paiement karte kreditkarte zahlung tarjeta pago",
    "phone": "phone call tel telephone mobile cell fax whatsapp contact dial number tél téléphone portable telefon handy anruf teléfono móvil llamar",
    "national_id": "ssn social security national insurance id tax identity sécurité sociale nir ausweis steuer dni nie identidad",
    "iban": "iban account bank transfer compte banque virement konto überweisung cuenta banco transferencia",
    "secret": "token secret key password passwd pwd apikey api_key access_key credential auth jeton passe clé passwort schlüssel contraseña clave",
}
COUNTER_CUES = set("version isbn issn order part figure section page chapter item model build release serial invoice".split())
CUES_OF = {kind: set(words.split()) for kind, words in CUES.items()}
CONTEXT_CHARS = 40
CONTEXT_WORD = re.compile(r"[^\W\d]+(?:[_-][^\W\d]+)*")

TRAITS = "sldaurm"  # of a span's own characters: spaces, long, mostly digits, letters, capitals, few different ones, marks
LABELERS = ["format", "gazetteer", "context", "neighbours"]
SPAN = "struct<kind:string,start:int,end:int,base:boolean,votes:string,shape:string>"
PRIOR_VOTES = 2.0  # pseudo-counts that keep estimates away from 0 and 1
ROUNDS = 50
MIN_PROBABILITY = 0.5


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    doubled = [int(d) if at % 2 == 0 else (2 * int(d)) % 9 or (9 if d != "0" else 0) for at, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The strict matches as (start, end, kind), sorted by start, then by kind as listed."""
    found = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end(), "email"))
            done = domain.end()
        else:
            done = max(done, at)
        at = text.find("@", at + 1)
    for m in IP.finditer(text):
        if all(map(_octet, m[0].split("."))):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), m.end(), "phone"))
    order = {kind: at for at, kind in enumerate(KINDS)}
    return sorted(found, key=lambda s: (s[0], order[s[2]], s[1]))


def account_check(number: str) -> bool:
    """Whether the check digits of an account number are right: moved to its end, letters as 10 to 35, 1 remains of 97."""
    number = number.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def national_check(span: str) -> bool | None:
    """Whether the check letter or key of a national number is right; None for a form without one."""
    plain = re.sub(r"[ -]", "", span)
    if plain[-1].isalpha():
        return REMAINDER_LETTERS[int(plain[:-1]) % 23] == plain[-1]
    if len(plain) == 15:
        return 97 - int(plain[:13]) % 97 == int(plain[13:])
    return None


def _version_6(span: str) -> bool:
    try:
        ipaddress.IPv6Address(span)
    except ValueError:
        return False
    return len(re.findall(r"[0-9A-Fa-f]+", span)) >= 3


def cards_inside(run: re.Match) -> Iterator[tuple[int, int]]:
    """Stretches of whole groups of a run of digits that have a card's length and check digit, leftmost and shortest first.

    Groups of a card have three digits or more, so a stretch has at most six.
    """
    groups = [m.span() for m in DIGITS.finditer(run.string, run.start(), run.end())]
    at = 0
    while at < len(groups):
        digits, to, after = "", at, at + 1
        while to < len(groups) and 3 <= groups[to][1] - groups[to][0] <= 19 - len(digits):
            digits += run.string[slice(*groups[to])]
            to += 1
            if len(digits) >= 13 and CARD_STARTS.match(digits) and luhn(digits):
                yield groups[at][0], groups[to - 1][1]
                after = to
                break
        at = after


def loose_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Further proposals that touch no base span and not each other, sorted by start."""
    found = []
    for m in AT.finditer(text):
        before = BEFORE_AT.search(text, max(0, m.start() - 66), m.start())
        after = AFTER_AT.match(text, m.end())
        if before and after:
            found.append((before.start(), after.end(), "email"))
    for m in NUMBER.finditer(text):
        found.append((m.start(), m.end(), "national_id" if NATIONAL_FORM.fullmatch(m[0]) else "phone"))
    for form in (LETTERED, KEYED):
        for m in form.finditer(text):
            if national_check(m[0]):
                found.append((m.start(), m.end(), "national_id"))
    for m in IBAN.finditer(text):
        found.append((m.start(), m.end(), "iban"))
    for m in IPV6.finditer(text):
        if _version_6(m[0]):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            found += [(a, b, "card") for a, b in cards_inside(m)]
    for m in SECRET.finditer(text):
        found.append((m.start(1), m.end(1), "secret"))
    taken, at, free = [*base], 0, []
    taken.sort()
    last = 0
    for span in sorted(found):
        while at < len(taken) and taken[at][1] <= span[0]:
            at += 1
        if span[0] >= last and not any(b[0] < span[1] and span[0] < b[1] for b in taken[at : at + 4]):
            free.append(span)
            last = span[1]
    return free


def _vote(yes: bool, no: bool) -> str:
    return "+" if yes else "-" if no else "0"


def votes(text: str, start: int, end: int, kind: str) -> tuple[str, str]:
    """The four labelers' votes on a span, and its shape."""
    span = text[start:end]
    digits = re.sub(r"[^0-9]", "", span)
    varied = len(set(span)) >= 6
    if kind == "email":
        form = _vote("@" in span, False)
        ending = re.split(r"[.\s\])]+", span.rstrip(".] )"))[-1].lower()
        listed = _vote(ending in DOMAIN_ENDS, not ending.isalpha())
    elif kind == "ip" and ":" in span:
        form = _vote(_version_6(span), True)
        listed = _vote(span[0] in "23", span.lower().startswith(("2001:db8:", "::", "fe80:")))
    elif kind == "ip":
        parts = [p.lstrip("0") or "0" for p in span.split(".")]
        form = _vote(all(p == "0" or not raw.startswith("0") for p, raw in zip(parts, span.split("."), strict=True)), False)
        listed = _vote(parts[0] != "0", parts[0] == "0")
    elif kind == "card":
        form = _vote(luhn(digits), True)
        listed = _vote(bool(CARD_STARTS.match(digits)), len(set(digits)) <= 2)
    elif kind == "phone":
        form = _vote(span.startswith("+") or bool(PHONE_FORM.fullmatch(span)), True)
        listed = _vote(digits[-10:][:1] not in "01" or span.startswith("+"), len(set(digits)) <= 2 or digits[-10:][:1] in "01")
    elif kind == "national_id":
        checked = national_check(span)
        form = _vote(bool(checked or NATIONAL_FORM.fullmatch(span)), True)
        listed = _vote(bool(checked), checked is None and (digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000"))
    elif kind == "iban":
        form = _vote(account_check(span), True)
        listed = _vote(span[:2] in ACCOUNT_COUNTRIES, span[:2] not in ACCOUNT_COUNTRIES)
    else:
        mixed = sum((any(c.isdigit() for c in span), any(c.isupper() for c in span), any(c.islower() for c in span)))
        form = _vote(len(digits) >= 4 and varied and mixed >= 2, not digits or not varied)
        listed = _vote(bool(re.match(r"(?:AKIA|gh[pousr]_|sk-|xox[abp]-|eyJ)", span)) or bool(re.fullmatch(r"[0-9a-f]{32,}", span)), "/" in span)
    around = text[max(0, start - CONTEXT_CHARS) : start]
    near = {w.lower() for w in CONTEXT_WORD.findall(around)}
    context = _vote(bool(near & CUES_OF[kind]), bool(near & COUNTER_CUES))
    left, right = text[start - 1 : start], text[end : end + 1]
    bare = (not left or left.isspace() or left in "\"'([<:=,;") and (not right or right.isspace() or right in "\"')]>,;.!?")
    neighbours = _vote(bare, (left + right).isalnum() and bool(left + right) and not bare)
    letters = sum(map(str.isalpha, span))
    traits = {
        "s": re.search(r"[ ()]", span),
        "l": len(span) >= 20,
        "d": 2 * len(digits) >= len(span),
        "a": letters > 0,
        "u": any(map(str.isupper, span)),
        "r": not varied,
        "m": len(span) > len(digits) + letters + span.count(" "),
    }
    shape = "".join(t for t in TRAITS if traits[t])
    return form + listed + context + neighbours, shape


def spans_of(text: str) -> list[tuple[int, int, str, bool, str, str]]:
    """All proposed spans of a text as (start, end, kind, base, votes, shape), by start, then kind as listed."""
    base = base_spans(text)
    every = [(*s, True) for s in base] + [(*s, False) for s in loose_spans(text, base)]
    order = {kind: at for at, kind in enumerate(KINDS)}
    every.sort(key=lambda s: (s[0], order[s[2]], s[1]))
    return [(*s, *votes(text, s[0], s[1], s[2])) for s in every]


def _found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        spans = [
            [dict(zip(("start", "end", "kind", "base", "votes", "shape"), s, strict=True)) for s in spans_of(text or "")]
            for text in batch["text"]
        ]
        yield pd.DataFrame({"key": batch["key"], "spans": spans})


def propose(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each row's ``key`` and its proposed ``spans``, as a written table."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return stored(docs.sparkSession, rows.mapInPandas(_found, f"key {kind}, spans array<{SPAN}>"), "spans")


def patterns(proposed: DataFrame) -> list[tuple[str, str, str, int]]:
    """How often each (kind, votes, shape) occurs; at most kinds x 3^4 x 2^7 rows."""
    spans = proposed.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.shape")
    return sorted(tuple(r) for r in spans.groupBy("kind", "votes", "shape").agg(F.count("*")).collect())


def reliabilities(counts: list[tuple[str, str, str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation: each pattern's probability of being personal data, and each labeler's table.

    The table gives, for a span that is none and one that is, the probabilities of the votes -, 0 and +.
    """
    n = np.array([c[3] for c in counts], dtype=float)
    vote = np.array([["-0+".index(v) for v in c[1]] for c in counts])
    kind = np.array([KINDS.index(c[0]) for c in counts])
    table = np.tile(np.array([[0.5, 0.35, 0.15], [0.1, 0.3, 0.6]]), (len(LABELERS), 1, 1))
    prior = np.full(len(KINDS), 0.5)
    start, held = table.copy(), np.full(len(counts), 0.5)
    for _ in range(ROUNDS):
        like = np.stack([np.log(table[np.arange(len(LABELERS)), z, vote]).sum(axis=1) for z in (0, 1)], axis=1)
        like[:, 0] += np.log(1 - prior[kind])
        like[:, 1] += np.log(prior[kind])
        held = 1 / (1 + np.exp(like[:, 0] - like[:, 1]))
        for z, weight in ((0, n * (1 - held)), (1, n * held)):
            for j in range(len(LABELERS)):
                counted = np.bincount(vote[:, j], weights=weight, minlength=3) + PRIOR_VOTES * start[j, z] * 3
                table[j, z] = counted / counted.sum()
        yes = np.bincount(kind, weights=n * held, minlength=len(KINDS)) + PRIOR_VOTES
        prior = yes / (np.bincount(kind, weights=n, minlength=len(KINDS)) + 2 * PRIOR_VOTES)
    return held, table


def _features(counts: list[tuple[str, str, str, int]]) -> np.ndarray:
    rows = []
    for kind, vote, shape, *_ in counts:
        votes_ = [float(v == sign) for v in vote for sign in "-+"]
        rows.append([1.0, *(float(kind == k) for k in KINDS), *votes_, *(float(t in shape) for t in TRAITS)])
    return np.array(rows)


def classifier(counts: list[tuple[str, str, str, int]], held: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on the estimated probabilities, by Newton's method."""
    x, n = _features(counts), np.array([c[3] for c in counts], dtype=float)
    n = n / n.sum() * min(n.sum(), 10_000.0)  # beyond that many spans the ridge has no effect worth having
    w = np.zeros(x.shape[1])
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (held - p)) - ridge * w
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def accepted(counts: list[tuple[str, str, str, int]]) -> list[str]:
    """The patterns, as kind:votes:shape, whose spans the trained classifier accepts."""
    if not counts:
        return []
    held, _ = reliabilities(counts)
    p = 1 / (1 + np.exp(-_features(counts) @ classifier(counts, held)))
    return [":".join(c[:3]) for c, value in zip(counts, p, strict=True) if value >= MIN_PROBABILITY]


def find(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each row's ``key`` with its ``spans``: the base spans and those the classifier accepts."""
    proposed = propose(docs, text, key)
    good = F.array(*(F.lit(p) for p in accepted(patterns(proposed)))).cast("array<string>")
    spans = F.filter(
        "spans", lambda s: s["base"] | F.array_contains(good, F.concat_ws(":", s["kind"], s["votes"], s["shape"]))
    )
    return proposed.select(F.col("key").alias(key), spans.alias("spans"))
