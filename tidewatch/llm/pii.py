"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Method: candidate gradient boosting. High-recall generators propose spans of
four kinds (email, ip, card, phone); they may overlap. Boosted regression
trees score each candidate on the format of the span and on its context, and a
threshold per kind, calibrated on templates kept apart, selects those to redact. The
base spans (the strict patterns below) always stay; the trees add the rest:
written-out mail addresses, phone numbers without a plus sign, grouped cards,
bracketed addresses.

The trees are trained on spans made by seeded templates (positives: the ways
people write such data; negatives: dates, versions, prices, order numbers,
hashes and the like), so training needs no table and no labels. The model has a
fixed size. Finding is one pass over whole texts without a shuffle.

Defined results: a null text is the empty text and has no spans; a very long
text is searched whole, in time that grows with its length (also over long runs
of digits and many spans); candidates of equal probability are taken by kind,
then place; a null id stays null; repeated rows are searched each; an empty table
gives no rows; other columns are not read (``redact`` keeps them).
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import filled

KINDS = ("email", "ip", "card", "phone")
SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)

# The base patterns.
_MAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# As the plain pattern finds them: a match takes whole runs of digits, so one that starts inside a run has an
# earlier start, and giving digits back never brings a dot nearer. Each run is read a fixed number of times.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _mails(text: str) -> list[tuple[int, int]]:
    """As the whole pattern finds them; starts at each @ sign, so long words cost nothing."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _MAIL_LOCAL:
            start -= 1
        found = _MAIL_DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            out.append((start, done))
        else:  # later names cannot reach back over this sign
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the strict patterns; failing matches are dropped, not retried."""
    out = [(0, a, b) for a, b in _mails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _only_digits(m.group())
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_only_digits(m.group())) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


# --- candidates -----------------------------------------------------------------------

_LOOSE_MAIL = re.compile(
    r"[\w.%+-]{1,64}\s?(?:@|＠|[\[({]\s?at\s?[\])}])\s?[\w-]{1,63}(?:(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)[\w-]{2,24}){1,4}"
    r"|[\w.%+-]{1,64}\sat\s[\w-]{1,63}(?:(?:\.|\sdot\s)[\w-]{2,24}){1,4}",
    re.I,
)
_LOOSE_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\s?\.\s?)[0-9]{1,3}){3}(?![\w])")
_LOOSE_CARD = re.compile(r"(?<![\w])(?:[0-9]{13,19}|[0-9]{4}(?:[\s._/-]{1,2}[0-9]{3,6}){2,4})(?!\w)")
_LOOSE_PHONE = re.compile(
    r"(?<![\w.+-])(?:\+[0-9]{1,3}[\s.-]?|00[1-9][0-9]{0,2}[\s.-]?)?\(?0?[0-9]{2,4}\)?(?:[\s./-]{1,2}[0-9]{2,4}){1,4}(?![0-9-])"
)
# One character, with what every loose address has after it.
_AT_HINT = re.compile(
    r"(?:[@＠]|[\[({](?=\s?at\s?[\])}])|\s(?=at\s))(?=(?:\s?at\s?[\])}]|at\s)?\s?[\w-]{1,63}\s?(?:\.|[\[({]\s?dot|dot\s))", re.I
)
_BEFORE_AT, _AFTER_AT = 66, 210  # more than a loose address has before and after that character


def _loose_mails(text: str) -> list[tuple[int, int]]:
    """As the whole pattern finds them; tried around the signs only, so other words cost nothing."""
    near: list[list[int]] = []
    for m in _AT_HINT.finditer(text):
        a, b = max(0, m.start() - _BEFORE_AT), m.end() + _AFTER_AT
        if near and a <= near[-1][1]:
            near[-1][1] = b
        else:
            near.append([a, b])
    return [m.span() for a, b in near for m in _LOOSE_MAIL.finditer(text, a, b)]


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of everything that could be personal data; spans may overlap."""
    out = [(0, a, b) for a, b in _loose_mails(text)]
    if _DIGIT.search(text):
        for kind, pattern in ((1, _LOOSE_IP), (2, _LOOSE_CARD), (3, _LOOSE_PHONE)):
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    return out


# Words that stand near personal data, and near numbers that are none.
_NEAR = {
    0: ("mail", "contact", "write", "reach", "kontakt", "correo", "courriel", "address"),
    1: ("ip", "host", "server", "address", "login", "client", "from"),
    2: ("card", "visa", "mastercard", "credit", "karte", "tarjeta", "carte", "payment", "pan"),
    3: ("tel", "phone", "call", "mobile", "fax", "cell", "telefon", "whatsapp", "sms", "contact", "dial", "ring"),
}
_FAR = (
    "version", "release", "isbn", "order", "invoice", "section", "chapter", "page", "figure", "date", "price",
    "build", "id", "no", "nr", "serial", "total", "usd", "eur", "hash", "sha", "rfc", "license", "pp", "vol", "score",
    "lat", "lon", "gps", "ref", "sku", "model", "part",
)
# Words that stand before "at" in prose, and ends of host names.
_AT_WORDS = frozenset((
    "look", "looked", "looking", "is", "are", "was", "were", "be", "been", "up", "down", "here", "live", "lives", "meet", "met", "stay", "stayed",
    "arrive", "arrived", "available", "found", "find", "see", "seen", "sold", "hosted", "based", "work", "works", "worked", "start", "starts",
    "ends", "us", "me", "it", "them", "online", "visit", "read", "more", "site", "posted", "published", "listed", "shop", "not", "only", "and", "or",
))
_HOST_ENDS = frozenset("com org net edu gov io info biz co uk de fr es it nl eu ch at pl ru jp cn in br ca au us".split())
_WORD = re.compile(r"[^\W\d_]+")
_MAIL_PARTS = re.compile(r"([\w.%+-]+)\W*(?:[@＠]|\bat\b).*?([\w-]+)$", re.I | re.S)
FEATURES = 27


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of the span and words around it."""
    span = text[start:end]
    before, after = text[max(0, start - 40) : start], text[end : end + 24]
    digits = _only_digits(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    near = [w.lower() for w in _WORD.findall(before)][-4:] + [w.lower() for w in _WORD.findall(after)][:2]
    values = [int(g) for g in re.findall(r"[0-9]{1,9}", span)]
    lower = span.lower()
    parts = _MAIL_PARTS.match(span) if kind == 0 else None
    local, end_label = parts.groups() if parts else ("", "")
    return [
        float(kind), float(len(span)), float(len(digits)), float(len(groups)),
        float(groups[0] if groups else 0), float(groups[-1] if groups else 0), float(max(groups, default=0)),
        float(min(groups, default=0)), float(max(values, default=0) <= 255), float(bool(digits) and luhn(digits)),
        float("(" in span and ")" in span), float(span.count("-")), float(span.count(".")), float(span.count(" ")),
        float(span.count("/")), float("@" in span or "＠" in span),
        float(bool(re.search(r"[\[({]\s?at|\sat\s", lower))), float(bool(re.search(r"[\[({]\s?dot|\sdot\s", lower))),
        float(any(w in near for w in _NEAR[kind])), float(any(w in near for w in _FAR)),
        float(before[-1:].isalnum() or before[-1:] in "$#€£.,="), float(after[:1].isalnum() or after[:1] in "%€$="),
        float(digits[:2] in ("19", "20")), float(span[:2] == "00" or span[:1] == "0" or span[:2] == "(0"),
        float(any(c in "._%+" or c.isdigit() for c in local)), float(local.lower() in _AT_WORDS), float(end_label in _HOST_ENDS),
    ]


def _examples(seed: int = 3, n: int = 220, family: str = "train") -> tuple[np.ndarray, np.ndarray]:
    """Spans written by templates, with label 1 where a person's data is meant.

    The families "train", "calibrate" and "test" share no template, so thresholds
    and figures come from ways of writing that the trees were not grown on.
    """
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    name = lambda: "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(3, 8)))

    def card() -> str:
        head = rng.choice("3456") + d(14)
        return next(head + c for c in "0123456789" if luhn(head + c))

    grouped = lambda c, s: s.join(c[k : k + 4] for k in range(0, 16, 4))
    octets = lambda s: s.join(str(rng.randint(0, 255)) for _ in range(4))
    filler = lambda: " ".join(name() for _ in range(rng.randint(1, 4)))
    ends, at_words = sorted(_HOST_ENDS), sorted(_AT_WORDS)
    positive = {
        0: [lambda: f"{name()}.{name()} at {name()} dot com", lambda: f"{name()}[at]{name()}[dot]org", lambda: f"{name()} (at) {name()} (dot) net",
            lambda: f"{name()} @ {name()}.com", lambda: f"{name()} at {name()}.com", lambda: f"{name()}＠{name()}.de",
            lambda: f"{name()}.{name()} at {name()}.{rng.choice(ends)}", lambda: f"{name()}{d(2)} at {name()}.{rng.choice(ends)}", lambda: f"{name()}[at]{name()}.{rng.choice(ends)}"],
        1: [lambda: octets("[.]"), lambda: octets("(.)"), lambda: octets(" . ")],
        2: [lambda: grouped(card(), "."), lambda: grouped(card(), "  "), lambda: grouped(card(), "/"), lambda: grouped(card(), "_"), card, card, lambda: grouped(card(), " ")],
        3: [lambda: f"({d(3)}) 555-{d(4)}", lambda: f"+{rng.randint(1, 99)} ({d(3)}) {d(3)}-{d(4)}", lambda: f"+{rng.randint(1, 99)} {d(3)} {d(3)} {d(4)}", lambda: f"{rng.randint(2, 9)}{d(2)}-{rng.randint(2, 9)}{d(2)}-{d(4)}", lambda: f"00{rng.randint(31, 49)} {d(3)} {d(3)} {d(4)}",
            lambda: f"0{d(3)} {d(3)} {d(4)}", lambda: f"(0{d(2)}) {d(4)} {d(4)}"],
    }

    def number(form) -> str:
        return next(t for t in iter(form, None) if not luhn(_only_digits(t)))

    negative = {
        0: [lambda: f"{name()} at {name()}.{name().title()}", lambda: f"look at {name()}.{d(2)}", lambda: f"{name()} @ {d(2)}.{d(2)}",
            lambda: f"{rng.choice(at_words)} at {name()}.{rng.choice(ends)}", lambda: f"{name()} at {name()}.{name()}"],
        1: [lambda: f"{d(1)} . {d(2)} . {d(1)} . {d(3)}", lambda: f"{rng.randint(256, 999)}[.]{d(3)}[.]{d(3)}[.]{d(3)}"],
        2: [lambda: number(lambda: grouped(d(16), rng.choice("./_ "))), lambda: number(lambda: d(rng.randint(13, 19))), lambda: number(lambda: f"{d(4)} {d(4)} {d(4)}"), lambda: f"{rng.randint(1900, 2030)}-{rng.randint(1900, 2030)}-{d(4)}"],
        3: [lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", lambda: f"{rng.randint(10, 28)}.{rng.randint(10, 12)}.{rng.randint(1900, 2030)}",
            lambda: f"{d(3)}.{d(2)}", lambda: f"{d(2)} {d(3)}", lambda: f"{d(4)}-{d(4)}", lambda: f"{d(3)}-{d(2)}-{d(5)}-{d(3)}", lambda: f"{d(2)}/{d(2)}/{d(4)}", lambda: f"{d(4)} {d(4)} {d(4)}", lambda: f"{d(3)} {d(3)} {d(3)}"],
    }
    stray = lambda: rng.choice(_FAR)
    negative[0] += [lambda: f"{rng.randint(1, 99)} at {name()}.{rng.choice(ends)}", lambda: f"{stray()} {d(2)} at {name()}.{rng.choice(ends)}"]
    negative[3] += [
        lambda: f"{stray()} {d(3)} {d(3)} {d(4)}", lambda: f"{stray()} no {d(3)}-{d(3)}-{d(4)}", lambda: f"{d(2)}.{d(4)} {d(2)} {d(2)} {d(2)}",
        lambda: f"{stray()} {d(2)}.{d(4)}, {d(2)}.{d(4)} {d(2)}", lambda: f"{stray()}: {d(4)}-{d(4)}-{d(3)}",
    ]
    amex = lambda: next(h + c for h in iter(lambda: "37" + d(12), None) for c in "0123456789" if luhn(h + c))
    cut = lambda c, s: f"{c[:4]}{s}{c[4:10]}{s}{c[10:]}"
    if family == "calibrate":
        positive = {
            0: [lambda: f"{name()}_{name()} [at] {name()} [dot] {rng.choice(ends)}", lambda: f"{name()}{d(2)}(at){name()}.{rng.choice(ends)}",
                lambda: f"{name()}-{name()} at {name()} dot co dot uk"],
            1: [lambda: octets("[.]").replace("[.]", ".", 1), lambda: octets(". "), lambda: octets(" .")],
            2: [lambda: grouped(card(), " -"), lambda: cut(amex(), " "), lambda: grouped(card(), "\t")],
            3: [lambda: f"0{d(2)}.{d(3)}.{d(4)}", lambda: f"({d(3)}) {d(3)}.{d(4)}", lambda: f"00{rng.randint(31, 49)}-{d(2)}-{d(3)}-{d(4)}",
                lambda: f"{rng.randint(2, 9)}{d(2)} {rng.randint(2, 9)}{d(2)}-{d(4)}"],
        }
        negative = {
            0: [lambda: f"{rng.choice(at_words)} at {name()}-{name()}.{rng.choice(ends)}", lambda: f"{name()} at {name()}.{name()}.{name()}", lambda: f"{d(3)} at {name()}.{rng.choice(ends)}"],
            1: [lambda: f"{rng.randint(256, 999)} . {d(2)} . {d(2)} . {d(2)}", lambda: f"{d(2)}. {d(2)}. {rng.randint(256, 999)}. {d(2)}"],
            2: [lambda: number(lambda: cut(d(15), " ")), lambda: number(lambda: grouped(d(16), " -")), lambda: f"{stray()} {number(lambda: d(14))}"],
            3: [lambda: f"{stray()} {d(3)}/{d(3)}/{d(4)}", lambda: f"{d(2)} {d(2)} {rng.randint(1900, 2030)}", lambda: f"{d(3)}.{d(3)}.{d(3)}", lambda: f"{stray()} no {d(3)} {d(4)}"],
        }
    elif family == "test":
        positive = {
            0: [lambda: f"{name()}.{name()}{d(1)} {{at}} {name()}.{rng.choice(ends)}", lambda: f"{name()}+{name()} (at) {name()} dot {rng.choice(ends)}"],
            1: [lambda: octets("(.)").replace("(.)", ".", 2), lambda: octets("[.]").replace("[.]", " . ", 1)],
            2: [lambda: grouped(card(), "  "), lambda: cut(amex(), "/"), lambda: grouped(card(), " .")],
            3: [lambda: f"+{rng.randint(1, 99)}.{d(3)}.{d(3)}.{d(4)}", lambda: f"({d(3)}){' '}{d(3)} {d(4)}", lambda: f"0{d(3)}/{d(3)}-{d(3)}"],
        }
        negative = {
            0: [lambda: f"{rng.choice(at_words)} @ {name()}.{rng.choice(ends)}", lambda: f"{d(1)} at {name()}.{name()}.{rng.choice(ends)}", lambda: f"{name()} at {name()}.{name().title()}"],
            1: [lambda: f"{rng.randint(256, 999)}(.){d(1)}(.){d(1)}(.){d(1)}"],
            2: [lambda: number(lambda: cut(d(15), "/")), lambda: number(lambda: grouped(d(16), "  "))],
            3: [lambda: f"{stray()} nr {d(3)} {d(3)} {d(3)}", lambda: f"{d(2)}.{d(2)}.{d(2)}", lambda: f"{stray()} {d(2)}-{d(3)}-{d(4)}", lambda: f"{d(3)}.{d(4)} {d(3)}.{d(4)}"],
        }
    x, y = [], []
    for label, made in ((1, positive), (0, negative)):
        for kind, forms in made.items():
            for k in range(n):
                form = forms[k % len(forms)]()
                near = rng.choice(_NEAR[kind]) if rng.random() < (0.6 if label else 0.1) else name()
                far = rng.choice(_FAR) if rng.random() < (0.02 if label else 0.5) else name()
                head = f"{filler()} {far} {near} " if rng.random() < 0.5 else f"{filler()} {near} {far} "
                text = head + form + " " + filler()
                found = [c for c in candidates(text) if c[0] == kind and c[1] < len(head) + len(form) and c[2] > len(head)]
                for c in found:
                    x.append(features(text, *c))
                    y.append(label)
    return np.array(x), np.array(y, float)


def _grow(x: np.ndarray, residual: np.ndarray, curve: np.ndarray, depth: int) -> tuple:
    """A regression tree: (feature, cut, left, right) or (value,)."""
    value = float(residual.sum() / (curve.sum() + 1.0))
    if depth == 0 or len(x) < 16:
        return (value,)
    best = (1e-6, -1, 0.0)
    own = residual.sum() ** 2 / (curve.sum() + 1.0)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        col, r, c = x[order, f], np.cumsum(residual[order]), np.cumsum(curve[order])
        at = np.flatnonzero(col[1:] > col[:-1])
        if not len(at):
            continue
        gain = r[at] ** 2 / (c[at] + 1.0) + (r[-1] - r[at]) ** 2 / (c[-1] - c[at] + 1.0) - own
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), f, float((col[at[k]] + col[at[k] + 1]) / 2))
    if best[1] < 0:
        return (value,)
    left = x[:, best[1]] <= best[2]
    return (
        best[1], best[2], _grow(x[left], residual[left], curve[left], depth - 1), _grow(x[~left], residual[~left], curve[~left], depth - 1)
    )


def _value(tree: tuple, row) -> float:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def train(rounds: int = 60, depth: int = 3, rate: float = 0.3, precision: float = 0.95) -> dict:
    """Boosted trees under log loss, and per kind the least threshold that has the
    wanted precision on templates kept apart, at that threshold and all above it
    (so one lucky cut doesn't count), and never below even odds; without one, the
    kind adds nothing."""
    x, y = _examples()
    out, trees = np.zeros(len(x)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-out))
        tree = _grow(x, y - p, p * (1 - p), depth)
        trees.append(tree)
        out += rate * np.array([_value(tree, r) for r in x])
    model = {"trees": trees, "rate": rate}
    apart, truth = _examples(seed=4, family="calibrate")
    p = np.array([probability(model, r) for r in apart])
    thresholds = []
    for kind in range(len(KINDS)):
        own, least = apart[:, 0] == kind, 2.0
        for c in np.arange(0.99, 0.495, -0.01):
            chosen = own & (p >= c)
            if chosen.any() and truth[chosen].mean() < precision:
                break
            least = float(c) if chosen.any() else least
        thresholds.append(round(least, 2))
    return model | {"thresholds": thresholds}


def figures(model: dict, family: str = "test", seed: int = 5) -> dict[str, tuple[float, float]]:
    """Precision and recall of each kind at its threshold, on candidates of a template family."""
    x, y = _examples(seed=seed, family=family)
    chosen = np.array([probability(model, r) for r in x]) >= np.array(model["thresholds"])[x[:, 0].astype(int)]
    out = {}
    for kind, name in enumerate(KINDS):
        own = x[:, 0] == kind
        hit = (chosen & own & (y == 1)).sum()
        out[name] = (float(hit / max((chosen & own).sum(), 1)), float(hit / max((own & (y == 1)).sum(), 1)))
    return out


def probability(model: dict, row) -> float:
    z = model["rate"] * sum(_value(t, row) for t in model["trees"])
    return 1 / (1 + np.exp(-z))


def find(text: str, model: dict | None) -> tuple[list, list]:
    """Base spans, and the spans that the trees add (never over a base span or another added one)."""
    base = base_spans(text)
    if model is None or not (found := candidates(text)):
        return base, []
    taken = bytearray(len(text))  # code points under a span: overlaps cost the length of a span, not their number
    for _, a, b in base:
        taken[a:b] = b"\1" * (b - a)
    scored = []
    for kind, a, b in found:
        if taken.find(1, a, b) < 0:
            p = probability(model, features(text, kind, a, b))
            if p >= model["thresholds"][kind]:
                scored.append((-p, kind, a, b))
    added: list[tuple[int, int, int]] = []
    for _, kind, a, b in sorted(scored):
        if taken.find(1, a, b) < 0:
            taken[a:b] = b"\1" * (b - a)
            added.append((kind, a, b))
    return base, added


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def detect(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of SCHEMA; the counts and ``base_sha256`` are those of the base spans."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            rows = []
            for text in filled(batch.column(1)):
                base, added = find(text.as_py(), model)
                counts = [sum(1 for s in base if s[0] == k) for k in range(4)]
                rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + added), len(added)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds[1:], strict=True))], names)

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(run, SCHEMA)


def redacted(text: str, spans) -> str:
    """The text with each run of overlapping spans replaced by the kind of its first one."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans of the texts replaced; a null text stays null."""

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = []
            for t in batch.column(at).to_pylist():
                if t:
                    base, added = find(t, model)
                    t = redacted(t, base + added) if base or added else t
                texts.append(t)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
