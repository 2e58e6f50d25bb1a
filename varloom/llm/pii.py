"""Personal data by weak supervision.

Exact patterns give the base spans. Looser patterns, and numbers inside matches that the exact
patterns had to drop, give further candidates. Labelers (patterns with check digits, gazetteers,
context, surroundings, shape) vote on every span; expectation-maximisation over the counts of all
vote patterns estimates how reliable each labeler is. Its soft labels train a logistic span
classifier on kind, votes, and features of the span and of what stands around it. Candidates that
it accepts are added; base spans always stay. Only counts by vote pattern and features reach the
driver, of which there are at most len(KINDS) * 3 ** len(LABELERS) * N_FEATURES whatever the input.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, written

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "email_text", "phone_local", "ssn", "iban", "name", "card_run", "phone_run")
LABELERS = ("pattern", "gazetteer", "context", "surroundings", "shape")
#: Features of a span and the number of their values.
FEATURES = {"length": 3, "digits": 3, "separators": 2, "before": 3, "after": 3, "capitals": 2}
N_FEATURES = math.prod(FEATURES.values())
#: A failed check is at most this many times as likely for personal data as for other spans, whatever the votes say.
FAILED_CHECK = 0.02

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the look-behind only keeps long digit runs linear: a start inside a run fails where the run's own start failed
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

DIGITS = re.compile("[0-9]+")
PHONE_RUN = re.compile(r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])")
EMAIL_TEXT = re.compile(r"\b[A-Za-z0-9._+-]{2,64}(?: ?[\[(]at[\])] ?| at )[A-Za-z0-9-]{2,64}(?: ?[\[(]dot[\])] ?| dot )[A-Za-z]{2,12}\b")
PHONE_LOCAL = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NAME = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Sr|Sra|Mme|Monsieur|Madame)\.? [A-Z][a-z]{2,20}(?: [A-Z][a-z]{2,20})?\b")

CUES = {
    "email": r"e-?mail|mail|contact|write|kontakt|correo|courriel",
    "phone": r"phone|call|tel|mobile|fax|telefon|anruf|t[eé]l[eé]fono|appel",
    "ip": r"\bip\b|address|host|server|from|adresse",
    "card": r"card|visa|credit|karte|tarjeta|carte",
    "ssn": r"ssn|social security|number|nummer",
    "iban": r"iban|account|konto|cuenta|compte",
    "name": r"name|dear|signed|von|from|by|para|pour",
}
CUES = {k: re.compile(v, re.I) for k, v in (CUES | {"email_text": CUES["email"], "phone_local": CUES["phone"], "phone_run": CUES["phone"], "card_run": CUES["card"]}).items()}
#: Common endings of addresses, and common given names.
ENDINGS = frozenset("com org net edu gov info io co de fr es uk eu at ch it nl".split())
NAMES = frozenset("james mary john linda robert anna michael maria peter laura hans julia pierre marie jose carmen juan thomas paul sophie".split())


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @: what stands before it as far as it may."""
    floor, at = 0, text.find("@")
    while at >= 0:
        before = text[floor:at]
        start = floor + len(before.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        floor = m.end() if m else at + 1
        at = text.find("@", floor)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def iban(span: str) -> bool:
    """Whether the check digits fit; a candidate without that is none."""
    flat = span.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Candidates whose check digits fit, each with the last end at a group's border that does so: a word behind may look like a group."""
    m = IBAN.search(text)
    while m:
        s, e = m.span()
        while e > s and not (IBAN.fullmatch(text, s, e) and iban(text[s:e])):
            e = text.rfind(" ", s, e)
        if e > s:
            yield s, e
        m = IBAN.search(text, e if e > s else s + 1)


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE_KINDS}
    if "@" in text:
        out["email"] = list(emails(text))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in m[0].split(".")):
                out["ip"].append(m.span())
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(m.span())
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    out["phone"].append(m.span())
    return out


def card_runs(text: str) -> Iterator[tuple[int, int]]:
    """Numbers of 13 to 19 digits in matches of CARD that don't check as a whole: from the left, the longest
    groups that check, else a group of such a length alone."""
    for m in CARD.finditer(text):
        if m.end() - m.start() < 13:
            continue
        groups = [(x.start(), x.end(), x[0]) for x in DIGITS.finditer(text, *m.span())]
        i = 0
        while i < len(groups):
            ends, digits, j = [], "", i
            while j < len(groups) and len(digits) + len(groups[j][2]) <= 19:
                digits += groups[j][2]
                if len(digits) >= 13:
                    ends.append((j, luhn(digits)))
                j += 1
            good = next((k for k, ok in reversed(ends) if ok), None)
            if good is None and ends and (ends[0][0] == i or len(ends) == 1 and i == 0 and j == len(groups)):
                good = ends[0][0]
            if good is None:
                i += 1
            else:
                yield groups[i][0], groups[good][1]
                i = good + 1


def more_spans(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """Looser candidates that don't overlap the base spans or each other."""
    # base spans of different kinds may overlap: what they cover
    held: list[tuple[int, int]] = []
    for s, e in sorted(taken):
        if held and s < held[-1][1]:
            held[-1] = held[-1][0], max(e, held[-1][1])
        else:
            held.append((s, e))
    digits = DIGIT.search(text) is not None
    spans = lambda pattern: (m.span() for m in pattern.finditer(text))
    for kind, found, needs in (
        ("email_text", spans(EMAIL_TEXT), " at " in text or "at]" in text or "at)" in text),
        ("ssn", spans(SSN), digits and "-" in text),
        ("iban", ibans(text), digits),
        ("phone_run", spans(PHONE_RUN), digits and "+" in text),
        ("card_run", card_runs(text), digits),
        ("phone_local", spans(PHONE_LOCAL), digits),
        ("name", spans(NAME), any(x in text for x in ("Mr", "Ms", "Dr", "Herr ", "Frau ", "Sr", "Mme", "Mons", "Madame"))),
    ):
        if needs:
            for s, e in found:
                at = bisect_left(held, (e, 0))  # all before it start before e
                if not at or held[at - 1][1] <= s:
                    insort(held, (s, e))
                    yield kind, s, e


def votes(kind: str, text: str, s: int, e: int) -> tuple[int, ...]:
    """Each labeler's vote: 1 for, -1 against, 0 none."""
    span = text[s:e]
    digits = "".join(filter(str.isdigit, span))
    low = span.lower()
    if kind == "iban":
        pattern = 1 if iban(span) else -1
    elif kind == "ssn":
        pattern = -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 1
    elif kind == "card_run":
        pattern = 1 if luhn(digits) else -1
    elif kind == "name":
        pattern = 0
    else:
        pattern = 1 if kind in BASE_KINDS or kind == "phone_run" and len(digits) <= 15 or kind == "phone_local" and digits[0] not in "01" and digits[3] not in "01" else 0
    if kind in ("email", "email_text"):
        gazetteer = 1 if re.split(r"[^a-z0-9]+", low)[-1] in ENDINGS else 0
    elif kind == "name":
        gazetteer = 1 if any(w in NAMES for w in low.replace(".", "").split()[1:]) else -1
    elif kind in ("card", "card_run"):
        gazetteer = 1 if digits[0] in "3456" or 2221 <= int(digits[:4]) <= 2720 else -1
    elif kind in ("phone", "phone_local", "phone_run"):
        gazetteer = 1 if digits[-7:-4] == "555" or kind != "phone_local" else 0
    else:
        gazetteer = 0
    context = 1 if CUES[kind].search(text[max(0, s - 32) : s]) else 0
    around = text[s - 1 : s] + text[e : e + 1]
    surroundings = -1 if any(c.isalnum() or c in "_/\\" for c in around) else 1
    shape = -1 if len(digits) > 4 and len(set(digits)) == 1 or kind == "ip" and digits.startswith("0") else 0
    return pattern, gazetteer, context, surroundings, shape


def features_of(text: str, s: int, e: int) -> tuple[int, ...]:
    """Values of FEATURES: classes of the span's length and share of digits, whether it has separators, what
    stands before and after it (nothing or a mark, letter, digit), whether the word before is in capitals."""
    span = text[s:e]
    digits = sum(map(str.isdigit, span))
    seen = lambda x: 0 if not x else 1 if x[0].isalpha() else 2 if x[0].isdigit() else 0
    before, after = text[max(0, s - 24) : s].rstrip(), text[e : e + 2].lstrip()
    word = before.rsplit(None, 1)[-1] if before else ""
    return (e - s > 12) + (e - s > 20), (2 * digits >= e - s) + (digits == e - s), int(any(not c.isalnum() for c in span)), seen(before[-1:]), seen(after[:1]), int(len(word) > 1 and word.isupper())


def code(kind: str, vote: tuple[int, ...], features: tuple[int, ...] = (0,) * len(FEATURES)) -> int:
    out = KINDS.index(kind)
    for v in vote:
        out = out * 3 + v + 1
    for v, n in zip(features, FEATURES.values()):
        out = out * n + v
    return out


def decode(c: int) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
    """Kind, votes and features."""
    features, vote = [], []
    for n in reversed(FEATURES.values()):
        c, v = divmod(c, n)
        features.append(v)
    for _ in LABELERS:
        c, v = divmod(c, 3)
        vote.append(v - 1)
    return c, tuple(reversed(vote)), tuple(reversed(features))


def reliabilities(codes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Soft labels of the codes, and p(vote | label) as [labeler, label, vote], by EM on kinds and votes."""
    patterns, of = np.unique(codes // N_FEATURES, return_inverse=True)
    counts = np.bincount(of, counts, len(patterns))
    decoded = [decode(int(c) * N_FEATURES) for c in patterns]
    kinds = np.array([d[0] for d in decoded])
    vote = np.array([d[1] for d in decoded]) + 1
    table = np.tile(np.array([[0.45, 0.35, 0.2], [0.1, 0.4, 0.5]]), (len(LABELERS), 1, 1))
    trust = table * 20  # pseudo-counts: labelers are better than chance
    prior = np.full(len(KINDS), 0.5)
    for _ in range(rounds):
        like = np.log(np.stack([1 - prior[kinds], prior[kinds]], 1))
        for j in range(len(LABELERS)):
            like += np.log(table[j][:, vote[:, j]].T)
        soft = 1 / (1 + np.exp(np.clip(like[:, 0] - like[:, 1], -60, 60)))
        for j in range(len(LABELERS)):
            for label, w in ((0, (1 - soft) * counts), (1, soft * counts)):
                got = trust[j, label] + np.bincount(vote[:, j], w, 3)
                table[j, label] = got / got.sum()
        most = FAILED_CHECK * table[0, 0, 0]  # the pattern's vote against
        if table[0, 1, 0] > most:
            table[0, 1] *= (1 - most) / (1 - table[0, 1, 0])
            table[0, 1, 0] = most
        prior = (2 + np.bincount(kinds, soft * counts, len(KINDS))) / (4 + np.bincount(kinds, counts, len(KINDS)))
    return soft[of], table


def features(codes: np.ndarray) -> np.ndarray:
    """Kind, each labeler's vote and each feature's value, one-hot."""
    sizes = [len(KINDS), *[3] * len(LABELERS), *FEATURES.values()]
    starts = np.cumsum([0, *sizes])
    out = np.zeros((len(codes), starts[-1]))
    for i, c in enumerate(codes):
        kind, vote, values = decode(int(c))
        out[i, starts[:-1] + np.array([kind, *[v + 1 for v in vote], *values])] = 1
    return out


def classifier(x: np.ndarray, soft: np.ndarray, counts: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (counts * (p - soft)) + ridge * w
        hess = (x * (counts * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return w


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.int32()), ("s", pa.int64()), ("e", pa.int64()), ("code", pa.int32())])
    for b in batches:
        cols: list[list] = [[] for _ in range(6)]
        for text in b.column(1):
            text = text.as_py() or ""
            base = base_spans(text)
            named = [(k, s, e) for k in BASE_KINDS for s, e in base[k]]
            extra = list(more_spans(text, [(s, e) for _, s, e in named]))
            joined = ",".join(f"{k}:{s}:{e}" for k, s, e in named)
            for c, v in zip(cols, (*(len(base[k]) for k in BASE_KINDS), hashlib.sha256(joined.encode()).hexdigest(), [{"kind": KINDS.index(k), "s": s, "e": e, "code": code(k, votes(k, text, s, e), features_of(text, s, e))} for k, s, e in named + extra])):
                c.append(v)
        yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4]), pa.array(cols[5], pa.list_(span))], ["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "found"])


def found(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """A row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans.

    spans: kind:start:end in code points, end exclusive, by KINDS then start, comma-joined; the
    candidates with a classifier score of least or more are among them. Null text counts as
    empty. Null doc_ids and repeated rows are kept as they are; no rows give no rows.
    """
    spark = docs.sparkSession
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, found array<struct<kind:int,s:long,e:long,code:int>>"
    scanned = written(spark, rows.mapInArrow(lean(_scan), schema), "pii")
    patterns = sorted(tuple(r) for r in scanned.select(F.explode("found.code").alias("code")).groupBy("code").count().collect())
    accepted: list[int] = []
    if patterns:
        codes, counts = np.array([p[0] for p in patterns]), np.array([p[1] for p in patterns], float)
        soft, _ = reliabilities(codes, counts)
        x = features(codes)
        score = 1 / (1 + np.exp(-np.clip(x @ classifier(x, soft, counts), -30, 30)))
        accepted = [int(c) for c, p in zip(codes, score) if p >= least]
    keep = F.array(*[F.lit(c).cast("int") for c in accepted]) if accepted else F.array().cast("array<int>")
    names = F.array(*map(F.lit, KINDS))
    stay = F.array_sort(F.filter("found", lambda f: (f["kind"] < len(BASE_KINDS)) | F.array_contains(keep, f["code"])))
    text = F.transform(stay, lambda f: F.concat_ws(":", F.element_at(names, f["kind"] + 1), f["s"].cast("string"), f["e"].cast("string")))
    return scanned.select("doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", F.array_join(text, ",").alias("spans"), F.size(stay).cast("long").alias("n_spans"))
