"""Personal data by weak-supervision aggregation.

*Base spans.* Four strict patterns (e-mail, IPv4, card number with Luhn check,
international phone number) give the base spans, leftmost and non-overlapping
per kind; what fails its check is dropped.

*Added spans.* Looser candidates (obfuscated e-mail addresses, IPv4 with
spaced dots, card numbers with other separators, phone numbers without a plus
sign) that overlap no base span are judged together with the base spans by
five labelers, each of which votes yes, no or abstains: the strict pattern,
the shape of the span, a gazetteer (mail domains, address ranges, card
prefixes, calling codes), a cue word before the span and the text around it.
One pass writes all candidates with votes and features of the span and its
context (digits, separators, brackets, what stands right before and after,
digits around). Their counts by kind, votes and features (a bounded number of
patterns, whatever the corpus) go to the driver, where expectation-maximisation
estimates the labelers' reliabilities and the share of true spans among the
looser ones per kind. The strict labeler tells base spans from the others by
construction, so it is no evidence against a looser span: base spans count as
true, and the other labelers judge the rest. The posteriors of the patterns are
the soft labels on which the final span classifier (a logistic regression on
the features and the other labelers' votes, per kind) is trained. Candidates it
gives ``ADD_AT`` or more are added, non-overlapping and leftmost first; base
spans always stay.

Offsets count code points, ends are exclusive.

Cases: null and empty texts have no spans; spans of several kinds may overlap
(each kind is searched for itself), added spans overlap nothing; long texts are
scanned in linear time (an e-mail search starts at its "@", digit runs are
consumed whole); repeated rows get the same spans each and count as often as
they occur; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, sha256_hex

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "shape", "gazetteer", "cue", "around")
FEATURES = ("digits", "separators", "brackets", "left", "right", "crowd")
ADD_AT = 0.9
ROUNDS = 50
_PRIOR = np.array([[8.0, 10.0, 2.0], [2.0, 10.0, 8.0]])     # [class, vote + 1]
_AROUND = 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

_LOOSE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\[at\]|\(at\)| at |@) ?"
                        r"[A-Za-z0-9-]{1,63}+(?: ?(?:\[dot\]|\(dot\)| dot |\.) ?[A-Za-z0-9-]{2,24}+){1,4}"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}+(?: ?(?:\[\.\]|\.) ?[0-9]{1,3}+){3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ ._/-]{1,2}[0-9]{4}){2}[ ._/-]{1,2}[0-9]{1,7}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\(0?[0-9]{2,4}\)|0?[0-9]{2,4})[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])"),
}
# Short gazetteers and cue words.
_MAIL_ENDS = (".com", ".org", ".net", ".edu", ".gov", ".de", ".fr", ".es", ".uk", ".io", ".example")
_CALLING = ("1", "33", "34", "39", "44", "49", "7", "81", "86", "91")
_CUES = {"email": re.compile(r"(?i)e-?mail|contact|write to|reach|kontakt|correo|courriel"),
         "ip": re.compile(r"(?i)\bip\b|address|host|server|adresse|servidor"),
         "card": re.compile(r"(?i)card|visa|master|credit|karte|carte|tarjeta"),
         "phone": re.compile(r"(?i)phone|\btel|call|mobile|fax|telefon|anruf|llam")}
_WORSE = re.compile(r"(?i)version|isbn|issn|license|release|section|page|\$|€|%")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches: the local part is the whole run of its
    characters before an "@", from the end of the last match on."""
    spans, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            spans.append((start, found.end()))
            done = found.end()
        else:
            done = max(done, at)     # the run before this "@" cannot be part of a later match
        at = text.find("@", max(at + 1, done))
    return spans


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    spans = {"email": emails(text) if "@" in text else [], "ip": [], "card": [], "phone": []}
    if _DIGITS.search(text):
        spans["ip"] = [m.span() for m in _IP.finditer(text)
                       if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split(".")))]
        for m in _CARD.finditer(text):
            if 13 <= m.end() - m.start() <= 40:
                digits = re.sub("[^0-9]", "", m[0])
                if 13 <= len(digits) <= 19 and luhn(digits):
                    spans["card"].append(m.span())
        if "+" in text:
            spans["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]
    return spans


# -------------------------------------------------------------------- labelers

def votes(text: str, kind: str, start: int, end: int, strict: bool) -> list[int]:
    """1 yes, -1 no, 0 no opinion, in the order of LABELERS."""
    span = text[start:end]
    digits = "".join(c for c in span if "0" <= c <= "9")
    before, after = text[max(0, start - _AROUND):start], text[end:end + _AROUND]
    if kind == "email":
        # "look at example.com" is half a sentence: a bare "at" needs a spelled dot
        bare = " at " in span and "dot" not in span
        shape = 1 if re.search(r"[A-Za-z]", span) and re.search(r"[A-Za-z]{2,}$", span) and not bare else -1
        known = 1 if span.lower().replace(" dot ", ".").endswith(_MAIL_ENDS) else 0
    elif kind == "ip":
        parts = [p for p in re.split(r"[^0-9]+", span) if p]
        shape = 1 if len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) else -1
        known = -1 if span.startswith(("0", "127.")) else 0
    elif kind == "card":
        shape = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        known = 1 if digits[:1] in "3456" and digits[:1] else -1
    else:
        shape = 1 if 9 <= len(digits) <= 15 else -1
        # national numbers have a bracketed or zero-led area code in place of the calling code
        known = 1 if (digits.startswith(_CALLING) if span.startswith("+") else span.startswith(("(", "0"))) else 0
    cue = 1 if _CUES[kind].search(before) else 0
    near = -1 if _WORSE.search(before[-12:]) or _WORSE.search(after[:3]) or re.match(r"[0-9]|[.,][0-9]", after) else 0
    return [1 if strict else -1, shape, known, cue, near]


def features(text: str, kind: str, start: int, end: int) -> list[int]:
    """What the classifier sees of the span and its context, 1, 0 or -1 each,
    in the order of FEATURES."""
    span = text[start:end]
    before, after = text[max(0, start - _AROUND):start], text[end:end + _AROUND]
    n = sum("0" <= c <= "9" for c in span)
    if kind == "email":
        digits = 1 if n == 0 else 0 if n <= 4 else -1
    elif kind == "ip":
        digits = -1 if re.search(r"(?<![0-9])0[0-9]", span) else 1
    elif kind == "card":
        digits = 1 if n == 16 else 0 if 13 <= n <= 19 else -1
    else:
        digits = 1 if 10 <= n <= 12 else 0 if 9 <= n <= 15 else -1
    marks = {c for c in span if not c.isalnum() and c not in "()[]+@"}
    separators = 0 if not marks else 1 if len(marks) == 1 else -1
    brackets = 1 if "(" in span or "[" in span else 0
    left = 1 if re.search(r"[:#=]\s*$", before) else -1 if before and not before[-1].isspace() else 0
    right = 1 if re.match(r"[.,;:!?)\"']*(\s|$)", after) else -1
    around = len(_DIGITS.findall(before)) + len(_DIGITS.findall(after))
    return [digits, separators, brackets, left, right, 1 if not around else 0 if around <= 8 else -1]


def _union(spans) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint stretches that the spans cover, in order."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def candidates(text: str) -> tuple[dict, list[tuple]]:
    """Base spans, and (kind, start, end, strict, votes, features) for them and
    for the looser candidates that overlap none of them."""
    base = base_spans(text)
    rows = [(k, a, b, True, votes(text, k, a, b, True), features(text, k, a, b)) for k in KINDS for a, b in base[k]]
    starts, ends = _union(s for spans in base.values() for s in spans)
    for kind, pattern in _LOOSE.items():
        if kind == "email" and not ("@" in text or "at)" in text or "at]" in text or " at " in text):
            continue
        if kind == "email" and not ("dot" in text or "@" in text):
            continue
        for m in pattern.finditer(text):
            a, b = m.span()
            at = bisect_left(starts, b)          # the last stretch that starts before the span's end
            if not at or ends[at - 1] <= a:
                rows.append((kind, a, b, False, votes(text, kind, a, b, False), features(text, kind, a, b)))
    return base, rows


def _joined(rows) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(rows, key=lambda r: (KINDS.index(r[0]), r[1], r[2])))


_FOUND = ("doc_id {}, n_email long, n_ip long, n_card long, n_phone long, base string, "
          "found array<struct<kind:string,start:long,end:long,strict:boolean,votes:array<int>,features:array<int>>>")
_FOUND_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("strict", pa.bool_()), ("votes", pa.list_(pa.int32())),
                                  ("features", pa.list_(pa.int32()))]))


def find(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts and spans of the base patterns, all candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base_text, found = [[], [], [], []], [], []
            for text in batch.column(1).to_pylist():
                base, rows = candidates(text or "")
                for k, c in zip(KINDS, counts):
                    c.append(len(base[k]))
                base_text.append(_joined((k, a, b) for k in KINDS for a, b in base[k]))
                found.append([dict(zip(("kind", "start", "end", "strict", "votes", "features"), r)) for r in rows])
            columns = [*(pa.array(c, pa.int64()) for c in counts), pa.array(base_text, pa.string()),
                       pa.array(found, _FOUND_TYPE)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[
                "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "found"])

    narrow = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, _FOUND.format(narrow.schema[0].dataType.simpleString()))


# ------------------------------------------------------- aggregation of votes

def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation on vote patterns (rows of -1, 0, 1) with their
    counts: (share of true spans, P(vote | class) as [class, labeler, vote + 1],
    posterior per pattern). Labelers are taken as independent given the class;
    the start leans on the majority of the votes. One pseudo count a cell."""
    post = 1 / (1 + np.exp(-patterns.sum(1).astype(float)))
    table = np.empty((2, patterns.shape[1], 3))
    share = 0.5
    for _ in range(rounds):
        weight = np.stack([counts * (1 - post), counts * post])
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        for v in (-1, 0, 1):
            table[:, :, v + 1] = weight @ (patterns == v) + 1
        table /= table.sum(2, keepdims=True)
        logs = np.log(table)
        j = np.arange(patterns.shape[1])
        odds = np.log(share / (1 - share)) + (logs[1][j, patterns + 1] - logs[0][j, patterns + 1]).sum(1)
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return share, table, post


def estimate_loose(patterns: np.ndarray, counts: np.ndarray, strict: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Posterior per pattern of the labelers other than the strict one. Strict
    patterns are true; the share of true ones is that of the others, and the
    labelers' tables are common to both. ``_PRIOR`` pseudo counts a cell say
    that a labeler is right more often than wrong."""
    post = np.where(strict, 1.0, 1 / (1 + np.exp(-patterns.sum(1).astype(float))))
    j = np.arange(patterns.shape[1])
    for _ in range(rounds):
        weight = np.stack([counts * (1 - post), counts * post])
        loose = weight[:, ~strict].sum(1)
        share = (loose[1] + 1) / (loose.sum() + 2)
        table = np.stack([weight @ (patterns == v) + _PRIOR[:, v + 1:v + 2] for v in (-1, 0, 1)], 2)
        logs = np.log(table / table.sum(2, keepdims=True))
        odds = np.log(share / (1 - share)) + (logs[1][j, patterns + 1] - logs[0][j, patterns + 1]).sum(1)
        post = np.where(strict, 1.0, 1 / (1 + np.exp(-np.clip(odds, -30, 30))))
    return post


def fit_classifier(patterns: np.ndarray, counts: np.ndarray, post: np.ndarray, steps: int = 30) -> np.ndarray:
    """Logistic regression of the soft labels on yes and no votes (or features
    of 1 and -1); intercept last."""
    x = np.hstack([patterns == 1, patterns == -1, np.ones((len(patterns), 1))]).astype(float)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (counts * (p - post)) + 0.1 * w
        hessian = (x * (counts * (p * (1 - p) + 1e-9))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(hessian, gradient)
    return w


def train(found: DataFrame) -> dict[str, list[float]]:
    """Classifier weights per kind from the counts of all patterns."""
    span = F.explode("found").alias("s")
    counted = (found.select(span).groupBy(*(F.col(f"s.{c}").alias(c) for c in ("kind", "votes", "features")))
               .agg(F.count(F.lit(1)).alias("n")).collect())    # bounded by the patterns, whatever the corpus
    weights = {}
    for kind in KINDS:
        rows = sorted((r["votes"], r["features"], r["n"]) for r in counted if r["kind"] == kind)
        if rows:
            voted, seen, counts = (np.array(c) for c in zip(*rows))
            post = estimate_loose(voted[:, 1:], counts.astype(float), voted[:, 0] == 1)
            weights[kind] = fit_classifier(np.hstack([voted[:, 1:], seen]), counts.astype(float), post).tolist()
    return weights


def probability(weights: list[float], vote: list[int]) -> float:
    n = len(vote)
    z = weights[2 * n] + sum(weights[i] if v == 1 else weights[n + i] if v == -1 else 0.0 for i, v in enumerate(vote))
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def detect(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", add_at: float = ADD_AT) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256 and spans (base and added, kind:start:end joined by commas)."""
    found = materialise(find(docs, doc_col=doc_col, text_col=text_col), "pii-candidates")
    weights = train(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sha, spans = [], []
            for base, rows in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist()):
                kept = [(r["kind"], r["start"], r["end"]) for r in rows if r["strict"]]
                end = -1
                for r in sorted((r for r in rows if not r["strict"]), key=lambda r: (r["start"], -r["end"])):
                    if r["start"] >= end and probability(weights[r["kind"]], r["votes"][1:] + r["features"]) >= add_at:
                        kept.append((r["kind"], r["start"], r["end"]))
                        end = r["end"]
                sha.append(sha256_hex(base.encode()))
                spans.append(_joined(kept))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sha, pa.string()), pa.array(spans, pa.string())],
                                             names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    kind = found.schema[0].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                                 "base_sha256 string, spans string")
