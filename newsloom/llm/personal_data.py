"""Personal data in texts: fixed patterns, and spans found by weak supervision.

Four kinds follow fixed patterns with checks (the base spans). Further spans come
from loose candidates. Labelers vote on each candidate: for, against or not at
all. Regular expressions look at its form, gazetteers at its parts, context
labelers at what stands around it. How often each combination of votes occurs
is counted over all texts; expectation-maximisation estimates from these counts
alone how reliable each labeler is and how likely each combination is personal
data. On these likelihoods a logistic classifier is trained, which sees votes and
form together and decides every span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import texts, tidy

# The base kinds in their order, and their patterns.
BASE = ("email", "ip", "card", "phone")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A start inside a run of digits fails where its beginning failed: skipping it keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Kinds that the method adds, after the base kinds in the order of spans.
ADDED = ("contact", "handle", "number", "secret")
KINDS = BASE + ADDED
CONTACT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+"
    r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}+)+"
)
HANDLE = re.compile(r"(?<![A-Za-z0-9._%+@-])@[A-Za-z0-9_]{3,30}+(?![A-Za-z0-9@.-])")
NUMBER = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ ./-]?[0-9]){8,}+")
SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]{0,40}[0-9])[A-Za-z0-9+/_=-]{24,}+")
DIGIT = re.compile(r"[0-9]")

# Gazetteers and context words of the labelers.
TOP_DOMAINS = frozenset("com org net edu gov info io de fr es it pt br uk eu us".split())
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35")
NEAR_WORDS = re.compile(
    r"(?i)\b(?:phone|tel|call|fax|mobile|mail|email|contact|card|visa|account|iban|ssn|passport|id|"
    r"token|secret|password|key|user|ip|host|address)\b[^A-Za-z]{0,4}\Z"
)
FAR_WORDS = re.compile(r"(?i)\b(?:version|license|licence|page|isbn|chapter|section|v|no|figure|rev)\b[^A-Za-z]{0,4}\Z")
LABELERS = ("form", "checksum", "gazetteer", "context", "border")
#: Characters before a span that context labelers read.
BEFORE = 24


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As ``[A-Za-z0-9._%+-]+@`` and the domain, leftmost first, without trying each start."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) in order."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() < 12:
                continue
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(DIGIT.findall(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def _candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Loose spans that touch no base span."""
    found = []
    if "@" in text:
        found += [(m.start(), 5, m.end()) for m in HANDLE.finditer(text)]
    if "at)" in text or "at]" in text:
        found += [(m.start(), 4, m.end()) for m in CONTACT.finditer(text)]
    if DIGIT.search(text):
        found += [(m.start(), 6, m.end()) for m in NUMBER.finditer(text)]
        found += [(m.start(), 7, m.end()) for m in SECRET.finditer(text)]
    found.sort()
    free, k = [], 0
    for a, kind, b in found:
        while k < len(base) and base[k][2] <= a:
            k += 1
        if all(x >= b or y <= a for x, _, y in base[k : k + 8]):
            free.append((a, kind, b))
    return free


def _votes(text: str, a: int, kind: int, b: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """What the labelers say (1, 0, -1), and the span's form as small integers."""
    span, before = text[a:b], text[max(0, a - BEFORE) : a]
    digits = sum(c.isdigit() for c in span)
    letters = sum(c.isalpha() for c in span)
    name = KINDS[kind]
    if name == "secret":
        form = 1 if digits >= 4 and letters >= 4 and len(span) >= 32 else 0 if digits and letters else -1
        plain = re.fullmatch("[0-9a-f]+|[0-9A-F]+", span)
        check = 1 if plain and len(span) in (32, 40, 64) else 0
        known = 1 if span[:3] in ("sk-", "ghp", "AKI", "eyJ", "xox") else 0
    elif name == "number":
        only = re.sub("[^0-9]", "", span)
        form = 1 if len(only) in (9, 10, 11, 12, 16) else 0
        check = (1 if luhn(only) else -1) if 12 <= len(only) <= 19 else 0
        known = (1 if only.startswith(ISSUERS) else -1) if len(only) == 16 else 0
    elif name == "handle":
        form, check = (1 if letters >= 3 else -1), 0
        known = -1 if span[1:].lower() in ("media", "import", "param", "return", "override") else 0
    else:
        form, check = 1, 0
        known = 1 if re.split("[^A-Za-z0-9]+", span.rstrip(")]"))[-1].lower() in TOP_DOMAINS else -1
    context = 1 if NEAR_WORDS.search(before) else -1 if FAR_WORDS.search(before) else 0
    after = text[b : b + 1]
    border = 1 if before[-1:] in ('"', "'", "=", ":", "(", "<") or after in ('"', "'", ")", ">") else 0
    if after.isalnum() or before[-1:] in ("#", ".", "/"):
        border = -1
    shape = (min(len(span) // 8, 7), int(digits * 4 / max(1, digits + letters)), int(any(c in " ./-" for c in span)))
    return (form, check, known, context, border), shape


def vote_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of each combination (kind, votes, form) over all texts; bounded by the combinations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        for batch in batches:
            counts: Counter = Counter()
            for text in texts(batch, "text"):
                for a, kind, b in _candidates(text, base_spans(text)):
                    votes, shape = _votes(text, a, kind, b)
                    counts[kind, *votes, *shape] += 1
            keys = [list(k) for k in counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.list_(pa.int32())), pa.array(list(counts.values()), pa.int64())],
                ["key", "n"],
            )

    counted = docs.select("text").mapInArrow(tidy(run), "key array<int>, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def reliabilities(votes, kinds, counts, rounds: int = 60):
    """Expectation-maximisation: likelihood of each combination, and P(vote | truth) per labeler.

    Starts from the majority of votes. Priors are per kind; small pseudo-counts
    keep every probability off 0 and 1.
    """
    import numpy as np

    balance = votes.sum(axis=1)
    truth = 1 / (1 + np.exp(-1.5 * balance))
    tables = None
    for _ in range(rounds):
        prior = np.zeros(len(truth))
        for kind in np.unique(kinds):
            own = kinds == kind
            share = (counts[own] @ truth[own] + 1) / (counts[own].sum() + 2)
            prior[own] = np.log(share) - np.log1p(-share)
        tables = np.empty((votes.shape[1], 3, 2))
        for k in range(votes.shape[1]):
            for v in (-1, 0, 1):
                own = votes[:, k] == v
                # More weight in advance on votes that agree with the truth.
                tables[k, v + 1, 1] = counts[own] @ truth[own] + (1 + v) * 1.0 + 0.5
                tables[k, v + 1, 0] = counts[own] @ (1 - truth[own]) + (1 - v) * 1.0 + 0.5
        tables /= tables.sum(axis=1, keepdims=True)
        odds = prior.copy()
        for k in range(votes.shape[1]):
            odds += np.log(tables[k, votes[:, k] + 1, 1] / tables[k, votes[:, k] + 1, 0])
        truth = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return truth, tables


def _features(key: tuple[int, ...]) -> list[float]:
    """Kind, votes and form of a combination as numbers."""
    kind, *rest = key
    votes, shape = rest[: len(LABELERS)], rest[len(LABELERS) :]
    row = [float(KINDS[kind] == k) for k in ADDED]
    for v in votes:
        row += [float(v == 1), float(v == -1)]
    return row + [shape[0] / 7, shape[1] / 4, float(shape[2])]


def train(docs: DataFrame) -> list[float]:
    """Weights of the span classifier, from the counts of all texts; none if there are no candidates."""
    import numpy as np

    rows = vote_counts(docs).collect()
    if not rows:
        return []
    rows.sort(key=lambda r: tuple(r["key"]))
    keys = np.array([r["key"] for r in rows])
    counts = np.array([r["n"] for r in rows], dtype=float)
    truth, _ = reliabilities(keys[:, 1 : 1 + len(LABELERS)], keys[:, 0], counts)
    x = np.array([_features(tuple(k)) for k in keys.tolist()])
    share = counts / counts.sum()
    weights = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps of a ridge-penalised logistic regression on soft labels
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (share * (p - truth)) + 1e-4 * weights
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(x.shape[1])
        weights = weights - np.linalg.solve(bend, slope)
    return weights.tolist()


def _spans(text: str, weights: list[float], known: dict) -> tuple[list, list]:
    """Base spans, and all spans, of one text."""
    base = base_spans(text)
    added = []
    for a, kind, b in _candidates(text, base) if weights else []:
        votes, shape = _votes(text, a, kind, b)
        key = (kind, *votes, *shape)
        if key not in known:
            known[key] = sum(w * f for w, f in zip(weights, _features(key))) >= 0
        if known[key] and not (added and added[-1][2] > a):
            added.append((a, kind, b))
    return base, sorted(base + added)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def find(docs: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """(doc_id, text) -> doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and digest are of the base spans. ``spans`` lists all as
    kind:start:end in code points, by start and then by kind. Null and empty
    texts have no spans; rows are independent, so repeated rows and null ids
    come out as they went in. Without given weights these are trained first.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    weights = train(docs) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        known: dict = {}
        for batch in batches:
            counts: list[list[int]] = [[] for _ in BASE]
            hashes, written = [], []
            for text in texts(batch, "text"):
                base, spans = _spans(text, weights, known)
                for k, column in enumerate(counts):
                    column.append(sum(kind == k for _, kind, _ in base))
                hashes.append(hashlib.sha256(_written(base).encode()).hexdigest())
                written.append(_written(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(written, pa.string())],
                ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"],
            )

    return docs.mapInArrow(
        tidy(run), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )


def redacted(docs: DataFrame, text: str = "text", weights: list[float] | None = None) -> DataFrame:
    """All rows and columns, with each span of the text replaced by its kind in brackets; null stays null."""
    if weights is None:
        weights = train(docs.select(F.col(text).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            place = batch.schema.get_field_index(text)
            found = []
            for value in batch.column(place).to_pylist():
                if value is None:
                    found.append(None)
                    continue
                pieces, end = [], 0
                for a, kind, b in _spans(value, weights, known)[1]:
                    if a >= end:
                        pieces += [value[end:a], f"[{KINDS[kind].upper()}]"]
                    end = max(end, b)
                found.append("".join([*pieces, value[end:]]))
            yield batch.set_column(place, text, pa.array(found, batch.schema.field(place).type))

    return docs.mapInArrow(tidy(run), docs.schema)
