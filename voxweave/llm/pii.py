"""Personal data and secrets: weak labelers, expectation-maximisation, a span classifier, redaction.

``train(docs)`` gives a model; ``find(docs, model)`` gives (doc_id, start, length, kind,
score), offsets in characters, of every span found; ``redact(docs, model)`` gives the rows of
docs with each span replaced by ``[KIND]``.

Candidates: spans of the text that look like e-mail addresses, IPv4 addresses, phone numbers,
payment cards, keys and secrets, taken widely (any dotted quad, any 13 to 19 digits, ...), one
kind to a span; phone numbers compact or in groups of two digits too, quoted names of keys, bearer
tokens and keys by their vendors' prefixes; of overlapping ones, the first in the order of KINDS.

Labelers vote yes, no or nothing on each candidate, by three sorts of evidence: strict regular
expressions and checksums (octets within 255, Luhn, digit counts, a mix of letters and digits),
gazetteers (mail domains, dialling codes, key prefixes, reserved addresses and test ranges) and
context (a cue word before, what stands on either side, digits all alike).

Expectation-maximisation, for each kind, finds each labeler's reliability and the share of true
spans from the counts of vote patterns alone; counts over all documents are made by Spark, and
the driver holds one row for each pattern that occurs, at most 3^labelers a kind however large
the corpus. A logistic classifier of the span is fitted to the probabilities that result: its features are the span's shape (length, shares of digits, letters, capitals
and distinct characters, which signs it has, how it begins and ends), its surroundings (what stands on either side, the two words before, hashed) and the labelers' findings.
It is fitted to a bounded sample: about ``sample_spans`` candidates of each kind, drawn from all documents by a hash, and to variants of VARIED_SPANS of them
(other digits, one digit throughout, a number out of range, a shorter span, letters at its side, another word before), of which the labelers and their estimated reliabilities say what they are:
so it has seen spans that the corpus doesn't hold. No span is labelled by hand. A span is found where its score is ``threshold`` or more.

Defined cases. Null text: no spans, stays null. Empty text: no spans. Very long texts are searched whole. Repeated rows are treated
row by row; null doc_id is kept. Ties: of overlapping candidates of one kind the first; scores at the threshold are found. Without any candidate, as in an empty table, the model is empty and finds nothing.
Only doc_id and text are read, so other columns can't clash; redaction leaves all columns but text and, where present, n_chars.
"""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import keyed, map_batches

THRESHOLD, ROUNDS, SAMPLE_SPANS, VARIED_SPANS = 0.5, 60, 500, 100
KINDS = ("SECRET", "EMAIL", "CARD", "PHONE", "IP")

_CANDIDATE = re.compile(
    r"(?P<SECRET>(?<![A-Za-z])(?:auth(?:orization)?[\"']?\s*[=:]\s*[\"']?)?bearer\s+[A-Za-z0-9._~+/=-]{8,}|(?:(?<![A-Za-z])(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key|auth)[\"']?\s*[=:]\s*\"?[^\s\"]{6,}\"?)|(?<![A-Za-z0-9])(?-i:(?:gh[pousr]|github_pat|glpat|xox[abprs]|sk|pk|rk)[_-][A-Za-z0-9_-]{10,}|AIza[A-Za-z0-9_-]{20,})|(?<![A-Za-z0-9])(?-i:[A-Z]{4}[A-Z0-9]{16})(?![A-Za-z0-9]))"
    r"|(?P<EMAIL>[A-Za-z0-9À-ɏ._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*)"
    r"|(?P<IP>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d))"
    r"|(?P<CARD>(?<![\d+])(?:\d{13,19}|\d{4}(?P<sep>[ -])\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d))"
    r"|(?P<PHONE>(?<![\d.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)|(?<![\d.])(?:\+\d{7,15}|\+\d{1,3}(?:[ .-]?\(?\d{1,5}\)?){1,2}(?:[ .-]\d{2,8}){1,4}|0\d(?:[ .-]\d{2}){4}|\(\d{2,5}\)[ .-]?\d{3,4}[ .-]?\d{3,5}|\d{9,12})(?!\d))",
    re.I,
)
_PREFILTER = r"[0-9]{3}|[0-9][ .)-]+[0-9]|@|(?i:passw|pwd|token|secret|api.?key|access.?key|auth|bearer)|[A-Z]{4}[A-Z0-9]{16}|gh[pousr][_-]|github_pat|glpat|xox[abprs]|[spr]k[_-]|AIza"
_CUES = {
    "EMAIL": re.compile(r"(?:mail|contact|write|correo|kontakt|courriel)\W*$", re.I),
    "PHONE": re.compile(r"(?:phone|tel|call|mobile|fax|llama|telefon|appel)\w*\W*$", re.I),
    "CARD": re.compile(r"(?:card|visa|master|amex|pay|tarjeta|karte|carte)\w*\W*$", re.I),
    "IP": re.compile(r"(?:ip|host|address|server|from|addr)\W*$", re.I),
    "SECRET": re.compile(r"(?:key|secret|credential|aws|login|pass)\w*\W*$", re.I),
}
_NOT = re.compile(r"(?:version|section|chapter|isbn|ver|v|no|page|figure)\.?\s*$", re.I)
_DOMAINS = frozenset("com net org edu gov io de fr es it uk eu info biz mx us ca co dev app me".split())
_CARD_STARTS = re.compile(r"(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35|30|36|38)")
_KEY_STARTS = re.compile(r"(?:AKIA|ASIA|AIDA|AROA|AGPA|gh[pousr]_|github_pat_|glpat-|xox[abprs]-|[spr]k[_-]|AIza)|(?i:authorization|bearer|password|passwd|pwd|token|secret|api|access)")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return bool(digits) and total % 10 == 0


def _octets(s: str) -> bool:
    parts = s.split(".")
    return len(parts) == 4 and all(x.isascii() and x.isdigit() and int(x) <= 255 and (x == "0" or x[0] != "0") for x in parts)


def _digits(s: str) -> str:
    return re.sub(r"\D", "", s)


def _strict(kind: str, s: str) -> int:
    """The regular-expression labeler: the kind's exact form."""
    if kind == "EMAIL":
        return 1 if re.fullmatch(r"[^@.](?:[^@]*[^@.])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}", s) and ".." not in s else -1
    if kind == "IP":
        return 1 if _octets(s) else -1
    if kind == "CARD":
        return 1 if len(_digits(s)) in (13, 14, 15, 16, 19) else -1
    if kind == "PHONE":
        return 1 if 9 <= len(_digits(s)) <= 15 else -1
    value = re.split(r"[=:]", s, maxsplit=1)[-1].strip(" \"'")
    return 1 if len(value) >= 8 and (re.search(r"[0-9]", value) or _KEY_STARTS.match(value)) and re.search(r"[A-Za-z]", value) else -1


def _checked(kind: str, s: str) -> int:
    """The checksum and variety labeler."""
    d = _digits(s)
    if kind == "CARD":
        return 1 if luhn(d) else -1
    if kind == "IP":
        return -1 if s in ("0.0.0.0", "127.0.0.1", "255.255.255.255") else 0
    if kind == "SECRET":
        value = re.split(r"[=:]", s, maxsplit=1)[-1].strip(" \"'")
        return 1 if len(set(value)) >= 8 else -1
    if kind == "PHONE":
        return -1 if len(set(d)) <= 2 else 0
    return 0


def _listed(kind: str, s: str) -> int:
    """The gazetteer labeler."""
    if kind == "EMAIL":
        return 1 if s.rsplit(".", 1)[-1].lower() in _DOMAINS else -1
    if kind == "CARD":
        return 1 if _CARD_STARTS.match(_digits(s)) else -1
    if kind == "PHONE":
        return 1 if s[0] in "+(" or "(" in s[:6] else 0
    if kind == "IP":
        return -1 if s.startswith(("0.", "1.0.", "1.1.", "1.2.")) else 1
    return 1 if _KEY_STARTS.match(s) else 0


def _cued(kind: str, before: str) -> int:
    """The context labeler: words before the span."""
    return 1 if _CUES[kind].search(before) else -1 if _NOT.search(before) else 0


def _alone(before: str, after: str) -> int:
    """The boundary labeler: a span that stands free of letters and digits."""
    return -1 if (before and before[-1].isalnum()) or (after and (after[0].isalnum() or after[0] == "_")) else 1


def _varied(s: str) -> int:
    """The variety labeler: digits or letters that are all alike aren't anyone's."""
    return -1 if len({c for c in s if c.isalnum()}) <= 2 else 0


LABELERS = 6


def votes_on(kind: str, s: str, before: str, after: str) -> tuple[int, ...]:
    return (_strict(kind, s), _checked(kind, s), _listed(kind, s), _cued(kind, before), _alone(before, after), _varied(s))


def candidates(text: str) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """(start, end, kind, votes), in order."""
    out = []
    for m in _CANDIDATE.finditer(text):
        kind = next(k for k in KINDS if m[k] is not None)
        out.append((m.start(), m.end(), kind, votes_on(kind, m[0], *around(text, m.start(), m.end()))))
    return out


def around(text: str, start: int, end: int) -> tuple[str, str]:
    """What stands before and after a span, as far as it counts."""
    return text[max(0, start - 24) : start], text[end : end + 1]


_SIGNS, _WORDS = "+(). -@\"=:/_", 16
_WORD = re.compile(r"\w+")


def features(s: str, before: str, after: str, votes: tuple[int, ...]) -> list[float]:
    """A bias, the labelers' findings, the span's shape and its surroundings."""
    n = len(s)
    shape = [min(n, 64) / 16, sum(c.isdigit() for c in s) / n, sum(c.isalpha() for c in s) / n, sum(c.isupper() for c in s) / n, len(set(s)) / n]
    ends = [s[0].isdigit(), s[0] == "0", s[0].isalpha(), s[-1].isdigit()]
    sides = [not before, before[-1:].isspace(), before[-1:].isalnum(), not after, after.isspace(), after.isalnum()]
    words = _WORD.findall(before.lower())[-2:]
    hashed = [0.0] * (2 * _WORDS)
    for k, w in enumerate(reversed(words)):
        hashed[k * _WORDS + zlib.crc32(w.encode()) % _WORDS] = 1.0
    return [1.0, *(float(v > 0) for v in votes), *(float(v < 0) for v in votes), *shape, *(float(c in s) for c in _SIGNS), *map(float, ends), *map(float, sides), *hashed]


def perturbed(kind: str, s: str, before: str, after: str, seed: int) -> list[tuple[str, str, str]]:
    """Variants of a span and its surroundings."""
    rng = random.Random(seed)
    other = re.sub(r"[0-9]", lambda _: str(rng.randrange(10)), s)
    return [
        (other, before, after),
        (re.sub(r"[0-9]", "1", s), before, after),
        (re.sub(r"[0-9]+", "0", s), before, after),
        (re.sub(r"[0-9]+", "999", s, count=1), before, after),
        (s[: max(1, len(s) // 2)], before, after),
        (re.sub(r"[A-Za-z]+$", "q9", s), before, after),
        (re.sub(r"[0-9]", "a", s), before, after),
        (s, before, "x"),
        (s, before + "x", after),
        (other, "version ", after),
        (s, {"EMAIL": "mail ", "PHONE": "phone ", "CARD": "card ", "IP": "host ", "SECRET": "key "}[kind], after),
    ]


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    reliability: dict[str, np.ndarray]
    share: dict[str, float]

    def of(self, kind: str, s: str, before: str, after: str, votes: tuple[int, ...]) -> float:
        if kind not in self.weights:
            return 0.0
        return float(_logistic(np.array(features(s, before, after, votes)) @ self.weights[kind]))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


#: What is expected of each labeler before any vote is seen: P(yes | true), P(no | true), P(yes | false), P(no | false). A form or checksum that fails says most; to stand alone says little.
PRIOR = np.array([[0.8, 0.01, 0.2, 0.6], [0.5, 0.01, 0.1, 0.3], [0.6, 0.1, 0.3, 0.4], [0.3, 0.01, 0.1, 0.3], [0.9, 0.02, 0.8, 0.15], [0.01, 0.01, 0.01, 0.2]])
PSEUDO, PSEUDO_SHARE, MOST_TRUE = 20.0, 10.0, 0.95
#: At most so many true spans have a form or a checksum that fails, however often it fails: such a candidate is another thing that looks alike.
MOST_FAILING = np.array([0.01, 0.01, 1, 1, 1, 1])


def expect(votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS, prior: np.ndarray = PRIOR, failing: np.ndarray = MOST_FAILING) -> tuple[np.ndarray, np.ndarray, float]:
    """(probability of each pattern, reliability by labeler: P(yes | true), P(no | true), P(yes | false), P(no | false); share of true).

    It starts from the expected reliabilities, which count as PSEUDO votes throughout.
    """
    says, pseudo = np.stack([votes > 0, votes < 0, votes > 0, votes < 0]).astype(np.float64), PSEUDO * prior
    p = posterior(votes, prior, 0.5)
    for _ in range(rounds):
        a, b = counts * p, counts * (1 - p)
        share = min(MOST_TRUE, (a.sum() + PSEUDO_SHARE) / (counts.sum() + 2 * PSEUDO_SHARE))
        rel = np.stack([(w @ says[k] + pseudo[:, k]) / (w.sum() + PSEUDO) for k, w in enumerate((a, a, b, b))], axis=1)
        rel = np.clip(rel, 1e-4, 1 - 1e-4)
        rel[:, 1] = np.minimum(rel[:, 1], failing)
        p = posterior(votes, rel, share)
    return p, rel, share


def posterior(votes: np.ndarray, rel: np.ndarray, share: float) -> np.ndarray:
    """Probability of each pattern, by the labelers' reliabilities as if independent."""
    yes, no = votes > 0, votes < 0
    says = lambda k: np.where(yes, np.log(rel[:, k]), np.where(no, np.log(rel[:, k + 1]), np.log(np.clip(1 - rel[:, k] - rel[:, k + 1], 1e-4, 1)))).sum(axis=1)
    return _logistic(np.log(share) + says(0) - np.log(1 - share) - says(2))


def classify(x: np.ndarray, target: np.ndarray, weight: np.ndarray, l2: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights of the logistic classifier of soft targets with a penalty for each feature, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _logistic(x @ w)
        g = x.T @ (weight * (p - target)) + l2 * w
        h = (x.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ x + np.diag(l2)
        step = np.linalg.solve(h, g)
        w -= step / max(1.0, np.abs(step).max() / 2)
    return w


def fit(patterns: list[tuple[str, tuple[int, ...], int]], spans: list[tuple[str, str, str, str]]) -> Model:
    """From (kind, votes, count) of all candidates and (kind, span, before, after) of some."""
    model = Model({}, {}, {})
    for kind in KINDS:
        own = sorted((v, c) for k, v, c in patterns if k == kind)
        some = sorted(x[1:] for x in spans if x[0] == kind)
        if not own or not some:
            continue
        _, rel, share = expect(np.array([v for v, _ in own]), np.array([c for _, c in own], np.float64))
        model.reliability[kind], model.share[kind] = rel, share
        rows = [(s, b, a, 1.0) for s, b, a in some]
        for k, (s, b, a) in enumerate(some[:: -(-len(some) // VARIED_SPANS)]):
            rows += [(*v, 1.0) for v in perturbed(kind, s, b, a, k)]
        votes = np.array([votes_on(kind, s, b, a) for s, b, a, _ in rows])
        x = np.array([features(s, b, a, tuple(v)) for (s, b, a, _), v in zip(rows, votes.tolist())])
        model.weights[kind] = classify(x, posterior(votes, rel, share), np.array([r[3] for r in rows]), np.where(np.arange(x.shape[1]) <= 2 * LABELERS, 0.005, 0.5))
    return model


def _worth(column: pa.Array) -> pa.Array:
    """Whether each text may hold a candidate: a linear-time test of what no candidate can be without."""
    return pc.fill_null(pc.match_substring_regex(column, _PREFILTER), False)


def train(docs: DataFrame, sample_spans: int = SAMPLE_SPANS) -> Model:
    texts = keyed(docs)

    def counts(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: dict[tuple[str, tuple[int, ...]], int] = {}
        for text in batch.column(1).filter(_worth(batch.column(1))).to_pylist():
            for _, _, kind, votes in candidates(text):
                seen[kind, votes] = seen.get((kind, votes), 0) + 1
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen], pa.string()), pa.array([list(v) for _, v in seen], pa.list_(pa.int32())), pa.array(list(seen.values()), pa.int64())], names=["kind", "votes", "n"])

    counted = map_batches(texts, "kind string, votes array<int>, n long", counts).groupBy("kind", "votes").agg(F.sum("n").alias("n"))
    patterns = [(r["kind"], tuple(r["votes"]), r["n"]) for r in counted.collect()]
    if not patterns:
        return Model({}, {}, {})
    total = {kind: sum(n for k, _, n in patterns if k == kind) for kind in KINDS}
    share = {k: min(1 << 32, -(-2 * sample_spans << 32) // n if n > sample_spans else 1 << 32) for k, n in total.items() if n}  # twice what is wanted, as the draw is by a hash

    def drawn(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        worth = batch.filter(_worth(batch.column(1)))
        for doc_id, text in zip(worth.column(0).to_pylist(), worth.column(1).to_pylist()):
            for a, z, kind, _ in candidates(text):
                h = zlib.crc32(f"{doc_id} {a} {text[a:z]}".encode())
                if h < share.get(kind, 1 << 32):
                    rows.append((kind, h, text[a:z], *around(text, a, z)))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64() if k == 1 else pa.string()) for k in range(5)], names=["kind", "h", "span", "before", "after"])

    by = Window.partitionBy("kind").orderBy("h", "span", "before", "after")
    some = map_batches(texts, "kind string, h long, span string, before string, after string", drawn).withColumn("k", F.row_number().over(by)).where(F.col("k") <= sample_spans)
    return fit(patterns, [(r["kind"], r["span"], r["before"], r["after"]) for r in some.collect()])


def spans(text: str, model: Model, threshold: float) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of what is found in a text."""
    return [(a, z, kind, s) for a, z, kind, votes in candidates(text) if (s := round(model.of(kind, text[a:z], *around(text, a, z), votes), 6)) >= threshold]


def find(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, start, length, kind, score); start counts characters from 0."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        batch = batch.filter(_worth(batch.column(1)))
        rows, got = [], []
        for k, text in enumerate(batch.column(1).to_pylist()):
            for x in spans(text, model, threshold):
                rows.append(k)
                got.append(x)
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array([a for a, _, _, _ in got], pa.int32()), pa.array([z - a for a, z, _, _ in got], pa.int32()), pa.array([k for _, _, k, _ in got], pa.string()), pa.array([s for _, _, _, s in got], pa.float64())], names=["doc_id", "start", "length", "kind", "score"])

    return map_batches(keyed(docs), "doc_id long, start int, length int, kind string, score double", one)


def redacted(text: str, model: Model, threshold: float) -> str:
    out, at = [], 0
    for a, z, kind, _ in spans(text, model, threshold):
        out += [text[at:a], f"[{kind}]"]
        at = z
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, with the spans replaced; n_chars follows the text."""
    at, counted = docs.columns.index("text"), "n_chars" in docs.columns

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        old = batch.column(at)
        mask = _worth(old)
        texts = [redacted(x, model, threshold) for x in old.filter(mask).to_pylist()]
        new = batch.set_column(at, batch.schema.field(at), pc.replace_with_mask(old, mask, pa.array(texts, old.type)))
        if counted:
            k = batch.schema.get_field_index("n_chars")
            new = new.set_column(k, batch.schema.field(k), pc.utf8_length(new.column(at)).cast(batch.schema.field(k).type))
        return new

    return map_batches(docs, docs.schema, one)

