"""Personal data by candidates and gradient boosting.

Fixed rules find the base spans (email, ip, card, phone); they always stay.
High-recall generators propose further, overlapping spans of the same kinds:
spelled-out or spaced addresses, numbers with other separators or without a
prefix, and numbers that look right and fail the rules' checks.  Boosted trees
score them from their format and context, the scores are calibrated, and a
kind's threshold is the least one that keeps ``PRECISION`` on held-out rows.

The trees learn from weak labels: base spans are positive, and so are they
rewritten the way people disguise them; candidates that fail a check are
negative, and so are broken base spans and common harmless numbers put in the
same contexts.  Labels come from a bounded sample of documents.

Rows: a null text counts as the empty text and has no spans.  Equal texts get
equal spans; an empty table gives an empty table.  Offsets are code points, end
exclusive.  Only id and text are read.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_right
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topic_tables.llm.text import share, slices

KINDS = ("email", "ip", "card", "phone")
#: Bound of the fit: documents, by a digest of the id.
FIT_DOCS = 20_000
#: Of a document, at most so many candidates of a kind teach.
FIT_EACH = 20
TREES, DEPTH, RATE, BINS = 40, 3, 0.3, 16
PRECISION = 0.995
SEED = 11
CONTEXT = 30

# The base rules.  A possessive or bounded start finds the same
# leftmost matches as the plain pattern without rescanning runs.
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Generators: wider than the rules on purpose.
AT, DOT = r"(?:@|[\[({]at[\])}])", r"(?:[\[({]dot[\])}]|dot(?= )| \.)"
WIDE = {
    "email": re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}(?: ?{AT} ?[A-Za-z0-9-]{{1,64}}(?:(?:\.| ?{DOT} ?)[A-Za-z0-9-]{{1,24}}){{1,4}}"
                        rf"| at [A-Za-z0-9-]{{1,64}}(?: dot [A-Za-z0-9-]{{1,24}}){{1,4}})"),
    "ip": re.compile(r"(?<![0-9A-Za-z.:])(?:[0-9]{1,3}(?: ?(?:\.|\[\.\]) ?[0-9]{1,3}){3}|(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4})(?![0-9A-Za-z])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ ./_-]{0,2}[0-9]){11,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9A-Za-z])(?:\+|00)?\(?[0-9]{2,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){1,4}(?![0-9A-Za-z])"),
}
#: Words near a span that speak for (or against) a kind.
CUES = {
    "email": re.compile(r"mail|contact|write|@", re.I), "ip": re.compile(r"\bip\b|addr|host|server|login", re.I),
    "card": re.compile(r"card|visa|credit|pay|account", re.I), "phone": re.compile(r"phone|tel|call|mobile|fax|cell", re.I),
    "not": re.compile(r"token|version|\bv\.?$|isbn|order|license|date|hash|=\s*\"?$", re.I),
}
#: Common last labels of host names (a feature, not a rule).
ENDINGS = frozenset("com org net edu gov mil int info biz io co ai app dev de fr es it uk us eu nl be ch at pl pt se no dk fi ie ru cn jp in br mx ca au".split())
DIGIT = re.compile(r"[0-9]")
DATE = re.compile(r"(?:19|20)[0-9]{2}[./-][01]?[0-9][./-][0-3]?[0-9]$|[0-3]?[0-9][./-][01]?[0-9][./-](?:19|20)[0-9]{2}$")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str | None) -> list[Span]:
    """Spans of the fixed rules, by kind and start."""
    out: list[Span] = []
    if not text:
        return out
    upto = 0
    if "@" in text:
        for m in EMAIL_TAIL.finditer(text):
            a = m.start()
            while a > upto and EMAIL_LOCAL.match(text[a - 1]):
                a -= 1
            if a < m.start():
                out.append(("email", a, m.end()))
                upto = m.end()
    if DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            d = digits_of(m[0]) if m.end() - m.start() <= 37 else ""
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


def candidates(text: str | None) -> list[Span]:
    """Spans of the generators; they may overlap."""
    if not text:
        return []
    digits = DIGIT.search(text) is not None
    mail = "@" in text or any(x in text for x in ("(at)", "[at]", "{at}")) or " at " in text and any(x in text for x in (" dot ", "(dot)", "[dot]", "{dot}"))
    return [(kind, m.start(), m.end()) for kind in KINDS if (mail if kind == "email" else digits or kind == "ip" and ":" in text)
            for m in WIDE[kind].finditer(text)]


def features(text: str, span: Span) -> list[float]:
    """Format and context of a span."""
    kind, a, b = span
    s, left, right = text[a:b], text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]
    d = digits_of(s)
    groups = re.findall(r"[0-9]+", s)
    sizes = [len(g) for g in groups] or [0]
    parts = re.split(rf"{AT}| at ", s, maxsplit=1)
    names = re.split(r"\.| ?[\[({]?dot[\])}]? ?", parts[1]) if len(parts) == 2 else []
    last = names[-1].strip() if names else ""
    octets = len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    return [
        *(float(kind == k) for k in KINDS), len(s), len(d), float(13 <= len(d) <= 19 and luhn(d)), float(9 <= len(d) <= 15),
        len(groups), max(sizes), min(sizes), float(octets), float(s[:1] == "+"), float(s[:2] == "00"), float("(" in s and ")" in s),
        s.count(" "), s.count("-"), s.count("."), s.count("/"), float("@" in s), len(names), float(last.isalpha()), len(last), float(last.lower() in ENDINGS),
        len(parts[0].strip()) if names else 0, float(any(c.isalpha() for c in s)), float(DATE.match(s) is not None),
        float(left[-1:].isalnum()), float(right[:1].isalnum()), float(left[-1:] in ".,-/:" and left != ""), float(right[:1] in "/-:%" and right != ""),
        *(float(CUES[c].search(left) is not None) for c in (*KINDS, "not")),
        float(CUES[kind].search(left) is not None), len(digits_of(left)), len(digits_of(right)),
    ]


# ------------------------------------------------------------------ weak labels
def disguised(kind: str, s: str, rnd: random.Random) -> str:
    """A base span the way people disguise it."""
    if kind == "email":
        at, dot = rnd.choice([(" at ", " dot "), ("(at)", "(dot)"), ("[at]", "."), ("(at)", "."), (" @ ", "."), (" [at] ", " [dot] "), ("{at}", "{dot}")])
        name, host = s.split("@", 1)
        plain = "".join(c for c in name if c.isalpha()) or "info"
        end = rnd.choice(["com", "org", "net", "de", "fr", "es", "io", "co.uk"])
        name = rnd.choice([name, plain, plain[:1] + "." + plain, plain + "-" + name])
        host = rnd.choice([host, host.rsplit(".", 1)[0] + "." + end, plain[::-1].lower() + "." + end])
        return name + at + host.replace(".", dot)
    if kind == "ip":
        return s.replace(".", rnd.choice([" . ", "[.]", ". "]))
    d = digits_of(s)
    if kind == "card":
        return rnd.choice([".", "/", "_", "  "]).join(d[i:i + 4] for i in range(0, len(d), 4))
    d = d[-10:]
    return rnd.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}"]).format(d[:3], d[3:6], d[6:])


def harmless(kind: str, s: str, rnd: random.Random) -> tuple[str, str]:
    """A broken span or a common number, and the kind a generator takes it for."""
    d = digits_of(s)
    n = rnd.randrange
    if kind == "card":
        d = d[:-1] + str((int(d[-1]) + 1 + n(9)) % 10)     # the check digit fails
        return "card", rnd.choice(["", " ", "-", "."]).join(d[i:i + 4] for i in range(0, len(d), 4))
    if kind == "ip":
        return "ip", ".".join(str(x) for x in rnd.sample([n(10), 256 + n(700), n(1000), n(100)], 4))
    if kind == "email":
        word = "".join(c for c in s.split("@")[0] if c.isalpha()).lower() or "look"
        return "email", rnd.choice([f"{s.split('@')[0]}@{n(100)}.{n(10)}", f"{word} at {word[::-1]} dot {word[1:] or 'here'}", f"{word} at the dot {word}s"])
    return "phone", rnd.choice([f"{1950 + n(90)}-{1 + n(12):02d}-{1 + n(28):02d}", f"{1 + n(28):02d}.{1 + n(12):02d}.{1950 + n(90)}", f"{n(100):02d} {n(100):02d}",
                                f"{n(100):02d}.{n(100):02d}", f"{n(1000):03d}-{n(100):02d}", f"{n(100):02d}/{n(100):02d}/{n(100):02d}", f"{n(1000):03d} {n(1000):03d}",
                                " ".join(f"{n(100):02d}" for _ in range(3 + n(4))), " ".join(f"{n(1000):03d}" for _ in range(3 + n(3)))])


def lessons(text: str | None) -> list[tuple[list[float], int, str]]:
    """Feature rows of one document with weak labels."""
    if not text:
        return []
    base = base_spans(text)
    out, each = [], dict.fromkeys(KINDS, 0)
    rnd = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    for kind, a, b in base:
        if each[kind] >= FIT_EACH:
            continue
        each[kind] += 1
        out.append((features(text, (kind, a, b)), 1, kind))
        left, right = text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]
        for _ in range(2):
            s = disguised(kind, text[a:b], rnd)
            out.append((features(left + s + right, (kind, len(left), len(left) + len(s))), 1, kind))
        for _ in range(2):
            k, s = harmless(kind, text[a:b], rnd)
            out.append((features(left + s + right, (k, len(left), len(left) + len(s))), 0, k))
    each = dict.fromkeys(KINDS, 0)
    cover = Cover(base)
    for span in candidates(text):
        kind, a, b = span
        if each[kind] < FIT_EACH and fails(kind, text[a:b]) and not cover.meets(a, b):
            each[kind] += 1
            out.append((features(text, span), 0, kind))
    return out


def fails(kind: str, s: str) -> bool:
    """Whether a candidate has the form of its kind and fails a check."""
    d = digits_of(s)
    if kind == "card":
        return not (13 <= len(d) <= 19 and luhn(d))
    if kind == "ip":
        return "." in s and not all(len(g) <= 3 and int(g) <= 255 for g in re.findall("[0-9]+", s))
    return kind == "phone" and not 9 <= len(d) <= 15


# ------------------------------------------------------------------------ trees
@dataclass
class Boosted:
    """Boosted trees of equal depth over binned features, then a logistic
    calibration and a threshold for each kind."""
    edges: list[np.ndarray] = field(default_factory=list)
    feature: list[np.ndarray] = field(default_factory=list)   # of a tree's inner nodes, breadth first
    cut: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    threshold: dict[str, float] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def grow(self, q: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
        """Add a tree; returns the leaf of each row."""
        feature, cut = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, BINS)
        node = np.zeros(len(q), np.int64)
        for depth in range(DEPTH):
            first = 2 ** depth - 1
            width = 2 ** depth
            best = np.zeros(width)
            for j in range(q.shape[1]):
                cell = (node - first) * (BINS + 1) + q[:, j]
                g = np.bincount(cell, grad, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                h = np.bincount(cell, hess, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all ** 2 / (h_all + 1)
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                better = top > best + 1e-9
                best = np.where(better, top, best)
                feature[first:first + width] = np.where(better, j, feature[first:first + width])
                cut[first:first + width] = np.where(better, at, cut[first:first + width])
            node = 2 * node + 1 + (q[np.arange(len(q)), feature[node]] > cut[node])
        leaf = node - (2 ** DEPTH - 1)
        value = -np.bincount(leaf, grad, 2 ** DEPTH) / (np.bincount(leaf, hess, 2 ** DEPTH) + 1)
        self.feature.append(feature)
        self.cut.append(cut)
        self.leaf.append(RATE * value)
        return leaf

    def margin(self, x: np.ndarray) -> np.ndarray:
        q, out = self.bins(x), np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (q[rows, feature[node]] > cut[node])
            out += leaf[node - (2 ** DEPTH - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, kinds: list[str]) -> Boosted | None:
    """Trees from two thirds of the rows; calibration and thresholds from the rest."""
    if not len(y) or y.min() == y.max():
        return None
    held = np.arange(len(y)) % 3 == 2
    m = Boosted(edges=[np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for j in range(x.shape[1])])
    # a value that is its own quantile must be able to leave it
    fit_x, fit_y = x[~held], y[~held]
    p = float(np.clip(fit_y.mean(), 0.01, 0.99))
    m.start = float(np.log(p / (1 - p)))
    q, now = m.bins(fit_x), np.full(len(fit_y), m.start)
    for _ in range(TREES):
        prob = 1 / (1 + np.exp(-now))
        leaf = m.grow(q, prob - fit_y, prob * (1 - prob))
        now += m.leaf[-1][leaf]
    z, t = m.margin(x[held]), y[held]
    for _ in range(50):                      # Newton steps of the logistic calibration
        prob = 1 / (1 + np.exp(-np.clip(m.slope * z + m.shift, -30, 30)))
        w = prob * (1 - prob) + 1e-6
        g = np.array([((prob - t) * z).sum() + 1e-3 * (m.slope - 1), (prob - t).sum()])
        hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, g)
        m.slope, m.shift = m.slope - float(step[0]), m.shift - float(step[1])
        if np.abs(step).max() < 1e-6:
            break
    m.slope = max(m.slope, 1e-3)
    score = m.probability(x[held])
    for kind in KINDS:
        at = np.flatnonzero(np.array(kinds)[held] == kind)
        order = at[np.argsort(-score[at], kind="stable")]
        right = np.cumsum(t[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(right >= PRECISION)
        if len(good):       # half way to the next lower score
            low = score[order[good[-1] + 1]] if good[-1] + 1 < len(order) else 0.0
            m.threshold[kind] = max(0.5, float(score[order[good[-1]]] + low) / 2)
        else:
            m.threshold[kind] = 2.0
    return m


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Boosted | None:
    n = docs.count()
    sample = docs.where(share(id_col) * n < FIT_DOCS).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in slices(batches, 1):
            flat = [(str(i), *row) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for row in lessons(t)]
            if flat:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*flat)], ["id", "x", "y", "kind"])

    rows = sample.mapInArrow(run, "id string, x array<double>, y bigint, kind string").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["id"], r["kind"], r["y"], list(r["x"])))
    random.Random(SEED).shuffle(rows)
    return boost(np.array([r["x"] for r in rows], float), np.array([r["y"] for r in rows], float), [r["kind"] for r in rows]) if rows else None


# ------------------------------------------------------------------------- spans
class Cover:
    """Disjoint covered stretches of a text."""

    def __init__(self, spans=()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted((s[1], s[2]) for s in spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        k = bisect_right(self.ends, a)
        return k < len(self.starts) and self.starts[k] < b

    def add(self, a: int, b: int) -> None:
        """Cover a stretch that meets none so far."""
        k = bisect_right(self.ends, a)
        self.starts.insert(k, a)
        self.ends.insert(k, b)


def select(texts: list[str | None], model: Boosted | None) -> list[list[tuple[str, int, int, bool, float]]]:
    """All spans of each text: base ones, and the best added ones that overlap
    no base span and no better one."""
    base = [base_spans(t) for t in texts]
    covers = [Cover(b) for b in base] if model else []
    found = [(i, c) for i, cover in enumerate(covers) for c in candidates(texts[i]) if not cover.meets(c[1], c[2])]
    score = model.probability(np.array([features(texts[i], c) for i, c in found], float)) if found else []
    out = [[(*s, True, 1.0) for s in b] for b in base]
    for k in sorted(range(len(found)), key=lambda k: (found[k][0], -score[k], found[k][1])):
        i, (kind, a, b) = found[k]
        if score[k] >= model.threshold[kind] and not covers[i].meets(a, b):
            covers[i].add(a, b)
            out[i].append((kind, a, b, False, float(score[k])))
    return [sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])) for spans in out]


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]))


def _structs(spans) -> pa.Array:
    return pa.array([[dict(zip(("kind", "start", "end", "base", "score"), s)) for s in row] for row in spans], SPAN_TYPE)


def find(docs: DataFrame, model: Boosted | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)`` of every row; no shuffle.  The model's size is fixed."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([b.column(0), _structs(select(b.column(1).to_pylist(), shared.value))], ["id", "spans"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {id_type}, spans {SPANS}").withColumnRenamed("id", id_col))


def redact(text: str | None, spans) -> str | None:
    """The text with every span replaced by its kind's name; overlapping spans
    are replaced together, under the first one's kind."""
    if not text or not spans:
        return text
    out, upto = [], 0
    for kind, a, b, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= upto:
            out += [text[upto:a], f"[{kind.upper()}]"]
        upto = max(upto, b)
    return "".join([*out, text[upto:]])


def redacted(docs: DataFrame, model: Boosted | None, text_col: str = "text") -> DataFrame:
    """The same rows and columns with redacted texts; no shuffle."""
    at, names = docs.columns.index(text_col), docs.columns
    safe = docs.toDF(*(f"c{i}" for i in range(len(names))))       # the table's own names may hold dots
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches, at):
            texts = b.column(at).to_pylist()
            clean = [redact(t, s) for t, s in zip(texts, select(texts, shared.value))]
            yield b.set_column(at, b.schema.field(at), pa.array(clean, b.schema.field(at).type))

    return safe.mapInArrow(run, safe.schema).toDF(*names)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")
    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    return found.select(id_col, *counts, F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
