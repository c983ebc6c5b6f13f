"""PII: fixed base patterns, widened by a semi-Markov conditional random field.

Base spans follow fixed patterns.  The field reads regions of a text: tokens that
hold a digit, an ``@`` or a written-out ``[at]``/``(at)``, with their neighbours.
A region is cut into units; a segment is a run of at most MAX_UNITS units with one
type.  Whole-span features score a segment, and dynamic programming over all
segmentations chooses boundaries and types together.  Its entity segments that
meet no base span are added to the base spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from usagelake.llm.common import arrow_limits, utf8

KINDS = ("email", "ip", "card", "phone")
MAX_UNITS = 16
SAMPLE_DOCS = 20_000
SAMPLE_REGIONS = 1500
REGION_CHARS = 400

# ---------------------------------------------------------------- base spans
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]")
_WRITTEN = re.compile(r"[\[(](?:at|dot)[\])]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all base matches in code points, in that order."""
    if not text:
        return []
    out = [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m.group())]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# ------------------------------------------------------------------- regions
_TOKEN = re.compile(r"\S+")
_UNIT = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[^A-Za-z0-9\s]")


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of neighbouring tokens that hold a mark; a written-out mark takes in both its neighbours."""
    if not _MARK.search(text):
        return
    start = end = None
    before, take = None, False
    for m in _TOKEN.finditer(text):
        mark = _MARK.search(m.group())
        if mark or take:
            written = bool(mark) and bool(_WRITTEN.search(m.group()))
            first = before if written and before is not None else m.start()
            if start is not None and first - end <= 1:
                end = m.end()
            else:
                if start is not None:
                    yield start, end
                start, end = first, m.end()
            take = written
        before = m.start()
    if start is not None:
        yield start, end


class Region:
    """Units of one region and the features of its candidate segments."""

    def __init__(self, text: str, start: int, end: int):
        self.text, self.start = text[start:end], start
        self.units = [m.span() for m in _UNIT.finditer(self.text)]

    def candidates(self, i: int) -> Iterator[tuple[int, np.ndarray]]:
        """Segments from unit ``i``: their last unit (exclusive) and their features.

        Any entity starts and ends with a letter, a digit or a sign of its own and has
        a digit run or a mark inside, so other segments are left to the outside type.
        """
        head = self.text[self.units[i][0]]
        if not (head.isascii() and (head.isalnum() or head in "+(_%.-")):
            return
        for j in range(i + 1, min(len(self.units), i + MAX_UNITS) + 1):
            last = self.text[self.units[j - 1][0]]
            if last.isascii() and last.isalnum():
                s = self.text[self.units[i][0]:self.units[j - 1][1]]
                f = span_features(s, self.text[max(0, self.units[i][0] - 2):self.units[i][0]],
                                  self.text[self.units[j - 1][1]:self.units[j - 1][1] + 2])
                if f is not None:
                    yield j, f


_AT = re.compile(r"\s?(?:@|[\[(]at[\])])\s?")
_DOT = re.compile(r"\s?[\[(](?:dot|\.)[\])]\s?")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_LOCALPART = re.compile(r"[A-Za-z0-9._%+-]+")
N_FEATURES = 24


def span_features(s: str, before: str, after: str) -> np.ndarray | None:
    """Features of a whole span, or None where no type can apply."""
    digits = re.sub(r"[^0-9]", "", s)
    n = len(digits)
    letters = sum(c.isalpha() for c in s)
    other = len(s) - n - letters
    at = _AT.search(s)
    if not at and (n < 4 or letters > 3 + s.count("dot") * 3):
        return None
    f = np.zeros(N_FEATURES)
    f[0] = 1
    inside = lambda c: c.isalnum() or c in "@_+%"
    f[1] = bool(before) and inside(before[-1])
    f[2] = bool(after) and inside(after[0])
    f[3] = after[:1] in ("-", ".") and after[1:].isalnum() or before[-1:] in ("-", ".") and before[:-1].isalnum()
    if at:
        name, host = s[:at.start()], _DOT.sub(".", s[at.end():])
        f[4] = bool(_LOCALPART.fullmatch(name))
        f[5] = bool(_HOST.fullmatch(host)) and "." in host
        f[6] = f[4] and f[5]
        f[7] = host.rpartition(".")[2].isalpha()
        f[8] = len(_AT.findall(s)) > 1
        return f
    plain = re.sub(r"\s?[\[(]?\.[\])]?\s?", ".", s)
    parts = plain.split(".")
    quad = len(parts) == 4 and all(p.isdigit() and p.isascii() for p in parts)
    f[9] = quad
    f[10] = quad and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    groups = re.findall(r"[0-9]+", s)
    seps = set(re.findall(r"[^0-9]+", s))
    even = len(seps) <= 1 and len({len(g) for g in groups[:-1]}) <= 1 and letters == 0
    f[11] = even and 12 <= n <= 19 and not quad
    f[12] = f[11] and luhn(digits)
    f[13] = letters == 0 and other == 0
    f[14] = f[11] and len(groups) in (3, 4, 5) and len(groups[0]) == 4
    f[15] = s[0] == "+"
    f[16] = "(" in s and s.count("(") == s.count(")")
    f[17] = 9 <= n <= 15 and letters == 0 and 3 <= len(groups) <= 6
    f[18] = f[17] and len(groups[-1]) == 4 and len(groups[-2]) == 3
    f[19] = f[17] and f[15]
    f[20] = letters > 0
    f[21] = n < 9 and not quad
    f[22] = n > 19
    f[23] = s.count("(") != s.count(")")
    return f


# --------------------------------------------------------------- the field
def _scores(region: Region, w: np.ndarray):
    """Candidate segments by first unit: last unit, features, scores of the four types."""
    out = []
    for i in range(len(region.units)):
        out.append([(j, f, w @ f) for j, f in region.candidates(i)])
    return out


def decode(region: Region, w: np.ndarray) -> list[tuple[int, int, int]]:
    """Best segmentation: ``(start, kind, end)`` of its entities, in text positions.

    The outside type covers one unit and scores 0; ties prefer it.
    """
    segments = _scores(region, w)
    n = len(region.units)
    best, back = np.full(n + 1, -np.inf), [None] * (n + 1)
    best[0] = 0
    for i in range(n):
        if best[i] > best[i + 1]:
            best[i + 1], back[i + 1] = best[i], (i, -1)
        for j, _, s in segments[i]:
            k = int(s.argmax())
            if s[k] > 0 and best[i] + s[k] > best[j]:
                best[j], back[j] = best[i] + s[k], (i, k)
        if best[i] >= best[i + 1]:
            best[i + 1], back[i + 1] = best[i], (i, -1)
    out, j = [], n
    while j:
        i, k = back[j]
        if k >= 0:
            out.append((region.start + region.units[i][0], k, region.start + region.units[j - 1][1]))
        j = i
    return out[::-1]


def _gradient(region: Region, gold: dict[tuple[int, int], int], w: np.ndarray) -> np.ndarray:
    """Gradient of the log-likelihood of the gold entities (unit ranges to kinds)."""
    segments = _scores(region, w)
    n = len(region.units)
    fwd, bwd = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    fwd[0] = bwd[n] = 0
    for i in range(n):
        fwd[i + 1] = np.logaddexp(fwd[i + 1], fwd[i])
        for j, _, s in segments[i]:
            fwd[j] = np.logaddexp(fwd[j], fwd[i] + np.logaddexp.reduce(s))
    for i in range(n - 1, -1, -1):
        bwd[i] = bwd[i + 1]
        for j, _, s in segments[i]:
            bwd[i] = np.logaddexp(bwd[i], bwd[j] + np.logaddexp.reduce(s))
    g = np.zeros_like(w)
    for i in range(n):
        for j, f, s in segments[i]:
            g -= np.exp(np.minimum(fwd[i] + s + bwd[j] - fwd[n], 0))[:, None] * f
            if (i, j) in gold:
                g[gold[i, j]] += f
    return g


def _disguised(kind: int, s: str, turn: int) -> str:
    """A written-out variant of a base span, as people write them to evade patterns."""
    if kind == 0:
        return s.replace("@", (" [at] ", "(at)", "[at]")[turn % 3])
    if kind == 1:
        return s.replace(".", ("[.]", " . ", "(.)")[turn % 3])
    if kind == 2:
        digits = re.sub("[^0-9]", "", s)
        return (".", "  ", "/")[turn % 3].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    return re.sub(r"^\+[0-9]+\s?", "", s) if turn % 2 else s.replace("+", "00")


def train(examples: list[tuple[str, str]], epochs: int = 6) -> np.ndarray:
    """Weights from ``(text, base spans)`` regions: base spans are positives, the rest is outside.

    Every positive is also learned in written-out form.  Without examples the
    weights make every entity impossible.
    """
    w = np.zeros((len(KINDS), N_FEATURES))
    w[:, 0] = -4.0
    data = []
    for turn, (text, labels) in enumerate(examples):
        spans = [(int(s), KINDS.index(k), int(e)) for k, s, e in
                 (x.split(":") for x in labels.split(",") if x)]
        data.append((text, spans))
        for s, k, e in spans[:1]:
            alt = _disguised(k, text[s:e], turn)
            data.append((text[:s] + alt + text[e:], [(s, k, s + len(alt))]))
    total = np.full_like(w, 1e-3)
    for epoch in range(epochs):
        for text, spans in data:
            r = Region(text, 0, len(text))
            first = {u[0]: i for i, u in enumerate(r.units)}
            last = {u[1]: i + 1 for i, u in enumerate(r.units)}
            gold = {(first[s], last[e]): k for s, k, e in spans if s in first and e in last}
            g = _gradient(r, gold, w) - 1e-3 * w
            total += g * g
            w += 0.5 * g / np.sqrt(total)
    return w


def all_spans(text: str, base: list[tuple[int, int, int]], w: np.ndarray) -> list[tuple[int, int, int]]:
    """Base spans and the field's spans that meet none of them, by start and kind."""
    taken = sorted((s, e) for s, _, e in base)
    starts = [s for s, _ in taken]
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else []
    added = []
    for a, b in regions(text):
        for s, k, e in decode(Region(text, a, b), w):
            i = int(np.searchsorted(starts, e))
            if i == 0 or reach[i - 1] <= s:
                added.append((s, k, e))
    return sorted(base + added)


def training_regions(docs: DataFrame, sample_docs: int = SAMPLE_DOCS,
                     sample_regions: int = SAMPLE_REGIONS) -> list[tuple[str, str]]:
    """At most ``sample_regions`` regions from the ``sample_docs`` documents of smallest md5(doc_id).

    Longer regions than REGION_CHARS characters are not used for fitting.
    """

    def run(batches):
        for b in batches:
            buf, off = utf8(b.column(1))
            data, keys = buf.tobytes(), b.column(0).to_pylist()
            rows = []
            for key, i, j in zip(keys, off[:-1], off[1:]):
                text = data[i:j].decode("utf-8", "replace")
                for n, (s, e) in enumerate(regions(text)):
                    if e - s <= REGION_CHARS and n < 8:
                        part = text[s:e]
                        rows.append((f"{key}-{n}", part, span_text(base_spans(part))))
            cols = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["key", "part", "labels"])

    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    # uniform md5: the bound on documents is a bound on the key, found from the row count
    n = docs.count()
    share = min(1.0, sample_docs / max(n, 1))
    limit = format(min(int(share * 16 ** 8), 16 ** 8 - 1), "08x")
    picked = docs.select(key.alias("key"), F.col("text").cast("string")).where(F.substring("key", 1, 8) <= limit)
    rows = picked.mapInArrow(run, "key string, part string, labels string").orderBy("key", "part").limit(
        sample_regions)
    return [(r.part, r.labels) for r in rows.collect()]


def pii_spans(docs: DataFrame, weights: np.ndarray | None = None,
              columns: tuple[str, str] = ("_base", "_spans")) -> DataFrame:
    """All columns of ``docs`` plus the base spans and all spans, each as kind:start:end joined by commas.

    Fits the field on ``docs`` unless weights are given.  Whole texts are read; null
    and empty texts have no spans; repeated rows have equal spans.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    if weights is None:
        weights = train(training_regions(docs))
    w = np.asarray(weights)
    names, at = docs.columns, docs.columns.index("text")
    schema = StructType([*docs.schema.fields, *(StructField(c, StringType()) for c in columns)])

    def run(batches):
        for b in batches:
            buf, off = utf8(b.column(at))
            data = buf.tobytes()
            base, full = [], []
            for i, j in zip(off[:-1], off[1:]):
                text = data[i:j].decode("utf-8", "replace")
                found = base_spans(text)
                base.append(span_text(found))
                full.append(span_text(all_spans(text, found, w)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(base, pa.string()), pa.array(full, pa.string())],
                                             [*names, *columns])

    return docs.mapInArrow(run, schema)


def redacted(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; the other columns stay.

    Spans that overlap are replaced together under the first one's kind.  Null texts stay null.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    w = train(training_regions(docs)) if weights is None else np.asarray(weights)
    names, at = docs.columns, docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            for n, text in enumerate(texts):
                out, done = [], 0
                for s, k, e in all_spans(text, base_spans(text), w) if text else ():
                    if s >= done:
                        out += [text[done:s], f"<{KINDS[k].upper()}>"]
                    done = max(done, e)
                if out:
                    texts[n] = "".join(out) + text[done:]
            cols = [*b.columns]
            cols[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.mapInArrow(run, docs.schema)


def op2(docs: DataFrame) -> DataFrame:
    """The contract's digest of :func:`pii_spans`; counts are of base spans."""
    spans = pii_spans(docs.select("doc_id", "text"))
    counts = [F.regexp_count("_base", F.lit(k + ":")).cast("long").alias(f"n_{k}") for k in KINDS]
    return spans.select("doc_id", *counts, F.sha2("_base", 256).alias("base_sha256"), F.col("_spans").alias("spans"))
