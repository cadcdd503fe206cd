"""Secret scan: fixed patterns, and a randomness test battery for anything else.

Three patterns give the base spans. Beyond them, every run of at least
``MIN_LENGTH`` key characters is a candidate. Its encoding is inferred from the
characters it uses, which gives the alphabet and each character's code; numbers
and letters in one case are not judged. A run that fits no encoding, as it holds
"+" or "/" together with "-" or "_", is split at the characters outside base64,
base64url and base62 in turn, and the parts are candidates; of those accepted
that overlap, the one least like text is reported. Two questions are asked of a
candidate:

* Could it be random? Chi-squared uniformity over the alphabet, a runs test
  about the middle code and a lag-1 serial correlation; it fails if the least
  of the three p-values, times three, is below ``ALPHA``. With few characters
  per cell Pearson's statistic is not chi-squared; a gamma law with its exact
  mean and variance is used.
* Could it be text? Under characters drawn with the frequencies that the whole
  corpus has within that alphabet, Pearson's statistic is large. The p-value is
  its lower tail, with exact mean and variance, so it falls with the length.

What could be random goes on to the false-discovery control over all
candidates of the corpus: Benjamini and Hochberg's step-up on the text
p-values, apart for each class of length, so that the many short candidates
neither borrow from the few long ones nor drown them. The p-values are counted
in bins of a thousandth of a decade, so the step-up is a running sum over a
small table, whatever the number of candidates.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from framelake.llm.common import python_ready, written

# The base patterns. Failing matches are consumed, then dropped.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}+")  # whole runs of 24 characters or more
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

MIN_LENGTH = 20
ALPHA = 0.001
FDR = 0.01
LENGTH_CLASSES = (20, 24, 32, 48, 64, 128)  # least lengths
BINS_PER_DECADE = 1000
METHOD_KIND = "random"

_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}")
_ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": string.ascii_uppercase + "234567",
    "base36": string.digits + string.ascii_lowercase,
    "base62": string.digits + string.ascii_uppercase + string.ascii_lowercase,
    "base64": string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/",
    "base64url": string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_",
}
_FOLDED = ("hex", "base36")
_CODES = {name: {c: i for i, c in enumerate(alphabet)} for name, alphabet in _ALPHABETS.items()}
_NAMES = list(_ALPHABETS)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns in code points, by start, then kind."""
    found = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def infer_encoding(token: str) -> str | None:
    """Encoding that a token's characters point to; None for numbers, plain
    words and what fits no encoding."""
    chars = set(token)
    digits, upper, lower = chars & set(string.digits), chars & set(string.ascii_uppercase), chars & set(string.ascii_lowercase)
    extra = chars - digits - upper - lower
    if not (upper or lower) or not (digits or extra or (upper and lower and upper & set(token[1:]))):
        return None
    if extra:
        return "base64" if extra <= set("+/") else "base64url" if extra <= set("-_") else None
    if not (upper and lower):
        folded = token.lower()
        if set(folded) <= set(_ALPHABETS["hex"]):
            return "hex"
        if upper and chars <= set(_ALPHABETS["base32"]):
            return "base32"
        return "base36"
    return "base62"


def key_parts(run: str) -> list[tuple[int, int]]:
    """Start and end of the parts of a run that are judged: the whole run, or
    its parts in each alphabet if it fits none as a whole."""
    if not (set(run) & set("+/") and set(run) & set("-_")):
        return [(0, len(run))]
    found = {m.span(): None for outside in ("+/", "_-", "+/_-") for m in re.finditer(rf"[^{outside}]{{{MIN_LENGTH},}}", run)}
    return sorted(found)


def pearson(codes: np.ndarray, size: int) -> float:
    counts = np.bincount(codes, minlength=size)
    return float(size * (counts**2).sum() / len(codes) - len(codes))


def uniformity_p(x2: float, n: int, size: int) -> float:
    """P of a statistic of ``x2`` or more under uniform characters."""
    mean, var = size - 1, 2 * (size - 1) * (1 - 1 / n)
    shape = mean * mean / var  # gamma with these moments, by Wilson and Hilferty's cube root
    z = ((max(x2, 0) / mean) ** (1 / 3) - (1 - 1 / (9 * shape))) * 3 * math.sqrt(shape)
    return 0.5 * math.erfc(z / math.sqrt(2))


def runs_p(codes: np.ndarray, size: int) -> float:
    """Two-sided P of the number of runs below and above the middle code."""
    high = codes >= size / 2
    n, n1 = len(codes), int(high.sum())
    n2 = n - n1
    if not n1 or not n2:
        return 2.0 ** (1 - n)
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 1 + 2 * n1 * n2 / n
    var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    return math.erfc(abs(runs - mean) / math.sqrt(2 * var))


def serial_p(codes: np.ndarray) -> float:
    """Two-sided P of the lag-1 serial correlation."""
    x = codes - codes.mean()
    total = float((x * x).sum())
    if not total:
        return 0.0
    n = len(codes)
    r = float((x[1:] * x[:-1]).sum()) / total
    return math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2))


def random_p(codes: np.ndarray, x2: float, size: int) -> float:
    """Bonferroni's P of the battery under randomness."""
    return min(1.0, 3 * min(uniformity_p(x2, len(codes), size), runs_p(codes, size), serial_p(codes)))


def text_log_p(x2: float, n: int, size: int, s2: float, s3: float) -> float:
    """Minus log10 P of a statistic of ``x2`` or less under characters whose
    probabilities have the second and third power sums ``s2`` and ``s3``."""
    mean = size + size * (n - 1) * s2 - n
    pairs = n * (n - 1)
    var = (size / n) ** 2 * (2 * pairs * s2 + 4 * pairs * (n - 2) * s3 - 2 * pairs * (2 * n - 3) * s2 * s2)
    if var <= 0:
        return 0.0
    z = (mean - x2) / math.sqrt(2 * var)
    p = 0.5 * math.erfc(z)
    return -math.log10(p) if p > 1e-300 else 300.0


def candidates(text: str) -> list[dict]:
    """Candidates with encoding, statistic and the battery's P, in order."""
    out = []
    for m in _RUN.finditer(text):
        run = m[0].rstrip("=")
        for start, end in key_parts(run):
            token = run[start:end]
            name = infer_encoding(token)
            if name is None:
                continue
            code = _CODES[name]
            folded = token.lower() if name in _FOLDED else token
            codes = np.array([code[c] for c in folded])
            x2 = pearson(codes, len(code))
            upto = m.end() if end == len(run) else m.start() + end
            out.append({"start": m.start() + start, "end": upto, "encoding": _NAMES.index(name), "length": len(token), "x2": x2, "random_p": random_p(codes, x2, len(code))})
    return out


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.LongType())]))
_CANDIDATE = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("start", "end")]
    + [T.StructField(n, T.IntegerType()) for n in ("encoding", "length")]
    + [T.StructField(n, T.DoubleType()) for n in ("x2", "random_p")]
)


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` its ``doc_id``, base spans and candidates, and, once
    per Arrow batch, the counts of the 128 ASCII characters in its texts."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("base", _SPAN), T.StructField("candidates", T.ArrayType(_CANDIDATE)), T.StructField("characters", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts = np.zeros(256, dtype=np.int64)
            for t in texts:
                counts += np.bincount(np.frombuffer(t.encode(), np.uint8), minlength=256)
            spans = [[{"start": s, "kind": k, "end": e} for s, k, e in base_spans(t)] for t in texts]
            first = [counts[:128].tolist()] + [None] * (len(texts) - 1)
            columns = [batch.column(0), pa.array(spans, arrow.field(1).type), pa.array([candidates(t) for t in texts], arrow.field(2).type), pa.array(first[: len(texts)], arrow.field(3).type)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return python_ready(docs).select("doc_id", "text").mapInArrow(run, schema)


def alphabet_sums(characters: dict[int, int]) -> list[tuple[float, float]]:
    """Second and third power sums of the corpus's character probabilities
    within each alphabet; each character counts once more than it occurs."""
    out = []
    for name, alphabet in _ALPHABETS.items():
        counts = []
        for c in alphabet:
            both = {c, c.upper()} if name in _FOLDED else {c}
            counts.append(1 + sum(characters.get(ord(x), 0) for x in both))
        q = np.array(counts, dtype=float) / sum(counts)
        out.append((float((q**2).sum()), float((q**3).sum())))
    return out


def accepted_bins(scored: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Least accepted bin of minus log10 P for each class of length, by the
    step-up procedure; classes that accept nothing are absent. Bins are counted
    before the window, which then sees at most 300,001 rows per class."""
    tests = scored.select(F.inline("tests")).where(F.col("random_p") >= ALPHA)
    binned = tests.groupBy("class", "bin").agg(F.count(F.lit(1)).alias("n"))
    up_to = F.sum("n").over(Window.partitionBy("class").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy("class"))
    steps = binned.select("class", "bin", up_to.alias("up_to"), total.alias("total"))
    passed = steps.where(F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE) * F.col("total") <= fdr * F.col("up_to"))
    return {r["class"]: r["bin"] for r in passed.groupBy("class").agg(F.min("bin").alias("bin")).collect()}


def added_spans(base: list[dict], found: list[dict], tests: list[dict], least: dict[int, int]) -> list[dict]:
    """Accepted candidates apart from the base spans. Of those that overlap
    (parts of one run) the one least like text is taken, then the next that
    overlaps none taken."""
    starts = [s["start"] for s in base]
    ends = list(itertools.accumulate((s["end"] for s in base), max))
    ok = []
    for c, t in zip(found, tests, strict=True):
        before = bisect.bisect_left(starts, c["end"])
        if t["random_p"] >= ALPHA and t["bin"] >= least.get(t["class"], math.inf) and not (before and ends[before - 1] > c["start"]):
            ok.append((c["start"], c["end"], t["bin"]))
    taken, chain, upto = [], [], 0
    for c in [*sorted(ok), (math.inf, math.inf, 0)]:
        if c[0] >= upto:
            apart: list[tuple] = []
            for x in sorted(chain, key=lambda x: (-x[2], x[0], -x[1])):
                if all(x[1] <= y[0] or x[0] >= y[1] for y in apart):
                    apart.append(x)
            taken += apart
            chain = []
        chain.append(c)
        upto = max(upto, c[1])
    return [{"start": start, "kind": len(KINDS), "end": end} for start, end, _ in taken]


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (arrays of ``start, kind, end``, code points, end
    exclusive, by start, then kind) for each row of ``docs`` (columns
    ``doc_id`` and ``text``; others are not read).

    Kinds 0 to 2 are ``KINDS``, kind 3 is the method's, which adds no span that
    overlaps a base one. Null and empty texts have no spans; repeated rows are
    reported alike, and count as often in the corpus statistics; an empty table
    gives an empty result. The texts are read once; what is written and read
    again are spans and candidates only. 128 character counts and six
    thresholds come to the driver.
    """
    found = written(scan(docs), "secrets-scan")
    characters = {r["at"]: r["n"] for r in found.where("characters IS NOT NULL").select(F.posexplode("characters").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()}
    sums = alphabet_sums(characters)
    test = T.StructType([T.StructField("class", T.IntegerType()), T.StructField("bin", T.IntegerType()), T.StructField("random_p", T.DoubleType())])
    schema = T.StructType([*found.schema.fields[:3], T.StructField("tests", T.ArrayType(test))])
    arrow = to_arrow_schema(schema)
    sizes = [len(a) for a in _ALPHABETS.values()]

    def score(c: dict) -> dict:
        log_p = text_log_p(c["x2"], c["length"], sizes[c["encoding"]], *sums[c["encoding"]])
        length_class = sum(c["length"] >= least for least in LENGTH_CLASSES)
        return {"class": length_class, "bin": math.floor(log_p * BINS_PER_DECADE), "random_p": c["random_p"]}

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tests = [[score(c) for c in row] for row in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tests, arrow.field(3).type)], schema=arrow)

    scored = written(found.drop("characters").mapInArrow(score_batches, schema), "secrets-tests")
    least = accepted_bins(scored, fdr)
    out = T.StructType([*scored.schema.fields[:2], T.StructField("spans", _SPAN)])
    arrow_out = to_arrow_schema(out)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)
            spans = [sorted([*base, *added_spans(base, of, tests, least)], key=lambda s: (s["start"], s["kind"], s["end"])) for base, of, tests in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, arrow_out.field(2).type)], schema=arrow_out)

    return scored.mapInArrow(select, out)
