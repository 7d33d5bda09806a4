"""Secret scans: fixed patterns, and guess costs of values in a credential context.

Three base patterns (assignments, access keys, long hex runs) are always found.
Beyond them, every value that stands in a credential context (a keyword, then ``:``,
``=``, ``=>`` or ``is``) is judged by how many guesses it takes: the cheapest
segmentation into words, dates, repeats, keyboard walks and brute force.  Values of
``COSTLY`` powers of ten or more are spans of kind ``costly``; placeholders such as
``your_password_here`` or ``qwertyuiop123`` fall below.

Texts go to Python as Arrow batches; a text without a keyword, key head or hex run
is left at once, on its bytes.

Defined results: null text counts as empty and has no spans; a null doc_id stays null;
rows may repeat; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import text_of
from candela.llm.guess_cost import segments

KINDS = ("assign", "access", "hex", "costly")
ASSIGN = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Wider than the base pattern: more keywords, and any characters up to space or quote.
CONTEXT = re.compile(
    r"(?i:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth(?:orization)?|bearer|"
    r"(?:api|access|private|client|signing)[_-]?key)[\"']?(?:[\x20\t]*(?:=>|[:=])|[\x20\t]+is(?=[\x20\t]))[\x20\t]*"
    r"[\"']?(?:(?i:bearer|basic)[\x20\t]+)?([^\s\"'`,;<>]{6,})", re.ASCII)
KEYWORDS = (b"pass", b"pwd", b"secret", b"token", b"credential", b"auth", b"bearer", b"key")
#: Powers of ten; eight random letters and digits take about eleven.
COSTLY = 10.0
_HEX_MAP = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_HEX_RUN = b"x" * LEAST["hex"]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns' matches, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST["assign"]]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(found)


def costly_spans(text: str, costly: float = COSTLY) -> list[tuple[int, int, int, float]]:
    """(start, kind number, end, cost) of context values that take ``costly`` powers of ten of guesses."""
    found = {}
    for pattern in (ASSIGN, CONTEXT):
        for m in pattern.finditer(text):
            value = m[1].rstrip(".)]}")
            if len(value) >= 6 and (m.start(1), m.start(1) + len(value)) not in found:
                cost = segments(value)[0]
                if cost >= costly:
                    found[m.start(1), m.start(1) + len(value)] = cost
    return [(a, 3, b, c) for (a, b), c in sorted(found.items())]


def _named(spans) -> str:
    return ",".join(f"{KINDS[x[1]]}:{x[0]}:{x[2]}" for x in spans)


def scan(raw: bytes, costly: float = COSTLY) -> dict | None:
    """What a text (UTF-8) holds; None if nothing."""
    low = raw.lower()
    context = any(k in low for k in KEYWORDS)
    if not (context or b"AKIA" in raw or _HEX_RUN in raw.translate(_HEX_MAP)):
        return None
    text = raw.decode("utf-8", "replace")
    base = base_spans(text)
    more = costly_spans(text, costly) if context else []
    return {"counts": [sum(x[1] == k for x in base) for k in range(3)], "base": _named(base),
            "spans": _named(sorted([*base, *((a, k, b) for a, k, b, _ in more)])),
            "costly": [{"start": a, "end": b, "cost": c} for a, _, b, c in more]}


def secret_report(docs: DataFrame, costly: float = COSTLY) -> DataFrame:
    """One row per document: n_assign, n_access, n_hex, base_sha256, spans, costly (start, end, cost)."""
    kind = pa.struct([("counts", pa.list_(pa.int64())), ("base_sha256", pa.string()), ("spans", pa.string()),
                      ("costly", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                                     ("cost", pa.float64())])))])
    nothing = {"counts": [0, 0, 0], "base": "", "spans": "", "costly": []}

    @F.arrow_udf("struct<counts: array<long>, base_sha256: string, spans: string,"
                 " costly: array<struct<start: long, end: long, cost: double>>>")
    def scanned(texts: pa.Array) -> pa.Array:
        found = (scan(x, costly) or nothing for x in texts.cast(pa.binary()).to_pylist())
        return pa.array([{**x, "base_sha256": hashlib.sha256(x["base"].encode()).hexdigest()}
                         for x in found], kind)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scanned(text_of()).alias("s"))
    return found.select("doc_id", *[F.col("s.counts")[i].alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
                        "s.base_sha256", "s.spans", "s.costly")
