"""Secret scans: fixed patterns, and novelty under dictionary-primed zstandard.

Method: a candidate is a long run of token characters, or a long enough part of one outside the spans of
the fixed patterns, before which something sensitive is named. Its
marginal size is what it adds to the compressed size of its surroundings, with zstandard primed by a
dictionary of common identifiers: text that resembles identifiers or the code around it adds little, a
random string adds nearly its own length. Passages of the candidate that stand in its surroundings or
earlier in itself are left out first, or each copy would hide the others. Candidates that add at least
NOVEL bytes a character (LONG_NOVEL from LONG characters on) are reported as `novel`, with every other
copy of them in the text; spans of the fixed patterns are always reported.

Cases: null text counts as empty and has no spans; repeated rows give repeated rows; an empty table gives
an empty result; extra columns are left alone. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAD = ("passw", "secret", "token", "api")
#: Words that make a surrounding sensitive.
SENSITIVE = re.compile(r"key|auth|bearer|credential|private|secret|token|passw|session|cookie|signature|salt|cert|access", re.I | re.A)
#: Fewest characters of a candidate.
LEAST = 20
#: Names end at "=" and ":"; padding belongs to a candidate.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.-]{%d,}={0,2}" % LEAST)
#: Characters before a candidate in which a sensitive word must stand; those on either side that prime its
#: compression. Both are parameters of the operator; the README has what other values find.
NEAR, AROUND = 64, 1024
#: Characters of the shortest passage that counts as a copy.
COPY = 16
#: Compressed bytes a character from which a candidate is novel: random strings add about one, and long ones
#: of few letters down to 0.47; names are short and mostly add less. The README has measured recall and false reports.
NOVEL, LONG, LONG_NOVEL = 0.75, 64, 0.45
# Common identifiers of code and configuration.
IDENTIFIERS = (
    "access account action active address admin alias allow api app application argument array async attribute auth author "
    "backend backup base batch block body boolean branch bucket buffer build byte cache callback category certificate channel "
    "character check child class client cluster code collection column command comment commit component config connection "
    "console constant container content context controller convert cookie copy core count create credential current customer "
    "data database date debug default delete description destination device dictionary directory document domain download "
    "element email enable encode encoding endpoint engine entity entry enum environment error event example exception execute "
    "export extension factory feature field file filter first flag folder format frame function generate global group handler "
    "hash header height host html http https icon image implementation import index info initialize input insert instance "
    "integer interface internal item iterator json key label language last layout length level library limit line link list "
    "listener load local location log logger login lower main manager map master match message metadata method metric model "
    "module monitor name namespace network node null number object offset operation option order output owner package page "
    "parameter parent parse password path pattern payload permission plugin policy pool port position prefix previous primary "
    "private process profile project property protocol provider proxy public query queue random range read record reference "
    "region register release remote remove render replace repository request resource response result retry return role root "
    "route row runtime scale schedule schema scope script search secret section select selector send sequence serial server "
    "service session setting setup shard shared signature single size socket sort source stack start state static status step "
    "storage store stream string struct style submit subnet success suffix sync system table tag target task template test text "
    "thread time timeout timestamp title token total trace track transaction transform type unique unit update upload url user "
    "utility valid validate value variable vector version view virtual volume warning web width window worker workspace write"
)


@lru_cache(maxsize=1)
def _compressor():
    import zstandard

    # Names come in lower, title and upper case; matches of three characters let short words count.
    spelt = " ".join([IDENTIFIERS, IDENTIFIERS, IDENTIFIERS.title(), IDENTIFIERS.upper()]).encode()
    primed = zstandard.ZstdCompressionDict(spelt, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(13, min_match=3), dict_data=primed)


def novelty(candidate: str, around: str) -> float:
    """Compressed bytes that the candidate adds to its surroundings, for each of its characters."""
    packed = _compressor()
    base = around.encode("utf-8", "surrogatepass")
    extra = candidate.encode("utf-8", "surrogatepass")
    return (len(packed.compress(base + b"\n" + extra)) - len(packed.compress(base + b"\n"))) / max(1, len(extra))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    out = []
    low = text.lower()
    if any(x in low for x in LEAD):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _grams(word: str) -> set[str]:
    return {word[i : i + COPY] for i in range(len(word) - COPY + 1)}


def surroundings(text: str, start: int, end: int, around: int = AROUND) -> str:
    """`around` characters before and after the candidate, without passages that also stand in it."""
    grams, out = _grams(text[start:end]), []
    for low, high in ((max(0, start - around), start), (end, min(len(text), end + around))):
        # Copies that the bounds cut are seen whole; none goes into the candidate itself.
        first, last = (max(0, low - (end - start)), high) if high == start else (low, min(len(text), high + end - start))
        keep = bytearray(b"\1") * (last - first)
        for i in range(first, last - COPY + 1):
            if text[i : i + COPY] in grams:
                keep[i - first : i - first + COPY] = bytes(COPY)
        out += [text[i] for i in range(low, high) if keep[i - first]]
    return "".join(out)


def without_repeats(word: str) -> str:
    """The word without passages that stand earlier in it, where enough is left to measure."""
    seen: set[str] = set()
    keep = bytearray(b"\1") * len(word)
    for i in range(len(word) - COPY + 1):
        gram = word[i : i + COPY]
        if gram in seen:
            keep[i : i + COPY] = bytes(COPY)
        seen.add(gram)
    fresh = "".join(c for c, k in zip(word, keep) if k)
    return fresh if len(fresh) >= LEAST else word


def outside(start: int, end: int, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of a range that no span, by start, covers."""
    out = []
    for s, _, e in spans:
        if s >= end:
            break
        if e > start:
            if s > start:
                out.append((start, s))
            start = max(start, e)
    return out + [(start, end)] if start < end else out


def with_copies(text: str, base: list[tuple[int, int, int]], found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The found spans and all other copies of their strings, as far as no span covers them."""
    for word in sorted({text[s:e] for s, _, e in found}, key=lambda w: (-len(w), w)):
        taken = sorted(base + found)
        at = text.find(word)
        while at >= 0:
            found = found + [(s, 3, e) for s, e in outside(at, at + len(word), taken)]
            at = text.find(word, at + len(word))
    return sorted(found)


def novel_spans(text: str, base: list[tuple[int, int, int]], near: int = NEAR, around: int = AROUND) -> list[tuple[int, int, int]]:
    """Sensitive, incompressible strings outside the base spans."""
    out: list[tuple[int, int, int]] = []
    if not SENSITIVE.search(text):
        return out
    for m in CANDIDATE.finditer(text):
        for start, end in outside(*m.span(), base):
            if end - start < LEAST or not SENSITIVE.search(text, max(0, m.start() - near), start):
                continue
            word = without_repeats(text[start:end])
            if novelty(word, surroundings(text, start, end, around)) >= (LONG_NOVEL if len(word) >= LONG else NOVEL):
                out.append((start, 3, end))
    return with_copies(text, base, out) if out else out


def all_spans(text: str, near: int = NEAR, around: int = AROUND) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and those with the novel ones, each by start and then kind."""
    base = base_spans(text)
    return base, sorted(base + novel_spans(text, base, near, around))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]], put: str = "[REDACTED]") -> str:
    """The text with every span, overlapping ones as one, replaced."""
    out, at = [], 0
    for start, _, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], put]
        at = end
    return "".join(out) + text[at:]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near: int = NEAR, around: int = AROUND) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans.

    near: characters before a candidate in which a sensitive word must stand; around: those on either side of
    it that its novelty is measured against."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("secrets")
        for batch in batches:
            found = [all_spans(t, near, around) for t in batch.column(1).to_pylist()]
            counts = {f"n_{name}": pa.array([sum(x[1] == k for x in every) for _, every in found], pa.int64()) for k, name in enumerate(KINDS)}
            digests = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), **counts, "base_sha256": digests, "spans": pa.array([joined(every) for _, every in found])})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")


def redact_secrets(docs: DataFrame, text_col: str = "text", near: int = NEAR, around: int = AROUND) -> DataFrame:
    """docs with every found secret replaced in its text; null texts and all other columns stay as they are.

    Every row stays, repeated ones too; empty texts stay empty; an empty table stays empty."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("secrets")
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [None if t is None else redact(t, all_spans(t, near, around)[1]) for t in batch.column(at).to_pylist()]
            cols = list(batch.columns)
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(run, schema)
