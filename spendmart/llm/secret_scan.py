"""Secrets in texts: fixed patterns, and strings that compress badly where secrets are spoken of.

Fixed patterns find assignments, access keys and long hex strings. Beyond them, every candidate string
that follows a sensitive word is compressed with zstandard twice: primed with a dictionary of the
corpus's identifiers, and primed with the rest of its own text. What it adds in bytes, as a share of its
own, says how new it is: known words cost a few bytes each, word-like letters compress by the
dictionary's letter table, names from around cost little, random strings cost nearly all their bytes.
A candidate that is new to both is reported as ``novel``.

The dictionary is trained on the ``WORDS`` commonest words of all texts (each task counts its own
first), and how new a string must be is learned as well, by length: words and compounds of words kept
out of a first dictionary show how new ordinary names of that length look.

Defined results: a null or empty text has no spans, and the hash of an empty string; spans of one
kind don't overlap; spans that start together are in the order of ``KINDS``; a novel span never overlaps
another span; texts and candidates are read whole however long; a corpus of too few words for training
is its own dictionary; an empty table gives an empty result; repeated rows get equal results; columns
other than the text are left as they are.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendmart.llm.common import lean
from spendmart.staging import staged

KINDS = ("assign", "access", "hex", "novel")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_HEX_AS_X = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
_SPOKEN = ("passw", "pwd", "secret", "token", "credential", "bearer", "authoriz", "key")
_SENSITIVE = re.compile(
    r"(?i:passwords?|passwd|pwd|secrets?|tokens?|credentials?|bearer|authorization|private[_ -]key|"
    r"(?:api|access|auth|secret|encryption|signing)[_ -]?keys?)[^A-Za-z0-9+/=\n]{1,8}"
    r"(?:(?:is|was|for|to|value)[^A-Za-z0-9+/=\n]{1,4}){0,2}([A-Za-z0-9+/_=-]{8,})",
    re.A,
)
_WORD = re.compile(r"[A-Za-z][A-Za-z0-9_]+", re.A)
# Names that code around secrets is full of, whatever the corpus: they follow the learned dictionary.
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key secret_key private_key public_key client_id "
    "client_secret authorization bearer credential credentials username user_name account email config "
    "environment variable default example placeholder changeme your_token_here your-api-key-here localhost "
    "database connection string value return function import export const static public private protected "
    "class self this null none true false undefined required optional string integer boolean object array "
    "request response header content application json http https www com org net index main test testing "
    "production development staging service server client session cookie login logout register authenticate "
    "validate generate random encrypt decrypt encode decode base64 sha256 hash digest signature certificate "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 xxxxxxxxxxxxxxxx 0000000000000000"
).encode()
#: Words that the dictionary is trained on, its bytes, and the levels of compression.
WORDS, DICTIONARY = 32_768, 65_536
LEVEL, TEXT_LEVEL = 19, 3
#: Different words that a task holds before it hands their counts on.
HELD = 1 << 20
#: One word in so many is kept out of the first dictionary, to see how new such words look.
KEPT_OUT = 8
#: Words in a carrier, and how new a string must be to the rest of its text.
CARRIER, BESIDE = 128, 0.5
#: Lengths up to which thresholds are learned one by one, the share of ordinary names that must lie
#: below them, and bounds: a string of no pattern adds about all its bytes, and no name counts as one
#: that adds half.
LONGEST, ORDINARY, LEAST_NEW, MOST_NEW = 64, 0.98, 0.5, 0.95

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Spans of the three fixed patterns, in code points."""
    found: list[Span] = []
    lower = text.lower()
    if any(word in lower for word in _KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if b"x" * 32 in text.encode("utf-8", "replace").translate(_HEX_AS_X):
        found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


def _compressor(content: bytes, level: int, kind: int = zstandard.DICT_TYPE_AUTO) -> zstandard.ZstdCompressor:
    """Tables and window are large enough for all of ``content``: its beginning counts like its end."""
    size = min(max(len(content).bit_length() + 1, 17), 27)
    tables = {"hash_log": size, "chain_log": size} if level == TEXT_LEVEL else {}
    settings = zstandard.ZstdCompressionParameters.from_level(
        level,
        window_log=size,
        **tables,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    primer = zstandard.ZstdCompressionDict(content, dict_type=kind)
    return zstandard.ZstdCompressor(dict_data=primer, compression_params=settings)


class Measure:
    """How many bytes a candidate adds to a carrier of ordinary names, as a share of its own.

    The carrier pays for headers and tables, so that even short candidates are measured by their
    letters and by what they repeat.
    """

    def __init__(self, content: bytes, level: int, carrier: bytes, kind: int = zstandard.DICT_TYPE_AUTO):
        self.compressor, self.carrier = _compressor(content, level, kind), carrier + b" "
        self.bare = len(self.compressor.compress(self.carrier))

    def __call__(self, candidate: str) -> float:
        own = candidate.encode()
        return (len(self.compressor.compress(self.carrier + own)) - self.bare) / len(own)


def _trained(words: list[str]) -> bytes:
    """A dictionary of these words; themselves, if they are too few to train one."""
    samples = [" ".join(words[i : i + 16]).encode() for i in range(0, len(words), 16)]
    try:
        content = zstandard.train_dictionary(DICTIONARY, samples, k=64, d=6).as_bytes()
    except zstandard.ZstdError:
        content = b" ".join(samples)
    return content + b" " + IDENTIFIERS  # what a dictionary ends with is its content


@dataclass(frozen=True)
class Identifiers:
    """The learned dictionary, a carrier, and how new a string of each length must be."""

    content: bytes
    carrier: bytes = b""
    least: tuple[float, ...] = field(default=())

    def threshold(self, length: int) -> float:
        return self.least[min(length, len(self.least) - 1)] if self.least else MOST_NEW


def _names(words: list[str]) -> Iterator[str]:
    """Names as they are made of words: alone, and two to five together in several spellings."""
    yield from words
    for n in range(2, 6):
        for i in range(0, len(words) - n + 1, n):
            some = words[i : i + n]
            yield from ("".join(some), "_".join(some), some[0] + "".join(w.capitalize() for w in some[1:]))


def learn(words: list[str]) -> Identifiers:
    """From words, the commonest first."""
    kept_out = words[::KEPT_OUT]
    carrier = " ".join(kept_out[:: len(kept_out) // CARRIER + 1]).encode()
    first = Measure(_trained([w for i, w in enumerate(words) if i % KEPT_OUT]), LEVEL, carrier)
    seen: dict[int, list[float]] = {}
    for name in _names(kept_out):
        if 8 <= len(name) <= LONGEST:
            seen.setdefault(len(name), []).append(first(name))
    least, near = [MOST_NEW] * (LONGEST + 1), MOST_NEW
    for n in range(8, LONGEST + 1):
        # neighbouring lengths count as well: each alone has few names
        values = [x for m in (n - 1, n, n + 1) for x in seen.get(m, [])]
        if len(values) >= 200:
            near = float(np.quantile(values, ORDINARY)) + 0.5 / n
        least[n] = min(max(near, LEAST_NEW), MOST_NEW)
    return Identifiers(_trained(words), carrier, tuple(least))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.update(_WORD.findall(text or ""))
            if len(held) > HELD:
                yield rows()
                held.clear()
    if held:
        yield rows()


def identifiers(docs: DataFrame, text_col: str = "text") -> Identifiers:
    """Learned from all texts of ``docs``; the driver sees ``WORDS`` words at most."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(lean(_count_words), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    # counts in eighths of a power of two: few values, in the counts' order
    sized = staged(counted.withColumn("size", F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")), "identifier-counts")
    least, held = 1 << 30, 0
    for size, n in sorted(sized.groupBy("size").count().collect(), reverse=True):  # some hundred rows at most
        if held + n > WORDS:
            break
        least, held = size, held + n
    found = sized.where(F.col("size") >= least).select("word", "n").collect()
    return learn([row["word"] for row in sorted(found, key=lambda r: (-r["n"], r["word"]))])


@lru_cache(2)
def _primed(content: bytes, carrier: bytes) -> Measure:
    """One per worker process."""
    return Measure(content, LEVEL, carrier)


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Strings that follow a sensitive word and overlap no span of ``taken``."""
    lower = text.lower()
    if not any(word in lower for word in _SPOKEN):
        return []
    starts, reach = [s[0] for s in taken], []
    for _, end, _ in taken:
        reach.append(max(end, reach[-1] if reach else 0))
    found = []
    for m in _SENSITIVE.finditer(text):
        a, b = m.span(1)
        i = bisect_right(starts, b - 1)
        if not (i and reach[i - 1] > a):
            found.append((a, b))
    return found


def novel_spans(text: str, taken: list[Span], known: Identifiers) -> list[Span]:
    asked = candidates(text, taken)
    if not asked:
        return []
    primed = _primed(known.content, known.carrier)
    new = [(a, b) for a, b in asked if primed(text[a:b]) >= known.threshold(b - a)]
    if not new:
        return []
    # the rest of the text, with what was asked about blanked out; eight bytes make a dictionary at least
    parts, at = [], 0
    for a, b in asked:
        parts += [text[at:a], " "]
        at = b
    around = "".join([*parts, text[at:], " " * 8]).encode("utf-8", "replace")
    beside = Measure(around, TEXT_LEVEL, known.carrier, zstandard.DICT_TYPE_RAWCONTENT)
    return [(a, b, "novel") for a, b in new if beside(text[a:b]) >= BESIDE]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(text: str | None, known: Identifiers) -> tuple[int, int, int, int, str, str]:
    """Counts of the four kinds, the hash of the base spans, all spans."""
    base = base_spans(text) if text else []
    more = novel_spans(text, base, known) if text else []
    of = [sum(s[2] == kind for s in base) for kind in KINDS[:3]]
    return (*of, len(more), hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + more, key=_order)))


_TYPE = "struct<n_assign:bigint,n_access:bigint,n_hex:bigint,n_novel:bigint,base_sha256:string,spans:string>"


def secrets_column(text: Column, known: Identifiers) -> Column:
    """A struct: counts of each kind, base_sha256, spans (kind:start:end by start, comma-joined)."""

    def find(texts: pa.Array) -> pa.Array:
        columns = list(zip(*(scan(t, known) for t in texts.to_pylist()))) or [()] * 6
        types = [pa.int64()] * 4 + [pa.string()] * 2
        names = ["n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return F.arrow_udf(find, _TYPE)(text.cast("string"))
