"""Secrets in texts: fixed patterns, and strings that a tokenizer finds hard to shorten.

Random keys have few characters per token under a vocabulary of natural text. Unbroken
strings with a letter are encoded, with digits or without; those with a low ratio are secrets
unless they are known digests or identifiers.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.llm.words import kept_and_text, pieces
from rareclass.llm.workers import bound_batches, held

# The base patterns. Letters of the words before an assignment count in either case.
_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_ASSIGN_LEAST = 6
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # runs are maximal, so a bound is the same as dropping short ones
_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ["assign", "access", "hex", "random"]
_WORDS = re.compile(r"(?i:password|passwd|secret|token|api_?key)", re.A)

# Digest lengths in hexadecimal digits, and shapes of identifiers.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
# Words of one case, capitalised or in camel case, joined by separators. Below _SHORT characters
# any part of a name may hold a number. A single word is no name: its ratio decides.
_PART = r"(?:(?:[A-Z]?[a-z]{2,})(?:[A-Z][a-z]{2,})*|[A-Z]+|[a-z])"
_NAME = re.compile(rf"[_/=+-]*{_PART}(?:[_/=+-]+{_PART})+[_/=+-]*[0-9]{{0,4}}|[_/=+-]+{_PART}[_/=+-]*[0-9]{{0,4}}"
                   rf"|{_PART}[_/=+-]+[0-9]{{0,4}}")
_SHORT_NAME = re.compile(rf"[_/=+-]*(?:{_PART}[0-9]{{0,4}}|[0-9]{{1,4}}[a-z]?)"
                         rf"(?:[_/=+-]+(?:{_PART}[0-9]{{0,4}}|[0-9]{{1,4}}[a-z]?))+[_/=+-]*")
_SHORT = 20
_NUMBER = re.compile(r"[0-9]+[eE][+-]?[0-9]+|[0-9]{4}-?[0-9]{2}-?[0-9]{2}T[0-9]{2,6}Z?")
_ONE_CASE = re.compile(r"[A-Z]?[a-z]*[0-9]{0,4}|[A-Z]+[0-9]{0,4}")


@dataclass(frozen=True)
class SecretConfig:
    """``vocabulary`` is a tiktoken rank file and ``pattern`` its split pattern.

    A string of at least ``least`` characters is random if it has fewer than ``ratio``
    characters per token and at least one letter. A single word of one case, which may end
    in up to four digits, must have ``least_word`` characters: shorter compounds of natural
    text reach such ratios.
    """

    vocabulary: str
    pattern: str
    least: int = 16
    least_word: int = 20
    ratio: float = 2.0


def _candidates(least: int) -> re.Pattern:
    return re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % least, re.A)


def _excluded(text: str) -> bool:
    """Known digests and identifiers."""
    return ((len(text) in DIGEST_LENGTHS and _DIGEST.fullmatch(text) is not None)
            or _UUID.fullmatch(text) is not None or _NAME.fullmatch(text) is not None
            or len(text) < _SHORT and _SHORT_NAME.fullmatch(text) is not None
            or _NUMBER.fullmatch(text) is not None or not any(c.isalpha() for c in text)
            # Rulers, numerals and sequences of bases: random letters have more distinct ones.
            or text.isalpha() and len(set(text)) < 8)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns; kinds are indexes of ``KINDS``."""
    found = []
    if _WORDS.search(text):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= _ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return found


def covered(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Maximal stretches ``(start, end)`` of sorted spans."""
    out: list[tuple[int, int]] = []
    for start, _, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


class Scanner:
    def __init__(self, config: SecretConfig):
        import tiktoken

        with open(config.vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("secrets", pat_str=config.pattern, mergeable_ranks=ranks, special_tokens={})
        self.config, self.pattern = config, _candidates(config.least)

    def random_spans(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Random strings, but for those that lie in stretches of base spans (sorted) as a whole."""
        found, stretches, at = [], covered(base), 0
        for m in self.pattern.finditer(text):
            while at < len(stretches) and stretches[at][1] < m.end():
                at += 1
            inside = at < len(stretches) and stretches[at][0] <= m.start()
            if inside or len(m[0]) < self.config.least_word and _ONE_CASE.fullmatch(m[0]) or _excluded(m[0]):
                continue
            if len(m[0]) < self.config.ratio * len(self.encoding.encode_ordinary(m[0])):
                found.append((m.start(), 3, m.end()))
        return found

    def spans(self, text: str) -> tuple[list, list]:
        base = sorted(base_spans(text))
        return base, sorted(base + self.random_spans(text, base))


def scanner_of(config: SecretConfig) -> Scanner:
    """One encoding per worker process."""
    return held(("secrets", config), lambda: Scanner(config))


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every maximal stretch of spans replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, config: SecretConfig, keep: list[str] | None = None) -> DataFrame:
    """Counts, spans and the redacted text of every row, beside the columns in ``keep``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind, joined
    by commas. A null text is empty. Rows do not depend on each other: ids may be null or repeat.
    ``redacted`` is null where nothing was found.
    """
    keep = ["doc_id"] if keep is None else keep
    bound_batches(docs.sparkSession)
    source, own = kept_and_text(docs, keep)
    names = ["n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans", "redacted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = scanner_of(config)
        for piece in pieces(batches, "text"):
            columns: list[list] = [[] for _ in names]
            for text in piece.column("text").to_pylist():
                text = text or ""
                base, spans = scanner.spans(text)
                counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)] if spans else [0] * 4
                row = [*counts, hashlib.sha256(_told(base).encode()).hexdigest(), _told(spans),
                       redacted(text, spans) if spans else None]
                for column, value in zip(columns, row):
                    column.append(value)
            types = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [piece.column(c) for c in own] + [pa.array(c, t) for c, t in zip(columns, types)], names=own + names)

    out = source.select(*own).schema
    for name in names:
        out = out.add(name, "long" if name.startswith("n_") else "string")
    return source.mapInArrow(run, out).select(*[F.col(n).alias(c) for c, n in zip(keep, own)], *names)
