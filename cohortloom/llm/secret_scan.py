"""Secrets in whole texts, found through a trigram inverted index.

Each rule is a regular expression. From its parse tree follows a Boolean query of trigrams that
every match must contain: literal runs are conjunctions of trigrams, alternatives disjunctions.
Every task indexes its batch of documents by the trigrams that any query names (lower-cased), the
postings are intersected and united as the query says, and the rule's expression verifies the
documents that remain. A rule without mandatory trigrams is matched against every document.
The index is split by documents, so it needs no shuffle and its size is bounded by the batch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.stored import quoted
from cohortloom.llm.words import parts, text_bytes

# Kind, expression, fewest characters (of group 2 if the rule has two groups).
BASE_RULES = (
    ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    ("access", r"AKIA[A-Z0-9]+", 16),
    ("hex", r"[0-9a-f]+", 32),
)
# A private key is its header with all up to the matching END line or, if another armor or the text's end
# comes first, with the header fields and base64 lines that follow (line breaks may be written as \\n).
_KEY = r"(?:(?:RSA|EC|DSA|OPENSSH|PGP|ENCRYPTED) )?PRIVATE KEY(?: BLOCK)?-----"
_BREAK = r"""(?:[\s"'+,>|#*;]|\\[nr])"""
_BODY = (rf"(?:{_BREAK}+(?:(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID): ?[^\n\\]*|[A-Za-z0-9+/]{{20,}}={{0,2}}))*+"
         r"(?:(?<=[A-Za-z0-9+/]{20})[\"']?(?:\r?\n|\\n)[^\S\n]*[\"']?[A-Za-z0-9+/]{1,76}={0,2}(?=[\"']?(?:\s*\n|\\n|\s*\Z)))?")
MORE_RULES = (
    ("private_key", rf"-----BEGIN {_KEY}(?:(?:(?!-----)[\s\S])*+-----END {_KEY}|{_BODY})", 20),
    ("github", r"gh[opsur]_[A-Za-z0-9]+", 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    ("google", r"AIza[0-9A-Za-z_-]+", 39),
    ("stripe", r"[rs]k_live_[0-9A-Za-z]+", 24),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 30),
    ("url_login", r"://[^\s:/@\"'<>]{1,64}:[^\s:/@\"'<>]{3,64}@", 8),
)
MARK = "[secret]"
_MOST_STRINGS = 64

# A query is a list of clauses that must all hold; a clause is a set of alternatives, each a
# frozenset of trigrams that must all occur. No clause: no mandatory trigram.
Query = list[set[frozenset[bytes]]]


def _clause(strings: set[str]) -> Query:
    grams = {frozenset(raw[i:i + 3] for i in range(len(raw) - 2))
             for raw in (s.encode("utf-8").lower() for s in strings)}  # lowers A-Z only, as the index does
    return [grams] if grams and all(grams) else []


def _strings(tree) -> set[str] | None:
    """All strings that a finite part of an expression can match; None if there are too many."""
    out = {""}
    for kind, value in tree:
        if kind is op.LITERAL:
            more = {chr(value)}
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value):
            more = {chr(v) for _, v in value}
        elif kind is op.BRANCH:
            parts = [_strings(branch) for branch in value[1]]
            more = None if None in parts else set().union(*parts)
        elif kind is op.SUBPATTERN:
            more = _strings(value[3])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] == 1:
            more = _strings(value[2])
            more = more if more is None or value[0] else more | {""}
        elif kind is op.AT:
            more = {""}
        else:
            more = None
        if more is None or len(out) * len(more) > _MOST_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def trigram_query(pattern: str) -> Query:
    """Clauses of trigrams that every match of ``pattern`` contains."""
    def walk(tree) -> Query:
        clauses, run = [], []
        for node in tree:
            if _strings([*run, node]) is not None:
                run.append(node)
                continue
            clauses += _clause(_strings(run))
            run = [node] if _strings([node]) is not None else []
            kind, value = node
            if kind is op.SUBPATTERN:
                clauses += walk(value[3])
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
                clauses += walk(value[2])
            elif kind is op.BRANCH:
                parts = [walk(branch) for branch in value[1]]
                if all(parts):  # one clause of each branch at least holds
                    clauses.append(set().union(*[part[0] for part in parts]))
        return clauses + _clause(_strings(run))
    return walk(_parser.parse(pattern))


class Scanner:
    """The rules with their queries, and the trigrams that any of them names."""

    def __init__(self, rules=(*BASE_RULES, *MORE_RULES)) -> None:
        self.rules = [(kind, re.compile(pattern), fewest, trigram_query(pattern)) for kind, pattern, fewest in rules]
        grams = sorted({g for *_, query in self.rules for clause in query for option in clause for g in option})
        self.number = {gram: k + 1 for k, gram in enumerate(grams)}
        self.table: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "table": None}

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[bytes, np.ndarray]:
        """Sorted rows of each trigram that a query names."""
        if self.table is None:
            self.table = np.zeros(1 << 24, np.uint16)
            for gram, k in self.number.items():
                self.table[gram[0] | gram[1] << 8 | gram[2] << 16] = k
        low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
        seen = self.table[low[:-2] | low[1:-1] << 8 | low[2:] << 16] if len(low) > 2 else np.zeros(0, np.uint16)
        at = np.flatnonzero(seen)
        rows = np.searchsorted(offsets, at, side="right") - 1
        pairs = np.unique(seen[at].astype(np.int64) * len(offsets) + rows)
        gram, row = pairs // len(offsets), pairs % len(offsets)
        return {g: row[np.searchsorted(gram, k):np.searchsorted(gram, k, "right")] for g, k in self.number.items()}

    def candidates(self, query: Query, held: dict[bytes, np.ndarray], rows: int) -> np.ndarray:
        found = np.arange(rows)
        for clause in query:
            options = [reduce(np.intersect1d, (held[g] for g in option)) for option in clause]
            found = np.intersect1d(found, reduce(np.union1d, options))
        return found

    def spans(self, column: pa.Array) -> list[list[tuple[int, int, int]]]:
        """(start, rule number, end) of each text's secrets, sorted; positions in code points."""
        data, offsets = text_bytes(column)
        held = self.postings(data, offsets)
        texts = column.fill_null("").to_pylist()
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, (_, pattern, fewest, query) in enumerate(self.rules):
            group = 2 if pattern.groups == 2 else 0
            for i in self.candidates(query, held, len(texts)).tolist():
                for match in pattern.finditer(texts[i]):
                    if match.end(group) - match.start(group) >= fewest:
                        out[i].append((match.start(), number, match.end()))
        for found in out:
            found.sort()
        return out


def _written(found: list[tuple[int, int, int]], rules) -> str:
    return ",".join(f"{rules[k][0]}:{start}:{end}" for start, k, end in found)


def _scan(scanner: Scanner):
    base = len(BASE_RULES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, upto in parts(batch.column("text")):
                found = scanner.spans(batch.column("text").slice(at, upto - at))
                first = [[x for x in spans if x[1] < base] for spans in found]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(at, upto - at),
                    *[pa.array([sum(x[1] == k for x in spans) for spans in first], pa.int64()) for k in range(base)],
                    pa.array([hashlib.sha256(_written(s, scanner.rules).encode()).hexdigest() for s in first]),
                    pa.array([_written(s, scanner.rules) for s in found], pa.string()),
                ], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return run


def secrets(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, counts of the base kinds, digest of the base spans, all spans.

    Spans are ``kind:start:end`` by start, then kind as listed, joined by commas; code points, end
    exclusive. Null and empty texts have none (an empty string and its digest). A null ``doc_id``
    stays null, repeated rows give repeated rows, other columns are not read, and an empty table
    gives an empty result.
    """
    plain = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(_scan(Scanner()), f"doc_id {kind}, n_assign long, n_access long, n_hex long, "
                                              "base_sha256 string, spans string")


def masked(text: str, found: list[tuple[int, int, int]]) -> str:
    """``text`` with every span, or run of overlapping spans, replaced by ``MARK``."""
    out, upto = [], 0
    for start, _, end in found:
        if start >= upto:
            out += [text[upto:start], MARK]
        upto = max(upto, end)
    return "".join([*out, text[upto:]])


def _mask(scanner: Scanner, names: list[str], text: str, length: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc")
            for at, upto in parts(docs.field(names.index(text))):
                part = docs.slice(at, upto - at)
                fields = part.flatten()
                texts = fields[names.index(text)]
                found = scanner.spans(texts)
                if any(found):
                    new = [masked(t, spans) if spans else t for t, spans in zip(texts.to_pylist(), found)]
                    if length in names:
                        k = names.index(length)
                        fields[k] = pa.array([len(t) if spans and n is not None else n for t, spans, n in zip(
                            new, found, fields[k].to_pylist())], fields[k].type)
                    fields[names.index(text)] = pa.array(new, texts.type)
                yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, fields=list(part.type))], ["doc"])
    return run


def without_secrets(docs: DataFrame, *, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """Rows of ``docs`` with every secret masked, and ``length`` (if there is such a column) brought up to date."""
    packed = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("doc"))
    out = packed.mapInArrow(_mask(Scanner(), docs.columns, text, length), packed.schema)
    return out.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
