"""Secret scans through a trigram inverted index.

From each rule's regular expression a Boolean query over lower-cased byte trigrams is derived that
every match must satisfy. A piece of documents is indexed for the trigrams that some query names;
intersecting and uniting postings gives each rule's candidate documents, and only those are
searched with the expression. A rule without mandatory trigrams scans every document. Nothing is
shuffled, and memory is bounded by one piece of documents, so a lost executor costs its tasks only.

Defined results: null or empty text holds no secrets, and its digest is that of the empty string; a
null doc_id stays null; repeated rows are scanned each on its own; an empty table gives an empty
result; other columns are ignored by ``scan_secrets`` and untouched by ``redact_secrets``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as c
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stoptide.llm.common import give_back, pieces, read_table, text_bytes


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression and the least length of one of its groups."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


#: The base rules, in the order in which their kinds are listed.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
)
#: Public token formats.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("github_fine", r"github_pat_[A-Za-z0-9_]{40,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("slack_hook", r"hooks\.slack\.com/services/[A-Z0-9]+/[A-Z0-9]+/[A-Za-z0-9]{20,}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("google_api", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("google_oauth", r"ya29\.[A-Za-z0-9_-]{20,}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("pypi", r"pypi-AgEIcHlwaS5vcmc[A-Za-z0-9_-]{50,}"),
    Rule("twilio", r"\bSK[0-9a-f]{32}\b"),
    Rule("telegram", r"\b[0-9]{8,10}:AA[A-Za-z0-9_-]{33}\b"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN (?:RSA |DSA |EC |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@[A-Za-z0-9.-]+"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}=*", any_case=True),
)
RULES = BASE_RULES + MORE_RULES

# ---------------------------------------------------------------- trigram queries

ALWAYS = ("all",)
MOST_STRINGS = 64


def _both(a: tuple, b: tuple) -> tuple:
    return b if a == ALWAYS else a if b == ALWAYS or a == b else ("and", a, b)


def _either(parts: list[tuple]) -> tuple:
    return ALWAYS if not parts or ALWAYS in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _of_strings(strings: set[str]) -> tuple:
    """The query that one of these strings occurs; those under three bytes say nothing."""
    parts = []
    for s in sorted(strings):
        raw = s.lower().encode()
        q = ALWAYS
        for i in range(len(raw) - 2):
            q = _both(q, ("tri", raw[i : i + 3]))
        parts.append(q)
    return _either(parts)


def _exact(op, arg) -> set[str] | None:
    """The finite set of strings an item stands for, or None."""
    if op is c.LITERAL:
        return {chr(arg).lower()} if arg < 128 else None
    if op is c.IN:
        out = set()
        for kind, x in arg:
            if kind is c.LITERAL and x < 128:
                out.add(chr(x).lower())
            elif kind is c.RANGE and x[1] < 128 and x[1] - x[0] < MOST_STRINGS:
                out |= {chr(k).lower() for k in range(x[0], x[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is c.SUBPATTERN:
        return _exact_seq(arg[3])
    if op is c.BRANCH:
        found = [_exact_seq(x) for x in arg[1]]
        return None if None in found else set().union(*found)
    if op in (c.MAX_REPEAT, c.MIN_REPEAT) and arg[1] <= 2 and (inner := _exact_seq(arg[2])) is not None:
        out = {""} if arg[0] == 0 else set()
        for k in range(max(1, arg[0]), arg[1] + 1):
            level = {""}
            for _ in range(k):
                level = {a + b for a in level for b in inner}
            out |= level
        return out
    return {""} if op is c.AT else None


def _exact_seq(seq) -> set[str] | None:
    out = {""}
    for op, arg in seq:
        e = _exact(op, arg)
        if e is None or len(out) * len(e) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in e}
    return out


def _query(seq) -> tuple:
    need, run = ALWAYS, {""}
    for op, arg in seq:
        e = _exact(op, arg)
        if e is not None and len(run) * len(e) <= MOST_STRINGS:
            run = {a + b for a in run for b in e}
            continue
        need, run = _both(need, _of_strings(run)), {""}
        if e is not None:
            run = e
        elif op is c.SUBPATTERN:
            need = _both(need, _query(arg[3]))
        elif op is c.BRANCH:
            need = _both(need, _either([_query(x) for x in arg[1]]))
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT) and arg[0] > 0:
            need = _both(need, _query(arg[2]))
    return _both(need, _of_strings(run))


def trigram_query(rule: Rule) -> tuple:
    """A Boolean query that the lower-cased bytes of every text with a match satisfy."""
    return _query(parser.parse(rule.pattern, re.ASCII))


def named_trigrams(query: tuple) -> set[bytes]:
    """The trigrams a query names."""
    return {query[1]} if query[0] == "tri" else set().union(*(named_trigrams(x) for x in query[1:] if isinstance(x, tuple)))


def answer(query: tuple, postings: dict[bytes, np.ndarray], everything: np.ndarray) -> np.ndarray:
    """The documents that satisfy a query, from sorted postings."""
    if query == ALWAYS:
        return everything
    if query[0] == "tri":
        return postings.get(query[1], everything[:0])
    parts = [answer(x, postings, everything) for x in query[1:]]
    out = parts[0]
    for p in parts[1:]:
        out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
    return out


# ---------------------------------------------------------------- the index

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Scanner:
    """Rules with their queries, and the table that maps a trigram to its number."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, r.compiled(), trigram_query(r)) for r in rules]
        self.trigrams = sorted(set().union(*(named_trigrams(q) for _, _, q in self.rules)))
        self.number = np.full(1 << 24, -1, dtype=np.int16)
        for k, t in enumerate(self.trigrams):
            self.number[t[0] << 16 | t[1] << 8 | t[2]] = k

    def postings(self, data: np.ndarray, at: np.ndarray) -> dict[bytes, np.ndarray]:
        if len(data) < 3:
            return {}
        low = _LOWER[data].astype(np.int32)
        found = self.number[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
        where = np.flatnonzero(found >= 0)
        doc = np.searchsorted(at, where, side="right") - 1
        whole = where + 2 < at[doc + 1]
        n = len(at)
        pairs = np.unique(found[where[whole]].astype(np.int64) * n + doc[whole])
        tri, docs = pairs // n, pairs % n
        cut = np.searchsorted(tri, np.arange(len(self.trigrams) + 1))
        return {t: docs[cut[k] : cut[k + 1]] for k, t in enumerate(self.trigrams)}

    def spans(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """Per text: (start, rule number, end) in code points, in order."""
        data, at = text_bytes(texts)
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        for i, j in pieces(len(texts), at):
            own = at[i : j + 1] - at[i]
            index, everything = self.postings(data[at[i] : at[j]], own), np.arange(j - i)
            body: dict[int, str] = {}
            for k, (rule, rx, query) in enumerate(self.rules):
                for d in answer(query, index, everything).tolist():
                    if d not in body:
                        body[d] = texts[i + d].as_py() or ""
                    for m in rx.finditer(body[d]):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            out[i + d].append((m.start(), k, m.end()))
        for x in out:
            x.sort()
        return out


_SCANNERS: dict[tuple[Rule, ...], Scanner] = {}


def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """One scanner per process and rule set."""
    if rules not in _SCANNERS:
        _SCANNERS[rules] = Scanner(rules)
    return _SCANNERS[rules]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: the id and ``spans``, an array of (kind, start, end) in code points, end exclusive."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for b in batches:
            spans = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in x] for x in scan.spans(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(kind))], names=["doc_id", "spans"])

    return docs.select(id_col, text).mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def _merged(spans: list[tuple[int, int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, _, end in spans:
        if out and start < out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", length: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with every secret replaced by ``mark``; ``length`` names a column of the text's length to renew."""
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for b in batches:
            body = b.column(at).to_pylist()
            for k, spans in enumerate(scan.spans(b.column(at))):
                if spans:
                    out, last = [], 0
                    for start, end in _merged(spans):
                        out += [body[k][last:start], mark]
                        last = end
                    body[k] = "".join([*out, body[k][last:]])
            cols = [b.column(i) for i in range(b.num_columns)]
            cols[at] = pa.array(body, b.schema.field(at).type)
            if length:
                n = names.index(length)
                cols[n] = pa.array([None if x is None else len(x) for x in body], b.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)
        give_back()

    plain = docs.toDF(*(f"_c{i}" for i in range(len(names))))
    return plain.mapInArrow(run, plain.schema).toDF(*names)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret scan over the whole of ``documents``: counts, digest of the base spans, and all spans."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    base, id_type = len(BASE_RULES), docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner()

        def said(x: list[tuple[int, int, int]]) -> str:
            return ",".join(f"{RULES[k].kind}:{s}:{e}" for s, k, e in x)

        for b in batches:
            found = scan.spans(b.column(1))
            counts = [pa.array([sum(y[1] == k for y in x) for x in found], pa.int64()) for k in range(base)]
            digest = pa.array([hashlib.sha256(said([y for y in x if y[1] < base]).encode()).hexdigest() for x in found], pa.string())
            cols = [b.column(0), *counts, digest, pa.array([said(x) for x in found], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.mapInArrow(run, f"doc_id {id_type}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
