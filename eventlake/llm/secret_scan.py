"""Secret scans through a trigram index.

Each rule's regular expression is turned into a Boolean query over trigrams that every match must
contain. Documents are indexed in segments (one Arrow batch each): postings of the trigrams that
some query mentions, found in one pass over the segment's bytes. The queries intersect and unite
postings; the rule's expression then verifies the documents that are left. A rule whose expression
has no mandatory trigram scans every document of the segment. The index is as large as a batch,
so memory is bounded whatever the table's size, and nothing is shuffled.

Offsets count code points, ends are exclusive. A missing text counts as empty and has no spans.
Rows with equal ids each keep their own spans. Only ASCII letters match in either case.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _parser as parser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.work import beside, ship, whole


@dataclass(frozen=True)
class Rule:
    """``base`` rules come first in reports; ``accept`` drops matches that are too short."""

    kind: str
    pattern: str
    accept: Callable[[re.Match], bool] = bool
    any_case: bool = False
    base: bool = False


#: A key from its BEGIN to its END line. Without an END before the next BEGIN: its header lines, lines
#: of base64 and a last shorter one. Line ends may be escaped, as in JSON, or be spaces.
KEY_BLOCK = (
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]{0,40}PRIVATE KEY-----"
    r"|(?:(?:[\s>]|\\[rn])+[A-Z][A-Za-z-]{0,40}: [^\r\n\\]*)*"
    r"(?:(?:(?:[\s>]|\\[rn])+[A-Za-z0-9+/]{16,}={0,2})+"
    r"(?:[\x20\t]*(?:\r?\n|(?:\\r)?\\n)[\x20\t>]*[A-Za-z0-9+/]{1,15}={0,2}(?=[\x20\t]*(?:[\r\n\\\"']|\Z)))?)?)"
)
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
        any_case=True,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20, base=True),
    Rule("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24, base=True),
    Rule("private_key", KEY_BLOCK),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"authorization: *bearer +[A-Za-z0-9._~+/-]{16,}", any_case=True),
)
SETS = 24


def letters(items) -> set[str] | None:
    """The characters of a class in lower case, or None if they are many."""
    out: set[str] = set()
    for op, value in items:
        if str(op) == "LITERAL":
            out.add(chr(value).lower())
        elif str(op) == "RANGE" and value[1] - value[0] < SETS:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out


def strings(node) -> set[str] | None:
    """All strings that an expression can match, or None if they are many."""
    out = {""}
    for op, value in node:
        name, one = str(op), None
        if name == "LITERAL":
            one = {chr(value).lower()}
        elif name == "IN":
            one = letters(value)
        elif name == "SUBPATTERN":
            one = strings(value[-1])
        elif name == "BRANCH":
            each = [strings(x) for x in value[1]]
            one = None if None in each else set().union(*each)
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[:2] == (0, 1):
            one = strings(value[2])
            one = None if one is None else one | {""}
        if one is None or len(out) * len(one) > SETS:
            return None
        out = {a + b for a in out for b in one}
    return out


def query_of_strings(found: set[str]) -> tuple | None:
    """Every match contains one of the strings."""
    if any(len(s) < 3 for s in found):
        return None
    each = [("all", *sorted({s[i : i + 3] for i in range(len(s) - 2)})) for s in sorted(found)]
    return each[0] if len(each) == 1 else ("any", *each)


def query_of(node) -> tuple | None:
    """Trigrams of the runs of finite parts, joined with what the other parts imply."""
    parts, run = [], []

    def flush():
        parts.append(query_of_strings(strings(run)))
        run.clear()

    for item in node:
        name, value = str(item[0]), item[1]
        if strings([*run, item]) is not None:
            run.append(item)
            continue
        flush()
        if strings([item]) is not None:
            run.append(item)
        elif name == "SUBPATTERN":
            parts.append(query_of(value[-1]))
        elif name == "BRANCH":
            each = [query_of(x) for x in value[1]]
            parts.append(None if None in each else ("any", *each))
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[0] >= 1:
            parts.append(query_of(value[2]))
    flush()
    known = [p for p in parts if p is not None]
    return None if not known else known[0] if len(known) == 1 else ("all", *known)


def trigram_query(pattern: str) -> tuple | None:
    """The Boolean trigram query of an expression, in lower case.

    ("all", ...) and ("any", ...) of trigrams or queries; None stands for every document.
    """
    return query_of(parser.parse(pattern))


def mentioned(query) -> set[str]:
    if query is None:
        return set()
    if isinstance(query, str):
        return {query}
    return set().union(*(mentioned(q) for q in query[1:]))


class Index:
    """Postings of the mentioned trigrams in one segment of texts."""

    def __init__(self, texts: list[bytes], trigrams: set[str]):
        self.all = np.arange(len(texts))
        data = np.frombuffer(b"\0".join(texts).lower(), dtype=np.uint8)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        wanted = np.zeros(1 << 24, dtype=np.uint8)
        codes = {t: int.from_bytes(t.encode(), "big") for t in trigrams}
        for code in codes.values():
            wanted[code] = 1
        wide = data.astype(np.uint32)
        grams = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:] if len(data) > 2 else wide[:0]
        at = np.flatnonzero(wanted[grams])
        hits = grams[at]
        docs = np.searchsorted(starts, at, side="right") - 1
        self.postings = {t: np.unique(docs[hits == code]) for t, code in codes.items()}

    def find(self, query) -> np.ndarray:
        if query is None:
            return self.all
        if isinstance(query, str):
            return self.postings[query]
        found = [self.find(q) for q in query[1:]]
        out = found[0]
        for f in found[1:]:
            out = np.intersect1d(out, f) if query[0] == "all" else np.union1d(out, f)
        return out


def scan_segment(texts: list[str], rules=RULES) -> list[list[tuple[int, int, int]]]:
    """(start, rule number, end) of every text's matches, sorted."""
    queries = [trigram_query(r.pattern) for r in rules]
    index = Index([t.encode() for t in texts], set().union(*map(mentioned, queries)))
    spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for n, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        find = re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.any_case else 0)).finditer
        for d in index.find(query):
            spans[d] += [(m.start(), n, m.end()) for m in find(texts[d]) if rule.accept(m)]
    for s in spans:
        s.sort()
    return spans


def segments(texts: list[str], chars: int = 1 << 22):
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t)
        if n >= chars:
            yield run
            run, n = [], 0
    if run:
        yield run


SPANS = "array<struct<start:int,kind:string,end:int,base:boolean>>"


def scan(docs: DataFrame, rules=RULES, key: str = "doc_id") -> DataFrame:
    """Spans of every document, by start and then by rule; overlapping rules each report theirs."""

    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            found = [s for part in segments(batch["text"].tolist()) for s in scan_segment(part, rules)]
            yield pd.DataFrame(
                {
                    "spans": [
                        [
                            {"start": a, "kind": rules[n].kind, "end": e, "base": rules[n].base}
                            for a, n, e in s
                        ]
                        for s in found
                    ],
                }
            )

    return beside(docs.select(key, whole().alias("text")), run, ["text"], [key], f"spans {SPANS}")


def redact(docs: DataFrame, rules=RULES) -> DataFrame:
    """The columns of ``docs`` with every secret in the text replaced by ``[kind]``.

    Overlapping spans are replaced as one, named by the first. ``n_chars`` follows the text where
    the table has it. Other rows pass unchanged, missing texts stay missing.
    """
    ship(docs.sparkSession)
    columns = docs.columns

    def run(batches):
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["text"]]
            found = [
                s
                for part in segments([t or "" for t in texts])
                for s in scan_segment(part, rules)
            ]
            for i, spans in enumerate(found):
                if not spans:
                    continue
                out, at = [], 0
                for a, n, e in spans:
                    if a >= at:
                        out += [texts[i][at:a], f"[{rules[n].kind}]"]
                    at = max(at, e)
                texts[i] = "".join([*out, texts[i][at:]])
            yield pd.DataFrame({"text": texts})

    clean = beside(docs, run, ["text"], [c for c in columns if c != "text"], "text string")
    if "n_chars" in columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return clean.select(*columns)


def digest(found: DataFrame, rules=RULES) -> DataFrame:
    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
        )

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda x: x["base"])
    return found.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in rules if r.base],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
