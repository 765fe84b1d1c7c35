"""Secrets in whole texts, by a trigram index that is cut along documents.

Every rule's regular expression gives a Boolean trigram query. A batch of documents is
one segment of the index: the postings of all trigrams that some query names are built
for it, each query intersects and unites them, and the rule's expression verifies the
rows that remain. A rule without mandatory trigrams (a run of hexadecimal digits, say)
scans every row. Segments need nothing from one another, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import id_and_text, in_parts
from tidemark.llm.trigrams import TrigramTable, matching_rows, trigram_query, trigrams_of


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern`; those whose `group` has fewer
    than `least` characters are dropped. Letters are ASCII letters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False

    @property
    def flags(self) -> int:
        return re.ASCII | (re.IGNORECASE if self.any_case else 0)


# The base rules.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]+", least=16),
)

# Published forms of keys and tokens.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("hosting", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{60,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[sr]k_live_[A-Za-z0-9]{20,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@"),
)
RULES = (*BASE_RULES, *MORE_RULES)

SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start_at", pa.int64()), ("end_at", pa.int64())])
)
SPANS_DDL = "array<struct<kind:string,start_at:bigint,end_at:bigint>>"


class Scanner:
    """The rules with their queries, set up once for each task."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [
            (rule, re.compile(rule.pattern, rule.flags), trigram_query(rule.pattern, rule.flags))
            for rule in rules
        ]
        self.table = TrigramTable(set().union(*(trigrams_of(q) for _, _, q in self.rules)))

    def scan(self, texts: pa.Array) -> tuple[list[str], list[list[dict]]]:
        """Texts (null: empty) and the spans of each, by start and then by rule."""
        postings = self.table.postings(texts)
        decoded = [text or "" for text in texts.to_pylist()]
        found: list[list[tuple]] = [[] for _ in decoded]
        for order, (rule, expression, query) in enumerate(self.rules):
            for row in matching_rows(query, postings, len(decoded)).tolist():
                for match in expression.finditer(decoded[row]):
                    if match.end(rule.group) - match.start(rule.group) >= rule.least:
                        found[row].append((match.start(), order, match.end()))
        return decoded, [
            [
                {"kind": self.rules[order][0].kind, "start_at": start, "end_at": end}
                for start, order, end in sorted(spans)
            ]
            for spans in found
        ]


def scan_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col="doc_id", text_col="text"
) -> DataFrame:
    """doc_id and spans (kind, start_at, end_at in code points, end exclusive) per row.

    A null or empty text has no spans; repeated rows and null ids stay as they are;
    other columns are not read; an empty table gives an empty result. Spans of two
    rules may overlap and both stand; ties in start go by the order of the rules.
    """

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in in_parts(batches):
            _, spans = scanner.scan(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, SPANS)], names=["doc_id", "spans"]
            )

    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(search, f"doc_id bigint, spans {SPANS_DDL}")


def masked(text: str, spans: list[dict], mask: str) -> str:
    """The text with every stretch covered by spans replaced by one mask."""
    parts, at = [], 0
    for span in spans:
        if span["end_at"] <= at:
            continue
        if span["start_at"] >= at and (span["start_at"] > at or not parts):
            parts += [text[at : span["start_at"]], mask]
        at = span["end_at"]
    return "".join(parts) + text[at:]


def redact_secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    mask: str = "[SECRET]",
    text_col: str = "text",
    length_col: str = "n_chars",
) -> DataFrame:
    """The same table with secrets masked in the text, and its length in characters
    brought up to date where a text changed. Rows without a secret stay as they are, null
    and empty texts among them; repeated rows and null ids are rows like others; an empty
    table gives an empty one. Stretches of overlapping spans get one mask."""
    columns = docs.columns

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in in_parts(batches):
            texts, spans = scanner.scan(batch.column(text_col))
            changed = np.array([bool(found) for found in spans], dtype=bool)
            if not changed.any():
                yield batch
                continue
            new = [masked(t, s, mask) if s else t for t, s in zip(texts, spans)]
            made = {
                text_col: pa.array(new, pa.string()),
                length_col: pa.array([len(text) for text in new]),
            }
            arrays = []
            for name in columns:
                old = batch.column(name)
                if name in made:
                    old = pa.compute.if_else(pa.array(changed), made[name].cast(old.type), old)
                arrays.append(old)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return docs.mapInArrow(clean, docs.schema)


def spans_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start_at"].cast("string"), s["end_at"].cast("string")),
        ),
        ",",
    )


def secret_digest(spans: DataFrame) -> DataFrame:
    """Counts and checksum of the base rules' spans, and all spans as text."""
    kinds = [rule.kind for rule in BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return spans.select(
        "doc_id",
        *(count(kind) for kind in kinds),
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )
